"""Word lists, patterns and limits that results depend on."""

CHUNK_LIMIT = 3200
CHUNK_LEAST = 1200
SEARCH_TEXT_CHARS = 480
SNIPPET_CHARS = 380
SEARCH_LIMIT = 50
TOPIC_LIST_LIMIT = 15
SCAN_STREAM_BYTES = 2 * 1024 * 1024
PDF_LEAST_WORD_CHARS = 500
FULL_TEXT_LEAST_WORD_CHARS = 200

RASTER = [".png", ".jpg", ".jpeg", ".gif", ".bmp", ".tif", ".tiff"]
VECTOR = [".wmf", ".emf"]

# keyword -> media type, the first that a caption holds
MEDIA_KEYWORDS = [
    ("схем", "scheme"), ("диаграм", "diagram"), ("график", "chart"), ("таблиц", "table_image"), ("карта", "map"), ("карты", "map"), ("фото", "photo"),
    ("фотограф", "photo"), ("обложк", "cover"), ("репродукц", "reproduction"), ("картин", "reproduction"), ("плакат", "reproduction"), ("скан", "scan_fragment"),
]
LABEL = r"(Рис(?:унок)?\.?\s*[\dIVXLCivxlc]*[.\-\d]*|Схема\s*\d[\d.]*|Диаграмма\s*\d[\d.]*|Таблица\s*\d[\d.]*|Илл\.?\s*\d[\d.]*|График\s*\d[\d.]*|Карта\s*[\dA-Za-z]*)"
CAPTION = r"(рис(?:унок|\.)\s*[\divxlcIVXLC.\-]*|схема|диаграмм|таблиц|иллюстрац|график|картин|репродукц|фотограф|фото\b|карта\b|карты\b|обложк|плакат|кадр\b|скриншот|икон)"
THIRD_PARTY = r"(репродукц|картин|фотограф|фото\b|кадр|плакат|скриншот|снимок\s+экрана|сайт|http|www\.|карта\s+\w+ск|карты\b|обложк|икон[аыо]?[,\.\s)])"
COVER = r"(обложк|титульн|cover\b)"
SCREENSHOT = r"(скриншот|снимок\s+экрана|screenshot|принтскрин|printscreen|копия\s+(страниц|документ)|скан\s|сканированн|факсимил|фотокопи)"
PHOTO = r"(фотограф|фото\b|фотоснимок|фотокарточк|кадр\s+из)"
REPRODUCTION = r"(репродукц|картин|плакат|афиш|из\s+книг|из\s+журнал|из\s+газет|иллюстрац.{0,20}из\b|сайт|https?://|www\.)"
SCHEME = r"(схем|диаграмм|алгоритм|структур|иерархи|блок-|матриц)"
TABLE = r"(таблиц|график|гистограмм|крива[ях])"
TABLE_LABEL = r"(таблиц|график)"
AUTHORIAL_CLASSES = ["authorial_scheme_or_diagram", "authorial_table_or_chart", "authorial_formula_or_math"]
THIRD_PARTY_CLASSES = ["third_party_photo", "third_party_reproduction", "cover_or_external_art", "screenshot_or_document_scan"]

TOPIC_ID = r"^topic-[a-z0-9][a-z0-9-]*$"
CONCEPT_ID = r"^cp-[a-z0-9][a-z0-9-]*$"
CITATION_ID = r"^ct-[a-z0-9][a-z0-9-]*$"
VARIANT_ID = r"^lv-[a-z0-9а-яё][a-z0-9а-яё-]*$"
DEFINITION_SCOPES = ["corpus_term", "editorial_navigation", "established_term"]
PUBLICATION_STATES = ["draft", "published", "withdrawn"]
REVIEW_STATES = ["unreviewed", "reviewed"]
TRANSLATION_STATUSES = ["canonical", "provisional", "confirmed", "absent"]
ALWAYS_INDEXABLE = ["work", "section", "volume_index", "landing", "topics_index", "concepts_index", "figure"]

EMAIL = r"[\w.+-]+@[\w-]+(\.[\w-]+)+"
# in binaries, where noise looks like addresses: lower-case domains only
EMAIL_IN_BINARY = r"(?<![\w.+-])[\w.+-]{2,}@[a-z0-9-]{2,}\.[a-z]{2,}"
# three Cyrillic letters whose UTF-8 was read as Latin-1 or CP1252: the letter of the first byte and what such a second byte becomes
MISREAD_CYRILLIC = r"(Ð[\x{80}-\x{BF}€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]|Ñ[\x{80}-\x{9F}€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]){3}"
PRINTABLE_RUN = r"[\x20-\x7e]{6,}"
MARKDOWN_LINK = r"(?<!!)\[([^\]]+)\]\(([^)\s]+)\)"
MARKDOWN_IMAGE = r"!\[(?:[^\[\]]|\[[^\]]*\])*\]\(([^)]+)\)"
HTML_IMAGE = r"(?i)<img\b[^>]*?src=[\"']([^\"']+)[\"']"
BASE64_RUN = r"[A-Za-z0-9+/]{40,}={0,2}"
FORBIDDEN_NAMES = r"(?i)(raw_extracted|_qa|manifest\.json|qa\.json|OLE|\.bin$|\.docx?$|media_qa)"
TEXT_EXTENSIONS = [".html", ".htm", ".css", ".js", ".json", ".jsonl", ".md", ".txt", ".svg", ".xml", ".yml", ".yaml", ".py", ".csv"]
# label, pattern: in every text; an address is sought from the beginning of a run only, which finds the same texts in linear time
FORBIDDEN = [
    ("personal Drive link", r"(?i)drive\.google"),
    ("personal Drive link", r"(?i)googledrive|docs\.google\.com/drive"),
    ("e-mail address", r"(?i)(?<![\w.+-])[\w.+-]{2,}@(?!users\.noreply\.github\.com)[\w-]{2,}\.[\w.]{2,}"),
    ("personal path/username", r"[A-Za-z]:\\Users\\"),
]
# label, pattern: in rendered pages as well
FORBIDDEN_IN_SITE = [
    ("internal review data", r"media_review_queue|ole_review_queue|release_approval"),
    ("internal workspace path", r"/mnt/data"),
    ("javascript: URL in output", r"(?i)javascript\s*:"),
    ("inline/foreign script tag", r"(?i)<script(?![^>]*assets/(reader|search)\.js)(?![^>]*application/ld\+json)"),
    ("opaque external file id", r"[?&]id=[\w-]{20,}"),
]

# where sources of works are kept, and the mark of names that lead to files of a site
SOURCE_PREFIX = "site:"
SOURCE_FOLDERS = {"converted": "docx", "classified_docx": "site_docx", "originals": "site_files", "repaired": "repaired"}

# marks that stand in a text for an illustration that may not be shown: one, and several at one place
OMITTED_ONE = "*[В оригинальном издании здесь расположена иллюстрация{label}. Не воспроизводится до правовой проверки и решения владельца; см. запись в FIGURES.md.]*"
OMITTED_SEVERAL = "*[В оригинальном издании здесь расположены иллюстрации ({n} объекта). Иллюстрации опущены: см. реестр графического слоя работы.]*"
NO_ALT = "иллюстрация"
FIGURE_TAG = r"<!--\s*figs:([0-9A-Za-zА-Яа-яёЁ_,\-]+)\s*-->"
# names of styles that get into captions: before Cyrillic letters, and at the beginning
GLUED_STYLE = r"([a-z]+\d+)(?=[А-Яа-яЁё])"
LEADING_STYLES = r"^([a-z]+\d+\s*)+"

# folders of volumes and of the media in them
VOLUME_PREFIX = "tom-"
VOLUME_MEDIA = "assets/media"

# sentences that a record of provenance gives as its evidence; those that end openly are followed by what was found
COVER_EVIDENCE = "cover signal in context/media_type"
SCREENSHOT_EVIDENCE = "screenshot/scan signal in context"
PHOTO_EVIDENCE = "photo signal in context/media_type"
REPRODUCTION_EVIDENCE = "reproduction/external-source signal"
TABLE_CAPTION_EVIDENCE = "table/chart caption"
SCHEME_CAPTION_EVIDENCE = "scheme/diagram caption"
NO_EVIDENCE = "no decisive authorial or third-party evidence"
VECTOR_EVIDENCE = "vector source format "
TYPE_EVIDENCE = "media_type "
TABLE_LABEL_EVIDENCE = "numbered table/chart label '"
FIGURE_LABEL_EVIDENCE = "numbered figure label '"
