"""The registry of figures from its sources: documents that embed them, folders of a volume, objects of other programs.

Each feeder makes records of one schema (RECORD); elect() lets the first record of equal bytes stand for the others, across feeders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, media, text
from ..sources import office, readers
from . import registry

RECORD = """figure_id string, work_id string, section_id string, source_kind string, source_file string, source_sha256 string, source_page int,
original_filename string, media_file string, media_bytes bigint, caption string, figure_label string, media_type string, referenced_in_text boolean,
ref_count int, ref_sites array<string>, criticality string, rights_status string, publication_status string, provenance_class string,
provenance_evidence array<string>, anchor_confidence string, anchor_file string, anchor_line int, anchor_mode string, anchor_sha256 string,
context_excerpt string, containing_source string, containing_source_sha256 string, conversion string, notes string"""
#: What orders the records of one object: feeder, work, then phase, place and name within the work.
SEAT = ["seat_feeder", "work_id", "seat_phase", "seat_place", "original_filename", "figure_id"]
VOLUME_OBJECTS, OTHER_WORKS = 0, 1
CONTEXT_LINES, CONTEXT_CHARS = 4, 800


def _ext(name: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(name, F.lit("")), r"(\.[^./]*)$", 1))


def _stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^./]*$", "")


def shaped(rows: DataFrame) -> DataFrame:
    """rows in the columns of RECORD and of the seat, absent ones null."""
    kinds = [x.split() for x in RECORD.replace("\n", " ").split(", ")]
    kinds += [["seat_feeder", "int"], ["seat_phase", "int"], ["seat_place", "bigint"], ["may_repeat", "boolean"]]
    return rows.select(*[(F.col(c) if c in rows.columns else F.lit(None)).cast(kind).alias(c) for c, kind in kinds])


def references(lines: DataFrame) -> DataFrame:
    """work_id, section_id, file, line_no and media_name of the images that lines (work_id, section_id, file, line_no, line) refer to; remote ones are left out."""
    found = F.concat(F.regexp_extract_all("line", F.lit(fixed.MARKDOWN_IMAGE), 1), F.regexp_extract_all("line", F.lit(fixed.HTML_IMAGE), 1))
    rows = lines.select("work_id", "section_id", "file", "line_no", F.explode(found).alias("target"))
    name = F.substring_index(F.substring_index("target", " ", 1), "/", -1)
    return rows.where(~F.col("target").contains("://")).select("work_id", "section_id", "file", "line_no", name.alias("media_name"))


def sites(refs: DataFrame) -> DataFrame:
    """A row for each work_id and media_name: its first place (file, line_no, section_id), ref_count and ref_sites in order."""
    at = F.struct("file", "line_no", "section_id")
    every = F.transform(F.array_sort(F.collect_list(F.struct("file", "line_no"))), lambda x: x["file"])
    return refs.groupBy("work_id", "media_name").agg(F.min(at).alias("at"), F.count(F.lit(1)).cast("int").alias("ref_count"), every.alias("ref_sites")).select("work_id", "media_name", "at.*", "ref_count", "ref_sites")


def with_surroundings(rows: DataFrame, lines: DataFrame, key: list[str]) -> DataFrame:
    """rows (key, file, line_no) with caption, label and surroundings, the lines round their place."""
    refs = rows.where("file IS NOT NULL").select(F.struct(*key).alias("ref_id"), "file", "line_no")
    of = registry.captions(refs, lines.select("file", "line_no", "line")).select("ref_id", "caption", F.col("label").alias("figure_label"))
    near = refs.join(lines.select("file", F.col("line_no").alias("at"), F.trim("line").alias("line")), "file").where(F.abs(F.col("at") - F.col("line_no")) <= CONTEXT_LINES)
    words = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), " ")
    round_ = near.groupBy("ref_id").agg(F.substring(words, 1, CONTEXT_CHARS).alias("surroundings"))
    out = rows.withColumn("ref_id", F.struct(*key)).join(of, "ref_id", "left").join(round_, "ref_id", "left").drop("ref_id")
    return out.withColumn("surroundings", F.coalesce("surroundings", F.lit("")))


def _own_caption(rows: DataFrame) -> DataFrame:
    """caption and figure_label of rows that have none from the paragraphs of their document: the nearest, the earlier of two."""
    around = F.array("words", "previous", "following")
    told = F.transform(around, lambda t: F.struct(
        F.when(t.rlike("(?iuU)" + fixed.CAPTION), F.trim(F.regexp_replace(t, r"^\*+|\*+$", ""))).alias("caption"), F.nullif(F.regexp_extract(t, "(?iuU)" + fixed.LABEL, 1), F.lit("")).alias("label")))
    first = F.get(F.filter(told, lambda x: x["caption"].isNotNull() | x["label"].isNotNull()), F.lit(0))
    none = F.col("caption").isNull() & F.col("figure_label").isNull()
    rows = rows.withColumn("_told", first)
    label = F.when(none, F.col("_told.label")).otherwise(F.col("figure_label"))
    return rows.withColumns({"caption": F.when(none, F.coalesce("_told.caption", "_told.label")).otherwise(F.col("caption")), "figure_label": label}).drop("_told")


def judged(rows: DataFrame, ext: Column, size: Column, side: Column, typed_by: str = "caption") -> DataFrame:
    """rows (caption, figure_label, context_excerpt, referenced_in_text) with media_type (by the caption in typed_by), rights_status,
    criticality, provenance and the status that they have if theirs is the first record of the object."""
    rows = rows.withColumn("_ext", ext).withColumn("media_type", media.media_type(F.col(typed_by), F.col("_ext")))
    rows = rows.withColumn("rights_status", media.rights(F.col("media_type"), F.col("caption"), F.col("context_excerpt"), F.col("_ext"), F.col("figure_label")))
    rows = rows.withColumn("criticality", media.criticality(F.col("media_type"), F.col("_ext"), F.col("figure_label"), F.coalesce(size, F.lit(0)), side))
    origin = media.provenance(F.col("media_type"), F.col("caption"), F.col("figure_label"), F.col("context_excerpt"), F.col("_ext"))
    rows = rows.withColumn("_origin", origin).withColumn("provenance_class", F.col("_origin.class")).withColumn("provenance_evidence", F.col("_origin.evidence"))
    status = media.staging(F.col("source_sha256").isNotNull(), F.lit(True), F.col("rights_status"), F.col("criticality"), F.col("referenced_in_text"), F.col("_ext"))
    conversion = F.when(status == "published", F.when(F.col("_ext").isin(fixed.VECTOR), F.concat(F.lit("to .png from "), F.col("_ext"))).otherwise("verbatim_copy"))
    return rows.withColumn("publication_status", status).withColumn("conversion", conversion).drop("_ext", "_origin")


def _sized(objects: DataFrame, key: list[str]) -> DataFrame:
    """objects (key, data) with sha, media_bytes and side, the longer one of the picture, without their bytes."""
    name = F.concat_ws("\x00", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key])
    sizes = readers.image_sizes(objects.select(name.alias("path"), F.col("data").alias("content"))).groupBy("path").agg(F.max(F.greatest("width", "height")).alias("side"))
    rows = objects.select(*key, F.sha2("data", 256).alias("source_sha256"), F.length("data").cast("bigint").alias("media_bytes"), name.alias("path"))
    return rows.join(sizes, "path", "left").drop("path")


def from_documents(works: DataFrame, files: DataFrame, lines: DataFrame) -> DataFrame:
    """Records of works (work_id, source_path, source_name, source_sha256, url) whose source is a DOCX of files (path, content).

    A media member that the work's lines refer to is bound there; one that they do not is sought by the paragraphs round it; a
    reference to no member is unresolved; a work without its document has its references as missing.
    """
    works = works.select("work_id", "source_path", "source_name", F.col("source_sha256").alias("containing_source_sha256"), "url")
    own = files.join(works.select(F.col("source_path").alias("path")).distinct(), "path", "left_semi")
    members = readers.zip_members(own).join(works.select("work_id", F.col("source_path").alias("path")), "path")
    objects = _sized(members.select("work_id", "member", "data"), ["work_id", "member"])
    seen = readers.image_neighbours(readers.docx_paragraphs(own)).join(works.select("work_id", F.col("source_path").alias("path")), "path")
    at = F.struct((F.col("part") != "word/document.xml").alias("_p"), "part", "paragraph_no")
    places = seen.groupBy("work_id", F.col("image").alias("member")).agg(F.min_by(F.struct("words", "previous", "following"), at).alias("p")).select("work_id", "member", "p.*")
    objects = objects.join(places, ["work_id", "member"], "left").withColumns({c: F.coalesce(c, F.lit("")) for c in ("words", "previous", "following")})
    objects = objects.withColumn("docx", F.substring(F.trim(F.concat_ws(" ", *[F.nullif(F.col(c), F.lit("")) for c in ("previous", "words", "following")])), 1, CONTEXT_CHARS))

    named = sites(references(lines.join(works.select("work_id"), "work_id", "left_semi")))
    have = works.join(own.select(F.col("path").alias("source_path")), "source_path", "left_semi").select("work_id", F.lit(True).alias("has_source"))
    met = named.withColumnRenamed("file", "_md")
    met = registry.match_media(met, objects.select("work_id", F.col("member").alias("file"))).withColumnRenamed("file", "member").withColumnRenamed("_md", "file")
    met = with_surroundings(met.join(have, "work_id", "left"), lines, ["work_id", "media_name"])
    bound = met.where("member IS NOT NULL").join(objects, ["work_id", "member"]).withColumn("context_excerpt", F.substring(F.trim(F.concat_ws(" ", "surroundings", "docx")), 1, CONTEXT_CHARS))
    bound = _own_caption(bound.withColumn("text_caption", F.col("caption"))).withColumn("referenced_in_text", F.lit(True))
    bound = judged(bound, _ext(F.col("member")), F.col("media_bytes"), F.col("side"), "text_caption").withColumns({
        "figure_id": text.object_id(F.col("work_id"), F.col("media_name")), "source_kind": F.lit("docx_embedded"), "media_file": F.col("media_name"),
        "original_filename": F.when(F.col("by_stem"), F.col("member")).otherwise(F.col("media_name")), "seat_phase": F.lit(0), "seat_place": F.col("line_no"),
    })
    lost = met.where("member IS NULL").withColumns({
        "figure_id": text.object_id(F.col("work_id"), F.col("media_name")), "original_filename": F.col("media_name"), "referenced_in_text": F.lit(True),
        "source_kind": F.when(F.col("has_source"), "unresolved_reference").otherwise("missing_source"), "publication_status": F.lit("metadata_only_source"),
        "media_type": F.lit("other"), "criticality": F.lit("unclear"), "rights_status": F.lit("unknown"), "seat_phase": F.lit(0), "seat_place": F.col("line_no"),
        "notes": F.when(F.col("has_source"), "no object of this name in the source").otherwise("the source is not at hand"),
    })
    free = objects.join(met.select("work_id", "member").where("member IS NOT NULL").distinct(), ["work_id", "member"], "left_anti")
    key = F.concat_ws("\x00", "work_id", "member")
    asked = free.select(key.alias("place_id"), "work_id", F.col("words").alias("paragraph"), "previous", F.col("following").alias("next"))
    norm = lines.withColumn("norm", text.squeeze(F.col("line"))).where("norm <> ''").select("work_id", "file", "line_no", "norm")
    found = registry.recover_anchors(asked, norm).select(F.col("place_id"), F.col("file").alias("anchor_file"), F.col("line_no").alias("anchor_line"), F.col("mode").alias("anchor_mode"), F.col("sha").alias("anchor_sha256"), F.col("confidence").alias("anchor_confidence"))
    of_file = lines.groupBy(F.col("file").alias("anchor_file")).agg(F.min("section_id").alias("section_id"))
    free = free.withColumn("place_id", key).join(found, "place_id", "left").join(of_file, "anchor_file", "left")
    free = _own_caption(free.withColumns({"text_caption": F.lit(None).cast("string"), "caption": F.lit(None).cast("string"), "figure_label": F.lit(None).cast("string"), "context_excerpt": F.nullif("docx", F.lit("")), "referenced_in_text": F.lit(False)}))
    free = judged(free, _ext(F.col("member")), F.col("media_bytes"), F.col("side"), "text_caption").withColumns({
        "figure_id": text.object_id(F.col("work_id"), F.col("member"), F.lit(True)), "source_kind": F.lit("docx_embedded_unbound"), "media_file": F.col("member"),
        "original_filename": F.col("member"), "seat_phase": F.lit(1), "seat_place": F.lit(0), "notes": F.lit("in the source, but not referred to in the text"),
    })
    rows = shaped(bound).unionByName(shaped(lost)).unionByName(shaped(free)).drop("source_file", "containing_source", "containing_source_sha256")
    rows = rows.join(works.select("work_id", F.coalesce("url", "source_name").alias("source_file"), F.col("source_name").alias("containing_source"), "containing_source_sha256"), "work_id")
    return shaped(rows.withColumns({"seat_feeder": F.lit(OTHER_WORKS), "may_repeat": F.lit(True)}))


def from_fb2(works: DataFrame, files: DataFrame, lines: DataFrame) -> DataFrame:
    """Records of works whose source is an FB2 of files: an image belongs behind the line of the text before it, else before that of the text behind it."""
    works = works.select("work_id", "source_path", "source_name", F.col("source_sha256").alias("containing_source_sha256"), "url")
    own = files.join(works.select(F.col("source_path").alias("path")).distinct(), "path", "left_semi")
    images = readers.fb2_images(readers.fb2_events(own)).join(works.select("work_id", F.col("source_path").alias("path")), "path")
    known = lines.withColumn("norm", text.squeeze(F.col("line"))).where("norm <> ''").groupBy("work_id", "norm").agg(F.min(F.struct("file", "line_no", "section_id")).alias("at"))
    tidy = lambda c: text.squeeze(F.coalesce(c, F.lit("")))
    images = images.withColumn("_a", tidy(F.col("before"))).withColumn("_b", tidy(F.col("behind")))
    for side in ("_a", "_b"):
        images = images.join(known.select("work_id", F.col("norm").alias(side), F.col("at").alias(f"{side}_at")), ["work_id", side], "left")
    at = F.coalesce("_a_at", "_b_at")
    anchor = F.when(F.col("_a_at").isNotNull(), F.col("_a")).when(F.col("_b_at").isNotNull(), F.col("_b"))
    images = images.withColumn("at", at).withColumns({
        "file": F.col("at.file"), "line_no": F.col("at.line_no"), "section_id": F.col("at.section_id"), "anchor_sha256": F.sha2(anchor, 256),
        "anchor_mode": F.when(F.col("_a_at").isNotNull(), "after").when(F.col("_b_at").isNotNull(), "before"), "data": F.col("bytes"),
    })
    sized = _sized(images.select("work_id", "pos", "data"), ["work_id", "pos"])
    rows = with_surroundings(images.drop("data", "bytes"), lines, ["work_id", "pos"]).join(sized, ["work_id", "pos"])
    label = F.nullif(F.regexp_extract(F.coalesce("behind", F.lit("")), "(?iuU)" + fixed.LABEL, 1), F.lit(""))
    bare = F.col("caption").isNull() & label.isNotNull()
    rows = rows.withColumn("figure_label", F.when(bare, label).otherwise(F.col("figure_label"))).withColumn("caption", F.when(bare, F.trim(F.regexp_replace("behind", r"^\*+|\*+$", ""))).otherwise(F.col("caption")))
    name = F.when(F.col("image") == "", F.concat(F.lit("bin_"), F.col("pos").cast("string"))).otherwise(F.col("image"))
    ext = F.when(_ext(name).isin(fixed.RASTER + fixed.VECTOR), _ext(name)).otherwise(".png")
    rows = rows.withColumns({"context_excerpt": F.nullif("surroundings", F.lit("")), "referenced_in_text": F.col("file").isNotNull()})
    rows = judged(rows, ext, F.col("media_bytes"), F.col("side")).withColumns({
        "figure_id": text.object_id(F.col("work_id"), F.concat(F.lit("fb2-"), F.lpad(F.col("pos").cast("string"), 3, "0"), F.lit("-"), name)), "source_kind": F.lit("fb2_embedded"),
        "original_filename": name, "media_file": F.when(_ext(name).isin(fixed.RASTER), name).otherwise(F.concat(name, ext)), "anchor_file": F.col("file"), "anchor_line": F.col("line_no"),
        "anchor_confidence": F.when(F.col("file").isNotNull(), "anchor_exact"), "seat_phase": F.lit(0), "seat_place": F.col("pos"), "seat_feeder": F.lit(OTHER_WORKS), "may_repeat": F.lit(True),
        "notes": F.when(F.col("source_sha256").isNull(), "the source holds no such object").when(F.col("file").isNull(), "no line of the text tells its place"),
    })
    return shaped(rows.join(works.select("work_id", F.coalesce("url", "source_name").alias("source_file"), F.col("source_name").alias("containing_source"), "containing_source_sha256"), "work_id"))


def from_volumes(objects: DataFrame, lines: DataFrame, queue: DataFrame | None = None, feeder: int = VOLUME_OBJECTS) -> DataFrame:
    """Records of objects (work_id, folder, name, content) in the folders preview, original and crop of a volume, and of what its lines refer to.

    Names that differ in their extension alone are one object, called as its preview is. The original's hash tells the object, the
    preview ships; without either a crop of that name ships; else the record is of metadata only. queue: work_id, image, page.
    """
    sized = _sized(objects.select("work_id", "folder", "name", F.col("content").alias("data")), ["work_id", "folder", "name"])
    part = lambda folder, *columns: sized.where(F.col("folder") == folder).groupBy("work_id", _stem(F.col("name")).alias("stem")).agg(F.min_by(F.struct(*columns), "name").alias(folder))
    facts = ("name", "source_sha256", "media_bytes", "side")
    named = sites(references(lines))
    by_stem = named.groupBy("work_id", _stem(F.col("media_name")).alias("stem")).agg(F.min_by(F.struct("media_name", "file", "line_no", "section_id", "ref_count", "ref_sites"), "media_name").alias("site"))
    keys = sized.where("folder <> 'original'").select("work_id", _stem(F.col("name")).alias("stem")).unionByName(by_stem.select("work_id", "stem")).distinct()
    rows = keys.join(by_stem, ["work_id", "stem"], "left")
    for folder in ("preview", "original", "crop"):
        rows = rows.join(part(folder, *facts), ["work_id", "stem"], "left")
    shown = F.coalesce("preview", "crop")
    rows = rows.withColumns({
        "key": F.coalesce("preview.name", "site.media_name", "crop.name"), "file": F.col("site.file"), "line_no": F.col("site.line_no"), "section_id": F.col("site.section_id"),
        "ref_count": F.coalesce("site.ref_count", F.lit(0)), "ref_sites": F.col("site.ref_sites"), "shown": shown,
        "source_sha256": F.when(F.col("preview").isNotNull(), F.coalesce("original.source_sha256", "preview.source_sha256")).otherwise(F.col("crop.source_sha256")),
        "media_bytes": F.col("shown.media_bytes"), "referenced_in_text": F.col("site").isNotNull(),
    })
    rows = with_surroundings(rows, lines, ["work_id", "stem"]).withColumn("context_excerpt", F.nullif("surroundings", F.lit("")))
    if queue is not None:
        pages = queue.groupBy("work_id", F.col("image").alias("key")).agg(F.min("page").alias("source_page"))
        rows = rows.join(pages, ["work_id", "key"], "left")
    ext, made = _ext(F.coalesce("original.name", "key")), _ext(F.col("shown.name"))
    rows = judged(rows, ext, F.col("media_bytes"), F.col("shown.side"))
    # what a volume holds was extracted before: it ships as it is, whatever its kind
    status = F.when(F.col("shown").isNull(), "metadata_only_source").when(F.col("rights_status").isin("rights_review_required", "unknown"), "metadata_only_rights").otherwise("published")
    conversion = F.when(status == "published", F.when(F.col("preview").isNull(), "crop of a page").when(ext != made, F.concat(F.lit("preview of "), ext)).otherwise("verbatim_copy"))
    return shaped(rows.withColumns({
        "figure_id": text.object_id(F.col("work_id"), F.col("stem")), "publication_status": status, "conversion": conversion,
        "source_kind": F.when(F.col("preview").isNotNull(), "docx_embedded_preview").when(F.col("crop").isNotNull(), "pdf_page_crop").when(F.col("original").isNotNull(), "docx_embedded_preview").otherwise("missing_source"),
        "original_filename": F.coalesce("original.name", "key"), "media_file": F.col("preview.name"), "seat_feeder": F.lit(feeder), "seat_phase": F.lit(0), "seat_place": F.lit(0), "may_repeat": F.lit(True),
        "notes": F.when(F.col("shown").isNull(), "no such object in the volume").when(~F.col("referenced_in_text"), "no section refers to it"),
    }))


def from_ole(files: DataFrame, feeder: int = VOLUME_OBJECTS) -> DataFrame:
    """Records of files (work_id, path, content) that hold objects of other programs: none ships, since nothing tells where it belongs."""
    found = office.ole_objects(files).join(files.select("work_id", "path"), "path").withColumn("name", F.substring_index("path", "/", -1))
    return shaped(found.select(
        "work_id", text.object_id(F.col("work_id"), F.col("name")).alias("figure_id"), F.lit("ole_object").alias("source_kind"), "media_type", "rights_status", "publication_status", "source_sha256",
        F.col("name").alias("original_filename"), F.lit("unclear").alias("criticality"), F.lit(False).alias("referenced_in_text"), F.col("kind").alias("notes"),
        F.lit(feeder).alias("seat_feeder"), F.lit(1).alias("seat_phase"), F.lit(0).alias("seat_place"), F.lit(False).alias("may_repeat"),
    ))


def elect(records: DataFrame) -> DataFrame:
    """records of all feeders, with the first record of each object by SEAT as its canonical one.

    Later records of the bytes are duplicates of it, or, if they may not repeat, keep their status and name it. A duplicate of what
    does not ship is blocked by the status of that. Records without bytes are left as they are.
    """
    first = records.where("source_sha256 IS NOT NULL").groupBy("source_sha256").agg(F.min_by(F.struct(F.col("figure_id").alias("canonical"), F.col("publication_status").alias("status")), F.struct(*SEAT)).alias("_first"))
    rows = records.join(first, "source_sha256", "left")
    later = F.coalesce(F.col("_first.canonical") != F.col("figure_id"), F.lit(False))
    repeats = later & F.col("may_repeat")
    rows = rows.withColumn("duplicate_of", F.when(later, F.col("_first.canonical"))).withColumn("duplicate_blocked_by", F.when(repeats & (F.col("_first.status") != "published"), F.col("_first.status")))
    ships = F.when(repeats, F.when(F.col("_first.status") == "published", F.col("_first.canonical"))).when(F.col("publication_status") == "published", F.col("figure_id"))
    rows = rows.withColumn("asset_of", ships).withColumn("conversion", F.when(~repeats, F.col("conversion"))).withColumn("publication_status", F.when(repeats, "duplicate").otherwise(F.col("publication_status")))
    return rows.drop("_first", "seat_feeder", "seat_phase", "seat_place", "may_repeat")


def figure_registry(works: DataFrame, files: DataFrame, lines: DataFrame, volume_objects: DataFrame | None = None, ole: DataFrame | None = None, queue: DataFrame | None = None) -> DataFrame:
    """The registry of all feeders. works: as resolve_sources() gives them, with url; files: path and content of sources.

    volume_objects: as from_volumes() takes them; the works in them are volumes, whose lines bind the objects of their folders.
    """
    parts = []
    others, own_lines = works, lines
    if volume_objects is not None:
        ids = volume_objects.select("work_id").distinct()
        others, own_lines = works.join(ids, "work_id", "left_anti"), lines.join(ids, "work_id", "left_anti")
        parts.append(from_volumes(volume_objects, lines.join(ids, "work_id", "left_semi"), queue))
    if ole is not None:
        parts.append(from_ole(ole))
    fb2 = F.coalesce(F.col("source_kind") == "fb2", F.lit(False))
    parts += [from_documents(others.where(~fb2), files, own_lines), from_fb2(others.where(fb2), files, own_lines)]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return elect(rows)


def resolve_sources(works: DataFrame, converted: DataFrame, classified: DataFrame, files: DataFrame, prefix: str = fixed.SOURCE_PREFIX, folders: dict[str, str] = fixed.SOURCE_FOLDERS) -> DataFrame:
    """works (work_id, sha256_source, source_name) with level, source_kind and source_path of the file that holds their source.

    converted (line_no, sha256, id): a hash that a conversion log knows leads to that conversion, whether its file is there or not.
    classified (line_no, sha256, file, ext): else one that the other log knows leads to a file name, whose conversion is taken if
    it is among files (path), and the file itself if not. A name with the prefix leads to its repaired conversion, else to the file
    of that name, if either is there. The last line of a log counts.
    """
    one = converted.groupBy(F.col("sha256").alias("sha256_source")).agg(F.max_by("id", "line_no").alias("_id"))
    two = classified.groupBy(F.col("sha256").alias("sha256_source")).agg(F.max_by(F.struct("file", "ext"), "line_no").alias("_c"))
    rows = works.join(one, "sha256_source", "left").join(two, "sha256_source", "left")
    stem = lambda c: F.regexp_replace(c, r"\.[^.]*$", "")
    base = F.when(F.col("source_name").startswith(prefix), F.substring(F.col("source_name"), len(prefix) + 1, 1 << 30))
    at = lambda folder, name: F.concat(F.lit(folders[folder] + "/"), name)
    tried = {
        "_log": at("converted", F.concat(F.col("_id"), F.lit(".docx"))), "_made": at("classified_docx", F.concat(stem(F.col("_c.file")), F.lit(".docx"))), "_file": at("originals", F.col("_c.file")),
        "_mended": at("repaired", F.concat(stem(base), F.lit(".docx"))), "_named": at("originals", base),
    }
    rows = rows.withColumns(tried)
    there = files.select("path").distinct()
    for c in ("_made", "_mended", "_named"):
        rows = rows.join(there.select(F.col("path").alias(c), F.lit(True).alias(f"{c}_is")), c, "left")
    chain = [
        (F.col("_id").isNotNull(), "conversion log", F.lit("docx"), "_log"), (F.col("_c").isNotNull() & F.col("_made_is"), "classified log, converted", F.lit("docx"), "_made"),
        (F.col("_c").isNotNull(), "classified log, as found", F.col("_c.ext"), "_file"), (F.col("_mended_is"), "name, repaired", F.lit("docx"), "_mended"),
        (F.col("_named_is"), "name, as found", F.lower(F.regexp_extract("_named", r"\.([^.]*)$", 1)), "_named"),
    ]
    found = F.lit(None)
    for condition, level, kind, path in reversed(chain):
        found = F.when(F.coalesce(condition, F.lit(False)), F.struct(F.lit(level).alias("level"), kind.alias("source_kind"), F.col(path).alias("source_path"))).otherwise(found)
    return rows.select(*works.columns, found.alias("_found")).select(*works.columns, "_found.level", "_found.source_kind", "_found.source_path")

