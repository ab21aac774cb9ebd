"""Text functions, Column to Column. Letters and digits are Unicode's throughout."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixed

NOT_WORD = r"[^\p{L}\p{N}_]+"
SPACES = r"[\s\p{Z}\x{1c}-\x{1f}\x{85}]+"


def norm_search(x: Column) -> Column:
    """Lower case, yo as ye, no soft hyphens, every run of other than letters, digits and _ one space; not trimmed."""
    folded = F.translate(F.lower(F.coalesce(x, F.lit(""))), "ё­", "е")
    return F.regexp_replace(folded, NOT_WORD, " ")


@F.pandas_udf(T.StringType())
def fold_letters(texts: pd.Series) -> pd.Series:
    """NFKC, case folded, yo as ye, letters and digits only."""
    return texts.map(lambda t: None if t is None else "".join(c for c in unicodedata.normalize("NFKC", t).casefold().replace("ё", "е") if c.isalpha() or c.isdigit()))


@F.pandas_udf(T.StringType())
def fold_alnum(texts: pd.Series) -> pd.Series:
    """As fold_letters, but every alphanumeric character stays."""
    return texts.map(lambda t: None if t is None else "".join(filter(str.isalnum, unicodedata.normalize("NFKC", t).casefold().replace("ё", "е"))))


@F.pandas_udf(T.StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Compatibility composition, for which Spark has no function."""
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def squeeze(x: Column) -> Column:
    """Without markup characters and soft hyphens, white space runs one space, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(x, "[#>*`_~­]", ""), SPACES, " "))


def plain(x: Column) -> Column:
    """Without footnote marks, link targets, tags and emphasis."""
    for pattern in (r"\[\^[0-9]+\]", r"\]\([^)]+\)", r"<[^>]+>", r"[*_`#]+"):
        x = F.regexp_replace(x, pattern, "")
    return F.regexp_replace(x, rf"^{SPACES}|{SPACES}$", "")


def detag(x: Column) -> Column:
    """As plain, with the words of links kept and images dropped."""
    for pattern, by in ((r"!\[[^\]]*\]\([^)]*\)", ""), (r"\[\^[0-9]+\]", ""), (r"\[([^\]]*)\]\([^)]*\)", "$1"), (r"<[^>]+>", ""), (r"[*_`#]+", "")):
        x = F.regexp_replace(x, pattern, by)
    return F.regexp_replace(x, rf"^{SPACES}|{SPACES}$", "")


def strip_front_matter(x: Column) -> Column:
    return F.regexp_replace(x, r"(?s)\A---\s*\n.*?\n---\s*\n", "")


def front_matter(x: Column, key: str) -> Column:
    """A key of the leading block, unquoted; null if absent."""
    block = F.regexp_extract(x, r"(?s)\A---\s*\n(.*?)\n---\s*\n", 1)
    value = F.regexp_extract(block, rf"(?m)^{key}:[ \t]*(.*)$", 1)
    return F.nullif(F.regexp_replace(F.trim(value), r"^([\"'])(.*)\1$", "$2"), F.lit(""))


def media_marks(x: Column) -> Column:
    """Both forms of image as IMG[file name]."""
    for pattern in (r'(?i)<img\b[^>]*?\bsrc="(?:[^"]*/)?([^"/]*)"[^>]*>', r"!\[[^\]]*\]\((?:[^)]*/)?([^)/]*)\)(?:\{[^}]*\})?"):
        x = F.regexp_replace(x, pattern, "IMG[$1]")
    return x


def soft_hyphens(x: Column) -> Column:
    return F.replace(x, F.lit("­"), F.lit(""))


def tidy_title(x: Column) -> Column:
    """Without images; where one was, white space is squeezed and a trailing slash goes."""
    cleaned = F.regexp_replace(F.trim(F.regexp_replace(F.regexp_replace(x, r"(?i)<img\b[^>]*>", " "), SPACES, " ")), r"\s*/$", "")
    return F.when(x.rlike(r"(?i)<img\b"), cleaned).otherwise(x)


def slug(url: Column) -> Column:
    """The last segment of a url, NFKC, in lower case, other than word characters, dots and hyphens as _, 60 characters at most."""
    last = F.element_at(F.split(F.rtrim(url, F.lit("/")), "/"), -1)
    name = F.substring(F.regexp_replace(F.when(last.rlike(r"[^\x00-\x7f]"), nfkc(last)).otherwise(F.coalesce(last, F.lit(""))), r"[^\p{L}\p{N}_.-]+", "_"), 1, 60)
    return F.lower(F.when(name == "", "item").otherwise(name))


def object_id(work: Column, name: Column, unbound: Column | None = None) -> Column:
    stem = F.regexp_replace(F.regexp_replace(name, r"\.[A-Za-z0-9]+$", ""), r"[^0-9A-Za-zА-Яа-яёЁ_\-]+", "_")
    stem = F.regexp_replace(stem, r"^_+|_+$", "")
    mark = F.when(unbound, "unbound-").otherwise("") if unbound is not None else F.lit("")
    return F.concat(work, F.lit("--"), mark, F.when(stem == "", "obj").otherwise(stem))


def escape_html(x: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def escape_cell(x: Column) -> Column:
    """For a cell of a Markdown table."""
    return F.replace(F.replace(x, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))


def html_links(x: Column) -> Column:
    """Links to .md files lead to .html."""
    return F.regexp_replace(x, r"(\]\()([^)\s#]+)\.md(?=[)#])", "$1$2.html")


def redact(x: Column) -> Column:
    return F.regexp_replace(x, r"(?U)" + fixed.EMAIL, "[email]")


def mask(x: Column, literal: str, by: str) -> Column:
    return F.replace(x, F.lit(literal), F.lit(by))


def occurrences(x: Column, literal: str) -> Column:
    return ((F.length(x) - F.length(F.replace(x, F.lit(literal), F.lit("")))) / len(literal)).cast("int")


def alt_text(x: Column, default: str) -> Column:
    cleaned = F.substring(F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(x, F.lit("")), r"[\[\]]", ""), SPACES, " ")), 1, 120)
    return F.when(cleaned == "", default).otherwise(cleaned)


def year(date: Column, given: Column, unknown: str = "н/д") -> Column:
    return F.coalesce(F.nullif(F.substring(date, 1, 4), F.lit("")), F.nullif(given, F.lit("")), F.lit(unknown))


def word_chars(x: Column) -> Column:
    """How many letters, digits and _ there are."""
    return F.length(F.regexp_replace(F.coalesce(x, F.lit("")), r"[^\p{L}\p{N}_]", ""))


def title_of(x: Column) -> Column:
    """The first line."""
    return F.substring_index(F.coalesce(x, F.lit("")), "\n", 1)


def with_title(body: Column, title: Column) -> Column:
    """A first heading, if the text has none."""
    return F.when(body.rlike(r"(?m)^#{1,6}\s"), body).otherwise(F.concat(F.lit("# "), title, F.lit("\n\n"), body))


@F.pandas_udf(T.StringType())
def unescape(texts: pd.Series) -> pd.Series:
    """Character references of HTML decoded."""
    import html

    return texts.map(lambda t: None if t is None else html.unescape(t))
