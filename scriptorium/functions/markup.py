"""HTML to Markdown and back, as far as a library needs it, with built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ENTITIES = [("&nbsp;", " "), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&laquo;", "«"), ("&raquo;", "»"), ("&mdash;", "—"), ("&ndash;", "–"), ("&hellip;", "…"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]


def decode_entities(x: Column) -> Column:
    """The common named references; &amp; last, so that nothing is decoded twice. functions.text.unescape knows all."""
    for a, b in ENTITIES:
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def article(html: Column) -> Column:
    """What is inside the first article element, or else all."""
    found = F.regexp_extract(html, r"(?is)<article[^>]*>(.*?)</article>", 1)
    return F.when(found != "", found).otherwise(html)


def html_to_markdown(html: Column) -> Column:
    """Headings of four levels, paragraphs, line breaks and list items as Markdown; scripts, styles, asides, navigation, headers and footers dropped."""
    x = article(html)
    for tag in ("script", "style", "aside", "nav", "footer", "header"):
        x = F.regexp_replace(x, rf"(?is)<{tag}\b[^>]*>.*?</{tag}>", "")
    for level in range(1, 5):
        x = F.regexp_replace(x, rf"(?is)<h{level}\b[^>]*>(.*?)</h{level}>", "\n\n" + "#" * level + " $1\n\n")
    x = F.regexp_replace(x, r"(?i)<br\s*/?>", "\n")
    x = F.regexp_replace(x, r"(?i)</p>", "\n\n")
    x = F.regexp_replace(x, r"(?i)<li\b[^>]*>", "\n- ")
    x = F.regexp_replace(x, r"<[^>]+>", "")
    x = decode_entities(x)
    x = F.regexp_replace(x, r"[ \t]+\n", "\n")
    return F.regexp_replace(F.regexp_replace(x, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")
