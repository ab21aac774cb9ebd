"""Markdown to HTML: headings, paragraphs, emphasis, code, links, images, lists, quotes, tables, strikethrough and footnotes; raw HTML is escaped."""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPANS = [
    (re.compile(r"!\[([^\]]*)\]\(([^)\s]+)\)"), r'<img src="\2" alt="\1">'),
    (re.compile(r"\[([^\]]+)\]\(([^)\s]+)\)"), r'<a href="\2">\1</a>'),
    (re.compile(r"(?<![\"\w/>])(https?://[^\s<]+[^\s<.,;:)])"), r'<a href="\1">\1</a>'),
    (re.compile(r"\*\*(.+?)\*\*"), r"<strong>\1</strong>"),
    (re.compile(r"\*(.+?)\*"), r"<em>\1</em>"),
    (re.compile(r"~~(.+?)~~"), r"<del>\1</del>"),
    (re.compile(r"\[\^(\w+)\]"), r'<sup id="fnref-\1"><a href="#fn-\1">\1</a></sup>'),
]


def _spans(line: str) -> str:
    out = []
    for i, part in enumerate(re.split(r"`([^`]+)`", line)):
        part = html.escape(part, quote=False)
        if i % 2:
            out.append(f"<code>{part}</code>")
            continue
        for pattern, by in _SPANS:
            part = pattern.sub(by, part)
        out.append(part)
    return "".join(out)


def _cells(row: str, tag: str) -> str:
    return "<tr>" + "".join(f"<{tag}>{_spans(c.strip())}</{tag}>" for c in re.split(r"(?<!\\)\|", row.strip().strip("|"))) + "</tr>"


def to_html(source: str) -> str:
    """One document."""
    notes = re.findall(r"(?ms)^\[\^(\w+)\]:[ \t]*(.*?)(?=^\[\^\w+\]:|^\S|\Z)", source)
    body = re.sub(r"(?ms)^\[\^\w+\]:.*?(?=^\[\^\w+\]:|^\S|\Z)", "", source)
    out = []
    for block in re.split(r"\n\s*\n", body.strip("\n")):
        lines = [x for x in block.split("\n") if x.strip()]
        if not lines:
            continue
        if m := re.match(r"(#{1,6})\s+(.*)", lines[0]):
            out.append(f"<h{len(m[1])}>{_spans(m[2].rstrip('# '))}</h{len(m[1])}>")
            lines = lines[1:]
            if not lines:
                continue
        if len(lines) > 1 and "|" in lines[0] and re.fullmatch(r"[\s|:-]+", lines[1]):
            out.append("<table>" + _cells(lines[0], "th") + "".join(_cells(x, "td") for x in lines[2:]) + "</table>")
        elif all(re.match(r"[-*+]\s", x) for x in lines):
            out.append("<ul>" + "".join(f"<li>{_spans(x[2:].strip())}</li>" for x in lines) + "</ul>")
        elif all(re.match(r"\d+\.\s", x) for x in lines):
            out.append("<ol>" + "".join(f"<li>{_spans(x.partition('.')[2].strip())}</li>" for x in lines) + "</ol>")
        elif all(x.startswith(">") for x in lines):
            out.append("<blockquote><p>" + "\n".join(_spans(x[1:].strip()) for x in lines) + "</p></blockquote>")
        else:
            out.append("<p>" + "\n".join(map(_spans, lines)) + "</p>")
    if notes:
        out.append('<section class="footnotes"><ol>' + "".join(f'<li id="fn-{n}">{_spans(" ".join(t.split()))} <a href="#fnref-{n}">↩</a></li>' for n, t in notes) + "</ol></section>")
    return "\n".join(out)


@F.pandas_udf(T.StringType())
def markdown_to_html(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else to_html(t))
