"""Paths inside a library: links resolved, made relative, and named by kind."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_decode(x: Column) -> Column:
    """%XX decoded as UTF-8; + stays, and what cannot be decoded stays whole."""
    return F.coalesce(F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B"))), x)


def is_remote(target: Column) -> Column:
    return target.rlike(r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://|#|mailto:|data:|//)") | target.contains("://")


def is_local_file(target: Column) -> Column:
    """A link to the writer's own machine."""
    return percent_decode(target).rlike(r"^(?i:file:)|^[A-Za-z]:[\\/]")


def _steps(base: Column, target: Column) -> Column:
    clean = percent_decode(F.regexp_replace(target, r"[#?].*$", ""))
    whole = F.when(clean.startswith("/"), clean).otherwise(F.concat(F.regexp_replace(base, r"[^/]*$", ""), clean))
    return F.filter(F.split(whole, "/"), lambda s: (s != "") & (s != "."))


def resolve(base: Column, target: Column) -> Column:
    """target as seen from the file base; .. beyond the root is ignored."""
    up = lambda acc, s: F.when(s != "..", F.concat(acc, F.array(s))).when(F.size(acc) > 0, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc)
    return F.array_join(F.aggregate(_steps(base, target), F.array().cast("array<string>"), up), "/")


def resolve_strict(base: Column, target: Column) -> Column:
    """As resolve, but null where .. leads beyond the root."""
    depth = lambda acc, s: F.struct((acc["d"] + F.when(s == "..", -1).otherwise(1)).alias("d"), F.least(acc["low"], acc["d"] + F.when(s == "..", -1).otherwise(1)).alias("low"))
    low = F.aggregate(_steps(base, target), F.struct(F.lit(0).alias("d"), F.lit(0).alias("low")), depth)["low"]
    return F.when(low >= 0, resolve(base, target))


def relative(file: Column, to: Column) -> Column:
    """to as a link from file, both from the root."""
    a, b = F.split(F.regexp_replace(file, r"/?[^/]*$", ""), "/"), F.split(to, "/")
    a = F.filter(a, lambda s: s != "")
    n = F.size(F.filter(F.sequence(F.lit(0), F.least(F.size(a), F.size(b) - 1)), lambda i: (i > 0) & (F.slice(a, F.lit(1), i) == F.slice(b, F.lit(1), i))))
    return F.concat(F.repeat(F.lit("../"), F.size(a) - n), F.array_join(F.slice(b, n + 1, F.size(b)), "/"))


def html_path(path: Column) -> Column:
    return F.regexp_replace(path, r"\.[^./]*$", ".html")


def unit_path(kind: Column, name: Column) -> Column:
    """Where a unit of a kind is kept."""
    folder = F.when(kind == "chapter", "chapters").when(kind == "appendix", "appendices").when(kind == "section", "sections").when(kind == "subsection", "subsections")
    fixed = F.when(kind == "original_toc", "original-toc.md").when(kind == "preface", "preface.md").otherwise("frontmatter.md")
    return F.coalesce(F.concat(folder, F.lit("/"), name, F.lit(".md")), fixed)


def root_prefix(path: Column) -> Column:
    return F.repeat(F.lit("../"), F.size(F.split(path, "/")) - 1)


def first_page(candidate: Column, start: Column) -> Column:
    """The page of a section, of either schema; 0 is none."""
    return F.coalesce(F.nullif(candidate, F.lit(0)), F.nullif(start, F.lit(0)))
