"""What leaves the library: links settled, pages rendered, indexes and linked data written out as strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import paths, text
from . import audit


def neutralise_links(docs: DataFrame, files: DataFrame, path: str = "path", body: str = "text") -> DataFrame:
    """docs with links that lead nowhere, or to the writer's machine, reduced to their label; kept and neutralised count them.

    The decision is one join for all links; each text is rewritten by the map of its own dead targets.
    """
    links = audit.markdown_links(docs, path, body).withColumn("resolved", paths.resolve_strict(F.col(path), F.col("target")))
    remote = paths.is_remote(F.col("target")) & ~paths.is_local_file(F.col("target"))
    known = files.select(F.col("path").alias("_known"), F.lit(True).alias("_there"))
    judged = links.join(known, F.col("resolved") == F.col("_known"), "left").withColumn("live", remote | F.coalesce("_there", F.lit(False)))
    by = judged.groupBy(path).agg(F.collect_set(F.when(~F.col("live"), F.struct("label", "target"))).alias("_dead"), F.count_if("live").alias("kept"), F.count_if(~F.col("live")).alias("neutralised"))
    rows = docs.join(by, path, "left")
    # an image of the same label and target is no link
    quoted = lambda c: F.concat(F.lit(r"\Q"), F.replace(c, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    link = lambda d: F.concat(F.lit(r"(?<!!)\["), quoted(d["label"]), F.lit(r"\]\("), quoted(d["target"]), F.lit(r"\)"))
    bare = lambda d: F.regexp_replace(d["label"], r"([\\$])", r"\\$1")
    rewritten = F.aggregate(F.coalesce("_dead", F.array().cast("array<struct<label:string,target:string>>")), F.col(body), lambda acc, d: F.regexp_replace(acc, link(d), bare(d)))
    return rows.withColumn(body, rewritten).withColumn("kept", F.coalesce("kept", F.lit(0))).withColumn("neutralised", F.coalesce("neutralised", F.lit(0))).drop("_dead")


def omit_images(docs: DataFrame, shipped: DataFrame, marker: str, key: str = "path", body: str = "text") -> DataFrame:
    """docs with images whose file is not shipped (key, name) replaced by a marker."""
    names = shipped.groupBy(key).agg(F.collect_set("name").alias("_names"))
    rows = docs.join(names, key, "left").withColumn("_names", F.coalesce("_names", F.array().cast("array<string>")))
    every = F.array_distinct(F.regexp_extract_all(body, F.lit(r"!\[[^\]]*\]\([^)]*\)"), 0))
    gone = F.filter(every, lambda i: ~F.array_contains(F.col("_names"), F.regexp_extract(i, r"([^/()]+)\)$", 1)))
    return rows.withColumns({body: F.aggregate(gone, F.col(body), lambda acc, i: F.replace(acc, i, F.lit(marker))), "omitted": F.size(gone)}).drop("_names")


def navigation_line(previous: Column, following: Column) -> Column:
    """Links to either neighbour, of those there are."""
    link = lambda label, to: F.when(to.isNotNull(), F.concat(F.lit(f"[{label}]("), to, F.lit(")")))
    return F.concat_ws(" | ", link("previous", previous), link("next", following))


def page(title: Column, body: Column, prefix: Column, canonical: Column, description: Column) -> Column:
    """A whole HTML page; title and description are escaped, body is not."""
    return F.concat(
        F.lit('<!DOCTYPE html><html><head><meta charset="utf-8"><title>'), text.escape_html(title), F.lit('</title><meta name="description" content="'), text.escape_html(description), F.lit('"><link rel="canonical" href="'), canonical,
        F.lit('"><link rel="stylesheet" href="'), prefix, F.lit('assets/site.css"></head><body><main><h1>'), text.escape_html(title), F.lit("</h1>"), body, F.lit("</main></body></html>"),
    )


def breadcrumb(items: Column, base: str) -> Column:
    """JSON-LD of array<struct<name, path>>, positions from 1."""
    element = lambda x, i: F.struct(F.lit("ListItem").alias("@type"), (i + 1).alias("position"), x["name"].alias("name"), F.concat(F.lit(base), x["path"]).alias("item"))
    return F.to_json(F.struct(F.lit("https://schema.org").alias("@context"), F.lit("BreadcrumbList").alias("@type"), F.transform(items, element).alias("itemListElement")))


def linked_data(kind: str, **fields: Column) -> Column:
    """JSON-LD of one thing; null fields are left out."""
    return F.to_json(F.struct(F.lit("https://schema.org").alias("@context"), F.lit(kind).alias("@type"), *[v.alias(k) for k, v in fields.items()]))


def data_catalog(files: DataFrame, title: str, base: str) -> DataFrame:
    """One row: a DCAT catalogue of files (path, bytes, sha256)."""
    entry = F.struct(F.lit("dcat:Distribution").alias("@type"), F.concat(F.lit(base), "path").alias("dcat:downloadURL"), F.col("bytes").alias("dcat:byteSize"), F.col("sha256").alias("spdx:checksum"), F.col("path").alias("dct:title"))
    return files.agg(F.array_sort(F.collect_list(entry), lambda a, b: F.when(a["dct:title"] < b["dct:title"], -1).when(a["dct:title"] > b["dct:title"], 1).otherwise(0)).alias("e")).select(
        F.to_json(F.struct(F.lit("http://www.w3.org/ns/dcat#").alias("@context"), F.lit("dcat:Dataset").alias("@type"), F.lit(title).alias("dct:title"), F.col("e").alias("dcat:distribution"))).alias("json")
    )


def sitemap(urls: DataFrame, url: str = "url") -> DataFrame:
    """One row: a sitemap of urls in order."""
    entries = F.transform(F.array_sort(F.collect_set(url)), lambda u: F.concat(F.lit("<url><loc>"), text.escape_html(u), F.lit("</loc></url>")))
    return urls.agg(F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), F.array_join(entries, ""), F.lit("</urlset>")).alias("xml"))


def table_of_contents(sections: DataFrame, work: str = "work_id") -> DataFrame:
    """work_id and a Markdown list of its sections (reading_order, title, path) in order."""
    item = F.struct("reading_order", F.concat(F.lit("- ["), text.escape_cell(F.col("title")), F.lit("]("), "path", F.lit(")")).alias("line"))
    return sections.groupBy(work).agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["line"]), "\n").alias("markdown"))


def front_matter(**fields: Column) -> Column:
    """A leading block of keys; null ones are left out."""
    rows = [F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), v.cast("string"))) for k, v in fields.items()]
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *rows), F.lit("\n---\n"))


def robots(mode: str, base: str = "") -> str:
    """robots.txt: a public site names its sitemap, any other keeps crawlers out."""
    if mode == "public":
        return f"User-agent: *\nAllow: /\nSitemap: {base.rstrip('/')}/sitemap.xml\n"
    return "User-agent: *\nDisallow: /\n"


def llms_text(title: str, note: str, entries: list[tuple[str, str]]) -> str:
    """llms.txt: title, note and what stands where, by links relative to the site."""
    return f"# {title}\n\n{note}\n\n" + "".join(f"- {path} — {what}\n" for path, what in entries)


def sitemap_lines(urls: DataFrame, url: str = "url") -> DataFrame:
    """value: an entry for each distinct url, in order, to be written as lines of sitemaps of any number of urls."""
    return urls.select(F.concat(F.lit("<url><loc>"), text.escape_html(F.col(url)), F.lit("</loc></url>")).alias("value")).distinct().orderBy("value")
