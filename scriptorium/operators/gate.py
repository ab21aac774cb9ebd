"""The release gate: it lets through only what every rule allows. Reasons block, notes do not."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .semantic import finding, together

BASE_FLAGS = ["editorial_text_review", "doc_pdf_edition_check", "jurisdiction_distribution_review", "human_final_approval"]
MEDIA_FLAGS = ["illustrations_and_ole_review"]
ART_FLAG = "rights_and_third_party_art_review"


def scope(approval: DataFrame) -> DataFrame:
    """approval with scope_media and scope_pdfs, the most that is declared in due form; anything else counts as everything."""
    media = F.when(F.col("release_scope.media").isin("none", "reviewed", "all"), F.col("release_scope.media")).otherwise("all")
    pdfs = F.when(F.col("release_scope.pdfs").isin("link", "ship"), F.col("release_scope.pdfs")).otherwise("ship")
    return approval.withColumns({"scope_media": media, "scope_pdfs": pdfs})


def scope_findings(approval: DataFrame) -> DataFrame:
    shaped = approval.where("release_scope IS NOT NULL")
    return together(
        [
            finding(approval.where("release_scope IS NULL"), "scope_missing", F.lit("release_scope"), ""),
            finding(shaped.where("coalesce(release_scope.media, '') NOT IN ('none', 'reviewed', 'all')"), "bad_scope_media", F.lit("release_scope"), F.col("release_scope.media")),
            finding(shaped.where("coalesce(release_scope.pdfs, '') NOT IN ('link', 'ship')"), "bad_scope_pdfs", F.lit("release_scope"), F.col("release_scope.pdfs")),
            finding(shaped.where("coalesce(size(release_scope.volumes), 0) < 1"), "no_volumes", F.lit("release_scope"), ""),
            finding(shaped.where("release_scope.pdfs = 'link' AND NOT coalesce(release_scope.canonical_pdf_url, '') RLIKE '^https://[^ ]+$'"), "bad_pdf_url", F.lit("release_scope"), F.col("release_scope.canonical_pdf_url")),
        ]
    )


def flag_findings(approval: DataFrame) -> DataFrame:
    """Flags that the scope asks for and that are not literally true."""
    rows = scope(approval)
    asked = F.array_compact(F.array(*map(F.lit, BASE_FLAGS), *[F.when(F.col("scope_media") != "none", F.lit(f)) for f in MEDIA_FLAGS], F.when((F.col("scope_media") != "none") | (F.col("scope_pdfs") == "ship"), F.lit(ART_FLAG))))
    given = F.create_map(*[x for f in [*BASE_FLAGS, *MEDIA_FLAGS, ART_FLAG] for x in (F.lit(f), F.coalesce(F.col(f), F.lit(False)))])
    lacking = rows.select(F.explode(F.filter(asked, lambda f: ~given[f])).alias("flag"))
    return finding(lacking, "not_approved", F.col("flag"), F.col("flag"))


def pin_findings(pins: DataFrame, files: DataFrame) -> DataFrame:
    """Pins (volume, name, sha256) against files (volume, name, sha256): missing, changed, unpinned."""
    both = pins.withColumnRenamed("sha256", "pinned").join(files.withColumnRenamed("sha256", "found"), ["volume", "name"], "full_outer")
    rule = F.when(F.col("found").isNull(), "source_missing").when(F.col("pinned").isNull(), "source_unpinned").when(F.col("found") != F.col("pinned"), "source_changed")
    rows = both.withColumn("_rule", rule).where("_rule IS NOT NULL")
    return rows.select(F.lit("block").alias("severity"), F.col("_rule").alias("rule"), F.concat_ws("/", F.col("volume").cast("string"), "name").alias("entity_key"), F.coalesce("found", "pinned").alias("detail"))


def allowlist_findings(allowed: DataFrame, shipped: DataFrame) -> DataFrame:
    """allowed (path, sha256, decision) against shipped (path, sha256), both ways."""
    approved = allowed.where("decision = 'approved'")
    both = approved.select("path", F.col("sha256").alias("_allowed")).join(shipped.select("path", F.col("sha256").alias("_shipped")), "path", "full_outer")
    rule = F.when(F.col("_shipped").isNull(), "allowed_file_missing").when(F.col("_allowed").isNull(), "file_not_allowed").when(F.col("_allowed") != F.col("_shipped"), "file_changed")
    rows = both.withColumn("_rule", rule).where("_rule IS NOT NULL").select(F.lit("block").alias("severity"), F.col("_rule").alias("rule"), F.col("path").alias("entity_key"), F.coalesce("_shipped", "_allowed").alias("detail"))
    outside = finding(approved.where("NOT startswith(path, 'assets/media/') OR contains(path, '..')"), "path_outside_media", F.col("path"), F.col("path"))
    return together([rows, outside, finding(allowed.groupBy("path").count().where("count > 1"), "allowed_twice", F.col("path"), F.col("count"))])


def verified_bytes_findings(verified: DataFrame, files: DataFrame) -> DataFrame:
    """Verified media rows (id, path, sha256) whose bytes on disk (path, sha256) are gone or changed."""
    rows = verified.join(files.select("path", F.col("sha256").alias("_found")), "path", "left")
    return finding(rows.where("_found IS NULL"), "verified_file_missing", F.col("id"), F.col("path")).unionByName(finding(rows.where("_found <> sha256"), "verified_file_changed", F.col("id"), F.col("path")))


def queue_findings(media: DataFrame, volumes: DataFrame, objects: DataFrame, approval: DataFrame) -> DataFrame:
    """Review queues against what volumes hold; without media in scope they are notes.

    media: volume, image, human_review_status, manual_decision; objects: volume, saved_as, human_review_status;
    volumes: volume, omitted_media, not_placed (array), ole_objects.
    """
    settled = media.where("human_review_status = 'verified' OR coalesce(manual_decision, '') <> ''")
    listed = volumes.select("volume", F.explode("not_placed").alias("image"))
    open_media = listed.join(settled, ["volume", "image"], "left_anti")
    lacking = volumes.where("omitted_media > 0 AND coalesce(size(not_placed), 0) < omitted_media")
    verified = objects.where("human_review_status = 'verified'").select("volume", "saved_as").distinct().groupBy("volume").agg(F.count(F.lit(1)).alias("_done"))
    ole = volumes.join(verified, "volume", "left").where("ole_objects > coalesce(_done, 0)")
    found = together([finding(open_media, "media_pending", F.col("volume"), F.col("image")), finding(lacking, "media_not_listed", F.col("volume"), F.col("omitted_media")), finding(ole, "ole_pending", F.col("volume"), F.col("ole_objects"))])
    none = scope(approval).select((F.col("scope_media") == "none").alias("_none"))
    return found.join(F.broadcast(none)).withColumn("severity", F.when(F.col("_none"), "note").otherwise(F.col("severity"))).drop("_none")


def verdict(findings: DataFrame) -> DataFrame:
    """ok, n_reasons and n_notes: one row."""
    return findings.agg(F.count_if(F.col("severity") == "block").alias("n_reasons"), F.count_if(F.col("severity") == "note").alias("n_notes")).select((F.col("n_reasons") == 0).alias("ok"), "n_reasons", "n_notes")


def dry_run(gate_findings: DataFrame, scan_findings: DataFrame) -> DataFrame:
    """FORBIDDEN if the scan found something, BLOCKED if the gate did, else READY."""
    a, b = gate_findings.agg(F.count_if(F.col("severity") == "block").alias("g")), scan_findings.agg(F.count(F.lit(1)).alias("s"))
    return a.join(b).select(F.when(F.col("s") > 0, "FORBIDDEN").when(F.col("g") > 0, "BLOCKED").otherwise("READY").alias("verdict"))


def queue_totals(queue: DataFrame) -> DataFrame:
    """volume, n_items, n_verified and n_pending."""
    return queue.groupBy("volume").agg(F.count(F.lit(1)).alias("n_items"), F.count_if(F.col("human_review_status") == "verified").alias("n_verified"), F.count_if(~F.col("human_review_status").eqNullSafe(F.lit("verified"))).alias("n_pending"))
