"""Cascades that classify media records. Each takes its keyword lists as parameters; the defaults are the fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def _has(x: Column, pattern: str) -> Column:
    return F.coalesce(x, F.lit("")).rlike("(?iuU)" + pattern)


def _first(cases: list[tuple[Column, Column | str]], other) -> Column:
    chain = F.when(F.coalesce(cases[0][0], F.lit(False)), cases[0][1])
    for condition, value in cases[1:]:
        chain = chain.when(F.coalesce(condition, F.lit(False)), value)
    return chain.otherwise(other)


def media_type(caption: Column, ext: Column, keywords=fixed.MEDIA_KEYWORDS, vector=fixed.VECTOR) -> Column:
    low = F.lower(F.coalesce(caption, F.lit("")))
    return _first([*[(low.contains(word), F.lit(kind)) for word, kind in keywords], (ext.isin(vector), F.lit("scheme"))], F.lit("other"))


def rights(kind: Column, caption: Column, context: Column, ext: Column, label: Column, third_party=fixed.THIRD_PARTY, label_pattern=fixed.LABEL) -> Column:
    around = F.concat_ws(" ", F.coalesce(caption, F.lit("")), F.coalesce(context, F.lit("")))
    return _first(
        [
            (_has(around, third_party) | kind.isin("photo", "reproduction", "map", "cover"), F.lit("rights_review_required")),
            (ext.isin(fixed.VECTOR) | kind.isin("scheme", "diagram", "chart", "table_image"), F.lit("authorial")),
            (_has(label, label_pattern), F.lit("authorial")),
        ],
        F.lit("unknown"),
    )


def criticality(kind: Column, ext: Column, label: Column, size: Column, longest_side: Column) -> Column:
    tiny = (size < 2048) | F.coalesce(longest_side <= 64, F.lit(False))
    return _first(
        [
            (tiny | (kind == "decorative"), F.lit("decorative")),
            (ext.isin(fixed.VECTOR) | kind.isin("scheme", "diagram", "chart"), F.lit("critical_for_understanding")),
            ((F.coalesce(label, F.lit("")) != "") | kind.isin("map", "reproduction", "photo"), F.lit("useful")),
        ],
        F.lit("unclear"),
    )


def provenance(kind: Column, caption: Column, label: Column, context: Column, ext: Column, p=fixed) -> Column:
    """struct(class, evidence): signals of third parties before those of the author. p names the patterns."""
    around = F.concat_ws(" ", F.coalesce(caption, F.lit("")), F.coalesce(context, F.lit("")))
    around = F.regexp_replace(F.regexp_replace(around, r"!\[[^\]]*\]\([^)]*\)", " "), r"<[^>]+>", " ")
    label = F.coalesce(label, F.lit(""))
    made = lambda name, *why: F.struct(F.lit(name).alias("class"), F.array(F.concat(*[F.lit(w) if isinstance(w, str) else w for w in why])).alias("evidence"))
    return _first(
        [
            (_has(around, p.COVER) | (kind == "cover"), made("cover_or_external_art", fixed.COVER_EVIDENCE)),
            (_has(around, p.SCREENSHOT) | (kind == "scan_fragment"), made("screenshot_or_document_scan", fixed.SCREENSHOT_EVIDENCE)),
            (_has(around, p.PHOTO) | (kind == "photo"), made("third_party_photo", fixed.PHOTO_EVIDENCE)),
            (_has(around, p.REPRODUCTION) | kind.isin("reproduction", "map"), made("third_party_reproduction", fixed.REPRODUCTION_EVIDENCE)),
            (_has(label, p.TABLE_LABEL), made("authorial_table_or_chart", fixed.TABLE_LABEL_EVIDENCE, label, "'")),
            (_has(caption, p.TABLE), made("authorial_table_or_chart", fixed.TABLE_CAPTION_EVIDENCE)),
            (ext.isin(p.VECTOR), made("authorial_scheme_or_diagram", fixed.VECTOR_EVIDENCE, ext)),
            (_has(label, p.LABEL), made("authorial_scheme_or_diagram", fixed.FIGURE_LABEL_EVIDENCE, label, "'")),
            (_has(caption, p.SCHEME), made("authorial_scheme_or_diagram", fixed.SCHEME_CAPTION_EVIDENCE)),
            (kind.isin("chart", "table_image"), made("authorial_table_or_chart", fixed.TYPE_EVIDENCE, kind)),
            (kind.isin("scheme", "diagram"), made("authorial_scheme_or_diagram", fixed.TYPE_EVIDENCE, kind)),
        ],
        made("unclear_after_second_pass", fixed.NO_EVIDENCE),
    )


def staging(has_bytes: Column, is_first: Column, rights_status: Column, critical: Column, referenced: Column, ext: Column) -> Column:
    """The publication status of a media object on first sight."""
    return _first(
        [
            (~has_bytes, F.lit("metadata_only_source")),
            (~is_first, F.lit("duplicate")),
            (rights_status.isin("rights_review_required", "unknown"), F.lit("metadata_only_rights")),
            ((critical == "decorative") & ~referenced, F.lit("decorative_excluded")),
            (F.lower(ext).isin(fixed.RASTER + fixed.VECTOR), F.lit("published")),
        ],
        F.lit("technical_failure"),
    )


def indexable(kind: Column, publication: Column, review: Column, translation: Column, supported: Column) -> Column:
    """Whether a page may be indexed: one policy for all surfaces, closed for unknown kinds. supported: it has members or evidence."""
    return F.coalesce(
        F.when(kind == "topic", publication.eqNullSafe(F.lit("published")) & supported)
        .when(kind == "concept", publication.eqNullSafe(F.lit("published")) & review.eqNullSafe(F.lit("reviewed")) & supported)
        .when(kind == "language_variant", translation.eqNullSafe(F.lit("confirmed")) & review.eqNullSafe(F.lit("reviewed")))
        .otherwise(kind.isin(fixed.ALWAYS_INDEXABLE)),
        F.lit(False),
    )
