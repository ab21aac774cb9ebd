"""Pages of headings by blocks equal those of going through a work heading by heading."""

import random
import time

from scriptorium.operators import sections


def test_scan_equals_a_plain_loop(spark, monkeypatch):
    rng = random.Random(5)
    rows = []
    for work, n in (("hot", 60), ("b", 5), (None, 9)):
        at = 1
        for k in range(n):
            at += rng.choice([0, 0, 1, 3])
            pages = sorted({max(1, at + rng.randint(-6, 9)) for _ in range(rng.randint(1, 5))})
            rows.append((work, k * 7, [(p, rng.random() < 0.4) for p in pages]))
    schema = "work string, k int, hits array<struct<page:int,within:boolean>>"
    want = {}
    for work in ("hot", "b", None):
        last = 5
        for w, k, hits in rows:
            if w == work:
                open_ = [(p, g) for p, g in hits if p >= max(4, last - 2)]
                good = [p for p, g in open_ if g]
                page = good[0] if good else open_[0][0] if open_ else None
                want[w, k] = (page, bool(good))
                last = last if page is None else max(last, page)
    for block in (1, 4, 128):
        monkeypatch.setattr(sections, "PAGE_BLOCK", block)
        got = sections._page_scan(spark.createDataFrame(rows, schema), "work", "k", 4).collect()
        assert {(r.work, r.k): (r.page, r.within) for r in got} == want and len(got) == len(want)


def test_page_candidates(spark):
    headings = [("w", 1, "chapter", "alphachapter", ["contextone"]), ("w", 2, "section", "betachapter", []), ("w", 3, "section", "tiny", []), ("w", 4, "front", "gammachapter", []), ("w", 5, "section", "nowhere to be", ["x"]), ("v", 1, "chapter", "alphachapter", [])]
    pages = [("w", i, t) for i, t in enumerate(["alphachapter", "betachapter", "x", "alphachapter here", "alphachapter", "contextone", "z betachapter"], 1)] + [("v", 4, "no")]
    found = sections.page_candidates(spark.createDataFrame(headings, "w string, k int, kind string, title string, contexts array<string>"), spark.createDataFrame(pages, "w string, page int, text string"), "w", "k")
    got = {(r.w, r.k): (r.page, r.status) for r in found.collect()}
    assert got == {
        ("w", 1): (5, "auto_heading_plus_context_candidate"), ("w", 2): (7, "auto_heading_only_candidate"), ("w", 3): (None, "title_too_short"), ("w", 4): (None, "not_applicable"), ("w", 5): (None, "not_found"), ("v", 1): (None, "not_found"),
    }
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_equal_headings_are_found_in_long_pages_once(spark):
    pages = [("w", i, f"{i}z" * 9000 + ("samechapter" if i % 2 else "") + "y" * i) for i in range(1, 9)]
    headings = [("w", k, "chapter", "samechapter", [f"{5 + k % 3}z" * 3]) for k in range(6)]
    began = time.time()
    found = sections.page_candidates(spark.createDataFrame(headings, "w string, k int, kind string, title string, contexts array<string>"), spark.createDataFrame(pages, "w string, page int, text string"), "w", "k")
    got = {r.k: (r.page, r.status) for r in found.collect()}
    assert time.time() - began < 120
    want, last = {}, 5
    for w, k, _, title, (context,) in headings:
        hits = [(i, context in t or any(j == i + 1 and context in u for _, j, u in pages)) for _, i, t in pages if title in t and i >= max(4, last - 2)]
        good = [i for i, near in hits if near] or [i for i, _ in hits]
        want[k] = (good[0], "auto_heading_plus_context_candidate" if any(near for _, near in hits) else "auto_heading_only_candidate") if good else (None, "not_found")
        last = max(last, good[0]) if good else last
    assert got == want
