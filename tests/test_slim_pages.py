"""What page plans carry: texts stay out of windows and joins of signals, and go to Python a few at a time."""

import difflib
import random

from leafcut.operators import classify, features
from leafcut.sources import adapter

D = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_signals_leave_texts_behind(spark):
    det = features.detected(adapter.raw_pages(spark, D), adapter.toc(spark, D))
    assert not {"text", "bands"} & set(det.columns)
    assert "ArrowEvalPython" not in _plan(det)


def test_phrases_take_each_text_once_in_small_batches(spark):
    segs = spark.createDataFrame([("d", 1, "Total", "the Invoice number 7", 0.0)], "doc_id string, segment_index int, titles string, body string, drawing_share double")
    known = classify.listed(adapter.taxonomy_phrases(spark))
    out = segs.select(classify.phrase_answers("titles", "body", known).alias("x"))
    assert "ArrowEvalPython" not in _plan(out)
    t, b = "total", "the invoice number 7"
    assert tuple(out.first().x) == (*known.longest(t), *known.longest(b), *known.most(f"{t} {b}")) == (None, None, "invoice", "invoice number", "invoice", 1)


def test_duplicates_over_gaps_and_missing_texts(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8)))
    base = " ".join(word() for _ in range(60))
    texts = [base, base, base + " x", None, base, base[:40] + "?" * 30 + base[70:], "short", "short", " ".join(word() for _ in range(60)), ""]
    rows = [(d, p, t) for d in ("x", "y") for p, t in zip((1, 2, 5, 6, 9, 12, 13, 14, 20, 21), texts, strict=True)]
    pages = adapter.raw_pages(spark, D).drop("i", "text", "doc_id", "page_num").limit(1).crossJoin(spark.createDataFrame(rows, "doc_id string, page_num int, text string"))
    pages = pages.select("doc_id", "page_num", *(c for c in pages.columns if c not in ("doc_id", "page_num")))
    got = {(r.doc_id, r.page_num): r.is_duplicate_of_prev for r in features.detected(pages).collect()}
    own = {}
    for (d, p, t), prev in zip(rows, [None, *rows], strict=False):
        a, b = t or "", (prev[2] or "") if prev and prev[0] == d else ""
        own[d, p] = min(len(a), len(b)) > 15 and difflib.SequenceMatcher(None, a, b).ratio() >= 0.95
    assert got == own and sum(own.values()) == 4
