"""Small cases worked by hand for the page-stream operators."""

import difflib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leafcut.functions import layout, money, text, vectors
from leafcut.operators import classify, features, redact, reports, scoring, similarity
from leafcut.sources import adapter, readers
from leafcut.streaming import pages as streamed


def one(spark, **cols):
    return spark.range(1).select(*(c.alias(k) for k, c in cols.items())).first()


def test_formats(spark):
    for w, h, want in ((600, 776, "US_LETTER_portrait"), (595, 842, "A4_portrait"), (1100, 600, "WIDE_landscape"), (700, 700, "OTHER_portrait")):
        assert one(spark, f=layout.page_format(F.lit(float(w)), F.lit(float(h)))).f == want


def test_blank_limits(spark):
    def blank(chars, area=0.0, drawings=5):
        return one(spark, b=layout.is_blank(F.lit("x" * chars), F.lit(area), F.lit(100.0), F.lit(100.0), F.lit(drawings))).b

    assert blank(15) and not blank(16) and not blank(0, drawings=6) and not blank(0, 201.0) and blank(0, 200.0)


def test_headers(spark):
    a = lambda s: one(spark, a=text.title_anchor(F.lit(s))).a
    assert a("x\n\ny\n EXHIBIT A ") == "EXHIBIT A" and a("x\ny\nz\nEXHIBIT A") is None and a("Exhibit A") is None
    c = lambda s: one(spark, c=text.correspondence(F.lit(s))).c
    assert c("To: x\nFrom: y") == ["FROM", "TO"] and c("To: x") is None and c("MEMORANDUM\nre : x") == ["MEMORANDUM", "RE"]


def test_numbering(spark):
    n = lambda s: one(spark, n=text.numbering_total(F.lit(s))).n
    assert tuple(n("Page 2 of 5")) == (2, 5) and tuple(n("PG 3/4")) == (3, 4) and n("Page 1000 of 1001") is None and tuple(n("Page 1000 of 1001\npg. 7 / 9000")) == (7, 9000)
    assert one(spark, n=text.numbering_split(F.lit("PAGE:\n\n1"))).n == 1 and one(spark, n=text.numbering_bare(F.lit("- 12 -"))).n == 12


def fold(rows):
    f = features.Fold()
    return [f.step(i, *r) for i, r in enumerate(rows, 1)]


def row(label="A", prev="A", dup=False, spike=False, title=None, level=None, anchor=False, cur=None, total=None, region="footer", kind="total", bare=None):
    return dup, label, prev, spike, title, level, anchor, cur, total, region if cur is not None else None, kind if cur is not None else None, bare


def test_fold_numbering():
    resets = lambda *ns: [x[2] for x in fold([row(cur=n) for n in ns])]
    assert resets(1, 1) == [True, True] and resets(3, 3) == [False, False] and resets(3, 5) == [False, True] and resets(5, 2) == [False, True]
    assert [x[0] for x in fold([row(cur=4, total=9), row(), row(bare=5), row(bare=9)])] == [4, None, 5, None]
    assert fold([row(cur=4, total=9), row(cur=5, kind="split")])[1][1] == 9
    fresh = fold([row(cur=1), row(cur=2), row(anchor=True), row(cur=1, region="header")])
    assert [x[3] for x in fresh] == [True, False, False, True] and fresh[3][4]


def test_fold_titles_and_formats():
    marks = lambda rows: [x[6] for x in fold(rows)]
    assert marks([row(title="A", level=1)] * 4) == [True, False, True, False]
    assert marks([row(title="A", level=1), row(title="A", level=1, cur=1)]) == [True, True]
    assert marks([row(title="A", level=3)]) == [False]
    back = fold([row("X", None), row("Y", "X", dup=True), row("X", "Y")])
    assert back[2][7] and back[2][8]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("AB"), st.booleans(), st.sampled_from([None, "t", "u"]), st.sampled_from([1, 2, 3]), st.one_of(st.none(), st.integers(0, 4))), max_size=20))
def test_fold_never_marks_duplicates(pages):
    prev = None
    rows = []
    for label, dup, title, level, cur in pages:
        rows.append(row(label, prev, dup, title=title, level=level if title else None, cur=cur))
        prev = label
    for r, out in zip(rows, fold(rows), strict=True):
        assert not (r[0] and out[6]) and (not out[8] or out[7]) and (not out[3] or out[2])


def flags(spark, sims):
    df = spark.createDataFrame([("d", i, s) for i, s in enumerate(sims, 1)], "doc_id string, page_num int, sim double")
    return [(r.is_moderate, r.z_reason, r.is_high) for r in similarity.flags(df).orderBy("page_num").collect()]


def test_flags(spark):
    assert flags(spark, [0.9, 0.9, 0.54])[2] == (True, "insufficient_context", False) and flags(spark, [0.9, 0.9, 0.55])[2][0] is False
    assert flags(spark, [0.9] * 4 + [0.8])[4] == (True, "z=-5.0,drop=0.1", True)
    assert flags(spark, [0.9, None, 0.9, 0.9, None, 0.84])[5][0] is False
    assert flags(spark, [0.0] + [0.9] * 11 + [0.8])[12][2]  # the oldest is outside the frame


def test_vectors(spark):
    arr = lambda *x: F.array(*(F.lit(float(v)) for v in x))
    r = one(spark, a=vectors.cosine(arr(1, 0), arr(1, 0, 0)), b=vectors.cosine_or_zero(arr(1, 0), arr(1, 0, 0)), c=vectors.cosine(arr(0, 0), arr(1, 0)), d=vectors.cosine(arr(3, 4), arr(3, 4)))
    assert r.a is None and r.b == 0 and r.c == 0 and abs(r.d - 1) < 1e-12


def test_duplicate_ratio(spark):
    base = "".join(chr(97 + i * i % 26) for i in range(3000))
    pairs = [("a" * 20, "a" * 20), ("x" + base[1:], base), (base[:150] + "zz", base[:150])]
    df = spark.createDataFrame(pairs, "a string, b string").withColumn("s", features.similar_enough(F.col("a"), F.col("b")))
    assert [r.s for r in df.collect()] == [difflib.SequenceMatcher(None, a, b).ratio() >= 0.95 for a, b in pairs]


def score_rows(spark, rows):
    base = dict(is_blank=False, title_anchor=None, correspondence_labels=None, format_changed=False, format_returning=False, has_l1_bookmark=False, bookmark_title=None, raw_bookmark_title=None, bookmark_level=None, bookmark_suppressed=False, numbering_reset=False, numbering_fresh_start=False, numbering_scheme_changed=False, drawing_spike=False, drawing_density_drop=False, letterhead_changed=False, is_duplicate_of_prev=False, image_similarity=None, text_similarity=None, image_mod=False, text_mod=False, image_high=False, text_high=False, image_z_reason=None, text_z_reason=None)
    kinds = {"title_anchor": "string", "correspondence_labels": "array<string>", "bookmark_title": "string", "raw_bookmark_title": "string", "bookmark_level": "int", "image_similarity": "double", "text_similarity": "double", "image_z_reason": "string", "text_z_reason": "string"}
    schema = "doc_id string, page_num int, " + ", ".join(f"{k} {kinds.get(k, 'boolean')}" for k in base)
    df = spark.createDataFrame([("d", i, *{**base, **r}.values()) for i, r in enumerate(rows, 1)], schema)
    return scoring.page_scores(df).orderBy("page_num").collect()


def test_scores(spark):
    high = {"image_high": True}
    s = score_rows(spark, [high, high, {"is_duplicate_of_prev": True, **high}, high])
    assert [x.total_score for x in s] == [1.0, 0.5, 0.0, 1.0] and [x.is_boundary for x in s] == [True, False, False, True]
    s = score_rows(spark, [{"image_mod": True, "text_mod": True, "image_similarity": 0.5, "text_similarity": 0.5}, {"numbering_fresh_start": True, "numbering_reset": True, "numbering_scheme_changed": True}, {"has_l1_bookmark": True, "bookmark_level": 2, "bookmark_title": "x"}, {"bookmark_suppressed": True, "raw_bookmark_title": "y", **high}])
    assert [x.embedding_score for x in s][0] == 0.5 and s[1].numbering_score == 1.1 and s[1].is_boundary and not s[2].bookmark_trusted and s[3].bookmark_title == "y" and s[3].structural_score == 1.0
    seg = scoring.segments(spark.createDataFrame([("d", i, b) for i, b in enumerate([False, False, True, False, True], 1)], "doc_id string, page_num int, is_boundary boolean")).orderBy("segment_index").collect()
    assert [(x.start_page, x.end_page) for x in seg] == [(1, 2), (3, 4), (5, 5)]


def classified(spark, titles, body, anchor="", share=0.0):
    segs = spark.createDataFrame([("d", 1, titles, body, anchor, False, share, False, 2)], "doc_id string, segment_index int, titles string, body string, first_anchor string, any_drawing boolean, drawing_share double, has_tables boolean, pages long")
    r = classify.classify(segs, adapter.taxonomy_types(spark), adapter.taxonomy_phrases(spark)).first()
    return r.document_type_id, r.confidence, r.classification_method


def test_cascade(spark):
    assert classified(spark, "Change Order Request", "public notice of something") == ("change_order", "HIGH", "anchor_phrase_bookmark:change order request")
    assert classified(spark, "", "a smooth surface") == ("award", "HIGH", "anchor_phrase_body:rfa")
    assert classified(spark, "", "sheet of cost", "EXHIBIT A") == ("supporting_misc", "LOW", "default") and classified(spark, "", "total fiscal budget", "EXHIBIT A")[0] == "budget"
    assert classified(spark, "", "", share=0.625)[2] == "visual_fingerprint:62%_drawing_pages"


def test_prototypes(spark):
    old = spark.createDataFrame([("t", i, [float(i)]) for i in range(20)], "type_id string, ord long, vec array<double>")
    new = spark.createDataFrame([("t", 0, [100.0]), ("t", 1, [101.0])], old.schema)
    kept = [r.vec[0] for r in classify.keep_prototypes(old, new).orderBy("ord").collect()]
    assert kept == [float(i) for i in range(2, 20)] + [100.0, 101.0]
    mixed = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0])], "g int, vec array<double>")
    assert classify.centroids(mixed, "g").first().centroid is None


def test_redaction(spark):
    p = spark.createDataFrame([("d", 1, "call 555-123-4567 or 555-123-4567, a@b.org, 123-45-6789")], "doc_id string, page_num int, text string")
    got = {r.category: (r.regions, r.compat_regions) for r in redact.pattern_counts(p).collect()}
    assert got == {"phone": (2, 4), "email": (1, 1), "ssn": (1, 1)}
    assert redact.redacted(p).first().text == "call [PHONE] or [PHONE], [EMAIL], [SSN]"


def test_costs_and_versions(spark):
    r = one(spark, c=money.primary(F.lit(1000), F.lit(None).cast("int")), f=money.fallback(F.lit(0), F.lit(None).cast("long")), g=money.primary(F.lit(1000), F.lit(50)))
    assert (r.c.text_tokens, r.c.image_tokens) == (250, 1290) and r.f.text_tokens == 0 and (r.g.text_tokens, r.g.image_tokens) == (-50, 100)
    v = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], "k string, version int")
    assert {x.k: x.version for x in reports.next_version(v, "k").collect()} == {"a": 2, "b": 1}
    assert one(spark, s=text.slug(F.lit("  Budget / Détail! "))).s == "Budget_Détail" and one(spark, s=text.slug(F.lit("//"))).s == "segment"


def test_readers(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"document_types": [{"id": "x", "label": "X", "anchor_phrases": ["p", "q"], "keywords": []}], "classification": {"keyword_min_hits": 2}}')
    types, phrases, settings_ = readers.taxonomy(spark, str(tmp_path / "t.json"))
    assert types.count() == 1 and phrases.count() == 2 and settings_["keyword_min_hits"] == 2 and settings_["low_confidence_threshold"] == 0.65
    (tmp_path / "p.json").write_text('{"x": [[1.0, 0.0]], "gone": [[1.0]], "x2": []}')
    assert [r.vec for r in readers.prototypes(spark, str(tmp_path / "p.json"), types).collect()] == [[1.0, 0.0]]
    (tmp_path / "b").mkdir()
    for n in ("b.PDF", "a.pdf", "c.txt"):
        (tmp_path / "b" / n).write_bytes(b"x")
    files = readers.bundles(spark, str(tmp_path / "b"))
    assert [r.doc_id for r in files.collect()] == ["a", "b"]

    def decoder(doc, content, most):
        if doc == "b":
            raise ValueError("broken")
        return [(doc, i, 600.0, 800.0, "t", {}, 0, 0, 0.0, []) for i in range(1, 9)][:most]

    decoded = readers.decode(files, decoder, 3)
    assert decoded.count() == 3 and [r.doc_id for r in readers.failures(files, decoded).collect()] == ["b"]


def test_embedding_falls_back(spark):
    def broken(texts):
        raise OSError

    pages = spark.createDataFrame([("d", 1, "", False), ("d", 2, "x", True)], "doc_id string, page_num int, text string, is_blank boolean")
    got = readers.embed(pages, [broken, lambda ts: [([1.0], None, t) for t in ts]], tries=2).collect()
    assert [(r.page_num, r.method) for r in got] == [(1, readers.EMPTY_PAGE)]


def test_streamed_fold_equals_batch(spark, tmp_path):
    rows = adapter.raw_pages(spark, "/root/testdata/sf0.001")
    det = features.detected(rows, adapter.toc(spark, "/root/testdata/sf0.001"))
    want = sorted(map(tuple, features.folded(det).collect()))
    flat = det.select("doc_id", "page_num", "is_duplicate_of_prev", "format_label", "prev_label", "drawing_spike", "title", "level", (F.col("title_anchor").isNotNull() | F.col("correspondence_labels").isNotNull()).alias("has_anchor"), "labeled.cur", "labeled.total", "labeled.region", "labeled.kind", "bare")
    flat.filter("page_num <= 5").coalesce(1).write.parquet(str(tmp_path / "in" / "a"))
    flat.filter("page_num > 5").coalesce(1).write.parquet(str(tmp_path / "in" / "b"))
    src = spark.readStream.schema(flat.schema).parquet(str(tmp_path / "in" / "*"))
    q = streamed.folded_stream(src).writeStream.format("memory").queryName("folded").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("folded").collect())) == want
