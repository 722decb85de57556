"""Taxonomy settings and the prototype pass, read from JSON and held against brute force; batch rows; patterns beyond ASCII."""

import json
import math

from pyspark.sql import functions as F

from leafcut.functions import text
from leafcut.operators import classify, reports
from leafcut.sources import readers

SEGS = "doc_id string, segment_index int, titles string, body string, first_anchor string, any_drawing boolean, drawing_share double, has_tables boolean, pages int"


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b, strict=True)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b))


def test_prototype_pass_with_settings_from_json(spark, tmp_path):
    types = [{"id": "a", "label": "A", "category": "X", "anchor_phrases": ["alpha"], "keywords": ["kappa"]}, {"id": "b", "label": "B", "category": "Y", "ingest_mode": "tabular", "anchor_phrases": [], "keywords": ["lambda", "mu"]}]
    (tmp_path / "t.json").write_text(json.dumps({"classification": {"prototype_min_confidence": 0.9, "low_confidence_threshold": 0.5, "keyword_min_hits": 2, "prototype_min_pages_to_save": 3}, "document_types": types}))
    vs = {"a": [[1.0, 0.0], [0.9, 0.1]], "b": [[0.0, 1.0]], "unknown": [[1.0, 1.0]]}
    (tmp_path / "p.json").write_text(json.dumps(vs))
    kinds, phrases, settings = readers.taxonomy(spark, str(tmp_path / "t.json"))
    known = readers.prototypes(spark, str(tmp_path / "p.json"), kinds)
    cents = {1: [1.0, 0.05], 2: [0.6, 0.8], 3: [-1.0, -1.0], 4: [0.1, 1.0], 5: [1.0, 0.0]}
    body = {1: "nothing", 2: "nothing", 3: "lambda and mu", 4: "alpha", 5: "nothing"}
    segs = spark.createDataFrame([("d", i, "", body[i], None, False, 0.0, False, 2 if i == 1 else 3) for i in cents], SEGS)
    c = spark.createDataFrame([("d", i, v) for i, v in cents.items()], "doc_id string, segment_index int, centroid array<double>")
    got = {r.segment_index: r for r in classify.classify(segs, kinds, phrases, known, c, settings).collect()}
    for i in (1, 2, 5):
        best = max(("a", "b"), key=lambda t: sum(cosine(cents[i], v) for v in vs[t]) / len(vs[t]))
        mean = sum(cosine(cents[i], v) for v in vs[best]) / len(vs[best])
        assert (got[i].document_type_id, got[i].confidence, got[i].classification_method) == (best, "HIGH" if mean >= 0.9 else "MEDIUM", f"prototype_similarity:{mean:.3f}")
    assert got[3].classification_method == "keyword_score:2_hits" and got[4].classification_method == "anchor_phrase_body:alpha"
    # A single vector may teach only from prototype_min_pages_to_save pages on, unless an anchor told the type.
    assert [got[i].may_teach for i in (1, 2, 4, 5)] == [False, False, True, True]
    strict = {r.segment_index: r.document_type_id for r in classify.classify(segs, kinds, phrases, known, c, {**settings, "low_confidence_threshold": 0.99, "keyword_min_hits": 3}).collect()}
    assert strict == {1: "a" if sum(cosine(cents[1], v) for v in vs["a"]) / 2 >= 0.99 else classify.MISC, 2: classify.MISC, 3: classify.MISC, 4: "a", 5: "a" if sum(cosine(cents[5], v) for v in vs["a"]) / 2 >= 0.99 else classify.MISC}


def test_what_teaches_is_kept_and_written(spark, tmp_path):
    old = spark.createDataFrame([("a", i, [float(i)]) for i in range(20)], "type_id string, ord long, vec array<double>")
    new = spark.createDataFrame([("a", 0, [100.0]), ("b", 0, [7.0])], "type_id string, ord long, vec array<double>")
    kept = classify.keep_prototypes(old, new)
    assert readers.write_prototypes(kept, str(tmp_path / "out")) == 21
    types = spark.createDataFrame([("a", 0), ("b", 1)], "type_id string, type_ord int")
    again = readers.prototypes(spark, str(tmp_path / "out"), types).filter("type_id = 'a'").orderBy("ord").collect()
    assert [r.vec[0] for r in again] == [*map(float, range(1, 20)), 100.0]


def test_batch_rows(spark):
    inputs = spark.createDataFrame([("b.pdf",), ("a.PDF",), ("c.pdf",)], "pdf_filename string")
    done = spark.createDataFrame([("c.pdf",)], "pdf_filename string")
    plan = reports.batch_plan(inputs, done, "/out/")
    assert [tuple(r) for r in plan.collect()] == [("a.PDF", "/out/a", "dry-run", 0.0), ("b.pdf", "/out/b", "dry-run", 0.0)]
    log = reports.batch_log(spark.createDataFrame([("x.pdf", "/out/x", 0, 1.26), ("y.pdf", "/out/y", 3, 2.0)], "pdf_filename string, output_dir string, exit_code int, seconds double"))
    assert [r.status for r in log.collect()] == ["OK", "FAILED(3)"]
    r = reports.batch_counts(plan.unionByName(log)).first()
    assert (r.runs, r.failed, r.executed) == (4, 1, 2)


def test_patterns_beyond_ascii(spark):
    row = spark.createDataFrame([("write josé@x.org or ana@x.org",)], "t string").select(text.redact(F.col("t")).alias("r"), text.pii_matches(F.col("t"))["email"].alias("m")).first()
    assert row.r == "write [EMAIL] or [EMAIL]" and row.m == ["josé@x.org", "ana@x.org"]
