"""Labels inside words, bands cut from words, images and tokens of providers, and the full run report."""

import json

from leafcut.operators import redact, reports
from leafcut.sources import readers

WORDS = "doc_id string, page_num int, x0 double, y0 double, x1 double, y1 double, text string"


def word(page, x0, y0, x1, text):
    return ("d", page, float(x0), float(y0), float(x1), float(y0 + 10), text)


def test_labels_inside_words_and_on_uneven_lines(spark):
    rows = [word(1, 10, 10, 50, "(ssn:a"), word(1, 60, 13, 90, "12-3"), word(1, 100, 10, 120, "next"), word(2, 10, 10, 30, "TAX"), word(2, 32, 12, 50, "ID:"), word(2, 60, 11, 70, "77"), word(3, 10, 10, 40, "words")]
    df = spark.createDataFrame(rows, WORDS)
    spans = {(r.page_num, r.label, round(r.x0, 2), round(r.x1, 2), r.y0, r.y1) for r in redact.label_spans(df).collect()}
    one = 40 / 6
    assert spans == {(1, "SSN:", round(10 + one, 2), round(10 + 5 * one, 2), 10.0, 20.0), (1, "SSN", round(10 + one, 2), round(10 + 4 * one, 2), 10.0, 20.0), (2, "TAX ID:", 10.0, 50.0, 10.0, 22.0), (2, "TAX ID", 10.0, 44.0, 10.0, 22.0)}
    got = {(r.page_num, r.x0, r.y0, r.x1, r.y1) for r in redact.label_regions(df).collect()}
    assert got == {(1, 60.0, 13.0, 90.0, 23.0), (2, 60.0, 11.0, 70.0, 21.0)}


def test_bands_from_words(spark):
    words = [word(1, 50, 6, 80, "7"), word(1, 10, 5, 40, "Page"), word(1, 10, 60, 40, "Low"), word(1, 10, 500, 40, "body"), word(1, 10, 980, 40, "foot"), word(1, 60, 980, 80, "note")]
    pages = spark.createDataFrame([("d", 1, 600.0, 1000.0), ("d", 2, 600.0, 1000.0)], "doc_id string, page_num int, width double, height double")
    got = {r.page_num: r.bands for r in readers.with_bands(pages, spark.createDataFrame(words, WORDS)).collect()}
    assert tuple(got[1]["0.12"]) == ("Page 7\nLow", "foot note") and tuple(got[1]["0.30"]) == ("Page 7\nLow", "foot note")
    assert set(got[2]) == {"0.12", "0.20", "0.30"} and tuple(got[2]["0.12"]) == ("", "")


def test_provider_gets_images_and_tells_tokens(spark):
    pages = spark.createDataFrame([("d", 1, " ", False, b"png"), ("d", 2, "x", False, None), ("d", 3, "x", True, None)], "doc_id string, page_num int, text string, is_blank boolean, image binary")

    def provider(texts, images):
        return [([float(len(i or b""))], [1.0], t, 7, None) for t, i in zip(texts, images, strict=True)]

    got = sorted((r.page_num, r.image_embedding, r.method, r.text_tokens, r.image_tokens) for r in readers.embed(pages, [provider]).collect())
    assert got == [(1, [3.0], readers.EMPTY_PAGE, 7, None), (2, [0.0], "x", 7, None)]


def test_run_report_has_every_part(spark):
    summary = spark.createDataFrame([("d", "d.pdf", 3, 2, 3, 3, "a|b"), ("d", "d.pdf", 3, 1, 1, 2, "")], "pdf_id string, pdf_filename string, total_pages int, seg int, start_page int, end_page int, special_tags string")
    scores = spark.createDataFrame([("d", p, p == 2, 0.5 * p) for p in (3, 1, 2)], "doc_id string, page_num int, is_blank boolean, total_score double")
    meta = spark.createDataFrame([("d", "v1")], "doc_id string, version string")
    timing = spark.createDataFrame([("d", 1.5)], "doc_id string, total double")
    costs = spark.createDataFrame([("d", "text", 9), ("d", "image", 4)], "doc_id string, method string, calls int")
    got = json.loads(reports.run_report(summary, scores, meta, timing, costs).first().report)
    assert got["run_metadata"] == {"input_pdf": "d.pdf", "total_pages": 3, "pages_processed": 3, "blank_pages_skipped": 1, "segments_found": 2, "version": "v1"}
    assert got["timing_seconds"] == {"total": 1.5} and [c["method"] for c in got["cost_and_tokens"]] == ["image", "text"]
    assert [(s["segment_index"], s["special_tags"]) for s in got["segments"]] == [(1, []), (2, ["a", "b"])]
    assert [p["page_num"] for p in got["per_page_detail"]] == [1, 2, 3] and got["config"]["boundary_threshold"] == 1.0
    assert set(json.loads(reports.run_report(summary, scores).first().report)) == {"run_metadata", "segments", "per_page_detail", "config"}
