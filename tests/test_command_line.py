"""The command line over small tables, and inputs that are missing, empty or of another header."""

import json

import pytest

from leafcut import __main__ as cli
from leafcut.sources import adapter, readers

D = "/root/testdata/sf0.001"


def call(spark, *args):
    a = cli.parser().parse_args(list(args))
    return [tuple(r) for r in a.call(spark, a).collect()]


def test_run_resumes_and_dry_run_writes_nothing(spark, tmp_path):
    at = lambda x: str(tmp_path / x)
    pages = adapter.raw_pages(spark, D).drop("i")
    docs = sorted(r[0] for r in pages.select("doc_id").distinct().collect())
    (tmp_path / "t.json").write_text(json.dumps({"document_types": [{"id": "invoice", "label": "Invoice", "category": "F", "anchor_phrases": ["invoice"], "keywords": []}]}))
    pages.filter(pages.doc_id == docs[0]).write.parquet(at("first"))
    pages.write.parquet(at("all"))
    args = ["--taxonomy", at("t.json"), "--out", at("out")]
    assert [r[0] for r in call(spark, "run", "--pages", at("all"), *args, "--dry-run")] == [f"{x}.pdf" for x in docs]
    assert not (tmp_path / "out").exists()
    assert [r[0] for r in call(spark, "run", "--pages", at("first"), *args)] == docs[:1]
    assert [r[0] for r in call(spark, "run", "--pages", at("all"), *args, "--dry-run")] == [f"{x}.pdf" for x in docs[1:]]
    once = call(spark, "run", "--pages", at("all"), *args)
    assert [r[0] for r in once] == docs and call(spark, "run", "--pages", at("all"), *args) == once
    assert spark.read.parquet(at("out/report")).count() == len(docs)


def test_merge_by_position_with_warning(spark, tmp_path):
    for name, body in (("a", ""), ("b", 'x,y\n1,"p, q"\n2,r\n'), ("c", "y,z\n3,s\n")):
        (tmp_path / "in" / name).mkdir(parents=True)
        (tmp_path / "in" / name / "segments_summary.csv").write_text(body)
    with pytest.warns(UserWarning, match="may not line up"):
        counts = call(spark, "merge", str(tmp_path / "in"), "--out", str(tmp_path / "out"))
    assert [n for _, n in counts] == [2, 1]
    got = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert got.columns == ["x", "y"] and sorted(map(tuple, got.collect())) == [("1", "p, q"), ("2", "r"), ("3", "s")]


def test_missing_inputs_are_warned_of(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "b.PDF").write_bytes(b"x")
    (tmp_path / "a.pdf").write_bytes(b"y")
    with pytest.warns(UserWarning, match="not found"):
        got = readers.bundles(spark, [str(tmp_path / "d"), str(tmp_path / "a.pdf"), str(tmp_path / "gone")]).collect()
    assert [r.doc_id for r in got] == ["a", "b"]


def test_redact_counts_and_writes(spark, tmp_path):
    spark.createDataFrame([("d", 1, "ssn 123-45-6789, ana@x.org")], "doc_id string, page_num int, text string").write.parquet(str(tmp_path / "p"))
    args = ["redact", "--pages", str(tmp_path / "p"), "--out", str(tmp_path / "o")]
    want = call(spark, *args, "--dry-run")
    assert dict(want)["ssn"] == 1 and dict(want)["email"] == 1 and not (tmp_path / "o").exists()
    assert call(spark, *args) == want and "123-45" not in spark.read.parquet(str(tmp_path / "o")).first().text
