"""Providers that fail for single pages, runs that are killed between results, and summaries of many rows in order."""

import json
import math
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from leafcut import __main__ as cli
from leafcut.functions import money
from leafcut.sources import embedding, readers
from leafcut.streaming import batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])
PAGES = "doc_id string, page_num int, text string, is_blank boolean"


@pytest.mark.parametrize("n,bad", [(64, {17}), (64, {0}), (64, {63}), (1, {0}), (50, {3, 4, 40}), (7, set()), (0, set())])
def test_a_failing_page_is_found_by_halving(n, bad):
    calls = []

    def call(rows):
        calls.append(len(rows))
        if bad & set(rows):
            raise OSError("no")
        return [x * 10 for x in rows]

    got = embedding.one_by_one(call, list(range(n)), tries=1)
    assert [x if not isinstance(x, Exception) else "bad" for x in got] == ["bad" if i in bad else i * 10 for i in range(n)]
    if len(bad) == 1:
        assert len(calls) <= 1 + 2 * math.ceil(math.log2(n or 1))
    # Only a page that fails alone is tried again.
    calls.clear()
    embedding.one_by_one(call, list(range(n)), tries=4)
    assert len(calls) <= 1 + len(bad) * (2 * math.ceil(math.log2(max(n, 1))) + 3)


def test_a_provider_that_is_down_is_not_asked_for_every_page():
    calls = []

    def call(rows):
        calls.append(1)
        raise OSError("down")

    got = embedding.one_by_one(call, list(range(1000)), tries=1, down=8)
    assert len(got) == 1000 and all(isinstance(x, OSError) for x in got) and len(calls) < 40
    assert all(isinstance(x, ValueError) for x in embedding.one_by_one(lambda xs: [], [1, 2], tries=1))


def test_pages_keep_the_primary_vectors_beside_a_bad_one(spark):
    rows = [("d", i, "" if i == 5 else "bad image text" if i == 9 else "bad text" if i == 7 else "bad" if i == 3 else f"text {i}", i == 8) for i in range(1, 100)] + [("e", 1, "fine", False)]
    pages = spark.createDataFrame(rows, PAGES).withColumn("image", F.when(F.col("page_num") == 9, F.lit(b"broken")).otherwise(F.lit(b"png")))

    def primary(texts, images):
        if any("bad" in t for t in texts):
            raise OSError("refused")
        return [([1.0, 2.0], [1.0, 2.0], "primary", 120 if t == "text 1" else None, None) for t in texts]

    def picture(images):
        if b"broken" in images:
            raise OSError("no image")
        return [[3.0]] * len(images)

    def words(texts):
        if any("text" in t for t in texts):
            raise OSError("no text")
        return [([4.0], 11)] * len(texts)

    got = readers.embed(pages, [primary, embedding.Parts(picture, words)], tries=2)
    by = {(r.doc_id, r.page_num): r for r in got.collect()}
    assert len(by) == 99 and ("d", 8) not in by
    assert {r.method for k, r in by.items() if k[1] not in (3, 7, 9)} == {"primary"} and by["d", 5].status == "ok"
    assert (by["d", 3].image_embedding, by["d", 3].text_embedding, by["d", 3].method, by["d", 3].text_tokens, by["d", 3].rank, by["d", 3].status) == ([3.0], [4.0], "fallback", 11, 1, "ok")
    assert by["d", 7].image_embedding == [3.0] and by["d", 7].text_embedding is None and by["d", 7].status == "text failed: OSError: no text"
    assert by["d", 9].rank is None and by["d", 9].image_embedding is None and by["d", 9].status == "failed: OSError: no image"
    assert [tuple(r) for r in embedding.failed_documents(got).collect()] == [("d", "FAILED", "failed: OSError: no image")]
    costs = {r.page_num: r for r in money.calls(got.filter("doc_id = 'd'").join(pages.select("doc_id", "page_num", F.length("text").alias("chars")), ["doc_id", "page_num"])).collect()}
    assert 9 not in costs and len(costs) == 97
    assert (costs[1].text_tokens, costs[1].image_tokens, costs[1].estimated) == (1, 119, False) and (costs[5].text_tokens, costs[5].image_tokens, costs[5].estimated) == (0, 1290, True)
    assert (costs[3].text_tokens, costs[3].image_tokens, costs[3].estimated) == (11, 1, False) and costs[7].text_tokens == 2 and math.isclose(costs[3].cost_usd, 0.0001 + 11 * 0.15 / 1e6)


# Folders of bundles.
TAXONOMY = {"document_types": [{"id": "invoice", "label": "Invoice", "category": "F", "anchor_phrases": ["invoice"], "keywords": []}, {"id": "memo", "label": "Memo", "category": "F", "anchor_phrases": ["memo"], "keywords": []}]}


class Text:
    def __init__(self, stream):
        self.pages = stream.read().decode().split("\f")
        if self.pages == ["broken"]:
            raise ValueError("not a bundle")

    def __len__(self):
        return len(self.pages)

    def page(self, number, wanted):
        none = {"header": "", "footer": ""}
        return {"text": self.pages[number - 1], "width": 612.0, "height": 792.0, "bands": {k: none for k in ("0.12", "0.20", "0.30")}, "drawing_count": 0, "image_count": 0, "image_area": 0.0, "image_infos": []}


def split(stream, ranges):
    pages = stream.read().decode().split("\f")
    return ["\f".join(pages[a - 1 : b]).encode() for a, b in ranges]


def embed(pages):
    return readers.embed(pages, [lambda ts: [([1.0, float(len(t))], [1.0, 2.0], "primary") for t in ts]])


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in" / "x").mkdir(parents=True)
    for name, body in (("a.pdf", "EXHIBIT A\nthis is an invoice\fsecond page of it\fEXHIBIT B\na memo to read"), ("x/a.PDF", "a memo of some length"), ("bad.pdf", "broken")):
        (tmp_path / "in" / name).write_text(body)
    (tmp_path / "t.json").write_text(json.dumps(TAXONOMY))
    return tmp_path


def call(spark, *args):
    a = cli.parser().parse_args(list(map(str, args)))
    return [tuple(r) for r in a.call(spark, a).collect()]


def test_a_folder_is_taken_up_where_it_was_left(spark, folder, monkeypatch, capsys):
    import types as t

    given = t.ModuleType("given_by_tests")
    given.decoder, given.splitter, given.embed = Text, split, embed
    monkeypatch.setitem(sys.modules, "given_by_tests", given)
    args = ["batch", folder / "in", "--recursive", "--decoder", "given_by_tests:decoder", "--splitter", "given_by_tests:splitter", "--embed", "given_by_tests:embed", "--taxonomy", folder / "t.json", "--out", folder / "out", "--files-per-batch", 9, "--prototypes", folder / "p", "--accumulate-prototypes"]
    real, at = DataFrameWriter.parquet, []

    def broken(self, path, *a, **k):
        if "/summary/" in path and not at:
            at.append(path)
            raise OSError("killed between report and summary")
        return real(self, path, *a, **k)

    with monkeypatch.context() as m:
        m.setattr(DataFrameWriter, "parquet", broken)
        with pytest.raises(Exception, match="killed between"):
            call(spark, *args)
    assert (folder / "out" / "report").exists() and not (folder / "out" / "summary").exists()
    assert call(spark, *args) == [("a", 2), ("x/a", 1)] == call(spark, *args)
    reports = [json.loads(r.report) for r in batches.results(spark, str(folder / "out"), "report").collect()]
    assert sorted(r["run_metadata"]["pages_processed"] for r in reports) == [1, 3]
    # Costs came out of the embedding pass.
    assert sorted(c["calls"] for r in reports for c in r["cost_and_tokens"]) == [1, 3]
    assert [(r.doc_id, r.error) for r in batches.results(spark, str(folder / "out"), "failures").collect()] == [("bad", "ValueError: not a bundle")]
    (folder / "in" / "new.pdf").write_text("an invoice that came later")
    assert call(spark, *args) == [("a", 2), ("new", 1), ("x/a", 1)]
    names = sorted(x.relative_to(folder / "out").as_posix() for x in (folder / "out").rglob("*.pdf"))
    assert sum("/new/segment_001" in x for x in names) == 1 and sum("_v1/a/segment_00" in x for x in names) >= 2
    types, _, _ = readers.taxonomy(spark, str(folder / "t.json"))
    assert sorted((r.type_id, r.ord) for r in readers.prototypes(spark, str(folder / "p"), types).collect()) == [("invoice", 1), ("invoice", 2), ("memo", 1), ("memo", 2)]


def test_a_killed_run_repeats_no_document(spark, folder, monkeypatch, capsys):
    rows = [(d, p, 612.0, 792.0, f"EXHIBIT A\n{w}", {}, 0, 0, 0.0, []) for d, p, w in (("d", 1, "an invoice"), ("d", 2, "a memo to all"), ("e", 1, "a memo"))]
    pages = spark.createDataFrame(rows, readers.RAW_PAGES)
    pages.write.parquet(str(folder / "pages"))
    pages.select("doc_id", "page_num", F.array(F.col("page_num").cast("double"), F.lit(1.0)).alias("image_embedding"), F.lit(None).cast("array<double>").alias("text_embedding")).write.parquet(str(folder / "vectors"))
    args = ["run", "--pages", folder / "pages", "--vectors", folder / "vectors", "--taxonomy", folder / "t.json", "--out", folder / "out", "--prototypes", folder / "p.json", "--accumulate-prototypes"]
    (folder / "p.json").write_text(json.dumps({"memo": [[0.0, 1.0]] * 20}))
    real = DataFrameWriter.parquet
    with monkeypatch.context() as m:
        m.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: (_ for _ in ()).throw(OSError("killed")) if "/summary/" in path else real(self, path, *a, **k))
        with pytest.raises(OSError, match="killed"):
            call(spark, *args)
    assert call(spark, *args) == [("d", 2), ("e", 1)] == call(spark, *args)
    assert spark.read.parquet(str(folder / "out" / "report")).count() == 2
    types, _, _ = readers.taxonomy(spark, str(folder / "t.json"))
    counts = {r.type_id: r["count"] for r in readers.prototypes(spark, str(folder / "p.json"), types).groupBy("type_id").count().collect()}
    assert counts["memo"] == 20 and counts["invoice"] >= 1


def test_many_rows_merge_in_order(spark, tmp_path):
    for name, n in (("b", 60_000), ("a", 40_000)):
        (tmp_path / "in" / name).mkdir(parents=True)
        (tmp_path / "in" / name / "s.csv").write_text("x,y\n" + "".join(f'{name}{i},"v{i % 7}, ""q"""\n' for i in range(n)))
    assert [n for _, n in call(spark, "merge", tmp_path / "in", "--out", tmp_path / "out")] == [40_000, 60_000]
    parts = sorted((tmp_path / "out").glob("part-*"))
    lines = [x for p in parts for x in p.read_text().splitlines() if x and not x.startswith("x,y")]
    assert [x.split(",")[0] for x in lines] == [f"a{i}" for i in range(40_000)] + [f"b{i}" for i in range(60_000)]
    # The rows are dealt by range, not gathered.
    assert readers.in_order(readers.summaries(spark, str(tmp_path / "in"))).select("x").rdd.getNumPartitions() >= 1
    plan = readers.in_order(readers.summaries(spark, str(tmp_path / "in")))._jdf.queryExecution().toString()
    assert "rangepartitioning" in plan.lower()
