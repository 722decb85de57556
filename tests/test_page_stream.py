"""Pages in any order as a stream: equal to the batch plan, with gaps that are waited for and documents that end."""

import random

from pyspark.sql import functions as F

from leafcut.operators import features, scoring, similarity
from leafcut.sources import adapter
from leafcut.streaming import pages as streamed

D = "/root/testdata/sf0.001"


def drained(spark, folder, schema, at, **more):
    """Rows of one batch over what is new in a folder."""
    source = spark.readStream.schema(schema).parquet(str(folder))
    out = []
    q = streamed.page_stream(source, **more).writeStream.foreachBatch(lambda df, n: out.extend(df.collect())).option("checkpointLocation", str(at)).trigger(once=True).start()
    q.awaitTermination()
    return out


def test_shuffled_pages_equal_the_batch_plan(spark, tmp_path):
    rnd = random.Random(4)
    vectors = adapter.page_vectors(spark, D)
    raw = adapter.raw_pages(spark, D).drop("i").join(vectors.withColumnRenamed("vec", "image_embedding"), ["doc_id", "page_num"], "left").withColumn("text_embedding", F.when(F.col("page_num") % 3 != 0, F.reverse("image_embedding")))
    raw.write.parquet(str(tmp_path / "all"))
    raw = spark.read.parquet(str(tmp_path / "all"))
    toc = adapter.toc(spark, D)
    known = spark.createDataFrame(toc.collect(), toc.schema)
    f = features.page_features(raw, toc).persist()
    v = f.filter("NOT is_blank").select("doc_id", "page_num").join(raw.select("doc_id", "page_num", "image_embedding", "text_embedding"), ["doc_id", "page_num"], "left")
    scores = scoring.page_scores(scoring.with_flags(f, *(similarity.flags(similarity.chain(v, c)) for c in ("image_embedding", "text_embedding"))))
    want = scores.join(scoring.segment_index(scores), ["doc_id", "page_num"]).join(f.select("doc_id", "page_num", "page_num_found", "numbering_reset", "format_returning"), ["doc_id", "page_num"])
    cols = [c for c in streamed._COLUMNS if c != "late"]
    fine = lambda r: tuple(round(x, 3) if isinstance(x, float) else x for x in (r[c] for c in cols))
    want = sorted(map(fine, want.select(cols).collect()))
    part = spark.createDataFrame([(*k, rnd.randrange(3)) for k in [(r.doc_id, r.page_num) for r in raw.select("doc_id", "page_num").collect()]], "doc_id string, page_num int, part int")
    got = []
    for k in range(3):
        raw.join(part.filter(F.col("part") == k), ["doc_id", "page_num"]).drop("part").orderBy(F.rand(k)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        got += drained(spark, tmp_path / "in", raw.schema, tmp_path / "cp", toc=known)
    assert not any(r.late for r in got) and sorted(map(fine, got)) == want and len(want) == 200
    by = {}
    for r in got:
        assert by.setdefault(r.doc_id, 0) == r.page_num - 1
        by[r.doc_id] = r.page_num


def page(spark, folder, *rows):
    none = {k: {"header": "", "footer": ""} for k in ("0.12", "0.20", "0.30")}
    df = spark.createDataFrame([(d, n, 612.0, 792.0, t, none, 0, 0, 0.0, []) for d, n, t in rows], "doc_id string, page_num int, width double, height double, text string, bands map<string, struct<header: string, footer: string>>, drawing_count int, image_count int, image_area double, image_infos array<struct<width: int, height: int, colorspace: int>>")
    df.coalesce(1).write.mode("append").parquet(str(folder))
    return df.schema


def test_a_gap_is_waited_for_then_passed_and_what_comes_after_is_late(spark, tmp_path):
    at, cp = tmp_path / "in", tmp_path / "cp"
    schema = page(spark, at, ("d", 1, "EXHIBIT A\nfirst"), ("d", 3, "EXHIBIT B\nthird"), ("d", 4, "fourth page text"))
    first = drained(spark, at, schema, cp, patience_ms=1, idle_ms=10**9)
    assert [(r.page_num, r.segment_index) for r in first] == [(1, 1)]
    # The next batch finds the time to wait over.
    page(spark, at, ("e", 1, "another document"))
    second = drained(spark, at, schema, cp, patience_ms=1, idle_ms=10**9)
    both = [(r.doc_id, r.page_num, r.segment_index, r.late) for r in first + second]
    assert sorted(both) == [("d", 1, 1, False), ("d", 3, 2, False), ("d", 4, 2, False), ("e", 1, 1, False)]
    page(spark, at, ("d", 2, "second"), ("d", 5, "fifth page of text"))
    third = drained(spark, at, schema, cp, patience_ms=1, idle_ms=10**9)
    assert sorted((r.page_num, r.late, r.segment_index) for r in third if r.doc_id == "d") == [(2, True, None), (5, False, 2)]


def test_a_document_without_pages_for_long_is_forgotten(spark, tmp_path):
    at, cp = tmp_path / "in", tmp_path / "cp"
    schema = page(spark, at, ("d", 1, "one"), ("d", 2, "two"))
    assert len(drained(spark, at, schema, cp, patience_ms=1, idle_ms=1)) == 2
    page(spark, at, ("e", 1, "x"))
    drained(spark, at, schema, cp, patience_ms=1, idle_ms=1)
    page(spark, at, ("d", 1, "one again"))
    again = drained(spark, at, schema, cp, patience_ms=1, idle_ms=1)
    assert [(r.page_num, r.late, r.segment_index) for r in again if r.doc_id == "d"] == [(1, False, 1)]


def test_state_survives_being_written():
    rnd = random.Random(2)
    row = lambda n: {"page_num": n, "text": rnd.choice(["a text that is long enough", "another text of some length"]), "is_blank": n % 7 == 0, "format_label": rnd.choice("AB"), "title_anchor": None, "correspondence": False, "drawing_count": rnd.randrange(900), "block": rnd.choice([None, ["acme"], ["bolt", "works"]]), "cur": rnd.choice([None, n % 4]), "total": 9, "region": "footer", "kind": rnd.choice(["total", "split"]), "bare": n, "title": rnd.choice("xy"), "level": rnd.choice([None, 1, 2, 3]), "_image": [rnd.random(), rnd.random()], "_text": rnd.choice([None, [rnd.random()]])}
    rows = [row(n) for n in range(1, 60)]
    whole, kept, a, b = streamed.Reading(), streamed.Reading(), [], []
    for r in rows:
        a.append(whole.step(r))
        kept = streamed.Reading.load(kept.dump())
        b.append(kept.step(r))
    assert a == b
