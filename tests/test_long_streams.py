"""Streams of any length, dealt in parts, against the same steps with a document in one task."""

import random

from pyspark.sql import functions as F

from leafcut.operators import places, similarity
from leafcut.plans import registry


def test_parts_give_what_whole_streams_give(spark, monkeypatch):
    monkeypatch.setattr(similarity, "PART", 16)
    monkeypatch.setattr(places, "BLOCK", 8)
    rng = random.Random(3)
    near = lambda: [1.0 + rng.random() / 9, 1.0, rng.random() / 9]
    rows = [(d, p, None if rng.random() < 0.2 or 40 < p < 90 else near() if rng.random() < 0.9 else [-1.0, rng.random(), 1.0]) for d in ("a", "b") for p in sorted(rng.sample(range(1, 400), 170))]
    pages = spark.createDataFrame(rows, "doc_id string, page_num int, vec array<double>").repartition(3).persist()
    sims = similarity.chain(pages, "vec")
    assert sorted(map(tuple, similarity.long_chain(pages, "vec").collect()), key=str) == sorted(map(tuple, sims.collect()), key=str)
    want = sorted(map(tuple, similarity.flags(sims).collect()), key=str)
    assert sorted(map(tuple, similarity.long_flags(sims).collect()), key=str) == want and len(want) == 340 and any(r[3] for r in want)


def test_vectors_are_one_stream(spark, tmp_path):
    rows = [(i, [1.0, float(i)]) for i in range(130)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    for name in ("w06_n08_similarity_chain", "w07_rolling_zflag"):
        got = registry.QUERIES[name](spark, str(tmp_path)).filter(F.col("sim").isNull()).collect()
        assert [r.page_num for r in got] == [1]


def test_places_count_over_gaps(spark, monkeypatch):
    monkeypatch.setattr(places, "BLOCK", 4)
    rows = [(s, i) for s in ("x", "y", None) for i in (9, 0, 3, 4, 70, 71, 72, 8)]
    got = places.numbered(spark.createDataFrame(rows, "s string, i long"), "s", "i", "p").collect()
    assert {(r.s, r.i): r.p for r in got} == {(s, i): k for s in ("x", "y", None) for k, i in enumerate(sorted({i for _, i in rows}), 1)}
