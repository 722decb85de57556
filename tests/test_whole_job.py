"""Queries over small tables of their own, against brute force: every row and the whole text count."""

from leafcut.plans import registry
from leafcut.sources import adapter


def test_next_version_reads_every_line(spark, tmp_path):
    rows = [(1, 100, 2), (1, 7, 1), (1, 8, 4), (2, 50, 1), (2, 51, 2), (3, 33, 3)]
    spark.createDataFrame(rows, "l_suppkey long, l_partkey long, l_linenumber int").write.parquet(str(tmp_path / "lineitem.parquet"))
    want = {k: next(v for v in range(1, 9) if (k, v) not in {(a, c) for a, _, c in rows}) for k in (1, 2, 3)}
    assert {r.k: r.version for r in registry.QUERIES["n20_k08_next_version"](spark, str(tmp_path)).collect()} == want == {1: 3, 2: 3, 3: 1}


def test_token_jaccard_of_whole_texts_and_over_gaps(spark, tmp_path):
    import re

    from leafcut.functions.text import STOP_WORDS

    long = " ".join(f"w{i}" for i in range(200))
    rows = [(1, long), (2, long + " other words at the end"), (5, "other words"), (4095, "some words here"), (4096, "some words there"), (20_000, "words there"), (20_001, ""), (20_002, "x1 x2")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    sets = [{x for x in re.findall("[a-z0-9]+", t.lower()) if len(x) > 1} - set(STOP_WORDS) for _, t in rows]
    want = {rows[i][0]: len(a & b) / len(a | b) if a and b else 0.0 for i, (a, b) in enumerate(zip(sets[1:], sets, strict=False), 1)}
    assert {r.doc_id: r.similarity for r in registry.QUERIES["n07_u03_u04_token_jaccard"](spark, str(tmp_path)).collect()} == want and 0 < want[2] < 1


def test_near_equal_pages_are_duplicates_in_every_query(spark, tmp_path):
    import difflib
    import random

    rng = random.Random(8)
    page = lambda: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(60))
    first, second = page(), page()
    # Ids 99 apart get the same head and phrase from the adapter.
    rows = [(5, "s", first), (104, "s", first[:90] + "#" + first[91:]), (203, "s", second), (302, "s", second[:40] + "?" * 30 + second[70:]), (401, "t", first)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    (tmp_path / "embeddings.parquet").symlink_to("/root/testdata/sf0.001/embeddings.parquet")
    d = str(tmp_path)
    texts = {(r.doc_id, r.page_num): r.text for r in adapter.raw_pages(spark, d).collect()}
    want = {k: (k[0], k[1] - 1) in texts and difflib.SequenceMatcher(None, t, texts[k[0], k[1] - 1]).ratio() >= 0.95 for k, t in texts.items()}
    assert want == {("s", 1): False, ("s", 2): True, ("s", 3): False, ("s", 4): False, ("t", 1): False}
    assert {(r.doc_id, r.page_num): r.is_duplicate_of_prev for r in registry.QUERIES["w01_duplicate_pages"](spark, d).collect()} == want
    assert {r.doc_id: r.duplicates for r in registry.QUERIES["f14_duplicates_score_nothing"](spark, d).collect()} == {"s": 1, "t": 0}
    scores = {(r.doc_id, r.page_num): r for r in registry.QUERIES["p01_p06_w08_w09_scores"](spark, d).collect()}
    assert scores["s", 2].total_score == 0 and not scores["s", 2].is_boundary
    report = registry._run(spark, d).scores.select("doc_id", "page_num", "duplicate_of_prev").collect()
    assert {(r.doc_id, r.page_num): r.duplicate_of_prev for r in report} == want


def test_prototypes_are_the_newest_of_the_whole_table(spark, tmp_path):
    rows = [(i, [float(i), 1.0]) for i in range(130)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = sorted((r.type_ord, r.type_id, r.ord, r.vec[0]) for r in adapter.prototypes(spark, str(tmp_path)).collect())
    want = [(t, f"t{t}", k, float(i)) for t in range(4) for k, i in enumerate([i for i in range(130) if i % 4 == t][-20:], 1)]
    assert got == want
