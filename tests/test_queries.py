"""Registered queries against their SQL, over the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__
from leafcut.plans import registry

SF = "/root/testdata/sf0.001"
NAMES = ["s04_bookmark_map", "s05_taxonomy", "w06_n08_similarity_chain", "f05_f06_headers", "f08_letterhead", "n01_l04_lines", "n05_labeled_numbering", "n14_a13_pii_counts", "n16_n19_j08_label_regions", "w02_w03_w04_changes", "w07_rolling_zflag", "d01_numbering", "w10_u01_l01_segments", "a03_centroids", "a08_l03_longest_anchor", "a10_j06_n09_prototypes", "k04_l06_last_prototypes", "a02_cost_by_method", "n20_k08_next_version", "k09_j09_pending_runs"]


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(norm, v)) + "]"
    return repr(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted("|".join(map(norm, r)) for r in df.select(*cols).collect())
    res = duck.execute(registry.SQL[name])
    names = [c[0] for c in res.description]
    assert sorted(names) == cols
    want = sorted("|".join(norm(r[names.index(c)]) for c in cols) for r in res.fetchall())
    assert got == want


def test_every_sql_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_segments_partition_pages(spark):
    segs = registry.QUERIES["w10_u01_l01_segments"](spark, SF).collect()
    by = {}
    for s in segs:
        by.setdefault(s.doc_id, []).append((s.start_page, s.end_page))
    for spans in by.values():
        spans.sort()
        assert spans[0][0] == 1 and all(b + 1 == c for (_, b), (c, _) in zip(spans, spans[1:], strict=False))
