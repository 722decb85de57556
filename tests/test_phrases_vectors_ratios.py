"""Phrases in one pass, vectors without a row a dimension, and text ratios that are bounded before they are worked out."""

import difflib
import math
import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leafcut.operators import classify, features


def phrase_rows(n, rnd):
    words = ["".join(rnd.choices("abcde", k=rnd.randrange(1, 4))) for _ in range(n)]
    return [(rnd.choice(["anchor", "keyword"]), i % 5, f"t{i % 5}", i, w) for i, w in enumerate(words)]


def test_every_phrase_of_a_text_is_found(spark):
    rnd = random.Random(1)
    for n in (0, 1, 3, 40):
        rows = phrase_rows(n, rnd)
        known = classify.Phrases(rows)
        for _ in range(60):
            t = "".join(rnd.choices("abcde ", k=rnd.randrange(0, 30)))
            for kind in ("anchor", "keyword"):
                assert set(known.found(t, kind)) == {r for r in rows if r[0] == kind and r[4] in t}
            best = max((r for r in rows if r[0] == "anchor" and r[4] in t), key=lambda r: (len(r[4]), -r[1], -r[3]), default=None)
            assert known.longest(t) == ((best[2], best[4]) if best else (None, None))
            hits = {o: len({r[4] for r in rows if r[0] == "keyword" and r[1] == o and r[4] in t}) for o in range(5)}
            top = max(hits, key=lambda o: (hits[o], -o))
            assert known.most(t) == ((f"t{top}", hits[top]) if hits[top] else (None, None))
    assert known.found(None, "anchor") == [] and known.longest("") == (None, None)


def test_phrases_as_rows_and_case(spark):
    phrases = spark.createDataFrame([("anchor", 0, "x", 0, "Straße A"), ("anchor", 1, "y", 0, "aß"), ("anchor", 0, "x", 1, ""), ("anchor", 2, classify.MISC, 0, "e"), ("keyword", 0, "x", 0, "a")], "kind string, type_ord int, type_id string, phrase_ord int, phrase string")
    segs = spark.createDataFrame([("d", 1, "In der STRASSE A"), ("d", 2, "straße a und mehr"), ("d", 3, None)], "doc_id string, segment_index int, t string")
    got = sorted((r.segment_index, r.type_id, r.phrase) for r in classify.matches(segs, phrases, "anchor", "t").collect())
    assert got == [(2, "x", "straße a"), (2, "y", "aß")]
    assert classify.matches(segs, phrases.limit(0), "anchor", "t").count() == 0


def test_the_time_does_not_grow_with_the_phrases():
    rnd = random.Random(2)
    texts = [" ".join("".join(rnd.choices("abcdefghijklmnop", k=6)) for _ in range(300)) for _ in range(60)]
    took = {}
    for n in (20, 2000):
        known = classify.Phrases([("anchor", i, f"t{i}", 0, "".join(rnd.choices("abcdefghijklmnop", k=9))) for i in range(n)])
        best = []
        for _ in range(5):
            began = time.perf_counter()
            for t in texts:
                known.longest(t)
            best.append(time.perf_counter() - began)
        took[n] = min(best)
    # A hundred times as many phrases; one search for each would take a hundred times as long.
    assert took[2000] < 10 * took[20]


def test_wide_centroids(spark):
    rnd = random.Random(3)
    rows = [(g, [rnd.uniform(-1, 1) for _ in range(3072)]) for g in (1, 1, 1, 2)] + [(3, [0.0, 0.0]), (4, [1.0]), (4, [1.0, 2.0]), (5, None), (5, []), (6, [3.0, 4.0]), (6, None)]
    df = spark.createDataFrame(rows, "g int, vec array<double>")
    c = classify.centroids(df, "g")
    assert "explode" not in c._jdf.queryExecution().toString().lower()
    got = {r.g: r.centroid for r in c.collect()}
    mean = [sum(v[i] for g, v in rows if g == 1) / 3 for i in range(3072)]
    size = math.sqrt(sum(x * x for x in mean))
    assert all(math.isclose(x, m / size, rel_tol=1e-9, abs_tol=1e-12) for x, m in zip(got[1], mean, strict=True))
    assert got[3] == [0.0, 0.0] and got[4] is None and 5 not in got and got[6] == pytest.approx([0.6, 0.8])


def test_nearest_prototypes_against_brute_force():
    rnd = random.Random(4)
    vec = lambda n: [rnd.choice([0.0, rnd.uniform(-1, 1)]) for _ in range(n)]
    rows = [(i % 3, f"t{i % 3}", vec(rnd.choice([2, 2, 3]))) for i in range(12)] + [(3, "t3", [0.0, 0.0])]
    batch = [vec(2) for _ in range(60)] + [vec(3), vec(5), None, [0.0, 0.0], []]

    def cosine(a, b):
        n = math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b))
        return sum(x * y for x, y in zip(a, b, strict=True)) / n if len(a) == len(b) and n else 0.0

    best, means = classify.Prototypes(rows).nearest(batch)
    for v, t, m in zip(batch, best, means, strict=True):
        want = {name: sum(cosine(v, p) for _, x, p in rows if x == name) / sum(x == name for _, x, _ in rows) for name in ("t0", "t1", "t2", "t3")} if v is not None else {}
        top = max(want, key=lambda k: want[k], default=None)
        assert (t is None and m is None) if top is None or want[top] <= 1e-12 else (t == top and math.isclose(m, want[top], rel_tol=1e-9))
    assert classify.Prototypes([]).nearest([[1.0], None]) == ([None, None], [None, None])


@settings(max_examples=300, deadline=None)
@given(st.text("ab c", max_size=300), st.text("ab c", max_size=300), st.sampled_from([0.3, 0.6, 0.95]))
def test_the_limit_is_told_as_by_the_whole_ratio(a, b, limit):
    assert features.reaches(a, b, limit) == (difflib.SequenceMatcher(None, a, b).ratio() >= limit)


def test_near_copies_and_bounds(spark):
    rnd = random.Random(6)
    page = lambda n: " ".join("".join(rnd.choices("etaoinshrdlu", k=rnd.randrange(2, 9))) for _ in range(n))
    pairs = []
    for _ in range(60):
        a = page(80)
        b = list(a)
        for _ in range(rnd.randrange(0, 60)):
            b[rnd.randrange(len(b))] = rnd.choice("xyz\U0001f600")
        pairs += [(a, "".join(b)), (a, page(80)), (a, a)]
    df = spark.createDataFrame(pairs, "a string, b string")
    rows = df.select("a", "b", features.ratio_bound(F.col("a"), F.col("b")).alias("bound"), features.similar_enough(F.col("a"), F.col("b")).alias("same")).collect()
    for r in rows:
        ratio = difflib.SequenceMatcher(None, r.a, r.b).ratio()
        assert r.bound >= ratio - 1e-12 and r.same == (ratio >= 0.95)
    assert {r.same for r in rows} == {True, False}


def test_long_pages_are_told_apart_soon():
    rnd = random.Random(7)
    words = ["".join(rnd.choices("etaoinshrdlucmfwypvbgkjqxz", weights=range(26, 0, -1), k=rnd.randrange(2, 9))) for _ in range(3000)]
    a, b = (" ".join(rnd.choices(words, k=18_000))[:100_000] for _ in range(2))
    began = time.perf_counter()
    assert not features.reaches(a, b, 0.95) and features.reaches(a, a[:50_000] + "#" + a[50_001:], 0.95)
    assert time.perf_counter() - began < 4
