"""Archives, periodic runs and the peak sweep: round trips, brute force and odd rows."""

import base64
import datetime as dt
import gzip
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafcut.llm import peak_sweep, periodic, warc


# Archives.
PAGES = [
    (5, "https://a.org/x", "<p>same</p>"), (3, "https://b.org/y", "<p>same</p>"), (9, "https://c.org/z\r\nX-Bad: 1", "<p>same</p>"), (1, None, None), (2, "https://d.org", ""),
    (7, "https://e.org", "WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n<p>ümläut 漢字</p>"), (None, "https://f.org", "alone"), (8, "https://g.org", "x" * 700_000), (4, "https://h.org", "\r\n\r\n"), (4, "https://h.org", "\r\n\r\n"),
]


def _pages(spark):
    return spark.createDataFrame([(*p, "clash", "clash", "clash") for p in PAGES], "page_id long, url string, html string, key string, n string, refers_to string")


def _digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_pages_come_back_from_archives(spark):
    got = sorted(map(tuple, warc.archived(_pages(spark)).collect()), key=repr)
    first = {}
    for p, _, h in PAGES:
        first[h or ""] = min(x for x in (first.get(h or ""), p) if x is not None) if p is not None or first.get(h or "") is not None else None
    want = [(p, len((h or "").encode()), _digest(h), "response" if first[h or ""] in (p, None) else "revisit", None if first[h or ""] in (p, None) else first[h or ""]) for p, _, h in PAGES]
    assert got == sorted(want, key=repr)


def test_a_large_number_of_repeats_goes_by_a_join(spark):
    few, _ = warc.revisits(_pages(spark))
    many, _ = warc.revisits(_pages(spark), most=0)
    assert sorted(map(repr, few.collect())) == sorted(map(repr, many.collect()))
    assert {r.refers_to for r in warc.revisits(_pages(spark), least=100)[0].collect()} == {None}


def test_members_sidecar_and_payloads(spark, tmp_path):
    warc.write_archives(_pages(spark).repartition(3), f"file://{tmp_path}/streams")
    streams = list((tmp_path / "streams").glob("*.gz"))
    index = warc.normalise(warc.archives(spark, f"file://{tmp_path}/streams"), f"file://{tmp_path}/members")
    rows = index.collect()
    assert len(rows) == len(PAGES) and all(zlib.decompressobj(31).decompress(x.read_bytes(), 8) == b"WARC/1.0" for x in streams)
    for file in {r.file for r in rows}:
        raw = open(file.removeprefix("file://"), "rb").read()
        side = [x.split() for x in open(file.removeprefix("file://") + ".idx").read().splitlines()]
        own = sorted((r.offset, r.length, r.record_id) for r in rows if r.file == file)
        assert [(int(o), int(n), i) for i, o, n in side] == own and sum(n for _, n, _ in own) == len(raw)
        for offset, length, _ in own:
            one = zlib.decompressobj(31)
            text = one.decompress(raw[offset : offset + length])
            assert one.eof and not one.unused_data and text.startswith(b"WARC/1.0\r\n") and text.endswith(b"\r\n\r\n")
    back = warc.read_records(spark.createDataFrame(rows, warc.INDEX)).collect()
    held = {r.page_id: bytes(r.payload).decode() for r in back if r.payload is not None}
    assert held[7] == PAGES[5][2] and held[8] == PAGES[7][2] and held[1] == "" and held[3] == "<p>same</p>"
    assert next(r.url for r in back if r.page_id == 9) == "https://c.org/z%0D%0AX-Bad: 1"


def _record(i, payload):
    block = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    return b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:leafcut:page:%d>\r\nwarc-payload-digest: sha1:%s\r\nContent-Length: %d\r\n\r\n" % (i, base64.b32encode(hashlib.sha1(payload).digest()), len(block)) + block + b"\r\n\r\n"


def test_foreign_streams(spark, tmp_path):
    rnd = random.Random(3)
    loads = {i: bytes(rnd.choices(b"ab\r\n", k=rnd.choice([0, 1, 9, 600_000]))) for i in range(12)}
    whole = b"".join(_record(i, x) for i, x in loads.items())
    (tmp_path / "one.warc.gz").write_bytes(gzip.compress(whole))
    (tmp_path / "two.warc.gz").write_bytes(gzip.compress(whole[:70_000]) + gzip.compress(whole[70_000:]))
    (tmp_path / "none.warc.gz").write_bytes(gzip.compress(b""))
    index = spark.createDataFrame(warc.normalise(warc.archives(spark, str(tmp_path)), f"{tmp_path.as_uri()}/out").collect(), warc.INDEX)
    got = sorted((r.page_id, bytes(r.payload)) for r in warc.read_records(index).collect())
    assert got == sorted([*loads.items()] * 2)
    for k, bad in enumerate((gzip.compress(whole)[:-20], gzip.compress(whole[:-500_000]), gzip.compress(b"WARC/1.0\r\nA: b\r\n\r\n"))):
        (tmp_path / f"bad{k}").mkdir()
        (tmp_path / f"bad{k}/x.gz").write_bytes(bad)
        with pytest.raises(Exception, match="breaks off|without a length"):
            warc.normalise(warc.archives(spark, f"{tmp_path}/bad{k}"), f"{tmp_path.as_uri()}/out").collect()


def test_no_pages_give_no_records(spark):
    assert warc.archived(_pages(spark).limit(0)).count() == 0


# Periodic runs.
def _smallest_period(w):
    return next(q for q in range(1, len(w) + 1) if all(w[i] == w[i + q] for i in range(len(w) - q)))


def _runs(w):
    out = set()
    for p in range(1, len(w) // 4 + 1):
        i = 0
        while i + p < len(w):
            if w[i] != w[i + p]:
                i += 1
                continue
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j + p - i >= max(6, 4 * p) and _smallest_period(w[i : j + p]) == p:
                out.add((i, j + p - i, p))
            i = j + 1
    return sorted(out)


def test_runs_against_brute_force(monkeypatch):
    rnd = random.Random(5)
    for k in range(1500):
        w = rnd.choices(range(rnd.choice([1, 2, 3, 9])), k=rnd.randrange(0, 70))
        for _ in range(rnd.randrange(3)):
            unit = rnd.choices(range(3), k=rnd.randrange(1, 9))
            w += (unit * 9)[: rnd.randrange(1, 9 * len(unit))] + rnd.choices(range(3), k=rnd.randrange(3))
        monkeypatch.setattr(periodic, "PROBES", 7 if k % 2 else 1 << 20)
        monkeypatch.setattr(periodic, "CHUNK", 1 if k % 3 else 64)
        assert periodic.runs_of(np.array(w, np.int64)) == _runs(w), w


def test_long_texts_are_searched_whole(spark):
    unit = [f"w{i}" for i in range(7000)]
    text = " ".join(["start", *unit * 5, "end", *["la"] * 50_000, "x"])
    docs = spark.createDataFrame([(1, text, "c"), (None, None, "c"), (2, "", "c"), (2, "", "c"), (3, "a b a\tb\x0bc", "c"), (4, "la la la la la", "c"), (5, "la la la la la la", "c")], "doc_id long, text string, runs string")
    got = {r.doc_id: r for r in periodic.find_runs(docs).collect()}
    assert [tuple(x) for x in got[1].runs] == [(1, 35_000, 7000), (35_002, 50_000, 1)] and bytes(got[1].collapsed).decode() == " ".join(["start", *unit, "end", "la", "x"])
    assert got[None].n_words == 0 and got[2].runs == [] and got[3].n_words == 4 and got[4].runs == [] and [tuple(x) for x in got[5].runs] == [(0, 6, 1)]
    assert periodic.find_runs(docs).count() == 7 and periodic.report(docs.limit(0)).count() == 0


def test_run_report_columns(spark):
    docs = spark.createDataFrame([(i, " ".join(random.Random(i).choices("abcdefgh", k=i % 90))) for i in range(300)] + [(None, "a a a a a a a")], "doc_id long, text string")
    for r in periodic.report(docs).collect():
        if r.doc_id is None:
            assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (1, 0, 7, 1, 7000)
            continue
        w = random.Random(r.doc_id).choices("abcdefgh", k=r.doc_id % 90)
        h, n = zlib.crc32(str(r.doc_id).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = _runs(w)
        gone = {i for s, k, p in runs for i in range(s + p, s + k)}
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (None if best[0] is None else 1000 * best[1] // best[2])
        assert r.runs_sha256 == sha("".join(f"{s},{k},{p}\n" for s, k, p in runs)) and r.collapsed_sha256 == sha(" ".join(x for i, x in enumerate(w) if i not in gone))


# The sweep.
def _swept(changes):
    by = {}
    for key, at, dn, dc in changes:
        by.setdefault(key, []).append((at, dn, dc))
    out = []
    for key, rows in by.items():
        rows.sort()
        n = c = 0
        own, high = [], None
        for i, (at, dn, dc) in enumerate(rows):
            n, c = n + dn, c + dc
            high = n if high is None else max(high, n)
            own.append((key, at, rows[i + 1][0] if i + 1 < len(rows) else None, n, c, high))
        out += [(*x, x[3] == high) for x in own]
    return sorted(out)


@pytest.mark.parametrize("block,bits", [(1, 1), (3, 1), (5, 2), (4096, 6)])
def test_scan_against_brute_force(spark, monkeypatch, block, bits):
    # One key has most rows, several have one, and blocks begin and end within keys and between them.
    rnd = random.Random(block)
    rows = [(key, at, rnd.choice([-2, -1, 1, 3]), rnd.randrange(-9, 9)) for key, n in ((-2, 40), (0, 1), (1, 90), (2, 1), (3, 1), (7, 13)) for at in rnd.sample(range(1000), n)]
    df = spark.createDataFrame(rows, "key int, from_s long, dn long, dc long")
    blocks = spark.sparkContext.broadcast(block)

    def scan(batches):
        peak_sweep.BLOCK = blocks.value
        return real(batches)

    real = peak_sweep._scan
    monkeypatch.setattr(peak_sweep, "_scan", scan)
    assert sorted(map(tuple, peak_sweep.scan(df, bits).collect())) == _swept(rows)


def test_combine_is_associative():
    rnd = random.Random(1)

    def leaf(key, at):
        n, c = rnd.randrange(-3, 4), rnd.randrange(-3, 4)
        return (key, key, at, n, c, n, n, c, n)

    for _ in range(300):
        a, b, c = (leaf(k, i) for i, k in enumerate(sorted(rnd.choices(range(3), k=3))))
        assert peak_sweep.combine(peak_sweep.combine(a, b), c) == peak_sweep.combine(a, peak_sweep.combine(b, c))


def test_open_sales_of_odd_rows(spark):
    t = lambda d, h=0, s=0: dt.datetime(2024, 1, d, h, 0, s)
    sales = spark.createDataFrame([
        (1, 10, 1.005, t(1, 0, 59), "x"), (2, 10, None, t(1, 0, 1), "x"), (3, None, 5.0, t(2), "x"), (4, 77, float("nan"), t(2), "x"), (5, 10, 2.0, None, "x"), (6, 10, 2.0, t(20), "x"), (7, 11, 3.0, t(3), "x"), (7, 11, 3.0, t(3), "x"), (8, 12, -4.0, t(8), "x"), (9, 12, -4.0, t(1), "x"),
    ], "sale_id long, client_id long, total double, sold_at timestamp_ntz, key string")
    lines = spark.createDataFrame([(1, t(1)), (1, t(2)), (1, None), (2, None), (6, t(1)), (7, t(4)), (9, t(1)), (None, t(9))], "sale_id long, shipped_at timestamp_ntz")
    clients = spark.createDataFrame([(10, 4), (11, None), (12, 4), (None, 9)], "client_id long, nation_id int")
    got = sorted(map(tuple, peak_sweep.open_sales(sales, lines, clients).collect()))
    at = lambda d: int(dt.datetime(2024, 1, d, tzinfo=dt.UTC).timestamp())
    # Sale 6 ends before it starts; sale 9 ends as sale 8 of the same amount starts; sale 7 comes twice.
    assert [x[:5] for x in got if x[0] == 4] == [(4, at(1), at(9), 3, 100 - 400), (4, at(9), None, 2, -400)]
    assert [x[:4] for x in got if x[0] == -1] == [(-1, at(2), at(3), 2), (-1, at(3), at(11), 4), (-1, at(11), None, 2)]
    assert [(x[1], x[3], x[5], x[6]) for x in got if x[0] == -2] == [(at(1), 3, 3, False), (at(2), 5, 5, False), (at(3), 7, 7, True), (at(9), 6, 7, False), (at(11), 4, 7, False)]
    assert peak_sweep.open_sales(sales.limit(0), lines.limit(0), clients.limit(0)).count() == 0
    assert peak_sweep.open_sales(sales, lines.limit(0), clients.limit(0)).filter(F.col("nation_id") == -1).count() == 5
