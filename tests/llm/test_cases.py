"""Corner cases of the corpus operators: small tables with a known answer, brute force, and the registered SQL over made tables."""

import hashlib
import itertools
import re
import time
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import zstandard

from leafcut.llm import decontaminate, exact_dedup, html_extract, language_id, license_scan, mixing, ngram_join, queries, secrets_scan, toxicity, url_filter
from leafcut.llm.common import among, passing

from test_corpus import DOCS, brute_components, docs, made, sets_of

PAGES = "page_id long, url string, html string, host long, verdict string, text int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash", 2) for r in rows], PAGES)


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_shingle_sets():
    word = thue_morse(1024)
    other = word.translate(str.maketrans("ab", "ba"))
    a, b = ngram_join.shingle_sets(pa.array([f"{word} one two three four", f"{other} one two three four"]))
    assert len(a) == len(b) == 1 and a[0] != b[0]
    text = " ".join(f"w{i % 37}" for i in range(3000)) + "\t" + "long" * 400 + " end  "
    whole = next(ngram_join.shingle_sets(pa.array([text])))
    assert len(whole) == len(sets_of(text))
    for x in ("", "   ", "a", "a b c d", "x" * 5000, text):
        assert (ngram_join._long_set(np.frombuffer(x.encode(), np.uint8)) == next(ngram_join.shingle_sets(pa.array([x])))).all()


def test_long_texts_in_stretches(monkeypatch):
    text = " ".join(f"w{i % 37}x" for i in range(500)) + "\t" + "long" * 40 + " end  "
    whole = next(ngram_join.shingle_sets(pa.array([text])))
    monkeypatch.setattr(ngram_join, "_CHUNK", 16)
    assert (next(ngram_join.shingle_sets(pa.array([text]))) == whole).all()


def test_near_rows_that_share_an_identifier(spark):
    w = [f"v{i}" for i in range(40)]
    a, b = " ".join(w), " ".join([*w[:39], "other"])
    rows = [(5, a, None), (5, "nothing in common with it at all", None), (3, b, None), (9, "nothing in common with it at all", None), (None, b, None), (5, a, None)]
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs(spark, rows)).collect())
    assert got == Counter({(5, 36, 3): 2, (5, 3, 5): 1, (3, 36, 3): 1, (9, 3, 5): 1, (None, 36, None): 1})
    kept = Counter((r.doc_id, r.text) for r in ngram_join.one_of_each(docs(spark, rows)).collect())
    assert kept == Counter({(5, rows[1][1]): 1, (3, b): 1, (None, b): 1})


def test_filter_or_join(spark):
    rows = spark.range(1000).selectExpr("id AS x", "'t' AS text")
    ids = spark.range(0, 1000, 7).selectExpr("id AS x")
    for most in (1 << 20, 10):
        got, shared = among(rows, "x", ids, most)
        assert (shared is None) == (most == 10)
        x = np.array([r.x for r in got.collect()])
        assert set(range(0, 1000, 7)) <= set(x[passing(shared, x)]) and len(passing(shared, x)) < 200


def test_drop_exact_by_row(spark):
    rows = [(1, "B", None), (5, "A", None), (5, "B", None), (9, "A", None), (None, "B", None), (None, "C", None), (None, "C", None), (7, "D", None), (7, "D", None), (8, None, None), (8, "", None), (2, "x \n y", None), (4, "x y", None)]
    kept = Counter((r.doc_id, r.text) for r in exact_dedup.drop_exact(docs(spark, rows)).collect())
    assert {k: n for k, n in kept.items() if k[0] not in (None, 8)} == {(1, "B"): 1, (5, "A"): 1, (7, "D"): 1, (2, "x \n y"): 1}
    assert sum(n for k, n in kept.items() if k[0] is None) == 1 and sum(n for k, n in kept.items() if k[0] == 8) == 1
    want = Counter()
    same: dict = {}
    for i, t, _ in rows:
        same.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    for t, ids in same.items():
        keep = min((i for i in ids if i is not None), default=None)
        want.update((i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids)
    for key_bytes, most in ((32, 1 << 20), (1, 0)):
        assert Counter(map(tuple, exact_dedup.exact_groups(docs(spark, rows), key_bytes, most).collect())) == want


def test_merge_of_sorted_runs():
    run = exact_dedup._runs(32)
    b = pa.record_batch([pa.array([3, 1, None, 2, 7]), pa.array(["a", "a", "b", "b", "c"])], ["doc_id", "text"])
    got = next(run(iter([b])))
    assert got.column(0).to_pylist() == sorted(got.column(0).to_pylist())
    first = [(d, n) for d, n in zip(got.column(2).to_pylist(), got.column(4).to_pylist(), strict=True) if n]
    assert sorted(first, key=str) == [(1, 2), (2, 2), (7, 1)]
    names = ["key", "k64", "keep_id", "n"]
    parts = [pa.record_batch([pa.array([bytes([k]) for k in ks]), pa.array(ks), pa.array(ids, pa.int64()), pa.array([1] * len(ks))], names) for ks, ids in (([1, 1, 2], [4, 3, None]), ([2, 2], [9, 8]), ([2, 5], [None, 1]))]
    out = pa.Table.from_batches(exact_dedup._merge(iter(parts))).to_pylist()
    assert [(r["k64"], r["keep_id"], r["n"]) for r in out] == [(1, 3, 2), (2, 8, 4), (5, 1, 1)]


def test_where_an_item_stands(spark):
    item = "abcdefghijklmnopqrstuvwxyz abcdefghijk"
    text = "No, abcdefghijklmnXYopqrstuvwxyz abcdefghijk end"
    bench = spark.createDataFrame([(1, item), (1, "something else that is long enough"), (2, item), (2, item)], "item_id long, text string")
    rows = [(7, text, None), (7, text, None), (8, "x " * 200_000 + item, None), (None, item, None)]
    got = Counter(map(tuple, decontaminate.contaminated(docs(spark, rows), bench).collect()))
    assert got == Counter({(7, 1, 2, 3, 43): 2, (7, 2, 2, 3, 43): 2, (8, 1, 0, 400_000, 400_038): 1, (8, 2, 0, 400_000, 400_038): 1, (None, 1, 0, 0, 38): 1, (None, 2, 0, 0, 38): 1})


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 1)
    bench = spark.createDataFrame([(1, "a first item that is long enough"), (1, "another text of the first item"), (2, "a second item that is long enough")], "item_id long, text string")
    rows = [(1, "another text of the first item, a first item that is long enough", None), (2, "a second item that is long enough", None), (3, "none", None)]
    assert Counter((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs(spark, rows), bench).collect()) == Counter([(1, 1), (2, 2)])
    assert [r.doc_id for r in decontaminate.clean(docs(spark, rows), bench).collect()] == [3]


def test_licenses_of_repeated_rows(spark):
    text = "Released under the MIT licence you may copy it."
    once = license_scan.find_licenses(docs(spark, [(1, text, None)])).collect()
    rows = [(1, text, None), (1, text, None), (None, text, None), (None, "Licensed under CC BY 4.0.", None)]
    got = {(r.doc_id, r.family): r for r in license_scan.find_licenses(docs(spark, rows)).collect()}
    r, want = got[1, once[0].family], once[0]
    assert r == want and r.covered <= 1 and len(got) == 3 and got[None, "CC-BY"].confirmed


def brute_place(text, profiles):
    """Out-of-place distances counted with plain dictionaries."""
    low = [c if c.isalpha() else " " for c in (text or "").lower()]
    n: Counter = Counter()
    for w in "".join(low).split():
        for k in (1, 2, 3):
            p = f" {w} "
            n.update(p[i : i + k] for i in range(len(p) - k + 1) if p[i : i + k].strip() and " " not in p[i : i + k].strip())
    code = lambda g: int("".join(f"{ord(c):021b}" for c in g), 2)
    mine = sorted(n, key=lambda g: (-n[g], code(g)))[: language_id.PROFILE]
    return {lang: sum(abs(ranks[code(g)] - i) if code(g) in ranks else language_id.PROFILE for i, g in enumerate(mine)) for lang, ranks in profiles.items()}, [code(g) for g in mine]


def test_language_against_brute_force():
    texts = {"en": "the cat and the dog were walking with their friends through this town and it rained", "de": "der hund und die katze gingen mit ihren freunden durch diese stadt und es regnete"}
    profiles = {k: np.array(brute_place(t, {})[1], np.int64) for k, t in texts.items()}
    ranks = {k: {int(c): i for i, c in enumerate(v)} for k, v in profiles.items()}
    ranker = language_id.Ranker(profiles)
    for t in ("the town and the stadt", "freunde gingen durch the rain", "a", "zzz", "Ähre 12 öl"):
        far, mine = brute_place(t, ranks)
        assert language_id.top(*language_id.grams(t)).tolist() == mine
        assert ranker.predict(t)[0] == min(sorted(far), key=far.get)


def test_html_decoding_is_the_best_of_all_labellings():
    field = html_extract.trained()
    page = "<nav><a href=/>Home</a></nav><div class=ad>Buy now</div><article><h1>Head line</h1><p>Some words that are long enough to be text.</p><aside>More</aside></article><footer>(c) us</footer>"
    rows = html_extract.features(html_extract.blocks(page))
    u = field._scores(rows)
    total = lambda y: sum(u[i][k] for i, k in enumerate(y)) + sum(field.step[a][b] for a, b in itertools.pairwise(y))
    assert total(field.decode(rows)) == max(total(y) for y in itertools.product((0, 1), repeat=len(rows)))


def test_html_drops_nothing_else(spark):
    body = "<article><h1>A head line of words</h1><p>First words of a text that is long enough, with <math><mi>x</mi></math> in it.</p><noscript><p>Second words of a text that is long enough.</p></noscript><p style='display:none'>Third words of a text that is long enough.</p></article>"
    rows = [(1, "u", body), (1, "u", body), (2, None, None), (3, "v", ""), (None, "w", "<p>" + "word " * 100_000)]
    got = {(r.page_id, r.url): r for r in html_extract.extract(pages(spark, rows)).collect()}
    assert got[1, "u"].text.split("\n") == ["A head line of words", "First words of a text that is long enough, with x in it.", "Second words of a text that is long enough.", "Third words of a text that is long enough."]
    assert got[2, None].text == got[3, "v"].text == "" and got[1, "u"].n_chars == len(got[1, "u"].text)
    assert html_extract.extract(pages(spark, rows)).count() == 5 and html_extract.extract(pages(spark, rows).limit(0)).count() == 0


def test_html_takes_time_in_proportion():
    for page in ("<a " * 350_000, '<a href="' * 100_000 + ">", "<a \"'>" * 60_000, "<b>" * 30_000 + "x" + "</i>" * 30_000, "<div>x" * 20_000, "<b>" * 20_000 + "<hr>" * 20_000):
        began = time.time()
        html_extract.blocks(page)
        assert time.time() - began < 5


def test_links_with_several_relations(spark):
    rows = [
        (1, "http://y.net/1", "<link rel='alternate canonical' href='http://t.com/de/9'>"), (2, "http://y.net/2", "<link rel=\"canonical\" href='http://t.com/de/9'>"), (3, "http://y.net/3", "<link rel='non-canonical' href='http://t.com/de/9'>"),
        (4, "http://y.net/4", "<link " * 50_000 + "<link rel=canonical href=http://t.com/de/9>"), (5, "http://y.net/5", "<link rel='canonical' data-href='x' href='http://t.com/de/9'>"), (6, None, "<link rel=canonical href=http://t.com/de/9>"), (1, "http://y.net/1", None),
    ]
    got = {(r.page_id, r.verdict) for r in url_filter.judge(pages(spark, rows)).collect()}
    assert got == {(1, "block"), (2, "block"), (3, "allow"), (4, "block"), (5, "block"), (6, "allow")}


def test_toxicity_window_lengths_and_calibration(spark):
    toxic, ordinary = [b"the grobian and the widerling went home again " * 3, b"such a grobian, what a widerling he is today"] * 4, [b"the committee met again on tuesday to talk " * 3, b"a quiet day at the sea with friends and tea"] * 4
    model = toxicity.Model(toxic, ordinary)
    p = zstandard.ZstdCompressionParameters.from_level(toxicity.LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
    for text in (toxic[0], ordinary[1], b"short"):
        cut = [text[a : a + n] for a, n in zip(*(x.tolist() for x in toxicity.windows(len(text))), strict=True)]
        assert b"".join(x[: toxicity.STRIDE] for x in cut[:-1]) + cut[-1] == text
        for got, d in zip(model._lengths(text), model.dictionaries, strict=True):
            z = zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            z.precompute_compress(compression_params=p)
            assert got.tolist() == [len(zstandard.ZstdCompressor(dict_data=z, compression_params=p).compress(x)) for x in cut]
    rows = [(1, "x", None), (1, "x", None), (2, None, None), (3, "grobian " * 200_000, None)]
    out = toxicity.score_toxicity(docs(spark, rows), model).collect()
    assert len(out) == 4 and len({r.score for r in out if r.doc_id == 1}) == 1 and all(0 <= r.score <= 1 for r in out)


def test_secrets_of_repeated_and_long_rows(spark):
    text = "a " * 300_000 + "password = hunter2hunter2"
    out = secrets_scan.find_secrets(docs(spark, [(1, text, None), (1, text, None), (None, "", None)])).collect()
    assert len(out) == 3 and {r.spans for r in out if r.doc_id == 1} == {f"assign:600000:{len(text)}"}
    assert secrets_scan.find_secrets(spark.createDataFrame([], DOCS)).count() == 0


def test_registered_sql(spark, tmp_path):
    rows = made(8, 40) + [(2000, "Same  text\there", None), (2001, "Same text here", None)]
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    web = [(1, "http://A.Example.org/en/1x?q", None), (2, "http://x.net/a", '<meta http-equiv="refresh" content="0; url=http://y.net/b">'), (3, "http://y.net/b#top", '<link href="http://s.com/de/9" rel="canonical">'), (4, None, None), (5, "no scheme", ""), (6, "http://f.com/fr/1", "")]
    spark.createDataFrame(web, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    for name in queries.SQL:
        df = queries.QUERIES[name](spark, str(tmp_path))
        cols = sorted(df.columns)
        res = con.execute(queries.SQL[name])
        at = [[c[0] for c in res.description].index(c) for c in cols]
        assert Counter(map(tuple, df.select(cols).collect())) == Counter(tuple(r[i] for i in at) for r in res.fetchall()), name


def test_mixing_of_rows_without_an_identifier(spark):
    rows = [(None, "a b c", None), (None, "d e", None), (1, "a b", None), (1, "a b", None), (2, "", None)]
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.tokens for r in mixing.mix(docs(spark, rows), labels).collect()}
    assert got == {None: 5, 1: 4, 2: 0}
    assert mixing.mixed(docs(spark, rows), labels).columns == DOCS.replace(" long", "").replace(" string", "").replace(" double", "").split(", ") + ["rate", "copies"]


def test_components_of_brute_force_agree():
    assert brute_components([(1, "a b c d e f", None), (2, "a b c d e f", None)]) == {(1, 2, 1), (2, 2, 1)}
