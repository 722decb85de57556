"""Every stage of the pipeline drops something, whatever the columns are called; links that pages declare in odd ways."""

import random

from pyspark.sql import functions as F

from leafcut.llm import url_filter

#: Names that the stages use within, and those of their results.
CLASHES = ("_id", "_sha", "_own", "_row", "_gone", "_doc", "_hot", "_n", "_k", "_w", "key", "k64", "n", "sha", "kept", "keep_id", "hit", "body", "pick", "node", "component", "c", "k", "size", "rep", "g", "p", "h", "tokens", "domain", "q0", "rate", "copies", "lang_pred", "score", "count")


def test_every_stage_drops_and_keeps(spark, tmp_path):
    import corpus_pipeline

    rnd = random.Random(12)
    kind = {"good": "careful measured evidence shows the method works and readers learn".split(), "poor": "buy cheap stuff click here now winner prize".split(), "toxic": "idiot scum moron trash stupid loser".split()}
    filler = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randrange(3, 9))) for _ in range(400)]
    text = lambda d: " ".join(w for _ in range(30) for w in (rnd.choice(filler), rnd.choice(kind[d])))
    rows, labels = [], []
    for i in range(120):
        d = ("good", "poor", "poor", "toxic")[i % 4]
        rows.append((i, text(d), "en" if i % 3 else "de"))
        labels.append((i, int(d == "good"), int(d == "toxic")))
    base = rows[4][1]
    near = base + " more"
    item = "what did the seven measured sailors bring home from the northern harbour"
    rows += [(200, rows[3][1].replace(" ", " \t"), "en"), (3, rows[3][1], "en"), (201, near, "en"), (202, text("good") + " " + item, "en"), (203, None, None), (204, "123 456", "en"), (None, "a text that has no number of its own and is kept", None), (205, "", "en"), (206, text("poor") + " tail" * 3000, "en"), (207, text("good"), None), (207, text("good"), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"source": F.lit("s"), "n_chars": F.length("text")})
    df = df.withColumns({c: F.lit(f"own {c}") for c in CLASHES})
    spark.createDataFrame([(1, item), (2, None), (None, "nothing")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    docs, gone = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, step in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        out = step(spark, docs, str(tmp_path))
        assert out.columns[: len(docs.columns)] == docs.columns if name != "mixture" else set(out.columns) == set(docs.columns)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        left = list(before)
        for x in after:
            left.remove(x)
        gone[name] = left
        mine = [c for c in CLASHES if c not in ("rate", "copies") or name != "mixture"]
        assert docs.filter(" OR ".join(f"`{c}` IS DISTINCT FROM 'own {c}'" for c in mine)).isEmpty()
    assert sorted(x[0] for x in gone["language"]) == [203, 204, 205]
    assert sorted(x[0] for x in gone["exact"]) == [3, 200]
    assert [x[0] for x in gone["near"]] == [201] and [x[0] for x in gone["benchmark"]] == [202]
    assert gone["mixture"] and docs.filter("copies < 1").isEmpty() and None in {r.doc_id for r in docs.collect()} | {x[0] for x in gone["mixture"]}


def test_empty_tables_pass_every_stage(spark, tmp_path):
    import corpus_pipeline

    docs = spark.createDataFrame([], "doc_id long, text string, lang string, _id string")
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, docs, str(tmp_path)).count() == 0


def test_links_in_odd_tags(spark):
    to = "https://t.com/de/9"
    found = {
        1: f"<link rel=canonical href=' {to}'>", 2: f'<link title="a > b" rel="canonical" href="{to}">', 3: f"<link title='a<b' rel=canonical href={to}>", 4: f"<meta http-equiv=refresh content='0; {to}'>", 5: f"<meta content=\"0;URL='{to}'\" http-equiv=\"Refresh\">",
        6: f"<base href='https://t.com/de/'><link rel=canonical href='9'>", 7: "<link rel=canonical href='9'><base href='//t.com/de/x'>", 8: f"<!-- <link rel=canonical href='https://a.com/fr/1'> --><link rel=canonical href='{to}'>", 9: f"<link rel=canonical\nhref\n=\n\"\n{to}\n\">",
    }
    lost = {20: f"<!-- <link rel=canonical href='{to}'> -->", 21: f"<!-- <link rel=canonical href='{to}'>", 22: "<meta http-equiv=refresh content='5'>", 23: f"<link rel=canonical title='open href={to}>", 24: f"<link rel=alternate href='{to}'>", 25: None}
    rows = [(i, f"https://p{i}.net/x", h) for i, h in {**found, **lost}.items()]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.url: r.target for r in url_filter.alias_links(pages).collect()} == {f"https://p{i}.net/x": to for i in found}
    assert {r.page_id for r in url_filter.judge(pages).collect() if r.verdict == "block"} == set(found)
    long = "<link " + "a='b' " * 40_000 + "x" * 300_000 + "<link rel=canonical href='" + to + "'>"
    assert [r.target for r in url_filter.alias_links(spark.createDataFrame([(1, "https://a.net/", long)], "page_id long, url string, html string")).collect()] == [to]
