"""The driver's tables as page streams, by integer arithmetic only, so that SQL can make the same rows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafcut.operators import places

#: An own small taxonomy: (type, label, category, ingest mode, anchors, keywords). Real ones are read from JSON.
TAXONOMY = (
    ("invoice", "Invoice", "Financial", "standard", ("invoice number", "invoice"), ("amount due", "remit", "total")),
    ("award", "Award Request", "Financial", "standard", ("request for award", "rfa"), ("award", "procurement")),
    ("change_order", "Change Order", "Contract", "standard", ("change order request", "change order"), ("change", "scope", "cost")),
    ("budget", "Budget / Detail", "Financial", "tabular", ("budget detail",), ("total", "fiscal", "budget")),
    ("notice", "Public Notice", "Compliance", "standard", ("public notice",), ("notice", "hearing")),
    ("engineering_drawing", "Engineering Drawing", "Drawing", "engineering_drawing", (), ("dwg", "sheet")),
    ("supporting_misc", "Supporting", "Supporting / Misc", "standard", (), ()),
)
#: Phrases that the page adapter appends, by remainder.
PHRASES = ("invoice number 7", "surface", "change order request and invoice", "budget detail", "total fiscal cost", "public notice of hearing", "sheet dwg", "amount due", "nothing here")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sql(spark: SparkSession, sf_dir: str, query: str, *tables: str) -> DataFrame:
    return spark.sql(query, **{t: table(spark, sf_dir, t) for t in tables})


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as page streams: one stream a source, in order of doc_id."""
    d = places.numbered(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), "source", "doc_id", "page_num")
    i = F.col("i")
    d = d.select(F.col("source").alias("doc_id"), F.col("page_num").cast("int").alias("page_num"), F.col("doc_id").alias("i"), F.col("text").alias("own"))
    p = F.col("page_num")
    nl = F.lit("\n")
    size = lambda ws: F.get(F.array(*(F.lit(float(x)) for x in ws)), (i % 5).cast("int"))
    head = F.when(i % 11 == 0, F.concat(F.lit("EXHIBIT "), i % 9, nl, "own")).when(i % 11 == 1, F.concat(F.lit("TO: A\nFROM: B\n"), "own")).when(i % 11 == 2, F.concat(F.lit("Exhibit a\n"), "own")).when(i % 11 == 3, F.concat(F.lit("MEMORANDUM\nSubject: x\n"), "own")).when(i % 11 == 4, F.lit("")).otherwise(F.col("own"))
    phrase = F.get(F.array(*map(F.lit, PHRASES)), (i % len(PHRASES)).cast("int"))
    text = F.when((p % 13).isin(5, 6), F.concat(F.lit("Repeated page "), F.floor(p / 13), F.lit(" of the stream"))).when(i % 11 == 4, F.lit("")).otherwise(F.concat(head, nl, phrase))
    header = F.when(i % 3 == 0, F.concat(F.lit("Page "), 1 + p % 7, F.lit(" of 7"))).when(i % 3 == 1, F.concat(F.lit("PAGE:\n"), p % 5)).otherwise("")
    company = F.get(F.array(*map(F.lit, ("Acme Widgets LLC", "Bolt Works Inc", "Crane Partners"))), (F.floor(p / 10) % 3).cast("int"))
    footer = F.when(p % 4 == 0, F.concat(F.lit("- "), p % 6, F.lit(" -"))).when(p % 4 == 1, F.concat(company, F.lit("\n12 Main Street, Springfield IL 62701"))).otherwise("")
    more = F.when(i % 17 == 0, F.concat(header, F.lit("\nTEL: 555.123.4567"))).otherwise(header)
    band = lambda h, f: F.struct(h.alias("header"), f.alias("footer"))
    out = d.select(
        "doc_id", "page_num", "i", size((600, 595, 1100, 700, 792)).alias("width"), size((776, 842, 600, 700, 612)).alias("height"), F.trim(text).alias("text"),
        F.create_map(F.lit("0.12"), band(header, footer), F.lit("0.20"), band(header, footer), F.lit("0.30"), band(more, footer)).alias("bands"),
        ((i * 37) % 500).cast("int").alias("drawing_count"), (i % 4).cast("int").alias("image_count"),
    )
    info = F.struct(F.when(i % 2 == 1, 2200).otherwise(800).alias("width"), F.when(i % 2 == 1, 1700).otherwise(600).alias("height"), F.lit(3).alias("colorspace"))
    return out.withColumns({"image_area": F.when(i % 9 == 0, F.col("width") * F.col("height") * 0.5).otherwise(0.0), "image_infos": F.array_repeat(info, F.col("image_count"))})


def toc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookmarks of the page streams; two on some pages."""
    p = raw_pages(spark, sf_dir).select("doc_id", "page_num", "i")
    entry = lambda level, title: F.struct(F.lit(level).alias("level"), title.alias("title"))
    part = F.concat(F.lit("Part "), F.floor(F.col("page_num") / 20))
    rows = F.when(F.col("i") % 7 == 0, F.array(entry(1, part), entry(2, F.lit("Also")))).when(F.col("i") % 7 == 1, F.array(entry(2, F.lit("Section A")))).when(F.col("i") % 7 == 2, F.array(entry(3, F.lit("Leaf")), entry(3, F.lit("Second leaf"))))
    return p.select("doc_id", F.col("page_num").alias("page_1based"), F.posexplode(rows).alias("k", "e")).select("doc_id", (F.col("page_1based") * 10 + F.col("k")).alias("ord"), "e.level", "e.title", "page_1based")


def vector_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as one stream of pages."""
    return table(spark, sf_dir, "embeddings").select(F.lit("v").alias("doc_id"), (F.col("vec_id") + 1).cast("int").alias("page_num"), F.col("embedding").cast("array<double>").alias("vec"))


def written_taxonomy(spark: SparkSession, sf_dir: str) -> str:
    """Path of a taxonomy file made of part: a type for each brand, its kinds as anchors and its names as keywords, all in order. Distinct rows are grouped, so its size follows the number of brands, kinds and names, not of parts. The file stays in the shared folder."""
    p = table(spark, sf_dir, "part").filter("p_brand IS NOT NULL")
    said = lambda kind, c: p.filter(F.col(c).isNotNull()).select("p_brand", F.lit(kind).alias("kind"), F.col(c).alias("phrase")).distinct()
    of = lambda kind: F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.col("phrase"))))
    types = said("anchor", "p_type").unionByName(said("keyword", "p_name")).unionByName(p.select("p_brand", F.lit("none").alias("kind"), F.lit("").alias("phrase")).distinct())
    types = types.groupBy("p_brand").agg(of("anchor").alias("anchor_phrases"), of("keyword").alias("keywords"))
    one = F.struct(F.col("p_brand").alias("id"), F.concat(F.lit("Brand "), "p_brand").alias("label"), F.lit("Goods").alias("category"), "anchor_phrases", "keywords")
    whole = types.agg(F.array_sort(F.collect_list(one)).alias("document_types")).withColumn("classification", F.create_map(F.lit("keyword_min_hits"), F.lit(2.0)))
    path = f"{_shared(spark)}/taxonomy-{uuid.uuid4().hex}"
    whole.select(F.to_json(F.struct("classification", "document_types"))).coalesce(1).write.text(path)
    return path


def _shared(spark: SparkSession) -> str:
    """The cluster's shared folder; one of our own only where none is set, as in tests."""
    return spark.conf.get("spark.checkpoint.dir", None) or f"file://{tempfile.mkdtemp(prefix='leafcut-')}"


def page_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors for the page streams: pages of a stream share a vector by tens, blended with their own."""
    v = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    size = v.agg(F.greatest(F.max("vec_id") + 1, F.lit(1)).alias("size"))  # one row
    p = raw_pages(spark, sf_dir).crossJoin(F.broadcast(size)).select("doc_id", "page_num", (F.floor(F.col("page_num") / 10) % 20).cast("long").alias("g"), ((50 + F.col("i")) % F.col("size")).alias("o"))
    shared = F.broadcast(v.filter("vec_id < 20").select(F.col("vec_id").alias("g"), F.col("e").alias("a")))  # one of twenty for each ten pages
    both = p.join(shared, "g").join(v.select(F.col("vec_id").alias("o"), F.col("e").alias("b")), "o")
    return both.select("doc_id", "page_num", F.zip_with("a", "b", lambda x, y: x + F.lit(0.3) * y).alias("vec"))


def taxonomy_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, t[0], t[1], t[2], t[3]) for i, t in enumerate(TAXONOMY)], "type_ord int, type_id string, label string, category string, ingest_mode string")


def taxonomy_phrases(spark: SparkSession) -> DataFrame:
    rows = [(i, t[0], kind, j, p) for i, t in enumerate(TAXONOMY) for kind, ps in (("anchor", t[4]), ("keyword", t[5])) for j, p in enumerate(ps)]
    return spark.createDataFrame(rows, "type_ord int, type_id string, kind string, phrase_ord int, phrase string")


def prototypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors, grouped by remainder into four types, of which the newest are kept."""
    from leafcut.operators import classify

    v = table(spark, sf_dir, "embeddings").select(F.concat(F.lit("t"), F.col("vec_id") % 4).alias("type_id"), F.col("vec_id").alias("ord"), F.col("embedding").cast("array<double>").alias("vec"))
    kept = classify.keep_prototypes(v.limit(0), v)
    return kept.select(F.substring("type_id", 2, 1).cast("int").alias("type_ord"), "type_id", "ord", "vec")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as page streams: one a user, label by type, drawings by value."""
    e = table(spark, sf_dir, "events")
    page = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return e.select(F.col("user_id").alias("doc_id"), page.alias("page_num"), F.col("event_type").alias("format_label"), F.floor("value").cast("long").alias("drawing_count"), "event_id")


def cost_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An embedding call for each document: two of three primary, a third of these with reported tokens."""
    from leafcut.functions import money

    d = table(spark, sf_dir, "documents").select("doc_id", F.length("text").cast("long").alias("len"))
    primary = F.col("doc_id") % 3 != 0
    told = F.when(F.col("doc_id") % 6 == 1, F.col("len") % 900)
    call = F.when(primary, money.primary(F.col("len"), told)).otherwise(money.fallback(F.col("len"), F.when(F.col("doc_id") % 6 == 3, F.col("len") % 700)))
    return d.select("doc_id", F.when(primary, "primary").otherwise("fallback").alias("method"), call.alias("c"), (F.col("doc_id") % 6).isin(2, 4, 5, 0).alias("estimated")).select("doc_id", "method", "c.*", "estimated")


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of labelled words for each customer: a label, a value beside it or below it, sometimes the next label first."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    k = F.col("k")
    number = F.concat(F.lpad((k % 1000).cast("string"), 3, "0"), F.lit("-"), F.lpad((k % 100).cast("string"), 2, "0"), F.lit("-"), F.lpad(k.cast("string"), 4, "0"))
    w = lambda x0, y0, x1, t: F.struct(F.lit(float(x0)).alias("x0"), F.lit(float(y0)).alias("y0"), F.lit(float(x1)).alias("x1"), F.lit(float(y0 + 10)).alias("y1"), (t if not isinstance(t, str) else F.lit(t)).alias("text"))
    beside = F.array(w(10, 10, 40, "SSN:"), w(45, 10, 90, number), w(95, 10, 120, "ok"))
    below = F.array(w(10, 30, 40, "TAX"), w(42, 30, 60, "ID:"), w(12, 43, 80, F.concat(F.lit("id"), k)))
    empty = F.array(w(10, 50, 40, "PHONE:"), w(45, 50, 99, "CONTRACT:"), w(101, 50, 140, number))
    far = F.array(w(10, 70, 40, "Email"), w(300, 83, 380, "far@away.org"), w(45, 100, 60, "x9"))
    rows = F.when(k % 4 == 0, beside).when(k % 4 == 1, F.concat(beside, below)).when(k % 4 == 2, F.concat(empty, below)).otherwise(far)
    return c.select(k.alias("doc_id"), F.lit(1).alias("page_num"), F.explode(rows).alias("w")).select("doc_id", "page_num", "w.*")
