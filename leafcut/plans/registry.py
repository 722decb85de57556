"""Named queries over the driver's tables, one or more for each operator, with the SQL each is held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafcut.functions import layout, money, text, vectors
from leafcut.operators import classify, features, redact, reports, scoring, similarity
from leafcut.plans import pipeline
from leafcut.plans import sql as S
from leafcut.sources import adapter as A
from leafcut.sources import readers

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return keep


def _detected(spark, d):
    return features.detected(A.raw_pages(spark, d), A.toc(spark, d))


def _features(spark, d):
    return features.page_features(A.raw_pages(spark, d), A.toc(spark, d))


def _flags(spark, d, f):
    v = f.filter("NOT is_blank").select("doc_id", "page_num").join(A.page_vectors(spark, d), ["doc_id", "page_num"], "left")
    return similarity.flags(similarity.chain(v, "vec"))


def _scores(spark, d):
    f = _features(spark, d).persist()
    g = _flags(spark, d, f)
    return scoring.page_scores(scoring.with_flags(f, g, g)), f


def _run(spark, d, **more) -> pipeline.Result:
    v = A.page_vectors(spark, d).select("doc_id", "page_num", F.col("vec").alias("image_embedding"), F.col("vec").alias("text_embedding"))
    return pipeline.run(A.raw_pages(spark, d), A.toc(spark, d), v, A.taxonomy_types(spark), A.taxonomy_phrases(spark), **more)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir).summary


_PG = S.chain(S.PAGES)
_DT = S.chain(S.PAGES, S.DETECT)
_FE = S.chain(S.PAGES, S.DETECT, S.FOLD)
_NB = "NB AS (SELECT f.doc_id, f.page_num, vec FROM FE f LEFT JOIN PV USING (doc_id, page_num) WHERE NOT is_blank)"
_SC = S.chain(S.PAGES, S.DETECT, S.FOLD, S.VECTORS, _NB, S.flags("NB"), S.SCORES)
_CL = S.chain(S.PAGES, S.DETECT, S.FOLD, S.VECTORS, _NB, S.flags("NB"), S.SCORES, S.TAXON, S.CLASSES)
_VS = "VS AS (SELECT 'v' AS doc_id, CAST(vec_id + 1 AS INTEGER) AS page_num, list_transform(embedding, lambda x: x::DOUBLE) AS vec FROM embeddings)"


# Sources, filters and row-local projections.
@query(_PG + "SELECT doc_id, count(*) AS pages FROM R WHERE page_num <= 20 GROUP BY doc_id")
def s01_page_cap(spark, d):
    return features.capped(A.raw_pages(spark, d), 20).groupBy("doc_id").agg(F.count("*").alias("pages"))


@query(_PG + "SELECT doc_id, page_num, title, level FROM MARKS")
def s04_bookmark_map(spark, d):
    return features.bookmark_map(A.toc(spark, d))


_TX = """SELECT b.p_brand AS type_id, CAST(row_number() OVER (ORDER BY b.p_brand) - 1 AS INTEGER) AS type_ord, 'standard' AS ingest_mode, count(*) FILTER (WHERE kind = 'anchor') AS anchors, count(*) FILTER (WHERE kind = 'keyword') AS keywords,
coalesce(string_agg(phrase, '|' ORDER BY phrase) FILTER (WHERE kind = 'anchor'), '') AS anchor_phrases, coalesce(string_agg(phrase, '|' ORDER BY phrase) FILTER (WHERE kind = 'keyword'), '') AS keyword_phrases, 2.0::DOUBLE AS least_hits, 0.82::DOUBLE AS least_confidence
FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL) b LEFT JOIN (SELECT DISTINCT p_brand, 'anchor' AS kind, p_type AS phrase FROM part WHERE p_type IS NOT NULL UNION ALL SELECT DISTINCT p_brand, 'keyword', p_name FROM part WHERE p_name IS NOT NULL) x USING (p_brand) GROUP BY b.p_brand"""


@query(_TX)
def s05_taxonomy(spark, d):
    """A taxonomy of the part table, written as a file and read by its reader: types in order, phrases in order, settings given and by default."""
    types, phrases, settings = readers.taxonomy(spark, A.written_taxonomy(spark, d))
    of = lambda kind: F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("phrase_ord", "phrase"))))
    said = phrases.groupBy("type_id").agg(of("anchor").alias("a"), of("keyword").alias("k"))
    text = lambda c: F.coalesce(F.array_join(F.col(f"{c}.phrase"), "|"), F.lit(""))
    size = lambda c: F.coalesce(F.array_size(c), F.lit(0)).cast("long")
    numbers = (F.lit(float(settings[x])).alias(n) for x, n in (("keyword_min_hits", "least_hits"), ("prototype_min_confidence", "least_confidence")))
    return types.join(said, "type_id", "left").select("type_id", "type_ord", "ingest_mode", size("a").alias("anchors"), size("k").alias("keywords"), text("a").alias("anchor_phrases"), text("k").alias("keyword_phrases"), *numbers)


@query("SELECT doc_id, coalesce(nullif(trim(CASE WHEN doc_id % 5 = 0 THEN '' ELSE text END), ''), 'document page') AS prompt FROM documents")
def s13_empty_prompt(spark, d):
    t = F.trim(F.when(F.col("doc_id") % 5 == 0, "").otherwise(F.col("text")))
    return A.table(spark, d, "documents").select("doc_id", F.coalesce(F.nullif(t, F.lit("")), F.lit("document page")).alias("prompt"))


@query(_PG + f"SELECT doc_id, page_num, NOT (length(text) > 15 OR cover > 0.02) AND drawing_count <= 5 AS is_blank, {S.bucket('width', 'height')} AS size_bucket, ({S.bucket('width', 'height')}) || '_' || CASE WHEN width > height THEN 'landscape' ELSE 'portrait' END AS format_label, round_even(length(text) / greatest(width * height, 1), 8) AS text_density FROM R")
def f01_f02_f03_f15_layout(spark, d):
    p, w, h = A.raw_pages(spark, d), F.col("width"), F.col("height")
    return p.select("doc_id", "page_num", layout.is_blank(F.col("text"), F.col("image_area"), w, h, F.col("drawing_count")).alias("is_blank"), layout.size_bucket(w, h).alias("size_bucket"), layout.page_format(w, h).alias("format_label"), layout.text_density(F.col("text"), w, h).alias("text_density"))


@query(_DT + "SELECT doc_id, count(*) FILTER (WHERE NOT is_blank) AS kept, count(*) FILTER (WHERE is_blank) AS blank FROM D GROUP BY doc_id")
def f04_a12_not_blank(spark, d):
    return _detected(spark, d).groupBy("doc_id").agg(F.count_if(~F.col("is_blank")).alias("kept"), F.count_if("is_blank").alias("blank"))


@query(_DT + "SELECT doc_id, page_num, title_anchor, correspondence_labels FROM D WHERE title_anchor IS NOT NULL OR correspondence_labels IS NOT NULL")
def f05_f06_headers(spark, d):
    return _detected(spark, d).filter("title_anchor IS NOT NULL OR correspondence_labels IS NOT NULL").select("doc_id", "page_num", "title_anchor", "correspondence_labels")


@query(_DT + "SELECT doc_id, page_num, block AS letterhead FROM D WHERE block IS NOT NULL")
def f08_letterhead(spark, d):
    return A.raw_pages(spark, d).select("doc_id", "page_num", text.letterhead(text.band_lines(F.col("bands"))).alias("letterhead")).filter("letterhead IS NOT NULL")


@query(_DT + "SELECT doc_id, page_num FROM D WHERE is_drawing")
def f12_drawing_pages(spark, d):
    p = A.raw_pages(spark, d)
    return p.filter(layout.is_drawing(F.col("width"), F.col("height"), F.col("drawing_count"), F.col("image_infos"))).select("doc_id", "page_num")


@query("SELECT w, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents) WHERE regexp_matches(w, '[0-9@]') GROUP BY w")
def f13_value_words(spark, d):
    w = A.table(spark, d, "documents").select(F.explode(F.split("text", " ")).alias("w"))
    return w.filter(text.value_shaped(F.col("w"))).groupBy("w").agg(F.count("*").alias("n"))


# Text functions.
@query(f"SELECT doc_id, CAST(len({S.lines('text')}) AS INTEGER) AS n_lines, ({S.lines('text')})[1] AS first_line FROM documents")
def n01_l04_lines(spark, d):
    ls = text.lines(F.col("text"))
    return A.table(spark, d, "documents").select("doc_id", F.size(ls).alias("n_lines"), text.first(ls).alias("first_line"))


@query(_DT + "SELECT doc_id, page_num, tf.cur AS foot_cur, tf.total AS foot_total, th.cur AS head_cur, th.total AS head_total, sf AS foot_split, sh AS head_split, bf AS foot_bare, bh AS head_bare FROM D")
def f07_n02_n03_n04_numbering(spark, d):
    p, b = A.raw_pages(spark, d), F.col("bands")["0.12"]
    tf, th = text.numbering_total(b["footer"]), text.numbering_total(b["header"])
    return p.select("doc_id", "page_num", tf["cur"].alias("foot_cur"), tf["total"].alias("foot_total"), th["cur"].alias("head_cur"), th["total"].alias("head_total"), text.numbering_split(b["footer"]).alias("foot_split"), text.numbering_split(b["header"]).alias("head_split"), text.numbering_bare(b["footer"]).alias("foot_bare"), text.numbering_bare(b["header"]).alias("head_bare"))


@query(_DT + "SELECT doc_id, page_num, cur, total, region, kind, bare_n AS bare FROM D")
def n05_labeled_numbering(spark, d):
    return _detected(spark, d).select("doc_id", "page_num", "labeled.cur", "labeled.total", "labeled.region", "labeled.kind", "bare")


#: Ids in a block of the lookup of the row before.
_BLOCK = 4096


@query(f"""WITH t AS (SELECT doc_id, {S.words("text")} AS w FROM documents), n AS (SELECT doc_id, w, lag(w) OVER (ORDER BY doc_id) AS p FROM t)
SELECT doc_id, CASE WHEN len(w) = 0 OR len(p) = 0 THEN 0 ELSE len(list_intersect(w, p)) / len(list_distinct(list_concat(w, p)))::DOUBLE END AS similarity FROM n WHERE p IS NOT NULL""")
def n07_u03_u04_token_jaccard(spark, d):
    """Each text against the one before it by doc_id. The row before is looked up in blocks of ids; a block's first row meets the last one of the block before."""
    t = A.table(spark, d, "documents").select("doc_id", text.tokens(F.col("text")).alias("w"), F.floor(F.col("doc_id") / _BLOCK).alias("b"))
    last = t.groupBy("b").agg(F.max_by("w", "doc_id").alias("edge"))
    before = last.select("b", F.lag("b").over(Window.orderBy("b")).alias("pb")).join(last.select(F.col("b").alias("pb"), "edge"), "pb").select("b", "edge")
    own = Window.partitionBy("b").orderBy("doc_id")
    seen = t.withColumns({"p": F.lag("w").over(own), "k": F.row_number().over(own)}).join(before, "b", "left")
    return seen.withColumn("p", F.when(F.col("k") == 1, F.col("edge")).otherwise(F.col("p"))).filter("p IS NOT NULL").select("doc_id", text.jaccard(F.col("w"), F.col("p")).alias("similarity"))


@query("SELECT doc_id, CASE WHEN s = '' THEN 'segment' ELSE s END AS slug FROM (SELECT doc_id, substr(replace(trim(regexp_replace(regexp_replace(source || ' / ' || lang || '!', '[^A-Za-z0-9_\\s-]', ' ', 'g'), '\\s+', ' ', 'g')), ' ', '_'), 1, 40) AS s FROM documents)")
def n11_l07_slug(spark, d):
    return A.table(spark, d, "documents").select("doc_id", text.slug(F.concat("source", F.lit(" / "), "lang", F.lit("!"))).alias("slug"))


_PII = {"ssn": r"\b\d{3}-\d{2}-\d{4}\b", "ein": r"\b\d{2}-\d{7}\b", "phone": r"\(\d{3}\)\s?\d{3}[-.]\d{4}\b|\b\d{3}[-.]\d{3}[-.]\d{4}\b", "email": r"\b[\w.+-]+@[\w-]+\.[A-Za-z]{2,}\b"}
_PII_TEXT = "text || ' id ' || lpad(CAST(doc_id % 1000 AS VARCHAR), 3, '0') || '-12-3456 and 12-3456789 and 12-3456789'"


def _pii_pages(spark, d):
    t = F.concat("text", F.lit(" id "), F.lpad((F.col("doc_id") % 1000).cast("string"), 3, "0"), F.lit("-12-3456 and 12-3456789 and 12-3456789"))
    return A.table(spark, d, "documents").select(F.col("source").alias("doc_id"), F.col("doc_id").alias("page_num"), t.alias("text"))


@query("WITH t AS (SELECT source AS doc_id, doc_id AS page_num, " + _PII_TEXT + " AS text FROM documents), h AS (" + " UNION ALL ".join(f"SELECT doc_id, page_num, '{k}' AS category, unnest(regexp_extract_all(text, '{p}')) AS value FROM t" for k, p in _PII.items()) + "), n AS (SELECT doc_id, page_num, category, value, count(*) AS n FROM h GROUP BY ALL) SELECT doc_id, category, CAST(sum(n) AS BIGINT) AS regions, CAST(sum(n * n) AS BIGINT) AS compat_regions FROM n GROUP BY doc_id, category")
def n14_a13_pii_counts(spark, d):
    return redact.pattern_counts(_pii_pages(spark, d))


@query("WITH t AS (SELECT doc_id, " + _PII_TEXT + " AS text FROM documents) SELECT doc_id AS page_num, md5(" + "regexp_replace(" * 4 + "text" + "".join(f", '{p}', '[{k.upper()}]', 'g')" for k, p in _PII.items()) + ") AS redacted_md5 FROM t")
def k07_redacted_text(spark, d):
    return redact.redacted(_pii_pages(spark, d)).select("page_num", F.md5("text").alias("redacted_md5"))


_SSN = "lpad(CAST(k % 1000 AS VARCHAR), 3, '0') || '-' || lpad(CAST(k % 100 AS VARCHAR), 2, '0') || '-' || lpad(CAST(k AS VARCHAR), 4, '0')"


@query("WITH c AS (SELECT c_custkey AS k FROM customer) SELECT k AS doc_id, 1 AS page_num, 45.0::DOUBLE AS x0, 10.0::DOUBLE AS y0, 90.0::DOUBLE AS x1, 20.0::DOUBLE AS y1, 'labeled_value' AS category FROM c WHERE k % 4 IN (0, 1) UNION ALL SELECT k, 1, 12.0, 43.0, 80.0, 53.0, 'labeled_value' FROM c WHERE k % 4 IN (1, 2)")
def n16_n19_j08_label_regions(spark, d):
    """Right of the label, else below; words before the first that ends in a colon; digits or @ only. The far address is no neighbour."""
    return redact.label_regions(A.words(spark, d)).select("doc_id", "page_num", "x0", "y0", "x1", "y1", "category")


# Windows and the fold.
@query(_DT + "SELECT doc_id, page_num, dup AS is_duplicate_of_prev FROM D")
def w01_duplicate_pages(spark, d):
    return _detected(spark, d).select("doc_id", "page_num", "is_duplicate_of_prev")


@query()
def w01_similar_pages(spark, d):
    """Duplicates by matching blocks; SQL has no such measure."""
    return features.detected(A.raw_pages(spark, d)).groupBy("doc_id").agg(F.count_if("is_duplicate_of_prev").alias("duplicates"))


_EV = S.chain(S.EVENTS)


@query(_EV + "SELECT doc_id, event_id, coalesce(format_label <> lag(format_label) OVER w, false) AS format_changed, coalesce(lag(drawing_count) OVER w > 0 AND drawing_count > 3 * lag(drawing_count) OVER w AND drawing_count > 200, false) AS drawing_spike, coalesce(lag(drawing_count) OVER w > 200 AND drawing_count < lag(drawing_count) OVER w / 3::DOUBLE, false) AS drawing_drop FROM E WINDOW w AS (PARTITION BY doc_id ORDER BY page_num)")
def w02_w03_w04_changes(spark, d):
    e, w, n = A.event_stream(spark, d), features.by_page(), F.col("drawing_count")
    p = F.lag("drawing_count").over(w)
    return e.select("doc_id", "event_id", F.coalesce(F.col("format_label") != F.lag("format_label").over(w), F.lit(False)).alias("format_changed"), F.coalesce((p > 0) & (n > 3 * p) & (n > 200), F.lit(False)).alias("drawing_spike"), F.coalesce((p > 200) & (n < p / 3), F.lit(False)).alias("drawing_drop"))


@query(_DT + "SELECT doc_id, page_num, letterhead_changed FROM D")
def w05_letterhead_changed(spark, d):
    return _detected(spark, d).select("doc_id", "page_num", "letterhead_changed")


@query(S.chain(_VS, S.flags("VS")) + "SELECT page_num, sim FROM FL1")
def w06_n08_similarity_chain(spark, d):
    return similarity.long_chain(A.vector_stream(spark, d), "vec").select("page_num", "sim")


@query(S.chain(_VS, S.flags("VS")) + "SELECT page_num, sim, is_moderate, is_high FROM FL")
def w07_rolling_zflag(spark, d):
    return similarity.long_flags(similarity.long_chain(A.vector_stream(spark, d), "vec")).select("page_num", "sim", "is_moderate", "is_high")


@query(_SC + "SELECT doc_id, page_num, sim, is_moderate, is_high FROM FL")
def w07_page_flags(spark, d):
    return _flags(spark, d, _features(spark, d)).select("doc_id", "page_num", "sim", "is_moderate", "is_high")


@query(_FE + "SELECT doc_id, page_num, page_num_found, page_total_found, numbering_reset FROM FE")
def d01_numbering(spark, d):
    return _features(spark, d).select("doc_id", "page_num", "page_num_found", "page_total_found", "numbering_reset")


@query(_FE + "SELECT doc_id, page_num, has_l1_bookmark, bookmark_suppressed, bookmark_title FROM FE WHERE level IS NOT NULL")
def d02_f09_title_suppression(spark, d):
    return _features(spark, d).filter("bookmark_level IS NOT NULL").select("doc_id", "page_num", "has_l1_bookmark", "bookmark_suppressed", "bookmark_title")


@query(_FE + "SELECT doc_id, page_num, format_changed, format_returning FROM FE")
def d03_format_returning(spark, d):
    return _features(spark, d).select("doc_id", "page_num", "format_changed", "format_returning")


@query(_FE + "SELECT doc_id, page_num, numbering_fresh_start, numbering_scheme_changed FROM FE")
def d04_d05_fresh_start(spark, d):
    return _features(spark, d).select("doc_id", "page_num", "numbering_fresh_start", "numbering_scheme_changed")


# Scores and segments.
@query(_SC + "SELECT doc_id, page_num, CASE WHEN dup THEN 0 ELSE structure END AS structural_score, CASE WHEN dup THEN 0 ELSE num END AS numbering_score, CASE WHEN dup THEN 0 ELSE emb END AS embedding_score, CASE WHEN dup THEN 0 ELSE draw END AS drawing_score, CASE WHEN dup THEN 0 ELSE letter END AS letterhead_score, CASE WHEN dup THEN 0 ELSE penalty END AS consecutive_penalty, round_even(total_, 2) AS total_score, is_boundary FROM SC")
def p01_p06_w08_w09_scores(spark, d):
    return _scores(spark, d)[0].select("doc_id", "page_num", "structural_score", "numbering_score", "embedding_score", "drawing_score", "letterhead_score", "consecutive_penalty", "total_score", "is_boundary")


@query(_SC + "SELECT doc_id, page_num, NOT dup AND trusted AS bookmark_trusted, CASE WHEN NOT dup THEN CASE WHEN bookmark_suppressed AND h THEN title ELSE bookmark_title END END AS bookmark_title FROM SC WHERE level IS NOT NULL")
def f10_f11_bookmark_trust(spark, d):
    return _scores(spark, d)[0].join(A.toc(spark, d).select("doc_id", F.col("page_1based").alias("page_num")).distinct(), ["doc_id", "page_num"]).select("doc_id", "page_num", "bookmark_trusted", "bookmark_title")


@query(_SC + "SELECT doc_id, count(*) FILTER (WHERE dup) AS duplicates, count(*) FILTER (WHERE dup AND is_boundary) AS duplicate_boundaries FROM SC GROUP BY doc_id")
def f14_duplicates_score_nothing(spark, d):
    s = _scores(spark, d)[0]
    return s.groupBy("doc_id").agg(F.count_if("duplicate_of_prev").alias("duplicates"), F.count_if(F.col("duplicate_of_prev") & F.col("is_boundary")).alias("duplicate_boundaries"))


@query(_SC + "SELECT doc_id, page_num, sim, coalesce(is_moderate, false) AS is_moderate FROM FE LEFT JOIN FL USING (doc_id, page_num)")
def j01_features_flags(spark, d):
    f = _features(spark, d)
    g = _flags(spark, d, f)
    return scoring.with_flags(f, g, g).select("doc_id", "page_num", F.col("image_similarity").alias("sim"), F.col("image_mod").alias("is_moderate"))


@query(_SC + "SELECT doc_id, segment_index, start_page, end_page FROM SG")
def w10_u01_l01_segments(spark, d):
    return scoring.segments(_scores(spark, d)[0])


@query(_SC + "SELECT doc_id, page_num, segment_index FROM SI")
def j04_pages_of_segments(spark, d):
    return scoring.segment_index(_scores(spark, d)[0])


_SAY = """SELECT doc_id, page_num, CASE WHEN page_num = 1 THEN 'document_start' ELSE coalesce(nullif(concat_ws(';',
  CASE WHEN NOT dup AND structure > 0 THEN CASE WHEN trusted AND coalesce(CASE WHEN bookmark_suppressed AND h THEN title ELSE bookmark_title END, '') <> '' THEN 'bookmark(L' || level || '):' || CASE WHEN bookmark_suppressed AND h THEN title ELSE bookmark_title END
    WHEN title_anchor IS NOT NULL THEN 'title_anchor:' || title_anchor WHEN correspondence_labels IS NOT NULL THEN 'correspondence_header:' || array_to_string(correspondence_labels, '+') WHEN format_changed THEN 'format_change:' || format_label END END,
  CASE WHEN NOT dup AND num > 0 THEN CASE WHEN numbering_fresh_start THEN 'page_numbering_fresh_start' ELSE 'page_numbering_reset' END || CASE WHEN numbering_scheme_changed THEN '+scheme_change' ELSE '' END END,
  CASE WHEN NOT dup AND emb > 0 THEN 'embedding_drop' END, CASE WHEN NOT dup AND draw > 0 THEN CASE WHEN fall THEN 'drawing_density_drop' ELSE 'drawing_density_spike' END END, CASE WHEN NOT dup AND letter > 0 THEN 'letterhead_change' END), ''), 'unscored_boundary') END AS boundary_signals FROM SC"""


@query(_SC + _SAY)
def p07_boundary_description(spark, d):
    s, f = _scores(spark, d)
    return scoring.describe(s, f).withColumn("boundary_signals", F.regexp_replace("boundary_signals", r"embedding_drop\([^)]*\)", "embedding_drop"))


# Classification.
@query(_CL + "SELECT doc_id, segment_index, start_page, end_page, document_type_id, confidence, classification_method, coalesce(category, 'Supporting / Misc') AS document_category FROM CL LEFT JOIN TT ON type_id = document_type_id")
def c01_classify_cascade(spark, d):
    return _run(spark, d).classified.select("doc_id", "segment_index", "start_page", "end_page", "document_type_id", "confidence", "classification_method", "document_category")


@query(_CL + "SELECT doc_id, segment_index, any_drawing, drawing_share::DOUBLE AS drawing_share, has_tables, md5(titles) AS titles_md5, md5(body) AS body_md5 FROM C2")
def a04_a05_a06_a07_l05_segment_inputs(spark, d):
    s, f = _scores(spark, d)
    r = classify.segment_inputs(f, scoring.segment_index(s), A.raw_pages(spark, d))
    return r.select("doc_id", "segment_index", "any_drawing", "drawing_share", "has_tables", F.md5("titles").alias("titles_md5"), F.md5("body").alias("body_md5"))


_DOCSEG = "SELECT source AS doc_id, doc_id AS segment_index, lower(text || ' ' || " + S.quoted(A.PHRASES) + f"[doc_id % {len(A.PHRASES)} + 1]) AS t FROM documents"


def _phrase_segments(spark, d):
    return A.table(spark, d, "documents").select(F.col("source").alias("doc_id"), F.col("doc_id").alias("segment_index"), F.concat("text", F.lit(" "), F.get(F.array(*map(F.lit, A.PHRASES)), (F.col("doc_id") % len(A.PHRASES)).cast("int"))).alias("t"))


@query(S.chain(S.TAXON, f"X AS ({_DOCSEG})") + "SELECT doc_id, segment_index, type_id, phrase FROM X JOIN TP ON kind = 'anchor' AND contains(t, phrase)")
def j05_substring_join(spark, d):
    return classify.matches(_phrase_segments(spark, d), A.taxonomy_phrases(spark), "anchor", "t").select("doc_id", "segment_index", "type_id", "phrase")


@query(S.chain(S.TAXON, f"X AS ({_DOCSEG})") + "SELECT doc_id, segment_index, type_id, phrase FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, segment_index ORDER BY length(phrase) DESC, type_ord, phrase_ord) AS k FROM X JOIN TP ON kind = 'anchor' AND contains(t, phrase)) WHERE k = 1")
def a08_l03_longest_anchor(spark, d):
    found = _phrase_segments(spark, d).withColumn("b", classify.longest_anchor("t", classify.listed(A.taxonomy_phrases(spark))))
    return found.filter("b.type_id IS NOT NULL").select("doc_id", "segment_index", "b.type_id", "b.phrase")


@query(S.chain(S.TAXON, f"X AS ({_DOCSEG})") + "SELECT doc_id, segment_index, type_id, hits FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, segment_index ORDER BY hits DESC, type_ord) AS k FROM (SELECT doc_id, segment_index, type_ord, type_id, count(DISTINCT phrase) AS hits FROM X JOIN TP ON kind = 'keyword' AND contains(t, phrase) GROUP BY ALL)) WHERE k = 1")
def a09_most_keywords(spark, d):
    found = _phrase_segments(spark, d).withColumn("b", classify.most_keywords("t", classify.listed(A.taxonomy_phrases(spark))))
    return found.filter("b.type_id IS NOT NULL").select("doc_id", "segment_index", "b.type_id", "b.hits")


_G = "V AS (SELECT vec_id // 10 AS g, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings), U AS (SELECT g, i, avg(e[i]) AS m FROM V, range(1, 65) r(i) GROUP BY g, i), CE AS MATERIALIZED (SELECT g, list(m ORDER BY i) AS mean FROM U GROUP BY g), CN AS MATERIALIZED (SELECT g, list_transform(mean, lambda x: x / sqrt(" + S.dot("mean", "mean") + ")) AS centroid FROM CE)"


def _groups(spark, d):
    v = A.table(spark, d, "embeddings").select(F.floor(F.col("vec_id") / 10).alias("g"), F.col("embedding").cast("array<double>").alias("vec"))
    return classify.centroids(v, "g")


@query("WITH " + _G + " SELECT g, list_transform(centroid, lambda x: round(x, 9)) AS centroid FROM CN")
def a03_centroids(spark, d):
    return _groups(spark, d).select("g", F.transform("centroid", lambda x: F.round(x, 9)).alias("centroid"))


@query("WITH " + _G + ", PR AS (SELECT vec_id % 4 AS o, 't' || (vec_id % 4) AS type_id, e FROM (SELECT *, row_number() OVER (PARTITION BY vec_id % 4 ORDER BY vec_id DESC) AS k FROM V) WHERE k <= 20), M AS (SELECT g, o, type_id, avg(" + S.dot("centroid", "e") + " / sqrt(" + S.dot("e", "e") + ") / sqrt(" + S.dot("centroid", "centroid") + ")) AS s FROM CN, PR GROUP BY ALL) SELECT g, type_id, round(s, 9) AS mean_sim FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY s DESC, o) AS k FROM M WHERE s > 0) WHERE k = 1")
def a10_j06_n09_prototypes(spark, d):
    return classify.nearest_prototype(_groups(spark, d), A.prototypes(spark, d), "g").select("g", "type_id", F.round("mean_sim", 9).alias("mean_sim"))


@query("SELECT DISTINCT 't' || (vec_id % 4) AS type_id FROM embeddings WHERE vec_id % 4 IN (0, 3)")
def s06_j10_known_prototypes(spark, d):
    known = spark.createDataFrame([("t0",), ("t3",), ("t9",)], "type_id string")
    return A.prototypes(spark, d).join(F.broadcast(known), "type_id", "left_semi").select("type_id").distinct()


@query("SELECT event_type AS type_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS k FROM events) WHERE k <= 20")
def k04_l06_last_prototypes(spark, d):
    e = A.table(spark, d, "events").select(F.col("event_type").alias("type_id"), F.col("event_id").alias("ord"), F.array(F.col("event_id").cast("double")).alias("vec"))
    kept = classify.keep_prototypes(e.filter("ord < 500"), e.filter("ord >= 500"))
    return kept.select("type_id", F.get("vec", F.lit(0)).cast("long").alias("event_id"))


@query(f"WITH c AS (SELECT (doc_id % 100) / 100.0::DOUBLE AS s FROM documents) SELECT CASE WHEN s >= 0.82 THEN 'HIGH' WHEN s >= 0.65 THEN 'MEDIUM' ELSE 'none' END AS band, count(*) AS n FROM c GROUP BY 1")
def n22_confidence_bands(spark, d):
    s = (F.col("doc_id") % 100) / 100
    band = F.when(s >= classify.PROTOTYPE_HIGH, "HIGH").when(s >= classify.PROTOTYPE_LOW, "MEDIUM").otherwise("none")
    return A.table(spark, d, "documents").groupBy(band.alias("band")).agg(F.count("*").alias("n"))


@query(_CL + "SELECT doc_id, segment_index, array_to_string(list_filter([CASE WHEN any_drawing THEN 'engineering_drawing' END, CASE WHEN has_tables THEN 'contains_tables' END], lambda x: x IS NOT NULL), '|') AS special_tags FROM C2")
def n25_special_tags(spark, d):
    return _run(spark, d).classified.select("doc_id", "segment_index", F.array_join("special_tags", "|").alias("special_tags"))


# Reports, costs, batches.
@query(_CL + f""", CT AS (SELECT *, list_filter([CASE WHEN any_drawing THEN 'engineering_drawing' END, CASE WHEN has_tables THEN 'contains_tables' END], lambda x: x IS NOT NULL) AS tags FROM CL)
SELECT doc_id AS pdf_id, CAST(segment_index AS INTEGER) AS seg, start_page, end_page, CAST(end_page - start_page + 1 AS INTEGER) AS page_count, label AS document_type_label, ingest_mode,
  'segment_' || lpad(CAST(segment_index AS VARCHAR), 3, '0') || '_' || substr(replace(trim(regexp_replace(regexp_replace(label, '[^A-Za-z0-9_\\s-]', ' ', 'g'), '\\s+', ' ', 'g')), ' ', '_'), 1, 40) || CASE WHEN len(tags) > 0 THEN '_' || array_to_string(tags, '+') ELSE '' END || '_pp' || start_page || '-' || end_page || '.pdf' AS output_file,
  total_pages FROM CT JOIN TT ON type_id = document_type_id JOIN (SELECT doc_id, max(page_num) AS total_pages FROM R GROUP BY doc_id) USING (doc_id)""")
def k02_k03_n21_j02_j07_summary(spark, d):
    return _run(spark, d).summary.select("pdf_id", "seg", "start_page", "end_page", "page_count", "document_type_label", "ingest_mode", "output_file", "total_pages")


@query()
def k01_run_report(spark, d):
    """One JSON report a stream."""
    r = _run(spark, d)
    return reports.run_report(r.summary, r.scores)


_COST = S.chain(S.COSTS)


@query(_COST + "SELECT doc_id, method, text_tokens, image_tokens, round(cost_usd, 12) AS cost_usd FROM KC")
def n12_n13_call_costs(spark, d):
    return A.cost_rows(spark, d).select("doc_id", "method", "text_tokens", "image_tokens", F.round("cost_usd", 12).alias("cost_usd"))


@query(_COST + "SELECT count(*) AS calls, CAST(sum(text_tokens) AS BIGINT) AS text_tokens, CAST(sum(image_tokens) AS BIGINT) AS image_tokens, round_even(sum(cost_usd), 6) AS cost_usd, bool_or(estimated) AS any_estimated FROM KC")
def a01_cost_summary(spark, d):
    return reports.cost_summary(A.cost_rows(spark, d))


@query(_COST + "SELECT method, count(*) AS calls, CAST(sum(text_tokens) AS BIGINT) AS text_tokens, CAST(sum(image_tokens) AS BIGINT) AS image_tokens, round_even(sum(cost_usd), 6) AS cost_usd, bool_or(estimated) AS any_estimated FROM KC GROUP BY method")
def a02_cost_by_method(spark, d):
    return reports.cost_summary(A.cost_rows(spark, d), "method")


@query("SELECT count(*) AS runs, count(*) FILTER (WHERE o_orderstatus = 'F') AS failed, count(*) FILTER (WHERE o_orderstatus <> 'P') AS executed, round(sum(o_totalprice), 2) AS seconds FROM orders")
def a14_k05_k10_batch_counts(spark, d):
    o = A.table(spark, d, "orders").select(F.when(F.col("o_orderstatus") == "F", "FAILED(1)").when(F.col("o_orderstatus") == "P", reports.DRY_RUN).otherwise("OK").alias("status"), F.col("o_totalprice").alias("seconds"))
    return reports.batch_counts(o).withColumn("seconds", F.round("seconds", 2))


@query("SELECT source, list_sort(list(DISTINCT lang)) AS langs FROM documents GROUP BY source")
def a15_distinct_sets(spark, d):
    return A.table(spark, d, "documents").groupBy("source").agg(F.array_sort(F.collect_set("lang")).alias("langs"))


@query("SELECT doc_id, source AS name FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, lang FROM documents WHERE doc_id % 2 = 1")
def u02_k06_s07_merged_summaries(spark, d):
    t = A.table(spark, d, "documents")
    return reports.merged([t.filter("doc_id % 2 = 0").select("doc_id", F.col("source").alias("name")), t.filter("doc_id % 2 = 1").select("doc_id", "lang")])


@query("WITH t AS (SELECT DISTINCT l_suppkey AS k, l_linenumber AS v FROM lineitem), c AS (SELECT k, v + 1 AS v FROM t UNION SELECT k, 1 FROM t) SELECT c.k, min(c.v) AS version FROM c LEFT JOIN t ON t.k = c.k AND t.v = c.v WHERE t.k IS NULL GROUP BY c.k")
def n20_k08_next_version(spark, d):
    t = A.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_linenumber").alias("version")).distinct()
    return reports.next_version(t, "k")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL)")
def k09_j09_pending_runs(spark, d):
    return reports.pending(A.table(spark, d, "orders").select("o_orderkey"), A.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")


@query(_PG + "SELECT R.doc_id, R.page_num, title, level FROM R LEFT JOIN MARKS USING (doc_id, page_num)")
def j03_pages_toc(spark, d):
    return A.raw_pages(spark, d).select("doc_id", "page_num").join(features.bookmark_map(A.toc(spark, d)), ["doc_id", "page_num"], "left")


@query("SELECT c_custkey AS doc_id, n AS words, x AS first_word FROM (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 3 WHEN 3 THEN 3 ELSE 6 END::BIGINT AS n, CASE c_custkey % 4 WHEN 0 THEN 'SSN:' WHEN 1 THEN 'SSN:' WHEN 2 THEN 'PHONE:' ELSE 'Email' END AS x FROM customer)")
def l08_reading_order(spark, d):
    w = A.words(spark, d).withColumn("y0", F.when(F.col("doc_id") % 4 == 2, -F.abs(F.col("y0"))).otherwise(F.col("y0")))
    return w.groupBy("doc_id").agg(F.count("*").alias("words"), F.min_by("text", F.struct("y0", "x0")).alias("first_word"))


@query()
def c03_prototype_pass(spark, d):
    """The cascade with prototypes, two series of vectors and a taxonomy's settings. The pass decides by averages of cosines against limits, so tests hold it against brute force."""
    v = A.page_vectors(spark, d)
    two = v.select("doc_id", "page_num", F.col("vec").alias("image_embedding"), F.reverse("vec").alias("text_embedding"))
    known = A.prototypes(spark, d).withColumn("type_id", F.get(F.array(*(F.lit(t[0]) for t in A.TAXONOMY)), F.col("type_ord")))
    settings = {"prototype_min_confidence": 0.30, "low_confidence_threshold": 0.15}
    out = pipeline.run(A.raw_pages(spark, d), A.toc(spark, d), two, A.taxonomy_types(spark), A.taxonomy_phrases(spark), known, settings=settings).classified
    return out.select("doc_id", "segment_index", "document_type_id", "confidence", "classification_method", "may_teach")


@query(S.chain(S.TAXON) + "SELECT (SELECT count(*) FROM TT) AS document_types, (SELECT count(*) FROM TP WHERE kind = 'anchor') AS anchor_phrases, (SELECT count(DISTINCT vec_id % 4) FROM embeddings) AS prototype_types, (SELECT CAST(sum(least(n, 20)) AS BIGINT) FROM (SELECT count(*) AS n FROM embeddings GROUP BY vec_id % 4)) AS prototype_vectors")
def c02_classifier_stats(spark, d):
    return classify.stats(A.taxonomy_types(spark), A.taxonomy_phrases(spark), A.prototypes(spark, d))


@query(_PG + "SELECT doc_id, page_num FROM R WHERE page_num <= 10")
def l09_page_limit(spark, d):
    return features.capped(A.raw_pages(spark, d), 10).select("doc_id", "page_num")


@query("SELECT source AS path, CAST(row_number() OVER (ORDER BY source) AS INTEGER) AS place FROM (SELECT DISTINCT source FROM documents)")
def l02_sorted_inputs(spark, d):
    """Distinct inputs are few files; their order is a rank over that listing."""
    return A.table(spark, d, "documents").select(F.col("source").alias("path")).distinct().select("path", F.row_number().over(Window.orderBy("path")).alias("place"))
