"""Classes of segments: a cascade of anchor phrases, drawings, prototypes and keywords over a configurable taxonomy.

Matching is by substring on lower-cased text. Every tie is broken by the order of types, then of phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from leafcut.functions.vectors import norm

MISC, MISC_CATEGORY, DRAWING = "supporting_misc", "Supporting / Misc", "engineering_drawing"
DRAWING_SHARE, PROTOTYPE_HIGH, PROTOTYPE_LOW, KEYWORDS_MEDIUM, KEYWORDS_ANCHORED, TABLE_DRAWINGS, KEPT = 0.60, 0.82, 0.65, 2, 3, 200, 20


#: Settings that a taxonomy may give, by the names it gives them, with what holds where it gives none.
SETTINGS = {"prototype_min_confidence": PROTOTYPE_HIGH, "low_confidence_threshold": PROTOTYPE_LOW, "keyword_min_hits": 1, "prototype_min_pages_to_save": 2}


def segment_inputs(features: DataFrame, index: DataFrame, texts: DataFrame) -> DataFrame:
    """One row a segment: titles, body (the first three texted pages that are not blank), drawing share, tables, first page's anchor. texts: doc_id, page_num, text."""
    rows = features.join(index, ["doc_id", "page_num"])
    # Only the first three texted pages of a segment are carried on, so no group of texts is unbounded. Which they are is told without the texts.
    texted = ~F.col("is_blank") & (F.col("text_char_count") > 0)
    place = F.count_if(texted).over(Window.partitionBy("doc_id", "segment_index").orderBy("page_num"))
    rows = rows.withColumn("_says", texted & (place <= 3)).join(texts.select("doc_id", "page_num", F.col("text").alias("native_text")), ["doc_id", "page_num"], "left")
    rows = rows.withColumn("body", F.when(F.col("_says"), F.col("native_text")))
    ordered = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("page_num", F.col(c).alias("t"))))), lambda x: x["t"]), " ")
    return rows.groupBy("doc_id", "segment_index").agg(
        F.min("page_num").alias("start_page"), F.max("page_num").alias("end_page"), ordered("bookmark_title").alias("titles"), ordered("body").alias("body"), F.min_by("title_anchor", "page_num").alias("first_anchor"),
        F.bool_or("is_drawing").alias("any_drawing"), F.coalesce(F.avg(F.when(~F.col("is_blank"), F.col("is_drawing").cast("double"))), F.lit(0.0)).alias("drawing_share"),
        F.bool_or((F.col("drawing_count") > TABLE_DRAWINGS) | (F.col("table_count") > 0)).alias("has_tables"), F.count_if(~F.col("is_blank")).alias("pages"),
    )


class Phrases:
    """The taxonomy's phrases in one automaton, which tells every phrase that a text contains in one pass over it, however many there are."""

    def __init__(self, rows: list[tuple[str, int, str, int, str]]):
        """rows: kind, type_ord, type_id, phrase_ord, phrase; of equal rows one counts."""
        self.listed = sorted(set(rows), key=lambda r: (r[1], r[3], r[0], r[2], r[4]))
        at: dict[str, list[int]] = {}
        for i, r in enumerate(self.listed):
            at.setdefault(r[4], []).append(i)
        self.machine = ahocorasick.Automaton()
        for phrase, places in at.items():
            self.machine.add_word(phrase, tuple(places))
        if at:
            self.machine.make_automaton()

    def found(self, text: str | None, kind: str) -> list[tuple[str, int, str, int, str]]:
        """The listed phrases of a kind that a text contains, by type and phrase."""
        if not text or not self.listed:
            return []
        hits = set()
        for _, places in self.machine.iter(text):
            hits.update(places)
        return [self.listed[i] for i in sorted(hits) if self.listed[i][0] == kind]

    def longest(self, text: str | None, kind: str = "anchor") -> tuple[str | None, str | None]:
        """The longest phrase of a kind in a text, and its type; of equally long ones the first by type and phrase."""
        best = max(self.found(text, kind), key=lambda r: (len(r[4]), -r[1], -r[3]), default=None)
        return (best[2], best[4]) if best else (None, None)

    def most(self, text: str | None, kind: str = "keyword") -> tuple[str | None, int | None]:
        """The type with most distinct phrases of a kind in a text, and their number; of equals the first type."""
        by: dict[tuple[int, str], set[str]] = {}
        for _, order, name, _, phrase in self.found(text, kind):
            by.setdefault((-order, name), set()).add(phrase)
        best = max(by.items(), key=lambda x: (len(x[1]), x[0][0]), default=None)
        return (best[0][1], len(best[1])) if best else (None, None)


def listed(phrases: DataFrame) -> Phrases:
    """Brings the taxonomy's phrases to the driver: a configuration, whose size does not depend on the pages."""
    own = phrases.filter((F.col("type_id") != MISC) & (F.col("phrase") != "")).select("kind", "type_ord", "type_id", "phrase_ord", F.lower("phrase"))
    return Phrases([tuple(r) for r in own.collect()])


def _low(column: str) -> Column:
    return F.lower(F.coalesce(column, F.lit("")))


def matches(segs: DataFrame, phrases: DataFrame, kind: str, column: str) -> DataFrame:
    """(doc_id, segment_index, type_ord, type_id, phrase_ord, phrase) of the listed phrases that a text column contains."""
    known = listed(phrases)

    def of(t: str) -> list[tuple]:
        return [r[1:] for r in known.found(t, kind)]

    return segs.select("doc_id", "segment_index", F.explode(F.udf(of, "array<struct<type_ord: int, type_id: string, phrase_ord: int, phrase: string>>", useArrow=False)(_low(column))).alias("m")).select("doc_id", "segment_index", "m.*")


# Texts go to Python some rows at a time: a batch of thousands of long texts would fill a worker.
def longest_anchor(column: str, known: Phrases) -> Column:
    """(type_id, phrase): the longest anchor phrase that a text column contains; both null if there is none."""
    return F.udf(known.longest, "type_id string, phrase string", useArrow=False)(_low(column))


def most_keywords(column: str, known: Phrases) -> Column:
    """(type_id, hits): the type with most distinct keywords in a text column; both null if there is none."""
    return F.udf(known.most, "type_id string, hits long", useArrow=False)(_low(column))


def phrase_answers(titles: str, body: str, known: Phrases) -> Column:
    """What the phrases tell of a segment: the longest anchor of its titles (a) and of its body (b), and the type with most keywords in both (k). Each text goes to Python once."""

    def of(t: str, b: str) -> tuple:
        return *known.longest(t), *known.longest(b), *known.most(f"{t} {b}")

    return F.udf(of, "a_type_id string, a_phrase string, b_type_id string, b_phrase string, k_type_id string, k_hits long", useArrow=False)(_low(titles), _low(body))


def _once(value: Column, f) -> Column:
    """f of a value that is worked out once."""
    return F.transform(F.array(value), f)[0]


def centroids(vectors: DataFrame, *keys: str) -> DataFrame:
    """The mean of a group's vectors, scaled to length 1; null where lengths differ, unscaled if its length is 0. Tasks sum up what they have of a group into one vector, so a group costs a row a task, whatever its size and width."""
    known = vectors.filter("vec IS NOT NULL AND size(vec) > 0").select(*keys, F.size("vec").alias("_n"), array_to_vector("vec").alias("_v"))
    sums = known.groupBy(*keys, "_n").agg(Summarizer.mean(F.col("_v")).alias("_m"))
    mean = sums.groupBy(*keys).agg(F.count("*").alias("kinds"), F.first("_m").alias("_m")).select(*keys, "kinds", vector_to_array("_m").alias("mean"))
    scaled = _once(F.col("mean"), lambda m: _once(norm(m), lambda n: F.when(n == 0, m).otherwise(F.transform(m, lambda x: x / n))))
    return mean.select(*keys, F.when(F.col("kinds") == 1, scaled).alias("centroid"))


class Prototypes:
    """The newest KEPT prototypes of each type as one matrix of unit rows for each vector length; what goes to the tasks grows with the taxonomy alone."""

    def __init__(self, rows: list[tuple[int, str, list[float]]]):
        self.types = sorted({(order, name) for order, name, _ in rows})
        place = {t: i for i, t in enumerate(self.types)}
        self.sizes = np.zeros(len(self.types))
        by: dict[int, list] = {}
        for order, name, vec in rows:
            self.sizes[place[order, name]] += 1
            by.setdefault(len(vec), []).append((place[order, name], vec))
        self.matrices = {}
        for n, own in by.items():
            m = np.array([v for _, v in own], float).reshape(len(own), n)
            size = np.linalg.norm(m, axis=1, keepdims=True)
            shares = np.zeros((len(own), len(self.types)))
            shares[np.arange(len(own)), [i for i, _ in own]] = 1
            self.matrices[n] = (np.divide(m, size, out=np.zeros_like(m), where=size > 0), shares)

    def nearest(self, batch: list) -> tuple[list, list]:
        """Type and mean cosine of each vector's best type; null where no mean is above 0. A vector of another length than a prototype's has cosine 0 with it."""
        best, means = [None] * len(batch), [None] * len(batch)
        groups: dict[int, list[int]] = {}
        for i, v in enumerate(batch):
            if v is not None and len(v) in self.matrices:
                groups.setdefault(len(v), []).append(i)
        for n, rows in groups.items():
            matrix, shares = self.matrices[n]
            x = np.array([batch[i] for i in rows], float)
            size = np.linalg.norm(x, axis=1, keepdims=True)
            x = np.divide(x, size, out=np.zeros_like(x), where=size > 0)
            mean = (x @ matrix.T) @ shares / self.sizes
            for i, k, m in zip(rows, mean.argmax(axis=1), mean.max(axis=1), strict=True):
                if m > 0:
                    best[i], means[i] = self.types[k][1], float(m)
        return best, means


def newest(prototypes: DataFrame) -> Prototypes:
    """Brings the newest KEPT prototypes of each type to the driver: a configuration, of at most KEPT vectors a type."""
    last = F.row_number().over(Window.partitionBy("type_id").orderBy(F.desc("ord")))
    rows = prototypes.withColumn("_b", last).filter(F.col("_b") <= KEPT).select("type_ord", "type_id", "vec").collect()
    return Prototypes([tuple(r) for r in rows])


def nearest(vec: Column, known: Prototypes) -> Column:
    """(type_id, mean_sim) of the type whose prototypes have the largest positive mean cosine with a vector: one matrix product a batch, without a join."""

    @F.pandas_udf("type_id string, mean_sim double")
    def of(batch: pd.Series) -> pd.DataFrame:
        best, means = known.nearest(batch.tolist())
        return pd.DataFrame({"type_id": pd.Series(best, dtype=object), "mean_sim": pd.Series(means, dtype=float)})

    return of(vec)


def nearest_prototype(groups: DataFrame, prototypes: DataFrame, *keys: str) -> DataFrame:
    """The type whose prototypes have the largest positive mean cosine with a group's centroid; groups without one have no row."""
    rows, known = groups.select(*keys, "centroid"), newest(prototypes)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            p["type_id"], p["mean_sim"] = known.nearest(p["centroid"].tolist())
            yield p[p["type_id"].notna()].drop(columns="centroid")

    return rows.mapInPandas(run, StructType([*rows.drop("centroid").schema, StructField("type_id", StringType()), StructField("mean_sim", DoubleType())]))


def classify(segs: DataFrame, types: DataFrame, phrases: DataFrame, prototypes: DataFrame | None = None, cents: DataFrame | None = None, settings: dict | None = None) -> DataFrame:
    """settings: those of the taxonomy, see SETTINGS. document_type_id, confidence, method, category, label, special_tags and whether the segment may teach a prototype. The first pass that answers decides."""
    key, limit = ["doc_id", "segment_index"], {**SETTINGS, **(settings or {})}
    known = listed(phrases)
    s = segs.withColumn("_said", phrase_answers("titles", "body", known)).select(*segs.columns, "_said.*")
    none = lambda kind: F.lit(None).cast(kind)
    s = s.join(cents.select(*key, "centroid"), key, "left") if cents is not None else s.withColumn("centroid", none("array<double>"))
    if prototypes is not None and cents is not None:
        open_ = F.col("a_type_id").isNull() & F.col("b_type_id").isNull() & (F.col("drawing_share") < DRAWING_SHARE)
        s = s.withColumn("p", nearest(F.when(open_, F.col("centroid")), newest(prototypes))).withColumns({"p_type_id": F.col("p.type_id"), "p_mean_sim": F.col("p.mean_sim")}).drop("p")
    else:
        s = s.withColumns({"p_type_id": none("string"), "p_mean_sim": none("double")})
    c = F.col
    enough = F.when(F.coalesce(F.length("first_anchor"), F.lit(0)) > 0, c("k_hits") >= KEYWORDS_ANCHORED).otherwise(c("k_hits") >= limit["keyword_min_hits"])
    answer = lambda t, conf, how: F.struct(t.alias("document_type_id"), conf.alias("confidence"), how.alias("classification_method"))
    high = F.lit("HIGH")
    anchor = lambda x, where: F.when(c(f"{x}_type_id").isNotNull(), answer(c(f"{x}_type_id"), high, F.concat(F.lit(f"anchor_phrase_{where}:"), F.substring(c(f"{x}_phrase"), 1, 40))))
    r = F.coalesce(
        anchor("a", "bookmark"), anchor("b", "body"),
        F.when(c("drawing_share") >= DRAWING_SHARE, answer(F.lit(DRAWING), high, F.concat(F.lit("visual_fingerprint:"), F.bround(c("drawing_share") * 100, 0).cast("int"), F.lit("%_drawing_pages")))),
        F.when(c("p_mean_sim") >= limit["low_confidence_threshold"], answer(c("p_type_id"), F.when(c("p_mean_sim") >= limit["prototype_min_confidence"], "HIGH").otherwise("MEDIUM"), F.concat(F.lit("prototype_similarity:"), F.format_string("%.3f", F.bround("p_mean_sim", 3))))),
        F.when(enough, answer(c("k_type_id"), F.when(c("k_hits") >= KEYWORDS_MEDIUM, "MEDIUM").otherwise("LOW"), F.concat(F.lit("keyword_score:"), c("k_hits"), F.lit("_hits")))),
        answer(F.lit(MISC), F.lit("LOW"), F.lit("default")),
    )
    out = s.withColumn("r", r).select(*segs.columns, "centroid", "r.*")
    out = out.join(F.broadcast(types.select(c("type_id").alias("document_type_id"), c("label").alias("document_type_label"), "category", "ingest_mode")), "document_type_id", "left")
    tags = F.array_compact(F.array(F.when(c("any_drawing"), "engineering_drawing"), F.when(c("has_tables"), "contains_tables")))
    teaches = (c("confidence") == "HIGH") & c("centroid").isNotNull() & ((c("pages") >= limit["prototype_min_pages_to_save"]) | c("classification_method").startswith("anchor_phrase") | c("classification_method").startswith("visual_fingerprint"))
    return out.withColumns({"document_category": F.coalesce("category", F.lit(MISC_CATEGORY)), "document_type_label": F.coalesce("document_type_label", "document_type_id"), "ingest_mode": F.coalesce("ingest_mode", F.lit("standard")), "special_tags": tags, "may_teach": teaches}).drop("category")


def keep_prototypes(old: DataFrame, new: DataFrame, most: int = KEPT) -> DataFrame:
    """type_id, ord, vec and whatever columns both have: the last `most` prototypes of each type, renumbered, after adding the new behind the old. Each task hands on its last ones of a type only, so a type may have any number of new vectors. ord may be of any kind that can be ordered."""
    newest = lambda df: df.withColumn("_b", F.row_number().over(Window.partitionBy("type_id").orderBy(F.desc("ord")))).filter(F.col("_b") <= most)
    both = newest(old).withColumn("_new", F.lit(0)).drop("ord").unionByName(newest(new).withColumn("_new", F.lit(1)).drop("ord"))
    kept = both.withColumn("_k", F.row_number().over(Window.partitionBy("type_id").orderBy(F.desc("_new"), "_b"))).filter(F.col("_k") <= most)
    kept = kept.withColumn("ord", F.row_number().over(Window.partitionBy("type_id").orderBy(F.desc("_k"))))
    return kept.select("type_id", "ord", "vec", *(c for c in new.columns if c not in ("type_id", "ord", "vec")))


def taught(classified: DataFrame, types: DataFrame) -> DataFrame:
    """type_id, ord, vec of the segments that may teach, by document and segment; only known types learn."""
    rows = classified.filter("may_teach").select(F.col("document_type_id").alias("type_id"), F.struct("doc_id", "segment_index").alias("ord"), F.col("centroid").alias("vec"))
    return rows.join(F.broadcast(types.select("type_id")), "type_id", "left_semi")


def stats(types: DataFrame, phrases: DataFrame, prototypes: DataFrame) -> DataFrame:
    """Counts of types, anchor phrases, types with prototypes and prototypes."""
    a = types.agg(F.count("*").alias("document_types"))
    b = phrases.agg(F.count_if(F.col("kind") == "anchor").alias("anchor_phrases"))
    p = prototypes.agg(F.countDistinct("type_id").alias("prototype_types"), F.count("*").alias("prototype_vectors"))
    return a.join(b).join(p)
