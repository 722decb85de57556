"""Mixing sources to target weights by soft membership, with DataFrame operations only.

A classifier learned from the labelled table gives each document a posterior over domains: naive Bayes log odds of word
letters, beginnings and endings that tell a domain from the first, over the root of how many speak, scaled and shifted to fit the labels. Posteriors are
given in hundredths, so that documents with the same posterior are one cell with its tokens: a few thousand cells at most,
however large the corpus. Projected gradient steps on the least squares between expected domain tokens and their targets
find each cell's nonnegative rate; a document's rate follows from its posterior by the same steps.

Defined results: null and empty texts have no tokens and the prior's posterior; null labels are ignored, contradicting ones
of a document count by their largest values; without labels of a second domain all rates are 1; rows that repeat an
identifier are one document whose tokens add up, and share its rate; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafcut.llm.common import bounded, fresh, stage

DOMAINS = ("good", "poor", "toxic")
#: Share of the tokens that each domain is to have; together the mixture has BUDGET times the corpus' tokens.
TARGETS = {"good": 0.87, "poor": 0.08, "toxic": 0.05}
BUDGET = 1.0
#: The classifier is learned from about so many labelled documents of each domain.
DOCS_PER_DOMAIN = 3000
#: A feature counts if its share of documents differs by MARK_Z standard errors and MARK_DOCS documents have it; at most FEATURES, the strongest.
MARK_Z, MARK_DOCS, FEATURES, SMOOTHING, GRID = 5.0, 4, 2000, 0.5, 100
SCALES, SHIFTS = (0.05, 0.1, 0.2, 0.35, 0.5, 0.75, 1.0, 1.5, 2.0), (-4.0, -3.0, -2.0, -1.0, 0.0, 1.0)
STEPS, RIDGE = 60, 0.01


def domain(labels: DataFrame) -> DataFrame:
    """(doc_id, domain): a labelled document's place in DOMAINS."""
    one = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("q"), F.max("toxic").alias("t"))
    return one.select("doc_id", F.when(F.col("t") > 0, 2).when(F.col("q") > 0, 0).otherwise(1).alias("domain"))


def _features(docs: DataFrame, *more: str) -> DataFrame:
    """Rows (doc_id, more, tokens, f) of each word's letters, beginning and ending; a first row for each document has its tokens and the empty feature."""
    words = F.filter(F.split(F.coalesce(F.col("text"), F.lit("")), r"[\x20\x09-\x0D]+"), lambda x: x != "")
    # Words are counted before they are taken apart, so that no row carries its whole text along.
    each = docs.select("doc_id", *more, words.alias("ws")).select("doc_id", *more, "ws", F.size("ws").alias("n")).select("doc_id", *more, "n", F.explode(F.concat(F.array(F.lit("")), F.col("ws"))).alias("w"))
    letters = F.regexp_replace(F.lower("w"), r"[^\p{L}]+", "")
    parts = F.when(F.col("w") == "", F.array(F.lit(""))).otherwise(F.array(F.concat(F.lit("="), letters), F.concat(F.lit("<"), F.left(letters, F.lit(5))), F.concat(F.lit(">"), F.right("w", F.lit(2)))))
    return each.select("doc_id", *more, F.when(F.col("w") == "", F.col("n")).otherwise(0).alias("tokens"), F.explode(parts).alias("f"))


def _weights(spark, weights: list[tuple]) -> DataFrame:
    """The learned weights as a table of at most FEATURES rows and one for the empty feature."""
    rows = ", ".join("('" + f.replace("\\", "\\\\").replace("'", "\\'") + f"', {a:.6g}D, {b:.6g}D)" for f, a, b in [("", 0.0, 0.0), *weights])
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(f, o1, o2)")


def _evidence(docs: DataFrame, weights: list[tuple], *more: str) -> DataFrame:
    """doc_id, tokens and, for each domain but the first, the sum of log odds over the square root of how many features spoke; features are summed within their task before anything is shuffled."""
    known = _features(docs, *more).join(F.broadcast(_weights(docs.sparkSession, weights)), "f")
    got = known.groupBy("doc_id", *more).agg(F.sum("tokens").alias("tokens"), *(F.sum(f"o{k}").alias(f"a{k}") for k in (1, 2)), *(F.sqrt(F.greatest(F.count_if(F.col(f"o{k}") != 0), F.lit(1)).cast("double")).alias(f"r{k}") for k in (1, 2)))
    return got.select("doc_id", *more, "tokens", *((F.col(f"a{k}") / F.col(f"r{k}")).alias(f"s{k}") for k in (1, 2)))


def _logit(k: int, scale: float, shift: float) -> Column:
    return F.least(F.greatest(F.lit(shift) + F.lit(scale) * F.col(f"s{k}"), F.lit(-30.0)), F.lit(30.0))


def _posterior(fits: list[tuple[float, float]]) -> list[Column]:
    logit = [F.lit(0.0), *(_logit(k, *x) for k, x in enumerate(fits, 1))]
    total = sum((F.exp(x) for x in logit[1:]), F.lit(1.0))
    return [F.exp(x) / total for x in logit]


def learn(docs: DataFrame, labels: DataFrame) -> tuple[list[tuple], list[tuple[float, float]]] | None:
    """Feature weights, and each further domain's scale and shift; None if labels know fewer than two domains. FEATURES weights reach the driver."""
    marked = domain(labels)
    sizes = {r[0]: r[1] for r in marked.groupBy("domain").count().collect()}
    if len(sizes) < 2:
        return None
    total = sum(sizes.values())
    prior = [max(sizes.get(k, 0), 0.5) / total for k in range(len(DOMAINS))]
    chosen = bounded(marked, F.col("doc_id"), "domain", DOCS_PER_DOMAIN, sizes)
    sample = stage(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "sample")
    held = stage(_features(sample.dropDuplicates(["text", "domain"]), "domain").select("doc_id", "domain", "f").distinct().groupBy("f").agg(*(F.count_if(F.col("domain") == k).alias(f"d{k}") for k in range(len(DOMAINS)))), "features")
    have = held.filter("f = ''").first()
    if have is None or sum(x > 0 for x in have[1:]) < 2:
        return None
    n = [max(x, 1) for x in have[1:]]
    odds, marks = [], []
    for k in range(1, len(DOMAINS)):
        p, q = F.col(f"d{k}") / n[k], F.col("d0") / n[0]
        both = (F.col(f"d{k}") + F.col("d0")) / (n[k] + n[0])
        z = (p - q) / F.sqrt(both * (1 - both) * (1 / n[k] + 1 / n[0]) + 1e-12)
        marks.append(F.when(F.abs(z) >= MARK_Z, F.abs(z)).otherwise(0.0))
        odds.append(F.when(F.abs(z) >= MARK_Z, F.log((F.col(f"d{k}") + SMOOTHING) / (n[k] + 2 * SMOOTHING)) - F.log((F.col("d0") + SMOOTHING) / (n[0] + 2 * SMOOTHING))).otherwise(0.0))
    told = held.filter(f"f <> '' AND d0 + d1 + d2 >= {MARK_DOCS}").select("f", odds[0].alias("o1"), odds[1].alias("o2"), F.greatest(*marks).alias("z"))
    weights = [(r[0], r[1], r[2]) for r in told.filter("z > 0").orderBy(F.desc("z"), "f").limit(FEATURES).collect()]
    seen = stage(_evidence(sample, weights, "domain"), "evidence")
    fits = []
    for k in range(1, len(DOMAINS)):
        # Scale and shift of least log loss between the first domain and this one.
        base = math.log(prior[k] / prior[0])
        grid = [(x, base + y) for x in SCALES for y in SHIFTS]
        loss = seen.filter(F.col("domain").isin(0, k)).agg(*(F.avg(F.log1p(F.exp(F.when(F.col("domain") == k, -1).otherwise(1) * _logit(k, *g)))).alias(f"l{i}") for i, g in enumerate(grid))).first()
        fits.append(grid[min(range(len(grid)), key=lambda i: (loss[i] if loss[i] is not None else 0.0, i))])
    return weights, fits


def posteriors(docs: DataFrame, model) -> DataFrame:
    """doc_id, tokens and the posterior in whole parts of GRID, q0 to q2, which add up to GRID."""
    weights, fits = model if model else ([], [(0.0, -30.0)] * (len(DOMAINS) - 1))
    p = _posterior(fits)
    q2 = F.round(p[2] * GRID).cast("int")
    q1 = F.least(F.round(p[1] * GRID).cast("int"), GRID - q2)
    return _evidence(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), weights).select("doc_id", "tokens", q1.alias("q1"), q2.alias("q2")).withColumn("q0", GRID - F.col("q1") - F.col("q2"))


def _rates(cells: DataFrame, aims: list[float], square: list[float], step: float) -> DataFrame:
    """q0, q1, q2, rate of each cell after STEPS moves from rate 1, in one job: the cells, GRID ** 2 / 2 or so at most however many documents there are, are one row, and each move is two passes over its array."""
    cell = F.struct("q0", "q1", "q2", "n", *(((F.col(f"q{k}") / GRID).alias(f"s{k}")) for k in range(len(DOMAINS))))
    row = cells.agg(F.collect_list(cell).alias("c"))
    c = F.col("c")

    def move(rates: Column, _: Column) -> Column:
        used = F.zip_with(c, rates, lambda x, r: F.transform(F.array(*(x[f"s{k}"] for k in range(len(DOMAINS)))), lambda s: s * x["n"] * r))
        got = F.aggregate(used, F.array(*[F.lit(0.0)] * len(DOMAINS)), lambda t, x: F.zip_with(t, x, lambda u, v: u + v))
        # A domain's error is weighed by its own size; one without tokens pulls nowhere.
        pull = lambda g, x: sum(((F.get(g, F.lit(k)) - aims[k]) / square[k] * x[f"s{k}"] for k in range(len(DOMAINS)) if square[k]), F.lit(0.0))
        return F.transform(F.array(got), lambda g: F.zip_with(c, rates, lambda x, r: F.greatest(F.lit(0.0), r * (1 - step * RIDGE) + step * RIDGE - step * pull(g, x))))[0]

    rates = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), F.transform(c, lambda x: F.lit(1.0)), move)
    return row.select(F.explode(F.arrays_zip("c", rates.alias("rate"))).alias("e")).select("e.c.q0", "e.c.q1", "e.c.q2", "e.rate")


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, budget: float = BUDGET) -> DataFrame:
    """doc_id, tokens, p_good, p_poor, p_toxic, rate, copies: copies is the rate rounded up or down by a hash of the identifier, so that copies add up to rates on average."""
    model = learn(docs, labels)
    soft = stage(posteriors(docs, model), "posteriors")
    cells = stage(soft.groupBy("q0", "q1", "q2").agg(F.sum("tokens").cast("double").alias("n")).coalesce(1), "cells")
    share = lambda k: F.col(f"q{k}") / GRID
    first = cells.agg(F.sum("n"), *(F.sum(F.col("n") * share(k) ** 2) for k in range(len(DOMAINS)))).first()
    total, square = first[0] or 0.0, [x or 0.0 for x in first[1:]]
    # That weight bounds the curvature by the number of domains.
    step = 1 / (len(DOMAINS) + RIDGE)
    aims = [targets[d] * budget * total for d in DOMAINS]
    rates = _rates(cells, aims, square, step) if model and total else cells.select("q0", "q1", "q2", F.lit(1.0).alias("rate"))
    rates = stage(rates, "cells")  # GRID ** 2 / 2 rows or so at most
    unit = F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)
    out = soft.join(F.broadcast(rates), ["q0", "q1", "q2"]).select("doc_id", "tokens", *(share(k).alias(f"p_{d}") for k, d in enumerate(DOMAINS)), "rate")
    return out.withColumn("copies", (F.floor("rate") + F.when(unit < F.col("rate") - F.floor("rate"), 1).otherwise(0)).cast("int"))


def mixed(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs that the mixture uses, with their rate and number of copies. Columns of a user's that are called rate or copies give way to these; all others, whatever their names, stay."""
    (doc,) = fresh("doc")
    rates = stage(mix(docs, labels).select(F.col("doc_id").alias(doc), "rate", "copies"), "rates")
    clear = docs.drop("rate", "copies")
    return clear.join(rates.filter("copies > 0"), clear["doc_id"].eqNullSafe(F.col(doc))).drop(doc)
