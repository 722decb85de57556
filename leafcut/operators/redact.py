"""Personal data on pages: patterns in text, and values beside or below labels by word position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafcut.functions import layout, text

# Labels whose values are redacted, and how far below a label its value may stand.
LABELS = ("TAXPAYER ID:", "TAX ID:", "TAXPAYER ID", "TAX ID", "EIN:", "EIN", "SSN:", "SSN", "PHONE:", "PHONE", "PH:", "TEL:", "EMAIL:", "EMAIL", "E-MAIL:", "E-MAIL")
GAP, RIGHT, SLACK = 14.0, 40.0, 1.0


def pattern_hits(pages: DataFrame) -> DataFrame:
    """(doc_id, page_num, category, value, n): how often each value of each pattern occurs on a page."""
    found = pages.select("doc_id", "page_num", F.explode(text.pii_matches(F.coalesce("text", F.lit("")))).alias("category", "vs"))
    return found.select("doc_id", "page_num", "category", F.explode("vs").alias("value")).groupBy("doc_id", "page_num", "category", "value").agg(F.count("*").alias("n"))


def pattern_counts(pages: DataFrame) -> DataFrame:
    """By category: occurrences, and the count of a search that looks for every occurrence's text again, which is the sum of squares."""
    return pattern_hits(pages).groupBy("doc_id", "category").agg(F.sum("n").alias("regions"), F.sum(F.col("n") * F.col("n")).alias("compat_regions"))


def redacted(pages: DataFrame) -> DataFrame:
    return pages.withColumn("text", text.redact(F.col("text")))


def label_spans(words: DataFrame) -> DataFrame:
    """(doc_id, page_num, ws, label, x0, y0, x1, y1): every place of a label on a line, in any case, also inside a word or over several; ws are the page's words. Within a word, place goes by characters."""
    pages = words.groupBy("doc_id", "page_num").agg(F.collect_list(F.struct("x0", "y0", "x1", "y1", "text")).alias("ws"))
    lines = pages.select("doc_id", "page_num", "ws", F.explode(layout.lines(F.col("ws"))).alias("line"))
    lines = lines.withColumn("t", F.array_join(F.transform("line", lambda w: w["text"]), " "))
    size = lambda xs: F.aggregate(xs, F.lit(0), lambda n, x: n + F.length(x))
    lines = lines.withColumn("line", F.transform("line", lambda w, i: F.struct(w.alias("w"), (size(F.transform(F.slice("line", 1, i), lambda x: x["text"])) + i).alias("at"), F.length(w["text"]).alias("n"))))

    def places(label: str) -> Column:
        parts = F.split("t", rf"(?i)\Q{label}\E", -1)
        found = F.transform(parts, lambda _, i: F.struct(F.lit(label).alias("label"), (size(F.slice(parts, 1, i)) + (i - 1) * len(label)).alias("at"), i.alias("i")))
        return F.filter(found, lambda x: x["i"] > 0)

    spots = lines.withColumn("p", F.explode(F.concat(*map(places, LABELS)))).withColumn("stop", F.col("p.at") + F.length("p.label"))
    on = spots.withColumn("on", F.filter("line", lambda x: (x["at"] < F.col("stop")) & (x["at"] + x["n"] > F.col("p.at"))))
    first, last = F.element_at("on", 1), F.element_at("on", -1)
    along = lambda x, at: x["w"]["x0"] + (x["w"]["x1"] - x["w"]["x0"]) * (at - x["at"]) / x["n"]
    edge = lambda f, name: f(F.transform("on", lambda x: x["w"][name])).alias(name)
    return on.select("doc_id", "page_num", "ws", "p.label", along(first, F.col("p.at")).alias("x0"), edge(F.array_min, "y0"), along(last, F.col("stop")).alias("x1"), edge(F.array_max, "y1"))


def _values(ws: Column) -> Column:
    """Of words in order, those before the first that ends in a colon which look like values."""
    ends = F.array_position(F.transform(ws, lambda x: x["text"].endswith(":")), True)
    return F.filter(F.when(ends > 0, F.slice(ws, 1, F.greatest(ends - 1, F.lit(0)).cast("int"))).otherwise(ws), lambda x: text.value_shaped(x["text"]))


def label_regions(words: DataFrame) -> DataFrame:
    """Distinct boxes around a label's value words: to its right on the line, else on the line below; a page's words are one row, so each label looks at its own page only."""
    rows, c = label_spans(words), F.col
    mid = lambda x: (x["y0"] + x["y1"]) / 2
    right = F.array_sort(F.filter("ws", lambda x: (mid(x) >= c("y0") - SLACK) & (mid(x) <= c("y1") + SLACK) & (x["x0"] >= c("x1") - SLACK)))
    down = F.filter("ws", lambda x: (x["y0"] >= c("y1") - SLACK) & (x["y0"] <= c("y1") + GAP) & (x["x0"] <= c("x1") + RIGHT))
    down = F.array_sort(down, lambda a, b: F.when(a["y0"] < b["y0"], -1).when(a["y0"] > b["y0"], 1).when(a["x0"] < b["x0"], -1).when(a["x0"] > b["x0"], 1).otherwise(0))
    rows = rows.withColumn("r", _values(right)).withColumn("v", F.when(F.size("r") > 0, c("r")).otherwise(_values(down))).filter(F.size("v") > 0)
    at = lambda f, n: f(F.transform("v", lambda x: x[n])).alias(n)
    return rows.select("doc_id", "page_num", at(F.array_min, "x0"), at(F.array_min, "y0"), at(F.array_max, "x1"), at(F.array_max, "y1"), F.lit("labeled_value").alias("category")).distinct()
