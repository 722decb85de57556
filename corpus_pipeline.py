"""From raw documents to a training mixture: five stages, each on all that the one before it kept.

What holds for all of them: a row is kept or dropped whole, and columns of any names, those of a stage's own inner tables
included, come out as they went in (the last stage adds rate and copies, and replaces columns of these names). Texts are read
whole, however long. An empty table gives no rows. Rows that share an identifier but not the text are judged apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leafcut.llm import decontaminate, exact_dedup, language_id, mixing, ngram_join
from leafcut.llm.common import release, stage, table, unstage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined. A null text, or one without a letter, has none and goes; so does every text if no document with a language is there to learn from. Of languages that are equally near the first by name counts, which drops nothing. Repeated rows stay as often as they come. A missing lang or identifier is no reason to go."""
    return language_id.accepted(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text, white space aside: the one with the smallest identifier; of rows that share that too, one by a hash of their columns. A null text counts as an empty one. Rows without an identifier stay only if no row of their text has one, and then one of them."""
    return exact_dedup.drop_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of 0.8 or more hold together: the one with the smallest identifier; rows of the group that share it all stay, and so do rows without one. A text without words is in no group and stays."""
    return ngram_join.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts stay, and everything does if there are no items; an item without an identifier or text is none. Repeated rows go or stay together."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mixture uses, those with one copy or more, with their rate and number of copies. Without labels of two domains every rate is 1 and all stay. Null and empty texts have no tokens, and the rate of a text that tells nothing. Rows without an identifier are one document."""
    return mixing.mixed(docs, table(spark, sf_dir, "labels"))


STAGES = [("language", language), ("exact", exact), ("near", near), ("benchmark", benchmark), ("mixture", mixture)]
#: Trained stages can't be stated in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next; what one has read is deleted once the next table is written."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        before, docs = docs, stage(step(spark, docs, sf_dir), name)
        unstage(before)
        release(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
