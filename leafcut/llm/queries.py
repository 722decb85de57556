"""Queries of the corpus operators over the driver's tables, with production parameters, and their SQL."""

from __future__ import annotations

from leafcut.llm import decontaminate, exact_dedup, html_extract, language_id, license_scan, mixing, ngram_join, peak_sweep, periodic, secrets_scan, toxicity, url_filter, warc
from leafcut.llm.common import table


def op1_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op2_license_scan(spark, sf_dir):
    return license_scan.find_licenses(table(spark, sf_dir, "documents"))


def op3_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_language_id(spark, sf_dir):
    return language_id.predict_held_out(table(spark, sf_dir, "documents"))


def op5_html_extract(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op6_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark, sf_dir):
    return secrets_scan.find_secrets(table(spark, sf_dir, "documents"))


def op9_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op10_toxicity(spark, sf_dir):
    return toxicity.predict_held_out(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_warc(spark, sf_dir):
    return warc.archived(table(spark, sf_dir, "pages"))


def op12_periodic_runs(spark, sf_dir):
    return periodic.report(table(spark, sf_dir, "documents"))


def op13_peak_sweep(spark, sf_dir):
    return peak_sweep.open_sales(*(table(spark, sf_dir, t) for t in ("sales", "sale_lines", "clients")))


QUERIES = {f.__name__: f for f in (op1_ngram_join, op2_license_scan, op3_mixing, op4_language_id, op5_html_extract, op6_decontaminate, op7_exact_dedup, op8_secret_scan, op9_url_filter, op10_toxicity, op11_warc, op12_periodic_runs, op13_peak_sweep)}
SQL = {"op1_ngram_join": ngram_join.SQL, "op7_exact_dedup": exact_dedup.SQL, "op9_url_filter": url_filter.SQL, "op11_warc": warc.SQL, "op12_periodic_runs": periodic.SQL, "op13_peak_sweep": peak_sweep.SQL}
