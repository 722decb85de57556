"""Column expressions over page geometry, images and drawings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def size_bucket(w: Column, h: Column) -> Column:
    """US_LETTER and A4 within 3 % or 8 points; WIDE beyond 1000 points."""
    long, short = F.greatest(w, h), F.least(w, h)
    close = lambda x, to: F.abs(x - to) <= F.greatest(F.lit(8.0), F.lit(0.03 * to))
    out = F.when(long > 1000, "WIDE")
    for name, a, b in (("US_LETTER", 792.0, 612.0), ("A4", 842.0, 595.0)):
        out = out.when(close(long, a) & close(short, b), name)
    return out.otherwise("OTHER")


def orientation(w: Column, h: Column) -> Column:
    return F.when(w > h, "landscape").otherwise("portrait")


def page_format(w: Column, h: Column) -> Column:
    w, h = F.bround(w, 1), F.bround(h, 1)
    return F.concat_ws("_", size_bucket(w, h), orientation(w, h))


def is_blank(text: Column, image_area: Column, w: Column, h: Column, drawings: Column, chars: int = 15, share: float = 0.02) -> Column:
    area = w * h
    covered = F.coalesce((area > 0) & (image_area / F.nullif(area, F.lit(0.0)) > share), F.lit(False))
    return ~((F.length(F.coalesce(text, F.lit(""))) > chars) | covered) & (drawings <= 5)


def text_density(text: Column, w: Column, h: Column) -> Column:
    return F.bround(F.length(F.coalesce(text, F.lit(""))) / F.greatest(w * h, F.lit(1.0)), 8)


def is_drawing(w: Column, h: Column, drawings: Column, infos: Column, most: int = 20, pixels: int = 1_500_000) -> Column:
    """A landscape page that is one large scan."""
    one = F.get(infos, F.lit(0))
    return F.coalesce((w > h) & (drawings <= most) & (F.size(infos) == 1) & (one["width"].cast("long") * one["height"] > pixels), F.lit(False))


_WORDS = "array<array<struct<x0: double, y0: double, x1: double, y1: double, text: string>>>"


def lines(ws: Column) -> Column:
    """A page's words (structs of x0, y0, x1, y1, text) as lines from top to bottom, each from left to right. A word whose middle is above the foot of a line's first word belongs to it, so uneven baselines do not part a line."""
    inside = lambda line, w: (w["y0"] + w["y1"]) / 2 <= line[0]["y1"]

    def add(found: Column, w: Column) -> Column:
        last = F.element_at(found, -1)
        return F.when((F.size(found) > 0) & inside(last, w), F.concat(F.slice(found, 1, F.size(found) - 1), F.array(F.array_append(last, w)))).otherwise(F.concat(found, F.array(F.array(w))))

    down = lambda a, b: F.when(a["y0"] < b["y0"], -1).when(a["y0"] > b["y0"], 1).when(a["x0"] < b["x0"], -1).when(a["x0"] > b["x0"], 1).otherwise(0)
    each = F.aggregate(F.array_sort(ws, down), F.array().cast(_WORDS), add)
    return F.transform(each, lambda line: F.array_sort(line))  # noqa: PLW0108


def _text(ws: Column) -> Column:
    return F.trim(F.array_join(F.transform(lines(ws), lambda line: F.array_join(F.transform(line, lambda w: w["text"]), " ")), "\n"))


def bands(ws: Column, height: Column, shares: tuple[str, ...] = ("0.12", "0.20", "0.30")) -> Column:
    """A map of share to the text of a page's words whose middle is in that share of its height at the top (header) and at the bottom (footer)."""
    mid = lambda w: (w["y0"] + w["y1"]) / 2
    part = lambda s: F.struct(_text(F.filter(ws, lambda w: mid(w) <= height * float(s))).alias("header"), _text(F.filter(ws, lambda w: mid(w) >= height * (1 - float(s)))).alias("footer"))
    return F.create_map(*(x for s in shares for x in (F.lit(s), part(s))))
