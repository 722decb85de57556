"""Pages that arrive as a stream: the sequential fold over pages in order, and the whole plan up to segments over pages in any order. Both are equal to the batch form."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from leafcut.functions import text
from leafcut.operators import features, scoring, similarity
from leafcut.operators.features import FOLD_IN, FOLD_OUT, Fold

_STATE = "cur long, total long, region string, kind string, title string, title_page int, labels array<string>, seen boolean"


def _none(x):
    return None if x is None or (not isinstance(x, (list, str)) and pd.isna(x)) else x


def _step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    f = Fold()
    if state.exists:
        cur, total, region, kind, title, page, labels, seen = state.get
        f.cur, f.total, f.scheme, f.title, f.title_page, f.labels, f.seen = cur, total, (region, kind) if region is not None else None, title, page, set(labels), seen
    rows = sorted((r for p in parts for r in p[list(FOLD_IN)].itertuples(index=False, name=None)), key=lambda r: r[1])
    out = [(r[0], r[1], *f.step(*(_none(x) for x in r[1:]))) for r in rows]
    state.update((f.cur, f.total, *(f.scheme or (None, None)), f.title, f.title_page, sorted(f.labels), f.seen))
    yield pd.DataFrame(out, columns=[x.split()[0] for x in FOLD_OUT.split(", ")])


def folded_stream(rows: DataFrame) -> DataFrame:
    """rows: a stream of the fold's input columns. A document's pages must arrive in order of page_num, though any batch may hold many of them."""
    return rows.groupBy("doc_id").applyInPandasWithState(_step, FOLD_OUT, _STATE, "append", GroupStateTimeout.NoTimeout)


#: What page_stream() gives: one row a page. A page that comes after its place was passed is late: it has no other values.
SEGMENTED = "doc_id string, page_num int, late boolean, segment_index int, is_boundary boolean, total_score double, duplicate_of_prev boolean, image_similarity double, text_similarity double, page_num_found long, numbering_reset boolean, format_returning boolean, bookmark_trusted boolean"
_COLUMNS = [x.split()[0] for x in SEGMENTED.split(", ")]
_SERIES = ("image", "text")
#: How long pages wait for one that is missing, and how long a document's state is kept after its last page.
PATIENCE_MS, IDLE_MS = 10 * 60_000, 24 * 3_600_000


class Series:
    """The last vector of a document and the similarities of the pages before, as many as the frame of the flags has."""

    def __init__(self, vec=None, sims=()):
        self.vec, self.sims = vec, list(sims)

    def step(self, vec: list[float] | None) -> tuple[float | None, bool, bool]:
        """Similarity, moderate, high of the next page that is not blank."""
        sim = None
        if vec is not None and self.vec is not None and len(vec) == len(self.vec):
            size = math.sqrt(sum(x * x for x in vec)) * math.sqrt(sum(x * x for x in self.vec))
            sim = sum(x * y for x, y in zip(vec, self.vec, strict=True)) / size if size else 0.0
        known = [x for x in self.sims if x is not None]
        few, moderate, high = len(known) < similarity.CONTEXT, False, False
        if sim is not None and few:
            moderate = sim < similarity.LOW
        elif sim is not None:
            mean = sum(known) / len(known)
            std = max(math.sqrt(sum((x - mean) ** 2 for x in known) / len(known)), similarity.LEAST_STD)
            far = mean - sim > similarity.LEAST_DROP
            moderate, high = far and (sim - mean) / std < similarity.MODERATE_Z, far and (sim - mean) / std < similarity.HIGH_Z
        self.sims = [*self.sims, sim][-similarity.FRAME :]
        self.vec = self.vec if vec is None else vec
        return sim if few or sim is None else round(sim, 4), moderate, high


class Reading:
    """All that a document's next page is judged by."""

    def __init__(self):
        self.next, self.segment, self.alone = 1, 0, False
        self.text = self.label = self.drawings = self.block = None
        self.fold, self.series = Fold(), {k: Series() for k in _SERIES}

    def dump(self) -> str:
        fold = {k: sorted(v) if isinstance(v, set) else v for k in Fold.__slots__ for v in [getattr(self.fold, k)]}
        own = {k: v for k, v in vars(self).items() if k not in ("fold", "series")}
        return json.dumps({**own, "fold": fold, "series": {k: vars(v) for k, v in self.series.items()}})

    @classmethod
    def load(cls, said: str) -> Reading:
        out, had = cls(), json.loads(said)
        for k, v in had.pop("fold").items():
            setattr(out.fold, k, set(v) if k == "labels" else tuple(v) if k == "scheme" and v else v)
        out.series = {k: Series(**v) for k, v in had.pop("series").items()}
        vars(out).update(had)
        return out

    def step(self, r: dict) -> dict:
        """The next page's row."""
        t, d = r["text"] or "", r["drawing_count"] or 0
        same = self.text is not None and min(len(t), len(self.text)) > features.DUPLICATE_CHARS and (t == self.text or features.reaches(t, self.text, features.DUPLICATE_RATIO))
        spike = self.drawings is not None and self.drawings > 0 and d > features.SPIKE_FACTOR * self.drawings and d > features.SPIKE_LEAST
        fall = self.drawings is not None and self.drawings > features.SPIKE_LEAST and d < self.drawings / features.SPIKE_FACTOR
        a, b = r["block"], self.block
        other = a is not None and b is not None and (len(set(a) & set(b)) / len(set(a) | set(b)) if a and b else 0.0) < features.LETTERHEAD_SAME
        anchor = r["title_anchor"] is not None or r["correspondence"]
        found, _, reset, fresh, scheme, repeated, mark, changed, returning = self.fold.step(
            r["page_num"], same, r["format_label"], self.label, spike, r["title"], r["level"], anchor, r["cur"], r["total"], r["region"], r["kind"], r["bare"],
        )
        flags = {k: (None, False, False) if r["is_blank"] else self.series[k].step(r[f"_{k}"]) for k in _SERIES}
        (i_sim, i_mod, i_high), (t_sim, t_mod, t_high) = (flags[k] for k in _SERIES)
        high = i_high or t_high
        one = i_sim is not None and t_sim is not None and abs(i_sim - t_sim) < 1e-9
        emb = scoring.HIGH if high else scoring.EACH * max(i_mod, t_mod) if one else scoring.EACH * i_mod + scoring.EACH * t_mod
        num = round((scoring.FRESH if fresh else scoring.RESET if reset else 0.0) + (scoring.SCHEME if fresh and scheme else 0.0), 2)
        draw, letter = scoring.DRAWING if spike or fall else 0.0, scoring.LETTERHEAD if other else 0.0
        new = changed and not returning
        trusted = mark and (r["level"] == 1 or num or draw or new or emb or letter) or repeated and high
        strong = bool(trusted or new or r["title_anchor"] or r["correspondence"])
        alone = not same and emb > 0 and not strong and not reset and not other
        structure = scoring.STRUCTURAL if strong else scoring.RETURNING if changed else 0.0
        total = max(0.0, structure + num + emb + draw + letter + (scoring.PENALTY if alone and self.alone else 0.0))
        boundary = not same and total >= scoring.BOUNDARY
        self.segment += bool(boundary or not self.segment)
        self.text, self.label, self.drawings, self.alone = t, r["format_label"], d, alone
        self.block = a if a is not None else self.block
        self.next = r["page_num"] + 1
        return {
            "late": False, "segment_index": self.segment, "is_boundary": boundary, "total_score": 0.0 if same else round(total, 2), "duplicate_of_prev": same, "image_similarity": None if same else i_sim, "text_similarity": None if same else t_sim,
            "page_num_found": found, "numbering_reset": reset, "format_returning": returning, "bookmark_trusted": bool(trusted and not same),
        }


def _frame(doc: str, rows: list[dict]) -> pd.DataFrame:
    df = pd.DataFrame([{"doc_id": doc, **r} for r in rows], columns=_COLUMNS)
    return df.astype({"segment_index": "Int64", "page_num_found": "Int64"})


def _in_order(patience: int, idle: int):
    """Holds pages back until those before them have come, or until the time to wait is over. The state is what the next page is judged by, and the pages that wait, by number."""

    def drain(reading: Reading, waiting: dict[int, str]) -> list[dict]:
        out = []
        while (said := waiting.pop(reading.next, None)) is not None:
            out.append({"page_num": reading.next, **reading.step(json.loads(said))})
        return out

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        reading, waiting = Reading(), {}
        if state.exists:
            said, pages, held = state.get
            reading, waiting = Reading.load(said), dict(zip(pages, held, strict=True))
        rows: list[dict] = []
        if state.hasTimedOut:
            if not waiting:
                # Nothing came for long: the document is over.
                state.remove()
                return
            for page in sorted(waiting):
                if page >= reading.next:
                    reading.next = page
                    rows += drain(reading, waiting)
        else:
            for part in parts:
                for page, said in zip(part["page_num"].tolist(), part["said"].tolist(), strict=True):
                    if page < reading.next:
                        rows.append({"page_num": page, "late": True})
                    else:
                        waiting[page] = said
            rows = [*drain(reading, waiting), *rows]
        state.update((reading.dump(), list(waiting), list(waiting.values())))
        state.setTimeoutDuration(patience if waiting else idle)
        if rows:
            yield _frame(key[0], rows)

    return run


def page_stream(pages: DataFrame, toc: DataFrame | None = None, patience_ms: int = PATIENCE_MS, idle_ms: int = IDLE_MS) -> DataFrame:
    """pages: a stream of the page contract, with image_embedding and text_embedding where there are vectors, in any order; toc is a table. Rows as SEGMENTED, in append mode, each document's in order. A page waits in the state for those before it, patience_ms at most; then what waits goes on without the missing ones, which are late if they still come. A document without new pages for idle_ms is forgotten. Of pages with one number the last that came before its turn counts. The state of a document is one page's text and vectors, the frame of the flags, and the pages that wait. Times are looked at once a batch, so a query runs by intervals or once; with availableNow it would wait for them without end."""
    none = F.lit(None).cast("array<double>")
    rows = features.row_local(pages.withColumns({f"{k}_embedding": none for k in _SERIES if f"{k}_embedding" not in pages.columns}), toc)
    said = F.to_json(F.struct(
        "page_num", F.coalesce("text", F.lit("")).alias("text"), "is_blank", "format_label", "title_anchor", F.col("correspondence_labels").isNotNull().alias("correspondence"), "drawing_count", F.when(F.col("block").isNotNull(), text.tokens(F.col("block"))).alias("block"),
        "labeled.cur", "labeled.total", "labeled.region", "labeled.kind", "bare", "title", "level", *(F.col(f"{k}_embedding").alias(f"_{k}") for k in _SERIES),
    ), {"ignoreNullFields": "false"})
    keyed = rows.select("doc_id", "page_num", said.alias("said"))
    return keyed.groupBy("doc_id").applyInPandasWithState(_in_order(patience_ms, idle_ms), SEGMENTED, "reading string, pages array<int>, held array<string>", "append", GroupStateTimeout.ProcessingTimeTimeout)
