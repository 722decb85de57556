"""Toxicity by compression distance.

Two zstandard dictionaries, for toxic and for ordinary text: a part trained on windows of both, so that what all texts share
costs the same, and behind it the strings that mark the side. Dictionaries trained on each side alone, without these, were
tried first and could not find toxic texts; README.md has the figures. A text is cut into windows; each is compressed with
both. How many bytes less a window takes with the toxic dictionary, over the whole text, gives the score. Weights and the
threshold are calibrated on labelled rows that the dictionaries were not trained on, in turns, so that 0.7 is the score that
separates them best.

Defined results: null and empty texts have one empty window and get the lowest evidence; contradicting labels of a document
count as toxic; null labels are ignored; with nothing to learn from, every score is 0; every row gives a row, repeated ones
the same score; of equal evidence in calibration the first by identifier counts first; long texts are scored whole, a
mebibyte at a time; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafcut.llm.common import bounded, held_out

#: A model is trained on about so many toxic and ordinary documents; a bounded sample of labelled rows.
TOXIC_DOCS, ORDINARY_DOCS = 1500, 3000
WINDOW, STRIDE = 48, 32
COMMON_BYTES, MARK_BYTES, LEVEL = 32768, 2048, 5
THRESHOLD = 0.7
#: Parts that labelled texts are dealt into for calibration, and how much more recall counts than precision in the F score that the threshold is best for.
FOLDS, RECALL = 3, 1.5
#: A string marks a side if its share of documents differs by so many standard errors, and it is in so many documents.
MARK_Z, MARK_DOCS, MARK_SHARE, MARK_RATIO = 5.0, 4, 0.02, 4.0
_WORD = re.compile(r"[^\W\d_]+")


def folded(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass")


def windows(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the windows that cover a text of so many bytes, each overlapping the next."""
    start = np.arange(0, max(1, size - (WINDOW - STRIDE)), STRIDE)
    return start, np.minimum(start + WINDOW, size) - start


def distinct(texts: list[bytes]) -> list[bytes]:
    """Texts of which at least half the word 5-grams are new, so that copies don't count as evidence again."""
    seen: set = set()
    out = []
    for x in texts:
        w = x.split()
        g = {hash(tuple(w[i : i + 5])) for i in range(max(1, len(w) - 4))}
        if 2 * len(g & seen) < len(g):
            out.append(x)
        seen |= g
    return out


def strings_in(texts: list[bytes]) -> Counter:
    """In how many texts each word and each word beginning of 4 to 10 letters occurs."""
    out: Counter = Counter()
    for x in texts:
        g = set()
        for w in set(_WORD.findall(x.decode("utf-8", "surrogatepass"))):
            if len(w) <= 40:
                g.add(w + " ")
            g.update(w[:n] for n in range(4, min(len(w), 10) + 1))
        out.update(g)
    return out


def marks(own: Counter, n_own: int, other: Counter, n_other: int) -> bytes:
    """What marks one side against the other, the strongest last, where it is nearest to a window."""
    z = {}
    for w, k in own.items():
        if k < max(MARK_DOCS, MARK_SHARE * n_own) or len(w) < 4:
            continue
        p, q = k / n_own, other[w] / n_other
        both = (k + other[w]) / (n_own + n_other)
        z[w] = (p - q) / math.sqrt(both * (1 - both) * (1 / n_own + 1 / n_other) + 1e-12)
        if z[w] < MARK_Z or p <= MARK_RATIO * q:
            del z[w]
    chosen: list[str] = []
    size = 0
    for w in sorted(z, key=lambda w: (-z[w], -len(w), w)):
        if any(w in v or (v in w and own[v] >= own[w]) for v in chosen):
            continue
        size += len(w.encode()) + 1
        if size > MARK_BYTES:
            break
        chosen.append(w)
    return " ".join(reversed(chosen)).encode("utf-8", "surrogatepass")


class Model:
    """Two dictionaries, and the weights that turn window savings into a score."""

    def __init__(self, toxic: list[bytes], ordinary: list[bytes]):
        """Weights and threshold come from texts that the dictionaries they are measured with were not trained on."""
        rows, known = [], []
        for fold in range(FOLDS):
            self._learn([x for i, x in enumerate(toxic) if i % FOLDS != fold] or toxic, [x for i, x in enumerate(ordinary) if i % FOLDS != fold] or ordinary)
            for y, texts in ((1.0, toxic), (0.0, ordinary)):
                rows += [self.evidence(x) for x in texts[fold::FOLDS]]
                known += [y] * len(texts[fold::FOLDS])
        self._learn(toxic, ordinary)
        self.mean, self.scale, self.weights, self.shift = np.zeros(4), np.ones(4), np.zeros(5), 0.0
        self._calibrate(np.array(rows), np.array(known))

    def _learn(self, toxic: list[bytes], ordinary: list[bytes]) -> None:
        t, o = distinct(toxic), distinct(ordinary)
        a, b = strings_in(t), strings_in(o)
        samples = [x[s : s + n] for x in o[:1000] + t[:500] for s, n in zip(*(v.tolist() for v in windows(len(x))), strict=True)]
        try:
            common = zstandard.train_dictionary(COMMON_BYTES, samples).as_bytes()
        except zstandard.ZstdError:  # too little text to train on
            common = b"".join(samples)[-COMMON_BYTES:]
        self.dictionaries = tuple(common + marks(*x).rjust(MARK_BYTES, b"\0") for x in ((a, len(t), b, len(o)), (b, len(o), a, len(t))))
        self._compressors: list | None = None

    def __getstate__(self):
        return self.__dict__ | {"_compressors": None}

    def _lengths(self, text: bytes) -> list[np.ndarray]:
        if self._compressors is None:
            p = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
            self._compressors = []
            for d in self.dictionaries:
                z = zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                z.precompute_compress(compression_params=p)
                self._compressors.append(zstandard.ZstdCompressor(dict_data=z, compression_params=p))
        start, size = windows(len(text))
        cut = zstandard.BufferWithSegments(text, np.stack([start, size], 1).astype(np.uint64).tobytes())
        out = []
        for c in self._compressors:
            got = c.multi_compress_to_buffer(cut, threads=0)
            out.append(np.fromiter((len(got[i]) for i in range(len(got))), np.int64, len(got)))
        return out

    def evidence(self, text: bytes) -> tuple[float, float, float, float]:
        """Of the bytes that windows save with the toxic dictionary: sum beyond one a window (log), mean, most, sum a window (log)."""
        if not text:
            return 0.0, 0.0, 0.0, 0.0
        parts = [self._lengths(text[i : i + (1 << 20)]) for i in range(0, len(text), 1 << 20)]
        save = np.concatenate([o - t for t, o in parts])
        more = math.log1p(float(np.maximum(save - 1, 0).sum()))
        return more, float(save.mean()), float(save.max()), more - math.log(len(save))

    def _calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-9
        z = np.c_[(x - self.mean) / self.scale, np.ones(len(x))]
        w = np.zeros(5)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            w = w - np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 0.01 * np.eye(5), z.T @ (p - y) + 0.01 * w)
        self.weights, order = w, np.argsort(-(z @ w), kind="stable")
        found = np.cumsum(y[order])
        best = int(((1 + RECALL**2) * found / (np.arange(1, len(y) + 1) + RECALL**2 * y.sum())).argmax())
        near = (z @ w)[order][best : best + 2]
        self.shift = math.log(THRESHOLD / (1 - THRESHOLD)) - float(near.mean())

    def score(self, text: str | None) -> float:
        x = (np.array(self.evidence(folded(text))) - self.mean) / self.scale
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, x @ self.weights[:4] + self.weights[4] + self.shift)))))


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model from labelled documents; None if there are not both toxic and ordinary ones. The chosen identifiers are bounded and broadcast, so texts are not shuffled."""
    marked = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r[0]: r[1] for r in marked.groupBy("toxic").count().collect()}
    if not (sizes.get(0) and sizes.get(1)):
        return None
    some = bounded(marked.filter("toxic = 1"), F.col("doc_id"), "toxic", TOXIC_DOCS, sizes).union(bounded(marked.filter("toxic = 0"), F.col("doc_id"), "toxic", ORDINARY_DOCS, sizes))
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("doc_id", "toxic", "text").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"] or ""))
    toxic, ordinary = ([folded(r["text"]) for r in rows if r["toxic"] == k and r["text"]] for k in (1, 0))
    return Model(toxic, ordinary) if toxic and ordinary else None


def score_toxicity(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score, predicted for each document."""

    def run(batches):
        for b in batches:
            s = [model.score(x.as_py()) if model else 0.0 for x in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array(s, pa.float64()), pa.array([int(x >= THRESHOLD) for x in s], pa.int32())], ["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double, predicted int")


def predict_held_out(docs: DataFrame, labels: DataFrame) -> DataFrame:
    aside = held_out(F.col("doc_id"), 3, 1)
    model = train(docs, labels.filter(~aside))
    return score_toxicity(docs, model).select("doc_id", aside.alias("held_out"), "score", "predicted")
