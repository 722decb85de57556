"""Language identification by rank-order profiles.

Each language's profile ranks its most frequent character n-grams (1 to 3 letters of a word, with a blank for the word's
ends). A document's most frequent n-grams are ranked likewise over its whole text; a language's distance is the sum of
how far each is out of place in its profile, an n-gram that the profile lacks counting as PROFILE places. The nearest
language is predicted; the score is the share of that language when the distances are weighed exponentially.

Defined results: a null text, or one without a letter, is `und` with score 0; so is every text if there is nothing to
learn from; equal distances go to the first language by name; n-grams of equal frequency rank by code; other columns are
ignored; no rows give no rows.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafcut.llm.common import bounded, held_out, keep_rows

PROFILE = 400
#: A profile is learned from about so many documents of its language; the statistics of a bounded sample of labelled rows.
DOCS_PER_LANGUAGE = 4000
SHARPNESS = 40.0
_CHUNK = 1 << 18
_LETTER: list = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes of a text's n-grams in ascending order, and how often each occurs. A code packs up to three code points."""
    cp = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    is_letter = _letters()[cp]
    if not is_letter.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cp = np.where(is_letter, cp, np.uint64(32))
    cp = np.concatenate(([np.uint64(32)], cp, [np.uint64(32)] * 2))
    found = []
    for i in range(0, len(cp) - 2, _CHUNK):
        c = cp[i : i + _CHUNK + 2]
        s, b = c != 32, np.uint64(21)
        one, two = c[:-2], c[:-1] << b | c[1:]
        three = two[:-1] << b | c[2:]
        # Starts in this chunk only; a gram holds a letter and no inner blank.
        codes = np.concatenate((one[s[:-2]], two[:-1][s[:-2] | s[1:-1]], three[s[1:-1]]))
        found.append(np.unique(codes.view(np.int64), return_counts=True))
    if len(found) == 1:
        return found[0]
    code, at = np.unique(np.concatenate([x[0] for x in found]), return_inverse=True)
    return code, np.bincount(at, np.concatenate([x[1] for x in found])).astype(np.int64)


def top(code: np.ndarray, n: np.ndarray, k: int = PROFILE) -> np.ndarray:
    """The k most frequent codes in order of rank."""
    return code[np.argsort((65535 - n).astype(np.uint16) if len(n) and n.max() < 65535 else -n, kind="stable")[:k]]


def learn(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> dict[str, np.ndarray]:
    """Profiles of the languages in `lang`, most frequent n-gram first; PROFILE codes a language reach the driver."""
    rows = docs.select("doc_id", "text", "lang").filter("lang IS NOT NULL AND text IS NOT NULL")
    rows = bounded(rows, F.col("doc_id"), "lang", per_language)

    def count(batches):
        held = defaultdict(list)
        for b in batches:
            for text, lang in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                held[lang].append(grams(text))
                if len(held[lang]) >= 200:
                    held[lang] = [_merged(held[lang])]
        for lang, parts in held.items():
            code, n = _merged(parts)
            if len(code):
                yield pa.record_batch([pa.array([lang] * len(code), pa.string()), pa.array(code), pa.array(n)], ["lang", "code", "n"])

    counts = rows.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code")).alias("place")
    best = counts.select("lang", "code", place).filter(F.col("place") <= PROFILE).collect()
    out: dict = defaultdict(dict)
    for r in best:
        out[r["lang"]][r["place"]] = r["code"]
    return {lang: np.array([out[lang][i] for i in sorted(out[lang])], np.int64) for lang in sorted(out)}


def _merged(parts) -> tuple[np.ndarray, np.ndarray]:
    code, at = np.unique(np.concatenate([x[0] for x in parts]), return_inverse=True)
    return code, np.bincount(at, np.concatenate([x[1] for x in parts])).astype(np.int64)


class Ranker:
    """Profiles as one table: a sorted list of codes and each language's place for it."""

    def __init__(self, profiles: dict[str, np.ndarray]):
        self.names = sorted(profiles)
        self.codes = np.unique(np.concatenate([profiles[x] for x in self.names])) if self.names else np.empty(0, np.int64)
        self.place = np.full((len(self.codes) + 1, len(self.names)), -1, np.int32)
        for j, x in enumerate(self.names):
            self.place[np.searchsorted(self.codes, profiles[x]), j] = np.arange(len(profiles[x]))

    def predict(self, text: str | None) -> tuple[str, float]:
        ranked = top(*grams(text))
        if not len(ranked) or not self.names:
            return "und", 0.0
        at = np.searchsorted(self.codes, ranked)
        at[(at == len(self.codes)) | (self.codes[np.minimum(at, len(self.codes) - 1)] != ranked)] = len(self.codes)
        place = self.place[at]
        far = np.where(place < 0, PROFILE, np.abs(place - np.arange(len(ranked))[:, None])).sum(0)
        best = int(far.argmin())
        weight = np.exp((far[best] - far) * (SHARPNESS / (len(ranked) * PROFILE)))
        return self.names[best], float(1 / weight.sum())


def identify(docs: DataFrame, profiles: dict[str, np.ndarray]) -> DataFrame:
    """doc_id, lang_pred, score for each document; the prediction sees the text alone."""
    ranker = Ranker(profiles)

    def run(batches):
        for b in batches:
            got = [ranker.predict(x.as_py()) for x in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def predict_held_out(docs: DataFrame) -> DataFrame:
    aside = held_out(F.col("doc_id"), 4, 2)
    out = identify(docs, learn(docs.filter(~aside)))
    return out.select("doc_id", aside.alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame) -> DataFrame:
    """docs without those whose language is undetermined."""
    ranker = Ranker(learn(docs.filter(~held_out(F.col("doc_id"), 4, 2))))
    return keep_rows(docs, "text", lambda texts: [ranker.predict(x)[0] != "und" for x in texts])
