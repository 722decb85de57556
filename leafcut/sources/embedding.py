"""Vectors of pages from providers that may fail: page by page where a batch fails, provider by provider, image and text apart."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What stands for a page without text.
EMPTY_PAGE = "document page"
#: Pages of a call, tries of a page that fails alone, and pages in a row that fail alone before a provider is taken to be down for the rest of a batch.
BATCH, TRIES, DOWN = 64, 5, 32
EMBEDDED = "doc_id string, page_num int, image_embedding array<double>, text_embedding array<double>, method string, text_tokens long, image_tokens long, rank int, status string"
_NAMES = [x.split()[0] for x in EMBEDDED.split(", ")]


class EmbeddingProvider(Protocol):
    """Vectors for a batch of pages: (image vector, text vector, method) each, and the text and image tokens it used if it tells them. Where pages have an `image` column, the page images (PNG bytes or null) come second."""

    def __call__(self, texts: list[str], images: list[bytes | None] = ...) -> list[tuple]: ...


@dataclass(frozen=True)
class Parts:
    """A provider of two services. A page whose image fails has failed here; one whose text fails keeps its image and has no text vector."""

    image: Callable[[list[bytes | None]], list[list[float]]]
    #: (vector, tokens or null) each.
    text: Callable[[list[str]], list[tuple]]
    method: str = "fallback"


def one_by_one(call: Callable[[list], list], rows: list, tries: int, wait: Callable[[int], None] | None = None, down: int = DOWN) -> list:
    """call(rows) for each row, or the error of a row for which it fails. A batch that fails is halved until the failing row is alone; only that is tried again. After `down` such rows in a row the rest fail with the last error, uncalled."""
    out: list = [None] * len(rows)
    failed, last = 0, None

    def go(lo: int, hi: int) -> None:
        nonlocal failed, last
        if failed >= down:
            out[lo:hi] = [last] * (hi - lo)
            return
        for k in range(tries if hi - lo == 1 else 1):
            try:
                got = list(call(rows[lo:hi]))
                if len(got) != hi - lo:
                    raise ValueError(f"{len(got)} results for {hi - lo} pages")
                out[lo:hi], failed = got, 0
                return
            except Exception as e:  # noqa: BLE001  whatever a provider raises, the pages beside must not suffer
                last = e
                if wait and hi - lo == 1 and k + 1 < tries:
                    wait(k)
        if hi - lo == 1:
            out[lo], failed = last, failed + 1
            return
        mid = (lo + hi) // 2
        go(lo, mid)
        go(mid, hi)

    if rows:
        go(0, len(rows))
    return out


def _say(e: Exception) -> str:
    return f"{type(e).__name__}: {e}"[:200]


def _asked(provider, texts: list[str], images: list | None, tries: int, wait) -> list:
    """For each page (image vector, text vector, method, text tokens, image tokens, status), or an error."""
    if isinstance(provider, Parts):
        pictures = one_by_one(provider.image, images if images is not None else [None] * len(texts), tries, wait)
        seen = [i for i, x in enumerate(pictures) if not isinstance(x, Exception)]
        words = dict(zip(seen, one_by_one(provider.text, [texts[i] for i in seen], tries, wait), strict=True))
        out = list(pictures)
        for i in seen:
            w = words[i]
            out[i] = (pictures[i], None, provider.method, None, None, f"text failed: {_say(w)}") if isinstance(w, Exception) else (pictures[i], w[0], provider.method, w[1] if len(w) > 1 else None, None, "ok")
        return out
    both = list(zip(texts, images, strict=True)) if images is not None else texts
    call = (lambda xs: provider([t for t, _ in xs], [i for _, i in xs])) if images is not None else provider
    return [x if isinstance(x, Exception) else (*(*x, None, None)[:5], "ok") for x in one_by_one(call, both, tries, wait)]


def embed(pages: DataFrame, providers: list[EmbeddingProvider | Parts], tries: int = TRIES, wait: Callable[[int], None] | None = None, batch: int = BATCH) -> DataFrame:
    """Vectors of pages that are not blank, as EMBEDDED. What the first provider fails for goes to the next one, page by page. rank tells which provider answered, null where none did; status says ok, that the text failed, or why the page failed (see failed_documents). Tokens are null where a provider tells none; costs follow from money.calls()."""
    pictured = "image" in pages.columns

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            for at in range(0, len(p), batch):
                own = p.iloc[at : at + batch]
                texts = [(t or "").strip() or EMPTY_PAGE for t in own["text"]]
                images = [None if x is None else bytes(x) for x in own["image"]] if pictured else None
                rows: list = [(None, None, "failed", None, None, None, "failed: no provider")] * len(own)
                left = list(range(len(own)))
                for rank, provider in enumerate(providers):
                    got = _asked(provider, [texts[i] for i in left], [images[i] for i in left] if pictured else None, tries, wait)
                    for i, x in zip(left, got, strict=True):
                        rows[i] = (None, None, "failed", None, None, None, f"failed: {_say(x)}") if isinstance(x, Exception) else (*x[:5], rank, x[5])
                    left = [i for i, x in zip(left, got, strict=True) if isinstance(x, Exception)]
                    if not left:
                        break
                out = pd.DataFrame({"doc_id": own["doc_id"], "page_num": own["page_num"]})
                for k, name in enumerate(_NAMES[2:]):
                    out[name] = pd.Series([x[k] for x in rows], index=own.index, dtype="Int64" if name.endswith("tokens") or name == "rank" else "object")
                yield out

    return pages.filter("NOT is_blank").select("doc_id", "page_num", "text", *(["image"] if pictured else [])).mapInPandas(run, EMBEDDED)


def failed_documents(embedded: DataFrame) -> DataFrame:
    """doc_id, status and error of documents of which a page has no vector, whose run therefore counts as failed; a text that failed does not count."""
    bad = embedded.filter("rank IS NULL").groupBy("doc_id").agg(F.min_by("status", "page_num").alias("error"))
    return bad.select("doc_id", F.lit("FAILED").alias("status"), "error")
