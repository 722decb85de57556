"""Near duplicates: an exact Jaccard join over word n-grams by vertical partitioning.

Every document is a set of shingles of five words, known by 64-bit hashes, and a set by the 64-bit sum of theirs. The global order puts shingles that are
frequent within the corpus last. Two documents can only be similar enough if a short prefix of each in that order shares a
shingle, which gives the candidates; where it stands in each set bounds what they can share. The order is cut into fragments; the overlap of a candidate pair is counted in each
fragment separately and summed per pair. Equal sets are joined as one. Frequent prefixes are not expanded into all pairs:
a few rounds compare each document with hubs and join what is linked; then every candidate pair that is still in different
components is compared, so that no component is missed.

Defined results: only A-Z are lower-cased and only ASCII white space parts words; a text of fewer words is one shingle; a
null or blank text has no shingles and is linked with nothing; rows without an identifier are returned with a null
component, but link others; rows that share an identifier are judged each by its own text; fully repeated rows give
repeated results; long texts are hashed in stretches of whole words; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafcut.llm.common import HOT_LEAST, HOT_SHARE, among, any_hot, attach, components, mix, passing, release, row_id, stage, unstage, without

WORDS = 5
#: Shingles that a memtable meets in FREQUENT documents are counted, and those with a count of KNOWN come last; this only changes the order, never the result.
FREQUENT, KNOWN, MEMTABLE, ORDER_BITS = 2, 8, 4_000_000, 22
#: From so many documents (a power of two) a shingle's rows are spread over several tasks.
SPREAD = 12
FRAGMENTS = 4
#: Least and most bits of a set's parity map, which bounds an overlap from above before it is counted; between them a map has a bit a shingle or more.
LEAST_BITS, MOST_BITS = 512, 1 << 15
#: Rounds of hubs before all remaining candidates are compared, and hubs of each group outside its largest component.
HUB_ROUNDS, HUBS = 2, 3
_CHUNK = 1 << 19
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BYTE = mix(np.arange(256, dtype=np.uint64) + np.uint64(0x5EED))
_PLACE = mix(np.arange(WORDS, dtype=np.uint64) + np.uint64(0xACE)) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.empty(0, np.uint64)


def _hashes(data: np.ndarray, first) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and what they hash to; a word never goes over a place in first. Each place of a word has a number of its own, so that no pattern of bytes cancels another."""
    low = _LOWER[data]
    inside = ~_SPACE[low]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    start[first] = inside[first]
    st, nz = np.flatnonzero(start), np.flatnonzero(inside)
    if not len(st):
        return st, _EMPTY
    begins = start[nz]
    place = nz - st[np.cumsum(begins) - 1]
    number = mix(np.arange(int(place.max()) + 1, dtype=np.uint64) + _BASE)
    return st, mix(np.add.reduceat(_BYTE[low[nz]] * number[place], np.flatnonzero(begins)))


def _fives(h: np.ndarray) -> np.ndarray:
    return mix(sum(h[i : len(h) - WORDS + 1 + i] * _PLACE[i] for i in range(WORDS))) if len(h) >= WORDS else _EMPTY


def _set(h: np.ndarray, five: np.ndarray) -> np.ndarray:
    """The sorted set of a text's shingles, given its words and their runs of five."""
    if len(h) >= WORDS:
        s = np.sort(five)
        return s[np.concatenate(([True], s[1:] != s[:-1]))]
    return mix(np.array([(h * _PLACE[: len(h)]).sum() + np.uint64(len(h))], np.uint64)) if len(h) else _EMPTY


def _chunk_sets(data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    st, h = _hashes(data, at[:-1][at[1:] > at[:-1]])
    five = _fives(h)
    bound = np.searchsorted(st, at).tolist()
    return [_set(h[a:b], five[a : max(a, b - WORDS + 1)]) for a, b in zip(bound, bound[1:], strict=False)]


def _long_set(data: np.ndarray) -> np.ndarray:
    """The set of a text longer than a chunk, whose words are hashed a stretch at a time; stretches end at white space."""
    space, cut = np.flatnonzero(_SPACE[data]), [0]
    while (i := int(np.searchsorted(space, cut[-1] + _CHUNK))) < len(space):
        cut.append(int(space[i]))
    h = np.concatenate([_hashes(data[a:b], [0])[1] for a, b in zip(cut, [*cut[1:], len(data)], strict=True) if b > a] or [_EMPTY])
    return _set(h, _fives(h))


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted set of shingle hashes of each text."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(off, off[i] + _CHUNK, "right")) - 1)
        if off[j] - off[i] > _CHUNK:
            yield _long_set(data[off[i] : off[j]])
        else:
            yield from _chunk_sets(data[off[i] : off[j]], off[i : j + 1] - off[i])
        i = j


def _key(s: np.ndarray) -> bytes:
    """What tells one set from another: two 64-bit sums and the size."""
    return np.array([mix(s).sum(), np.bitwise_xor.reduce(mix(s + _BASE)), len(s)], np.uint64).tobytes()


def _parity(s: np.ndarray) -> bytes:
    """Bit i tells whether an odd number of shingles end in i. Sets that differ in few shingles differ in no more bits."""
    bits = min(max(LEAST_BITS, 1 << (len(s) - 1).bit_length()), MOST_BITS)
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _fold(parity: bytes) -> list[int]:
    """The map folded to LEAST_BITS bits, as longs."""
    return np.bitwise_xor.reduce(np.frombuffer(parity, np.int64).reshape(-1, LEAST_BITS // 64), axis=0).tolist()


def _may_link(batches):
    """Of pairs with their parity maps, those whose overlap could reach the threshold; the wider map is folded to the width of the other."""
    for b in batches:
        na, nb = (b.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
        maps = [b.column(i) for i in (4, 5)]
        wide = np.stack([pc.binary_length(m).to_numpy(zero_copy_only=False) for m in maps])
        differ = np.zeros(b.num_rows, np.int64)
        for width in np.unique(wide, axis=1).T:
            at = np.flatnonzero((wide == width[:, None]).all(0))
            x, y = (np.frombuffer(b"".join(m.take(pa.array(at)).to_pylist()), np.uint8).reshape(len(at), -1) for m in maps)
            least = int(width.min())
            x, y = (np.bitwise_xor.reduce(z.reshape(len(at), -1, least), axis=1) for z in (x, y))
            differ[at] = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
        most = (na + nb - differ) // 2
        yield b.select(["a", "b", "na", "nb"]).filter(pa.array(100 * most >= 80 * (na + nb - most)))


def _node(s: np.ndarray) -> int:
    """The number that stands for a set in groups, pairs and links."""
    return int(np.array([mix(s).sum()], np.uint64).view(np.int64)[0])


_SCANNED = "doc_id long, pick long, node long, n long, key binary, parts binary, fold array<long>, h long, c long"


def _scan(batches):
    """Node, size, key and parity map of each document's set, and the shingles that are frequent among a task's documents."""
    names = [x.split()[0] for x in _SCANNED.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64()]
    held, size = np.empty(MEMTABLE, np.uint64), 0

    def flush():
        # Sorted in place: the table is never copied whole.
        now = held[:size]
        now.sort()
        cut = np.flatnonzero(np.concatenate(([True], now[1:] != now[:-1])))
        c = np.diff(np.concatenate((cut, [size])))
        h, c = now[cut[c >= FREQUENT]], c[c >= FREQUENT]
        return pa.record_batch([*(pa.nulls(len(h), k) for k in kinds[:-2]), pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], names)

    for b in batches:
        node, n, key, parts = [], [], [], []
        for s in shingle_sets(b.column(1)):
            node.append(_node(s))
            n.append(len(s))
            key.append(_key(s))
            parts.append(_parity(s) if len(s) else None)
            while len(s):
                some = s[: MEMTABLE - size]
                held[size : size + len(some)] = some
                size += len(some)
                s = s[len(some) :]
                if size == MEMTABLE:
                    yield flush()
                    size = 0
        none = pa.nulls(len(n), pa.int64())
        yield pa.record_batch([b.column(0), b.column(2), *(pa.array(x, k) for x, k in zip((node, n, key, parts, [p and _fold(p) for p in parts]), kinds[2:], strict=False)), none, none], names)
    if size:
        yield flush()


def _level(s: np.ndarray, levels: np.ndarray) -> np.ndarray:
    return levels[(s & np.uint64(len(levels) - 1)).astype(np.int64)]


def _prefixes(shared):
    """(level, h, salt, doc, n, p) for the prefix of each set of n shingles; level and h give the global order, p a shingle's place in its set by that order."""
    names = ["level", "h", "salt", "doc", "n", "p"]

    def batch(*columns):
        level, h, *rest = (np.concatenate(x) for x in columns)
        return pa.record_batch([pa.array(level.astype(np.int32)), pa.array((h ^ np.uint64(1 << 63)).view(np.int64)), *(pa.array(x.astype(np.int64)) for x in rest)], names)

    def run(batches):
        levels, chosen = shared[0].value, shared[1]
        for b in batches:
            take = passing(chosen, b.column(0).to_numpy(zero_copy_only=False))
            lists = at, hs, salts, docs, sizes, spots = [], [], [], [], [], []
            rows = 0
            for s in shingle_sets(b.column(1).take(pa.array(take))):
                n = len(s)
                if not n:
                    continue
                node, level = _node(s), _level(s, levels)
                order = np.argsort(level, kind="stable")[: n - (4 * n + 4) // 5 + 1]
                s, level = s[order], level[order].astype(np.int64)
                own = int(mix(np.array([node], np.int64).view(np.uint64))[0] >> np.uint64(1))
                at.append(level)
                hs.append(s)
                salts.append(np.where(level >= SPREAD, own & ((1 << np.maximum(level - SPREAD + 1, 0)) - 1), -1))
                docs.append(np.full(len(s), node, np.int64))
                sizes.append(np.full(len(s), n, np.int64))
                spots.append(np.arange(len(s)))
                rows += len(s)
                if rows > 100_000:
                    yield batch(*lists)
                    for x in lists:
                        x.clear()
                    rows = 0
            if hs:
                yield batch(*lists)

    return run


def _groups(batches):
    """From rows in the global order: the groups of documents that share a shingle, each set of members once a task, at its first shingle; the group is known by a hash of its members, a spread shingle's by the shingle."""
    seen: set = set()
    carry = None

    def emit(h, salt, doc, n, p):
        cut = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (salt[1:] != salt[:-1]))))
        size = np.diff(np.concatenate((cut, [len(h)])))
        wide = salt[cut] >= 0
        order = np.repeat(np.arange(len(cut)), size)
        d = doc.view(np.uint64)
        sign = np.add.reduceat(mix(d) + mix(d ^ (n.view(np.uint64) << np.uint64(40))), cut).view(np.int64)
        gid = np.where(wide, h[cut], sign)
        fresh = np.zeros(len(cut), bool)
        for i in np.flatnonzero((size > 1) | wide).tolist():
            if wide[i]:
                fresh[i] = True
            elif (g := int(sign[i])) not in seen:
                seen.add(g)
                fresh[i] = True
        if len(seen) > 200_000:
            seen.clear()
        rows = np.flatnonzero(fresh[order])
        return pa.record_batch([pa.array(gid[order][rows]), pa.array(doc[rows]), pa.array(n[rows]), pa.array(p[rows])], ["g", "doc", "n", "p"])

    for b in batches:
        now = [b.column(i).to_numpy(zero_copy_only=False) for i in range(1, 6)]
        if carry is not None:
            now = [np.concatenate(x) for x in zip(carry, now, strict=True)]
        h, salt = now[0], now[1]
        if not len(h):
            continue
        last = np.flatnonzero((h != h[-1]) | (salt != salt[-1]))
        end = int(last[-1]) + 1 if len(last) else 0
        if end:
            yield emit(*(x[:end] for x in now))
        carry = [x[end:] for x in now]
    if carry is not None and len(carry[0]):
        yield emit(*carry)


def _segments(shared):
    """(doc, frag, els): each chosen document's set, cut by the fragments of the global order."""

    def run(batches):
        levels, needed = shared[0].value, shared[1]
        names = ["doc", "frag", "els"]

        def batch(docs, frags, els):
            at = np.concatenate(([0], np.cumsum([len(x) for x in els]))).astype(np.int32)
            return pa.record_batch([pa.array(docs, pa.int64()), pa.array(frags, pa.int32()), pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(els)))], names)

        for b in batches:
            take = passing(needed, b.column(0).to_numpy(zero_copy_only=False))
            docs, frags, els = [], [], []
            rows = 0
            for s in shingle_sets(b.column(1).take(pa.array(take))):
                node = _node(s)
                frag = np.where(_level(s, levels) > 0, FRAGMENTS, (s >> np.uint64(62)).astype(np.int64))
                for f in range(FRAGMENTS + 1):
                    part = s[frag == f]
                    if len(part):
                        docs.append(node)
                        frags.append(f)
                        els.append(part.view(np.int64))
                rows += len(s)
                if rows > 500_000:
                    yield batch(docs, frags, els)
                    docs, frags, els, rows = [], [], [], 0
            if docs:
                yield batch(docs, frags, els)

    return run


def _hot(pairs: DataFrame, total: int) -> dict[str, str]:
    """For sides a and b of pairs, SQL for the number of tasks that a document's pairs are dealt over: 1, but for the documents, such as hubs, that have more than HOT_SHARE of all pairs; so at most 1 / HOT_SHARE of them a side reach the driver."""
    least = max(int(total * HOT_SHARE), HOT_LEAST // 4)
    end = lambda side: F.struct(F.lit(side).alias("side"), F.col(side).alias("k"))
    many = pairs.select(F.explode(F.array(end("a"), end("b"))).alias("e")).groupBy("e.side", "e.k").count().filter(F.col("count") > least).collect()
    of = {side: ", ".join(f"{r['k']}L, {-(-r['count'] // least)}" for r in many if r["side"] == side) for side in ("a", "b")}
    return {side: f"coalesce(element_at(map({known}), {{}}), 1)" if known else "" for side, known in of.items()}


def _split(pairs: DataFrame, side: str, other: str, rows: DataFrame, hot: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Pairs and rows (by doc, now by side) with one more column to join by: the pairs of a document with many are dealt over several tasks, as _hot() says, and its rows repeated for each."""
    salt, wide = "s" + side, hot[side]
    dealt = pairs.withColumn(salt, F.expr(f"pmod(hash({other}), {wide.format(side)})") if wide else F.lit(0))
    many = rows.withColumn(salt, F.expr(f"explode(sequence(0, {wide.format('doc')} - 1))") if wide else F.lit(0))
    return dealt, many.withColumnRenamed("doc", side)


def _verified(pairs: DataFrame, segments: DataFrame, total: int) -> DataFrame:
    """Of pairs (a, b, na, nb) those with 100 * intersection >= 80 * union: overlaps are counted fragment by fragment and summed per pair."""
    hot = _hot(pairs, total)
    pairs, one = _split(pairs, "a", "b", segments.withColumnRenamed("els", "ea"), hot)
    pairs, two = _split(pairs, "b", "a", segments.withColumnRenamed("els", "eb"), hot)
    met = pairs.join(one, ["a", "sa"]).join(two, ["b", "sb", "frag"]).select("a", "b", "na", "nb", F.size(F.array_intersect("ea", "eb")).cast("long").alias("o"))
    return met.groupBy("a", "b", "na", "nb").agg(F.sum("o").alias("overlap")).filter("100 * overlap >= 80 * (na + nb - overlap)").select("a", "b", "overlap")


def _first(turn: int, i: int):
    """The document of the smallest hash, with its size; after the first turn each group has its own hash, so that a document meets several hubs."""
    return F.min(F.struct(F.hash("doc", F.lit(turn * (HUBS + 1) + i), *([F.col("g")] if turn else [])).alias("x"), F.col("doc").alias("a"), F.col("n").alias("na"), F.col("p").alias("pa")))


def _fits(n: str, p: str, m: str, q: str) -> str:
    """Whether sets of n and m shingles could link if the first that they share stands at places p and q: what comes before is not shared. It holds at the first shared shingle of any two that link."""
    return f"9 * least({n} - {p}, {m} - {q}) >= 4 * ({n} + {m})"


def _close(x: str, y: str, n: str, m: str) -> str:
    """Whether the folded parity maps of sets of n and m shingles leave room for a link."""
    return f"9 * ({' + '.join(f'bit_count({x}[{i}] ^ {y}[{i}])' for i in range(LEAST_BITS // 64))}) <= {n} + {m}"


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for each document."""
    return _near(docs)[0].drop("pick")


def _near(docs: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """doc_id, n_shingles, component_id and row_id (as pick) for each document, and the staged tables that this frame reads. Nodes are sets, not identifiers, so texts that share an identifier stay apart."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), row_id().alias("pick"))
    scanned = stage(docs.mapInArrow(_scan, _SCANNED), "sets")
    rows = scanned.filter("key IS NOT NULL").select("doc_id", "pick", "n", "key")
    one = F.coalesce(F.min_by("pick", "doc_id"), F.min("pick")).alias("pick")
    sets = stage(scanned.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("size"), F.first("node").alias("node"), one), "classes")
    frequent = scanned.filter("h IS NOT NULL").groupBy("h").agg(F.sum("c").alias("c")).filter(F.col("c") >= KNOWN).groupBy(F.col("h").bitwiseAND(F.lit((1 << ORDER_BITS) - 1)).alias("p")).agg(F.floor(F.log2(F.max("c"))).cast("int").alias("level")).toPandas()
    levels = np.zeros(1 << ORDER_BITS, np.uint8)  # a table of fixed size, however large the corpus
    levels[frequent["p"].to_numpy(np.int64)] = frequent["level"].to_numpy(np.uint8)
    del frequent
    twice = not rows.filter("n > 0").groupBy("pick").count().filter("count > 1").isEmpty()

    known = docs.select("pick", "text")
    levels = spark.sparkContext.broadcast(levels)
    source, chosen = among(known, "pick", sets.select("pick"))
    prefixes = source.mapInArrow(_prefixes((levels, chosen)), "level int, h long, salt long, doc long, n long, p long")
    sorted_ = prefixes.repartition("h", "salt").sortWithinPartitions("level", "h", "salt", "n", "doc")
    grouped = sorted_.mapInArrow(_groups, "g long, doc long, n long, p long")
    groups = stage(grouped.groupBy("g", "doc", "n").agg(F.min("p").alias("p")), "groups")
    if chosen is not None:
        chosen.destroy()
    # One row a set before the join, so that many copies of one text are brought together within tasks first.
    parts = stage(scanned.filter("n > 0").select(F.col("node").alias("doc"), "pick", "parts", "fold").dropDuplicates(["doc"]).join(groups.select("doc").distinct(), "doc"), "parts")

    tried, found, kept = None, None, [sets, groups, parts]
    turn = 0
    while turn <= HUB_ROUNDS:
        now = groups.withColumn("c", F.col("doc"))
        if found is not None:
            now = groups.join(found, groups["doc"] == found["node"], "left").select(*groups.columns, F.coalesce("component", "doc").alias("c"))
        # Groups that lie within one component have nothing more to tell.
        now = stage(now, "rows")
        n_rows = now.count()
        per = now.groupBy("g", "c").agg(F.count("*").alias("k"), *(_first(turn, i).alias(f"h{i}") for i in range(HUBS + 1)))
        main = per.groupBy("g").agg(F.sum("k").alias("gk"), F.max(F.struct("k", "c", F.col("h0.a").alias("a"), F.col("h0.na").alias("na"), F.col("h0.pa").alias("pa"))).alias("m"), F.count("*").alias("parts")).filter("parts > 1").select("g", "gk", F.col("m.c").alias("main"), F.struct("m.a", "m.na", "m.pa", F.col("m.c").alias("ca"), F.lit(0).alias("kind")).alias("m0"))
        if turn < HUB_ROUNDS:
            # Rows outside a group's largest component, against a hub of that component and some from outside it.
            rest = [F.min(F.struct(F.col(f"h{i}.x").alias("x"), F.col(f"h{i}.a").alias("a"), F.col(f"h{i}.na").alias("na"), F.col(f"h{i}.pa").alias("pa"), F.col("c").alias("ca"))).alias(f"r{i}") for i in range(1, HUBS + 1)]
            hubs = per.join(main, "g").filter("c <> main").groupBy("g", "gk", "main", "m0").agg(*rest)
            hubs = hubs.select("g", "gk", "main", F.array("m0", *(F.struct(f"r{i}.a", f"r{i}.na", f"r{i}.pa", f"r{i}.ca", F.lit(i).alias("kind")) for i in range(1, HUBS + 1))).alias("hubs"))
            spent = stage(hubs, "hubs")
            near = attach(now, spent, "g", "gk", n_rows, any_hot(spent, "gk", n_rows)).filter("c <> main").select("doc", "n", "p", "c", F.inline("hubs")).filter(f"c <> ca AND {_fits('n', 'p', 'na', 'pa')}")
            near = near.groupBy("doc", "n", "a", "na", "kind").agg(F.count("*").alias("k")).withColumnsRenamed({"a": "x", "na": "nx"})
            near = near.select(F.least("x", "doc").alias("a"), F.greatest("x", "doc").alias("b"), F.when(F.col("x") < F.col("doc"), F.col("nx")).otherwise(F.col("n")).alias("na"), F.when(F.col("x") < F.col("doc"), F.col("n")).otherwise(F.col("nx")).alias("nb"), "doc", "kind", "k")
            if tried is not None:
                near = near.join(tried.select("a", "b"), ["a", "b"], "left_anti")
            # The first turn takes the hub that shares most groups with a document, later ones all hubs it meets.
            pairs = near.select("a", "b", "na", "nb").distinct() if turn else near.groupBy("doc", "kind").agg(F.max(F.struct("k", "a", "b", "na", "nb")).alias("p")).select("p.a", "p.b", "p.na", "p.nb").distinct()
        else:
            # All candidate pairs across components: rows outside a group's largest component, against all rows.
            open_ = now.join(main.select("g", "main"), "g")
            open_ = stage(open_.join(parts.select("doc", "fold"), "doc"), "open")
            spent = open_
            few = open_.filter("c <> main").select("g", F.col("doc").alias("x"), F.col("n").alias("nx"), F.col("p").alias("px"), F.col("c").alias("cx"), F.col("fold").alias("fx"))
            met = few.join(open_, "g").filter(f"c <> cx AND (c = main OR x < doc) AND {_fits('n', 'p', 'nx', 'px')} AND {_close('fold', 'fx', 'n', 'nx')}")
            pairs = met.select(F.least("x", "doc").alias("a"), F.greatest("x", "doc").alias("b"), F.when(F.col("x") < F.col("doc"), F.col("nx")).otherwise(F.col("n")).alias("na"), F.when(F.col("x") < F.col("doc"), F.col("n")).otherwise(F.col("nx")).alias("nb")).distinct()
            if tried is not None:
                pairs = pairs.join(tried.select("a", "b"), ["a", "b"], "left_anti")
        pairs = stage(pairs, "pairs")
        n_pairs = pairs.count()
        unstage(spent)
        hot = _hot(pairs, n_pairs)
        bounds, pa_ = _split(pairs, "a", "b", parts.select("doc", F.col("parts").alias("pa")), hot)
        bounds, pb_ = _split(bounds, "b", "a", parts.select("doc", F.col("parts").alias("pb")), hot)
        bounds = bounds.join(pa_, ["a", "sa"]).join(pb_, ["b", "sb"])
        near_ = stage(bounds.select("a", "b", "na", "nb", "pa", "pb").mapInArrow(_may_link, "a long, b long, na long, nb long"), "near")
        wanted = near_.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
        wanted = stage(parts.join(wanted, "doc").select("pick"), "wanted")
        source, needed = among(known, "pick", wanted)
        segments = source.mapInArrow(_segments((levels, needed)), "doc long, frag int, els array<long>")
        segments = stage(segments.dropDuplicates(["doc", "frag"]) if twice else segments, "segments")
        good = stage(_verified(near_, segments, near_.count()), "links")
        unstage(segments, near_, wanted)
        kept.append(pairs)
        if needed is not None:
            needed.destroy()
        tried = pairs if tried is None else tried.unionByName(pairs)
        if turn == 0 or not good.isEmpty():
            # What is known already goes in as one link a node, not as all links so far.
            links = good.select("a", "b") if found is None else good.select("a", "b").union(found.filter("node <> component"))
            before, found = found, stage(components(links, "a", "b"), "components")
            unstage(*[before] if before is not None else [])
        unstage(now, good)
        release(spark)
        # A round without new pairs ends the rounds; the last turn, over all that is left, always comes.
        turn = max(turn + 1, HUB_ROUNDS) if turn < HUB_ROUNDS and pairs.isEmpty() else turn + 1
    levels.destroy()
    classes = sets.join(found, sets["node"] == found["node"], "left").select("key", "size", "rep", F.coalesce("component", sets["node"]).alias("c"))
    least = stage(classes.groupBy("c").agg(F.min("rep").alias("component_id"), F.count("*").alias("k")), "least")
    n_sets = sets.count()
    answers = stage(attach(classes, least, "c", "k", n_sets, any_hot(least, "k", n_sets)).select("key", "size", "component_id"), "answers")
    # All that the answers were made from is spent now.
    unstage(*kept, found, least)
    release(spark)
    n_rows = rows.count()
    full = attach(rows.filter("n > 0"), answers, "key", "size", n_rows, any_hot(answers, "size", n_rows))
    full = full.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"), "pick")
    return full.unionByName(rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "pick")), [scanned, answers]


def one_of_each(docs: DataFrame) -> DataFrame:
    """docs with one document of each group of near duplicates, the one with the smallest identifier; rows of the group that share it all stay, and so do rows without an identifier."""
    near, read = _near(docs)
    gone = stage(near.filter("component_id <> doc_id").select(F.col("pick").alias("_gone")).distinct(), "gone")
    unstage(*read)
    return without(docs, gone)


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' '))) END AS s FROM w),
reps AS (SELECT min(doc_id) AS rep, list_sort(s) AS k, any_value(s) AS s FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)),
els AS (SELECT rep, len(s) AS n, unnest(s) AS e FROM reps),
pairs AS (SELECT a.rep AS x, b.rep AS y FROM els a JOIN els b ON a.e = b.e AND a.rep < b.rep GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
links AS (SELECT x, y FROM pairs UNION SELECT y, x FROM pairs),
reach(v, r) AS (SELECT rep, rep FROM reps UNION SELECT l.y, r.r FROM reach r JOIN links l ON l.x = r.v WHERE r.r < l.y),
comp AS (SELECT v, min(r) AS c FROM reach GROUP BY v)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(c.c, s.doc_id) AS component_id
FROM sets s LEFT JOIN reps p ON len(s.s) > 0 AND list_sort(s.s) = p.k LEFT JOIN comp c ON c.v = p.rep
"""
