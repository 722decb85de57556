"""Peak concurrency by a segmented scan: a tree's up-sweep and down-sweep over blocks of ordered moments.

Changes of one key and moment are added up before anything is ordered. The moments, dealt by range of (key, moment), are cut
into blocks of BLOCK rows, and each block is scanned by itself. What a block tells the others is a fixed number of values: its
first and last key, the sums and the highest prefix of its first and of its last key's stretch. Two such summaries combine
into one, and a key that differs between the left one's end and the right one's start is a reset. The up-sweep combines FAN
summaries at a time until one is left; the down-sweep hands each node what stands before it (the open stretch's sums and
highest prefix) and what stands behind it (the next moment, and the highest prefix still to come). A row's result follows
from its block's scan and those two carries, so no key, however many rows it has, is ever in one task.

Defined results: an interval without a start, or that does not end after it, takes no part, one without an end stays open;
an amount that is null or not finite counts nothing; a moment whose changes cancel out gives no row; repeated rows count as
often as they come; of rows that repeat a client the smallest nation counts; other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from leafcut.llm.common import attach, stage, unstage

#: Rows of a block, and children of a node (a power of two).
BLOCK, FAN_BITS = 4096, 6
WEEK, EVERYONE, UNKNOWN = 7 * 86400, -2, -1

_ROW = "block long, key int, from_s long, next_s long, n long, cents long, high long, top long, lead boolean, tail boolean"
#: Of a run of moments: its ends, then the sums and the highest prefix of its first and of its last key's stretch.
_SUM = "first_key int, last_key int, first_s long, head_n long, head_c long, head_m long, tail_n long, tail_c long, tail_m long"
#: What stands before a node (key, sums, highest so far) and behind it (key, next moment, highest prefix from there), and the sum at its end.
_CARRY = "p_key int, p_n long, p_c long, p_m long, q_key int, q_s long, q_m long, end_n long"
_SUM_NAMES, _CARRY_NAMES = ([x.split()[0] for x in s.split(", ")] for s in (_SUM, _CARRY))


def minutes(c: Column, kind) -> Column:
    """Seconds since 1970, rounded down to the minute, of a time without a zone (taken as UTC), an instant or a date."""
    if isinstance(kind, TimestampType):
        s = F.unix_seconds(c)
        return s - F.pmod(s, F.lit(60))
    if isinstance(kind, TimestampNTZType):
        return F.unix_date(c.cast("date")).cast("long") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60
    return F.unix_date(c.cast("date")).cast("long") * 86400


def _concat(a: tuple, b: tuple) -> tuple:
    """Sums and highest prefix of a stretch that b continues."""
    return a[0] + b[0], a[1] + b[1], max(a[2], a[0] + b[2])


def combine(a: tuple, b: tuple) -> tuple:
    """The summary of a run that b follows, as _SUM; associative."""
    head, tail = a[3:6], b[6:9]
    if a[1] == b[0]:
        if a[0] == a[1]:
            head = _concat(a[3:6], b[3:6])
        if b[0] == b[1]:
            tail = _concat(a[6:9], b[6:9])
    return (a[0], b[1], a[2], *head, *tail)


def _after(p: tuple, s: tuple) -> tuple:
    """The carry (key, n, c, highest) behind a run that starts with the carry p before it."""
    if s[0] == s[1] and p[0] == s[0]:
        return (s[1], p[1] + s[6], p[2] + s[7], max(p[3], p[1] + s[8]))
    return (s[1], *s[6:9])


def _before(s: tuple, q: tuple) -> tuple:
    """The carry (key, moment, highest prefix) before a run that has the carry q behind it."""
    if s[0] == s[1] and q[0] == s[0]:
        return (s[0], s[2], max(s[5], s[3] + q[2]))
    return (s[0], s[2], s[5])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of BLOCK rows of a sorted partition, each with its own scan; the first row of a block carries its summary."""
    part, made, held = TaskContext.get().partitionId(), 0, None
    for b in batches:
        now = pa.Table.from_batches([b])
        held = now if held is None else pa.concat_tables([held, now])
        while held.num_rows >= BLOCK:
            yield _block(held.slice(0, BLOCK), part, made)
            held, made = held.slice(BLOCK), made + 1
    if held is not None and held.num_rows:
        yield _block(held, part, made)


def _block(t: pa.Table, part: int, made: int) -> pa.RecordBatch:
    key, at, dn, dc = (t.column(i).to_numpy() for i in range(4))
    size = len(key)
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    seg = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, size]))
    n, c = np.cumsum(dn), np.cumsum(dc)
    n, c = n - np.r_[0, n][starts][seg], c - np.r_[0, c][starts][seg]
    high, top = np.empty(size, np.int64), np.empty(size, np.int64)
    for i, j in zip(starts, np.r_[starts[1:], size], strict=True):
        high[i:j] = np.maximum.accumulate(n[i:j])
        top[i:j] = high[j - 1]
    following = np.r_[at[1:], 0]
    no_next = np.r_[key[1:] != key[:-1], True]
    first_end, last = (starts[1] if len(starts) > 1 else size) - 1, size - 1
    summary = (key[0], key[-1], at[0], n[first_end], c[first_end], high[first_end], n[last], c[last], high[last])
    kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 7]
    once = [pa.array([int(v), *[None] * (size - 1)], k) for v, k in zip(summary, kinds, strict=True)]
    values = [
        pa.array(np.full(size, part << 32 | made)), pa.array(key, pa.int32()), pa.array(at), pa.array(following, mask=no_next), pa.array(n), pa.array(c), pa.array(high), pa.array(top),
        pa.array(seg == 0), pa.array(seg == len(starts) - 1),
    ]
    return pa.RecordBatch.from_arrays([*values, *once], [*(x.split()[0] for x in _ROW.split(", ")), *_SUM_NAMES])


def _up(group: pd.DataFrame) -> pd.DataFrame:
    total = None
    for s in group.sort_values("node")[_SUM_NAMES].itertuples(index=False, name=None):
        total = s if total is None else combine(total, s)
    return pd.DataFrame([(group["parent"].iat[0], *total)], columns=["node", *_SUM_NAMES])


def _down(children: pd.DataFrame, parent: pd.DataFrame) -> pd.DataFrame:
    if not len(children):
        return pd.DataFrame([], columns=["node", *_CARRY_NAMES])
    children = children.sort_values("node")
    # A carry without a key is none: no summary has that key.
    given = [None if pd.isna(x) else int(x) for x in parent[_CARRY_NAMES].iloc[0]]
    p, q = tuple(given[:4]), tuple(given[4:7])
    sums = list(children[_SUM_NAMES].itertuples(index=False, name=None))
    behind = []
    for s in reversed(sums):
        behind.append(q)
        q = _before(s, q)
    out = []
    for node, s, q in zip(children["node"], sums, reversed(behind), strict=True):
        after = _after(p, s)
        out.append((node, *p, *q, after[1]))
        p = after
    whole = pd.DataFrame(out, columns=["node", *_CARRY_NAMES])
    return whole.astype({c: "Int64" for c in _CARRY_NAMES})


def scan(changes: DataFrame, block_bits: int | None = None) -> DataFrame:
    """Per row of changes (key int, from_s long, dn long, dc long; one row a key and moment): key, from_s, to_s (the key's next moment), n and cents (running sums), high (largest n so far) and peak (n is the key's largest). block_bits: for tests, bits of a node that its level takes."""
    bits = block_bits or FAN_BITS
    ordered = changes.select("key", "from_s", "dn", "dc").repartitionByRange("key", "from_s").sortWithinPartitions("key", "from_s")
    rows = stage(ordered.mapInArrow(_scan, f"{_ROW}, {_SUM}"), "moments")
    leaves = stage(rows.filter("first_key IS NOT NULL").select("block", *_SUM_NAMES), "blocks")
    # Blocks are numbered by partition and place; places get as many bits as the longest partition needs.
    part, place = leaves.agg(F.max(F.shiftright("block", 32)), F.max(F.col("block").bitwiseAND(F.lit((1 << 32) - 1)))).first()
    low = int(place or 0).bit_length()
    node = F.shiftleft(F.shiftright("block", 32), low).bitwiseOR(F.col("block").bitwiseAND(F.lit((1 << 32) - 1)))
    levels = [leaves.select(node.alias("node"), *_SUM_NAMES)]
    for _ in range(-(-(int(part or 0).bit_length() + low) // bits)):
        up = levels[-1].withColumn("parent", F.shiftright("node", bits)).groupBy("parent").applyInPandas(_up, f"node long, {_SUM}")
        levels.append(stage(up, "summaries"))
    carry = levels[-1].select("node", *(F.lit(None).cast(x.split()[1]).alias(x.split()[0]) for x in _CARRY.split(", ")))
    spent = levels[1:]
    for level in reversed(levels[:-1]):
        children = level.withColumn("parent", F.shiftright("node", bits))
        new = stage(children.groupBy("parent").cogroup(carry.groupBy("node")).applyInPandas(_down, f"node long, {_CARRY}"), "carries")
        unstage(carry)
        carry = new
    unstage(*spent)
    c = F.col
    # The summaries of blocks grow with the rows, so they are never broadcast.
    both = rows.drop(*_SUM_NAMES).withColumn("node", node).join(carry.hint("shuffle_hash"), "node")
    open_, more = c("lead") & c("key").eqNullSafe(c("p_key")), c("tail") & c("key").eqNullSafe(c("q_key"))
    n, cents = (c(x) + F.when(open_, c(y)).otherwise(0) for x, y in (("n", "p_n"), ("cents", "p_c")))
    high, top = (F.when(open_, F.greatest("p_m", c("p_n") + c(x))).otherwise(c(x)) for x in ("high", "top"))
    # `top` is the highest of the row's stretch within the block; the last stretch goes on behind it from the sum at its end.
    top = F.when(more, F.greatest(top, c("end_n") + c("q_m"))).otherwise(top)
    following = F.coalesce("next_s", F.when(more, c("q_s")))
    return both.select("key", "from_s", following.alias("to_s"), n.alias("n"), cents.alias("cents"), high.alias("high"), (n == top).alias("peak"))


def intervals(sales: DataFrame, lines: DataFrame, clients: DataFrame) -> DataFrame:
    """(key, start, end, cents) of each sale that takes part; the key is its client's nation. Lines are summed up before they meet a sale; a client with many sales is broadcast by itself."""
    kinds = {f.name: f.dataType for f in [*sales.schema, *lines.schema]}
    shipped = lines.filter("shipped_at IS NOT NULL").groupBy("sale_id").agg(F.max("shipped_at").alias("last"))
    amount = F.when(~F.isnan("total") & (F.abs("total") < float("inf")), F.floor(100 * F.col("total").cast("double") + 0.5)).otherwise(0)
    own = sales.select("sale_id", "client_id", minutes(F.col("sold_at"), kinds["sold_at"]).alias("start"), F.coalesce(amount, F.lit(0)).cast("long").alias("cents")).filter("start IS NOT NULL")
    ended = own.join(shipped, "sale_id", "left").select("client_id", "start", (minutes(F.col("last"), kinds["shipped_at"]) + WEEK).alias("end"), "cents").filter("end IS NULL OR end > start")
    nation = clients.filter("client_id IS NOT NULL").groupBy("client_id").agg(F.min("nation_id").cast("int").alias("key"))
    staged = stage(ended, "open")
    named = staged.filter("client_id IS NOT NULL")
    sizes = named.groupBy("client_id").agg(F.count("*").alias("k")).join(nation, "client_id", "left")
    known = attach(named, sizes, "client_id", "k", staged.count()).select(F.coalesce("key", F.lit(UNKNOWN)).alias("key"), "start", "end", "cents")
    return known.union(staged.filter("client_id IS NULL").select(F.lit(UNKNOWN), "start", "end", "cents"))


def changes(spans: DataFrame) -> DataFrame:
    """Changes by key and moment, and again of all keys together under EVERYONE; those that cancel out are left out."""
    ends = F.explode(F.array(F.struct(F.col("start").alias("from_s"), F.lit(1).cast("long").alias("dn"), F.col("cents").alias("dc")), F.struct(F.col("end").alias("from_s"), F.lit(-1).cast("long").alias("dn"), (-F.col("cents")).alias("dc"))))
    own = spans.select("key", ends.alias("e")).select("key", "e.*").filter("from_s IS NOT NULL").groupBy("key", "from_s").agg(F.sum("dn").alias("dn"), F.sum("dc").alias("dc"))
    own = stage(own, "changes")
    return own.unionByName(own.groupBy("from_s").agg(F.sum("dn").alias("dn"), F.sum("dc").alias("dc")).withColumn("key", F.lit(EVERYONE))).filter("dn <> 0 OR dc <> 0")


def open_sales(sales: DataFrame, lines: DataFrame, clients: DataFrame) -> DataFrame:
    """Open sales of each nation, and of all (-2), from moment to moment: nation_id, from_s, to_s, n_open, open_cents, high_open, is_peak."""
    out = scan(changes(intervals(sales, lines, clients)))
    return out.select(F.col("key").alias("nation_id"), "from_s", "to_s", F.col("n").alias("n_open"), F.col("cents").alias("open_cents"), F.col("high").alias("high_open"), F.col("peak").alias("is_peak"))


SQL = r"""
WITH ended AS (SELECT sale_id, max(shipped_at) AS last FROM sale_lines WHERE shipped_at IS NOT NULL GROUP BY sale_id),
s AS (SELECT coalesce(c.nation_id, -1) AS nation_id, epoch(date_trunc('minute', sold_at))::BIGINT AS a, epoch(date_trunc('minute', last))::BIGINT + 604800 AS b,
        CASE WHEN isfinite(total) THEN floor(100 * total + 0.5)::BIGINT ELSE 0 END AS cents
      FROM sales LEFT JOIN ended USING (sale_id) LEFT JOIN clients c USING (client_id) WHERE sold_at IS NOT NULL),
k AS (SELECT * FROM s WHERE b IS NULL OR b > a), e AS (SELECT nation_id, a AS t, 1 AS dn, cents AS dc FROM k UNION ALL SELECT nation_id, b, -1, -cents FROM k WHERE b IS NOT NULL),
d AS (SELECT nation_id, t, sum(dn)::BIGINT AS dn, sum(dc)::BIGINT AS dc FROM (SELECT * FROM e UNION ALL SELECT -2, t, dn, dc FROM e) GROUP BY ALL HAVING sum(dn) <> 0 OR sum(dc) <> 0),
r AS (SELECT nation_id, t, lead(t) OVER w AS to_s, (sum(dn) OVER w)::BIGINT AS n_open, (sum(dc) OVER w)::BIGINT AS open_cents FROM d WINDOW w AS (PARTITION BY nation_id ORDER BY t))
SELECT nation_id::INTEGER AS nation_id, t AS from_s, to_s, n_open, open_cents, max(n_open) OVER (PARTITION BY nation_id ORDER BY t) AS high_open, n_open = max(n_open) OVER (PARTITION BY nation_id) AS is_peak FROM r
"""
