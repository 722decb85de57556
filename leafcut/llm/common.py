"""What the corpus operators share: shared storage, hot keys, filters over identifiers, components."""

from __future__ import annotations

import gc
import re
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key is hot if it holds this share of all rows or more; there are at most 1 / HOT_SHARE of them, which bounds what is broadcast.
HOT_SHARE = 1 / 500
#: A group is not hot below so many rows, whatever its share.
HOT_LEAST = 256
#: Identifiers that a filter is made for; it has FILTER_RATIO bits for each, so 32 MB at most. More identifiers are joined instead.
FILTER_MOST, FILTER_RATIO = 1 << 24, 12


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where that is unset, as in tests, one of our own."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not sc.getCheckpointDir():
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir("file:///tmp/leafcut-checkpoints")
    return sc.getCheckpointDir().rstrip("/")


def stage(df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """Writes df to the shared folder and reads it again: lineage is cut, and a lost executor costs only the task it ran. The table goes with unstage, or when the application ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/leafcut-{name}-{uuid.uuid4().hex}"
    df.write.options(**(options or {})).parquet(path)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    out = spark.read.schema(df.schema).parquet(path)
    out._leafcut_path = path
    return out


def unstage(*frames: DataFrame) -> None:
    """Deletes staged tables that nothing lazy refers to any more."""
    for df in frames:
        if path := getattr(df, "_leafcut_path", None):
            spark = df.sparkSession
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def delete(spark: SparkSession, path: str, at_exit: bool = False) -> None:
    """Deletes a folder of the shared storage, now or when the application ends."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.deleteOnExit(p) if at_exit else fs.delete(p, True)


def any_hot(groups: DataFrame, size: str, total: int) -> bool:
    """Whether attach() has a key to broadcast; for groups that are staged, as it reads their sizes."""
    return (groups.agg(F.max(size)).first()[0] or 0) >= least_hot(total)


def least_hot(total: int) -> int:
    return max(int(total * HOT_SHARE), HOT_LEAST)


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, hot: bool = True) -> DataFrame:
    """Left join of rows with one row per key. Hot keys, HOT_SHARE of the rows or more and so a fixed number at most, are broadcast; the others are shuffled. hot: False if it is known that there are none, so that rows are made once and nothing is broadcast."""
    if not hot:
        return rows.join(groups, key, "left")
    least = least_hot(total)
    hot = groups.filter(F.col(size) >= least).withColumn("_hot", F.lit(True))
    split = rows.join(F.broadcast(hot), key, "left")
    cold = split.filter(F.col("_hot").isNull()).select(*rows.columns).join(groups.filter(F.col(size) < least), key, "left")
    return split.filter("_hot").drop("_hot").unionByName(cold)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of frames that nothing refers to any more, between the rounds of an iteration."""
    gc.collect()
    spark._jvm.System.gc()


_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the splitmix64 generator, over unsigned 64-bit numbers."""
    x = x + np.uint64(_MIX[0])
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[1])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[2])
    return x ^ (x >> np.uint64(31))


def filter_bits(n: int) -> int:
    """The power of two that gives n identifiers FILTER_RATIO bits each."""
    return min(max(16, (max(1, n) * FILTER_RATIO - 1).bit_length()), (FILTER_MOST * FILTER_RATIO - 1).bit_length())


def id_filter(ids: DataFrame, bits: int | None = None) -> np.ndarray:
    """A Bloom filter with two hashes over a column of longs, made by executors word by word; 2**bits / 64 words reach the driver."""
    c = F.col(ids.columns[0])
    bits = filter_bits(ids.count()) if bits is None else bits
    places = F.explode(F.array(*(_place(c, seed, bits) for seed in (11, 12)))).alias("p")
    words = ids.select(places).groupBy(F.shiftright("p", 6).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("m")).toPandas()
    out = np.zeros(1 << bits - 6, np.uint64)
    out[words["w"].to_numpy(np.int64)] = words["m"].to_numpy(np.int64).view(np.uint64)
    return out


def _place(c: Column, seed: int, bits: int) -> Column:
    """Matches places(): a multiply-shift of the identifier, in 63 bits so that it can't overflow."""
    a, b, m = _ODD[seed]
    low, high = c.bitwiseAND(F.lit((1 << 20) - 1)), F.shiftrightunsigned(c, 20).bitwiseAND(F.lit((1 << 44) - 1))
    mid, top = high.bitwiseAND(F.lit((1 << 20) - 1)), F.shiftrightunsigned(high, 20)
    return F.shiftright((low * a + mid * b + top * m).bitwiseAND(F.lit((1 << 62) - 1)), 40 - bits).bitwiseAND(F.lit((1 << bits) - 1))


_ODD = {11: (0x1F3D5B79A1, 0x16A09E667B, 0x13198A2E03), 12: (0x19B05688C3, 0x1F83D9AB67, 0x15BE0CD19B)}


def places(ids: np.ndarray, seed: int, bits: int) -> np.ndarray:
    a, b, m = (np.uint64(x) for x in _ODD[seed])
    x, low = ids.astype(np.int64).view(np.uint64), np.uint64((1 << 20) - 1)
    s = (x & low) * a + ((x >> np.uint64(20)) & low) * b + (x >> np.uint64(40)) * m
    return ((s & np.uint64((1 << 62) - 1)) >> np.uint64(40 - bits)) & np.uint64((1 << bits) - 1)


def maybe_in(words: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether each identifier may be in the filter; never false for one that is."""
    bits = (len(words) * 64).bit_length() - 1
    out = np.ones(len(ids), bool)
    for seed in (11, 12):
        p = places(ids, seed, bits)
        out &= (words[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) > 0
    return out


def among(rows: DataFrame, column: str, ids: DataFrame, most: int = FILTER_MOST):
    """Rows that may be meant by ids, and a broadcast filter over that column for the function that reads them; for more than `most` ids the rows are joined instead, and there is no filter. ids has one column of longs, the name of `column`."""
    n = ids.count()
    if n > most:
        return rows.join(ids, column, "left_semi"), None
    return rows, rows.sparkSession.sparkContext.broadcast(id_filter(ids, filter_bits(n)))


def passing(shared, ids: np.ndarray) -> np.ndarray:
    """Places of the identifiers that the filter of among() lets through."""
    return np.arange(len(ids)) if shared is None else np.flatnonzero(maybe_in(shared.value, ids))


def components(edges: DataFrame, a: str, b: str, rounds: int = 50) -> DataFrame:
    """Connected components by alternating large and small stars: (node, component), component the smallest node that links reach. Nodes without a link to another node have no row. Each round is written to the shared folder; nothing is collected but three counts, which tell when every node that is left hangs on one centre, and whether any is hot."""
    pair = lambda df, x, y: df.select(F.least(x, y).alias("v"), F.greatest(x, y).alias("u")).filter("u <> v").distinct()
    now = stage(pair(edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull()), F.col(a), F.col(b)), "stars")
    for _ in range(rounds):
        ends = now.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))).alias("e")).select("e.*")
        per = ends.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least"), F.count("*").alias("k"))
        total, astray, most = per.agg(F.coalesce(F.sum("up"), F.lit(0)), F.count_if(F.expr("up > 1 OR up = 1 AND least = 0")), F.max("k")).first()
        if not astray:
            break
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("k"))
        large = attach(both.filter("v > u"), low, "u", "k", 2 * total, hot=most >= least_hot(2 * total)).select(F.col("v").alias("x"), F.col("m").alias("y"))
        large = pair(large, F.col("x"), F.col("y"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.col("v"), F.col("u"))).alias("x"), F.col("m").alias("y"))
        new = stage(pair(small, F.col("x"), F.col("y")), "stars")
        unstage(now)
        now = new
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def held_out(doc_id: Column, of: int, remainder: int) -> Column:
    """Whether the check sum of an identifier's digits puts its document aside; a missing identifier is not put aside."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % of == remainder, F.lit(False))


def keep_rows(docs: DataFrame, column: str, passes) -> DataFrame:
    """docs with the rows for which passes(values) is true, all columns as they were; nothing is shuffled. passes gets a list of values and gives as many booleans."""
    import pyarrow as pa

    schema, at = docs.schema, docs.columns.index(column)

    def run(batches):
        for b in batches:
            # Few texts at a time are made strings.
            for i in range(0, b.num_rows, 64):
                part = b.slice(i, 64)
                yield part.filter(pa.array(passes(part.column(at).to_pylist()), pa.bool_()))

    return docs.mapInArrow(run, schema)


def fresh(*names: str) -> list[str]:
    """Column names that no table of a user's has."""
    return [f"_{x}_{uuid.uuid4().hex}" for x in names]


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs without the rows whose row_id is in gone (one column). A row_id has 64 bits: of ten billion rows some few may go with one that was meant."""
    (name,) = fresh("gone")
    return docs.join(gone.toDF(name), row_id() == F.col(name), "left_anti")


def row_id() -> Column:
    """A hash of a row's identifier and text, which tells rows apart that share an identifier."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("doc_id").isNull(), F.coalesce(F.col("text").cast("string"), F.lit("")))


def bounded(rows: DataFrame, key: Column, group: str, most: int, sizes: dict | None = None) -> DataFrame:
    """Of each group about `most` rows, chosen by a hash of their key; all of them if there are fewer. For fitting models only."""
    sizes = sizes if sizes is not None else {r[0]: r[1] for r in rows.groupBy(group).count().collect()}
    part = F.lit(0.0)
    for g, n in sizes.items():
        part = F.when(F.col(group).eqNullSafe(F.lit(g)), min(1.0, most / n)).otherwise(part)
    return rows.filter(F.pmod(F.xxhash64(key), F.lit(1 << 20)) < part * (1 << 20))
