"""Helpers shared by the operators: tables, shared folders, ordered buckets and running totals."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LAST_KEY = 2**63 - 1
#: A key is heavy if more than one row in HEAVY has it: so there are fewer than HEAVY heavy keys in any table.
HEAVY = 1000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the one that driver and executors share (spark.checkpoint.dir).

    Without that setting a temporary folder serves, but only with a local master, where all tasks see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='editloom-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of df, written once as Parquet to the shared folder and read back: later plans start there."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *stems: str) -> list[str]:
    """The stems, each with as many underscores in front as it takes to differ from all columns of df, whatever their case."""
    taken = {c.lower() for c in df.columns}
    return [next(name for i in range(len(taken) + 1) if (name := "_" * i + stem).lower() not in taken) for stem in stems]


def bucket_count(spark: SparkSession, per_partition: int = 4) -> int:
    return max(16, per_partition * int(spark.conf.get("spark.sql.shuffle.partitions")))


def order_key(key: Column) -> Column:
    """Null keys come last."""
    return F.coalesce(key.cast("long"), F.lit(LAST_KEY))


def constant_array(values: list, kind: str) -> Column:
    """A constant array<kind>: one literal, however many values."""
    if not values:
        return F.array().cast(f"array<{kind}>")
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def count_at_most(values: list, x: Column, kind: str = "bigint") -> Column:
    """How many of the ascending values are at most x, by binary search."""
    array = constant_array(values, kind)
    steps = F.lit([1 << i for i in reversed(range(len(values).bit_length()))]) if values else F.array().cast("array<int>")
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.get(array, n + step - 1) <= x, n + step).otherwise(n))


def hashed_text(text: str) -> Column:
    """Orders rows of the same key: 0 to 2**62 - 1."""
    return F.shiftrightunsigned(F.xxhash64(text), 2)


def range_cuts(df: DataFrame, key: Column, buckets: int) -> list[int]:
    """Keys that cut rows into about `buckets` ranges of near equal row counts; null keys come last. A key of many rows is a cut several times."""
    shares = [i / buckets for i in range(1, buckets)]
    return sorted(df.select(order_key(key).alias("k")).agg(F.percentile_approx("k", shares, max(10_000, 20 * buckets))).first()[0] or []) if shares else []


def range_number(key: Column, tie: Column, cuts: list[int]) -> Column:
    """Number of the range, 0 to len(cuts), that rows are in by (key, tie); ranges are in ascending order.

    Rows of a key that is a cut m times are spread over m + 1 ranges by their tie (0 to 2**62 - 1).
    """
    place = order_key(key)
    upto, below = count_at_most(cuts, place), count_at_most(cuts, F.when(place > -LAST_KEY, place - 1).otherwise(place))
    part = F.shiftright(tie, 31) * (upto - below + F.lit(1))
    return (below + F.shiftright(part, 31)).cast("int")


def with_running_total(df: DataFrame, within: list[str], bucket: str, order: list, amount: str, start: str) -> DataFrame:
    """Adds `start`: the sum of `amount` over all earlier rows of the same `within` keys, ordered by bucket, then `order`.

    Rows are only sorted within (within, bucket); the totals of whole buckets are one small row each. No task sees
    all rows of a hot key.
    """
    keys = [*within, bucket]
    totals = df.groupBy(*keys).agg(F.sum(amount).alias("_total"))
    before = Window.partitionBy(*within).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    if not within:
        before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                           F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    # One row for each key and bucket, bounded by len(keys) * buckets: small beside df, and checked by the planner's own size estimate.
    joined = df.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0))).join(totals, same, "left")
    drop = ["_inside", "_before", *[f"_k{i}" for i in range(len(keys))]]
    return joined.withColumn(start, (F.col("_inside") + F.col("_before")).cast("long")).drop(*drop)


def join_counted(rows: DataFrame, values: DataFrame, key: str, count: str) -> DataFrame:
    """rows.join(values, key), without the column `count`: the number of a key's rows. values has one row for each key.

    Rows of heavy keys stay where they are and meet the few broadcast values; only the others are shuffled, so no task
    gets the rows of a hot key. Both tables are read twice and should be written ones. Keys are not null.
    """
    most = rows.count() // HEAVY
    heavy = F.broadcast(values.where(F.col(count) > most).drop(count))  # fewer than HEAVY rows
    light = values.where(F.col(count) <= most).drop(count)
    return rows.join(heavy, key).unionByName(rows.join(heavy, key, "left_anti").join(light, key))


def block_runs(rows: DataFrame, by: list[str], member: str, block: int, purpose: str) -> DataFrame:
    """Rows that are to be compared with each other: column `run`, then those of rows but `by`; a run's rows follow each other.

    Rows of one group (`by`) are one run, unless they are more than `block`: then a hash of `member` puts them into
    blocks, and each pair of blocks is a run. No task sees a whole large group. Large groups are few, at most one for
    each `block` rows; they go to a written table that the planner broadcasts only if it is small.
    """
    large = written(rows.groupBy(*by).agg(F.count("*").alias("_size")).where(F.col("_size") > block)
                    .select(*by, F.ceil(F.col("_size") / block).cast("int").alias("_blocks")), purpose)
    kept = [c for c in rows.columns if c not in by]
    rows = rows.join(large, by, "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
    rows = rows.withColumn("_own", F.pmod(F.xxhash64(member), "_blocks").cast("int"))
    rows = rows.select(*by, *kept, "_own", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other"))
    rows = rows.withColumn("_low", F.least("_own", "_other")).withColumn("_high", F.greatest("_own", "_other"))
    keys = [*by, "_low", "_high"]
    return rows.repartition(*keys).sortWithinPartitions(*keys).select(F.xxhash64(*keys).alias("run"), *kept)


def run_batches(batches: Iterator) -> Iterator:
    """Arrow batches of `run` and other columns, cut anew so that every run is whole in one batch."""
    import numpy as np
    import pyarrow as pa

    rest = None
    for batch in batches:
        table = pa.Table.from_batches([*rest, batch] if rest else [batch])
        run = table.column(0).to_numpy()
        cut = int(np.flatnonzero(np.r_[True, run[1:] != run[:-1]])[-1]) if len(run) else 0
        if cut:
            yield table.slice(0, cut).combine_chunks()
        rest = table.slice(cut).to_batches()
    if rest:
        yield pa.Table.from_batches(rest).combine_chunks()
