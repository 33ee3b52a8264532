"""Work that stays balanced: few large input pieces, one key with a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TASK_BYTES = 32 << 20
HOT_SHARE = 1000  # a key is hot when it holds at least 1/1000 of the rows


def plan_bytes(df: DataFrame) -> int:
    """Size the planner expects; exact up to compression for a stored table."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    """Is the expected size below the session's broadcast threshold?"""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return plan_bytes(df) <= limit


def balanced(df: DataFrame, key: str) -> DataFrame:
    """A small input over all cores; one of more than TASK_BYTES a core stays as it is.

    A small table is often a single row group, which one task would read and
    work on alone. Large ones have pieces enough and are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if plan_bytes(df) > cores * TASK_BYTES else df.repartition(cores, key)


def hot_keys(df: DataFrame, keys: Sequence[str], share: int = HOT_SHARE) -> DataFrame:
    """Keys holding at least 1/share of the rows: never more than `share` of them."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()  # reuses the shuffle of the counts
    return counts.filter(F.col("_n") * share >= total).select(*keys)


def join_unique(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str] | str,
    how: str = "left",
    salts: int = 32,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join on keys that are unique in `right`, whatever their spread in `left`.

    A `right` below the broadcast threshold is broadcast. Beyond it, rows of a
    hot key get one of `salts` salts and the matching right rows are repeated
    once per salt, so a hot key is spread over many tasks. The set of hot keys
    found here has at most HOT_SHARE rows, hence the broadcast; a set passed as
    `hot` must be as small, and no key of it is left out. Null keys do not match, as
    in a plain join. Finding the hot keys reads `left` once more; where `left`
    is itself a long chain, pass those of its source as `hot`.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if how in ("left", "inner", "left_anti", "left_semi") and fits_broadcast(right):
        return left.join(F.broadcast(right), keys, how)
    found = hot_keys(left, keys) if hot is None else hot.select(*keys).distinct()
    hot = F.broadcast(found.withColumn("_hot", F.lit(True)))
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(salts)).cast("int")
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    salted_left = (
        left.join(hot, keys, "left")
        .withColumn("_salt", F.when(F.col("_hot") | null_key, spread).otherwise(F.lit(0)))
        .drop("_hot")
    )
    salted_right = (
        right.join(hot, keys, "left")
        .withColumn(
            "_salt",
            F.explode(
                F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
            ),
        )
        .drop("_hot")
    )
    return salted_left.join(salted_right, [*keys, "_salt"], how).drop("_salt")
