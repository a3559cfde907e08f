"""A join that a hot key doesn't hold up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoforge.llm.common import partitions


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int | None = None) -> DataFrame:
    """rows joined with groups (one for each combination of keys that rows have; size: how many rows it has).

    Groups of more than 1 / (2 * partitions) of all rows are at most 2 * partitions in number, whatever the
    input; these are broadcast, and their rows, which need no partner any more, are dealt out by a hash of
    themselves in the shuffle of the others. So no task gets a hot group. groups is read twice, or three times where the
    total of the sizes isn't given: write it first.
    """
    spark = rows.sparkSession
    if total is None:
        total = groups.agg(F.sum(size)).first()[0] or 0
    least = max(1, total // (2 * partitions(spark)))
    values = [c for c in groups.columns if c not in keys]
    hot = groups.where(F.col(size) > least).select(*keys, F.struct(*values).alias("__hot"))
    cold = groups.where(F.col(size) <= least).select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), F.struct(*values).alias("__cold"))
    own = rows.join(F.broadcast(hot), keys, "left")
    is_hot = F.col("__hot").isNotNull()
    # a hot row's key is replaced by one that no group has
    spread = F.when(is_hot, -F.abs(F.xxhash64(*rows.columns) % 1_000_003) - 1).otherwise(F.lit(0).cast("long"))
    own = own.withColumn("__spread", spread)
    # always 0, but no constant to the optimiser: a constant would make it a filter, and the shuffle go by the keys alone
    cold = cold.withColumn("__none", F.pmod(F.xxhash64(*(f"__k{i}" for i in range(len(keys)))), F.lit(1).cast("long")))
    on = [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(keys)] + [F.col("__spread") == F.col("__none")]
    joined = own.join(cold, on, "left")
    found = F.coalesce("__hot", "__cold")
    return joined.where(is_hot | F.col("__cold").isNotNull()).select(*rows.columns, *(found[v].alias(v) for v in values))
