"""Dimension lookups that stay balanced when one key value dominates the facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quayside.operators.spread import shuffle_partitions


def left_lookup(facts: DataFrame, dim: DataFrame | list[DataFrame], fact_key: str, dim_key: str, *,
                placeholders: tuple = (), spread_by: list[Column] | None = None) -> DataFrame:
    """facts LEFT JOIN dim ON fact_key = dim_key; `dim` keeps only its other columns.

    Several dimensions on the same key are joined one after the other on one
    shuffle of the facts.

    Nothing is broadcast by hint: Catalyst broadcasts `dim` when its size
    estimate (or its AQE runtime size) is under the threshold, and otherwise
    shuffles, where AQE splits an oversized fact partition.

    Two kinds of hot values are known beforehand: NULL, which never matches,
    and placeholder keys such as -99999. With `spread_by`, those rows get a
    hash salt that spreads them over all shuffle partitions; the dimension rows
    of the placeholders (if there are any) are repeated once per salt, all
    others are left alone.
    """
    dims = dim if isinstance(dim, list) else [dim]
    if not spread_by:
        for d in dims:
            keyed = d.withColumnRenamed(dim_key, "_dim_key")
            facts = facts.join(keyed, F.col(fact_key) == F.col("_dim_key"), "left").drop("_dim_key")
        return facts

    ways = shuffle_partitions(facts)
    key = F.col(fact_key)
    hot = key.isNull() | key.isin(*placeholders) if placeholders else key.isNull()
    salt = F.when(hot, F.pmod(F.xxhash64(*spread_by), F.lit(ways)).cast("int")).otherwise(0)
    joined = facts.withColumn("_salt", salt)
    salts = F.array(F.lit(0))
    if placeholders:
        salts = F.when(F.col("_dim_key").isin(*placeholders), F.sequence(F.lit(0), F.lit(ways - 1))).otherwise(salts)
    for d in dims:
        keyed = d.withColumnRenamed(dim_key, "_dim_key").withColumn("_dim_salt", F.explode(salts))
        on = (F.col(fact_key) == F.col("_dim_key")) & (F.col("_salt") == F.col("_dim_salt"))
        joined = joined.join(keyed, on, "left").drop("_dim_key", "_dim_salt")
    return joined.drop("_salt")
