"""Spreading hot join keys over many tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# The sketch of frequent keys can't look for smaller shares than this.
_LEAST_SHARE = 1e-4


def heavy_keys(df: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """``(_heavy, _salts)``: every key that fills more than one of ``parts`` shuffle partitions by itself, and how many.

    A mergeable sketch of fixed size names at most ``parts`` candidates, from one scan of the key
    column; a second scan counts them, each task for itself first. With more than 10,000 partitions, keys of less
    than a ten-thousandth of the rows aren't looked for. The result is small, and fetched up front
    because both sides of a join must see the same one. Null is no key.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = df.schema[key].dataType
    schema = f"_heavy {kind.simpleString()}, _salts int"
    keys = df.select(F.col(key).alias("_heavy")).filter(F.col("_heavy").isNotNull())
    found = keys.freqItems(["_heavy"], max(1 / parts, _LEAST_SHARE)).first()[0]
    if not found:
        return spark.createDataFrame([], schema)
    candidates = spark.createDataFrame([(k, True) for k in found], f"_heavy {kind.simpleString()}, _known boolean")
    counted = keys.join(F.broadcast(candidates), "_heavy", "left").groupBy(F.when(F.col("_known"), F.col("_heavy")).alias("_heavy")).count().collect()
    fair = max(sum(r["count"] for r in counted) / parts, 1)
    hot = [(r["_heavy"], int(-(-r["count"] // fair))) for r in counted if r["_heavy"] is not None and r["count"] > fair]
    return spark.createDataFrame(hot, schema)


def salt_keys(
    many: DataFrame, one: DataFrame, key: str, spread_by: str, parts: int | None = None, name: str = "_salt"
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt column to join on next to ``key``.

    Rows of ``many`` under a heavy key get one of its salts by the hash of ``spread_by``, so that each
    salt has about the rows of a shuffle partition; rows of ``one`` under it are repeated once per
    salt. All other rows get salt 0 and are not repeated, so each pair still meets exactly
    once. The heavy keys are broadcast: no more than there are partitions.
    """
    heavy = F.broadcast(heavy_keys(many, key, parts))
    spread = F.pmod(F.xxhash64(spread_by), F.col("_salts")).cast("int")
    every = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)

    def salted(df: DataFrame, salt) -> DataFrame:
        return df.join(heavy, F.col(key) == F.col("_heavy"), "left").withColumn(name, salt).drop("_heavy", "_salts")

    return salted(many, F.coalesce(spread, F.lit(0))), salted(one, F.explode(every))
