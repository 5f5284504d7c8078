"""Explanation look-ups: each prediction can be explained once."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from addrwatch import config
from addrwatch.functions.dates import micros
from addrwatch.operators.prefix import running_totals
from addrwatch.operators.skew import salt_keys


def explain_lookup(lookups: DataFrame, predictions: DataFrame) -> DataFrame:
    """Add ``hit`` to every look-up.

    The first look-up at or after a prediction takes it; earlier and later ones
    miss. ``lookup_id`` is unique and orders equal times; ``request_id`` is unique
    in the predictions.

    The first look-up per request is a minimum, so the heavy look-ups of one
    request are combined where they are read, never gathered. Only the ids of the
    winners go back to the look-ups. Look-ups without an id are misses and aren't shuffled.
    """
    named = lookups.filter(F.col("request_id").isNotNull())
    asked, given = salt_keys(
        named.select("lookup_id", "ts", "request_id"),
        predictions.select("request_id", F.col("ts").alias("_made")),
        "request_id", "lookup_id",
    )
    after = asked.join(given, ["request_id", "_salt"]).filter(F.col("_made") <= F.col("ts"))
    winners = after.groupBy("request_id").agg(F.min(F.struct("ts", "lookup_id")).alias("_first")).select(
        F.col("_first.lookup_id").alias("lookup_id"), F.lit(True).alias("_won")
    )
    served = named.join(winners, "lookup_id", "left").withColumn("hit", F.coalesce("_won", F.lit(False))).drop("_won")
    return served.unionByName(lookups.filter(F.col("request_id").isNull()).withColumn("hit", F.lit(False)))


def lookup_misses(lookups: DataFrame, predictions: DataFrame) -> DataFrame:
    """Look-ups of ids that were never predicted, those without an id among them, which aren't shuffled."""
    named = lookups.filter(F.col("request_id").isNotNull())
    asked, given = salt_keys(named, predictions.select("request_id"), "request_id", "lookup_id")
    missed = asked.join(given, ["request_id", "_salt"], "left_anti").drop("_salt")
    return missed.unionByName(lookups.filter(F.col("request_id").isNull()))


def lookup_hit_rate(marked: DataFrame) -> DataFrame:
    """``(hits, misses, hit_rate)`` in percent."""
    counts = marked.agg(
        F.count_if("hit").alias("hits"), F.count_if(~F.col("hit")).alias("misses")
    )
    rate = F.try_divide(F.col("hits") * 100.0, F.col("hits") + F.col("misses"))
    return counts.select("hits", "misses", rate.alias("hit_rate"))


def running_hit_rate(marked: DataFrame, rows_per_range: int = config.RANGE_ROWS) -> DataFrame:
    """Add ``hits``, ``seen`` and ``hit_rate`` as they stand after each look-up."""
    running = running_totals(
        marked, micros(F.col("ts")),
        {"hits": F.col("hit").cast("bigint"), "seen": F.lit(1).cast("bigint")},
        tie=F.col("lookup_id"), rows_per_range=rows_per_range,
    )
    return running.withColumn("hit_rate", F.col("hits") * 100.0 / F.col("seen"))
