"""Activity, predictions, look-ups, logs, runs and requests, as views over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from addrwatch import config, schemas
from addrwatch.operators import prep
from addrwatch.plans.prepare import label_activity


SCHEMAS = {"orders": schemas.ORDERS, "lineitem": schemas.LINEITEM, "events": schemas.EVENTS}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table in its known schema, which saves a job that would look it up."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw activity: one row per order. Lines are summed per order before the join."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count("l_linenumber").alias("length"),
        F.sum("l_discount").alias("weight"),
        F.sum("l_quantity").alias("count"),
        F.count_if(F.col("l_returnflag") == "R").alias("looped"),
        F.count_distinct("l_suppkey").alias("neighbors"),
    )
    orders = table(spark, sf_dir, "orders")
    joined = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left")

    def or_zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0).cast("bigint")).alias(name)

    finished = F.col("o_orderstatus") == "F"
    return joined.select(
        F.col("o_orderkey").cast("string").alias("address"),
        F.year("o_orderdate").alias("year"),
        F.dayofyear("o_orderdate").alias("day"),
        or_zero("length"),
        F.round(F.coalesce("weight", F.lit(0.0)), 4).alias("weight"),
        F.coalesce("count", F.lit(0.0)).cast("bigint").alias("count"),
        or_zero("looped"),
        or_zero("neighbors"),
        F.col("o_totalprice").alias("income"),
        F.when((F.col("o_orderpriority") == "1-URGENT") & finished, "familyA")
        .when((F.col("o_orderpriority") == "2-HIGH") & finished & (F.col("o_orderkey") % 4 == 0), "familyB")
        .otherwise("white").alias("label"),
    )


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.with_partition_date(tx(spark, sf_dir))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw features and target with the sampling key, for all dates."""
    rows = prep.with_target(activity(spark, sf_dir))
    return rows.select(*prep.SAMPLE_KEY, *config.RAW_FEATURES, config.TARGET)


def preprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_activity(activity(spark, sf_dir))


def _confidence() -> Column:
    return F.round(1 - F.exp(-F.col("value") / 50), 4)


def predictions_of(events: DataFrame) -> DataFrame:
    """Predictions: every event but the views. Works on a stream of events as well."""
    chance = F.floor(10 * (1 - F.exp(-F.col("value") / 50)))
    return events.filter(F.col("event_type") != "view").select(
        F.col("event_id").alias("request_id"), "ts",
        _confidence().alias("confidence"),
        (_confidence() >= 0.5).cast("int").alias("prediction"),
        ((F.col("event_id") * 7 + F.col("user_id")) % 10 < chance).cast("int").alias("y"),
    )


def pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions_of(table(spark, sf_dir, "events"))


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pred(spark, sf_dir).select(
        "request_id", "ts", (F.col("prediction") == 1).alias(config.TARGET), "confidence"
    )


def lookups_of(events: DataFrame) -> DataFrame:
    """Explanation requests: the view events, each asking for a recent id."""
    back = F.get_json_object("props", "$.k").cast("bigint") % 5
    return events.filter(F.col("event_type") == "view").select(
        F.col("event_id").alias("lookup_id"), "ts", (F.col("event_id") - back).alias("request_id")
    )


def lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups_of(table(spark, sf_dir, "events"))


def _instance() -> Column:
    return F.concat(F.lit("i"), (F.col("user_id") % 3).cast("string")).alias("instance")


def http_log_of(events: DataFrame) -> DataFrame:
    """A request log in which the error events failed."""
    return events.select(
        "event_id", "ts", F.lit("api").alias("job"), _instance(),
        F.when(F.col("event_type") == "error", "500").otherwise("200").alias("status"),
    )


def http_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return http_log_of(table(spark, sf_dir, "events"))


def gauges_of(events: DataFrame, factor: float) -> DataFrame:
    """A gauge sampled once per event and instance."""
    return events.select("event_id", "ts", _instance(), (F.col("value") * factor).alias("value"))


def gauges(spark: SparkSession, sf_dir: str, factor: float) -> DataFrame:
    return gauges_of(table(spark, sf_dir, "events"), factor)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests: activity with some negative values and some missing fields."""
    key = F.col("address").cast("bigint")
    day = F.date_add(F.make_date("year", F.lit(1), F.lit(1)), F.col("day") - 1).cast("timestamp_ntz")
    return tx(spark, sf_dir).select(
        F.col("address").alias("request_id"),
        F.timestamp_add("SECOND", key * 7919 % 86400, day).alias("ts"),
        F.when(key % 10 != 0, F.col("length").cast("double")).alias("length"),
        F.when(key % 7 == 0, -F.col("weight")).otherwise(F.col("weight")).alias("weight"),
        F.col("count").cast("double").alias("count"),
        F.col("looped").cast("double").alias("looped"),
        F.when(key % 15 != 0, F.col("neighbors").cast("double")).alias("neighbors"),
        (F.col("income") - 100000.0).alias("income"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run registry with one run per order."""
    key, state = F.col("o_orderkey"), F.col("o_orderstatus")
    suffix = F.element_at(F.array(*[F.lit(s) for s in config.STAGE_SUFFIXES]), (key % 3 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("run_"), key.cast("string")).alias("run_id"),
        F.concat(F.lit("addrwatch_"), suffix).alias("run_name"),
        F.when(state == "F", "FINISHED").when(state == "O", "RUNNING").otherwise("FAILED").alias("status"),
        F.col("o_orderdate").alias("start_ts"),
        F.create_map(F.lit("fn"), F.floor(F.col("o_totalprice") / 1000).cast("double")).alias("metrics"),
    )
