"""Activity: sources, labels, samples, splits and features."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from addrwatch import config, views
from addrwatch.catalog.registry import places, query, sql_places
from addrwatch.catalog.sql import with_
from addrwatch.functions import dates, labels, numeric
from addrwatch.operators import features, prep, stats
from addrwatch.plans import prepare
from addrwatch.session import scratch_dir
from addrwatch.sources import activity, tables

SINCE = date(1998, 3, 5)
RAW = ", ".join(config.RAW_FEATURES)
STAGE = [*config.RAW_FEATURES, config.TARGET]


def _dated(df: DataFrame) -> DataFrame:
    """The partition date as text, for comparison."""
    return df.withColumn("day_text", F.col(config.PARTITION_COL).cast("string")).drop(config.PARTITION_COL)


_DAY = "CAST(partition_date AS VARCHAR) AS day_text"

# ---------------------------------------------------------------- sources


@query("s1_read_activity_csv", with_("tx", "SELECT * FROM tx"))
def s1(spark, sf):
    path = scratch_dir(spark, "csv")
    views.tx(spark, sf).write.option("header", True).csv(path)
    return activity.read_activity_csv(spark, path)


@query("s2_write_activity", with_("act", f"SELECT address, year, day, {RAW}, label, {_DAY} FROM act"))
def s2(spark, sf):
    path = scratch_dir(spark, "activity")
    activity.write_activity(views.tx(spark, sf), path)
    return _dated(spark.read.parquet(path))


@query("s3_read_activity_since", with_(
    "act", f"SELECT year, day, {RAW}, label, {_DAY} FROM act WHERE partition_date >= DATE '{SINCE}'"))
def s3(spark, sf):
    path = scratch_dir(spark, "activity")
    activity.write_activity(views.tx(spark, sf), path)
    return _dated(activity.read_activity_since(spark, path, SINCE))


@query("s4_write_stage", with_("prep", f"SELECT {RAW}, is_ransomware FROM prep"))
def s4(spark, sf):
    path = tables.write_stage(views.preprocessed(spark, sf).select(STAGE), scratch_dir(spark, "stage"))
    return spark.read.parquet(path)


@query("s5_read_stage", with_("first_pass", "SELECT is_ransomware, count(*) AS n, "
                              "round(avg(log_income), 6) AS log_income FROM first_pass GROUP BY is_ransomware"))
def s5(spark, sf):
    path = tables.write_stage(features.first_pass(views.labelled(spark, sf)), scratch_dir(spark, "stage"))
    return tables.read_stage(spark, path).groupBy(config.TARGET).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("log_income"), 6).alias("log_income"))


@query("s9_baseline", with_("sampled", """
SELECT 'is_ransomware' AS target, is_ransomware = 1 AS value, count(*) AS n
FROM sampled WHERE split = 'train' GROUP BY is_ransomware"""))
def s9(spark, sf):
    path = scratch_dir(spark, "baseline")
    split = prep.split_data(views.labelled(spark, sf))
    tables.save_baseline(split.filter(F.col("split") == "train"), path)
    return tables.load_baseline(spark, path).select("target", "value", "n")


@query("s10_stats", with_("stats", f"SELECT col, {sql_places(['mean', 'std'])} FROM stats"))
def s10(spark, sf):
    path = scratch_dir(spark, "stats")
    tables.save_stats(stats.fit_stats(features.first_pass(views.labelled(spark, sf))), path)
    return tables.load_stats(spark, path).select("col", *places(["mean", "std"]))


# ------------------------------------------------- projections and filters


@query("p1_select_columns", with_("act", f"SELECT {_DAY}, year, day, {RAW}, label FROM act"))
def p1(spark, sf):
    return _dated(prep.select_columns(views.activity(spark, sf)))


@query("p2_filter_since", with_(
    "act", f"SELECT address, {_DAY}, income FROM act WHERE partition_date >= DATE '{SINCE}'"))
def p2(spark, sf):
    return _dated(prep.filter_since(views.activity(spark, sf), SINCE).select("address", "partition_date", "income"))


@query("p3_drop_columns", with_("prep", f"SELECT address, {RAW}, is_ransomware FROM prep"))
def p3(spark, sf):
    return prep.drop_columns(prep.with_target(prep.with_transaction_date(views.activity(spark, sf))))


@query("p4_drop_null_target", with_("act", """
SELECT address, CASE WHEN label = 'white' THEN 0 ELSE 1 END AS is_ransomware
FROM act WHERE day % 5 <> 0"""))
def p4(spark, sf):
    rows = views.activity(spark, sf).withColumn("label", F.when(F.col("day") % 5 != 0, F.col("label")))
    return prep.drop_null_target(prep.with_target(rows, null_label="drop")).select("address", config.TARGET)


@query("p5_by_class", with_("prep", f"SELECT address, {RAW}, is_ransomware AS class FROM prep"))
def p5(spark, sf):
    rows = views.labelled(spark, sf)
    parts = [prep.by_class(rows, y).select("address", *config.RAW_FEATURES, F.lit(y).alias("class")) for y in (0, 1)]
    return parts[0].unionByName(parts[1])


@query("p6_feature_columns", with_("prep", f"SELECT address, {RAW} FROM prep"))
def p6(spark, sf):
    return prep.feature_columns(views.labelled(spark, sf)).drop(config.PARTITION_COL)


@query("p7_drop_raw_logged", with_("prep", """
SELECT address, length, weight, looped, is_ransomware, round(ln(1.0::DOUBLE + count), 6) AS log_count,
  round(ln(1.0::DOUBLE + neighbors), 6) AS log_neighbors, round(ln(1.0::DOUBLE + income), 6) AS log_income FROM prep"""))
def p7(spark, sf):
    logged = features.drop_raw_logged(features.log_features(views.labelled(spark, sf))).drop(config.PARTITION_COL)
    return logged.withColumns({f"log_{c}": F.round(f"log_{c}", 6) for c in config.LOG_COLS})


# ------------------------------------------------------------- aggregates


@query("a1_fit_stats", with_("stats", f"SELECT col, {sql_places(['mean', 'std'])} FROM stats"))
def a1(spark, sf):
    fitted = stats.fit_stats(features.first_pass(views.labelled(spark, sf)))
    return fitted.select("col", *places(["mean", "std"]))


@query("a2_class_counts", with_("counts", "SELECT * FROM counts"))
def a2(spark, sf):
    return stats.class_counts(views.labelled(spark, sf))


@query("a3_training_baseline", with_("sampled", """
SELECT 'is_ransomware' AS target, is_ransomware = 1 AS value, count(*) AS n
FROM sampled WHERE split = 'train' GROUP BY is_ransomware"""))
def a3(spark, sf):
    split = prep.split_data(views.labelled(spark, sf))
    return stats.training_baseline(split.filter(F.col("split") == "train")).drop("run_id")


# --------------------------------------------------- sampling and splitting


@query("r1_downsample", with_("sampled", f"SELECT address, {_DAY}, income FROM sampled WHERE is_ransomware = 0"))
def r1(spark, sf):
    rows = views.labelled(spark, sf)
    kept = prep.downsample(prep.by_class(rows, 0), stats.class_counts(rows))
    return _dated(kept.select("address", "partition_date", "income"))


@query("r2_stratified_split", with_("hashed", """
SELECT address, is_ransomware, CASE WHEN h_split < floor(0.8 * 4294967296) THEN 'train' ELSE 'test' END AS split
FROM hashed"""))
def r2(spark, sf):
    return prep.stratified_split(views.labelled(spark, sf)).select("address", config.TARGET, "split")


@query("r3_split_data", with_("sampled", f"SELECT address, {RAW}, is_ransomware, split FROM sampled"))
def r3(spark, sf):
    return prep.split_data(views.labelled(spark, sf)).select("address", *STAGE, "split")


@query("u1_union_splits", with_("sampled", "SELECT address, income, is_ransomware, split FROM sampled"))
def u1(spark, sf):
    """Train and test, each the union of its positives and negatives."""
    rows = views.labelled(spark, sf)
    kept = prep.downsample(prep.by_class(rows, 0), stats.class_counts(rows))
    halves = []
    for split in ("train", "test"):
        parts = [prep.stratified_split(part).filter(F.col("split") == split).select("address", "income", config.TARGET, "split")
                 for part in (prep.by_class(rows, 1), kept)]
        halves.append(prep.union_splits(*parts))
    return halves[0].unionByName(halves[1])


# -------------------------------------------------------- scalar functions


@query("f1_partition_date", with_("tx", """
SELECT address, CAST(CAST(make_date(year, 1, 1) + (day - 1) AS DATE) AS VARCHAR) AS at_day,
  CAST(CAST(make_date(year, 1, 1) + (day % 7 + 360 - 1) AS DATE) AS VARCHAR) AS near_year_end FROM tx"""))
def f1(spark, sf):
    year, day = F.col("year"), F.col("day")
    return views.tx(spark, sf).select(
        "address", dates.partition_date(year, day).cast("string").alias("at_day"),
        dates.partition_date(year, day % 7 + 360).cast("string").alias("near_year_end"))


@query("f2_transaction_date", with_("tx", """
SELECT address, CASE WHEN year(make_date(year, 1, 1) + (day % 7 + 360 - 1)) = year
  THEN CAST(CAST(make_date(year, 1, 1) + (day % 7 + 360 - 1) AS DATE) AS VARCHAR) END AS near_year_end FROM tx"""))
def f2(spark, sf):
    return views.tx(spark, sf).select(
        "address",
        dates.transaction_date(F.col("year"), F.col("day") % 7 + 360).cast("string").alias("near_year_end"))


@query("f3_binary_label", with_("tx", """
SELECT address, CASE WHEN label = 'white' THEN 0 ELSE 1 END AS target,
  CASE WHEN day % 5 = 0 THEN 1 WHEN label = 'white' THEN 0 ELSE 1 END AS with_gaps FROM tx"""))
def f3(spark, sf):
    gaps = F.when(F.col("day") % 5 != 0, F.col("label"))
    return views.tx(spark, sf).select(
        "address", labels.binary_label(F.col("label")).alias("target"),
        labels.binary_label(gaps).alias("with_gaps"))


_LOGS = ["log_count", "log_neighbors", "log_income"]


@query("f4_log_features", with_("prep", """
SELECT address, round(ln(1.0::DOUBLE + count), 6) + 0.0 AS log_count, round(ln(1.0::DOUBLE + neighbors), 6) + 0.0 AS log_neighbors,
  CASE WHEN income - 100000 > -1 THEN round(ln(1.0::DOUBLE + (income - 100000)), 6) + 0.0 END AS log_income FROM prep"""))
def f4(spark, sf):
    rows = views.labelled(spark, sf).withColumn("income", F.col("income") - 100000)
    return features.log_features(rows).select("address", *places(_LOGS))


_FIRST = [numeric.ratio_name(*p) for p in config.FIRST_RATIOS]


@query("f5_ratio_features", with_("first_pass", f"SELECT address, {sql_places(_FIRST, 3)} FROM first_pass"))
def f5(spark, sf):
    return features.ratio_features(views.labelled(spark, sf)).select("address", *places(_FIRST, 3))


@query("f5_second_ratio_features", with_(
    "unscaled", "SELECT address, " + sql_places([numeric.ratio_name(*p) for p in config.SECOND_RATIOS], 3)
    + " FROM unscaled"))
def f5b(spark, sf):
    passed = features.first_pass(views.labelled(spark, sf))
    return features.ratio_features(passed, config.SECOND_RATIOS).select(
        "address", *places([numeric.ratio_name(*p) for p in config.SECOND_RATIOS], 3))


@query("f6_z_score", with_("second_pass", f"SELECT address, {sql_places(config.Z_SCORE_COLS)} FROM second_pass"))
def f6(spark, sf):
    passed = features.first_pass(views.labelled(spark, sf))
    return features.z_score(passed, stats.fit_stats(passed)).select("address", *places(config.Z_SCORE_COLS))


@query("f13_safe_std", with_("stats", """
SELECT col, round(CASE WHEN std * 1e-6 > 1e-6 THEN std * 1e-6 ELSE 1.0 END, 9) AS used FROM stats"""))
def f13(spark, sf):
    fitted = stats.fit_stats(features.first_pass(views.labelled(spark, sf)))
    return fitted.select("col", F.round(numeric.safe_std(F.col("std") * 1e-6), 9).alias("used"))


@query("j3_apply_stats", with_("stats", f"""
SELECT f.address, s.col, round(s.mean, 6) + 0.0 AS mean, round(s.std, 6) + 0.0 AS std
FROM first_pass f CROSS JOIN stats s WHERE s.col IN ('log_income', 'length')"""))
def j3(spark, sf):
    passed = features.first_pass(views.labelled(spark, sf))
    cols = ["log_income", "length"]
    attached = stats.attach_stats(passed.select("address"), stats.fit_stats(passed, cols), cols, "fitted")
    rows = F.array(*[F.struct(F.lit(c).alias("col"), F.col("fitted")[c].alias("fit")) for c in cols])
    return attached.select("address", F.inline(rows)).select(
        "address", "col", F.col("fit.mean").alias("mean"), F.col("fit.std").alias("std")
    ).select("address", "col", *places(["mean", "std"]))


# ------------------------------------------------------------ composed jobs


@query("c1_preprocess", with_(
    "prep", f"SELECT {RAW}, is_ransomware FROM prep WHERE partition_date >= DATE '{SINCE}'"))
def c1(spark, sf):
    path = scratch_dir(spark, "activity")
    activity.write_activity(views.tx(spark, sf), path)
    return prepare.preprocess(spark, path, SINCE, keep_key=False)


_PASS1 = ["log_count", "log_neighbors", "log_income"]


@query("c2_first_pass", with_("first_pass", f"""
SELECT address, is_ransomware, length, weight, looped, {sql_places(_PASS1)}, {sql_places(_FIRST, 3)} FROM first_pass"""))
def c2(spark, sf):
    return features.first_pass(views.labelled(spark, sf)).select(
        "address", config.TARGET, "length", "weight", "looped", *places(_PASS1), *places(_FIRST, 3))


_PASS2 = [c for c in features.SECOND_PASS_COLS if c not in ("weight", "looped")]
_LARGE = [c for c in _PASS2 if c not in config.Z_SCORE_COLS]


@query("c3_second_pass", with_("second_pass", f"""
SELECT address, is_ransomware, weight, looped, {sql_places(config.Z_SCORE_COLS)}, {sql_places(_LARGE, 3)} FROM second_pass"""))
def c3(spark, sf):
    passed = features.first_pass(views.labelled(spark, sf))
    return features.second_pass(passed, stats.fit_stats(passed)).select(
        "address", config.TARGET, "weight", "looped", *places(config.Z_SCORE_COLS), *places(_LARGE, 3))


@query("c4_transform", with_("second_pass", f"""
SELECT address, {sql_places(config.Z_SCORE_COLS)}, {sql_places(_LARGE, 3)} FROM second_pass"""))
def c4(spark, sf):
    return features.transform(views.labelled(spark, sf)).select(
        "address", *places(config.Z_SCORE_COLS), *places(_LARGE, 3))


def _class_profile_sql() -> str:
    parts = ", ".join(
        f"round(avg({c}), 6) + 0.0 AS avg_{c}, round(stddev_samp({c}), 6) + 0.0 AS std_{c}"
        for c in config.Z_SCORE_COLS)
    return with_("second_pass", f"""
SELECT is_ransomware, count(*) AS n, {parts} FROM second_pass GROUP BY is_ransomware""")


@query("class_profile", _class_profile_sql())
def class_profile(spark, sf):
    """Labelled activity through both feature passes: each scaled feature per class."""
    scaled = features.transform(views.labelled(spark, sf))
    return scaled.groupBy(config.TARGET).agg(
        F.count(F.lit(1)).alias("n"),
        *[(F.round(fn(c), 6) + F.lit(0.0)).alias(f"{prefix}_{c}")
          for c in config.Z_SCORE_COLS for prefix, fn in (("avg", F.avg), ("std", F.stddev_samp))])
