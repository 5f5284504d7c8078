"""Explicit schemas; nothing in the library infers one from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_LONG, _DOUBLE, _STRING, _INT, _TIME = (
    T.LongType(), T.DoubleType(), T.StringType(), T.IntegerType(), T.TimestampType(),
)

# One address on one day.
ACTIVITY = _struct(
    address=_STRING, year=_INT, day=_INT, length=_LONG, weight=_DOUBLE, count=_LONG,
    looped=_LONG, neighbors=_LONG, income=_DOUBLE, label=_STRING,
)

# The same as a dataset with one folder per date.
ACTIVITY_BY_DATE = T.StructType([*ACTIVITY.fields, T.StructField("partition_date", T.DateType())])

# The given tables behind the views.
_WALL = T.TimestampNTZType()
ORDERS = _struct(
    o_orderkey=_LONG, o_custkey=_LONG, o_orderstatus=_STRING, o_totalprice=_DOUBLE,
    o_orderdate=_WALL, o_orderpriority=_STRING,
)
LINEITEM = _struct(
    l_orderkey=_LONG, l_partkey=_LONG, l_suppkey=_LONG, l_linenumber=_INT, l_quantity=_DOUBLE,
    l_extendedprice=_DOUBLE, l_discount=_DOUBLE, l_tax=_DOUBLE, l_returnflag=_STRING,
    l_linestatus=_STRING, l_shipdate=_WALL,
)
EVENTS = _struct(
    event_id=_LONG, ts=_WALL, user_id=_LONG, event_type=_STRING, value=_DOUBLE, props=_STRING,
)

# One scoring request.
REQUEST = _struct(
    request_id=_STRING, ts=_TIME, length=_DOUBLE, weight=_DOUBLE, count=_DOUBLE,
    looped=_DOUBLE, neighbors=_DOUBLE, income=_DOUBLE,
)

# One served prediction, as kept for drift monitoring. ``timestamp`` is ISO text
# in the JSON form and a timestamp in the Parquet form.
TELEMETRY_JSON = _struct(timestamp=_STRING, is_ransomware=T.BooleanType(), confidence=_DOUBLE)

# Training class counts.
BASELINE = _struct(run_id=_STRING, target=_STRING, value=T.BooleanType(), n=_LONG)

# Fitted column statistics.
STATS = _struct(col=_STRING, mean=_DOUBLE, std=_DOUBLE)

# Additive model: one row per term and bin. ``lo``/``hi`` bound the first
# feature and ``lo2``/``hi2`` the second one of a pair term; all four are null
# in the bin for missing values.
MODEL_TERMS = _struct(
    term=_STRING, bin=_INT, lo=_DOUBLE, hi=_DOUBLE, lo2=_DOUBLE, hi2=_DOUBLE, score=_DOUBLE,
)
MODEL_HEAD = _struct(intercept=_DOUBLE, threshold=_DOUBLE)

# Metric samples.
SAMPLE = T.StructType([
    T.StructField("metric", _STRING),
    T.StructField("labels", T.MapType(_STRING, _STRING)),
    T.StructField("ts", _TIME),
    T.StructField("value", _DOUBLE),
])

# Run registry.
RUN = T.StructType([
    T.StructField("run_id", _STRING),
    T.StructField("run_name", _STRING),
    T.StructField("status", _STRING),
    T.StructField("start_ts", _TIME),
    T.StructField("params", T.MapType(_STRING, _STRING)),
    T.StructField("metrics", T.MapType(_STRING, _DOUBLE)),
    T.StructField("feature_info", T.MapType(_STRING, T.MapType(_STRING, _DOUBLE))),
])
