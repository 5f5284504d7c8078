"""Keyed state of streams."""

from __future__ import annotations

from pyspark.sql import SparkSession

from addrwatch.session import ship_package

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def prepare(spark: SparkSession) -> None:
    """State functions need RocksDB, where a key's state is read and written alone, and this package in the workers."""
    if spark.conf.get(_PROVIDER, "") != _ROCKS:
        spark.conf.set(_PROVIDER, _ROCKS)
    ship_package(spark)
