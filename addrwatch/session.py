"""Session settings for tests and the benchmark, and the shared scratch folder."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_LOCAL: dict[str, str] = {}
_SHIPPED: set[str] = set()


def build_session(cpus: int | str = "*", app: str = "addrwatch", **conf: str) -> SparkSession:
    """Local session. On a cluster the session comes from the submit command."""
    parts = "8" if cpus == "*" else str(cpus)
    settings = {
        "spark.sql.shuffle.partitions": parts,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": parts,
    } | conf
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one named by ``spark.checkpoint.dir``.

    Every executor must reach it, so a cluster without the setting is refused; only a local
    master, where driver and executor are one process, falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.sparkContext.applicationId
        base = _LOCAL[app] = _LOCAL.get(app) or tempfile.mkdtemp(prefix="addrwatch-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, *paths: str) -> None:
    """Deletes folders made by ``scratch_dir`` once nothing reads them any more."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def ship_package(spark: SparkSession) -> None:
    """Makes this package importable in Python workers, whatever their path; once per application.

    The modules go as one zip file through the shared scratch folder.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root, packed = Path(__file__).parent, io.BytesIO()
    with zipfile.ZipFile(packed, "w") as file:
        for module in sorted(root.rglob("*.py")):
            file.write(module, module.relative_to(root.parent))
    target = sc._jvm.org.apache.hadoop.fs.Path(f"{scratch_dir(spark, 'package')}/{root.name}.zip")
    out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(packed.getvalue()))
    out.close()
    sc.addPyFile(target.toString())
    _SHIPPED.add(sc.applicationId)
