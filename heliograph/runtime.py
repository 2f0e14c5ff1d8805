"""Session helpers: the shared working folder and shipping this package to executors."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_ROOT = Path(__file__).resolve().parent


def session(app: str = "heliograph", cores: str = "*") -> SparkSession:
    """A local session with the settings the engine expects (UTC, AQE)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def ship_code(spark: SparkSession) -> None:
    """Sends this package to the executors once per context, for Python functions that run there."""
    sc = spark.sparkContext
    if getattr(sc, "_heliograph_shipped", False):
        return
    folder = os.path.realpath(tempfile.mkdtemp(prefix="heliograph-code-"))
    atexit.register(shutil.rmtree, folder, True)
    target = os.path.join(folder, "heliograph_code.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(_ROOT.rglob("*.py")):
            z.write(f, f.relative_to(_ROOT.parent))
    sc.addPyFile(target)
    sc._heliograph_shipped = True


def workspace(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only where that setting is absent and everything runs in this process (tests, a laptop) a folder
    of this machine stands in for it; on a cluster its absence is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = getattr(spark.sparkContext, "_heliograph_workspace", None)
        if base is None:
            base = tempfile.mkdtemp(prefix="heliograph-")
            atexit.register(shutil.rmtree, base, True)
            spark.sparkContext._heliograph_workspace = base
    return base.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{workspace(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._heliograph_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Deletes tables that `saved` wrote, once nothing reads them any more."""
    for df in frames:
        target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._heliograph_path)
        target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)
