"""Session defaults and table access shared by all operators."""

from __future__ import annotations

import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "lociframe", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benches; on a cluster, pass your own session instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settled(df: DataFrame) -> DataFrame:
    """df written to the checkpoint folder and read from there, so that what follows does not compute it again.

    The folder is the one that spark.checkpoint.dir names; a temporary one only where that is unset and Spark runs on this machine alone.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        found = context.getConf().get("spark.checkpoint.dir", None)
        if not found and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(found or tempfile.mkdtemp(prefix="lociframe-checkpoint-"))
    return df.checkpoint()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once for each application, through Spark's own file server."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    here = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="lociframe-ship-")) / "lociframe_package.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, p.relative_to(here.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)
