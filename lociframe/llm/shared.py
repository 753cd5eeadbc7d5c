"""Helpers that several corpus operators use."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where it is unset and Spark runs on this machine alone."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        found = spark.conf.get("lociframe.local.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='lociframe-')}"
        spark.conf.set("lociframe.local.checkpoint.dir", found)
    return found


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write df as Parquet in the shared folder and read it again: short lineage that survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete what cut() wrote for df, when nothing lazy reads it any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of DataFrames that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): (id, label), label the least id of each component; for ids in links only.

    Each round maps every node to its least neighbour, follows that map on to itself, and contracts the graph, which at
    least halves; tables are cut in the shared folder each round, and nothing but a count comes to the driver.
    """
    both = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = cut(both, "edges")
    labels = cut(edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct().select("id", F.col("id").alias("label")), "labels")
    while not edges.isEmpty():
        turned = edges.union(edges.select("b", "a")).toDF("v", "w")
        steps = [cut(turned.groupBy("v").agg(F.least(F.col("v"), F.min("w")).alias("to")), "step")]
        for _ in range(2):
            onward = steps[-1].toDF("to", "on")
            steps.append(cut(steps[-1].join(onward, "to").select("v", F.col("on").alias("to")), "step"))
        step, old = steps[-1], (labels, edges, *steps)
        labels = cut(labels.join(step.toDF("label", "to"), "label", "left").select("id", F.coalesce("to", "label").alias("label")), "labels")
        moved = edges.join(step.toDF("a", "a2"), "a").join(step.toDF("b", "b2"), "b")
        edges = cut(moved.where("a2 <> b2").select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(), "edges")
        for df in old:
            forget(df)
    forget(edges)
    return labels


_tables: dict[str, Callable[[], None]] = {}
#: glibc's call that returns free memory; other C libraries have none.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def claim(owner: str, clear: Callable[[], None] | None = None) -> None:
    """Called in a worker when an operator's task starts: tables that other operators keep between tasks are cleared, and free memory goes back to the system."""
    for name in [n for n in _tables if n != owner]:
        _tables.pop(name)()
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)
    if clear is not None:
        _tables[owner] = clear
