"""Recalibration reports: covariate tables as lines of a fixed-width report, and back."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.operators import bqsr

# Fixed values of the format: each table's title, columns and column formats.
TABLES = {
    "Arguments": ("Recalibration argument collection values used in this run", ["Argument", "Value"], ["%s", "%s"]),
    "Quantized": ("Quality quantization map", ["QualityScore", "Count", "QuantizedScore"], ["%d", "%d", "%d"]),
    "RecalTable0": ("", ["ReadGroup", "EventType", "EmpiricalQuality", "EstimatedQReported", "Observations", "Errors"], ["%s", "%s", "%.4f", "%.4f", "%d", "%.2f"]),
    "RecalTable1": ("", ["ReadGroup", "QualityScore", "EventType", "EmpiricalQuality", "Observations", "Errors"], ["%s", "%d", "%s", "%.4f", "%d", "%.2f"]),
    "RecalTable2": ("", ["ReadGroup", "QualityScore", "CovariateValue", "CovariateName", "EventType", "EmpiricalQuality", "Observations", "Errors"], ["%s", "%d", "%s", "%s", "%s", "%.4f", "%d", "%.2f"]),
}
ORDER = list(TABLES)
NUMBER = r"^(null|NA|[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan)))$"


def _rows(df: DataFrame, table: str, cells: list[Column | str], a: Column | str = "rg", b: Column | None = None, c: Column | None = None, d: Column | None = None) -> DataFrame:
    """Rows of one table: cells as text, and the keys that order them."""
    text = lambda x: x.cast("string") if isinstance(x, Column) else F.col(x).cast("string")
    blank = F.lit("")
    return df.select(F.lit(ORDER.index(table)).alias("k"), F.array(*map(text, cells)).alias("cells"), text(a).alias("a"), F.coalesce(b if b is not None else F.lit(0), F.lit(0)).cast("long").alias("b"), (blank if c is None else c).alias("c"), (blank if d is None else d).alias("d"))


def report_lines(tables: DataFrame, arguments: Mapping[str, str] | None = None, quantized: DataFrame | None = None) -> DataFrame:
    """covariate_tables() as report lines in order: table, value. Read groups go by name; values of a covariate go by their text.

    quantized: quality, observations, quantized. Both it and the arguments may be left out, with their tables.
    Column widths come from one aggregate of a row for each table and column.
    """
    spark = tables.sparkSession
    number = lambda x: F.format_string("%.4f", x)
    counts = ["observations", F.format_string("%.2f", F.col("errors").cast("double"))]
    own = number(bqsr.empirical_quality(F.col("observations"), F.col("errors"), F.col("qual")))
    group = number(bqsr.empirical_quality(F.col("observations"), F.col("errors"), F.col("reported")))
    m, rest = F.lit("M"), tables.where("covariate <> 'Quality'")
    rows = _rows(bqsr.read_group_table(tables), "RecalTable0", ["rg", m, group, number(F.col("reported")), *counts])
    rows = rows.unionByName(_rows(tables.where("covariate = 'Quality'"), "RecalTable1", ["rg", "qual", m, own, *counts], b=F.col("qual")))
    rows = rows.unionByName(_rows(rest, "RecalTable2", ["rg", "qual", "value", "covariate", m, own, *counts], b=F.col("qual"), c=F.col("value"), d=F.col("covariate")))
    if arguments:
        given = spark.createDataFrame([(k, str(v)) for k, v in arguments.items()], "name string, value string")
        rows = rows.unionByName(_rows(given, "Arguments", ["name", "value"], "name"))
    if quantized is not None:
        rows = rows.unionByName(_rows(quantized, "Quantized", ["quality", "observations", "quantized"], F.lit(""), b=F.col("quality")))
    shown = [t for t in ORDER if (t != "Arguments" or arguments) and (t != "Quantized" or quantized is not None)]
    fixed = spark.createDataFrame([(ORDER.index(t), t, *TABLES[t]) for t in shown], "k int, table string, title string, columns array<string>, formats array<string>")
    seen = rows.select("k", F.posexplode("cells").alias("i", "cell")).groupBy("k", "i").agg(F.max(F.length("cell")).alias("w")).groupBy("k").agg(F.array_sort(F.collect_list(F.struct("i", "w"))).alias("seen"))
    sizes = fixed.join(seen, "k", "left").join(rows.groupBy("k").agg(F.count("*").alias("n")), "k", "left")
    wide = F.transform("columns", lambda c, i: F.greatest(F.length(c), F.coalesce(F.get("seen", i)["w"], F.lit(0))))
    sizes = sizes.select("k", "table", "title", "columns", "formats", F.coalesce("n", F.lit(0)).alias("n"), wide.alias("widths"))
    pad = lambda x, w, right: F.concat(x, F.repeat(F.lit(" "), w - F.length(x))) if not right else F.concat(F.repeat(F.lit(" "), w - F.length(x)), x)
    joined = lambda cells, f: F.array_join(F.transform(F.arrays_zip(cells.alias("x"), F.col("widths").alias("w")), f), "  ")
    heads = F.array(
        F.concat(F.lit("#:GATKTable:"), F.size("columns").cast("string"), F.lit(":"), F.col("n").cast("string"), F.lit(":"), F.array_join("formats", ":"), F.lit(":;")),
        F.concat(F.lit("#:GATKTable:"), "table", F.lit(":"), "title"),
        joined(F.col("columns"), lambda z: pad(z["x"], z["w"], False)),
    )
    top = sizes.select("k", "table", F.lit(0).alias("part"), F.posexplode(heads).alias("b", "value"))
    end = sizes.select("k", "table", F.lit(2).alias("part"), F.lit(0).alias("b"), F.lit("").alias("value"))
    line = joined(F.col("cells"), lambda z: F.when(z["x"].rlike(NUMBER), pad(z["x"], z["w"], True)).otherwise(pad(z["x"], z["w"], False)))
    body = rows.join(sizes, "k").select("k", "table", F.lit(1).alias("part"), "a", "b", "c", "d", line.alias("value"))
    first = spark.range(1).select(F.lit(-1).alias("k"), F.lit("").alias("table"), F.lit(0).alias("part"), F.lit(0).alias("b"), F.lit("#:GATKReport.v1.1:5").alias("value"))
    every = body.unionByName(top.unionByName(end).unionByName(first), allowMissingColumns=True)
    return every.orderBy("k", "part", F.coalesce("a", F.lit("")), "b", F.coalesce("c", F.lit("")), F.coalesce("d", F.lit(""))).select("table", "value")


def report_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the known tables of a report, a file or a folder of part files in order: table, cells. Titles, headers and other tables go.

    A file names its few tables on lines of their own; these alone come to the driver, and each line belongs to the last before it.
    """
    lines = spark.read.text(path).select(F.rtrim("value").alias("value"), F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n")).alias("at")).where("value <> ''")
    named = lines.where(F.col("value").rlike(r"^#:GATKTable:[^:\d][^:]*:|^#:GATKTable:[^:\d][^:]*$")).withColumn("table", F.split("value", ":")[2]).orderBy("at").collect()
    table = F.lit(None).cast("string")
    for r in named:
        table = F.when(F.col("at") > F.struct(*map(F.lit, r["at"])).cast("struct<file:string,block:bigint,n:bigint>"), F.lit(r["table"])).otherwise(table)
    headers = F.array(*[F.array_join(F.array(*map(F.lit, columns)), " ") for _, columns, _ in TABLES.values()])
    cells = lines.where(~F.col("value").startswith("#")).select(table.alias("table"), F.split(F.trim("value"), r"\s+").alias("cells"))
    return cells.where(F.col("table").isin(ORDER) & ~F.array_contains(headers, F.array_join("cells", " ")))


def report_arguments(rows: DataFrame) -> dict[str, str]:
    """Arguments of a report; one without the standard covariates is an error."""
    found = {r["cells"][0]: " ".join(r["cells"][1:]) for r in rows.where("table = 'Arguments'").collect()}
    if found.get("no_standard_covs", "false") == "true":
        raise ValueError("the report lacks the standard covariates")
    return found


def report_quantized(rows: DataFrame) -> list[int]:
    """The map of 94 qualities; a missing one is an error."""
    given = {int(r["cells"][0]): int(r["cells"][2]) for r in rows.where("table = 'Quantized'").collect()}
    missing = [q for q in range(bqsr.MAX_QUALITY + 1) if q not in given]
    if missing:
        raise ValueError(f"no quantized row for quality {missing[0]}")
    return [given[q] for q in range(bqsr.MAX_QUALITY + 1)]


def report_tables(rows: DataFrame) -> DataFrame:
    """covariate_tables() of a report, as recalibrate() takes them. An event other than M or an unknown covariate is an error."""
    c = lambda i: F.col("cells")[i]
    second = F.col("table") == "RecalTable2"
    event, name = F.when(second, c(4)).otherwise(c(2)), F.when(second, c(3)).otherwise("Quality")
    bad = F.concat(F.lit("bad report row: "), F.array_join("cells", " "))
    ok = (event == "M") & name.isin("Quality", "Cycle", "Context") & (F.size("cells") == F.when(second, 8).otherwise(6))
    good = rows.where(F.col("table").isin("RecalTable1", "RecalTable2")).where(F.when(ok, True).otherwise(F.raise_error(bad).cast("boolean")))
    return good.select(
        c(0).alias("rg"), c(1).cast("int").alias("qual"), name.alias("covariate"), F.when(second, c(2)).otherwise("").alias("value"),
        F.when(second, c(6)).otherwise(c(4)).cast("long").alias("observations"), F.round(F.when(second, c(7)).otherwise(c(5)).cast("double")).cast("long").alias("errors"),
    )
