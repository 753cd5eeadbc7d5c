"""Rows in order: the last mark before each row, for many kinds of marks in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lociframe.operators.intervals import BIN


def last_marks(df: DataFrame, keys: tuple[str, ...], at: str, marks: dict[str, Column], before: bool = False) -> DataFrame:
    """Adds for each mark its last value that is not null, up to this row in order of `at` inside keys, or strictly before it; and <name>_at, its place.

    Windows run inside bins of `at`; one row for each bin carries the last marks on, so a file is the work of as many tasks as it has bins.
    """
    own = {f"_m_{n}": F.when(c.isNotNull(), F.struct(F.col(at).alias("at"), c.alias("value"))) for n, c in marks.items()}
    binned = df.withColumn("_bin", F.floor(F.col(at) / BIN)).withColumns(own)
    by_bin = binned.groupBy(*keys, "_bin").agg(*(F.max(m).alias(m) for m in own))
    earlier = W.partitionBy(*keys).orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    carried = by_bin.select(*keys, "_bin", *(F.max(m).over(earlier).alias(f"_c{m}") for m in own))
    inside = W.partitionBy(*keys, "_bin").orderBy(at).rowsBetween(W.unboundedPreceding, -1 if before else 0)
    both = binned.join(carried, [*keys, "_bin"]).withColumns({f"_i{m}": F.max(m).over(inside) for m in own})
    found = {n: F.coalesce(f"_i_m_{n}", f"_c_m_{n}") for n in marks}
    out = both.withColumns({f"_f_{n}": c for n, c in found.items()})
    out = out.withColumns({n: F.col(f"_f_{n}.value") for n in marks} | {f"{n}_at": F.col(f"_f_{n}.at") for n in marks})
    return out.drop("_bin", *own, *(f"_c{m}" for m in own), *(f"_i{m}" for m in own), *(f"_f_{n}" for n in marks))
