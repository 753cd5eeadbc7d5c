"""VCF fields as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def info(text: Column) -> Column:
    """'DP=3;DB' -> map(DP -> 3, DB -> true); '.' and empty give an empty map, and of equal keys the last wins."""
    items = F.filter(F.split(text, ";"), lambda x: (x != "") & (x != "."))
    value = lambda x: F.when(F.instr(x, "=") > 0, F.regexp_extract(x, "(?s)^[^=]*=(.*)$", 1)).otherwise("true")
    pairs = F.transform(items, lambda x: F.named_struct(F.lit("key"), F.substring_index(x, "=", 1), F.lit("value"), value(x)))
    unique = F.aggregate(pairs, F.array().cast("array<struct<key:string,value:string>>"), lambda s, p: F.array_append(F.filter(s, lambda q: q["key"] != p["key"]), p))
    return F.map_from_entries(unique)


def sample_value(fmt: Column, sample: Column, key: str) -> Column:
    """The sample's value of a FORMAT key, or ''."""
    at = F.array_position(F.split(fmt, ":"), key)
    return F.when(at > 0, F.coalesce(F.get(F.split(sample, ":"), (at - 1).cast("int")), F.lit(""))).otherwise("")


def split_depths(ad: Column) -> tuple[Column, Column]:
    parts = F.split(ad, ",")
    return parts[0], F.array_join(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), ",")


def variant_type(ref: Column, alt: Column) -> Column:
    one = (F.length(ref) == 1) & F.forall(F.split(alt, ","), lambda a: F.length(a) == 1)
    return F.when(one, "SNP").otherwise("INDEL_OR_COMPLEX")


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(100.0 * part / F.nullif(whole, F.lit(0)))


def gt(genotype: Column) -> Column:
    return F.when(genotype == 2, "1/1").when(genotype == 1, "0/1").otherwise("0/0")
