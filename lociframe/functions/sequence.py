"""Bases, contexts, cycles and flags as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PAIRED, UNMAPPED, REVERSE, FIRST, SECOND, SECONDARY, QC_FAIL, DUPLICATE, SUPPLEMENTARY = 0x1, 0x4, 0x10, 0x40, 0x80, 0x100, 0x200, 0x400, 0x800


def flag_set(flag: Column, bits: int) -> Column:
    return flag.bitwiseAND(F.lit(bits)) != 0


def flag_clear(flag: Column, bits: int) -> Column:
    return flag.bitwiseAND(F.lit(bits)) == 0


def is_regular(bases: Column) -> Column:
    return bases.rlike("^[ACGTacgt]+$")


def reverse_complement(bases: Column) -> Column:
    """A<->T, C<->G, anything else N."""
    return F.reverse(F.translate(F.regexp_replace(F.upper(bases), "[^ACGT]", "N"), "ACGT", "TGCA"))


def let(value: Column, f) -> Column:
    """f of a value that is computed once, where lambdas inside f use it many times."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def cycle(offset: Column, length: Column, reverse: Column, second: Column) -> Column:
    """Sequencing cycle from 1, counted from the read's start; negative for second of pair."""
    n = F.when(reverse, length - offset).otherwise(offset + 1)
    return F.when(second, -n).otherwise(n)


def contexts(bases: Column, quals: Column, reverse: Column, k: int = 2, low: int = 2) -> Column:
    """Array by offset in the read: the k bases that end at it in order of sequencing; null where one is not regular.

    Bases in the low-quality tails (quality <= low) count as N.
    """
    n = F.length(bases)
    at = F.sequence(F.lit(0), n - 1)
    good = F.filter(at, lambda i: F.get(quals, i) > low)
    bounds = F.struct(F.coalesce(F.array_min(good), n).alias("first"), F.coalesce(F.array_max(good), n - 1).alias("last"))

    def masked(x: Column) -> Column:
        kept = F.substr(F.upper(bases), x["first"] + 1, x["last"] - x["first"] + 1)
        return F.concat(F.repeat(F.lit("N"), x["first"]), F.when(x["first"] < n, kept).otherwise(""), F.repeat(F.lit("N"), n - 1 - x["last"]))

    def found(strand: Column) -> Column:
        words = F.transform(at, lambda i: F.when(i >= k - 1, F.substr(strand, i - (k - 2), F.lit(k))))
        kept = F.transform(words, lambda x: F.when((x != "") & (F.translate(x, "ACGT", "") == ""), x))
        return F.when(reverse, F.reverse(kept)).otherwise(kept)

    strand = let(let(bounds, masked), lambda m: F.when(reverse, reverse_complement(m)).otherwise(m))
    return F.when(n > 0, let(strand, found)).otherwise(F.array().cast("array<string>"))


def masked_bases(bases: Column, quals: Column, low: int = 2) -> Column:
    """The bases with N in both low-quality tails (quality <= low); as contexts() takes them."""
    n = F.length(bases)
    first = F.array_position(F.transform(quals, lambda q: q > low), True) - 1
    last = F.size(quals) - F.array_position(F.transform(F.reverse(quals), lambda q: q > low), True)
    good = first >= 0
    middle = F.substring(F.upper(bases), F.when(good, first + 1).otherwise(1).cast("int"), F.when(good, last - first + 1).otherwise(0).cast("int"))
    return F.concat(F.repeat(F.lit("N"), F.when(good, first).otherwise(n).cast("int")), middle, F.repeat(F.lit("N"), F.when(good, n - 1 - last).otherwise(0).cast("int")))


def context_at(masked: Column, offset: Column, reverse: Column, k: int = 2) -> Column:
    """One item of contexts(), from masked_bases(): the k bases that end at this offset in order of sequencing, null where one is not regular or missing."""
    first = F.when(reverse, offset).otherwise(offset - (k - 1))
    word = F.when(first >= 0, F.substring(masked, first + 1, F.lit(k)))
    regular = (F.length(word) == k) & (F.translate(word, "ACGT", "") == "")
    return F.when(regular, F.when(reverse, F.reverse(F.translate(word, "ACGT", "TGCA"))).otherwise(word))


def original_qualities(oq: Column) -> Column:
    """Text qualities to numbers."""
    return F.transform(F.split(oq, ""), lambda c: F.greatest(F.lit(0), F.ascii(c) - 33))
