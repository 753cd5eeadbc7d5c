"""Phred arithmetic and diploid models as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

FLOOR = 2.2250738585072014e-308
SNP_PRIOR = (0.0, math.log10(1e-3) - math.log10(3), 2 * (math.log10(1e-3) - math.log10(3)))
INDEL_PRIOR = (0.0, math.log10(1 / 8000), 2 * math.log10(1 / 8000))
ASSEMBLED_PRIOR = (math.log10(1 - 1.5e-3), math.log10(1e-3), math.log10(5e-4))


def error(q: Column, cap: int | None = None) -> Column:
    q = F.least(q, F.lit(cap)) if cap is not None else q
    return F.pow(F.lit(10.0), -q.cast("double") / 10)


def phred(p: Column) -> Column:
    return F.greatest(F.lit(1), F.least(F.lit(93), F.round(-10 * F.log10(p)).cast("int")))


def quality_of(log10_ref: Column) -> Column:
    """QUAL from the log10 posterior of the reference genotype."""
    return F.when(log10_ref <= -999.9, 9999).otherwise(F.greatest(F.lit(0), F.least(F.lit(9999.0), F.round(-10 * log10_ref)).cast("int")))


def pl(x: Column, best: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(999.0), F.round(-10 * (x - best))).cast("int"))


def log10_sum_exp(values: Column) -> Column:
    """log10 of the sum of 10^v over an array; its greatest value as it is where that is not finite."""
    top = F.array_max(values)
    total = F.aggregate(values, F.lit(0.0), lambda s, v: s + F.pow(F.lit(10.0), v - top))
    return F.when(F.abs(top) == float("inf"), top).otherwise(top + F.log10(total))


def observation(match: Column, err: Column) -> Column:
    return F.greatest(F.when(match, 1 - err).otherwise(err / 3), F.lit(FLOOR))


def diploid(n_ref: Column, n_alt: Column, err: Column) -> tuple[Column, Column, Column]:
    """log10 likelihoods of 0/0, 0/1 and 1/1 from counts of reference and alternative observations of equal error."""
    good, bad = observation(F.lit(True), err), observation(F.lit(False), err)
    same = F.log10(0.5 * good + 0.5 * bad)
    return n_ref * F.log10(good) + n_alt * F.log10(bad), (n_ref + n_alt) * same, n_ref * F.log10(bad) + n_alt * F.log10(good)


def genotype(likelihoods: tuple[Column, Column, Column], prior: tuple[float, float, float]) -> Column:
    """struct(genotype, qual, pl array): the model's call from likelihoods and priors; PL come from the posteriors."""
    post = [x + p for x, p in zip(likelihoods, prior, strict=True)]
    norm = log10_sum_exp(F.array(*post))
    a, b, c = [x - norm for x in post]
    best = F.greatest(a, b, c)
    call = F.when((c > a) & (c > b), 2).when(b > a, 1).otherwise(0)
    return F.struct(call.alias("genotype"), quality_of(a).alias("qual"), F.array(pl(a, best), pl(b, best), pl(c, best)).alias("pl"))


def genotype_quality(pls: Column, call: Column) -> Column:
    """Least PL of the other genotypes, 99 at most."""
    others = F.filter(F.transform(pls, lambda x, i: F.when(i != call, x)), lambda x: x.isNotNull())
    return F.least(F.lit(99), F.array_min(others))


def quality_by_depth(qual: Column, depth: Column) -> Column:
    qd = F.when(depth > 0, qual / depth).otherwise(F.lit(0.0))
    return F.when(qd >= 35, F.lit(30.0)).otherwise(qd)


def fisher_strand(rf: Column, rr: Column, af: Column, ar: Column) -> Column:
    """Phred of the two-sided exact test on the strand table; the table is scaled to about 200 where it holds over 400."""
    total = (rf + rr + af + ar).cast("double")
    fit = lambda x: F.when(total > 400, F.round(x * 200 / total).cast("int")).otherwise(x.cast("int"))
    a, b, c, d = (fit(x) for x in (rf, rr, af, ar))
    top, left = a + b, a + c
    n = a + b + c + d
    logfact = lambda k: F.aggregate(F.sequence(F.lit(1), F.greatest(k, F.lit(1))), F.lit(0.0), lambda s, i: s + F.log(i.cast("double")))
    fixed = logfact(top) + logfact(n - top) + logfact(left) + logfact(n - left) - logfact(n)
    at = lambda x: fixed - logfact(x) - logfact(top - x) - logfact(left - x) - logfact(n - top - left + x)
    seen = at(a)
    tail = F.aggregate(F.sequence(F.greatest(F.lit(0), top + left - n), F.least(top, left)), F.lit(0.0), lambda s, x: s + F.when(at(x) <= seen + 1e-12, F.exp(at(x))).otherwise(0.0))
    p = F.when((n == 0) | (top == 0) | (top == n) | (left == 0) | (left == n), F.lit(1.0)).otherwise(F.least(F.lit(1.0), tail))
    return F.abs(-10 * F.log10(F.greatest(p, F.lit(1e-320))))
