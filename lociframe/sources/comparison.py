"""Lines of summary files: comparisons of call sets, stage diffs, candidate intervals.

Each function gives (file, part, line) and a text `value`; ordered by file, part and line (and by their keys in detail files) they are
the files. Counts come from one row of sums, and details from the same joined table, sorted by range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociframe.functions import vcf as V
from lociframe.operators.variants import KEY

KINDS = ("snp", "indel_or_complex")
SETS = ("shared", "a_private", "b_private")
#: Cells of a comparison row, in the order in which files have them.
CELLS = ["a_count", "b_count", "shared", "a_private", "b_private", "a_sensitivity", "b_precision_vs_a", *(f"{s}_{k}" for s in SETS for k in KINDS), "gt_same", "gt_diff"]
#: Settings lead the candidate summary, then these measured values.
MEASURED = ["input_intervals", "input_bases", "pileup_sites", "covered_sites", "candidate_sites", "mean_filtered_depth", "max_filtered_depth", "output_intervals", "output_bases", "reduction_fraction", "used_input_fallback"]


def json_escape(x: Column) -> Column:
    """The text between a JSON string's quotes: backslash, quote, newline, return and tab by two signs, all else as it is."""
    for plain, sign in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        x = F.replace(x, F.lit(plain), F.lit(sign))
    return x


def comparison_counts(compared: DataFrame) -> DataFrame:
    """One row of sums over variants.compare(): all_<cell> and pass_<cell>, and for each side its records by PASS and type.

    The PASS comparison holds keys that pass on a side, so a shared key that passes on one side alone is that side's own.
    """
    n = lambda c: F.coalesce(F.sum(F.coalesce(c, F.lit(False)).cast("long")), F.lit(0))
    cat, snp = F.col("category"), F.col("type") == "SNP"
    has = {"a": cat != "b_private", "b": cat != "a_private"}
    good = {x: has[x] & (F.col(f"{x}_filter") == "PASS") for x in "ab"}
    sums = {}
    for name, (a, b) in (("all", (has["a"], has["b"])), ("pass", (F.coalesce(good["a"], F.lit(False)), F.coalesce(good["b"], F.lit(False))))):
        sets = {"shared": a & b, "a_private": a & ~b, "b_private": b & ~a}
        sums |= {f"{name}_a_count": n(a), f"{name}_b_count": n(b), **{f"{name}_{s}": n(c) for s, c in sets.items()}}
        sums |= {f"{name}_{s}_{k}": n(c & (snp if k == "snp" else ~snp)) for s, c in sets.items() for k in KINDS}
        sums |= {f"{name}_gt_same": n(a & b & (F.col("a_gt") == F.col("b_gt"))), f"{name}_gt_diff": n(a & b & (F.col("a_gt") != F.col("b_gt")))}
    for x in "ab":
        sums |= {f"{x}_total": n(has[x]), f"{x}_pass": n(good[x]), f"{x}_all_snp": n(has[x] & snp), f"{x}_all_indel": n(has[x] & ~snp), f"{x}_pass_snp": n(good[x] & snp), f"{x}_pass_indel": n(good[x] & ~snp)}
    out = compared.agg(*(c.alias(k) for k, c in sums.items()))
    share = {f"{s}_{c}": V.percent(F.col(f"{s}_shared"), F.col(f"{s}_{d}")) for s in ("all", "pass") for c, d in (("a_sensitivity", "a_count"), ("b_precision_vs_a", "b_count"))}
    return out.withColumns(share)


def filter_counts(compared: DataFrame) -> DataFrame:
    """One row: a_filters and b_filters, texts `filter:keys` in order of filter. There are as many as a caller has filters."""
    sides = F.array(*(F.struct(F.lit(x).alias("side"), F.col(f"{x}_filter").alias("filter"), (F.col("category") != other).alias("has")) for x, other in (("a", "b_private"), ("b", "a_private"))))
    counts = compared.select(F.explode(sides).alias("s")).where("s.has").groupBy("s.side", F.coalesce("s.filter", F.lit("")).alias("filter")).agg(F.count("*").alias("n"))
    text = lambda x: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("side") == x, F.struct("filter", "n")))), lambda s: F.concat(s["filter"], F.lit(":"), s["n"].cast("string"))), ", ")
    return counts.agg(text("a").alias("a_filters"), text("b").alias("b_filters"))


def _cell(name: str, digits: int, unit: str = "") -> Column:
    real = name.endswith(("sensitivity", "precision_vs_a"))
    return F.concat(F.format_string(f"%.{digits}f", F.col(name)), F.lit(unit)) if real else F.col(name).cast("string")


def _listed(row: DataFrame, file: str, lines: list[Column]) -> DataFrame:
    each = row.select(F.posexplode(F.array(*lines)).alias("line", "value"))
    return each.select(F.lit(file).alias("file"), F.lit(0).alias("part"), F.col("line").cast("long").alias("line"), "value")


def _bar(*cells) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *(c if isinstance(c, Column) else F.lit(c) for c in cells)), F.lit(" |"))


def comparison_files(compared: DataFrame, a_label: str, b_label: str) -> DataFrame:
    """The files summary.md, summary.tsv, summary.json and details.tsv of variants.compare()."""
    row = comparison_counts(compared).join(filter_counts(compared), how="full_outer")  # one row each
    title = lambda *x: _bar(*x)
    side = lambda x, label: _bar(label, *(F.col(f"{x}_{c}").cast("string") for c in ("total", "pass")), (F.col(f"{x}_total") - F.col(f"{x}_pass")).cast("string"), *(F.col(f"{x}_{c}").cast("string") for c in ("pass_snp", "pass_indel", "all_snp", "all_indel")), F.col(f"{x}_filters"))
    md = [
        F.lit(f"# VCF comparison: {a_label} vs {b_label}"), F.lit(""), F.lit("## Counts"), F.lit(""),
        title("dataset", "total allele keys", "PASS allele keys", "non-PASS allele keys", "PASS SNP", "PASS indel/complex", "all SNP", "all indel/complex", "filters"), F.lit("|---|" + "---:|" * 7 + "---|"),
        side("a", a_label), side("b", b_label), F.lit(""), F.lit("## Exact Allele-Key Comparison"), F.lit(""),
        title("set", "A count", "B count", "shared", "A private", "B private", "A sensitivity", "B precision vs A", *(f"{s} {k}" for s in ("shared", "A-private", "B-private") for k in ("SNP", "indel/complex")), "GT same", "GT diff"), F.lit("|---|" + "---:|" * len(CELLS)),
        *(_bar(label, *(_cell(f"{s}_{c}", 3, "%" if "_sensitivity" in c or "_precision" in c else "") for c in CELLS)) for s, label in (("all", "all allele keys"), ("pass", "PASS only"))),
    ]
    tsv = [F.lit("\t".join(["set", *CELLS])), *(F.concat_ws("\t", F.lit(s), *(_cell(f"{s}_{c}", 6) for c in CELLS)) for s in ("all", "pass"))]
    told = [c for c in CELLS if not c.endswith(KINDS)]
    json = [F.lit("{"), *(F.concat(F.lit(f'  "{x}_label": "'), json_escape(F.lit(label)), F.lit('",')) for x, label in (("a", a_label), ("b", b_label)))]
    for s in ("all", "pass"):
        json += [F.lit(f'  "{s}_records": {{'), *(F.concat(F.lit(f'    "{c}": '), _cell(f"{s}_{c}", 6), F.lit("" if c == told[-1] else ",")) for c in told), F.lit("  }," if s == "all" else "  }")]
    json.append(F.lit("}"))
    names = ["category", *KEY, "type", "a_filter", "b_filter", "a_gt", "b_gt"]
    head = row.select(F.lit("details.tsv").alias("file"), F.lit(0).alias("part"), F.lit(0).cast("long").alias("line"), F.lit("\t".join(names)).alias("value"))
    # the line of a detail row is its position; rows of one position follow by their text
    body = compared.select(F.lit("details.tsv").alias("file"), F.lit(1).alias("part"), F.col("pos").cast("long").alias("line"), F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names)).alias("value"))
    whole = _listed(row, "summary.md", md).unionAll(_listed(row, "summary.tsv", tsv)).unionAll(_listed(row, "summary.json", [*json])).unionAll(head).unionAll(body)
    return whole.orderBy("file", "part", "line", "value")


STAGE_CELLS = ["a_rows", "b_rows", "shared", "a_private", "b_private", "shared_with_diffs", "field_diffs"]


def stage_files(diff: DataFrame, summary: DataFrame, keys: list[str], stage: str, tolerance: float, a_label: str = "A", b_label: str = "B") -> DataFrame:
    """The files summary.md, summary.tsv and details.tsv of variants.stage_diff() and stage_summary()."""
    names = [f"{a_label} rows", f"{b_label} rows", "shared rows", f"{a_label}-private rows", f"{b_label}-private rows", "shared rows with field diffs", "field diffs"]
    md = [F.lit(f"# {stage} stage diff"), F.lit(""), F.lit(f"- key columns: `{','.join(keys)}`"), F.lit(f"- numeric tolerance: `{tolerance:g}`"), F.lit(""), F.lit("| metric | value |"), F.lit("|---|---:|"), *(_bar(name, F.col(c).cast("string")) for name, c in zip(names, STAGE_CELLS, strict=True))]
    tsv = [F.lit("\t".join(["stage", *STAGE_CELLS])), F.concat_ws("\t", F.lit(stage), *(F.col(c).cast("string") for c in STAGE_CELLS))]
    head = summary.select(F.lit("details.tsv").alias("file"), F.lit(0).alias("part"), F.lit(0).cast("long").alias("line"), F.lit("category\trow_key\tfield\ta_value\tb_value").alias("value"))
    key = F.concat_ws("|", *keys)
    kinds = F.element_at(F.create_map(*(F.lit(x) for x in ("a_only", "a_private", "b_only", "b_private", "diff", "field_diff"))), F.col("status"))
    body = diff.select(F.lit("details.tsv").alias("file"), F.lit(1).alias("part"), F.lit(0).cast("long").alias("line"), F.concat_ws("\t", kinds, key, "field", "a_value", "b_value").alias("value"))
    return _listed(summary, "summary.md", md).unionAll(_listed(summary, "summary.tsv", tsv)).unionAll(head).unionAll(body).orderBy("file", "part", "line", "value")


def candidate_summary(evidence: DataFrame, given: DataFrame, found: DataFrame, candidate: Column, settings: dict[str, object]) -> DataFrame:
    """metric, value (texts) of a candidate search: settings, then what evidence (depth), input intervals and found intervals (start, end) measure.

    All of it is sums of single passes. Without any found interval the input is used as it is, which used_input_fallback tells.
    """
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    sites = evidence.agg(F.count("*").alias("pileup_sites"), n(F.col("depth") > 0).alias("covered_sites"), F.coalesce(F.sum("depth"), F.lit(0)).alias("_depth"), F.coalesce(F.max("depth"), F.lit(0)).alias("max_filtered_depth"), n(candidate).alias("candidate_sites"))
    spans = lambda df, x: df.agg(F.count("*").alias(f"{x}_intervals"), F.coalesce(F.sum(F.col("end") - F.col("start") + 1), F.lit(0)).alias(f"{x}_bases"))
    row = sites.join(spans(given, "input"), how="full_outer").join(spans(found, "output"), how="full_outer")  # one row each
    fallback = F.col("output_intervals") == 0
    row = row.withColumns({"used_input_fallback": fallback, "output_intervals": F.when(fallback, F.col("input_intervals")).otherwise(F.col("output_intervals")), "output_bases": F.when(fallback, F.col("input_bases")).otherwise(F.col("output_bases"))})
    share = lambda a, b: F.when(F.col(b) == 0, F.lit(0.0)).otherwise(F.col(a) / F.nullif(F.col(b), F.lit(0)))
    saved = F.when(F.col("input_bases") == 0, F.lit(0.0)).otherwise(1 - F.col("output_bases") / F.nullif(F.col("input_bases"), F.lit(0)))
    texts = {c: F.col(c).cast("string") for c in MEASURED if c in row.columns} | {"mean_filtered_depth": F.format_string("%.3f", share("_depth", "covered_sites")), "reduction_fraction": F.format_string("%.6f", saved)}
    cells = [F.struct(F.lit(k).alias("metric"), F.lit(f"{v:.6f}" if isinstance(v, float) else str(v).lower() if isinstance(v, bool) else str(v)).alias("value")) for k, v in settings.items()]
    cells += [F.struct(F.lit(k).alias("metric"), texts[k].alias("value")) for k in MEASURED]
    return row.select(F.inline(F.array(*cells)))
