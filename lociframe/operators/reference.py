"""Reference sequence as a table of overlapping bins, from FASTA lines; lookups by bin; left-normalised indels.

Lines come with their offsets (`sources.blocks.read_lines`). The contig of a line is the last header before it, its place the
running length of the contig's lines, both by windows in bins of offsets whose outcome is carried on, so a chromosome is
the work of many tasks. A bin holds its bases and `overlap` more, so whatever lies within `overlap` bases is one join away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociframe.operators.intervals import running

SIZE, OVERLAP = 4096, 512


def placed(lines: DataFrame) -> DataFrame:
    """FASTA lines (path, offset, value) -> contig, contig_at (the header's offset), offset, start 0-based, bases upper-case.

    The contig's name ends at the first white space; blank lines count nothing; bases before any header are an error.
    """
    name = F.regexp_extract("value", r"^>\s*(\S*)", 1)
    mark = F.when(F.col("value").startswith(">"), F.struct(F.col("offset").alias("at"), name.alias("contig")))
    # a header comes before bases that are said to lie at its very offset
    rows = lines.select("path", "offset", "value", (~F.col("value").startswith(">")).alias("_body"))
    marked = running(rows, ("path",), ("offset", "_body"), mark, F.max, "mark")
    body = marked.where(~F.col("value").startswith(">")).select("path", "offset", "mark", F.upper(F.regexp_replace("value", r"\s", "")).alias("bases")).where("bases <> ''")
    at = F.coalesce("mark.at", F.raise_error(F.concat(F.lit("bases before a header: "), "path")).cast("long"))
    body = body.select("path", F.col("mark.contig").alias("contig"), at.alias("contig_at"), "offset", "bases")
    ends = running(body, ("path", "contig_at"), ("offset",), F.length("bases").cast("long"), F.sum, "end")
    return ends.select("contig", "path", "contig_at", "offset", (F.col("end") - F.length("bases")).alias("start"), "bases")


def index(lines: DataFrame) -> DataFrame:
    """contig, length, offset of its first line, line_bases: what a FASTA index lists, and with contig_at the dictionary's order."""
    rows = placed(lines)
    return rows.groupBy("path", "contig", "contig_at").agg(F.sum(F.length("bases").cast("long")).alias("length"), F.min("offset").alias("offset"), F.min_by(F.length("bases"), "offset").alias("line_bases")).drop("path")


def bins(lines: DataFrame, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """FASTA lines -> contig, bin, start 0-based, bases: bases from bin * size on, size + overlap of them at most."""
    rows, n = placed(lines), F.length("bases")
    first = F.greatest(F.lit(0), F.floor((F.col("start") - overlap) / size)).cast("long")
    each = rows.select("contig", "start", "bases", F.explode(F.sequence(first, F.floor((F.col("start") + n - 1) / size).cast("long"))).alias("bin"))
    low = F.greatest(F.col("start"), F.col("bin") * size)
    high = F.least(F.col("start") + n, F.col("bin") * size + size + overlap)
    part = F.substring("bases", (low - F.col("start") + 1).cast("int"), (high - low).cast("int"))
    cut = each.where(high > low).select("contig", "bin", F.struct(low.alias("at"), part.alias("bases")).alias("part"))
    whole = cut.groupBy("contig", "bin").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    # size + overlap bases of one bin, from as many lines
    made = whole.select("contig", "bin", (F.col("bin") * size).alias("start"), F.array_join("parts.bases", "").alias("bases"))
    return made.where((F.col("bin") == 0) | (F.length("bases") > 0))


def with_bases(df: DataFrame, table: DataFrame, start: Column, end: Column, name: str = "ref_bases", size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """Adds the reference's bases from start to end (1-based, inclusive) as text, shorter where the contig ends, null off any contig.

    One equi join on (contig, bin). A span over `overlap` bases is an error: make bins with more overlap, or look up its pieces.
    """
    rows = df.withColumns({"_from": F.greatest(start, F.lit(1)).cast("long"), "_to": end.cast("long")}).withColumn("_bin", F.floor((F.col("_from") - 1) / size).cast("long"))
    other = table.select(F.col("contig").alias("_contig"), F.col("bin").alias("_b"), F.col("start").alias("_s"), F.col("bases").alias("_bases"))
    both = rows.join(other, (F.col("contig") == F.col("_contig")) & (F.col("_bin") == F.col("_b")), "left")
    n = F.col("_to") - F.col("_from") + 1
    fits = F.when(n > overlap, F.raise_error(F.lit(f"a span of more than {overlap} bases")).cast("string"))
    found = F.coalesce(fits, F.substring("_bases", (F.col("_from") - F.col("_s")).cast("int"), F.greatest(n, F.lit(0)).cast("int")))
    return both.withColumn(name, found).drop("_from", "_to", "_bin", "_contig", "_b", "_s", "_bases")


def _common(a: Column, b: Column, most: Column) -> Column:
    """Length of the common start of two texts, `most` at most."""
    same = F.transform(F.sequence(F.lit(1), F.greatest(most, F.lit(1))), lambda i: (i <= most) & (F.substring(a, i, F.lit(1)) == F.substring(b, i, F.lit(1))))
    first = F.array_position(same, False)
    return F.when(first > 0, first - 1).otherwise(F.greatest(most, F.lit(0))).cast("int")


def left_normalize(calls: DataFrame, table: DataFrame, reach: int = 200, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """Calls (contig, pos, ref, alt) with indels trimmed and moved as far left as the bases allow; adds open.

    Alleles of equal length stay. Others lose their common end, then their common start, one base of each left; then as long as
    both end in the same base, the base before them leads both and the last one goes. That is a fold over
    the `reach` bases to the left, which stops at a base outside A, C, G, T. open: it would go on beyond them; such
    rows can be put in once more. No contig, or one without bases, moves nothing.
    """
    ref, alt = F.col("ref"), F.col("alt")
    shorter = F.least(F.length("ref"), F.length("alt"))
    tail = _common(F.reverse("ref"), F.reverse("alt"), shorter - 1)
    rows = calls.withColumns({"_same": F.length("ref") == F.length("alt"), "_tail": tail})
    rows = rows.withColumns({"_r": F.substring(ref, F.lit(1), F.length("ref") - F.col("_tail")), "_a": F.substring(alt, F.lit(1), F.length("alt") - F.col("_tail"))})
    rows = rows.withColumn("_head", _common(F.col("_r"), F.col("_a"), F.least(F.length("_r"), F.length("_a")) - 1))
    rows = rows.withColumns({"_r": F.substring("_r", F.col("_head") + 1, F.length("_r")), "_a": F.substring("_a", F.col("_head") + 1, F.length("_a")), "_p": F.col("pos") + F.col("_head")})
    near = with_bases(rows, table, F.col("_p") - reach, F.col("_p") - 1, "_left", size, overlap)

    def step(s: Column, base: Column) -> Column:
        go = s["on"] & (F.right(s["r"], F.lit(1)) == F.right(s["a"], F.lit(1))) & base.isin(*"ACGT")
        moved = lambda x: F.concat(base, F.substring(x, F.lit(1), F.length(x) - 1))
        return F.struct(F.when(go, moved(s["r"])).otherwise(s["r"]).alias("r"), F.when(go, moved(s["a"])).otherwise(s["a"]).alias("a"), F.when(go, s["n"] + 1).otherwise(s["n"]).alias("n"), go.alias("on"))

    start = F.struct(F.col("_r").alias("r"), F.col("_a").alias("a"), F.lit(0).alias("n"), F.lit(True).alias("on"))
    bases = F.filter(F.split(F.reverse(F.coalesce("_left", F.lit(""))), ""), lambda x: x != "")
    done = near.withColumn("_d", F.when(~F.col("_same"), F.aggregate(bases, start, step)))
    is_open = F.coalesce(F.col("_d.on") & (F.size(bases) == reach) & (F.right("_d.r", F.lit(1)) == F.right("_d.a", F.lit(1))), F.lit(False))
    changed = {"pos": F.when(F.col("_same"), F.col("pos")).otherwise(F.col("_p") - F.col("_d.n")), "ref": F.coalesce("_d.r", "ref"), "alt": F.coalesce("_d.a", "alt"), "open": is_open}
    return done.withColumns(changed).select(*calls.columns, "open")
