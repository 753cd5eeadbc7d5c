"""CIGAR strings as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lociframe.functions.sequence import let

OP = r"(\d+)([MIDNSHP=X])"


def ops(cigar: Column) -> Column:
    """'5M2D3M' -> array<struct<len:int,op:string>>; null, empty or '*' gives an empty array."""
    lens = F.transform(F.regexp_extract_all(cigar, F.lit(OP), F.lit(1)), lambda x: x.cast("int"))
    kinds = F.regexp_extract_all(cigar, F.lit(OP), F.lit(2))
    zipped = F.transform(F.arrays_zip(lens.alias("l"), kinds.alias("o")), lambda x: F.struct(x["l"].alias("len"), x["o"].alias("op")))
    return F.coalesce(zipped, F.array().cast("array<struct<len:int,op:string>>"))


def _total(cigar_ops: Column, kinds: str) -> Column:
    return F.aggregate(F.filter(cigar_ops, lambda x: x["op"].isin(*kinds)), F.lit(0), lambda n, x: n + x["len"])


def read_length(cigar_ops: Column) -> Column:
    return _total(cigar_ops, "MIS=X")


def reference_length(cigar_ops: Column) -> Column:
    return _total(cigar_ops, "MDN=X")


def span(cigar_ops: Column) -> Column:
    """Reference span, one at least."""
    return F.greatest(F.lit(1), reference_length(cigar_ops))


def leading_clips(cigar_ops: Column) -> Column:
    """Soft and hard clips before the first other operation."""
    state = F.aggregate(
        cigar_ops,
        F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")),
        lambda s, x: F.struct((s["n"] + F.when(s["on"] & x["op"].isin("S", "H"), x["len"]).otherwise(0)).alias("n"), (s["on"] & x["op"].isin("S", "H")).alias("on")),
    )
    return state["n"]


def trailing_clips(cigar_ops: Column) -> Column:
    return leading_clips(F.reverse(cigar_ops))


def has_op(cigar_ops: Column, kinds: str) -> Column:
    return F.exists(cigar_ops, lambda x: x["op"].isin(*kinds))


def unclipped_five_prime(pos0: Column, cigar_ops: Column, reverse: Column) -> Column:
    """1-based 5' end before clipping: forward from the left, reverse from the right end."""
    left = pos0 - leading_clips(cigar_ops) + 1
    right = pos0 + reference_length(cigar_ops) + trailing_clips(cigar_ops)
    return F.when(reverse, right).otherwise(left)


def segments(cigar_ops: Column) -> Column:
    """Walk: array<struct<op,len,q0,r0,next_op,next_len>>, q0 and r0 the read and reference offsets where the operation starts."""
    return let(cigar_ops, _walk)


def _walk(cigar_ops: Column) -> Column:
    empty = F.array().cast("array<struct<op:string,len:int,q0:int,r0:int,next_op:string,next_len:int>>")

    def step(s: Column, x: Column) -> Column:
        after = F.get(cigar_ops, F.size(s["out"]) + 1)
        row = F.struct(x["op"].alias("op"), x["len"].alias("len"), s["q"].alias("q0"), s["r"].alias("r0"), after["op"].alias("next_op"), after["len"].alias("next_len"))
        return F.struct(
            F.array_append(s["out"], row).alias("out"),
            (s["q"] + F.when(x["op"].isin(*"MIS=X"), x["len"]).otherwise(0)).alias("q"),
            (s["r"] + F.when(x["op"].isin(*"MDN=X"), x["len"]).otherwise(0)).alias("r"),
        )

    return F.aggregate(cigar_ops, F.struct(empty.alias("out"), F.lit(0).alias("q"), F.lit(0).alias("r")), step, lambda s: s["out"])


def text(cigar_ops: Column) -> Column:
    return F.array_join(F.transform(cigar_ops, lambda x: F.concat(x["len"].cast("string"), x["op"])), "")


def clipped_left(cigar_ops: Column, bases: Column) -> Column:
    """struct(ops, moved): the first `bases` read bases as a soft clip, behind hard clips; moved is how far the position goes right.

    Deletions and skips inside or right behind the clip go.
    """
    kind = "array<struct<len:int,op:string>>"
    hard = F.filter(F.slice(cigar_ops, 1, 1), lambda x: x["op"] == "H")
    body = F.slice(cigar_ops, F.size(hard) + 1, F.greatest(F.size(cigar_ops), F.lit(1)))

    def step(s: Column, x: Column) -> Column:
        reads, refs = x["op"].isin(*"MIS=X"), x["op"].isin(*"MDN=X")
        taken = F.when(reads, F.least(s["left"], x["len"])).when(refs & ~s["on"], x["len"]).otherwise(0)
        rest = F.struct((x["len"] - taken).alias("len"), x["op"].alias("op"))
        return F.struct(
            F.when(x["len"] > taken, F.array_append(s["ops"], rest)).otherwise(s["ops"]).alias("ops"),
            (s["left"] - F.when(reads, taken).otherwise(0)).alias("left"),
            (s["moved"] + F.when(refs, taken).otherwise(0)).alias("moved"),
            (s["on"] | (reads & (x["len"] > taken))).alias("on"),
        )

    start = F.struct(F.array().cast(kind).alias("ops"), bases.cast("int").alias("left"), F.lit(0).alias("moved"), F.lit(False).alias("on"))
    clip = F.array(F.struct(bases.cast("int").alias("len"), F.lit("S").alias("op")))
    return F.aggregate(body, start, step, lambda s: F.struct(F.concat(hard, clip, s["ops"]).cast(kind).alias("ops"), s["moved"].alias("moved")))


def skips(cigar_ops: Column) -> Column:
    """array<struct<start,end>>: the reference offsets between the last aligned base before a skip and the first behind it."""
    walk = F.aggregate(
        segments(cigar_ops),
        F.struct(F.array().cast("array<struct<start:int,end:int>>").alias("out"), F.lit(None).cast("int").alias("stop"), F.lit(False).alias("gap")),
        lambda s, x: F.when(x["op"] == "N", F.struct(s["out"].alias("out"), s["stop"].alias("stop"), s["stop"].isNotNull().alias("gap")))
        .when(
            x["op"].isin(*"M=X"),
            F.struct(
                F.when(s["gap"], F.array_append(s["out"], F.struct(s["stop"].alias("start"), (x["r0"] - 1).alias("end")))).otherwise(s["out"]).alias("out"),
                (x["r0"] + x["len"]).alias("stop"),
                F.lit(False).alias("gap"),
            ),
        )
        .otherwise(s),
        lambda s: s["out"],
    )
    return walk


def _joined(parts: Column) -> Column:
    """Adjacent equal operations joined, empty ones dropped: array<struct<len,op>>."""

    def step(s: Column, x: Column) -> Column:
        last, rest = F.get(s, F.size(s) - 1), F.slice(s, F.lit(1), F.greatest(F.size(s) - 1, F.lit(0)))
        more = F.struct((last["len"] + x["len"]).alias("len"), x["op"].alias("op"))
        return F.when(x["len"] == 0, s).when(F.coalesce(last["op"] == x["op"], F.lit(False)), F.array_append(rest, more)).otherwise(F.array_append(s, x))

    return F.aggregate(parts, F.array().cast("array<struct<len:int,op:string>>"), step)


def sections(cigar: Column) -> Column:
    """array<struct<cigar,offset>>: each exon section of a spliced alignment and its reference offset; the whole CIGAR at 0 if it is not to be split.

    Bases of other sections become soft clips and the outer hard clips stay; a deletion at a section's edge goes, and a section of
    deletions alone is an error. Without a section of aligned, inserted or deleted bases before some N nothing is split.
    """
    whole = F.array(F.struct(cigar.alias("cigar"), F.lit(0).alias("offset")))
    real = lambda items: F.exists(items, lambda x: x["op"].isin(*"M=XID"))
    of = lambda n, op: F.struct(n.cast("int").alias("len"), F.lit(op).alias("op"))

    def walked(segs: Column) -> Column:
        skipped = F.filter(F.transform(segs, lambda x, i: F.when(x["op"] == "N", i)), lambda i: i.isNotNull())
        edges = F.concat(F.array(F.lit(-1)), skipped, F.array(F.size(segs)))
        return F.transform(F.slice(edges, F.lit(2), F.size(edges)), lambda stop, k: F.slice(segs, F.get(edges, k) + 2, stop - F.get(edges, k) - 1))

    def split(x: Column) -> Column:
        segs, parts = x["segs"], x["parts"]
        first, last = F.get(segs, F.lit(0)), F.get(segs, F.size(segs) - 1)
        head = F.when(first["op"] == "H", first["len"]).otherwise(0)
        tail = F.when((last["op"] == "H") & (F.size(segs) > 1), last["len"]).otherwise(0)

        def one(items: Column) -> Column:
            core = F.filter(items, lambda y: ~y["op"].isin(*"SDH"))
            begin, final = F.get(core, F.lit(0)), F.get(core, F.size(core) - 1)
            stop = final["r0"] + F.when(final["op"].isin(*"M=X"), final["len"]).otherwise(0)
            kept = F.filter(items, lambda y: (y["op"] != "H") & ((y["op"] != "D") | ((y["r0"] >= begin["r0"]) & (y["r0"] < stop))))
            body = F.transform(kept, lambda y: F.struct(y["len"].alias("len"), y["op"].alias("op")))
            end = F.get(items, F.size(items) - 1)
            after = read_length(segs) - end["q0"] - F.when(end["op"].isin(*"MIS=X"), end["len"]).otherwise(0)
            parts = F.concat(F.array(of(head, "H"), of(F.get(items, F.lit(0))["q0"], "S")), body, F.array(of(after, "S"), of(tail, "H")))
            bad = F.raise_error(F.concat(F.lit("a section holds deletions only: "), cigar))
            return F.struct(F.when(F.size(core) == 0, bad.cast("string")).otherwise(text(_joined(parts))).alias("cigar"), begin["r0"].alias("offset"))

        good = F.exists(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), real)
        return F.when(good, F.transform(F.filter(parts, real), one)).otherwise(whole)

    return let(let(segments(ops(cigar)), lambda s: F.struct(s.alias("segs"), walked(s).alias("parts"))), split)
