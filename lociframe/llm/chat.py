r"""Chat formatting with typed content parts, as DataFrame expressions only.

A turn holds an array of parts (text, image, audio, document). flatten() visits the parts in
order: text is escaped, any other part becomes a placeholder such as `[IMG:2]`, where 2 is the part's
place in its turn; what it refers to and the number of tokens that it expands to are recorded.
format_conversations() then writes each turn as

    <s>role[INST]content[/INST]</s>      for user, system and other roles
    <s>role[OUT]content[/OUT]</s>        for the assistant, whose content is under the loss mask

Control strings inside roles and texts are escaped reversibly: a backslash is put before their last
character, after any backslashes that stand there already: `</s>` becomes `</s\>`.
So no text can end its turn, and read_back() restores every text exactly.

Defined cases: null role or text counts as empty; turns that tie are ordered by role, then text; a null turn
number sorts first; rows that repeat are turns of their own; a null conv_id is one conversation;
an empty table gives no rows; columns beyond those named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
ASSISTANT = "assistant"
_HEAD = r"(</?s|\[/?(?:INST|OUT)|\[(?:IMG|AUD|DOC):\d*)"
_TAIL = r"(\\*)([>\]])"
_TURN = r"(?s)<s>(.*?)\[(INST|OUT)\](.*?)\[/\2\]</s>"
_MARKS = {"image": "IMG", "audio": "AUD", "document": "DOC"}


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _HEAD + _TAIL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _HEAD + r"\\" + _TAIL, "$1$2$3")


def text_part(text: Column) -> Column:
    """One text as an array of parts."""
    null = F.lit(None)
    part = F.struct(F.lit("text").alias("kind"), text.alias("text"), null.cast("string").alias("ref"), null.cast("int").alias("width"), null.cast("int").alias("height"), null.cast("double").alias("seconds"), null.cast("int").alias("pages"))
    return F.array(part)


def expanded_tokens(part: Column, patch: int = 28, audio_rate: float = 25.0, page_tokens: int = 512) -> Column:
    """Tokens that a part other than text stands for: patches of an image, frames of audio, pages of a document; one at least."""
    side = lambda n: F.ceil(F.coalesce(n, F.lit(1)) / F.lit(patch))
    n = (
        F.when(part["kind"] == "image", side(part["width"]) * side(part["height"]))
        .when(part["kind"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * audio_rate))
        .when(part["kind"] == "document", F.coalesce(part["pages"], F.lit(1)).cast("long") * page_tokens)
    )
    return F.greatest(F.coalesce(n, F.lit(1)), F.lit(1)).cast("long")


def flatten(parts: Column) -> Column:
    """parts -> struct(content, attachments array<struct(place, kind, ref, tokens)>). Null parts and unknown kinds without text add nothing.

    Neighbouring texts are joined before they are escaped, so a control string cut across parts is escaped too.
    """
    parts = F.coalesce(parts, F.array().cast(PART))
    mark = lambda p: F.coalesce(*[F.when(p["kind"] == k, F.lit(v)) for k, v in _MARKS.items()])

    def shown(p: Column, i: Column) -> Column:
        m = mark(p)
        return F.struct(F.concat(F.lit("["), m, F.lit(":"), i.cast("string"), F.lit("]")).alias("mark"), F.when(m.isNull(), F.coalesce(p["text"], F.lit(""))).otherwise("").alias("text"))

    def add(done: Column, s: Column) -> Column:
        run = F.concat(done["run"], s["text"])
        grown = F.struct(done["out"].alias("out"), run.alias("run"))
        return F.when(s["mark"].isNull(), grown).otherwise(F.struct(F.concat(done["out"], escape(done["run"]), s["mark"]).alias("out"), F.lit("").alias("run")))

    start = F.struct(F.lit("").alias("out"), F.lit("").alias("run"))
    content = F.aggregate(F.transform(parts, shown), start, add, lambda d: F.concat(d["out"], escape(d["run"])))
    placed = F.transform(parts, lambda p, i: F.struct(i.cast("int").alias("place"), p["kind"].alias("kind"), p["ref"].alias("ref"), expanded_tokens(p).alias("tokens")))
    return F.struct(content.alias("content"), F.filter(placed, lambda a: a["kind"].isin(*_MARKS)).alias("attachments"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, parts) -> one row per conversation: formatted, attachments with their turn's number from 0, attachment_tokens."""
    role = F.coalesce(F.col("role"), F.lit(""))
    flat = turns.select("conv_id", F.struct("turn", role.alias("role"), flatten(F.col("parts")).alias("flat")).alias("t"))
    rows = flat.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    kind = lambda t: F.when(t["role"] == ASSISTANT, F.lit("OUT")).otherwise(F.lit("INST"))
    shown = F.transform("turns", lambda t: F.concat(F.lit("<s>"), escape(t["role"]), F.lit("["), kind(t), F.lit("]"), t["flat"]["content"], F.lit("[/"), kind(t), F.lit("]</s>")))
    seen = F.flatten(F.transform("turns", lambda t, i: F.transform(t["flat"]["attachments"], lambda a: F.struct(i.cast("int").alias("turn"), a["place"].alias("place"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))))
    out = rows.select("conv_id", F.array_join(shown, "").alias("formatted"), seen.alias("attachments"))
    return out.withColumn("attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]))


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse `formatted` alone: adds turns array<struct(role, text)> and loss_text, what is under the loss mask, unescaped."""
    found = [F.regexp_extract_all("formatted", F.lit(_TURN), F.lit(k)) for k in (1, 2, 3)]
    zipped = F.transform(F.arrays_zip(*[x.alias(n) for x, n in zip(found, "rkt", strict=True)]), lambda t: F.struct(unescape(t["r"]).alias("role"), (t["k"] == "OUT").alias("loss"), unescape(t["t"]).alias("text")))
    out = formatted.withColumn("turns", zipped)
    return out.withColumn("loss_text", F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), ""))


def digests(read: DataFrame) -> DataFrame:
    """Counts and digests of what read_back() found."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"),
        "attachment_tokens",
    )
