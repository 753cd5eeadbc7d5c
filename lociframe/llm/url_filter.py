"""URL filtering by mined association rules, as DataFrame and Spark ML operations only.

FP-growth mines token combinations of labelled urls that go with a bad label; rules pruned by support and
confidence match all urls through an inverted index: each rule is filed under its rarest token, a url
probes only the rules filed under its own tokens, and a rule holds if the url has all of its tokens.
Rules written by hand (host and path prefix, longest wins) stand above the mined ones.

Defined cases: a null url, or one without `://`, has empty host and path and no tokens, so no mined rule
fits it; labels go by doc_id = page_id; equal urls get equal verdicts and keep their rows; labels without a row among the urls are ignored, null
labels count as good; a url that repeats among labelled rows counts as often, and its tokens, however many, are one class; with no labelled url at all nothing is mined and every url is allowed; other columns pass unread.
"""

from __future__ import annotations

import math
import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociframe.llm import shared

BLOCK_ITEM = "label=block"
#: (verdict, host, path)
HAND_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z lower-cased, and path; both empty for a null url or one without `://`."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, pattern, k), F.lit("")) for k in (1, 2))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def tokens(url: Column) -> Column:
    """Distinct tokens of a url: labels of the host, its last two labels together, path segments, file ending, names in the query."""
    host, path = url_parts(url)
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1)
    names = F.regexp_extract_all(F.coalesce(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit("")), F.lit(r"(?:^|&)([^=&]+)="), F.lit(1))
    tag = lambda mark, xs: F.transform(xs, lambda x: F.concat(F.lit(mark), x))
    return F.array_distinct(
        F.concat(
            tag("h:", labels),
            tag("d:", F.when(F.size(labels) >= 2, F.array(F.array_join(F.slice(labels, -2, 2), "."))).otherwise(F.array().cast("array<string>"))),
            tag("p:", segments),
            tag("e:", F.filter(F.array(ending), lambda x: x != "")),
            tag("q:", names),
        )
    )


def mine(labelled: DataFrame, min_support: float = 0.002, min_confidence: float = 0.5, min_rows: int = 5) -> tuple[DataFrame, DataFrame]:
    """(items array, blocked boolean) -> rules (antecedent array, index_token, confidence, support), minimal ones only, and classes (token, item).

    A combination counts from min_rows rows on, however few rows there are. Tokens that lie in the very same rows are one
    class, and rules name each class by its least token: a rule stands for all choices of one token of each of its
    classes. So a long url that comes again and again is one item, not all subsets of its tokens. Classes that are rules by themselves
    are not mined further, as a rule is dropped if there is one on a subset of its classes: whatever it fits, the shorter one fits.
    """
    rows = shared.cut(labelled.select("items", "blocked").withColumn("row", F.monotonically_increasing_id()), "url-rows")
    total = rows.count()
    support = min(1.0, max(min_support, min_rows / max(1, total)))
    least = max(1, math.ceil(support * total))
    one = rows.select("row", "blocked", F.explode("items").alias("token"))
    marks = (F.sum(F.xxhash64("row").cast("decimal(38,0)")).alias("sum"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("mix"))
    seen = one.groupBy("token").agg(F.count("*").alias("freq"), F.sum(F.col("blocked").cast("long")).alias("bad"), *marks).where(F.col("bad") >= least)
    named = seen.groupBy("freq", "bad", "sum", "mix").agg(F.min("token").alias("item"), F.collect_list("token").alias("token"))
    sure = F.col("bad") >= min_confidence * F.col("freq")
    classes = shared.cut(named.select(F.explode("token").alias("token"), "item", "freq", "bad", sure.alias("sure")), "url-classes")
    items = classes.where("token = item")
    # a class that is sure, or too rare to matter, leaves the rows
    mixed = one.join(classes.where("token = item and not sure").select("token"), "token").groupBy("row", "blocked").agg(F.collect_list("token").alias("items"))
    marked = mixed.select(F.when(F.col("blocked"), F.array_append("items", BLOCK_ITEM)).otherwise(F.col("items")).alias("items"))
    n_mixed = max(1, mixed.count())
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / n_mixed), minConfidence=min_confidence).fit(marked)
    found = model.associationRules.where(F.col("consequent") == F.array(F.lit(BLOCK_ITEM)))
    found = found.select(F.array_sort("antecedent").alias("antecedent"), "confidence", (F.col("support") * n_mixed / total).alias("support"))
    single = items.where("sure").select(F.array("item").alias("antecedent"), (F.col("bad") / F.col("freq")).alias("confidence"), (F.col("bad") / total).alias("support"))
    rules = shared.cut(found.where(F.size("antecedent") > 0).unionAll(single), "url-rules")
    # all proper subsets of a rule, by the bits of a number; FP-growth has listed as many sets already
    bits = F.expr("sequence(1L, shiftleft(1L, size(antecedent)) - 2)")
    parts = rules.where(F.size("antecedent") > 1).select(F.col("antecedent").alias("whole"), F.explode(bits).alias("bits"))
    parts = parts.select("whole", F.expr("filter(whole, (x, i) -> getbit(bits, i) = 1)").alias("antecedent"))
    covered = parts.join(rules.select("antecedent"), "antecedent").select(F.col("whole").alias("antecedent")).distinct()
    minimal = rules.join(covered, "antecedent", "left_anti")
    rarest = minimal.select("antecedent", F.explode("antecedent").alias("item")).join(items.select("item", "freq"), "item").groupBy("antecedent").agg(F.min_by("item", F.struct("freq", "item")).alias("index_token"))
    return minimal.join(rarest, "antecedent"), classes.select("token", "item")


def matched_urls(urls: DataFrame, rules: DataFrame, classes: DataFrame) -> DataFrame:
    """Distinct urls that some mined rule fits."""
    one = urls.where(F.col("url").isNotNull()).select("url").distinct().select("url", F.explode(tokens(F.col("url"))).alias("token"))
    probes = one.join(classes, "token").groupBy("url").agg(F.collect_set("item").alias("items")).select("url", "items", F.explode("items").alias("index_token"))
    hits = probes.join(rules.select("index_token", "antecedent"), "index_token").where(F.size(F.array_except("antecedent", "items")) == 0)
    return hits.select("url").distinct()


def hand_rule(host: Column, path: Column, rules=HAND_RULES) -> Column:
    """struct(len, rule, verdict) of the longest rule that fits, else null. The rules are a parameter of bounded length."""
    fits = [F.when(((host == h) | host.endswith(f".{h}")) & path.startswith(p), F.struct(F.lit(len(h + p)).alias("len"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for v, h, p in rules]
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<len:int,rule:string,verdict:string>")


def judge(pages: DataFrame, labels: DataFrame, rules=HAND_RULES, min_support: float = 0.002, min_confidence: float = 0.5) -> DataFrame:
    """pages (page_id, url), labels (doc_id, quality, toxic) -> page_id, host, path, rule, verdict, mined."""
    bad = labels.groupBy(F.col("doc_id").alias("page_id")).agg(F.max(F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.lit(False))).alias("blocked"))
    labelled = pages.select("page_id", "url").join(bad, "page_id").select(tokens(F.col("url")).alias("items"), "blocked").where(F.size("items") > 0)
    mined = matched_urls(pages, *mine(labelled, min_support, min_confidence)).withColumn("mined", F.lit(True))
    host, path = url_parts(F.col("url"))
    best = hand_rule(F.col("host"), F.col("path"), rules)
    out = pages.select("page_id", "url", host.alias("host"), path.alias("path")).join(mined, "url", "left")
    out = out.select("page_id", "host", "path", best.alias("best"), F.coalesce("mined", F.lit(False)).alias("mined"))
    return out.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.when(F.col("mined"), "block").otherwise("allow")).alias("verdict"), "mined")
