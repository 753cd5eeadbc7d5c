"""The manifest against a plain build of the trees, with nulls, repeats, one-leaf trees and several strata."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lociframe.llm import merkle

DOC = "doc_id long, text string, lang string, source string, n_chars long, leaf string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], row[1])))


def build(nodes, fan):
    """Layers of a tree, leaves first."""
    layers = [nodes]
    while len(layers[-1]) > 1:
        layers.append([h(*layers[-1][i : i + fan]) for i in range(0, len(layers[-1]), fan)])
    return layers


def siblings(layers, at, fan):
    out = []
    for layer in layers[:-1]:
        first = at // fan * fan
        out.append((layer[first:at], layer[at + 1 : first + fan]))
        at //= fan
    return out


def brute(rows, fan):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[s] = build([leaf_of(r) for r in groups[s]], fan)
    top = build([trees[s][-1][0] for s in names], fan)
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            path = siblings(trees[s], i, fan) + siblings(top, k, fan)
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1] or "")
            digest = leaf_of((r[0], low if changed else r[1], *r[2:]))
            for left, right in path:
                digest = h(*left, digest, *right)
            out.append((r[0], leaf_of(r), trees[s][-1][0], top[-1][0], h(*(x for pair in path for side in pair for x in side)), digest, digest == top[-1][0]))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def rows_of(n, sources, seed=1):
    rng = random.Random(seed)
    return [(rng.choice([i, i, i - 1]), rng.choice(["Ab Ç", "x" * 30, "Once", ""]) + str(i), "en", sources(rng), i, "clash") for i in range(n)]


@pytest.mark.parametrize("n", [1, 16, 17, 300])
def test_one_tree(spark, n):
    rows = rows_of(n, lambda rng: "a")
    assert got(merkle.manifest(spark.createDataFrame(rows, DOC).repartition(3))) == brute(rows, merkle.FAN)


def test_many_trees_with_nulls_and_repeats(spark):
    rows = rows_of(400, lambda rng: rng.choice(["hot"] * 8 + [None, "", "b", "é", "\U0001f600", "ￚ"]))
    rows += [(None, None, None, None, None, None), (5, None, None, "b", None, None), (5, None, None, "b", None, None), (None, "X", "en", "b", 1, None), (7, "LONG " * 200_000, "en", "solo", 1, None)]
    out = got(merkle.manifest(spark.createDataFrame(rows, DOC)))
    assert out == brute(rows, merkle.FAN)
    assert any(not r[-1] for r in out) and all(r[-1] for r in out if r[0] is None)


def test_second_stratum(spark):
    # 5,000 leaves of one source need a second stratum at the true block size
    many = spark.range(5000).select(F.lit("1a").alias("tree"), "id", F.sha2(F.col("id").cast("string"), 256).alias("leaf"), F.lit(None).cast("string").alias("tampered"))
    layers = build([h(str(i)) for i in range(5000)], 16)
    assert len(layers) == 5
    found = {r["doc_id"]: r for r in merkle.prove(many).collect()}
    assert len(found) == 5000 and all(r["verified"] and r["root"] == layers[-1][0] == r["subroot"] for r in found.values())
    for i in (0, 15, 16, 4095, 4096, 4999):
        path = siblings(layers, i, 16)
        assert found[i]["proof_sha256"] == h(*(x for pair in path for side in pair for x in side))


def test_no_rows(spark):
    out = merkle.manifest(spark.createDataFrame([], DOC))
    assert out.collect() == [] and out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
