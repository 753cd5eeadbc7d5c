"""run() against plain Python: lines over all pairs of lines, near-duplicates over all pairs of documents, pieces by the tokenizer.

The line field and the surrogates are taken from their operators, one document at a time; they have tests of their own.
"""

import collections
import os
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociframe.llm import line_dedup, pii, quality_rules

sys.path[:0] = [".", os.path.dirname(__file__)]
from test_corpus import SF, WORDS, _classes, _distance  # noqa: E402

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def without_repeated_lines(rows):
    own = {(d, k): x for d, t in rows if t for k, x in enumerate(t.split("\n")) if x.strip(" \t\n\v\f\r")}
    distinct = sorted(set(own.values()), key=len)
    label = {x: x for x in distinct}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            most = min(2, len(a) // 20)
            if not most or len(b) - len(a) > most:
                break
            if (_distance(a, b) if len(a) < 60 else line_dedup.edit_distance(a, b, most)) <= most:
                label[root(a)] = root(b)
    first = {}
    for at in sorted(own):
        first.setdefault(root(own[at]), at)
    out = []
    for d, t in rows:
        left = [x for k, x in enumerate((t or "").split("\n")) if (d, k) not in own or first[root(own[d, k])] == (d, k)]
        had = any((d, k) in own for k in range(len((t or "").split("\n"))))
        if not had or any(x.strip(" \t\n\v\f\r") for x in left):
            out.append((d, None if t is None else "\n".join(left)))
    return out


def test_run_against_plain_stages(spark, tmp_path):
    from tokenizers import Tokenizer

    d = spark.read.parquet(f"{SF}/documents.parquet").where("text is null or length(text) < 2500")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    # near copies in one line each, too different for line dedup: a word more after every 60
    long = [r["text"].split() for r in d.where("size(split(text, ' ')) between 150 and 400").orderBy("doc_id").limit(12).collect()]
    copies = [(80_000 + 10 * i + k, " ".join(f"{w} zaqo" if k and n % 60 == 30 * k else w for n, w in enumerate(x, 1))) for i, x in enumerate(long) for k in (0, 1)]
    odd = [*copies, (90_001, None), (90_002, ""), (90_003, " \n")]
    d = d.unionByName(spark.createDataFrame([(i, t, "en", "odd", 0) for i, t in odd], d.schema))
    d.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    d = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {r["doc_id"] for r in quality_rules.judge(d, quality_rules.train(d, labels)).where("kept").collect()}
    rows = sorted((r["doc_id"], r["text"]) for r in d.where(F.col("doc_id").isin(list(kept))).collect())
    assert 20 < len(rows) < d.count()
    rows = without_repeated_lines(rows)
    classes = _classes([t for _, t in rows], len(rows))
    single = [r for i, r in enumerate(rows) if classes[i] == i]
    assert len(single) < len(rows)
    hidden = {r["doc_id"]: r["text"] for r in pii.pseudonymize(spark.createDataFrame(single, "doc_id long, text string"), pii.query_key(spark)).collect()}
    t = Tokenizer.from_file(WORDS)
    want = {i: t.encode(x or "", add_special_tokens=False).ids + [1] for i, x in hidden.items()}

    got, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert r["doc_tokens"] == len(want[r["doc_id"]])
    assert set(got) == set(want)
    for i, pieces in got.items():
        at = 0
        for start, length, crc in sorted(pieces):
            assert start == at and crc == zlib.crc32(np.array(want[i][at : at + length], dtype="<u4").tobytes())
            at += length
        assert at == len(want[i])
    for x in sequences.values():
        x.sort()
        assert x[0][0] == 0 and sum(x[-1]) <= 2048 and all(a + n == b for (a, n), (b, _) in zip(x, x[1:], strict=False))
