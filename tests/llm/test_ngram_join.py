"""The join against all pairs."""

import random
import re

import numpy as np
import pytest

from lociframe.llm import ngram_join

DOC = "doc_id long, text string, key string, n long"


def tokens(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def brute(rows):
    sets = [tokens(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), least.get(find(i))) for i, r in enumerate(rows)), key=str)


def got(spark, rows, parts=3):
    return sorted((tuple(r) for r in ngram_join.components(spark.createDataFrame(rows, DOC).repartition(parts)).collect()), key=str)


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.random()
        if kind < 0.4:
            out[at] = f"w{rng.randrange(60)}"
        elif kind < 0.7:
            del out[at]
        else:
            out.insert(at, f"w{rng.randrange(60)}")
    return out


def corpus(seed, groups=6, copies=12, vocabulary=40):
    """Groups of near copies whose similarities lie around the threshold, chains of copies, short texts and a shared passage."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for _ in range(groups):
        base = [f"w{rng.randrange(vocabulary)}" for _ in range(rng.choice([3, 9, 11, 12, 20, 60, 200, 400]))]
        if rng.random() < 0.4:
            base += passage
        last = base
        for _ in range(copies):
            source = rng.choice([base, last])
            last = edited(rng, source, rng.choice([0, 0, 1, 1, 2, 3, 5]) if len(source) > 12 else rng.choice([0, 1]))
            rows.append((len(rows), rng.choice([" ", "\n", "\t "]).join(last).replace("w1", rng.choice(["w1", "W1"])), "clash", 1))
    return rows


@pytest.mark.parametrize("seed", range(6))
def test_against_all_pairs(spark, seed):
    rows = corpus(seed)
    assert got(spark, rows) == brute(rows)


def test_large_bucket_of_chains(spark):
    """More sets than SPLIT around one, of which many are similar to others only."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    rows, ends = [(0, " ".join(base), None, None)], [base]
    while len(rows) < 3 * ngram_join.SPLIT:
        words = edited(rng, rng.choice(ends), rng.choice([1, 2, 3, 4]))
        ends.append(words)
        rows.append((len(rows), " ".join(words), None, None))
    expected = brute(rows)
    assert 3 < len({r[2] for r in expected}) < len(rows) - 20
    assert got(spark, rows) == expected


def test_signatures_share_one_for_every_similar_pair():
    """Sets at the threshold, all orders of frequency, from rare alone to frequent alone."""
    rng = np.random.default_rng(12)
    for turn in range(400):
        n = int(rng.integers(9, 600))
        pool = rng.permutation(4 * n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        df_of = dict(zip(pool.tolist(), rng.choice([1, 2, 20, 33, 1000] if turn % 2 else [40, 50], len(pool)).tolist(), strict=True))
        x = set(pool[:n].tolist())
        y = set(x)
        for t in pool[n:].tolist():
            z = set(y)
            if rng.random() < 0.5 and len(z) > 9:
                z.discard(sorted(z)[int(rng.integers(len(z)))])
            if rng.random() < 0.7:
                z.add(t)
            both = len(x & z)
            if 100 * both < 90 * (len(x) + len(z) - both):
                break
            y = z
        if x == y:
            continue
        signed = []
        for s in (x, y):
            own = sorted((max(2, df_of[t]) if t in x and t in y else df_of[t], np.uint64(t).astype(np.int64).item()) for t in s)
            own = [p for p in own if p[0] > 1]
            with np.errstate(over="ignore"):
                signed.append(set(ngram_join.signatures(len(s), np.array([p[0] for p in own]), np.array([p[1] for p in own], dtype=np.int64).view(np.uint64)).tolist()))
        assert signed[0] & signed[1], (turn, len(x), len(y))


def test_defined_cases(spark):
    long = " ".join(f"t{i}" for i in range(30_000))
    rows = [(1, None, None, None), (2, "", None, None), (3, " \n\t", None, None), (4, "One two", None, None), (5, "one  TWO", None, None), (6, "one two three", None, None), (7, "É", None, None), (8, "é", None, None)]
    rows += [(9, long, None, None), (10, long + " end", None, None), (11, long.replace("t2", "s2"), None, None), (None, "a b c d", None, None), (None, "A b c d", None, None), (9, "a b c d", None, None), (6, "one two three", None, None)]
    rows += [(None, "nothing else has this text", None, None), (20, "x y z " * 4, None, None), (21, "x y z " * 9, None, None)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, rows[:0]) == []
    assert got(spark, [(i, "the same few words", None, None) for i in range(50)]) == [(i, 2, 0) for i in sorted(range(50), key=str)]


def test_shuffled_survivors_and_low_similarities(spark, monkeypatch):
    rows = corpus(7)
    monkeypatch.setattr(ngram_join, "SENT_ROWS", 0)
    assert got(spark, rows) == brute(rows)
    with pytest.raises(ValueError, match="0.8"):
        ngram_join.components(spark.createDataFrame(rows, DOC), similar=(100, 79))
