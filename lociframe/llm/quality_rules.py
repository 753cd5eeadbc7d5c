"""Quality rules: base rules on words and repeats, then a linear-chain conditional random field over lines.

The field labels each line of a document as content or boilerplate by Viterbi decoding; the share of characters in
content lines decides. It is trained here, by gradient ascent on the likelihood of line labels, on a bounded sample of
labelled documents, of which every line counts. Line labels are latent: they start as their document's label (quality 1: content,
0: boilerplate); then the field decodes each document, its path becomes the labels where its content share agrees
with the document's label, and the field is fitted again. So documents that mix content and boilerplate teach changes of label.

Base counts, on words `[^\\x20\\x09-\\x0D]+` of the whole text, are those of the query's contract; see base_counts().

Defined cases: a null or empty text has no words and fails the base rules; with no labelled documents every line counts as
content; a doc_id that repeats keeps a row for each of its rows; texts of any length are read in full; an empty table gives no
rows; other columns are ignored by judge() and kept by keep().
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociframe.llm import shared

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIN_CONTENT_SHARE = 0.5
#: The bound on the training sample: documents of each label, by hash of doc_id.
TRAIN_DOCS = 1000
#: Training cuts a document's lines into chains of that length, all of which count.
CHAIN_LINES = 48
RELABELS = 2

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_START = (np.arange(256) & 0xC0) != 0x80  # first bytes of code points
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER, _LOWER, _DIGIT, _PUNCT = (np.isin(np.arange(256), list(x)) for x in (range(65, 91), range(97, 123), range(48, 58), b"!?.,;:()[]{}\"'-_=+/\\~^@`"))
_WEIGHTS = np.stack([x.astype(np.int32) for x in (_START, _START & ~_SPACE, _SYMBOL, _UPPER, _LOWER, _DIGIT, _PUNCT, _SPACE)])
#: Odd multipliers that mix five word hashes into one.
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], dtype=np.uint64)
_EDGES = (
    (8, 20, 40, 80, 160, 320, 640),  # code points
    (0.05, 0.15, 0.3, 0.6),  # upper case of letters
    (0.005, 0.02, 0.05, 0.1),  # symbols
    (0.02, 0.1, 0.3),  # digits
    (0.02, 0.05, 0.08, 0.15),  # punctuation
    (2.5, 3.5, 4.5, 5.5, 7.0, 9.0),  # code points a word
    (0.01, 0.1, 0.3, 0.6),  # words equal to the word before
    (0.5,),  # equal to an earlier line
)
N_FEATURES = sum(len(e) + 1 for e in _EDGES)
_OFFSETS = np.cumsum([0, *(len(e) + 1 for e in _EDGES[:-1])])


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return 0, 0, int(_SYMBOL[np.frombuffer(data, np.uint8)].sum()), 0, 0
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    lines = [x for x in data.split(b"\n") if x.strip()]
    return len(words), int(counts @ _WEIGHTS[1]), int(counts @ _WEIGHTS[2]), len(lines) - len(set(lines)), repeat_words(words)


def repeat_words(words: list[bytes], size: int = 5) -> int:
    """Words in windows of five words that are found twice or more in the text."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    w = h[:n] * _MIX[0]
    for j in range(1, size):
        w = (w ^ (w >> np.uint64(29))) * _MIX[j - 1] + h[j : j + n] * _MIX[j]
    order = np.argsort(w, kind="stable")
    same = w[order][1:] == w[order][:-1]
    repeated = np.zeros(n, dtype=bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    covered = np.zeros(len(words), dtype=bool)
    for j in range(size):
        covered[j : j + n] |= repeated
    return int(covered.sum())


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """For each line with a word: the bin of each feature, and its code points."""
    lines = [x for x in (text or "").encode("utf-8", "surrogatepass").split(b"\n") if x.strip()]
    if not lines:
        return np.empty((0, len(_EDGES)), dtype=np.int64), np.empty(0, dtype=np.int64)
    data = np.frombuffer(b"".join(lines), np.uint8)
    ends = np.cumsum([len(x) for x in lines])
    sums = np.zeros((len(_WEIGHTS), len(data) + 1), dtype=np.int32)
    np.cumsum(_WEIGHTS[:, data], axis=1, out=sums[:, 1:], dtype=np.int32)
    per = np.diff(sums[:, np.concatenate([[0], ends])], axis=1).astype(float)
    points, solid, symbols, upper, lower, digits, punct, _ = per
    split = [x.split() for x in lines]
    n_words = np.array([len(x) for x in split])
    again = np.array([sum(map(bytes.__eq__, x, x[1:])) for x in split])
    seen: set[bytes] = set()
    dup = np.array([x in seen or seen.add(x) is not None for x in lines], dtype=float)
    values = (points, upper / np.maximum(1, upper + lower), symbols / np.maximum(1, solid), digits / np.maximum(1, solid), punct / np.maximum(1, solid), solid / np.maximum(1, n_words), again / np.maximum(1, n_words), dup)
    return np.stack([np.searchsorted(e, v, side="right") for e, v in zip(_EDGES, values, strict=True)], axis=1), points.astype(np.int64)


class LineField:
    """Two labels, 0 boilerplate and 1 content: weights (N_FEATURES, 2), transitions (2, 2)."""

    def __init__(self, weights: np.ndarray | None = None, transitions: np.ndarray | None = None):
        self.weights = np.zeros((N_FEATURES, 2)) if weights is None else weights
        self.transitions = np.zeros((2, 2)) if transitions is None else transitions

    def scores(self, bins: np.ndarray) -> np.ndarray:
        return self.weights[bins + _OFFSETS].sum(axis=1)

    def viterbi(self, bins: np.ndarray) -> np.ndarray:
        """The likeliest labels; ties go to content."""
        s = self.scores(bins).tolist()
        (t00, t01), (t10, t11) = self.transitions.tolist()
        a, b, back = s[0][0], s[0][1], []
        for e0, e1 in s[1:]:
            stay0, stay1 = a + t00 > b + t10, b + t11 >= a + t01
            a, b = (a + t00 if stay0 else b + t10) + e0, (b + t11 if stay1 else a + t01) + e1
            back.append((0 if stay0 else 1, 1 if stay1 else 0))
        label = int(b >= a)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return np.array(out[::-1])

    def content_share(self, bins: np.ndarray, points: np.ndarray) -> float:
        return float(points[self.viterbi(bins) == 1].sum() / points.sum()) if len(bins) else 0.0

    def fit(self, chains: list[tuple[np.ndarray, np.ndarray]], steps: int = 80, rate: float = 0.1, l2: float = 0.01) -> LineField:
        """Gradient ascent (Adam) on the mean log-likelihood, from this field on; chains: bins and labels of consecutive lines."""
        chains = sorted(chains, key=lambda c: -len(c[0]))
        longest, n = len(chains[0][0]), len(chains)
        bins, alive, y = np.zeros((n, longest, len(_EDGES)), dtype=np.int16), np.zeros((n, longest), dtype=bool), np.zeros((n, longest), dtype=np.int64)
        for i, (b, labels) in enumerate(chains):
            bins[i, : len(b)], alive[i, : len(b)], y[i, : len(b)] = b + _OFFSETS, True, labels
        flat, last = bins[alive].astype(np.int64), alive.sum(axis=1) - 1
        gold_w, gold_t = np.zeros((N_FEATURES, 2)), np.zeros((2, 2))
        for v in (0, 1):
            np.add.at(gold_w[:, v], flat[y[alive] == v].ravel(), 1)
        np.add.at(gold_t, (y[:, :-1][alive[:, 1:]], y[:, 1:][alive[:, 1:]]), 1)
        theta = np.concatenate([self.weights.ravel(), self.transitions.ravel()])
        m, v2 = np.zeros_like(theta), np.zeros_like(theta)
        rows = alive.sum(axis=0)
        for step in range(1, steps + 1):
            w, tr = theta[: 2 * N_FEATURES].reshape(-1, 2), theta[2 * N_FEATURES :].reshape(2, 2)
            e = np.zeros((n, longest, 2))
            e[alive] = w[flat].sum(axis=1)
            alpha, beta = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
            alpha[:, 0] = e[:, 0]
            for t in range(1, longest):
                k = rows[t]
                alpha[:k, t] = np.logaddexp(alpha[:k, t - 1, :1] + tr[0], alpha[:k, t - 1, 1:] + tr[1]) + e[:k, t]
            for t in range(longest - 2, -1, -1):
                k = rows[t + 1]
                on = e[:k, t + 1] + beta[:k, t + 1]
                beta[:k, t] = np.logaddexp(tr[:, 0] + on[:, :1], tr[:, 1] + on[:, 1:])
            z = np.logaddexp.reduce(alpha[np.arange(n), last], axis=1)
            node = np.exp(alpha + beta - z[:, None, None])[alive]
            want_w = np.stack([np.bincount(flat.ravel(), np.repeat(node[:, v], len(_EDGES)), minlength=N_FEATURES) for v in (0, 1)], axis=1)
            pair = np.exp(alpha[:, :-1, :, None] + tr + (e + beta)[:, 1:, None, :] - z[:, None, None, None])
            want_t = pair[alive[:, 1:]].sum(axis=0)
            g = np.concatenate([(gold_w - want_w).ravel(), (gold_t - want_t).ravel()]) / len(flat) - l2 * theta / N_FEATURES
            m, v2 = 0.9 * m + 0.1 * g, 0.999 * v2 + 0.001 * g * g
            theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v2 / (1 - 0.999**step)) + 1e-8)
        return LineField(theta[: 2 * N_FEATURES].reshape(-1, 2), theta[2 * N_FEATURES :].reshape(2, 2))


def learn(docs: list[tuple[np.ndarray, np.ndarray, int]], relabels: int = RELABELS) -> LineField:
    """A field from bins and code points of documents' lines and the documents' labels."""
    docs = [d for d in docs if len(d[0])]
    field = LineField()
    if len({y for *_, y in docs}) < 2:
        return field
    labels = [np.full(len(bins), y) for bins, _, y in docs]
    for turn in range(relabels + 1):
        chains = [(bins[k : k + CHAIN_LINES], own[k : k + CHAIN_LINES]) for (bins, *_), own in zip(docs, labels, strict=True) for k in range(0, len(bins), CHAIN_LINES)]
        field = field.fit(chains)
        if turn < relabels:
            paths = [field.viterbi(bins) for bins, *_ in docs]
            agrees = [(points[path == 1].sum() >= MIN_CONTENT_SHARE * points.sum()) == y for path, (_, points, y) in zip(paths, docs, strict=True)]
            labels = [path if ok else np.full(len(path), d[2]) for path, ok, d in zip(paths, agrees, docs, strict=True)]
    return field


def train(documents: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> LineField:
    """A field from at most `most` labelled documents of either label, chosen by hash; all of their lines train it."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = [known.where(F.col("quality") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for v in (0, 1)]
    sample = documents.select("doc_id", "text").join(F.broadcast(chosen[0].unionAll(chosen[1])), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [line_features(t) for t in b.column("text").to_pylist()]
            columns = [pa.array([x.astype(kind).tobytes() for x in column], pa.binary()) for kind, column in zip((np.uint8, np.int32), zip(*got, strict=True), strict=True)] if got else [pa.array([], pa.binary())] * 2
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("quality"), *columns], names=["doc_id", "quality", "bins", "points"])

    rows = sample.mapInArrow(run, "doc_id long, quality int, bins binary, points binary").dropDuplicates(["doc_id", "bins"]).collect()
    return learn([(np.frombuffer(r["bins"], np.uint8).reshape(-1, len(_EDGES)).astype(np.int64), np.frombuffer(r["points"], np.int32), r["quality"]) for r in sorted(rows, key=lambda r: (r["doc_id"], r["bins"]))])


VERDICT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_share double, kept boolean"


def verdict(text: str | None, field: LineField, min_share: float = MIN_CONTENT_SHARE) -> tuple:
    n_words, word_chars, n_symbols, n_dup, n_repeat = base_counts(text)
    failed = n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words
    bins, points = line_features(text)
    share = field.content_share(bins, points)
    return n_words, word_chars, n_symbols, n_dup, n_repeat, failed, share, not failed and share >= min_share


def judge(documents: DataFrame, field: LineField) -> DataFrame:
    """doc_id and the columns of VERDICT."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared.claim("quality_rules")
        kinds = (pa.int64(),) * 5 + (pa.bool_(), pa.float64(), pa.bool_())
        for b in batches:
            rows = [verdict(t.as_py(), field) for t in b.column("text")]
            columns = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *columns], names=["doc_id", *(c.split()[0] for c in VERDICT.split(", "))])

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id long, {VERDICT}")


def keep(documents: DataFrame, field: LineField) -> DataFrame:
    """The documents that pass, all columns kept."""
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared.claim("quality_rules")
        for b in batches:
            yield b.filter(pa.array([verdict(t.as_py(), field)[-1] for t in b.column(at)], pa.bool_()))

    return documents.mapInArrow(run, T.StructType(documents.schema.fields))
