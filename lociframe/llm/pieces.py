"""Sampled SentencePiece segmentation by forward filtering and backward sampling, and lossless decoding.

The lattice of a text has a node for each place between bytes and an arc for each piece of the vocabulary; a path's
probability goes with exp(theta * sum of its pieces' scores). The forward pass sums over all paths up to each node;
backward sampling then draws arcs from the end, so each whole path comes up with its exact probability. Random numbers
are a hash of the row's key and the place in the text: a row gets the same segmentation in any run,
partition or batch, and theta above 1 nears the best path.

No piece reaches over the start of a run of spaces or over a line break, so the lattice falls apart into units; units that
repeat are filtered once and drawn together, column-wise. A unit of over UNIT_BYTES bytes is walked on its own: the forward pass keeps
one sum for each place, and sampling finds the arcs again, WALK_BYTES at a time from the end, so no text is cut. A model
with pieces that do reach over has whole texts as units.

A text gets the model's leading space; characters outside the vocabulary, and U+2581 itself, which the model uses for the
space, become byte pieces. So decode(encode(text)) == text for every text.

Defined cases: a null text has null ids; an empty text is the leading space alone; a null key counts as key 0; equal
texts under equal keys get equal ids; texts of any length are read in full; an empty table gives no rows; columns other than the
key and text are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lociframe.llm import shared
from lociframe.llm.packing import slices

THETA = 0.0005
UNIT_BYTES = 4096
WALK_BYTES = 1 << 16
KEPT_ARCS = 6_000_000
SLICE_BYTES = 2 << 20
_UNITS = re.compile(r" +[^ \n]*|\n|[^ \n]+")
_SPACE = "▁"
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_models: dict[tuple[str, float], Lattices] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


class _Numbered(dict):
    """Numbers new keys in order."""

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        return n


class _Growing:
    """An array that grows at its end."""

    def __init__(self, kind: type, size: int = 1 << 16):
        self.held, self.size = np.empty(size, dtype=kind), 0

    def add(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.held):
            self.held = np.concatenate([self.held[: self.size], np.empty(max(need, len(self.held) * 3 // 2) - self.size, dtype=self.held.dtype)])
        self.held[self.size : need] = values
        self.size = need


class Lattices:
    """The filtered lattices of all units seen, in flat arrays, for one model and theta."""

    def __init__(self, path: str, theta: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.theta, self.pieces, self.bytes_of = theta, {}, []
        self.byte_ids = [0] * 256
        scores = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            scores.append(model.get_score(i))
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes_of.append(b"")
            else:
                text = piece.replace(_SPACE, " ").encode()
                self.pieces[text] = i
                self.bytes_of.append(text)
        self.whole = any(not re.fullmatch(r" *[^ \n]*|\n", t.decode()) for t in self.pieces)
        self.id_type = np.uint16 if len(scores) <= 1 << 16 else np.int32
        self.scores = np.array(scores)
        self.scores[self.byte_ids] = self.scores.min()
        self.byte_ids = np.array(self.byte_ids)
        self.longest = max(map(len, self.pieces))
        self.by_length = {}
        for n in {*map(len, self.pieces)}:
            own = [(t, i) for t, i in self.pieces.items() if len(t) == n]
            letters = np.frombuffer(b"".join(t for t, _ in own), np.uint8).reshape(-1, n)
            h = np.zeros(len(own), dtype=np.uint64)
            for k in range(n):
                h = h * _A + letters[:, k]
            order = np.argsort(h, kind="stable")
            if len(np.unique(h)) < len(own):
                raise ValueError("two pieces share a hash")
            self.by_length[n] = h[order], np.array([i for _, i in own])[order], letters[order]
        self.reset()

    def reset(self) -> None:
        self.units = _Numbered()
        self.done = 0
        self.base = _Growing(np.int64)  # first node of each unit; nodes of a unit lie side by side
        self.base.add(np.zeros(1, dtype=np.int64))
        self.first = _Growing(np.int32)  # first arc into each node
        self.cum, self.came, self.ids = _Growing(np.float32), _Growing(np.int32), _Growing(self.id_type)

    def _arcs(self, data: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place, length and id of all pieces in the units' bytes; left: bytes from each place to its unit's end."""
        at = np.flatnonzero((data & 0xC0) != 0x80)
        starts, sizes = at, np.diff(at, append=len(data))
        h, found = np.zeros(len(at), dtype=np.uint64), []
        spelled = np.zeros(len(data), dtype=bool)  # first bytes of characters that are pieces
        size_at = np.zeros(len(data), dtype=np.int64)
        size_at[starts] = sizes
        for n in range(1, self.longest + 1):
            open_ = left[at] >= n
            at, h = at[open_], h[open_] * _A + data[at[open_] + (n - 1)]
            if not len(at):
                break
            if n not in self.by_length:
                continue
            hashes, ids, letters = self.by_length[n]
            k = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            hit = np.flatnonzero(hashes[k] == h)
            hit = hit[(data[at[hit][:, None] + np.arange(n)] == letters[k[hit]]).all(axis=1)]
            found.append((at[hit], np.full(len(hit), n), ids[k[hit]]))
            spelled[at[hit][size_at[at[hit]] == n]] = True
        lone = starts[~spelled[starts]]
        lone = np.repeat(lone, size_at[lone]) + (np.arange(size_at[lone].sum()) - np.repeat(np.cumsum(size_at[lone]) - size_at[lone], size_at[lone]))
        found.append((lone, np.ones(len(lone), dtype=np.int64), self.byte_ids[data[lone]]))
        return tuple(np.concatenate(x[::-1]) for x in zip(*found, strict=True))

    def filter(self) -> None:
        """The forward pass over all units numbered since the last call."""
        fresh = [u.encode() for u in list(self.units)[self.done :]]
        if not fresh:
            return
        sizes = np.fromiter(map(len, fresh), np.int64, len(fresh))
        ends, unit = np.cumsum(sizes), np.repeat(np.arange(len(fresh)), sizes)
        data = np.frombuffer(b"".join(fresh), np.uint8)
        place, n, ids = self._arcs(data, ends[unit] - np.arange(len(data)))
        to = place + n - (ends - sizes)[unit[place]]
        came = place + unit[place]  # a unit has a node more than bytes
        order = np.argsort(came + n, kind="stable")
        to, came, at, ids = to[order], came[order], (came + n)[order], ids[order].astype(np.int32)
        s = self.theta * self.scores[ids]
        base = np.concatenate([[0], ends + np.arange(1, len(fresh) + 1)])
        alpha = np.full(base[-1], -np.inf)
        alpha[base[:-1]] = 0.0
        by_step = np.argsort(to.astype(np.int16), kind="stable")
        edges = np.flatnonzero(np.diff(to[by_step], prepend=-1, append=-1))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            arc = by_step[a:b]
            v, starts = alpha[came[arc]] + s[arc], np.flatnonzero(np.diff(at[arc], prepend=-1))
            top = np.maximum.reduceat(v, starts)
            total = np.add.reduceat(np.exp(v - np.repeat(top, np.diff(starts, append=len(arc)))), starts)
            alpha[at[arc[starts]]] = top + np.log(total)
        p = np.exp(alpha[came] + s - alpha[at])
        starts = np.flatnonzero(np.diff(at, prepend=-1))
        size = np.diff(starts, append=len(at))
        cum = np.cumsum(p)
        cum -= np.repeat(cum[starts] - p[starts], size)
        cum[starts + size - 1] = np.inf
        first = np.full(base[-1], -1, dtype=np.int64)
        first[at[starts]] = starts + self.cum.size
        nodes = self.base.held[self.base.size - 1]
        for kept, new in ((self.base, nodes + base[1:]), (self.first, first), (self.cum, cum), (self.ids, ids), (self.came, nodes + came)):
            kept.add(new)
        self.done = len(self.units)

    def encode(self, texts: list[str], keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has."""
        if self.cum.size > KEPT_ARCS:
            self.reset()
        split = [[" " + t] if self.whole else _UNITS.findall(" " + t) for t in texts]
        n_units = np.array([len(x) for x in split])
        long = {}  # units that are walked on their own stand in the tables as one byte
        for x, k in zip(split, (np.cumsum(n_units) - n_units).tolist(), strict=True):
            if max(map(len, x)) * 4 > UNIT_BYTES:
                for j, u in enumerate(x):
                    if len(u) * 4 > UNIT_BYTES:
                        long[k + j], x[j] = u.encode(), " "
        units = np.fromiter((k for x in split for k in map(self.units.__getitem__, x)), np.int64, n_units.sum())
        self.filter()
        with np.errstate(over="ignore"):
            row = _mix(np.array([k & 0xFFFFFFFFFFFFFFFF for k in keys], dtype=np.uint64) + _A)
            place = np.arange(len(units)) - np.repeat(np.cumsum(n_units) - n_units, n_units)
            seed = _mix(np.repeat(row, n_units) + place.astype(np.uint64) * _A)
            base, first, cum, came, piece = (x.held for x in (self.base, self.first, self.cum, self.came, self.ids))
            start, node = base[units], base[units + 1] - 1
            n_ids, active, steps = np.zeros(len(units), dtype=np.int64), np.arange(len(units)), []
            while len(active):
                at = node[active]
                u = (_mix(seed[active] + (at - start[active]).astype(np.uint64) * _B) >> np.uint64(11)) * 2.0**-53
                arc = first[at]
                more = np.flatnonzero(u >= cum[arc])
                while len(more):
                    arc[more] += 1
                    more = more[u[more] >= cum[arc[more]]]
                steps.append((active, piece[arc]))
                n_ids[active] += 1
                node[active] = came[arc]
                active = active[node[active] != start[active]]
            walked = {k: self.walk(data, seed[k]) for k, data in long.items()}
            for k, ids in walked.items():
                n_ids[k] = len(ids)
        ends = np.cumsum(n_ids)
        out = np.empty(ends[-1] if len(ends) else 0, dtype=np.int32)
        for k, (who, ids) in enumerate(steps):
            out[ends[who] - 1 - k] = ids
        for k, ids in walked.items():
            out[ends[k] - len(ids) : ends[k]] = ids
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(n_units)])]
        return out, np.diff(bounds)

    def _window(self, data: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The arcs that end in (a, b], in order of their ends: where each place's arcs start in the list, starts, ids, weights; a and b are between characters."""
        from_ = max(0, a - self.longest)
        while from_ and data[from_] & 0xC0 == 0x80:
            from_ -= 1
        place, n, ids = self._arcs(data[from_:b], b - from_ - np.arange(b - from_))
        place, end = place + from_, place + from_ + n
        order = np.argsort(end, kind="stable")
        order = order[end[order] > a]
        return np.searchsorted(end[order], np.arange(a + 1, b + 2)), place[order], ids[order], self.theta * self.scores[ids[order]]

    def walk(self, unit: bytes, seed: np.uint64) -> np.ndarray:
        """Ids of one long unit: the same draws as in encode(), with arcs in memory for one window at a time."""
        data, edges = np.frombuffer(unit, np.uint8), [0]
        while edges[-1] < len(data):
            to = min(len(data), edges[-1] + WALK_BYTES)
            while to < len(data) and data[to] & 0xC0 == 0x80:
                to += 1
            edges.append(to)
        alpha = np.full(len(data) + 1, -np.inf)
        alpha[0] = 0.0
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            bounds, came, _, s = self._window(data, a, b)
            bounds = bounds.tolist()
            for j, (i, k) in enumerate(zip(bounds[:-1], bounds[1:], strict=True), a + 1):
                if i < k:
                    v = alpha[came[i:k]] + s[i:k]
                    top = v.max()
                    if top > -np.inf:
                        alpha[j] = top + np.log(np.exp(v - top).sum())
        out, at = [], len(data)
        draws = (_mix(seed + np.arange(len(data) + 1, dtype=np.uint64) * _B) >> np.uint64(11)) * 2.0**-53
        for a, b in zip(edges[-2::-1], edges[:0:-1], strict=True):
            bounds, came, ids, s = self._window(data, a, b)
            while at > a:
                i, k = bounds[at - a - 1], bounds[at - a]
                cum = np.cumsum(np.exp(alpha[came[i:k]] + s[i:k] - alpha[at]))
                arc = i + min(int(np.searchsorted(cum, draws[at], side="right")), k - i - 1)
                out.append(ids[arc])
                at = int(came[arc])
        return np.array(out[::-1], dtype=np.int32)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids))[1:].decode()


def lattices(path: str, theta: float = THETA) -> Lattices:
    if (path, theta) not in _models:
        _models[path, theta] = Lattices(path, theta)
    return _models[path, theta]


def encode(rows: DataFrame, model: str, key: str = "doc_id", theta: float = THETA, check: bool = False) -> DataFrame:
    """(key, text) -> key, ids array<int>; with `check`, lossless: whether the ids decode to the text exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared.claim("pieces", _models.clear)
        lat = lattices(model, theta)
        for whole in batches:
            for b in slices(whole, most=SLICE_BYTES):
                texts, keys = b.column("text").to_pylist(), b.column(key).to_pylist()
                ids, n = lat.encode([t for t in texts if t is not None], [k or 0 for t, k in zip(texts, keys, strict=True) if t is not None])
                sizes = np.zeros(len(texts), dtype=np.int64)
                null = np.array([t is None for t in texts], dtype=bool)
                sizes[~null] = n
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), pa.int32(), mask=np.append(null, False))
                columns, names = [b.column(key), pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))], [key, "ids"]
                if check:
                    bounds = np.concatenate([[0], np.cumsum(sizes)]).tolist()
                    columns.append(pa.array([None if t is None else lat.decode(ids[i:j].tolist()) == t for t, i, j in zip(texts, bounds, bounds[1:], strict=False)], pa.bool_()))
                    names.append("lossless")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.select(key, "text").mapInArrow(run, f"{key} long, ids array<int>" + ", lossless boolean" * check)


def decode(rows: DataFrame, model: str) -> DataFrame:
    """Adds decoded to rows with ids; other columns stay."""
    at = rows.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared.claim("pieces", _models.clear)
        lat = lattices(model)
        for b in batches:
            texts = [None if x.as_py() is None else lat.decode(x.values.to_numpy().tolist()) for x in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, "decoded"])

    fields = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)
    return rows.mapInArrow(run, f"{fields}, decoded string")
