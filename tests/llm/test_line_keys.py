"""Hashes of substrings, against plain Python, and what a worker keeps for them."""

import sys

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
sys.path.insert(0, ".")
from lociframe.llm import line_dedup  # noqa: E402


@pytest.mark.parametrize("long", [1, 2 * (1 << 18) + 5])
def test_hashes_of_substrings_against_plain_python(long):
    lines = ["plain words", "é中　、⿿😂\U0010ffff", "x" * long, "plain words"]
    with np.errstate(over="ignore"):
        h = line_dedup.Hashed(lines)
        points = list(map(ord, "".join(lines)))[:40]
        mixed = line_dedup._mix(np.array(points, dtype=np.uint64) + np.uint64(1)).tolist()
        sums = [0]
        for k, x in enumerate(mixed):
            sums.append((sums[-1] + x * pow(line_dedup._PRIME, k, 2**64)) % 2**64)
        assert h.sums[: len(sums)].tolist() == sums
        first, last = (h.keys(np.array([h.start[i]]), np.array([11]), np.array([11]), 0)[0] for i in (0, 3))
        assert first == last


def test_powers_are_kept_between_batches():
    with np.errstate(over="ignore"):
        a, b = line_dedup.Hashed(["some words"]), line_dedup.Hashed(["other words"])
    assert np.shares_memory(a.back, b.back)
