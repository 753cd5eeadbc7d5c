"""The packing encoder's table and short way for words against whole texts through the tokenizer."""

import json
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, ".")
from lociframe.llm import packing  # noqa: E402

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [*"abCDéÉßÿÞ×÷ªµº'’.,!#$%&|<>-_ \n\t\r\x0b\x0c\x00\x1c\x85\xa0İıΣσςſK12½中😂", "é", "<|endoftext|>", "<|STARTOFTEXT|>", "'s", "'LL", " the ", " Été, "]


class Counted:
    """A tokenizer that counts the texts it gets."""

    def __init__(self, tokenizer):
        self.tokenizer, self.seen = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.seen += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def changed(tmp_path, change):
    made = json.load(open(WORDS))
    change(made)
    path = tmp_path / "tokenizer.json"
    path.write_text(json.dumps(made))
    return str(path)


def equal_to_whole_texts(encoder, rng):
    for _ in range(60):
        texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(40))) for _ in range(40)]
        whole = encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        assert encoder.encode(texts) == [np.array(x.ids, dtype="<u4").tobytes() for x in whole]


def test_odd_words_equal_whole_texts(monkeypatch):
    monkeypatch.setattr(packing, "KEPT_WORDS", 200)  # the halves of the table change places often
    equal_to_whole_texts(packing.Encoder(WORDS), random.Random(5))


@pytest.mark.parametrize("change", [lambda x: x["normalizer"]["normalizers"].pop(), lambda x: x["pre_tokenizer"]["pretokenizers"][0]["pattern"].update(Regex=r"[\p{L}.]+|[^\s\p{L}.]+")])
def test_other_tokenizers_equal_whole_texts(tmp_path, change):
    equal_to_whole_texts(packing.Encoder(changed(tmp_path, change)), random.Random(6))


def test_words_of_letters_go_to_the_merges_alone():
    encoder, rng = packing.Encoder(WORDS), random.Random(7)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzéüß", k=9)) + rng.choice(["", ".", "###"]) for _ in range(4000)]
    encoder.tokenizer = counted = Counted(encoder.tokenizer)
    got = encoder.encode([" ".join(words)])
    assert counted.seen < 20
    assert got == [np.array(counted.tokenizer.encode(" ".join(words), add_special_tokens=False).ids, dtype="<u4").tobytes()]


def test_table_of_words_is_bounded():
    encoder = packing.Encoder(WORDS)
    for part in range(60):
        encoder.encode([" ".join(f"{'abcdefghij'[part % 10]}{'klmnop'[part // 10]}{''.join('qrstuvwxyz'[int(d)] for d in str(i))}" for i in range(5000))])
    assert sum(len(x) for x in vars(encoder).values() if isinstance(x, dict)) <= 2 * 100_000 + 10_000
