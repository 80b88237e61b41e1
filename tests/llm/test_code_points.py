"""Letters on which Unicode tables of different age differ: ids equal the library's, for any code point."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from netquarry.llm import bpe, store
from netquarry.llm.registry import tokenizer_path

POINTS = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]


@pytest.fixture(scope="module")
def encoders():
    library = Tokenizer.from_file(tokenizer_path())
    library.no_padding()
    library.no_truncation()
    own, stored = bpe.vocabulary(tokenizer_path()), store.Library(tokenizer_path())

    def split(found):
        ids, n = found
        return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]

    return lambda texts: (split(own.words().encode(texts)), split(stored.table.encode(texts)), [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)])


def same(encoders, texts):
    one, seven, want = encoders(texts)
    assert [ascii(t) for t, x, y in zip(texts, one, want, strict=True) if x != y] == []
    assert [ascii(t) for t, x, y in zip(texts, seven, want, strict=True) if x != y] == []


def test_letters_of_other_versions(encoders):
    same(encoders, [f"a{c}!" for c in "՘֋࢏౜೜Ᲊ₏₝꟎ꟚꟜ\U00010d50\U00016ea0\U00018e00"] + ["Σς İİ ẞ ﬁ"])


@pytest.mark.parametrize("around", ["a{}!", "1{}x", "e{0}̴́ {0}{0}"])
def test_code_points_in_surroundings(encoders, around):
    """Every fifth code point beyond the first 70,000, which are all tried."""
    same(encoders, [around.format(c) for c in POINTS[:70_000] + POINTS[70_000::5]])


def test_random_texts(encoders):
    rng, near = random.Random(3), [c for c in POINTS if ord(c) < 0x32000]
    pools = (near, near[:600], "aB1 \n.<|endoftext|>'s")
    same(encoders, ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.randrange(1, 40))) for _ in range(5000)])
