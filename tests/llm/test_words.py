import random

import numpy as np
import pyarrow as pa
from tests.llm import plain

from boxloom.llm import words as W


def test_words_and_windows():
    chance = random.Random(1)
    texts = ["", None, "a", " a", "a ", "ab\tcd", "é à b", "x" * 50 + " y"] + [
        "".join(chance.choice("ab \té1!") for _ in range(chance.randrange(40))) for _ in range(300)
    ]
    for size in (1, 64, 1 << 20):
        for inside, rule, lower in ((W.BLANKS, plain.blank_words, False), (W.ALPHANUMERIC, plain.plain_words, True)):
            got = []
            for block in W.blocks(pa.array(texts), inside, lower=lower, size=size):
                for row in range(block.n_rows):
                    got.append([block.word(i).decode() for i in range(block.bounds[row], block.bounds[row + 1])])
            assert got == [rule(t) for t in texts]


def test_hashes():
    block = next(W.blocks(pa.array(["one two three one", "twelve-letters twelve-lettera twelve-letters one"]), W.BLANKS))
    h = W.word_hashes(block)
    assert h[0] == h[3] == h[7] and h[4] == h[6] != h[5]
    values = np.random.default_rng(0).integers(0, 1 << 63, 50).astype(np.uint64)
    for length in (1, 2, 3, 6, 7, 8, 13, 50):
        base = int(W._BASE)
        want = [sum(int(values[i + j]) * base ** (length - 1 - j) for j in range(length)) % (1 << 64) for i in range(51 - length)]
        assert W.window_hashes(values, length).tolist() == want
    assert len(W.window_hashes(values, 51)) == 0
    for width in (1, 2, 3, 8, 11):
        assert W.sliding_min(values, width).tolist() == [values[i : i + width].min() for i in range(51 - width)]
