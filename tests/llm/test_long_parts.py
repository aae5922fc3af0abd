"""Expectation maximisation of the subword lattice on long parts of words."""

import numpy as np

from pageloom.llm.lm_scoring import Lattice, Vocabulary, tokenizer_path


def test_long_parts_teach_as_short_ones_do():
    v = Vocabulary(tokenizer_path())
    words = ["antidisestablishmentarianism".encode(), "这是一个没有空格的句子".encode()]
    short, long = Lattice(v, v.start()), Lattice(v, v.start())
    long.MOST = 8
    a, b = np.zeros(v.size), np.zeros(v.size)
    short.expected(words, a)
    long.expected(words, b)
    assert a.sum() > 2 and np.allclose(a, b, atol=1e-4)
    c = np.zeros(v.size)
    short.expected(["这是一个没有空格的很长的句子它超过四十八个字节".encode()], c)
    assert c.sum() > 1
