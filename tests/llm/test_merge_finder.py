"""Merges of words listed by an automaton, and texts put together by offsets."""

import numpy as np

from segmint.llm import bpe
from segmint.llm.queries import RANK_FILE, tokenizer_path


def test_merges_by_automaton_equal_all_substrings():
    file = bpe.RankFile.load(tokenizer_path(RANK_FILE))
    rank = {t: k for k, t in enumerate(file.tokens)}
    spans = [(s, e) for e in range(2, bpe.FOLD_BYTES + 1) for s in range(e - 1)]
    find = bpe.MergeFinder(file.tokens)
    for word in [b"a", b" the", " größeren".encode(), b" ientation", "中文中文".encode(), b"x" * bpe.FOLD_BYTES, bytes(range(200, 256))]:
        found = [rank[word[s:e]] * bpe.MOST_SPANS + k for k, (s, e) in enumerate(spans) if e <= len(word) and word[s:e] in rank]
        assert find(word) == sorted(found)


def test_texts_are_put_together_by_offsets():
    table = bpe._Assembler(bpe.WordTable([], np.array([5, 6, 7], np.int32), np.array([0, 1, 3])))
    ids, starts = table.texts(np.array([1, 0, 1]), np.array([0, 0, 2, 3, 3]))
    assert ids.tolist() == [6, 7, 5, 6, 7] and starts.tolist() == [0, 0, 3, 5, 5]
