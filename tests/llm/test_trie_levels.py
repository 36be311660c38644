"""Token counts from a trie that is computed level by level."""

import random

import pytest

from segmint.llm import unigram


def _words(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdx\0é中\U0001f600", k=rng.randrange(1, 90))) for _ in range(n)] + ["a", "a\0", "a\0\0", "\0"]


SCORES = {c: -3.0 for c in "abcdé"} | {"ab": -2.0, "cd": -2.5, "abcd": -4.0, "dd": 0.0, "中a": -1.0, "\0a": -2.0}


def test_a_level_of_the_trie_is_computed_together(monkeypatch):
    words = [w for w in _words(2000) if len(w) <= unigram.LONGEST]
    want = {w: unigram.TrieCounter(SCORES)._alone(w) for w in words}
    counter = unigram.TrieCounter(SCORES)
    monkeypatch.setattr(counter, "_extend", None)  # the recursion of a single word
    assert counter.learn(words) == want


@pytest.mark.parametrize("most", [40, unigram.MAX_NODES])
def test_results_of_repeated_and_long_words(monkeypatch, most):
    words = _words(300) * 3
    want = [unigram.TrieCounter(SCORES)._alone(w) for w in words]
    monkeypatch.setattr(unigram, "MAX_NODES", most)
    counter = unigram.TrieCounter(SCORES)
    for _ in range(2):
        tokens, scores = counter.results(words)
        assert list(zip(tokens.tolist(), scores.tolist())) == want
        assert len(counter.terminal) <= most
    assert [len(x) for x in counter.results([])] == [0, 0]
