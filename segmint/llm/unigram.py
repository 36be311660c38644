"""Token counts under a unigram vocabulary, by dynamic programming shared over a trie.

The best segmentation of a pre-token is a forward recursion over its prefixes:
``best[i] = max over pieces p ending at i of best[i - len(p)] + score(p)``. The distinct
pre-tokens not met yet are put in a trie, level by level: a node is the first of the sorted
pre-tokens with its prefix, holds the prefix's best score and token count, and is computed
once, however many of them share it. All nodes of a level are computed together, in numpy. A
pre-token that is met again is answered by its terminal node; a document's count is the sum
over its pre-tokens. Each worker process keeps the terminal nodes between batches and tasks
(inner nodes serve only the pre-tokens inserted together); no words are shuffled.

Scores are given by the caller; ``zipf_scores`` derives them from the ranks of a public
vocabulary. A character that no piece covers costs its UTF-8 bytes, one token each. Equal
scores prefer the longer last piece.

Null text counts as empty: no pre-tokens, no tokens. Rows stay one to one, extra columns are
ignored. Memory is bounded: a batch's pre-tokens, the trie of ``CHUNK`` of them and at most
``MAX_NODES`` terminal nodes, which begin anew when they are full; pre-tokens over 64 characters
are counted without the trie, with the last few positions only.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import only_memo, small_batches, text_column
from .pieces import SPACE, PieceModel

_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
BYTE_SCORE = -20.0  # of each byte of an uncovered character
MAX_NODES = 600_000  # terminal nodes of a process, about 250 bytes each
CHUNK = 16_384  # pre-tokens that are inserted together
RUN = 262_144  # pre-tokens of a batch that are answered together
LONGEST = 64  # characters of a pre-token in the trie


def zipf_scores(model: PieceModel) -> dict[str, float]:
    """Log probabilities 1 / (rank + 1), normalised, in the order of the vocabulary's ids."""
    skip = model.special | set(model.byte_ids)
    pieces = [p for i, p in enumerate(model.pieces) if i not in skip]
    total = math.log(sum(1.0 / (r + 2) for r in range(len(pieces))))
    return {p: -math.log(r + 2) - total for r, p in enumerate(pieces)}


_NO_SUFFIX = object()  # of any piece; None: a suffix that is no piece itself


class SuffixTable:
    """Transitions between the suffixes of pieces, read backwards: from a suffix, by the character
    before it, to the longer suffix. An open-addressing table in numpy; state 0 is the empty suffix."""

    def __init__(self, suffixes: dict[str, float | None]):
        state = {"": 0} | {s: k for k, s in enumerate(suffixes, 1)}
        self.score = np.array([np.nan, *(np.nan if x is None else x for x in suffixes.values())])
        # every suffix but its first character is a suffix too
        keys = np.array([state[s[1:]] << 21 | ord(s[0]) for s in suffixes], dtype=np.uint64)
        bits = max(4, (4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, np.iinfo(np.uint64).max)
        self.states = np.full(1 << bits, -1, np.int32)
        rest, at = np.arange(len(keys)), self._place(keys)
        while len(rest):
            free = self.states[at] < 0
            first = np.unique(at[free], return_index=True)[1]  # one key a place
            put = np.flatnonzero(free)[first]
            self.keys[at[put]], self.states[at[put]] = keys[rest[put]], rest[put] + 1
            left = np.ones(len(rest), bool)
            left[put] = False
            rest, at = rest[left], at[left]
            taken = self.keys[at] != keys[rest]
            at = np.where(taken, (at + 1) & self.mask, at)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def next(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The states after one more character, -1 where the string is no suffix of a piece."""
        keys = state.astype(np.uint64) << np.uint64(21) | char.astype(np.uint64)
        at = self._place(keys)
        out = self.states[at]
        other = np.flatnonzero((self.keys[at] != keys) & (out >= 0))
        while len(other):
            at[other] = (at[other] + 1) & self.mask
            out[other] = self.states[at[other]]
            other = other[(self.keys[at[other]] != keys[other]) & (out[other] >= 0)]
        return out


class TrieCounter:
    """Best-segmentation counts and scores of pre-tokens."""

    def __init__(self, scores: dict[str, float]):
        # every suffix of a piece, with the score if it is a piece itself: the backward
        # walk from an end position stops at the first string that is no such suffix
        self.suffixes: dict[str, float | None] = {}
        for piece in scores:
            for i in range(len(piece)):
                self.suffixes.setdefault(piece[i:], None)
        self.suffixes.update(scores)
        self.longest = max(map(len, scores), default=1)
        self.table = SuffixTable(self.suffixes)
        self._begin()

    def _begin(self) -> None:
        self.best, self.tokens = np.empty(0), np.empty(0, np.int64)  # by terminal node, room at the end
        self.terminal: dict[str, int] = {}  # pre-token -> its node

    def _extend(self, word: str, end: int, best: list[float], tokens: list[int], base: int = 0) -> None:
        """Appends the results of ``word[:end]``; ``best[k]`` is that of ``word[: base + k]``."""
        suffixes = self.suffixes
        top, count, covered = -math.inf, 0, False
        for start in range(end - 1, -1, -1):
            score = suffixes.get(word[start:end], _NO_SUFFIX)
            if score is _NO_SUFFIX:
                break
            if score is not None:
                covered = covered or start == end - 1
                if best[start - base] + score >= top:
                    top, count = best[start - base] + score, tokens[start - base] + 1
        if not covered:
            raw = len(word[end - 1].encode("utf-8", "surrogatepass"))
            if best[end - 1 - base] + raw * BYTE_SCORE > top:
                top, count = best[end - 1 - base] + raw * BYTE_SCORE, tokens[end - 1 - base] + raw
        best.append(top)
        tokens.append(count)

    def _insert(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token counts and scores of sorted distinct words of 1 to ``LONGEST`` characters."""
        n = len(words)
        lengths = np.array([len(w) for w in words])
        width = int(lengths.max())
        chars = np.ascontiguousarray(np.array(words, dtype=f"U{width}").view(np.uint32).reshape(n, width).T)
        best, tokens = np.zeros((width + 1, n)), np.zeros((width + 1, n), np.int64)  # of a row's prefixes
        fresh = np.zeros(n, bool)  # the row's prefix differs from that of the row before
        fresh[0] = True
        for end in range(1, width + 1):
            fresh[1:] |= (chars[end - 1, 1:] != chars[end - 1, :-1]) | (lengths[:-1] < end)
            reach = np.flatnonzero(lengths >= end)
            starts = fresh[reach]
            top, count = self._level(chars, best, tokens, reach[starts], end)
            node = np.cumsum(starts) - 1
            best[end, reach], tokens[end, reach] = top[node], count[node]
        rows = np.arange(n)
        return tokens[lengths, rows], best[lengths, rows]

    def _level(
        self, chars: np.ndarray, best: np.ndarray, tokens: np.ndarray, nodes: np.ndarray, end: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Best score and token count of the prefixes of length ``end`` of some rows."""
        top, count = np.full(len(nodes), -math.inf), np.zeros(len(nodes), np.int64)
        covered = np.zeros(len(nodes), bool)
        alive, rows, state = np.arange(len(nodes)), nodes, np.zeros(len(nodes), np.int32)
        for start in range(end - 1, -1, -1):
            state = self.table.next(state, chars[start, rows])
            go = state >= 0
            if not go.all():
                alive, rows, state = alive[go], rows[go], state[go]
            if not len(alive):
                break
            score = self.table.score[state]
            if start == end - 1:
                covered[alive] = ~np.isnan(score)
            total = best[start, rows] + score
            better = total >= top[alive]  # never where the suffix is no piece
            at = alive[better]
            top[at], count[at] = total[better], tokens[start, rows[better]] + 1
        bare = np.flatnonzero(~covered)
        if len(bare):
            rows = nodes[bare]
            char = chars[end - 1, rows]
            raw = 1 + (char >= 0x80) + (char >= 0x800) + (char >= 0x10000)  # bytes in UTF-8
            total = best[end - 1, rows] + raw * BYTE_SCORE
            better = total > top[bare]
            at = bare[better]
            top[at], count[at] = total[better], tokens[end - 1, rows[better]] + raw[better]
        return top, count

    def _alone(self, word: str) -> tuple[int, float]:
        """A long pre-token, of whose prefixes only as many are held as a piece is long."""
        best, tokens, base = [0.0], [0], 0
        for end in range(1, len(word) + 1):
            self._extend(word, end, best, tokens, base)
            if len(best) > 4096 + self.longest:
                del best[:4096], tokens[:4096]
                base += 4096
        return tokens[-1], best[-1]

    def learn(self, words: Iterable[str]) -> dict[str, tuple[int, float]]:
        """(tokens, score) of pre-tokens; those of ordinary length get a terminal node."""
        words = set(words)
        out = {w: self._alone(w) for w in words if len(w) > LONGEST}
        for part, tokens, best in self._grow(words.difference(out)):
            out.update(zip(part, zip(tokens.tolist(), best.tolist())))
        return out

    def _grow(self, words: Iterable[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
        """Inserts pre-tokens of ordinary length: parts of them with their token counts and scores."""
        ordered, step = sorted(words), min(CHUNK, MAX_NODES)
        for at in range(0, len(ordered), step):
            part = ordered[at : at + step]
            tokens, best = self._insert(part)
            self._keep(part, tokens, best)
            yield part, tokens, best

    def _keep(self, words: list[str], tokens: np.ndarray, best: np.ndarray) -> None:
        first = len(self.terminal)
        if first + len(words) > MAX_NODES:
            self._begin()
            first = 0
        last = first + len(words)
        if last > len(self.best):
            room = min(MAX_NODES, max(last, 2 * len(self.best)))
            self.best, self.tokens = (np.concatenate([x[:first], np.empty(room - first, x.dtype)]) for x in (self.best, self.tokens))
        self.best[first:last], self.tokens[first:last] = best, tokens
        self.terminal.update(zip(words, range(first, last)))

    def known(self, word: str) -> tuple[int, float] | None:
        """The result at the terminal node of ``word``, if it has one."""
        node = self.terminal.get(word)
        return None if node is None else (int(self.tokens[node]), float(self.best[node]))

    def results(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token counts and scores of a list of pre-tokens, which may repeat."""
        step = min(RUN, MAX_NODES)
        parts = [self._results(words[at : at + step]) for at in range(0, len(words), step)]
        if not parts:
            return np.empty(0, np.int64), np.empty(0)
        return tuple(np.concatenate(x) for x in zip(*parts))

    def _results(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        nodes = np.array(list(map(self.terminal.get, words)), dtype=float)  # nan: no node
        rest = np.flatnonzero(np.isnan(nodes)).tolist()
        new = {words[k] for k in rest}
        if len(self.terminal) + len(new) > MAX_NODES:  # all of the run must have a node at once
            self._begin()
            rest, new = range(len(words)), set(words)
        long = {w: self._alone(w) for w in new if len(w) > LONGEST}
        for _ in self._grow(new.difference(long)):
            pass
        # the nodes of the long pre-tokens come after all others
        place = {w: k for k, w in enumerate(long, len(self.best))}
        nodes[rest] = [place[w] if len(w) > LONGEST else self.terminal[w] for w in (words[k] for k in rest)]
        nodes = nodes.astype(np.int64)
        if not long:
            return self.tokens[nodes], self.best[nodes]
        tokens, best = (np.array(x) for x in zip(*long.values()))
        return np.concatenate([self.tokens, tokens])[nodes], np.concatenate([self.best, best])[nodes]


def pre_tokens(text: str) -> list[str]:
    """Words with their leading spaces as marks; the text counts as starting with a space."""
    return _WORD.findall(SPACE + text.replace(" ", SPACE)) if text else []


_COUNTERS: dict[str, TrieCounter] = {}


def _counter_of(key: str, scores: dict[str, float]) -> TrieCounter:
    only_memo("unigram", _COUNTERS.clear)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = TrieCounter(scores)
    return _COUNTERS[key]


def count_tokens(
    df: DataFrame, scores: dict[str, float], key: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, n_pretokens, n_tokens and the log score of the best segmentation.

    ``scores`` is a vocabulary of fixed size (broadcast); ``key`` names it.
    """
    shared = df.sparkSession.sparkContext.broadcast(scores)
    kind = df.schema[id_col].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter_of(key, shared.value)
        for batch in small_batches(batches, text_col, 2 << 20):
            split = [pre_tokens(t) for t in text_column(batch, text_col)]
            sizes = [len(w) for w in split]
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            tokens, scores = counter.results(list(chain.from_iterable(split)))
            totals = np.concatenate([[0], np.cumsum(tokens)])[ends]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(id_col),
                    pa.array(sizes, pa.int64()),
                    pa.array(np.diff(totals), pa.int64()),
                    pa.array(np.array([math.fsum(scores[a:b].tolist()) for a, b in zip(ends, ends[1:])], dtype=float)),
                ],
                [id_col, "n_pretokens", "n_tokens", "log_score"],
            )

    return df.select(id_col, text_col).mapInArrow(count, f"`{id_col}` {kind}, n_pretokens bigint, n_tokens bigint, log_score double")
