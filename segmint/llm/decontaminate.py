"""Benchmark decontamination: BM25 over test items, block-max WAND, overlap check.

The test items are the index and the passages of the training documents are the queries.
Scores are BM25 divided by the item's score for its own text, so 1.0 means that every word
of the item occurs in the passage; all items at ``threshold`` or above are retrieved.
Items are split by length (powers of two); a document is read in windows of twice the
longest length of a class, overlapping by half, so an item always lies whole in one.

Postings are cut into blocks of consecutive items with the largest impact of each term.
The sum of a window's block maxima is computed for all windows of a document at once;
only blocks that can reach the threshold are opened, and WAND walks their postings.
Every retrieved window of an item is verified, and the best verified one is reported: the share of the question's and of the answer's word
trigrams that occur in the window. The answer is the item's last sentence (the last
quarter of the words, if there is only one sentence).

The index is broadcast in parts of a bounded number of characters, one at a time: a larger
benchmark takes more passes over the documents, each written before the next part is built.
Of a long text only word numbers, one slice's words and one slice's block sums are held.
In scripts written without spaces every character is a word.

Null and empty texts and items match nothing; equal items are all reported; repeated rows
give repeated results; a document's id may be null. Extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only_memo, small_batches, stage, text_column

WORD = re.compile(r"\w+")
#: Thai, Lao, Burmese, Khmer, kana and Han: written without spaces.
_SPACELESS = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
SPACELESS = re.compile(f"[{_SPACELESS}]")
MIXED_WORD = re.compile(f"[{_SPACELESS}]|[^\\W{_SPACELESS}]+")
#: Where a long text may be cut: part of no word, or a word alone, and no part of a letter's context.
_CUT = re.compile(f'[\\s,;|<>/(){{}}\\[\\]="&{_SPACELESS}-]')
SENTENCE_END = re.compile(r"[.!?]+\s+|[。！？]+|\n+")
K1, B = 1.2, 0.75
BLOCKS = 32  # blocks of a length class at most
INDEX_CHARS = 2_000_000  # characters of test items in one broadcast part
SLICE_CHARS = 1_000_000  # characters of a text whose words are held at a time, about
SLICE_WORDS = 32_768  # words of a text whose block sums are held at a time, about


def words_of(text: str) -> list[str]:
    text = text.lower()
    return (WORD if text.isascii() or not SPACELESS.search(text) else MIXED_WORD).findall(text)


class TextWords:
    """The words of a text by position, of which one slice is held at a time."""

    def __init__(self, text: str):
        self.slices, at = [], 0  # pieces of the text, cut at characters that are part of no word
        while len(text) - at > SLICE_CHARS:
            cut = _CUT.search(text, at + SLICE_CHARS)
            if cut is None:
                break
            self.slices.append(text[at : cut.start()])
            at = cut.start()
        self.slices.append(text[at:] if at else text)
        self.firsts = [0]  # number of the first word of each slice, and of all words
        self.open = (-1, [])

    def numbers(self, terms: dict[str, int]) -> np.ndarray:
        """The term of every word, 0 if it is none."""
        get, parts = terms.get, []
        for i in range(len(self.slices)):
            words = self._slice(i)
            parts.append(np.array([get(w, 0) for w in words], dtype=np.int32))
            if len(self.firsts) == i + 1:
                self.firsts.append(self.firsts[-1] + len(words))
        return np.concatenate(parts)

    def _slice(self, i: int) -> list[str]:
        if self.open[0] != i:
            self.open = (i, words_of(self.slices[i]))
        return self.open[1]

    def between(self, low: int, high: int) -> list[str]:
        """Words ``low`` to ``high`` (excluded, or the end); ``numbers`` has been called."""
        out = []
        i = max(0, bisect_right(self.firsts, low) - 1)
        while i < len(self.slices) and self.firsts[i] < high:
            first = self.firsts[i]
            out += self._slice(i)[max(0, low - first) : high - first]
            i += 1
        return out


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The words before and of the last sentence."""
    parts = [w for w in map(words_of, SENTENCE_END.split(text)) if w]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0] if parts else []
    cut = len(words) - max(1, len(words) // 4)
    return words[:cut], words[cut:]


def _grams(words: list[str]) -> set[tuple[str, ...]]:
    n = min(3, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


@dataclass
class LengthClass:
    """Items of one length class, their postings and block maxima."""

    longest: int
    items: list[int]  # positions in the index, ascending
    block_size: int
    maxima: np.ndarray  # (terms + 1, blocks), float32; row 0 is for unknown words
    postings: dict[int, list[tuple[int, float]]]  # term -> (item number in the class, impact)


class ItemIndex:
    """Inverted index of one part of the test items, split by length."""

    def __init__(self, items: list[tuple[int | None, str]], frequency: dict[str, int], n_items: int, mean_length: float):
        self.ids = [i for i, _ in items]
        texts = [words_of(t) for _, t in items]
        self.terms = {w: k + 1 for k, w in enumerate(sorted(set().union(*texts)))}
        self.parts = [question_and_answer(t) for _, t in items]
        by_class: dict[int, list[int]] = {}
        for i, words in enumerate(texts):
            if words:
                by_class.setdefault(max(8, 1 << (len(words) - 1).bit_length()), []).append(i)
        self.classes = []
        for longest, members in sorted(by_class.items()):
            size = -(-len(members) // BLOCKS)
            maxima = np.zeros((len(self.terms) + 1, -(-len(members) // size)), np.float32)
            postings: dict[int, list[tuple[int, float]]] = {}
            for number, i in enumerate(members):
                counts: dict[str, int] = {}
                for w in texts[i]:
                    counts[w] = counts.get(w, 0) + 1
                norm = K1 * (1 - B + B * len(texts[i]) / mean_length)
                impact = {}
                for w, tf in counts.items():
                    df = frequency[w]
                    impact[w] = np.log1p((n_items - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + norm)
                own = sum(impact.values())
                for w, x in impact.items():
                    t, share = self.terms[w], float(x / own)
                    postings.setdefault(t, []).append((number, share))
                    maxima[t, number // size] = max(maxima[t, number // size], share)
            self.classes.append(LengthClass(longest, members, size, maxima * np.float32(1.0001), postings))

    def search(self, text: str, threshold: float) -> dict[int, tuple[float, int, list[str]]]:
        """item position -> (best score, window start, window words) for all items at threshold or above."""
        found: dict[int, tuple[float, int, list[str]]] = {}
        for i, score, at, window in self.candidates(text, threshold):
            if i not in found or score > found[i][0]:
                found[i] = (score, at, window)
        return found

    def candidates(self, text: str, threshold: float) -> Iterator[tuple[int, float, int, list[str]]]:
        """(item position, score, window start, window words) of every window and item at threshold or above."""
        words = TextWords(text)
        ids = words.numbers(self.terms)
        known = np.flatnonzero(ids)
        if not len(known):
            return
        for part in self.classes:
            step = part.longest
            every = np.arange(0, max(1, len(ids) - step), step)
            size = max(1, SLICE_WORDS // step)
            for starts in (every[i : i + size] for i in range(0, len(every), size)):
                own = known[np.searchsorted(known, starts[0]) : np.searchsorted(known, starts[-1] + 2 * step)]
                # running sums of block maxima over known words: a window's bound is a difference
                sums = np.zeros((len(own) + 1, part.maxima.shape[1]))
                np.cumsum(part.maxima[ids[own]], axis=0, out=sums[1:], dtype=np.float64)
                low, high = np.searchsorted(own, starts), np.searchsorted(own, starts + 2 * step)
                bounds = sums[high] - sums[low]
                for w in np.flatnonzero((bounds >= threshold).any(axis=1)):
                    terms = np.unique(ids[own[low[w] : high[w]]])  # repeated words count once
                    once = part.maxima[terms].sum(axis=0, dtype=np.float64)
                    window = None
                    for block in np.flatnonzero(once >= threshold).tolist():
                        for number, score in self._wand(part, terms.tolist(), block, threshold):
                            at = int(starts[w])
                            window = window or words.between(at, at + 2 * step)
                            yield part.items[number], score, at, window

    def _wand(self, part: LengthClass, terms: list[int], block: int, threshold: float) -> Iterator[tuple[int, float]]:
        """Items of a block that score the threshold or more, by pivoting on block maxima."""
        first, limit = block * part.block_size, (block + 1) * part.block_size
        cursors = []  # [current item, block maximum, postings in the block, position]
        for t in terms:
            top = float(part.maxima[t, block])
            if top > 0:
                inside = [p for p in part.postings[t] if first <= p[0] < limit]
                cursors.append([inside[0][0], top, inside, 0])
        while cursors:
            cursors.sort(key=lambda c: c[0])
            total, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                total += c[1]
                if total >= threshold:
                    pivot = k
                    break
            if pivot < 0:
                return
            item = cursors[pivot][0]
            if cursors[0][0] == item:
                score = sum(c[2][c[3]][1] for c in cursors if c[0] == item)
                if score >= threshold:
                    yield item, score
                target = item + 1
            else:
                target = item
            for c in cursors:
                if c[0] < target:
                    while c[3] < len(c[2]) and c[2][c[3]][0] < target:
                        c[3] += 1
                    c[0] = c[2][c[3]][0] if c[3] < len(c[2]) else limit
            cursors = [c for c in cursors if c[0] < limit]

    def matches(self, text: str, threshold: float, question: float, answer: float) -> list[tuple]:
        """(item id, score, question overlap, answer overlap) of the best verified window of each item."""
        best: dict[int, tuple] = {}
        for i, score, _, window in self.candidates(text, threshold):
            if i in best and round(best[i][1], 9) > round(min(1.0, score), 9):
                continue  # a better window is verified
            overlaps = []
            for words in self.parts[i]:
                wanted = _grams(words)
                n = min(3, len(words))
                have = {tuple(window[k : k + n]) for k in range(len(window) - n + 1)} if n else set()
                overlaps.append(len(wanted & have) / len(wanted) if wanted else 1.0)
            if overlaps[0] >= question and overlaps[1] >= answer:
                match = (self.ids[i], min(1.0, score), *overlaps)
                if i not in best or (round(match[1], 9), *overlaps) > (round(best[i][1], 9), *best[i][2:]):
                    best[i] = match
        return [best[i] for i in sorted(best)]


def build_indexes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[tuple[Broadcast, bool]]:
    """Broadcast index parts of at most about INDEX_CHARS and whether there are more than one;
    statistics cover all items. A part is built when it is asked for."""
    spark = benchmark.sparkSession

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [words_of(t) for t in text_column(batch, "text")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(words, pa.list_(pa.string()))], ["item_id", "text", "words"])

    rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    items = stage(rows.mapInArrow(split, "item_id bigint, text string, words array<string>"), "items")
    n, mean, chars = items.where(F.size("words") > 0).agg(
        F.count(F.lit(1)), F.avg(F.size("words")), F.sum(F.length("text"))
    ).first()
    if not n:
        return
    parts = -(-chars // INDEX_CHARS)
    items = items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))
    terms = items.select("part", F.explode(F.array_distinct("words")).alias("term"))
    frequency = stage(terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "frequency")
    for part in range(parts):  # each collects one bounded part
        own = sorted(((r[0], r[1]) for r in items.where(F.col("part") == part).select("item_id", "text").collect()), key=lambda r: (r[0] is None, r))
        df = frequency.join(terms.where(F.col("part") == part).select("term").distinct(), "term", "left_semi")
        yield spark.sparkContext.broadcast(ItemIndex(own, {r[0]: r[1] for r in df.collect()}, n, mean)), parts > 1


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, threshold: float = 0.6, question: float = 0.6, answer: float = 0.5,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document row and verified item: id, item_id, score and both overlaps."""
    kind = docs.schema[id_col].dataType
    ddl = f"`{id_col}` {kind.simpleString()}, item_id bigint, score double, question_overlap double, answer_overlap double"
    rows = docs.select(id_col, text_col)

    def scan(index: Broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            only_memo("index", lambda: None)
            for batch in small_batches(batches, text_col):
                owner, found = [], []
                for i, text in enumerate(text_column(batch, text_col)):
                    for match in index.value.matches(text, threshold, question, answer):
                        owner.append(i)
                        found.append(match)
                columns = [pa.array([m[k] for m in found], t) for k, t in enumerate([pa.int64()] + [pa.float64()] * 3)]
                ids = batch.column(id_col).take(pa.array(owner, pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, *columns], [id_col, "item_id", "score", "question_overlap", "answer_overlap"])

        return run

    parts = []
    for index, several in build_indexes(benchmark):
        found = rows.mapInArrow(scan(index), ddl)
        if several:  # written, so that this part's broadcast can go before the next is built
            found = stage(found, "leaks")
            index.destroy()
        parts.append(found)
    if not parts:
        return docs.sparkSession.createDataFrame([], ddl)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, threshold: float = 0.6, question: float = 0.6, answer: float = 0.5, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` whose text holds no verified item, unchanged."""

    def keep(index: Broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            only_memo("index", lambda: None)
            for batch in small_batches(batches, text_col):
                clean = [not index.value.matches(t, threshold, question, answer) for t in text_column(batch, text_col)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return run

    for index, several in build_indexes(benchmark):
        docs = docs.mapInArrow(keep(index), docs.schema)
        if several:
            docs = stage(docs, "clean")
            index.destroy()
    return docs
