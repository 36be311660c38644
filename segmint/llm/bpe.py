"""Byte-level BPE encoding and decoding with a rank file, as a fold over ranked merges.

A text is cut into pre-tokens ("words"). Each distinct word is encoded once, over its bytes:

* the substrings that have a rank, sorted by it, are the word's ranked merges. The task that
  cuts the text lists them with an automaton of the tokens, which passes a word once; words
  that come without (the shared ones below) have every substring looked up in the rank map, a
  literal of the plan (an array of small maps by hash, so that a lookup does not scan the
  vocabulary);
* Spark's higher-order functions fold (``aggregate``) the merges over the set of piece
  boundaries, a bit mask: a merge applies when its substring consists of exactly two current
  pieces, and clears the boundary between;
* the ranks of the pieces that are left are the ids.

Taking each merge once, in rank order, gives what repeated "lowest rank first, leftmost on
ties" gives if every token of the file is itself such a merge of two pieces of lower rank.
``RankFile.load`` checks that for every token and refuses a file where it does not hold.

"Distinct" has two levels. Words that several tasks meet, at most ``SHARED_WORDS`` of them,
are encoded once and broadcast. Of the rest each task encodes a word once per generation
of ``TASK_WORDS`` words. The documents stay where they are: the task that cuts a text
writes its new words as rows before the document's row, the fold encodes them on their
way, and the next step of the same task puts the documents together. So nothing but the
word counts is shuffled.

Decoding concatenates the binary pieces of the ids.

Null text counts as empty: no ids, empty bytes. Rows stay one to one; a repeated or null id
is kept as it is. Other columns of the input, whatever their names, are not read. Words of
more than ``FOLD_BYTES`` bytes (the fold is quadratic in them) are merged with a heap in the
task that cuts them, with equal results, so no length of text or word is refused.
"""

from __future__ import annotations

import base64
import heapq
import re
import sys
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from json import dumps

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import list_array, only_memo, small_batches, stage, text_column

FOLD_BYTES = 62  # boundaries of a word as the bits of a long
SHARED_WORDS = 1 << 18  # bound of the broadcast dictionary, in words
TASK_WORDS = 400_000  # words a task remembers before it starts anew
WORD_ROWS = 4_096  # words that are sent to the fold at a time
MOST_SPANS = 1 << 11  # substrings of such a word, and room
RANK_BUCKETS = 1 << 16
HASH_SEED = 42  # of Spark's xxhash64

# The white space of the pre-token pattern (Unicode White_Space).
WHITE = r"\t-\r \x85\xa0  -     　"


@cache
def _other_numbers() -> str:
    """The numbers that are no decimal digits (Nl and No)."""
    return "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) in ("Nl", "No"))


def word_pattern(numbers: str = "") -> str:
    """The public pre-token pattern for Python's ``re``, which has no ``\\p``: what ``\\w`` holds
    besides letters, decimal digits and the underscore are the other numbers. Without them the
    pattern is right for texts that have none, and much faster."""
    return (
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_{numbers}]+| ?[\d{numbers}]+"
        rf"| ?(?:[^\w{WHITE}]|_)+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
    )


class WordCutter:
    """Cuts texts into pre-tokens."""

    def __init__(self, numbers: str | None = None):
        self.numbers = frozenset(_other_numbers() if numbers is None else numbers)
        self.plain = re.compile(word_pattern()).findall
        self.full = re.compile(word_pattern("".join(sorted(self.numbers)))).findall

    def __call__(self, text: str) -> list[str]:
        return self.plain(text) if text.isascii() or self.numbers.isdisjoint(text) else self.full(text)


@dataclass(frozen=True)
class RankFile:
    """Token bytes by rank (the rank is the id)."""

    tokens: tuple[bytes, ...]

    @classmethod
    def load(cls, path: str) -> RankFile:
        """Read a rank file (base64 token, rank; one a line); the driver alone reads the path."""
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}
        tokens = sorted(ranks, key=ranks.__getitem__)
        if [ranks[t] for t in tokens] != list(range(len(tokens))):
            raise ValueError("ranks must be 0, 1, 2 ... without gaps")
        if not all(bytes([b]) in ranks for b in range(256)):
            raise ValueError("every byte must be a token")
        for token, rank in ranks.items():
            if len(token) > 1 and len(merge(token, ranks, below=rank)) != 2:
                raise ValueError(f"token {token!r} is not a merge of two pieces of lower rank")
        return cls(tuple(tokens))


def merge(word: bytes, ranks: dict[bytes, int], below: int | None = None) -> list[bytes]:
    """Pieces of a word, lowest rank first and leftmost on ties, by a heap of merges."""
    n = len(word)
    after = list(range(1, n + 1))  # end of the piece that starts at a position; 0: no start
    before = list(range(-1, n))  # start of the piece that ends at a position
    top = len(ranks) if below is None else below
    heap: list[tuple[int, int, int]] = []

    def offer(start: int, end: int) -> None:
        rank = ranks.get(word[start:end], top)
        if rank < top:
            heapq.heappush(heap, (rank, start, end))

    for i in range(n - 1):
        offer(i, i + 2)
    while heap:
        _, start, end = heapq.heappop(heap)
        middle = after[start]
        if not middle or middle >= end or after[middle] != end:
            continue  # one of the two pieces is gone
        after[start], after[middle], before[end] = end, 0, start
        if start:
            offer(before[start], end)
        if end < n:
            offer(start, after[end])
    starts = [i for i in range(n) if after[i]]
    return [word[i : after[i]] for i in starts]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def rank_map(file: RankFile) -> Column:
    """The rank map as a literal: by hash of the token, a small map token -> rank. Bytes are
    characters of the same number here and in the fold (ISO 8859-1)."""
    buckets: list[dict[str, int]] = [{} for _ in range(RANK_BUCKETS)]
    for rank, token in enumerate(file.tokens):
        key = token.decode("latin-1")
        buckets[xxhash.xxh64_intdigest(key.encode(), HASH_SEED) % RANK_BUCKETS][key] = rank
    return F.from_json(F.lit(dumps(buckets, separators=(",", ":"))), "array<map<string,int>>")


def _rank_of(ranks: Column, piece: Column) -> Column:
    return F.get(ranks, F.xxhash64(piece).bitwiseAND(F.lit(RANK_BUCKETS - 1)).cast("int"))[piece]


def _spans() -> Column:
    """All substrings of a word by end, as a literal: place ``a`` and length ``n``, the boundaries inside
    (``i``) and with both ends (``f``). Those of a shorter word come first."""
    spans = [
        {"a": s + 1, "n": e - s, "f": (1 << (e + 1)) - (1 << s), "i": (1 << e) - (2 << s)}
        for e in range(2, FOLD_BYTES + 1)
        for s in range(e - 1)
    ]
    return F.from_json(F.lit(dumps(spans, separators=(",", ":"))), "array<struct<a:int,n:int,f:bigint,i:bigint>>")


class MergeFinder:
    """The ranked merges of a word of at most ``FOLD_BYTES`` bytes: for each of its substrings that
    has a rank, the rank and, in the lower bits, the number of its span (see ``_spans``), sorted."""

    def __init__(self, tokens: tuple[bytes, ...]):
        self.automaton = ahocorasick.Automaton()
        for rank, token in enumerate(tokens):
            if 1 < len(token) <= FOLD_BYTES:
                # the span from s to e has number (e - 1) * (e - 2) / 2 + s, and s is e less the length
                self.automaton.add_word(token.decode("latin-1"), rank * MOST_SPANS - len(token))
        self.automaton.make_automaton()
        self.ends = [e * (e - 1) // 2 + e + 1 for e in range(FOLD_BYTES)]  # by place of the last byte

    def __call__(self, word: bytes) -> list[int]:
        ends = self.ends
        return sorted([start + ends[last] for last, start in self.automaton.iter(word.decode("latin-1"))])


def fold_merges(word: Column, ranks: Column, merges: Column | None = None) -> Column:
    """``array<int>``: the ids of a word of 1 to ``FOLD_BYTES`` bytes; ``merges`` are its ranked merges,
    if they are known."""
    size = F.octet_length(word)

    def over(text: Column, ranks: Column, spans: Column) -> Column:
        if merges is None:
            inside = F.slice(spans, F.lit(1), F.floor(size * (size - 1) / 2).cast("int"))
            # a merge is its rank and, in the lower bits, the number of its span
            found = F.transform(
                inside, lambda x, i: _rank_of(ranks, F.substring(text, x["a"], x["n"])).cast("long") * MOST_SPANS + i
            )
            ordered = F.sort_array(F.array_compact(found))
        else:
            ordered = merges

        def apply(mask: Column, merge: Column) -> Column:
            span = F.get(spans, merge.bitwiseAND(F.lit(MOST_SPANS - 1)).cast("int"))
            two = (F.bit_count(mask.bitwiseAND(span["i"])) == 1) & (F.bit_count(mask.bitwiseAND(span["f"])) == 3)
            return F.when(two, mask.bitwiseAND(F.bitwise_not(span["i"]))).otherwise(mask)

        every = F.call_function("shiftleft", F.lit(2).cast("long"), size) - 1
        mask = F.aggregate(ordered, every, apply)

        def pieces(mask: Column) -> Column:
            at = F.filter(
                F.sequence(F.lit(0), size),
                lambda i: F.call_function("shiftrightunsigned", mask, i).bitwiseAND(F.lit(1)) == 1,
            )
            return _let(
                at,
                lambda b: F.transform(
                    F.sequence(F.lit(1), F.size(b) - 1),
                    lambda i: _rank_of(ranks, F.substring(text, F.get(b, i - 1) + 1, F.get(b, i) - F.get(b, i - 1))),
                ),
            )

        return _let(mask, pieces)

    return _let(F.decode(word, "ISO-8859-1"), lambda d: _let(ranks, lambda r: _let(_spans(), lambda s: over(d, r, s))))


@dataclass(frozen=True)
class WordTable:
    """Words and their ids, flat: word ``k`` has ``ids[starts[k] : starts[k + 1]]``."""

    words: list[bytes]
    ids: np.ndarray
    starts: np.ndarray


def _with_merges(words: DataFrame, tokens: Broadcast) -> DataFrame:
    """``word`` (of at most ``FOLD_BYTES`` bytes) and its ranked ``merges``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges_of = _finder_of(tokens)
        for batch in batches:
            for at in range(0, batch.num_rows, WORD_ROWS):
                part = batch.column("word").slice(at, WORD_ROWS)
                merges = [np.array(merges_of(w), dtype=np.int64) for w in part.to_pylist()]
                yield pa.RecordBatch.from_arrays([part, list_array(merges, pa.int64())], ["word", "merges"])

    return words.select("word").mapInArrow(add, "word binary, merges array<bigint>")


def _shared_words(texts: DataFrame, text_col: str, ranks: Column, tokens: Broadcast | None = None) -> WordTable:
    """The words that most tasks meet (each more than one), encoded: as many of the most common
    counts as have at most ``SHARED_WORDS`` words together. Given the tokens, an automaton lists
    the merges."""
    numbers = _other_numbers()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = WordCutter(numbers)
        met: set[str] = set()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([w.encode() for w in met], pa.binary())], ["word"])

        for batch in small_batches(batches, text_col, 2 << 20):
            for text in text_column(batch, text_col):
                met.update(cut(text))
            if len(met) >= TASK_WORDS:
                yield rows()
                met.clear()
        yield rows()

    met = texts.mapInArrow(count, "word binary").where(F.octet_length("word") <= FOLD_BYTES)
    counts = stage(met.groupBy("word").agg(F.count(F.lit(1)).alias("tasks")).where("tasks > 1"), "words")
    histogram = counts.groupBy("tasks").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per count, at most one per task
    total, least = 0, None
    for tasks, n in sorted(((r.tasks, r.n) for r in histogram), reverse=True):
        total += n
        if total > SHARED_WORDS:
            break
        least = tasks
    if least is None:
        return WordTable([], np.empty(0, np.int32), np.zeros(1, np.int64))
    words = counts.where(F.col("tasks") >= least).select("word")
    merges = None if tokens is None else F.col("merges")
    words = words if tokens is None else _with_merges(words, tokens)
    shared = words.select("word", fold_merges(F.col("word"), ranks, merges).alias("ids")).toArrow()
    ids = shared.column("ids").combine_chunks()
    ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    lengths = ids.value_lengths().to_numpy(zero_copy_only=False)
    return WordTable(
        shared.column("word").to_pylist(),
        ids.flatten().to_numpy(zero_copy_only=False).astype(np.int32),
        np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64),
    )


class _Assembler:
    """Ids of words by slot: the shared words first, then those a task has met, in order."""

    def __init__(self, shared: WordTable):
        self.n = self.shared = len(shared.starts) - 1
        self.used = self.shared_used = len(shared.ids)
        self.ids = shared.ids.copy()
        self.starts = shared.starts.copy()

    def forget(self) -> None:
        self.n, self.used = self.shared, self.shared_used

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.ids = self._room(self.ids, self.used + len(ids))
        self.starts = self._room(self.starts, self.n + len(lengths) + 1)
        self.ids[self.used : self.used + len(ids)] = ids
        self.starts[self.n + 1 : self.n + 1 + len(lengths)] = self.used + np.cumsum(lengths)
        self.used += len(ids)
        self.n += len(lengths)

    @staticmethod
    def _room(values: np.ndarray, size: int) -> np.ndarray:
        return values if size <= len(values) else np.resize(values, max(size, 2 * len(values)))

    def texts(self, slots: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts that follow each other, and where each begins, with the end: text ``k``
        has the words ``slots[stops[k] : stops[k + 1]]``."""
        first = self.starts[slots]
        lengths = self.starts[slots + 1] - first
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return self.ids[np.repeat(first - ends[:-1], lengths) + np.arange(ends[-1])], ends[stops]


_FINDERS: dict[tuple[bytes, ...], MergeFinder] = {}


def _finder_of(tokens: Broadcast) -> MergeFinder:
    """One automaton per process and rank file."""
    only_memo("bytes", _FINDERS.clear)
    if tokens.value not in _FINDERS:
        _FINDERS.clear()
        _FINDERS[tokens.value] = MergeFinder(tokens.value)
    return _FINDERS[tokens.value]


NEW, WORD, TEXT = 0, 1, 2  # rows of the step in between: forget the words; a word; a document


def encode_bytes(df: DataFrame, rank_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, ``ids`` (array of int) and ``decoded`` (binary)."""
    context = df.sparkSession.sparkContext
    file = RankFile.load(rank_path)
    ranks = rank_map(file)
    rows = df.select(F.col(id_col), F.col(text_col).alias("_text" if id_col == "text" else "text"))
    text_col = rows.columns[1]
    kind = rows.schema[id_col].dataType.simpleString()
    tokens, numbers = context.broadcast(file.tokens), _other_numbers()
    shared_words = _shared_words(rows.select(text_col), text_col, ranks, tokens)
    # the step that cuts needs the words, the step that puts ids together their ids
    common = context.broadcast(pa.array(shared_words.words, pa.binary()).cast(pa.string()))
    shared = context.broadcast(WordTable([], shared_words.ids, shared_words.starts))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, merges_of = WordCutter(numbers), _finder_of(tokens)
        rank_of: dict[bytes, int] = {}
        slots: dict[str, int] = {}

        def begin() -> None:
            slots.clear()
            for at in range(0, len(common.value), 65536):
                slots.update(zip(common.value.slice(at, 65536).to_pylist(), range(at, len(common.value))))

        def encoded(word: bytes) -> np.ndarray:
            if not rank_of:
                rank_of.update((t, k) for k, t in enumerate(tokens.value))
            return np.array([rank_of[p] for p in merge(word, rank_of)], dtype=np.int32)

        def built(kinds: list[int], words: list[bytes | None], merges: pa.Array, nums: pa.Array, ids: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.int8()), pa.array(words, pa.binary()), merges, nums, ids], ["kind", "word", "merges", "nums", "id"]
            )

        def rows_of(new: list[str], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
            """Some thousand words at a time, for their merges take far more room than they do."""
            for at in range(0, len(new), WORD_ROWS):
                raw = [w.encode() for w in new[at : at + WORD_ROWS]]
                short = [len(w) <= FOLD_BYTES for w in raw]
                merges = [np.array(merges_of(w) if s else [], dtype=np.int64) for w, s in zip(raw, short)]
                nums = [empty if s else encoded(w) for w, s in zip(raw, short)]
                words = [w if s else None for w, s in zip(raw, short)]
                yield built([WORD] * len(raw), words, list_array(merges, pa.int64()), list_array(nums, pa.int32()), pa.nulls(len(raw), kind))

        begin()
        empty = np.empty(0, dtype=np.int32)
        for batch in small_batches(batches, text_col, 2 << 20):
            ids = batch.column(id_col)
            if len(slots) >= len(common.value) + TASK_WORDS:
                begin()
                yield built([NEW], [None], pa.nulls(1, pa.list_(pa.int64())), list_array([empty], pa.int32()), pa.nulls(1, ids.type))
            texts, new = [], []
            for text in text_column(batch, text_col):
                found = find(text)
                for word in set(found).difference(slots):
                    slots[word] = len(slots)
                    new.append(word)
                texts.append(np.fromiter(map(slots.__getitem__, found), np.int32, len(found)))
            yield from rows_of(new, ids.type)
            yield built([TEXT] * len(texts), [None] * len(texts), pa.nulls(len(texts), pa.list_(pa.int64())), list_array(texts, pa.int32()), ids)

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Assembler(shared.value)
        pieces = pa.array(tokens.value, pa.large_binary())
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(kinds)) + 1).tolist(), len(kinds)]
            for a, b in zip(cuts, cuts[1:]):
                part = batch.slice(a, b - a)
                nums = part.column("nums")
                if a < b and kinds[a] == NEW:
                    table.forget()
                elif a < b and kinds[a] == WORD:
                    table.add(nums.flatten().to_numpy(), nums.value_lengths().to_numpy())
                elif a < b:
                    for row in range(0, b - a, 256):
                        some = nums.slice(row, 256)
                        stops = np.concatenate([[0], np.cumsum(some.value_lengths().to_numpy())])
                        ids, starts = table.texts(some.flatten().to_numpy(), stops)
                        # the taken pieces lie one after the other: a text is the bytes of its pieces
                        taken = pieces.take(pa.array(ids))
                        places = np.frombuffer(taken.buffers()[1], np.int64, len(ids) + 1)[starts] if len(ids) else starts
                        texts = pa.LargeBinaryArray.from_buffers(
                            pa.large_binary(), len(some), [None, pa.py_buffer(places.astype(np.int64)), taken.buffers()[2] or pa.py_buffer(b"")]
                        ).cast(pa.binary())
                        lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids, pa.int32()))
                        yield pa.RecordBatch.from_arrays([part.column("id").slice(row, 256), lists, texts], [id_col, "ids", "decoded"])

    parts = rows.mapInArrow(cut, f"kind tinyint, word binary, merges array<bigint>, nums array<int>, id {kind}")
    folded = F.when(F.col("word").isNotNull(), fold_merges(F.col("word"), ranks, F.col("merges"))).otherwise(F.col("nums"))
    parts = parts.select("kind", folded.alias("nums"), "id")
    return parts.mapInArrow(put_together, f"`{id_col}` {kind}, ids array<int>, decoded binary")
