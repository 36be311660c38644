"""SentencePiece encoding and decoding for merge-type (BPE) models.

Encoding finds the one token sequence the merges would give without running them over
the text: an Aho-Corasick pass lists the longest piece at every position, the encoder
takes it and backs off to shorter prefixes, adjacent tokens must be compatible (merging
their joined text again gives back the same two tokens; answers are memoised), and a
bitfield marks positions from which no valid sequence was found. A sequence of pairwise
compatible tokens is unique, so the result is exact.

No piece has a space mark after another character, so a text falls apart at word starts
and words are encoded independently; a bounded per-process memo keeps their ids.

Null text counts as empty: no ids and an empty decoded text. Rows stay one to one. Any
length of text or word works; the memo holds only words of at most 64 characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Memo, list_array, only_memo, small_batches, text_column

SPACE = "\u2581"
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
# Entries of a memo generation; a process keeps two at most. A word with its packed ids takes about
# 200 bytes and a pair of ids, one number, 75: 160 MB of words and 75 MB of pairs at the very most.
MEMO_WORDS = 400_000
MEMO_PAIRS = 500_000


@dataclass(frozen=True)
class PieceModel:
    """The vocabulary of a merge-type model: pieces by id, merge scores, special ids."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    byte_ids: tuple[int, ...]  # id of each byte value
    special: frozenset[int]
    unk_id: int
    key: str = field(default="")

    @classmethod
    def load(cls, path: str) -> PieceModel:
        """Read a .model file; the path must be readable by the driver only."""
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        pieces = tuple(sp.id_to_piece(i) for i in ids)
        byte = {pieces[i]: i for i in ids if sp.is_byte(i)}
        if len(byte) != 256:
            raise ValueError("the model needs byte fallback")
        special = frozenset(i for i in ids if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
        return cls(pieces, tuple(sp.get_score(i) for i in ids), tuple(byte[f"<0x{b:02X}>"] for b in range(256)),
                   special, sp.unk_id(), path)


class PieceEncoder:
    """Encoder and decoder of one process; words are memoised as packed int32 ids."""

    def __init__(self, model: PieceModel):
        skip = model.special | set(model.byte_ids)
        self.ids = {p: i for i, p in enumerate(model.pieces) if i not in skip}
        self.scores = {p: model.scores[i] for p, i in self.ids.items()}
        self.byte_ids = model.byte_ids
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            self.automaton.add_word(p, len(p))
        self.automaton.make_automaton()
        chars = "".join(re.escape(p) for p in self.ids if len(p) == 1)
        self.runs = re.compile(f"[{chars}]+|[^{chars}]+")
        self.known = {p for p in self.ids if len(p) == 1}
        self.shorter: dict[str, int] = {}
        self.pairs = Memo(self._merges_to, MEMO_PAIRS)
        self.words = Memo(self._packed, MEMO_WORDS)
        self.decoded = [b"" if i in model.special else p.replace(SPACE, " ").encode() for i, p in enumerate(model.pieces)]
        for value, i in enumerate(model.byte_ids):
            self.decoded[i] = bytes([value])
        self.decoded[model.unk_id] = " \u2047 ".encode()
        self.bytes_only = set(model.byte_ids)
        self.pieces = model.pieces

    def merge(self, text: str) -> list[str]:
        """Plain merging: the best-scored adjacent pair first, the leftmost on ties."""
        parts = list(text)
        score = self.scores.get
        none = float("-inf")
        gains = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while gains and (best := max(gains)) > none:
            at = gains.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del gains[at]
            if at:
                gains[at - 1] = score(parts[at - 1] + parts[at], none)
            if at < len(gains):
                gains[at] = score(parts[at] + parts[at + 1], none)
        return parts

    def _merges_to(self, pair: int) -> bool:
        """Whether merging the joined text gives back the two tokens (one, if there is no left one). A pair is
        the left id plus one (0: none) times the number of pieces, plus the right id."""
        left, right = divmod(pair, len(self.pieces))
        parts = [self.pieces[left - 1], self.pieces[right]] if left else [self.pieces[right]]
        return self.merge("".join(parts)) == parts

    def shorter_prefix(self, piece: str) -> int:
        """Length of the longest proper prefix that is a piece; 0 if there is none."""
        n = self.shorter.get(piece)
        if n is None:
            n = len(piece) - 1
            while n and piece[:n] not in self.ids:
                n -= 1
            self.shorter[piece] = n
        return n

    def encode_run(self, text: str) -> list[int]:
        """Ids of a text whose characters are all in the vocabulary."""
        n = len(text)
        longest = [1] * n
        for end, size in self.automaton.iter(text):
            start = end - size + 1
            if size > longest[start]:
                longest[start] = size
        failed = bytearray(n // 8 + 1)  # bit i: no valid sequence passes position i
        tried = False  # whether any bit is set
        tokens: list[int] = []
        pairs, shorter, ids, many = self.pairs, self.shorter, self.ids, len(self.pieces)
        last, at, size = 0, 0, longest[0]  # the empty start (0) is compatible with every sound piece
        while True:
            end = at + size
            piece = text[at:end]
            if not (tried and failed[end >> 3] >> (end & 7) & 1):
                number = ids[piece]
                if pairs[last * many + number]:
                    tokens.append(number)
                    if end == n:
                        return tokens
                    last, at, size = number + 1, end, longest[end]
                    continue
            size = shorter.get(piece)
            if size is None:
                size = self.shorter_prefix(piece)
            while not size:
                failed[at >> 3] |= 1 << (at & 7)
                tried = True
                piece = self.pieces[tokens.pop()]
                at -= len(piece)
                last = tokens[-1] + 1 if tokens else 0
                size = self.shorter_prefix(piece)

    def encode_word(self, word: str) -> list[int]:
        if self.known.issuperset(word):
            return self.encode_run(word)
        out: list[int] = []
        for run in self.runs.findall(word):
            if run[0] in self.known:
                out += self.encode_run(run)
            else:
                out += [self.byte_ids[b] for b in run.encode("utf-8", "surrogatepass")]
        return out

    def _packed(self, word: str) -> bytes:
        return np.array(self.encode_word(word), dtype=np.int32).tobytes()

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text as int32."""
        if not text:
            return np.empty(0, dtype=np.int32)
        words = _WORD.findall(SPACE + text.replace(" ", SPACE))
        known = self.words
        ids = [known[w] if len(w) <= 64 else self._packed(w) for w in words]
        return np.frombuffer(b"".join(ids), dtype=np.int32)

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """The text of ids; the space that encoding puts first is dropped."""
        table = self.decoded
        values = ids.tolist() if isinstance(ids, np.ndarray) else list(ids)
        text = b"".join([table[i] for i in values]).decode("utf-8", "replace")
        first = next((i for i in values if table[i]), None)
        return text[1:] if first is not None and self.pieces[first].startswith(SPACE) else text


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder_of(model: PieceModel) -> PieceEncoder:
    """One encoder per process and model."""
    only_memo("pieces", _ENCODERS.clear)
    if model.key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[model.key] = PieceEncoder(model)
    return _ENCODERS[model.key]


def encode_pieces(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: all its columns' id, ``ids`` (array of int) and ``decoded``.

    The model (a vocabulary of fixed size) is read on the driver and broadcast.
    """
    model = df.sparkSession.sparkContext.broadcast(PieceModel.load(model_path))
    kind = df.schema[id_col].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder_of(model.value)
        for batch in small_batches(batches, text_col):
            ids = [coder.encode(t) for t in text_column(batch, text_col)]
            texts = pa.array([coder.decode(i) for i in ids], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), list_array(ids, pa.int32()), texts], [id_col, "ids", "decoded"]
            )

    return df.select(id_col, text_col).mapInArrow(encode, f"`{id_col}` {kind}, ids array<int>, decoded string")


def add_piece_ids(df: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """All rows and columns plus ``ids`` and ``n_tokens``; a clashing name is replaced."""
    model = df.sparkSession.sparkContext.broadcast(PieceModel.load(model_path))
    df = df.drop("ids", "n_tokens")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder_of(model.value)
        for batch in small_batches(batches, text_col):
            ids = [coder.encode(t) for t in text_column(batch, text_col)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, list_array(ids, pa.int32()), pa.array([len(i) for i in ids], pa.int64())],
                [*batch.schema.names, "ids", "n_tokens"],
            )

    return df.mapInArrow(encode, f"{ddl}, ids array<int>, n_tokens bigint")
