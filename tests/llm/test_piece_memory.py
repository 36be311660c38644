"""Small memo entries of the piece encoder, and slices of batches."""

import random

import pyarrow as pa

from segmint.llm import common, pieces
from segmint.llm.queries import tokenizer_path


def test_pairs_of_pieces_are_remembered_as_numbers():
    rng = random.Random(2)
    coder = pieces.PieceEncoder(pieces.PieceModel.load(tokenizer_path()))
    for _ in range(500):
        coder.encode(" ".join("".join(rng.choices("abcdefghino", k=rng.randrange(1, 12))) for _ in range(20)))
    assert coder.pairs and all(type(p) is int for p in coder.pairs)


def test_slices_by_bytes_count_nulls_as_empty():
    batch = pa.RecordBatch.from_arrays([pa.array(["aa", None, "é", "bbb", ""])], ["text"])
    assert [p.num_rows for p in common.small_batches(iter([batch]), "text", 4)] == [2, 3]
