import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from segmint.llm import neardup  # noqa: E402
from segmint.llm.graph import connected_components  # noqa: E402

SF = "/root/testdata/sf0.01"


def _found(df, **options):
    return {r[0]: tuple(r)[1:] for r in neardup.near_duplicates(df, **options).collect()}


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
def test_near_duplicates_equal_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert _found(docs) == brute.near_groups([tuple(r) for r in docs.collect()])


def test_blocks_of_a_large_group_find_every_link(spark, monkeypatch):
    """More near copies than a block holds, with similarities on both sides of 0.8."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        docs.append((i, " ".join(words)))
    assert _found(spark.createDataFrame(docs, "doc_id long, text string")) == brute.near_groups(docs)


def _half_shared(n, seed=5):
    """Texts of 300 words of which half are the same in all: similarities of about 1/3, no link."""
    rng = random.Random(seed)
    shared = [f"s{i}" for i in range(150)]
    return [(i, " ".join(shared + [f"x{rng.randrange(10**9)}" for _ in range(150)])) for i in range(n)]


def test_shared_boilerplate_leaves_no_candidates(spark, monkeypatch):
    """Documents that only share boilerplate are one component of band keys, but none is compared on its set."""
    compared = []
    real = neardup._compare
    monkeypatch.setattr(neardup, "_compare", lambda steps, *rest: (compared.append(steps.count()), real(steps, *rest))[1])
    docs = _half_shared(1200)
    copies = [(5000 + i, t + " end") for i, t in docs[:20]]
    got = _found(spark.createDataFrame(docs + copies, "doc_id long, text string"))
    for i, _ in docs:
        assert got[i] == (i, i, 1 if i < 20 else 0)
    for i, _ in copies:
        assert got[i] == (i - 5000, i, 1)
    assert compared[0] < 100


def test_survivors_equal_all_pairs_of_the_rounds():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 4, (60, 150)).astype(np.uint32)
    for i in range(1, 60, 3):
        values[i] = np.where(rng.random(150) < 0.85, values[i - 1], values[i])
    needed = neardup.least_matches(0.8, 1e-6, 5)
    pairs = [
        (i, j) for i in range(60) for j in range(i)
        if all((values[i, : 30 * (r + 1)] == values[j, : 30 * (r + 1)]).sum() >= least for r, least in enumerate(needed))
    ]
    want = neardup._least_connected(60, np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
    assert pairs and neardup.survivors(values, np.full(60, 100), 0.8, needed).tolist() == want.tolist()


def test_small_band_blocks_find_every_link(spark, monkeypatch):
    """Large components whose band keys hold several blocks, and blocks limited by grams."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    monkeypatch.setattr(neardup, "BAND_BLOCK", 8)
    monkeypatch.setattr(neardup, "BLOCK_GRAMS", 1000)
    rng = random.Random(4)
    docs = _half_shared(60)
    for i in range(80):
        words = docs[i % 3][1].split()
        for _ in range(rng.randint(0, 12)):
            words[rng.randrange(len(words))] = f"y{rng.randrange(10**6)}"
        docs.append((100 + i, " ".join(words)))
    assert _found(spark.createDataFrame(docs, "doc_id long, text string")) == brute.near_groups(docs)


def test_edge_rows(spark):
    rows = [(1, None, "k"), (2, "", "k"), (3, "a b", "k"), (4, "A, b!", "k"), (5, "a b", "k"), (None, "a b", "k"), (6, "...", "k"),
            (7, "long " * 40000, "k"), (7, "long " * 40000, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, digest string")
    got = sorted((tuple(r) for r in neardup.near_duplicates(df).collect()), key=str)
    want = [(1, 1, 1, 0), (2, 2, 2, 0), (3, 3, 3, 2), (4, 3, 3, 2), (5, 3, 3, 2), (6, 6, 6, 0), (7, 7, 7, 1), (7, 7, 7, 1), (None, None, None, 0)]
    assert got == sorted(want, key=str)
    kept = neardup.keep_one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r[0] for r in kept.collect()), key=str) == sorted([1, 2, 3, 6, 7, None], key=str)
    assert neardup.near_duplicates(df.limit(0)).collect() == []


def test_least_matches_is_the_posterior_bound():
    needed = neardup.least_matches(0.8, 1e-6, 5)
    assert needed == sorted(needed) and 8 <= needed[0] <= 16 and needed[-1] < 0.8 * 150


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    roots = {r[0]: r[1] for r in connected_components(edges).collect()}
    assert roots == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_dense_and_pairwise_intersections_agree():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(30)]
    left, right = np.triu_indices(30, 1)
    every = neardup._intersections(sets, left, right)
    few = np.concatenate([neardup._intersections(sets, left[k : k + 1], right[k : k + 1]) for k in range(len(left))])
    want = [len(set(sets[i].tolist()) & set(sets[j].tolist())) for i, j in zip(left, right)]
    assert every.tolist() == want == few.tolist()
