"""Ranked search, byte-level BPE and the conversation trie against brute force and libraries."""

import hashlib
import math
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from segmint.llm import bpe, ranking, trie
from segmint.llm.queries import RANK_FILE, tokenizer_path

SF = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
CLASH = ["rank", "score", "n", "terms", "norm", "word", "kind", "nums", "decoded", "_run", "c", "d", "x", "pos"]


def _with_clashes(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("clash") for c in CLASH if c not in df.columns})


# --- ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def _ranked(docs, items, k):
    terms = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    terms = [(i, Counter(t), len(t)) for i, t in terms if t]
    n, length = len(terms), sum(x for _, _, x in terms)
    df = Counter(t for _, c, _ in terms for t in c)
    out = []
    for item, text in items:
        asked = Counter(TERM.findall((text or "").translate(LOWER)))
        found = []
        for doc, held, size in terms:
            m = 100 - 75 + (75 * size * n) // length
            score = sum(
                r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * held[t] // (1000 * held[t] + 8 * m))
                for t, r in asked.items() if t in held
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def _search(spark, docs, items, k, **kw):
    d = _with_clashes(spark.createDataFrame(docs, "doc_id long, text string"))
    q = _with_clashes(spark.createDataFrame(items, "item_id long, text string"))
    return sorted((tuple(r) for r in ranking.rank_documents(d, q, k, **kw).select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("bucket", [3, ranking.BUCKET])
@pytest.mark.parametrize("blocks", [400, ranking.BLOCK_CHARS])
def test_ranked_search_equals_brute_force(spark, monkeypatch, bucket, blocks):
    monkeypatch.setattr(ranking, "BUCKET", bucket)
    monkeypatch.setattr(ranking, "BLOCK_CHARS", blocks)
    rng = random.Random(bucket)
    words = ["the", "ÉTÉ", "Éa", "x9", "ß", "中文", "zoo"] + [f"w{i}" for i in range(40)]
    text = lambda n: " ".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=n))
    docs = [(i, text(rng.randrange(1, 60))) for i in range(120)]
    docs += [(200 + i, docs[7][1]) for i in range(30)]  # copies: ties
    docs += [(300, None), (301, ""), (302, " .-_ "), (None, docs[3][1]), (None, docs[3][1]), (5, docs[5][1]), (400, "zoo " * 20000)]
    items = [(i, docs[i][1]) for i in range(0, 40, 3)] + [(900, None), (901, "unknownterm"), (902, "zoo"), (903, "THE the The"), (903, "w1")]
    assert _search(spark, docs, items, 4) == _ranked(docs, items, 4)


def test_ranked_search_of_empty_tables(spark):
    assert _search(spark, [], [(1, "a")], 3) == []
    assert _search(spark, [(1, "a b"), (2, "c")], [], 3) == []
    assert _search(spark, [(1, None), (2, "...")], [(1, "a")], 3) == []


def test_buckets_prune_without_loss():
    """Most vectors are never rescored, and those that count all are."""
    rng = np.random.default_rng(3)
    terms = [np.sort(rng.choice(200, size=rng.integers(1, 30), replace=False)) for _ in range(5000)]
    impacts = [rng.integers(1, 900_000, size=len(t)) for t in terms]
    starts = np.concatenate([[0], np.cumsum([len(t) for t in terms])])
    queries, weights = [], []
    for q in range(20):  # each query is much like one vector
        queries.append(terms[q * 7][np.argsort(-impacts[q * 7])].astype(np.int64))
        weights.append(np.sort(rng.integers(1, 9000, size=len(queries[-1])))[::-1].astype(np.int64))
    block = ranking.QueryBlock(list(range(20)), queries, weights)
    search = ranking.BucketSearch(block, np.zeros(20, np.int64), 200, 5)
    rescored = []
    plain = search._rescore
    search._rescore = lambda q, left, *a: (rescored.append(len(left)), plain(q, left, *a))
    search.add(list(range(5000)), np.concatenate(terms), np.concatenate(impacts), starts)
    for q in range(20):
        dense = np.zeros(200, np.int64)
        dense[queries[q]] = weights[q]
        exact = sorted(((-int((dense[t] * p).sum()), i) for i, (t, p) in enumerate(zip(terms, impacts))))[:5]
        assert [(-s, i) for s, i in exact] == list(zip(search.found[q][0].tolist(), search.found[q][1]))
    assert sum(rescored) < 20 * 5000 / 2


# --- byte-level BPE


@pytest.fixture(scope="module")
def ranks():
    return bpe.RankFile.load(tokenizer_path(RANK_FILE))


@pytest.fixture(scope="module")
def library(ranks):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(ranks.tokens)}, special_tokens={})


def test_pre_tokens_and_merges_equal_the_library(ranks, library):
    """Every code point (surrogates do not occur in a text) in several neighbourhoods."""
    cut = bpe.WordCutter()
    rank_of = {t: i for i, t in enumerate(ranks.tokens)}
    points = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 4096):
        parts = [f"a{chr(c)}1{chr(c)}{chr(c)}! {chr(c)} \n" for c in points[at : at + 4096]]
        plain = "".join(p for p in parts if cut.numbers.isdisjoint(p)) if at == 0 else parts[0]
        for text in ("".join(parts), plain):
            got = [rank_of[p] for w in cut(text) for p in bpe.merge(w.encode(), rank_of)]
            assert got == library.encode_ordinary(text), hex(points[at])


EDGES = ["", None, " ", "a", "don't we'll 'S", " " * 300 + "x", "\n\n \t\r\n", "a" * 5000, "aé" * 40, "中" * 200, "<|endoftext|>", "\x1c\x1d_ __", "0123456789" * 30,
         "word " * 30000, "\U0001f600" * 50, "zażółć gęślą jaźń"]


@pytest.mark.parametrize("task_words", [5, bpe.TASK_WORDS])
def test_encoding_equals_the_library(spark, ranks, library, monkeypatch, task_words):
    monkeypatch.setattr(bpe, "TASK_WORDS", task_words)
    rng = random.Random(1)
    parts = ["the", " the", "é", " ", "\n", "ing", "'re", "9", "中文", "́", "_", "İ", "ſ", "Étion", "x" * 70]
    rows = [(i, t) for i, t in enumerate(EDGES)] + [(3, "a"), (None, "null id"), (None, "null id")]
    rows += [(1000 + i, "".join(rng.choices(parts, k=rng.randrange(40)))) for i in range(300)]
    df = _with_clashes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    found = bpe.encode_bytes(df, tokenizer_path(RANK_FILE)).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    want = sorted(((i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows), key=key)
    assert sorted(((r.doc_id, list(r.ids), bytes(r.decoded)) for r in found), key=key) == want
    assert bpe.encode_bytes(df.limit(0), tokenizer_path(RANK_FILE)).count() == 0


def test_encoding_shares_words_of_several_tasks(spark, ranks, library):
    texts = [f"common words here and {i} there" for i in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "text long, doc string").repartition(4)
    shared = bpe._shared_words(df.select("doc"), "doc", bpe.rank_map(ranks))
    assert b" words" in shared.words
    got = {r.text: list(r.ids) for r in bpe.encode_bytes(df, tokenizer_path(RANK_FILE), "text", "doc").collect()}
    assert got == {i: library.encode_ordinary(t) for i, t in enumerate(texts)}


def test_rank_files_that_are_no_merge_list_are_refused(tmp_path):
    import base64

    path = tmp_path / "ranks"
    tokens = [bytes([b]) for b in range(256)]
    for extra, fits in (([b"ab", b"abc"], True), ([b"abc"], False), ([b"bc", b"ab", b"abc", b"abd", b"abcd"], True)):
        path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens + extra)))
        if fits:
            assert bpe.RankFile.load(str(path)).tokens[256:] == tuple(extra)
        else:
            with pytest.raises(ValueError, match="not a merge"):
                bpe.RankFile.load(str(path))


@needs_data
def test_byte_bpe_query_equals_the_library(spark, library):
    from segmint.llm.queries import op12_byte_bpe

    got = {r.doc_id: r for r in op12_byte_bpe(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids, raw = library.encode_ordinary(r.text or ""), (r.text or "").encode()
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(raw).hexdigest()


# --- conversation trie


def _trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0), role or "", text or ""))
    turns = {c: [t[1:] for t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = turns.get(c - c % 20, [])[:h] + own[h:]
    nodes = defaultdict(list)
    for c, t in built.items():
        for d in range(len(t) + 1):
            nodes[tuple(t[:d])].append(c)
    words = {p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0 for p in nodes}
    below, children = defaultdict(list), Counter()
    for p in nodes:
        for d in range(len(p) + 1):
            below[p[:d]].append(p)
        if p:
            children[p[:-1]] += 1
    return sorted(
        (
            min(m), len(p), min(nodes[p[:-1]]) if p else -1, len(m), children[p], sum(not children[q] for q in below[p]),
            sum((len(nodes[q]) - 1) * words[q] for q in below[p]),
            hashlib.sha256(",".join(str(c) for c in sorted(m) if len(built[c]) == len(p)).encode()).hexdigest(),
        )
        for p, m in nodes.items()
    )


def _conversations(rng):
    texts = ["hello", "hello there you", "", None, " a b  c\n", "same"]
    rows = []
    for c in rng.sample(range(400), 150):
        n = rng.choice([1, 2, 3, 4, 5, 9])
        rows += [(c, t, rng.choice(["user", "assistant", None]), rng.choice(texts)) for t in range(n)]
    rows += [(5000 + i, t, "user", "copy of all") for i in range(60) for t in range(3)]  # copies
    rows += [(40, None, "system", "first"), (40, 0, "user", "tie"), (40, 0, "user", "tie"), (None, 0, "user", "lost"), (None, None, None, None)]
    rows += [(78, t * 5000, "user", f"turn {t % 3}") for t in range(50)]
    rows += [(7, -3, "user", "before"), (80, 0, "user", "alone")]
    return rows


def _found(df):
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.select(*cols).collect())


def test_trie_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(trie, "RUN_BITS", 4)  # many runs
    monkeypatch.setattr(trie, "END_BITS", 3)
    rows = _conversations(random.Random(4)) + [(77, 100 + t, "user", f"turn {t % 3}") for t in range(70)]
    df = _with_clashes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    out = trie.conversation_trie(df)
    assert _found(out) == _trie(rows)
    stored = {}
    for c, turn, role, text in sorted(((c, (t is not None, t or 0), r or "", x or "") for c, t, r, x in rows if c is not None)):
        stored.setdefault(c, []).append((role, text))
    for r in out.where("depth > 0").collect():
        assert len(stored[r.turn_conv_id]) >= r.turn_pos >= 1


def test_trie_of_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(trie, "RUN_BITS", 5)
    rows = [(77, t, "user", f"turn {t % 3}") for t in range(210)] + [(77 + 100, t, "user", f"turn {t % 3}") for t in range(150)]
    got = _found(trie.conversation_trie(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")))
    assert got == _trie(rows)


def test_trie_of_little(spark):
    ddl = "conv_id long, turn long, role string, text string"
    assert trie.conversation_trie(spark.createDataFrame([], ddl)).count() == 0
    assert trie.conversation_trie(spark.createDataFrame([(None, 1, "user", "x")], ddl)).count() == 0
    # conversations of which nothing is left: no base, and no more own turns than are dropped
    lone = [(c, 0, "user", "x") for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 > 0]
    assert _found(trie.conversation_trie(spark.createDataFrame(lone, ddl))) == _trie(lone)
    assert len(_trie(lone)) == 1


def test_colliding_hashes_are_noticed(spark, monkeypatch):
    """With one lane value for every turn the groups are wrong: the check must refuse them."""
    from pyspark.sql import functions as F

    plain = F.xxhash64
    monkeypatch.setattr(trie.F, "xxhash64", lambda *a: plain(F.lit(1)))
    try:
        with pytest.raises(RuntimeError, match="collided"):
            trie.conversation_trie(
                spark.createDataFrame([(1, 0, "user", "a"), (2, 0, "user", "b")] * 3, "conv_id long, turn long, role string, text string")
            )
    finally:
        monkeypatch.undo()
