"""Piece encoding, token counts, secrets, decontamination, chunks and language labels."""

import base64
import json
import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from segmint.llm import chunks, decontaminate, langid, pieces, secrets, unigram  # noqa: E402
from segmint.llm.queries import tokenizer_path  # noqa: E402

SF = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
PARTS = ["a", "e", "th", "ing", " ", "  ", "\n", "\t", "\U0001f600", "é", "ß", "▁", "中文", "\x00", "the", "99", "<s>", "<0x41>",
         "́", "​", "\r\n", " " * 40, "=====", "aaaa"]


def _docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def edge(spark):
    """Null, empty, long and repeated rows, a null id, and clashing column names."""
    rows = [(1, None, "x", 0), (2, "", "x", 0), (3, "the token: abcdefgh", "x", 1), (3, "the token: abcdefgh", "x", 1),
            (None, "the one", None, 2), (5, "word " * 30000, "x", 3), (6, "12 .. 7", "x", 4)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_tokens long").withColumn("spans", _lit("s")).withColumn("ids", _lit("i"))


def _lit(x):
    from pyspark.sql import functions as F

    return F.lit(x)


def test_pieces_equal_the_library():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    coder = pieces.PieceEncoder(pieces.PieceModel.load(tokenizer_path()))
    rng = random.Random(5)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(25))) for _ in range(3000)]
    texts += ["thequick" * 3000, " " * 5000, "a" * 5000, "", " ", "\U0001f600" * 300]
    for text in texts:
        ids = coder.encode(text)
        assert ids.tolist() == library.encode(text), text[:50]
        assert coder.decode(ids) == library.decode(ids.tolist()), text[:50]


@needs_data
def test_piece_query_equals_the_library(spark):
    import hashlib

    import sentencepiece

    from segmint.llm.queries import op3_sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    got = {r.doc_id: r for r in op3_sentencepiece(spark, SF).collect()}
    for doc_id, text in _docs(spark).select("doc_id", "text").collect():
        ids = library.encode(text)
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert (got[doc_id].n_tokens, got[doc_id].ids_sha256) == (len(ids), digest)
        assert got[doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_piece_edge_rows(edge):
    rows = pieces.encode_pieces(edge, tokenizer_path()).collect()
    assert sorted((r[0] or 0, len(r[1]), r[2][:7]) for r in rows)[:3] == [(0, 2, "the one"), (1, 0, ""), (2, 0, "")]
    assert len(rows) == 7 and max(len(r[2]) for r in rows) == 150000
    wide = pieces.add_piece_ids(edge, tokenizer_path())
    assert wide.columns == ["doc_id", "text", "lang", "spans", "ids", "n_tokens"] and wide.count() == 7
    assert pieces.encode_pieces(edge.limit(0), tokenizer_path()).collect() == []


def test_trie_counts_equal_plain_recursion():
    scores = unigram.zipf_scores(pieces.PieceModel.load(tokenizer_path()))
    rng = random.Random(2)
    words = {"▁" + "".join(rng.choice("abethinglyoré中\U0001f600") for _ in range(rng.randrange(1, 12))) for _ in range(1500)}
    found = unigram.TrieCounter(scores).learn(words)
    assert {w: n for w, (n, _) in found.items()} == {w: brute.best_segmentation(w, scores, unigram.BYTE_SCORE)[0] for w in words}
    assert all(abs(s - brute.best_segmentation(w, scores, unigram.BYTE_SCORE)[1]) < 1e-9 for w, (_, s) in found.items())


def test_trie_ties_prefer_the_longer_last_piece():
    scores = {"a": -1.0, "b": -1.0, "c": -1.0, "ab": -1.0, "bc": -1.0}
    assert unigram.TrieCounter(scores).learn(["abc"])["abc"] == (2, -2.0)


def test_count_edge_rows(edge):
    scores = unigram.zipf_scores(pieces.PieceModel.load(tokenizer_path()))
    rows = sorted((r[0] or 0, r[1], r[2] > 0) for r in unigram.count_tokens(edge, scores, "k").collect())
    assert rows[:4] == [(0, 2, True), (1, 0, False), (2, 0, False), (3, 3, True)] and len(rows) == 7
    assert unigram.count_tokens(edge.limit(0), scores, "k").collect() == []


def _der(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x82, n >> 8, n & 255])
    return bytes([tag]) + size + body


def _keys():
    integer = _der(2, b"\x01" * 60)
    pkcs1 = _der(0x30, _der(2, b"\x00") + integer * 8)
    pkcs8 = _der(0x30, _der(2, b"\x00") + _der(0x30, _der(6, b"\x2a\x86") + _der(5, b"")) + _der(4, pkcs1))
    sec1 = _der(0x30, _der(2, b"\x01") + _der(4, b"k" * 32) + _der(0xA0, _der(6, b"\x2a\x86")))
    text = lambda b: len(b).to_bytes(4, "big") + b
    public = text(b"ssh-ed25519") + text(b"p" * 32)
    ssh = b"openssh-key-v1\0" + text(b"none") * 2 + text(b"") + (1).to_bytes(4, "big") + text(public) + text(b"s" * 64)
    return pkcs1, pkcs8, sec1, ssh


def _plain_spans(text):
    """The base patterns, written out as the contract has them."""
    import re

    out = []
    for kind, pattern, least in (
        ("assign", r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
        ("access", r"AKIA[A-Z0-9]+", 20), ("hex", r"[0-9a-f]+", 24)):
        for m in re.finditer(pattern, text):
            if len(m[2] if kind == "assign" else m[0]) >= least:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


@needs_data
def test_base_spans_equal_the_plain_patterns(spark):
    texts = [r[0] for r in _docs(spark).select("text").collect()]
    rng = random.Random(4)
    bits = ["token", "=", ": ", "secret", "Api_Key", "'", '"', "abcdef", "AKIA", "Z9" * 9, "0a" * 13, " ", "passwd", "é", "."]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(4000)]
    hits = 0
    for text in texts:
        want = _plain_spans(text)
        assert [s for s in secrets.find_secrets(text) if s[0] in secrets.BASE_KINDS] == want
        hits += len(want)
    assert hits > 1000


def test_structures_are_confirmed_and_near_misses_are_not():
    pkcs1, pkcs8, sec1, ssh = _keys()
    for key, kind in ((pkcs1, "der_key"), (pkcs8, "der_key"), (sec1, "der_key"), (ssh, "ssh_key")):
        body = base64.b64encode(key).decode()
        assert kind in {s[0] for s in secrets.find_secrets(f"x {body} y")}
        broken = base64.b64encode(key[:-3]).decode()
        assert kind not in {s[0] for s in secrets.find_secrets(f"x {broken} y")}
        lines = "\n".join(body[i : i + 64] for i in range(0, len(body), 64))
        pem = f"é -----BEGIN PRIVATE KEY-----\n{lines}\n-----END PRIVATE KEY----- z"
        assert ("pem_key", 2, len(pem) - 2) in secrets.find_secrets(pem)
        assert "hex_key" in {s[0] for s in secrets.find_secrets(key.hex())}
    part = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")
    token = f"{part({'alg': 'HS256'})}.{part({'sub': 'a'})}.c2ln"
    assert ("signed_token", 4, 4 + len(token)) in secrets.find_secrets(f"see {token}")
    assert not secrets.find_secrets(f"see {part({'typ': 'x'})}.{part([1])}.c2ln")
    assert not secrets.find_secrets("-----BEGIN PRIVATE KEY-----\nnot a key\n-----END PRIVATE KEY-----")


def test_redaction_and_edge_rows(edge):
    rows = secrets.scan_secrets(edge).collect()
    assert sorted((r[0] or 0, len(r[1])) for r in rows) == [(0, 0), (1, 0), (2, 0), (3, 1), (3, 1), (5, 0), (6, 0)]
    clean = secrets.redact_secrets(edge, length_col="n_tokens")
    assert clean.columns == edge.columns
    got = {r.doc_id: (r.text, r.n_tokens) for r in clean.collect()}
    assert got[3] == ("the [REDACTED:assign]", 21) and got[1] == (None, 0) and got[6] == ("12 .. 7", 4)
    assert secrets.scan_secrets(edge.limit(0)).collect() == []
    assert secrets.redact("abcdefgh", [("hex", 1, 4), ("assign", 3, 6)]) == "a[REDACTED:hex]gh"


@needs_data
def test_leaks_equal_whole_item_search(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    docs = [tuple(r) for r in _docs(spark).select("doc_id", "text").collect()]
    got = {(r[0], r[1]) for r in decontaminate.find_leaks(_docs(spark), spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    spaced = lambda t: " " + " ".join(decontaminate.words_of(t)) + " "
    want = {(d, i) for d, t in docs for i, u in items if spaced(u) in spaced(t)}
    assert got == want and want
    kept = decontaminate.drop_leaks(_docs(spark), spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert kept.count() == len(docs) - len({d for d, _ in want})


def test_wand_retrieves_every_item_over_the_threshold():
    rng = random.Random(8)
    vocabulary = [f"w{min(rng.randrange(300), rng.randrange(300))}" for _ in range(300)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(5, 40)))) for i in range(300)]
    frequency = {}
    for _, text in items:
        for w in set(text.split()):
            frequency[w] = frequency.get(w, 0) + 1
    index = decontaminate.ItemIndex(items, frequency, 300, 22.0)
    impacts = {i: {} for i, _ in items}
    for part in index.classes:
        for term, postings in part.postings.items():
            for number, share in postings:
                impacts[part.items[number]][term] = share
    for _ in range(40):
        _, text = rng.choice(items)
        words = text.split() + [rng.choice(vocabulary) for _ in range(rng.randrange(60))]
        rng.shuffle(words)
        found = {i: s for i, (s, _, _) in index.search(" ".join(words), 0.4).items()}
        for part in index.classes:
            for i in part.items:
                starts = range(0, max(1, len(words) - part.longest), part.longest)
                best = max(
                    sum(impacts[i].get(index.terms.get(w, 0), 0.0) for w in set(words[s : s + 2 * part.longest])) for s in starts
                )
                assert (i in found) == (best >= 0.4) or abs(best - 0.4) < 1e-6
                assert i not in found or abs(found[i] - best) < 1e-9


def test_leak_edge_rows(spark, edge):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "the token: abcdefgh"), (None, "the token abcdefgh"), (4, "zz yy xx")], "item_id long, text string")
    got = sorted((r[0], r[1] or 0) for r in decontaminate.find_leaks(edge, items).collect())
    assert got == [(3, 0), (3, 0), (3, 3), (3, 3)]
    assert decontaminate.find_leaks(edge, items.limit(0)).collect() == []
    assert decontaminate.find_leaks(edge.limit(0), items).collect() == []
    assert decontaminate.drop_leaks(edge, items).count() == 5


def test_rolling_hash_equals_its_definition():
    data = np.random.default_rng(2).integers(0, 256, 200, dtype=np.uint8)
    got = chunks.gear_hash(data)
    for i in range(200):
        want = sum(int(chunks.GEAR[data[i - k]]) << k for k in range(min(32, i + 1))) % 2**32
        assert int(got[i]) == want


def test_chunks_cover_the_text_and_resist_insertions():
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefghi é中") for _ in range(6000))
    raw = text.encode()
    cuts = chunks.cut_points(raw)
    assert cuts[-1] == len(raw) and cuts == sorted(set(cuts))
    assert max(b - a for a, b in zip([0, *cuts], cuts)) <= chunks.MAX_CHUNK
    assert all(raw[c] & 0xC0 != 0x80 for c in cuts[:-1])
    pieces_of = lambda r: {r[a:b] for a, b in zip([0, *chunks.cut_points(r)], chunks.cut_points(r))}
    moved = pieces_of(("inserted" + text).encode())
    assert len(pieces_of(raw) & moved) > 0.95 * len(moved)


@needs_data
def test_repeats_hold_all_long_passages_and_no_others(spark):
    docs = [tuple(r) for r in _docs(spark).select("doc_id", "text").collect()]
    found = {r[0] for r in chunks.find_repeats(_docs(spark)).collect()}
    assert brute.shared_passages(docs, 50) <= found
    assert found <= brute.shared_passages(docs, 8)


def test_removal_keeps_one_place_and_edge_rows(spark, edge):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    passage = " ".join(word() for _ in range(80))
    rows = [(i, f"{' '.join(word() for _ in range(30))} {passage} {' '.join(word() for _ in range(30))}") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r[0] for r in chunks.find_repeats(df).collect()} == {0, 1, 2}
    left = {r[0]: r[1] for r in chunks.remove_repeats(df).collect()}
    assert left[0] == rows[0][1] and all(len(left[i]) < len(rows[i][1]) - 300 for i in (1, 2))
    out = chunks.remove_repeats(edge)
    assert out.columns == edge.columns and out.count() == 7
    assert chunks.find_repeats(edge).collect() == []  # a long text that only repeats itself
    twice = edge.unionAll(edge.withColumn("doc_id", _lit(None).cast("long")))
    assert {r[0]: len(r[2]) > 0 for r in chunks.find_repeats(twice).collect()} == {None: False, 5: True}
    assert chunks.find_repeats(edge.limit(0)).collect() == []


@needs_data
def test_language_accuracy_on_held_out_documents(spark):
    from segmint.llm.queries import op9_language_id

    truth = {r[0]: r[1] for r in _docs(spark).select("doc_id", "lang").collect()}
    rows = [r for r in op9_language_id(spark, SF).collect() if r.held_out]
    assert len(rows) > 200
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_gradients_equal_differences():
    rng = np.random.default_rng(3)
    net = langid.ByteNet.fresh(["a", "b", "c"], seed=1, hidden=4)
    for name in ("emb", "rec", "out", "bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    data = rng.integers(0, 256, (6, 5), dtype=np.uint8)
    mask = np.ones((6, 5), np.float32)
    mask[4:, 2] = 0
    target = np.array([0, 1, 2, 1, 0])
    _, grads = langid._gradients(net, data, mask, target)
    for w, g in zip(net.weights(), grads):
        spots = [np.unravel_index(k, w.shape) for k in rng.integers(0, w.size, 12)]
        if w is net.emb:
            spots = [(d, gate, int(data[1, 1]), j) for d in (0, 1) for gate in range(3) for j in (0, 3)]
        for spot in spots:
            old = w[spot]
            w[spot] = old + 1e-2
            up = langid._gradients(net, data, mask, target)[0]
            w[spot] = old - 1e-2
            down = langid._gradients(net, data, mask, target)[0]
            w[spot] = old
            assert abs((up - down) / 2e-2 - g[spot]) < 2e-3


def test_language_edge_rows(edge):
    net = langid.train(["the one and the other"] * 20 + ["le un et les autres"] * 20, ["en"] * 20 + ["fr"] * 20, steps=30)
    got = {r[0]: (r[1], r[2]) for r in langid.predict(edge, net).collect()}
    assert got[1] == got[2] == got[6] == ("und", 0.0) and got[3][0] in ("en", "fr")
    assert langid.predict(edge, None).where("lang_pred <> 'und'").count() == 0
    assert langid.fit(edge.where("lang IS NULL")) is None
    assert langid.predict(edge.limit(0), net).collect() == []
