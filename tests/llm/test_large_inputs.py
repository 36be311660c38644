"""Texts with very many candidates, scores of zero and names that clash."""

import base64
import hashlib
import time

from segmint.llm import secrets, unigram


def _seconds(text):
    best = 1e9
    for _ in range(2):
        t = time.perf_counter()
        secrets.find_secrets(text)
        best = min(best, time.perf_counter() - t)
    return best


def test_secret_scan_is_linear_in_its_candidates():
    hashes = lambda n: "\n".join(hashlib.sha256(b"%d" % i).hexdigest() + f"  file{i}" for i in range(n))
    lines = lambda n: "\n".join("b3Bl" + base64.b64encode(hashlib.sha256(b"%d" % i).digest()).decode()[:40] for i in range(n))
    assert len(secrets.find_secrets(hashes(20_000))) == 20_000
    for text in (hashes, lines):
        assert _seconds(text(40_000)) < 10 * _seconds(text(10_000)) + 0.5


def test_wrapped_ssh_keys_after_one_another():
    def string(b):
        return len(b).to_bytes(4, "big") + b

    key = b"openssh-key-v1\x00" + string(b"none") + string(b"none") + string(b"") + (1).to_bytes(4, "big") + string(string(b"ssh-ed25519") + b"k" * 36) + string(b"p" * 100)
    coded = base64.b64encode(key).decode()
    wrapped = "\n".join(coded[i : i + 64] for i in range(0, len(coded), 64))
    text = "\n".join(["x", wrapped, wrapped, "tail of words"])
    spans = [s for s in secrets.find_secrets(text) if s[0] == "ssh_key"]
    assert spans == [("ssh_key", 2, 2 + len(wrapped)), ("ssh_key", 3 + len(wrapped), 3 + 2 * len(wrapped))]


def test_a_piece_may_score_zero():
    counter = unigram.TrieCounter({"ab": 0.0, "a": -5.0, "b": -5.0})
    assert counter.learn(["ab", "aba"]) == {"ab": (1, 0.0), "aba": (2, -5.0)}


def test_removal_of_repeats_keeps_columns_of_any_name(spark):
    from pyspark.sql import functions as F

    from segmint.llm.chunks import remove_repeats

    import random

    rng = random.Random(3)
    words = lambda n: " ".join("".join(rng.choices("abcdefghijklmnop", k=7)) for _ in range(n))
    shared = words(80)
    rows = [(i, f"{words(20)} {shared} {words(20)}") for i in range(4)]
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    names = ["_row", "_text", "_cuts", "start", "id", "body", "removable"]
    want = {r.doc_id: r.text for r in remove_repeats(plain).collect()}
    got = remove_repeats(plain.withColumns({n: F.lit(n) for n in names})).collect()
    assert {r.doc_id: r.text for r in got} == want
    assert sum(len(t) for t in want.values()) < sum(len(t) for _, t in rows) - 1500
    assert all([r[n] for n in names] == names for r in got)
