"""Bounded memory of texts and tries, scripts without spaces, and states carried over window ends."""

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from segmint.llm import decontaminate, langid, unigram, warc


def _index(items):
    texts = [decontaminate.words_of(t) for _, t in items]
    frequency = {}
    for words in texts:
        for w in set(words):
            frequency[w] = frequency.get(w, 0) + 1
    return decontaminate.ItemIndex(items, frequency, len(items), float(np.mean([len(w) for w in texts])))


def _items(n, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(20000)]
    return [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(12, 60))) + ". " + " ".join(rng.choice(words) for _ in range(6))) for i in range(n)]


def test_long_text_is_searched_in_slices():
    items = _items(200)
    index = _index(items)
    rng = random.Random(2)
    noise = lambda n: " ".join(f"w{rng.randrange(20000)}" for _ in range(n))
    text = " ".join([noise(200_000), items[7][1], noise(200_000), items[150][1], noise(200_000)])  # 4 MB, a third of the words known
    tracemalloc.start()
    found = [m[0] for m in index.matches(text, 0.6, 0.6, 0.5)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {7, 150} <= set(found)
    assert peak < 120 << 20


def test_slices_change_nothing(monkeypatch):
    items = _items(60)
    index = _index(items)
    rng = random.Random(3)
    texts = []
    for _ in range(12):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            parts += [" ".join(f"w{rng.randrange(500)}" for _ in range(rng.randrange(300))), rng.choice(items)[1]]
        texts.append(", ".join(parts))
    whole = [index.matches(t, 0.6, 0.6, 0.5) for t in texts]
    assert any(whole)
    monkeypatch.setattr(decontaminate, "SLICE_CHARS", 50)
    monkeypatch.setattr(decontaminate, "SLICE_WORDS", 100)
    assert [index.matches(t, 0.6, 0.6, 0.5) for t in texts] == whole
    words = decontaminate.TextWords(texts[0])
    words.numbers({})
    assert len(words.slices) > 1 and words.between(0, 10**9) == decontaminate.words_of(texts[0])
    assert words.between(37, 91) == decontaminate.words_of(texts[0])[37:91]


def test_item_in_a_script_without_spaces_is_found(spark):
    item = "地球绕太阳一周需要多长时间？大约三百六十五天零六个小时"
    items = spark.createDataFrame([(1, item), (2, "ประเทศไทยมีกี่จังหวัด เจ็ดสิบเจ็ดจังหวัด")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "昨天我们学习了很多新的知识" + item + "老师说明天还要继续"), (2, "昨天我们学习了很多新的知识老师说明天还要继续"), (3, item), (4, None)],
        "doc_id long, text string",
    )
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, items).collect()) == [(1, 1), (3, 1)]
    assert sorted(r.doc_id for r in decontaminate.drop_leaks(docs, items).collect()) == [2, 4]
    assert decontaminate.words_of("Ab 中文x") == ["ab", "中", "文", "x"]


def test_parts_of_a_benchmark_find_the_same(spark, monkeypatch):
    items = spark.createDataFrame(_items(40), "item_id long, text string")
    rng = random.Random(4)
    rows = [(i, " ".join(f"v{rng.randrange(900)}" for _ in range(50)) + (" " + t if i % 3 else "")) for i, t in _items(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    key = lambda df: sorted((r.doc_id, r.item_id, round(r.score, 9)) for r in df.collect())
    whole, kept = key(decontaminate.find_leaks(docs, items)), sorted(r[0] for r in decontaminate.drop_leaks(docs, items).collect())
    monkeypatch.setattr(decontaminate, "INDEX_CHARS", 4000)
    assert key(decontaminate.find_leaks(docs, items)) == whole and whole
    assert sorted(r[0] for r in decontaminate.drop_leaks(docs, items).collect()) == kept


def _plain_states(net, d, data):
    """One direction, byte by byte, as the formulas read."""
    h, out = np.zeros(net.rec.shape[-1]), []
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    for x in data if d == 0 else reversed(data):
        z = sigmoid(net.emb[d, 0, x] + h @ net.rec[d, 0])
        r = sigmoid(net.emb[d, 1, x] + h @ net.rec[d, 1])
        n = np.tanh(net.emb[d, 2, x] + r * (h @ net.rec[d, 2]))
        h = (1 - z) * n + z * h
        out.append(h)
    return out if d == 0 else out[::-1]


def test_pooled_probabilities_equal_a_plain_loop():
    rng = np.random.default_rng(5)
    net = langid.ByteNet.fresh(["a", "b", "c"], seed=3)
    texts = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (1, 31, 63, 64, 65, 96, 97, 128, 129, 500, 0, 1000)]
    got = langid.pooled(net, texts)
    for text, row in zip(texts, got):
        total = np.zeros(3)
        for at in range(0, len(text), langid.WINDOW):
            stop = min(len(text), at + langid.WINDOW)
            before = max(0, at - langid.CONTEXT)
            forward = _plain_states(net, 0, text[before:stop])[at - before :]
            backward = _plain_states(net, 1, text[at : stop + langid.CONTEXT])[: stop - at]
            for f, b in zip(forward, backward):
                e = np.exp(f @ net.out[0] + b @ net.out[1] + net.bias)
                total += e / e.sum()
        assert np.allclose(row, total / max(1, len(text)), atol=1e-4)


def test_null_id_is_not_held_out(spark, tmp_path):
    from segmint.llm.queries import op9_language_id

    rows = [(i, f"the one and the other {i}", "en") for i in range(30)] + [(None, "the one", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.held_out for r in op9_language_id(spark, str(tmp_path)).collect()}
    assert got[None] is False and set(got.values()) == {True, False}


def test_a_full_trie_begins_anew_with_equal_counts(monkeypatch):
    scores = {c: -3.0 for c in "abcd"} | {"ab": -2.0, "cd": -2.5, "abcd": -4.0, "dd": 0.0}
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdx") for _ in range(rng.randrange(1, 90))) for _ in range(300)]
    whole = unigram.TrieCounter(scores).learn(words)
    monkeypatch.setattr(unigram, "MAX_NODES", 500)
    small = unigram.TrieCounter(scores)
    assert small.learn(words) == whole and len(small.best) <= 500
    assert {w: small.known(w) for w in small.terminal} == {w: whole[w] for w in small.terminal}
    long = "abcdx" * 4000
    assert unigram.TrieCounter(scores)._alone(long) == (4000 * 2, 4000 * (-4.0 + unigram.BYTE_SCORE))


def test_index_of_an_archive_is_what_reads_it(spark):
    pages = spark.createDataFrame([(i, "u", "x" * (i * 50)) for i in range(40)], "page_id long, url string, html string").coalesce(1)
    content = bytes(warc.write_archives(pages, frame_bytes=1500).first().content)
    reader = warc.BundleReader(content)
    assert len(reader.spans) > 3 and [r["page_id"] for r in reader.records()] == list(range(40))
    assert [r["payload_bytes"] for r in reader.records()] == [i * 50 for i in range(40)]
    reader.index[5][2] = reader.index[4][2]
    with pytest.raises(ValueError):
        list(reader.records())
    assert warc.read_archives(warc.write_archives(pages.where(F.lit(False)))).count() == 0
