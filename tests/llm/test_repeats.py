"""Repeats inside one document and between rows with the same id."""

import random

from segmint.llm import chunks


def _words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(n))


def test_repeats_inside_a_document_and_between_rows_of_one_id(spark):
    rng = random.Random(9)
    passage, line = _words(rng, 80), _words(rng, 80)
    inside = f"{_words(rng, 30)} {passage} {_words(rng, 30)} {passage} {_words(rng, 30)}"
    later = f"{_words(rng, 30)} {passage} {_words(rng, 30)}"
    rows = [(1, inside), (2, later), (3, f"{line} {_words(rng, 20)}"), (3, f"{_words(rng, 9)} é {line}"), (None, line), (None, line)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = [(r.doc_id, len(r.repeats), len(r.removable)) for r in chunks.find_repeats(df, within=True).collect()]
    assert sorted(got, key=lambda r: (r[0] or 0, r)) == [(None, 1, 0), (None, 1, 1), (1, 2, 1), (2, 1, 1), (3, 1, 1), (3, 1, 1)]
    left = sorted((r[0] or 0, len(r[1])) for r in chunks.remove_repeats(df, within=True).collect())
    assert left[0] == (0, 0) and left[1] == (0, len(line)) and left[2][1] < len(inside) - 400
    texts = {r[1] for r in chunks.remove_repeats(df, within=True).where("doc_id = 1").collect()}
    assert inside[: inside.index(passage) + len(passage)] in texts.pop()  # the first place stays whole


def test_passages_of_two_documents_in_different_contexts_are_found_whole(spark):
    rng = random.Random(10)
    vocabulary = [_words(rng, 1)[: rng.randrange(2, 8)] for _ in range(3000)]
    words = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    rows, passages = [], []
    for k in range(300):
        passages.append(f"中{words(51)}é")
        rows += [(2 * k + j, f"{words(30)} {'ab'[j]}{passages[k]}{'cd'[j]} {words(30)}") for j in (0, 1)]
    found = {r.doc_id: r for r in chunks.find_repeats(spark.createDataFrame(rows, "doc_id long, text string"), within=True).collect()}
    whole = 0
    for i, text in rows:
        start = len(text[: text.index(passages[i // 2])].encode())
        span = (start, start + len(passages[i // 2].encode()))
        if i in found:
            whole += span in [tuple(s) for s in found[i].repeats]
            assert [tuple(s) for s in found[i].removable] in ([], [span]) and bool(found[i].removable) == (i % 2 == 1)
    assert whole >= 0.99 * len(rows), whole


def test_an_extension_has_no_length_limit(spark):
    # a stretch without gear boundaries is cut at multiples of MAX_CHUNK, out of step in the two documents
    rng, h, stretch = random.Random(11), 0, ""
    while len(stretch) < 3000:
        letter = rng.choice("abcdefghijklmnop")
        if (following := ((h << 1) + int(chunks.GEAR[ord(letter)])) % 2**32) >> (32 - chunks.MASK_BITS):
            h, stretch = following, stretch + letter
    shared = f"{stretch} {_words(rng, 30)}"
    texts = [f"{_words(rng, n)} {'XY'[j]}{shared}{'VW'[j]} {_words(rng, 30)}" for j, n in ((0, 20), (1, 27))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {i: [(t.index(shared), t.index(shared) + len(shared))] for i, t in enumerate(texts)}
    assert {r.doc_id: [tuple(s) for s in r.repeats] for r in chunks.find_repeats(df).collect()} == want
    assert chunks.remove_repeats(df).where("doc_id = 1").first().text == texts[1].replace(shared, "")


def test_spans_are_merged_and_kept_chunks_stay():
    spans = [{"start": a, "end": b, "kind": k} for a, b, k in ((0, 10, "copy"), (5, 60, "copy"), (60, 90, "kept"), (85, 120, "copy"), (130, 140, "copy"))]
    assert chunks.merge_spans(spans, 100) == ([{"start": 0, "end": 120}], [{"start": 0, "end": 60}, {"start": 90, "end": 120}])
    assert chunks.equal_bytes("xé".encode(), "yé".encode(), 0) == 2 and chunks.equal_bytes("é".encode(), "è".encode(), 1) == 0
