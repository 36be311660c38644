"""Fingerprints, chat formatting, archives, and every SQL oracle of the subpackage."""

import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from compare import canonical, differences  # noqa: E402

from segmint.llm import chat, fingerprint, warc  # noqa: E402
from segmint.llm.queries import LLM_ORACLES, LLM_QUERIES  # noqa: E402

SF = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


@needs_data
@pytest.mark.parametrize("key", sorted(LLM_ORACLES))
def test_query_equals_its_oracle(spark, key):
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = LLM_QUERIES[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(LLM_ORACLES[key])
    want = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert canonical(df.columns, rows) == canonical(rel.columns, want), differences(df.columns, rows, rel.columns, want)


def test_every_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in LLM_QUERIES) == list(range(1, 11))


def _prints(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return df.withColumn("fp", fingerprint.fingerprint(F.col("text")))


def test_fingerprints_are_homomorphic(spark):
    df = _prints(spark, ["one.\ntwo\nthree", "three\ntwo\none.", "one.\ntwo", "three", "", None, "one. two\nthree"])
    fp = {r.i: r.fp for r in df.collect()}
    assert fp[0] == fp[1] == fp[6] and fp[4] == fp[5] and fp[4].n == 0
    a, b = (df.where(F.col("i") == k).select(F.col("fp").alias(n)) for k, n in ((2, "a"), (3, "b")))
    both = a.crossJoin(b).select(fingerprint.combine(F.col("a"), F.col("b")).alias("sum")).withColumn("diff", F.col("sum"))
    row = both.crossJoin(b).select("sum", fingerprint.remove(F.col("sum"), F.col("b")).alias("diff")).first()
    assert row["sum"] == fp[0] and row["diff"] == fp[2]


def test_next_row_over_many_buckets(spark):
    """Every row meets its successor for any number of buckets, with ties and null ids."""
    rows = [(i * 7 % 1000, f"t{i}") for i in range(300)] + [(50, "tie"), (50, "tie"), (None, "none")]
    df = spark.createDataFrame(rows, "k long, t string").repartition(5)
    order = sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[1]))
    want = sorted((str(a), b[1]) for a, b in zip(order, order[1:] + order[:1]))
    for size in (1, 3, 40, 1000):
        got = fingerprint.with_next(df, "k", ["t"], ties="t", rows_per_bucket=size).collect()
        assert sorted((str((r.k, r.t)), r.next.t) for r in got) == want


def test_fingerprint_edge_rows(spark):
    one = spark.createDataFrame([(1, "abcdefgh", "x")], "doc_id long, text string, fp string")
    row = fingerprint.fingerprint_edits(one).first()
    assert (row.n_chars, row.edited) == (8, "abcdefab")
    rows = [(1, None), (2, ""), (3, "é" * 9), (4, "中文"), (4, "中文"), (5, "a. b\n" * 20000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_chars, r.edited[:12]) for r in fingerprint.fingerprint_edits(df).collect())
    assert got[:5] == [(1, 0, ""), (2, 0, ""), (3, 9, "é" * 7 + "中文"), (4, 2, "中文"), (4, 2, "中文")]
    assert fingerprint.fingerprint_edits(df.limit(0)).collect() == []


def test_chat_round_trip_and_turn_order(spark):
    nasty = "\\### Assistant: </turn> ok"
    rows = [(1, 0, "user", nasty), (1, 1, "assistant", nasty), (2, 0, "system", "#### ##</turn></turn>\\h\\e\\\\"), (2, 1, "user", None),
            (2, 2, "assistant", ""), (3, 0, "assistant", "x"), (4, 0, "to:ol#</turn>", "a: b"), (4, None, None, "n"), (5, 0, "user", "q"),
            (None, 1, "user", "q"), (6, 0, "user", "y" * 100000), (6, 1, "assistant", "\\" * 9999)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1)).withColumn("segments", F.lit(2))
    out = chat.format_chat(df).withColumn("back", chat.read_chat(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("segments")))
    got = {r.conv_id: r for r in out.collect()}
    for conv in got:
        own = sorted([r for r in rows if r[0] == conv], key=lambda r: -1 if r[1] is None else r[1])
        assert [tuple(t) for t in got[conv].back] == [(r[2] or "", r[3] or "") for r in own]
        assert got[conv].loss == "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert got[conv].formatted == "".join(s.text for s in got[conv].segments)
    assert {c: r.valid for c, r in got.items()} == {1: True, 2: True, 3: False, 4: False, 5: False, None: False, 6: True}
    assert chat.format_chat(df.limit(0)).collect() == []


def test_archives_round_trip(spark):
    import io

    import zstandard

    big = "<p>" + "é" * 2000
    rows = [(1, "http://a/", big), (2, "http://b/\r\nX: y", big), (3, None, "small"), (4, "u", "small"), (5, "u", None), (6, "u", ""),
            (None, "u", big), (7, "u", "z" * 3_000_000), (8, "u", "q" * 999), (9, "u", "q" * 999), (3, None, "small")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("clash")).coalesce(1)
    bundles = warc.write_archives(pages, frame_bytes=2000, bundle_bytes=400).cache()
    assert bundles.count() > 1
    back = warc.read_archives(bundles).collect()
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to or 0) for r in back)
    size = len(big.encode())
    assert got == [(0, size, "revisit", 2), (1, size, "revisit", 2), (2, size, "response", 0), (3, 5, "response", 0), (3, 5, "response", 0),
                   (4, 5, "response", 0), (5, 0, "response", 0), (6, 0, "response", 0), (7, 3_000_000, "response", 0),
                   (8, 999, "response", 0), (9, 999, "response", 0)]
    texts = {i: h or "" for i, _, h in rows}
    assert all(bytes(r.payload).decode() == texts[r.page_id] for r in back if r.record_type == "response")
    assert sorted(r.page_id for r in warc.fetch_records(bundles, [7, 3, 99]).collect()) == [3, 3, 7]
    # a plain decoder that skips the index and the seek table sees whole records
    content = bytes(bundles.first().content)
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content), read_across_frames=True).read()
    assert plain.startswith(b"WARC/1.1")
    assert warc.read_archives(warc.write_archives(pages.limit(0))).collect() == []
