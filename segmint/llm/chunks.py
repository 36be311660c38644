"""Substring deduplication by content-defined chunks.

A gear hash rolls over the UTF-8 bytes of a text: the hash at a byte depends on the last
32 bytes only, so boundaries after an insertion fall in place again. A chunk ends where
the top bits of the hash are zero (never inside a character); candidates closer than
``MIN_CHUNK`` to the last cut are passed over and a gap longer than ``MAX_CHUNK`` is cut at
multiples of it from its start. Chunks are compared by 128-bit digest.

A chunk is shared if its digest occurs in more than one document or, with ``within``, in
more than one place: twice in a document, or in two rows with the same id. Chunks only find
candidates: both ends of a run of adjacent shared chunks are extended byte by byte, as far as
the text equals that around the first place of the run's outermost chunk, and both places get
the extended span. Spans that touch are one repeat if they have ``min_run`` bytes. Of each digest the document with
the smallest id keeps its text, with ``within`` only its first place; all other places are
removable.

Null and empty texts have no chunks and no repeats. A null id counts as one id, the
smallest; rows with the same id follow each other in the order they are read. Extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, stage, text_column

WINDOW_BITS = 5  # the rolling hash sees 2**5 bytes
MASK_BITS = 5  # a candidate every 32 bytes on average
MIN_CHUNK, MAX_CHUNK = 24, 192
MIN_RUN = 100  # bytes of a repeat: about a third of a passage of fifty words
CONTEXT, CONTEXT_GROWTH = 128, 32  # bytes compared beyond a run in the first round; each later round, for what is equal so far, has more


def _gear() -> np.ndarray:
    """256 random 32-bit words, from a digest of each byte value."""
    return np.array([int.from_bytes(hashlib.sha256(bytes([b])).digest()[:4], "big") for b in range(256)], dtype=np.uint32)


GEAR = _gear()


def gear_hash(data: np.ndarray) -> np.ndarray:
    """h[i] = sum of GEAR[data[i - k]] << k over the last 32 bytes, for all i at once."""
    h = GEAR[data]
    for bit in range(WINDOW_BITS):  # doubling: the window grows 1, 2, 4, ... bytes
        k = 1 << bit
        if len(h) > k:
            longer = h.copy()
            longer[k:] += h[:-k] << np.uint32(k)
            h = longer
    return h


def cut_points(raw: bytes) -> list[int]:
    """Ends of the chunks of a text's bytes, ascending; the last is its length."""
    if not raw:
        return []
    data = np.frombuffer(raw, dtype=np.uint8)
    hits = np.flatnonzero(gear_hash(data) >> np.uint32(32 - MASK_BITS) == 0) + 1
    hits = hits[hits < len(raw)]
    hits = hits[(data[hits] & 0xC0) != 0x80]  # the next byte starts a character
    cuts, last = [], 0
    for hit in [*hits.tolist(), len(raw)]:
        while hit - last > MAX_CHUNK:
            last += MAX_CHUNK
            while raw[last] & 0xC0 == 0x80:
                last -= 1
            cuts.append(last)
        if hit - last >= MIN_CHUNK or hit == len(raw):
            cuts.append(hit)
            last = hit
    return cuts


def chunk_digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def chunk_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Chunk rows: id, ``_row``, ``_text``, byte ``start`` and ``size``, ``digest``; ``df`` has a
    number ``_row`` per row and a hash ``_text`` of its text."""
    kind = df.schema[id_col].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text_col, 2 << 20):
            owner, starts, sizes, digests = [], [], [], []
            for i, text in enumerate(text_column(batch, text_col)):
                raw, last = text.encode("utf-8", "surrogatepass"), 0
                cuts = cut_points(raw)
                for end in cuts:
                    starts.append(last)
                    sizes.append(end - last)
                    digests.append(chunk_digest(raw[last:end]))
                    last = end
                owner += [i] * len(cuts)
            owners = [batch.column(c).take(pa.array(owner, pa.int64())) for c in (id_col, "_row", "_text")]
            yield pa.RecordBatch.from_arrays(
                [*owners, pa.array(starts, pa.int32()), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary())],
                [id_col, "_row", "_text", "start", "size", "digest"],
            )

    return df.select(id_col, "_row", "_text", text_col).mapInArrow(split, f"`{id_col}` {kind}, _row long, _text long, start int, size int, digest binary")


def shared_chunks(chunks: DataFrame, id_col: str = "doc_id", within: bool = False) -> DataFrame:
    """The chunk rows whose digest occurs in several documents (``within``: in several places);
    ``kept`` marks the first document's (the first place), ``first`` is the first place.

    The first place and the greatest id of every digest come from a map-side combined aggregate,
    so a digest that holds a third of all rows is one row per task there. Its result is written
    before the join back, so that both sides of the join are plain exchanges, whose hot
    partitions adaptive execution splits.
    """
    place = F.struct(F.col(id_col).alias("id"), F.col("_row").alias("row"), "start", F.col("_text").alias("text"))
    # min() and max() skip no null inside a struct, and null sorts first
    found = chunks.groupBy("digest").agg(F.min(place).alias("first"), F.max(F.struct(F.col(id_col).alias("id"))).alias("last"), F.count(F.lit(1)).alias("places"))
    shared = found.where("places > 1" if within else "NOT first.id <=> last.id").select("digest", "first")
    joined = chunks.join(stage(shared, "shared"), "digest")
    kept = F.col("first") == place if within else F.col("first.id").eqNullSafe(F.col(id_col))
    return joined.select(id_col, "_row", "_text", "start", "size", kept.alias("kept"), "first")


def run_edges(shared: list[dict]) -> list[tuple]:
    """(position, side, first's id, row, text, position) of the ends of a document's runs of adjacent
    shared chunks, which are sorted by start; side 0 is the left one. The first places have none:
    they are extended with their copies."""
    out = []
    for k, c in enumerate(shared):
        if c["kept"]:
            continue
        f, end = c["first"], c["start"] + c["size"]
        if c["start"] and f["start"] and (k == 0 or shared[k - 1]["start"] + shared[k - 1]["size"] < c["start"]):
            out.append((c["start"], 0, f["id"], f["row"], f["text"], f["start"]))
        if k + 1 == len(shared) or shared[k + 1]["start"] > end:
            out.append((end, 1, f["id"], f["row"], f["text"], f["start"] + c["size"]))
    return out


def equal_bytes(own: bytes, other: bytes, side: int) -> int:
    """How many bytes before (side 0) or after the edge are equal, in whole characters."""
    n = min(len(own), len(other))
    a, b = (own[::-1], other[::-1]) if side == 0 else (own, other)
    if a[:n] != b[:n]:
        n = next(i for i in range(n) if a[i] != b[i])
    if side == 0:
        while n and own[len(own) - n] & 0xC0 == 0x80:
            n -= 1
    else:
        while n and any(len(x) > n and x[n] & 0xC0 == 0x80 for x in (own, other)):
            n -= 1
    return n


def merge_spans(spans: list[dict], min_run: int) -> tuple[list[dict], list[dict]]:
    """(repeats, removable spans) of a document's spans, which are sorted by start.

    Repeats are spans that touch, of ``min_run`` bytes or more together; removable are their
    parts in ``copy`` spans and not in ``kept`` chunks. The rest are extensions of kept chunks.
    """
    repeats: list[dict] = []
    for s in spans:
        if repeats and s["start"] <= repeats[-1]["end"]:
            repeats[-1]["end"] = max(repeats[-1]["end"], s["end"])
        else:
            repeats.append({"start": s["start"], "end": s["end"]})
    repeats = [r for r in repeats if r["end"] - r["start"] >= min_run]
    kept = [s for s in spans if s["kind"] == "kept"]  # chunks, so they do not overlap
    removable: list[dict] = []
    r = k = at = 0
    for s in spans:
        if s["kind"] != "copy":
            continue
        while r < len(repeats) and repeats[r]["end"] < s["end"]:
            r += 1
        if r == len(repeats) or s["start"] < repeats[r]["start"]:
            continue
        at = max(at, s["start"])
        while k < len(kept) and kept[k]["end"] <= at:
            k += 1
        j = k
        while at < s["end"]:
            stop = min(s["end"], kept[j]["start"]) if j < len(kept) else s["end"]
            if stop > at:
                if removable and removable[-1]["end"] == at:
                    removable[-1]["end"] = stop
                else:
                    removable.append({"start": at, "end": stop})
            at = max(at, stop)
            if j < len(kept) and at >= kept[j]["start"]:
                at = max(at, kept[j]["end"])
                j += 1
    return repeats, removable


def _extensions(rows: DataFrame, runs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The spans by which run ends are extended: id, ``_row``, ``start``, ``end``, ``kind``.

    The bytes beyond an end are fetched by (id, hash of the text, position, side), once for all that
    ask for them, and joined to the ends by plain exchanges. Ends that are equal throughout
    go into a next round with more bytes, so no length limits an extension.
    """
    kind = rows.schema[id_col].dataType.simpleString()
    names = ["id", "row", "text", "at", "side", "first_id", "first_row", "first_text", "first_at"]
    ddl = f"id {kind}, row long, text long, at int, side int, first_id {kind}, first_row long, first_text long, first_at int"

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [run_edges(x) for x in batch.column("shared").to_pylist()]
            owner = pa.array([i for i, x in enumerate(found) for _ in x], pa.int64())
            flat = [e for x in found for e in x]
            types = [pa.int32(), pa.int32(), batch.schema.field(id_col).type, pa.int64(), pa.int64(), pa.int32()]
            own = [batch.column(c).take(owner) for c in (id_col, "_row", "_text")]
            yield pa.RecordBatch.from_arrays([*own, *(pa.array([e[k] for e in flat], t) for k, t in enumerate(types))], names)

    def fetch(size: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in small_batches(batches, "body"):
                owner, asked, near = [], [], []
                for i, (text, places) in enumerate(zip(text_column(batch, "body"), batch.column("places").to_pylist())):
                    raw = text.encode("utf-8", "surrogatepass")
                    for p in places:
                        at = p["at"]
                        owner.append(i)
                        asked.append(p)
                        near.append(raw[at : at + size] if p["side"] else raw[max(0, at - size) : at])
                own = [batch.column(c).take(pa.array(owner, pa.int64())) for c in ("id", "text")]
                places = [pa.array([p[c] for p in asked], pa.int32()) for c in ("at", "side")]
                yield pa.RecordBatch.from_arrays([*own, *places, pa.array(near, pa.binary())], ["id", "text", "at", "side", "near"])

        return run

    def compare(size: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own, other, side = (batch.column(c).to_pylist() for c in ("near", "first_near", "side"))
                n = [equal_bytes(a, b, s) for a, b, s in zip(own, other, side)]
                # whole so far: fewer equal bytes can only be a cut character at the far end
                more = [len(a) == len(b) == size and a == b for a, b in zip(own, other)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(n, pa.int32()), pa.array(more, pa.bool_())], [*names, "n", "more"])

        return run

    def same(left: DataFrame, right: DataFrame, prefix: str):
        return left[f"{prefix}id"].eqNullSafe(right["id"]) & (left[f"{prefix}text"] == right["text"]) & (left[f"{prefix}at"] == right["at"]) & (left["side"] == right["side"])

    todo, size, out = stage(runs.mapInArrow(ends, ddl), "ends"), CONTEXT, None
    body = rows.select(F.col(id_col).alias("id"), F.col("_text").alias("text"), F.col(text_col).alias("body"))
    while True:
        first = todo.select(*(F.col(f"first_{c}").alias(c) for c in ("id", "text", "at")), "side")
        places = todo.select("id", "text", "at", "side").unionAll(first).groupBy("id", "text").agg(F.collect_set(F.struct("at", "side")).alias("places"))
        places = stage(places, "places")
        asked = body.join(places, body["id"].eqNullSafe(places["id"]) & (body["text"] == places["text"])).select(places["id"], places["text"], "body", "places")
        near = asked.mapInArrow(fetch(size), f"id {kind}, text long, at int, side int, near binary")
        near = stage(near.groupBy("id", "text", "at", "side").agg(F.min("near").alias("near")), "near")
        own = todo.join(near, same(todo, near, "")).select(*(todo[c] for c in names), "near")
        other = near.select("id", "text", "at", "side", F.col("near").alias("first_near"))
        both = own.join(other, same(own, other, "first_")).select(*(own[c] for c in names), "near", "first_near")
        done = stage(both.mapInArrow(compare(size), f"{ddl}, n int, more boolean"), "compared")
        closed = done.where("NOT more AND n > 0")
        out = closed if out is None else out.unionAll(closed)
        todo = done.where("more").select(*names)
        if todo.isEmpty():
            break
        size *= CONTEXT_GROWTH
    begin, end = F.expr("IF(side = 0, at - n, at)").alias("start"), F.expr("IF(side = 0, at, at + n)").alias("end")
    copies = out.select(F.col("id").alias(id_col), F.col("row").alias("_row"), begin, end, F.lit("copy").alias("kind"))
    longest = out.groupBy(F.col("first_id").alias(id_col), F.col("first_row").alias("_row"), F.col("first_at").alias("at"), "side").agg(F.max("n").alias("n"))
    return copies.unionAll(longest.select(id_col, "_row", begin, end, F.lit("first").alias("kind")))


def find_repeats(df: DataFrame, min_run: int = MIN_RUN, id_col: str = "doc_id", text_col: str = "text", within: bool = False) -> DataFrame:
    """One row per document row that holds a repeat: id, ``repeats`` and ``removable``, arrays of
    (start, end) in bytes of the UTF-8 text, ascending.

    ``within`` also finds repeats inside one document and between rows with the same id.
    A document's shared chunks are gathered in one row; their number is bounded by its
    length.
    """
    numbered = df.select(id_col, text_col, F.monotonically_increasing_id().alias("_row"), F.xxhash64(text_col).alias("_text"))
    return _numbered_repeats(numbered, min_run, id_col, text_col, within).drop("_row")


def _numbered_repeats(df: DataFrame, min_run: int, id_col: str, text_col: str, within: bool) -> DataFrame:
    """``find_repeats`` of rows with a number ``_row``, which the result keeps, and a hash ``_text``."""
    chunks = stage(chunk_documents(df, id_col, text_col), "chunks")
    own = F.sort_array(F.collect_set(F.struct("start", "size", "kept", "first")))
    runs = stage(shared_chunks(chunks, id_col, within).groupBy(id_col, "_row", "_text").agg(own.alias("shared")), "runs")
    inner = runs.select(id_col, "_row", F.explode("shared").alias("c")).select(
        id_col, "_row", F.col("c.start").alias("start"), F.expr("c.start + c.size").alias("end"), F.expr("IF(c.kept, 'kept', 'copy')").alias("kind")
    )
    parts = inner.unionAll(_extensions(df, runs, id_col, text_col))
    docs = parts.groupBy(id_col, "_row").agg(F.sort_array(F.collect_set(F.struct("start", "end", "kind"))).alias("parts"))
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [merge_spans(x, min_run) for x in batch.column("parts").to_pylist()]
            out = [batch.column(id_col), batch.column("_row"), pa.array([f[0] for f in found], spans), pa.array([f[1] for f in found], spans)]
            rows = pa.RecordBatch.from_arrays(out, [id_col, "_row", "repeats", "removable"])
            yield rows.filter(pa.array([bool(f[0]) for f in found], pa.bool_()))

    kind = df.schema[id_col].dataType.simpleString()
    ddl = "array<struct<start:int,end:int>>"
    return docs.mapInArrow(merge, f"`{id_col}` {kind}, _row long, repeats {ddl}, removable {ddl}")


def remove_repeats(df: DataFrame, min_run: int = MIN_RUN, id_col: str = "doc_id", text_col: str = "text", within: bool = False) -> DataFrame:
    """``df`` with every repeat but its kept place cut out of the texts.

    The numbered rows are written first, so that a row has the same number in both uses. Columns
    go by place inside, so no name of ``df`` can clash.
    """
    names = df.columns
    id_col, text_col = (f"c{names.index(c)}" for c in (id_col, text_col))
    df = df.toDF(*(f"c{i}" for i in range(len(names))))
    rows = stage(df.withColumn("_row", F.monotonically_increasing_id()).withColumn("_text", F.xxhash64(text_col)), "rows")
    spans = _numbered_repeats(rows, min_run, id_col, text_col, within).select("_row", F.col("removable").alias("_cuts"))
    joined = rows.join(spans, "_row", "left").drop("_row", "_text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            for i, cuts in enumerate(batch.column("_cuts").to_pylist()):
                if cuts:
                    raw, last, kept = texts[i].encode("utf-8", "surrogatepass"), 0, []
                    for c in cuts:
                        kept.append(raw[last : c["start"]])
                        last = c["end"]
                    texts[i] = b"".join([*kept, raw[last:]]).decode("utf-8", "surrogatepass")
            names = [n for n in batch.schema.names if n != "_cuts"]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if n == text_col else batch.column(n) for n in names], names)

    return joined.mapInArrow(cut, df.schema).toDF(*names)
