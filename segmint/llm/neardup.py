"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of hashed word 5-grams (lower case, letters and digits; a text of fewer
words is one gram). Documents with equal sets form a copy class, and one of each goes on.
Candidates are classes that share a band of MinHash values; with 30 bands of five values,
a pair at similarity 0.8 is missed by all bands with a probability under 1e-5. MinHash
values are compared in rounds, and a pair is dropped as soon as the posterior probability of
reaching the threshold (uniform prior) is under ``tolerance``. A connected component of
candidates that fits one block is compared as it is. In a larger one, classes that merely share
boilerplate would be compared with all others, so its bands are searched first: the members of
a band key, in blocks, are joined where a pair outlives the pruning, and the components that
remain are cut into blocks, of which every pair is one step. What outlives the rounds there is
verified on the exact sets. A step returns, per class, its number of links and one edge to the
least class it is connected with, so no pair becomes a row.

Null and empty texts, and texts without a word, have no grams: they link to nothing. A row
with a null id takes no part and comes back with null class and no links. Equal rows are
copies of each other. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, only_memo, small_batches, stage, text_column
from .graph import connected_components

WORD = re.compile(r"\w+")
GRAM = 5
BANDS, ROWS = 30, 5
BLOCK = 256  # classes of a block, about
BLOCK_GRAMS = 4_000_000  # grams of a block's sets, about
BAND_BLOCK = 1024  # classes of a block of one band key, about
ROUND = 30  # MinHash values compared at a time
MEMO_WORDS = 150_000  # words of a memo generation; a process keeps two at most
FILTER_BITS, FILTER_PROBES = 1 << 27, 4  # most bits of the filter of ids, and bits of an id

_rng = np.random.default_rng(20240607)
_MULTIPLY = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_MIX = _rng.integers(0, 1 << 63, max(GRAM, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_HASH = Memo(xxhash.xxh64_intdigest, MEMO_WORDS)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def grams(text: str) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's word 5-grams."""
    words = np.array([_HASH[w] for w in WORD.findall(text.lower())], dtype=np.uint64)
    if not len(words):
        return words
    n = min(GRAM, len(words))
    total = np.full(len(words) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        total += _mixed(words[k : len(words) - n + 1 + k] + _MIX[k]) * _MIX[k]
    return np.unique(_mixed(total))


def signature(items: np.ndarray) -> np.ndarray:
    """BANDS * ROWS MinHash values of a non-empty set, 16 bits of each: half the bytes to shuffle, and a
    value in 65,536 is equal by chance, which only keeps a pair that the exact sets decide on."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(items), 4096):
        part = items[at : at + 4096]
        least = np.minimum(least, (_MULTIPLY[:, None] * part + _ADD[:, None]).min(axis=1))
    return (least >> np.uint64(48)).astype(np.uint16)


def set_digest(items: np.ndarray) -> bytes:
    return hashlib.blake2b(items.tobytes(), digest_size=16).digest()


def least_matches(threshold: float, tolerance: float, rounds: int) -> list[int]:
    """Per round, the fewest equal MinHash values that keep a pair.

    After m of n equal values the posterior of the similarity is Beta(m + 1, n - m + 1), so
    P(similarity >= t) is P(Binomial(n + 1, t) <= m).
    """
    out = []
    for r in range(1, rounds + 1):
        n, tail, m = r * ROUND, 0.0, -1
        while tail < tolerance:
            m += 1
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def _describe(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, digest of the set, MinHash values as binary (both null if empty) and size of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_memo("grams", _HASH.forget)
        for batch in small_batches(batches, text_col):
            digests, values, sizes = [], [], []
            for text in text_column(batch, text_col):
                items = grams(text)
                digests.append(set_digest(items) if len(items) else None)
                values.append(signature(items).tobytes() if len(items) else None)
                sizes.append(len(items))
            columns = [batch.column(0), pa.array(digests, pa.binary()), pa.array(values, pa.binary()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "digest", "minhash", "size"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), text_col)
    return rows.mapInArrow(run, "id bigint, digest binary, minhash binary, size bigint")


def _band_key(band: F.Column) -> F.Column:
    """One 64-bit key of a band's MinHash values, different for each band."""
    return F.xxhash64(band, F.substring("minhash", band * (2 * ROWS) + 1, F.lit(2 * ROWS)))


def _probe_bits(hashed: np.ndarray, bits: int) -> np.ndarray:
    """A row per probe: the places of 64-bit hashes in a filter of ``bits`` bits."""
    first, step = hashed & (bits - 1), (hashed.view(np.uint64) >> np.uint64(32)).astype(np.int64) | 1
    return np.stack([(first + k * step) & (bits - 1) for k in range(FILTER_PROBES)])


def _id_filter(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of the long column ``id`` as 64-bit words: 16 to 32 bits an id, at most ``FILTER_BITS``
    in all (16 MB). It passes every id, and few others (more of them where the bits are at the limit)."""
    bits = min(FILTER_BITS, max(1 << 10, 1 << (16 * ids.count()).bit_length()))
    mask, hashed = F.lit(bits - 1).cast("long"), F.xxhash64("id")
    first, step = hashed.bitwiseAND(mask), F.shiftrightunsigned(hashed, 32).bitwiseOR(F.lit(1).cast("long"))
    places = F.array(*[(first + step * k).bitwiseAND(mask) for k in range(FILTER_PROBES)])
    words = ids.select(F.explode(places).alias("at")).select(
        F.shiftright("at", 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int")).alias("bit")
    )
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out


def _passing(filter_words: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Which hashes of ids the filter passes."""
    at = _probe_bits(hashed, 64 * len(filter_words))
    return ((filter_words[at >> 6] >> (at & 63)) & 1).all(axis=0)


def _sets(df: DataFrame, ids: DataFrame) -> DataFrame:
    """digest and grams, as binary, of the (id, text) rows whose id is among ``ids``, and of few others.

    The texts stay where they are: a filter of the ids goes to them, so that no text is shuffled.
    """
    words = df.sparkSession.sparkContext.broadcast(_id_filter(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_memo("grams", _HASH.forget)
        for batch in batches:
            batch = batch.filter(pa.array(_passing(words.value, batch.column("hashed").to_numpy())))
            for part in small_batches(iter([batch]), "text", 2 << 20):
                sets = [x for x in map(grams, text_column(part, "text")) if len(x)]
                columns = [[set_digest(x) for x in sets], [x.tobytes() for x in sets]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], ["digest", "grams"])

    rows = df.where("id IS NOT NULL").select(F.xxhash64("id").alias("hashed"), "text")
    return rows.mapInArrow(run, "digest binary, grams binary")


def _intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """|sets[left[k]] & sets[right[k]]| for every k."""
    used = np.unique(np.concatenate([left, right]))
    lengths = np.array([len(sets[i]) for i in used])
    column, counts = np.unique(np.concatenate([sets[i] for i in used]), return_inverse=True, return_counts=True)[1:]
    several = counts > 1  # grams of a single set meet nothing
    number = np.cumsum(several) - 1
    width = int(several.sum())
    if len(left) * lengths.mean() * 10 < len(used) ** 2 * width / 100:
        out = np.empty(len(left), np.int64)
        for k, (i, j) in enumerate(zip(left, right)):
            a, b = sets[i], sets[j]
            at = np.searchsorted(a, b)
            at[at == len(a)] = 0
            out[k] = np.count_nonzero(a[at] == b)
        return out
    row = np.repeat(np.arange(len(used)), lengths)
    keep = several[column]
    row, column = row[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(used), len(used)), np.float32)
    for at in range(0, width, 4096):  # products of 0/1 matrices, a slice of grams at a time
        a, b = np.searchsorted(column, [at, at + 4096])
        part = np.zeros((len(used), min(4096, width - at)), np.float32)
        part[row[a:b], column[a:b] - at] = 1
        total += part @ part.T
    place = np.empty(int(used.max()) + 1, np.int64)
    place[used] = np.arange(len(used))
    return np.rint(total[place[left], place[right]]).astype(np.int64)


def link_block(
    values: np.ndarray, sets: list[np.ndarray], blocks: np.ndarray, threshold: float, needed: list[int]
) -> tuple[np.ndarray, np.ndarray]:
    """All pairs at ``threshold`` or above, as two index arrays.

    ``blocks`` names the two blocks of the rows (or one): with two, only pairs across them
    are compared.
    """
    sizes = np.array([len(s) for s in sets])
    names = np.unique(blocks)
    first = np.flatnonzero(blocks == names[0])
    second = np.flatnonzero(blocks == names[-1])
    left, right = (x.ravel() for x in np.meshgrid(first, second, indexing="ij"))
    fits = np.minimum(sizes[left], sizes[right]) >= threshold * np.maximum(sizes[left], sizes[right]) - 1e-9
    if len(names) == 1:
        fits &= left < right
    left, right = left[fits], right[fits]
    equal = np.zeros(len(left), np.int64)
    for r, least in enumerate(needed):  # drop pairs that are now unlikely to reach the threshold
        part = values[:, r * ROUND : (r + 1) * ROUND]
        for at in range(0, len(left), 65536):
            pick = slice(at, at + 65536)
            equal[pick] += (part[left[pick]] == part[right[pick]]).sum(axis=1)
        alive = equal >= least
        left, right, equal = left[alive], right[alive], equal[alive]
    if not len(left):
        return left, right
    common = _intersections(sets, left, right)
    linked = common >= threshold * (sizes[left] + sizes[right] - common) - 1e-9
    return left[linked], right[linked]


def _least_connected(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least index of each item's connected component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _rows_of_steps(batches: Iterator[pa.RecordBatch], key: tuple[str, ...]) -> Iterator[list[dict]]:
    """The rows of each step, one step at a time; they come sorted by ``key``."""
    rows, current = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if (name := tuple(row[c] for c in key)) != current:
                if rows:
                    yield rows
                rows, current = [], name
            rows.append(row)
    if rows:
        yield rows


def _dealt(steps: DataFrame, *key: str) -> DataFrame:
    partitions = int(steps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return steps.repartition(partitions, *key).sortWithinPartitions(*key)


def _block_pairs(rows: DataFrame) -> DataFrame:
    """Each row once for every pair (low, high) of blocks that its ``block`` is in."""
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    names = [c for c in rows.columns if c != "blocks"]
    return rows.select(*names, other.alias("other")).select(
        *names, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )


def survivors(values: np.ndarray, sizes: np.ndarray, threshold: float, needed: list[int]) -> np.ndarray:
    """The least row that each row is connected with by pairs that no round drops.

    Rows are reached from the least one on; a reached row is compared only with those not
    reached yet, so a group of near copies takes few comparisons.
    """
    root = np.full(len(values), -1)
    rest = np.arange(len(values))
    while len(rest):
        start, rest = rest[0], rest[1:]
        root[start] = start
        reached = [start]
        while reached and len(rest):
            i = reached.pop()
            near = np.flatnonzero(np.minimum(sizes[rest], sizes[i]) >= threshold * np.maximum(sizes[rest], sizes[i]) - 1e-9)
            equal = np.zeros(len(near), np.int64)
            for r, least in enumerate(needed):
                part = slice(r * ROUND, (r + 1) * ROUND)
                equal += (values[rest[near], part] == values[i, part]).sum(axis=1)
                near, equal = near[equal >= least], equal[equal >= least]
            root[rest[near]] = start
            reached.extend(rest[near].tolist())
            rest = np.delete(rest, near)
    return root


def _likely(steps: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Edges (a, b) from classes to the least one that the pruning leaves them connected with in a step."""
    needed = least_matches(threshold, tolerance, BANDS * ROWS // ROUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _rows_of_steps(batches, ("key", "low", "high")):
            rows = sorted(rows, key=lambda r: r["digest"])
            values = np.stack([np.frombuffer(r["minhash"], np.uint16) for r in rows])
            root = survivors(values, np.array([r["size"] for r in rows]), threshold, needed)
            joined = np.flatnonzero(root != np.arange(len(rows))).tolist()
            ends = [[rows[i]["digest"] for i in joined], [rows[root[i]]["digest"] for i in joined]]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in ends], ["a", "b"])

    return _dealt(steps, "key", "low", "high").mapInArrow(run, "a binary, b binary")


_STEP = "a binary, b binary, links bigint"


def _compare(steps: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Rows (a, b, links): class, least class connected within the step, linked documents."""
    needed = least_matches(threshold, tolerance, BANDS * ROWS // ROUND)

    def step(rows: list[dict]) -> pa.RecordBatch | None:
        rows = sorted(rows, key=lambda r: r["digest"])
        if len(rows) < 2:
            return None
        values = np.stack([np.frombuffer(r["minhash"], np.uint16) for r in rows])
        sets = [np.frombuffer(r["grams"], np.uint64) for r in rows]
        blocks = np.array([r["block"] for r in rows])
        if rows[0]["low"] != rows[0]["high"] and len(np.unique(blocks)) < 2:
            return None  # one of the two blocks is empty
        left, right = link_block(values, sets, blocks, threshold, needed)
        if not len(left):
            return None
        copies = np.array([r["copies"] for r in rows], np.int64)
        links = np.zeros(len(rows), np.int64)
        np.add.at(links, left, copies[right])
        np.add.at(links, right, copies[left])
        root = _least_connected(len(rows), left, right)
        own = np.unique(np.concatenate([left, right])).tolist()
        return pa.RecordBatch.from_arrays(
            [pa.array([rows[i]["digest"] for i in own], pa.binary()), pa.array([rows[root[i]]["digest"] for i in own], pa.binary()), pa.array(links[own])],
            ["a", "b", "links"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _rows_of_steps(batches, ("root", "low", "high")):
            if (out := step(rows)) is not None:
                yield out

    return _dealt(steps, "root", "low", "high").mapInArrow(run, _STEP)


def _candidates(classes: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """(node, root) of the classes to compare, with ``blocks``, the number of blocks of the root."""

    def sized(members: DataFrame) -> DataFrame:
        sizes = members.join(classes.select(F.col("digest").alias("node"), "size"), "node").groupBy("root").agg(
            F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("size") / BLOCK_GRAMS)).cast("int").alias("blocks")
        )
        # written first, so that the join has two plain exchanges, whose hot roots are split
        return members.join(stage(sizes, "sizes"), "root")

    keyed = classes.select("digest", "minhash", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"))
    keyed = keyed.select("digest", _band_key(F.col("band")).alias("key"))
    buckets = keyed.groupBy("key").agg(F.min("digest").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = stage(buckets, "buckets")
    edges = keyed.join(buckets.hint("merge"), "key").where("digest <> least")
    members = stage(sized(stage(connected_components(edges.select(F.col("digest").alias("a"), F.col("least").alias("b"))), "met")), "candidates")
    large = members.where("blocks > 1").select(F.col("node").alias("digest"))
    if large.isEmpty():
        return members
    block = F.pmod(F.xxhash64("digest", "key"), F.col("blocks")).cast("int")
    banded = (
        keyed.join(large, "digest", "left_semi")
        .join(buckets.select("key", F.ceil(F.col("n") / BAND_BLOCK).cast("int").alias("blocks")), "key")
        .withColumn("block", block)
    )
    # the pair of different blocks compares inside them too
    steps = _block_pairs(banded.select("key", "digest", "blocks", "block", F.col("blocks").alias("of")))
    steps = steps.where("of = 1 OR low < high").drop("of", "block")
    # the values come last: a class is in many steps
    values = classes.select("digest", "minhash", "size").join(large, "digest", "left_semi")
    steps = steps.join(values, "digest")
    likely = stage(_likely(steps, threshold, tolerance).distinct(), "likely")
    return members.where("blocks = 1").unionByName(sized(stage(connected_components(likely), "likely_groups")))


def near_duplicates(
    df: DataFrame, threshold: float = 0.8, tolerance: float = 1e-6, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per input row: id, ``class_id`` (least id of its group of linked documents),
    ``copy_id`` (least id with the same set), ``n_links`` (documents at the threshold or above, copies included).
    """
    described = stage(_describe(df, id_col, text_col), "sets")
    taking_part = described.where("id IS NOT NULL AND digest IS NOT NULL")
    classes = stage(
        taking_part.groupBy("digest").agg(
            F.min("id").alias("copy_id"), F.count(F.lit(1)).alias("copies"), F.first("minhash").alias("minhash"), F.first("size").alias("size")
        ),
        "classes",
    )
    placed = (
        _candidates(classes, threshold, tolerance).withColumnRenamed("node", "digest").hint("merge")
        .join(classes.select("digest", "copy_id", "copies", "minhash"), "digest")
        .withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
    )
    placed = stage(placed, "placed")
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sets = _sets(texts, placed.select(F.col("copy_id").alias("id"))).dropDuplicates(["digest"])
    steps = _block_pairs(placed.select("digest", "root", "copies", "minhash", "blocks", "block")).join(sets, "digest")
    linked = stage(_compare(steps, threshold, tolerance), "links")
    groups = connected_components(linked.select("a", "b"))
    links = linked.groupBy(F.col("a").alias("digest")).agg(F.sum("links").alias("links"))
    grouped = (
        links.join(groups.withColumnRenamed("node", "digest"), "digest")
        .join(classes.select("digest", "copy_id"), "digest")
    )
    grouped = stage(grouped, "grouped")
    least = stage(grouped.groupBy("root").agg(F.min("copy_id").alias("class_id")), "least")
    grouped = grouped.join(least, "root").select("digest", "class_id", "links")
    known = classes.select("digest", "copy_id", "copies").join(grouped, "digest", "left").select(
        "digest", "copy_id", F.coalesce("class_id", "copy_id").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    # written first, so that the join below has two plain exchanges, whose hot digests are split
    known = stage(known, "known")
    alone = described.where("id IS NULL OR digest IS NULL").select("id", F.col("id").alias("class_id"), F.col("id").alias("copy_id"), F.lit(0).cast("long").alias("n_links"))
    return (
        taking_part.select("id", "digest").join(known, "digest").select("id", "class_id", "copy_id", "n_links")
        .unionAll(alone).withColumnRenamed("id", id_col)
    )


def keep_one_of_each(df: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` without all but the least id of each group of near copies.

    Rows with a null id stay; of several rows with the same id that stays, one remains.
    """
    found = stage(near_duplicates(df, threshold, id_col=id_col, text_col=text_col), "groups").where(F.col(id_col).isNotNull())
    kept = (F.col(id_col) == F.col("class_id")) & F.col("class_id").isNotNull()
    by_id = found.groupBy(id_col).agg(F.max(kept.cast("int")).alias("stays"), F.count(F.lit(1)).alias("rows"))
    dropped = by_id.where("stays = 0").select(id_col)
    rest = df.join(dropped, id_col, "left_anti").select(*df.columns)
    repeated = by_id.where("stays = 1 AND rows > 1").select(id_col)
    if repeated.isEmpty():
        return rest
    single = rest.join(repeated, id_col, "left_anti").select(*df.columns)
    return single.unionAll(rest.join(repeated, id_col, "left_semi").select(*df.columns).dropDuplicates([id_col]))
