"""Prefix trie of rebuilt conversations, by composable fingerprints.

A conversation ``c`` is rebuilt as the first ``h`` turns of its base ``c - c % 20`` followed by its
own turns after the first ``h`` (``h = crc32(c) % 4``). No rebuilt text is made. The fingerprint of a
sequence of turns is a monoid element ``(length, sum of hash_i * B^i mod P)`` in four lanes, and the
product of two is ``(n + m, x + B^n * y)``. So every prefix of a rebuilt conversation is a product
of a prefix of the base's head and of a run of own turns, both known from the stored turns: a few
integers and the reference ``(conversation, place)`` of its last turn.

Prefixes of equal depth and fingerprint are a node. Equality is verified, not assumed: all
members of a node must come from one parent node and have last turns of one 128-bit digest, and
the stored turns of a digest must all be the same role and text (exact comparison). If any check
fails, everything is done anew with another hash seed.

Sums over subtrees need no walk: a node's members hold all nodes below it, so a sum over the
subtree is a sum, over the members, of a running sum from the conversation's end. For sums over
distinct nodes a node counts at its smallest member only.

Long conversations are scanned in two levels (inside runs of 1024 turns or depths, then over the
runs), and the products make the parts composable; no step holds a whole conversation or all
members of a node. The ids of the conversations that end at a node are joined in pieces of 4096
consecutive ids, then hashed as a stream.

Rows without ``conv_id`` belong to no conversation. A null turn comes first; null role or text is
empty. Turns of one number go by role and text; repeated rows are repeated turns. An empty table
gives no rows. Only the four named columns are read. Ids are integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

BASE_EVERY = 20
HEAD_MOST = 3  # turns of a head at most
RUN_BITS = 10  # 1024 turns or depths are scanned at a time
END_BITS = 12  # 4096 consecutive ids are joined at a time
PRIME = (1 << 31) - 1
LANES = (1_000_003, 69_621_113, 523_456_789, 1_987_654_321)  # B of each lane
ATTEMPTS = 4
NO_ENDS = hashlib.sha256(b"").hexdigest()
_ORDER_BITS = 31  # a conversation has fewer than 2^31 turns


def _power(base: int, exponent: str) -> Column:
    """``base ^ exponent mod PRIME`` from the bits of a long column."""
    out = "1L"
    for bit in range(_ORDER_BITS):
        out = f"({out} * IF({exponent} & {1 << bit}L != 0, {pow(base, 1 << bit, PRIME)}L, 1L)) % {PRIME}L"
    return F.expr(out)


def _head_product(i: int, turns: int) -> str:
    """SQL of lane ``i`` of the product of the first turns of ``head`` (missing ones add nothing)."""
    return "(" + " + ".join(f"coalesce(get(head, {j}).g{i} * {pow(LANES[i], j, PRIME)}L % {PRIME}L, 0L)" for j in range(turns)) + f") % {PRIME}L"


def _running(df: DataFrame, key: str, at: Column, order: Sequence[Column], values: Sequence[str], name: str) -> DataFrame:
    """``df`` with the running sum ``sum_<v>`` of each value per key, in two levels.

    ``at`` is a long, ascending in ``order``: its upper bits are the run. Only keys of more than one
    run have a second level. The first level is written once.
    """
    run = F.shiftright(at, RUN_BITS)
    inside = Window.partitionBy(key, "_run").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = df.withColumn("_run", run)
    local = stage(local.select("*", *(F.sum(v).over(inside).alias(f"sum_{v}") for v in values)), name)
    totals = local.groupBy(key, "_run").agg(*(F.sum(v).alias(v) for v in values))
    earlier = Window.partitionBy(key).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(key, "_run", *(F.sum(v).over(earlier).alias(f"_{v}") for v in values)).where(F.col(f"_{values[0]}").isNotNull())
    sums = {f"sum_{v}": F.col(f"sum_{v}") + F.coalesce(F.col(f"_{v}"), F.lit(0)) for v in values}
    return local.join(before, [key, "_run"], "left").withColumns(sums).drop("_run", *(f"_{v}" for v in values))


def _stored_turns(conversations: DataFrame, seed: int) -> DataFrame:
    """``conv, pos, role, text, words``, the turn's digest ``x, y`` and its hash per lane ``g0..g3``."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.lit(1).cast("long").alias("one")
    )
    first = F.lit(-(1 << 63)).cast("long")
    turns = _running(turns, "conv", F.coalesce("turn", first), [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], ["one"], "turns")
    turns = turns.withColumnRenamed("sum_one", "pos").drop("one", "turn")
    turns = turns.withColumn("words", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long"))
    turns = turns.withColumn("x", F.xxhash64(F.lit(2 * seed), "role", "text")).withColumn("y", F.xxhash64(F.lit(2 * seed + 1), "text", "role"))
    halves = [F.col("x"), F.shiftrightunsigned("x", 32), F.col("y"), F.shiftrightunsigned("y", 32)]
    return turns.select("*", *(F.pmod(v, F.lit(PRIME)).alias(f"g{i}") for i, v in enumerate(halves)))


def _prefixes(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per rebuilt conversation its length ``(c, size)``; and a row per conversation and depth:
    ``c, d, size``, node key ``k1, k2``, parent key ``q1, q2``, digest ``x, y`` and words of the last turn
    and its reference."""
    lanes = range(len(LANES))
    brief = ["pos", "words", "x", "y", *(f"g{i}" for i in lanes)]
    heads = turns.where((F.col("conv") % BASE_EVERY == 0) & (F.col("pos") <= HEAD_MOST))
    heads = heads.groupBy(F.col("conv").alias("base")).agg(F.sort_array(F.collect_list(F.struct(*brief))).alias("head"))
    h = F.crc32(F.col("c").cast("string").cast("binary")) % 4
    convs = turns.groupBy(F.col("conv").alias("c")).agg(F.max("pos").alias("n")).withColumn("h", h)
    convs = convs.withColumn("base", F.col("c") - F.col("c") % BASE_EVERY).join(heads, "base", "left")
    convs = convs.withColumn("head", F.coalesce(F.slice("head", F.lit(1), F.col("h").cast("int")), F.array().cast(heads.schema["head"].dataType)))
    convs = convs.withColumns({f"p{i}": F.expr(_head_product(i, HEAD_MOST)) for i in lanes}).withColumn("k", F.size("head").cast("long"))
    convs = stage(convs.withColumn("size", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "convs")

    def prefix(j: int) -> str:
        """The head's prefix of ``j + 1`` turns."""
        values = [f"{_head_product(i, j + 1)} AS v{i}" for i in lanes]
        turn = [f"get(head, {j}).{b} AS {b}" for b in brief[1:]]
        fields = [f"{j + 1}L AS d", *values, *turn, "base AS ref_conv", f"get(head, {j}).pos AS ref_pos"]
        return f"IF(k > {j}, struct({', '.join(fields)}), NULL)"

    from_heads = convs.select("c", "size", F.expr(f"inline(array_compact(array({', '.join(prefix(j) for j in range(HEAD_MOST))})))"))

    own_h = F.crc32(F.col("conv").cast("string").cast("binary")) % 4
    own = turns.drop("role", "text").withColumn("rel", F.col("pos") - own_h - 1).where(F.col("rel") >= 0)
    own = own.withColumns({f"t{i}": F.col(f"g{i}") * _power(LANES[i], "rel") % PRIME for i in lanes})
    own = _running(own, "conv", F.col("rel"), [F.col("rel")], [f"t{i}" for i in lanes], "own")
    own = own.withColumnRenamed("conv", "c").join(convs.select("c", "k", "size", *(f"p{i}" for i in lanes)), "c")
    scale = [f"element_at(array({', '.join(f'{pow(b, j, PRIME)}L' for j in range(HEAD_MOST + 1))}), CAST(k AS INT) + 1)" for b in LANES]
    shift = {f"v{i}": F.expr(f"(p{i} + (sum_t{i} % {PRIME}L) * {scale[i]} % {PRIME}L) % {PRIME}L") for i in lanes}
    own = own.withColumns(shift).select(
        "c", "size", (F.col("k") + F.col("rel") + 1).alias("d"), *(f"v{i}" for i in lanes), *brief[1:], F.col("c").alias("ref_conv"), F.col("pos").alias("ref_pos")
    )
    rows = from_heads.unionByName(own)
    before = {f"u{i}": F.pmod(F.col(f"v{i}") - F.col(f"g{i}") * _power(LANES[i], "(d - 1)") % PRIME, F.lit(PRIME)) for i in lanes}

    def packed(a: str, b: str) -> Column:
        return F.col(a) * (1 << 31) + F.col(b)

    rows = rows.withColumns(before).select(
        "c", "d", "size", packed("v0", "v1").alias("k1"), packed("v2", "v3").alias("k2"), packed("u0", "u1").alias("q1"), packed("u2", "u3").alias("q2"),
        "x", "y", "words", "ref_conv", "ref_pos",
    )
    return convs.select("c", "size"), stage(rows, "prefixes")


def _same(*names: str) -> list[Column]:
    return [f(n).alias(f"{n}_{f.__name__}") for n in names for f in (F.min, F.max)]


def _differ(*names: str) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"{n}_min") != F.col(f"{n}_max") for n in names])


def _ends(rows: DataFrame) -> DataFrame:
    """``d, k1, k2, ends_sha256`` of nodes where conversations end; ``rows``: ``c, d, k1, k2`` of those."""
    key = ["d", "k1", "k2"]
    parts = rows.groupBy(*key, F.shiftright("c", END_BITS).alias("part")).agg(
        F.array_join(F.sort_array(F.collect_list("c")).cast("array<string>"), ",").alias("ids")
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sha = None, hashlib.sha256()
        for batch in batches:
            done = []
            for *node, ids in zip(*(batch.column(k).to_pylist() for k in [*key, "ids"])):
                if node != last:
                    if last is not None:
                        done.append((*last, sha.hexdigest()))
                    last, sha = node, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.encode())
            yield result(done)
        if last is not None:
            yield result([(*last, sha.hexdigest())])

    def result(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done)) if done else [[], [], [], []]
        types = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [*key, "ends_sha256"])

    parts = parts.repartition(*key).sortWithinPartitions(*key, "part")
    return parts.mapInArrow(digest, "d bigint, k1 bigint, k2 bigint, ends_sha256 string")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """A row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``, and the reference ``turn_conv_id, turn_pos`` of its last turn."""
    key = ["d", "k1", "k2"]
    for seed in range(ATTEMPTS):
        turns = stage(_stored_turns(conversations, seed), "stored")
        digests = turns.groupBy("x", "y").agg(*_same("role", "text")).where(_differ("role", "text"))
        convs, rows = _prefixes(turns)
        nodes = rows.groupBy(*key).agg(
            F.count(F.lit(1)).alias("n_convs"), F.min("c").alias("conv_id"), F.max("size").alias("deepest"),
            F.min(F.struct("ref_conv", "ref_pos")).alias("ref"), *_same("x", "y", "q1", "q2", "words"),
        )
        nodes = stage(nodes, "nodes")
        if digests.isEmpty() and nodes.where(_differ("x", "y", "q1", "q2")).isEmpty():
            break
    else:
        raise RuntimeError(f"fingerprints collided under {ATTEMPTS} seeds")
    nodes = nodes.select(
        *key, "n_convs", "conv_id", (F.col("deepest") == F.col("d")).alias("childless"), "ref",
        (F.col("d") - 1).alias("pd"), F.col("q1_min").alias("q1"), F.col("q2_min").alias("q2"),
    )

    # sums over subtrees, from the conversations' ends
    smallest = nodes.select(F.col("conv_id").alias("c"), "d", F.lit(1).cast("long").alias("is_node"), F.col("childless").cast("long").alias("leaf"))
    marked = rows.select("c", *key, "words").join(smallest, ["c", "d"], "left").select(
        "c", *key,
        F.coalesce("leaf", F.lit(0)).alias("leaves"),
        (F.col("words") * (1 - F.coalesce("is_node", F.lit(0)))).alias("saved"),
    )
    back = -F.col("d")
    marked = _running(marked, "c", back, [back], ["leaves", "saved"], "marked")
    sums = stage(marked.groupBy(*key).agg(F.sum("sum_leaves").alias("n_leaves"), F.sum("sum_saved").alias("saved_tokens")), "sums")

    children = nodes.groupBy(F.col("pd").alias("d"), F.col("q1").alias("k1"), F.col("q2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("d").alias("pd"), F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    ended = rows.where("d = size").select("c", *key)
    zero = F.lit(0).cast("long")
    ended = ended.unionByName(convs.where("size = 0").select("c", *(zero.alias(k) for k in key)))
    ends = stage(_ends(ended), "ends")
    parented = stage(nodes.where("d > 1").join(parents, ["pd", "q1", "q2"]).select(*key, "parent_conv_id"), "parents")
    tree = nodes.join(sums, key).join(children, key, "left").join(parented, key, "left").join(ends.where("d > 0"), key, "left")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "turn_conv_id", "turn_pos"]
    root = _root(convs, nodes, sums, ends)
    inner = tree.select(
        "conv_id", F.col("d").alias("depth"),
        F.when(F.col("d") == 1, F.lit(root[0] if root else None).cast("long")).otherwise(F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        F.col("ref.ref_conv").alias("turn_conv_id"), F.col("ref.ref_pos").alias("turn_pos"),
    )
    outer = conversations.sparkSession.createDataFrame([root] if root else [], ", ".join(f"{c} {t}" for c, t in inner.dtypes))
    return inner.select(*columns).unionByName(outer)


def _root(convs: DataFrame, nodes: DataFrame, sums: DataFrame, ends: DataFrame) -> tuple | None:
    """The root's row, from a few totals; None without conversations."""
    members = convs.agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("first")).first()
    if not members.n:
        return None
    whole = nodes.agg(F.count_if(F.col("d") == 1).alias("children"), F.count_if("childless").alias("leaves")).first()
    saved = sums.where("d = 1").agg(F.sum("saved_tokens")).first()[0] or 0
    ended = ends.where("d = 0").first()
    return members["first"], 0, None, members.n, whole.children, max(whole.leaves, 1), saved, ended.ends_sha256 if ended else NO_ENDS, None, None
