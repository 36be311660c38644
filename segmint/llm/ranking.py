"""Ranked lexical search: exact top-k of all documents per query, with norm buckets.

A document is its impact vector: for each term of the queries that it holds, the integer
``(1000000000 * tf) div (1000 * tf + 8 * m)``, where ``m = 100 - 75 + (75 * n * N) div L`` grows
with its length. A query's vector holds ``floor(1000 * ln((2N + 2) / (2df + 1)))`` per term, times
its repeats; the score is the inner product. The search is LEMP's:

1. Vectors are ordered by length (Euclidean norm) into buckets. The longest sixteenth of all
   vectors is searched first; its k-th scores are thresholds for all the rest.
2. In a task the vectors are sorted by norm and taken in buckets of ``BUCKET``. By
   Cauchy-Schwarz no vector of a bucket can reach a query's threshold if the product of the
   longest norm and the query's norm does not: the search of that query ends there.
3. Inside a bucket the query's coordinates are taken by weight. Those that are left give no
   vector more than the sum of their largest entries in the bucket, nor more than the norm of
   the query's rest times the norm of the vector's rest. Vectors whose bound stays below the
   threshold are dropped.
4. Survivors are rescored exactly in 64-bit integers.

Queries are taken in blocks of at most ``BLOCK_CHARS`` characters of text (by a hash, so about
that), each a pass over the documents; a block's terms, weights and results are what is
broadcast or collected, never anything that grows with the documents. Each task returns at
most k rows per query, and only those that reach the thresholds.

Null text has no terms. Documents without terms are not counted and never found. Each row is
a document and each query row a query, also where ids repeat; a null query text finds nothing.
Equal scores go by ascending id, null ids last. An empty table gives no rows. Only the named
columns are read, so other columns do not matter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import list_array, small_batches, stage

BLOCK_CHARS = 2_000_000
BUCKET = 2048  # vectors
HEAD_SHARE = 16  # the longest 1/16 of the vectors give the thresholds
# bytes of a term: digits, letters and all of a character outside ASCII; A-Z are lowered
_TERM_BYTES = bytes(
    b + 32 if 65 <= b < 91 else b if 48 <= b < 58 or 97 <= b < 123 or b > 127 else 32 for b in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return (text or b"").translate(_TERM_BYTES).split()


@dataclass(frozen=True)
class QueryBlock:
    """Queries as sparse vectors over the block's terms."""

    ids: list  # per query
    terms: list[np.ndarray]  # per query: distinct term numbers, heaviest first
    weights: list[np.ndarray]  # int64, same order

    @property
    def norms(self) -> list[float]:
        return [math.sqrt(float((w.astype(float) ** 2).sum())) for w in self.weights]


def _vectors(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """``id, n, terms, tfs`` of every document that has a term; only terms of the vocabulary are kept."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kind = docs.schema[id_col].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        for batch in small_batches(batches, "text"):
            sizes, terms, tfs = [], [], []
            for text in batch.column("text").cast(pa.large_binary()):
                found = terms_of(text.as_py())
                held = Counter(t for t in found if t in number)
                sizes.append(len(found))
                terms.append(np.array([number[t] for t in held], dtype=np.int32))
                tfs.append(np.fromiter(held.values(), np.int64, len(held)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), list_array(terms, pa.int32()), list_array(tfs, pa.int64())],
                ["id", "n", "terms", "tfs"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(count, f"id {kind}, n bigint, terms array<int>, tfs array<bigint>").where("n > 0")


def _impacts(n_docs: int, n_terms: int) -> Column:
    m = f"100 - 75 + (75 * n * {n_docs}L) div {n_terms}L"
    return F.expr(f"transform(tfs, tf -> (1000000000L * tf) div (1000 * tf + 8 * ({m})))")


def _norm(impacts: str) -> Column:
    return F.sqrt(F.aggregate(impacts, F.lit(0.0), lambda s, p: s + p.cast("double") * p))


def _best(scores: np.ndarray, ids: list, k: int) -> tuple[np.ndarray, list]:
    """The k best by score, then ascending id (null last)."""
    if len(scores) > k:
        keep = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
        scores, ids = scores[keep], [ids[i] for i in keep]
    order = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i] is None, ids[i]))[:k]
    return scores[order], [ids[i] for i in order]


class BucketSearch:
    """One task's search of a query block; ``least``: the score a result needs per query."""

    def __init__(self, queries: QueryBlock, least: np.ndarray, n_terms: int, k: int):
        self.queries, self.k = queries, k
        self.least = least.copy()
        self.norms = queries.norms
        self.dense = np.zeros(n_terms, dtype=np.int64)
        self.found: list[tuple[np.ndarray, list]] = [(np.empty(0, np.int64), []) for _ in queries.ids]

    def add(self, ids: list, terms: np.ndarray, impacts: np.ndarray, starts: np.ndarray) -> None:
        """Search vectors given as rows ``terms[starts[i] : starts[i + 1]]``, in any order."""
        lengths = np.diff(starts)
        rows = np.repeat(np.arange(len(ids)), lengths)
        norms = np.sqrt(np.bincount(rows, impacts.astype(float) ** 2, len(ids)))
        order = np.argsort(-norms, kind="stable")
        open_queries = set(range(len(self.norms)))
        for at in range(0, len(order), BUCKET):
            picked = order[at : at + BUCKET]
            open_queries = {q for q in open_queries if not self._below(self.norms[q] * norms[picked[0]], q)}
            if not open_queries:
                return
            size = lengths[picked]
            ends = np.cumsum(size)
            flat = np.repeat(starts[picked] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
            self._search(open_queries, [ids[i] for i in picked], norms[picked], terms[flat], impacts[flat], np.concatenate([[0], ends]))

    def _below(self, bound: float, q: int) -> bool:
        """Whether a bound in doubles rules out a score that counts (with room for rounding)."""
        return bound * (1 + 1e-9) + 1 < max(self.least[q], 1)

    def _search(self, open_queries: set[int], ids: list, norms: np.ndarray, terms: np.ndarray, impacts: np.ndarray, starts: np.ndarray) -> None:
        rows = np.repeat(np.arange(len(ids)), np.diff(starts))
        by_term = np.argsort(terms, kind="stable")
        term, row, impact = terms[by_term], rows[by_term], impacts[by_term].astype(float)
        first = np.searchsorted(term, np.arange(len(self.dense) + 1))
        held = first[1:] > first[:-1]
        largest = np.zeros(len(self.dense))
        largest[held] = np.maximum.reduceat(impact, first[:-1][held]) if len(impact) else 0
        for q in sorted(open_queries):
            qt, qw = self.queries.terms[q], self.queries.weights[q].astype(float)
            here = held[qt]
            qt, qw = qt[here], qw[here]
            if not len(qt):
                continue
            need = max(self.least[q], 1)
            # what the coordinates from the j-th on can add: by their largest entries, and by norm
            by_entry = np.append(np.cumsum((qw * largest[qt])[::-1])[::-1], 0.0)
            by_norm = np.append(np.sqrt(np.cumsum((qw**2)[::-1])[::-1]), 0.0)
            rest = np.minimum(by_entry, by_norm * norms[0])
            focus = int(np.argmax(rest * (1 + 1e-9) + 1 < need)) if rest[-1] * (1 + 1e-9) + 1 < need else len(qt)
            part, squares = np.zeros(len(ids)), np.zeros(len(ids))
            for t, w in zip(qt[:focus], qw[:focus]):
                a, b = first[t], first[t + 1]
                part[row[a:b]] += w * impact[a:b]
                squares[row[a:b]] += impact[a:b] ** 2
            tail = np.minimum(by_entry[focus], by_norm[focus] * np.sqrt(np.maximum(norms**2 * (1 + 1e-9) - squares, 0)))
            left = np.flatnonzero((squares > 0) & ((part + tail) * (1 + 1e-9) + 1 >= need))
            if len(left):
                self._rescore(q, left, ids, terms, impacts, starts)

    def _rescore(self, q: int, left: np.ndarray, ids: list, terms: np.ndarray, impacts: np.ndarray, starts: np.ndarray) -> None:
        qt = self.queries.terms[q]
        self.dense[qt] = self.queries.weights[q]
        size = starts[left + 1] - starts[left]
        ends = np.cumsum(size)
        flat = np.repeat(starts[left] - (ends - size), size) + np.arange(ends[-1])
        scores = np.add.reduceat(self.dense[terms[flat]] * impacts[flat], ends - size)
        self.dense[qt] = 0
        good = np.flatnonzero(scores >= max(self.least[q], 1))
        if len(good):
            old, old_ids = self.found[q]
            scores, names = _best(np.concatenate([old, scores[good]]), old_ids + [ids[left[i]] for i in good], self.k)
            self.found[q] = scores, names
            if len(scores) == self.k:
                self.least[q] = max(self.least[q], scores[-1])


def _search(vectors: DataFrame, block: QueryBlock, least: np.ndarray, n_terms: int, k: int) -> DataFrame:
    """``query, id, score``: at most k rows per task and query."""
    shared = vectors.sparkSession.sparkContext.broadcast((block, least))
    kind = vectors.schema["id"].dataType.simpleString()
    arrow_kind = vectors.select("id").limit(0).toArrow().schema.field("id").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, least = shared.value
        search = BucketSearch(queries, least, n_terms, k)
        for batch in batches:
            terms, impacts = batch.column("terms"), batch.column("impacts")
            starts = np.concatenate([[0], np.cumsum(terms.value_lengths().to_numpy())])
            search.add(batch.column("id").to_pylist(), terms.flatten().to_numpy(), impacts.flatten().to_numpy(), starts)
        rows = [(q, i, s) for q, (scores, ids) in enumerate(search.found) for s, i in zip(scores.tolist(), ids)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], arrow_kind), pa.array([r[2] for r in rows], pa.int64())],
            ["query", "id", "score"],
        )

    return vectors.select("id", "terms", "impacts").mapInArrow(run, f"query int, id {kind}, score bigint")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _rank_block(docs: DataFrame, queries: list[tuple], id_col: str, text_col: str, k: int) -> DataFrame:
    """``query`` (number in the block), ``rank``, ``id``, ``score``."""
    counted = [Counter(terms_of(text)) for _, text in queries]
    vocabulary = {t: i for i, t in enumerate(sorted({t for c in counted for t in c}))}
    vectors = stage(_vectors(docs, vocabulary, id_col, text_col), "vectors")
    total = vectors.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    df = {r.term: r.docs for r in vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("docs")).collect()}
    terms, weights = [], []
    for c in counted:
        held = [(math.floor(1000 * math.log((2 * total.docs + 2) / (2 * df[i] + 1))) * n, i) for t, n in c.items() if (i := vocabulary[t]) in df]
        held.sort(reverse=True)
        terms.append(np.array([i for _, i in held], dtype=np.int64))
        weights.append(np.array([w for w, _ in held], dtype=np.int64))
    block = QueryBlock([i for i, _ in queries], terms, weights)
    vectors = vectors.where(F.size("terms") > 0).withColumn("impacts", _impacts(total.docs, total.terms or 1)).drop("tfs")
    vectors = vectors.withColumn("norm", _norm("impacts"))
    # norms by eighths of a power of two: a histogram of a few hundred rows at most
    step = F.floor(F.log2("norm") * 8).cast("int")
    histogram = sorted(((r.step, r.n) for r in vectors.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    every, longest, cut = sum(n for _, n in histogram), 0, None
    for at, n in histogram:
        longest, cut = longest + n, at
        if longest * HEAD_SHARE >= every:
            break
    none = np.zeros(len(queries), dtype=np.int64)
    if cut is None:
        return _top(_search(vectors, block, none, len(vocabulary), k), k)
    head = stage(_top(_search(vectors.where(step >= cut), block, none, len(vocabulary), k), k), "head")
    least = none.copy()
    for r in head.where(F.col("rank") == k).collect():
        least[r.query] = r.score
    # no vector shorter than this can reach the threshold of any query
    shortest = min((t / n for t, n in zip(least.tolist(), block.norms) if n), default=0.0) * (1 - 1e-9)
    tail = vectors.where((step < cut) & (F.col("norm") >= shortest))
    found = _search(tail, block, least, len(vocabulary), k).unionByName(head.drop("rank"))
    return _top(found, k)


def rank_documents(
    docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
    query_id_col: str = "item_id", query_text_col: str = "text",
) -> DataFrame:
    """The ``k`` best documents per query with a score above 0: the query's id, ``rank`` (from 1),
    the document's id and ``score``. The two id columns must differ in name."""
    spark = docs.sparkSession
    asked = queries.select(F.col(query_id_col).alias("id"), F.encode(F.col(query_text_col), "UTF-8").alias("text"))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // BLOCK_CHARS + 1
    kind = docs.schema[id_col].dataType.simpleString()
    query_kind = queries.schema[query_id_col].dataType
    out = None
    for b in range(blocks):
        rows = [(r.id, r.text) for r in asked.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).collect()]
        names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(rows)], f"query int, `{query_id_col}` {query_kind.simpleString()}")
        found = _rank_block(docs, rows, id_col, text_col, k)
        part = found.join(F.broadcast(names), "query").select(
            query_id_col, F.col("rank").cast("int").alias("rank"), F.col("id").cast(kind).alias(id_col), "score"
        )
        part = part if blocks == 1 else stage(part, f"ranked{b}")
        out = part if out is None else out.unionByName(part)
    return out
