"""Exact top-k search by inner product over a bit-sliced index.

The index holds blocks of rows.  Of each attribute (vector component, an
integer) it keeps the most significant bits of its distance from the block's
least value as slices: bitmaps with one bit a row.  A query's weights are
written as signed digits; each digit adds an attribute's slices, or their
complements where it is negative, at its place, and carry-save adders made of
AND, OR and XOR over whole bitmaps turn them into the slices of the sum.  The
k-th largest sum is read off from the most significant slice downward.  What
slices and digits leave out is bounded, so rows whose sum is short of the k-th
by more than that bound are out; the boundary rows are scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulseline.llm.common import table
from pulseline.llm.vectors import id_arrays, integers, to_ids
from pulseline.session import materialize

BLOCK = 1 << 13
SLICES = 8
DIGITS = 8
QUERY_BLOCK = 256
SCALE = 1024
K = 10


# --- bitmaps ------------------------------------------------------------------

def pack(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words, padded with zeros."""
    pad = -bits.shape[-1] % 64
    if pad:
        bits = np.concatenate([bits, np.zeros((*bits.shape[:-1], pad), bool)], axis=-1)
    return np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)


def places(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def slice_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(slices, slices of each attribute, bits left out below them, range) of
    a block's integer rows."""
    span = rows - rows.min(axis=0)
    top = span.max(axis=0)
    bits = np.array([int(x).bit_length() for x in top], np.int64)
    shift = np.maximum(bits - SLICES, 0)
    high = span >> shift
    cut = ((high[:, :, None] >> np.arange(SLICES)) & 1).astype(bool)  # row, attribute, slice
    slices = pack(np.ascontiguousarray(cut.transpose(1, 2, 0)))
    return slices.reshape(-1, slices.shape[-1]), np.minimum(bits, SLICES), shift, top


def signed_digits(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, place, sign) digits of the non-adjacent form as two masks."""
    half = x >> 1
    three = x + half
    differ = half ^ three
    width = np.arange(DIGITS + 2)
    return (((three & differ)[:, None] >> width) & 1).astype(bool), (
        ((half & differ)[:, None] >> width) & 1).astype(bool)


class Block:
    """A block of the index, ready to be searched."""

    def __init__(self, rows, ids, null, slices, used, shift, top):
        self.rows, self.ids, self.null = rows.astype(np.int64), ids, null
        self.most = int(np.abs(self.rows).max(initial=0))
        self.n, self.dims = rows.shape
        self.both = np.concatenate([slices, ~slices])  # complements serve negative digits
        self.used, self.shift, self.top = used, shift, top
        self.all = pack(np.ones((1, self.n), bool))[0]

    def sums(self, weights: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of the weighted sum, least significant first, and by how
        much two rows' sums can differ from their exact scores' difference;
        both in units of the last digit kept."""
        drop = max(0, int(np.abs(weights).max(initial=0)).bit_length() - DIGITS)
        kept = (weights + ((1 << drop) >> 1)) >> drop
        rest = np.abs(weights - (kept << drop))
        slack = int((np.abs(kept) << drop) @ ((1 << self.shift) - 1) + rest @ self.top)
        plus, minus = signed_digits(kept)
        attr, place = np.nonzero(plus | minus)
        start = attr * SLICES + np.where(minus[attr, place], self.dims * SLICES, 0)
        at = (start[:, None] + np.arange(SLICES)).ravel()
        weight = ((place + self.shift[attr])[:, None] + np.arange(SLICES)).ravel()
        real = (np.arange(SLICES) < self.used[attr][:, None]).ravel()
        at, weight = at[real], weight[real]
        order = np.argsort(weight, kind="stable")
        at, weight = at[order], weight[order]
        out: list[np.ndarray] = []
        carried: list[np.ndarray] = []
        last = int(weight[-1]) if len(weight) else -1
        while len(out) <= last or carried:
            here = at[np.searchsorted(weight, len(out)):np.searchsorted(weight, len(out) + 1)]
            heap = np.concatenate([self.both[here], *carried])
            carried = []
            while len(heap) > 2:  # full adders, three bitmaps to a sum and a carry
                third = len(heap) // 3
                a, b, c = heap[:third], heap[third:2 * third], heap[2 * third:3 * third]
                x = a ^ b
                carried.append((a & b) | (x & c))
                heap = np.concatenate([x ^ c, heap[3 * third:]])
            if len(heap) == 2:
                carried.append((heap[0] & heap[1])[None])
                heap = (heap[0] ^ heap[1])[None]
            out.append(heap[0] if len(heap) else np.zeros_like(self.all))
        return out, -(-slack >> drop)

    def best(self, weights: np.ndarray, k: int, own: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the k best rows without row ``own``, ties to the
        smaller id, null ids after all others."""
        w = np.zeros(self.dims, np.int64)
        w[:min(len(weights), self.dims)] = weights[:self.dims]  # and zeros beyond the query's end
        if self.most * int(np.abs(w).max(initial=0)) * self.dims >= 2 ** 63:
            raise ArithmeticError("a score does not fit a long")
        rows = self.all
        if own is not None:
            rows = rows.copy()
            rows[own >> 6] &= ~np.uint64(1 << (own & 63))
        if self.n - (own is not None) > k:
            sums, slack = self.sums(w)
            rows = boundary(sums, rows, k, slack)
        at = places(rows)
        score = self.rows[at] @ w
        order = np.lexsort((self.ids[at], self.null[at], -score))[:k]
        return at[order], score[order]


def boundary(sums: list[np.ndarray], rows: np.ndarray, k: int, slack: int) -> np.ndarray:
    """The rows whose sum is at most ``slack`` below the k-th largest."""
    equal, need, kth = rows, k, 0
    for i in range(len(sums) - 1, -1, -1):
        with_bit = equal & sums[i]
        n = int(np.bitwise_count(with_bit).sum())
        if n >= need:
            equal, kth = with_bit, kth | 1 << i
        else:
            equal, need = equal & ~sums[i], need - n
    least = kth - slack
    if least <= 0:
        return rows
    above, equal = np.zeros_like(rows), rows
    for i in range(len(sums) - 1, -1, -1):
        if least >> i & 1:
            equal = equal & sums[i]
        else:
            above = above | (equal & sums[i])
            equal = equal & ~sums[i]
    return above | equal


# --- the index and the search as Spark jobs -----------------------------------

INDEX = ("block long, n int, dims int, ids binary, nulls binary, is_query binary, rows binary, "
         "slices binary, used binary, shift binary, top binary")
QUERIES = "q_block long, q_n int, q_dims int, q_from long, q_ids binary, q_at binary, weights binary"
_FIELDS = tuple(x.split()[0] for x in INDEX.split(", "))
_Q_FIELDS = tuple(x.split()[0] for x in QUERIES.split(", "))


def _batch(row: tuple, schema: str) -> pa.RecordBatch:
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    names, kinds = zip(*(x.split() for x in schema.split(", ")))
    return pa.RecordBatch.from_arrays(
        [pa.array([v], types[t]) for v, t in zip(row, kinds)], list(names))


def build_index(vectors: DataFrame, id_col: str, vector_col: str, query, scale: int = SCALE) -> DataFrame:
    """The index of all vectors that take part, a row for each block, written
    as a table; ``query`` (a condition) marks the rows that are queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def emit(some: list[tuple]) -> pa.RecordBatch:
            width = max(x[0].shape[1] for x in some)
            rows = np.concatenate([np.pad(x[0], ((0, 0), (0, width - x[0].shape[1]))) for x in some])
            ids, null, asks = (np.concatenate([x[i] for x in some]) for i in (1, 2, 3))
            slices, used, shift, top = slice_rows(rows)
            return _batch((task << 32 | made, len(rows), width, ids.tobytes(), null.tobytes(),
                           asks.tobytes(), rows.astype(np.int32).tobytes(), slices.tobytes(),
                           used.tobytes(), shift.tobytes(), top.tobytes()), INDEX)

        for b in batches:
            at, rows, _ = integers(b.column(1), scale)
            ids, null = id_arrays(b.column(0))
            asks = b.column(2).fill_null(False).to_numpy(zero_copy_only=False)
            while len(at):
                room = BLOCK - sum(len(x[0]) for x in held)
                held.append((rows[:room], ids[at[:room]], null[at[:room]], asks[at[:room]]))
                at, rows = at[room:], rows[room:]
                if sum(len(x[0]) for x in held) == BLOCK:
                    yield emit(held)
                    held, made = [], made + 1
        if held:
            yield emit(held)

    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vector_col].alias("v"),
                          query.alias("q"))
    return materialize(rows.mapInArrow(run, INDEX), "bit-slices")


def _ints(cell, kind=np.int64) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), kind)


def queries_of(index: DataFrame) -> DataFrame:
    """The rows marked as queries, in blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                block, n, dims, ids, null, asks, rows = (b.column(c)[i] for c in range(7))
                at = np.flatnonzero(_ints(asks, bool) & ~_ints(null, bool))
                rows = _ints(rows, np.int32).reshape(n.as_py(), dims.as_py())
                for first in range(0, len(at), QUERY_BLOCK):
                    some = at[first:first + QUERY_BLOCK]
                    yield _batch(((block.as_py() << 10) + first // QUERY_BLOCK, len(some),
                                  dims.as_py(), block.as_py(), _ints(ids)[some].tobytes(),
                                  some.astype(np.int64).tobytes(), rows[some].tobytes()), QUERIES)

    return materialize(index.select(*_FIELDS[:7]).mapInArrow(run, QUERIES), "bit-slice-queries")


def top_k(index: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) of each marked row's k best other rows.

    Every block of queries meets every block of the index once: blocks of the
    index are dealt to cells, blocks of queries (a hundredth of the rows) go
    to all cells.  A task holds one block of each kind at a time.  Its k best
    rows of a block and query go on; the k best of these are the result.
    """
    spark = index.sparkSession
    cells = max(1, min(index.count(), 4 * spark.sparkContext.defaultParallelism))
    dealt = index.drop("is_query").withColumn(
        "cell", ((F.col("block") + F.shiftright("block", 32)) % cells).cast("int"))
    asked = queries_of(index).withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))
    met = dealt.repartition(cells, "cell").join(asked.repartition(cells, "cell"), "cell").drop("cell")
    names = met.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None
        for b in batches:
            col = {c: b.column(i) for i, c in enumerate(names)}
            out: list[tuple] = []
            for i in range(b.num_rows):
                block = col["block"][i].as_py()
                if block != now:
                    n, dims = col["n"][i].as_py(), col["dims"][i].as_py()
                    now, held = block, Block(
                        _ints(col["rows"][i], np.int32).reshape(n, dims), _ints(col["ids"][i]).copy(),
                        _ints(col["nulls"][i], bool).copy(),
                        _ints(col["slices"][i], np.uint64).reshape(dims * SLICES, -1),
                        _ints(col["used"][i]).copy(), _ints(col["shift"][i]).copy(),
                        _ints(col["top"][i]).copy())
                asks = col["q_n"][i].as_py()
                ids, at = _ints(col["q_ids"][i]), _ints(col["q_at"][i])
                weights = _ints(col["weights"][i], np.int32).reshape(asks, col["q_dims"][i].as_py())
                same = col["q_from"][i].as_py() == block
                for j in range(asks):
                    found, score = held.best(weights[j], k, int(at[j]) if same else None)
                    out.append((col["q_block"][i].as_py(), j, ids[j], held.ids[found],
                                held.null[found], score))
            if out:
                size = [len(x[5]) for x in out]
                spread = [np.repeat([x[c] for x in out], size) for c in (0, 1, 2)]
                ids, null, score = (np.concatenate([x[c] for x in out]) for c in (3, 4, 5))
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, spread), to_ids(ids, null), pa.array(score)],
                    ["q_block", "q_at", "query_id", "vec_id", "score"])

    found = met.mapInArrow(run, "q_block long, q_at long, query_id long, vec_id long, score long")
    order = Window.partitionBy("q_block", "q_at").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def search(vectors: DataFrame, id_col: str, vector_col: str, query, k: int = K,
           scale: int = SCALE) -> DataFrame:
    """Exact top k by inner product of floor(scale * x) for the rows that
    meet ``query``, against all rows.

    Null vectors and those with a null or non-finite component take no part.
    A row is no candidate of itself; rows that repeat it are.  A shorter
    vector counts as zero where it ends, an empty one has score 0.  Rows with
    a null id are candidates (last among ties) and no queries.  Fewer rows
    than k give all of them; an empty table gives none.  Columns beside the
    two are not read.  Integers beyond 31 bits and scores beyond a long are
    refused with an error.
    """
    return top_k(build_index(vectors, id_col, vector_col, query, scale), k)


def op11_exact_topk(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return search(rows, "vec_id", "embedding", rows["vec_id"] % 100 == 0)


OP11_SQL = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r
  WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank
  FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
