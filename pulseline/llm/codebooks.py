"""Vector code compression by a product quantiser with equal-average search.

A vector of integers is cut into equal parts; each part position has a
codebook, and a vector's code is its parts' nearest entries.  The nearest
entry is found by component sums: squared distance is at least the squared
gap of the sums over the part's dimension, so entries are sorted by their sum
and tried outward from the part's own sum until that bound strictly exceeds
the best distance.  Training is a few rounds of exact integer means: tasks add
up their rows, Spark adds up the tasks, the codebooks (bounded) are broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseline.llm.common import table
from pulseline.llm.vectors import id_arrays, integers, to_ids
from pulseline.session import materialize

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: sums of a label column are broadcast up to so many labels (16 bytes each and their keys)
FEW_LABELS = 100_000
FAR = np.iinfo(np.int64).max


class Codebook:
    """The entries of one part position, sorted by their sum."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        sums = entries.sum(axis=1)
        self.order = np.argsort(sums, kind="stable")
        self.sums = sums[self.order]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of each row, ties to
        the lower index."""
        n, size = parts.shape
        own = parts.sum(axis=1)
        right = np.searchsorted(self.sums, own)
        left = right - 1
        best, at = np.full(n, FAR), np.full(n, len(self.sums))
        rows = np.arange(n)
        while len(rows):
            lo, hi, s = left[rows], right[rows], own[rows]
            gap_lo = np.where(lo >= 0, s - self.sums[np.maximum(lo, 0)], FAR)
            gap_hi = np.where(hi < len(self.sums), self.sums[np.minimum(hi, len(self.sums) - 1)] - s, FAR)
            down = gap_lo <= gap_hi
            gap = np.where(down, gap_lo, gap_hi)
            # gap * gap / size > best, where a side is left at all
            go = gap < FAR
            go[go] = gap[go] * gap[go] <= np.minimum(best[rows[go]], FAR // size) * size
            rows, down = rows[go], down[go]
            entry = self.order[np.where(down, lo[go], hi[go])]
            left[rows] -= down
            right[rows] += ~down
            d = ((parts[rows] - self.entries[entry]) ** 2).sum(axis=1)
            closer = (d < best[rows]) | ((d == best[rows]) & (entry < at[rows]))
            best[rows[closer]], at[rows[closer]] = d[closer], entry[closer]
        return at, best


def _vectors(column, scale: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    at, rows, length = integers(column, scale)
    some = length > 0
    at, rows = at[some], rows[some]
    if len(at) and (rows.shape[1] != dims or (length[some] != dims).any()):
        raise ValueError(f"vectors of {dims} components are needed")
    if 4 * int(np.abs(rows).max(initial=0)) ** 2 * dims ** 2 >= 2 ** 63:
        raise ArithmeticError("squared distances do not fit a long")
    return at, rows


def first_vectors(vectors: DataFrame, id_col: str, vector_col: str, n: int = ENTRIES,
                  scale: int = SCALE) -> np.ndarray:
    """The integer vectors of the n smallest ids, ascending: ties of an id by
    the vectors, null ids last.  Each task sends on its own n smallest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, rows, length = integers(b.column(1), scale)
            ids, null = id_arrays(b.column(0))
            some = [i for i in np.lexsort((ids[at], null[at])) if length[i]]
            if len(some) > n:  # and all that tie with the last of them
                last = some[n - 1]
                some = [i for i in some if (null[at[i]], ids[at[i]]) <= (null[at[last]], ids[at[last]])]
                some = sorted(some, key=lambda i: (null[at[i]], ids[at[i]], rows[i, :length[i]].tolist()))[:n]
            yield pa.RecordBatch.from_arrays(
                [to_ids(ids[at[some]], null[at[some]]),
                 pa.array([rows[i, :length[i]].tolist() for i in some], pa.list_(pa.int64()))],
                ["id", "v"])

    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vector_col].alias("v"))
    found = rows.mapInArrow(run, "id long, v array<long>").orderBy(F.asc_nulls_last("id"), "v").limit(n)
    found = [r.v for r in found.collect()]
    if len({len(v) for v in found}) > 1 or found and len(found[0]) % PARTS:
        raise ValueError(f"vectors of one length that {PARTS} divides are needed")
    return np.array(found, np.int64) if found else np.zeros((0, 0), np.int64)


def start(first: np.ndarray, parts: int = PARTS) -> list[np.ndarray]:
    """A codebook for each part position."""
    return np.split(first, parts, axis=1) if first.size else []


def improve(vectors: DataFrame, vector_col: str, books: list[np.ndarray],
            scale: int = SCALE) -> list[np.ndarray]:
    """One round: each entry becomes floor(sum / count) of its parts; entries
    without a part stay.  Each task sends one row for each entry and
    component, Spark adds them up."""
    entries, size = books[0].shape
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(x) for x in shared.value]
        total = np.zeros((len(books), entries, size + 1), np.int64)  # the last is the count
        for b in batches:
            _, rows = _vectors(b.column(0), scale, len(books) * size)
            for p, book in enumerate(books):
                part = rows[:, p * size:(p + 1) * size]
                at, _ = book.nearest(part)
                order = np.argsort(at, kind="stable")
                starts = np.flatnonzero(np.r_[True, np.diff(at[order]) != 0]) if len(at) else []
                if len(at):
                    total[p, at[order][starts], :size] += np.add.reduceat(part[order], starts, axis=0)
                    total[p, :, size] += np.bincount(at, minlength=entries)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], ["cell", "n"])

    sums = vectors.select(vectors[vector_col].alias("v")).mapInArrow(run, "cell long, n long")
    total = [0] * (len(books) * entries * (size + 1))
    for r in sums.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        total[r.cell] = r.n
    shared.unpersist()
    total = np.array(total, np.int64).reshape(len(books), entries, size + 1)
    count = total[:, :, size:]
    return [np.where(count[p] > 0, total[p, :, :size] // np.maximum(count[p], 1), books[p])
            for p in range(len(books))]


def train(vectors: DataFrame, id_col: str, vector_col: str, rounds: int = ROUNDS) -> list[np.ndarray]:
    books = start(first_vectors(vectors, id_col, vector_col))
    for _ in range(rounds if books else 0):
        books = improve(vectors, vector_col, books)
    return books


def compress(vectors: DataFrame, id_col: str, vector_col: str, books: list[np.ndarray],
             carry: tuple[str, ...] = (), scale: int = SCALE) -> DataFrame:
    """(id, carried columns k0, k1, ..., code, error): a row for each vector
    that takes part.  The code has two hexadecimal digits for each part; the
    error is the sum of the parts' squared distances."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)
    names = [f"k{i}" for i in range(len(carry))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(x) for x in shared.value]
        size = books[0].entries.shape[1] if books else 0
        for b in batches:
            at, rows = _vectors(b.column(1), scale, len(books) * size)
            ids, null = id_arrays(b.column(0))
            code, error = np.zeros((len(at), len(books)), np.uint8), np.zeros(len(at), np.int64)
            for p, book in enumerate(books):
                code[:, p], d = book.nearest(rows[:, p * size:(p + 1) * size])
                error += d
            digits = code.tobytes().hex()
            width = 2 * len(books)
            yield pa.RecordBatch.from_arrays(
                [to_ids(ids[at], null[at]), *(b.column(2 + i).take(pa.array(at)) for i in range(len(carry))),
                 pa.array([digits[i * width:(i + 1) * width] for i in range(len(at))], pa.string()),
                 pa.array(error)], ["id", *names, "code", "error"])

    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vector_col].alias("v"),
                          *(vectors[c].alias(n) for c, n in zip(carry, names)))
    kinds = "".join(f"k{i} {rows.schema[f'k{i}'].dataType.simpleString()}, " for i in range(len(carry)))
    return rows.mapInArrow(run, f"id long, {kinds}code string, error long")


def decode(codes: list[str], books: list[np.ndarray]) -> np.ndarray:
    """The integer vectors that codes stand for."""
    at = np.frombuffer(bytes.fromhex("".join(codes)), np.uint8).reshape(len(codes), -1)
    return np.concatenate([book[at[:, p]] for p, book in enumerate(books)], axis=1)


def books_text(books: list[np.ndarray]) -> str:
    return ",".join(str(x) for book in books for x in book.ravel().tolist())


def compress_labelled(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) with codebooks
    trained on all vectors that take part; label_error adds up the errors of
    equal labels, nulls together.

    Null and empty vectors and those with a null or non-finite component give
    no row; repeated rows and null ids each give theirs; an empty table gives
    none.  Fewer rows than entries make smaller codebooks.  Columns beside the
    three are not read.  Vectors of different lengths, lengths that the number
    of parts does not divide, and distances beyond a long are refused.
    """
    books = train(vectors, id_col, vector_col)
    coded = materialize(compress(vectors, id_col, vector_col, books, (label_col,)), "codes")
    by_label = materialize(coded.groupBy(F.col("k0").alias("label")).agg(
        F.sum("error").alias("label_error")), "label-errors")
    if by_label.count() <= FEW_LABELS:
        by_label = F.broadcast(by_label)
    digest = hashlib.sha256(books_text(books).encode()).hexdigest()
    return coded.join(by_label, coded["k0"].eqNullSafe(by_label["label"])).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error",
        F.lit(digest).alias("codebooks_sha256"))


def op12_code_compression(spark, sf_dir):
    return compress_labelled(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")


def _sql() -> str:
    near = """SELECT r, p, min(struct_pack(d := d, e := e)) AS m FROM (
    SELECT x.r, x.p, b.e, CAST(list_sum(list_transform(list_zip(x.v, b.c),
           lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM parts x JOIN {book} b USING (p)) GROUP BY r, p"""
    steps = ["""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             """parts AS MATERIALIZED (
  SELECT r, p, list_slice(v, p * (len(v) // 8) + 1, (p + 1) * (len(v) // 8)) AS v
  FROM kept, range(8) t(p))""",
             """b0 AS MATERIALIZED (
  SELECT p, e, x.v AS c FROM (
    SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS e FROM kept)
  JOIN parts x USING (r) WHERE e < 16)"""]
    for i in range(6):
        steps += [f"a{i} AS MATERIALIZED ({near.format(book=f'b{i}')})",
                  f"""s{i} AS MATERIALIZED (
  SELECT p, e, list((n - (n % k + k) % k) // k ORDER BY pos) AS c FROM (
    SELECT p, a.m.e AS e, pos, CAST(sum(x.v[pos]) AS BIGINT) AS n, count(*) AS k
    FROM a{i} a JOIN parts x USING (r, p), range(1, 1 + (SELECT max(len(v)) FROM parts)) t(pos)
    GROUP BY ALL) GROUP BY p, e)""",
                  f"""b{i + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(s.c, b.c) AS c FROM b{i} b LEFT JOIN s{i} s USING (p, e))"""]
    return "WITH " + ",\n".join(steps) + f""",
ends AS ({near.format(book="b6")}),
coded AS (
  SELECT k.r, any_value(vec_id) AS vec_id, any_value(label) AS label,
         string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error
  FROM kept k JOIN ends USING (r) GROUP BY k.r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM b6) AS codebooks_sha256
FROM coded
"""


OP12_SQL = _sql()
