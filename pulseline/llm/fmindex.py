"""Benchmark decontamination with an FM-index per shard of the documents.

A shard is a slice of a task's rows.  Its words become integers (words that no
benchmark item has are the separator, so only runs long enough for a window
are kept); a suffix array by prefix doubling gives the Burrows-Wheeler
transform, kept as a wavelet matrix.  All benchmark windows are searched
backwards at once through its ranks, occurrences are located by walking back
to sampled suffix positions, and their word spans are merged per document.

The benchmark's windows are sent to the tasks in blocks of bounded size, one
pass over the documents for each block; there is no shuffle.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulseline.llm.common import (
    LOWER, NON_WORD, UPPER, WORD_BYTES, by_place, byte_slices, table, text_buffer)

WINDOW = 13
SHARE = 20
SHARD_BYTES = 8 << 20
BLOCK_BYTES = 8 << 20
SAMPLE = 8
_WORD = re.compile("[^" + NON_WORD[1:-2] + "]+")
_LOWER = str.maketrans(UPPER, LOWER)
_STATE = ["_n_words", "_starts", "_ends", "_items"]
_STATE_TYPES = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string())]
_STATE_DDL = "_n_words long, _starts array<int>, _ends array<int>, _items array<string>"


# --- the index ----------------------------------------------------------------

def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes; each 0 is a separator of its own, smaller than
    all words and than the separators after it, so no comparison passes one."""
    n = len(text)
    gaps = text == 0
    rank = np.where(gaps, np.cumsum(gaps) - 1, text.astype(np.int64) + int(gaps.sum()))
    order = np.argsort(rank, kind="stable")
    rank = _dense(rank[order], order)
    step = 1
    while True:
        sizes = np.bincount(rank, minlength=n)
        open_ = np.flatnonzero(sizes[rank] > 1)  # suffixes that share their rank so far
        if not len(open_):
            order = np.empty(n, np.int64)
            order[rank] = np.arange(n)
            return order
        after = np.minimum(open_ + step, n - 1)
        key = rank[open_] * (n + 1) + rank[after]
        by = np.argsort(key, kind="stable")
        at, key = open_[by], key[by]
        # a group's ranks start at its old rank and grow with the position in the group
        old = rank[at]
        first = np.flatnonzero(np.r_[True, old[1:] != old[:-1]])
        within = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
        new = old + within
        same = np.r_[False, key[1:] == key[:-1]]
        lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(at))))
        rank[at] = new[lead]
        step *= 2


def _dense(values: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Ranks of sorted values, equal ones at the first of them."""
    first = np.r_[True, values[1:] != values[:-1]]
    lead = np.maximum.accumulate(np.where(first, np.arange(len(values)), 0))
    rank = np.empty(len(values), np.int64)
    rank[order] = lead
    return rank


class FmIndex:
    """Index of an integer text that ends with a separator (0)."""

    def __init__(self, text: np.ndarray, n_symbols: int):
        n = len(text)
        sa = suffix_array(text)
        self.n, self.levels = n, max(1, int(n_symbols).bit_length())
        before = text[sa - 1]
        counts = np.bincount(text, minlength=n_symbols + 1)
        self.first = np.concatenate([[0], np.cumsum(counts)])  # rows of smaller symbols
        self.zeros, self.ranks = [], []
        row = before.astype(np.int64)
        for level in reversed(range(self.levels)):
            bit = (row >> level) & 1
            self.ranks.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(n - int(bit.sum()))
            row = np.concatenate([row[bit == 0], row[bit == 1]])
        self.last = before
        # every SAMPLE-th position, and those after a separator, which no walk passes
        self.known = (sa % SAMPLE == 0) | (before == 0)
        self.sample_of = np.cumsum(self.known) - 1
        self.samples = sa[self.known]

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands before row i of the transform."""
        lo, hi = np.zeros(len(i), np.int64), i.astype(np.int64)
        for k, level in enumerate(reversed(range(self.levels))):
            one, ones, zeros = (symbol >> level) & 1 == 1, self.ranks[k], self.zeros[k]
            a, b = ones[lo].astype(np.int64), ones[hi].astype(np.int64)
            lo, hi = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, hi - b)
        return hi - lo

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple:
        """(which, lo, hi) of the patterns that occur; row r of ``patterns``
        holds its ``lengths[r]`` symbols at the left."""
        which = np.arange(len(patterns))
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        done: list[tuple] = []
        for k in range(patterns.shape[1]):
            ended = lengths[which] == k
            if ended.any():
                done.append((which[ended], lo[ended], hi[ended]))
                which, lo, hi = which[~ended], lo[~ended], hi[~ended]
            if not len(which):
                break
            c = patterns[which, lengths[which] - 1 - k].astype(np.int64)
            lo, hi = self.first[c] + self.rank(c, lo), self.first[c] + self.rank(c, hi)
            live = lo < hi
            which, lo, hi = which[live], lo[live], hi[live]
        done.append((which, lo, hi))
        return tuple(np.concatenate(x) for x in zip(*done))

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        todo = np.flatnonzero(~self.known[rows])
        while len(todo):
            c = self.last[rows[todo]].astype(np.int64)
            rows[todo] = self.first[c] + self.rank(c, rows[todo])
            steps[todo] += 1
            todo = todo[~self.known[rows[todo]]]
        return self.samples[self.sample_of[rows]] + steps


# --- windows and shards -------------------------------------------------------

def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class Windows:
    """The distinct windows of a block of benchmark items."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.ids: dict[bytes, int] = {}
        owners: dict[tuple, set] = defaultdict(set)
        for item, text in items:
            words = [self.ids.setdefault(w, len(self.ids) + 1)
                     for w in words_of((text or "").encode())]
            for i in range(max(1, len(words) - window + 1) if words else 0):
                owners[tuple(words[i:i + window])].add(item)
        self.owners = [sorted(x) for x in owners.values()]
        self.lengths = np.array([len(w) for w in owners], np.int64)
        self.patterns = np.zeros((len(owners), window), np.int64)
        for row, w in zip(self.patterns, owners):
            row[:len(w)] = w


def find_windows(w: Windows, texts: list[bytes]) -> tuple[list[int], list[tuple[int, int, int, int]]]:
    """Words per text; (text, window, first word, end word) of every occurrence."""
    get = w.ids.get
    counts, parts = [], []
    for t in texts:
        words = words_of(t)
        counts.append(len(words))
        parts.append(np.fromiter((get(x, 0) for x in words), np.int64, len(words)))
        parts.append(np.zeros(1, np.int64))
    if not len(w.lengths) or not parts:
        return counts, []
    text = np.concatenate(parts)
    # runs of known words that can hold a window; position i of what is kept was at place[i]
    edges = np.flatnonzero(np.diff(np.r_[0, (text > 0).astype(np.int8), 0]))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= w.lengths.min()
    starts, ends = starts[long], ends[long]
    if not len(starts):
        return counts, []
    size = ends - starts + 1  # with the separator after it
    place = np.repeat(starts - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
    index = FmIndex(text[place], len(w.ids))
    which, lo, hi = index.search(w.patterns, w.lengths)
    n = hi - lo
    rows = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
    at = place[index.locate(rows)]
    which = np.repeat(which, n)
    begin = np.r_[0, np.cumsum(np.array(counts, np.int64) + 1)]
    doc = np.searchsorted(begin, at, side="right") - 1
    first = at - begin[doc]
    return counts, list(zip(doc.tolist(), which.tolist(), first.tolist(),
                            (first + w.lengths[which]).tolist()))


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _scan(windows, text_at: int, n_own: int, batches: Iterator[pa.RecordBatch]):
    """Each batch with the spans and items of one more block of windows."""
    w = windows.value
    for batch in batches:
        data, offsets = text_buffer(batch.column(text_at))
        for first, last in byte_slices(offsets, SHARD_BYTES):
            part = batch.slice(first, last - first)
            raw = data[offsets[first]:offsets[last]].tobytes()
            cut = (offsets[first:last + 1] - offsets[first]).tolist()
            counts, found = find_windows(w, [raw[a:b] for a, b in zip(cut, cut[1:])])
            spans, items = [[] for _ in counts], [set() for _ in counts]
            if part.num_columns > n_own:  # what earlier blocks found
                old = [part.column(n_own + k).to_pylist() for k in (1, 2, 3)]
                spans = [list(zip(s, e)) for s, e in zip(old[0], old[1])]
                items = [set(x) for x in old[2]]
            for doc, which, s, e in found:
                spans[doc].append((s, e))
                items[doc].update(w.owners[which])
            merged = [merge_spans(s) for s in spans]
            state = [counts, [[s for s, _ in m] for m in merged], [[e for _, e in m] for m in merged],
                     [sorted(x) for x in items]]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:n_own], *map(pa.array, state, _STATE_TYPES)],
                [*batch.schema.names[:n_own], *_STATE])


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_bytes: int):
    """Broadcast windows of the items, in as many blocks as their bytes need
    (items are dealt by the hash of their text, so a block is bounded)."""
    b = benchmark.select(F.coalesce(benchmark[item_col].cast("string"), F.lit("")).alias("item"),
                         benchmark[text_col].cast("string").alias("text"))
    size = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // block_bytes) or 1
    for k in range(n):
        rows = b.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k).collect()
        yield b.sparkSession.sparkContext.broadcast(Windows([tuple(r) for r in rows], window))


def scan_benchmark(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with _n_words, the merged word spans (_starts, _ends; from 0,
    end exclusive) of benchmark windows and the _items they belong to.

    Null, empty and word-less texts have no words and no spans, in documents
    and items; an item of fewer than ``window`` words is one window.  Repeated
    rows and item ids are fine (an item is its id); a null item id counts as
    the empty one.  Empty tables give no row or no span.  Columns of ``docs``
    pass through; those with one of the four names above are replaced.
    """
    docs = docs.drop(*_STATE)
    return _scanned(by_place(docs), docs.columns.index(text_col), benchmark, item_col, item_text_col,
                    window, block_bytes).toDF(*docs.columns, *_STATE)


def _scanned(docs: DataFrame, at: int, benchmark: DataFrame, item_col: str = "item_id",
             item_text_col: str = "text", window: int = WINDOW,
             block_bytes: int = BLOCK_BYTES, then=None) -> DataFrame:
    """``docs`` (columns by place, the text at ``at``) and the state columns;
    with ``then``, what it makes of the batches of that in the pass of the
    last block, in the columns of ``docs``."""
    n = len(docs.columns)
    out = docs.withColumn(f"c{at}", F.col(f"c{at}").cast("string"))
    own = out.schema.fields
    schema = StructType(own + StructType.fromDDL(_STATE_DDL).fields)
    blocks = list(_blocks(benchmark, item_col, item_text_col, window, block_bytes))
    for block in blocks[:-1] if then else blocks:
        out = out.mapInArrow(lambda b, block=block: _scan(block, at, n, b), schema)
    return out.mapInArrow(lambda b: then(_scan(blocks[-1], at, n, b)), StructType(own)) if then else out


def _hit_words():
    return F.coalesce(F.aggregate(F.zip_with("_starts", "_ends", lambda s, e: e - s),
                                  F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0))


def contaminated(hit, words):
    return (hit > 0) & (SHARE * hit >= words)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the spans of benchmark windows in contaminated texts.
    A text of which no word is left goes; all others stay as they are."""
    at, n = docs.columns.index(text_col), len(docs.columns)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, keep = [], []
            state = [b.column(n + k).to_pylist() for k in range(3)]
            for text, n_words, starts, ends in zip(b.column(at).to_pylist(), *state):
                hit = sum(ends) - sum(starts)
                if hit and SHARE * hit >= n_words:
                    text = _without(text, list(zip(starts, ends)))
                    keep.append(any(_words(text)))
                else:
                    keep.append(True)
                texts.append(text)
            columns = [*b.columns[:n]]
            columns[at] = pa.array(texts, b.column(at).type)
            yield pa.RecordBatch.from_arrays(columns, b.schema.names[:n]).filter(
                pa.array(keep, pa.bool_()))

    # in one pass, so that a task has one Python worker
    return _scanned(by_place(docs), at, benchmark, then=cut, **options).toDF(*docs.columns)


def _words(text: str):
    """Matches of the words of a text, as words_of finds them: with A-Z as a-z."""
    return _WORD.finditer(text.translate(_LOWER))


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the given word spans."""
    places = [m.span() for m in _words(text)]
    out, at = [], 0
    for s, e in spans:
        out.append(text[at:places[s][0]])
        at = places[e - 1][1]
    return "".join(out) + text[at:]


def op10_benchmark_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_benchmark(docs, table(spark, sf_dir, "benchmark"))
    hit = _hit_words().cast("long")
    return found.select(
        "doc_id", F.col("_n_words").alias("n_words"), hit.alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("_items"), ","), 256).alias("items_sha256"),
        contaminated(hit, F.col("_n_words")).alias("contaminated"))


_SQL_WORDS = """list_filter(regexp_split_to_array(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"""
OP10_SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_SQL_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, w[i:i + {WINDOW - 1}] AS g
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - {WINDOW - 1}) + 1)) AS i FROM b WHERE len(w) > 0)),
size AS (SELECT DISTINCT len(g) AS n FROM win),
hit AS (
  SELECT doc_id, i, n, item
  FROM (SELECT doc_id, i, n, w[i:i + n - 1] AS g
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, size WHERE len(w) >= n))
  JOIN win USING (g)),
cover AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id)
"""
