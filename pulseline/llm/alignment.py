"""Cross-tokenizer alignment of a byte-level BPE (A) with a sentencepiece model (B).

Both encode the same bytes; byte offsets where tokens of both end cut a text
into groups, and tokens whose bytes overlap are linked.  Most groups are one
token of each with the same bytes.  An identity map, an array from A id to the
B id of the same bytes, made once, recognises them: they are counted in a
vector as long as A's vocabulary.  Only the links of the other groups enter
the shuffle of pairs.  Texts are encoded once; what a second look at them
needs (distinct ids and pairs with their times) is written with the first.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulseline.llm.common import byte_slices, table, text_buffer
from pulseline.session import materialize, scratch_path

A_PATH = "/opt/tokenizers/byte_bpe_50k.json"
B_PATH = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Fixed value: the pattern of byte-level vocabularies, which cuts a text into pieces.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SLICE_BYTES = 1 << 20
#: pairs that a task holds before it sends them on, and that are broadcast (16 bytes each)
HELD_PAIRS = 1 << 20
HEAD_PAIRS = 1 << 20
RESULTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


# --- the two vocabularies -------------------------------------------------------

def byte_letters() -> dict[str, int]:
    """Letter -> byte of byte-level vocabularies: printable Latin-1 characters
    stand for themselves, the other bytes for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Pool:
    """Byte strings by number, joined many at a time."""

    def __init__(self, strings: list[bytes]):
        self.data = np.frombuffer(b"".join(strings), np.uint8)
        self.size = np.array([len(x) for x in strings], np.int64)
        self.start = np.cumsum(self.size) - self.size

    def join(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the strings one after another, and where each ends."""
        size = self.size[ids]
        ends = np.cumsum(size)
        at = np.repeat(self.start[ids] - (ends - size), size)
        at += np.arange(len(at))
        return self.data[at], ends


class Vocabularies:
    """Both tokenizers, the bytes of their tokens and the identity map."""

    def __init__(self, a_json: bytes, b_model: bytes):
        import sentencepiece
        import tiktoken

        spec = json.loads(a_json)
        cut, vocab = spec["pre_tokenizer"], spec["model"]["vocab"]
        pairs = (x.split(" ") if isinstance(x, str) else x for x in spec["model"]["merges"])
        if cut["type"] != "ByteLevel" or cut["add_prefix_space"] or not cut.get("use_regex", True) or any(
                vocab[x + y] != 256 + i for i, (x, y) in enumerate(pairs)):
            raise ValueError("a byte-level BPE with the usual pattern, ids in order of merges, is needed")
        letter = byte_letters()
        ranks = {bytes([letter[c] for c in token]): i for token, i in vocab.items()
                 if i < 256 + len(spec["model"]["merges"])}
        # the same merges and ids, at a third of the time
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a_json = a_json
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        a_bytes = [b""] * (max([*vocab.values(), *(x["id"] for x in spec["added_tokens"])]) + 1)
        for token, i in ranks.items():
            a_bytes[i] = token
        b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
            for i in range(self.b.get_piece_size()) for p in [self.b.id_to_piece(i)]]
        first: dict[bytes, int] = {}
        for of_bytes in (False, True):  # a piece comes before the byte of the same value
            for i, x in enumerate(b_bytes):
                if self.b.is_byte(i) == of_bytes:
                    first.setdefault(x, i)
        self.same = np.array([first.get(x, -1) for x in a_bytes], np.int64)
        self.a_bytes, self.b_bytes = Pool(a_bytes), Pool(b_bytes)

    def _a_ids(self, text: str) -> np.ndarray:
        try:
            return self.a.encode_to_numpy(text, disallowed_special=())
        except ValueError:  # its pattern matcher gives up on a run of a million spaces
            from tokenizers import Tokenizer

            whole = Tokenizer.from_str(self.a_json.decode())
            whole.encode_special_tokens = True
            return np.array(whole.encode(text, add_special_tokens=False).ids, np.int64)

    def encode(self, raw: list[bytes]) -> tuple[Encoded, Encoded]:
        """Ids of both for each text (UTF-8); none where the bytes of either
        are not those of a space and the text."""
        texts = [x.decode("utf-8", "replace") for x in raw]
        lists = self.b.encode(texts, num_threads=1)
        n = np.array([len(x) for x in lists], np.int64)
        arrays = [self._a_ids(" " + t) for t in texts]
        both = (Encoded(np.concatenate(arrays).astype(np.int64), np.array(list(map(len, arrays)), np.int64),
                        self.a_bytes),
                Encoded(np.fromiter(chain.from_iterable(lists), np.int64, n.sum()), n, self.b_bytes))
        want = [b" " + x if x else b"" for x in raw]
        good = both[0].equals(want) & both[1].equals(want) & np.array([len(x) > 0 for x in raw], bool)
        return both[0].only(good), both[1].only(good)


class Encoded:
    """Ids of some texts one after another; ``ends``: where each token's
    bytes end."""

    def __init__(self, ids: np.ndarray, count: np.ndarray, pool: Pool):
        self.ids, self.count, self.pool = ids, count, pool
        self.bytes, self.ends = pool.join(ids)

    def _cuts(self) -> np.ndarray:
        """Where each text's bytes begin, and the end."""
        return np.r_[0, self.ends][np.r_[0, np.cumsum(self.count)]]

    def equals(self, want: list[bytes]) -> np.ndarray:
        cut, raw = self._cuts().tolist(), self.bytes.tobytes()
        return np.array([raw[a:b] == x for a, b, x in zip(cut, cut[1:], want)], bool)

    def only(self, good: np.ndarray) -> Encoded:
        """Without the ids of the other texts."""
        if good.all():
            return self
        return Encoded(self.ids[np.repeat(good, self.count)], np.where(good, self.count, 0), self.pool)


@dataclass
class Links:
    """All links of some texts, in order."""
    text: np.ndarray  # which text
    a: np.ndarray  # the ids
    b: np.ndarray
    closes: np.ndarray  # whether both tokens end here, which ends a group
    regular: np.ndarray  # whether it is a group of its own and in the identity map


class Aligned:
    """Texts encoded by both, cut into groups."""

    def __init__(self, same: np.ndarray, a: Encoded, b: Encoded):
        self.a, self.b = a, b
        # tokens of a text have the same bytes in both, so all texts can stand in one row of bytes
        total = int(a.ends[-1]) if len(a.ends) else 0
        a_here, b_here = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        a_here[a.ends], b_here[b.ends] = True, True
        self.both = a_here & b_here
        ends = np.flatnonzero(a_here | b_here)  # between two of them, one token of each: a link
        closes = self.both[ends]
        alone = closes & np.r_[True, closes[:-1]][:len(closes)]
        a_at, b_at = _before(a_here, ends), _before(b_here, ends)
        a_id, b_id = a.ids[a_at], b.ids[b_at]
        text_of_a = np.repeat(np.arange(len(a.count)), a.count)
        self.links = Links(text_of_a[a_at], a_id, b_id, closes, alone & (same[a_id] == b_id))

    def digests(self, labels: Pool) -> list[str]:
        """sha256 of ``a1,a2|b1;a3|b2,b3`` of each text; ``labels`` has each
        decimal id followed by a comma, a bar and a semicolon."""
        a, b, both = self.a, self.b, self.both
        n_groups = int(both.sum())
        a_group, b_group = _before(both, a.ends), _before(both, b.ends)
        a_before = np.r_[0, np.cumsum(np.bincount(a_group, minlength=n_groups))]
        b_before = np.r_[0, np.cumsum(np.bincount(b_group, minlength=n_groups))]
        codes = np.zeros(len(a.ids) + len(b.ids), np.int64)
        codes[np.arange(len(a.ids)) + b_before[a_group]] = 3 * a.ids + both[a.ends]
        codes[np.arange(len(b.ids)) + a_before[b_group + 1]] = 3 * b.ids + 2 * both[b.ends]
        whole = Encoded(codes, a.count + b.count, labels)
        cut, raw = whole._cuts().tolist(), whole.bytes.tobytes()
        return [hashlib.sha256(raw[i:j - 1]).hexdigest() if j > i else "" for i, j in zip(cut, cut[1:])]


def _before(marks: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many marks are before each place."""
    return (np.cumsum(marks, dtype=np.int32)[at] - marks[at]).astype(np.int64)


def _times(text: np.ndarray, key: np.ndarray, most: int, n: int) -> tuple[pa.Array, pa.Array]:
    """Distinct keys of each of n texts and how often each is there, as lists."""
    found, times = np.unique(text * most + key, return_counts=True)
    ends = np.r_[0, np.cumsum(np.bincount(found // most, minlength=n))].astype(np.int32)
    return (pa.ListArray.from_arrays(pa.array(ends), pa.array(found % most)),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(times.astype(np.int64))))


class _Counts:
    """A task's counts: of regular groups in a vector, of other links in
    sorted arrays that are sent on when they grow beyond ``HELD_PAIRS``."""

    def __init__(self, a_most: int):
        self.regular = np.zeros(a_most, np.int64)
        self.keys, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, links: Links, b_most: int) -> None:
        self.regular += np.bincount(links.a[links.regular], minlength=len(self.regular))
        other = ~links.regular
        keys, n = np.unique(links.a[other] * b_most + links.b[other], return_counts=True)
        keys, n = np.r_[self.keys, keys], np.r_[self.n, n]
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
        self.keys, self.n = keys[first], np.add.reduceat(n, first) if len(first) else n

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        out = self.keys, self.n
        self.keys, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        return out


# --- the two passes as Spark jobs -------------------------------------------------

LISTS = "ids array<long>, id_times array<long>, keys array<long>, key_times array<long>"
FIRST = f"part string, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, {LISTS}"


def _vocabularies(spark, a_path: str, b_path: str):
    with open(a_path, "rb") as a, open(b_path, "rb") as b:
        data = a.read(), b.read()
    return Vocabularies(*data), spark.sparkContext.broadcast(data)


def _encoded(docs: DataFrame, files, a_most: int, b_most: int) -> DataFrame:
    """The first pass, written: a row for each text (part ``text``: kept
    columns, numbers, digest, distinct regular ids and other pairs) and rows
    of counts (part ``count``).  The last column is the text."""
    kept = docs.schema.fields[:-1]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabularies(*files.value)
        labels = Pool([f"{i}{s}".encode() for i in range(max(a_most, b_most)) for s in ",|;"])
        counts = _Counts(a_most)
        row = TaskContext.get().partitionId() << 40
        kinds: list[pa.DataType] = []

        def sums(regular: bool) -> pa.RecordBatch:
            at = np.flatnonzero(counts.regular) if regular else np.zeros(0, np.int64)
            keys, n = counts.pairs()
            lists = [pa.array([x], pa.list_(pa.int64())) for x in (at, counts.regular[at], keys, n)]
            none = [pa.nulls(1, k) for k in (*kinds, *[pa.int64()] * 5, pa.string())]
            return pa.RecordBatch.from_arrays(
                [*none[:len(kinds)], pa.array(["count"]), *none[len(kinds):], *lists],
                [*names, *_names(FIRST)])

        for batch in batches:
            kinds = [c.type for c in batch.columns[:-1]]
            data, offsets = text_buffer(batch.column(len(names)))
            for first, last in byte_slices(offsets, SLICE_BYTES):
                n = last - first
                raw = data[offsets[first]:offsets[last]].tobytes()
                cut = (offsets[first:last + 1] - offsets[first]).tolist()
                some = [raw[i:j] for i, j in zip(cut, cut[1:])]
                x = Aligned(v.same, *v.encode(some))
                k = x.links
                counts.add(k, b_most)
                ids = _times(k.text[k.regular], k.a[k.regular], a_most, n)
                other = ~k.regular
                pairs = _times(k.text[other], k.a[other] * b_most + k.b[other], a_most * b_most, n)
                groups = np.bincount(k.text[k.closes], minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(first, n).columns[:-1], pa.array(["text"] * n),
                     pa.array(np.arange(row, row + n)), pa.array(x.a.count), pa.array(x.b.count),
                     pa.array(groups), pa.array(np.bincount(k.text, minlength=n)),
                     pa.array(x.digests(labels), pa.string()), *ids, *pairs],
                    [*names, *_names(FIRST)])
                row += n
                if len(counts.keys) > HELD_PAIRS:
                    yield sums(False)
        if counts.regular.any() or len(counts.keys):
            yield sums(True)

    spark = docs.sparkSession
    schema = StructType(kept + StructType.fromDDL(FIRST).fields)
    path = scratch_path(spark, "alignment")
    docs.mapInArrow(run, schema).write.partitionBy("part").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _names(ddl: str) -> list[str]:
    return [f.split()[0] for f in ddl.split(", ")]


def _pair_counts(first: DataFrame, same: np.ndarray, b_most: int) -> DataFrame:
    """(key, n, regular): all links of each pair over all texts, written."""
    spark = first.sparkSession
    sums = first.where("part = 'count'")
    regular = sums.select(F.explode(F.arrays_zip("ids", "id_times")).alias("x")).groupBy(
        F.col("x.ids").alias("a")).agg(F.sum("x.id_times").alias("n"))
    known = np.flatnonzero(same >= 0)
    key_of = spark.createDataFrame(
        pa.table({"a": known, "key": known * b_most + same[known]}), "a long, key long")
    # the identity map has an entry for an id of A at most
    regular = regular.join(F.broadcast(key_of), "a").select("key", "n", F.lit(True).alias("regular"))
    other = sums.select(F.explode(F.arrays_zip("keys", "key_times")).alias("x")).select(
        F.col("x.keys").alias("key"), F.col("x.key_times").alias("n"), F.lit(False).alias("regular"))
    return materialize(regular.unionByName(other).groupBy("key").agg(
        F.sum("n").alias("n"), F.max("regular").alias("regular")), "pair-counts")


def _columns(df: DataFrame) -> list[np.ndarray]:
    got = df.toArrow()
    return [c.combine_chunks().to_numpy(zero_copy_only=False) for c in got.columns]


@dataclass
class _Lookup:
    """Counts of regular ids (as long as A's vocabulary), the highest count of
    each B id, and the most frequent pairs, sorted."""
    regular: np.ndarray
    best: np.ndarray
    keys: np.ndarray
    n: np.ndarray


def _lookup(counts: DataFrame, a_most: int, b_most: int) -> _Lookup:
    b_id = (F.col("key") % b_most).alias("b")
    best, regular = np.zeros(b_most, np.int64), np.zeros(a_most, np.int64)
    at, n = _columns(counts.groupBy(b_id).agg(F.max("n").alias("n")))  # at most B's vocabulary
    best[at] = n
    at, n = _columns(counts.where("regular").select("key", "n"))  # at most A's
    regular[at // b_most] = n
    total = counts.count()
    least = 0
    if total > HEAD_PAIRS:
        least = counts.agg(F.percentile_approx("n", 1 - HEAD_PAIRS / total)).first()[0] + 1
    # whatever the head leaves out is met in a join, so its bound loses nothing
    keys, n = _columns(counts.where(F.col("n") >= least).select("key", "n").limit(HEAD_PAIRS))
    order = np.argsort(keys)
    return _Lookup(regular, best, keys[order], n[order])


def _sums(values, times, text, n):
    """Sum of values * times of each of n texts, exact."""
    out = np.zeros(n, np.int64)
    np.add.at(out, text, values * times)
    return out


def _flat_list(column) -> tuple[np.ndarray, np.ndarray]:
    """(row of each element, elements) of a list column without nulls."""
    return (np.repeat(np.arange(len(column)), column.value_lengths().to_numpy(zero_copy_only=False)),
            column.flatten().to_numpy(zero_copy_only=False))


def _scored(first: DataFrame, names: list[str], lookup: _Lookup, same: np.ndarray, b_most: int) -> DataFrame:
    """The second pass, written: n_best and count_sum of the regular links and
    the head pairs; pairs beyond the head stay as lists."""
    spark = first.sparkSession
    shared = spark.sparkContext.broadcast((lookup, same))
    numbers = ["row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look, same = shared.value
        for batch in batches:
            n = batch.num_rows
            whole = [batch.column(i) for i in range(len(names) + len(numbers))]
            ids, id_times, keys, key_times = (batch.column(len(whole) + i) for i in range(4))
            text, a = _flat_list(ids)
            times = _flat_list(id_times)[1]
            count = look.regular[a]
            best = _sums(count == look.best[same[a]], times, text, n)
            total = _sums(count, times, text, n)
            text, key = _flat_list(keys)
            times = _flat_list(key_times)[1]
            at = np.searchsorted(look.keys, key)
            at[at == len(look.keys)] = 0
            known = look.keys[at] == key if len(look.keys) else np.zeros(len(key), bool)
            count = look.n[at[known]]
            best += _sums(count == look.best[key[known] % b_most], times[known], text[known], n)
            total += _sums(count, times[known], text[known], n)
            ends = np.r_[0, np.cumsum(np.bincount(text[~known], minlength=n))].astype(np.int32)
            rest = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x[~known])) for x in (key, times)]
            yield pa.RecordBatch.from_arrays(
                [*whole, pa.array(best), pa.array(total), *rest],
                [*names, *numbers, "n_best", "count_sum", "keys", "key_times"])

    texts = first.where("part = 'text'").select(
        *names, *numbers, "ids", "id_times", "keys", "key_times")
    schema = StructType(texts.schema.fields[:len(names) + len(numbers)] + StructType.fromDDL(
        "n_best long, count_sum long, keys array<long>, key_times array<long>").fields)
    return materialize(texts.mapInArrow(run, schema), "alignment-scores")


def align_texts(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
                a_path: str = A_PATH, b_path: str = B_PATH) -> tuple[DataFrame, DataFrame]:
    """(texts, pairs).  texts has the kept columns and n_a, n_b, n_groups,
    n_links, n_best, count_sum, groups_sha256 of each text; pairs has a_id,
    b_id and n, the number of their links in all texts.

    Null and empty texts, and texts whose bytes a tokenizer does not give
    back, have zeros and an empty digest.  Repeated rows each give their row
    and each count; an empty table gives none.  Kept columns named like a
    result are left out; other columns are not read.  The vocabulary files
    are read by the driver and broadcast.
    """
    spark = docs.sparkSession
    keep = tuple(c for c in keep if c not in RESULTS)
    names = [f"k{i}" for i in range(len(keep))]
    v, files = _vocabularies(spark, a_path, b_path)
    a_most, b_most = len(v.a_bytes.size), len(v.b_bytes.size)
    rows = docs.select(*(docs[c].alias(n) for c, n in zip(keep, names)),
                       docs[text_col].cast("string").alias("text"))
    first = _encoded(rows, files, a_most, b_most)
    files.unpersist()
    counts = _pair_counts(first, v.same, b_most)
    scored = _scored(first, names, _lookup(counts, a_most, b_most), v.same, b_most)
    best = counts.groupBy((F.col("key") % b_most).alias("b")).agg(F.max("n").alias("best"))
    rare = scored.select("row", F.explode(F.arrays_zip("keys", "key_times")).alias("x")).select(
        "row", F.col("x.keys").alias("key"), F.col("x.key_times").alias("times"))
    rare = rare.join(counts, "key").join(best, F.col("key") % b_most == F.col("b")).groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("n") * F.col("times")).alias("more_sum"))
    out = scored.drop("keys", "key_times").join(rare, "row", "left")
    texts = out.select(
        *(F.col(n).alias(c) for c, n in zip(keep, names)), "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256")
    pairs = counts.select(F.expr(f"key div {b_most}").alias("a_id"),
                          (F.col("key") % b_most).alias("b_id"), "n")
    return texts, pairs


def op13_tokenizer_alignment(spark, sf_dir):
    return align_texts(table(spark, sf_dir, "documents"))[0]
