"""SimHash near-duplicates: BK-trees over shards of fingerprints.

Equal texts share a fingerprint, so all further work is on distinct
fingerprints.  Two fingerprints that differ in at most 3 of 64 bits agree in
one of 4 bands of 16 bits, and in the other 48 bits in one of 4 bands of 12:
each fingerprint goes to the 16 shards named by such a pair of bands, and no
link is lost.  A shard with more than ``max_shard`` fingerprints is split once
more, by 4 bands of 9 of the 36 bits left.  In each shard a BK-tree (children
keyed by their distance to the parent) is searched along the edges that the
radius allows; of the links found only a spanning forest leaves the shard.
Components come from large-star and small-star rounds on those links.

The trees are built where their shards are, from a shuffle.  Sending them
through the driver would collect the fingerprints of all documents there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseline.llm.common import table, text_lists
from pulseline.session import materialize

SHINGLE = 3
RADIUS = 3
SEED = 42
MAX_SHARD = 4096
_HASHES_AT_ONCE = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a UTF-8 text; bytes.lower and bytes.split know ASCII only."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        ends = starts[shingle:] + [at]
        hash_of = xxhash.xxh64_intdigest
        hashes = [hash_of(line[s:e - 1], SEED) for s, e in zip(starts, ends)]
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _HASHES_AT_ONCE):
        part = np.array(hashes[i:i + _HASHES_AT_ONCE], dtype="<u8")
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1,
                               bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = np.array([fingerprint(t, shingle) for t in text_lists(b.column(1))], dtype="<u8")
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found.view(np.int64))],
                                         ["doc_id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) per row; fp is the fingerprint as a signed 64-bit integer."""
    d = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(lambda b: _fingerprints(b, shingle), f"doc_id {kind}, fp long")


def _bits(low: int, n: int) -> Column:
    return F.shiftrightunsigned(F.col("fp"), low).bitwiseAND((1 << n) - 1)


def _rest(band: int) -> list[tuple[int, int]]:
    """(low, n) bit runs that remain beside a band of 16, as 4 bands of 12."""
    bits = [i for i in range(64) if i // 16 != band]
    return [bits[i * 12:i * 12 + 12] for i in range(4)]


def _of_bits(bits: list[int]) -> Column:
    """The given bit positions of fp, packed; positions form at most two runs."""
    out, place, i = None, 0, 0
    while i < len(bits):
        j = i
        while j + 1 < len(bits) and bits[j + 1] == bits[j] + 1:
            j += 1
        part = F.shiftleft(_bits(bits[i], j - i + 1), place)
        out = part if out is None else out.bitwiseOR(part)
        place += j - i + 1
        i = j + 1
    return out


def _shards() -> list[tuple[Column, list[int]]]:
    """The 16 shard keys of a fingerprint, each with the 36 bits it leaves out."""
    keys = []
    for band in range(4):
        rest = _rest(band)
        for k, some in enumerate(rest):
            name = F.lit((band * 4 + k) << 28).cast("long")
            key = name + F.shiftleft(_bits(band * 16, 16), 12) + _of_bits(some)
            keys.append((key, [b for other in rest if other is not some for b in other]))
    return keys


class BkTree:
    """Burkhard-Keller tree of integers under Hamming distance."""

    def __init__(self):
        self.value: list[int] = []
        self.children: list[dict[int, int]] = []

    def near_then_add(self, x: int, radius: int) -> list[int]:
        """Nodes within the radius of x, found along the edges it allows;
        then x becomes a node."""
        found, value, children = [], self.value, self.children
        if value:
            todo = [0]
            while todo:
                node = todo.pop()
                d = (value[node] ^ x).bit_count()
                if d <= radius:
                    found.append(node)
                for edge, child in children[node].items():
                    if d - radius <= edge <= d + radius:
                        todo.append(child)
            node = 0
            while True:
                d = (value[node] ^ x).bit_count()
                if d not in children[node]:
                    children[node][d] = len(value)
                    break
                node = children[node][d]
        value.append(x)
        children.append({})
        return found


def _forest(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that connect what the radius connects, one fewer than each part has members."""
    tree, parent, links = BkTree(), list(range(len(values))), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, x in enumerate(values):
        for j in tree.near_then_add(x, radius):
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((x, values[j]))
    return links


def _search(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by shard; a shard may reach over several batches."""
    key, held = None, np.zeros(0, np.uint64)

    def out(links):
        a = np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], ["a", "b"])

    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        fps = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        if not len(keys):
            continue
        edges = np.flatnonzero(np.diff(keys)) + 1
        starts, ends = np.r_[0, edges], np.r_[edges, len(keys)]
        links: list = []
        if key is not None and keys[0] == key:
            held = np.concatenate([held, fps[:ends[0]]])
        else:
            if len(held) > 1:
                links += _forest(held.tolist(), radius)
            held = fps[:ends[0]]
        if len(starts) > 1:
            if len(held) > 1:
                links += _forest(held.tolist(), radius)
            middle = slice(1, len(starts) - 1)
            several = ends[middle] - starts[middle] > 1
            for s, e in zip(starts[middle][several].tolist(), ends[middle][several].tolist()):
                links += _forest(fps[s:e].tolist(), radius)
            held = fps[starts[-1]:]
        key = keys[-1]
        if links:
            yield out(links)
    if len(held) > 1 and (links := _forest(held.tolist(), radius)):
        yield out(links)


def _in_pairs(keyed: DataFrame, max_shard: int) -> DataFrame:
    """(fp, key) with no key of more than about 2 * ``max_shard`` fingerprints.

    A shard above ``max_shard`` is divided into sub-shards by the hash of the
    fingerprint, and each two of them make a shard of their own: any two
    fingerprints of the shard still meet in one, and a family of any size that
    agrees in all bits of a key is spread over many tasks."""
    crowded = keyed.groupBy("key").count().where(F.col("count") > max_shard).select(
        "key", F.ceil(F.col("count") / max_shard).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("parts")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.xxhash64(
        "key", F.least(own, j), F.greatest(own, j)))
    return keyed.join(crowded, "key", "left").select("fp", F.explode(
        F.when(F.col("parts").isNotNull(), pairs).otherwise(F.array("key"))).alias("key"))


def links(distinct: DataFrame, radius: int = RADIUS, max_shard: int = MAX_SHARD) -> DataFrame:
    """Edges (a, b) that connect all fingerprints that the radius connects."""
    if radius > 3:
        raise ValueError("4 bands find links of at most 3 bits")
    shards = _shards()
    keyed = distinct.select("fp", F.explode(F.array(*(k for k, _ in shards))).alias("key"))
    crowded = keyed.groupBy("key").count().where(F.col("count") > max_shard).select(
        "key", F.lit(True).alias("crowded"))
    kind = F.shiftrightunsigned("key", 28)
    finer = None
    for i, (_, rest) in enumerate(shards):
        four = F.array(*(F.xxhash64("key", F.lit(k), _of_bits(rest[k * 9:k * 9 + 9]))
                         for k in range(4)))
        finer = F.when(kind == i, four) if finer is None else finer.when(kind == i, four)
    keyed = keyed.join(crowded, "key", "left")
    calm = keyed.where(F.col("crowded").isNull()).select("fp", "key")
    again = materialize(keyed.where("crowded").select("fp", F.explode(finer).alias("key")), "crowded")
    keyed = calm.unionByName(_in_pairs(again, max_shard))
    keyed = keyed.select("key", "fp").repartition("key").sortWithinPartitions("key", "fp")
    return keyed.mapInArrow(lambda b: _search(b, radius), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of an edge.

    Large-star links a node's larger neighbours to the least of its
    neighbourhood, small-star its smaller ones; minima are partial aggregates
    and the joins are split by Spark where one node has most of the links.
    Each round is a written table; the end is a round that changes nothing.
    """
    now = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                      .where("u <> v").distinct(), "links")
    state = None
    while True:
        after = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == state or after[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = after
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").where("v > u").select(
            F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
        now = materialize(small.select("e.u", "e.v").where("u <> v").distinct(), "links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, radius: int = RADIUS,
                    max_shard: int = MAX_SHARD) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row.

    Null, empty and word-less texts have fingerprint 0 and link like others; a
    text of fewer than ``shingle`` words is one shingle.  Repeated rows and
    ids are fine, as the work is by fingerprint.  A null id is never the
    smallest; a component of null ids only has a null component_id.  An empty
    table gives no row; other columns are not read.
    """
    marked = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    star = components(links(distinct.select("fp"), radius, max_shard))
    member = distinct.join(star.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = member.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = member.select("fp", "root").join(smallest, "root").select("fp", "component_id")
    return marked.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of the document with the smallest id of each component.  Rows
    that repeat an id are one document and stay or go together."""
    found = near_duplicates(docs, id_col, **options)
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(first, docs[id_col].eqNullSafe(first["_kept_id"]), "left_semi")


def op7_simhash_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
