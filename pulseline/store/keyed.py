"""A keyed upsert store: one row per key, kept up to date batch by batch.

Rows live in hash buckets of the key.  A batch is combined by key (partial
aggregation first) and written as a delta; ``merge`` rewrites only the buckets
that deltas have touched.  What counts is a small JSON manifest: it names, for
every bucket, the version that wrote it, and the deltas not yet merged.  Files
are written under names that no manifest knows, then a new manifest is put in
place by one rename.  A job that is lost before that leaves files that nobody
reads, and a batch whose number the manifest has is not taken again.

Layout of a store's folder::

    manifest/<version>.json
    snapshot/write=<write>/bucket=<b>/part-*.parquet
    delta/write=<write>/bucket=<b>/part-*.parquet
    inbox/_batch=<n>/part-*.parquet      (rows of a stream, see ``feed``)

One writer at a time; readers hold on to the manifest they opened with.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from pulseline.operators.summary import combine_partial, finish_summary, partial_summary

BUCKET, WRITE, BATCH = "bucket", "write", "_batch"
BUCKETS = 256


# --- what a store keeps of a key ------------------------------------------------

@dataclass(frozen=True)
class Kind:
    """``prepare`` makes rows of a batch into rows of the store; ``combine``
    makes rows of equal keys one (associative, in any grouping); ``finish``
    makes rows of the store those that a reader sees."""

    prepare: Callable[[DataFrame, str], DataFrame]
    combine: Callable[[DataFrame, str, tuple], DataFrame]
    finish: Callable[[DataFrame, str], DataFrame]


def _latest(rows: DataFrame, key: str, by: tuple) -> DataFrame:
    """One row per key (and ``by`` columns): the latest record.  Grouped by
    the columns themselves, so that rows dealt by ``by`` stay where they are."""
    others = [c for c in rows.columns if c not in (key, *by)]
    last = F.max_by(F.struct(*others), F.struct("start_ts", "seq"))
    return rows.groupBy(*by, key).agg(last.alias("_r")).select(*by, key, "_r.*")


KINDS = {
    # the latest record of a key, as a document written under its id would be
    "latest": Kind(lambda rows, key: rows, _latest, lambda rows, key: rows),
    # count, sum, extremes and the identity of the latest record
    "totals": Kind(partial_summary, combine_partial, finish_summary),
    # occurrences of a key
    "counts": Kind(lambda rows, key: rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")),
                   lambda rows, key, by: rows.groupBy(*by, key).agg(F.sum("n").alias("n")),
                   lambda rows, key: rows),
}


# --- the manifest ---------------------------------------------------------------

@dataclass(frozen=True)
class Manifest:
    key: str
    kind: str
    buckets: int
    schema: dict
    version: int = 0
    next_batch: int = 0
    written: tuple = ()  # by bucket: the write that made it, or None
    deltas: tuple = ()  # (write, touched buckets), oldest first

    @property
    def struct(self) -> StructType:
        return StructType.fromJson(self.schema)

    def touched(self) -> set[int]:
        return {b for _, buckets in self.deltas for b in buckets}


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _manifest_path(path: str, version: int) -> str:
    return f"{path}/manifest/{version:012d}.json"


def _versions(spark: SparkSession, path: str) -> list[int]:
    fs, p = _fs(spark, f"{path}/manifest")
    if not fs.exists(p):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(p))
    return sorted(int(n[:-5]) for n in names if n.endswith(".json"))


def _read_manifest(spark: SparkSession, path: str, version: int) -> Manifest:
    fs, p = _fs(spark, _manifest_path(path, version))
    stream = fs.open(p)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    d = json.loads(text)
    return Manifest(**{**d, "written": tuple(d["written"]),
                       "deltas": tuple((w, tuple(b)) for w, b in d["deltas"])})


class Conflict(RuntimeError):
    """Another writer has committed since this one opened the store."""


@dataclass
class KeyedStore:
    spark: SparkSession
    path: str
    manifest: Manifest
    rewritten: list[int] = field(default_factory=list)  # buckets of the last merge

    @classmethod
    def create(cls, spark: SparkSession, path: str, rows: DataFrame, key: str = "record_key",
               kind: str = "latest", buckets: int = BUCKETS) -> KeyedStore:
        """A new, empty store for batches with the columns of ``rows``."""
        if _versions(spark, path):
            raise ValueError(f"there is a store in {path}")
        k = KINDS[kind]
        schema = k.combine(k.prepare(rows, key), key, ()).schema
        store = cls(spark, path, Manifest(key, kind, buckets, json.loads(schema.json()), -1,
                                          written=(None,) * buckets))
        store._commit(store.manifest)
        return store

    @classmethod
    def open(cls, spark: SparkSession, path: str, version: int | None = None) -> KeyedStore:
        """The store as of its last commit, or as of an earlier version whose
        files are still there."""
        versions = _versions(spark, path)
        if not versions:
            raise FileNotFoundError(f"no store in {path}")
        return cls(spark, path, _read_manifest(spark, path, versions[-1] if version is None else version))

    @classmethod
    def open_or_create(cls, spark: SparkSession, path: str, rows: DataFrame, **kw) -> KeyedStore:
        return cls.open(spark, path) if _versions(spark, path) else cls.create(spark, path, rows, **kw)

    # --- writing

    def append(self, rows: DataFrame, batch: int) -> bool:
        """Take a batch.  Batches are numbered from 0 without gaps; one that
        the store has already is left out (False), so a restarted job may
        offer its last batch again.  A batch without rows counts too."""
        m = self.manifest
        if batch < m.next_batch:
            return False
        if batch > m.next_batch:
            raise ValueError(f"batch {batch} came before batch {m.next_batch}")
        k = KINDS[m.kind]
        write = self._name()
        self._write(k.combine(k.prepare(rows, m.key), m.key, ()), "delta", write)
        touched = self._buckets_of("delta", write)
        self._commit(replace(m, next_batch=batch + 1,
                             deltas=m.deltas + (((write, touched),) if touched else ())))
        return True

    def merge(self) -> list[int]:
        """Rewrite the buckets that deltas have touched, and no others.
        Returns their numbers."""
        m = self.manifest
        touched = sorted(m.touched())
        if touched:
            write = self._name()
            self._write(self._combined(touched), "snapshot", write)
            self._commit(replace(m, deltas=(), written=tuple(
                write if b in m.touched() else w for b, w in enumerate(m.written))))
        self.rewritten = touched
        return touched

    def vacuum(self) -> int:
        """Delete what the current manifest does not name (earlier versions
        and writes that were never committed).  Returns the number of
        folders deleted."""
        m, gone = self.manifest, 0
        named = {"snapshot": set(m.written), "delta": {w for w, _ in m.deltas}}
        for part, keep in named.items():
            fs, p = _fs(self.spark, f"{self.path}/{part}")
            for s in fs.listStatus(p) if fs.exists(p) else []:
                if s.getPath().getName().removeprefix(f"{WRITE}=") not in keep:
                    gone += bool(fs.delete(s.getPath(), True))
        for v in _versions(self.spark, self.path):
            if v < m.version:
                fs, p = _fs(self.spark, _manifest_path(self.path, v))
                fs.delete(p, False)
        return gone

    # --- reading

    def read(self) -> DataFrame:
        """One row per key after all batches.  Buckets without a pending delta
        are read as they are; the others are combined on the way."""
        m = self.manifest
        touched = m.touched()
        rows = self._snapshot(b for b in range(m.buckets) if b not in touched)
        if touched:
            rows = rows.unionByName(self._combined(sorted(touched)))
        return KINDS[m.kind].finish(rows.drop(BUCKET), m.key)

    def get(self, *keys: str) -> DataFrame:
        """The rows of some keys; only their buckets are read."""
        m = self.manifest
        probe = self.spark.createDataFrame([(k,) for k in keys], f"{m.key} string")
        of = {r[0] for r in probe.select(self._bucket()).collect()}
        rows = self._combined(sorted(of)).where(F.col(m.key).isin(*keys))
        return KINDS[m.kind].finish(rows.drop(BUCKET), m.key)

    # --- parts of these

    def _bucket(self):
        return F.pmod(F.xxhash64(self.manifest.key), F.lit(self.manifest.buckets)).cast("int").alias(BUCKET)

    def _name(self) -> str:
        return f"{self.manifest.version + 1:012d}-{uuid.uuid4().hex[:8]}"

    def _write(self, rows: DataFrame, part: str, write: str) -> None:
        """One file for each bucket that has rows."""
        if BUCKET not in rows.columns:
            rows = rows.withColumn(BUCKET, self._bucket()).repartition(
                self.manifest.buckets, BUCKET)
        rows.write.partitionBy(BUCKET).parquet(f"{self.path}/{part}/{WRITE}={write}")

    def _buckets_of(self, part: str, write: str) -> tuple[int, ...]:
        fs, p = _fs(self.spark, f"{self.path}/{part}/{WRITE}={write}")
        names = (s.getPath().getName() for s in fs.listStatus(p))
        return tuple(sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{BUCKET}=")))

    def _read(self, part: str, of: list[tuple[str, int]]) -> DataFrame:
        """Rows of (write, bucket) folders."""
        schema = StructType(self.manifest.struct.fields).add(WRITE, StringType()).add(BUCKET, IntegerType())
        if of:
            rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/{part}").parquet(
                *(f"{self.path}/{part}/{WRITE}={w}/{BUCKET}={b}" for w, b in of))
        else:
            rows = self.spark.createDataFrame([], schema)
        return rows.drop(WRITE)

    def _snapshot(self, buckets) -> DataFrame:
        written = self.manifest.written
        return self._read("snapshot", [(written[b], b) for b in buckets if written[b] is not None])

    def _combined(self, buckets: list[int]) -> DataFrame:
        """The rows of some buckets, snapshot and deltas combined; grouped by
        bucket and key, so that they stay together for the write."""
        m, some = self.manifest, set(buckets)
        rows = self._snapshot(buckets).unionByName(self._read(
            "delta", [(w, b) for w, touched in m.deltas for b in touched if b in some]))
        return KINDS[m.kind].combine(rows.repartition(m.buckets, BUCKET), m.key, (BUCKET,))

    def _commit(self, m: Manifest) -> None:
        """Put a manifest in place: written under another name, then renamed."""
        m = replace(m, version=m.version + 1)
        versions = _versions(self.spark, self.path)
        if versions and versions[-1] >= m.version:
            raise Conflict(f"version {versions[-1]} of {self.path} was committed meanwhile")
        final = _manifest_path(self.path, m.version)
        fs, tmp = _fs(self.spark, f"{self.path}/manifest/.{m.version}-{uuid.uuid4().hex}")
        out = fs.create(tmp)
        try:
            out.write(bytearray(json.dumps(asdict(m)).encode()))
        finally:
            out.close()
        if not fs.rename(tmp, _fs(self.spark, final)[1]):
            raise Conflict(f"{final} could not be put in place")
        self.manifest = m


def feed(store: KeyedStore, stream: DataFrame, checkpoint: str, most_deltas: int = 8) -> bool:
    """Take what a stream has by now as the store's next batch; merge when
    ``most_deltas`` batches wait for it.

    The stream's rows go to the store's inbox, a log partitioned by batch
    number, with the stream's own checkpoint, and from there into the store.
    Wherever that is cut off, the next call goes on: rows that reached the
    inbox are of the next batch until the store has committed it, and only
    rows that the stream has committed are read.
    """
    spark, batch = store.spark, store.manifest.next_batch
    inbox = f"{store.path}/inbox"
    numbered = stream.withColumn(BATCH, F.lit(batch))
    query = (numbered.writeStream.format("parquet").outputMode("append").option("path", inbox)
             .option("checkpointLocation", checkpoint).partitionBy(BATCH).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    fs, p = _fs(spark, f"{inbox}/{BATCH}={batch}")
    if not fs.exists(p):
        return False
    rows = spark.read.schema(numbered.schema).parquet(inbox).where(F.col(BATCH) == batch).drop(BATCH)
    if rows.isEmpty() or not store.append(rows, batch):
        return False
    if len(store.manifest.deltas) >= most_deltas:
        store.merge()
    return True
