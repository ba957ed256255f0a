"""Running summaries in order of time, whatever order records arrive in.

Records wait in a buffer (list state) until the watermark has passed their
time, then an event-time timer lets them go in order of time and sequence,
through the same running values as everywhere else.  As long as no record is
later than the delay, the rows are those of the batch ``running_summary``.  A
record whose time the watermark has passed already would change rows that are
out: it goes to a late log instead, and is counted there.

The watermark moves with the times of the records.  ``flush`` moves it past
all that have arrived, by a heartbeat without a record.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor
from pyspark.sql.types import StructType

from pulseline.streaming.processors import (
    RUNNING_SCHEMA, PacketState, _div_trunc, run_starts, running_runs)
from pulseline.streaming.queries import RECORD_INPUT, _prepare, default_buckets, key_bucket, sink

BUFFERED = ["record_key", "trial_id", "patient_id", "visit_name", "value", "at", "seq"]
BUFFER_TYPES = pa.schema([*((c, pa.string()) for c in BUFFERED[:4]), ("value", pa.int32()),
                          ("at", pa.int64()), ("seq", pa.int64())])
CHUNK_ROWS = 10_000  # of waiting records in one state entry
OUT_SCHEMA = f"{RUNNING_SCHEMA}, late BOOLEAN"
OUT_COLUMNS = [f.split()[0] for f in OUT_SCHEMA.split(", ")]


class OrderBufferProcessor(StatefulProcessor):
    """Buffer and running values of a bucket of keys.  A timer stands for the
    earliest record that waits; it holds what arrives within the delay.
    Records wait in chunks (Arrow streams), so state calls are few."""

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting_chunks", "chunk BINARY")
        self.state = PacketState(handle, "totals_packets")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        staying = []
        for pdf in rows:
            pdf = pdf[pdf["record_key"].notna()]  # heartbeats have moved the watermark, that is all
            late = pdf["at"] < passed
            if late.any():
                yield _rows(pdf[late], late=True)
            staying.append(_table(pdf[~late]))
        stay = pa.concat_tables(staying) if staying else None
        if stay:
            self.waiting.appendList(_chunks(stay))
            self.handle.registerTimer(pc.min(stay["at"]).as_py() + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        chunks = [pa.ipc.open_stream(r[0]).read_all() for r in self.waiting.get()] if self.waiting.exists() else []
        if not chunks:
            return
        held = pa.concat_tables(chunks)
        out = pc.fill_null(pc.less(held["at"], passed), True)
        go, stay = held.filter(out), held.filter(pc.invert(out))
        if not go:
            return
        if stay:
            self.waiting.put(_chunks(stay))
            self.handle.registerTimer(pc.min(stay["at"]).as_py() + 1)
        else:
            self.waiting.clear()
        pdf = go.drop_columns("seq").to_pandas()
        pdf["seq"] = go["seq"].to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
        pdf = pdf.sort_values(["record_key", "at", "seq"], kind="mergesort", na_position="first")
        pdf = pdf.reset_index(drop=True)
        keys = pdf["record_key"].to_numpy()
        starts = run_starts(keys)
        names = keys[starts].tolist()
        (count, total, low, high), now = running_runs(
            pdf["value"].to_numpy(np.int64), starts, self.state.load(names))
        self.state.store(names, now)
        yield _rows(pdf, late=False, run_count=count, run_sum=total, run_min=low, run_max=high,
                    run_avg_int=_div_trunc(total, count), run_avg=total / count)

    def close(self) -> None:
        pass


def _table(pdf: pd.DataFrame) -> pa.Table:
    return pa.table({f.name: pa.Array.from_pandas(pdf[f.name], type=f.type, safe=False) for f in BUFFER_TYPES},
                    schema=BUFFER_TYPES)


def _chunks(rows: pa.Table) -> list[tuple[bytes]]:
    """Rows as state entries of at most ``CHUNK_ROWS``."""
    out = []
    for i in range(0, len(rows), CHUNK_ROWS):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema) as writer:
            writer.write_table(rows.slice(i, CHUNK_ROWS))
        out.append((sink.getvalue().to_pybytes(),))
    return out


_KIND = {"value": "Int32", "seq": "Int64", "run_count": "Int64", "run_sum": "Int64", "run_min": "Int32",
         "run_max": "Int32", "run_avg_int": "Int64", "run_avg": "float64"}


def _rows(pdf: pd.DataFrame, **more) -> pd.DataFrame:
    rows = pdf.assign(start_ts=pd.to_datetime(pdf["at"], unit="ms"), **more)
    return pd.DataFrame({c: rows[c].astype(_KIND[c]) if c in rows and c in _KIND else rows[c] if c in rows
                         else pd.Series(None, rows.index, _KIND[c]) for c in OUT_COLUMNS})


def ordered_running_stream(records: DataFrame, delay: str, heartbeats: DataFrame | None = None,
                           buckets: int | None = None) -> DataFrame:
    """Running summaries of a keyed record stream in order of time, and its
    late records (``late``, without running values).  ``delay`` is how much
    later than others a record may come; ``heartbeats`` (at TIMESTAMP) move
    the watermark."""
    rows = records.select(*RECORD_INPUT).withColumn("_at", F.col("start_ts").cast("timestamp"))
    if heartbeats is not None:
        rows = rows.unionByName(heartbeats.select(F.col("at").alias("_at")), allowMissingColumns=True)
    # the column that carries the watermark goes no further, so that late rows are not dropped unseen
    rows = rows.withWatermark("_at", delay).select(
        *(c for c in BUFFERED if c != "at"), F.unix_millis("_at").alias("at"))
    buckets = buckets or default_buckets(records.sparkSession)
    bucket = F.coalesce(key_bucket("record_key", buckets), F.lit(0))
    return rows.withColumn("_bucket", bucket).groupBy("_bucket").transformWithStateInPandas(
        statefulProcessor=OrderBufferProcessor(), outputStructType=StructType.fromDDL(OUT_SCHEMA),
        outputMode="Append", timeMode="EventTime")


def start_ordered(spark: SparkSession, records: DataFrame, out_dir: str, delay: str, *,
                  trigger: str | None = None, available_now: bool = False,
                  buckets: int | None = None) -> StreamingQuery:
    _prepare(spark)
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{out_dir}/heartbeats")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    beats = spark.readStream.schema("at TIMESTAMP").parquet(f"{out_dir}/heartbeats")
    return sink(ordered_running_stream(records, delay, beats, buckets), f"{out_dir}/ordered",
                f"{out_dir}/_ckpt/ordered", trigger=trigger, available_now=available_now,
                partition_by=("late",))


def flush(spark: SparkSession, out_dir: str, at: str = "9999-01-01 00:00:00") -> None:
    """A heartbeat: when the query has taken it, all records before ``at``
    less the delay have gone out, and those that still come are late."""
    spark.sql(f"SELECT timestamp'{at}' AS at").write.mode("append").parquet(f"{out_dir}/heartbeats")


def ordered_summaries(spark: SparkSession, out_dir: str) -> DataFrame:
    rows = spark.read.schema(OUT_SCHEMA).parquet(f"{out_dir}/ordered")
    return rows.where(~F.col("late")).drop("late")


def late_records(spark: SparkSession, out_dir: str) -> DataFrame:
    rows = spark.read.schema(OUT_SCHEMA).parquet(f"{out_dir}/ordered")
    return rows.where("late").select(*RECORD_INPUT)
