"""The sensor program as one query: every line is read and parsed once.

One stateful query emits rows of five kinds into one log partitioned by
``tag``: ``record`` (the parsed record), ``summary`` (its key's running
values), ``alert`` (a record beyond the threshold), ``total`` (a key's totals
after a batch that had it) and ``reject`` (a line that does not parse, with
its reason and origin).

Rejects are a dead-letter log.  ``replay`` takes the rejects that no replay
has had, parses their lines under another configuration and hands all of them
back to the program through a second input; there the good ones become
records and the others rejects of a further attempt.  Both directions are
checkpointed streams over committed files, so each line ends up in the log
once, whatever is restarted in between.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor
from pyspark.sql.types import StructType

from pulseline.config import SensorConfig
from pulseline.operators.records import filter_fields, filter_lines, line_counts, parse_lines
from pulseline.operators.summary import IDENTITY, _avg_cols
from pulseline.sources.lines import read_lines
from pulseline.streaming.processors import PacketState, _div_trunc, run_starts, running_runs
from pulseline.streaming.queries import _prepare, await_all, default_buckets, sink

RECORD = ("record_key STRING, variance INT, percentage FLOAT, trial_id STRING, patient_id STRING, "
          "visit_name STRING, value INT, device STRING, start_date DATE, start_time INT, end_date DATE, "
          "end_time INT, start_ts TIMESTAMP_NTZ, seq BIGINT")
LETTER = "raw STRING, origin STRING, attempt INT, reason STRING, letter STRING"
RUNNING = ("run_count BIGINT, run_sum BIGINT, run_min INT, run_max INT, run_avg_int BIGINT, "
           "run_avg DOUBLE")
TAGS = ("record", "summary", "alert", "total", "reject")


def _names(ddl: str) -> list[str]:
    return [f.split()[0] for f in ddl.split(", ")]


RECORD_COLUMNS, LETTER_COLUMNS, RUNNING_COLUMNS = map(_names, (RECORD, LETTER, RUNNING))
#: parsed lines, as they reach the stateful step and as a replay hands them back
PARSED = f"{RECORD}, {LETTER}"
LOG = f"tag STRING, {PARSED}, {RUNNING}, alert STRING"


def parsed_lines(lines: DataFrame, cfg: SensorConfig) -> DataFrame:
    """Lines (value, origin, attempt, letter) -> parsed rows, good and bad."""
    rows = parse_lines(lines, cfg.separator, cfg.base_value, carry=("origin", "attempt", "letter"))
    key = F.when(F.col("reason").isNull(), F.concat_ws("_", *cfg.key_columns))
    return rows.withColumn("record_key", key).select(*RECORD_COLUMNS, *LETTER_COLUMNS)


class OnePassProcessor(StatefulProcessor):
    """All outputs of a bucket of keys (and of bad lines); one state entry for
    each key: its totals and the identity of its latest record."""

    def __init__(self, threshold: int | None):
        self.threshold = threshold

    def init(self, handle) -> None:
        # entries: count, sum, min, max, start second and sequence of the latest record, its identity
        self.state = PacketState(handle, "totals_packets")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True)
        bad = pdf["reason"].notna()
        if bad.any():
            yield self._tagged(pdf[bad], "reject")
        good = pdf[~bad]
        if len(good):
            yield from self._records(good)

    def _tagged(self, rows: pd.DataFrame, tag: str, **more) -> pd.DataFrame:
        """Log rows with the columns that ``rows`` has, the others null."""
        rows = rows.assign(tag=tag, **more)
        return pd.DataFrame({
            c: rows[c].astype(LOG_TYPES.get(c, object)) if c in rows else
            pd.Series(None, rows.index, LOG_TYPES.get(c, object)) for c in LOG_COLUMNS})

    def _records(self, pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        order = ["record_key", "start_ts", "seq"]
        pdf = pdf.sort_values(order, kind="mergesort", na_position="first").reset_index(drop=True)
        keys = pdf["record_key"].to_numpy()
        starts = run_starts(keys)
        names = keys[starts].tolist()
        states = self.state.load(names)
        run, now = running_runs(pdf["value"].to_numpy(np.int64), starts, states)
        ends = np.append(starts[1:], len(pdf)) - 1
        at, seq = _order_numbers(pdf)
        latest = zip(at[ends].tolist(), seq[ends].tolist(), *(pdf[c].to_numpy()[ends].tolist() for c in IDENTITY))
        latest = [last if old is None or (old[4], old[5]) <= last[:2] else tuple(old[4:])
                  for last, old in zip(latest, states)]
        self.state.store(names, [(*n, *last) for n, last in zip(now, latest)])
        totals = [(k, *last[2:], *n) for k, n, last in zip(names, now, latest)]
        yield self._tagged(pdf[RECORD_COLUMNS], "record")
        count, total, low, high = run
        yield self._tagged(
            pdf[["record_key", *IDENTITY, "value", "start_ts", "seq"]], "summary", run_count=count,
            run_sum=total, run_min=low, run_max=high, run_avg_int=_div_trunc(total, count),
            run_avg=total / count)
        yield self._tagged(pd.DataFrame(totals, columns=["record_key", *IDENTITY, *RUNNING_COLUMNS[:2],
                                                         "run_min", "run_max"]), "total")
        if self.threshold is not None:
            loud = pdf[pdf["variance"].astype("int64").abs() > self.threshold]
            if len(loud):
                yield self._tagged(loud[["record_key", "start_ts", "seq", "value", "variance"]], "alert",
                                   alert=np.where(loud["variance"] > 0, "high", "low"))

    def close(self) -> None:
        pass


def _order_numbers(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(start second, sequence) of each record; missing ones come first."""
    least = np.iinfo(np.int64).min
    ts = pdf["start_ts"]
    at = np.where(ts.isna(), least, ts.astype("datetime64[s]").astype("int64"))
    return at, pdf["seq"].fillna(least).astype("int64").to_numpy()


LOG_COLUMNS = _names(LOG)
_KIND = {"INT": "Int32", "BIGINT": "Int64", "FLOAT": "float32", "DOUBLE": "float64",
         "TIMESTAMP_NTZ": "datetime64[us]"}
LOG_TYPES = {n: _KIND[t] for n, t in (f.split() for f in LOG.split(", ")) if t in _KIND}


def one_pass(parsed: DataFrame, threshold: int | None, buckets: int | None = None) -> DataFrame:
    """Rows of the tagged log from parsed lines (a stream)."""
    buckets = buckets or default_buckets(parsed.sparkSession)
    # bad lines have no key: their own text spreads them
    of = F.pmod(F.xxhash64(F.coalesce("record_key", "raw")), F.lit(buckets)).cast("int")
    # a new letter for each further attempt
    parsed = parsed.withColumn("letter", F.when(F.col("reason").isNotNull(), F.expr("uuid()")))
    return parsed.withColumn("_bucket", of).groupBy("_bucket").transformWithStateInPandas(
        statefulProcessor=OnePassProcessor(threshold), outputStructType=StructType.fromDDL(LOG),
        outputMode="Append", timeMode="None")


def _lines(spark: SparkSession, cfg: SensorConfig) -> DataFrame:
    mode = "socket" if cfg.source == "socket" else "stream"
    lines = read_lines(spark, cfg.path, mode=mode, host=cfg.host, port=cfg.port,
                       max_files_per_trigger=cfg.max_files_per_trigger,
                       max_bytes_per_trigger=cfg.max_bytes_per_trigger)
    origin = F.col("_metadata.file_path") if mode == "stream" else F.lit(None).cast("string")
    return lines.select("value", origin.alias("origin"), F.lit(0).alias("attempt"),
                        F.lit(None).cast("string").alias("letter"))


def _folder(spark: SparkSession, path: str) -> str:
    """A folder that streams may watch before its first file."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)
    return path


def start_one_pass(spark: SparkSession, cfg: SensorConfig, out_dir: str, *, available_now: bool = False,
                   buckets: int | None = None) -> dict[str, StreamingQuery]:
    """Start the program over its lines and what replays have handed back."""
    _prepare(spark)
    base = cfg.checkpoint or f"{out_dir}/_ckpt"
    lines = filter_fields(filter_lines(_lines(spark, cfg), cfg.filter_terms), cfg.field_terms, cfg.separator)
    back = spark.readStream.schema(PARSED).parquet(_folder(spark, f"{out_dir}/replayed"))
    parsed = parsed_lines(lines, cfg).unionByName(back)
    # counted in the same pass; a listener or lastProgress has them by batch
    parsed = parsed.observe("lines", *line_counts())
    return {"log": sink(one_pass(parsed, cfg.alert_threshold, buckets), f"{out_dir}/log", f"{base}/log",
                        trigger=None if available_now else cfg.trigger, available_now=available_now,
                        partition_by=("tag",))}


def replay(spark: SparkSession, cfg: SensorConfig, out_dir: str) -> StreamingQuery:
    """Parse the rejects that no replay has had under ``cfg`` and hand them
    back; ``start_one_pass`` takes them with its next batch."""
    letters = spark.readStream.schema(LOG).parquet(f"{out_dir}/log").where("tag = 'reject'")
    lines = letters.select(F.col("raw").alias("value"), "origin", (F.col("attempt") + 1).alias("attempt"),
                           "letter")
    base = cfg.checkpoint or f"{out_dir}/_ckpt"
    return sink(parsed_lines(lines, cfg), f"{out_dir}/replayed", f"{base}/replay", available_now=True)


def replay_all(spark: SparkSession, program: SensorConfig, repair: SensorConfig, out_dir: str,
               **kw) -> None:
    """One replay of all open rejects, and the program's batch that takes it."""
    await_all([replay(spark, repair, out_dir)])
    await_all(start_one_pass(spark, program, out_dir, available_now=True, **kw))


# --- reading the log --------------------------------------------------------------

def tagged(spark: SparkSession, out_dir: str, tag: str) -> DataFrame:
    """Rows of one tag; other partitions of the log are not read."""
    return spark.read.schema(LOG).parquet(f"{out_dir}/log").where(F.col("tag") == tag)


def records(spark: SparkSession, out_dir: str) -> DataFrame:
    return tagged(spark, out_dir, "record").select(*RECORD_COLUMNS)


def summaries(spark: SparkSession, out_dir: str) -> DataFrame:
    return tagged(spark, out_dir, "summary").select(
        "record_key", *IDENTITY, "value", "start_ts", "seq", *RUNNING_COLUMNS)


def alerts(spark: SparkSession, out_dir: str) -> DataFrame:
    return tagged(spark, out_dir, "alert").select(
        "record_key", "start_ts", "seq", "value", "variance", "alert")


def totals(spark: SparkSession, out_dir: str) -> DataFrame:
    """Totals per key after the last batch; the log has one row for each key
    and batch that had it."""
    last = tagged(spark, out_dir, "total").groupBy("record_key").agg(F.max_by(F.struct(
        *IDENTITY, "run_sum", "run_min", "run_max"), "run_count").alias("t"),
        F.max("run_count").alias("n_records"))
    return last.select(
        "record_key", *(f"t.{c}" for c in IDENTITY), "n_records", F.col("t.run_sum").alias("sum_value"),
        F.col("t.run_min").alias("min_value"), F.col("t.run_max").alias("max_value")).select(
            "*", *_avg_cols("n_records", "sum_value"))


def dead_letters(spark: SparkSession, out_dir: str, all_attempts: bool = False) -> DataFrame:
    """(letter, attempt, raw, reason, origin) of the rejects that are still
    open: those of them that no replay has handed back."""
    found = tagged(spark, out_dir, "reject").select("letter", "attempt", "raw", "reason", "origin")
    if all_attempts:
        return found
    try:
        back = spark.read.schema(PARSED).parquet(f"{out_dir}/replayed").select("letter")
    except Exception as missing:  # no replay has run yet
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return found
    return found.join(back, "letter", "left_anti")
