"""Structured Streaming queries of the sensor and word-count programs.

Sources are folder-watching text/parquet streams (or a socket for
development); sinks are Parquet append logs with their own checkpoint, so
a restarted query resumes from its offsets and state.  Totals per key are
kept in a keyed store that takes what a stream has batch by batch; no driver
callback is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulseline.config import DEFAULT_WORD_SEED
from pulseline.operators.records import (
    add_key, filter_fields, filter_lines, parse_trial, trial_records)
from pulseline.operators.report import flag_alerts
from pulseline.operators.summary import IDENTITY, _avg_cols
from pulseline.operators.words import WORDS, seed_frame, tokenize, with_seed
from pulseline.session import STATE_STORE_PROVIDER, settings
from pulseline.sources.lines import read_lines
from pulseline.store.keyed import KeyedStore, feed
from pulseline.streaming.packed import BUCKETS, PACKED_SCHEMA, pack_batches
from pulseline.streaming.processors import (
    COMPAT_SCHEMA, RUNNING_SCHEMA, WORDS_SCHEMA, BucketedLiteralFoldProcessor,
    BucketedRunningSummaryProcessor, LiteralFoldProcessor, PackedWordCountProcessor,
    RunningSummaryProcessor, WordCountProcessor)

RECORD_INPUT = ["record_key", "trial_id", "patient_id", "visit_name", "value", "start_ts", "seq"]


def _prepare(spark: SparkSession) -> None:
    # transformWithState needs the RocksDB state store
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE_PROVIDER)
    # a batch writes what it changed; whole snapshots follow in the background
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    # else the store of each partition takes 4 MB of disk at once, one after each restart
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")


def sink(df: DataFrame, path: str, checkpoint: str, *, trigger: str | None = None,
         available_now: bool = False, partition_by=(), name: str | None = None, codec: str | None = None) -> StreamingQuery:
    """Append a streaming DataFrame to a Parquet log with its own checkpoint;
    ``codec`` is its compression, if not the session's."""
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        w = w.queryName(name)
    if codec:
        w = w.option("compression", codec)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()


def console(df: DataFrame, n: int = 10, trigger: str | None = None,
            available_now: bool = False) -> StreamingQuery:
    """Print the first ``n`` rows of every batch (``--show`` of the runner)."""
    w = df.writeStream.format("console").option("numRows", str(n)).outputMode("append")
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()


def records_seen(spark: SparkSession, out_dir: str) -> int:
    """Records a sensor run has seen so far, counted in its record log (from
    file footers): all batches count, however long ago they ran."""
    return spark.read.parquet(f"{out_dir}/records").count()


MIN_BUCKETS = 256


def default_buckets(spark: SparkSession) -> int:
    """Key buckets of a stateful stream: at least two per state partition
    (``spark.sql.shuffle.partitions``), so every partition's task gets work
    on a large cluster, and at least ``MIN_BUCKETS``.  The count is part of
    a query's checkpoint: a restart must use the same value (keep the
    shuffle-partition setting, as Spark requires for stateful queries, or
    pass ``buckets`` explicitly)."""
    try:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    except (TypeError, ValueError):
        parts = spark.sparkContext.defaultParallelism
    return max(MIN_BUCKETS, 2 * parts)


def key_bucket(col, buckets: int):
    return F.pmod(F.xxhash64(col), F.lit(buckets)).cast("int")


def running_summary_stream(records: DataFrame, literal: bool = False,
                           buckets: int | None = -1) -> DataFrame:
    """Per-record running summaries of a keyed record stream (stateful).

    The stateful function runs once per hash bucket of keys (``buckets``,
    default ``default_buckets``) with one state entry per key; ``None``
    groups by the key itself (one Python call per key and batch).
    """
    recs = records.select(*RECORD_INPUT)
    schema = COMPAT_SCHEMA if literal else RUNNING_SCHEMA
    if buckets is None:
        proc = LiteralFoldProcessor() if literal else RunningSummaryProcessor()
        grouped = recs.groupBy("record_key")
    else:
        if buckets == -1:
            buckets = default_buckets(records.sparkSession)
        proc = BucketedLiteralFoldProcessor() if literal else BucketedRunningSummaryProcessor()
        grouped = recs.withColumn("_bucket", key_bucket("record_key", buckets)).groupBy("_bucket")
    return grouped.transformWithStateInPandas(
        statefulProcessor=proc, outputStructType=schema, outputMode="Append", timeMode="None")


def summary_updates_stream(records: DataFrame, key: str = "record_key") -> DataFrame:
    """Totals per key with built-in streaming aggregation (no Python state).

    For ``update`` output mode: each batch emits the keys it changed with
    their new totals; the identity is that of the latest record.  The keyed
    view of all totals is a store, see ``feed_totals``.
    """
    return records.groupBy(key).agg(
        F.max_by(F.struct(*IDENTITY), F.struct("start_ts", "seq")).alias("identity"),
        F.count(F.lit(1)).alias("n_records"),
        F.sum("value").cast("bigint").alias("sum_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
    ).select(key, "identity.*", "n_records", "sum_value", "min_value", "max_value",
             *_avg_cols("n_records", "sum_value"))


def word_totals_stream(texts: DataFrame) -> DataFrame:
    """Occurrences per word with built-in streaming aggregation."""
    return tokenize(texts).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def feed_totals(spark: SparkSession, records: DataFrame, out_dir: str, checkpoint: str | None = None) -> bool:
    """Take what the record stream has by now into the store of totals per
    key (``sensor_totals``)."""
    store = KeyedStore.open_or_create(spark, f"{out_dir}/totals", _like(spark, records), kind="totals")
    return feed(store, records, f"{checkpoint or out_dir + '/_ckpt'}/totals")


def sensor_totals(spark: SparkSession, out_dir: str) -> DataFrame:
    """Totals per key of a sensor run, one row per key, from their store."""
    return KeyedStore.open(spark, f"{out_dir}/totals").read()


def feed_word_totals(spark: SparkSession, texts: DataFrame, out_dir: str) -> bool:
    """Take the words of the text stream into the store of their counts."""
    words = tokenize(texts).select("word")
    store = KeyedStore.open_or_create(spark, f"{out_dir}/word_totals", _like(spark, words), key="word",
                                      kind="counts")
    return feed(store, words, f"{out_dir}/_ckpt/word_totals")


def word_totals(spark: SparkSession, out_dir: str, seed=DEFAULT_WORD_SEED) -> DataFrame:
    """Occurrences per word of a text stream so far, seed included."""
    return with_seed(KeyedStore.open(spark, f"{out_dir}/word_totals").read(), seed).select(
        "word", (F.col("n") + F.coalesce("seed_n", F.lit(0))).alias("n"))


def _like(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """An empty batch with the columns of a stream."""
    return spark.createDataFrame([], rows.schema)


def word_count_stream(texts: DataFrame, seed=DEFAULT_WORD_SEED,
                      buckets: int | None = -1) -> DataFrame:
    """Cumulative seeded word counts of a text stream (one row per token).

    The stateful function runs once per hash bucket of words (``buckets``,
    default ``default_buckets``); state is still one entry per word.  Tokens
    are shuffled to their bucket packed (``streaming.packed``).  ``None`` keys
    it by word.
    """
    spark = texts.sparkSession
    seed_df = seed if isinstance(seed, DataFrame) else seed_frame(spark, seed)
    if buckets is None:
        return tokenize(texts).groupBy("word").transformWithStateInPandas(
            statefulProcessor=WordCountProcessor(), outputStructType=WORDS_SCHEMA,
            outputMode="Append", timeMode="None", initialState=seed_df.groupBy("word"))
    if buckets == -1:
        buckets = default_buckets(spark)
    lists = tokenize(texts, lists=True).select(
        F.col("doc_id").cast("bigint"), WORDS,
        F.transform(WORDS, lambda word: key_bucket(word, buckets)).alias(BUCKETS))
    seeds = seed_df.withColumn("bucket", key_bucket("word", buckets))
    return (lists.mapInArrow(pack_batches("doc_id", buckets), PACKED_SCHEMA).groupBy("bucket")
            .transformWithStateInPandas(
                statefulProcessor=PackedWordCountProcessor(), outputStructType=WORDS_SCHEMA,
                outputMode="Append", timeMode="None", initialState=seeds.groupBy("bucket")))


def start_sensor_queries(spark: SparkSession, records: DataFrame, out_dir: str, *,
                         literal: bool = False, trigger: str | None = None,
                         available_now: bool = False, checkpoint: str | None = None,
                         alert_threshold: int | None = None) -> dict[str, StreamingQuery]:
    """The sensor program over a stream of keyed records: the raw record log
    (partitioned by trial), the running summary of every record, and (with a
    threshold) the log of alerts.  Totals per key are fed to their store, see
    ``feed_totals``."""
    _prepare(spark)
    base = checkpoint or f"{out_dir}/_ckpt"
    how = {"trigger": None if available_now else trigger, "available_now": available_now}
    queries = {
        "records": sink(records, f"{out_dir}/records", f"{base}/records",
                        partition_by=("trial_id",), **how),
        "summary": sink(running_summary_stream(records, literal), f"{out_dir}/summary",
                        f"{base}/summary", **how),
    }
    if alert_threshold is not None:
        queries["alerts"] = sink(flag_alerts(records, alert_threshold), f"{out_dir}/alerts",
                                 f"{base}/alerts", **how)
    return queries


def start_from_config(spark: SparkSession, cfg, out_dir: str, *,
                      available_now: bool = False) -> dict[str, StreamingQuery]:
    """Start the sensor program as configured (folder or socket source,
    separator, filters, base value, key columns, alerts, trigger)."""
    return start_sensor_queries(spark, configured_records(spark, cfg), out_dir, trigger=cfg.trigger,
                                available_now=available_now, checkpoint=cfg.checkpoint,
                                alert_threshold=cfg.alert_threshold)


def configured_records(spark: SparkSession, cfg) -> DataFrame:
    """The keyed record stream of a configuration."""
    mode = "socket" if cfg.source == "socket" else "stream"
    lines = read_lines(spark, cfg.path, mode=mode, host=cfg.host, port=cfg.port,
                       max_files_per_trigger=cfg.max_files_per_trigger,
                       max_bytes_per_trigger=cfg.max_bytes_per_trigger)
    lines = filter_fields(filter_lines(lines, cfg.filter_terms), cfg.field_terms, cfg.separator)
    return add_key(parse_trial(lines, sep=cfg.separator, base=cfg.base_value), cfg.key_columns)


#: Tokens are written in order of word, text and position: as differences their
#: columns take about half as much as with dictionaries.  The sink has no option
#: for that, it takes over what the session has when the query starts.
AS_DIFFERENCES = {"parquet.writer.version": "v2", "parquet.enable.dictionary": "false"}


#: Texts go to the tasks' Python in batches of at most so much.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}
#: All state stores of an executor share so much memory.
STORE_MEMORY = {"spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
                "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128"}


def start_word_count(spark: SparkSession, texts: DataFrame, out_dir: str, *,
                     seed=DEFAULT_WORD_SEED, trigger: str | None = None,
                     available_now: bool = False) -> StreamingQuery:
    _prepare(spark)
    with settings(spark, AS_DIFFERENCES | SMALL_BATCHES | STORE_MEMORY):
        return sink(word_count_stream(texts, seed), f"{out_dir}/words", f"{out_dir}/_ckpt/words",
                    trigger=trigger, available_now=available_now, codec="zstd")


def await_all(queries, timeout_s: float | None = None) -> None:
    """Wait for ``availableNow`` queries to finish; raise on failure.  Without
    a time limit they run as long as their input needs."""
    for q in (queries.values() if isinstance(queries, dict) else queries):
        if timeout_s is None:
            q.awaitTermination()
        elif not q.awaitTermination(timeout_s):
            q.stop()
            raise TimeoutError(f"streaming query {q.name or q.id} did not finish")
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
