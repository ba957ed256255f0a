"""Line sources: bounded and streaming reads of device lines, and a renderer
that derives device lines from the ``events`` table (the test/bench input).

Every reader returns a DataFrame with one ``value STRING`` column, the shape
of Spark's text source, so the same parse code serves batch and stream.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseline.session import scratch_path


def read_lines(spark: SparkSession, path: str | None = None, *, mode: str = "batch",
               host: str = "localhost", port: int = 9999,
               max_files_per_trigger: int | None = None,
               max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Device lines from a folder (``batch`` / ``stream``) or a socket.

    ``stream`` is the folder-watching source: new files are picked up per
    trigger, so many files or else so many bytes a batch.  ``socket``
    reads newline-delimited text from host:port (development only; it holds
    no offsets and cannot recover).
    """
    if mode == "batch":
        return spark.read.text(path)
    if mode == "stream":
        r = spark.readStream.format("text")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        elif max_bytes_per_trigger:
            r = r.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
        return r.load(path)
    if mode == "socket":
        return (spark.readStream.format("socket")
                .option("host", host).option("port", str(port)).load())
    raise ValueError(f"unknown mode {mode!r}")


def _upper_date(ts: Column) -> Column:
    return F.upper(F.date_format(ts, "ddMMMyyyy"))


def _hms(ts: Column) -> Column:
    return F.date_format(ts, "HHmmss")


# How each event type is rendered as a device line
# (record class, category, test name).
EVENT_LAYOUT = {
    "view": ("MEASUREMENT", "HR DAILY", "SUMMARY (MEAN) HEART RATE"),
    "click": ("MEASUREMENT", "HR DAILY", "SUMMARY (MAX) HEART RATE"),
    "purchase": ("MEASUREMENT", "HR DAILY", "SUMMARY (MIN) HEART RATE"),
    "error": ("MEASUREMENT", "SYSTEM TRIGGERED MEASUREMENT", "SUMMARY (MEAN) HEART RATE"),
    "signup": ("FINDING", "SYSTEM TRIGGERED MEASUREMENT", "RHYTHM"),
}
WITH_END = ("view", "click", "purchase")


def _event_parts(events: DataFrame) -> DataFrame:
    """Per-row pieces used more than once (dates, times, ids), computed once."""
    ts = F.col("ts")
    nxt = F.timestamp_add("DAY", F.lit(1), ts)
    et = F.col("event_type")

    def by_type(i: int) -> Column:
        c = None
        for name, layout in EVENT_LAYOUT.items():
            c = (F.when(et == name, F.lit(layout[i])) if c is None
                 else c.when(et == name, F.lit(layout[i])))
        return c.otherwise(F.lit(""))

    return events.select(
        "*",
        _upper_date(ts).alias("_d0"), _hms(ts).alias("_t0"),
        _upper_date(nxt).alias("_d1"), _hms(nxt).alias("_t1"),
        (et == "signup").alias("_signup"), et.isin(*WITH_END).alias("_with_end"),
        by_type(0).alias("_class"), by_type(1).alias("_category"), by_type(2).alias("_test"))


def event_line_fields() -> list[Column]:
    """The 27 field expressions of a rendered line (over ``_event_parts``)."""
    signup, with_end = F.col("_signup"), F.col("_with_end")
    uid = F.col("user_id")
    return [
        F.concat(F.lit("TR-00"), (uid % 3).cast("string")),
        F.lpad(uid.cast("string"), 9, "0"),
        F.lit(""),
        F.when(uid % 2 == 0, F.lit("M")).otherwise(F.lit("F")),
        F.concat(F.lit("S0"), (1 + F.col("event_id") % 3).cast("string")),
        F.col("_d0"), F.col("_t0"), F.col("_d1"), F.col("_t1"),
        F.col("_class"), F.col("_category"), F.col("_test"),
        F.when(signup, F.lit("Sinus Rhythm")).otherwise(
            F.floor(F.col("value")).cast("int").cast("string")),
        F.when(signup, F.lit("SINUS RHYTHM")).otherwise(F.lit("")),
        F.when(signup, F.lit("")).otherwise(F.lit("BEATS/MIN")),
        F.lit("1"),
        F.concat(F.lit("DEV"), F.lpad((uid % 7).cast("string"), 4, "0")),
        F.lit(""), F.lit(""), F.lit(""), F.lit(""), F.lit(""),
        F.col("event_id").cast("string"),
        F.col("_d0"), F.col("_t0"),
        F.when(with_end, F.col("_d1")).otherwise(F.lit("")),
        F.when(with_end, F.col("_t1")).otherwise(F.lit("")),
    ]


# Faults for lines whose event number leaves the given rest on
# division by FAULT_EVERY; (field, text), or None for a line cut after 5 fields.
FAULT_EVERY = 17
LINE_FAULTS = {
    0: None, 1: (0, ""), 2: (12, "n/a"), 3: (12, "99999999999"), 4: (23, "31FEB2024"),
    5: (24, "256161"), 6: (25, "yesterday"), 7: (26, "120060"), 8: (12, "-2147483640"),
    9: (24, ""),
}


def render_event_lines(events: DataFrame, sep: str = "|", keep=(), faults=None) -> DataFrame:
    """One device line per ``events`` row (a narrow projection, no shuffle);
    ``keep`` names event columns to carry beside the line, ``faults`` spoils
    some lines (see ``LINE_FAULTS``)."""
    parts = [F.coalesce(c, F.lit("")) for c in event_line_fields()]
    rest = F.col("event_id") % FAULT_EVERY
    for r, fault in (faults or {}).items():
        if fault is not None:
            at, text = fault
            parts[at] = F.when(rest == r, F.lit(text)).otherwise(parts[at])
    line = F.concat_ws(sep, *parts)
    for r, fault in (faults or {}).items():
        if fault is None:
            line = F.when(rest == r, F.concat_ws(sep, *parts[:5])).otherwise(line)
    # A one-element explode makes the line a generated column: predicates on
    # it (the category filter) then run on the built line instead of being
    # pushed below and re-inlining the 27-field rendering per predicate.
    return _event_parts(events).select(
        *keep, F.explode(F.array(line)).alias("value"))


def load_event_lines(spark: SparkSession, sf_dir: str, sep: str = "|", faults=None) -> DataFrame:
    return render_event_lines(spark.read.parquet(f"{sf_dir}/events.parquet"), sep, faults=faults)


def file_statuses(table: DataFrame) -> list[tuple]:
    """Name and status of each file that a table is read from."""
    spark = table.sparkSession
    out = []
    for name in sorted(table.inputFiles()):
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        out.append((name, path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)))
    return out


def move_files(table: DataFrame, folder: str, prefix: str) -> list[str]:
    """Move the files that a table is read from into a folder, their names
    with a prefix; returns where they are now."""
    spark = table.sparkSession
    to = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = to.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(to)
    moved = []
    for _, status in file_statuses(table):
        moved.append(f"{folder}/{prefix}{status.getPath().getName()}")
        if not fs.rename(status.getPath(), spark._jvm.org.apache.hadoop.fs.Path(moved[-1])):
            raise RuntimeError(f"{status.getPath()} could not be moved to {folder}")
    return moved


def delete_files(spark: SparkSession, names: list[str]) -> None:
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)


TASK_BYTES = 2 << 20  # of a slice's input files, about, in one task


def ordered_slices(df: DataFrame, order_value: Column, n_slices: int,
                   task_bytes: int = TASK_BYTES) -> Iterator[DataFrame]:
    """Consecutive ranges of ``order_value`` with about equally many rows, in
    order, however ``df`` is laid out in files.  Rows of one value share a
    slice.  ``df`` is written once, a folder for each slice, so reading all
    slices reads it once more.  A slice is itself cut into ranges of about
    ``task_bytes`` of the input files, so no task takes more as these grow."""
    spark = df.sparkSession
    size = sum(s.getLen() for _, s in file_statuses(df))
    parts = max(1, -(-size // (n_slices * task_bytes)))
    dealt = df.withColumn("_v", order_value).repartitionByRange(n_slices * parts, "_v")
    path = scratch_path(spark, "slices")
    of = F.floor(F.spark_partition_id() / parts).cast("int")
    dealt.withColumn("_slice", of).drop("_v").write.partitionBy("_slice").parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [s.getPath().getName() for s in found]
    for i in sorted(int(x.split("=")[1]) for x in names if x.startswith("_slice=")):
        yield spark.read.schema(df.schema).parquet(f"{path}/_slice={i}")
