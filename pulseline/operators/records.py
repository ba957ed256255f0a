"""Line filter, record parse, composite key and rejects.

All steps are narrow projections/filters: they pipeline into the scan in one
whole-stage-codegen span and work unchanged on streaming DataFrames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from pulseline.config import DEFAULT_BASE_VALUE, DEFAULT_FILTER_TERMS, DEFAULT_KEY_COLUMNS
from pulseline.functions import fields as fx
from pulseline.session import scratch_path

TRIAL_COLUMNS = [
    "variance", "percentage", "trial_id", "patient_id", "visit_name", "value",
    "device", "start_date", "start_time", "end_date", "end_time",
]
# columns carried beside the record: order key and raw line
ORDER_COLUMNS = ["start_ts", "seq"]


def filter_lines(lines: DataFrame, terms=DEFAULT_FILTER_TERMS, line_col: str = "value") -> DataFrame:
    """Keep lines that contain every term (case-sensitive substring tests)."""
    return lines.filter(fx.contains_all(F.col(line_col), terms))


def filter_fields(lines: DataFrame, terms: dict[int, str], sep: str = "|",
                  line_col: str = "value") -> DataFrame:
    """Keep lines whose fields (by number, from 0) equal the given texts."""
    split = fx.split_fields(F.col(line_col), sep)
    for i, text in terms.items():
        lines = lines.filter(F.get(split, i) == text)
    return lines


def parse_lines(lines: DataFrame, sep: str = "|", base: int = DEFAULT_BASE_VALUE,
                line_col: str = "value", carry=()) -> DataFrame:
    """Every line, good or bad: ``raw``, the record's columns and ``reason``,
    the first check that fails (NULL for a good line); ``carry`` names columns
    of ``lines`` to keep beside."""
    # the split array is its own projection, referenced by every field
    split = lines.select(F.col(line_col).alias("raw"), *carry,
                         fx.split_fields(F.col(line_col), sep).alias("_f"))
    f = F.col("_f")

    def fld(i: int):
        return fx.field(f, i)

    step1 = split.select(
        "raw", *carry,
        F.size(f).alias("_n"),
        fld(fx.FIELD_TRIAL).alias("trial_id"),
        fld(fx.FIELD_PATIENT).alias("patient_id"),
        fld(fx.FIELD_VISIT).alias("visit_name"),
        fld(fx.FIELD_RESULT).alias("_result"),
        fld(fx.FIELD_DEVICE).alias("device"),
        fld(fx.FIELD_START_DATE).alias("_sd"),
        fld(fx.FIELD_START_TIME).alias("_st"),
        fld(fx.FIELD_END_DATE).alias("_ed"),
        fld(fx.FIELD_END_TIME).alias("_et"),
        fld(fx.FIELD_EPISODE).alias("_seq"),
    )
    b = int(base)
    if b == 0:
        raise ValueError("the base value must not be 0")
    # in BIGINT, so that no value can overflow; one whose difference from the
    # base does not fit INT is rejected like any other bad number
    wide = F.col("_result").try_cast("bigint")
    variance = F.try_subtract(wide, F.lit(b).cast("bigint"))
    value = F.when(variance.try_cast("int").isNotNull(), wide.try_cast("int"))
    step2 = step1.select(
        "*",
        value.alias("value"),
        fx.parse_date(F.col("_sd")).alias("start_date"),
        fx.parse_hhmmss(F.col("_st")).alias("start_time"),
        fx.parse_date(F.col("_ed")).alias("end_date"),
        fx.parse_hhmmss(F.col("_et")).alias("end_time"),
        F.col("_seq").try_cast("bigint").alias("seq"),
    )
    reason = (
        F.when(F.col("_n") < fx.N_FIELDS, F.lit("short_line"))
        .when(F.col("trial_id").isNull() | F.col("patient_id").isNull()
              | F.col("visit_name").isNull(), F.lit("missing_key"))
        .when(F.col("value").isNull(), F.lit("bad_int:result"))
        .when(F.col("start_date").isNull(), F.lit("bad_date:start_date"))
        .when(F.col("_st").isNotNull() & F.col("start_time").isNull(), F.lit("bad_time:start_time"))
        .when(F.col("_ed").isNotNull() & F.col("end_date").isNull(), F.lit("bad_date:end_date"))
        .when(F.col("_et").isNotNull() & F.col("end_time").isNull(), F.lit("bad_time:end_time"))
    )
    # The parsed row is emitted as one generated row (inline of a one-row
    # array).  The reject filter on ``reason`` then reads computed columns;
    # on a plain projection Catalyst would push it below, inlining the split
    # and every parse into the predicate and computing them twice.
    return step2.select(F.inline(F.array(F.struct(
        F.col("raw"), *carry,
        F.expr(f"cast(cast(value as bigint) - {b} as int)").alias("variance"),
        # integer division (toward zero) first, then widened to FLOAT
        F.expr(f"cast(((cast(value as bigint) - {b}) * 100) div {b} as float)").alias("percentage"),
        "trial_id", "patient_id", "visit_name", "value", "device",
        "start_date", "start_time", "end_date", "end_time",
        fx.stamp(F.col("start_date"), F.col("start_time")).alias("start_ts"),
        "seq",
        reason.alias("reason"),
    ))))


def parse_trial(lines: DataFrame, sep: str = "|", base: int = DEFAULT_BASE_VALUE,
                on_error: str = "reject", line_col: str = "value",
                keep_raw: bool = False) -> DataFrame:
    """Lines -> typed trial records (variance, percentage, ids, value, device,
    start/end date and packed time) plus ``start_ts``/``seq`` for ordering.

    ``on_error="reject"`` drops lines that do not parse (see ``rejects``);
    ``on_error="fail"`` raises on the first such line, like a strict cast.
    """
    p = parse_lines(lines, sep, base, line_col)
    if on_error == "fail":
        p = p.withColumn(
            "reason", F.when(F.col("reason").isNotNull(),
                             F.raise_error(F.concat(F.lit("unparsable line ("), F.col("reason"),
                                                    F.lit("): "), F.col("raw"))))
            .otherwise(F.col("reason")))
    elif on_error != "reject":
        raise ValueError("on_error must be 'reject' or 'fail'")
    good = p.filter(F.col("reason").isNull())
    cols = TRIAL_COLUMNS + ORDER_COLUMNS + (["raw"] if keep_raw else [])
    return good.select(*cols)


def rejects(lines: DataFrame, sep: str = "|", base: int = DEFAULT_BASE_VALUE,
            line_col: str = "value") -> DataFrame:
    """Lines that do not parse, with the first failing check as ``reason``."""
    return (parse_lines(lines, sep, base, line_col)
            .filter(F.col("reason").isNotNull()).select("raw", "reason"))


REASONS = ("short_line", "missing_key", "bad_int:result", "bad_date:start_date", "bad_time:start_time",
           "bad_date:end_date", "bad_time:end_time")


def line_counts(reason=None) -> list:
    """read, kept and the rejected by reason, as aggregates to observe in the
    pass that parses."""
    reason = F.col("reason") if reason is None else reason
    return [F.count(F.lit(1)).alias("read"), F.count_if(reason.isNull()).alias("kept"),
            *(F.count_if(reason == r).alias(r) for r in REASONS)]


def parse_counted(lines: DataFrame, sep: str = "|", base: int = DEFAULT_BASE_VALUE,
                  line_col: str = "value") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, rejects, counts) from one pass over the lines: both kinds are
    written as it goes, and ``counts`` (what, n) is what it has seen."""
    spark = lines.sparkSession
    seen = Observation()
    parsed = parse_lines(lines, sep, base, line_col).observe(seen, *line_counts())
    path = scratch_path(spark, "parsed")
    parsed.withColumn("_bad", F.col("reason").isNotNull()).write.partitionBy("_bad").parquet(path)
    rows = spark.read.schema(parsed.schema.add("_bad", BooleanType())).parquet(path)
    counts = spark.createDataFrame([(k, int(v)) for k, v in seen.get.items()], "what STRING, n BIGINT")
    return (rows.where(~F.col("_bad")).select(*TRIAL_COLUMNS, *ORDER_COLUMNS),
            rows.where("_bad").select("raw", "reason"), counts)


def add_key(records: DataFrame, key_cols=DEFAULT_KEY_COLUMNS, sep: str = "_",
            name: str = "record_key") -> DataFrame:
    """Composite document key, e.g. ``trial_patient_visit`` (parts non-null
    after ``parse_trial``; add ``device`` for the per-device variant)."""
    return records.withColumn(name, F.concat_ws(sep, *[F.col(c) for c in key_cols]))


def trial_records(lines: DataFrame, terms=DEFAULT_FILTER_TERMS, sep: str = "|",
                  base: int = DEFAULT_BASE_VALUE, key_cols=DEFAULT_KEY_COLUMNS) -> DataFrame:
    """filter -> parse -> key: the keyed record stream of the sensor program."""
    return add_key(parse_trial(filter_lines(lines, terms), sep=sep, base=base), key_cols)
