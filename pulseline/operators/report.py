"""Reports over trial records: patient report, attribute filters/groupings,
latest record per key, alert flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseline.config import DEFAULT_ALERT_THRESHOLD


def where_equal(rows: DataFrame, filters: dict | None) -> DataFrame:
    """Rows whose columns equal a value or are one of several."""
    for col, val in (filters or {}).items():
        rows = rows.filter(F.col(col).isin(*val) if isinstance(val, (list, tuple, set))
                           else F.col(col) == val)
    return rows


def report(records: DataFrame, group_by=("patient_id",), filters: dict | None = None) -> DataFrame:
    """Heart-rate figures per chosen attributes, after equality filters.

    "variance" is the difference from the base value (not statistical
    variance); ``percentage`` is that difference in percent of the base.
    """
    df = where_equal(records, filters)
    n = F.count(F.lit(1))
    return df.groupBy(*group_by).agg(
        n.alias("n_records"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        (F.sum("value").cast("double") / n).alias("avg_value"),
        F.min("variance").alias("min_variance"),
        F.max("variance").alias("max_variance"),
        (F.sum("variance").cast("double") / n).alias("avg_variance"),
        (F.sum(F.col("percentage").cast("double")) / n).alias("avg_percentage"),
    )


def patient_report(records: DataFrame) -> DataFrame:
    """Min, max, average heart rate and variance figures per patient."""
    return report(records, group_by=("patient_id",))


def latest_by_key(records: DataFrame, key: str = "record_key",
                  order=("start_ts", "seq")) -> DataFrame:
    """The latest record per key (the document a keyed upsert would leave).

    One ``max_by`` aggregation: partial per map task, so a hot key costs
    one candidate row per task, never a sort of the whole key.
    """
    others = [c for c in records.columns if c != key]
    best = F.max_by(F.struct(*[F.col(c) for c in others]),
                    F.struct(*[F.col(c) for c in order]))
    return records.groupBy(key).agg(best.alias("_r")).select(key, "_r.*")


def flag_alerts(records: DataFrame, threshold: int = DEFAULT_ALERT_THRESHOLD) -> DataFrame:
    """Records whose difference from the base exceeds the threshold."""
    return records.filter(F.abs(F.col("variance")) > F.lit(threshold)).withColumn(
        "alert", F.when(F.col("variance") > 0, F.lit("high")).otherwise(F.lit("low")))
