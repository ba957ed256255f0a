"""Reports from stored partial summaries.

A store of summaries holds, for chosen groupings of records, one row of
partial figures for each group and batch.  Only the finest grouping reads the
records; each coarser one is made from the smallest that has its columns.  A
report with any grouping and filters is answered by the smallest stored
grouping that has all columns it names, and falls back to the records if none
does.  A batch is its own folder in each grouping, written anew if a job is
repeated, so a batch counts once.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseline.operators.report import report, where_equal

DIMENSIONS = ("trial_id", "patient_id", "visit_name", "device", "start_date")
FIGURES = ["n_records", "sum_value", "min_value", "max_value", "sum_variance", "min_variance",
           "max_variance", "sum_percentage"]


def _of_records() -> list[Column]:
    out = [F.count(F.lit(1)).alias("n_records"), F.sum(F.col("percentage").cast("double")).alias("sum_percentage")]
    for c in ("value", "variance"):
        out += [F.sum(F.col(c).cast("bigint")).alias(f"sum_{c}"), F.min(c).alias(f"min_{c}"),
                F.max(c).alias(f"max_{c}")]
    return out


def _of_figures() -> list[Column]:
    how = {"n": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
    return [how[c.split("_")[0]](c).alias(c) for c in FIGURES]


def _finished(figures: DataFrame, group_by) -> DataFrame:
    n = F.col("n_records")
    return figures.select(
        *group_by, "n_records", "min_value", "max_value", (F.col("sum_value").cast("double") / n).alias("avg_value"),
        "min_variance", "max_variance", (F.col("sum_variance").cast("double") / n).alias("avg_variance"),
        (F.col("sum_percentage") / n).alias("avg_percentage"))


@dataclass
class SummaryStore:
    """``groupings``: tuples of columns, of which one has those of all others."""

    spark: SparkSession
    path: str
    groupings: tuple[tuple[str, ...], ...]

    def __post_init__(self) -> None:
        self.groupings = tuple(sorted((tuple(sorted(g)) for g in self.groupings), key=lambda g: (-len(g), g)))
        finest = set(self.groupings[0])
        if any(not set(g) <= finest for g in self.groupings):
            raise ValueError("one grouping must have the columns of all others")

    def _folder(self, grouping: tuple[str, ...]) -> str:
        return f"{self.path}/{'+'.join(grouping) or 'all'}"

    def append(self, records: DataFrame, batch: int) -> None:
        """Add (or write again) a batch of records."""
        made: list[tuple[str, ...]] = []
        for g in self.groupings:
            if not made:
                rows = records.groupBy(*g).agg(*_of_records())
            else:
                wider = min((w for w in made if set(g) <= set(w)), key=lambda w: self._rows(w, batch))
                rows = self._batch(wider, batch).groupBy(*g).agg(*_of_figures())
            rows.select(*g, *FIGURES).write.mode("overwrite").parquet(f"{self._folder(g)}/batch={batch}")
            made.append(g)

    def _batch(self, grouping, batch: int) -> DataFrame:
        return self.spark.read.parquet(f"{self._folder(grouping)}/batch={batch}")

    def _rows(self, grouping, batch: int | None = None) -> int:
        """Rows of a grouping, from the file footers."""
        rows = self._batch(grouping, batch) if batch is not None else self.spark.read.parquet(self._folder(grouping))
        return rows.count()

    def choose(self, columns) -> tuple[str, ...] | None:
        """The smallest stored grouping that has these columns."""
        fit = [g for g in self.groupings if set(columns) <= set(g)]
        return min(fit, key=lambda g: (self._rows(g), g)) if fit else None

    def report(self, group_by=("patient_id",), filters: dict | None = None,
               records: DataFrame | None = None) -> DataFrame:
        """The rows of ``operators.report.report`` over all batches; without a
        grouping that has the columns, from ``records``."""
        filters = filters or {}
        grouping = self.choose({*group_by, *filters})
        if grouping is None:
            if records is None:
                raise ValueError(f"no summary has {json.dumps(sorted({*group_by, *filters}))}")
            return report(records, group_by, filters)
        rows = where_equal(self.spark.read.parquet(self._folder(grouping)), filters)
        return _finished(rows.groupBy(*group_by).agg(*_of_figures()), group_by)
