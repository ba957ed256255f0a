"""Sinks: keyed documents, a bounded print."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseline.operators.records import TRIAL_COLUMNS


def to_documents(df: DataFrame, key: str = "record_key", fields=TRIAL_COLUMNS) -> DataFrame:
    """``(doc_id, doc)``: each row as a JSON document under its key, ready for
    any external document store (a later document with the same id replaces
    the earlier one there)."""
    return df.select(F.col(key).alias("doc_id"),
                     F.to_json(F.struct(*[F.col(c) for c in fields])).alias("doc"))


def print_rows(df: DataFrame, n: int = 10, write=print) -> int:
    """Print the first ``n`` rows and whether there are more; returns how many
    were printed.  Only these rows reach the driver."""
    rows = df.limit(n + 1).collect()
    for r in rows[:n]:
        write(" ".join(str(x) for x in r))
    if len(rows) > n:
        write("...")
    return min(len(rows), n)
