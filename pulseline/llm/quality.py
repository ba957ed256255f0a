"""Quality rules: base counts and robust multivariate outliers, native.

Every text gives a vector of transformed statistics.  Per language and source
a minimum-covariance-determinant estimate of centre and scatter is found by
concentration steps: start from the coordinate-wise median and spread, take
the ``SHARE`` of documents with the smallest Mahalanobis distances, take their
mean and covariance, repeat.  A document is rejected if its distance under the
last estimate exceeds the chi-squared quantile at ``TAIL``.

All steps are partial aggregates over a narrow table of statistics, joined
with one row per group, so a source with a third of all rows is no heavier for
any task than the others.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseline.llm.common import SPACES, split_words, table
from pulseline.session import materialize

SHARE = 0.75
STEPS = 3
#: One clean document in a million is given up.
TAIL = 1e-6
MIN_GROUP = 100
FEW_GROUPS = 20_000  # one row per group: about 10 MB in all
#: Statistics and the least standard deviation that each is taken to have (an estimate
#: above it stays as it is): most clean texts have no symbol or repeated line at all,
#: and a spread of 0 would reject any.
FEATURES = {"f_symbols": 0.5, "f_marks": 0.3, "f_upper": 0.3, "f_repeats": 0.8, "f_lines": 0.8,
            "f_length": 0.1}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
GROUP = ["g_lang", "g_source"]
SHARED = "\u0000"  # names the estimate of groups that are too small for their own


def _n(text: Column, chars: str) -> Column:
    """Characters of a class in a text."""
    return F.length(text) - F.length(F.regexp_replace(text, f"{chars}+", ""))


def quality_stats(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                  source_col: str = "source", keep: list[Column] | None = None) -> DataFrame:
    """``keep`` columns, the base counts, the features and the group of each
    row.  A null text has no words, a null language or source is a group of
    its own (named by the empty string)."""
    keep = keep or []
    name = [f"k{i}" for i in range(len(keep))]
    d = docs.select(
        *(c.alias(n) for c, n in zip(keep, name)),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("x"),
        F.coalesce(docs[lang_col].cast("string"), F.lit("")).alias("g_lang"),
        F.coalesce(docs[source_col].cast("string"), F.lit("")).alias("g_source"))
    d = d.select(*name, *GROUP, "x", split_words(F.col("x"), SPACES).alias("w"),
                 F.filter(F.split("x", "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    grams = F.arrays_zip(*(F.slice("w", i, F.greatest(F.size("w") - 2, F.lit(0))).alias(f"w{i}")
                           for i in (1, 2, 3)))
    d = d.select(
        *name, *GROUP, "lines", F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        _n(F.col("x"), "[#*$%&|<>]").cast("long").alias("n_symbols"),
        _n(F.col("x"), r"\p{Lu}").alias("upper"),
        _n(F.col("x"), r"[!-/:-@\[-`{-~]").alias("marks"),
        F.transform(grams, lambda z: F.xxhash64(z["w1"], z["w2"], z["w3"])).alias("h"))
    # only texts with a repeated window are sorted; equal windows are then neighbours
    again = F.size(F.array_distinct("h")) < F.size("h")
    d = d.select(
        *name, *GROUP, "n_words", "word_chars", "n_symbols", "upper", "marks",
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(again, F.sort_array(F.transform("h", lambda x, i: F.struct(
            x.alias("x"), i.alias("i"))))).alias("s"))
    none = F.array().cast("array<int>")
    same = F.flatten(F.zip_with(
        "s", F.slice("s", 2, F.size("s")),
        lambda a, b: F.when(a["x"] == b["x"], F.array(a["i"], b["i"])).otherwise(none)))
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        F.array_distinct(same), lambda i: F.array(i, i + 1, i + 2)))))
    d = d.withColumn("n_repeat_words",
                     F.when(F.col("s").isNull(), 0).otherwise(covered).cast("long"))

    def percent(a: str, b: str) -> Column:
        return F.log1p(100.0 * F.col(a) / F.greatest(F.col(b), F.lit(1)))

    # as one generated row: a filter on the result then reads these columns, where on
    # a plain projection it would be pushed down with all that they are computed from
    return d.select(F.inline(F.array(F.struct(
        *(F.col(n) for n in name), *GROUP, *COUNTS,
        percent("n_symbols", "word_chars").alias("f_symbols"),
        percent("marks", "word_chars").alias("f_marks"),
        percent("upper", "word_chars").alias("f_upper"),
        percent("n_repeat_words", "n_words").alias("f_repeats"),
        percent("n_dup_lines", "n_lines").alias("f_lines"),
        F.log1p(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))).alias("f_length")))))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _chi2(p: int, q: float) -> float:
    """Chi-squared quantile (Wilson and Hilferty)."""
    return p * (1 - 2 / (9 * p) + NormalDist().inv_cdf(q) * (2 / (9 * p)) ** 0.5) ** 3


# The algebra below is written as SQL text: thousands of column calls would take the
# driver longer than the work takes the cluster.

def _distance() -> Column:
    """Squared length of W (x - m); W is the inverse Cholesky factor."""
    f = list(FEATURES)
    rows = [" + ".join(f"w_{i}_{j} * ({f[j]} - m_{j})" for j in range(i + 1)) for i in range(len(f))]
    return F.expr(" + ".join(f"({r}) * ({r})" for r in rows))


def _by_group(rows: DataFrame, groups: DataFrame, n_groups: int, how: str = "inner") -> DataFrame:
    """Rows with what is known of their group: sent to all tasks if there are
    few groups, so that a large group's rows stay where they are, and else
    joined by a shuffle."""
    small = F.broadcast(groups) if n_groups <= FEW_GROUPS else groups
    return rows.join(small, GROUP, how)


def _whiten(d: DataFrame) -> DataFrame:
    """Columns c_i_j (scatter, j <= i) to w_i_j, the inverse of its Cholesky
    factor; one row per group.  One projection for each column of the factor
    and each row of the inverse."""
    p = len(FEATURES)
    for j in range(p):
        rest = {i: " - ".join([f"c_{i}_{j}", *(f"l_{i}_{k} * l_{j}_{k}" for k in range(j))])
                for i in range(j, p)}
        d = d.withColumn(f"l_{j}_{j}", F.expr(f"sqrt(greatest({rest[j]}, 1e-12D))"))
        d = d.withColumns({f"l_{i}_{j}": F.expr(f"({rest[i]}) / l_{j}_{j}") for i in range(j + 1, p)})
    for i in range(p):
        inner = {j: " + ".join(f"l_{i}_{k} * w_{k}_{j}" for k in range(j, i)) for j in range(i)}
        d = d.withColumns({f"w_{i}_{j}": F.expr(f"-({inner[j]}) / l_{i}_{i}" if j < i else f"1 / l_{i}_{i}")
                           for j in range(i + 1)})
    return d.select(*GROUP, *(f"m_{j}" for j in range(p)),
                    *(f"w_{i}_{j}" for i in range(p) for j in range(i + 1)))


def _start(stats: DataFrame) -> DataFrame:
    """Median and spread (from the 10 and 90 % points) of each feature."""
    f, floor = list(FEATURES), list(FEATURES.values())
    width = 2 * NormalDist().inv_cdf(0.9)
    q = stats.groupBy(*GROUP).agg(*(
        F.expr(f"percentile_approx({c}, array(0.1, 0.5, 0.9), 2000) AS q_{i}") for i, c in enumerate(f)))
    return _whiten(q.selectExpr(
        *GROUP, *(f"q_{i}[1] AS m_{i}" for i in range(len(f))),
        *(f"greatest(pow((q_{i}[2] - q_{i}[0]) / {width}, 2), {floor[i] ** 2}D) AS c_{i}_{i}" if i == j
          else f"0.0D AS c_{i}_{j}" for i in range(len(f)) for j in range(i + 1))))


def _step(stats: DataFrame, now: DataFrame, n_groups: int) -> DataFrame:
    """One concentration step."""
    f, floor = list(FEATURES), list(FEATURES.values())
    far = _by_group(stats, now, n_groups).select(*GROUP, *f, _distance().alias("d2"))
    edge = far.groupBy(*GROUP).agg(F.percentile_approx("d2", SHARE, 2000).alias("edge"))
    near = _by_group(far, edge, n_groups).where("d2 <= edge")
    p = len(f)
    sums = near.groupBy(*GROUP).agg(
        *(F.expr(f"avg({c}) AS m_{i}") for i, c in enumerate(f)),
        *(F.expr(f"covar_pop({f[i]}, {f[j]}) AS v_{i}_{j}") for i in range(p) for j in range(i + 1)))
    # the nearest SHARE of normal data have less scatter than all: the factor of consistency
    grow = SHARE / _chi2_share(p + 2, _chi2(p, SHARE))
    return _whiten(sums.selectExpr(
        *GROUP, *(f"m_{i}" for i in range(p)),
        *(f"greatest(v_{i}_{j} * {grow}, {floor[i] ** 2}D) AS c_{i}_{j}" if i == j
          else f"v_{i}_{j} * {grow} AS c_{i}_{j}" for i in range(p) for j in range(i + 1))))


def _chi2_share(p: int, x: float) -> float:
    return NormalDist().cdf(((x / p) ** (1 / 3) - 1 + 2 / (9 * p)) / (2 / (9 * p)) ** 0.5)


def fit_quality(stats: DataFrame, steps: int = STEPS, min_group: int = MIN_GROUP) -> DataFrame:
    """One row of estimates for each (language, source) with a row that
    passes the base rules.  Groups with fewer than ``min_group`` such rows
    share one estimate per language, and languages that are small even so one
    estimate of all.  ``stats`` is read several times and should be a written
    table.  Each step's estimates, one row per group, are written too, which
    keeps the plans short."""
    good = stats.where(~base_failed()).select(*GROUP, *FEATURES)
    n = good.groupBy(*GROUP).count()
    rest = n.where(F.col("count") < min_group).groupBy("g_lang").agg(F.sum("count").alias("rest"))
    big, some = F.col("count") >= min_group, F.col("rest") >= min_group
    to = materialize(n.join(rest, "g_lang", "left").select(
        *GROUP, F.when(big | some, F.col("g_lang")).otherwise(SHARED).alias("t_lang"),
        F.when(big, F.col("g_source")).otherwise(SHARED).alias("t_source")), "groups")
    n_groups = to.count()
    good = _by_group(good, to, n_groups).select(F.col("t_lang").alias("g_lang"),
                                       F.col("t_source").alias("g_source"), *FEATURES)
    now = materialize(_start(good), "mcd")
    for _ in range(steps):
        now = materialize(_step(good, now, n_groups), "mcd")
    return to.join(now.withColumnsRenamed({"g_lang": "t_lang", "g_source": "t_source"}),
                   ["t_lang", "t_source"]).drop("t_lang", "t_source")


def judge(stats: DataFrame, estimates: DataFrame, tail: float = TAIL) -> DataFrame:
    """``stats`` with base_failed, distance (squared) and kept."""
    cut = _chi2(len(FEATURES), 1 - tail)
    d = _by_group(stats, estimates, estimates.count(), "left").withColumn("distance", _distance())
    return d.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= cut))


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", **columns: str) -> DataFrame:
    """doc_id, the base counts, base_failed, distance and kept of each row.

    Null, empty and word-less texts fail the base rules; null languages and
    sources are groups like others.  Repeated rows each count and each give
    their row; an empty table gives none; other columns are not read.
    """
    stats = materialize(quality_stats(docs, keep=[docs[id_col]], **columns), "quality")
    return judge(stats, fit_quality(stats)).select(
        F.col("k0").alias("doc_id"), *COUNTS, "base_failed", "kept", "distance")


def keep_good(docs: DataFrame, **columns: str) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns.  Rows and their
    statistics are written once, side by side: estimates read the narrow
    columns only, and the rows are then filtered from the same table, so that
    no text is shuffled or looked at again and no id is needed."""
    stats = materialize(quality_stats(docs, keep=[docs[c] for c in docs.columns], **columns), "quality")
    kept = judge(stats, fit_quality(stats)).where("kept")
    return kept.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(docs.columns)))


def op8_quality_rules(spark, sf_dir):
    return quality_verdicts(table(spark, sf_dir, "documents"))
