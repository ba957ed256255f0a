"""Reconciling several sources that claim the same target, by named rule.

Input rows: ``(target, source, source_rank, content)`` (plus an optional
boolean ``packaged``: whether the part came from a packaged source, the
only kind ``rename`` touches; absent = all packaged).  A rule list maps
target patterns to strategies, first match wins, default ``deduplicate``.

Output of ``reconcile``:

``resolved``  target, strategy, source_rank, line_no, content -- the
              resolved content of a target is its rows in
              (source_rank, line_no) order.  ``concat`` gives one row per
              part and ``filterDistinctLines`` one row per kept line, so a
              target claimed by very many sources is never gathered into
              one row or one task.
``conflicts`` target, strategy, n_sources, first_source, last_source for
              every target ``singleOrError``/``deduplicate`` cannot resolve
              (all reported together; ``conflict_sources`` lists them).
``counts``    strategy, n_targets: targets the strategy handled with at
              least 2 parts (1 for ``rename`` and ``discard``).

Everything is a filter/projection or an aggregation with partial
(map-side) combine; no sorted lists per target are built.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseline.operators.running import chunked_running, equal_count_chunks
from pulseline.session import materialize

# Strategy names and their report thresholds.
FIRST = "first"
LAST = "last"
SINGLE_OR_ERROR = "singleOrError"
CONCAT = "concat"
FILTER_DISTINCT_LINES = "filterDistinctLines"
DEDUPLICATE = "deduplicate"
RENAME = "rename"
DISCARD = "discard"
STRATEGIES = (FIRST, LAST, SINGLE_OR_ERROR, CONCAT, FILTER_DISTINCT_LINES, DEDUPLICATE,
              RENAME, DISCARD)
NOTIFY_THRESHOLD = {RENAME: 1, DISCARD: 1}
DEFAULT_THRESHOLD = 2
FILE_EXTENSION = r"([.]\w+)$"


class ReconcileConflict(RuntimeError):
    pass


@dataclass
class Reconciled:
    resolved: DataFrame
    conflicts: DataFrame
    counts: DataFrame

    def raise_on_conflict(self, show: int = 20) -> "Reconciled":
        """Fail if there are conflicts.  The message counts them all and tells
        of ``show``; the whole list is the ``conflicts`` table."""
        bad = self.conflicts.orderBy("target").limit(show).collect()
        if bad:
            n = self.conflicts.count()
            lines = [f"{r.strategy}: {r.target} ({r.n_sources} sources, "
                     f"{r.first_source} .. {r.last_source})" for r in bad]
            raise ReconcileConflict(
                f"{n} target(s) that no rule resolves, {len(bad)} of them:\n" + "\n".join(lines))
        return self


def assign_strategy(parts: DataFrame, rules=(), default: str = DEDUPLICATE) -> DataFrame:
    """Add ``strategy``: the first rule whose pattern matches the target."""
    expr: Column | None = None
    for pattern, strategy in rules:
        if strategy not in STRATEGIES:
            raise ValueError(f"unknown strategy {strategy!r}")
        cond = F.col("target").rlike(pattern)
        expr = F.when(cond, F.lit(strategy)) if expr is None else expr.when(cond, F.lit(strategy))
    expr = F.lit(default) if expr is None else expr.otherwise(F.lit(default))
    return parts.withColumn("strategy", expr)


def renamed_target(target: Column, source: Column) -> Column:
    """``dir/NOTICE.txt`` from source ``lib-2.jar`` -> ``dir/NOTICE_lib-2.txt``."""
    ext = F.regexp_extract(target, FILE_EXTENSION, 1)
    return F.concat(F.regexp_replace(target, FILE_EXTENSION, ""), F.lit("_"),
                    F.regexp_replace(source, FILE_EXTENSION, ""), ext)


def _lines(content: Column) -> Column:
    """Lines of a text as a line reader returns them (final break dropped)."""
    return F.when(content == "", F.array().cast("array<string>")).otherwise(
        F.split(F.regexp_replace(content, "(\\r\\n|\\r|\\n)\\z", ""), "\\r\\n|\\r|\\n", -1))


def _one_row(agg: DataFrame, strategy: str, rank: str, content: str) -> DataFrame:
    return agg.select("target", F.lit(strategy).alias("strategy"),
                      F.col(rank).alias("source_rank"), F.lit(0).alias("line_no"),
                      F.col(content).alias("content"))


def _content_hash() -> Column:
    """SHA-1 of the content; NULL contents are equal to each other only."""
    return F.coalesce(F.sha1(F.col("content")), F.lit("null"))


def _by_target(parts: DataFrame, extra_keys=()) -> DataFrame:
    """Per-target aggregates every strategy needs (one partial aggregation)."""
    first = F.struct(F.col("source_rank"), F.col("content"), F.col("source"))
    return parts.groupBy(*extra_keys, "target").agg(
        F.count(F.lit(1)).alias("n_sources"),
        F.min(first).alias("_first"),
        F.max(first).alias("_last"),
        F.min(_content_hash()).alias("_h_min"),
        F.max(_content_hash()).alias("_h_max"),
    ).select(*extra_keys, "target", "n_sources",
             F.col("_first.source_rank").alias("first_rank"),
             F.col("_first.content").alias("first_content"),
             F.col("_first.source").alias("first_source"),
             F.col("_last.source_rank").alias("last_rank"),
             F.col("_last.content").alias("last_content"),
             F.col("_last.source").alias("last_source"),
             (F.col("_h_min") == F.col("_h_max")).alias("same_content"))


def resolve_first(parts: DataFrame) -> DataFrame:
    return _one_row(_by_target(parts), FIRST, "first_rank", "first_content")


def resolve_last(parts: DataFrame) -> DataFrame:
    return _one_row(_by_target(parts), LAST, "last_rank", "last_content")


def _conflicts(agg: DataFrame, strategy: str, bad: Column) -> DataFrame:
    return agg.filter(bad).select("target", F.lit(strategy).alias("strategy"), "n_sources",
                                  "first_source", "last_source")


def resolve_single_or_error(parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    agg = _by_target(parts)
    ok = agg.filter(F.col("n_sources") == 1)
    return (_one_row(ok, SINGLE_OR_ERROR, "first_rank", "first_content"),
            _conflicts(agg, SINGLE_OR_ERROR, F.col("n_sources") > 1))


def resolve_deduplicate(parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fine when every part has the same content hash (SHA-1), else conflict."""
    agg = _by_target(parts)
    ok = agg.filter(F.col("same_content"))
    return (_one_row(ok, DEDUPLICATE, "first_rank", "first_content"),
            _conflicts(agg, DEDUPLICATE, ~F.col("same_content")))


def resolve_concat(parts: DataFrame) -> DataFrame:
    """Every part in rank order, a line break added where one is missing."""
    c = F.col("content")
    return parts.select("target", F.lit(CONCAT).alias("strategy"), "source_rank",
                        F.lit(0).alias("line_no"),
                        F.when(c.endswith("\n"), c).otherwise(F.concat(c, F.lit("\n")))
                        .alias("content"))


def resolve_distinct_lines(parts: DataFrame) -> DataFrame:
    """The distinct lines of all parts, each at its first occurrence."""
    lines = parts.select("target", "source_rank",
                         F.posexplode(_lines(F.col("content"))).alias("line_no", "line"))
    first = lines.groupBy("target", "line").agg(
        F.min(F.struct("source_rank", "line_no")).alias("_at"))
    return first.select("target", F.lit(FILTER_DISTINCT_LINES).alias("strategy"),
                        F.col("_at.source_rank").alias("source_rank"),
                        F.col("_at.line_no").alias("line_no"), F.col("line").alias("content"))


def resolve_rename(parts: DataFrame) -> DataFrame:
    """Packaged parts move to ``<name>_<source><ext>``; others stay."""
    pk = F.col("packaged") if "packaged" in parts.columns else F.lit(True)
    return parts.select(
        F.when(pk, renamed_target(F.col("target"), F.col("source")))
        .otherwise(F.col("target")).alias("target"),
        F.lit(RENAME).alias("strategy"), "source_rank", F.lit(0).alias("line_no"), "content")


def strategy_counts(parts_with_strategy: DataFrame) -> DataFrame:
    """Targets each strategy handled, counting a target when it has at least
    the strategy's threshold of parts."""
    per_target = parts_with_strategy.groupBy("strategy", "target").agg(
        F.count(F.lit(1)).alias("n"))
    thr = F.lit(DEFAULT_THRESHOLD)
    for s, t in NOTIFY_THRESHOLD.items():
        thr = F.when(F.col("strategy") == s, F.lit(t)).otherwise(thr)
    return (per_target.filter(F.col("n") >= thr)
            .groupBy("strategy").agg(F.count(F.lit(1)).alias("n_targets")))


def _regrouped(parts: DataFrame, rules, default: str) -> DataFrame:
    """Parts under their new targets with the strategy of the new name;
    ``was`` is the old target of parts of a renamed one, else NULL.  A part
    is renamed once: one whose new name asks for it again stays."""
    tagged = assign_strategy(parts, rules, default)
    if RENAME not in {default} | {s for _, s in rules}:
        return tagged.withColumn("was", F.lit(None).cast("string"))
    packaged = F.col("packaged") if "packaged" in parts.columns else F.lit(True)
    renamed = F.col("strategy") == RENAME
    moved = tagged.withColumn("was", F.when(renamed, F.col("target"))).withColumn(
        "target", F.when(renamed & packaged, renamed_target(F.col("target"), F.col("source")))
        .otherwise(F.col("target")))
    return assign_strategy(moved, rules, default)


def reconcile(parts: DataFrame, rules=(), default: str = DEDUPLICATE) -> Reconciled:
    """Resolve every target with the strategy its rule names.

    Rename runs first; its parts, regrouped with any others of their new
    target, are then resolved by the strategy of the new name.  All strategies
    that choose (first, last, singleOrError, deduplicate, and
    filterDistinctLines per line) share one aggregation; concat and rename
    keep their parts and are one projection beside it.
    """
    tagged = _regrouped(parts, rules, default)
    strategy = F.col("strategy")
    whole = F.array(F.struct(F.lit(0).alias("line_no"), F.lit(None).cast("string").alias("line")))
    lines = F.when(strategy == FILTER_DISTINCT_LINES, F.transform(
        _lines(F.col("content")), lambda x, i: F.struct(i.alias("line_no"), x.alias("line")))).otherwise(whole)
    keeps = strategy.isin(CONCAT, RENAME)
    rows = tagged.filter(~keeps & (strategy != DISCARD)).select(
        "target", "strategy", "source", "source_rank", "content", F.explode(lines).alias("l"))
    rows = rows.select("target", "strategy", "source", "source_rank", "l.line_no", "l.line",
                       F.coalesce("l.line", "content").alias("content"))
    part = F.struct("source_rank", "line_no", "content", "source")
    agg = rows.groupBy("strategy", "target", "line").agg(
        F.count(F.lit(1)).alias("n_sources"), F.min(part).alias("first"), F.max(part).alias("last"),
        (F.min(_content_hash()) == F.max(_content_hash())).alias("same"))
    ok = (F.when(strategy == SINGLE_OR_ERROR, F.col("n_sources") == 1)
          .when(strategy == DEDUPLICATE, F.col("same")).otherwise(F.lit(True)))
    chosen = agg.filter(ok).select("target", "strategy", F.when(
        strategy == LAST, F.col("last")).otherwise(F.col("first")).alias("p"))
    chosen = chosen.select("target", "strategy", "p.source_rank", "p.line_no", "p.content")
    content = F.col("content")
    kept = tagged.filter(keeps).select(
        "target", "strategy", "source_rank", F.lit(0).alias("line_no"),
        F.when((strategy == RENAME) | content.endswith("\n"), content)
        .otherwise(F.concat(content, F.lit("\n"))).alias("content"))
    conflicts = agg.filter(~ok).select(
        "target", "strategy", "n_sources", F.col("first.source").alias("first_source"),
        F.col("last.source").alias("last_source"))
    # rename counts the names it was asked for, the others the names they met
    met = tagged.filter(strategy != RENAME).select("strategy", "target")
    asked = tagged.filter(F.col("was").isNotNull()).select(
        F.lit(RENAME).alias("strategy"), F.col("was").alias("target"))
    return Reconciled(chosen.unionByName(kept), conflicts, strategy_counts(met.unionByName(asked)))


def conflict_sources(parts: DataFrame, conflicts: DataFrame) -> DataFrame:
    """Every (target, source) behind a conflict, one row each."""
    return parts.join(conflicts.select("target", "strategy"), "target", "left_semi").select(
        "target", "source", "source_rank")


PIECE_BYTES = 8 << 20


def merged_pieces(resolved: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """The merged content of every target, cut into pieces of ``piece_bytes``:
    (target, piece, offset, content), content as bytes.  A target's pieces in
    order are what its rows of ``resolved`` make, line after line.

    Where a row's bytes begin is a running sum of lengths over the target's
    rows, chunk by chunk (see ``operators.running``), so a target with a third
    of all parts is spread over many tasks, and then over its pieces.  A part
    longer than a piece is cut, and no group is larger than a piece.  A target
    without any content has one empty piece; NULL content counts as empty.
    """
    ends = F.when(F.col("strategy") == FILTER_DISTINCT_LINES, F.lit("\n")).otherwise(F.lit(""))
    rows = materialize(resolved.select(
        "target", "source_rank", "line_no",
        F.encode(F.concat(F.coalesce("content", F.lit("")), ends), "UTF-8").alias("data")), "merged")
    rows = rows.withColumn("_n", F.octet_length("data").cast("bigint"))
    order = ["source_rank", "line_no"]
    places = chunked_running(
        equal_count_chunks(rows.drop("data"), ["target"], order, "_chunk"),
        ["target"], "_chunk", order, {"_end": ("sum", F.col("_n"))}).select("target", *order, "_end")
    # the texts stay where they are written; their places meet them by the rows' own key
    placed = rows.join(places, ["target", *order]).withColumn("_start", F.col("_end") - F.col("_n"))
    first = F.greatest(F.floor((F.col("_start") - F.when(F.col("_n") == 0, 1).otherwise(0)) / piece_bytes), F.lit(0))
    last = F.greatest(F.floor((F.col("_end") - 1) / piece_bytes), F.lit(0))
    cut = placed.withColumn("piece", F.explode(F.sequence(first.cast("bigint"), last.cast("bigint"))))
    cut = cut.withColumn("_lo", F.greatest(F.col("piece") * piece_bytes - F.col("_start"), F.lit(0)))
    cut = cut.withColumn("_some", F.least(F.col("_n"), (F.col("piece") + 1) * piece_bytes - F.col("_start")) - F.col("_lo"))
    part = F.substring("data", (F.col("_lo") + 1).cast("int"), F.col("_some").cast("int"))
    return cut.select("target", "piece", F.col("_start").alias("_at"), part.alias("_part")).groupBy(
        "target", "piece").agg(F.expr("listagg(_part) WITHIN GROUP (ORDER BY _at)").alias("content")).select(
            "target", "piece", (F.col("piece") * piece_bytes).alias("offset"), "content")
