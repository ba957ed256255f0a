"""Column expressions shared by the batch and streaming paths.

Everything here returns a ``Column`` built from built-in functions, so it
stays inside whole-stage codegen.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The record layout of one device line (27 positional fields).
N_FIELDS = 27
FIELD_TRIAL = 0
FIELD_PATIENT = 1
FIELD_VISIT = 4
FIELD_RESULT = 12
FIELD_DEVICE = 16
FIELD_EPISODE = 22
FIELD_START_DATE = 23
FIELD_START_TIME = 24
FIELD_END_DATE = 25
FIELD_END_TIME = 26
DATE_PATTERN = "ddMMMyyyy"


def split_fields(line: Column, sep: str = "|") -> Column:
    """All fields of a line, trailing empty fields kept (limit -1)."""
    return F.split(line, re.escape(sep), -1)


def field(fields_col: Column, i: int) -> Column:
    """Field ``i`` (0-based) or NULL when the line is shorter; '' -> NULL."""
    v = F.get(fields_col, i)
    return F.when(v == "", F.lit(None)).otherwise(v)


def contains_all(line: Column, terms) -> Column:
    """Conjunction of case-sensitive substring tests on the whole line."""
    terms = list(terms)
    if not terms:
        return F.lit(True)
    return reduce(lambda a, b: a & b, [line.contains(t) for t in terms])


def parse_date(s: Column) -> Column:
    """``ddMMMyyyy`` (e.g. 05JAN2024) -> DATE, NULL when invalid."""
    return F.try_to_date(s, DATE_PATTERN)


def parse_hhmmss(s: Column) -> Column:
    """Packed ``HHMMSS`` -> INT (``"083026"`` -> 83026), NULL when invalid
    (also when no clock shows it, e.g. 256161)."""
    t = s.try_cast("int")
    clock = (t < 240000) & ((t / 100).cast("int") % 100 < 60) & (t % 100 < 60)
    return F.when(s.rlike("^[0-9]{1,6}$") & clock, t)


def stamp(date: Column, hhmmss: Column) -> Column:
    """Parsed DATE + packed INT time -> TIMESTAMP_NTZ (second precision).

    Wall-clock arithmetic only, so the session time zone plays no part.
    A missing time counts as midnight; an impossible one gives NULL.
    """
    t = F.coalesce(hhmmss, F.lit(0))
    return F.try_make_timestamp_ntz(
        F.year(date), F.month(date), F.dayofmonth(date),
        (t / 10000).cast("int"), ((t / 100).cast("int") % 100), (t % 100).cast("decimal(8,6)"))


def space_tokens(text: Column) -> Column:
    """JVM ``String.split(" ")`` on a line: inner and leading empty tokens are
    kept, trailing ones dropped; '' -> [""]; a line of only spaces -> []."""
    # rtrim drops trailing ' ' only (as the JVM rule drops only the empty
    # tokens they make); no regular expression runs per text
    body = F.rtrim(text)
    return F.when((body == "") & (text != ""), F.array().cast("array<string>")).otherwise(
        F.split(body, " ", -1))


def wall_seconds(date: Column, hhmmss: Column) -> Column:
    """Seconds since 1970-01-01 of a wall-clock DATE + packed time (no time
    zone involved), as BIGINT; a missing time counts as midnight."""
    t = F.coalesce(hhmmss, F.lit(0))
    return (F.unix_date(date).cast("bigint") * 86400
            + (t / 10000).cast("bigint") * 3600 + ((t / 100).cast("bigint") % 100) * 60
            + (t % 100).cast("bigint"))
