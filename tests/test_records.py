import datetime as dt

import numpy as np

from conftest import hr_line, line

from pulseline.operators import records as rec


def _lines(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value STRING")


def test_filter_is_conjunction_of_substrings(spark):
    good = hr_line()
    other = good.replace("HR DAILY", "SYSTEM TRIGGERED MEASUREMENT")
    lower = good.replace("HR DAILY", "hr daily")
    out = rec.filter_lines(_lines(spark, [good, other, lower])).collect()
    assert [r.value for r in out] == [good]


def test_parse_types_and_derived_values(spark):
    r = rec.parse_trial(_lines(spark, [hr_line(value="86", time="083026", seq="7")])).first()
    assert r.value == 86 and r.variance == 36 and r.percentage == 72.0
    assert r.start_date == dt.date(2024, 1, 5) and r.start_time == 83026
    assert r.end_date == dt.date(2024, 1, 6) and r.end_time == 0
    assert r.start_ts == dt.datetime(2024, 1, 5, 8, 30, 26) and r.seq == 7
    assert r.patient_id == "000000001"


def test_percentage_truncates_toward_zero(spark):
    # base 60: variance -1 -> (-100) div 60 = -1 (not -2)
    r = rec.parse_trial(_lines(spark, [hr_line(value="59")]), base=60).first()
    assert r.variance == -1 and r.percentage == -1.0


def test_comma_separator_and_key(spark):
    df = rec.add_key(rec.parse_trial(_lines(spark, [hr_line(sep=",")]), sep=","))
    assert df.first().record_key == "TR-001_000000001_S01"


def test_rejects_keep_line_and_reason(spark):
    lines = [hr_line(value="Sinus Rhythm"), hr_line(day="32JAN2024"), "a|b|c",
             hr_line(time="xx"), hr_line()]
    got = {r.raw: r.reason for r in rec.rejects(_lines(spark, lines)).collect()}
    assert got == {lines[0]: "bad_int:result", lines[1]: "bad_date:start_date",
                   "a|b|c": "short_line", lines[3]: "bad_time:start_time"}
    assert rec.parse_trial(_lines(spark, lines)).count() == 1


def test_missing_end_is_null_not_reject(spark):
    r = rec.parse_trial(_lines(spark, [hr_line(end_day="", end_time="")])).first()
    assert r.end_date is None and r.end_time is None


def test_pipe_file_read_with_comma_is_rejected(spark):
    got = rec.rejects(_lines(spark, [hr_line()]), sep=",").first()
    assert got.reason == "short_line"


def test_fail_mode_raises(spark):
    import pytest
    with pytest.raises(Exception):
        rec.parse_trial(_lines(spark, [line({12: "x"})]), on_error="fail").collect()


def test_report_filters_and_grouping(spark):
    from pulseline.operators.report import report
    lines = [hr_line(patient="000000001", visit="S01", value="60", seq="1"),
             hr_line(patient="000000001", visit="S03", value="80", seq="2"),
             hr_line(patient="000000002", visit="S01", value="40", seq="3")]
    recs = rec.trial_records(_lines(spark, lines))
    got = report(recs, group_by=("patient_id",), filters={"visit_name": "S01"}).collect()
    assert {(r.patient_id, r.n_records, r.avg_value, r.avg_percentage) for r in got} == \
        {("000000001", 1, 60.0, 20.0), ("000000002", 1, 40.0, -20.0)}
    got = report(recs, group_by=("visit_name",), filters={"patient_id": ["000000001"]}).collect()
    assert sorted((r.visit_name, r.max_variance) for r in got) == [("S01", 10), ("S03", 30)]


def test_impossible_times_are_rejected(spark):
    lines = [hr_line(time=t, seq=str(i)) for i, t in enumerate(("256161", "240000", "126000", "120060", "235959"))]
    got = rec.rejects(_lines(spark, lines)).collect()
    assert [r.reason for r in got] == ["bad_time:start_time"] * 4
    assert rec.parse_trial(_lines(spark, lines)).first().start_time == 235959


def test_no_value_fails_the_job(spark):
    values = ["99999999", "2147483647", "-2147483648", "9223372036854775807", "99999999999999999999", "-3"]
    lines = [hr_line(value=v) for v in values]
    assert {r.raw for r in rec.rejects(_lines(spark, lines)).collect()} == {lines[i] for i in (2, 3, 4)}
    got = {r.value: (r.variance, r.percentage) for r in rec.parse_trial(_lines(spark, lines)).collect()}
    assert {v: x for v, (x, _) in got.items()} == {99999999: 99999949, 2147483647: 2147483597, -3: -53}
    assert got[-3][1] == -106.0 and got[99999999][1] == float(np.float32(199999898))


def test_filter_by_field(spark):
    lines = [hr_line(visit="S01"), hr_line(visit="S02"), "short"]
    out = rec.filter_fields(_lines(spark, lines), {4: "S02", 10: "HR DAILY"}).collect()
    assert [r.value for r in out] == [lines[1]]


def test_unknown_settings_are_refused():
    import pytest
    from pulseline.config import SensorConfig
    with pytest.raises(ValueError, match="bas_value"):
        SensorConfig.from_dict({"bas_value": 60})
    cfg = SensorConfig.from_dict({"field_terms": {"4": "S01"}, "key_columns": ["patient_id"]})
    assert cfg.field_terms == {4: "S01"} and cfg.key_columns == ("patient_id",)


def test_bounded_print(spark):
    from pulseline.sources.sinks import print_rows
    said = []
    assert print_rows(spark.range(25), 10, said.append) == 10
    assert len(said) == 11 and said[-1] == "..."
    said.clear()
    assert print_rows(spark.range(3), 10, said.append) == 3 and len(said) == 3
