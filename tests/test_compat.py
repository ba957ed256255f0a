import datetime as dt
import random

from pyspark.sql import functions as F

from pulseline.operators.compat import compat_running

INT_MAX = 2147483647


def literal_fold(values):
    """The original per-key fold, record by record."""
    out, state = [], None
    for v in values:
        if state is None:
            state = (0, 1000, 0, 0)
            out.append(state)
            continue
        mx = v if v > state[0] else 0
        mn = v if v < state[1] else INT_MAX
        state = (mx, mn, state[2] + 1, state[3] + v)
        out.append(state)
    return out


def test_closed_form_equals_fold_on_random_sequences(spark):
    rnd = random.Random(7)
    rows, want = [], {}
    for k in range(300):
        n = rnd.randint(1, 30)
        vals = [rnd.choice([0, rnd.randint(0, 5), rnd.randint(1, 999), rnd.randint(-9, 0)]) for _ in range(n)]
        key = f"K{k}"
        want[key] = literal_fold(vals)
        for i, v in enumerate(vals):
            # several records per day so chunks hold runs and borders both
            ts = dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * i)
            rows.append((key, "T", "P", "V", v, ts, i, ts.date(),
                         ts.hour * 10000 + ts.minute * 100 + ts.second))
    df = spark.createDataFrame(
        rows, "record_key STRING, trial_id STRING, patient_id STRING, visit_name STRING, "
              "value INT, start_ts TIMESTAMP_NTZ, seq BIGINT, start_date DATE, start_time INT")
    for width in ("auto", 86400, 3600 * 13):
        got = {}
        for r in compat_running(df, chunk_seconds=width).orderBy("record_key", "seq").collect():
            got.setdefault(r.record_key, []).append(
                (r.max_value, r.min_value, r.n_records, r.sum_value))
        assert got == want, width


def test_first_record_is_blank(spark):
    df = spark.createDataFrame(
        [("K", "T", "P", "V", 80, dt.datetime(2024, 1, 1), 1, dt.date(2024, 1, 1), 0)],
        "record_key STRING, trial_id STRING, patient_id STRING, visit_name STRING, "
        "value INT, start_ts TIMESTAMP_NTZ, seq BIGINT, start_date DATE, start_time INT")
    r = compat_running(df).first()
    assert (r.trial_id, r.max_value, r.min_value, r.n_records, r.sum_value, r.avg_int) == \
        ("", 0, 1000, 0, 0, 0)
