import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers find the package the same way
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pulseline.session import get_session
    s = get_session(master="local[8]", shuffle_partitions=8)
    yield s
    s.stop()


def line(fields: dict, n: int = 27, sep: str = "|") -> str:
    """A device line with the given 0-based fields set (others empty)."""
    parts = [""] * n
    for i, v in fields.items():
        parts[i] = v
    return sep.join(parts)


def hr_line(patient="000000001", visit="S01", value="60", day="05JAN2024", time="083026",
            end_day="06JAN2024", end_time="000000", seq="1", trial="TR-001", sep="|"):
    return line({0: trial, 1: patient, 3: "M", 4: visit, 9: "MEASUREMENT", 10: "HR DAILY",
                 11: "SUMMARY (MEAN) HEART RATE", 12: value, 14: "BEATS/MIN", 15: "1",
                 16: "DEV0001", 22: seq, 23: day, 24: time, 25: end_day, 26: end_time}, sep=sep)
