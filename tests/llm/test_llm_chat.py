"""Perspective rotation where turns do not number the messages."""

import duckdb
import pyarrow as pa
import pytest

from compare import compare
from pulseline.llm import chat
from pulseline.llm.chat import OP9_SQL, rotate
from pulseline.session import scratch_path

SCHEMA = ("conv_id long, turn long, role string, text string, block string, part string, speaker int, "
          "mask string, messages int")


def row(conv, turn, role, text):
    return (conv, turn, role, text, "b", "p", 1, "m", 2)


ROWS = [row(1, None, f"r{i % 3}", f"message {i:04d}") for i in range(200)]  # no turn numbers at all
ROWS += [row(2, 5, "a" if i % 2 else "b", f"same turn {i:04d}") for i in range(150)]
ROWS += [row(2, i, "a", "short") for i in range(130)]
ROWS += [row(3, 0, "system", "only the system"), row(4, 0, None, None), row(4, 0, None, None), row(4, 1, "x", "")]
ROWS += [row(None, 0, "x", "no conversation"), row(None, None, "y", "<|im_end|> in a text")]
ROWS += [row(6, 0, "x", "long " * 40_000), row(6, 1, "y", "a" * 100_000)]


@pytest.fixture(scope="module")
def folder(spark):
    path = scratch_path(spark, "chat")
    spark.createDataFrame(ROWS, SCHEMA).repartition(5).write.parquet(f"{path}/conversations.parquet")
    return path


def test_query_and_sql_agree_whatever_the_turns_are(spark, folder):
    con = duckdb.connect()
    con.register("conversations", pa.Table.from_pylist(
        [dict(zip(("conv_id", "turn", "role", "text"), r)) for r in ROWS]))
    got = chat.op9_chat_rotation(spark, folder)
    assert compare(got, con, OP9_SQL) == []
    keys = [(r.conv_id, r.speaker, r.block, r.part) for r in got.collect()]
    assert len(set(keys)) == len(keys)  # parts can be put in order
    assert sorted(r.n_messages for r in got.where("conv_id = 1 AND speaker = 'r0'").collect()) == [8, 64, 64, 64]


def test_parts_in_order_are_the_whole_rendering(spark, folder):
    rows = rotate(spark.read.parquet(f"{folder}/conversations.parquet")).where(
        "conv_id = 1 AND speaker = 'r1'").orderBy("block", "part").collect()
    text = "".join(r.text for r in rows)
    at = [text.index(f"message {i:04d}") for r in range(3) for i in range(r, 200, 3)]
    assert at == sorted(at)  # by role, then text, as there are no turns
    own = [r.text[s["start"]:s["end"]] for r in rows for s in r.mask]
    assert own == [f"message {i:04d}{chat.END}" for i in range(1, 200, 3)]


def test_empty_table(spark):
    assert rotate(spark.createDataFrame([], SCHEMA)).collect() == []
