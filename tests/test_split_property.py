"""The space-split rule against a model of the JVM's String.split(" ")."""

from hypothesis import given, settings
from hypothesis import strategies as st

from pulseline.functions.fields import space_tokens


def jvm_split_space(s: str) -> list[str]:
    if s == "":
        return [""]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=" ab\n\t", max_size=12), min_size=50, max_size=50))
def test_split_matches_jvm_rule(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text STRING")
    got = [r.toks for r in df.select(space_tokens(df.text).alias("toks")).collect()]
    assert got == [jvm_split_space(t) for t in texts]
