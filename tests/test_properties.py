"""Property checks against small Python reference implementations."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from recspark.constants import RATING_LOG_PREFIX as P
from recspark.functions import expr as X
from test_expr import java_hash

SETTINGS = settings(max_examples=5, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def java_payload(line: str):
    """Reference: text after the first prefix up to the next, Java-trimmed."""
    if P not in line:
        return None
    part = line.split(P)[1]
    i, j = 0, len(part)
    while i < j and ord(part[i]) <= 0x20:
        i += 1
    while j > i and ord(part[j - 1]) <= 0x20:
        j -= 1
    return part[i:j] or None


names = st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=12),
                 min_size=1, max_size=60)
lines = st.lists(st.builds(lambda a, b, c: a + b + c,
                           st.text(max_size=8),
                           st.sampled_from(["", P, P + P, " " + P, P + "\t"]),
                           st.text(alphabet="0123456789|. \t\x01", max_size=10)),
                 min_size=1, max_size=60)


@SETTINGS
@given(names)
def test_name_hash_matches_java(spark, ns):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(ns)], "i int, n string")
    got = {r.i: r.h for r in df.select("i", X.user_id_from_name("n").alias("h")).collect()}
    assert all(got[i] == java_hash(n) for i, n in enumerate(ns))


@SETTINGS
@given(lines)
def test_log_payload_matches_reference(spark, ls):
    df = spark.createDataFrame([(i, l) for i, l in enumerate(ls)], "i int, value string")
    got = {r.i: r.p for r in df.select("i", X.rating_log_payload("value").alias("p")).collect()}
    assert all(got[i] == java_payload(l) for i, l in enumerate(ls))
