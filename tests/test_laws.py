"""Property tests (hypothesis) for the laws the operators promise."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import quality
from tidemark.operators.identity import add_identity
from tidemark.session import RunStamp

ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 3)), max_size=40)
LAW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@LAW
@given(prior=ROWS, current=ROWS)
def test_rowkey_anti_join_is_except_all(spark, prior, current):
    schema = "s string, n int"
    p = add_identity(spark.createDataFrame(prior, schema).repartition(3))
    c = add_identity(spark.createDataFrame(current, schema).repartition(2))
    diff = p.join(c.select("rowkey"), "rowkey", "left_anti").select("s", "n").collect()
    expected = Counter(prior) - Counter(current)
    assert Counter(map(tuple, diff)) == expected


@LAW
@given(rows=ROWS)
def test_occurrences_number_each_copy_once(spark, rows):
    out = add_identity(spark.createDataFrame(rows, "s string, n int").repartition(4)).collect()
    seen = Counter()
    for r in out:
        seen[(r.s, r.n)] += 1
    by_row = {}
    for r in out:
        by_row.setdefault((r.s, r.n), []).append(r.rowoccurrence)
    for key, occ in by_row.items():
        assert sorted(occ) == list(range(1, seen[key] + 1))
    assert len({r.rowkey for r in out}) == len(rows)


@LAW
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 5)), st.one_of(st.none(), st.integers(-5, 5))),
                     max_size=30))
def test_dq_split_partitions_input(spark, rows):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "id int, a int, b int")
    rules = [("a_pos", "a > 0"), ("b_small", "b < 3")]
    passed, failed = quality.split(df, rules, "t", RunStamp.parse("2024-01-01 00:00:00"))
    p = {r.id for r in passed.collect()}
    f = {r.id: r._failed_dq_rules for r in failed.collect()}
    assert p | set(f) == set(range(len(rows))) and not (p & set(f))
    for i, (a, b) in enumerate(rows):
        want = [d for d, ok in (("a_pos", a is None or a > 0), ("b_small", b is None or b < 3)) if not ok]
        assert f.get(i, []) == want
