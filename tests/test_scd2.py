"""Properties of the dimension, merges and deduplication, on small random rows."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stratiform.operators import dedup, merge, scd2

SOURCE = "k int, a string, b int"
attribute = st.sampled_from([None, "", "x", "y", "x||y"])
source = st.dictionaries(st.integers(1, 6), st.tuples(attribute, st.sampled_from([None, 1, 2])), max_size=6)
few = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, rows):
    return spark.createDataFrame([(k, *v) for k, v in rows.items()], SOURCE)


@few
@given(source, source)
def test_apply(spark, one, two):
    dim = scd2.initial(frame(spark, one), dt.date(2024, 1, 1))
    src = frame(spark, two)
    out = scd2.apply(dim, src, ["k"], ["a", "b"], dt.date(2024, 2, 1))
    got = sorted(map(repr, out.collect()))
    assert got == sorted(map(repr, scd2.expire_then_insert(dim, src, ["k"], ["a", "b"], dt.date(2024, 2, 1)).select(out.columns).collect()))
    changed = {k for k in one if k in two and one[k] != two[k]}
    assert len(got) == len(one) + len(changed) + len(set(two) - set(one))
    current = {r["k"]: (r["a"], r["b"]) for r in out.where("is_current").collect()}
    assert current == {**one, **two}
    again = scd2.apply(out, src, ["k"], ["a", "b"], dt.date(2024, 3, 1))
    assert sorted(map(repr, again.collect())) == got
    same_day = scd2.apply(out, frame(spark, one), ["k"], ["a", "b"], dt.date(2024, 2, 1))
    assert scd2.bad_order(same_day).count() == scd2.gaps(same_day, ["k"]).count() == scd2.several_current(same_day, ["k"]).count() == 0


def test_null_to_empty_is_a_change(spark):
    dim, empty = scd2.initial(frame(spark, {1: (None, None)}), dt.date(2024, 1, 1)), frame(spark, {1: ("", None)})
    assert [r["_kind"] for r in scd2.new_or_changed(dim, empty, ["k"], ["a", "b"]).collect()] == ["changed"]
    assert scd2.new_or_changed(dim, frame(spark, {1: (None, None)}), ["k"], ["a", "b"]).count() == 0


def test_apply_refuses_or_takes_the_past(spark):
    d = dt.date
    dim = scd2.initial(frame(spark, {1: ("x", 1), 2: ("y", 1)}), d(2024, 6, 1))
    change = frame(spark, {1: ("z", 1), 3: ("n", 1)})
    for f in (scd2.apply, scd2.expire_then_insert):
        with pytest.raises(Exception, match="use rebuild"):
            f(dim, change, ["k"], ["a", "b"], d(2024, 1, 1)).collect()
    out = sorted((r["k"], r["a"], r["effective_from"], r["effective_to"], r["is_current"]) for r in scd2.apply_anytime(dim, change, ["k"], ["a", "b"], d(2024, 1, 1)).collect())
    end = d(9999, 12, 31)
    assert out == [(1, "x", d(2024, 6, 1), end, True), (1, "z", d(2024, 1, 1), d(2024, 6, 1), False), (2, "y", d(2024, 6, 1), end, True), (3, "n", d(2024, 1, 1), end, True)]


def test_rebuild_in_the_past(spark):
    d = dt.date
    dim = spark.createDataFrame([(1, "x", d(2024, 1, 1), d(2024, 6, 1), False), (1, "y", d(2024, 6, 1), d(9999, 12, 31), True)], "k int, a string, effective_from date, effective_to date, is_current boolean")
    late = spark.createDataFrame([(1, "z", d(2024, 3, 1), 1), (1, "w", d(2023, 1, 1), 1), (1, "y", d(2024, 8, 1), 1), (2, "q", d(2024, 1, 1), 1), (1, "v", d(2024, 6, 1), 2)], "k int, a string, effective_from date, arrival int")
    out = [(r["k"], r["a"], r["effective_from"], r["is_current"]) for r in scd2.rebuild(dim, late, ["k"], ["a"]).orderBy("k", "effective_from").collect()]
    assert out == [(1, "w", d(2023, 1, 1), False), (1, "x", d(2024, 1, 1), False), (1, "z", d(2024, 3, 1), False), (1, "v", d(2024, 6, 1), False), (1, "y", d(2024, 8, 1), True), (2, "q", d(2024, 1, 1), True)]


def test_empty_sides(spark):
    none = spark.createDataFrame([], SOURCE)
    some = frame(spark, {1: ("x", 1)})
    dim = scd2.initial(some, dt.date(2024, 1, 1))
    assert scd2.apply(dim, none, ["k"], ["a"], dt.date(2024, 2, 1)).count() == 1
    assert scd2.apply(dim.limit(0), some, ["k"], ["a"], dt.date(2024, 2, 1)).count() == 1
    assert merge.upsert(none, some, ["k"]).count() == merge.upsert(some, none, ["k"]).count() == 1
    assert merge.update_only(none, some, ["k"]).count() == 0


def test_null_keys_and_columns(spark):
    t = spark.createDataFrame([(1, "a", 1), (None, "b", 2)], SOURCE)
    s = spark.createDataFrame([(1, "c", 3), (None, "d", 4)], SOURCE)
    assert sorted(map(repr, [tuple(r) for r in merge.upsert(t, s, ["k"], ["a"]).collect()])) == sorted(map(repr, [(1, "c", 1), (None, "b", 2), (None, "d", 4)]))
    assert merge.insert_only(t, s, ["k"]).count() == 3


@few
@given(st.lists(st.tuples(st.integers(1, 3), st.sampled_from([None, 1, 2]), st.integers(0, 3)), max_size=12))
def test_latest(spark, data):
    df = spark.createDataFrame(data, "k int, t int, v int")
    got = {r["k"]: (r["t"], r["v"]) for r in dedup.latest(df, ["k"], ["t"], ["v"]).collect()}
    key = lambda x: (x[1] is not None, x[1] or 0, x[2])
    assert got == {k: max((x for x in data if x[0] == k), key=key)[1:] for k in {x[0] for x in data}}


def test_unique(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    with pytest.raises(ValueError, match="not unique"):
        dedup.assert_unique(df, ["k"])
    assert dedup.assert_unique(df.distinct(), ["k"]).count() == 2


def test_late_split(spark):
    d = dt.date
    df = spark.createDataFrame([(1, d(2024, 1, 1), d(2024, 1, 2)), (2, d(2024, 1, 1), d(2024, 1, 3)), (3, d(2022, 1, 1), d(2024, 1, 1)), (4, None, d(2024, 1, 1))], "k int, e date, r date")
    assert [sorted(x["k"] for x in p.collect()) for p in scd2.split_late(df, "r", "e")] == [[1, 4], [2], [3]]
