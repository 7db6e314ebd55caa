import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sediment.operators import upsert
from sediment.operators.upsert import MergeConflict, MergePlan, MergeSpec, merge_upsert
from tests.conftest import rows

SCHEMA = "k string, kept int, changed string"
SPEC = MergeSpec("k", ("changed",))


def merge(spark, target, source, plan=MergePlan.HOT_TARGET):
    return rows(
        merge_upsert(
            spark.createDataFrame(target, SCHEMA),
            spark.createDataFrame(source, SCHEMA),
            SPEC,
            plan,
        )
    )


@pytest.mark.parametrize("plan", MergePlan)
def test_insert_update_and_untouched(spark, plan):
    found = merge(
        spark,
        [("a", 1, "x"), ("b", 2, "y")],
        [("b", 20, "new"), ("c", 30, "z")],
        plan,
    )
    assert found == [("a", 1, "x"), ("b", 2, "new"), ("c", 30, "z")]


def test_match_overwrites_with_null_and_without_regard_to_age(spark):
    assert merge(spark, [("a", 1, "newer")], [("a", 9, None)]) == [("a", 1, None)]


@pytest.mark.parametrize("plan", MergePlan)
def test_null_keys_never_match(spark, plan):
    found = merge(spark, [(None, 1, "z")], [(None, 2, "n"), (None, 3, "n")], plan)
    assert found == [(None, 1, "z"), (None, 2, "n"), (None, 3, "n")]


def test_repeated_source_key_on_a_match_is_an_error(spark):
    with pytest.raises(MergeConflict, match="k = a"):
        merge(spark, [("a", 1, "x")], [("a", 2, "p"), ("a", 3, "q")])


def test_different_keys_of_one_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(upsert, "_key_hash", lambda key: F.lit(7).cast("long"))
    assert merge(spark, [("a", 1, "x")], [("a", 2, "p"), ("b", 3, "q")]) == [("a", 1, "p"), ("b", 3, "q")]
    with pytest.raises(MergeConflict, match="k = a"):
        merge(spark, [("a", 1, "x")], [("a", 2, "p"), ("a", 3, "q"), ("b", 3, "q")])


def test_repeated_source_key_without_a_match_is_inserted(spark):
    found = merge(spark, [("a", 1, "x")], [("c", 2, "p"), ("c", 3, "q"), ("a", 0, "u")])
    assert found == [("a", 1, "u"), ("c", 2, "p"), ("c", 3, "q")]


@pytest.mark.parametrize("plan", MergePlan)
def test_repeated_target_key_is_updated_in_every_row(spark, plan):
    found = merge(spark, [("a", 1, "x"), ("a", 2, "y")], [("a", 9, "u")], plan)
    assert found == [("a", 1, "u"), ("a", 2, "u")]


def test_columns_are_found_by_name_in_target_order(spark):
    target = spark.createDataFrame([("a", 1, "x")], SCHEMA)
    source = spark.createDataFrame([("new", "b", 5)], "changed string, k string, kept int")
    merged = merge_upsert(target, source, SPEC)
    assert merged.columns == ["k", "kept", "changed"]
    assert rows(merged) == [("a", 1, "x"), ("b", 5, "new")]


def test_a_missing_source_column_is_an_error(spark):
    target = spark.createDataFrame([("a", 1, "x")], SCHEMA)
    source = spark.createDataFrame([("a", "x")], "k string, changed string")
    with pytest.raises(AnalysisException):
        merge_upsert(target, source, SPEC)


def test_merging_twice_equals_merging_once(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], SCHEMA)
    source = spark.createDataFrame([("b", 20, "new"), ("c", 30, "z")], SCHEMA)
    once = merge_upsert(target, source, SPEC)
    assert rows(merge_upsert(once, source, SPEC)) == rows(once)


def test_empty_sides(spark):
    assert merge(spark, [], [("a", 1, "x")]) == [("a", 1, "x")]
    assert merge(spark, [("a", 1, "x")], []) == [("a", 1, "x")]


keys = st.one_of(st.none(), st.sampled_from("abcdef"))
cells = st.tuples(keys, st.integers(0, 9), st.one_of(st.none(), st.sampled_from("xyz")))


def brute_force(target, source):
    """One pass per rule, in plain Python; None stands for an error."""
    result = []
    for key, kept, changed in target:
        hits = [row for row in source if key is not None and row[0] == key]
        if len(hits) > 1:
            return None
        result.append((key, kept, hits[0][2] if hits else changed))
    held = {row[0] for row in target if row[0] is not None}
    return result + [row for row in source if row[0] not in held]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=st.lists(cells, max_size=8), source=st.lists(cells, max_size=8), plan=st.sampled_from(MergePlan))
def test_equals_brute_force(spark, target, source, plan):
    expected = brute_force(target, source)
    if expected is None:
        with pytest.raises(MergeConflict):
            merge(spark, target, source, plan)
    else:
        found = merge(spark, target, source, plan)
        assert sorted(map(str, found)) == sorted(map(str, expected))
