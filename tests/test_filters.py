from __future__ import annotations

import pytest

from tidelake.operators import filters


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [("Uma", 31), ("Pia", 52), (None, 43), ("O'Hara", 24)], "name string, size bigint"
    )


def test_equal_filter_takes_values_as_they_are(people, rows):
    assert rows(filters.filter_equal(people, name="O'Hara", size=24)) == [("O'Hara", 24)]
    assert filters.filter_equal(people, name="x' or '1'='1").count() == 0


def test_isin_with_scalar_list_and_table(spark, people, rows):
    assert rows(filters.filter_isin(people, "name", "Uma")) == [("Uma", 31)]
    assert rows(filters.filter_isin(people, "size", [52, 24, None])) == [("O'Hara", 24), ("Pia", 52)]
    wanted = spark.createDataFrame([("Uma",), ("Uma",), (None,)], "w string")
    assert rows(filters.filter_isin(people, "name", wanted)) == [("Uma", 31)]
    clashing = people.withColumnRenamed("size", "_wanted")
    assert rows(filters.filter_isin(clashing, "name", wanted)) == [("Uma", 31)]


@pytest.mark.parametrize("column", ["id", "text", "half"])
@pytest.mark.parametrize("make", [int, str, float])
def test_isin_is_the_same_for_any_number_of_values(spark, column, make):
    df = spark.range(3_000).selectExpr("id", "cast(id as string) as text", "cast(id as double) as half")
    found = [filters.filter_isin(df, column, [make(i) for i in range(n)]).count() for n in (1_000, 1_001, 2_500)]
    assert found in ([1_000, 1_001, 2_500], [0, 0, 0])  # "1.0" is not the text "1"


def test_contains(people):
    assert filters.contains_value(people, "name", "Uma") is True
    assert filters.contains_value(people, "name", "Max") is False
    assert filters.contains_value(people, "name", [None]) is False
    assert filters.contains_value(people.limit(0), "name", "Uma") is False
    assert filters.contains_row(people, "name", ["Max", "Pia"]).first().found is True
    assert filters.contains_row(people.limit(0), "name", "Uma").first().found is False


def test_routing_takes_the_first_prefix(spark):
    keys = spark.createDataFrame([("a/b/1",), ("a/2",), ("c",), (None,)], "key string")
    routed = filters.route_prefix(keys, {"a/b/": "deep", "a/": "shallow"})
    assert {r.key: r.role for r in routed.collect()} == {"a/b/1": "deep", "a/2": "shallow", "c": None, None: None}
    assert {r.key for r in filters.unrouted(routed).collect()} == {"c", None}


def test_lookup_with_a_mapping_and_with_a_table(spark):
    keys = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "key string")
    table = spark.createDataFrame([("x", "job")], "name string, job string")
    for targets in ({"x": "job"}, table):
        found = sorted((str(r.key), str(r.target)) for r in filters.lookup_exact(keys, targets).collect())
        assert found == [("None", "None"), ("x", "job"), ("x", "job"), ("y", "None")]
        assert {r.key for r in filters.unmatched_keys(keys, targets).collect()} == {"y", None}


def test_a_rule_mapping_of_any_size(spark):
    keys = spark.range(5).selectExpr("cast(id as string) as key", "id as _key")
    for size in (0, 3, 120_000):
        found = filters.lookup_exact(keys, {str(i): f"job \"{i}\"" for i in range(size)})
        assert sorted((r.key, r.target) for r in found.filter("target is not null").collect()) == [
            (str(i), f'job "{i}"') for i in range(min(size, 5))
        ]
        assert found.columns == ["key", "_key", "target"]


def test_rules_join_like_the_longest_prefix(spark):
    keys = ["a/b/c", "a/b", "a", "", None, "x/y", "a/b/c", "é/1"]
    rules = [("a", "A"), ("a/b", "AB"), ("a/b", "AA"), ("a/b/c/d", "long"), ("é/", "E"), (None, "no")]
    df = spark.createDataFrame([(i, k, "old") for i, k in enumerate(keys)], "n int, key string, _key string")
    table = spark.createDataFrame(rules, "prefix string, role string")
    found = [r["role"] for r in filters.route_by_rules(df, table).orderBy("n").collect()]
    assert found == ["AA", "AA", "A", None, None, None, "AA", "E"]
    with_default = table.union(spark.createDataFrame([("", "any")], "prefix string, role string"))
    found = [r["role"] for r in filters.route_by_rules(df, with_default).orderBy("n").collect()]
    assert found == ["AA", "AA", "A", "any", None, "any", "AA", "E"]
    assert filters.route_by_rules(df, table.limit(0)).filter("role IS NOT NULL").count() == 0
    assert filters.route_by_rules(df.limit(0), table).count() == 0


def test_rules_can_go_by_their_own_order(spark):
    df = spark.createDataFrame([("a/b/c",), ("a",), ("x",)], "key string")
    rules = [("a/b", "late", 9), ("a", "early", 1), ("", "first", 0), ("x", "x", 5)]
    table = spark.createDataFrame(rules, "prefix string, role string, place int")
    assert {r["key"]: r["role"] for r in filters.route_by_rules(df, table, first="place").collect()} == {"a/b/c": "first", "a": "first", "x": "first"}
    found = filters.route_by_rules(df, table.filter("prefix <> ''"), first="place").collect()
    assert {r["key"]: r["role"] for r in found} == {"a/b/c": "early", "a": "early", "x": "x"}


def test_a_hundred_thousand_rules_need_no_chain_and_no_nested_loop(spark):
    rules = spark.range(100_000).selectExpr("concat('p', id, '/') AS prefix", "concat('r', id) AS role")
    keys = spark.range(1_000).selectExpr("concat('p', id * 100, '/file') AS key")
    routed = filters.route_by_rules(keys, rules)
    plan = routed._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and len(plan) < 40_000
    assert routed.filter("role = concat('r', substring(key, 2, length(key) - 6))").count() == 1_000
