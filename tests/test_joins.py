import pytest

from corpusloom.operators.joins import lookup_join
from corpusloom.workspace import materialize


@pytest.mark.parametrize(
    "limits",
    [
        {},
        {"max_rows": 4},
        {"max_rows": 1},
        {"max_rows": 100, "max_bytes": 1},
        {"max_rows": 5, "max_bytes": 60},
    ],
)
def test_every_route_gives_the_same_rows(spark, limits):
    # one key holds half of all facts, and some keys are in one table only
    facts = spark.range(2000).selectExpr(
        "id", "CASE WHEN id % 2 = 0 THEN 'hot' ELSE concat('k', id % 100) END AS key"
    )
    counts = facts.filter("key <> 'k7'").groupBy("key").count().withColumnRenamed("count", "n")
    lookup = materialize(counts.selectExpr("key", "n", "length(key) AS size"), "lookup")
    found = lookup_join(facts, lookup, ["key"], "n", **limits)
    expected = facts.join(lookup, ["key"])
    assert found.columns == expected.columns
    assert sorted(found.collect()) == sorted(expected.collect())


def test_only_a_measured_small_lookup_is_broadcast_whole(spark):
    facts = spark.range(1000).selectExpr("id", "concat('k', id % 100) AS key")
    lookup = materialize(
        facts.groupBy("key").count().withColumnRenamed("count", "n"), "lookup"
    )
    small = lookup_join(facts, lookup, ["key"], "n")
    large = lookup_join(facts, lookup, ["key"], "n", max_rows=10)
    assert "left_anti" not in str(small._jdf.queryExecution().optimizedPlan()).lower()
    assert "leftanti" in str(large._jdf.queryExecution().optimizedPlan()).lower()


def test_empty_tables(spark):
    facts = spark.createDataFrame([], "key STRING, id BIGINT")
    lookup = spark.createDataFrame([], "key STRING, n BIGINT")
    assert lookup_join(facts, lookup, ["key"], "n", max_rows=-1 + 1).count() == 0
