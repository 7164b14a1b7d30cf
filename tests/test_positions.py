import contextlib
import io
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.positions import with_position
from corpusloom.workspace import materialize


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_positions_equal_a_sort(spark, partitions):
    rng = random.Random(1)
    # a third of all rows share a value
    rows = [(rng.choice([5, rng.randint(0, 9)]), f"n{i:04}") for i in range(1000)]
    rng.shuffle(rows)
    table = materialize(spark.createDataFrame(rows, "value INT, name STRING"), "rows")
    found = with_position(table, [F.desc("value"), F.asc("name")], partitions=partitions)
    wanted = [(*r, i + 1) for i, r in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])))]
    assert sorted(map(tuple, found.collect()), key=lambda r: r[2]) == wanted


def test_hot_value_falls_into_several_ranges(spark):
    table = materialize(spark.range(10_000).select(F.lit(1).alias("value"), "id"), "hot")
    found = with_position(table, [F.asc("value"), F.asc("id")], partitions=8)
    assert found.filter("position = id + 1").count() == 10_000
    assert found.rdd.getNumPartitions() > 1 or found.inputFiles()[1:]


def test_no_window(spark):
    table = materialize(spark.range(10), "few")
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        with_position(table, [F.asc("id")]).explain()
    assert "Window" not in plan.getvalue()


def test_no_rows(spark):
    table = materialize(spark.range(0), "none")
    assert with_position(table, [F.asc("id")]).collect() == []
