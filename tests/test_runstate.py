"""Counts over runs from stored states against counts over the rows."""

import pytest
from pyspark.sql import functions as F

from recordlake.operators import runstate


def ids(spark, low, high, prefix=""):
    return spark.range(low, high).select(F.concat(F.lit(prefix), F.col("id").cast("string")).alias("id"), F.lit("x").alias("a"))


def test_small_runs_are_exact(spark):
    runs = [ids(spark, 0, 500), ids(spark, 250, 700), spark.createDataFrame([(None, ""), ("3", " "), ("3", "y")], "id string, a string")]
    states = [runstate.run_state(df, f"r{k}", ["a"]) for k, df in enumerate(runs)]
    every = states[0].union(states[1]).union(states[2]).union(states[1])  # one of them twice
    row = runstate.over_runs(every).first()
    assert (row.n_runs, row.n_rows, row.distinct_ids, row.duplicate_ids, row.exact, row.error) == (3, 953, 700, 252, True, 0)
    assert tuple(runstate.exact_over_runs(runs).first()) == (700, 252)
    assert [tuple(r) for r in runstate.fill_over_runs(every).collect()] == [("a", 951, 953)]


@pytest.mark.parametrize("lg_size", [8, 11])
def test_large_runs_stay_within_the_error(spark, lg_size):
    """Several id sets, so that a bound of two standard errors may be missed now and then."""
    missed = 0
    for k in range(8):
        runs = [ids(spark, 0, 6000, f"p{k}-"), ids(spark, 3000, 20000, f"p{k}-")]
        states = runstate.run_state(runs[0], "a", lg_size=lg_size).union(runstate.run_state(runs[1], "b", lg_size=lg_size))
        row = runstate.over_runs(states, lg_size).first()
        assert not row.exact and row.distinct_ids + row.duplicate_ids == row.n_rows == 23000
        missed += abs(row.distinct_ids - 20000) > row.error
        assert abs(row.distinct_ids - 20000) < 2.5 * row.error
    assert missed <= 2
    assert tuple(runstate.exact_over_runs(runs).first()) == (20000, 3000)


def test_empty_runs(spark):
    none = ids(spark, 0, 0)
    states = runstate.run_state(none, "a", ["a"]).union(runstate.run_state(none, "b", ["a"]))
    assert tuple(runstate.over_runs(states).first()) == (2, 0, 0, 0, True, 0)
    assert tuple(runstate.over_runs(states.where("false")).first()) == (0, 0, 0, 0, True, 0)
    assert tuple(runstate.exact_over_runs([none]).first()) == (0, 0)
