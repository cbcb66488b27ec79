"""Subtotals beside attributes that are NULL."""

from __future__ import annotations

import pytest
from conftest import tuples

from tallyhouse.operators import metrics


@pytest.fixture
def star(spark):
    fact = spark.createDataFrame([(1, 10), (1, 20), (2, 5), (3, 7), (None, 9)], "k long, amount long")
    dim = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, None, None)], "k long, name string, kind string")
    return fact, {"k": (dim, ["name", "kind"])}


def test_level_tells_a_subtotal_from_a_missing_attribute(star):
    got = metrics.star_metrics(*star, ["name", "kind"], [metrics.rows()], totals="rollup", level="level")
    assert sorted(tuples(got.select("level", "name", "kind", "transaction_count")), key=repr) == sorted(
        [(0, "a", None, 2), (0, "b", "x", 1), (0, None, None, 1), (1, "a", None, 2), (1, "b", None, 1), (1, None, None, 1), (3, None, None, 4)],
        key=repr,
    )


def test_chosen_sets_in_one_pass(star):
    got = metrics.star_metrics(*star, ["name", "kind"], [metrics.rows()], sets=[["kind"], []], level="level")
    assert sorted(tuples(got.select("level", "name", "kind", "transaction_count")), key=repr) == sorted(
        [(2, None, None, 3), (2, None, "x", 1), (3, None, None, 4)], key=repr
    )
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1 and "Union" not in plan


@pytest.mark.parametrize("wrong", [{"totals": "sum"}, {"totals": "cube", "sets": [[]]}, {"level": "level"}])
def test_wrong_requests(star, wrong):
    with pytest.raises(ValueError):
        metrics.star_metrics(*star, ["name"], [metrics.rows()], **wrong)
