"""The stored demand index and the lookups on it."""

from __future__ import annotations

from tests.helpers import hours, rows
from tests.test_serving import HISTORY, asked, history
from velotide.operators.lookup import lookup_demand
from velotide.plans.serving import answer_requests, forecast
from velotide.schemas import FORECAST_REQUEST, PRICE_REQUEST
from velotide.sources.demand_index import read_demand_index, write_demand_index

ASKED = [
    ("1.10", "2026-01-05 08:59:00"), ("2.10", "2026-01-07 08:00:00"), ("none", "2026-01-05 09:10:00"),
    ("1.10", "2026-01-05 17:00:00"), ("1.10", None), (None, "2026-01-05 08:00:00"),
]


def test_index_answers_as_the_history_does(spark, tmp_path):
    holed = history(spark).unionByName(hours(spark, [("1.10", None, 7, 7), (None, "2026-01-05 08:00:00", 9, 9)], HISTORY))
    index = write_demand_index(holed, str(tmp_path / "it's"), buckets=3)
    assert rows(lookup_demand(asked(spark, *ASKED), index)) == rows(lookup_demand(asked(spark, *ASKED), holed))
    again = read_demand_index(spark, str(tmp_path / "it's"))
    assert rows(lookup_demand(asked(spark, *ASKED), again)) == rows(lookup_demand(asked(spark, *ASKED), holed))
    requests = spark.createDataFrame([(1, "1.10", None, 3, None), (2, "none", 20, None, 5)], FORECAST_REQUEST)
    assert rows(forecast(requests, again, "2026-01-05 07:30:00")) == rows(forecast(requests, holed, "2026-01-05 07:30:00"))


def test_index_of_nothing_and_replacing(spark, tmp_path):
    path = str(tmp_path / "index")
    nothing = write_demand_index(history(spark).where("false"), path, buckets=2)
    assert nothing.by_station.count() == 0 == nothing.by_hour.count()
    got = lookup_demand(asked(spark, ("1.10", "2026-01-04 18:00:00")), nothing).first()
    assert (got.predicted_bike_demand, got.predicted_dock_demand) == (15.0, 13.5)
    assert write_demand_index(history(spark), path, buckets=4).by_station.count() == 3


def test_history_is_neither_aggregated_nor_shuffled(spark, tmp_path):
    index = write_demand_index(history(spark), str(tmp_path / "index"), buckets=5)
    requests = spark.createDataFrame(
        [(i, f"{i}.10", "2026-01-05 08:00", False, 3, 4, 50) for i in range(64)], PRICE_REQUEST
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        answers = answer_requests(requests, index)
        answers.collect()
        plan = answers._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # One shuffle, of the requests; the index is read bucket by bucket.
    assert plan.count("Exchange hashpartitioning") == 1 and "Aggregate" not in plan
    assert "Bucketed: true" in plan or "SelectedBucketsCount: 5 out of 5" in plan
