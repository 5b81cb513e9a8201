import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tests.helpers import hours, rows
from velotide.operators.categories import (
    category_counts,
    category_index,
    category_stages,
    filled_slots,
    slot_count,
    slot_value,
)
from velotide.plans.gold import encoded_features, run_gold


@pytest.fixture(scope="module")
def visits(spark):
    table = [("b", 1)] * 3 + [("a", 2)] * 3 + [("é", 1)] * 2 + [("", 3), ("z", 2), (None, 1)]
    return spark.createDataFrame(table, "station string, hour int").persist()


def _labels(index):
    return [list(i.labels) for i in index]


def _slots(df, index, column):
    return Pipeline(stages=category_stages(index)).fit(df), vector_to_array(column)


def test_counts_leave_nulls_out(visits):
    assert rows(category_counts(visits, ["station"])) == sorted(
        [("station", "b", 3), ("station", "a", 3), ("station", "é", 2), ("station", "", 1), ("station", "z", 1)], key=repr)


def test_most_frequent_first_ties_by_code_point(visits):
    index = category_index(visits, ["station", "hour"])
    assert _labels(index) == [["a", "b", "é", "", "z"], ["1", "2", "3"]]
    assert _labels(category_index(visits.repartition(5), ["station"])) == [["a", "b", "é", "", "z"]]


def test_rare_unseen_and_null_values_share_the_last_slot(spark, visits):
    index = category_index(visits, ["station"], min_rows=2)
    model, slots = _slots(visits, index, "raw_categories")
    new = spark.createDataFrame([("a",), ("é",), ("z",), ("new",), (None,)], "station string")
    got = {r.station: r.v for r in model.transform(new).select("station", slots.alias("v")).collect()}
    last = [0, 0, 0, 1]
    assert got == {"a": [1, 0, 0, 0], "é": [0, 0, 1, 0], "z": last, "new": last, None: last}


def test_slots_are_divided_by_their_deviation(visits):
    index = category_index(visits, ["station", "hour"], min_rows=2)
    model, _ = _slots(visits, index, "raw_categories")
    scaled = model.transform(visits)
    assert type(scaled.first().scaled_categories).__name__ == "SparseVector"
    spread = scaled.select(F.posexplode(vector_to_array("scaled_categories"))).groupBy("pos").agg(F.stddev_samp("col").alias("s"))
    assert {round(r.s, 9) for r in spread.collect()} == {1.0}


def test_column_without_frequent_values(visits):
    model, slots = _slots(visits, category_index(visits, ["station"], min_rows=100), "raw_categories")
    assert {tuple(r.v) for r in model.transform(visits).select(slots.alias("v")).collect()} == {(1.0,)}


def test_empty_table_has_no_categories(visits):
    assert _labels(category_index(visits.limit(0), ["station", "hour"])) == [[], []]


def test_too_many_categories_and_bad_settings_are_refused(visits):
    with pytest.raises(ValueError, match="station has more than 4"):
        category_index(visits, ["station", "hour"], max_categories=4)
    assert len(_labels(category_index(visits, ["station"], max_categories=5))[0]) == 5
    with pytest.raises(ValueError, match="min_rows"):
        category_index(visits, ["station"], min_rows=0)
    with pytest.raises(ValueError, match="no categorical"):
        category_index(visits, [])


@pytest.fixture(scope="module")
def silver(spark):
    table = [(f"{i % 3}.10", f"2026-01-01 {i % 24:02d}:00:00", i, i % 5, i % 24, i * 0.5) for i in range(48)]
    return hours(spark, table, "station_id string, event_hour string, bike_demand int, dock_demand int, hour int, temp_c double")


@pytest.mark.parametrize(("k", "numeric"), [(0, 1), (1, 1)])
def test_gold_holds_numbers_then_slots(silver, k, numeric):
    table, _ = encoded_features(silver, ["station_id", "hour"], k)
    assert table.columns == ["station_id", "event_hour", "encoded_features", "bike_demand", "dock_demand"]
    assert {r.encoded_features.size for r in table.collect()} == {numeric + 4 + 25}


def test_saved_steps_encode_new_stations(spark, silver, tmp_path):
    silver.write.parquet(str(tmp_path / "silver"))
    run_gold(spark, str(tmp_path / "silver"), str(tmp_path / "gold"), str(tmp_path / "model"), 0, ["station_id"])
    steps = PipelineModel.load(str(tmp_path / "model"))
    array = vector_to_array("encoded_features").alias("v")
    again = rows(steps.transform(silver).select("station_id", "event_hour", array))
    assert again == rows(spark.read.parquet(str(tmp_path / "gold")).select("station_id", "event_hour", array))
    new = steps.transform(silver.withColumn("station_id", F.lit("new"))).select(vector_to_array("raw_categories").alias("v"))
    assert {tuple(r.v) for r in new.collect()} == {(0.0, 0.0, 0.0, 1.0)}


def test_slots_are_read_from_sparse_and_dense_vectors(spark):
    vectors = [Vectors.sparse(10**9, [3, 7, 10**9 - 1], [0.5, 0.0, 2.0]), Vectors.dense(0.0, 0.5, 0.0, 2.0), Vectors.sparse(4, [], [])]
    table = spark.createDataFrame([(v,) for v in vectors], ["v"]).withColumn("filled", filled_slots("v"))
    values = [slot_value("v", F.get("filled", F.lit(i))) for i in (0, 1)]
    got = [tuple(r) for r in table.select(slot_count("v"), "filled", *values, slot_value("v", F.lit(2))).collect()]
    assert got == [(10**9, [3, 10**9 - 1], 0.5, 2.0, 0.0), (4, [1, 3], 0.5, 2.0, 0.0), (4, [], 0.0, 0.0, 0.0)]


def test_many_frequent_categories_are_all_kept(spark):
    many = spark.range(60_000).select(F.col("id").cast("string").alias("station"))
    assert len(_labels(category_index(many, ["station"]))[0]) == 60_000
