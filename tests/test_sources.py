import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from sensorloom.session import freeze, shared_dir
from sensorloom.sources import readings as r
from sensorloom.sources import store

from conftest import START


@pytest.fixture
def folder(tmp_path_factory):
    return str(tmp_path_factory.mktemp("data"))


def csv(folder, text):
    path = f"{folder}/{uuid.uuid4().hex}.csv"
    with open(path, "w") as f:
        f.write(text)
    return path


def test_both_header_sets(spark, folder):
    one = csv(folder, "time,EquipmentUnit,System,Oxygen[%sat]\n2024-01-01T00:00:00Z,EQ1,A,95.4\n2024-01-01T00:01:00Z,,A,\n")
    two = csv(folder, "timestamp,equipment_id,system_id,oxygen_saturation\n2024-01-01T00:00:00Z,EQ1,A,95.4\n")
    got = r.read_readings(spark, one).orderBy("time").collect()
    assert [(x.time, x.entity_id, x.value) for x in got] == [
        (START, "EQ1_A", 95.4),
        (START + dt.timedelta(minutes=1), "nan_A", None),
    ]
    assert r.read_readings(spark, one, drop_nulls=True).count() == 1
    assert r.read_readings(spark, two).first().entity_id == "EQ1_A"


def test_time_forms(spark):
    forms = {
        "2024-01-01T00:00:00Z": START,
        "2024-01-01T02:00:00+02:00": START,
        "2024-01-01 00:00:00": START,
        "2024-01-01T00:00:00.123456789Z": START + dt.timedelta(microseconds=123456),
        "2024/01/01 00:00:00": START,
        "1/1/2024 0:00:00": START,
        "01-Jan-2024 00:00:00": START,
        "2024-01-01": START,
        "soon": None,
    }
    df = spark.createDataFrame([(k,) for k in forms], "t string").withColumn("p", r.parse_time(F.col("t")))
    assert {x.t: x.p for x in df.collect()} == forms
    with pytest.raises(r.InputError):
        r.check_times(df.select(F.col("p").alias("time")))


def test_bad_inputs(spark, folder):
    with pytest.raises(r.InputError):
        r.read_readings(spark, f"{folder}/missing.csv")
    bare = csv(folder, "time,Oxygen[%sat]\n2024-01-01T00:00:00Z,n/a\n")
    with pytest.raises(r.InputError):
        r.read_readings(spark, bare)
    got = r.read_readings(spark, bare, global_if_missing=True).first()
    assert (got.entity_id, got.value) == ("global", None)
    with pytest.raises(r.InputError):
        r.read_readings(spark, csv(folder, "time,EquipmentUnit,System\n2024-01-01,a,b\n"))
    with pytest.raises(r.InputError):
        r.require_rows(spark.createDataFrame([], "a int"), "test")


def test_parquet_source(spark, folder):
    spark.createDataFrame([(START, "E", "S", 1.5)], "time timestamp, equipment_id string, System string, oxygen_saturation double").write.parquet(
        f"{folder}/p"
    )
    got = r.read_readings(spark, f"{folder}/p", "parquet").first()
    assert (got.entity_id, got.value, got.time) == ("E_S", 1.5, START)


def test_frozen_tables_live_in_the_shared_folder(spark):
    frozen = freeze(spark.range(5).toDF("x"), "t")
    assert frozen.count() == 5
    assert shared_dir(spark).replace("file:", "") in frozen.inputFiles()[0].replace("file://", "").replace("file:", "")


def rows(spark, split, entity, n, extra=0.0):
    data = [(entity, split, START + dt.timedelta(minutes=i), i + extra) for i in range(n)]
    return spark.createDataFrame(data, "entity_id string, split string, window_start timestamp, mean double")


def test_feature_store(spark, folder):
    path = f"{folder}/features"
    assert store.stored_entities(spark, path).count() == 0
    with pytest.raises(r.InputError):
        store.read_features(spark, path)
    store.write_features(rows(spark, "train", "b", 5).union(rows(spark, "test", "b", 2)).union(rows(spark, "test", "c", 2)), path)
    store.write_features(rows(spark, "train", "a", 3), path)
    assert [x.entity_id for x in store.stored_entities(spark, path).collect()] == ["a", "b"]
    wanted = spark.createDataFrame([("a",), ("c",)], "entity_id string")
    missing, existing = store.check_features(spark, path, wanted)
    assert ([x[0] for x in missing.collect()], [x[0] for x in existing.collect()]) == (["c"], ["a"])
    assert store.read_features(spark, path, "test").count() == 4
    store.write_features(rows(spark, "train", "a", 4, 0.5), path)
    got = store.read_features(spark, path, "train", "a")
    assert got.count() == 4 and got.agg(F.min("mean")).first()[0] == 0.5
    assert store.read_features(spark, path, "train", "b").count() == 5


def test_numeric_series_names_stay_text(spark, folder):
    path = f"{folder}/features"
    store.write_features(rows(spark, "train", "12", 2), path)
    assert store.read_features(spark, path, "train", "12").first().entity_id == "12"
    assert dict(store.stored_entities(spark, path).dtypes)["entity_id"] == "string"


def test_combine_fills_missing_columns(spark):
    both = store.combine(spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2, 3)], "a int, b int"))
    assert sorted((x.a, x.b) for x in both.collect()) == [(1, None), (2, 3)]


def test_files_may_differ_in_headers_and_order(spark, folder, tmp_path):
    (tmp_path / "a.csv").write_text("time,EquipmentUnit,System,Oxygen[%sat]\n2024-01-01T00:00:00Z,E1,S1,90\n")
    (tmp_path / "b.csv").write_text("System,Oxygen[%sat],time,EquipmentUnit\nS2,91,2024-01-01T00:01:00Z,E2\n")
    (tmp_path / "c.csv").write_text("oxygen_saturation,system_id,equipment_id,timestamp,note\nNaN,S3,E3,2024-01-01T00:02:00Z,x\n")
    (tmp_path / "d.csv").write_text("")
    got = r.read_readings(spark, str(tmp_path)).orderBy("time").collect()
    assert [(x.entity_id, x.value) for x in got] == [("E1_S1", 90.0), ("E2_S2", 91.0), ("E3_S3", None)]
    assert got[2].time == START + dt.timedelta(minutes=2)


def test_keys_do_not_depend_on_how_files_are_split(spark, tmp_path):
    lines = [f"2024-01-01T00:{i // 60:02d}:{i % 60:02d}Z,E{i % 3},S,{90 + i % 7}" for i in range(2000)]
    (tmp_path / "a.csv").write_text("time,EquipmentUnit,System,Oxygen[%sat]\n" + "\n".join(lines) + "\n")
    keys = lambda: sorted((x.entity_id, x.time, x.row_key) for x in r.read_readings(spark, str(tmp_path)).collect())
    whole = keys()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert keys() == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_values_that_are_no_numbers_are_null(spark, tmp_path):
    rows = ["NaN", "nan", "inf", "-Infinity", "n/a", "", "1e400", "91.5"]
    (tmp_path / "a.csv").write_text("time,Oxygen[%sat]\n" + "".join(f"2024-01-01T00:0{i}:00Z,{v}\n" for i, v in enumerate(rows)))
    got = r.read_readings(spark, str(tmp_path), global_if_missing=True).orderBy("time").collect()
    assert [x.value for x in got] == [None] * 7 + [91.5]
    numbers = spark.createDataFrame([(START, float("nan")), (START, float("inf")), (START, 2.0)], "time timestamp, value double")
    assert sorted((x.value for x in r.typed(numbers, global_if_missing=True).collect()), key=str) == [2.0, None, None]


def test_a_time_filter_reaches_parquet(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([(START, "E", "S", 1.0)], "time timestamp, equipment_id string, system_id string, oxygen_saturation double").write.parquet(path)
    readings = r.read_readings(spark, path, "parquet").where("time > timestamp'2024-01-01 00:00:00'")
    plan = readings._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(time" in plan
