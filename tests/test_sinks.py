from datetime import date

from pyspark.sql import functions as F

from firmlens.session import scratch_path
from firmlens.sources import readers, sinks


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_insert_ignore_twice(spark):
    path = scratch_path(spark, "t")
    first = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0)], "id int, part string, v double")
    more = spark.createDataFrame([(2, "a", 9.0), (3, "b", 3.0), (3, "b", 4.0)], "id int, part string, v double")
    for _ in range(2):
        sinks.insert_ignore(first, path, ["id", "part"], [F.col("v").asc()], ["part"])
        sinks.insert_ignore(more, path, ["id", "part"], [F.col("v").asc()], ["part"])
    assert _rows(spark.read.parquet(path).select("id", "part", "v")) == [(1, "a", 1.0), (2, "a", 2.0), (3, "b", 3.0)]


def test_upsert_twice_equals_once(spark):
    path = scratch_path(spark, "t")
    old = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0), (5, "c", 5.0)], "id int, part string, v double")
    new = spark.createDataFrame([(2, "a", None), (3, "b", 3.0)], "id int, part string, v double")
    order = [F.col("v").desc()]
    sinks.upsert(old, path, ["id", "part"], ["part"], order)
    for _ in range(2):
        sinks.upsert(new, path, ["id", "part"], ["part"], order)
    got = {r.id: (r.part, r.v) for r in spark.read.parquet(path).collect()}
    # A new NULL overwrites; the untouched partition stays.
    assert got == {1: ("a", 1.0), 2: ("a", None), 3: ("b", 3.0), 5: ("c", 5.0)}


def test_load_guard_knows_economies(spark):
    path = scratch_path(spark, "t")
    rows = spark.createDataFrame([(1, 2, date(2024, 1, 1)), (2, 3, date(2024, 1, 1))], "id int, econ int, task_date date")
    guard = ["task_date", "econ"]
    sinks.append_if_not_loaded(rows.where("econ = 2"), path, guard, ["task_date"])
    sinks.append_if_not_loaded(rows, path, guard, ["task_date"])
    sinks.append_if_not_loaded(rows, path, guard, ["task_date"])
    assert _rows(spark.read.parquet(path).select("id")) == [(1,), (2,)]


def test_dimension_ids_are_stable(spark):
    names = lambda *ns: spark.createDataFrame([(n,) for n in ns], "name string")
    one = sinks.with_new_names(names("b", "a", "b"), None, "id", "name")
    two = sinks.with_new_names(names("c", "a"), one, "id", "name")
    assert _rows(two.select("id", "name")) == [(1, "a"), (2, "b"), (3, "c")]


def test_missing_table_is_none(spark):
    assert sinks.read_if_exists(spark, scratch_path(spark, "nothing")) is None


def test_economy_from_file_name(spark, tmp_path):
    for name in ("merged_output_7_202508.csv", "merged_output_12_202508.csv", "plain.csv"):
        (tmp_path / name).write_text("id,x\n1,2.5\n2,\n")
    df = readers.read_economy_files(spark, str(tmp_path / "*.csv"), "id int, x double")
    assert _rows(df.groupBy("econ").count()) == [("12", 2), ("7", 2)]
    last = readers.read_economy_files(spark, str(tmp_path / "merged*.csv"), "id int, x double", position=None)
    assert {r.econ for r in last.collect()} == {"202508"}


def test_cube_rows(spark):
    cube = [[[1.0, 2.0], [10.0, 20.0]], [[3.0, 4.0], [30.0, 40.0]]]  # firm x variable x month
    df = spark.createDataFrame([(cube,)], "cube array<array<array<double>>>")
    out = readers.explode_cube(df, "cube", ["a", "b"])
    assert _rows(out) == [(0, 0, 1.0, 10.0), (0, 1, 2.0, 20.0), (1, 0, 3.0, 30.0), (1, 1, 4.0, 40.0)]
