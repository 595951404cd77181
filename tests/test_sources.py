import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import bag
from tripmill import scratch
from tripmill.schema import TRIP_SCHEMA, SchemaError, check
from tripmill.sources.trips import load_trips, read_trips, trips_table
from tripmill.sources.zones import CHICAGO_ZONES, chicago_zones, read_zones


def test_parquet_glob_and_formats(spark, make_trips, tmp_path):
    trips = make_trips({}, {"unique_key": "b"})
    trips.repartition(2).write.parquet(f"{tmp_path}/raw")
    assert bag(read_trips(spark, f"{tmp_path}/raw/*.parquet")) == bag(trips)
    assert bag(load_trips(spark, "parquet", path=f"{tmp_path}/raw")) == bag(trips)
    trips.createOrReplaceTempView("some_trips")
    assert bag(trips_table(spark, "some_trips")) == bag(trips)


def test_unreadable_path_is_fatal(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_trips(spark, f"{tmp_path}/nothing/*.parquet")


def test_missing_and_mistyped_columns_fail_before_any_job(spark, make_trips):
    bad = make_trips({}).drop("tips").withColumn("trip_miles", F.lit("far"))
    with pytest.raises(SchemaError, match="trip_miles is string.*tips is missing"):
        check(bad, TRIP_SCHEMA)


def test_narrower_numbers_and_zoneless_times_are_accepted(make_trips):
    trips = make_trips({}).withColumns({
        "trip_seconds": F.col("trip_seconds").cast("int"),
        "trip_start_timestamp": F.col("trip_start_timestamp").cast("timestamp_ntz"),
    })
    assert check(trips, TRIP_SCHEMA) is trips


def test_packaged_zones(spark):
    rows = chicago_zones(spark).collect()
    assert [r.id_dzielnicy for r in rows] == list(range(1, 78))
    assert len(set(CHICAGO_ZONES)) == 77
    assert rows[0].nazwa_dzielnicy == "Rogers Park"
    assert rows[31].nazwa_dzielnicy == "Loop"
    assert rows[75].nazwa_dzielnicy == "O'Hare"


def test_zone_seed_roundtrip(spark, tmp_path):
    chicago_zones(spark).write.option("header", True).csv(f"{tmp_path}/seed")
    assert bag(read_zones(spark, f"{tmp_path}/seed")) == bag(chicago_zones(spark))


def test_zone_seed_with_other_header_fails(spark, tmp_path):
    (tmp_path / "seed.csv").write_text("id,name\n1,Rogers Park\n")
    with pytest.raises(Exception, match="header"):
        read_zones(spark, f"{tmp_path}/seed.csv").collect()


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch.scratch_dir(spark), scratch.scratch_dir(spark)
    assert first.startswith(shared) and first != second


def test_scratch_off_one_machine_needs_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()
        sparkContext = type(
            "C", (), {"master": "spark://host:7077", "getCheckpointDir": lambda self: None}
        )()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_dir(Session())
