from pyspark.sql import types as T

from tradelake.functions.geo import add_trip_distance

COLUMNS = ["tripduration", "starttime", "stoptime", "start_station_id", "start_station_name",
           "start_station_latitude", "start_station_longitude", "end_station_id",
           "end_station_name", "end_station_latitude", "end_station_longitude", "bikeid",
           "usertype", "birth_year", "gender"]

# start lat, start lon, end lat, end lon -> expected miles (golden values)
COORDS = [
    (40.69102925677968, -73.99183362722397, 40.6763947, -73.99869893, 1.07),
    (40.75724567911726, -73.97805914282799, 40.74444921, -73.98303529, 0.92),
    (40.75660359, -73.9979009, 40.73314259, -73.97573881, 1.99),
]


def _trips(spark):
    rows = [[300 + i, "2017-07-01 00:00:00", "2017-07-01 00:10:00", 100 + i, f"st {i}",
             c[0], c[1], 200 + i, f"end {i}", c[2], c[3], 9000 + i, "Subscriber", 1980 + i, 1]
            for i, c in enumerate(COORDS)]
    return spark.createDataFrame(rows, COLUMNS)


def test_distance_keeps_input_columns_and_schema(spark):
    trips = _trips(spark)
    out = add_trip_distance(trips)
    assert out.columns == COLUMNS + ["distance"]
    assert out.schema.fields[:-1] == trips.schema.fields
    assert out.schema["distance"] == T.StructField("distance", T.DoubleType(), True)


def test_distance_golden_values(spark):
    out = add_trip_distance(_trips(spark)).orderBy("tripduration")
    assert [r.distance for r in out.collect()] == [c[4] for c in COORDS]


def test_distance_null_coordinate_gives_null(spark):
    df = spark.createDataFrame([(None, 1.0, 2.0, 3.0)],
                               "a double, b double, c double, d double")
    out = add_trip_distance(df, "a", "b", "c", "d").collect()[0]
    assert out.distance is None


def test_trip_distance_job_round_trip(spark, tmp_path):
    from tradelake.plans.jobs import run_trip_distance
    src, out = str(tmp_path / "trips"), str(tmp_path / "with_distance")
    _trips(spark).write.parquet(src)
    run_trip_distance(spark, src, out)
    back = spark.read.parquet(out)
    assert back.columns == COLUMNS + ["distance"]
    assert sorted(r.distance for r in back.collect()) == sorted(c[4] for c in COORDS)
