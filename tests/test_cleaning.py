import pytest
from pyspark.sql import functions as F

from roadfeat.functions import clean
from roadfeat.sources import places
from roadfeat.sources.tables import read_table, write_table


def test_numbers_take_only_decimals(spark):
    texts = ["1", " 2.5 ", "-.5", "1e3", "1d", "0x1p3", "NaN", "inf", "abc", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r[0] for r in clean.with_numbers(df, ["v"]).collect()]
    assert got == [1.0, 2.5, -0.5, 1000.0, None, None, None, None, None, None, None]


def test_typed_nan_is_missing(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (None,)], "v double")
    assert [r[0] for r in clean.with_numbers(df, ["v"]).collect()] == [1.5, None, None]


def test_white_space_of_any_kind_is_trimmed(spark):
    rows = [("가상정류장\t",), ("\u3000가상정류장",), ("\xa0 가상정류장\r\n",), ("가상 정류장",)]
    df = spark.createDataFrame(rows, "v string").select(clean.trimmed(F.col("v")).alias("v"))
    assert [r.v for r in df.collect()] == ["가상정류장"] * 3 + ["가상 정류장"]


def test_long_ids_keep_every_digit(spark):
    rows = [("9007199254740993",), (" 12\t",), ("12.0",), ("x",), (None,), ("99999999999999999999",)]
    df = spark.createDataFrame(rows, "v string").select(clean.to_long(F.col("v")).alias("v"))
    assert [r.v for r in df.collect()] == [9007199254740993, 12, 12, None, None, None]


def test_missing_column_fails_without_a_job(spark):
    with pytest.raises(ValueError, match="missing columns"):
        places.load_subway_stations(spark.createDataFrame([(1.0,)], "`경도` double"))


@pytest.mark.parametrize("encoding", ["cp949", "utf-8"])
def test_csv_encodings_and_missing_texts(spark, tmp_path, encoding):
    path = tmp_path / "t.csv"
    path.write_bytes("이름,값\n가로등,1\nN/A,2\n,3\n".encode(encoding))
    rows = read_table(str(path), ["이름", "값"], encoding=encoding).orderBy("값").collect()
    assert [r[0] for r in rows] == ["가로등", None, None]


def test_byte_order_mark(spark, tmp_path):
    path = tmp_path / "bom.csv"
    path.write_bytes("x_crdnt,y_crdnt\n1,2\n".encode("utf-8-sig"))
    assert read_table(str(path), ["x_crdnt"]).collect()[0][0] == "1"


def test_ids_of_a_number_column_compare_as_numbers(spark):
    numbers = spark.createDataFrame([("007",), ("7",), ("7.0",), (None,)], "id string")
    assert clean.canonical_ids(numbers, "id").select(F.count_distinct("id")).first()[0] == 1
    mixed = spark.createDataFrame([("007",), ("7",), ("A",)], "id string")
    assert clean.canonical_ids(mixed, "id").select(F.count_distinct("id")).first()[0] == 3


def test_swapped_and_out_of_range_coordinates(spark):
    rows = [("a", 37.5, 127.0), ("b", 127.0, 37.5), ("c", 0.0, 0.0), (None, 37.5, 127.0), ("e", None, 127.0)]
    df = spark.createDataFrame(rows, "`관리번호` string, `위도` double, `경도` double")
    got = sorted((r["관리번호"], r["y"], r["x"]) for r in places.load_streetlights(df).df.collect())
    assert got == [("a", 37.5, 127.0), ("b", 37.5, 127.0)]


def test_other_sources_do_not_repair(spark):
    df = spark.createDataFrame([(1, 127.0, 37.5)], "`고유역번호(외부역코드)` int, `위도` double, `경도` double")
    row = places.load_subway_stations(df).df.first()
    assert (row["x"], row["y"]) == (37.5, 127.0)


def test_virtual_stops_go_and_untyped_ones_stay(spark):
    rows = [("1", " 가상정류장 ", 127.0, 37.5), ("2", None, 127.0, 37.5), ("3", "일반", None, 37.5)]
    df = spark.createDataFrame(rows, "NODE_ID string, `정류소타입` string, `X좌표` double, `Y좌표` double")
    assert [r["NODE_ID"] for r in places.load_bus_stops(df).df.collect()] == ["2"]


def test_welfare_status_is_optional(spark):
    schema = "`시설ID` string, `경도` double, `위도` double"
    plain = spark.createDataFrame([("1", 127.0, 37.5), (None, 127.0, 37.5)], schema)
    assert places.load_geocoded_social_welfare_facilities(plain).df.count() == 2
    status = plain.withColumn("지오코딩상태", F.when(F.col("시설ID") == "1", "OK"))
    assert places.load_geocoded_social_welfare_facilities(status).df.count() == 1


def test_passengers_sum_per_stop_and_copies_count(spark):
    stops = spark.createDataFrame(
        [("100", "일반", 127.0, 37.5), ("100", "일반", 127.0, 37.5), ("x", "일반", 127.0, 37.5)],
        "NODE_ID string, `정류소타입` string, `X좌표` double, `Y좌표` double",
    )
    rides = spark.createDataFrame(
        [("20240101", "100", "3", "-"), ("20240102", "100", "4", "1"), ("20240102", "999", "9", "9")],
        "`사용일자` string, `표준버스정류장ID` string, `승차총승객수` string, `하차총승객수` string",
    )
    rows = places.load_bus_passenger_stops(stops, rides).df.collect()
    assert [(r["NODE_ID"], r["copies"], r["버스승하차총승객수"]) for r in rows] == [(100, 2, 8)]
    assert places.passenger_days(rides).first()["days"] == 2


def test_csv_sink_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(0, "길")], "POINT_ID long, `이름` string")
    write_table(df, str(tmp_path / "out.csv"), "csv")
    assert read_table(str(tmp_path / "out.csv"), ["POINT_ID", "이름"]).collect()[0]["이름"] == "길"
