"""Scalar goldens (values stated by the source system) and edge values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewright.functions import (
    date_int_to_date,
    decode_dimension,
    decode_metric,
    fill_rate_percent,
    month_label,
    month_year_to_date,
    normalise_age,
    normalise_gender,
    ratio,
    serve_rate_percent,
    split_group_age,
    split_group_gender,
    to_float64,
    to_int64,
    to_text,
    yesterday,
)
from slicewright.functions.dates import py_month_year


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("v")).collect()]


@pytest.mark.parametrize("value,expected", [
    (1510, dt.date(2025, 11, 1)), (1511, dt.date(2025, 12, 1)), (1512, dt.date(2026, 1, 1)),
    (1600, dt.date(2026, 1, 1)), (0, dt.date(2010, 1, 1)), (-1191, dt.date(1998, 10, 1)),
    (1599, dt.date(2033, 4, 1)), (-1398, dt.date(1996, 3, 1)),
])
def test_month_year_golden(spark, value, expected):
    assert one(spark, month_year_to_date("v"), [(value,)], "v bigint") == [expected]
    assert one(spark, month_year_to_date("v"), [(str(value),)], "v string") == [expected]
    assert py_month_year(value) == expected


def test_date_int_golden(spark):
    assert one(spark, date_int_to_date("v"), [(20251125,), (None,)], "v bigint") == [dt.date(2025, 11, 25), None]
    assert one(spark, date_int_to_date("v"), [("20240229",)], "v string") == [dt.date(2024, 2, 29)]


def test_date_int_bad_month_raises(spark):
    with pytest.raises(Exception):
        one(spark, date_int_to_date("v"), [(20251325,)], "v bigint")


def test_to_int64_text(spark):
    texts = ["1234", " 4 ", "1e3", "-", "N/A", "1,000", "", "1.5", "2.0", "nan", "9007199254740993", None]
    got = one(spark, to_int64("v"), [(t,) for t in texts], "v string")
    assert got == [1234, 4, 1000, None, None, None, None, None, 2, None, 9007199254740993, None]


def test_to_int64_numbers(spark):
    got = one(spark, to_int64("v", T.DoubleType()), [(3.0,), (3.5,), (float("nan"),), (None,)], "v double")
    assert got == [3, None, None, None]
    assert one(spark, to_int64("v", T.LongType()), [(7,), (None,)], "v bigint") == [7, None]


def test_to_float64(spark):
    got = one(spark, to_float64("v"), [("0.25",), ("-",), ("nan",), ("1e2",), (None,)], "v string")
    assert got == [0.25, None, None, 100.0, None]
    assert one(spark, to_float64("v", T.LongType()), [(3,)], "v bigint") == [3.0]


def test_to_text_keeps_null(spark):
    assert one(spark, to_text("v", T.LongType()), [(0,), (None,)], "v bigint") == ["0", None]


CELL = T.StructType([T.StructField("string_value", T.StringType()), T.StructField("int_value", T.LongType())])
MCELL = T.StructType([T.StructField("double_value", T.DoubleType()), T.StructField("int_value", T.LongType())])


def test_decode_dimension(spark):
    schema = T.StructType([T.StructField("c", CELL)])
    data = [(("Sports", 0),), (("", 0),), (("", 20251125),), ((None, None),), (None,)]
    assert one(spark, decode_dimension(F.col("c")), data, schema) == ["Sports", "0", "20251125", "0", None]


def test_decode_metric(spark):
    schema = T.StructType([T.StructField("c", MCELL)])
    data = [((0.0, 42),), ((0.75, 0),), ((0.0, 0),), (None,)]
    assert one(spark, decode_metric(F.col("c")), data, schema) == ["42", "0.75", "0", None]


def test_kpi_goldens(spark):
    row = spark.createDataFrame([(98000, 125000, 150000), (5, 5, 0)],
                                "ad_server_impressions bigint, code_served_count bigint, ad_requests bigint")
    got = row.select(fill_rate_percent().alias("f"), serve_rate_percent().alias("s")).collect()
    assert round(got[0]["f"], 2) == 65.33 and round(got[0]["s"], 2) == 83.33
    assert got[1]["f"] is None and got[1]["s"] is None
    assert one(spark, ratio("a", "b"), [(1, 4)], "a bigint, b bigint") == [0.25]


def test_month_label_and_yesterday(spark):
    assert one(spark, month_label("d"), [(dt.date(2025, 11, 1),)], "d date") == ["November 2025"]
    # 23:30 UTC on Jan 31 is already Feb 1 in Paris: yesterday is Jan 31.
    ts = dt.datetime(2025, 1, 31, 23, 30)
    assert one(spark, yesterday(F.col("t"), "Europe/Paris"), [(ts,)], "t timestamp") == [dt.date(2025, 1, 31)]


def test_demographics(spark):
    data = [("MALE_18_24",), ("FEMALE_65_PLUS",), ("junk",)]
    assert one(spark, split_group_gender("g"), data, "g string") == ["MALE", "FEMALE", None]
    assert one(spark, split_group_age("g"), data, "g string") == ["18-24", "65+", None]
    assert one(spark, normalise_gender("g"), [("Homme",), ("Femme",), ("0",), ("MALE",), (None,)], "g string") \
        == ["Male", "Female", "Unknown", "Male", "Unknown"]
    assert one(spark, normalise_age("a"), [("25-34",), ("0",), ("65+",), (None,)], "a string") \
        == ["25-34", "Unknown", "65+", "Unknown"]


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace

    from slicewright.session import checkpoint_dir

    def session(master, **conf):
        made = []
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: made[-1] if made else None, setCheckpointDir=made.append)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, *d: conf.get(k.replace(".", "_"), *d)))

    assert checkpoint_dir(session("spark://host:7077", spark_checkpoint_dir="hdfs://shared/c")) == "hdfs://shared/c"
    assert checkpoint_dir(session("local[4]", spark_sql_warehouse_dir="/w/")) == "/w/_checkpoints"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(session("spark://host:7077", spark_sql_warehouse_dir="file:/one/machine"))
