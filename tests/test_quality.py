import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallyloom.operators import quality as Q
from tallyloom.sources import readers as R

RUNS = "order_id int, runner_id int, pickup_time string, distance string, duration string, cancellation string"
RETAIL = "invoice string, description string, quantity int, invoice_date timestamp_ntz, price double, customer_id long, country string"
T0 = dt.datetime(2010, 1, 5, 10, 0)


def test_distances(frame):
    dirty = ["7km", "0.8 km", "31.25km", "6", "km", "null", None, "", " 4.0 km"]
    df = frame([(i, 1, None, d, None, None) for i, d in enumerate(dirty)], RUNS)
    text = [r["distance"] for r in Q.clean_runner_orders(df, typed=False).orderBy("order_id").collect()]
    assert text == ["7", "0.8", "31.25", "6", "", None, None, "", "4.0"]
    typed = [r["distance"] for r in Q.clean_runner_orders(df).orderBy("order_id").collect()]
    assert [None if v is None else float(v) for v in typed] == [7, 0.8, 31.25, 6, None, None, None, None, 4]


def test_durations_lose_the_dot_unless_kept(frame):
    df = frame([(1, 1, None, None, "6.5 minutes", None), (2, 1, None, None, "41 mins", None)], RUNS)
    assert [float(r["duration"]) for r in Q.clean_runner_orders(df).orderBy("order_id").collect()] == [65, 41]
    assert [float(r["duration"]) for r in Q.clean_runner_orders(df, duration_keep="0-9.").orderBy("order_id").collect()] == [6.5, 41]


def test_null_tokens_and_bad_times(frame):
    df = frame([(1, 1, "null", None, None, ""), (2, 1, "2022-07-09 05:06:07", None, None, "null"), (3, 1, "soon", None, None, "NaN"), (4, 1, None, None, None, "late")], RUNS)
    got = Q.clean_runner_orders(df).orderBy("order_id").collect()
    assert [r["cancellation"] for r in got] == [None, None, None, "late"]
    assert [r["pickup_time"] for r in got] == [None, dt.datetime(2022, 7, 9, 5, 6, 7), None, None]
    rejected = Q.rejected_rows(df.filter("pickup_time <> 'null'"), "pickup_time", F.try_to_timestamp("pickup_time"))
    assert [r["order_id"] for r in rejected.collect()] == [3]


def retail(frame):
    return frame(
        [
            ("1", "mug", 2, T0, 3.0, 7, "EIRE"),
            ("1", "mug", 2, T0, 3.0, 7, "EIRE"),
            ("1", "mug", 2, T0, 3.0, None, "EIRE"),
            ("1", "mug", 2, T0, 3.0, None, "EIRE"),
            ("C2", "mug", -2, T0, 3.0, 7, "France"),
            ("3", None, -5, T0, 0.0, None, "France"),
            ("4", "debt", 1, T0, -9.0, None, "France"),
            ("5", "gift", 1, T0, 0.0, 8, "France"),
            ("6", "cup", None, T0, 1.0, 8, "France"),
        ],
        RETAIL,
    ).withColumn("price", F.col("price").cast("decimal(10,2)"))


def test_duplicates_missing_and_audit(frame, rows):
    df = retail(frame)
    assert rows(Q.duplicate_count(df)) == [(2,)]
    assert Q.drop_duplicates(df).count() == df.count() - 2
    missing = dict(rows(Q.null_report(df)))
    assert missing == {"invoice": 0, "description": 1, "quantity": 1, "invoice_date": 0, "price": 0, "customer_id": 4, "country": 0}
    assert {r["column_name"]: (r["data_type"], r["non_null"]) for r in Q.schema_profile(df).collect()}["customer_id"] == ("bigint", 5)
    assert rows(Q.cancellation_audit(df)) == [(2, False, 1)]
    assert rows(Q.cancellation_violators(df), "invoice") == [("3",)]
    assert rows(Q.cancellation_audit(df.filter("invoice = 'C2'"))) == [(1, True, 0)]
    assert rows(Q.cancellation_audit(df.limit(0))) == [(0, True, 0)]


def test_cleaning(frame, rows):
    cleaned = Q.clean_transactions(retail(frame))
    assert rows(cleaned.withColumn("revenue", F.col("revenue").cast("double")), "invoice", "customer_id", "country", "revenue") == [
        ("1", 7, "Ireland", 6.0),
        ("1", None, "Ireland", 6.0),
    ]


def test_keyword_exclusion(frame, rows):
    df = frame([("Manual",), ("dotcom postage",), ("POSTAGE",), ("mug",), (None,), ("a.b",)], "description string")
    assert rows(Q.exclude_keywords(df)) == [("a.b",), ("mug",), (None,)]
    assert rows(Q.exclude_keywords(df, keywords=["a.b", "mug"]), "description") == [("Manual",), ("POSTAGE",), ("dotcom postage",), (None,)]


RATINGS = [(k, 300 + k * 7 % 5, 40 + k % 4, 1 + k % 5) for k in range(1, 7)]


def test_rating_rules(frame, spark, rows):
    schema = "order_id int, customer_id int, runner_id int, rating int"
    good = frame(RATINGS, schema)
    assert rows(Q.violations(good, "order_id", Q.rating_rules())) == []
    bad = R.append_rows(good, frame([(1, 1, 1, 1), (20, None, 1, 1), (21, 1, 1, 6), (22, 1, 1, None)], schema))
    assert rows(Q.violations(bad, "order_id", Q.rating_rules()), "rule", "key", "rows") == [
        ("customer_id is missing", "20", 1),
        ("order_id is repeated", "1", 2),
        ("rating is missing", "22", 1),
        ("rating is out of range", "21", 1),
    ]


def test_declared_ratings_and_default_time(spark):
    df = R.inline(spark, [(*r, None) for r in RATINGS], R.RATINGS_SCHEMA)
    assert not df.schema["rating"].nullable
    filled = Q.with_default_time(df, "rating_time")
    assert filled.filter("rating_time is null").count() == 0
    fixed = Q.with_default_time(df, "rating_time", F.lit("2020-01-01 00:00:00").cast("timestamp_ntz"))
    assert {r["rating_time"] for r in fixed.collect()} == {dt.datetime(2020, 1, 1)}


def test_csv_by_header_names(spark, tmp_path, rows):
    path = tmp_path / "lines.csv"
    path.write_text(
        'Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n1,x,"mug, ""blue""",2,2010-01-05 10:00:00,3.50,9007199254740993.0,France\n2,y,,many,later,1.00,,France\n'
    )
    df = R.read_csv(spark, str(path), R.RETAIL_FILE)
    assert df.columns == [name for name, _ in R.RETAIL_FILE.values()]
    assert rows(df, "invoice", "description", "quantity", "customer_id") == [("1", 'mug, "blue"', 2, 9007199254740993), ("2", None, None, None)]
    R.write_table(df, str(tmp_path / "out"), ["country"])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    assert [r["invoice"] for r in R.preview(df, 1, "invoice").collect()] == ["1"]
    with pytest.raises(AnalysisException):
        R.read_csv(spark, str(path), {"No such name": ("x", "string")})


def test_quality_report(frame, rows):
    got = dict(rows(Q.quality_report(retail(frame))))
    assert got["duplicate rows"] == 2 and got["missing customer_id"] == 4
    assert got["negative quantity"] == 2 and got["negative quantity without prefix"] == 1
