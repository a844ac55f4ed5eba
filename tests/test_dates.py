import pytest
from pyspark.sql import functions as F

from tabkit.operators import profiling


@pytest.mark.parametrize(
    "text, hour",
    [("3/7/2024", 0), ("03/07/2024", 0), ("3/7/2024 9:05", 9), ("12/31/2024 11:59 PM", 23), ("2024-03-07 10:11:12.345", 10), ("2024", None), ("7.5", None)],
)
def test_spellings_of_dates(spark, text, hour):
    got = spark.createDataFrame([(text,)], "d string").select(F.hour(profiling.parse_date(F.col("d")))).first()[0]
    assert got == hour


@pytest.mark.parametrize(
    "text, stamp",
    [
        ("2024-03-07", "2024-03-07 00:00:00"), ("2024/3/7 9:05", "2024-03-07 09:05:00"), ("2024.03.07T10:11:12", "2024-03-07 10:11:12"),
        ("2024-03-07T10:11:12.345Z", "2024-03-07 10:11:12.345"), ("2024-03-07 10:11:12+02:00", "2024-03-07 08:11:12"), ("2024-03-07 10:11 -0130", "2024-03-07 11:41:00"),
        ("7.3.2024", "2024-03-07 00:00:00"), ("13/12/2024", "2024-12-13 00:00:00"), ("12-13-2024", "2024-12-13 00:00:00"), ("3/7/2024 12:00 am", "2024-03-07 00:00:00"),
        ("7 Mar 2024", "2024-03-07 00:00:00"), ("7-mar-2024 23:59:59", "2024-03-07 23:59:59"), ("Thursday, 7 March 2024", "2024-03-07 00:00:00"), ("7th Sept. 2024", "2024-09-07 00:00:00"),
        ("March 7, 2024", "2024-03-07 00:00:00"), ("Mar 7 2024 1:02 PM GMT", "2024-03-07 13:02:00"), ("Thu Mar 7 2024", "2024-03-07 00:00:00"),
        ("2024-13-01", None), ("2024-02-30", None), ("30/31/2024", None), ("2024-03/07", None), ("7 Foo 2024", None), ("3/7/2024 13:00 PM", None), ("2024-03-07 25:00", None),
        ("2024-03-07 noon", None), ("1-2-3", None), ("", None), (None, None), ("20240307", None), ("Foo, 7 March 2024", None),
    ],
)
def test_date_grammar(spark, text, stamp):
    rows = spark.createDataFrame([(text,)], "d string").select(profiling.parse_date(F.col("d")).cast("string"))
    assert rows.first()[0] == stamp
