import calendar
import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daybook.functions import dates

D = dt.date


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def spans(spark, rows):
    return spark.createDataFrame(rows, "low date, high date")


def test_date_series_edges(spark):
    rows = [(D(2024, 2, 27), D(2024, 3, 1)), (D(2024, 1, 1), D(2024, 1, 1)), (D(2024, 1, 2), D(2024, 1, 1))]
    found = [r[0] for r in spans(spark, rows).select(dates.date_series(F.col("low"), F.col("high"))).collect()]
    assert found[0] == [D(2024, 2, 27), D(2024, 2, 28), D(2024, 2, 29), D(2024, 3, 1)]
    assert found[1:] == [[D(2024, 1, 1)], []]


def next_month(day):
    year, month = (day.year + day.month // 12, day.month % 12 + 1)
    return D(year, month, min(day.day, calendar.monthrange(year, month)[1]))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.dates(D(1990, 1, 1), D(2030, 1, 1)), st.integers(-5, 1500)), min_size=20, max_size=60))
def test_month_ranges_cover_without_overlap(spark, starts):
    rows = [(low, low + dt.timedelta(days=n)) for low, n in starts]
    found = spans(spark, rows).select("low", "high", dates.month_ranges(F.col("low"), F.col("high")).alias("r"))
    for r in found.collect():
        expected, start = [], r["low"]
        while start <= r["high"]:
            end = min(next_month(start), r["high"])
            expected.append((start, end))
            start = next_month(start) + dt.timedelta(days=1)
        assert [tuple(p) for p in r["r"]] == expected
        if expected:
            assert expected[0][0] == r["low"] and expected[-1][1] == r["high"]
            for (_, end), (start, _) in zip(expected, expected[1:]):
                assert start == end + dt.timedelta(days=1)


def test_month_series(spark):
    rows = [(D(2020, 11, 30), D(2021, 2, 1)), (D(2020, 1, 5), D(2020, 1, 1)), (D(2020, 2, 1), D(2020, 1, 1))]
    found = [r[0] for r in spans(spark, rows).select(dates.month_series(F.col("low"), F.col("high"))).collect()]
    assert found == [["202011", "202012", "202101", "202102"], ["202001"], []]


def test_text_lists_agree_with_columns(spark):
    today = D(2024, 3, 2)
    days = one(spark, F.transform(dates.last_n_days(F.lit(today), 50), dates.day_key))
    assert days == dates.last_n_day_texts(today, 50) and days[-1] == "2024-03-01T00:00:00"
    assert dates.month_texts(D(2023, 12, 31), D(2024, 2, 1)) == ["202312", "202401", "202402"]
    assert dates.shift_month(D(2024, 1, 31), -2) == D(2023, 11, 1)


def test_request_windows(spark):
    w = one(spark, dates.request_windows(F.lit(D(2024, 1, 1)), F.lit(D(2024, 3, 1))))
    assert [tuple(x) for x in w] == [(D(2024, 1, 1), D(2024, 2, 29))]
    w = one(spark, dates.request_windows(F.lit(D(2024, 1, 1)), F.lit(D(2024, 3, 2))))
    assert [x["from_date"] for x in w] == [D(2024, 1, 1), D(2024, 3, 1)]
    assert one(spark, dates.request_windows(F.lit(D(2024, 1, 1)), F.lit(D(2024, 1, 1)))) == []


def test_helpers(spark):
    assert one(spark, dates.next_day_text(F.lit(2024), F.lit(2), F.lit(28))) == "2024-02-29"
    assert one(spark, dates.next_day_text(F.lit(2023), F.lit(12), F.lit(31))) == "2024-01-01"
    assert one(spark, dates.next_day_text(F.lit(2023), F.lit(2), F.lit(31))) == "2023-03-04"
    assert one(spark, dates.epoch_text(F.lit(""))) == "null"
    assert one(spark, dates.epoch_text(F.lit("1599846111"))) == "2020-09-11 17:41:51"
    assert one(spark, dates.add_days_text(F.lit("2024-02-28T00:00:00"), 2)) == "2024-03-01"
