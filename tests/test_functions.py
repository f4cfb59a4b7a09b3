"""Column expressions on edge rows."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st


from tidewell.functions import amounts, codes, dates, text


def column(spark, values, type_name, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_name}")
    return [r.out for r in rows.select("i", expression.alias("out")).orderBy("i").collect()]


def test_pad_code_keeps_the_right_end(spark):
    got = column(spark, ["12345", "12345678901", "9912345678901", "", None], "string", text.pad_code("v"))
    assert got == ["00000012345", "12345678901", "12345678901", "00000000000", None]


def test_valid_phone(spark):
    numbers = ["2125551234", "9995551234", "0001112222", "212555123", "1235551234", "  2125551 ", None, ""]
    got = column(spark, numbers, "string", text.valid_phone("v"))
    assert got == [True, False, False, False, False, False, False, False]


def test_text_tests_never_give_null(spark):
    assert column(spark, ["ab", "", None], "string", text.present("v")) == [True, False, False]
    assert column(spark, [" Paid ", "PAID", None], "string", text.eq_ci("v", "paid", strip=True)) == [True, True, None]
    assert column(spark, ["", "x", None], "string", text.blank_to("v", "none")) == ["none", "x", None]


def test_concat_skips_null_and_hash_collides_without_separator(spark):
    rows = spark.createDataFrame([("AB", "C"), ("A", "BC"), ("A", None)], "a string, b string")
    got = rows.select(text.concat_skip_null("a", "b").alias("t"), text.name_hash("a", "b").alias("h"),
                      text.name_hash("a", "b", sep="|").alias("s")).collect()
    assert [r.t for r in got] == ["ABC", "ABC", "A"]
    assert got[0].h == got[1].h and got[0].s != got[1].s


def test_date_or(spark):
    raw = ["2020-02-29", "2020-13-01", "", None, "2020", "02/28/2021", "20210301", "2021-02-30", "1/2/2020",
           "2021-03-04 00:00:00", "2021-3-4T10:20:30.5Z", "03/04/2021 1:05 PM", "2021-03-04x", "20210304 99"]
    got = column(spark, raw, "string", dates.date_or("v", date(1900, 1, 1)))
    blank = date(1900, 1, 1)
    assert got == [date(2020, 2, 29), blank, blank, blank, blank, date(2021, 2, 28), date(2021, 3, 1), blank, date(2020, 1, 2),
                   date(2021, 3, 4), date(2021, 3, 4), date(2021, 3, 4), blank, blank]
    stamped = column(spark, [datetime(2021, 3, 4, 5), None], "timestamp_ntz", dates.date_or("v", date(1900, 1, 1)))
    assert stamped == [date(2021, 3, 4), blank]
    assert column(spark, ["bad", None], "string", dates.date_or("v")) == [None, None]


def test_clamp_period(spark):
    rows = spark.createDataFrame([
        (date(2020, 3, 1), date(2020, 4, 1)),  # inside
        (date(2019, 3, 1), date(2021, 4, 1)),  # over both ends
        (date(2018, 3, 1), date(2019, 4, 1)),  # ended before the year: keeps its start
        (date(2021, 3, 1), date(2021, 4, 1)),  # starts after the year
        (date(2019, 3, 1), None)], "s date, e date")
    start, end = dates.clamp_period("s", "e", 2020)
    got = [tuple(r) for r in rows.select(start, end).collect()]
    assert got == [(date(2020, 3, 1), date(2020, 4, 1)), (date(2020, 1, 1), date(2020, 12, 31)),
                   (date(2018, 3, 1), date(2019, 4, 1)), (date(2021, 3, 1), date(2020, 12, 31)), (date(2019, 3, 1), None)]


def test_completed_age(spark):
    born = [date(2002, 7, 1), date(2002, 7, 2), date(2004, 2, 29), None]
    assert column(spark, born, "date", dates.completed_age("v", date(2020, 7, 1))) == [18, 17, 16, None]
    assert column(spark, born[2:3], "date", dates.completed_age("v", date(2022, 2, 28))) == [18]
    assert column(spark, born[2:3], "date", dates.completed_age("v", date(2022, 2, 27))) == [17]


def test_age_bands(spark):
    today = date(2020, 6, 1)
    ages = [0, 10, 11, 19, 20, 89, 90, 120]
    born = [date(2020 - a, 12, 31) for a in ages] + [None]
    assert column(spark, born, "date", codes.age_band_sort("v", today)) == [0, 0, 1, 1, 2, 8, 9, 9, 999]
    assert column(spark, born, "date", codes.age_band("v", today)) == [
        "0 - tens", "0 - tens", "teens", "teens", "twenties", "eighties", "ninety_andabove", "ninety_andabove", "nodob"]


def test_supply_window_wraps_but_supply_end_does_not(spark):
    rows = spark.createDataFrame([(datetime(2020, 12, 20), 30), (datetime(2020, 2, 28), 2)], "d timestamp_ntz, n int")
    end = dates.supply_end("d", "n")
    got = [tuple(r) for r in rows.select(dates.day_of_year("d"), end, dates.day_of_year(end)).collect()]
    assert got == [(355, date(2021, 1, 18), 18), (59, date(2020, 2, 29), 60)]


def test_cutover_day_belongs_to_the_old_rule(spark):
    days = [datetime(2016, 8, 31), datetime(2016, 9, 1), datetime(2016, 9, 1, 0, 0, 1)]
    old, new = dates.cutover("v", date(2016, 9, 1))
    assert column(spark, days, "timestamp_ntz", old) == [True, True, False]
    assert column(spark, days, "timestamp_ntz", new) == [False, False, True]
    assert column(spark, days, "timestamp_ntz", dates.cutover("v", date(2016, 9, 1), False)[0]) == [True, False, False]


def test_local_time_follows_daylight_saving(spark):
    got = column(spark, [datetime(2021, 1, 1, 5), datetime(2021, 7, 1, 5)], "timestamp_ntz",
                 dates.to_local("v", "America/Chicago"))
    assert got == [datetime(2020, 12, 31, 23), datetime(2021, 7, 1, 0)]


def test_packed_amounts(spark):
    raw = ["250{", "250}", "12345A", "1234J", "2500", "", None, "1x{", "-5"]
    money = column(spark, raw, "string", amounts.packed_money("v"))
    assert money == [Decimal("25.00"), Decimal("-25.00"), Decimal("1234.51"), Decimal("-123.41"), Decimal("25.00"),
                     Decimal("0.00"), None, None, Decimal("-0.05")]
    assert column(spark, ["2500", "250{", "99I", "", None], "string", amounts.packed_quantity("v")) == [2.0, 2.0, 0.0, 0.0, None]
    assert column(spark, ["12345", "x", None], "string", amounts.implied_decimal("v")) == [Decimal("123.45"), None, None]


def test_money_and_dirty_values(spark):
    assert column(spark, ["$1,234.565", "7", "abc", None], "string", amounts.money("v")) == [
        Decimal("1234.57"), Decimal("7.00"), None, None]
    assert column(spark, ["12", "12.7", "x", None], "string", amounts.typed("v", "int")) == [12, None, None, None]
    assert column(spark, ["12", "12.7", "x", None], "string", amounts.dirty("v", "int")) == [False, True, True, False]


def test_codes(spark):
    kept = codes.map_codes("v", {("1", "2"): "low", "3": "high"}, "other")
    assert column(spark, ["1", "2", "3", "9", None], "string", kept) == ["low", "low", "high", "other", "other"]
    no_default = codes.map_codes("v", {"5000": "H5943"})
    assert column(spark, ["5000", "1"], "string", no_default) == ["H5943", None]
    rows = spark.createDataFrame([(2, None), (2, 5), (1, None)], "s int, d int")
    assert [r[0] for r in rows.select(codes.recode_missing_detail("s", "d")).collect()] == [0, 5, None]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-10**12, 10**12), min_size=1, max_size=30))
def test_unpack_decimal_round_trip(spark, numbers):
    def pack(n):
        digits = str(abs(n))
        signs = amounts.NEGATIVE_SIGNS if n < 0 else amounts.POSITIVE_SIGNS
        return digits[:-1] + signs[int(digits[-1])]
    got = column(spark, [pack(n) for n in numbers], "string", amounts.unpack_decimal("v").cast("bigint"))
    assert got == numbers


def test_unknown_environment_is_an_error():
    from tidewell.sources.watch import location_column
    assert location_column("qa") == "filelocationqa"
    with pytest.raises(ValueError):
        location_column("staging")


def test_year_filter_is_a_range(spark):
    rows = spark.createDataFrame([(datetime(2019, 12, 31, 23, 59),), (datetime(2020, 1, 1),), (datetime(2020, 12, 31, 23),),
                                  (datetime(2021, 1, 1),), (None,)], "d timestamp_ntz")
    assert rows.where(dates.in_year("d", 2020)).count() == 2
