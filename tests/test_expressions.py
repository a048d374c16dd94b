from decimal import Decimal

from pyspark.sql import functions as F

from parcelmart.functions.dates import date_key, days_between, iso_weekday, month_of_key
from parcelmart.functions.numbers import guarded_fraction, percent, rounded_average, rounded_int, rounded_ratio
from parcelmart.functions.text import blank_to_null, capitalise_words, place_name, state_code


def values(spark, schema, rows, column):
    return [row[0] for row in spark.createDataFrame(rows, schema).select(column).collect()]


def test_words_start_after_any_other_character(spark):
    given = [("d'oeste são JOAO-del  rei",), ("3m brasil_x",), ("ßen ok",), ("",), (None,)]
    expected = ["D'Oeste São Joao-Del  Rei", "3m Brasil_X", "ßen Ok", "", None]
    assert values(spark, "t string", given, capitalise_words(F.col("t"))) == expected


def test_places_and_states_are_trimmed(spark):
    assert values(spark, "t string", [("  rio claro ",)], place_name(F.col("t"))) == ["Rio Claro"]
    assert values(spark, "t string", [(" sp ",)], state_code(F.col("t"))) == ["SP"]


def test_numbers_round_half_away_from_zero(spark):
    given = [("2.5",), ("2.4",), ("-2.5",), ("",)]
    assert values(spark, "t string", given, rounded_int(blank_to_null(F.col("t")))) == [3, 2, -3, None]


def test_average_is_rounded_on_the_exact_quotient(spark):
    frame = spark.createDataFrame([(Decimal("0.01"),), (Decimal("0.02"),), (None,)], "v decimal(10,2)")
    assert frame.agg(rounded_average(F.col("v"), 2)).first()[0] == Decimal("0.02")


def test_ratio_without_divisor_is_null(spark):
    frame = spark.createDataFrame([(1, 0), (1, 8), (-1, 8)], "a int, b int")
    assert [r[0] for r in frame.select(rounded_ratio(F.col("a"), F.col("b"), 2)).collect()] == [
        None, Decimal("0.13"), Decimal("-0.13"),
    ]
    assert frame.select(percent(F.col("a"), F.col("b"), 1)).collect()[1][0] == Decimal("12.5")
    assert [r[0] for r in frame.select(guarded_fraction(F.col("a"), F.col("b"))).collect()] == [None, 0.125, -0.125]


def test_dates(spark):
    frame = spark.sql(
        "select timestamp_ntz'2018-03-04 23:59:00' as late, timestamp_ntz'2018-03-01 00:01:00' as early,"
        " cast(null as timestamp_ntz) as never"
    )
    row = frame.select(
        date_key(F.col("late")), date_key(F.col("never")), days_between(F.col("late"), F.col("early")),
        iso_weekday(F.col("late").cast("date")), month_of_key(date_key(F.col("late"))),
    ).first()
    assert tuple(row) == (20180304, None, 3, 7, 201803)
