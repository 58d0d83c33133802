from decimal import ROUND_HALF_UP, Decimal
from random import Random

import pytest
from pyspark.sql import functions as F

from semestra.functions.numeric import exact_mean, guarded_corr, half_up, percent_change
from semestra.functions.periods import period_columns
from semestra.functions.text import (
    month_key, month_number, month_text, numeric_text, observation_flag, parse_number, period_year,
    semester_number, semester_text,
)


@pytest.mark.parametrize(("cell", "number", "flag"), [
    ("0.0969", 0.0969, None),
    ("0.1234 e", 0.1234, "e"),
    ("0.1 e p", 0.1, "ep"),
    ("-0.1 ", -0.1, None),
    (": ", None, None),
    (": c", None, "c"),
    ("1.2.3", None, None),
    ("1-05", None, None),
    ("", None, None),
    (None, None, None),
    (".5", 0.5, None),
    ("5.", 5.0, None),
])
def test_cells(spark, cell, number, flag):
    frame = spark.createDataFrame([(cell,)], "c string")
    row = frame.select(parse_number(numeric_text(F.col("c"))), observation_flag(F.col("c"))).first()
    assert tuple(row) == (number, flag)


def test_number_out_of_range_is_null(spark):
    frame = spark.createDataFrame([("1234567.1",), ("0.00005",)], "c string")
    values = [r[0] for r in frame.select(parse_number(F.col("c"), "decimal(10,4)")).collect()]
    assert values == [None, Decimal("0.0001")]


def test_periods(spark):
    frame = spark.sql(
        "SELECT timestamp_ntz'2007-06-30 23:59:59' AS a, timestamp_ntz'2007-07-01' AS b, '1985-01-15' AS t, 'x' AS u"
    )
    row = frame.select(
        semester_text(semester_number(F.col("a"))), semester_text(semester_number(F.col("b"))),
        month_text(month_number(F.col("a"))), month_key(F.col("t")), month_key(F.col("u")),
        period_year(F.lit("2007-S1")),
    ).first()
    assert tuple(row) == ("2007-S1", "2007-S2", "2007-06", "1985-01", None, 2007)


def test_period_columns():
    header = ["2007-S1 ", "2007-S3", "2007", "2007-01", "geo", "22007"]
    assert period_columns(header, "semester") == ["2007-S1 "]
    assert period_columns(header, "year") == ["2007"]
    assert period_columns(header, "month") == ["2007-01"]


def test_means_round_half_away_from_zero_exactly(spark):
    random = Random(7)
    groups = {g: [Decimal(random.randint(-99999, 99999)).scaleb(-4) for _ in range(random.randint(1, 4))]
              for g in range(300)}
    data = [(g, v) for g, values in groups.items() for v in values]
    frame = spark.createDataFrame(data, "g int, v decimal(10,4)").repartition(4)
    for digits in (2, 4):
        got = dict(frame.groupBy("g").agg(half_up(exact_mean(F.col("v")), digits)).collect())
        for g, values in groups.items():
            exact = sum(values) / Decimal(len(values))
            assert got[g] == exact.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP), (g, values)


def test_mean_of_nothing_is_null(spark):
    frame = spark.createDataFrame([(1, None)], "g int, v decimal(10,4)")
    assert frame.groupBy("g").agg(exact_mean(F.col("v"))).first()[1] is None


def test_correlation(spark):
    data = [("up", 1.0, 2.0), ("up", 2.0, 4.0), ("up", 3.0, 6.0), ("up", 9.0, None),
            ("flat", 1.0, 5.0), ("flat", 2.0, 5.0), ("one", 1.0, 1.0)]
    frame = spark.createDataFrame(data, "g string, x double, y double")
    got = dict(frame.groupBy("g").agg(guarded_corr(F.col("x"), F.col("y"))).collect())
    assert got["up"] == pytest.approx(1.0) and got["flat"] is None and got["one"] is None


def test_percent_change(spark):
    frame = spark.sql(
        "SELECT * FROM VALUES (1.5BD, 1BD), (1BD, 0BD), (1BD, NULL), (-1BD, -2BD) AS t(a, b)"
    ).select(half_up(percent_change(F.col("a"), F.col("b")), 2))
    assert [r[0] for r in frame.collect()] == [Decimal("50.00"), None, None, Decimal("-50.00")]
