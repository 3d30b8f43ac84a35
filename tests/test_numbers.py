import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tierlake.functions import numbers
from tierlake.functions.keys import date_parts, run_stamp


def one_column(spark, values, kind):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def evaluate(df, column):
    return [r.got for r in df.select("i", column.alias("got")).orderBy("i").collect()]


NUMBERS_AS_TEXT = [
    "1", " 12 ", "-3.5", "+.5", "2.", "1e3", "-1E-2", "abc", "", " ", "0x1A", "0x1Ap0", "1.5d", "1f", "1_000",
    "1,5", "nan", "NaN", "inf", "-Infinity", "--1", "1e", "e5", "1 2", "\t7\n", None, "1e999", "0012.50",
]


def test_number_or_null_agrees_with_coercion(spark):
    found = evaluate(one_column(spark, NUMBERS_AS_TEXT, "string"), numbers.number_or_null(F.col("v")))
    wanted = pd.to_numeric(pd.Series(NUMBERS_AS_TEXT, dtype=object), errors="coerce")
    assert found == [None if math.isnan(x) else x for x in wanted]


def test_strict_long_keeps_null_and_stops_on_text(spark):
    good = one_column(spark, ["7", None, "-1"], "string")
    assert evaluate(good, numbers.strict_long(F.col("v"))) == [7, None, -1]
    with pytest.raises(Exception, match="not an integer: 1.5"):
        evaluate(one_column(spark, ["1.5"], "string"), numbers.strict_long(F.col("v")))


@pytest.mark.parametrize("places", [1, 2])
def test_round_half_even_agrees_with_numpy(spark, places):
    values = [0.125, 2.675, 0.5, 1.5, -0.125, 33.333, 66.65, 12.25, 12.35, 1e12 + 0.05, None]
    found = evaluate(one_column(spark, values, "double"), numbers.round_half_even(F.col("v"), places))
    assert found == [None if v is None else float(np.round(v, places)) for v in values]


def test_percent_of_nothing_is_null(spark):
    df = spark.createDataFrame([(0, 1, 4), (1, 1, 0), (2, None, 4)], "i int, a long, b long")
    assert evaluate(df, numbers.percent(F.col("a"), F.col("b"))) == [25.0, None, None]


def test_true_or_false(spark):
    df = one_column(spark, [True, False, None], "boolean")
    assert evaluate(df, numbers.true_or_false(F.col("v"))) == [True, False, False]


def test_exact_mean_does_not_depend_on_row_order(spark):
    values = [70.1, 0.3, 99.9, 12.7, 33.3, 66.7, 0.1, 0.2] * 50
    results = {
        spark.createDataFrame([(v,) for v in order], "v double").repartition(parts)
        .agg(numbers.exact_mean(F.col("v"), 1)).first()[0]
        for order, parts in [(values, 1), (values[::-1], 7), (sorted(values), 3)]
    }
    assert len(results) == 1
    empty = one_column(spark, [None], "double").agg(numbers.exact_mean(F.col("v"), 1)).first()[0]
    assert empty is None


def test_missing_counts_nan_for_floating_columns_only(spark):
    df = spark.createDataFrame([(float("nan"), 1), (None, None), (1.0, 2)], "d double, n int")
    row = df.agg(*[F.count_if(numbers.missing(f.name, f.dataType)) for f in df.schema.fields]).first()
    assert tuple(row) == (2, 1)


def test_date_parts_are_padded_strings(spark):
    df = spark.sql("SELECT DATE '2024-01-05' AS d, TIMESTAMP '2024-01-05 06:07:08' AS t")
    row = df.select(*[c.alias(n) for n, c in date_parts(F.col("d")).items()], run_stamp(F.col("t"))).first()
    assert tuple(row) == ("2024", "01", "05", "20240105_060708")


def test_number_text_agrees_with_python(spark):
    values = [0.0001, -0.0005, 7.000000000000001e-4, 0.00099, 0.001, 0.0, -0.0, 1.0, -37.3159, 9999999.5, 1e7, 12345678.9,
              9007199254740992.0, 9999999999999998.0, 1e16, 1.5e16, 9.5e-05, 1e-05, 1.25e-07, 1e100, 1.5e-300, None,
              math.inf, -math.inf, math.nan]
    found = evaluate(one_column(spark, values, "double"), numbers.number_text(F.col("v")))
    assert found == [None if x is None else repr(x) for x in values]
