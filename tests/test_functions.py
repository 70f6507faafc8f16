import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import money
from millrace.functions.cleaning import (
    amount,
    flag,
    integer,
    known_code,
    lower_text,
    moment,
    text,
)
from millrace.functions.dedup import keep_one

FEW = settings(
    max_examples=15,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)


def one(spark, value, column):
    frame = spark.createDataFrame([(value,)], "v string")
    return frame.select(column.alias("r")).first().r


@pytest.mark.parametrize(
    "value, expected",
    [("3", 3), (" 3 ", 3), ("3.7", None), ("abc", None), ("", None), (None, None)],
)
def test_integer(spark, value, expected):
    assert one(spark, value, integer("v")) == expected


@pytest.mark.parametrize(
    "value, expected", [("1.5", 1.5), (" 2 ", 2.0), ("x", None), (None, None)]
)
def test_amount(spark, value, expected):
    assert one(spark, value, amount("v")) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2018-01-02 03:04:05", "2018-01-02 03:04:05"),
        ("2018-01-02T03:04:05", "2018-01-02 03:04:05"),
        ("2018-01-02", "2018-01-02 00:00:00"),
        ("02/01/2018", None),
        ("2018-13-40 00:00:00", None),
        ("", None),
        ("12:30", None),  # no day: it would be the day of the run
        ("T12:30:00", None),
        ("2018", None),
        ("2018-03", None),
    ],
)
def test_moment(spark, value, expected):
    assert one(spark, value, moment("v").cast("string")) == expected


def test_text_trims_spaces_only(spark):
    assert one(spark, "  a b ", text("v")) == "a b"
    assert one(spark, "   ", text("v")) == ""
    assert one(spark, "\ta\t", text("v")) == "\ta\t"
    assert one(spark, None, text("v")) is None


def test_known_code(spark):
    code = known_code(lower_text("v"), ["paid", "open"])
    assert one(spark, " PAID ", code) == "paid"
    assert one(spark, "lost", code) == "unknown"
    assert one(spark, None, code) == "unknown"


def test_flag_is_a_summable_int(spark):
    frame = spark.createDataFrame([(1,), (None,)], "v int")
    flagged = frame.select(flag(F.col("v") == 1).alias("f"))
    assert dict(flagged.dtypes)["f"] == "int"
    assert flagged.agg(F.sum("f")).first()[0] == 1


# Deduplication


def test_keep_one_keeps_the_smallest_row_nulls_last(spark, rows_of):
    frame = spark.createDataFrame(
        [("a", None, "x"), ("a", 2, "y"), ("a", 2, "b"), (None, 1, "n"), (None, 0, "m")],
        "k string, n int, s string",
    )
    assert rows_of(keep_one(frame, ["k"])) == [
        {"k": None, "n": 0, "s": "m"},
        {"k": "a", "n": 2, "s": "b"},
    ]


def test_keep_one_prefers_a_given_order(spark, rows_of):
    frame = spark.createDataFrame([("a", 1, "x"), ("a", 9, "y")], "k string, n int, s string")
    latest = keep_one(frame, ["k"], prefer=[F.col("n").desc()])
    assert rows_of(latest) == [{"k": "a", "n": 9, "s": "y"}]


def test_keep_one_with_one_or_no_other_column(spark, rows_of):
    frame = spark.createDataFrame([("a", 2), ("a", None), ("a", 1), ("b", None)], "k string, n int")
    assert rows_of(keep_one(frame, ["k"])) == [{"k": "a", "n": 1}, {"k": "b", "n": None}]
    assert keep_one(frame, ["k", "n"]).count() == 4
    assert keep_one(frame.union(frame), ["k", "n"]).count() == 4


@FEW
@given(
    st.lists(
        st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 9)), st.sampled_from("abc")),
        min_size=1,
    )
)
def test_keep_one_does_not_depend_on_row_order(spark, data):
    def survivors(rows):
        frame = spark.createDataFrame(rows, "k int, n int, s string").repartition(3)
        return {row.k: (row.n, row.s) for row in keep_one(frame, ["k"]).collect()}

    expected = {}
    for k, n, s in data:
        rank = (n is None, n or 0, s)
        if k not in expected or rank < expected[k][0]:
            expected[k] = (rank, (n, s))
    expected = {k: row for k, (_, row) in expected.items()}
    assert survivors(data) == survivors(data[::-1]) == expected


# Money


@FEW
@given(st.lists(st.integers(0, 10**9), min_size=1, max_size=50))
def test_exact_totals_and_means_are_those_of_integer_cents(spark, cents):
    frame = spark.createDataFrame([(c / 100,) for c in cents], "v double")
    row = frame.agg(
        money.total(F.col("v"), exact=True).alias("total"),
        F.sum(money.addend(F.col("v"), exact=True)).alias("summed"),
        F.count("*").alias("n"),
    ).select(
        "total", money.per_head(F.col("summed"), F.col("n"), exact=True).alias("mean")
    ).first()
    assert row.total == sum(cents) / 100
    assert row.mean == ((2 * sum(cents) + len(cents)) // (2 * len(cents))) / 100


def test_total_with_nan_is_nan_in_both_modes(spark):
    frame = spark.createDataFrame([(1.0,), (float("nan"),)], "v double")
    for exact in (False, True):
        total = frame.agg(money.total(F.col("v"), exact).alias("t")).first().t
        assert math.isnan(total)


def test_share_rounds_half_up_and_guards_zero(spark):
    frame = spark.createDataFrame([(1, 3), (1, 32), (0, 0)], "p long, w long")
    for exact in (False, True):
        ratios = frame.select(money.share(F.col("p"), F.col("w"), exact).alias("r"))
        assert [row.r for row in ratios.collect()] == [0.3333, 0.0313, 0.0]


def test_exact_addend_refuses_what_does_not_fit(spark):
    frame = spark.createDataFrame([(float("inf"),)], "v double")
    with pytest.raises(Exception, match="OVERFLOW"):
        frame.select(money.addend(F.col("v"), exact=True)).collect()
