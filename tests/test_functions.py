import datetime as dt
import math
import random
from fractions import Fraction

from pyspark.sql import functions as F

from acctcube.functions import (
    apply_to,
    between,
    contains,
    differs,
    ends_with,
    if_else,
    in_set,
    is_true,
    month_year_code,
    nan_to_null,
    number_text,
    pct,
    pick,
    rename_prefix,
    round_even,
    round_up,
    starts_with,
    to_front,
    to_number,
    ymd_text,
)


def column(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_if_else_missing_condition_is_missing(frame):
    df = frame([(None,), (20,), (22,)], "x int")
    assert column(df, if_else(F.col("x") >= 21, 1, 0)) == [None, 0, 1]


def test_membership_and_truth(frame):
    df = frame([(None,), ("B",), ("W",)], "x string")
    assert column(df, in_set(F.col("x"), ["B", "H"])) == [False, True, False]
    assert column(df, ~in_set(F.col("x"), ["B", "H"])) == [True, False, True]
    assert column(df, is_true(F.col("x") == "B")) == [False, True, False]
    assert column(df, differs(F.col("x"), F.lit("B"))) == [True, False, True]


def stored_half_even(x, k):
    """Brute force on the exact binary value."""
    exact, scale = Fraction(x), 10**k
    low = math.floor(exact * scale)
    gap = exact * scale - low
    if gap > Fraction(1, 2) or (gap == Fraction(1, 2) and low % 2):
        low += 1
    return low / scale


def test_round_even_edges(frame):
    df = frame([(12.25,), (2.5,), (0.5,), (247 / 20,), (5.55,), (5.45,), (None,), (-2.5,)], "x double")
    assert column(df, round_even(F.col("x"), 1)) == [12.2, 2.5, 0.5, 12.3, 5.5, 5.5, None, -2.5]
    assert column(df, round_even(F.col("x"))) == [12, 2, 0, 12, 6, 5, None, -2]
    assert column(df, round_up(F.col("x"), 1))[:3] == [12.3, 2.5, 0.5]
    assert column(df, round_up(F.col("x")))[:3] == [12, 3, 1]


def test_round_even_all_ratios(frame):
    rows = [(100.0 * n / d,) for d in range(1, 121) for n in range(d + 1)] + [
        (s / n,) for n in (20, 40, 60, 80, 2000) for s in range(n, 36 * n, 7)
    ]
    df = frame(rows, "x double")
    for k in (0, 1):
        got = column(df, round_even(F.col("x"), k))
        for (x,), value in zip(rows, got, strict=True):
            assert value == stored_half_even(x, k), x


def test_round_even_next_to_ties(frame):
    rows = [0.05, 0.15, 0.25, 0.35, 0.45, 0.75, 1.85, 1.95, 12.35] + [100.0 * n / 4000 for n in range(4001)]
    df = frame([(x,) for x in rows], "x double")
    assert column(df, round_even(F.col("x"), 1)) == [stored_half_even(x, 1) for x in rows]


def test_pct_zero_whole(frame):
    df = frame([(1, 0), (0, 0), (1, 4), (None, 4)], "a int, b int")
    assert column(df, pct(F.col("a"), F.col("b"))) == [None, None, 25.0, None]


def test_number_and_text(frame):
    df = frame([("12",), (" 7 ",), ("x",), ("",), ("1.9",), ("1d",), ("NaN",), (None,), ("9007199254740993",)], "s string")
    assert column(df, to_number(F.col("s"), "bigint")) == [12, 7, None, None, 1, None, None, None, 9007199254740993]
    assert column(df, to_number(F.col("s")))[:5] == [12.0, 7.0, None, None, 1.9]
    nums = frame([(20.0,), (20.1,), (None,), (100.0,)], "x double")
    assert column(nums, number_text(F.col("x"))) == ["20", "20.1", None, "100"]


def test_nan_to_null(frame):
    df = frame([(float("nan"),), (1.0,), (None,)], "x double")
    assert column(df, nan_to_null(F.col("x"))) == [None, 1.0, None]


def test_month_year_code(frame):
    df = frame([(1016,), (416,), (1316,), (None,), (16,), (0,), (12016,), (999,)], "c int")
    day = dt.date
    assert column(df, month_year_code(F.col("c"))) == [
        day(2016, 10, 1), day(2016, 4, 1), None, None, None, None, day(2001, 12, 1), day(2099, 9, 1),
    ]


def test_ymd_text(frame):
    df = frame([("20000229",), ("20010229",), ("2000-01-",), ("",), (None,), ("200013 1",)], "s string")
    assert column(df, ymd_text(F.col("s"))) == [dt.date(2000, 2, 29), None, None, None, None, None]


def test_column_helpers(frame):
    df = frame([(1, 2, 3, 4)], "n_a int, pct_a int, n_b int, total int")
    assert starts_with(df, "n_") == ["n_a", "n_b"]
    assert ends_with(df, "_a") == ["n_a", "pct_a"]
    assert contains(df, "ct", "tot") == ["pct_a", "total"]
    assert between(df, "pct_a", "total") == ["pct_a", "n_b", "total"]
    assert pick("total", ["n_a", "total"]) == ["total", "n_a"]
    assert to_front(df, "total").columns == ["total", "n_a", "pct_a", "n_b"]
    assert rename_prefix(df, "n_", "pct_of_").columns == ["pct_of_a", "pct_a", "pct_of_b", "total"]
    assert apply_to(df, ["n_a", "n_b"], lambda c: c * 10).first()[:3] == (10, 2, 30)


def test_random_rounding_is_idempotent(frame):
    rng = random.Random(1)
    rows = [(rng.uniform(0, 100),) for _ in range(500)]
    df = frame(rows, "x double").select(round_even(F.col("x"), 1).alias("x"))
    assert column(df, round_even(F.col("x"), 1)) == column(df, F.col("x"))
