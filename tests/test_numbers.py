from __future__ import annotations

from decimal import Decimal
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tallyhouse.functions.numbers import cents, money, money_per, percent2, ratio2


def half_up(n: int, d: int) -> float:
    scaled = Fraction(abs(n) * 100, abs(d))
    whole = (scaled + Fraction(1, 2)).__floor__()
    return (-whole if (n < 0) != (d < 0) else whole) / 100


@settings(
    max_examples=8,
    deadline=None,
    phases=[Phase.generate],
    suppress_health_check=list(HealthCheck),
)
@given(
    pairs=st.lists(
        st.tuples(st.integers(-(10**17), 10**17), st.integers(-(10**9), 10**9).filter(bool)),
        min_size=20,
        max_size=60,
    )
)
def test_ratio_is_exact_half_up(spark, pairs):
    # hundredths a DOUBLE holds exactly
    pairs = [(n, d) for n, d in pairs if abs(n) // abs(d) < 10**13]
    if not pairs:
        return
    frame = spark.createDataFrame(pairs, "n long, d long")
    got = rows(frame.select("n", "d", ratio2(F.col("n"), F.col("d"))))
    for n, d, value in got:
        assert value == half_up(n, d)


def test_exact_half_cent(spark):
    # 38482.60 / 40 = 962.065
    frame = spark.createDataFrame([(3848260, 40)], "c long, n long")
    assert rows(frame.select(money_per(F.col("c"), F.col("n")))) == [(962.07,)]


@pytest.mark.parametrize("n, d, expected", [(1, 3, 33.33), (2, 3, 66.67), (0, 5, 0.0), (1, 0, None)])
def test_percent(spark, n, d, expected):
    frame = spark.createDataFrame([(n, d)], "n long, d long")
    assert rows(frame.select(percent2(F.col("n"), F.col("d")))) == [(expected,)]


def test_money_round_trip(spark):
    amounts = [Decimal("0.01"), Decimal("993.52"), Decimal("99999999.99")]
    frame = spark.createDataFrame([(a,) for a in amounts], "a decimal(10,2)")
    assert [r[0] for r in rows(frame.select(money(cents(F.col("a")))))] == amounts


def test_money_beyond_eight_digits(spark):
    frame = spark.createDataFrame([(145_000_000_000,)], "c long")
    assert rows(frame.select(money(F.col("c")))) == [(Decimal("1450000000.00"),)]
