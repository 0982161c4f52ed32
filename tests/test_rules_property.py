"""The rule chain against an independent pure-Python evaluation (SQL
three-valued logic) on generated rows with NULLs, zeros and negatives."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from tickvault.operators import quality

SCHEMA = T.StructType([
    T.StructField("date", T.DateType()), T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()), T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()), T.StructField("adj_close", T.DoubleType()),
    T.StructField("volume", T.LongType()), T.StructField("ticker", T.StringType()),
])

price = st.one_of(st.none(), st.sampled_from([-2.0, 0.0, 1.0, 5.0, 9.0, 10.0]))
row = st.tuples(st.one_of(st.none(), st.just(dt.date(2024, 1, 2))), price, price, price, price,
                price, st.one_of(st.none(), st.sampled_from([-1, 0, 7])),
                st.one_of(st.none(), st.just("AAPL")))


def lt(a, b):
    return None if a is None or b is None else a < b


def le0(a):
    return None if a is None else a <= 0


def any3(vals):
    if any(v is True for v in vals):
        return True
    return None if any(v is None for v in vals) else False


def expected(r):
    d, o, h, lo, c, ac, v, t = r
    if any(x is None for x in (d, t, o, h, lo, c, v)):
        return "null_in_critical_column"
    if any3([le0(o), le0(h), le0(lo), le0(c), le0(ac)]) is True:
        return "non_positive_price"
    if lt(v, 0) is True:
        return "negative_volume"
    if any3([lt(h, lo), lt(h, o), lt(h, c)]) is True:
        return "ohlc_inconsistency"
    return None


@settings(max_examples=5, deadline=None)
@given(st.lists(row, min_size=1, max_size=60))
def test_rule_chain_matches_python(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               T.StructType([T.StructField("i", T.LongType())] + SCHEMA.fields))
    got = {r["i"]: r["failure_reason"] for r in quality.flag(df).collect()}
    assert got == {i: expected(r) for i, r in enumerate(rows)}
    clean, rejected = quality.split(df)
    assert clean.count() == sum(expected(r) is None for r in rows)
    assert {r["i"]: r["failure_reason"] for r in rejected.collect()} == \
        {i: expected(r) for i, r in enumerate(rows) if expected(r) is not None}
