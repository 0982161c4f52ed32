"""Quality rules as data: an ordered list of (reason, predicate builder).

A row is rejected with the reason of the first rule whose predicate is TRUE;
a NULL predicate does not fire (three-valued logic, as in SQL ``CASE``).
"""

from __future__ import annotations

from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rule names, their order, and the columns they read.
CRITICAL_COLUMNS = ["date", "ticker", "open", "high", "low", "close", "volume"]
POSITIVE_PRICE_COLUMNS = ["open", "high", "low", "close", "adj_close"]
NULL_RULE = "null_in_critical_column"
PRICE_RULE = "non_positive_price"
VOLUME_RULE = "negative_volume"
OHLC_RULE = "ohlc_inconsistency"
DUPLICATE_RULE = "duplicate_key"
RULE_ORDER = [NULL_RULE, PRICE_RULE, VOLUME_RULE, OHLC_RULE]

Rule = tuple[str, Callable[[Sequence[str]], Column]]


def _any(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, preds, F.lit(False))


def null_in_critical(columns: Sequence[str]) -> Column:
    # Columns absent from the frame are skipped.
    return _any([F.col(c).isNull() for c in CRITICAL_COLUMNS if c in columns])


def non_positive_price(columns: Sequence[str]) -> Column:
    return _any([F.col(c) <= 0 for c in POSITIVE_PRICE_COLUMNS if c in columns])


def negative_volume(columns: Sequence[str]) -> Column:
    # Not guarded: an absent volume column is an analysis error.
    return F.col("volume") < 0


def ohlc_inconsistent(columns: Sequence[str]) -> Column:
    # Only ``high`` is checked against the other prices.
    high = F.col("high")
    return (high < F.col("low")) | (high < F.col("open")) | (high < F.col("close"))


DEFAULT_RULES: list[Rule] = [
    (NULL_RULE, null_in_critical),
    (PRICE_RULE, non_positive_price),
    (VOLUME_RULE, negative_volume),
    (OHLC_RULE, ohlc_inconsistent),
]


#: Column of ``schemas.enforce_schema(mark=...)``: a value that could not be cast.
CAST_FAILED = "_cast_failed"
TYPE_RULE = "type_mismatch"


def type_mismatch(columns: Sequence[str]) -> Column:
    return F.col(CAST_FAILED) if CAST_FAILED in columns else F.lit(False)


#: The rules for files of other writers: a value of the wrong type is that, not a missing one.
TYPED_RULES: list[Rule] = [(TYPE_RULE, type_mismatch), *DEFAULT_RULES]


def failure_reason(columns: Sequence[str], rules: Sequence[Rule] = DEFAULT_RULES) -> Column:
    """``CASE WHEN r1 THEN 'r1' WHEN r2 ... END`` - the first failing rule wins."""
    expr = None
    for name, build in rules:
        pred = build(columns)
        expr = F.when(pred, F.lit(name)) if expr is None else expr.when(pred, F.lit(name))
    return expr if expr is not None else F.lit(None).cast("string")


def any_rule_fails(columns: Sequence[str], rules: Sequence[Rule] = DEFAULT_RULES) -> Column:
    """TRUE when some rule fires (NULL when none fires but one is unknown)."""
    return reduce(lambda a, b: a | b, [build(columns) for _, build in rules])
