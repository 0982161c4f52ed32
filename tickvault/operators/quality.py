"""Rule-based quality checks: flag, split, counts, duplicates."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tickvault.functions.rules import (DEFAULT_RULES, DUPLICATE_RULE, Rule,
                                       any_rule_fails, failure_reason)

REASON = "failure_reason"


def flag(df: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES, reason_col: str = REASON) -> DataFrame:
    """All rows plus ``failure_reason`` (NULL for clean rows)."""
    return df.withColumn(reason_col, failure_reason(df.columns, rules))


def clean_rows(df: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """Rows no rule fires on (a NULL predicate does not fire)."""
    return df.where(~F.coalesce(any_rule_fails(df.columns, rules), F.lit(False)))


def rejected_rows(df: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES,
                  reason_col: str = REASON) -> DataFrame:
    """Rows some rule fires on, with the first failing rule as reason.

    Selected with the OR of the rule predicates before the reason is built,
    so the CASE expression is evaluated only for rejected rows.  (The OHLC
    rule compares columns with each other, which a Parquet scan cannot
    evaluate, so this filter stays in Spark.)
    """
    return (df.where(any_rule_fails(df.columns, rules))
              .withColumn(reason_col, failure_reason(df.columns, rules)))


def split(df: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES,
          reason_col: str = REASON) -> tuple[DataFrame, DataFrame]:
    """(clean, rejected) as two lazy plans over the same input."""
    return clean_rows(df, rules), rejected_rows(df, rules, reason_col)


def metric_columns(flagged: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES,
                   reason_col: str = REASON) -> list[Column]:
    r = F.col(reason_col)
    cols = [F.count(F.lit(1)).alias("total_rows"),
            F.count_if(r.isNull()).alias("clean_rows"),
            F.count_if(r.isNotNull()).alias("rejected_rows")]
    cols += [F.count_if(r == name).alias(name) for name, _ in rules]
    return cols


def metrics(flagged: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES,
            reason_col: str = REASON) -> DataFrame:
    """One row: total, clean, rejected and per-rule counts in a single pass (A1, A2)."""
    return flagged.agg(*metric_columns(flagged, rules, reason_col))


def observe_metrics(flagged: DataFrame, name: str = "quality",
                    rules: Sequence[Rule] = DEFAULT_RULES,
                    reason_col: str = REASON) -> tuple[DataFrame, Observation]:
    """Attach the counts to a plan; they are filled in by whatever action runs it."""
    obs = Observation(name)
    return flagged.observe(obs, *metric_columns(flagged, rules, reason_col)), obs


def breakdown(rejected: DataFrame, reason_col: str = REASON) -> DataFrame:
    """Rejected rows per reason (A3)."""
    return rejected.groupBy(reason_col).agg(F.count(F.lit(1)).alias("rows"))


def dedup_latest(df: DataFrame, keys: Sequence[str] = ("ticker", "date"),
                 newest: str | None = "ingested_at", tiebreak: str | None = "src_id") -> DataFrame:
    """One row per key: newest ``newest`` wins, then the smallest numeric ``tiebreak``.

    Expressed as a grouped maximum of one struct that begins with the order,
    so the choice is combined map-side: a key holding a third of all rows is
    reduced before the shuffle instead of being sorted in one task, as a
    ``row_number`` window would be, and each row travels once.  The rest of
    the row breaks any remaining tie, so the pick never depends on the order
    rows arrive in (a retried task picks the same row).
    """
    rest = [c for c in df.columns if c not in (*keys, newest)]
    order = [F.col(newest).alias(newest)] if newest else []
    if tiebreak:
        order.append((-F.col(tiebreak)).alias("_tiebreak"))
    pick = F.max(F.struct(*order, *[F.col(c) for c in rest]))
    back = {c: F.col(c) if c in keys else F.col(f"_keep.{c}") for c in df.columns}
    return df.groupBy(*keys).agg(pick.alias("_keep")).select(*[x.alias(c) for c, x in back.items()])


def duplicate_rows(df: DataFrame, kept: DataFrame, row_id: str = "src_id",
                   reason_col: str = REASON) -> DataFrame:
    """Rows removed by ``dedup_latest``, with reason ``duplicate_key``.

    The anti join is on the unique row id, so both sides hash evenly even when
    one business key is hot.
    """
    return (df.join(kept.select(row_id), row_id, "left_anti")
              .withColumn(reason_col, F.lit(DUPLICATE_RULE)))
