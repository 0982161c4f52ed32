"""Declarative data tests: not_null, unique, relationships and a suite runner (Q1-Q4)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL, per column: ``(column_name, failures)``, one scan for all columns."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counts.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, failures)")


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    """The failing rows of ``not_null(column)``."""
    return df.where(F.col(column).isNull())


def unique_failures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values occurring more than once (NULLs ignored), with their count.

    A partial-aggregated ``groupBy``: a hot value is counted map-side."""
    cols = list(columns)
    nonnull = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return (df.where(nonnull).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
              .where(F.col("n_records") > 1))


def relationship_failures(child: DataFrame, child_col: str, parent: DataFrame,
                          parent_col: str) -> DataFrame:
    """Child rows whose non-NULL key is absent from the parent."""
    keys = parent.select(F.col(parent_col).alias("_parent_key")).distinct()
    c = child.where(F.col(child_col).isNotNull())
    return c.join(keys, c[child_col] == keys["_parent_key"], "left_anti")


@dataclass(frozen=True)
class DataTest:
    kind: str            # not_null | unique | relationships
    table: str
    column: str
    to_table: str | None = None
    to_column: str | None = None

    @property
    def name(self) -> str:
        if self.kind == "relationships":
            return f"relationships_{self.table}_{self.column}__{self.to_column}__{self.to_table}"
        return f"{self.kind}_{self.table}_{self.column}"


def _row_tests(df: DataFrame, tests: Sequence[DataTest], tables: dict[str, DataFrame],
               known_rows: dict[str, int]) -> DataFrame:
    """not_null and relationships tests of one table in a single scan.

    Each parent's distinct keys are left-joined with a marker column (a key
    set, broadcast after a size check), so an orphan is a non-NULL child key
    with no marker; no child row is duplicated."""
    from tickvault.operators.lookup import broadcast_if_bounded

    counts = []
    for i, t in enumerate(tests):
        if t.kind == "not_null":
            counts.append(F.count_if(F.col(t.column).isNull()).alias(f"_f{i}"))
        else:
            keys = (tables[t.to_table].select(F.col(t.to_column).alias(f"_pk{i}")).distinct()
                    .withColumn(f"_hit{i}", F.lit(True)))
            keys = broadcast_if_bounded(keys, known_rows=known_rows.get(t.to_table))
            df = df.join(keys, df[t.column] == keys[f"_pk{i}"], "left")
            counts.append(F.count_if(F.col(t.column).isNotNull() & F.col(f"_hit{i}").isNull())
                          .alias(f"_f{i}"))
    pairs = ", ".join(f"{i}, `_f{i}`" for i in range(len(tests)))
    return df.agg(*counts).selectExpr(f"stack({len(tests)}, {pairs}) AS (_i, failures)")


def _unique_tests(df: DataFrame, tests: Sequence[DataTest]) -> DataFrame:
    """All unique tests of one table in one aggregation over grouping sets."""
    cols = [t.column for t in tests]
    if len(cols) == 1:
        per_value = (df.where(F.col(cols[0]).isNotNull()).groupBy(cols[0])
                       .agg(F.count(F.lit(1)).alias("_n"), F.lit(0).alias("_i")))
    else:
        sets = [[c] for c in cols]
        gid = F.grouping_id(*cols)
        per_value = (df.groupingSets(sets, *cols).agg(F.count(F.lit(1)).alias("_n"),
                                                      gid.alias("_gid")))
        # grouping_id has bit (k-1-i) set when column i is not grouped.
        which = F.lit(None).cast("int")
        for i in range(len(cols)):
            mask = ((1 << len(cols)) - 1) ^ (1 << (len(cols) - 1 - i))
            which = F.when(F.col("_gid") == mask, F.lit(i)).otherwise(which)
        per_value = per_value.withColumn("_i", which)
        nonnull = F.lit(False)
        for i, c in enumerate(cols):
            nonnull = nonnull | ((F.col("_i") == i) & F.col(c).isNotNull())
        per_value = per_value.where(nonnull)
    found = per_value.where(F.col("_n") > 1).groupBy("_i").agg(F.count(F.lit(1)).alias("failures"))
    ids = df.sparkSession.range(len(cols)).select(F.col("id").cast("int").alias("_i"))
    # ``ids`` holds one row per test (a handful); every test gets a row.
    return (F.broadcast(ids).join(found, "_i", "left")
             .select("_i", F.coalesce("failures", F.lit(0)).alias("failures")))


def run_suite(tables: dict[str, DataFrame], tests: Sequence[DataTest],
              known_rows: dict[str, int] | None = None) -> DataFrame:
    """One row per test: test_name, kind, table_name, column_name, failures, status.

    ``known_rows`` (table -> row count) lets parent key sets be broadcast
    without a size check.

    Per table: one scan for its not_null and relationships tests and one
    grouping-sets aggregation for its unique tests; the per-table results are
    unioned into one job.
    """
    parts: list[DataFrame] = []
    by_table: dict[str, dict[str, list[DataTest]]] = {}
    for t in tests:
        group = "unique" if t.kind == "unique" else "row"
        by_table.setdefault(t.table, {}).setdefault(group, []).append(t)
    for table, groups in by_table.items():
        for group, ts in groups.items():
            res = (_unique_tests(tables[table], ts) if group == "unique"
                   else _row_tests(tables[table], ts, tables, known_rows or {}))
            labels = F.create_map(*[x for i, t in enumerate(ts)
                                    for x in (F.lit(i), F.array(F.lit(t.name), F.lit(t.kind),
                                                                F.lit(t.column)))])
            lab = labels[F.col("_i")]
            parts.append(res.select(lab[0].alias("test_name"), lab[1].alias("kind"),
                                    F.lit(table).alias("table_name"), lab[2].alias("column_name"),
                                    F.col("failures").cast("bigint").alias("failures")))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


# ---- incremental tests: results per folder, merged ------------------------------

def is_additive(test: DataTest) -> bool:
    """Do the failures of a table's folders add up to the table's?  Null counts do, and orphans,
    as long as the parent loses no key; repeated values don't."""
    return test.kind in ("not_null", "relationships")


def folder_results(df: DataFrame, tests: Sequence[DataTest], tables: dict[str, DataFrame], folder: str,
                   known_rows: dict[str, int] | None = None) -> DataFrame:
    """(folder, test_name, failures) of one table's additive tests, in one scan with a grouped sum."""
    from tickvault.operators.lookup import broadcast_if_bounded

    counts = []
    for i, t in enumerate(tests):
        if t.kind == "not_null":
            counts.append(F.count_if(F.col(t.column).isNull()).alias(f"_f{i}"))
        else:
            keys = tables[t.to_table].select(F.col(t.to_column).alias(f"_pk{i}")).distinct().withColumn(f"_hit{i}", F.lit(True))
            keys = broadcast_if_bounded(keys, known_rows=(known_rows or {}).get(t.to_table))
            df = df.join(keys, df[t.column] == keys[f"_pk{i}"], "left")
            counts.append(F.count_if(F.col(t.column).isNotNull() & F.col(f"_hit{i}").isNull()).alias(f"_f{i}"))
    pairs = ", ".join(f"'{t.name}', `_f{i}`" for i, t in enumerate(tests))
    return df.groupBy(folder).agg(*counts).selectExpr(f"`{folder}`", f"stack({len(tests)}, {pairs}) AS (test_name, failures)")


def merge_results(parts: DataFrame, tests: Sequence[DataTest]) -> DataFrame:
    """The verdicts of additive tests from the results of all folders, as ``run_suite`` gives them."""
    rows = [(t.name, t.kind, t.table, t.column) for t in tests]
    declared = parts.sparkSession.createDataFrame(rows, "test_name string, kind string, table_name string, column_name string")
    sums = parts.groupBy("test_name").agg(F.sum("failures").alias("failures"))
    return declared.join(sums, "test_name", "left").withColumn("failures", F.coalesce("failures", F.lit(0)).cast("bigint")) \
        .withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


# The 18 declared data tests of the gold layer and its source.
GOLD_TESTS = [
    DataTest("unique", "dim_date", "date_key"),
    DataTest("not_null", "dim_date", "date_key"),
    DataTest("unique", "dim_date", "full_date"),
    DataTest("not_null", "dim_date", "full_date"),
    DataTest("unique", "dim_ticker", "ticker_key"),
    DataTest("not_null", "dim_ticker", "ticker_key"),
    DataTest("unique", "dim_ticker", "ticker_symbol"),
    DataTest("not_null", "dim_ticker", "ticker_symbol"),
    DataTest("not_null", "fact_stock_prices", "date_key"),
    DataTest("relationships", "fact_stock_prices", "date_key", "dim_date", "date_key"),
    DataTest("not_null", "fact_stock_prices", "ticker_key"),
    DataTest("relationships", "fact_stock_prices", "ticker_key", "dim_ticker", "ticker_key"),
    DataTest("not_null", "fact_stock_prices", "close_price"),
    DataTest("not_null", "fact_stock_prices", "volume"),
    DataTest("not_null", "silver_stock_prices", "date"),
    DataTest("not_null", "silver_stock_prices", "ticker"),
    DataTest("not_null", "silver_stock_prices", "close"),
    DataTest("not_null", "silver_stock_prices", "volume"),
]
