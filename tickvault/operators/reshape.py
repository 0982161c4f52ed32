"""Raw-side reshaping: wide to long, name normalisation, all-NULL group drop,
lineage columns (P1-P4, P6)."""

from __future__ import annotations

import json
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickvault.functions.naming import normalize_columns


def wide_to_long(wide: DataFrame, index: str = "Date", tickers: Sequence[str] | None = None,
                 ticker: str | None = None) -> DataFrame:
    """One row per (index, ticker) from a frame with one struct column per ticker
    (the (ticker, field) column MultiIndex).  A flat frame (fields as plain
    columns) is one ticker's data and needs ``ticker`` (P1).  Requested tickers
    missing from the frame yield no rows (they are reported as failed).

    The ticker columns form one array that is exploded with its positions, which a
    literal array turns into names: no shuffle, and the plan grows by one column
    reference per ticker, as the scan does, not by a set of expressions.
    """
    structs = [f for f in wide.schema.fields if isinstance(f.dataType, T.StructType)]
    if not structs:
        if ticker is None:
            raise ValueError("a flat single-ticker frame needs the ticker name")
        return wide.withColumn("ticker", F.lit(ticker))
    available = [f.name for f in structs]
    names = [t for t in tickers if t in available] if tickers is not None else available
    fields = [f.name for f in structs[0].dataType.fields]
    if not names:
        wide, names = wide.where(F.lit(False)), available[:1]
    labels = F.from_json(F.lit(json.dumps(names)), F.lit("array<string>"))
    rows = wide.select(F.col(index).alias("_index"), F.posexplode(F.array(*[F.col(f"`{t}`") for t in names])).alias("_at", "_row"))
    return rows.select(F.col("_index").alias(index), *[F.col("_row")[f].alias(f) for f in fields], F.get(labels, F.col("_at")).alias("ticker"))


def drop_all_null_groups(df: DataFrame, key: str = "ticker",
                         ignore: Sequence[str] = ("date",)) -> DataFrame:
    """Drop every row of a key whose rows are all NULL in every value column;
    a key with at least one non-NULL value keeps all its rows, NULL rows too (P3).

    The per-key test is a partial-aggregated ``groupBy`` and a semi join, so a
    hot key is never gathered into one task.
    """
    values = [c for c in df.columns if c != key and c not in ignore]
    any_value = F.greatest(*[F.col(c).isNotNull() for c in values]) if len(values) > 1 \
        else F.col(values[0]).isNotNull()
    keep = (df.groupBy(key).agg(F.max(any_value.cast("int")).alias("_has"))
              .where(F.col("_has") == 1).select(key))
    return df.join(keep, key, "left_semi")


def with_lineage(df: DataFrame, ingested_at: str, source: str) -> DataFrame:
    """Batch-constant lineage columns of the raw layer."""
    return df.withColumns({"ingested_at": F.lit(ingested_at), "source": F.lit(source)})


def tolerant_select(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fixed column order, silently skipping columns the frame lacks."""
    present = set(df.columns)
    return df.select(*[c for c in columns if c in present])


def to_raw_rows(wide: DataFrame, ingested_at: str, source: str, index: str = "Date",
                tickers: Sequence[str] | None = None, ticker: str | None = None) -> DataFrame:
    """Download frame -> normalised long rows of tickers with data, with lineage."""
    long = normalize_columns(wide_to_long(wide, index, tickers, ticker))
    return with_lineage(drop_all_null_groups(long, "ticker", ("date",)), ingested_at, source)
