"""Table schemas and schema enforcement on read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRICE_COLUMNS = ["open", "high", "low", "close", "adj_close"]

RAW_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("adj_close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("ingested_at", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("company_name", T.StringType()),
    T.StructField("sector", T.StringType()),
    T.StructField("exchange", T.StringType()),
])

SILVER_EXTRA = T.StructType([
    T.StructField("daily_return", T.DoubleType()),
    T.StructField("price_range", T.DoubleType()),
    T.StructField("processed_at", T.StringType()),
    T.StructField("layer", T.StringType()),
])

SILVER_SCHEMA = T.StructType(RAW_SCHEMA.fields + SILVER_EXTRA.fields)

# Column order of the exported clean table (17 columns).
SILVER_EXPORT_COLUMNS = [f.name for f in SILVER_SCHEMA.fields]

FACT_SCHEMA = T.StructType([
    T.StructField("date_key", T.IntegerType()),
    T.StructField("ticker_key", T.LongType()),
    T.StructField("open_price", T.DoubleType()),
    T.StructField("high_price", T.DoubleType()),
    T.StructField("low_price", T.DoubleType()),
    T.StructField("close_price", T.DoubleType()),
    T.StructField("adj_close_price", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("daily_return", T.DoubleType()),
    T.StructField("price_range", T.DoubleType()),
    T.StructField("created_at", T.TimestampType()),
])

AUDIT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("layer", T.StringType()),
    T.StructField("run_date", T.DateType()),
    T.StructField("status", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])


def _coerce(c: Column, current: T.DataType | None, dtype: T.DataType, nan_to_null: bool) -> Column:
    """Cast without failing on bad text; NaN becomes NULL for doubles.

    A column already of the target type is left as is (no expression), so
    filters on it still reach the Parquet scan."""
    out = c if current == dtype else c.try_cast(dtype)
    if nan_to_null and isinstance(dtype, T.DoubleType):
        out = F.nanvl(out, F.lit(None).cast("double"))
    return out


def enforce_schema(df: DataFrame, schema: T.StructType = RAW_SCHEMA,
                   keep_extra: bool = True, nan_to_null: bool = True, mark: str | None = None) -> DataFrame:
    """Cast every declared column to its type; absent columns become typed NULLs.

    A timestamp ``date`` becomes a DATE, a DOUBLE ``volume`` a BIGINT, and NaN a
    NULL, so the quality rules see one shape whatever the writer inferred.
    ``nan_to_null=False`` is for data already normalised on write: predicates
    on untouched columns are then pushed to the scan.  ``mark`` names a BOOLEAN
    column that is true where a value was there but could not be cast, so that
    the rules can tell it from a missing one (``rules.TYPED_RULES``).
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        if f.name in present:
            cols.append(_coerce(F.col(f.name), present[f.name], f.dataType, nan_to_null).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    if mark:
        failed = [F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
                  for f in schema.fields if f.name in present and present[f.name] != f.dataType]
        cols.append(reduce(lambda a, b: a | b, failed, F.lit(False)).alias(mark))
    if keep_extra:
        declared = {f.name for f in schema.fields}
        cols += [F.col(c) for c in df.columns if c not in declared]
    return df.select(*cols)


def schema_mismatches(source: T.StructType, target: T.StructType) -> list[str]:
    """Differences between two schemas by column name and type."""
    src = {f.name: f.dataType.simpleString() for f in source.fields}
    tgt = {f.name: f.dataType.simpleString() for f in target.fields}
    out = []
    for name in sorted(set(src) | set(tgt)):
        if name not in tgt:
            out.append(f"new column {name} {src[name]}")
        elif name not in src:
            out.append(f"missing column {name} {tgt[name]}")
        elif src[name] != tgt[name]:
            out.append(f"type change {name}: {tgt[name]} -> {src[name]}")
    return out


class SchemaChangeError(ValueError):
    pass


def assert_same_schema(source: T.StructType, target: T.StructType) -> None:
    diff = schema_mismatches(source, target)
    if diff:
        raise SchemaChangeError("schema change not allowed: " + "; ".join(diff))
