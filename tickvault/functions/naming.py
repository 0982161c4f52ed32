"""Column-name and path helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalize_name(name: str) -> str:
    return name.lower().replace(" ", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case names and replace blanks by underscores."""
    return df.toDF(*[normalize_name(c) for c in df.columns])


def partition_value_from_path(path: Column, key: str, uri: bool = True) -> Column:
    """Value of ``key=value`` in a hive-style file path, NULL if absent.

    ``uri=True`` for URI strings such as ``_metadata.file_path``."""
    pattern = f"(?:^|/){key}=([^/]+)"
    val = F.regexp_extract(path, pattern, 1)
    # Two levels of %XX escaping: the folder name escapes special characters,
    # and a file path URI (as in ``_metadata.file_path``) escapes again.
    # Neither escapes '+', which URL decoding would read as a blank, so '+'
    # is protected before each decoding.
    def unescape(c):
        return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))

    decoded = unescape(unescape(val)) if uri else unescape(val)
    return F.when(val == "", F.lit(None)).otherwise(decoded)


def run_stamp(ts: Column) -> Column:
    """``YYYYMMDD_HHMMSS`` partition label for a run timestamp."""
    return F.date_format(ts, "yyyyMMdd_HHmmss")
