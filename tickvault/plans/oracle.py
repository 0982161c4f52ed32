"""DuckDB SQL for every registered query, built from shared CTEs.

These are written independently of the Spark code: they follow the
definitions in FIXTURES.md.
"""

from __future__ import annotations

from tickvault.plans.constants import RUN_TS, RUN_TS_ISO
from tickvault.sources.fixtures import META_SQL, QUOTES_SQL, WIDE_META_SQL, WIDE_QUOTES_SQL

RULE_CASE = """CASE
  WHEN date IS NULL OR ticker IS NULL OR open IS NULL OR high IS NULL OR low IS NULL
       OR close IS NULL OR volume IS NULL THEN 'null_in_critical_column'
  WHEN open <= 0 OR high <= 0 OR low <= 0 OR close <= 0 OR adj_close <= 0 THEN 'non_positive_price'
  WHEN volume < 0 THEN 'negative_volume'
  WHEN high < low OR high < open OR high < close THEN 'ohlc_inconsistency'
END"""

def chain(src: str = "quotes", p: str = "", processed_at: str = f"'{RUN_TS_ISO}'",
          meta: str = "meta") -> dict[str, str]:
    """The clean-layer CTE chain over the raw rows in ``src``, names prefixed by ``p``."""
    return {
        f"{p}flagged": f"SELECT *, {RULE_CASE} AS failure_reason FROM {src}",
        f"{p}clean": f"SELECT * EXCLUDE (failure_reason) FROM {p}flagged WHERE failure_reason IS NULL",
        f"{p}dedup": f"""SELECT * EXCLUDE (rn) FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker, date ORDER BY ingested_at DESC, src_id) AS rn
            FROM {p}clean) WHERE rn = 1""",
        f"{p}enriched": f"""SELECT d.*, COALESCE(m.company_name, '') AS company_name,
            COALESCE(m.sector, '') AS sector, COALESCE(m.exchange, '') AS exchange
            FROM {p}dedup d LEFT JOIN {meta} m ON d.ticker = m.ticker""",
        f"{p}silver": f"""SELECT * EXCLUDE (prev_close),
            ROUND((close - prev_close) / prev_close, 6) AS daily_return,
            ROUND(high - low, 4) AS price_range,
            {processed_at} AS processed_at, 'silver' AS layer
            FROM (SELECT *, LAG(close) OVER (PARTITION BY ticker ORDER BY date, src_id) AS prev_close
                  FROM {p}enriched)""",
    }


def fact_sql(silver: str, created_at: str = RUN_TS) -> str:
    return f"""SELECT dd.date_key, dt.ticker_key, s.open AS open_price, s.high AS high_price,
        s.low AS low_price, s.close AS close_price, s.adj_close AS adj_close_price, s.volume,
        s.daily_return, s.price_range, TIMESTAMP '{created_at}' AS created_at
        FROM {silver} s JOIN dim_date dd ON dd.full_date = s.date
        JOIN dim_ticker dt ON dt.ticker_symbol = s.ticker"""


CTES: dict[str, str] = {
    "quotes": QUOTES_SQL,
    "meta": META_SQL,
    **chain(),
    "w_quotes": WIDE_QUOTES_SQL,
    "w_meta": WIDE_META_SQL,
    **chain("w_quotes", "w_", meta="w_meta"),
    "dim_date": """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
        CAST(year(d) AS SMALLINT) AS year, CAST(quarter(d) AS SMALLINT) AS quarter,
        CAST(month(d) AS SMALLINT) AS month, rpad(monthname(d), 9, ' ') AS month_name,
        CAST(weekofyear(d) AS SMALLINT) AS week_of_year, CAST(dayofweek(d) AS SMALLINT) AS day_of_week,
        rpad(dayname(d), 9, ' ') AS day_name, dayofweek(d) IN (0, 6) AS is_weekend,
        d = last_day(d) AS is_month_end,
        d = CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS is_quarter_end
        FROM (SELECT CAST(generate_series AS DATE) AS d
              FROM generate_series(TIMESTAMP '2015-01-01', TIMESTAMP '2030-12-31', INTERVAL 1 DAY))""",
    "dim_ticker": f"""SELECT CAST(ROW_NUMBER() OVER (ORDER BY ticker, company_name, sector, exchange) AS BIGINT)
               AS ticker_key,
        ticker AS ticker_symbol, company_name, sector, CAST(NULL AS VARCHAR) AS industry, exchange,
        'USD' AS currency, TIMESTAMP '{RUN_TS}' AS created_at, TIMESTAMP '{RUN_TS}' AS updated_at
        FROM (SELECT DISTINCT ticker, company_name, sector, exchange FROM silver WHERE ticker IS NOT NULL)""",
    "fact": fact_sql("silver"),
}

# Which CTEs each CTE needs (so a query includes only what it reads).
DEPS = {
    "flagged": ["quotes"], "clean": ["flagged"], "dedup": ["clean"],
    "w_quotes": ["quotes"], "w_meta": ["meta"], "w_flagged": ["w_quotes"], "w_clean": ["w_flagged"],
    "w_dedup": ["w_clean"], "w_enriched": ["w_dedup", "w_meta"], "w_silver": ["w_enriched"],
    "enriched": ["dedup", "meta"], "silver": ["enriched"], "dim_ticker": ["silver"],
    "fact": ["silver", "dim_date", "dim_ticker"],
}


def _closure(names: list[str]) -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in DEPS.get(n, []):
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return order


def sql(body: str, *uses: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` the needed CTEs (plus ``extra`` ones, in order) then ``body``.

    ``extra`` CTEs may read the shared ones listed in ``uses``."""
    parts = [f"{n} AS ({CTES[n]})" for n in _closure(list(uses))]
    parts += [f"{n} AS ({q})" for n, q in (extra or {}).items()]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body
