"""The same results in SQL, straight from the test tables: no JSON is built or parsed here."""

from __future__ import annotations

from quoteflow.plans.registry import END, START

SYMBOLS = """
membership AS (
  SELECT CAST(o_custkey % 25 AS INTEGER) AS PortfolioID,
         CASE o_orderkey % 6 WHEN 0 THEN 's' || o_custkey WHEN 1 THEN '  S' || o_custkey || ' '
              WHEN 2 THEN NULL WHEN 3 THEN '' WHEN 4 THEN '   ' ELSE 'S' || o_custkey END AS Symbol,
         o_orderstatus = 'O' AS IsActive
  FROM orders),
symbols AS (
  SELECT DISTINCT PortfolioID, upper(trim(Symbol)) AS Symbol
  FROM membership WHERE IsActive AND Symbol IS NOT NULL AND Symbol <> '')
"""

QUOTES = """
quotes AS (
  SELECT event_id AS SnapshotId, 'S' || user_id AS Symbol,
         CAST(value AS DECIMAL(18,4)) AS LastPrice,
         CAST(CAST(value AS DECIMAL(18,4)) - 0.01 AS DECIMAL(18,4)) AS BidPrice,
         CAST(CAST(value AS DECIMAL(18,4)) + 0.01 AS DECIMAL(18,4)) AS AskPrice,
         CASE event_type WHEN 'click' THEN date_trunc('millisecond', ts)
              WHEN 'view' THEN date_trunc('second', ts)
              WHEN 'purchase' THEN date_trunc('second', ts)
              WHEN 'signup' THEN date_trunc('millisecond', ts) END AS QuoteTime,
         json_extract_string(props, '$.k') AS k, event_type, event_id, user_id, ts
  FROM events)
"""

RAW = "SnapshotId, Symbol, LastPrice, BidPrice, AskPrice, QuoteTime"

STAGE = f"""
WITH {QUOTES}
SELECT Symbol, LastPrice, BidPrice, AskPrice, QuoteTime, '{{"k":' || k || '}}' AS Fundamental, SnapshotId
FROM quotes WHERE QuoteTime IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY Symbol ORDER BY QuoteTime DESC, SnapshotId DESC) = 1
"""


def _latest(rows: str) -> str:
    return f"""
SELECT Symbol, LastPrice, BidPrice, AskPrice, QuoteTime, SnapshotId FROM ({rows})
QUALIFY row_number() OVER (PARTITION BY Symbol ORDER BY QuoteTime DESC NULLS LAST, SnapshotId DESC) = 1
"""


def _manifest(batch_size: int) -> str:
    return f"""
WITH {SYMBOLS},
spread AS (
  SELECT s.*, ('0x' || left(md5(Symbol), 8))::BIGINT
              % CAST(ceil(count(*) OVER (PARTITION BY PortfolioID) / {batch_size}.0) AS BIGINT) AS bucket
  FROM symbols s),
numbered AS (
  SELECT *, CAST((row_number() OVER (PARTITION BY PortfolioID, bucket ORDER BY Symbol) - 1)
                 // {batch_size} AS BIGINT) AS part
  FROM spread)
SELECT PortfolioID, bucket, part, count(*) AS n_symbols, string_agg(Symbol, ',' ORDER BY Symbol) AS symbols,
       'quote,fundamental' AS fields
FROM numbered GROUP BY PortfolioID, bucket, part
"""


TICKS = f"""
ticks AS (
  SELECT 'S' || user_id AS Symbol, ts, event_id AS TickId, CAST(value AS DECIMAL(18,4)) AS Price,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS Volume
  FROM events
  WHERE ts >= TIMESTAMP '{START} 00:00:00' AND ts < TIMESTAMP '{END} 00:00:00' + INTERVAL 1 DAY)
"""


def _bars(unit: str) -> str:
    return f"""
WITH {TICKS}
SELECT Symbol, CAST(date_trunc('{unit}', ts) AS DATE) AS bar_date,
       first(Price ORDER BY ts, TickId) AS "open", max(Price) AS high, min(Price) AS low,
       last(Price ORDER BY ts, TickId) AS "close", CAST(sum(Volume) AS BIGINT) AS volume
FROM ticks GROUP BY ALL
"""


PORTFOLIO_ROWS = f"""SELECT {RAW} FROM quotes
WHERE Symbol IN (SELECT Symbol FROM symbols WHERE PortfolioID = 1)"""

NO_PRICES = "CAST(NULL AS DECIMAL(18,4))"

ORACLE: dict[str, str] = {
    "portfolio_symbols": f"WITH {SYMBOLS} SELECT Symbol FROM symbols WHERE PortfolioID = 1",
    "portfolio_symbols_all": f"WITH {SYMBOLS} SELECT PortfolioID, Symbol FROM symbols",
    "request_manifest": _manifest(500),
    "request_manifest_small": _manifest(20),
    "requests_fewest": f"""
WITH {SYMBOLS},
numbered AS (
  SELECT *, (row_number() OVER (PARTITION BY PortfolioID ORDER BY Symbol) - 1) // 20 AS request FROM symbols)
SELECT PortfolioID, request, count(*) AS n_symbols, string_agg(Symbol, ',' ORDER BY Symbol) AS symbols,
       'quote,fundamental' AS fields
FROM numbered GROUP BY PortfolioID, request
""",
    "quotes_raw": f"WITH {QUOTES} SELECT {RAW} FROM quotes",
    "quotes_one_file": f"""
WITH {QUOTES}
SELECT 'E' || SnapshotId AS Symbol, LastPrice, BidPrice, AskPrice, QuoteTime FROM quotes
UNION ALL
SELECT kind || SnapshotId, {NO_PRICES}, {NO_PRICES}, {NO_PRICES}, CAST(NULL AS TIMESTAMP)
FROM quotes, (SELECT unnest(['N', 'L']) AS kind) WHERE event_type = 'error'
""",
    "quotes_mixed": f"""
WITH {QUOTES}
SELECT {RAW}, CAST(NULL AS VARCHAR) AS OtherJson FROM quotes
UNION ALL
SELECT SnapshotId, 'N' || user_id, {NO_PRICES}, {NO_PRICES}, {NO_PRICES}, CAST(NULL AS TIMESTAMP),
       CASE SnapshotId % 4 WHEN 0 THEN '"oops"' WHEN 1 THEN 'null' WHEN 2 THEN '{{"quote":null}}'
            ELSE '{{"quote":[]}}' END FROM quotes
UNION ALL
SELECT SnapshotId, 'D' || user_id, LastPrice, {NO_PRICES}, {NO_PRICES}, CAST(NULL AS TIMESTAMP), NULL FROM quotes
UNION ALL
SELECT SnapshotId, 'errors', {NO_PRICES}, {NO_PRICES}, {NO_PRICES}, CAST(NULL AS TIMESTAMP),
       '{{"invalidSymbols":["X' || user_id || '"]}}' FROM quotes WHERE event_type = 'error'
""",
    # Thirteen digits as text are no epoch, but some read as yyyyMMdd, a separator and HHmm.
    "quote_time_forms": """
SELECT event_id AS SnapshotId, 'S' || user_id AS Symbol,
       CASE WHEN event_id % 16 IN (0, 10, 11, 15) THEN date_trunc('millisecond', ts)
            WHEN event_id % 16 IN (1, 3, 4, 5) THEN date_trunc('second', ts)
            WHEN event_id % 16 IN (2, 7) THEN ts
            WHEN event_id % 16 = 6 THEN CAST(date_trunc('day', ts) AS TIMESTAMP)
            WHEN event_id % 16 = 8 THEN date_trunc('minute', ts)
            WHEN event_id % 16 = 9 THEN TIMESTAMP '1970-01-01 00:00:01'
            WHEN event_id % 16 = 12
            THEN try_strptime(left(CAST(epoch_us(ts) // 1000 AS VARCHAR), 8)
                              || right(CAST(epoch_us(ts) // 1000 AS VARCHAR), 4), '%Y%m%d%H%M') END AS QuoteTime
FROM events
""",
    "quote_raw_json": f"""
WITH {QUOTES}
SELECT SnapshotId, Symbol, CAST(k AS BIGINT) AS k, AskPrice AS ask, epoch_us(ts) // 1000 AS trade_ms FROM quotes
""",
    "documents_rejected": """
SELECT event_id AS SnapshotId FROM events WHERE event_type IN ('click', 'signup', 'error')
""",
    "documents_accepted": f"""
WITH {QUOTES} SELECT {RAW} FROM quotes WHERE event_type IN ('view', 'purchase')
""",
    "quotes_one_symbol": f"WITH {QUOTES} SELECT {RAW} FROM quotes WHERE Symbol = 'S1'",
    "quotes_symbol_list": f"WITH {QUOTES} SELECT {RAW} FROM quotes WHERE Symbol IN ('S1', 'S2', 'S3')",
    "portfolio_quote_rows": f"WITH {SYMBOLS}, {QUOTES} {PORTFOLIO_ROWS}",
    "portfolio_quotes": f"WITH {SYMBOLS}, {QUOTES} {_latest(PORTFOLIO_ROWS)}",
    "quotes_latest": f"WITH {QUOTES} {_latest('SELECT * FROM quotes')}",
    "quote_coverage": f"""
WITH {SYMBOLS}, quoted AS (SELECT DISTINCT 'S' || user_id AS Symbol FROM events)
SELECT PortfolioID, count(*) AS requested, count(q.Symbol) AS received,
       count(*) - count(q.Symbol) AS missing
FROM symbols s LEFT JOIN quoted q ON s.Symbol = q.Symbol GROUP BY PortfolioID
""",
    "quotes_missing": f"""
WITH {SYMBOLS}
SELECT PortfolioID, Symbol FROM symbols WHERE Symbol NOT IN (SELECT 'S' || user_id FROM events)
""",
    "quotes_stage": STAGE,
    "quotes_stored_raw": f"WITH {QUOTES} SELECT {RAW} FROM quotes",
    "load_summary": f"""
WITH {QUOTES}
SELECT CAST(0 AS BIGINT) AS load_id, count(*) AS raw_rows,
       count(DISTINCT CASE WHEN QuoteTime IS NOT NULL THEN Symbol END) AS stage_rows FROM quotes
""",
    "portfolio_load": f"""
WITH {SYMBOLS}, {QUOTES}
SELECT Symbol, LastPrice, BidPrice, AskPrice, QuoteTime, '{{"k":' || k || '}}' AS Fundamental, SnapshotId
FROM quotes WHERE QuoteTime IS NOT NULL AND Symbol IN (SELECT Symbol FROM symbols WHERE PortfolioID = 1)
QUALIFY row_number() OVER (PARTITION BY Symbol ORDER BY QuoteTime DESC, SnapshotId DESC) = 1
""",
    "quotes_reloaded": f"WITH {QUOTES} SELECT {RAW} FROM quotes WHERE SnapshotId % 2 = 1",
    # Every price has a 1 written before it.
    "quotes_reloaded_whole": f"""
WITH {QUOTES}
SELECT SnapshotId + 1000000000 AS SnapshotId, Symbol, CAST('1' || LastPrice AS DECIMAL(18,4)) AS LastPrice,
       CAST('1' || BidPrice AS DECIMAL(18,4)) AS BidPrice, CAST('1' || AskPrice AS DECIMAL(18,4)) AS AskPrice, QuoteTime
FROM quotes
""",
    "load_counters": f"""
WITH {SYMBOLS}, {QUOTES}, portfolio AS (SELECT Symbol FROM symbols WHERE PortfolioID = 1)
SELECT CAST(0 AS BIGINT) AS load_id, (SELECT count(*) FROM portfolio) AS symbols_loaded, count(*) AS quotes_received,
       count(*) FILTER (Symbol IN (FROM portfolio)) AS raw_rows, CAST(0 AS BIGINT) AS rejected_rows,
       count(DISTINCT CASE WHEN QuoteTime IS NOT NULL AND Symbol IN (FROM portfolio) THEN Symbol END) AS stage_rows
FROM quotes
""",
    "load_rejects": """
SELECT event_id AS SnapshotId FROM events WHERE event_type IN ('click', 'signup', 'error')
""",
    "load_summary_damaged": f"""
WITH {QUOTES}
SELECT CAST(0 AS BIGINT) AS load_id, count(*) FILTER (event_type IN ('view', 'purchase')) AS raw_rows,
       count(*) FILTER (event_type NOT IN ('view', 'purchase')) AS rejected_rows,
       count(DISTINCT Symbol) FILTER (event_type IN ('view', 'purchase')) AS stage_rows FROM quotes
""",
    "price_history_one_symbol": f"WITH {TICKS} SELECT Symbol, ts, TickId, Price, Volume FROM ticks WHERE Symbol = 'S1'",
    "price_history_documents": f"""
WITH {QUOTES}
SELECT Symbol, date_trunc('millisecond', ts) AS ts, LastPrice AS "open", LastPrice AS high, LastPrice AS low,
       LastPrice AS "close", CAST(v AS BIGINT) AS volume
FROM quotes, (SELECT unnest([1, 2]) AS v) WHERE event_type NOT IN ('error', 'signup')
""",
    "price_history": f"WITH {TICKS} SELECT Symbol, ts, TickId, Price, Volume FROM ticks",
    "history_stored": f"""
WITH {TICKS} SELECT Symbol, ts, TickId, Price, Volume FROM ticks WHERE Symbol IN ('S1', 'S2', 'S3')
""",
    "history_rejects": """
SELECT event_id AS SnapshotId FROM events WHERE event_type IN ('click', 'view', 'signup')
""",
    # Sound responses have two candles for purchases, and none for errors.
    "history_loaded": """
SELECT 2 * count(*) FILTER (event_type = 'purchase') AS bars, count(*) FILTER (event_type IN ('click', 'view', 'signup')) AS rejected
FROM events
""",
    "price_bars_daily": _bars("day"),
    "price_bars_weekly": _bars("week"),
    "price_bars_monthly": _bars("month"),
    "price_bars_weekly_from_daily": _bars("week"),
    "price_bars_monthly_from_daily": _bars("month"),
    "quotes_stream_raw": f"WITH {QUOTES} SELECT {RAW} FROM quotes",
    "quotes_stream_latest": STAGE,
}
