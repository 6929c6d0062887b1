"""The registered queries as SQL over the same tables, written independently of the Spark side."""

from __future__ import annotations

from functools import lru_cache

_TICKS = """
ticks0 AS (
    SELECT event_id, upper(event_type) AS symbol, CAST(value AS DECIMAL(18,2)) AS price,
           CAST(event_id % 3 AS DECIMAL(18,2)) AS spread,
           CAST(json_extract_string(props, '$.k') AS BIGINT) * 1000 + event_id % 1000 AS volume,
           ts AS event_time
    FROM events),
ticks AS (
    SELECT event_id, symbol, price, price AS open_price,
           CAST(price + spread AS DECIMAL(18,2)) AS high_price,
           CAST(greatest(CAST(0.01 AS DECIMAL(18,2)), CAST(price - spread AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS low_price,
           volume, event_time,
           event_time + to_seconds(event_id * 37 % 300) AS inserted_at,
           event_time + to_minutes(event_id * 37 % 300) AS late_at,
           CAST(event_id % 4 AS INTEGER) AS partition, CAST(event_id // 4 AS BIGINT) AS "offset"
    FROM ticks0)"""

_HEAVY = """
heavy AS (
    SELECT l_returnflag || l_linestatus AS symbol, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
           CAST(l_quantity AS BIGINT) AS volume, l_shipdate AS event_time
    FROM lineitem)"""


def _curate(source: str, width: str, places: int | None = None) -> str:
    average = "CAST(sum(price) AS DOUBLE) / count(*)"
    return f"""
    SELECT time_bucket(INTERVAL '{width}', event_time) + INTERVAL '{width}' AS batch_time, symbol,
           {average if places is None else f"round({average}, {places})"} AS avg_price,
           CAST(min(price) AS DOUBLE) AS min_price, CAST(max(price) AS DOUBLE) AS max_price,
           CAST(sum(volume) AS BIGINT) AS total_volume, count(*) AS event_count,
           max(event_time) AS latest_event_time
    FROM {source} WHERE event_time IS NOT NULL GROUP BY 1, 2"""


_REVISIONS = """
staged AS (
    SELECT *, CAST(epoch_us(late_at) // 864000000000 AS BIGINT) AS batch_id,
           time_bucket(INTERVAL '{width}', event_time) + INTERVAL '{width}' AS batch_time
    FROM ticks),
touched AS (SELECT DISTINCT batch_id, batch_time, symbol FROM staged),
revised AS (
    SELECT t.batch_id, t.batch_time, t.symbol,
           round(CAST(sum(s.price) AS DOUBLE) / count(*), 9) AS avg_price,
           CAST(min(s.price) AS DOUBLE) AS min_price, CAST(max(s.price) AS DOUBLE) AS max_price,
           CAST(sum(s.volume) AS BIGINT) AS total_volume, count(*) AS event_count,
           max(s.event_time) AS latest_event_time,
           make_timestamp((t.batch_id + 1) * 864000000000) AS inserted_at
    FROM touched t JOIN staged s
      ON s.batch_time = t.batch_time AND s.symbol = t.symbol AND s.batch_id <= t.batch_id
    GROUP BY ALL)"""

_CURATED_COLUMNS = """batch_time, symbol, avg_price, min_price, max_price, total_volume, event_count, latest_event_time"""

_PRICE_COLUMNS = """symbol, CAST(price AS DOUBLE) AS price, CAST(open_price AS DOUBLE) AS open_price,
    CAST(high_price AS DOUBLE) AS high_price, CAST(low_price AS DOUBLE) AS low_price, volume, event_time"""

_RECENT = "recent AS (SELECT * FROM ticks ORDER BY inserted_at DESC, event_id DESC LIMIT 1000)"
_RECENT_LATEST = """
latest AS (
    SELECT DISTINCT ON (symbol) * FROM recent WHERE symbol IS NOT NULL
    ORDER BY symbol, event_time DESC NULLS FIRST, event_id DESC)"""


def _messages(arrival: str) -> str:
    stamp = "replace(CAST(event_time AS VARCHAR), ' ', 'T') || '+00:00'"
    return f"""{_TICKS},
shaped AS (
    SELECT *, event_id % 101 AS c, {arrival} AS arrival,
           CASE WHEN event_id % 101 = 6 THEN '"symbol": " \\t "'
                WHEN event_id % 101 = 7 THEN '"symbol": "' || rpad(symbol, 25, 'X') || '"'
                WHEN event_id % 101 = 10 THEN '"symbol": null'
                ELSE '"symbol": "' || symbol || '"' END AS p_symbol,
           CASE WHEN event_id % 101 = 4 THEN '"price": "abc"'
                WHEN event_id % 101 = 9 THEN '"price": "' || price || '"'
                ELSE '"price": ' || price END AS p_price,
           CASE WHEN event_id % 101 <> 3 THEN '"open": ' || open_price END AS p_open,
           CASE WHEN event_id % 101 <> 2 THEN '"high": ' || high_price END AS p_high,
           '"low": ' || low_price AS p_low,
           CASE WHEN event_id % 101 = 5 THEN '"volume": null'
                WHEN event_id % 101 <> 3 THEN '"volume": ' || volume END AS p_volume,
           CASE WHEN event_id % 101 = 8 THEN '"event_time": "garbage"'
                WHEN event_id % 101 = 11 THEN '"event_time": null'
                ELSE '"event_time": "' || {stamp} || '"' END AS p_time
    FROM ticks),
joined AS (
    SELECT *, concat_ws(', ', p_symbol, p_price, p_open, p_high, p_low, p_volume, p_time) AS body FROM shaped),
messages AS (
    SELECT event_id, 'ticks' AS topic, partition, "offset", arrival,
           CASE WHEN c = 0 THEN '{{' || body WHEN c = 1 THEN '[{{' || body || '}}]' ELSE '{{' || body || '}}' END AS payload
    FROM joined)"""


def _is_float(name: str) -> str:
    return f"""(json_type(j, '$.{name}') IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'BOOLEAN')
        OR (json_type(j, '$.{name}') = 'VARCHAR'
            AND regexp_full_match(json_extract_string(j, '$.{name}'), '\\s*[+-]?[0-9]+(\\.[0-9]*)?\\s*')))"""


def _judged(arrival: str = "inserted_at") -> str:
    fields = ("symbol", "price", "open", "high", "low", "volume", "event_time")
    absent = ", ".join(f"CASE WHEN json_type(j, '$.{f}') IS NULL THEN '{f}' END" for f in fields)
    floats = " AND ".join(_is_float(f) for f in ("price", "open", "high", "low"))
    return f"""{_messages(arrival)},
read0 AS (
    SELECT *, CASE WHEN json_valid(payload) AND json_type(CASE WHEN json_valid(payload) THEN payload ELSE 'null' END) = 'OBJECT'
                   THEN payload END AS j
    FROM messages),
read AS (
    SELECT *, concat_ws(', ', {absent}) AS missing,
           CASE WHEN json_type(j, '$.symbol') <> 'NULL' THEN json_extract_string(j, '$.symbol') END AS symbol,
           CASE WHEN json_type(j, '$.event_time') <> 'NULL' THEN json_extract_string(j, '$.event_time') END AS time_text
    FROM read0),
judged AS (
    SELECT *,
           CASE WHEN j IS NULL THEN 'Event payload is not a JSON object'
                WHEN missing <> '' THEN 'Missing required fields: ' || missing
                WHEN NOT ({floats}) OR json_type(j, '$.volume') NOT IN ('BIGINT', 'UBIGINT')
                    THEN 'Numeric fields contain invalid values'
                WHEN symbol IS NOT NULL AND regexp_full_match(symbol, '\\s*') THEN 'Symbol is empty' END AS invalid,
           CASE WHEN length(symbol) > 20 THEN 'Load error: symbol is too long'
                WHEN time_text IS NOT NULL AND TRY_CAST(time_text AS TIMESTAMP) IS NULL
                    THEN 'Load error: event_time is not a timestamp' END AS unloaded
    FROM read),
classified AS (
    SELECT topic, partition, "offset", arrival, payload,
           CASE WHEN invalid IS NOT NULL THEN 'invalid' WHEN unloaded IS NOT NULL THEN 'load_failed'
                ELSE 'inserted' END AS status,
           coalesce(invalid, unloaded) AS error_message, symbol,
           TRY_CAST(json_extract_string(j, '$.price') AS DOUBLE) AS price,
           TRY_CAST(json_extract_string(j, '$.open') AS DOUBLE) AS open_price,
           TRY_CAST(json_extract_string(j, '$.high') AS DOUBLE) AS high_price,
           TRY_CAST(json_extract_string(j, '$.low') AS DOUBLE) AS low_price,
           TRY_CAST(json_extract_string(j, '$.volume') AS BIGINT) AS volume,
           TRY_CAST(time_text AS TIMESTAMP) AS event_time
    FROM judged)"""


_FAST = "TIMESTAMP '2024-01-01 00:00:00' + to_seconds(event_id)"

_COUNTERS = """
counted AS (
    SELECT topic, arrival, partition, "offset", status,
           count(*) OVER w AS processed,
           CAST(sum(CASE WHEN status = 'inserted' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS inserted,
           CAST(sum(CASE WHEN status = 'inserted' THEN 0 ELSE 1 END) OVER w AS BIGINT) AS failed
    FROM classified
    WINDOW w AS (PARTITION BY topic ORDER BY arrival, partition, "offset" ROWS UNBOUNDED PRECEDING))"""

_REPORTS = """
reports AS (
    SELECT topic, 'consumer_success_ratio' AS metric_name,
           CAST(inserted AS DOUBLE) / CAST(processed AS DOUBLE) AS metric_value,
           '{"processed":' || processed || ',"inserted":' || inserted || ',"failed":' || failed
               || ',"topic":"' || topic || '","success_ratio":'
               || CAST(CAST((inserted * 20000 + processed) // (2 * processed) AS DOUBLE) / 10000.0 AS VARCHAR)
               || '}' AS extra_data,
           arrival AS recorded_at, processed, inserted, failed
    FROM counted WHERE processed % 50 = 0 AND status <> 'invalid')"""

_ALERTS = """
candidates AS (
    SELECT *, CASE WHEN failed >= 10 THEN 'failure-threshold-reached' ELSE 'success-ratio-below-threshold' END AS reason,
           min(recorded_at) OVER (ORDER BY recorded_at
               RANGE BETWEEN INTERVAL 120 SECOND FOLLOWING AND UNBOUNDED FOLLOWING) AS following
    FROM reports WHERE failed >= 10 OR metric_value < 0.9),
walk AS (
    SELECT recorded_at, following FROM candidates WHERE recorded_at = (SELECT min(recorded_at) FROM candidates)
    UNION ALL
    SELECT c.recorded_at, c.following FROM walk w JOIN candidates c ON c.recorded_at = w.following)"""

_HEALTH = f"{_judged(_FAST)},{_COUNTERS},{_REPORTS}"
_METRICS = f"WITH {_HEALTH} SELECT metric_name, metric_value, extra_data, recorded_at FROM reports"
_ALERT_LOG = f"""WITH RECURSIVE {_HEALTH},{_ALERTS}
    SELECT topic, 'tick-consumer' AS pipeline, reason, extra_data AS summary, recorded_at AS raised_at
    FROM candidates WHERE recorded_at IN (SELECT recorded_at FROM walk)"""


def _draw(place: int, low: int, high: int) -> str:
    digits = f"CAST('0x' || substr(digest, {1 + 6 * place}, 6) AS BIGINT)"
    return f"({digits} * {high - low + 1} // 16777216 + {low})"


_DRAWN = f"""
drawn AS (
    SELECT event_id AS id, digest, {_draw(0, 5000, 50000)} AS cents, {_draw(1, 0, 200)} AS under,
           {_draw(2, 0, 200)} AS over_, {_draw(3, 0, 200)} AS depth, {_draw(4, 1000, 5000000)} AS volume
    FROM (SELECT event_id, md5('7:' || event_id) AS digest FROM events)),
generated AS (
    SELECT id, (['AAPL', 'MSFT', 'GOOGL', 'TSLA', 'NVDA'])[id % 5 + 1] AS symbol,
           cents / 100.0::DOUBLE AS price, (cents - under) / 100.0::DOUBLE AS open, (cents + over_) / 100.0::DOUBLE AS high,
           greatest(1, cents - depth) / 100.0::DOUBLE AS low, volume,
           TIMESTAMP '2024-01-01 00:00:00' + to_microseconds(id * 1000) AS event_time
    FROM drawn)"""

_LISTS = """
lists AS (
    SELECT event_id, ' ' || event_type || ' ,'
           || CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN '  ' ELSE chr(9) || event_type || '_x ' END
           || ',' || upper(event_type) AS symbols
    FROM events),
parts AS (
    SELECT event_id, CAST(generate_subscripts(string_split(symbols, ','), 1) - 1 AS INTEGER) AS position,
           unnest(string_split(symbols, ',')) AS part
    FROM lists),
cleaned AS (
    SELECT event_id, position, upper(regexp_replace(part, '^\\s+|\\s+$', '', 'g')) AS symbol FROM parts)"""

_WINDOW_FROM_JSON = f"""
WITH {_messages('inserted_at')},
read AS (
    SELECT CASE WHEN json_valid(payload) AND json_type(CASE WHEN json_valid(payload) THEN payload ELSE 'null' END) = 'OBJECT'
                THEN payload END AS j FROM messages),
streamed AS (
    SELECT json_extract_string(j, '$.symbol') AS symbol,
           CASE WHEN json_type(j, '$.price') IN ('DOUBLE', 'BIGINT', 'UBIGINT')
                THEN CAST(json_extract_string(j, '$.price') AS DECIMAL(18,2)) END AS price,
           CASE WHEN json_type(j, '$.volume') IN ('BIGINT', 'UBIGINT')
                THEN CAST(json_extract_string(j, '$.volume') AS BIGINT) END AS volume,
           TRY_CAST(json_extract_string(j, '$.event_time') AS TIMESTAMP) AS event_time
    FROM read)
{_curate('streamed', '1 hour', 9)}"""

_LATE = f"""
WITH {_TICKS},
clock AS (SELECT min(epoch_us(late_at)) AS low, max(epoch_us(late_at)) + 1 - min(epoch_us(late_at)) AS span FROM ticks),
edges AS (SELECT i, low + span * i // 3 AS edge FROM clock, range(4) t(i)),
fed AS (
    SELECT t.*, e.i AS part, time_bucket(INTERVAL '1 hour', event_time) + INTERVAL '1 hour' AS closes
    FROM ticks t JOIN edges e ON epoch_us(late_at) >= e.edge
    JOIN edges n ON n.i = e.i + 1 AND epoch_us(late_at) < n.edge),
marks AS (SELECT p.part, max(f.event_time) - INTERVAL 2 MINUTE AS mark
          FROM (SELECT DISTINCT part FROM fed) p JOIN fed f ON f.part < p.part GROUP BY 1),
kept AS (SELECT f.* FROM fed f LEFT JOIN marks m USING (part) WHERE m.mark IS NULL OR f.closes > m.mark)
"""


@lru_cache(maxsize=1)
def _build() -> dict[str, str]:
    sql: dict[str, str] = {}

    sql["curated_window"] = f"WITH {_TICKS} {_curate('ticks', '1 minute')}"
    sql["curated_hour"] = f"WITH {_TICKS} {_curate('ticks', '1 hour')}"
    sql["curated_heavy_day"] = f"WITH {_HEAVY} {_curate('heavy', '1 day')}"
    sql["curated_from_json"] = _WINDOW_FROM_JSON
    hourly = _REVISIONS.format(width="1 hour")
    minutes = _REVISIONS.format(width="1 minute")
    sql["curated_revisions"] = f"""WITH {_TICKS},{hourly}
        SELECT dense_rank() OVER (ORDER BY batch_id) - 1 AS batch_id, {_CURATED_COLUMNS} FROM revised"""
    sql["curated_current"] = f"WITH {_TICKS} {_curate('ticks', '1 hour', 9)}"

    sql["view_latest"] = f"""WITH {_TICKS}
        SELECT DISTINCT ON (symbol) {_PRICE_COLUMNS}, inserted_at FROM ticks
        ORDER BY symbol, event_time DESC NULLS FIRST, event_id DESC"""
    sql["view_latest_long"] = sql["view_latest"]
    sql["view_latest_nulls"] = f"""WITH {_judged()}
        SELECT DISTINCT ON (symbol) {_PRICE_COLUMNS}, arrival AS inserted_at FROM classified WHERE status = 'inserted'
        ORDER BY symbol, event_time DESC NULLS FIRST, arrival DESC, partition DESC, "offset" DESC"""
    sql["view_curated_recent"] = f"""WITH {_TICKS},{minutes}
        SELECT {_CURATED_COLUMNS}, inserted_at FROM revised ORDER BY batch_time DESC"""
    sql["view_latency"] = f"""WITH {_TICKS},{minutes}
        SELECT symbol, batch_time, latest_event_time,
               extract(epoch FROM (batch_time - latest_event_time)) AS latency_seconds, inserted_at
        FROM revised ORDER BY batch_time DESC"""

    sql["recent_ticks"] = f"WITH {_TICKS},{_RECENT} SELECT {_PRICE_COLUMNS}, inserted_at FROM recent"
    sql["dashboard_latest"] = f"WITH {_TICKS},{_RECENT},{_RECENT_LATEST} SELECT {_PRICE_COLUMNS} FROM latest"
    sql["latest_volume"] = f"WITH {_TICKS},{_RECENT},{_RECENT_LATEST} SELECT symbol, volume FROM latest"
    sql["dashboard_kpis"] = f"""WITH {_TICKS},{_RECENT},{_RECENT_LATEST}
        SELECT (SELECT count(DISTINCT symbol) FROM latest) AS tracked_symbols,
               (SELECT count(*) FROM recent) AS latest_records,
               (SELECT CAST(coalesce(sum(volume), 0) AS BIGINT) FROM latest) AS total_volume"""
    sql["price_series"] = f"""WITH {_TICKS},{_RECENT}
        SELECT symbol, event_time, CAST(price AS DOUBLE) AS price FROM recent ORDER BY symbol, event_time"""
    sql["recent_prices"] = f"""WITH {_TICKS}
        SELECT {_PRICE_COLUMNS}, inserted_at FROM ticks ORDER BY inserted_at DESC, event_id DESC LIMIT 10"""
    sql["recent_curated"] = f"""WITH {_TICKS},{minutes}
        SELECT {_CURATED_COLUMNS}, inserted_at FROM revised
        ORDER BY inserted_at DESC, batch_time DESC, symbol DESC LIMIT 10"""
    dead = """SELECT topic AS source_topic, partition AS source_partition, "offset" AS source_offset,
              error_message, payload"""
    sql["recent_dead_letters"] = f"""WITH {_judged()} {dead}, arrival AS created_at FROM classified
        WHERE status <> 'inserted' ORDER BY arrival DESC, partition DESC, "offset" DESC LIMIT 10"""
    sql["recent_metrics"] = f"""WITH {_HEALTH} SELECT metric_name, metric_value, recorded_at FROM reports
        ORDER BY recorded_at DESC LIMIT 10"""
    sql["tick_count"] = "SELECT count(*) AS row_count FROM events"

    sql["parse_ticks"] = f"""WITH {_messages('inserted_at')},
        read AS (
            SELECT partition, "offset",
                   CASE WHEN json_valid(payload)
                         AND json_type(CASE WHEN json_valid(payload) THEN payload ELSE 'null' END) = 'OBJECT'
                        THEN payload END AS j FROM messages)
        SELECT partition, "offset", json_extract_string(j, '$.symbol') AS symbol,
               {", ".join(f"CASE WHEN json_type(j, '$.{f}') IN ('DOUBLE', 'BIGINT', 'UBIGINT') THEN CAST(json_extract_string(j, '$.{f}') AS DOUBLE) END AS {f}" for f in ("price", "open", "high", "low"))},
               CASE WHEN json_type(j, '$.volume') IN ('BIGINT', 'UBIGINT')
                    THEN CAST(json_extract_string(j, '$.volume') AS BIGINT) END AS volume,
               TRY_CAST(json_extract_string(j, '$.event_time') AS TIMESTAMP) AS event_time
        FROM read"""
    sql["ingest_valid"] = f"""WITH {_judged()}
        SELECT symbol, price, open_price, high_price, low_price, volume, event_time, partition, "offset"
        FROM classified WHERE status = 'inserted'"""
    sql["ingest_dead_letter"] = f"WITH {_judged()} {dead} FROM classified WHERE status <> 'inserted'"
    sql["ingest_split_counts"] = f"""WITH {_judged()}
        SELECT status, error_message, count(*) AS messages FROM classified GROUP BY 1, 2"""

    sql["running_counters"] = f"""WITH {_judged()},{_COUNTERS}
        SELECT topic, arrival, partition, "offset", status, processed, inserted, failed FROM counted"""
    sql["health_metrics"] = _METRICS
    sql["alerts"] = _ALERT_LOG

    sql["synthetic_ticks"] = f"""WITH {_DRAWN}
        SELECT id, symbol, price, open, high, low, volume, event_time FROM generated"""
    sql["publish_values"] = f"""WITH {_DRAWN}
        SELECT 'ticks' AS topic, symbol AS "key",
               '{{"symbol":"' || symbol || '","price":' || price || ',"open":' || open || ',"high":' || high
               || ',"low":' || low || ',"volume":' || volume || ',"event_time":"'
               || replace(CAST(event_time AS VARCHAR), ' ', 'T') || '+00:00"}}' AS "value"
        FROM generated"""
    sql["symbol_normalise"] = f"WITH {_LISTS} SELECT event_id, position, symbol FROM cleaned WHERE symbol <> ''"
    sql["symbol_poll_list"] = f"WITH {_LISTS} SELECT event_id, position, symbol FROM cleaned"
    sql["latest_bar_per_symbol"] = """
        WITH bars AS (
            SELECT event_id, upper(event_type) AS symbol, ts, CAST(value AS DECIMAL(18,4)) AS o,
                   CAST((event_id % 8) * CAST(0.1255 AS DECIMAL(5,4)) AS DECIMAL(18,4)) AS d,
                   CAST(json_extract_string(props, '$.k') AS BIGINT) * 1000 AS volume
            FROM events WHERE ts >= DATE '2024-01-15' AND ts < DATE '2024-01-16'),
        last AS (SELECT DISTINCT ON (symbol) * FROM bars ORDER BY symbol, ts DESC, event_id DESC)
        SELECT symbol, CAST(round(CAST(o + CAST(d * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(18,5)) AS DECIMAL(18,4)), 2) AS DOUBLE) AS price,
               CAST(round(o, 2) AS DOUBLE) AS open, CAST(round(CAST(o + d AS DECIMAL(18,4)), 2) AS DOUBLE) AS high,
               CAST(round(CAST(o - d AS DECIMAL(18,4)), 2) AS DOUBLE) AS low, volume,
               '2024-02-01T12:00:00+00:00' AS event_time
        FROM last"""
    sql["load_reconcile"] = f"""WITH {_judged()},{_HEAVY},
        published AS (
            SELECT CASE WHEN json_valid(payload)
                    AND json_type(CASE WHEN json_valid(payload) THEN payload ELSE 'null' END) = 'OBJECT'
                   THEN json_extract_string(payload, '$.symbol') END AS symbol, count(*) AS n
            FROM messages GROUP BY 1),
        held AS (SELECT symbol, count(*) AS n FROM heavy GROUP BY 1),
        arrived AS (SELECT symbol, count(*) AS n FROM classified WHERE status = 'inserted' GROUP BY 1),
        names AS (SELECT symbol FROM published UNION SELECT symbol FROM held UNION SELECT symbol FROM arrived)
        SELECT s.symbol, coalesce(p.n, 0) AS published, coalesce(h.n, 0) AS start_rows,
               coalesce(h.n, 0) + coalesce(a.n, 0) AS end_rows, coalesce(a.n, 0) AS inserted_delta,
               CASE WHEN coalesce(a.n, 0) > 0 THEN 'PASS' ELSE 'CHECK' END AS verdict,
               coalesce(a.n, 0) >= coalesce(p.n, 0) AS complete
        FROM names s LEFT JOIN published p ON p.symbol IS NOT DISTINCT FROM s.symbol
        LEFT JOIN held h ON h.symbol IS NOT DISTINCT FROM s.symbol
        LEFT JOIN arrived a ON a.symbol IS NOT DISTINCT FROM s.symbol"""
    sql["lost_offsets"] = f"""WITH {_judged()}
        SELECT topic, partition, "offset", 1::BIGINT AS published, 0::BIGINT AS held, 'lost' AS finding
        FROM classified WHERE status <> 'inserted'"""
    sql["throughput"] = f"""WITH {_TICKS}, spans AS (
            SELECT symbol, count(*) AS events, epoch_us(max(event_time)) - epoch_us(min(event_time)) AS us
            FROM ticks GROUP BY 1)
        SELECT symbol, events, CAST(us AS DOUBLE) / 1e6 AS elapsed_seconds,
               CASE WHEN us > 0 THEN events / (CAST(us AS DOUBLE) / 1e6) ELSE 0.0 END AS rate FROM spans"""

    sql["stream_window_update"] = _WINDOW_FROM_JSON
    sql["stream_window_append"] = f"""WITH {_TICKS}, windows AS ({_curate('ticks', '1 hour', 9)})
        SELECT * FROM windows WHERE batch_time <= (SELECT max(event_time) - INTERVAL 2 MINUTE FROM ticks)"""
    sql["stream_late_drop"] = f"{_LATE} {_curate('kept', '1 hour', 9)}"
    sql["stream_late_rows"] = f"""{_LATE},
        windows AS ({_curate('kept', '1 hour', 9)})
        SELECT batch_time, symbol, avg_price, event_count, CAST(NULL AS INTEGER) AS partition,
               CAST(NULL AS BIGINT) AS "offset", CAST(NULL AS VARCHAR) AS reason FROM windows
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, partition, "offset", 'late' FROM fed ANTI JOIN kept USING (event_id)"""
    sql["stream_ingest"] = f"""WITH {_judged()}
        SELECT partition, "offset",
               CASE WHEN status = 'inserted' THEN symbol END AS symbol,
               CASE WHEN status = 'inserted' THEN price END AS price,
               CASE WHEN status = 'inserted' THEN volume END AS volume, error_message
        FROM classified"""
    sql["stream_health"] = _METRICS
    sql["stream_alerts"] = _ALERT_LOG
    return sql


def all_oracles() -> dict[str, str]:
    return dict(_build())
