"""SQL for another engine (DuckDB dialect) that must give the rows of the registered queries.

Common table expressions are kept by name; ``_sql`` puts those a query needs before it.
"""

from __future__ import annotations

import re

from tickloom import schema as S

_CTE: dict[str, str] = {}


def _iso(ns: str) -> str:
    secs = f"make_timestamp(({ns} // 1000000000) * 1000000)"
    return (
        f"strftime({secs}, '%Y-%m-%dT%H:%M:%S') || '.' || "
        f"lpad((({ns}) % 1000000000)::VARCHAR, 9, '0') || 'Z'"
    )


def _offset_iso(ns: str) -> str:
    micros = f"(({ns} // 1000) % 1000000)"
    return (
        f"strftime(make_timestamp({ns} // 1000), '%Y-%m-%dT%H:%M:%S') || "
        f"CASE WHEN {micros} = 0 THEN '' ELSE '.' || lpad({micros}::VARCHAR, 6, '0') END || '+00:00'"
    )


def _local(ns: str, tz: str = "America/Chicago") -> str:
    return f"((make_timestamp({ns} // 1000) AT TIME ZONE 'UTC') AT TIME ZONE '{tz}')"


def _session(ns: str) -> dict[str, str]:
    loc = _local(ns)
    day = (
        f"(CASE WHEN {loc}::TIME >= TIME '17:00:00' THEN {loc}::DATE + 1 ELSE {loc}::DATE END)::VARCHAR"
    )
    rth = f"({loc}::TIME >= TIME '08:30:00' AND {loc}::TIME < TIME '15:00:00')"
    return {"day": day, "rth": rth}


def _r(expr: str) -> str:
    return f"round(({expr})::DOUBLE, 6)"


_CTE["base"] = """
SELECT event_id, user_id, value, epoch_us(ts) * 1000 AS ns, user_id % 4 AS lane,
  'S' || (user_id % 4)::VARCHAR AS symbol,
  4000 + (abs(((epoch_us(ts) // 1000000) + (user_id % 4) * 7200)
      % (43200 + ((user_id % 4) // 2) * 388800)
      - (21600 + ((user_id % 4) // 2) * 194400)) * 4) // 200
    + floor(value / 2)::BIGINT AS ticks,
  event_id % 9 + 1 AS size,
  CASE WHEN event_id % 10 = 0 THEN 'N' WHEN event_id % 10 < 5 THEN 'B' ELSE 'A' END AS side
FROM events"""

_CTE["mbo"] = """
SELECT event_id, ns AS ts_event, ns + 250000 AS ts_recv, 1::BIGINT AS publisher_id,
  100 + lane AS instrument_id, action, side, ticks::DOUBLE / 4 AS price, size,
  event_id * 4 + k AS sequence, symbol, event_id * 4 + k AS source_row_number
FROM (
  SELECT *, 'T' AS action, 0 AS k FROM base
  UNION ALL SELECT *, 'F', 1 FROM base WHERE event_id % 5 = 0
  UNION ALL SELECT *, 'A', 2 FROM base WHERE event_id % 7 = 0
  UNION ALL SELECT *, 'C', 3 FROM base WHERE event_id % 11 = 0)"""

_CTE["dirty"] = """
SELECT event_id, CASE WHEN event_id % 113 <> 6 THEN ts_event END AS ts_event, ts_recv,
  publisher_id, instrument_id, symbol, source_row_number,
  CASE WHEN event_id % 107 = 4 THEN 'X' ELSE action END AS action,
  CASE WHEN event_id % 103 <> 3 THEN side END AS side,
  CASE WHEN event_id % 97 = 1 THEN price + 0.1 ELSE price END AS price,
  CASE WHEN event_id % 101 = 2 THEN 0 ELSE size END AS size,
  CASE WHEN event_id % 109 <> 5 THEN sequence END AS sequence
FROM mbo"""

_CTE["flags"] = """
SELECT *, scope AND len(reasons) = 0 AS valid FROM (
  SELECT *, coalesce(action = 'T', false) AS scope,
    [x FOR x IN [
      CASE WHEN NOT coalesce(action IN ('A','C','M','R','T','F'), false) THEN 'invalid_action' END,
      CASE WHEN NOT coalesce(side IN ('A','B','N'), false) THEN 'invalid_side' END,
      CASE WHEN ts_event IS NULL THEN 'invalid_ts_event' END,
      CASE WHEN ts_recv IS NULL THEN 'invalid_ts_recv' END,
      CASE WHEN sequence IS NULL THEN 'invalid_sequence' END,
      CASE WHEN coalesce(action = 'T', false) AND NOT price > 0 THEN 'invalid_price' END,
      CASE WHEN coalesce(action = 'T', false) AND NOT size > 0 THEN 'invalid_size' END,
      CASE WHEN coalesce(action = 'T', false) AND symbol = '' THEN 'invalid_symbol' END,
      CASE WHEN coalesce(action = 'T', false) AND NOT abs(price * 4 - round_even(price * 4, 0)) <= 1e-9
        THEN 'invalid_tick_price' END] IF x IS NOT NULL] AS reasons
  FROM dirty)"""

_S = _session("ts_event")
_TAPE = f"""
SELECT ts_event // 1000 AS ts_event, ts_event AS ts_event_ns, ts_recv // 1000 AS ts_recv,
  ts_recv AS ts_recv_ns, sequence, publisher_id, instrument_id, symbol, price, size,
  side AS aggressor_side,
  CASE side WHEN 'B' THEN size WHEN 'A' THEN -size ELSE 0 END AS signed_volume,
  side = 'N' AS unknown_aggressor, {_S['day']} AS trading_date,
  'CME_EQ_FUT_' || {_S['day']} AS session_id,
  CASE WHEN {_S['rth']} THEN 'RTH' ELSE 'OVERNIGHT' END AS session_segment,
  {_S['rth']} AS is_rth, source_row_number
FROM """
_CTE["tape"] = _TAPE + "mbo WHERE action = 'T'"
_CTE["dirty_tape"] = _TAPE + "flags WHERE valid"


def _bars(seconds: int, start: str | None = None, keys: str = "symbol, session_id") -> str:
    width = seconds * 1_000_000_000
    start = start or f"(ts_event_ns // {width}) * {width}"
    return f"""
SELECT {keys}, {start} AS bar_start_ns, arg_min(price, source_row_number) AS open,
  max(price) AS high, min(price) AS low, arg_max(price, source_row_number) AS close,
  sum(size)::BIGINT AS volume, count(*) AS trades, max(price) - min(price) AS range
FROM tape GROUP BY {keys}, {start}"""


_CTE["m30"] = _bars(1800)
_CTE["h1"] = _bars(3600)
_CTE["c15"] = _bars(900, keys="symbol")
_CTE["c30"] = _bars(1800, keys="symbol")
_CTE["c60"] = _bars(3600, keys="symbol")
_IST = "((ts_event_ns + 19800000000000) // 3600000000000) * 3600000000000 - 19800000000000"
_CTE["ist"] = _bars(3600, _IST, "symbol")
_CTE["nb"] = """
SELECT *, row_number() OVER w - 1 AS bar_no, high - low AS rng, lag(close) OVER w AS prev_close,
  lead(bar_start_ns) OVER w AS next_ns, lead(open) OVER w AS next_open,
  lead(session_id) OVER w AS next_session
FROM m30 WINDOW w AS (PARTITION BY symbol ORDER BY bar_start_ns)"""
_CTE["nb2"] = """
SELECT *, CASE WHEN next_ns = bar_start_ns + 1800000000000 AND next_session = session_id
    THEN next_ns END AS entry_ns,
  CASE WHEN next_ns = bar_start_ns + 1800000000000 AND next_session = session_id
    THEN next_open END AS entry_open, next_ns IS NULL AS is_last
FROM nb"""
_CTE["day_ranges"] = f"""
SELECT symbol, {_local('bar_start_ns', 'America/New_York')}::DATE::VARCHAR AS local_date,
  max(high) - min(low) AS day_range
FROM c30 GROUP BY 1, 2"""


def _zones(bars: str, seconds: int, keys: str) -> str:
    return f"""
SELECT {keys}, bar_start_ns AS formed_ns,
  bar_start_ns + {seconds}000000000 AS available_ns,
  CASE WHEN low > far_high THEN 'BULL' ELSE 'BEAR' END AS kind,
  CASE WHEN low > far_high THEN far_high ELSE high END AS zone_low,
  CASE WHEN low > far_high THEN low ELSE far_low END AS zone_high
FROM (SELECT *, lag(high, 2) OVER w AS far_high, lag(low, 2) OVER w AS far_low
  FROM {bars} WINDOW w AS (PARTITION BY {keys} ORDER BY bar_start_ns))
WHERE low > far_high OR high < far_low"""


_CTE["zones"] = f"""
SELECT *, (zone_low + zone_high) / 2 AS zone_mid,
  'setup_' || left(sha256('fvg|' || symbol || '|' || session_id || '|' ||
    {_offset_iso('formed_ns')} || '|' || kind || '|' || zone_low::VARCHAR || '|' ||
    zone_high::VARCHAR), 16) AS zone_id
FROM ({_zones('h1', 3600, 'symbol, session_id')})"""
_CTE["zones15"] = f"SELECT *, (zone_low + zone_high) / 2 AS zone_mid FROM ({_zones('c15', 900, 'symbol')})"
_CTE["zones30"] = f"SELECT * FROM ({_zones('c30', 1800, 'symbol')})"
_CTE["zones60"] = f"SELECT *, (zone_low + zone_high) / 2 AS zone_mid FROM ({_zones('c60', 3600, 'symbol')})"

# Greedy zone use, one step per pair of a session.
_CTE["effort3"] = """
SELECT *, rng * 3 / sum(rng) OVER w AS rr, volume * 3 / sum(volume) OVER w AS vr,
  count(*) OVER w AS n, min(rng) OVER w AS lr, min(volume) OVER w AS lv
FROM nb2 WINDOW w AS (PARTITION BY symbol ORDER BY bar_start_ns ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)"""
_CTE["gap_pairs"] = """
SELECT *, row_number() OVER (PARTITION BY symbol, session_id
    ORDER BY bar_start_ns, available_ns DESC) AS step
FROM (
  SELECT e.*, z.kind, z.zone_low, z.zone_high, z.zone_mid, z.zone_id, z.available_ns,
    floor(e.entry_open * 4 + 0.5) / 4 AS entry,
    CASE z.kind WHEN 'BULL' THEN ceil(e.high * 4) / 4 ELSE floor(e.low * 4) / 4 END AS stop
  FROM effort3 e JOIN zones z ON z.symbol = e.symbol AND z.session_id = e.session_id
    AND e.bar_start_ns - z.available_ns BETWEEN 0 AND 5400000000000
  WHERE e.n = 3 AND e.bar_no >= 3 AND e.lr > 0 AND e.lv > 0 AND e.rng > 0 AND e.entry_ns IS NOT NULL
    AND e.rr > 1.2 AND e.vr > 1.3 AND e.high >= z.zone_low AND e.low <= z.zone_high
    AND CASE z.kind WHEN 'BULL' THEN e.close < z.zone_high ELSE e.close > z.zone_low END)
WHERE CASE kind WHEN 'BULL' THEN stop - entry ELSE entry - stop END > 0"""
_CTE["gap_walk"] = """
SELECT symbol, session_id, 0::BIGINT AS step, []::VARCHAR[] AS used, NULL::BIGINT AS settled, false AS took
FROM gap_pairs GROUP BY 1, 2
UNION ALL
SELECT p.symbol, p.session_id, p.step,
  CASE WHEN p.bar_start_ns IS NOT DISTINCT FROM w.settled OR list_contains(w.used, p.zone_id)
    THEN w.used ELSE list_append(w.used, p.zone_id) END,
  CASE WHEN p.bar_start_ns IS NOT DISTINCT FROM w.settled OR list_contains(w.used, p.zone_id)
    THEN w.settled ELSE p.bar_start_ns END,
  NOT (p.bar_start_ns IS NOT DISTINCT FROM w.settled OR list_contains(w.used, p.zone_id))
FROM gap_walk w JOIN gap_pairs p ON p.symbol = w.symbol AND p.session_id = w.session_id
  AND p.step = w.step + 1"""
_CTE["gap_risk"] = """
SELECT p.*, CASE kind WHEN 'BULL' THEN 'SHORT' ELSE 'LONG' END AS side,
  CASE kind WHEN 'BULL' THEN stop - entry ELSE entry - stop END AS risk,
  CASE kind WHEN 'BULL' THEN -1 ELSE 1 END AS dir
FROM gap_pairs p JOIN gap_walk w USING (symbol, session_id, step) WHERE w.took"""
_CTE["gap_cand"] = f"""
SELECT 'setup_' || left(sha256('failed_fvg_v1|' || zone_id || '|' || {_offset_iso('bar_start_ns')}
    || '|' || side || '|' || entry::DECIMAL(18,2)::VARCHAR), 16) AS setup_id,
  bar_start_ns // 1000 AS ts_event, symbol, session_id AS cme_session_id,
  CASE side WHEN 'SHORT' THEN 'FAILED_BULL_FVG' ELSE 'FAILED_BEAR_FVG' END AS setup_type,
  side AS entry_side, {_r('zone_mid')} AS reference_level, entry AS entry_price,
  entry_ns // 1000 AS entry_timestamp,
  CASE side WHEN 'SHORT' THEN high ELSE low END AS structural_invalidation, stop AS stop_price,
  entry + dir * risk AS target_1, entry + dir * risk * 2 AS target_2,
  entry + dir * risk * 4 AS target_3, 12::BIGINT AS max_holding_bars,
  21600::BIGINT AS max_holding_seconds,
  CASE side WHEN 'SHORT' THEN 'FAILED_BULL_FVG_SHORT' ELSE 'FAILED_BEAR_FVG_LONG' END
    || ',FVG_OVERLAP_CONFIRMED,EFFORT_WITHOUT_RESULT' AS reason_codes,
  bar_start_ns // 1000 AS feature_timestamp, 'failed_fvg_v1' AS setup_version, zone_id AS fvg_id,
  zone_low AS fvg_low, zone_high AS fvg_high, {_r('rr')} AS effort_range_ratio,
  {_r('vr')} AS effort_volume_ratio
FROM gap_risk"""

# Exponential averages by recurrence over bar numbers.
_CTE["walk"] = """
SELECT symbol, bar_no, close AS f, close AS s, 0.0::DOUBLE AS line, 0.0::DOUBLE AS trig,
  close AS e200
FROM nb WHERE bar_no = 0
UNION ALL
SELECT symbol, bar_no, f, s, f - s, ((f - s) - trig) * (2.0::DOUBLE / 10) + trig, e200
FROM (SELECT n.symbol, n.bar_no, (n.close - w.f) * (2.0::DOUBLE / 13) + w.f AS f,
    (n.close - w.s) * (2.0::DOUBLE / 27) + w.s AS s, w.trig,
    (n.close - w.e200) * (2.0::DOUBLE / 201) + w.e200 AS e200
  FROM walk w JOIN nb n ON n.symbol = w.symbol AND n.bar_no = w.bar_no + 1)"""
_CTE["ind"] = """
SELECT b.*, k.line, k.trig,
  CASE WHEN b.bar_no < 14 THEN NULL WHEN loss = 0 AND gain > 0 THEN 100.0 WHEN loss = 0 THEN 50.0
    ELSE 100.0 - 100.0 / (1.0 + gain / loss) END AS rsi,
  CASE WHEN b.bar_no >= 14 AND min(tr) OVER t > 0 THEN sum(tr) OVER t END AS tr_sum
FROM (SELECT *, greatest(rng, abs(high - prev_close), abs(low - prev_close)) AS tr,
    sum(greatest(close - prev_close, 0)) OVER t AS gain,
    sum(greatest(prev_close - close, 0)) OVER t AS loss
  FROM nb2 WINDOW t AS (PARTITION BY symbol ORDER BY bar_start_ns ROWS 13 PRECEDING)) b
JOIN walk k USING (symbol, bar_no)
WINDOW t AS (PARTITION BY b.symbol ORDER BY b.bar_start_ns ROWS 13 PRECEDING)"""
_CTE["sided"] = """
SELECT *, CASE WHEN rsi > 50 AND round(line, 9) > round(trig, 9) AND round(line, 9) > 0 THEN 1
    WHEN rsi < 50 AND round(line, 9) < round(trig, 9) AND round(line, 9) < 0 THEN -1 END AS dir,
  floor(entry_open * 4 + 0.5) / 4 AS entry
FROM ind WHERE bar_no >= 33 AND entry_ns IS NOT NULL AND tr_sum IS NOT NULL"""
_CTE["tech_priced"] = """
SELECT *, abs(entry - stop) AS risk FROM (
  SELECT *, CASE dir WHEN 1 THEN floor((entry::DECIMAL(18,4) * 28 - tr_sum::DECIMAL(18,4) * 4)::BIGINT / 7.0)
      ELSE ceil((entry::DECIMAL(18,4) * 28 + tr_sum::DECIMAL(18,4) * 4)::BIGINT / 7.0) END / 4 AS stop
  FROM sided WHERE dir IS NOT NULL)
WHERE dir * (entry - stop) > 0"""
_CTE["tech"] = f"""
SELECT sha256('qep_technical_v1|' || {_offset_iso('bar_start_ns')} || '|' ||
    CASE dir WHEN 1 THEN 'LONG' ELSE 'SHORT' END || '|' || entry::DECIMAL(18,2)::VARCHAR) AS setup_id,
  bar_start_ns // 1000 AS ts_event, symbol, session_id AS cme_session_id,
  'QEP_TECHNICAL' AS setup_type, CASE dir WHEN 1 THEN 'LONG' ELSE 'SHORT' END AS entry_side,
  close AS reference_level, entry AS entry_price, entry_ns // 1000 AS entry_timestamp,
  stop AS structural_invalidation, stop AS stop_price,
  CASE dir WHEN 1 THEN floor((entry + risk * 1.5::DOUBLE) * 4 + 0.5) / 4
    ELSE floor((entry - risk * 1.5::DOUBLE) * 4 + 0.5) / 4 END AS target_1,
  entry + dir * risk * 3 AS target_2,
  CASE dir WHEN 1 THEN floor((entry + risk * 4.5::DOUBLE) * 4 + 0.5) / 4
    ELSE floor((entry - risk * 4.5::DOUBLE) * 4 + 0.5) / 4 END AS target_3,
  12::BIGINT AS max_holding_bars, 21600::BIGINT AS max_holding_seconds,
  CASE dir WHEN 1 THEN 'QEP_RSI_ABOVE_50,QEP_MACD_BULLISH_POSITIVE'
    ELSE 'QEP_RSI_BELOW_50,QEP_MACD_BEARISH_NEGATIVE' END || ',QEP_ATR_STOP_2X' AS reason_codes,
  bar_start_ns // 1000 AS feature_timestamp, 'qep_technical_v1' AS setup_version,
  'QEP_TECHNICAL_NA' AS fvg_id, low AS fvg_low, high AS fvg_high,
  {_r('rng / (tr_sum / 14)')} AS effort_range_ratio, 0.0::DOUBLE AS effort_volume_ratio
FROM tech_priced"""
_CTE["altered"] = """
SELECT * REPLACE (
  CASE (entry_timestamp // 1800000000) % 4 WHEN 0 THEN 'FLAT' ELSE entry_side END AS entry_side,
  CASE (entry_timestamp // 1800000000) % 4 WHEN 1 THEN entry_price WHEN 2 THEN target_1
    ELSE stop_price END AS stop_price)
FROM tech"""


def _labels(cands: str, latency: int) -> dict[str, str]:
    """Label CTEs: windows, range join on all trades, exits."""
    return {
        f"win_{cands}_{latency}": f"""
SELECT *, entry_timestamp * 1000 + {latency}000000000 AS start_ns,
  entry_timestamp * 1000 + max_holding_seconds * 1000000000 AS end_ns,
  CASE WHEN entry_side NOT IN ('LONG', 'SHORT') THEN 'INVALID_ENTRY_SIDE'
    WHEN entry_price = stop_price THEN 'INVALID_RISK'
    WHEN NOT CASE entry_side WHEN 'LONG' THEN stop_price < entry_price AND entry_price < target_1
      ELSE target_1 < entry_price AND entry_price < stop_price END
    THEN 'INVALID_BARRIER_GEOMETRY' END AS verdict
FROM {cands}""",
        f"exit_{cands}_{latency}": f"""
SELECT c.symbol, c.setup_id, c.start_ns, count(*) AS n,
  min(t.source_row_number) FILTER (WHERE CASE c.entry_side
    WHEN 'LONG' THEN t.price <= c.stop_price OR t.price >= c.target_1
    ELSE t.price >= c.stop_price OR t.price <= c.target_1 END) AS hit_row,
  max(t.source_row_number) AS last_row
FROM win_{cands}_{latency} c JOIN tape t ON t.symbol = c.symbol AND t.session_id = c.cme_session_id
  AND t.ts_event_ns BETWEEN c.start_ns AND c.end_ns
WHERE c.verdict IS NULL GROUP BY 1, 2, 3""",
        f"lab_{cands}_{latency}": f"""
SELECT *, CASE entry_side WHEN 'LONG' THEN exit_fill - entry_fill ELSE entry_fill - exit_fill END AS gross
FROM (
  SELECT *, CASE WHEN exit_reason = 'TARGET_1' THEN target_1
      WHEN exit_reason = 'STOP' THEN CASE entry_side WHEN 'LONG' THEN least(stop_price, trade) - {{stop}}
        ELSE greatest(stop_price, trade) + {{stop}} END
      WHEN exit_reason = 'MAX_HOLD' THEN CASE entry_side WHEN 'LONG' THEN trade - {{time}}
        ELSE trade + {{time}} END END AS exit_fill,
    CASE WHEN verdict IS NULL THEN CASE entry_side WHEN 'LONG' THEN entry_price + {{entry}}
      ELSE entry_price - {{entry}} END END AS entry_fill
  FROM (
    SELECT c.*, coalesce(e.n, 0) AS n, t.price AS trade, t.ts_event_ns AS exit_ns,
      CASE WHEN c.verdict IS NOT NULL THEN c.verdict
        WHEN e.hit_row IS NOT NULL AND CASE c.entry_side WHEN 'LONG' THEN t.price <= c.stop_price
          ELSE t.price >= c.stop_price END THEN 'STOP'
        WHEN e.hit_row IS NOT NULL THEN 'TARGET_1'
        WHEN e.n > 0 THEN 'MAX_HOLD' ELSE 'NO_FUTURE_DATA' END AS exit_reason,
      CASE WHEN c.verdict IS NULL THEN abs(c.entry_price - c.stop_price) END AS risk
    FROM win_{cands}_{latency} c
    LEFT JOIN exit_{cands}_{latency} e USING (symbol, setup_id, start_ns)
    LEFT JOIN tape t ON t.source_row_number = coalesce(e.hit_row, e.last_row)))""",
    }


_FILL = {"stop": "0.25::DOUBLE", "time": "0.5::DOUBLE", "entry": "0.25::DOUBLE"}
_NONE = dict.fromkeys(_FILL, "0::DOUBLE")
for _c, _l, _f in (("tech", 1, _FILL), ("altered", 1, _FILL), ("tech", 21601, _NONE)):
    _CTE.update({k: v.format(**_f) if k.startswith("lab_") else v for k, v in _labels(_c, _l).items()})


def _label_cols(comm: str) -> dict[str, str]:
    avail = (
        "CASE WHEN verdict IS NOT NULL THEN start_ns WHEN exit_ns IS NULL THEN end_ns ELSE exit_ns END"
    )
    return {
        "setup_id": "setup_id",
        "ts_event": "ts_event",
        "symbol": "symbol",
        "cme_session_id": "cme_session_id",
        "setup_type": "setup_type",
        "entry_side": "entry_side",
        "entry_timestamp": "entry_timestamp",
        "earliest_entry_timestamp": "start_ns // 1000",
        "max_exit_timestamp": "end_ns // 1000",
        "entry_price": "entry_price",
        "entry_fill_price": "entry_fill",
        "stop_price": "stop_price",
        "target_price": "target_1",
        "exit_timestamp": "exit_ns // 1000",
        "exit_trade_price": "trade",
        "exit_fill_price": "exit_fill",
        "exit_reason": "exit_reason",
        "success": "exit_reason = 'TARGET_1'",
        "planned_risk_points": "risk",
        "gross_points": "gross",
        "gross_r": _r("gross / risk"),
        "net_points": _r(f"gross - {comm}"),
        "net_r": _r(f"(gross - {comm}) / risk"),
        "commission_per_side": f"{comm}::DOUBLE",
        "point_value": "2.0::DOUBLE",
        "entry_slippage_ticks": "1::BIGINT",
        "stop_slippage_ticks": "1::BIGINT",
        "time_exit_slippage_ticks": "2::BIGINT",
        "entry_latency_seconds": "1::BIGINT",
        "event_count": "n",
        "label_available_timestamp": f"({avail}) // 1000",
        "ambiguity_policy": "'event_order_first_barrier'",
        "reason_codes": "reason_codes",
    }


_CORE = (
    "setup_id",
    "symbol",
    "entry_timestamp",
    "exit_reason",
    "success",
    "entry_fill_price",
    "exit_timestamp",
    "exit_fill_price",
    "planned_risk_points",
    "net_r",
    "event_count",
    "label_available_timestamp",
)


def _label_select(table: str, names=None, comm: str = "0.62") -> str:
    cols = _label_cols(comm)
    return f"SELECT {', '.join(f'{cols[n]} AS {n}' for n in (names or cols))} FROM {table}"


_CTE["labels"] = (
    "SELECT exit_reason, entry_side, reason_codes, exit_reason = 'TARGET_1' AS success, "
    "(gross - 0.62) / risk AS net_r FROM lab_tech_1"
)
_CTE["summary"] = """
SELECT count(*) AS candidate_count, count(*) FILTER (WHERE success) AS success_count,
  round(count(*) FILTER (WHERE success) / count(*), 4) AS hit_rate,
  round(coalesce(sum(net_r), 0), 4) AS sum_net_r, round(avg(net_r), 4) AS avg_net_r,
  count(*) FILTER (WHERE exit_reason = 'MAX_HOLD') AS max_hold_count,
  count(*) FILTER (WHERE exit_reason = 'STOP') AS stop_count,
  round(count(*) / (SELECT count(*) FROM m30), 4) AS candidate_density
FROM labels"""

# Study.
_CTE["regimes"] = """
SELECT symbol, local_date, CASE WHEN ratio <= 0.75 THEN 'LOW' WHEN ratio >= 1.25 THEN 'HIGH'
    ELSE 'NORMAL' END AS regime, ratio
FROM (SELECT symbol, local_date, CASE WHEN base > 0 THEN prior / base END AS ratio FROM (
  SELECT *, lag(day_range) OVER w AS prior,
    quantile_cont(day_range, 0.5) OVER (PARTITION BY symbol ORDER BY local_date
      ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS base
  FROM day_ranges WINDOW w AS (PARTITION BY symbol ORDER BY local_date)))"""
_NY = _local("bar_start_ns", "America/New_York")
_CTE["study_bars"] = f"""
SELECT *, lead(bar_start_ns) OVER w AS next_ns, lead(open) OVER w AS next_open,
  row_number() OVER w - 1 AS bar_no, {_NY}::DATE::VARCHAR AS local_date,
  hour({_NY}) >= 3 AND hour({_NY}) < 16 AND NOT (hour({_NY}) = 9 AND minute({_NY}) = 30) AS open_hours,
  range * 20 / nullif(sum(range) OVER p, 0) AS rr, volume * 20 / sum(volume) OVER p AS vr,
  count(*) OVER p AS n
FROM c30 WINDOW w AS (PARTITION BY symbol ORDER BY bar_start_ns),
  p AS (PARTITION BY symbol ORDER BY bar_start_ns ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)"""


def _study(tag: str, regime: str, size: str) -> dict[str, str]:
    """Study CTEs for a regime join and a size formula over (risk, risk_pct)."""
    pick = "CASE regime WHEN 'LOW' THEN {} WHEN 'HIGH' THEN {} ELSE {} END"
    return {
        f"rated_{tag}": f"""
SELECT *, {pick.format(60, 120, 90)} AS win, {pick.format(1.10, 1.35, 1.20)}::DOUBLE AS rm,
  {pick.format(1.15, 1.50, 1.30)}::DOUBLE AS vm, {pick.format(0.0, 1.0, 0.0)}::DOUBLE AS buf,
  {pick.format(3.0, 4.5, 4.0)}::DOUBLE AS tp, {pick.format(8, 16, 12)} AS hold,
  {pick.format(0.020, 0.015, 0.025)}::DOUBLE AS risk_pct
FROM ({regime})""",
        f"pairs_{tag}": f"""
SELECT *, risk > 0 AND contracts > 0 AS tradable,
  row_number() OVER (PARTITION BY symbol, local_date ORDER BY bar_start_ns, available_ns DESC) AS step
FROM (SELECT *, {size} AS contracts FROM (
  SELECT *, CASE kind WHEN 'BULL' THEN stop - next_open ELSE next_open - stop END AS risk FROM (
    SELECT b.*, z.kind, z.zone_low, z.zone_high, z.zone_mid, z.formed_ns, z.available_ns,
      CASE z.kind WHEN 'BULL' THEN b.high + b.buf ELSE b.low - b.buf END AS stop
    FROM rated_{tag} b JOIN zones60 z ON z.symbol = b.symbol
      AND b.bar_start_ns - z.available_ns BETWEEN 0 AND b.win * 60000000000
    WHERE b.open_hours AND b.bar_no >= 20 AND b.next_ns = b.bar_start_ns + 1800000000000
      AND b.n = 20 AND b.range > 0 AND b.rr > b.rm AND b.vr > b.vm
      AND b.high >= z.zone_low AND b.low <= z.zone_high
      AND CASE z.kind WHEN 'BULL' THEN b.close < z.zone_high ELSE b.close > z.zone_low END)))""",
        f"walk_{tag}": f"""
SELECT symbol, local_date, 0::BIGINT AS step, []::BIGINT[] AS used, NULL::BIGINT AS settled, false AS took
FROM pairs_{tag} GROUP BY 1, 2
UNION ALL
SELECT p.symbol, p.local_date, p.step,
  CASE WHEN p.bar_start_ns IS NOT DISTINCT FROM w.settled OR list_contains(w.used, p.formed_ns)
      OR NOT p.tradable THEN w.used ELSE list_append(w.used, p.formed_ns) END,
  CASE WHEN p.bar_start_ns IS NOT DISTINCT FROM w.settled OR list_contains(w.used, p.formed_ns)
    THEN w.settled ELSE p.bar_start_ns END,
  NOT (p.bar_start_ns IS NOT DISTINCT FROM w.settled OR list_contains(w.used, p.formed_ns))
FROM walk_{tag} w JOIN pairs_{tag} p ON p.symbol = w.symbol AND p.local_date = w.local_date
  AND p.step = w.step + 1""",
        f"signals_{tag}": f"""
SELECT p.*, CASE kind WHEN 'BULL' THEN 'SHORT' ELSE 'LONG' END AS direction,
  CASE kind WHEN 'BULL' THEN -1 ELSE 1 END AS dir,
  next_open + CASE kind WHEN 'BULL' THEN -1 ELSE 1 END * risk * tp AS target
FROM pairs_{tag} p JOIN walk_{tag} w USING (symbol, local_date, step) WHERE w.took""",
        f"held_{tag}": f"""
SELECT s.symbol, s.bar_start_ns, max(b.bar_no) AS last_no,
  min(b.bar_no) FILTER (WHERE CASE s.dir WHEN 1 THEN b.low <= s.stop OR b.high >= s.target
    ELSE b.high >= s.stop OR b.low <= s.target END) AS hit_no
FROM signals_{tag} s JOIN study_bars b ON b.symbol = s.symbol
  AND b.bar_no BETWEEN s.bar_no + 1 AND s.bar_no + s.hold
WHERE s.tradable GROUP BY 1, 2""",
        f"out_{tag}": f"""
SELECT *, dir * (exit_price - next_open) AS points,
  contracts * (dir * (exit_price - next_open) * 5 - 5) AS pnl,
  strftime({_local('next_ns', 'America/New_York')}, '%Y-%m') AS month,
  {_local('next_ns', 'America/New_York')}::DATE AS entry_date
FROM (SELECT *, CASE status WHEN 'STOP_LOSS' THEN stop WHEN 'TAKE_PROFIT' THEN target
    ELSE x_close END AS exit_price FROM (
  SELECT s.*, x.bar_start_ns AS exit_ns, x.close AS x_close,
    CASE WHEN h.hit_no IS NULL THEN 'TIME_OUT'
      WHEN CASE s.dir WHEN 1 THEN x.low <= s.stop ELSE x.high >= s.stop END THEN 'STOP_LOSS'
      ELSE 'TAKE_PROFIT' END AS status
  FROM signals_{tag} s JOIN held_{tag} h USING (symbol, bar_start_ns)
  JOIN study_bars x ON x.symbol = s.symbol AND x.bar_no = coalesce(h.hit_no, h.last_no)))""",
        f"curve_{tag}": f"""
SELECT *, peak - balance AS drawdown, greatest(0, (day_start - balance) / day_start) AS daily_loss
FROM (SELECT *, greatest(10000, max(balance) OVER (PARTITION BY symbol, month ORDER BY next_ns)) AS peak,
    first_value(balance - pnl) OVER (PARTITION BY symbol, month, entry_date ORDER BY next_ns) AS day_start
  FROM (SELECT *, 10000 + sum(pnl) OVER (PARTITION BY symbol, month ORDER BY next_ns) AS balance
    FROM out_{tag}))""",
        f"report_{tag}": f"""
SELECT m.symbol, m.month, m.skipped_missing_entry, coalesce(r.bad_risk, 0) AS skipped_invalid_risk,
  coalesce(r.no_size, 0) AS skipped_no_contracts, coalesce(c.trades, 0) AS trades,
  coalesce(c.wins, 0) AS wins, coalesce(c.trades - c.wins, 0) AS losses,
  coalesce(round(c.wins / c.trades * 100, 2), 0) AS win_rate, coalesce(round(c.net, 2), 0) AS net_pnl,
  coalesce(round(c.net / 10000 * 100, 2), 0) AS return_pct,
  coalesce(round(c.dd / c.peak * 100, 2), 0) AS max_drawdown_pct,
  coalesce(round(c.daily * 100, 2), 0) AS max_daily_dd_pct,
  coalesce(c.low_n, 0) AS low_vol_trades, coalesce(c.normal_n, 0) AS normal_vol_trades,
  coalesce(c.high_n, 0) AS high_vol_trades
FROM (SELECT symbol, strftime({_NY}, '%Y-%m') AS month,
    count(*) FILTER (WHERE open_hours AND bar_no >= 20 AND next_ns IS NOT NULL
      AND next_ns <> bar_start_ns + 1800000000000) AS skipped_missing_entry
  FROM study_bars GROUP BY 1, 2) m
LEFT JOIN (SELECT symbol, strftime({_local('next_ns', 'America/New_York')}, '%Y-%m') AS month,
    count(*) FILTER (WHERE NOT tradable AND NOT risk > 0) AS bad_risk,
    count(*) FILTER (WHERE NOT tradable AND risk > 0) AS no_size
  FROM signals_{tag} GROUP BY 1, 2) r USING (symbol, month)
LEFT JOIN (SELECT symbol, month, count(*) AS trades, count(*) FILTER (WHERE pnl > 0) AS wins,
    sum(pnl) AS net, max(drawdown) AS dd, max(peak) AS peak, max(daily_loss) AS daily,
    count(*) FILTER (WHERE regime = 'LOW') AS low_n,
    count(*) FILTER (WHERE regime = 'NORMAL') AS normal_n,
    count(*) FILTER (WHERE regime = 'HIGH') AS high_n
  FROM curve_{tag} GROUP BY 1, 2) c USING (symbol, month)""",
    }


_SIZE = (
    "CASE WHEN risk > 0 THEN least(floor(least(10000 * risk_pct, 0.018::DOUBLE * 10000 * 0.8::DOUBLE)"
    " / (risk * 5 + 5)), 100)::BIGINT ELSE 0 END"
)
_CTE.update(
    _study(
        "eq",
        "SELECT b.*, coalesce(r.regime, 'NORMAL') AS regime FROM study_bars b "
        "LEFT JOIN regimes r USING (symbol, local_date)",
        _SIZE,
    )
)
_CTE.update(_study("one", "SELECT *, 'NORMAL' AS regime FROM study_bars", "1::BIGINT"))

_RECURSIVE = {"walk", "gap_walk", "walk_eq", "walk_one"}


def _needs(sql: str) -> list[str]:
    words = set(re.findall(r"\b\w+\b", sql))
    return [n for n in _CTE if n in words]


def _sql(final: str) -> str:
    """``final`` behind the expressions it needs, each after those it needs itself."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in order:
            return
        for dep in _needs(_CTE[name]):
            if dep != name:
                add(dep)
        order.append(name)

    for name in _needs(final):
        add(name)
    ctes = ",\n".join(f"{n} AS ({_CTE[n]})" for n in order)
    return f"WITH RECURSIVE {ctes}\n{final}" if order else final


_COUNT_BY_REASON = (
    "SELECT reason, count(*) AS rows FROM (SELECT unnest(reasons) AS reason FROM flags) GROUP BY reason"
)
_NULLABLE = (
    "ts_recv",
    "ts_event",
    "publisher_id",
    "instrument_id",
    "action",
    "side",
    "price",
    "size",
    "sequence",
    "symbol",
)
_SHAPED = """
SELECT event_id, epoch_us(ts) AS us FROM events"""


def _far(year: int) -> str:
    """Epoch ns of the same day and time in another year; null where it has no such day."""
    text = f"'{year}' || strftime(make_timestamp(us), '-%m-%d %H:%M:%S.%f')"
    return f"epoch_us(try_cast({text} AS TIMESTAMP)) * 1000"


_BAR_COLS = "symbol, session_id, bar_start_ns, open, high, low, close, volume"
_CANDLE_COLS = "symbol, bar_start_ns, open, high, low, close, volume, trades, range"
_ROUGH = """
SELECT event_id AS pos, CASE WHEN event_id % 41 <> 7 THEN
    (epoch_us(ts) // 60000000) * 60000000000
    - CASE WHEN event_id % 37 = 5 THEN 60000000000 ELSE 0 END END AS ts,
  event_id % 3 AS seq FROM events"""


def _ordering(rows: str) -> str:
    return f"""
SELECT coalesce(sum((ts < pts OR (ts = pts AND seq < pseq))::INT), 0)::BIGINT AS ordering_anomalies,
  coalesce(sum((ts = pts AND seq = pseq)::INT), 0)::BIGINT AS duplicate_candidates
FROM (SELECT *, lag(ts) OVER (ORDER BY pos) AS pts, lag(seq) OVER (ORDER BY pos) AS pseq
  FROM ({rows}) WHERE ts IS NOT NULL AND seq IS NOT NULL)"""


_COVER = (
    "SELECT session_id, count(*) AS rows, min(ts_event_ns) AS min_ts_ns, max(ts_event_ns) AS max_ts_ns "
    "FROM dirty_tape GROUP BY session_id"
)


def _bound(day: str, clock: str) -> str:
    local = f"({day}::TIMESTAMP + INTERVAL '{clock}' HOUR)"
    return f"epoch_us(({local} AT TIME ZONE 'America/Chicago') AT TIME ZONE 'UTC') * 1000"


_OPEN, _CLOSE = _bound("(d - 1)", "17"), _bound("d", "16")
_SHIFT = "(make_timestamp(us + (event_id % 366) * 86400000000))"
_SHIFT_LOCAL = f"(({_SHIFT} AT TIME ZONE 'UTC') AT TIME ZONE 'America/Chicago')"
_SHIFT_DAY = (
    f"(CASE WHEN {_SHIFT_LOCAL}::TIME >= TIME '17:00:00' THEN {_SHIFT_LOCAL}::DATE + 1 "
    f"ELSE {_SHIFT_LOCAL}::DATE END)::VARCHAR"
)
_SHIFT_RTH = f"({_SHIFT_LOCAL}::TIME >= TIME '08:30:00' AND {_SHIFT_LOCAL}::TIME < TIME '15:00:00')"
_HALF = "((make_timestamp((us // 1800000000) * 1800000000) AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')"

_CANDIDATE_COLS = """setup_id, ts_event, symbol, cme_session_id, setup_type, entry_side,
  reference_level, entry_price, entry_timestamp, structural_invalidation, stop_price, target_1,
  target_2, target_3, max_holding_bars, max_holding_seconds, reason_codes, feature_timestamp,
  setup_version, fvg_id, fvg_low, fvg_high, effort_range_ratio, effort_volume_ratio"""

_FINAL: dict[str, str] = {
    "trade_tape": "SELECT * FROM tape",
    "trade_tape_scoped": (
        "SELECT symbol, ts_event_ns, sequence, price, size, signed_volume, source_row_number "
        "FROM dirty_tape WHERE symbol IN ('S0', 'S2')"
    ),
    "tape_totals_report": (
        "SELECT count(*) AS row_count, sum(size)::BIGINT AS sum_size, "
        "sum(signed_volume)::BIGINT AS sum_signed_volume FROM tape"
    ),
    "tape_reconcile": (
        "SELECT count(*) AS row_count, sum(size)::BIGINT AS sum_size, "
        "sum(signed_volume)::BIGINT AS sum_signed_volume, '' AS failures, true AS valid FROM dirty_tape"
    ),
    "tape_roundtrip": "SELECT * FROM tape",
    "quality_flags": (
        "SELECT source_row_number, scope AS trade_scope, valid AS valid_trade, "
        "array_to_string(list_sort(reasons), ',') AS reasons FROM flags"
    ),
    "reason_counts": _COUNT_BY_REASON,
    "reason_counts_from_cells": _COUNT_BY_REASON,
    "ns_to_iso": (
        f"SELECT event_id, {_iso('ns')} AS iso, {_offset_iso('ns')} AS offset_iso FROM "
        "(SELECT event_id, epoch_us(ts) * 1000 + event_id % 1000 AS ns FROM events)"
    ),
    "timestamp_parse": (
        "SELECT event_id, ns, ns IS NULL AS invalid FROM (SELECT event_id, CASE event_id % 10 "
        "WHEN 0 THEN us * 1000 WHEN 1 THEN (us // 1000000) * 1000000000 "
        "WHEN 2 THEN (us // 1000) * 1000000 "
        f"WHEN 8 THEN {_far(1700)} WHEN 9 THEN {_far(2200)} "
        f"END AS ns FROM ({_SHAPED}))"
    ),
    "action_side_report": (
        "SELECT 'action_side' AS grouping, coalesce(action, '<NULL>') AS action, "
        "coalesce(side, '<NULL>') AS side, count(*) AS rows FROM dirty GROUP BY action, side "
        "UNION ALL SELECT 'action', coalesce(action, '<NULL>'), NULL, count(*) FROM dirty GROUP BY action "
        "UNION ALL SELECT 'side', NULL, coalesce(side, '<NULL>'), count(*) FROM dirty GROUP BY side"
    ),
    "null_counts": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM dirty"
        for c in _NULLABLE
    ),
    "rows_per_symbol": "SELECT symbol, count(*) AS rows FROM dirty GROUP BY symbol",
    "volume_report": """
SELECT count(*) AS total_rows, count(*) FILTER (WHERE action = 'T') AS total_t_rows,
  count(*) FILTER (WHERE action = 'F') AS total_f_rows, count(*) FILTER (WHERE valid) AS valid_t_rows,
  count(*) FILTER (WHERE valid AND side = 'N') AS unknown_side_t_rows,
  sum(size) FILTER (WHERE valid)::BIGINT AS sum_t_size,
  sum(CASE side WHEN 'B' THEN size WHEN 'A' THEN -size ELSE 0 END) FILTER (WHERE valid)::BIGINT
    AS sum_signed_volume,
  min(price) FILTER (WHERE valid) AS min_price, max(price) FILTER (WHERE valid) AS max_price,
  min(size) FILTER (WHERE valid) AS min_size, max(size) FILTER (WHERE valid) AS max_size,
  count(*) FILTER (WHERE list_contains(reasons, 'invalid_tick_price')) AS invalid_tick_prices,
  min(ts_event) AS min_ts_event_ns, max(ts_event) AS max_ts_event_ns FROM flags""",
    "timestamp_report": (
        f"SELECT {_iso('min(ts_event)')} AS min_ts_event, {_iso('max(ts_event)')} AS max_ts_event, "
        "count(*) FILTER (WHERE ts_event IS NULL) AS invalid_ts_event, "
        "count(*) FILTER (WHERE ts_recv IS NULL) AS invalid_ts_recv FROM dirty"
    ),
    "session_coverage": _COVER,
    "partial_sessions": f"""
SELECT session_id, rows, {_iso('min_ts_ns')} AS observed_min, {_iso('max_ts_ns')} AS observed_max,
  {_iso('open_ns')} AS expected_open, {_iso('close_ns')} AS expected_close, true AS potentially_partial
FROM (SELECT *, {_OPEN} AS open_ns, {_CLOSE} AS close_ns
  FROM (SELECT *, substr(session_id, 12, 10)::DATE AS d, min(session_id) OVER () AS first_id,
    max(session_id) OVER () AS last_id FROM ({_COVER})))
WHERE session_id IN (first_id, last_id)
  AND (min_ts_ns > open_ns + 300000000000 OR max_ts_ns < close_ns - 300000000000)""",
    "ordering_report_scrambled": _ordering(
        "SELECT source_row_number // 1000003 * 1000003 + source_row_number * 7919 % 1000003 AS pos, "
        "ts_event AS ts, sequence AS seq FROM dirty"
    ),
    "ordering_report_scan": _ordering(_ROUGH),
    "session_bounds": f"""
SELECT DISTINCT d::VARCHAR AS trading_date, {_OPEN} AS open_ns, {_CLOSE} AS close_ns
FROM (SELECT (trading_date::DATE + k::INT)::DATE AS d
  FROM (SELECT DISTINCT trading_date FROM tape), range(0, 361, 30) r(k))""",
    "sessions_over_dst": f"""
SELECT event_id, {_SHIFT_DAY} AS trading_date, 'CME_EQ_FUT_' || {_SHIFT_DAY} AS session_id,
  CASE WHEN {_SHIFT_RTH} THEN 'RTH' ELSE 'OVERNIGHT' END AS session_segment, {_SHIFT_RTH} AS is_rth
FROM ({_SHAPED})""",
    "market_hours": f"""
SELECT event_id, hour({_HALF}) >= 3 AND hour({_HALF}) < 16
  AND NOT (hour({_HALF}) = 9 AND minute({_HALF}) = 30) AS in_market_hours FROM ({_SHAPED})""",
    "tick_rounding": (
        "SELECT event_id, round(v * 4) / 4.0::DOUBLE AS nearest, ceil(v * 4) / 4.0::DOUBLE AS up, "
        "floor(v * 4) / 4.0::DOUBLE AS down, value > 0 AND abs(value * 4 - round_even(value * 4, 0)) <= 1e-9 "
        "AS on_tick FROM (SELECT *, value::DECIMAL(18,4) AS v FROM events)"
    ),
    "stable_ids": (
        "SELECT source_row_number, 'setup_' || left(h, 16) AS short_id, h AS full_id FROM "
        f"(SELECT *, sha256(symbol || '|' || {_offset_iso('ts_event_ns')} || '|' || price::VARCHAR) AS h FROM tape)"
    ),
    "month_labels": (
        "SELECT event_id, strftime(ts, '%Y-%m') || CASE event_id % 3 WHEN 2 "
        "THEN 'x_' || (user_id % 4)::VARCHAR ELSE '' END AS month FROM events"
    ),
    "contracts": """
SELECT event_id, CASE WHEN risk > 0 AND room > 0 AND cash > 0
    THEN least(floor(cash / (risk * 5 + 2.5 + 2.5)), floor(equity / 100)) ELSE 0 END::BIGINT AS contracts
FROM (SELECT *, least(equity * 0.025::DOUBLE, room * 10000 * 0.8::DOUBLE) AS cash
  FROM (SELECT event_id, (4000 + event_id % 50 * 200)::DOUBLE AS equity, value / 8 - 1 AS risk,
      0.018::DOUBLE - (event_id % 20) / 1000.0::DOUBLE AS room FROM events))""",
    "bars_m30": f"SELECT {_BAR_COLS} FROM m30",
    "bars_ties": """
SELECT symbol, session_id, ts // 1800000000000 * 1800000000000 AS bar_start_ns,
  first(price ORDER BY ts, seq, pos) AS open, max(price) AS high, min(price) AS low,
  last(price ORDER BY ts, seq, pos) AS close, sum(size)::BIGINT AS volume
FROM (SELECT *, ts_event_ns // 600000000000 * 600000000000 AS ts, source_row_number % 5 AS seq,
  source_row_number * 7919 % 1000003 AS pos FROM tape)
GROUP BY symbol, session_id, ts // 1800000000000""",
    "bars_m30_wide_keys": f"SELECT {_BAR_COLS} FROM m30",
    "bars_h1": f"SELECT {_BAR_COLS} FROM h1",
    "candles_15m": f"SELECT {_CANDLE_COLS} FROM c15",
    "bars_market_tz": f"SELECT {_CANDLE_COLS} FROM ist",
    "daily_ranges": "SELECT * FROM day_ranges",
    "gap_zones": (
        "SELECT symbol, session_id, formed_ns, available_ns, kind, zone_low, zone_high, "
        f"{_r('zone_mid')} AS zone_mid, zone_id FROM zones"
    ),
    "gap_zones_any": (
        "SELECT symbol, formed_ns, available_ns, kind, zone_low, zone_high, "
        f"{_r('zone_mid')} AS zone_mid FROM zones15"
    ),
    "latest_gaps": (
        "SELECT symbol, session_id, formed_ns, available_ns, kind, zone_low, zone_high, "
        f"{_r('zone_mid')} AS zone_mid, zone_id FROM zones ORDER BY formed_ns DESC, symbol DESC LIMIT 300"
    ),
    "gap_fill_status": """
SELECT z.symbol, z.kind || '_FVG' AS kind, z.formed_ns AS start_ns,
  coalesce(f.fill_ns, l.last_ns) + 1800000000000 AS end_ns, z.zone_low, z.zone_high,
  CASE WHEN f.fill_ns IS NULL THEN 'OPEN' ELSE 'FULLY_FILLED' END AS status
FROM zones30 z JOIN (SELECT symbol, max(bar_start_ns) AS last_ns FROM c30 GROUP BY 1) l USING (symbol)
LEFT JOIN (SELECT z.symbol, z.formed_ns, min(b.bar_start_ns) AS fill_ns
  FROM zones30 z JOIN c30 b ON b.symbol = z.symbol AND b.bar_start_ns > z.formed_ns
    AND CASE z.kind WHEN 'BULL' THEN b.low <= z.zone_low ELSE b.high >= z.zone_high END
  GROUP BY 1, 2) f USING (symbol, formed_ns)""",
    "effort_ratios": f"""
SELECT symbol, bar_start_ns, CASE WHEN ok THEN {_r('rng * 3 / rs')} END AS effort_range_ratio,
  CASE WHEN ok THEN {_r('volume * 5 / vs')} END AS effort_volume_ratio
FROM (SELECT *, count(*) OVER w5 = 5 AND rng > 0 AND min(rng) OVER w3 > 0 AND min(volume) OVER w5 > 0 AS ok,
    sum(rng) OVER w3 AS rs, sum(volume) OVER w5 AS vs
  FROM nb WINDOW w3 AS (PARTITION BY symbol ORDER BY bar_start_ns ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
    w5 AS (PARTITION BY symbol ORDER BY bar_start_ns ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING))""",
    "trailing_baselines": f"""
SELECT symbol, bar_start_ns, CASE WHEN count(*) OVER w = 20 THEN {_r('avg(range) OVER w')} END AS baseline_range,
  CASE WHEN count(*) OVER w = 20 THEN {_r('avg(volume) OVER w')} END AS baseline_volume
FROM c30 WINDOW w AS (PARTITION BY symbol ORDER BY bar_start_ns ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)""",
    "rsi": f"SELECT symbol, bar_start_ns, {_r('rsi')} AS rsi FROM ind",
    "ema": (
        f"SELECT symbol, bar_start_ns, {_r('f')} AS ema_12, {_r('e200')} AS ema_200 "
        "FROM walk JOIN nb USING (symbol, bar_no)"
    ),
    "macd": f"SELECT symbol, bar_start_ns, {_r('line')} AS macd, {_r('trig')} AS macd_signal FROM ind",
    "atr": f"""
SELECT symbol, bar_start_ns, tr AS true_range, {_r('tr_sum / 14')} AS atr FROM (
  SELECT i.*, greatest(rng, abs(high - prev_close), abs(low - prev_close)) AS tr FROM ind i)""",
    "entry_bars": "SELECT symbol, bar_start_ns, entry_ns, entry_open, is_last FROM nb2",
    "failed_gap_candidates": f"SELECT {_CANDIDATE_COLS} FROM gap_cand",
    "indicator_candidates": f"SELECT {_CANDIDATE_COLS} FROM tech",
    "candidate_roundtrip": (
        "SELECT setup_id, symbol, setup_type, entry_timestamp, entry_price FROM gap_cand "
        "UNION ALL SELECT setup_id, symbol, setup_type, entry_timestamp, entry_price FROM tech"
    ),
    "first_barrier_labels": _label_select("lab_tech_1"),
    "label_invalids": _label_select("lab_altered_1", _CORE),
    "label_no_future": _label_select("lab_tech_21601", _CORE, "0"),
    "label_gate_report": (
        "SELECT exit_reason, count(*) AS labels, count(*) FILTER (WHERE success) AS successes, "
        "'NO-GO' AS gate_recommendation FROM labels GROUP BY exit_reason"
    ),
    "label_summary": "SELECT * FROM summary",
    "label_counts": """
SELECT 'exit_reason' AS kind, exit_reason AS value, count(*) AS labels FROM labels GROUP BY 2
UNION ALL SELECT 'entry_side', entry_side, count(*) FROM labels GROUP BY 2
UNION ALL SELECT 'reason_code', code, count(*)
FROM (SELECT unnest(string_split(reason_codes, ',')) AS code FROM labels) GROUP BY 2""",
    "net_r_buckets": """
SELECT 'exit_reason' AS kind, exit_reason AS value, count(*) AS labels,
  round(sum(net_r), 4) AS sum_net_r, round(avg(net_r), 4) AS avg_net_r
FROM labels WHERE net_r IS NOT NULL GROUP BY 2
UNION ALL SELECT 'entry_side', entry_side, count(*), round(sum(net_r), 4), round(avg(net_r), 4)
FROM labels WHERE net_r IS NOT NULL GROUP BY 2""",
    "label_diagnosis": """
SELECT candidate_count, coalesce(nullif(array_to_string([x FOR x IN [
  CASE WHEN avg_net_r < 0 THEN 'negative expectancy after costs: average net R is below zero' END,
  CASE WHEN hit_rate <= 0.2 THEN 'target conversion is weak: few candidates reach TARGET_1' END,
  CASE WHEN max_hold_count / candidate_count >= 0.5
    THEN 'MAX_HOLD dominates exits: signals often fail to resolve before timeout' END,
  CASE WHEN stop_count / candidate_count >= 0.3
    THEN 'STOP exits are frequent: adverse movement is common after entry' END,
  CASE WHEN candidate_density >= 0.25
    THEN 'candidate density is high: raw QEP is overtrading the M30 stream' END] IF x IS NOT NULL], '; '), ''),
  'no single dominant failure mode detected; inspect trade-level rows') AS diagnosis FROM summary""",
    "volatility_regimes": f"SELECT symbol, local_date, regime, {_r('ratio')} AS volatility_ratio FROM regimes",
    "regime_signals": f"""
SELECT symbol, bar_start_ns AS signal_ns, formed_ns, direction, regime, next_open AS entry_open, stop,
  risk AS risk_points, contracts, tradable, {_r('rr')} AS effort_range_ratio,
  {_r('vr')} AS effort_volume_ratio, {_r('close - zone_mid')} AS close_vs_mid,
  close - CASE kind WHEN 'BULL' THEN zone_high ELSE zone_low END AS close_vs_zone FROM signals_eq""",
    "bar_study": f"""
SELECT symbol, month, bar_start_ns AS signal_ns, next_ns AS entry_ns, exit_ns, direction, contracts,
  next_open AS entry_open, stop, {_r('target')} AS target, {_r('exit_price')} AS exit_price, status,
  {_r('points')} AS points, {_r('pnl')} AS pnl, regime FROM out_eq""",
    "equity_curve": f"""
SELECT symbol, month, next_ns AS entry_ns, {_r('pnl')} AS pnl, {_r('balance')} AS balance,
  {_r('peak')} AS peak, {_r('drawdown')} AS drawdown, {_r('daily_loss')} AS daily_loss FROM curve_eq""",
    "trade_summary": "SELECT * FROM report_eq",
    "fixed_size_summary": "SELECT * FROM report_one",
    "scan_row_numbers": "SELECT event_id AS source_row_number, event_id FROM events",
}

_QUARANTINE = (
    "SELECT array_to_string(list_sort(reasons), ',') AS rejection_reason, source_row_number, "
    f"{_iso('ts_event')} AS ts_event, {_iso('ts_recv')} AS ts_recv, sequence, publisher_id, "
    "instrument_id, symbol, action, side, round(price, 6) AS price, size FROM flags WHERE scope AND NOT valid"
)
_FINAL["quarantine_rows"] = _QUARANTINE
_FINAL["quarantine_roundtrip"] = _QUARANTINE
_FINAL["schema_report"] = """
SELECT position::INTEGER AS position, c.column_name, column_type, c.column_name IN (SELECT n FROM wanted) AS required,
  column_type IS NOT NULL AS present, false AS duplicated, false AS input_valid, nulls
FROM (
  SELECT row_number() OVER () - 1 AS position, column_name,
    CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS column_type
  FROM (DESCRIBE SELECT * FROM events)
  UNION ALL
  SELECT (SELECT count(*) FROM (DESCRIBE SELECT * FROM events)) + k, n, NULL FROM wanted
  WHERE n NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM events))
) c LEFT JOIN (
  UNPIVOT (SELECT count(*) - count(COLUMNS(*)) FROM events) ON COLUMNS(*) INTO NAME column_name VALUE nulls
) USING (column_name)
""".replace("wanted", "(SELECT unnest(%s) AS n, unnest(range(%d)) AS k)" % (list(S.MBO_REQUIRED), len(S.MBO_REQUIRED)))
_FINAL["csv_roundtrip"] = _FINAL["bar_study"]
_FINAL["normalize_trades"] = (
    "SELECT symbol, ts_event AS ts_event_ns, round(price, 6) AS price, size, sequence, source_row_number "
    "FROM dirty WHERE action = 'T' AND ts_event IS NOT NULL AND price > 0 AND size > 0"
)
_FINAL["chart_trades"] = (
    "SELECT symbol, ts_event AS ts_event_ns, round(price, 6) AS price, "
    "CASE WHEN event_id % 23 = 4 THEN 0 ELSE size END::DOUBLE AS size, source_row_number "
    "FROM dirty WHERE symbol = 'S1' AND ts_event IS NOT NULL AND event_id % 19 <> 3"
)

_FINAL["scan_many_files"] = (
    "SELECT ts_recv, ts_event, publisher_id, instrument_id, action, side, round(price, 6) AS price, size, sequence, "
    "symbol, row_number() OVER (ORDER BY mbo.source_row_number) - 1 AS source_row_number FROM mbo"
)
_FINAL["stream_trade_tape"] = "SELECT * EXCLUDE (source_row_number) FROM tape"
_FINAL["stream_volume_report"] = _FINAL["volume_report"]
_FINAL["tape_day_replaced"] = "SELECT * FROM tape"
_CTE["spoiled"] = """
SELECT * REPLACE (
  CASE WHEN event_id % 127 = 7 THEN -price WHEN event_id % 149 = 11 THEN NULL WHEN event_id % 131 <> 8 THEN price END AS price,
  CASE WHEN event_id % 137 = 9 THEN '' WHEN event_id % 151 <> 12 THEN symbol END AS symbol,
  CASE WHEN event_id % 139 <> 10 THEN ts_recv END AS ts_recv)
FROM dirty"""
_FINAL["all_invalid_reasons"] = """
SELECT reason, count(*) AS rows FROM (
  SELECT unnest([
    CASE WHEN NOT coalesce(action IN ('A','C','M','R','T','F'), false) THEN 'invalid_action' END,
    CASE WHEN NOT coalesce(side IN ('A','B','N'), false) THEN 'invalid_side' END,
    CASE WHEN ts_event IS NULL THEN 'invalid_ts_event' END,
    CASE WHEN ts_recv IS NULL THEN 'invalid_ts_recv' END,
    CASE WHEN sequence IS NULL THEN 'invalid_sequence' END,
    CASE WHEN coalesce(action = 'T', false) AND NOT coalesce(price > 0, false) THEN 'invalid_price' END,
    CASE WHEN coalesce(action = 'T', false) AND NOT coalesce(size > 0, false) THEN 'invalid_size' END,
    CASE WHEN coalesce(action = 'T', false) AND coalesce(symbol, '') = '' THEN 'invalid_symbol' END,
    CASE WHEN coalesce(action = 'T', false) AND NOT coalesce(price > 0 AND abs(price * 4 - round_even(price * 4, 0)) <= 1e-9, false)
      THEN 'invalid_tick_price' END]) AS reason
  FROM spoiled) WHERE reason IS NOT NULL GROUP BY reason"""
_FINAL["row_policies"] = """
SELECT 'fail' AS policy, 0::BIGINT AS row_count, count(*) > 0 AS raised FROM flags WHERE len(reasons) > 0
UNION ALL SELECT policy, count(*), false FROM dirty_tape, (VALUES ('quarantine'), ('warn')) p(policy) GROUP BY policy"""
_FINAL["null_guards"] = """
SELECT column_name, count(*) AS nulls, true AS raised FROM tape, (VALUES ('price'), ('size'), ('session_id'), ('sequence')) c(column_name)
WHERE sequence % 4004 = 0 GROUP BY column_name"""
_FINAL["tape_reconcile_failing"] = """
SELECT count(*) FILTER (symbol <> 'S3') AS row_count, sum(size) FILTER (symbol <> 'S3')::BIGINT AS sum_size,
  sum(signed_volume) FILTER (symbol <> 'S3')::BIGINT AS sum_signed_volume,
  array_to_string([x FOR x IN [
    CASE WHEN count(*) FILTER (symbol = 'S3') > 0 THEN 'output row count does not match manifest' END,
    CASE WHEN coalesce(sum(size) FILTER (symbol = 'S3'), 0) <> 0 THEN 'output size sum does not match manifest' END,
    CASE WHEN coalesce(sum(signed_volume) FILTER (symbol = 'S3'), 0) <> 0 THEN 'signed-volume sum does not match manifest' END]
    IF x IS NOT NULL], ',') AS failures,
  count(*) FILTER (symbol = 'S3') = 0 AS valid
FROM dirty_tape"""

# Each file is a part of the symbol, as all expressions are keyed by it, and its month is its name.
_FILE = "CASE WHEN (epoch_us(ts) // 864000000000) % 2 = 1 THEN '2024-02' ELSE '2024-01' END"


def _by_file(final: str) -> str:
    sql = _sql(
        f"SELECT split_part(symbol, '|', 2) AS symbol, split_part(symbol, '|', 1) AS month, * EXCLUDE (symbol, month) FROM ({final})"
    )
    own = "'S' || (user_id % 4)::VARCHAR AS symbol"
    assert sql.count(own) == 1
    return sql.replace(own, f"{_FILE} || '|' || {own}")


def oracle_sql() -> dict[str, str]:
    return {name: _sql(final) for name, final in _FINAL.items()} | {
        "bar_study_by_file": _by_file(_FINAL["bar_study"])
    }
