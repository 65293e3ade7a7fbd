"""DuckDB SQL for the queries of ``plans/queries.py``, written independently of them."""

from __future__ import annotations

from statistics import NormalDist

EPOCH = "TIMESTAMP '1970-01-01'"


def _z(confidence: float) -> float:
    return NormalDist().inv_cdf(0.5 + confidence / 200.0)


def half_up(x: str, digits: int) -> str:
    """Half up, after floating-point noise is cut at the ninth digit."""
    return f"CAST(round(CAST({x} AS DECIMAL(28,9)), {digits}) AS DOUBLE)"


def r6(x: str) -> str:
    return half_up(x, 6)


def _bucket(column: str, width: str) -> str:
    return f"time_bucket(INTERVAL '{width}', {column}, {EPOCH})"


def _window_time(start: str, width: str) -> str:
    return f"{start} + INTERVAL '{width}' - INTERVAL '1 millisecond'"


# --- common table expressions ---------------------------------------------------------

EVENT_SERIES = f"""
series AS (
  SELECT user_id, event_type AS signal, {_bucket('ts', '1 day')} AS w,
         avg(value) AS observed_value
  FROM events GROUP BY ALL
)"""

GLOBAL_SERIES = f"""
series AS (
  SELECT event_type AS signal, {_bucket('ts', '1 minute')} AS w, avg(value) AS observed_value
  FROM events GROUP BY ALL
)"""

LINE_WIDE = f"""
wide AS (
  SELECT l_suppkey, {_bucket('l_shipdate', '1 day')} AS w, avg(l_quantity) AS l_quantity,
         avg(l_extendedprice) AS l_extendedprice, avg(l_discount) AS l_discount,
         avg(l_tax) AS l_tax
  FROM lineitem GROUP BY ALL
)"""

LINE_SERIES = (
    LINE_WIDE
    + """,
series AS (
  SELECT l_suppkey, w, 'l_quantity' AS signal, l_quantity AS observed_value FROM wide
  UNION ALL SELECT l_suppkey, w, 'l_extendedprice', l_extendedprice FROM wide
  UNION ALL SELECT l_suppkey, w, 'l_discount', l_discount FROM wide
  UNION ALL SELECT l_suppkey, w, 'l_tax', l_tax FROM wide
)"""
)


def _bands(
    keys: str,
    model: str = "mean",
    least: int = 5,
    most: int | None = None,
    confidence: float = 99.9,
    extra: str = "",
) -> str:
    """CTE ``band``: the rows of ``series`` with forecast, bounds, flag and training size."""
    start = "UNBOUNDED" if most is None else str(most)
    frame = f"(PARTITION BY {keys} ORDER BY w ROWS BETWEEN {start} PRECEDING AND 1 PRECEDING)"
    z = _z(confidence)
    if model == "mean":
        return f"""
stats AS (
  SELECT *, count(observed_value) OVER f AS n, avg(observed_value) OVER f AS fc,
         stddev_samp(observed_value) OVER f AS sd
  FROM series WINDOW f AS {frame}
),
{_flags(least, z)}"""
    x = (
        "(epoch_us(w + INTERVAL '1 day') - epoch_us(TIMESTAMP '2024-01-01') - 1) / 3.6e9"
        if model == "trend"
        else f"lag(observed_value) OVER (PARTITION BY {keys} ORDER BY w)"
    )
    x = x.replace("1 day", extra or "1 day")
    return f"""
pairs AS (SELECT *, {x} AS x FROM series),
fits AS (
  SELECT *, regr_count(observed_value, x) OVER f AS n,
         regr_slope(observed_value, x) OVER f AS b,
         regr_intercept(observed_value, x) OVER f AS a,
         regr_syy(observed_value, x) OVER f AS syy,
         regr_sxy(observed_value, x) OVER f AS sxy
  FROM pairs WINDOW f AS {frame}
),
stats AS (
  SELECT *, a + b * x AS fc,
         CASE WHEN n > 2 THEN sqrt(greatest(syy - b * sxy, 0) / (n - 2)) END AS sd
  FROM fits
),
{_flags(least, z)}"""


def _flags(least: int, z: float) -> str:
    return f"""
bounds AS (
  SELECT *, CASE WHEN n >= {least} THEN fc END AS forecast_value,
         CASE WHEN n >= {least} THEN fc + {z!r} * sd END AS upper_bound,
         CASE WHEN n >= {least} THEN fc - {z!r} * sd END AS lower_bound
  FROM stats
),
band AS (
  SELECT *, coalesce(observed_value > upper_bound OR observed_value < lower_bound, FALSE)
         AS is_anomaly, CAST(n AS BIGINT) AS training_size
  FROM bounds
)"""


def _band_query(keys: str, width: str, ctes: str, where: str = "") -> str:
    return f"""WITH {ctes}
SELECT {keys}, {_window_time('w', width)} AS window_time,
       {r6('observed_value')} AS observed_value, {r6('forecast_value')} AS forecast_value,
       {r6('upper_bound')} AS upper_bound, {r6('lower_bound')} AS lower_bound,
       is_anomaly, training_size
FROM band {where}"""


def _event_band(**options) -> str:
    return _band_query(
        "user_id, signal", "1 day", f"{EVENT_SERIES}, {_bands('user_id, signal', **options)}"
    )


def _global_band(**options) -> str:
    bands = _bands("signal", extra="1 minute", **options)
    return _band_query("signal", "1 minute", f"{GLOBAL_SERIES}, {bands}")


EVENT_BANDS = f"{EVENT_SERIES}, {_bands('user_id, signal')}"
LINE_BANDS = f"{LINE_SERIES}, {_bands('l_suppkey, signal', least=200, most=7000, confidence=90.0)}"

RECORD_COLUMNS = f"""{r6('observed_value')} AS observed_value,
       {half_up('forecast_value', 2)} AS expected_value,
       {r6('upper_bound')} AS upper_bound, {r6('lower_bound')} AS lower_bound,
       {r6('observed_value - forecast_value')} AS deviation"""
DIRECTION = """CASE WHEN observed_value > upper_bound THEN 'HIGH'
            WHEN observed_value < lower_bound THEN 'LOW' ELSE 'OUTLIER' END AS direction"""


def _line_records(where: str) -> str:
    return f"""WITH {LINE_BANDS}
SELECT l_suppkey, {_window_time('w', '1 day')} AS window_time, signal, {RECORD_COLUMNS}
FROM band WHERE is_anomaly AND {where}"""


HIGH_PRICE = f"""WITH {LINE_WIDE},
series AS (SELECT l_suppkey, w, l_extendedprice AS observed_value FROM wide),
{_bands('l_suppkey', least=200, most=7000, confidence=90.0)}
SELECT l_suppkey, {_window_time('w', '1 day')} AS window_time, 'l_extendedprice' AS signal,
       {RECORD_COLUMNS}, is_anomaly
FROM band WHERE is_anomaly AND observed_value > upper_bound"""


def _risk_columns(signals: list[str], key: str, width: str, source: str) -> str:
    pivot = ",\n         ".join(
        f"max(CASE WHEN signal = '{s}' THEN observed_value END) AS {s}" for s in signals
    )
    return f"""
risks AS (
  SELECT {key}, {_bucket('w', width)} AS window_start,
         {_bucket('w', width)} + INTERVAL '{width}' AS window_end,
         count(DISTINCT signal) AS signals_tripped,
         string_agg(DISTINCT signal, ', ' ORDER BY signal) AS tripped_signals,
         {pivot}
  FROM {source} WHERE is_anomaly GROUP BY ALL HAVING count(DISTINCT signal) >= 2
)"""


LINE_SIGNALS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
EVENT_SIGNALS = ["click", "error", "purchase", "signup", "view"]
LINE_RISKS = f"{LINE_BANDS}, {_risk_columns(LINE_SIGNALS, 'l_suppkey', '30 days', 'band')}"
EVENT_RISKS = f"{EVENT_BANDS}, {_risk_columns(EVENT_SIGNALS, 'user_id', '7 days', 'band')}"


def _risk_query(ctes: str, key: str, signals: list[str]) -> str:
    values = ", ".join(f"{r6(s)} AS {s}" for s in signals)
    return f"""WITH {ctes}
SELECT {key}, window_start, window_end, signals_tripped, tripped_signals, {values}
FROM risks"""


# A rounded reading as text: half away from zero on the decimal digits.
def _reading(column: str, digits: int, null_text: str | None) -> str:
    text = f"CAST({half_up(column, digits)} AS VARCHAR)"
    return text if null_text is None else f"coalesce({text}, '{null_text}')"


def _prompt(null_text: str | None) -> str:
    sensors = [
        ("l_quantity", "Quantity", 1, "25.5"),
        ("l_extendedprice", "Price", 2, "52000"),
        ("l_discount", "Discount", 4, "0.05"),
        ("l_tax", "Tax", 4, "0.04"),
    ]
    lines = " || ".join(
        f"'{label}: ' || {_reading(c, d, null_text)} || ' (normal near {normal})' || chr(10)"
        for c, label, d, normal in sensors
    )
    return f"""'Several sensors of one vehicle left their forecast band together. '
  || 'Name the most probable fault. Answer with these three lines and nothing else:' || chr(10)
  || 'SEVERITY: one of CRITICAL, HIGH, MEDIUM, LOW' || chr(10)
  || 'LIKELY_CAUSE: the fault in one sentence' || chr(10)
  || 'RECOMMENDED_ACTION: what to do, in one sentence' || chr(10) || chr(10)
  || 'Vehicle: ' || l_suppkey || chr(10)
  || 'Outside the band: ' || tripped_signals || ' (' || signals_tripped
  || ' distinct signals)' || chr(10)
  || {lines} || chr(10)
  || 'Use CRITICAL only where a breakdown within about 50 miles must be feared.'"""


RULE_CTES = """
rules AS (
  SELECT *, CASE WHEN signals_tripped >= 4 THEN 'CRITICAL' WHEN signals_tripped = 3 THEN 'HIGH'
                 ELSE 'MEDIUM' END AS severity,
         'joint fault behind ' || tripped_signals AS likely_cause
  FROM risks
),
diagnosed AS (
  SELECT *, CASE severity WHEN 'CRITICAL' THEN 'stop at the nearest service center'
                          WHEN 'HIGH' THEN 'repair today'
                          ELSE 'repair at the next stop' END AS recommended_action
  FROM rules
)"""
RULE_ANSWER = """'SEVERITY: ' || severity || chr(10) || 'LIKELY_CAUSE: ' || likely_cause
  || chr(10) || 'RECOMMENDED_ACTION: ' || recommended_action"""


def _diagnosed_query() -> str:
    values = ", ".join(f"{r6(s)} AS {s}" for s in LINE_SIGNALS)
    return f"""WITH {LINE_RISKS}, {RULE_CTES}
SELECT l_suppkey, window_start, window_end, signals_tripped, tripped_signals, {values},
       severity, likely_cause, recommended_action, {RULE_ANSWER} AS raw_diagnosis
FROM diagnosed"""


def _agent_text(null_text: str | None) -> str:
    def value(column: str) -> str:
        text = f"CAST({column} AS VARCHAR)"
        return text if null_text is None else f"coalesce({text}, '{null_text}')"

    sensors = " || ".join(f"', {s}: ' || {value(s)}" for s in LINE_SIGNALS)
    return f"""'truck_id: ' || l_suppkey || ', severity: ' || severity
  || ', likely_cause: ' || likely_cause
  || ', recommended_action: ' || recommended_action || {sensors}"""


AGENT_CTES = """
orders AS (
  SELECT *, CASE severity WHEN 'CRITICAL' THEN 'URGENT' WHEN 'HIGH' THEN 'PRIORITY'
                          ELSE 'SCHEDULED' END AS status
  FROM diagnosed
),
reports AS (
  SELECT *, l_suppkey || ' goes to SHOP-AUSTIN as ' || status || '.' AS dispatch_summary,
         '{"action": "dispatch_maintenance", "truck_id": "' || l_suppkey || '", "severity": "'
         || severity || '", "status": "' || status || '", "shop_id": "SHOP-AUSTIN", '
         || '"eta_miles": null, "parts_to_pre_stage": [], "diagnosis": "' || likely_cause
         || '"}' AS dispatch_json,
         'MOCKED: 200 OK' AS api_response
  FROM orders
),
actions AS (
  SELECT *, 'Dispatch Summary:' || chr(10) || dispatch_summary || chr(10) || chr(10)
         || 'Dispatch JSON:' || chr(10) || dispatch_json || chr(10) || chr(10)
         || 'API Response:' || chr(10) || api_response AS raw_response
  FROM reports
)"""
ACTIONS = f"{LINE_RISKS}, {RULE_CTES}, {AGENT_CTES}"

ACTION_ROWS = f"""WITH {ACTIONS}
SELECT CAST(l_suppkey AS VARCHAR) AS l_suppkey, window_start, severity, likely_cause,
       recommended_action, dispatch_summary, dispatch_json, api_response, raw_response
FROM actions"""

GAPPY = """
gappy AS (
  SELECT event_id, CASE WHEN value < 60 THEN value END AS value,
         CASE WHEN value > 1 THEN event_type END AS event_type, ts
  FROM events
)"""
ALL_SET = "value IS NOT NULL AND event_type IS NOT NULL AND ts IS NOT NULL"

CAUSES = """
causes AS (
  SELECT event_id, user_id,
         CASE event_id % 5 WHEN 0 THEN 'CRITICAL' WHEN 1 THEN 'high' WHEN 2 THEN 'MEDIUM'
                           WHEN 3 THEN 'LOW' ELSE 'UNKNOWN' END AS severity,
         'drift' || CASE WHEN value > 10 THEN ' of Vibration' ELSE '' END
         || CASE WHEN user_id % 2 = 0 THEN ' with engine_temp' ELSE '' END
         || CASE WHEN event_type = 'error' THEN ' and oil_pressure' ELSE '' END AS likely_cause
  FROM events
)"""
POLICY = """
rules(severity, status, max_eta_miles, shop_rule) AS (
  VALUES ('CRITICAL', 'URGENT', 50, 'nearest'),
         ('HIGH', 'PRIORITY', 200, 'nearest with specialty'),
         ('MEDIUM', 'SCHEDULED', NULL, 'end of route'), ('LOW', 'MONITOR', NULL, NULL)
),
policy AS (
  SELECT c.*, r.status, r.max_eta_miles, r.shop_rule
  FROM causes c LEFT JOIN rules r ON upper(c.severity) = r.severity
)"""
PARTS = """list_filter([CASE WHEN contains(lower(likely_cause), 'vibration')
                        THEN 'wheel bearing kit' END,
                   CASE WHEN contains(lower(likely_cause), 'engine_temp')
                        THEN 'coolant pump' END,
                   CASE WHEN contains(lower(likely_cause), 'oil_pressure')
                        THEN 'oil pump seal kit' END], lambda p: p IS NOT NULL)"""
SHOPS = """
centers AS (
  SELECT l_suppkey AS user_id, 'SHOP-' || l_partkey AS shop, l_quantity AS miles,
         CASE WHEN l_tax > 0.06 THEN 'vibration' WHEN l_tax > 0.03 THEN 'engine_temp'
              ELSE 'oil_pressure' END AS specialty
  FROM lineitem
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY miles, shop) AS place,
         row_number() OVER (PARTITION BY user_id, specialty ORDER BY miles, shop) AS special_place
  FROM centers
),
wanted AS (
  SELECT *, CASE WHEN contains(lower(likely_cause), 'vibration') THEN 'vibration'
                 WHEN contains(lower(likely_cause), 'engine_temp') THEN 'engine_temp'
                 WHEN contains(lower(likely_cause), 'oil_pressure') THEN 'oil_pressure'
            END AS specialty
  FROM policy
),
offered AS (
  SELECT w.*,
         CASE WHEN w.shop_rule = 'nearest with specialty' AND s.miles <= w.max_eta_miles
              THEN s.shop ELSE a.shop END AS shop,
         CASE WHEN w.shop_rule = 'nearest with specialty' AND s.miles <= w.max_eta_miles
              THEN s.miles ELSE a.miles END AS miles
  FROM wanted w
  LEFT JOIN ranked a ON a.user_id = w.user_id AND a.place = 1
  LEFT JOIN ranked s ON s.user_id = w.user_id AND s.specialty = w.specialty
                    AND s.special_place = 1
),
chosen AS (
  SELECT *, CASE WHEN shop_rule IS NULL THEN NULL
                 WHEN shop IS NOT NULL AND coalesce(miles <= max_eta_miles, TRUE) THEN shop
                 ELSE 'SHOP-AUSTIN' END AS shop_id,
         CASE WHEN shop_rule IS NOT NULL AND shop IS NOT NULL
                   AND coalesce(miles <= max_eta_miles, TRUE)
              THEN CAST(miles AS INTEGER) END AS eta_miles
  FROM offered
)"""

ANSWERS = """
answers AS (
  SELECT conv_id, turn,
         CASE turn % 5 WHEN 0 THEN 'SEVERITY: CRITICAL' || chr(10)
                       WHEN 1 THEN 'severity: high' || chr(10)
                       WHEN 2 THEN 'SEVERITY: SEVERE' || chr(10)
                       WHEN 3 THEN 'Severity:   LOW' || chr(10) ELSE '' END
         || 'LIKELY_CAUSE: ' || text
         || CASE WHEN turn % 5 = 4 THEN ''
                 ELSE chr(10) || 'RECOMMENDED_ACTION: call the ' || role END AS response
  FROM conversations
)"""
# The patterns of the report's sections.
REPORTS = """
shapes AS (
  SELECT *, CASE WHEN turn % 4 = 1 THEN '**' ELSE '' END AS m,
         CASE WHEN turn % 4 = 3 THEN chr(10) ELSE chr(10) || chr(10) END AS gap,
         '{"status": "' || role || '"}' AS body
  FROM conversations
),
reports AS (
  SELECT conv_id, turn,
         m || 'Dispatch Summary:' || m || chr(10) || text || gap
         || m || 'Dispatch JSON:' || m || chr(10)
         || CASE WHEN turn % 4 = 2 THEN '```json' || chr(10) || body || chr(10) || '```'
                 ELSE body END || chr(10) || chr(10)
         || m || 'API Response:' || m || chr(10) || '200 OK for ' || role AS response
  FROM shapes
),
parsed AS (
  SELECT conv_id, turn,
         trim(nullif(regexp_extract(response, '\\*{0,2}Dispatch Summary:\\*{0,2}\\s*\\n([\\s\\S]+?)(?:\\n\\n\\*{0,2}Dispatch JSON:\\*{0,2})', 1), '')) AS dispatch_summary,
         trim(nullif(regexp_extract(response, '\\*{0,2}Dispatch JSON:\\*{0,2}\\s*\\n(?:```json\\s*)?([\\s\\S]+?)(?:```)?(?:\\n\\n\\*{0,2}API Response:\\*{0,2})', 1), '')) AS dispatch_json,
         trim(nullif(regexp_extract(response, '\\*{0,2}API Response:\\*{0,2}\\s*\\n(?:```json\\s*)?([\\s\\S]+?)(?:```)?$', 1), '')) AS api_response
  FROM reports
)"""


def _hourly(aggregate: str) -> str:
    return f"""SELECT user_id, {_bucket('ts', '1 hour')} AS window_start,
       {_bucket('ts', '1 hour')} + INTERVAL '1 hour' AS window_end,
       {_window_time(_bucket('ts', '1 hour'), '1 hour')} AS window_time, {aggregate}
FROM events GROUP BY ALL"""


def _weekly(aggregates: str) -> str:
    return f"""SELECT user_id, {_bucket('ts', '7 days')} AS window_start,
       {_bucket('ts', '7 days')} + INTERVAL '7 days' AS window_end, {aggregates}
FROM events GROUP BY ALL"""


SQL: dict[str, str] = {
    "scan_telemetry": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "require_not_null": f"WITH {GAPPY} SELECT * FROM gappy WHERE {ALL_SET}",
    "rejects": f"WITH {GAPPY} SELECT * FROM gappy WHERE NOT ({ALL_SET})",
    "not_null_report": f"""WITH {GAPPY}
SELECT {_bucket('ts', '1 day')} AS window_start,
       count(*) FILTER ({ALL_SET}) AS accepted, count(*) FILTER (NOT ({ALL_SET})) AS rejected
FROM gappy GROUP BY ALL""",
    "ctas_engine_anomalies": HIGH_PRICE,
    "ctas_typed": f"""WITH {EVENT_BANDS}
SELECT CAST(user_id AS VARCHAR) AS user_id, {_window_time('w', '1 day')} AS window_time, signal,
       {RECORD_COLUMNS}, {DIRECTION}
FROM band WHERE is_anomaly""",
    "append_actions": f"""WITH {EVENT_SERIES},
keyed AS (SELECT CASE WHEN observed_value > 2 THEN CAST(user_id AS VARCHAR) ELSE 'UNKNOWN' END
                 AS entity, signal, w AS window_start FROM series)
SELECT * FROM keyed UNION ALL SELECT * FROM keyed""",
    "read_actions": f"""WITH {ACTIONS}
SELECT CAST(l_suppkey AS VARCHAR) AS l_suppkey, severity, likely_cause, dispatch_summary,
       dispatch_json, api_response
FROM actions""",
    "explode_json_list": """
SELECT event_id, unnest([event_type, 'u' || user_id]) AS member FROM events""",
    "stage_tables": _diagnosed_query(),
    "project_alias": """
SELECT event_id AS reading_id, user_id AS entity, event_type AS signal, value AS observed_value
FROM events""",
    "fanout_unpivot": f"""WITH {LINE_SERIES}
SELECT l_suppkey, {_window_time('w', '1 day')} AS window_time, signal,
       {r6('observed_value')} AS observed_value FROM series""",
    "struct_access": f"""WITH {EVENT_BANDS}
SELECT user_id, signal, {_window_time('w', '1 day')} AS window_time,
       {r6('upper_bound')} AS upper_bound, {r6('lower_bound')} AS lower_bound FROM band""",
    "filter_anomaly": f"""WITH {EVENT_BANDS}
SELECT user_id, signal, {_window_time('w', '1 day')} AS window_time,
       {r6('observed_value')} AS observed_value FROM band WHERE is_anomaly""",
    "high_side_only": _line_records("observed_value > upper_bound"),
    "low_side_only": _line_records("observed_value < lower_bound"),
    "direction_label": """
SELECT event_id, CASE WHEN value > 30 THEN 'HIGH' WHEN value < 5 THEN 'LOW' ELSE 'OUTLIER' END
       AS direction FROM events""",
    "deviation": f"""WITH {EVENT_BANDS}
SELECT user_id, signal, {_window_time('w', '1 day')} AS window_time,
       {r6('observed_value - forecast_value')} AS deviation
FROM band WHERE forecast_value IS NOT NULL""",
    # Rounding is half away from zero on the decimal digits.
    "round_values": """
SELECT event_id, CAST(round(CAST(value AS DECIMAL(18,6)), 1) AS DOUBLE) AS one,
       round(value / 7, 2) AS two, round(value / 7, 3) AS three FROM events""",
    "cast_values": """
SELECT event_id, CAST(value AS VARCHAR) AS value_text, CAST(ts AS VARCHAR) AS ts_text,
       CAST(user_id AS DOUBLE) AS user_double, date_trunc('milliseconds', ts) AS ts_millis
FROM events""",
    "coalesce_text": f"""WITH {GAPPY}
SELECT event_id, coalesce(CAST(value AS VARCHAR), 'n/a') AS value_text FROM gappy""",
    "concat_null": f"""WITH {GAPPY}
SELECT event_id, event_type || ': ' || {_reading('value', 1, None)} AS line FROM gappy""",
    "trim_text": """
SELECT conv_id, turn, trim('  ' || text || ' ' || chr(10) || ' ', ' ') AS trimmed
FROM conversations""",
    "regex_extract": """
SELECT event_id, nullif(regexp_extract(props, '"k": (9\\d)', 1), '') AS k_in_nineties
FROM events""",
    "ts_minus_interval": "SELECT event_id, ts - INTERVAL '5 seconds' AS watermark FROM events",
    "json_object": f"""WITH {GAPPY}
SELECT event_id, CAST(to_json({{'id': event_id, 'kind': event_type, 'value': value}}) AS VARCHAR)
       AS json FROM gappy""",
    "tumble_1m": f"""
SELECT user_id, {_bucket('ts', '1 minute')} AS window_start,
       {_bucket('ts', '1 minute')} + INTERVAL '1 minute' AS window_end,
       {_window_time(_bucket('ts', '1 minute'), '1 minute')} AS window_time,
       {r6('avg(value)')} AS avg_value, count(*) AS reading_count
FROM events GROUP BY ALL""",
    "tumble_5m_of_1m": f"""
WITH inside AS (
  SELECT event_type, {_window_time(_bucket('ts', '1 minute'), '1 minute')} AS t, max(value) AS top
  FROM events GROUP BY ALL)
SELECT event_type, {_bucket('t', '5 minutes')} AS window_start,
       {_bucket('t', '5 minutes')} + INTERVAL '5 minutes' AS window_end,
       {_window_time(_bucket('t', '5 minutes'), '5 minutes')} AS window_time,
       max(top) AS top, count(*) AS minutes
FROM inside GROUP BY ALL""",
    "window_columns": _hourly("min(value) AS least"),
    "avg_signals": f"""WITH {LINE_WIDE}
SELECT l_suppkey, w AS window_start, w + INTERVAL '1 day' AS window_end,
       {_window_time('w', '1 day')} AS window_time, {r6('l_quantity')} AS l_quantity,
       {r6('l_extendedprice')} AS l_extendedprice, {r6('l_discount')} AS l_discount,
       {r6('l_tax')} AS l_tax
FROM wide""",
    "max_signal": _hourly("max(value) AS top"),
    "reading_count": _hourly("count(*) AS reading_count"),
    "distinct_signals": _weekly("count(DISTINCT event_type) AS signals_tripped"),
    "list_signals": _weekly(
        "string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS tripped_signals"
    ),
    "signal_pivot": _weekly(
        ", ".join(
            f"max(CASE WHEN event_type = '{s}' THEN value END) AS {s}" for s in EVENT_SIGNALS
        )
    ),
    "escalate_multi_signal": _risk_query(EVENT_RISKS, "user_id", EVENT_SIGNALS),
    "window_profile": f"""
SELECT l_suppkey, {_bucket('l_shipdate', '1 day')} AS window_start,
       {_bucket('l_shipdate', '1 day')} + INTERVAL '1 day' AS window_end,
       {_window_time(_bucket('l_shipdate', '1 day'), '1 day')} AS window_time,
       {r6('avg(l_extendedprice)')} AS avg_l_extendedprice,
       max(l_extendedprice) AS max_l_extendedprice,
       {r6('avg(l_quantity)')} AS avg_l_quantity, count(*) AS reading_count
FROM lineitem GROUP BY ALL""",
    "running_frame": f"""WITH {EVENT_SERIES}
SELECT user_id, signal, {_window_time('w', '1 day')} AS window_time,
       {r6('observed_value')} AS observed_value, count(observed_value) OVER f AS seen,
       {r6('avg(observed_value) OVER f')} AS mean_so_far
FROM series
WINDOW f AS (PARTITION BY user_id, signal ORDER BY w
             RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "band_mean": _event_band(),
    "band_trend": _event_band(model="trend"),
    "band_ar1": _event_band(model="ar1"),
    "band_min_training": _event_band(least=9, confidence=95.0),
    "band_max_training": _event_band(most=7),
    "band_max_training_trend": _event_band(model="trend", most=8, confidence=99.0),
    "band_max_training_ar1": _event_band(model="ar1", most=8, confidence=99.0),
    "band_confidence": _event_band(confidence=80.0),
    "band_split_mean": _global_band(least=200),
    "band_split_trend": _global_band(model="trend", least=200),
    "band_split_ar1": _global_band(model="ar1", least=200),
    "band_split_max_training": _global_band(least=50, most=120),
    "anomaly_records": f"""WITH {LINE_BANDS}
SELECT l_suppkey, {_window_time('w', '1 day')} AS window_time, signal, {RECORD_COLUMNS},
       {DIRECTION}
FROM band WHERE is_anomaly""",
    "engine_anomalies": HIGH_PRICE,
    "eda_band": f"""WITH
profile AS (
  SELECT event_type AS signal, {_bucket('ts', '1 minute')} AS w, avg(value) AS observed_value,
         max(value) AS max_value, count(*) AS reading_count
  FROM events GROUP BY ALL
),
series AS (SELECT * FROM profile),
{_bands('signal', least=200, most=7000)}
SELECT signal, {_window_time('w', '1 minute')} AS window_time,
       {r6('observed_value')} AS avg_value, max_value, reading_count,
       {r6('forecast_value')} AS forecast_value, {r6('upper_bound')} AS upper_bound,
       {r6('lower_bound')} AS lower_bound, is_anomaly, training_size
FROM band""",
    "at_risk_entities": _risk_query(LINE_RISKS, "l_suppkey", LINE_SIGNALS),
    "union_all": " UNION ALL ".join(
        f"SELECT l_suppkey, '{s}' AS signal, {s} AS observed_value FROM lineitem"
        for s in LINE_SIGNALS
    ),
    "lateral_apply": """
SELECT event_id, event_type, props, upper(event_type) AS signal_upper,
       length(props) AS props_length FROM events""",
    "build_prompt": f"""WITH {LINE_RISKS}
SELECT l_suppkey, window_start, {_prompt('n/a')} AS prompt FROM risks""",
    "build_prompt_null": f"""WITH {LINE_RISKS}
SELECT l_suppkey, window_start, {_prompt(None)} AS prompt FROM risks""",
    "ml_predict_rules": f"""WITH {LINE_RISKS}, {RULE_CTES}
SELECT l_suppkey, window_start, {RULE_ANSWER} AS response FROM diagnosed""",
    # The patterns of the answer's sections.
    "parse_diagnosis": f"""WITH {ANSWERS}
SELECT conv_id, turn,
       trim(nullif(regexp_extract(response, '(?i)SEVERITY:\\s*(CRITICAL|HIGH|MEDIUM|LOW)', 1), ''))
         AS severity,
       trim(nullif(regexp_extract(response, '(?i)LIKELY_CAUSE:\\s*([\\s\\S]+?)(?:\\n\\s*(?:RECOMMENDED_ACTION|$))', 1), ''))
         AS likely_cause,
       trim(nullif(regexp_extract(response, '(?i)RECOMMENDED_ACTION:\\s*([\\s\\S]+?)$', 1), ''))
         AS recommended_action
FROM answers""",
    "agent_input": f"""WITH {LINE_RISKS}, {RULE_CTES}
SELECT l_suppkey, window_start, {_agent_text(None)} AS strict, {_agent_text('n/a')} AS filled
FROM diagnosed""",
    "invocation_key": f"""WITH {LINE_RISKS}
SELECT l_suppkey, window_start, l_suppkey || '_' || window_start AS key FROM risks""",
    "dispatch_policy": f"""WITH {CAUSES}, {POLICY}
SELECT * REPLACE (CAST(max_eta_miles AS VARCHAR) AS max_eta_miles) FROM policy""",
    "parts_lookup": f"""WITH {CAUSES}
SELECT event_id, CAST(to_json({PARTS}) AS VARCHAR) AS parts FROM causes""",
    "shop_lookup": f"""WITH {CAUSES}, {POLICY}, {SHOPS}
SELECT event_id, status, shop_id, CAST(eta_miles AS VARCHAR) AS eta_miles FROM chosen""",
    "dispatch_json": f"""WITH {CAUSES}, {POLICY}, {SHOPS}
SELECT event_id, CAST(to_json({{
         'action': 'dispatch_maintenance', 'truck_id': CAST(user_id AS VARCHAR),
         'severity': upper(severity), 'status': status, 'shop_id': shop_id,
         'eta_miles': eta_miles, 'parts_to_pre_stage': {PARTS}, 'diagnosis': likely_cause
       }}) AS VARCHAR) AS dispatch_json
FROM chosen""",
    "parse_actions": f"""WITH {REPORTS}
SELECT *, json_extract_string(dispatch_json, '$.status') AS status FROM parsed""",
    "diagnose_stage": _diagnosed_query(),
    "run_agent_rules": f"""WITH {ACTIONS}
SELECT CAST(l_suppkey AS VARCHAR) AS l_suppkey, window_start, raw_response FROM actions""",
    "action_stage": ACTION_ROWS,
    # A stream whose input has ended gives the rows of the batch job.
    "stream_actions": ACTION_ROWS,
    "stream_tumble": f"""
SELECT event_type AS signal, {_bucket('ts', '1 minute')} AS window_start,
       {_bucket('ts', '1 minute')} + INTERVAL '1 minute' AS window_end,
       {_window_time(_bucket('ts', '1 minute'), '1 minute')} AS window_time,
       {r6('avg(value)')} AS avg_value, count(*) AS reading_count
FROM events GROUP BY ALL""",
    "stream_band": _event_band(),
    "stream_escalate": _risk_query(LINE_RISKS, "l_suppkey", LINE_SIGNALS),
    "stream_diagnose": _diagnosed_query(),
    "stream_band_seeded": _event_band(),
    "stream_band_retired": _band_query("user_id, signal", "1 day", f"""{EVENT_SERIES.replace(
        'series AS', 'whole AS')},
gaps AS (
  SELECT *, CASE WHEN w - lag(w) OVER k > INTERVAL '3 days' THEN 1 ELSE 0 END AS gap
  FROM whole WINDOW k AS (PARTITION BY user_id, signal ORDER BY w)
),
series AS (
  SELECT *, sum(gap) OVER (PARTITION BY user_id, signal ORDER BY w) AS life FROM gaps
),
{_bands('user_id, signal, life')}"""),
    "stream_rejects": f"WITH {GAPPY} SELECT * FROM gappy WHERE NOT ({ALL_SET})",
    "stream_late_rows": f"""
WITH arrivals AS (
  SELECT *, least((day(ts) - 1) // 8 + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END, 3) AS slice
  FROM events
),
marks AS (
  SELECT a.slice, max(date_trunc('milliseconds', b.ts)) - INTERVAL '5 seconds' AS watermark
  FROM (SELECT DISTINCT slice FROM arrivals) a JOIN arrivals b ON b.slice < a.slice
  GROUP BY a.slice
)
SELECT event_id, ts, user_id, watermark
FROM arrivals JOIN marks USING (slice)
WHERE {_bucket('ts', '1 hour')} + INTERVAL '1 hour' <= watermark""",
    "stream_stage_tables": _diagnosed_query(),
    "agent_ledger": f"""WITH {ACTIONS}
SELECT l_suppkey || '_' || window_start AS key, raw_response AS response,
       CAST(CASE WHEN l_suppkey % 3 <> 0 THEN 0 ELSE 1 END AS BIGINT) AS delivery
FROM actions""",
    "action_stage_tools": f"""WITH {LINE_RISKS}, {RULE_CTES},
causes AS (
  SELECT * REPLACE (likely_cause || CASE l_suppkey % 3 WHEN 0 THEN ' (vibration)'
                                     WHEN 1 THEN ' (engine_temp)' ELSE '' END AS likely_cause),
         CASE l_suppkey % 3 WHEN 0 THEN 'vibration' WHEN 1 THEN 'engine_temp' END AS word,
         CASE severity WHEN 'CRITICAL' THEN 'URGENT' WHEN 'HIGH' THEN 'PRIORITY'
                       ELSE 'SCHEDULED' END AS status,
         CASE severity WHEN 'CRITICAL' THEN 50 WHEN 'HIGH' THEN 200 END AS most
  FROM diagnosed
),
centers AS (
  SELECT l_suppkey, 'SHOP-' || l_partkey AS shop,
         l_quantity * 3 + CASE WHEN l_suppkey % 4 = 3 THEN 60 ELSE 0 END AS miles,
         CASE WHEN l_tax > 0.06 THEN 'vibration' WHEN l_tax > 0.03 THEN 'engine_temp'
              ELSE 'oil_pressure' END AS specialty
  FROM lineitem
),
nearest AS (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY miles, shop) AS place,
         row_number() OVER (PARTITION BY l_suppkey, specialty ORDER BY miles, shop) AS special
  FROM centers
),
offered AS (
  SELECT c.*,
         CASE WHEN severity = 'HIGH' AND s.miles <= 200 THEN s.shop
              WHEN most IS NULL OR a.miles <= most THEN a.shop ELSE 'SHOP-AUSTIN' END AS shop_id,
         CASE WHEN severity = 'HIGH' AND s.miles <= 200 THEN s.miles
              WHEN most IS NULL OR a.miles <= most THEN a.miles END AS eta
  FROM causes c
  LEFT JOIN nearest a ON a.l_suppkey = c.l_suppkey AND a.place = 1
  LEFT JOIN nearest s ON s.l_suppkey = c.l_suppkey AND s.special = 1 AND s.specialty = c.word
),
told AS (
  SELECT *, l_suppkey || ' goes to ' || shop_id || ' as ' || status || '.' AS dispatch_summary,
         '{{"action": "dispatch_maintenance", "truck_id": "' || l_suppkey || '", "severity": "'
         || severity || '", "status": "' || status || '", "shop_id": "' || shop_id
         || '", "eta_miles": ' || coalesce(CAST(CAST(floor(eta) AS BIGINT) AS VARCHAR), 'null')
         || ', "parts_to_pre_stage": ['
         || CASE word WHEN 'vibration' THEN '"wheel bearing kit"'
                      WHEN 'engine_temp' THEN '"coolant pump"' ELSE '' END
         || '], "diagnosis": "' || likely_cause || '"}}' AS dispatch_json,
         CASE l_suppkey % 5 WHEN 0 THEN 'MOCKED: 200 OK'
              WHEN 1 THEN 'FAILED: PostRefused: order refused'
              ELSE '201 for ' || l_suppkey || '_' || window_start END AS api_response
  FROM offered
)
SELECT CAST(l_suppkey AS VARCHAR) AS l_suppkey, window_start, severity, likely_cause,
       recommended_action, dispatch_summary, dispatch_json, api_response,
       'Dispatch Summary:' || chr(10) || dispatch_summary || chr(10) || chr(10)
       || 'Dispatch JSON:' || chr(10) || dispatch_json || chr(10) || chr(10)
       || 'API Response:' || chr(10) || api_response AS raw_response
FROM told""",
    # A row without a time sorts first; 1900 stands for its place.
    "band_dirty": f"""WITH {EVENT_SERIES.replace('series AS', 'whole AS')},
series AS (
  SELECT user_id, signal, CASE WHEN day(w) = 12 THEN TIMESTAMP '1900-01-01' ELSE w END AS w,
         CASE WHEN day(w) % 5 <> 0 AND day(w) % 7 <> 0 THEN observed_value END AS observed_value
  FROM whole
),
{_bands('user_id, signal')}
SELECT user_id, signal,
       CASE WHEN w > TIMESTAMP '1900-01-01' THEN {_window_time('w', '1 day')} END AS window_time,
       {r6('forecast_value')} AS forecast_value, {r6('upper_bound')} AS upper_bound,
       {r6('lower_bound')} AS lower_bound, is_anomaly, training_size
FROM band""",
}
