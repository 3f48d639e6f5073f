"""The SQL that each query must agree with, for DuckDB over the same tables."""

from __future__ import annotations

READINGS = "SELECT event_id, ts, 'dev-' || user_id AS device_id, event_type AS metric, value FROM events"
OBSERVED = f"""
SELECT ts, device_id, metric, CASE WHEN value >= 20 THEN value END AS value,
       CASE WHEN metric IN ('click', 'signup', 'view') THEN 'mV' ELSE '' END AS unit,
       CASE WHEN metric IN ('click', 'signup', 'view') THEN 'bio_signal' ELSE 'environment' END AS domain,
       CAST(CASE WHEN value < 20 THEN 1 ELSE 0 END AS BIGINT) AS quality_flag
FROM ({READINGS})"""
SHIPMENTS = """
SELECT l_shipdate AS "Time", 'sup-' || l_suppkey AS device_id, l_orderkey, l_linenumber, l_partkey,
       l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem"""
RAW = f'SELECT ts AS "Time", device_id, metric AS sensor, value FROM ({READINGS})'
FILE = "'lab_dev-' || user_id || '_' || strftime(ts, '%Y-%m-%d') || '.csv'"
SECOND = "date_trunc('second', ts)"
TIE = "l_orderkey, l_linenumber, l_partkey, l_extendedprice"
EPOCH = "TIMESTAMP '1970-01-01'"


def iso(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%dT%H:%M:%SZ')"


def bucket(interval: str, ts: str = "ts") -> str:
    return f"time_bucket(INTERVAL '{interval}', {ts}, {EPOCH})"


SQL: dict[str, str] = {}

# --- times, names, columns

SQL["ts_normalize"] = f"""
SELECT event_id, {iso(SECOND)} AS iso, {iso(SECOND + ' - INTERVAL 2 HOUR')} AS iso_moved, {iso(SECOND)} AS iso_wall,
       'at ' || CAST(ts AS VARCHAR) AS kept_text, {iso("date_trunc('day', ts)")} AS iso_day
FROM events"""

SQL["time_buckets"] = f"""
SELECT event_id, {bucket('7 seconds')} AS b7s, {bucket('10 minutes')} AS b10m, {bucket('1 hour')} AS b1h,
       {bucket('1 day')} AS b1d, CAST(date_trunc('week', ts) AS TIMESTAMP) AS b1w,
       CAST(date_trunc('month', ts) AS TIMESTAMP) AS b1mo
FROM events"""

SQL["source_identity"] = """
SELECT event_id, 'lab' AS experience, 'dev-' || user_id AS device_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type AS domain,
       '10s' AS level
FROM events"""

SQL["select_rename"] = f'SELECT "Time" AS ts, device_id, l_quantity AS quantity, l_tax, l_orderkey FROM ({SHIPMENTS})'

SQL["round_wide"] = """
SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity, 1) AS l_quantity, round(l_extendedprice, 0) AS l_extendedprice,
       round(l_discount, 1) AS l_discount, round(l_tax, 1) AS l_tax
FROM lineitem"""

SQL["round_by_metric"] = f"""
SELECT event_id, metric, CASE metric WHEN 'click' THEN round(value, 0) WHEN 'view' THEN round(value, 1) ELSE value END AS value
FROM ({READINGS})"""

SQL["filter_metrics"] = f"""
SELECT event_id, CASE metric WHEN 'click' THEN 'm0' ELSE metric END AS metric, value
FROM ({READINGS}) WHERE metric IN ('click', 'view')"""

SQL["literal_identity"] = "SELECT event_id, 'dev-' || user_id AS device_id, 'bio_signal' AS domain FROM events"

# --- pruning and filters

SQL["filter_range"] = f"""
SELECT * FROM ({READINGS}) WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 23:59:59'"""

SQL["prune_overlap"] = f"""
WITH r AS (SELECT event_id, ts, {FILE} AS source_file FROM events),
kept AS (
  SELECT source_file FROM r GROUP BY source_file
  HAVING max(ts) >= TIMESTAMP '2024-01-10 12:00:00' AND min(ts) <= TIMESTAMP '2024-01-12 06:00:00')
SELECT r.* FROM r SEMI JOIN kept USING (source_file)"""

SQL["prune_zones"] = SQL["prune_overlap"]
SQL["prune_days"] = f"""
WITH r AS (
  SELECT event_id, ts,
         CASE WHEN event_type = 'click' THEN 'lab_dev-' || user_id || '.csv' ELSE {FILE} END AS source_file,
         CASE WHEN event_type <> 'click' THEN CAST(ts AS DATE) END AS day
  FROM events),
kept AS (
  SELECT source_file FROM r WHERE day IS NULL GROUP BY source_file
  HAVING max(ts) >= TIMESTAMP '2024-01-10 12:00:00' AND min(ts) <= TIMESTAMP '2024-01-12 06:00:00')
SELECT event_id, source_file, CAST(day AS VARCHAR) AS day FROM r
WHERE r.day BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'
   OR (r.day IS NULL AND source_file IN (SELECT source_file FROM kept))"""

SQL["filter_source_date"] = """
WITH r AS (
  SELECT event_id, ts,
         CASE WHEN event_type = 'click' THEN 'lab_x.csv'
              ELSE 'lab_x_' || strftime(ts + INTERVAL 6 HOUR, '%Y-%m-%d') || '.csv' END AS source_file
  FROM events)
SELECT * FROM r
WHERE source_file = 'lab_x.csv' OR source_file = 'lab_x_' || strftime(ts, '%Y-%m-%d') || '.csv'"""

SQL["domain_split"] = f"""
SELECT "Time", device_id, l_orderkey, l_linenumber, l_quantity, l_extendedprice, CAST(NULL AS DOUBLE) AS l_discount,
       CAST(NULL AS DOUBLE) AS l_tax, 'trade' AS domain FROM ({SHIPMENTS})
UNION ALL
SELECT "Time", device_id, l_orderkey, l_linenumber, l_quantity, NULL, l_discount, l_tax, 'terms' FROM ({SHIPMENTS})"""

# --- sources

SQL["kv_parse"] = f"""
SELECT {SECOND} AS "Time", {FILE} AS source_file, event_id AS seq, event_type || ':x' AS note,
       CASE WHEN event_type = 'click' THEN value END AS click, CASE WHEN event_type = 'error' THEN value END AS error,
       CASE WHEN event_type = 'purchase' THEN value END AS purchase, CASE WHEN event_type = 'signup' THEN value END AS signup,
       CASE WHEN event_type = 'view' THEN value END AS "view"
FROM events"""

SQL["kv_lenient_long"] = f"""
SELECT {SECOND} AS "Time", 'dev-' || user_id AS device_id, event_type AS sensor, value, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
       {FILE} AS source_file
FROM events"""

SQL["discover_metrics"] = """
SELECT event_type AS metric, count(*) AS readings, 'double' AS type FROM events GROUP BY event_type
UNION ALL SELECT 'seq', count(*), 'long' FROM events
UNION ALL SELECT 'note', count(*), 'string' FROM events"""

SQL["raw_rewrite"] = f"""
SELECT {iso(SECOND)} || ';seq:0;' || event_type || ':' || CAST(value AS VARCHAR) || ';no pair;note:' || event_type
       || ':x;seq:' || event_id AS value, {FILE} AS source_file
FROM events"""

SQL["kv_files_read"] = f"""
SELECT {SECOND} AS "Time", event_type AS sensor, value FROM events
UNION ALL SELECT {SECOND}, 'seq', CAST(event_id AS DOUBLE) FROM events"""

SQL["csv_round_trip"] = f"""
SELECT {SECOND} AS ts, device_id, metric, round(value, CASE WHEN metric = 'click' THEN 1 ELSE 3 END) AS value,
       nullif(unit, '') AS unit, domain, quality_flag
FROM ({OBSERVED})"""

SQL["time_column"] = "SELECT event_id, ts, value FROM events"
SQL["raw_format_found"] = """
SELECT l_shipdate AS "Time", 'l_quantity' AS sensor, l_quantity AS value FROM lineitem
UNION ALL SELECT l_shipdate, 'l_tax', nullif(l_tax, 0) FROM lineitem"""

SQL["raw_mixed_folder"] = f"""
SELECT {SECOND} AS "Time", CASE WHEN day(ts) % 3 = 0 THEN event_type ELSE 'click' END AS sensor,
       CASE WHEN day(ts) % 3 = 0 OR event_type = 'click' THEN value END AS value
FROM events"""
SQL["csv_mixed_headers"] = """
SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 <> 2 THEN l_quantity END AS l_quantity, l_tax FROM lineitem"""
SQL["parser_rejects"] = f"SELECT event_id, {FILE} AS source_file FROM events WHERE event_type = 'purchase'"

# --- cleaning


def cleaned_events(flag: str, series: str = "device_id, CAST(ts AS DATE)") -> str:
    return f"""
WITH a AS (
  SELECT *, CASE WHEN value < 5 OR value > 150 THEN NULL ELSE value END AS v1 FROM ({READINGS})),
b AS (
  SELECT *, lag(v1) OVER (PARTITION BY {series} ORDER BY ts, event_id) AS prev FROM a),
c AS (SELECT *, coalesce(abs(v1 - prev) > 60, FALSE) AS spike FROM b)
SELECT event_id, ts, device_id, metric, CASE WHEN NOT spike THEN v1 END AS value, CAST({flag} AS BIGINT) AS quality_flag
FROM c"""


SQL["clean_documented"] = cleaned_events(
    "CASE WHEN value IS NULL THEN 1 WHEN v1 IS NULL THEN 3 WHEN spike THEN 2 ELSE 0 END"
)
SQL["incremental_clean"] = cleaned_events(
    "CASE WHEN value IS NULL THEN 1 WHEN v1 IS NULL THEN 3 WHEN spike THEN 2 ELSE 0 END", "device_id"
)
SQL["clean_as_coded"] = cleaned_events("CASE WHEN v1 IS NULL OR spike THEN 1 ELSE 0 END")

SQL["clean_wide"] = f"""
WITH a AS (
  SELECT * REPLACE (CASE WHEN l_linenumber = 6 THEN NULL ELSE l_quantity END AS l_quantity,
                    CASE WHEN l_linenumber <> 7 THEN l_tax END AS l_tax),
         l_linenumber = 7 AS missing, l_linenumber = 6 AS impossible
  FROM ({SHIPMENTS})),
b AS (
  SELECT *, CASE WHEN l_quantity < 2 OR l_quantity > 48 THEN NULL ELSE l_quantity END AS q,
         CASE WHEN l_discount > 0.09 THEN NULL ELSE l_discount END AS d FROM a),
c AS (
  SELECT *, lag(q) OVER w AS q0, lag(l_tax) OVER w AS t0 FROM b
  WINDOW w AS (PARTITION BY device_id ORDER BY "Time", {TIE})),
d AS (
  SELECT *, coalesce(abs(q - q0) > 30, FALSE) AS qs, coalesce(abs(l_tax - t0) > 0.05, FALSE) AS ts_,
         (l_quantity IS NOT NULL AND q IS NULL) OR (l_discount IS NOT NULL AND d IS NULL) AS outside FROM c)
SELECT "Time", device_id, l_orderkey, l_linenumber, l_partkey, CAST(CASE WHEN NOT qs THEN q END AS BIGINT) AS l_quantity,
       l_extendedprice, d AS l_discount, CASE WHEN NOT ts_ THEN l_tax END AS l_tax,
       CAST(CASE WHEN missing THEN 1 WHEN impossible THEN 4 WHEN outside THEN 3 WHEN qs OR ts_ THEN 2 ELSE 0 END AS BIGINT)
         AS quality_flag
FROM d"""

SQL["clean_no_rules"] = """
SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_tax, 0) AS l_tax,
       CAST(CASE WHEN nullif(l_tax, 0) IS NULL THEN 1 ELSE 0 END AS BIGINT) AS quality_flag
FROM lineitem"""

SQL["previous_value"] = f"""
SELECT *, lag(value) OVER (PARTITION BY device_id, metric ORDER BY ts, event_id) AS prev_value FROM ({READINGS})"""

HIGH = f"SELECT * REPLACE (CASE WHEN value >= 60 THEN value END AS value) FROM ({READINGS})"
UP_TO = "(PARTITION BY device_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
FROM_ON = "(PARTITION BY device_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"

SQL["forward_filled"] = f"SELECT * REPLACE (last_value(value IGNORE NULLS) OVER {UP_TO} AS value) FROM ({HIGH})"
SQL["backward_filled"] = f"SELECT * REPLACE (first_value(value IGNORE NULLS) OVER {FROM_ON} AS value) FROM ({HIGH})"
SQL["interpolated_rows"] = f"""
WITH a AS (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY ts, event_id) AS p FROM ({HIGH})),
b AS (
  SELECT *, CASE WHEN value IS NOT NULL THEN p END AS vp FROM a),
c AS (
  SELECT *, last_value(vp IGNORE NULLS) OVER {UP_TO} AS p0, last_value(value IGNORE NULLS) OVER {UP_TO} AS v0,
         first_value(vp IGNORE NULLS) OVER {FROM_ON} AS p1, first_value(value IGNORE NULLS) OVER {FROM_ON} AS v1 FROM b)
SELECT event_id, ts, device_id, metric,
       round(coalesce(value, v0 + (v1 - v0) * ((p - p0) / nullif(p1 - p0, 0))), 9) AS value
FROM c"""

SQL["ffill_bfill_drop"] = f"""
WITH a AS (
  SELECT *, CAST(CASE WHEN l_quantity < 5 OR l_quantity > 45 THEN NULL ELSE l_quantity END AS BIGINT) AS q,
         CASE WHEN l_discount < 0.01 THEN NULL ELSE l_discount END AS d
  FROM ({SHIPMENTS})),
b AS (
  SELECT *, last_value(q IGNORE NULLS) OVER w AS qf, last_value(d IGNORE NULLS) OVER w AS df,
         first_value(q IGNORE NULLS) OVER n AS qb, first_value(d IGNORE NULLS) OVER n AS db
  FROM a
  WINDOW w AS (PARTITION BY device_id ORDER BY "Time", {TIE} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         n AS (PARTITION BY device_id ORDER BY "Time", {TIE} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT device_id, l_orderkey, l_linenumber, l_partkey, l_extendedprice, "Time", coalesce(qf, qb) AS l_quantity,
       coalesce(df, db) AS l_discount
FROM b WHERE coalesce(qf, qb) IS NOT NULL AND coalesce(df, db) IS NOT NULL"""

# --- derived columns, reshaping

SQL["transforms"] = f"""
SELECT "Time", l_orderkey, l_linenumber, l_partkey, round(l_quantity, 9) AS l_quantity,
       round(l_extendedprice, 9) AS l_extendedprice, round(l_discount, 9) AS l_discount, round(l_tax, 9) AS l_tax,
       round(CASE WHEN l_discount > 0 THEN ln(l_discount) END, 9) AS discount_log,
       round(CASE WHEN l_discount > 0 THEN sqrt(1.0::DOUBLE / l_discount) END, 9) AS discount_inv,
       round(l_quantity * 1.8::DOUBLE + 32, 9) AS quantity_f, round(ln(l_quantity * 1.8::DOUBLE + 32), 9) AS quantity_f_log
FROM ({SHIPMENTS})"""


def gaussian(column: str) -> str:
    return f"round(CASE WHEN {column} > 0 THEN sqrt(1.0::DOUBLE / {column}) ELSE {column} END, 9) AS {column}"


SQL["gaussianised"] = f"""
SELECT "Time", l_orderkey, l_linenumber, l_partkey, {gaussian('l_quantity')}, {gaussian('l_extendedprice')},
       {gaussian('l_discount')}, {gaussian('l_tax')}
FROM ({SHIPMENTS})"""

SQL["canonical_long"] = f"""
WITH w AS (
  SELECT "Time" AS ts, device_id, l_quantity, l_extendedprice, l_discount, nullif(l_tax, 0) AS l_tax,
         CAST(CASE WHEN l_tax = 0 THEN 1 ELSE 0 END AS BIGINT) AS quality_flag FROM ({SHIPMENTS}))
SELECT ts, device_id, metric, value,
       CASE metric WHEN 'l_extendedprice' THEN 'EUR' WHEN 'l_quantity' THEN 'pcs' ELSE '' END AS unit, 'trade' AS domain, quality_flag
FROM w UNPIVOT INCLUDE NULLS (value FOR metric IN (l_quantity, l_extendedprice, l_discount, l_tax))"""

SQL["sink_long"] = f"""
WITH w AS (
  SELECT "Time" AS ts, device_id, 'trade' AS domain, l_quantity AS m0, l_discount, l_tax FROM ({SHIPMENTS}))
SELECT ts, device_id, domain, sensor, value
FROM w UNPIVOT INCLUDE NULLS (value FOR sensor IN (m0, l_discount, l_tax))"""

SQL["raw_long"] = f"""
WITH w AS (SELECT "Time", device_id, l_quantity, l_extendedprice, l_discount, l_tax FROM ({SHIPMENTS}))
SELECT "Time", device_id, sensor, value
FROM w UNPIVOT INCLUDE NULLS (value FOR sensor IN (l_quantity, l_extendedprice, l_discount, l_tax))"""

SQL["variable_long"] = """
SELECT l_shipdate AS timestamp, 'l_quantity' AS variable, l_quantity AS value FROM lineitem
UNION ALL SELECT l_shipdate, 'l_tax', l_tax FROM lineitem WHERE l_tax <> 0"""

SQL["lines_to_long"] = f"""
SELECT {SECOND} AS "Time", {FILE} AS source_file, event_type AS sensor, value FROM events
UNION ALL SELECT {SECOND}, {FILE}, 'seq', CAST(event_id AS DOUBLE) FROM events"""

# --- duplicates

SQL["dedup_all"] = f"SELECT DISTINCT * FROM (({READINGS}) UNION ALL (SELECT * FROM ({READINGS}) WHERE metric = 'click'))"
SQL["dedup_subset"] = f"""
SELECT * FROM ({SHIPMENTS})
QUALIFY row_number() OVER (PARTITION BY device_id, "Time" ORDER BY {TIE}, l_quantity, l_discount, l_tax) = 1"""
SQL["limited"] = f"SELECT * FROM ({READINGS}) ORDER BY ts, event_id LIMIT 500"

# --- as-of and resampling

SQL["asof_backward"] = f"""
WITH l AS (SELECT event_id, device_id, ts FROM ({READINGS}) WHERE metric = 'click'),
r AS (
  SELECT device_id, ts AS obs_ts, CASE WHEN value >= 20 THEN value END AS value, event_id AS purchase_id
  FROM ({READINGS}) WHERE metric = 'purchase')
SELECT l.event_id, l.device_id, l.ts, r.obs_ts, r.value, r.purchase_id
FROM l ASOF LEFT JOIN r ON l.device_id = r.device_id AND l.ts >= r.obs_ts"""

SQL["asof_ties"] = f"""
WITH r AS (SELECT *, date_trunc('day', ts)::TIMESTAMP AS d FROM ({READINGS})),
l AS (SELECT event_id, device_id, d AS ts FROM r WHERE metric = 'click'),
o AS (
  SELECT device_id, d AS obs_ts, value FROM r WHERE metric = 'view'
  QUALIFY row_number() OVER (
    PARTITION BY device_id, d ORDER BY CASE WHEN value >= 50 THEN floor(value / 100) END DESC NULLS LAST, value DESC) = 1)
SELECT l.event_id, l.device_id, l.ts, o.obs_ts, o.value
FROM l ASOF LEFT JOIN o ON l.device_id = o.device_id AND l.ts >= o.obs_ts"""


def grid(interval: str, by_day: bool, midnight: bool = False, source: str = OBSERVED) -> str:
    """CTEs ``o`` (observations) and ``g`` (grid with the matched observation)."""
    day = ", day" if by_day else ""
    lo = "date_trunc('day', min(ts))" if midnight else "min(ts)"
    on_day = "AND g0.day = o.day" if by_day else ""
    return f"""
WITH o AS (SELECT *, CAST(ts AS DATE) AS day FROM ({source})),
units AS (SELECT device_id, domain, metric, max(unit) AS unit FROM o GROUP BY ALL),
b AS (SELECT device_id, domain{day}, CAST({lo} AS TIMESTAMP) AS lo, max(ts) AS hi FROM o GROUP BY ALL),
m AS (SELECT DISTINCT device_id, domain, metric{day} FROM o),
g0 AS (
  SELECT m.device_id, m.domain, m.metric{', m.day' if by_day else ''}, unnest(generate_series(lo, hi, INTERVAL '{interval}')) AS ts
  FROM b JOIN m USING (device_id, domain{day})),
g AS (
  SELECT g0.*, units.unit, o.ts AS obs_ts, o.value, o.quality_flag AS obs_flag
  FROM g0 JOIN units USING (device_id, domain, metric)
  ASOF LEFT JOIN o ON g0.device_id = o.device_id AND g0.domain = o.domain AND g0.metric = o.metric {on_day} AND g0.ts >= o.ts),"""


DAY_START = """
f AS (
  SELECT device_id, domain, metric, day, arg_min({'obs_ts': obs_ts, 'value': value}, ts) FILTER (WHERE obs_ts IS NOT NULL) AS first
  FROM g GROUP BY ALL),
h AS (
  SELECT g.* REPLACE (coalesce(g.obs_ts, f.first.obs_ts) AS obs_ts,
                      CASE WHEN g.obs_ts IS NULL THEN f.first.value ELSE g.value END AS value)
  FROM g JOIN f USING (device_id, domain, metric, day))"""
MARKS = """ts, device_id, metric, value, unit, domain,
       CAST(CASE WHEN obs_ts IS NULL THEN 1 WHEN obs_ts <> ts THEN 5 ELSE obs_flag END AS BIGINT) AS quality_flag,
       obs_ts IS NULL OR obs_ts <> ts AS is_interpolated,
       CAST(trunc((epoch_us(ts) - epoch_us(obs_ts)) / 1e6) AS DOUBLE) AS gap_duration"""


def by_day(interval: str, midnight: bool = False, source: str = OBSERVED) -> str:
    return f"{grid(interval, True, midnight, source)} {DAY_START} SELECT {MARKS} FROM h"


SQL["regular_grid"] = f"""
WITH b AS (
  SELECT device_id, domain, min(ts) AS lo, max(ts) AS hi FROM ({OBSERVED}) GROUP BY ALL),
m AS (SELECT device_id, domain, metric, max(unit) AS unit FROM ({OBSERVED}) GROUP BY ALL)
SELECT device_id, domain, metric, unit, unnest(range(0, len(generate_series(lo, hi, INTERVAL 6 HOUR)))) AS cell,
       unnest(generate_series(lo, hi, INTERVAL 6 HOUR)) AS ts
FROM b JOIN m USING (device_id, domain)"""
SQL["resample_forward"] = f"{grid('3 hours', False)} h AS (SELECT * FROM g) SELECT {MARKS} FROM h"
SQL["incremental_resample"] = SQL["resample_forward"]
SQL["resample_by_day"] = by_day("10 minutes")
SQL["resample_by_day_midnight"] = by_day("1 hour", True)
SQL["resample_linear"] = f"""
{grid('3 hours', False)}
p AS (SELECT *, row_number() OVER (PARTITION BY device_id, domain, metric ORDER BY ts) AS p FROM g),
q AS (
  SELECT *, last_value(CASE WHEN value IS NOT NULL THEN p END IGNORE NULLS) OVER w AS p0, last_value(value IGNORE NULLS) OVER w AS v0,
         first_value(CASE WHEN value IS NOT NULL THEN p END IGNORE NULLS) OVER n AS p1, first_value(value IGNORE NULLS) OVER n AS v1
  FROM p
  WINDOW w AS (PARTITION BY device_id, domain, metric ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         n AS (PARTITION BY device_id, domain, metric ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
h AS (SELECT * REPLACE (round(coalesce(value, v0 + (v1 - v0) * ((p - p0) / nullif(p1 - p0, 0))), 9) AS value) FROM q)
SELECT {MARKS} FROM h"""


def nearest(rows: str, keys: str) -> str:
    return f"""
SELECT * REPLACE (coalesce(last_value(value IGNORE NULLS) OVER (PARTITION BY {keys} ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                           first_value(value IGNORE NULLS) OVER (PARTITION BY {keys} ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS value)
FROM {rows}"""


SQL["resample_nearest"] = f"""
{grid('30 minutes', True)} {DAY_START},
n AS ({nearest('h', 'device_id, domain, metric, day')})
SELECT {MARKS} FROM n"""
BIO_ONLY = f"SELECT * FROM ({OBSERVED}) WHERE domain = 'bio_signal'"
ENVIRONMENT_ONLY = f"SELECT * FROM ({OBSERVED}) WHERE domain = 'environment'"
SQL["resample_domains"] = f"""
SELECT * FROM ({by_day('1 hour', source=BIO_ONLY)})
UNION ALL
SELECT * FROM ({grid('6 hours', False, source=ENVIRONMENT_ONLY)} n AS ({nearest('g', 'device_id, domain, metric')}) SELECT {MARKS} FROM n)"""

# --- aggregation

SQL["agg_median_mean"] = f"""
SELECT {bucket('10 minutes')} AS ts, device_id, domain,
       round(median(value) FILTER (metric = 'click'), 9) AS click_median, round(avg(value) FILTER (metric = 'click'), 9) AS click_mean,
       round(median(value) FILTER (metric = 'view'), 9) AS view_median,
       round(avg(value) FILTER (metric = 'purchase'), 9) AS purchase_mean, CAST(NULL AS DOUBLE) AS unknown
FROM ({OBSERVED}) GROUP BY ALL"""
SQL["spine_left_join"] = f"""
WITH r AS (SELECT *, {bucket('10 minutes')} AS b FROM ({OBSERVED})),
spine AS (SELECT DISTINCT b, device_id, domain FROM r),
c AS (SELECT b, device_id, domain, median(value) AS click_median, avg(value) AS click_mean FROM r WHERE metric = 'click' GROUP BY ALL),
v AS (SELECT b, device_id, domain, median(value) AS view_median FROM r WHERE metric = 'view' GROUP BY ALL),
p AS (SELECT b, device_id, domain, avg(value) AS purchase_mean FROM r WHERE metric = 'purchase' GROUP BY ALL)
SELECT b AS ts, device_id, domain, round(click_median, 9) AS click_median, round(click_mean, 9) AS click_mean,
       round(view_median, 9) AS view_median, round(purchase_mean, 9) AS purchase_mean, CAST(NULL AS DOUBLE) AS unknown
FROM spine LEFT JOIN c USING (b, device_id, domain) LEFT JOIN v USING (b, device_id, domain) LEFT JOIN p USING (b, device_id, domain)"""

_METRICS = ["click", "error", "purchase", "signup", "view"]
_P50 = ", ".join(f"round(median(value) FILTER (metric = '{m}'), 9) AS {m}_p50" for m in _METRICS)
_AVG = ", ".join(f"round(avg(value) FILTER (metric = '{m}'), 9) AS {m}_avg" for m in _METRICS)
_ALL = ", ".join(f"round(median(value) FILTER (metric = '{m}'), 9) AS \"{m}\"" for m in _METRICS)
SQL["agg_daily"] = f"""
SELECT {bucket('1 day')} AS ts, device_id, domain, {_P50}, {_AVG}
FROM (SELECT * REPLACE (CASE WHEN quality_flag <> 1 THEN value END AS value) FROM ({OBSERVED})) GROUP BY ALL"""
SQL["agg_global_median"] = f"""
SELECT CAST(date_trunc('year', ts) AS TIMESTAMP) AS ts, 'all' AS device_id, domain, {_ALL}
FROM (SELECT * EXCLUDE device_id FROM ({OBSERVED})) GROUP BY ALL"""


def by_domain(metric: str, bio: str, environment: str) -> str:
    pick = lambda f, d: f"{f}(value) FILTER (metric = '{metric}' AND domain = '{d}')"
    return f"round(coalesce({pick(bio, 'bio_signal')}, {pick(environment, 'environment')}), 9) AS \"{metric}\""


SQL["agg_by_domain"] = f"""
SELECT {bucket('1 day')} AS ts, device_id, domain, {', '.join(by_domain(m, 'median', 'avg') for m in _METRICS)}
FROM ({OBSERVED}) GROUP BY ALL"""
SQL["agg_by_domain_found"] = f"""
SELECT {bucket('6 hours')} AS ts, device_id, domain, round(median(value) FILTER (metric = 'error'), 9) AS error,
       round(median(value) FILTER (metric = 'purchase'), 9) AS purchase
FROM ({OBSERVED}) WHERE domain = 'environment' GROUP BY ALL"""
AGG_60S = f"""
SELECT {bucket('60 seconds', '"Time"')} AS "Time", device_id, sensor, round(avg(value), 2) AS value FROM ({RAW}) GROUP BY ALL"""
SQL["agg_raw_60s"] = AGG_60S
SQL["agg_raw_10s_median"] = f"""
SELECT {bucket('10 seconds', '"Time"')} AS "Time", device_id, sensor, round(median(value), 2) AS value FROM ({RAW}) GROUP BY ALL"""
SQL["rollup_levels"] = " UNION ALL ".join(
    f"""
SELECT '{level}' AS level, {at} AS ts, device_id, metric, count(value) AS n, round(avg(value), 6) AS mean, min(value) AS low, max(value) AS high
FROM ({READINGS}) WHERE ts IS NOT NULL GROUP BY ALL"""
    for level, at in {"60s": bucket("60 seconds", "ts"), "1h": bucket("1 hour", "ts"), "1d": bucket("1 day", "ts"), "1mo": "CAST(date_trunc('month', ts) AS TIMESTAMP)"}.items()
)
SQL["first_last_time"] = f"SELECT device_id, min(ts) AS first_ts, max(ts) AS last_ts FROM ({READINGS}) GROUP BY device_id"
SQL["days_present"] = "SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events"
SQL["null_count"] = f"""
SELECT metric, count(*) FILTER (value IS NULL) AS value_nulls, count(*) FILTER (ts IS NULL) AS ts_nulls
FROM ({OBSERVED}) GROUP BY metric"""

# --- sinks and incremental loads

HELD = f"SELECT * FROM ({READINGS}) WHERE ts < TIMESTAMP '2024-01-20'"
BATCH = f"""
SELECT * REPLACE (value + 1000 AS value) FROM ({READINGS}) WHERE ts >= TIMESTAMP '2024-01-15 06:00:00' AND metric <> 'view'"""
SQL["append"] = f"({HELD}) UNION ALL ({BATCH})"
REPLACED = f"""
WITH held AS ({HELD}), batch AS ({BATCH}), span AS (SELECT min(ts) AS lo, max(ts) AS hi FROM batch)
SELECT * FROM held WHERE NOT ts BETWEEN (SELECT lo FROM span) AND (SELECT hi FROM span)
UNION ALL SELECT * FROM batch"""
SQL["replace_range"] = REPLACED
SQL["replace_given_range"] = f"""
SELECT * FROM ({HELD}) WHERE NOT ts BETWEEN TIMESTAMP '2024-01-12 00:00:00' AND TIMESTAMP '2024-01-18 23:59:59'
UNION ALL ({BATCH})"""
SQL["replace_range_scoped"] = f"""
WITH held AS ({HELD}), batch AS (SELECT * FROM ({BATCH}) WHERE metric = 'click'),
span AS (SELECT device_id, metric, min(ts) AS lo, max(ts) AS hi FROM batch GROUP BY ALL)
SELECT held.* FROM held LEFT JOIN span USING (device_id, metric) WHERE coalesce(NOT ts BETWEEN lo AND hi, TRUE)
UNION ALL SELECT * FROM batch"""
SQL["evolve_columns"] = f"""
SELECT event_id, ts, device_id, metric, value, CAST(NULL AS VARCHAR) AS unit FROM ({HELD})
UNION ALL SELECT event_id, ts, device_id, NULL, value, 'mV' FROM ({BATCH})"""
SQL["replace_null_times"] = f"""
WITH held AS (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN ts END AS ts, device_id, metric, value FROM ({HELD})),
batch AS (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN ts END AS ts, device_id, metric, value FROM ({BATCH})),
span AS (SELECT min(ts) AS lo, max(ts) AS hi FROM batch)
SELECT * FROM held WHERE coalesce(NOT ts BETWEEN (SELECT lo FROM span) AND (SELECT hi FROM span), TRUE)
UNION ALL SELECT * FROM batch"""
SQL["sink_type_widened"] = f"""
SELECT event_id, ts, floor(value) AS value FROM ({HELD}) UNION ALL SELECT event_id, ts, round(value, 2) FROM ({BATCH})"""
SQL["table_replace"] = REPLACED
SQL["table_replace_all"] = BATCH
SQL["table_append"] = SQL["append"]
SQL["partitioned_dataset"] = f"""
SELECT ts, device_id, metric, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-05' THEN value * 2 ELSE value END AS value, unit, quality_flag,
       domain, CAST(CAST(ts AS DATE) AS VARCHAR) AS day
FROM ({OBSERVED}) WHERE domain = 'bio_signal' AND ts < TIMESTAMP '2024-01-11'"""
SQL["column_mapping"] = f"SELECT event_id, ts AS time, device_id AS node, metric AS sensor, value AS reading FROM ({READINGS})"
SQL["value_type_infer"] = f"""
WITH w AS (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM ({SHIPMENTS}))
SELECT sensor, CASE WHEN max(abs(value - trunc(value))) < 1e-9 THEN 'int' ELSE 'numeric' END AS value_type
FROM w UNPIVOT INCLUDE NULLS (value FOR sensor IN (l_quantity, l_extendedprice, l_discount, l_tax)) GROUP BY sensor"""
SQL["value_cast"] = "SELECT event_id, round(value, 1) AS value FROM events"
SQL["load_after_hwm"] = f"SELECT * FROM ({READINGS}) WHERE ts > (SELECT max(ts) FROM ({HELD}))"
SQL["load_missing_days"] = f"""
WITH r AS (
  SELECT event_id, ts, CASE WHEN metric = 'click' THEN device_id || '.csv'
                            ELSE 'lab_' || device_id || '_' || strftime(ts, '%Y-%m-%d') || '.csv' END AS source_file,
         CASE WHEN metric <> 'click' THEN CAST(ts AS DATE) END AS named
  FROM ({READINGS})),
d AS (SELECT *, coalesce(named, CAST(min(ts) OVER (PARTITION BY source_file) AS DATE)) AS day FROM r),
present AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE day(ts) % 3 <> 0)
SELECT event_id, ts, source_file FROM d ANTI JOIN present USING (day)"""
SQL["source_report"] = f"""
SELECT device_id, count(*) AS rows_before, count(*) FILTER (value > 400) AS rows_after, count(*) FILTER (value > 400) = 0 AS failed
FROM ({READINGS}) GROUP BY device_id"""
SQL["csv_text"] = f"""
SELECT {iso('ts')} AS ts, device_id, metric,
       coalesce(CASE WHEN metric = 'click' THEN format('{{:.1f}}', round(value, 1)) ELSE format('{{:.3f}}', value) END, 'NaN') AS value,
       unit, domain, quality_flag
FROM ({OBSERVED})"""
SQL["csv_text_wide"] = f"""
SELECT {iso('"Time"')} AS "Time", l_orderkey, l_linenumber, l_partkey, format('{{:.1f}}', l_quantity) AS l_quantity,
       format('{{:.1f}}', round(l_extendedprice, 1)) AS l_extendedprice, format('{{:.1f}}', round(l_discount, 1)) AS l_discount,
       coalesce(format('{{:.3f}}', nullif(l_tax, 0)), 'NaN') AS l_tax
FROM ({SHIPMENTS})"""

# --- streams

SQL["ingest_available_now"] = SQL["kv_files_read"]
SQL["stream_agg_60s"] = AGG_60S
SQL["stream_late_files"] = AGG_60S

# --- enriched series, joined views, corrections

SQL["enriched_rolling"] = f"""
WITH w AS (
  SELECT event_id, ts, value, lag(ts) OVER o AS prev_ts, lag(value) OVER o AS prev,
         count(value) OVER r AS count, round(avg(value) OVER r, 6) AS mean, min(value) OVER r AS min, max(value) OVER r AS max
  FROM ({READINGS})
  WINDOW o AS (PARTITION BY device_id, metric ORDER BY ts, event_id),
         r AS (PARTITION BY device_id, metric ORDER BY ts RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW)),
d AS (SELECT *, (epoch_us(ts) - epoch_us(prev_ts)) / 1000000.0::DOUBLE AS passed FROM w),
e AS (SELECT *, CASE WHEN passed > 0 AND passed <= 21600 THEN (value - prev) / passed END AS rate FROM d)
SELECT event_id, count, mean, min, max, round(rate, 9) AS rate, abs(rate) > 0.01 AS event FROM e"""
SQL["event_segments"] = f"""
WITH r AS (SELECT * FROM ({READINGS}) WHERE value IS NOT NULL),
s AS (
  SELECT *, coalesce(last_value(CASE WHEN value >= 80 THEN 1 WHEN value < 30 THEN 0 END IGNORE NULLS) OVER w, 0) AS state
  FROM r WINDOW w AS (PARTITION BY device_id, metric ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
b AS (SELECT *, coalesce(lag(state) OVER w, 0) AS was FROM s WINDOW w AS (PARTITION BY device_id, metric ORDER BY ts, event_id)),
n AS (
  SELECT *, sum(CASE WHEN state = 1 AND was = 0 THEN 1 ELSE 0 END) OVER w AS event
  FROM b WINDOW w AS (PARTITION BY device_id, metric ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT device_id, metric, min(ts) FILTER (state = 1) AS start, max(ts) FILTER (state = 1) AS "end", count(*) FILTER (state = 1) AS readings,
       max(value) FILTER (state = 1) AS peak, round(avg(value) FILTER (state = 1), 6) AS mean, bool_or(state = 0) AS closed
FROM n WHERE event > 0 AND (state = 1 OR was = 1) GROUP BY device_id, metric, event
HAVING epoch_us(max(ts) FILTER (state = 1)) - epoch_us(min(ts) FILTER (state = 1)) >= 10800000000"""
SQL["view_bio_env"] = f"""
WITH r AS ({READINGS}),
l AS (SELECT event_id AS click_id, device_id, ts, value FROM r WHERE metric = 'click'),
e AS (SELECT device_id, ts AS error_ts, value AS error FROM r WHERE metric = 'error'),
p AS (SELECT device_id, ts AS purchase_ts, value AS purchase FROM r WHERE metric = 'purchase'),
a AS (SELECT l.*, e.error_ts, e.error FROM l ASOF LEFT JOIN e ON l.device_id = e.device_id AND l.ts >= e.error_ts)
SELECT a.*, p.purchase_ts, p.purchase FROM a ASOF LEFT JOIN p ON a.device_id = p.device_id AND a.ts >= p.purchase_ts"""
SQL["corrected_overlay"] = f"""
WITH r AS ({READINGS}),
c AS (
  SELECT device_id, metric, ts, CASE WHEN event_id % 150 <> 0 THEN value * 2 END AS fixed FROM r WHERE event_id % 50 = 0
  QUALIFY row_number() OVER (PARTITION BY device_id, metric, ts ORDER BY event_id DESC) = 1)
SELECT event_id, r.ts, r.device_id, r.metric, CASE WHEN c.ts IS NOT NULL THEN c.fixed ELSE value END AS value,
       CASE WHEN c.ts IS NOT NULL THEN 6 ELSE 0 END::BIGINT AS quality_flag
FROM r LEFT JOIN c ON r.device_id = c.device_id AND r.metric = c.metric AND r.ts = c.ts"""

# --- the whole chain

_FILLED = """coalesce(last_value({0} IGNORE NULLS) OVER (PARTITION BY device_id, CAST(ts AS DATE) ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                 first_value({0} IGNORE NULLS) OVER (PARTITION BY device_id, CAST(ts AS DATE) ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {0}"""
SQL["legacy_chain"] = f"""
WITH a AS (
  SELECT ts, device_id, CASE WHEN metric = 'click' AND value BETWEEN 5 AND 200 THEN value END AS click,
         CASE WHEN metric = 'error' AND value <= 150 THEN value END AS error
  FROM ({READINGS})),
b AS (SELECT date_trunc('second', ts) AS ts, {_FILLED.format('click')}, {_FILLED.format('error')} FROM a),
c AS (SELECT * FROM b WHERE click IS NOT NULL AND error IS NOT NULL)
SELECT ts AS timestamp, 'click' AS variable, round(CASE WHEN click > 0 THEN sqrt(1.0::DOUBLE / click) ELSE click END, 9) AS value FROM c
UNION ALL SELECT ts, 'error', round(CASE WHEN error > 0 THEN sqrt(1.0::DOUBLE / error) ELSE error END, 9) FROM c"""

_PARSED = f"SELECT {SECOND} AS ts, device_id, metric, round(value, 3) AS value FROM ({READINGS})"
# Every row belongs to both domains, and always lacks some metric of each: flag 1 throughout.
_BIO = f"""
SELECT ts, device_id, 'bio_signal' AS domain, m AS metric, 'mV' AS unit, CAST(1 AS BIGINT) AS quality_flag,
       max(CASE WHEN metric = m AND value BETWEEN 1 AND 200 THEN value END) AS value
FROM ({_PARSED}), (SELECT unnest(['click', 'signup', 'view']) AS m) GROUP BY ALL"""
_ENVIRONMENT = f"""
SELECT ts, device_id, 'environment' AS domain, m AS metric, '' AS unit, CAST(1 AS BIGINT) AS quality_flag,
       max(CASE WHEN value BETWEEN 0 AND 100 AND m = 'error_log' AND metric = 'error' THEN round(ln(value), 3)
                WHEN value BETWEEN 0 AND 100 AND metric = m THEN value END) AS value
FROM ({_PARSED}), (SELECT unnest(['error', 'purchase', 'error_log']) AS m) GROUP BY ALL"""
SQL["end_to_end"] = f"""
WITH bio AS ({SQL['resample_nearest'].replace(OBSERVED, _BIO).replace('30 minutes', '1 hour')}),
env AS ({by_day('2 hours', source=_ENVIRONMENT)})
SELECT {bucket('1 day')} AS ts, device_id, domain, round(median(value) FILTER (metric = 'click'), 6) AS c0,
       round(avg(value) FILTER (metric = 'error_log'), 6) AS c1
FROM (SELECT * FROM bio UNION ALL SELECT * FROM env) GROUP BY ALL"""
