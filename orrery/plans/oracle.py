"""Independent DuckDB SQL for every registered query (the correctness oracle).

Views over the driver tables are rebuilt here in SQL from the same fixed
rules as ``plans/views.py``; the operators themselves are written the plain
SQL way (window functions, ``row_number`` ranks, brute-force step grids),
not as translations of the Spark plans.  Column names equal the Spark ones.
DuckDB notes: ``x // y`` is integer division, ``100.0`` is a DECIMAL literal
(so doubles are spelled ``100::DOUBLE``), and ``CAST(double AS BIGINT)``
rounds, so truncation is ``CAST(trunc(x) AS BIGINT)``.
"""

from __future__ import annotations

SERVICES_SQL = "['frontend','checkout','payment','inventory','shipping']"

SAMPLES = """samples AS (
  SELECT event_id, ts, user_id, event_type, value,
         'event_value{event_type="' || event_type || '",user_id="' || CAST(user_id AS VARCHAR) || '"}' AS series_key
  FROM events)"""

BOUNDS = "bounds AS (SELECT max(ts) AS e, epoch_us(max(ts)) AS e_us FROM events)"

COUNTERS = """counters AS (
  SELECT *, sum(CAST(value AS DECIMAL(18,2))) OVER (
           PARTITION BY series_key ORDER BY ts, event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS counter
  FROM samples)"""

LOGS = f"""log_base AS (
  SELECT event_id, ts, user_id, event_type, value, props,
         CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS severity,
         {SERVICES_SQL}[user_id % 5 + 1] AS service
  FROM events),
log_lines AS (
  SELECT *,
    '{{"timestamp":' || printf('%d.%06d', epoch_us(ts) // 1000000, epoch_us(ts) % 1000000)
    || ',"severity":"' || severity || '","service":"' || service
    || '","event_type":"' || event_type || '","user_id":' || CAST(user_id AS VARCHAR)
    || ',"msg":"event ' || CAST(event_id AS VARCHAR)
    || '","duration_ms":' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)
    || ',"props":' || props || '}}' AS line,
    '/' || service AS container
  FROM log_base),
log_parts AS (
  SELECT *, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso, 'plain text event ' || CAST(event_id AS VARCHAR) AS plain,
         regexp_replace(line, '^\\{{"timestamp":[^,]*', '') AS tail
  FROM log_lines),
log_raw AS (
  SELECT *,
    CASE event_id % 40
      WHEN 7 THEN '{{"timestamp":"' || iso || '"' || tail
      WHEN 11 THEN left(line, -1)
      WHEN 13 THEN line || ' trailing'
      WHEN 17 THEN left(line, -1)
        || ',"ok":true,"big":123456789012345678901234567890,"none":null,"deep":{{"a":[1,2.50,"x"]}}}}'
      WHEN 19 THEN replace(line, '"', chr(39))
      WHEN 23 THEN chr(9) || ' ' || chr(13)
      WHEN 29 THEN '{{"_time":"' || iso || '","timestamp":1' || tail
      WHEN 31 THEN '[1, 2]'
      WHEN 37 THEN chr(9) || '{{"level":"none"}}' || chr(13)
      WHEN 20 THEN chr(9) || plain || chr(13)
      ELSE CASE WHEN event_id % 10 = 0 THEN plain
                WHEN event_id % 3 = 0 THEN iso || ' stdout F ' || line
                ELSE line END END AS raw
  FROM log_parts)"""


def _parsed_sql(candidate: str) -> str:
    """Entries judged by DuckDB's own JSON reader; ``candidate``: what of the
    trimmed line may be an object."""
    return f"""{LOGS},
t AS (SELECT event_id, ts, trim(raw, chr(9) || chr(13) || chr(10) || ' ') AS line FROM log_raw),
c AS (SELECT event_id, ts, line, {candidate} AS cand FROM t WHERE line <> ''),
o AS (SELECT *, TRY_CAST(CASE WHEN json_valid(cand) THEN cand END AS JSON) AS j,
             printf('%d.%06d', epoch_us(ts) // 1000000, epoch_us(ts) % 1000000) AS now FROM c),
p AS (SELECT *, coalesce(json_type(j) = 'OBJECT', false) AS is_json,
             CASE WHEN json_type(j) = 'OBJECT' THEN coalesce(CAST(json_extract(j, '$._time') AS VARCHAR),
                                                            CAST(json_extract(j, '$.timestamp') AS VARCHAR)) END AS own FROM o),
entries AS (
  SELECT event_id, is_json, j, cand, own AS own_time, CASE WHEN NOT is_json THEN line END AS _msg,
         coalesce(own, now) AS _time,
         round(coalesce(TRY_CAST(coalesce(own, now) AS DOUBLE),
                        epoch_us(TRY_CAST(trim(own, '"') AS TIMESTAMP)) / 1000000::DOUBLE), 6) AS event_time,
         CASE WHEN is_json THEN json_extract_string(j, '$.severity') END AS severity,
         (j IS NOT NULL AND NOT is_json) AS rejected
  FROM p)"""


LENIENT = _parsed_sql("CASE WHEN strpos(line, '{') > 0 THEN substr(line, strpos(line, '{')) END")
STRICT = _parsed_sql("line")

EXPO = f"""expo AS (
  SELECT {SERVICES_SQL}[user_id % 5 + 1] AS service, date_trunc('day', ts) AS scrape_ts, event_id AS line_no,
    CASE WHEN event_id % 50 = 0 THEN '# HELP events_' || event_type || '_total events seen'
         WHEN event_id % 50 = 1 THEN ''
         WHEN event_id % 50 = 2 THEN 'events_' || event_type || '_total{{user_id="' || CAST(user_id AS VARCHAR)
              || '",zone="zone ' || CAST(user_id % 3 AS VARCHAR) || '"}} nope'
         ELSE 'events_' || event_type || '_total{{user_id="' || CAST(user_id AS VARCHAR)
              || '",zone="zone ' || CAST(user_id % 3 AS VARCHAR) || '"}} '
              || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS line
  FROM events),
expo_parsed AS (
  SELECT service, scrape_ts, line_no, line,
         split_part(regexp_extract(line, '^\\s*(\\S+)', 1), '{{', 1) AS name,
         TRY_CAST(regexp_extract(line, '(\\S+)\\s*$', 1) AS DOUBLE) AS v
  FROM expo
  WHERE NOT starts_with(line, '#') AND trim(line) <> '' AND regexp_matches(line, '\\S+\\s+\\S+')),
expo_sums AS (
  SELECT service, scrape_ts, name, sum(v) AS value FROM expo_parsed WHERE v IS NOT NULL GROUP BY ALL)"""

SPANS = f"""spans AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS trace_id, l.l_orderkey AS order_key, l.l_linenumber AS line_number,
         {SERVICES_SQL}[l.l_partkey % 5 + 1] AS service, l.l_returnflag AS flag, l.l_linestatus AS status,
         o.o_orderstatus AS batch
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

OBS = """obs AS (
  SELECT event_id, ts, event_type AS service,
         CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 'steady' ELSE 'burst' END AS scenario,
         count(*) OVER w AS ingested,
         CAST(sum(CASE WHEN value > 400 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS dropped,
         value % 100 AS cpu_percent,
         CAST(trunc(value * 1048576::DOUBLE) AS BIGINT) AS memory_bytes
  FROM events
  WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def _rate_sql(where: str, tail: str, increase_col: bool) -> str:
    inc = "CAST(inc AS DOUBLE) AS increase, " if increase_col else ""
    return f"""WITH {SAMPLES}, {BOUNDS},
c AS (SELECT series_key, ts, event_id, sum(CAST(value AS DECIMAL(18,2))) OVER (
        PARTITION BY series_key ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS counter
      FROM samples {where}),
r AS (SELECT c.* FROM c, bounds b WHERE c.ts > b.e - INTERVAL 7 DAY AND c.ts <= b.e),
p AS (SELECT series_key, counter, lag(counter) OVER (PARTITION BY series_key ORDER BY ts, event_id) AS prev FROM r),
a AS (SELECT series_key,
             sum(CASE WHEN prev IS NULL THEN NULL WHEN counter >= prev THEN counter - prev ELSE counter END) AS inc,
             count(*) AS samples
      FROM p GROUP BY series_key)
SELECT series_key, {inc}CAST(inc AS DOUBLE) / 604800::DOUBLE AS rate, samples FROM a WHERE samples >= 2 {tail}"""


def _quantile_sql(source: str, key: str, small_n: str) -> str:
    """Exclusive quantiles by row_number; small-n fallback 'recent' or 'max'."""
    fb = "arg_max(v, ts)" if small_n == "recent" else "max(v)"
    return f"""r AS (SELECT {key} AS k, v, ts,
              row_number() OVER (PARTITION BY {key} ORDER BY v, ts, event_id) AS rk,
              count(*) OVER (PARTITION BY {key}) AS n
       FROM {source}),
g AS (SELECT k, max(n) AS n,
        max(CASE WHEN rk = (n + 1) // 2 THEN v END) AS m_lo,
        max(CASE WHEN rk = (n + 2) // 2 THEN v END) AS m_hi,
        max(CASE WHEN rk = (9 * (n + 1)) // 10 THEN v END) AS a90,
        max(CASE WHEN rk = (9 * (n + 1)) // 10 + 1 THEN v END) AS b90,
        max(9 * (n + 1) - ((9 * (n + 1)) // 10) * 10) AS d90,
        max(CASE WHEN rk = (99 * (n + 1)) // 100 THEN v END) AS a99,
        max(CASE WHEN rk = (99 * (n + 1)) // 100 + 1 THEN v END) AS b99,
        max(99 * (n + 1) - ((99 * (n + 1)) // 100) * 100) AS d99,
        {fb} AS fb
      FROM r GROUP BY k),
q AS (SELECT k, n, (m_lo + m_hi) / 2 AS p50,
        CASE WHEN n >= 10 THEN (a90 * (10 - d90) + b90 * d90) / 10 ELSE fb END AS p90,
        CASE WHEN n >= 100 THEN (a99 * (100 - d99) + b99 * d99) / 100 ELSE fb END AS p99
      FROM g)"""


def _grid_total_sql(source: str, key: str, w_us: int, s_us: int, r_us: int | None = None) -> str:
    """Brute force: every grid step t = e - j*s in [e - range, e]; per key the
    count in (t - w, t] at the last step with a non-zero count; summed."""
    r_us = w_us if r_us is None else r_us
    steps = r_us // s_us
    return f"""recent AS (SELECT {key} AS k, epoch_us(ts) AS u FROM {source}, bounds b
                WHERE epoch_us(ts) > b.e_us - {r_us + w_us} AND epoch_us(ts) <= b.e_us),
grid AS (SELECT b.e_us - j * {s_us} AS t FROM bounds b, range(0, {steps + 1}) r(j)),
cnt AS (SELECT k, t, count(*) AS c FROM recent JOIN grid ON u > t - {w_us} AND u <= t GROUP BY k, t),
last AS (SELECT k, arg_max(c, t) AS c FROM cnt GROUP BY k)
SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS total FROM last"""


def _exp_fmt(col: str) -> str:
    """Byte text with exact half-even rounding at 2 decimals."""
    unit = (f"CASE WHEN {col} < 1024 THEN 0 WHEN {col} < 1048576 THEN 1 WHEN {col} < 1073741824 THEN 2 "
            f"WHEN {col} < 1099511627776 THEN 3 WHEN {col} < 1125899906842624 THEN 4 ELSE 5 END")
    return f"""(SELECT CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') || ' '
          || ['B','KB','MB','GB','TB','PB'][u + 1]
   FROM (SELECT u, q + CASE WHEN 2 * rm > d OR (2 * rm = d AND q % 2 = 1) THEN 1 ELSE 0 END AS cents
         FROM (SELECT u, d, (CAST({col} AS HUGEINT) * 100) // d AS q, (CAST({col} AS HUGEINT) * 100) % d AS rm
               FROM (SELECT u, CAST(pow(1024, u) AS HUGEINT) AS d FROM (SELECT {unit} AS u)))))"""


STORAGE = """storage AS (
  SELECT event_type AS service,
         CASE WHEN event_type = 'error' THEN count(*) * 37 + 11 ELSE count(*) * 1000 END AS storage_bytes
  FROM events GROUP BY event_type)"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    # ------------------------------------------------------------ series
    q["topk_latest"] = f"""WITH {SAMPLES}, {BOUNDS},
r AS (SELECT s.* FROM samples s, bounds b WHERE s.event_type = 'click' AND s.ts > b.e - INTERVAL 7 DAY AND s.ts <= b.e)
SELECT series_key, arg_max(value, ts) AS value FROM r GROUP BY series_key ORDER BY value DESC, series_key LIMIT 10"""

    q["topk_rate"] = _rate_sql("WHERE event_type = 'purchase'", "ORDER BY rate DESC, series_key LIMIT 10", False)
    q["rate_per_series"] = _rate_sql("", "", True)

    q["count_over_time_tumbling"] = f"""WITH {SAMPLES}, t AS (SELECT series_key, epoch_us(ts) AS us FROM samples)
SELECT series_key, make_timestamp(us + ((-us) % 86400000000 + 86400000000) % 86400000000) AS window_end,
       count(*) AS n
FROM t GROUP BY ALL"""

    q["count_over_time_sliding"] = f"""WITH {SAMPLES}, grid AS (
  SELECT DISTINCT series_key, (epoch_us(ts) // 21600000000) * 21600000000 + j * 21600000000 AS t
  FROM samples, range(0, 5) r(j))
SELECT g.series_key, make_timestamp(g.t) AS window_end, count(*) AS n
FROM grid g JOIN samples s ON s.series_key = g.series_key
  AND epoch_us(s.ts) > g.t - 86400000000 AND epoch_us(s.ts) <= g.t
GROUP BY ALL"""

    q["count_over_time_last_step_total"] = f"""WITH {SAMPLES}, {BOUNDS},
{_grid_total_sql('samples', 'series_key', 2 * 86400 * 10**6, 3600 * 10**6)}"""

    q["count_over_time_plain_total"] = f"""WITH {SAMPLES}, {BOUNDS}
SELECT count(*) AS total FROM samples, bounds b WHERE ts > b.e - INTERVAL 2 DAY AND ts <= b.e"""

    q["series_cardinality"] = f"""WITH {SAMPLES}
SELECT event_type, count(DISTINCT series_key) AS series FROM samples GROUP BY event_type"""

    q["series_churn"] = f"""WITH {SAMPLES},
a AS (SELECT DISTINCT series_key, epoch_us(ts) // 86400000000 AS i FROM samples),
n AS (SELECT i, count(*) AS active FROM a GROUP BY i),
ap AS (SELECT a.i, count(*) AS appeared FROM a
       WHERE NOT EXISTS (SELECT 1 FROM a p WHERE p.series_key = a.series_key AND p.i = a.i - 1) GROUP BY a.i),
gone AS (SELECT a.i + 1 AS i, count(*) AS disappeared FROM a
         WHERE NOT EXISTS (SELECT 1 FROM a x WHERE x.series_key = a.series_key AND x.i = a.i + 1) GROUP BY a.i + 1),
ids AS (SELECT i FROM n UNION SELECT i FROM ap UNION SELECT i FROM gone)
SELECT make_timestamp(ids.i * 86400000000) AS interval_start, coalesce(active, 0) AS active,
       coalesce(appeared, 0) AS appeared, coalesce(disappeared, 0) AS disappeared
FROM ids LEFT JOIN n USING (i) LEFT JOIN ap USING (i) LEFT JOIN gone USING (i)"""

    q["histogram_buckets"] = f"""WITH {SAMPLES},
b AS (SELECT CAST(le AS DOUBLE) AS le FROM (VALUES (10), (50), (100), (250), (500)) v(le))
SELECT s.series_key, b.le, CAST(sum(CASE WHEN s.value <= b.le THEN 1 ELSE 0 END) AS BIGINT) AS cum_count
FROM samples s, b GROUP BY ALL"""

    q["histogram_quantiles"] = """WITH bounds AS (
  SELECT * FROM (VALUES (0, 10.0::DOUBLE), (0, 50), (0, 100), (0, 250), (0, 500), (0, 'Infinity'::DOUBLE),
                        (1, 25), (1, 100), (1, 300), (1, 'Infinity'::DOUBLE)) v(p, le)),
own AS (SELECT event_type, p, le, CAST(count(*) FILTER (value <= le) AS DOUBLE) AS c
        FROM events JOIN bounds ON p = user_id % 2 GROUP BY ALL),
le AS (SELECT DISTINCT event_type, le FROM own),
near AS (SELECT le.event_type, le.le, o.p, max(o.le) FILTER (o.le <= le.le) AS lo, coalesce(arg_max(o.c, o.le) FILTER (o.le <= le.le), 0) AS lo_c,
                min(o.le) FILTER (o.le > le.le) AS hi, arg_min(o.c, o.le) FILTER (o.le > le.le) AS hi_c
         FROM le JOIN own o USING (event_type) GROUP BY ALL),
held AS (SELECT event_type, le, sum(CASE WHEN hi IS NULL OR isinf(hi) THEN lo_c
             ELSE lo_c + (hi_c - lo_c) * (le - coalesce(lo, 0)) / (hi - coalesce(lo, 0)) END) AS c FROM near GROUP BY ALL),
b AS (SELECT *, coalesce(lag(le) OVER w, 0) AS low, coalesce(lag(c) OVER w, 0) AS under, max(c) OVER (PARTITION BY event_type) AS total
      FROM held WINDOW w AS (PARTITION BY event_type ORDER BY le)),
hit AS (SELECT event_type, total, f, arg_min(CASE WHEN isinf(le) THEN low ELSE low + (le - low) * (f * total - under) / (c - under) END, le) AS v
        FROM b, (VALUES (0.5), (0.9)) q(f) WHERE c >= f * total AND c > 0 GROUP BY ALL)
SELECT event_type, CAST(total AS BIGINT) AS n, round(max(v) FILTER (f = 0.5), 6) AS p50, round(max(v) FILTER (f = 0.9), 6) AS p90
FROM hit GROUP BY ALL"""
    # logarithmic buckets with a relative error of 0.01: gamma = 1.01 / 0.99
    q["quantiles_merged"] = """WITH s AS (
  SELECT event_type, CAST(ceil(ln(value) / ln(1.01::DOUBLE / 0.99::DOUBLE)) AS INTEGER) AS b, count(*) AS k
  FROM events WHERE strftime(ts, '%Y-%m-%d') BETWEEN '2024-01-05' AND '2024-01-20' GROUP BY ALL),
r AS (SELECT event_type, pow(1.01::DOUBLE / 0.99::DOUBLE, b) * 2 / (1 + 1.01::DOUBLE / 0.99::DOUBLE) AS v, k,
             sum(k) OVER (PARTITION BY event_type ORDER BY b) AS upto, sum(k) OVER (PARTITION BY event_type) AS n FROM s),
f AS (SELECT * FROM (VALUES ('p50', 1, 2), ('p90', 9, 10), ('p99', 99, 100)) f(name, i, m)),
q AS (SELECT event_type, n, name, i, m, i * (n + 1) // m AS j, i * (n + 1) % m AS d FROM (SELECT DISTINCT event_type, n FROM r), f),
e AS (SELECT q.event_type, q.n, name,
             (max(v) FILTER (upto >= greatest(1, least(j, q.n)) AND upto - k < greatest(1, least(j, q.n))) * (m - d)
              + max(v) FILTER (upto >= greatest(1, least(j + 1, q.n)) AND upto - k < greatest(1, least(j + 1, q.n))) * d) / m AS x
      FROM q JOIN r USING (event_type) GROUP BY q.event_type, q.n, name, j, d, m)
SELECT event_type, CAST(n AS BIGINT) AS n, round(max(x) FILTER (name = 'p50'), 6) AS p50, round(max(x) FILTER (name = 'p90'), 6) AS p90,
       round(max(x) FILTER (name = 'p99'), 6) AS p99 FROM e GROUP BY ALL"""
    q["cardinality_merged"] = """WITH p AS (
  SELECT user_id, unnest(['month ' || strftime(ts, '%Y-%m'), 'week ' || CAST(weekofyear(ts) AS VARCHAR),
                          'third ' || strftime(ts, '%Y-%m') || ' ' || CAST((day(ts) - 1) // 10 AS VARCHAR)]) AS period FROM events)
SELECT period, count(DISTINCT user_id) AS users, true AS within_bound FROM p GROUP BY 1"""

    q["label_cardinality"] = """WITH k AS (
  SELECT 'base' AS mode,
         'test_metric{benchmark_app="events",instance="instance-' || CAST(event_id % 100 AS VARCHAR)
         || '",job="test-job-' || CAST(event_id % 10 AS VARCHAR) || '"}' AS series_key FROM events
  UNION ALL
  SELECT 'high_cardinality',
         'test_metric{benchmark_app="events",customer="customer-' || CAST(event_id % 100 AS VARCHAR)
         || '",env="' || ['prod','staging','dev'][event_id % 3 + 1]
         || '",host="host-' || CAST(event_id % 1000 AS VARCHAR)
         || '",instance="instance-' || CAST(event_id % 100 AS VARCHAR)
         || '",job="test-job-' || CAST(event_id % 10 AS VARCHAR)
         || '",pod="pod-' || CAST(event_id % 5000 AS VARCHAR)
         || '",region="region-' || CAST(event_id % 10 AS VARCHAR)
         || '",team="team-' || CAST(event_id % 50 AS VARCHAR)
         || '",version="v' || CAST(event_id % 20 AS VARCHAR) || '"}' FROM events)
SELECT mode, count(DISTINCT series_key) AS series FROM k GROUP BY mode"""

    # -------------------------------------------------------------- logs
    q["log_error_lines"] = f"""WITH {LOGS}
SELECT event_id, ts, line FROM log_lines
WHERE regexp_extract(container, '^/(.*)$', 1) = 'payment'
  AND json_extract_string(line, '$.service') = 'payment'
  AND json_extract_string(line, '$.event_type') = 'error'
  AND contains(line, 'ERROR')"""

    q["log_latest_lines"] = f"""WITH {LOGS}
SELECT event_id, ts, line FROM log_lines
WHERE service = 'checkout' AND json_extract_string(line, '$.severity') = 'ERROR'
ORDER BY ts DESC, event_id LIMIT 100"""

    q["log_window_count"] = f"""WITH {LOGS}, {BOUNDS}
SELECT count(*) AS n FROM log_lines, bounds b
WHERE ts >= b.e - INTERVAL 7 DAY AND ts <= b.e AND json_extract_string(line, '$.severity') = 'ERROR'"""

    columns = "event_id, is_json, _msg, _time, event_time, severity"
    q["log_parse_lenient"] = f"WITH {LENIENT}\nSELECT {columns} FROM entries"
    q["log_parse_strict"] = f"WITH {STRICT}\nSELECT {columns} FROM entries WHERE NOT rejected"
    q["log_entry_payload"] = f"""WITH {LENIENT}
SELECT event_id,
       CASE WHEN NOT is_json THEN '{{"_msg":' || CAST(to_json(_msg) AS VARCHAR) || ',"_time":' || _time || '}}'
            WHEN json_exists(j, '$._time') THEN cand
            ELSE '{{"_time":' || _time || ',' || substr(cand, 2) END AS payload
FROM entries"""

    q["log_stream_counts"] = f"""WITH {LOGS}, t AS (SELECT container, epoch_us(ts) AS us FROM log_lines)
SELECT container AS stream_key,
       make_timestamp(us + ((-us) % 86400000000 + 86400000000) % 86400000000) AS window_end, count(*) AS n
FROM t GROUP BY ALL"""

    q["log_range_count_total"] = f"""WITH {LOGS}, {BOUNDS},
sel AS (SELECT service AS stream, ts FROM log_lines WHERE json_extract_string(line, '$.severity') = 'ERROR'),
{_grid_total_sql('sel', 'stream', 86400 * 10**6, 3600 * 10**6, 6 * 3600 * 10**6)}"""

    # -------------------------------------------------------- exposition
    q["exposition_sum"] = f"""WITH {EXPO}
SELECT service, scrape_ts, name, round(value, 6) AS value FROM expo_sums"""

    q["exposition_labelled"] = ("WITH " + EXPO + """
SELECT service, scrape_ts, regexp_extract(line, '^([^{]*[{][^}]*[}])', 1) AS series_key,
       round(sum(v), 6) AS value
FROM expo_parsed WHERE v IS NOT NULL AND contains(line, '{') GROUP BY ALL""")

    q["exposition_selected"] = f"""WITH {EXPO},
t AS (SELECT service, scrape_ts, line, TRY_CAST(regexp_extract(line, '(\\S+)\\s*$', 1) AS DOUBLE) AS v,
             (trim(line) <> '' AND NOT starts_with(line, '#') AND regexp_matches(line, '\\S+\\s+\\S+')) AS body
      FROM expo),
f AS (SELECT *, body AND contains(line, 'events_click_total') AND contains(line, 'zone 1') AS is_in FROM t)
SELECT service, scrape_ts,
  CAST(trunc(round(coalesce(sum(CASE WHEN is_in THEN v END), 0), 6)) AS BIGINT) AS ingested,
  CAST(trunc(round(coalesce(sum(CASE WHEN NOT is_in AND body AND contains(line, 'events_error_total')
                                   AND contains(line, 'zone 2') THEN v END), 0), 6)) AS BIGINT) AS dropped
FROM f GROUP BY service, scrape_ts"""

    q["exposition_first"] = f"""WITH {EXPO}
SELECT service, scrape_ts,
       arg_min(coalesce(TRY_CAST(regexp_extract(line, '(\\S+)\\s*$', 1) AS DOUBLE), 0), line_no) AS value
FROM expo WHERE contains(line, 'zone="zone 2"') GROUP BY service, scrape_ts"""

    q["exposition_last"] = f"""WITH {EXPO}
SELECT service, scrape_ts, arg_max(v, line_no) AS value FROM (
  SELECT service, scrape_ts, line_no, TRY_CAST(regexp_extract(line, '(\\S+)\\s*$', 1) AS DOUBLE) AS v
  FROM expo WHERE contains(line, 'zone="zone 2"')) WHERE v IS NOT NULL GROUP BY service, scrape_ts"""

    q["exposition_active_series"] = f"""WITH {EXPO}
SELECT service, scrape_ts, CAST(count_if(starts_with(line, 'events_') AND contains(line, '{{')) AS BIGINT) AS series
FROM expo GROUP BY service, scrape_ts"""

    q["exposition_named"] = f"""WITH {EXPO}
SELECT service, scrape_ts,
  round(coalesce(max(CASE WHEN name = 'events_click_total' THEN value END), 0), 6) AS events_click_total,
  round(coalesce(max(CASE WHEN name = 'events_view_total' THEN value END), 0), 6) AS events_view_total,
  round(coalesce(max(CASE WHEN name = 'events_missing_total' THEN value END), 0), 6) AS events_missing_total
FROM expo_sums GROUP BY service, scrape_ts"""

    q["exposition_drop_prefix_sum"] = f"""WITH {EXPO}
SELECT service, scrape_ts,
  round(coalesce(sum(CASE WHEN starts_with(name, 'events_error') THEN value END), 0)
        + coalesce(sum(CASE WHEN name = 'events_signup_total' THEN value END), 0), 6) AS drops
FROM expo_sums GROUP BY service, scrape_ts"""

    # ------------------------------------------------------------ traces
    counts = """SELECT count(DISTINCT nullif(trace_id, '')) AS traces, count(*) AS spans,
       CASE WHEN count(DISTINCT nullif(trace_id, '')) > 0
            THEN count(*) / count(DISTINCT nullif(trace_id, '')) ELSE 0::DOUBLE END AS spans_per_trace
FROM spans WHERE trace_id IN (SELECT trace_id FROM spans WHERE {pred})"""
    q["trace_span_counts"] = f"WITH {SPANS}\n" + counts.format(pred="flag = 'R' AND status = 'F'")
    q["trace_service_tag_search"] = f"WITH {SPANS}\n" + counts.format(pred="service = 'payment' AND flag = 'A'")
    q["trace_field_search"] = f"WITH {SPANS}\n" + counts.format(pred="batch = 'P'")

    q["reconcile_expected_found"] = f"""WITH {SPANS},
e AS (SELECT o_orderstatus AS batch, count(*) AS expected FROM orders GROUP BY 1),
f AS (SELECT batch, count(DISTINCT nullif(trace_id, '')) AS found FROM spans GROUP BY 1)
SELECT batch, coalesce(expected, 0) AS expected, coalesce(found, 0) AS found,
       coalesce(expected, 0) = coalesce(found, 0) AS complete,
       CAST(coalesce(found, 0) AS VARCHAR) || '/' || CAST(coalesce(expected, 0) AS VARCHAR) AS found_of_expected
FROM e FULL JOIN f USING (batch)"""

    q["reconcile_lost_ids"] = """WITH e AS (SELECT DISTINCT o_orderstatus AS batch, o_orderkey AS trace FROM orders),
f AS (SELECT DISTINCT batch, trace + CASE WHEN trace % 211 = 0 THEN 1000000000000 ELSE 0 END AS trace
      FROM e WHERE trace IN (SELECT l_orderkey FROM lineitem))
SELECT batch, trace, 'missing' AS side FROM (SELECT * FROM e EXCEPT SELECT * FROM f)
UNION ALL SELECT batch, trace, 'surplus' FROM (SELECT * FROM f EXCEPT SELECT * FROM e)"""

    q["backend_ratio"] = f"""WITH {SPANS},
p AS (SELECT flag, count(DISTINCT nullif(trace_id, '')) AS t, count(*) AS s FROM spans GROUP BY flag),
r AS (SELECT flag, count(DISTINCT nullif(trace_id, '')) AS t, count(*) AS s FROM spans WHERE line_number <= 4
      GROUP BY flag)
SELECT flag, CASE WHEN p.t > 0 AND r.t > 0 THEN r.t / p.t END AS trace_ratio,
       CASE WHEN p.s > 0 AND r.s > 0 THEN r.s / p.s END AS span_ratio
FROM p FULL JOIN r USING (flag)"""

    q["trace_keep_matches_else_all"] = f"""WITH {SPANS},
m AS (SELECT service, count_if(flag = 'R' AND service = 'payment') AS nm FROM spans GROUP BY service)
SELECT s.service, count(*) AS spans FROM spans s JOIN m USING (service)
WHERE (s.flag = 'R' AND s.service = 'payment') OR m.nm = 0 GROUP BY s.service"""

    q["trace_process_exists"] = f"""WITH {SPANS}
SELECT count(DISTINCT a.trace_id) AS traces FROM spans a JOIN spans b
  ON a.trace_id = b.trace_id AND a.service = b.service
 AND a.line_number = 1 AND a.flag = 'N' AND b.line_number = 2 AND b.status = 'O'"""

    responses = """WITH n AS (SELECT l_orderkey, count(*) AS c FROM lineitem GROUP BY 1),
t AS (SELECT o_orderkey // 2000 AS response, o_orderkey, o_orderstatus AS status,
             CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE coalesce(c, 0) END AS listed,
             o_orderstatus = 'F' AND (o_orderkey // 2000) % 3 <> 0 AS joint
      FROM orders LEFT JOIN n ON o_orderkey = l_orderkey)"""
    q["trace_response_counts"] = responses + """
SELECT response, count(DISTINCT o_orderkey) AS traces,
       CAST(sum(CASE WHEN response % 2 = 0 OR listed > 0 THEN listed WHEN status = 'F' THEN 3 ELSE 1 END) AS BIGINT) AS spans
FROM t GROUP BY 1"""
    q["trace_response_labelled"] = responses + """
SELECT response, count(*) AS traces, CAST(sum(listed) AS BIGINT) AS spans
FROM (SELECT *, bool_or(joint) OVER (PARTITION BY response) AS found FROM t) WHERE joint OR NOT found GROUP BY 1"""
    q["trace_response_tags"] = responses + """
SELECT response, key, CASE key WHEN 'benchmark_app' THEN 'orders' ELSE 'r1' END AS value, count(*) AS tags
FROM t, (VALUES ('benchmark_app'), ('benchmark_run_id')) k(key) GROUP BY ALL"""

    q["search_result_counts"] = """WITH n AS (SELECT l_orderkey, count(*) AS c FROM lineitem GROUP BY 1)
SELECT o_orderstatus AS status, count(DISTINCT nullif(CAST(o_orderkey AS VARCHAR), '')) AS traces,
       CAST(sum(CASE WHEN coalesce(c, 0) > 0 THEN c WHEN o_orderstatus = 'F' THEN 3 ELSE 1 END) AS BIGINT) AS spans
FROM orders LEFT JOIN n ON o_orderkey = l_orderkey GROUP BY 1"""

    # ------------------------------------------------------------ report
    lat_ok = """l AS (SELECT 'q' || CAST(user_id AS VARCHAR) AS query_key, event_type, ts, event_id, value AS v,
                  event_type <> 'error' AS success FROM events)"""
    q["latency_percentiles_recent"] = f"""WITH {lat_ok}, ok AS (SELECT * FROM l WHERE success),
{_quantile_sql('ok', 'query_key', 'recent')}
SELECT k AS query_key, n, p50, p90, p99 FROM q"""

    q["latency_percentiles_by_type"] = f"""WITH {lat_ok}, ok AS (SELECT * FROM l WHERE success),
{_quantile_sql('ok', 'event_type', 'recent')}
SELECT k AS query_key, n, p50, p90, p99 FROM q"""

    q["latency_summary_stats"] = f"""WITH {lat_ok},
{_quantile_sql('l', 'event_type', 'max')},
s AS (SELECT event_type AS k, round(sum(v) / count(*), 6) AS mean, min(v) AS min, max(v) AS max FROM l GROUP BY 1)
SELECT q.k AS event_type, n, p50, p90, p99, mean, min, max FROM q JOIN s USING (k)"""

    q["errors_per_query"] = f"""WITH {lat_ok}, ok AS (SELECT * FROM l WHERE success),
{_quantile_sql('ok', 'query_key', 'recent')},
e AS (SELECT query_key AS k, CAST(count_if(NOT coalesce(success, false)) AS BIGINT) AS errors FROM l GROUP BY 1)
SELECT q.k AS query_key, n, p50, p90, p99, coalesce(errors, 0) AS errors FROM q LEFT JOIN e USING (k)"""

    q["peak_ingest"] = """SELECT event_type AS service, count(*) AS total_ingested, CAST(count_if(value > 400) AS BIGINT) AS total_dropped,
  CASE WHEN contains(event_type, 'click') OR contains(event_type, 'view') THEN 'Samples'
       WHEN contains(event_type, 'signup') OR contains(event_type, 'purchase') THEN 'Lines'
       WHEN contains(event_type, 'error') THEN 'Spans' END AS type
FROM events GROUP BY event_type"""

    q["trace_drop_rate"] = """WITH
q AS (SELECT 'backend-' || CAST(user_id % 3 AS VARCHAR) AS backend,
             max(CAST(trunc(value) AS BIGINT)) AS qt,
             max(CASE WHEN user_id % 3 = 2 THEN 0 ELSE CAST(trunc(value * 3) AS BIGINT) END) AS qs
      FROM events WHERE value > 5 GROUP BY 1),
i AS (SELECT 'backend-' || CAST(user_id % 3 AS VARCHAR) AS backend,
             max(nullif(CAST(trunc(value * 10) AS BIGINT), 0)) AS isp,
             max(nullif(CASE WHEN value > 400 THEN CAST(trunc(value / 10) AS BIGINT) ELSE 0 END, 0)) AS idr
      FROM events GROUP BY 1),
j AS (SELECT backend, coalesce(qt, 0) AS qt, coalesce(qs, 0) AS qs, isp, idr FROM q FULL JOIN i USING (backend)),
k AS (SELECT backend, qt AS traces,
             CASE WHEN (qt = 0 OR qs = 0) AND isp IS NOT NULL THEN isp ELSE qs END AS spans,
             CASE WHEN (qt = 0 OR qs = 0) AND isp IS NOT NULL THEN coalesce(idr, 0) ELSE 0 END AS dropped
      FROM j)
SELECT backend, traces, spans, dropped,
       round(CASE WHEN spans > 0 THEN CAST(dropped AS DOUBLE) * 100::DOUBLE / CAST(spans AS DOUBLE)
                  ELSE 0::DOUBLE END, 6) AS drop_rate_pct
FROM k"""

    q["resource_usage"] = f"""WITH {OBS}
SELECT scenario, service, round(avg(cpu_percent), 6) AS avg_cpu_pct, round(max(cpu_percent), 6) AS max_cpu_pct,
       round(avg(memory_bytes / 1024::DOUBLE / 1024::DOUBLE), 6) AS avg_mem_mb,
       round(max(memory_bytes / 1024::DOUBLE / 1024::DOUBLE), 6) AS max_mem_mb
FROM obs GROUP BY scenario, service"""

    q["resource_series"] = f"""WITH {OBS}
SELECT service, ts, cpu_percent AS cpu_pct, memory_bytes / 1024::DOUBLE / 1024::DOUBLE AS mem_mb FROM obs"""

    q["throughput"] = """WITH t AS (SELECT event_type AS service, count(*) AS items,
                  epoch_us(max(ts)) - epoch_us(min(ts)) AS el FROM events GROUP BY 1)
SELECT service, items, el / 1000000::DOUBLE AS elapsed_s,
       CASE WHEN el > 0 THEN CAST(items AS DOUBLE) * 1000000::DOUBLE / CAST(el AS DOUBLE) ELSE 0::DOUBLE END
         AS per_second
FROM t"""

    q["counter_delta"] = """SELECT event_type AS service,
       CAST(count_if(ts < TIMESTAMP '2024-01-15 00:00:00') + 1 AS BIGINT) AS before, count(*) AS after,
       CAST(count(*) - count_if(ts < TIMESTAMP '2024-01-15 00:00:00') - 1 AS BIGINT) AS delta
FROM events GROUP BY event_type HAVING count_if(ts >= TIMESTAMP '2024-01-15 00:00:00') > 0"""

    q["storage_fill_in"] = f"WITH {STORAGE}\nSELECT service, storage_bytes FROM storage WHERE storage_bytes > 0"

    q["bytes_per_item"] = f"""WITH {STORAGE}, n AS (SELECT event_type AS service, count(*) AS total_ingested
                                         FROM events GROUP BY 1)
SELECT service, storage_bytes, total_ingested,
       CASE WHEN total_ingested > 0 THEN storage_bytes / total_ingested END AS bytes_per_item
FROM storage JOIN n USING (service) WHERE storage_bytes > 0"""

    q["relative_difference"] = f"""WITH {STORAGE}, n AS (SELECT event_type AS service, count(*) AS c FROM events GROUP BY 1),
b AS (SELECT service, storage_bytes / c AS bpi FROM storage JOIN n USING (service)),
p AS (SELECT max(CASE WHEN service = 'click' THEN bpi END) AS a, max(CASE WHEN service = 'error' THEN bpi END) AS e
      FROM b)
SELECT CASE WHEN a <> 0 THEN (a - e) / a * 100::DOUBLE END AS pct_less FROM p"""

    q["format_storage"] = f"""WITH {STORAGE}
SELECT service, storage_bytes, {_exp_fmt('storage_bytes')} AS storage_text FROM storage WHERE storage_bytes > 0"""

    q["service_assembly"] = f"""WITH {OBS}, {STORAGE}
SELECT service, ts, cpu_percent, memory_bytes, ingested, dropped, storage_bytes
FROM obs LEFT JOIN storage USING (service)"""

    q["known_services"] = """SELECT event_type AS service, count(*) AS observations FROM events
WHERE event_type IN ('click', 'purchase', 'view') GROUP BY 1"""

    q["load_volume"] = f"""WITH {OBS},
t AS (SELECT scenario, count(*) AS items, epoch_us(max(ts)) - epoch_us(min(ts)) AS el FROM obs GROUP BY 1)
SELECT scenario, CAST(trunc((CASE scenario WHEN 'steady' THEN 25.5::DOUBLE ELSE 100.25::DOUBLE END)
                            * (el / 1000000::DOUBLE)) AS BIGINT) AS estimated_items
FROM t"""

    q["cpu_from_deltas"] = f"""WITH {OBS},
p AS (SELECT service, event_id, ingested - lag(ingested) OVER w AS cd,
             epoch_us(ts) - lag(epoch_us(ts)) OVER w AS sd
      FROM obs WINDOW w AS (PARTITION BY service ORDER BY ts, event_id))
SELECT service, event_id,
       CASE WHEN sd > 0 THEN CAST(cd AS DOUBLE) / CAST(sd AS DOUBLE) * 4::DOUBLE * 100::DOUBLE ELSE 0::DOUBLE END
         AS cpu_pct
FROM p WHERE sd IS NOT NULL"""

    q["memory_share"] = f"""WITH {OBS}
SELECT service, event_id, CAST(memory_bytes AS DOUBLE) / 536870912::DOUBLE * 100::DOUBLE AS mem_pct FROM obs"""

    q["text_utf8_repair"] = f"WITH {LOGS}\nSELECT event_id, line || chr(65533) || 'x' AS repaired FROM log_lines"
    q["exposition_pages_sum"] = f"""WITH {EXPO}
SELECT service, strftime(scrape_ts, '%Y-%m-%d') AS day, name, round(value, 6) AS value FROM expo_sums"""

    q["text_truncate"] = "SELECT doc_id, substring(text, 1, 200) AS head FROM documents"

    q["trace_search_with_fallback"] = f"WITH {SPANS}\n" + counts.format(pred="service = 'payment'")

    q["trace_search_strict_wins"] = f"WITH {SPANS}\n" + counts.format(pred="service = 'payment' AND flag = 'R'")

    run_days = """d AS (
  SELECT date_trunc('day', ts) AS day, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'view') AS view,
         count(*) FILTER (event_type = 'signup') AS signup, count(*) FILTER (event_type = 'purchase') AS purchase,
         count(*) FILTER (event_type = 'error') AS error, max(value) AS top, min(value) AS low
  FROM events GROUP BY 1),
o AS (SELECT *, dayofmonth(day) % 2 = 1 AS odd, CASE WHEN day < TIMESTAMP '2024-01-16' THEN 'run_a' ELSE 'run_b' END AS run FROM d),
b AS (SELECT * FROM o WHERE run = (SELECT max(run) FROM o)),
e AS (SELECT * FROM b ORDER BY day DESC LIMIT 1)"""

    def run_quantiles(name: str, latency: str, ok: str, key: str) -> str:
        return f"""{name}_l AS (SELECT '{key}' AS query_key, day AS ts, 0 AS event_id, {latency} AS v FROM b WHERE {ok}),
{_quantile_sql(name + '_l', 'query_key', 'recent').replace('r AS (', name + '_r AS (').replace('FROM r ', f'FROM {name}_r ')
 .replace('g AS (', name + '_g AS (').replace('FROM g)', f'FROM {name}_g)').replace('q AS (', name + '_q AS (')}"""

    six_hours, day = 6 * 3600 * 10**6, 86400 * 10**6
    closed = "w <= (SELECT epoch_us(max(ts)) - 1 - 3600000000 FROM events)"
    q["stream_sink_steps"] = f"""WITH t AS (SELECT event_type, (epoch_us(ts) + {six_hours} - 1) // {six_hours} * {six_hours} AS w FROM events)
SELECT make_timestamp(w) AS window_end, event_type, count(*) AS n FROM t WHERE {closed} GROUP BY ALL"""
    q["stream_sink_snapshot"] = f"""WITH t AS (SELECT event_type, ts, value, (epoch_us(ts) + {day} - 1) // {day} * {day} AS w FROM events)
SELECT make_timestamp(w) AS window_end, event_type, arg_max(value, (ts, value)) AS value, count(*) AS samples
FROM t WHERE {closed} GROUP BY w, event_type"""
    forwarded = f"""WITH {STRICT}, f AS (
  SELECT CASE WHEN rejected THEN 'rejected' WHEN is_json THEN 'entry' ELSE 'plain' END AS kind, severity
  FROM entries WHERE NOT is_json OR own_time IS NULL OR event_time >= 1705363200)"""
    q["stream_sink_forwarder"] = forwarded + "\nSELECT kind, severity, count(*) AS lines FROM f GROUP BY ALL"
    q["stream_drop_counts"] = forwarded + """
SELECT 'entries' AS metric, count(*) FILTER (kind <> 'rejected') AS lines FROM f UNION ALL SELECT 'plain', count(*) FILTER (kind = 'plain') FROM f
UNION ALL SELECT 'rejected', count(*) FILTER (kind = 'rejected') FROM f UNION ALL SELECT 'untimed', 0"""
    q["stream_forwarder_pair"] = forwarded + """
SELECT count(*) FILTER (kind <> 'rejected') AS lines_a, count(*) FILTER (kind <> 'rejected') AS lines_b, 0 AS batches_apart FROM f"""
    q["stream_forwarder_batches"] = forwarded + "\nSELECT 0 AS batches_over, count(*) AS lines FROM f"
    q["stream_tail_from_now"] = f"""WITH {LENIENT}
SELECT CASE WHEN is_json THEN 'entry' ELSE 'plain' END AS kind, severity, count(*) AS lines FROM entries WHERE event_id % 3 = 0 GROUP BY ALL"""
    pane_end = f"(SELECT (epoch_us(max(ts)) - 1 - 3600000000) // {six_hours} * {six_hours} FROM events)"
    q["stream_rate_per_series"] = f"""WITH {SAMPLES},
c AS (SELECT series_key, ts, event_id, sum(CAST(value AS DECIMAL(18,2))) OVER (
        PARTITION BY series_key ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS counter FROM samples),
p AS (SELECT series_key, counter, lag(counter) OVER (PARTITION BY series_key ORDER BY ts, event_id) AS prev
      FROM c WHERE epoch_us(ts) > {pane_end} - 604800000000 AND epoch_us(ts) <= {pane_end}),
a AS (SELECT series_key, sum(CASE WHEN prev IS NULL THEN NULL WHEN counter >= prev THEN counter - prev ELSE counter END) AS inc,
             count(*) AS samples FROM p GROUP BY series_key)
SELECT series_key, CAST(inc AS DOUBLE) AS increase, CAST(inc AS DOUBLE) / 604800::DOUBLE AS rate, samples FROM a WHERE samples >= 2"""
    q["stream_sliding_state"] = f"""WITH grid AS (
  SELECT DISTINCT event_type, (epoch_us(ts) + {six_hours} - 1) // {six_hours} * {six_hours} + j * {six_hours} AS t FROM events, range(0, 4) r(j))
SELECT make_timestamp(g.t) AS window_end, g.event_type, count(*) AS n
FROM grid g JOIN events e ON e.event_type = g.event_type AND epoch_us(e.ts) > g.t - {day} AND epoch_us(e.ts) <= g.t
WHERE g.t <= {pane_end} GROUP BY ALL"""
    q["stream_churn"] = f"""WITH {SAMPLES}, lim AS (SELECT (epoch_us(max(ts)) // 1000 * 1000 - 3600000000) // {day} AS i FROM events),
a AS (SELECT DISTINCT series_key, epoch_us(ts) // {day} AS i FROM samples WHERE epoch_us(ts) // {day} < (SELECT i FROM lim)),
s AS (SELECT i, 1 AS act, CASE WHEN NOT EXISTS (SELECT 1 FROM a p WHERE p.series_key = a.series_key AND p.i = a.i - 1) THEN 1 ELSE 0 END AS app, 0 AS gone FROM a
      UNION ALL SELECT i + 1, 0, 0, 1 FROM a WHERE i + 1 < (SELECT i FROM lim)
        AND NOT EXISTS (SELECT 1 FROM a x WHERE x.series_key = a.series_key AND x.i = a.i + 1))
SELECT make_timestamp(i * {day}) AS interval_start, CAST(sum(act) AS BIGINT) AS active, CAST(sum(app) AS BIGINT) AS appeared,
       CAST(sum(gone) AS BIGINT) AS disappeared FROM s GROUP BY i"""
    q["stream_top_series"] = f"""WITH {SAMPLES}
SELECT series_key, CAST(sum(1 + bit_count(xor(user_id, user_id - 1))) AS BIGINT) AS samples, true AS held, true AS within_bounds
FROM samples GROUP BY 1 ORDER BY samples DESC, series_key LIMIT 10"""
    q["stream_retention"] = """SELECT event_type, count(*) AS entries FROM events
WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY GROUP BY 1"""
    q["stored_range_counts"] = """SELECT event_type, count(*) AS samples FROM events
WHERE ts > TIMESTAMP '2024-01-10 06:00:00' AND ts <= TIMESTAMP '2024-01-12 18:00:00' GROUP BY 1"""

    q["run_latest"] = f"WITH {run_days}\nSELECT max(run) AS run_id FROM o"
    q["run_query_errors"] = f"""WITH {run_days}
SELECT 'metrics_store:topk' AS query_key, count(*) FILTER (error % 3 = 0) AS errors FROM o
UNION ALL SELECT 'logs_store:count', count(*) FILTER (error % 4 = 0) FROM o
UNION ALL SELECT 'traces_store:traces_by_label', 0 FROM o HAVING count(*) > 0"""
    q["report_load_volume"] = f"""WITH {run_days}
SELECT 'Time Series' AS metric, format('{{:,}} series', click * 1000) AS value, format('{{:,}} active', view * 10) AS rate FROM e
UNION ALL SELECT 'Log Lines', format('{{:,}} lines', signup * 5000), printf('%.0f lines/sec', signup + 0.25) FROM e
UNION ALL SELECT 'Trace Spans', format('{{:,}} spans', purchase), printf('%.0f spans/sec', purchase + 0.75) FROM e"""
    q["report_metrics"] = f"""WITH {run_days}, {run_quantiles('m', 'top', 'error % 3 <> 0', 'metrics_store:topk')}
SELECT 'metrics_store' AS service, 'topk' AS query, round(p50, 6) AS p50, round(p90, 6) AS p90, round(p99, 6) AS p99 FROM m_q"""
    q["report_logs"] = f"""WITH {run_days}, {run_quantiles('m', 'low', 'error % 4 <> 0', 'logs_store:count')}
SELECT 'logs_store' AS service, 'count' AS query, round(p50, 6) AS p50, round(p90, 6) AS p90, round(p99, 6) AS p99,
       (SELECT count(*) FROM b WHERE error % 4 = 0) AS errors FROM m_q"""
    q["report_traces"] = f"""WITH {run_days}, t AS (
  SELECT max(view) AS traces, nullif(max(nullif(purchase * 3, 0)), 0) AS spans, max(nullif(view % 5, 0)) AS dropped FROM b)
SELECT 'traces_store' AS backend, traces, CAST(coalesce(spans, 0) AS BIGINT) AS spans, CAST(coalesce(dropped, 0) AS BIGINT) AS dropped,
       round(CASE WHEN spans > 0 THEN coalesce(dropped, 0) / spans::DOUBLE * 100 ELSE 0::DOUBLE END, 6) AS drop_rate_pct FROM t"""
    q["report_storage"] = f"""WITH {run_days}, s AS (
  SELECT 'metrics_store' AS service, (SELECT arg_max(click * 1000, day) FROM b WHERE click > 0) AS storage_bytes
  UNION ALL SELECT 'traces_store', (SELECT arg_max(purchase * 37 + 5, day) FROM b))
SELECT service, {_exp_fmt('storage_bytes')} AS storage_size, storage_bytes FROM s WHERE storage_bytes IS NOT NULL"""
    q["report_ingest"] = f"""WITH {run_days}
SELECT 'metrics_store' AS service, 'Samples' AS type, max(CASE WHEN odd OR click = 0 THEN click * 20 ELSE click * 10 END) AS total_ingested,
       max(error) AS total_dropped FROM b
UNION ALL SELECT 'logs_store', 'Lines', max(signup * 7), max(error * 2) FROM b
UNION ALL SELECT 'traces_store', 'Spans', max(purchase * 3), max(view % 5) FROM b"""
    q["report_resources"] = f"""WITH {run_days}, u AS (
  SELECT 'metrics_store' AS service, click % 100 + 0.5::DOUBLE AS cpu, view::DOUBLE AS mb FROM b
  UNION ALL SELECT 'logs_store', view % 100 + 0.5::DOUBLE, click::DOUBLE FROM b
  UNION ALL SELECT 'traces_store', signup % 100 + 0.5::DOUBLE, purchase::DOUBLE FROM b)
SELECT service, round(avg(cpu), 6) AS avg_cpu_pct, max(cpu) AS max_cpu_pct, round(avg(mb), 6) AS avg_mem_mb, max(mb) AS max_mem_mb FROM u GROUP BY 1"""

    q["tag_inspection"] = f"""WITH {SPANS}
SELECT 'benchmark_app' AS key, 'orders' AS value, count(*) AS spans FROM spans
UNION ALL SELECT 'Benchmark.Status', status, count(*) FROM spans GROUP BY status"""

    q["query_latency_table"] = f"""WITH l AS (SELECT event_type || ':q' || CAST(user_id % 3 AS VARCHAR) AS query_key, ts, event_id,
                  value AS v FROM events WHERE event_type <> 'error'),
{_quantile_sql('l', 'query_key', 'recent')}
SELECT CASE WHEN contains(k, 'click') OR contains(k, 'view') THEN 'Samples'
            WHEN contains(k, 'signup') OR contains(k, 'purchase') THEN 'Lines'
            WHEN contains(k, 'error') THEN 'Spans' END AS service,
       regexp_extract(k, '[^:]*$') AS query, k AS query_key, n, p50, p90, p99
FROM q"""

    q["stream_sliding_counts"] = """WITH grid AS (
  SELECT DISTINCT event_type, (epoch_us(ts) // 21600000000) * 21600000000 + j * 21600000000 AS t
  FROM events, range(0, 5) r(j))
SELECT make_timestamp(g.t) AS window_end, g.event_type, count(*) AS n
FROM grid g JOIN events e ON e.event_type = g.event_type
  AND epoch_us(e.ts) > g.t - 86400000000 AND epoch_us(e.ts) <= g.t
GROUP BY ALL"""

    q["stream_periodic_snapshot"] = f"""WITH {OBS},
t AS (SELECT *, epoch_us(ts) AS us FROM obs)
SELECT make_timestamp(us + ((-us) % 86400000000 + 86400000000) % 86400000000) AS window_end, service,
       arg_max(ingested, ts) AS ingested, count(*) AS samples
FROM t GROUP BY ALL"""

    q["stream_running_totals"] = """SELECT event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
       count(*) AS samples FROM events GROUP BY event_type"""

    q["stream_dedup"] = """SELECT event_type, count(DISTINCT event_id) AS entries FROM events GROUP BY event_type"""

    q["stream_late_rejection"] = f"""WITH {BOUNDS}
SELECT event_type, count(*) AS accepted FROM events, bounds b
WHERE ts >= b.e - INTERVAL 168 HOUR GROUP BY event_type"""
    return q
