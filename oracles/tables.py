"""Second computation of the operators on the star-schema and text tables."""

from __future__ import annotations

_PRICED = """SELECT o_orderkey AS order_key, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
  o_orderstatus AS status, o_totalprice AS price, o_orderdate FROM orders"""

TABLES = {
    "latest_line_per_key": """
SELECT * EXCLUDE (nth) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax
  ) AS nth FROM lineitem)
WHERE nth = 1""",
    "daily_user_kpis": """
SELECT CAST(ts AS DATE) AS day, user_id, event_type, count(*) AS events,
  count(*) FILTER (WHERE value > 10) AS large,
  (count(*) FILTER (WHERE value > 10)) / count(*)::DOUBLE AS large_rate,
  first(value ORDER BY ts, event_id) AS value_first,
  first(value ORDER BY ts DESC, event_id DESC) AS value_last,
  count(DISTINCT json_extract_string(props, '$.k')::BIGINT) AS distinct_keys,
  round(first(value ORDER BY ts DESC, event_id DESC) - first(value ORDER BY ts, event_id), 6)
    AS value_delta
FROM events GROUP BY ALL""",
    "weekly_user_trend": """
WITH weekly AS (
  SELECT CAST(date_trunc('week', ts) AS DATE) AS week, user_id, event_type, count(*) AS events,
    min(value) AS min_value, max(value) AS max_value,
    first(value ORDER BY ts, event_id) AS opening,
    first(value ORDER BY ts DESC, event_id DESC) AS closing
  FROM events GROUP BY ALL)
SELECT *, lag(closing) OVER w AS previous_closing,
  round(closing - lag(closing) OVER w, 6) AS change,
  ((week - lag(week) OVER w) // 7)::BIGINT AS weeks_since_previous
FROM weekly WINDOW w AS (PARTITION BY user_id, event_type ORDER BY week)""",
    "return_rates": """
SELECT l_partkey, l_linestatus, coalesce(p_brand, 'Unknown') AS brand, lines, returned,
  returned / lines::DOUBLE AS return_rate,
  (returned + 0.5::DOUBLE * accepted) / lines AS weighted_rate, open_rate,
  lines >= 30 AS is_significant
FROM (
  SELECT l_partkey, l_linestatus, count(*) AS lines,
    count(*) FILTER (WHERE l_returnflag = 'R') AS returned,
    count(*) FILTER (WHERE l_returnflag = 'A') AS accepted,
    (count(*) FILTER (WHERE l_returnflag = 'N')) / count(*)::DOUBLE AS open_rate
  FROM lineitem GROUP BY ALL
) LEFT JOIN part ON p_partkey = l_partkey""",
    "value_quantiles": """
SELECT event_type, count(*) AS events, quantile_disc(value, 0.5) AS median_value,
  quantile_disc(value, 0.9) AS p90_value,
  avg(CASE WHEN value > 10 THEN day(ts) END) AS mean_day_large
FROM events GROUP BY event_type""",
    "nation_cohorts": """
SELECT c_nationkey, count(*) AS customers, sum(orders)::BIGINT AS total_orders,
  avg(orders) AS avg_orders, quantile_disc(orders, 0.5) AS median_orders,
  avg(CAST(last_order AS DATE) - CAST(first_order AS DATE)) AS avg_span_days,
  (count(*) FILTER (WHERE last_order >= TIMESTAMP '2001-07-01')) / count(*)::DOUBLE AS active_rate
FROM (
  SELECT o_custkey, count(*) AS orders, min(o_orderdate) AS first_order,
    max(o_orderdate) AS last_order
  FROM orders GROUP BY o_custkey
) JOIN customer ON c_custkey = o_custkey
GROUP BY c_nationkey""",
    "line_parties": """
SELECT 'part' AS role, l_partkey AS party, count(*) AS lines, sum(l_quantity) AS quantity
FROM lineitem GROUP BY ALL
UNION ALL
SELECT 'supplier', l_suppkey, count(*), sum(l_quantity) FROM lineitem GROUP BY ALL""",
    "brand_types": """
SELECT p_brand, p_type, total::BIGINT AS total_rows, variants AS label_variants
FROM (
  SELECT p_brand, p_type, sum(n) OVER (PARTITION BY p_brand) AS total,
    count(*) OVER (PARTITION BY p_brand) AS variants,
    row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) AS nth
  FROM (SELECT p_brand, p_type, count(*) AS n FROM part
        WHERE p_brand IS NOT NULL AND p_type IS NOT NULL GROUP BY ALL))
WHERE nth = 1""",
    "line_checks": """
WITH checks AS (
  SELECT 'key_not_null' AS check_name, 'error' AS severity, count(*) FILTER (WHERE l_orderkey IS NULL)
    AS failed_rows, count(*) AS total_rows, 0::DOUBLE AS threshold_pct, 'key set' AS detail
    FROM lineitem
  UNION ALL SELECT 'key_unique', 'error', count(*) - count(DISTINCT (l_orderkey, l_linenumber)),
    count(*), 0, 'key unique' FROM lineitem
  UNION ALL SELECT 'quantity_in_range', 'error',
    count(*) FILTER (WHERE l_quantity < 2 OR l_quantity > 49), count(*), 5,
    'quantity between 2 and 49' FROM lineitem
  UNION ALL SELECT 'flag_known', 'error',
    count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N', 'R')), count(*), 0, 'flag known'
    FROM lineitem
  UNION ALL SELECT 'discounted', 'warn', count(*) FILTER (WHERE l_discount <= 0), count(*), 1,
    'discount given' FROM lineitem
  UNION ALL SELECT 'taxed_or_open', 'warn',
    count(*) FILTER (WHERE l_tax = 0 AND l_linestatus <> 'O'), count(*), 3, 'tax or open'
    FROM lineitem
  UNION ALL SELECT 'rows_present', 'error', CASE WHEN count(*) = 0 THEN 1 ELSE 0 END,
    greatest(count(*), 1), 0, 'rows exist' FROM lineitem)
SELECT check_name, severity, failed_rows, total_rows,
  round(failed_rows / total_rows::DOUBLE * 100, 4) AS failed_pct, threshold_pct,
  failed_rows / total_rows::DOUBLE * 100 <= threshold_pct AS passed, detail
FROM checks""",
    "page_urls": r"""
SELECT page_id, nullif(regexp_extract(url, '^\w+://([^/?#]+)', 1), '') AS host,
  nullif(regexp_extract(bare, '([^/]+)/?$', 1), '') AS slug,
  TRY_CAST(nullif(regexp_extract(bare, '/(\d+)/?$', 1), '') AS BIGINT) AS number,
  nullif(replace(regexp_extract(bare, '([^/]+)/?$', 1), '-', ' '), '') AS title,
  starts_with(url, 'https://') AS is_secure
FROM (SELECT page_id, url, regexp_replace(url, '[?#].*$', '') AS bare FROM pages)""",
    "text_numbers": r"""
SELECT doc_id,
  list_max(list_transform(regexp_extract_all(plain, '(\d+)\.', 1), lambda n: TRY_CAST(n AS BIGINT)))
    AS greatest,
  len(regexp_extract_all(plain, '(\d+)', 1)) AS numbers
FROM (SELECT doc_id, regexp_replace(text, '\{[^}]*\}', ' ', 'g') AS plain FROM documents)""",
    "event_props": """
SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k,
  array_to_string(json_keys(props), ',') AS keys
FROM events""",
    "user_sessions": """
WITH marked AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS is_first
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
numbered AS (
  SELECT *, sum(is_first) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nth FROM marked)
SELECT min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, user_id,
  count(*) AS events, count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
  first(event_type ORDER BY ts, event_id) AS first_type, max(value) AS max_value
FROM numbered GROUP BY user_id, nth""",
    "hourly_throughput": """
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
  event_type, count(*) AS events, min(value) AS min_value,
  round_even(count(*) / 60.0::DOUBLE, 3) AS events_per_minute
FROM events GROUP BY ALL""",
    "last_known_values": """
SELECT event_id, ts, user_id, event_type, value,
  last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER w AS last_purchase,
  last_value(CASE WHEN event_type = 'click' THEN value END IGNORE NULLS) OVER w AS last_click
FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "document_moves": r"""
WITH tokens AS (
  SELECT doc_id, list_filter(
    list_transform(
      list_filter(string_split_regex(regexp_replace(text, '\{[^}]*\}', ' ', 'g'), '\s+'),
        lambda t: t NOT IN ('1-0', '0-1', '1/2-1/2', '*') AND NOT starts_with(t, '$')),
      lambda t: regexp_replace(t, '^\d+\.(\.\.)?', '')),
    lambda t: t NOT IN ('', '1-0', '0-1', '1/2-1/2', '*')) AS words
  FROM documents),
moves AS (
  SELECT doc_id, unnest(words) AS san, unnest(range(1, len(words) + 1)) AS ply FROM tokens)
SELECT doc_id, CASE WHEN ply % 2 = 1 THEN 'white' ELSE 'black' END AS color, count(*) AS tokens,
  max(ply) AS last_ply, max((ply + 1) // 2) AS last_move, sum(length(san))::BIGINT AS letters
FROM moves GROUP BY ALL""",
    "role_words": """
SELECT upper(role) AS title, username, count(*) AS entries
FROM (SELECT role, unnest(string_split(text, ' ')) AS username FROM conversations)
GROUP BY ALL""",
    "monthly_archives": """
SELECT o_custkey AS player, year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month,
  sign * o_orderkey AS order_key, sign * o_totalprice AS price
FROM orders, (VALUES (1), (-1)) AS signs(sign)
WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'""",
    "recent_order_months": """
SELECT player, url, year, month FROM (
  SELECT *, row_number() OVER (PARTITION BY player ORDER BY year DESC, month DESC) AS nth
  FROM (SELECT DISTINCT 'player' || o_custkey AS player,
          'https://games.example.org/player/' || o_custkey || strftime(o_orderdate, '/games/%Y/%m')
            AS url,
          year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month
        FROM orders))
WHERE nth <= 3""",
    "upserted_orders": f"""
SELECT order_key, month, status,
  CASE WHEN year(month) IN (1997, 1998) THEN price * 2 ELSE price END AS price
FROM ({_PRICED})
WHERE status IN ('F', 'P') OR year(month) IN (1997, 1998)""",
    "replaced_months": f"""
SELECT month, status, count(*) AS orders, max(price) AS max_price
FROM ({_PRICED})
WHERE year(month) NOT BETWEEN 1996 AND 1999
   OR (month(month) BETWEEN 4 AND 9 AND status = 'O')
GROUP BY ALL""",
}
