"""The canonical-table bindings written as DuckDB SQL (oracle side).

Mirror of ``fanpulse.sources.bindings``; each entry is a CTE body over the
pre-registered raw views. ``with_tables(names, body)`` builds a full query
with only the CTEs it needs (plus their dependencies).
"""

from __future__ import annotations

CHANNEL_CASE = """CASE {seg}
      WHEN 'AUTOMOBILE' THEN 'organic' WHEN 'BUILDING' THEN 'paid_search'
      WHEN 'FURNITURE' THEN 'social' WHEN 'HOUSEHOLD' THEN 'partner'
      WHEN 'MACHINERY' THEN 'referral' END"""

PLATFORM_CASE = "CASE {u} % 3 WHEN 0 THEN 'android' WHEN 1 THEN 'ios' ELSE 'web' END"
VARIANT_CASE = "CASE WHEN {u} % 2 = 0 THEN 'control' ELSE 'treatment' END"

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "_ev_k": ((), """
  SELECT e.event_id, e.user_id, e.ts AS event_ts, CAST(e.ts AS DATE) AS event_date, e.event_type, e.value,
         CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k,
         """ + CHANNEL_CASE.format(seg="c.c_mktsegment") + """ AS acquisition_channel
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey"""),
    "_ev_named": (("_ev_k",), """
  SELECT *, CASE
      WHEN event_type = 'purchase' AND value < 5 THEN 'subscription_cancel'
      WHEN event_type = 'purchase' THEN 'subscription_start'
      WHEN event_type = 'signup' THEN 'notification_click'
      WHEN event_type = 'view' THEN 'match_center_view'
      WHEN event_type = 'click' THEN 'highlight_view'
      WHEN event_type = 'error' AND k % 2 = 0 THEN 'app_open'
      WHEN event_type = 'error' THEN 'content_view' END AS event_name,
    CAST((user_id + (k // 4) % 8) % (SELECT COUNT(*) FROM supplier) AS BIGINT) AS match_id
  FROM _ev_k"""),
    "app_events": (("_ev_named",), """
  SELECT event_id, user_id,
    CAST(user_id AS VARCHAR) || '-' || CAST(event_date AS VARCHAR) || '-' || CAST(hour(event_ts) // 6 AS VARCHAR) AS session_id,
    event_ts, event_date, event_name, match_id,
    CASE WHEN event_name = 'match_center_view' THEN 'C' || CAST(match_id AS VARCHAR) || '_match_center'
         WHEN event_name = 'highlight_view' THEN 'C' || CAST(match_id AS VARCHAR) || '_highlight'
         WHEN event_name = 'content_view' THEN 'C' || CAST(match_id AS VARCHAR) ||
              CASE WHEN k % 4 = 1 THEN '_live_blog' ELSE '_player_story' END END AS content_id,
    """ + PLATFORM_CASE.format(u="user_id") + """ AS platform,
    acquisition_channel,
    """ + VARIANT_CASE.format(u="user_id") + """ AS experiment_variant,
    CASE WHEN acquisition_channel IN ('paid_search', 'social', 'partner')
         THEN acquisition_channel || '_' || strftime(event_date, '%Y%m%d') END AS campaign_id,
    CAST(CASE WHEN event_name = 'subscription_start' THEN 9.99
         WHEN event_name = 'subscription_cancel' THEN -9.99 ELSE 0.0 END AS DOUBLE) AS revenue_usd,
    value
  FROM _ev_named"""),
    "dim_users": ((), """
  SELECT c.c_custkey AS user_id,
    CAST(DATE '2023-12-20' + CAST(c.c_custkey % 30 AS INTEGER) AS DATE) AS signup_date,
    """ + CHANNEL_CASE.format(seg="c.c_mktsegment") + """ AS acquisition_channel,
    """ + PLATFORM_CASE.format(u="c.c_custkey") + """ AS platform,
    n.n_name AS country,
    CASE WHEN c.c_acctbal > 5000 THEN 'premium' ELSE 'free' END AS subscription_tier
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""),
    "dim_matches": ((), """
  SELECT h.s_suppkey AS match_id,
    CAST(DATE '2024-01-05' + CAST(3 * (h.s_suppkey % 8) AS INTEGER) AS DATE) AS match_date,
    '00:00:00' AS kick_off,
    CAST(n.n_regionkey AS BIGINT) AS competition_id, r.r_name AS competition_name,
    CAST(1 AS BIGINT) AS season_id, '2024' AS season_name,
    h.s_suppkey AS home_team_id, h.s_name AS home_team_name,
    a.s_suppkey AS away_team_id, a.s_name AS away_team_name,
    h.s_suppkey % 3 AS home_score, a.s_suppkey % 3 AS away_score
  FROM supplier h JOIN supplier a ON a.s_suppkey = (h.s_suppkey + 1) % (SELECT COUNT(*) FROM supplier)
  LEFT JOIN nation n ON n.n_nationkey = h.s_nationkey LEFT JOIN region r ON r.r_regionkey = n.n_regionkey"""),
    "dim_content": (("dim_matches",), """
  SELECT 'C' || CAST(m.match_id AS VARCHAR) || '_' || t.content_type AS content_id, m.match_id,
    t.content_type, CAST(m.match_date AS TIMESTAMP) AS published_at, m.home_team_id AS team_id,
    CAST(NULL AS BIGINT) AS player_id
  FROM dim_matches m CROSS JOIN (VALUES ('match_center'), ('highlight'), ('live_blog'), ('player_story')) t(content_type)"""),
    "_orders_matched": ((), """
  SELECT *, o_orderkey % teams AS match_id, (o_orderkey % teams + o_custkey % 2) % teams AS team_id
  FROM orders, (SELECT COUNT(*) AS teams FROM supplier) t"""),
    "match_events": (("_orders_matched",), """
  SELECT o_orderkey AS event_id, match_id, CAST(o_orderkey AS INTEGER) AS event_index,
    TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST((o_orderkey * 29) % 43200 AS BIGINT)) AS event_ts,
    CAST(1 + o_orderkey % 5 AS INTEGER) AS period,
    CAST(((o_orderkey * 29) % 43200) % 120 AS INTEGER) AS minute, 0 AS second,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Shot' WHEN '2' THEN 'Pass' WHEN '3' THEN 'Duel'
      WHEN '4' THEN 'Substitution' WHEN '5' THEN 'Bad Behaviour' END AS event_type,
    team_id,
    o_custkey % 100 AS player_id,
    CASE WHEN o_orderkey % 11 <> 0 THEN team_id END AS possession_team_id,
    CAST(o_orderkey % 121 AS DOUBLE) AS x, CAST(o_orderkey % 81 AS DOUBLE) AS y,
    CAST(NULL AS DOUBLE) AS end_x, CAST(NULL AS DOUBLE) AS end_y,
    CASE WHEN substr(o_orderpriority, 1, 1) = '1' THEN ((o_orderkey * 37) % 101) / 100.0 END AS shot_xg,
    CASE WHEN substr(o_orderpriority, 1, 1) = '1' THEN
      CASE o_orderstatus WHEN 'F' THEN 'Goal' WHEN 'O' THEN 'Saved' ELSE 'Blocked' END END AS shot_outcome,
    CASE WHEN substr(o_orderpriority, 1, 1) = '2' THEN
      CASE WHEN o_orderstatus = 'P' THEN 'Incomplete' ELSE 'Complete' END END AS pass_outcome,
    CASE WHEN substr(o_orderpriority, 1, 1) = '3' THEN
      CASE WHEN o_orderstatus = 'F' THEN 'Tackle' ELSE 'Aerial Lost' END END AS duel_type,
    o_totalprice > 100000 AS under_pressure, CAST(0.0 AS DOUBLE) AS duration_seconds
  FROM _orders_matched"""),
    "campaign_spend": ((), """
  SELECT spend_date, channel || '_' || strftime(spend_date, '%Y%m%d') AS campaign_id, channel,
    50 * clicks AS impressions, clicks, installs, spend_usd,
    CAST(CASE channel WHEN 'paid_search' THEN 2568.0 WHEN 'social' THEN 1926.0 WHEN 'partner' THEN 1105.67 END
      AS DOUBLE) AS target_spend_usd
  FROM (
    SELECT CAST(DATE '2023-12-20' + CAST(l.l_orderkey % 30 AS INTEGER) AS DATE) AS spend_date,
      """ + CHANNEL_CASE.format(seg="c.c_mktsegment") + """ AS channel,
      CAST(SUM(l.l_quantity) AS BIGINT) AS clicks, COUNT(*) AS installs,
      ROUND(SUM(l.l_extendedprice * l.l_tax) / 1000, 2) AS spend_usd
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey
    WHERE c.c_mktsegment IN ('BUILDING', 'FURNITURE', 'HOUSEHOLD')
    GROUP BY 1, 2
  ) s"""),
    "assignments": (("dim_users",), """
  SELECT user_id, 'match_center_v2' AS experiment_name,
    """ + VARIANT_CASE.format(u="user_id") + """ AS variant,
    CAST(signup_date AS TIMESTAMP) AS assigned_at
  FROM dim_users"""),
    "dim_teams": ((), """
  SELECT s_suppkey AS team_id, s_name AS team_name FROM supplier"""),
    "dim_players": (("dim_teams",), """
  SELECT p.player_id, p.player_name, p.team_id, t.team_name
  FROM (SELECT c_custkey AS player_id, c_name AS player_name, c_custkey % (SELECT COUNT(*) FROM supplier) AS team_id
        FROM customer) p LEFT JOIN dim_teams t ON t.team_id = p.team_id"""),
    "dim_date": (("dim_users", "app_events"), """
  SELECT d AS date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
    CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, CAST(weekofyear(d) AS INTEGER) AS iso_week,
    CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend
  FROM (SELECT CAST(unnest(generate_series(
          CAST((SELECT MIN(signup_date) FROM dim_users) AS TIMESTAMP),
          CAST((SELECT MAX(event_date) FROM app_events) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d) g"""),
}


def _closure(names: tuple[str, ...] | list[str]) -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in CTES[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    return order


def with_tables(names: tuple[str, ...] | list[str], body: str) -> str:
    """``WITH <bindings needed> <body>``; body may start with more CTEs as ', x AS (...)'."""
    parts = [f"{n} AS ({CTES[n][1]}\n)" for n in _closure(names)]
    body = body.strip()
    if body.startswith(","):
        return "WITH " + ",\n".join(parts) + body + "\n"
    return "WITH " + ",\n".join(parts) + "\n" + body + "\n"
