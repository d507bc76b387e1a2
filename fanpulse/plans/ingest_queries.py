"""Registered queries of the ingestion operators and of quality checks that find something.

The given tables are nested into the raw match, event and lineup shapes (missing fields, short coordinate lists, renamed
teams) and go through the normalisers; for the quality suite, the canonical tables get broken keys, references, values
and orders. Each binding is written in DuckDB SQL beside its Spark form.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fanpulse.operators import quality
from fanpulse.plans.oracle import AS_OF
from fanpulse.plans.oracle_bindings import with_tables
from fanpulse.plans.registry import register
from fanpulse.plans.reports import _ALL_TABLES, ORACLE_NAME, _quality_sql
from fanpulse.sources import ingest

LAST_MATCHES = 12  # of the "last N matches" query


# ============================================================== raw shapes
def _div(column: str, n: int) -> Column:
    return F.expr(f"{column} div {n}")


def raw_matches(t) -> DataFrame:
    """Two suppliers share a team, under names of their own; some matches lack a kick-off or a score."""
    def team(side: str) -> Column:
        return F.struct(_div(f"{side}_team_id", 2).alias(f"{side}_team_id"), F.col(f"{side}_team_name")).alias(f"{side}_team")

    return t["dim_matches"].select(
        "match_id", F.col("match_date").cast("string").alias("match_date"),
        F.when(F.pmod("match_id", F.lit(3)) != 0, "18:30:00.000").alias("kick_off"),
        F.struct("competition_id", "competition_name").alias("competition"), F.struct("season_id", "season_name").alias("season"),
        team("home"), team("away"),
        *[F.when(F.col(s) > 0, F.col(s)).alias(s) for s in ("home_score", "away_score")],
    )


def raw_events(t) -> DataFrame:
    def ref(id_: str | None, name: str | None) -> Column:
        return F.struct((F.col(id_) if id_ else F.lit(1)).cast("long").alias("id"), (F.col(name) if name else F.lit(None)).cast("string").alias("name"))

    kind, x, y = F.col("event_type"), F.col("x"), F.col("y")
    pass_end = F.when(y < 60, F.array(y, x)).when(y < 70, F.array(y)).otherwise(F.array().cast("array<double>"))
    return t["fact_match_events"].select(
        F.col("match_id").alias("_match_id"),
        F.concat(F.lit("evt_"), F.col("event_id").cast("string")).alias("id"),
        F.when(F.pmod("event_index", F.lit(4)) != 0, F.col("event_index")).alias("index"),
        F.when(F.col("period") < 5, F.col("period")).alias("period"),
        F.when(F.pmod("minute", F.lit(10)) != 9, F.col("minute")).alias("minute"),
        F.when(F.col("period") > 1, F.pmod("event_index", F.lit(60))).alias("second"),
        ref(None, "event_type").alias("type"), ref("team_id", None).alias("team"),
        F.when(kind != "Substitution", ref("player_id", None)).alias("player"), ref("possession_team_id", None).alias("possession_team"),
        F.when(x < 100, F.array(x, y)).when(x < 110, F.array(x)).alias("location"),
        F.when(kind == "Pass", F.struct(F.when(F.col("pass_outcome") == "Incomplete", ref(None, "pass_outcome")).alias("outcome"), pass_end.alias("end_location"))).alias("pass"),
        F.when(kind == "Shot", F.struct(F.col("shot_xg").alias("statsbomb_xg"), ref(None, "shot_outcome").alias("outcome"), F.array(x, y).alias("end_location"))).alias("shot"),
        F.when(kind == "Duel", F.struct(ref(None, "duel_type").alias("type"))).alias("duel"),
        F.when(F.col("under_pressure"), True).alias("under_pressure"),
        F.when(F.col("period") == 1, 1.5).alias("duration"),
    )


def raw_lineups(t) -> DataFrame:
    """Both sides of every match, each with all players of its team (a bounded number a team, whatever the data's size)."""
    squads = t["dim_players"].groupBy("team_id").agg(F.array_sort(F.collect_list(F.struct("player_id", "player_name"))).alias("lineup"))
    sides = F.array(*[F.struct(F.lit(i).alias("_team_pos"), F.col(f"{s}_team_id").alias("team_id"),
                               F.concat(F.col(f"{s}_team_name"), F.lit(f" ({s})")).alias("team_name")) for i, s in enumerate(("home", "away"))])
    rows = t["dim_matches"].select(F.col("match_id").alias("_match_id"), F.inline(sides))
    return rows.join(squads, "team_id", "left")


def football(t, max_matches: int | None = None) -> dict[str, DataFrame]:
    return ingest.football_tables(ingest.normalize_matches(raw_matches(t)), raw_events(t), raw_lineups(t), max_matches)


_MATCH_SQL = """
SELECT match_id, match_date, CASE WHEN match_id % 3 <> 0 THEN '18:30:00.000' ELSE '00:00:00' END AS kick_off,
  competition_id, competition_name, season_id, season_name, home_team_id // 2 AS home_team_id, home_team_name,
  away_team_id // 2 AS away_team_id, away_team_name, home_score, away_score
FROM dim_matches
"""
_TEAM_SQL = """
, named AS (
  SELECT home_team_id // 2 AS team_id, home_team_name AS team_name, 0 AS side, match_date, match_id FROM dim_matches
  UNION ALL SELECT away_team_id // 2, away_team_name, 1, match_date, match_id FROM dim_matches)
SELECT team_id, team_name FROM named
QUALIFY row_number() OVER (PARTITION BY team_id ORDER BY side, match_date, match_id) = 1
"""
_EVENT_SQL = """
, e AS (
  SELECT *, CASE WHEN minute % 10 = 9 THEN 0 ELSE minute END AS mi, CASE WHEN period > 1 THEN event_index % 60 ELSE 0 END AS se,
    CASE WHEN event_type = 'Pass' AND y < 60 THEN [y, x] WHEN event_type = 'Pass' AND y < 70 THEN [y]
         WHEN event_type = 'Shot' THEN [x, y] END AS ends
  FROM match_events)
SELECT 'evt_' || CAST(event_id AS VARCHAR) AS event_id, e.match_id, CASE WHEN event_index % 4 = 0 THEN 0 ELSE event_index END AS event_index,
  CAST(m.match_date AS TIMESTAMP) + to_minutes(CASE WHEN m.match_id % 3 = 0 THEN 0 ELSE 1110 END + mi) + to_seconds(se) AS event_ts,
  CASE WHEN period < 5 THEN period ELSE 1 END AS period, mi AS minute, CAST(se AS INTEGER) AS second, event_type, team_id,
  CASE WHEN event_type <> 'Substitution' THEN CAST(player_id AS VARCHAR) END AS player_id, CAST(possession_team_id AS VARCHAR) AS possession_team_id,
  CASE WHEN x < 110 THEN x END AS x, CASE WHEN x < 100 THEN y END AS y, ends[1] AS end_x, ends[2] AS end_y,
  shot_xg, shot_outcome, CASE WHEN pass_outcome = 'Incomplete' THEN 'Incomplete' ELSE 'Complete' END AS pass_outcome, duel_type,
  under_pressure, CAST(CASE WHEN period = 1 THEN 1.5 ELSE 0 END AS DOUBLE) AS duration_seconds
FROM e JOIN dim_matches m ON m.match_id = e.match_id
"""
_PLAYER_SQL = """
, listed AS (
  SELECT p.player_id, p.player_name, p.team_id, m.match_date, m.match_id, m.home_team_id <> p.team_id AS away,
    CASE WHEN m.home_team_id = p.team_id THEN m.home_team_name || ' (home)' ELSE m.away_team_name || ' (away)' END AS team_name
  FROM dim_players p JOIN dim_matches m ON p.team_id IN (m.home_team_id, m.away_team_id))
SELECT player_id, player_name, team_id, team_name FROM listed
QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY match_date, match_id, away) = 1
"""

register("ingest_matches", with_tables(["dim_matches"], _MATCH_SQL))(lambda t: football(t)["dim_matches"])
register("ingest_last_matches", with_tables(["dim_matches"], _MATCH_SQL + f"ORDER BY match_date DESC, match_id DESC LIMIT {LAST_MATCHES}"))(
    lambda t: football(t, LAST_MATCHES)["dim_matches"])
register("ingest_teams", with_tables(["dim_matches"], _TEAM_SQL))(lambda t: football(t)["dim_teams"])
# ids that may be missing are compared as text: both engines then hand over NULL the same way
register("ingest_events", with_tables(["match_events", "dim_matches"], _EVENT_SQL))(
    lambda t: football(t)["fact_match_events"].withColumns({c: F.col(c).cast("string") for c in ("player_id", "possession_team_id")}))
register("ingest_players", with_tables(["dim_players", "dim_matches"], _PLAYER_SQL))(lambda t: football(t)["dim_players"])


# ============================================================== broken tables
# table -> column -> (Spark SQL, DuckDB SQL where it differs)
BROKEN: dict[str, dict[str, str | tuple[str, str]]] = {
    "dim_date": {"date": "CASE WHEN day_of_week <> 3 THEN date END"},
    "dim_users": {"user_id": "CASE WHEN user_id % 10 <> 3 THEN user_id END"},
    "dim_matches": {"match_id": "CASE WHEN home_score > 0 THEN match_id END"},
    "dim_teams": {"team_id": ("CASE WHEN team_id > 0 THEN team_id div 2 END", "CASE WHEN team_id > 0 THEN team_id // 2 END")},
    "dim_players": {"player_id": ("CASE WHEN player_id % 7 <> 0 THEN player_id div 3 END", "CASE WHEN player_id % 7 <> 0 THEN player_id // 3 END")},
    "dim_content": {"content_id": "CASE WHEN content_type <> 'live_blog' THEN content_id END"},
    "fact_match_events": {
        "event_id": ("CASE WHEN event_type <> 'Duel' THEN event_id div 2 END", "CASE WHEN event_type <> 'Duel' THEN event_id // 2 END"),
        "shot_xg": "shot_xg * 2",
    },
    "fact_app_events": {  # rows without an id are alone in their session, so that the order of a session stays defined
        "event_id": "CASE WHEN event_name <> 'app_open' THEN event_id END",
        "session_id": "CASE WHEN event_name <> 'app_open' THEN session_id ELSE 'lone-' || CAST(event_id AS {string}) END",
        "event_ts": "CASE WHEN event_name = 'highlight_view' THEN event_ts - INTERVAL '2' HOUR ELSE event_ts END",
    },
    "fact_campaign_spend": {"spend_date": "CASE WHEN channel <> 'partner' THEN spend_date END", "campaign_id": "channel"},
    "fact_experiment_assignments": {"user_id": "CASE WHEN user_id % 10 <> 3 THEN user_id END"},
}


def broken_tables(t) -> dict[str, DataFrame]:
    """The ten tables with the columns of ``BROKEN``; every user is assigned a second time, to the treatment."""
    out = {}
    for name, columns in BROKEN.items():
        df = t[name]
        if name == "fact_experiment_assignments":
            df = df.unionByName(df.withColumn("variant", F.lit("treatment")))
        out[name] = df.withColumns({c: F.expr((e if isinstance(e, str) else e[0]).replace("{string}", "string")) for c, e in columns.items()})
    return out


def _broken_sql() -> str:
    parts = []
    for name, columns in BROKEN.items():
        source = ORACLE_NAME[name]
        rows = source if source != "assignments" else (
            "(SELECT * FROM assignments UNION ALL SELECT * REPLACE ('treatment' AS variant) FROM assignments) a")
        exprs = ", ".join(f"{(e if isinstance(e, str) else e[1]).replace('{string}', 'VARCHAR')} AS {c}" for c, e in columns.items())
        parts.append(f", broken_{source} AS (SELECT * REPLACE ({exprs}) FROM {rows})")
    names = "|".join(ORACLE_NAME.values())
    return "\n".join(parts) + re.sub(rf"\b(FROM|JOIN) ({names})\b", r"\1 broken_\2", _quality_sql())


register("quality_findings", with_tables(_ALL_TABLES, _broken_sql() + "SELECT * FROM quality"))(
    lambda t: quality.with_checked_at(quality.validate(broken_tables(t)), AS_OF))

register("lineitem_key_check", """
SELECT (SELECT CAST(COALESCE(SUM(c - 1), 0) AS BIGINT) FROM (SELECT COUNT(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)) AS duplicates,
  (SELECT COUNT(*) FROM lineitem WHERE l_orderkey IS NULL OR l_linenumber IS NULL) AS null_keys
""")(lambda t: quality.key_stats(t.raw("lineitem"), ["l_orderkey", "l_linenumber"]))
