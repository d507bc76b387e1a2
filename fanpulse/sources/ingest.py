"""Nested football JSON -> star-schema tables (matches, teams, players, events).

Input layout (files already in storage): ``matches.json`` or
``matches/<competition>/<season>.json`` (array of matches),
``events/<match_id>.json`` and ``lineups/<match_id>.json`` (arrays).
Everything is read with explicit schemas and flattened with struct access,
``get`` for coordinates, ``explode`` / ``posexplode`` for arrays; no row loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fanpulse.functions.joins import dedupe_first

_L, _S, _D, _I, _B = T.LongType(), T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


_REF = _st(("id", _L), ("name", _S))
MATCH_SCHEMA = _st(
    ("match_id", _L), ("match_date", _S), ("kick_off", _S),
    ("competition", _st(("competition_id", _L), ("competition_name", _S))),
    ("season", _st(("season_id", _L), ("season_name", _S))),
    ("home_team", _st(("home_team_id", _L), ("home_team_name", _S))),
    ("away_team", _st(("away_team_id", _L), ("away_team_name", _S))),
    ("home_score", _L), ("away_score", _L),
)
EVENT_SCHEMA = _st(
    ("id", _S), ("index", _I), ("period", _I), ("minute", _I), ("second", _I),
    ("type", _REF), ("team", _REF), ("player", _REF), ("possession_team", _REF),
    ("location", T.ArrayType(_D)),
    ("pass", _st(("outcome", _REF), ("end_location", T.ArrayType(_D)))),
    ("shot", _st(("statsbomb_xg", _D), ("outcome", _REF), ("end_location", T.ArrayType(_D)))),
    ("duel", _st(("type", _REF),)),
    ("under_pressure", _B), ("duration", _D),
)
LINEUP_SCHEMA = _st(
    ("team_id", _L), ("team_name", _S),
    ("lineup", T.ArrayType(_st(("player_id", _L), ("player_name", _S)))),
)


def read_matches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MATCH_SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(path)


def normalize_matches(raw: DataFrame) -> DataFrame:
    """Match list -> dim_matches (kick-off defaults to midnight, scores to 0)."""
    return raw.select(
        "match_id",
        F.to_date("match_date").alias("match_date"),
        F.coalesce("kick_off", F.lit("00:00:00")).alias("kick_off"),
        F.col("competition.competition_id").alias("competition_id"),
        F.col("competition.competition_name").alias("competition_name"),
        F.col("season.season_id").alias("season_id"),
        F.col("season.season_name").alias("season_name"),
        F.col("home_team.home_team_id").alias("home_team_id"),
        F.col("home_team.home_team_name").alias("home_team_name"),
        F.col("away_team.away_team_id").alias("away_team_id"),
        F.col("away_team.away_team_name").alias("away_team_name"),
        F.coalesce("home_score", F.lit(0)).cast("long").alias("home_score"),
        F.coalesce("away_score", F.lit(0)).cast("long").alias("away_score"),
    )


def normalize_teams(matches: DataFrame) -> DataFrame:
    """Home and away (id, name) pairs; the first occurrence per team id wins
    under the explicit order (all home sides before all away sides, match date, match id)."""
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("home_team_id").alias("team_id"), F.col("home_team_name").alias("team_name")),
        F.struct(F.lit(1).alias("side"), F.col("away_team_id").alias("team_id"), F.col("away_team_name").alias("team_name")),
    )
    pairs = matches.select("match_date", "match_id", F.inline(sides))
    firsts = dedupe_first(pairs, ["team_id"], ["side", "match_date", "match_id"])
    return firsts.select("team_id", "team_name")


def _match_id_from_file() -> Column:
    return F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\.json$", 1).cast("long")


def _match_files(folder: str, match_ids: Sequence[int] | None) -> list[str]:
    return [f"{folder}/*.json"] if match_ids is None else [f"{folder}/{i}.json" for i in match_ids]


def read_events(spark: SparkSession, events_dir: str, match_ids: Sequence[int] | None = None) -> DataFrame:
    """The event files of a folder (all, or those of ``match_ids``), each row tagged with its file's match id."""
    raw = spark.read.schema(EVENT_SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(_match_files(events_dir, match_ids))
    return raw.withColumn("_match_id", _match_id_from_file())


def _clock(kickoff: Column, minute: Column, second: Column) -> Column:
    return kickoff + F.make_dt_interval(F.lit(0), F.lit(0), minute, second.cast("decimal(18,6)"))


def normalize_events(raw: DataFrame, matches: DataFrame) -> DataFrame:
    """Events -> fact_match_events. ``event_ts`` = kick-off + match clock (no
    half-time gap); nested ids/names, coordinates by index (NULL when short),
    pass outcome defaults to 'Complete' on every event, end location is the
    pass's else the shot's."""
    m = matches.select(
        F.col("match_id").alias("_match_id"),
        F.to_timestamp(F.concat_ws(" ", F.col("match_date").cast("string"), F.col("kick_off"))).cast("timestamp_ntz").alias("_kickoff"),
    )
    e = raw.join(m, "_match_id")  # one row per match on the right: broadcast-sized
    minute = F.coalesce("minute", F.lit(0))
    second = F.coalesce("second", F.lit(0))
    pass_end = F.col("pass.end_location")
    end_loc = F.when(F.coalesce(F.size(pass_end), F.lit(0)) > 0, pass_end).otherwise(F.col("shot.end_location"))
    return e.select(
        F.col("id").alias("event_id"),
        F.col("_match_id").alias("match_id"),
        F.coalesce("index", F.lit(0)).alias("event_index"),
        _clock(F.col("_kickoff"), minute, second).alias("event_ts"),
        F.coalesce("period", F.lit(1)).alias("period"),
        minute.alias("minute"),
        second.alias("second"),
        F.col("type.name").alias("event_type"),
        F.col("team.id").alias("team_id"),
        F.col("player.id").alias("player_id"),
        F.col("possession_team.id").alias("possession_team_id"),
        F.get(F.col("location"), 0).alias("x"),
        F.get(F.col("location"), 1).alias("y"),
        F.get(end_loc, 0).alias("end_x"),
        F.get(end_loc, 1).alias("end_y"),
        F.col("shot.statsbomb_xg").alias("shot_xg"),
        F.col("shot.outcome.name").alias("shot_outcome"),
        F.coalesce(F.col("pass.outcome.name"), F.lit("Complete")).alias("pass_outcome"),
        F.col("duel.type.name").alias("duel_type"),
        F.coalesce("under_pressure", F.lit(False)).alias("under_pressure"),
        F.coalesce("duration", F.lit(0.0)).alias("duration_seconds"),
    )


def read_lineups(spark: SparkSession, lineups_dir: str, match_ids: Sequence[int] | None = None) -> DataFrame:
    """Lineup files read whole (one row per file) so array positions are kept."""
    raw = spark.read.option("wholetext", True).text(_match_files(lineups_dir, match_ids))
    raw = raw.withColumn("_match_id", _match_id_from_file())
    teams = raw.select("_match_id", F.posexplode(F.from_json("value", T.ArrayType(LINEUP_SCHEMA), {"mode": "FAILFAST"})).alias("_team_pos", "t"))
    return teams.select("_match_id", "_team_pos", "t.*")


def normalize_lineups(raw: DataFrame) -> DataFrame:
    """One row per listed player (a team without a lineup yields no rows)."""
    p = raw.select("_match_id", "_team_pos", "team_id", "team_name",
                   F.posexplode("lineup").alias("_player_pos", "pl"))
    return p.select(
        "_match_id", "_team_pos", "_player_pos",
        F.col("pl.player_id").alias("player_id"), F.col("pl.player_name").alias("player_name"),
        "team_id", "team_name",
    )


def football_tables(matches: DataFrame, raw_events: DataFrame, raw_lineups: DataFrame, max_matches: int | None = None) -> dict[str, DataFrame]:
    """Star tables from normalised matches and raw events and lineups (tagged with ``_match_id``): all matches, or the
    last ``max_matches`` by (date, id). A player's first listing in (date, match, team, lineup) order stands."""
    if max_matches is not None:
        matches = matches.orderBy(F.desc("match_date"), F.desc("match_id")).limit(max_matches)
        kept_ids = matches.select(F.col("match_id").alias("_match_id"))
        raw_events = raw_events.join(kept_ids, "_match_id", "left_semi")
        raw_lineups = raw_lineups.join(kept_ids, "_match_id", "left_semi")
    order = matches.select(F.col("match_id").alias("_match_id"), "match_date")
    players = dedupe_first(
        normalize_lineups(raw_lineups).join(order, "_match_id"), ["player_id"], ["match_date", "_match_id", "_team_pos", "_player_pos"]
    ).select("player_id", "player_name", "team_id", "team_name")
    return {
        "dim_matches": matches,
        "dim_teams": normalize_teams(matches),
        "dim_players": players,
        "fact_match_events": normalize_events(raw_events, matches),
    }


def _load_last(spark: SparkSession, root: str, matches_file: str, max_matches: int) -> dict[str, DataFrame]:
    matches = normalize_matches(read_matches(spark, f"{root}/{matches_file}"))
    kept = matches.orderBy(F.desc("match_date"), F.desc("match_id")).limit(max_matches)
    ids = [r.match_id for r in kept.select("match_id").collect()]
    if not ids:
        raise ValueError(f"no matches in {matches_file}")
    kept = matches.where(F.col("match_id").isin(ids))
    return football_tables(kept, read_events(spark, f"{root}/events", ids), read_lineups(spark, f"{root}/lineups", ids))


def load_football_data(spark: SparkSession, root: str, max_matches: int) -> dict[str, DataFrame]:
    """The last ``max_matches`` matches of ``matches.json`` with their events, teams and players; only the event and lineup
    files of those matches are read. The driver holds the kept match ids, at most ``max_matches``; a missing file fails the
    read."""
    return _load_last(spark, root, "matches.json", max_matches)


def load_season(spark: SparkSession, root: str, competition_id: int, season_id: int, max_matches: int) -> dict[str, DataFrame]:
    """The same for ``matches/<competition>/<season>.json``."""
    return _load_last(spark, root, f"matches/{competition_id}/{season_id}.json", max_matches)
