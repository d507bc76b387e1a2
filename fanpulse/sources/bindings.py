"""Present the generic test tables in the canonical product schema.

This is the only module that knows the raw table names. Every canonical
table is a lazy Spark plan over the raw Parquet tables, so its size grows
with them; nothing is synthesised on the driver. The same mapping is
written in DuckDB SQL in ``fanpulse.plans.oracle`` for the cross-engine
check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fanpulse.functions.scalar import campaign_key, col
from fanpulse.schemas import CONTENT_TYPES, PAID_CHANNELS

# Fixed values of the binding (chosen for the test data, not derived):
# market segment -> acquisition channel, daily target spend per paid channel,
# signup epoch, match calendar start and the experiment name.
SEGMENT_CHANNEL = {
    "AUTOMOBILE": "organic",
    "BUILDING": "paid_search",
    "FURNITURE": "social",
    "HOUSEHOLD": "partner",
    "MACHINERY": "referral",
}
DAILY_TARGET_SPEND = {"paid_search": 2568.0, "social": 1926.0, "partner": 1105.67}
SIGNUP_EPOCH = "2023-12-20"
MATCH_EPOCH = "2024-01-05"
EVENT_EPOCH = "2024-01-01"
EXPERIMENT = "match_center_v2"
FOLLOWED = 8  # matches that a user's events are about, next to each other in number
MATCH_DAYS = 8  # match days of the calendar, three days apart


def _channel(segment: Column) -> Column:
    expr = None
    for seg, channel in SEGMENT_CHANNEL.items():
        expr = (F.when(segment == seg, channel) if expr is None else expr.when(segment == seg, channel))
    return expr


def _platform(user_id: Column) -> Column:
    r = F.pmod(user_id, F.lit(3))
    return F.when(r == 0, "android").when(r == 1, "ios").otherwise("web")


def _variant(user_id: Column) -> Column:
    return F.when(F.pmod(user_id, F.lit(2)) == 0, "control").otherwise("treatment")


def _match_count(supplier: DataFrame) -> Column:
    """Matches and teams there are: one for each supplier, so their number grows with the data."""
    return supplier.agg(F.count(F.lit(1))).scalar()


def app_events(events: DataFrame, customer: DataFrame, supplier: DataFrame) -> DataFrame:
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    e = events.select(
        "event_id", "user_id", F.col("ts").alias("event_ts"), "event_type", "value", k.alias("_k")
    )
    c = customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("_seg"))
    j = e.join(c, "user_id", "left")
    m = F.pmod(F.col("user_id") + F.pmod(F.floor(F.col("_k") / 4), F.lit(FOLLOWED)), _match_count(supplier))
    name = (
        F.when((F.col("event_type") == "purchase") & (F.col("value") < 5), "subscription_cancel")
        .when(F.col("event_type") == "purchase", "subscription_start")
        .when(F.col("event_type") == "signup", "notification_click")
        .when(F.col("event_type") == "view", "match_center_view")
        .when(F.col("event_type") == "click", "highlight_view")
        .when((F.col("event_type") == "error") & (F.pmod(F.col("_k"), F.lit(2)) == 0), "app_open")
        .when(F.col("event_type") == "error", "content_view")
    )
    j = j.withColumns({"event_name": name, "match_id": m.cast("long"),
                       "event_date": F.to_date("event_ts")})
    prefix = F.concat(F.lit("C"), F.col("match_id").cast("string"), F.lit("_"))
    content = (
        F.when(F.col("event_name") == "match_center_view", F.concat(prefix, F.lit("match_center")))
        .when(F.col("event_name") == "highlight_view", F.concat(prefix, F.lit("highlight")))
        .when(
            F.col("event_name") == "content_view",
            F.concat(prefix, F.when(F.pmod(F.col("_k"), F.lit(4)) == 1, "live_blog").otherwise("player_story")),
        )
    )
    channel = _channel(F.col("_seg"))
    session = F.concat_ws(
        "-", F.col("user_id").cast("string"), F.col("event_date").cast("string"),
        F.floor(F.hour("event_ts") / 6).cast("string"),
    )
    revenue = (
        F.when(F.col("event_name") == "subscription_start", 9.99)
        .when(F.col("event_name") == "subscription_cancel", -9.99)
        .otherwise(0.0)
    )
    out = j.withColumn("acquisition_channel", channel)
    return out.select(
        "event_id", "user_id", session.alias("session_id"), "event_ts", "event_date", "event_name",
        "match_id", content.alias("content_id"), _platform(F.col("user_id")).alias("platform"),
        "acquisition_channel", _variant(F.col("user_id")).alias("experiment_variant"),
        campaign_key("acquisition_channel", "event_date", PAID_CHANNELS).alias("campaign_id"),
        revenue.alias("revenue_usd"), "value",
    )


def dim_users(customer: DataFrame, nation: DataFrame) -> DataFrame:
    n = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    c = customer.join(n, "c_nationkey", "left")
    return c.select(
        F.col("c_custkey").alias("user_id"),
        F.date_add(F.lit(SIGNUP_EPOCH).cast("date"), F.pmod("c_custkey", F.lit(30)).cast("int")).alias("signup_date"),
        _channel(F.col("c_mktsegment")).alias("acquisition_channel"),
        _platform(F.col("c_custkey")).alias("platform"),
        "country",
        F.when(F.col("c_acctbal") > 5000, "premium").otherwise("free").alias("subscription_tier"),
    )


def dim_matches(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """A match per supplier: at home against the next one, the last against the first; the competition is the home region."""
    mid = F.col("s_suppkey")
    away_id = F.pmod(mid + 1, _match_count(supplier))
    home = supplier.select(mid.alias("match_id"), F.col("s_name").alias("home_team_name"), F.col("s_nationkey").alias("n_nationkey"),
                           away_id.alias("away_team_id"))
    away = supplier.select(mid.alias("away_team_id"), F.col("s_name").alias("away_team_name"))
    r = region.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("competition_name"))
    j = home.join(away, "away_team_id").join(nation.select("n_nationkey", "n_regionkey"), "n_nationkey", "left").join(r, "n_regionkey", "left")
    mid = F.col("match_id")
    return j.select(
        "match_id",
        F.date_add(F.lit(MATCH_EPOCH).cast("date"), (F.pmod(mid, F.lit(MATCH_DAYS)) * 3).cast("int")).alias("match_date"),
        F.lit("00:00:00").alias("kick_off"),
        F.col("n_regionkey").cast("long").alias("competition_id"),
        "competition_name",
        F.lit(1).cast("long").alias("season_id"),
        F.lit("2024").alias("season_name"),
        mid.alias("home_team_id"),
        "home_team_name",
        "away_team_id",
        "away_team_name",
        F.pmod(mid, F.lit(3)).alias("home_score"),
        F.pmod("away_team_id", F.lit(3)).alias("away_score"),
    )


def dim_content(matches: DataFrame) -> DataFrame:
    types = F.array(*[F.lit(t) for t in CONTENT_TYPES])
    m = matches.select("match_id", "match_date", "home_team_id", F.explode(types).alias("content_type"))
    return m.select(
        F.concat(F.lit("C"), F.col("match_id").cast("string"), F.lit("_"), F.col("content_type")).alias("content_id"),
        "match_id", "content_type",
        F.col("match_date").cast("timestamp_ntz").alias("published_at"),
        F.col("home_team_id").alias("team_id"),
        F.lit(None).cast("long").alias("player_id"),
    )


def match_events(orders: DataFrame, supplier: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    offset = F.pmod(key * 29, F.lit(43200))
    prio = F.substring("o_orderpriority", 1, 1)
    etype = (
        F.when(prio == "1", "Shot").when(prio == "2", "Pass").when(prio == "3", "Duel")
        .when(prio == "4", "Substitution").when(prio == "5", "Bad Behaviour")
    )
    status = F.col("o_orderstatus")
    is_shot, is_pass, is_duel = etype == "Shot", etype == "Pass", etype == "Duel"
    matches = _match_count(supplier)
    match_id = F.pmod(key, matches)
    team = F.pmod(match_id + F.pmod("o_custkey", F.lit(2)), matches)
    return orders.select(
        key.alias("event_id"),
        match_id.alias("match_id"),
        key.cast("int").alias("event_index"),
        (F.lit(EVENT_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), offset.cast("int"))).alias("event_ts"),
        (1 + F.pmod(key, F.lit(5))).cast("int").alias("period"),
        F.pmod(offset, F.lit(120)).cast("int").alias("minute"),
        F.lit(0).alias("second"),
        etype.alias("event_type"),
        team.alias("team_id"),
        F.pmod("o_custkey", F.lit(100)).alias("player_id"),
        F.when(F.pmod(key, F.lit(11)) != 0, team).alias("possession_team_id"),
        F.pmod(key, F.lit(121)).cast("double").alias("x"),
        F.pmod(key, F.lit(81)).cast("double").alias("y"),
        F.lit(None).cast("double").alias("end_x"),
        F.lit(None).cast("double").alias("end_y"),
        F.when(is_shot, F.pmod(key * 37, F.lit(101)) / 100.0).alias("shot_xg"),
        F.when(is_shot, F.when(status == "F", "Goal").when(status == "O", "Saved").otherwise("Blocked")).alias("shot_outcome"),
        F.when(is_pass, F.when(status == "P", "Incomplete").otherwise("Complete")).alias("pass_outcome"),
        F.when(is_duel, F.when(status == "F", "Tackle").otherwise("Aerial Lost")).alias("duel_type"),
        (F.col("o_totalprice") > 100000).alias("under_pressure"),
        F.lit(0.0).alias("duration_seconds"),
    )


def campaign_spend(lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    paid = [s for s, ch in SEGMENT_CHANNEL.items() if ch in PAID_CHANNELS]
    c = customer.where(F.col("c_mktsegment").isin(*paid)).select(
        F.col("c_custkey").alias("o_custkey"), _channel(F.col("c_mktsegment")).alias("channel")
    )
    o = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey").join(c, "o_custkey")
    li = lineitem.select("l_orderkey", "l_quantity", "l_extendedprice", "l_tax").join(o, "l_orderkey")
    li = li.withColumn(
        "spend_date", F.date_add(F.lit(SIGNUP_EPOCH).cast("date"), F.pmod("l_orderkey", F.lit(30)).cast("int"))
    )
    g = li.groupBy("spend_date", "channel").agg(
        F.sum("l_quantity").cast("long").alias("clicks"),
        F.count(F.lit(1)).alias("installs"),
        F.round(F.sum(F.col("l_extendedprice") * F.col("l_tax")) / 1000, 2).alias("spend_usd"),
    )
    target = None
    for ch, v in DAILY_TARGET_SPEND.items():
        target = F.when(F.col("channel") == ch, F.lit(v)) if target is None else target.when(F.col("channel") == ch, F.lit(v))
    return g.select(
        "spend_date",
        campaign_key("channel", "spend_date", PAID_CHANNELS).alias("campaign_id"),
        "channel",
        (F.col("clicks") * 50).alias("impressions"),
        "clicks", "installs", "spend_usd",
        target.alias("target_spend_usd"),
    )


def experiment_assignments(users: DataFrame) -> DataFrame:
    return users.select(
        "user_id",
        F.lit(EXPERIMENT).alias("experiment_name"),
        _variant(F.col("user_id")).alias("variant"),
        F.col("signup_date").cast("timestamp_ntz").alias("assigned_at"),
    )


def dim_teams(supplier: DataFrame) -> DataFrame:
    return supplier.select(F.col("s_suppkey").alias("team_id"), F.col("s_name").alias("team_name"))


def dim_players(customer: DataFrame, supplier: DataFrame) -> DataFrame:
    p = customer.select(
        F.col("c_custkey").alias("player_id"), F.col("c_name").alias("player_name"),
        F.pmod("c_custkey", _match_count(supplier)).alias("team_id"),
    )
    return p.join(dim_teams(supplier), "team_id", "left").select("player_id", "player_name", "team_id", "team_name")


def dim_date_from(users: DataFrame, events: DataFrame) -> DataFrame:
    from fanpulse.operators.calendar import date_dimension

    # one global aggregate over both inputs: signup min .. event max
    both = users.select(F.col("signup_date").alias("lo"), F.lit(None).cast("date").alias("hi")).unionByName(
        events.select(F.lit(None).cast("date").alias("lo"), F.col("event_date").alias("hi"))
    )
    span = both.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return date_dimension(span, "lo", "hi")


class CanonicalTables(dict):
    """Lazy mapping of the ten canonical tables over one test-data folder.

    A table's plan is built on first access only and then reused; no job runs.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._raw[name]

    _BUILD = {
        "dim_users": lambda t: dim_users(t.raw("customer"), t.raw("nation")),
        "fact_app_events": lambda t: app_events(t.raw("events"), t.raw("customer"), t.raw("supplier")),
        "dim_matches": lambda t: dim_matches(t.raw("supplier"), t.raw("nation"), t.raw("region")),
        "dim_date": lambda t: dim_date_from(t["dim_users"], t["fact_app_events"]),
        "dim_teams": lambda t: dim_teams(t.raw("supplier")),
        "dim_players": lambda t: dim_players(t.raw("customer"), t.raw("supplier")),
        "dim_content": lambda t: dim_content(t["dim_matches"]),
        "fact_match_events": lambda t: match_events(t.raw("orders"), t.raw("supplier")),
        "fact_campaign_spend": lambda t: campaign_spend(t.raw("lineitem"), t.raw("orders"), t.raw("customer")),
        "fact_experiment_assignments": lambda t: experiment_assignments(t["dim_users"]),
    }

    def __missing__(self, name: str) -> DataFrame:
        if name not in self._BUILD:
            raise KeyError(name)
        self[name] = df = self._BUILD[name](self)
        return df

    def keys(self):  # every canonical table counts as present
        return self._BUILD.keys()

    def __contains__(self, name) -> bool:
        return name in self._BUILD

    def __iter__(self):
        return iter(self._BUILD)

    def __len__(self) -> int:
        return len(self._BUILD)

    def items(self):
        return [(k, self[k]) for k in self._BUILD]

    def values(self):
        return [self[k] for k in self._BUILD]


def canonical_tables(spark: SparkSession, sf_dir: str) -> CanonicalTables:
    """All ten canonical tables over ``sf_dir``, as plans: building a query starts no job and writes nothing."""
    return CanonicalTables(spark, sf_dir)


__all__ = ["canonical_tables", "col"]
