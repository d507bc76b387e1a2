import json
import os

import pytest

from fanpulse.sources.ingest import (load_football_data, load_season, normalize_events, normalize_lineups, normalize_matches,
                                     normalize_teams, read_events, read_lineups, read_matches)

MATCH = {"match_id": 7, "match_date": "2031-05-09", "kick_off": "21:15:00.000",
         "competition": {"competition_id": 5, "competition_name": "Harbour Cup"},
         "season": {"season_id": 61, "season_name": "2031"},
         "home_team": {"home_team_id": 1, "home_team_name": "Tideford"},
         "away_team": {"away_team_id": 2, "away_team_name": "Marlow Bay"}, "home_score": 3, "away_score": 4}
MATCH2 = {"match_id": 8, "match_date": "2031-05-16", "competition": {"competition_id": 5, "competition_name": "Harbour Cup"},
          "season": {"season_id": 61, "season_name": "2031"},
          "home_team": {"home_team_id": 2, "home_team_name": "Marlow Bay FC"},
          "away_team": {"away_team_id": 3, "away_team_name": "Stonewick"}}
EVENTS = [
    {"id": "k-17", "index": 812, "minute": 73, "second": 41, "period": 2, "type": {"id": 1, "name": "Shot"},
     "team": {"id": 1, "name": "Tideford"}, "player": {"id": 9, "name": "Oda Brandt"},
     "possession_team": {"id": 1, "name": "Tideford"}, "location": [97.5, 22.0],
     "shot": {"statsbomb_xg": 0.0625, "outcome": {"id": 2, "name": "Saved"}, "end_location": [118.5, 33.25]}},
    {"id": "k-18", "type": {"id": 3, "name": "Pass"}, "location": [31.5],
     "pass": {"end_location": [44.0, 71.5]}, "under_pressure": True},
]
LINEUPS = [{"team_id": 1, "team_name": "Tideford", "lineup": [{"player_id": 9, "player_name": "Oda Brandt"},
                                                              {"player_id": 10, "player_name": "Ines Cole"}]},
           {"team_id": 2, "team_name": "Marlow Bay", "lineup": [{"player_id": 9, "player_name": "O. Brandt"}]},
           {"team_id": 3, "team_name": "Stonewick"}]


def _write(root):
    os.makedirs(f"{root}/events", exist_ok=True)
    os.makedirs(f"{root}/lineups", exist_ok=True)
    json.dump([MATCH, MATCH2], open(f"{root}/matches.json", "w"))
    json.dump(EVENTS, open(f"{root}/events/7.json", "w"))
    json.dump([], open(f"{root}/events/8.json", "w"))
    json.dump(LINEUPS, open(f"{root}/lineups/7.json", "w"))
    json.dump([], open(f"{root}/lineups/8.json", "w"))


def test_normalize_all(spark, tmp_path):
    root = str(tmp_path)
    _write(root)
    matches = normalize_matches(read_matches(spark, f"{root}/matches.json"))
    m = {r.match_id: r for r in matches.collect()}
    assert m[8].kick_off == "00:00:00" and m[8].home_score == 0 and m[7].away_score == 4
    ev = {r.event_id: r for r in normalize_events(read_events(spark, f"{root}/events"), matches).collect()}
    e1, e2 = ev["k-17"], ev["k-18"]
    assert e1.shot_xg == 0.0625 and e1.shot_outcome == "Saved" and e1.match_id == 7
    assert e1.event_ts.isoformat() == "2031-05-09T22:28:41"
    assert (e1.x, e1.y, e1.end_x, e1.end_y) == (97.5, 22.0, 118.5, 33.25)
    assert e1.pass_outcome == "Complete"             # default on every event, also shots
    assert (e2.x, e2.y, e2.end_x, e2.period, e2.minute, e2.event_index) == (31.5, None, 44.0, 1, 0, 0)
    assert e2.under_pressure and e2.duration_seconds == 0.0 and not e1.under_pressure
    teams = [(r.team_id, r.team_name) for r in normalize_teams(matches).orderBy("team_id").collect()]
    assert teams == [(1, "Tideford"), (2, "Marlow Bay FC"), (3, "Stonewick")]  # home sides come first
    players = normalize_lineups(read_lineups(spark, f"{root}/lineups")).collect()
    assert len(players) == 3 and {p.team_name for p in players} == {"Tideford", "Marlow Bay"}


def test_load_football_data_keeps_last_matches_and_first_player(spark, tmp_path):
    root = str(tmp_path)
    _write(root)
    data = load_football_data(spark, root, max_matches=2)
    assert data["dim_matches"].count() == 2 and data["fact_match_events"].count() == 2
    players = {r.player_id: r.player_name for r in data["dim_players"].collect()}
    assert players == {9: "Oda Brandt", 10: "Ines Cole"}          # first occurrence wins
    one = load_football_data(spark, root, max_matches=1)
    assert [r.match_id for r in one["dim_matches"].collect()] == [8]
    assert one["fact_match_events"].count() == 0


def test_load_football_data_reads_only_its_own_files(spark, tmp_path):
    root = str(tmp_path)
    _write(root)
    for folder in ("events", "lineups"):
        open(f"{root}/{folder}/99.json", "w").write("[{")  # another match's broken file is never opened
    os.remove(f"{root}/events/7.json")
    data = load_football_data(spark, root, max_matches=1)
    files = {f.rsplit("/", 1)[-1] for f in data["fact_match_events"].inputFiles()}
    assert files == {"8.json", "matches.json"} and data["dim_players"].count() >= 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_football_data(spark, root, max_matches=2)


def test_load_season_reads_only_its_own_files(spark, tmp_path):
    root = str(tmp_path)
    _write(root)
    os.makedirs(f"{root}/matches/5")
    json.dump([MATCH, MATCH2], open(f"{root}/matches/5/61.json", "w"))
    json.dump([], open(f"{root}/matches/5/62.json", "w"))
    open(f"{root}/events/99.json", "w").write("[{")  # another match's broken file is never opened
    data = load_season(spark, root, 5, 61, max_matches=2)
    assert data["dim_matches"].count() == 2 and data["fact_match_events"].count() == 2
    assert {r.player_id for r in data["dim_players"].collect()} == {9, 10}
    os.remove(f"{root}/events/7.json")
    assert load_season(spark, root, 5, 61, max_matches=1)["fact_match_events"].count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_season(spark, root, 5, 61, max_matches=2)
    with pytest.raises(ValueError, match="no matches"):
        load_season(spark, root, 5, 62, max_matches=2)


@pytest.mark.parametrize("part", ["matches", "events/7", "lineups/7"])
def test_truncated_files_raise(spark, tmp_path, part):
    root = str(tmp_path)
    _write(root)
    text = open(f"{root}/{part}.json").read()
    open(f"{root}/{part}.json", "w").write(text[: len(text) // 2])
    read = {"matches": lambda: read_matches(spark, f"{root}/matches.json"), "events/7": lambda: read_events(spark, f"{root}/events"),
            "lineups/7": lambda: read_lineups(spark, f"{root}/lineups")}[part]
    with pytest.raises(Exception, match="MALFORMED"):
        read().collect()
