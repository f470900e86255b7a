"""Hand-built match documents."""

import copy
import json


def ball(batter="A1", bowler="B1", non_striker="A2", runs=0, extras=None, wickets=None):
    extras = extras or {}
    extra_runs = sum(extras.values())
    delivery = {
        "batter": batter,
        "bowler": bowler,
        "non_striker": non_striker,
        "runs": {"batter": runs, "extras": extra_runs, "total": runs + extra_runs},
    }
    if extras:
        delivery["extras"] = extras
    if wickets is not None:
        delivery["wickets"] = wickets
    return delivery


def innings(team, *overs, super_over=None):
    inning = {
        "team": team,
        "overs": [{"over": n, "deliveries": list(balls)} for n, balls in enumerate(overs)],
    }
    if super_over is not None:
        inning["super_over"] = super_over
    return inning


def document(*all_innings, revision=1, season="2016", outcome=None, **info):
    squads = {"A": ["A1", "A2", "A3"], "B": ["B1", "B2", "B3"]}
    people = {name: f"id-{name}" for squad in squads.values() for name in squad}
    people["Umpire"] = "id-umpire"
    doc = {
        "meta": {"data_version": "1.1.0", "created": "2016-04-10", "revision": revision},
        "info": {
            "season": season,
            "dates": ["2016-04-09", "2016-04-10"],
            "venue": "Ground",
            "city": "Town",
            "event": {"match_number": 7},
            "teams": ["A", "B"],
            "toss": {"winner": "A", "decision": "bat"},
            "outcome": outcome or {"winner": "A", "by": {"runs": 12}},
            "player_of_match": ["A1"],
            "registry": {"people": people},
            "players": squads,
        },
        "innings": list(all_innings),
    }
    doc["info"].update(info)
    return copy.deepcopy(doc)


def write(folder, **documents):
    """One file per match; returns the folder as text."""
    folder.mkdir(parents=True, exist_ok=True)
    for match_id, doc in documents.items():
        (folder / f"{match_id}.json").write_text(json.dumps(doc))
    return str(folder)


def rows(df, *names):
    """Rows as sorted tuples, NULLs first."""
    picked = [tuple(row) for row in (df.select(*names) if names else df).collect()]
    return sorted(picked, key=lambda row: tuple((v is not None, v) for v in row))
