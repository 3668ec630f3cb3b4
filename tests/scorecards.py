"""Small hand-written scorecards."""

from __future__ import annotations

import json
from pathlib import Path


def ball(batter="A One", bowler="B One", partner="A Two", runs=0, extras=0, wickets=None):
    delivery = {
        "batter": batter, "bowler": bowler, "non_striker": partner,
        "runs": {"batter": runs, "extras": extras, "total": runs + extras},
    }
    if wickets is not None:
        delivery["wickets"] = wickets
    return delivery


def scorecard(number=1, teams=("Alpha", "Beta"), innings=None, **info):
    body = {
        "match_type_number": number, "event": {"name": "Cup", "match_number": 3}, "dates": ["2020-02-01"],
        "match_type": "ODI", "season": "2020", "team_type": "international", "overs": 50, "city": "Town",
        "venue": "Park", "gender": "male", "teams": list(teams), "outcome": {"winner": teams[0] if teams else None},
        "toss": {"winner": teams[0] if teams else None, "decision": "bat"},
        "players": {"Alpha": ["A One", "A Two"], "Beta": ["B One", "B Two"]},
    }
    body.update(info)
    card = {"info": body}
    if innings is not None:
        card["innings"] = innings
    return card


def overs(team, *deliveries, over=0):
    return {"team": team, "overs": [{"over": over, "deliveries": list(deliveries)}]}


def write(folder: Path, cards: dict[str, object]) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    for name, card in cards.items():
        (folder / name).write_text(card if isinstance(card, str) else json.dumps(card))
    return str(folder)
