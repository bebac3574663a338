"""A second by second replay of one game with plain sets, used as the answer in tests."""

from collections import defaultdict
from itertools import combinations


def replay(rows, changes_only=False):
    """rows: dicts with Event, elapsedTime, eventTeam, player1Id, isGoalie, xG.

    Returns (pieces, plays): (seconds, label, skaters, goalies) per piece and (row, label, skaters,
    goalies) per play, both with the sets of both teams by name.
    """
    if changes_only:
        rows = [r for r in rows if r["Event"] in ("ON", "OFF")]
    teams = sorted({r["eventTeam"] for r in rows if r["eventTeam"] is not None})
    if len(teams) != 2:
        return [], []
    a, b = teams
    skaters, goalies = {a: set(), b: set()}, {a: set(), b: set()}
    by_second = defaultdict(list)
    for r in rows:
        if r["elapsedTime"] is not None:
            by_second[r["elapsedTime"]].append(r)

    def state():
        label = "v".join(f"{len(skaters[t])}{'' if goalies[t] else '*'}" for t in teams)
        return label, {t: frozenset(skaters[t]) for t in teams}, {t: frozenset(goalies[t]) for t in teams}

    pieces, plays, last = [], [], 0
    for t in sorted(by_second):
        here = by_second[t]
        plays += [(r, *state()) for r in here if r["Event"] not in ("ON", "OFF")]
        if t > last:
            pieces.append((t - last, *state()))
            last = t
        for code in ("OFF", "ON"):
            for r in here:
                if r["Event"] == code and r["eventTeam"] is not None and r["player1Id"] is not None:
                    side = (goalies if r["isGoalie"] == 1 else skaters)[r["eventTeam"]]
                    (side.discard if code == "OFF" else side.add)(r["player1Id"])
    return pieces, plays


def team_toi(rows):
    out = defaultdict(int)
    for seconds, label, _, _ in replay(rows, changes_only=True)[0]:
        out[label] += seconds
    return dict(out)


def player_toi(rows, changes_only=True):
    out = defaultdict(int)
    for seconds, label, skaters, goalies in replay(rows, changes_only)[0]:
        for t in skaters:
            for p in [*skaters[t], *goalies[t]]:
                out[p, label] += seconds
    return dict(out)


def combo_toi(rows, n):
    """Own-side label: the two halves swapped for the second team."""
    out = defaultdict(int)
    for seconds, label, skaters, _ in replay(rows)[0]:
        left, right = label.split("v")
        for i, t in enumerate(sorted(skaters)):
            own = f"{left}v{right}" if i == 0 else f"{right}v{left}"
            for c in combinations(sorted(skaters[t]), n):
                out[t, c, own] += seconds
    return dict(out)


def player_corsi(rows):
    """(player, label) -> [for, against] where there is time."""
    out = defaultdict(lambda: [0, 0])
    for r, label, skaters, _ in replay(rows)[1]:
        if r["Event"] not in ("SHOT", "GOAL", "MISS", "BLOCK") or r["eventTeam"] not in skaters:
            continue
        for t in skaters:
            ours = (t == r["eventTeam"]) != (r["Event"] == "BLOCK")
            for p in skaters[t]:
                out[p, label][0 if ours else 1] += 1
    timed = {k for k in _skater_time(rows)}
    return {k: tuple(v) for k, v in out.items() if k in timed}


def _skater_time(rows):
    out = defaultdict(int)
    for seconds, label, skaters, _ in replay(rows)[0]:
        for t in skaters:
            for p in skaters[t]:
                out[p, label] += seconds
    return out
