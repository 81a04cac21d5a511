"""Small XES logs written by the tests (edge cases the reference fixture lacks)."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

HEADER = ('<?xml version="1.0" encoding="UTF-8"?>\n'
          '<log xmlns="http://www.xes-standard.org/" xes.version="2016">\n'
          '\t<string key="origin" value="test"/>\n')


def attr(tag, key, value):
    return f'<{tag} key="{key}" value="{value}"/>'


def event(activity, ts, index=None, win=None, amount="1", extra=()):
    parts = []
    if activity is not None:
        parts.append(attr("string", "concept:name", activity))
    if ts is not None:
        parts.append(attr("date", "time:timestamp", ts))
    if win is not None:
        parts.append(attr("int", "win", win))
    if amount is not None:
        parts.append(attr("int", "amount", amount))
    if index is not None:
        parts.append(attr("int", "@@index", index))
    parts.extend(extra)
    return "\t\t<event>\n\t\t\t" + "\n\t\t\t".join(parts) + "\n\t\t</event>\n"


def trace(case, attrs, events, attrs_after=()):
    head = "".join(f"\t\t{a}\n" for a in [attr("string", "concept:name", case)] + list(attrs))
    tail = "".join(f"\t\t{a}\n" for a in attrs_after)
    return "\t<trace>\n" + head + "".join(events) + tail + "\t</trace>\n"


def iso(base, seconds, fraction=True):
    t = base + timedelta(seconds=seconds)
    return t.isoformat(timespec="microseconds" if fraction else "seconds") + "+00:00"


def edge_log() -> str:
    """Traces covering NULL/junk casts, ties, missing index, filtered first events…"""
    b = datetime(2023, 1, 1)
    acts = ["Queue Villager", "Build House", "Upgrade Feudal Age", "Queue Villager", "Build Barracks",
            "Upgrade Castle Age", "Queue Archer"]
    out = []
    common = lambda m, p, civ, strat, elo: [
        attr("string", "match_id", m), attr("string", "player_id", p), attr("string", "map_type", "Arabia"),
        attr("string", "civilization", civ), attr("string", "civilization_category", "Cavalry"),
        attr("string", "strategy", strat), attr("float", "elo", elo)]
    # t1: 130 events, one at exactly 600 s, one just after; amount forms; tie
    ev = []
    for i in range(130):
        sec = {60: 600.0, 61: 600.000001}.get(i, i * 4.0 if i < 60 else 700 + i)
        ev.append(event(acts[i % len(acts)], iso(b, sec), index=1000 + i, win="1",
                        amount=["1.5", "1e3", " 3 ", "x", "2"][i % 5]))
    ev.append(event("Queue Villager", iso(b, 4.0), index=2000, win="1"))  # tie with i=1
    out.append(trace("c1", common("m1", "p1", "Britons", "drush", "1500.0"), ev))
    # t2: first event lacks activity (filtered, moves start), missing @@index, win 'True'
    ev = [event(None, iso(b, 0), index=100), event("Queue Villager", iso(b, 10, False), win="True"),
          event("Upgrade Feudal Age", iso(b, 70), win="True"), event("Build House", iso(b, 80), win="True")]
    out.append(trace("c2", common("m2", "p1", "Britons", "Unknown", "junk"), ev))
    # t3: trace attribute after events, NULL win, non-ASCII before "age", escaped value
    ev = [event("Queue Villager", iso(b, 0), index=1, win="maybe"),
          event("éage Start", iso(b, 5), index=2, win="maybe"),
          event("Research &amp; Age Test", iso(b, 9), index=3, win="maybe")]
    out.append(trace("c3", common("m3", "p2", "Mayans", "Unknown", "1200.0")[:-1], ev,
                     attrs_after=[attr("float", "elo", "1300.0")]))
    # t4: same match as t3, other player, two win values in one match, no strategy
    ev = [event("Queue Villager", iso(b, 0), index=1, win="0"), event("Build House", iso(b, 1), index=2, win="1")]
    out.append(trace("c4", common("m3", "p3", "Mayans", "Unknown", "1250.0")[:5] + [attr("float", "elo", "1250.0")], ev))
    # t5: no match_id at all (all events filtered)
    ev = [event("Queue Villager", iso(b, 0), index=1, win="1")]
    out.append(trace("c5", [attr("string", "player_id", "p9")], ev))
    # t6, t7: identical short sequences; t8 single action
    for case, m in (("c6", "m6"), ("c7", "m7")):
        ev = [event("Queue Villager", iso(b, 0), index=1, win="FALSE"), event("Build House", iso(b, 2), index=2, win="FALSE")]
        out.append(trace(case, common(m, "p4", "Franks", "scout_rush", "1800.0"), ev))
    ev = [event("Queue Villager", iso(b, 0), index=1, win="0")]
    out.append(trace("c8", common("m8", "p5", "Franks", "scout_rush", "1900.0"), ev))
    return HEADER + "".join(out) + "</log>\n"


def write_log(folder: str, name: str, text: str) -> str:
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path
