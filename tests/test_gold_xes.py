"""Silver and gold on XES input, checked against DuckDB running the same statements."""

import os

import duckdb
import pytest

from tests.test_ingest import _split_edge_log
from tests.xes_samples import HEADER, attr, event, iso, trace, write_log
from tools.oracle_check import rows_of
from warband import oracle as O
from warband.plans import gold
from warband.plans.silver import events_clean
from warband.sources.xes import read_xes, write_bronze


def _check(spark_df, con, sql):
    s_cols, s_rows = spark_df.columns, [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols, d_rows = [d[0] for d in res.description], res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert rows_of(s_cols, s_rows, 12) == rows_of(d_cols, d_rows, 12)


CASES = {
    "player_match_results": (lambda s: gold.player_match_results(s), (O.PMR,), "pmr"),
    "player_summary": (lambda s: gold.player_summary(s), (O.PMR, O.USAGE, O.SUMMARY), "summary"),
    "apm": (lambda s: gold.apm(s), (O.apm_cte(600),), "apm"),
    "age_timings": (lambda s: gold.age_timings(s), (O.AGE,), "age"),
    "openings": (lambda s: gold.openings(s), (O.PMR, O.openings_cte(100)), "openings"),
    "winrate_civ": (lambda s: gold.winrate_civ(s), (O.WINRATE_CIV,), "winrate_civ"),
    "winrate_strat": (lambda s: gold.winrate_strat(s), (O.WINRATE_STRAT,), "winrate_strat"),
}


@pytest.fixture(scope="module")
def edge(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("edge"))
    _split_edge_log(os.path.join(folder, "logs"))
    bronze_path = os.path.join(folder, "bronze")
    write_bronze(read_xes(spark, os.path.join(folder, "logs")), bronze_path)
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    bronze_cte = f"bronze AS (SELECT * FROM read_parquet('{bronze_path}/*.parquet'))"
    return events_clean(spark.read.parquet(bronze_path)), con, bronze_cte


def test_silver_edge(edge):
    silver, con, bronze_cte = edge
    _check(silver.drop("event_time"), con,
           O.with_(bronze_cte, O.SILVER) + "SELECT * EXCLUDE (event_time) FROM silver")
    got = {r["event_id"]: r for r in silver.collect()}
    assert got["c1-1000"]["amount"] == 2 and got["c1-1001"]["amount"] == 1000
    assert got["c1-1002"]["amount"] == 3 and got["c1-1003"]["amount"] is None
    assert got["c1-1060"]["seconds_since_start"] == 600.0
    assert got["c2-1"]["seconds_since_start"] == 0.0      # the filtered first event moves the start
    assert got["c2-1"]["elo"] is None and got["c2-1"]["win"] == 1
    assert got["c3-1"]["win"] is None


@pytest.mark.parametrize("name", sorted(CASES))
def test_gold_edge(edge, name):
    silver, con, bronze_cte = edge
    fn, ctes, table = CASES[name]
    _check(fn(silver), con, O.with_(bronze_cte, O.SILVER, *ctes) + f"SELECT * FROM {table}")


def test_edge_semantics(edge):
    silver, _, _ = edge
    apm = {(r.match_id, r.player_id): r.apm for r in gold.apm(silver).collect()}
    assert apm[("m1", "p1")] == 62 * 60.0 / 600        # 600.0 s kept, 600.000001 s not
    ages = {(r.civilization, r.activity) for r in gold.age_timings(silver).collect()}
    assert ("Mayans", "éage Start") in ages and ("Mayans", "Research & Age Test") in ages
    assert not any("Villager" in a for _, a in ages)
    summary = {r.player_id: r for r in gold.player_summary(silver).collect()}
    assert summary["p1"].total_matches == 2 and summary["p1"].total_wins == 2
    assert summary["p2"].total_wins is None and summary["p2"].total_loses is None
    assert summary["p4"].used_strategies == "scout_rush - 2"
    civ = {r.civilization: r for r in gold.winrate_civ(silver).collect()}
    assert civ["Mayans"].total_games == 3            # m3/p3 has two win values: two games
    op = gold.openings(silver).where("match_id = 'm1'").orderBy("action_rank").collect()
    assert len(op) == 100 and op[1].activity == "Build House" and op[2].activity == "Queue Villager"


@pytest.fixture(scope="module")
def golden(spark, tmp_path_factory):
    """Six matches whose figures are known by construction: match k has 10·k events, 30 s apart."""
    from datetime import datetime
    b = datetime(2024, 5, 1)
    folder = str(tmp_path_factory.mktemp("golden"))
    traces = []
    for k in range(1, 7):
        attrs = [attr("string", "match_id", f"m{k}"), attr("string", "player_id", f"p{k % 3}"), attr("string", "map_type", "Arena"),
                 attr("string", "civilization", "Franks" if k % 2 else "Celts"), attr("string", "civilization_category", "Cavalry"),
                 attr("string", "strategy", "drush" if k < 4 else "Unknown"), attr("float", "elo", str(1000.0 + k))]
        acts = {3: "Upgrade Feudal Age", 9: "Upgrade Castle Age"}
        traces.append(trace(f"c{k}", attrs, [event(acts.get(i, "Queue Villager"), iso(b, 30 * i), index=i, win=str(k % 2)) for i in range(10 * k)]))
    write_log(folder, "g.xes", HEADER + "".join(traces) + "</log>\n")
    return events_clean(read_xes(spark, folder))


def test_golden_log(golden):
    s = golden
    assert s.count() == 210
    apm = {r.match_id: r.apm for r in gold.apm(s).collect()}
    assert apm == {f"m{k}": min(10 * k, 21) * 60 / 600 for k in range(1, 7)}         # events at 0, 30, …, 600 s
    assert gold.openings(s, top_n=25).count() == 10 + 20 + 25 * 4
    ages = {(r.civilization, r.activity): r.avg_time_mins for r in gold.age_timings(s).collect()}
    assert ages == {(c, a): m for c in ("Franks", "Celts") for a, m in (("Upgrade Feudal Age", 1.5), ("Upgrade Castle Age", 4.5))}
    civ = {r.civilization: (r.winrate, r.total_games, r.playrate) for r in gold.winrate_civ(s).collect()}
    assert civ == {"Franks": (1.0, 3, 0.5), "Celts": (0.0, 3, 0.5)}
    strat = {r.strategy: (r.winrate, r.total_games, r.civilizations) for r in gold.winrate_strat(s).collect()}
    assert strat == {"drush": (2 / 3, 3, "Celts, Franks"), "Unknown": (1 / 3, 3, "Celts, Franks")}
    summary = {r.player_id: (r.max_elo, r.total_matches, r.total_wins, r.used_strategies) for r in gold.player_summary(s).collect()}
    assert summary == {"p0": (1006.0, 2, 1, "Unknown - 1, drush - 1"), "p1": (1004.0, 2, 1, "Unknown - 1, drush - 1"),
                       "p2": (1005.0, 2, 1, "Unknown - 1, drush - 1")}
