import os
import subprocess
import sys

from tests.test_entry_contract import REPO
from tests.test_ingest import _split_edge_log
from warband import cli


def test_steps_as_separate_processes(spark, scratch):
    """extract → transform → metrics → discover → known → analyst with default folders, one process each."""
    _split_edge_log(os.path.join(scratch, "data"))
    env = {**os.environ, "PYTHONPATH": REPO}

    def run(*args):
        out = subprocess.run([sys.executable, "-m", "warband.cli", *args, "--master", "local[2]"], cwd=scratch, env=env,
                             capture_output=True, text=True, timeout=600)
        assert out.returncode == 0, out.stderr[-2000:]
        return out.stdout

    run("extract")
    run("transform")
    assert "openings" in run("metrics")
    assert "no cluster found" in run("discover")            # too few sequences for the defaults
    assert "stored clusters" in run("discover", "--ngram-n", "1", "--lsh-threshold", "0.05", "--eps", "0.9", "--min-samples", "2",
                                    "--min-matches-per-player", "1")
    assert "scout_rush" in run("known")
    assert "Mayans" in run("analyst", "--report", "civilizations")
    run("analyst", "--report", "clusters", "--out", "report")
    assert spark.read.parquet(os.path.join(scratch, "report")).count() >= 1
    silver = spark.read.parquet(os.path.join(scratch, "warehouse/silver"))
    assert silver.count() == spark.read.parquet(os.path.join(scratch, "warehouse/bronze")).where(
        "activity IS NOT NULL AND match_id IS NOT NULL AND player_id IS NOT NULL").count()


def test_every_report_reads_stored_tables(spark, scratch):
    logs, bronze, silver, gold = (os.path.join(scratch, d) for d in ("logs", "bronze", "silver", "gold"))
    _split_edge_log(logs)
    cli.extract(spark, logs, bronze)
    cli.transform(spark, bronze, silver)
    cli.metrics(spark, silver, gold)
    for report in sorted(set(cli.REPORTS) - {"clusters"}):
        a = cli.parser().parse_args(["analyst", "--gold", gold, "--silver", silver, "--report", report, "--elo-min", "0"])
        assert cli.analyst(spark, report, a).columns
    a = cli.parser().parse_args(["analyst", "--gold", gold, "--silver", silver, "--report", "players", "--elo-min", "0"])
    assert cli.analyst(spark, "players", a).count() >= 3
    a = cli.parser().parse_args(["analyst", "--gold", gold, "--silver", silver, "--report", "civilization-winrates", "--civ", "Mayans"])
    assert cli.analyst(spark, "civilization-winrates", a).first().total_games == 3
