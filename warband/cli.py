"""Command line: the medallion flow as steps that each take and give folders.

    python -m warband.cli extract   --xes data               --bronze warehouse/bronze
    python -m warband.cli transform --bronze warehouse/bronze --silver warehouse/silver
    python -m warband.cli metrics   --silver warehouse/silver --gold warehouse/gold
    python -m warband.cli discover  --gold warehouse/gold     [--eps 0.3 --min-samples 50 ...]
    python -m warband.cli known     --gold warehouse/gold
    python -m warband.cli analyst   --gold warehouse/gold --silver warehouse/silver --report players [--out folder]

Steps are separate processes: nothing but the folders is shared. A path without a scheme is taken from
the working directory. ``--master`` is only for local runs, on a cluster the submit settings apply.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from warband.plans import analyst as A
from warband.plans.discovery import known_variation, publish_clusters, unknown_clusters
from warband.plans.gold import write_gold
from warband.plans.silver import events_clean, write_silver
from warband.session import drop_scratch, ship_package
from warband.sources.xes import read_xes, write_bronze

CLUSTERS = "clustered_unknown_strategies"


def located(path: str) -> str:
    return path if ":/" in path else os.path.abspath(path)


def extract(spark: SparkSession, xes: str, bronze: str) -> None:
    """Every ``*.xes`` file of a folder → bronze parquet (replaced)."""
    write_bronze(read_xes(spark, located(xes)), located(bronze))


def transform(spark: SparkSession, bronze: str, silver: str) -> None:
    """Bronze → clustered silver parquet."""
    write_silver(events_clean(spark.read.parquet(located(bronze))), located(silver))


def metrics(spark: SparkSession, silver: str, gold: str) -> list[str]:
    """Every gold table from the stored silver table."""
    return write_gold(spark.read.parquet(located(silver)), located(gold))


def discover(spark: SparkSession, gold: str, **params) -> bool:
    """Cluster unnamed openings and store them when any cluster is found."""
    clusters = unknown_clusters(spark.read.parquet(f"{located(gold)}/openings"), **params)
    return publish_clusters(spark, clusters, path=f"{located(gold)}/{CLUSTERS}")


def known(spark: SparkSession, gold: str) -> DataFrame:
    """U16: similarity report of the named strategies."""
    return known_variation(spark.read.parquet(f"{located(gold)}/openings"))


#: Report name → (stored tables it reads, query over them and the filter values).
REPORTS = {
    "players": (("player_summary",), lambda t, f: A.players_by_elo(t, f.elo_min, f.elo_max)),
    "apm": (("apm", "silver"), lambda t, s, f: A.apm_by_player(t, s, f.elo_min, f.elo_max, f.civ)),
    "ages": (("age_timings",), lambda t, f: A.age_matrix(t, f.civ)),
    "sequences": (("openings",), lambda t, f: A.opening_sequences(t, f.actions, f.elo_min, f.elo_max, f.civ)),
    "steps": (("openings",), lambda t, f: A.action_step_matrix(t, f.actions, f.elo_min, f.elo_max, f.civ)),
    "civilization-winrates": (("winrate_civ",), lambda t, f: A.civ_winrates(t, f.civ)),
    "strategy-winrates": (("winrate_strat",), lambda t, f: A.strategy_winrates(t, f.civ)),
    "civilizations": (("silver",), lambda s, f: A.civilizations(s)),
    "clusters": ((CLUSTERS,), lambda t, f: A.cluster_summary(t)),
}


def analyst(spark: SparkSession, report: str, filters: argparse.Namespace) -> DataFrame:
    """One analyst query over the stored gold (and silver) tables."""
    tables, query = REPORTS[report]
    frames = [spark.read.parquet(located(filters.silver) if t == "silver" else f"{located(filters.gold)}/{t}") for t in tables]
    return query(*frames, filters)


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="warband.cli")
    steps = ap.add_subparsers(dest="step", required=True)

    def step(name: str, *folders: str) -> argparse.ArgumentParser:
        s = steps.add_parser(name)
        s.add_argument("--master", default=None)
        for f in folders:
            s.add_argument(f"--{f}", default="data" if f == "xes" else f"warehouse/{f}")
        return s

    step("extract", "xes", "bronze")
    step("transform", "bronze", "silver")
    step("metrics", "silver", "gold")
    d = step("discover", "gold")
    d.add_argument("--ngram-n", type=int, default=3)
    d.add_argument("--num-perm", type=int, default=128)
    d.add_argument("--lsh-threshold", type=float, default=0.5)
    d.add_argument("--eps", dest="dbscan_eps", type=float, default=0.3)
    d.add_argument("--min-samples", dest="dbscan_min_samples", type=int, default=50)
    d.add_argument("--min-matches-per-player", type=int, default=3)
    step("known", "gold")
    a = step("analyst", "gold", "silver")
    a.add_argument("--report", choices=sorted(REPORTS), required=True)
    a.add_argument("--elo-min", type=float, default=2500)
    a.add_argument("--elo-max", type=float, default=3100)
    a.add_argument("--actions", type=int, default=50)
    a.add_argument("--civ", action="append", default=None, help="repeat for several; default: every civilization")
    a.add_argument("--out", default=None, help="write the whole report as parquet here instead of showing its first rows")
    return ap


def main(argv=None) -> None:
    a = parser().parse_args(argv)
    builder = SparkSession.builder.appName(f"warband-{a.step}").config("spark.sql.session.timeZone", "UTC")
    if a.master:
        builder = builder.master(a.master).config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    ship_package(spark)
    if a.step == "extract":
        extract(spark, a.xes, a.bronze)
    elif a.step == "transform":
        transform(spark, a.bronze, a.silver)
    elif a.step == "metrics":
        print("wrote", ", ".join(metrics(spark, a.silver, a.gold)))
    elif a.step == "discover":
        params = {k: v for k, v in vars(a).items() if k not in ("step", "master", "gold")}
        print("stored clusters" if discover(spark, a.gold, **params) else "no cluster found; table left as it was")
    elif a.step == "known":
        known(spark, a.gold).show(truncate=False)
    else:
        report = analyst(spark, a.report, a)
        if a.out:
            report.write.mode("overwrite").parquet(located(a.out))
        else:
            report.show(50, truncate=False)
    drop_scratch(spark)


if __name__ == "__main__":
    main()
