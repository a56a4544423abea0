"""python -m tallyspark COMMAND: what the data product is made and checked with. See --help."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import quality
from .plans import audits, recovery, release
from .plans.canonical import Canonical
from .plans.models import Models
from .session import make_session, ship
from .sources.landing import read_invalid, read_overlay, write_csv
from .sources.tables import TABLES, MissingTables, load_tables

# The seasons of each league.
SEASONS = {
    "wfa": (2009, 2010, 2011, 2012, 2013, 2014, 2017, 2018, 2019, 2020, 2021, 2022, 2023, 2024, 2025, 2026),
    "wnfc": (2019, 2020, 2021, 2022, 2023, 2024, 2025, 2026),
}


def show(findings: DataFrame, most: int = 200) -> dict[str, int]:
    """Prints findings, the gravest first, up to ``most`` lines, and returns how many there are of each level."""
    for r in quality.in_order(findings).limit(most).toLocalIterator():
        print(f"{r['level']:8} {r['table_name']:24} {r['check_name']:16} {r['message']}: {r['count']}")
    counts = dict.fromkeys(("ERROR", "WARNING", "INFO"), 0) | {r["level"]: r["count"] for r in findings.groupBy("level").count().collect()}
    print(", ".join(f"{n} {level}" for level, n in counts.items()))
    return counts


def extract(spark: SparkSession, args: argparse.Namespace) -> int:
    from .sources.web import extract_season

    for league in [args.league] if args.league else SEASONS:
        for season in [args.season] if args.season else SEASONS[league]:
            landed = extract_season(spark, args.url, f"{args.root}/raw", league, season, delay=args.delay)
            print(f"{league} {season}: {landed.where('path is not null').count()} landed, {landed.where('not valid').count()} invalid or failed")
    return 0


def recover(spark: SparkSession, args: argparse.Namespace) -> int:
    invalid = read_invalid(spark, args.root)
    audit, report = recovery.audit_invalid(invalid), recovery.recover_all(spark, args.root)
    recovery.write_report(report, f"{args.root}/recovery_report")
    write_csv(audit, f"{args.root}/invalid_responses", skip_empty=True)
    recovery.rule_histogram(report).show(50, False)
    recovery.first_failures(report).show(20, False)
    show(recovery.recovery_findings(audit, report))
    return 0


def normalize(spark: SparkSession, args: argparse.Namespace) -> int:
    for name, df in Canonical(read_overlay(spark, args.root)).tables().items():
        df.write.mode("overwrite").parquet(f"{args.tables}/{name}.parquet")
        print(f"{name}: {spark.read.parquet(f'{args.tables}/{name}.parquet').count()} rows")
    return 0


def validate(spark: SparkSession, args: argparse.Namespace) -> int:
    findings = quality.check_all(load_tables(spark, args.tables, required=()), TABLES)
    return 1 if show(findings)["ERROR"] else 0


def audit(spark: SparkSession, args: argparse.Namespace) -> int:
    outputs = audits.run_audits(load_tables(spark, args.tables))
    outputs["disposition_summary"].show(50, False)
    print("written:", ", ".join(audits.write_audits(outputs, args.out)))
    return 0


def publish(spark: SparkSession, args: argparse.Namespace) -> int:
    print(release.publish(load_tables(spark, args.tables), args.version, args.releases, args.force))
    return 0


def export(spark: SparkSession, args: argparse.Namespace) -> int:
    tables = release.release_tables(spark, args.releases, args.version)
    lacking = [t for t in TABLES if t not in tables]
    if lacking:
        raise MissingTables(f"the release lacks {', '.join(lacking)}")
    models = Models(tables)
    marts = {name: models.core(name) for name in Models.CORE}
    if show(quality.check_marts(marts))["ERROR"] and not args.force:
        return 1
    for e in release.export_marts(marts, args.version, args.releases)["datasets"]:
        print(f"{e['mart']}: {e['row_count']} rows, {e['column_count']} columns, {e['size_bytes']} bytes, {e['sha256'] if 'sha256' in e else len(e['parts'])}")
    return 0


def leagues(spark: SparkSession, args: argparse.Namespace) -> int:
    """The leagues that each table has, and the seasons of each."""
    for name, df in load_tables(spark, args.tables, required=()).items():
        if {"league", "season"} <= set(df.columns):
            for r in df.groupBy("league").agg(F.count_distinct("season").alias("seasons"), F.min("season").alias("first"), F.max("season").alias("last")).orderBy("league").toLocalIterator():
                print(f"{name:24} {r['league']}: {r['seasons']} seasons, {r['first']} to {r['last']}")
    return 0


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tallyspark", description=__doc__)
    out.add_argument("--master", help="the Spark master; without it, that of the environment, or all cores of this machine")
    commands = out.add_subparsers(dest="command", required=True)

    def command(name: str, run, about: str, **options: dict) -> None:
        sub = commands.add_parser(name, help=about)
        sub.set_defaults(run=run)
        for option, settings in options.items():
            sub.add_argument(f"--{option}", **settings)

    needed = {"required": True}
    command("extract", extract, "land the documents of the leagues' seasons", root=needed, url=needed, league={}, season={"type": int}, delay={"type": float, "default": 0.25})
    command("recover", recover, "repair invalid responses and report", root=needed)
    command("normalize", normalize, "write the canonical tables of landed documents", root=needed, tables=needed)
    command("validate", validate, "print the findings; 1 if there are errors", tables=needed)
    command("leagues", leagues, "print which leagues and seasons the tables have", tables=needed)
    command("audit", audit, "write the audits of unresolved rows as CSV", tables=needed, out=needed)
    command("publish", publish, "write a release", tables=needed, releases=needed, version=needed, force={"action": "store_true"})
    command("export", export, "write the marts of a release, the latest without a version", releases=needed, version={}, force={"action": "store_true"})
    return out


def main(argv: list[str] | None = None) -> int:
    """0 if all went well, 1 for findings of level ERROR and for what can't be made."""
    args = parser().parse_args(argv)
    spark = SparkSession.getActiveSession() or (make_session(args.master) if args.master else make_session())
    ship(spark)
    try:
        return args.run(spark, args)
    except (release.ReleaseError, MissingTables, ValueError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
