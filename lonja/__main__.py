"""Command line: ``python -m lonja bronze | silver | gold | batch | stream | report NAME [--csv PATH]``."""

from __future__ import annotations

import argparse
import inspect
import logging

from .plans import reports, runner
from .settings import Settings
from .sources import kafka_events
from .streaming import LiveSinks, start


# Options of the command line and the parameters of reports that they set.
REPORT_OPTIONS = {"first": "first", "last": "last", "brand": "brands", "category": "categories", "segment": "segments", "kind": "kind", "k": "k"}


def report_options(chosen: argparse.Namespace) -> dict:
    """Parameters for the chosen report. An export holds all rows unless ``--k`` limits it; an option that the report does
    not know is an error."""
    options = {name: getattr(chosen, option) for option, name in REPORT_OPTIONS.items() if getattr(chosen, option) is not None}
    known = inspect.signature(reports.REPORTS[chosen.name][0]).parameters
    if unknown := sorted(set(options) - set(known)):
        raise ValueError(f"{chosen.name} does not take {', '.join(unknown)}")
    if chosen.csv and "k" in known:
        options.setdefault("k", None)
    return options


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="lonja")
    parser.add_argument("step", choices=["bronze", "silver", "gold", "batch", "stream", "report"])
    parser.add_argument("name", nargs="?", choices=sorted(reports.REPORTS), help="which report")
    parser.add_argument("--csv", help="write the report there instead of showing it")
    parser.add_argument("--limit", type=int, default=100, help="how many rows to show; the number of all rows is shown too")
    parser.add_argument("--first", metavar="DAY", help="first day of the report")
    parser.add_argument("--last", metavar="DAY", help="last day of the report")
    for option in ("brand", "category", "segment"):
        parser.add_argument(f"--{option}", action="append", help="may be given several times")
    parser.add_argument("--kind", choices=["talla", "color"], help="demand by size or by colour")
    parser.add_argument("--k", type=int, help="number of rows of a top-k report")
    parser.add_argument("--incremental", action="store_true", help="Silver reads only the ingest days that are new to it")
    parser.add_argument("--latest-only", action="store_true", help="each ingest day is a complete copy: what the last one lacks was deleted")
    chosen = parser.parse_args(arguments)
    if chosen.step == "report" and not chosen.name:
        parser.error("name a report")
    try:
        options = report_options(chosen) if chosen.step == "report" else {}
    except ValueError as problem:
        parser.error(str(problem))
    logging.basicConfig(level=logging.INFO)
    settings = Settings.from_environment()
    spark, lake, rules = settings.session(f"lonja-{chosen.step}"), settings.lake, settings.rules

    def ingest():
        counts = runner.ingest_database(spark, settings.database, lake)
        runner.ingest_files(spark, settings["RAW_ROOT"], lake)
        runner.ingest_catalog(spark, f"{settings['RAW_ROOT']}/api_catalogo", lake, settings["API_BASE_URL"])
        return counts

    if chosen.step == "bronze":
        print(ingest())
    elif chosen.step == "silver":
        print(runner.run_silver(spark, lake, rules, chosen.incremental, chosen.latest_only))
    elif chosen.step == "gold":
        print(runner.run_gold(spark, lake, rules))
    elif chosen.step == "batch":
        print(runner.run_batch(spark, lake, ingest, rules, chosen.incremental, chosen.latest_only))
    elif chosen.step == "stream":
        records = kafka_events(spark, settings["KAFKA_BOOTSTRAP_SERVERS"], settings.topic)
        start(records, LiveSinks(lake, rules=rules), settings["STREAM_TRIGGER"]).awaitTermination()
    else:
        report = runner.report(spark, lake, chosen.name, **options)
        if chosen.csv:
            reports.write_csv(report, chosen.csv)
        else:
            report.show(chosen.limit, truncate=False)
            print(f"{report.count()} rows in all")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
