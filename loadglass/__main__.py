"""Command line: clean a raw log, roll it up, and write report tables.

    python -m loadglass clean  --raw RAW --clean CLEAN [--rejects R] [--csv C] [--tables T]
    python -m loadglass rollup --clean CLEAN --rollup ROLLUP
    python -m loadglass report (--rollup ROLLUP | --clean CLEAN) --tables T [--set static ...]

Run it with ``spark-submit`` on a cluster; ``--master`` is for local runs.
"""

import argparse

from loadglass.operators import cleaning
from loadglass.plans import bundles, gathered, rollup, shared
from loadglass.session import scratch_folder, session
from loadglass.sources import logs

SETS = {
    "published": bundles.published_tables,
    "static": bundles.static_report,
    "dashboard": bundles.dashboard,
    "load-model": bundles.load_model,
}


# The reports of each set that one scan of a clean log can make.
SHARED = {
    "published": shared.PUBLISHED,
    "static": shared.STATIC,
    "dashboard": shared.DASHBOARD,
}


def write_tables(tables: dict, folder: str) -> None:
    for name, table in tables.items():
        logs.write_table(table, f"{folder.rstrip('/')}/{name}")


def staged(raw, path):
    """Parsed rows as Parquet: all that follows reads columns of these, not text again."""
    raw.write.parquet(path)
    return raw.sparkSession.read.schema(raw.schema).parquet(path)


def clean(spark, args) -> None:
    raw = logs.read_raw_log(spark, args.raw, args.format)
    if args.format == "csv":
        raw = staged(raw, scratch_folder(spark, "staged"))
    log = cleaning.clean_log(raw)
    kept, removed = gathered.clean_metrics(log.columns), gathered.reject_metrics()
    logs.write_clean_log(log, args.clean, watch=kept.on)
    if args.rejects:
        removed.on(cleaning.rejected_log(raw)).write.mode("overwrite").parquet(args.rejects)
    if args.csv:
        logs.write_sorted_csv_log(logs.read_clean_log(spark, args.clean), args.csv)
    if args.tables:
        written = logs.read_clean_log(spark, args.clean)
        tables = bundles.clean_report(raw, written)
        if args.rejects:
            tables |= gathered.tables(spark, kept, removed)
        write_tables(tables, args.tables)


def roll_up(spark, args) -> None:
    rollup.write_rollup(logs.read_clean_log(spark, args.clean), args.rollup)


def report(spark, args) -> None:
    if args.clean:
        log = logs.read_clean_log(spark, args.clean)
        names = dict.fromkeys(name for chosen in args.set for name in SHARED[chosen])
        write_tables(shared.shared_tables(log, names), args.tables)
        return
    log = rollup.read_rollup(spark, args.rollup)
    for chosen in args.set:
        write_tables(SETS[chosen](log), args.tables)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="loadglass")
    parser.add_argument("--master", help="for local runs, such as local[8]")
    commands = parser.add_subparsers(required=True)

    command = commands.add_parser("clean")
    command.add_argument("--raw", required=True)
    command.add_argument("--format", default="csv", choices=["csv", "parquet"])
    command.add_argument("--clean", required=True)
    command.add_argument("--rejects")
    command.add_argument("--csv", help="also write the clean log as CSV in order of time")
    command.add_argument("--tables")
    command.set_defaults(run=clean)

    command = commands.add_parser("rollup")
    command.add_argument("--clean", required=True)
    command.add_argument("--rollup", required=True)
    command.set_defaults(run=roll_up)

    command = commands.add_parser("report")
    source = command.add_mutually_exclusive_group(required=True)
    source.add_argument("--rollup")
    source.add_argument("--clean", help="read once; for all sets but load-model")
    command.add_argument("--tables", required=True)
    command.add_argument("--set", nargs="+", choices=SETS, default=["static"])
    command.set_defaults(run=report)

    args = parser.parse_args(argv)
    if args.run is report and args.clean and not set(args.set) <= set(SHARED):
        parser.error(f"from a clean log only {', '.join(SHARED)}; others need a rollup")
    args.run(session(master=args.master), args)


if __name__ == "__main__":
    main()
