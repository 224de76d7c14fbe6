"""Command line: ``python -m oreworks <command> --base <folder>``.

Exit code 0 means done, 1 an error, 2 a run the quality gate halted.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreworks.operators import export, marts, monitor, profile
from oreworks.operators.quality import latest_metrics, metrics_schema
from oreworks.plans.medallion import LAYER_MODES, layer_tables, run_medallion
from oreworks.session import build_session
from oreworks.sources.rowlog import merge_closed_months, read_newest_month
from oreworks.sources.versioned import VersionedTable
from oreworks.spec import PEOPLE, Layout
from oreworks.streaming.files import medallion_arrivals


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="oreworks")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, text: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        sub.add_argument("--base", required=True, help="folder of input files and tables")
        sub.add_argument("--master", help="Spark master; left to spark-submit when absent")
        return sub

    command("run", "run all layers once over the input folder")
    watch = command("watch", "run all layers for each arrival of files")
    watch.add_argument("--every", type=float, default=60.0, metavar="SECONDS")
    watch.add_argument("--once", action="store_true", help="take what is there and end")
    watch.add_argument("--archive", action="store_true", help="move taken files to the archive folder")
    watch.add_argument("--silver-mode", default="overwrite", choices=LAYER_MODES)
    watch.add_argument("--max-files", type=int, help="files of one batch at most")
    export_to = command("export", "write all silver rows as CSV, newest date first")
    export_to.add_argument("--to", required=True, help="folder of the CSV files")
    command("merge-logs", "rewrite closed months of the logs as one table each")
    command("counts", "row count per layer")
    command("status", "last run, silver rows, latest quality metrics")
    command("profile", "size, duplicate rows and empty cells of each input CSV file")
    for name, text in (("history", "versions of a layer"), ("update", "UPDATE a layer"), ("delete", "DELETE from a layer")):
        sub = command(name, text)
        sub.add_argument("--layer", default="silver", choices=("bronze", "silver", "gold"))
        if name != "history":
            sub.add_argument("--where", required=True)
        if name == "update":
            sub.add_argument("--set", required=True, nargs="+", metavar="COLUMN=EXPRESSION")
    incident = command("incident", "append one incident")
    for field in ("dag_id", "run_id", "task_id", "message"):
        incident.add_argument(field)
    incident.add_argument("--status", default="ERROR")
    return parser


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session(master=args.master)
    layout = Layout(args.base)
    tables = layer_tables(spark, PEOPLE, layout)

    if args.command == "run":
        result = run_medallion(spark, PEOPLE, layout)
        print(result)
        return 0 if result.ok else 2
    if args.command == "watch":
        every = None if args.once else args.every
        how = {"every": every, "archive": args.archive, "silver_mode": args.silver_mode, "max_files": args.max_files}
        medallion_arrivals(spark, PEOPLE, layout, on_result=print, **how)
    elif args.command == "export":
        rows = tables["silver"].read()
        if rows is None:
            print("no silver table")
            return 1
        export.export_csv(rows, args.to, marts.silver_order(PEOPLE))
    elif args.command == "merge-logs":
        logs = {
            layout.dq_metrics: metrics_schema(PEOPLE),
            layout.trace: monitor.INCIDENT_SCHEMA,
            layout.run_metrics: monitor.RUN_SCHEMA,
        }
        for path, schema in logs.items():
            print(path, merge_closed_months(spark, path, schema))
    elif args.command == "counts":
        marts.layer_counts(spark, {name: table.read() for name, table in tables.items()}).show()
    elif args.command == "status":
        runs = read_newest_month(spark, layout.run_metrics, monitor.RUN_SCHEMA)
        monitor.run_kpis(spark, runs, tables["silver"].read()).show()
        metrics = read_newest_month(spark, layout.dq_metrics, metrics_schema(PEOPLE))
        if metrics is not None:
            latest_metrics(metrics).show(truncate=False)
    elif args.command == "profile":
        _print_all(profile.profile_csv_files(spark, layout.input).orderBy("file_path"))
    elif args.command == "incident":
        monitor.log_incident(
            spark, layout.trace, args.dag_id, args.run_id, args.task_id, args.message, args.status
        )
    else:
        _mutate_or_list(args, tables[args.layer])
    return 0


def _mutate_or_list(args: argparse.Namespace, table: VersionedTable) -> None:
    if args.command == "update":
        print(table.update(args.where, dict(a.split("=", 1) for a in args.set)))
    elif args.command == "delete":
        print(table.delete(args.where))
    history = table.history()
    if history is not None:
        _print_all(monitor.history_report(history))


def _print_all(rows: DataFrame) -> None:
    """Every row as one line of JSON, fetched partition by partition."""
    for row in rows.select(F.to_json(F.struct("*"))).toLocalIterator():
        print(row[0])


if __name__ == "__main__":
    sys.exit(main())
