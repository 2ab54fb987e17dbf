"""Command line: ``python -m bankmetrics COMMAND`` or ``spark-submit submit.py COMMAND``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from bankmetrics import monthly, schemas
from bankmetrics.functions import rules
from bankmetrics.operators import checks, funding
from bankmetrics.operators.reshape import one_metric
from bankmetrics.plans import history, ratios
from bankmetrics.plans.benchmarks import REPORT_DATE
from bankmetrics.sinks import files, tables
from bankmetrics.sources import quarantine, synthetic
from bankmetrics.sources.files import read_financials, read_input, read_staged_metrics


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="bankmetrics", description="Bank regulatory ratios on Spark")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, data: bool = True) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        if data:
            sub.add_argument("--data", required=True, help="folder of the input tables")
            sub.add_argument("--format", default="csv", help="format of the input tables")
            sub.add_argument("--seed", type=int, default=0)
        sub.add_argument("--database", help="database of the result tables")
        return sub

    generate = command("generate", "write synthetic input tables")
    generate.add_argument("--assets", type=int, default=synthetic.ASSETS)
    generate.add_argument("--liabilities", type=int, default=synthetic.LIABILITIES)
    generate.add_argument("--branches", type=int, default=synthetic.BRANCHES)
    for name in rules.METRICS:
        command(name.lower(), f"compute {name} and stage it under --data")
    command("worst-branches", "show the five branches with the highest NPL ratio")
    rolling = command("rolling", "write the rolling outflow of every liability")
    rolling.add_argument("--out", required=True)
    create = command("create-tables", "create the result tables", data=False)
    create.add_argument("--location", help="shared folder for the table files")
    check = command("check", "write all input rows that the ratios would lose or count twice, and print their number")
    check.add_argument("--out", required=True, help="folder for one CSV folder per check")
    audit = command("audit", "add the audit row of a stored run, if a run ended before it", data=False)
    audit.add_argument("--run-id", required=True)
    load = command("load", "store the staged metrics with an audit row")
    load.add_argument("--missing", type=float, help="value of a metric that was not staged (default: no row)")
    industry = command("benchmarks", "average a financials document and replace the benchmarks", data=False)
    industry.add_argument("--json", required=True)
    industry.add_argument("--copy", help="folder for the CSV copy")
    industry.add_argument("--report-date", default=REPORT_DATE)
    industry.add_argument("--multi-line", action="store_true", help="each file is one document, not one per line")
    industry.add_argument("--keep-periods", action="store_true", help="keep the benchmarks of other report periods")
    industry.add_argument("--rejected", help="folder for lines that are not JSON (default: the first one is an error)")
    run = command("run", "compute and store all metrics in one pass")
    run.add_argument("--run-id", help="id of the run (default: a new one)")
    run.add_argument("--again", action="store_true", help="replace a run of that id")
    run.add_argument("--rejected", help="shared folder for input rows that do not fit (default: their values are NULL)")
    command("report", "latest run against latest benchmarks", data=False)
    return parser


def _compute(spark: SparkSession, name: str, args) -> None:
    assets = read_input(spark, args.data, "assets", args.format)
    if name == "CAR":
        capital = read_input(spark, args.data, "capital", args.format)
        result = ratios.car(assets, capital, rules.risk_config(spark))
    elif name == "LCR":
        liabilities = read_input(spark, args.data, "liabilities", args.format)
        result = ratios.lcr(assets, funding.with_maturity(liabilities, args.seed))
    else:
        result = ratios.npl_bank(assets).withColumnRenamed("npl_ratio_percent", "NPL")
    files.stage_metric(one_metric(result, name), args.data, name)


def _check(spark: SparkSession, args) -> None:
    def found(name: str, rows) -> None:
        path = f"{args.out}/{name}"
        rows.write.mode("overwrite").option("header", True).csv(path)
        number = spark.read.option("header", True).schema(rows.schema).csv(path).count()
        print(f"{name}: {number}")

    for name, columns in schemas.REQUIRED.items():
        rows = read_input(spark, args.data, name, args.format)
        found(f"{name}_null_keys", checks.null_keys(rows, *columns).where("null_rows > 0"))
        found(f"{name}_duplicate_keys", checks.duplicate_keys(rows, columns[0]))
        marked = quarantine.read_marked(spark, args.data, name, args.format)
        found(f"{name}_rejected", quarantine.split(marked, name).rejected)
    assets = read_input(spark, args.data, "assets", args.format)
    found("assets_unmapped_types", checks.unmapped_types(assets, rules.risk_config(spark)))


def _rolling(spark: SparkSession, args):
    liabilities = funding.with_maturity(read_input(spark, args.data, "liabilities", args.format), args.seed)
    return funding.rolling_outflow(liabilities)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("bankmetrics").getOrCreate()
    if args.command == "generate":
        sheet = synthetic.balance_sheet(spark, args.assets, args.liabilities, args.branches, args.seed)
        files.write_inputs(sheet, args.data, args.format)
    elif args.command.upper() in rules.METRICS:
        _compute(spark, args.command.upper(), args)
    elif args.command == "worst-branches":
        by_branch = ratios.npl_by_branch(read_input(spark, args.data, "assets", args.format))
        ratios.worst_branches(by_branch).show(truncate=False)
    elif args.command == "check":
        _check(spark, args)
    elif args.command == "rolling":
        _rolling(spark, args).write.mode("overwrite").parquet(args.out)
    elif args.command == "create-tables":
        tables.create_tables(spark, args.database, args.location)
    elif args.command == "load":
        run_id = monthly.new_run_id()
        staged = read_staged_metrics(spark, args.data)
        monthly.store(history.staged_snapshot(staged, run_id, missing=args.missing), run_id, args.database)
    elif args.command == "benchmarks":
        if args.rejected:
            checked = quarantine.read_checked_financials(spark, args.json, args.multi_line)
            financials = checked.rows
            checked.rejected.write.mode("overwrite").option("header", True).csv(args.rejected)
        else:
            financials = read_financials(spark, args.json, args.multi_line)
        monthly.load_benchmarks(financials, args.report_date, args.copy, args.database, args.keep_periods)
    elif args.command == "audit":
        tables.append_audit(spark, args.run_id, args.database)
    elif args.command == "run":
        monthly.run(spark, args.data, args.format, args.database, args.run_id, args.seed, args.again, args.rejected)
    else:
        monthly.report(spark, args.database).show(truncate=False)


if __name__ == "__main__":
    main()
