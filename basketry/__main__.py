"""Jobs for spark-submit: ``load`` runs the incremental load, ``insights`` writes the report tables."""

from __future__ import annotations

import argparse
import json
from dataclasses import asdict

from basketry.plans.insight_state import rollups
from basketry.plans.insights import HOME_MARKET, all_insights, constant_rate_lines
from basketry.plans.runs import run_daily
from basketry.schemas import CONSTANT_FX_RATE, MIN_COUNTRIES
from basketry.session import fit_shuffles, job_session, run_scratch, stage
from basketry.sources.fact_table import PERIOD_FORMATS, read_fact
from basketry.sources.sales import read_sales_csv


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="basketry", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--timestamp-format", help="of InvoiceDate, if not ISO")
    lines = common.add_mutually_exclusive_group()
    lines.add_argument("--one-line-per-row", dest="multi_line", action="store_false", default=None, help="files split")
    lines.add_argument("--breaks-in-quotes", dest="multi_line", action="store_true", help="each file is one task")
    common.add_argument("--strict-quotes", action="store_true", help="with --breaks-in-quotes: files split all the same")

    load = jobs.add_parser("load", parents=[common])
    for name in ("sales", "countries", "fx", "fact", "metadata"):
        load.add_argument(f"--{name}", required=True)
    load.add_argument("--grain", choices=sorted(PERIOD_FORMATS), default="month")
    load.add_argument("--min-countries", type=int, default=MIN_COUNTRIES)

    insights = jobs.add_parser("insights", parents=[common])
    source = insights.add_mutually_exclusive_group(required=True)
    source.add_argument("--fact", help="stored fact")
    source.add_argument("--sales", help="sales feed, converted at one constant rate")
    insights.add_argument("--rate", type=float, default=CONSTANT_FX_RATE)
    insights.add_argument("--home", help="home market, spelled as in the source")
    insights.add_argument("--state", help="with --fact: folder of roll-ups; only periods changed since are read")
    insights.add_argument("--out", required=True)
    args = parser.parse_args(argv)
    if args.sales and args.multi_line is None:
        parser.error("with --sales, say --one-line-per-row or --breaks-in-quotes")
    if args.job == "insights" and args.state and not args.fact:
        parser.error("--state goes with --fact")
    return args


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = job_session(f"basketry {args.job}")
    csv = {"timestamp_format": args.timestamp_format, "multi_line": args.multi_line, "strict_quotes": args.strict_quotes}
    if args.job == "load":
        result = run_daily(
            spark, args.sales, args.countries, args.fx, args.fact, args.metadata,
            grain=args.grain, min_countries=args.min_countries, **csv,
        )
        print(json.dumps(asdict(result)))
        return
    fit_shuffles(spark, [args.fact or args.sales])
    with run_scratch(spark, "insights"):
        if args.fact:
            lines, home = read_fact(spark, args.fact), args.home or HOME_MARKET
        else:
            sales = read_sales_csv(spark, args.sales, **csv)
            # Parse the text once; the report reads the lines twice.
            lines = stage(constant_rate_lines(sales, args.rate), "constant-rate-lines")
            home = args.home or HOME_MARKET.title()
        if args.state:
            tables = rollups(spark, args.fact, args.state).insights(home)
        else:
            tables = all_insights(lines, home)
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{args.out}/{name}")


if __name__ == "__main__":
    main()
