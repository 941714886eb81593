"""spark-submit entry: one job, or all of them, for one process date or several."""

from __future__ import annotations

import argparse
import logging

from silvermill.plans import forge
from silvermill.plans.jobs import backfill
from silvermill.plans.specs import Store
from silvermill.session import get_spark
from silvermill.sources.envelopes import Scope

JOBS = {
    "repos": forge.repos_job,
    "commits": forge.commits_job,
    "issues": forge.issues_job,
    "all": forge.run_date,
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--bronze", required=True, help="root folder of the landed envelopes")
    parser.add_argument("--silver", required=True, help="root folder of the silver tables")
    parser.add_argument("--process-date", required=True, nargs="+", help="YYYY-MM-DD; several are run oldest first")
    parser.add_argument("--owner")
    parser.add_argument("--repo")
    parser.add_argument("--layout", choices=("keyed", "bare"), default="keyed")
    parser.add_argument("--format", choices=("parquet", "delta"), default="parquet", help="of the silver tables")
    parser.add_argument("--allow-missing", action="store_true", help="commits and issues may have landed nothing")
    args = parser.parse_args(argv)
    try:
        scopes = {day: Scope(day, args.owner, args.repo) for day in args.process_date}
    except ValueError as problem:
        parser.error(str(problem))
    logging.basicConfig(level=logging.INFO)
    store = Store(args.bronze.rstrip("/"), args.silver.rstrip("/"), args.format)
    spark = get_spark(f"silvermill-{args.job}")
    options = {"layout": args.layout}
    if args.job != "repos":
        options["allow_missing"] = args.allow_missing
    backfill(lambda day: JOBS[args.job](spark, store, scopes[day], **options), args.process_date)


if __name__ == "__main__":
    main()
