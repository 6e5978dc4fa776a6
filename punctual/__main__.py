"""Command line: ``python -m punctual rebuild|extract|layout``; see --help."""

from __future__ import annotations

import argparse
import os
import sys
import uuid

from punctual.operators.checks import GateFailed
from punctual.plans import layout_bench
from punctual.contracts import RAW_TABLES
from punctual.plans.bi import bi_views
from punctual.plans.catalog import publish
from punctual.plans.rebuild import extract, rebuild
from punctual.session import get_session
from punctual.sources.csv_load import DEFAULT_NAMING, MissingInputs
from punctual.sources.states import ref_br_state
from punctual.sources.warehouse import Warehouse, row_counts


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="punctual")
    jobs = parser.add_subparsers(dest="job", required=True)
    one = jobs.add_parser("rebuild", help="CSV files -> gated BI layer")
    one.add_argument("source_dir")
    one.add_argument("root")
    one.add_argument("--naming", default=DEFAULT_NAMING, help="file name, with {table}")
    one.add_argument("--database", help="also register the tables in this database")
    one.add_argument(
        "--at-once", action="store_true", help="show nothing before all gates have passed"
    )
    two = jobs.add_parser("extract", help="snapshot the report's views")
    two.add_argument("root")
    two.add_argument("target")
    three = jobs.add_parser("layout", help="what the partitioned copy saves")
    three.add_argument("root")
    three.add_argument("--events", help="existing folder for the event log that is measured")
    args = parser.parse_args(argv)

    spark = get_session(**_event_log(args))
    warehouse = Warehouse(spark, args.root)
    try:
        if args.job == "rebuild":
            views = rebuild(
                spark, args.source_dir, args.root, args.naming, at_once=args.at_once
            )
            loaded = {table: warehouse.read(table) for table in RAW_TABLES}
            row_counts({**loaded, **views}).show(truncate=False)
            if args.database:
                publish(warehouse, args.database)
        elif args.job == "extract":
            extract(bi_views(warehouse.pinned(), ref_br_state(spark)), args.target)
        else:
            run_id = f"bench{uuid.uuid4().hex[:12]}"
            measured = layout_bench.measure(warehouse, layout_bench.Params(), run_id)
            layout_bench.comparison(measured).show(truncate=False)
    except (GateFailed, MissingInputs) as error:
        print(error, file=sys.stderr)
        return 1
    return 0


def _event_log(args: argparse.Namespace) -> dict[str, str]:
    """The settings by which a session logs what the layout job measures.

    A local warehouse keeps the log beside its tables. Elsewhere the folder has to exist,
    as Spark asks; without one, real bytes stay unknown.
    """
    folder = getattr(args, "events", None)
    if args.job == "layout" and folder is None and "://" not in args.root:
        folder = os.path.join(os.path.abspath(args.root.removeprefix("file:")), ".events")
        os.makedirs(folder, exist_ok=True)
    if folder is None:
        return {}
    return {
        "spark__eventLog__enabled": "true",
        "spark__eventLog__compress": "false",
        "spark__eventLog__dir": folder,
    }


if __name__ == "__main__":
    sys.exit(main())
