"""The daily feed job (K4): WT MAWB -> WT HAWB -> CW MAWB (-> CW HAWB).

Feeds run in that order and the run stops at the first failure; feeds
written before the failure stay written. The WT result feeds two exports,
so it is written once as a table in the cluster's shared checkpoint folder
(``spark.checkpoint.dir``, ``operators.stage``): both exports read the
stored rows, and a lost executor does not force the WT joins to run again.

Usage::

    spark-submit -m cargofeed.job --wt-root s3://.../wt --cw-root s3://.../cw \\
        --out s3://.../feeds [--as-of 2024-05-01] [--full-load] [--cw-hawb]
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging
import sys
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from .params import FeedParams, parse_date
from .plans.cw import cw_feed
from .plans.feeds import cw_hawb_feed, cw_mawb_feed, wt_hawb_feed, wt_mawb_feed
from .plans.wt import wt_feed
from .operators.stage import stage, staged_run
from .session import build_session
from .sinks.csv import export_feed
from .sources.tables import read_family

log = logging.getLogger("cargofeed.job")


@dataclass
class RunResult:
    ok: bool = True
    written: dict[str, str] = field(default_factory=dict)
    failed: str | None = None
    error: str | None = None


def run_feeds(spark: SparkSession, wt_tables: Mapping[str, DataFrame] | None,
              cw_tables: Mapping[str, DataFrame] | None, params: FeedParams, out_root: str,
              wt_header: str = "observed", cw_hawb: bool = False) -> RunResult:
    """Build and export the feeds in order; stop at the first failure."""
    result = RunResult()
    steps = []
    if wt_tables is not None:
        state: dict[str, DataFrame] = {}

        def wt_rows() -> DataFrame:
            if "wt" not in state:
                state["wt"] = stage(wt_feed(wt_tables, params.wt_window), "wt_feed")
            return state["wt"]

        steps.append(("mawb", lambda: wt_mawb_feed(wt_rows(), wt_header)))
        steps.append(("hawb", lambda: wt_hawb_feed(wt_rows())))
    if cw_tables is not None:
        cw_state: dict[str, DataFrame] = {}

        def cw_rows() -> DataFrame:
            if "cw" not in cw_state:
                cw = cw_feed(cw_tables, params.cw_window)
                # one export stages its own rows; two share them
                cw_state["cw"] = stage(cw, "cw_feed") if cw_hawb else cw
            return cw_state["cw"]

        steps.append(("cwmawb", lambda: cw_mawb_feed(cw_rows())))
        if cw_hawb:
            steps.append(("cwhawb", lambda: cw_hawb_feed(cw_rows())))

    with staged_run(spark):
        for feed, build in steps:
            try:
                df = build()
                # the WT feeds are written in the order of their dates
                by = [c for c in df.columns if c.lower() == "date"] if feed in ("mawb", "hawb") else []
                result.written[feed] = export_feed(df, feed, params.as_of, out_root, order_by=by)
                log.info("feed %s written to %s", feed, result.written[feed])
            except Exception as exc:  # noqa: BLE001 - report and stop, as the source job did
                log.error("feed %s failed: %s", feed, exc)
                result.ok, result.failed, result.error = False, feed, str(exc)
                break
    return result


def reader_options(pairs: list[str]) -> dict[str, str]:
    """``KEY=VALUE`` arguments as reader options."""
    for pair in pairs:
        if "=" not in pair:
            raise ValueError(f"reader option {pair!r} is not KEY=VALUE")
    return dict(pair.split("=", 1) for pair in pairs)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="cargofeed.job", description=__doc__.split("\n")[0])
    ap.add_argument("--wt-root", help="root of the WT tables (omit to skip WT feeds)")
    ap.add_argument("--cw-root", help="root of the CW tables (omit to skip the CW feed)")
    ap.add_argument("--format", default="parquet", help="source format (parquet, orc, table, ...)")
    for family in ("wt", "cw"):
        ap.add_argument(f"--{family}-option", action="append", default=[], metavar="KEY=VALUE",
                        help=f"reader option of the {family.upper()} tables, or TABLE.KEY=VALUE for "
                             "one table (JDBC: url, user, TABLE.partitionColumn, ...); repeatable")
    ap.add_argument("--shuffle-partitions", type=int, default=None,
                    help="about the shuffled bytes / 128 MB (default: the cluster's setting)")
    ap.add_argument("--out", required=True, help="feed output root")
    ap.add_argument("--as-of", help="run day, YYYY-MM-DD (default: today, UTC)")
    ap.add_argument("--full-load", action="store_true")
    ap.add_argument("--lookback-days", type=int, default=45)
    ap.add_argument("--wt-header", choices=["observed", "declared"], default="observed")
    ap.add_argument("--cw-hawb", action="store_true", help="also write the CW HAWB feed")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    logging.basicConfig(level=logging.INFO)
    spark = build_session(master=args.master, shuffle_partitions=args.shuffle_partitions)
    as_of = parse_date(args.as_of) or dt.datetime.now(dt.timezone.utc).date()
    params = FeedParams(as_of=as_of, full_load=args.full_load, lookback_days=args.lookback_days)
    wt = read_family(spark, args.wt_root, "wt", args.format, reader_options(args.wt_option)) if args.wt_root else None
    cw = read_family(spark, args.cw_root, "cw", args.format, reader_options(args.cw_option)) if args.cw_root else None
    result = run_feeds(spark, wt, cw, params, args.out, args.wt_header, args.cw_hawb)
    print(result)
    return 0 if result.ok else 1


if __name__ == "__main__":
    sys.exit(main())
