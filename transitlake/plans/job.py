"""``spark-submit`` entry of the daily refresh.

    spark-submit transitlake/plans/job.py FEEDS RAW MARTS [--bundles GLOB] [--observed SOURCE]

FEEDS is the day's landing folder, RAW and MARTS the roots of the raw tables and
of the star schema. The members of zip archives (``--bundles``) are first landed in
FEEDS. SOURCE, a path or table, holds the observed stop times; the raw copy is
replaced by it. Shuffles are sized by what is stored in FEEDS and RAW.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from transitlake.plans import refresh  # noqa: E402
from transitlake.session import build, tune  # noqa: E402
from transitlake.sources.archives import land_bundle  # noqa: E402
from transitlake.sources.tables import Files  # noqa: E402


def main(argv: list[str]) -> refresh.Outcome:
    parser = argparse.ArgumentParser()
    parser.add_argument("feeds")
    parser.add_argument("raw")
    parser.add_argument("marts")
    parser.add_argument("bundles_at", nargs="?")
    parser.add_argument("--bundles")
    parser.add_argument("--observed")
    args = parser.parse_args(argv)
    spark = build("daily-refresh")
    if bundles := args.bundles or args.bundles_at:
        land_bundle(spark, bundles, args.feeds)
    tune(spark, sum(Files(spark, root).size() for root in (args.feeds, args.raw)))
    return refresh.run(
        spark, args.feeds, args.raw, args.marts, observed_stop_times=args.observed
    )


if __name__ == "__main__":
    print(main(sys.argv[1:]))
