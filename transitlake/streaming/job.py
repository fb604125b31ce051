"""``spark-submit`` entry of the vehicle stream.

    spark-submit transitlake/streaming/job.py IN OUT CHECKPOINT [SECONDS]

Runs for SECONDS (300 by default; 0 works off what is there and ends). The
checkpoint folder carries the stream across runs.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from transitlake.session import build, use_utc  # noqa: E402
from transitlake.streaming.pings import (  # noqa: E402
    TRIGGER,
    dropped_rows,
    read_pings,
    run,
    vehicle_windows,
    work_off,
    write_windows,
)

RUN_SECONDS = 300


def main(argv: list[str]) -> None:
    source, out, checkpoint = argv[:3]
    seconds = int(argv[3]) if len(argv) > 3 else RUN_SECONDS
    spark = use_utc(build("vehicle-stream"))
    windows = vehicle_windows(read_pings(spark, source))
    query = write_windows(windows, out, checkpoint, trigger=TRIGGER if seconds else None)
    if seconds:
        run(query, seconds)
        print("rows dropped as late:", dropped_rows(query))
    else:
        work_off(query)


if __name__ == "__main__":
    main(sys.argv[1:])
