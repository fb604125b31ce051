"""A full refresh in order: raw tables, staging views, gated marts.

A plain sequence of steps; when and where it runs is the caller's business.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from transitlake import schemas
from transitlake.operators.incremental import load_table
from transitlake.operators.quality import (
    Check,
    QualityError,
    failures_after_write,
    observed,
    run_suite,
)
from transitlake.plans import marts, staging, suites
from transitlake.session import shared_folder, use_utc
from transitlake.sources import tables
from transitlake.sources.files import read_csv_feed, read_enveloped_json, read_json_array
from transitlake.sources.lost_cells import land
from transitlake.sources.versions import Versions


# Staging relations with far fewer rows than the feed they come from.
CONDENSED = {"stop_times", "real_stop_times", "routes", "lines", "stops", "weather_data"}


@dataclass
class Outcome:
    """What a refresh did."""

    load_modes: dict[str, str] = field(default_factory=dict)
    # cells of CSV feeds that their types could not read, by feed and column
    lost_cells: dict[str, dict[str, int]] = field(default_factory=dict)
    version: str = ""
    failures: dict[str, dict[tuple[str, str], int]] = field(default_factory=dict)


# Feeds whose records are the array under a field of the document.
ENVELOPES = {"weather_data": "data"}


def load_raw(
    spark: SparkSession,
    feed_folder: str,
    raw_root: str,
    feeds: Sequence[str] | None = None,
    now: datetime | None = None,
    ledger_root: str | None = None,
    lost: dict[str, dict[str, int]] | None = None,
) -> dict[str, str]:
    """Append what is new in a day's feed files to the raw tables.

    With ``ledger_root``, a CSV feed is landed typed first, so that its text is read
    once; its lost cells are kept in ``ledger_root/<feed>`` and counted in ``lost``.
    """
    modes = {}
    for name in feeds or schemas.FEEDS:
        kind, schema = schemas.FEEDS[name]
        if kind == "csv" and ledger_root is not None:
            typed = shared_folder(spark, f"typed-{name}")
            text = read_csv_feed(spark, feed_folder, name)
            counts = land(text, schema, typed, f"{ledger_root}/{name}", now=now)
            if lost is not None:
                lost[name] = {c: n for c, n in counts.items() if n}
            incoming = tables.read(spark, typed, schema)
        elif kind == "csv":
            incoming = read_csv_feed(spark, feed_folder, name, schema)
        elif name in ENVELOPES:
            path = f"{feed_folder}/{name}.json"
            incoming = read_enveloped_json(spark, path, ENVELOPES[name], schema)
        else:
            incoming = read_json_array(spark, f"{feed_folder}/{name}.json", schema)
        modes[name] = load_table(spark, incoming, f"{raw_root}/{name}", now)
    return modes


def read_raw(spark: SparkSession, raw_root: str, name: str) -> DataFrame:
    """A raw table by its declared schema."""
    if name == "historical_stop_times":
        schema = schemas.HISTORICAL_STOP_TIMES
    else:
        schema = schemas.FEEDS[name][1]
    stamped = schemas.with_stamp(schema)
    return spark.read.schema(stamped).parquet(f"{raw_root}/{name}")


def staging_relations(
    spark: SparkSession, raw: Callable[[str], DataFrame]
) -> dict[str, DataFrame]:
    """All staging relations, lazily, from a reader of raw tables."""
    return {
        "stop_times": staging.stop_times(raw("stop_times")),
        "real_stop_times": staging.real_stop_times(raw("historical_stop_times")),
        "calendar_dates": staging.calendar_dates(raw("calendar_dates"), raw("periods")),
        "routes": staging.routes(raw("routes"), raw("municipalities")),
        "lines": staging.lines(raw("lines")),
        "stops": staging.stops(raw("stops")),
        "trips": staging.trips(raw("trips")),
        "weather_data": staging.weather_data(raw("weather_data")),
        "dates": staging.dates(spark),
    }


def materialize(df: DataFrame, target: str, partition_by: str | None = None) -> DataFrame:
    """Write a mart (to a path or a catalog table) and return it as read back."""
    tables.write(df, target, "overwrite", [partition_by] if partition_by else [])
    return tables.read(df.sparkSession, target, df.schema)


def _judge(
    outcome: Outcome, name: str, counts: dict[tuple[str, str], int], strict: bool
) -> None:
    """Record the failures of a relation; with ``strict`` they stop the refresh."""
    failed = {k: n for k, n in counts.items() if n}
    outcome.failures[name] = failed
    if failed and strict:
        raise QualityError(f"{name}: {failed}")


def check(
    outcome: Outcome, name: str, df: DataFrame, checks: Sequence[Check], strict: bool
) -> None:
    """Check a relation that is not written."""
    rows = run_suite(df, checks).collect()
    _judge(outcome, name, {(r["check"], r["column"]): r["failures"] for r in rows}, strict)


def materialize_checked(
    outcome: Outcome,
    name: str,
    df: DataFrame,
    target: str,
    checks: Sequence[Check],
    strict: bool,
    partition_by: str | None = None,
) -> DataFrame:
    """Write a relation, counting what its checks find on the way, and judge it."""
    counting, observation = observed(df, checks)
    written = materialize(counting, target, partition_by)
    _judge(outcome, name, failures_after_write(written, checks, observation), strict)
    return written


def build_marts(
    spark: SparkSession,
    raw: Callable[[str], DataFrame],
    out_root: str,
    strict: bool = True,
    now: datetime | None = None,
    outcome: Outcome | None = None,
    keep_staging: bool = False,
) -> Outcome:
    """Staging views, their checks, then the marts and theirs; then all marts are published.

    Everything is written to a new version below ``out_root``
    (:class:`~transitlake.sources.versions.Versions`) and readers are pointed to it when
    the last check has passed. A failure with ``strict`` leaves the former version in use.

    Each mart is read back from where it was written, so a later mart starts
    from files and not from a long lineage. With ``keep_staging`` the staging
    relations that condense their feed are written once as well; their checks
    and the marts then read the few rows per trip, route or stop that are left
    instead of working through the raw tables again.
    """
    outcome = outcome or Outcome()
    use_utc(spark)
    versions = Versions(spark, out_root)
    outcome.version = versions.begin()
    names: list[str] = []

    def build(
        name: str, df: DataFrame, checks: Sequence[Check], partition_by: str | None = None,
        folder: str = "",
    ) -> DataFrame:
        names.append(folder + name)
        target = versions.path(outcome.version, names[-1])
        return materialize_checked(outcome, name, df, target, checks, strict, partition_by)

    stage = staging_relations(spark, raw)
    for name, df in stage.items():
        checks = suites.STAGING.get(name, [])
        if keep_staging and name in CONDENSED:
            df = stage[name] = build(name, df, checks, folder="staging/")
        elif checks:
            check(outcome, name, df, checks, strict)
        df.createOrReplaceTempView(f"staging_{name}")

    def mart(name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        return build(name, df, suites.MARTS.get(name, []), partition_by)

    mart("dim_date", marts.dim_date(stage["dates"], stage["calendar_dates"], now))
    mart("dim_weather", marts.dim_weather(stage["weather_data"], now))
    routes = mart(
        "dim_routes", marts.dim_routes(stage["routes"], stage["lines"], stage["stops"], now)
    )
    # the fact comes before the comparison with observed trips, which reads it
    fact = mart(
        "fact_trips",
        marts.fact_trips(stage["stop_times"], stage["trips"], routes, stage["calendar_dates"]),
        partition_by="planned_date",
    )
    mart("dim_historical_trips", marts.dim_historical_trips(stage["real_stop_times"], fact, now))
    versions.publish(outcome.version, names)
    return outcome


def run(
    spark: SparkSession,
    feed_folder: str,
    raw_root: str,
    out_root: str,
    strict: bool = True,
    now: datetime | None = None,
    observed_stop_times: str | None = None,
    ledger_root: str | None = None,
) -> Outcome:
    """Load a day's feeds and publish a new version of the star schema below ``out_root``.

    ``observed_stop_times`` (path or table) replaces the copy of the observed stop times
    below ``raw_root``; without it the copy that is there is used. ``ledger_root`` keeps
    the cells that were lost to their types.
    """
    use_utc(spark)
    if observed_stop_times is not None:
        source = tables.read(spark, observed_stop_times)
        tables.full_refresh(source, f"{raw_root}/historical_stop_times")
    outcome = Outcome()
    outcome.load_modes = load_raw(
        spark, feed_folder, raw_root, now=now, ledger_root=ledger_root, lost=outcome.lost_cells
    )
    return build_marts(
        spark,
        lambda name: read_raw(spark, raw_root, name),
        out_root,
        strict,
        now,
        outcome,
        keep_staging=True,
    )
