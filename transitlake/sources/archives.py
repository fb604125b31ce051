"""Members of zipped feed bundles."""

from __future__ import annotations

import csv
import io
import sys
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from urllib.parse import unquote, urlparse

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The readers below run on executors, where this package need not be installed:
# they are shipped with the task instead of being imported there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RECORDS_PER_BATCH = 50_000
MOST_READERS = 10_000

# The members taken from a feed bundle.
BUNDLE_MEMBERS = (
    "stop_times.txt",
    "calendar_dates.txt",
    "trips.txt",
    "dates.txt",
    "shapes.txt",
    "periods.txt",
)

RECORDS_SCHEMA = (
    "archive string, member string, status string, header array<string>, record_no bigint, "
    "cells array<string>"
)
# Names of stores that Arrow knows by another name.
SAME_STORE = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}


def extract_zip_members(
    spark: SparkSession, zip_glob: str, members: Sequence[str]
) -> DataFrame:
    """Data records of the wanted members of every archive, as cells.

    Each (archive, member) pair is its own piece of work: a task opens the
    archive by path, seeks to its member and streams it, so neither an archive
    nor a member is ever held whole. A quoted cell may hold commas and line breaks;
    an empty cell is NULL, and blank lines are no records. Status is ``ok`` for a data record, and
    ``empty``, ``missing`` or ``bad`` for a single report row that stands for
    the member (``bad`` may follow records read before the damage was met).
    """
    return _pairs(spark, zip_glob, members).mapInPandas(_read_members, RECORDS_SCHEMA)


def _pairs(spark: SparkSession, zip_glob: str, members: Sequence[str]) -> DataFrame:
    # only paths are asked for, so the files are listed and not read here
    archives = spark.read.format("binaryFile").load(zip_glob).select("path")
    wanted = F.array(*[F.lit(m) for m in members])
    pairs = archives.select("path", F.explode(wanted).alias("member"))
    # an explicit number: paths are a few bytes, and would else be merged into one task
    pairs_there = archives.count() * len(members)
    return pairs.repartition(max(1, min(pairs_there, MOST_READERS)), "path", "member")


def _open(path: str):
    """A seekable file of any store Arrow can reach (local, HDFS, S3, GCS).

    Spark's scheme ``s3a`` is Arrow's ``s3``.
    """
    from pyarrow import fs

    parsed = urlparse(path)
    if parsed.scheme in ("", "file"):
        return open(unquote(parsed.path), "rb")
    store, inner = fs.FileSystem.from_uri(arrow_uri(path))
    return store.open_input_file(inner)


def arrow_uri(path: str) -> str:
    """The address in the names that Arrow has for stores."""
    scheme, rest = path.split(":", 1)
    return f"{SAME_STORE.get(scheme, scheme)}:{rest}"


def _read_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, member in zip(batch["path"], batch["member"]):
            yield from _read_member(path, member)


def _rows(path, member, status, header=None, first=None, records=(None,)) -> pd.DataFrame:
    numbers = [None if first is None else first + i for i in range(len(records))]
    return pd.DataFrame(
        {
            "archive": path,
            "member": member,
            "status": status,
            "header": [header] * len(records),
            "record_no": pd.array(numbers, dtype="Int64"),
            "cells": list(records),
        }
    )


def _read_member(
    path: str, member: str, records_per_batch: int = RECORDS_PER_BATCH
) -> Iterator[pd.DataFrame]:
    header = None
    try:
        with _open(path) as raw, zipfile.ZipFile(raw) as archive:
            if member not in archive.namelist():
                yield _rows(path, member, "missing")
                return
            with archive.open(member) as stream:
                text = csv.reader(io.TextIOWrapper(stream, encoding="utf-8-sig", newline=""))
                header = [name.strip() for name in next(text, [])]
                number, records = 1, []
                for cells in text:
                    if not cells:
                        continue
                    records.append([c if c else None for c in cells])
                    if len(records) == records_per_batch:
                        yield _rows(path, member, "ok", header, number, records)
                        number, records = number + len(records), []
                if records:
                    yield _rows(path, member, "ok", header, number, records)
                elif number == 1:
                    yield _rows(path, member, "empty", header)
    except (zipfile.BadZipFile, zlib.error, EOFError, UnicodeDecodeError, csv.Error):
        # damaged content is reported; failures to reach the store still raise,
        # so that Spark retries the task
        yield _rows(path, member, "bad", header)


def member_headers(spark: SparkSession, zip_glob: str, members: Sequence[str]) -> DataFrame:
    """``(archive, member, status, header)`` from the first record of each member."""
    listed = _pairs(spark, zip_glob, members).mapInPandas(_read_headers, RECORDS_SCHEMA)
    return listed.select("archive", "member", "status", "header")


def _read_headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, member in zip(batch["path"], batch["member"]):
            yield next(_read_member(path, member, records_per_batch=1))


def zip_member_table(
    spark: SparkSession, zip_glob: str, member: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """One member of all archives as a table of text columns, matched by header name.

    Archives may order their columns differently or lack some; a name that repeats
    counts where it comes first. Without ``columns`` the names of all archives are
    taken, and only those, with the least place of each, reach the driver.
    """
    if columns is None:
        listed = member_headers(spark, zip_glob, [member])
        names = listed.select(F.posexplode("header").alias("place", "name"))
        found = names.groupBy("name").agg(F.min("place").alias("place")).orderBy("place", "name")
        columns = [r["name"] for r in found.collect()]
    records = extract_zip_members(spark, zip_glob, [member]).where(F.col("status") == "ok")
    return records.select(*[_cell(name).alias(name) for name in columns])


def _cell(name: str):
    place = F.array_position("header", F.lit(name))
    return F.when(place > 0, F.get("cells", (place - 1).cast("int")))


def land_zip_member(
    spark: SparkSession,
    zip_glob: str,
    member: str,
    folder: str,
    name: str,
    columns: Sequence[str] | None = None,
    max_records_per_file: int = 1_000_000,
) -> None:
    """Write one member of all archives as CSV parts that each carry the header."""
    (
        zip_member_table(spark, zip_glob, member, columns)
        .write.mode("overwrite")
        .option("header", True)
        .option("maxRecordsPerFile", max_records_per_file)
        .csv(f"{folder.rstrip('/')}/{name}.csv")
    )


def land_bundle(
    spark: SparkSession,
    zip_glob: str,
    folder: str,
    members: Sequence[str] = BUNDLE_MEMBERS,
) -> dict[tuple[str, str], int]:
    """Land the members of feed bundles as CSV feeds named after them.

    A member that no archive holds is left out without stopping the others.
    Returns how many archives hold each (member, status), from first records only.
    """
    counted = member_headers(spark, zip_glob, members).groupBy("member", "status").count()
    found = {(r["member"], r["status"]): r["count"] for r in counted.collect()}
    for member in members:
        if any((member, status) in found for status in ("ok", "empty")):
            land_zip_member(spark, zip_glob, member, folder, member.rsplit(".", 1)[0])
    return found
