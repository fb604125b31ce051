"""Row digests, and a bucketed store of the digests of a table.

A digest is 128 bits, two hashes with different starts and column orders. Rows with
equal digests count as equal; among 10**12 different rows the chance of one false match
is about 10**-15.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlake.sources import tables

HIGH, LOW = "_digest_high", "_digest_low"
KEY_HIGH, KEY_LOW = "_key_high", "_key_low"

# Nested values are hashed as text that holds every microsecond.
_JSON = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def comparable(value: Column, kind: T.DataType) -> Column:
    """A form of ``value`` that groups and joins as a plain key.

    Maps become sorted entries. Floating-point numbers become text, which is
    exact both ways: Spark wraps floating keys in a normalization of its own,
    and grouped rows would then not count as placed for the join that follows.
    """
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        # adding zero makes -0.0 and 0.0 one number
        return (value + F.lit(0).cast(kind)).cast("string")
    if isinstance(kind, T.MapType):
        entries = F.map_entries(value)
        return F.array_sort(comparable(entries, T.ArrayType(_entry_type(kind))))
    if isinstance(kind, T.ArrayType) and is_encoded(kind.elementType):
        return F.transform(value, lambda item: comparable(item, kind.elementType))
    if isinstance(kind, T.StructType) and is_encoded(kind):
        fields = [comparable(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def _entry_type(kind: T.MapType) -> T.StructType:
    return T.StructType(
        [T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)]
    )


def is_encoded(kind: T.DataType) -> bool:
    """Whether :func:`comparable` changes values of this type."""
    if isinstance(kind, (T.MapType, T.FloatType, T.DoubleType)):
        return True
    if isinstance(kind, T.ArrayType):
        return is_encoded(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(is_encoded(f.dataType) for f in kind.fields)
    return False


def digest_columns(
    names: Sequence[str], kinds: dict[str, T.DataType], high: str = HIGH, low: str = LOW
) -> list[Column]:
    """The two halves of the digest of the named columns.

    Every value goes in together with its column's name. Hashing passes over NULLs, so
    a NULL column leaves no trace: rows keep their digest when a table gets a column.
    """
    parts = []
    for name in sorted(names):
        value = comparable(F.col(f"`{name}`"), kinds[name])
        if isinstance(kinds[name], (T.ArrayType, T.StructType, T.MapType)):
            value = F.to_json(value, _JSON)
        parts.append((F.when(value.isNotNull(), F.lit(name)), value))
    forward = [c for pair in parts for c in pair]
    backward = [c for pair in reversed(parts) for c in pair]
    return [
        F.xxhash64(F.lit("high"), *forward).alias(high),
        F.xxhash64(F.lit("low"), *backward).alias(low),
    ]


def aligned(df: DataFrame, names: Sequence[str], kinds: dict[str, T.DataType]) -> DataFrame:
    """The named columns in the given types; a column that ``df`` lacks is NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{n}`") if n in present else F.lit(None))
            # by name, so that the NULL-ability of nested parts is left alone
            .cast(kinds[n].simpleString())
            .alias(n)
            for n in names
        ]
    )


class DigestStore:
    """Digests of the different rows of a stored table, kept beside its files.

    The digests lie in ``_digests`` below the table's folder, hidden from readers of
    the table, as a relation bucketed by key and digest: joining a load to it moves the load's
    digests only. Loads add to it. ``layout-N.json`` names the bucket count, the
    columns the digests cover and the generation in use; a change of columns that
    would change old digests starts a new generation.

    Order of a load: digests of new rows are written aside (``pending``, bucketed alike),
    the rows are appended, the digests' files are moved into the store. A load that broke
    off is settled by the next one: those pending digests whose rows arrived join the store.
    """

    def __init__(self, spark: SparkSession, target: str):
        self.spark = spark
        self.root = f"{tables.location(spark, target)}/_digests"
        self.fs = tables.Files(spark, self.root)
        self.layout = self._last_layout()

    def _last_layout(self) -> dict | None:
        found = []
        for name in self.fs.names(""):
            number = name.removeprefix("layout-").removesuffix(".json")
            if number.isdigit():
                try:
                    found.append((int(number), json.loads(self.fs.read_text(name))))
                except ValueError:
                    # a write that broke off
                    continue
        if not found:
            return None
        number, layout = max(found, key=lambda x: x[0])
        return layout | {"number": number}

    def _save_layout(self, **changes) -> None:
        layout = {**(self.layout or {"number": -1}), **changes}
        layout["number"] += 1
        self.fs.write_text(f"layout-{layout['number']}.json", json.dumps(layout))
        self.layout = layout

    @property
    def keyed(self) -> list[str]:
        return [KEY_HIGH, KEY_LOW] if self.layout["keys"] else [HIGH, LOW]

    def _table(self, folder: str) -> str:
        """The bucketed relation of the digests in a folder, registered by its place."""
        place = f"{self.root}/{folder}"
        name = f"row_digests_{sha256(place.encode()).hexdigest()[:20]}"
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(
                f"""CREATE TABLE {name}
                    ({KEY_HIGH} BIGINT, {KEY_LOW} BIGINT, {HIGH} BIGINT, {LOW} BIGINT, _load BIGINT)
                    USING parquet CLUSTERED BY ({', '.join(self.keyed)})
                    INTO {self.layout['buckets']} BUCKETS LOCATION '{place}'"""
            )
        else:
            # files may have come or gone by another session
            self.spark.catalog.refreshTable(name)
        return name

    def _write(self, digests: DataFrame, folder: str) -> None:
        """Add to a folder: one file per bucket, since the rows are dealt as the buckets are."""
        name = self._table(folder)
        columns = self.spark.table(name).columns
        dealt = digests.select(*columns).repartition(self.layout["buckets"], *self.keyed)
        dealt.write.insertInto(name)

    def covers(self, columns: dict[str, str], keys: Sequence[str]) -> bool:
        """Whether digests over ``columns`` (name to type) compare with the stored ones."""
        if self.layout is None or list(keys) != self.layout["keys"]:
            return False
        return all(columns.get(n) == kind for n, kind in self.layout["columns"].items())

    def start(
        self, rows: DataFrame | None, columns: dict[str, str], keys: Sequence[str], buckets: int
    ) -> None:
        """Begin a generation over ``columns`` with the digests of ``rows`` (as digested)."""
        number = -1 if self.layout is None else self.layout["number"]
        self.layout = {
            "number": number,
            "buckets": (self.layout or {}).get("buckets", buckets),
            "columns": columns,
            "keys": list(keys),
            "generation": f"generation-{number + 1}",
        }
        # of an attempt that broke off before its layout was written
        self.fs.delete(self.layout["generation"])
        self._table(self.layout["generation"])
        if rows is not None:
            self.add(rows)
        self._save_layout()

    def widen(self, columns: dict[str, str]) -> None:
        """Note columns that came since; their NULLs left no trace in old digests."""
        if set(columns) - set(self.layout["columns"]):
            self._save_layout(columns={**self.layout["columns"], **columns})

    def compact(self) -> None:
        """Rewrite the store with one file per bucket."""
        old, former = self.known(), self.layout["generation"]
        self.start(old, self.layout["columns"], self.layout["keys"], self.layout["buckets"])
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(former)}")
        self.fs.delete(former)

    def known(self) -> DataFrame:
        """All stored digests."""
        return self.spark.table(self._table(self.layout["generation"]))

    def add(self, digests: DataFrame) -> None:
        self._write(digests, self.layout["generation"])

    def new(self, digests: DataFrame) -> DataFrame:
        """Those of ``digests`` that the store lacks.

        Without keys: by digest. With keys: those that differ from the newest version
        stored for their key, so a value that changes and changes back is new again.
        """
        known = self.known()
        # dealt as the buckets are, or Spark would rather shuffle the store
        digests = digests.repartition(self.layout["buckets"], *self.keyed)
        if not self.layout["keys"]:
            # an anti-join would be moved below the repartition
            met = known.select(HIGH, LOW, F.lit(True).alias("_met"))
            return digests.join(met, [HIGH, LOW], "left").where("_met IS NULL").drop("_met")
        newest = known.groupBy(KEY_HIGH, KEY_LOW).agg(
            F.max(F.struct("_load", HIGH, LOW)).alias("_newest")
        )
        met = digests.join(newest, [KEY_HIGH, KEY_LOW], "left")
        same = (F.col("_newest")[HIGH] == F.col(HIGH)) & (F.col("_newest")[LOW] == F.col(LOW))
        return met.where(~F.coalesce(same, F.lit(False))).drop("_newest")

    @property
    def _pending(self) -> str:
        return f"pending-{self.layout['generation']}"

    def pend(self, digests: DataFrame, stamp: str) -> DataFrame:
        """Write the digests of rows that are about to be appended; returns them as read."""
        self.settled()
        self._write(digests, self._pending)
        self.fs.write_text(f"{self._pending}/_stamp", stamp)
        return self.pending()

    def pending(self) -> DataFrame:
        return self.spark.table(self._table(self._pending))

    def pending_stamp(self) -> str | None:
        """The stamp of a load that has not been settled."""
        if "_stamp" not in self.fs.names(self._pending):
            return None
        return self.fs.read_text(f"{self._pending}/_stamp")

    def take_pending(self) -> None:
        """The pending digests join the store: their files are moved."""
        self.fs.move_data(self._pending, self.layout["generation"])
        self.settled()

    def settled(self) -> None:
        self.fs.delete(self._pending)
