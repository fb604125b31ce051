"""Loading only new or changed rows into a stored table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlake.functions.clean import compact_arrays, with_ingested_at
from transitlake.operators.digests import (
    HIGH,
    KEY_HIGH,
    KEY_LOW,
    LOW,
    DigestStore,
    aligned,
    comparable,
    digest_columns,
    is_encoded,
)
from transitlake.sources import tables

# Fixed values of the load policy.
MAX_COMPARE_ROWS = 300_000
MAX_AGE_HOURS = 23

# Copies of one row are restored in blocks of at most this many.
COPIES_PER_BLOCK = 100_000
STAMP = "ingested_at"


def new_or_changed(
    incoming: DataFrame, stored: DataFrame, exclude: Sequence[str] = ("ingested_at",)
) -> DataFrame:
    """Incoming rows that no stored row equals in all incoming columns.

    NULL equals NULL. Copies of a new row are all kept. Columns in ``exclude``
    neither take part nor come out. A column the stored table does not have
    counts as NULL there.

    Rows are compared by 128-bit digests, all that is shuffled of the stored side. Both
    sides are first reduced to one record per different row, before their single
    shuffle, so many copies of a row travel as one record with a count and no task
    receives them all; the copies are restored afterwards in blocks.
    """
    names = [c for c in incoming.columns if c not in exclude]
    kinds = {f.name: f.dataType for f in incoming.schema.fields}
    # nested columns that group in another form travel along as they are
    kept = [
        n
        for n in names
        if is_encoded(kinds[n]) and not isinstance(kinds[n], (T.FloatType, T.DoubleType))
    ]
    record = F.struct(*[comparable(F.col(f"`{n}`"), kinds[n]).alias(n) for n in names])
    left = (
        incoming.select(
            record.alias("_record"),
            *digest_columns(names, kinds),
            *[F.col(f"`{n}`").alias(f"_kept_{n}") for n in kept],
        )
        # by the digest alone, so that the join finds the rows placed
        .groupBy(HIGH, LOW)
        .agg(
            F.count(F.lit(1)).alias("_copies"),
            F.any_value("_record").alias("_record"),
            *[F.any_value(f"_kept_{n}").alias(f"_kept_{n}") for n in kept],
        )
    )
    right = aligned(stored, names, kinds).select(*digest_columns(names, kinds)).distinct()
    fresh = left.join(right, [HIGH, LOW], "left_anti")
    out = [
        (F.col(f"_kept_{n}") if n in kept else F.col(f"_record.`{n}`").cast(kinds[n])).alias(n)
        for n in names
    ]
    return _restore_copies(fresh).select(*out)


def _shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _restore_copies(df: DataFrame) -> DataFrame:
    """Repeat each row ``_copies`` times.

    Rows of up to one block of copies are written out where they are. The others, few
    by their nature, are cut into blocks that are spread over the cluster, so a row
    with very many copies is written out by many tasks.
    """
    one = F.lit(1).cast("bigint")
    few = df.where(F.col("_copies") <= COPIES_PER_BLOCK).withColumn("_block", one)
    last = F.ceil(F.col("_copies") / COPIES_PER_BLOCK).cast("bigint")
    many = (
        df.where(F.col("_copies") > COPIES_PER_BLOCK)
        .withColumn("_block", F.explode(F.sequence(one, last)))
        # an explicit number: the few bytes of the blocks would else be merged into one task
        .repartition(_shuffle_partitions(df.sparkSession), HIGH, "_block")
    )
    size = F.least(
        F.lit(COPIES_PER_BLOCK).cast("bigint"),
        F.col("_copies") - (F.col("_block") - 1) * COPIES_PER_BLOCK,
    )
    return few.unionByName(many).withColumn("_n", F.explode(F.sequence(one, size)))


def choose_mode_column(
    rows: Column,
    created: Column,
    now: Column,
    max_rows: int = MAX_COMPARE_ROWS,
    max_age_h: int = MAX_AGE_HOURS,
) -> Column:
    """What a size-bound load would do with each of a table of tables.

    Reported for comparison only; :func:`load_table` always compares. NULL ``rows``
    means missing.
    """
    too_old = created < now - F.make_dt_interval(F.lit(0), F.lit(max_age_h))
    return (
        F.when(rows.isNull(), "all")
        .when(rows < max_rows, "diff")
        .when(too_old, "replace")
        .otherwise("append")
    )


def _digested(
    df: DataFrame, names: Sequence[str], kinds: dict[str, T.DataType], keys: Sequence[str]
) -> DataFrame:
    """``df`` with the digests of its rows and, where there are keys, of those."""
    of_keys = (
        digest_columns(keys, kinds, KEY_HIGH, KEY_LOW)
        if keys
        else [F.lit(None).cast("bigint").alias(n) for n in (KEY_HIGH, KEY_LOW)]
    )
    return df.select("*", *of_keys, *digest_columns(names, kinds))


def _different(digested: DataFrame, load: Column, keys: Sequence[str]) -> DataFrame:
    """The different digests, each once; a key's digests come out together."""
    stamped = digested.select(KEY_HIGH, KEY_LOW, HIGH, LOW, load.cast("bigint").alias("_load"))
    newest = F.max("_load").alias("_load")
    if keys:
        return stamped.groupBy(KEY_HIGH, KEY_LOW, HIGH, LOW).agg(newest)
    none = [F.lit(None).cast("bigint").alias(n) for n in (KEY_HIGH, KEY_LOW)]
    return stamped.groupBy(HIGH, LOW).agg(newest).select(*none, HIGH, LOW, "_load")


def load_table(
    spark: SparkSession,
    incoming: DataFrame,
    target: str,
    now: datetime | None = None,
    keys: Sequence[str] = (),
    buckets: int | None = None,
) -> str:
    """Append what is new in ``incoming`` to a stored table (path or name).

    The comparison is made at any size. Of the history only digests are read, from a
    bucketed store beside the table (:class:`~transitlake.operators.digests.DigestStore`),
    and nothing of it is shuffled; whole rows move only if their digest is new. With
    ``keys``, which identify a row within a load, a row is new if it differs from the
    newest stored version of its key. A table that has no store yet, or whose feed lost
    a column or changed a type, is read once to make one.

    ``buckets`` (shuffle partitions by default) is fixed by the first load. Returns
    ``diff``, or ``all`` for the first load.
    """
    incoming = compact_arrays(incoming)
    names = [c for c in incoming.columns if c != STAMP]
    kinds = {f.name: f.dataType for f in incoming.schema.fields if f.name != STAMP}
    types = {n: k.simpleString() for n, k in kinds.items()}
    keys = list(keys)
    # one moment for the whole load, in the session's time zone
    now = str(now or spark.sql("SELECT CAST(current_timestamp() AS STRING)").first()[0])
    moment = F.unix_micros(F.lit(now).cast("timestamp"))

    mode = "diff" if tables.exists(spark, target) else "all"
    if mode == "all" and not tables.is_path(target):
        # a named table has its folder once it is there
        tables.write(with_ingested_at(incoming.limit(0), now), target, "append")
    store = DigestStore(spark, target)

    def history(where: str = "true") -> DataFrame:
        # the schema is known, so no footer is opened to infer one, and files
        # written before a column existed give NULL for it
        stamped = T.StructType(
            [f for f in incoming.schema.fields if f.name != STAMP]
            + [T.StructField(STAMP, T.TimestampType())]
        )
        old = tables.read(spark, target, stamped).where(where)
        same = aligned(old, [*names, STAMP], {**kinds, STAMP: T.TimestampType()})
        load = F.coalesce(F.unix_micros(STAMP), F.lit(0))
        return _different(_digested(same, names, kinds, keys), load, keys)

    if mode == "all" or not store.covers(types, keys):
        wanted = buckets or _shuffle_partitions(spark)
        store.start(history() if mode == "diff" else None, types, keys, wanted)
    elif (stamp := store.pending_stamp()) is not None:
        arrived = history(f"{STAMP} = timestamp'{stamp}'").select(HIGH, LOW)
        store.add(store.pending().join(arrived, [HIGH, LOW], "left_semi"))
        store.settled()
    store.widen(types)

    digested = _digested(incoming, names, kinds, keys)
    found = _different(digested, moment, keys)
    if mode == "all":
        # nothing to compare with
        store.pend(found, now)
        rows = incoming
    else:
        pending = store.pend(store.new(found), now)
        matched = [HIGH, LOW] if not keys else [KEY_HIGH, KEY_LOW, HIGH, LOW]
        rows = digested.join(pending.select(*matched), matched, "left_semi")
    tables.write(with_ingested_at(rows.select(*names), now), target, "append")
    store.take_pending()
    return mode
