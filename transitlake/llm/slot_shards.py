"""Sharding by fixed virtual slots, balanced by bytes.

Every record is hashed into one of a fixed number of virtual slots, bytes are added up
per slot, and a small map says which shard holds which slot. Only the map is edited
when shards are added or drift apart; it is stored in numbered versions, and a record
never changes its slot. DataFrame functions only; the driver holds the map, which has
one row per slot whatever the table's size.

Records with equal texts share a slot. A text whose copies together hold more than
``1 / (PIECES * shards)`` of all bytes (at most ``PIECES * shards`` texts can) is dealt
over as many slots as it has such shares, so that one group of copies cannot fill a
shard. Rows that are equal in id and text are numbered, and the number takes part in
the dealing, so null or repeated ids spread as well.

A null text has no bytes and is as the empty text (CRC 0, size 1); a null id is a value
of its own, placed last within its slot. A text is never cut, so one that exceeds an
even share makes its shard that much larger. An empty table gives no rows and a map
of all slots. Other columns, whatever their names, are not read by ``records``.
"""

from __future__ import annotations

import heapq
import os
import re
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transitlake.llm.common import stored, whole_text
from transitlake.session import shared_folder
from transitlake.sources import tables

SLOTS = 4096
# A group of equal texts is kept in one slot up to this part of an even shard.
PIECES = 4
# Equal rows are numbered in blocks of at most this many.
BLOCK = 100_000


def _number(df: DataFrame, copies: str, out: str) -> DataFrame:
    """Each row ``copies`` times, numbered from 0 in ``out``.

    Rows with very many copies are cut into blocks, which are spread over the cluster
    before they are written out.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = df.where(F.col(copies) <= BLOCK).withColumn("_from", F.lit(0).cast("bigint"))
    many = (
        df.where(F.col(copies) > BLOCK)
        .withColumn("_from", F.expr(f"explode(sequence(0L, {copies} - 1, {BLOCK}L))"))
        .repartition(partitions, "_from", *df.columns)
    )
    number = F.expr(f"explode(sequence(_from, least(_from + {BLOCK}, {copies}) - 1))")
    return few.unionByName(many).withColumn(out, number).drop("_from", copies)


def _narrow(id_col: str, text: str) -> list[Column]:
    whole = whole_text(text)
    return [
        F.col(id_col).alias("id"),
        (F.octet_length(whole).cast("bigint") + 1).alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        F.xxhash64(whole).alias("text_hash"),
    ]


def records(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, size, text_crc32, text_hash, copy): one row per row of ``docs``.

    Equal rows are counted before the shuffle and written out by number after it. The
    relation is stored: texts are read once.
    """
    counted = (
        docs.select(*_narrow(id_col, text))
        .groupBy("id", "size", "text_crc32", "text_hash")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    return stored(_number(stored(counted, "counted"), "copies", "copy"), "records")


def with_slot(rows: DataFrame, shards: int, slots: int = SLOTS) -> DataFrame:
    """Add ``virtual_slot``; ``rows`` has the columns of :func:`records`, or more."""
    total = rows.agg(F.sum("size").alias("bytes")).first()["bytes"] or 0
    share = max(1, total // (PIECES * shards))
    same = ["text_hash", "text_crc32", "size"]
    # each of these texts holds a share of all bytes, so there are at most PIECES * shards
    hot = (
        rows.groupBy(*same)
        .agg(F.sum("size").alias("bytes"))
        .where(F.col("bytes") > share)
        .select(*same, F.ceil(F.col("bytes") / share).cast("bigint").alias("pieces"))
    )
    piece = F.pmod(F.xxhash64("id", "copy"), F.coalesce("pieces", F.lit(1).cast("bigint")))
    return (
        rows.join(F.broadcast(hot), same, "left")
        .withColumn("virtual_slot", F.pmod(F.xxhash64(*same, piece), F.lit(slots)).cast("int"))
        .drop("pieces")
    )


@dataclass
class SlotMap:
    """Which shard holds which slot, with bytes and rows per slot as of the last count."""

    shards: int
    shard: list[int]
    size: list[int]
    rows: list[int]
    version: int = 0
    moved: list[int] = field(default_factory=list)

    def loads(self) -> list[int]:
        loads = [0] * self.shards
        for slot, shard in enumerate(self.shard):
            loads[shard] += self.size[slot]
        return loads

    def counted(self, sizes: Iterable[tuple[int, int, int]]) -> SlotMap:
        """The same map with a new count of (slot, bytes, rows)."""
        size, rows = [0] * len(self.shard), [0] * len(self.shard)
        for slot, b, n in sizes:
            size[slot], rows[slot] = b, n
        return SlotMap(self.shards, list(self.shard), size, rows, self.version)

    def _edited(self, shards: int, shard: list[int]) -> SlotMap:
        moved = [s for s, (a, b) in enumerate(zip(self.shard, shard)) if a != b]
        return SlotMap(shards, shard, self.size, self.rows, self.version + 1, moved)

    def levelled(self, tolerance: float = 0.0) -> SlotMap:
        """The next version: slots move from the fullest shard to the emptiest.

        Each move is of the largest slot that narrows the gap of the two, until the
        fullest is within ``tolerance`` of an even share or no move narrows the gap.
        """
        shard, loads = list(self.shard), self.loads()
        even = sum(loads) / max(1, self.shards)
        held = [[] for _ in range(self.shards)]
        for slot, s in enumerate(shard):
            if self.size[slot]:
                held[s].append((self.size[slot], slot))
        for own in held:
            own.sort()
        for _ in range(len(shard)):
            full = max(range(self.shards), key=lambda s: (loads[s], -s))
            spare = min(range(self.shards), key=lambda s: (loads[s], s))
            gap = loads[full] - loads[spare]
            fits = [x for x in held[full] if x[0] < gap]
            if loads[full] <= even * (1 + tolerance) or not fits:
                break
            # half the gap evens the two out
            best = min(fits, key=lambda x: (abs(2 * x[0] - gap), x[1]))
            held[full].remove(best)
            held[spare].append(best)
            shard[best[1]] = spare
            loads[full] -= best[0]
            loads[spare] += best[0]
        return self._edited(self.shards, shard)

    def grown(self) -> SlotMap:
        """The next version with one more shard, which takes slots of the fullest only."""
        shard, loads = list(self.shard), [*self.loads(), 0]
        new = self.shards
        even = sum(loads) / (self.shards + 1)
        heap = [(-loads[s], s) for s in range(self.shards)]
        heapq.heapify(heap)
        held = [[] for _ in range(self.shards)]
        for slot, s in enumerate(shard):
            if self.size[slot]:
                held[s].append(slot)
        while heap and loads[new] < even:
            _, s = heapq.heappop(heap)
            over = min(loads[s] - even, even - loads[new])
            fits = [x for x in held[s] if self.size[x] <= max(over, 0)]
            if not fits:
                continue
            best = max(fits, key=lambda x: (self.size[x], -x))
            held[s].remove(best)
            shard[best] = new
            loads[s] -= self.size[best]
            loads[new] += self.size[best]
            heapq.heappush(heap, (-loads[s], s))
        return self._edited(self.shards + 1, shard)


def slot_sizes(rows: DataFrame) -> list[tuple[int, int, int]]:
    """(slot, bytes, rows) of every slot in use: one row per slot reaches the driver."""
    found = rows.groupBy("virtual_slot").agg(F.sum("size"), F.count(F.lit(1))).collect()
    return sorted((r[0], r[1], r[2]) for r in found)


def first_map(sizes: list[tuple[int, int, int]], shards: int, slots: int = SLOTS) -> SlotMap:
    """Largest slot first, each to the shard with the fewest bytes; empty slots in turn."""
    size, rows = [0] * slots, [0] * slots
    for slot, b, n in sizes:
        size[slot], rows[slot] = b, n
    shard = [slot % shards for slot in range(slots)]
    heap = [(0, s) for s in range(shards)]
    for slot in sorted((s for s in range(slots) if size[s]), key=lambda s: (-size[s], s)):
        load, s = heapq.heappop(heap)
        shard[slot] = s
        heapq.heappush(heap, (load + size[slot], s))
    return replace(SlotMap(shards, shard, size, rows).levelled(), moved=[])


def map_table(spark: SparkSession, held: SlotMap) -> DataFrame:
    """(virtual_slot, shard, bytes, rows, first_place): the map as a small relation.

    ``first_place`` counts the rows in the earlier slots of the same shard.
    """
    places, first = [0] * held.shards, []
    for slot, shard in enumerate(held.shard):
        first.append(places[shard])
        places[shard] += held.rows[slot]
    lists = {"shard": held.shard, "bytes": held.size, "rows": held.rows, "first_place": first}
    arrays = [
        F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>").alias(name)
        for name, values in lists.items()
    ]
    one = spark.range(1).select(F.arrays_zip(*arrays).alias("slots"))
    return one.select(F.posexplode("slots").alias("virtual_slot", "of")).select(
        "virtual_slot",
        F.col("of.shard").cast("int").alias("shard"),
        *[f"of.{name}" for name in ("bytes", "rows", "first_place")],
    )


def _versions(spark: SparkSession, folder: str) -> list[int]:
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(path))
    numbers = [int(m[1]) for n in names if (m := re.fullmatch(r"version=(\d+)", n))]
    # a version counts once its write has ended
    return sorted(
        n for n in numbers if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{folder}/version={n}/_SUCCESS"))
    )


def save_map(spark: SparkSession, held: SlotMap, folder: str) -> str:
    """Write the map as ``version=N``; earlier versions stay as they are."""
    path = os.path.join(folder, f"version={held.version}")
    map_table(spark, held).withColumn("shards", F.lit(held.shards)).coalesce(1).write.mode(
        "overwrite"
    ).parquet(path)
    return path


def load_map(spark: SparkSession, folder: str, version: int | None = None) -> SlotMap:
    """A stored version; the last one by default."""
    version = _versions(spark, folder)[-1] if version is None else version
    found = spark.read.parquet(os.path.join(folder, f"version={version}"))
    rows = found.orderBy("virtual_slot").collect()
    return SlotMap(
        rows[0]["shards"],
        [r["shard"] for r in rows],
        [r["bytes"] for r in rows],
        [r["rows"] for r in rows],
        version,
    )


def placed(rows: DataFrame, held: SlotMap) -> DataFrame:
    """Add ``shard`` and ``slot``, the place in the shard, gapless from 0.

    Places are counted within each virtual slot and moved up by the rows of the
    earlier slots of the shard, so no task orders a whole shard.
    """
    order = [F.asc_nulls_last("id"), "text_hash", "text_crc32", "size", "copy"]
    nth = F.row_number().over(Window.partitionBy("virtual_slot").orderBy(*order))
    small = map_table(rows.sparkSession, held).select("virtual_slot", "shard", "first_place")
    return (
        rows.withColumn("_nth", nth)
        .join(F.broadcast(small), "virtual_slot")
        .withColumn("slot", F.col("first_place") + F.col("_nth") - 1)
        .drop("_nth", "first_place")
    )


def write_shards(
    docs: DataFrame,
    held: SlotMap,
    folder: str,
    id_col: str = "doc_id",
    text: str = "text",
) -> None:
    """Write whole rows as ``shard=N`` folders below ``folder``, by the map.

    A shard is written by several tasks, in proportion to its bytes. Equal rows are
    interchangeable, so they are dealt by their place in the input here. A column
    named ``shard`` gives way to the shard.
    """
    own = [c for c in docs.columns if c != "shard"]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row"),
        *_narrow(id_col, text),
        F.monotonically_increasing_id().alias("copy"),
    )
    by_slot = map_table(docs.sparkSession, held).select("virtual_slot", "shard")
    placed_rows = with_slot(rows, held.shards, len(held.shard)).join(
        F.broadcast(by_slot), "virtual_slot"
    )
    tables.write(placed_rows.select("_row.*", "shard"), folder, "overwrite", ["shard"])


def shard_query(docs: DataFrame, shards: int = 16, slots: int = SLOTS) -> DataFrame:
    """Shard and place of every document; the map is stored as its first version."""
    rows = stored(with_slot(records(docs), shards, slots), "slotted")
    held = first_map(slot_sizes(rows), shards, slots)
    folder = shared_folder(docs.sparkSession, "slot-map")
    save_map(docs.sparkSession, held, folder)
    held = load_map(docs.sparkSession, folder)
    return placed(rows, held).select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
