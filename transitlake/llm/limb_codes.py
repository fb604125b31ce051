"""Vector code compression: product codes from exact integer k-means.

A vector's components become integers, the vector is cut into equal parts, and each
part is replaced by the index of the nearest entry of that part's codebook. Distances
are exact: integers are broken into limbs so small that every float64 matrix product
of limbs stays below 2**53, the products are recombined in int64, and the first least
distance wins.

Rows whose vector is null or has a null, NaN or infinite component are dropped. The
width is the length that most remaining vectors have (the greater on a tie). A vector
of another length keeps its row, with null code and error, and takes no part in
training. A width that is no multiple of ``parts`` is filled up with zeros. Integers
beyond +-2**29 (less for parts wider than 4) count as that bound, so that squared
distances fit 64 bits. Repeated ids are rows of their own, ordered by their integers
where ids tie; a null id comes last. An empty table gives no rows and empty codebooks.
Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlake.llm.common import stored

# Tasks carry this module's code with them; executors need no package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows per matrix product: what a task holds is this many rows times the entries.
BLOCK = 4096
LONGEST = 2**63 - 1


def limb_bits(width: int) -> int:
    """Bits of a limb so that ``width`` products of limbs add up to less than 2**53."""
    return (52 - max(width - 1, 0).bit_length()) // 2


def largest(width: int) -> int:
    """The bound of an integer so that ``width`` squared differences fit 63 bits."""
    return 1 << ((60 - max(width - 1, 0).bit_length()) // 2)


def limbs(a: np.ndarray, bits: int) -> list[np.ndarray]:
    """``a`` as float64 limbs, lowest first: a == sum(limb[i] << (bits * i)).

    All but the last are from 0 to 2**bits - 1; the last carries the sign. Small
    numbers are one limb.
    """
    out = []
    while a.size and max(int(a.max()), -int(a.min())) >= 1 << bits:
        out.append((a & ((1 << bits) - 1)).astype(np.float64))
        a = a >> bits
    return [*out, a.astype(np.float64)]


def exact_products(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Dot products (rows x entries) of int64 vectors, exact in int64."""
    bits = limb_bits(x.shape[1])
    total = np.zeros((len(x), len(entries)), np.int64)
    right = [limb.T for limb in limbs(entries, bits)]
    for i, a in enumerate(limbs(x, bits)):
        for j, b in enumerate(right):
            total += (a @ b).astype(np.int64) << (bits * (i + j))
    return total


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first nearest entry of each row, and the squared distance."""
    apart = np.square(entries).sum(axis=1) - 2 * exact_products(x, entries)
    index = apart.argmin(axis=1)
    return index, apart[np.arange(len(x)), index] + np.square(x).sum(axis=1)


@dataclass(frozen=True)
class Shape:
    """How vectors become parts: ``width`` components, each times ``scale`` and floored."""

    width: int
    parts: int
    scale: float

    @property
    def part_width(self) -> int:
        return -(-self.width // self.parts)

    def integers(self, values: np.ndarray) -> np.ndarray:
        """Rows x parts x components of the part."""
        bound = largest(self.part_width)
        with np.errstate(over="ignore"):
            whole = np.floor(values * self.scale).clip(-bound, bound).astype(np.int64)
        filled = np.zeros((len(whole), self.parts * self.part_width), np.int64)
        filled[:, : self.width] = whole
        return filled.reshape(len(whole), self.parts, self.part_width)


def _usable(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, which vectors are whole and finite, and all components in a row."""
    lengths = pc.list_value_length(column)
    there = np.asarray(lengths.is_valid())
    lengths = np.asarray(lengths.fill_null(0)).astype(np.int64)
    values = np.asarray(column.flatten().fill_null(np.nan), np.float64)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    ends = np.cumsum(lengths)
    return lengths, there & (bad[ends] == bad[ends - lengths]), values


def _vectors(lengths: np.ndarray, rows: np.ndarray, values: np.ndarray, width: int) -> np.ndarray:
    return values[np.repeat(rows, lengths)].reshape(-1, width)


def _narrow(df: DataFrame, id_col: str, vector: str, *carry: Column) -> DataFrame:
    """Only what is needed, so that clashing names of other columns do not matter."""
    return df.select(
        F.col(id_col).alias("_id"), F.col(vector).cast("array<double>").alias("_vector"), *carry
    )


def _first_vectors(df: DataFrame, entries: int) -> tuple[int, np.ndarray] | None:
    """Width and the vectors of the ``entries`` smallest ids.

    A batch hands on its rows with the smallest ids of each width, so what is
    sorted is a small part of the table.
    """
    kind = df.schema["_id"].dataType.simpleString()

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, usable, _ = _usable(batch.column("_vector"))
            for width in np.unique(lengths[usable]):
                rows = np.flatnonzero(usable & (lengths == width))
                own = batch.take(pa.array(rows))
                rank = np.asarray(
                    pc.rank(own.column("_id"), null_placement="at_end", tiebreaker="dense")
                )
                most = np.sort(rank)[min(entries, len(rank)) - 1]
                first = own.filter(pa.array(rank <= most))
                counts = np.zeros(first.num_rows, np.int64)
                counts[0] = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [first.column("_id"), first.column("_vector"), pa.array(counts)],
                    names=["_id", "_vector", "_rows"],
                )

    found = stored(
        df.mapInArrow(candidates, f"_id {kind}, _vector array<double>, _rows bigint"), "first-vectors"
    ).withColumn("_width", F.size("_vector"))
    width = (
        found.groupBy("_width")
        .agg(F.sum("_rows").alias("rows"))
        .orderBy(F.desc("rows"), F.desc("_width"))
        .first()
    )
    if width is None:
        return None
    first = (
        found.where(F.col("_width") == width["_width"])
        .orderBy(F.asc_nulls_last("_id"), "_vector")
        .limit(entries)
        .collect()
    )
    return width["_width"], np.array([r["_vector"] for r in first], np.float64).reshape(len(first), -1)


def _assigned(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (rows x parts) and squared distances summed over parts."""
    codes = np.empty(x.shape[:2], np.int64)
    error = np.zeros(len(x), np.int64)
    for at in range(0, len(x), BLOCK):
        for part, book in enumerate(books):
            index, distance = nearest(x[at : at + BLOCK, part], book)
            codes[at : at + BLOCK, part] = index
            error[at : at + BLOCK] += np.minimum(distance, LONGEST - error[at : at + BLOCK])
    return codes, error


def _improved(df: DataFrame, shape: Shape, books: np.ndarray) -> np.ndarray:
    """Each entry replaced by the floored mean of the parts nearest to it.

    A task adds up its parts and hands on one row per used entry, so at most
    parts x entries rows of a task are shuffled, and as many reach the driver.
    """
    entries = books.shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((shape.parts, entries, shape.part_width), np.int64)
        count = np.zeros((shape.parts, entries), np.int64)
        for batch in batches:
            lengths, usable, values = _usable(batch.column("_vector"))
            x = shape.integers(
                _vectors(lengths, usable & (lengths == shape.width), values, shape.width)
            )
            codes, _ = _assigned(x, books)
            for part in range(shape.parts):
                count[part] += np.bincount(codes[:, part], minlength=entries)
                np.add.at(total[part], codes[:, part], x[:, part])
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part.astype(np.int32)),
                pa.array(entry.astype(np.int32)),
                pa.array(count[part, entry]),
                pa.array(list(total[part, entry]), pa.list_(pa.int64())),
            ],
            names=["part", "entry", "n", "total"],
        )

    partial = df.mapInArrow(sums, "part int, entry int, n bigint, total array<bigint>")
    totals = partial.groupBy("part", "entry").agg(
        F.sum("n").alias("n"),
        *[
            F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"c{i}")
            for i in range(shape.part_width)
        ],
    )
    books = books.copy()
    for row in totals.collect():
        books[row["part"], row["entry"]] = [
            int(row[f"c{i}"]) // row["n"] for i in range(shape.part_width)
        ]
    return books


def train(
    df: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    scale: float = 256.0,
) -> tuple[Shape, np.ndarray]:
    """Codebooks (parts x entries x components) trained on every usable vector.

    They start as the parts of the ``entries`` smallest ids, in that order; with
    fewer vectors there are fewer entries. ``rounds`` passes over the table follow.
    What the driver holds is the codebooks, whatever the table's size.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an index takes one byte: 1 to 256 entries")
    narrow = _narrow(df, id_col, vector)
    first = _first_vectors(narrow, entries)
    if first is None:
        return Shape(0, parts, scale), np.zeros((parts, 0, 0), np.int64)
    shape = Shape(first[0], parts, scale)
    books = shape.integers(first[1]).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        books = _improved(narrow, shape, books)
    return shape, books


def encode(
    df: DataFrame,
    shape: Shape,
    books: np.ndarray,
    id_col: str = "vec_id",
    vector: str = "embedding",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(id, carried columns, code as hex, squared error) of every usable row."""
    narrow = _narrow(df, id_col, vector, *[F.col(c).alias(f"_c_{c}") for c in carry])
    fields = [f for f in narrow.schema.fields if f.name != "_vector"]
    names = [f.name for f in fields]

    def codes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, usable, values = _usable(batch.column("_vector"))
            fits = usable & (lengths == shape.width)
            if books.shape[1] == 0:
                continue
            x = shape.integers(_vectors(lengths, fits, values, shape.width))
            codes, error = _assigned(x, books)
            text = np.full(batch.num_rows, None, object)
            text[fits] = [row.tobytes().hex() for row in codes.astype(np.uint8)]
            whole = np.zeros(batch.num_rows, np.int64)
            whole[fits] = error
            out = pa.RecordBatch.from_arrays(
                [
                    *[batch.column(n) for n in names],
                    pa.array(text.tolist(), pa.string()),
                    pa.array(whole, mask=~fits),
                ],
                names=[*names, "code", "error"],
            )
            yield out.filter(pa.array(usable))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    coded = narrow.mapInArrow(codes_of, f"{schema}, code string, error bigint")
    return coded.select(
        F.col("_id").alias(id_col), *[F.col(f"`_c_{c}`").alias(c) for c in carry], "code", "error"
    )


def decode(coded: DataFrame, shape: Shape, books: np.ndarray) -> DataFrame:
    """Codes back to vectors: ``approximate`` holds the entries, scaled back; else null."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for code in batch.column("code").to_pylist():
                if code is None:
                    out.append(None)
                    continue
                index = np.frombuffer(bytes.fromhex(code), np.uint8)
                whole = books[np.arange(shape.parts), index].reshape(-1)[: shape.width]
                out.append(whole / shape.scale)
            yield batch.append_column("approximate", pa.array(out, pa.list_(pa.float64())))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema.fields)
    return coded.mapInArrow(vectors, f"{fields}, approximate array<double>")


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress_query(
    df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", **sizes
) -> DataFrame:
    """Codes with errors summed over equal labels (nulls together) and the books' digest.

    Codes are written once. Label totals are written too, so that the join back is
    between plain shuffles, where Spark splits a label that holds much of the table.
    """
    shape, books = train(df, id_col, vector, **sizes)
    coded = stored(
        encode(df.withColumn("_label", F.col(label)), shape, books, id_col, vector, ("_label",)), "codes"
    )
    totals = stored(
        coded.groupBy(F.col("_label").alias("_of"))
        .agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("_total"))
        .select("_of", F.least("_total", F.lit(LONGEST).cast("decimal(38,0)")).cast("bigint").alias("label_error")),
        "label-errors",
    )
    return coded.join(totals, F.col("_label").eqNullSafe(F.col("_of"))).select(
        id_col,
        "code",
        "error",
        "label_error",
        F.lit(books_digest(books)).alias("codebooks_sha256"),
    )
