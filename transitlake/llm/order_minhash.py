"""Order MinHash fingerprints, sensitive to edit distance.

The k-mers of a text are numbered by occurrence. Each of the hash functions takes the
``PICK`` least numbered k-mers, puts them in text order and hashes that tuple. Two
texts agree in a value when the same k-mers are picked and stand in the same order,
so moving passages lowers the likeness, which plain MinHash does not see.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlake.llm.common import text_blocks, whole_text

KMER = 6
PICK = 2
VALUES = 32
# Rows per piece of the document order, and the most pieces.
PIECE_ROWS = 4096
MOST_PIECES = 20_000
PLACE_BITS = 22
RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)

_rng = np.random.default_rng(1702)
_ODD = (_rng.integers(0, 1 << 31, VALUES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
BUFFER = 1 << 18
_space = np.empty(BUFFER, np.uint32)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _numbered(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, hash and numbered hash of each k-mer, in any order."""
    size = min(KMER, len(points))
    n = len(points) - size + 1
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h = h * _STEP + points[k : k + n]
    h = _mixed(h)
    if n < 1 << PLACE_BITS:
        # sorting (hash, place) as one number brings equal k-mers together, in text order
        low = np.uint64((1 << PLACE_BITS) - 1)
        both = np.sort((h & ~low) | np.arange(n, dtype=np.uint64))
        place, h = (both & low).astype(np.int64), both >> np.uint64(PLACE_BITS)
    else:
        h = h >> np.uint64(PLACE_BITS)
        place = np.argsort(h, kind="stable")
        h = h[place]
    start = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    number = np.arange(n) - np.repeat(start, np.diff(np.r_[start, n]))
    return place, h, _mixed(h * _STEP + number.astype(np.uint64))


def values(text: str) -> np.ndarray:
    """The fingerprint's values; a text without characters has all zeros."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if not len(points):
        return np.zeros(VALUES, np.uint32)
    place, kmer, numbered = _numbered(points)
    low = numbered.astype(np.uint32)
    pick = min(PICK, len(low))
    chosen = np.empty((VALUES, pick), np.int64)
    step = min(VALUES, max(1, BUFFER // len(low)))
    # one buffer for all texts but the longest: fresh memory would cost more than the hashing
    space = _space if len(low) <= BUFFER else np.empty(len(low), np.uint32)
    for a in range(0, VALUES, step):
        odd = _ODD[a : a + step, None]
        order = space[: len(odd) * len(low)].reshape(len(odd), len(low))
        np.multiply(low, odd, out=order)
        row = np.arange(len(order))
        for k in range(pick):
            chosen[a : a + step, k] = at = order.argmin(axis=1)
            order[row, at] = np.uint32(0xFFFFFFFF)
    chosen = np.take_along_axis(chosen, place[chosen].argsort(axis=1), axis=1)
    out = np.full(VALUES, pick, np.uint64)
    for k in range(pick):
        out = _mixed(out * _STEP + kmer[chosen[:, k]])
    return (out >> np.uint64(32)).astype(np.uint32)


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    return float((x == y).mean())


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_blocks(batches, "__text"):
        made = pa.array([values(t).tobytes().hex() for t in texts], pa.string())
        yield pa.RecordBatch.from_arrays([*part.columns[:-1], made], names=[*part.schema.names[:-1], "fingerprint"])


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with a column ``fingerprint`` of their whole text (null: empty).

    Narrow. Equal texts have equal fingerprints; likeness is the share of equal
    values (of eight hexadecimal digits each).
    """
    names = [c for c in docs.columns if c != "fingerprint"]
    source = docs.select(*names, whole_text(text).alias("__text"))
    return source.mapInArrow(
        _fingerprints, docs.select(*names, F.lit("").alias("fingerprint")).schema
    )


# --- neighbours ------------------------------------------------------------------


def _pieces(ids: DataFrame) -> tuple[list[float], list[tuple[int, int]]]:
    """Borders of the pieces of the order, and for each piece's first row the piece
    before it, which needs a copy of that row. Bounded by the number of pieces."""
    count = ids.count()
    n = max(1, min(MOST_PIECES, count // PIECE_ROWS))
    at = [i / n for i in range(1, n)]
    marks = ids.agg(F.percentile_approx("__key", at, 100 * n).alias("m")).first().m if at else []
    return sorted({float(m) for m in marks or []}), n


def _with_piece(df: DataFrame, borders: list[float]) -> DataFrame:
    """``__piece``: how many borders are at or below the key."""
    from pyspark.ml.feature import Bucketizer

    if not borders:
        return df.withColumn("__piece", F.lit(0))
    cut = Bucketizer(
        splits=[float("-inf"), *borders, float("inf")], inputCol="__wide", outputCol="__piece"
    )
    return (
        cut.transform(df.withColumn("__wide", F.col("__key").cast("double")))
        .withColumn("__piece", F.col("__piece").cast("int"))
        .drop("__wide")
    )


def in_pieces(docs: DataFrame) -> DataFrame:
    """doc_id and text in descending order of doc_id, piece by piece.

    A piece ends with a copy (``ghost``) of the row that follows its last one; the
    last piece's copy is the first row of all. Rows with equal doc_id are in order
    of their texts; null doc_ids come last.
    """
    spark = docs.sparkSession
    keyed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        whole_text().alias("text"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("__key"),
    )
    borders, _ = _pieces(keyed.select("__key"))
    placed = _with_piece(keyed, borders)
    # one row per piece
    firsts = sorted(
        (r["__piece"], r["first"])
        for r in placed.groupBy("__piece").agg(F.max("__key").alias("first")).collect()
    )
    after = [p for p, _ in firsts[1:]] + [p for p, _ in firsts[:1]]
    copies = spark.createDataFrame(
        [(first, p) for (_, first), p in zip(firsts, after, strict=True)], "__key bigint, __to int"
    )
    own = F.struct(F.col("__piece").alias("piece"), F.lit(False).alias("ghost"))
    copy = F.struct(F.col("__to").alias("piece"), F.lit(True).alias("ghost"))
    rows = placed.join(F.broadcast(copies), "__key", "left").select(
        F.explode(F.array_compact(F.array(own, F.when(F.col("__to").isNotNull(), copy)))).alias("__at"),
        "doc_id",
        "text",
        "__key",
    )
    return (
        rows.select("__at.piece", "__at.ghost", "doc_id", "text", "__key")
        .repartition("piece")
        .sortWithinPartitions("piece", "ghost", F.desc("__key"), "text")
    )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    held = None  # (piece, doc_id, text, values) that waits for what follows it

    def finish(text: str, own: np.ndarray, doc_id, next_text: str, following: np.ndarray) -> tuple:
        n = len(text)
        moved = n // 3
        edited = text[: n - moved] + next_text[:moved]
        other = values(edited)
        return (
            doc_id,
            n,
            hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            own.tobytes().hex(),
            other.tobytes().hex(),
            likeness(own, other),
            likeness(own, following),
        )

    def batch() -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        columns = zip(*rows) if rows else [[] for _ in types]
        names = [c.split()[0] for c in RESULT.split(", ")]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=names
        )

    for part, texts in text_blocks(batches):
        pieces, ghosts = part.column("piece").to_pylist(), part.column("ghost").to_pylist()
        for piece, ghost, doc_id, text in zip(
            pieces, ghosts, part.column("doc_id").to_pylist(), texts, strict=True
        ):
            if held is None and ghost:
                continue  # a second row with the doc_id of the copy
            own = values(text)
            if held is not None:
                rows.append(finish(held[1], held[2], held[0], text, own))
            held = None if ghost else (doc_id, text, own)
        if rows:
            yield batch()
            rows = []


def with_next(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint, that of an edited form, and likenesses.

    Returns doc_id, n_chars (code points), edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next for every row of ``docs``, of which
    doc_id and text are read. The edited text has its last third replaced by the
    start of the next document's text, in descending order of doc_id and around to
    the first; a lone document is its own next. Null and empty texts fingerprint
    alike, and are like each other. Rows of equal doc_id are in order of text.

    The texts are shuffled once, to pieces of the order; only the first row of each
    piece travels twice, and a task streams its pieces row by row.
    """
    return in_pieces(docs).mapInArrow(_compare, RESULT)
