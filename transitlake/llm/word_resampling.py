"""Target-distribution importance resampling over hashed word n-grams.

A task keeps an Aho-Corasick automaton of words, each bounded by a delimiter on both
sides and carrying its CRC-32 and its length. A scan of a block of texts emits these
payloads in text order; the payloads of adjacent words are composed to the CRC of
their n-gram (CRC-32 is linear, so no text is hashed twice), and the CRC gives the
bucket. What the scan does not cover is words not yet in the automaton: their payloads
are worked out directly and they join it at the next rebuild. The automaton holds at
most ``WORDS`` words; further words go the direct way for good, so the bound changes
time, never a result.

Words are runs of digits, letters and bytes above 0x7F, after A-Z is lowered. Buckets
are counted over all documents and over all target texts; a bucket's gain is the
floored, scaled logarithm of the smoothed ratio. A document's score is the sum of the
gains of its n-grams plus Gumbel noise that its id fixes. Of the documents with enough
words the given share with the highest scores is drawn: sampling without replacement
in proportion to the weights.

A null or empty text has no words, so weight 0. A null id is hashed as the empty text
and comes after all others of its score; rows that tie in score and id are ranked in
the order of the stored relation, so which of them is drawn is arbitrary and how many
is not. Empty tables: no documents give no rows; no target texts make all target counts
0. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
import sys
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlake.llm.common import stored, whole_text

# Tasks carry this module's code with them; executors need no package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS = 200_000
BLOCK_BYTES = 2_000_000
CRC_POLYNOMIAL = 0xEDB88320

# Lowers A-Z and turns each byte that cannot stand in a word into a blank.
WORD_BYTES = bytes(
    b + 32
    if 0x41 <= b <= 0x5A
    else b
    if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b > 0x7F
    else 0x20
    for b in range(256)
)


# --- composing checksums -------------------------------------------------------


def _apply(columns: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map over bits, given by the images of the 32 bits, on many values."""
    out = np.zeros_like(crc)
    for bit in range(32):
        out ^= np.where((crc >> np.uint32(bit)) & np.uint32(1), columns[bit], np.uint32(0))
    return out


def _past_one() -> np.ndarray:
    """The map that moves a CRC past one byte."""
    columns = []
    for bit in range(32):
        x = 1 << bit
        for _ in range(8):
            x = (x >> 1) ^ (CRC_POLYNOMIAL if x & 1 else 0)
        columns.append(x)
    return np.array(columns, np.uint32)


PAST_ONE = _past_one()


def _past(length: int) -> np.ndarray:
    """The map that moves a CRC past ``length`` bytes, by repeated squaring."""
    if length == 1:
        return PAST_ONE
    half = _past(length // 2)
    whole = _apply(half, half)
    return _apply(PAST_ONE, whole) if length % 2 else whole


def joined_crc(left: np.ndarray, right: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRCs of left texts followed by right texts of the given lengths."""
    out = right.copy()
    for length in np.unique(lengths):
        rows = lengths == length
        out[rows] ^= _apply(_past(int(length)), left[rows]) if length else left[rows]
    return out


# --- the automaton -------------------------------------------------------------


class Dictionary:
    """Delimiter-bounded words with payloads; grows with the texts up to ``most``."""

    def __init__(self, most: int = WORDS):
        self.most = most
        self.words: dict[bytes, int] = {}
        self.crc: list[int] = []
        self.built = 0
        self.automaton = None
        self.payload = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _rebuild(self) -> None:
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for word, number in self.words.items():
            self.automaton.add_word(f" {word.decode('latin-1')} ", number)
        self.automaton.make_automaton()
        self.built = len(self.words)
        lengths = np.fromiter(map(len, self.words), np.int64, self.built)
        self.payload = np.array(self.crc, np.uint32), lengths

    def scan(self, blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, CRCs and lengths of all words of ``blob`` in text order.

        ``blob`` consists of words and blanks and has a blank at both ends.
        """
        found = np.zeros(0, [("end", "i8"), ("number", "i8")])
        if self.automaton is not None:
            # bytes as characters of the same number: places are byte offsets
            found = np.fromiter(self.automaton.iter(blob.decode("latin-1")), found.dtype)
        crcs, sizes = self.payload
        crc, length = crcs[found["number"]], sizes[found["number"]]
        start = found["end"] - length

        rest = np.frombuffer(blob, np.uint8) != 0x20
        if length.sum() < rest.sum():
            inside = np.zeros(len(blob) + 1, np.int8)
            inside[start] = 1
            inside[start + length] -= 1
            rest &= np.cumsum(inside[:-1], dtype=np.int8) == 0
            edges = np.flatnonzero(np.diff(rest.astype(np.int8), prepend=0, append=0))
            first, last = edges[::2], edges[1::2]
            words = [blob[a:b] for a, b in zip(first.tolist(), last.tolist())]
            own = {w: zlib.crc32(w) for w in set(words)}
            for word, value in own.items():
                if word not in self.words and len(self.words) < self.most:
                    self.words[word] = len(self.words)
                    self.crc.append(value)
            start = np.concatenate([start, first])
            crc = np.concatenate([crc, np.array([own[w] for w in words], np.uint32)])
            length = np.concatenate([length, last - first])
            order = start.argsort(kind="stable")
            start, crc, length = start[order], crc[order], length[order]
            # the cost of all rebuilds stays in proportion to the last one
            if len(self.words) > 1.25 * self.built:
                self._rebuild()
        return start, crc, length


def gram_crcs(
    texts: list[bytes], dictionary: Dictionary, most: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, n-gram CRC) of every run of 1 to ``most`` words, and words per text."""
    blob = b" " + b" ".join(t.translate(WORD_BYTES) for t in texts) + b" "
    start, crc, length = dictionary.scan(blob)
    ends = np.cumsum([len(t) + 1 for t in texts])
    text = np.searchsorted(ends, start - 1, side="right")
    blank = np.uint32(zlib.crc32(b" "))
    all_texts, all_crcs = [text], [crc]
    run, of = crc, np.arange(len(crc))
    for _ in range(1, most):
        # a run goes on if the next word belongs to the same text
        on = of + 1 < len(crc)
        on[on] = text[of[on] + 1] == text[of[on]]
        run, of = run[on], of[on] + 1
        spaced = _apply(PAST_ONE, run) ^ blank
        run = joined_crc(spaced, crc[of], length[of])
        all_texts.append(text[of])
        all_crcs.append(run)
    return np.concatenate(all_texts), np.concatenate(all_crcs), np.bincount(text, minlength=len(texts))


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of rows of about ``BLOCK_BYTES``: first row and texts."""
    texts, start, size = [], 0, 0
    for i, value in enumerate(batch.column("_text")):
        texts.append(value.as_py())
        size += len(texts[-1])
        if size >= BLOCK_BYTES:
            yield start, texts
            texts, start, size = [], i + 1, 0
    if texts:
        yield start, texts


def hashed(df: DataFrame, text: str, id_col: str | None, grams: int, buckets: int) -> DataFrame:
    """(_id, _words, _buckets): bucket numbers of all n-grams of a text, packed.

    Texts are scanned once; two bytes per n-gram (four above 65,536 buckets) are kept.
    """
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")
    given = F.col(id_col) if id_col else F.lit(None).cast("bigint")
    narrow = df.select(given.alias("_id"), whole_text(text).cast("binary").alias("_text"))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary = Dictionary()
        for batch in batches:
            for start, texts in _blocks(batch):
                of, crc, words = gram_crcs(texts, dictionary, grams)
                numbers = (crc % np.uint32(buckets)).astype(kind)
                numbers = numbers[np.argsort(of, kind="stable")]
                cuts = np.cumsum(np.bincount(of, minlength=len(texts)))[:-1]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id").slice(start, len(texts)),
                        pa.array(words.astype(np.int64)),
                        pa.array([part.tobytes() for part in np.split(numbers, cuts)], pa.binary()),
                    ],
                    names=["_id", "_words", "_buckets"],
                )

    id_kind = narrow.schema["_id"].dataType.simpleString()
    return narrow.mapInArrow(scanned, f"_id {id_kind}, _words bigint, _buckets binary")


def bucket_counts(packed: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs: a task hands on one row per bucket at most."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column("_buckets"):
                total += np.bincount(np.frombuffer(value.as_py(), kind), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int64)), pa.array(total[used])], names=["bucket", "n"]
        )

    rows = (
        packed.select("_buckets")
        .mapInArrow(counted, "bucket bigint, n bigint")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    out = np.zeros(buckets, np.int64)
    for row in rows:
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(smoothed target share / smoothed source share)) per bucket."""
    all_source, all_target, n = int(source.sum()), int(target.sum()), len(source)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * (all_source + n) / ((s + 1.0) * (all_target + n))))
            for s, t in zip(source.tolist(), target.tolist())
        ],
        np.int64,
    )


def _weighted(packed: DataFrame, gain: np.ndarray) -> DataFrame:
    kind = np.dtype("<u2" if len(gain) <= 1 << 16 else "<u4")
    fields = [f for f in packed.schema.fields if f.name != "_buckets"]

    def weighted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, weight = [], []
            for value in batch.column("_buckets"):
                numbers = np.frombuffer(value.as_py(), kind)
                grams.append(len(numbers))
                weight.append(int(gain[numbers].sum()))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(f.name) for f in fields],
                    pa.array(grams, pa.int64()),
                    pa.array(weight, pa.int64()),
                ],
                names=[*[f.name for f in fields], "n_features", "weight"],
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    return packed.mapInArrow(weighted, f"{schema}, n_features bigint, weight bigint")


# --- drawing -------------------------------------------------------------------


def ranked(scored: DataFrame, share: int, least_words: int) -> DataFrame:
    """Add ``rank`` from 1 to the drawn rows, null to the others.

    Rows are cut into sorted pieces by score and id, written with their place in the
    piece, and moved up by the rows of the pieces before; one number per piece reaches
    the driver.
    """
    spark = scored.sparkSession
    fit = F.col("_words") >= least_words
    pieces = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("score"), F.asc_nulls_last("_id"), F.asc("_row")]
    # the id of a row in its partition after the sort: partition in the upper bits
    cut = stored(
        scored.where(fit)
        .repartitionByRange(pieces, *order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        "ranked",
    )
    counts = cut.groupBy(F.expr("shiftright(_place, 33)").alias("piece")).count().collect()
    before, offsets = 0, []
    for piece, n in sorted(tuple(r) for r in counts):
        offsets.append((piece, before))
        before += n
    drawn = share * before // 100
    offset = F.lit(0).cast("bigint")
    if offsets:
        first = {p: at for p, at in offsets}
        moved = [first.get(p, 0) for p in range(max(first) + 1)]
        text = F.split(F.lit(",".join(map(str, moved))), ",").cast("array<bigint>")
        offset = text[F.expr("shiftright(_place, 33)").cast("int")]
    place = offset + F.expr(f"_place & {(1 << 33) - 1}L") + 1
    rank = F.when(place <= drawn, place)
    rest = scored.where(~F.coalesce(fit, F.lit(False)))
    return cut.withColumn("rank", rank).drop("_place").unionByName(
        rest.withColumn("rank", F.lit(None).cast("bigint"))
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    grams: int = 1,
    buckets: int = 10_000,
    share: int = 10,
    least_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """(id, n_features, weight, score, rank) of every document; rank null if not drawn.

    Per bucket one count and one gain pass the driver, at most ``buckets`` of each.
    """
    packed = stored(hashed(docs, text, id_col, grams, buckets), "hashed")
    wanted = bucket_counts(hashed(target, target_text, None, grams, buckets), buckets)
    gain = gains(bucket_counts(packed, buckets), wanted)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = stored(
        _weighted(packed, gain)
        .withColumn("score", F.col("weight") + noise)
        .withColumn("_row", F.monotonically_increasing_id()),
        "scored",
    )
    return ranked(scored, share, least_words).select(
        F.col("_id").alias(id_col), "n_features", "weight", "score", "rank"
    )


def drawn_documents(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The drawn rows of ``docs``, whole; ids should differ.

    Rows that share an id are drawn together if one of them is.
    """
    ids = (
        resample(docs, target, id_col=id_col, **options)
        .where("rank IS NOT NULL")
        .select(F.col(id_col).alias("_drawn"))
        .distinct()
    )
    ids = stored(ids, "drawn")
    return docs.join(ids, docs[id_col].eqNullSafe(ids["_drawn"]), "left_semi")
