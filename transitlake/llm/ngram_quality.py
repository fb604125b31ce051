"""Quality by perplexity under an interpolated modified Kneser-Ney n-gram model.

Words are predicted from the word before them. Pairs of words of all trusted text are
counted; continuation counts, totals and discounts are aggregations of these counts,
and the shares below the single words are spelling probabilities, from a Kneser-Ney
model over UTF-8 bytes, so that a new word of any script costs what its letters cost. An
interpolated model is a sum over the n-grams of a text:

    ln P(text) = sum of ln(base(w)) over its words + sum of value(g) over its n-grams

where a pair's value is what it adds to its word's, and a word's value holds the
weight it leaves as a context. Unknown n-grams have the value 0, so the perplexity of
a document is one join of its n-grams with the values and one sum, sharded by n-gram
(the n-grams of a block of texts travel packed, one row a shard). The model grows with
the trusted text, and no task holds all of it.

The most frequent words, at most MOST_WORDS, have numbers that all tasks know. A pair of
two such words is a small number, its values follow from its counts and from what the
tasks know of its words, and so it takes a few bytes wherever it is stored or shuffled.
Other words and pairs are hashes, and their values are rows. Of the pairs of frequent
words the most frequent ones, at most HEAD of them, are sent to all tasks, which keeps
those that nearly every document holds out of the join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlake.llm.common import Shelf, text_blocks, whole_text

BYTES = 256
ORDER = 3
# Largest dense table of a model over chosen characters (numbers of four bytes).
MOST_CELLS = 1 << 22
# Thresholds are exact to this many bins a nat.
BINS = 2000
# Most pairs whose values are sent to all tasks.
HEAD = 1 << 20
# Most words that all tasks know by a number.
MOST_WORDS = 1 << 18
# Bytes of text in a block; its n-grams travel in one row a shard.
BLOCK = 4_000_000
# A shard has the words and pairs of about so many words, or of so many bytes of trusted
# text, or the n-grams of so many bytes of text.
SHARD_VALUES, SHARD_TRUSTED, SHARD_BYTES = 1 << 19, 1 << 24, 1 << 26
# Texts are scored in so many turns, each for its share of the texts: a turn's shuffle holds
# that part of their n-grams, and all values. Each text's n-grams are made in one turn.
TURNS = 2
# Numbers of words have at most so many bits.
WORD_BITS = 24
# The pairs of the most frequent words, so many, are dealt over shards by what follows, too.
SPREAD = 1024
# Context of the first word and the word after the last; no text has these words.
START, END = "\n", ""
# Models: of all trusted text, and of each half of it for the documents of the other.
MODELS = ("whole", "half1", "half0")


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def symbols(text: str, table: np.ndarray, order: int) -> np.ndarray:
    """The text as symbols, after ``order`` - 1 times the symbol 0."""
    if len(table) == BYTES:
        points = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    else:
        points = code_points(text)
    return np.concatenate([np.zeros(order - 1, np.int32), table[points]])


def ngrams(text: str, table: np.ndarray, size: int, order: int) -> np.ndarray:
    """The number of the n-gram that ends at each symbol."""
    s = symbols(text, table, order)
    n = len(s) - order + 1
    out = s[:n].astype(np.int32)
    for k in range(1, order):
        out = out * np.int32(size) + s[k : k + n]
    return out


def lookup_table(alphabet: list[int] | None) -> np.ndarray:
    """The symbol of each code point; without an alphabet, that of each byte."""
    if alphabet is None:
        table = np.arange(BYTES, dtype=np.int32)
        table[0] = BYTES - 1  # 0 is the padding, and 255 is no byte of UTF-8
        return table
    table = np.zeros(0x110000, np.int32)
    table[alphabet] = np.arange(1, len(alphabet) + 1)
    return table


# --- counts -------------------------------------------------------------------


def _point_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0x110000, np.int64)
    for _, texts in text_blocks(batches):
        points, n = np.unique(code_points("".join(texts)), return_counts=True)
        total[points] += n
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["point", "n"]
    )


def choose_alphabet(trusted: DataFrame, size: int) -> list[int]:
    """The ``size`` - 1 most frequent code points of all trusted text."""
    counts = trusted.mapInArrow(_point_counts, "point int, n bigint")
    top = counts.groupBy("point").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "point")
    return [r.point for r in top.limit(size - 1).collect()]


def _ngram_counts(alphabet: list[int] | None, size: int, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = lookup_table(alphabet)
        for _, texts in text_blocks(batches):
            found = [ngrams(t, table, size, order) for t in texts]
            grams, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams.astype(np.int64)), pa.array(n.astype(np.int64))], names=["gram", "n"]
            )

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Discounts of n-grams seen once, twice and more often (Chen and Goodman).

    Where a count of counts is zero the rule has no value; then one half, within the
    count, is taken.
    """
    if not n1 or not n2:
        return (0.5, 0.5, 0.5)
    y = n1 / (n1 + 2 * n2)
    d1 = 1 - 2 * y * n2 / n1
    d2 = 2 - 3 * y * n3 / n2
    d3 = 3 - 4 * y * n4 / n3 if n3 else d2
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in ((1, d1), (2, d2), (3, d3)))


def discounted(counts: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """(gram, share) after discounting, and (context, left): what goes to lower orders."""
    r = counts.agg(*[F.count(F.when(F.col("n") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4)])
    d1, d2, d3 = discounts(*r.first())
    off = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
    split = counts.select(
        "gram", "n", F.expr(f"gram div {size}").alias("context"), off.alias("off")
    )
    contexts = split.groupBy("context").agg(
        F.sum("n").alias("total"), F.sum(F.expr("cast(round(off * 1e9) as bigint)")).alias("taken")
    )
    shares = split.join(contexts, "context").select(
        "gram", ((F.col("n") - F.col("off")) / F.col("total")).alias("share")
    )
    return shares, contexts.select("context", (F.col("taken") / F.col("total") / 1e9).alias("left"))


@dataclass
class SeenLosses:
    """Losses of n-grams as rows: those seen by themselves, all others by their parts."""

    size: int
    lower: int  # how many n-grams the next lower order has
    grams: np.ndarray  # those seen, sorted
    own: np.ndarray
    left: np.ndarray  # loss of what a context leaves to the lower order
    rest: np.ndarray  # loss of each n-gram of the lower order

    def __getitem__(self, grams: np.ndarray) -> np.ndarray:
        out = self.left[grams // self.size] + self.rest[grams % self.lower]
        if len(self.grams):
            at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
            out = np.where(self.grams[at] == grams, self.own[at], out)
        return out


@dataclass
class Model:
    alphabet: list[int] | None
    size: int
    order: int
    losses: np.ndarray | SeenLosses  # of each n-gram, in nats

    def loss(self, text: str, table: np.ndarray) -> float:
        return float(self.losses[ngrams(text, table, self.size, self.order)].sum(dtype=np.float64))


def train(
    trusted: DataFrame, size: int | None = None, order: int = ORDER, shelf: Shelf | None = None
) -> Model:
    """Train on the ``text`` of all rows of ``trusted`` (which may be empty).

    The symbols are the bytes of UTF-8, so no script falls together with the padding;
    with ``size``, the ``size`` - 1 most frequent characters and one for all others. Over
    bytes, the n-grams of the highest order are rows for those seen, at most 256 ^ order.
    """
    alphabet, shelf = None, shelf or Shelf(trusted.sparkSession)
    if size is None:
        size = BYTES
    else:
        if size**order > MOST_CELLS:
            raise ValueError(f"{size}^{order} is over {MOST_CELLS} numbers")
        alphabet = choose_alphabet(trusted, size)
    grams = trusted.mapInArrow(_ngram_counts(alphabet, size, order), "gram bigint, n bigint")
    counts = shelf.put(grams.groupBy("gram").agg(F.sum("n").alias("n")), "ngrams")
    levels = [counts]
    for m in range(order - 1, 0, -1):
        # how many different symbols come before: one for each longer n-gram
        lower = levels[0].groupBy(F.expr(f"gram % {size**m}").alias("gram"))
        levels.insert(0, lower.agg(F.count(F.lit(1)).alias("n")))
    p = np.full(1, 1.0 / size)
    for m, level in enumerate(levels, 1):
        shares, lefts = (x.toArrow() for x in discounted(level, size))
        left = np.ones(size ** (m - 1))
        left[lefts["context"].to_numpy()] = lefts["left"].to_numpy()
        if alphabet is None and m == order:
            shares = shares.sort_by("gram")
            grams, lower = shares["gram"].to_numpy(), size ** (m - 1)
            own = shares["share"].to_numpy() + left[grams // size] * p[grams % lower]
            return Model(
                None,
                size,
                order,
                SeenLosses(size, lower, grams.astype(np.int32), *(
                    (-np.log(x)).astype(np.float32) for x in (own, left, p)
                )),
            )
        p = np.repeat(p, size) if m == 1 else np.tile(p, size)
        p = p * np.repeat(left, size)
        p[shares["gram"].to_numpy()] += shares["share"].to_numpy()
    return Model(alphabet, size, order, (-np.log(p)).astype(np.float32))


# --- words and pairs ------------------------------------------------------------


def _word_key(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))


def spelled(text: str = "text"):
    """The text in the form that the spelling model reads: words apart by two blanks."""
    words = F.regexp_replace(F.trim(F.lower(text)), r"\s+", "  ")
    return F.concat(F.lit("  "), words, F.lit(" "))


class Words:
    """The words of a block of texts: place in the vocabulary, keys, spelling losses."""

    def __init__(self, texts: list[str], spelling: Model | None = None, table: np.ndarray | None = None):
        number = {START: 0, END: 1}
        self.docs = []
        for t in texts:
            ids = [number.setdefault(w, len(number)) for w in t.lower().split()]
            self.docs.append(np.array([0, *ids, 1], np.int64))
        self.keys = np.fromiter(map(_word_key, number), np.uint64, len(number)).view(np.int64)
        if spelling is None:
            return
        words = list(number)[1:]
        # two blanks before each word are its context, the one after it is its end
        line = "  " + "  ".join(words) + "  "
        losses = spelling.losses[ngrams(line, table, spelling.size, spelling.order)]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        if spelling.alphabet is None:
            spans = np.fromiter((len(w.encode("utf-8", "surrogatepass")) for w in words), np.int64, len(words))
        else:
            spans = lengths
        ends = np.cumsum(spans + 2) + 1
        total = np.concatenate([[0.0], np.cumsum(losses, dtype=np.float64)])
        base = total[ends] - total[ends - spans - 1]
        self.base = np.concatenate([[0.0], -base])  # ln of the spelling probability
        self.chars = np.concatenate([[0], lengths + 1])  # with the blank after a word


def pair_key(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Key of a pair; ``PAIR`` is the same in SQL."""
    b = before.view(np.uint64)
    return ((b << np.uint64(1)) | (b >> np.uint64(63))).view(np.int64) ^ word


PAIR = "(shiftleft(h, 1) | shiftrightunsigned(h, 63)) ^ w"


@dataclass
class Often:
    """The most frequent words and their numbers, 0 for the most frequent one."""

    keys: np.ndarray  # sorted as unsigned numbers
    numbers: np.ndarray

    @classmethod
    def ranked(cls, keys: np.ndarray) -> Often:
        """From the keys in the order of their numbers."""
        order = np.argsort(keys.view(np.uint64))
        return cls(keys.view(np.uint64)[order], order)

    def by_number(self) -> np.ndarray:
        keys = np.empty(len(self.keys), np.uint64)
        keys[self.numbers] = self.keys
        return keys.view(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for words that have none."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        asked = keys.view(np.uint64)
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        return np.where(self.keys[at] == asked, self.numbers[at], -1)


def _pair_codes(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Pairs of numbered words as one number."""
    return before.astype(np.uint64) << np.uint64(WORD_BITS) | word.astype(np.uint64)


def _of_codes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (codes >> np.uint64(WORD_BITS)).astype(np.int64), (codes & np.uint64((1 << WORD_BITS) - 1)).astype(np.int64)


def _code_shards(codes: np.ndarray, bits: int) -> np.ndarray:
    """Pairs of one word are neighbours in one shard, but for those of very frequent words."""
    before, word = _of_codes(codes)
    mixed = (before << WORD_BITS | np.where(before < SPREAD, word >> 8, 0)).astype(np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(21))) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def _gram_shards(grams: np.ndarray, bits: int) -> np.ndarray:
    return (grams.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def _by_shard(shards: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard that occurs, with the places it has, in their order."""
    order = np.argsort(shards.astype(np.uint16 if shards.max(initial=0) < 1 << 16 else np.int64), kind="stable")
    start = np.flatnonzero(np.diff(shards[order], prepend=-1))
    for a, b in pairwise(np.append(start, len(order))):
        yield int(shards[order[a]]), order[a:b]


def _planes(x: np.ndarray, kind: str) -> bytes:
    """The numbers byte by byte: all lowest bytes, then the next ones. High bytes of small
    numbers stand together as zeros, which compress to nothing."""
    x = x.astype(kind)
    return x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def _columns(packed: bytes, *kinds: str) -> list[np.ndarray]:
    """The numbers of columns that were packed one after the other."""
    sizes = [np.dtype(k).itemsize for k in kinds]
    rows, out, at = int.from_bytes(packed[:8], "little"), [], 0
    if not rows:
        return [np.zeros(0, k) for k in kinds]
    plain = pa.decompress(packed[8:], rows * sum(sizes), codec="zstd", asbytes=True)
    for kind, size in zip(kinds, sizes, strict=True):
        part = np.frombuffer(plain, np.uint8, rows * size, at)
        out.append(np.ascontiguousarray(part.reshape(size, rows).T).view(kind).reshape(-1))
        at += rows * size
    return out


def _pack(*columns: tuple[np.ndarray, str]) -> bytes:
    rows = len(columns[0][0])
    plain = b"".join(_planes(x, kind) for x, kind in columns)
    return rows.to_bytes(8, "little") + (pa.compress(plain, codec="zstd", asbytes=True) if rows else b"")


# What a row carries: values of a shard; counts of a shard's pairs of numbered words; sums of
# a block's texts; n-grams of a block's texts, of one shard; what these add to the sums;
# counts of a shard's other pairs.
VALUES, PAIRS, SUMS, GRAMS, ADDED, RARE = range(6)
PACKED = "shard int, kind int, block bigint, packed binary"
GRAM_COLUMNS = ("<u8", "<u4", "<u4")  # difference to the n-gram before, text, count
VALUE_COLUMNS = ("<u8", *["<f4"] * len(MODELS))
SUM_COLUMNS = ("<i8", "<i8", *["<f8"] * (2 + len(MODELS)))  # key, n, chars, base, one a model
ADDED_COLUMNS = ("<u4", *["<f4"] * len(MODELS))
PAIR_COLUMNS = ("<u8", "<u8", "<u8")  # difference to the pair before, counts in both halves
RARE_COLUMNS = ("<u8", "<u8", "<u8", "<u8")  # difference to the word before, word, counts
# Rows of pairs that a task holds before it adds up those that are equal.
HELD = 1 << 21


def _packed_rows(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    types = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
    columns = list(zip(*rows, strict=True)) or [()] * len(types)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
        names=["shard", "kind", "block", "packed"],
    )


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def _steps(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=np.uint64(0))


def _pack_pairs(keys: list[np.ndarray], n: list[np.ndarray]) -> bytes:
    """Sorted pairs: numbers of pairs, or the keys of both words, with their counts."""
    kinds = PAIR_COLUMNS if len(keys) == 1 else RARE_COLUMNS
    return _pack(*zip((_steps(keys[0]), *keys[1:], *n), kinds, strict=True))


def _unpack_pairs(kind: int, packed: bytes) -> list[np.ndarray]:
    first, *others = _columns(packed, *(PAIR_COLUMNS if kind == PAIRS else RARE_COLUMNS))
    return [np.cumsum(first, dtype=np.uint64), *others]


def _word_counts(sent):
    """The different words of each block but START, with counts and spelling."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelling = sent.value
        table = lookup_table(spelling.alphabet)
        for _, texts in text_blocks(batches, most=BLOCK):
            words = Words(texts, spelling, table)
            n = np.bincount(np.concatenate(words.docs), minlength=len(words.keys))
            yield pa.RecordBatch.from_arrays(
                [pa.array(words.keys[1:]), pa.array(n[1:]), pa.array(words.base[1:])], names=["w", "n", "base"]
            )

    return run


def _pair_counts(sent, bits: int):
    """Counts of the different pairs of each block, one row for each shard and kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_blocks(batches, most=BLOCK):
            # a block's arrays go before the next block's come
            yield from packed(sent.value, part, texts)

    def packed(often: Often, part: pa.RecordBatch, texts: list[str]) -> Iterator[pa.RecordBatch]:
        words = Words(texts)
        half = np.array(part.column("half").to_pylist(), np.int64)
        size = len(words.keys)
        pair = np.concatenate([(d[:-1] * size + d[1:]) * 2 + k for d, k in zip(words.docs, half, strict=True)])
        pair, n = np.unique(pair, return_counts=True)
        start = np.flatnonzero(np.diff(pair >> 1, prepend=-1))
        n = [np.add.reduceat(n * (pair & 1 == k), start) for k in (0, 1)]
        h, w = np.divmod(pair[start] >> 1, size)
        numbers = often.of(words.keys)
        known = (numbers[h] >= 0) & (numbers[w] >= 0)
        codes = _pair_codes(numbers[h[known]], numbers[w[known]])
        order = np.argsort(codes)
        codes, own = codes[order], [x[known][order] for x in n]
        for shard, at in _by_shard(_code_shards(codes, bits)):
            yield _packed_rows([(shard, PAIRS, 0, _pack_pairs([codes[at]], [x[at] for x in own]))])
        h, w = (words.keys[x[~known]].view(np.uint64) for x in (h, w))
        order = np.lexsort((w, h))
        h, w, own = h[order], w[order], [x[~known][order] for x in n]
        for shard, at in _by_shard(_gram_shards(pair_key(h.view(np.int64), w.view(np.int64)), bits)):
            yield _packed_rows([(shard, RARE, 0, _pack_pairs([h[at], w[at]], [x[at] for x in own]))])

    return run


def _summed_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each shard and kind, from rows that come by both."""

    def summed() -> list[np.ndarray]:
        columns = [np.concatenate(c) for c in zip(*held, strict=True)]
        keys, n = columns[:-2], columns[-2:]
        order = np.lexsort(keys[::-1])
        keys = [k[order] for k in keys]
        new = np.ones(len(order), bool)
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        start = np.flatnonzero(new)
        return [*(k[start] for k in keys), *(np.add.reduceat(x[order], start) for x in n)]

    def row() -> pa.RecordBatch:
        *keys, n0, n1 = summed()
        return _packed_rows([(*at, 0, _pack_pairs(keys, [n0, n1]))])

    at, held, size, least = None, [], 0, 0
    for batch in batches:
        for r in batch.to_pylist():
            if (r["shard"], r["kind"]) != at:
                if held:
                    yield row()
                at, held, size, least = (r["shard"], r["kind"]), [], 0, 0
            held.append(_unpack_pairs(r["kind"], r["packed"]))
            size += len(held[-1][0])
            if size > HELD + 2 * least:
                held = [summed()]
                size = least = len(held[0][0])
    if held:
        yield row()


def _models(n0: np.ndarray, n1: np.ndarray) -> list[np.ndarray]:
    """Counts in the order of MODELS."""
    return [(n0 + n1).astype(np.int64), n1.astype(np.int64), n0.astype(np.int64)]


def _offs(m: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(m, 3)]


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray], list[np.ndarray]]]:
    """(kind, keys, counts a model) of the pairs of each row."""
    for batch in batches:
        for r in batch.to_pylist():
            *keys, n0, n1 = _unpack_pairs(r["kind"], r["packed"])
            yield r["kind"], keys, _models(n0, n1)


def _counts_of_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(model, count, n): how many pairs have a count of 1 to 4."""
    total = np.zeros((len(MODELS), 6), np.int64)
    for _, _, m in _pair_rows(batches):
        for x in range(len(MODELS)):
            total[x] += np.bincount(np.minimum(m[x], 5), minlength=6)
    model, count = np.divmod(np.arange(4 * len(MODELS)), 4)
    yield pa.RecordBatch.from_arrays(
        [pa.array(model), pa.array(count + 1), pa.array(total[:, 1:5].reshape(-1))], names=["model", "count", "n"]
    )


SIDES = "side int, key bigint, a0 bigint, a1 bigint, a2 bigint, b0 double, b1 double, b2 double"


def _side_sums(sent, off: list[tuple[float, float, float]]):
    """Per row and word, as context (side 0): counts and what is taken off them; as the word
    predicted (side 1): counts, and before how many different words it stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = sent.value.by_number()
        for kind, pair, m in _pair_rows(batches):
            for side in (0, 1):
                word = _of_codes(pair[0])[side] if kind == PAIRS else pair[side]
                word, at = np.unique(word, return_inverse=True)
                other = [_offs(c, d) if side == 0 else (c > 0).astype(float) for c, d in zip(m, off, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(word), side, np.int32)),
                        pa.array(keys[word] if kind == PAIRS else word.view(np.int64)),
                        *(pa.array(np.bincount(at, c, len(word)).astype(np.int64)) for c in m),
                        *(pa.array(np.bincount(at, c, len(word))) for c in other),
                    ],
                    names=[c.split()[0] for c in SIDES.split(", ")],
                )

    return run


def _rare_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, (h, w), m in _pair_rows(batches):
        yield pa.RecordBatch.from_arrays(
            [pa.array(h.view(np.int64)), pa.array(w.view(np.int64)), *map(pa.array, m)],
            names=["h", "w", "m0", "m1", "m2"],
        )


# Key; values, counts as context, what they leave, shares: one each model.
KNOWN_COLUMNS = ("<u8", *["<f4"] * len(MODELS), *["<f8"] * (3 * len(MODELS)))


def _pack_known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [c.to_numpy() for c in batch.columns]
        packed = _pack(*zip((columns[0].view(np.uint64), *columns[1:]), KNOWN_COLUMNS, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], names=["packed"])


@dataclass
class NumberedWords:
    """What the values of pairs of numbered words follow from, by the words' numbers; an
    array each model."""

    total: list[np.ndarray]  # as context
    left: list[np.ndarray]  # what it leaves to single words
    share: list[np.ndarray]  # among single words
    off: list[tuple[float, float, float]]

    def values(self, codes: np.ndarray, m: list[np.ndarray]) -> list[np.ndarray]:
        """Per model what each pair adds to its word's value, as ``word_values`` has it."""
        out = [np.zeros(len(codes), np.float32) for _ in MODELS]
        for k in range(0, len(codes), 1 << 16):
            before, word = _of_codes(codes[k : k + (1 << 16)])
            for x in range(len(MODELS)):
                # a half that has not seen the pair may have a total or a share of 0
                count = m[x][k : k + (1 << 16)]
                seen = np.flatnonzero(count > 0)
                h, w, n = before[seen], word[seen], count[seen]
                own = ((n - _offs(n, self.off[x])) / self.total[x][h] / self.left[x][h]).astype(np.float32)
                out[x][k + seen] = np.log1p(own / self.share[x][w].astype(float))
        return out


@dataclass
class Values:
    """The values of all n-grams: rows of words and pairs by their hashes, and packed counts
    of pairs of numbered words."""

    rows: DataFrame  # gram, and one column a model
    pairs: DataFrame  # PACKED, of the kind PAIRS
    often: Often
    words: list[bytes]  # numbered words, as KNOWN_COLUMNS
    off: list[tuple[float, float, float]]  # taken off counts of pairs, each model
    bits: int  # of a shard's number


def _off(n: str, d: tuple[float, float, float]) -> str:
    return f"case {n} when 0 then 0D when 1 then {d[0]!r}D when 2 then {d[1]!r}D else {d[2]!r}D end"


def _count_discounts(df: DataFrame, names: list[str]) -> list[tuple[float, float, float]]:
    """Discounts for each column of counts."""
    found = df.agg(
        *[F.count(F.when(F.col(n) == k, 1)).alias(f"{n}_{k}") for n in names for k in (1, 2, 3, 4)]
    ).first()
    return [discounts(*found[4 * i : 4 * i + 4]) for i in range(len(names))]


def _beside(rows: DataFrame, words: DataFrame, key: str, most: int = MOST_WORDS) -> DataFrame:
    """``rows`` with the columns of ``words`` for their word.

    The ``most`` most frequent words (by ``n``, which goes) are sent to the tasks, so that only
    rows of other words are shuffled, and no frequent word makes a hot key.
    """
    often, seldom = _most_frequent(words, most)
    often, seldom = F.broadcast(often.drop("n")), seldom.drop("n")
    others = rows.join(often.select(key), key, "left_anti").join(seldom, key)
    return rows.join(often, key).unionByName(others)


def word_values(
    trusted: DataFrame, spelling: Model, shelf: Shelf | None = None, most: int = MOST_WORDS, size: int = 0
) -> tuple[Values, list[float]]:
    """Count and value of each n-gram in each model; and per model the logarithm of the
    weight that single words leave to spelling.

    ``trusted`` has text and half. Each relation is keyed by a word or a pair; of the
    ``most`` most frequent words, which have numbers, a few figures come to the driver and
    go to all tasks (how many they are does not change the result). What ``shelf`` holds as
    "trusted" goes once it is read. ``size`` is how many bytes of text will be scored.
    """
    spark = trusted.sparkSession
    shelf, context = shelf or Shelf(spark), spark.sparkContext
    sent = context.broadcast(spelling)
    counted = trusted.mapInArrow(_word_counts(sent), "w bigint, n bigint, base double")
    vocabulary = shelf.put(
        counted.groupBy("w").agg(F.sum("n").alias("n"), F.max("base").alias("base")), "vocabulary"
    )
    sent.destroy()
    own = trusted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(vocabulary.count() / SHARD_VALUES, own / SHARD_TRUSTED, size / SHARD_BYTES, 2)
    bits = int(np.ceil(np.log2(shards)))
    # END is a word like any other; START, the context of each first word, has the number 0
    frequent = _most_frequent(vocabulary.select("w", "n"), most)[0]
    top = frequent.toArrow()
    by_n = np.lexsort((top["w"].to_numpy(), -top["n"].to_numpy()))
    first = [_word_key(START)] if most else []
    often = Often.ranked(np.append(np.array(first, np.uint64).view(np.int64), top["w"].to_numpy()[by_n]))
    sent = context.broadcast(often)
    raw = trusted.mapInArrow(_pair_counts(sent, bits), PACKED)
    met = raw.repartition("shard").sortWithinPartitions("shard", "kind")
    pairs = shelf.put(met.mapInArrow(_summed_pairs, PACKED), "pairs", "kind").select("shard", "kind", "block", "packed")
    if "trusted" in shelf.paths:
        shelf.drop("trusted")
    models = range(len(MODELS))
    tallies = pairs.mapInArrow(_counts_of_counts, "model bigint, count bigint, n bigint")
    found = {(r.model, r["count"]): r.n for r in tallies.groupBy("model", "count").agg(F.sum("n").alias("n")).collect()}
    off2 = [discounts(*(found.get((x, k), 0) for k in (1, 2, 3, 4))) for x in models]
    sides = pairs.mapInArrow(_side_sums(sent, off2), SIDES)
    sides = shelf.put(sides.groupBy("side", "key").agg(*[F.sum(f"{c}{x}").alias(f"{c}{x}") for c in "ab" for x in models]), "sides")
    contexts = sides.where("side = 0").selectExpr(
        "key as h", *[f"a{x} as t{x}" for x in models], *[f"b{x} / nullif(a{x}, 0) as g{x}" for x in models]
    )
    ends = sides.where("side = 1").selectExpr(
        "key as w", "a0 as n", *[f"cast(b{x} as bigint) as c{x}" for x in models]
    )
    off1 = _count_discounts(ends, [f"c{x}" for x in models])
    row = ends.agg(
        *[F.sum(f"c{x}") for x in models], *[F.expr(f"sum({_off(f'c{x}', off1[x])})") for x in models]
    ).first()
    total = [row[x] or 0 for x in models]
    rest = [row[len(MODELS) + x] / total[x] if total[x] else 1.0 for x in models]
    words = shelf.put(
        ends.join(vocabulary.select("w", "base"), "w").selectExpr(
            "w",
            "n",
            "base",
            *[f"(c{x} - {_off(f'c{x}', off1[x])}) / {max(total[x], 1)}D + {rest[x]!r}D * exp(base) as p{x}" for x in models],
        ),
        "words",
    )
    left = [f"coalesce(ln(g{x}), 0D)" for x in models]
    figures = [f"{c}{x}" for c in "tgp" for x in models]

    def single(words: DataFrame, contexts: DataFrame) -> DataFrame:
        return words.join(contexts.withColumnRenamed("h", "w"), "w", "full").selectExpr(
            "w as gram",
            *[
                f"cast(coalesce(ln(p{x}) - {float(np.log(rest[x]))!r}D - base, 0D) + {left[x]} as float) as {MODELS[x]}"
                for x in models
            ],
            *[f"coalesce(cast({c} as double), 0D) as {c}" for c in figures],
        )

    numbers = F.broadcast(
        frequent.select("w").union(spark.range(len(first)).select(F.lit(often.by_number()[0] if most else 0)))
    )
    named = numbers.withColumnRenamed("w", "h")
    known = single(words.join(numbers, "w"), contexts.join(named, "h")).select("gram", *MODELS, *figures)
    known = [r.packed for r in known.mapInArrow(_pack_known, "packed binary").collect()]
    ones = single(words.join(numbers, "w", "left_anti"), contexts.join(named, "h", "left_anti"))
    ones = shelf.put(ones.select("gram", *MODELS), "singles")
    # what a pair has beside its word's share, over the weight that its context leaves
    beside = [
        f"cast(coalesce((m{x} - {_off(f'm{x}', off2[x])}) / nullif(t{x}, 0) / g{x}, 0D) as float) as a{x}" for x in models
    ]
    rare = pairs.where(f"kind = {RARE}").mapInArrow(
        _rare_pairs, "h bigint, w bigint, m0 bigint, m1 bigint, m2 bigint"
    )
    before = contexts.selectExpr("h", "t0 as n", *[f"t{x}" for x in models], *[f"g{x}" for x in models])
    shares = _beside(rare, before, "h", most).selectExpr("w", f"{PAIR} as gram", *beside)
    last = words.select("w", "n", *[f"p{x}" for x in models])
    double = _beside(shares, last, "w", most).selectExpr("gram", *[
        # the share of a long word that a half has not seen may be too small for a
        # double; then the half has not seen the pair either
        f"cast(coalesce(ln(1D + a{x} / nullif(p{x}, 0D)), 0D) as float) as {MODELS[x]}"
        for x in models
    ])
    double = shelf.put(double, "doubles")
    sent.destroy()
    shelf.drop("vocabulary", "sides", "words")
    shelf.drop_part("pairs", f"kind={RARE}")
    values = Values(ones.unionByName(double), pairs.where(f"kind = {PAIRS}"), often, known, off2, bits)
    return values, [float(np.log(r)) for r in rest]


# --- scores and thresholds ------------------------------------------------------


def _most_frequent(values: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The rows of the greatest ``n``, at most ``most`` rows, and all others."""
    step = F.floor(F.log2("n") * 8)
    first = _first_step(values.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("k")), most)
    if first is None:
        return values.limit(0), values
    return values.where(step >= first), values.where(step < first)


def _first_step(steps: DataFrame, most: int) -> int | None:
    """The least of the greatest steps that hold at most ``most`` rows."""
    held, first = 0, None
    for r in steps.orderBy(F.desc("step")).collect():  # some hundred steps
        held += r.k
        if held > most:
            break
        first = r.step
    return first


def _pair_steps(m: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(m) * 8).astype(np.int64)


def _step_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(64 * 8, np.int64)
    for _, _, m in _pair_rows(batches):
        total += np.bincount(_pair_steps(m[0]), minlength=len(total))
    steps = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(steps), pa.array(total[steps])], names=["step", "k"])


def _frequent_pairs(first: int):
    """Pairs of numbered words from the step ``first`` on, packed as they were."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (codes,), (_, n1, n0) in _pair_rows(batches):
            own = np.flatnonzero(_pair_steps(n0 + n1) >= first)
            yield _packed_rows([(0, PAIRS, 0, _pack_pairs([codes[own]], [n0[own], n1[own]]))])

    return run


def _head(values: Values, most: int) -> list[bytes]:
    """The most frequent pairs of numbered words, at most ``most``, packed."""
    steps = values.pairs.mapInArrow(_step_counts, "step bigint, k bigint").groupBy("step").agg(F.sum("k").alias("k"))
    first = _first_step(steps, most)
    if first is None:
        return []
    return [r.packed for r in values.pairs.mapInArrow(_frequent_pairs(first), PACKED).select("packed").collect()]


@dataclass
class _Known:
    """What all tasks know of the model, unpacked once in a process."""

    spelling: Model
    often: Often
    packed_words: list[bytes]
    off: list[tuple[float, float, float]]
    packed_head: list[bytes]

    @cached_property
    def figures(self) -> list[np.ndarray]:
        """KNOWN_COLUMNS but the key, by the words' numbers."""
        size = len(self.often.keys)
        out = [np.zeros(size, kind) for kind in KNOWN_COLUMNS[1:]]
        for packed in self.packed_words:
            keys, *columns = _columns(packed, *KNOWN_COLUMNS)
            at = self.often.of(keys)
            for o, c in zip(out, columns, strict=True):
                o[at] = c
        return out

    @property
    def single(self) -> list[np.ndarray]:
        """The values of words."""
        return self.figures[: len(MODELS)]

    @cached_property
    def words(self) -> NumberedWords:
        n = len(MODELS)
        return NumberedWords(*(self.figures[k * n : (k + 1) * n] for k in (1, 2, 3)), self.off)

    @cached_property
    def head(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """Pairs that all tasks know, sorted, and their values."""
        if not self.packed_head:
            return np.zeros(0, np.uint64), []
        columns = zip(*(_unpack_pairs(PAIRS, p) for p in self.packed_head), strict=True)
        codes, *n = (np.concatenate(c) for c in columns)
        order = np.argsort(codes)
        codes = codes[order]
        return codes, self.words.values(codes, _models(*(c[order] for c in n)))


def _counted(grams: np.ndarray, owner: np.ndarray, texts: int) -> list[np.ndarray]:
    """The different n-grams of each text, by n-gram and text: n-gram, text, count."""
    if texts <= 1 << 16 and not (grams >> np.uint64(2 * WORD_BITS)).any():
        both, n = np.unique(grams << np.uint64(16) | owner.astype(np.uint64), return_counts=True)
        return [both >> np.uint64(16), (both & np.uint64(0xFFFF)).astype(np.int64), n]
    # texts stay in order where n-grams are equal
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    start = np.flatnonzero(new)
    return [grams[start], owner[start], np.diff(np.append(start, len(grams)))]


def _pack_grams(entries: list[np.ndarray], at: np.ndarray) -> bytes:
    grams, owner, n = (x[at] for x in entries)
    return _pack(*zip((_steps(grams), owner, n), GRAM_COLUMNS, strict=True))


def _pack_texts(sent, bits: int, most: int):
    """Per block of texts one row of sums, and for each shard one row of the n-grams that
    are not known to the task: those of a text once, with their count. Pairs of numbered
    words come first in it, other n-grams after them."""

    nothing = _pack(*((np.zeros(0), kind) for kind in GRAM_COLUMNS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = lookup_table(sent.value.spelling.alphabet)
        for part, texts in text_blocks(batches, most=most):
            # a block's arrays go before the next block's come
            yield from packed(sent.value, table, part, texts)

    def packed(known: _Known, table: np.ndarray, part: pa.RecordBatch, texts: list[str]) -> Iterator[pa.RecordBatch]:
        count, words = len(texts), Words(texts, known.spelling, table)
        ids = np.concatenate(words.docs).astype(np.int32)
        doc = np.repeat(np.arange(count, dtype=np.int32), [len(d) for d in words.docs])
        number = known.often.of(words.keys).astype(np.int32)[ids]
        single = number >= 0
        added = [np.bincount(doc[single], v[number[single]], count) for v in known.single]
        first = np.flatnonzero(ids != 1)  # a pair starts at each word but the END
        both = single[first] & single[first + 1]
        at = first[both]
        pairs = _counted(_pair_codes(number[at], number[at + 1]), doc[at], count)
        head, head_values = known.head
        if len(head):
            place = np.minimum(np.searchsorted(head, pairs[0]), len(head) - 1)
            hit = head[place] == pairs[0]
            for a, v in zip(added, head_values, strict=True):
                a += np.bincount(pairs[1][hit], v[place[hit]] * pairs[2][hit].astype(float), count)
            pairs = [x[~hit] for x in pairs]
        at = first[~both]
        grams = np.concatenate([words.keys[ids[~single]], pair_key(words.keys[ids[at]], words.keys[ids[at + 1]])])
        others = _counted(grams.view(np.uint64), np.concatenate([doc[~single], doc[at]]), count)
        key = part.column("key").to_numpy()
        # the same when a lost task runs again
        block = xxhash.xxh3_64_intdigest(key.tobytes()) - (1 << 63)
        sums = [
            (key, "<i8"),
            (np.array([len(d) - 1 for d in words.docs]), "<i8"),
            (np.bincount(doc, words.chars[ids], count), "<f8"),
            (np.bincount(doc, words.base[ids], count), "<f8"),
            *[(a, "<f8") for a in added],
        ]
        yield _packed_rows([(block % (1 << bits), SUMS, block, _pack(*sums))])
        of_pairs = dict(_by_shard(_code_shards(pairs[0], bits)))
        of_others = dict(_by_shard(_gram_shards(others[0], bits)))
        for shard in of_pairs.keys() | of_others.keys():
            own = _pack_grams(pairs, of_pairs[shard]) if shard in of_pairs else nothing
            rest = _pack_grams(others, of_others[shard]) if shard in of_others else nothing
            yield _packed_rows([(shard, GRAMS, block, len(own).to_bytes(8, "little") + own + rest)])

    return run


def _pack_values(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g = batch.column("gram").to_numpy().view(np.uint64)
            order = np.argsort(g)
            columns = [g[order], *(batch.column(m).to_numpy()[order] for m in MODELS)]
            for shard, at in _by_shard(_gram_shards(columns[0], bits)):
                steps = _steps(columns[0][at])
                packed = _pack(*zip((steps, *(c[at] for c in columns[1:])), VALUE_COLUMNS, strict=True))
                yield _packed_rows([(shard, VALUES, 0, packed)])

    return run


def _hits(packed: bytes, grams: np.ndarray, values: list[np.ndarray]) -> list[np.ndarray]:
    """Of n-grams that are known: text, and per model what the n-gram adds to it."""
    steps, owner, n = _columns(packed, *GRAM_COLUMNS)
    if not len(grams):
        return [owner[:0], *(v[:0].astype(float) for v in values)]
    asked = np.cumsum(steps, dtype=np.uint64)
    at = np.minimum(np.searchsorted(grams, asked), len(grams) - 1)
    hit = np.flatnonzero(grams[at] == asked)
    return [owner[hit], *(v[at[hit]] * n[hit].astype(float) for v in values)]


def _found_values(sent):
    """What each block's n-grams add to its sums. Rows come by shard, values and pairs first;
    what a shard holds of them is held, and one row of n-grams."""

    def sorted_(parts: list[list[np.ndarray]]) -> tuple[np.ndarray, list[np.ndarray]]:
        if not parts:
            return np.zeros(0, np.uint64), [np.zeros(0, np.float32) for _ in MODELS]
        grams, *values = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.argsort(grams)
        return grams[order], [v[order] for v in values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, known, rows, pairs = None, None, [], []
        for row in _rows(batches):
            if row["shard"] != shard:
                shard, known, rows, pairs = row["shard"], None, [], []
            if row["kind"] == VALUES:
                steps, *values = _columns(row["packed"], *VALUE_COLUMNS)
                rows.append([np.cumsum(steps, dtype=np.uint64), *values])
                continue
            if row["kind"] == PAIRS:
                codes, *n = _unpack_pairs(PAIRS, row["packed"])
                pairs.append([codes, *sent.value.words.values(codes, _models(*n))])
                continue
            if row["kind"] == SUMS:
                yield _packed_rows([(0, SUMS, row["block"], row["packed"])])
                continue
            if known is None:
                known, rows, pairs = (sorted_(pairs), sorted_(rows)), [], []
            cut = 8 + int.from_bytes(row["packed"][:8], "little")
            own = (_hits(x, *k) for x, k in zip((row["packed"][8:cut], row["packed"][cut:]), known, strict=True))
            owner, *added = (np.concatenate(c) for c in zip(*own, strict=True))
            if len(owner):
                texts, owner = np.unique(owner, return_inverse=True)
                sums = (np.bincount(owner, a) for a in added)
                packed = _pack(*zip((texts, *sums), ADDED_COLUMNS, strict=True))
                yield _packed_rows([(0, ADDED, row["block"], packed)])

    return run


def _whole_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, n, chars, base, one sum a model) per text. Rows come by block, its sums first."""

    def texts() -> pa.RecordBatch:
        # equal blocks share their number and what was found, as they share their texts
        sums = [own[0], own[1], own[2], own[3], *((s + a / copies) for s, a in zip(own[4:], added, strict=True))]
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in sums], names=["key", "n", "chars", "base", *MODELS]
        )

    block, own, added, copies = None, None, [], 0
    for batch in batches:
        for row in batch.to_pylist():
            if row["block"] != block:
                if own is not None:
                    yield texts()
                block, own, copies = row["block"], None, 0
            if row["kind"] == SUMS:
                own = _columns(row["packed"], *SUM_COLUMNS)
                added = [np.zeros(len(own[0])) for _ in MODELS]
                copies += 1
                continue
            if own is None:
                raise RuntimeError("the texts came in another order when they were read again")
            at, *found = _columns(row["packed"], *ADDED_COLUMNS)
            for a, f in zip(added, found, strict=True):
                a[at] += f
    if own is not None:
        yield texts()


def text_losses(
    texts: DataFrame,
    values: Values,
    rest: list[float],
    spelling: Model,
    head: int = HEAD,
    block: int = BLOCK,
    shelf: Shelf | None = None,
) -> DataFrame:
    """(key, whole, half1, half0): nats a character of each different text in each model.

    ``texts`` has key and text; rows of one key have one text, and count once.
    A text without words has no row.

    The n-grams of a block of texts travel in one row for each shard, sorted, as
    differences; a shard's values meet them in a task that holds these values and one such
    row at a time. What a turn finds is stored before the next one begins.
    """
    bits, shelf = values.bits, shelf or Shelf(texts.sparkSession)
    known = _Known(spelling, values.often, values.words, values.off, _head(values, head))
    sent = texts.sparkSession.sparkContext.broadcast(known)
    names = ["n", "chars", "base", *MODELS]
    ddl = "key bigint, n bigint, " + ", ".join(f"{c} double" for c in names[1:])
    turns = []
    for turn in range(TURNS):
        # copies of a text come in one turn
        part = texts.where(F.pmod(F.xxhash64("key"), F.lit(TURNS)) == turn)
        rows = values.rows.select("gram", *MODELS).mapInArrow(_pack_values(bits), PACKED)
        rows = rows.unionByName(values.pairs).unionByName(part.mapInArrow(_pack_texts(sent, bits, block), PACKED))
        met = rows.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(_found_values(sent), PACKED)
        sums = met.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(_whole_sums, ddl)
        # copies of a text have equal sums
        sums = sums.groupBy("key").agg(*[F.max(c).alias(c) for c in names])
        turns.append(shelf.put(sums, f"sums{turn}"))
    sent.destroy()
    sums = reduce(DataFrame.unionByName, turns)
    return sums.where("n > 1").select(
        "key",
        *[
            (-(F.col("base") + F.col(m) + F.col("n") * F.lit(r)) / F.col("chars")).alias(m)
            for m, r in zip(MODELS, rest, strict=True)
        ],
    )


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_id of documents whose labels all say good and not toxic."""
    return (
        labels.where("quality is not null")
        .groupBy(F.col("doc_id").cast("bigint").alias("__trusted"))
        .agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
        .where("q = 1 and t = 0")
        .select("__trusted")
    )


def thresholds(losses: DataFrame, quantile: float) -> DataFrame:
    """(lang, __most): per language the quantile of the trusted losses; lang null with
    ``__all`` true: of all of them, for languages without trusted text.

    Losses are counted in bins of 1 / BINS nat, so no group is sorted and the result
    does not depend on any order.
    """
    bins = (
        losses.where("__loss is not null")
        .groupBy("lang", F.floor(F.col("__loss") * BINS).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    whole = bins.groupBy("bin").agg(F.sum("n").alias("n"))
    each = bins.select(F.lit(False).alias("__all"), "lang", "bin", "n").unionByName(
        whole.select(F.lit(True).alias("__all"), F.lit(None).cast("string").alias("lang"), "bin", "n")
    )
    return losses.sparkSession.sql(
        f"""select __all, lang as __lang, (min(bin) + 1) / {BINS}D as __most, max(total) as __n
            from (select *, sum(n) over (partition by __all, lang order by bin) as upto,
                         sum(n) over (partition by __all, lang) as total from {{each}})
            where upto >= {quantile}D * total group by __all, lang""",
        each=each,
    )


def judge(
    docs: DataFrame,
    labels: DataFrame,
    quantile: float = 0.995,
    alphabet: int | None = None,
    order: int = ORDER,
    head: int = HEAD,
) -> DataFrame:
    """Every document with ``perplexity`` (a character), ``threshold`` and ``kept``.

    ``docs`` has doc_id, text and lang, all columns come back; ``labels`` has doc_id,
    quality and toxic. Trusted text: documents all of whose labels say quality 1 and
    not toxic. The model is trained on all of it (``alphabet`` and ``order`` are those
    of the spelling model: bytes, or the characters of an alphabet of that size). A document is
    kept when its perplexity is at most the ``quantile`` of the trusted documents of
    its language. A trusted text is measured by the counts of the half that it is not
    in, since a text looks better to a model that has read it, and any other text by
    both halves (the mean of their losses), so that all are judged by models of one size.
    A language without trusted documents takes the quantile over all languages, and
    one with too few to have the quantile (under 1 / (1 - quantile)) the greater of
    both; without any trusted document all are kept.

    Empty, blank and null texts have no perplexity and are kept. Null is a language
    like any other. Repeated rows count each time; rows with a null doc_id are never
    trusted. New columns replace columns of the same name.

    Keys of texts, words and pairs are hashes of 64 bits. The n-grams of all documents
    are shuffled to their values, but for the most frequent words and the ``head`` most
    frequent pairs; how large ``head`` is does not change the result.
    """
    names = [c for c in docs.columns if c not in ("perplexity", "threshold", "kept")]
    docs = docs.select(*names)
    key = F.xxhash64(whole_text())
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("__trusted"), "lang", whole_text().alias("text")
    )
    # copies of a text fall in one half
    half = F.pmod(F.xxhash64("text"), F.lit(2)).alias("half")
    shelf = Shelf(docs.sparkSession)
    trusted = shelf.put(
        texts.join(trusted_ids(labels), "__trusted", "left_semi").select(
            "lang", half, F.xxhash64("text").alias("key"), "text"
        ),
        "trusted",
    )
    keys = shelf.put(trusted.select("lang", "half", "key"), "trusted_keys")
    spelling = train(trusted.select(spelled().alias("text")), alphabet, order, shelf)
    shelf.drop("ngrams")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    values, rest = word_values(trusted.select("half", "text"), spelling, shelf, size=size)
    trusted = keys
    losses = shelf.put(
        text_losses(
            docs.select(key.alias("key"), whole_text().alias("text")), values, rest, spelling, head, shelf=shelf
        ),
        "losses",
    )
    shelf.drop("singles", "doubles", "pairs", *[f"sums{turn}" for turn in range(TURNS)])
    unseen = F.when(F.col("half") == 0, F.col("half1")).when(F.col("half") == 1, F.col("half0"))
    held_out = trusted.select("lang", "half", "key").join(losses, "key").select("lang", unseen.alias("__loss"))
    limits = shelf.put(thresholds(held_out, quantile), "thresholds")
    own = limits.where("not __all").select("__lang", "__most", "__n")
    overall = limits.where("__all").agg(F.max("__most").alias("__overall")).first()[0]
    pooled = F.lit(overall).cast("double")
    few = F.col("__n") * (1 - quantile) < 1
    most = F.when(few, F.greatest("__most", pooled)).otherwise(F.coalesce("__most", pooled))
    read = trusted.select("key", "half").distinct()
    fair = F.coalesce(unseen, (F.col("half0") + F.col("half1")) / 2)
    scores = losses.join(read, "key", "left").select(F.col("key").alias("__key"), fair.alias("__loss"))
    rows = docs.withColumn("__key", key).join(scores, "__key", "left")
    return rows.join(own, F.col("lang").eqNullSafe(F.col("__lang")), "left").select(
        *names,
        F.exp("__loss").alias("perplexity"),
        F.exp(most).alias("threshold"),
        F.coalesce(F.col("__loss") <= most, F.lit(True)).alias("kept"),
    )


def good_documents(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The pipeline's form: the documents that are kept, with their columns."""
    return judge(docs, labels, **settings).where("kept").select(*docs.columns)
