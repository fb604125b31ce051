"""Benchmark decontamination: pigeonhole pieces and bit-parallel edit distance.

An item of L characters may occur in a document with up to k edits. Cut into k + 1
pieces, at least one of them is untouched, so every such occurrence shows as an exact
hit of a piece. All pieces go into one automaton that scans each whole text once; the
stretch around a hit is then searched with Myers' bit-parallel algorithm.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlake.llm.common import text_blocks, whole_text

# Raw bytes of items that one automaton holds; more items make more passes.
BLOCK_BYTES = 8 << 20
HITS = "doc_id bigint, item_id bigint, edits int, start_at bigint, end_at bigint"


def plain(text: str) -> str:
    """Lower case, white space as blanks; positions stay as they are."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(x if len(x := c.lower()) == 1 else c for c in text)
    for c in "\n\t\r\f\v ":
        low = low.replace(c, " ")
    return low


def budget(length: int, rate: float, shortest_piece: int) -> int:
    """Edits allowed: a share of the length, with no piece under the shortest."""
    return max(0, min(int(length * rate), length // shortest_piece - 1))


def cut(length: int, pieces: int) -> list[tuple[int, int]]:
    """Borders of ``pieces`` pieces of nearly equal length."""
    ends = [length * i // pieces for i in range(pieces + 1)]
    return list(zip(ends, ends[1:], strict=False))


def _masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def best_end(masks: dict[str, int], length: int, text: str, anchored: bool = False) -> tuple[int, int]:
    """(edits, end) of the pattern's best occurrence in ``text``; of equals the first.

    ``anchored``: the occurrence starts where the text does.
    """
    full, top = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score = full, 0, length
    best, at = length, 0
    for j, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | (~(xh | plus) & full)
        mh = plus & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ((ph << 1) | anchored) & full
        mh = (mh << 1) & full
        plus = mh | (~(xv | ph) & full)
        minus = ph & xv
        if score < best:
            best, at = score, j
    return best, at


def occurrence(pattern: str, masks, reverse, text: str, most: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best occurrence within ``most`` edits."""
    at = text.find(pattern)
    if at >= 0:
        return 0, at, at + len(pattern)
    edits, end = best_end(masks, len(pattern), text)
    if edits > most:
        return None
    back = text[max(0, end - len(pattern) - edits) : end][::-1]
    _, length = best_end(reverse, len(pattern), back, True)
    return edits, end - length, end


class Items:
    """The automaton of a block of items."""

    def __init__(self, items: list[tuple[int, str]], rate: float, shortest_piece: int):
        texts: dict[str, list[int]] = {}
        for item_id, text in items:
            p = plain(text or "").strip()
            if p:
                texts.setdefault(p, []).append(item_id)
        self.texts = list(texts)
        self.ids = [sorted(set(texts[t])) for t in self.texts]
        self.most = [budget(len(t), rate, shortest_piece) for t in self.texts]
        self.masks = [(_masks(t), _masks(t[::-1])) for t in self.texts]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for k, t in enumerate(self.texts):
            for a, b in cut(len(t), self.most[k] + 1):
                pieces.setdefault(t[a:b], []).append((k, a))
        self.automaton = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.automaton.add_word(piece, (len(piece), places))
        if pieces:
            self.automaton.make_automaton()

    def stretches(self, text: str) -> dict[int, list[list[int]]]:
        """Per item the merged stretches in which it may occur."""
        places: dict[int, list[int]] = {}
        for end, (length, owners) in self.automaton.iter(text):
            for k, offset in owners:
                places.setdefault(k, []).append(end + 1 - length - offset)
        out = {}
        for k, starts in places.items():
            most, length = self.most[k], len(self.texts[k])
            merged: list[list[int]] = []
            for s in sorted(set(starts)):
                a, b = max(0, s - most), s + length + most
                if merged and a <= merged[-1][1] - length:
                    merged[-1][1] = b
                else:
                    merged.append([a, b])
            out[k] = merged
        return out

    def search(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, edits, start, end) for each stretch with an occurrence."""
        if not self.texts or not text:
            return []
        p = plain(text)
        out = set()
        for k, stretches in self.stretches(p).items():
            for a, b in stretches:
                hit = occurrence(self.texts[k], *self.masks[k], p[a:b], self.most[k])
                if hit:
                    out.update((i, hit[0], a + hit[1], a + hit[2]) for i in self.ids[k])
        return sorted(out)


def item_blocks(
    benchmark: DataFrame, rate: float, shortest_piece: int, block_bytes: int = BLOCK_BYTES
) -> Iterator[Callable[[], Items]]:
    """The items in blocks of about ``block_bytes``; each gives a cached automaton.

    Only one block is at the driver and in a broadcast at a time, so their size does
    not grow with the benchmark; its number of blocks does.
    """
    spark = benchmark.sparkSession
    items = benchmark.select(
        F.col("item_id").cast("bigint").alias("item_id"), whole_text().alias("text")
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(total // block_bytes) + 1
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        sent = spark.sparkContext.broadcast(
            (rate, shortest_piece, sorted(((r.item_id, r.text) for r in part.collect()), key=_sort_key))
        )
        yield _cached(sent)


_BUILT: dict[int, Items] = {}


def _cached(sent) -> Callable[[], Items]:
    def get() -> Items:
        key = sent.id if hasattr(sent, "id") else id(sent)
        if key not in _BUILT:
            _BUILT.clear()
            rate, shortest_piece, items = sent.value
            _BUILT[key] = Items(items, rate, shortest_piece)
        return _BUILT[key]

    return get


def _sort_key(item):
    return (item[0] is None, item[0] or 0, item[1])


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, rate: float = 0.06, shortest_piece: int = 16
) -> DataFrame:
    """doc_id, item_id, edits, start_at, end_at of benchmark items in documents.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other columns are
    ignored. An item counts where it occurs within ``rate`` of its length in edits
    (at most one per ``shortest_piece`` characters; shorter items exactly), letter
    case and kind of white space aside. All occurrences within the budget are
    found; of those that overlap closely the best is reported. Positions are code
    points of the text.

    Null or empty texts have no hits, null or blank items none either. Items that
    share a text are reported each, repeated documents likewise. No shuffle: the
    items, in blocks of bounded size, meet every whole text where it is read.
    """
    out = None
    for get in item_blocks(benchmark, rate, shortest_piece):
        found = docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text")
        ).mapInArrow(_hits(get), HITS)
        out = found if out is None else out.unionByName(found)
    return out


def _hits(get: Callable[[], Items]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = get()
        for part, texts in text_blocks(batches):
            rows = [
                (doc, *hit)
                for doc, text in zip(part.column("doc_id").to_pylist(), texts, strict=True)
                for hit in items.search(text)
            ]
            if rows:
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)],
                    names=[c.split()[0] for c in HITS.split(", ")],
                )

    return run


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, rate: float = 0.06, shortest_piece: int = 16
) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns.

    Same rules as ``find_leaks``; rows are judged where they are read, so null or
    repeated doc_ids do not matter and nothing is shuffled.
    """
    schema = docs.schema
    for get in item_blocks(benchmark, rate, shortest_piece):
        docs = docs.mapInArrow(_without(get), schema)
    return docs


def _without(get: Callable[[], Items]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = get()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            keep = pa.array([not items.search(t or "") for t in texts], pa.bool_())
            yield batch.filter(keep)

    return run
