"""Exact removal of long repeats with run-length compressed BWT indexes.

A byte goes when it lies in a string of LONG bytes that starts anywhere else too.

1. Each start position has an anchor: of the strings of GRAM bytes inside its string
   of LONG bytes, the one with the least hash. Equal strings have equal anchors, so
   only positions whose anchor recurs can repeat. The positions that share an anchor
   place make a window; windows are counted by hashes.
2. Windows that recur as a whole need no more: all their positions repeat. They and
   all windows of anchors with a single form of window never leave their document.
3. Of the other anchors, one copy of each different window goes to the task of its
   anchor, where an index of a bounded number of bytes is built: the Burrows-Wheeler
   transform in runs with the suffix array sampled at run ends. The length of the
   longest match elsewhere (matching statistics) is worked out for the samples alone
   and streamed over the text: inside a run it falls by one per position.
4. An anchor with too many different windows for one index is resolved by counting the
   strings themselves (hashes of 128 bits), which any number of tasks share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlake.llm.common import stored, whole_text

LONG = 400
GRAM = 200
SPAN = LONG - GRAM + 1  # anchors that a start position can have
# Bytes handled at once in a task, and bytes of one index.
PIECE = 1 << 20
INDEX_BYTES = 1 << 20
# Windows of one anchor in one index (each has up to LONG + SPAN - 1 bytes).
MOST_WINDOWS = 1500
PACK = 1 << 10  # window lengths are below
RESULT = (
    "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, text string"
)

_rng = np.random.default_rng(977)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_M = 0x9E3779B97F4A7C15
_BYTE2 = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_M2 = 0xD1342543DE82EF95


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_SIZE = PIECE + LONG + 8
_UP, _DOWN = _powers(_M, _SIZE), _powers(pow(_M, -1, 1 << 64), _SIZE)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class Hashes:
    """Hashes of all substrings of some bytes, from sums of the prefixes."""

    def __init__(self, data: np.ndarray, table=_BYTE, up=_UP, down=_DOWN):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * up[: len(data)], out=self.sums[1:])
        self.down = down

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return _mixed((self.sums[start + length] - self.sums[start]) * self.down[start])


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by prefix and suffix minima of blocks."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(x)] = x
    grid = padded.reshape(blocks, width)
    prefix = np.minimum.accumulate(grid, axis=1).reshape(-1)
    suffix = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(suffix[:n], prefix[width - 1 : width - 1 + n])


def windows(data: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor hash, window hash, first position, positions) of each window.

    ``valid`` marks the positions whose LONG bytes lie inside one text.
    """
    if len(data) < LONG or not valid.any():
        return (np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))
    h = Hashes(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = h.of(at, GRAM)
    low = np.uint64((1 << 24) - 1)
    least = _sliding_least((grams & ~low) | at.astype(np.uint64), SPAN)
    anchor = (least & low).astype(np.int64)[: len(valid)]
    ok = np.flatnonzero(valid)
    new = np.r_[True, (anchor[ok[1:]] != anchor[ok[:-1]]) | (ok[1:] != ok[:-1] + 1)]
    first = ok[new]
    count = np.diff(np.r_[np.flatnonzero(new), len(ok)])
    place = anchor[first]
    # where the anchor lies and how many positions it has are part of the window
    form = (count * PACK + (place - first)).astype(np.uint64)
    whole = _mixed(h.of(first, count + LONG - 1) + form * np.uint64(_M))
    return grams[place], whole, first, count


def _pieces(batches: Iterator[pa.RecordBatch]):
    """(rows, offset of each row's bytes in its text, bytes, first byte of each row)
    of about PIECE bytes; longer texts come in pieces that overlap by LONG - 1."""
    for batch in batches:
        rows, offsets, parts, size = [], [], [], 0
        for i, text in enumerate(batch.column("text").to_pylist()):
            raw = text.encode("utf-8", "surrogatepass")
            for k in range(0, max(1, len(raw) - LONG + 1), PIECE):
                part = raw[k : k + PIECE + LONG - 1]
                if size and size + len(part) > PIECE:
                    yield batch, rows, offsets, parts
                    rows, offsets, parts, size = [], [], [], 0
                rows.append(i)
                offsets.append(k)
                parts.append(part)
                size += len(part)
        if rows:
            yield batch, rows, offsets, parts


def _emit(with_places: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows, offsets, parts in _pieces(batches):
            data = np.frombuffer(b"".join(parts), np.uint8)
            sizes = np.array([len(p) for p in parts])
            begin = np.cumsum(sizes) - sizes
            valid = np.zeros(max(0, len(data) - LONG + 1), bool)
            for b, n in zip(begin.tolist(), sizes.tolist(), strict=True):
                if n >= LONG:
                    valid[b : b + n - LONG + 1] = True
            anchor, window, first, count = windows(data, valid)
            if not len(anchor):
                continue
            anchor, window = anchor.view(np.int64), window.view(np.int64)
            if not with_places:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(window)], names=["anchor", "window"]
                )
                continue
            part = np.searchsorted(begin, first, "right") - 1
            # parts may be empty: the last that begins there holds the bytes
            start = first - begin[part] + np.array(offsets)[part]
            row = pa.array(np.array(rows)[part])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor),
                    pa.array(window),
                    batch.column("key").take(row),
                    batch.column("text_hash").take(row),
                    pa.array(start * PACK + count),
                ],
                names=["anchor", "window", "key", "text_hash", "place"],
            )

    return run


PLACES = "anchor bigint, window bigint, key bigint, text_hash bigint, place bigint"


def _cut_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted windows of each text."""
    for batch in batches:
        out: dict[str, list] = {c: [] for c in ("anchor", "many", "key", "text_hash", "place", "bytes")}
        size = 0
        for key, text_hash, text, wanted in zip(
            *[batch.column(c).to_pylist() for c in ("key", "text_hash", "text", "wanted")], strict=True
        ):
            raw = text.encode("utf-8", "surrogatepass")
            for w in wanted:
                start, count = divmod(w["place"], PACK)
                out["anchor"].append(w["anchor"])
                out["many"].append(w["many"])
                out["key"].append(key)
                out["text_hash"].append(text_hash)
                out["place"].append(w["place"])
                out["bytes"].append(raw[start : start + count + LONG - 1])
                size += count + LONG
            if size > 8 << 20:
                yield _window_batch(out)
                out, size = {c: [] for c in out}, 0
        yield _window_batch(out)


def _window_batch(out: dict[str, list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out)
    )


# --- the index -------------------------------------------------------------------


class RunLengthIndex:
    """The run-length BWT of some strings, with the suffix array at the run ends.

    Each string is closed by a symbol of its own, so no match crosses strings.
    """

    def __init__(self, strings: list[bytes]):
        sizes = np.array([len(s) for s in strings])
        self.begin = np.cumsum(sizes + 1) - (sizes + 1)
        n = int(sizes.sum()) + len(strings)
        text = np.zeros(n, np.uint64)
        keep = np.ones(n, bool)
        keep[self.begin + sizes] = False
        text[keep] = np.frombuffer(b"".join(strings), np.uint8)
        text[~keep] = 256 + np.arange(len(strings), dtype=np.uint64)
        wide = np.concatenate([text, np.zeros(3, np.uint64)])
        self.four = (wide[:-3] << np.uint64(48)) | (wide[1:-2] << np.uint64(32)) | (
            wide[2:-1] << np.uint64(16)
        ) | wide[3:]
        order = self._suffix_array(n, int(sizes.max(initial=0)) + 1)
        before = text[order - 1]
        # rows of the transform that start a run; the row above each ends one
        head = np.flatnonzero(before[1:] != before[:-1]) + 1
        self.runs = len(head) + 1
        self.text = text
        match = self._common(order[head - 1], order[head])
        self.starts = self._samples(order[head], match, order[:1])
        self.ends = self._samples(order[head - 1], match, order[-1:])

    def _suffix_array(self, n: int, longest: int) -> np.ndarray:
        order = np.argsort(self.four, kind="stable")
        sorted_ = self.four[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[0, sorted_[1:] != sorted_[:-1]])
        depth = 4
        while depth < longest and rank[order[-1]] + 1 < n:
            key = rank * (n + 1)
            key[: n - depth] += rank[depth:] + 1
            order = np.argsort(key, kind="stable")
            sorted_ = key[order]
            rank[order] = np.cumsum(np.r_[0, sorted_[1:] != sorted_[:-1]])
            depth *= 2
        return order

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at a and b."""
        out = np.zeros(len(a), np.int64)
        open_ = np.arange(len(a))
        x, y = a.copy(), b.copy()
        last = len(self.four) - 1
        while len(open_):
            same = (np.maximum(x, y) <= last) & (
                self.four[np.minimum(x, last)] == self.four[np.minimum(y, last)]
            )
            done = ~same
            for k in range(3):  # the rest of under four symbols
                u, v = x[done] + k, y[done] + k
                inside = np.maximum(u, v) <= last
                eq = inside & (self.text[np.minimum(u, last)] == self.text[np.minimum(v, last)])
                still = open_[done]
                hit = eq & (out[still] % 4 == k)
                out[still[hit]] += 1
            open_, x, y = open_[same], x[same] + 4, y[same] + 4
            out[open_] += 4
        return out

    @staticmethod
    def _samples(place: np.ndarray, match: np.ndarray, border: np.ndarray):
        # the first (last) suffix has no neighbour above (below)
        place, match = np.r_[place, border], np.r_[match, np.zeros(len(border), np.int64)]
        order = np.argsort(place)
        return place[order], match[order]

    def matching_statistics(self) -> np.ndarray:
        """For each position the length of the longest match that starts elsewhere."""
        at = np.arange(len(self.text))
        best = np.zeros(len(at), np.int64)
        for place, match in (self.starts, self.ends):
            until = np.diff(np.r_[place, len(at)])
            streamed = np.repeat(place + match, until) - at[place[0] :]
            best[place[0] :] = np.maximum(best[place[0] :], streamed)
        return best


def _spans_of(strings: list[bytes], counts: list[int]) -> list[list[tuple[int, int]]]:
    """Per window the runs (first, end) of positions that repeat."""
    index = RunLengthIndex(strings)
    long = index.matching_statistics() >= LONG
    out = []
    for begin, count in zip(index.begin.tolist(), counts, strict=True):
        mark = np.diff(np.r_[0, long[begin : begin + count].astype(np.int8), 0])
        out.append(
            list(zip(np.flatnonzero(mark == 1).tolist(), np.flatnonzero(mark == -1).tolist(), strict=True))
        )
    return out


MARKS = "key bigint, text_hash bigint, first bigint, end bigint"


def _marks_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in range(4)]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), pa.int64()) for c in columns], names=["key", "text_hash", "first", "end"]
    )


def _index_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks from windows sorted by anchor; an index holds whole anchors."""
    held: list[tuple] = []
    fresh: list[tuple] = []  # of the newest anchor
    size = new = 0

    def resolve(rows: list[tuple]) -> pa.RecordBatch:
        out = []
        if len(rows) > 1:
            places = [divmod(r[3], PACK) for r in rows]
            spans = _spans_of([r[4] for r in rows], [p[1] for p in places])
            for r, (start, _), own in zip(rows, places, spans, strict=True):
                out += [(r[1], r[2], start + a, start + b) for a, b in own]
        return _marks_batch(out)

    for batch in batches:
        for row in zip(
            *[batch.column(c).to_pylist() for c in ("anchor", "key", "text_hash", "place", "bytes")], strict=True
        ):
            if fresh and row[0] != fresh[-1][0]:
                if held and size + new > INDEX_BYTES:
                    yield resolve(held)
                    held, size = [], 0
                held += fresh
                size += new
                fresh, new = [], 0
            fresh.append(row)
            new += len(row[4])
    if held and size + new > INDEX_BYTES:
        yield resolve(held)
        held = []
    yield resolve(held + fresh)


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two hashes of each string of LONG bytes in a window, and its place."""
    names = ["h1", "h2", "key", "text_hash", "at"]
    up, down = _powers(_M2, _SIZE), _powers(pow(_M2, -1, 1 << 64), _SIZE)
    for batch in batches:
        for i in range(batch.num_rows):
            raw = np.frombuffer(batch.column("bytes")[i].as_py(), np.uint8)
            start, count = divmod(batch.column("place")[i].as_py(), PACK)
            at = np.arange(count)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(Hashes(raw).of(at, LONG).view(np.int64)),
                    pa.array(Hashes(raw, _BYTE2, up, down).of(at, LONG).view(np.int64)),
                    batch.column("key").take(pa.array(np.full(count, i))),
                    batch.column("text_hash").take(pa.array(np.full(count, i))),
                    pa.array(at + start),
                ],
                names=names,
            )


# --- removal -----------------------------------------------------------------------


def removed_runs(marks: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of removed bytes from runs of repeating start positions."""
    out: list[list[int]] = []
    for a, b in sorted((m["first"], m["end"] + LONG - 1) for m in marks or []):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _remove(digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in text_blocks(batch):
                yield removed(piece, texts)

    def text_blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
        # rows of about two million characters at a time
        texts, start, size = [], 0, 0
        for i, value in enumerate(batch.column("text")):
            texts.append(value.as_py())
            size += len(texts[-1])
            if size >= 2_000_000 or i + 1 == batch.num_rows:
                yield batch.slice(start, len(texts)), texts
                texts, start, size = [], i + 1, 0

    def removed(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        rows = []
        for doc_id, text, marks in zip(
            batch.column("doc_id").to_pylist(), texts, batch.column("marks").to_pylist(), strict=True
        ):
            raw = text.encode("utf-8", "surrogatepass")
            runs = removed_runs(marks)
            kept, at = [], 0
            for a, b in runs:
                kept.append(raw[at:a])
                at = b
            kept.append(raw[at:])
            left = b"".join(kept)
            if digests:
                last = hashlib.sha256(left).hexdigest()
                rows.append(
                    (doc_id, len(raw), len(raw) - len(left), len(runs), last, left.decode("utf-8", "replace"))
                )
            else:
                rows.append((doc_id, [{"first": a, "end": b} for a, b in runs], left))
        types = (
            [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            if digests
            else [
                pa.int64(),
                pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])),
                pa.binary(),
            ]
        )
        names = [c.split()[0] for c in (RESULT if digests else "doc_id r, spans s, kept b").split(", ")]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(zip(*rows), types, strict=True)], names=names
        )

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id").cast("bigint")
    text = whole_text()
    # equal keys hold equal texts, and equal texts lose equal bytes
    return docs.select(
        doc_id.alias("doc_id"),
        F.coalesce(doc_id, F.lit(0)).alias("key"),
        F.xxhash64(text).alias("text_hash"),
        text.alias("text"),
    )


def repeat_marks(docs: DataFrame) -> DataFrame:
    """(key, text_hash, first, end): runs of start positions that repeat."""
    plain = docs.select("key", "text_hash", "text")
    seen = plain.select("text").mapInArrow(_emit(False), "anchor bigint, window bigint")
    anchors = (
        seen.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"), F.min("window").alias("w0"), F.max("window").alias("w1"))
        .where("n > 1")
        .select("anchor", (F.col("w0") != F.col("w1")).alias("mixed"))
    )
    found = stored(
        plain.mapInArrow(_emit(True), PLACES).join(anchors, "anchor"), "recurring-windows"
    )
    span = (
        F.expr(f"place div {PACK}").alias("first"),
        F.expr(f"place div {PACK} + place % {PACK}").alias("end"),
    )
    plain_marks = found.where("not mixed").select("key", "text_hash", *span)
    mixed = found.where("mixed")
    forms = stored(
        mixed.groupBy("anchor", "window").agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.struct("key", "text_hash", "place")).alias("copy"),
        ),
        "windows",
    )
    whole = mixed.join(forms.where("n > 1").select("anchor", "window"), ["anchor", "window"])
    whole_marks = whole.select("key", "text_hash", *span)
    groups = forms.groupBy("anchor").agg(F.count(F.lit(1)).alias("forms"))
    wanted = (
        forms.join(groups, "anchor")
        .select(
            "copy.key",
            "copy.text_hash",
            F.struct("anchor", (F.col("forms") > MOST_WINDOWS).alias("many"), "copy.place").alias("w"),
        )
        .groupBy("key", "text_hash")
        .agg(F.collect_list("w").alias("wanted"))
    )
    cut = stored(
        docs.join(wanted, ["key", "text_hash"])
        .select("key", "text_hash", "text", "wanted")
        .mapInArrow(
            _cut_windows,
            "anchor bigint, many boolean, key bigint, text_hash bigint, place bigint, bytes binary",
        ),
        "window-bytes",
    )
    indexed = (
        cut.where("not many")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_index_marks, MARKS)
    )
    strings = cut.where("many").mapInArrow(
        _strings, "h1 bigint, h2 bigint, key bigint, text_hash bigint, at bigint"
    )
    again = strings.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counted = strings.join(again.select("h1", "h2"), ["h1", "h2"]).select(
        "key", "text_hash", F.col("at").alias("first"), (F.col("at") + 1).alias("end")
    )
    return plain_marks.unionByName(whole_marks).unionByName(indexed).unionByName(counted)


def remove_repeats(docs: DataFrame, digests: bool = False, kept_text: bool = False) -> DataFrame:
    """Remove every byte covered by a string of 400 bytes that also starts elsewhere.

    ``docs`` has doc_id and text (UTF-8 bytes count); other columns are ignored.
    Returns doc_id, spans (maximal removed runs of bytes) and kept (the other bytes,
    concatenated), or with ``digests`` n_bytes, n_removed, n_spans and kept_sha256, and
    with ``kept_text`` also text: the other bytes as text, where a character that lost
    some of its bytes is U+FFFD.
    All copies go, in the same document or another; strings are judged on the input.

    Null and empty texts, and texts under 400 bytes, lose nothing. Rows are documents
    of their own, also where they repeat: a text that occurs twice with at least
    400 bytes goes altogether. Null doc_ids stay null.

    Anchors are combined on the map side; the rows of windows are 40 bytes for about
    100 bytes of text. Copies of a text meet as counts, and one copy of each different
    window around an edit goes to an index of bounded size.
    """
    docs = _keyed(docs)
    marks = (
        repeat_marks(docs)
        .groupBy("key", "text_hash")
        .agg(F.collect_set(F.struct("first", "end")).alias("marks"))
    )
    joined = docs.join(marks, ["key", "text_hash"], "left").select("doc_id", "text", "marks")
    schema = RESULT if digests else (
        "doc_id bigint, spans array<struct<first:bigint,end:bigint>>, kept binary"
    )
    removed = joined.mapInArrow(_remove(digests), schema)
    return removed.drop("text") if digests and not kept_text else removed
