"""MinHash near-duplicates by a multi-index Hamming join, confirmed on full sets.

A document is the set of its word shingles; equal sets are one node. A node's
signature has HASHES values of 16 bits. Two signatures that differ in at most 31 of 64
values agree, but for one value, in one of 16 chunks of four (pigeonhole), so each
node is put under 64 keys: every chunk with every one of its values left open. Nodes
under one key are candidates, and all pairs within the distance share a key.

Candidates are not multiplied out. Each node is first compared with the least node
under its key, which joins groups of copies in one step; only where a key still holds
nodes of different components are the pairs across components compared, in blocks of
bounded size. Every link is confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlake.llm.common import stored, text_blocks, whole_text
from transitlake.llm.components import components

WORDS = 5
HASHES = 64
CHUNK = 4
# At the similarity limit a value differs with probability 1/4: 16 of 64 on average,
# more than MOST_APART in one pair of 100,000.
MOST_APART = 2 * (HASHES // CHUNK) - 1
# Nodes of one block under a key, and how many hashes of a set travel with a node.
BLOCK = 1024
SKETCHED = 512
SKETCH = "doc_id bigint, node binary, n_shingles bigint, signature binary"

_rng = np.random.default_rng(20240)
_ODD = (_rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def shingles(text: str) -> np.ndarray:
    """Sorted different shingle hashes; words are runs without ASCII white space."""
    # bytes.lower and bytes.split know ASCII letters and white space only
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(WORDS, len(w))
    n = len(w) - size + 1
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h = _mixed(h * _STEP + w[k : k + n])
    return np.unique(h)


def signature(hashes: np.ndarray) -> np.ndarray:
    low = hashes.astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(low), 2048):
        part = low[k : k + 2048, None] * _ODD + _ADD
        np.minimum(least, part.min(axis=0), out=least)
    return least.astype(np.uint16)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_blocks(batches):
        nodes, sizes, sigs = [], [], []
        for t in texts:
            h = shingles(t)
            sizes.append(len(h))
            nodes.append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
            sigs.append(signature(h).tobytes() if len(h) else None)
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                pa.array(nodes, pa.binary()),
                pa.array(sizes, pa.int64()),
                pa.array(sigs, pa.binary()),
            ],
            names=["doc_id", "node", "n_shingles", "signature"],
        )


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys of each node: a chunk's place, its open value, its other values."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16)
        sig = sig.reshape(-1, HASHES // CHUNK, CHUNK).astype(np.int64)
        out = np.empty((len(sig), HASHES // CHUNK, CHUNK), np.int64)
        place = np.arange(HASHES // CHUNK) * CHUNK
        for open_ in range(CHUNK):
            key = np.broadcast_to(place + open_, sig.shape[:2]).copy()
            for k in range(CHUNK):
                if k != open_:
                    key = (key << 16) | sig[:, :, k]
            out[:, :, open_] = key
        node = np.repeat(np.arange(batch.num_rows), HASHES)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out.reshape(-1)), batch.column("node").take(pa.array(node))],
            names=["key", "node"],
        )


def _confirm(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs whose full sets have 100 * intersection >= limit * union."""
        for batch in batches:
            keep, seen = [], {}
            a, b = batch.column("set_a"), batch.column("set_b")
            bs = batch.column("b")
            for i in range(batch.num_rows):
                x = np.frombuffer(a[i].as_py(), np.uint64)
                other = bs[i].as_py()
                if other not in seen:
                    if len(seen) > 64:
                        seen.clear()
                    seen[other] = np.frombuffer(b[i].as_py(), np.uint64)
                y = seen[other]
                small, large = (x, y) if len(x) < len(y) else (y, x)
                if 100 * len(small) < limit * len(large):
                    keep.append(False)
                    continue
                at = np.searchsorted(large, small)
                at[at == len(large)] = 0
                both = int((large[at] == small).sum())
                keep.append(100 * both >= limit * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_blocks(batches):
        sets = [shingles(t).tobytes() for t in texts]
        nodes = [xxhash.xxh3_128_digest(s) if s else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.binary()), pa.array(sets, pa.binary())], names=["node", "shingles"]
        )


def full_sets(pairs: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shingles) of the nodes in ``pairs``, from the texts anew."""
    wanted = (
        pairs.select(F.col("a").alias("node"))
        .unionByName(pairs.select(F.col("b").alias("node")))
        .distinct()
    )
    # one document of each node
    places = nodes.join(wanted, "node", "left_semi").select(F.col("text_id").alias("__id")).distinct()
    texts = docs.join(places, docs["doc_id"].eqNullSafe(places["__id"]), "left_semi")
    # rows that repeat a doc_id may hold other texts; those of no wanted node meet no pair
    return stored(
        texts.mapInArrow(_sets, "node binary, shingles binary").dropDuplicates(["node"]), "sets"
    )


def confirmed(pairs: DataFrame, sets: DataFrame, limit: int) -> DataFrame:
    """The pairs (a, b) of nodes that are links by their full sets."""
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "set_a", "set_b")
    return stored(both.mapInArrow(_confirm(limit), "a binary, b binary"), "links")


def _least_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each node its size and its SKETCHED least mixed hashes (32 bits, sorted)."""
    for batch in batches:
        sizes, least = [], []
        for raw in batch.column("shingles").to_pylist():
            h = np.sort((np.frombuffer(raw, np.uint64) >> np.uint64(16)).astype(np.uint32))
            sizes.append(len(h))
            least.append(h[:SKETCHED].tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array(sizes, pa.int64()), pa.array(least, pa.binary())],
            names=["node", "size", "least_hashes"],
        )


def _first_shared(sig: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many values differ, and the number of the first key that is shared."""
    same = others == sig
    apart = HASHES - same.sum(axis=1)
    chunks = same.reshape(len(others), -1, CHUNK)
    misses = CHUNK - chunks.sum(axis=2)
    chunk = (misses <= 1).argmax(axis=1)
    row = np.arange(len(others))
    open_ = np.where(misses[row, chunk] == 0, 0, chunks[row, chunk].argmin(axis=1))
    return apart, chunk * CHUNK + open_


def _similarity(x: np.ndarray, nx: int, y: np.ndarray, ny: int) -> tuple[float, float]:
    """Similarity of two sets by their least hashes, and its standard error (0: exact)."""
    both = np.intersect1d(x, y)
    if nx <= SKETCHED and ny <= SKETCHED:
        return len(both) / (nx + ny - len(both)), 0.0
    union = np.union1d(x, y)[:SKETCHED]
    j = np.searchsorted(both, union[-1], "right") / len(union)
    return j, (0.1875 / len(union)) ** 0.5


class _Groups:
    """Which rows of a block are known to belong together."""

    def __init__(self, names: list[bytes]):
        number: dict[bytes, int] = {}
        self.label = np.array([number.setdefault(n, len(number)) for n in names])

    def join(self, i: int, j: int) -> None:
        self.label[self.label == self.label[j]] = self.label[i]


def _linked_in_block(
    key: int, two_blocks: bool, rows: list[tuple], limit: float
) -> list[tuple[bytes, bytes]]:
    """Links across components among the rows (side, node, component, signature, size,
    least hashes) under one key. A pair counts under the first key it shares only."""
    sig = np.frombuffer(b"".join([r[3] for r in rows]), np.uint16).reshape(-1, HASHES)
    side = np.array([r[0] for r in rows])
    size = np.array([r[4] for r in rows])
    groups = _Groups([r[2] for r in rows])
    if len(set(groups.label.tolist())) < 2:
        return []
    place = key >> (16 * (CHUNK - 1))
    sets: dict[int, np.ndarray] = {}
    out = []
    for i in range(len(rows) - 1):
        rest = np.arange(i + 1, len(rows))
        ok = (groups.label[rest] != groups.label[i]) & (
            100 * np.minimum(size[rest], size[i]) >= limit * np.maximum(size[rest], size[i])
        )
        if two_blocks:
            ok &= side[rest] != side[i]
        rest = rest[ok]
        if not len(rest):
            continue
        apart, first = _first_shared(sig[i], sig[rest])
        for j in rest[(apart <= MOST_APART) & (first == place)].tolist():
            if groups.label[i] == groups.label[j]:
                continue
            for k in (i, j):
                if k not in sets:
                    sets[k] = np.frombuffer(rows[k][5], np.uint32)
            s, error = _similarity(sets[i], size[i], sets[j], size[j])
            if 100 * (s + 5 * error) + 1e-9 < limit:
                continue
            out.append((max(rows[i][1], rows[j][1]), min(rows[i][1], rows[j][1])))
            if 100 * (s - 5 * error) >= limit:
                groups.join(i, j)
    return out


def _blocked_links(limit: int):
    columns = ("key", "low", "high", "side", "node", "component", "signature", "size", "least_hashes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Candidate links from rows sorted by key and pair of blocks."""
        held: list[tuple] = []
        at = None

        def batch_of(found) -> pa.RecordBatch:
            a, b = zip(*found) if found else ((), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"]
            )

        for batch in batches:
            found: list[tuple] = []
            for key, low, high, *row in zip(*[batch.column(c).to_pylist() for c in columns], strict=True):
                if (key, low, high) != at:
                    if len(held) > 1:
                        found += _linked_in_block(at[0], at[1] != at[2], held, limit)
                    held, at = [], (key, low, high)
                held.append(tuple(row))
            yield batch_of(found)
        if len(held) > 1:
            yield batch_of(_linked_in_block(at[0], at[1] != at[2], held, limit))

    return run


def _across(
    members: DataFrame, labels: DataFrame, nodes: DataFrame, sets: DataFrame, limit: int
) -> DataFrame:
    """Candidate links between components that share a key."""
    tagged = stored(
        members.where("n > 2")
        .join(labels, "node", "left")
        .select("key", "node", "n", F.coalesce("component", "node").alias("component")),
        "tagged",
    )
    mixed = (
        tagged.groupBy("key")
        .agg(F.min("component").alias("x"), F.max("component").alias("y"))
        .where("x != y")
        .select("key")
    )
    facts = sets.mapInArrow(_least_hashes, "node binary, size bigint, least_hashes binary").join(
        nodes.select("node", "signature"), "node"
    )
    rows = (
        tagged.join(mixed, "key", "left_semi")
        .join(facts, "node")
        .withColumn("blocks", F.expr(f"cast(ceil(n / {BLOCK}D) as int)"))
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
        # once with each block, itself included; side tells the two apart
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "key",
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
            F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"),
            "node",
            "component",
            "signature",
            "size",
            "least_hashes",
        )
    )
    dealt = rows.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return dealt.mapInArrow(_blocked_links(limit), "a binary, b binary").distinct()


def near_duplicates(docs: DataFrame, limit: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    ``docs`` has doc_id and text; other columns are ignored. Two documents are linked
    when 100 * intersection >= ``limit`` * union of their sets of word shingles (five
    words, ASCII letters in lower case; with fewer words all of them as one). A
    component is what links reach; its id is its smallest doc_id, and the document
    with that id is kept.

    Null and blank texts have an empty set and link with nothing, not even each
    other. Repeated texts are one node, so thousands of copies cost one. A component
    without any doc_id has a null id, and its rows are kept. Rows with equal doc_id
    are rows of their own; all that carry the smallest id are kept.

    Signatures can miss a pair at the limit with a probability of about 1e-5; every
    link found is exact (sets are compared as 64-bit hashes). The texts are shuffled
    to take one of each candidate; keys and ids otherwise.
    """
    docs = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text")
    )
    sketches = stored(docs.mapInArrow(_sketch, SKETCH), "sketches")
    # a node and the document that will give its text
    nodes = stored(
        sketches.where("node is not null")
        .groupBy("node")
        .agg(F.min("doc_id").alias("text_id"), F.first("signature").alias("signature")),
        "nodes",
    )
    keys = nodes.select("node", "signature").mapInArrow(_keyed, "key bigint, node binary")
    least = (
        keys.groupBy("key").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    )
    members = stored(keys.join(least, "key"), "members")
    star = members.where("node != least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    star = stored(star.distinct(), "star")
    sets = full_sets(star, docs, nodes)
    links = confirmed(star, sets, limit)
    labels = components(links)
    more = stored(_across(members, labels, nodes, sets, limit), "across")
    if more.limit(1).count():
        labels = components(links.unionByName(confirmed(more, sets, limit)))
    tagged = sketches.join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    smallest = (
        tagged.where("component is not null")
        .groupBy("component")
        .agg(F.min("doc_id").alias("smallest"))
    )
    own = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("smallest"))
    return tagged.join(smallest, "component", "left").select(
        "doc_id",
        "n_shingles",
        own.alias("component_id"),
        F.col("doc_id").eqNullSafe(own).alias("kept"),
    )


def first_of_each(docs: DataFrame, limit: int = 75) -> DataFrame:
    """The pipeline's form: the rows of ``docs`` that are kept.

    Of rows that share a doc_id, all go if one does.
    """
    found = near_duplicates(docs, limit)
    gone = found.where("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col("doc_id").cast("bigint").eqNullSafe(F.col("__gone")), "left_anti")
