"""Line dedup by a tree of log templates.

A line goes down a tree of fixed depth: by its number of tokens, then by its leading
tokens, where a token with a digit counts as a field and matches any other (unless
most tokens are such, as in a table of numbers, which stays as it is). In a leaf,
a template fixes the rest of the tokens but for one stretch: the rest is cut into
``stretches`` parts, and a long line belongs to each template that leaves one part
open. Lines of one leaf that agree outside a part thus share a template, which is the
similarity test of log parsers (here 1 - 1 / stretches of the rest) in a form that is
a key: templates are counted by a plain aggregation, in any order and on any number
of machines. Lines in a template that many documents hold are dropped. How many it
takes depends on how many tokens the template fixes: short boilerplate must recur
often, a long line says enough when a second, unlike document has it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlake.llm.common import stored, text_blocks, whole_text
from transitlake.llm.hamming_near_dup import shingles

DIGIT = re.compile(r"\d")
OPEN = "<*>"
KEYS = "doc_id bigint, template bigint"
# (fixed tokens, documents): a template that fixes so many tokens recurs in so many
# documents; with fewer fixed tokens it takes min_docs. The place in this list, from 1,
# is in the lowest two bits of a template's key (0: none of them).
TELLING = ((8, 4), (12, 3), (20, 2))
# Documents with this estimated share of common shingles are alike; the estimate takes
# the LEAST smallest shingle hashes of both (exact for sets that are not larger).
ALIKE = 0.5
LEAST = 64


def template_keys(line: str, depth: int, stretches: int, longest_exact: int) -> list[int]:
    """Keys of the templates that a line belongs to; none for a blank line."""
    words = tokens = line.split()
    n = len(tokens)
    if not n:
        return []
    if DIGIT.search(line):
        general = [OPEN if DIGIT.search(t) else t for t in tokens]
        if 2 * general.count(OPEN) <= n:
            tokens = general
    whole = telling(n - (tokens.count(OPEN) if tokens is not words else 0))
    if n <= longest_exact:
        return [_key(f"{n}\x00" + " ".join(tokens), whole)]
    ends = [depth + (n - depth) * i // stretches for i in range(stretches + 1)]
    keys, most = [], 0
    for i in range(stretches):
        fixed = tokens[: ends[i]] + tokens[ends[i + 1] :]
        level = telling(len(fixed) - (fixed.count(OPEN) if tokens is not words else 0))
        most = max(most, level)
        kept = " ".join(tokens[: ends[i]] + [OPEN] + tokens[ends[i + 1] :])
        keys.append(_key(f"{n}\x01{i}\x00" + kept, level))
    if whole > most:
        # all tokens together say more than any template with an open stretch
        keys.append(_key(f"{n}\x00" + " ".join(tokens), whole))
    return keys


def telling(fixed: int) -> int:
    """The level in ``TELLING`` of a template with so many fixed tokens."""
    return sum(fixed >= least for least, _ in TELLING)


def _key(text: str, level: int) -> int:
    h = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) & ~3 | level
    return h - (1 << 64) if h >> 63 else h


def _emit(depth: int, stretches: int, longest_exact: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_blocks(batches):
            ids, keys = [], []
            for doc, text in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                own = {
                    k
                    for line in set(text.split("\n"))
                    for k in template_keys(line, depth, stretches, longest_exact)
                }
                keys += own
                ids += [doc] * len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.int64())], names=["doc_id", "template"]
            )

    return run


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least shingle hashes of each document."""
    for part, texts in text_blocks(batches):
        found = [(shingles(t)[:LEAST] >> np.uint64(32)).astype(np.uint32).tobytes() for t in texts]
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(found, pa.binary())], names=["doc_id", "signature"]
        )


def similarity(a: bytes, b: bytes) -> float:
    """Estimated share of common shingles of two documents, from their signatures."""
    x, y = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
    union = np.union1d(x, y)[:LEAST]
    both = np.isin(union, x) & np.isin(union, y)
    return int(both.sum()) / max(len(union), 1)


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of documents that are alike by their signatures."""
    for batch in batches:
        x, y = (batch.column(c).to_pylist() for c in ("signature", "first_signature"))
        near = [similarity(a, b) >= ALIKE for a, b in zip(x, y, strict=True)]
        yield batch.select(["__doc", "__first"]).filter(pa.array(near, pa.bool_()))


def recurring_templates(
    docs: DataFrame, min_docs: int, depth: int, stretches: int, longest_exact: int
) -> DataFrame:
    """(doc_id, template): the templates that each document loses its lines of.

    Documents that share a template too few hold are compared by signatures, which are
    worked out for these documents alone.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    emitted = stored(texts.mapInArrow(_emit(depth, stretches, longest_exact), KEYS), "templates")
    held = emitted.select("doc_id", "template")
    level = F.col("template").bitwiseAND(F.lit(3))
    needed = F.lit(min_docs)
    for k, (_, n) in enumerate(TELLING, 1):
        needed = F.when(level == k, min(n, min_docs)).otherwise(needed)
    found = (
        held.groupBy("template")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"))
        .where(F.col("n_docs") >= needed)
    )
    losing = stored(
        held.join(found, "template").where(~F.col("doc_id").eqNullSafe(F.col("first_doc"))), "losing"
    )
    # below min_docs a line counts only between unlike documents
    few = losing.where(F.col("n_docs") < min_docs)
    pairs = stored(
        few.select(F.col("doc_id").alias("__doc"), F.col("first_doc").alias("__first")).distinct(), "pairs"
    )
    doubtful = stored(
        pairs.select(F.col("__doc").alias("doc_id"))
        .unionByName(pairs.select(F.col("__first").alias("doc_id")))
        .distinct(),
        "doubtful",
    )
    signatures = stored(
        texts.join(doubtful, "doc_id", "left_semi")
        .mapInArrow(_signatures, "doc_id bigint, signature binary")
        .groupBy("doc_id")
        .agg(F.min("signature").alias("signature")),
        "signatures",
    )
    first = signatures.select(
        F.col("doc_id").alias("__first"), F.col("signature").alias("first_signature")
    )
    alike = (
        pairs.join(signatures.withColumnRenamed("doc_id", "__doc"), "__doc")
        .join(first, "__first")
        .mapInArrow(_alike, "__doc bigint, __first bigint")
    )
    apart = few.join(
        alike,
        (F.col("doc_id") == F.col("__doc")) & (F.col("first_doc") == F.col("__first")),
        "left_anti",
    )
    often = losing.where(F.col("n_docs") >= min_docs)
    return often.unionByName(apart).select("doc_id", "template")


def _rewrite(names: list[str], depth: int, stretches: int, longest_exact: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_blocks(batches, "__text"):
            out, dropped, left = [], [], []
            for text, drop in zip(texts, part.column("__drop").to_pylist(), strict=True):
                lines = text.split("\n")
                if drop:
                    gone = set(drop)
                    kept = [
                        line
                        for line in lines
                        if gone.isdisjoint(template_keys(line, depth, stretches, longest_exact))
                    ]
                else:
                    kept = lines
                out.append("\n".join(kept))
                dropped.append(len(lines) - len(kept))
                left.append(sum(1 for line in kept if line.strip()))
            yield pa.RecordBatch.from_arrays(
                [part.column(n) for n in names]
                + [
                    pa.array(out, pa.string()),
                    pa.array(dropped, pa.int64()),
                    pa.array(left, pa.int64()),
                ],
                names=[*names, "__kept", "__n_dropped", "__n_left"],
            )

    return run


def drop_recurring_lines(
    docs: DataFrame,
    min_docs: int = 6,
    depth: int = 3,
    stretches: int = 4,
    longest_exact: int = 11,
) -> DataFrame:
    """The documents without the lines of recurring templates.

    Returns every row with its columns, ``text`` as it is left, and n_lines_dropped and
    n_lines_left (lines that are not blank). A template recurs when ``min_docs``
    documents hold it, or fewer if it fixes more tokens (``TELLING``: two documents
    from 20 tokens on); the document with the smallest doc_id of those keeps its lines,
    so no content is lost altogether. Lines of up to ``longest_exact`` tokens must
    agree in all tokens (fields aside).

    Where fewer than ``min_docs`` documents hold a template, a document that is like
    the one that keeps (``ALIKE`` of their shingles, estimated) keeps as well: copies
    and near-copies share all lines, and are whole documents to near-duplicate removal.

    Null texts stay null and have no lines; blank lines stay. A line repeated inside
    one document counts once. Rows with equal doc_id count as documents of their own,
    but lose the same templates, and the smallest doc_id keeps in all its rows. Null
    doc_ids keep a template only where no other document holds it. New columns
    replace columns of the same name.

    The counts combine on the map side, so a line of a third of all documents is one
    row per task. Only templates, ids and signatures are shuffled for the decision, the
    texts once. At most ``min_docs`` - 2 pairs of documents are compared per template.
    """
    drops = (
        recurring_templates(docs, min_docs, depth, stretches, longest_exact)
        .groupBy(F.col("doc_id").alias("__doc"))
        .agg(F.collect_set("template").alias("__drop"))
    )
    names = [c for c in docs.columns if c not in ("n_lines_dropped", "n_lines_left")]
    joined = (
        docs.select(*names)
        .join(drops, F.col("doc_id").cast("bigint").eqNullSafe(F.col("__doc")), "left")
        .select(*names, whole_text().alias("__text"), "__drop")
    )
    schema = docs.select(*names).schema
    ddl = "__kept string, __n_dropped bigint, __n_left bigint"
    made = joined.mapInArrow(
        _rewrite(names, depth, stretches, longest_exact),
        T.StructType([*schema.fields, *T.StructType.fromDDL(ddl).fields]),
    )
    return made.select(
        *[
            F.when(F.col("text").isNotNull(), F.col("__kept")).alias(c) if c == "text" else F.col(c)
            for c in names
        ],
        F.col("__n_dropped").alias("n_lines_dropped"),
        F.col("__n_left").alias("n_lines_left"),
    )


def dedup_query(docs: DataFrame) -> DataFrame:
    """Per document what is left of it, as digests."""
    kept = drop_recurring_lines(docs.select("doc_id", "text"))
    return kept.select(
        "doc_id",
        "n_lines_dropped",
        "n_lines_left",
        F.length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_chars_left"),
        F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"),
    )


def own_lines(docs: DataFrame, **settings) -> DataFrame:
    """The pipeline's form: the columns of ``docs``, without documents that had
    nothing but recurring lines."""
    kept = drop_recurring_lines(docs, **settings)
    return kept.where("n_lines_dropped = 0 or n_lines_left > 0").select(*docs.columns)
