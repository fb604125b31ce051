"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A batch of texts is cut into words at the places no piece can cross; each
different word is encoded once. All words of a batch are one flat numpy array of
symbols. A round finds the best pair of each word (a segmented minimum of pair
ranks), merges its leftmost non-overlapping occurrences in all words at once, and
compacts the array; words without a pair leave it. The result is the library's,
which merges one pair at a time: where merging all occurrences at once could
differ from that (a merge makes a pair at least as good as itself), the word takes
only its leftmost merge in that round.

Only the vocabulary is read with the ``sentencepiece`` package.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlake.llm.common import text_blocks, whole_text

SPACE = "▁"
NONE = np.int32(2**31 - 1)
# A worker keeps encoded words between batches up to this many (memory bound).
MOST_WORDS = 600_000
# Words of one flat array.
BLOCK = 20_000
# Slots of the pair tables, as a power of two.
TABLE_BITS = 20
# White-space runs longer than this are cut after whole pieces of 16.
LONG_RUN = 48


class PieceModel:
    """Vocabulary and pair table of a BPE model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
        self.byte_ids = np.full(256, sp.unk_id(), np.int32)
        self.raw: list[bytes] = []
        ids: dict[str, int] = {}
        for i, p in enumerate(pieces):
            if sp.is_byte(i):
                b = int(p[3:-1], 16)
                self.byte_ids[b] = i
                self.raw.append(bytes([b]))
            elif special[i]:
                self.raw.append(b"")
            else:
                ids[p] = i
                self.raw.append(p.replace(SPACE, " ").encode())
        self.size = n
        # a character outside the vocabulary is the symbol size + code point
        self.first = np.arange(n, n + sys.maxunicode + 1, dtype=np.int32)
        for p, i in ids.items():
            if len(p) == 1:
                self.first[ord(p)] = i
        self.decimal = [str(i) for i in range(n)]
        scores = sorted({sp.get_score(i) for i in ids.values()}, reverse=True)
        rank_of = {s: r for r, s in enumerate(scores)}
        found = []
        for p, i in ids.items():
            r = rank_of[sp.get_score(i)]
            for k in range(1, len(p)):
                a, b = ids.get(p[:k]), ids.get(p[k:])
                if a is not None and b is not None:
                    found.append((a * n + b, r, i))
        found.sort()
        self.keys = np.array([f[0] for f in found] or [-1], np.int64)
        self.ranks = np.array([f[1] for f in found] or [NONE], np.int32)
        self.merged = np.array([f[2] for f in found] or [0], np.int32)
        self._index()
        inner = {c for p in ids if len(p) > 1 for c in p}
        # Line breaks stand alone unless a piece holds them.
        self.cut = re.compile(
            f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+"
            if "\n" in inner
            else f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+"
        )
        if any(SPACE in p[1:] and p.strip(SPACE) for p in ids):
            raise ValueError("a piece crosses a word boundary; this model can't be cut into words")
        self.words: dict[str, tuple[str, int, bytes]] = {}

    def _index(self) -> None:
        """Two open tables over the pair keys; what collides in both stays sorted."""
        rest = np.arange(len(self.keys))
        self.slots = []
        for odd in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
            slot = self._slot(self.keys[rest], odd)
            order = np.argsort(slot, kind="stable")
            first = order[np.r_[True, np.diff(slot[order]) > 0]] if len(order) else order
            held = np.zeros(1 << TABLE_BITS, np.int32)
            held[slot[first]] = rest[first]
            self.slots.append((odd, held))
            rest = np.delete(rest, first)
        self.rest = rest

    @staticmethod
    def _slot(key: np.ndarray, odd: int) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(odd)) >> np.uint64(64 - TABLE_BITS)).astype(
            np.int32
        )

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE without a piece) and merged id of each pair of symbols."""
        key = left.astype(np.int64) * self.size + right
        key[(left >= self.size) | (right >= self.size)] = -2
        (odd, held), (odd2, held2) = self.slots
        at = held[self._slot(key, odd)]
        miss = np.flatnonzero(self.keys[at] != key)
        again = held2[self._slot(key[miss], odd2)]
        at[miss] = again
        miss = miss[self.keys[again] != key[miss]]
        rank, into = self.ranks[at], self.merged[at]
        if len(self.rest):
            kept = self.keys[self.rest]
            place = np.minimum(np.searchsorted(kept, key[miss]), len(kept) - 1)
            hit = kept[place] == key[miss]
            found = self.rest[place[hit]]
            rank[miss[hit]], into[miss[hit]] = self.ranks[found], self.merged[found]
            miss = miss[~hit]
        rank[miss] = NONE
        return rank, into

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all (non-empty) words, and where each word ends."""
        text = "".join(words)
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        sym = self.first[chars]
        word = np.repeat(
            np.arange(len(words), dtype=np.int32), np.fromiter(map(len, words), np.int32, len(words))
        )
        done_sym, done_word = [], []
        rank, into = self._pairs(sym, word)
        while len(sym):
            start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            length = np.diff(np.r_[start, len(word)])
            best = np.minimum.reduceat(rank, start)
            open_ = np.repeat(best != NONE, length)
            if not open_.all():
                done_sym.append(sym[~open_])
                done_word.append(word[~open_])
                sym, word, rank, into = sym[open_], word[open_], rank[open_], into[open_]
                length = length[best != NONE]
                best = best[best != NONE]
                if not len(sym):
                    break
            best = np.repeat(best, length)
            at = np.flatnonzero(rank == best)
            # of occurrences that overlap, every other one from the left
            run = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1])
            first = np.repeat(at[run], np.diff(np.r_[run, len(at)]))
            at = at[(at - first) % 2 == 0]
            at = self._safe(at, sym, word, best, into)
            sym[at] = into[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            moved = at - np.arange(len(at))
            sym, word, rank, into = sym[keep], word[keep], rank[keep], into[keep]
            # only pairs beside a merge change
            fresh = np.zeros(len(sym) + 1, bool)
            fresh[moved] = fresh[moved - 1] = True
            touched = np.flatnonzero(fresh[:-1])
            rank[touched], into[touched] = self._pairs_at(touched, sym, word)
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        sym, word = sym[order], word[order]
        sym, word = self._bytes(sym, word)
        return sym, np.cumsum(np.bincount(word, minlength=len(words)))

    def _pairs_at(self, i, sym, word):
        j = np.minimum(i + 1, len(sym) - 1)
        rank, into = self.lookup(sym[i], sym[j])
        return np.where((j > i) & (word[i] == word[j]), rank, NONE), into

    def _pairs(self, sym, word):
        return self._pairs_at(np.arange(len(sym)), sym, word)

    def _safe(self, at, sym, word, best, into):
        """Drop all but the leftmost merge of words where order could matter."""
        new, w = into[at], word[at]
        after = np.minimum(at + 2, len(sym) - 1)
        before = np.maximum(at - 1, 0)
        worst = best[at]
        bad = (self.lookup(new, sym[after])[0] <= worst) & (after == at + 2) & (word[after] == w)
        bad |= (self.lookup(sym[before], new)[0] <= worst) & (before < at) & (word[before] == w)
        if len(at) > 1:
            both = (at[1:] == at[:-1] + 2) & (w[1:] == w[:-1])
            bad[:-1] |= both & (self.lookup(new[:-1], new[1:])[0] <= worst[:-1])
        if not bad.any():
            return at
        unsafe = np.isin(w, w[bad])
        leftmost = np.r_[True, w[1:] != w[:-1]]
        return at[~unsafe | leftmost]

    def _bytes(self, sym, word):
        """Replace characters outside the vocabulary by their bytes."""
        foreign = np.flatnonzero(sym >= self.size)
        if not len(foreign):
            return sym, word
        spelled = {
            s: self.byte_ids[np.frombuffer(chr(s - self.size).encode(), np.uint8)]
            for s in np.unique(sym[foreign]).tolist()
        }
        count = np.ones(len(sym), np.int64)
        count[foreign] = [len(spelled[s]) for s in sym[foreign].tolist()]
        out = np.repeat(sym, count)
        place = np.cumsum(count) - count
        for i in foreign.tolist():
            out[place[i] : place[i] + count[i]] = spelled[int(sym[i])]
        return out, np.repeat(word, count)

    def cut_words(self, text: str) -> list[str]:
        """The words of a text, with the space that encoding puts before it."""
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        words = self.cut.findall(marked)
        if SPACE * LONG_RUN in marked:
            words = [part for w in words for part in self._cut_run(w)]
        return words

    @staticmethod
    def _cut_run(word: str) -> list[str]:
        """Whole pieces of 16 spaces off a long run (the merges work from the left)."""
        run = len(word) - len(word.lstrip(SPACE))
        if run < LONG_RUN:
            return [word]
        whole = (run - LONG_RUN // 2) // 16
        return [SPACE * 16] * whole + [word[16 * whole :]]

    def encoded(self, texts: list[list[str]]) -> dict[str, tuple[str, int, bytes]]:
        """Encode what is new among the words; word -> decimal ids, count, bytes."""
        if len(self.words) > MOST_WORDS:
            self.words.clear()
        known = self.words
        new = list({w for words in texts for w in words if w not in known})
        for k in range(0, len(new), BLOCK):
            part = new[k : k + BLOCK]
            flat, ends = self.encode_words(part)
            flat, start = flat.tolist(), 0
            decimal = [self.decimal[i] for i in flat]
            raw = [self.raw[i] for i in flat]
            for w, end in zip(part, ends.tolist(), strict=True):
                known[w] = (",".join(decimal[start:end]), end - start, b"".join(raw[start:end]))
                start = end
        return known

    def decode_bytes(self, raw: bytes) -> str:
        """The text of the concatenated bytes of ids; the leading space goes."""
        return raw.removeprefix(b" ").decode("utf-8", "replace")


_MODELS: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """One model per worker process and path."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


ENCODED = "ids array<int>, n_tokens bigint, decoded string"
DIGESTS = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def _run(path: str, digests: bool, carried: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for part, texts in text_blocks(batches, "__text"):
            cut = [m.cut_words(t) for t in texts]
            known = m.encoded(cut)
            ids, counts, plain = [], [], []
            for words in cut:
                text_ids, number, raw = zip(*[known[w] for w in words]) if words else ((), (), ())
                ids.append(",".join(text_ids))
                counts.append(sum(number))
                plain.append(b"".join(raw))
            kept = [part.column(i) for i in range(carried)]
            names = part.schema.names[:carried]
            if digests:
                new = {
                    "n_tokens": pa.array(counts, pa.int64()),
                    "ids_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in ids],
                    "decoded_sha256": [
                        hashlib.sha256(m.decode_bytes(x).encode()).hexdigest() for x in plain
                    ],
                }
            else:
                flat = ",".join([x for x in ids if x])
                values = pa.array(np.array(flat.split(",") if flat else [], np.int32))
                ends = np.cumsum(np.r_[0, counts]).astype(np.int32)
                new = {
                    "ids": pa.ListArray.from_arrays(pa.array(ends), values),
                    "n_tokens": pa.array(counts, pa.int64()),
                    "decoded": pa.array([m.decode_bytes(x) for x in plain]),
                }
            yield pa.RecordBatch.from_arrays(
                kept + [v if isinstance(v, pa.Array) else pa.array(v) for v in new.values()],
                names=names + list(new),
            )

    return blocks


def encode_decode(
    df: DataFrame,
    model_path: str,
    text: str = "text",
    carry: list[str] | None = None,
    digests: bool = False,
) -> DataFrame:
    """Encode every whole text and decode it again.

    Returns the ``carry`` columns (all but the text by default) with ``ids``,
    ``n_tokens`` and ``decoded``, or with ``digests`` their SHA-256 forms. A column
    of the input that has the name of a new one is left out.

    Nulls encode as the empty text: no ids, empty decoded text. Equal rows give
    equal rows; an empty table gives an empty one. A text of any length is
    encoded whole. Narrow: no shuffle, one pass.
    """
    new = DIGESTS if digests else ENCODED
    made = {c.split()[0] for c in new.split(", ")}
    carry = [c for c in (df.columns if carry is None else carry) if c not in made | {text}]
    fields = T.StructType([*df.select(*carry).schema.fields, *T.StructType.fromDDL(new).fields])
    source = df.select(*carry, whole_text(text).alias("__text"))
    return source.mapInArrow(_run(model_path, digests, len(carry)), fields)


def digest_query(docs: DataFrame, model_path: str) -> DataFrame:
    return encode_decode(docs, model_path, carry=["doc_id"], digests=True).select(
        F.col("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256"
    )
