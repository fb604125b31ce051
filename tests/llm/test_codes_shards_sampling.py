"""Vector codes, slot shards and word resampling against definitions and SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from transitlake.llm import limb_codes as codes
from transitlake.llm import slot_shards as shards
from transitlake.llm import word_resampling as words

DOCS = "doc_id bigint, text string"


# --- limbs and product codes --------------------------------------------------------


@pytest.mark.parametrize("size", [1, 1 << 12, 1 << 24, 1 << 29])
@pytest.mark.parametrize("width", [1, 4, 100])
def test_limb_products_are_exact(size, width):
    rng = np.random.default_rng(size + width)
    x, y = rng.integers(-size, size + 1, (2, 7, width))
    bits = codes.limb_bits(width)
    assert sum((l.astype(np.int64) << (bits * i)) for i, l in enumerate(codes.limbs(x, bits))).tolist() == x.tolist()
    assert width << (2 * bits) < 1 << 53
    want = [[sum(int(a) * int(b) for a, b in zip(r, c)) for c in y] for r in x]
    assert codes.exact_products(x, y).tolist() == want


def brute_codes(rows, parts, entries, rounds, scale=256):
    """(id, label, vector) rows by the definition, in Python integers."""
    kept = sorted(
        (i, lab, [math.floor(scale * x) for x in v])
        for i, lab, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    )
    w = len(kept[0][2]) // parts
    cut = [[v[p * w : (p + 1) * w] for p in range(parts)] for _, _, v in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def assign():
        out = []
        for c in cut:
            best = [min((sum((a - b) ** 2 for a, b in zip(c[p], e)), k) for k, e in enumerate(books[p])) for p in range(parts)]
            out.append(best)
        return out

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [c[p] for c, f in zip(cut, found) if f[p][1] == k]
                if own:
                    books[p][k] = [sum(col) // len(own) for col in zip(*own)]
    found = assign()
    error = [sum(d for d, _ in f) for f in found]
    by = defaultdict(int)
    for (_, lab, _), e in zip(kept, error):
        by[lab] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return {
        (i, "".join(f"{k:02x}" for _, k in f), e, by[lab], digest)
        for (i, lab, _), f, e in zip(kept, found, error)
    }


VECTORS = "vec_id bigint, label int, embedding array<double>"


@pytest.mark.parametrize("scale", [1.0, 1e5])
def test_codes_against_the_definition(spark, scale):
    rng = random.Random(3)
    rows = [(i, rng.choice([0, 0, 1, None]), [rng.gauss(0, scale) for _ in range(8)]) for i in range(120)]
    rows += [(200 + i, 5, rows[7][2]) for i in range(20)]
    rows += [
        (300, 1, None), (301, 1, [None] * 8), (302, 1, [math.nan] * 8), (303, 1, [1.0] * 7 + [math.inf]),
        (-5, 1, [math.nan, *[0.0] * 7]),
    ]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    got = codes.compress_query(df, parts=4, entries=6, rounds=3).collect()
    assert {tuple(r) for r in got} == brute_codes(rows, 4, 6, 3)
    assert len(got) == 140


def test_codes_defined_cases(spark):
    vectors = [(0, 1, [0.5, 0.5, 0.5]), (1, 1, [2.0, 2.0, 2.0]), (2, None, [1.0]), (None, None, [0.5, 0.5, 0.5]),
               (1, 1, [2.0, 2.0, 2.0]), (4, 2, []), (5, 2, [1e300, -1e300, 0.0])]
    df = spark.createDataFrame(vectors, VECTORS).selectExpr("*", "'x' AS code", "1 AS error", "2 AS _id")
    got = codes.compress_query(df, parts=2, entries=3).collect()
    assert got[0].__fields__ == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    by = defaultdict(list)
    for r in got:
        by[r.vec_id].append(r)
    assert len(got) == 7 and len(by[1]) == 2 and by[1][0] == by[1][1]
    assert by[2][0].code is None and by[2][0].error is None and by[4][0].code is None
    assert by[None][0].code == by[0][0].code and by[5][0].error >= 0
    none = codes.compress_query(df.limit(0), parts=2)
    assert none.collect() == [] and none.columns == got[0].__fields__


def test_codes_decode_to_entries(spark):
    rows = [(i, 0, [float(i % 4), 1.0, -2.0, 0.25]) for i in range(40)]
    df = spark.createDataFrame(rows, VECTORS)
    shape, books = codes.train(df, parts=2, entries=4)
    back = codes.decode(codes.encode(df, shape, books), shape, books).collect()
    assert all(r.error == 0 and r.approximate == rows[r.vec_id][2] for r in back)


# --- slot shards --------------------------------------------------------------------


def check_shards(rows, texts, n):
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    places, load = defaultdict(list), [0] * n
    for r in rows:
        assert 0 <= r.shard < n and r.law == "bytes" and r.grown_shard is None
        places[r.shard].append(r.slot)
        load[r.shard] += r["size"]
    assert all(sorted(v) == list(range(len(v))) for v in places.values())
    return load


def test_shards_hold_equal_bytes_whatever_repeats(spark):
    rng = random.Random(5)
    texts = [(i, "".join(rng.choice("abcdé ") for _ in range(rng.randrange(200)))) for i in range(1500)]
    texts += [(10_000 + i, "the same long text " * 20) for i in range(400)]
    texts += [(None, "no id " * 30)] * 500 + [(3, None), (None, None), (4, ""), (texts[0][0], texts[0][1])]
    df = spark.createDataFrame(texts, DOCS).selectExpr("*", "7 AS size", "'x' AS shard", "1 AS copy", "2 AS id")
    got = shards.shard_query(df.repartition(7)).collect()
    load = check_shards(got, texts, 16)
    assert max(load) - min(load) <= 0.02 * sum(load) / 16
    again = shards.shard_query(df.repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    # equal texts of ordinary size lie in one shard
    by = defaultdict(set)
    for r in got:
        by[r.text_crc32, r["size"]].add(r.shard)
    hot = {(zlib.crc32(t.encode()), len(t) + 1) for t in ("the same long text " * 20, "no id " * 30)}
    assert all(len(s) == 1 for k, s in by.items() if k not in hot)


def test_shards_of_few_and_no_rows(spark):
    long = [(0, "z" * 3_000_000), (1, "a"), (2, None)]
    check_shards(shards.shard_query(spark.createDataFrame(long, DOCS)).collect(), long, 16)
    assert shards.shard_query(spark.createDataFrame([], DOCS)).collect() == []


def test_many_equal_rows_are_numbered_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(shards, "BLOCK", 10)
    texts = [(1, "x")] * 95 + [(2, "y")] * 3
    rows = shards.records(spark.createDataFrame(texts, DOCS)).collect()
    assert sorted(r.copy for r in rows if r.id == 1) == list(range(95))


def test_map_is_edited_in_versions(spark, tmp_path):
    rng = random.Random(1)
    sizes = [(s, rng.randrange(1, 1000), 1) for s in range(500)]
    first = shards.first_map(sizes, 8, 512)
    even = sum(b for _, b, _ in sizes) / 8
    assert max(first.loads()) - min(first.loads()) <= 0.001 * even
    grown = first.grown()
    assert grown.version == first.version + 1 and grown.shards == 9
    assert all(grown.shard[s] == 8 for s in grown.moved)
    assert all(a == b for s, (a, b) in enumerate(zip(first.shard, grown.shard)) if s not in set(grown.moved))
    assert max(grown.loads()) <= 1.03 * even * 8 / 9 + 1000 and grown.loads()[8] >= 0.9 * even * 8 / 9
    # a third of the slots become three times as large
    later = first.counted((s, b * 3 if s % 3 == 0 and first.shard[s] < 4 else b, n) for s, b, n in sizes)
    level = later.levelled(0.01)
    assert max(level.loads()) <= 1.01 * sum(level.loads()) / 8 < max(later.loads())
    assert len(level.moved) < 250
    for held in (first, grown):
        shards.save_map(spark, held, str(tmp_path))
    back = shards.load_map(spark, str(tmp_path))
    assert (back.version, back.shard, back.size) == (grown.version, grown.shard, grown.size)
    assert shards.load_map(spark, str(tmp_path), first.version).shard == first.shard


def test_shards_are_written_whole(spark, tmp_path):
    texts = [(i, f"text {i} " * (i % 9)) for i in range(300)]
    df = spark.createDataFrame(texts, DOCS).selectExpr("*", "doc_id AS size", "'x' AS shard")
    held = shards.first_map(
        shards.slot_sizes(shards.with_slot(shards.records(df), 4, 64)), 4, 64
    )
    shards.write_shards(df, held, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.doc_id, r.text, r["size"]) for r in back.collect()) == [(i, t, i) for i, t in texts]
    placed = {r.id: r.shard for r in shards.placed(shards.with_slot(shards.records(df), 4, 64), held).collect()}
    assert all(r.shard == placed[r.doc_id] for r in back.collect())


def test_shards_run_without_python_workers(spark):
    df = spark.createDataFrame([(1, "a")], DOCS)
    rows = shards.with_slot(shards.records(df), 4)
    held = shards.first_map(shards.slot_sizes(rows), 4)
    plan = shards.placed(rows, held)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|ExistingRDD", plan)


# --- word resampling ----------------------------------------------------------------

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_resampling(docs, target, grams=1, buckets=10_000, share=10, least=20):
    def features(text):
        found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        return len(found), [
            zlib.crc32(" ".join(found[i : i + n]).encode()) % buckets
            for n in range(1, grams + 1)
            for i in range(len(found) - n + 1)
        ]

    own = [(i, *features(t)) for i, t in docs]
    s, t = Counter(), Counter()
    for _, _, f in own:
        s.update(f)
    for text in target:
        t.update(features(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    rows = []
    for i, n, f in own:
        weight = sum(
            math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in f
        )
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    fit = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(fit[: share * len(fit) // 100], 1):
        r[4] = place
    return Counter(tuple(r[:5]) for r in rows)


def texts_of(rng, n):
    alphabet = ["Alpha", "beta7", "naïve", "Ünï", "x", "日本語", "a_b", "don't", "ÉCOLE", "w" * 300]
    glue = [" ", "  ", "\n", "-", "\x00", " ", "."]
    return [
        "".join(rng.choice(alphabet) + rng.choice(glue) for _ in range(rng.randrange(60))) for _ in range(n)
    ]


@pytest.mark.parametrize("grams, buckets", [(1, 10_000), (3, 10_000), (2, 100_003)])
def test_resampling_against_the_definition(spark, grams, buckets):
    rng = random.Random(grams)
    docs = [*enumerate(texts_of(rng, 300)), (300, None), (301, ""), (None, "one two " * 15)]
    target = [*texts_of(rng, 20), None]
    df = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 AS score", "2 AS _id", "3 AS rank").repartition(6)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = words.resample(df, goal, grams=grams, buckets=buckets, share=40)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(tuple(r) for r in got.collect()) == brute_resampling(docs, target, grams, buckets, 40)


def test_resampling_of_repeats_long_texts_and_empty_tables(spark):
    docs = [(7, "same words here " * 10)] * 50 + [(i, "other text " * 12) for i in range(50)]
    docs += [(1000, "very long text " * 400_000)]
    df = spark.createDataFrame(docs, DOCS).repartition(4)
    goal = spark.createDataFrame([("same words",)], "text string")
    got = words.resample(df, goal, share=30).collect()
    ranks = sorted(r["rank"] for r in got if r["rank"])
    assert len(got) == 101 and ranks == list(range(1, 31))
    want = brute_resampling(docs, ["same words"], share=30)
    assert Counter((r.doc_id, r.weight, r.score, r["rank"] is None) for r in got) == Counter(
        {k2: n for k2, n in Counter((a, c, d, e is None) for (a, b, c, d, e), m in want.items() for _ in range(m)).items()}
    )
    assert words.resample(df.limit(0), goal).collect() == []
    alone = words.resample(df.limit(3), goal.limit(0)).collect()
    assert len(alone) == 3


def test_small_dictionary_gives_the_same_payloads():
    rng = random.Random(9)
    texts = [t.encode() for t in texts_of(rng, 200)]
    small, large = words.Dictionary(3), words.Dictionary()
    for block in (texts[:50], texts[50:120], texts[120:]):
        a, b = (words.gram_crcs(block, d, 2) for d in (small, large))
        assert all((x == y).all() for x, y in zip(a, b))
    assert len(small.words) == 3 and len(large.words) > 3
    # all words of a known block come from the automaton
    start, crc, length = large.scan(b" alpha  x ")
    assert [(s, c) for s, c in zip(start, crc)] == [(1, zlib.crc32(b"alpha")), (8, zlib.crc32(b"x"))]


def test_joined_checksums():
    rng = random.Random(2)
    parts = [(rng.randbytes(rng.randrange(9)), rng.randbytes(rng.randrange(400))) for _ in range(100)]
    got = words.joined_crc(
        np.array([zlib.crc32(a) for a, _ in parts], np.uint32),
        np.array([zlib.crc32(b) for _, b in parts], np.uint32),
        np.array([len(b) for _, b in parts]),
    )
    assert got.tolist() == [zlib.crc32(a + b) for a, b in parts]


def test_drawn_documents_are_like_the_target(spark):
    rng = random.Random(4)
    good, bad = [f"g{i}" for i in range(50)], [f"b{i}" for i in range(50)]
    docs = [(i, " ".join(rng.choices(good if i % 10 == 0 else bad, k=40))) for i in range(400)]
    df = spark.createDataFrame(docs, DOCS)
    goal = spark.createDataFrame([(" ".join(good),)], "text string")
    drawn = words.drawn_documents(df, goal).collect()
    assert len(drawn) == 40 and all(r.doc_id % 10 == 0 for r in drawn) and drawn[0].text
