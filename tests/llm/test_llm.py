"""Operators of the llm subpackage against brute force, exact round trips and SQL."""

import hashlib
import os
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from transitlake.llm import (
    edit_decontamination as leaks,
    hamming_near_dup as near,
    license_scan,
    line_templates,
    ngram_quality,
    order_minhash,
    piece_encoding,
    queries,
    run_length_index,
    url_reputation,
    warc_bundles,
)
from transitlake.llm.components import components

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(rng, n, vocabulary=300):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def documents(spark, texts):
    """Documents with ids from 0, or (id, text) pairs."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# --- url reputation and WARC, which SQL can express --------------------------------


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_against_sql(spark, name):
    assert compare(spark, connect(SMALL), queries.QUERIES[name], queries.SQL[name], SMALL) == []


def test_urls_edge_cases(spark):
    urls = [
        None, "", "no host", "http://A.Example.COM/en/x?q#f", "http://www.example.com/en/",
        "x://h.net/fr/", "http://com", "http://com/", "a://b://c/d", "http://u.net?x/es/",
    ]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").withColumn(
        "host", F.lit("clash")
    )
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = {r.page_id: r for r in url_reputation.judge_urls(pages, labels, queries.URL_RULES).collect()}
    assert [(got[i].host, got[i].path) for i in range(10)] == [
        ("", ""), ("", ""), ("", ""), ("a.example.com", "/en/x"), ("www.example.com", "/en/"),
        ("h.net", "/fr/"), ("com", ""), ("com", "/"), ("b:", "//c/d"), ("u.net", ""),
    ]
    assert [got[i].rule for i in range(3, 10)] == [
        "example.com/en/", "www.example.com/en/", "net/fr/", None, "com/", None, None,
    ]
    assert got[3].verdict == "block" and got[4].verdict == "allow"
    assert url_reputation.judge_urls(pages.limit(0), labels).count() == 0


def test_bad_host_is_blocked_and_thin_host_is_not(spark):
    rows = [(i, "http://bad.a.org/") for i in range(60)] + [(i, "http://good.a.org/") for i in range(60, 200)]
    rows += [(200, "http://once.a.org/")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    labels = spark.createDataFrame(
        [(i, 0 if i < 60 or i == 200 else 1, 0) for i, _ in rows], "doc_id bigint, quality int, toxic int"
    )
    got = {r.host: r.verdict for r in url_reputation.judge_urls(pages, labels).collect()}
    assert got["bad.a.org"] == "block" and got["good.a.org"] == "allow"


def test_carried_document_is_the_number_that_ends_the_path(spark):
    urls = [
        "http://a.org/en/17?page=2", "http://a.org/en/18.html#top", "http://a.org/en/19/", "http://a.org/5/en",
        None, "", "http://a.org", "http://a.org/en/99999999999999999999", "http://a.org/en/17?page=2",
    ]
    pages = spark.createDataFrame(list(enumerate(urls[:8])) + [(0, urls[8])], "page_id bigint, url string")
    got = spark.sql(url_reputation.carried_sql("{pages}"), pages=pages).collect()
    assert sorted((r.page_id, r.doc_id) for r in got) == [(0, 17), (1, 18), (2, 19)]


def test_page_takes_the_label_of_the_document_it_carries(spark):
    pages = spark.createDataFrame(
        [(i, "http://bad.a.org/" if i < 60 else "http://good.a.org/") for i in range(200)],
        "page_id bigint, url string",
    )
    # the document of page i is 199 - i
    labels = spark.createDataFrame(
        [(199 - i, 0 if i < 60 else 1, 0) for i in range(200)], "doc_id bigint, quality int, toxic int"
    )
    carried = spark.createDataFrame([(i, 199 - i) for i in range(200)] * 2, "page_id bigint, doc_id bigint")
    got = {r.host: r.verdict for r in url_reputation.judge_urls(pages, labels, carried=carried).collect()}
    assert got == {"bad.a.org": "block", "good.a.org": "allow"}


def test_warc_bundles(spark, tmp_path):
    body = "é" * 80
    rows = [
        (5, "http://a/\r\nX: y", body, 1), (3, None, body, 1), (4, "u", None, 1), (6, "u", "", 1),
        (7, "u", "short", 1), (8, "u", "short", 1), (9, "u", "x" * 500_000, 1), (3, None, body, 1),
        (None, "n", body, 1),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, bundle int")
    index = warc_bundles.write_bundles(pages, str(tmp_path / "warc"), frame_bytes=400, bundle_bytes=2000)
    got = warc_bundles.read_bundles(index)
    kinds = Counter((r.page_id, r.record_type, r.refers_to) for r in got.collect())
    assert kinds == Counter({
        (5, "revisit", 3): 1, (3, "response", None): 2, (4, "response", None): 1, (6, "response", None): 1,
        (7, "response", None): 1, (8, "response", None): 1, (9, "response", None): 1, (None, "revisit", 3): 1,
    })
    wanted = spark.createDataFrame([(9,), (7,)], "page_id bigint")
    picked = {r.page_id: bytes(r.payload) for r in warc_bundles.read_records(index, wanted).collect()}
    assert picked == {9: b"x" * 500_000, 7: b"short"}
    # any reader can read a bundle from its start
    import io

    import zstandard

    path = index.first()["bundle"]
    stream = zstandard.ZstdDecompressor().stream_reader(
        io.BytesIO(open(path, "rb").read()), read_across_frames=True
    )
    assert stream.read().startswith(b"WARC/1.1\r\n")
    empty = warc_bundles.write_bundles(pages.limit(0), str(tmp_path / "none"))
    assert warc_bundles.read_bundles(empty).count() == 0


# --- decontamination ------------------------------------------------------------------


def edits(pattern, text):
    """Least edit distance of the pattern to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def test_bit_parallel_distance():
    rng = random.Random(5)
    for _ in range(300):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 12)))
        t = "".join(rng.choice("abc") for _ in range(rng.randint(0, 20)))
        assert leaks.best_end(leaks._masks(p), len(p), t)[0] == edits(p, t)


def test_leaks_against_brute_force(spark):
    rng = random.Random(2)
    items = [" ".join(words(rng, rng.randint(8, 20))) for _ in range(12)] + [None, "", "Tiny one"]
    texts = [None, ""]
    for k in range(60):
        body = words(rng, 60)
        if k % 2:
            item = list(items[k % 12])
            for _ in range(k % 7):
                at = rng.randrange(len(item))
                item[at] = rng.choice(["", "x", item[at] + "y"])
            body.insert(rng.randrange(60), "".join(item).upper())
        texts.append(rng.choice([" ", "\n"]).join(body))
    docs = documents(spark, texts + [texts[3]])
    bench = spark.createDataFrame(list(enumerate(items)) + [(99, items[0])], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in leaks.find_leaks(docs, bench).collect()}
    want = set()
    for d, t in enumerate(texts + [texts[3]]):
        for i, item in [*enumerate(items), (99, items[0])]:
            p = leaks.plain(item or "").strip()
            if p and edits(p, leaks.plain(t or "")) <= leaks.budget(len(p), 0.06, 16):
                want.add((d, i))
    assert got == want and len(want) > 10
    kept = {r.doc_id for r in leaks.drop_leaks(docs, bench).collect()}
    assert kept == set(range(len(texts) + 1)) - {d for d, _ in want}
    assert leaks.find_leaks(docs, bench.limit(0)).count() == 0


# --- fingerprints ----------------------------------------------------------------------


def test_order_minhash_neighbours(spark, monkeypatch):
    monkeypatch.setattr(order_minhash, "PIECE_ROWS", 7)
    rng = random.Random(1)
    texts = [" ".join(words(rng, rng.randint(0, 80))) for _ in range(60)] + [None, "", "a", "ß" * 50]
    docs = documents(spark, texts)
    got = by_id(order_minhash.with_next(docs))
    order = sorted(range(len(texts)), reverse=True)
    for i, d in enumerate(order):
        own, after = texts[d] or "", texts[order[(i + 1) % len(order)]] or ""
        moved = len(own) // 3
        edited = own[: len(own) - moved] + after[:moved]
        assert got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[d].fingerprint == order_minhash.values(own).tobytes().hex()
        assert got[d].near_next == order_minhash.likeness(order_minhash.values(own), order_minhash.values(after))
    lone = documents(spark, [(1, "some text")]).unionByName(documents(spark, [(1, "some text")]))
    assert {r.near_next for r in order_minhash.with_next(lone).collect()} == {1.0}
    assert order_minhash.with_next(docs.limit(0)).count() == 0
    nulls = documents(spark, [(None, "x"), (None, "y"), (3, "z")])
    assert order_minhash.with_next(nulls).count() == 3


def test_order_minhash_sees_order():
    rng = random.Random(8)
    w = words(rng, 400, 10_000)
    base = order_minhash.values(" ".join(w))
    swapped = order_minhash.values(" ".join(w[200:] + w[:200]))
    near_ = order_minhash.values(" ".join(w[:390] + ["new"] * 10))
    assert order_minhash.likeness(base, near_) > order_minhash.likeness(base, swapped) + 0.2


# --- piece encoding -----------------------------------------------------------------------


def test_piece_encoding_is_the_librarys(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    path = queries.piece_model()
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(3)
    texts = [None, "", " ", "  a", "a  b\n\nc ", "▁x", "a\tb\r\n", "<s>hi</s>", "\x00a", "ＡＢ ﬁ", "中文 字符", "🙂🙂"]
    texts += [" " * k + "b" for k in range(0, 130, 3)] + [" " * k + "Ａ" for k in range(0, 130, 3)]
    texts += ["".join(rng.choice("ab aab  =-_.\n\teèßnt▁é0the in") for _ in range(50)) for _ in range(400)]
    texts += ["a" * 5000, "abc" * 3000, "word " * 5000]
    docs = documents(spark, texts).withColumn("n_tokens", F.lit("clash"))
    got = by_id(piece_encoding.encode_decode(docs, path))
    for i, t in enumerate(texts):
        ids = sp.encode(t or "")
        assert (got[i].ids, got[i].n_tokens, got[i].decoded) == (ids, len(ids), sp.decode(ids))
    assert piece_encoding.encode_decode(docs.limit(0), path).count() == 0


# --- lines ------------------------------------------------------------------------------------


def test_line_templates(spark):
    rng = random.Random(4)
    common = "All of this page was made by the team in room"
    texts = []
    for k in range(20):
        own = [" ".join(words(rng, 14, 5000)) for _ in range(3)]
        texts.append("\n".join([f"{common} {k * 7}", *own, "", "the end"]))
    texts += [None, "", texts[3], "the end"]
    got = by_id(line_templates.drop_recurring_lines(documents(spark, texts), min_docs=6))
    assert got[0].text == texts[0]  # the first document keeps
    assert got[5].text == "\n".join(texts[5].split("\n")[1:5]) and got[5].n_lines_dropped == 2
    assert got[20].text is None and got[21].text == "" and got[23].n_lines_left == 0
    kept = line_templates.own_lines(documents(spark, texts), min_docs=6)
    assert kept.columns == documents(spark, texts).columns
    assert {r.doc_id for r in kept.collect()} == set(range(24)) - {23}
    assert line_templates.drop_recurring_lines(documents(spark, texts).limit(0)).count() == 0


@pytest.mark.parametrize("holders", [2, 3])
def test_long_line_recurs_in_few_unlike_documents(spark, holders):
    rng = random.Random(21)
    own = lambda k: [" ".join(words(rng, k, 9000)) for _ in range(4)]
    long, edge, short = (" ".join(words(rng, n, 9000)) for n in (60, 20, 5))
    texts = ["\n".join([*own(30), long, edge, short]) for _ in range(holders)]
    alone = "\n".join(own(30))
    edited = " ".join(alone.split(" ")[:-1]) + " other"
    texts += [alone, edited, alone, "\n".join(own(30)), "", None]
    docs = documents(spark, texts)
    got = by_id(line_templates.drop_recurring_lines(docs))
    assert got[0].text == texts[0]  # the smallest doc_id keeps
    for i in range(1, holders):
        assert got[i].text == "\n".join([*texts[i].split("\n")[:4], short])
    # copies and near-copies are whole documents to the next stage
    for i in range(holders, len(texts)):
        assert got[i].text == texts[i]
    left = near.first_of_each(line_templates.own_lines(docs))
    assert {r.doc_id for r in left.collect()} == {*range(holders + 1), *range(holders + 3, len(texts))}


def test_template_leaves_one_stretch_open():
    a = "the job of the day was started at noon by one of the workers".split()
    b, c = a[:], a[:]
    b[5] = "evening"
    c[5], c[12] = "evening", "machines"
    key = lambda t: set(line_templates.template_keys(" ".join(t), 3, 4, 11))
    assert key(a) & key(b) and not key(a) & key(c)


# --- long repeats -----------------------------------------------------------------------------


def repeats(texts):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + 400] for t in raw for i in range(len(t) - 399))
    out = []
    for t in raw:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 399):
            if seen[t[i : i + 400]] > 1:
                gone[i : i + 400] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = bytes(np.frombuffer(t, np.uint8)[~gone]) if t else b""
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("most_windows", [1500, 1])
def test_long_repeats_against_brute_force(spark, monkeypatch, most_windows):
    monkeypatch.setattr(run_length_index, "MOST_WINDOWS", most_windows)
    rng = random.Random(6)
    passage = " ".join(words(rng, 150, 9000))
    texts = [None, "", "x" * 399, "x" * 400, "ab" * 900, "é" * 450]
    for k in range(25):
        own = " ".join(words(rng, 120, 9000))
        cut = rng.randrange(0, 200)
        texts.append(own[:300] + passage[cut : cut + 380 + 5 * k] + own[300:])
    texts += [texts[8], texts[9][:700], texts[9][1:]]
    docs = documents(spark, texts)
    got = by_id(run_length_index.remove_repeats(docs, digests=True))
    assert [tuple(got[i])[1:] for i in range(len(texts))] == repeats(texts)
    texts_kept = by_id(run_length_index.remove_repeats(docs, digests=True, kept_text=True))
    plain = by_id(run_length_index.remove_repeats(docs))
    assert all(texts_kept[i].text == plain[i].kept.decode("utf-8", "replace") for i in plain)
    assert all(hashlib.sha256(plain[i].kept).hexdigest() == got[i].kept_sha256 for i in got)
    assert run_length_index.remove_repeats(docs.limit(0), digests=True).count() == 0


def test_matching_statistics_of_run_length_index():
    rng = random.Random(1)
    for _ in range(60):
        strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 6))]
        index = run_length_index.RunLengthIndex(strings)
        stats = index.matching_statistics()
        places = [(k, i) for k, s in enumerate(strings) for i in range(len(s))]
        for k, i in places:
            best = 0
            for k2, i2 in places:
                n = 0
                while (k, i) != (k2, i2) and strings[k][i : i + n + 1] == strings[k2][i2 : i2 + n + 1] and (
                    max(i + n, 0) < len(strings[k]) and i2 + n < len(strings[k2])
                ):
                    n += 1
                best = max(best, n)
            assert stats[index.begin[k] + i] == best


# --- near duplicates ------------------------------------------------------------------------------


def shingle_set(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


@pytest.mark.parametrize("block", [1024, 16])
def test_near_duplicates_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near, "BLOCK", block)
    rng = random.Random(9)
    texts = [None, "", "  \n", "one two", "ONE two", "one\ttwo three", "Ünı\u00a0x y z v w"]
    base = words(rng, 150)
    for _ in range(120):  # a large group whose members are often not linked with each other
        copy = base[:]
        for _ in range(rng.randint(1, 8)):
            copy[rng.randrange(150)] = "new%d" % rng.randrange(10**6)
        texts.append(" ".join(copy))
    texts += [" ".join(words(rng, 60, 5000)) for _ in range(40)]
    texts += [texts[20], texts[21].upper(), texts[22] + " more"]
    sets = [shingle_set(t) for t in texts]
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
            a, b = sorted((root(i), root(j)))
            label[b] = a
    got = by_id(near.near_duplicates(documents(spark, texts).withColumn("node", F.lit(1))))
    for i in range(len(texts)):
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(sets[i]), root(i), root(i) == i)
    kept = near.first_of_each(documents(spark, texts))
    assert {r.doc_id for r in kept.collect()} == {i for i in range(len(texts)) if root(i) == i}


def test_near_duplicates_of_nothing(spark):
    assert near.near_duplicates(documents(spark, []).limit(0)).count() == 0
    two = documents(spark, [(None, "a b c d e f"), (None, "a b c d e f"), (4, "")])
    assert {(r.doc_id, r.component_id, r.kept) for r in near.near_duplicates(two).collect()} == {
        (None, None, True), (4, 4, True)
    }


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(50, 40), (60, 60)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert got == {**dict.fromkeys(range(21), 0), 40: 40, 50: 40}


# --- licences --------------------------------------------------------------------------------------


def test_license_scan(spark):
    texts = [
        "Some text.\nReleased under the MIT License.", "Licensed under the Apache License, Version 2.0.",
        None, "", "der Hund geht mit der Katze", "Licensed under CC BY-NC 4.0.\nAll rights reserved.",
        "the the the the", "x " * 20_000, "Released under the MIT License.",
    ]
    got = {(r.doc_id, r.line_no): (r.family, r.confirmed) for r in license_scan.scan(documents(spark, texts)).collect()}
    assert got == {
        (0, 2): ("mit", True), (1, 1): ("apache", True), (5, 1): ("cc-by-nc", True),
        (5, 2): ("proprietary", True), (8, 1): ("mit", True),
    }
    plan = license_scan.scan(documents(spark, texts))._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapIn" not in plan
    assert license_scan.scan(documents(spark, texts).limit(0)).count() == 0


def test_license_training_holds_out():
    families, weights, bias, heat = license_scan.trained()
    for family, notices in license_scan.NOTICES.items():
        for text in notices:
            p = license_scan._probabilities(weights, bias, license_scan.features(text), heat)
            assert families[p.index(max(p))] == family


# --- quality -----------------------------------------------------------------------------------------


def direct_losses(texts, size, order, alphabet):
    """Interpolated modified Kneser-Ney by its definition."""
    table = {c: i + 1 for i, c in enumerate(alphabet)}
    symbols = lambda t: [0] * (order - 1) + [table.get(ord(c), 0) for c in t]
    counts = Counter()
    for t in texts:
        s = symbols(t)
        counts.update(tuple(s[i : i + order]) for i in range(len(s) - order + 1))
    levels = [counts]
    for _ in range(order - 1):
        levels.insert(0, Counter(g[1:] for g in levels[0]))
    off = []
    for c in levels:
        n = Counter(c.values())
        off.append(ngram_quality.discounts(n[1], n[2], n[3], n[4]))

    def p(gram):
        if not gram:
            return 1 / size
        c, d = levels[len(gram) - 1], off[len(gram) - 1]
        row = {w: n for w, n in ((g[-1], n) for g, n in c.items() if g[:-1] == gram[:-1])}
        if not row:
            return p(gram[1:])
        take = sum(d[min(n, 3) - 1] for n in row.values())
        own = row.get(gram[-1], 0)
        return (own - (d[min(own, 3) - 1] if own else 0) + take * p(gram[1:])) / sum(row.values())

    return lambda t: [-np.log(p(tuple(symbols(t)[i : i + order]))) for i in range(len(t))]


def test_kneser_ney_by_definition(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice("aaab bc.") for _ in range(60)) for _ in range(8)]
    trusted = spark.createDataFrame([(t,) for t in texts], "text string")
    model = ngram_quality.train(trusted, size=5, order=3)
    direct = direct_losses(texts, 5, 3, model.alphabet)
    table = ngram_quality.lookup_table(model.alphabet)
    for t in [texts[0], "cab?", "zzz"]:
        assert model.loss(t, table) == pytest.approx(sum(direct(t)), rel=1e-5)
    total = np.exp(-model.losses.astype(float)).reshape(-1, 5).sum(axis=1)
    assert total == pytest.approx(np.ones(25), rel=1e-4)


def direct_word_loss(trusted, spelling, text):
    """Nats a character of an interpolated modified Kneser-Ney model of pairs, by definition."""
    table = ngram_quality.lookup_table(spelling.alphabet)

    def p0(word):
        line = f"  {word} "
        grams = ngram_quality.ngrams(line, table, spelling.size, spelling.order)
        return np.exp(-spelling.losses[grams][2:].astype(float).sum())

    def pairs_of(t):
        tokens = ["<s>", *t.lower().split(), ""]
        return list(zip(tokens, tokens[1:]))

    def off_of(counts):
        n = Counter(counts.values())
        return ngram_quality.discounts(n[1], n[2], n[3], n[4])

    pairs = Counter(g for t in trusted for g in pairs_of(t))
    ends = Counter(w for _, w in pairs)
    off2, off1 = off_of(pairs), off_of(ends)

    def share(row, off, word, lower):
        taken = sum(off[min(n, 3) - 1] for n in row.values())
        own = row.get(word, 0)
        return (own - (off[min(own, 3) - 1] if own else 0) + taken * lower) / sum(row.values())

    def p(before, word):
        single = share(ends, off1, word, p0(word))
        row = {w: n for (h, w), n in pairs.items() if h == before}
        return share(row, off2, word, single) if row else single

    return -sum(np.log(p(h, w)) for h, w in pairs_of(text)) / sum(len(w) + 1 for _, w in pairs_of(text))


@pytest.mark.parametrize("head", [0, 20, 1 << 20])
def test_word_model_by_definition(spark, head, monkeypatch):
    # small shards and blocks, and words that are not sent to all tasks
    monkeypatch.setattr(ngram_quality, "SHARD_VALUES", 40)
    rng = random.Random(11)
    trusted = [" ".join(words(rng, 40, 25)) for _ in range(12)]
    texts = [trusted[0], "w1 w2 new w1 w3", "Other words\nthere", "w1", trusted[0], "", " \t "]
    rows = spark.createDataFrame([(i % 2, t) for i, t in enumerate(trusted)], "half bigint, text string")
    spelling = ngram_quality.train(rows.select(ngram_quality.spelled().alias("text")), 12, 3)
    values, rest = ngram_quality.word_values(rows, spelling, most=head)
    keyed = spark.createDataFrame([(hash(t), t) for t in texts], "key bigint, text string")
    got = {r.key: r for r in ngram_quality.text_losses(keyed, values, rest, spelling, head, 40).collect()}
    assert set(got) == {hash(t) for t in texts[:4]}
    for t in texts[:4]:
        assert got[hash(t)].whole == pytest.approx(direct_word_loss(trusted, spelling, t), rel=1e-5)
        assert got[hash(t)].half1 == pytest.approx(direct_word_loss(trusted[1::2], spelling, t), rel=1e-5)
        assert got[hash(t)].half0 == pytest.approx(direct_word_loss(trusted[::2], spelling, t), rel=1e-5)


def test_word_model_is_stored_in_few_bytes(spark):
    rng = random.Random(13)
    # some words are frequent, as in real text
    trusted = [" ".join(f"w{int(rng.paretovariate(0.6)) % 5000}" for _ in range(2000)) for _ in range(40)]
    rows = spark.createDataFrame([(i % 2, t) for i, t in enumerate(trusted)], "half bigint, text string")
    spelling = ngram_quality.train(rows.select(ngram_quality.spelled().alias("text")))
    shelf = ngram_quality.Shelf(spark)
    ngram_quality.word_values(rows, spelling, shelf)
    pairs = {g for t in trusted for g in zip(t.split(), t.split()[1:])}
    stored = [
        os.path.getsize(os.path.join(at, f))
        for path in shelf.paths.values()
        for at, _, files in os.walk(path)
        for f in files
        if f.endswith(".parquet")
    ]
    assert 0 < sum(stored) < 8 * len(pairs)


def test_texts_are_scored_in_turns_with_equal_results(spark, monkeypatch):
    rng = random.Random(17)
    docs = documents(spark, [" ".join(words(rng, 30, 60)) for _ in range(40)] + [None, "", "new words only"])
    docs = docs.union(docs.limit(9))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(25)], "doc_id bigint, quality int, toxic int")
    got = []
    for turns in (1, 4):
        monkeypatch.setattr(ngram_quality, "TURNS", turns)
        rows = ngram_quality.judge(docs, labels).select("doc_id", "perplexity", "threshold", "kept").collect()
        got.append(sorted((r.doc_id, r.kept, round(r.perplexity or 0, 4), round(r.threshold, 6)) for r in rows))
    assert got[0] == got[1] and len(got[0]) == 52


def test_quality_keeps_clean_text(spark):
    rng = random.Random(3)
    clean = [" ".join(words(rng, 50)) + "." for _ in range(60)]
    junk = ["".join(rng.choice("#%&|@$!") for _ in range(200)) for _ in range(10)]
    docs = documents(spark, clean + junk + [None, ""]).withColumn("kept", F.lit("clash"))
    labels = spark.createDataFrame(
        [(i, 1, None) for i in range(40)] + [(60, 0, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int"
    )
    got = by_id(ngram_quality.judge(docs, labels))
    assert sum(got[i].kept for i in range(60)) >= 57 and not any(got[i].kept for i in range(60, 70))
    assert got[70].kept and got[70].perplexity is None and got[71].kept
    assert all(r.kept for r in ngram_quality.judge(docs, labels.limit(0)).collect())
    assert ngram_quality.judge(docs.limit(0), labels).count() == 0
    held_out = [(got[i].kept, i) for i in range(40, 60)]
    assert sum(k for k, _ in held_out) >= 18


def test_quality_in_a_minority_script(spark):
    rng = random.Random(31)
    latin = "".join(map(chr, [*range(97, 123), *range(0xE0, 0x180)]))  # over 95 characters
    many = [" ".join("".join(rng.choice(latin) for _ in range(6)) for _ in range(150)) for _ in range(60)]
    syllables = ["\u043c\u0430", "\u0440\u043e", "\u043d\u0438", "\u0442\u0435", "\u043b\u0443"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(3))
    clean = [" ".join(word() for _ in range(40)) for _ in range(30)]
    letters = [chr(c) for c in range(0x0436, 0x0450)]
    junk = [" ".join("".join(rng.choice(letters) for _ in range(6)) for _ in range(40)) for _ in range(10)]
    # no blanks: each text is one unknown word
    common = [chr(0x4E00 + k) for k in range(12)]
    han = ["".join(rng.choices(common, range(12, 0, -1), k=400)) for _ in range(30)]
    noise = ["".join(chr(0x6000 + rng.randrange(0x3000)) for _ in range(120)) for _ in range(10)]
    texts = many + clean + junk + han + noise
    langs = ["xx"] * 60 + ["ru"] * 40 + ["zh"] * 40
    docs = spark.createDataFrame(
        [(i, t, lang) for i, (t, lang) in enumerate(zip(texts, langs, strict=True))],
        "doc_id bigint, text string, lang string",
    )
    trusted = [*range(60), *range(60, 85), *range(100, 125)]
    labels = spark.createDataFrame([(i, 1, 0) for i in trusted], "doc_id bigint, quality int, toxic int")
    # each language by its own quantile
    got = by_id(ngram_quality.judge(docs, labels, quantile=0.95))
    assert sum(got[i].kept for i in [*range(85, 90), *range(125, 130)]) >= 7
    assert not any(got[i].kept for i in [*range(90, 100), *range(130, 140)])


def test_quality_judges_by_models_that_have_not_read_the_text(spark):
    rng = random.Random(41)
    docs = documents(spark, [" ".join(words(rng, 30, 200)) for _ in range(24)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id bigint, quality int, toxic int")
    rows = docs.withColumn("key", F.xxhash64("text")).withColumn("half", F.pmod("key", F.lit(2)))
    trusted = rows.where("doc_id < 20")
    spelling = ngram_quality.train(trusted.select(ngram_quality.spelled().alias("text")))
    values, rest = ngram_quality.word_values(trusted.select("half", "text"), spelling)
    losses = {r.key: r for r in ngram_quality.text_losses(rows, values, rest, spelling).collect()}
    got = by_id(ngram_quality.judge(docs, labels))
    for r in rows.collect():
        own = losses[r.key]
        fair = (own.half0 + own.half1) / 2 if r.doc_id >= 20 else own.half0 if r.half else own.half1
        assert np.log(got[r.doc_id].perplexity) == pytest.approx(fair, rel=1e-6)


def test_byte_model_adds_up(spark):
    trusted = spark.createDataFrame([("ab \u0436\u4e00\x00",), ("abc",)], "text string")
    model = ngram_quality.train(trusted)
    table = ngram_quality.lookup_table(None)
    contexts = ngram_quality.ngrams("ab \u0436\u4e00zz", table, 256, 3) // 256
    each = (contexts[:, None] * 256 + np.arange(256)).astype(np.int32)
    assert np.exp(-model.losses[each].astype(float)).sum(axis=1) == pytest.approx(np.ones(len(each)), rel=1e-4)


# --- pipeline ----------------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "lines", "near_duplicates", "decontamination", "encoding"]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.stored(stage(spark, before, SMALL), name)
        assert after.columns == docs.columns
        assert 0 < after.count() <= before.count()
        before = after
    encoded = corpus_pipeline.STAGES[-1][1](spark, before, SMALL)
    assert encoded.count() == before.count()


def test_every_operator_is_registered():
    numbers = {int(name[2:].split("_")[0]) for name in queries.QUERIES}
    assert numbers == set(range(1, 11))
