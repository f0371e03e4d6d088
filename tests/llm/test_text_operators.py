"""Token counts, BPE, SimHash and fingerprints against brute force."""

import hashlib
import random
import unicodedata

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillstone.llm import bpe, fingerprints, simhash, tokencount

DOCS = "doc_id long, text string, extra string, word string, fp string"
LONG = "the quick brown fox jumps over it again and " * 4000
ODD = ["", None, " ", "A", "a<|endoftext|>B <|startoftext|>", "don't İstanbul ΑΣ ΑΣΑ \x1c x\x1dy 12 ½ ٣ é é", "'S 'RE I'LL z\x85w", "中文 \U0001f600!!", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", LONG]


def documents(spark, texts=ODD):
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in enumerate(texts)] + [(1, texts[1], "x", "y", "z"), (None, "null id", None, None, None)], DOCS)


def test_bpe_equals_the_library(spark):
    library = Tokenizer.from_file(bpe.default_path())
    for words in (5, 1000):
        got = bpe.encode_digests(documents(spark), lexicon_words=words).collect()
        assert len(got) == len(ODD) + 2
        for r in got:
            text = "null id" if r["doc_id"] is None else ODD[r["doc_id"]] or ""
            want = library.encode(text, add_special_tokens=False).ids
            assert r["n_tokens"] == len(want)
            assert r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
            assert r["decoded_sha256"] == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_bpe_of_any_text(text):
    library = test_bpe_of_any_text.__dict__.setdefault("library", Tokenizer.from_file(bpe.default_path()))
    if any(unicodedata.category(c) == "Cn" for c in text):
        return  # code points of newer Unicode versions than the libraries share
    own = bpe.Encoder(bpe.tokenizer(bpe.default_path()), None).encode([text])[0]
    assert np.frombuffer(own, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_automaton_is_minimal_and_numbers_its_words(tmp_path):
    rnd = random.Random(1)
    words = sorted({"".join(rnd.choice("abcé") for _ in range(rnd.randrange(1, 7))) for _ in range(500)})
    entries = {w: np.array([i, i + 1], "<u4").tobytes() for i, w in enumerate(words)}
    (tmp_path / "l").write_bytes(bpe.Lexicon.compile(entries))
    lexicon = bpe.Lexicon(str(tmp_path / "l"))
    assert lexicon.lookup(words) == [entries[w] for w in words]
    assert lexicon.lookup(["", "zz", "a" * 30, words[0] + "~"]) == [None] * 4
    arcs, final = bpe.minimal_automaton([b"tap", b"taps", b"top", b"tops"])
    alive, stack = {0}, [0]
    while stack:
        for t in arcs[stack.pop()].values():
            if t not in alive:
                alive.add(t)
                stack.append(t)
    assert len(alive) == 5  # start, t, ta = to, tap = top, taps = tops
    (tmp_path / "e").write_bytes(bpe.Lexicon.compile({}))
    assert bpe.Lexicon(str(tmp_path / "e")).lookup(["a"]) == [None]


@pytest.mark.parametrize("operator", [lambda d: bpe.encode_digests(d), lambda d: simhash.near_duplicates(d), lambda d: fingerprints.fingerprint_edits(d), lambda d: tokencount.count_edits(d, tokencount.standard_edits()), lambda d: simhash.keep_one(d)])
def test_empty_tables(spark, operator):
    assert operator(spark.createDataFrame([], DOCS)).count() == 0


def test_edit_counts_equal_a_full_recount(spark):
    counts = tokencount.counter(tokencount.default_path(), tokencount.default_pattern())
    rnd, parts = random.Random(5), ["a", "b", "'", " ", "  ", "\n", "s", "re", "1", "é", "!", "'ll", "\t", "中", "don't", " word"]
    for _ in range(250):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randrange(0, 400)))
        tree = tokencount.TokenTree(text, counts)
        for _ in range(5):
            a = rnd.randrange(0, len(text) + 3)
            b, new = a + rnd.choice([0, 0, 1, 2, 5, 30]), "".join(rnd.choice(parts) for _ in range(rnd.choice([0, 1, 2, 5, 40, 600])))
            tree.edit(a, b, new)
            low = min(a, len(text))
            text = text[:low] + new + text[max(min(b, len(text)), low) :]
            assert tree.text() == text and tree.n_tokens == len(counts.encoding.encode_ordinary(text)) and tree.n_chars == len(text)
    got = tokencount.count_edits(documents(spark), tokencount.standard_edits()).collect()
    for r in got:
        text = "null id" if r["doc_id"] is None else ODD[r["doc_id"]] or ""
        assert r["n_tokens"] == len(counts.encoding.encode_ordinary(text))
        n = len(text)
        edited = text[: n // 2] + text[:24] + text[n // 2 + 40 :]
        edited = edited[: n // 4] + edited[n // 4 + 7 :] + " It's the end."
        assert (r["edited_tokens"], r["edited_chars"]) == (len(counts.encoding.encode_ordinary(edited)), len(edited))
    assert [r["recounted_chars"] for r in got if r["doc_id"] == 9][0] < 2000


def brute_fingerprint(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) > 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT_VARIANTS", 2000)
    monkeypatch.setattr(simhash, "CELL_VARIANTS", 1000)
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    base = [[rnd.choice(words) for _ in range(120)] for _ in range(12)]
    texts = [*ODD[:9]]
    for b in base:
        texts += [" ".join(b)] * 2
        for _ in range(6):
            c = list(b)
            for _ in range(rnd.randrange(1, 4)):
                c[rnd.randrange(len(c))] = rnd.choice(words)
            texts.append(" ".join(c))
    got = simhash.near_duplicates(documents(spark, texts)).collect()
    rows = [(r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got]
    for d, fp, _ in rows:
        assert fp == brute_fingerprint("null id" if d is None else texts[d])
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 4:
                parent[root(i)] = root(j)
    for i, r in enumerate(rows):
        ids = [q[0] for j, q in enumerate(rows) if root(j) == root(i) and q[0] is not None]
        assert r[2] == (min(ids) if ids else None)
    kept = simhash.keep_one(documents(spark, texts))
    assert kept.columns == DOCS.replace(" long", "").replace(" string", "").split(", ")
    assert sorted(r["doc_id"] for r in kept.where(F.col("doc_id").isNotNull()).collect()) == sorted({r[2] for r in rows if r[2] is not None})


def test_routes_and_dealing_cover_every_variant():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**64, 12, dtype=np.uint64)
    fp = np.unique(np.concatenate([base, *[b ^ (np.uint64(1) << rng.integers(0, 64, 20).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 20).astype(np.uint64)) for b in base[:5]]]))

    def groups(pairs):
        parent = {x: x for x in fp.tolist()}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in pairs:
            parent[root(a)] = root(b)
        return {frozenset(y for y in parent if root(y) == root(x)) for x in parent}

    want = groups((int(a), int(b)) for i, a in enumerate(fp) for b in fp[i + 1 :] if int(a ^ b).bit_count() <= 4)
    for prefix, bits in ((8, 0), (8, 3), (5, 5)):
        masks, used = simhash.flips(prefix, 2)
        cells = {}
        for f in fp:
            for m, u in zip(masks, used):
                cells.setdefault(int((f >> np.uint64(64 - prefix)) ^ m), []).append((f, 2 - u))
        found = []
        for cell, rows in cells.items():
            for parity in range(1 << bits):
                got = simhash.link_cell(np.array([x for x, _ in rows], np.uint64).view(np.int64), np.array([b for _, b in rows]), cell, prefix, bits, parity)
                assert len(got) <= len(rows)
                found += [(int(np.int64(a).view(np.uint64)), int(np.int64(b).view(np.uint64))) for a, b in got]
        assert groups(found) == want


def brute_lanes(text):
    """Signed sums of the bits of the trigram hashes of all lines."""

    def hashed(*words):
        seed = 42
        for w in words:
            seed = xxhash.xxh64_intdigest(w.encode(), seed=seed)
        return seed

    hashes = []
    for line in (text or "").split("\n"):
        if line:
            words = line.split(" ")
            hashes += [hashed(*words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [hashed(" ".join(words), "short")]
    bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64) if hashes else np.zeros(64, np.int64)
    return 2 * bits - len(hashes)


def brute_likeness(a, b):
    if sorted(p for p in a.split("\n") if p) == sorted(p for p in b.split("\n") if p):
        return 1.0
    x, y = brute_lanes(a), brute_lanes(b)
    norm = float(np.sqrt(float(x @ x) * float(y @ y)))
    return min(1.0, max(0.0, float(x @ y) / norm)) if norm else 0.0


def test_likeness_equals_brute_force(spark):
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(30)]
    line = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    texts = ["\n".join(line(rnd.randrange(1, 9)) for _ in range(rnd.randrange(1, 12))) for _ in range(25)]
    texts += ["", "a b c\n" * 45_000 + "tail of another kind", "a b c\n" * 41_000, "one  two\n\n three", texts[0]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_edits(docs).collect()}
    for i, text in enumerate(texts):
        following, moved = texts[(i + 1) % len(texts)], len(text) // 4
        edited = text[: len(text) - moved] + following[:moved]
        assert abs(got[i]["near_edited"] - brute_likeness(text, edited)) < 1e-9 and abs(got[i]["near_next"] - brute_likeness(text, following)) < 1e-9, i


def test_hot_and_null_ids_are_spread(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "SPAN_ROWS", 20)
    rows = [(None, f"null {i}") for i in range(200)] + [(7, f"seven {i}") for i in range(200)] + [(i, f"own {i}") for i in range(8, 208)] + [(2**60 + 1, "large")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ids = docs.select(F.coalesce("doc_id", F.lit(fingerprints._NULL_ID)).alias("id"), F.shiftrightunsigned(F.xxhash64("text"), 1).alias("tie"))
    spans = ids.withColumn("span", fingerprints.spans_of(ids)).collect()
    sizes = {}
    for r in spans:
        sizes[r["span"]] = sizes.get(r["span"], 0) + 1
    assert max(sizes.values()) <= 80 and len(sizes) > 15
    order = sorted(spans, key=lambda r: (r["id"], r["tie"]))
    assert [r["span"] for r in order] == sorted(r["span"] for r in spans)
    tie = lambda t: xxhash.xxh64_intdigest(t.encode(), seed=42) >> 1
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, tie(r[1])))
    want = {r: hashlib.sha256((r[1][: len(r[1]) - len(r[1]) // 4] + rows[(i + 1) % len(rows)][1][: len(r[1]) // 4]).encode()).hexdigest() for i, r in enumerate(rows)}
    got = fingerprints.fingerprint_edits(docs).select("doc_id", "edited_sha256").collect()
    assert sorted((str(r["doc_id"]), r["edited_sha256"]) for r in got) == sorted((str(d), h) for (d, _), h in want.items())


def test_hot_keys_join_alike(spark, monkeypatch):
    from quillstone.llm import common

    many = spark.range(3000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v")).union(spark.range(4000).select(F.lit(3).alias("k"), F.col("id").alias("v")))
    one = many.groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("top")).where("k <> 5")
    want = sorted(map(tuple, many.join(one, "k").collect()))
    assert sorted(map(tuple, common.hot_join(many, one, "k", "n", 8).collect())) == want
    for limit in (64, 40):
        monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
        monkeypatch.setattr(common, "WHOLE_BYTES", limit)
        for hot in (1000, 10, 10**6):
            assert sorted(map(tuple, common.hot_join(many, one, "k", "n", 16, 100, hot).collect())) == want


def test_components_of_hubs_and_chains(spark, monkeypatch):
    from quillstone.llm import common

    rnd = random.Random(4)
    edges = [(0, i) for i in range(1, 60)] + [(i, i + 1) for i in range(100, 140)] + [(300 - i, 300) for i in range(1, 30)] + [(rnd.randrange(400, 500), rnd.randrange(400, 500)) for _ in range(60)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    frame = spark.createDataFrame(edges, "a long, b long")
    want = {(x, root(x)) for x in parent if root(x) != x}
    assert {tuple(r) for r in simhash.components(frame).collect()} == want
    for module in (common, simhash):
        monkeypatch.setattr(module, "HOT_ROWS", 10)
    monkeypatch.setattr(common, "BROADCAST_BYTES", 2000)
    monkeypatch.setattr(common, "WHOLE_BYTES", 2000)
    monkeypatch.setattr(common.hot_join, "__defaults__", (None, 10))
    assert {tuple(r) for r in simhash.components(frame).collect()} == want


def test_likeness_of_long_repetitive_texts(spark):
    docs = spark.createDataFrame([(0, "a b c\n" * 40_000), (1, "p q r\n" * 10), (2, "a b c\n" * 20_000)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_edits(docs).collect()}
    assert got[0]["near_edited"] > 0.99 and got[2]["near_next"] > 0.99 and got[2]["near_edited"] > 0.99


def test_fingerprints_are_homomorphic(spark):
    texts = ["a b c d\ne f g h\ni j k l", "i j k l\na b c d\ne f g h", "a b c d\ne f g h", "", None, "x", "p q r s t\n" * 40 + "tail of it", LONG]
    docs = spark.createDataFrame([(10 * i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, "last")], "doc_id long, text string")
    got = {(r["doc_id"], r["fingerprint"], r["n_chars"]): r for r in fingerprints.fingerprint_edits(docs).collect()}
    by = {r["doc_id"]: r for r in got.values()}
    assert by[0]["fingerprint"] == by[10]["fingerprint"] != by[20]["fingerprint"] and by[30]["fingerprint"] == by[40]["fingerprint"]
    order = [texts[0], *texts, "last"]
    ids = [0, *[10 * i for i in range(len(texts))], None]
    direct = {r["k"]: r["fingerprint"] for r in fingerprints.fingerprint_texts(spark.createDataFrame([(i, (order[i] or "")[: len(order[i] or "") - len(order[i] or "") // 4] + (order[(i + 1) % len(order)] or "")[: len(order[i] or "") // 4]) for i in range(len(order))], "k int, text string"), "k").collect()}
    for i in range(1, len(order)):
        text, following = order[i] or "", order[(i + 1) % len(order)] or ""
        q = len(text) // 4
        r = by[ids[i]]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256((text[: len(text) - q] + following[:q]).encode()).hexdigest()
        assert r["edited_fingerprint"] == direct[i], i
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert by[60]["near_edited"] > 0.5 > by[60]["near_next"]
    assert by[0]["near_next"] == 1.0  # its repeat, or the text of the same paragraphs, follows
