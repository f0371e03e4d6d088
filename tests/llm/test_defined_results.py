"""Nulls, large ids, ties, repeats, empty tables, long texts and clashing names: the results that the docstrings define."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillstone.llm import bpe, chat, fingerprints, html, langid, licenses, media, mixing, simhash, tokencount

LARGE = 2**60 + 1
CLASH = "doc_id long, text string, lang string, source string, n_chars long, lid string, size long, fp string, license string"
ROWS = [
    (LARGE, "one two three four five", "en", "s0", 1, "x", 1, "x", "x"), (None, "a null id", None, None, None, None, None, None, None), (LARGE, "one two three four five", "en", "s0", 1, "x", 1, "x", "x"),
    (3, None, "en", None, None, None, None, None, None), (4, "", None, "s1", 0, "x", 0, "x", "x"), (5, "wide " * 40_000, "de", "s1", 200_000, "x", 0, "x", "x"), (6, "x" * 300_000, "de", "s1", 300_000, "x", 0, "x", "x"), (-1, " \t\n", "en", "", 3, "x", 0, "x", "x"),
]
BY_ROW = {
    "op1": lambda d: tokencount.count_edits(d, tokencount.standard_edits()), "op2": simhash.near_duplicates, "op4": bpe.encode_digests, "op4 ids": bpe.encode, "op6": fingerprints.fingerprint_edits, "op7": licenses.scan,
    "op8": mixing.mix, "op9": media.media_digests, "op9 files": media.encode_texts, "op10": lambda d: langid.predict(d, langid.fit(d), "doc_id"),
}


@pytest.mark.parametrize("name", BY_ROW)
def test_ids_nulls_and_repeats(spark, name):
    docs = spark.createDataFrame(ROWS, CLASH).coalesce(1)
    out = BY_ROW[name](docs)
    rows = out.collect()
    ids = sorted((r[0] for r in rows), key=lambda i: (i is None, i))
    assert ids == sorted((r[0] for r in ROWS), key=lambda i: (i is None, i))
    twice = [tuple(map(str, r)) for r in rows if r[0] == LARGE]
    assert len(twice) == 2 and (twice[0] == twice[1] or name == "op6")
    assert BY_ROW[name](docs.where("false")).collect() == []
    assert BY_ROW[name](docs.select("lang", "text", "source", "doc_id")).columns == out.columns


def test_page_ids(spark):
    pages = spark.createDataFrame([(LARGE, "http://a.example/", "<p>one</p>"), (None, None, None), (LARGE, "http://a.example/", "<p>one</p>")], "page_id long, url string, html string").coalesce(1)
    rows = html.extract_pages(pages.withColumn("host", F.lit("clash"))).collect()
    assert sorted((str(r["page_id"]), r["text"]) for r in rows) == [(str(LARGE), "one")] * 2 + [("None", "")]


def test_votes_of_equal_number_go_by_their_hash(spark):
    page = lambda c: f"<body><div class={c}>The same words in either.</div></body>"
    pages = spark.createDataFrame([(i, "http://a.example/", page("ab"[i % 2])) for i in range(8)], "page_id long, url string, html string")
    paths = [p["path"] for p in html.host_paths(pages).first()["paths"]]
    assert paths == sorted(paths) and len(paths) == 2


def test_chat_packs_of_one_null_id_and_of_none(spark):
    turns = spark.createDataFrame([(None, None, None, None, "x")], "conv_id long, turn long, role string, text string, ids string")
    (r,) = chat.read_back(chat.pack(turns)).collect()
    assert (r["conv_id"], r["n_turns"], r["loss_chars"], r["formatted_chars"]) == (None, 1, 0, 14)


def test_pipeline_through_run_on_odd_tables(spark, tmp_path):
    docs = spark.createDataFrame([r[:5] for r in ROWS] + [(100 + i, "the cat and the dog of the house sleep " * 3 + str(i), "en", "s0", 9) for i in range(30)], "doc_id long, text string, lang string, source string, n_chars long")
    for name, table in (("odd", docs), ("empty", docs.where("false")), ("clash", docs.withColumns({"size": F.lit(1), "fp": F.lit("x"), "mix_key": F.lit(2)}))):
        table.write.parquet(str(tmp_path / name / "documents.parquet"))
        rows = corpus_pipeline.run(spark, str(tmp_path / name)).collect()
        assert set(rows[0].asDict()) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} if rows else name == "empty"
        assert {r["doc_id"] for r in rows} <= {r[0] for r in ROWS} | set(range(100, 130))


def brute_model(rows, dimensions):
    """FTRL-proximal with elastic net, feature by feature, in plain Python; weights of (column, class) and of the bias."""
    classes = sorted({r[0] for r in rows})
    seen = {}
    for _, columns, _, _ in rows:
        for c in columns.tolist():
            seen[c] = seen.get(c, 0) + 1
    z, n = {}, {}

    def weight(key):
        if abs(z.get(key, 0.0)) <= langid.L1:
            return 0.0
        return -(z[key] - np.sign(z[key]) * langid.L1) / ((langid.BETA + np.sqrt(n[key])) / langid.ALPHA + langid.L2)

    for _ in range(langid.EPOCHS):
        for at, (y, columns, values, _) in enumerate(rows):
            if at % langid.CALIBRATE_EVERY == 0:
                continue
            x = {c: float(v) * (np.log((1 + len(rows)) / (1 + seen[c])) + 1) for c, v in zip(columns.tolist(), values.tolist())} | {dimensions: 1.0}
            w = {(c, k): weight((c, k)) for c in x for k in range(len(classes))}
            scores = [sum(x[c] * w[c, k] for c in x) for k in range(len(classes))]
            e = np.exp(np.array(scores) - max(scores))
            p = e / e.sum()
            for k, name in enumerate(classes):
                for c, v in x.items():
                    g = v * (p[k] - (name == y))
                    old = n.get((c, k), 0.0)
                    z[c, k] = z.get((c, k), 0.0) + g - (np.sqrt(old + g * g) - np.sqrt(old)) / langid.ALPHA * w[c, k]
                    n[c, k] = old + g * g
    return classes, {key: weight(key) for key in z}, seen


def test_training_and_scores_equal_a_plain_version():
    rnd = np.random.default_rng(2)
    vocabulary = {"a": "the cat and dog of house", "b": "der hund und die katze haus", "c": "le chat et le chien maison"}
    texts = [(k, " ".join(rnd.choice(v.split(), 6))) for _ in range(12) for k, v in vocabulary.items()]
    rows = [(k, *langid.sparse_counts(t), len(t) + 2) for k, t in texts]
    model = langid.train(rows)
    classes, weights, seen = brute_model(rows, langid.DIMENSIONS)
    assert model.languages == classes
    for (c, k), w in weights.items():
        idf = np.log((1 + len(rows)) / (1 + seen[c])) + 1 if c != langid.DIMENSIONS else 1
        assert abs((model.bias[k] if c == langid.DIMENSIONS else model.weights[k][c]) - w * idf) < 1e-4
    names, scores = model.predict([t for _, t in texts] + [None, "12 \U0001f600 !!"])
    for (_, text), name, score in zip(texts, names, scores):
        columns, values = langid.sparse_counts(text)
        z = np.array([model.bias[k] + sum(float(v) * model.weights[k][c] for c, v in zip(columns, values)) for k in range(3)]) / model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert name == classes[int(p.argmax())] and abs(score - p.max()) < 1e-3
    assert names[-2:] == ["und", "und"]
    held = [r for i, r in enumerate(rows) if i % langid.CALIBRATE_EVERY == 0]
    logits = np.array([[model.bias[k] + sum(float(v) * model.weights[k][c] for c, v in zip(r[1], r[2])) for k in range(3)] for r in held])

    def loss(t):
        p = np.exp(logits / t - (logits / t).max(1, keepdims=True))
        return -np.log(np.maximum((p / p.sum(1, keepdims=True))[np.arange(len(held)), [classes.index(r[0]) for r in held]], 1e-12)).mean()

    assert loss(model.temperature) <= min(loss(np.exp(t)) for t in np.arange(-8, 4, 0.05)) + 1e-6


def test_code_points_beyond_the_basic_plane():
    points, _ = langid._points(["a\U0001f600b\U00010400"])
    assert "".join(map(chr, points)) == " a b\U00010428 "


def test_frequencies_cover_all_training_documents(spark):
    texts = ["ab", "abc", None, "12", "b"]
    seen, n = langid.document_frequencies(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    want = np.zeros(langid.DIMENSIONS, int)
    for t in ("ab", "abc", "b"):
        want[langid.sparse_counts(t)[0]] += 1
    assert n == 3 and np.array_equal(seen, want)


def test_the_sample_is_bounded(spark):
    rows = [(i, "some words " * 30 + str(i), "en" if i % 2 else "de") for i in range(400)] + [(1, f"the same id {i}", "en") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = langid.training_rows(docs, per_lang=50, all_rows=60)
    assert 20 <= len(found) <= 80 and {r[0] for r in found} == {"en", "de"}
    few = langid.training_rows(docs, per_lang=50, all_pairs=6000)
    assert len(few) < 20 and {r[0] for r in few} == {"en", "de"}


def test_ties_between_sources_and_keys(spark):
    docs = spark.createDataFrame([(i, "same words here", "s%d" % (i % 2)) for i in range(40)] + [(None, "same words here", "s0")] * 3, "doc_id long, text string, source string")
    first, again = (sorted(map(tuple, mixing.mix(docs.repartition(n)).select("doc_id", "taken").fillna(-5).collect())) for n in (1, 5))
    assert first == again and sum(t for _, t in first) <= 3 * 43 * 3


def test_one_very_long_word(spark):
    docs = spark.createDataFrame([(1, "ab" * 400_000), (2, "ab" * 400_000 + " c")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in bpe.encode_digests(docs).collect()}
    assert rows[2]["n_tokens"] == rows[1]["n_tokens"] + 1
