"""Streaming, forest, serving, rules and the register of queries."""

import numpy as np
import pytest

import __spark_entry__ as queries
from quillstone.functions.matching import allowed_outside, normalize_text
from quillstone.functions.wratio import Scorer
from quillstone.operators import forest
from quillstone.operators.matching import nearest
from quillstone.operators.peers import flags
from quillstone.plans.serving import NotFound, Serving
from quillstone.streaming.events import emit, read_files, start

SMALL = "/root/testdata/sf0.001"


def test_events_are_reprocessed_once(spark, tmp_path):
    folder, results, place = (str(tmp_path / n) for n in ("events", "results", "checkpoint"))
    for i in range(12):
        emit(folder, f"h{i % 4}", "bad" if i == 0 else f"sha{i}", 10, f"2026-01-{i + 1:02}")
    seen = []

    def reprocess(slug, sha):
        seen.append((slug, sha))
        if sha == "bad":
            raise ValueError("unreadable")
        return "reprocessed", ""

    start(read_files(spark, folder, 5), reprocess, results, place).awaitTermination()
    got = spark.read.parquet(results)
    assert len(seen) == 12 == got.count() and got.select("batch").distinct().count() == 3
    assert [r["detail"] for r in got.where("result = 'error'").collect()] == ["ValueError: unreadable"]
    start(read_files(spark, folder, 5), reprocess, results, place).awaitTermination()
    assert len(seen) == 12


def test_forest_finds_what_lies_apart():
    rng = np.random.default_rng(0)
    points = rng.normal(size=(600, 3))
    points[:3] = 9
    model = forest.fit(points, trees=60, sample=128)
    scores = model.score(points)
    assert set(np.argsort(scores)[:3]) == {0, 1, 2} and (scores < model.threshold).sum() <= 4
    assert np.array_equal(scores, forest.fit(points, trees=60, sample=128).score(points))


def test_forest_scores_every_row_of_its_types(spark):
    from quillstone.plans import store

    rows = store.scored(spark, SMALL)
    got = queries.queries()["isolation_forest"](spark, SMALL).collect()
    assert len(got) == rows.count() > 50
    for r in got:
        assert (r["if_score"] is None) == (r["price_type"] == "gross") and r["any_flag"] == (r["any_rule"] or r["if_flag"])
    assert 0 < sum(r["if_flag"] for r in got) < 0.1 * len(got)
    by_group = queries.queries()["anomaly_flags_all"](spark, SMALL).collect()
    assert sum(r["n"] for r in by_group) == len(got) and sum(r["n_any_flag"] for r in by_group) == sum(r["any_flag"] for r in got)


def test_injected_errors_are_judged_by_rules_and_forest(spark):
    from quillstone.plans import store

    rows = store.scored(spark, SMALL)
    trained = forest.train(rows)
    report = {(r["inj_type"], r["context"]): r for r in forest.injection_report(rows, trained, per_type=50).collect()}
    kinds = {k for k, _ in report}
    assert kinds == {"none", "x10", "x100", "div10", "div100", "item_x10", "item_x100", "three_gross", "half_min", "placeholder"}
    pool = rows.where(forest.F.col("price_type").isin("negotiated", "cash") & ~trained.is_train_row()).count()
    assert report["none", "all"]["n"] == pool and all(r["n"] <= 100 for (k, _), r in report.items() if k != "none")
    for (kind, _), r in report.items():
        assert max(r["rules"], r["forest"]) <= r["combined"] <= 1 and r["peer_only"] <= r["rules"]
    assert report["placeholder", "all"]["rules"] == 1.0 == report["three_gross", "all"]["rules"]


def test_medians_of_groups_too_large_for_a_task(spark):
    from quillstone.operators import peers

    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(3, 2, 999), [0.0, -0.5, 0.5, 1.0, 1.0, -3.0], np.full(300, 2.25)])
    rows = [("a", float(v)) for v in values] + [("b", 7.0), ("b", 8.5), ("c", 1.5), ("d", None)] + [(None, float(v)) for v in values[:10]] + [("e", float(v)) for v in (1e-9, 1e9, -1e9, 2.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    want = {k: float(np.median([v for n, v in rows if n == k])) for k in ("a", "b", "c", None, "e")}
    for got in (peers.binned_medians(df.where("v is not null"), ("k",), "v", "m"), peers.group_medians(df, ("k",), "v", "m")):
        assert {r["k"]: r["m"] for r in got.collect()} == want


def test_peer_statistics_do_not_depend_on_the_way(spark, monkeypatch):
    from quillstone.operators import peers
    from quillstone.plans import store

    rows, facts = peers.peer_rows(store.current(spark, SMALL)), store.current(spark, SMALL)
    shown = lambda df: sorted(str(tuple(r)) for r in df.collect())
    plain = shown(peers.peer_stats(rows, False, 0).select(*peers.PEER_KEY, "n", "n_hosp", "med", "mad")), shown(peers.item_context(facts, 0))
    monkeypatch.setattr(peers, "GROUP_ROWS", 5)
    assert plain == (shown(peers.peer_stats(rows, False).select(*peers.PEER_KEY, "n", "n_hosp", "med", "mad")), shown(peers.item_context(facts).select(*peers.ITEM_KEY, "item_gross", "item_cash", "item_min", "item_max")))


def brute_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = _next_row(row, x, b)
    return row[-1]


def _next_row(row, x, b):
    out = [0]
    for j, y in enumerate(b, 1):
        out.append(row[j - 1] + 1 if x == y else max(row[j], out[j - 1]))
    return out


def brute_composite(a, b):
    ratio = lambda x, y: 200 * brute_common(x, y) / (len(x) + len(y)) if x or y else 0.0
    order = lambda t: " ".join(sorted(t))

    def window(x, y):
        if not x or not y:
            return 0.0
        x, y = sorted((x, y), key=len)
        both = [(x, y)] + ([(y, x)] if len(x) == len(y) else [])
        return max(ratio(s, w) for s, t in both for w in {t[i : i + len(s)] for i in range(len(t))} | {t[:n] for n in range(1, len(s))})

    if not a or not b:
        return 0.0
    apart, (p, q) = max(len(a), len(b)) / min(len(a), len(b)), (a.split(), b.split())
    s, t = set(p), set(q)
    if apart < 1.5:
        if not s or not t:
            sets = 0.0
        elif s & t and (s <= t or t <= s):
            sets = 100.0
        else:
            x, y, m = order(s - t), order(t - s), order(s & t)
            left, right = (f"{m} {x}".strip(), f"{m} {y}".strip())
            far = len(x) + len(y) - 2 * brute_common(x, y)
            sets = 100 - 100 * far / (len(left) + len(right))
            if m:
                sets = max(sets, ratio(m, left), ratio(m, right))
        return max(ratio(a, b), 0.95 * max(ratio(order(p), order(q)), sets))
    scale = 0.9 if apart <= 8 else 0.6
    words = 100.0 if s & t else max(window(order(p), order(q)), window(order(s), order(t)))
    return max(ratio(a, b), scale * window(a, b), scale * 0.95 * words)


def test_composite_ratio_equals_a_plain_version():
    rng = np.random.default_rng(9)
    words = ["knee", "brace", "mri", "of", "the", "left", "a", "xray", "x-ray", "contrast", "injection", "mg", "10"]
    some = lambda n: " ".join(rng.choice(words, n)) if n else ""
    texts = sorted({some(int(rng.integers(0, 7))) for _ in range(60)} | {"", "z", "aspirin", "aspirine 10 mg", some(30), "knee " * 20})
    scorer = Scorer(texts)
    for asked in [*texts[::4], "aspirine", "kneebrace left", some(25), ""]:
        got = scorer.scores(asked)
        for t, score in zip(texts, got):
            assert abs(score - brute_composite(asked, t)) < 1e-9, (asked, t)


def test_candidates_without_a_word_in_common_are_found(spark):
    import quillstone.operators.matching as m

    asked = spark.createDataFrame([("h1", "aspirine"), ("h1", "xray of chest")], "hospital_slug string, text string")
    vocab = spark.createDataFrame([("A", "aspirin"), ("B", "x-ray chest"), ("C", "knee brace")], "code string, text string").withColumn("mask", forest.F.lit(2).cast("long")).withColumn("n_hosp", forest.F.lit(1).cast("long"))
    for candidates in (m.fuzzy_candidates, m.composite_candidates):
        best = {r["text"]: r["found"] for r in candidates(asked, vocab).where("place = 1").collect()}
        assert best == {"aspirine": "aspirin", "xray of chest": "x-ray chest"}
        none = {r["method"] for r in m.fuzzy_match(asked, vocab, candidates).collect()}
        assert none == {"none"}  # known from the asking hospital only
    texts = spark.createDataFrame([(f"text {i} {'abc'[i % 3] * (i % 7)}",) for i in range(60)], "text string")
    want = sorted(map(tuple, m.composite_candidates(texts, texts, 5).collect()))
    m.VOCABULARY_BLOCK, before = 13, m.VOCABULARY_BLOCK
    try:
        assert sorted(map(tuple, m.composite_candidates(texts, texts, 5).collect())) == want
    finally:
        m.VOCABULARY_BLOCK = before


def test_masks_have_room_for_sixty_two_hospitals(spark):
    from quillstone.operators.matching import REFERENCE_BIT, hospital_bit

    bits = [r[0] for r in spark.createDataFrame([(f"h{i}",) for i in range(62)], "s string").select(hospital_bit(forest.F.col("s"))).collect()]
    assert len({*bits, REFERENCE_BIT}) == 63 and all(b.bit_count() == 1 for b in bits)
    with pytest.raises(Exception, match="62 hospitals"):
        spark.createDataFrame([("h62",)], "s string").select(hospital_bit(forest.F.col("s"))).collect()


def test_data_checks_have_severity(spark):
    from quillstone.operators.gold import checks

    rows = spark.createDataFrame([(1, "a", 5.0, "x"), (1, "b", None, "y"), (2, "b", -1.0, None), (2, "b", 3.0, "z")], "k int, t string, v double, r string")
    other = spark.createDataFrame([("x",), ("y",)], "name string")
    got = {r["check"]: (r["severity"], r["failures"], r["status"]) for r in checks(rows, unique=("k", ("k", "t")), not_null=("v", "t"), accepted={"t": ("a", "b")}, ranges={"v": (0, None)}, relationships={"r": (other, "name")}, warn=("unique:k",)).collect()}
    assert got == {"not_null:v": ("error", 1, "fail"), "not_null:t": ("error", 0, "pass"), "accepted:t": ("error", 0, "pass"), "range:v": ("error", 1, "fail"), "unique:k": ("warn", 2, "warn"), "unique:k,t": ("error", 1, "fail"), "relationship:r": ("error", 1, "fail")}
    assert checks(rows, unique=("t",)).first()["failures"] == 1


BASE = dict(price_type="negotiated", amount=100.0, robust_z=0.0, item_gross=100.0, item_cash=None, item_min=50.0, item_max=150.0)


@pytest.mark.parametrize("change, fires", [
    ({}, None), ({"robust_z": -5.0}, "r1_robust_z"), ({"item_gross": 90.0}, "r2_neg_gt_gross"), ({"item_max": 90.0}, "r3_out_of_range"), ({"item_min": 112.0, "item_gross": 99.0}, "r3_out_of_range"),
    ({"price_type": "cash", "item_gross": 90.0}, "r4_cash_gt_gross"), ({"amount": 99999.94, "item_gross": None, "item_min": None, "item_max": None}, "r5_placeholder"), ({"item_gross": None, "item_min": None, "item_max": None}, None),
])
def test_each_rule_fires_alone(spark, change, fires):
    row = BASE | change
    df = spark.createDataFrame([tuple(row.values())], "price_type string, amount double, robust_z double, item_gross double, item_cash double, item_min double, item_max double")
    got = flags(df).first().asDict()
    assert [k for k in got if k[0] == "r" and k[1].isdigit() and got[k]] == ([fires] if fires else [])


def test_text_and_masks(spark):
    rows = spark.createDataFrame([("HC MRI BRAIN W/O CONTRAST",), ("pr hb inj 10mg w/dye",), (None,), ("HC HC",), ("Add'l CATH",)], "raw string")
    from pyspark.sql import functions as F

    texts = [r[0] for r in rows.select(normalize_text(F.col("raw"))).collect()]
    assert texts == ["magnetic resonance imaging brain without contrast", "injection 10 mg with dye", "", "", "additional catheter"]
    again = spark.createDataFrame([(t,) for t in texts], "raw string")
    assert [r[0] for r in again.select(normalize_text(F.col("raw"))).collect()] == texts
    masks = spark.createDataFrame([(1, 1), (3, 1), (1 << 40, 1), (1, None)], "m long, own long")
    assert [r[0] for r in masks.select(allowed_outside(F.col("m"), F.col("own"))).collect()] == [False, True, True, True]


def test_vector_search_has_another_way_for_many_queries(spark, monkeypatch):
    import quillstone.operators.matching as m

    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet").limit(120)
    asked = m.queries_of(vectors.union(vectors.limit(0)))
    want = sorted(map(tuple, nearest(vectors, asked, 5).collect()))
    monkeypatch.setattr(m, "QUERY_BYTES", 1024)
    assert sorted(map(tuple, nearest(vectors, asked, 5).collect())) == want


def test_serving(spark):
    api = Serving(spark, SMALL)
    assert all(spark.table(name).count() for name in api.views(spark))
    assert api.health()["status"] == "healthy" and api.search("an", 5).count() <= 5
    code = api.spreads.first()["code"]
    assert api.price_spread(code).count() and api.hospital_quality("h3").count() == 1
    both, missing = api.compare([code, "none", code])
    assert missing == ["none"] and both.count()
    for call in (lambda: api.search("a"), lambda: api.search("ab", 0), lambda: api.compare([code])):
        with pytest.raises(ValueError):
            call()
    for call in (lambda: api.price_spread("none"), lambda: api.hospital_quality("none")):
        with pytest.raises(NotFound):
            call()
