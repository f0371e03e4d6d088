"""Mixing: targets against the iterative definition, selection against a sorted brute force."""

import math
import re

from pyspark.sql import functions as F

from quillstone.llm import mixing

SCHEMA = "doc_id long, text string, source string, extra string"


def brute_targets(sizes: dict) -> dict:
    """Share by weight; stop at three times the size; reshare the excess by weight until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        got = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if got[s] > 3 * sizes[s]]
        if not over:
            return fixed | got
        fixed |= {s: 3 * sizes[s] for s in over}


def documents(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 23)), f"s{i % 9}" if i % 9 else "s0", "x") for i in range(400)]
    rows += [(1000 + i, "a b c", None, None) for i in range(7)] + [(2000, None, "s1", None), (2001, "", "s1", None), (2002, " \t ", "only", None)]
    rows += [(5, rows[5][1], rows[5][2], "again")]
    return spark.createDataFrame(rows, SCHEMA)


def test_targets_follow_the_iterative_definition(spark):
    got = mixing.mix(documents(spark)).toPandas()
    sizes = {}
    for r in documents(spark).collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    want = brute_targets(sizes)
    assert len(got) == documents(spark).count()
    for source, part in got.groupby(got["source"].fillna("\0null")):
        key = None if source == "\0null" else source
        assert set(part["source_size"]) == {sizes[key]}
        assert all(math.isclose(t, want[key], rel_tol=1e-9, abs_tol=1e-9) for t in part["target"])
        assert abs(part["taken"].sum() - want[key]) <= 23
        assert (part["taken"] <= 3 * part["size"]).all() and (part["taken"] >= 0).all()
        epochs = int(want[key] // sizes[key]) if sizes[key] else 0
        assert (part["taken"] >= epochs * part["size"]).all()


def test_smallest_keys_are_taken_first(spark):
    docs = documents(spark).dropDuplicates(["doc_id"])
    keyed = {r["doc_id"]: r["mix_key"] for r in mixing.sized_documents(docs).collect()}
    for r in mixing.mix(docs).where(F.col("size") > 0).groupBy("source").agg(F.collect_list(F.struct("doc_id", "times")).alias("d")).collect():
        times = sorted((keyed[d["doc_id"]], d["times"]) for d in r["d"])
        assert [t for _, t in times] == sorted((t for _, t in times), reverse=True)


def test_stage_repeats_rows_and_keeps_columns(spark):
    docs = documents(spark).dropDuplicates(["doc_id"]).withColumns({c: F.lit("clash") for c in ("size", "target", "epochs", "cut_key", "mix_plan", "mix_source", "mix_key")})
    times = {r["doc_id"]: r["times"] for r in mixing.mix(docs).collect()}
    out = mixing.apply_mix(docs)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == {d: t for d, t in times.items() if t}


def test_empty_table(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mixing.apply_mix(spark.createDataFrame([], SCHEMA)).count() == 0
