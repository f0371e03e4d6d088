"""The raw store with a session of its own, and answers of a scripted model."""

import os

from quillstone.operators.answers import ask, parse_answer, with_answers
from quillstone.plans.reports import phase_reports, write_gold_fixture
from quillstone.sources.bronze import fetch_all, file_name, read_manifest


class Answer:
    def __init__(self, body, headers=None):
        self.body, self.headers = body, headers or {}

    def raise_for_status(self):
        if self.body is None:
            raise OSError("503")

    def iter_content(self, size):
        yield from (self.body[i : i + 3] for i in range(0, len(self.body), 3))


class Session:
    def __init__(self, *answers):
        self.answers = list(answers)

    def get(self, url, stream, timeout):
        return self.answers.pop(0)


def test_content_is_stored_once(spark, tmp_path):
    pauses, told = [], []
    session = Session(Answer(b"prices", {"Content-Disposition": 'attachment; filename="a b.csv"'}), Answer(None), Answer(b"prices"), Answer(None), Answer(None), Answer(None))
    sources = [("h", "http://x/one.csv"), ("h", "http://x/two.csv"), ("g", "http://x/three.csv")]
    got = fetch_all(session, sources, str(tmp_path / "store"), str(tmp_path / "m.jsonl"), lambda: "2026-01-01", pauses.append, told.append)
    assert [r["outcome"] for r in got] == ["stored", "unchanged_duplicate", "failed"] and len(told) == 1
    assert pauses == [2.0, 5.0, 2.0, 5.0, 10.0] and got[2]["error"] == "OSError: 503"
    assert got[0]["path"] == got[1]["path"] and got[0]["path"].endswith("a_b.csv") and os.stat(got[0]["path"]).st_mode & 0o777 == 0o444
    assert not [f for _, _, names in os.walk(tmp_path) for f in names if f.endswith(".part")]
    assert read_manifest(spark, str(tmp_path / "m.jsonl")).count() == 3


def test_file_names():
    assert file_name("http://x/a/b%20c.zip?q=1", {}) == "b_c.zip" and file_name("http://x/", {}) == "file"
    assert file_name("http://x/y", {"content-disposition": "attachment; filename*=UTF-8''z%2Fq.json"}) == "z_q.json"


def test_answers(spark):
    assert parse_answer('{"code": "1", "confidence": "high"}', ["1"]) == ("1", "high") and parse_answer('{"code": null, "confidence": "low"}') == (None, "low")
    assert parse_answer('{"code": "2", "confidence": "high"}', ["1"]) is None and parse_answer("no") is None and parse_answer('{"code": 3, "confidence": "high"}') is None

    def model(text, candidates):
        if text == "broken":
            raise OSError
        return '{"code": "%s", "confidence": "high"}' % (candidates[0] if candidates else text)

    items = spark.createDataFrame([(1, "a", ["x", "y"]), (2, "b", None), (3, "broken", None), (4, "c", None)], "item_id long, text string, candidates array<string>")
    known = spark.createDataFrame([(4, "old", "high", 1)], "item_id long, llm_code string, llm_conf string, attempts int")
    got = {r["item_id"]: tuple(r)[1:] for r in ask(items, model, 2, known).collect()}
    odd = spark.createDataFrame([(2**60 + 1, "a", None), (None, "b", None)], "item_id long, text string, candidates array<string>").coalesce(1)
    asked = ask(odd, model, 1)
    assert sorted(str(r["item_id"]) for r in asked.collect()) == sorted([str(2**60 + 1), "None"])
    assert {r["llm_code"] for r in with_answers(items, ask(items, model, 2)).collect()} == {"x", "b", None, "c"}
    assert got == {1: ("x", "high", 1), 2: ("b", "high", 1), 3: (None, "low", 12), 4: ("old", "high", 1)}


def test_reports_of_the_phases(spark, tmp_path):
    manifest = spark.createDataFrame([("h", "stored", 10), ("h", "failed", 0), ("g", "unchanged_duplicate", 7)], "slug string, outcome string, size_bytes long")
    runs = spark.createDataFrame([("h", 90, 10, 1.5)], "slug string, rows_out long, rejects long, duration_s double")
    ledger = spark.createDataFrame([("h", 5, 2, 83, 0.5), ("h", 1, 1, 89, 0.5)], "slug string, rows_inserted long, rows_closed long, rows_unchanged long, duration_s double")
    text = phase_reports(manifest, runs, ledger)
    assert "sources 2, fetches 3, failures 1, stored_bytes 10" in text and "| h | 90 | 10 | 1.5 | 0.1 |" in text and "| h | 2 | 6 | 3 | 172 | 1.0 |" in text
    made = write_gold_fixture(spark, str(tmp_path / "gold"))
    assert made == {"prices": 36, "quality": 3, "flags": 36, "registry": 3}
    prices = spark.read.parquet(str(tmp_path / "gold" / "prices"))
    assert prices.select("hospital_slug", "code", "payer").distinct().count() == 36 and prices.where("payer is null").count() == 12
