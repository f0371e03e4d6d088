"""SCD2 loads, versions and pinned reports."""

import random
import time
from decimal import Decimal
from pathlib import Path

import duckdb
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest

from quillstone.operators.history import T2, as_of, initial, merge
from quillstone.plans import store
from quillstone.plans.loads import History, reproduce, run_report, store_metrics, store_quality
from quillstone.plans.pricefacts import KEY, STAGED, distinct_facts, price_facts, stage
from quillstone.plans_loaded import ORACLES, QUERIES
from quillstone.session import shared_dir
from quillstone.sources.snapshots import SnapshotTable

FACTS = "hospital_slug string, description string, code string, code_type string, alt_codes string, setting string, billing_class string, payer string, plan string, price_type string, amount decimal(14,4), methodology string, modifiers string"
# description, code, payer, price type, amount: of five prices two stay, one changes, two go, and two are new
OLD = [("Brace", "L1810", None, "gross", 412), ("Brace", "L1810", "Harbor", "negotiated", 210), ("Sling", "A4565", "Harbor", "negotiated", 31), ("Sling", "A4565", None, "cash", 25), ("Cast", "29075", "Summit", "negotiated", 131)]
NEW = [("Brace", "L1810", None, "gross", 412), ("Brace", "L1810", "Harbor", "negotiated", 205), ("Sling", "A4565", None, "cash", 25), ("Boot", "L4360", "Summit", "negotiated", 88), ("Boot", "L4360", None, "gross", 140)]


def facts(spark, rows, slug="h"):
    return spark.createDataFrame([(slug, d, c, "CPT", "", None, None, p, None, t, Decimal(a), None, None) for d, c, p, t, a in rows], FACTS)


@pytest.fixture
def history(spark, tmp_path):
    return History(spark, str(tmp_path))


def test_versions(spark, history):
    first = history.load("h", "s1", facts(spark, OLD), "2026-01-01 00:00:00")
    assert (first["mode"], first["rows_inserted"]) == ("initial", len(OLD))
    second = history.load("h", "s2", facts(spark, NEW), "2026-02-01 00:00:00", synthetic=True)
    assert (second["rows_closed"], second["rows_inserted"], second["rows_unchanged"]) == (len(set(OLD) - set(NEW)), len(set(NEW) - set(OLD)), len(set(OLD) & set(NEW)))
    rows = history.table.read()
    closed = {(r["description"], r["payer"]): r["change_reason"] for r in rows.where("not is_current").collect()}
    assert closed == {("Brace", "Harbor"): "changed", ("Sling", "Harbor"): "removed", ("Cast", "Summit"): "removed"}
    assert as_of(rows, "2026-01-15 00:00:00").count() == len(OLD) == history.table.read(0).where("is_current").count()
    version = history.table.version()
    assert history.load("h", "s2", facts(spark, NEW), "2026-03-01 00:00:00")["mode"] == "skipped_already_loaded"
    assert history.load("h", "s3", facts(spark, NEW), "2026-03-01 00:00:00")["mode"] == "noop" and history.table.version() == version
    assert history.load("g", "s1", facts(spark, OLD, "g"), "2026-03-01 00:00:00")["mode"] == "initial"
    assert set(history.table.files()) == {"h", "g"} and history.loads().count() == 4
    assert history.loads().where("synthetic").count() == 1 and history.loads().where("loaded_at is null or duration_s is null").count() == 0


def test_same_key_with_other_amounts_keeps_rows(spark, history):
    rows = [("Boot", "L4360", "Summit", "negotiated", a) for a in (88, 91, 91, 97)]
    assert history.load("h", "s", facts(spark, rows), "2026-01-01 00:00:00")["staged_rows"] == 3
    assert sorted(r["dup_seq"] for r in history.table.read().collect()) == [0, 1, 2]


def test_a_merge_rewrites_only_files_with_closed_rows(spark, history):
    many = [(f"Item {i:03}", f"C{i:03}", None, "gross", 100 + i) for i in range(200)]
    history.table.commit("h", initial(stage(facts(spark, many)), "s1", "2026-01-01 00:00:00").repartitionByRange(8, "code"))
    before = set(history.table.files()["h"])
    changed = [(d, c, p, t, a + (c == "C005")) for d, c, p, t, a in many]
    assert history.load("h", "s2", facts(spark, changed), "2026-02-01 00:00:00")["rows_closed"] == 1
    assert len(before & set(history.table.files()["h"])) == len(before) - 1
    rows = history.table.read()
    assert rows.count() == 201 and rows.where("is_current").count() == 200 and rows.where("not is_current").first()["code"] == "C005"
    assert history.load("h", "s3", facts(spark, many), "2026-03-01 00:00:00")["rows_closed"] == 1 and history.table.read().count() == 202


def test_stored_tables_open_only_files_that_can_hold_the_rows(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path))
    rows = spark.range(4000).selectExpr("concat('h ', id % 3, '/x') as hospital_slug", "concat('c', lpad(id % 50, 2, '0')) as code", "id", "cast(null as string) as gap")
    table.commit_table(rows.repartition(6), "hospital_slug", "code")
    assert table.rows() == 4000 and set(table.files()) == {"h 0/x", "h 1/x", "h 2/x"} and table.read().count() == 4000
    opened, every = table.chosen(partitions=["h 1/x"], within={"code": ["c07"]})
    assert 0 < len(opened) < every == len([f for g in table.files().values() for f in g])
    assert table.read(partitions=["h 1/x"], within={"code": ["c07"]}).where("code = 'c07'").count() == rows.where("hospital_slug = 'h 1/x' and code = 'c07'").count()
    assert table.chosen(within={"code": ["none"]})[0] == [] and table.read(within={"code": ["none"]}).count() == 0
    table.commit("h 1/x", rows.limit(0).union(rows.where("hospital_slug = 'h 1/x'").limit(5)))
    assert table.read().count() == rows.where("hospital_slug <> 'h 1/x'").count() + 5 and table.read(0).count() == 4000


def test_a_taken_version_is_refused(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path))
    table.commit("p", spark.range(3).toDF("x"))
    with pytest.raises(FileExistsError):
        table._create(table._log(0), "{}")
    table.commit("p", spark.range(2).toDF("x"), replace=False)
    assert (table.read().count(), table.read(0).count(), table.compact("p", 1, "x")) == (5, 3, 2)
    assert len(table.files()["p"]) == 1 and table.read().count() == 5


def test_report_is_the_same_after_the_data_moved_on(spark, history):
    history.load("h", "s1", facts(spark, OLD), "2026-01-01 00:00:00")
    data, record = run_report(history.table, ("L1810", "A4565"), ("negotiated",))
    history.load("h", "s2", facts(spark, NEW), "2026-02-01 00:00:00")
    assert reproduce(history.table, record) and b"210.0000" in data
    assert run_report(history.table, ("L1810", "A4565"), ("negotiated",), moment="2026-01-15 00:00:00")[0] == data
    assert run_report(history.table, ("L1810", "A4565"), ("negotiated",))[0] != data


def test_the_whole_chain_can_be_reproduced(spark, tmp_path):
    """Staging, first load, merge, time travel, point in time, ledger and report give the same again in a second place."""

    def run(place):
        history = History(spark, str(place))
        history.load("h", "s1", facts(spark, OLD), "2026-01-01 00:00:00")
        history.load("h", "s2", facts(spark, NEW), "2026-02-01 00:00:00")
        rows = lambda df: sorted(map(str, df.drop("loaded_at", "duration_s").collect()))
        shown = [rows(stage(facts(spark, OLD))), rows(history.table.read(0)), rows(history.table.read()), rows(as_of(history.table.read(), "2026-01-20 00:00:00")), rows(history.loads())]
        return [*shown, run_report(history.table, ("L1810",), ("gross",))[0], history.table.version()]

    assert run(tmp_path / "a") == run(tmp_path / "b")


def test_logs_are_stored(spark, tmp_path):
    rows = spark.createDataFrame([("h", 90.5)], "hospital_slug string, quality_score double")
    assert (store_quality(spark, str(tmp_path), rows), store_quality(spark, str(tmp_path), rows)) == (0, 1)
    assert SnapshotTable(spark, f"{tmp_path}/quality").read().count() == 2
    store_metrics(spark, str(tmp_path), rows)
    store_metrics(spark, str(tmp_path), rows)
    assert SnapshotTable(spark, f"{tmp_path}/run_metrics").read().count() == 1


def test_random_snapshots_follow_a_model(spark, tmp_path):
    rnd, history, seen = random.Random(3), History(spark, str(tmp_path)), {}
    for step in range(4):
        snapshot = {f"d{rnd.randrange(9)}": rnd.randrange(1, 4) for _ in range(6)}
        got = history.load("h", f"s{step}", facts(spark, [(d, "1", None, "gross", a) for d, a in snapshot.items()]), f"2026-0{step + 1}-01 00:00:00")
        if step:
            assert got["rows_closed"] == sum(snapshot.get(d) != a for d, a in seen.items())
            assert got["rows_inserted"] == sum(seen.get(d) != a for d, a in snapshot.items())
        seen = snapshot
        now = {r["description"]: int(r["amount"]) for r in history.table.read().where("is_current").collect()}
        assert now == seen


SHIFTED = {"lineitem": ("l_orderkey", "l_partkey", "l_suppkey"), "orders": ("o_orderkey", "o_custkey"), "customer": ("c_custkey",), "part": ("p_partkey",), "supplier": ("s_suppkey",)}


def in_duckdb(place, sql):
    con = duckdb.connect()
    for name in SHIFTED:
        files = f"{place}/{name}.parquet" + "/*.parquet" * (place / f"{name}.parquet").is_dir()
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{files}'")
    return sorted(map(str, con.execute(sql).fetchall()))


def shifted(table, keys, by):
    for k in keys:
        table = table.set_column(table.schema.get_field_index(k), k, pc.add(table[k], by))
    return table


def test_current_rows_come_without_storing_all_repeats(spark, tmp_path):
    """Three copies of the tables under keys of their own: the facts repeat, and neither the repeats nor wide rows are written on the way."""
    for name, keys in SHIFTED.items():
        one = pq.read_table(f"/root/testdata/sf0.001/{name}.parquet")
        pq.write_table(pa.concat_tables(shifted(one, keys, i * 10**6) for i in range(3)), f"{tmp_path}/{name}.parquet")
    rows = [str(tuple(r)) for r in QUERIES["scd2_current"](spark, str(tmp_path)).collect()]
    assert sorted(rows) == in_duckdb(tmp_path, ORACLES["scd2_current"])
    assert store.place(spark, str(tmp_path), "prices").version() < 0 and not list(Path(shared_dir(spark), "store").glob("passing-*"))
    once = store.current_table(spark, str(tmp_path)).rows()
    assert once == store.current_table(spark, "/root/testdata/sf0.001").rows() and store.prices(spark, str(tmp_path)).count() > 2 * once


def test_passed_rows_leave_no_shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f: f.stat().st_size for d in blocks.localDirs() for f in Path(d.getPath()).rglob("shuffle_*.data")}
    before = files()
    with store.passing(spark) as passed:
        rows = passed(spark.range(20_000).repartition(3, "id"))
        names, until = rows.inputFiles(), time.time() + 10
        while (left := sum(files()[f] for f in files().keys() - before)) and time.time() < until:  # they are removed in the background
            time.sleep(0.2)
        assert left == 0 and rows.count() == 20_000
    assert names and not any(Path(n.removeprefix("file:")).exists() for n in names)


def test_a_merge_shuffles_only_what_is_asked_for(spark, capsys):
    first = initial(stage(facts(spark, OLD)), "s1", "2026-01-01 00:00:00")
    asked = ("row_id", "key_hash", "amount", "is_current")
    held = spark.createDataFrame(first.collect(), first.schema)
    new = stage(facts(spark, NEW))
    new = spark.createDataFrame(new.collect(), new.schema)

    def exchanges(df):
        df.explain("formatted")
        return "".join(x for x in capsys.readouterr().out.split("\n\n") if "Exchange" in x and "Input" in x)

    some = merge(held, new, "s2", T2, asked)
    assert "description" in exchanges(merge(held, new, "s2", T2)) and "key_hash" in (narrow := exchanges(some)) and "description" not in narrow
    assert sorted(map(str, some.collect())) == sorted(map(str, merge(held, new, "s2", T2).select(*asked).collect()))


def test_distinct_facts_of_odd_tables(spark, tmp_path):
    """Nulls in every column that may have them, parts alike under several keys, and part keys that come twice, with other columns."""
    rnd = random.Random(5)
    odd = lambda *values: rnd.choice(values)
    tables = {
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_returnflag string, l_linestatus string", [(odd(1, 2, 3, None), odd(1, 2, 3, 4, 5, 6, None), odd(1, 2), odd(1, 2, None), odd(1.5, 2.25, None), odd("R", "A", "N", None), odd("O", "F", None)) for _ in range(600)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string", [(1, 1, "O", "1-URGENT"), (2, 2, None, "2-HIGH"), (3, 1, "F", None), (None, 1, "F", "1-URGENT")]),
        "customer": ("c_custkey long, c_mktsegment string", [(1, "A"), (2, None)]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int", [(1, "n", "b", "SMALL", 1), (1, "m", "b", "PROMO", 1), (2, "n", "b", "SMALL", 1), (3, "n", "b", None, 1), (4, "n", "b", None, 2), (5, None, None, "LARGE", None), (6, "m", "b", "PROMO", 1), (6, "m", "b", "PROMO", 1), (None, "n", "b", "SMALL", 1)]),
        "supplier": ("s_suppkey long, s_nationkey int", [(1, 7), (2, 8), (None, 7)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    columns = (*KEY, "amount", "methodology", "modifiers", "alt_codes")
    shown = lambda df: sorted(str(tuple(r)) for r in df.select(*columns).collect())
    expected = in_duckdb(tmp_path, f"{STAGED} SELECT {', '.join(columns)} FROM src")
    assert len(expected) > 50 and shown(distinct_facts(spark, str(tmp_path))) == expected == shown(price_facts(spark, str(tmp_path)).distinct())
