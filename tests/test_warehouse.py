"""Load-once ingestion and the whole job over catalog tables."""

import csv
import datetime as dt
import os
import threading
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill import schemas
from ordermill.operators.dimensions import DIMENSIONS
from ordermill.operators.quality import duplicate_keys, orphans
from ordermill.plans.warehouse import REJECTS, Warehouse
from ordermill.rules import DEFAULT, INDIA, PARITY, Rules
from ordermill.sources import landing, tables
from ordermill.streaming.load_once import LOAD_ID, load_new_files, write_files

ONLY_INDIA = Rules(markets=(INDIA,))
AS_OF = dt.date(2026, 1, 23)


def _drop(root, day, *orders):
    """Land one file of orders, given as (order id, order date, quantity, customer)."""
    folder = root / "source=IN" / "format=csv" / f"date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    with open(folder / f"order-{uuid.uuid4().hex}.csv", "w", newline="") as file:
        out = csv.writer(file)
        out.writerow([f.column for f in landing.FIELDS])
        for order_id, date, quantity, customer in orders:
            out.writerow(
                [order_id, customer, "b/m/c/64", quantity, 100, 100, "null", "80.00", "8.00",
                 date, "Paid", "Delivered", "card", "", "1", "Main St"]
            )


def _rates(path, *days):
    path.write_text(
        "date,usd2usd,usd2eu,usd2can,usd2uk,usd2inr,usd2jp\n"
        + "".join(f"{day},1,1.1,1.3,0.8,80,130\n" for day in days)
    )
    return str(path)


@pytest.fixture
def source(spark, tmp_path):
    name = f"t{uuid.uuid4().hex}"
    tables.create_database(spark, name, str(tmp_path / "db"))
    loaded = T.StructField(LOAD_ID, T.StringType())
    orders = schemas.source_orders(INDIA.contact_field)
    tables.create_table(spark, f"{name}.o", T.StructType([*orders, loaded]), LOAD_ID)
    tables.create_table(spark, f"{name}.r", T.StructType([*REJECTS, loaded]), LOAD_ID)
    yield f"{name}.o", f"{name}.r"
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_files_are_loaded_once(spark, tmp_path, source):
    root, checkpoint = tmp_path / "landing", str(tmp_path / "cp")
    orders, rejects = source

    def load(**limits):
        return load_new_files(spark, str(root), INDIA, orders, rejects, checkpoint, **limits)

    _drop(root, "2023-01-01", ("A", "2023-01-01", 1, "Ann"), ("B", "2023-01-01", "x", "Ann"))
    first = load()
    assert [(d.rows_written, d.rows_rejected) for d in first] == [(1, 1)]
    assert load() == []
    _drop(root, "2023-01-02", ("C", "2023-01-02", 1, "Ann"))
    _drop(root, "2023-01-03", ("D", "2023-01-03", 1, "Ann"))
    assert [d.rows_written for d in load(maxFilesPerTrigger=1)] == [1, 1]
    rows = spark.table(orders).select("order_id", "sales_order_key").collect()
    assert sorted(r["order_id"] for r in rows) == ["A", "C", "D"]
    assert len({r["sales_order_key"] for r in rows}) == 3
    assert spark.table(rejects).count() == 1


def test_repeated_batch_leaves_no_second_copy(spark, tmp_path, source):
    orders, rejects = source
    root = tmp_path / "landing"
    _drop(root, "2023-01-01", ("A", "2023-01-01", 1, "Ann"))
    paths = [str(p) for p in root.rglob("*.csv")]

    def write(load_id):
        write_files(spark, str(root), paths, load_id, INDIA, orders, rejects)

    write("q-0")
    keys = spark.table(orders).select("sales_order_key").collect()
    write("q-0")
    assert spark.table(orders).select("sales_order_key").collect() == keys
    write("q-1")
    assert spark.table(orders).count() == 2


@pytest.fixture
def warehouse(spark, tmp_path):
    made = Warehouse(spark, str(tmp_path / "wh"), f"w{uuid.uuid4().hex}_", ONLY_INDIA)
    yield made
    for layer in ("source", "curated", "consumption", "audit", "common"):
        spark.sql(f"DROP DATABASE IF EXISTS {made.prefix}{layer} CASCADE")


def _facts(warehouse):
    rows = warehouse.table("consumption", "sales_fact").collect()
    return sorted((r["order_code"], r["us_total_order_amt"]) for r in rows if r["exchange_rate"])


def _audited(warehouse, layer, table):
    return warehouse.audit(layer, table).agg(F.sum("rows_written")).first()[0]


AUDITED = (
    ("source", "in_sales_order"),
    ("curated", "in_sales_order"),
    ("common", "exchange_rate"),
    ("consumption", "sales_fact"),
    *(("consumption", d.table) for d in DIMENSIONS),
)


def _contents(warehouse):
    """Orders of every layer, and how many rows each table has and is noted to have."""
    orders = [
        sorted(r[0] for r in warehouse.table(layer, table).select(column).collect())
        for layer, table, column in (
            ("source", "in_sales_order", "order_id"),
            ("curated", "in_sales_order", "order_id"),
            ("consumption", "sales_fact", "order_code"),
        )
    ]
    counts = {t: warehouse.table(*t).count() for t in AUDITED}
    assert {t: _audited(warehouse, *t) for t in AUDITED} == counts
    return orders, counts


def test_a_failure_after_any_write_loses_nothing(spark, tmp_path, monkeypatch):
    """Attempt n is lost right after its n-th write, until one gets through."""

    def made(name, lost):
        root, folder = tmp_path / name, tmp_path / f"{name}-files"
        warehouse = Warehouse(spark, str(root), f"w{uuid.uuid4().hex}_", ONLY_INDIA)
        rates = _rates(tmp_path / f"{name}.csv", "2023-01-01", "2023-01-02")
        for drop in (("A", "B"), ("C",)):
            orders = [(i, f"2023-01-0{1 + (i != 'A')}", 1, f"Customer {i}") for i in drop]
            _drop(folder, "2023-01-01", *orders)
            for attempt in range(1, 100):
                writes = [0]

                def counted(write):
                    def call(*args, **named):
                        done = write(*args, **named)
                        writes[0] += 1
                        if lost and writes[0] == attempt:
                            raise RuntimeError("lost")
                        return done

                    return call

                with monkeypatch.context() as patch:
                    for name_of in ("append", "replace_and_see"):
                        patch.setattr(tables, name_of, counted(getattr(tables, name_of)))
                    try:
                        run = f"{drop[0]}{attempt}"
                        warehouse.run(str(folder), rates, str(root / "cp"), run, AS_OF)
                        break
                    except Exception as error:
                        assert "lost" in str(error)
        return _contents(warehouse), attempt

    expected, _ = made("plain", False)
    found, attempts = made("broken", True)
    assert found == expected and attempts > 3
    assert expected[0] == [["A", "B", "C"]] * 3


def test_runs_add_only_what_is_new(warehouse, tmp_path):
    root, checkpoint = tmp_path / "landing", str(tmp_path / "cp")
    rates = _rates(tmp_path / "rates.csv", "2023-01-01", "2023-03-01")

    def run(name):
        return warehouse.run(str(root), rates, checkpoint, name, AS_OF)

    _drop(root, "2023-01-01", ("A", "2023-01-01", 1, "Ann"), ("B", "2023-01-01", 1, "Bob"))
    assert run("r1") == {"rates": 2, "ingested": 2, "curated": 2, "facts": 2}
    assert run("r2") == {"rates": 0, "ingested": 0, "curated": 0, "facts": 0}

    # A later file for the same day supersedes it; the rows curated before stay.
    _drop(root, "2023-01-01", ("C", "2023-01-01", 1, "Ann"))
    assert run("r3") == {"rates": 0, "ingested": 1, "curated": 1, "facts": 1}

    # A day without a rate gets one later: it is curated again, with dollars.
    _drop(root, "2023-03-02", ("D", "2023-03-02", 1, "Dan"))
    assert run("r4") == {"rates": 0, "ingested": 1, "curated": 1, "facts": 1}
    rates = _rates(tmp_path / "rates.csv", "2023-01-01", "2023-03-01", "2023-03-02")
    assert run("r5") == {"rates": 1, "ingested": 0, "curated": 1, "facts": 1}
    assert run("r6") == {"rates": 0, "ingested": 0, "curated": 0, "facts": 0}

    assert [code for code, _ in _facts(warehouse)] == ["A", "B", "C", "D"]
    fact = warehouse.table("consumption", "sales_fact")
    assert fact.count() == 5
    assert duplicate_keys(fact, "order_id_pk").isEmpty()
    members = {d.table: warehouse.table("consumption", d.table) for d in DIMENSIONS}
    assert orphans(fact, members).isEmpty()
    for dimension in DIMENSIONS:
        assert duplicate_keys(members[dimension.table], dimension.key).isEmpty()
    assert members["date_dim"].count() == 61
    assert members["customer_dim"].count() == 3
    assert _audited(warehouse, "source", "in_sales_order") == 4
    assert _audited(warehouse, "consumption", "sales_fact") == 5


def test_only_partitions_of_touched_days_are_read(warehouse, tmp_path):
    """Loads are found by their noted days and new keys by noted ranges, not by scans."""
    root, checkpoint = tmp_path / "landing", str(tmp_path / "cp")
    rates = _rates(tmp_path / "rates.csv", "2023-01-01", "2023-03-01")
    for day in ("2023-01-01", "2023-03-01"):
        _drop(root, day, (day, day, 1, "Ann"))
        warehouse.run(str(root), rates, checkpoint, f"run {day}", AS_OF)
    warehouse.curate("again")  # notes the days of what the last run has curated
    last = warehouse.days("source", "in_sales_order").filter("day = '2023-03-01'").select(LOAD_ID)
    for rows in warehouse.touched_orders(INDIA, last):
        assert [r["order_id"] for r in rows.select("order_id").collect()] == ["2023-03-01"]
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "SubqueryAdaptiveBroadcast dynamicpruning" in plan
    ranges = warehouse.table("audit", "key_ranges").orderBy("table_name", "first_key").collect()
    for one, other in zip(ranges, ranges[1:], strict=False):
        assert one["table_name"] != other["table_name"] or one["last_key"] < other["first_key"]
    assert len(ranges) == 4


def test_run_after_a_failure_takes_up_what_was_left(warehouse, tmp_path, monkeypatch):
    root, checkpoint = tmp_path / "landing", str(tmp_path / "cp")
    rates = _rates(tmp_path / "rates.csv", "2023-01-01")
    _drop(root, "2023-01-01", ("A", "2023-01-01", 1, "Ann"))

    def fail(*args):
        raise RuntimeError("lost")

    # After the rows are written, before this is noted.
    for broken, run in (("_curate", "r1"), ("_take", "r2"), ("_model", "r3")):
        with monkeypatch.context() as patch:
            patch.setattr(Warehouse, broken, fail)
            with pytest.raises(RuntimeError):
                warehouse.run(str(root), rates, checkpoint, run, AS_OF)
    assert warehouse.run(str(root), rates, checkpoint, "r4", AS_OF)["facts"] == 1
    # The same once more, lost between the fact and its note.
    _drop(root, "2023-01-02", ("B", "2023-01-02", 1, "Ann"))
    warehouse.ingest(str(root), checkpoint)
    warehouse.curate("r5")
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "_take", fail)
        with pytest.raises(RuntimeError):
            warehouse.model("r5", AS_OF)
    assert warehouse.run(str(root), rates, checkpoint, "r6", AS_OF)["ingested"] == 0
    codes = [r["order_code"] for r in warehouse.table("consumption", "sales_fact").collect()]
    assert sorted(codes) == ["A", "B"]
    keys = duplicate_keys(warehouse.table("consumption", "sales_fact"), "order_id_pk")
    assert keys.isEmpty()


def test_markets_without_files_are_left_out(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"), f"w{uuid.uuid4().hex}_")
    root, rates = tmp_path / "landing", _rates(tmp_path / "rates.csv", "2023-01-01")
    _drop(root, "2023-01-01", ("A", "2023-01-01", 1, "Ann"))
    run = warehouse.run(str(root), rates, str(tmp_path / "cp"), "r1", AS_OF)
    assert run == {"rates": 1, "ingested": 1, "curated": 1, "facts": 1}


def test_name_of_a_complete_run_is_refused(warehouse, tmp_path):
    root, rates = tmp_path / "landing", _rates(tmp_path / "rates.csv", "2023-01-01")
    _drop(root, "2023-01-01", ("A", "2023-01-01", 1, "Ann"))
    warehouse.run(str(root), rates, str(tmp_path / "cp"), "r1", AS_OF)
    with pytest.raises(ValueError, match="r1"):
        warehouse.run(str(root), rates, str(tmp_path / "cp"), "r1", AS_OF)


def test_strict_parity_appends_the_whole_fact_again(spark, tmp_path):
    rules = Rules(markets=(INDIA,), incremental_fact=PARITY.incremental_fact)
    warehouse = Warehouse(spark, str(tmp_path / "wh"), f"w{uuid.uuid4().hex}_", rules)
    root = tmp_path / "landing"
    rates = _rates(tmp_path / "rates.csv", "2023-01-01")
    _drop(root, "2023-01-01", ("A", "2023-01-01", 1, "Ann"))
    for name in ("r1", "r2"):
        run = warehouse.run(str(root), rates, str(tmp_path / "cp"), name, AS_OF)
        assert run["facts"] == 1
    fact = warehouse.table("consumption", "sales_fact")
    assert sorted((r["order_id_pk"], r["order_code"]) for r in fact.collect()) == [
        (1, "A"),
        (2, "A"),
    ]


def test_tables_are_appended_by_name_and_never_dropped(spark, tmp_path):
    name = f"t{uuid.uuid4().hex}"
    tables.create_database(spark, name, str(tmp_path))
    table = f"{name}.region_dim"
    tables.create_table(spark, table, schemas.REGION_DIM)
    row = spark.range(1).select(
        F.lit("NA").alias("region"),
        F.lit("Y").alias("isActive"),
        F.lit("US").alias("country"),
        F.lit("k").alias("region_id_pk"),
    )
    assert tables.append(row, table) == 1
    tables.create_table(spark, table, schemas.REGION_DIM)
    assert tables.append(row.limit(0), table) == 0
    found = tables.scan(spark, table, "country", "region").collect()
    assert [tuple(r) for r in found] == [("US", "NA")]
    tables.add_column(spark, table, "note", T.LongType())
    tables.add_column(spark, table, "note", T.LongType())
    assert spark.table(table).first()["note"] is None


def test_default_markets_have_tables_of_their_own():
    assert [m.source_table for m in DEFAULT.markets] == [
        "in_sales_order",
        "us_sales_order",
        "fr_sales_order",
    ]


def _stamped(root, moment):
    """Give the files that have none yet the time of their drop."""
    stamp = dt.datetime(2026, 1, moment, tzinfo=dt.timezone.utc).timestamp()
    for path in root.rglob("*.csv"):
        if path.stat().st_mtime > stamp + 30 * 86_400:
            os.utime(path, (stamp, stamp))


def _current(warehouse):
    """Current orders of the curated table and the fact, with their dollars."""
    curated = warehouse.current("curated", "in_sales_order")
    fact = warehouse.current("consumption", "sales_fact")
    dollars = ("exchange_rate", "us_total_order_amt", "usd_tax_amt")
    return (
        sorted(map(str, curated.select("order_id", "order_dt", *dollars).collect())),
        sorted(map(str, fact.select("order_code", *dollars).collect())),
    )


def test_runs_over_parts_leave_what_one_run_leaves(spark, tmp_path):
    """Newer, equal and older files of a day, a late rate, and a day without a rate."""
    drops = (
        (10, (("A", "2023-01-01"), ("B", "2023-01-02"), ("C", "2023-01-03"))),
        (11, (("A", "2023-01-01"), ("D", "2023-01-03"), ("E", "2023-01-03"))),
        (11, (("F", "2023-01-03"),)),
        (5, (("G", "2023-01-03"), ("H", "2023-01-04"))),
        (12, (("I", "2023-01-02"),)),
    )
    early = _rates(tmp_path / "early.csv", "2023-01-01", "2023-01-03")
    late = _rates(tmp_path / "late.csv", "2023-01-01", "2023-01-02", "2023-01-03")

    def made(name, several):
        root, files = tmp_path / name, tmp_path / f"{name}-files"
        warehouse = Warehouse(spark, str(root), f"w{uuid.uuid4().hex}_", ONLY_INDIA)
        for i, (moment, orders) in enumerate(drops):
            _drop(files, "2023-01-01", *((o, day, 1, f"Customer {o}") for o, day in orders))
            _stamped(files, moment)
            if several:
                rates = early if i < 4 else late
                warehouse.run(str(files), rates, str(root / "cp"), f"run {i}", AS_OF)
        warehouse.run(str(files), late, str(root / "cp"), "last", AS_OF)
        warehouse.run(str(files), late, str(root / "cp"), "again", AS_OF)
        return warehouse, _current(warehouse)

    parts, found = made("parts", True)
    whole, expected = made("whole", False)
    assert found == expected
    codes = [r["order_code"] for r in parts.current("consumption", "sales_fact").collect()]
    assert sorted(codes) == ["A", "D", "E", "F", "H", "I"]
    assert whole.table("audit", "retracted_days").isEmpty()
    assert parts.table("consumption", "sales_fact").count() > len(codes)
    # Once replaced, a day is not taken up again.
    assert parts.curate("once more") == 0


def test_a_day_is_replaced_when_its_new_rows_are_modelled(warehouse, tmp_path, monkeypatch):
    root, checkpoint = tmp_path / "landing", str(tmp_path / "cp")
    rates = _rates(tmp_path / "rates.csv", "2023-01-01")
    _drop(root, "2023-01-01", ("A", "2023-01-01", 1, "Ann"))
    _stamped(root, 10)
    warehouse.run(str(root), rates, checkpoint, "r1", AS_OF)
    _drop(root, "2023-01-01", ("B", "2023-01-01", 1, "Bob"))
    warehouse.ingest(str(root), checkpoint)

    def fail(*args):
        raise RuntimeError("lost")

    def codes():
        return [r["order_code"] for r in warehouse.current("consumption", "sales_fact").collect()]

    # Lost between the new rows and the note on those they replace.
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "_note_retracted", fail)
        with pytest.raises(RuntimeError):
            warehouse.curate("r2")
    warehouse.curate("r3")
    curated = warehouse.current("curated", "in_sales_order")
    assert [r["order_id"] for r in curated.collect()] == ["B"]
    assert codes() == ["A"]
    warehouse.model("r3", AS_OF)
    assert codes() == ["B"]


def test_parity_keeps_replaced_days(spark, tmp_path):
    rules = Rules(markets=(INDIA,), replace_days=PARITY.replace_days)
    warehouse = Warehouse(spark, str(tmp_path / "wh"), f"w{uuid.uuid4().hex}_", rules)
    root, rates = tmp_path / "landing", _rates(tmp_path / "rates.csv", "2023-01-01")
    for moment, order in ((10, "A"), (11, "B")):
        _drop(root, "2023-01-01", (order, "2023-01-01", 1, "Ann"))
        _stamped(root, moment)
        warehouse.run(str(root), rates, str(tmp_path / "cp"), order, AS_OF)
    assert warehouse.current("consumption", "sales_fact").count() == 2


def test_reconciliation_names_what_was_tampered_with(warehouse, tmp_path):
    root, checkpoint = tmp_path / "landing", str(tmp_path / "cp")
    rates = _rates(tmp_path / "rates.csv", "2023-01-01")
    for moment, orders in ((10, "AB"), (11, "CD")):
        _drop(root, "2023-01-01", *((o, "2023-01-01", 1, "Ann") for o in orders))
        _stamped(root, moment)
        warehouse.run(str(root), rates, checkpoint, f"r{moment}", AS_OF)
    assert warehouse.reconcile().isEmpty()
    fact, curated = warehouse.name("consumption", "sales_fact"), warehouse.name("curated", "in_sales_order")
    # Copies of the partitions, as a table cannot be read while it is overwritten.
    facts = warehouse.spark.table(fact).filter("load_id = 'r10'").drop(LOAD_ID).collect()
    kept = warehouse.spark.createDataFrame(facts, schemas.SALES_FACT).filter("order_code = 'A'")
    tables.replace_partition(kept, fact, LOAD_ID, "r10")
    doubled = warehouse.spark.table(curated).filter("order_id = 'D'").collect()
    tables.append(warehouse.spark.createDataFrame(doubled, warehouse.spark.table(curated).schema), curated, LOAD_ID)
    found = [tuple(r)[1:] for r in warehouse.reconcile().collect()]
    assert sorted(found, key=repr) == [
        ("r10", None, 2, 1, "lost"),
        ("r11", None, 3, 2, "lost"),
        (None, dt.date(2023, 1, 1), 2, 3, "doubled"),
    ]


def test_a_damaged_packed_file_is_found_before_all_are_parsed(spark, tmp_path, source, monkeypatch):
    orders, rejects = source
    root = tmp_path / "landing"
    _drop(root, "2023-01-01", ("A", "2023-01-01", 1, "Ann"))
    folder = root / "source=IN" / "format=csv" / "date=2023-01-02"
    folder.mkdir()
    (folder / "damaged.csv.gz").write_bytes(b"\x1f\x8b\x08\x00 no file of this kind")
    attempts = []
    real = landing.stage_files
    monkeypatch.setattr(
        landing, "stage_files", lambda spark, root, paths, *more: attempts.append(paths) or real(spark, root, paths, *more)
    )
    (load,) = load_new_files(spark, str(root), INDIA, orders, rejects, str(tmp_path / "cp"))
    assert (load.rows_written, load.rows_rejected) == (1, 1)
    assert len(attempts) == 1
    assert not any(path.endswith("damaged.csv.gz") for path in attempts[0])
    (row,) = spark.table(rejects).collect()
    assert row[landing.BAD_FIELDS] == landing.UNREADABLE


def test_files_that_are_all_damaged_leave_only_rejects(spark, tmp_path, source):
    orders, rejects = source
    folder = tmp_path / "landing" / "source=IN" / "format=csv" / "date=2023-01-02"
    folder.mkdir(parents=True)
    for name in ("a.csv.gz", "b.CSV.GZ"):
        (folder / name).write_bytes(b"\x1f\x8b\x08\x00 no file of this kind")
    (load,) = load_new_files(spark, str(tmp_path / "landing"), INDIA, orders, rejects, str(tmp_path / "cp"))
    assert load.rows_written == 0
    assert spark.table(orders).count() == 0


def test_tables_are_noted_at_the_same_time(warehouse, monkeypatch):
    meeting = threading.Barrier(2, timeout=60)
    monkeypatch.setattr(Warehouse, "_note_loads", lambda self, layer, table: meeting.wait())
    warehouse.create()
    # One after the other they would never meet.
    assert warehouse.curate("first") == 0
