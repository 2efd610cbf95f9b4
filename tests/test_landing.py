"""Order files written by hand and read back."""

import datetime as dt
import gzip
import json
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ordermill.rules import FRANCE, INDIA, PARITY, USA
from ordermill.sources import landing
from ordermill.sources.rates import canonical_rates, read_rates

HEADER = ",".join(f.column for f in landing.FIELDS)
LABELS = [f.label for f in landing.FIELDS]
CLEAN = [
    "A1", "Ann", "b/m/c/64", "2", "100", "200", "P1", "199.99", "1.50", "2023-01-05",
    "Paid", "Delivered", "card", "visa", "123", "Main St 1",
]


def _line(**changes):
    names = [f.column for f in landing.FIELDS]
    return ",".join(changes.get(n, v) for n, v in zip(names, CLEAN, strict=True))


def _csv(tmp_path, *lines, date="2023-01-05", name="order-1.csv"):
    folder = tmp_path / "source=IN" / "format=csv" / f"date={date}"
    folder.mkdir(parents=True, exist_ok=True)
    text = "\n".join([HEADER, *lines]) + "\n"
    if name.endswith(".gz"):
        (folder / name).write_bytes(gzip.compress(text.encode()))
    else:
        (folder / name).write_text(text)
    return str(tmp_path)


def _stage(spark, root, market=INDIA, **kwargs):
    raw = landing.raw_orders(spark, root, market, pieces=True)
    return landing.stage_orders(raw, market, **kwargs)


def test_clean_row(spark, tmp_path):
    row = landing.accepted(_stage(spark, _csv(tmp_path, _line())), INDIA).first()
    assert row["order_quantity"] == 2
    assert row["final_order_amount"] == Decimal("199.99")
    assert row["tax_amount"] == Decimal("1.50")
    assert row["order_dt"] == dt.date(2023, 1, 5)
    assert row["mobile"] == "123"
    assert row["_metadata_file_name"].endswith("order-1.csv")
    assert row["_metadata_row_number"] == 1
    assert row["_metadata_last_modified"] is not None


def test_null_tokens_empty_fields_and_quotes(spark, tmp_path):
    root = _csv(
        tmp_path,
        _line(order_id="A1", promotion_code="null"),
        _line(order_id="A2", promotion_code=""),
        _line(order_id="A3", promotion_code='""'),
        _line(order_id="A4", promotion_code='"x, ""y"""'),
    )
    rows = landing.accepted(_stage(spark, root), INDIA).collect()
    codes = {r["order_id"]: r["promotion_code"] for r in rows}
    assert codes == {"A1": None, "A2": None, "A3": "", "A4": 'x, "y"'}


def test_bad_rows_are_set_aside_whole(spark, tmp_path):
    root = _csv(
        tmp_path,
        _line(order_id="good"),
        _line(order_id="b1", order_quantity="abc"),
        _line(order_id="b2", order_dt="05/01/2023"),
        _line(order_id="b3", final_order_amount="123456789012.00", unit_price="x"),
        _line(order_id="rounded", unit_price="199.99", order_value="2.5"),
    )
    staged = _stage(spark, root)
    good = {r["order_id"]: r for r in landing.accepted(staged, INDIA).collect()}
    assert set(good) == {"good", "rounded"}
    assert good["rounded"]["unit_price"] == 200
    assert good["rounded"]["order_value"] == 3
    bad = {
        json.loads(r["raw_record"])["order_id"]: (r["bad_fields"], r["_metadata_row_number"])
        for r in landing.rejected(staged).collect()
    }
    assert bad == {
        "b1": ("order_quantity", 2),
        "b2": ("order_dt", 3),
        "b3": ("unit_price,final_order_amount", 4),
    }


def test_bad_row_is_found_when_its_column_is_not_used(spark, tmp_path):
    root = _csv(tmp_path, _line(), _line(order_quantity="abc"))
    good = landing.accepted(_stage(spark, root), INDIA)
    assert good.select("customer_name").count() == 1


def test_short_and_long_lines(spark, tmp_path):
    root = _csv(tmp_path, "A1,Ann,b/m/c/64,2", _line(order_id="A2") + ",more,and more")
    rows = {r["order_id"]: r for r in landing.accepted(_stage(spark, root), INDIA).collect()}
    assert rows["A1"]["shipping_address"] is None
    assert rows["A2"]["shipping_address"] == "Main St 1"


def test_line_breaks_in_quotes_are_read(spark, tmp_path):
    last = '"Main\nOld Town\nEnd"'
    root = _csv(tmp_path, _line(), _line(order_id="A2", shipping_address=last), _line(order_id="A3", customer_name='"A\n\nB"'))
    staged = _stage(spark, root)
    assert landing.rejected(staged).isEmpty()
    rows = {r["order_id"]: r for r in landing.accepted(staged, INDIA).collect()}
    assert rows.keys() == {"A1", "A2", "A3"}
    assert rows["A2"]["shipping_address"] == "Main\nOld Town\nEnd"
    assert rows["A3"]["customer_name"] == "A\n\nB"


def test_json_documents_on_several_lines(spark, tmp_path):
    one = json.dumps(_records(spark, **{"Order ID": "J1"}))
    two = json.dumps([_records(spark, **{"Order ID": "J2"}), _records(spark, **{"Order ID": "J3"})], indent=1)
    texts = [one, two, "{broken", json.dumps(_records(spark, **{"Order ID": "J4", "Customer Name": "}{ ]["}))]
    folder = tmp_path / "source=FR" / "format=json" / "date=2023-01-05"
    folder.mkdir(parents=True)
    (folder / "order-1.json").write_text("\n".join(texts[:2]) + "\n\n" + texts[3] + "\n")
    (folder / "order-2.json").write_text("[]")
    (folder / "order-3.json").write_text("\n".join([one.replace("J1", "J5"), texts[2]]))
    staged = _stage(spark, str(tmp_path), FRANCE)
    found = {r["order_id"] for r in landing.accepted(staged, FRANCE).collect()}
    assert found == {"J1", "J2", "J3", "J4", "J5"}
    assert [(r["bad_fields"], r["raw_record"]) for r in landing.rejected(staged).collect()] == [
        ("record", "{broken")
    ]


def test_compressed_file(spark, tmp_path):
    root = _csv(tmp_path, _line(), name="order-1.csv.gz")
    assert landing.accepted(_stage(spark, root), INDIA).count() == 1


def test_date_folders_are_pruned(spark, tmp_path):
    for day in ("2023-01-05", "2023-01-06", "2023-01-07"):
        root = _csv(tmp_path, _line(order_id=day), date=day)
    raw = landing.raw_orders(spark, root, INDIA)
    some = landing.between_dates(raw, dt.date(2023, 1, 6), dt.date(2023, 1, 6))
    assert [r["order_id"] for r in some.collect()] == ["2023-01-06"]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_row_numbers_of_split_files(spark, tmp_path):
    """Files of many blocks, all read by several tasks, numbered as they were written."""
    for file in range(3):
        lines = [_line(order_id=f"{file}-{i}") for i in range(1, 2001 + 100 * file)]
        root = _csv(tmp_path, *lines, name=f"order-{file}.csv")
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "20000")
    try:
        raw = landing.raw_orders(spark, root, replace(INDIA, multi_line=False))
        assert raw.rdd.getNumPartitions() > 10
        rows = landing.accepted(landing.stage_orders(raw, INDIA, start=501), INDIA).cache()
        wrong = rows.filter(
            F.split("order_id", "-")[1].cast("bigint") != F.col("_metadata_row_number")
        )
        assert wrong.isEmpty()
        low, high, distinct = rows.agg(
            F.min("sales_order_key"), F.max("sales_order_key"), F.count_distinct("sales_order_key")
        ).first()
        assert (low, high, distinct) == (501, 6800, 6300)
    finally:
        spark.conf.set(size, before)


def _records(spark, **changes):
    values = dict(zip(LABELS, CLEAN, strict=True))
    values.update(changes)
    return values


def test_parquet_by_name_in_any_column_order_and_type(spark, tmp_path):
    folder = tmp_path / "source=US" / "format=parquet" / "date=2023-01-05"
    typed = (
        spark.createDataFrame([tuple(reversed(CLEAN))], list(reversed(LABELS)))
        .withColumn("Quantity", F.lit(2).cast("int"))
        .withColumn("Price per Unit", F.lit(2.5))
        .withColumn("Tax", F.lit("7.50").cast("decimal(12,4)"))
        .withColumn("Order Date", F.lit(dt.date(2023, 1, 5)))
    )
    typed.write.parquet(str(folder))
    row = landing.accepted(_stage(spark, str(tmp_path), USA), USA).first()
    assert (row["order_quantity"], row["unit_price"]) == (2, 3)
    assert row["tax_amount"] == Decimal("7.50")
    assert (row["order_dt"], row["phone"]) == (dt.date(2023, 1, 5), "123")
    strict = landing.accepted(_stage(spark, str(tmp_path), USA, rules=PARITY), USA).first()
    assert strict["tax_amount"] == Decimal("8.00")


def test_field_missing_in_some_parquet_files(spark, tmp_path):
    folder = tmp_path / "source=US" / "format=parquet"
    all_fields = spark.createDataFrame([tuple(CLEAN)], LABELS)
    all_fields.write.parquet(str(folder / "date=2023-01-06"))
    all_fields.drop("Promotion Code", "Phone").write.parquet(str(folder / "date=2023-01-05"))
    rows = landing.accepted(_stage(spark, str(tmp_path), USA), USA).collect()
    assert sorted((r["promotion_code"] or "", r["phone"] or "") for r in rows) == [
        ("", ""),
        ("P1", "123"),
    ]


def _json(tmp_path, text, name="order-1.json"):
    folder = tmp_path / "source=FR" / "format=json" / "date=2023-01-05"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    return str(tmp_path)


def test_json_array_is_taken_apart(spark, tmp_path):
    records = [
        _records(spark, **{"Order ID": "A1", "Price per Unit": 199.99}),
        _records(spark, **{"Order ID": "A2", "Promotion Code": None}),
        _records(spark, **{"Order ID": "A3", "Quantity": "abc"}),
    ]
    root = _json(tmp_path, json.dumps(records, indent=1))
    staged = _stage(spark, root, FRANCE)
    rows = {r["order_id"]: r for r in landing.accepted(staged, FRANCE).collect()}
    assert set(rows) == {"A1", "A2"}
    assert rows["A1"]["unit_price"] == 200
    assert rows["A2"]["promotion_code"] is None
    assert [rows[k]["_metadata_row_number"] for k in ("A1", "A2")] == [1, 2]
    assert landing.rejected(staged).first()["_metadata_row_number"] == 3


def test_broken_json_file_is_rejected(spark, tmp_path):
    root = _json(tmp_path, '[{"Order ID": "A1", ')
    _json(tmp_path, json.dumps([_records(spark)]), name="order-2.json")
    staged = _stage(spark, root, FRANCE)
    assert landing.accepted(staged, FRANCE).count() == 1
    assert [r["bad_fields"] for r in landing.rejected(staged).collect()] == ["record"]


def test_json_by_line(spark, tmp_path):
    lines = [json.dumps(_records(spark, **{"Order ID": f"A{i}"})) for i in range(3)]
    arrays = f"[{lines[0]},{lines[1]}]\n{lines[2]}\n"
    root = _json(tmp_path, arrays)
    raw = landing.raw_json(spark.read, landing.landing_path(root, FRANCE), by_line=True)
    assert {r["order_id"] for r in raw.collect()} == {"A0", "A1", "A2"}


def test_json_null_tokens(spark, tmp_path):
    root = _json(tmp_path, json.dumps([_records(spark, **{"Phone": "", "Order ID": "null"})]))
    path = landing.landing_path(root, FRANCE)
    plain = landing.raw_json(spark.read, path).first()
    assert (plain["contact_no"], plain["order_id"]) == ("", "null")
    cleaned = landing.raw_json(spark.read, path, null_tokens=landing.JSON_NULLS).first()
    assert (cleaned["contact_no"], cleaned["order_id"]) == (None, None)


def test_inventory(spark, tmp_path):
    _csv(tmp_path, _line())
    root = _json(tmp_path, "[]")
    found = landing.file_inventory(spark, root, "csv").collect()
    assert [(r["file_name"], r["partition_dir"]) for r in found] == [
        ("order-1.csv", "source=IN/format=csv/date=2023-01-05")
    ]
    assert landing.file_inventory(spark, root).count() == 2


@pytest.mark.parametrize("day", ["date", "echange_rate_dt"])
def test_rates_under_either_header(spark, tmp_path, day):
    path = tmp_path / "rates.csv"
    path.write_text(
        f"{day},usd2usd,usd2eu,usd2can,usd2uk,usd2inr,usd2jp\n"
        "2023-04-30,1,0.9250,1.4120,0.7610,71.3750,119.2500\n"
    )
    row = read_rates(spark, str(path)).first()
    assert (row["rate_dt"], row["usd2inr"]) == (dt.date(2023, 4, 30), Decimal("71.3750"))
    table = spark.read.option("header", True).csv(str(path))
    assert canonical_rates(table).columns[0] == "rate_dt"


def test_repeated_rate_day_stops_the_load(spark, tmp_path):
    path = tmp_path / "rates.csv"
    path.write_text("date,a,b,c,d,e,f\n" + "2023-04-30,1,1,1,1,1,1\n" * 2)
    with pytest.raises(ValueError, match="rate_dt"):
        read_rates(spark, str(path))


def test_market_formats_can_be_changed(spark, tmp_path):
    """A market may deliver another format than it does by default."""
    other = replace(FRANCE, country="IN", file_format="csv")
    root = _csv(tmp_path, _line())
    assert landing.accepted(_stage(spark, root, other), other).first()["phone"] == "123"
