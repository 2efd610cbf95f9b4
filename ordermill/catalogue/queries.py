"""The registered queries: every operator over the whole sample tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill import schemas
from ordermill.operators import dimensions as dims
from ordermill.operators import facts, filters, keys, latest, quality, rates, reconcile
from ordermill.plans.curate import curate_market, curate_orders
from ordermill.plans.warehouse import REJECTS, Warehouse
from ordermill.rules import DEFAULT, FRANCE, INDIA, PARITY, USA, Market, Rules
from ordermill.shared import cut, new_folder, replace_file, together, write_bytes
from ordermill.sources import landing, sample, sample_landing, tables
from ordermill.sources.rates import read_rates
from ordermill.streaming.load_once import LOAD_ID, load_new_files

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.date(2026, 1, 23)

# Matching of the parity preset on the markets of the default one, so that each
# difference can be checked on its own.
PARITY_MATCHING = replace(PARITY, markets=DEFAULT.markets)

BUSINESS_FIELDS = [f.column for f in landing.FIELDS]


def _paid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.paid_and_delivered(sample.sales_orders(spark, sf_dir))


def _curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate_orders(sample.sales_orders(spark, sf_dir), sample.daily_rates(spark, sf_dir))


# Curation


def curated_usd_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _curated(spark, sf_dir)


def curated_usd_orders_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source table per market; France curates the orders of the USA."""
    orders = cut(sample.sales_orders(spark, sf_dir).drop("region"), "source")
    daily = cut(sample.daily_rates(spark, sf_dir), "rates")
    curated = []
    for market in PARITY.markets:
        contact = PARITY.market(market.reads_from).contact_field
        source = filters.where_equal(orders, "country", market.reads_from)
        source = source.drop("country").withColumnRenamed("contact_no", contact)
        curated.append(curate_market(source, daily, market, PARITY))
    return facts.union_orders(*curated)


def paid_delivered_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paid(spark, sf_dir).select(
        "country", "sales_order_key", "order_dt", "payment_status", "shipping_status"
    )


def fx_full_outer_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = rates.with_rates_full(_paid(spark, sf_dir), sample.daily_rates(spark, sf_dir))
    return joined.select("country", "sales_order_key", "order_dt", "rate_dt", "usd2eu", "usd2inr")


def latest_file_per_day_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest.rank_files(_paid(spark, sf_dir)).select(
        "country", "sales_order_key", "order_dt", latest.MODIFIED, "order_rank"
    )


def latest_file_per_day_selfjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = cut(_paid(spark, sf_dir), "paid")  # read three times
    return latest.latest_by_self_join(orders).select(
        "country", "sales_order_key", "order_dt", latest.MODIFIED
    )


def latest_file_per_day_maxjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest.latest_file_per_day(_paid(spark, sf_dir)).select(
        "country", "sales_order_key", "order_dt", latest.MODIFIED
    )


def curated_union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables, of which one was appended a second time."""
    curated = cut(_curated(spark, sf_dir), "curated")
    india, usa, france = (
        filters.where_equal(curated, "country", m.country) for m in DEFAULT.markets
    )
    return facts.union_orders(india.union(india), usa, france)


# Dimensions


def _dimension(dimension: dims.Dimension, rules: Rules = DEFAULT) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return dims.build_dimension(
            dimension, _curated(spark, sf_dir), rules=rules, as_of=AS_OF
        )

    return query


def payment_dim_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded twice with plain matching: members with a NULL come in again."""
    curated = _curated(spark, sf_dir)
    once = cut(dims.build_dimension(dims.PAYMENT, curated), "payment_dim")
    again = dims.build_dimension(dims.PAYMENT, curated, once, PARITY_MATCHING)
    return once.union(again)


def dim_key_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = dims.member_counts(
        _curated(spark, sf_dir), "country", "region", "payment_method", "payment_provider"
    )
    return counts.withColumnRenamed("count", "orders")


def _incremental(dimension: dims.Dimension, first: str = "sales_order_key % 2 = 0") -> Query:
    """Load the members of some orders, of every second one by default, then those of all."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        curated = cut(_curated(spark, sf_dir), "curated")
        some = curated.filter(first)
        seed = cut(dims.build_dimension(dimension, some, as_of=AS_OF), dimension.table)
        added = dims.build_dimension(dimension, curated, seed, as_of=AS_OF)
        return seed.union(added)

    return query


# Fact


def _dimension_tables(curated: DataFrame) -> dict[str, DataFrame]:
    def build(dimension: dims.Dimension) -> DataFrame:
        return cut(dims.build_dimension(dimension, curated, as_of=AS_OF), dimension.table)

    built = together(partial(build, d) for d in dims.DIMENSIONS)
    return {d.table: rows for d, rows in zip(dims.DIMENSIONS, built, strict=True)}


def _fact(rules: Rules) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        curated = cut(_curated(spark, sf_dir), "curated")
        members = _dimension_tables(curated)
        return facts.build_fact(facts.union_orders(curated), members, rules=rules)

    return query


def fact_incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load the fact of every second order, then of all orders."""
    curated = cut(_curated(spark, sf_dir), "curated")
    members = _dimension_tables(curated)
    half = curated.filter(F.col("sales_order_key") % 2 == 0)
    loaded = cut(facts.build_fact(facts.union_orders(half), members), "sales_fact")
    start = keys.next_key(loaded, "order_id_pk")
    added = facts.build_fact(facts.union_orders(curated), members, loaded, start=start)
    return loaded.union(added)


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = sample.sales_orders(spark, sf_dir).select(
        "payment_provider", "customer_name", "sales_order_key"
    )
    return keys.assign_keys(orders, "row_key", orders.columns, start=1001)


def order_date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.order_date_bounds(sample.sales_orders(spark, sf_dir))


def customer_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = sample.table(spark, sf_dir, "customer")
    return customers.select("c_custkey", "c_name", "c_mktsegment").orderBy("c_custkey").limit(10)


# Files


def _landed(spark: SparkSession, sf_dir: str, *markets: Market) -> str:
    root = new_folder(spark, "landing")
    sample_landing.write_landing(spark, sf_dir, root, markets)
    return root


def _staged(
    spark: SparkSession, sf_dir: str, market: Market, rules: Rules = DEFAULT
) -> DataFrame:
    return _stage_all(spark, _landed(spark, sf_dir, market), market, rules)


def _stage_all(
    spark: SparkSession, root: str, market: Market, rules: Rules = DEFAULT
) -> DataFrame:
    raw = landing.raw_orders(spark, root, market, pieces=True)
    return landing.stage_orders(raw, market, rules)


def _accepted(staged: DataFrame, market: Market) -> DataFrame:
    rows = landing.accepted(staged, market)
    return rows.withColumnRenamed(market.contact_field, "contact_no").select(*BUSINESS_FIELDS)


def _ingest(market: Market, rules: Rules = DEFAULT) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _accepted(_staged(spark, sf_dir, market, rules), market)

    return query


def csv_multiline_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line breaks inside quotes, in a middle field and in the last one."""
    rows = sample_landing.file_fields(sample.sales_orders(spark, sf_dir), INDIA)
    name, address = F.col("customer_name"), F.col("shipping_address")
    rows = rows.withColumns(
        {
            "customer_name": F.when(
                F.col("_key") % 13 == 0, F.concat(F.lit("Line one\n\n"), name)
            ).otherwise(name),
            "shipping_address": F.when(
                F.col("_key") % 7 == 0, F.concat(address, F.lit('\nOld "Town"\nEnd, north'))
            ).otherwise(address),
        }
    )
    root = new_folder(spark, "landing")
    sample_landing.write_files(rows, INDIA, root)
    return _accepted(_stage_all(spark, root, INDIA), INDIA)


def json_lines_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of many documents: an object on each line, or an array over two lines."""
    rows = sample_landing.file_fields(sample.sales_orders(spark, sf_dir), FRANCE)
    record = F.to_json(F.struct(*(F.col(f.column).alias(f.label) for f in landing.FIELDS)))
    array = F.concat(F.lit("[\n"), record, F.lit("]"))
    lines = rows.select(F.when(F.col("_key") % 3 == 0, array).otherwise(record).alias("value"), "date")
    root = new_folder(spark, "landing")
    lines.write.partitionBy("date").text(landing.landing_path(root, FRANCE))
    return _accepted(_stage_all(spark, root, FRANCE), FRANCE)


def csv_split_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file a folder: quoted line breaks, stray and doubled quotes, blank lines, CRLF ends.

    Also the orders that the reading by one task gives, of which there must be the same.
    """
    rows = sample_landing.file_fields(sample.sales_orders(spark, sf_dir), INDIA)
    key = F.col("_key")
    name = F.concat(F.lit("Line one\n\n"), "customer_name")
    values = {f: F.coalesce(F.col(f), F.lit("null")) for f in BUSINESS_FIELDS}
    values["customer_name"] = F.when(key % 3 == 0, name).otherwise(F.col("customer_name"))
    quoted = ("customer_name", "shipping_address")
    for field in quoted:
        doubled = F.replace(values[field], F.lit('"'), F.lit('""'))
        values[field] = F.concat(F.lit('"'), doubled, F.lit('"'))
    values["mobile_key"] = F.when(key % 5 == 0, F.concat("mobile_key", F.lit(' 6" wide'))).otherwise(
        F.col("mobile_key")
    )
    line = F.concat_ws(",", *values.values())
    line = F.concat(F.when(key % 17 == 0, "\r\n").otherwise(""), line, F.lit("\r"))
    names = F.lit(",".join(BUSINESS_FIELDS) + "\r").alias("value")
    header = rows.select("date").distinct().select("date", names, F.lit(-1).alias("_key"))
    lines = rows.select("date", line.alias("value"), "_key").union(header)
    root = new_folder(spark, "landing")
    ordered = lines.repartition("date").sortWithinPartitions("date", "_key").select("date", "value")
    ordered.write.partitionBy("date").text(landing.landing_path(root, INDIA))

    def read(pieces: bool) -> DataFrame:
        raw = landing.raw_orders(spark, root, INDIA, pieces)
        rows = _accepted(landing.stage_orders(raw, INDIA), INDIA)
        return rows.withColumn("reading", F.lit("split" if pieces else "whole"))

    # A file by one task leaves cores idle, which the other reading takes.
    return reduce(DataFrame.unionByName, together(partial(read, pieces) for pieces in (True, False)))


def json_documents_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that follow each other on one line, with other text between some of them."""
    rows = sample_landing.file_fields(sample.sales_orders(spark, sf_dir), FRANCE)
    key = F.col("_key")
    record = F.to_json(F.struct(*(F.col(f.column).alias(f.label) for f in landing.FIELDS)))
    nested = F.concat(F.rtrim(record, F.lit("}")), F.lit(',"Lines":[{"a":{"b":"}{ ]["}},{}]}'))
    text = (
        F.when(key % 4 == 0, F.concat(F.lit("["), record, F.lit("] ")))
        .when(key % 4 == 1, F.concat(record, F.lit("\r")))
        .when(key % 4 == 2, nested)
        .otherwise(F.concat(F.lit("[\n"), nested, F.lit(", "), F.lit("\n]")))
    )
    text = F.concat(text, F.when(key % 11 == 0, F.concat(F.lit("left over "), key)).otherwise(""))
    chunk = (key / sample_landing.KEYS_PER_ARRAY).cast("bigint").alias("_chunk")
    bodies = rows.groupBy("date", chunk).agg(
        F.concat_ws("", F.array_sort(F.collect_list(text))).alias("value")
    )
    root = new_folder(spark, "landing")
    bodies.select("date", "value").write.partitionBy("date").text(landing.landing_path(root, FRANCE))
    staged = _stage_all(spark, root, FRANCE)
    good = _accepted(staged, FRANCE).withColumn(landing.RAW, F.lit(None).cast("string"))
    # Orders with a bad value are rejects too, with their fields as raw text.
    bad = landing.rejected(staged).filter(F.col(landing.BAD_FIELDS) == "record").select(landing.RAW)
    return good.unionByName(bad, allowMissingColumns=True)


def _source_tables(spark: SparkSession, market: Market) -> tuple[str, str, str]:
    """A database with a source table and its rejects."""
    name = f"load_{uuid.uuid4().hex}"
    tables.create_database(spark, name, new_folder(spark, "database"))
    loaded = T.StructField(LOAD_ID, T.StringType())
    source = schemas.source_orders(market.contact_field)
    tables.create_table(spark, f"{name}.orders", T.StructType([*source, loaded]), LOAD_ID)
    tables.create_table(spark, f"{name}.rejects", T.StructType([*REJECTS, loaded]), LOAD_ID)
    tables.create_table(spark, f"{name}.key_ranges", schemas.KEY_RANGES)
    return name, f"{name}.orders", f"{name}.rejects"


def _loaded(spark: SparkSession, name: str, market: Market) -> DataFrame:
    """What the source table of _source_tables holds; the database is dropped."""
    rows = spark.table(f"{name}.orders").withColumnRenamed(market.contact_field, "contact_no")
    batch = F.element_at(F.split(LOAD_ID, "-"), -1).alias("batch")
    found = cut(rows.select(*BUSINESS_FIELDS, "sales_order_key", batch), "loaded")
    spark.sql(f"DROP DATABASE {name} CASCADE")
    return found


def parquet_mixed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one load whose numbers, dates and amounts have differing types, by month."""
    rows = sample_landing.file_fields(sample.sales_orders(spark, sf_dir), USA)
    root = new_folder(spark, "landing")
    place = landing.landing_path(root, USA)
    by_label = {f.column: F.col(f.column).alias(f.label) for f in landing.FIELDS}
    casts = (
        {},
        {"order_quantity": "int", "unit_price": "double", "order_dt": "date"},
        {"order_quantity": "bigint", "final_order_amount": "decimal(14,2)", "tax_amount": "double"},
    )
    for i, some in enumerate(casts):
        typed = by_label | {c: F.col(c).try_cast(t).alias(_label(c)) for c, t in some.items()}
        part = rows.filter(F.col("_key") % 3 == i)
        # Values that a file's type cannot hold were never written to it.
        part = part.filter(" AND ".join(f"try_cast({c} AS {t}) IS NOT NULL" for c, t in some.items()) or "true")
        part.select(*typed.values(), "date").write.partitionBy("date").mode("append").parquet(place)
    name, table, rejects = _source_tables(spark, USA)
    load_new_files(
        spark, root, USA, table, rejects, new_folder(spark, "stream"), ranges=f"{name}.key_ranges"
    )
    return _loaded(spark, name, USA).drop("batch", "sales_order_key")


def _label(column: str) -> str:
    return next(f.label for f in landing.FIELDS if f.column == column)


def damaged_file_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A damaged file in each format is set aside while the others load, and loads once repaired."""
    orders = cut(sample.sales_orders(spark, sf_dir), "orders")

    def ingested(market: Market) -> DataFrame:
        root = new_folder(spark, "landing")
        sample_landing.write_files(sample_landing.file_fields(orders, market), market, root)
        place = f"{landing.landing_path(root, market)}/date=2000-01-01"
        ending = {"csv": "csv.gz", "json": "json.gz", "parquet": "parquet"}[market.file_format]
        damaged = f"{place}/damaged.{ending}"
        write_bytes(spark, damaged, b"\x1f\x8b\x08\x00 no file of this kind")
        name, table, rejects = _source_tables(spark, market)
        checkpoint = new_folder(spark, "stream")

        def load() -> int:
            loads = load_new_files(
                spark, root, market, table, rejects, checkpoint, ranges=f"{name}.key_ranges"
            )
            return sum(done.rows_written for done in loads)

        load()
        aside = spark.table(rejects).filter(F.col(landing.BAD_FIELDS) == landing.UNREADABLE).count()
        again = load()
        good = (F.lit(v).alias(f.column) for f, v in zip(landing.FIELDS, REPAIRED, strict=True))
        one = spark.range(1).select(
            F.col("id").alias("_key"), F.lit(dt.date(2000, 1, 1)).alias("date"), *good
        )
        repaired = new_folder(spark, "repaired")
        sample_landing.write_files(one, market, repaired, "gzip" if "gz" in ending else None)
        replace_file(spark, repaired, damaged)
        repaired_rows, last = load(), load()
        rows = _loaded(spark, name, market)
        keys_ = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("sales_order_key").alias("keys"))
        counts = keys_.select(
            F.lit(market.country).alias("country"), "rows", (F.col("rows") == F.col("keys")).alias("unique"),
            F.lit(aside).alias("set_aside"), F.lit(again).alias("again"),
            F.lit(repaired_rows).alias("repaired"), F.lit(last).alias("last"),
        )
        return cut(counts, "counts")

    return reduce(DataFrame.unionByName, together(partial(ingested, m) for m in DEFAULT.markets))


# The order that a repaired file holds.
REPAIRED = (
    "ORD-R", "Ann", "b/m/c/64", "1", "100", "100", "PROMO1", "100.00", "8.00", "2000-01-02",
    "Paid", "Delivered", "card", "visa", "PH-1", "Main St 1",
)


def _rejects(market: Market) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = landing.rejected(_staged(spark, sf_dir, market))
        raw = (F.get_json_object(landing.RAW, f"$.{c}").alias(c) for c in BUSINESS_FIELDS)
        return rows.select(landing.BAD_FIELDS, *raw)

    return query


def json_null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON variant in which some texts stand for NULL."""
    orders = sample.sales_orders(spark, sf_dir).withColumns(
        {
            "payment_provider": F.coalesce("payment_provider", F.lit("")),
            "promotion_code": F.coalesce("promotion_code", F.lit("null")),
            "shipping_address": F.when(F.col("sales_order_key") % 3 == 0, r"\n").otherwise(
                F.col("shipping_address")
            ),
        }
    )
    root = new_folder(spark, "landing")
    sample_landing.write_files(sample_landing.file_fields(orders, FRANCE), FRANCE, root)
    raw = landing.raw_json(
        spark.read, landing.landing_path(root, FRANCE), root, landing.JSON_NULLS
    )
    return raw.select("order_id", "payment_provider", "promotion_code", "shipping_address")


def file_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row numbers of each folder's files: from 1 on, without gaps or repetitions."""
    root = _landed(spark, sf_dir, *DEFAULT.markets)
    staged = None
    for market in DEFAULT.markets:
        rows = _stage_all(spark, root, market)
        rows = rows.select(F.lit(market.country).alias("country"), "date", *_LINEAGE_COLUMNS)
        staged = rows if staged is None else staged.union(rows)
    number = F.col("_metadata_row_number")
    rows = F.count(F.lit(1))
    per_file = staged.groupBy("country", "date", "_metadata_file_name").agg(
        rows.alias("rows"),
        ((F.min(number) == 1) & (F.max(number) == rows)).alias("dense"),
        (F.sum(number) * 2 == rows * (rows + 1)).alias("consecutive"),
        F.count("_metadata_last_modified").alias("with_time"),
    )
    return per_file.groupBy("country", "date").agg(
        F.sum("rows").alias("rows"),
        F.every("dense").alias("dense"),
        F.every("consecutive").alias("consecutive"),
        F.sum("with_time").alias("with_time"),
    )


_LINEAGE_COLUMNS = ["_metadata_file_name", "_metadata_row_number", "_metadata_last_modified"]


def landing_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = landing.file_inventory(spark, _landed(spark, sf_dir, *DEFAULT.markets))
    found = files.filter(F.col("partition_dir") != "")
    return found.groupBy("partition_dir").agg(F.every(F.col("length") > 0).alias("has_data"))


def landing_date_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the folders of three years are read."""
    raw = landing.raw_orders(spark, _landed(spark, sf_dir, INDIA), INDIA)
    some = landing.between_dates(raw, dt.date(1996, 1, 1), dt.date(1998, 1, 1))
    return some.select("date", "order_id", "customer_name")


def incremental_file_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of files and three calls, of which the last finds nothing new."""
    name, table, rejects = _source_tables(spark, INDIA)
    root, checkpoint = new_folder(spark, "landing"), new_folder(spark, "stream")
    rows = sample_landing.file_fields(sample.sales_orders(spark, sf_dir), INDIA)
    for drop in (F.col("_key") % 2 == 0, F.col("_key") % 2 == 1, None):
        if drop is not None:
            sample_landing.write_files(rows.filter(drop), INDIA, root)
        load_new_files(
            spark, root, INDIA, table, rejects, checkpoint, ranges=f"{name}.key_ranges"
        )
    found = _loaded(spark, name, INDIA)
    return found.select(*BUSINESS_FIELDS, F.col("batch").cast("int").alias("batch"))


def exchange_rate_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "rates")
    sample_landing.write_rates(spark, sf_dir, path, "echange_rate_dt")
    return read_rates(spark, path)


def append_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days before 1998 are appended before the table has a day counter."""
    name = f"append_{uuid.uuid4().hex}"
    tables.create_database(spark, name, new_folder(spark, "database"))
    table = f"{name}.date_dim"
    tables.create_table(spark, table, schemas.DATE_DIM)
    days = cut(
        dims.build_dimension(dims.DATE, sample.sales_orders(spark, sf_dir)), "date_dim"
    )
    early, late = F.col("order_year") < 1998, F.col("order_year") >= 1998
    backwards = list(reversed(schemas.DATE_DIM.fieldNames()))
    tables.append(days.filter(early).select(*backwards), table)
    tables.add_column(spark, table, "day_counter", T.LongType())
    tables.append(days.filter(late).select("day_counter", *backwards), table)
    return tables.scan(spark, table)


# Checks


def dim_pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = cut(dims.build_dimension(dims.CUSTOMER, _curated(spark, sf_dir)), "customer_dim")
    planted = members.union(members.filter(F.col("customer_id_pk") % 50 == 0))
    found = quality.duplicate_keys(planted, "customer_id_pk")
    return found.withColumnRenamed("count", "rows")


def fact_fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some members are taken out of three dimensions."""
    curated = cut(_curated(spark, sf_dir), "curated")
    members = _dimension_tables(curated)
    fact = facts.fact_rows(facts.union_orders(curated), members)
    for name, key, every in (
        ("payment_dim", "payment_id_pk", 7),
        ("product_dim", "product_id_pk", 10),
        ("customer_dim", "customer_id_pk", 100),
    ):
        members[name] = members[name].filter(F.col(key) % every != 0)
    return quality.orphans(fact, members)


def missing_rate_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_rates(_curated(spark, sf_dir))


def layer_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads whose facts are not their curated orders, after some were lost, doubled or changed."""
    curated = cut(_curated(spark, sf_dir), "curated")
    fact = facts.fact_rows(curated, _dimension_tables(curated))
    load, key = (F.col("sales_order_key") % 97).alias(LOAD_ID), F.col("sales_order_key")
    lost, doubled, changed = (key % 970 == 0), (key % 776 == 8), (key % 873 == 20)
    quantity = F.col("order_quantity") + F.when(changed, 1).otherwise(0)
    copies = F.explode(F.when(doubled, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    fact = fact.filter(~lost).withColumn("order_quantity", quantity).withColumn("copy", copies)
    # Orders without a day have no fact.
    dated = curated.filter(F.col("order_dt").isNotNull())
    return reconcile.differences(
        dated.select("*", load), fact.select("*", load), [LOAD_ID], reconcile.FACT_CONTENT
    )


def _moving_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample rates that move a little each day, with planted jumps, stale and swapped rates."""
    day = F.dayofyear("rate_dt")
    moved = {}
    for name in sample.RATE_COLUMNS[1:]:
        units = (F.col(name) * rates.UNITS).cast("bigint")
        moved[name] = units + (day * 37 % 41 - 20) * F.expr(f"cast({name} * {rates.UNITS} AS bigint) div 20000")
    moved["usd2uk"] += F.when(day % 97 == 0, 3_000_000).otherwise(0)
    moved["usd2jp"] = F.when(day.between(40, 50), 1_185_000_000).otherwise(moved["usd2jp"])
    swapped = day % 113 == 0
    moved["usd2eu"], moved["usd2can"] = (
        F.when(swapped, moved["usd2can"]).otherwise(moved["usd2eu"]),
        F.when(swapped, moved["usd2eu"]).otherwise(moved["usd2can"]),
    )
    unit = F.lit("0.0000001").cast("decimal(8,7)")
    values = (
        (v.cast("decimal(18,0)") * unit).cast("decimal(10,7)").alias(n) for n, v in moved.items()
    )
    return sample.daily_rates(spark, sf_dir).select("rate_dt", "usd2usd", *values)


def rate_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.rate_outliers(_moving_rates(spark, sf_dir))


def wrong_dollars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders curated with rates of which some were not those of their day."""
    key = F.col("sales_order_key")
    curated = _curated(spark, sf_dir)
    cent = F.lit("0.00000001").cast("decimal(9,8)")
    dollars = F.col("us_total_order_amt")
    tampered = curated.withColumns(
        {
            "us_total_order_amt": F.when(key % 101 == 0, dollars + cent).otherwise(dollars).cast("decimal(23,8)"),
            "exchange_rate": F.when(key % 103 != 0, F.col("exchange_rate")),
        }
    )
    found = rates.wrong_dollars(tampered, sample.daily_rates(spark, sf_dir))
    return found.select(
        "country", "sales_order_key", "exchange_rate", "expected_exchange_rate",
        "us_total_order_amt", "expected_us_total_order_amt",
    )


def warehouse_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job twice over all files: what the tables hold after the second run."""
    root = _landed(spark, sf_dir, *DEFAULT.markets)
    rate_files = new_folder(spark, "rates")
    sample_landing.write_rates(spark, sf_dir, rate_files, "date")
    warehouse = Warehouse(spark, new_folder(spark, "warehouse"), f"w{uuid.uuid4().hex}_")
    checkpoint = new_folder(spark, "stream")
    for run in ("first", "second"):
        warehouse.run(root, rate_files, checkpoint, run, AS_OF)
    fact = warehouse.table("consumption", "sales_fact")
    members = {d.table: warehouse.table("consumption", d.table) for d in dims.DIMENSIONS}
    counts = []
    for market in DEFAULT.markets:
        loaded = warehouse.table("source", market.source_table)
        bad = warehouse.table("source", f"{market.source_table}_rejects")
        counts += [(f"{market.country} source", loaded), (f"{market.country} rejects", bad)]
        audited = warehouse.audit("source", market.source_table)
        audited = audited.agg(F.sum("rows_written").alias("rows"))
        held = loaded.agg(F.count(F.lit(1)).alias("rows"))
        counts.append((f"{market.country} audit wrong", audited.exceptAll(held)))
    curated = [warehouse.table("curated", m.source_table) for m in DEFAULT.markets]
    dated = facts.union_orders(*curated).filter(F.col("order_dt").isNotNull())
    counts += [
        ("exchange rates", warehouse.table("common", "exchange_rate")),
        ("orphans", quality.orphans(fact, members)),
        ("facts beyond curated", fact.select("order_code").exceptAll(dated.select("order_id"))),
        ("curated beyond facts", dated.select("order_id").exceptAll(fact.select("order_code"))),
        ("repeated fact keys", quality.duplicate_keys(fact, "order_id_pk")),
        ("late loads", fact.filter(F.col(LOAD_ID) != "first")),
    ]
    counts += [
        (f"repeated {name}", quality.duplicate_keys(rows, rows.columns[0]))
        for name, rows in members.items()
    ]

    def count(label: str, rows: DataFrame) -> DataFrame:
        row = rows.agg(F.count(F.lit(1)).alias("rows"))
        return cut(row.select(F.lit(label).alias("what"), "rows"), "count")

    # One plan over all of them would be planned anew after each of its many stages.
    return reduce(DataFrame.union, together(partial(count, *pair) for pair in counts))


class _Interrupted(Warehouse):
    """A job that is lost after it has written curated rows, before it notes them."""

    def _note(self, table: str, load_id: str, written: int, rejected: int = 0) -> None:
        if table.startswith(f"{self.prefix}curated."):
            raise RuntimeError("planted failure")
        super()._note(table, load_id, written, rejected)


def _after_two_drops(spark: SparkSession, sf_dir: str, interrupted: bool) -> Warehouse:
    """A warehouse after two drops of files; the first run over the first one may break off."""
    root, rate_files = new_folder(spark, "landing"), new_folder(spark, "rates")
    sample_landing.write_rates(spark, sf_dir, rate_files, "date")
    place = (new_folder(spark, "warehouse"), f"w{uuid.uuid4().hex}_")
    checkpoint = new_folder(spark, "stream")
    orders = cut(sample.sales_orders(spark, sf_dir), "orders")
    for drop in (0, 1):
        some = orders.filter(F.col("sales_order_key") % 2 == drop)
        together(
            partial(sample_landing.write_files, sample_landing.file_fields(some, m), m, root)
            for m in DEFAULT.markets
        )
        # The drop's files get one time, so all its orders of a day are latest together.
        sample_landing.stamp_new_files(spark, root, dt.datetime(2026, 1, 20 + drop))
        if interrupted and drop == 0:
            try:
                _Interrupted(spark, *place).run(root, rate_files, checkpoint, "lost", AS_OF)
            except RuntimeError as lost:
                if "planted" not in str(lost):
                    raise
        Warehouse(spark, *place).run(root, rate_files, checkpoint, f"run{drop}", AS_OF)
    warehouse = Warehouse(spark, *place)
    warehouse.run(root, rate_files, checkpoint, "again", AS_OF)
    return warehouse


def _orders_of(warehouse: Warehouse, fact: DataFrame) -> DataFrame:
    """Fact rows with what their keys stand for."""
    for key, dimension in facts.FOREIGN_KEYS.items():
        members = warehouse.table("consumption", dimension.table)
        if dimension is not dims.REGION:
            members = members.drop("country", "region")
        fact = fact.join(members, fact[key] == members[dimension.key])
    return fact.select(
        "order_code", "order_dt", "country", "region", "customer_name", "contact_no",
        "shipping_address", "payment_method", "payment_provider", "mobile_key", "promotion_code",
        "order_quantity", "local_total_order_amt", "local_tax_amt", "exchange_rate",
        "us_total_order_amt", "usd_tax_amt",
    )


def warehouse_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts after two drops of files, of which the first run over the first one breaks off."""
    warehouse = _after_two_drops(spark, sf_dir, interrupted=True)
    return _orders_of(warehouse, warehouse.table("consumption", "sales_fact"))


def fact_replaced_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current facts after two drops: those of the second one on all days that it has."""
    warehouse = _after_two_drops(spark, sf_dir, interrupted=False)
    return _orders_of(warehouse, warehouse.current("consumption", "sales_fact"))


QUERIES: dict[str, Query] = {
    "curated_usd_orders": curated_usd_orders,
    "curated_usd_orders_parity": curated_usd_orders_parity,
    "paid_delivered_filter": paid_delivered_filter,
    "fx_full_outer_join": fx_full_outer_join,
    "latest_file_per_day_rank": latest_file_per_day_rank,
    "latest_file_per_day_selfjoin": latest_file_per_day_selfjoin,
    "latest_file_per_day_maxjoin": latest_file_per_day_maxjoin,
    "curated_union_distinct": curated_union_distinct,
    "region_dim": _dimension(dims.REGION),
    "region_dim_parity": _dimension(dims.REGION, PARITY_MATCHING),
    "product_dim": _dimension(dims.PRODUCT),
    "promo_code_dim": _dimension(dims.PROMO_CODE),
    "customer_dim": _dimension(dims.CUSTOMER),
    "payment_dim": _dimension(dims.PAYMENT),
    "payment_dim_parity": payment_dim_parity,
    "date_dim": _dimension(dims.DATE),
    "date_dim_parity": _dimension(dims.DATE, PARITY_MATCHING),
    "dim_key_counts": dim_key_counts,
    "dim_incremental_load": _incremental(dims.CUSTOMER),
    "dim_incremental_load_nulls": _incremental(dims.PAYMENT),
    "region_dim_incremental": _incremental(dims.REGION, "country = 'IN'"),
    "product_dim_incremental": _incremental(dims.PRODUCT),
    "promo_code_dim_incremental": _incremental(dims.PROMO_CODE, "country = 'IN' AND promotion_code > 'PROMO3'"),
    "date_dim_incremental": _incremental(dims.DATE, "order_dt < DATE'1995-07-01'"),
    "sales_fact": _fact(DEFAULT),
    "sales_fact_parity": _fact(PARITY_MATCHING),
    "fact_incremental_append": fact_incremental_append,
    "surrogate_keys": surrogate_keys,
    "order_date_bounds": order_date_bounds,
    "customer_sample": customer_sample,
    "csv_ingest": _ingest(INDIA),
    "parquet_ingest": _ingest(USA),
    "parquet_ingest_parity": _ingest(USA, PARITY),
    "json_ingest": _ingest(FRANCE),
    "csv_multiline_ingest": csv_multiline_ingest,
    "csv_split_multiline": csv_split_multiline,
    "json_documents_ingest": json_documents_ingest,
    "parquet_mixed_types": parquet_mixed_types,
    "damaged_file_ingest": damaged_file_ingest,
    "json_lines_ingest": json_lines_ingest,
    "csv_rejects": _rejects(INDIA),
    "json_rejects": _rejects(FRANCE),
    "json_null_tokens": json_null_tokens,
    "file_lineage": file_lineage,
    "landing_inventory": landing_inventory,
    "landing_date_pruning": landing_date_pruning,
    "incremental_file_load": incremental_file_load,
    "exchange_rate_load": exchange_rate_load,
    "append_by_name": append_by_name,
    "dim_pk_duplicates": dim_pk_duplicates,
    "fact_fk_orphans": fact_fk_orphans,
    "missing_rate_audit": missing_rate_audit,
    "layer_reconciliation": layer_reconciliation,
    "rate_outliers": rate_outliers,
    "wrong_dollars": wrong_dollars,
    "warehouse_rerun": warehouse_rerun,
    "warehouse_recovery": warehouse_recovery,
    "fact_replaced_days": fact_replaced_days,
}
