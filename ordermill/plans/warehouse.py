"""The whole job over catalog tables: ingest, curate, model, audit.

Every stage works on what is new. Source, curated and fact rows lie in partitions named
by the load that wrote them; audit.load_progress says which loads a later stage has
taken up. A stage that failed half-way is repeated by the next run and replaces or
recognises what it had already written.

A day that gets a newer file or a late rate is curated again as a whole. Its earlier rows stay
in their partitions, so nothing is rewritten; audit.retracted_days notes the days of the loads
that hold them, and the current_ views leave these rows out.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import partial, reduce
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill import schemas
from ordermill.operators.dimensions import (
    DATE,
    DIMENSIONS,
    REGION,
    Dimension,
    build_dimension,
    match,
    new_members,
)
from ordermill.operators.facts import build_fact, union_orders
from ordermill.operators.filters import paid_and_delivered, tag_market
from ordermill.operators.keys import next_start, note_range
from ordermill.operators.latest import latest_file_per_day
from ordermill.operators.reconcile import FACT_CONTENT, SOURCE_CONTENT, differences
from ordermill.plans.curate import curate_market
from ordermill.rules import DEFAULT, Market, Rules
from ordermill.shared import broadcast_if_small, cut, scratch, shuffles_for, together
from ordermill.sources import tables
from ordermill.sources.rates import read_rates
from ordermill.streaming.load_once import LOAD_ID, Load, load_new_files

LAYERS = ("source", "curated", "consumption", "audit", "common")

# A curated row follows from its order and the rates of its day.
CURATED_IDENTITY = ["sales_order_key", "exchange_rate", "us_total_order_amt", "usd_tax_amt"]


def _with_load(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema, T.StructField(LOAD_ID, T.StringType())])


REJECTS = T.StructType(
    [
        T.StructField("bad_fields", T.StringType()),
        T.StructField("raw_record", T.StringType()),
        *(T.StructField(name, kind) for name, kind in schemas.LINEAGE),
    ]
)


@dataclass(frozen=True)
class Warehouse:
    """Databases of the layers share a prefix; location is their common folder.

    Plain Parquet tables have no transactions: run one job at a time.
    """

    spark: SparkSession
    location: str
    prefix: str = "sales_"
    rules: Rules = DEFAULT
    # Two appends to one folder at a time would remove each other's unfinished files.
    _audit_lock: Lock = field(default_factory=Lock, repr=False, compare=False)

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}{layer}.{table}"

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def create(self) -> None:
        """Create what is missing; existing tables keep their data."""
        for layer in LAYERS:
            tables.create_database(
                self.spark, f"{self.prefix}{layer}", f"{self.location}/{layer}"
            )
        for market in self.rules.markets:
            orders = schemas.source_orders(market.contact_field)
            self._loaded_table("source", market.source_table, orders)
            self._loaded_table("source", f"{market.source_table}_rejects", REJECTS)
            self._loaded_table("curated", market.source_table, schemas.CURATED_ORDERS)
        for dimension in DIMENSIONS:
            self._table("consumption", dimension.table, dimension.schema)
        tables.add_column(
            self.spark, self.name("consumption", DATE.table), "day_counter", T.LongType()
        )
        self._loaded_table("consumption", "sales_fact", schemas.SALES_FACT)
        self._table("audit", "load_audit", schemas.LOAD_AUDIT)
        self._table("audit", "load_progress", schemas.LOAD_PROGRESS)
        self._table("audit", "key_ranges", schemas.KEY_RANGES)
        self._table("audit", "load_days", schemas.LOAD_DAYS)
        self._table("audit", "retracted_days", schemas.RETRACTED_DAYS)
        self._table("common", "exchange_rate", schemas.EXCHANGE_RATE)
        for market in self.rules.markets:
            self._current_view(
                "curated", market.source_table,
                "SELECT load_id, country, day FROM {gone}",
                "g.load_id = t.load_id AND g.country <=> t.country AND g.day <=> t.order_dt",
            )
        self._current_view(
            "consumption", "sales_fact",
            "SELECT r.load_id, date_id_pk, region_id_pk FROM {gone} AS r"
            " JOIN {dates} AS d ON d.order_dt = r.day JOIN {regions} AS n ON n.country = r.country",
            "g.load_id = t.load_id AND g.date_id_pk = t.date_id_fk AND g.region_id_pk = t.region_id_fk",
        )

    def _current_view(self, layer: str, table: str, gone: str, same: str) -> None:
        """The table without its retracted days, which are few rows per load."""
        noted = self.name("audit", "retracted_days")
        days = gone.format(
            gone=f"(SELECT * FROM {noted} WHERE table_name = '{self.name(layer, table)}')",
            dates=self.name("consumption", DATE.table),
            regions=self.name("consumption", REGION.table),
        )
        self.spark.sql(
            f"CREATE VIEW IF NOT EXISTS {self.name(layer, f'current_{table}')} AS"
            f" SELECT t.* FROM {self.name(layer, table)} AS t"
            f" WHERE NOT EXISTS (SELECT 1 FROM ({days}) AS g WHERE {same})"
        )

    def current(self, layer: str, table: str) -> DataFrame:
        """Rows of a curated table or the fact whose day no later load has replaced."""
        return self.table(layer, f"current_{table}")

    def _table(self, layer: str, table: str, schema: T.StructType) -> None:
        tables.create_table(self.spark, self.name(layer, table), schema)

    def _loaded_table(self, layer: str, table: str, schema: T.StructType) -> None:
        tables.create_table(self.spark, self.name(layer, table), _with_load(schema), LOAD_ID)

    # Audit

    def _note(self, table: str, load_id: str, written: int, rejected: int = 0) -> None:
        row = self.spark.range(1).select(
            F.lit(table).alias("table_name"),
            F.lit(load_id).alias("load_id"),
            F.lit(written).cast("bigint").alias("rows_written"),
            F.lit(rejected).cast("bigint").alias("rows_rejected"),
            F.localtimestamp().alias("loaded_at"),
        )
        with self._audit_lock:
            tables.append(row, self.name("audit", "load_audit"))

    def audit(self, layer: str, table: str) -> DataFrame:
        """What each load wrote to a table; a load that was repeated counts by its last note."""
        notes = self.table("audit", "load_audit").filter(
            F.col("table_name") == self.name(layer, table)
        )
        last = F.max_by(F.struct("rows_written", "rows_rejected", "loaded_at"), "loaded_at")
        return notes.groupBy("table_name", "load_id").agg(last.alias("last")).select(
            "table_name", "load_id", "last.*"
        )

    def _note_growth(self, layer: str, table: str, load_id: str) -> None:
        """Note what the table has beyond all other loads' notes.

        So rows that a lost attempt has appended without a note are noted by the next one.
        """
        total = self.table(layer, table).count()
        others = self.audit(layer, table).filter(F.col("load_id") != load_id)
        known = others.agg(F.coalesce(F.sum("rows_written"), F.lit(0))).first()[0]
        self._note(self.name(layer, table), load_id, total - known)

    def _note_loads(self, layer: str, table: str) -> None:
        """Note the loads that a table holds without a note, as a lost attempt leaves them."""
        noted = self.audit(layer, table).select(F.col("load_id").alias("value"))
        held = tables.partition_values(self.spark, self.name(layer, table))
        for (load_id,) in held.join(noted, "value", "left_anti").collect():
            rows = self.table(layer, table).filter(F.col(LOAD_ID) == load_id).count()
            self._note(self.name(layer, table), load_id, rows)

    def _pending(self, layer: str, table: str, stage: str) -> DataFrame:
        """Loads that the table holds and the stage has not taken up.

        The table's own partitions say what it holds, whether it was noted or not.
        """
        held = tables.partition_values(self.spark, self.name(layer, table))
        taken = self.table("audit", "load_progress").filter(F.col("stage") == stage)
        pending = held.select(F.col("value").alias(LOAD_ID)).join(taken, LOAD_ID, "left_anti")
        return cut(pending, "pending")

    def _rows(self, layer: str, table: str, loads: DataFrame | None) -> int:
        """Rows of these loads of a table, or of all, as noted."""
        found = self.audit(layer, table)
        if loads is not None:
            found = found.join(loads, LOAD_ID, "left_semi")
        return found.agg(F.coalesce(F.sum("rows_written"), F.lit(0))).first()[0]

    def days(self, layer: str, table: str) -> DataFrame:
        """The days of each load of a table: a few rows per load instead of its orders."""
        noted = self.table("audit", "load_days")
        return noted.filter(F.col("table_name") == self.name(layer, table))

    def _note_days(self, layer: str, table: str) -> None:
        """Note the days of loads that have none noted; only their partitions are read."""
        held = tables.partition_values(self.spark, self.name(layer, table))
        held = held.select(F.col("value").alias(LOAD_ID))
        new = cut(held.join(self.days(layer, table), LOAD_ID, "left_anti"), "new_loads")
        if new.isEmpty():
            return
        rows = _of_loads(self.table(layer, table), new)
        if layer == "curated":
            unpriced = F.coalesce(F.bool_or(F.col("us_total_order_amt").isNull()), F.lit(False))
        else:
            unpriced = F.lit(False)
        days = rows.groupBy(LOAD_ID, F.col("order_dt").alias("day")).agg(unpriced.alias("unpriced"))
        named = days.withColumn("table_name", F.lit(self.name(layer, table)))
        made = cut(named.select(*schemas.LOAD_DAYS.fieldNames()), "load_days")
        with self._audit_lock:
            tables.append(made, self.name("audit", "load_days"))

    def retracted(self, layer: str, table: str) -> DataFrame:
        """The days of each load of a table that a later load has replaced."""
        noted = self.table("audit", "retracted_days")
        return noted.filter(F.col("table_name") == self.name(layer, table))

    def _note_retracted(self, layer: str, table: str, days: DataFrame) -> None:
        """Note days that are not noted yet."""
        columns = [LOAD_ID, "country", "day"]
        new = new_members(days.select(*columns), self.retracted(layer, table), columns)
        named = new.withColumn("table_name", F.lit(self.name(layer, table)))
        made = cut(named.select(*schemas.RETRACTED_DAYS.fieldNames()), "retracted")
        with self._audit_lock:
            tables.append_new(made, self.name("audit", "retracted_days"))

    def _complete(self, run_id: str) -> bool:
        stage = self.name("consumption", "sales_fact")
        same = (F.col("stage") == stage) & (F.col("load_id") == run_id)
        return not self.table("audit", "load_progress").filter(same).isEmpty()

    def _take(self, stage: str, loads: DataFrame) -> None:
        done = loads.select(F.lit(stage).alias("stage"), LOAD_ID)
        with self._audit_lock:
            tables.append(done, self.name("audit", "load_progress"))

    # Stages

    @property
    def replaces_days(self) -> bool:
        return self.rules.replace_days and self.rules.incremental_fact

    def load_rates(self, path: str) -> int:
        """Add the days of a rate file that the rate table does not have yet."""
        known = self.table("common", "exchange_rate")
        with scratch(self.spark, "rates"):
            fresh = new_members(read_rates(self.spark, path), known, ["rate_dt"])
            rows = tables.append_new(cut(fresh, "rates"), self.name("common", "exchange_rate"))
        self._note_growth("common", "exchange_rate", path)
        return rows

    def ingest(self, landing_root: str, checkpoint_root: str, **limits: object) -> int:
        """Load the new files of all markets."""

        def load(market: Market) -> int:
            table = self.name("source", market.source_table)

            def audit(done: Load) -> None:
                self._note(table, done.load_id, done.rows_written, done.rows_rejected)

            loads = load_new_files(
                self.spark,
                landing_root,
                market,
                table,
                f"{table}_rejects",
                f"{checkpoint_root}/{market.source_table}",
                self.rules,
                audit,
                self.name("audit", "key_ranges"),
                **limits,
            )
            return sum(done.rows_written for done in loads)

        return sum(together(partial(load, market) for market in self.rules.markets))

    def curate(self, run_id: str) -> int:
        """Curate the days that new files or late rates have touched, in all markets."""
        if self._complete(run_id):
            raise ValueError(f"run {run_id} is complete, choose another name")
        with scratch(self.spark, "curate"):
            rows = 0
            held = {("source", self.rules.market(m.reads_from).source_table) for m in self.rules.markets}
            held |= {("curated", m.source_table) for m in self.rules.markets}

            def note(layer: str, table: str) -> None:
                self._note_loads(layer, table)
                self._note_days(layer, table)

            together(partial(note, *table) for table in sorted(held))
            for market in self.rules.markets:
                source = self.rules.market(market.reads_from).source_table
                stage = self.name("curated", market.source_table)
                rows += self._rows("source", source, self._pending("source", source, stage))
            # As wide as what is new; days curated again add the other orders of these days.
            with shuffles_for(self.spark, rows):
                return sum(
                    together(partial(self._curate, m, run_id) for m in self.rules.markets)
                )

    def touched_orders(self, market: Market, pending: DataFrame) -> tuple[DataFrame, DataFrame] | None:
        """Source and curated rows of the days that pending loads or late rates touch, if any.

        Whole days are curated again. The noted days of the loads say which partitions hold
        them, and only these are read.
        """
        source = self.rules.market(market.reads_from).source_table
        noted, curated = self.days("source", source), self.days("curated", market.source_table)
        gone = self.retracted("curated", market.source_table)
        curated = new_members(curated, gone, [LOAD_ID, "day"])
        rates = self.table("common", "exchange_rate")
        days = noted.join(pending, LOAD_ID, "left_semi").select("day")
        unpriced = curated.filter("unpriced").select("day")
        days = days.union(unpriced.join(rates, F.col("day") == F.col("rate_dt"), "left_semi"))
        days = broadcast_if_small(days.distinct())
        if days.isEmpty():
            return None

        def on_days(layer: str, table: str, loads: DataFrame) -> DataFrame:
            holding = loads.withColumnRenamed("day", "order_dt")
            holding = _on_days(holding.select("order_dt", LOAD_ID), days).select(LOAD_ID).distinct()
            return _on_days(_of_loads(self.table(layer, table), holding), days)

        known = on_days("curated", market.source_table, curated)
        gone = gone.select(LOAD_ID, F.col("day").alias("order_dt"))
        known = new_members(known, gone, [LOAD_ID, "order_dt"])
        return on_days("source", source, noted), known

    def _curate(self, market: Market, run_id: str) -> int:
        reads_from = self.rules.market(market.reads_from)
        stage = self.name("curated", market.source_table)
        pending = self._pending("source", reads_from.source_table, stage)
        touched = self.touched_orders(market, pending)
        if touched is None:
            return 0
        source, known = touched
        rates = self.table("common", "exchange_rate")
        curated = curate_market(source, rates, market, self.rules)
        # Narrow, and none at all for days that are new.
        known = broadcast_if_small(known.select(*CURATED_IDENTITY, LOAD_ID, "country", "order_dt"))
        fresh = new_members(curated, known, CURATED_IDENTITY)
        rows = tables.append(fresh.withColumn(LOAD_ID, F.lit(run_id)), stage, LOAD_ID)
        if self.replaces_days:
            replaced = replaced_days(known, curated)
            self._note_retracted("curated", market.source_table, replaced)
        # A repeated run adds to what its lost attempt has written under its name.
        whole = self.table("curated", market.source_table).filter(F.col(LOAD_ID) == run_id)
        self._note(stage, run_id, whole.count())
        self._take(stage, pending)
        return rows

    def model(self, run_id: str, as_of: dt.date) -> int:
        """Extend dimensions and fact by the curated rows not modelled yet.

        Each curated load becomes the fact partition of the same name. Strict parity
        models all curated orders again in every run.
        """
        curated = [m.source_table for m in self.rules.markets]
        stage = self.name("consumption", "sales_fact")
        with scratch(self.spark, "model"):
            together(partial(self._note_loads, "curated", table) for table in curated)
            if not self.rules.incremental_fact:
                rows = sum(self._rows("curated", table, None) for table in curated)
                with shuffles_for(self.spark, rows):
                    return self._model(None, run_id, as_of)
            pending = {table: self._pending("curated", table, stage) for table in curated}
            rows = sum(self._rows("curated", table, some) for table, some in pending.items())
            loads = reduce(DataFrame.union, pending.values()).distinct().sort(LOAD_ID)
            written = 0
            with shuffles_for(self.spark, rows):
                for (load_id,) in loads.collect():
                    written += self._model(load_id, load_id, as_of)
                    self._take(stage, loads.filter(F.col(LOAD_ID) == load_id))
            # The rows that replace them are there by now.
            if self.replaces_days:
                for table in curated:
                    replaced = self.retracted("curated", table)
                    self._note_retracted("consumption", "sales_fact", replaced)
            return written

    def _model(self, curated_load: str | None, fact_load: str, as_of: dt.date) -> int:
        orders = []
        for market in self.rules.markets:
            rows = self.table("curated", market.source_table)
            if curated_load is not None:
                rows = rows.filter(F.col(LOAD_ID) == curated_load)
            orders.append(rows.drop(LOAD_ID))
        # Repeated rows do not change a dimension; only the fact needs them removed.
        every = orders[0]
        for other in orders[1:]:
            every = every.unionByName(other)

        def extend(dimension: Dimension) -> int:
            name = self.name("consumption", dimension.table)
            known = self.spark.table(name)
            fresh = build_dimension(dimension, every, known, self.rules, as_of)
            return tables.append_new(fresh, name)

        together(partial(extend, d) for d in DIMENSIONS)
        together(
            partial(self._note_growth, "consumption", d.table, fact_load) for d in DIMENSIONS
        )
        members = {d.table: self.table("consumption", d.table) for d in DIMENSIONS}
        name, ranges = self.name("consumption", "sales_fact"), self.name("audit", "key_ranges")
        start = next_start(self.spark.table(ranges), name, fact_load)
        facts = build_fact(
            # A curated load has each order once, which saves shuffling whole rows.
            union_orders(*orders) if curated_load is None else every,
            members,
            rules=self.rules,
            start=start,
            ordered=False,
        )
        seen = tables.replace_and_see(
            facts, name, LOAD_ID, fact_load,
            rows=F.count(F.lit(1)), last=F.coalesce(F.max("order_id_pk"), F.lit(start - 1)),
        )
        note_range(self.spark, ranges, name, fact_load, start, seen["last"])
        self._note(name, fact_load, seen["rows"])
        return seen["rows"]

    def reconcile(self) -> DataFrame:
        """Where the layers do not hold the same orders: table, load or day, rows and verdict.

        Facts are compared with the curated orders of each load, and the current curated orders
        of each day with the latest paid and delivered ones of the source. Only loads that the
        later layer has taken up count. Empty where nothing was lost, doubled or changed;
        parity keeps superseded orders, so there only facts are compared.
        """
        fact = self.name("consumption", "sales_fact")
        taken = self.table("audit", "load_progress")
        modelled = taken.filter(F.col("stage") == fact).select(LOAD_ID)
        curated = [self.table("curated", m.source_table) for m in self.rules.markets]
        # Orders without a day have no fact.
        dated = reduce(DataFrame.unionByName, curated).filter(F.col("order_dt").isNotNull())
        found = [
            differences(
                _of_loads(dated, modelled), _of_loads(self.spark.table(fact), modelled),
                [LOAD_ID], FACT_CONTENT,
            ).withColumn("table_name", F.lit(fact)).withColumn("day", F.lit(None).cast("date"))
        ]
        for market in self.rules.markets if self.replaces_days else ():
            name = self.name("curated", market.source_table)
            source = self.table("source", self.rules.market(market.reads_from).source_table)
            orders = _of_loads(source, taken.filter(F.col("stage") == name).select(LOAD_ID))
            latest = latest_file_per_day(paid_and_delivered(tag_market(orders, market)))
            days = differences(
                latest.withColumn("day", F.col("order_dt")),
                self.current("curated", market.source_table).withColumn("day", F.col("order_dt")),
                ["day"], SOURCE_CONTENT,
            )
            found.append(
                days.withColumn("table_name", F.lit(name)).withColumn(LOAD_ID, F.lit(None).cast("string"))
            )
        columns = ("table_name", LOAD_ID, "day", "expected_rows", "found_rows", "verdict")
        return reduce(DataFrame.unionByName, (rows.select(*columns) for rows in found))

    def run(
        self,
        landing_root: str,
        rates_path: str,
        checkpoint_root: str,
        run_id: str,
        as_of: dt.date | None = None,
        **limits: object,
    ) -> dict[str, int]:
        """One complete run; any error ends it."""
        self.create()
        return {
            "rates": self.load_rates(rates_path),
            "ingested": self.ingest(landing_root, checkpoint_root, **limits),
            "curated": self.curate(run_id),
            "facts": self.model(run_id, as_of or dt.date.today()),
        }


def replaced_days(known: DataFrame, curated: DataFrame) -> DataFrame:
    """Days of earlier loads that have known rows, but none that a day's new curation keeps.

    Orders of a day and load come from files of one time and get their rates together, so a
    newer file or a late rate replaces all of them or none.
    """
    days = [LOAD_ID, "country", F.col("order_dt").alias("day")]
    rows = curated.select(*(F.col(c).alias(f"_new_{c}") for c in CURATED_IDENTITY))
    pairs = {c: f"_new_{c}" for c in CURATED_IDENTITY}
    kept = known.join(rows, match(known, rows, pairs, True), "left_semi")
    return new_members(
        known.select(*days).distinct(), kept.select(*days).distinct(), [LOAD_ID, "country", "day"]
    )


def _of_loads(rows: DataFrame, loads: DataFrame) -> DataFrame:
    """Rows of these loads; their partitions are found when the query runs.

    The planner looks for them if the other side selects something, which the comparison says.
    """
    some = broadcast_if_small(loads.select(LOAD_ID)).filter(F.col(LOAD_ID) >= "")
    return rows.join(some, LOAD_ID, "left_semi")


def _on_days(orders: DataFrame, days: DataFrame) -> DataFrame:
    return orders.join(days, match(orders, days, {"order_dt": "day"}, True), "left_semi")
