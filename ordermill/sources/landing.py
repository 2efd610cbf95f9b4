"""Order files in the landing area: raw scans, typed rows and rejected rows.

Layout: <root>/source=<country>/format=<csv|parquet|json>/date=<yyyy-MM-dd>/<file>.
Load-once ingestion streams the names of the files and reads those of a batch as here.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.functions.casts import CASTS, tokens_to_null
from ordermill.operators import records as cuts
from ordermill.operators.keys import label_rows, number_file_rows, spaced_key
from ordermill.rules import DEFAULT, Market, Rules
from ordermill.schemas import source_orders
from ordermill.shared import JobFailure, together

FILE, BLOCK, MODIFIED, ROW_INDEX = "_file", "_block", "_modified", "_row_index"
BAD_FIELDS, RAW = "bad_fields", "raw_record"
UNREADABLE = "file"
_CORRUPT = "_corrupt_record"
_EMPTY_ARRAY = r"^\s*\[\s*\]\s*$"
# What may stand between JSON documents and between the records of an array.
_JSON_GLUE = " \t\r\n\f,[]\ufeff"


@dataclass(frozen=True)
class Field:
    """One business field: its column, its label in named formats, its cast."""

    column: str
    label: str
    cast: str
    named_cast: str | None = None  # cast in Parquet and JSON files, if another one


# Field order of the CSV files and labels of the Parquet and JSON files.
FIELDS = (
    Field("order_id", "Order ID", "text"),
    Field("customer_name", "Customer Name", "text"),
    Field("mobile_key", "Mobile Model", "text"),
    Field("order_quantity", "Quantity", "count"),
    Field("unit_price", "Price per Unit", "whole"),
    Field("order_value", "Total Price", "whole"),
    Field("promotion_code", "Promotion Code", "text"),
    Field("final_order_amount", "Order Amount", "money"),
    Field("tax_amount", "Tax", "money", "whole_money"),
    Field("order_dt", "Order Date", "date"),
    Field("payment_status", "Payment Status", "text"),
    Field("shipping_status", "Shipping Status", "text"),
    Field("payment_method", "Payment Method", "text"),
    Field("payment_provider", "Payment Provider", "text"),
    Field("contact_no", "Phone", "text"),
    Field("shipping_address", "Delivery Address", "text"),
)

# Texts that stand for NULL.
CSV_NULL = "null"
JSON_NULLS = ("\\n", "null", "")

# Names of compressed text files end with one of these.
PACKED = (".gz", ".gzip", ".bz2", ".deflate", ".lz4", ".snappy", ".zst", ".xz")

CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "nullValue": CSV_NULL,
    "mode": "PERMISSIVE",
}


def landing_path(root: str, market: Market) -> str:
    return f"{root}/source={market.country}/format={market.file_format}"


def between_dates(df: DataFrame, since: dt.date | None, until: dt.date | None) -> DataFrame:
    """Only the files of date= folders in the range; other folders are not read."""
    if since is not None:
        df = df.filter(F.col("date") >= F.lit(since))
    if until is not None:
        df = df.filter(F.col("date") <= F.lit(until))
    return df


def _text_schema(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _lineage(*extra: Column) -> list[Column]:
    modified = F.col("_metadata.file_modification_time").cast("timestamp_ntz")
    return [
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.convert_timezone(None, F.lit("UTC"), modified).alias(MODIFIED),
        *extra,
    ]


def raw_csv(reader, path: str | list[str], base: str | None = None, multi_line: bool = False) -> DataFrame:
    """Fields by position, as text. Missing fields are NULL and further ones ignored.

    multi_line reads line breaks inside quotes, each file in one task. Without it files are
    split, which takes one line per row and is only for files that have no such line breaks.
    """
    rows = _load(
        reader.schema(_text_schema((*(f.column for f in FIELDS), _CORRUPT)))
        .options(**CSV_OPTIONS)
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .option("multiLine", multi_line)
        .format("csv"),
        path,
        base,
    )
    quotes = F.length(F.regexp_replace(_CORRUPT, '[^"]', ""))
    open_quote = F.when(quotes % 2 == 1, F.col(_CORRUPT)).alias(_CORRUPT)
    return rows.select(*(f.column for f in FIELDS), open_quote, *_lineage(), *_date(rows))


def raw_parquet(
    reader, path: str | list[str], base: str | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """Fields by label, in the types of the files, or of the schema that they agree with.

    Without one, the files are asked for all their fields, as a field may be missing in
    some; it is NULL in those.
    """
    reader = reader.option("mergeSchema", True) if schema is None else reader.schema(schema)
    rows = _load(reader.format("parquet"), path, base)
    index = F.col("_metadata.row_index").alias(ROW_INDEX)
    return rows.select(*_by_label(rows), *_lineage(index), *_date(rows))


def raw_json(
    reader,
    path: str | list[str],
    base: str | None = None,
    null_tokens: Iterable[str] = (),
    by_line: bool = False,
) -> DataFrame:
    """Fields by label, as text, of every document of a file: arrays are taken apart.

    Documents follow each other on new lines, and a file is read whole by one task. by_line
    reads files that have a complete object or array on each line; these are split like CSV
    files. A document that cannot be read is one row with its text as the corrupt record.
    """
    if by_line:
        schema = _text_schema((*(f.label for f in FIELDS), _CORRUPT))
        rows = _load(
            reader.schema(schema)
            .option("columnNameOfCorruptRecord", _CORRUPT)
            .option("mode", "PERMISSIVE")
            .format("json"),
            path,
            base,
        )
        lineage = _lineage()
    else:
        files = _load(reader.option("wholetext", True).format("text"), path, base)
        # No value holds a raw line break, so a bracket closed before one and another opened
        # after it are two documents.
        texts = F.split("value", r"(?<=[\]}])\s*\n\s*(?=[\[{])")
        documents = files.select(F.explode(texts).alias("_text"), *_lineage(), *_date(files))
        kind = T.ArrayType(_text_schema(f.label for f in FIELDS))
        parsed = documents.filter(F.trim("_text", F.lit(" \t\r\n")) != "").withColumn(
            "_found", F.from_json("_text", kind)
        )
        rows = parsed.withColumn("_row", F.explode_outer("_found"))
        rows = rows.select(
            *(F.col(f"_row.`{f.label}`").alias(f.label) for f in FIELDS),
            F.when(F.col("_row").isNull(), F.col("_text")).alias(_CORRUPT),
            FILE, BLOCK, MODIFIED, *_date(rows),
        ).filter(F.col(_CORRUPT).isNull() | ~F.col(_CORRUPT).rlike(_EMPTY_ARRAY))
        lineage = [FILE, BLOCK, MODIFIED]
    fields = _by_label(rows)
    tokens = tuple(null_tokens)
    if tokens:
        fields = [
            tokens_to_null(c, tokens).alias(f.column)
            for c, f in zip(fields, FIELDS, strict=True)
        ]
    return rows.select(*fields, F.col(_CORRUPT), *lineage, *_date(rows))


CSV_SHAPE = cuts.Shape(glue="\n", lead=False, nested=False)
JSON_SHAPE = cuts.Shape(glue="{", lead=True)


def raw_pieces(reader, path: str | list[str], shape: cuts.Shape, base: str | None = None) -> DataFrame:
    """Pieces of text files for split_csv and split_json, split into blocks like any text."""
    rows = _load(reader.option("lineSep", shape.glue).format("text"), path, base)
    return rows.select(F.col("value").alias(cuts.PIECE), *_lineage(), *_date(rows))


def _cut_records(pieces: DataFrame, effect: cuts.Effect, shape: cuts.Shape, path: str | None) -> DataFrame:
    keep = [MODIFIED, *_date(pieces)]
    return cuts.records(cuts.label_pieces(pieces, effect, path), shape, keep)


def _once(parsed: Column) -> Column:
    """parsed, made once for a row: the optimizer would parse again for each field taken of it."""
    return F.explode(F.array(parsed))


def split_csv(pieces: DataFrame, path: str | None = None) -> DataFrame:
    """Fields by position, as text, and row numbers in files that several tasks read.

    Line breaks may stand inside quotes, wherever a block ends. Lines end with LF or CRLF, the
    first record of a file is its header, and the lines of a value that a file's end leaves open
    are corrupt records, one each. path is where the labelled pieces are written.
    """
    found = _cut_records(pieces, cuts.csv_effect(F.col(cuts.PIECE)), CSV_SHAPE, path)
    line = F.rtrim(cuts.PIECE, F.lit("\r"))
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"} | {"multiLine": "true"}
    schema = _text_schema(f.column for f in FIELDS).simpleString()
    whole = F.col(cuts.ROLE) == cuts.RECORD
    rows = found.filter((F.col(cuts.NUMBER) > 0) & (F.col(cuts.ROLE) != cuts.BETWEEN)).withColumn(
        "_row", _once(F.when(whole, F.from_csv(line, schema, options)))
    )
    return rows.select(
        *(F.col(f"_row.{f.column}").alias(f.column) for f in FIELDS),
        F.when(~whole, line).alias(_CORRUPT),
        FILE, MODIFIED, *_date(rows), cuts.BEFORE, cuts.NUMBER,
    )


def split_json(
    pieces: DataFrame, null_tokens: Iterable[str] = (), path: str | None = None
) -> DataFrame:
    """Fields by label, as text, and row numbers in files that several tasks read.

    A record is an object that is in no other one, whether documents follow each other on one
    line, on several, or without a space, and whether arrays hold them. What else stands between
    them, but for commas and brackets, is a corrupt record; so is an object that cannot be read
    or has too many braces, and each piece of one that is not closed at the end of its file.
    """
    found = _cut_records(pieces, cuts.json_effect(F.col(cuts.PIECE)), JSON_SHAPE, path)
    text, role = F.col(cuts.PIECE), F.col(cuts.ROLE)
    glue = F.lit(_JSON_GLUE)
    whole = role == cuts.RECORD
    body = F.when(whole, F.rtrim(text, glue)).otherwise(F.trim(text, glue))
    after = F.trim(F.substring_index(body, "}", -1), glue)
    found = found.withColumn("_body", body).withColumn("_after", F.when(whole, after))
    # A record is followed by nothing, or by text of no record.
    inside = F.when(whole, F.substring("_body", 1, F.length("_body") - F.length(F.substring_index("_body", "}", -1))))
    texts = F.array(
        F.struct(F.coalesce(inside, F.col("_body")).alias("text"), whole.alias("whole")),
        F.struct(F.col("_after").alias("text"), F.lit(False).alias("whole")),
    )
    schema = _text_schema((*(f.label for f in FIELDS), _CORRUPT))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    rows = (
        found.withColumn("_one", F.explode(texts))
        .filter(F.col("_one.text") != "")
        .withColumn("_row", _once(F.when(F.col("_one.whole"), F.from_json("_one.text", schema, options))))
    )
    fields = [F.col(f"_row.`{f.label}`").alias(f.column) for f in FIELDS]
    tokens = tuple(null_tokens)
    if tokens:
        fields = [tokens_to_null(F.col(f"_row.`{f.label}`"), tokens).alias(f.column) for f in FIELDS]
    broken = F.when(~F.col("_one.whole"), F.col("_one.text")).otherwise(F.col(f"_row.{_CORRUPT}"))
    return rows.select(
        *fields, broken.alias(_CORRUPT), FILE, MODIFIED, *_date(rows), cuts.BEFORE,
        (F.col(cuts.NUMBER) + 1).alias(cuts.NUMBER),
    )


def _load(reader, path: str | list[str], base: str | None) -> DataFrame:
    return reader.option("basePath", base).load(path) if base else reader.load(path)


def _by_label(rows: DataFrame) -> list[Column]:
    def field(label: str) -> Column:
        return F.col(f"`{label}`") if label in rows.columns else F.lit(None).cast("string")

    return [field(f.label).alias(f.column) for f in FIELDS]


def _date(rows: DataFrame) -> list[str]:
    return ["date"] if "date" in rows.columns else []


def raw_orders(
    spark: SparkSession,
    root: str,
    market: Market,
    pieces: bool = False,
    paths: list[str] | None = None,
) -> DataFrame:
    """Raw rows of one market's files, or of the given ones among them.

    With pieces, CSV and JSON files come as text that stage_orders cuts into records, so that
    a large file is read by several tasks. Without, rows are parsed at once, a file by one task.
    Parquet files must agree in the types of their fields; stage_files takes any.
    """
    where = landing_path(root, market) if paths is None else list(map(_literal, paths))
    if pieces and market.file_format != "parquet":
        shape = CSV_SHAPE if market.file_format == "csv" else JSON_SHAPE
        return raw_pieces(spark.read, where, shape, root)
    if market.file_format == "csv":
        return raw_csv(spark.read, where, root, market.multi_line)
    if market.file_format == "json":
        return raw_json(spark.read, where, root, market.null_tokens)
    return raw_parquet(spark.read, where, root)


def _literal(path: str) -> str:
    """A path as a pattern that only it matches."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def file_names(spark: SparkSession, root: str, market: Market, **limits: object) -> DataFrame:
    """Paths of one market's files as a stream, which knows those it has seen.

    limits are options such as maxFilesPerTrigger. Contents are not read.
    """
    reader = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary"
    )
    for name, value in limits.items():
        reader = reader.option(name, value)
    return reader.load(landing_path(root, market)).select("path")


def parquet_groups(
    spark: SparkSession, paths: list[str]
) -> tuple[list[tuple[T.StructType, list[str]]], list[str]]:
    """Files by the types of their fields, and the files that have no readable schema.

    Spark merges the schemas of all files at once, in tasks; where that fails, each half of the
    files is tried. Files are tried in the order of their names, so where a type has changed
    from one day on, few attempts are needed.
    """
    try:
        found = spark.read.option("mergeSchema", True).parquet(*map(_literal, paths)).schema
    except JobFailure:
        if len(paths) == 1:
            return [], paths
        half = len(paths) // 2
        parts = together(partial(parquet_groups, spark, part) for part in (paths[:half], paths[half:]))
        groups: list[tuple[T.StructType, list[str]]] = []
        for schema, some in (group for made, _ in parts for group in made):
            for i, (known, others) in enumerate(groups):
                if all(f.dataType == known[f.name].dataType for f in schema if f.name in known.names):
                    missing = [f for f in schema if f.name not in known.names]
                    groups[i] = (T.StructType([*known, *missing]), others + some)
                    break
            else:
                groups.append((schema, some))
        return groups, [path for _, damaged in parts for path in damaged]
    labels = {f.label for f in FIELDS}
    return [(T.StructType([f for f in found if f.name in labels]), paths)], []


def compressed(paths: list[str], file_format: str) -> list[str]:
    """The text files among these that are unpacked while they are read, by their names."""
    return [] if file_format == "parquet" else [p for p in paths if p.lower().endswith(PACKED)]


def unreadable(spark: SparkSession, paths: list[str], file_format: str) -> list[str]:
    """The files that cannot be read from end to end.

    All are read at once; where that fails, each half of them is tried.
    """

    def read(some: list[str]) -> None:
        where = list(map(_literal, some))
        if file_format == "parquet":
            rows = spark.read.option("mergeSchema", True).parquet(*where)
        else:
            rows = spark.read.option("lineSep", "\n").text(where)
        rows.write.format("noop").mode("overwrite").save()

    try:
        read(paths)
    except JobFailure:
        if len(paths) == 1:
            return paths
        half = len(paths) // 2
        parts = (partial(unreadable, spark, p, file_format) for p in (paths[:half], paths[half:]))
        return [path for found in together(parts) for path in found]
    return []


def set_aside(spark: SparkSession, paths: list[str]) -> DataFrame:
    """A row for the rejects for each file that cannot be read."""
    names = spark.createDataFrame([(path,) for path in paths], f"{RAW} string")
    return names.select(
        F.lit(UNREADABLE).alias(BAD_FIELDS),
        F.lit(None).cast("string").alias(RAW),
        F.col(RAW).alias("_metadata_file_name"),
        F.lit(0).cast("bigint").alias("_metadata_row_number"),
        F.lit(None).cast("timestamp_ntz").alias("_metadata_last_modified"),
    )


def typed_orders(raw: DataFrame, named: bool, rules: Rules = DEFAULT) -> DataFrame:
    """Cast all fields; bad_fields lists those whose value does not fit, else is NULL.

    The whole row is judged, whatever columns are used later, and a bad row keeps its
    raw values as JSON text.
    """
    casts = {}
    for field in FIELDS:
        kind = field.cast
        if named and field.named_cast and rules.whole_tax_in_named_files:
            kind = field.named_cast
        casts[field.column] = CASTS[kind](F.col(field.column))
    flags = [
        F.when(F.col(name).isNotNull() & cast.isNull(), F.lit(name))
        for name, cast in casts.items()
    ]
    original = F.to_json(F.struct(*casts))
    if _CORRUPT in raw.columns:
        flags.append(F.when(F.col(_CORRUPT).isNotNull(), F.lit("record")))
        original = F.coalesce(F.col(_CORRUPT), original)
    bad = F.nullif(F.concat_ws(",", *flags), F.lit(""))
    rest = [c for c in raw.columns if c not in casts and c != _CORRUPT]
    return raw.select(
        *(cast.alias(name) for name, cast in casts.items()),
        bad.alias(BAD_FIELDS),
        F.when(bad.isNotNull(), original).alias(RAW),
        *rest,
    )


def stage_orders(
    raw: DataFrame,
    market: Market,
    rules: Rules = DEFAULT,
    start: int = 1,
    path: str | None = None,
) -> DataFrame:
    """Typed rows with row numbers in their files and keys; bad rows use up keys too.

    Parquet knows the position of a row, so these files are read in place. Pieces of text are
    written to shared storage once, in path if given, and cut into records there; rows parsed
    already are written and counted there instead.
    """
    pieces = cuts.PIECE in raw.columns
    if pieces:
        if market.file_format == "csv":
            raw = split_csv(raw, path)
        else:
            raw = split_json(raw, market.null_tokens, path)
    typed = typed_orders(raw, market.file_format != "csv", rules)
    if pieces:
        numbers = {
            "_metadata_row_number": F.col(cuts.NUMBER),
            "sales_order_key": F.col(cuts.BEFORE) + F.col(cuts.NUMBER) + (start - 1),
        }
        return _named(typed.withColumns(numbers))
    if ROW_INDEX in typed.columns:
        return _keyed_rows(typed, start)
    labelled = label_rows(typed, path)
    return _named(
        number_file_rows(labelled, FILE, BLOCK, "_metadata_row_number", "sales_order_key", start)
    )


def _named(rows: DataFrame) -> DataFrame:
    return rows.withColumnsRenamed(
        {FILE: "_metadata_file_name", MODIFIED: "_metadata_last_modified"}
    )


def _keyed_rows(typed: DataFrame, start: int) -> DataFrame:
    numbers = {"_metadata_row_number": F.col(ROW_INDEX) + 1, "sales_order_key": spaced_key(start)}
    return _named(typed.withColumns(numbers))


def stage_files(
    spark: SparkSession,
    root: str,
    paths: list[str],
    market: Market,
    rules: Rules = DEFAULT,
    start: int = 1,
) -> tuple[DataFrame | None, list[str]]:
    """stage_orders for these files, None if none is left, and the files without a schema.

    Parquet files whose fields differ in type are read in one scan for each set of types, and
    the casts, which go by the fields' names, make them one.
    """
    if market.file_format != "parquet":
        return stage_orders(raw_orders(spark, root, market, True, paths), market, rules, start), []
    groups, damaged = parquet_groups(spark, sorted(paths))
    typed = [
        typed_orders(raw_parquet(spark.read, list(map(_literal, some)), root, schema), True, rules)
        for schema, some in groups
    ]
    # Keys are made above the union, so that no two scans make the same.
    return _keyed_rows(reduce(DataFrame.unionByName, typed), start) if typed else None, damaged


def accepted(staged: DataFrame, market: Market) -> DataFrame:
    """Rows for the source table."""
    rows = staged.filter(F.col(BAD_FIELDS).isNull())
    rows = rows.withColumnRenamed("contact_no", market.contact_field)
    return rows.select(*source_orders(market.contact_field).fieldNames())


def rejected(staged: DataFrame) -> DataFrame:
    """Rows that did not fit, with the fields at fault and where they came from."""
    return staged.filter(F.col(BAD_FIELDS).isNotNull()).select(
        BAD_FIELDS,
        RAW,
        "_metadata_file_name",
        "_metadata_row_number",
        "_metadata_last_modified",
    )


def file_inventory(spark: SparkSession, root: str, extension: str = "*") -> DataFrame:
    """Files below root with their partition folder; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*.{extension}")
        .load(root)
        .select("path", "length", "modificationTime")
    )
    # Folders below root are those of the layout, name=value one after the other.
    folders = F.regexp_extract("path", r"((?:/[^/=]+=[^/]+)+)/[^/]+$", 1)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.ltrim(folders, F.lit("/")).alias("partition_dir"),
        "path",
        "length",
        F.col("modificationTime").alias("modified_at"),
    )
