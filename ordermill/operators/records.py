"""Records of large text files that several tasks read, cut by their structure.

A file is read as pieces that end at one character (a line feed, or the brace that opens an
object), which Spark splits into blocks like any text file. Whether a piece begins a record
depends on all that stands before it in its file: is a quoted value open, and how many braces?
So each piece is given its effect on that state; effects are combined within chunks of pieces,
the chunks' effects along their file, and every piece then learns the state it begins in.

State: a quoted value is open (1) or not (0), and a depth that never falls below zero.
Effect of a piece: the quote state after it, if it begins in state 0 (end0) or 1 (end1), and
what it adds to the depth in either case (add0, add1), rises before falls.

Most chunks hold nothing but whole records; no row of these is shuffled. The windows run over
the narrow effects, and over the texts of the other chunks only. A record of several pieces is
put together by its number, whatever blocks it lies in.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.operators.keys import SLOT
from ordermill.shared import broadcast_if_small, cut

FILE, BLOCK, PIECE = "_file", "_block", "_piece"
NUMBER, ROLE, BEFORE = "_number", "_role", "_records_before"
RECORD, PART, BETWEEN = "record", "part", "between"

CHUNK = "_chunk"
CHUNK_PIECES = 4096
_PLACE = [FILE, BLOCK, CHUNK]


@dataclass(frozen=True)
class Effect:
    """Columns of a piece's effect; skip marks one that begins no record in state 0, depth 0."""

    end0: Column
    end1: Column
    add0: Column
    add1: Column
    skip: Column


@dataclass(frozen=True)
class Shape:
    """How pieces make records.

    lead: the character in front of every piece but a file's first one, if it belongs to the
    piece (else pieces are joined by glue). The first piece then stands before all records.
    nested: pieces may change the depth.
    """

    glue: str
    lead: bool
    nested: bool = True

    @property
    def first_depth(self) -> int:
        return -1 if self.lead else 0


def label_pieces(pieces: DataFrame, effect: Effect, path: str | None = None) -> DataFrame:
    """Write pieces of a file scan to shared storage, with their places and effects."""
    slot = F.monotonically_increasing_id()
    labelled = pieces.withColumns(
        {
            SLOT: slot,
            "end0": effect.end0.cast("tinyint"),
            "end1": effect.end1.cast("tinyint"),
            "add0": effect.add0.cast("int"),
            "add1": effect.add1.cast("int"),
            "skip": effect.skip,
        }
    )
    return cut(labelled, "pieces", path).withColumn(CHUNK, F.floor(F.col(SLOT) / CHUNK_PIECES))


def _states(rows: DataFrame, window: Window) -> DataFrame:
    """Quote states after (after0, after1) and before (state0, state1) each row of a window.

    The two columns are for either state at the window's start. A row keeps, turns or fixes the
    state; since the last one that fixed it, turns count.
    """
    upto = window.rowsBetween(Window.unboundedPreceding, 0)
    turns = (F.col("end0") == 1) & (F.col("end1") == 0)
    rows = rows.withColumn("_turns", F.sum(turns.cast("int")).over(upto))
    fixed = F.when(F.col("end0") == F.col("end1"), F.struct(F.col("end0").alias("v"), F.col("_turns").alias("t")))
    rows = rows.withColumn("_fixed", F.last(fixed, True).over(upto))
    found = {}
    for start in (0, 1):
        found[f"after{start}"] = F.when(
            F.col("_fixed").isNull(), (F.col("_turns") + start) % 2
        ).otherwise((F.col("_fixed.v") + F.col("_turns") - F.col("_fixed.t")) % 2)
    rows = rows.withColumns(found).drop("_turns", "_fixed")
    return rows.withColumns(
        {f"state{s}": F.coalesce(F.lag(f"after{s}").over(window), F.lit(s)) for s in (0, 1)}
    )


def _depths(rows: DataFrame, window: Window) -> DataFrame:
    """Running sums and least sums of the depth, for either state at the window's start."""
    upto = window.rowsBetween(Window.unboundedPreceding, 0)
    adds = {f"_add{s}": F.when(F.col(f"state{s}") == 0, F.col("add0")).otherwise(F.col("add1")) for s in (0, 1)}
    rows = rows.withColumns(adds)
    rows = rows.withColumns({f"sum{s}": F.sum(f"_add{s}").over(upto) for s in (0, 1)})
    return rows.withColumns({f"low{s}": F.min(f"sum{s}").over(upto) for s in (0, 1)})


def _in_chunks() -> Window:
    return Window.partitionBy(*_PLACE).orderBy(SLOT)


def _chunks(labelled: DataFrame, shape: Shape) -> DataFrame:
    """One row per chunk: its pieces, whether they are all neutral, and its effect if so.

    Neutral pieces leave state 0 and the depth there as they are. Begun in state 1, a chunk of
    them ends in state 0 if a piece does.
    """
    neutral = (F.col("end0") == 0) & (F.col("add0") == 0) & ((F.col("end1") == 1) | (F.col("add1") == 0))
    head = F.min_by(F.struct("end0", "end1", "add0", "skip"), SLOT)
    chunks = labelled.groupBy(*_PLACE).agg(
        F.min(SLOT).alias("first"),
        F.count(F.lit(1)).alias("pieces"),
        F.sum((~neutral).cast("int")).alias("odd"),
        F.sum(F.col("skip").cast("int")).alias("skips"),
        F.sum("add1").alias("sum1"),
        F.min("end1").alias("min1"),
        head.alias("_head"),
    )
    in_file = Window.partitionBy(FILE).orderBy(BLOCK, CHUNK)
    plain_head = (F.col("_head.end0") == 0) & (F.col("_head.end1") == 1) & (F.col("_head.add0") == 1)
    is_first = F.row_number().over(in_file) == 1
    with_head = is_first & plain_head & F.lit(shape.lead)
    return chunks.withColumns({"head": with_head.cast("int"), "is_first": is_first}).select(
        *_PLACE, "first", "pieces", "head", "sum1", "min1", "is_first",
        (F.col("odd") == F.col("head")).alias("neutral"),
        (F.col("skips") - (with_head & F.col("_head.skip")).cast("int")).alias("skips"),
    )


def _along_files(chunks: DataFrame, effects: DataFrame, shape: Shape) -> DataFrame:
    """chunks with the state and depth that each begins and ends in."""
    known = chunks.join(effects, _PLACE, "left").select(
        *_PLACE, "first", "pieces", "head", "neutral", "skips",
        F.coalesce("after0", F.lit(0)).alias("end0"),
        F.coalesce("after1", "min1").alias("end1"),
        F.coalesce("total0", "head").alias("total0"),
        F.coalesce("total1", "sum1").alias("total1"),
        F.coalesce("least0", "head").alias("least0"),
        F.coalesce("least1", "sum1").alias("least1"),
        "begun0", "begun1",
    )
    in_file = Window.partitionBy(FILE).orderBy(BLOCK, CHUNK)
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    rows = _states(known, in_file).withColumns(
        {
            "total": F.when(F.col("state0") == 0, F.col("total0")).otherwise(F.col("total1")),
            "least": F.when(F.col("state0") == 0, F.col("least0")).otherwise(F.col("least1")),
        }
    )
    raw = F.coalesce(F.sum("total").over(earlier), F.lit(0)) + shape.first_depth
    rows = rows.withColumn("_raw", raw)
    rows = rows.withColumn("_low", F.min(F.col("_raw") + F.col("least")).over(earlier))
    depth = F.col("_raw") - F.least(F.lit(0), F.coalesce("_low", F.lit(0)))
    rows = rows.withColumn("depth", depth)
    after = F.col("depth") + F.col("total") - F.least(F.lit(0), F.col("depth") + F.col("least"))
    # Without windows it is known what such a chunk begins: all its pieces, or none.
    calm = F.col("neutral") & ((F.col("state0") == 0) | (F.col("end1") == 1))
    return rows.select(
        *_PLACE, "first", "pieces", "head", "skips", calm.alias("calm"),
        F.col("state0").alias("state"), "depth",
        F.when(F.col("state0") == 0, F.col("begun0")).otherwise(F.col("begun1")).alias("known"),
        F.col("after0").alias("last_state"),
        after.alias("last_depth"),
    )


def _placed(rows: DataFrame) -> DataFrame:
    """Pieces, joined with their chunk's state and depth, with begins, open, outside and bad."""
    window = _in_chunks()
    rows = _depths(_states(rows, window), window)

    def of(name: str) -> Column:
        return F.when(F.col("state") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))

    after = F.col("depth") + of("sum") - F.least(F.lit(0), F.col("depth") + of("low"))
    rows = rows.withColumns(
        {"_before": of("state"), "_after": of("after"), "_add": of("_add"), "_depth": after}
    )
    rows = rows.withColumn("_was", F.coalesce(F.lag("_depth").over(window), F.col("depth")))
    level = (F.col("_before") == 0) & (F.col("_was") <= 0)
    begins = level & (F.col("_was") == 0) & ~F.col("skip")
    return rows.withColumns(
        {
            "begins": begins,
            "outside": level & ~begins,
            "open": (F.col("_after") == 1) | (F.col("_depth") > 0),
            # More closing braces than open ones.
            "bad": begins & (F.col("_add") < 0) | ~level & (F.col("_was") + F.col("_add") < 0),
        }
    )


def _begun(narrow: DataFrame, chunks: DataFrame, shape: Shape) -> DataFrame:
    """chunks with the number of records that each begins, by windows over the narrow effects."""
    window = _in_chunks()
    odd = chunks.where("NOT neutral").select(*_PLACE)
    sums = _depths(_states(narrow.join(odd, _PLACE, "left_semi"), window), window)
    # Without depths, the state at a chunk's start says which of its pieces begin records.
    starts = {s: F.lit(not shape.nested) & (F.col(f"state{s}") == 0) & ~F.col("skip") for s in (0, 1)}
    found = sums.groupBy(*_PLACE).agg(
        *(F.max_by(c, SLOT).alias(c) for c in ("after0", "after1")),
        *(F.max_by(f"sum{s}", SLOT).alias(f"total{s}") for s in (0, 1)),
        *(F.min(f"low{s}").alias(f"least{s}") for s in (0, 1)),
        *(
            (F.lit(None) if shape.nested else F.sum(starts[s].cast("long"))).cast("long").alias(f"begun{s}")
            for s in (0, 1)
        ),
    )
    chunks = cut(_along_files(chunks, found, shape), "states")
    odd = chunks.where("NOT calm AND known IS NULL").select(*_PLACE, "state", "depth")
    counts = _placed(narrow.join(odd, _PLACE)).groupBy(*_PLACE).agg(
        F.sum(F.col("begins").cast("long")).alias("begun")
    )
    level = (F.col("state") == 0) & (F.col("depth") + F.col("head") == 0)
    own = F.col("pieces") - F.col("skips") - F.col("head")
    return chunks.join(counts, _PLACE, "left").select(
        *_PLACE, "first", "head", "state", "depth", "last_state", "last_depth",
        F.coalesce("known", "begun", F.when(level, own), F.lit(0)).cast("long").alias("begun"),
        (F.col("calm") & level & (F.col("skips") == 0)).alias("whole"),
    )


def records(labelled: DataFrame, shape: Shape, keep: list[str]) -> DataFrame:
    """Records of label_pieces' rows: their text (PIECE), number from 0 in their file, and role.

    A RECORD is whole. A PART is a piece of one that its file's end leaves open, or a record
    with more ends than beginnings. BETWEEN are pieces outside all records; they have the
    number of the record before them. BEFORE counts the records of the files before.
    keep names columns that are constant in a file.
    """
    effects = ["end0", "end1", "add0", "add1", "skip"]
    # Tables of chunks have a row for thousands of pieces; the optimizer knows their sizes.
    chunks = cut(_chunks(labelled, shape), "chunks")
    headless = F.col("is_first") & (F.col("head") != int(shape.lead))
    plain = chunks.where(~F.col("neutral") | (F.col("skips") > 0) | headless).isEmpty()
    window = _in_chunks()
    if plain:
        # Every piece is a record, as in most batches of files: nothing has to be worked out.
        begun = F.col("pieces") - F.col("head")
        chunks = chunks.select(
            *_PLACE, "first", "head", begun.alias("begun"), F.lit(True).alias("whole"),
            *(F.lit(0).alias(c) for c in ("state", "depth", "last_state", "last_depth")),
        )
    else:
        # Read twice below, by chunk and by file.
        chunks = cut(_begun(labelled.select(*_PLACE, SLOT, *effects), chunks, shape), "begun")
    in_file = Window.partitionBy(FILE).orderBy(BLOCK, CHUNK)
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("offset", F.coalesce(F.sum("begun").over(earlier), F.lit(0)))
    last = F.struct("last_state", "last_depth")
    files = chunks.groupBy(FILE).agg(
        F.sum("begun").alias("_total"),
        F.max_by(last, F.struct(BLOCK, CHUNK)).alias("_last"),
    )
    # One row per file.
    before = Window.orderBy(FILE).rowsBetween(Window.unboundedPreceding, -1)
    left_open = (F.col("_last.last_state") == 1) | (F.col("_last.last_depth") > 0)
    files = files.select(
        F.col(FILE),
        F.coalesce(F.sum("_total").over(before), F.lit(0)).alias(BEFORE),
        F.when(left_open, F.col("_total") - 1).alias("_open_record"),
    )
    places = broadcast_if_small(
        chunks.join(files, FILE).select(
            *_PLACE, "first", "head", "whole", "state", "depth", "offset", BEFORE, "_open_record"
        )
    )
    texts = labelled.select(*_PLACE, SLOT, PIECE, *effects, *keep).join(places, _PLACE)
    columns = [FILE, *keep, BEFORE, NUMBER, ROLE, PIECE]
    lead = F.lit(shape.glue if shape.lead else "")

    # Chunks of whole records: the place says the number.
    at = F.col(SLOT) - F.col("first") - F.col("head")
    simple = texts.where("whole").select(
        FILE, *keep, BEFORE,
        (F.col("offset") + F.greatest(at, F.lit(0))).cast("long").alias(NUMBER),
        F.when(at < 0, BETWEEN).otherwise(RECORD).alias(ROLE),
        F.when(at < 0, F.col(PIECE)).otherwise(F.concat(lead, PIECE)).alias(PIECE),
    )

    if plain:
        return simple.select(*columns)

    upto = window.rowsBetween(Window.unboundedPreceding, 0)
    begun = F.col("offset") + F.sum(F.col("begins").cast("long")).over(upto)
    number = F.greatest(begun - 1, F.lit(0))
    placed = _placed(texts.where("NOT whole")).withColumn(NUMBER, number)
    unclosed = F.coalesce(F.col(NUMBER) == F.col("_open_record"), F.lit(False))
    role = (
        F.when(F.col("outside"), BETWEEN)
        .when(unclosed | F.col("begins") & ~F.col("open") & F.col("bad"), PART)
        .when(F.col("begins") & ~F.col("open"), RECORD)
    )
    placed = cut(
        placed.withColumn(ROLE, role).select(
            FILE, *keep, BEFORE, NUMBER, ROLE, BLOCK, SLOT, "bad",
            F.when(F.col("outside"), F.col(PIECE)).otherwise(F.concat(lead, PIECE)).alias(PIECE),
        ),
        "placed",
    )
    single = placed.where(F.col(ROLE).isNotNull()).select(*columns)
    pieces = F.array_sort(F.collect_list(F.struct(BLOCK, SLOT, PIECE)))
    glued = (
        placed.where(F.col(ROLE).isNull())
        .groupBy(FILE, *keep, BEFORE, NUMBER)
        .agg(pieces.alias("_pieces"), F.max("bad").alias("bad"))
        .withColumn(PIECE, F.concat_ws("" if shape.lead else shape.glue, F.col(f"_pieces.{PIECE}")))
        .withColumn(ROLE, F.when(F.col("bad"), PART).otherwise(RECORD))
    )
    return simple.select(*columns).unionByName(single).unionByName(glued.select(*columns))


# Effects


def csv_effect(line: Column, sep: str = ",", quote: str = '"') -> Effect:
    """Lines of a CSV file. A quote opens a value only at its start, and doubled ones are text."""

    # Fields with an odd number of quotes turn the state, or close what is open; others leave it.
    # The code holds the states that follow from state 0 and, times two, from state 1.
    def step(code: Column, field: Column) -> Column:
        odd = (F.length(field) - F.length(F.replace(field, F.lit(quote), F.lit("")))) % 2 == 1
        turned = F.when(F.startswith(field, F.lit(quote)), F.lit(3) - code).otherwise(0)
        return F.when(odd, turned).otherwise(code)

    # Only fields with a quote, each from its start to the next separator.
    quoted = F.lit(f"(?<![^{sep}])[^{sep}{quote}]*+{quote}[^{sep}]*+")
    walked = F.aggregate(F.regexp_extract_all(line, quoted, F.lit(0)), F.lit(2), step)
    code = F.when(F.contains(line, F.lit(quote)), walked).otherwise(2)
    return Effect(code % 2, F.floor(code / 2), F.lit(0), F.lit(0), line.isin("", "\r"))


def json_effect(piece: Column) -> Effect:
    """What follows an opening brace, up to the next one."""

    def count(text: Column, mark: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))

    # Pairs of backslashes first, so that those left escape what follows them.
    plain = piece
    for escaped in (r"\\", r'\"', r"\}"):
        plain = F.replace(plain, F.lit(escaped), F.lit(""))
    turned = count(plain, '"') % 2
    strings = r'"[^"]*("|$)'

    def closing(text: Column, outside: Column) -> Column:
        # Most pieces close what they close behind their last quote.
        last = count(F.substring_index(plain, '"', -1), "}")
        every = count(F.regexp_replace(text, strings, ""), "}")
        return F.when(last < count(plain, "}"), every).when(outside, last).otherwise(0)

    # Begun inside a string, the brace in front and all up to the next quote are text.
    inside = closing(F.concat(F.lit('"'), plain), turned == 1)
    return Effect(turned, 1 - turned, 1 - closing(plain, turned == 0), -inside, F.lit(False))
