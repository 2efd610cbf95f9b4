"""Records cut by structure from files that several tasks read."""

import json
import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from ordermill.operators import records
from ordermill.rules import FRANCE, INDIA
from ordermill.sources import landing

NAMES = [f.column for f in landing.FIELDS]
LABELS = [f.label for f in landing.FIELDS]


@contextmanager
def blocks(spark, size):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _folder(tmp_path, source, kind):
    folder = tmp_path / f"source={source}" / f"format={kind}" / "date=2023-01-05"
    folder.mkdir(parents=True, exist_ok=True)
    return folder


def _csv_text(rng, file):
    """Quoted line breaks, doubled and stray quotes, blank lines, short and long records."""
    values = ["x", "", "null", '""', '"a,b"', '"one\ntwo"', '"\n"', '"say ""hi""\n\n"",""z"', '5" wide',
              'TV 55"', '"\r\nq"', "é文字", '"a"', '" , "" "', "'", '"""\n"""']
    lines = [",".join(NAMES)]
    for i in range(rng.randint(0, 30)):
        fields = [f"{file}-{i}"] + [rng.choice(values) for _ in range(rng.choice([15, 15, 15, 3, 17]))]
        lines.append(",".join(fields))
        if rng.random() < 0.1:
            lines.append("")
    end = rng.choice(["\n", "\r\n"])
    return end.join(lines) + rng.choice(["", end, end * 2])


@pytest.mark.parametrize("seed, block, chunk", [(1, 300, 4096), (2, 500, 3), (4, 900, 1)])
def test_csv_equals_the_reading_by_one_task(spark, tmp_path, monkeypatch, seed, block, chunk):
    monkeypatch.setattr(records, "CHUNK_PIECES", chunk)
    rng = random.Random(seed)
    for file in range(4):
        (_folder(tmp_path, "IN", "csv") / f"f{file}.csv").write_bytes(_csv_text(rng, file).encode())
    whole = landing.raw_csv(spark.read, landing.landing_path(str(tmp_path), INDIA), multi_line=True)
    # That reader takes CRLF in a value for a line feed, if the file's lines end with it.
    want = sorted(repr(tuple(r[n] for n in NAMES)).replace("\\r\\n", "\\n") for r in whole.collect())
    with blocks(spark, block):
        pieces = landing.raw_orders(spark, str(tmp_path), INDIA, pieces=True)
        assert pieces.rdd.getNumPartitions() > 4
        found = landing.split_csv(pieces).collect()
    got = sorted(repr(tuple(r[n] for n in NAMES)).replace("\\r\\n", "\\n") for r in found)
    assert got == want
    assert all(r["_corrupt_record"] is None for r in found)
    for file in range(4):
        own = [r for r in found if r["_file"].endswith(f"f{file}.csv")]
        assert sorted(r[records.NUMBER] for r in own) == list(range(1, len(own) + 1))
        in_order = sorted((r for r in own if r["order_id"]), key=lambda r: r[records.NUMBER])
        assert [r["order_id"] for r in in_order] == sorted(
            (r["order_id"] for r in in_order), key=lambda x: int(x.split("-")[1])
        )


def test_lines_of_an_open_quote_are_rejected_one_by_one(spark, tmp_path):
    row = ",".join(["A1"] + ["1"] * 15)
    text = "\n".join([",".join(NAMES), row, 'A2,"never closed', row, "last"])
    (_folder(tmp_path, "IN", "csv") / "f.csv").write_text(text)
    found = landing.split_csv(landing.raw_orders(spark, str(tmp_path), INDIA, pieces=True)).collect()
    assert [r["order_id"] for r in found if r["_corrupt_record"] is None] == ["A1"]
    bad = sorted(r["_corrupt_record"] for r in found if r["_corrupt_record"] is not None)
    assert bad == sorted(['A2,"never closed', row, "last"])


def _record(name, **extra):
    return dict(zip(LABELS, [name] + ["1"] * 15, strict=True)) | extra


def _json_text(rng, file):
    """A file, the names of its orders in order, and the texts that belong to none."""
    text, names, garbage = rng.choice(["", "﻿", " \n", "oops "]), [], []
    if text == "oops ":
        garbage.append("oops")
    tricky = {"Note": 'a "b" \\ } ] { [ ,', "Lines": [{"x": {"y": "}"}}, {}, [1, {"z": "\\\"{"}]]}
    for i in range(rng.randint(0, 20)):
        parts = []
        for j in range(rng.choice([1, 1, 2, 5])):
            names.append(f"{file}-{i}-{j}")
            record = _record(names[-1], **(tricky if rng.random() < 0.3 else {}))
            parts.append(json.dumps(record, indent=rng.choice([None, 2]), ensure_ascii=False))
        if len(parts) > 1 or rng.random() < 0.4:
            text += "[" + rng.choice([",", ", ", ",\n"]).join(parts) + "]"
        else:
            text += parts[0]
        if rng.random() < 0.1:
            garbage.append(f"garbage {i}")
            text += f" garbage {i} "
        text += rng.choice(["", " ", "\n", "\r", "\r\n\n"])
    return text, names, garbage


@pytest.mark.parametrize("seed, block, chunk", [(1, 3000, 4096), (2, 5000, 2), (4, 2500, 1)])
def test_json_documents_however_they_follow(spark, tmp_path, monkeypatch, seed, block, chunk):
    monkeypatch.setattr(records, "CHUNK_PIECES", chunk)
    rng = random.Random(seed)
    made = [_json_text(rng, file) for file in range(5)]
    for file, (text, _, _) in enumerate(made):
        (_folder(tmp_path, "FR", "json") / f"f{file}.json").write_bytes(text.encode())
    with blocks(spark, block):
        pieces = landing.raw_orders(spark, str(tmp_path), FRANCE, pieces=True)
        found = landing.split_json(pieces).collect()
    for file, (_, names, garbage) in enumerate(made):
        own = [r for r in found if r["_file"].endswith(f"f{file}.json")]
        good = sorted((r for r in own if r["_corrupt_record"] is None), key=lambda r: r[records.NUMBER])
        assert [r["order_id"] for r in good] == names
        assert [r[records.NUMBER] for r in good] == list(range(1, len(names) + 1))
        assert sorted(r["_corrupt_record"] for r in own if r["_corrupt_record"]) == sorted(garbage)


@pytest.mark.parametrize(
    "text, names, broken",
    [
        ("{A1}{A2}", ["A1", "A2"], []),
        ("[{A1}] [{A2}]", ["A1", "A2"], []),
        ("[{A1}]\r[{A2}]", ["A1", "A2"], []),
        ("[{A1}] garbage", ["A1"], ["garbage"]),
        ("[{A1}, 5, null, {A2}]", ["A1", "A2"], ["5, null"]),
        ("{A1}} {A2}", ["A2"], ["{A1}}"]),
        ("{A1} {broken: {A2}", ["A1"], ["{broken:", "{A2}"]),
        ('{A1} {"Order ID": "x', ["A1"], ['{"Order ID": "x']),
        ("{A1} {,}", ["A1"], ["{,}"]),
        ("nothing", [], ["nothing"]),
        ("[]", [], []),
        ("", [], []),
    ],
)
def test_every_document_is_accounted_for(spark, tmp_path, text, names, broken):
    whole = {n: json.dumps(_record(n)) for n in ("A1", "A2")}

    def full(text):
        for name, record in whole.items():
            text = text.replace("{" + name + "}", record)
        return text

    (_folder(tmp_path, "FR", "json") / "f.json").write_bytes(full(text).encode())
    found = landing.split_json(landing.raw_orders(spark, str(tmp_path), FRANCE, pieces=True)).collect()
    assert sorted(r["order_id"] for r in found if r["_corrupt_record"] is None) == names
    bad = sorted(r["_corrupt_record"] for r in found if r["_corrupt_record"] is not None)
    assert bad == sorted(map(full, broken))


def test_whole_chunks_are_not_shuffled(spark, tmp_path):
    """Rows of a file without line breaks in values go from the copy to the result."""
    row = ",".join(["A1"] + ['"a, b"'] + ["1"] * 14)
    (_folder(tmp_path, "IN", "csv") / "f.csv").write_text("\n".join([",".join(NAMES)] + [row] * 9000))
    found = landing.split_csv(landing.raw_orders(spark, str(tmp_path), INDIA, pieces=True))
    assert found.count() == 9000
    simple = found.filter(F.col(records.NUMBER) > 0)
    plan = simple._jdf.queryExecution().executedPlan().toString()
    assert "wholetext" not in plan and "BatchEvalPython" not in plan


def _open_after(line, state):
    """The state after a CSV line, field by field."""
    for field in line.split(","):
        odd = field.count('"') % 2 == 1
        state = (1 - odd) if state else int(odd and field.startswith('"'))
    return state


def test_csv_effects_of_lines_with_any_quotes(spark):
    rng = random.Random(5)
    lines = ["".join(rng.choice('ab,,"" \r') for _ in range(rng.randint(0, 12))) for _ in range(2000)]
    rows = spark.createDataFrame([(line,) for line in lines], "line string")
    effect = records.csv_effect(F.col("line"))
    for line, end0, end1 in rows.select("line", effect.end0, effect.end1).collect():
        assert (end0, end1) == (_open_after(line, 0), _open_after(line, 1)), line


def _ended(piece, inside):
    """Whether a string is open after a JSON piece, and the braces that close outside strings."""
    i, closed = 0, 0
    while i < len(piece):
        if piece[i] == "\\":
            i += 1
        elif piece[i] == '"':
            inside = not inside
        elif piece[i] == "}" and not inside:
            closed += 1
        i += 1
    return int(inside), closed


def test_json_effects_of_pieces_with_any_escapes(spark):
    rng = random.Random(6)
    pieces = ["".join(rng.choice('a\\"}, ') for _ in range(rng.randint(0, 12))) for _ in range(2000)]
    rows = spark.createDataFrame([(piece,) for piece in pieces], "piece string")
    effect = records.json_effect(F.col("piece"))
    for piece, *found in rows.select("piece", effect.end0, effect.end1, effect.add0, effect.add1).collect():
        (end0, closed0), (end1, closed1) = _ended(piece, False), _ended(piece, True)
        assert found == [end0, end1, 1 - closed0, -closed1], piece


def test_the_records_that_chunks_begin_are_worked_out_once(spark, tmp_path, monkeypatch):
    """Two tables are made of them; each would repeat the windows over all effects."""
    made = []
    real = records.cut
    monkeypatch.setattr(records, "cut", lambda df, label, *more: made.append(label) or real(df, label, *more))
    text = "\n".join([",".join(NAMES), 'A1,"one\ntwo"' + ",1" * 14, "A2" + ",1" * 15])
    (_folder(tmp_path, "IN", "csv") / "f.csv").write_text(text)
    found = landing.split_csv(landing.raw_orders(spark, str(tmp_path), INDIA, pieces=True)).collect()
    assert sorted(r["order_id"] for r in found) == ["A1", "A2"]
    assert made.count("begun") == 1
