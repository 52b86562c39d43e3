"""Records that span lines and splits, heads of files, encodings."""

from __future__ import annotations

import csv
import io
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from layerwise.session import setting
from layerwise.sources import landing as land
from layerwise.sources.records import QuoteStates, read_records, split_pieces, split_lines, starting_states, states_after


@pytest.fixture
def small_splits(spark):
    with setting(spark, "spark.sql.files.maxPartitionBytes", "2000"):
        with setting(spark, "spark.sql.files.openCostInBytes", "1"):
            yield


def written(folder, name, rows, end="\n", last_end=True):
    text = io.StringIO()
    csv.writer(text, lineterminator=end).writerows(rows)
    text = text.getvalue() if last_end else text.getvalue()[: -len(end)]
    (folder / name).write_text(text, newline="")
    return text


def fields(text):
    return [row for row in csv.reader(io.StringIO(text, newline="")) if row]


def in_order(df, file):
    own = df.filter(F.col("src_file") == file).orderBy("src_block", "src_row").collect()
    return [next(csv.reader(io.StringIO(r["record"], newline=""))) for r in own]


NOTES = ["a", "two\nlines", 'q "w" q', "x,y", "", '"', "tail\n", "\nhead", "end\r\nmark", "\n\n", "l\n" * 900, "u" * 5000]


@pytest.mark.parametrize("seed", [1, 2])
def test_records_across_splits(spark, tmp_path, small_splits, seed):
    pick = random.Random(seed)
    wanted = {}
    for name, end, last_end in (("a.csv", "\n", True), ("b.csv", "\r\n", True), ("c.csv", "\n", False)):
        rows = [["id", "note", "tail"]] + [[str(i), pick.choice(NOTES), pick.choice(["p", "z\n\nz"])] for i in range(60)]
        wanted[name] = fields(written(tmp_path, name, rows, end, last_end))
    found = read_records(spark, [str(tmp_path)], ",")
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
    assert found.select("src_file", "src_block", "src_row").distinct().count() == found.count()
    for name, rows in wanted.items():
        assert in_order(found, name) == rows
    first = found.where("first").select("src_file", "record").collect()
    assert {r["src_file"]: r["record"] for r in first} == dict.fromkeys(wanted, "id,note,tail")


def test_record_over_many_splits_without_a_quote_in_them(spark, tmp_path, small_splits):
    rows = [["id", "note"], ["1", "k\n" * 6000], ["2", "b"], ["3", "m" * 9000], ["4", "c"]]
    written(tmp_path, "a.csv", rows)
    lines = split_lines(spark, [str(tmp_path)])
    states = starting_states(split_pieces(lines, ","))
    assert states.where("inside AND all_head").count() > 2
    assert in_order(read_records(spark, [str(tmp_path)], ","), "a.csv") == rows


def test_quotes_within_fields_open_nothing(spark, tmp_path, small_splits):
    lines = [f'{i},5" pipe,x"y' for i in range(400)]
    (tmp_path / "a.csv").write_text("id,note,tail\n" + "\n".join(lines) + "\n")
    found = read_records(spark, [str(tmp_path)], ",").orderBy("src_block", "src_row").collect()
    assert [r["record"] for r in found][1:] == lines


def test_open_quote_makes_the_rest_one_record(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note\n1,a\n2,"open\n3,c\n4,d\n')
    found = read_records(spark, [str(tmp_path)], ",").orderBy("src_block", "src_row").collect()
    assert [r["record"] for r in found] == ["id,note", "1,a", '2,"open\n3,c\n4,d']


def test_states():
    states = QuoteStates(",")
    cases = ["plain", 'a,"b"', 'a,"b', 'b",c', '"", x', 'a""b', '"a""', '""""', '"a"b,"c', 'x","y']
    outside, inside = states.after(pa.array(cases))
    assert outside.tolist() == [False, False, True, False, False, False, True, False, True, True]
    assert inside.tolist() == [True, False, False, False, True, True, False, True, True, True]
    pick = np.random.default_rng(0)
    out, within = pick.random(200) < 0.4, pick.random(200) < 0.6
    for start in (False, True):
        state, after = start, []
        for o, i in zip(out, within):
            state = bool(i) if state else bool(o)
            after.append(state)
        # the lines a text can have: those that turn, fix or leave the state
        assert states_after(start, out, within).tolist() == after


def _landed(spark, folder, **options):
    catalog = land.landing_catalog(spark, str(folder), ["Device"], **options)
    return {r["file_name"]: r for r in catalog.collect()}


def test_formats(spark, tmp_path):
    files = {
        "A_Device_20250416.csv": b'id;"two\nlines"\n1;"a;b"\n2;c\n',
        "B_Device_20250416.csv": b'\n \nid,note\n1,5" pipe\n',
        "C_Device_20250416.csv": b"id,note\n1,a\n",
        "D_Device_20250416.csv": "id,note\n1,café\n".encode("latin-1"),
        "E_Device_20250416.csv": "id,note\n1,caf�\n".encode(),
        "F_Device_20250416.csv": b"\n\n",
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    found = _landed(spark, tmp_path)
    assert {n[0]: (r["valid"], r["multi_line"]) for n, r in found.items()} == {
        "A": (True, True), "B": (True, False), "C": (True, False), "D": (False, False), "E": (True, False), "F": (False, False),
    }
    a = found["A_Device_20250416.csv"]
    assert (a["delimiter"], a["header"], a["n_columns"]) == (";", 'id;"two\nlines"', 2)
    assert found["B_Device_20250416.csv"]["header"] == "id,note"
    with_fallback = _landed(spark, tmp_path, fallback_encoding="ISO-8859-1")
    d = with_fallback["D_Device_20250416.csv"]
    assert (d["valid"], d["encoding"]) == (True, "ISO-8859-1")

    def read(row):
        df = land.read_landing(
            spark, [row["path"]], row["delimiter"], row["header"], multi_line=row["multi_line"], encoding=row["encoding"]
        )
        return [tuple(r)[:2] for r in df.orderBy("src_block", "src_row").collect()]

    assert read(a) == [("1", "a;b"), ("2", "c")]
    assert land.header_names(a["header"], ";") == ["id", "two\nlines"]
    assert read(found["B_Device_20250416.csv"]) == [("1", '5" pipe')]
    assert read(d) == [("1", "café")]
    assert read(found["E_Device_20250416.csv"]) == [("1", "caf�")]


def test_multi_line_rejects(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('id,note\n1,"x\ny"\n2\n3,"a\nb",c\n')
    df = land.read_landing(spark, [str(path)], ",", "id,note", multi_line=True, reject_column="bad")
    found = sorted((r["id"], r["note"], r["bad"]) for r in df.collect())
    assert found == [("1", "x\ny", None), ("2", None, "2"), ("3", "a\nb", '3,"a\nb",c')]
    with pytest.raises(Exception, match="MALFORMED"):
        land.read_landing(spark, [str(path)], ",", "id,note", multi_line=True).collect()


def test_heads_are_read_without_their_files(spark, tmp_path):
    files = []
    for k in range(4):
        path = tmp_path / f"B {k}_Device_20250416.csv"
        path.write_text("id,note\n" + f"{k},{'n' * 90}\n" * (50 if k == 3 else 60_000))
        files.append((str(path), path.stat().st_size))

    def read():
        return sum(stage.inputBytes() for stage in _stages(spark))

    before = read()
    heads = land.head_lines(spark, files)
    used = read() - before
    assert 0 < used < 4 * (1 << 17) < sum(size for _, size in files) / 20
    counts = heads.groupBy("file_path").agg(F.count("*").alias("n"), F.min_by("value", "__line_id").alias("first"))
    assert sorted((r["n"], r["first"]) for r in counts.collect()) == [(land.HEAD_LINES, "id,note")] * 3 + [(51, "id,note")]
    assert land.head_lines(spark, []).count() == 0


def test_heads_of_large_files_in_many_splits(spark, tmp_path, monkeypatch):
    """Where small splits are held and the reading session cannot widen them, a large file's head
    lines are still its first lines, in order, and its first record is the header."""
    held = {"spark.sql.files.maxPartitionBytes": "8192", "spark.sql.files.openCostInBytes": "1"}
    config, session_of = type(spark.conf), type(spark).newSession
    put = config.set

    def apart(self):
        session = session_of(self)
        for key, value in held.items():
            put(session.conf, key, value)
        return session

    monkeypatch.setattr(type(spark), "newSession", apart)
    monkeypatch.setattr(config, "set", lambda self, key, *a, **b: None if key in held else put(self, key, *a, **b))
    path = tmp_path / "B 0_Items_20240131.csv"
    lines = ["id,note"] + [f'{k},"line {k}\n{"x" * 40}"' for k in range(30_000)]
    path.write_text("\n".join(lines) + "\n")
    assert path.stat().st_size > land.SMALL_FILE
    heads = land.head_lines(spark, [(str(path), path.stat().st_size)])
    found = [r["value"] for r in heads.orderBy("__block", "__line_id").collect()]
    assert found == "\n".join(lines).split("\n")[: land.HEAD_LINES]
    catalog = land.landing_catalog(spark, str(tmp_path), ["Items"]).collect()
    assert [(r["header"], r["delimiter"], r["multi_line"]) for r in catalog] == [("id,note", ",", True)]


def _stages(spark):
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    jvm, none = spark._jvm, spark.sparkContext._gateway.new_array(spark._jvm.double, 0)
    store = spark.sparkContext._jsc.sc().statusStore()
    listed = store.stageList(None, False, False, none, jvm.java.util.ArrayList())
    return [listed.apply(k) for k in range(listed.size())]
