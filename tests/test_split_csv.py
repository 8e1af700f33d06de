"""The scan in many tasks against Spark's scan of a whole file in one."""

import random

import pytest
from pyspark.sql import functions as F

from stewardry.sources.concept_files import CSV_OPTIONS
from stewardry.sources.split_csv import CLOSES, KEEPS, OPENS, TURNS, line_effect, open_spans, parse_records, read_lines, read_records

NAMES = ["name", "note", "end"]


@pytest.fixture
def small_blocks(spark):
    for key, value in {"spark.sql.files.maxPartitionBytes": "300b", "spark.sql.files.openCostInBytes": "1b"}.items():
        spark.conf.set(key, value)
    yield
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(key)


def cell(draw):
    kind = draw.randrange(9)
    plain = "".join(draw.choice("abcé 漢") for _ in range(draw.randrange(12)))
    quoted = {
        0: f"{plain}\n{plain}", 1: f"{plain}, {plain}", 2: f'{plain} "said" {plain}', 3: f'\n"\n{plain},"\n', 4: '","', 5: f"{plain}\r\nx",
    }
    if kind in quoted:
        return '"' + quoted[kind].replace('"', '""') + '"'
    return plain.strip() if kind < 8 else f'5" {plain}x'


def write(path, rows, end="\n", header="name,note,end"):
    path.write_bytes(("﻿" + header + end + end.join(rows) + end).encode())


def old(spark, path):
    rows = spark.read.options(**CSV_OPTIONS, enforceSchema="false").csv(str(path))
    return [tuple(r) for r in rows.collect()]


def new(spark, path, names=NAMES):
    rows = parse_records(read_records(spark, str(path)), names, {**CSV_OPTIONS, "header": "false"})
    return [tuple(r)[:-1] for r in rows.orderBy("line").collect()]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_same_rows_in_the_same_order(spark, small_blocks, tmp_path, seed, end):
    draw = random.Random(seed)
    rows = [f"k{i},{cell(draw)},{cell(draw)}" for i in range(150)]
    rows[20], rows[40:42] = "", ["short", "k,a,b,too long"]
    write(tmp_path / "f.csv", rows, end)
    assert read_lines(spark, str(tmp_path / "f.csv")).select("block").distinct().count() > 5
    found = new(spark, tmp_path / "f.csv")
    assert found == old(spark, tmp_path / "f.csv") and len(found) == 149


def test_a_cell_over_many_blocks(spark, small_blocks, tmp_path):
    long = "\n".join(f"line {i}, with a comma" for i in range(200))
    write(tmp_path / "f.csv", ["a,b,c", f'k,"{long}",z', "d,e,f", f'"{long}",,"{long}"', "g,h,i"])
    found = new(spark, tmp_path / "f.csv")
    assert found == old(spark, tmp_path / "f.csv") and found[1] == ("k", long, "z")
    spans, _ = open_spans(read_lines(spark, str(tmp_path / "f.csv")))
    # The line between the last two cells closes one and opens the next.
    assert spans.count() == 2


def test_a_cell_that_is_never_closed_takes_the_rest(spark, small_blocks, tmp_path):
    write(tmp_path / "f.csv", ["a,b,c", 'k,"open', *["more text, of it"] * 60])
    found = new(spark, tmp_path / "f.csv")
    assert len(found) == 2 and found[0] == ("a", "b", "c") and found[1][0] == "k"


def test_files_of_a_folder(spark, small_blocks, tmp_path):
    for k in range(3):
        write(tmp_path / f"{k}.csv", [f'{k}-{i},"x\n""y"", {i}",z' for i in range(30 * k)])
    (tmp_path / "3.csv").write_text("")
    assert sorted(new(spark, tmp_path)) == sorted(old(spark, tmp_path))
    by_file = {}
    for row in new(spark, tmp_path):
        by_file.setdefault(row[0].split("-")[0], []).append(row[0])
    assert all(names == sorted(names, key=lambda n: int(n.split("-")[1])) for names in by_file.values())


def test_another_header_is_told(spark, tmp_path):
    write(tmp_path / "1.csv", ["a,b,c"])
    write(tmp_path / "2.csv", ["a,b,c"], header="name,other,end")
    with pytest.raises(Exception, match="another header"):
        new(spark, tmp_path)


def test_effects_of_lines(spark):
    cases = {"a,b": KEEPS, 'b""c': KEEPS, '5" disk': KEEPS, 'a,"b"': KEEPS, 'a,"b': OPENS, 'b",c': CLOSES, '"': TURNS, 'x",y,"z': OPENS, 'x",y,"z"': CLOSES}
    rows = spark.createDataFrame([(t,) for t in cases], "t string").select("t", line_effect(F.col("t")).alias("e")).collect()
    assert {r.t: r.e for r in rows} == cases
