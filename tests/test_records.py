"""CSV records over many splits, against a parser that reads a file from its start."""

import csv
import io
import random

import pytest
from table_rows import rows

from trackmart.sources import lake, records

NAMES = ["a", "b", "c"]


@pytest.fixture
def small_splits(spark):
    held = {k: spark.conf.get(k) for k in
            ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    for name, value in held.items():
        spark.conf.set(name, value)


def saved(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(text.encode())
    return str(folder)


def field(draw):
    kind = draw.random()
    if kind < 0.45:
        return "".join(draw.choice("xyz 19") for _ in range(draw.randrange(0, 9))).strip()
    if kind < 0.6:
        return f'12" {draw.randrange(9)}'  # a quote inside a field without quotes
    parts = ['""', ",", "\n", "word", "é", "\n\n", ' "" ', "q"]
    return '"' + "".join(draw.choice(parts) for _ in range(draw.randrange(0, 9))) + '"'


def parsed(text):
    found = csv.reader(io.StringIO(text, newline=""), strict=False)
    return sorted(([f or None for f in row] for row in found if row), key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_records_equal_those_of_a_whole_read(spark, tmp_path, small_splits, seed):
    draw = random.Random(seed)
    want = []
    for number in range(3):
        lines = [",".join(f'"k{i}"' if j == 0 and draw.random() < 0.2 else f"k{i}" if j == 0
                          else field(draw) for j in range(3)) for i in range(120)]
        if number == 2:  # a file without line breaks is read by its lines
            lines = [line for line in lines if "\n" not in line]
        text = "\n".join(["a,b,c", *lines, ""])
        saved(tmp_path / "csv", f"{number}.csv", text)
        want += [r for r in parsed(text) if r != NAMES]
    found = lake.read_csv(spark, str(tmp_path / "csv"), multi_line=True)
    got = sorted(([f or None for f in row] for row in found.collect()), key=repr)
    assert got == sorted(want, key=repr)
    lines = records.scan_lines(spark, str(tmp_path / "csv"))
    assert lines.rdd.getNumPartitions() > 20
    assert lines.select("file", "block").distinct().count() > 20


def test_stray_quotes_cost_their_own_record(spark, tmp_path, small_splits):
    body = [f"k{i},plain {i},z" for i in range(200)]
    body[20] = 'k20,"stray,z'                     # closed by nothing that can close it
    body[30] = 'k30,"two\nlines",z'
    body[90] = 'k90,x"y,z'                        # not at the start of a field
    body[120] = 'k120,"a ""b"", c",z'
    body[150] = 'k150,"open to the end,z'
    path = saved(tmp_path / "csv", "t.csv", "\n".join(["a,b,c", *body]) + "\n")
    found = {r["a"]: (r["b"], r["c"]) for r in lake.read_csv(spark, path, multi_line=True).collect()}
    assert len(found) == 200
    for i in range(200):
        if i not in (20, 30, 90, 120, 150):
            assert found[f"k{i}"] == (f"plain {i}", "z"), i
    assert found["k30"] == ("two\nlines", "z")
    assert found["k90"] == ('x"y', "z") and found["k120"] == ('a "b", c', "z")


def test_a_record_over_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i} with some words in it" for i in range(100))
    text = f'a,b,c\n1,x,y\n2,"{long}",y\n3,"{long}\n",y\n4,"",y\n\n5,"p\r\nq",y\r\n'
    path = saved(tmp_path / "csv", "t.csv", text)
    assert rows(lake.read_csv(spark, path, multi_line=True), "a") == [
        ("1", "x", "y"), ("2", long, "y"), ("3", long + "\n", "y"), ("4", None, "y"),
        ("5", "p\nq", "y")]


def test_files_without_header_and_long_records(spark, tmp_path, small_splits):
    text = '1,"a\nb",x\n2,"a\nb",x,stray\n3,"a,\n,,b"\n' * 30
    path = saved(tmp_path / "csv", "t.csv", text)
    found = lake.read_csv(spark, path, NAMES, skip_long_lines=True, multi_line=True, header=False)
    assert rows(found) == sorted([("1", "a\nb", "x"), ("3", "a,\n,,b", None)] * 30, key=repr)


def test_empty_files(spark, tmp_path):
    path = saved(tmp_path / "csv", "t.csv", "a,b,c\n")
    assert rows(lake.read_csv(spark, path, multi_line=True)) == []


def test_a_record_is_parsed_once_whatever_filters_follow(spark):
    lines = spark.createDataFrame([("1,x,",), ("2,,z",), (" ",)], "record string")
    parsed = records.parse_records(lines, NAMES).filter("a is not null and b is not null")
    assert rows(parsed) == [("1", "x", None)]
    assert parsed._jdf.queryExecution().optimizedPlan().toString().count("from_csv(") == 1
