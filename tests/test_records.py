"""CSV records with quoted line breaks: many tasks, the same rows as Spark's one-task reader."""

import os
import random
import tempfile
from contextlib import contextmanager

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mishap.sources.csv import read_counts, read_incidents_csv
from mishap.sources.records import Lines, _end, csv_records, has_open_lines, split_starts, stays_open, text_lines

HEADER = "id,city,note\n"


@contextmanager
def splits_of(spark, nbytes):
    keys = {"spark.sql.files.maxPartitionBytes": str(nbytes), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def folder(**files):
    place = tempfile.mkdtemp(prefix="mishap-records-")
    for name, text in files.items():
        with open(os.path.join(place, name + ".csv"), "w", newline="") as file:
            file.write(text)
    return place


def by_spark(spark, place):
    return spark.read.option("multiLine", True).option("header", True).option("escape", '"').csv(place)


def rows(frame):
    return sorted(map(repr, map(tuple, frame.collect())))


def made(rng, n):
    def cell():
        kind = rng.random()
        if kind < 0.4:
            return "".join(rng.choice("ab5 x") for _ in range(rng.randint(0, 6)))
        if kind < 0.5:
            return '5" pipe'
        text = "".join(rng.choice(['a', ',', '\n', '""', ' ', 'long words ']) for _ in range(rng.randint(0, 9)))
        return f'"{text}"'
    out = []
    for k in range(n):
        cells = [str(k), cell(), cell()]
        if rng.random() < 0.1:
            cells = cells[:rng.randint(1, 3)] + ["x"] * rng.randint(0, 3)
        out.append(",".join(cells))
    return HEADER + "\n".join(out) + rng.choice(["", "\n"])


@pytest.mark.parametrize("line,out,inside", [
    ("a,b", False, True), ('a,"b', True, False), ('c",d', False, False), ('a,"b,c",d', False, False), ('5" pipe,b', False, False),
    ('"a""', True, False), ('"a"""', False, False), ('a,""', False, True), ('"x"y,"z', True, True), ("", False, True), ('"', True, False)])
def test_function_of_a_line(spark, line, out, inside):
    one = spark.createDataFrame([(line,)], "v string")
    got = one.select(stays_open(F.col("v")), stays_open(F.concat(F.lit('"'), "v"))).first()
    assert tuple(got) == (out, inside)
    assert (_end(line.encode(), False), _end(line.encode(), True)) == (out, inside)


def test_states_of_a_batch_equal_those_line_by_line():
    rng = random.Random(5)
    for _ in range(300):
        texts = ["".join(rng.choice(['a', ',', '"', '""', '"b"', ',"', '",', "\r"]) for _ in range(rng.randint(0, 6)))
                 for _ in range(rng.randint(1, 12))]
        lines = Lines(pa.array(["x", *texts, "y"]).slice(1, len(texts)))
        for start in (False, True):
            want, state = [], start
            for text in texts:
                want.append(state)
                state = _end(text.encode(), state)
            before, end = lines.states(start)
            assert before.tolist() == want and end == state, texts
            joined, records = "\n".join(texts), lines.joined(before).to_pylist()
            assert "\n".join(records) == joined and len(records) == 1 + sum(not b for b in want[1:])


@pytest.mark.parametrize("seed", range(3))
def test_equals_the_one_task_reader(spark, seed):
    rng = random.Random(seed)
    place = folder(a=made(rng, 60), b=made(rng, 40), c=HEADER + "1,only,one\n")
    want = rows(by_spark(spark, place))
    for nbytes in (41, 300):
        with splits_of(spark, nbytes):
            frame = read_incidents_csv(spark, place)
            assert frame.columns == ["id", "city", "note"]
            assert rows(frame) == want
            if nbytes < 100:
                assert text_lines(spark, place).rdd.getNumPartitions() > 5


def test_a_record_over_many_splits(spark):
    long = "word, \n" * 400
    place = folder(a=f'{HEADER}1,"{long}",x\n2,b,c\n3,"{long}","{long}"')
    with splits_of(spark, 64):
        assert rows(read_incidents_csv(spark, place)) == rows(by_spark(spark, place))
        starts = split_starts(text_lines(spark, place))
        assert starts.where("inside").count() > 50 and starts.where("split = 0 and not inside").count() == 1


def test_return_and_line_feed(spark):
    place = folder(a='id,city,note\r\n1,"a\r\nb",c\r\n2,d,"e"\r\n')
    with splits_of(spark, 12):
        assert rows(read_incidents_csv(spark, place)) == rows(spark.createDataFrame([("1", "a\r\nb", "c"), ("2", "d", "e")]))


def test_files_without_line_breaks_keep_the_plain_reader(spark):
    place = folder(a=HEADER + '1,"a, b",c\n2,5" pipe,d\n')
    assert not has_open_lines(spark, place)
    frame = read_incidents_csv(spark, place)
    assert "FileScan csv" in frame._jdf.queryExecution().executedPlan().toString()
    assert rows(frame) == rows(by_spark(spark, place))


def test_malformed_rows_are_always_counted(spark):
    for text, want in ((HEADER + "1,a\n2,b,c\n3,d,e,f\n", {"rows": 3, "malformed": 2}),
                       (HEADER + '1,a\n2,"b\nb",c\n3,d,e,f\n', {"rows": 3, "malformed": 2})):
        place = folder(a=text)
        read_incidents_csv(spark, place).collect()
        assert read_counts(place) == want


def test_headers_are_checked(spark):
    place = folder(a=HEADER + '1,"a\nb",c\n', b="id,note,city\n1,c,a\n")
    with pytest.raises(Exception, match="header"):
        read_incidents_csv(spark, [os.path.join(place, "a.csv"), os.path.join(place, "b.csv")]).collect()


def test_byte_order_mark_empty_lines_and_clashing_names(spark):
    place = folder(a='﻿id,_malformed_line,text\n\n1,"a\nb",c\n\n')
    got = read_incidents_csv(spark, place)
    assert got.columns == ["id", "_malformed_line", "text"] and rows(got) == [repr(("1", "a\nb", "c"))]


def test_only_crossing_records_are_shuffled(spark):
    place = folder(a=HEADER + "".join(f'{k},"a\nb",c\n' for k in range(2000)))
    with splits_of(spark, 4096):
        plan = csv_records(spark, place)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert csv_records(spark, place).count() == 2001
