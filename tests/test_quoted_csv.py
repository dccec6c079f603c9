from __future__ import annotations

import csv
import random

import pytest
from pyspark.sql import types as T

from reviewmill.operators.dedup import keep_first
from reviewmill.sources import quoted_csv as Q
from reviewmill.sources import readers, writers

COLUMNS = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "text", "note")])


@pytest.fixture()
def small_ranges(spark):
    """Byte ranges of a few dozen bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def cut(size):
        for n, v in zip(names, (size, 0)):
            spark.conf.set(n, str(v))

    yield cut
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def write(path, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as out:
        csv.writer(out, lineterminator=end).writerows([["id", "te\nxt", "note"], *rows])


def made_rows(seed, count=24):
    draw = random.Random(seed)
    bits = ["\n", '"', '""', ",", "word", "é𝒳", " ", "\n\n", "x" * 70, "a\r\nb", '"\n"']
    rows = [[str(i), "".join(draw.choice(bits) for _ in range(draw.randrange(6))) or "-", draw.choice(["n", 'say "hi"', "l1\nl2"])] for i in range(count)]
    return rows + [["last", "line\n" * 40, "one text over many ranges"], ["end", '"', "q"]]


@pytest.mark.parametrize("size", [150, 1 << 20])
def test_every_cut_gives_the_same_rows(spark, stage, tmp_path, small_ranges, size):
    for seed in range(2):
        write(tmp_path / f"{seed}.csv", made_rows(seed), "\r\n" if seed else "\n")
    small_ranges(size)
    lines = Q.ranges_of_lines(spark, str(tmp_path))
    if size < 1000:
        assert lines.select("_file", "_block").distinct().count() > 10
        assert Q.range_starts(lines, stage).filter("inside = 1").count() > 2
    got = readers.read_csv(spark, str(tmp_path), COLUMNS, stage=stage, keep_order=True).collect()
    for seed in range(2):
        mine = sorted((r for r in got if r["_file"].endswith(f"/{seed}.csv")), key=lambda r: (r["_block"], r["_row"]))
        assert [[r["id"], r["text"], r["note"]] for r in mine] == made_rows(seed)


def test_ranges_beyond_the_broadcast_limit(spark, stage, tmp_path, small_ranges):
    write(tmp_path / "a.csv", made_rows(5))
    small_ranges(150)
    first, second = ({tuple(r) for r in Q.csv_records(spark, str(tmp_path), stage, limit).collect()} for limit in (1 << 20, 0))
    assert first == second and len(first) == 26


def test_same_as_one_task(spark, stage, tmp_path, small_ranges):
    table = spark.createDataFrame(
        [(i, ["", None, 'q"q', "a\nb", " pad ", "\\N x", "back\\slash", "tab\t,"][i % 8], None if i % 3 else i / 7) for i in range(100)], "id int, t string, d double"
    )
    writers.write_table(table.coalesce(1), str(tmp_path / "t"), "csv")
    small_ranges(150)
    many = readers.read_csv(spark, str(tmp_path / "t"), table.schema, stage=stage)
    alone = readers.read_csv(spark, str(tmp_path / "t"), table.schema, "one task")
    assert sorted(map(tuple, many.collect()), key=str) == sorted(map(tuple, alone.collect()), key=str) == sorted(map(tuple, table.collect()), key=str)


def test_first_copy_in_file_order_across_ranges(spark, stage, tmp_path, small_ranges):
    head = "app_id,app_name,review_id,user_name,rating,review_text,thumbs_up,app_version,review_date,reply_text\n"
    line = 'a,A,{i},u,{r},"two\n""lines"" of text",{t},1.0,2026-01-02 03:04:05,\n'
    body = "".join(line.format(i=i % 10, r=1 + i // 10 % 5, t=99 - i) for i in range(50))
    (tmp_path / "raw.csv").write_text(head + body)
    small_ranges(100)
    first = keep_first(readers.read_raw_reviews(spark, str(tmp_path / "raw.csv"), stage=stage)).collect()
    assert {r["review_id"]: r["rating"] for r in first} == {str(i): 1 for i in range(10)}


def test_stray_marks_and_empty_files(spark, stage, tmp_path):
    (tmp_path / "odd.csv").write_text('id,text,note\n1,5" wide,x\n2,b,y\n')
    with pytest.raises(ValueError, match="odd.csv"):
        readers.read_csv(spark, str(tmp_path / "odd.csv"), COLUMNS, stage=stage)
    assert readers.read_csv(spark, str(tmp_path / "odd.csv"), COLUMNS, "one task").count() == 2
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "head.csv").write_text("id,text,note\n\n\r\n")
    for name in ("empty", "head"):
        assert readers.read_csv(spark, str(tmp_path / f"{name}.csv"), COLUMNS, stage=stage).count() == 0


def test_reading_is_spread_over_tasks(spark, stage, tmp_path, small_ranges):
    write(tmp_path / "a.csv", made_rows(1, 200))
    small_ranges(512)
    parts = Q._with_start(lines := Q.ranges_of_lines(spark, str(tmp_path)), Q.range_starts(lines, stage), 1 << 20)
    assert parts.rdd.getNumPartitions() > 10
    assert "Exchange hash" not in parts._jdf.queryExecution().executedPlan().toString()


def test_records_that_are_not_stored(spark, stage, tmp_path, small_ranges):
    from reviewmill import Stage

    (tmp_path / "csv").mkdir()
    write(tmp_path / "csv" / "a.csv", made_rows(3))
    small_ranges(150)
    kept = readers.read_csv(spark, str(tmp_path / "csv"), COLUMNS, stage=stage, keep_order=True)
    read = readers.read_csv(spark, str(tmp_path / "csv"), COLUMNS, stage=Stage(spark, str(tmp_path)), keep_order=True, stored=False)
    assert sorted(map(str, read.collect())) == sorted(map(str, kept.collect())) and read.count() == 26
    stored = [p.name.rsplit("-", 1)[0] for p in tmp_path.glob("stage-*/*")]
    assert "csv_fragments" in stored and "csv_records" not in stored
