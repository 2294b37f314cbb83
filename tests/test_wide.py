"""Wide tables with more names than a table can have columns."""

import csv
import time

import pytest

from gleaner.operators import shape


def cells_of(spark, rows):
    """Rows of ``id, cells``; the cells are given as pairs, as their order counts."""
    entries = spark.createDataFrame(rows, "id long, e array<struct<k: string, v: string>>")
    return entries.selectExpr("id", "map_from_entries(e) as cells")


def test_twenty_thousand_names(spark, tmp_path):
    rows = [(i, [(f"k{j}", f"{i},{j}" if j % 2 else f'a"{i}') for j in range(i * 2000, i * 2000 + 2001)]) for i in range(10)] + [(10, []), (11, None)]
    df = cells_of(spark, rows)
    with pytest.raises(ValueError, match="write_wide_csv"):
        shape.union_columns(df, ["id"])
    shape.write_wide_csv(df, str(tmp_path / "wide"), ["id"])
    text = "".join(part.read_text() for part in sorted((tmp_path / "wide").glob("part-*")))
    header, *lines = csv.reader(text.splitlines())
    assert header == [f"k{j}" for j in range(20_001)]
    for (_, cells), line in zip(rows, lines, strict=True):
        given = dict(cells or [])
        assert line == [given.get(name, "") for name in header]


def test_the_same_as_columns(spark):
    rows = [(1, [("b", "x"), ("a", "")]), (0, [("c,d", "line\nend"), ("a", "y")]), (2, [("a", None)])]
    df = cells_of(spark, rows)
    table = shape.union_columns(df, ["id"], "id").orderBy("id")
    got = [r.line for r in shape.wide_lines(df, ["id"]).orderBy("part", "id").collect()]
    assert next(csv.reader([got[0]])) == table.columns[1:] == ["c,d", "a", "b"]
    assert got[1:] == ['"line\nend",y,', ",,x", ",,"]
    assert [tuple(r)[1:] for r in table.collect()] == [("line\nend", "y", ""), ("", "", "x"), ("", "", "")]


def test_empty_tables(spark):
    schema = "id long, cells map<string, string>"
    assert shape.wide_lines(spark.createDataFrame([], schema), ["id"]).collect() == []
    got = shape.wide_lines(spark.createDataFrame([(1, {})], schema), ["id"]).orderBy("part").collect()
    assert [r.line for r in got] == ["", ""]


def test_a_row_looks_up_its_own_cells_only(spark, tmp_path):
    """A look-up per row and name made 0.8 billion look-ups here."""
    docs = spark.range(40_000).selectExpr("id", "map(concat('k', id div 2), 'v', 'all', concat(id, ',')) as cells")
    started = time.time()
    shape.write_wide_csv(docs, str(tmp_path / "wide"), ["id"], compression="gzip")
    lines = spark.read.text(str(tmp_path / "wide")).selectExpr("count(*) as n", "min(length(translate(value, ',', ''))) as least", "max(length(value)) as most")
    assert tuple(lines.first())[:2] == (40_001, 4)
    assert time.time() - started < 120


def test_wide_lines_of_a_compressed_sink(spark, tmp_path):
    df = cells_of(spark, [(1, [("b", "x"), ("a", "y")]), (2, [("c", 'q"'), ("b", "")]), (3, [("é", "z"), ("a", None)])])
    shape.write_wide_csv(df, str(tmp_path / "wide"), ["id"], compression="gzip")
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "wide")).collect()) == sorted(["b,a,c,é", "x,y,,", ',,"q""",', ",,,z"])
