"""Tables' tokens and grids: places are made and read within a table's row, with spans, uneven rows and empty lines."""

import os
import re

import pytest

from vellum.operators import tables
from vellum.plans import catalogue
from vellum.sources import markup

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
CELL = "table_id long, r0 int, r1 int, c0 int, c1 int, text string, column_header boolean, row_header boolean, row_section boolean"


def planned(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
def test_tokens_are_read_without_sorting_places(spark):
    said = planned(catalogue.queries()["table_tokens_parse"](spark, DATA))
    # Lines are numbered by the only window, cells gathered by the only aggregation.
    assert len(re.findall(r"Window \[", said)) == 1 and len(re.findall(r"Aggregate \[", said)) == 1


def test_tokens_of_spans(spark):
    cells = [(1, 0, 2, 0, 1, "a", True, None, None), (1, 0, 1, 1, 3, "b", True, None, None), (1, 1, 2, 1, 2, "", None, None, None), (1, 2, 4, 0, 2, "x", None, True, None),
             (2, 0, 1, 0, 1, "s", None, None, True), (3, 0, 1, 0, 1, None, None, None, None), (3, 1, 2, 0, 1, "t", None, None, None)]
    got = {r.table_id: r.tokens for r in tables.as_tokens(spark.createDataFrame(cells, CELL)).collect()}
    assert got == {1: "<ched>a<ched>b<lcel><nl><ucel><ecel><nl><rhed>x<lcel><nl><ucel><xcel><nl>", 2: "<srow>s<nl>", 3: "<nl><fcel>t<nl>"}


def test_places_of_tokens(spark):
    said = [("1", "<ched>a<ched>b<lcel><nl><ucel><ecel><nl><rhed> x<lcel><nl><ucel><xcel><nl>"), ("uneven", "<fcel>a<fcel>b<nl><fcel>c<nl><fcel>d<fcel>e<nl><nl><nl>"),
            ("down", "<fcel>a<fcel>b<nl>\n<nl><ucel><nl><fcel>c<fcel>d<nl> "), ("none", ""), ("null", None), ("last", "<fcel>a<lcel><lcel>")]
    got = {}
    for r in markup.table_cells(spark.createDataFrame(said, "k string, x string"), "k", "x").collect():
        got.setdefault(r.table_id, set()).add((r.r0, r.r1, r.c0, r.c1, r.text, r.column_header, r.row_header))
    assert got == {
        "1": {(0, 2, 0, 1, "a", True, False), (0, 1, 1, 3, "b", True, False), (1, 2, 1, 2, "", False, False), (2, 4, 0, 2, "x", False, True)},
        "uneven": {(0, 1, 0, 1, "a", False, False), (0, 2, 1, 2, "b", False, False), (1, 2, 0, 1, "c", False, False), (2, 3, 0, 1, "d", False, False), (2, 3, 1, 2, "e", False, False)},
        "down": {(0, 3, 0, 1, "a", False, False), (0, 3, 1, 2, "b", False, False), (3, 4, 0, 1, "c", False, False), (3, 4, 1, 2, "d", False, False)},
        "last": {(0, 1, 0, 3, "a", False, False)},
    }


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", ("grid_densify", "table_markdown"))
def test_grids_are_laid_out_without_joins(spark, name):
    assert "Join" not in planned(catalogue.queries()[name](spark, DATA))


def test_later_cells_lie_over_earlier_ones(spark):
    cells = [(1, 0, 2, 0, 2, "a"), (1, 1, 2, 1, 2, "b"), (1, 0, 1, 3, 4, None), (1, 3, 4, 0, 1, "c"), (2, 0, 1, 0, 1, "alone")]
    grid = tables.densified(spark.createDataFrame(cells, "table_id long, r0 int, r1 int, c0 int, c1 int, text string"))
    assert grid.dtypes == [("table_id", "bigint"), ("r", "int"), ("c", "int"), ("text", "string")]
    got = {}
    for r in grid.collect():
        assert (r.table_id, r.r, r.c) not in got
        got[r.table_id, r.r, r.c] = r.text
    assert {k: v for k, v in got.items() if v} == {(1, 0, 0): "a", (1, 0, 1): "a", (1, 1, 0): "a", (1, 1, 1): "b", (1, 3, 0): "c", (2, 0, 0): "alone"}
    assert len(got) == 17
    said = {r.table_id: r.markdown for r in tables.as_markdown(grid).collect()}
    assert said[2] == "| alone |\n| --- |"
    assert said[1] == "| a | a |  |  |\n| --- | --- | --- | --- |\n| a | b |  |  |\n|  |  |  |  |\n| c |  |  |  |"
