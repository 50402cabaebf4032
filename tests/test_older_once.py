"""Documents of the older schema are made and read within their rows: rows are shuffled by order once, and nothing is written on the way."""

import os

import pytest
from pyspark.sql import functions as F

from vellum.plans import catalogue
from vellum.sources import older

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
CELL = (
    "struct<r0: int, r1: int, c0: int, c1: int, text: string, box: struct<l: double, t: double, r: double, b: double, origin: string>, "
    "column_header: boolean, row_header: boolean, row_section: boolean>"
)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", ("older_cells", "older_items", "older_tags", "older_markdown"))
def test_only_orders_and_lines_are_shuffled(spark, name):
    plan = catalogue.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("FileScan") == 2
    # JSON is written and read in one pass, nothing is worked out twice.
    assert plan.count("from_json(") == 1


def brute(cells, rows, columns):
    rows = max([x[1] for x in cells], default=0) if rows is None else rows
    columns = max([x[3] for x in cells], default=0) if columns is None else columns
    grid = [["" for _ in range(columns)] for _ in range(rows)]
    for r0, r1, c0, c1, text, *_ in sorted(cells, key=lambda x: (x[0], x[2])):
        for r in range(max(r0, 0), min(r1, rows)):
            for c in range(max(c0, 0), min(c1, columns)):
                grid[r][c] = text
    return rows, columns, grid if columns else []


def test_grids_like_cell_by_cell(spark):
    cell = lambda r0, r1, c0, c1, text: (r0, r1, c0, c1, text, None, False, None, True)
    tables = [
        ([cell(0, 1, 0, 1, "a"), cell(0, 3, 1, 3, "b"), cell(1, 2, 0, 2, "c"), cell(2, 3, 2, 4, "d")], None, None), ([cell(0, 5, 0, 5, "wide")], 2, 3), ([cell(0, 1, 0, 1, "x")], 3, None),
        ([cell(-1, 1, -2, 1, "low"), cell(1, 1, 0, 2, "flat"), cell(2, 1, 0, 1, "back")], None, 2), ([], None, 4), ([], 2, 2), ([], 0, 0), ([cell(0, 1, 0, 1, "cut")], 0, None),
        ([cell(r, r + 1, c, c + 1, f"{r},{c}") for r in range(12) for c in range(11)], None, None),
    ]
    df = spark.createDataFrame([(k, *x) for k, x in enumerate(tables)], f"k int, cells array<{CELL}>, num_rows int, num_cols int")
    made = df.select("k", older.laid(F.col("cells"), F.col("num_rows"), F.col("num_cols"), F.lit(9.0)).alias("x")).select("k", "x.*").collect()
    for r in made:
        assert (r["#-rows"], r["#-cols"], [[x.text for x in line] for line in r.data]) == brute(*tables[r.k]), r.k
    first = {r.k: r.data for r in made}[0]
    assert first[1][1].spans == [[1, 0], [1, 1]] and first[1][1]["row-span"] == [1, 2] and first[1][1].type == "row_section" and (first[1][1].row, first[1][1].col) == (1, 1)
    assert first[0][3].spans == [[0, 3]] and first[0][3].type == "body" and first[0][3].row is None and first[0][3]["col-header"] is None


def test_captions_of_two_documents_and_floats_are_numbered_in_order(spark):
    text = lambda pos, label, said=None, of=None, layer="body": (pos, label, layer, said, None, None, of, None, None, None, None, None)
    kinds = "pos: long, label: string, layer: string, text: string, page_no: int, box: struct<l: double, t: double, r: double, b: double, origin: string>, caption_of: long, marker: string, height: double, data: array<array<struct<text: string>>>, `#-rows`: int, `#-cols`: int"
    items = [text(5, "picture"), text(0, "caption", "of five", 5), text(1, "table"), text(2, "picture"), text(3, "caption", "and one", 1), text(4, "caption", "of one", 1), text(9, "caption", "of none", 8)]
    df = spark.createDataFrame([(1, items, None), (2, [text(0, "page_header", "h", layer="furniture")], None), (3, [text(0, "nothing", "x", layer="furniture")], None), (4, [], None)],
                               f"doc_id long, items array<struct<{kinds}>>, sheets array<struct<page_no: int, height: double, width: double>>")
    read = older.parsed(older.as_json(df))
    got = [(r.doc_id, r.pos, r.label, r.text, r.caption_of) for r in older.items(read).orderBy("doc_id", "pos", "label").collect()]
    assert [x for x in got if x[0] == 1] == [
        (1, 0, "table", None, None), (1, 1, "text", "and one", None), (1, 2, "text", "of one", None), (1, 3, "picture", None, None), (1, 4, "picture", None, None), (1, 5, "caption", "of five", 4),
        (1, 6, "text", "of none", None),
    ]
    assert [x for x in got if x[0] > 1] == [(2, -1, "page_header", "h", None)]
    assert read.count() == 2 and read.filter("doc_id = 1").first().document["tables"][0]["text"] == "and oneof one"
