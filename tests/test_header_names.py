"""Names of columns: rows after one that is no header don't count, and cells are shuffled once, by table."""

import os

import pytest

from vellum.operators import rendering
from vellum.plans import catalogue

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_leading_rows(spark):
    flags = {1: (True, True, False, True), 2: (False, True, True, True), 3: (None, True, None, False), 4: (True, None, True)}
    rows = [(t, r, c, f"{r}{c}", f if c else None) for t, all_of in flags.items() for r, f in enumerate(all_of) for c in range(2)]
    grid = spark.createDataFrame([*rows, (None, 0, 0, "x", True), (1, 1, 2, None, False)], "table_id long, r int, c int, text string, is_header boolean")
    got = {(x.table_id, x.c, x.name) for x in rendering.header_names(grid).collect()}
    assert got == {(1, 0, "00.10"), (1, 1, "01.11"), (1, 2, ""), (3, 0, "10.20"), (3, 1, "11.21"), (4, 0, "00.10.20"), (4, 1, "01.11.21"), (None, 0, "x")}


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
def test_cells_are_read_and_shuffled_once(spark):
    plan = catalogue.queries()["header_names"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 1 and "Join" not in plan
