"""Units are gathered from a stream of batches in order: no aggregation of elements, and the same units wherever batches end."""

import os

import pytest

from vellum.functions import markers as m
from vellum.operators import structure
from vellum.plans import catalogue

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ITEMS = "doc_id long, pos long, label string, text string, hyperlink string"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
def test_elements_of_units_are_not_aggregated(spark):
    plan = catalogue.queries()["unit_islands"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan


@pytest.mark.parametrize("size", ("1", "2", "5", "10000"))
def test_units_go_on_in_the_next_batch(spark, size):
    texts = ["before", "PRVÁ ČASŤ", "§ 1", "(1)", "one", "two", "a)", "three", "1.", "four", "five", "§ 2", "six", "Tento zákon nadobúda účinnosť", "between",
             "Príloha č. 1", "seven", "eight", "Poznámky", "1)", "nine", "ten"]
    rows = [(d, k, "text", t, "#poznamky" if t == "Poznámky" else None) for d in (1, 2, None) for k, t in enumerate(texts[: 12 if d == 2 else None])]
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    try:
        got = structure.units(spark.createDataFrame(rows, ITEMS)).collect()
        counts = {r.doc_id: r.paragraphs for r in structure.counters(spark.createDataFrame(rows, ITEMS)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
    first = [("part-0", -1, "before"), ("part-1", 1, ""), ("paragraf-1", 2, ""), ("odsek-1.1", 3, "one\ntwo"), ("pismeno-1.1.a", 6, "three"),
             ("subitem-1.1.a.1", 8, "four\nfive"), ("paragraf-2", 11, "")]
    rest = [("paragraf-2", 11, "six"), ("annex-1", 15, "seven\neight"), ("footnote-1", 19, "nine\nten")]
    for doc, said in ((1, first[:-1] + rest), (2, first), (None, first[:-1] + rest)):
        assert sorted(((r.unit_id, r.pos, r.text) for r in got if r.doc_id == doc), key=lambda x: x[1]) == said
    assert counts == {1: 2, 2: 2, None: 2}


def test_quick_tests_of_texts_leave_nothing_out(spark):
    texts = ["  a b \t", "a  ", "a \x85", "\n a\r\n", "", None, " ", "\x0bx\x0c", "a", "PÍſM. a)", "pISM", "piSm", "písM", "prizma"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    spaced = "regexp_replace(replace(t, ' ', ' '), '^\\\\s+|\\\\s+$', '')"
    rows = df.select(m.normalised(df.t).alias("a"), m.may_name_letters(df.t).alias("b"), "t").selectExpr("a", "b", f"{spaced} AS c", "coalesce(t RLIKE '(?iuU)p[ií]sm', false) AS d")
    assert all(r.a == r.c and r.b == r.d for r in rows.collect())
