"""Statutes: units are made once, and repeated ids, marks without a note and closed levels come out as by joins."""

import os

import pytest

from vellum.operators import context, structure
from vellum.plans import catalogue

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
UNIT = "doc_id long, unit_id string, level string, pos long, parent_id string, part_no long, text string"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", ("superior_content", "resolve_footnotes", "resolve_refs_one_level"))
def test_units_are_made_once(spark, name):
    plan = catalogue.queries()[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Union") == 1  # of the four kinds of elements


def test_repeated_ids_answer_each(spark):
    units = spark.createDataFrame(
        [(1, "part-1", "part", 0, None, 1, "P"), (1, "paragraf-1", "paragraph", 1, None, 1, "one § 2"), (1, "paragraf-1", "paragraph", 5, None, 1, "again"),
         (1, "odsek-1.1", "odsek", 2, None, 1, "x [1] y [2] § 1 § 9"), (1, "footnote-1", "footnote", 9, None, 1, "note"), (1, "odsek-7.1", "odsek", 8, None, 3, None)], UNIT
    )
    got = {(r.unit_id, r.paragraph_text, r.part_text) for r in context.superior(units).collect()}
    assert got == {("odsek-1.1", "one § 2", "P"), ("odsek-1.1", "again", "P"), ("odsek-7.1", None, None)}
    got = {tuple(r) for r in context.resolved_footnotes(units).collect()}
    assert got == {(1, "odsek-1.1", "1", "note"), (1, "odsek-1.1", "2", None)}
    got = {tuple(r)[1:] for r in context.resolved_one_level(units).collect()}
    assert got == {("paragraf-1", "2", None, None, None), ("odsek-1.1", "1", "paragraf-1", "one § 2", "2"),
                   ("odsek-1.1", "1", "paragraf-1", "again", None), ("odsek-1.1", "9", None, None, None)}


def test_parts_count_in_the_main_text_only_and_letters_named_before_are_none(spark):
    texts = ["PRVÁ ČASŤ", "§ 1", "(1)", "podľa písm.", "a)", "x", "y", "b)", "said", "Tento zákon nadobúda účinnosť 1. januára.", "Príloha č. 1 k zákonu č. 2",
             "DRUHÁ ČASŤ", "more"]
    items = spark.createDataFrame([(1, k, "text", t, None) for k, t in enumerate(texts)], "doc_id long, pos long, label string, text string, hyperlink string")
    got = {r.unit_id: (r.part_no, r.text) for r in structure.units(items).collect()}
    assert got == {"part-1": (1, ""), "paragraf-1": (1, ""), "odsek-1.1": (1, "podľa písm.\na)\nx\ny"), "pismeno-1.1.b": (1, "said"), "annex-1": (1, "DRUHÁ ČASŤ\nmore")}
    counts = structure.counters(items).first().asDict()
    assert counts == {"doc_id": 1, "parts": 1, "paragraphs": 1, "odseks": 1, "pismenos": 1, "subitems": 0, "annexs": 1, "footnotes": 0}
