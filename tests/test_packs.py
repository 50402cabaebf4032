"""Units travel in packs: rows are shuffled by document before their elements are made, and units are shuffled once more, many a row."""

import os
import re

import pytest

from vellum.operators import structure
from vellum.plans import catalogue

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ITEMS = "doc_id long, pos long, label string, text string, hyperlink string"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", ("chunk_level_counts", "rag_projection", "unit_chunks_odsek", "nested_sections", "references_index", "unit_chunks_pismeno"))
def test_neither_elements_nor_single_units_are_shuffled(spark, name):
    plan = catalogue.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("MapInArrow", 1)
    # Packs, and the counts of a level.
    assert re.findall(r"Exchange hashpartitioning\((\w+)#", above) == ["level"] * (name == "chunk_level_counts") + ["doc_id"]
    assert re.search(r"Generate inline\(arrays_zip.*\n.*Exchange hashpartitioning\(doc_id", above)
    # The elements of all kinds meet in order without a shuffle of their own.
    assert re.search(r"Window \[last\(.*\n.*Sort \[doc_id.*\n.*Union", below)


@pytest.mark.parametrize("together", (True, False))
def test_documents_of_many_packs(spark, together):
    n = structure.PACK + 500
    rows = [(d, k, "text", t, None) for d in (1, 2, None) for k, t in enumerate(x for k in range(n) for x in (f"§ {k + 1}", f"said {k}"))]
    got = structure.units(spark.createDataFrame(rows, ITEMS), together=together).collect()
    for d in (1, 2, None):
        own = sorted((r.pos, r.unit_id, r.parent_id, r.text) for r in got if r.doc_id == d)
        assert own == [(2 * k, f"paragraf-{k + 1}", "part-0", f"said {k}") for k in range(n)]


@pytest.mark.parametrize("together", (True, False))
def test_ids_and_parents_by_path(spark, together):
    texts = ["before", "PRVÁ ČASŤ", "§ 1", "(1)", "1.", "a", "a)", "10.", "b", "(12)", "aa)", "Tento zákon nadobúda účinnosť", "Príloha č. 1", "c", "Poznámky", "12)", "d"]
    rows = [(1, k, "text", t, "#poznamky" if t == "Poznámky" else None) for k, t in enumerate(texts)]
    got = structure.units(spark.createDataFrame(rows, ITEMS), together=together).collect()
    assert sorted((r.pos, r.unit_id, r.level, r.parent_id, r.part_no) for r in got) == [
        (-1, "part-0", "part", None, 0), (1, "part-1", "part", None, 1), (2, "paragraf-1", "paragraph", "part-1", 1), (3, "odsek-1.1", "odsek", "paragraf-1", 1),
        (4, "subitem-1.1.1", "subitem", None, 1), (6, "pismeno-1.1.a", "pismeno", "odsek-1.1", 1), (7, "subitem-1.1.a.10", "subitem", "pismeno-1.1.a", 1),
        (9, "odsek-1.12", "odsek", "paragraf-1", 1), (10, "pismeno-1.12.aa", "pismeno", "odsek-1.12", 1), (12, "annex-1", "annex", None, 1), (15, "footnote-12", "footnote", None, 1),
    ]
