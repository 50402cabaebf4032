"""Generated code of statute queries: methods over 8,000 bytes are never compiled by the JVM and run many times slower."""

import contextlib
import io
import os
import re

import pytest

from vellum.plans import catalogue

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
QUERIES = (
    "unit_islands", "unit_counters", "references_index", "extract_refs", "resolve_refs_one_level", "resolve_footnotes", "superior_content",
    "unit_chunks_pismeno", "unit_chunks_odsek", "unit_chunks_paragraph", "unit_chunks_part", "rag_projection", "chunks_markdown",
    "chunk_level_counts", "nested_sections",
)


def plan(df, mode):
    said = io.StringIO()
    with contextlib.redirect_stdout(said):
        df.explain(mode)
    return said.getvalue()


@pytest.mark.parametrize("name", QUERIES)
def test_methods_are_small_enough_to_be_compiled(spark, name):
    kept = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = re.findall(r"maxMethodCodeSize:(\d+)", plan(catalogue.queries()[name](spark, DATA), "codegen"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", kept)
    assert sizes and max(map(int, sizes)) < 8_000


@pytest.mark.parametrize("level", ("paragraph", "odsek"))
def test_chunks_make_units_once(spark, level):
    said = plan(catalogue.queries()[f"unit_chunks_{level}"](spark, DATA), "simple")
    assert said.count("part_no") and len(re.findall(r"Window \[last\(", said)) == 1


def test_annexes_that_repeat_an_id_stay_apart(spark):
    from vellum.operators import chunks

    kind = "doc_id long, unit_id string, level string, pos long, parent_id string, part_no long, text string"
    units = spark.createDataFrame(
        [(1, "part-1", "part", 0, None, 1, "p"), (1, "annex-1", "annex", 5, None, 1, "one"), (1, "annex-1", "annex", 9, None, 1, ""), (1, "annex-2", "annex", 11, None, 1, None)], kind
    )
    for level in chunks.CHUNK_LEVELS:
        got = {(r.chunk_id, r.pos, r.content) for r in chunks.unit_chunks(units, level).collect() if r.level == "annex"}
        assert got == {("annex-1", 5, "one"), ("annex-1", 9, ""), ("annex-2", 11, None)}
