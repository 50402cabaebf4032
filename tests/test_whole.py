import os

import pytest

from vellum.plans import catalogue

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")


def test_texts_are_whole(spark):
    queries = catalogue.queries()
    turns = {(r.conv_id, r.turn): r for r in spark.read.parquet(f"{DATA}/conversations.parquet").collect()}
    assert max(len(r.text) for r in turns.values()) > 30
    paths = queries["heading_path_whole"](spark, DATA).collect()
    assert paths and all(r.text == turns[r.doc_id, r.pos].text for r in paths)
    chunks = queries["contextualised_chunks_whole"](spark, DATA).collect()
    assert chunks and all(r.context.endswith(turns[r.doc_id, r.pos].text) for r in chunks)
    frames = queries["context_frame_whole"](spark, DATA).collect()
    assert all(r.frame == "|".join(turns[r.conv_id, k].text for k in range(max(r.turn - 3, 0), r.turn)) for r in frames)


def test_every_unit_and_region_is_joined(spark):
    queries = catalogue.queries()
    events = spark.read.parquet(f"{DATA}/events.parquet").filter("event_type = 'error'")
    found = queries["table_position_range_join_whole"](spark, DATA).collect()
    assert len(found) == events.count()
    assert {r.priority for r in found} == {1, 2} and any(r.unit_id % 97 for r in found)
    regions = {r.region for r in queries["cells_in_regions_whole"](spark, DATA).collect()}
    boxes = spark.read.parquet(f"{DATA}/embeddings.parquet").count()
    assert len(regions) == boxes and any(r % 10 for r in regions)
