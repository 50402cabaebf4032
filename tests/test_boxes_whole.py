import os

import pytest

from vellum.plans import catalogue

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
def test_boxes_of_different_blocks_meet_once(spark):
    pairs = [(r.a, r.b) for r in catalogue.queries()["bbox_iou_join_whole"](spark, DATA).collect()]
    assert any(a // 10 != b // 10 for a, b in pairs)
    assert len(pairs) == len(set(pairs))
