import os

import pytest
from pyspark.sql import functions as F

from vellum.functions import geometry as g
from vellum.operators import layout
from vellum.plans import catalogue

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_lines_round_exact_values(spark):
    values = [0.125, 0.375, 1.005, 2.675, 0.285, -1.005, -0.001, 0.0, 0.995, 99.995, -12.345, 7.0, 1234.565, 0.29]
    values += [k / 1000 for k in range(-20_000, 20_000, 7)]
    x = F.col("x")
    rows = spark.createDataFrame([(v,) for v in values], "x double").select(x, layout.text_line(g.box(x, x, x, x), F.lit("a")).alias("line"))
    for r in rows.collect():
        assert r.line == f"({r.x:06.2f}, {r.x:06.2f}) ({r.x:06.2f}, {r.x:06.2f}) a"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
def test_every_box_has_a_line(spark):
    lines = catalogue.queries()["text_lines_whole"](spark, DATA)
    assert lines.count() == spark.read.parquet(f"{DATA}/embeddings.parquet").count()
    assert lines.filter("line LIKE '(-%'").count() > 0


def test_zeros_keep_their_sign(spark, tmp_path):
    rows = [(1, 0, [-0.000001, 0.5, -0.000002, 0.25])]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    (row,) = catalogue.queries()["text_lines_whole"](spark, str(tmp_path)).collect()
    assert row.line == "(-00.00, -00.00) (050.00, 025.00) 0"
