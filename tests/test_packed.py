from vellum.operators import packing


def test_documents_are_packed_as_a_stream(spark):
    rows = [(1, 2, "h", "c d"), (1, 1, "h", "a b"), (1, 3, None, " "), (1, 4, "h", "e f g h i"), (1, 5, "one two three four five", "x y"), (2, 0, "", "p q r s t u v"),
            (2, None, None, "last"), (None, 0, None, "w"), (3, 0, None, None)]
    items = spark.createDataFrame(rows, "doc_id long, pos long, path string, text string")
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {
        (1, 0, "h", "a b\nc d", 5), (1, 1, "h", "e f g h", 5), (1, 2, "h", "i", 2), (1, 3, "one two three four five", "x y", 2), (2, 0, "", "p q r s t", 5),
        (2, 1, "", "u v\nlast", 3), (None, 0, "", "w", 1),
    }
    for size in (1, 10_000):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            made = packing.packed(items, 5)
            assert set(map(tuple, made.collect())) == want
            assert {r.text for r in packing.packed(items, 5, merge_peers=False).collect()} >= {"a b", "c d", "last"}
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
    # No data frame a document.
    assert "FlatMapGroups" not in made._jdf.queryExecution().optimizedPlan().toString()
