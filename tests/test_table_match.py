from vellum.operators import tables


def grid(table_id, *rows, doc_id=1):
    return [(doc_id, table_id, r, c, text) for r, row in enumerate(rows) for c, text in enumerate(row)]


def test_tables_are_found_by_headers_and_values(spark):
    cells = grid(0, ["Skupina", "Doba"], ["1", "nič"]) + grid(1, ["x", "y"], ["a", "Dva roky"], ["b", "štyri roky"])
    cells += grid(2, ["Odpisová skupina", "Doba odpisovania"], ["a", "x"]) + grid(3, ["x", "y"], ["a", "dva roky"], ["b", "štyri roky"])
    cells += grid(4, ["x", "y"], ["a", "dva roky"], doc_id=2)
    cells = spark.createDataFrame(cells, "doc_id long, table_id long, r int, c int, text string")
    texts = [
        (1, 1, "0, 1 = dva roky. 1, 1 = štyri  ROKY."),
        (1, 2, "Odpisová skupina, 1 = Doba odpisovania."),
        (1, 3, "0, 1 = dva roky. 1, 1 = iné."),
        (2, 1, "0, 1 = dva roky. 1, 1 = tri dni."),
    ]
    texts = spark.createDataFrame(texts, "doc_id long, text_id long, text string")
    found = lambda *a: sorted(map(tuple, tables.best_table_match(texts, cells, *a).collect()))
    assert found() == [(1, 1, 1, 10), (1, 2, 2, 10)]
    gone = spark.createDataFrame([(1, 1, 1), (1, 2, 2)], "doc_id long, text_id long, table_id long")
    assert found(gone) == [(1, 1, 3, 10)]


def test_items_gather_their_descriptions(spark):
    rows = ["1-1", "*prvý", "*druhý", "inde", "1-2", "4-17 ", "*tretí", "Poznámky", "1-3", "*nie"]
    rows = [(1, k, "list_item" if t[0] == "*" else "text", t.lstrip("*")) for k, t in enumerate(["*pred", *rows])]
    rows += [(2, 0, "text", "2-1"), (2, 1, "list_item", "a")]
    elements = spark.createDataFrame(rows, "doc_id long, pos long, label string, text string")
    got = sorted(map(tuple, tables.described_items(elements).collect()))
    assert got == [(1, "1-1", 1, "prvý, druhý"), (1, "1-2", 5, ""), (1, "4-17", 6, "tretí"), (2, "2-1", 0, "a")]


def test_shared_words_are_counted_in_one_join(spark):
    texts = spark.createDataFrame([(1, "a b c d"), (2, "x Á x"), (3, ""), (4, None), (5, "lone word")], "text_id long, text string")
    held = spark.createDataFrame([(7, "a b"), (3, "c  D e"), (9, "a"), (8, "X a"), (2, None), (1, "")], "table_id long, header string")
    best = tables.best_header_match(texts, held)
    assert sorted(map(tuple, best.collect())) == [(1, 3, 2, 4), (2, 8, 2, 2)]
    assert sorted(map(tuple, tables.best_header_match(texts, held, 0.6).collect())) == [(2, 8, 2, 2)]
    # Lists of words don't go through joins.
    assert best._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
