import json

from pyspark.sql import functions as F

from vellum.functions import text
from vellum.operators import analytics, chunks, structure
from vellum.sources import legacy, pages, pictures


def rectangle(l, t, r, b):
    return dict(zip([f"r_{a}{k}" for k in range(4) for a in "xy"], [l, t, r, t, r, b, l, b]), coord_origin="TOPLEFT")


PAGE = {
    "dimension": {"angle": 0.0, "rect": rectangle(0, 0, 100, 200), "boundary_type": "crop_box", "crop_bbox": {"l": 0, "t": 0, "r": 100, "b": 200}},
    "textline_cells": [
        {"index": 0, "rect": rectangle(1, 2, 30, 12), "text": "One", "orig": "One", "from_ocr": False},
        {"index": 1, "rect": rectangle(1, 20, 40, 32), "text": "two", "orig": "two", "from_ocr": True},
    ],
    "word_cells": [], "has_lines": True, "lines": [{"index": 0, "parent_id": 1, "points": [[0, 0], [5, 5]]}],
}


def test_segmented_pages(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(PAGE))
    (tmp_path / "b.json").write_text("[")
    read = pages.read_pages(spark, str(tmp_path))
    got = [(r.ord, r.text, r.l, r.t, r.r, r.b, r.from_ocr) for r in pages.cells(read).orderBy("ord").collect()]
    assert got == [(0, "One", 1, 2, 30, 12, False), (1, "two", 1, 20, 40, 32, True)]
    assert pages.cells(read, "word").count() == 0 and read.filter("page IS NULL").count() == 1
    again = read.filter("page IS NOT NULL").select("doc_id", F.from_json(pages.as_json(F.col("page")), pages.PAGE).alias("page"))
    assert again.first().page == read.filter("page IS NOT NULL").first().page
    assert again.first().page.lines[0].points == [[0.0, 0.0], [5.0, 5.0]]


def test_parsed_files_and_contents(spark, tmp_path):
    toc = {"text": "Root", "children": [{"text": "A", "marker": "1", "children": [{"text": "B"}]}, {"text": "C"}]}
    (tmp_path / "a.json").write_text(json.dumps({"pages": {"10": PAGE, "2": PAGE}, "table_of_contents": toc}))
    assert [r.page_no for r in pages.in_order(pages.read_files(spark, str(tmp_path))).collect()] == [2, 10]
    rows = pages.contents(spark.createDataFrame([(1, json.dumps(toc)), (2, None), (3, "{")], "k long, j string"), "k", "j").orderBy("ord").collect()
    assert [(r.k, r.depth, r.path, r.text, r.marker) for r in rows] == [
        (1, 0, [], "Root", ""), (1, 1, [0], "A", "1"), (1, 2, [0, 0], "B", ""), (1, 1, [1], "C", "")
    ]


def test_older_documents_both_ways(spark, tmp_path):
    document = {
        "_name": "d", "type": "pdf-document", "description": {"abstract": "one", "authors": {"name": "x"}}, "file-info": {"filename": "f"},
        "main-text": [
            {"type": "title", "text": "T"}, {"type": "subtitle-level-1", "text": "S", "prov": [{"page": 2, "bbox": [0, 0, 1, 1]}]},
            {"__ref": "#/tables/0"}, {"$ref": "#/figures/0"}, {"type": "paragraph", "text": "p"}, {"$ref": "#/tables/9"},
        ],
        "tables": [{"type": "table", "text": "tab", "#-cols": 1, "#-rows": 1}], "figures": [{"type": "figure", "text": "fig"}],
        "page-headers": [{"type": "page-header", "text": "h"}],
    }
    (tmp_path / "a.json").write_text(json.dumps(document))
    (tmp_path / "b.json").write_text("{}")
    read = legacy.read(spark, str(tmp_path))
    one = read.filter("document IS NOT NULL").first()
    assert (one.abstract, [json.loads(a) for a in one.authors], one.collection_type) == (["one"], [{"name": "x"}], "Document")
    assert read.filter("document IS NULL").count() == 1
    items = legacy.items(read.filter("document IS NOT NULL"))
    got = [(r.pos, r.type, r.label, r.text, r.page_no) for r in items.orderBy("pos").collect()]
    assert got == [
        (-1, "page-header", "page_header", "h", None), (0, "title", "title", "T", None), (1, "subtitle-level-1", "section_header", "S", 2),
        (2, "table", "table", "tab", None), (3, "figure", "picture", "fig", None), (4, "paragraph", "text", "p", None), (5, None, "text", None, None),
    ]
    made = json.loads(legacy.from_items(items.filter("type IS NOT NULL")).first().json)
    assert [x.get("$ref") or (x["type"], x["text"]) for x in made["main-text"]] == [
        ("title", "T"), ("subtitle-level-1", "S"), "#/tables/0", "#/figures/0", ("paragraph", "p")
    ]
    assert [x["text"] for x in made["tables"] + made["figures"] + made["page-headers"]] == ["tab", "fig", "h"]


def test_charts_and_predictions(spark):
    charts = [
        {"kind": "line_chart_data", "lines": [{"label": "a", "values": [[0, 1], [1, 2]]}]}, {"kind": "bar_chart_data", "bars": [{"label": "x", "values": 3}]},
        {"kind": "stacked_bar_chart_data", "stacked_bars": [{"label": ["u", "v"], "values": [[0, 4], [0, 5]]}]},
        {"kind": "pie_chart_data", "slices": [{"label": "s", "value": 0.5}]}, {"kind": "scatter_chart_data", "points": [{"value": [7, 8]}]},
        {"kind": "tabular_chart_data", "chart_data": {"table_cells": [{"text": "c", "start_row_offset_idx": 2, "start_col_offset_idx": 1}]}},
    ]
    rows = spark.createDataFrame([(k, json.dumps(c)) for k, c in enumerate(charts)], "chart_id long, j string")
    rows = rows.select("chart_id", F.from_json("j", pictures.CHART).alias("chart"))
    got = [(r.chart_id, r.series, r.ord, r.label, r.x, r.y) for r in pictures.chart_points(rows).orderBy("chart_id", "ord").collect()]
    assert got == [
        (0, "a", 0, None, 0, 1), (0, "a", 1, None, 1, 2), (1, None, 0, "x", None, 3), (2, "0", 0, "u", 0, 4), (2, "0", 1, "v", 0, 5),
        (3, None, 0, "s", None, 0.5), (4, None, 0, None, 7, 8), (5, None, 0, "c", 1, 2),
    ]
    meta = {"summary": {"text": "S"}, "classification": {"predictions": [{"class_name": "bar_chart", "confidence": 0.2}, {"class_name": "pie_chart", "confidence": 0.7}]}}
    unsure = {"classification": {"predictions": [{"class_name": "x_y"}, {"class_name": "z"}]}, "molecule": {"smi": "CO"}}
    rows = spark.createDataFrame([(1, json.dumps(meta)), (2, json.dumps(unsure))], "k long, j string").select("k", F.from_json("j", pictures.META).alias("m"))
    got = sorted((r.k, r["name"], r.text) for r in pictures.meta_texts(rows, "k", "m").collect())
    assert got == [(1, "classification", "pie chart"), (1, "summary", "S"), (2, "classification", "x y"), (2, "molecule", "CO")]
    said = spark.createDataFrame(
        [("classification", ["a_b"], None, None), ("description", [], "d", None), ("molecule_data", [], None, "m"), ("misc", ["q"], "w", "e"), ("classification", [], None, None)],
        "k string, c array<string>, t string, s string",
    )
    assert [r[0] for r in said.select(pictures.annotation_text(*map(F.col, "kcts"))).collect()] == ["a b", "d", "m", None, None]
    place = spark.createDataFrame([("data:x", 3, 7), ("https://x/y.png", 3, 8), (None, 1, 0)], "u string, p int, n int")
    named = lambda mode: [r[0] for r in place.select(pictures.image_reference(mode, F.col("u"), F.lit("art"), F.col("p"), F.col("n"))).collect()]
    assert named("placeholder") == [None] * 3 and named("embedded") == ["data:x", None, None]
    assert named("referenced") == ["art/image_000007_p3.png", "https://x/y.png", "art/image_000000_p1.png"]


def test_named_chunks_and_single_pass(spark):
    texts = ["PRVÁ ČASŤ", "§ 5", "(1)", "daň[3] podľa § 10a[3]", "(2)", "iné", "Tento zákon nadobúda účinnosť", "Poznámky", "3)", "Zákon"]
    rows = [(1, i, "text", "body", t, "#poznamky" if t == "Poznámky" else None) for i, t in enumerate(texts)]
    items = spark.createDataFrame(rows, "doc_id long, pos long, label string, layer string, text string, hyperlink string")
    units = structure.units(items)
    one = chunks.identified(units, "odsek", "5.1").first()
    assert one.content == "daň[3] podľa § 10a[3]" and [(r.type, r.target) for r in one.references] == [("paragraph", "10a")]
    assert [(f.number, f.text) for f in one.footnotes] == [("3", "Zákon")]
    assert chunks.identified(units, "paragraph", "5").first().content == "daň[3] podľa § 10a[3]\niné"
    assert chunks.identified(units, "paragraph", "6").count() == 0
    said = spark.createDataFrame([(1, "x"), (2, " "), (3, " <unknown> "), (4, None)], "k long, text string")
    assert [r.k for r in chunks.generated(said).collect()] == [1]
    found = analytics.post_processed(items, {"tax": "daň", "none": "qq"}).first()
    assert (found.paragraphs, found.parts, found.tax, found.none) == (["5"], ["PRVÁ ČASŤ"], 3, None)
    spans = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (1, 2, "a")], "r long, seq long, node string")
    assert sorted((r.node, r.seq) for r in analytics.unique_spans(spans, "r").collect()) == [("a", 0), ("b", 1)]
    assert analytics.aliased(spans, {"r": "_r"}).columns == ["_r", "seq", "node"]
    rows, seen = analytics.observed(spans, "spans", last=F.max("seq"))
    rows.collect()
    assert seen.get == {"rows": 3, "last": 2}


def test_relative_paths(spark):
    pairs = {("/a/b/c", "/a/b/d/e"): "../d/e", ("/a", "/a"): ".", ("/a/b", "/"): "../..", ("/", "/x"): "x", ("a", "/b"): None, ("/a/x", "/b/x"): "../../b/x"}
    df = spark.createDataFrame([(*k,) for k in pairs], "s string, t string")
    assert [r[0] for r in df.select(text.relative_path(F.col("s"), F.col("t"))).collect()] == list(pairs.values())


def test_schemas_of_collections_and_raw_pages(spark):
    from vellum.sources import records

    def problems(name, *texts, package=None):
        rows = spark.createDataFrame(list(enumerate(texts)), "k long, j string")
        return [r.problem for r in records.validated_as(rows, "j", name, package).orderBy("k").collect()]

    whole = {"created": "2024", "source": "s", "type": "Document", "version": [{"name": "p", "version": "1"}]}
    twice = whole | {"version": whole["version"] * 2}
    said = problems("collection", json.dumps(whole), json.dumps(twice), json.dumps(whole | {"version": []}), "{}", package="p")
    assert said == [None, "several versions of p", "no version of p", "created lacks"]
    assert problems("raw_page", json.dumps({"cells": [{"angle": 0.5}]}), json.dumps({"cells": 3})) == [None, "not as the schema says"]
    empty = {"dimension": {"width": 1, "height": 2}, "words": [], "cells": [], "boxes": [], "paths": []}
    assert problems("ocr", json.dumps(empty), json.dumps({"words": []})) == [None, "dimension lacks"]
    assert all(set(records.SCHEMAS[n][1]) for n in records.SCHEMAS)
