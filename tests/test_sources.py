import json

from vellum.operators import code, search, tables, trees
from vellum.sources import documents, html, manifest, markup
from vellum.streaming import incremental

DOCUMENT = {
    "schema_name": "Doc", "version": "1.3.0", "name": "d",
    "body": {"self_ref": "#/body", "children": [{"$ref": "#/texts/0"}, {"$ref": "#/groups/0"}, {"$ref": "#/tables/0"}]},
    "groups": [{"self_ref": "#/groups/0", "parent": {"$ref": "#/body"}, "children": [{"$ref": "#/texts/1"}], "label": "list"}],
    "texts": [
        {"self_ref": "#/texts/0", "parent": {"$ref": "#/body"}, "children": [], "label": "title", "text": "T", "prov": [{"page_no": 1}]},
        {"self_ref": "#/texts/1", "parent": {"$ref": "#/groups/0"}, "children": [], "label": "list_item", "text": "x", "marker": "-"},
        {"self_ref": "#/texts/2", "parent": {"$ref": "#/body"}, "children": [], "label": "page_footer", "text": "f"},
    ],
    "tables": [{"self_ref": "#/tables/0", "parent": {"$ref": "#/body"}, "children": [], "label": "table", "data": {
        "num_rows": 2, "num_cols": 2, "table_cells": [
            {"text": "a", "start_row_offset_idx": 0, "end_row_offset_idx": 1, "start_col_offset_idx": 0, "end_col_offset_idx": 2, "column_header": True},
            {"text": "b", "start_row_offset_idx": 1, "end_row_offset_idx": 2, "start_col_offset_idx": 1, "end_col_offset_idx": 2}]}}],
    "pages": {"1": {"page_no": 1, "size": {"width": 10.0, "height": 20.0}}},
}


def test_documents_from_json(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(DOCUMENT))
    (tmp_path / "b.json").write_text("{")
    (tmp_path / "c.json").write_text(json.dumps(DOCUMENT | {"version": "2.0.0"}))
    read = documents.checked(documents.read_json(spark, str(tmp_path)))
    assert sorted(str(r.problem) for r in read.collect()) == ["None", "unreadable", "version 2.0.0"]
    fine = read.filter("problem IS NULL")
    got = {r.node: (r.kind, r.label, r.layer, r.ord, r.parent) for r in documents.items(fine).collect()}
    assert got["#/texts/0"] == ("texts", "title", "body", 0, "#/body")
    assert got["#/texts/1"][3:] == (0, "#/groups/0")
    assert got["#/texts/2"][2:4] == ("furniture", None)
    assert len(got) == 5
    grid = tables.densified(documents.cells(fine)).orderBy("r", "c").collect()
    assert [r.text for r in grid] == ["a", "a", "", "b"]
    tokens = tables.as_tokens(documents.cells(fine)).first().tokens
    assert tokens == "<ched>a<lcel><nl><fcel>b<nl>"
    assert [(r.page_no, r.height) for r in documents.pages(fine).collect()] == [(1, 20.0)]


def test_documents_from_yaml(spark, tmp_path):
    (tmp_path / "a.yaml").write_text(json.dumps(DOCUMENT))
    (tmp_path / "b.yaml").write_text("a: [1, {")
    read = documents.checked(documents.read_yaml(spark, str(tmp_path)))
    assert documents.items(read).count() == 5
    assert sorted(str(r.problem) for r in read.collect()) == ["None", "unreadable"]


def test_table_tokens_with_spans(spark):
    tokens = "<ched>h<lcel><nl><fcel>a<fcel>b<nl><ucel><ecel><nl>"
    rows = markup.table_cells(spark.createDataFrame([(1, tokens)], "t long, x string"), "t", "x").collect()
    got = {(r.r0, r.c0): (r.r1, r.c1, r.text, r.column_header) for r in rows}
    assert got == {(0, 0): (1, 2, "h", True), (1, 0): (3, 1, "a", False), (1, 1): (2, 2, "b", False), (2, 1): (3, 2, "", False)}


def test_markup_pages(spark):
    body = "<title><loc_0><loc_50><loc_500><loc_100>T</title><page_break>\n<section_header_level_2>S</section_header_level_2><page_footer>f</page_footer><text>open"
    rows = markup.items(markup.pages_of(spark.createDataFrame([(1, body)], "d long, x string"), "d", "x"), "d", 10.0, 20.0).collect()
    got = [(r.page_no, r.label, r.level, r.layer, r.text) for r in sorted(rows, key=lambda r: (r.page_no, r.ord))]
    assert got == [(1, "title", None, "body", "T"), (2, "section_header", 2, "body", "S"), (2, "page_footer", None, "furniture", "f")]
    assert [r.box for r in rows if r.box][0].r == 10.0


def test_key_values(spark):
    body = "<key_1>Name<link_2></key_1><value_2>Ann</value_2><key_3>Age<link_9></key_3>"
    cells, links = markup.key_values(spark.createDataFrame([(1, body)], "d long, x string"), "d", "x")
    assert sorted((r.kind, r.cell_id, r.text) for r in cells.collect()) == [("key", 1, "Name"), ("key", 3, "Age"), ("value", 2, "Ann")]
    assert [(r.source, r.target) for r in links.collect()] == [(1, 2)]


def test_html_elements_and_annexes(spark):
    page = (
        "<html><title>A &amp; B</title><body><nav><p>menu</p></nav><h1>H</h1><p>one<br>two<p>three<script>var x='<p>';</script>"
        "<div class='priloha' id='priloha-1'><div class='prilohaOznacenie'>Príloha č. 1</div><a href='x.pdf'>file</a></div>"
        "<div class='priloha'><div class='prilohaOznacenie'>Príloha č. 2</div></div></body></html>"
    )
    found = html.elements(spark.createDataFrame([(1, page), (2, None)], "k long, h string"), "k", "h").cache()
    got = [(r.tag, r.layer, r.text) for r in found.orderBy("pos").collect()]
    assert ("title", "body", "A & B") in got and ("p", "furniture", "menu") in got and ("p", "body", "three") in got
    rows = html.annexes(found, "k").orderBy("number").collect()
    assert [(r.number, r.kind, r.url) for r in rows] == [("1", "external", "x.pdf"), ("2", "inline", None)]


def test_manifest(spark, tmp_path):
    (tmp_path / "manifest.yaml").write_text(
        "law_id: 1/2003\nannexes:\n  - {number: '1', title: A, type: external_pdf, filename: a.pdf, unknown: 1}\n  - {number: '2', local_path: /b.pdf, some_path: c.json}\n"
    )
    (tmp_path / "other.yaml").write_text("law_id: [")
    rows = manifest.annexes(manifest.read(spark, str(tmp_path))).orderBy("ord").collect()
    assert [(r.number, r.kind) for r in rows] == [("1", "external_pdf"), ("2", "inline")]
    assert rows[0].file.endswith("/a.pdf") and rows[1].file == "/b.pdf"
    assert rows[0].cache is None and rows[1].cache.endswith("/c.json")


def test_code_chunks(spark):
    source = "# Copyright me\nimport os\nimport re\nX = 1\n\ndef f():\n    'doc'\n    return os.sep\n\nclass A:\n    def __init__(self):\n        pass\n    def g(self):\n        return re.I\n\nclass B:\n    y = 1\n"
    files = spark.createDataFrame([(1, source, "python"), (2, "int x;", "c"), (3, "def (", "python"), (4, None, "c")], "k long, c string, l string")
    got = {(r.k, r.type, r["name"]): r for r in code.code_chunks(files, "k", "c", "l").collect()}
    assert set(got) == {(1, "preamble", ""), (1, "function", "f"), (1, "method", "A.g"), (1, "class", "B"), (2, "code_block", ""), (3, "code_block", "")}
    assert got[1, "function", "f"].text == "import os\ndef f():\n    'doc'\n    return os.sep"
    assert got[1, "function", "f"].docstring == "doc"
    assert got[1, "preamble", ""].text == "import os\nimport re\nX = 1"


def test_index_definition():
    schema = {
        "$defs": {"P": {"type": "object", "properties": {"n": {"type": "integer"}, "up": {"$ref": "#/$defs/P"}}}},
        "properties": {
            "a": {"anyOf": [{"type": "string"}, {"type": "null"}], **search.es_field(type="keyword")},
            "b": {"type": "array", "items": {"$ref": "#/$defs/P"}}, "c": {"type": "string", "x-es-suppress": True},
            "d": {"type": "string", "format": "date-time"},
        },
    }
    made = search.index_definition(schema)["mappings"]["properties"]
    assert made == {"a": {"type": "keyword"}, "b": {"properties": {"n": {"type": "integer"}}}, "d": {"type": "date"}}


def test_broken_links(spark):
    edges = spark.createDataFrame([(1, "a", None, 0), (1, "b", "a", 0), (1, "c", "z", 0)], "doc_id long, node string, parent string, ord int")
    assert [r.node for r in trees.broken_links(edges).collect()] == ["c"]


def test_new_files_are_processed_once(spark, tmp_path):
    source, target, at = (str(tmp_path / x) for x in ("in", "out", "at"))
    schema = "k long, v string"
    spark.createDataFrame([(1, "a"), (2, "b")], schema).write.mode("append").parquet(source)

    def run(force=False):
        incremental.process_new(spark, source, schema, lambda d: d.selectExpr("k", "upper(v) AS v"), target, at, "k", force).awaitTermination()
        return sorted((r.k, r.v) for r in spark.read.parquet(target).collect())

    assert run() == [(1, "A"), (2, "B")]
    assert run() == [(1, "A"), (2, "B")]
    spark.createDataFrame([(2, "c"), (3, "d")], schema).write.mode("append").parquet(source)
    assert run() == [(1, "A"), (2, "B"), (3, "D")]


def test_failures_and_repeated_batches(spark, tmp_path):
    import shutil

    source, target, at = (str(tmp_path / x) for x in ("in", "out", "at"))
    schema, seen = "k long, v string", []
    spark.createDataFrame([(1, "a"), (2, None)], schema).write.mode("append").parquet(source)

    def work(rows):
        seen.append(sorted(r.k for r in rows.collect()))
        return rows.selectExpr("k", "upper(v) AS v", "CASE WHEN v IS NULL THEN 'no text' END AS problem")

    def run():
        incremental.process_new(spark, source, schema, work, target, at, "k").awaitTermination()
        return sorted((r.k, r.v) for r in spark.read.parquet(target).collect())

    assert run() == [(1, "A")]
    assert tuple(incremental.summary(spark, target, "k").first()) == (1, 1)
    # The batch's end was not noted: it is done again, in place.
    shutil.rmtree(tmp_path / "at" / "commits")
    assert run() == [(1, "A")]
    spark.createDataFrame([(1, "x"), (2, "b")], schema).write.mode("append").parquet(source)
    assert run() == [(1, "A"), (2, "B")]
    assert seen == [[1, 2], [1, 2], [2]]
    assert tuple(incremental.summary(spark, target, "k").first()) == (2, 0)


def test_windows_of_a_stream(spark, tmp_path):
    source = str(tmp_path / "events")
    spark.sql("SELECT timestamp'2024-01-01 00:00:10' AS ts, 'a' AS kind UNION ALL SELECT timestamp'2024-01-01 00:06:00', 'a'").write.parquet(source)
    stream = spark.readStream.schema("ts timestamp, kind string").parquet(source)
    counted = incremental.windowed_counts(stream, "ts", "kind", "5 minutes", "1 minute")
    query = counted.writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("counted").count() == 2


def test_records_are_checked(spark):
    from vellum.sources import records

    good = {
        "subject": {"name": "S", "type": "material"}, "more": 1,
        "attributes": [{"conf": 0.5, "predicates": [
            {"key": {"name": "mass"}, "value": {"numerical": {"val": 2.5}}}, {"key": {"name": "kind"}, "value": {"nominal": "x"}}]}],
    }
    rows = [(1, json.dumps(good)), (2, "{"), (3, json.dumps({"attributes": []})), (4, json.dumps({"subject": {"name": "S"}, "attributes": "no"})), (5, None)]
    read = records.validated(spark.createDataFrame(rows, "k long, j string"), "j")
    got = {r.k: r.problem for r in read.collect()}
    assert got == {1: None, 2: "not as the schema says", 3: "subject lacks", 4: "not as the schema says", 5: "not as the schema says"}
    said = records.statements(read.filter("problem IS NULL"), "k").collect()
    assert sorted((r.subject, r["name"], r.kind, r.value) for r in said) == [("S", "kind", "nominal", "x"), ("S", "mass", "numerical", "2.5")]


def test_titles_keep_references_that_are_cut_off(spark):
    pages = ["<title>a &lt; b\n &amp;&amp</title><title>c</title>", "<title></title>", "<p>none</p>", "<title>open"]
    rows = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
    assert {tuple(r) for r in html.titles(rows, "page_id", "html").collect()} == {(0, "a < b &&amp"), (1, ""), (3, "")}
