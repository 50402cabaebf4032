"""Location-tagged markup of pages, as items and table cells."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Root tags, and the grid that locations are on.
ROOTS = ("title", "text", "list_item", "code", "formula", "caption", "footnote", "page_header", "page_footer", "picture", "otsl",
         "section_header_level_1", "section_header_level_2", "section_header_level_3", "section_header_level_4",
         "section_header_level_5", "section_header_level_6")
GRID = 500
_ROOT = rf"(?s)<({'|'.join(ROOTS)})>(.*?)</\1>"


def pages_of(texts: DataFrame, key: str, text: str) -> DataFrame:
    """One row a page: documents are cut at page breaks."""
    return texts.select(key, F.posexplode(F.split(text, r"<page_break>\n?")).alias("page", "markup")).withColumn(
        "page_no", F.col("page") + 1
    ).drop("page")


def items(pages: DataFrame, key: str, width: float = 1.0, height: float = 1.0) -> DataFrame:
    """key, page_no, ord, label, level, layer, text, box of each closed root tag, in order."""
    whole = F.regexp_extract_all("markup", F.lit(_ROOT), F.lit(0))
    tag = F.regexp_extract("x", _ROOT, 1)
    body = F.regexp_extract("x", _ROOT, 2)
    rows = pages.select(key, "page_no", F.posexplode(whole).alias("ord", "x")).withColumn("tag", tag).withColumn("body", body)
    places = F.transform(F.regexp_extract_all("body", F.lit(r"<loc_(\d+)>"), F.lit(1)), lambda n: n.cast("double") / GRID)
    at = lambda k, scale: F.get("places", F.lit(k)) * scale
    level = F.nullif(F.regexp_extract("tag", r"level_(\d)$", 1), F.lit("")).cast("int")
    return rows.withColumn("places", places).select(
        key, "page_no", "ord",
        F.when(F.col("tag").startswith("section_header"), "section_header").when(F.col("tag") == "otsl", "table").otherwise(F.col("tag")).alias("label"),
        level.alias("level"),
        F.when(F.col("tag").isin("page_header", "page_footer"), "furniture").otherwise("body").alias("layer"),
        F.trim(F.regexp_replace("body", r"<loc_\d+>", "")).alias("text"),
        F.when(
            F.size("places") >= 4,
            F.struct(at(0, width).alias("l"), at(1, height).alias("t"), at(2, width).alias("r"), at(3, height).alias("b"), F.lit("TOPLEFT").alias("origin")),
        ).alias("box"),
    )


def table_cells(tables: DataFrame, key: str, text: str) -> DataFrame:
    """Cells with spans from table tokens: a span reaches as far as lcel goes right and ucel down.

    A table's tokens lie in one row, so its cells are found within that row: nothing is shuffled or sorted.
    """
    token = r"<(fcel|ecel|ched|rhed|srow|lcel|ucel|xcel)>([^<]*)"
    lines = F.split(F.regexp_replace(text, r"<nl>\s*$", ""), "<nl>")
    parsed = F.transform(lines, lambda line: F.regexp_extract_all(line, F.lit(token), F.lit(0)))
    # A letter a place tells its kind; what a row lacks doesn't stop a span that goes down.
    letters = F.transform(parsed, lambda xs: F.array_join(F.transform(xs, lambda x: F.substring(x, 2, 1)), ""))
    # Most tables are even and have no spans that go down.
    wide, tall = F.col(text).contains("<lcel>"), F.col(text).contains("<ucel>")
    held = tables.select(F.col(key).alias("table_id"), parsed.alias("parsed"), letters.alias("letters"), wide.alias("wide"), tall.alias("tall"))
    sizes = F.transform("letters", F.length)
    tall = F.col("tall") | (F.array_min(sizes) < F.array_max(sizes))
    down = F.transform(
        F.sequence(F.lit(1), F.greatest(F.array_max(F.transform("letters", F.length)), F.lit(1))),
        lambda c: F.array_join(F.transform("letters", lambda line: F.coalesce(F.nullif(F.substr(line, c, F.lit(1)), F.lit("")), F.lit("-"))), ""),
    )
    # Rows behind the last place are none.
    rows = F.array_max(F.transform("letters", lambda line, r: F.when(line != "", r + 1)))
    held = held.select("table_id", "letters", "wide", F.when(tall, down).alias("down"), rows.alias("rows"), F.posexplode("parsed").alias("r", "xs"))
    line = F.element_at("letters", F.col("r") + 1)
    places = held.select("table_id", "down", "rows", "r", F.when(F.col("wide"), line).alias("line"), F.posexplode("xs").alias("c", "x"))
    places = places.withColumn("kind", F.substring("x", 2, 4)).filter("kind NOT IN ('lcel', 'ucel', 'xcel')")
    # How many places of the kind follow without a break, to the right or down.
    right = F.regexp_extract(F.substr("line", F.col("c") + 2), "^l*", 0)
    below = F.regexp_extract(F.substr(F.element_at("down", F.col("c") + 1), F.col("r") + 2), "^[u-]*", 0)
    follows = lambda at, text, letters: F.substr(at, text, F.lit(1)).isin(*letters)
    c1 = F.col("c") + 1 + F.when(follows("line", F.col("c") + 2, "l"), F.length(right)).otherwise(0)
    r1 = F.col("r") + 1 + F.when(follows(F.element_at("down", F.col("c") + 1), F.col("r") + 2, "u-"), F.length(below)).otherwise(0)
    return places.select(
        "table_id", F.col("r").alias("r0"), F.least(r1, "rows").alias("r1"), F.col("c").alias("c0"), c1.alias("c1"),
        F.trim(F.substr("x", F.lit(7))).alias("text"),
        (F.col("kind") == "ched").alias("column_header"), (F.col("kind") == "rhed").alias("row_header"), (F.col("kind") == "srow").alias("row_section"),
    )


def key_values(texts: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Cells and links of key-value regions; links to ids that aren't there are left out."""
    kinds = {"key": r"(?s)<key_(\d+)>(.*?)</key_\1>", "value": r"(?s)<value_(\d+)>(.*?)</value_\1>"}
    parts = []
    for kind, pattern in kinds.items():
        rows = texts.select(key, F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("x"))
        parts.append(rows.select(key, F.lit(kind).alias("kind"), F.regexp_extract("x", pattern, 1).cast("int").alias("cell_id"), F.regexp_extract("x", pattern, 2).alias("body")))
    every = parts[0].unionByName(parts[1])
    cells = every.select(key, "kind", "cell_id", F.trim(F.regexp_replace("body", r"<(loc|link)_\d+>", "")).alias("text"))
    links = every.select(key, F.col("cell_id").alias("source"), F.explode(F.regexp_extract_all("body", F.lit(r"<link_(\d+)>"), F.lit(1))).alias("t"))
    links = links.select(key, "source", F.col("t").cast("int").alias("target"))
    return cells, links.join(cells.select(key, F.col("cell_id").alias("target")), [key, "target"], "left_semi")


#: Tags that hold other elements, tags of running text, and labels of charts with what they stand for.
LISTS = ("ordered_list", "unordered_list")
HOLDERS = (*LISTS, "list_item", "inline", "picture", "chart", "otsl", "document_index", "key_value_region")
TEXTS = ("title", "text", "code", "formula", "caption", "footnote", "page_header", "page_footer", "checkbox_selected", "checkbox_unselected")
CHARTS = {
    "pie_chart": "pie_chart", "bar_chart": "bar_chart", "stacked_bar_chart": "stacked_bar_chart", "line_chart": "line_chart",
    "flow_chart": "flow_chart", "scatter_chart": "scatter_chart", "heatmap": "heatmap", "line": "line_chart", "dot_line": "line_chart",
    "vbar_categorical": "bar_chart", "hbar_categorical": "bar_chart",
}
CELLS = ("fcel", "ecel", "ched", "rhed", "srow", "lcel", "ucel", "xcel", "nl")
_TAG = re.compile(r"<(/?)([^<>/]*)>")
_HEADING = re.compile(r"section_header_level_([1-6])$")
_GRAPH = re.compile(r"(key|value)_(\d+)$")

NODE = (
    "node int, parent int, ord int, tag string, label string, level int, layer string, text string, places array<int>, marker string, "
    "enumerated boolean, chart string, cell_id int, links array<int>, caption_of int, closed boolean"
)


def parsed(markup: str) -> list[dict]:
    """The elements of a page's markup, parents before children.

    A stack of open elements, which repairs what doesn't match: a closing tag closes all that was opened
    after its element, one that nothing waits for is passed over, an item that begins within an item ends
    that one. What is still open at the end of the page is there, but empty, as nothing says where it ends. In
    running text other tags are formatting: their text stays.
    """
    nodes: list[dict] = []
    stack: list[dict] = []

    def fits(tag: str) -> bool:
        top = stack[-1]["tag"] if stack else None
        if _GRAPH.match(tag):
            return top == "key_value_region"
        if tag == "list_item":
            return top in LISTS
        if not (tag in HOLDERS or tag in TEXTS or _HEADING.match(tag)):
            return False
        if top in LISTS or top == "key_value_region":
            return False
        if top == "list_item":
            return tag in LISTS or tag == "inline"
        if top in ("picture", "chart", "otsl", "document_index"):
            return tag == "caption"
        return top is None or (top == "inline" and tag not in LISTS)

    def opened(tag: str) -> None:
        up = stack[-1] if stack else None
        graph = _GRAPH.match(tag)
        node = {"node": len(nodes), "parent": up and up["node"], "tag": graph[1] if graph else tag, "name": tag, "pieces": [], "places": [],
                "chart": [], "language": None, "links": [], "cell_id": int(graph[2]) if graph else None, "kids": 0, "closed": False}
        node["ord"] = sum(n["parent"] == node["parent"] for n in nodes) if up is None else up["kids"]
        if up is not None:
            up["kids"] += 1
        nodes.append(node)
        stack.append(node)

    def said(text: str) -> None:
        if stack and text:
            stack[-1]["pieces"].append(text)

    at = 0
    for tag in _TAG.finditer(markup):
        said(markup[at : tag.start()])
        at, name, top = tag.end(), tag[2], stack[-1]["tag"] if stack else None
        if tag[1]:
            if any(n["name"] == name for n in stack):
                while (done := stack.pop())["name"] != name:
                    done["closed"] = True
                done["closed"] = True
        elif name.startswith("loc_") and name[4:].isdigit():
            for n in stack:
                n["places"] += [int(name[4:])] * (len(n["places"]) < 4)
        elif name.startswith("link_") and name[5:].isdigit():
            if stack and stack[-1]["cell_id"] is not None:
                stack[-1]["links"].append(int(name[5:]))
        elif name in CELLS:
            said(tag[0] if top in ("otsl", "chart", "document_index") else "")
        elif name in CHARTS and top == "chart":
            stack[-1]["chart"].append(name)
        elif len(name) > 2 and name[0] == name[-1] == "_" and top == "code":
            stack[-1]["language"] = name[1:-1]
        else:
            if name == "list_item" and top == "list_item":
                stack.pop()["closed"] = True
            if fits(name):
                opened(name)
    return _finished(nodes, {n["node"] for n in stack})


def _finished(nodes: list[dict], still_open: set[int]) -> list[dict]:
    by_node, out, dropped = {n["node"]: n for n in nodes}, [], set()
    cells, placed = {n["cell_id"] for n in nodes}, {n["node"] for n in nodes if len(n["places"]) == 4}
    gone = {n["node"] for n in nodes if n["tag"] in ("picture", "chart")} - placed
    for n in nodes:
        up = by_node.get(n["parent"])
        if n["parent"] in dropped or n["parent"] in still_open:
            dropped.add(n["node"])
        if n["node"] in dropped | gone:
            continue
        heading, tag = _HEADING.match(n["tag"]), n["tag"]
        ordered = up is not None and up["tag"] == "ordered_list"
        text = "" if n["node"] in still_open or tag in (*LISTS, "inline") else "".join(n["pieces"]).strip()
        # The order of CHARTS decides, not the page's.
        chart = next((CHARTS[c] for c in CHARTS if c in n["chart"]), None)
        # A caption hangs on a picture only where it has a place of its own.
        hangs = tag == "caption" and up is not None and up["tag"] != "inline" and n["parent"] not in gone
        hangs = hangs and (n["node"] in placed or up["tag"] not in ("picture", "chart"))
        out.append({
            "node": n["node"], "parent": None if n["parent"] in gone else n["parent"], "ord": n["ord"], "tag": tag, "level": int(heading[1]) if heading else None,
            "label": "section_header" if heading else {"otsl": "table", "chart": "picture"}.get(tag, tag),
            "layer": "furniture" if tag in ("page_header", "page_footer") else "body", "text": text,
            "places": up["places"] if up is not None and up["tag"] == "inline" else n["places"],
            "marker": f"{n['ord'] + 1}." if tag == "list_item" and ordered else n["language"], "enumerated": tag == "list_item" and ordered,
            "chart": chart, "cell_id": n["cell_id"], "links": [x for x in n["links"] if x in cells], "closed": n["closed"],
            "caption_of": n["parent"] if hangs else None,
        })
    return out


def tree(pages: DataFrame, key: str, width: float = 1.0, height: float = 1.0) -> DataFrame:
    """key, page_no and the elements of each page as a tree: lists in lists, inline groups, tables, charts, captions, key-value cells.

    See NODE for the columns, but for ``places``, which become ``box`` where there are four. ``text`` of tables and charts is their
    table tokens, for table_cells(). A picture without a place is left out; its caption stays by itself. Null markup has no
    elements. Links to cells that aren't there are left out. Pages are read in Arrow batches; a parse holds its page only.
    """
    kinds = StructType.fromDDL(NODE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [parsed(text or "") for text in batch.column(2).to_pylist()]
            of = np.repeat(np.arange(len(found)), [len(f) for f in found])
            rows = [n for f in found for n in f]
            columns = [pa.array([n[name] for n in rows], arrow) for name, arrow in zip(names, arrows, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(pa.array(of)) for k in (0, 1)), *columns], [key, "page_no", *names])

    names = kinds.names
    numbers, flags, lists = ("node", "parent", "ord", "level", "cell_id", "caption_of"), ("enumerated", "closed"), ("places", "links")
    arrows = [pa.int32() if n in numbers else pa.bool_() if n in flags else pa.list_(pa.int32()) if n in lists else pa.string() for n in names]
    schema = pages.select(key, "page_no").schema
    for field in kinds:
        schema = schema.add(field)
    rows = pages.select(key, "page_no", "markup").mapInArrow(run, schema)
    at = lambda k, scale: F.get("places", F.lit(k)) / GRID * scale
    box = F.struct(at(0, width).alias("l"), at(1, height).alias("t"), at(2, width).alias("r"), at(3, height).alias("b"), F.lit("TOPLEFT").alias("origin"))
    return rows.withColumn("box", F.when(F.size("places") == 4, box)).drop("places")
