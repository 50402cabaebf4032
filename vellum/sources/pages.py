"""Segmented pages and parsed files as JSON: cells, lines and bitmaps of each page, and tables of contents."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_RECT = "struct<" + ", ".join(f"r_{a}{k}: double" for k in range(4) for a in "xy") + ", coord_origin: string>"
_COLOR = "struct<r: int, g: int, b: int, a: int>"
_BOX = "struct<l: double, t: double, r: double, b: double, coord_origin: string>"
_CELL = (
    f"struct<index: int, rgba: {_COLOR}, rect: {_RECT}, text: string, orig: string, text_direction: string, confidence: double, "
    "from_ocr: boolean, rendering_mode: int, widget: boolean, font_key: string, font_name: string>"
)
_BOXES = ", ".join(f"{k}_bbox: {_BOX}" for k in ("art", "bleed", "crop", "media", "trim"))
_LINE = f"struct<index: int, rgba: {_COLOR}, parent_id: int, points: array<array<double>>, width: double, coord_origin: string>"
#: One page: its geometry, cells by unit, lines and bitmaps.
PAGE = (
    f"dimension struct<angle: double, rect: {_RECT}, boundary_type: string, {_BOXES}>, "
    f"bitmap_resources array<struct<index: int, rect: {_RECT}, uri: string>>, char_cells array<{_CELL}>, word_cells array<{_CELL}>, "
    f"textline_cells array<{_CELL}>, has_chars boolean, has_words boolean, has_lines boolean, lines array<{_LINE}>"
)
#: The unit of text, and where its cells are.
UNITS = {"char": "char_cells", "word": "word_cells", "line": "textline_cells"}


def _struct(schema: str) -> str:
    """A schema of columns as that of a struct."""
    parts, depth, out = schema, 0, []
    start = 0
    for k, c in enumerate(parts + ","):
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            name, kind = parts[start:k].strip().split(" ", 1)
            out.append(f"{name}: {kind}")
            start = k + 1
    return f"struct<{', '.join(out)}>"


def _whole(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("doc_id"), "value")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """doc_id (the file), page: one segmented page a file; null where a file isn't one."""
    page = F.from_json("value", PAGE, {"mode": "PERMISSIVE"})
    return _whole(spark, path).select("doc_id", F.when(page["dimension"].isNotNull(), page).alias("page"))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, page_no, page of parsed files, one row a page; files that don't parse have none."""
    schema = f"pages map<string, {_struct(PAGE)}>"
    parsed = _whole(spark, path).select("doc_id", F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("f"))
    return parsed.select("doc_id", F.explode("f.pages").alias("no", "page")).select("doc_id", F.col("no").cast("int").alias("page_no"), "page")


def in_order(pages: DataFrame) -> DataFrame:
    """Pages by file and number."""
    return pages.orderBy("doc_id", "page_no")


def cells(pages: DataFrame, unit: str = "line") -> DataFrame:
    """A row a cell of the unit, in the page's order: key columns, ord, text, l, t, r, b around its rectangle."""
    keys = [c for c in pages.columns if c != "page"]
    rows = pages.select(*keys, F.posexplode(f"page.{UNITS[unit]}").alias("ord", "c"))
    side = lambda least, axis: (F.least if least else F.greatest)(*[F.col(f"c.rect.r_{axis}{k}") for k in range(4)])
    return rows.select(
        *keys, "ord", "c.text", side(True, "x").alias("l"), side(True, "y").alias("t"), side(False, "x").alias("r"),
        side(False, "y").alias("b"), "c.rect.coord_origin", F.coalesce("c.from_ocr", F.lit(False)).alias("from_ocr"),
    )


def as_json(page: Column) -> Column:
    """A page as JSON; fields without a value are left out."""
    return F.to_json(page)


def contents(files: DataFrame, key: str, column: str) -> DataFrame:
    """Tables of contents, nested to any depth, as rows: key, ord, depth, path, text, marker. ``column`` holds their JSON."""

    def walk(node: dict, path: tuple[int, ...]) -> Iterator[tuple]:
        yield path, node.get("text") or "", node.get("marker") or ""
        for k, child in enumerate(node.get("children") or ()):
            yield from walk(child, (*path, k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, owner = [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                try:
                    node = json.loads(text or "null")
                except ValueError:
                    node = None
                found = list(walk(node, ())) if isinstance(node, dict) else []
                rows += [(ord_, len(p), list(p), t, m) for ord_, (p, t, m) in enumerate(found)]
                owner += [k] * len(found)
            kinds = [pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.string(), pa.string()]
            arrays = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner, pa.int64())), *arrays], [key, "ord", "depth", "path", "text", "marker"]
            )

    kind = files.schema[key].dataType.simpleString()
    return files.select(key, column).mapInArrow(run, f"{key} {kind}, ord long, depth int, path array<int>, text string, marker string")
