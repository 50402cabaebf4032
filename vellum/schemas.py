"""Schemas of the canonical tables, and of documents as JSON."""

from __future__ import annotations

BBOX = "l double, t double, r double, b double, origin string"
PROV = (
    "page_no: int, bbox: struct<l: double, t: double, r: double, b: double, coord_origin: string>, charspan: array<int>"
)
#: One row an element of a document, in reading order.
ITEMS = "doc_id long, pos long, label string, layer string, text string, hyperlink string"
#: One row a cell of a table; ends are exclusive.
CELLS = (
    "table_id long, r0 int, r1 int, c0 int, c1 int, text string, column_header boolean, row_header boolean, row_section boolean"
)

_REF = "struct<`$ref`: string>"
_PROV = f"array<struct<{PROV}>>"
_NODE = f"self_ref: string, parent: {_REF}, children: array<{_REF}>, content_layer: string, label: string"
_CELL = (
    "struct<text: string, row_span: int, col_span: int, start_row_offset_idx: int, end_row_offset_idx: int, "
    "start_col_offset_idx: int, end_col_offset_idx: int, column_header: boolean, row_header: boolean, row_section: boolean>"
)
_TEXT = (
    f"struct<{_NODE}, prov: {_PROV}, orig: string, text: string, level: int, enumerated: boolean, marker: string, "
    "hyperlink: string, code_language: string>"
)
_TABLE = (
    f"struct<{_NODE}, prov: {_PROV}, captions: array<{_REF}>, "
    f"data: struct<num_rows: int, num_cols: int, table_cells: array<{_CELL}>>>"
)
#: A document as it is stored: flat arrays of nodes that point at each other.
DOCUMENT = (
    "schema_name string, version string, name string, "
    f"body struct<{_NODE}>, furniture struct<{_NODE}>, groups array<struct<{_NODE}, name: string>>, "
    f"texts array<{_TEXT}>, tables array<{_TABLE}>, "
    f"pictures array<struct<{_NODE}, prov: {_PROV}, captions: array<{_REF}>>>, "
    "pages map<string, struct<page_no: int, size: struct<width: double, height: double>>>"
)
MANIFEST = (
    "law_id string, source string, main_document struct<type: string, filename: string, cache: string>, "
    "annexes array<struct<number: string, title: string, type: string, url: string, filename: string, local_path: string, "
    "cache: string, content_type: string, html_id: string, parser: string, "
    "parser_options: map<string, string>>>"
)
