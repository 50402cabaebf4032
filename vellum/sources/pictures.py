"""What documents say of their pictures: charts as points, predictions and their origin, texts of annotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MADE = "confidence: double, created_by: string"
#: Predictions about a picture.
META = (
    f"summary struct<{_MADE}, text: string>, description struct<{_MADE}, text: string>, "
    f"classification struct<predictions: array<struct<{_MADE}, class_name: string>>>, molecule struct<{_MADE}, smi: string>, "
    f"tabular_chart struct<{_MADE}, title: string>"
)
#: A chart of any kind; only the fields of its kind have values.
CHART = (
    "kind string, title string, x_axis_label string, y_axis_label string, "
    "lines array<struct<label: string, values: array<array<double>>>>, bars array<struct<label: string, values: double>>, "
    "stacked_bars array<struct<label: array<string>, values: array<array<double>>>>, slices array<struct<label: string, value: double>>, "
    "points array<struct<value: array<double>>>, "
    "chart_data struct<table_cells: array<struct<text: string, start_row_offset_idx: int, start_col_offset_idx: int>>>"
)


def chart_points(charts: DataFrame) -> DataFrame:
    """Charts (chart_id, chart) as rows: chart_id, kind, series, ord, label, x, y; tables as their cells' texts and places."""
    c = lambda name: F.col(f"chart.{name}")
    no, text = F.lit(None).cast("double"), F.lit(None).cast("string")
    row = lambda series, ord_, label, x, y: F.struct(
        series.cast("string").alias("series"), ord_.cast("int").alias("ord"), label.cast("string").alias("label"),
        x.cast("double").alias("x"), y.cast("double").alias("y"),
    )
    at = lambda pair, k: F.get(pair, F.lit(k))
    lines = F.flatten(F.transform(c("lines"), lambda s: F.transform(s["values"], lambda p, i: row(s["label"], i, text, at(p, 0), at(p, 1)))))
    stacked = F.flatten(
        F.transform(
            c("stacked_bars"),
            lambda s, b: F.transform(s["values"], lambda p, i: row(b, i, F.get(s["label"], i), at(p, 0), at(p, 1))),
        )
    )
    parts = [
        lines,
        F.transform(c("bars"), lambda s, i: row(text, i, s["label"], no, s["values"])),
        stacked,
        F.transform(c("slices"), lambda s, i: row(text, i, s["label"], no, s["value"])),
        F.transform(c("points"), lambda s, i: row(text, i, text, at(s["value"], 0), at(s["value"], 1))),
        F.transform(c("chart_data.table_cells"), lambda s, i: row(text, i, s["text"], s["start_col_offset_idx"], s["start_row_offset_idx"])),
    ]
    none = F.array().cast("array<struct<series:string,ord:int,label:string,x:double,y:double>>")
    every = F.concat(*[F.coalesce(p, none) for p in parts])
    return charts.select("chart_id", c("kind").alias("kind"), F.inline(every))


def main_prediction(predictions: Column) -> Column:
    """The class of the greatest confidence, the first of equals; without any confidence the first."""
    best = F.array_max(F.transform(predictions, lambda p: p["confidence"]))
    sure = F.filter(predictions, lambda p: p["confidence"] == best)
    return F.coalesce(F.get(sure, F.lit(0)), F.get(predictions, F.lit(0)))["class_name"]


def annotation_text(kind: Column, classes: Column, text: Column, smi: Column) -> Column:
    """What an annotation says: its first class in words, its description, or its molecule; null for other kinds."""
    first = F.replace(F.get(classes, F.lit(0)), F.lit("_"), F.lit(" "))
    return F.when(kind == "classification", first).when(kind == "description", text).when(kind == "molecule_data", smi)


def meta_texts(rows: DataFrame, key: str, meta: str) -> DataFrame:
    """key, name, text of all that is predicted about a node, in the names' order."""
    m = lambda path: F.col(f"{meta}.{path}")
    said = {
        "summary": m("summary.text"), "description": m("description.text"),
        "classification": F.replace(main_prediction(m("classification.predictions")), F.lit("_"), F.lit(" ")),
        "molecule": m("molecule.smi"), "tabular_chart": m("tabular_chart.title"),
    }
    each = F.array(*[F.struct(F.lit(k).alias("name"), v.alias("text")) for k, v in said.items()])
    return rows.select(key, F.inline(each)).filter("text IS NOT NULL")


def image_reference(mode: str, uri: Column, folder: Column, page: Column, place: Column) -> Column:
    """Where a picture's image is named: nowhere ("placeholder"), in the document ("embedded"), or by a file ("referenced").

    Referenced images are named by their place among the document's pictures and their page.
    """
    if mode == "placeholder":
        return F.lit(None).cast("string")
    if mode == "embedded":
        return F.when(uri.startswith("data:"), uri)
    if mode != "referenced":
        raise ValueError(f"no such image mode: {mode}")
    name = F.concat(F.lit("image_"), F.lpad(place.cast("string"), 6, "0"), F.lit("_p"), page.cast("string"), F.lit(".png"))
    return F.when(uri.startswith("data:") | uri.isNull(), F.concat_ws("/", folder, name)).otherwise(uri)
