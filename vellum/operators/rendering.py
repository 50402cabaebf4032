"""Whole documents from items: Markdown, HTML, markup, trees, the older export, JSON of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vellum.functions import render

#: How documents in a format begin, what parts elements, and how they end.
FRAMES = {"markdown": ("", "\n\n", ""), "html": ("<!DOCTYPE html>\n<html>\n<body>\n", "\n", "\n</body>\n</html>"),
          "tags": ("<doctag>", "\n", "</doctag>"), "latex": ("\\documentclass{article}\n\\begin{document}\n", "\n\n", "\n\\end{document}")}
_RENDERERS = {"markdown": render.markdown, "html": render.html, "tags": render.tagged, "latex": render.latex}


def documents(
    items: DataFrame, form: str, *, labels: list[str] | None = None, start: int | None = None, stop: int | None = None,
    page_break: str | None = None, layers: tuple[str, ...] = ("body",),
) -> DataFrame:
    """doc_id and the rendered text of its items in order.

    items: doc_id, pos, label, layer, text, level and, for ``page_break``, page_no: it then
    stands before each element that begins a later page. Only ``labels``, ``layers`` and
    positions from ``start`` to before ``stop`` are rendered.
    """
    head, between, foot = FRAMES[form]
    kept = items.filter(F.col("layer").isin(*layers))
    if labels is not None:
        kept = kept.filter(F.col("label").isin(*labels))
    if start is not None:
        kept = kept.filter(F.col("pos") >= start)
    if stop is not None:
        kept = kept.filter(F.col("pos") < stop)
    part = _RENDERERS[form](F.col("label"), F.col("text"), F.col("level"))
    if page_break is not None:
        turned = F.col("page_no") > F.lag("page_no").over(W.partitionBy("doc_id").orderBy("pos"))
        part = F.when(F.coalesce(turned, F.lit(False)), F.concat(F.lit(page_break + between), part)).otherwise(part)
    rows = kept.withColumn("part", part)
    parts = F.transform(F.sort_array(F.collect_list(F.struct("pos", "part"))), lambda x: x["part"])
    return rows.groupBy("doc_id").agg(F.concat(F.lit(head), F.array_join(parts, between), F.lit(foot)).alias("rendered"))


def element_tree(nodes: DataFrame, longest: int = 30) -> DataFrame:
    """One line a node, indented by depth; longer texts are cut in the middle. nodes: doc_id, path, depth, node."""
    half = (longest - 3) // 2
    cut = F.concat(F.left("node", F.lit(half)), F.lit("..."), F.right("node", F.lit(half)))
    line = F.concat(F.repeat(F.lit(" "), F.col("depth")), F.when(F.length("node") > longest, cut).otherwise(F.col("node")))
    lines = F.transform(F.sort_array(F.collect_list(F.struct("path", line.alias("line")))), lambda x: x["line"])
    return nodes.groupBy("doc_id").agg(F.array_join(lines, "\n").alias("tree"))


def legacy_markdown(items: DataFrame) -> DataFrame:
    """The older export: texts that repeat their predecessor dropped, the first title #, later ones ##."""
    order = W.partitionBy("doc_id").orderBy("pos")
    again = F.coalesce(F.lag("text").over(order) == F.col("text"), F.lit(False))
    fresh = items.withColumn("again", again).filter("NOT again")
    titles = F.count(F.when(F.col("label") == "title", 1)).over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    mark = F.when(F.col("label") == "title", F.when(titles == 1, "# ").otherwise("## ")).otherwise("")
    rows = fresh.withColumn("part", F.concat(mark, "text"))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("pos", "part"))), lambda x: x["part"])
    return rows.groupBy("doc_id").agg(F.array_join(parts, "\n\n").alias("rendered"))


def page_json(items: DataFrame) -> DataFrame:
    """JSON of each page's paragraphs with roles and polygons; elements without a box are left out."""
    role = (
        F.when(F.col("label") == "title", "title").when(F.col("label") == "section_header", "sectionHeading")
        .when(F.col("label") == "footnote", "footnote").when(F.col("label") == "page_header", "pageHeader")
        .when(F.col("label") == "page_footer", "pageFooter")
    )
    corner: list[Column] = [F.col(f"box.{k}") for k in ("l", "t", "r", "t", "r", "b", "l", "b")]
    paragraph = F.struct(F.col("text").alias("content"), role.alias("role"), F.array(*corner).alias("polygon"))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("pos", paragraph.alias("p")))), lambda x: x["p"])
    rows = items.filter("box IS NOT NULL").groupBy("doc_id", "page_no").agg(listed.alias("paragraphs"))
    return rows.select("doc_id", "page_no", F.to_json(F.struct("paragraphs")).alias("json"))


def misplaced_list_items(items: DataFrame) -> DataFrame:
    """Runs of neighbouring list items that no list holds: doc_id, first, last, n. items: pos, label, parent_label."""
    order = W.partitionBy("doc_id").orderBy("pos")
    loose = (F.col("label") == "list_item") & ~F.coalesce(F.col("parent_label") == "list", F.lit(False))
    rows = items.withColumn("loose", loose.cast("int"))
    rows = rows.withColumn("run", F.sum(F.when(F.coalesce(F.lag("loose").over(order), F.lit(0)) != F.col("loose"), 1).otherwise(0)).over(order))
    return rows.filter("loose = 1").groupBy("doc_id", "run").agg(F.min("pos").alias("first"), F.max("pos").alias("last"), F.count("*").alias("n")).drop("run")


def header_names(grid: DataFrame) -> DataFrame:
    """Names of columns: the leading header rows' texts, joined by dots. grid: table_id, r, c, text, is_header.

    A row is a header if one of its cells is. Cells are shuffled and sorted once, by table and row, without a join.
    """
    order = W.partitionBy("table_id").orderBy("r").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = grid.withColumn("head", F.max(F.col("is_header").cast("int")).over(W.partitionBy("table_id", "r")))
    leading = rows.withColumn("all", F.min("head").over(order)).filter("all = 1")
    texts = F.transform(F.sort_array(F.collect_list(F.struct("r", "text"))), lambda x: x["text"])
    return leading.groupBy("table_id", "c").agg(F.array_join(texts, ".").alias("name"))
