"""Tables that a converter missed, rebuilt from the texts that their cells became."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: What heads a table, what a line of one says, and the columns of a rebuilt one.
HEADER = r"(?iuU)Odpisová\s+skupina\s+([0-9]+)"
LINE = r"(?dU)^([0-9]+-[0-9]+)\s+([0-9]+[.0-9]*)\s+(.+)$"
ITEM = r"^([0-9]+)-([0-9]+)$"
CODE = r"^[0-9]+\.[0-9.]*$"
COLUMNS = ("Položka", "KP", "Názov")
#: Tops of one row of a page lie within so many points.
HEIGHT = 8


def headers(elements: DataFrame) -> DataFrame:
    """doc_id, group, title, first: the groups that texts head; the last text is a group's title, its first one its place."""
    group = F.regexp_extract("text", HEADER, 1)
    found = elements.select("doc_id", "pos", "text", group.alias("group")).filter(F.col("group") != "")
    return found.groupBy("doc_id", "group").agg(F.max_by("text", "pos").alias("title"), F.min("pos").alias("first"))


def lacking(elements: DataFrame, cells: DataFrame) -> DataFrame:
    """headers() of the groups that no table has: none whose rows begin with an item of the group."""
    held = cells.filter("c = 0").select("doc_id", F.regexp_extract(F.trim("text"), r"^([0-9]+)-", 1).alias("group"))
    return headers(elements).join(held.filter(F.col("group") != "").distinct(), ["doc_id", "group"], "left_anti")


def line_items(elements: DataFrame) -> DataFrame:
    """doc_id, item, kp, name, place of the items that one text tells whole; of texts of one item the last one counts."""
    part = lambda k: F.regexp_extract("text", LINE, k)
    told = elements.select("doc_id", "pos", part(1).alias("item"), part(2).alias("kp"), part(3).alias("name")).filter("item <> ''")
    last = F.max_by(F.struct("kp", "name"), "pos").alias("told")
    return told.groupBy("doc_id", "item").agg(last, F.min("pos").alias("place")).select("doc_id", "item", "told.*", "place")


def row_items(elements: DataFrame, height: int = HEIGHT) -> DataFrame:
    """doc_id, item, kp, name, place of the items whose texts lie in a row, the item being the leftmost.

    Rows are those of equal rounded tops. The first text that looks like a code is the code, the
    others are the name. Of rows that begin with one item the topmost counts. Only the texts of
    such rows are gathered; elements without a place take no part.
    """
    row = F.bround(F.col("top") / height).cast("long")
    placed = elements.filter("top IS NOT NULL").select("doc_id", "pos", "text", row.alias("row"), F.coalesce("left", F.lit(0.0)).alias("left"))
    begun = placed.groupBy("doc_id", "row").agg(F.min_by("text", F.struct("left", "pos")).alias("item"))
    begun = begun.filter(F.col("item").rlike(ITEM)).groupBy("doc_id", "item").agg(F.min("row").alias("row"))
    texts = F.transform(F.sort_array(F.collect_list(F.struct("left", "pos", "text"))), lambda x: x["text"])
    rows = placed.join(begun, ["doc_id", "row"]).groupBy("doc_id", "row", "item").agg(texts.alias("texts"))
    rest = F.slice("texts", F.lit(2), F.size("texts"))
    code = F.array_position(F.transform(rest, lambda x: x.rlike(CODE)), F.lit(True))
    rows = rows.withColumn("rest", rest).withColumn("at", code)
    names = F.filter("rest", lambda x, i: i + 1 != F.col("at"))
    return rows.select(
        "doc_id", "item", F.when(F.col("at") > 0, F.get("rest", (F.col("at") - 1).cast("int"))).otherwise("").alias("kp"),
        F.array_join(names, " ").alias("name"), F.col("row").alias("place"),
    )


def _number(digits: Column) -> Column:
    """Orders digits as numbers, however many there are."""
    plain = F.regexp_replace(digits, r"^0+(?=.)", "")
    return F.struct(F.length(plain).alias("digits"), plain.alias("value"))


def rebuilt_tables(elements: DataFrame, cells: DataFrame, height: int = HEIGHT) -> DataFrame:
    """doc_id, place, group, title, rows, markdown: a table for each header that has none.

    elements: doc_id, pos, text (decoded), left, top (null: not on a page); cells: doc_id,
    table_id, r, c, text of the tables that there are. A table's rows are the items of its group,
    told by one text or, where none does, by the texts of a row; they come by number, equal
    numbers as they were found. Headers without any item make no table. Tables are numbered
    behind those that there are, as their headers come. Null texts head and tell nothing; digits
    are those of ASCII.

    Items meet headers by document and group. All steps but the numbering of a document's
    tables combine before they are shuffled.
    """
    wanted = lacking(elements, cells)
    told = line_items(elements).withColumn("source", F.lit(0)).unionByName(row_items(elements, height).withColumn("source", F.lit(1)))
    # Of one item what a text tells whole goes before what lies in a row.
    best = F.min_by(F.struct("kp", "name", "source", "place"), "source").alias("b")
    items = told.groupBy("doc_id", "item").agg(best).select(
        "doc_id", "item", "b.*", F.split_part("item", F.lit("-"), F.lit(1)).alias("group"), _number(F.split_part("item", F.lit("-"), F.lit(2))).alias("number")
    )
    ordered = F.sort_array(F.collect_list(F.struct("number", "source", "place", "item", "kp", "name")))
    rows = F.transform(ordered, lambda x: F.struct(x["item"].alias("item"), x["kp"].alias("kp"), x["name"].alias("name")))
    made = items.groupBy("doc_id", "group").agg(rows.alias("rows")).join(wanted, ["doc_id", "group"])
    held = cells.groupBy("doc_id").agg(F.countDistinct("table_id").alias("held"))
    number = F.row_number().over(W.partitionBy("doc_id").orderBy("first", "group")) - 1
    line = lambda *texts: F.concat(F.lit("| "), F.concat_ws(" | ", *texts), F.lit(" |"))
    head = F.array(line(*map(F.lit, COLUMNS)), line(*[F.lit("---")] * len(COLUMNS)))
    markdown = F.array_join(F.concat(head, F.transform("rows", lambda x: line(x["item"], x["kp"], x["name"]))), "\n")
    return made.withColumn("number", number).join(held, "doc_id", "left").select(
        "doc_id", (F.coalesce("held", F.lit(0)) + F.col("number")).alias("place"), "group", "title", "rows", markdown.alias("markdown")
    )
