"""Location-tagged markup as a tree: nested, malformed, and back again from what is rendered."""

import pytest
from pyspark.sql import functions as F

from vellum.operators import nested
from vellum.sources import markup


def short(text):
    """(tag, text, parent's tag) of each element."""
    rows = markup.parsed(text)
    tags = {n["node"]: n["tag"] for n in rows}
    return [(n["tag"], n["text"], tags.get(n["parent"])) for n in rows]


@pytest.mark.parametrize(
    "text,want",
    [
        ("<text>a</text> loose <title>b</title>", [("text", "a", None), ("title", "b", None)]),
        ("<text>a <b>bold</b> <formula>x</formula> c</text>", [("text", "a bold x c", None)]),
        ("</text><text>a</text></title><code><_C_>b < c</code>", [("text", "a", None), ("code", "b < c", None)]),
        ("<text>a</text><title>cut off", [("text", "a", None), ("title", "", None)]),
        ("<ordered_list><list_item>a</list_item><list_item>b", [("ordered_list", "", None)]),
        (
            "<unordered_list><list_item>a<list_item>b<ordered_list><list_item>c</list_item></ordered_list></list_item></unordered_list><text>d</text>",
            [("unordered_list", "", None), ("list_item", "a", "unordered_list"), ("list_item", "b", "unordered_list"),
             ("ordered_list", "", "list_item"), ("list_item", "c", "ordered_list"), ("text", "d", None)],
        ),
        (
            "<unordered_list><list_item>a<ordered_list><list_item>b</unordered_list><text>c</text>",
            [("unordered_list", "", None), ("list_item", "a", "unordered_list"), ("ordered_list", "", "list_item"), ("list_item", "b", "ordered_list"), ("text", "c", None)],
        ),
        (
            "<inline><loc_1><text>see</text><code>f</code><formula>y</formula></inline>",
            [("inline", "", None), ("text", "see", "inline"), ("code", "f", "inline"), ("formula", "y", "inline")],
        ),
        ("<otsl><fcel>a<fcel>b<nl><caption>of it</caption></otsl>", [("otsl", "<fcel>a<fcel>b<nl>", None), ("caption", "of it", "otsl")]),
        ("<list_item>alone</list_item>", []),
        ("", []),
    ],
)
def test_elements(text, want):
    assert short(text) == want


def pages(spark, *texts):
    return spark.createDataFrame([(1, k, t) for k, t in enumerate(texts, 1)], "doc_id long, page_no int, markup string")


def test_places_charts_captions_and_cells(spark):
    text = (
        "<page_header><loc_0><loc_50><loc_100><loc_500>head</page_header>"
        "<chart><loc_1><loc_2><loc_3><loc_4><line><bar_chart><fcel>x<fcel>1<nl><caption><loc_5><loc_6><loc_7><loc_8>Fig</caption></chart>"
        "<picture><caption>of nothing</caption></picture><picture><loc_1><loc_2><loc_3><loc_4><caption>placeless</caption></picture>"
        "<key_value_region><key_1>k<link_2><link_9></key_1><value_2>v</value_2></key_value_region><section_header_level_2>H</section_header_level_2>"
        "<ordered_list><list_item>p</list_item><list_item>q</list_item></ordered_list><inline><loc_9><loc_9><loc_9><loc_9><text>i</text></inline>"
    )
    rows = {r.text or r.tag: r for r in markup.tree(pages(spark, text, None), "doc_id", 10.0, 100.0).collect()}
    assert rows["head"].layer == "furniture" and tuple(rows["head"].box) == (0.0, 10.0, 2.0, 100.0, "TOPLEFT")
    chart = rows["<fcel>x<fcel>1<nl>"]
    assert (chart.label, chart.chart) == ("picture", "bar_chart") and rows["Fig"].caption_of == chart.node
    assert rows["of nothing"].parent is None and rows["of nothing"].caption_of is None
    assert rows["placeless"].parent is not None and rows["placeless"].caption_of is None
    assert (rows["k"].cell_id, rows["k"].links, rows["v"].tag) == (1, [2], "value")
    assert rows["H"].level == 2 and (rows["q"].marker, rows["q"].enumerated) == ("2.", True)
    assert rows["i"].box == rows["inline"].box and rows["i"].box is not None
    assert len(rows) == 15


def test_what_is_rendered_is_read_back(spark):
    text = (
        "<title>T</title>\n<ordered_list><list_item>a</list_item>\n<list_item><unordered_list><list_item>b</list_item>\n</unordered_list></list_item>\n"
        "</ordered_list>\n<inline><text>see</text>\n<code><_Python_>f</code>\n</inline>\n<section_header_level_3>H</section_header_level_3>"
    )
    # Lists within a list stand in an item of their own, as they are rendered.
    found = markup.tree(pages(spark, text), "doc_id")
    kind = F.when(F.col("tag").isin(*markup.LISTS), "list").when(F.col("tag") == "inline", "inline").otherwise("text")
    items = found.select("doc_id", F.col("node").cast("string").alias("node"), F.col("parent").cast("string").alias("parent"), "ord", kind.alias("kind"), "label", "text", "level", "marker", "enumerated")
    assert nested.document(items, "tags").first().rendered == f"<doctag>{text}\n</doctag>"
