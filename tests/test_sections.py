import json

from pyspark.sql import functions as F

from vellum.operators import sections, structure

UNITS = "doc_id long, unit_id string, level string, pos long, text string"
ITEMS = "doc_id long, pos long, label string, layer string, text string, hyperlink string"


def nested(spark, units):
    rows = sections.nested(spark.createDataFrame(units, UNITS)).select("doc_id", "pos", F.to_json("section").alias("s")).collect()
    return {(r.doc_id, r.pos): json.loads(r.s) for r in rows}


def unit(level, marker, text, **held):
    return {"type": level, "marker": marker, "content": {"text": text, **held}}


def odsek(marker, text, letters=(), items=()):
    return unit("odsek", marker, text, subsubsections=list(letters), subitems=list(items))


def subitem(marker, text):
    return {"type": "subitem", "marker": marker, "text": text}


def test_units_nest_by_position(spark):
    units = [
        (1, "part-1", "part", 0, "časť"), (1, "paragraf-1", "paragraph", 1, "úvod"), (1, "odsek-1.1", "odsek", 2, "x"),
        (1, "subitem-1.1.1", "subitem", 3, "voľný"), (1, "pismeno-1.1.b", "pismeno", 4, "b"), (1, "subitem-1.1.b.2", "subitem", 5, "dva"),
        (1, "subitem-1.1.b.10", "subitem", 6, "desať"), (1, "pismeno-1.1.a", "pismeno", 7, "a"), (1, "odsek-1.2", "odsek", 8, ""),
        (1, "subitem-1.2.1", "subitem", 9, "druhý"), (1, "paragraf-2a", "paragraph", 10, "prázdny"), (1, "paragraf-1", "paragraph", 11, "znova"),
        (1, "odsek-1.1", "odsek", 12, "y"), (1, "annex-1", "annex", 13, "p"), (2, "odsek-.1", "odsek", 0, "bez paragrafu"),
    ]
    b = unit("pismeno", "b", "b", subitems=[subitem("2", "dva"), subitem("10", "desať")])
    first = odsek("1", "x", [b, unit("pismeno", "a", "a", subitems=[])], [subitem("1", "voľný")])
    assert nested(spark, units) == {
        (1, 1): unit("paragraph", "1", "úvod", subsections=[first, odsek("2", "", items=[subitem("1", "druhý")])]),
        (1, 10): unit("paragraph", "2a", "prázdny", subsections=[]),
        (1, 11): unit("paragraph", "1", "znova", subsections=[odsek("1", "y")]),
    }
    assert nested(spark, []) == {}


def test_a_whole_statute_nests_as_it_reads(spark):
    texts = ["§ 1", "Predmet", "(1)", "Daň je", "a)", "príjem:", "1.", "zo mzdy", "2.", "z dividend", "b)", "iné", "(2)", "Platí", "§ 2", "Koniec"]
    items = spark.createDataFrame([(1, k, "text", "body", t, None) for k, t in enumerate(texts)], ITEMS)
    made = sections.nested(structure.units(items)).orderBy("pos").collect()
    letters = [unit("pismeno", "a", "príjem:", subitems=[subitem("1", "zo mzdy"), subitem("2", "z dividend")]), unit("pismeno", "b", "iné", subitems=[])]
    first = unit("paragraph", "1", "Predmet", subsections=[odsek("1", "Daň je", letters), odsek("2", "Platí")])
    assert [r.section.asDict(True) for r in made] == [first, unit("paragraph", "2", "Koniec", subsections=[])]


def test_units_are_shuffled_by_document_only(spark):
    plan = sections.nested(spark.createDataFrame([], UNITS))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(doc_id") == plan.count("Exchange ") == 1
