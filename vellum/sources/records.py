"""Knowledge records as JSON: facts with typed values, checked against their schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_VALUE = (
    "struct<numerical: struct<min: double, max: double, val: double, err: double, unit: string>, nominal: string, "
    "text: string, boolean: boolean, datetime: string, geopoint: array<double>>"
)
#: A record: a subject and its attributes, each with predicates of typed values.
RECORD = (
    "file_info struct<filename: string, document_hash: string>, subject struct<name: string, type: string, identifiers: "
    "array<struct<type: string, value: string, _name: string>>>, attributes array<struct<conf: double, predicates: "
    f"array<struct<key: struct<name: string, type: string>, value: {_VALUE}>>>>"
)


def validated(rows: DataFrame, column: str, schema: str = RECORD, required: tuple[str, ...] = ("subject",)) -> DataFrame:
    """``rows`` with the parsed ``record``, and ``problem``: null where the JSON fits the schema.

    A wrong type anywhere is a problem, as is a required field that lacks; unknown fields aren't.
    """
    corrupt = "_problem_text"
    parsed = F.from_json(column, f"{schema}, {corrupt} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    out = rows.withColumn("record", parsed)
    lacking: Column = F.lit(None).cast("string")
    for name in reversed(required):
        lacking = F.when(F.col(f"record.{name}").isNull(), F.lit(f"{name} lacks")).otherwise(lacking)
    problem = F.when(F.col(column).isNull() | F.col("record").isNull() | F.col(f"record.{corrupt}").isNotNull(), "not as the schema says")
    return out.withColumn("problem", F.coalesce(problem, lacking)).withColumn("record", F.col("record").dropFields(corrupt))


def statements(records: DataFrame, key: str) -> DataFrame:
    """One row a predicate: key, subject, name, kind of its value and the value as text."""
    rows = records.select(key, F.col("record.subject.name").alias("subject"), F.explode("record.attributes").alias("a"))
    rows = rows.select(key, "subject", "a.conf", F.explode("a.predicates").alias("p"))
    value = F.col("p.value")
    kinds = {
        "numerical": value["numerical"]["val"].cast("string"), "nominal": value["nominal"], "text": value["text"],
        "boolean": value["boolean"].cast("string"), "datetime": value["datetime"],
        "geopoint": F.array_join(F.transform(value["geopoint"], lambda x: x.cast("string")), ","),
    }
    kind = F.coalesce(*[F.when(v.isNotNull(), F.lit(k)) for k, v in kinds.items()])
    return rows.select(key, "subject", "conf", F.col("p.key.name").alias("name"), kind.alias("kind"), F.coalesce(*kinds.values()).alias("value"))


_BOX = "array<double>"
_LICENCE = "struct<code: array<string>, text: array<string>>"
#: Schemas of collections and of the older raw outputs, with the fields that a row can't do without.
SCHEMAS: dict[str, tuple[str, tuple[str, ...]]] = {
    "collection": (
        "aliases array<string>, created string, description string, source string, storage string, display_name string, type string, "
        "classification array<string>, version array<struct<name: string, version: string>>, license string, filename string, "
        "domain array<string>, `$ref` string, ccs_s3_data struct<endpoint: string, paths: array<struct<bucket: string, prefix: string, "
        f"infix: string>>>, document_license {_LICENCE}, index_key string, project_key string",
        ("created", "source", "type", "version"),
    ),
    "collection_info": ("name string, type string, version string, alias array<string>", ("type",)),
    "acquisition": ("type string, date string, link string, size bigint", ("type",)),
    "log": ("task string, agent string, type string, comment string, date string", ("agent", "type", "date")),
    "file_info": ("filename string, fileprov string, `document-hash` string", ("filename",)),
    "raw_page": (
        f"cells array<struct<SEE_cell: boolean, SEE_confidence: double, angle: double, box: struct<baseline: {_BOX}, device: {_BOX}>, "
        f"content: struct<rnormalized: string>, font: struct<color: array<double>, name: string, size: double>>>, "
        f"dimensions struct<bbox: {_BOX}, height: double, width: double>, images array<struct<box: {_BOX}, height: double, width: double>>, "
        f"paths array<struct<bbox: {_BOX}, type: string>>",
        ("cells",),
    ),
    "ocr": (
        "_meta struct<page: struct<width: double, height: double>>, dimension struct<width: double, height: double>, "
        + ", ".join(f"{k} array<struct<confidence: double, bbox: {_BOX}, content: string>>" for k in ("words", "cells", "boxes"))
        + ", paths array<struct<x: array<double>, y: array<double>>>",
        ("dimension", "words", "cells", "boxes", "paths"),
    ),
    "annotation": (
        ", ".join(
            f"{k} array<struct<cells: array<struct<id: int, rawcell_id: int, label: string>>, clusters: array<struct<model: string, "
            f"type: string, bbox: {_BOX}, cell_ids: array<int>, merged: boolean, id: int>>, tables: array<struct<cell_id: int, "
            "label: string, rows: array<int>, cols: array<int>>>, source: struct<type: string, timestamp: double>>>"
            for k in ("annotations", "predictions")
        ),
        ("annotations", "predictions"),
    ),
}


def validated_as(rows: DataFrame, column: str, name: str, package: str | None = None) -> DataFrame:
    """validated() by one of SCHEMAS. With ``package`` a collection's versions must name that package once."""
    schema, required = SCHEMAS[name]
    out = validated(rows, column, schema, required)
    if name != "collection" or package is None:
        return out
    own = F.size(F.filter("record.version", lambda v: v["name"] == package))
    count = F.when(own == 0, f"no version of {package}").when(own > 1, f"several versions of {package}")
    return out.withColumn("problem", F.coalesce("problem", count))
