"""Manifests of statutes and their annexes, from YAML or JSON."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.schemas import MANIFEST


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row a manifest: its folder and fields, null where the file can't be read. Keys that aren't known are ignored.

    Whatever converter a manifest names its caches by, a key that ends in _cache, or in _path
    but for local_path, is the cache; the first one that has a value counts.
    """
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json

        import yaml

        for batch in batches:
            texts = []
            for x in batch.column(1).to_pylist():
                try:
                    texts.append(json.dumps(_with_cache(yaml.safe_load(x)), default=str))
                except (yaml.YAMLError, ValueError, TypeError):
                    texts.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["path", "value"])

    turned = files.mapInArrow(run, "path string, value string")
    return turned.select(F.regexp_replace("path", "/[^/]*$", "").alias("folder"), F.from_json("value", MANIFEST).alias("m")).select("folder", "m.*")


def _with_cache(node):
    if isinstance(node, list):
        return [_with_cache(x) for x in node]
    if not isinstance(node, dict):
        return node
    out = {}
    for suffix in ("_cache", "_path"):
        for key, value in node.items():
            if str(key).endswith(suffix) and key != "local_path" and value:
                out.setdefault("cache", value)
    return {k: _with_cache(v) for k, v in node.items()} | out


def annexes(manifests: DataFrame) -> DataFrame:
    """One row an annex, in the manifest's order, with file names below the manifest's folder."""
    rows = manifests.select("folder", "law_id", F.posexplode("annexes").alias("ord", "a"))
    within = lambda name: F.when(name.startswith("/"), name).otherwise(F.concat_ws("/", "folder", name))
    file = F.coalesce("a.filename", "a.local_path")
    cache = F.col("a.cache")
    return rows.select(
        "law_id", "ord", "a.number", "a.title", F.coalesce("a.type", F.lit("inline")).alias("kind"), "a.url",
        F.when(file.isNotNull(), within(file)).alias("file"), F.when(cache.isNotNull(), within(cache)).alias("cache"),
        F.coalesce("a.parser", F.lit("hybrid")).alias("parser"), "a.parser_options",
    )


def write(annex_rows: DataFrame, path: str) -> None:
    """Manifests as JSON, one row a law."""
    entry = F.struct("ord", "number", "title", F.col("kind").alias("type"), "url", F.col("file").alias("filename"))
    rows = annex_rows.groupBy("law_id").agg(F.sort_array(F.collect_list(entry)).alias("annexes"))
    rows.write.mode("overwrite").json(path)
