"""Scanning for secrets through an incremental blob ledger, with DataFrame functions only.

Every version of every path is content-addressed by the SHA-256 of its text. The ledger
holds, for each blob, the rule versions it was scanned with and what they found. A run
scans one copy of each blob that the ledger lacks, with just the rule versions it lacks,
and then joins findings back to all paths that hold the blob.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vellum.llm.shared import hot_of, salted, spread, table_path, text_or_empty, written

@dataclass(frozen=True)
class Rule:
    """Spans of ``pattern``, leftmost and not overlapping, whose group has enough characters.

    ``hint`` tells quickly that a text can have no match at all.
    """

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0
    hint: str | None = None

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: The base kinds. Runs of fewer than 24 or 20 characters fail as a whole, so
#: their patterns may ask for the length; an assignment is matched first and judged then.
BASE = (
    Rule(
        "assign",
        1,
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", hint="AKIA"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)
#: Further kinds, whose spans come on top.
ADDED = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hint="PRIVATE KEY-----"),
    Rule("forge", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
)


class BlobLedger:
    """A Parquet table of scans: blob_id, rules, spans, each run in a folder of its own.

    A run's folder is named by what it scans, so a run that is repeated after it failed writes
    the same folder again; folders that weren't finished aren't read.
    """

    SCHEMA = "blob_id string, rules array<string>, spans array<struct<start:bigint,place:int,kind:string,end:bigint,rule:string>>"

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or table_path(spark, "ledger")

    def _finished(self) -> list[str]:
        """The folders of finished runs: one a run, whatever their size."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return []
        folders = [status.getPath() for status in files.listStatus(path)]
        return sorted(f.toString() for f in folders if files.exists(f.suffix("/_SUCCESS")))

    def rows(self) -> DataFrame:
        folders = self._finished()
        if not folders:
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(*folders)

    def known(self) -> DataFrame:
        """One row a blob: all rule versions it was scanned with, all spans found."""
        return self.rows().groupBy("blob_id").agg(
            F.array_distinct(F.flatten(F.collect_list("rules"))).alias("rules"),
            F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"),
        )

    def append(self, scans: DataFrame, run: str) -> None:
        scans.write.mode("overwrite").parquet(f"{self.path}/run-{run}")


def scan_versions(
    versions: DataFrame,
    ledger: BlobLedger,
    *,
    path_column: str = "doc_id",
    text_column: str = "text",
    rules: tuple[Rule, ...] = BASE + ADDED,
) -> DataFrame:
    """One row for each row of ``versions``: path, blob_id, spans; the ledger gets the new scans.

    spans holds (start, place of the rule, kind, end, rule version) by start, in code
    points, the end exclusive. Null texts count as empty, very long ones are scanned whole.
    Null and repeated paths are rows like any other; an empty table gives no rows. Further
    columns aren't read, whatever their names. Only spans of the given rule versions are
    returned, whatever else the ledger holds. A new ledger holds nothing: then each distinct
    text is scanned once.
    """
    current = F.array(*[F.lit(r.key) for r in rules])
    addressed = versions.select(
        F.col(f"`{path_column}`").alias("path"), text_or_empty(F.col(f"`{text_column}`")).alias("body")
    ).withColumn("blob_id", F.sha2("body", 256))
    paths = written(addressed.select("path", "blob_id"), "paths")
    blobs = written(paths.groupBy("blob_id").agg(F.min("path").alias("chosen"), F.count("*").alias("rows")), "blobs")
    known = ledger.known().select("blob_id", F.col("rules").alias("had"))
    unseen = (
        blobs.drop("rows").join(known, "blob_id", "left")
        .withColumn("missing", F.array_except(current, F.coalesce("had", F.array().cast("array<string>"))))
        .filter(F.size("missing") > 0)
        .select(F.col("blob_id").alias("unseen_id"), "chosen", "missing")
    )
    unseen = written(unseen, "unseen")
    pairs = F.sum(F.xxhash64("unseen_id", "missing").cast("decimal(38,0)"))
    scanned, mark = unseen.agg(F.count("*"), F.coalesce(pairs, F.lit(0)).cast("string")).first()
    if scanned:
        # The blob's own id in the key keeps rows with a null or repeated path apart.
        on = addressed["path"].eqNullSafe(unseen["chosen"]) & (addressed["blob_id"] == unseen["unseen_id"])
        ledger.append(_scanned(addressed.join(unseen, on).select("blob_id", "body", "missing"), rules), f"{scanned}-{mark}")
    found = ledger.known().select(
        "blob_id", F.array_sort(F.filter("spans", lambda s: F.array_contains(current, s["rule"]))).alias("spans")
    )
    found = found.filter(F.size("spans") > 0)
    # Copies of a blob may be a third of all rows.
    hot = hot_of(blobs, "blob_id", paths.count())
    none = F.array().cast(found.schema["spans"].dataType)
    return salted(paths, hot, "blob_id", "path").join(spread(found, hot, "blob_id"), ["blob_id", "__salt"], "left").select(
        "path", "blob_id", F.coalesce("spans", none).alias("spans")
    )


def _scanned(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows of ``blobs`` (blob_id, body, missing): every blob is scanned with what it misses.

    The texts between matches and the matches give all positions by running sums. Blobs
    without a match never leave their task's rows; the others send lengths, not texts.
    """
    pieces = F.concat(*[_pieces(F.col("body"), place, rule) for place, rule in enumerate(rules)])
    cut = written(blobs.select("blob_id", "missing", pieces.alias("pieces")).distinct(), "pieces")
    lengths = cut.filter(F.size("pieces") > 0).select("blob_id", F.explode("pieces").alias("p")).select("blob_id", "p.*")
    upto = W.partitionBy("blob_id", "place").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    ends = lengths.withColumn("end", F.sum(F.col("before") + F.col("matched")).over(upto))
    span = F.struct((F.col("end") - F.col("matched")).alias("start"), "place", "kind", "end", "rule")
    spans = ends.filter("valid").groupBy("blob_id").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    none = F.array().cast(spans.schema["spans"].dataType)
    return cut.join(spans, "blob_id", "left").select(
        "blob_id", F.col("missing").alias("rules"), F.coalesce("spans", none).alias("spans")
    )


def _pieces(body: Column, place: int, rule: Rule) -> Column:
    """For each match: characters before it since the last one, its own, whether it is valid."""
    asked = F.array_contains("missing", F.lit(rule.key))
    hinted = asked & body.contains(rule.hint) if rule.hint else asked
    matches = F.regexp_extract_all(body, F.lit(rule.pattern), F.lit(0))
    judged = matches if not rule.group else F.regexp_extract_all(body, F.lit(rule.pattern), F.lit(rule.group))
    between = F.split(body, rule.pattern, -1)
    piece = F.transform(
        F.arrays_zip(F.slice(between, F.lit(1), F.size(matches)).alias("b"), matches.alias("m"), judged.alias("g")),
        lambda x, i: F.struct(
            F.lit(place).alias("place"),
            F.lit(rule.kind).alias("kind"),
            F.lit(rule.key).alias("rule"),
            i.alias("i"),
            F.length(x["b"]).cast("long").alias("before"),
            F.length(x["m"]).cast("long").alias("matched"),
            (F.length(x["g"]) >= rule.least).alias("valid"),
        ),
    )
    none = F.array().cast(
        "array<struct<place:int,kind:string,rule:string,i:int,before:bigint,matched:bigint,valid:boolean>>"
    )
    return F.when(hinted & body.rlike(rule.pattern), piece).otherwise(none)


def spans_of(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
