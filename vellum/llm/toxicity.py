"""Toxicity of texts: a character n-gram linear model over naive Bayes features.

Each n-gram's presence is scaled by its log-count ratio between toxic and other labelled
texts, and a logistic regression over the scaled features gives the score. A task fits it on
a bounded number of labelled rows; the driver sees the weights only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.linear import Grams, gram_sets, logistic, sigmoid, text_slices
from vellum.llm.shared import bounded_batches, text_or_empty, tidy


@dataclass(frozen=True)
class Fit:
    """How to fit. ``rows_a_class`` bounds the labelled rows to learn from, never the rows to score."""

    rows_a_class: int = 2000
    sizes: tuple[int, ...] = (3, 4, 5, 6)
    bits: int = 20
    least_errors: float = 3.0
    penalty: float = 1.0


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from: a fifth, by the id's checksum."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def known_labels(labels: DataFrame, label: str, id_column: str = "doc_id") -> DataFrame:
    """doc_id, label of ids to learn from. Labels other than 0 and 1 are none; of an id's several, 1 counts."""
    doc_id = F.col(f"`{id_column}`")
    known = labels.select(doc_id.alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return known.groupBy("doc_id").agg(F.max("label").alias("label"))


def chosen(known: DataFrame, name: str, rows_a_class: int) -> list[tuple]:
    """(doc_id, label): as many of each class as allowed, chosen by a hash of the id."""
    order = F.md5(F.concat(F.lit(name), F.col("doc_id").cast("string")))
    some = [known.filter(F.col("label") == k).orderBy(order).limit(rows_a_class) for k in (0, 1)]
    return [(r["doc_id"], r["label"]) for x in some for r in x.collect()]  # bounded by rows_a_class


def sample(docs: DataFrame, labels: DataFrame, label: str, fit: Fit, id_column: str, text_column: str) -> DataFrame:
    """doc_id, label, body: whole labelled texts. Of rows that repeat an id the smallest text counts."""
    known = known_labels(labels, label, id_column)
    wanted = F.broadcast(docs.sparkSession.createDataFrame(chosen(known, label, fit.rows_a_class), known.schema))
    found = docs.select(F.col(f"`{id_column}`").alias("doc_id"), text_or_empty(F.col(f"`{text_column}`")).alias("body"))
    return found.join(wanted, "doc_id").groupBy("doc_id", "label").agg(F.min("body").alias("body"))


def train(sets: list[np.ndarray], labels: np.ndarray, fit: Fit = Fit()) -> Grams:
    """The model from texts' gram_sets(); where one class is missing, a constant that leans to the other.

    The list is left empty: grams that tell nothing are given up text by text.
    """
    width = 1 << fit.bits
    if not len(labels) or labels.min() == labels.max():
        odds = (labels.sum() + 0.5) / (len(labels) - labels.sum() + 0.5) if len(labels) else 1e-3
        return Grams(fit.sizes, fit.bits, np.zeros(width, np.float32), float(np.log(odds)))
    counted = [np.zeros(width, np.int64), np.zeros(width, np.int64)]
    for buckets, label in zip(sets, labels, strict=True):
        counted[int(label > 0)][buckets] += 1
    p, q = counted[1] + 1.0, counted[0] + 1.0
    ratio = np.log(p / (labels.sum() + 2)) - np.log(q / (len(labels) - labels.sum() + 2))
    # Only ratios that stand out from their standard error: chance finds would outvote them in long texts.
    used = np.abs(ratio) >= fit.least_errors * np.sqrt(1 / p + 1 / q)
    number = (np.cumsum(used) - 1).astype(np.int32)
    scale = ratio[used]
    sets.reverse()
    kept = []
    while sets:
        one = sets.pop()
        kept.append(number[one[used[one]]])
    weights, bias = logistic(kept, scale, labels, np.ones(len(labels)), fit.penalty)
    table = np.zeros(width, np.float32)
    table[used] = weights * scale
    return Grams(fit.sizes, fit.bits, table, bias)


def fitted(rows: DataFrame, fit: Fit) -> Grams:
    """The model from a bounded number of rows (doc_id, label, body), fitted in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            sets = [s for some in text_slices(batch.column(2)) for s in gram_sets(some, fit.sizes, fit.bits)]
            held += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), sets, strict=True)
        held.sort(key=lambda x: x[0])
        labels, sets = np.array([x[1] for x in held], float), [x[2] for x in held]
        del held
        model = train(sets, labels, fit)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()]), pa.array([model.bias])], ["weights", "bias"])

    bounded_batches(rows.sparkSession)
    # A task of an empty partition runs too: without rows there is a model as well.
    one = rows.select("doc_id", "label", "body").repartition(1).mapInArrow(tidy(run), "weights binary, bias double").first()
    if one is None:
        return train([], np.zeros(0), fit)
    return Grams(fit.sizes, fit.bits, np.frombuffer(one["weights"], np.float32), one["bias"])


def score(docs: DataFrame, model: Grams, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, score of every row of ``docs``, each over its whole text.

    Null and empty texts get the model's constant. Very long texts are taken in pieces.
    Repeated rows and null ids are rows like any other; further columns aren't read, whatever
    their names; an empty table gives no rows. The model that is broadcast has 2 ** bits
    weights, whatever the input.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [sigmoid(shared.value.margins(some)) for some in text_slices(batch.column(1))]
            values = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), text_or_empty(F.col(f"`{text_column}`")).alias("body"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"doc_id {kind}, score double")


def toxicity(
    docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), *, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "toxic",
) -> DataFrame:
    """doc_id, score of all ``docs``, learnt from ``labels`` outside the held-out fifth.

    ``labels`` has the ids' column and the label's. Null ids and labels other than 0 and 1 are
    passed over, labels that contradict each other count as 1, and labels of ids that ``docs``
    lacks teach nothing. Without labels of both classes all rows score alike. See score() for
    null, empty, long and repeated rows.
    """
    model = fitted(sample(docs, labels, label_column, fit, id_column, text_column), fit)
    return score(docs, model, id_column=id_column, text_column=text_column)


def without_toxic(
    docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), threshold: float = 0.5, *, id_column: str = "doc_id",
    text_column: str = "text", label_column: str = "toxic",
) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns, in one pass.

    Rows are judged as by toxicity(); rows of null and empty texts stay where the model's
    constant is below the threshold.
    """
    bounded_batches(docs.sparkSession)
    model = fitted(sample(docs, labels, label_column, fit, id_column, text_column), fit)
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [sigmoid(shared.value.margins(some)) for some in text_slices(batch.column(at))]
            yield batch.filter(pa.array(np.concatenate(scores) < threshold)) if scores else batch

    return docs.mapInArrow(tidy(run), docs.schema)
