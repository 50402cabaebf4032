"""Quality of documents by co-training two views: the text's content and the page's metadata.

Each view has a classifier of its own. In each round both score all unlabelled documents, and
of those that a view is surest of over the whole corpus the other learns some. In the end each
view's margin is calibrated on a fifth of the labelled rows to learn from, which neither view
has learnt from, and the calibrated views are added up, less the prior that both contain. Where
that fifth lacks a class, all of these rows calibrate.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm import toxicity
from vellum.llm.linear import Grams, gram_sets, logistic, sigmoid, text_slices
from vellum.llm.shared import bounded_batches, text_or_empty, tidy, written

#: Buckets of metadata features.
META_BITS = 14
#: Kinds of bytes that a page's shape counts: line feeds, capitals, marks, digits, and those that begin a character.
KINDS = np.zeros((5, 256), bool)
KINDS[0, 10] = KINDS[1, 65:91] = KINDS[3, 48:58] = True
KINDS[2, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
KINDS[4] = (np.arange(256) & 0xC0) != 0x80


@dataclass(frozen=True)
class CoFit:
    """How to fit. The bounds are of rows to learn from, never of rows to score or to choose among."""

    rows_a_class: int = 1500
    rounds: int = 3
    taught_a_class: int = 150
    sure: float = 0.95
    text: toxicity.Fit = field(default_factory=lambda: toxicity.Fit(sizes=(1, 2, 3), bits=18))


def shapes(texts: pa.Array) -> np.ndarray:
    """One row a text: line feeds, capitals, marks, digits and code points."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw else np.zeros(0, np.uint8)
    upto = [np.concatenate(([0], np.cumsum(k[data], dtype=np.int64))) for k in KINDS]
    at = offsets - offsets[0]
    return np.stack([u[at[1:]] - u[at[:-1]] for u in upto], axis=1)


def metadata(names: tuple[str, ...], given: list[list[str | None]], texts: pa.Array) -> list[np.ndarray]:
    """Metadata features of each row: given columns, all of them together, and the shape of the page."""
    counts = shapes(texts)
    length = counts[:, 4]
    lines = counts[:, 0] + 1
    log = lambda x: np.floor(np.log2(x + 1)).astype(int).tolist()
    share = lambda x: (20 * x // np.maximum(length, 1)).tolist()
    shape = {
        "length": log(length), "lines": log(lines), "line": log(length / lines), "capitals": share(counts[:, 1]),
        "marks": share(counts[:, 2]), "digits": share(counts[:, 3]),
    }
    out = []
    for row in range(len(texts)):
        own = [f"{c}={'-' if v[row] is None else v[row]}" for c, v in zip(names, given, strict=True)]
        words = own + (["&".join(own)] if len(own) > 1 else []) + [f"{k}:{v[row]}" for k, v in shape.items()]
        out.append(np.unique([zlib.crc32(w.encode()) >> (32 - META_BITS) for w in words]).astype(np.int32))
    return out


@dataclass(frozen=True)
class Meta:
    """A linear model over metadata features."""

    weights: np.ndarray
    bias: float

    def margins(self, sets: list[np.ndarray]) -> np.ndarray:
        rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        columns = np.concatenate([*sets, np.zeros(0, np.int32)])
        return np.bincount(rows, self.weights[columns], len(sets)) + self.bias


def _train_meta(sets: list[np.ndarray], labels: np.ndarray) -> Meta:
    weights, bias = logistic(sets, np.ones(1 << META_BITS), labels, np.ones(len(labels)), 1.0, 300)
    return Meta(weights.astype(np.float32), bias)


@dataclass(frozen=True)
class Views:
    """Both classifiers, each margin's calibration (slope, offset), and the prior's log odds."""

    text: Grams
    meta: Meta
    scales: tuple[tuple[float, float], tuple[float, float]]
    prior: float

    def scores(self, texts: list[str], sets: list[np.ndarray]) -> np.ndarray:
        """Three rows: both calibrated views together, the text's, the metadata's."""
        margins = self.text.margins(texts), self.meta.margins(sets)
        views = [a * m + b for (a, b), m in zip(self.scales, margins, strict=True)]
        return sigmoid(np.stack([views[0] + views[1] - self.prior, *views]))

    def sureness(self, texts: list[str], sets: list[np.ndarray]) -> np.ndarray:
        """Two rows: what the text's and the metadata's own classifiers say, before calibration."""
        return sigmoid(np.stack([self.text.margins(texts), self.meta.margins(sets)]))


def _platt(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and offset that make margins log odds. A view that tells nothing gets the prior alone."""
    spread = float(np.std(margins)) or 1.0
    x, w, b = margins / spread, 0.0, 0.0
    for _ in range(100):  # Newton's steps of a penalised logistic regression in two unknowns
        p = sigmoid(w * x + b)
        g, h = weights * (p - labels), weights * p * (1 - p) + 1e-9
        hessian = np.array([[(h * x * x).sum() + 1.0, (h * x).sum()], [(h * x).sum(), h.sum()]])
        step = np.linalg.solve(hessian, np.array([(g * x).sum() + w, g.sum()]))
        w, b = w - float(np.clip(step[0], -2, 2)), b - float(np.clip(step[1], -2, 2))
        if np.abs(step).max() < 1e-8:
            break
    return (w / spread, b) if w > 0 else (0.0, prior)


def views(
    texts: list[np.ndarray], metas: list[np.ndarray], labels: np.ndarray, taught: list[str | None], share: float, fit: CoFit
) -> Views:
    """Both views from rows to learn from. ``taught``: the view that learns a pseudo-label; None for labelled rows.

    ``share`` is that of label 1 among all labelled rows.
    """
    own = np.array([t is None for t in taught], bool)
    y = labels[own]
    if not len(y) or y.min() == y.max():
        prior = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))) if len(y) else 0.0
        none = np.zeros(1 << META_BITS, np.float32)
        text = Grams(fit.text.sizes, fit.text.bits, np.zeros(1 << fit.text.bits, np.float32), prior)
        return Views(text, Meta(none, prior), ((0.0, prior), (0.0, prior)), prior)
    prior = float(np.log((share + 1e-4) / (1 - share + 1e-4)))
    at = np.flatnonzero(own)
    kept = at[np.arange(len(at)) % 5 == 0]
    learnt = np.setdiff1d(at, kept)
    if min(len(np.unique(labels[x])) if len(x) else 0 for x in (kept, learnt)) < 2:
        kept, learnt = at, at
    model = {}
    for view in ("text", "meta"):
        rows = [*learnt, *[k for k, t in enumerate(taught) if t == view]]
        model[view] = [(texts if view == "text" else metas)[k] for k in rows], labels[rows]  # lists of their own
    text, meta = toxicity.train(*model["text"], fit.text), _train_meta(*model["meta"])
    y = labels[kept]
    # Classes were drawn alike; weights restore their shares.
    weights = np.where(y > 0, share / y.mean(), (1 - share) / (1 - y.mean()))
    columns = [texts[k] for k in kept]
    margins = np.array([text.weights[c].sum() + text.bias for c in columns]), meta.margins([metas[k] for k in kept])
    return Views(text, meta, tuple(_platt(m, y, weights, prior) for m in margins), prior)


def _fitted(rows: DataFrame, names: tuple[str, ...], share: float, fit: CoFit) -> Views:
    """The views from a bounded number of rows (doc_id, body, names, label, taught), fitted in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            text = [s for some in text_slices(batch.column(1)) for s in gram_sets(some, fit.text.sizes, fit.text.bits)]
            meta = metadata(names, [batch.column(2 + k).to_pylist() for k in range(len(names))], batch.column(1))
            ids, labels, taught = (batch.column(k).to_pylist() for k in (0, -2, -1))
            held += zip([zlib.crc32(str(i).encode()) for i in ids], map(str, ids), text, meta, labels, taught, strict=True)
        held.sort(key=lambda x: (*x[:2], x[5] or ""))
        labels = np.array([x[4] for x in held], float)
        model = views([x[2] for x in held], [x[3] for x in held], labels, [x[5] for x in held], share, fit)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    one = rows.repartition(1).mapInArrow(tidy(run), "model binary").first()
    return views([], [], np.zeros(0), [], share, fit) if one is None else pickle.loads(one["model"])


def _scored(viewed: DataFrame, names: tuple[str, ...], model: Views, function: str, columns: tuple[str, ...]) -> DataFrame:
    """doc_id and the rows of a function of the model, over whole texts."""
    shared = viewed.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given, at, parts = [batch.column(2 + k).to_pylist() for k in range(len(names))], 0, []
            for some in text_slices(batch.column(1)):
                own = metadata(names, [g[at : at + len(some)] for g in given], batch.column(1).slice(at, len(some)))
                parts.append(getattr(shared.value, function)(some, own))
                at += len(some)
            values = np.concatenate(parts, axis=1) if parts else np.zeros((len(columns), 0))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(v, pa.float64()) for v in values]], ["doc_id", *columns])

    kind = viewed.schema["doc_id"].dataType.simpleString()
    return viewed.mapInArrow(tidy(run), ", ".join([f"doc_id {kind}", *[f"{c} double" for c in columns]]))


def quality(
    docs: DataFrame, labels: DataFrame, fit: CoFit = CoFit(), *, columns: tuple[str, ...] = ("source", "lang"),
    id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality",
) -> DataFrame:
    """doc_id, score (of label 1, good), text_score, meta_score of every row of ``docs``.

    Labels of the held-out fifth are never learnt from; labels that contradict each other count
    as 1, and ids of ``labels`` are never pseudo-labelled. All other documents are scored in each
    round, and the surest of them all are taught. Null and empty texts have metadata of their
    own shape and the text view's constant. Null metadata is a value like any other. Very long
    texts are taken in pieces. Repeated rows and null ids are rows like any other, but of those
    that share an id the smallest text teaches. Further columns aren't read, whatever their
    names; an empty table gives no rows. Without labels of both classes all rows score the same.
    What is broadcast has a fixed number of weights.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    given = [F.col(f"`{c}`").cast("string").alias(f"given_{k}") for k, c in enumerate(columns)]
    viewed = docs.select(F.col(f"`{id_column}`").alias("doc_id"), text_or_empty(F.col(f"`{text_column}`")).alias("body"), *given)
    known = toxicity.known_labels(labels, label_column, id_column)
    share = known.agg(F.avg("label")).first()[0]
    share = 0.5 if share is None else float(share)
    kinds = f"doc_id {known.schema['doc_id'].dataType.simpleString()}, label int, taught string"
    wanted = [(i, label, None) for i, label in toxicity.chosen(known, "quality", fit.rows_a_class)]
    named = labels.select(F.col(f"`{id_column}`").alias("doc_id"))
    model, classes = None, len({label for _, label, _ in wanted})
    for turn in range(fit.rounds + 1 if classes == 2 else 1):
        ids = F.broadcast(spark.createDataFrame(wanted, kinds))  # bounded by rows_a_class and taught_a_class
        rows = viewed.join(ids, "doc_id").groupBy("doc_id", "label", "taught").agg(F.min(F.struct("body", *[f"given_{k}" for k in range(len(columns))])).alias("v"))
        model = _fitted(rows.select("doc_id", "v.*", "label", "taught"), columns, share, fit)
        if turn == fit.rounds or classes < 2:
            break
        sure = _scored(viewed, columns, model, "sureness", ("text", "meta"))
        taught = spark.createDataFrame([(i,) for i, *_ in wanted], kinds.split(",")[0])
        # Only ids and numbers are joined: texts stay where they are.
        sure = sure.dropna().join(named, "doc_id", "left_anti").join(F.broadcast(taught), "doc_id", "left_anti")
        sure = written(sure.filter(F.greatest("text", "meta", 1 - F.col("text"), 1 - F.col("meta")) >= fit.sure), "sure")
        for teacher, view in (("text", "meta"), ("meta", "text")):
            for label in (1, 0):
                certain = F.col(teacher) if label else 1 - F.col(teacher)
                best = sure.filter(certain >= fit.sure).groupBy("doc_id").agg(F.max(certain).alias("certain"))
                best = best.orderBy(F.desc("certain"), "doc_id").limit(fit.taught_a_class)
                wanted += [(r["doc_id"], label, view) for r in best.collect()]  # bounded by taught_a_class
    return _scored(viewed, columns, model, "scores", ("score", "text_score", "meta_score"))
