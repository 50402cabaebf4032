import random
import zlib

import pytest

import numpy as np

from vellum.llm import linear
from vellum.llm.cotraining import CoFit, quality, shapes, views
from vellum.llm.toxicity import Fit, toxicity, train, without_toxic

SCHEMA = "doc_id long, text string, lang string, source string, score string"


@pytest.fixture(scope="module")
def corpus(spark):
    rng, words = random.Random(3), [f"{a}{b}" for a in "bdfgklmn" for b in ("ana", "ero", "ilo", "umi")]
    rows, labels = [], []
    for i in range(600):
        body = [rng.choice(words) for _ in range(rng.choice([5, 40, 300]))]
        toxic, good = rng.random() < 0.2, rng.random() < 0.7
        if toxic:
            body[rng.randrange(len(body))] = rng.choice(["vilest", "doltish"])
        if not good:
            body = [w.upper() + "!!" for w in body]
        rows.append((i, " ".join(body), "en", "good" if good else "bad", "x"))
        if i % 2 or i < 100:
            labels.append((i, int(good), int(toxic)))
    rows += [(None, "null id", None, None, "x"), (700, None, None, "good", "x"), (701, "", "en", None, "x"), (1, "vilest one", "en", "good", "x"), (702, "w " * 60_000 + "doltish", "en", "good", "x")]
    labels += [(9999, 1, 1), (None, 1, 1), (3, None, None)]
    return spark.createDataFrame(rows, SCHEMA).cache(), spark.createDataFrame(labels, "doc_id long, quality int, toxic int").cache(), rows, labels


def test_toxicity_on_held_out_rows(spark, corpus):
    docs, labels, rows, marked = corpus
    scored = toxicity(docs, labels).collect()
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 for r in scored)
    known = {i: t for i, _, t in marked if i is not None and i < 600 and i not in (1, 3) and zlib.crc32(str(i).encode()) % 5 == 0}
    wrong = sum((r.score >= 0.5) != bool(known[r.doc_id]) for r in scored if r.doc_id in known)
    assert len(known) > 50 and wrong <= 2
    long = [r.score for r in scored if r.doc_id == 702]
    assert long[0] >= 0.5
    kept = without_toxic(docs, labels)
    assert kept.schema == docs.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in scored if r.score < 0.5)


def test_held_out_labels_do_not_matter(spark, corpus):
    docs, labels, _, marked = corpus
    turned = [(i, q, 1 - t if i is not None and t is not None and zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in marked]
    other = spark.createDataFrame(turned, labels.schema)
    a = sorted((str(r.doc_id), r.score) for r in toxicity(docs, labels).collect())
    assert a == sorted((str(r.doc_id), r.score) for r in toxicity(docs, other).collect())


def test_quality_on_held_out_rows(spark, corpus):
    docs, labels, rows, marked = corpus
    scored = quality(docs, labels, CoFit(rows_a_class=200, taught_a_class=40)).collect()
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 for r in scored)
    known = {i: q for i, q, _ in marked if i is not None and i < 600 and i not in (1, 3) and zlib.crc32(str(i).encode()) % 5 == 0}
    wrong = sum((r.score >= 0.5) != bool(known[r.doc_id]) for r in scored if r.doc_id in known)
    assert wrong <= 2
    good = [r.score for r in scored if r.doc_id in known and known[r.doc_id]]
    assert sum(s >= 0.5 for s in good) >= 0.98 * len(good)


def test_missing_labels_and_empty_tables(spark, corpus):
    docs, labels, _, _ = corpus
    for none in (labels.filter("false"), labels.filter("toxic = 0 AND quality = 1")):
        assert len({r.score for r in toxicity(docs, none, Fit(bits=16)).collect()}) == 1
        assert len({round(r.score, 9) for r in quality(docs, none).collect()}) == 1
    assert toxicity(docs.filter("false"), labels).count() == 0
    assert quality(docs.filter("false"), labels).count() == 0
    assert without_toxic(docs.filter("false"), labels).count() == 0


def slow_grams(text, sizes, bits):
    """The buckets of a text's n-grams, one at a time."""
    mask, points = (1 << 64) - 1, [max(ord(c), 32) for c in f" {(text or '').lower()} "]
    out = set()
    for n in sizes:
        for a in range(len(points) - n + 1):
            code = 0
            for p in points[a : a + n]:
                code = (code * 0x100000001B3 + p) & mask
            code = ((code ^ (code >> 29)) * 0xBF58476D1CE4E5B9 + n) & mask
            out.add((((code ^ (code >> 32)) * 0x9E3779B97F4A7C15) & mask) >> (64 - bits))
    return out


def slow_optimum(sets, scale, labels, penalty, steps=20_000):
    """Plain gradient steps on dense rows, until nothing changes."""
    x = np.array([[scale[k] if k in s else 0.0 for k in scale] for s in sets]).reshape(len(sets), -1)
    w, b, rate = np.zeros(x.shape[1]), 0.0, 4.0 / (1 + (x**2).sum(axis=1).max(initial=0) + penalty)
    for _ in range(steps):
        error = (1 / (1 + np.exp(-(x @ w + b))) - labels) / len(labels)
        w, b = w - rate * (x.T @ error + penalty / len(labels) * w), b - rate * error.sum()
    return dict(zip(scale, w, strict=True)), b


def test_scores_are_those_of_brute_force():
    rng, fit = random.Random(8), Fit(sizes=(2, 3), bits=16, least_errors=2.0)
    words = ["ana", "bero", "cilo", "dumi", "vile", "dolt"]
    texts = [" ".join(rng.choice(words[: 4 + 2 * (k % 3 == 0)]) for _ in range(rng.choice([2, 5, 9]))) for k in range(60)] + ["", None]
    labels = np.array([float("vile" in (t or "") or "dolt" in (t or "")) for t in texts])
    labels[5] = 1 - labels[5]
    sets = [slow_grams(t, fit.sizes, fit.bits) for t in texts]
    assert [set(s.tolist()) for s in linear.gram_sets(texts, fit.sizes, fit.bits)] == sets
    scale = {}
    for k in set().union(*sets):
        p, q = (1 + sum(k in s for s, y in zip(sets, labels) if y == c) for c in (1, 0))
        ratio = np.log(p / (labels.sum() + 2)) - np.log(q / ((1 - labels).sum() + 2))
        if abs(ratio) >= fit.least_errors * (1 / p + 1 / q) ** 0.5:
            scale[k] = ratio
    weight, bias = slow_optimum(sets, scale, labels, fit.penalty)
    want = np.array([bias + sum(weight[k] * scale[k] for k in s if k in scale) for s in sets])
    got = train(linear.gram_sets(texts, fit.sizes, fit.bits), labels, fit).margins(texts)
    assert np.abs(linear.sigmoid(got) - linear.sigmoid(want)).max() < 0.02


def test_very_long_texts_have_the_grams_of_their_pieces(monkeypatch):
    monkeypatch.setattr(linear, "PIECE", 100)
    text = " ".join(random.Random(2).choice(["ab", "cde", "f", "ghij"]) for _ in range(400))
    assert set(linear.gram_sets([text], (2, 3, 5), 16)[0].tolist()) == slow_grams(text, (2, 3, 5), 16)


def test_shapes_and_views_are_those_of_brute_force():
    import pyarrow as pa

    texts = ["Ab1\n!", None, "", "\u00e9\u00c9 9_~\n\n"]
    assert shapes(pa.array(["skipped", *texts]).slice(1)).tolist() == [[1, 1, 1, 1, 5], [0] * 5, [0] * 5, [2, 0, 2, 1, 8]]
    # Calibration is on the fifth that neither view learns from; taught rows go to the view they are meant for.
    rng = np.random.default_rng(1)
    labels = rng.integers(0, 2, 100).astype(float)
    sets = [np.array([10 + int(y), *rng.integers(100, 200, 3)], np.int32) for y in labels]
    taught = [None] * 90 + ["text"] * 5 + ["meta"] * 5
    fit = CoFit()
    both = views([np.unique(s) for s in sets], [np.unique(s) for s in sets], labels, taught, 0.5, fit)
    learnt = [k for k in range(90) if k % 5]
    text = train([np.unique(sets[k]) for k in [*learnt, *range(90, 95)]], labels[[*learnt, *range(90, 95)]], fit.text)
    assert np.allclose(both.text.weights, text.weights) and np.isclose(both.text.bias, text.bias)
    assert both.scales[0][0] > 0 and both.scales[1][0] > 0
