import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from vellum.llm.linear import gram_sets, sigmoid
from vellum.llm.toxicity import Fit, train

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng, words = random.Random(5), [f"w{i}" for i in range(300)]
    rows = []
    while len(rows) < 150:
        base = [rng.choice(words) for _ in range(rng.choice([3, 30, 80]))]
        for _ in range(rng.choice([1, 1, 2, 3])):
            copy = list(base)
            if rng.random() < 0.4:
                copy[rng.randrange(len(copy))] = rng.choice(words)
            if rng.random() < 0.15:
                copy += ["vile", "dolt"]
            rows.append(" ".join(copy) if rng.random() < 0.5 else "\n".join(copy))
    rows += ["", None]
    docs = [(i, t, "en", rng.choice(["a", "b", "c", None, "a"]), len(t or "")) for i, t in enumerate(rows)]
    labels = [(i, 1, int("vile" in (t or ""))) for i, t, *_ in docs if i % 3]
    path = str(tmp_path_factory.mktemp("tables"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, docs, labels


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(docs, labels):
    by_id = {d[0]: d for d in docs}
    known = [(i, t) for i, _, t in labels if zlib.crc32(str(i).encode()) % 5]
    fit = Fit()
    known = sorted(known)
    model = train(gram_sets([by_id[i][1] for i, _ in known], fit.sizes, fit.bits), np.array([t for _, t in known], float), fit)
    docs = [d for d in docs if sigmoid(model.margins([d[1]]))[0] < 0.5]
    groups = defaultdict(list)
    for d in docs:
        groups["".join(split(d[1]))].append(d)
    docs = [min(g, key=lambda d: (-len(d[1] or ""), d[0])) for g in groups.values()]
    sets = {d[0]: {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} - {()} for d in docs if (w := split((d[1] or "").lower())) or True}
    root = {d[0]: d[0] for d in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in root:
        for b in root:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted(d[0] for d in docs if find(d[0]) == d[0]), by_id


def test_stages_do_what_brute_force_does(spark, tables):
    path, docs, labels = tables
    frame, seen = spark.read.parquet(f"{path}/documents.parquet"), {}
    columns = frame.schema
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.written(stage(spark, frame, path), name)
        if name != "packing":
            assert out.schema == columns
            seen[name] = out.collect()
            frame = out
    survivors, by_id = brute(docs, labels)
    assert sorted(r.doc_id for r in seen["near_dedup"]) == survivors
    assert not any("vile" in (r.text or "") for r in seen["toxicity"])
    for name in ("toxicity", "exact_dedup", "near_dedup", "mixing"):
        assert all(tuple(r) == by_id[r.doc_id] for r in seen[name])
    taken = Counter()
    for r in seen["mixing"]:
        taken[r.source] += len(split(r.text))
    sizes = Counter()
    for i in survivors:
        sizes[by_id[i][3]] += len(split(by_id[i][1]))
    assert all(taken[s] <= 3 * sizes[s] for s in sizes)
    assert abs(sum(taken.values()) - sum(sizes.values())) <= (80 + 4 * 64) * len(sizes)
    tokenizer = tokenizers.Tokenizer.from_file(public.path("word_bpe_49k.json"))
    want = Counter((r.doc_id, len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1) for r in seen["mixing"])
    pieces = out.collect()
    got = Counter()
    for p in pieces:
        got[(p.doc_id, p.doc_tokens)] += p.length
    assert got == Counter({k: k[1] * n for k, n in want.items()})


def test_run_gives_sequences(spark, tables):
    rows = corpus_pipeline.run(spark, tables[0]).collect()
    length = Counter()
    for r in rows:
        length[r.sequence_id] += r.length
    assert all(n == 2048 or n & (n - 1) == 0 for n in length.values())


CLASHES = ("gone_id", "times", "drawn_id", "whole", "own_id", "slots", "digest", "body", "doc", "label", "score", "key", "rows", "__hot")


@pytest.fixture(scope="module")
def odd(spark, tables):
    from pyspark.sql import functions as F

    base = " ".join(f"word{i}" for i in range(40))
    rows = [
        (1, base, "a"), (1, base, "a"), (2, base.replace(" ", "\n"), "b"), (3, base + " more", "a"), (None, base + " other", "a"), (None, None, None),
        (4, "", "a"), (5, None, "b"), (6, " \t", None), (7, "x " * 60_000, "c"), (7, "seven", "c"), (8, next(t for _, t, *_ in tables[1] if "vile" in (t or "")), "a"), (9, "clean words here", None),
    ]
    df = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHES)]).repartition(3)


def test_stages_on_odd_rows_and_clashing_columns(spark, tables, odd):
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        done = stage(spark, odd, tables[0])
        if name != "packing":
            assert done.columns == odd.columns
        out[name] = done.collect()
    said = lambda name: Counter((r.doc_id, (r.text or "")[:12]) for r in out[name])
    # The labels are those of other texts here: what is learnt says nothing, but rows come whole or not at all.
    assert not Counter(map(tuple, out["toxicity"])) - Counter(map(tuple, odd.collect()))
    exact = said("exact_dedup")
    assert sum(exact.values()) == 8 and exact[1, "word0 word1 w"[:12]] + exact[2, "word0\nword1 "[:12]] == 1
    near = said("near_dedup")
    # Both rows of id 1, and a row without an id that another one without an id keeps.
    assert sum(n for (i, t), n in near.items() if t.startswith("word0")) == 3
    assert sum(n for (_, t), n in near.items() if not t.strip()) == 4
    # Rows without words come only where another row of their id is drawn.
    assert out["mixing"] and all(r.doc_id is None for r in out["mixing"] if not (r.text or "").strip())
    assert max(Counter(r.doc_id for r in out["mixing"] if r.doc_id == 9).values(), default=0) <= 3
    assert sum(p.length for p in out["packing"] if p.doc_id in (4, 5)) == 2


def test_stages_on_an_empty_table(spark, tables, odd):
    for name, stage in corpus_pipeline.STAGES:
        done = stage(spark, odd.filter("false"), tables[0])
        assert done.count() == 0 and (name == "packing" or done.columns == odd.columns)
