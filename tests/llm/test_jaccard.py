import random
import re

import numpy as np
import pytest

from vellum.llm.components import components
from vellum.llm.jaccard import Alike, JaccardJoin, keys, shingle_sets, without_near_copies
from vellum.llm.tiles import packed, unpacked

pa = pytest.importorskip("pyarrow")


def brute_sets(texts, words):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        s = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} - {()}
        out.append(s)
    return out


def brute(ids, texts, words, percent):
    sets, parent = brute_sets(texts, words), {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(ids[i]), root(ids[j])))
                parent[y] = x
    return {i: (len(s), root(i)) for i, s in zip(ids, sets)}


def corpus(seed, n=160):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    texts = ["", None, " \t\n", "One", "one", "A b", "a  B\n", "a b c", "A\x0bb c", "x " * 50]
    while len(texts) < n:
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 11, 12, 20, 40, 90, 200]))]
        if rng.random() < 0.3:
            base[len(base) // 2 : len(base) // 2] = passage
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
                k = rng.randrange(len(copy))
                copy[k : k + 1] = rng.choice([[], [rng.choice(vocabulary)], ["new", copy[k]]])
            texts.append(" ".join(copy))
    return texts[:n]


@pytest.mark.parametrize("words,percent", [(3, 90), (5, 80)])
def test_groups_are_those_of_brute_force(spark, words, percent):
    texts = corpus(words)
    ids = list(range(3, 3 + len(texts)))
    df = spark.createDataFrame([(i, t, "x") for i, t in zip(ids, texts)], "doc_id long, text string, n string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in JaccardJoin(df, Alike(words, percent)).groups().collect()}
    assert got == brute(ids, texts, words, percent)


@pytest.mark.parametrize("percent", [80, 90])
def test_alike_sets_share_a_key(percent):
    rng, alike = random.Random(percent), Alike(1, percent)
    for _ in range(1500):
        n = rng.choice([1, 2, 5, 9, 10, 11, 19, 30, 100])
        base = [f"t{rng.randrange(10**9)}" for _ in range(n)]
        other = base[rng.randrange(0, 1 + n // 8) :] + [f"t{rng.randrange(10**9)}" for _ in range(rng.randrange(0, 1 + n // 8))]
        (a, _), (b, _) = shingle_sets(pa.array([" ".join(base), " ".join(other)]), 1)
        x, y = set(base), set(other)
        if 100 * len(x & y) >= percent * len(x | y):
            assert set(keys(a, alike).tolist()) & set(keys(b, alike).tolist())


def test_null_and_repeated_ids(spark):
    text = "one two three four five six seven"
    rows = [(7, text), (7, text), (None, text), (3, text + " eight"), (4, ""), (None, None)]
    got = JaccardJoin(spark.createDataFrame(rows, "doc_id long, text string"), Alike(5, 80)).groups().collect()
    found = sorted((r.n_shingles, str(r.doc_id), str(r.component_id)) for r in got)
    assert found == [(0, "4", "4"), (0, "None", "None"), (3, "7", "7"), (3, "7", "7"), (3, "None", "7"), (4, "3", "3")]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert JaccardJoin(df).groups().count() == 0


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(40)] + [(60, 50), (50, 60), (70, 70), (61, 60)]
    got = {r.id: r.component_id for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 50: 50, 60: 50, 61: 50}


def cloud(seed, n, words=120):
    """A text and copies of it with a tenth of its words changed, more or less: many only just alike, or just not."""
    rng = random.Random(seed)
    base = [f"v{rng.randrange(10**6)}" for _ in range(words)]
    texts = []
    for _ in range(n):
        copy = list(base)
        for k in rng.sample(range(words), rng.choice([0, 1, 2, 3, 4, 5, 6, 7])):
            copy[k] = f"n{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("tile", [2048, 8])
def test_clouds_around_a_text(spark, tile, monkeypatch):
    import vellum.llm.jaccard as module

    # Small tiles: their parts meet in several blocks.
    monkeypatch.setattr(module, "TILE", tile)
    monkeypatch.setattr(module, "WEIGHT", tile * 128)
    texts = cloud(1, 70) + cloud(2, 40, 60) + cloud(3, 30, 25)
    random.Random(4).shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in JaccardJoin(df, Alike(3, 80)).groups().collect()}
    assert got == brute(list(range(len(texts))), texts, 3, 80)


def test_packed_columns_come_back():
    rng = np.random.default_rng(1)
    columns = [rng.integers(-5, 5, 300), rng.integers(-(2**62), 2**62, 300), np.full(300, 2**40), np.arange(300)]
    assert all((a == b).all() for a, b in zip(unpacked(packed(*columns), 4), columns, strict=True))
    assert [x.tolist() for x in unpacked(packed(np.array([7])), 1)] == [[7]]


def test_very_long_texts_and_clashing_names(spark):
    rng = random.Random(9)
    long = [f"w{rng.randrange(50_000)}" for _ in range(200_000)]
    near = [*long[:100_000], "another", *long[100_000:]]
    rows = [(1, " ".join(long)), (2, " ".join(near)), (3, " ".join(long[:1000])), (4, None), (5, "x " * 70_000), (6, "x")]
    names = ("gone_id", "__hot", "__salt", "digest", "key", "id", "n", "component_id", "body", "doc")
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[spark_lit(i).alias(c) for i, c in enumerate(names)])
    out = without_near_copies(df, Alike(5, 80))
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 3, 4, 5, 6]


def spark_lit(value):
    from pyspark.sql import functions as F

    return F.lit(value)
