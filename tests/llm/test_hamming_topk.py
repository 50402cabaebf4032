import random

import pytest

from vellum.llm.hamming_topk import top_k


def brute(rows, queries, k):
    codes = [(i, [x is not None and x > 0 for x in v]) for i, v in rows if i is not None and v is not None]
    out = set()
    for q in queries:
        for own in [c for i, c in codes if i == q]:
            near = sorted((sum(a != b for a, b in zip(own, c)), i) for i, c in codes)[:k]
            out |= {(q, r, i, d) for r, (d, i) in enumerate(near, 1)}
    return out


@pytest.mark.parametrize("dims,segments,k", [(16, None, 5), (24, 4, 3), (10, 3, 40)])
def test_neighbours_are_those_of_brute_force(spark, dims, segments, k):
    rng = random.Random(dims)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(dims)]) for i in range(60)]
    rows += [(100 + i, list(rows[0][1])) for i in range(20)] + [(200, None), (None, rows[1][1]), (201, [None] * dims)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, code string")
    asked = spark.createDataFrame([(q,) for q in (0, 3, 100, 200, 201, 999, None)], "vec_id long")
    got = top_k(df, asked, k=k, segments=segments).collect()
    assert {tuple(r) for r in got} == brute(rows, [0, 3, 100, 201], k)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k(df, df.select("vec_id")).count() == 0


def test_only_probed_values_are_compared(spark, monkeypatch):
    from vellum.llm import hamming_topk

    # 40 clusters of codes a few bits apart: radius 0 and 1 find all neighbours.
    rng = random.Random(9)
    rows = []
    for c in range(40):
        centre = [rng.choice((-1.0, 1.0)) for _ in range(48)]
        for i in range(25):
            near = list(centre)
            near[rng.randrange(48)] *= -1
            rows.append((100 * c + i, near))
    compared = []
    real = hamming_topk.probed

    def counted(*args):
        found = real(*args)
        compared.append(found.count())
        return found

    monkeypatch.setattr(hamming_topk, "probed", counted)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asked = [100 * c for c in range(40)]
    got = top_k(df, df.filter("vec_id % 100 = 0").select("vec_id"), k=10, segments=4).collect()
    assert {tuple(r) for r in got} == brute(rows, asked, 10)
    assert 0 < sum(compared) < len(asked) * len(rows) / 5


def test_a_value_that_many_codes_share_is_dealt_among_salts(spark, monkeypatch):
    from vellum.llm import hamming_topk
    from vellum.llm.shared import hot_of

    seen = []

    def small(counts, key, total):
        seen.append(hot_of(counts, key, total, least=8))
        return seen[-1]

    monkeypatch.setattr(hamming_topk, "hot_of", small)
    rng = random.Random(4)
    rows = [(i, [1.0] * 10 + [rng.choice((-1.0, 1.0)) for _ in range(10)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = top_k(df, df.filter("vec_id < 5").select("vec_id"), k=7, segments=2).collect()
    assert {tuple(r) for r in got} == brute(rows, range(5), 7)
    assert seen[0].agg({"__salts": "max"}).first()[0] > 10
