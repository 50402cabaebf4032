import random

import pytest

from vellum.llm import line_dedup as module
from vellum.llm.line_dedup import Near, line_dedup


def distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(q[-1] + 1, p[j] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def test_query_links_short_lines(spark, tmp_path):
    from vellum.llm.queries import op2_line_dedup

    rows = [(1, "Accept all cookies"), (2, "Accept all cookies."), (3, "Accept a cookie"), (4, "abcdefg"), (5, "abcdefh")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_links, r.kept) for r in op2_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: (1, True), 2: (1, False), 3: (0, True), 4: (0, True), 5: (0, True)}


@pytest.mark.parametrize("tile", [1024, 3])
def test_links_of_short_lines_are_those_of_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(module, "TILE", tile)
    rng, near = random.Random(tile), Near(2, 20, ((8, 1),))
    base = ["".join(rng.choice("abé ") for _ in range(n)).replace(" ", "c") for n in (6, 7, 8, 9, 12, 17, 18, 19, 20, 21, 22, 23) * 2]
    lines = set()
    for x in base * 5:
        line = list(x)
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(line) + 1)
            line[k : k + rng.choice([0, 1])] = rng.choice(["", "a", "b"])
        lines.add("".join(line))
    lines = sorted(lines)
    allowed = lambda n: 2 if n >= 20 else 1 if n >= 8 else -1
    want = {x: sum(x != y and distance(x, y) <= allowed(min(len(x), len(y))) for y in lines) for x in lines}
    got = line_dedup(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), near).collect()
    assert {lines[r.doc_id]: r.n_links for r in got} == want
    assert any(want[x] for x in lines if len(x) < 20)
