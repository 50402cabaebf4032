import hashlib
import random

import pytest

from vellum.llm import line_dedup as module
from vellum.llm.line_dedup import Near, line_dedup, tile_keys, within


def distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(q[-1] + 1, p[j] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def changed(rng, line, edits, letters="abé"):
    line = list(line)
    for _ in range(edits):
        k = rng.randrange(len(line) + 1)
        line[k : k + rng.choice([0, 1])] = rng.choice(["", rng.choice(letters)])
    return "".join(line)


@pytest.mark.parametrize("edits", [1, 2, 4])
def test_banded_distance(edits):
    rng = random.Random(edits)
    a = ["".join(rng.choice("abé") for _ in range(rng.randrange(30))) for _ in range(800)]
    b = [changed(rng, x, rng.randrange(edits + 3)) for x in a]
    assert within(a, b, edits).tolist() == [distance(x, y) <= edits for x, y in zip(a, b)]


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_near_lines_share_a_key(edits):
    rng, near = random.Random(edits), Near(edits, 8)
    for _ in range(1500):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(8, 24)))
        b = changed(rng, a, edits, "ab")
        if len(b) >= 8 and distance(a, b) <= edits:
            (x, m), (y, n) = tile_keys([a], near), tile_keys([b], near)
            offered = [(set(k[v % 2 == 1].tolist()), set(k.tolist())) for k, v in ((x, m), (y, n))]
            assert offered[0][0] & offered[1][1] or offered[0][1] & offered[1][0]


def brute(rows, near):
    lines = [(d, k, x) for d, t in rows for k, y in enumerate((t or "").split("\n")) if (x := y.strip(" \t\x0b\x0c\r"))]
    ident = lambda x: hashlib.md5(x.encode()).hexdigest()
    texts = sorted({x for _, _, x in lines}, key=ident)
    linked = {x: [] for x in texts}
    for i, x in enumerate(texts):
        for y in texts[:i]:
            if min(len(x), len(y)) >= near.least and abs(len(x) - len(y)) <= near.edits and distance(x, y) <= near.edits:
                linked[x].append(y)
                linked[y].append(x)
    group = {}
    for x in texts:
        todo = [x] if x not in group else []
        while todo:
            y = todo.pop()
            if y not in group:
                group[y] = ident(x)
                todo += linked[y]
    out, seen = set(), set()
    for d, k, x in sorted(lines, key=lambda r: (r[0], r[1])):
        copies = sum(1 for z in lines if z[2] == x)
        out.add((d, k, ident(x), group[x], len(linked[x]), copies, group[x] not in seen))
        seen.add(group[x])
    return out


@pytest.mark.parametrize("tile", [1024, 3])
def test_lines_are_those_of_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(module, "TILE", tile)
    rng, rows = random.Random(tile), [(1, None), (2, ""), (3, " \n\n\t")]
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.choice([3, 10, 20, 33, 60]))) for _ in range(30)]
    for d in range(4, 40):
        some = [changed(rng, rng.choice(base), rng.choice([0, 0, 1, 1, 2, 3])) for _ in range(rng.randrange(1, 6))]
        rows.append((d, "\n".join(some)))
    near = Near(2, 10)
    got = line_dedup(spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, line int"), near).collect()
    assert {tuple(r) for r in got} == brute(rows, near)
    assert len(got) == len({tuple(r)[:2] for r in got})


def test_null_ids_and_empty_table(spark):
    rows = [(None, "x" * 30), (5, "x" * 30), (5, "x" * 29 + "y"), (5, "short")]
    got = line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_links, r.kept) for r in got) == [(0, 1, False), (5, 0, True), (5, 1, False), (5, 1, True)]
    assert line_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
