import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest

from vellum.llm import resampling
from vellum.llm.resampling import Draw, ranked, resample


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, target, draw):
    def buckets(text):
        w = words_of(text)
        return [crc32(" ".join(w[i : i + n]).encode()) % draw.buckets for n in range(1, draw.grams + 1) for i in range(len(w) - n + 1)]

    s, t = Counter(b for _, x in docs for b in buckets(x)), Counter(b for x in target for b in buckets(x))
    big_s, big_t, width = sum(s.values()), sum(t.values()), draw.buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big_s + width) / ((s[b] + 1) * (big_t + width)))) for b in s}
    rows = []
    for doc, text in docs:
        h = int(hashlib.sha256(f"{draw.seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in buckets(text))
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc, len(buckets(text)), weight, score, len(words_of(text)) >= draw.least_words))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    size = draw.percent * len(able) // 100
    drawn = [(*r[:4], k) for k, r in enumerate(able, 1) if k <= size]
    return sorted(drawn + [(*r[:4], None) for r in [*able[size:], *(r for r in rows if not r[4])]], key=repr)


@pytest.mark.parametrize("draw", [Draw(least_words=3, percent=30), Draw(grams=3, buckets=50, least_words=2, percent=55, seed="x")])
def test_draw_is_that_of_brute_force(spark, monkeypatch, draw):
    monkeypatch.setattr(resampling, "SLICE", 200)
    rng = random.Random(draw.grams)
    bag = ["Apple", "pear,", "naïve", "ÄPFEL", "x2", "日本", "--", "a_b", "42", "\x00", "\x7f"]
    docs = [(i, " ".join(rng.choice(bag) for _ in range(rng.randrange(12)))) for i in range(120)]
    docs += [(None, "apple pear apple"), (None, "apple pear apple"), (5, docs[5][1]), (500, None), (501, ""), (502, "word " * 3000), (503, "-- !")]
    target = ["apple pear apple x2", None, "42 42 42"]
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in docs], "doc_id long, text string, weight int, body string")
    got = resample(df, spark.createDataFrame([(t, 1) for t in target], "text string, doc_id long"), draw)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, target, draw)


@pytest.mark.parametrize("percent", [0, 1, 37, 100])
def test_ranks_with_many_ties(spark, percent):
    rng = random.Random(percent)
    rows = [(i, rng.choice([5, 5, 5, 7, -3, 10**12]), i % 7 > 0) for i in range(400)]
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], "doc_id long, score long, eligible boolean, n_features long, weight long")
    able = sorted((r for r in rows if r[2]), key=lambda r: (-r[1], r[0]))
    want = {r[0]: k for k, r in enumerate(able[: percent * len(able) // 100], 1)}
    assert {r["doc_id"]: r["rank"] for r in ranked(df, percent).collect()} == {r[0]: want.get(r[0]) for r in rows}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a " * 30)], "doc_id long, text string")
    assert resample(none, some).count() == 0
    assert [r["rank"] for r in resample(some, none, Draw(percent=100)).collect()] == [1]
