import random

import numpy as np
import pytest

from vellum.llm import suffix_dedup as module
from vellum.llm.bwt import merged
from vellum.llm.suffix_dedup import suffix_dedup


def brute(docs, length):
    first, gone = {}, {}
    for doc, text in sorted(docs, key=lambda x: x[0]):
        raw = (text or "").encode()
        marks = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            s = raw[i : i + length]
            if s in first:
                marks[i : i + length] = b"\1" * length
            else:
                first[s] = (doc, i)
        kept = bytes(b for b, m in zip(raw, marks) if not m)
        runs = sum(1 for i, m in enumerate(marks) if m and (i == 0 or not marks[i - 1]))
        gone[doc] = (len(raw), sum(marks), runs, kept)
    return gone


def corpus(seed):
    rng = random.Random(seed)
    prose = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    passage, line = prose(300), prose(99)
    docs = ["", None, "short", "a" * 500, "ab" * 200, "xyz" * 150, "a" * 500, line, line + "x", "x" + line]
    for _ in range(60):
        t = prose(rng.choice([10, 120, 400, 900]))
        for _ in range(rng.choice([0, 1, 2])):
            k = rng.randrange(len(t))
            a = rng.randrange(len(passage) - 130)
            t = t[:k] + passage[a : a + rng.choice([90, 110, 130, 300])] + t[k:]
        docs.append(t)
        if rng.random() < 0.3:
            k = rng.randrange(len(t))
            docs.append(t[:k] + "!" + t[k + 1 :])
        if rng.random() < 0.2:
            docs.append(t)
    rng.shuffle(docs)
    return list(enumerate(docs, 5))


@pytest.mark.parametrize("seed,hot", [(1, 4096), (2, 2)])
def test_removes_what_brute_force_removes(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(module, "MOST", hot)
    docs = corpus(seed)
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, body string")
    rows = suffix_dedup(df).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows} == brute(docs, 100)


def test_shared_cores_without_a_repeat(spark):
    core = "".join(random.Random(9).choice("abcdefgh") for _ in range(90))
    docs = [(i, chr(65 + i) * 60 + core + chr(75 + i) * 60) for i in range(8)]
    rows = suffix_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows} == brute(docs, 100)
    assert not any(r.n_removed for r in rows)


@pytest.mark.parametrize("most,length", [(3, 100), (3, 50), (4096, 400)])
def test_a_line_that_many_texts_share(spark, monkeypatch, most, length):
    monkeypatch.setattr(module, "MOST", most)
    rng = random.Random(length)
    line = "".join(rng.choice("abcdefgh ") for _ in range(length - 8))
    around = ["".join(rng.choice("xy") for _ in range(40)) for _ in range(3)]
    docs = []
    for i in range(40):
        before, after = rng.choice(around)[-rng.randrange(1, 40) :], rng.choice(around)[: rng.randrange(40)]
        docs.append((i, f"{i * 7919}{before}{line}{after}{i * 104729}" * rng.choice([1, 1, 3])))
    rows = suffix_dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), length=length).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows} == brute(docs, length)


def test_parts_of_a_long_text_hold_each_window_once(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(module, "CHUNK", 700)
    texts = [b"x" * 2000, None, b"", b"abc", bytes(range(256)) * 5]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(texts, pa.binary())], ["doc", "body"])
    starts = {k: [] for k in range(5)}
    for rows, data, bounds, begins in module._chunks(batch, 100):
        assert len(data) == bounds[-1]
        for row, begin, size in zip(rows, begins, np.diff(bounds, prepend=0).tolist()):
            starts[row] += range(begin, begin + size - 99)
    assert {k: sorted(v) for k, v in starts.items()} == {k: list(range(len(t or b"") - 99)) for k, t in enumerate(texts)}


def test_very_long_texts(spark):
    rng = random.Random(7)
    long = "".join(rng.choice("abcdefghij ") for _ in range(60_000))
    docs = [(1, long), (2, long[1000:21_000] + "!" + long[30_000:31_000]), (3, "k" + long[59_000:]), (4, "z" * 20_000)]
    rows = suffix_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows} == brute(docs, 100)


def test_lengths_that_are_not_supported(spark):
    for length in (20, 49, 10_001):
        with pytest.raises(ValueError):
            suffix_dedup(spark.createDataFrame([(1, "x")], "doc_id long, text string"), length=length)


def test_null_and_repeated_ids(spark):
    texts = [(1, "q" * 150), (None, "q" * 120), (1, "q" * 150), (2, None), (None, "")]
    rows = suffix_dedup(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed) for r in rows)
    assert got == [(False, 1, 150, 149), (False, 1, 150, 150), (False, 2, 0, 0), (True, 0, 0, 0), (True, 0, 120, 120)]


def test_empty_table(spark):
    assert suffix_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_merged_intervals_are_equal_strings():
    rng = random.Random(3)
    texts = [bytes(rng.choice(b"ab\0") for _ in range(rng.randrange(1, 40))) for _ in range(60)]
    order, interval = merged(texts, 6, shard_bytes=64)
    joined = b"".join(t + b"\xff" for t in texts)
    ends = np.cumsum([len(t) + 1 for t in texts])
    seen = {}
    for place, group in zip(order.tolist(), interval.tolist()):
        end = ends[np.searchsorted(ends, place, side="right")] - 1
        if place + 6 <= end:
            seen.setdefault(group, set()).add(joined[place : place + 6])
    assert all(len(s) == 1 for s in seen.values())
    assert len({next(iter(s)) for s in seen.values()}) == len(seen)
    assert sorted(order.tolist()) == list(range(len(joined)))
