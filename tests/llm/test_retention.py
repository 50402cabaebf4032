import math
import random
from datetime import datetime, timedelta
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from vellum.llm import retention
from vellum.llm.retention import Calendar, retention_matrix

CUT = datetime(2024, 2, 15)
CLICKS = "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double, period string"


def brute(rows, segments, cohort_days, length):
    rows = [r for r in dict.fromkeys(rows) if r[1] is not None and r[3] is not None]
    states = [[r for r in rows if r[2] is not None and r[2] < CUT], rows]
    starts = []
    for known in states:
        mine = {}
        for r in known:
            if r[4] == "signup":
                mine[r[3]] = min(r[1], mine.get(r[3], r[1]))
        starts.append(mine)
    cohort = [{c: math.floor((t - datetime(1970, 1, 1)).days / cohort_days) for c, t in s.items()} for s in starts]
    cells = {}
    for s, known in enumerate(states):
        for r in known:
            who = r[3]
            if who in starts[s] and r[1] >= starts[s][who]:
                cell = (s, segments.get(who) or "", cohort[s][who], (r[1] - starts[s][who]) // length)
                cells.setdefault(cell, {}).setdefault(who, []).append(math.floor(100 * (r[5] or 0) + 0.5))
    out = set()
    for cell, users in cells.items():
        moved = sum(len({c[w] for c in cohort if w in c}) > 1 for w in users)
        out.add((*cell, len(users), sum(crc32(str(w).encode()) for w in users), moved, sum(map(sum, users.values()))))
    return out


def clicks(rng, n, clients):
    rows = []
    for i in range(n):
        ts = datetime(2024, 1, 20) + timedelta(microseconds=rng.randrange(40 * 86_400_000_000))
        who = 7 if rng.random() < 0.4 else rng.randrange(clients)
        late = ts + timedelta(days=rng.choice([0, 0, 3, 30]))
        rows.append((i, ts, late, who, rng.choice(["signup", "view", "click", None]), rng.choice([None, -1.005, 0.0, 12.345, 80.5]), "x"))
    rows += [(900, None, CUT, 1, "signup", 1.0, "x"), (901, CUT, None, 2, "signup", 1.0, "x"), (902, CUT, CUT, None, "signup", 1.0, "x")]
    # Ties, a start exactly one period before another click, and repeated rows.
    rows += [(910, CUT, CUT, 60, "signup", 1.0, "x"), (911, CUT, CUT, 60, "view", 2.0, "x")]
    rows += [(912, CUT + timedelta(days=1) - timedelta(microseconds=k), CUT, 60, "view", 2.0, "x") for k in (0, 1)]
    return rows + rows[:20] + rows[-2:]


def matrix(spark, rows, people, calendar=Calendar()):
    return retention_matrix(
        spark.createDataFrame(rows, CLICKS),
        spark.createDataFrame(people, "client_id long, segment string, ts string, period int"),
        known=(F.col("arrived_at") < F.lit(CUT).cast("timestamp_ntz"), F.lit(True)),
        starts=F.col("kind") == "signup",
        amount=F.floor(100 * F.col("value") + 0.5),
        calendar=calendar,
    )


def test_cells_are_those_of_brute_force(spark, monkeypatch):
    # A hot client is dealt among salts; batches of a few rows cut clients and periods.
    monkeypatch.setattr(retention, "hot_of", lambda counts, key, total: real(counts, key, total, least=40))
    from vellum.llm.shared import hot_of as real

    rng = random.Random(5)
    rows = clicks(rng, 700, 40)
    people = [(c, rng.choice(["retail", "online", None]), "y", 3) for c in range(0, 40, 2)] + [(None, "lost", "y", 3)]
    calendar = Calendar(cohort_days=2, period=timedelta(hours=36))
    got = matrix(spark, rows, people, calendar)
    assert got.columns == ["state", "segment", "cohort", "period", "users", "users_crc32", "moved", "cents"]
    for batch in ("7", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            assert {tuple(r) for r in got.collect()} == brute(rows, {c: s for c, s, *_ in people}, 2, timedelta(hours=36))
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_hot_client_is_one_user_of_a_cell(spark, monkeypatch):
    from vellum.llm.shared import hot_of as real

    seen = []

    def spied(counts, key, total):
        seen.append(real(counts, key, total, least=10))
        return seen[-1]

    monkeypatch.setattr(retention, "hot_of", spied)
    rows = [(i, CUT + timedelta(seconds=i), CUT, 7, "signup" if i == 0 else "view", 0.01, "x") for i in range(500)]
    assert [tuple(r) for r in matrix(spark, rows, []).select("state", "period", "users", "cents").collect()] == [(1, 0, 1, 500)]
    assert seen[0].count() == 1 and seen[0].first()["__salts"] == 50


@pytest.mark.parametrize("rows", [[], [(1, CUT, CUT, 1, "view", 1.0, "x")]])
def test_without_a_start_there_are_no_cells(spark, rows):
    assert matrix(spark, rows, []).count() == 0
