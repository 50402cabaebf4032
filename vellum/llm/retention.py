"""Cohort retention by a secondary sort: no set of clients is ever held.

Events are dealt by client and sorted by time behind the client's *sheet*, a row with its
starts and its segment. One pass over a sorted partition then knows a client's period from
the sheet, and gives a row each time the period changes: that row is one user of one cell,
so users are counted by counting rows.

A client with many rows is dealt among salts, each with a copy of the sheet. Its rows of one
cell may then come from several salts; they are brought together before they count.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import timedelta

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.shared import hot_of, salted, tidy, written


@dataclass(frozen=True)
class Calendar:
    """``cohort_days``: days of a cohort, counted from 1970. ``period``: the length of a period after the start."""

    cohort_days: int = 1
    period: timedelta = timedelta(days=1)


def retention_matrix(
    events: DataFrame,
    clients: DataFrame,
    *,
    known: Sequence[Column],
    starts: Column,
    amount: Column,
    calendar: Calendar = Calendar(),
    client_column: str = "client_id",
    time_column: str = "ts",
    segment_column: str = "segment",
) -> DataFrame:
    """A row for each cell with a user: state, segment, cohort, period, users, users_crc32, moved, cents.

    ``known`` has a condition over ``events`` for each state: which rows that state knows.
    ``starts`` marks the rows that can start a client, ``amount`` (whole number) is summed up
    as cents. In each state a client starts at its earliest known starting row; all known rows
    from then on, the starting one too, lie in the period of their time since. Clients without a start have no
    rows in that state. ``moved`` counts users whose starts lie in different cohorts in two states.

    Equal rows of ``events``, in all of their columns, count once. Rows without a time or a
    client are dropped. A null condition is false, a null amount 0. Rows of equal time are all
    counted. Clients that ``clients`` lacks, or whose segment is null, have the segment ''; of a client's
    several rows the smallest segment counts. Other columns, of whatever names, matter only to
    whether rows are equal. Empty tables give no rows.
    """
    client, time = F.col(f"`{client_column}`"), F.col(f"`{time_column}`")
    once = events.filter(time.isNotNull() & client.isNotNull()).dropDuplicates()
    mask = sum(F.when(F.coalesce(k, F.lit(False)), 1 << s).otherwise(0) for s, k in enumerate(known)).cast("int")
    facts = once.select(
        client.alias("who"), time.alias("at"), mask.alias("mask"), F.coalesce(starts, F.lit(False)).alias("starting"),
        F.coalesce(amount, F.lit(0)).cast("long").alias("cents"), F.xxhash64(*[F.col(f"`{c}`") for c in events.columns]).alias("by"),
    )
    facts = written(facts.filter("mask > 0"), "clicks")
    sheets = _sheets(facts, clients, len(known), calendar, client_column, segment_column)
    total = sheets.agg(F.sum("rows")).first()[0] or 0
    hot = written(hot_of(sheets, "who", total), "hot")
    runs = _scan(facts, sheets, hot, len(known), calendar.period)
    # A salted client's runs of a cell meet first; whoever isn't salted has one run a cell.
    cell = ["state", "segment", "cohort", "period"]
    mark = F.crc32(F.col("who").cast("string"))
    owner = F.when(F.col("shared"), F.col("who"))
    met = runs.groupBy(*cell, owner.alias("owner")).agg(
        F.count("*").alias("n"), F.sum(mark).alias("marks"), F.max(mark).alias("mark"),
        F.sum("moved").alias("moves"), F.max("moved").alias("moved"), F.sum("cents").alias("cents"),
    )
    one = F.col("owner").isNotNull()
    return met.groupBy(*cell).agg(
        F.sum(F.when(one, 1).otherwise(F.col("n"))).cast("long").alias("users"),
        F.sum(F.when(one, F.col("mark")).otherwise(F.col("marks"))).cast("long").alias("users_crc32"),
        F.sum(F.when(one, F.col("moved")).otherwise(F.col("moves"))).cast("long").alias("moved"),
        F.sum("cents").cast("long").alias("cents"),
    )


def _sheets(
    facts: DataFrame, clients: DataFrame, states: int, calendar: Calendar, client_column: str, segment_column: str
) -> DataFrame:
    """who, rows, start_<s>, cohort_<s>, segment, moved: a row for each client of ``facts``."""
    known = [F.col("mask").bitwiseAND(F.lit(1 << s)) > 0 for s in range(states)]
    firsts = [F.min(F.when(k & F.col("starting"), F.col("at"))).alias(f"start_{s}") for s, k in enumerate(known)]
    found = facts.groupBy("who").agg(F.count("*").alias("rows"), *firsts)
    for s in range(states):
        day = F.unix_date(F.to_date(f"start_{s}"))
        found = found.withColumn(f"cohort_{s}", F.floor(day / calendar.cohort_days).cast("long"))
    # Nulls are passed over, so only cohorts of starts are compared.
    cohorts = [F.col(f"cohort_{s}") for s in range(states)]
    moved = F.size(F.array_distinct(F.array_compact(F.array(*cohorts)))) > 1
    who, segment = F.col(f"`{client_column}`"), F.col(f"`{segment_column}`")
    named = clients.select(who.alias("who"), segment.cast("string").alias("segment")).groupBy("who").agg(F.min("segment").alias("segment"))
    found = found.withColumn("moved", moved.cast("int")).join(named, "who", "left")
    return written(found.withColumn("segment", F.coalesce("segment", F.lit(""))), "sheets")


def _scan(facts: DataFrame, sheets: DataFrame, hot: DataFrame, states: int, period: timedelta) -> DataFrame:
    """who, shared, segment, moved, state, cohort, period, cents: a row for each client (and salt), state and period."""
    about = ["segment", "moved", *(f"{x}_{s}" for s in range(states) for x in ("start", "cohort"))]
    each = salted(facts, hot, "who", "by").select("who", F.col("__salt").alias("salt"), F.lit(False).alias("sheet"), "at", "mask", "cents")
    pages = sheets.join(F.broadcast(hot), F.col("who") == F.col("__hot"), "left")
    salts = F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1))
    pages = pages.select("who", salts.alias("salt"), F.lit(True).alias("sheet"), F.col("__hot").isNotNull().alias("shared"), *about)
    dealt = each.unionByName(pages, allowMissingColumns=True).repartition("who", "salt")
    dealt = dealt.sortWithinPartitions("who", "salt", F.col("sheet").desc(), "at")
    dealt = dealt.select("who", "shared", "sheet", "at", "mask", "cents", *about)
    length = period // timedelta(microseconds=1)
    out = ["who", "shared", "segment", "moved"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the sheet of the client in progress
        # Each state's run in progress: the client's period and its sum so far.
        going: list[tuple[int, int] | None] = [None] * states

        def rows(sheets: pa.RecordBatch, s: int, of: np.ndarray, number: np.ndarray, cents: np.ndarray) -> pa.RecordBatch:
            some = sheets.take(pa.array(of, pa.int64()))
            return pa.RecordBatch.from_arrays(
                [*(some.column(c) for c in out), pa.array(np.full(len(of), s, np.int32)), some.column(f"cohort_{s}"),
                 pa.array(number, pa.int64()), pa.array(cents, pa.int64())],
                [*out, "state", "cohort", "period", "cents"],
            )

        for batch in batches:
            if held is not None:
                batch = pa.concat_batches([held, batch])
            is_sheet = batch.column("sheet").to_numpy(zero_copy_only=False)
            pages = batch.take(pa.array(np.flatnonzero(is_sheet)))
            of = np.cumsum(is_sheet) - 1
            at = _micros(batch.column("at"))
            mask = batch.column("mask").fill_null(0).to_numpy(zero_copy_only=False)
            cents = batch.column("cents").fill_null(0).to_numpy(zero_copy_only=False)
            for s in range(states):
                start, lacks = _micros(pages.column(f"start_{s}")), pages.column(f"start_{s}").is_null().to_numpy(zero_copy_only=False)
                mine = np.flatnonzero((mask & (1 << s) > 0) & ~lacks[of] & (at >= start[of]))
                sheet, number = of[mine], (at[mine] - start[of[mine]]) // length
                new = np.flatnonzero((np.diff(sheet, prepend=-1) != 0) | (np.diff(number, prepend=-1) != 0))
                total = np.add.reduceat(cents[mine], new) if len(new) else np.zeros(0, np.int64)
                sheet, number = sheet[new], number[new]
                if going[s] is not None:
                    if len(sheet) and sheet[0] == 0 and number[0] == going[s][0]:
                        total[0] += going[s][1]
                    else:
                        sheet, number, total = (np.concatenate(([x], y)) for x, y in zip((0, *going[s]), (sheet, number, total), strict=True))
                going[s] = None
                if len(sheet) and sheet[-1] == pages.num_rows - 1:
                    going[s] = int(number[-1]), int(total[-1])
                    sheet, number, total = sheet[:-1], number[:-1], total[:-1]
                yield rows(pages, s, sheet, number, total)
            held = pages.slice(pages.num_rows - 1)
        for s, last in enumerate(going):
            if last is not None:
                yield rows(held, s, np.zeros(1, np.int64), np.array(last[:1]), np.array(last[1:]))

    who = facts.schema["who"].dataType.simpleString()
    kinds = f"who {who}, shared boolean, segment string, moved int, state int, cohort long, period long, cents long"
    return dealt.mapInArrow(tidy(run), kinds)


def _micros(times: pa.Array) -> np.ndarray:
    """Microseconds of a column of timestamps, with or without a zone; 0 for null."""
    return pc.fill_null(times.cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
