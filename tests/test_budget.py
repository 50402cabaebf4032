"""Chunks by a budget of tokens, against an untouched tokenizer and a plain greedy fold."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from vellum.operators.budget import Budget, Counter, judged, line_windows, pieces, token_chunks

WORDS, BPE = None, public_tokenizers.path("word_bpe_49k.json")


UNTOUCHED = Tokenizer.from_file(BPE)
UNTOUCHED.encode_special_tokens = True


def size(text, vocabulary):
    return len(text.split()) if vocabulary is None else len(UNTOUCHED.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("vocabulary", [WORDS, BPE])
@pytest.mark.parametrize("room", [1, 3, 10])
def test_pieces_are_the_text_and_fit(vocabulary, room):
    tool, rng = Counter(vocabulary), random.Random(room)
    bits = ["Word. ", "a, b; ", "\n\n", "\n", "unbelievably", " ", "ďakujem ", "🙂", "x" * 30, "!? ", "\t"]
    for _ in range(40):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 60)))
        made = pieces(text, room, tool)
        assert "".join(made) == text
        assert all(size(p, vocabulary) <= room or len(p) == 1 for p in made)


def test_pieces_end_at_the_coarsest_separators():
    tool = Counter(WORDS)
    assert pieces("a b c\n\nd e f. g h", 4, tool) == ["a b c\n\n", "d e f. ", "g h"]
    assert pieces("a b\nc d\ne f", 4, tool) == ["a b\nc d\n", "e f"]
    assert pieces("a b c d e f", 4, tool) == ["a b c d ", "e f"]


def greedy(items, most):
    """By words: items in order, one more as long as it fits."""
    out = []
    for path, text in items:
        n = len(text.split())
        if out and out[-1][0] == path and out[-1][2] + n <= most:
            out[-1][1] += "\n" + text
            out[-1][2] += n
        else:
            out.append([path, text, n + len(path.split())])
    return [(p, t, n) for p, t, n in out]


@pytest.mark.parametrize("rows_a_batch", ["3", "10000"])
def test_items_that_fit_are_packed_greedily(spark, rows_a_batch):
    rng = random.Random(7)
    items = {d: [(rng.choice(["A", "A", "B c"]), " ".join(["w"] * rng.randint(1, 6))) for _ in range(50)] for d in range(3)}
    rows = [(d, i, p, t) for d, some in items.items() for i, (p, t) in enumerate(some)] + [(0, 99, "A", None), (5, 0, None, "")]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_a_batch)
    try:
        got = token_chunks(spark.createDataFrame(rows, "doc_id long, pos long, path string, text string"), Budget(12)).orderBy("doc_id", "seq").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for d, some in items.items():
        mine = [r for r in got if r.doc_id == d]
        assert [(r.path, r.text, r.tokens) for r in mine] == greedy(some, 12)
        assert [r.seq for r in mine] == list(range(len(mine))) and mine[0].first_pos == 0 and mine[-1].last_pos == 49
    assert {r.doc_id for r in got} == set(items)


@pytest.mark.parametrize("merge", [True, False])
def test_long_items_under_headings(spark, merge):
    long = "One sentence here. Another one, longer; with parts.\n" * 12 + "x" * 500
    rows = [(1, 0, "Head of it", long), (1, 1, "Head of it", "short"), (1, 2, "h " * 40, "words under long headings"), (2, 0, None, "alone")]
    budget = Budget(20, merge, BPE)
    chunks = token_chunks(spark.createDataFrame(rows, "doc_id long, pos long, path string, text string"), budget)
    got = chunks.orderBy("doc_id", "seq").collect()
    assert all(r.tokens == size(f"{r.path}\n{r.text}" if r.path else r.text, BPE) <= 20 for r in got)
    assert all(r.text_tokens == size(r.text, BPE) for r in got)
    first = [r for r in got if r.doc_id == 1 and r.first_pos <= 1]
    assert "".join(r.text for r in first).replace("\n", "") == (long + "short").replace("\n", "")
    assert [(r.path, r.text) for r in got if r.first_pos == 2] == [("", "words under long headings")]
    facts = {r.doc_id: (r.within, r.tight) for r in judged(chunks, budget).collect()}
    assert all(f[0] for f in facts.values()) and (not merge or facts[1][1])


def test_windows_of_lines(spark):
    text = "\n".join(["a b c", "d e", "f g h i j k l", "m"])
    rows = spark.createDataFrame([(1, text), (2, "x y"), (3, None)], "chunk_id long, text string")
    got = sorted(tuple(r) for r in line_windows(rows, Budget(5), least=2).collect())
    assert got == [(1, 1, "a b c\nd e", 5), (1, 2, "f g h i j k l", 7), (2, 0, "x y", 2), (3, 0, "", 0)]


def test_no_items(spark):
    assert token_chunks(spark.createDataFrame([], "doc_id long, pos long, path string, text string")).count() == 0
