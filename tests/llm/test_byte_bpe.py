import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from vellum.llm.byte_bpe import Chunks, Vocabulary, codec, cuts, decode, encode, public_vocabulary, stitch

SMALL = Chunks(size=40, overlap=12)


@pytest.fixture(scope="module")
def untouched():
    lines = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("untouched", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(seed, n):
    rng = random.Random(seed)
    parts = ["don't", "I'll", "x's", "'", "'r", "'re", "  ", " ", "\n", "\t\n ", "\r\n", "naïve", "日本語テキスト", "🙂🙃", " ", "123", "4,567.89", "<|endoftext|>", "--", "!!", "a" * 50, " " * 60, "ſ", " ", "é", "Z"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_ids_are_those_of_an_untouched_encoder_and_bytes_come_back(spark, untouched):
    texts = [*odd_texts(1, 150), None, "", " ", "a", "a" * 5000, " " * 5000 + "b", "word " * 2000, "\n" * 300, "x\n\n\ny" * 200]
    rows = [(i // 2 if i % 5 else None, t, "z", b"q") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, bytes binary")
    vocabulary = public_vocabulary()
    for chunks in (SMALL, Chunks(size=5, overlap=1), Chunks()):
        got = decode(encode(docs, vocabulary, chunks), vocabulary).collect()
        want = []
        for doc, text, *_ in rows:
            ids = untouched.encode_ordinary(text or "")
            want.append((str(doc), len(ids), np.array(ids, "<u4").tobytes(), (text or "").encode()))
        assert sorted((str(r.doc_id), r.n_tokens, bytes(r.ids), bytes(r.bytes)) for r in got) == sorted(want)


def test_long_runs_of_white_space_beyond_the_encoders_stack(spark, untouched):
    text = "a" + " " * 1_000_000 + "b"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    vocabulary = public_vocabulary()
    row = decode(encode(docs, vocabulary), vocabulary).first()
    assert bytes(row.bytes) == text.encode()
    pieces = ["a", " " * 999_999, " b"]
    assert np.frombuffer(bytes(row.ids), "<u4").tolist() == [i for p in pieces for i in untouched._encode_single_piece(p)]


def test_stitches_are_boundaries_of_the_whole_scan():
    tool = codec(public_vocabulary())
    stitched = 0
    for text in odd_texts(2, 300):
        whole, begin = {0, len(text), *tool.bounds(text, 0)}, 0
        parts = list(cuts(text, SMALL))
        assert [p[0] for p in parts[1:]] == [p[1] for p in parts[:-1]] and parts[-1][1] == len(text)
        for a, core, shown in parts[:-1]:
            end = a + stitch(text[a:shown], core - a, tool, SMALL.margin)
            assert end in whole and begin < end and core <= end <= shown
            stitched, begin = stitched + 1, end
    assert stitched > 300


def test_scans_that_never_meet_are_an_error(tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(bytes([b])) + b" %d\n" % b for b in range(256)))
    tool = codec(Vocabulary(str(path), r"(?s)..|."))
    with pytest.raises(ValueError, match="don't meet"):
        stitch("ab" * 40 + "c", 41, tool, 8)


def test_unknown_ids_and_null_ids(spark):
    vocabulary = public_vocabulary()
    null = spark.createDataFrame([(1, None), (2, b"")], "doc_id long, ids binary")
    assert [r.bytes for r in decode(null, vocabulary).orderBy("doc_id").collect()] == [None, b""]
    unknown = spark.createDataFrame([(1, np.array([60000], "<u4").tobytes())], "doc_id long, ids binary")
    with pytest.raises(Exception, match="."):
        decode(unknown, vocabulary).collect()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert decode(encode(docs, public_vocabulary()), public_vocabulary()).count() == 0
