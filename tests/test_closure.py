from random import Random

import pytest

from vellum.operators import closure

CHUNKS, PARAGRAPHS, REGISTER = "doc_id long, chunk_id string, content string", "doc_id long, target string, pos long, text string", "law string, doc_id long"


def resolved(spark, chunks, paragraphs, register, depth):
    frames = [spark.createDataFrame(rows, schema) for rows, schema in ((chunks, CHUNKS), (paragraphs, PARAGRAPHS), (register, REGISTER))]
    made = closure.with_references(*frames, depth).collect()
    assert len(made) == len(chunks)
    return {(r.doc_id, r.chunk_id): [tuple(x) for x in r.references] for r in made}


def test_texts_of_own_and_other_laws_are_in_the_chunk(spark):
    paragraphs = [
        (1, "1", 0, "podľa § 2 a § 7 zákona č. 595/2003 Z. z."), (1, "2", 1, "kruh § 1, § 9 a § 2 č. 1/1993"), (1, "9", 2, "starý § 1"),
        (1, "9", 5, "nový"), (2, "7", 0, "ďalej § 8 zákona  č. 595/2003 a § 8"), (2, "8", 0, None), (3, "1", 0, "§ 1"),
    ]
    chunks = [(d, f"paragraf-{t}", text) for d, t, pos, text in paragraphs if (d, t, pos) != (1, "9", 2)]
    chunks += [(1, "odsek-1.3", "§ 1 a § 2"), (None, "odsek-1.1", "§ 2"), (4, None, "§ 1"), (4, "odsek-2.1", "")]
    register = [("595/2003", 2), ("595/2003", 3), (None, 1)]
    one = resolved(spark, chunks, paragraphs, register, 1)
    assert one[1, "paragraf-1"] == [(1, 1, None, "2", paragraphs[1][3]), (1, 2, None, "7", paragraphs[4][3])]
    assert one[1, "odsek-1.3"] == [(1, 1, None, "2", paragraphs[1][3])]
    assert one[1, "paragraf-2"] == [(1, None, "1/1993", "2", None), (1, 1, None, "1", paragraphs[0][3]), (1, 1, None, "9", "nový")]
    assert one[2, "paragraf-7"] == [(1, 2, None, "8", None)] and one[3, "paragraf-1"] == one[2, "paragraf-8"] == one[4, "odsek-2.1"] == []
    three = resolved(spark, chunks, paragraphs, register, 3)
    assert [x[:4] for x in three[1, "paragraf-1"]] == [(1, 1, None, "2"), (1, 2, None, "7"), (2, None, "1/1993", "2"), (2, 1, None, "9"), (2, 2, None, "8")]
    assert resolved(spark, [], [], [], 2) == {}


@pytest.mark.parametrize("depth", [1, 2, 5])
def test_random_laws_are_walked_as_by_hand(spark, depth):
    rng = Random(depth)
    laws, names = range(1, 6), {f"{d}/2000": d for d in range(1, 5)}
    mention = lambda: f"§ {rng.randint(1, 7)}" + (f" č. {rng.randint(1, 6)}/2000" if rng.random() < 0.4 else "")
    texts = {(d, str(k)): " ".join(mention() for _ in range(rng.randint(0, 3))) for d in laws for k in range(1, 7)}

    def out(doc, text):
        words = text.replace("§ ", "§").split()
        for at, word in enumerate(words):
            if word[0] == "§":
                law = words[at + 2] if words[at + 1 : at + 2] == ["č."] else None
                known = doc if law is None else names.get(law)
                yield known, law if known is None else None, word[1:]

    expected = {}
    for (doc, number), text in texts.items():
        seen, front = {}, set(out(doc, text))
        for distance in range(1, depth + 1):
            front = {t for t in front if t not in seen and t != (doc, None, number)}
            seen |= dict.fromkeys(front, distance)
            front = {t for d, law, n in front if d for t in out(d, texts.get((d, n), ""))}
        rows = [(distance, *t, texts.get((t[0], t[2]))) for t, distance in seen.items()]
        expected[doc, f"paragraf-{number}"] = sorted(rows, key=lambda x: (x[0], x[1] or 0, x[2] or "", x[3]))
    chunks = [(d, f"paragraf-{k}", text) for (d, k), text in texts.items()]
    paragraphs = [(d, k, int(k), text) for (d, k), text in texts.items()]
    assert resolved(spark, chunks, paragraphs, list(names.items()), depth) == expected
