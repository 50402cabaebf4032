import re
from collections import defaultdict
from random import Random

from vellum.operators import fragments

ELEMENTS = "doc_id long, pos long, text string, left double, top double"
CELLS = "doc_id long, table_id long, r int, c int, text string"


def rebuilt(spark, elements, cells=()):
    made = fragments.rebuilt_tables(spark.createDataFrame(elements, ELEMENTS), spark.createDataFrame(list(cells), CELLS))
    return sorted((x.doc_id, x.place, x.group, x.title, [tuple(r) for r in x.rows]) for x in made.collect())


def by_hand(elements, cells):
    """One document: what the texts say, an element at a time."""
    elements = sorted(elements, key=lambda e: e[1])
    held = {m[1] for _, _, _, c, text in cells if c == 0 and (m := re.match(r"(\d+)-", text.strip(" ")))}
    titles, lines, rows = {}, {}, defaultdict(list)
    for _, _, text, left, top in elements:
        if m := re.search(r"Odpisová\s+skupina\s+([0-9]+)", text or "", re.I):
            titles[m[1]] = text
        if m := re.match(r"([0-9]+-[0-9]+)\s+([0-9]+[.0-9]*)\s+(.+)$", text or ""):
            lines[m[1]] = m[2], m[3]
        if top is not None:
            rows[round(top / 8)].append((left, text))
    for _, row in sorted(rows.items()):
        item, *texts = [t for _, t in sorted(row, key=lambda x: x[0])]
        if item and re.fullmatch(r"[0-9]+-[0-9]+", item) and item not in lines:
            codes = [k for k, t in enumerate(texts) if re.fullmatch(r"[0-9]+\.[0-9.]*", t)][:1]
            lines[item] = "".join(texts[k] for k in codes), " ".join(t for k, t in enumerate(texts) if k not in codes)
    made = []
    for group, title in titles.items():
        items = sorted((i for i in lines if i.split("-")[0] == group), key=lambda i: int(i.split("-")[1]))
        if items and group not in held:
            made.append((group, title, [(i, *lines[i]) for i in items]))
    tables = len({c[1] for c in cells})
    return [(elements[0][0], tables + k, *m) for k, m in enumerate(made)]


def test_headers_with_a_table_have_it_and_others_get_theirs(spark):
    elements = [
        (1, 0, "Odpisová skupina 2", None, None), (1, 1, "2-1 12.3 stroj", None, None), (1, 2, "odpisová skupina 1 prvá", None, None),
        (1, 3, "1-10 7 desiata", None, None), (1, 4, "1-9 8.1 deviata", None, None), (1, 5, "1-9\t8.2 oprava", None, None),
        (1, 6, "1-2", 10.0, 81.0), (1, 7, "názov", 30.0, 79.0), (1, 8, "4.5", 20.0, 80.0), (1, 9, "6.7", 40.0, 80.0), (1, 10, "1-2", 10.0, 400.0),
        (1, 11, "1-10", 10.0, 160.0), (1, 12, "nič", 20.0, 160.0), (1, 13, "Odpisová skupina 3", None, None), (1, 14, None, 10.0, 240.0),
        (2, 0, "2-1 12.3 bez hlavičky", None, None),
    ]
    cells = [(1, 7, 0, 0, "Položka"), (1, 7, 1, 0, " 2-5 "), (1, 7, 1, 1, "1-1"), (1, 8, 0, 0, "x")]
    rows = [("1-2", "4.5", "názov 6.7"), ("1-9", "8.2", "oprava"), ("1-10", "7", "desiata")]
    assert rebuilt(spark, elements, cells) == [(1, 2, "1", "odpisová skupina 1 prvá", rows)]
    without = rebuilt(spark, elements)
    assert [x[:3] for x in without] == [(1, 0, "2"), (1, 1, "1")] and without[1][4] == rows


def test_halves_go_to_the_even_row_and_long_numbers_keep_their_order(spark):
    elements = [(1, 0, "Odpisová skupina 1", None, None), (1, 1, "1-5", 0.0, 16.0), (1, 2, "a", 1.0, 20.0), (1, 3, "b", 2.0, 12.0), (1, 4, "c", 3.0, 20.5)]
    elements += [(1, 5, f"1-{'9' * 30} 1 veľká", None, None), (1, 6, "1-007 1 siedma", None, None), (1, 7, "1-0 1 nultá\nďalej", None, None)]
    assert rebuilt(spark, elements)[0][4] == [("1-5", "", "a b"), ("1-007", "1", "siedma"), ("1-" + "9" * 30, "1", "veľká")]
    assert rebuilt(spark, []) == [] == rebuilt(spark, [(None, None, None, None, None)])


def test_random_documents_are_as_by_hand(spark):
    for seed in range(3):
        rng, elements, cells = Random(seed), [], []
        for doc in range(12):
            words = lambda: rng.choice(["x", "1.2", "3.", "y z", "1-2", "2-2", ""])
            for pos in range(60):
                kind = rng.random()
                item = f"{rng.randint(1, 4)}-{rng.randint(1, 12)}"
                at = (rng.randint(0, 9) * 1.0, rng.randint(0, 400) * 1.0)
                if kind < 0.1:
                    elements.append((doc, pos, f"{rng.choice('aA')} Odpisová  skupina {rng.randint(1, 5)}", *(at if kind < 0.05 else (None, None))))
                elif kind < 0.3:
                    elements.append((doc, pos, f"{item} {rng.choice(['1', '1.5', '.', 'k'])} {words()}", None, None))
                else:
                    elements.append((doc, pos, item if kind < 0.6 else words(), *at))
            cells += [(doc, 9, 0, 0, f"{doc % 6}-1")] if doc % 2 else []
        parts = [by_hand([e for e in elements if e[0] == d], [c for c in cells if c[0] == d]) for d in range(12)]
        expected = sorted(x for part in parts for x in part)
        assert expected and rebuilt(spark, elements, cells) == expected
