"""Markers of statute text as Column expressions: null where an element is none."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The ordinals of parts, in order.
PARTS = ("PRVÁ", "DRUHÁ", "TRETIA", "ŠTVRTÁ", "PIATA", "ŠIESTA", "SEDMÁ", "ÔSMA", "DEVÄTÁ", "DESIATA")


def extract(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null where there is none."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def normalised(text: Column) -> Column:
    """No-break spaces as spaces, white space trimmed."""
    plain = F.regexp_replace(F.replace(text, F.lit("\u00a0"), F.lit(" ")), r"^\s+|\s+$", "")
    # The pattern runs only where it can match: most texts begin and end in something else. Its "$" also stands before a last line's end.
    asked = (text < "!") | text.contains("\u00a0")
    for end in " \t\n\x0b\f\r\x85\u2028\u2029":
        asked = asked | text.endswith(end)
    return F.when(asked, plain).otherwise(text)


# Each marker asks something cheap of the text before its pattern runs: few elements are markers.


def part(text: Column) -> Column:
    return F.nullif(_part(text), F.lit(""))


def _part(text: Column) -> Column:
    found = F.upper(F.regexp_extract(text, rf"(?iu)^({'|'.join(PARTS)})\s+ČASŤ", 0))
    return F.when((text.contains("Č") | text.contains("č")) & F.upper(text).contains("ČASŤ"), found)


def _digit(text: Column) -> Column:
    return F.left(text, F.lit(1)).between("0", "9")


def paragraph(text: Column, link: Column | None = None) -> Column:
    """§ and its number; a link to a paragraph goes before the text."""
    own = F.when(text.startswith("§ "), extract(text, r"^§\s+(\d+[a-zA-Z]*)"))
    return own if link is None else F.coalesce(extract(link, r"^#paragraf-([^.]+)"), own)


#: The capitals that a section's title begins with.
CAPITALS = "A-ZÁÄČĎÉÍĽŇÓÔŔŠŤÚÝŽ"


def pure_section(text: Column) -> Column:
    """The number of "§ N" or "§ N Title" alone; texts that name a section, or an odsek of it, have none."""
    bare = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    own = F.coalesce(
        extract(bare, r"(?U)^§\s+(\d+[a-z]?)$"), extract(bare, rf"(?U)^§\s+(\d+[a-z]?)\s+[{CAPITALS}].*$")
    )
    return F.when(bare.startswith("§") & ~F.lower(bare).contains("ods."), own)


def pure_odsek(text: Column) -> Column:
    """The number of "(N)" alone."""
    return extract(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""), r"(?U)^\((\d+)\)$")


def odsek(text: Column, link: Column | None = None) -> Column:
    own = F.when(text.startswith("("), extract(text, r"^\(\s*(\d+)\s*\)"))
    return own if link is None else F.coalesce(extract(link, r"odsek-(\d+)"), own)


def pismeno(text: Column, link: Column | None = None) -> Column:
    own = F.nullif(_pismeno(text), F.lit(""))
    return own if link is None else F.coalesce(F.lower(extract(link, r"(?i)pismeno-([a-z]+)")), own)


def _pismeno(text: Column) -> Column:
    """A word of any letters before a closing bracket that ends the text, or one of plain letters before any."""
    own = F.regexp_extract(text, r"^(\p{L}+(?=\s*\)$)|[a-zA-Z]+(?=\s*\)))", 1)
    return F.when(text.contains(")") & ~text.startswith("("), F.lower(own))


def by_level(text: Column, free: Column) -> dict[str, Column]:
    """What marker of the main text an element is, by level: null or empty where it is none, so that each pattern runs once.

    ``free``: whether the element is no link; a linked "§ N" or "(N)" refers to a unit.
    """
    return {
        "part": _part(text),
        "paragraph": F.when(free & text.startswith("§ "), F.regexp_extract(text, r"^§\s+(\d+[a-zA-Z]*)", 1)),
        "pismeno": _pismeno(text),
        "odsek": F.when(free & text.startswith("("), F.regexp_extract(text, r"^\(\s*(\d+)\s*\)", 1)),
        "subitem": F.when(_digit(text) & text.contains("."), F.regexp_extract(text, r"^(\d+)(?:\s*\.$|\.\s+)", 1)),
    }


def subitem(text: Column) -> Column:
    return F.when(_digit(text) & text.contains("."), extract(text, r"^(\d+)(?:\s*\.$|\.\s+)"))


def law_end(text: Column) -> Column:
    lower = F.lower(F.trim(text))
    return lower.contains("tento zákon nadobúda účinnosť") | lower.endswith("v. r.")


def annex(text: Column) -> Column:
    """The number of an annex whose heading this is; links and tables that name one aren't."""
    lower = F.lower(F.trim(text))
    none = lower.contains("prevziať prílohu") | lower.contains("tabul") | lower.contains("tabuľka")
    named = lower.contains("príloha") | lower.startswith("annex")
    heading = (F.length(text) < 100) | lower.contains("k zákonu")
    return F.when(
        named & ~none,
        F.coalesce(
            extract(lower, r"(?u)príloha\s+č\.\s*(\d+)\s+k\s+zákonu"),
            F.when(heading, extract(lower, r"(?u)^príloha\s+č\.\s*(\d+)")),
            extract(lower, r"^annex\s+(\d+)\s*$"),
        ),
    )


def notes_start(text: Column, link: Column) -> Column:
    return F.coalesce((link == "#poznamky") & (F.lower(F.trim(text)) == "poznámky"), F.lit(False))


def footnote(text: Column, link: Column) -> Column:
    """The number of a footnote that is defined here; one that is linked is only referred to."""
    linked = F.coalesce(link.rlike(r"poznamka-\d"), F.lit(False))
    return F.when(_digit(text) & ~linked, extract(text, r"^(\d+[a-z]*)\)"))


def remainder(text: Column) -> Column:
    """What follows an inline marker, null where the marker stands alone."""
    return F.nullif(F.regexp_replace(text, r"(?i)^(?:\(\s*\d+\s*\)|\p{L}+\s*\)|\d+\s*\.(?=\s|$))\s*", ""), F.lit(""))


#: Words that name a letter; each stands before it as a word, or ends the text before it.
NAMES = r"písmene|písm\.|pismeno|písmena|písm"


def may_name_letters(text: Column) -> Column:
    """Whether one of NAMES may stand in the text, alone; a quick test for all elements."""
    # "ſ" is a small "s" as well where patterns ignore case.
    stem = F.lit(False)
    for part_of in ("sm", "Sm", "sM", "SM", "ſ"):
        stem = stem | text.contains(part_of)
    return F.coalesce(stem & text.rlike("(?iuU)p[ií]sm"), F.lit(False))


def is_reference(letter: Column, link: Column, before: Column, linked_before: Column | None = None) -> Column:
    """Whether "x)" is named in running text and no marker.

    So it is where its own link names the same letter; where a text just before that links to a
    letter or a section (``linked_before``) ends in a word that names letters; where ``before``
    ends in such a word, or names this letter.
    """
    target = extract(F.when(F.lower(link).contains("pismeno"), link), r"(?i)pismeno[_-]?([a-z]+)")
    said = F.trim(F.replace(before, F.lit("\n"), F.lit(" ")))
    named = F.transform(F.regexp_extract_all(said, F.lit(rf"(?iuU)(?:{NAMES})\s+(\p{{L}}+)\)"), F.lit(1)), lambda x: F.lower(x))
    ends = said.rlike(r"(?iuU)(?:v\s+písmene|písm\.|pismeno|písmena|písm)\s*$")
    tests = [F.lower(target) == F.lower(letter), F.array_contains(named, F.lower(letter)), ends]
    if linked_before is not None:
        tests.append(F.exists(linked_before, lambda t: F.replace(t, F.lit("\n"), F.lit(" ")).rlike(rf"(?iuU)(?:{NAMES})\s*$")))
    any_of = F.lit(False)
    for test in tests:
        any_of = any_of | F.coalesce(test, F.lit(False))
    return any_of
