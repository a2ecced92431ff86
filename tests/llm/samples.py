"""Schemas, texts and fixtures shared by the tests of this folder (imported, not a conftest: the folder above has one)."""

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use for columns of their own.
CLASHING = ("score", "slot", "shard", "n", "words", "fp", "root", "h", "at", "doc", "copies", "size", "target", "rank", "response", "sha", "host", "rule",
            "segment", "run", "seeds", "found", "postings", "held_out", "predicted", "component_id", "item", "start", "near", "hits", "place", "part")


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghilmnoprstuvy") for _ in range(r.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="session")
def make(spark):
    """DataFrame from tuples and a schema, with extra columns (partly null) under names that operators use themselves."""
    def build(rows, schema, extra=CLASHING):
        names = [c.split()[0] for c in schema.split(", ")]
        extra = [c for c in extra if c not in names]
        full = [(*r, *(None if i % 2 else "x" for i, _ in enumerate(extra))) for r in rows]
        return spark.createDataFrame(full, ", ".join([schema, *(f"`{c}` string" for c in extra)]))

    return build



@pytest.fixture(scope="session")
def odd_docs():
    """Null and empty texts, a null id, repeated rows, an id with two texts, near copies, blanks of all kinds, a long text."""
    a, b, c = prose(1, 120), prose(2, 90), prose(3, 60)
    long = prose(4, 30_000)
    changed = b.split()
    changed[40] = "zzz"
    texts = [(1, a), (2, None), (3, ""), (None, a), (4, a), (4, a), (5, b), (6, " ".join(changed)), (7, c), (7, c + " more"), (8, " \t\n\x0b "),
             (9, "one"), (10, "one two"), (11, long), (12, long + " end"), (13, a.upper()), (14, a.replace(" ", "\t\n")), (None, None), (15, "Ünï cödé ßß 日本 語"),
             (16, prose(5, 20) + " " + a + " " + prose(6, 30)), (17, prose(7, 40) + " " + " ".join(a.split()[30:100]))]
    return [(d, t, None if d == 9 else "en", None if d in (5, 9) else "s%d" % ((d or 0) % 3), None) for d, t in texts]
