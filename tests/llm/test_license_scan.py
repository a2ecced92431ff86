import brute
from samples import DOCS, make, prose  # noqa: F401 (fixtures)

from conform.llm.license_scan import PHRASES, TEMPLATES, scan_licenses

MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
TEXTS = [None, "", "   ", "Under the MIT License.", "under the mit licensed", "UNDER-THE_MIT/LICENSE under the\nmit license", prose(1, 40) + " CC BY-NC 4.0 " + prose(2, 9),
         "Licensed under the Apache License, Version 2.0.", "apache license version 2", "This work is licensed under the GNU General Public License, version 3.",
         "licensed under the GNU Lesser General Public License, version 3", MIT, MIT.replace("obtaining", "who gets"), "cc by nc cc by nc", "ccbync", "cc by",
         "wor\u212A under the mit license \u0130 K", "the the the " * 2000 + MIT + " the" * 500, "GNU general license public version 3",
         "licensed under cc by sa 4 0 and licensed under cc by nc 4 0", "ünder the mit license", "under the mit license\u00e9", "free and unencumbered software",
         "This is free and unencumbered software released into the public domain."] + [prose(i, 60) for i in range(10, 30)]


def test_rows_as_brute_force(make):
    rows = [(None if i == 4 else i, t, None, None, None) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "x", None, None)]
    got = scan_licenses(make(rows, DOCS)).collect()
    want = []
    for (d, *_), (n, starts, base, labels) in zip(rows, brute.licenses([r[1] for r in rows], PHRASES, TEMPLATES)):
        want.append((d, n, len(starts), starts[0] if starts else None, starts[-1] if starts else None, ",".join(sorted(base)), ",".join(sorted(labels))))
    assert sorted((tuple(r)[:7] for r in got), key=str) == sorted(want, key=str)
    assert all(0 <= r.score <= 1 and (r.score > 0) == bool(r.labels) for r in got)
    by = {r.doc_id: r for r in got}
    assert by[9].labels == "gpl-3" and by[9].base_labels == "" and by[11].labels == "mit" and by[10].labels == "lgpl-3"


def test_empty_table(make):
    assert scan_licenses(make([], DOCS)).collect() == []


def test_a_long_file_of_licence_lines(make):
    """Hundreds of beginnings in one file: each is found, and none where a key phrase is cut."""
    line = "licensed under the gnu general public license version 3 "
    rows = [(1, line * 200, None, None, None), (2, line.replace("general ", "") * 200, None, None, None), (3, ("cc by nc 4 0 " + line) * 150, None, None, None)]
    got = {r.doc_id: r for r in scan_licenses(make(rows, DOCS)).collect()}
    for (d, *_), (n, starts, base, labels) in zip(rows, brute.licenses([r[1] for r in rows], PHRASES, TEMPLATES)):
        assert (got[d].n_words, got[d].n_base, got[d].labels) == (n, len(starts), ",".join(sorted(labels)))
    assert got[1].labels == "gpl-3" and got[2].labels == "" and got[3].n_base == 150
