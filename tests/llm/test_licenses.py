from __future__ import annotations

import re

from spendscore.llm.licenses import TEMPLATES, license_scan


def brute(rows):
    out = []
    for doc, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
        starts, base, labels, score = [], set(), set(), 0.0
        for t in TEMPLATES:
            key, own = t.key.split(), t.words.split()
            for s in range(len(words) - len(key) + 1):
                if words[s : s + len(key)] == key:
                    labels.add(t.label)
                    if t.base:
                        starts.append(s)
                        base.add(t.label)
                    fits = sum(0 <= s - t.key_start + j < len(words) and words[s - t.key_start + j] == w for j, w in enumerate(own))
                    score = max(score, fits / len(own))
        out.append((doc, len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score))
    return sorted(out, key=str)


def run(documents, rows):
    names = "doc_id n_words n_base first_word last_word base_labels labels score".split()
    return sorted((tuple(r[n] for n in names) for r in license_scan(documents(*rows)).collect()), key=str)


def test_templates_hold_their_keys():
    assert all(t.words.split()[t.key_start :][: len(t.key.split())] == t.key.split() for t in TEMPLATES)


def test_notices(documents):
    rows = [
        (1, "Licensed under the Apache License, Version 2.0."), (2, "mit license MIT LICENSE mit-license"), (3, "the license of mit"),
        (4, "This work is licensed under the GNU General Public License, version 3, or CC BY-NC 4.0."), (5, "cc by cc by 4 0"),
        (6, "gnu gnu general public license"), (7, "gnu general\npublic;license"), (8, "GNU General Publiс License"),  # a Cyrillic letter
        (9, "Redistribution and use in source and binary forms, with or without modification, are permitted."), (10, "apache"),
        (11, "license apache license"), (12, "émit license"), (13, "mit license" + " filler" * 60_000 + " cc by"), (14, "İmit license KIT"),
        (15, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"), (16, "cc0 1.0"), (17, "xcc by"),
    ]
    found = run(documents, rows)
    assert found == brute(rows)
    assert {r[0]: r[6] for r in found}[4] == "cc-by,cc-by-nc,gpl,gpl-3.0"


def test_odd_rows(documents):
    rows = [(1, None), (2, ""), (3, " .,;"), (None, "mit license"), (4, "mit license"), (4, "mit license"), (5, "x" * 100_000)]
    assert run(documents, rows) == brute(rows)
    assert run(documents, []) == []
