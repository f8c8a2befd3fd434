from __future__ import annotations

from spendscore.llm.line_windows import line_windows


def brute(rows, size=3):
    """Rows by id; each window's first occurrence stays."""
    seen, out = set(), {}
    for doc, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        if text is None:
            out[doc, text] = (None, 0, 0)
            continue
        lines = text.split("\n")
        full = [(i, x.strip(" \t\r")) for i, x in enumerate(lines) if x.strip(" \t\r")]
        cut = set()
        for k in range(len(full) - size + 1):
            window = tuple(t for _, t in full[k : k + size])
            if window in seen:
                cut.update(range(full[k][0], full[k + size - 1][0] + 1))
            seen.add(window)
        out[doc, text] = ("\n".join(x for i, x in enumerate(lines) if i not in cut), len(lines), len(cut))
    return sorted((r[0] or -1, *map(str, out[r])) for r in rows)


def run(documents, rows, **options):
    return sorted((r["doc_id"] or -1, str(r["text"]), str(r["n_lines"]), str(r["n_cut"])) for r in line_windows(documents(*rows), **options).collect())


def test_passages(documents):
    rows = [
        (1, "a\nb\nc\nd\ne"), (2, "x\na\nb\nc\nd\ny"), (3, "a\n\nb \n \t\nc\r\nz"), (4, "a\nb"), (5, "a\na\na\na\na"),
        (6, "b\nc\nd\nq"), (7, "c\nd\nq\nr"), (8, "p\nq\nr\ns\np\nq\nr\ns"), (9, "a\nb\nc\nd\ne"),
    ]
    assert run(documents, rows) == brute(rows)


def test_other_size(documents):
    rows = [(1, "a\nb\nc"), (2, "b\nc"), (3, "c\nb")]
    assert run(documents, rows, size=2) == brute(rows, 2)


def test_odd_rows(documents):
    long = "\n".join(f"line {k % 700}" for k in range(2000))
    rows = [(1, None), (2, ""), (3, "\n\n\n\n"), (4, long), (5, long), (5, long), (None, "line 1\nline 2\nline 3"), (7, "é\nü\nß x")]
    assert run(documents, rows) == brute(rows)
    assert run(documents, []) == []


def test_a_copy_of_every_line_stays(documents):
    rows = [(k, "\n".join("abcdefg"[(k + j) % 7] for j in range(12))) for k in range(1, 9)]
    kept = {line for r in line_windows(documents(*rows)).collect() for line in r["text"].split("\n")}
    assert set("abcdefg") <= kept


def test_columns_stay(documents):
    out = line_windows(documents((1, "a\nb\nc"), (2, "a\nb\nc\nd")))
    assert set(documents().columns) <= set(out.columns) and {r["cls"] for r in out.collect()} == {"clash"}
