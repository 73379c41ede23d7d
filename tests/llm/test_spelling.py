"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import duckdb
import pytest

from fraudspark.llm import spelling
from tests.llm.corpus import frame, rows_of

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans(spelling.UPPER, spelling.LOWER)


def counted(rows) -> dict[str, int]:
    out: Counter = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def is_near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute(rows) -> list[tuple]:
    n = counted(rows)
    near = {w: [v for v in n if is_near(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        last = w
        while form[last] is not None:
            last = form[last]
        out.append((w, form[w], last, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def corpus(seed: int = 9) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    letters = "abcdeéñ"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randrange(6, 13))) for _ in range(60)]
    stems += ["prefix" + "".join(rng.choice("abc") for _ in range(4)) for _ in range(60)]
    stems += ["".join(rng.choice("abc") for _ in range(4)) + "suffix" for _ in range(60)]
    stems += ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abababab", "babababa", "ababababa", "ÀÿéÀÿé×", "ÀÿéÀÿé÷"]

    def edited(w: str) -> str:
        k = rng.randrange(len(w))
        kind = rng.randrange(3)
        c = rng.choice(letters + "xyz")
        return w[:k] + (c + w[k + 1 :] if kind == 0 else c + w[k:] if kind == 1 else w[k + 1 :])

    rows: list[tuple[int | None, str | None]] = []
    for i in range(120):
        words = [rng.choice(stems) for _ in range(60)] + [edited(rng.choice(stems)) for _ in range(40)]
        words += ["frequentword"] * 5 + (["frequentwrd"] if i % 3 == 0 else []) + (["frequntwrd"] if i in (5, 90) else [])
        rows.append((i, " ".join(w.upper() if rng.random() < 0.1 else w for w in words) + "-ab1cd2 café"))
    long = "".join(rng.choice(letters) for _ in range(3000))
    rows += [(500, f"{long} {long} {long[:2000] + long[2001:]} {long[:2000] + long[2001:]} {'z' + long} {'z' + long}")]
    rows += [(None, None), (None, "frequentwords frequentwords"), (7, ""), (8, "1 2 .. !"), rows[3], rows[3], rows[60]]
    return rows


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(spelling, "NODE_WORDS", 5)
    rows = corpus()
    expected = brute(rows)
    assert sum(r[4] > 0 for r in expected) > 100 and sum(r[1] is not None for r in expected) > 10
    assert any(r[1] not in (None, r[2]) for r in expected)
    assert rows_of(spelling.variants(frame(spark, rows)), *COLUMNS) == expected


def test_sql_agrees(spark):
    rows = [r for r in corpus(11) if len(r[1] or "") < 5000]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    found = con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({spelling.SQL})").fetchall()
    assert sorted(found, key=repr) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None), (2, "")], [(1, "short words only")], [(1, "lonelyword other1")]])
def test_no_words(spark, rows):
    assert spelling.variants(frame(spark, rows)).count() == 0


def test_one_word_and_pieces_of_a_batch(spark, monkeypatch):
    assert rows_of(spelling.variants(frame(spark, [(1, "solitary solitary")])), *COLUMNS) == brute([(1, "solitary solitary")])
    monkeypatch.setattr(spelling, "_POINTS", 20)
    rows = corpus(3)[:20]
    assert rows_of(spelling.variants(frame(spark, rows)), *COLUMNS) == brute(rows)
