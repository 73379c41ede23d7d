"""A small corpus with every awkward case, and plain readings of texts to compare with."""

from __future__ import annotations

import random

import pytest

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "block string, part int, row string, ord int, label string, held_out int, score string, n_lines int, word string"
)
WORDS = [
    a + b for a in ("ka", "lo", "mi", "ne", "po", "ru", "Sa", "tü", "vé", "xi") for b in ("ra", "sto", "n", "lle", "q", "X")
]


def prose(rng: random.Random, n: int, per_line: int = 12) -> str:
    words = [rng.choice(WORDS) for _ in range(n)]
    return "\n".join(" ".join(words[k : k + per_line]) for k in range(0, n, per_line))


def edited(rng: random.Random, text: str, edits: int) -> str:
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return " ".join(words)


def texts(seed: int = 3) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    out: list[str | None] = [prose(rng, rng.choice((3, 8, 20, 60, 200))) for _ in range(40)]
    base = prose(rng, 150)
    out += [edited(rng, base, rng.randrange(8)) for _ in range(25)]
    out += [base] * 6 + [base.upper(), base.lower(), base.replace(" ", "  ")]
    passage = " ".join(rng.choice(WORDS) for _ in range(60))
    out += [f"{prose(rng, 30)}\n{passage} {prose(rng, 20)}" for _ in range(8)]
    out += [None, "", " \t\n ", "a", "a b c d", "a b c d", ".", "12 34 !!", "\n\n\n", "x " * 40, "\x00\t é ▁ \U0001f600  "]
    out.append(prose(rng, 6000) + "\n" + passage)
    line = " ".join(rng.choice(WORDS) for _ in range(12))
    out += [line, line + " end", line.replace(line.split()[4], "other", 1), line.split(" ", 1)[1], "t u v w x y z", "t u v w x y q"]
    rows: list[tuple[int | None, str | None]] = list(enumerate(out, 10))
    rng.shuffle(rows)
    rows += [rows[0], rows[5], (None, "no id " + passage), (None, base), (None, None)]
    return rows


def frame(spark, rows):
    extra = ("en", "s", 1, "b", 2, "r", 3, "l", 4, "sc", 5, "w")
    return spark.createDataFrame([(i, t, *extra) for i, t in rows], SCHEMA)


def rows_of(df, *columns: str) -> list[tuple]:
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, texts())
