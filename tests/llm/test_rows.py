"""Rows without id, rows that share one, and rows repeated without end."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from fraudspark.llm import exchange, jaccard_join, repeated_phrases
from tests.llm.corpus import frame, prose, rows_of, words_of
from tests.llm.test_exact import grams, linked_components, sha


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(exchange, "BLOCK_BYTES", 6_000)
    monkeypatch.setattr(exchange, "PART_BYTES", 20_000)
    monkeypatch.setattr(exchange, "COPIES", 7)


def rows_with_few_ids() -> list[tuple[int | None, str | None]]:
    rng = random.Random(8)
    rows: list[tuple[int | None, str | None]] = [(i, prose(rng, 60)) for i in range(60, 90)]
    rows += [(None, prose(rng, 60)) for _ in range(40)] + [(50, prose(rng, 60)) for _ in range(40)]
    rows += [(None, rows[3][1])] * 90 + [(50, rows[4][1])] * 90 + [(None, None)] * 200 + [(51, "")] * 200
    return rows + [(7, rows[40][1] + " more"), (8, rows[80][1] + " more"), (9, rows[81][1] + " more")]


def test_blocks_are_bounded_whatever_the_ids(spark, small_blocks):
    rows = rows_with_few_ids()
    dealt, _ = exchange.blocked(frame(spark, rows))
    size: Counter = Counter()
    for r in dealt.collect():
        size[r["block"]] += len(r["text"] or b"") + exchange.ROW_BYTES
    assert max(size.values()) < 4 * exchange.BLOCK_BYTES
    back = exchange.spread(dealt).collect()
    found = Counter((r["doc_id"], None if r["text"] is None else bytes(r["text"]).decode()) for r in back)
    assert found == Counter(rows)


def test_operators_with_few_ids(spark, small_blocks):
    rows = rows_with_few_ids()
    expected = [(i, len(grams(t)), c) for (i, t), c in zip(rows, linked_components(rows), strict=True)]
    found = jaccard_join.jaccard_join(frame(spark, rows))
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == sorted(expected, key=repr)
    assert next(c for (_, t), c in zip(rows, linked_components(rows), strict=True) if t == rows[4][1]) == 8

    last = 2**63 - 1
    first: dict = defaultdict(lambda: last)
    for i, t in rows:
        w = words_of(t)
        for k in range(len(w) - 12):
            first[tuple(w[k : k + 13])] = min(first[tuple(w[k : k + 13])], last if i is None else i)
    kept = []
    for i, t in rows:
        w, gone = words_of(t), set()
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < (last if i is None else i):
                gone |= set(range(k, k + 13))
        kept.append((i, len(w), len(gone), sha(b" ".join(x for k, x in enumerate(w) if k not in gone))))
    digests = repeated_phrases.digest(repeated_phrases.remove_repeats(frame(spark, rows)))
    assert rows_of(digests, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(kept, key=repr)
