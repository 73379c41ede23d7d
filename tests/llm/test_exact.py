"""The operators with one right answer, against brute force on the small corpus."""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from fraudspark.llm import (
    decontaminate,
    digest_index,
    exchange,
    hash_tree,
    jaccard_join,
    line_dedup,
    repeated_phrases,
    sentencepiece_bpe,
)
from tests.llm.corpus import docs, empty, frame, rows_of, texts, words_of  # noqa: F401

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


@pytest.fixture
def small_blocks(monkeypatch):
    """Several blocks and parts even for the small corpus."""
    monkeypatch.setattr(exchange, "BLOCK_BYTES", 9_000)
    monkeypatch.setattr(exchange, "PART_BYTES", 20_000)


def test_sentencepiece_is_the_library(spark, docs):  # noqa: F811
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    expected = []
    for i, text in texts():
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        expected.append((i, len(ids), sha(packed), sha(library.decode(ids).encode())))
    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert rows_of(sentencepiece_bpe.digest(docs, MODEL), *columns) == sorted(expected, key=repr)
    assert sentencepiece_bpe.digest(empty(spark), MODEL).count() == 0


def test_sentencepiece_runs_of_blanks_and_odd_characters():
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    bpe = sentencepiece_bpe.model(MODEL)
    odd = [" " * n + "x" + " " * (n % 7) for n in range(70)]
    odd += ["aaaaaaaaaaaaaaa", "<s>a</s>", "\n\n a\n", "①ﬁ é", "日本語 テキスト", "====----....", "a▁▁b", "­​"]
    for text in odd:
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(bpe.encode(text), "<u4").tolist() == ids, repr(text)
        assert bpe.decode(ids) == library.decode(ids).encode(), repr(text)


def grams(text: str | None) -> frozenset:
    words = words_of(text, lower=True)
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def linked_components(rows) -> list:
    """Per row the smallest id it is linked to, by comparing all sets; rows of one id are one node."""
    up: dict = {}

    def top(x):
        while x in up:
            x = up[x]
        return x

    def join(x, y):
        if top(x) != top(y):
            up[top(x)] = top(y)

    sets = list({grams(t) for _, t in rows if grams(t)})
    for k, a in enumerate(sets):
        for b in sets[:k]:
            if 100 * len(a & b) >= 80 * len(a | b):
                join(a, b)
    for i, t in rows:
        if i is not None and grams(t):
            join(i, grams(t))
    least: dict = {}
    for i, t in rows:
        if i is not None and grams(t):
            least[top(i)] = min(i, least.get(top(i), i))
    return [least.get(top(grams(t))) if grams(t) else i for i, t in rows]


@pytest.mark.parametrize("long, block", [(64, 256), (3, 5)])
def test_jaccard_join(spark, docs, small_blocks, monkeypatch, long, block):  # noqa: F811
    monkeypatch.setattr(jaccard_join, "LONG", long)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows = texts()
    expected = [(i, len(grams(t)), c) for (i, t), c in zip(rows, linked_components(rows), strict=True)]
    found = jaccard_join.jaccard_join(docs)
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == sorted(expected, key=repr)


def test_documents_without_id_link_others(spark):
    base = [f"w{k}" for k in range(60)]
    one, two = base, [*base[:55], "x", *base[56:]]
    three = ["y"] * 3 + two[3:]
    assert 100 * len(grams(" ".join(one)) & grams(" ".join(three))) < 80 * len(grams(" ".join(one)) | grams(" ".join(three)))
    rows = [(1, " ".join(one)), (None, " ".join(two)), (2, " ".join(three)), (None, "a b c d e f"), (None, "a b c d e f")]
    assert linked_components(rows) == [1, 1, 1, None, None]
    found = jaccard_join.jaccard_join(frame(spark, rows))
    assert rows_of(found, "doc_id", "component_id") == sorted([(1, 1), (None, 1), (2, 1), (None, None), (None, None)], key=repr)


def test_jaccard_join_of_nothing(spark):
    assert jaccard_join.jaccard_join(empty(spark)).count() == 0
    only = jaccard_join.jaccard_join(frame(spark, [(4, None), (2, ""), (3, " ")]))
    assert rows_of(only, "doc_id", "n_shingles", "component_id") == [(2, 0, 2), (3, 0, 3), (4, 0, 4)]


def terms(text: str | None) -> list[bytes]:
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", data)


def test_decontamination(spark, docs):  # noqa: F811
    rows = texts()
    long = next(t for _, t in rows if t and len(t) > 20_000)
    items = [
        (1, " ".join(long.split()[100:130])),
        (2, "A, b; C d"),
        (30, rows[3][1]),
        (31, "nowhere to be found at all in any of these texts here"),
        (4, None),
        (5, "..."),
        (2, "x x x x"),
        (None, " ".join(long.split()[500:512])),
    ]
    windows = defaultdict(set)
    for i, t in items:
        found = terms(t)
        for k in range(max(1, len(found) - 9) if found else 0):
            windows[tuple(found[k : k + 10])].add(i)
    expected = []
    for i, t in rows:
        found, hit, names = terms(t), set(), set()
        for window, owners in windows.items():
            for k in range(len(found) - len(window) + 1):
                if tuple(found[k : k + len(window)]) == window:
                    hit |= set(range(k, k + len(window)))
                    names |= owners - {None}
        listed = ",".join(sorted(map(str, names)))
        expected.append((i, len(found), len(hit), len(names), sha(listed.encode()), bool(hit)))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert rows_of(decontaminate.decontaminate(docs, benchmark), *columns) == sorted(expected, key=repr)
    index = decontaminate.build_index(docs, shard_bytes=5_000)
    sliced = decontaminate.digest(decontaminate.search(index, benchmark, slice_bytes=4_000))
    # Sliced answers are merged by document, and rows that agree in all of it stay apart.
    assert rows_of(sliced, *columns) == sorted(expected, key=repr)
    none = decontaminate.decontaminate(docs, benchmark.limit(0))
    assert {(r["n_hit"], r["contaminated"]) for r in none.collect()} == {(0, False)}
    assert decontaminate.decontaminate(empty(spark), benchmark).count() == 0


def test_proximity_matches(spark):
    index = decontaminate.build_index(
        frame(spark, [(1, "alpha one two beta three gamma four delta"), (2, "alpha " + "w " * 60 + "beta gamma delta")])
    )
    items = spark.createDataFrame([(9, "delta gamma beta alpha")], "item_id bigint, text string")
    near = decontaminate.search(index, items, anchors=4, span=10)
    assert rows_of(near, "doc_id", "near", "items") == [(1, ["9"], []), (2, [], [])]


def test_repeated_phrases(spark, docs, small_blocks):  # noqa: F811
    last = 2**63 - 1
    rows = texts()
    first: dict[tuple, int] = {}
    for i, t in rows:
        found = words_of(t)
        for k in range(len(found) - 12):
            window = tuple(found[k : k + 13])
            first[window] = min(first.get(window, last), last if i is None else i)
    expected = []
    for i, t in rows:
        found, gone = words_of(t), set()
        for k in range(len(found) - 12):
            if first[tuple(found[k : k + 13])] < (last if i is None else i):
                gone |= set(range(k, k + 13))
        kept = b" ".join(w for k, w in enumerate(found) if k not in gone)
        expected.append((i, len(found), len(gone), sha(kept)))
    found = repeated_phrases.digest(repeated_phrases.remove_repeats(docs))
    assert rows_of(found, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(expected, key=repr)
    assert any(r[2] for r in expected)
    assert repeated_phrases.remove_repeats(empty(spark)).count() == 0


def run_sql(sql: str, rows) -> list[tuple]:
    db = duckdb.connect()
    db.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    found = db.sql(sql)
    return [dict(zip(found.columns, r, strict=True)) for r in found.fetchall()]


def test_exact_dedup(spark, docs):  # noqa: F811
    rows = texts()
    columns = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    expected = [tuple(r[c] for c in columns) for r in run_sql(digest_index.SQL, rows)]
    for batches in (1, 3):
        found = digest_index.deduplicate(docs, batches)
        assert rows_of(found, *columns) == sorted(expected, key=repr)
    assert digest_index.deduplicate(empty(spark)).count() == 0


def test_digest_index_keeps_its_batches(spark):
    index = digest_index.DigestIndex(spark, "index_of_a_test", expected_rows=30_000_000)
    first = index.append(digest_index.digested(frame(spark, [(1, "a"), (2, "A"), (3, "b")])))
    assert rows_of(first, "keep_id", "n_rows", "known") == [(2, 2, False), (3, 1, False)]
    again = digest_index.DigestIndex(spark, "index_of_a_test")
    assert again.buckets == 30
    second = again.append(digest_index.digested(frame(spark, [(9, "a"), (4, "c"), (5, "c")])))
    assert rows_of(second, "keep_id", "n_rows", "known") == [(5, 2, False), (9, 1, True)]
    third = again.append(digest_index.digested(frame(spark, [(1, "a"), (None, "b")])))
    assert rows_of(third, "keep_id", "n_rows", "known") == [(1, 1, True), (None, 1, True)]
    # The anti-join keeps a digest from being indexed twice; known ones are in the updates.
    assert spark.table("index_of_a_test").count() == 3 and spark.table("index_of_a_test_updates").count() == 3
    assert sorted((r["keep_id"], r["group_size"]) for r in again.resolve().collect()) == [(3, 2), (5, 2), (9, 4)]
    plan = again.resolve()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    spark.sql("DROP TABLE index_of_a_test")
    spark.sql("DROP TABLE index_of_a_test_updates")


def test_one_row_of_a_group_without_ids_stays(spark):
    rows = [(None, "x"), (None, "X"), (None, "x"), (None, None), (None, ""), (3, "y"), (None, "y"), (3, "y"), (2, "y")]
    found = rows_of(digest_index.deduplicate(frame(spark, rows)), "doc_id", "keep_id", "group_size", "kept")
    expected = [(None, None, 3, True)] + [(None, None, 3, False)] * 2 + [(None, None, 2, True), (None, None, 2, False)]
    expected += [(3, 3, 4, True)] * 2 + [(2, 3, 4, False), (None, 3, 4, False)]
    assert found == sorted(expected, key=repr)


def near_lines(a: list[bytes], b: list[bytes]) -> bool:
    if a == b:
        return True
    if min(len(a), len(b)) < line_dedup.MIN_WORDS or abs(len(a) - len(b)) > 1:
        return False
    if len(a) < len(b):
        a, b = b, a
    k = 0
    while k < len(b) and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == (b[k + 1 :] if len(a) == len(b) else b[k:])


def test_line_dedup(spark, docs):  # noqa: F811
    last = 2**63 - 1
    rows = texts()
    lines = []
    for i, t in rows:
        lines += [(last if i is None else i, k, x.encode().split()) for k, x in enumerate(t.split("\n") if t is not None else [])]
    by_words = defaultdict(list)
    for i, k, w in lines:
        by_words[tuple(w)].append((i, k))
    first = {w: min(at) for w, at in by_words.items()}
    classes = list(first)
    earlier = {w: any(first[v] < first[w] and near_lines(list(v), list(w)) for v in classes if v) for w in classes}
    expected = []
    for i, t in rows:
        split = t.split("\n") if t is not None else []
        keep = []
        for k, x in enumerate(split):
            w = tuple(x.encode().split())
            if not w or not (earlier[w] or (last if i is None else i, k) > first[w]):
                keep.append(x)
        expected.append((i, len(split), len(split) - len(keep), sha("\n".join(keep).encode())))
    columns = ("doc_id", "n_lines", "n_removed", "kept_sha256")
    assert rows_of(line_dedup.digest(docs), *columns) == sorted(expected, key=repr)
    reduced = line_dedup.remove_repeated_lines(docs)
    assert set(docs.columns) <= set(reduced.columns) and reduced.count() == len(rows)
    assert line_dedup.remove_repeated_lines(empty(spark)).count() == 0
    with_ids = [(i, t) for i, t in dict(rows).items() if i is not None]
    sql = [tuple(r[c] for c in columns) for r in run_sql(line_dedup.SQL, with_ids)]
    assert rows_of(line_dedup.digest(frame(spark, with_ids)), *columns) == sorted(sql, key=repr)


def test_line_dedup_uses_no_python(spark, docs):  # noqa: F811
    plan = line_dedup.digest(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_sharding(spark, docs, monkeypatch):  # noqa: F811
    monkeypatch.setattr(hash_tree, "SLOT_GROUP", 1)
    rows = texts()
    found = [r.asDict() for r in hash_tree.shard_rows(docs, 5).collect()]
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows
    )
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert hash_tree.shard_rows(empty(spark), 5).count() == 0
    unique = [(i, t) for i, t in dict(rows).items() if i is not None]
    columns = ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    expected = [tuple(r[c] for c in columns) for r in run_sql(hash_tree.sql(40), unique)]
    assert rows_of(hash_tree.shard_rows(frame(spark, unique), 40), *columns) == sorted(expected, key=repr)


@pytest.mark.parametrize("shards", [39, 40, 44])
def test_one_more_shard_takes_rows_only_into_itself(spark, shards):
    rows = spark.range(20_000).selectExpr("id AS doc_id", "'t' AS text")
    found = hash_tree.shard_rows(rows, shards).collect()
    moved = [r for r in found if r["shard"] != r["grown_shard"]]
    assert moved and {r["grown_shard"] for r in moved} == {shards}
    sizes = Counter(r["shard"] for r in found)
    assert len(sizes) == shards and max(sizes.values()) < 1.4 * 20_000 / shards


def test_weights_move_rows_only_below_the_changed_node(spark):
    from pyspark.sql import functions as F

    def shards(weight: float):
        racks = [hash_tree.parent(f"k{r}", [hash_tree.Node(f"s{r}{k}", weight if (r, k) == (0, 0) else 1.0, shard=10 * r + k) for k in range(3)]) for r in range(3)]
        return hash_tree.descend(F.col("id").cast("string"), hash_tree.parent("top", racks))

    moved = spark.range(5000).select(shards(1.0).alias("a"), shards(2.0).alias("b")).where("a <> b").collect()
    assert moved and all(r["b"] < 10 for r in moved)
