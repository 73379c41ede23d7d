"""Benchmark decontamination by a distributed positional inverted index.

``build_index`` cuts the documents into shards of some megabytes. A shard stores, for every term of
its documents, the sorted list of word positions (postings), with the documents laid end to end.
``search`` first sums the corpus frequency of the benchmark's terms, then looks every benchmark
window up in every shard: the postings of its rarest term, less that term's offset, are the
candidate starts; the lists of the other terms, rarest first, are moved by their offsets and
intersected with them. What is left after all terms is an exact occurrence. Terms are compared as
bytes, nothing is hashed.

Besides phrases there are proximity matches: an item is near in a document if its rarest distinct
terms that occur in the documents at all (``anchors`` of them, or as many as there are) all occur
within ``span`` words around an occurrence of the rarest.

No shuffle: a shard answers for its own documents. The items are broadcast in slices of at most
``slice_bytes``; with more than one slice the answers are merged by document.

Defined cases: a null or wordless text has no words and no hits; a wordless item has no window; an
item without id marks words but is not listed; repeated rows each get a row; items that share an id
count once; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudspark.llm import shared, words

#: A-Z become a-z; every other byte outside 0-9, a-z and 0x80-0xFF separates words.
_TERM_BYTES = bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32
    for b in range(256)
)

INDEX = "shard binary, doc_ids array<bigint>, first binary, terms array<binary>, starts binary, positions binary"
FOUND = "shard binary, place int, doc_id bigint, n_words bigint, spans array<int>, items array<string>, near array<string>"
COUNTED = (
    "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, n_near bigint"
)

#: A step over Arrow batches in a task.
Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


class Window(NamedTuple):
    item: int
    terms: tuple[bytes, ...]


class Items(NamedTuple):
    """One slice of the benchmark; ``names`` holds the ids as text, None for a missing one."""

    names: list[str | None]
    windows: list[Window]
    anchors: list[tuple[bytes, ...]]


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TERM_BYTES).split()


def build_index(docs: DataFrame, shard_bytes: int = words.SLICE_BYTES) -> DataFrame:
    """One row per shard; every word of every document has a posting."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.texts_of(batch["text"])
            ids = batch["doc_id"].cast(pa.int64())
            for begin, end in words.slices(offsets, shard_bytes):
                numbers: dict[bytes, int] = {}
                codes, first = [], [0]
                for k in range(begin, end):
                    found = terms_of(data[offsets[k] : offsets[k + 1]].tobytes())
                    codes.append(
                        np.fromiter(
                            (numbers.setdefault(t, len(numbers)) for t in found), np.int32, len(found)
                        )
                    )
                    first.append(first[-1] + len(found))
                code = np.concatenate(codes)
                order = np.argsort(code, kind="stable").astype(np.int32)
                starts = np.zeros(len(numbers) + 1, np.int64)
                np.cumsum(np.bincount(code, minlength=len(numbers)), out=starts[1:])
                own = ids.slice(begin, end - begin).to_pylist()
                digest = hashlib.blake2b(data[offsets[begin] : offsets[end]], digest_size=12)
                digest.update(repr(own).encode())
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": [digest.digest()],
                        "doc_ids": [own],
                        "first": [np.array(first, np.int64).tobytes()],
                        "terms": [list(numbers)],
                        "starts": [starts.tobytes()],
                        "positions": [order.tobytes()],
                    },
                    schema=pa.schema(
                        {
                            "shard": pa.binary(),
                            "doc_ids": pa.list_(pa.int64()),
                            "first": pa.binary(),
                            "terms": pa.list_(pa.binary()),
                            "starts": pa.binary(),
                            "positions": pa.binary(),
                        }
                    ),
                )
        shared.give_back()

    index = docs.select("doc_id", shared.binary_text()).mapInArrow(shards, INDEX)
    # Shards may agree in all rows, so each key gets a number of its own.
    number = F.unhex(F.format_string("%016x", F.monotonically_increasing_id()))
    return index.withColumn("shard", F.concat("shard", number))


def term_counts(index: DataFrame, wanted: set[bytes]) -> dict[bytes, int]:
    """Corpus frequency of the wanted terms; the result is no larger than the wanted set."""
    known = index.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[bytes, int] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                starts = np.frombuffer(batch["starts"][row].as_py(), np.int64)
                for k, term in enumerate(batch["terms"][row].as_py()):
                    if term in known.value:
                        totals[term] = totals.get(term, 0) + int(starts[k + 1] - starts[k])
        yield pa.RecordBatch.from_pydict(
            {"term": pa.array(list(totals), pa.binary()), "n": pa.array(list(totals.values()), pa.int64())}
        )

    rows = index.select("terms", "starts").mapInArrow(count, "term binary, n bigint")
    return {bytes(r["term"]): r["n"] for r in rows.groupBy("term").agg(F.sum("n").alias("n")).collect()}


def windows_of(terms: list[bytes], size: int) -> list[tuple[bytes, ...]]:
    if not terms:
        return []
    return [tuple(terms[k : k + size]) for k in range(max(1, len(terms) - size + 1))]


def _slices(benchmark: DataFrame, slice_bytes: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The items in slices; the driver holds one slice at a time."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("name"), shared.binary_text())
    part, held = [], 0
    for row in rows.toLocalIterator():
        found = terms_of(row["text"])
        part.append((row["name"], found))
        held += 200 * (len(found) + 1)
        if held >= slice_bytes:
            yield part
            part, held = [], 0
    if part:
        yield part


def _intersect(
    window: tuple[bytes, ...], postings: dict[bytes, np.ndarray], rank: dict[bytes, int]
) -> np.ndarray:
    """Starts of the window: the rarest term's positions, thinned out by every other term's."""
    order = sorted(range(len(window)), key=lambda k: rank.get(window[k], 0))
    starts = postings[window[order[0]]] - order[0]
    for k in order[1:]:
        if not len(starts):
            break
        there = postings[window[k]]
        at = np.searchsorted(there, starts + k)
        starts = starts[(at < len(there)) & (there[np.minimum(at, len(there) - 1)] == starts + k)]
    return starts


def _near(anchors: tuple[bytes, ...], postings: dict[bytes, np.ndarray], span: int, doc_of) -> np.ndarray:
    """Documents in which all anchors stand within ``span`` words of the first one."""
    spots = postings[anchors[0]]
    owner = doc_of(spots)
    good = np.ones(len(spots), dtype=bool)
    for term in anchors[1:]:
        there = postings[term]
        home = doc_of(there)
        right = np.searchsorted(there, spots)
        left, right_in = np.maximum(right - 1, 0), np.minimum(right, len(there) - 1)
        good &= ((np.abs(there[left] - spots) <= span) & (home[left] == owner)) | (
            (np.abs(there[right_in] - spots) <= span) & (home[right_in] == owner)
        )
    return np.unique(owner[good])


def _look(spark: SparkSession, items: Items, rank: dict[bytes, int], span: int) -> Step:
    """Looks a slice's items up in shards; only the broadcast holds them."""
    sent = spark.sparkContext.broadcast((items, rank))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, rank = sent.value
        for batch in batches:
            for row in range(batch.num_rows):
                doc_ids = batch["doc_ids"][row].as_py()
                first = np.frombuffer(batch["first"][row].as_py(), np.int64)
                starts = np.frombuffer(batch["starts"][row].as_py(), np.int64)
                positions = np.frombuffer(batch["positions"][row].as_py(), np.int32)
                postings = {
                    term: positions[starts[k] : starts[k + 1]].astype(np.int64)
                    for k, term in enumerate(batch["terms"][row].as_py())
                    if term in rank
                }

                def doc_of(spots: np.ndarray, first: np.ndarray = first) -> np.ndarray:
                    return np.searchsorted(first, spots, side="right") - 1

                spans: list[list[int]] = [[] for _ in doc_ids]
                hit: list[set[str]] = [set() for _ in doc_ids]
                near: list[set[str]] = [set() for _ in doc_ids]
                for item, window in items.windows:
                    if all(term in postings for term in window):
                        found = _intersect(window, postings, rank)
                        docs = doc_of(found)
                        for begin, doc in zip(found.tolist(), docs.tolist(), strict=True):
                            if begin + len(window) <= first[doc + 1]:
                                at = begin - int(first[doc])
                                spans[doc] += [at, at + len(window)]
                                if items.names[item] is not None:
                                    hit[doc].add(items.names[item])
                for item, anchors in enumerate(items.anchors):
                    if items.names[item] is not None and anchors and all(term in postings for term in anchors):
                        for doc in _near(anchors, postings, span, doc_of).tolist():
                            near[doc].add(items.names[item])
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": pa.array([batch["shard"][row].as_py()] * len(doc_ids), pa.binary()),
                        "place": pa.array(range(len(doc_ids)), pa.int32()),
                        "doc_id": pa.array(doc_ids, pa.int64()),
                        "n_words": pa.array(np.diff(first), pa.int64()),
                        "spans": pa.array(spans, pa.list_(pa.int32())),
                        "items": pa.array([sorted(x) for x in hit], pa.list_(pa.string())),
                        "near": pa.array([sorted(x) for x in near], pa.list_(pa.string())),
                    }
                )

        shared.give_back()

    return look


def _looks(
    index: DataFrame, benchmark: DataFrame, window: int, anchors: int = 4, span: int = 40, slice_bytes: int = 64_000_000
) -> Iterator[Step]:
    """One step for each slice of the benchmark, at least one."""
    none = True
    for part in _slices(benchmark, slice_bytes):
        rank = term_counts(index, {term for _, terms in part for term in terms})
        items = Items(
            [name for name, _ in part],
            [Window(k, w) for k, (_, terms) in enumerate(part) for w in dict.fromkeys(windows_of(terms, window))],
            [
                tuple(sorted((t for t in set(terms) if t in rank), key=lambda t: (rank[t], t))[:anchors])
                for _, terms in part
            ],
        )
        none = False
        yield _look(index.sparkSession, items, rank, span)
    if none:
        yield _look(index.sparkSession, Items([], [], []), {}, span)


def _merged(index: DataFrame, looks: Iterator[Step]) -> DataFrame:
    found = None
    for look in looks:
        answer = index.mapInArrow(look, FOUND)
        found = answer if found is None else found.unionAll(answer)
        if found is not answer:
            found = found.groupBy("shard", "place", "doc_id", "n_words").agg(
                F.flatten(F.collect_list("spans")).alias("spans"),
                F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
                F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"),
            )
    return found


def search(
    index: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    anchors: int = 4,
    span: int = 40,
    slice_bytes: int = 64_000_000,
) -> DataFrame:
    """Per document: its words, ``spans`` (begin, end of each occurrence in turn), ``items`` with an
    occurring window and ``near`` items; all lists are sorted by what they hold as text."""
    return _merged(index, _looks(index, benchmark, window, anchors, span, slice_bytes))


def _counted(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Counts and digests of one batch; the words hit are counted once, however often covered."""
    hits = []
    for spans in batch["spans"].to_pylist():
        covered, last = 0, 0
        for begin, end in sorted(zip(spans[::2], spans[1::2], strict=True)):
            covered += max(0, end - max(begin, last))
            last = max(last, end)
        hits.append(covered)
    items = [sorted(x) for x in batch["items"].to_pylist()]
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": batch["doc_id"],
            "n_words": batch["n_words"],
            "n_hit": pa.array(hits, pa.int64()),
            "n_items": pa.array([len(x) for x in items], pa.int64()),
            "items_sha256": pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
            "contaminated": pa.array([n > 0 for n in hits], pa.bool_()),
            "n_near": pa.array([len(x) for x in batch["near"].to_pylist()], pa.int64()),
        }
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of ``search``."""
    return found.mapInArrow(lambda batches: map(_counted, batches), COUNTED)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, slice_bytes: int = 64_000_000) -> DataFrame:
    """Index the documents in the shared folder, search it, and count per document.

    What one slice finds is counted by the worker that found it: two steps in a row are two workers a core.
    """
    index = shared.stored(build_index(docs), "postings")
    looks = _looks(index, benchmark, window, slice_bytes=slice_bytes)
    first, second = next(looks), next(looks, None)
    if second is None:
        return index.mapInArrow(lambda batches: map(_counted, first(batches)), COUNTED)
    return digest(_merged(index, chain([first, second], looks)))
