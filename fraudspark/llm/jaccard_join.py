"""N-gram Jaccard join by prefix filters under several global orders.

Sets are the distinct hashes (64 bits) of a text's word n-grams. A global order sorts n-grams by how
many sets hold them, in powers of two, and then by a hash that differs from order to order. Two sets
of similarity t or more share an n-gram among the first ``n - ceil(t n) + 1`` of each, in every such
order. N-grams of one set only come first everywhere and can't be shared; a set whose prefix holds
nothing else has no partner and is out at once.

1. Equal sets become one node, named by a 64-bit hash; sets that share a document id are linked.
2. The corpus frequency of every n-gram comes from ``exchange``; each set gets its prefixes.
3. Candidates share a prefix n-gram of the first order. Long lists first: each is compared with one
   pivot, which joins most of a group of near copies at the cost of one pair per member. Lists that
   then still hold several components make clusters, whose sets are compared in blocks, and only
   where they aren't connected yet. Pairs are never written out, and none that might be the only link
   between two components is skipped.
4. A pair is dropped unless its prefixes of all other orders meet too, then verified exactly.

Defined cases: a null or wordless text has an empty set and links nothing; a text of fewer words
than n has one n-gram, its whole sequence; rows that share an id are in one component; rows without id take
the component of an equal text, if any, and link nothing else; other columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudspark.llm import exchange, shared, words
from fraudspark.llm.components import components

ORDERS = 3
#: Members of a list that gets a pivot first, and sets of a block.
LONG, BLOCK = 64, 256
SETS = (
    "doc_id bigint, copies bigint, n_shingles bigint, set_key binary, grams binary, "
    + ", ".join(f"prefix{k} binary" for k in range(ORDERS))
)


def gram_sets(table: pa.Table, n: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text of the table."""
    data, offsets = words.texts_of(table["text"])
    found = words.hash_words(data, offsets, lower=True)
    grams = words.ngrams(found.hashes, n)
    first = found.first.tolist()
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        else:
            out.append(words.ngrams(found.hashes[a:b], b - a) if b > a else grams[:0])
    return out


def _counted(docs: DataFrame, parts: int, n: int) -> DataFrame:
    """How many sets hold each n-gram of a block, as a power of two; 0 for one set.

    N-grams are counted by part and 32 more bits. Two that share those have one count, in every set
    alike, so it is still a global order; parts grow with the input, so such pairs stay rare.
    """

    def send(table: pa.Table) -> pa.Table:
        shared.give_back()
        distinct = {s.tobytes(): s for s in gram_sets(exchange.in_order(table), n)}
        keys, counts = np.unique(np.concatenate(list(distinct.values())), return_counts=True)
        return exchange.packed(
            table["block"][0].as_py(),
            keys.astype(np.uint32),
            exchange.part_of(keys, parts),
            counts.astype(np.uint32),
        )

    def answer(group: np.ndarray, begins: np.ndarray, part: pa.Table) -> pa.Table:
        counts = np.bincount(group, exchange.numbers_of(part, np.uint32))
        power = np.log2(counts).astype(np.uint8)[group]
        return pa.table(
            {
                "block": part["block"],
                "part": part["part"],
                "keys": pa.array([b""] * part.num_rows, pa.binary()),
                "numbers": pa.array(
                    [power[a:b].tobytes() for a, b in zip(begins[:-1], begins[1:], strict=True)], pa.binary()
                ),
            }
        )

    return exchange.answered(docs.groupBy("block").applyInArrow(send, exchange.KEYED), answer, np.uint32)


def _prefixed(docs: DataFrame, counted: DataFrame, parts: int, n: int, percent: int) -> DataFrame:
    """One row per document; the first row of a set in its block has its shared n-grams and prefixes."""

    def prefix(table: pa.Table, replies: pa.Table) -> pa.Table:
        shared.give_back()
        table = exchange.in_order(table)
        sets = gram_sets(table, n)
        keys = np.unique(np.concatenate(sets)) if sets else np.zeros(0, np.uint64)
        power = exchange.unpacked(replies, exchange.part_of(keys, parts), np.uint8)
        seen: set[bytes] = set()
        digests: list[bytes | None] = []
        payload: list[list[bytes | None]] = [[] for _ in range(1 + ORDERS)]
        for own in sets:
            digest = hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None
            digests.append(digest)
            row: list[bytes | None] = [None] * (1 + ORDERS)
            if len(own) and digest not in seen:
                seen.add(digest)
                mine = power[np.searchsorted(keys, own)]
                grams, mine = own[mine > 0], mine[mine > 0]
                length = len(own) + (-percent * len(own) // 100) + 1 - (len(own) - len(grams))
                if length > 0:
                    row[0] = grams.tobytes()
                    for k in range(ORDERS):
                        order = np.lexsort((words.mix(grams, 100 + k), mine))[:length]
                        row[1 + k] = np.sort(grams[order]).tobytes()
            for column, value in zip(payload, row, strict=True):
                column.append(value)
        columns = {
            "doc_id": table["doc_id"],
            "copies": table["copies"],
            "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
            "set_key": pa.array(digests, pa.binary()),
            "grams": pa.array(payload[0], pa.binary()),
        }
        columns |= {f"prefix{k}": pa.array(payload[1 + k], pa.binary()) for k in range(ORDERS)}
        return pa.table(columns)

    return docs.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(prefix, SETS)


def _lists(sets: DataFrame) -> DataFrame:
    """Postings of the first order: ``token``, ``node`` and the set's size."""

    def unpack(batches):
        for batch in batches:
            grams = [np.frombuffer(p.as_py(), np.int64) for p in batch["prefix0"]]
            many = [len(g) for g in grams]
            yield pa.RecordBatch.from_pydict(
                {
                    "token": pa.array(np.concatenate(grams) if grams else np.zeros(0, np.int64)),
                    "node": pa.array(np.repeat(batch["node"].to_numpy(), many)),
                    "size": pa.array(np.repeat(batch["n_shingles"].to_numpy(), many)),
                }
            )

    return sets.select("prefix0", "node", "n_shingles").mapInArrow(unpack, "token bigint, node bigint, size bigint")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (node, other) whose other prefixes meet and whose similarity is high enough."""
    columns = ["n_shingles", "grams", *[f"prefix{k}" for k in range(1, ORDERS)]]
    joined = pairs
    for side in ("node", "other"):
        joined = joined.join(
            sets.select(F.col("node").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns]), side
        )

    def verify(batches):
        for batch in batches:
            good = []
            for row in range(batch.num_rows):

                def meet(column, row=row) -> int:
                    one, two = (np.frombuffer(batch[f"{s}_{column}"][row].as_py(), np.uint64) for s in ("node", "other"))
                    if len(one) > len(two):
                        one, two = two, one
                    at = np.searchsorted(two, one)
                    return int((two[np.minimum(at, len(two) - 1)] == one).sum()) if len(two) else 0

                fits = all(meet(f"prefix{k}") for k in range(1, ORDERS))
                both = meet("grams") if fits else 0
                total = batch["node_n_shingles"][row].as_py() + batch["other_n_shingles"][row].as_py() - both
                good.append(fits and 100 * both >= percent * total)
            yield batch.select(["node", "other"]).filter(pa.array(good, pa.bool_()))

    return joined.mapInArrow(verify, "node bigint, other bigint")


def _stars(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs of each long list's pivot, the member with the smallest hash, with its other members."""
    one = F.struct(F.xxhash64("node").alias("h"), "node", "size")
    pivots = (
        lists.groupBy("token")
        .agg(F.count(F.lit(1)).alias("members"), F.min(one).alias("p"))
        .where(F.col("members") >= LONG)
        .select("token", "members", F.col("p.node").alias("pivot"), F.col("p.size").alias("pivot_size"))
    )
    # A token that very many sets share has its pivot by broadcast.
    return (
        shared.attach(lists, shared.settled(pivots), "token", "members")
        .where(f"node <> pivot and 100 * least(size, pivot_size) >= {percent} * greatest(size, pivot_size)")
        .select(F.least("node", "pivot").alias("node"), F.greatest("node", "pivot").alias("other"))
        .distinct()
    )


def _clusters(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """Nodes of lists that still hold several components: their ``cluster`` and ``label``.

    Any two nodes with a common list are in one cluster.
    """
    labelled = lists.join(roots, "node", "left").select("token", "node", F.coalesce("root", "node").alias("label"))
    bounds = labelled.groupBy("token").agg(
        F.min("node").alias("least"), F.min("label").alias("a"), F.max("label").alias("b")
    )
    open_lists = bounds.where("a < b").select("token", "least")
    links = shared.settled(
        labelled.join(open_lists, "token").select("node", F.col("least").alias("other"), "label").distinct()
    )
    joined = components(links.select("node", "other"))
    return (
        links.select("node", "label")
        .distinct()
        .join(joined, "node", "left")
        .select("node", "label", F.coalesce("root", "node").alias("cluster"))
    )


def _block_links(sets: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """Links between components, found by comparing the sets of a cluster block by block.

    A cluster is cut into blocks of about ``BLOCK`` sets; each pair of blocks is one group. Within it
    only pairs that meet in every order's prefixes and aren't connected yet are verified.
    """
    sizes = clusters.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (
        sets.join(clusters, "node")
        .join(sizes, "cluster")
        .withColumn("own", own)
        .withColumn("peer", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("own", "peer"))
        .withColumn("high", F.greatest("own", "peer"))
        .drop("blocks", "peer", "set_key")
    )

    def compare(group: pa.Table) -> pa.Table:
        shared.give_back()
        group = group.sort_by("node").combine_chunks()
        cross = group["low"][0].as_py() != group["high"][0].as_py()
        links = _spanning(group, percent, np.asarray(group["own"]) if cross else None)
        return pa.table({"node": pa.array([a for a, _ in links], pa.int64()), "other": pa.array([b for _, b in links], pa.int64())})

    return dealt.groupBy("cluster", "low", "high").applyInArrow(compare, "node bigint, other bigint")


def _spanning(group: pa.Table, percent: int, side: np.ndarray | None) -> list[tuple[int, int]]:
    """Verified links that connect components of the group; with ``side``, between two blocks only."""
    n = group.num_rows
    close = np.triu(np.ones((n, n), bool), 1)
    if side is not None:
        close &= side[:, None] != side[None, :]
    for k in range(ORDERS):
        prefixes = [np.frombuffer(p.as_py(), np.uint64) for p in group[f"prefix{k}"]]
        token = np.concatenate(prefixes)
        owner = np.repeat(np.arange(n), [len(p) for p in prefixes])
        order = np.argsort(token, kind="stable")
        token, owner = token[order], owner[order]
        edges = np.append(np.flatnonzero(np.append(True, token[1:] != token[:-1])), len(token))
        meet = np.zeros((n, n), bool)
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if b - a > 1:
                meet[np.ix_(owner[a:b], owner[a:b])] = True
        close &= meet
    size = np.asarray(group["n_shingles"])
    close &= 100 * np.minimum(size[:, None], size) >= percent * np.maximum(size[:, None], size)
    grams = [np.frombuffer(g.as_py(), np.uint64) for g in group["grams"]]
    nodes = group["node"].to_pylist()
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while x in up:
            x = up[x]
        return x

    links = []
    label = group["label"].to_pylist()
    for a, b in np.argwhere(close).tolist():
        one, two = top(label[a]), top(label[b])
        if one != two:
            both = len(np.intersect1d(grams[a], grams[b], assume_unique=True))
            if 100 * both >= percent * (size[a] + size[b] - both):
                up[max(one, two)] = min(one, two)
                links.append((nodes[a], nodes[b]))
    return links


def _same_id(rows: DataFrame) -> DataFrame:
    """Links of the sets of documents that share an id, each with the smallest of them."""
    own = rows.where("doc_id is not null and set_key is not null").select("doc_id", "node")
    shared_ids = shared.settled(
        own.groupBy("doc_id")
        .agg(F.min("node").alias("other"), F.max("node").alias("most"), F.count(F.lit(1)).alias("size"))
        .where("other < most")
        .drop("most")
    )
    if shared_ids.isEmpty():
        return shared_ids.select(F.col("other").alias("node"), "other")
    return shared.attach(own, shared_ids, "doc_id", "size").where("node > other").select("node", "other").distinct()


def similarity_components(sets: DataFrame, given: DataFrame, percent: int) -> DataFrame:
    """``node`` and ``root`` of every set that is linked to a smaller one; ``sets`` has one row per set.

    ``given`` are links (node, other) that hold besides similarity.
    """
    lists = shared.settled(_lists(sets).where("token is not null"))
    stars = shared.settled(_linked(_stars(lists, percent), sets, percent).unionByName(given))
    roots = components(stars)
    clusters = shared.settled(_clusters(lists, roots))
    return components(stars.unionAll(_block_links(sets, clusters, percent)))


def _components(classes: DataFrame, roots: DataFrame) -> DataFrame:
    """``classes`` with ``component_id``, the smallest document id of all sets linked to its own."""
    joined = shared.settled(
        classes.join(roots, "node", "left").select(classes.columns + [F.coalesce("root", "node").alias("root")])
    )
    members = joined.groupBy("root").agg(F.min("class_id").alias("component_id"), F.count(F.lit(1)).alias("size"))
    return shared.attach(joined, members, "root", "size").drop("root", "size", "node")


def jaccard_join(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Per document: ``n_shingles``, ``component_id``, and ``class_id``, the smallest equal one's id."""
    frame, parts = exchange.blocked(docs)
    prefixed = _prefixed(frame, _counted(frame, parts, n), parts, n, percent)
    rows = shared.stored(prefixed, "sets").withColumn("node", F.xxhash64("set_key"))
    classes = (
        rows.where("set_key is not null")
        .groupBy("set_key", "node")
        .agg(F.min("doc_id").alias("class_id"), F.sum("copies").alias("copies"))
    )
    sets = shared.stored(
        rows.where("grams is not null")
        .dropDuplicates(["set_key"])
        .drop("doc_id", "copies"),
        "leaders",
    )
    classes = _components(classes, similarity_components(sets, _same_id(rows), percent))
    spread = exchange.spread(rows.select("doc_id", "copies", "n_shingles", "set_key"))
    return shared.attach(spread, classes, "set_key", "copies").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
    )
