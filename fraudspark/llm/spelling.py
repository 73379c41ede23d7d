"""Spelling variants: words one edit apart, found by walking a distributed trie level by level.

The trie is a table of edges between prefixes, which go by 64-bit hashes. It holds every word twice,
forwards and backwards, and keeps the nodes at which words part; an edge carries the letters down to
the next such node, or to the end of its only word. A walk is a row (word, position, node, edits). Of
two words one edit apart, the shorter one, or the one with the smaller letter, looks for the other;
both share the first half of the one that looks, or else the rest of it from the end. So its walks
start with no edit at the nodes of its own path in the second half, forwards and backwards, where few
words are left. The first join with the edges spends the edit on a letter replaced or inserted, and
every level after it joins the one edge that begins with the walk's next letter. A walk goes on only
where the edge's letters agree with the word's and the node below has an edge for the letter after
them (edges carry the letters of that node as bits). A walk that reaches the end of a word has found a
neighbour; the others form the next level's frontier, until it is empty. Levels are parting nodes,
not letters, so long words need no more of them.

Counting is native and combined before the shuffle. Nodes that many words pass are salted by the
number of their words; a node has at most one edge per letter.

Defined cases: null and empty texts have no words; a null doc_id is the empty text in the key of the
deletion; repeated rows count again. Of equally frequent near words the smallest in code-point order
is the form. Tables without words of the kind give no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudspark.llm import shared, words

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DELETE_EVERY, LEAST_LENGTH, LEAST_COUNT, FORM_TIMES = 31, 7, 2, 10
#: Words of a node that one salt of it serves.
NODE_WORDS = 20_000
#: Code points that a task works on at once.
_POINTS = 1 << 18
#: Number of a letter: a-z from 0 and À-ÿ from 64, so that two longs hold a set; and of a word's end.
_OTHERS, _END = 64, 62

STEPS = "id bigint, back boolean, depth int, node bigint, letter int"


def occurrences(docs: DataFrame) -> DataFrame:
    """``word`` and ``n`` of the words that remain after the keyed deletions."""
    runs = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{LEAST_LENGTH},}}"), F.lit(0))
    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(runs).alias("run"))
    found = found.select("doc", F.translate("run", UPPER, LOWER).alias("run"))
    hashed = found.select("run", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.pmod(F.col("h"), F.char_length("run").cast("bigint")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    word = F.when(F.pmod(F.col("h"), F.lit(DELETE_EVERY)) == 0, shorter).otherwise(F.col("run"))
    counted = hashed.select(word.alias("word")).where(F.char_length("word") >= LEAST_LENGTH).groupBy("word")
    return counted.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


def _hashed_prefixes(texts: list[str], low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every word and depth from the given one on: word index, depth, node and next letter."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
    lengths = np.array([len(t) for t in texts], np.int64)
    first = np.concatenate([[0], np.cumsum(lengths)])
    each = lengths - low + 1
    owner = np.repeat(np.arange(len(texts)), each)
    depth = np.arange(len(owner)) - np.repeat(np.cumsum(each) - each - low, each)
    place = np.arange(len(points)) - np.repeat(first[:-1], lengths)
    values = words.mix(points.astype(np.uint64), 21) * words.powers(words._BASE, int(lengths.max()))[place]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    node = words.mix(sums[first[owner] + depth] - sums[first[owner]] + words.mix(depth.astype(np.uint64), 22), 23)
    letters = np.where(points < 128, points - ord("a"), points - ord("À") + _OTHERS)
    after = np.append(letters, 0)[first[owner] + depth]
    return owner, depth, node, np.where(depth == lengths[owner], _END, after)


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch["id"].to_numpy(), batch["word"].to_pylist()
        ends = np.cumsum([len(t) for t in texts])
        begin = 0
        while begin < len(texts):
            most = (ends[begin - 1] if begin else 0) + _POINTS
            end = max(begin + 1, int(np.searchsorted(ends, most, side="right")))
            for back in (False, True):
                part = [t[::-1] for t in texts[begin:end]] if back else texts[begin:end]
                lengths = np.array([len(t) for t in part], np.int64)
                # Where the shortest word that looks for this one may start.
                low = lengths // 2 if back else (lengths - 1) // 2
                owner, depth, node, after = _hashed_prefixes(part, low)
                if back:
                    node = words.mix(node, 24)
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": pa.array(ids[begin:end][owner]),
                        "back": pa.array(np.full(len(owner), back)),
                        "depth": pa.array(depth.astype(np.int32)),
                        "node": pa.array(node.view(np.int64)),
                        "letter": pa.array(after.astype(np.int32)),
                    }
                )
            begin = end


def _oriented() -> Column:
    return F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word"))


def _after(text: Column, start: Column | int) -> Column:
    """The text from a position, counted from 1, to its end."""
    return F.substring(text, F.lit(start) if isinstance(start, int) else start, F.char_length(text))


def _letter(text: Column) -> Column:
    """Number of the first letter of a text, or of its end."""
    point = F.ascii(text)
    return F.when(text == "", _END).when(point < 128, point - ord("a")).otherwise(point - ord("À") + _OTHERS)


def _holds(letter: Column) -> Column:
    """Whether the node below an edge has an edge for the letter."""
    return F.when(letter < _OTHERS, F.getbit("low", letter)).otherwise(F.getbit("high", letter - _OTHERS)) == 1


def _salts() -> Column:
    return F.ceil(F.col("words") / NODE_WORDS)


def trie(counted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of a stored table ``id, word, n``: every word at each parting node of its path, and the edges.

    An edge has its node and the number of ``words`` there, its first ``letter``, all its letters
    (``label``), and the node it leads to (``child, child_words`` and its letters ``low, high``) or the
    word it ends (``leaf, leaf_n``).
    """
    steps = shared.stored(counted.select("id", "word").mapInArrow(_steps, STEPS), "trie-steps", "zstd")
    bit, none = F.expr("shiftleft(1L, letter % 64)"), F.lit(0).cast("bigint")
    parting = shared.stored(
        steps.groupBy("node")
        .agg(
            F.bit_or(F.when(F.col("letter") < _OTHERS, bit).otherwise(none)).alias("low"),
            F.bit_or(F.when(F.col("letter") >= _OTHERS, bit).otherwise(none)).alias("high"),
            F.count(F.lit(1)).alias("words"),
        )
        .where(F.bit_count("low") + F.bit_count("high") > 1),
        "trie-nodes",
        "zstd",
    )
    kept = shared.attach(steps, parting, "node", "words").where(F.col("words").isNotNull())
    below = Window.partitionBy("id", "back").orderBy("depth")
    ahead = {f"next_{c}": F.lead(c).over(below) for c in ("node", "depth", "words", "low", "high")}
    placed = shared.stored(kept.join(counted, "id").withColumns(ahead).drop("low", "high"), "trie-words", "zstd")
    known = [F.col("next_node").alias("child"), F.col("next_words").alias("child_words"), F.col("next_low").alias("low"), F.col("next_high").alias("high")]
    inner = placed.where("next_node IS NOT NULL").select(
        "node", "words", "letter",
        F.substring(_oriented(), F.col("depth") + 1, F.col("next_depth") - F.col("depth")).alias("label"), *known,
        F.lit(None).cast("string").alias("leaf"), F.lit(None).cast("bigint").alias("leaf_n"),
    )
    ends = placed.where("next_node IS NULL").select(
        "node", "words", "letter", _after(_oriented(), F.col("depth") + 1).alias("label"), *known,
        F.col("word").alias("leaf"), F.col("n").alias("leaf_n"),
    )
    return placed, shared.stored(inner.distinct().unionByName(ends), "trie-edges", "zstd")


def _fits(mine: Column, letters: Column) -> Column:
    """Whether an edge's letters, all or the rest of them, are the next of a walk, and more can follow."""
    on = F.startswith(mine, letters) & _holds(_letter(F.substring(mine, F.char_length(letters) + 1, F.lit(1))))
    return F.when(F.col("leaf").isNotNull(), mine == letters).otherwise(on)


def _moved(met: DataFrame, skips: Column, letters: Column) -> DataFrame:
    return met.select(
        "word", "n", "back", (F.col("pos") + skips + F.char_length(letters)).alias("pos"), F.lit(1).alias("edits"),
        F.col("child").alias("node"), F.col("child_words").alias("words"), "leaf", "leaf_n",
    )


def _spend(walks: DataFrame, edges: DataFrame) -> DataFrame:
    """The first level: walks leave their own path by a letter replaced or inserted."""
    salt = F.explode(F.sequence(F.lit(0).cast("bigint"), _salts() - 1)).alias("salt")
    spread = edges.where("label <> ''").withColumn("tail", _after(F.col("label"), 2)).select("*", salt).drop("words", "label")
    rest = _after(_oriented(), F.col("pos") + 1)
    salted = walks.select(
        "word", "n", "back", "pos", "edits", F.col("letter").alias("own"), "node", F.pmod(F.xxhash64("word"), _salts()).alias("salt"),
        rest.alias("rest"), _after(rest, 2).alias("skipped"),
    )
    inserted = _fits(F.col("rest"), F.col("tail"))
    replaced = (F.col("letter") > F.col("own")) & (F.col("rest") != "") & _fits(F.col("skipped"), F.col("tail"))
    met = salted.join(spread, ["node", "salt"]).where((F.col("letter") != F.col("own")) & (inserted | replaced))
    skips = F.array_compact(F.array(F.when(inserted, 0), F.when(replaced, 1)))
    return _moved(met.withColumn("skips", F.explode(skips)), F.col("skips"), F.col("tail"))


def _follow(walks: DataFrame, edges: DataFrame) -> DataFrame:
    """A later level: walks with an edit go on along the edge of their next letter."""
    rest = _after(_oriented(), F.col("pos") + 1)
    salted = walks.select("word", "n", "back", "pos", "edits", "node", rest.alias("rest"), _letter(rest).alias("letter"))
    met = salted.join(edges.drop("words"), ["node", "letter"]).where(_fits(F.col("rest"), F.col("label")))
    return _moved(met, F.lit(0), F.col("label"))


def neighbours(placed: DataFrame, edges: DataFrame) -> DataFrame:
    """``word``, ``near`` and ``near_n``: for every word each word one edit away, once."""
    half = F.floor(F.char_length("word") / 2).cast("int")
    start = F.when(F.col("back"), F.char_length("word") - half).otherwise(half)
    walks = placed.where(F.col("depth") >= start).select(
        "word", "n", "back", F.col("depth").alias("pos"), F.lit(0).alias("edits"), "node", "words", "letter"
    )
    # Words that share the first half of the one that looks are found forwards, all others backwards.
    apart = F.substring("word", F.lit(1), half) != F.substring("leaf", F.lit(1), half)
    once = F.when(F.col("back"), apart).otherwise(F.lit(True)) & (F.levenshtein("word", "leaf", 1) == 1)
    found, step = [], _spend
    while True:
        level = shared.stored(step(walks, edges), "trie-walks", "zstd")
        pairs = level.where(F.col("leaf").isNotNull() & once)
        found.append(pairs.select("word", F.col("leaf").alias("near"), F.col("leaf_n").alias("near_n")))
        found.append(pairs.select(F.col("leaf").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))
        walks, step = level.where(F.col("leaf").isNull()).drop("leaf", "leaf_n"), _follow
        if walks.isEmpty():
            return functools.reduce(DataFrame.unionAll, found)


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of a table ``word, form``: every link doubled until none changes."""
    known = shared.stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = known.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = shared.stored(known.join(ahead, "root", "left").select("word", "root", "further"), "roots")
        known = longer.select("word", F.coalesce("further", "root").alias("root"))
        if longer.where(F.col("further").isNotNull()).isEmpty():
            return known


def variants(docs: DataFrame, form_times: int = FORM_TIMES) -> DataFrame:
    """One row per word: its count, near words, form and root."""
    counted = shared.stored(occurrences(docs).select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")
    near = neighbours(*trie(counted))
    first = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("word"))).alias("first")
    groups = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), first)
    most = -F.col("first.minus")
    formed = most >= F.col("n") * form_times
    joined = shared.stored(
        counted.join(groups, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(formed, F.col("first.word")).alias("form"), F.when(formed, most).alias("form_n"),
        ),
        "variants",
    )
    last = roots(joined.where(F.col("form").isNotNull()))
    return joined.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


SQL = f"""
WITH RECURSIVE steps(i, k, c) AS (
    SELECT i, 0, i FROM range(256) r(i) UNION ALL
    SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS tab FROM steps WHERE k = 8),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc,
         translate(unnest(regexp_extract_all(text, '[{LETTERS}]+')), '{UPPER}', '{LOWER}') AS run FROM documents),
bytes AS (SELECT *, hex(encode(doc || ':' || run)) AS x FROM (SELECT doc, run, count(*) AS times FROM runs GROUP BY ALL)),
hashed AS (SELECT run, times, xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)]))) AS h FROM bytes, crc),
cut AS (SELECT times, CASE WHEN h % {DELETE_EVERY} = 0
        THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
w AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM cut WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(times) >= {LEAST_COUNT}),
gaps AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS gap FROM w, range(1000) r(i) WHERE i < length(word)),
pairs AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b ON a.gap = b.gap AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM gaps a JOIN w b ON a.gap = b.word
    UNION SELECT b.word, a.word, a.n FROM gaps a JOIN w b ON a.gap = b.word),
best AS (SELECT word, count(*) AS n_near, min(near_n * -1) AS minus FROM pairs GROUP BY word),
chosen AS (SELECT best.word, n_near, -minus AS most, min(near) AS near FROM best JOIN pairs ON best.word = pairs.word AND near_n = -minus GROUP BY ALL),
f AS (SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= {FORM_TIMES} * n THEN near END AS form,
      CASE WHEN most >= {FORM_TIMES} * n THEN most END AS form_n FROM w LEFT JOIN chosen USING (word)),
links(word, root) AS (SELECT word, word FROM f UNION SELECT links.word, f.form FROM links JOIN f ON links.root = f.word WHERE form IS NOT NULL),
ends AS (SELECT links.word, root FROM links JOIN f ON links.root = f.word WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM f JOIN ends USING (word)"""
