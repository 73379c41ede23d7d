"""Line deduplication by a deletion-neighbourhood join, with DataFrame functions only.

A line is the text between line ends, taken as its words (runs of other than ASCII white space). The
edit bound is one word: inserted, deleted or replaced. A line goes if an earlier one (by document id,
then line number) has the same words or, where both have ``MIN_WORDS`` words or more, is within the
bound; all is judged on the input.

1. Lines with equal words are one class, with the place of its earliest line.
2. Two classes within the bound share their first or their last half, less a word. Only classes that
   share such a half with another one go on. This drops no pair: it spares lines without any partner
   their variants.
3. Those classes emit every variant with one word deleted, and themselves, as hashed keys: a sum of
   word hashes times random factors of their places, so that running sums over a line give all of its
   variants at once, however long it is.
4. Equal keys meet. Lines within the bound share a variant of the same place (a word replaced), or
   one's variant is the other line. So the earliest partner is a minimum over such groups: groups are
   never paired out, and a very common variant costs one row per line.
5. The partner found is verified word by word.

Defined cases: a null text stays null; blank lines stay and match nothing; rows without id come after
all others; rows that agree in id and text keep the same lines and don't remove each other's; a text
that loses all lines becomes empty, and its row stays; extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fraudspark.llm import shared

MIN_WORDS = 8
BLANKS = " \t\r\x0b\x0c"
PRIME = 2**31 - 1
LAST = 2**63 - 1
#: A line's class: two hashes of its words.
CLASS = ["h1", "h2"]
PLACE = ["ord", "row", "line_no"]


def _words(line: Column) -> Column:
    return F.split(F.btrim(line, F.lit(BLANKS)), "[ \\t\\x0B\\f\\r]+")


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents with the order of their row and a hash of the text; both identify the row."""
    return docs.withColumns(
        {"ord": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)), "row": F.xxhash64("text")}
    )


def _exploded(keyed: DataFrame) -> DataFrame:
    """Every line that isn't blank: its place, words, class and number of words."""
    lines = keyed.select("ord", "row", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return (
        lines.where(F.btrim("line", F.lit(BLANKS)) != "")
        .withColumn("words", _words(F.col("line")))
        .select(
            *PLACE,
            "words",
            F.size("words").alias("n"),
            F.xxhash64("words").alias("h1"),
            F.xxhash64(F.lit("second"), "words").alias("h2"),
        )
    )


def _halves() -> Column:
    """Keys of the first and last words: half of them less one, for this length and one more."""

    def key(count: Column, tail: bool) -> Column:
        part = F.slice("words", F.col("n") - count + 1, count) if tail else F.slice("words", F.lit(1), count)
        return F.xxhash64(F.lit("tail" if tail else "head"), count, part)

    counts = [F.floor((F.col("n") - 1) / 2).cast("int"), F.floor(F.col("n") / 2).cast("int")]
    keys = F.array_distinct(F.array(*[key(c, tail) for c in counts for tail in (False, True)]))
    return F.when(F.col("n") >= MIN_WORDS, keys)


def _survivors(lines: DataFrame) -> DataFrame:
    """Classes that share a half with another class."""
    keys = lines.select(*CLASS, F.explode("halves").alias("half"))
    shared_halves = (
        keys.groupBy("half").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a < b").select("half")
    )
    return keys.join(shared_halves, "half", "left_semi").select(*CLASS).distinct()


def _random(seed: int, *of: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *of), F.lit(PRIME))


def _variants(words: DataFrame) -> DataFrame:
    """All lines with one word deleted (``gone``: its place), and whole (``gone`` -1), as hashed keys.

    Deleting place i leaves earlier words where they are and moves later ones back by one.
    """
    spread = words.select(*CLASS, "n", F.posexplode("words").alias("at", "word"))
    here, back, running, total = {}, {}, {}, {}
    line = W.partitionBy(*CLASS)
    so_far = line.orderBy("at").rowsBetween(W.unboundedPreceding, W.currentRow)
    for k in (1, 2):
        word = _random(k, F.col("word"))
        here[f"here{k}"] = F.pmod(word * _random(10 + k, F.col("at")), F.lit(PRIME))
        back[f"back{k}"] = F.pmod(word * _random(10 + k, F.col("at") - 1), F.lit(PRIME))
    spread = spread.withColumns(here | back).drop("word")
    for k in (1, 2):
        running[f"before{k}"] = F.sum(f"here{k}").over(so_far) - F.col(f"here{k}")
        running[f"after{k}"] = F.sum(f"back{k}").over(line) - F.sum(f"back{k}").over(so_far)
        total[f"key{k}"] = F.pmod(F.sum(f"here{k}"), F.lit(PRIME))
    spread = spread.withColumns(running)
    deleted = spread.select(
        *CLASS,
        *[F.pmod(F.col(f"before{k}") + F.col(f"after{k}"), F.lit(PRIME)).alias(f"key{k}") for k in (1, 2)],
        (F.col("n") - 1).alias("left"),
        F.col("at").alias("gone"),
    )
    whole = spread.groupBy(*CLASS, "n").agg(*[c.alias(name) for name, c in total.items()])
    return deleted.unionByName(
        whole.select(*CLASS, "key1", "key2", F.col("n").alias("left"), F.lit(-1).alias("gone"))
    )


def _partners(variants: DataFrame, classes: DataFrame) -> DataFrame:
    """The earliest class within the bound of each class, where that is an earlier one."""
    key = ["key1", "key2", "left"]
    met = variants.groupBy(*key).agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a < b").select(*key)
    first = F.struct(*PLACE, *CLASS)
    met = shared.stored(
        variants.join(met, key, "left_semi").join(classes, CLASS).select(*key, "gone", first.alias("own")), "variants"
    )
    same = met.where("gone >= 0").groupBy(*key, "gone").agg(F.min("own").alias("replaced"))
    any_of = met.groupBy(*key).agg(
        F.min(F.when(F.col("gone") < 0, F.col("own"))).alias("whole"),
        F.min(F.when(F.col("gone") >= 0, F.col("own"))).alias("longer"),
    )
    found = (
        met.join(any_of, key)
        .join(same, [*key, "gone"], "left")
        .select("own", F.when(F.col("gone") < 0, F.col("longer")).otherwise(F.least("replaced", "whole")).alias("other"))
        .where("other < own")
    )
    return found.groupBy("own").agg(F.min("other").alias("other"))


def _within_one(a: Column, b: Column) -> Column:
    """Whether two word lists differ by one word replaced, inserted or deleted, or not at all."""
    differ = F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y))
    at = F.array_position(differ, True).cast("int")
    rest = F.greatest(F.size(a), F.size(b))

    def tail(words: Column, start: Column) -> Column:
        return F.slice(words, start, rest + 1)

    return (
        F.when(at == 0, True)
        .when(F.size(a) == F.size(b), tail(a, at + 1) == tail(b, at + 1))
        .when(F.size(a) == F.size(b) + 1, tail(a, at + 1) == tail(b, at))
        .when(F.size(a) + 1 == F.size(b), tail(a, at) == tail(b, at + 1))
        .otherwise(False)
    )


def _near(keyed: DataFrame, lines: DataFrame, classes: DataFrame) -> DataFrame:
    """Classes with an earlier class within the bound."""
    wanted = shared.stored(classes.join(_survivors(lines), CLASS), "survivors")
    texts = keyed.select("ord", "row", "text").join(wanted.select("ord", "row").distinct(), ["ord", "row"], "left_semi")
    words = shared.stored(
        _exploded(texts).join(wanted.select(*PLACE, *CLASS), [*PLACE, *CLASS], "left_semi").dropDuplicates(CLASS),
        "words",
    )
    pairs = _partners(_variants(words), wanted)
    side = words.select(*CLASS, "words")
    return (
        pairs.select(
            F.col("own.h1").alias("h1"),
            F.col("own.h2").alias("h2"),
            F.col("other.h1").alias("o1"),
            F.col("other.h2").alias("o2"),
        )
        .join(side, CLASS)
        .join(side.toDF("o1", "o2", "other_words"), ["o1", "o2"])
        .where(_within_one(F.col("words"), F.col("other_words")))
        .select(*CLASS, F.lit(True).alias("near"))
    )


def removed_lines(docs: DataFrame) -> DataFrame:
    """``ord``, ``row`` and ``gone``, the numbers of the lines that go, of rows that lose any."""
    keyed = _keyed(docs.select("doc_id", "text"))
    lines = shared.stored(_exploded(keyed).withColumn("halves", _halves()).drop("words"), "lines")
    classes = (
        lines.groupBy(*CLASS)
        .agg(F.min(F.struct(*PLACE)).alias("first"), F.count(F.lit(1)).alias("copies"))
        .select(*CLASS, "first.*", "copies")
    )
    near = _near(keyed, lines, classes.drop("copies"))
    hit = (
        classes.join(near, CLASS, "left")
        .where("copies > 1 or near")
        .select(
            F.struct(*CLASS).alias("class"),
            F.struct(*PLACE).alias("first"),
            "copies",
            F.coalesce("near", F.lit(False)).alias("near"),
        )
    )
    placed = shared.attach(lines.select(*PLACE, F.struct(*CLASS).alias("class")), shared.stored(hit, "classes"), "class", "copies")
    # Rows that agree in id and text have the same places, so none of them is later than the other.
    gone = placed.where("first is not null").where(
        F.col("near") | (F.struct("ord", "line_no") > F.struct(F.col("first.ord"), F.col("first.line_no")))
    )
    return gone.groupBy("ord", "row").agg(F.collect_set("line_no").alias("gone"))


def remove_repeated_lines(docs: DataFrame) -> DataFrame:
    """The documents with ``text`` reduced to the lines that stay, and ``n_lines``, ``n_removed``."""
    gone = removed_lines(docs)
    keyed = docs.withColumns(
        {"__ord": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)), "__row": F.xxhash64("text")}
    )
    joined = keyed.join(gone.toDF("__ord", "__row", "__gone"), ["__ord", "__row"], "left")
    lines = F.split("text", "\n")
    kept = F.array_join(F.filter(lines, lambda line, k: ~F.array_contains("__gone", k)), "\n")
    columns = [F.when(F.col("__gone").isNull(), F.col("text")).otherwise(kept).alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_removed")]
    return joined.select(
        *columns,
        F.coalesce(F.size(lines), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("bigint").alias("n_removed"),
    )


def digest(docs: DataFrame) -> DataFrame:
    kept = remove_repeated_lines(docs.select("doc_id", "text"))
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return kept.select(
        "doc_id",
        F.when(F.col("text").isNull(), 0).otherwise(F.col("n_lines")).cast("bigint").alias("n_lines"),
        F.when(F.col("text").isNull(), 0).otherwise(F.col("n_removed")).cast("bigint").alias("n_removed"),
        F.sha2(text, 256).alias("kept_sha256"),
    )


SQL = f"""
WITH lines AS (
  SELECT doc_id, u.k - 1 AS line_no, u.line AS line,
         list_filter(string_split_regex(u.line, '[ \\t\\x0B\\f\\r]+'), lambda x: x <> '') AS w
  FROM (SELECT doc_id, unnest(list_transform(string_split(text, chr(10)), lambda x, i: {{'k': i, 'line': x}})) AS u
        FROM documents)),
classes AS (
  SELECT w, len(w) AS n, min({{'d': doc_id, 'l': line_no}}) AS first FROM lines WHERE len(w) > 0 GROUP BY w),
deleted AS (
  SELECT w, first, i - 1 AS gone, n - 1 AS rest, list_concat(w[1:i - 1], w[i + 1:n]) AS key
  FROM classes, unnest(range(1, n + 1)) AS t(i) WHERE n >= {MIN_WORDS}),
replaced AS (SELECT key, gone, min(first) AS m FROM deleted GROUP BY key, gone HAVING count(*) > 1),
longer AS (SELECT key, min(first) AS m FROM deleted GROUP BY key),
near AS (
  SELECT DISTINCT w FROM (
    SELECT d.w FROM deleted d JOIN replaced r ON d.key = r.key AND d.gone = r.gone WHERE r.m < d.first
    UNION ALL
    SELECT d.w FROM deleted d JOIN classes c ON d.key = c.w WHERE c.n >= {MIN_WORDS} AND c.first < d.first
    UNION ALL
    SELECT c.w FROM classes c JOIN longer g ON g.key = c.w WHERE c.n >= {MIN_WORDS} AND g.m < c.first)),
judged AS (
  SELECT l.doc_id, l.line_no, l.line,
         len(l.w) > 0 AND (n.w IS NOT NULL OR {{'d': l.doc_id, 'l': l.line_no}} > c.first) AS gone
  FROM lines l LEFT JOIN classes c ON l.w = c.w LEFT JOIN near n ON l.w = n.w)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INTEGER)) AS BIGINT) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
UNION ALL
SELECT doc_id, 0, 0, sha256('') FROM documents WHERE text IS NULL"""
