"""The pipeline against its stages' plain readings, and the registration of the queries."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import sentencepiece

import corpus_pipeline
from fraudspark.llm import language_id, queries
from tests.llm.corpus import prose
from tests.llm.test_exact import linked_components, near_lines, terms


def documents() -> list[tuple]:
    rng = random.Random(4)
    made = [prose(rng, 120) for _ in range(30)]
    made += [made[0], made[1] + " tail", "12 34", None, "", made[2].split("\n")[0] + "\n" + prose(rng, 90)]
    return [(i, t, "en" if i % 2 else "de", "s", len(t or "")) for i, t in enumerate(made)]


def plain_lines(rows: dict[int, str]) -> dict[int, str]:
    seen: dict[tuple, tuple] = {}
    lines = [(i, k, x) for i, t in sorted(rows.items()) for k, x in enumerate(t.split("\n"))]
    for i, k, x in lines:
        seen.setdefault(tuple(x.encode().split()), (i, k))
    out = {}
    for i, t in rows.items():
        kept = []
        for k, x in enumerate(t.split("\n")):
            own = tuple(x.encode().split())
            earlier = own and any(at < (i, k) and near_lines(list(w), list(own)) for w, at in seen.items() if w)
            if not earlier:
                kept.append(x)
        out[i] = "\n".join(kept)
    return out


def test_pipeline(spark, tmp_path):
    rows = documents()
    items = [(1, " ".join(rows[7][1].split()[40:60])), (2, "not in any document at all")]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    first = corpus_pipeline.identify_language(spark, docs, str(tmp_path))
    assert first.columns == docs.columns
    model = language_id.fitted(docs)
    known = {r["doc_id"]: r["text"] for r in first.collect()}
    assert {34, 33, 32}.isdisjoint(known) and model.langs == ["de", "en"] and len(known) == len(rows) - 3
    reduced = plain_lines(known)
    component = linked_components(sorted(reduced.items()))
    alone = {i: t for i, t in reduced.items() if component[i] == i}
    windows = {tuple(w[k : k + 10]) for _, t in items if (w := terms(t)) for k in range(max(1, len(w) - 9))}
    clean = {
        i: t
        for i, t in alone.items()
        if not any(tuple(terms(t)[k : k + len(w)]) == w for w in windows for k in range(len(terms(t))))
    }
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    expected = {}
    for i, t in clean.items():
        ids = library.encode(t, add_bos=True, add_eos=True)
        expected[i] = (ids, hashlib.sha256(library.decode(ids).encode()).hexdigest())
    found = {r["doc_id"]: (r["ids"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert found == expected
    assert 7 not in found and len(found) < len(known)


def test_every_operator_has_a_query():
    assert {f"op{n}" for n in range(1, 11)} | {"pipeline"} == {name.split("_")[0] for name in queries.QUERIES}
    assert set(queries.ORACLES) == {"op6_exact_dedup", "op9_line_dedup", "op10_sharding"}
