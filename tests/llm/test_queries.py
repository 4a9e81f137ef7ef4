"""Every named query against plain rules, a library, or SQL, over whole tables."""

import math
import os
import re
from pathlib import Path

import duckdb
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer, models, pre_tokenizers

import corpus_pipeline
from gleanset.llm.queries import llm_queries
from gleanset.llm.sql import llm_oracles

from . import plain

SF = Path(os.environ.get("LLM_TEST_DIR", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables")


def rows(name, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{SF}/{name}.parquet'").fetchall()


def run(spark, name):
    return llm_queries()[name](spark, str(SF)).collect()


@pytest.mark.parametrize("name", list(llm_oracles()))
def test_sql(spark, name):
    db = duckdb.connect()
    for path in SF.glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    cursor = db.execute(llm_oracles()[name])
    head = sorted(range(len(cursor.description)), key=lambda i: cursor.description[i][0])
    want = sorted((tuple(r[i] for i in head) for r in cursor.fetchall()), key=repr)
    frame = llm_queries()[name](spark, str(SF))
    assert sorted(frame.columns) == [cursor.description[i][0] for i in head]
    got = sorted((tuple(r) for r in frame.select(*sorted(frame.columns)).collect()), key=repr)
    assert got == want


def test_substring_dedup(spark):
    documents = rows("documents", "doc_id, text")
    split, kept = plain.repeats([t for _, t in documents])
    want = {
        k: (len(w), len(w) - len(x), plain.sha(" ".join(x)))
        for (k, _), w, x in zip(documents, split, kept)
    }
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in run(spark, "op1_substring_dedup")}
    assert got == want
    assert any(n for _, n, _ in want.values())


def test_warc(spark):
    want = plain.archive_rows(rows("pages", "page_id, html"))
    got = {
        r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
        for r in run(spark, "op4_warc")
    }
    assert got == want


def test_embedding_dedup(spark):
    want = plain.vector_links(rows("embeddings", "vec_id, embedding"))
    found = run(spark, "op5_embedding_dedup")
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_decontamination(spark):
    want = plain.leaks(rows("documents", "doc_id, text"), rows("benchmark", "item_id, text"))
    got = {(r.doc_id, r.item_id): r.score for r in run(spark, "op6_decontamination")}
    assert got == pytest.approx(want)
    assert got


def test_minhash(spark):
    want = plain.near_copies(rows("documents", "doc_id, text"), 4)
    found = run(spark, "op7_minhash")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_language_id(spark):
    languages = dict(rows("documents", "doc_id, lang"))
    found = run(spark, "op8_language_id")
    assert {r.doc_id for r in found} == set(languages)
    assert all(r.held_out == plain.held_out(r.doc_id) for r in found)
    assert all(0 <= r.score <= 1 for r in found)
    apart = [r for r in found if r.held_out]
    right = sum(r.lang_pred == languages[r.doc_id] for r in apart)
    assert right >= 0.97 * len(apart)


def test_language_id_equals_the_plain_rule(spark):
    told = rows("documents", "doc_id, text, lang")
    labelled = [(t, l) for k, t, l in told if t is not None and l is not None and not plain.held_out(k)]
    want = plain.bayes(labelled, [(k, t) for k, t, _ in told])
    got = {r.doc_id: (r.lang_pred, r.score) for r in run(spark, "op8_language_id")}
    assert {k: name for k, (name, _) in got.items()} == {k: name for k, (name, _) in want.items()}
    assert {k: s for k, (_, s) in got.items()} == pytest.approx({k: s for k, (_, s) in want.items()}, abs=1e-6)


def test_token_counts(spark):
    model = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )
    pieces = [(model.id_to_piece(i), float(model.get_score(i))) for i in range(model.get_piece_size())]
    library = Tokenizer(models.Unigram(pieces, 0, True))
    library.pre_tokenizer = pre_tokenizers.Metaspace()
    want = {k: len(library.encode(t, add_special_tokens=False).ids) for k, t in rows("documents", "doc_id, text")}
    assert {r.doc_id: r.n_tokens for r in run(spark, "op9_token_counts")} == want


def test_bpe(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for k, t in rows("documents", "doc_id, text"):
        ids = library.encode(t, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[k] = (len(ids), plain.sha(",".join(map(str, ids))), plain.sha(decoded))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in run(spark, "op10_bpe")}
    assert got == want


def test_pipeline(spark):
    told = rows("documents", "doc_id, text, lang, source")
    labelled = [(t, l) for _, t, l, _ in told if t is not None and l is not None]
    scored = plain.bayes(labelled, [(k, t) for k, t, _, _ in told])
    documents = [(k, t, s) for k, t, _, s in told if scored[k][0] != "und" and scored[k][1] >= 0.4]
    by_source, pages = {}, {}
    for _, text, source in documents:
        pages[source] = pages.get(source, 0) + 1
        for line in set(text.split("\n")):
            if line.strip(" \t\r\f\v"):
                by_source[source, line] = by_source.get((source, line), 0) + 1
    bad = {k for k, n in by_source.items() if n >= 3 and 10 * n > pages[k[0]]}
    cut = [
        (k, "\n".join(x for x in t.split("\n") if (s, x) not in bad)) for k, t, s in documents
    ]
    found = plain.near_copies(cut, 5)
    alone = [(k, t) for k, t in cut if found[k][1] == k]
    leaked = {k for k, _ in plain.leaks(alone, rows("benchmark", "item_id, text"))}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {
        k: len(library.encode(t, add_special_tokens=False).ids) for k, t in alone if k not in leaked
    }
    assert leaked
    result = corpus_pipeline.run(spark, str(SF)).collect()
    assert {r.doc_id: r.n_tokens for r in result} == want
    assert all(r.round_trip for r in result)


def test_pipeline_stage_cases(spark):
    """Nulls in any column, empty and repeated rows, ties, and no rows at all, through every stage."""
    texts = ["the cat and the dog sat on the mat", "le chat et la souris dans la maison", "der hund und die katze im haus",
             "el perro y la casa de los gatos"]
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    told = [(10 * i + j, f"{t} {j} {t}", "en fr de es".split()[i], "s", 1) for i, t in enumerate(texts) for j in range(4)]
    told += [(100, None, "en", "s", 0), (101, "", None, None, None), (102, "12 !", "en", "s", 4), (103, "\u0436", None, "s", 1),
             (104, texts[0], None, None, None), (105, texts[0], "en", "s", 5), (0, told[0][1], "en", "s", 1),
             (None, texts[2], "de", None, 3)]
    frame = spark.createDataFrame(told, kind)
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language_id"](spark, frame, str(SF))
    assert kept.columns == corpus_pipeline.COLUMNS
    # Without a text, without a letter, and one letter of no learned language.
    assert {100, 101, 102, 103}.isdisjoint({r.doc_id for r in kept.collect()})
    assert kept.count() == len(told) - 4
    docs = frame
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, frame.limit(0), str(SF))
        assert empty.count() == 0
        docs = stage(spark, docs, str(SF))
        assert docs.columns == empty.columns
    out = docs.collect()
    assert {r.doc_id for r in out} >= {0, 10, 20, 30, 104, None} and all(r.round_trip for r in out)
    assert 105 not in {r.doc_id for r in out}  # a copy of 104


def test_centroids(spark):
    found = [
        (r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256)
        for r in run(spark, "op11_centroids")
    ]
    assert sorted(found, key=repr) == plain.centroid_rows(rows("embeddings", "vec_id, embedding"))


def test_merkle(spark):
    found = sorted((tuple(r) for r in run(spark, "op12_merkle")), key=repr)
    assert found == plain.merkle_rows(rows("documents", "doc_id, source, lang, n_chars, text"))
    assert {r[-1] for r in found} == {True, False}


def test_mixing(spark):
    documents = {k: (s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for k, s, t in
                 rows("documents", "doc_id, source, text")}
    sizes = {}
    for source, size in documents.values():
        sizes[source] = sizes.get(source, 0) + size
    targets = plain.mix_targets(sizes)
    found = run(spark, "op13_mixing")
    assert {r.doc_id for r in found} == set(documents)
    taken, counts, wanted = {}, {}, {}
    for r in found:
        source, size = documents[r.doc_id]
        assert (r.size, r.source_size) == (size, sizes[source])
        assert r.target == pytest.approx(targets[source])
        rate = r.target / r.source_size
        assert r.taken in {size * math.floor(rate), size * math.ceil(rate)}
        taken[source] = taken.get(source, 0) + r.taken
        counts[source] = counts.get(source, 0) + r.taken // max(size, 1)
        wanted[source] = wanted.get(source, 0) + (rate if size else 0)
    for source, words in taken.items():
        assert words == pytest.approx(targets[source], rel=0.02)
        assert counts[source] == pytest.approx(wanted[source], abs=8)  # half a landing
    assert sorted(found) == sorted(run(spark, "op13_mixing"))
