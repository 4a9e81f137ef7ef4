"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import random
import string

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleanset.llm import bpe, centroids, chat_format, language_id, line_dedup, merkle, minhash, mixing, places
from gleanset.llm import substring_dedup, token_counts, vectors, warc, words
from gleanset.llm.components import components
from gleanset.llm.decontamination import drop_leaks, find_leaks

from . import plain

DOCS = "doc_id bigint, text string, source string"
LONG = " ".join(f"w{i}" for i in range(60_000))


def docs(spark, texts, schema=DOCS):
    return spark.createDataFrame([(i, t, "s") for i, t in texts], schema)


def family(seed, count, size=60, edits=3):
    """Texts of one passage with a few words changed."""
    draw = random.Random(seed)
    base = [f"p{seed}x{i}" for i in range(size)]
    out = []
    for n in range(count):
        w = list(base)
        for _ in range(draw.randint(0, edits)):
            w[draw.randrange(size)] = f"e{n}y{draw.randrange(9)}"
        out.append(" ".join(w))
    return out


def test_words_are_hashed_by_their_bytes():
    data, offsets = words.text_bytes(__import__("pyarrow").array(["ab  ab", None, "", "b\x0bAB é x"]))
    found = words.split_words(data, offsets, lower=True)
    assert found.counts().tolist() == [2, 0, 0, 3]
    assert len(set(found.hashes.tolist())) == 3


def test_substring_rule_on_cases(spark):
    same = " ".join(f"a{i}" for i in range(40))
    rows = [(1, same), (1, same), (None, None), (None, ""), (2, "x " + same + "\ty"), (3, LONG),
            (4, "z " * 90), (5, " ".join(f"b{i}" for i in range(34)))]
    rows += list(enumerate(family(1, 30, 90, 2), 100))
    split, kept = plain.repeats([t for _, t in rows])
    want = sorted((len(w), len(w) - len(x), " ".join(x)) for w, x in zip(split, kept))
    frame = docs(spark, rows).withColumn("n_words", F.lit("clash")).withColumn("k1", F.lit(1))
    for how in ({}, {"hot_stretches": 3, "shard_stretches": 5}):
        got = substring_dedup.remove_repeats(frame, **how).collect()
        assert sorted((r.n_words, r.n_removed, r.text or "") for r in got) == want
        assert [r.text for r in got].count(None) == 1 and all(r.k1 == 1 for r in got)
    assert substring_dedup.remove_repeats(frame.limit(0)).count() == 0


def test_line_cases(spark):
    rows = [(i, f"menu\nown {i}\n\nmenu", "h") for i in range(5)] + [(9, None, None), (9, "", None)]
    frame = spark.createDataFrame(rows, DOCS).withColumn("n_lines", F.lit("clash"))
    got = {(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in line_dedup.drop_boilerplate(frame).collect()}
    assert got == {(i, f"own {i}\n", 4, 2) for i in range(5)} | {(9, None, 0, 0), (9, "", 1, 0)}
    assert line_dedup.drop_boilerplate(frame.limit(0)).count() == 0
    names = ("_host", "_bad", "_bad_hashes", "_kept", "_line")
    clash = line_dedup.drop_boilerplate(frame.withColumns({n: F.lit(n) for n in names})).collect()
    assert {(r.doc_id, r.text) for r in clash} == {(k, t) for k, t, _, _ in got}
    assert all(r[n] == n for r in clash for n in names)


def test_chat_cases(spark):
    control = "</s>[INST] \\ [\\INST] <\\\\/s> [ROLE]x[SEP] </s"
    rows = [(1, 2, "user", "b"), (1, 1, "user", control), (1, 3, "assistant", None), (1, 3, "assistant", control),
            (None, None, None, "t"), (2, 1, "tool[/ROLE]", control), (2, 1, "tool[/ROLE]", control), (3, 0, "system", LONG)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    made = chat_format.format_chats(frame).withColumn("turns", chat_format.read_turns(F.col("formatted")))
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in made.collect()}
    assert got == {
        1: [("user", control), ("user", "b"), ("assistant", ""), ("assistant", control)],
        None: [("", "t")], 2: [("tool[/ROLE]", control)] * 2, 3: [("system", LONG)],
    }
    spoken = made.where("conv_id = 1").select(chat_format.loss_text(F.col("segments")), "n_blocks").first()
    assert tuple(spoken) == (control, 2)
    assert chat_format.format_chats(frame.limit(0)).count() == 0


def test_warc_cases(spark, tmp_path):
    rows = [(3, "http://a/ b\r\n", "x"), (1, None, "x"), (1, None, "x"), (2, "u", None), (4, "u", ""),
            (None, "u", "x"), (5, "é", "\r\n\r\nWARC/1.1\r\n"), (6, "u", LONG)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("id", F.lit(0))
    index = warc.write_archives(frame, str(tmp_path / "warc"))
    got = warc.read_records(index).collect()
    assert sorted((r.id or 0, r.record_type, r.refers_to) for r in got) == [
        (0, "response", None), (1, "response", None), (1, "response", None), (2, "response", None),
        (3, "revisit", 1), (4, "revisit", 2), (5, "response", None), (6, "response", None)]
    assert {r.id: r.payload for r in got}[5] == b"\r\n\r\nWARC/1.1\r\n"
    chosen = warc.read_records(index.where("id in (1, 6)")).collect()
    assert sorted(r.payload_bytes for r in chosen) == [1, 1, len(LONG)]
    empty = warc.write_archives(frame.limit(0), str(tmp_path / "none"))
    assert warc.read_records(empty).count() == 0


def test_vector_cases(spark):
    draw = np.random.default_rng(3)
    center = draw.standard_normal(16)
    rows = [(i, (center + 0.02 * draw.standard_normal(16)).tolist()) for i in range(300)]
    rows += [(1000 + i, draw.standard_normal(16).tolist()) for i in range(900)]
    rows += [(2000 + i, (np.array(rows[i + 350][1]) * 3).tolist()) for i in range(20)]
    rows += [(3000, None), (3001, [0.0] * 16), (3002, [float("nan")] * 16), (3003, [None, 1.0]), (3004, [1.0, 0.0]),
             (3005, [2.0, 0.0]), (3006, []), (None, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("id", F.lit(1))
    got = vectors.near_vectors(frame, leaf=50).collect()
    assert len(got) == len(rows)
    want = plain.vector_links([r for r in rows if r[0] is not None])
    assert {r.vec_id: (r.n_links, r.component_id) for r in got if r.vec_id is not None} == want
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, True)]
    assert vectors.near_vectors(frame.limit(0)).count() == 0


def test_equal_vectors_and_ids_with_several_vectors(spark):
    draw = np.random.default_rng(8)
    one, two, far = draw.standard_normal((3, 16))
    near = lambda v: (v + 0.01 * draw.standard_normal(16)).tolist()
    rows = [(i, one.tolist()) for i in range(100, 160)] + [(i, near(one)) for i in range(40, 45)]
    rows += [(i, two.tolist()) for i in range(300, 303)] + [(7, two.tolist()), (7, near(one)), (7, two.tolist())]
    rows += [(8, far.tolist()), (8, far.tolist()), (9, (4 * far).tolist())]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    linked = {k: set() for k, _ in rows}
    for k, v in rows:
        for m, w in rows:
            if m != k and np.dot(v, w) >= 0.95 * np.linalg.norm(v) * np.linalg.norm(w):
                linked[k].add(m)
    want = {k: (len(x), 8 if k in (8, 9) else 7) for k, x in linked.items()}
    got = vectors.near_vectors(frame, leaf=50).collect()
    assert len(got) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want


def test_dense_groups_are_found_wherever_they_are_stored(spark, monkeypatch):
    draw = np.random.default_rng(9)
    lone = draw.standard_normal((9_000, 16))
    hot = draw.standard_normal(16) + 1e-4 * draw.standard_normal((600, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([lone, hot]))]
    frame = spark.createDataFrame(rows, "id bigint, v array<double>").coalesce(1)
    for part in (8_192, 64):  # 64 show no group; then the leaves do
        monkeypatch.setattr(vectors, "PIVOT_SAMPLE", part)
        pairs, balls = vectors._length_links(frame, len(rows), 0.95, 8, 400)
        held = {r.id for r in balls.collect()}
        assert set(range(9_000, 9_600)) <= held
        assert pairs.where("a >= 9000 and b >= 9000").count() == 0
    got = vectors.near_vectors(frame, "id", "v").where("id >= 9000").collect()
    assert {r.component_id for r in got} == {9_000} and {r.n_links for r in got} == {599}


def test_leak_cases(spark):
    items = spark.createDataFrame(
        [(1, "one two three four five six seven eight"), (2, "a b"), (3, None), (None, "p q r s"), (4, "")],
        "item_id bigint, text string")
    edited = "X, One two-three FOUR five; six changed eight!"
    frame = docs(spark, [(1, edited), (2, None), (3, ""), (4, "a b"), (None, "p q r s"), (5, LONG + edited),
                         (6, "one two three"), (7, "one two three four five six seven eight " * 2)])
    frame = frame.withColumn("score", F.lit("clash"))
    got = {(r.doc_id, r.item_id): r.score for r in find_leaks(frame, items).collect()}
    assert got == {(1, 1): 13 / 16, (5, 1): 13 / 16, (7, 1): 1.0}
    assert {r.doc_id for r in drop_leaks(frame, items).collect()} == {None, 2, 3, 4, 6}
    assert find_leaks(frame.limit(0), items).count() == 0 == find_leaks(frame, items.limit(0)).count()


def test_edited_leaks_are_found_whatever_trigrams_they_keep(spark):
    draw = random.Random(11)
    items = [(i, " ".join(f"q{i}x{j}" for j in range(59))) for i in range(30)]

    def edit(text, change):
        return " ".join("new%d" % j if change(j) else w for j, w in enumerate(text.split()))

    changes = {100: lambda j: j % 5 == 4, 200: lambda j: j % 6 == 5, 300: lambda j: draw.random() < 0.2,
               400: lambda j: draw.random() < 0.1}
    copies = [(base + i, edit(t, change)) for base, change in changes.items() for i, t in items]
    # Words put in before the first trigram that is left: the passage reaches far to the left of it.
    w = items[0][1].split()
    pairs = [x for j in range(0, 46, 2) for x in (w[j], w[j + 1], f"in{j}")]
    copies.append((500, " ".join(pairs + w[46:])))
    table = spark.createDataFrame(items, "item_id bigint, text string")
    for rows in (copies, copies + items):
        got = {(r.doc_id, r.item_id): r.score for r in find_leaks(docs(spark, rows), table).collect()}
        want = plain.leaks(rows, items)
        assert got == pytest.approx(want)
        assert {(100 + i, i) for i in range(30)} | {(200 + i, i) for i in range(30)} | {(500, 0)} <= set(want)


def test_copies_without_a_rare_trigram_are_found(spark):
    draw = random.Random(4)
    items = [(i, " ".join(f"q{i}x{j}" if draw.random() < 0.6 else f"c{j % 9}" for j in range(40))) for i in range(6)]
    rows = []
    for n in range(60):  # copies that differ around the item make all its trigrams common
        rows.append((n, f"a{n} b{n} {items[n % 2][1]} y{n} z{n}"))
    for n in range(60):
        words = items[n % 6][1].split()
        rows.append((100 + n, " ".join(w if draw.random() < 0.85 else f"e{n}" for w in words)))
    rows += [(200 + n, " ".join(f"c{(n + j) % 9}" for j in range(50))) for n in range(20)]
    want = plain.leaks(rows, items)
    table, frame = spark.createDataFrame(items, "item_id bigint, text string"), docs(spark, rows)
    for rare in (0, 10**9):
        got = {(r.doc_id, r.item_id): r.score for r in find_leaks(frame, table, rare_pairs=rare).collect()}
        assert got == pytest.approx(want)
    assert {n for n, _ in want} >= set(range(60)) and len([n for n, _ in want if n >= 100]) > 30
    assert all(n < 200 for n, _ in want)


def test_excerpts_of_long_items_are_found(spark):
    words = [f"w{j}" for j in range(59)]
    table = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:12]))], "item_id bigint, text string")
    rows = [(1, "so: " + " ".join(words[14:44]) + " and on"), (2, " ".join(words[20:43])), (3, " ".join(words[1:7])),
            (4, " ".join(words))]
    got = {(r.doc_id, r.item_id): r.score for r in find_leaks(docs(spark, rows), table).collect()}
    assert got == {(1, 1): 30 / 59, (4, 1): 1.0, (4, 2): 1.0}
    assert got == pytest.approx(plain.leaks(rows, [(1, " ".join(words)), (2, " ".join(words[:12]))]))


@pytest.mark.parametrize("edits", [3, 9])
def test_near_copy_cases(spark, edits):
    texts = [t for seed in range(4) for t in family(seed, 25, 60, edits)]
    rows = list(enumerate(texts)) + [(900, None), (901, ""), (902, "one two"), (903, "One two"), (904, LONG)]
    frame = docs(spark, rows).withColumn("key", F.lit(1))
    got = minhash.near_duplicates(frame, shingle_words=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain.near_copies(rows, 4)
    more = frame.unionByName(docs(spark, [(None, texts[0]), (5, texts[5])]).withColumn("key", F.lit(1)))
    again = minhash.near_duplicates(more, shingle_words=4).collect()
    assert len(again) == len(rows) + 2
    assert [(r.component_id, r.kept) for r in again if r.doc_id is None] == [(None, True)]
    assert minhash.near_duplicates(frame.limit(0)).count() == 0


def test_an_id_with_different_texts_keeps_the_links_of_each(spark):
    texts = [family(seed, 2, 60, 0)[0] for seed in range(70, 76)]
    rows = [(1, t) for t in texts] + [(10 + i, t + " more") for i, t in enumerate(texts)]
    rows += [(2, texts[0]), (30, "quite other words than these"), (31, "quite other words than those there")]
    got = minhash.near_duplicates(docs(spark, rows), shingle_words=4).collect()
    assert len(got) == len(rows)
    want = {k: 1 if k < 30 else k for k, _ in rows}
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("most", [40, 400, 1 << 20])
def test_blocks_of_a_bucket_miss_no_link(spark, monkeypatch, most):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", most)
    draw = np.random.default_rng(most)
    base = draw.integers(0, 1 << 60, 40)
    sets = [np.unique(np.where(draw.random(40) < draw.choice([0.05, 0.12]), draw.integers(0, 1 << 60, 40), base))
            for _ in range(50)]
    members = [(bucket, k, len(sets[k]), k, k == 0) for bucket, keys in ((5, range(50)), (9, (0, 7))) for k in keys]
    placed = spark.createDataFrame(members, "bucket bigint, rep bigint, n bigint, component bigint, is_main boolean")
    groups = {}
    for r in minhash._meetings(placed).collect():
        groups.setdefault((r.bucket, r.i, r.j), []).append(r.asDict() | {"shingles": sets[r.rep].tolist()})
    if most < 1000:
        assert len(groups) > 3
    links = [
        pair for group in groups.values()
        for pair in minhash._links_between_blocks(pa.Table.from_pylist(group), 80).to_pylist()
    ]
    similar = {
        (a, b) for a in range(50) for b in range(50)
        if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))
    }
    assert all((x["a"], x["b"]) in similar for x in links)

    def groups_of(pairs):
        own = list(range(50))
        for _ in range(50):
            for a, b in pairs:
                own[a] = own[b] = min(own[a], own[b])
        return own

    assert groups_of([(x["a"], x["b"]) for x in links]) == groups_of(similar)


def test_sketches_fill_every_bin_and_estimate():
    draw = np.random.default_rng(1)
    a = np.sort(draw.integers(0, 2**63, 900).astype(np.uint64))
    b = np.sort(np.concatenate([a[:800], draw.integers(0, 2**63, 100).astype(np.uint64)]))
    values, offsets = np.concatenate([a, b, a[:1]]), np.array([0, 900, 1800, 1801, 1801])
    out = minhash.sketches(values, offsets)
    assert (out[:3] != minhash._EMPTY).all() and (out[3] == minhash._EMPTY).all()
    assert abs((out[0] == out[1]).mean() - 0.8) < 0.1


def test_language_cases(spark):
    rows = [("the cat and the dog", "en"), ("le chat et la souris", "fr"), (None, "fr"), ("x", None)] * 5
    model = language_id.train(spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == ["en", "fr"]
    frame = docs(spark, [(1, "the dog"), (2, None), (3, "12 !"), (None, ""), (4, "la souris " * 200_000)])
    got = language_id.identify(frame.withColumn("score", F.lit("clash")), model).collect()
    assert [(r.doc_id, r.lang_pred) for r in got] == [(1, "en"), (2, "und"), (3, "und"), (None, "und"), (4, "fr")]
    none = language_id.train(spark.createDataFrame([], "text string, lang string"))
    assert {r.lang_pred for r in language_id.identify(frame, none).collect()} == {"und"}


def test_texts_are_scored_alike_alone_and_together(spark):
    rows = [("the cat and the dog", "en"), ("le chat et la souris", "fr"), ("der hund und die katze", "de")] * 3
    model = language_id.train(spark.createDataFrame(rows, "text string, lang string"))
    texts = ["la souris", "", None, "İstanbul Σας", "the " * 70_000, "x", "1 2", "und die katze " * 90_000, "\x00", "d"]
    names, scores = language_id.score_texts(texts, model)
    for text, name, score in zip(texts, names, scores, strict=True):
        (alone,), (own,) = language_id.score_texts([text], model)
        assert (alone, own) == (name, pytest.approx(score))
    want = plain.bayes(rows, list(enumerate(texts)))
    assert names == [want[i][0] for i in range(len(texts))]
    assert list(scores) == pytest.approx([want[i][1] for i in range(len(texts))])
    assert language_id.score_texts([], model)[0] == []


def test_any_number_of_vector_lengths(spark):
    draw = random.Random(6)
    rows = []
    for n in range(1, 91):
        base = [draw.gauss(0, 1) for _ in range(n)]
        rows += [(10 * n, base), (10 * n + 1, [x * 1.5 + 0.01 for x in base]), (10 * n + 2, [-x for x in base])]
    rows += [(2000 + i, [draw.gauss(0, 1) for _ in range(12)]) for i in range(90)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(frame, leaf=60).collect()}
    assert got == plain.vector_links(rows)


def test_the_forest_finds_pairs_at_the_threshold(spark):
    import numpy as np

    draw = np.random.default_rng(3)
    near = draw.standard_normal((300, 64))
    near /= np.linalg.norm(near, axis=1, keepdims=True)
    side = draw.standard_normal((300, 64))
    side -= (side * near).sum(1, keepdims=True) * near
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    pairs = 0.952 * near + np.sqrt(1 - 0.952**2) * side
    table = np.concatenate([near, pairs, draw.standard_normal((9_400, 64))])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(table)], "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r.n_links for r in vectors.near_vectors(frame, leaf=10).collect()}  # ten levels
    assert sum(got[i] == 1 for i in range(300)) >= 0.98 * 300
    assert sum(got.values()) <= 600


def test_token_and_bpe_cases(spark):
    texts = [None, "", "<|endoftext|>x<|endoftext|>", "\x00 é 😀", LONG[:200_000], "a" * 20_000, "  \n\n "]
    frame = docs(spark, list(enumerate(texts))).withColumn("ids", F.lit("clash"))
    vocabulary = bpe.load_vocabulary(spark, public_tokenizers.path("byte_bpe_50k.json"))
    encoded = bpe.bpe_encode(frame, vocabulary)
    got = encoded.select("doc_id", "ids", bpe.bpe_decode(vocabulary, F.col("ids")).alias("back")).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in got:
        text = texts[r.doc_id] or ""
        assert r.ids == library.encode(text, add_special_tokens=False).ids and r.back == text
    pieces = token_counts.load_pieces(spark, public_tokenizers.path("piece_bpe_32k.model"))
    counted = token_counts.count_tokens(frame.withColumn("n_tokens", F.lit("clash")), pieces).collect()
    assert [r.n_tokens for r in counted][:2] == [0, 0] and all(r.n_tokens for r in counted[2:])
    assert token_counts.count_tokens(frame.limit(0), pieces).count() == 0 == bpe.bpe_encode(frame.limit(0), vocabulary).count()


def test_components_of_a_long_chain(spark):
    chain = spark.range(200).select(F.col("id").alias("b"), (F.col("id") + 1).alias("a"))
    loose = spark.createDataFrame([(500, 501), (501, 500), (7, 7), (None, 3)], "a bigint, b bigint")
    found = {r.id: r.component for r in components(chain.unionByName(loose)).collect()}
    assert found == {i: 0 for i in range(201)} | {500: 500, 501: 500}


def test_places_and_stretches(spark):
    draw = random.Random(5)
    rows = [(draw.choice(["hot", "hot", "hot", "b", None]), draw.choice([None, 1, 2, 3, i])) for i in range(500)]
    frame = spark.createDataFrame(rows, "grp string, day int").repartition(7)
    sorted_rows, stretches = places.sorted_stretches(frame, ["grp"], ["day"], "test-places")
    found = places.placed(sorted_rows, stretches, ["grp"]).collect()
    for name in {g for g, _ in rows}:
        own = sorted((r for r in found if r.grp == name), key=lambda r: r.place)
        assert [r.place for r in own] == list(range(len(own))) and {r.total for r in own} == {len(own)}
        days = [(r.day is not None, r.day or 0) for r in own]
        assert days == sorted(days)


def test_centroid_cases(spark):
    draw = np.random.default_rng(3)
    base = draw.normal(size=(60, 64)).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(base)] + [(7, base[7]), (None, base[3]), (100, None), (101, []), (102, base[0][:63])]
    rows += [(103, [None] * 64), (104, [float("nan")] * 64), (105, [float("inf")] * 64), (106, [0.0] * 64)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<float>, id string, cluster int")
    want = plain.centroid_rows(rows)
    for how in ({}, {"width": 1}, {"width": 7, "chunk_rows": 5}):
        got = centroids.cluster_vectors(frame, **how)
        columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
        assert sorted((tuple(r) for r in got.select(*columns).collect()), key=repr) == want
    few = frame.where("vec_id < 3")
    assert sorted(r.cluster for r in centroids.cluster_vectors(few).collect()) == [0, 1, 2]
    assert centroids.cluster_vectors(frame.limit(0)).count() == 0
    # Equal vectors under several ids leave clusters empty, and the first of equally near ones wins.
    same = spark.createDataFrame([(i, [0.5] * 64) for i in range(20)], "vec_id bigint, embedding array<float>")
    assert {(r.cluster, r.distance) for r in centroids.cluster_vectors(same).collect()} == {(0, 0)}
    far = spark.createDataFrame([(1, [1e30] * 64)], "vec_id bigint, embedding array<float>")
    with pytest.raises(ValueError, match="beyond"):
        centroids.cluster_vectors(far)


def test_subvectors_come_back_from_their_codes():
    vectors = np.random.default_rng(1).integers(-3, 3, (200, 13))
    books, codes = centroids.encode(vectors, 4)
    told = [np.frombuffer(b, np.int32).reshape(-1, w)[np.frombuffer(c, np.uint32)]
            for b, c, w in zip(books, codes, (4, 4, 4, 1))]
    assert np.array_equal(np.concatenate(told, axis=1), vectors)
    assert len(np.frombuffer(books[3], np.int32)) == 6  # six distinct numbers, each kept once


MERKLE = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def merkle_of(spark, rows):
    frame = spark.createDataFrame(rows, MERKLE).withColumns({"g": F.lit(1), "place": F.lit("x"), "leaf": F.lit(2)})
    fields = ["doc_id", "source", "lang", "n_chars"]
    low = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    leaves = frame.select(
        F.col("doc_id").alias("key"), F.col("lang").alias("group"), merkle.row_digest([*fields, "text"]).alias("leaf"),
        F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, merkle.row_digest([*fields, low])).alias("claim"),
    )
    found = merkle.manifest(leaves)
    folded = merkle.folded_root(F.coalesce("claim", "leaf"), F.col("path"))
    return sorted((tuple(r) for r in found.select(
        "key", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")), folded, folded == F.col("root")
    ).collect()), key=repr)


@pytest.mark.parametrize("case", ["lone", "one_group", "mixed", "many_groups", "empty"])
def test_merkle_cases(spark, case):
    rows = {
        "lone": [(5, None, None, None, None)],
        "one_group": [(i, "s", "en", i, f"Text {i}") for i in range(9)],
        "mixed": [(i, None if i % 5 else "", "en", None, f"T É {i}") for i in range(73)]
        + [(1, "s", None, 1, ""), (1, "s", None, 1, ""), (None, "s", None, 1, None), (2, "s", "", 0, LONG.upper())]
        + [(3, "s", "é", 0, "A"), (4, "s", "z", 0, "A"), (4, "s", "z", 0, "A"), (4, "s", "z", 0, "B")],
        "many_groups": [(i, "s", f"l{i // 2}", i, "X") for i in range(41)],
        "empty": [],
    }[case]
    assert merkle_of(spark, rows) == plain.merkle_rows(rows)


def test_mixing_cases(spark):
    rows = [(i, "hot", "w " * (i % 40 + 1)) for i in range(900)] + [(i % 4, None, "a b c") for i in range(30)]
    rows += [(None, "nulls", f"x{i} y") for i in range(40)] + [(1, "long", LONG), (2, "long", "x"), (3, "none", None), (4, "none", " \t")]
    frame = spark.createDataFrame([(*r, 1, "y") for r in rows], "doc_id bigint, source string, text string, size int, place string")
    sizes = {}
    for _, source, text in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    targets = plain.mix_targets(sizes)
    for how in ({}, {"block_rows": 64}):
        found = mixing.mix(frame, **how)
        assert found.columns == ["doc_id", "size", "source_size", "target", "copies", "taken"]
        got = found.collect()
        assert len(got) == len(rows)
        assert all(r.taken == r.size * r.copies and 0 <= r.copies <= 3 for r in got)
        taken = {}
        for r in got:
            taken[r.source_size, round(r.target, 6)] = taken.get((r.source_size, round(r.target, 6)), 0) + r.taken
        for source in ("hot", None, "nulls"):
            # the largest documents are landed: half of one bounds how near whole copies come
            half = 20 if source == "hot" else 2
            assert taken[sizes[source], round(targets[source], 6)] == pytest.approx(targets[source], abs=half)
        assert taken[0, 0.0] == 0
        assert sorted(map(repr, got)) == sorted(map(repr, mixing.mix(frame, **how).collect()))
    assert mixing.mix(frame.limit(0)).count() == 0


def test_flight_keeps_both_totals_and_every_expectation():
    draw = np.random.default_rng(2)
    sizes = draw.integers(1, 50, 30).tolist()
    shares = np.full(30, 0.3)
    runs = []
    for seed in range(2000):
        now = np.array(mixing.fly(sizes, shares.tolist(), 2, np.random.default_rng(seed)))
        assert np.count_nonzero((now > 0) & (now < 1)) <= 2
        assert now.sum() == pytest.approx(9.0) and now @ sizes == pytest.approx(0.3 * sum(sizes))
        runs.append(now)
    assert np.abs(np.mean(runs, axis=0) - 0.3).max() < 0.06
    assert mixing.land([5, 5, 9], [0.5, 0.5, 1.0]) == [1.0, 0.0, 1.0]
    assert all(x in (0.0, 1.0) for x in mixing.land(*[[7] * 16, [0.4] * 16]))
