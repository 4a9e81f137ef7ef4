"""Benchmark decontamination: rare n-gram seeds join passages to items, then Smith-Waterman alignment.

One pass over the texts cuts out the passages around word trigrams that some item has; equal
passages fold.  How many passages have each trigram is counted, and the rare ones, which bring
few pairs of a passage and an item, are the seeds of a join.  An edited copy may have kept no rare
trigram.  For those each common trigram of an item is paired with the item's rarest words: a copy
that reaches the score has at least one of them, since it lacks too few words to lack them all.
Such pairs are rarer seeds, joined in the same way, so no copy that keeps a trigram is lost.
Every pair found is aligned word by word; the share of the greatest possible score is kept.

An item is found whole, from ``min_score`` of its greatest score on, and in excerpts: from the score
on that ``min_score`` of EXCERPT_WORDS words would have.  ``score`` is the share of the whole item in either case.

Nothing of the texts or items passes the driver but bit maps of fixed size and counts.  Words are
runs of ASCII letters, digits and other characters beyond ASCII, in lower case for A-Z, so
punctuation does not matter.

Cases: null and empty texts match nothing; items of fewer than three words have no
trigram and match nothing, as any text may hold them by chance.  An item that occurs twice in a document gives
one row, with the best score.  Rows that share a key are answered together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanset.llm.tables import releasing, small_enough, stored
from gleanset.llm.words import PUNCTUATION_BYTES, ngram_hashes, slices, split_words, text_bytes

SEED_WORDS = 3
# A passage is reported from this share of the greatest score on; items edited in every
# eighth word or so still reach it.
MIN_SCORE = 0.6
# Of longer items an excerpt that scores like this many words is reported too.
EXCERPT_WORDS = 40
MATCH, MISMATCH, GAP = 2, -1, -1
# A trigram is rare if it brings no more pairs than this, or than four times the mean of passages per trigram.
RARE_PAIRS = 1_000
# Bits of the maps that tell hashes worth a look; the joins after them are exact.
MAP_BITS = 1 << 22
PAIR_MAP_BITS = 1 << 26
# Pairs of a common trigram and a rare word looked up at a time.
_PAIR_BLOCK = 1 << 20


def alignment(query: np.ndarray, passage: np.ndarray) -> int:
    """Best local alignment score of two word sequences, one numpy row per query word."""
    slope = GAP * np.arange(len(passage) + 1)
    row = np.zeros(len(passage) + 1, np.int64)
    best = 0
    for word in query:
        step = np.where(passage == word, MATCH, MISMATCH)
        fresh = np.zeros_like(row)
        fresh[1:] = np.maximum(row[:-1] + step, row[1:] + GAP)
        np.maximum(fresh, 0, out=fresh)
        row = np.maximum.accumulate(fresh - slope) + slope
        best = max(best, int(row.max()))
    return best


def least_score(words: int, min_score: float) -> float:
    """The score from which an item of so many words is reported."""
    return MATCH * min_score * min(words, EXCERPT_WORDS)


def most_inserted(words: int, min_score: float) -> int:
    """Words that a copy can hold between the item's and still reach the score."""
    return int(np.ceil((MATCH * words - least_score(words, min_score)) / -GAP))


def _words(texts: pa.Array):
    return split_words(*text_bytes(texts), separators=PUNCTUATION_BYTES, lower=True)


def _lists(values: list[np.ndarray]) -> pa.Array:
    """Arrays of 64-bit hashes as a column of lists."""
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def _arrays(column: pa.Array) -> list[np.ndarray]:
    """The lists of a column as arrays of hashes."""
    offsets = np.asarray(column.offsets)
    flat = np.asarray(column.values).view(np.uint64)
    return [flat[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]


def _bit_map(hashes: DataFrame, column: str, bits: int) -> np.ndarray:
    """A map of fixed size in which the bits of all hashes are set, made by part in Spark."""
    slot = F.col(column).bitwiseAND(F.lit(bits - 1))
    table = (
        hashes.select(slot.alias("slot"))
        .selectExpr("shiftright(slot, 6) AS place", "shiftleft(1L, cast(slot & 63 AS int)) AS bit")
        .groupBy("place").agg(F.bit_or("bit").alias("bit"))
        .toPandas()
    )
    out = np.zeros(bits // 64, np.int64)
    out[table["place"].to_numpy(np.int64)] = table["bit"].to_numpy(np.int64)
    return out.view(np.uint64)


def _marked(bit_map: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes & np.uint64(64 * len(bit_map) - 1)
    return (bit_map[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) > 0


def _item_words(items: DataFrame, key: str, text: str) -> DataFrame:
    """``(item, item_key, words)`` of the items that have a trigram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            found = _words(batch.column("_text"))
            own = [found.hashes[a:b] for a, b in zip(found.first, found.first[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("_key"), _lists(own)], ["item_key", "words"])

    named = items.select(F.col(key).cast("bigint").alias("_key"), F.col(text).alias("_text"))
    read = named.where("_key is not null and _text is not null").mapInArrow(
        releasing(run), "item_key bigint, words array<bigint>"
    )
    whole = read.where(F.size("words") >= SEED_WORDS)
    return stored(whole.withColumn("item", F.monotonically_increasing_id()), "leak-items")


def _grams(frame: DataFrame, key: str, kind: str, bit_map: object = None) -> DataFrame:
    """The distinct trigrams of each row's ``words``, those that the map tells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(ngram_hashes(w, SEED_WORDS)) for w in _arrays(batch.column("words"))]
            if bit_map is not None:
                found = [g[_marked(bit_map.value, g)] for g in found]
            of = np.repeat(np.arange(len(found)), [len(g) for g in found])
            grams = np.concatenate(found) if found else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(key).take(pa.array(of, pa.int64())), pa.array(grams.view(np.int64))], [key, "gram"]
            )

    return frame.select(key, "words").mapInArrow(releasing(run), f"{key} {kind}, gram bigint")


def _passages(texts: DataFrame, key: str, text: str, gram_map: object, word_map: object, reach: int) -> DataFrame:
    """``(key, same, words)`` of the stretches of each text that lie within reach of an item's trigram.

    Stretches of a text do not overlap.  Words that no item has are 0, and ``same`` is a digest of the words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            found = _words(batch.column("_text"))
            at = np.flatnonzero(_marked(gram_map.value, ngram_hashes(found.hashes, SEED_WORDS)))
            text_of = np.searchsorted(found.first, at, side="right") - 1
            inside = at + SEED_WORDS <= found.first[text_of + 1]
            at, text_of = at[inside], text_of[inside]
            begin = np.maximum(at - reach, found.first[text_of])
            end = np.minimum(at + reach + SEED_WORDS, found.first[text_of + 1])
            cut = np.flatnonzero((np.diff(text_of) != 0) | (begin[1:] > end[:-1])) + 1 if len(at) else cut_none
            first = np.concatenate([[0], cut]).astype(np.int64) if len(at) else cut_none
            last = np.concatenate([cut, [len(at)]]).astype(np.int64) - 1 if len(at) else cut_none
            own = []
            for a, b in zip(begin[first], end[last], strict=True):
                words = found.hashes[a:b]
                own.append(np.where(_marked(word_map.value, words), words, np.uint64(0)))
            same = [hashlib.blake2b(w.tobytes(), digest_size=16).digest() for w in own]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key").take(pa.array(text_of[first], pa.int64())), pa.array(same, pa.binary()), _lists(own)],
                [key, "same", "words"],
            )

    cut_none = np.zeros(0, np.int64)
    return texts.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(
        releasing(run), f"{key} bigint, same binary, words array<bigint>"
    )


def _rarest_words(items: DataFrame, passages: DataFrame, min_score: float) -> DataFrame:
    """``(item, word)``: so many of each item's rarest words that no reported copy lacks them all."""
    told = passages.select(F.explode(F.array_distinct("words")).alias("word"))
    often = told.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    needed = F.ceil(F.lit(min_score) * F.least(F.size("words"), F.lit(EXCERPT_WORDS)) - F.lit(1e-9))
    spelled = items.select(
        "item", (F.size("words") - needed + 1).alias("spare"), F.posexplode("words").alias("place", "word")
    )
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.coalesce("n", F.lit(0)), "word", "place"))
    ranked = spelled.join(often, "word", "left").withColumn("rank", rank)
    return ranked.where("rank <= spare").select("item", "word").distinct()


def _paired_seeds(
    passages: DataFrame, items: DataFrame, item_grams: DataFrame, common: DataFrame, min_score: float
) -> DataFrame:
    """``(same, item)`` that share a common trigram and one of the item's rarest words."""
    spark = passages.sparkSession
    usual = item_grams.join(common, "gram", "left_semi")
    rarest = _rarest_words(items.join(usual, "item", "left_semi"), passages, min_score)
    seeds = stored(
        usual.join(rarest, "item").select("item", "gram", "word", F.col("gram").bitwiseXOR(F.col("word")).alias("seed")),
        "leak-pairs",
    )
    shared = spark.sparkContext.broadcast((
        _bit_map(seeds, "gram", MAP_BITS), _bit_map(seeds, "word", MAP_BITS), _bit_map(seeds, "seed", PAIR_MAP_BITS)
    ))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram_map, word_map, pair_map = shared.value
        for batch in batches:
            same = batch.column("same")
            for i, words in enumerate(_arrays(batch.column("words"))):
                grams = np.unique(ngram_hashes(words, SEED_WORDS))
                grams = grams[_marked(gram_map, grams)]
                if not len(grams):
                    continue
                words = np.unique(words)
                words = words[_marked(word_map, words)]
                step = max(1, _PAIR_BLOCK // max(1, len(words)))
                for a in range(0, len(grams), step):
                    found = (grams[a : a + step, None] ^ words[None, :]).ravel()
                    found = found[_marked(pair_map, found)]
                    yield pa.RecordBatch.from_arrays(
                        [same.take(pa.array(np.full(len(found), i))), pa.array(found.view(np.int64))], ["same", "seed"]
                    )

    told = passages.mapInArrow(releasing(run), "same binary, seed bigint")
    return told.join(seeds.select("seed", "item").distinct(), "seed").select("same", "item")


def _score(query: np.ndarray, words: np.ndarray, min_score: float) -> float | None:
    """Best score of an item in a passage, or None below the least."""
    least, most = least_score(len(query), min_score), most_inserted(len(query), min_score)
    grams = ngram_hashes(query, SEED_WORDS)
    order = np.argsort(grams, kind="stable")
    here = ngram_hashes(words, SEED_WORDS)
    low = np.searchsorted(grams, here, sorter=order)
    high = np.searchsorted(grams, here, side="right", sorter=order)
    at = np.repeat(np.arange(len(here)), high - low)
    if not len(at):
        return None
    place = np.concatenate([order[a:b] for a, b in zip(low, high, strict=True) if a < b])
    begin = np.sort(at - place)
    # One passage while the expected beginnings lie so close to each other.
    cut = np.flatnonzero(np.diff(begin) > max(len(query), most)) + 1
    best = 0
    for a, b in zip([0, *cut], [*cut, len(begin)], strict=True):
        first = max(0, int(begin[a]) - most)
        part = words[first : int(begin[b - 1]) + len(query) + most]
        if MATCH * np.isin(query, part).sum() >= max(least - 1e-9, best + 1):
            best = max(best, alignment(query, part))
    return best / (MATCH * len(query)) if best >= least - 1e-9 else None


def _aligned(pairs: DataFrame, passages: DataFrame, items: DataFrame, item_key: str, min_score: float) -> DataFrame:
    """``(same, item_key, score)`` of the pairs that reach the score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            queries, parts = _arrays(batch.column("query")), _arrays(batch.column("words"))
            scores = [_score(q, w, min_score) for q, w in zip(queries, parts, strict=True)]
            kept = pa.array([i for i, s in enumerate(scores) if s is not None], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("same").take(kept), batch.column("item_key").take(kept),
                 pa.array([s for s in scores if s is not None], pa.float64())],
                ["same", item_key, "score"],
            )

    queries = items.select("item", "item_key", F.col("words").alias("query"))
    both = pairs.join(passages, "same").join(queries, "item").select("same", "item_key", "query", "words")
    return both.mapInArrow(releasing(run), f"same binary, {item_key} bigint, score double")


def find_leaks(
    texts: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", *, min_score: float = MIN_SCORE,
    rare_pairs: int = RARE_PAIRS,
) -> DataFrame:
    """``(doc_id, item_id, score)`` for every text that holds a copy of an item, however edited.

    ``rare_pairs`` changes which seeds find a copy, never the result.
    """
    spark = texts.sparkSession
    queries = _item_words(items, item_key, item_text)
    longest = queries.agg(F.max(F.size("words"))).first()[0]
    if longest is None:
        return spark.createDataFrame([], f"{key} bigint, {item_key} bigint, score double")
    item_grams = stored(_grams(queries, "item", "bigint"), "leak-grams")
    gram_map = spark.sparkContext.broadcast(_bit_map(item_grams, "gram", MAP_BITS))
    spelled = queries.select(F.explode("words").alias("word"))
    word_map = spark.sparkContext.broadcast(_bit_map(spelled, "word", MAP_BITS))
    reach = longest + most_inserted(longest, min_score)
    cut = stored(_passages(texts, key, text, gram_map, word_map, reach), "leak-passages")
    passages = stored(cut.groupBy("same").agg(F.any_value("words").alias("words")), "leak-folded")

    hits = stored(_grams(passages, "same", "binary", gram_map), "leak-hits")
    in_items = item_grams.groupBy("gram").agg(F.count(F.lit(1)).alias("items"))
    counts = stored(
        hits.groupBy("gram").agg(F.count(F.lit(1)).alias("passages")).join(in_items, "gram"), "leak-counts"
    )
    mean = counts.agg(F.avg("passages")).first()[0] or 0.0
    rare = F.col("passages") * F.col("items") <= max(rare_pairs, 4.0 * mean)
    pairs = hits.join(counts.where(rare).select("gram"), "gram").join(item_grams, "gram").select("same", "item")
    common = counts.where(~rare).select("gram")
    if common.take(1):
        pairs = pairs.unionByName(_paired_seeds(passages, queries, item_grams, common, min_score))
    found = stored(_aligned(pairs.distinct(), passages, queries, item_key, min_score), "leaks")
    return cut.select(key, "same").join(small_enough(found), "same").groupBy(key, item_key).agg(
        F.max("score").alias("score")
    )


def drop_leaks(
    texts: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **how: object
) -> DataFrame:
    """The texts that hold no test item; rows with a null key stay."""
    leaks = find_leaks(texts, items, key, text, **how).select(key).distinct()
    return texts.join(small_enough(leaks), key, "left_anti")
