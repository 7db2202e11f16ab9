"""Benchmark decontamination by spaced seeds.

A seed is the hash of the tokens under a mask; the tokens that the mask leaves out may differ. MASKS hit every stretch
of MIN_TOKENS tokens or more in which a fifth is substituted, wherever the substitutions fall: tests go through all of
them for 13 tokens with 2, 15 with 3, 20 with 4 and 25 with 5. A stretch of fewer than 26 tokens holds one of these, and a
longer one has a half that is no worse than a fifth. SHORT_MASKS do the same for whole items of 5 to 12 tokens. Seeds of
the benchmark fill a Bloom filter of a fixed size; seeds of the documents that pass it are joined with the benchmark's and
counted for each diagonal. A short item has a number of seeds on its diagonal whatever the changes, so one with fewer is
no candidate; the diagonals that are left get their texts and are verified as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .hashing import word_hashes
from .line_dedup import _bits, _has, _set
from .shared import materialize, mix64, slices

# Masks found by a search over all masks of that many tokens.
MASKS = ((0, 1, 3, 5, 6, 7), (0, 1, 2, 6, 8, 9), (0, 1, 3, 7, 8, 9), (0, 1, 2, 3, 4, 5))
SHORT_MASKS = ((0, 1, 2, 4), (0, 2, 3, 4), (0, 1, 2, 3), (0, 1, 3, 4))
MIN_TOKENS = 13
SHORTEST_ITEM = 5
ITEMS_AT_ONCE = 64
LOG2_BITS = 24
TOKEN_GAP = r"[\x09-\x0D\x20-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+"


def _seeds(tokens: np.ndarray, bounds: np.ndarray, masks: tuple[tuple[int, ...], ...], first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number and token place (in its text) of each seed that lies within one text."""
    sizes = np.diff(bounds)
    text = np.repeat(np.arange(len(sizes)), sizes)
    left = np.repeat(bounds[1:], sizes) - np.arange(len(text))  # tokens from here to the text's end
    out = []
    for number, mask in enumerate(masks, first):
        at = np.flatnonzero(left > mask[-1])
        seed = np.full(len(at), number, np.uint64)
        for k in mask:
            seed = seed * np.uint64(0x9E3779B97F4A7C15) + tokens[at + k]
        out.append((mix64(seed), text[at], at - bounds[text[at]]))
    return tuple(np.concatenate(x) for x in zip(*out))


def fewest_seeds(size: int) -> int:
    """How many seeds by SHORT_MASKS a whole item of so many tokens keeps at least, whichever fifth of them is substituted."""
    places = [{o + k for k in m} for m in SHORT_MASKS for o in range(size - m[-1])]
    return min(sum(not p & set(changed) for p in places) for changed in combinations(range(size), size // 5))


def _seed_rows(texts: DataFrame, short: bool, filter_=None) -> DataFrame:
    """seed, id, place and n (the text's tokens) for each text's seeds, or for those that the filter lets pass; a repeat in one text counts each time.

    Without a filter the texts are benchmark items: of these, the short ones alone have seeds by SHORT_MASKS.
    """
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                tokens, bounds = word_hashes(part.column(1), bare=True)
                found = [_seeds(tokens, bounds, MASKS, 1)]
                if short:
                    found.append(_seeds(tokens, bounds, SHORT_MASKS, 1 + len(MASKS)))
                if filter_ is None and short:
                    size = np.diff(bounds)
                    small = (size[found[1][1]] < MIN_TOKENS) & (size[found[1][1]] >= SHORTEST_ITEM)
                    found[1] = tuple(x[small] for x in found[1])
                seed, text, place = (np.concatenate(x) for x in zip(*found))
                if filter_ is not None:
                    keep = _has(filter_.value, _bits(seed, LOG2_BITS))
                    seed, text, place = seed[keep], text[keep], place[keep]
                n = np.diff(bounds)[text]
                yield pa.RecordBatch.from_arrays([pa.array(seed.view(np.int64)), part.column(0).take(pa.array(text)), pa.array(place, pa.int64()), pa.array(n, pa.int64())], names=["seed", "id", "place", "n"])

    return texts.mapInArrow(run, f"seed long, id {kind}, place long, n long")


def _filter(seeds: DataFrame) -> np.ndarray:
    """The filter of all seeds. Tasks hand on their set bytes only, joined by place, so the driver gets a fixed size at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros((1 << LOG2_BITS) // 8, np.uint8)
        for batch in batches:
            _set(own, _bits(batch.column(0).to_numpy().view(np.uint64), LOG2_BITS))
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(own[at].astype(np.int32))], names=["at", "bits"])

    whole = np.zeros((1 << LOG2_BITS) // 8, np.uint8)
    for r in seeds.select("seed").mapInArrow(run, "at long, bits int").groupBy("at").agg(F.bit_or("bits").alias("bits")).toLocalIterator():
        whole[r["at"]] = r["bits"]
    return whole


def best_overlap(doc: np.ndarray, item: np.ndarray, diagonal: int, percent: int) -> tuple[int, int, int]:
    """Place in doc, tokens and equal tokens of the longest stretch of the diagonal with that share of equal tokens.

    Of several the one with most equal tokens, then the first. Its ends may be substituted as any of its tokens.
    """
    a, b = max(0, -diagonal), min(len(item), len(doc) - diagonal)
    if a >= b:
        return 0, 0, 0
    same = doc[a + diagonal : b + diagonal] == item[a:b]
    run = np.concatenate([[0], np.cumsum(np.where(same, 100 - percent, -percent))])
    ahead = np.maximum.accumulate(run[::-1])[::-1]  # falls; a stretch from s may end at the last e with ahead[e] >= run[s]
    ends = np.searchsorted(-ahead, -run, side="right") - 1
    sizes, equals = ends - np.arange(len(run)), np.concatenate([[0], np.cumsum(same)])
    longest = np.flatnonzero(sizes == sizes.max())
    equal = equals[ends[longest]] - equals[longest]
    best = int(np.argmax(equal))
    return a + diagonal + int(longest[best]), int(sizes.max()), int(equal[best])


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", percent: int = 80) -> DataFrame:
    """One row for each document and benchmark item it overlaps: id, item id, start, n_tokens, n_equal, item_tokens.

    Tokens are stretches without white space and ASCII punctuation, A-Z lower-cased. An overlap is an aligned stretch of
    MIN_TOKENS tokens at least, or the whole item if that is shorter, of which `percent` percent are equal; the row shows
    the longest (then first) one. Items of fewer than SHORTEST_ITEM tokens are too short to tell from chance and never match.
    No overlap is missed. Null texts are empty; rows with a null id are left out; documents or items that repeat an id are one; other columns are
    not read. Without documents or items there are no rows.
    """
    spark = docs.sparkSession
    named = lambda df, i, t: df.filter(F.col(i).isNotNull()).select(F.col(i).alias("id"), F.coalesce(F.col(t), F.lit("")).alias("text"))
    items, texts = named(benchmark, item_col, item_text_col), named(docs, id_col, text_col)
    test = materialize(_seed_rows(items, True), "benchmark-seeds")
    filter_ = spark.sparkContext.broadcast(_filter(test))
    size = F.size(F.split(F.col("text"), TOKEN_GAP, -1))  # a text of n tokens has at most n + 2 pieces
    short = not items.filter(size <= MIN_TOKENS + 1).isEmpty()
    hits = _seed_rows(texts, short, filter_)
    of_items = test.select("seed", F.col("id").alias("item"), F.col("place").alias("item_place"), F.col("n").alias("item_tokens"))
    joined = hits.select("seed", "id", "place").join(of_items, "seed")
    counted = joined.groupBy("id", "item", "item_tokens", (F.col("place") - F.col("item_place")).alias("diagonal")).agg(F.count("*").alias("seeds"))
    need = F.lit(1)
    for n in range(SHORTEST_ITEM, MIN_TOKENS):
        need = F.when(F.col("item_tokens") == n, fewest_seeds(n)).otherwise(need)
    diagonals = counted.filter(F.col("seeds") >= need).select("id", "item", "diagonal").distinct()
    held = materialize(diagonals.join(items.select(F.col("id").alias("item"), F.col("text").alias("item_text")), "item"), "hits")
    by_item = held.groupBy("id", "item", "item_text").agg(F.collect_set("diagonal").alias("diagonals"))
    # a document that meets very many items gets several rows of about ITEMS_AT_ONCE items each
    parts = F.ceil(F.count("*").over(Window.partitionBy("id")) / ITEMS_AT_ONCE)
    by_doc = by_item.withColumn("part", F.pmod(F.xxhash64("item"), parts)).groupBy("id", "part").agg(F.collect_list(F.struct("item", "item_text", "diagonals")).alias("found"))
    id_type, item_type = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(docs.schema[id_col].dataType), to_arrow_type(benchmark.schema[item_col].dataType)] + [pa.int64()] * 4
    names = [id_col, item_col, "start", "n_tokens", "n_equal", "item_tokens"]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                tokens, bounds = word_hashes(part.column(1), bare=True)
                rows = []
                for k, (id_, found) in enumerate(zip(part.column(0).to_pylist(), part.column(2).to_pylist())):
                    doc = tokens[bounds[k] : bounds[k + 1]]
                    items, at = word_hashes(pa.array([f["item_text"] for f in found], pa.string()), bare=True)
                    for n, f in enumerate(found):
                        item = items[at[n] : at[n + 1]]
                        start, size, equal = max((best_overlap(doc, item, d, percent) for d in sorted(f["diagonals"])), key=lambda x: (x[1], x[2], -x[0]))
                        if size and size >= min(MIN_TOKENS, len(item)):
                            rows.append((id_, f["item"], start, size, equal, len(item)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6, types)], names=names)

    out = texts.join(by_doc, "id").select("id", "text", "found").mapInArrow(verify, f"`{id_col}` {id_type}, `{item_col}` {item_type}, start long, n_tokens long, n_equal long, item_tokens long")
    return out.dropDuplicates([id_col, item_col])
