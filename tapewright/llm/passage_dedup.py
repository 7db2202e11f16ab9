"""Repeated passages by MinHash banding of paragraphs.

A paragraph is a line of PASSAGE words or more. Paragraphs whose bands collide are joined, verified by the exact Jaccard
similarity of their shingle sets, and clustered by components; all but a cluster's first are repeats.

Paragraphs that other text surrounds, or that line breaks part, are found as stretches of PASSAGE words. Of the PICKED-word
stretches, the one with the smallest hash of each WINDOW that follow each other is picked (a minimum over a window, as in a
band of one row), so two places with PASSAGE equal words share a pick. Around shared picks, and nowhere else, the
PASSAGE-word stretches are met and equal ones clustered, so each word that such a repeat covers is known, whatever the
punctuation and lines. Repeats that follow each other, with short gaps at most, make one passage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import _P, _P_INVERSE, joined_bytes, powers, word_hashes, words
from .minhash_dedup import near_duplicates
from .shared import materialize, mix64, slices
from .suffix_dedup import _sliding_min

#: Equal runs of so many words are found wherever they lie.
PASSAGE = 50
PICKED = 30
WINDOW = PASSAGE - PICKED + 1
#: What a row stands for: a whole document, a picked stretch, any stretch of PASSAGE words near a shared pick.
WHOLE, PICK, NEAR = range(3)
#: Fewer words than these between two repeats leave them one passage: a changed word or two.
MAX_GAP = 8


def _stretches(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of each stretch of so many words, by the first one; those that cross texts too."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix64(hashes) * powers(_P, n), dtype=np.uint64)])
    return mix64((sums[size:] - sums[:-size]) * powers(_P_INVERSE, n - size + 1))


def _picked(grams: np.ndarray, of_text: np.ndarray) -> np.ndarray:
    """The places of the smallest hash of each WINDOW stretches of one text; texts of fewer stretches have none."""
    counts = np.maximum(0, np.diff(of_text) - PICKED + 1)
    windows = np.maximum(0, counts - WINDOW + 1)
    total = int(windows.sum())
    if not total:
        return np.zeros(0, np.int64)
    at = np.arange(total) - np.repeat(np.cumsum(windows) - windows, windows) + np.repeat(of_text[:-1], windows)
    keyed = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    return np.unique(_sliding_min(keyed, WINDOW)[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _whole(hashes: np.ndarray, of_text: np.ndarray) -> np.ndarray:
    """The hash of each text's words in their order."""
    place = np.arange(len(hashes)) - np.repeat(of_text[:-1], np.diff(of_text))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix64(hashes + mix64(place.astype(np.uint64))), dtype=np.uint64)])
    return mix64(sums[of_text[1:]] - sums[of_text[:-1]])


def _rows(h: np.ndarray, ids: np.ndarray, at: np.ndarray, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """h, id, place << 3 | kind << 1 | sure, of rows in the order of id and place. What equals an earlier row is sure and gets a hash of its own."""
    h = mix64(h + np.uint64(kind))
    _, lead, back, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
    head = lead[back]
    sure = _late(ids, at, ids[head], at[head])
    h = np.where(sure, mix64(h + mix64(ids.astype(np.uint64) + mix64(at.astype(np.uint64)))), h)
    if kind == PICK:
        sure |= n[back] > 1
    return h, ids, at << 3 | kind << 1 | sure


def _late(id_: np.ndarray, at: np.ndarray, first_id: np.ndarray, first_at: np.ndarray) -> np.ndarray:
    """Whether a row repeats the first of its hash. Places that lie close together in one document don't."""
    return (id_ != first_id) | (at - first_at >= PICKED)


def _met(rows: DataFrame) -> DataFrame:
    """id, at, kind: the rows that repeat an earlier one, and all picks that another place has too. One sorted stream per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, told = None, False  # the first row of the last hash, and whether it is out
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([c.to_numpy() for c in batch.columns], axis=1)
            if held is not None:
                x = np.concatenate([held[None], x])
            lead = np.flatnonzero(np.concatenate([[True], x[1:, 0] != x[:-1, 0]]))
            sizes = np.diff(np.append(lead, len(x)))
            head = np.repeat(lead, sizes)
            kind, at = x[:, 2] >> 1 & 3, x[:, 2] >> 3
            out = (x[:, 2] & 1 == 1) | np.where(kind == PICK, np.repeat(sizes > 1, sizes), _late(x[:, 1], at, x[head, 1], at[head]))
            told_now = bool(out[lead[-1]]) or (told and lead[-1] == 0)
            out[0] &= not told
            held, told = x[lead[-1]], told_now
            yield pa.RecordBatch.from_arrays([pa.array(x[out, 1]), pa.array(at[out]), pa.array(kind[out].astype(np.int32))], names=["id", "at", "kind"])

    keyed = rows.repartition("h").sortWithinPartitions("h", "id", "at")
    return keyed.mapInArrow(run, "id long, at long, kind int")


def joined_runs(of: np.ndarray, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Joins spans of n words from `at` on in document number `of`, if they overlap or fewer than MAX_GAP words part them; document, start and end of each."""
    if not len(of):
        return of, at, n
    by = np.lexsort((at, of))
    of, at, end = of[by], at[by], (at + n)[by]
    far = int(end.max()) + MAX_GAP
    reach = np.maximum.accumulate(end + of * far) - of * far  # the furthest end so far in the document
    new = np.concatenate([[True], (of[1:] != of[:-1]) | (at[1:] - reach[:-1] >= MAX_GAP)])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(of) - 1)
    return of[new], at[new], reach[last]


def _paragraphs(texts: DataFrame) -> DataFrame:
    """paragraph (id, at: its first word's number, n: its words) and line, of each line of PASSAGE words or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                data, bounds = joined_bytes(part.column(1))
                starts, _, of_text = words(data, bounds)
                breaks = np.unique(np.concatenate([bounds, np.flatnonzero(data == ord("\n")) + 1]))
                first = np.searchsorted(starts, breaks)
                long = np.flatnonzero(np.diff(first) >= PASSAGE)
                of = np.searchsorted(bounds, breaks[long], side="right") - 1
                ids = part.column(0).take(pa.array(of))
                at, n = first[long] - of_text[of], first[long + 1] - first[long]
                key = pa.StructArray.from_arrays([ids, pa.array(at), pa.array(n)], names=["id", "at", "n"])
                lines = [data[a:b].tobytes() for a, b in zip(breaks[long].tolist(), breaks[long + 1].tolist())]
                yield pa.RecordBatch.from_arrays([key, pa.array(lines, pa.binary()).cast(pa.string())], names=["paragraph", "line"])

    return texts.mapInArrow(run, "paragraph struct<id: long, at: long, n: long>, line string")


def find_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, bands: int = 10, rows: int = 3) -> DataFrame:
    """One row per document with a repeated passage: id, n_passages, n_words, passages (start and end among the text's words).

    The first occurrence (smallest id, then place) stays. Ids are integers of any size. Null and empty texts and rows with
    a null id have no passages. Rows that repeat an id with the same text are one document. Other columns are not read. A
    pair of paragraphs at the threshold is missed by all bands with a chance of 8e-4, one of similarity 0.9 with 2e-6; equal
    ones never are. Words are stretches without white space, A-Z lower-cased. An equal run of PASSAGE words is always found,
    to its full length, wherever it starts and ends; in one document, only beyond PICKED words from the first place.
    """
    texts = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    names, kinds = ["h", "id", "at"], "h long, id long, at long"

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                part = part.take(pc.sort_indices(part.column(0)))
                ids = part.column(0).to_numpy()
                own, of_text = word_hashes(part.column(1))
                size = np.diff(of_text)
                long = np.flatnonzero(size >= PASSAGE)
                whole = _rows(_whole(own, of_text)[long], ids[long], size[long], WHOLE)
                grams = _stretches(own, PICKED)
                place = _picked(grams, of_text)
                of = np.searchsorted(of_text, place, side="right") - 1
                picks = _rows(grams[place], ids[of], place - of_text[of], PICK)
                h, id_, at = (np.concatenate(c) for c in zip(whole, picks))
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(id_), pa.array(at)], names=names)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                part = part.take(pc.sort_indices(part.column(0)))
                ids = part.column(0).to_numpy()
                own, of_text = word_hashes(part.column(1))
                grams = _stretches(own, PASSAGE)
                picks = part.column(2)
                of = np.repeat(np.arange(len(ids)), pc.list_value_length(picks).to_numpy())
                at = picks.flatten().to_numpy() + of_text[of]
                reach = np.zeros(len(own) + 1, np.int64)
                np.add.at(reach, np.maximum(of_text[of], at - WINDOW + 1), 1)
                np.add.at(reach, np.maximum(of_text[of], np.minimum(of_text[of + 1] - PASSAGE, at) + 1), -1)
                place = np.flatnonzero(np.cumsum(reach) > 0)
                of = np.searchsorted(of_text, place, side="right") - 1
                h, id_, at = _rows(grams[place], ids[of], place - of_text[of], NEAR)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(id_), pa.array(at)], names=names)

    same = near_duplicates(_paragraphs(texts), "paragraph", "line", percent=percent, bands=bands, rows=rows)
    lines = same.filter("NOT kept").select("paragraph.id", F.col("paragraph.at").alias("at"), F.col("paragraph.n").alias("n"))
    found = materialize(_met(texts.mapInArrow(hashed, kinds)), "met")
    copies = found.filter(F.col("kind") == WHOLE).select("id", F.lit(0).cast("long").alias("at"), F.col("at").alias("n"))
    picks = found.filter(F.col("kind") == PICK).groupBy("id").agg(F.collect_set("at").alias("picks"))
    shared = picks.join(copies.select("id"), "id", "left_anti")
    late = _met(texts.join(shared, "id").select("id", "text", "picks").mapInArrow(near, kinds))
    # places of stretches that were met go into one row for 64 of them; lines and copies keep a row each
    bits = F.expr("shiftleft(1L, CAST(at & 63 AS INT))")
    met = late.select("id", F.expr("at - (at & 63)").alias("at"), F.lit(0).cast("long").alias("n"), bits.alias("bits"))
    spans = met.union(lines.union(copies).select("id", "at", "n", F.lit(0).cast("long")))
    by_doc = spans.repartition("id").groupBy("id", "at", "n").agg(F.bit_or("bits").alias("bits")).groupBy("id").agg(F.collect_list(F.struct("at", "n", "bits")).alias("spans"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(1)
            of = np.repeat(np.arange(batch.num_rows), pc.list_value_length(held).to_numpy())
            at, n, bits = (held.flatten().field(k).to_numpy() for k in range(3))
            row, bit = np.nonzero(np.unpackbits(bits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            plain = n > 0
            of, a, b = joined_runs(np.concatenate([of[plain], of[row]]), np.concatenate([at[plain], at[row] + bit]), np.concatenate([n[plain], np.full(len(row), PASSAGE)]))
            ends = np.searchsorted(of, np.arange(batch.num_rows + 1)).astype(np.int32)
            pairs = pa.ListArray.from_arrays(pa.array(np.arange(0, 2 * len(a) + 1, 2, dtype=np.int32)), pa.array(np.stack([a, b], axis=1).ravel()))
            total = np.concatenate([[0], np.cumsum(b - a)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends).astype(np.int64)), pa.array(total[ends[1:]] - total[ends[:-1]]), pa.ListArray.from_arrays(pa.array(ends), pairs)], names=[id_col, "n_passages", "n_words", "passages"])

    return by_doc.mapInArrow(joined, f"`{id_col}` long, n_passages long, n_words long, passages array<array<long>>")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, bands: int = 10, rows: int = 3) -> DataFrame:
    """One row per input row with a repeated passage: id, n_passages, n_words, spans (start, end in characters), kept_text.

    find_passages says what a passage is. kept_text is the text without its passages.
    """
    found = find_passages(docs, id_col, text_col, percent, bands, rows).withColumnRenamed(id_col, "id")
    texts = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                spans, kept = [], []
                data, bounds = joined_bytes(part.column(1))
                starts, ends, of_text = words(data, bounds)
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                for k, runs in enumerate(part.column(4).to_pylist()):
                    gone = [(int(starts[of_text[k] + a]), int(ends[of_text[k] + b - 1])) for a, b in runs]
                    edges = [int(bounds[k]), *(x for g in gone for x in g), int(bounds[k + 1])]
                    kept.append(b"".join(data[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2])))
                    spans.append([(chars[list(g)] - chars[bounds[k]]).tolist() for g in gone])
                made = [pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(kept, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), part.column(3), *made], names=[id_col, "n_passages", "n_words", "spans", "kept_text"])

    whole = texts.join(found, "id").select("id", "text", "n_passages", "n_words", "passages")
    return whole.mapInArrow(cut, f"`{id_col}` long, n_passages long, n_words long, spans array<array<long>>, kept_text string")
