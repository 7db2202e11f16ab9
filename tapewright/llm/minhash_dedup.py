"""Near-duplicate documents by b-bit MinHash, confirmed on full shingle sets.

1. Each document's shingle set is sketched: minima under `bands` * `rows` hash functions. A band's minima make a bucket
   key; the low `BITS` bits of all minima make the packed signature. Documents with equal sets are one class.
2. Buckets with two classes or more give candidates. First each bucket links its members with one pivot, the member that
   shares most buckets, so a bucket of n members gives n - 1 candidates. Signatures drop those whose corrected estimate
   is far below the threshold; the rest are confirmed on full sets.
3. Members that the pivots didn't join are compared by wider signatures, block against block within their bucket. A
   forest of their likely links is confirmed first, then all pairs that are still apart. No pair is dropped for the size
   of its bucket.
4. Components of the confirmed links, spread to the members of each class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .hashing import mix64, shingle_sets
from .shared import materialize, slices

BITS = 4
BLOCK = 1024
#: Minima of the wide signature, made only for members that the pivots left apart: its estimates are off by 0.00625 at 0.8.
WIDE = 4096
#: Texts whose wide signatures are made at once: their minima take 8 * WIDE * WIDE_ROWS bytes.
WIDE_ROWS = 256
_MULTIPLIERS = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 4096, np.uint64) * np.uint64(2) + np.uint64(1)


def _minima(sets: list[np.ndarray], count: int) -> np.ndarray:
    """One row for each set that isn't empty, one column for each hash function."""
    joined = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), count), np.uint64)
    for k in range(count):
        out[:, k] = np.minimum.reduceat(joined * _MULTIPLIERS[k], starts)
    return mix64(out)


def _packed(minima: np.ndarray) -> np.ndarray:
    """The low BITS bits of each minimum, 16 to a 64-bit word."""
    low = minima & np.uint64((1 << BITS) - 1)
    per = 64 // BITS
    low = np.pad(low, ((0, 0), (0, -low.shape[1] % per)))
    shifts = (np.arange(per) * BITS).astype(np.uint64)
    return np.bitwise_or.reduce(low.reshape(len(low), -1, per) << shifts, axis=2)


def estimates(left: np.ndarray, right: np.ndarray, count: int) -> np.ndarray:
    """The estimated similarity of packed signatures (broadcasting over rows), corrected for minima that agree by chance."""
    differ = left ^ right
    differ = (differ | (differ >> np.uint64(1)) | (differ >> np.uint64(2)) | (differ >> np.uint64(3))) & np.uint64(0x1111111111111111)
    agree = 1 - np.bitwise_count(differ).sum(axis=-1, dtype=np.int64) / count
    chance = 1 / (1 << BITS)
    return (agree - chance) / (1 - chance)


def sketch(docs: DataFrame, id_col: str, text_col: str, size: int, bands: int, rows: int) -> DataFrame:
    """id, n (shingles), set_hash (of the whole set), keys (one bucket key a band), signature, short_keys (32 bits a band).

    An empty set has no keys.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, 2_000_000):
                sets = shingle_sets(part.column(1), size)
                full = [s for s in sets if len(s)]
                keys, packed, short, hashes = (iter(()) for _ in range(4))
                if full:
                    minima = _minima(full, bands * rows)
                    of_band = mix64(minima).reshape(len(full), bands, rows)
                    mixed = np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    for k in range(rows):
                        mixed = mix64(mixed + of_band[:, :, k])
                    keys, packed, short = iter(mixed.view(np.int64)), iter(_packed(minima)), iter((mixed >> np.uint64(32)).astype(np.uint32))
                    hashes = iter([s.sum(dtype=np.uint64).tobytes() + mix64(s).sum(dtype=np.uint64).tobytes() for s in full])
                take = lambda it: [next(it) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(take(hashes), pa.binary()), pa.array(take(keys), pa.list_(pa.int64())), *[pa.array([None if p is None else p.tobytes() for p in take(it)], pa.binary()) for it in (packed, short)]], names=["id", "n", "set_hash", "keys", "signature", "short_keys"])

    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(run, f"id {kind}, n long, set_hash binary, keys array<long>, signature binary, short_keys binary")


def wide_signatures(texts: DataFrame, size: int) -> DataFrame:
    """id and a packed signature of WIDE minima; texts without words are left out."""
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, 500_000, WIDE_ROWS):
                sets = shingle_sets(part.column(1), size)
                full = [k for k, s in enumerate(sets) if len(s)]
                packed = [p.tobytes() for p in _packed(_minima([sets[k] for k in full], WIDE))] if full else []
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(full, pa.int64())), pa.array(packed, pa.binary())], names=["id", "signature"])

    return texts.select("id", "text").mapInArrow(run, f"id {kind}, signature binary")


def _least(percent: int, count: int) -> float:
    """The threshold less five standard deviations of an estimate by so many minima, of which BITS bits are compared."""
    chance = 0.5**BITS
    agree = percent / 100 + (1 - percent / 100) * chance
    return percent / 100 - 5 * (agree * (1 - agree) / count) ** 0.5 / (1 - chance)


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Of the pairs (a, b), those whose full sets reach the threshold."""
    kind = pairs.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 3):
                columns, sets = [], []
                for c in (2, 3):
                    coded = part.column(c).dictionary_encode()
                    sets.append(shingle_sets(coded.dictionary, size))
                    columns.append(coded.indices.to_pylist())
                keep = []
                for x, y in zip(*columns):
                    both = len(np.intersect1d(sets[0][x], sets[1][y], assume_unique=True))
                    keep.append(100 * both >= percent * (len(sets[0][x]) + len(sets[1][y]) - both))
                yield pa.RecordBatch.from_arrays([part.column(0).filter(pa.array(keep, pa.bool_())), part.column(1).filter(pa.array(keep, pa.bool_()))], names=["a", "b"])

    b = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    whole = b.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    return whole.select("a", "b", "text_a", "text_b").mapInArrow(run, f"a {kind}, b {kind}")


def _likely(pairs: DataFrame, signatures: DataFrame, count: int, least: float) -> DataFrame:
    """Of the pairs, those whose estimated similarity reaches the least value."""
    kind = pairs.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for c in (2, 3))
                keep = pa.array(estimates(left, right, count) >= least)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    side = lambda k: signatures.select(F.col("id").alias(k), F.col("signature").alias(f"sig_{k}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sig_a", "sig_b").mapInArrow(run, f"a {kind}, b {kind}")


def _across(members: DataFrame, count: int, least: float, forest: bool = False) -> DataFrame:
    """Pairs of one bucket's members from different components whose estimate reaches the least value.

    members: bucket, band, id, component, signature, keys, main (whether the component is the bucket's largest), n_main and
    n_other. Members of the largest component are compared with the others only, and these with each other too; both kinds
    are dealt out in blocks, a pair of blocks to a cell. A pair that shares buckets of several bands is given once, by the
    first of these bands. forest: pairs that others of the same two blocks connect already are left out, so n members give
    n - 1 pairs at most.
    """
    kind = members.schema["id"].dataType.simpleString()
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))
    own = members.withColumn("own", F.pmod(F.xxhash64("id"), F.when(F.col("main"), blocks("n_main")).otherwise(blocks("n_other"))).cast("int"))
    main, other = own.filter("main").withColumn("to", each("n_other")), own.filter("NOT main")
    cells = [
        main.withColumns({"i": -1 - F.col("own"), "j": F.col("to"), "right": F.lit(False)}),
        other.withColumn("to", each("n_main")).withColumns({"i": -1 - F.col("to"), "j": F.col("own"), "right": F.lit(True)}),
        other.withColumn("to", each("n_other")).withColumns({"i": F.least("own", "to"), "j": F.greatest("own", "to"), "right": F.col("own") > F.col("to")}),
    ]
    dealt = [c.select("bucket", "i", "j", "right", "band", "id", F.xxhash64("component").alias("component"), "signature", "keys") for c in cells]
    cell = dealt[0].union(dealt[1]).union(dealt[2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(k).to_numpy() for k in range(3)], axis=1)
            starts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            if held and [c[0].as_py() for c in held[-1].columns[:3]] != keys[0].tolist():
                yield from pairs(held)
                held = []
            for x, y in zip(starts[:-2], starts[1:-1]):
                yield from pairs([*held, batch.slice(x, y - x)])
                held = []
            held.append(batch.slice(starts[-2]))
        if held:
            yield from pairs(held)

    def pairs(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        n = rows.num_rows
        split = rows.column("i")[0] != rows.column("j")[0]
        side = rows.column("right").to_numpy()
        band = rows.column("band")[0].as_py()
        component = rows.column("component").to_numpy().copy()
        signature, keys = (np.frombuffer(b"".join(rows.column(c).to_pylist()), t).reshape(n, -1) for c, t in (("signature", np.uint64), ("keys", np.uint32)))
        ids = rows.column("id").combine_chunks()
        rights = np.flatnonzero(side) if split else np.arange(n)
        for left in np.flatnonzero(~side).tolist() if split else range(n):
            rest = rights if split else rights[left + 1 :]
            rest = rest[component[rest] != component[left]]
            likeness = estimates(signature[left], signature[rest], count)
            near = (likeness >= least) & ~(keys[left, :band] == keys[rest, :band]).any(axis=1)
            rest = rest[near]
            if forest and len(rest):
                best = np.argsort(-likeness[near], kind="stable")
                met, firsts = np.unique(component[rest[best]], return_index=True)
                rest = rest[best[firsts]]
                component[np.isin(component, met)] = component[left]
            if len(rest):
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rest)), ids.take(pa.array(np.full(len(rest), left)))], names=["a", "b"])

    keyed = cell.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    found = keyed.mapInArrow(run, f"a {kind}, b {kind}")
    return found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80, bands: int = 28, rows: int = 4) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    Two documents are linked if 100 * |A & B| >= percent * |A | B| for their sets of word shingles; component_id is the
    smallest id reachable over links, kept is true for the document of that id. A null or empty text, or one of white
    space, has an empty set: it is linked with nothing and kept. A row with a null id is no document: its component is
    null and it is kept. Rows that repeat an id are one document and get one result each. Other columns are not read.
    A pair at the threshold of 80 is missed by all buckets with a chance of about 4e-7 (28 bands of 4 rows), and by its
    estimate, which may fall 5 standard deviations short, with one of about 3e-7.
    """
    count = bands * rows
    least = _least(percent, count)
    held = materialize(sketch(docs, id_col, text_col, size, bands, rows), "sketch")
    known = held.filter("id is not null and n > 0")
    classes = known.groupBy("set_hash", "n").agg(F.min("id").alias("rep"))
    reps = known.join(classes.select(F.col("rep").alias("id"), F.lit(True).alias("is_rep")).distinct(), "id", "left_semi").dropDuplicates(["id"])

    spread = reps.select("id", F.posexplode("keys").alias("band", "bucket"))
    sizes = spread.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    shared = materialize(spread.join(sizes, "bucket"), "buckets")
    weight = shared.groupBy("id").agg(F.sum("size").alias("weight"))
    weighed = shared.join(weight, "id")
    # written, so that Spark can split a bucket of very many members in the join
    pivots = materialize(weighed.groupBy("bucket").agg(F.max(F.struct("weight", "id"))["id"].alias("pivot")), "pivots")
    stars = shared.join(pivots, "bucket").filter("id != pivot").select(F.greatest("id", "pivot").alias("a"), F.least("id", "pivot").alias("b")).distinct()

    signatures = materialize(reps.join(weight.select("id"), "id", "left_semi").select("id", "signature", "short_keys"), "signatures")
    named = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = materialize(named.join(weight.select("id"), "id", "left_semi").dropDuplicates(["id"]), "candidate-texts")
    links = materialize(confirmed(_likely(stars, signatures, count, least), texts, size, percent), "links")

    def apart(found: DataFrame) -> DataFrame:
        """The members of buckets that hold more than one component, with what _across needs to know of these."""
        joined = shared.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
        each = joined.groupBy("bucket", "component").agg(F.count("*").alias("n"))
        largest = each.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("size"), F.count("*").alias("components")).filter("components > 1")
        open_ = materialize(largest.select("bucket", F.col("top.component").alias("largest"), F.col("top.n").alias("n_main"), (F.col("size") - F.col("top.n")).alias("n_other")), "open-buckets")
        held = joined.drop("size").join(open_, "bucket").withColumn("main", F.col("component") == F.col("largest"))
        return materialize(held.drop("largest"), "apart")

    def joined(links: DataFrame, more: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
        """All links, and their components: found, if there are no more."""
        return (links, found) if more.isEmpty() else (links.union(more), connected_components(links.union(more)))

    found = connected_components(links)
    before = apart(found)
    wide = wide_signatures(texts.join(before.select("id").distinct(), "id", "left_semi"), size)
    signed = materialize(signatures.select("id", F.col("short_keys").alias("keys")).join(wide, "id"), "wide-signatures")
    forest = _across(before.join(signed, "id"), WIDE, percent / 100, forest=True)
    links, found = joined(links, materialize(confirmed(forest, texts, size, percent), "links"), found)
    rest = _across(apart(found).join(signed, "id"), WIDE, _least(percent, WIDE))
    links, found = joined(links, materialize(confirmed(rest, texts, size, percent), "links"), found)

    # written, so that Spark can split a class of very many copies in the join
    of_class = materialize(classes.join(found.withColumnRenamed("id", "rep"), "rep", "left").select("set_hash", "n", F.coalesce("component", "rep").alias("component")), "classes")
    out = held.join(of_class, ["set_hash", "n"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
