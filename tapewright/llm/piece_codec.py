"""SentencePiece (BPE) encoding and decoding by a prefix table.

For each prefix of a stretch of text the table stores the last token of that prefix's encoding. That token is unique: it
is the one automaton match that ends there, starts at the text's begin or after a prefix whose own last token forms a
compatible pair with it. A pair is compatible if merging the two tokens' joint text gives just these two tokens. Ids
are read off backwards from the whole stretch. Work is linear in the text's length, whatever it holds.

A text is cut, before encoding, only where no token can reach across: before each space mark that follows another
character, and around characters that no token of two or more characters holds.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import clash, slices

MARK = "▁"
#: Pairs, and characters of stretches, remembered by a worker; a full memory is emptied, which changes no result.
MAX_REMEMBERED = 250_000
MAX_REMEMBERED_CHARS = 5_000_000
NEVER = float("-inf")


class Remembered(dict):
    """Stretches met so far: each one's place in `bounds`, which bounds its ids in `flat`."""

    def __init__(self, encode: Callable[[str], tuple[int, ...]]) -> None:
        super().__init__()
        self.encode, self.flat, self.bounds, self.chars = encode, array("i"), array("q", [0]), 0

    def __missing__(self, stretch: str) -> int:
        self.flat.extend(self.encode(stretch))
        self.bounds.append(len(self.flat))
        self.chars += len(stretch)
        self[stretch] = place = len(self.bounds) - 2
        return place


class PieceCodec:
    """A BPE model with byte fallback: the vocabulary, the automaton over it, and the pair tests made so far."""

    def __init__(self, pieces: list[tuple[str, float]], byte_ids: list[int], first_id: int, add_prefix: bool) -> None:
        """pieces: the ordinary pieces and their scores, ids counting from first_id; byte_ids: the ids of bytes 0 to 255."""
        import ahocorasick

        self.ids = {p: first_id + k for k, (p, _) in enumerate(pieces)}
        self.score = {p: s for p, s in pieces}
        self.byte_ids, self.add_prefix = byte_ids, add_prefix
        raw = {first_id + k: p.replace(MARK, " ").encode() for k, (p, _) in enumerate(pieces)} | {i: bytes([b]) for b, i in enumerate(byte_ids)}
        self.surface = pa.array([raw.get(i, b"") for i in range(first_id + len(pieces))], pa.binary())
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        self.joined = {c for p in self.ids if len(p) > 1 for c in p}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece holds a space mark behind another character; texts can't be cut at spaces")
        held = "".join(re.escape(c) for c in sorted(self.joined - {MARK}))
        self.stretch = re.compile(rf"{MARK}+[{held}]*|[{held}]+|[^{MARK}{held}]")
        self.pairs: dict[tuple[str, str], bool] = {}
        self.alone: dict[str, bool] = {}
        self.known = Remembered(self.encode_stretch)

    def merged(self, text: str) -> list[str]:
        """The defining procedure, for the short texts of pair tests: merge the best-scored pair, leftmost first."""
        parts, score = list(text), self.score.get
        gains = [score(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while gains and (best := max(gains)) != NEVER:
            at = gains.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del gains[at]
            if at:
                gains[at - 1] = score(parts[at - 1] + parts[at], NEVER)
            if at < len(gains):
                gains[at] = score(parts[at] + parts[at + 1], NEVER)
        return parts

    def compatible(self, left: str, right: str) -> bool:
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs) >= MAX_REMEMBERED:
                self.pairs.clear()
            found = self.pairs[left, right] = self.merged(left + right) == [left, right]
        return found

    def reachable(self, piece: str) -> bool:
        found = self.alone.get(piece)
        if found is None:
            found = self.alone[piece] = self.merged(piece) == [piece]
        return found

    def encode_stretch(self, text: str) -> tuple[int, ...]:
        n = len(text)
        last: list[str | None] = [None] * (n + 1)  # last[i]: the last token of text[:i]
        pairs = self.pairs
        for end, piece in self.automaton.iter(text):
            start = end + 1 - len(piece)
            if start == 0:
                if self.reachable(piece):
                    last[end + 1] = piece
            elif last[end + 1] is None:
                before = last[start]
                if before is None:
                    if text[start - 1] not in self.score and self.reachable(piece):  # behind an unknown character
                        last[end + 1] = piece
                else:
                    fits = pairs.get((before, piece))
                    if fits is None:
                        fits = self.compatible(before, piece)
                    if fits:
                        last[end + 1] = piece
        out: list[int] = []
        at = n
        while at:
            piece = last[at]
            if piece is None:  # a character that the vocabulary lacks: its bytes
                out.extend(self.byte_ids[b] for b in reversed(text[at - 1].encode("utf-8", "surrogatepass")))
                at -= 1
            else:
                out.append(self.ids[piece])
                at -= len(piece)
        out.reverse()
        return tuple(out)

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and the bounds of each text's ids in it."""
        prefix = MARK if self.add_prefix else ""
        cut = [self.stretch.findall(prefix + t.replace(" ", MARK)) if t else [] for t in texts]
        known = self.known
        place = np.fromiter(map(known.__getitem__, chain.from_iterable(cut)), np.int64, sum(map(len, cut)))
        bounds = np.array(known.bounds, np.int64)
        starts, sizes = bounds[place], bounds[place + 1] - bounds[place]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = np.array(known.flat, np.int32)[np.arange(total) + np.repeat(starts - (ends - sizes), sizes)]
        of_text = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum([len(c) for c in cut])])]
        if known.chars > MAX_REMEMBERED_CHARS:
            self.known = Remembered(self.encode_stretch)
        return ids, of_text.astype(np.int64)

    def decode_all(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The texts of ids[bounds[k]:bounds[k + 1]]; bytes that are no UTF-8 become U+FFFD, as in any lossy decoder."""
        taken = self.surface.take(pa.array(ids))
        _, ends, data = taken.buffers()
        raw = data.to_pybytes() if data else b""
        at = np.frombuffer(ends, np.int32)[bounds + taken.offset].tolist() if len(ids) else [0] * len(bounds)
        out = [raw[a:b].decode("utf-8", "replace") for a, b in zip(at, at[1:])]
        return [t[1:] if t.startswith(" ") else t for t in out] if self.add_prefix else out

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode(self, ids: list[int]) -> str:
        return self.decode_all(np.array(ids, np.int32), np.array([0, len(ids)]))[0]


def read_model(path: str) -> dict:
    """The vocabulary of a SentencePiece BPE model with byte fallback, read with the library's own accessors."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.vocab_size()
    bytes_ = {model.id_to_piece(i): i for i in range(n) if model.is_byte(i)}
    ordinary = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    if ordinary != list(range(ordinary[0], n)) or len(bytes_) != 256:
        raise ValueError("the ordinary pieces must follow each other and all bytes must have a piece")
    prefixed = model.encode("a") != model.encode(" a")
    return {"pieces": [(model.id_to_piece(i), model.get_score(i)) for i in ordinary], "byte_ids": [bytes_[f"<0x{b:02X}>"] for b in range(256)], "first_id": ordinary[0], "add_prefix": prefixed}


@lru_cache(maxsize=2)
def _codec(key: str, held) -> PieceCodec:
    return PieceCodec(**held.value)


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """One row per input row: id, the carried columns, ids array<int> (the whole text's token ids), decoded string (made from the ids alone).

    A null text counts as empty: no ids, an empty decoded text. Null ids and repeated rows are kept as they are; other
    columns are not read, and carried ones must not be named as the result's own. The model file is read on the driver and its vocabulary, whose size the model fixes, is
    broadcast. Each row is worked on alone, so nothing is shuffled.
    """
    clash(carry, id_col, ("ids", "decoded"))
    held = docs.sparkSession.sparkContext.broadcast(read_model(model_path))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model_path, held)
        for batch in batches:
            for part in slices(batch, 1):
                ids, bounds = codec.encode_all([t or "" for t in part.column(1).to_pylist()])
                decoded = codec.decode_all(ids, bounds)
                listed = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), *part.columns[2:], listed, pa.array(decoded, pa.string())], names=[id_col, *carry, "ids", "decoded"])

    carried = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in carry)
    texts = docs.select(F.col(id_col), F.col(text_col).alias("encoded text"), *carry)
    return texts.mapInArrow(run, f"`{id_col}` {kind}, {carried}ids array<int>, decoded string")
