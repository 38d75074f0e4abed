"""Best-fit packing of tokenised documents by minimum bin slack.

Documents become token ids in tasks; what the plan needs of them is how many pieces there
are of each length, at most ``capacity`` numbers however large the corpus. The plan takes
the longest piece left, finds by a subset-sum over bitsets the fullest sequence that
holds it, and uses that combination as often as the counts allow. Pieces of one length are
alike, so each one is then given its place from its number among the pieces of its length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import table
from larkspur.session import durable

CAPACITY = 4096
VOCABULARY = "word_bpe_49k.json"
END_ID = 1

_CHUNKS_KEPT = 400_000
_CHUNK_BYTES = 64


def _byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if visible."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class ChunkIds(dict):
    """Packed ids of white-space-free chunks; this vocabulary never joins across white space.

    The full tokeniser spends most of its time before the merges, so a chunk that is one run
    of plain letters goes to the merges directly and letters with a point or comma after
    them are two chunks. Anything else takes the full way; the ids are the same.
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.merge = tokenizer, tokenizer.model.tokenize
        self.characters = _byte_characters()
        self.letters = re.compile("[a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch

    def __missing__(self, chunk: bytes) -> bytes:
        packed = self._ids(chunk)
        if len(chunk) <= _CHUNK_BYTES:
            if len(self) >= _CHUNKS_KEPT:
                self.clear()
            self[chunk] = packed
        return packed

    def _ids(self, chunk: bytes) -> bytes:
        text = chunk.decode("utf-8", "replace")
        if self.letters(text):
            low = text.lower()
            if low != text:
                return self[low.encode()]
            own = text if text.isascii() else "".join([self.characters[b] for b in chunk])
            return np.array([t.id for t in self.merge(own)], dtype="<u4").tobytes()
        if len(text) > 1 and text[-1] in ".," and self.letters(text[:-1]):
            return self[chunk[:-1]] + self[chunk[-1:]]
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def _open(vocabulary: str) -> ChunkIds:
    import public_tokenizers
    from tokenizers import Tokenizer

    return ChunkIds(Tokenizer.from_file(public_tokenizers.path(vocabulary)))


_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("part", pa.int32()),
        ("nth", pa.int64()),
    ]
)


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, nth): nth counts a length's pieces within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, part, seen = _open(vocabulary), TaskContext.get().partitionId(), Counter()
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = b"".join([*map(ids_of.__getitem__, (text.as_py() or b"").split()), end])
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    length = len(own) // 4
                    rows.append((doc_id, piece, at // 4, length, zlib.crc32(own), part, seen[length]))
                    seen[length] += 1
            columns = list(zip(*rows)) or [()] * len(_SCHEMA)
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _SCHEMA)], schema=_SCHEMA)

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return read.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long")


def fullest(counts: dict[int, int], longest: int, capacity: int) -> Counter:
    """The fullest combination that holds a piece of the longest length."""
    room = capacity - longest
    mask, reach, taken = (1 << (room + 1)) - 1, 1, []
    for length in sorted(counts, reverse=True):
        if length > room:
            continue
        left, step = min(counts[length] - (length == longest), room // length), 1
        while left > 0 and not reach >> room & 1:
            step = min(step, left)
            taken.append((length, step, reach))
            reach |= reach << (length * step) & mask
            left, step = left - step, step * 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, Counter({longest: 1})
    for length, step, before in reversed(taken):
        if not before >> total & 1:
            chosen[length] += step
            total -= length * step
    return chosen


def plan(counts: dict[int, int], capacity: int) -> list[tuple[Counter, int]]:
    """(combination, times) until no piece is left.

    Each step leaves some length with fewer pieces than its combination holds, so there are
    at most capacity * (1 + 1 + 1/2 + ... + 1/capacity) steps, however many pieces.
    """
    left, steps = {n: c for n, c in counts.items() if c}, []
    while left:
        chosen = fullest(left, max(left), capacity)
        times = min(left[n] // m for n, m in chosen.items())
        for n, m in chosen.items():
            left[n] -= m * times
            if not left[n]:
                del left[n]
        steps.append((chosen, times))
    return steps


def _places(steps: list[tuple[Counter, int]]) -> dict[str, np.ndarray]:
    """For each length and step: the first piece it uses, how many a sequence, and where they go."""
    used, sequence, rows = Counter(), 0, []
    for chosen, times in steps:
        offset = 0
        for length, many in sorted(chosen.items()):
            rows.append((length, used[length], many, sequence, offset))
            used[length] += many * times
            offset += length * many
        sequence += times
    names = ("length", "first", "many", "sequence", "offset")
    columns = zip(*sorted(rows)) if rows else [()] * len(names)
    return {n: np.array(c, dtype=np.int64) for n, c in zip(names, columns)}


_NTH_BITS = 44


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is one piece that holds the end id alone; repeated rows and null
    doc_ids are packed as the documents they are. No documents give no rows. Only doc_id
    and text are read.
    """
    read = durable(pieces(docs, capacity, vocabulary))
    per_part = durable(read.groupBy("length", "part").agg(F.count("*").alias("n")))
    # at most ``capacity`` rows
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = docs.sparkSession.sparkContext.broadcast(_places(plan(counts, capacity)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = places.value
        keys = (p["length"] << _NTH_BITS) | p["first"]
        for batch in batches:
            length, nth = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            at = np.searchsorted(keys, (length << _NTH_BITS) | nth, side="right") - 1
            turn, inside = np.divmod(nth - p["first"][at], p["many"][at])
            found = [pa.array(p["sequence"][at] + turn), pa.array(p["offset"][at] + inside * length)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *found], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    nth = (F.col("base") + F.col("nth")).alias("nth")
    numbered = read.join(base, ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", nth)
    return numbered.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def query(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))


def stage(spark, docs, sf_dir):
    """The packed pieces of all documents that are left."""
    return pack(docs)
