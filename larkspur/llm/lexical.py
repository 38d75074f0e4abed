"""Ranked lexical search, term at a time over short lists and document at a time over long ones.

Documents become shards in tasks: a shard holds the posting lists of the asked terms over some
thousand documents in the order of their ids, as one stored row, so ranking needs no shuffle of
postings. Counts of all shards give the weights. Each shard then ranks every item: its short
lists are summed into accumulators, which join the long lists as one more iterator with a bound.
Windows of documents are scored from the lists that alone could lift a document into the top,
and the others are only looked up for candidates whose bound still reaches it. The tops of the
tasks, a few rows each, meet in a window over the item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.llm.common import ascii_lower, table
from larkspur.session import durable

K = 50
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: item terms and items that are searched in one pass over the documents
BLOCK_TERMS, BLOCK_ITEMS = 1 << 18, 1 << 12
#: text bytes of a shard, and documents scored between two looks at the threshold
SHARD_BYTES, WINDOW = 32 << 20, 2048
#: share of a shard's documents up to which the shortest lists together count as short
SHORT = 0.125

_PIECE = 1 << 20
#: tasks whose tops meet in a first step
_FAN = 64
_INDEX = "n_docs long, n_terms long, ids array<long>, lengths binary, terms array<int>, counts array<long>, places binary, times binary"
_INDEX_ARROW = pa.schema(
    [
        ("n_docs", pa.int64()),
        ("n_terms", pa.int64()),
        ("ids", pa.list_(pa.int64())),
        ("lengths", pa.binary()),
        ("terms", pa.list_(pa.int32())),
        ("counts", pa.list_(pa.int64())),
        ("places", pa.binary()),
        ("times", pa.binary()),
    ]
)
_TOP_ARROW = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64()), ("part", pa.int32())])


def _separators() -> bytes:
    """Byte to byte: A-Z lower-cased, digits, letters and bytes beyond ASCII kept, all others a blank."""
    kept = lambda b: b >= 128 or chr(b).isalnum()
    return bytes(ord(chr(b).lower()) if b < 128 and kept(b) else b if kept(b) else 32 for b in range(256))


def _pieces(text: bytes) -> Iterator[bytes]:
    """A normalised text in parts of bounded length, cut at blanks."""
    at = 0
    while len(text) - at > _PIECE:
        cut = text.find(b" ", at + _PIECE)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text


class _Shard:
    """Documents of a task until they are enough for a row of the index."""

    def __init__(self, number_of):
        self.number_of = number_of
        self.clear()

    def clear(self) -> None:
        self.size = self.n_docs = self.n_terms = 0
        self.ids, self.lengths, self.found = [], [], []

    def add(self, doc_id: int | None, text: bytes, plain: bytes) -> None:
        n, found = 0, []
        for piece in _pieces(text.translate(plain)):
            words = piece.split()
            n += len(words)
            numbers = np.fromiter(map(self.number_of, words, repeat(-1)), np.int32, len(words))
            found.append(numbers[numbers >= 0])
        self.size += len(text)
        self.n_docs += n > 0
        self.n_terms += n
        own = np.concatenate(found)
        if len(own):
            self.ids.append(doc_id)
            self.lengths.append(n)
            self.found.append(own)

    def row(self) -> pa.RecordBatch:
        missing = np.array([i is None for i in self.ids], dtype=bool)
        ids = np.array([i or 0 for i in self.ids], dtype=np.int64)
        order = np.lexsort((ids, missing))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        sizes = [len(f) for f in self.found]
        term = np.concatenate(self.found) if sizes else np.zeros(0, np.int32)
        key, times = np.unique(term.astype(np.int64) << 32 | np.repeat(place, sizes), return_counts=True)
        terms, counts = np.unique(key >> 32, return_counts=True)
        values = [
            self.n_docs,
            self.n_terms,
            [self.ids[i] for i in order],
            np.array(self.lengths, dtype=np.int64)[order].tobytes(),
            terms.astype(np.int32),
            counts.astype(np.int64),
            (key & 0xFFFFFFFF).astype("<u4").tobytes(),
            times.astype("<u4").tobytes(),
        ]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _INDEX_ARROW)], schema=_INDEX_ARROW)


def index(docs: DataFrame, numbers: dict[bytes, int], shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per shard: counts of all its documents, posting lists of the numbered terms."""
    sent = docs.sparkSession.sparkContext.broadcast(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, shard = _separators(), _Shard(sent.value.get)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                shard.add(doc_id.as_py(), text.as_py() or b"", plain)
                if shard.size >= shard_bytes:
                    yield shard.row()
                    shard.clear()
        yield shard.row()

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return read.mapInArrow(run, _INDEX)


class Postings:
    """The posting lists of one shard, scored by term and document but for the weight."""

    def __init__(self, row: dict, n_docs: int, n_terms: int):
        self.ids = row["ids"]
        length = np.frombuffer(row["lengths"], np.int64)
        place = np.frombuffer(row["places"], "<u4").astype(np.int64)
        times = np.frombuffer(row["times"], "<u4").astype(np.int64)
        m = 100 - 50 + (50 * length * n_docs) // n_terms
        part = (1_000_000_000 * times) // (1000 * times + 20 * m[place]) if len(place) else times
        cuts = np.cumsum(row["counts"])[:-1] if len(row["counts"]) else []
        self.lists = dict(zip(row["terms"], zip(np.split(place, cuts), np.split(part, cuts)))) if len(row["terms"]) else {}
        self.most = {t: int(part.max()) for t, (_, part) in self.lists.items()}

    def top(self, terms: list[int], weight: dict[int, int], k: int, least: int, window: int, short: float) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the k best documents that score above ``least``, ties to the smaller place."""
        held = sorted((t for t in terms if t in self.lists and weight[t] > 0), key=lambda t: len(self.lists[t][0]))
        room, few = int(short * len(self.ids)), 0
        while few < len(held) and len(self.lists[held[few]][0]) <= room:
            room -= len(self.lists[held[few]][0])
            few += 1
        runs = [(self.most[t] * weight[t], *self.lists[t], weight[t]) for t in held[few:]]
        if few:
            runs.append(self._accumulated(held[:few], weight))
        runs.sort(key=lambda r: r[0])
        reach = np.cumsum([r[0] for r in runs])
        at, score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        marks = np.arange(0, len(self.ids) + window, window)
        edges = [np.searchsorted(r[1], marks) for r in runs]
        for w, low in enumerate(marks[:-1]):
            # lists that together cannot lift a document above the threshold give no candidates
            first = int(np.searchsorted(reach, least, side="right"))
            if first == len(runs):
                break
            sums = np.zeros(window, np.int64)
            for i in range(first, len(runs)):
                cut = slice(edges[i][w], edges[i][w + 1])
                sums[runs[i][1][cut] - low] += runs[i][2][cut] * runs[i][3]
            found = np.flatnonzero(sums)
            for i in range(first - 1, -1, -1):
                found = found[sums[found] + reach[i] > least]
                if not len(found):
                    break
                own = runs[i][1]
                spot = np.searchsorted(own, found + low)
                hit = spot < edges[i][w + 1]
                hit[hit] = own[spot[hit]] == found[hit] + low
                sums[found[hit]] += runs[i][2][spot[hit]] * runs[i][3]
            found = found[sums[found] > least]
            if len(found):
                at, score = np.r_[at, found + low], np.r_[score, sums[found]]
                best = np.lexsort((at, -score))[:k]
                at, score = at[best], score[best]
                if len(at) == k:
                    least = max(least, int(score[-1]))
        return at, score

    def _accumulated(self, terms: list[int], weight: dict[int, int]) -> tuple:
        """The sums of short lists as one list: (bound, places, scores, 1)."""
        place = np.concatenate([self.lists[t][0] for t in terms])
        score = np.concatenate([self.lists[t][1] * weight[t] for t in terms])
        order = np.argsort(place, kind="stable")
        place, score = place[order], score[order]
        starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        sums = np.add.reduceat(score, starts)
        return int(sums.max()), place[starts], sums, 1


def _merged(old: list[tuple], new: list[tuple], k: int) -> list[tuple]:
    """The k best (score, doc_id), ties to the smaller id, null after all."""
    return sorted(old + new, key=lambda r: (-r[0], r[1] is None, r[1] or 0))[:k]


def _tops(shards: DataFrame, items: list[list[int]], weight: dict[int, int], n_docs: int, n_terms: int, k: int, window: int, short: float) -> DataFrame:
    """(item, doc_id, score, part): the best of each task for each item of a block."""
    sent = shards.sparkSession.sparkContext.broadcast((items, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights = sent.value
        best: list[list[tuple]] = [[] for _ in asked]
        for batch in batches:
            for row in batch.to_pylist():
                lists = Postings(row, n_docs, n_terms)
                for i, terms in enumerate(asked):
                    # a later shard may hold an equal score with a smaller id
                    least = best[i][-1][0] - 1 if len(best[i]) == k else 0
                    at, score = lists.top(terms, weights, k, max(least, 0), window, short)
                    if len(at):
                        best[i] = _merged(best[i], [(int(s), lists.ids[p]) for p, s in zip(at, score)], k)
        part = TaskContext.get().partitionId()
        rows = [(i, doc_id, score, part) for i, tops in enumerate(best) for score, doc_id in tops]
        columns = list(zip(*rows)) or [()] * len(_TOP_ARROW)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _TOP_ARROW)], schema=_TOP_ARROW)

    return shards.mapInArrow(run, "item int, doc_id long, score long, part int")


def _best(rows: DataFrame, k: int, *group: str) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _terms(items: DataFrame) -> DataFrame:
    """(item_id, term), once each."""
    found = F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(TERM), 0)
    return items.select(F.col("item_id").cast("long").alias("item_id"), F.explode(found).alias("term")).distinct()


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    block_terms: int = BLOCK_TERMS,
    block_items: int = BLOCK_ITEMS,
    shard_bytes: int = SHARD_BYTES,
    window: int = WINDOW,
    short: float = SHORT,
) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item.

    Rows of items with one item_id are one item that has the terms of all; null is an item_id like
    another. Each row of documents is ranked, so repeated rows take a rank each; a null doc_id comes
    after all others at a tie. Null texts and texts without a term match nothing and do not count;
    no documents or no items give no rows. A text of any length is read in whole, in parts. Only
    doc_id, item_id and text are read.

    Items are dealt by hash into blocks of about ``block_terms`` terms and ``block_items`` items, what
    the driver and a task hold of them; each block reads the documents once.
    """
    spark = docs.sparkSession
    pairs = durable(_terms(items))
    size = pairs.agg(F.count("*").alias("terms"), F.countDistinct(F.struct("item_id")).alias("items")).first()
    blocks = max(math.ceil(size["terms"] / block_terms), math.ceil(size["items"] / block_items))
    found = None
    for block in range(blocks):
        asked = pairs.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block) if blocks > 1 else pairs
        ranked = _search_block(docs, asked.collect(), k, shard_bytes, window, short)
        if ranked is not None:
            found = ranked if found is None else found.unionByName(ranked)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if found is None else found


def _search_block(docs: DataFrame, asked: list, k: int, shard_bytes: int, window: int, short: float) -> DataFrame | None:
    spark = docs.sparkSession
    numbers: dict[bytes, int] = {}
    terms: dict[int | None, list[int]] = {}
    for r in asked:
        terms.setdefault(r["item_id"], []).append(numbers.setdefault(r["term"].encode(), len(numbers)))
    if not numbers:
        return None
    shards = durable(index(docs, numbers, shard_bytes))
    whole = shards.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    if not whole["l"]:
        return None
    held = shards.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.counts").alias("df"))
    value = F.floor(F.lit(1000.0) * F.ln(F.lit(2.0 * whole["n"] + 2.0) / (2.0 * F.col("df") + 1.0))).cast("long")
    # at most the terms of the block
    weight = {r["term"]: r["w"] for r in held.select("term", value.alias("w")).collect()}
    ids = list(terms)
    rows = _tops(shards, [terms[i] for i in ids], weight, whole["n"], whole["l"], k, window, short)
    few = _best(rows.withColumn("fan", F.floor(F.col("part") / _FAN)), k, "item", "fan")
    named = spark.createDataFrame(list(enumerate(ids)), T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", T.LongType())]))
    return _best(few, k, "item").join(named, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def query(spark, sf_dir):
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_SQL = rf"""WITH
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}') AS w FROM documents),
held AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n, w FROM d WHERE len(w) > 0),
whole AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM held),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')) AS term FROM benchmark),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM held) GROUP BY r, term),
weight AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, whole GROUP BY term, nn),
scored AS (SELECT item_id, held.r, doc_id, CAST(sum(weight.w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * nn) // ll))))) AS BIGINT) AS score
  FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN held ON held.r = tf.r, whole GROUP BY item_id, held.r, doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= {K}"""
