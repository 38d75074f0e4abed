"""Repeated paragraphs by MinHash banding.

A paragraph is a stretch of the whole word sequence between two places that the words
themselves choose: a run of four words whose hash is the least among all that begin up to
``WINDOW`` words before or after it. Lines do not matter, so a passage copied into the middle of a line falls
into the same stretches as in its source, but for its two ends. Stretches within a text have
more than ``WINDOW`` words; what is left before the first place and after the last may be shorter.

Paragraphs with equal words are one node from the start. A node's word shingles are hashed
by ``bands * rows`` functions; two nodes whose minima agree in a whole band meet. With 6 bands of
3 rows a pair of similarity 0.8 meets with probability 1 - (1 - 0.8^3)^6 = 0.987, one of 0.9 with
0.9996 and one of 0.3 with 0.15. Meeting nodes are verified by the exact Jaccard similarity of
their shingles.

A bucket never becomes all its pairs: first every node is verified against the least node of
each of its buckets, and then only nodes whose components still differ meet each other, so a
crowd of near copies costs its size. Components of the verified links are the classes; all
but the first paragraph of a class are removals.

A paragraph whose few shingles no other text can share (``_alone``) has only equal ones for
company, which its node unites; it gets no band keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import table
from larkspur.llm.components import components
from larkspur.session import durable

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 6, 3
#: words on either side of a place among which its run of GRAM words has the least hash
WINDOW, GRAM = 12, 4
#: shorter beginnings and ends of texts take no part, but for texts that are no longer as a whole; no stretch within a text is as short
MIN_WORDS = 12

#: nodes of a bucket that are compared as one block
CROWD_BLOCK = 256

_WORDS_KEPT = 300_000
_TEXTS_SEEN = 100_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row, by doubling."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:-step], out[step:])
        done += step
    return out


def gram_hashes(words: list[bytes], hashes: dict) -> np.ndarray:
    """A hash for each run of GRAM words."""
    own = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = len(own) - GRAM + 1
    mixed = np.zeros(max(n, 0), dtype=np.uint64)
    for j in range(GRAM):
        mixed = (mixed ^ own[j : j + len(mixed)]) * _ODD
        mixed ^= mixed >> np.uint64(31)
    return mixed


def stretches(words: list[bytes], hashes: dict, window: int) -> list[int]:
    """Ends of the stretches of a word sequence; of equal least hashes in a window the first counts."""
    if not words:
        return []
    h = gram_hashes(words, hashes)
    if len(h) < 2:
        return [len(words)]
    edge = np.full(window, np.iinfo(np.uint64).max, dtype=np.uint64)
    least = _least(np.r_[edge, h, edge], window)
    before, after = least[: len(h)], least[window + 1 : window + 1 + len(h)]
    places = np.flatnonzero((h < before) & (h <= after))
    return [*places[places > 0].tolist(), len(words)]


def paragraphs(text: bytes | None, hashes: dict, window: int = WINDOW, least_words: int = MIN_WORDS) -> Iterator[tuple[int, bytes]]:
    """(number, words joined by one blank, A-Z lower-cased) of each stretch that takes part; numbers count all stretches."""
    words = (text or b"").lower().split()
    begin = 0
    for n, end in enumerate(stretches(words, hashes, window)):
        if end - begin >= least_words or end - begin == len(words):
            yield n, b" ".join(words[begin:end])
        begin = end


def short_repeats(docs: DataFrame, below: int = MIN_WORDS) -> DataFrame:
    """(line, n_words, n_lines) of every line of 1 to ``below`` - 1 words that stands more than once, over all documents.

    Such lines, licence phrases or headings, say little about the documents that hold them, so they
    are counted and name no document. Equal lines are added up in tasks first.
    """
    words = F.filter(F.split(F.lower("text"), r"[ \t\x0B\f\r]+"), lambda w: w != "")
    lines = docs.select(F.explode(F.split("text", "\n")).alias("text")).select(words.alias("w"))
    short = lines.filter(F.size("w").between(1, below - 1)).select(F.array_join("w", " ").alias("line"), F.size("w").alias("n_words"))
    return short.groupBy("line").agg(F.first("n_words").alias("n_words"), F.count("*").alias("n_lines")).filter("n_lines > 1")


def shingles(words: bytes, size: int = SHINGLE) -> set[bytes]:
    """The runs of ``size`` words; a shorter text is one run."""
    own = words.split(b" ")
    return {b" ".join(own[i : i + size]) for i in range(max(len(own) - size + 1, 1))}


def similarity(a: bytes, b: bytes, size: int = SHINGLE) -> float:
    x, y = shingles(a, size), shingles(b, size)
    both = len(x & y)
    return both / (len(x) + len(y) - both)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS_KEPT:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def band_keys(texts: list[bytes], hashes: dict, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One row of band keys for each text of joined words."""
    coins = np.random.default_rng(20).integers(1, 1 << 62, (2, bands * rows), dtype=np.uint64)
    words = [t.split(b" ") for t in texts]
    counts = np.array([len(w) for w in words])
    flat = np.fromiter((hashes[w] for own in words for w in own), dtype=np.uint64, count=int(counts.sum()))
    ends = np.cumsum(counts)
    starts = ends - counts
    width = np.minimum(counts, size)
    # the hash of the shingle at each word; past the last start of a text it takes in no more words
    place = np.arange(len(flat)) - np.repeat(starts, counts)
    inside = place <= np.repeat(counts - width, counts)
    mixed = np.zeros(len(flat), dtype=np.uint64)
    left = np.repeat(ends, counts)
    at = np.arange(len(flat))
    for j in range(size):
        take = at + j < left
        mixed[take] = (mixed[take] ^ flat[at[take] + j]) * _ODD
        mixed ^= mixed >> np.uint64(29)
    mixed = mixed[inside]
    first = np.cumsum(np.r_[0, counts - width + 1])[:-1]
    minima = np.empty((len(texts), bands * rows), dtype=np.uint64)
    for k in range(bands * rows):
        minima[:, k] = np.minimum.reduceat((mixed ^ coins[0, k]) * (coins[1, k] | np.uint64(1)), first)
    keys = np.zeros((len(texts), bands), dtype=np.uint64)
    for r in range(rows):
        keys = (keys ^ minima[:, r::rows]) * _ODD
        keys ^= keys >> np.uint64(31)
    return keys


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))


def _alone(words: bytes, size: int, least: float) -> bool:
    """Whether no other text can have the similarity ``least``, so that only equal texts are one class.

    A text shorter than a shingle is one run, which no other text has. With k shingles, other
    sets come to k / (k + 1) at most; the same set in another text needs a run of size - 1 words
    that stands twice, else there is one way to string the shingles together.
    """
    n = words.count(b" ") + 2 - size
    if n < 1:
        return True
    if n >= least * (n + 1):
        return False
    own = words.split(b" ")
    joints = {b" ".join(own[i : i + size - 1]) for i in range(n + 1)}
    return len(joints) == n + 1


def places(docs: DataFrame, window: int, least_words: int, size: int, bands: int, rows: int, least: float) -> DataFrame:
    """(doc_id, paragraph, node, short, keys): where each text stands; the node is a 128-bit digest of its words.

    ``keys`` are the band keys, the band number being part of each. They stand with the first of equal texts a
    task has seen lately and are empty with the others, so a very common text is sent a few times; a text that
    no other can be like has none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = _WordHashes(), set()
        offsets = np.arange(bands, dtype=np.uint64) * _ODD
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                ids, numbers, nodes, fresh, texts = [], [], [], [], []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1)):
                    for n, words in paragraphs(text.as_py(), hashes, window, least_words):
                        node = xxhash.xxh3_128_digest(words)
                        if node not in seen and not _alone(words, size, least):
                            seen.add(node)
                            fresh.append(len(nodes))
                            texts.append(words)
                        ids.append(doc_id)
                        numbers.append(n)
                        nodes.append(node)
                if len(seen) > _TEXTS_SEEN:
                    seen.clear()
                many = np.zeros(len(nodes), dtype=np.int32)
                many[fresh] = bands
                keys = (band_keys(texts, hashes, size, bands, rows) + offsets).view(np.int64).ravel() if texts else np.zeros(0, np.int64)
                listed = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(many)].astype(np.int32)), pa.array(keys))
                columns = [pa.array(ids, pa.int64()), pa.array(numbers, pa.int32()), pa.array(nodes, pa.binary()), pa.array(_short(nodes)), listed]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "paragraph", "node", "short", "keys"])

    return _texts(docs).mapInArrow(run, "doc_id long, paragraph int, node binary, short long, keys array<long>")


def _short(digests: list[bytes]) -> np.ndarray:
    """The first half of each digest as a number: what travels with the band keys.

    Should two texts share it, both are looked up; that only adds candidates.
    """
    return np.frombuffer(b"".join(digests), ">i8").reshape(-1, 2)[:, 0].astype(np.int64)


def _meeting(text: bytes | None, hashes: dict, window: int, least_words: int, size: int, least: float) -> Iterator[bytes]:
    """The words of the paragraphs that may be like other texts."""
    return (w for _, w in paragraphs(text, hashes, window, least_words) if not _alone(w, size, least))


def buckets(stood: DataFrame) -> DataFrame:
    """(bucket, short): the band keys of the nodes."""
    return stood.select(F.explode("keys").alias("bucket"), "short")


def crowds(keys: DataFrame) -> DataFrame:
    """(bucket, short, leader): buckets in which different nodes meet, with the least of each.

    One shuffle brings a bucket together in order; what stands alone goes no further.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_bucket, leader, last, told = None, 0, 0, False
        for batch in batches:
            if not len(batch):
                continue
            bucket, short = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            goes_on = open_bucket is not None and bucket[0] == open_bucket
            start = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            own = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(bucket)]))
            first = short[start].copy()
            if goes_on:
                first[0] = leader
            lead = first[own]
            before = np.r_[last if goes_on else short[0], short[:-1]]
            new = (short != lead) & ((short != before) | np.r_[not goes_on, bucket[1:] != bucket[:-1]])
            heads = np.unique(own[new])
            if goes_on and told:
                heads = heads[heads != 0]
            out = (np.r_[bucket[new], bucket[start[heads]]], np.r_[short[new], first[heads]], np.r_[lead[new], first[heads]])
            told = bool(new[own == own[-1]].any() or (goes_on and told and own[-1] == 0))
            open_bucket, leader, last = bucket[-1], first[-1], short[-1]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["bucket", "short", "leader"])

    dealt = keys.repartition("bucket").sortWithinPartitions("bucket", "short")
    return dealt.mapInArrow(run, "bucket long, short long, leader long")


def _words_of(docs: DataFrame, shorts: DataFrame, window: int, least_words: int, size: int, least: float) -> DataFrame:
    """(short, node, words) of the given nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            for at in range(0, len(batch), 512):
                texts = list({w for text in batch.column(0).slice(at, 512) for w in _meeting(text.as_py(), hashes, window, least_words, size, least)})
                nodes = [xxhash.xxh3_128_digest(t) for t in texts]
                yield pa.RecordBatch.from_arrays([pa.array(_short(nodes)), pa.array(nodes, pa.binary()), pa.array(texts, pa.binary())], names=["short", "node", "words"])

    every = _texts(docs).select("text").mapInArrow(run, "short long, node binary, words binary")
    return every.join(shorts, "short", "left_semi").groupBy("short", "node").agg(F.first("words").alias("words"))


def _verified(pairs: DataFrame, words: DataFrame, size: int, least: float) -> DataFrame:
    """Links (a, b) of nodes among the pairs (x, y) of their short forms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            like = [similarity(x.as_py(), y.as_py(), size) >= least for x, y in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(like, pa.bool_()))

    one = words.select(F.col("short").alias("x"), F.col("node").alias("a"), F.col("words").alias("wa"))
    two = words.select(F.col("short").alias("y"), F.col("node").alias("b"), F.col("words").alias("wb"))
    return pairs.join(one, "x").join(two, "y").select("a", "b", "wa", "wb").mapInArrow(run, "a binary, b binary")


def _across(torn: DataFrame, size: int, least: float) -> DataFrame:
    """Links (a, b) between nodes (bucket, node, root, words) of one bucket and different roots.

    A bucket is cut into blocks and every two blocks meet in a group of their own, of bounded
    size, which passes on links alone, one for two roots at most.
    """

    def compared(rows: list[tuple]) -> list[tuple[bytes, bytes]]:
        low, high = rows[0][:2]
        sets = [(part, node, root, shingles(words, size)) for _, _, part, node, root, words in rows]
        left = [x for x in sets if x[0] == low]
        right = left if low == high else [x for x in sets if x[0] == high]
        joined: dict = {}

        def top(r):
            while r in joined:
                r = joined[r]
            return r

        found = []
        for i, (_, a, ra, x) in enumerate(left):
            for _, b, rb, y in right[i + 1 :] if low == high else right:
                if ra == rb or min(len(x), len(y)) < least * max(len(x), len(y)):
                    continue
                both = len(x & y)
                if both < least * (len(x) + len(y) - both):
                    continue
                ta, tb = top(ra), top(rb)
                if ta != tb:
                    joined[ta] = tb
                    found.append((a, b))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the rows of a group follow each other; most groups have few, so they are not worth a call of their own
        key, rows = None, []
        for batch in batches:
            found = []
            for bucket, *row in zip(*(c.to_pylist() for c in batch.columns)):
                own = (bucket, *row[:2])
                if own != key:
                    if len(rows) > 1:
                        found += compared(rows)
                    key, rows = own, []
                rows.append(row)
            yield _pairs(found)
        yield _pairs(compared(rows) if len(rows) > 1 else [])

    counts = torn.groupBy("bucket").agg(F.ceil(F.count("*") / CROWD_BLOCK).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part")
    dealt = torn.join(counts, "bucket").select("*", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("bucket", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "node", "root", "words")
    together = dealt.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    return together.select("bucket", "low", "high", "part", "node", "root", "words").mapInArrow(run, "a binary, b binary")


def _pairs(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], pa.binary()) for i in (0, 1)], names=["a", "b"])


def classes(
    docs: DataFrame,
    shingle: int = SHINGLE,
    least: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    window: int = WINDOW,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """(doc_id, paragraph, class_doc_id, class_paragraph, n_members, removed) of every paragraph that repeats.

    ``paragraph`` is the number of a stretch within its document, from 0. A text of fewer than ``min_words``
    words is one paragraph; of a longer one, a beginning or end of fewer takes no part. The class is named by its
    first member by (doc_id, paragraph), which alone is kept. Null and empty texts have no
    paragraphs; a text of one word over and over is one; very long texts are cut like others. Rows that repeat
    a document repeat its paragraphs; a null doc_id sorts first. Documents without repeats give no row, and
    neither do no documents. Other columns are not read.
    """
    stood = durable(places(docs, window, min_words, shingle, bands, rows, least))
    crowd = durable(crowds(buckets(stood)))
    words = durable(_words_of(docs, crowd.select("short").distinct(), window, min_words, shingle, least))
    first = crowd.filter("short != leader").select(F.col("leader").alias("x"), F.col("short").alias("y")).distinct()
    linked = durable(_verified(first, words, shingle, least))
    # nodes of one bucket that are not yet connected
    root = components(linked)
    ids = words.select("short", "node").join(root, "node", "left").select("short", F.coalesce("root", "node").alias("root"))
    rooted = crowd.select("bucket", "short").join(durable(ids), "short")
    split = rooted.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi").select("bucket")
    torn = durable(rooted.join(split, "bucket"))
    more = _across(torn.join(words, "short").select("bucket", "node", "root", "words"), shingle, least)
    root = durable(components(linked.unionByName(more)))
    # most nodes stand once and are linked to none: they go no further
    nodes = stood.groupBy("node").agg(F.min(F.struct("doc_id", "paragraph")).alias("first"), F.count("*").alias("n"))
    nodes = durable(nodes.join(root, "node", "left").filter("n > 1 OR root IS NOT NULL").withColumn("root", F.coalesce("root", "node")))
    sizes = nodes.groupBy("root").agg(F.min("first").alias("first"), F.sum("n").alias("n_members")).filter("n_members > 1")
    named = durable(nodes.select("node", "root").join(sizes, "root").drop("root"))
    place = F.struct("doc_id", "paragraph")
    return stood.join(named, "node").select(
        "doc_id",
        "paragraph",
        F.col("first.doc_id").alias("class_doc_id"),
        F.col("first.paragraph").alias("class_paragraph"),
        "n_members",
        (~place.eqNullSafe(F.col("first"))).alias("removed"),
    )


def query(spark, sf_dir):
    return classes(table(spark, sf_dir, "documents"))
