"""Repeated byte strings by difference-cover ranks.

Every string of ``length`` bytes holds the least hash among its ``GRAM``-byte strings, its anchor.
Windows whose anchor occurs once in the corpus cannot repeat and are left out, without loss. Of the
others, neighbours with one anchor form a piece, and pieces are dealt by their anchor: equal windows
always meet in one share, so a text's bytes travel once, not a key a place and round. Windows of
very frequent anchors are pieces of their own, dealt by their own hash. Copies of a piece keep
only their place: all their windows are repeats.

In a share, places are sampled by the difference cover {1, 2} modulo 3 of their place in the
piece: whatever two places are compared, some offset of 0, 1 or 2 takes both to sampled ones.
Sampled places are ranked by sorting their first bytes, and again by the ranks some steps on, so
that they cover 8, 20, 56 and 98 bytes; equal ranks mean equal strings. A place that is not
sampled is compared through the sampled one after it and the bytes before that: each pair of
residues has a form (bytes, rank, bytes) that both can build. In each form equal neighbours are
one string of ``length`` bytes; all but the first place of it in document order are repeats.

Whole copies of a text meet as digests and are not ranked again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import KEY, row_key, table
from larkspur.session import durable

LENGTH = 100
GRAM = 50
#: bytes of text that are hashed at a time
CHUNK = 1 << 20
#: bytes of pieces among which a task looks for copies before it sends them
TILE = 1 << 25
#: bytes of pieces that are ranked together, and of text whose anchors are counted together
SHARE = 1 << 22
#: an anchor at more places than this has its windows dealt one by one, so many at a time
HOT, BLOCK = 1 << 15, 1 << 16

# what a rank covers after each round, and how far on the ranks are that make the next
FIRST, STEPS = 8, ((6, 12), (18, 36), (42,))
_DEPTH = FIRST + sum(s[-1] for s in STEPS)

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


_TABLES: dict[str, np.ndarray] = {}


def _powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base``, kept for the next call."""
    if name not in _TABLES or len(_TABLES[name]) < n:
        _TABLES[name] = np.cumprod(np.r_[np.uint64(1), np.full(max(n, CHUNK), base)])
    return _TABLES[name][:n]


def _rolling(data: np.ndarray, size: int) -> np.ndarray:
    """A mixed hash of each run of ``size`` bytes; a filter only, so collisions just add candidates."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers("base", _BASE, n), out=sums[1:])
    h = (sums[size:] - sums[:-size]) * _powers("inverse", _BASE_INVERSE, n - size + 1)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _window_min(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by block prefixes and suffixes."""
    n = len(h)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = h
    rows = padded.reshape(-1, width)
    prefix = np.minimum.accumulate(rows, axis=1).ravel()
    suffix = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(suffix[: n - width + 1], prefix[width - 1 : n])


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *row_key(), text)


def _least(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """The hash of each ``GRAM`` bytes of the texts, end to end; text, start and place there of each window within one text, and its least hash."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    h = _rolling(np.frombuffer(b"".join(texts), np.uint8), GRAM)
    counts = sizes - length + 1
    own = np.repeat(np.arange(len(texts)), counts)
    start = np.arange(len(own)) - np.repeat(np.cumsum(counts) - counts, counts)
    place = start + np.repeat(np.cumsum(sizes) - sizes, counts)
    return h, own, start, place, _window_min(h, length - GRAM + 1)[place]


def anchors(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each place that is the least of a window that holds it; of a row of equal hashes the first two."""
    h, own, _, place, least = _least(texts, length)
    width = length - GRAM + 1
    windows = np.zeros(len(h) + width - 1, dtype=np.uint64)
    windows[place + width - 1] = least
    most = ~_window_min(~windows, width)  # of the windows that hold a place
    at = np.flatnonzero(most == h)
    text = np.searchsorted(np.cumsum([len(t) for t in texts]), at, side="right")
    values = h[at]
    third = np.r_[False, False, (values[2:] == values[:-2]) & (values[2:] == values[1:-1]) & (text[2:] == text[:-2])][: len(at)]
    return text[~third], values[~third]


def stretches(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(text, start, windows, anchor) of each run of windows of a text that have one least hash; no text is shorter than ``length``."""
    _, own, start, _, values = _least(texts, length)
    new = np.flatnonzero(np.r_[True, (values[1:] != values[:-1]) | (own[1:] != own[:-1])])
    return own[new], start[new], np.diff(np.r_[new, len(own)]), values[new]


def _chunks(batch: pa.RecordBatch, length: int) -> Iterator[list[tuple]]:
    """The rows (k_id, k_text, text, ...) of a batch whose text is long enough, about ``CHUNK`` bytes at a time."""
    held, size = [], 0
    for row in zip(*[c.to_pylist() for c in batch.columns]):
        if len(row[2]) >= length:
            held.append(row)
            size += len(row[2])
            if size >= CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


def _dealt(share: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(share, the numbers of its entries in their order) of each share."""
    order = np.argsort(share, kind="stable")
    cut = np.flatnonzero(np.diff(share[order])) + 1
    return ((int(share[p[0]]), p) for p in np.split(order, cut) if len(p))


def _packed(numbers: np.ndarray, keys: list[tuple[int, int]]) -> list[bytes]:
    """Document numbers as an index into the documents that occur, and these documents' keys."""
    used, index = np.unique(numbers, return_inverse=True)
    return [index.astype(np.uint32).tobytes(), *(np.array([keys[u][c] for u in used.tolist()], dtype=np.int64).tobytes() for c in (0, 1))]


def _unpacked(rows: list[dict], column: str) -> tuple[np.ndarray, np.ndarray]:
    """(k_id, k_text) of each entry of a column that ``_packed`` made."""
    index = [np.frombuffer(r[column], np.uint32) for r in rows]
    return tuple(np.concatenate([np.frombuffer(r[c], np.int64)[i] for r, i in zip(rows, index)]) for c in ("ids", "texts"))


def _joined(rows: list[dict], column: str, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(r[column], kind) for r in rows])


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    names, types = zip(*[c.split() for c in schema.split(", ")])
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, k in zip(list(zip(*rows)) or [()] * len(names), types)], names=list(names))


def _anchors(docs: DataFrame, length: int, count: int) -> DataFrame:
    """(k_id, k_text, hashes, hot): the anchors of a document that occur twice or more, and those with very many pieces; several rows a document."""
    sent = "share int, docs binary, ids binary, texts binary, hashes binary"

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, own, values = [], [], []
            for rows in _chunks(batch, length):
                text, hashes = anchors([r[2] for r in rows], length)
                own.append(text + len(keys))
                values.append(hashes)
                keys += [r[:2] for r in rows]
            if keys:
                own, values = np.concatenate(own), np.concatenate(values)
                yield _batch([(s, *_packed(own[p], keys), values[p].tobytes()) for s, p in _dealt((values % np.uint64(count)).astype(np.int64))], sent)

    def common(key, frame):
        rows = frame.to_pylist()
        k_id, k_text = _unpacked(rows, "docs")
        values = _joined(rows, "hashes", np.uint64)
        number = _dense(values).astype(np.int64)
        times = np.bincount(number)[number]
        order = np.flatnonzero(times > 1)
        order = order[np.lexsort((values[order], k_text[order], k_id[order]))]
        k_id, k_text, values, hot = k_id[order], k_text[order], values[order], times[order] > HOT
        cut = np.flatnonzero(np.r_[True, (k_id[1:] != k_id[:-1]) | (k_text[1:] != k_text[:-1])]) if len(order) else np.zeros(0, np.int64)
        out = [(int(k_id[a]), int(k_text[a]), values[a:b].tobytes(), values[a:b][hot[a:b]].tobytes()) for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(order)])]
        return pa.Table.from_batches([_batch(out, "k_id long, k_text long, hashes binary, hot binary")])

    return docs.select(*KEY, "text").mapInArrow(send, sent).groupBy("share").applyInArrow(common, "k_id long, k_text long, hashes binary, hot binary")


_SENT = "share int, docs binary, ids binary, texts binary, starts binary, sizes binary, body binary"


def _pieces(docs: DataFrame, shared: DataFrame, length: int, count: int) -> DataFrame:
    """(share, docs, ids, texts, starts, sizes, body): pieces in document order, then their copies, which have a place and a size but no bytes."""

    def message(share: int, held: list[tuple], picked: np.ndarray, keys: list[tuple]) -> tuple:
        pieces = sorted((held[p] for p in picked.tolist()), key=lambda x: (keys[x[0]], x[1]))
        known: set[bytes] = set()
        first, copies = [], []
        for piece in pieces:
            (copies if piece[2] in known else first).append(piece)
            known.add(piece[2])
        both = first + copies
        numbers = [np.array([x[n] for x in both], dtype=np.int64) for n in (0, 1)]
        sizes = np.array([len(x[2]) for x in both], dtype=np.uint32)
        return (share, *_packed(numbers[0], keys), numbers[1].astype(np.uint32).tobytes(), sizes.tobytes(), b"".join(x[2] for x in first))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, held, shares, size = [], [], [], 0

        def out():
            for s, p in _dealt(np.array(shares, dtype=np.int64)):
                yield _batch([message(s, held, p, keys)], _SENT)
            held.clear()
            shares.clear()

        for batch in batches:
            for rows in _chunks(batch, length):
                texts = [r[2] for r in rows]
                common, hot = (np.unique(np.frombuffer(b"".join(h for r in rows for h in r[n]), np.uint64)) for n in (3, 4))
                own, at, windows, values = (x[m] for x, m in ((x, m) for s in [stretches(texts, length)] for m in [np.isin(s[3], common)] for x in s))
                alone = np.isin(values, hot)
                share = (values % np.uint64(count)).astype(np.int64)
                if not held:
                    keys.clear()
                base = len(keys)
                keys += [r[:2] for r in rows]
                for o, a, n, s, single in zip(own.tolist(), at.tolist(), windows.tolist(), share.tolist(), alone.tolist()):
                    for j in range(0, n, BLOCK) if single else [0]:
                        body = texts[o][a + j : a + (min(j + BLOCK, n) if single else n) + length - 1]
                        if single:
                            held += [(base + o, a + j + i, body[i : i + length]) for i in range(len(body) - length + 1)]
                            shares += (_rolling(np.frombuffer(body, np.uint8), length) % np.uint64(count)).tolist()
                            size += len(body) * length
                        else:
                            held.append((base + o, a, body))
                            shares.append(s)
                            size += len(body)
                        if size >= TILE:
                            yield from out()
                            size = 0
        if held:
            yield from out()

    per_doc = shared.groupBy(*KEY).agg(F.collect_list("hashes").alias("hashes"), F.collect_list("hot").alias("hot"))
    return docs.select(*KEY, "text").join(per_doc, KEY).select(*KEY, "text", "hashes", "hot").mapInArrow(send, _SENT)


class Tile:
    """A tile's bytes and, for each place, how far its region goes on."""

    def __init__(self, body: bytes, ends: bytes):
        self.data = np.frombuffer(body, np.uint8)
        self.ends = np.frombuffer(ends, np.int64)
        starts = np.r_[0, self.ends[:-1] + -self.ends[:-1] % 3] if len(self.ends) else self.ends
        self.starts = starts
        size = np.diff(np.r_[starts, len(self.data)])
        self.left = np.repeat(self.ends, size) - np.arange(len(self.data))

    def sampled(self, depth: int) -> np.ndarray:
        at = np.arange(len(self.data))
        return np.flatnonzero((at % 3 != 0) & (self.left >= depth))

    def words(self, at: np.ndarray) -> np.ndarray:
        """The eight bytes from each place as a number."""
        padded = np.r_[self.data, np.zeros(8, np.uint8)].astype(np.uint64)
        out = np.zeros(len(at), dtype=np.uint64)
        for j in range(8):
            out = out << np.uint64(8) | padded[at + j]
        return out

    def spread(self, depth: int, names: np.ndarray) -> np.ndarray:
        """Names of the places sampled at ``depth`` as an array over all places."""
        out = np.zeros(len(self.data) + 64, dtype=np.uint64)
        out[self.sampled(depth)] = names
        return out


def _dense(values: np.ndarray) -> np.ndarray:
    """The rank of each value among the distinct ones, from 0."""
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    out = np.empty(len(values), dtype=np.uint64)
    out[order] = np.cumsum(np.r_[False, ranked[1:] != ranked[:-1]][: len(values)])
    return out


def _ranks(*parts: np.ndarray) -> np.ndarray:
    """The rank, from 0, of each row of numbers, compared part by part."""
    key, *rest = parts
    for part in rest if len(key) else ():
        bits = int(part.max()).bit_length()
        if int(key.max()).bit_length() + bits > 64:
            key = _dense(key)
        key = key << np.uint64(bits) | part
    return _dense(key)


_FORMS = ((1, 2, 0), (0, 1, 1), (0, 2, 2))  # residues that can build it, bytes before the rank


def _form_keys(tile: Tile, known: np.ndarray, later: np.ndarray, form: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, a, b) of a form: those of its residues that start a window and are not known as repeats."""
    one, two, before = _FORMS[form]
    at = np.arange(len(tile.data))
    residue = at % 3
    at = at[((residue == one) | (residue == two)) & (tile.left >= length) & ~later]
    around = [*range(before), *range(_DEPTH + before, length)]
    b = np.zeros(len(at), dtype=np.uint64)
    for j in around[: length - _DEPTH]:
        b = b << np.uint64(8) | tile.data[at + j].astype(np.uint64)
    return at, known[at + before], b


def later_places(tile: Tile, length: int = LENGTH) -> np.ndarray:
    """Which places of a tile start a window that an earlier place starts too."""
    at = tile.sampled(FIRST)
    known, depth = tile.spread(FIRST, _ranks(tile.words(at))), FIRST
    for steps in STEPS:
        depth += steps[-1]
        at = tile.sampled(depth)
        known = tile.spread(depth, _ranks(known[at], *(known[at + s] for s in steps)))
    later = np.zeros(len(tile.data), bool)
    for form in range(len(_FORMS)):
        at, a, b = _form_keys(tile, known, later, form, length)
        rank = _ranks(a, b)
        order = np.argsort(rank, kind="stable")  # the first place of a string comes first
        again = np.r_[False, rank[order][1:] == rank[order][:-1]][: len(at)]
        later[at[order[again]]] = True
    return later


def _found(sent: DataFrame, length: int) -> DataFrame:
    """(k_id, k_text, start, stop): the repeats of each share."""

    def run(key, frame):
        rows = frame.to_pylist()
        k_id, k_text = _unpacked(rows, "docs")
        start, size = (_joined(rows, c, np.uint32).astype(np.int64) for c in ("starts", "sizes"))
        bodies: list[bytes | None] = []
        for r in rows:
            sizes = np.frombuffer(r["sizes"], np.uint32).astype(np.int64)
            ends = np.cumsum(sizes)
            sizes = sizes[: np.searchsorted(ends, len(r["body"]), side="right")]
            bodies += [r["body"][e - n : e] for e, n in zip(ends.tolist(), sizes.tolist())]
            bodies += [None] * (len(r["sizes"]) // 4 - len(sizes))
        del rows
        whole = np.zeros(len(bodies), bool)
        known: set[bytes] = set()
        first = []
        for p in np.lexsort((start, k_text, k_id)).tolist():
            body = bodies[p]
            if body is None or body in known:
                whole[p] = True
            else:
                known.add(body)
                first.append(p)
        padded = [bodies[p] + bytes(-len(bodies[p]) % 3) for p in first]
        first = np.array(first, dtype=np.int64)
        ends = np.cumsum([len(b) for b in padded]) - [-size[p] % 3 for p in first.tolist()]
        tile = Tile(b"".join(padded), ends.astype(np.int64).tobytes())
        edge = np.flatnonzero(np.diff(np.r_[False, later_places(tile, length), False].astype(np.int8)))
        begin, end = edge[::2], edge[1::2]
        own = np.searchsorted(tile.starts, begin, side="right") - 1
        begin, end = (x - tile.starts[own] + start[first[own]] for x in (begin, end))
        place = np.r_[np.flatnonzero(whole), first[own]]
        columns = [k_id[place], k_text[place], np.r_[start[whole], begin], np.r_[(start + size)[whole], end + length - 1]]
        return pa.Table.from_arrays([pa.array(c) for c in columns], names=[*KEY, "start", "stop"])

    return sent.groupBy("share").applyInArrow(run, "k_id long, k_text long, start long, stop long")


def repeats(docs: DataFrame, length: int = LENGTH, total: int | None = None) -> DataFrame:
    """(k_id, k_text, start, stop): runs of bytes to remove, those of a document apart, touching or overlapping.

    Null is an empty text. Texts shorter than ``length`` have no run. Whole copies are not
    listed; see ``removals``. Documents are ordered by (doc_id, hash of the text). ``total`` is
    the number of bytes, if known; it only decides how many shares there are.
    """
    if length != LENGTH:
        raise ValueError("ranks are built for strings of 100 bytes")
    if total is None:
        total = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    shared = durable(_anchors(docs, length, max((total or 0) // SHARE, 1)))
    every, hot = (x or 0 for x in shared.agg(F.sum(F.octet_length("hashes") / 8), F.sum(F.octet_length("hot") / 8)).first())
    # a piece has about half the windows that its anchor can reach
    windows = (length - GRAM) // 2
    count = max(int((every - hot) * (length + windows) + hot * length * windows) // SHARE, 1)
    return _found(_pieces(docs, shared, length, count), length)


def removals(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a
    smaller doc_id, or earlier in the same document. Repeated rows of a document count as
    that document once and get the same answer; a null doc_id counts as 0. A null or empty
    text has no bytes and the digest of nothing. Other columns are not read.
    """
    texts = _texts(docs)
    digest = F.sha2("text", 256)
    whole = durable(texts.select(*KEY, F.octet_length("text").alias("size"), digest.alias("sha")))
    first = whole.groupBy("sha").agg(F.min(F.struct(*KEY)).alias("first"), F.count("*").alias("n")).filter("n > 1")
    copies = whole.join(first, "sha").filter(F.struct(*KEY) != F.col("first")).select(*KEY).distinct()
    copies = durable(copies)
    spans = repeats(texts.join(copies, KEY, "left_anti").dropDuplicates(KEY) if _repeated(whole) else texts.join(copies, KEY, "left_anti"), length, whole.agg(F.sum("size")).first()[0])
    spans = spans.groupBy(*KEY).agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    marked = durable(spans).unionByName(copies.select(*KEY, F.lit(None).cast("array<struct<start:bigint,stop:bigint>>").alias("spans")).withColumn("spans", F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(-1).cast("long").alias("stop")))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                text = text.as_py()
                merged: list[list[int]] = []
                for s in spans or []:
                    start, stop = s["start"], s["stop"]
                    if stop < 0:  # a whole copy
                        stop = len(text) if len(text) >= length else 0
                    if stop <= start:
                        continue
                    if merged and start <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], stop)
                    else:
                        merged.append([start, stop])
                kept, at = hashlib.sha256(), 0
                for start, stop in merged:
                    kept.update(text[at:start])
                    at = stop
                kept.update(text[at:])
                rows.append((doc_id, len(text), sum(b - a for a, b in merged), len(merged), kept.hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 5, kinds)], names=names)

    joined = texts.join(marked, KEY, "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _repeated(whole: DataFrame) -> bool:
    """Whether any document stands in several rows."""
    return bool(whole.groupBy(*KEY).count().filter("count > 1").limit(1).count())


def query(spark, sf_dir):
    return removals(table(spark, sf_dir, "documents"))
