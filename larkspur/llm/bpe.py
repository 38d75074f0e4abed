"""Byte-level BPE with reuse of content-defined chunks, and its decoder.

A rolling hash cuts every text where its last bytes say so, so a passage that documents share
falls into the same chunks in all of them but at its ends. A chunk found more than once is
encoded once, by one owner, and its ids go to every text that holds it; the rest of a text is
encoded in place. Encoded parts do not simply follow each other: what stands next to a cut
may be split otherwise in the whole text. Each join is encoded again from the last place that
no later text can change until a piece begins where one begins in the part that follows; from
there on both agree, because pieces depend only on what stands after their beginning.

Texts cross the network once, with copies already taken out; after that only short chunk
fingerprints and the ids of shared chunks do.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import table

VOCABULARY = "byte_bpe_50k.json"
#: bytes the rolling hash looks at, mean and least bytes of a chunk
ROLL, MEAN_CHUNK, LEAST_CHUNK = 32, 1024, 256

_START = np.uint32(1 << 31)
_ID = np.uint32((1 << 31) - 1)
_SLICE = 1 << 20
_PIECES_KEPT, _PIECE_CHARS = 300_000, 48
#: first stretch after a join that is encoded again
_STRETCH = 64

# fixed values: what the vocabulary's own piece pattern matches among ASCII and the accented letters of
# U+00C0 to U+017F; texts with other characters go through the library's pattern
_LETTERS = "A-Za-zÀ-ÖØ-öø-ſ"
_BLANKS = " \t-\r"
_PATTERN = r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PLAIN = re.compile(f"[\x00-\x7f{_LETTERS}]*").fullmatch
_PIECES = re.compile(
    f"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[0-9]+| ?[^{_BLANKS}{_LETTERS}0-9]+|[{_BLANKS}]+(?![^{_BLANKS}])|[{_BLANKS}]+"
).findall


def _byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if visible."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class Pieces(dict):
    """Packed ids of a piece by its text, or by its bytes in mapped characters; the first id carries a mark."""

    def __init__(self, ids_of):
        super().__init__()
        self.ids_of = ids_of

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.ids_of(piece), dtype="<u4")
        ids[0] |= _START
        packed = ids.tobytes()
        if len(piece) <= _PIECE_CHARS:
            if len(self) >= _PIECES_KEPT:
                self.clear()
            self[piece] = packed
        return packed


class Codec:
    """Encodes texts to marked ids and knows the bytes of every id.

    The library's own merges are slow over many different pieces. Where every id is the number of
    its merge, which is checked, ids are ranks and tiktoken merges plain pieces by them; all that is
    not plain goes through the library.
    """

    def __init__(self, vocabulary: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(public_tokenizers.path(vocabulary), encoding="utf-8") as file:
            spec = json.load(file)
        added = spec["added_tokens"]
        if spec["normalizer"] or spec["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
            raise ValueError(f"{vocabulary} is no byte-level vocabulary with the usual pieces")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError(f"{vocabulary} has added tokens that match by their surroundings")
        byte_of = {c: b for b, c in enumerate(_byte_characters())}
        vocab = spec["model"]["vocab"]
        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if all(c in byte_of for c in t)}
        merged = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        if len(ranks) != len(vocab) or any(vocab["".join(m)] != 256 + i for i, m in enumerate(merged)):
            raise ValueError(f"{vocabulary} does not number its merges in order")
        tokenizer = Tokenizer.from_str(json.dumps(spec))
        merge = tokenizer.model.tokenize
        self.split = tokenizer.pre_tokenizer.pre_tokenize_str
        names = {t["content"]: t["id"] for t in added}
        self.fast = tiktoken.Encoding(vocabulary, pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=names)
        self.pieces, self.mapped = Pieces(self.fast.encode_ordinary), Pieces(lambda m: [t.id for t in merge(m)])
        self.special = {n: np.array([i | int(_START)], dtype="<u4").tobytes() for n, i in names.items()}
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(names, key=len, reverse=True))) + ")") if names else None
        #: bytes after the end of a piece that can still change it
        self.margin = max((len(n.encode()) for n in names), default=0) + 8
        tokens = {i: b for b, i in ranks.items()} | {i: n.encode() for n, i in names.items()}
        self.sizes = np.array([len(tokens.get(i, b"")) for i in range(max(tokens) + 1)], dtype=np.int64)

    def encode(self, text: bytes, marked: bool = True) -> np.ndarray:
        """Ids of a text that is encoded for itself, if asked with a mark on the first of each piece."""
        whole = text.decode()
        parts = self.specials.split(whole) if self.specials else [whole]
        packed = []
        for n, part in enumerate(parts):
            if n % 2:
                packed.append(self.special[part])
            elif _PLAIN(part):
                if marked:
                    packed += map(self.pieces.__getitem__, _PIECES(part))
                else:
                    packed.append(np.array(self.fast.encode_ordinary(part), dtype="<u4").tobytes())
            else:
                packed += [self.mapped[mapped] for mapped, _ in self.split(part)]
        ids = np.frombuffer(b"".join(packed), dtype="<u4")
        return ids if marked else ids & _ID

    def borders(self, ids: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray]:
        """(places in the text, places in ids) of all beginnings of pieces, and the end."""
        where = np.r_[np.flatnonzero(ids & _START), len(ids)]
        ends = np.r_[0, np.cumsum(self.sizes[ids & _ID])]
        return at + ends[where], where

    def join(self, text: bytes, parts: list[tuple[int, int, np.ndarray]]) -> np.ndarray:
        """Ids of the whole text from those of its parts (begin, end, ids), which follow each other."""
        out, done = [], 0  # what is out covers text[:done], and nothing later can change it
        for begin, end, ids in parts:
            if end <= done and end < len(text):
                continue
            places, index = self.borders(ids, begin)
            if end < len(text):
                kept = int(np.searchsorted(places, end - self.margin, side="right"))
                places, index = places[:kept], index[:kept]
            if done < begin or (done > begin and not np.isin(done, places)):
                window, done = self._repair(text, done, begin, end, places)
                out.append(window)
            at = np.searchsorted(places, done)
            if at < len(places) and places[at] == done:
                out.append(ids[index[at] : index[-1]])
                done = int(places[-1])
        return np.concatenate(out) & _ID if out else np.zeros(0, np.uint32)

    def _repair(self, text: bytes, done: int, begin: int, end: int, places: np.ndarray) -> tuple[np.ndarray, int]:
        """Ids from ``done`` up to the first border of the part, or past the part if none agrees."""
        stretch = _STRETCH
        while True:
            stop = min(max(begin, done) + stretch, len(text))
            while stop < len(text) and text[stop] & 0xC0 == 0x80:
                stop += 1
            ids = self.encode(text[done:stop])
            borders, index = self.borders(ids, done)
            if stop < len(text):
                kept = int(np.searchsorted(borders, stop - self.margin, side="right"))
                borders, index = borders[:kept], index[:kept]
            agreed = np.flatnonzero((borders >= begin) & (borders > done) & np.isin(borders, places))
            if len(agreed):
                return ids[: index[agreed[0]]], int(borders[agreed[0]])
            if stop >= end and len(borders) and (borders[-1] > done or stop == len(text)):
                return ids[: index[-1]], int(borders[-1])
            stretch *= 2

    def decode(self, ids: np.ndarray) -> str:
        return self.fast.decode_bytes(ids.tolist()).decode("utf-8", "replace")


def _codec(vocabulary: str) -> Codec:
    """The codec of a worker process, made once for all its tasks; modules sent with a task do not outlive it."""
    kept = vars(sys).setdefault("_larkspur_codecs", {})
    if vocabulary not in kept:
        kept[vocabulary] = Codec(vocabulary)
    return kept[vocabulary]


_MIXED = np.frombuffer(b"".join(hashlib.sha256(bytes([b])).digest()[:4] for b in range(256)), "<u4").astype(np.uint32)


def _rolled(data: np.ndarray) -> np.ndarray:
    """Hash of the ROLL bytes from each place on, by doubling."""
    h, width, factor = _MIXED[data], 1, np.uint32(0x9E3779B1)
    while width < ROLL:
        h = h[:-width] * factor + h[width:]
        width, factor = width * 2, factor * factor
    return h


def cuts(text: bytes) -> list[int]:
    """Ends of the chunks of a text: where the bytes before a place hash to a value, at least LEAST_CHUNK apart."""
    data = np.frombuffer(text, np.uint8)
    last, ends = 0, []
    with np.errstate(over="ignore"):
        for low in range(0, max(len(data) - ROLL, 0) + 1, _SLICE):
            part = data[low : low + _SLICE + ROLL - 1]
            if len(part) < ROLL:
                break
            for place in (np.flatnonzero(_rolled(part) < (1 << 32) // MEAN_CHUNK) + (low + ROLL)).tolist():
                # not before the rest of a character
                if place - last >= LEAST_CHUNK and place < len(data) and data[place] & 0xC0 != 0x80:
                    ends.append(place)
                    last = place
    return [*ends, len(data)] if len(data) else []


def _text() -> Column:
    """Null is empty; bytes that are no UTF-8 become the replacement character."""
    return F.make_valid_utf8(F.coalesce("text", F.lit("")))


def _key(text: Column) -> Column:
    # never null, so that no join on it filters the texts, which would keep their shuffle from being reused
    return F.coalesce(F.substring(F.unhex(F.sha2(text, 256)), 1, 16), F.lit(b"")).alias("k")


def texts_of(docs: DataFrame) -> DataFrame:
    """(k, text as bytes), each text once; copies are taken out before they are shuffled."""
    rows = docs.select(_text().alias("text"))
    return rows.select(_key(F.col("text")), F.col("text").cast("binary").alias("text")).groupBy("k").agg(F.any_value("text").alias("text"))


def _chunks(texts: DataFrame) -> DataFrame:
    """(k, begin, end, h) of every chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, begins, ends, prints = [], [], [], []
            for n, cell in enumerate(batch.column(1)):
                text, begin = cell.as_py(), 0
                for end in cuts(text):
                    which.append(n)
                    begins.append(begin)
                    ends.append(end)
                    prints.append(hashlib.blake2b(text[begin:end], digest_size=16).digest())
                    begin = end
            columns = [batch.column(0).take(pa.array(which, pa.int64())), pa.array(begins, pa.int64()), pa.array(ends, pa.int64()), pa.array(prints, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["k", "begin", "end", "h"])

    return texts.mapInArrow(run, "k binary, begin long, end long, h binary")


def _encode_owned(owned: DataFrame, vocabulary: str) -> DataFrame:
    """(h, ids): the chunks a text owns, encoded for themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary)
        for batch in batches:
            prints, ids = [], []
            for cell, chunks in zip(batch.column(0), batch.column(1)):
                text = cell.as_py()
                for c in chunks.as_py():
                    prints.append(c["h"])
                    ids.append(codec.encode(text[c["begin"] : c["end"]]).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(prints, pa.binary()), pa.array(ids, pa.binary())], names=["h", "ids"])

    return owned.select("text", "own").mapInArrow(run, "h binary, ids binary")


def _assemble(texts: DataFrame, vocabulary: str) -> DataFrame:
    """(k, ids) from (k, text, given): shared chunks as they came, the rest encoded here, all joins repaired."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                ids = [_whole(codec, t.as_py(), g.as_py()).astype("<u4").tobytes() for t, g in zip(some.column(1), some.column(2))]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(ids, pa.binary())], names=["k", "ids"])

    return texts.select("k", "text", "given").mapInArrow(run, "k binary, ids binary")


def _whole(codec: Codec, text: bytes, given: list[dict] | None) -> np.ndarray:
    if not given:
        return codec.encode(text, marked=False)
    parts, at = [], 0
    for g in sorted(given, key=lambda g: g["begin"]):
        if g["begin"] > at:
            parts.append((at, g["begin"], codec.encode(text[at : g["begin"]])))
        parts.append((g["begin"], g["end"], np.frombuffer(g["ids"], "<u4")))
        at = g["end"]
    if at < len(text):
        parts.append((at, len(text), codec.encode(text[at:])))
    return codec.join(text, parts)


def encode_texts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(k, ids) of each different text: ids as little-endian unsigned 32-bit integers.

    The distinct texts stand three times in this plan, over one shuffle that is reused.
    """
    texts = texts_of(docs)
    chunks = _chunks(texts)
    least = F.min(F.struct("k", "begin", "end")).alias("at")
    shared = chunks.groupBy("h").agg(F.count("*").alias("n"), least).filter("n > 1")
    owners = shared.groupBy(F.col("at.k").alias("k")).agg(F.collect_list(F.struct("at.begin", "at.end", "h")).alias("own"))
    once = _encode_owned(texts.join(owners, "k"), vocabulary)
    given = chunks.join(once, "h").groupBy("k").agg(F.collect_list(F.struct("begin", "end", "ids")).alias("given"))
    return _assemble(texts.join(given, "k", "left"), vocabulary)


def encode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(own, ids): each row of ``docs`` whole as the struct ``own``, so that no name can clash, and its ids.

    The ids are those of the tokenizers library without special tokens added, truncation or padding;
    the string of an added token within a text is that token. A null text is an empty one and has no
    ids. Rows come out as often as they come in, null doc_ids too; an empty table gives no rows. Very
    long texts are cut and encoded like others, in the memory of one task. Bytes that are no UTF-8
    count as replacement characters. Of the columns only text is looked at.
    """
    return docs.select(F.struct("*").alias("own"), _key(_text())).join(encode_texts(docs, vocabulary), "k").drop("k")


def decode(rows: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The first column of ``rows`` and, as ``decoded``, the text of the ids in its second, special tokens kept."""
    name, kind = rows.schema[0].name, rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                decoded = [codec.decode(np.frombuffer(c.as_py(), "<u4")) for c in some.column(1)]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(decoded, pa.string())], names=[name, "ids", "decoded"])

    return rows.mapInArrow(run, f"`{name}` {kind}, ids binary, decoded string")


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    back = decode(encode_texts(docs))
    digests = back.select(
        "k",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key(_text())).join(digests, "k").drop("k")
