"""Small corpora with every awkward case, and plain versions of the operators to compare with."""

import hashlib
import random
import re
import zlib
from collections import Counter

import xxhash

from larkspur.llm import paragraphs

DOCS = "doc_id long, text string, lang string, source string, n_chars long, k_id string, own string, fp string, hash string, spans string"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    made = ["".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(2, 9))) for _ in range(words)]
    return " ".join(w + ("." if rng.random() < 0.1 else "") for w in made)


def documents() -> list[tuple]:
    """Nulls, empties, copies, near copies, repeated rows, a very long text, shared passages, odd characters."""
    passage, item = prose(1, 60), prose(2, 30)
    long_text = prose(3, 12_000)
    near = prose(4, 400).split(" ")
    texts = [
        (1, prose(10, 80)),
        (2, None),
        (3, ""),
        (4, " \t\n "),
        (5, prose(11, 50) + "\n" + passage + "\n" + prose(12, 50)),
        (6, prose(13, 40) + "\n" + passage),
        (7, prose(10, 80)),
        (8, " ".join(near)),
        (9, " ".join([*near[:200], "changed", *near[201:]])),
        (10, long_text),
        (11, long_text[:5000] + prose(14, 30)),
        (12, prose(15, 20) + " " + item + " " + prose(16, 20)),
        (13, item.upper() + " Éa"),
        (14, "aa bb cc"),
        (15, "x AA, bb. cc y"),
        (16, prose(17, 300) + " aa bb cc"),
        (17, "b" * 350),
        (18, "Mail joe.22@mail7.example.com or 70.123.182.155, card 4041894974608795."),
        (19, "mail joe.22@mail7.example.com \x01 twice 4041-8949-7460-8795 and 2001-02-28"),
        (20, "日本語 テキスト ÀÉ ß <|endoftext|> don't"),
        (None, prose(18, 30)),
        (None, None),
        (21, prose(19, 60)),
        (21, prose(19, 60)),
    ]
    return [(i, t, "en" if n % 3 else None, f"src{n % 4}" if n % 5 else None, len(t) if t is not None else None, "k", "o", "f", "h", "s") for n, (i, t) in enumerate(texts)]


def benchmark() -> list[tuple]:
    item = prose(2, 30)
    return [(0, item), (1, item), (2, prose(90, 40)), (10, "AA bb, cc!"), (3, None), (4, ""), (5, " ".join(item.split(" ")[5:25])), (10, "AA bb, cc!"), (6, prose(17, 300)[:200])]


def ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def contamination(docs, items, span=13):
    """{(doc_id, text): (n_words, n_hit, n_items, sha, contaminated)}"""
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows: dict[tuple, set] = {}
    for item_id, text in items:
        w = pattern.findall(ascii_lower(text or ""))
        for i in range(max(len(w) - span + 1, 1) if w else 0):
            windows.setdefault(tuple(w[i : i + span]), set()).add(item_id)
    out = {}
    for doc_id, text in docs:
        w = pattern.findall(ascii_lower(text or ""))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                own = windows.get(tuple(w[i : i + n]))
                if own:
                    hit |= set(range(i, i + n))
                    found |= own
        sha = hashlib.sha256(",".join(sorted(str(x) for x in found)).encode()).hexdigest()
        out[doc_id, text] = (len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w))
    return out


def simhash(text, shingle=4) -> int:
    w = re.findall("[^\x20\x09-\x0d]+", ascii_lower(text or ""))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + shingle]).encode(), 42) for i in range(max(len(w) - shingle + 1, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_classes(docs, radius=4):
    fps = {simhash(t) for _, t in docs}
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    least = {}
    for i, t in docs:
        key = find(simhash(t))
        known = least.get(key)
        least[key] = i if known is None else known if i is None else min(known, i)
    return Counter((i, f"{simhash(t):016x}", least[find(simhash(t))]) for i, t in docs)


def removed_bytes(docs, length=100):
    """{(doc_id, text): (n_bytes, n_removed, n_spans, sha)} of distinct documents in the operator's order."""
    seen, out = set(), {}
    for doc_id, text in docs:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if w in seen:
                gone[p : p + length] = b"\x01" * length
            seen.add(w)
        spans = sum(1 for j in range(len(b)) if gone[j] and not (j and gone[j - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out[doc_id, text] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def stretches(words, window):
    """Stretches of a word list, place by place: a run of four words begins one if its hash is below all before it in the window and above none after."""
    h = [int(x) for x in paragraphs.gram_hashes(words, paragraphs._WordHashes())] if words else []
    ends = [p for p in range(1, len(h)) if all(h[p] < x for x in h[max(p - window, 0) : p]) and all(h[p] <= x for x in h[p + 1 : p + 1 + window])]
    return [words[a:b] for a, b in zip([0, *ends], [*ends, len(words)]) if words]


def paragraph_classes(docs, shingle=5, least=0.8, window=12, min_words=12):
    nodes: dict[bytes, list] = {}
    for i, text in docs:
        whole = ascii_lower(text or "").encode().split()
        for n, w in enumerate(stretches(whole, window)):
            if len(w) >= min_words or len(w) == len(whole):
                nodes.setdefault(b" ".join(w), []).append((i, n))
    keys = list(nodes)
    sets = [{tuple(k.split(b" ")[j : j + shingle]) for j in range(max(len(k.split(b" ")) - shingle + 1, 1))} for k in keys]
    root = list(range(len(keys)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(keys)):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if both / (len(sets[x]) + len(sets[y]) - both) >= least:
                root[find(x)] = find(y)
    groups: dict[int, list] = {}
    for x, k in enumerate(keys):
        groups.setdefault(find(x), []).extend(nodes[k])
    order = lambda p: (p[0] is not None, p[0] or 0, p[1])
    return Counter((*m, *min(g, key=order), len(g), m != min(g, key=order)) for g in groups.values() if len(g) > 1 for m in g)


def crc(ids) -> int:
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
