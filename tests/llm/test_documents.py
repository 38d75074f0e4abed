"""Operators over documents against plain versions, on a corpus of awkward cases and on empty tables."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from larkspur.llm import decontaminate, linear, packing, paragraphs, pseudonyms, quality, simhash, suffixes, toxicity
from larkspur.llm.components import components
from tests.llm import corpus as C

PAIRS = [(r[0], r[1]) for r in C.documents()]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(C.documents(), C.DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], C.DOCS)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(C.benchmark(), "item_id long, text string")


def plain(name):
    return [tuple(r) for r in name.collect()]


def test_decontaminate(docs, items):
    got = Counter(plain(decontaminate.decontaminate(docs, items).drop("k_id", "k_text")))
    want = C.contamination(PAIRS, C.benchmark())
    assert got == Counter((i, *want[i, t]) for i, t in PAIRS)
    assert sum(x[-1] for x in got) >= 4


def test_decontaminate_empty(spark, docs, none, items):
    assert plain(decontaminate.decontaminate(none, items)) == []
    clean = decontaminate.decontaminate(docs, items.limit(0)).collect()
    assert len(clean) == len(PAIRS) and not any(r["contaminated"] or r["n_hit"] for r in clean)


def test_winnowing_guarantee():
    """Any shared run of 13 words leaves a common fingerprint, also among repeated words."""
    import random

    rng = random.Random(5)
    values = [[rng.choice("abc") for _ in range(60)] for _ in range(20)]
    for w in values:
        other = [rng.choice("xyz") for _ in range(9)] + w[20:33] + ["q"]
        grams = lambda s: [hash(tuple(s[i : i + 8])) for i in range(len(s) - 7)]
        picked = lambda s: {min(grams(s)[i : i + 6]) for i in range(len(grams(s)) - 5)}
        assert picked(w) & picked(other)


def test_simhash(docs, none):
    rows = simhash.classes(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id")
    assert Counter(plain(rows)) == C.simhash_classes(PAIRS)
    assert plain(simhash.classes(none)) == []


@pytest.mark.parametrize("cell_pairs", [1 << 40, 0])
def test_simhash_links_light_and_blocked(spark, monkeypatch, cell_pairs):
    """A crowd within a small ball, scattered others: both ways give the brute-force components."""
    rng = np.random.default_rng(3)
    centre = int(rng.integers(0, 1 << 62))
    values = {centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)) for _ in range(150)}
    values |= {int(v) for v in rng.integers(0, 1 << 62, 60)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    monkeypatch.setattr(simhash, "CELL_PAIRS", cell_pairs)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    root = {r["node"]: r["root"] for r in components(simhash.links(fps)).collect()}
    near = np.bitwise_count(np.array(signed).view(np.uint64)[:, None] ^ np.array(signed).view(np.uint64)[None, :]) <= 4
    label = np.array(signed)
    while True:
        moved = np.where(near, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        if (moved == label).all():
            break
        label = moved
    assert [root.get(v, v) for v in signed] == label.tolist()


def test_components_of_a_chain(spark):
    edges = spark.range(60).select((F.col("id") * 7 % 61).alias("a"), ((F.col("id") + 1) * 7 % 61).alias("b"))
    assert {r["root"] for r in components(edges).collect()} == {0}
    assert plain(components(edges.limit(0))) == []


def test_paragraphs(docs, none):
    assert Counter(plain(paragraphs.classes(docs))) == C.paragraph_classes(PAIRS)
    assert plain(paragraphs.classes(none)) == []


def test_short_texts(spark):
    """Short texts that repeat are classes; so are the few that differ and have the same shingles."""
    lines = ["ok", "See the licence", "a b c d e", "one two three four five six seven", "Permission is granted to all who read this", *["ha " * n for n in (4, 5, 6, 7, 9)]]
    lines += ["x y x y x y", "y x y x y x", "p q r p q r p", "q r p q r p q", "r p q r p q r", "c1 c2 c3 c4 c5 c6 c7 c8", "c1 c2 c3 c4 c5 c6 c7 c8 c9"]
    lines += ["OK", "see\n the LICENCE", "a b c d e f", "A b c d e", "permission is granted to all who read this", lines[3], None, "same " * 500, "same " * 480]
    rows = list(enumerate(lines))
    got = Counter(plain(paragraphs.classes(spark.createDataFrame(rows, "doc_id long, text string"))))
    want = C.paragraph_classes(rows)
    assert got == want and sum(x[-1] for x in want) >= 8


def test_passages_are_found_wherever_they_begin(spark):
    """Documents that share a run of more than 50 words are named, those that hold no run of 12 that stands twice are not."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    words = {i: tuple((t or "").lower().split()) for i, t in rows}

    def sharing(n, kind=set):
        runs = {i: kind(w[j : j + n] for j in range(len(w) - n + 1)) for i, w in words.items()}
        count = Counter(r for own in runs.values() for r in own)
        return {i for i, own in runs.items() if any(count[r] > 1 for r in own)}

    named = {r["doc_id"] for r in paragraphs.classes(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id").distinct().collect()}
    long, any_run = sharing(51), sharing(12, list)
    tiny = {i for i, w in words.items() if len(w) < 12}
    assert len(named & long) >= 0.9 * len(long) and len(named - any_run - tiny) <= 0.02 * len(words)


def test_short_repeats(spark):
    rows = [(1, "See the  licence\nother\n" + "w " * 12), (2, "SEE the licence\n\n" + "w " * 12), (3, None), (4, "see The licence")]
    got = {tuple(r) for r in paragraphs.short_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {("see the licence", 3, 3)}


def test_lines_that_stand_alone():
    """What gets no band keys is like no other text, by brute force over all short texts of two and three words."""
    import itertools

    for letters, longest in (("ab", 10), ("abc", 8)):
        texts = [" ".join(w).encode() for n in range(1, longest) for w in itertools.product(letters, repeat=n)]
        sets = defaultdict(set)
        for t in texts:
            sets[frozenset(paragraphs.shingles(t))].add(t)
        for t in texts:
            if paragraphs._alone(t, 5, 0.8):
                assert sets[frozenset(paragraphs.shingles(t))] == {t}
        near = [t for t in texts[::37] if paragraphs._alone(t, 5, 0.8)]
        assert near and not any(paragraphs.similarity(t, u) >= 0.8 for t in near for u in texts if u != t)


@pytest.mark.parametrize("block", [256, 4])
def test_paragraph_crowd(spark, monkeypatch, block):
    """Near copies that are alike only through others stay one class; whole texts are the paragraphs here."""
    monkeypatch.setattr(paragraphs, "CROWD_BLOCK", block)
    monkeypatch.setattr(paragraphs, "stretches", lambda words, hashes, window: [len(words)] if words else [])
    monkeypatch.setattr(C, "stretches", lambda words, window: [words] if words else [])
    base = C.prose(30, 100).split(" ")
    rows = [(i, " ".join(base[2 * i : 2 * i + 44])) for i in range(25)] + [(99, C.prose(31, 60))]
    got = Counter(plain(paragraphs.classes(spark.createDataFrame(rows, "doc_id long, text string"))))
    assert got == C.paragraph_classes(rows) and len(got) == 25


@pytest.mark.parametrize("tile", [1 << 20, 4000])
def test_repeated_bytes(spark, docs, none, monkeypatch, tile):
    monkeypatch.setattr(suffixes, "TILE", tile)
    monkeypatch.setattr(suffixes, "SHARE", tile)
    got = defaultdict(set)
    for r in suffixes.removals(docs).collect():
        got[r["doc_id"]].add(tuple(r)[1:])
    known = [(i, t) for i, t in PAIRS if i is not None]
    first = [(None, t) for i, t in PAIRS if i is None]  # a null doc_id counts as 0
    want = C.removed_bytes(list(dict.fromkeys(first + known)))
    assert {k: v for k, v in got.items()} == {i: {want[j, t] for j, t in want if j == i} for i, _ in want}
    assert sum(x[1] for s in got.values() for x in s) > 5000
    assert plain(suffixes.removals(none)) == []


@pytest.mark.parametrize("share, hot", [(1 << 22, 1 << 15), (3000, 2)])
def test_repeated_bytes_near_each_other(spark, monkeypatch, share, hot):
    """Short periods, repeats inside one run of windows, a frequent line between different words, copies of pieces."""
    monkeypatch.setattr(suffixes, "SHARE", share)
    monkeypatch.setattr(suffixes, "HOT", hot, raising=False)
    monkeypatch.setattr(suffixes, "TILE", share)
    monkeypatch.setattr(suffixes, "BLOCK", 7, raising=False)
    line, other = C.prose(40, 14)[:70], C.prose(41, 60)
    texts = [C.prose(42, 30)[:20] * 7, C.prose(43, 30)[:49] * 3, "ab" * 75, C.prose(44, 30)[:99] * 2, other + C.prose(45, 9) + other]
    texts += [C.prose(50 + n, 12) + line + C.prose(50 + n % 4, 12) for n in range(12)] + ["x" + other[3:], None, "", "x" * 99, "x" * 100, "x" * 101]
    rows = [(n, t) for n, t in enumerate(texts)]
    got = {r["doc_id"]: tuple(r)[1:] for r in suffixes.removals(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    want = C.removed_bytes(rows)
    assert got == {i: want[i, t] for i, t in rows} and sum(x[1] for x in got.values()) > 1500


def test_repeated_bytes_travel_once(spark, monkeypatch):
    """What the groups get to count and rank is not many times the text itself."""
    from pyspark.sql import GroupedData

    sent, apply = [], GroupedData.applyInArrow

    def counted(self, func, schema):
        size = sum(F.octet_length(c) if kind == "binary" else F.lit(8) for c, kind in self._df.dtypes)
        sent.append(self._df.agg(F.sum(size)).first()[0])
        return apply(self, func, schema)

    monkeypatch.setattr(GroupedData, "applyInArrow", counted)
    passages = [C.prose(60 + n, 200) for n in range(8)]
    rows = [(n, " ".join([C.prose(100 + n, 300), passages[n % 8], C.prose(300 + n, 200), passages[n % 7]])) for n in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert suffixes.removals(docs).agg(F.sum("n_removed")).first()[0] > 200_000
    assert 0 < sum(sent) < 1.5 * sum(len(t) for _, t in rows)


def test_packing(docs, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    ids = [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in PAIRS]
    rows = packing.pack(docs, capacity=500).collect()
    want = Counter((i, p, p * 500, len(own[p * 500 : (p + 1) * 500]), C.crc(own[p * 500 : (p + 1) * 500])) for i, own in ids for p in range(-(-len(own) // 500)))
    assert Counter(tuple(r)[:5] for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 500
    assert len(by) <= -(-sum(len(x) for _, x in ids) // 500) + 1
    assert plain(packing.pack(none)) == []


def test_chunk_ids_equal_the_tokenizer():
    chunks = packing._open(packing.VOCABULARY)
    texts = ["Thing, thing. THING don't I'll a'b", "Éaß ÀÈÿ ×÷ªº naïve,", "x<|endoftext|>y 12,5 ... ,", "İ ΑΣ ẖ 日本 🙂🙂", "a\x0bb\x1cc\x85d　e", "word,. .word ..", ""]
    for text in texts:
        own = np.frombuffer(b"".join(map(chunks.__getitem__, text.encode().split())), "<u4").tolist()
        assert own == chunks.tokenizer.encode(text, add_special_tokens=False).ids


def test_plan_uses_every_piece_and_fills():
    counts = {1: 7, 3: 1000, 450: 13, 700: 40, 999: 11, 1000: 5}
    steps = packing.plan(counts, 1000)
    used = Counter()
    for chosen, times in steps:
        assert sum(n * m for n, m in chosen.items()) <= 1000
        for n, m in chosen.items():
            used[n] += m * times
    assert used == Counter(counts)
    assert packing.fullest({600: 1, 399: 2, 200: 3, 1: 1}, 600, 1000) == Counter({600: 1, 200: 2})
    assert packing.plan({}, 1000) == []


def test_pseudonyms(docs, none):
    out = pseudonyms.pseudonymise(docs)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r for r in out.collect() if r["doc_id"] is not None}
    texts = dict(PAIRS)
    found = {18, 19}
    for i, r in got.items():
        if i not in found:
            assert r["text"] == texts[i]
    for value in ("joe.22@", "70.123.182.155", "4041894974608795", "4041-8949-7460-8795", "2001-02-28"):
        assert all(value not in (r["text"] or "") for r in got.values())
    mail = [re.search(r"\w+\.\d\d@mail7\.example\.com", got[i]["text"])[0] for i in (18, 19)]
    card = [re.sub("-", "", re.search(r"\d{4}-?\d{4}-?\d{4}-?\d{4}", got[i]["text"])[0]) for i in (18, 19)]
    assert mail[0] == mail[1] and card[0] == card[1]
    digits = [int(c) for c in reversed(card[0])]
    assert sum(d if n % 2 == 0 else sum(divmod(2 * d, 10)) for n, d in enumerate(digits)) % 10 == 0
    assert "\x01" in got[19]["text"]
    assert all(r["n_chars"] == (len(r["text"]) if r["text"] is not None else None) for r in got.values())
    assert plain(pseudonyms.pseudonymise(none)) == []


def test_pseudonyms_are_one_to_one(spark):
    sizes = pseudonyms.DAYS
    days = spark.range(sizes[0] * sizes[1]).select(pseudonyms.permuted_number(F.col("id"), sizes, "k", "date").alias("v"))
    r = days.agg(F.countDistinct("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    assert tuple(r) == (73049, 0, 73048)
    short = spark.range(1000).select(pseudonyms.permuted_text(F.lpad(F.col("id").cast("string"), 3, "0"), "k", "t").alias("v"))
    assert short.filter("v rlike '^[0-9]{3}$'").distinct().count() == 1000


def test_pseudonyms_leave_what_is_not_valid(spark):
    texts = ["4041894974608796", "999.1.1.1", "2001-02-30", "1850-01-01", "666-12-1234", "000-12-1234", "Version 2.0", "a" * 5000]
    got = pseudonyms.pseudonymise(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    assert [r["text"] for r in got] == texts


def rewritten(spark, texts):
    return [r["text"] for r in pseudonyms.pseudonymise(spark.createDataFrame([(t,) for t in texts], "text string")).collect()]


def test_pseudonyms_of_named_secrets_in_any_case(spark):
    value = "a1b2c3d4e5f60718293a4b5c6d7e8f9012345678"
    names = ["token", "TOKEN", "Token", "Password", "PASSWD", "API_KEY", "Api_Key", "Secret", "sEcReT"]
    signs = [' = "', ": ", "=", " : '"]
    got = rewritten(spark, [f"{n}{s}{value} end" for n in names for s in signs])
    found = set()
    for text, (n, s) in zip(got, [(n, s) for n in names for s in signs]):
        assert text.startswith(n + s) and text.endswith(" end") and value not in text
        found.add(text[len(n + s) : -4])
    assert len(found) == 1


def test_pseudonyms_of_marked_telephone_numbers(spark):
    """A country code or brackets make a number one, whatever digits its area begins with; bare groups need 2-9."""
    marked = ["+1 (017) 555-7713", "+1 (117) 155-7713", "(017) 555-7713", "+1 017-555-7713", "+1.415.555.2671", "+14155552671", "+44 20 7946 0958", "+353 1 234 5678", "+49 (0)30 1234567", "+33 1 23 45 67 89", "+4915112345678"]
    tails = ["", ", call", " 2024-05-01", " 415-555-2672"]
    got = rewritten(spark, [v + t for v in marked for t in tails] + ["017-555-7713", "+5 apples 12", "2 + 3 (100) 4", "415-555-2671"])
    alone = got[:: len(tails)][: len(marked)]
    for n, v in enumerate(marked):
        assert alone[n] != v and re.sub(r"\d", "0", alone[n]) == re.sub(r"\d", "0", v)
        for k, t in enumerate(tails):
            own = got[n * len(tails) + k]
            assert own.startswith(alone[n]) and (own == alone[n] + t if k < 2 else t not in own)
    assert alone[6].startswith("+44 ") and alone[7].startswith("+353 ")
    digits = lambda v: re.sub(r"\D", "", v)[-10:]
    assert digits(alone[4]) == digits(alone[5]) == digits(got[-1])
    assert got[-4:-1] == ["017-555-7713", "+5 apples 12", "2 + 3 (100) 4"]


NEIGHBOURS = [
    ["4111 1111 1111 1111", " 12/25"],
    ["4111 1111 1111 1111", " 123 and"],
    ["2024 ", "4111 1111 1111 1111"],
    ["12 ", "4111-1111-1111-1111", " 7"],
    ["4111 1111 1111 1111", " ", "5500 0000 0000 0004"],
    ["4111111111111111", " ", "415-555-2671"],
    ["3782 822463 10005", " 12/25"],
    ["4111 1111 1111 1111", " ", "2024/05/01"],
    ["4111 1111 1111 1111", " ", "70.123.182.155"],
    ["4111 1111 1111 1111", " ", "01.02.2024"],
    ["4111 1111 1111 1111", " ", "123-45-6789"],
    ["415-555-2671", " 1234 Main St"],
    ["415-555-2671", " ", "2024-05-01"],
    ["415-555-2671", " ", "415-555-2672"],
    ["415-555-2671", " ", "4111 1111 1111 1111", " 99"],
    ["41111111 11111111"],
]


def test_pseudonyms_beside_other_numbers(spark):
    """Each value (of ten digits or with a point or slash of its own) gets the pseudonym it has when it stands alone."""
    is_value = lambda v: sum(c.isdigit() for c in v) >= 8
    values = sorted({v for row in NEIGHBOURS for v in row if is_value(v)})
    alone = dict(zip(values, rewritten(spark, values)))
    assert all(k != v and re.sub(r"\d+", "0", k) == re.sub(r"\d+", "0", v) for k, v in alone.items())
    got = rewritten(spark, ["".join(row) for row in NEIGHBOURS])
    assert got == ["".join(alone.get(v, v) for v in row) for row in NEIGHBOURS]


def labelled(spark):
    rng = np.random.default_rng(1)
    docs, labels = [], []
    for i in range(400):
        bad, toxic = rng.random() < 0.3, rng.random() < 0.3
        text = C.prose(1000 + i, 60)
        text = " ".join(w + "$$$!!" for w in text.split(" ")) if bad else text
        text = text + " idiot moron" if toxic else text
        docs.append((i, text, "en", f"src{i % 3}"))
        if i < 300:
            labels.append((i, int(not bad), int(toxic)))
    labels += [(None, 1, 0), (5, None, 1), (7777, 1, 1)]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_classifiers_on_held_out_documents(spark):
    docs, labels = labelled(spark)
    kept = {r["doc_id"]: r["keep"] for r in quality.classify(docs, labels).collect()}
    both = labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    scores = {r["doc_id"]: r["p_toxic"] for r in toxicity.classify(docs, both, ["low_quality", "toxic"]).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    held_out = range(300, 400)
    assert np.mean([kept[i] == ("$$$" not in texts[i]) for i in held_out]) >= 0.97
    assert np.mean([(scores[i] >= 0.5) == ("idiot" in texts[i]) for i in held_out]) >= 0.97


def test_labelled_rows_are_one_per_document(spark):
    rows = [(1, "often")] * 500 + [(1, "other"), (1, None), (2, "once"), (3, None), (None, "x"), (4, "no label")]
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (3, 1), (None, 1)], "doc_id long, quality int")
    got = [linear.labelled(spark.createDataFrame(rows, "doc_id long, text string").repartition(n), labels, ["quality"]).collect() for n in (1, 5)]
    one = [sorted(((r["doc_id"], r["quality"], r["text"] and bytes(r["text"])) for r in g), key=str) for g in got]
    assert one[0] == one[1] and [x[:2] for x in one[0]] == [(1, 0), (2, 1), (3, 1)] and [x[2] for x in one[0][1:]] == [b"once", None]


def test_chain_reads_earlier_categories():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 3))
    y = np.c_[(x[:, 0] > 0), (x[:, 0] > 0) & (x[:, 1] > 0)].astype(float)
    models = toxicity.train(x, y, np.arange(600) % 3)
    assert [len(m.weights) for m in models] == [3, 4] and models[1].weights[3] > 0
    alone = linear.fit(x, np.ones(600))
    assert not alone.weights.any() and alone.bias > 5


def test_classifiers_on_awkward_input(spark, docs, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality.classify(docs, labels)
    assert set(docs.columns) < set(rows.columns) or set(docs.columns) <= set(rows.columns)
    assert rows.filter("keep").count() == len(PAIRS)
    assert plain(quality.classify(none, labels)) == []
    assert toxicity.classify(docs, labels.drop("quality"), ["toxic"]).count() == len(PAIRS)
    assert plain(toxicity.classify(none, labels.drop("quality"), ["toxic"])) == []


def test_sparse_sites_follow_their_host(spark):
    rows = [("a", "x", 0.9)] * 300 + [("a", "y", 0.1)] + [("b", "x", 0.1)] * 300
    places = quality.sites(spark.createDataFrame(rows, "host string, path string, p double"))
    rate = {}
    for r in places.collect():
        host = (r["host_s"] + r["host_k"] * r["base"]) / (r["host_n"] + r["host_k"])
        rate[r["host"], r["path"]] = (r["s"] + r["path_k"] * host) / (r["n"] + r["path_k"])
    assert rate["a", "x"] > 0.8 and rate["b", "x"] < 0.2
    assert 0.1 < rate["a", "y"]


def test_pipeline(spark, docs, items, none, tmp_path):
    """Each stage on all its predecessor kept, with columns unchanged but for the last."""
    folder = str(tmp_path)
    items.write.parquet(f"{folder}/benchmark.parquet")
    labelled(spark)[1].filter("doc_id > 1000").write.parquet(f"{folder}/labels.parquet")
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    docs.select(names).write.parquet(f"{folder}/documents.parquet")
    at, left = spark.read.parquet(f"{folder}/documents.parquet"), list(PAIRS)
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, at, folder)
        if n < 4:
            assert out.columns == names
            assert plain(stage(spark, none.select(names), folder)) == []
        out.write.parquet(f"{folder}/{n}")
        at = spark.read.parquet(f"{folder}/{n}")
        if name == "near_duplicates":
            want = {x[2] for x in C.simhash_classes(left)}
            assert {r["doc_id"] for r in at.collect()} == want and at.count() == len(want)
            left = [(r["doc_id"], r["text"]) for r in at.collect()]
        if name == "decontamination":
            want = C.contamination(left, C.benchmark())
            left = [p for p in left if not want[p][-1]]
            assert Counter((r["doc_id"], r["text"]) for r in at.collect()) == Counter(left)
    whole = Counter(tuple(r)[:5] for r in corpus_pipeline.run(spark, folder).collect())
    assert whole == Counter(tuple(r)[:5] for r in at.collect())
    assert {r[0] for r in whole} == {i for i, _ in left}
    clash = docs  # columns named like the operators' own
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, clash, folder).columns == docs.columns


@pytest.mark.parametrize("batch", [2, 1000])
def test_crowds_over_batch_edges(spark, batch):
    rng = np.random.default_rng(7)
    rows = [(int(b), int(n)) for b, n in zip(rng.integers(0, 40, 300), rng.integers(-5, 5, 300))] + [(99, 3)] * 20 + [(98, n % 7) for n in range(60)]
    nodes = defaultdict(set)
    for b, n in rows:
        nodes[b].add(n)
    want = Counter((b, n, min(own)) for b, own in nodes.items() if len(own) > 1 for n in own)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, batch)
    try:
        got = Counter(plain(paragraphs.crowds(spark.createDataFrame(rows, "bucket long, short long"))))
    finally:
        spark.conf.set(key, before)
    assert got == want
