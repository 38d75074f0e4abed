"""Benchmark decontamination by winnowing, in DataFrame functions only.

Every run of ``span`` words is covered by ``span - k + 1`` k-gram hashes; the smallest of
them is kept as a fingerprint. Equal runs keep equal minima, so a document that shares a
run with a benchmark item shares a fingerprint with it, whatever surrounds the run. The
fingerprints of documents meet those of the benchmark in a join, and around each hit the
runs that contain it are compared word for word.

Items shorter than ``span`` words are one window each; they are found by the hash of that
many words at every place of a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import KEY, ascii_lower, keyed, let, row_key, table
from larkspur.session import durable

SPAN = 13
GRAM = 8

# A fingerprint is one long: the upper bits of the hash, then the place modulo 2^20. Places
# that far apart in one document are told apart by the comparison of the words.
PLACE_BITS = 20
PLACES = 1 << PLACE_BITS

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-case runs of ASCII letters, digits and all characters beyond ASCII; none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _upto(n: Column) -> Column:
    """1..n, empty where n is below 1."""
    return F.when(n >= 1, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def _grams(w: Column, k: int) -> Column:
    def packed(i):
        high = F.xxhash64(F.slice(w, i, F.lit(k))).bitwiseAND(F.lit(-PLACES))
        return high.bitwiseOR(i.cast("long").bitwiseAND(F.lit(PLACES - 1)))

    return F.transform(_upto(F.size(w) - (k - 1)), packed)


def winnowed(w: Column, span: int, k: int) -> Column:
    """The packed fingerprints of a word array."""
    width = span - k + 1
    return let(
        _grams(w, k),
        lambda g: F.array_distinct(
            F.transform(_upto(F.size(g) - (width - 1)), lambda i: F.array_min(F.slice(g, i, F.lit(width))))
        ),
    )


def _seed(packed: Column) -> Column:
    return F.shiftright(packed, PLACE_BITS)


def benchmark_windows(items: DataFrame, span: int) -> DataFrame:
    """(item_id, length, win): the distinct windows of each item."""
    w = items.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    starts = _upto(F.greatest(F.size("w") - (span - 1), F.lit(1)))
    wins = F.transform(starts, lambda i: F.slice("w", i, F.lit(span)))
    return w.select("item_id", F.explode(wins).alias("win")).select("item_id", F.size("win").alias("length"), F.array_join("win", " ").alias("win")).distinct()


def benchmark_seeds(windows: DataFrame, span: int, k: int) -> DataFrame:
    """(length, seed): what a document must hold to be looked at."""
    w = F.split("win", " ")
    packed = F.when(F.col("length") == span, winnowed(w, span, k)).otherwise(F.array(F.xxhash64(w)))
    return windows.select("length", F.explode(packed).alias("p")).select("length", _seed(F.col("p")).alias("seed")).distinct()


def _covered(spans: Column) -> Column:
    """Number of places inside any of the (start, length) spans."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))

    def step(acc, s):
        last = s["start"] + s["length"] - 1
        fresh = last - F.greatest(acc["upto"], s["start"] - 1)
        return F.struct((acc["n"] + F.greatest(fresh, F.lit(0))).alias("n"), F.greatest(acc["upto"], last).alias("upto"))

    return F.aggregate(F.array_sort(spans), zero, step)["n"]


def decontaminate(docs: DataFrame, items: DataFrame, span: int = SPAN, k: int = GRAM) -> DataFrame:
    """One row per document: doc_id, k_id, k_text, n_words, n_hit, n_items, items_sha256, contaminated.

    ``docs`` needs doc_id and text, ``items`` item_id and text; other columns are not read.
    A null or wordless text has no words and is clean; repeated rows and repeated or null
    doc_ids each get their row. An item that is null or has no words has no window. An
    item without an id counts in n_hit but is not listed. An empty benchmark, or no
    documents, give clean rows, or none.
    """
    docs = docs.select("doc_id", "text", *row_key())
    windows = durable(benchmark_windows(items.select("item_id", "text"), span))
    seeds = durable(benchmark_seeds(windows, span, k))
    # at most span - 1 numbers
    short = sorted(r["length"] for r in windows.filter(F.col("length") < span).select("length").distinct().collect())

    def marks(w):
        whole = [winnowed(w, span, k).alias(f"m{span}")]
        return F.struct(F.size(w).cast("long").alias("n_words"), *whole, *[_grams(w, n).alias(f"m{n}") for n in short])

    read = docs.select("doc_id", *KEY, let(words(F.col("text")), marks).alias("m")).select("doc_id", *KEY, "m.*")
    read = durable(read)
    places = None
    for n in [span, *short]:
        part = read.select(*KEY, F.lit(n).alias("length"), F.explode(f"m{n}").alias("p"))
        places = part if places is None else places.unionByName(part)
    found = (
        places.withColumn("seed", _seed(F.col("p")))
        .join(seeds, ["length", "seed"])
        .groupBy(*KEY, "length")
        .agg(F.collect_set(F.col("p").bitwiseAND(F.lit(PLACES - 1)).cast("int")).alias("places"))
    )
    spans = _extend(docs, durable(found), windows, span, k)
    hit = spans.groupBy(*KEY).agg(
        _covered(F.collect_set(F.struct("start", "length"))).cast("long").alias("n_hit"),
        F.array_sort(F.collect_set("list_id")).alias("lists"),
    )
    hit = durable(hit.withColumn("lists_id", F.sha2(F.array_join("lists", ","), 256)))
    named = hit.join(_named(hit, windows), "lists_id").select(*KEY, "n_hit", "n_items", "items_sha256")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (
        read.select("doc_id", *KEY, "n_words")
        .join(named, KEY, "left")
        .select(
            "doc_id",
            *KEY,
            "n_words",
            n_hit.alias("n_hit"),
            F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
            F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
            ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"),
        )
    )


def _item_lists(windows: DataFrame) -> DataFrame:
    """(win, list_id, items): windows with the sorted ids of the items that have them."""
    ids = F.array_sort(F.collect_set(F.col("item_id").cast("string")))
    return windows.groupBy("win").agg(ids.alias("items")).withColumn("list_id", F.sha2(F.array_join("items", ","), 256))


def _extend(docs: DataFrame, found: DataFrame, windows: DataFrame, span: int, k: int) -> DataFrame:
    """(key, start, length, list_id): every occurrence of a benchmark window around a hit."""
    texts = docs.select(*KEY, "text").join(found, KEY).select(*KEY, "length", "places", words(F.col("text")).alias("w"))

    def around(p, length, n):
        back = F.when(length == span, F.lit(span - k)).otherwise(F.lit(0))
        return F.sequence(F.greatest(p - back, F.lit(1)), p)

    def wins(w, places, length):
        n = F.size(w)
        # a place is known modulo 2^20
        every = F.flatten(F.transform(places, lambda p: F.when(p > n, F.array().cast("array<int>")).otherwise(F.sequence(p, n, F.lit(PLACES)))))
        zero = F.when(F.array_contains(places, 0), _upto(F.floor(n / PLACES).cast("int"))).otherwise(F.array().cast("array<int>"))
        every = F.concat(F.filter(every, lambda p: p > 0), F.transform(zero, lambda i: (i * PLACES).cast("int")))
        starts = F.array_distinct(F.flatten(F.transform(every, lambda p: around(p, length, n))))
        return F.transform(
            F.filter(starts, lambda s: s + length - 1 <= n),
            lambda s: F.struct(s.alias("start"), F.array_join(F.slice(w, s, length), " ").alias("win")),
        )

    spans = texts.select(*KEY, "length", F.explode_outer(let(F.col("w"), lambda w: wins(w, F.col("places"), F.col("length")))).alias("s"))
    spans = spans.select(*KEY, "length", "s.start", "s.win").filter(F.col("win").isNotNull())
    lists = durable(_item_lists(windows).select("win", "list_id"))
    return spans.join(lists, "win").select(*KEY, "start", "length", "list_id")


def _named(hit: DataFrame, windows: DataFrame) -> DataFrame:
    """(lists_id, n_items, items_sha256), worked out once per combination: copies share theirs."""
    lists = _item_lists(windows).select("list_id", "items").distinct()
    each = hit.select("lists_id", "lists").distinct().select("lists_id", F.explode("lists").alias("list_id"))
    ids = each.join(lists, "list_id").select("lists_id", F.explode_outer("items").alias("item"))
    listed = ids.groupBy("lists_id").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return listed.select("lists_id", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))


def query(spark, sf_dir):
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.drop(*KEY)


def stage(spark, docs, sf_dir):
    """Documents without the contaminated ones."""
    bad = decontaminate(docs, table(spark, sf_dir, "benchmark")).filter("contaminated").select(*KEY).distinct()
    return keyed(docs).join(bad, KEY, "left_anti").select("own.*")


_WORDS = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), {SPAN}) AS length, array_to_string(w[i:i + {SPAN - 1}], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {SPAN - 1}, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT length FROM bw),
dw AS (SELECT doc_id, i, length, array_to_string(w[i:i + length - 1], ' ') AS win
  FROM (SELECT doc_id, w, length, unnest(range(1, len(w) - length + 2)) AS i FROM d, lengths)),
m AS (SELECT doc_id, i, dw.length, item_id FROM dw JOIN bw USING (win)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + length)) AS p FROM m) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""
