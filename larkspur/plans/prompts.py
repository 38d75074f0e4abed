"""Prompt columns, packed chat histories, completion calls and token estimates."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur import domain as D
from larkspur.operators.ordered import numbered
from larkspur.registry import query

ASK = "Describe this product in one sentence: "


@query("prompt_column", f"SELECT p_partkey, '{ASK}' || p_name || ' (' || p_brand || ')' AS prompt FROM part")
def prompt_column(spark, sf):
    return D.table(spark, sf, "part").select(
        "p_partkey", F.concat(F.lit(ASK), "p_name", F.lit(" ("), "p_brand", F.lit(")")).alias("prompt")
    )


@query(
    "chat_history_pack",
    """SELECT conv_id, CAST(p AS BIGINT) AS part, count(*) AS messages, string_agg(role, ',' ORDER BY turn) AS roles, md5(string_agg(text, chr(10) ORDER BY turn)) AS text_digest,
  '{"temperature":0.2,"max_tokens":' || 100 * count(*) || '}' AS options FROM
(SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 500 AS p FROM conversations) GROUP BY conv_id, p""",
)
def chat_history_pack(spark, sf, part_size: int = 500):
    """Ordered message arrays per conversation.

    A conversation longer than ``part_size`` messages continues in further parts, so no
    array grows without bound and no message is left out.
    """
    history = packed_history(spark, sf, part_size)
    tokens = F.size("messages") * 100
    return history.select(
        "conv_id",
        "part",
        F.size("messages").alias("messages"),
        F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"),
        F.md5(F.array_join(F.transform("messages", lambda m: m["content"]), "\n")).alias("text_digest"),
        F.to_json(F.struct(F.lit(0.2).alias("temperature"), tokens.alias("max_tokens"))).alias("options"),
    )


def packed_history(spark, sf, part_size: int):
    """Messages are numbered by (conversation, turn) alone; their texts travel once, to their part."""
    said = D.table(spark, sf, "conversations")
    heads = numbered(said.select("conv_id", "turn"), ["turn"], "_pos", start=0, keys=["conv_id"])
    # messages of one turn share a place
    heads = heads.groupBy("conv_id", "turn").agg(F.min("_pos").alias("_pos")).withColumnsRenamed({"conv_id": "_c", "turn": "_t"})
    turns = said.join(heads, F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t")))
    part = F.floor(F.col("_pos") / part_size).alias("part")
    message = F.struct("_pos", "role", F.col("text").alias("content"))
    packed = turns.groupBy("conv_id", part).agg(F.sort_array(F.collect_list(message)).alias("m"))
    return packed.select("conv_id", "part", F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


@query(
    "token_budget",
    """SELECT doc_id, words, chars_estimate, words > 1000 OR chars_estimate > 1500 AS over_limit FROM (SELECT doc_id, len(list_filter(regexp_split_to_array(text, '[ \\n\\t\\r]+'), lambda w: w <> ''))
  AS words, CAST(ceil(length(text) / 4) AS BIGINT) AS chars_estimate FROM documents)""",
)
def token_budget(spark, sf, limit_words: int = 1000, limit_tokens: int = 1500):
    """Word count and the characters / 4 estimate of each text; both are estimates of tokens."""
    words = F.size(F.filter(F.split("text", r"[ \n\t\r]+"), lambda w: w != ""))
    chars = F.ceil(F.length("text") / 4)
    return D.table(spark, sf, "documents").select(
        "doc_id",
        words.alias("words"),
        chars.alias("chars_estimate"),
        ((words > limit_words) | (chars > limit_tokens)).alias("over_limit"),
    )
