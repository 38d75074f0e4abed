"""JSON and VARIANT jobs over event properties, conversations and menu health metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur import domain as D
from larkspur.functions import dialect as X
from larkspur.plans.aggregates import n_rows
from larkspur.registry import query


def _props(spark, sf):
    return D.table(spark, sf, "events").withColumn("v", F.parse_json("props"))


@query(
    "json_extract",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text, CAST(NULL AS VARCHAR) AS missing,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) * 2 AS k_doubled, CAST(NULL AS BIGINT) AS wrong_case FROM events""",
)
def json_extract(spark, sf):
    return _props(spark, sf).select(
        "event_id",
        F.variant_get("v", "$.k", "bigint").alias("k"),
        F.get_json_object("props", "$.k").alias("k_text"),
        F.try_variant_get("v", "$.nothing", "string").alias("missing"),
        (F.try_variant_get("v", "$.k", "double") * 2).alias("k_doubled"),
        F.try_variant_get("v", "$.K", "bigint").alias("wrong_case"),
    )


@query(
    "json_flatten",
    """SELECT p_partkey AS menu_item_id, i AS pos, ['calories', 'fat', 'sodium'][i + 1] AS metric, CAST([p_size * 10, p_size, p_size * 2][i + 1] AS DOUBLE) AS value
FROM part, range(3) r(i)""",
)
def json_flatten(spark, sf):
    menu = D.menu(spark, sf).select("menu_item_id", F.parse_json("health_metrics").alias("doc"))
    return _metric_rows(spark, menu)


def _metric_rows(spark, menu):
    return spark.sql(
        """SELECT menu_item_id, f.pos, variant_get(f.value, '$.metric', 'string') AS metric, try_variant_get(f.value, '$.value', 'double') AS value
        FROM {menu}, LATERAL variant_explode(variant_get(doc, '$.menu_item_health_metrics', 'variant')) AS f""",
        menu=menu,
    )


@query(
    "json_flatten_object",
    """SELECT event_id, CASE WHEN event_type <> 'view' THEN 'k' END AS key, CASE WHEN event_type <> 'view' THEN json_extract_string(props, '$.k') END AS value FROM events""",
)
def json_flatten_object(spark, sf):
    """Keys and values of objects; an empty object keeps its row, as the outer form does."""
    props = F.when(F.col("event_type") == "view", F.lit("{}")).otherwise(F.col("props"))
    doc = F.from_json(props, "map<string,string>")
    return D.table(spark, sf, "events").select("event_id", F.explode_outer(doc).alias("key", "value"))


@query(
    "json_kind_predicates",
    """SELECT count(*) FILTER (event_type = 'view') AS is_array, count(*) FILTER (event_type = 'click') AS is_object, count(*) FILTER (event_type = 'error') AS is_null_value,
  count(*) FILTER (event_type = 'purchase') AS is_decimal, count(*) FILTER (event_type NOT IN ('view', 'click', 'error', 'purchase')) AS is_varchar,
  count(*) FILTER (event_type = 'purchase') AS is_number, CAST(0 AS BIGINT) AS is_boolean FROM events""",
)
def json_kind_predicates(spark, sf):
    """The IS_* family over one column of mixed values."""
    v = D.table(spark, sf, "events").select(F.parse_json(F.expr(MIXED)).alias("v"))
    kinds = {
        "is_array": ("array",),
        "is_object": ("object",),
        "is_null_value": ("null",),
        "is_decimal": ("decimal",),
        "is_varchar": ("string",),
        "is_number": ("integer", "decimal", "double"),
        "is_boolean": ("boolean",),
    }
    return v.agg(*[F.count_if(X.is_kind("v", *names)).alias(alias) for alias, names in kinds.items()])


@query(
    "json_flatten_agg",
    "SELECT p_partkey AS menu_item_id, CAST(p_size * 13 AS DOUBLE) AS total, 3 AS metrics FROM part",
)
def json_flatten_agg(spark, sf):
    return json_flatten(spark, sf).groupBy("menu_item_id").agg(F.sum("value").alias("total"), n_rows("metrics"))


@query(
    "json_object_edit",
    """SELECT event_id, '{"type":"' || event_type || '","user":"' || user_id || '"}' AS built, '{"type":"' || event_type || '","user":"' || user_id || '","tag":"x"}' AS inserted,
  '{"type":"' || event_type || '","user":"0"}' AS updated, '{"user":"' || user_id || '"}' AS deleted, '{"type":"' || event_type || '"}' AS picked, 'type,user' AS keys,
  '{"user":' || user_id || ',"note":null}' AS keep_null FROM events""",
)
def json_object_edit(spark, sf):
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    obj = F.create_map(F.lit("type"), kind, F.lit("user"), user)
    with_null = F.create_map(F.lit("type"), kind, F.lit("user"), user, F.lit("note"), F.lit(None).cast("string"))
    return D.table(spark, sf, "events").select(
        "event_id",
        F.to_json(F.map_filter(with_null, lambda _, v: v.isNotNull())).alias("built"),
        F.to_json(X.object_insert(obj, "tag", F.lit("x"))).alias("inserted"),
        F.to_json(X.object_insert(obj, "user", F.lit("0"), update=True)).alias("updated"),
        F.to_json(X.object_delete(obj, "type")).alias("deleted"),
        F.to_json(X.object_pick(obj, "type")).alias("picked"),
        F.array_join(F.map_keys(obj), ",").alias("keys"),
        F.to_json(F.struct(F.col("user_id").alias("user"), F.lit(None).cast("string").alias("note")), {"ignoreNullFields": "false"}).alias("keep_null"),
    )


# Values of several kinds, built from the columns of an event.
MIXED = """CASE event_type WHEN 'view' THEN '[' || user_id || ']' WHEN 'click' THEN props WHEN 'error' THEN 'null'
  WHEN 'purchase' THEN '12.5' WHEN 'signup' THEN '"2024-01-01"' END"""


@query(
    "json_type_profile",
    """SELECT CASE event_type WHEN 'view' THEN 'array' WHEN 'click' THEN 'object' WHEN 'error' THEN 'null' WHEN 'purchase' THEN 'decimal' ELSE 'string' END AS kind,
  count(*) AS n, count(*) FILTER (event_type = 'view') AS arrays, count(*) FILTER (event_type = 'error') AS nulls, count(*) FILTER (event_type <> 'error') AS stripped,
  'variant' AS column_type FROM events GROUP BY 1""",
)
def json_type_profile(spark, sf):
    v = D.table(spark, sf, "events").select(F.parse_json(F.expr(MIXED)).alias("v"))
    tagged = v.select(
        X.kind_of("v").alias("kind"),
        F.is_variant_null("v").alias("is_null"),
        X.strip_null_value("v").isNotNull().alias("kept"),
        F.typeof("v").alias("column_type"),
    )
    return tagged.groupBy("kind").agg(
        n_rows(),
        F.count_if(F.col("kind") == "array").alias("arrays"),
        F.count_if("is_null").alias("nulls"),
        F.count_if("kept").alias("stripped"),
        F.any_value("column_type").alias("column_type"),
    )


@query(
    "json_validate",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'invalid' END AS problem FROM events""",
)
def json_validate(spark, sf):
    text = F.when(F.col("event_type") == "error", F.concat(F.col("props"), F.lit("}"))).otherwise(F.col("props"))
    return D.table(spark, sf, "events").select("event_id", X.check_json(text).alias("problem"))


@query(
    "variant_to_columns",
    """SELECT conv_id, turn, role, CAST(length(text) AS BIGINT) AS chars, CAST(NULL AS BIGINT) AS score FROM conversations""",
)
def variant_to_columns(spark, sf):
    """A relational table out of one variant column."""
    packed = D.table(spark, sf, "conversations").select(F.parse_json(F.to_json(F.struct("conv_id", "turn", "role", "text"))).alias("v"))
    return packed.select(
        F.try_variant_get("v", "$.conv_id", "bigint").alias("conv_id"),
        F.try_variant_get("v", "$.turn", "bigint").alias("turn"),
        F.try_variant_get("v", "$.role", "string").alias("role"),
        F.length(F.try_variant_get("v", "$.text", "string")).alias("chars"),
        F.try_variant_get("v", "$.role", "bigint").alias("score"),
    )
