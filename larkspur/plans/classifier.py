"""The small classification job: which neighbourhood a truck visits on a day.

Order days are reduced to (month, day) with their number of orders before anything is
trained, so the model sees at most 366 weighted rows however many orders there are.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier, OneVsRest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from larkspur import domain as D
from larkspur.registry import query
from larkspur.session import durable


def neighbourhood(month, day):
    """January: 1 on every seventh day, else 2; February to November: cycle 1-7; December: 8."""
    cycle = (day - 1) % 7 + 1
    return F.when(month == 1, F.when(day % 7 == 1, 1).otherwise(2)).when(month <= 11, cycle).otherwise(8)


PATTERN_SQL = """SELECT month, day, CASE WHEN month = 1 THEN CASE WHEN day % 7 = 1 THEN 1 ELSE 2 END WHEN month <= 11 THEN (day - 1) % 7 + 1 ELSE 8 END AS neighborhood, n
FROM (SELECT CAST(month(order_date) AS BIGINT) AS month, CAST(day(order_date) AS BIGINT) AS day, count(*) AS n FROM v_orders GROUP BY 1, 2)"""


@query("ml_pattern_data", PATTERN_SQL.replace("END AS neighborhood", "END::BIGINT AS neighborhood"))
def ml_pattern_data(spark, sf):
    d = D.orders(spark, sf).groupBy(F.month("order_date").alias("month"), F.day("order_date").alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return d.select("month", "day", neighbourhood(F.col("month"), F.col("day")).alias("neighborhood"), "n")


def encoded(spark, sf):
    rows = ml_pattern_data(spark, sf).withColumn("name", F.col("neighborhood").cast("string"))
    indexer = StringIndexer(inputCol="name", outputCol="label", stringOrderType="alphabetAsc")
    return indexer.fit(rows).transform(rows).drop("name", "neighborhood")


@query(
    "ml_label_encode",
    f"""WITH p AS ({PATTERN_SQL}), c AS (SELECT neighborhood, row_number() OVER (ORDER BY CAST(neighborhood AS VARCHAR)) - 1 AS label FROM (SELECT DISTINCT neighborhood FROM p))
SELECT month, day, n, CAST(label AS DOUBLE) AS label FROM p JOIN c USING (neighborhood)""",
)
def ml_label_encode(spark, sf):
    return encoded(spark, sf)


def hash_split(df, share: float, *keys: str):
    """Repeatable random split by key hash: the same row always lands on the same side."""
    slot = F.pmod(F.xxhash64(*keys), F.lit(1000))
    edge = int(share * 1000)
    return df.filter(slot < edge), df.filter(slot >= edge)


@query("ml_split")
def ml_split(spark, sf):
    train, test = hash_split(encoded(spark, sf), 0.9, "month", "day")
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


def boosted(trees: int, depth: int) -> OneVsRest:
    """Gradient-boosted trees, one model a class against the rest."""
    one = GBTClassifier(maxIter=trees, maxDepth=depth, maxBins=64, stepSize=0.3, seed=7, checkpointInterval=-1)
    return OneVsRest(classifier=one, labelCol="label", featuresCol="features", weightCol="n", parallelism=4)


def train_score(spark, sf, model):
    """(scored test rows, accuracy weighted by orders) of a model on the hash split."""
    rows = VectorAssembler(inputCols=["month", "day"], outputCol="features").transform(encoded(spark, sf))
    # at most 366 rows; stored, as each tree reads them again
    train, test = hash_split(durable(rows.coalesce(1)), 0.9, "month", "day")
    scored = model.fit(train.coalesce(1)).transform(test)
    return scored, MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy", weightCol="n").evaluate(scored)


@query("ml_train_score")
def ml_train_score(spark, sf, trees: int = 8, depth: int = 7):
    """Accuracy of boosted trees on month and day, weighted by orders."""
    scored, accuracy = train_score(spark, sf, boosted(trees, depth))
    return scored.agg(F.count(F.lit(1)).alias("test_rows")).withColumn("accuracy", F.lit(accuracy))
