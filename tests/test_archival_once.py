"""Morphology given to the folds of the archival table is computed once for a row, not once for a word."""

import pytest
from pyspark.sql import functions as F

from utterlake.functions import archival


@pytest.mark.parametrize("fold", [archival.realign_reformulations, archival.reconcile])
def test_no_step_computes_the_items_again(spark, fold):
    df = spark.range(1).select(F.lit("a b").alias("gloss"), F.split(F.lit("a b"), " ").alias("words"), F.split(F.lit("n|a n|b"), " ").alias("items_given"))
    out = df.select(fold(F.col("gloss" if fold is archival.realign_reformulations else "words"), F.col("items_given")).alias("x"))
    plan = out._jdf.queryExecution().logical().toString().splitlines()[0]
    assert "aggregate(" in plan and "items_given" not in plan.split("aggregate(", 1)[1]
    assert out.first().x == ["n|a", "n|b"]
