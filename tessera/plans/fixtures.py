"""Derived fixture views shared by several queries (Spark side and SQL side).

Fixed values (chosen once, used by query and oracle alike):
  selected words: the in and to of a is on that was as be for it with this are by at from
  stop words: a an and are as at be but by for if in into is it no not of on or such that the
              their then there these they this to was will with
  all-words set: the and of to
  scored lineitem view:
    cents  = round(l_extendedprice * 100) as bigint
    label  = +1 if (l_quantity - 25 + 100 * (l_discount - 0.05) > 0) XOR (cents % 10 = 0) else -1
    z      = round(0.1 * (l_quantity - 25) + 10 * (l_discount - 0.05), 9)   (rounded so both
             engines group identical margins)
    score  = 1 / (1 + exp(-z))
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values
STOP_WORDS = ["a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into",
              "is", "it", "no", "not", "of", "on", "or", "such", "that", "the", "their", "then",
              "there", "these", "they", "this", "to", "was", "will", "with"]
ALL_WORDS_SET = ["the", "and", "of", "to"]
SELECTED_WORDS = ["the", "in", "and", "to", "of", "a", "is", "on", "that", "was",
                  "as", "be", "for", "it", "with", "this", "are", "by", "at", "from"]


def words_values_sql(words=None, alias: str = "sw") -> str:
    words = SELECTED_WORDS if words is None else words
    return "(VALUES " + ", ".join(f"('{w}')" for w in words) + f") AS {alias}(word)"


def lineitem_cents(li: DataFrame) -> DataFrame:
    return li.withColumn("cents", F.round(F.col("l_extendedprice") * 100).cast("bigint"))


def scored_lineitem(li: DataFrame) -> DataFrame:
    li = lineitem_cents(li)
    truth = (F.col("l_quantity") - 25 + 100 * (F.col("l_discount") - 0.05)) > 0
    flip = (F.col("cents") % 10) == 0
    label = F.when(truth != flip, F.lit(1)).otherwise(F.lit(-1)).cast("bigint")
    z = F.round(0.1 * (F.col("l_quantity") - 25) + 10 * (F.col("l_discount") - 0.05), 9)
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "cents",
                     "l_quantity", "l_discount", "l_tax", label.alias("label"),
                     score.alias("score"))


SCORED_LINEITEM_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, cents, l_quantity, l_discount, l_tax,
       (CASE WHEN ((l_quantity - 25 + 100 * (l_discount - 0.05)) > 0) <> (cents % 10 = 0)
             THEN 1 ELSE -1 END)::BIGINT AS label,
       1.0 / (1.0 + exp(-round(0.1 * (l_quantity - 25) + 10 * (l_discount - 0.05), 9))) AS score
FROM (SELECT *, round(l_extendedprice * 100)::BIGINT AS cents FROM lineitem)
"""
