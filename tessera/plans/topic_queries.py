"""Topic-model queries.

Oracle-checked parts use a topic-word table derived from counts (fixed values): all
documents, lower-cased whitespace tokens without the stop words, topic = document source,
weight(word | topic) = count of the word in the topic's documents / all its word count.
The fitted LDA (MLlib) queries are rows-only (``model_queries``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import text_features as TF
from tessera.operators.neighbors import topk_per_group
from tessera.operators.relational import distinct_values, with_prefix_sums
from tessera.plans.fixtures import STOP_WORDS, words_values_sql
from tessera.registry import query
from tessera.session import written
from tessera.sources.tables import Tables


def topic_word_counts(spark, sf_dir):
    docs = Tables(spark, sf_dir).documents
    stop = F.broadcast(spark.createDataFrame([(w,) for w in STOP_WORDS], "word string"))
    # materialised once: the counts feed the topic table, its totals and the projections
    wc = written(TF.word_counts_by(docs, "doc_id", "source").join(stop, "word", "left_anti"), "topic-counts")
    return docs, wc


def topic_sums(spark, sf_dir):
    """(topic, word, cnt) dealt by word, (topic, total) and the documents' word counts."""
    _, wc = topic_word_counts(spark, sf_dir)
    by_list = written(wc.groupBy("source", "word").agg(F.sum("count").alias("cnt")), "topic-words")
    each = by_list.select(F.explode("source").alias("topic"), "word", "cnt")
    tw = each.repartition("word").groupBy("topic", "word").agg(F.sum("cnt").alias("cnt"))
    return tw, each.groupBy("topic").agg(F.sum("cnt").alias("total")), wc


def topic_table(spark, sf_dir):
    tw, tot, wc = topic_sums(spark, sf_dir)
    return tw.join(tot, "topic"), wc


_TT_SQL = f"""
wc AS (SELECT doc_id, w AS word, count(*) AS cnt FROM
        (SELECT doc_id, unnest(string_split_regex(lower(text), '[ \\t\\r\\n]+')) AS w FROM documents) WHERE w <> '' AND w NOT IN (SELECT word FROM {words_values_sql(STOP_WORDS)})
       GROUP BY 1, 2),
tw AS (SELECT d.source AS topic, wc.word, sum(wc.cnt) AS cnt FROM wc JOIN documents d USING (doc_id)
       GROUP BY d.source, wc.word),
tot AS (SELECT topic, sum(cnt) AS total FROM tw GROUP BY topic)"""


@query("topic_mass", rows=("M3",), oracle=f"""
WITH {_TT_SQL},
r AS (SELECT tw.*, row_number() OVER (PARTITION BY topic ORDER BY cnt DESC, word) AS rd,
             row_number() OVER (PARTITION BY topic ORDER BY cnt ASC, word) AS ra FROM tw)
SELECT r.topic, round(sum(cnt) FILTER (WHERE rd <= 10) / any_value(total), 9) AS top10_mass,
       round(sum(cnt) FILTER (WHERE ra <= 10) / any_value(total), 9) AS bottom10_mass
FROM r JOIN tot USING (topic) GROUP BY r.topic
""")
def topic_mass(spark, sf_dir):
    """Probability mass of the 10 most and the 10 least probable words of each topic."""
    tt, _ = topic_table(spark, sf_dir)
    top = topk_per_group(tt, "topic", [F.desc("cnt"), F.col("word")], 10) \
        .groupBy("topic").agg(F.sum("cnt").alias("t"), F.first("total").alias("total"))
    bot = topk_per_group(tt, "topic", [F.asc("cnt"), F.col("word")], 10) \
        .groupBy("topic").agg(F.sum("cnt").alias("b"))
    return top.join(bot, "topic").select(
        "topic", F.round(F.col("t") / F.col("total"), 9).alias("top10_mass"),
        F.round(F.col("b") / F.col("total"), 9).alias("bottom10_mass"))


@query("topic_cdf_count", rows=("W3", "M4"), oracle=f"""
WITH {_TT_SQL},
c AS (SELECT tw.topic, tw.cnt, sum(cnt) OVER (PARTITION BY topic ORDER BY cnt DESC, word
                                              ROWS UNBOUNDED PRECEDING) - cnt AS before FROM tw)
SELECT c.topic, count_if(2 * before < total)::BIGINT AS n_words FROM c JOIN tot USING (topic)
GROUP BY c.topic
""")
def topic_cdf_count(spark, sf_dir):
    """Words needed (most probable first) to reach half of each topic's probability mass.

    Cumulative counts along the global (topic, count desc, word) order with distributed
    prefix sums (a large topic spans many partitions), integer arithmetic throughout."""
    tt, _ = topic_table(spark, sf_dir)
    pre = with_prefix_sums(tt, [F.col("topic"), F.desc("cnt"), F.col("word")],
                           {"s": F.col("cnt").cast("double")})
    base = pre.groupBy("topic").agg(F.min(F.col("s") - F.col("cnt")).alias("base"))
    j = pre.join(base, "topic").withColumn("before", F.col("s") - F.col("cnt") - F.col("base"))
    return j.groupBy("topic").agg(
        F.count_if(2 * F.col("before") < F.col("total")).cast("bigint").alias("n_words"))


@query("topic_weight_counts", rows=("M8",), oracle=f"""
WITH {_TT_SQL},
nt AS (SELECT count(*) AS k FROM tot),
phi AS (SELECT tw.topic, tw.word, tw.cnt / tot.total AS p FROM tw JOIN tot USING (topic)),
s AS (SELECT wc.doc_id, phi.topic, sum(wc.cnt * phi.p) AS s FROM wc JOIN phi USING (word)
      GROUP BY wc.doc_id, phi.topic),
th AS (SELECT doc_id, topic, s / sum(s) OVER (PARTITION BY doc_id) AS theta FROM s)
SELECT doc_id, count_if(theta > 0.3)::BIGINT AS n_high,
       (count_if(theta < 0.05) + (SELECT k FROM nt) - count(*))::BIGINT AS n_low FROM th GROUP BY doc_id
""")
def topic_weight_counts(spark, sf_dir):
    """Per document: number of topics with weight > 0.3 and < 0.05, where the document's
    topic weights are its word counts projected on the topic-word table, normalised."""
    tw, tot, wc = topic_sums(spark, sf_dir)
    topics = distinct_values(tot, "topic")         # bounded (checked) number of topics
    tt = tw.join(F.broadcast(tot), "topic")
    # topic-word weights as one wide row per word: the projection is then one join on word
    # and compiled multiply-adds, instead of a (doc, word, topic) row per shared word
    names = [f"p{i}" for i in range(len(topics))]
    phi = written(tt.groupBy("word").agg(F.sum("cnt").alias("df"), *[
        F.coalesce(F.max(F.when(F.col("topic") == t, F.col("cnt") / F.col("total"))), F.lit(0.0)).alias(n) for t, n in zip(topics, names)]), "phi")
    cols = [F.col(n) for n in names]
    s = TF.with_words(wc.select("doc_id", "word", "count"), phi).groupBy("doc_id").agg(
        *[F.sum(F.col("count") * c).alias(f"s{i}") for i, c in enumerate(cols)])
    z = sum(F.col(f"s{i}") for i in range(len(topics)))
    theta = [F.col(f"s{i}") / z for i in range(len(topics))]
    return s.select("doc_id",
                    sum((t > 0.3).cast("bigint") for t in theta).alias("n_high"),
                    sum((t < 0.05).cast("bigint") for t in theta).alias("n_low"))
