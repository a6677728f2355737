"""Projection, filter, join, aggregation, window, sort, set and sampling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import sql_hash32, sql_uniform
from tessera.operators import relational as R
from tessera.operators import split as S
from tessera.operators.quantiles import grouped_quantiles
from tessera.plans.fixtures import SELECTED_WORDS, words_values_sql
from tessera.registry import query
from tessera.sources.tables import Tables
from tessera.operators.text_features import word_counts


@query("select_columns", rows=("P1", "P9"), oracle="""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_quantity FROM lineitem
""")
def select_columns(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return (li.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
            .drop("l_extendedprice")
            .withColumn("l_linenumber", F.col("l_linenumber").cast("bigint")))


@query("derive_features", rows=("P2", "P5", "P25"), oracle="""
SELECT p_partkey, (p_size * p_size)::BIGINT AS size_sq, round(ln(p_retailprice), 6) AS log_price,
       round(sqrt(p_size::DOUBLE), 6) AS sqrt_size, round(p_retailprice / p_size, 6) AS price_per_size,
       round(p_size * p_retailprice, 6) AS size_x_price
FROM part
""")
def derive_features(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    return p.select("p_partkey",
                    (F.col("p_size") * F.col("p_size")).cast("bigint").alias("size_sq"),
                    F.round(F.log("p_retailprice"), 6).alias("log_price"),
                    F.round(F.sqrt(F.col("p_size").cast("double")), 6).alias("sqrt_size"),
                    F.round(F.col("p_retailprice") / F.col("p_size"), 6).alias("price_per_size"),
                    F.round(F.col("p_size") * F.col("p_retailprice"), 6).alias("size_x_price"))


@query("concat_name", rows=("P3",), oracle="""
SELECT c_custkey, concat_ws(' ', c_name, c_mktsegment) AS full_name FROM customer
""")
def concat_name(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return c.select("c_custkey", F.concat_ws(" ", "c_name", "c_mktsegment").alias("full_name"))


@query("recode_values", rows=("P4",), oracle="""
SELECT o_orderkey, substr(o_orderpriority, 1, 1)::BIGINT AS priority_code,
       (CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 ELSE -1 END)::BIGINT AS status_code,
       CASE WHEN o_totalprice < 50000 THEN 'low' WHEN o_totalprice < 150000 THEN 'mid' ELSE 'high' END
         AS price_band,
       round(ln(1 + o_totalprice), 6) AS log_price
FROM orders
""")
def recode_values(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.select(
        "o_orderkey",
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("priority_code"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0)
        .otherwise(-1).cast("bigint").alias("status_code"),
        F.when(F.col("o_totalprice") < 50000, "low").when(F.col("o_totalprice") < 150000, "mid")
        .otherwise("high").alias("price_band"),
        F.round(F.log1p("o_totalprice"), 6).alias("log_price"))


@query("cast_columns", rows=("P7",), oracle="""
SELECT p_partkey, size_str, trunc(size_str::DOUBLE)::BIGINT AS size_int,
       trunc(p_retailprice)::BIGINT AS price_int
FROM (SELECT *, p_size::VARCHAR || '.5' AS size_str FROM part)
""")
def cast_columns(spark, sf_dir):
    """String → double → integer (truncating), as ``astype(int)`` on '1.5' gives 1."""
    p = Tables(spark, sf_dir).part
    s = F.concat(F.col("p_size").cast("string"), F.lit(".5"))
    return p.select("p_partkey", s.alias("size_str"),
                    s.cast("double").cast("bigint").alias("size_int"),
                    F.col("p_retailprice").cast("bigint").alias("price_int"))


@query("filter_range", rows=("P12", "A11"), oracle="""
SELECT l_linestatus, count(*)::BIGINT AS n,
       round(avg(CASE WHEN l_extendedprice <= 40000 THEN 1.0 ELSE 0.0 END), 6) AS share_le_40k
FROM lineitem WHERE l_discount < 0.05 AND l_returnflag <> 'N'
GROUP BY l_linestatus
""")
def filter_range(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return (li.where((F.col("l_discount") < 0.05) & (F.col("l_returnflag") != "N"))
            .groupBy("l_linestatus")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.round(F.avg((F.col("l_extendedprice") <= 40000).cast("double")), 6)
                 .alias("share_le_40k")))


@query("filter_by_ids", rows=("P14", "J4"), oracle="""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def filter_by_ids(spark, sf_dir):
    t = Tables(spark, sf_dir)
    ids = t.customer.where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey"))
    return (t.orders.join(ids, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
            .select("o_orderkey", "o_custkey", "o_totalprice"))


@query("filter_contains", rows=("P15",), oracle="""
SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'red')
""")
def filter_contains(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    return p.where(F.lower("p_name").contains("red")).select("p_partkey", "p_name")


@query("dropna_split", rows=("P16", "P17"), oracle="""
WITH d AS (SELECT p_partkey, nullif(p_size, 7) AS size_n, nullif(p_brand, 'Brand#3') AS brand_n,
                  p_retailprice FROM part)
SELECT (size_n IS NOT NULL AND brand_n IS NOT NULL) AS complete, count(*)::BIGINT AS n,
       round(avg(coalesce(size_n, 0)), 6) AS avg_size_filled,
       count(DISTINCT coalesce(brand_n, 'unknown'))::BIGINT AS n_brands_filled
FROM d GROUP BY 1
""")
def dropna_split(spark, sf_dir):
    """Complete rows vs rows with a null (one null-count expression), nulls filled per part."""
    p = Tables(spark, sf_dir).part
    d = p.select("p_partkey", F.expr("nullif(p_size, 7)").alias("size_n"),
                 F.expr("nullif(p_brand, 'Brand#3')").alias("brand_n"), "p_retailprice")
    complete = F.col("size_n").isNotNull() & F.col("brand_n").isNotNull()
    return (d.withColumn("complete", complete)
            .na.fill({"size_n": 0, "brand_n": "unknown"})
            .groupBy("complete")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.round(F.avg("size_n"), 6).alias("avg_size_filled"),
                 F.countDistinct("brand_n").alias("n_brands_filled")))


@query("label_binary", rows=("P18",), oracle="""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber,
       (CASE WHEN l_quantity > 25 THEN 1 ELSE -1 END)::BIGINT AS label, l_quantity >= 40 AS is_bulk
FROM lineitem
""")
def label_binary(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return li.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
                     F.when(F.col("l_quantity") > 25, 1).otherwise(-1).cast("bigint").alias("label"),
                     (F.col("l_quantity") >= 40).alias("is_bulk"))


@query("word_doc_count", rows=("P19",), oracle=f"""
WITH toks AS (SELECT DISTINCT doc_id, w AS word FROM
   (SELECT doc_id, unnest(string_split_regex(lower(text), '[ \\t\\r\\n]+')) AS w FROM documents))
SELECT word, count(*)::BIGINT AS n_docs FROM toks JOIN {words_values_sql()} USING (word)
GROUP BY word
""")
def word_doc_count(spark, sf_dir):
    """Per listed word: number of documents with count ≥ 1."""
    docs = Tables(spark, sf_dir).documents
    wl = spark.createDataFrame([(w,) for w in SELECTED_WORDS], "word string")
    wc = word_counts(docs, "doc_id").join(F.broadcast(wl), "word")   # word list: 20 rows
    return wc.groupBy("word").agg(F.count_if(F.col("count") >= 1).cast("bigint").alias("n_docs"))


@query("row_slice", rows=("P20", "P21", "L2"), oracle="""
SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1)::BIGINT AS row_id,
       (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) BETWEEN 100 AND 199 AS in_slice
FROM orders
""")
def row_slice(spark, sf_dir):
    """0-based row number by (o_orderdate, o_orderkey) and the positional slice [100:200]."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderdate")
    idx = R.with_row_index(o, [F.col("o_orderdate"), F.col("o_orderkey")], "row_id")
    return idx.select("o_orderkey", "row_id", F.col("row_id").between(100, 199).alias("in_slice"))


@query("pack_vector", rows=("P22",), oracle="""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey,
       [round(l_quantity / 50.0, 6), round(l_discount * 10 + 0.0, 6), round(l_tax * 10 + 0.0, 6)] AS rgb
FROM lineitem
""")
def pack_vector(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return li.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
                     "l_partkey",
                     F.array(F.round(F.col("l_quantity") / 50.0, 6),
                             F.round(F.col("l_discount") * 10 + 0.0, 6),
                             F.round(F.col("l_tax") * 10 + 0.0, 6)).alias("rgb"))


@query("poly_features", rows=("P24",), oracle="""
SELECT p_partkey, round(x, 6) AS power_1, round(x * x, 6) AS power_2, round(x * x * x, 6) AS power_3
FROM (SELECT p_partkey, p_size / 50.0 AS x FROM part)
""")
def poly_features(spark, sf_dir):
    from tessera.operators.linear import poly_columns
    p = Tables(spark, sf_dir).part.select("p_partkey", (F.col("p_size") / 50.0).alias("x"))
    return p.select("p_partkey", *[F.round(c, 6).alias(f"power_{i}")
                                   for i, c in enumerate(poly_columns("x", 3), start=1)])


@query("onehot_unpack", rows=("P10", "P17", "P23"), oracle="""
SELECT o_orderkey,
  (o_orderpriority = '1-URGENT')::BIGINT AS o_orderpriority_1_URGENT,
  (o_orderpriority = '2-HIGH')::BIGINT AS o_orderpriority_2_HIGH,
  (o_orderpriority = '3-MEDIUM')::BIGINT AS o_orderpriority_3_MEDIUM,
  (o_orderpriority = '4-NOT SPECIFIED')::BIGINT AS o_orderpriority_4_NOT_SPECIFIED,
  (o_orderpriority = '5-LOW')::BIGINT AS o_orderpriority_5_LOW,
  coalesce((nullif(o_orderstatus, 'P') = 'F')::BIGINT, 0) AS o_orderstatus_F,
  coalesce((nullif(o_orderstatus, 'P') = 'O')::BIGINT, 0) AS o_orderstatus_O
FROM orders
""")
def onehot_unpack(spark, sf_dir):
    """Category → {value: 1} → one 0/1 column per value named prefix_value; nulls filled with 0."""
    o = Tables(spark, sf_dir).orders.withColumn("status_n", F.expr("nullif(o_orderstatus, 'P')"))
    prios = R.distinct_values(o, "o_orderpriority")
    stats = R.distinct_values(o, "status_n")
    return o.select("o_orderkey", *R.onehot_columns(o, "o_orderpriority", prios),
                    *R.onehot_columns(o, "status_n", stats, prefix="o_orderstatus"))


@query("feature_matrix", rows=("S7", "P6"), oracle="""
SELECT p_partkey, [1.0, p_size::DOUBLE, p_retailprice] AS features, p_retailprice AS target FROM part
""")
def feature_matrix(spark, sf_dir):
    from tessera.operators.linear import feature_array
    p = Tables(spark, sf_dir).part
    return p.select("p_partkey", feature_array(["p_size", "p_retailprice"], constant=True)
                    .alias("features"), F.col("p_retailprice").alias("target"))


@query("group_avg", rows=("A1",), oracle="""
SELECT o_orderpriority, round(avg(o_totalprice), 6) AS avg_price FROM orders GROUP BY 1
""")
def group_avg(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.groupBy("o_orderpriority").agg(F.round(F.avg("o_totalprice"), 6).alias("avg_price"))


@query("group_sum_sorted", rows=("A2", "L1", "D7"), oracle="""
SELECT p_brand, total_qty, (row_number() OVER (ORDER BY total_qty DESC, p_brand))::BIGINT AS rank_desc,
       (row_number() OVER (ORDER BY total_qty, p_brand))::BIGINT AS rank_asc
FROM (SELECT p_brand, sum(l_quantity::BIGINT)::BIGINT AS total_qty
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand)
""")
def group_sum_sorted(spark, sf_dir):
    """Play totals per 'artist' (quantity per brand), ranked both directions."""
    t = Tables(spark, sf_dir)
    s = (t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
         .groupBy("p_brand").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("total_qty")))
    down = R.ranked(s, [F.desc("total_qty"), F.col("p_brand")], "rank_desc")
    both = R.ranked(down, [F.col("total_qty"), F.col("p_brand")], "rank_asc")
    return both.orderBy(F.desc("total_qty"), "p_brand")


@query("column_stats", rows=("A4",), oracle="""
SELECT sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS sum_cents, count(*)::BIGINT AS n,
       round(avg(l_extendedprice), 6) AS mean, max(l_extendedprice) AS max_price,
       min(l_extendedprice) AS min_price, round(stddev_pop(l_extendedprice), 4) AS std_pop,
       round(var_pop(l_quantity), 6) AS var_qty
FROM lineitem
""")
def column_stats(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return li.agg(F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("sum_cents"),
                  F.count(F.lit(1)).alias("n"),
                  F.round(F.avg("l_extendedprice"), 6).alias("mean"),
                  F.max("l_extendedprice").alias("max_price"),
                  F.min("l_extendedprice").alias("min_price"),
                  F.round(F.stddev_pop("l_extendedprice"), 4).alias("std_pop"),
                  F.round(F.var_pop("l_quantity"), 6).alias("var_qty"))


@query("distinct_users", rows=("A5", "U2", "D7"), oracle="""
SELECT p_brand, count(DISTINCT o_custkey)::BIGINT AS n_customers,
       count(DISTINCT CASE WHEN l_quantity > 40 THEN o_custkey END)::BIGINT AS n_customers_bulk
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
GROUP BY p_brand
""")
def distinct_users(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(t.part, F.col("l_partkey") == F.col("p_partkey")))
    # distinct (brand, customer) pairs first: a partial dedup before the final count
    pairs = j.select("p_brand", "o_custkey", (F.col("l_quantity") > 40).alias("bulk")) \
        .groupBy("p_brand", "o_custkey").agg(F.max(F.col("bulk").cast("int")).alias("bulk"))
    return pairs.groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.sum("bulk").cast("bigint").alias("n_customers_bulk"))


@query("value_counts", rows=("A7",), oracle="""
SELECT o_orderpriority AS value, count(*)::BIGINT AS n,
       round(count(*) / (SELECT count(*) FROM orders)::DOUBLE, 6) AS share
FROM orders GROUP BY 1
""")
def value_counts(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    c = o.groupBy(F.col("o_orderpriority").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = o.agg(F.count(F.lit(1)).alias("total"))          # one row
    return (c.withColumn("_one", F.lit(1)).join(F.broadcast(total.withColumn("_one", F.lit(1))), "_one")
            .select("value", "n", F.round(F.col("n") / F.col("total"), 6).alias("share")))


@query("class_balance", rows=("A10",), oracle="""
SELECT count(*)::BIGINT AS n, count_if(quality = 1)::BIGINT AS n_quality,
       round(avg(CASE WHEN quality = 1 THEN 1.0 ELSE 0.0 END), 6) AS share_quality,
       count_if(toxic = 1)::BIGINT AS n_toxic,
       round(avg(CASE WHEN toxic = 1 THEN 1.0 ELSE 0.0 END), 6) AS share_toxic
FROM labels
""")
def class_balance(spark, sf_dir):
    lb = Tables(spark, sf_dir).labels
    return lb.agg(F.count(F.lit(1)).alias("n"),
                  F.count_if(F.col("quality") == 1).alias("n_quality"),
                  F.round(F.avg((F.col("quality") == 1).cast("double")), 6).alias("share_quality"),
                  F.count_if(F.col("toxic") == 1).alias("n_toxic"),
                  F.round(F.avg((F.col("toxic") == 1).cast("double")), 6).alias("share_toxic"))


@query("grouped_quartiles", rows=("A17",), oracle="""
SELECT o_orderpriority, round(quantile_cont(o_totalprice, 0.25), 6) AS q1,
       round(quantile_cont(o_totalprice, 0.5), 6) AS median,
       round(quantile_cont(o_totalprice, 0.75), 6) AS q3,
       min(o_totalprice) AS lo, max(o_totalprice) AS hi
FROM orders GROUP BY 1
""")
def grouped_quartiles(spark, sf_dir):
    """Box-plot numbers per group; exact quantiles without gathering a group into one task."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    q = grouped_quantiles(o, "o_orderpriority", "o_totalprice", "o_orderkey",
                          {"q1": 0.25, "median": 0.5, "q3": 0.75, "lo": 0.0, "hi": 1.0})
    return q.select("o_orderpriority", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")],
                    "lo", "hi")


@query("length_histogram", rows=("A17", "N13"), oracle="""
WITH nb AS (
  SELECT doc_id FROM (
    WITH dw AS (SELECT doc_id, w AS word, count(*) AS cnt FROM
                (SELECT doc_id, unnest(string_split_regex(lower(text), '[ \\t\\r\\n]+')) AS w FROM documents)
                WHERE w <> '' GROUP BY 1, 2),
    idf AS (SELECT word, ln((SELECT count(*) FROM documents)::DOUBLE / count(*)) AS idf FROM dw
            GROUP BY word HAVING count(*) < (SELECT count(*) FROM documents)),
    dt AS (SELECT doc_id, word, cnt * idf AS w FROM dw JOIN idf USING (word)),
    qw AS (SELECT item_id, w AS word, count(*) AS cnt FROM
           (SELECT item_id, unnest(string_split_regex(lower(text), '[ \\t\\r\\n]+')) AS w FROM benchmark)
           WHERE w <> '' GROUP BY 1, 2),
    qt AS (SELECT item_id, word, cnt * idf AS w FROM qw JOIN idf USING (word)),
    qn AS (SELECT item_id, sqrt(sum(w * w)) AS nrm FROM qt GROUP BY 1),
    dn AS (SELECT doc_id, sqrt(sum(w * w)) AS nrm FROM dt GROUP BY 1),
    sc AS (SELECT item_id, doc_id, 1 - sum(qt.w * dt.w) / (any_value(qn.nrm) * any_value(dn.nrm)) AS dist
           FROM qt JOIN dt USING (word) JOIN qn USING (item_id) JOIN dn USING (doc_id)
           GROUP BY item_id, doc_id)
    SELECT doc_id, row_number() OVER (PARTITION BY item_id ORDER BY round(dist, 9), doc_id) AS rk FROM sc
  ) WHERE rk <= 5),
corpus AS (SELECT (n_chars // 1000)::BIGINT AS bucket, count(*)::BIGINT AS n_corpus FROM documents GROUP BY 1),
nbh AS (SELECT (n_chars // 1000)::BIGINT AS bucket, count(*)::BIGINT AS n_neighbours
        FROM nb JOIN documents USING (doc_id) GROUP BY 1)
SELECT bucket, n_corpus, coalesce(n_neighbours, 0)::BIGINT AS n_neighbours
FROM corpus LEFT JOIN nbh USING (bucket)
""")
def length_histogram(spark, sf_dir):
    """Length histogram (1000-char bins) of the corpus and of the retrieved neighbours."""
    from tessera.plans.text_queries import benchmark_tfidf_neighbours
    docs = Tables(spark, sf_dir).documents.select("doc_id", "n_chars")
    b = F.floor(F.col("n_chars") / 1000).cast("bigint").alias("bucket")
    corpus = docs.groupBy(b).agg(F.count(F.lit(1)).alias("n_corpus"))
    nb = benchmark_tfidf_neighbours(spark, sf_dir).select("doc_id").join(docs, "doc_id")
    nbh = nb.groupBy(b).agg(F.count(F.lit(1)).alias("n_neighbours"))
    return (corpus.join(nbh, "bucket", "left")
            .select("bucket", "n_corpus", F.coalesce("n_neighbours", F.lit(0)).cast("bigint")
                    .alias("n_neighbours")))


@query("head_tail", rows=("L3",), oracle="""
(SELECT o_orderkey, o_totalprice, 'head' AS part FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5)
UNION ALL
(SELECT o_orderkey, o_totalprice, 'tail' AS part FROM orders ORDER BY o_totalprice ASC, o_orderkey LIMIT 5)
""")
def head_tail(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_totalprice")
    head = o.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5).withColumn("part", F.lit("head"))
    tail = o.orderBy("o_totalprice", "o_orderkey").limit(5).withColumn("part", F.lit("tail"))
    return head.unionByName(tail)


@query("sample_n", rows=("X6",), oracle=f"""
SELECT p_partkey FROM part ORDER BY {sql_hash32('p_partkey', 7)}, p_partkey LIMIT 20
""")
def sample_n(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select("p_partkey")
    return S.sample_n(p, "p_partkey", 20, seed=7)


@query("hash_split", rows=("X1",), oracle=f"""
SELECT p_partkey, CASE WHEN {sql_hash32('p_partkey', 1)} % 1000 < 800 THEN 'train' ELSE 'test' END AS split
FROM part
""")
def hash_split(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select("p_partkey")
    return S.hash_split(p, "p_partkey", 0.8, seed=1)


@query("hash_split_nested", rows=("X2",), oracle=f"""
SELECT p_partkey,
  CASE WHEN {sql_hash32('p_partkey', 5)} % 1000 < 500 THEN 'train'
       WHEN {sql_hash32('p_partkey', 6)} % 1000 < 500 THEN 'validation'
       WHEN {sql_hash32('p_partkey', 7)} % 1000 < 500 THEN 'test'
       ELSE 'holdout' END AS split
FROM part
""")
def hash_split_nested(spark, sf_dir):
    """4-way nested split: half train, half of the rest validation, half of that test."""
    p = Tables(spark, sf_dir).part.select("p_partkey")
    return S.hash_split_nested(p, "p_partkey", [0.5, 0.5, 0.5], seed=5,
                               names=["train", "validation", "test", "holdout"])


@query("kfold_assign", rows=("W4", "U4", "X5"), oracle=f"""
WITH s AS (SELECT p_partkey, (row_number() OVER (ORDER BY {sql_hash32('p_partkey', 3)}, p_partkey) - 1)
                  AS pos FROM part),
n AS (SELECT count(*) AS n FROM part)
SELECT p_partkey, pos::BIGINT AS pos, ((pos * 10 + 9) // n)::BIGINT AS fold FROM s, n
""")
def kfold_assign(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select("p_partkey")
    return S.kfold_assign(p, "p_partkey", k=10, seed=3)


@query("balance_classes", rows=("U1", "X3", "X4"), oracle=f"""
WITH c AS (SELECT count_if(quality = 0)::DOUBLE / count_if(quality = 1) AS ratio FROM labels)
SELECT doc_id, quality::BIGINT AS quality FROM labels, c
WHERE quality = 0 OR {sql_uniform('doc_id', 11)} < ratio
""")
def balance_classes(spark, sf_dir):
    """Undersample the majority class (quality = 1) to the minority's size share."""
    lb = Tables(spark, sf_dir).labels.select("doc_id", F.col("quality").cast("bigint"))
    return S.undersample_majority(lb, "doc_id", "quality", seed=11)


@query("moving_average", rows=("W2", "C18"), oracle="""
SELECT event_id, round(ma, 6) AS moving_avg FROM (
  SELECT event_id, avg(value) OVER (ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS ma,
         row_number() OVER (ORDER BY ts, event_id) AS rn FROM events)
WHERE rn >= 10
""")
def moving_average(spark, sf_dir):
    """10-row moving average of event value along (ts, event_id), full windows only: window
    frames inside blocks of consecutive rows (no global prefix sums, no self-join)."""
    ev = Tables(spark, sf_dir).events.select("event_id", "ts", "value")
    out = R.rolling_mean(ev, [F.col("ts"), F.col("event_id")], "value", 10, "ma")
    return out.select("event_id", F.round("ma", 6).alias("moving_avg"))
