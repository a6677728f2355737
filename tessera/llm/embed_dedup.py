"""Near duplicates among embedding vectors: sign hashing, exact cosine, components.

Vectors with the same components are one class, found by grouping on a digest. A signature
of ``bits`` random-hyperplane signs in each of several tables puts the classes in buckets;
inside a bucket every pair is compared by its exact cosine in double precision, in cells of
bounded size (``cells``). The number of bits follows the logarithm of the number of classes,
so buckets keep their size as the table grows; the number of tables follows from the bits
and the recall asked for at exactly the threshold (closer pairs are found more surely).
A pair that meets in several tables counts in the first one.

Defined results: vectors that are null or zero, or hold null or non-finite components, link
with nothing; vectors of different lengths don't link; repeated rows link like any others;
a row without id is judged too, but no component is named by it. Empty table: empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.cells import Links, bounds, cells_of, dealt, lists_of
from tessera.llm.common import discard, materialise, sorted_groups
from tessera.llm.components import connected_components

THRESHOLD = 0.95
RECALL = 0.995      # of pairs at exactly the threshold
BUCKET = 8          # classes in a bucket, on average
BLOCK = 512         # members of a block of a large bucket
SEED = 7

SIGNED = "member bigint, size bigint, vec array<double>, sig array<int>"


def tables_for(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """Bits of a signature and number of tables for ``n`` classes."""
    bits = min(30, max(6, math.ceil(math.log2(max(2, n / BUCKET)))))
    p = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - p)))


def _classes(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """All rows with ``_class``: a digest of the components, null where the vector links with nothing."""
    v = F.transform("emb", lambda x: x.cast("double") + F.lit(0.0))  # -0.0 becomes 0.0
    usable = (F.col("vec").isNotNull() & (F.size("vec") > 0)
              & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists("vec", lambda x: x != 0))
    return (vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("emb")).withColumn("vec", v)
            .select("vec_id", F.when(usable, F.md5(F.to_json(F.struct("vec")).cast("binary"))).alias("_class"),
                    F.when(usable, F.col("vec")).alias("vec")))


def _signatures(bits: int, tables: int):
    def run(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            vec = batch.column("vec")
            lens = np.diff(vec.offsets.to_numpy())
            flat = vec.flatten().to_numpy()
            starts = np.concatenate([[0], np.cumsum(lens)])[:-1]
            sig = np.zeros((batch.num_rows, tables), dtype=np.int32)
            for d in np.unique(lens):
                if d not in planes:
                    planes[d] = np.random.default_rng([SEED, int(d)]).standard_normal((int(d), bits * tables))
                rows = np.flatnonzero(lens == d)
                m = flat[starts[rows][:, None] + np.arange(d)]
                signs = (m / np.abs(m).max(axis=1, keepdims=True)) @ planes[d] >= 0
                signs = signs.reshape(len(rows), tables, bits)
                sig[rows] = (signs * (1 << np.arange(bits))).sum(axis=2)
            out = pa.ListArray.from_arrays(pa.array(np.arange(0, sig.size + 1, tables, dtype=np.int32)),
                                           pa.array(sig.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("member"), batch.column("size"), vec, out],
                                             ["member", "size", "vec", "sig"])
    return run


def _links(threshold: float):
    """Cells → per member the number of vectors linked, counted in this cell, and a link to
    the first member of its group within the cell."""
    def run(batches):
        for t in sorted_groups(batches, ["cell"]):
            member, size, side, number = (t.column(c).to_numpy() for c in ("member", "size", "side", "number"))
            vals, at = lists_of(t, "vec")
            sigs, _ = lists_of(t, "sig")
            sigs = sigs.reshape(len(member), -1)
            links = Links()
            for lo, hi in bounds(t.column("cell").to_numpy()):
                d = int(at[lo + 1] - at[lo])
                m = vals[at[lo]:at[hi]].astype(np.float64).reshape(hi - lo, d)
                m = m / np.abs(m).max(axis=1, keepdims=True)
                m = m / np.sqrt((m * m).sum(axis=1, keepdims=True))
                i, j = np.nonzero(np.triu(m @ m.T >= threshold - 1e-9, 1))
                s = side[lo:hi]
                if s.min() != s.max():
                    ok = s[i] != s[j]
                    i, j = i[ok], j[ok]
                # the row-wise product decides at the threshold itself
                ok = (m[i] * m[j]).sum(axis=1) >= threshold
                i, j = i[ok], j[ok]
                k = int(number[lo])
                ok = ~(sigs[lo + i, :k] == sigs[lo + j, :k]).any(axis=1)
                links.add(member[lo:hi], size[lo:hi], i[ok], j[ok])
            out = links.batch()
            if out is not None:
                yield out
    return run


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                    threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept, class_id (smallest id with
    the same components)."""
    rows = _classes(vectors, vec_id, embedding)
    classes = (rows.where("_class is not null").groupBy("_class")
               .agg(F.count(F.lit(1)).alias("size"), F.min("vec_id").alias("class_id"), F.first("vec").alias("vec")))
    # the number names the class from here on: written once, it can't change
    classes = materialise(classes.withColumn("member", F.monotonically_increasing_id()), "classes")
    bits, tables = tables_for(classes.count(), threshold, recall)
    signed = materialise(classes.select("member", "size", "vec").mapInArrow(_signatures(bits, tables), SIGNED), "signatures")
    keyed = (signed.select("member", F.size("vec").alias("_d"), F.posexplode("sig").alias("number", "_sig"))
             .select("member", "number", F.concat_ws("/", "_d", "number", "_sig").alias("key")))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    cells = F.transform(cells_of(F.col("key"), F.col("member"), F.col("n"), BLOCK),
                        lambda c: F.struct(c["cell"].alias("cell"), c["side"].alias("side"), F.col("number").alias("number")))
    members = keyed.join(sizes, "key").groupBy("member").agg(F.flatten(F.collect_list(cells)).alias("_cells"))
    found = materialise(dealt(members, signed, "member").mapInArrow(_links(threshold), "member bigint, linked bigint, other bigint"),
                        "links")
    discard(signed)
    comp = connected_components(found, "member", "other")
    linked = found.groupBy("member").agg(F.sum("linked").alias("linked"))
    full = (classes.drop("vec").join(linked, "member", "left").join(comp.withColumnRenamed("node", "member"), "member", "left")
            .withColumn("component", F.coalesce("component", "member")))
    first = full.groupBy("component").agg(F.min("class_id").alias("component_id"))
    full = full.join(first, "component").select(
        "_class", "class_id", "component_id", (F.col("size") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    out = rows.select("vec_id", "_class").join(full, "_class", "left")
    comp_id = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      comp_id.alias("component_id"), (F.col("vec_id") == comp_id).alias("kept"),
                      F.coalesce("class_id", "vec_id").alias("class_id"))
