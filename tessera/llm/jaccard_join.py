"""Similarity join of texts by the Jaccard index of their word shingles: chosen paths.

A text is the set of its runs of ``SHINGLE`` words (a shorter text is one run). Texts with
the same set are one class, found by grouping on a digest. In each run every class chooses
each of its tokens t with probability 1 / (LAMBDA * size), by a hash that all classes share,
and goes to the bucket of each chosen token; two classes at the threshold expect to choose a
common token in every run, so ``runs`` follows from the recall asked for. Buckets with one
member need no more, small ones are compared by brute force, and large ones are split again
by further chosen tokens (the path), each as a try of its own, also where others have the same
members. A large bucket whose members mostly stay together in large children, or choose few
children as their common tokens were not drawn, is a group of near copies and is compared as it
is; so is what is still large at the last level. Comparison is exact and goes in cells of
bounded size (``cells``): no pair ever is a row, and a pair that meets in several buckets
counts in the first one.

Recursion handles numbers of classes and hashes only; sets are computed once for the classes
that share a bucket with another one.

Defined results: null and empty texts and texts without a word have no set and link with
nothing; a text of fewer words than a shingle links with texts of the same words only;
repeated rows are copies of one another; rows without id take part, but name no class or
component; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.cells import Links, bounds, cells_of, dealt, lists_of
from tessera.llm.common import (ALNUM_WORD, Texts, discard, list_array, materialise, mix64, release_shuffles, shingle_hashes,
                                sorted_groups, word_hashes, word_spans, small)
from tessera.llm.components import connected_components

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9995          # of pairs at exactly the threshold, over all runs
SPLIT = 1.5              # expected common tokens of such a pair at each further level
SMALL = 64               # classes that are compared without further splits
TOGETHER = 0.7           # near copies: the others of a bucket's paths, or of those expected, leave large children
LEVELS = 5
BLOCK = 512


def runs_for(recall: float) -> int:
    """Runs, each with one expected common token, that miss a pair with at most 1 - recall."""
    return max(1, math.ceil(-math.log(1 - recall)))


def token_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document."""
    starts, stops, _ = word_spans(data, offsets, ALNUM_WORD)
    words = word_hashes(data, starts, stops)
    first = np.searchsorted(starts, offsets)
    full = shingle_hashes(words, k)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(full[a:b - k + 1]))
        elif b > a:
            out.append(shingle_hashes(words[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(words[:0])
    return out


def _digest(tokens: np.ndarray) -> str | None:
    return blake2b(tokens.tobytes(), digest_size=16).hexdigest() if len(tokens) else None


def _limit(size: int, times: float, threshold: float) -> np.uint64:
    return np.uint64(min(2**64 - 1, int(2**64 * min(1.0, times / (threshold * size)))))


def chosen(tokens: np.ndarray, path: int, times: float, threshold: float) -> np.ndarray:
    """Keys of the children that a set chooses below a path."""
    h = mix64(tokens ^ mix64(np.array([path], dtype=np.uint64)))
    limit = _limit(len(tokens), times, threshold)
    return mix64(h[h <= limit] + np.uint64(0x5851F42D4C957F2D))


def _sketches(k: int, runs: int, threshold: float):
    def rows(batches):
        for batch in small(batches):
            texts = Texts(batch.column("text"))
            digests, counts, keys = [], [], []
            for i, j in texts.slices():
                for s in token_sets(*texts.part(i, j), k):
                    digests.append(_digest(s))
                    own = [chosen(s, r, 1.0, threshold) for r in range(1, runs + 1)] if len(s) else []
                    counts.append(sum(map(len, own)))
                    keys.extend(own)
            if digests:
                flat = np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(digests, type=pa.string()),
                     list_array(flat.view(np.int64), np.array(counts), pa.int64())], ["doc_id", "digest", "keys"])
    return rows


def _sets(k: int):
    def rows(batches):
        for batch in small(batches):
            texts = Texts(batch.column("text"))
            digest, number = batch.column("digest").to_pylist(), batch.column("member").to_numpy()
            own, counts, tokens = [], [], []
            for i, j in texts.slices():
                for n, s in enumerate(token_sets(*texts.part(i, j), k), start=i):
                    if _digest(s) == digest[n]:      # another row may have the same id
                        own.append(n)
                        counts.append(len(s))
                        tokens.append(s)
            if own:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number[own]), list_array(np.concatenate(tokens).view(np.int64), np.array(counts), pa.int64()),
                     batch.column("paths").take(pa.array(own))], ["member", "tokens", "paths"])
    return rows


def _children(threshold: float):
    """Members of large buckets with their sets → the buckets they choose below these."""
    def rows(batches):
        for batch in batches:
            member = batch.column("member").to_numpy()
            table = pa.Table.from_batches([batch])
            tokens, at = lists_of(table, "tokens")
            paths, of = lists_of(table, "paths")
            ids, parents, keys = [], [], []
            for r in range(len(member)):
                s = tokens[at[r]:at[r + 1]].view(np.uint64)
                for p in paths[of[r]:of[r + 1]].tolist():
                    c = chosen(s, p & (2**64 - 1), SPLIT, threshold)
                    ids.append(np.full(len(c), member[r]))
                    parents.append(np.full(len(c), p))
                    keys.append(c)
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(ids)), pa.array(np.concatenate(parents)),
                     pa.array(np.concatenate(keys).view(np.int64))], ["member", "parent", "key"])
    return rows


def _links(threshold: float):
    """Cells → what they link (exact). A pair that shares a smaller key counts there."""
    def rows(batches):
        for t in sorted_groups(batches, ["cell"]):
            member, copies, side, key = (t.column(c).to_numpy() for c in ("member", "copies", "side", "key"))
            tokens, at = lists_of(t, "tokens")
            keys, of = lists_of(t, "keys")
            links = Links()
            for lo, hi in bounds(t.column("cell").to_numpy()):
                n = hi - lo
                size = np.diff(at[lo:hi + 1])
                row = np.repeat(np.arange(n), size)
                _, which, count = np.unique(tokens[at[lo]:at[hi]], return_inverse=True, return_counts=True)
                several = count[which] > 1
                column = np.cumsum(count > 1)[which[several]] - 1
                row = row[several]
                width = int((count > 1).sum())
                common = np.zeros((n, n), dtype=np.float32)
                for c in range(0, width, 4096):
                    part = (column >= c) & (column < c + 4096)
                    m = np.zeros((n, min(4096, width - c)), dtype=np.float32)
                    m[row[part], column[part] - c] = 1
                    common += m @ m.T
                i, j = np.nonzero(np.triu(common, 1))
                got = common[i, j].astype(np.float64)
                ok = got / (size[i] + size[j] - got) >= threshold
                s = side[lo:hi]
                if s.min() != s.max():
                    ok &= s[i] != s[j]
                i, j = i[ok], j[ok]
                if len(i):
                    # smaller keys of the members: pairs that share one were counted there
                    k = keys[of[lo]:of[hi]]
                    owner = np.repeat(np.arange(n), np.diff(of[lo:hi + 1]))
                    less = k < key[lo]
                    if less.any():
                        names, pos = np.unique(k[less], return_inverse=True)
                        seen = np.zeros((n, len(names)), dtype=np.float32)
                        seen[owner[less], pos] = 1
                        new = (seen @ seen.T)[i, j] == 0
                        i, j = i[new], j[new]
                links.add(member[lo:hi], copies[lo:hi], i, j)
            out = links.batch()
            if out is not None:
                yield out
    return rows


def _sizes(rows: DataFrame) -> DataFrame:
    """Members of each bucket: their number and a digest of who they are."""
    return rows.groupBy("parent", "key").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("member")).alias("x"),
        F.bit_xor(F.xxhash64("member", F.lit(1))).alias("y"))


def _distinct(buckets: DataFrame) -> DataFrame:
    """Buckets of several members; small ones with the same members are compared once. Large
    ones are split by chance, so each is a try of its own."""
    return (buckets.where("n > 1").groupBy("n", "x", "y", F.when(F.col("n") > SMALL, F.col("key")).alias("_own"))
            .agg(F.min(F.struct("key", "parent")).alias("b")).select("b.*", "n"))


def _once(leaves: DataFrame) -> DataFrame:
    """(member, key, n) of large buckets that are compared as they are: one of those with the
    same members."""
    same = _sizes(leaves.withColumn("parent", F.lit(0))).groupBy("n", "x", "y").agg(F.min("key").alias("key"))
    return leaves.join(same.select("key"), "key", "left_semi").select("member", "key", "n")


def _leaves(inside: DataFrame, sets: DataFrame, threshold: float, scratch: list[DataFrame]) -> DataFrame:
    """(member, key, n) of all buckets to compare. ``inside``: (member, key, n) of the first
    level; ``sets``: (member, tokens, paths), paths being the member's large buckets of the
    first level; ``scratch`` takes the tables that the result reads."""
    def keep(df: DataFrame, name: str) -> DataFrame:
        scratch.append(materialise(df, name))
        return scratch[-1]

    done, whole = [inside.where(F.col("n") <= SMALL)], []
    inside = inside.where(F.col("n") > SMALL)
    split = sets.where(F.size("paths") > 0)
    for level in range(LEVELS):
        if inside.isEmpty():
            break
        if level == LEVELS - 1:
            whole.append(inside)
            break
        below = keep(split.mapInArrow(_children(threshold), "member bigint, parent bigint, key bigint"), "children")
        children = keep(_sizes(below), "buckets")
        together = (children.groupBy("parent").agg(
            F.sum("n").alias("all"), F.sum(F.when(F.col("n") <= SMALL, F.col("n")).otherwise(0)).alias("apart"))
            .withColumnRenamed("parent", "key"))
        # common tokens that none chose are missing from "all": the expected number stands in
        paths = F.greatest(F.coalesce("all", F.lit(0)), F.col("n") * F.lit(SPLIT / threshold))
        judged = keep(inside.select("key", "n").distinct().join(together, "key", "left")
                      .select("key", (F.coalesce("apart", F.lit(0)) <= (1 - TOGETHER) * paths).alias("copies")), "judged")
        whole.append(inside.join(judged.where("copies").select("key"), "key", "left_semi").select("member", "key", "n"))
        buckets = keep(_distinct(children.join(judged.where("not copies").select(F.col("key").alias("parent")),
                                               "parent", "left_semi")), "buckets")
        found = keep(below.join(buckets, ["parent", "key"]).select("member", "key", "n"), "inside")
        done.append(found.where(F.col("n") <= SMALL))
        inside = found.where(F.col("n") > SMALL)
        paths = inside.groupBy("member").agg(F.collect_list("key").alias("paths"))
        split = split.drop("paths").join(paths, "member").select("member", "tokens", "paths")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    if whole:
        large = whole[0]
        for d in whole[1:]:
            large = large.unionByName(d)
        out = out.unionByName(_once(large))
    return out


def similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
            threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per document: doc_id, n_links (other documents at the threshold), component_id
    (smallest id reachable), kept (doc_id = component_id), class_id (smallest id with the same
    set), digest (of the set; null without words)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    runs = runs_for(recall)
    sketches = materialise(rows.mapInArrow(_sketches(shingle, runs, threshold), T.StructType([
        rows.schema["doc_id"], T.StructField("digest", T.StringType()), T.StructField("keys", T.ArrayType(T.LongType()))])), "sketches")
    # the number names the class from here on: written once, it can't change
    classes = materialise(sketches.where("digest is not null").groupBy("digest")
                          .agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("class_id"), F.first("keys").alias("keys"))
                          .withColumn("member", F.monotonically_increasing_id()), "classes")
    first = classes.select("member", F.explode(F.array_distinct("keys")).alias("key"))
    first = first.withColumn("parent", F.lit(0).cast("bigint"))
    inside = materialise(first.join(_distinct(_sizes(first)), ["parent", "key"]).select("member", "key", "n"), "inside")
    paths = inside.groupBy("member").agg(F.collect_list(F.when(F.col("n") > SMALL, F.col("key"))).alias("paths"))
    wanted = classes.join(paths, "member").select("member", "digest", "class_id", "paths")
    by_id = rows.join(wanted, rows["doc_id"] == wanted["class_id"])
    vague = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null").select(F.col("doc_id").alias("vague"))
    if not vague.isEmpty():
        # an id that several rows have, or none, names no text: these rows meet their class by digest
        several = rows.join(vague, F.col("doc_id").eqNullSafe(F.col("vague")), "left_semi")
        tagged = several.select("text").mapInArrow(_tagged(shingle, ["text"]), "text string, digest string").dropDuplicates(["digest"])
        theirs = wanted.join(vague, F.col("class_id").eqNullSafe(F.col("vague")), "left_semi")
        columns = ["text", "digest", "member", "paths"]
        by_id = (by_id.join(vague, F.col("doc_id") == F.col("vague"), "left_anti").select(columns)
                 .unionByName(tagged.join(theirs, "digest").select(columns)))
    found = by_id.select("text", "digest", "member", "paths")
    sets = materialise(found.mapInArrow(_sets(shingle), "member bigint, tokens array<bigint>, paths array<bigint>"), "sets")
    release_shuffles(spark)
    scratch: list[DataFrame] = []
    leaves = materialise(_leaves(inside, sets, threshold, scratch), "leaves")
    discard(inside, *scratch)
    release_shuffles(spark)
    per_member = leaves.withColumn("_c", cells_of(F.col("key"), F.col("member"), F.col("n"), BLOCK)).groupBy("member").agg(
        F.sort_array(F.collect_set("key")).alias("keys"),
        F.flatten(F.collect_list(F.transform("_c", lambda c: F.struct(
            c["cell"].alias("cell"), c["side"].alias("side"), F.col("key").alias("key"))))).alias("_cells"))
    payload = sets.drop("paths").join(classes.select("member", "copies"), "member")
    links = materialise(dealt(per_member, payload, "member").mapInArrow(_links(threshold), "member bigint, linked bigint, other bigint"), "links")
    discard(sets, leaves)
    comp = connected_components(links, "member", "other")
    linked = links.groupBy("member").agg(F.sum("linked").alias("linked"))
    full = (classes.drop("keys").join(linked, "member", "left").join(comp.withColumnRenamed("node", "member"), "member", "left")
            .withColumn("component", F.coalesce("component", "member")))
    least = full.groupBy("component").agg(F.min("class_id").alias("component_id"))
    full = full.join(least, "component").select(
        "digest", "class_id", "component_id", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    comp_id = F.coalesce("component_id", "doc_id")
    return (sketches.select("doc_id", "digest").join(full, "digest", "left").select(
        "doc_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), comp_id.alias("component_id"),
        F.col("doc_id").eqNullSafe(comp_id).alias("kept"), F.coalesce("class_id", "doc_id").alias("class_id"), "digest"))


def _tagged(k: int, names: list[str]):
    def rows(batches):
        for batch in small(batches):
            texts = Texts(batch.column("text"))
            digests = [_digest(s) for i, j in texts.slices() for s in token_sets(*texts.part(i, j), k)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(digests, type=pa.string())],
                                             [*names, "digest"])
    return rows


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs`` without those whose component has a smaller id: one document of
    each component stays. Of repeated rows one stays; in a component without any id, one row
    of each set of shingles."""
    found = similar(docs, doc_id, text, shingle, threshold, recall)
    repeated = docs.groupBy(doc_id).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if repeated.isEmpty():
        kept = found.where("kept").select(F.col("doc_id").alias("_kept"))
        return docs.join(kept, docs[doc_id].eqNullSafe(kept["_kept"]), "left_semi")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"))
    schema = T.StructType([rows.schema["doc_id"], rows.schema["row"], T.StructField("digest", T.StringType())])
    tagged = rows.mapInArrow(_tagged(shingle, ["doc_id", "row"]), schema)
    kept = found.where("kept").select(F.col("doc_id").alias("_kept"), F.col("digest").alias("_of")).distinct()
    stay = tagged.join(kept, F.col("doc_id").eqNullSafe(F.col("_kept")) & F.col("digest").eqNullSafe(F.col("_of")), "left_semi")
    one = stay.where("digest is not null").dropDuplicates(["doc_id", "digest"])
    return one.unionByName(stay.where("digest is null")).select("row.*")
