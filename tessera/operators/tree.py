"""Binary-feature decision trees by classification error, built level by level.

Every depth costs one distributed aggregation: for each open node, the (weighted)
label totals on both sides of every candidate feature — 4·d conditional sums per
node, partially aggregated map-side, so the driver receives only
open-nodes × 4·d numbers. A row's node id is never stored and updated: it is
recomputed from the tree so far as one closed-form expression (the lineage
does not grow with depth): a nested CASE, one test per level.

Rules (unweighted): leaf when the node has no mistakes, no unused features, depth ≥
max_depth, n ≤ min_node_size, the best split reduces the error by ≤
min_error_reduction, or a side of the best split is empty. Leaf = majority, tie → −1.
Weighted: mistakes ≤ 1e-15 ends a node, leaf = weighted majority, tie → +1.
Best feature: fewest (weighted) mistakes after the split; first feature wins ties.
Children of node k are 2k (feature = 0) and 2k + 1 (feature = 1).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Node:
    id: int
    depth: int
    p: float                # (weighted) count of +1 labels
    q: float                # (weighted) count of −1 labels
    feature: int | None = None
    prediction: int | None = None

    @property
    def n(self) -> float:
        return self.p + self.q

    @property
    def mistakes(self) -> float:
        return min(self.p, self.q)


def _descend(tree: dict[int, Node], features: list[str], leaf, k: int = 1) -> Column:
    """Nested CASE from node ``k`` down: one test per level of a row's path, an expression
    linear in the nodes. ``leaf``: value of a node that is not split (a Column)."""
    nd = tree.get(k)
    if nd is None or nd.feature is None:
        return leaf(k)
    return (F.when(F.col(features[nd.feature]) == 0, _descend(tree, features, leaf, 2 * k))
            .otherwise(_descend(tree, features, leaf, 2 * k + 1)))


def node_column(tree: dict[int, Node], features: list[str], targets: list[int]) -> Column:
    """Which of ``targets`` (disjoint nodes) a row falls in, NULL otherwise (a row's node is
    recomputed, never carried as mutable state)."""
    wanted = set(targets)
    return _descend(tree, features, lambda k: F.lit(k if k in wanted else None).cast("bigint"))


def predict_column(tree: dict[int, Node], features: list[str]) -> Column:
    return _descend(tree, features, lambda k: F.lit(tree[k].prediction).cast("bigint"))


def _side_stats(df: DataFrame, node: Column, features: list[str], label: Column,
                weight: Column | None, open_nodes: list[int]):
    w = weight if weight is not None else F.lit(1)
    aggs = []
    for i, c in enumerate(features):
        x = F.col(c)
        for v in (0, 1):
            for lab, nm in ((1, "p"), (-1, "q")):
                aggs.append(F.sum(F.when((x == v) & (label == lab), w).otherwise(F.lit(0)))
                            .alias(f"{nm}{v}_{i}"))
    rows = (df.withColumn("_node", node).where(F.col("_node").isin(open_nodes))
            .groupBy("_node").agg(*aggs).collect())
    return {r["_node"]: r for r in rows}


def _multi_side_stats(df: DataFrame, targets: list[tuple[int, Column]], features: list[str],
                      label: Column, weight: Column | None) -> dict:
    """Side statistics of the open nodes of several trees in one aggregation: each row is
    replicated once per tree in which it sits in an open node (≤ number of trees)."""
    w = weight if weight is not None else F.lit(1)
    structs = [F.struct(F.lit(t).alias("t"), node.alias("n")) for t, node in targets]
    base = (df.select(*[F.col(c) for c in features], label.alias("_y"), w.alias("_w"),
                      F.explode(F.array(*structs)).alias("_tn"))
            .where(F.col("_tn.n").isNotNull()))
    aggs = []
    for i, c in enumerate(features):
        x = F.col(c)
        for v in (0, 1):
            for lab, nm in ((1, "p"), (-1, "q")):
                aggs.append(F.sum(F.when((x == v) & (F.col("_y") == lab), F.col("_w"))
                                  .otherwise(F.lit(0))).alias(f"{nm}{v}_{i}"))
    rows = base.groupBy(F.col("_tn.t").alias("_t"), F.col("_tn.n").alias("_n")).agg(*aggs).collect()
    return {(r["_t"], r["_n"]): r for r in rows}


def build_trees(df: DataFrame, features: list[str], label: str, configs: dict,
                weight: Column | None = None) -> dict[str, dict[int, Node]]:
    """Grow several trees (``configs``: name → max_depth, min_node_size, min_error_reduction)
    level by level on ``df`` (the training rows), sharing one aggregation per level.

    A child's label totals are already known from its parent's split statistics, so a level
    is aggregated only for the nodes that may still split (not pure, depth below the maximum,
    above the minimum size): a stump costs one pass, a depth-d tree at most d passes."""
    weighted = weight is not None
    y = F.col(label)
    d = len(features)
    names = list(configs)
    state = {name: {"tree": {}, "paths": {1: set()}, "pending": {1: None}} for name in names}

    def is_pure(p, q):
        return min(p, q) <= 1e-15 if weighted else min(p, q) == 0

    depth = 0
    while any(state[nm]["pending"] for nm in names):
        targets, need = [], {}
        for ti, nm in enumerate(names):
            cfg, st = configs[nm], state[nm]
            need[nm] = [k for k, pq in st["pending"].items()
                        if pq is None or (not is_pure(*pq) and depth < cfg["max_depth"]
                                          and pq[0] + pq[1] > cfg.get("min_node_size", 0)
                                          and len(st["paths"][k]) < d)]
            if need[nm]:
                targets.append((ti, node_column(st["tree"], features, need[nm])))
        stats = _multi_side_stats(df, targets, features, y, weight) if targets else {}
        for ti, nm in enumerate(names):
            cfg, st = configs[nm], state[nm]
            tree, paths = st["tree"], st["paths"]
            min_size = cfg.get("min_node_size", 0)
            min_red = cfg.get("min_error_reduction")
            nxt: dict[int, tuple[float, float]] = {}
            for k, pq in st["pending"].items():
                r = stats.get((ti, k))
                if r is not None:
                    p = float(r["p0_0"] + r["p1_0"])
                    q = float(r["q0_0"] + r["q1_0"])
                elif pq is not None:
                    p, q = pq
                else:
                    continue
                nd = Node(k, depth, p, q)
                tree[k] = nd
                pred = (-1 if p < q else 1) if weighted else (1 if p > q else -1)
                allowed = [i for i in range(d) if i not in paths[k]]
                if r is None or is_pure(p, q) or not allowed or depth >= cfg["max_depth"] \
                        or nd.n <= min_size:
                    nd.prediction = pred
                    continue
                best, best_m = None, None
                for i in allowed:
                    m = (min(r[f"p0_{i}"], r[f"q0_{i}"]) + min(r[f"p1_{i}"], r[f"q1_{i}"]))
                    if best_m is None or m < best_m:
                        best, best_m = i, m
                n_left = r[f"p0_{best}"] + r[f"q0_{best}"]
                n_right = r[f"p1_{best}"] + r[f"q1_{best}"]
                if (min_red is not None and (nd.mistakes - best_m) / nd.n <= min_red) \
                        or n_left == 0 or n_right == 0:
                    nd.prediction = pred
                    continue
                nd.feature = best
                for v in (0, 1):
                    paths[2 * k + v] = paths[k] | {best}
                    nxt[2 * k + v] = (float(r[f"p{v}_{best}"]), float(r[f"q{v}_{best}"]))
            st["pending"] = nxt
        depth += 1
    return {nm: state[nm]["tree"] for nm in names}


def build_tree(df: DataFrame, features: list[str], label: str, max_depth: int,
               weight: Column | None = None, min_node_size: float = 0,
               min_error_reduction: float | None = None) -> dict[int, Node]:
    """One tree (see ``build_trees``)."""
    cfg = {"max_depth": max_depth, "min_node_size": min_node_size,
           "min_error_reduction": min_error_reduction}
    return build_trees(df, features, label, {"t": cfg}, weight)["t"]


def tree_rows(tree: dict[int, Node], features: list[str]):
    return [(k, nd.depth, None if nd.feature is None else features[nd.feature], nd.prediction,
             nd.n, nd.mistakes) for k, nd in sorted(tree.items())]


def best_root_split(df: DataFrame, features: list[str], label: str, weight: Column | None = None):
    """(feature index, mistakes after split, per-feature mistakes) at the root."""
    r = _side_stats(df, F.lit(1).cast("bigint"), features, F.col(label), weight, [1])[1]
    per = [min(r[f"p0_{i}"], r[f"q0_{i}"]) + min(r[f"p1_{i}"], r[f"q1_{i}"])
           for i in range(len(features))]
    best = min(range(len(features)), key=lambda i: (per[i], i))
    total = r["p0_0"] + r["p1_0"] + r["q0_0"] + r["q1_0"]
    return best, per, total
