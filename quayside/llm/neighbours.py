"""Nearest neighbours by inner product, from stable projections in one kd-tree.

Largest inner product becomes smallest distance by one more coordinate: with M
the largest norm, x gets sqrt(M^2 - |x|^2) and a query 0. Vectors are projected
to `PROJECTED` dimensions with normal (2-stable) weights: the squared projected
distance is the true one times a chi-square variable of as many degrees.

A kd-tree over the projections spans the whole table: its planes are cut from
`SAMPLE` rows at most, chosen by hash, and every row goes to its leaf, in blocks
of bounded size, in which the tree goes on. A query first searches its home
leaf, and learns how far its worst neighbour is. Then it is sent only to leaves
whose box may still hold a nearer one, and takes their inner leaves from the
nearest on. It leaves one out if the chance that a vector nearer than its worst
neighbour lies beyond the box is under 1 - `CERTAINTY`:
chi2(distance^2 / d_k^2) >= CERTAINTY. So each true neighbour is found with that
chance at least; boxes are farther out than the vectors in them, so most are
found with a higher one.

Every row is indexed. Equal vectors are indexed once and come back with their
ids, of which only the smallest k + 1 can ever be asked for, so a hot vector is
no hot task. Groups of queries meet blocks in tasks of bounded size; both are
shipped in blocks, never row by row.

Defined results: vectors that are null, zero, of another length than most, or
hold null or non-finite components take no part; a query's own id is never its
neighbour; rows that repeat an id and vector count once; ties go to the smaller
id; with fewer candidates than k all are returned; an empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from quayside.llm.common import read, saved
from quayside.session import sent_with_jobs

sent_with_jobs(__name__)

K, EVERY = 20, 20
PROJECTED, CERTAINTY, SEED = 8, 0.5, 5
SAMPLE, SAMPLE_LEAF = 16_384, 32  # rows that cut the tree's planes, and the fewest of them in a leaf
LEAF_ROWS, BLOCK, INNER, QUERIES_PER_TASK = 4096, 8192, 256, 16_384
TOGETHER = 512  # queries searched side by side


def chi_square_cdf(x, degrees: int):
    """For an even number of degrees, in closed form."""
    import numpy as np

    half = np.asarray(x, float) / 2
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, degrees // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def weights_for(size: int):
    """Projection of vectors of `size` components and the one more."""
    import numpy as np

    return np.random.default_rng(SEED).standard_normal((size + 1, PROJECTED))


def projected(vectors, norm2: float, weights):
    import numpy as np

    lift = np.sqrt(np.maximum(norm2 - (vectors * vectors).sum(1), 0.0))
    return vectors @ weights[:-1] + lift[:, None] * weights[-1]


def planes(points, leaf: int) -> list[tuple]:
    """Inner nodes (axis, value, node below, node from it on) of a kd-tree with about `leaf` points a leaf; -1 - i is leaf i."""
    import numpy as np

    nodes, leaves, todo = [], 0, [(points, None, None)]
    while todo:
        part, parent, side = todo.pop()
        axis = int(np.argmax(part.max(0) - part.min(0))) if len(part) else 0
        value = float(np.median(part[:, axis])) if len(part) else 0.0
        below = part[:, axis] < value if len(part) else np.zeros(0, bool)
        if not below.any() and (part[:, axis:axis + 1] > value).any():  # more than half are the smallest
            value = float(part[part[:, axis] > value, axis].min())
            below = part[:, axis] < value
        if len(part) < 2 * leaf or not below.any():
            here, leaves = -1 - leaves, leaves + 1
        else:
            here = len(nodes)
            nodes.append([axis, value, None, None])
            todo += [(part[below], here, 2), (part[~below], here, 3)]
        if parent is not None:
            nodes[parent][side] = here
    return [tuple(n) for n in nodes]


def leaf_of(points, nodes: list[tuple]):
    """The leaf each point falls into."""
    import numpy as np

    at = np.zeros(len(points), np.int64)
    if not nodes:
        return at
    axis, below, above = (np.array([n[i] for n in nodes], np.int64) for i in (0, 2, 3))
    value = np.array([n[1] for n in nodes])
    while (at >= 0).any():
        inner = np.flatnonzero(at >= 0)
        node = at[inner]
        low = points[inner, axis[node]] < value[node]
        at[inner] = np.where(low, below[node], above[node])
    return -1 - at


def tree(points, leaf: int = INNER):
    """Order of the points by leaf, where leaves begin and end, and their boxes."""
    import numpy as np

    order, bounds, todo = np.arange(len(points)), [], [(0, len(points))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo <= leaf:
            bounds.append((lo, hi))
            continue
        part = points[order[lo:hi]]
        axis, mid = int(np.argmax(part.max(0) - part.min(0))), (hi - lo) // 2
        order[lo:hi] = order[lo:hi][np.argpartition(part[:, axis], mid)]  # by place, so equal values split too
        todo += [(lo, lo + mid), (lo + mid, hi)]
    bounds.sort()
    starts = np.array([b[0] for b in bounds])
    sorted_points = points[order]
    return order, np.append(starts, len(points)), np.minimum.reduceat(sorted_points, starts), np.maximum.reduceat(sorted_points, starts)


def beyond(points, low, high):
    """Squared distance of each point to each box."""
    import numpy as np

    total = np.zeros((len(points), len(low)))
    for d in range(points.shape[1]):
        gap = np.maximum(np.maximum(low[:, d] - points[:, d:d + 1], points[:, d:d + 1] - high[:, d]), 0.0)
        total += gap * gap
    return total


def settled(distance2, own, worst):
    """Whether nothing nearer than the worst neighbour is likely beyond a projected distance. `own`: |q|^2 + M^2; `worst`: its score."""
    import numpy as np

    left = np.maximum(own - 2 * worst, 1e-12)
    return np.isfinite(worst) & (chi_square_cdf(distance2 / np.where(np.isfinite(left), left, 1.0), PROJECTED) >= CERTAINTY)


def search(ids, vectors, queries, worst, norm2: float, k: int):
    """(query place, row place, score) of each query's k best rows of one block that are no worse than `worst`, as far as
    the stopping test lets it look, and how many it verified. Ties go to the smaller of `ids`."""
    import numpy as np

    weights = weights_for(vectors.shape[1])
    order, starts, low, high = tree(projected(vectors, norm2, weights))
    ids, vectors = ids[order], vectors[order]
    own, worst = (queries * queries).sum(1) + norm2, worst.copy()
    slack = 1e-9 * own  # products of matrices are rounded in another order than the scores
    distance2 = beyond(queries @ weights[:-1], low, high)
    best_query, best_row, best, verified = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), 0
    for leaf in np.argsort(distance2.mean(0), kind="stable"):
        lo, hi = starts[leaf], starts[leaf + 1]
        open_ = np.flatnonzero(~settled(distance2[:, leaf], own, worst))
        verified += len(open_) * (hi - lo)
        near = queries[open_] @ vectors[lo:hi].T
        q, r = np.nonzero(near >= (worst - slack)[open_, None])
        if not len(q):
            continue
        q, r = open_[q], r + lo
        best_query, best_row = np.concatenate([best_query, q]), np.concatenate([best_row, r])
        best = np.concatenate([best, (vectors[r] * queries[q]).sum(1)])  # row by row, so equal vectors score equally
        by = np.lexsort((ids[best_row], -best, best_query))
        best_query, best_row, best = best_query[by], best_row[by], best[by]
        place = np.arange(len(by)) - np.searchsorted(best_query, best_query)
        kept = place < k
        best_query, best_row, best, place = best_query[kept], best_row[kept], best[kept], place[kept]
        last = place == k - 1
        worst[best_query[last]] = np.maximum(worst[best_query[last]], best[last])
    return best_query, order[best_row], best, verified


def usable_rows(rows: DataFrame, id: str, vector: str) -> DataFrame:
    """vec_id and v of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    usable = rows.select(F.col(id).cast("long").alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (
            F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    sizes = usable.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").first()
    return usable.filter(F.size("v") == (sizes.size if sizes else 0))


def met(index: DataFrame, queries: DataFrame, parts: dict[int, int], groups: int, norm2: float, k: int) -> DataFrame:
    """query_id, id, print, score: what queries (query_id, v, worst, leaf) find in the blocks of their leaves (leaf, part, id, print, v)."""
    numbered = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    many = F.create_map(*[F.lit(x) for leaf, n in parts.items() for x in (leaf, n)])
    blocks = index.withColumn("some", numbered(F.lit(groups)))
    # queries travel packed, some hundreds to a row
    packed = queries.withColumn("some", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int")).withColumn(
        "pack", F.pmod(F.xxhash64("query_id", F.lit(1)), F.lit(max(1, QUERIES_PER_TASK // TOGETHER)))).groupBy("leaf", "some", "pack").agg(
        F.collect_list(F.struct("query_id", "worst", "v")).alias("q")).select(
        "leaf", "some", F.transform("q", lambda x: x["query_id"]).alias("ids"), F.transform("q", lambda x: x["worst"]).alias("worst"),
        F.flatten(F.transform("q", lambda x: x["v"])).alias("vs")).filter(F.map_contains_key(many, F.col("leaf"))).withColumn(
        "part", numbered(F.element_at(many, F.col("leaf"))))

    def run(key, left, right):
        import numpy as np
        import pandas as pd

        out = []
        if len(left) and len(right):
            vectors, ids, prints = np.stack(left["v"].to_numpy()), left["id"].to_numpy(), left["print"].to_numpy()
            rank = np.empty(len(ids), np.int64)  # ties inside a block break by id
            rank[np.lexsort((prints, ids))] = np.arange(len(ids))
            asked, worst = np.concatenate(right["ids"].to_list()), np.concatenate(right["worst"].to_list())
            flat = np.concatenate(right["vs"].to_list()).reshape(len(asked), -1)
            for at in range(0, len(asked), TOGETHER):
                q, r, scores, _ = search(rank, vectors, flat[at:at + TOGETHER], worst[at:at + TOGETHER], norm2, k)
                out.append(pd.DataFrame({"query_id": asked[at:at + TOGETHER][q], "id": ids[r], "print": prints[r], "score": scores}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "id": [], "print": [], "score": []})

    return blocks.groupBy("leaf", "part", "some").cogroup(packed.groupBy("leaf", "part", "some")).applyInPandas(
        run, "query_id long, id long, print long, score double")


def nearest(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = K, every: int = EVERY,
            leaf_rows: int = LEAF_ROWS, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each row whose id is divisible by `every`."""
    usable = usable_rows(rows, id, vector)
    order = Window.partitionBy("v").orderBy("vec_id")
    equal = usable.distinct().withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    members = saved(equal.withColumn("same", F.min("vec_id").over(order)).withColumn(
        "same", F.struct("same", F.xxhash64("v").alias("print"))), "vectors")  # one id may have several vectors
    facts = members.filter("place = 1").agg(F.count(F.lit(1)).alias("n"), F.max(
        F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("norm2")).first()
    n, norm2 = facts.n, facts.norm2 or 0.0
    nodes = _planes_of(members.filter("place = 1"), n, norm2, leaf_rows)
    located = saved(_located(members.filter("place = 1").select(
        F.col("same.same").alias("id"), F.col("same.print").alias("print"), "v"), nodes, norm2), "vector-leaves")
    bounds = {r.leaf: r for r in located.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), *[
        f(F.get("p", F.lit(d))).alias(f"{name}{d}") for d in range(PROJECTED) for f, name in ((F.min, "low"), (F.max, "high"))]).collect()}
    parts = {leaf: math.ceil(r.n / block) for leaf, r in bounds.items()}
    if not parts:  # no usable vector
        return usable.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    many = F.create_map(*[F.lit(x) for leaf, count in parts.items() for x in (leaf, count)])
    index = located.withColumn("part", F.pmod(F.xxhash64("print"), F.element_at(many, F.col("leaf"))).cast("int")).drop("p")

    asked = saved(_asked(usable.filter(F.pmod("vec_id", F.lit(every)) == 0).distinct(), nodes, list(parts)), "vector-queries")
    groups = max(1, math.ceil(asked.count() / QUERIES_PER_TASK))
    none = F.lit(float("-inf"))
    home = saved(met(index, asked.select("query_id", "v", none.alias("worst"), "leaf"), parts, groups, norm2, k + 1), "vector-homes")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    worst = home.withColumn("r", F.row_number().over(best)).filter(F.col("r") == k + 1).select("query_id", F.col("score").alias("worst"))
    routed = _routed(asked.join(worst, "query_id", "left").select("query_id", "v", F.coalesce("worst", none).alias("worst"), "leaf"), bounds, norm2)
    away = met(index, routed, parts, groups, norm2, k + 1)

    short = home.unionByName(away).withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1).drop("r")
    ids = members.select(F.col("same.same").alias("id"), F.col("same.print").alias("print"), "vec_id")
    every_id = short.join(ids, ["id", "print"]).filter("vec_id <> query_id").groupBy("query_id", "vec_id").agg(
        F.max("score").alias("score"))
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return every_id.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def _planes_of(vectors: DataFrame, n: int, norm2: float, leaf_rows: int) -> list[tuple]:
    """Planes of a tree with about `leaf_rows` of the n vectors a leaf."""
    import numpy as np

    if n <= leaf_rows:
        return []
    share = min(1.0, 0.8 * SAMPLE / n)
    sample = vectors.filter(F.pmod(F.xxhash64("v", F.lit("planes")), F.lit(1 << 30)) < int(share * (1 << 30))).select("v").toPandas()["v"]
    points = np.stack(sample.to_numpy()) if len(sample) else np.zeros((0, 1))
    return planes(projected(points, norm2, weights_for(points.shape[1])), max(SAMPLE_LEAF, math.ceil(leaf_rows * share)))


def _located(vectors: DataFrame, nodes: list[tuple], norm2: float) -> DataFrame:
    """`vectors` (id, print, v) with projection p and leaf."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                v = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, -1)
                p = projected(v, norm2, weights_for(v.shape[1]))
                offsets = pa.array(np.arange(0, p.size + 1, PROJECTED), pa.int32())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(p.ravel())),
                                                  pa.array(leaf_of(p, nodes), pa.int32())], names=["id", "print", "v", "p", "leaf"])

    return vectors.mapInArrow(run, "id long, print long, v array<double>, p array<double>, leaf int")


def _asked(queries: DataFrame, nodes: list[tuple], leaves: list[int]) -> DataFrame:
    """`queries` (vec_id, v) as query_id, v and leaf, the home."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                v = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
                leaf = leaf_of(v @ weights_for(v.shape[1])[:-1], nodes)
                leaf = np.where(np.isin(leaf, leaves), leaf, leaves[0])  # no row at home: any leaf is a start
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())], names=["query_id", "v", "leaf"])

    return queries.select("vec_id", "v").mapInArrow(run, "query_id long, v array<double>, leaf int")


def _routed(queries: DataFrame, bounds: dict, norm2: float) -> DataFrame:
    """`queries` (query_id, v, worst, leaf: their home) with each leaf but the home that may hold something nearer, a row for each."""
    import numpy as np

    leaves = np.array(list(bounds))
    low, high = (np.array([[r[f"{name}{d}"] for d in range(PROJECTED)] for r in bounds.values()]) for name in ("low", "high"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            v = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
            worst, home = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            own = (v * v).sum(1) + norm2
            away = ~settled(beyond(v @ weights_for(v.shape[1])[:-1], low, high), own[:, None], worst[:, None]) & (leaves != home[:, None])
            offsets = np.concatenate([[0], np.cumsum(away.sum(1))])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(leaves[np.nonzero(away)[1]], pa.int32()))], names=["query_id", "v", "worst", "leaves"])

    return queries.mapInArrow(run, "query_id long, v array<double>, worst double, leaves array<int>").select(
        "query_id", "v", "worst", F.explode("leaves").alias("leaf"))


def op5_nearest(spark, sf_dir):
    return nearest(read(spark, sf_dir, "embeddings"))


QUERIES = {"op5_nearest": op5_nearest}
ORACLE: dict[str, str] = {}
