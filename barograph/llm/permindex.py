"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order of its nearest pivots. Blocks of vectors
hold one inverted file per pivot: the place the pivot has with each vector. A
query walks the files of its own nearest pivots and sums up the footrule
distance of the two orders; the share of a block with the smallest distances is
reranked by the inner product of the original vectors: the products of their
components, summed exactly and rounded once.

For the inner product vectors are lifted to a sphere: a coordinate is added
that fills their length up to the largest one, and queries get zero there.

All queries meet all vectors block by block, every block pair in a task of its
own and of bounded size. Pivots are a documented, bounded sample of the vectors;
all vectors are indexed. A block of copies is no hot spot: blocks are dealt by a
hash of the id, and in a block equal vectors are one entry, of which no query
needs more than ``top + 1`` ids.

Defined results: vectors that are null, zero or hold nulls or non-finite numbers
take no part, nor do rows without id or of another length than most. Equal
scores go to the smaller id. Rows that repeat an id count once per id. With
fewer candidates than ``top`` a query returns all. Other columns are ignored.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from barograph.llm.common import over_batches, rows_of

PIVOTS = 256
PREFIX = 128
WALKED = 64
SHARE = 0.15
TOP = 20
LEAST_CANDIDATES = 5 * TOP
VECTOR_BLOCK = 4096
QUERY_BLOCK = 1024
# What a product of two vectors may be off by, as a share of the product of their lengths.
MARGIN = 1e-12


def usable(vectors, id_col="vec_id", vector_col="embedding"):
    """``id, v``: rows whose vector takes part, as doubles."""
    v = F.col(vector_col)
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), v.cast("array<double>").alias("v"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.where(
        F.col("id").isNotNull()
        & (F.size("v") > 0)
        & F.forall("v", finite)
        & F.exists("v", lambda x: x != 0)
    )
    most = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (most["d"] if most else 0))


def lifted(matrix, longest):
    """Vectors scaled into the unit ball, with the coordinate that lifts them to its sphere."""
    scaled = matrix / longest
    rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled**2).sum(1)))
    return np.hstack([scaled, rest[:, None]])


def nearest_pivots(matrix, pivots, prefix):
    return np.argsort(-(matrix @ pivots.T), axis=1, kind="stable")[:, :prefix].astype(np.int16)


def indexed(rows, pivots, longest, prefix):
    """``id, v, orders, asks``: vectors as bytes, with their pivot orders as row and as query."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def make():
        def step(batch):
            v = np.array(batch["v"], dtype=np.float64)
            orders = nearest_pivots(lifted(v, longest), shared.value, prefix)
            unit = v / np.linalg.norm(v, axis=1, keepdims=True)
            asks = nearest_pivots(np.hstack([unit, np.zeros((len(v), 1))]), shared.value, prefix)
            return {
                "id": batch["id"],
                "v": [x.tobytes() for x in v],
                "orders": [x.tobytes() for x in orders],
                "asks": [x.tobytes() for x in asks],
            }

        return step

    return over_batches(rows, "id bigint, v binary, orders binary, asks binary", make)


def search_block(ids, vectors, orders, query_ids, queries, asks, pivots, top, share, least, walked):
    """``(query, ids, scores)`` of the best entries of one block for each query."""
    kind = np.dtype((np.void, vectors.shape[1] * 8))
    order = np.argsort(ids, kind="stable")
    ids, vectors, orders = ids[order], vectors[order], orders[order]
    keys = np.ascontiguousarray(vectors).view(kind).ravel()
    _, first, entry = np.unique(keys, return_index=True, return_inverse=True)
    by_entry = np.argsort(entry, kind="stable")
    starts = np.searchsorted(entry[by_entry], np.arange(len(first) + 1))
    size, prefix = len(first), orders.shape[1]
    # Twice the place of every pivot with every entry; beyond the prefix, its length.
    files = np.full((pivots, size), 2 * prefix, dtype=np.int16)
    for place in range(prefix):
        files[orders[first, place], np.arange(size)] = 2 * place
    wanted = min(size, max(least, int(share * size)))
    distance, part = np.empty(size, np.int16), np.empty(size, np.int16)
    copies = vectors[first]
    lengths = np.linalg.norm(copies, axis=1)
    for number, query in enumerate(query_ids):
        if wanted < size:
            distance[:] = 0
            # max(2r - j, j) is |r - j| + r: the footrule, less what is the same for all.
            for place, pivot in enumerate(asks[number, :walked]):
                np.subtract(files[pivot], place, out=part)
                np.maximum(part, place, out=part)
                np.add(distance, part, out=distance)
            limit = np.partition(distance, wanted - 1)[wanted - 1]
            near = np.flatnonzero(distance <= limit)
        else:
            near = np.arange(size)
        scores = copies[near] @ queries[number]
        if len(near) > top + 1:
            bound = np.partition(scores, len(scores) - top - 1)[len(scores) - top - 1]
            kept = scores >= bound - MARGIN * lengths[near] * np.linalg.norm(queries[number])
            near = near[kept]
        # The last bits of a matrix product depend on its shape. This sum depends on the two vectors alone,
        # so equal vectors score alike in whatever block they lie.
        scores = [math.fsum(copies[at] * queries[number]) for at in near.tolist()]
        found = []
        for at, score in zip(near, scores):
            members = ids[by_entry[starts[at] : starts[at + 1]]]
            found += [(-score, int(i)) for i in np.unique(members)[: top + 1] if i != query]
        found = sorted(set(found))[:top]
        yield int(query), [i for _, i in found], [-s for s, _ in found]


def nearest(
    vectors, stored, is_query, top=TOP, pivots=PIVOTS, prefix=PREFIX, walked=WALKED, share=SHARE,
    least=LEAST_CANDIDATES, vector_block=VECTOR_BLOCK, query_block=QUERY_BLOCK, id_col="vec_id", vector_col="embedding",
):
    """``query_id, rank, vec_id, score``: the ``top`` nearest found of every query.

    ``is_query`` is a condition on ``id``.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    seen = rows.agg(
        F.max(length).alias("longest"),
        F.count("*").alias("n"),
        F.count(F.when(is_query, 1)).alias("q"),
    ).first()
    out = "query_id bigint, rank int, vec_id bigint, score double"
    if not seen["q"]:
        return spark.createDataFrame([], out)
    longest = seen["longest"]
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(pivots)
    points = lifted(np.array([r["v"] for r in rows_of(sample)], dtype=np.float64), longest)
    prefix, walked = min(prefix, len(points)), min(walked, len(points))
    blocks = max(1, -(-seen["n"] // vector_block))
    asked = max(1, -(-seen["q"] // query_block))
    deal = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n)).cast("int")
    index = stored(indexed(rows, points, longest, prefix), "permutations")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    data = index.select(
        "id", "v", F.col("orders").alias("places"), F.lit(False).alias("asks"),
        deal(blocks, "v").alias("vb"), every(asked).alias("qb"),
    )
    queries = index.where(is_query).select(
        "id", "v", F.col("asks").alias("places"), F.lit(True).alias("asks"),
        every(blocks).alias("vb"), deal(asked, "q").alias("qb"),
    )
    wide = len(points)

    def search(table):
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        ids = table.column("id").to_numpy()
        matrix = lambda name, kind: np.stack(
            [np.frombuffer(x, dtype=kind) for x in table.column(name).to_pylist()]
        )
        v, places = matrix("v", np.float64), matrix("places", np.int16)
        found = []
        if asks.any() and not asks.all():
            found = list(
                search_block(
                    ids[~asks], v[~asks], places[~asks], ids[asks], v[asks], places[asks],
                    wide, top, share, least, walked,
                )
            )
        return pa.table(
            {
                "query_id": pa.array([f[0] for f in found], pa.int64()),
                "ids": pa.array([f[1] for f in found], pa.list_(pa.int64())),
                "scores": pa.array([f[2] for f in found], pa.list_(pa.float64())),
            }
        )

    met = (
        data.unionByName(queries)
        .groupBy("vb", "qb")
        .applyInArrow(search, "query_id bigint, ids array<bigint>, scores array<double>")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        met.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("f"))
        .select("query_id", F.col("f.ids").alias("vec_id"), F.col("f.scores").alias("score"))
        .distinct()
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= top)
        .select("query_id", "rank", "vec_id", "score")
    )
