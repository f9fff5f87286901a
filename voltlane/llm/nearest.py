"""Approximate nearest neighbours by learned partitions.

The index is fitted on a bounded sample: a graph of nearest neighbours within the sample is cut into balanced parts of
few cut edges, and a small network learns to tell from a vector the parts of its neighbours. Every vector of the table
is indexed under its most probable part; a query goes to its most probable parts and is compared there with all
vectors, in double precision. On held-out vectors of the sample the driver measures how many parts it takes to find
``RECALL`` of the true neighbours; neighbours in the whole table are nearer than those, so they are easier to find.

The sample has ``SAMPLE`` vectors to learn from and ``HELD_OUT`` to measure on. The number of parts follows the table's
size, ``ROWS`` vectors each, up to ``MOST_PARTS``. Parts are cut into blocks of vectors and of queries by hash, so a task
holds one block of each, however full a part is.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlane.llm.arrow import bounded, group_starts, runs
from voltlane.llm.vectors import by_length, cosine, matrix, unit, usable
from voltlane.scratch import staged

SAMPLE, HELD_OUT = 4096, 1024
NEIGHBOURS = 10
ROWS = 500
LEAST_PARTS, MOST_PARTS = 4, 256
LEAST_ROWS = 64
RECALL = 0.94
HIDDEN = 128
BLOCK = 4096
MOST_LENGTHS = 64


# Fitting


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Of each unit vector the ``k`` nearest others."""
    out = np.empty((len(x), k), dtype=np.int64)
    for at in range(0, len(x), 1024):
        near = x[at : at + 1024] @ x.T
        near[np.arange(len(near)), at + np.arange(len(near))] = -2
        out[at : at + 1024] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, seed: int = 1) -> np.ndarray:
    """A part for each node: halves along main directions to begin with, then nodes move to the part of most of their
    neighbours as long as that has room."""
    part = np.zeros(len(x), dtype=np.int64)
    todo = [(np.arange(len(x)), 0, parts)]
    while todo:
        own, first, n = todo.pop()
        if n == 1:
            part[own] = first
            continue
        centred = x[own] - x[own].mean(axis=0)
        along = centred @ np.linalg.svd(centred[:1024], full_matrices=False)[2][0]
        order, cut = np.argsort(along, kind="stable"), round(len(own) * (n // 2) / n)
        todo += [(own[order[:cut]], first, n // 2), (own[order[cut:]], first + n // 2, n - n // 2)]
    both = [[] for _ in range(len(x))]
    for a, row in enumerate(graph.tolist()):
        for b in row:
            both[a].append(b)
            both[b].append(a)
    both = [np.array(b) for b in both]
    size, room = np.bincount(part, minlength=parts), int(1.1 * len(x) / parts) + 1
    rng = np.random.default_rng(seed)
    for _ in range(8):
        moved = 0
        for a in rng.permutation(len(x)).tolist():
            count = np.bincount(part[both[a]], minlength=parts)
            here = part[a]
            best = int(np.where((size < room) | (np.arange(parts) == here), count, -1).argmax())
            if count[best] > count[here]:
                size[here] -= 1
                size[best] += 1
                part[a] = best
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Network:
    """One hidden layer; the logits of the parts."""

    first: np.ndarray
    second: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum(np.column_stack([x, np.ones(len(x))]) @ self.first, 0)
        return np.column_stack([hidden, np.ones(len(x))]) @ self.second

    def order(self, x: np.ndarray) -> np.ndarray:
        """Parts of each row, most probable first."""
        return np.argsort(-self.logits(x), axis=1, kind="stable")


def learned(x: np.ndarray, target: np.ndarray, epochs: int = 40, seed: int = 2) -> Network:
    """A network fitted to the shares of parts among each row's neighbours, by Adam on the cross-entropy."""
    rng = np.random.default_rng(seed)
    d, parts = x.shape[1], target.shape[1]
    net = Network(
        rng.standard_normal((d + 1, HIDDEN)) * np.sqrt(2 / d) * 3, rng.standard_normal((HIDDEN + 1, parts)) * 0.05
    )
    weights, step = [net.first, net.second], 0
    mean, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 256):
            own = order[at : at + 256]
            inputs = np.column_stack([x[own], np.ones(len(own))])
            before = inputs @ net.first
            hidden = np.column_stack([np.maximum(before, 0), np.ones(len(own))])
            logits = hidden @ net.second
            shares = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = (shares / shares.sum(axis=1, keepdims=True) - target[own]) / len(own)
            grads = [inputs.T @ ((error @ net.second[:-1].T) * (before > 0)), hidden.T @ error]
            step += 1
            rate = 0.01 * (1 - epoch / epochs)
            for k, (w, g) in enumerate(zip(weights, grads)):
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                w -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    return net


@dataclass
class Index:
    """What the tasks need: the network of each vector length, and how many parts a query goes to."""

    network: Network
    probes: int
    sizes: np.ndarray | None = None


def fit(x: np.ndarray, rows: int, nearest: int) -> Index | None:
    """An index for a table of ``rows`` vectors from a sample of them; None if there are too few for parts."""
    if len(x) < LEAST_ROWS:
        return None
    x = unit(x)
    train = x[: max(LEAST_ROWS // 2, len(x) * SAMPLE // (SAMPLE + HELD_OUT))]
    k = min(NEIGHBOURS, len(train) - 1)
    graph = neighbour_graph(train, k)
    parts = int(np.clip(-(-rows // ROWS), LEAST_PARTS, min(MOST_PARTS, len(train) // 16 + LEAST_PARTS)))
    part = balanced_parts(train, graph, parts)
    target = np.zeros((len(train), parts))
    np.add.at(target, (np.repeat(np.arange(len(train)), k), part[graph].ravel()), 1 / (k + 1))
    target[np.arange(len(train)), part] += 1 / (k + 1)
    net = learned(train, target)
    indexed = net.order(x)[:, 0]
    asked = np.arange(len(train), len(x))[:512]
    if not len(asked):
        return Index(net, parts)
    near = x[asked] @ x.T
    near[np.arange(len(asked)), asked] = -2
    true = np.argpartition(-near, nearest - 1, axis=1)[:, :nearest]
    place = np.argsort(net.order(x[asked]), axis=1)  # of each part in a query's order
    needed = np.sort(np.take_along_axis(place, indexed[true], axis=1).ravel())
    return Index(net, int(needed[min(len(needed) - 1, int(np.ceil(RECALL * len(needed))))]) + 1)


def fitted(vectors: DataFrame, nearest: int) -> dict[int, Index]:
    """An index for each of the most frequent vector lengths that has vectors enough."""
    size = F.size("embedding")
    counts = vectors.groupBy(size.alias("d")).count().orderBy(F.desc("count"), "d").limit(MOST_LENGTHS).collect()
    out = {}
    for d, rows in [(r["d"], r["count"]) for r in counts if r["count"] >= LEAST_ROWS]:
        wanted = SAMPLE + HELD_OUT
        share = min(1.0, 1.2 * wanted / rows)
        draw = F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(1 << 30))
        sample = vectors.filter((size == d) & (draw < F.lit(int(share * (1 << 30)))))
        sample = sample.dropDuplicates(["embedding"]).select("embedding").orderBy(F.xxhash64("embedding")).limit(wanted)
        x = np.array([r["embedding"] for r in sample.collect()], dtype=np.float64).reshape(-1, d)
        if index := fit(x, rows, nearest):
            out[d] = index
    return out


# Searching


def _with_part(df: DataFrame) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField("part", T.IntegerType())])


def _indexed(vectors: DataFrame, box) -> DataFrame:
    """Vectors with the part they are indexed under; those of a length without an index form one part."""

    def assign(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                own = batch.slice(at, 4096)
                part = np.zeros(own.num_rows, dtype=np.int32)
                for rows, x in by_length(own.column("embedding")):
                    if index := box.value.get(x.shape[1]):
                        part[rows] = index.network.logits(unit(x)).argmax(axis=1)
                yield own.append_column("part", pa.array(part))

    return bounded(vectors).mapInArrow(assign, _with_part(vectors))


def _routed(queries: DataFrame, box, nearest: int) -> DataFrame:
    """A row for each part that a query goes to: its most probable ones, more where these hold too few vectors."""

    def route(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                own = batch.slice(at, 1024)
                who, part = [], []
                for rows, x in by_length(own.column("embedding")):
                    index = box.value.get(x.shape[1])
                    if index is None:
                        who.append(rows)
                        part.append(np.zeros(len(rows), dtype=np.int64))
                        continue
                    order = index.network.order(unit(x))
                    held = np.cumsum(index.sizes[order], axis=1)
                    enough = np.minimum((held <= nearest).sum(axis=1) + 1, order.shape[1])
                    use = np.arange(order.shape[1]) < np.maximum(enough, index.probes)[:, None]
                    who.append(rows[np.nonzero(use)[0]])
                    part.append(order[use])
                if who:
                    out = own.take(pa.array(np.concatenate(who)))
                    yield out.append_column("part", pa.array(np.concatenate(part).astype(np.int32)))

    return queries.mapInArrow(route, _with_part(queries))


def _blocks(rows: DataFrame, sizes: DataFrame, own: Column, other: Column) -> DataFrame:
    """``rows`` once for each block of the other side; ``i`` and ``j`` are the blocks of vectors and of queries."""
    rows = rows.join(sizes, ["d", "part"])
    return rows.withColumn("own", F.pmod(F.xxhash64("vec_id", F.lit(29)), own).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), (other - 1).cast("int")))
    )


def _best(table: pa.Table, nearest: int):
    """Of each cell, every query's nearest vectors."""
    starts = group_starts([table.column(k) for k in ("d", "part", "i", "j")])
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows]):
        cell = table.slice(a, b - a)
        ids, query = cell.column("vec_id").to_numpy(), cell.column("query").to_numpy(zero_copy_only=False)
        x = matrix(cell.column("embedding"))
        q_id, q, ids, x = ids[query], x[query], ids[~query], x[~query]
        # Of equal vectors only the least ids can be among the nearest, and the query itself.
        order = np.lexsort((ids, *x.T[:8]))
        ids, x = ids[order], x[order]
        same = np.concatenate([[False], (x[1:] == x[:-1]).all(axis=1)])
        first = np.maximum.accumulate(np.where(same, 0, np.arange(len(x))))
        use = np.arange(len(x)) - first <= nearest
        ids, x = ids[use], x[use]
        if not len(q_id) or not len(ids):
            continue
        u = unit(x)
        for at in range(0, len(q_id), 512):
            who, rows = q_id[at : at + 512], q[at : at + 512]
            near = unit(rows) @ u.T
            near[who[:, None] == ids[None, :]] = -2
            k = min(nearest, near.shape[1])
            least = -np.partition(-near, k - 1, axis=1)[:, k - 1]
            r, c = np.nonzero(near >= np.maximum(least - 1e-9, -1.5)[:, None])
            score = cosine(rows[r], x[c])
            order = np.lexsort((ids[c], -score, r))
            r, c, score = r[order], c[order], score[order]
            begin = np.flatnonzero(np.diff(r, prepend=-1))
            rank = np.arange(len(r)) - np.repeat(begin, np.diff(np.append(begin, len(r))))
            use = rank < nearest
            yield pa.RecordBatch.from_arrays(
                [pa.array(who[r[use]]), pa.array(ids[c[use]]), pa.array(score[use])], names=["query_id", "vec_id", "score"]
            )


def nearest(vectors: DataFrame, queries: Column, k: int = 5) -> DataFrame:
    """Of each row of ``vectors`` (vec_id, embedding) where ``queries`` holds, its ``k`` nearest found by cosine among
    the rows of another vec_id: query_id, rank (from 1), vec_id, score; nearest first, ties to the smaller vec_id.

    Vectors that are null, empty or zero or hold null or non-finite components take no part, nor do rows without
    vec_id; vectors meet only those of their length. Fewer than ``k`` candidates are all returned. Rows that repeat a
    vec_id are one candidate, with the larger score."""
    rows = vectors.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull() & usable("embedding"))
    indexes = fitted(rows, k)
    context = vectors.sparkSession.sparkContext
    parted = staged(_indexed(rows, context.broadcast(indexes)).withColumn("d", F.size("embedding")), "parts")
    sizes = parted.groupBy("d", "part").agg(F.count("*").alias("n_vectors"))
    for r in sizes.filter(F.col("d").isin([int(d) for d in indexes])).collect():
        index = indexes[r["d"]]
        if index.sizes is None:
            index.sizes = np.zeros(index.network.second.shape[1], dtype=np.int64)
        index.sizes[r["part"]] = r["n_vectors"]
    asked = _routed(parted.filter(queries).select("vec_id", "embedding", "d"), context.broadcast(indexes), k)
    asked = staged(asked, "asked")
    sizes = sizes.join(asked.groupBy("d", "part").agg(F.count("*").alias("n_queries")), ["d", "part"])
    sizes = staged(
        sizes.select(
            "d", "part", F.ceil(F.col("n_vectors") / BLOCK).alias("rows"), F.ceil(F.col("n_queries") / BLOCK).alias("asks")
        ),
        "sizes",
    )
    found = _blocks(parted, sizes, F.col("rows"), F.col("asks")).select(
        "d", "part", F.col("own").alias("i"), F.col("other").alias("j"), F.lit(False).alias("query"), "vec_id", "embedding"
    )
    asking = _blocks(asked, sizes, F.col("asks"), F.col("rows")).select(
        "d", "part", F.col("other").alias("i"), F.col("own").alias("j"), F.lit(True).alias("query"), "vec_id", "embedding"
    )
    cells = found.unionByName(asking).repartition("d", "part", "i", "j").sortWithinPartitions("d", "part", "i", "j")

    def search(batches):
        for table in runs(batches, ["d", "part", "i", "j"]):
            yield from _best(table, k)

    hits = cells.mapInArrow(search, "query_id long, vec_id long, score double")
    hits = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, F.col("vec_id") % 50 == 0)
