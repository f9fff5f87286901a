"""Near-duplicate vectors by spherical-cap filters.

Filter directions are the words of a random product code: after a random rotation, the space is cut into up to three
blocks, each with ``B`` random unit vectors, and every choice of one per block is a direction. A vector passes all
filters whose direction it exceeds ``alpha`` with; list decoding finds them from the blocks' products, leaving out
branches that can't reach ``alpha``; a vector in a thin place of the code takes its ``LEAST`` best. There are so many filters that a vector passes ``LIST`` on average, and a filter
holds some ``HELD`` unrelated vectors, at any size of the table. Two vectors at the threshold share a filter with about
half of the passes of either.

Vectors meet in the filters by id and a sign sketch of 128 bits; pairs whose sketches are near make candidate groups.
Within those the cosine is taken in double precision, every vector being shuffled once (more in groups above ``CELL``).
Equal vectors are one from the start.
"""

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlane.llm.arrow import bounded, group_starts
from voltlane.llm.bits import near_edges
from voltlane.llm.cells import compared, dealt, linked_roots, star_edges
from voltlane.llm.components import components
from voltlane.llm.vectors import by_length, cosine, matrix, unit, usable
from voltlane.scratch import staged

THRESHOLD = 0.95
LIST = 32
HELD = 32
LEAST = 32
WIDEST_CAP = 0.8
SKETCH_BITS = 128
SKETCH_MOST = 30
CELL = 1024
ROWS = 256


@lru_cache(maxsize=8)
def _tail(d: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a random unit vector's product with a direction: values, and the chance to exceed them."""
    u = np.linspace(-1, 1, 200_001)
    density = (1 - u * u).clip(1e-300) ** ((d - 3) / 2)
    above = np.cumsum(density[::-1])[::-1]
    return u, above / above[0]


class Code:
    """The product code for vectors of length ``d`` in a table of ``n``."""

    def __init__(self, d: int, n: int):
        blocks = 1 if d < 8 else 2 if d < 24 else 3
        u, above = _tail(max(d, 2))
        most = LIST / max(np.interp(WIDEST_CAP, u, above), 1e-300)
        count = min(max(64.0, LIST * n / HELD), most)
        self.size = max(2, int(np.ceil(count ** (1 / blocks))))
        if blocks == 1:
            self.size = min(self.size, 4096)
        share = min(0.5, LIST / float(self.size) ** blocks)
        # Beyond the grid the tail is followed by its logarithm.
        self.alpha = float(np.interp(np.log(share), np.log(above[::-1].clip(1e-300)), u[::-1]))
        rng = np.random.default_rng([17, d, self.size])
        self.rotation = np.linalg.qr(rng.standard_normal((d, d)))[0]
        self.cuts = np.array_split(np.arange(d), blocks)
        self.words = [unit(rng.standard_normal((self.size, len(c)))) for c in self.cuts]
        self.planes = rng.standard_normal((d, SKETCH_BITS))
        self.salt = d * 0x9E3779B97F4A7C15 % (1 << 63)

    def _decode(self, products: list[np.ndarray], need: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, filters and products above each row's ``need``, block by block without the branches that fall short."""
        best = np.array([p.max(axis=1) for p in products])
        row, left, code = np.arange(len(need)), need.copy(), np.zeros(len(need), dtype=np.int64)
        for k, p in enumerate(products):
            later = best[k + 1 :].sum(axis=0) if k + 1 < len(products) else np.zeros(len(need))
            rows, lefts, codes = [row[:0]], [left[:0]], [code[:0]]
            for at in range(0, len(row), 8192):
                own = slice(at, at + 8192)
                open_, word = np.nonzero(p[row[own]] >= (left[own] - later[row[own]])[:, None])
                r = row[own][open_]
                rows.append(r)
                lefts.append(left[own][open_] - p[r, word])
                codes.append(code[own][open_] * self.size + word)
            row, left, code = (np.concatenate(v) for v in (rows, lefts, codes))
        return row, code, need[row] - left

    def passes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of unit vectors and the filters that they pass: all above ``alpha``, and their ``LEAST`` best where
        those are more, since the code leaves some places thin."""
        turned = x @ self.rotation
        products = [turned[:, c] @ w.T for c, w in zip(self.cuts, self.words)]
        need = np.full(len(x), self.alpha * np.sqrt(len(products)))
        row, code, _ = self._decode(products, need)
        found = np.bincount(row, minlength=len(x))
        least = min(LEAST, self.size ** len(products))
        thin = np.flatnonzero(found < least)
        rows, codes = [row[found[row] >= least]], [code[found[row] >= least]]
        while len(thin):
            need[thin] -= 0.08
            r, c, value = self._decode([p[thin] for p in products], need[thin])
            n = np.bincount(r, minlength=len(thin))
            order = np.lexsort((c, -value, r))
            r, c = r[order], c[order]
            rank = np.arange(len(r)) - np.repeat(np.cumsum(n) - n, n)
            use = (n[r] >= least) & (rank < least)
            rows.append(thin[r[use]])
            codes.append(c[use])
            thin = thin[n < least]
        return np.concatenate(rows), np.concatenate(codes) ^ np.int64(self.salt)

    def sketch(self, x: np.ndarray) -> np.ndarray:
        return np.packbits(x @ self.planes > 0, axis=1).view(np.int64)


@lru_cache(maxsize=8)
def _code(d: int, n: int) -> Code:
    return Code(d, n)


def filters(reps: DataFrame, n: int) -> DataFrame:
    """(filter, rep, low, high): a row for each filter that a vector passes, with its sketch."""

    def decode(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, batch.num_rows, ROWS):
                for rows, x in by_length(batch.column(1).slice(at, ROWS)):
                    code, x = _code(x.shape[1], n), unit(x)
                    row, passed = code.passes(x)
                    sketch = code.sketch(x)[row]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(passed), pa.array(ids[at + rows[row]]), pa.array(sketch[:, 0]), pa.array(sketch[:, 1])],
                        names=["filter", "rep", "low", "high"],
                    )

    return bounded(reps).select("rep", "embedding").mapInArrow(decode, "filter long, rep long, low long, high long")


def _near(table: pa.Table):
    starts = group_starts([table.column(k) for k in ("filter", "i", "j")])
    bits = np.column_stack([table.column(k).to_numpy() for k in ("low", "high")]).view(np.uint64)
    u, v = near_edges(starts, bits, table.column("rep").to_numpy(), SKETCH_MOST)
    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def _verified(table: pa.Table, threshold: float):
    """Of each cell, a vector's links, copies counted, and the least vector that it reaches."""
    starts = group_starts([table.column(k) for k in ("component", "i", "j")])
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows]):
        cell = table.slice(a, b - a)
        rep, copies, side = (cell.column(k).to_numpy() for k in ("rep", "copies", "side"))
        x = matrix(cell.column("embedding"))
        products = (u := unit(x)) @ u.T
        linked = products >= threshold
        for r, c in np.argwhere(np.abs(products - threshold) < 1e-9):
            linked[r, c] = cosine(x[r : r + 1], x[c : c + 1])[0] >= threshold
        np.fill_diagonal(linked, False)
        if side.any():
            linked &= side[:, None] != side[None, :]
        yield pa.RecordBatch.from_arrays(
            [pa.array(rep), pa.array(rep[linked_roots(linked)]), pa.array(linked @ copies)],
            names=["rep", "root", "links"],
        )


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    n_links counts the other rows at a cosine of ``threshold`` or more that were found, equal vectors included;
    component_id is the least vec_id reachable by links. Vectors that are null, empty or zero or hold null or
    non-finite components link with nothing, nor do vectors of different lengths, nor rows without vec_id (whose
    component_id is null). Rows that repeat a vec_id count one by one if their vectors are equal."""
    rows = vectors.select("vec_id", "embedding").withColumn("ok", usable("embedding") & F.col("vec_id").isNotNull())
    reps = rows.filter("ok").groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    reps = staged(reps, "vectors")
    passed = filters(reps, reps.count())
    edges = star_edges(dealt(staged(passed, "filters"), "filter", "rep", CELL), "filter", _near)
    close = staged(components(edges, starred=True), "close")
    sizes = close.groupBy("component").agg(F.count("*").alias("n"))
    cells = dealt(close.join(reps, F.col("node") == F.col("rep")).drop("node"), "component", "rep", CELL, sizes)
    found = compared(cells, "component", "rep long, root long, links long", lambda table: _verified(table, threshold))
    found = staged(found, "links")
    groups = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    reps = reps.join(groups.withColumnRenamed("node", "rep"), "rep", "left").join(links, "rep", "left")
    reps = reps.select(
        F.col("embedding").alias("__embedding"),
        F.coalesce("component", "rep").alias("component_id"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    out = rows.join(reps, F.col("ok") & (F.col("embedding") == F.col("__embedding")), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def op6(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
