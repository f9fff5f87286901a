"""Jaccard join of word-shingle sets by chosen paths.

A set is represented by ``T`` minhashes; its token at place i is (i, minhash i). A run is a tree: each node picks places
at random, ``1 / threshold`` of them on average, the same for all sets in the node, and sends a set to one child per
picked place, the one of its token there. So similar sets share a path more often than not. A node of up to ``LIMIT``
sets is compared by brute force; a larger one splits again, up to ``DEPTH`` levels, and what is still larger is cut into
cells that hold any two of its sets once. As many runs are made as the target recall needs at the threshold.

All runs go level by level as one table of (path, set). Sets with equal shingles are one set from the start. Nodes of
equal members are compared once. Minhashes only say which sets may be similar: their connected groups are then joined
exactly, on the shingles of the whole texts, with every text shuffled once (more in groups above ``CELL``).
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlane.llm.arrow import bounded, group_starts, slices, strings
from voltlane.llm.cells import compared, dealt, linked_roots, star_edges
from voltlane.llm.components import components
from voltlane.llm.shingles import N, mix, shingle_sets
from voltlane.scratch import staged

THRESHOLD = (4, 5)
RECALL = 0.999
PLACES = 64
DEPTH = 3
LIMIT = 256
CELL = 512
BROADCAST_TEXTS = 500_000
MINHASHES = T.StructType([T.StructField("sid", T.LongType()), T.StructField("sketch", T.BinaryType())])
_XOR, _TIMES = (np.random.default_rng(s).integers(1, 1 << 63, PLACES, dtype=np.uint64) | np.uint64(1) for s in (31, 37))
_PLACE_KEY = np.random.default_rng(41).integers(1, 1 << 63, PLACES, dtype=np.uint64)


def runs_needed(threshold: float, recall: float, depth: int = DEPTH, places: int = PLACES) -> int:
    """Runs after which sets at the threshold share a node of ``depth`` with probability ``recall``: a place is picked
    with chance 1 / (threshold * places) and then shared with chance ``threshold``."""
    meet = 1.0
    for _ in range(depth):
        meet = 1 - (1 - meet / places) ** places
    return math.ceil(math.log(1 - recall) / math.log(1 - meet))


def _identity(hashes: np.ndarray) -> int:
    """64 bits that stand for a set."""
    return int(mix(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64, keepdims=True)).view(np.int64)[0])


def _minhashes(sets: list[np.ndarray]) -> np.ndarray:
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets)])[:-1]
    out = np.empty((len(sets), PLACES), dtype=np.uint32)
    for i in range(PLACES):
        least = np.minimum.reduceat((flat ^ _XOR[i]) * _TIMES[i], starts)
        out[:, i] = (least >> np.uint64(32)).astype(np.uint32)
    return out


def sketches(docs: DataFrame, n: int = N) -> DataFrame:
    """doc_id, sid (the set's 64 bits, null without a word) and minhashes."""

    @F.arrow_udf(MINHASHES)
    def sketch(texts: pa.Array) -> pa.Array:
        ids, rows = [], []
        for part in slices(texts):
            sets = shingle_sets(strings(part), n)
            full = [s for s in sets if len(s)]
            hashes = iter(_minhashes(full) if full else [])
            for s in sets:
                ids.append(_identity(s) if len(s) else None)
                rows.append(next(hashes).tobytes() if len(s) else None)
        return pa.StructArray.from_arrays([pa.array(ids, pa.int64()), pa.array(rows, pa.binary())], names=["sid", "sketch"])

    return bounded(docs).select("doc_id", sketch.asNondeterministic()("text").alias("s")).select("doc_id", "s.*")


def with_sets(docs: DataFrame, n: int, name: str) -> DataFrame:
    """``docs`` with the sid of each text as column ``name``."""

    @F.arrow_udf(T.LongType())
    def sid(texts: pa.Array) -> pa.Array:
        sets = [s for part in slices(texts) for s in shingle_sets(strings(part), n)]
        return pa.array([_identity(s) if len(s) else None for s in sets], pa.int64())

    return bounded(docs).withColumn(name, sid.asNondeterministic()("text"))


def _children(paths: np.ndarray, sketch: np.ndarray, chance: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and paths of the children: the places that each row's node picks, with the row's tokens there."""
    drawn = mix(paths[:, None] ^ _PLACE_KEY[None, :])
    row, place = np.nonzero(drawn < np.uint64(int(chance * 2**64)))
    token = (sketch[row, place].astype(np.uint64) << np.uint64(8)) | place.astype(np.uint64)
    return row, mix(mix(paths[row]) + token * np.uint64(0x9E3779B97F4A7C15))


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, PLACES)


def _split(rows: DataFrame, roots: list[int] | None, chance: float) -> DataFrame:
    """(path, sid) one level down: of ``rows`` (path, sid, sketch), or of the roots of all runs."""

    def split(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                sketch, sid = _matrix(part.column("sketch")), part.column("sid").to_numpy()
                if roots is None:
                    starts = [part.column("path").to_numpy().view(np.uint64)]
                else:
                    starts = [np.full(len(sid), r, dtype=np.uint64) for r in roots]
                for paths in starts:
                    row, child = _children(paths, sketch, chance)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(child.view(np.int64)), pa.array(sid[row])], names=["path", "sid"]
                    )

    return rows.mapInArrow(split, "path long, sid long")


def spanning(linked: np.ndarray, side: np.ndarray) -> np.ndarray:
    """For each row of a cell the row that one edge should go to, or itself. The edges connect what ``linked`` does: in a cell
    of one block every row goes to the least that it reaches. In a cell of two blocks, whose own cells connect the rows of
    each, only the least row of what is connected inside a block does. So a large group has an edge for each row, and a
    few for each two blocks, not an edge for each row and block."""
    root = linked_roots(linked)
    if side.any():
        inside = linked_roots(linked & (side[:, None] == side[None, :]))
        own = np.arange(len(root))
        root = np.where(inside == own, root, own)
    return root


def _candidates(table: pa.Table, least: int):
    """Edges of each cell's groups by minhashes: every set to the least that it reaches."""
    starts = group_starts([table.column(k) for k in ("path", "i", "j")])
    sketch, sid, side = _matrix(table.column("sketch")), *(table.column(k).to_numpy() for k in ("sid", "side"))
    u, v = [], []
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(sid)]):
        if b - a < 2:
            continue
        equal = np.zeros((b - a, b - a), dtype=np.uint8)
        for place in range(PLACES):
            equal += sketch[a:b, place][:, None] == sketch[a:b, place][None, :]
        root = spanning(equal >= least, side[a:b])
        moved = np.flatnonzero(root != np.arange(b - a))
        u.append(sid[a:b][moved])
        v.append(sid[a:b][root[moved]])
    if u:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], names=["u", "v"])


def candidate_edges(reps: DataFrame, threshold: float, recall: float) -> DataFrame:
    """Edges between sets that met in a small node and whose minhashes agree nearly as often as the threshold, as stars."""
    chance = min(1.0, 1 / (threshold * PLACES))
    roots = mix(np.arange(1, 1 + runs_needed(threshold, recall), dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    sketch = reps.select("sid", "sketch")
    level, small = _split(sketch, [int(r) for r in roots], chance), None
    for depth in range(DEPTH):
        level = staged(level, "paths")
        nodes = level.groupBy("path").agg(F.count("*").alias("n"), F.sum(F.xxhash64("sid").cast("decimal(38,0)")).alias("members"))
        nodes = staged(nodes.filter("n > 1"), "nodes")
        last = depth == DEPTH - 1
        leaves = nodes if last else nodes.filter(F.col("n") <= LIMIT)
        leaves = leaves.groupBy("n", "members").agg(F.min("path").alias("path"))
        leaf = level.join(leaves.select("path", "n", "members"), "path")
        small = leaf if small is None else small.unionByName(leaf)
        if last or nodes.filter(F.col("n") > LIMIT).isEmpty():
            break
        large = level.join(nodes.filter(F.col("n") > LIMIT).select("path"), "path", "left_semi")
        level = _split(large.join(sketch, "sid").select("path", "sid", "sketch"), None, chance)
    least = max(1, math.floor(PLACES * threshold - 4 * math.sqrt(PLACES * threshold * (1 - threshold))))
    rows = small.join(sketch, "sid").select("path", "sid", "sketch", "n")
    sizes = small.groupBy("path").agg(F.first("n").alias("n"))
    cells = dealt(rows.drop("n"), "path", "sid", LIMIT, sizes)
    return star_edges(cells, "path", lambda table: _candidates(table, least))


def shared_counts(sets: list[np.ndarray], block: int = 1 << 22) -> np.ndarray:
    """Sizes of all intersections, by products of the sets' incidence rows over the hashes that at least two have."""
    m, size = len(sets), np.array([len(s) for s in sets])
    if m == 2:
        return np.array([[0, k := len(np.intersect1d(*sets, assume_unique=True))], [k, 0]]) + np.diag(size)
    owner = np.repeat(np.arange(m), size)
    hashes, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1
    use = count[place] > 1
    owner, place = owner[use], number[place[use]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    shared = np.zeros((m, m), dtype=np.float64)
    width = max(256, block // m)
    for at in range(0, int(number[-1]) + 1 if len(number) else 0, width):
        a, b = np.searchsorted(place, [at, at + width])
        rows = np.zeros((m, min(width, int(number[-1]) + 1 - at)), dtype=np.float32)
        rows[owner[a:b], place[a:b] - at] = 1
        shared += rows @ rows.T
    np.fill_diagonal(shared, size)
    return shared.astype(np.int64)


def _links(table: pa.Table, n: int, threshold: tuple[int, int]):
    """Exact links of each cell: of every set the rows it is linked to, and the set that an edge should go to."""
    over, under = threshold
    starts = group_starts([table.column(k) for k in ("component", "i", "j")])
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows]):
        cell = table.slice(a, b - a)
        sid, copies, side = (cell.column(k).to_numpy() for k in ("sid", "copies", "side"))
        sets = [s for part in slices(cell.column("text").combine_chunks()) for s in shingle_sets(strings(part), n)]
        # A doc_id that repeats with another text brings rows that are not meant.
        meant = np.array([len(s) > 0 and _identity(s) == i for s, i in zip(sets, sid.tolist())])
        _, first = np.unique(sid[meant], return_index=True)
        pick = np.flatnonzero(meant)[first]
        if len(pick) < 2:
            continue
        sid, copies, side, sets = sid[pick], copies[pick], side[pick], [sets[k] for k in pick]
        shared = shared_counts(sets)
        size = shared.diagonal()
        linked = shared * under >= over * (size[:, None] + size[None, :] - shared)
        np.fill_diagonal(linked, False)
        root = spanning(linked, side)
        if side.any():
            linked &= side[:, None] != side[None, :]
        yield pa.RecordBatch.from_arrays(
            [pa.array(sid), pa.array(sid[root]), pa.array(linked @ copies)], names=["sid", "root", "links"]
        )


def _classes(docs: DataFrame, n: int, threshold: tuple[int, int], recall: float) -> DataFrame:
    """Per row of ``docs``: doc_id, sid, component (a number of its class), class_id, n_links; sid, component and n_links are
    null for rows that take no part."""
    own = staged(sketches(docs.select("doc_id", "text"), n), "sketches")
    usable = own.filter(F.col("doc_id").isNotNull() & F.col("sid").isNotNull())
    reps = usable.groupBy("sid").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.any_value("sketch").alias("sketch")
    )
    reps = staged(reps, "sets")
    edges = candidate_edges(reps, threshold[0] / threshold[1], recall)
    close = staged(components(edges, starred=True), "close")
    wanted = staged(close.join(reps, close["node"] == reps["sid"]).select("component", "sid", "rep", "copies"), "wanted")
    if wanted.count() <= BROADCAST_TEXTS:
        wanted = F.broadcast(wanted)
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("rep"))
    sizes = close.groupBy("component").agg(F.count("*").alias("n"))
    cells = dealt(texts.select("component", "sid", "copies", "text"), "component", "sid", CELL, sizes)
    found = compared(cells, "component", "sid long, root long, links long", lambda table: _links(table, n, threshold))
    found = staged(found, "links")
    groups = components(found.select(F.col("sid").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("sid").agg(F.sum("links").alias("links"))
    groups = groups.select(F.col("node").alias("sid"), "component")
    sets = reps.select("sid", "rep", "copies").join(groups, "sid", "left").join(links, "sid", "left")
    sets = staged(sets.withColumn("component", F.coalesce("component", "sid")), "classes")
    least = sets.groupBy("component").agg(F.min("rep").alias("class_id"))
    sets = sets.join(least, "component").select(
        F.col("sid").alias("__sid"),
        "component",
        "class_id",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    on = (F.col("sid") == F.col("__sid")) & F.col("doc_id").isNotNull()
    return own.select("doc_id", "sid").join(sets, on, "left").drop("__sid")


def ngram_join(docs: DataFrame, n: int = N, threshold: tuple[int, int] = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, class_id, n_links, kept.

    Two rows are linked if the Jaccard similarity of their sets of ``n``-word shingles is at least ``threshold`` (a
    fraction, compared in whole numbers). n_links counts the other rows linked directly, copies one by one; class_id
    is the least doc_id that links reach; kept marks the row that stands for the class. Texts of fewer than ``n``
    words have one shingle; null texts and texts without a word are linked with nothing. A row without doc_id takes no
    part (class_id null, kept). Rows that repeat both doc_id and text count as rows, and are all marked kept or none.
    """
    rows = _classes(docs, n, threshold, recall)
    class_id = F.coalesce("class_id", "doc_id")
    return rows.select(
        "doc_id",
        class_id.alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce(F.col("doc_id") == class_id, F.lit(True)).alias("kept"),
    )


def representatives(docs: DataFrame, n: int = N, threshold: tuple[int, int] = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One document of each class of ``ngram_join``, the one of least doc_id; of rows that repeat doc_id and text, one.
    Columns stay as they are; rows without doc_id stay.

    Where a doc_id repeats with other texts, each text is decided on by itself: it goes only if another text, or the same
    one under a smaller doc_id, stands for its class. Of several texts of one doc_id that stand for a class, the one of
    least set number stays. Texts without a word always stay."""
    rows = staged(_classes(docs, n, threshold, recall).filter(F.col("doc_id").isNotNull()), "classes")
    repeated = staged(rows.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id"), "repeated")
    gone = rows.filter(F.col("class_id") != F.col("doc_id")).select("doc_id").distinct()
    gone = staged(gone.join(repeated, "doc_id", "left_anti"), "gone")
    if gone.count() <= BROADCAST_TEXTS:
        gone = F.broadcast(gone)
    names = [F.col(f"`{c}`") for c in docs.columns]
    left = docs.join(gone, "doc_id", "left_anti").select(*names)
    if repeated.isEmpty():
        return left
    first = rows.filter(F.col("sid").isNotNull()).groupBy("component").agg(F.min(F.struct("doc_id", "sid")).alias("first"))
    first = staged(first.select("first.*").join(repeated, "doc_id", "left_semi"), "first")
    texts = with_sets(docs.join(repeated, "doc_id", "left_semi").select(*names), n, "__sid")
    stands = first.select(F.col("doc_id").alias("__doc_id"), F.col("sid").alias("__first"))
    found = texts.join(stands, (F.col("doc_id") == F.col("__doc_id")) & (F.col("__sid") == F.col("__first")), "left")
    stays = found.filter(F.col("__first").isNotNull()).dropDuplicates(["doc_id", "__sid"]).select(*names)
    wordless = found.filter(F.col("__sid").isNull()).dropDuplicates(["doc_id", "text"]).select(*names)
    return left.join(repeated, "doc_id", "left_anti").unionByName(stays).unionByName(wordless)


def op10(spark, sf_dir: str) -> DataFrame:
    return ngram_join(spark.read.parquet(f"{sf_dir}/documents.parquet"))
