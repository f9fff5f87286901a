"""Vectors as short codes: each of 16 equal parts becomes the number of its nearest codebook entry, by ball k-means in
whole numbers.

The parts of an entry are its ball: the entry is the centre, and the largest distance of a part from it the radius.
After the first assignment, which compares with all entries, the next ones are exact with fewer comparisons:

* An entry j can only win parts of ball i if it is not farther from i than twice the radius: j is a neighbour of i. The
  radius around a centre that has moved is at most the old one plus the way it moved, so it costs no pass of its own.
* A part at distance d from its centre can only go to a neighbour within 2 d. Parts nearer than half the way to the
  nearest neighbour are the stable core of the ball and are compared with nothing.
* Neighbours in order of distance cut the rest of the ball into rings; a part in the k-th ring is compared with k
  neighbours.

All distances are squared and whole, so ties are exact (the lower entry wins) and the order of rows never matters.
Spark makes a pass over the rows for each assignment and sums up each round's parts by entry; a task keeps one sum for
each entry, and the driver gets the codebooks only, ``entries`` times the length of a vector.
"""

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlane.llm.arrow import bounded
from voltlane.scratch import staged

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
# Components are held within this, so that sums of them stay exact; errors that exceed a long are held at the largest.
MOST = 1 << 36
LONGEST = (1 << 63) - 1
EXACT = 1 << 53
ROWS = 4096
BROADCAST_LABELS = 100_000
SALTS = 16


# Whole numbers


def whole(column, parts: int, width: int) -> np.ndarray:
    """Vectors of a list column as whole numbers, (rows, parts, width): floor(``SCALE`` x). A vector is cut into ``parts``
    equal parts by its own length; a part of fewer components ends in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    flat = np.clip(flat, -MOST, MOST).astype(np.int64)
    out = np.zeros((len(size), parts, width), dtype=np.int64)
    row = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    own = np.maximum(-(-size // parts), 1)[row]
    out[row, place // own, place % own] = flat
    return out


def exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays as doubles if their squared distances are exact in doubles, or else as Python numbers."""
    largest = max((int(np.abs(a).max(initial=0)) for a in arrays), default=0)
    kind = np.float64 if 4 * largest * largest * max(1, arrays[0].shape[-1]) < EXACT else object
    return [a.astype(kind) for a in arrays]


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows with rows, one by one."""
    return ((a - b) ** 2).sum(axis=-1)


def squared_all(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` with all of ``b``."""
    return (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]


# Codebooks and balls


@dataclass
class Codebooks:
    """Entries (parts, entries, width), and the radius of each entry's ball, or more; none before the first assignment."""

    entries: np.ndarray
    radius: np.ndarray | None = None

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()

    def moved(self, count: np.ndarray, sums: np.ndarray, reach: np.ndarray) -> "Codebooks":
        """The codebooks after a round, from the number, the sums and the largest squared distance of each entry's parts.
        Unused entries stay."""
        new = self.entries.copy()
        used = count > 0
        new[used] = sums[used] // count[used][:, None]
        way = np.sqrt(squared(*exact(new, self.entries)).astype(np.float64))
        return Codebooks(new.astype(np.int64), (np.sqrt(reach) + way) * (1 + 1e-9) + 1e-3)


class Balls:
    """The neighbours of each entry of one part's codebook, nearest first."""

    def __init__(self, entries: np.ndarray, radius: np.ndarray):
        gap = squared_all(entries, entries)
        gap[np.arange(len(gap)), np.arange(len(gap))] = -1
        self.order = np.argsort(gap, axis=1, kind="stable")[:, 1:]
        self.gap = np.take_along_axis(gap, self.order, axis=1)
        self.entries = entries
        self.neighbours = (self.gap.astype(np.float64) <= 4 * (radius * radius)[:, None]).sum(axis=1)

    def nearest(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest entries and squared distances of parts that were in the balls ``own``, and how many comparisons it
        took."""
        first = squared(x, self.entries[own])
        best, entry = first.copy(), own.copy()
        rows, compared = np.arange(len(x)), 0
        for ring in range(self.order.shape[1]):
            ball = own[rows]
            rows = rows[(ring < self.neighbours[ball]) & (self.gap[ball, ring] <= 4 * first[rows])]
            if not len(rows):
                break
            other = self.order[own[rows], ring]
            d = squared(x[rows], self.entries[other])
            better = (d < best[rows]) | ((d == best[rows]) & (other < entry[rows]))
            best[rows[better]], entry[rows[better]] = d[better], other[better]
            compared += len(rows)
        return entry, best, compared


def assigned(values: np.ndarray, books: Codebooks, codes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entries (rows, parts) and their squared distances, of ``values`` (rows, parts, width). With ``codes`` of the
    round before, by its balls."""
    new = np.zeros(values.shape[:2], dtype=np.uint8)
    away = []
    for p in range(values.shape[1]):
        x, entries = exact(values[:, p], books.entries[p])
        if codes is not None:
            entry, d, _ = Balls(entries, books.radius[p]).nearest(x, codes[:, p].astype(np.int64))
        else:
            blocks = [squared_all(x[k : k + ROWS], entries) for k in range(0, len(x), ROWS)]
            entry = np.concatenate([b.argmin(axis=1) for b in blocks])
            d = np.concatenate([b.min(axis=1) for b in blocks])
        new[:, p] = entry
        away.append(d)
    return new, np.stack(away, axis=1)


# Passes over the rows


def _codes(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), PARTS)


def _values(column, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), PARTS, width)


def _assigning(books: Codebooks, width: int, raw: bool):
    """Rows with new codes; ``raw`` ones have the vector as it came and no code yet."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            values = whole(batch.column("vector"), PARTS, width) if raw else _values(batch.column("vector"), width)
            codes, away = assigned(values, books, None if raw else _codes(batch.column("code")))
            error = np.minimum(away.sum(axis=1), LONGEST) if away.dtype == object else away.sum(axis=1)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(values) + 1) * PARTS * width, pa.int32()), pa.array(values.reshape(-1))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), lists, pa.array([c.tobytes() for c in codes], pa.binary()),
                 pa.array([int(e) for e in error], pa.int64())],
                names=["id", "label", "vector", "code", "error"],
            )

    return run


def _summing(books: Codebooks, width: int):
    """For each part and entry in a task: how many, the sum of each component, and the largest squared distance."""

    def run(batches):
        parts, entries = books.entries.shape[:2]
        count = np.zeros((parts, entries), dtype=np.int64)
        sums = np.zeros((parts, entries, width), dtype=np.int64)
        reach = np.zeros((parts, entries))
        for batch in batches:
            values, codes = _values(batch.column("vector"), width), _codes(batch.column("code"))
            for p in range(parts):
                entry = codes[:, p].astype(np.int64)
                count[p] += np.bincount(entry, minlength=entries)
                np.add.at(sums[p], entry, values[:, p])
                x, own = exact(values[:, p], books.entries[p])
                np.maximum.at(reach[p], entry, squared(x, own[entry]).astype(np.float64))
        part, entry = np.nonzero(count)
        if not len(part):
            return
        total = np.concatenate([count[part, entry][:, None], sums[part, entry]], axis=1)
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(part) + 1) * (width + 1), pa.int32()), pa.array(total.reshape(-1))
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(entry), lists, pa.array(reach[part, entry])], names=["part", "entry", "total", "reach"]
        )

    return run


def _after_round(rows: DataFrame, books: Codebooks, width: int) -> Codebooks:
    sums = bounded(rows.select("vector", "code")).mapInArrow(
        _summing(books, width), "part long, entry long, total array<long>, reach double"
    )
    sums = sums.select("part", "entry", "reach", F.posexplode("total").alias("position", "value"))
    sums = sums.groupBy("part", "entry", "position").agg(
        F.sum(F.col("value").cast("decimal(38,0)")).alias("value"), F.max("reach").alias("reach")
    )
    found = sums.toArrow()
    total = np.zeros((*books.entries.shape[:2], width + 1), dtype=object)
    reach = np.zeros(books.entries.shape[:2])
    part, entry, position = (found.column(c).to_numpy() for c in ("part", "entry", "position"))
    total[part, entry, position] = [int(v) for v in found.column("value").to_pylist()]
    reach[part, entry] = found.column("reach").to_numpy()
    return books.moved(total[..., 0], total[..., 1:], reach)


def finite(vector: Column) -> Column:
    """Is the vector there, and all its components finite numbers?"""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def first_codebooks(rows: DataFrame, width: int) -> Codebooks:
    """The parts of the ``ENTRIES`` smallest ids; where an id repeats, of the least of its vectors."""
    known = rows.filter(F.col("id").isNotNull())
    ids = [r["id"] for r in known.select("id").distinct().orderBy("id").limit(ENTRIES).collect()]
    first = known.filter(F.col("id").isin(ids)).groupBy("id").agg(F.min("vector").alias("vector")).toArrow()
    vectors = whole(first.column("vector"), PARTS, width)[np.argsort(first.column("id").to_numpy(), kind="stable")]
    return Codebooks(vectors.transpose(1, 0, 2).copy())


def encode(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> tuple[DataFrame, Codebooks]:
    """(``id``, ``label``, code, error) of each vector, and the final codebooks.

    code: a byte for each part, its entry's number. error: squared distances to the entries, summed over the parts.

    Vectors that are null or hold null or non-finite components are left out; zero vectors and those without components
    are not. Rows with a null ``id`` are encoded, but never begin a codebook. Repeated rows each have their row, and count
    as often; where an ``id`` has several vectors, the least begins the codebook. With fewer than ``ENTRIES`` ids there are
    as many entries as ids; if there is no id at all, the one entry is zero. Vectors may differ in length: each is cut into
    ``PARTS`` parts by its own length (the last may be short), and short parts end in zeros. Components
    beyond ``MOST`` / ``SCALE`` count as that. Other columns are ignored, whatever they are called. Ids are whole numbers."""
    rows = vectors.select(F.col(id).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    rows = rows.filter(finite(F.col("vector")))
    longest = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    width = max(1, -(-longest // PARTS)) if longest else 1
    books = first_codebooks(rows, width)
    if not books.entries.shape[1]:
        books = Codebooks(np.zeros((PARTS, 1, width), dtype=np.int64))
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"id {types['id']}, label {types['label']}, vector array<long>, code binary, error long"
    coded = None
    for _ in range(ROUNDS):
        source, raw = (rows, True) if coded is None else (coded, False)
        coded = staged(bounded(source).mapInArrow(_assigning(books, width, raw), schema), "codes")
        books = _after_round(coded, books, width)
    coded = bounded(coded).mapInArrow(_assigning(books, width, False), schema)
    return coded.select(F.col("id").alias(id), F.col("label").alias(label), "code", "error"), books


def with_label_error(coded: DataFrame, label: str = "label") -> DataFrame:
    """``coded`` with label_error: the errors summed over rows of equal labels, nulls together. Labels are summed before
    the shuffle; their sums are broadcast if they are few, and dealt over ``SALTS`` copies if not."""
    coded = staged(coded, "errors")
    sums = coded.groupBy(label).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("label_error"))
    sums = sums.withColumn("label_error", F.least("label_error", F.lit(LONGEST).cast("decimal(38,0)")).cast("long"))
    sums = staged(sums.withColumnRenamed(label, "__label"), "label-errors")
    if sums.count() <= BROADCAST_LABELS:
        return coded.join(F.broadcast(sums), F.col(label).eqNullSafe(F.col("__label")), "left").drop("__label")
    sums = sums.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = coded.withColumn("__own", F.pmod(F.xxhash64(*coded.columns), F.lit(SALTS)).cast("int"))
    on = F.col(label).eqNullSafe(F.col("__label")) & (F.col("__own") == F.col("__salt"))
    return salted.join(sums, on, "left").drop("__label", "__own", "__salt")


def op12(spark, sf_dir: str) -> DataFrame:
    coded, books = encode(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return with_label_error(coded).select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(books.sha256()).alias("codebooks_sha256"),
    )


_ASSIGN = """
a{k} AS (
  SELECT rid, part, least_of % 64 AS entry, least_of // 64 AS d FROM (
    SELECT rid, x.part, min((list_inner_product(v, v) - 2 * list_inner_product(v, c) + list_inner_product(c, c))::BIGINT * 64 + entry) AS least_of
    FROM x JOIN b{k} AS b ON x.part = b.part GROUP BY rid, x.part)
),"""
_MOVE = """
m{k} AS (
  SELECT part, entry, list(mean ORDER BY position) AS c FROM (
    SELECT part, entry, position, floor(sum(component)::BIGINT / count(*))::DOUBLE AS mean FROM (
      SELECT a.part, a.entry, unnest(v) AS component, unnest(range(len(v))) AS position FROM x JOIN a{k} AS a USING (rid, part))
    GROUP BY part, entry, position)
  GROUP BY part, entry
),
b{next} AS (SELECT part, entry, coalesce(m.c, b.c) AS c FROM b{k} AS b LEFT JOIN m{k} AS m USING (part, entry)),"""
# Doubles hold these whole numbers exactly; vectors of one length.
SQL = (
    """
WITH kept AS (
  SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
),
x AS (
  SELECT rid, part, v[part * len(v) // 16 + 1 : (part + 1) * len(v) // 16] AS v
  FROM (SELECT rid, v, unnest(range(16)) AS part FROM kept)
),
b0 AS (
  SELECT part, entry, v AS c FROM x
  JOIN (SELECT rid, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < 64) USING (rid)
),"""
    + "".join(_ASSIGN.format(k=k) + _MOVE.format(k=k, next=k + 1) for k in range(ROUNDS))
    + _ASSIGN.format(k=ROUNDS)
    + """
books AS (
  SELECT sha256(string_agg(list_aggregate(list_transform(c, lambda e: e::BIGINT), 'string_agg', ','), ',' ORDER BY part, entry)) AS codebooks_sha256
  FROM b2
),
coded AS (
  SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY rid
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (rid) CROSS JOIN books
"""
)
