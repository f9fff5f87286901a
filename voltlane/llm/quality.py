"""Quality of texts by positive-unlabelled learning.

Only texts known to be good are trusted as labels; everything else is unlabelled web text, a mixture of good and bad with
an unknown share of good ones, the class prior. The classifier is logistic over measures of a text's surface: how classes
of characters follow each other, how words and lines repeat, how long they are. It minimises the non-negative unbiased
risk: the loss of the positives as positives, and the loss of unlabelled text as negative less the part that the positives
in it account for. Where that difference falls below zero on a batch, which only overfitting does, a step is taken to undo
it.

The class prior is estimated from the same data. Two first classifiers tell positives from unlabelled texts, each on half
of the rows, and score the other half. The share of unlabelled texts above a score, over the share of positives above it,
is never less than the prior (up to chance), and is the prior where no bad text scores that high. The score is chosen
where the ratio and its margin of error are smallest.

The classifiers are fitted on at most ``POSITIVES`` trusted and ``UNLABELLED`` unlabelled rows, drawn by hash. The prior
takes all rows: Spark counts scores into ``BINS`` bins.
"""

import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlane.llm.arrow import bounded, slices, strings
from voltlane.scratch import staged

POSITIVES, UNLABELLED = 20_000, 20_000
BINS = 1000
ROWS = 1024
QUANTILES = 8
EPOCHS, BATCH, RATE, RIDGE = 60, 512, 0.01, 1e-3
DOUBT, LOWER_BY = 0.1, 0.99
FEWEST = 20
PRIOR = 0.5

LOWER, UPPER, LETTER, DIGIT, SPACE, LINE, STOP, COMMA, QUOTE, DASH, SYMBOL, OTHER = range(12)
CLASSES = 12
MEASURES = 12


# Measures of texts


@cache
def _classes() -> np.ndarray:
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    by_category = {"Ll": LOWER, "Lu": UPPER, "Lt": UPPER, "Pd": DASH, "Pc": DASH, "Ps": QUOTE, "Pe": QUOTE, "Pi": QUOTE, "Pf": QUOTE}
    by_kind = {"L": LETTER, "M": LETTER, "N": DIGIT, "Z": SPACE, "S": SYMBOL, "P": SYMBOL}
    for code in range(0x110000):
        category = unicodedata.category(chr(code))
        table[code] = by_category.get(category, by_kind.get(category[0], OTHER))
    for group, kind in ((".!?…。！？", STOP), (",;:、，；：", COMMA), ("\"'", QUOTE), (" \t", SPACE), ("\n\r\v\f  ", LINE)):
        for c in group:
            table[ord(c)] = kind
    return table


def _spans(new: np.ndarray, use: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where spans begin, and a hash of the used characters of each."""
    start = np.flatnonzero(new)
    if not len(start):
        return start, np.zeros(0, dtype=np.uint64)
    place = (np.arange(len(codes)) - start[np.maximum(np.cumsum(new) - 1, 0)]).astype(np.uint64)
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * (place * np.uint64(2) + np.uint64(0x9E3779B97F4A7C15))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return start, np.add.reduceat(np.where(use, mixed, np.uint64(0)), start)


def _repeats(text: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of n texts, how many different keys it has and how often its most frequent one."""
    low = np.uint64(64 - int(n).bit_length())
    key = np.sort((text.astype(np.uint64) << low) | (key >> (np.uint64(64) - low)))
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
    own = (key[starts] >> low).astype(np.int64)
    most = np.zeros(n)
    np.maximum.at(most, own, np.diff(np.append(starts, len(key))))
    return np.bincount(own, minlength=n).astype(float), most


def measured(texts: list[str]) -> np.ndarray:
    """The measures of each text: ``MEASURES`` of its words and lines, then the roots of the shares of pairs of classes.
    A text without characters has zeros."""
    n = len(texts)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    size = np.array([len(t) for t in texts], dtype=np.int64)
    text = np.repeat(np.arange(n), size)
    kind = _classes()[codes].astype(np.int64)
    together = np.zeros(len(codes), dtype=bool)
    together[1:] = text[1:] == text[:-1]
    count = lambda rows: np.bincount(text[rows], minlength=n).astype(float)
    share = lambda a, b: np.divide(a, b, out=np.zeros(n), where=b > 0)
    after = np.flatnonzero(together)
    pairs = np.bincount(text[after] * CLASSES**2 + kind[after - 1] * CLASSES + kind[after], minlength=n * CLASSES**2)
    pairs = np.sqrt(pairs.reshape(n, -1) / np.maximum(size - 1, 1)[:, None])

    blank = (kind == SPACE) | (kind == LINE)
    in_word = ~blank
    new_word = in_word.copy()
    new_word[1:] &= blank[:-1] | ~together[1:]
    word, word_key = _spans(new_word, in_word, codes)
    owner = text[word]
    words = np.bincount(owner, minlength=n).astype(float)
    of_word = lambda mask: np.add.reduceat(mask.astype(np.int64), word) if len(word) else np.zeros(0)
    letters = of_word(kind <= LETTER)
    follows = np.zeros(len(word), dtype=bool)
    follows[1:] = owner[1:] == owner[:-1]
    again = follows.copy()
    again[1:] &= word_key[1:] == word_key[:-1]
    distinct, top = _repeats(owner, word_key, n)
    second = np.flatnonzero(follows)
    two = word_key[second] * np.uint64(0x9E3779B97F4A7C15) ^ word_key[second - 1]
    distinct_pairs, _ = _repeats(owner[second], two, n)

    new_line = ~together
    new_line[1:] |= kind[:-1] == LINE
    line, line_key = _spans(new_line, kind != LINE, codes)
    lines = np.bincount(text[line], minlength=n).astype(float)
    distinct_lines, _ = _repeats(text[line], line_key, n)

    same = together.copy()
    same[1:] &= (codes[1:] == codes[:-1]) & in_word[1:]
    columns = [
        np.log1p(size),
        np.log1p(words),
        share(count(in_word), words),
        share(np.bincount(owner, weights=letters == 0, minlength=n), words),
        share(np.bincount(owner, weights=again, minlength=n), words),
        share(distinct, words),
        share(top, words),
        share(distinct_pairs, words - 1),
        share(lines - distinct_lines, lines),
        np.log1p(share(size.astype(float), lines)),
        share(count(same), size),
        share(count(kind == UPPER), count(kind <= LETTER)),
    ]
    return np.concatenate([np.stack(columns, axis=1), pairs], axis=1)


def _parts(texts: pa.Array):
    """The measures of an Arrow array of texts, part by part."""
    for part in slices(texts):
        for k in range(0, len(part), ROWS):
            yield measured(strings(part.slice(k, ROWS)))


# The classifier


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


@dataclass
class Classifier:
    """Logistic over measures, scaled, and over the quantile that each of the first ``MEASURES`` falls in."""

    centre: np.ndarray
    scale: np.ndarray
    cuts: np.ndarray
    weights: np.ndarray | None = None
    prior: float = PRIOR

    @classmethod
    def scaled(cls, rows: np.ndarray) -> "Classifier":
        spread = rows.std(axis=0)
        cuts = np.quantile(rows[:, :MEASURES], np.arange(1, QUANTILES) / QUANTILES, axis=0)
        return cls(rows.mean(axis=0), np.where(spread > 1e-9, spread, 1.0), cuts)

    def inputs(self, rows: np.ndarray) -> np.ndarray:
        scaled = np.clip((rows - self.centre) / self.scale, -5, 5)
        above = (rows[:, None, :MEASURES] > self.cuts[None]).reshape(len(rows), -1)
        return np.concatenate([scaled, above, np.ones((len(rows), 1))], axis=1)

    def odds(self, rows: np.ndarray) -> np.ndarray:
        return self.inputs(rows) @ self.weights

    def scores(self, texts: pa.Array) -> np.ndarray:
        parts = [_sigmoid(self.odds(rows)) for rows in _parts(texts)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def fitted(self, positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> "Classifier":
        """Least non-negative unbiased risk with logistic loss, in batches of both kinds of rows; the weights are those of
        the last quarter of the steps, averaged."""
        rng = np.random.default_rng(0)
        p, u = self.inputs(positive), self.inputs(unlabelled)
        w = np.zeros(p.shape[1])
        first, second, mean, kept = np.zeros_like(w), np.zeros_like(w), np.zeros_like(w), 0
        batches = max(4, -(-max(len(p), len(u)) // BATCH))
        steps = EPOCHS * batches
        step = 0
        for _ in range(EPOCHS):
            for own, other in zip(np.array_split(_dealt(rng, len(p), len(u)), batches), np.array_split(_dealt(rng, len(u), len(p)), batches)):
                step += 1
                zp, zu = p[own] @ w, u[other] @ w
                negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
                rest = u[other].T @ _sigmoid(zu) / len(other) - prior * (p[own].T @ _sigmoid(zp)) / len(own)
                if negative < 0:
                    slope = -rest
                else:
                    slope = rest - prior * (p[own].T @ _sigmoid(-zp)) / len(own)
                slope += RIDGE * w
                first = 0.9 * first + 0.1 * slope
                second = 0.999 * second + 0.001 * slope * slope
                w = w - RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
                if 4 * step > 3 * steps:
                    mean, kept = mean + w, kept + 1
        return Classifier(self.centre, self.scale, self.cuts, mean / kept, prior)


def _dealt(rng, n: int, other: int) -> np.ndarray:
    """Rows in random order; the shorter of two tables is gone through as often as the longer one needs."""
    return np.concatenate([rng.permutation(n) for _ in range(max(1, round(other / n)))])


def prior_of(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives in unlabelled rows, from both kinds' numbers of rows in bins of ascending score. The ratio can only
    err upwards, for bad texts above the score, so it is lowered by a hundredth."""
    up, uu = np.cumsum(positive[::-1]), np.cumsum(unlabelled[::-1])
    p, u = up / up[-1], uu / uu[-1]
    margin = np.sqrt(np.log(4 / DOUBT) / 2) * (1 / np.sqrt(up[-1]) + 1 / np.sqrt(uu[-1]))
    use = p > 0
    best = np.argmin(np.where(use, (u + 1.01 * margin) / np.where(use, p, 1), np.inf))
    return float(np.clip(LOWER_BY * u[best] / p[best], 0.01, 0.99))


# Learning from tables


def _drawn(n: int, most: int) -> Column:
    """About ``most`` of n ids, by hash, or all."""
    return F.pmod(F.xxhash64("id", F.lit(13)), F.lit(1 << 30)) < int(min(1.0, most / max(n, 1)) * (1 << 30))


def _measures(rows: DataFrame) -> dict[bool, tuple[np.ndarray, np.ndarray]]:
    """Of a sample of rows: by whether it is positive, (measures, half)."""

    def run(batches):
        for batch in batches:
            at = 0
            for found in _parts(batch.column("text")):
                lists = pa.array(list(found.astype(np.float32)), pa.list_(pa.float32()))
                marks = [batch.column(c).slice(at, len(found)) for c in ("positive", "half")]
                yield pa.RecordBatch.from_arrays([*marks, lists], names=["positive", "half", "measures"])
                at += len(found)

    rows = bounded(rows.select("text", "positive", "half"))
    found = rows.mapInArrow(run, "positive boolean, half boolean, measures array<float>")
    # In an order of their own, so that a rerun fits the same rows in the same batches; bounded even if an id that was drawn
    # repeats without end.
    found = found.orderBy(F.hash("measures"), "measures", "positive").limit(2 * (POSITIVES + UNLABELLED)).toArrow()
    matrix = found.column("measures").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(found.num_rows, -1)
    positive, half = (found.column(c).to_numpy().astype(bool) for c in ("positive", "half"))
    return {kind: (matrix[positive == kind], half[positive == kind]) for kind in (True, False)}


def train(docs: DataFrame, trusted: DataFrame, use: Column | None = None) -> Classifier | None:
    """A classifier from the texts of ``docs`` (doc_id, text) and the ids of good ones, ``trusted`` (doc_id).

    ``use`` says which documents may be learned from, as positives and as unlabelled text alike; null counts as no. All of
    them are unlabelled rows, and those of trusted ids are positives as well. Documents without an id are left out,
    repeated ones count as often as they stand; repeated or null ids of ``trusted`` do nothing more. With fewer than
    ``FEWEST`` positives or unlabelled rows there is no classifier, but None.

    Texts are never shuffled: ids are joined first, and texts are drawn by the few ids of the sample."""
    docs = docs.filter(use) if use is not None else docs
    rows = docs.select(F.col("doc_id").alias("id"), "text").filter(F.col("id").isNotNull())
    good = trusted.select(F.col("doc_id").alias("id")).filter(F.col("id").isNotNull()).distinct()
    n_good, n = rows.select("id").join(good, "id", "left_semi").count(), rows.count()
    if min(n_good, n) < FEWEST:
        return None
    halved = rows.withColumn("half", F.pmod(F.xxhash64("id"), F.lit(2)) == 0)
    drawn_good = staged(good.filter(_drawn(n_good, POSITIVES)), "trusted")
    positive = halved.join(drawn_good, "id", "left_semi").withColumn("positive", F.lit(True))
    unlabelled = halved.filter(_drawn(n, UNLABELLED)).withColumn("positive", F.lit(False))
    found = _measures(positive.unionByName(unlabelled))
    (p, p_half), (u, u_half) = found[True], found[False]
    start = Classifier.scaled(u)
    if min(p_half.sum(), u_half.sum(), (~p_half).sum(), (~u_half).sum()) < FEWEST // 4:
        return start.fitted(p, u, PRIOR)
    # Positives against unlabelled rows with equal weight, which is the risk with a prior that nothing is taken off for.
    halves = {half: start.fitted(p[p_half == half], u[u_half == half], PRIOR) for half in (True, False)}
    counts = _binned(halved, good, halves)
    return start.fitted(p, u, prior_of(counts[True], counts[True] + counts[False]))


def _binned(rows: DataFrame, good: DataFrame, halves: dict[bool, Classifier]) -> dict[bool, np.ndarray]:
    """Numbers of all rows by score, for the trusted ones and the rest; a row's score is from the half that it isn't in."""
    box = rows.sparkSession.sparkContext.broadcast(halves)

    def run(batches):
        for batch in batches:
            half = batch.column("half").to_numpy(zero_copy_only=False).astype(np.int64)
            odds = [np.stack([box.value[not h].odds(m) for h in (False, True)]) for m in _parts(batch.column("text"))]
            odds = np.concatenate([np.zeros((2, 0)), *odds], axis=1)[half, np.arange(len(half))]
            score = np.minimum(BINS - 1, (_sigmoid(odds) * BINS).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(score)], names=["id", "bin"])

    found = bounded(rows.select("id", "text", "half")).mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, bin long")
    # Copies of an id are counted before the join.
    found = found.groupBy("id", "bin").agg(F.count("*").alias("n"))
    found = found.join(good.withColumn("positive", F.lit(True)), "id", "left")
    found = found.groupBy(F.col("positive").isNotNull().alias("positive"), "bin").agg(F.sum("n").alias("n"))
    counts = {True: np.zeros(BINS), False: np.zeros(BINS)}
    for r in found.collect():
        counts[r["positive"]][r["bin"]] = r["n"]
    return counts


def scored(docs: DataFrame, model: Classifier | None, name: str = "quality") -> DataFrame:
    """``docs`` with a column ``name``: how likely each whole text is good, 0 to 1.

    Null counts as the empty text; empty texts get the score of their measures, all zero. Without a model every score is
    0.5. A column of ``docs`` called ``name`` is replaced, all others stay."""
    if model is None:
        return docs.withColumn(name, F.lit(0.5))
    box = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(np.clip(box.value.scores(texts), 0.0, 1.0))

    return bounded(docs).withColumn(name, score.asNondeterministic()("text"))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def op13(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(docs, labels.filter((F.col("quality") == 1) & ~held_out()).select("doc_id"), ~held_out())
    found = scored(docs, model, "score")
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
