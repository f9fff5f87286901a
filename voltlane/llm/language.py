"""Language identification with interpolated Kneser-Ney character models.

One model per value of ``lang``: counts of character four-grams are gathered over all labelled rows (workers count,
Spark sums), Spark derives the continuation counts of the lower orders, and the driver turns the most frequent grams,
``GRAMS`` for each language, into interpolated probabilities. They are stored in sorted hash arrays: a gram packs into 64 bits, a
bijective mix of it is the hash, and a row of the value matrix has the log probability under every language, so one
search serves all of them. A text takes the language of the lowest cross-entropy per character.

Texts are NFC-normalised and lower-cased; runs of anything but letters and marks are one space. Characters outside the
basic plane share one symbol.

Calibration: a hash sample of labelled rows (of each language at most a tenth; about ``CALIBRATION_ROWS`` in all, and about
``LANG_ROWS`` of each) is kept out of the counts. It sets the temperature of ``score`` and, for each language, the entropy
above which a text is rejected. Spark sums it up by language; where a language has few rows, those of all languages
count as ``PRIOR_ROWS`` more.
"""

import unicodedata
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlane.llm.arrow import bounded, slices, strings
from voltlane.scratch import staged

ORDER = 4
BITS = 16
SPACE, START, ASTRAL = 32, 1, 0xFFFD
CALIBRATION_ROWS, LANG_ROWS, PRIOR_ROWS = 2000, 500, 10
TEMPERATURES = [2.0**-k for k in range(11)]
GRAMS = 40_000
MAX_GRAMS = 2_000_000
MAX_CELLS = 64_000_000
MAX_LANGS = 256
UNDEFINED = "und"
PREDICTION = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("cross_entropy", T.DoubleType()),
        T.StructField("rejected", T.BooleanType()),
    ]
)


# Texts as symbols


@cache
def _symbol_table() -> np.ndarray:
    table = np.full(0x110000, SPACE, dtype=np.uint16)
    for code in range(0x110000):
        if unicodedata.category(chr(code))[0] in "LM":
            table[code] = code if code < ASTRAL else ASTRAL
    table[0] = START
    return table


@cache
def _letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def _plain(text: str) -> str:
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return text.lower().replace("\0", " ")


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts, each led by three start marks; where each text begins; whether it has a letter."""
    mark = "\0" * (ORDER - 1)
    plain = [mark + _plain(t) for t in texts]
    codes = np.frombuffer("".join(plain).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(t) for t in plain])[:-1]]).astype(np.int64)
    letters = np.add.reduceat(_letter_table()[codes], starts, dtype=np.int64) > 0
    out = _symbol_table()[codes]
    keep = np.ones(len(out), dtype=bool)
    keep[1:] = (out[1:] != SPACE) | (out[:-1] != SPACE)
    kept = np.add.reduceat(keep, starts, dtype=np.int64)
    return out[keep], np.concatenate([[0], np.cumsum(kept)[:-1]]).astype(np.int64), letters


def grams(out: np.ndarray) -> np.ndarray:
    """The gram that ends at each position from the third on, packed, the newest symbol lowest."""
    wide = out.astype(np.uint64)
    key = wide[ORDER - 1 :].copy()
    for back in range(1, ORDER):
        key |= wide[ORDER - 1 - back : len(wide) - back] << np.uint64(BITS * back)
    return key


# Counting


def _count(batches):
    held: dict[str, list] = {}
    size = 0
    for batch in batches:
        for part in slices(batch.column(0)):
            at = part.offset - batch.column(0).offset
            langs = batch.column(1).slice(at, len(part)).to_pylist()
            texts = strings(part)
            for lang in sorted(set(langs)):
                out, _, _ = symbols([t for t, x in zip(texts, langs) if x == lang])
                key = grams(out)
                key, n = np.unique(key[out[ORDER - 1 :] != START], return_counts=True)
                held.setdefault(lang, []).append((key, n))
                size += len(key)
        if size > 4_000_000:
            held = {lang: [_merged(parts)] for lang, parts in held.items()}
            size = sum(len(p[0][0]) for p in held.values())
            if size > 2_000_000:
                yield from _counted(held)
                held, size = {}, 0
    yield from _counted(held)


def _merged(parts):
    key, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return key, np.bincount(inverse, weights=np.concatenate([n for _, n in parts])).astype(np.int64)


def _counted(held):
    for lang, parts in held.items():
        key, n = _merged(parts)
        if len(key):
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(key)), pa.array(key.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"]
            )


def _levels(counts: DataFrame) -> DataFrame:
    """Counts of all orders: as they are for the highest, the number of different left neighbours below it. With each
    its context's total."""
    level, all_levels = counts, None
    for order in range(ORDER, 0, -1):
        rows = level.select("lang", F.lit(order).alias("order"), "gram", "n")
        all_levels = rows if all_levels is None else all_levels.unionByName(rows)
        low = (1 << BITS * (order - 1)) - 1
        level = level.groupBy("lang", F.col("gram").bitwiseAND(F.lit(low)).alias("gram")).agg(F.count("*").alias("n"))
    context = Window.partitionBy("lang", "order", F.shiftrightunsigned("gram", BITS))
    return all_levels.withColumn("total", F.sum("n").over(context))


# The model


@dataclass
class Level:
    """Sorted hashes with a row of values each; ``first`` leads by the top bits of a hash to its neighbourhood."""

    hashes: np.ndarray
    values: np.ndarray
    first: np.ndarray = field(init=False)
    shift: np.uint64 = field(init=False)
    widest: int = field(init=False)

    def __post_init__(self):
        bits = max(1, int(max(1, len(self.hashes))).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        buckets = (self.hashes >> self.shift).astype(np.int64)
        self.first = np.searchsorted(buckets, np.arange((1 << bits) + 1)).astype(np.int32)
        self.widest = int(np.diff(self.first).max(initial=0))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Rows of the hashes, -1 where there is none."""
        out = np.full(len(hashes), -1, dtype=np.int32)
        if not len(self.hashes):
            return out
        bucket = (hashes >> self.shift).astype(np.int32)
        at = self.first[bucket]
        last = len(self.hashes) - 1
        for _ in range(self.widest):
            here = np.minimum(at, last)
            hit = self.hashes[here] == hashes
            out[hit] = here[hit]
            at = at + 1
        return out


def mix(key: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits, so that different grams keep different hashes."""
    with np.errstate(over="ignore"):
        key = (key ^ (key >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        key = (key ^ (key >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return key ^ (key >> np.uint64(33))


def _level(keys, values):
    hashes = mix(keys)
    order = np.argsort(hashes)
    return Level(hashes[order], np.ascontiguousarray(values[order]))


@dataclass
class Model:
    langs: list[str]
    probs: dict[int, Level]
    backoff: dict[int, Level]
    unseen: np.ndarray
    temperature: float = 1.0
    mean: np.ndarray | None = None
    foreign: np.ndarray | None = None
    spread: np.ndarray | None = None

    def logs(self, order: int, keys: np.ndarray) -> np.ndarray:
        """log2 probability of each gram's last symbol under every language."""
        if order == 0:
            return np.broadcast_to(self.unseen, (len(keys), len(self.langs)))
        row = self.probs[order].find(mix(keys))
        if not len(self.probs[order].hashes):
            out = np.zeros((len(keys), len(self.langs)), dtype=np.float32)
        else:
            out = self.probs[order].values[row]
        miss = np.flatnonzero(row < 0)
        if len(miss):
            lower = np.array(self.logs(order - 1, keys[miss] & np.uint64((1 << BITS * (order - 1)) - 1)))
            if order > 1:
                context = self.backoff[order].find(mix(keys[miss] >> np.uint64(BITS)))
                seen = context >= 0
                lower[seen] += self.backoff[order].values[context[seen]]
            out[miss] = lower
        return out

    def entropies(self, texts: list[str], block: int = 1 << 19) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bits per symbol of each text under each language, its number of symbols, whether it has a letter."""
        out, starts, letters = symbols(texts)
        lead = ORDER - 1
        n = np.diff(np.append(starts, len(out))) - lead
        keys, inner = grams(out), out[lead:] != START
        text_of = np.repeat(np.arange(len(texts)), n)
        keys = keys[inner]
        sums = np.zeros((len(texts), len(self.langs)))
        step = max(1024, block // max(1, len(self.langs) // 4))
        for at in range(0, len(keys), step):
            of = text_of[at : at + step]
            first = np.flatnonzero(np.diff(of, prepend=-1))
            sums[of[first]] += np.add.reduceat(self.logs(ORDER, keys[at : at + step]), first, axis=0, dtype=np.float64)
        return -sums / np.maximum(n, 1)[:, None], n, letters

    def limits(self, best: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Half-way between the language's own entropy and that of other text, more for short texts."""
        return (self.mean[best] + self.foreign[best]) / 2 + 1.5 * self.spread[best] / np.sqrt(np.maximum(n, 1))

    def predict(self, texts: list[str]) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
        bits, n, letters = self.entropies(texts)
        best = bits.argmin(axis=1)
        gain = (bits - bits.min(axis=1, keepdims=True)) * n[:, None] * self.temperature
        score = np.round(1 / np.exp2(-np.minimum(gain, 1000)).sum(axis=1), 6)
        lowest = bits[np.arange(len(texts)), best]
        rejected = ~letters | (lowest > self.limits(best, n))
        langs = [self.langs[b] if ok else UNDEFINED for b, ok in zip(best, letters)]
        return langs, np.where(letters, score, 0.0), np.where(letters, lowest, 0.0), rejected


def _build(levels: pa.Table) -> Model | None:
    """Interpolated probabilities from the collected levels. What was left out falls back to the lower order, and its
    share with it, so the probabilities of a context sum to one. ``ones`` and ``twos`` are of all grams, left out or not."""
    if not levels.num_rows:
        return None
    rows = {c: levels.column(c).to_numpy() for c in ("order", "gram", "n", "total", "ones", "twos")}
    coded = levels.column("lang").combine_chunks().dictionary_encode()
    order = sorted(range(len(coded.dictionary)), key=lambda k: coded.dictionary[k].as_py())
    langs = [coded.dictionary[k].as_py() for k in order]
    lang = np.argsort(order)[coded.indices.to_numpy()]
    width = len(langs)
    model = Model(langs, {}, {}, np.zeros(width, dtype=np.float32))
    size = len(set(rows["gram"][rows["order"] == 1].tolist())) + 1
    for order in range(1, ORDER + 1):
        own = rows["order"] == order
        keys = rows["gram"][own].view(np.uint64)
        n, total, of = (x[own] for x in (rows["n"], rows["total"], lang))
        ones, twos = np.zeros(width, dtype=np.int64), np.zeros(width, dtype=np.int64)
        ones[of], twos[of] = rows["ones"][own], rows["twos"][own]
        discount = np.where((ones > 0) & (twos > 0), ones / np.maximum(ones + 2 * twos, 1), 0.5)
        contexts, context = np.unique(keys >> np.uint64(BITS), return_inverse=True)
        union, gram = np.unique(keys, return_inverse=True)
        share = np.zeros((len(union), width))
        share[gram, of] = np.maximum(n - discount[of], 0) / total
        taken = np.bincount(context * width + of, share[gram, of], len(contexts) * width)
        # Discounts are above zero, so something is left.
        gamma = np.maximum(1 - taken.reshape(len(contexts), width), 1e-12)
        ctx = np.searchsorted(contexts, union >> np.uint64(BITS))
        if order == 1:
            first = gamma[0] if len(contexts) else np.ones(width)
            model.unseen = np.log2(first / size).astype(np.float32)
            lower = np.full((len(union), width), 1 / size)
        else:
            lower = np.exp2(model.logs(order - 1, union & np.uint64((1 << BITS * (order - 1)) - 1)).astype(np.float64))
        model.probs[order] = _level(union, np.log2(share + gamma[ctx] * lower).astype(np.float32))
        model.backoff[order] = _level(contexts, np.log2(gamma).astype(np.float32))
    return model


def train(
    docs: DataFrame, usable: Column, grams: int = GRAMS, calibration_rows: int = CALIBRATION_ROWS
) -> Model | None:
    """Learn from the text and lang of the rows where ``usable`` holds and neither is null; None if there are none.

    Bounds: ``grams`` grams for each language, ``MAX_GRAMS`` in all, those of the largest shares among a language's grams
    of their order; the ``MAX_LANGS`` most frequent languages. ``calibration_rows`` rows, or ``LANG_ROWS`` of a language if that is more,
    are kept out, but a tenth at most."""
    labelled = bounded(docs).filter(usable & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "text", "lang", F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)).alias("draw")
    )
    sizes = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGS).collect()
    if not sizes:
        return None
    langs, rows = [r["lang"] for r in sizes], sum(r["count"] for r in sizes)
    labelled = labelled.filter(F.col("lang").isin(langs))
    least = LANG_ROWS if calibration_rows else 0
    part = {r["lang"]: min(0.1, max(calibration_rows / rows, least / r["count"])) for r in sizes}
    bounds = F.create_map(*[F.lit(x) for lang in langs for x in (lang, int(1_000_000 * part[lang]))])
    kept_out = F.col("draw") < F.element_at(bounds, F.col("lang"))
    counts = labelled.filter(~kept_out).select("text", "lang")
    counts = counts.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    limit = min(grams * len(langs), MAX_GRAMS, MAX_CELLS // len(langs))
    levels = _levels(staged(counts, "grams"))
    whole = levels.groupBy("lang", "order").agg(
        F.sum("n").alias("all"), F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos")
    )
    levels = levels.join(whole, ["lang", "order"]).orderBy((F.col("n") / F.col("all")).desc(), "order", "lang", "gram")
    model = _build(levels.limit(limit).drop("all").toArrow())
    if model:
        _calibrate(model, labelled.filter(kept_out).select("text", "lang"), part)
    return model


def _calibrate(model: Model, sample: DataFrame, part: dict[str, float]):
    """Temperature of least log loss; by language, the mean entropy of its own text and of other languages' text, and
    the largest usual excess of its own. ``part`` is the share of each language's rows that the sample has."""
    box = sample.sparkSession.sparkContext.broadcast(model)
    number = {lang: k for k, lang in enumerate(model.langs)}

    def score(batches):
        for batch in batches:
            for texts in slices(batch.column(0)):
                langs = batch.column(1).slice(texts.offset - batch.column(0).offset, len(texts))
                bits, n, letters = box.value.entropies(strings(texts))
                truth = np.array([number.get(x, -1) for x in langs.to_pylist()])
                use = letters & (n > 0) & (truth >= 0)
                bits, n, truth = bits[use], n[use], truth[use]
                if not len(n):
                    continue
                own = bits[np.arange(len(n)), truth]
                gain = (bits - bits.min(axis=1, keepdims=True)) * n[:, None]
                losses = []
                for t in TEMPERATURES:
                    scaled = np.minimum(gain * t, 1000)
                    losses.append(scaled[np.arange(len(n)), truth] + np.log2(np.exp2(-scaled).sum(axis=1)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(truth), pa.array(np.ones(len(n), dtype=bool)), pa.array(own), pa.array(n.astype(float)),
                     pa.array(np.array(losses).T.tolist(), pa.list_(pa.float64()))],
                    names=["k", "own", "bits", "n", "losses"],
                )
                # Of all other languages' texts together.
                other = np.repeat(n[:, None].astype(float), len(number), axis=1)
                other[np.arange(len(n)), truth] = 0
                weight = other.sum(axis=0)
                some = np.flatnonzero(weight)
                mean = (bits * other).sum(axis=0)[some] / weight[some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some), pa.array(np.zeros(len(some), dtype=bool)), pa.array(mean), pa.array(weight[some]),
                     pa.nulls(len(some), pa.list_(pa.float64()))],
                    names=["k", "own", "bits", "n", "losses"],
                )

    rows = staged(sample.mapInArrow(score, "k long, own boolean, bits double, n double, losses array<double>"), "calibration")
    losses = [F.sum(F.get("losses", F.lit(i))).alias(f"loss{i}") for i in range(len(TEMPERATURES))]
    found = rows.groupBy("k", "own").agg(
        F.count("*").alias("rows"), F.sum("n").alias("n"), F.sum(F.col("bits") * F.col("n")).alias("bits"), *losses
    )
    found = {(r["k"], r["own"]): r for r in found.collect()}
    width = len(model.langs)
    model.mean, model.foreign, model.spread = np.full(width, 8.0), np.full(width, 16.0), np.full(width, 8.0)
    own = {k: found[k, True] for k in range(width) if (k, True) in found}
    if not own:
        return
    # A row stands for as many as were not drawn in its language.
    total = [sum(r[f"loss{i}"] / part[model.langs[k]] for k, r in own.items()) for i in range(len(TEMPERATURES))]
    model.temperature = TEMPERATURES[int(np.argmin(total))]
    usual = np.mean([r["bits"] / r["n"] for r in own.values()])
    length = sum(r["n"] for r in own.values()) / sum(r["rows"] for r in own.values())
    for k in range(width):
        n, bits = (own[k]["n"], own[k]["bits"]) if k in own else (0, 0)
        model.mean[k] = (bits + usual * PRIOR_ROWS * length) / (n + PRIOR_ROWS * length)
        model.foreign[k] = 2 * model.mean[k]
        if (k, False) in found:
            model.foreign[k] = max(1.5 * model.mean[k], found[k, False]["bits"] / found[k, False]["n"])
    means = F.array(*[F.lit(float(m)) for m in model.mean])
    excess = (F.col("bits") - F.get(means, F.col("k").cast("int"))) * F.sqrt("n")
    high = F.percentile_approx(excess, 0.999, 10_000).alias("high")
    excesses = rows.filter("own").select("k", "bits", "n")
    high_of = {r["k"]: r["high"] for r in excesses.groupBy("k").agg(high).collect()}
    usual = excesses.agg(high).first()["high"]
    for k in range(width):
        count = own[k]["rows"] if k in own else 0
        spread = (count * high_of.get(k, 0) + PRIOR_ROWS * usual) / (count + PRIOR_ROWS)
        model.spread[k] = max(1.0, spread)


def detect(docs: DataFrame, model: Model | None, name: str = "language") -> DataFrame:
    """``docs`` with a struct ``name``: lang_pred, score, cross_entropy (bits per symbol), rejected.

    Null texts and texts without a letter are ``und``, score 0, rejected; so is every text without a model. Equal
    entropies go to the language that sorts first. A column of ``docs`` called ``name`` is replaced."""
    if model is None:
        none = F.struct(F.lit(UNDEFINED).alias("lang_pred"), F.lit(0.0).alias("score"))
        return docs.withColumn(name, none.withField("cross_entropy", F.lit(0.0)).withField("rejected", F.lit(True)))
    box = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(PREDICTION)
    def predicted(texts: pa.Array) -> pa.Array:
        parts = [box.value.predict(strings(part)) for part in slices(texts)]
        columns = [pa.array([x for p in parts for x in p[0]], pa.string())]
        columns += [pa.array(np.concatenate([p[k] for p in parts])) if parts else pa.array([]) for k in (1, 2, 3)]
        return pa.StructArray.from_arrays(columns, names=PREDICTION.names)

    # As nondeterministic, a later filter on the struct doesn't run the function a second time.
    return bounded(docs).withColumn(name, predicted.asNondeterministic()("text"))


def not_held_out(docs: DataFrame) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 3 != 1


def keep_known(docs: DataFrame) -> DataFrame:
    """Documents whose language is known to a model learned from all labelled rows of ``docs`` itself; the rejected ones go.
    Nothing is measured here, so no row is held out. Columns stay as they are."""
    model = train(docs, F.lit(True))
    name = "__language"
    return detect(docs, model, name).filter(~F.col(f"{name}.rejected")).select(*[F.col(f"`{c}`") for c in docs.columns])


def op1(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    found = detect(docs, train(docs, not_held_out(docs)), "found")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "found.*")
