"""Periodic runs of words, by an online sparse dynamic program over diagonals, and texts with the repeats taken out.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and at least
max(``LEAST``, ``TIMES`` * q) words that no neighbouring word extends. A text is read once, word by word. An earlier
occurrence of what ends at a word lies on the diagonal of its lag; it makes the match on that diagonal one word longer.
A diagonal that a word does not continue has ended: if it is long enough, its run is emitted there and then.

Following every earlier occurrence of a word would be quadratic in texts of few words. A run of period d has matches on
at least 3 d words, so occurrences are looked up by scale: for the lags from D to 1.5 D, those of the last 3 D words (5 at
least, since every run has as many matches). Such a stretch of words spans two periods of its run, therefore its nearest
earlier occurrence is exactly one smallest period back, and no other occurrence matters. So a word has at most one lag on
each scale, whatever the text, multiples of a period never become runs, and a text of n words takes O(n log n) steps.

Stretches of words get exact names, longer ones from two overlapping shorter ones. Only what recurs goes to the next
scale, which in ordinary prose is next to nothing.
"""

import re
from collections import defaultdict
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlane.llm.arrow import bounded, slices, strings

WORDS = r"[^\x20\x09-\x0D]+"
LEAST, TIMES = 6, 4
SHORTEST = LEAST - 1
BUCKETS = 1 << 20
RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
FOUND = T.StructType(
    [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]
)

_words = re.compile(WORDS).findall


# Matches: (word, lag) by scale


def scales(longest: int):
    """(least lag, first lag of the next scale, words to look up) for lags up to ``longest``."""
    least = 1
    while least <= longest:
        after = 3 * least // 2 + 1
        yield least, after, max(SHORTEST, (TIMES - 1) * least)
        least = after


def _named(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For positions in ascending order: a name for each key; whether it recurs; the index of its nearest earlier
    occurrence, or -1."""
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key), dtype=bool)
    same[1:] = key[order[1:]] == key[order[:-1]]
    name = np.empty(len(key), dtype=np.int64)
    name[order] = np.cumsum(~same)
    again = same.copy()
    again[:-1] |= same[1:]
    recurs = np.empty(len(key), dtype=bool)
    recurs[order] = again
    before = np.full(len(key), -1)
    before[order[1:][same[1:]]] = order[:-1][same[1:]]
    return name, recurs, before


def _first_names(word: np.ndarray, place: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose last ``SHORTEST`` words recur in their text, and names of these stretches."""
    at = np.flatnonzero(place >= SHORTEST - 1)
    mixed = text[at].astype(np.uint64)
    for back in range(SHORTEST):
        mixed = (mixed ^ word[at - back].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    # Most stretches are alone in their bucket and need no sorting.
    bucket = (mixed % np.uint64(BUCKETS)).astype(np.int64)
    at = at[np.bincount(bucket, minlength=BUCKETS)[bucket] > 1]
    name = text[at].astype(np.int64)
    kinds = int(word.max(initial=0)) + 1
    for back in range(SHORTEST):
        name = _named(name * kinds + word[at - back])[0]
    return at, name


def matches(word: np.ndarray, place: np.ndarray, text: np.ndarray, longest: int):
    """Arrays (position, lag, matching words up to there) of all scales, for consecutive texts: the number of each word,
    its place in its text and the number of the text. ``longest`` is the number of words of the longest text."""
    found = []
    at, name = _first_names(word, place, text)
    held = SHORTEST
    full = np.full(len(word), -1, dtype=np.int64)
    for least, after, long in scales(longest // TIMES):
        shift = long - held
        if shift:
            # The longer stretch is the one that ends here and the one that ends ``shift`` words before.
            full[at] = name
            use = at[place[at] >= long - 1]
            use = use[full[use - shift] >= 0]
            key = full[use] * (len(word) + 1) + full[use - shift]
            full[at] = -1
            at, held = use, long
        else:
            key = name
        name, recurs, before = _named(key)
        late = np.flatnonzero(before >= 0)
        lag = at[late] - at[before[late]]
        on = (lag >= least) & (lag < after)
        found.append((at[late[on]], lag[on], np.full(int(on.sum()), long)))
        at, name = at[recurs], name[recurs]
        if not len(at):
            break
    found.append((np.zeros(0, dtype=np.int64),) * 3)
    position, lag, length = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((lag, position))
    return position[order], lag[order], length[order]


def runs_of_matches(places: list[int], lags: list[int], lengths: list[int]) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of one text from its matches in the order of words."""
    runs = []

    def ended(last: int, diagonals: dict[int, int]):
        for lag, matched in diagonals.items():
            if matched + lag >= max(LEAST, TIMES * lag):
                runs.append((last - matched - lag + 1, matched + lag, lag))

    active, here, now = {}, -1, {}
    for place, lag, length in zip(places, lags, lengths):
        if place != here:
            ended(here - 1, {d: n for d, n in active.items() if d not in now})
            active = now
            if place != here + 1:
                ended(here, active)
                active = {}
            here, now = place, {}
        now[lag] = active[lag] + 1 if lag in active else length
    ended(here - 1, {d: n for d, n in active.items() if d not in now})
    ended(here, now)
    return sorted(runs, key=lambda run: (run[0], run[2]))


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    keep = np.cumsum(change[:-1]) == 0
    return [words[k] for k in np.flatnonzero(keep).tolist()]


def runs_of_texts(texts: list[list[str]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, given by its words."""
    number: dict[str, int] = defaultdict(count().__next__)
    size = np.array([len(words) for words in texts], dtype=np.int64)
    word = np.fromiter(map(number.__getitem__, chain.from_iterable(texts)), dtype=np.int64, count=int(size.sum()))
    start = np.cumsum(size) - size
    text = np.repeat(np.arange(len(texts)), size)
    position, lag, length = matches(word, np.arange(len(word)) - start[text], text, int(size.max(initial=0)))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    cuts = np.searchsorted(position, np.append(start, len(word)))
    for k in np.flatnonzero(np.diff(cuts)).tolist():
        own = slice(cuts[k], cuts[k + 1])
        out[k] = runs_of_matches((position[own] - start[k]).tolist(), lag[own].tolist(), length[own].tolist())
    return out


# The operator


def _found(texts: pa.Array) -> pa.StructArray:
    n, ends, runs, left = [], [0], [], []
    for part in slices(texts):
        words = [_words(t) for t in strings(part)]
        for own, here in zip(words, runs_of_texts(words)):
            n.append(len(own))
            runs.extend(here)
            ends.append(len(runs))
            left.append(" ".join(collapsed(own, here)))
    columns = np.array(runs, dtype=np.int64).reshape(-1, 3).T
    structs = pa.StructArray.from_arrays([pa.array(c) for c in columns], names=RUN.names)
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)
    return pa.StructArray.from_arrays([pa.array(n, pa.int64()), lists, pa.array(left, pa.string())], names=FOUND.names)


def periodic_runs(docs: DataFrame, text: str = "text", name: str = "periodic") -> DataFrame:
    """``docs`` with a struct ``name``: n_words, runs (start, length, period; by start, then period) and collapsed, the
    words that are left, joined by one space.

    ``text`` names the column to read. Null counts as the empty text: no words, no runs, an empty collapsed text. Equal
    texts have equal results, in repeated rows as well. A text without runs collapses to its words. A column of ``docs``
    called ``name`` is replaced; all others stay, whatever they are called."""

    @F.arrow_udf(FOUND)
    def found(texts: pa.Array) -> pa.Array:
        return _found(texts)

    return bounded(docs).withColumn(name, found.asNondeterministic()(text))


# The registered query


def planted(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The text, for a tenth of the doc_ids with words from a drawn place on that repeat with a drawn period. A null
    doc_id changes nothing."""
    h = F.crc32(F.col(doc_id).cast("string"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = lambda i: F.when(i >= a, a + (i - a) % p).otherwise(i).cast("int")
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, place(i))), " "))

    words = F.regexp_extract_all(F.col(text), F.lit(WORDS), F.lit(0))
    return F.when(h % 10 == 0, F.transform(F.array(words), repeated)[0]).otherwise(F.col(text))


def op11(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    # Spark passes no lambda function on into a Python one; inline keeps the two apart.
    found = periodic_runs(docs.select("doc_id", F.inline(F.array(F.struct(planted().alias("text"))))))
    runs = F.col("periodic.runs")
    # Greatest length / period first, as exact fractions.
    first = F.array_sort(
        runs,
        lambda x, y: F.when(x["length"] * y["period"] != y["length"] * x["period"],
                            F.signum(y["length"] * x["period"] - x["length"] * y["period"]))
        .when(x["start"] != y["start"], F.signum(x["start"] - y["start"]))
        .otherwise(F.signum(x["period"] - y["period"])).cast("int"),
    )
    best = F.get(first, F.lit(0))
    listed = F.array_join(F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size(runs) > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    return found.select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(best["length"] * 1000 / best["period"]).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2(F.col("periodic.collapsed"), 256).alias("collapsed_sha256"),
    )


# DuckDB has no crc32, so it is worked out over the bits of the digits. Matches of five words become diagonals by
# numbering; of the diagonals with the same extent, the least lag is the period and the others are its multiples.
SQL = """
WITH hashed AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
             lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
               lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) AS h
  FROM documents
),
sized AS (SELECT doc_id, w, h, len(w)::BIGINT AS n, h // 10 AS g FROM hashed),
placed AS (SELECT *, g % n AS a, 1 + (n - g % n) // (3 + g % 8) AS p FROM sized),
docs AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END]) ELSE w END AS w
  FROM placed
),
grams AS (
  SELECT doc_id, n, i, hash(w[i - 3], w[i - 2], w[i - 1], w[i], w[i + 1]) AS gram, w[i - 3 : i + 1] AS five
  FROM (SELECT *, unnest(range(4, n)) AS i FROM docs)
),
again AS (SELECT doc_id, gram FROM grams GROUP BY ALL HAVING count(*) > 1),
kept AS (SELECT grams.* FROM grams SEMI JOIN again USING (doc_id, gram)),
matched AS (
  SELECT y.doc_id, y.i, y.i - x.i AS lag
  FROM kept AS x JOIN kept AS y ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i AND 4 * (y.i - x.i) <= y.n
  WHERE x.five = y.five
),
diagonals AS (
  SELECT doc_id, lag, min(i) - 4 - lag AS start, count(*) + 4 + lag AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, lag ORDER BY i) AS island FROM matched)
  GROUP BY doc_id, lag, island
),
runs AS (
  SELECT doc_id, start, length, min(lag) AS period FROM diagonals
  WHERE length >= greatest(6, 4 * lag) GROUP BY doc_id, start, length
),
summed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed
  FROM runs GROUP BY doc_id
),
best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) = 1
),
dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
left_over AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(n)) AS i FROM docs) ANTI JOIN dropped USING (doc_id, i)
  GROUP BY doc_id
)
SELECT docs.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM docs LEFT JOIN summed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN left_over USING (doc_id)
"""
