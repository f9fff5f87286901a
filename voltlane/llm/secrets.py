"""Secret scan with multipart credential linking.

Strong parts are reported wherever they stand: ``assign`` (a password, secret, token or key given a value), ``access``
(an access key id) and ``hex`` (a long hexadecimal run). Weak parts mean nothing alone: ``ident`` (a named user or
client id), ``bare`` (a long random-looking word) and ``endpoint`` (a URL or a named host). An interval join within a
scope decides on them: each part covers itself and ``REACH`` code points to either side, cut at the blank lines around
it, and two parts meet if one touches what the other covers.

* ``bare`` is reported where it meets an identifier (``access`` or ``ident``);
* ``ident`` where it meets a secret (``assign``, ``hex`` or ``bare``);
* ``endpoint`` where it meets an identifier and a secret that meet each other.

The scopes lie inside a text, so the join needs no shuffle: a task joins the sorted starts and ends of all parts of an
Arrow batch at once. Positions are code points, ends exclusive.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlane.llm.arrow import bounded, slices, strings

REACH = 200
# The contract's patterns, and the kinds in the order in which they are listed.
KINDS = ["assign", "access", "hex", "ident", "bare", "endpoint"]
ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST = 6
# Weak parts.
IDENT = re.compile(
    r"""\b(?ai:access_?key_?id|client_?id|account_?id|user_?name|user|login)["']?\x20*[:=]\x20*"""
    r"""["']?([A-Za-z0-9._@+-]{3,})""",
    re.ASCII,
)
BARE = re.compile(r"[A-Za-z0-9+/_-]{32,}={0,2}")
ENDPOINT = re.compile(
    r"""\b(?:(?ai:https?|ftp|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp)://[^\x09-\x0D\x20"'<>]+"""
    r"""|(?ai:host|hostname|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+(?::[0-9]+)?)""",
    re.ASCII,
)
BLANK = re.compile(r"\n[ \t\r]*\n")
SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("stop", T.LongType()),
        ]
    )
)


def _random_looking(word: str) -> bool:
    """Upper and lower case and digits, hardly any character often."""
    kinds = any("a" <= c <= "z" for c in word), any("A" <= c <= "Z" for c in word), any("0" <= c <= "9" for c in word)
    return all(kinds) and len(set(word)) >= 14


def _parts(text: str) -> dict[str, list[tuple[int, int]]]:
    strong = {
        "assign": [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST],
        "access": [m.span() for m in ACCESS.finditer(text)],
        "hex": [m.span() for m in HEX.finditer(text)],
    }
    found = {k: v for k, v in strong.items() if v}
    taken = [s for v in found.values() for s in v]
    idents = [m.span() for m in IDENT.finditer(text)]
    if idents or taken:
        weak = {
            "ident": idents,
            "bare": [m.span() for m in BARE.finditer(text) if _random_looking(m[0])],
            "endpoint": [m.span() for m in ENDPOINT.finditer(text)],
        }
        taken = np.array(sorted(taken), dtype=np.int64).reshape(-1, 2)
        for kind, spans in weak.items():
            if spans := _free(spans, taken):
                found[kind] = spans
    return found


def _free(spans, taken):
    """Weak parts that no strong one overlaps: those are reported already."""
    if not len(taken) or not spans:
        return spans
    own = np.array(spans, dtype=np.int64)
    hit = _meeting(own[:, 0] + 1, own[:, 1] - 1, taken)
    return [s for s, h in zip(spans, hit) if not h]


def _meeting(low: np.ndarray, high: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Interval join: for which [low, high] is there a part that touches it? Those that start in time, less those that
    ended before."""
    begun = np.searchsorted(np.sort(parts[:, 0]), high, side="right")
    return begun > np.searchsorted(np.sort(parts[:, 1]), low, side="left")


def scan(texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """Of each text the reported spans, as (start, number of the kind, end), sorted."""
    out: list[list] = [[] for _ in texts]
    parts: dict[str, list] = {k: [] for k in KINDS}
    shift = 0
    for i, text in enumerate(texts):
        found = _parts(text)
        for k, spans in found.items():
            if k in KINDS[:3]:
                out[i] += [(a, KINDS.index(k), b) for a, b in spans]
        if any(k in found for k in KINDS[3:]):
            blanks = [m.span() for m in BLANK.finditer(text)]
            first = np.array([0, *(b for _, b in blanks)], dtype=np.int64)
            last = np.array([*(a for a, _ in blanks), len(text)], dtype=np.int64)
            for k, spans in found.items():
                own = np.array(spans, dtype=np.int64)
                scope = np.searchsorted(first, own[:, 0], side="right") - 1
                low, high = np.maximum(own[:, 0] - REACH, first[scope]), np.minimum(own[:, 1] + REACH, last[scope])
                rows = np.column_stack([own + shift, low + shift, high + shift, np.full(len(own), i), own])
                parts[k].append(rows)
        shift += len(text) + 2 * REACH  # parts of different texts never meet
    table = {k: np.concatenate(v) if v else np.empty((0, 7), dtype=np.int64) for k, v in parts.items()}
    idents = np.concatenate([table["access"], table["ident"]])
    bare = table["bare"][_meeting(table["bare"][:, 2], table["bare"][:, 3], idents)]
    secrets = np.concatenate([table["assign"], table["hex"], bare])
    ident = table["ident"][_meeting(table["ident"][:, 2], table["ident"][:, 3], secrets)]
    linked_idents = idents[_meeting(idents[:, 2], idents[:, 3], secrets)]
    linked_secrets = secrets[_meeting(secrets[:, 2], secrets[:, 3], idents)]
    ends = table["endpoint"]
    ends = ends[_meeting(ends[:, 2], ends[:, 3], linked_idents) & _meeting(ends[:, 2], ends[:, 3], linked_secrets)]
    for kind, rows in (("ident", ident), ("bare", bare), ("endpoint", ends)):
        for row in rows.tolist():
            out[row[4]].append((row[5], KINDS.index(kind), row[6]))
    return [sorted(spans) for spans in out]


def find_secrets(docs: DataFrame, name: str = "secrets") -> DataFrame:
    """``docs`` with an array ``name`` of spans (kind, start, stop), by start and then kind as listed.

    A null or empty text has none. Equal texts have equal spans. A column of ``docs`` called ``name`` is replaced."""

    @F.arrow_udf(SPANS)
    def found(texts: pa.Array) -> pa.Array:
        rows = [r for part in slices(texts) for r in scan(strings(part))]
        flat = [s for r in rows for s in r]
        spans = pa.StructArray.from_arrays(
            [
                pa.array([KINDS[k] for _, k, _ in flat], pa.string()),
                pa.array([a for a, _, _ in flat], pa.int64()),
                pa.array([b for _, _, b in flat], pa.int64()),
            ],
            names=["kind", "start", "stop"],
        )
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), spans)

    return bounded(docs).withColumn(name, found.asNondeterministic()("text"))


def op2(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_secrets(docs)

    def of(*kinds):
        return F.filter("secrets", lambda s: s["kind"].isin(*kinds))

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])))

    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(joined(of(*KINDS[:3])), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
        F.size(of(*KINDS[3:])).cast("long").alias("n_linked"),
    )


# The same as SQL. Case is spelt out, as the engine's own folding knows letters beyond ASCII.


def _either(words: str) -> str:
    """A pattern whose letters match in either case."""
    out, inside = [], False
    for c in words:
        inside = c == "[" or (inside and c != "]")
        out.append(f"[{c}{c.upper()}]" if c.isalpha() and not inside else c)
    return "".join(out).replace("[a-z]", "[a-zA-Z]")


_VALUE = """["'']?\\x20*[:=]\\x20*["'']?"""
_PATTERNS = {
    "assign": f"({_either('password|passwd|secret|token|api_?key')}){_VALUE}([A-Za-z0-9+/_.=-]+)",
    "access": "AKIA[A-Z0-9]{16,}",
    "hex": "[0-9a-f]{24,}",
    "ident": f"\\b(?:{_either('access_?key_?id|client_?id|account_?id|user_?name|user|login')}){_VALUE}[A-Za-z0-9._@+-]{{3,}}",
    "bare": "[A-Za-z0-9+/_-]{32,}={0,2}",
    "endpoint": f"\\b(?:(?:{_either('https?|ftp|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp')})://"
    """[^\\x09-\\x0D\\x20"''<>]+"""
    f"|(?:{_either('host|hostname|endpoint|server')}){_VALUE}[A-Za-z0-9.-]+(?::[0-9]+)?)",
    "blank": r"\n[ \t\r]*\n",
}


def _found(kind: str) -> str:
    """Matches with their places: a match starts behind all pieces up to it and all matches before it."""
    p = _PATTERNS[kind]
    return f"""
SELECT doc_id, '{kind}' AS kind, a, a + length(m) AS b, m, n_chars FROM (
  SELECT doc_id, n_chars, unnest([list_sum([length(x) FOR x IN pieces[1:i]]) + coalesce(list_sum([length(x) FOR x IN ms[1:i - 1]]), 0)
      FOR i IN range(1, len(ms) + 1)]) AS a, unnest(ms) AS m
  FROM (SELECT doc_id, length(t) AS n_chars, regexp_extract_all(t, '{p}') AS ms, string_split_regex(t, '{p}') AS pieces
        FROM d) WHERE len(ms) > 0)"""


SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
raw AS MATERIALIZED ({" UNION ALL ".join(map(_found, _PATTERNS))}),
strong AS (
  SELECT * FROM raw WHERE (kind = 'assign' AND length(regexp_extract(m, '{_PATTERNS["assign"]}', 2)) >= {ASSIGN_LEAST})
    OR kind IN ('access', 'hex')),
weak AS (
  SELECT * FROM raw w WHERE (kind IN ('ident', 'endpoint')
      OR (kind = 'bare' AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[0-9]')
          AND len(list_distinct(string_split(m, ''))) >= 14))
    AND NOT EXISTS (FROM strong s WHERE s.doc_id = w.doc_id AND s.a <= w.b - 1 AND s.b >= w.a + 1)),
parts AS (
  SELECT p.doc_id, p.kind, p.a, p.b,
    greatest(p.a - {REACH}, coalesce((SELECT max(x.b) FROM raw x WHERE x.kind = 'blank' AND x.doc_id = p.doc_id AND x.b <= p.a), 0)) AS low,
    least(p.b + {REACH}, coalesce((SELECT min(x.a) FROM raw x WHERE x.kind = 'blank' AND x.doc_id = p.doc_id AND x.b > p.a), p.n_chars)) AS high
  FROM (FROM strong UNION ALL FROM weak) p),
idents AS (SELECT * FROM parts WHERE kind IN ('access', 'ident')),
bare AS (SELECT * FROM parts p WHERE kind = 'bare'
  AND EXISTS (FROM idents q WHERE q.doc_id = p.doc_id AND q.a <= p.high AND q.b >= p.low)),
secrets AS (SELECT * FROM parts WHERE kind IN ('assign', 'hex') UNION ALL FROM bare),
named AS (SELECT * FROM idents p WHERE EXISTS (FROM secrets q WHERE q.doc_id = p.doc_id AND q.a <= p.high AND q.b >= p.low)),
linked AS (SELECT * FROM secrets p WHERE EXISTS (FROM idents q WHERE q.doc_id = p.doc_id AND q.a <= p.high AND q.b >= p.low)),
ends AS (SELECT * FROM parts p WHERE kind = 'endpoint'
  AND EXISTS (FROM named q WHERE q.doc_id = p.doc_id AND q.a <= p.high AND q.b >= p.low)
  AND EXISTS (FROM linked q WHERE q.doc_id = p.doc_id AND q.a <= p.high AND q.b >= p.low)),
reported AS (
  SELECT doc_id, kind, a, b FROM strong UNION ALL SELECT doc_id, kind, a, b FROM bare
  UNION ALL SELECT doc_id, kind, a, b FROM named WHERE kind = 'ident' UNION ALL SELECT doc_id, kind, a, b FROM ends),
spans AS (
  SELECT *, list_position({KINDS}, kind) AS k, kind || ':' || a || ':' || b AS span FROM reported),
joined AS (
  SELECT doc_id, count(*) FILTER (k = 1) AS n_assign, count(*) FILTER (k = 2) AS n_access, count(*) FILTER (k = 3) AS n_hex,
    coalesce(string_agg(span, ',' ORDER BY a, k) FILTER (k <= 3), '') AS base, string_agg(span, ',' ORDER BY a, k) AS spans,
    count(*) FILTER (k > 3) AS n_linked
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_linked, 0) AS n_linked
FROM d LEFT JOIN joined USING (doc_id)
"""
