"""From log lines to checked calls."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlane import schemas as S
from voltlane.functions import calls as C
from voltlane.functions.literals import literal_to_json

# White space around the parts of a line, and the timestamps written with a space instead of a T.
BLANK = " \t\r\n\f\x0b"
SPACED_STAMP = r'"(\d{8})\s+(\d+Z)"'


def parse_lines(lines: DataFrame, python_literals: bool = True) -> DataFrame:
    """Adds chargerId, kind (request, response or reject), uniqueId, message and reason to each line.

    ``message`` is the call as JSON text with repaired timestamps. Calls written as Python literals, holding True,
    False or None, are accepted too, and only lines that are no JSON go to Python; ``python_literals=False`` rejects
    them."""
    # ``charger : call``, where the charger has neither a colon nor white space in it.
    colon = F.instr("line", ":")
    split = lines.withColumn("chargerId", F.rtrim(F.substring_index("line", ":", 1), F.lit(BLANK)))
    rest = F.ltrim(F.substring("line", colon + 1, F.length("line")), F.lit(BLANK))
    matches = (colon > 0) & (F.length("chargerId") > 0) & (F.length(rest) > 0) & ~F.col("chargerId").rlike(r"\s")
    split = split.withColumn("body", F.when(matches, rest))
    split = split.withColumn("message", F.regexp_replace("body", SPACED_STAMP, '"$1T$2"'))
    split = C.evaluate_once(split, call=C.strict_call_elements(F.col("message")))
    if python_literals:
        unread = F.col("call").isNull() & F.col("body").rlike(r"^[\[(]")
        split = split.withColumn("literal", literal_to_json(F.when(unread, F.col("body"))))
        split = split.withColumn("call", F.coalesce("call", C.call_elements(F.col("literal"))))
        split = split.withColumn("message", F.coalesce("literal", "message")).drop("literal")

    kind_text = F.get("call", F.lit(0))
    quoted_kind = F.col("message").rlike(r"^\s*\[\s*[\"']")
    is_number = ~quoted_kind & kind_text.rlike(r"^\d+(\.0+)?$")
    number = kind_text.try_cast("double")
    other_json = ~F.col("body").startswith("[") & F.try_parse_json("body").isNotNull()
    reason = (
        F.when(F.col("body").isNull(), S.NO_MATCH)
        .when(F.col("call").isNull(), F.when(other_json, S.NOT_ARRAY).otherwise(S.NOT_PARSED))
        .when(F.size("call") < 2, S.TOO_SHORT)
        .when(~F.coalesce(is_number & number.isin(2.0, 3.0), F.lit(False)),
              F.concat(F.lit(S.UNKNOWN_TYPE), F.coalesce(kind_text, F.lit("None"))))
    )
    kind = F.when(reason.isNotNull(), "reject").when(number == 2.0, "request").otherwise("response")
    return split.select(
        *lines.columns,
        F.when(F.col("body").isNotNull(), F.col("chargerId")).alias("chargerId"),
        kind.alias("kind"),
        F.get("call", F.lit(1)).alias("uniqueId"),
        F.when(F.col("call").isNotNull(), F.col("message")).alias("message"),
        F.size("call").alias("elements"),
        reason.alias("reason"),
    )


def parse_flat(lines: DataFrame, python_literals: bool = True) -> DataFrame:
    """Every call of two or more elements, of any type and without pairing; other lines are skipped."""
    parsed = parse_lines(lines, python_literals)
    return parsed.filter(F.col("elements") >= 2).select("chargerId", "uniqueId", "message")


def rejects(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("kind") == "reject").select("line", "reason")
