"""The one Python UDF: old records hold the call as a Python literal instead of JSON."""

import ast
import json

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _as_json(text):
    try:
        value = ast.literal_eval(text.strip())
        return json.dumps(value) if isinstance(value, (list, tuple)) else None
    except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
        return None


@F.pandas_udf(T.StringType())
def literal_to_json(texts: pd.Series) -> pd.Series:
    """JSON text of each Python list or tuple literal; null where there is none. Callers pass null for all rows
    that parse as JSON, so only the others cost anything here."""
    return texts.map(_as_json, na_action="ignore").astype(object).where(texts.notna(), None)
