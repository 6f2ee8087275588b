"""The first JSON object in free text, and its label: an Arrow function, as no built-in is exact."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

_BRACE = re.compile(r"[{}]")
_RESULT = T.StructType([T.StructField("valid", T.BooleanType()), T.StructField("label", T.StringType()), T.StructField("parsed", T.StringType())])


def _spans(text: str):
    """(start, end) of the balanced braces from each opening brace, in order of their starts."""
    open_at: list[int] = []
    ends: dict[int, int] = {}
    for m in _BRACE.finditer(text):
        if m[0] == "{":
            open_at.append(m.start())
        elif open_at:
            ends[open_at.pop()] = m.end()
    for start in sorted(ends):
        yield start, ends[start]


def first_object(text: str | None) -> dict | None:
    """The whole text if it is JSON (None unless an object), else the first span of braces that is."""
    text = (text or "").strip()
    if not text:
        return None
    try:
        whole = json.loads(text)
    except (ValueError, RecursionError):
        pass
    else:
        return whole if isinstance(whole, dict) else None
    for start, end in _spans(text):
        try:
            return json.loads(text[start:end])
        except (ValueError, RecursionError):
            continue
    return None


def label_in(found: dict | None) -> str:
    if not found:
        return "invalid_json"
    label = found.get("label_id")
    label = label.strip() if isinstance(label, str) else ""
    return label or "missing_label"


@pandas_udf(_RESULT)
def _scan(texts: pd.Series) -> pd.DataFrame:
    found = [first_object(t) for t in texts]
    return pd.DataFrame({"valid": [f is not None for f in found], "label": [label_in(f) for f in found], "parsed": [None if f is None else json.dumps(f, sort_keys=True) for f in found]})


def scan(c: Column) -> Column:
    """struct(valid, label, parsed): whether there is an object, its label or a sentinel, the object with sorted keys."""
    return _scan(c)
