"""Message content: union-typed JSON values rendered as text."""

from __future__ import annotations

import json
import re
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _text(value: Any) -> str:
    if value is None:
        return ""
    if isinstance(value, str):
        return value
    if not isinstance(value, list):
        return json.dumps(value, ensure_ascii=False, sort_keys=True)
    out = []
    for item in value:
        if isinstance(item, dict):
            named = [item[k] for k in ("text", "content") if isinstance(item.get(k), str)]
            item = named[0] if named else json.dumps(item, ensure_ascii=False, sort_keys=True)
        out.append(item if isinstance(item, str) else str(item))
    return "\n".join(filter(None, out))


@F.pandas_udf(StringType())
def canonical_json(values: pd.Series) -> pd.Series:
    """JSON text with sorted keys, spaced separators and unescaped letters; null for text that isn't JSON."""

    def one(raw):
        try:
            return None if raw is None else json.dumps(json.loads(raw), ensure_ascii=False, sort_keys=True)
        except ValueError:
            return None

    return values.map(one)


@F.pandas_udf(StringType())
def ascii_json(values: pd.Series) -> pd.Series:
    """JSON text with everything beyond ASCII as escapes."""
    return values.map(lambda raw: raw if raw is None or raw.isascii() else re.sub(r"[^\x00-\x7f]+", lambda m: json.dumps(m.group())[1:-1], raw))


@F.pandas_udf(StringType())
def content_text(values: pd.Series) -> pd.Series:
    """The text of a JSON-encoded content value: null is empty, a list's parts are joined by line
    breaks, text or content of objects comes first, anything else is canonical JSON."""
    return values.map(lambda raw: _text(None if raw is None else json.loads(raw)))


def _reference(raw: str) -> str:
    try:
        parsed = json.loads(raw)
    except ValueError:
        return raw
    if isinstance(parsed, dict):
        if "content" in parsed:
            return _text(parsed["content"])
        if isinstance(parsed.get("messages"), list):
            asked = [(str(m.get("role", "user")), _text(m.get("content"))) for m in parsed["messages"] if isinstance(m, dict)]
            return "\n\n".join(f"{role}: {text}" for role, text in asked if role != "assistant" and text)
        if "prompt" in parsed:
            return _text(parsed["prompt"])
    return _text(parsed)


@F.pandas_udf(StringType())
def reference_text(values: pd.Series) -> pd.Series:
    """The text that a referenced JSON file stands for: its content, else its messages without the assistant's, else its prompt, else
    all of it, as content text; a file that isn't JSON as it is."""
    return values.map(lambda raw: None if raw is None else _reference(raw))


def render_messages(messages: Column, include_assistant: bool = True) -> Column:
    """``role: content`` blocks parted by blank lines; empty contents are left out, a missing role is user."""
    role = lambda m: F.coalesce(m["role"], F.lit("user"))
    said = F.filter(messages, lambda m: F.coalesce(m["content"], F.lit("")) != "")
    if not include_assistant:
        said = F.filter(said, lambda m: role(m) != "assistant")
    return F.array_join(F.transform(said, lambda m: F.concat(role(m), F.lit(": "), m["content"])), "\n\n")
