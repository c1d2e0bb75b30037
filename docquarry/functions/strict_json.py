"""Strict JSON in Arrow functions: what Spark's lenient parsers would let pass is an error here.

Key presence, JSON types and SQL coercions matter to the import, so records are
flattened into typed fields with flags, once, next to the text.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..arrow import ready

#: One imported record: what it is, and its fields as the tables store them.
RECORD = "struct<status:string, result_id:bigint, category_id:bigint, match:string, reasoning_trace:string, blockquotes:array<string>, quote_error:boolean>"

_LARGEST = 1 << 63


def balanced_object(text: str) -> str | None:
    """The text from the first ``{`` to the brace that closes it, strings skipped; None if it stays open."""
    at = start = text.find("{")
    if start < 0:
        return None
    depth, size = 0, len(text)
    while at < size:
        c = text[at]
        if c == '"':  # to the string's end
            at += 1
            while at < size and text[at] != '"':
                at += 2 if text[at] == "\\" else 1
        elif c == "{":
            depth += 1
        elif c == "}":
            depth -= 1
            if not depth:
                return text[start : at + 1]
        at += 1
    return None


def first_object(text: str | None) -> dict | None:
    """The first balanced object of a text, if it is JSON; there is no second try at a later brace."""
    found = balanced_object(text or "")
    if found is None:
        return None
    try:
        return json.loads(found)
    except (json.JSONDecodeError, RecursionError):
        return None


def _stored(value: object) -> str | None:
    """A scalar as a text column stores it; raises for what it can't store."""
    if isinstance(value, bool):
        return str(int(value))
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, (int, float)):
        return repr(value)
    raise TypeError(type(value).__name__)


def _identifier(value: object) -> int | None:
    """An id as an integer column stores it: integers, and texts or reals that are integers."""
    if value is None:
        return None
    if isinstance(value, float):
        if not value.is_integer():
            raise ValueError(value)
        value = int(value)
    if isinstance(value, (int, str)):
        number = int(value)  # bool is an int
        if -_LARGEST <= number < _LARGEST:
            return number
    raise ValueError(value)


def flatten_record(text: str | None) -> dict:
    """A record's fields and status: ``ok``, ``error`` (counts as an error) or ``ignored`` (counts as skipped).

    A record that has ids keeps them, even if it is an error.  Null keys and verdicts that the table doesn't allow are ignored silently, as
    an insert that ignores conflicts does.
    """
    out = {"status": "error", "result_id": None, "category_id": None, "match": None, "reasoning_trace": None, "blockquotes": [], "quote_error": False}
    try:
        data = json.loads(text or "")
    except (json.JSONDecodeError, RecursionError):
        return out
    if not isinstance(data, dict) or "result_id" not in data or "category_id" not in data:
        return out
    try:
        out |= {k: _identifier(data[k]) for k in ("result_id", "category_id")}
        if "match" not in data:
            return out
        out["match"] = _stored(data["match"])
        out["reasoning_trace"] = _stored(data.get("reasoning_trace", ""))
    except (TypeError, ValueError):
        return out
    from ..schema import MATCHES

    none = out["result_id"] is None or out["category_id"] is None
    out["status"] = "ignored" if none or out["match"] not in MATCHES else "ok"
    quotes = data.get("blockquotes", [])
    if isinstance(quotes, (str, list, dict)):  # a text gives its characters, an object its keys
        for quote in quotes:
            try:
                stored = _stored(quote)
            except TypeError:
                stored = None
            if stored is None:  # what came before it stays
                out["quote_error"] = True
                break
            out["blockquotes"].append(stored)
    return out


def parse_records(df: DataFrame, column: str = "value", to: str = "record") -> DataFrame:
    """``df`` with the struct ``to`` of each record's text."""

    ready(df.sparkSession)

    @F.pandas_udf(RECORD)
    def flatten(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([flatten_record(x) for x in texts], columns=["status", "result_id", "category_id", "match", "reasoning_trace", "blockquotes", "quote_error"]).astype({"result_id": "Int64", "category_id": "Int64"})

    return df.withColumn(to, flatten(F.col(column)))


#: A reply's object: whether there is one, the flags of its keys, and its values as JSON.
REPLY = "struct<found:boolean, has_match:boolean, match:string, blockquotes:string, shown:string>"


def reply_object(content: Column) -> Column:
    """The first object of each reply; ``shown`` is how a message shows it."""

    ready()

    @F.pandas_udf(REPLY)
    def extract(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            data = first_object(text)
            has = data is not None and "match" in data
            rows.append((data is not None, has, json.dumps(data["match"], ensure_ascii=False) if has else None, json.dumps(data.get("blockquotes", []), ensure_ascii=False) if has else None, None if data is None else str(data)))
        return pd.DataFrame(rows, columns=["found", "has_match", "match", "blockquotes", "shown"])

    return extract(content)


def parse_replies(df: DataFrame) -> DataFrame:
    """Replies (``custom_id, content, reasoning_content, error, has_response, has_choices``) with ``record`` JSON or ``failure``.

    Failures are looked for in order: transport error, no response, no choices,
    empty content, no object, no ``match``.
    """
    from .text import custom_id_parts, reasoning_before_json

    rid, cid = custom_id_parts(F.col("custom_id"))
    content = F.coalesce("content", F.lit(""))
    preview = F.replace(F.substring(content, 1, 200), F.lit("\n"), F.lit(" "))
    parsed = df.withColumn("reply", reply_object(content))
    failure = (
        F.when(F.coalesce("error", F.lit("")) != "", F.concat(F.lit("HTTP error: "), F.col("error")))
        .when(~F.col("has_response"), "No response received")
        .when(~F.col("has_choices"), "No choices in response")
        .when(content == "", "Empty content in response")
        .when(~F.col("reply.found"), F.concat(F.lit("No JSON found. Preview: "), preview, F.lit("...")))
        .when(~F.col("reply.has_match"), F.concat(F.lit("Missing 'match' field: "), F.col("reply.shown")))
    )
    trace = F.when(F.coalesce("reasoning_content", F.lit("")) != "", F.col("reasoning_content")).otherwise(reasoning_before_json(content))
    parsed = parsed.withColumns({"failure": failure, "result_id": rid, "category_id": cid, "reasoning_trace": trace})
    quoted = F.to_json(F.struct(F.col("reasoning_trace")))
    record = F.concat(
        F.lit('{"result_id": '), F.col("result_id").cast("string"), F.lit(', "category_id": '), F.col("category_id").cast("string"), F.lit(', "match": '), F.col("reply.match"),
        F.lit(', "reasoning_trace": '), F.expr("substring(q, 20, length(q) - 20)"), F.lit(', "blockquotes": '), F.col("reply.blockquotes"), F.lit("}"),
    )
    return parsed.withColumn("q", quoted).withColumn("record", F.when(F.col("failure").isNull(), record)).drop("q", "reply")

