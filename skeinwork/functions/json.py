"""JSON columns: validity, decoding, message arrays, fingerprints and blob links, by Variant and higher-order functions."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import content_id


def is_json(c: Column) -> Column:
    return F.try_parse_json(c).isNotNull()


def decoded(c: Column) -> Column:
    """The value as Variant; malformed text stays a string, null stays null."""
    return F.coalesce(F.try_parse_json(c), c.cast("variant"))


def json_kind(c: Column) -> Column:
    """OBJECT, ARRAY, STRING, ... of a JSON text; null if it is malformed."""
    return F.regexp_extract(F.schema_of_variant(F.try_parse_json(c)), "^[A-Z]+", 0)


def message_list(messages: Column) -> Column:
    """The elements' own text, as written; null if it is no array."""
    return F.when(json_kind(messages) == "ARRAY", F.from_json(messages, "array<string>"))


def fingerprints(messages: Column) -> Column:
    """SHA-256 of each message's canonical JSON (keys sorted, compact)."""
    return F.transform(F.from_json(messages, "array<variant>"), lambda m: F.sha2(F.to_json(m), 256))


def append_json(messages: Column, response: Column) -> Column:
    """messages ++ response as one JSON array, spelled as the parts are: an array response extends, anything else is one element."""
    inner = lambda c: F.trim(F.substr(F.trim(c), F.lit(2), F.length(F.trim(c)) - 2))
    right = F.when(json_kind(response) == "ARRAY", inner(response)).otherwise(F.trim(response))
    left = inner(messages)
    both = F.concat_ws(",", F.nullif(left, F.lit("")), F.nullif(right, F.lit("")))
    return F.concat(F.lit("["), both, F.lit("]"))


def _loaded(text: str | None):
    """The value of a JSON text; the text itself where it is none."""
    try:
        return None if text is None else json.loads(text)
    except ValueError:
        return text


#: Members that can hold a link.
LINK_MEMBERS = ("image_url", "input_audio")


def _members(value) -> Iterator[tuple]:
    """(key, value) of every member of every object within a JSON value, in the order of its text; list items by number."""
    for key, inner in value.items() if isinstance(value, dict) else enumerate(value) if isinstance(value, list) else ():
        yield key, inner
        yield from _members(inner)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _links(payloads: pd.Series) -> pd.Series:
    def one(texts) -> list[str]:
        values = [_loaded(t) for t in texts if t and ('"url"' in t or "\\u" in t)]  # no other text has a member of that name
        urls = (inner.get("url") for v in values for key, inner in _members(v) if key in LINK_MEMBERS and isinstance(inner, dict))
        return list(dict.fromkeys(u for u in urls if isinstance(u, str) and u.startswith("s3://")))

    return payloads.map(one)


def blob_links(*columns: Column) -> Column:
    """Distinct s3:// links, in order of first sight: the url of an object under image_url or input_audio, at any depth.

    A link that stands there as plain text is not taken, and malformed JSON has none. How deep a payload goes is known
    only once it is read, so this is an Arrow function.
    """
    return _links(F.array(*columns))


@F.pandas_udf(T.StringType())
def canonical_json(texts: pd.Series) -> pd.Series:
    """JSON text with the keys of all objects in order, spelled one way; malformed text becomes a JSON string."""
    return texts.map(lambda t: None if t is None else json.dumps(_loaded(t), sort_keys=True, ensure_ascii=False))


def status_not_200(meta: Column) -> Column:
    """True if meta's object, or its env_state or telemetry (object or JSON text of one), has a status_code other than 200 or "200"."""
    v = F.try_parse_json(meta)

    def kind(x: Column) -> Column:
        return F.coalesce(F.schema_of_variant(x), F.lit(""))

    def nested(key: str) -> Column:
        x = F.try_variant_get(v, f"$.{key}", "variant")
        return F.when(kind(x) == "STRING", F.try_parse_json(F.try_variant_get(v, f"$.{key}", "string"))).otherwise(x)

    def bad(z: Column) -> Column:
        code = F.try_variant_get(z, "$.status_code", "variant")
        fine = ((kind(code) == "BIGINT") & (F.try_variant_get(z, "$.status_code", "long") == 200)) | ((kind(code) == "STRING") & (F.trim(F.try_variant_get(z, "$.status_code", "string")) == "200"))
        return code.isNotNull() & ~F.coalesce(fine, F.lit(False))

    return F.coalesce(bad(v), F.lit(False)) | F.coalesce(bad(nested("env_state")), F.lit(False)) | F.coalesce(bad(nested("telemetry")), F.lit(False))


def compact_row(*columns: str) -> Column:
    """A row as JSON without its null fields; nulls inside lists stay."""
    return F.to_json(F.struct(*columns))


def with_member(c: Column, key: str, value: Column) -> Column:
    """An object's text with one member added at its end; any other value (or null) becomes {"value": ..., key: ...}."""
    member = F.concat(F.lit(f'"{key}":'), value)
    inner = F.trim(F.substr(F.trim(c), F.lit(2), F.length(F.trim(c)) - 2))
    added = F.concat(F.lit("{"), F.concat_ws(",", F.nullif(inner, F.lit("")), member), F.lit("}"))
    quoted = F.when(is_json(c), c).otherwise(F.coalesce(F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r"^\{\"v\":(.*)\}$", 1), F.lit("null")))
    return F.when(json_kind(c) == "OBJECT", added).otherwise(F.concat(F.lit('{"value":'), F.when(c.isNull(), F.lit("null")).otherwise(quoted), F.lit(","), member, F.lit("}")))


def deterministic_id(df: DataFrame, json_columns: tuple[str, ...] = ()) -> Column:
    """The id that a record's content gives: that of its messages; of a record without any, that of all its fields but
    created_at and meta_json. Nulls count as not there. The order of keys, and blanks between them, make no difference.
    """
    rest = [c for c in df.columns if c not in ("messages", "created_at", "meta_json")]
    whole = F.to_json(F.struct(*[(decoded(F.col(c)) if c in json_columns else F.col(c)).alias(c) for c in rest])) if rest else F.lit("{}")
    return content_id(canonical_json(F.coalesce(F.col("messages"), whole) if "messages" in df.columns else whole))


def _grown(x):
    if isinstance(x, str) and x.lstrip()[:1] in ("{", "["):
        inner = _loaded(x)
        return x if inner is x else _grown(inner)
    if isinstance(x, dict):
        return {k: _grown(v) for k, v in x.items()}
    return [_grown(v) for v in x] if isinstance(x, list) else x


def _compact(x) -> str:
    return json.dumps(x, ensure_ascii=False, separators=(",", ":"))


@F.pandas_udf(T.StringType())
def expanded_json(texts: pd.Series) -> pd.Series:
    """JSON text with strings that are themselves JSON objects or arrays expanded, however deep; malformed text as it is.

    Recursion is beyond column functions, so this is an Arrow function; it is for output, not for filters.
    """

    def one(t: str | None) -> str | None:
        x = _loaded(t)
        return t if x is t else _compact(_grown(x))

    return texts.map(one)


def _plain(c: Column, kind: T.DataType) -> Column:
    """A value as JSON can hold it: NaN is null, bytes are named base64; nested ones too."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), c)
    if isinstance(kind, T.BinaryType):
        return F.when(c.isNotNull(), F.struct(F.lit("base64").alias("encoding"), F.base64(c).alias("data")))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _plain(x, kind.elementType))
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[_plain(c[f.name], f.dataType).alias(f.name) for f in kind]))
    return c


def json_rows(df: DataFrame, json_columns: tuple[str, ...]) -> DataFrame:
    """(value): each row as a JSON object with its nulls; JSON columns as what they hold, expanded however deep.

    NaN is null, bytes are {"encoding": "base64", "data": ...}, times are ISO. Malformed JSON stays a string.
    """
    own = [c for c in df.columns if c in json_columns]

    @F.pandas_udf(T.StringType())
    def grow(rows: pd.Series) -> pd.Series:
        def one(t: str) -> str:
            row = json.loads(t)
            return _compact(row | {c: _grown(row[c]) for c in own})

        return rows.map(one)

    text = F.to_json(F.struct(*[_plain(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema]), {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"})
    return df.select((grow(text) if own else text).alias("value"))
