"""JSON column functions: parse with a fixed envelope, test the open map,
render records back to text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def parse_json(text: Column | str, schema: T.StructType) -> Column:
    """Parse JSON text into ``schema``. In PERMISSIVE mode malformed text
    keeps its raw value in ``_corrupt_record`` (appended to the struct) so
    the caller can dead-letter it instead of failing the job."""
    text = F.col(text) if isinstance(text, str) else text
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    return F.from_json(
        text,
        with_corrupt,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )


def json_map(text: Column | str) -> Column:
    """JSON object text -> ``map<string,string>`` (numbers become text,
    JSON nulls stay NULL, nested objects stay JSON text)."""
    text = F.col(text) if isinstance(text, str) else text
    return F.from_json(text, T.MapType(T.StringType(), T.StringType()))


def map_text_length(m: Column | str) -> Column:
    """Length of the compact JSON text of a map after dropping NULL members
    — the way a JSON library that omits nulls would serialise it. ``{}`` and
    ``{"a":null}`` both give 2."""
    m = F.col(m) if isinstance(m, str) else m
    return F.length(F.to_json(F.map_filter(m, lambda k, v: v.isNotNull())))


def with_member(text: Column | str, owner: str, name: str, value: Column) -> Column:
    """JSON text with member ``name`` of its object ``owner`` set to the text
    ``value``; every other member, nested ones too, stays. NULL where the text
    is no object or has no such owner."""
    text = F.col(text) if isinstance(text, str) else text
    whole = F.try_parse_json(text)
    inner = F.try_variant_get(whole, f"$.{owner}", "map<string,variant>")
    new = F.create_map(F.lit(name), F.parse_json(F.to_json(F.array(value))))
    # a JSON array of one text, so that its quotes are escaped; its element is the member
    new = F.transform_values(new, lambda k, v: F.variant_get(v, "$[0]", "variant"))
    changed = F.to_variant_object(F.map_concat(F.map_filter(inner, lambda k, v: k != name), new))
    rest = F.map_filter(F.try_variant_get(whole, "$", "map<string,variant>"), lambda k, v: k != owner)
    return F.when(inner.isNotNull(), F.to_json(F.to_variant_object(F.map_concat(rest, F.create_map(F.lit(owner), changed)))))


def record_text(*cols: Column | str) -> Column:
    """Record -> compact JSON text; NULL fields are left out."""
    return F.to_json(F.struct(*cols))
