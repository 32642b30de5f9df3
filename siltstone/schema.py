"""Schemas of the tables that operators exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE_TYPES = ("code", "confluence", "jira")
SYMBOL_TYPES = ("function", "class", "method", "component", "interface", "type", "endpoint", "section", "other")
RELATIONSHIPS = ("imports", "calls", "extends", "implements")

_strings = T.ArrayType(T.StringType())


def _struct(text: str, **other: T.DataType) -> T.StructType:
    """Columns by name, strings unless given in other."""
    return T.StructType([T.StructField(n, other.get(n, T.StringType())) for n in text.split()])


RAW_DOCUMENT = _struct("source_type source_id content repo provider ref file_path language last_modified url labels content_hash", last_modified=T.TimestampType(), labels=_strings)

_arrays = {n: _strings for n in ("imports", "calls", "extends_symbols", "implements_symbols", "framework_markers", "heading_path", "labels")}
CHUNK = _struct(
    "chunk_id source_type source_id content display_content repo file_path language symbol_name symbol_type start_line end_line imports calls "
    "extends_symbols implements_symbols exported framework_markers url last_modified content_hash heading_path labels",
    start_line=T.IntegerType(), end_line=T.IntegerType(), exported=T.BooleanType(), last_modified=T.TimestampType(), **_arrays,
)

STORED_CHUNK = T.StructType([*CHUNK, T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("created_at", T.TimestampType()), T.StructField("updated_at", T.TimestampType())])

EDGE = _struct("repo from_symbol to_symbol relationship from_path from_name to_path to_name")

WIKI_PAGE = _struct("id title status parent_id created_at html webui")


def conform(df: DataFrame, schema: T.StructType, extra: tuple[str, ...] = ()) -> DataFrame:
    """df with exactly the schema's columns and types, and the extra ones: missing ones null, missing arrays empty, missing flags false."""
    have = set(df.columns)

    def column(f: T.StructField):
        value = F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)
        if isinstance(f.dataType, T.ArrayType) and f.name != "embedding":
            value = F.coalesce(value, F.array().cast(f.dataType))
        if f.name == "exported":
            value = F.coalesce(value, F.lit(False))
        return value.alias(f.name)

    return df.select(*map(column, schema), *extra)
