"""Declared table schemas and schema alignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DETAIL_FIELDS = (
    "title string, description string, year int, make string, model string, material string, "
    "weight_kg int, width_cm int, depth_cm int, sleepers int, seats int, engine_make string, "
    "engine_type string, engine_effect_hp int, boat_max_speed_knots int, registration_number string, "
    "municipality string, county string, postal_code string, lat double, lng double"
)

# Detail columns that keep their old value when a newer snapshot carries none.
DETAIL_COLUMNS = [part.split()[0] for part in _DETAIL_FIELDS.split(", ")]


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
    "array<bigint>": T.ArrayType(T.LongType()),
    "array<double>": T.ArrayType(T.DoubleType()),
    "array<float>": T.ArrayType(T.FloatType()),
}


def _schema(columns: str) -> T.StructType:
    """Built without a session, so the module can be imported before Spark starts."""
    pairs = (column.split() for column in columns.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


STAGING_ADS = _schema(
    "ad_id bigint, ad_url string, price int, specs_text string, scraped_at timestamp"
)
STAGING_ITEM_DETAILS = _schema(
    f"ad_id bigint, scraped_at timestamp, source_json string, equipment array<string>, {_DETAIL_FIELDS}"
)
ADS = _schema(
    f"ad_id bigint, ad_url string, {_DETAIL_FIELDS}, equipment array<string>, latest_price int, "
    "first_seen_at timestamp, last_seen_at timestamp, last_scraped_at timestamp, "
    "last_edited_at timestamp, active boolean, has_embeddings boolean, "
    "semantic_processed_at timestamp, source_raw string"
)
PRICE_HISTORY = _schema("ad_id bigint, price int, changed_at timestamp")
TEXT_CHUNKS = _schema(
    "chunk_id bigint, ad_id bigint, chunk_source string, chunk_text string, chunk_order int, "
    "chunk_length int, overlap_words int, embedding array<float>, created_at timestamp, updated_at timestamp"
)
SEMANTIC_SCORES = _schema(
    "score_id bigint, ad_id bigint, aspect string, raw_score double, normalized_score double, "
    "supporting_chunks array<bigint>, score_method string, created_at timestamp"
)
SEARCH_CACHE = _schema(
    "query_hash string, query_text string, result_ad_ids array<bigint>, similarity_scores array<double>, "
    "search_method string, expires_at timestamp, created_at timestamp"
)

TABLES = {
    "staging_ads": STAGING_ADS,
    "staging_item_details": STAGING_ITEM_DETAILS,
    "ads": ADS,
    "price_history": PRICE_HISTORY,
    "text_chunks": TEXT_CHUNKS,
    "semantic_scores": SEMANTIC_SCORES,
    "search_cache": SEARCH_CACHE,
}

KEYS = {
    "staging_ads": ["ad_id", "scraped_at"],
    "staging_item_details": ["ad_id", "scraped_at"],
    "ads": ["ad_id"],
    "price_history": ["ad_id", "changed_at"],
    "text_chunks": ["ad_id", "chunk_source", "chunk_order"],
    "semantic_scores": ["ad_id", "aspect"],
    "search_cache": ["query_hash"],
}

COLUMN_DEFAULTS = {"active": True, "has_embeddings": False}


def _aligned(df: DataFrame, field: T.StructField) -> Column:
    if field.name not in df.columns:
        value = F.lit(None).cast(field.dataType)
    else:
        have = df.schema[field.name].dataType
        if have == field.dataType:
            value = F.col(field.name)
        elif isinstance(have, T.StringType) and isinstance(field.dataType, T.ArrayType):
            value = F.from_json(F.col(field.name), field.dataType)
        elif isinstance(have, T.StringType):
            value = F.nullif(F.col(field.name), F.lit("")).try_cast(field.dataType)
        elif isinstance(have, (T.ArrayType, T.MapType, T.StructType)):
            value = F.to_json(F.col(field.name)).cast(field.dataType)
        else:
            value = F.col(field.name).try_cast(field.dataType)
    if field.name in COLUMN_DEFAULTS:
        value = F.coalesce(value, F.lit(COLUMN_DEFAULTS[field.name]))
    return value.alias(field.name)


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bring any older layout of a table to ``schema``.

    Missing columns are added as typed NULL, wrongly typed ones are cast (an empty string becomes
    NULL first), declared defaults fill flags, and unknown columns are dropped.
    """
    return df.select(*[_aligned(df, field) for field in schema.fields])
