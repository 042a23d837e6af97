"""Declared schemas of the tables the pipeline produces (FIXTURES §C).

``conforms`` compares names and types at plan time -- no job runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


RAW = _st(("path", S), ("modificationTime", T.TimestampType()), ("length", L), ("content", T.BinaryType()))
SECTIONS = _st(("path", S), ("section_no", I), ("section", S))
CHUNKS = _st(("chunk_id", L), ("path", S), ("chunk_no", I), ("content", S))
CHUNK_EMBEDDINGS = _st(*[(f.name, f.dataType) for f in CHUNKS.fields], ("embedding", T.ArrayType(T.FloatType())))
INDEX = _st(*[(f.name, f.dataType) for f in CHUNK_EMBEDDINGS.fields], ("centroid", I), ("cell_dist", D))
ARTICLES = _st(("url", S), ("text", S))
MESSAGE = _st(("turn", L), ("role", S), ("content", S))
MESSAGES = _st(("conv_id", L), ("messages", T.ArrayType(MESSAGE)))
HITS = _st(("query_id", L), ("rank", I), ("score", D), ("chunk_id", L), ("path", S), ("content", S))
DOC = _st(("rank", I), ("content", S), ("path", S))
ANSWERS = _st(("query_id", L), ("question", S), ("result", S), ("sources", T.ArrayType(S)))
ANSWER_LOG = _st(("request_id", S), ("ts", T.TimestampType()),
                 ("messages", T.ArrayType(_st(("role", S), ("content", S)))), ("result", S), ("sources", T.ArrayType(S)))
ANSWER_METRICS = _st(("request_id", S), ("n_tokens", I), ("mean_sentence_tokens", D), ("type_token_ratio", D),
                     ("unigram_perplexity", D), ("refused", B))


def _strip(dt: T.DataType) -> T.DataType:
    """Data type with nullability removed (compared by names and types only)."""
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, _strip(f.dataType)) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(_strip(dt.elementType))
    if isinstance(dt, T.MapType):
        return T.MapType(_strip(dt.keyType), _strip(dt.valueType))
    return dt


def conforms(df: DataFrame, schema: T.StructType) -> bool:
    return _strip(df.schema) == _strip(schema)


def require(df: DataFrame, schema: T.StructType, what: str = "table") -> DataFrame:
    """Raise (at plan time) unless ``df`` has exactly ``schema``'s columns and types."""
    if not conforms(df, schema):
        raise ValueError(f"{what}: got {df.schema.simpleString()}, want {schema.simpleString()}")
    return df
