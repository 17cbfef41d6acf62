"""The fixed schema of normalised documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, D, L = T.StringType(), T.DoubleType(), T.LongType()
#: Column order is part of the format; fixed values.
COLUMNS = (
    ("text", S), ("id", S), ("url", S), ("language", S), ("dataset", S), ("source_name", S), ("source_repo", S), ("source_config", S), ("source_split", S),
    ("language_score", D), ("fasttext_score", D), ("score", D), ("answer_count", L), ("accepted_answer_id", S), ("int_score", L),
    ("token_count", L), ("word_count", L), ("char_count", L), ("estimated_tokens", L), ("mix_name", S), ("mix_weight", D),
)
OUTPUT = T.StructType([T.StructField(n, k) for n, k in COLUMNS])


def align(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """df with just the columns of the schema, cast where their type differs and null where they are missing."""
    have = dict(zip(df.columns, (f.dataType for f in df.schema), strict=True))

    def column(name: str, kind: T.DataType):
        if name not in have or (isinstance(have[name], (T.ArrayType, T.StructType, T.MapType)) and kind != S):
            return F.lit(None).cast(kind).alias(name)
        return F.col(f"`{name}`").try_cast(kind).alias(name)

    return df.select(*keep, *[column(n, k) for n, k in COLUMNS])
