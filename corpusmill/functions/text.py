"""Column expressions for text measures and for coercing loosely typed columns. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The 29 white-space code points; fixed values.
BLANKS = "".join(map(chr, (*range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
TOKENS_PER_WORD = 1.3
#: What counts as a number in text; an underscore may stand between digits.
INTEGER = r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"
FLOAT = r"(?i)^\s*[+-]?(([0-9]+(_[0-9]+)*\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+(_[0-9]+)*)(e[+-]?[0-9]+(_[0-9]+)*)?|inf(inity)?|nan)\s*$"


def words(text: Column) -> Column:
    """What stands between blanks. All blanks become spaces first, so that the text is cut at a single character, without a regular
    expression, which takes three times as long."""
    return F.array_remove(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), "")


def word_count(text: Column) -> Column:
    return F.when(text.isNotNull(), F.size(words(text)).cast("bigint"))


def char_count(text: Column) -> Column:
    return F.length(text).cast("bigint")


def estimated_tokens(token_count: Column, n_words: Column) -> Column:
    """The known count unless it is null or 0; else 1.3 a word, rounded half to even, at least 1."""
    return F.coalesce(F.nullif(token_count, F.lit(0)), F.greatest(F.lit(1), F.rint(n_words * F.lit(TOKENS_PER_WORD)).cast("bigint")))


def as_float(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return F.when(value.rlike(FLOAT), F.regexp_replace(F.trim(value), "_", "").try_cast("double"))
    return value.try_cast("double") if isinstance(kind, (T.NumericType, T.BooleanType)) else F.lit(None).cast("double")


def as_int(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return F.when(value.rlike(INTEGER), F.regexp_replace(F.trim(value), "_", "").try_cast("bigint"))
    return value.try_cast("bigint") if isinstance(kind, (T.NumericType, T.BooleanType)) else F.lit(None).cast("bigint")


def as_string(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BooleanType):
        return F.when(value, "True").when(~value, "False")
    return value.cast("string")


def stable_id(text: Column) -> Column:
    """The first 12 hexadecimal digits of SHA-256."""
    return F.substring(F.sha2(text, 256), 1, 12)


def file_key(path: Column) -> Column:
    return F.regexp_replace(path, r"[/\\]", "__")


def shard_name(prefix: Column | str, index: Column, suffix: str = ".parquet") -> Column:
    return F.format_string(f"%s_shard_%05d{suffix}", F.lit(prefix) if isinstance(prefix, str) else prefix, index)
