"""Names and keys: snake case, recursive key normalisation, slugs."""

import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

# Java's Unicode \s lacks the four separators 1C-1F that count as white space here.
_SPACE = r"\s\x1c-\x1f"
_SEPARATOR = rf"(?U)[-{_SPACE}]"


def snake(col) -> Column:
    """Every dash or white-space character becomes one underscore, then lower case.

    Camel case is not split: ``displayName`` gives ``displayname``.
    """
    return F.lower(F.regexp_replace(col, _SEPARATOR, "_"))


def snake_name(name: str) -> str:
    """`snake` for a name known when the plan is built."""
    return re.sub(r"[-\s]", "_", name).lower()


def normalize_map(col) -> Column:
    """Snake-case the keys of a string-keyed map; of colliding keys the last one wins."""
    col = F.col(col) if isinstance(col, str) else col
    # Reversed, so that the first position of a key is that of its last entry.
    reversed_entries = F.struct(
        F.reverse(F.transform(F.map_keys(col), snake)).alias("keys"), F.reverse(F.map_values(col)).alias("values")
    )

    def rebuild(entries):
        distinct = F.array_distinct(entries["keys"])
        values = F.transform(
            distinct, lambda key: F.get(entries["values"], (F.array_position(entries["keys"], key) - 1).cast("int"))
        )
        return F.map_from_arrays(distinct, values)

    # The one-element array binds the normalised keys, which are then computed once per row.
    return F.get(F.transform(F.array(reversed_entries), rebuild), F.lit(0))


def _normal_type(dtype: DataType) -> DataType:
    if isinstance(dtype, StructType):
        return StructType([StructField(snake_name(f.name), _normal_type(f.dataType), f.nullable) for f in dtype])
    if isinstance(dtype, ArrayType):
        return ArrayType(_normal_type(dtype.elementType), dtype.containsNull)
    if isinstance(dtype, MapType):
        return MapType(dtype.keyType, _normal_type(dtype.valueType), dtype.valueContainsNull)
    return dtype


def _holds_map(dtype: DataType) -> bool:
    if isinstance(dtype, StructType):
        return any(_holds_map(f.dataType) for f in dtype)
    if isinstance(dtype, ArrayType):
        return _holds_map(dtype.elementType)
    return isinstance(dtype, MapType)


def _normalized(col: Column, dtype: DataType) -> Column:
    if not _holds_map(dtype):
        # Struct fields are matched by position in a cast, so it only renames.
        return col.cast(_normal_type(dtype)) if dtype != _normal_type(dtype) else col
    if isinstance(dtype, MapType):
        by_key = normalize_map(col)
        if _holds_map(dtype.valueType) or dtype.valueType != _normal_type(dtype.valueType):
            by_key = F.transform_values(by_key, lambda _, v: _normalized(v, dtype.valueType))
        return by_key
    if isinstance(dtype, ArrayType):
        return F.transform(col, lambda x: _normalized(x, dtype.elementType))
    fields = [_normalized(col[f.name], f.dataType).alias(snake_name(f.name)) for f in dtype]
    return F.when(col.isNotNull(), F.struct(*fields))


def normalize_schema(df: DataFrame) -> DataFrame:
    """Normalise the names of all columns, all nested fields and all map keys."""
    if df.schema == _normal_type(df.schema) and not _holds_map(df.schema):
        return df
    return df.select(*[_normalized(F.col(f"`{f.name}`"), f.dataType).alias(snake_name(f.name)) for f in df.schema])


def normalize_columns(df: DataFrame) -> DataFrame:
    """Normalise the column names only."""
    return df.toDF(*[snake_name(name) for name in df.columns])


# Plain functions take rows by the hundred. Arrow's batches of thousands of long texts fill a worker's memory.
@F.udf(StringType(), useArrow=False)
def _to_ascii(value):
    return value and unicodedata.normalize("NFKD", value).encode("ascii", "ignore").decode("ascii")


@F.udf(StringType(), useArrow=False)
def _to_composed(value):
    return value and unicodedata.normalize("NFKC", value)


def _unless_ascii(col, normal_form) -> Column:
    """A normal form of a text; ASCII texts have it already and are not passed to Python."""
    col = F.col(col) if isinstance(col, str) else col
    is_ascii = F.octet_length(col) == F.char_length(col)
    return F.when(is_ascii, col).otherwise(normal_form(F.when(~is_ascii, col)))


def slug(col, allow_unicode: bool = False) -> Column:
    """File-name form of a text.

    Only the Unicode normal form needs Python, the rest runs in the JVM. Feed
    it distinct values where a column repeats them.
    """
    if allow_unicode:
        text, flag, word = _unless_ascii(col, _to_composed), "(?U)", r"\p{L}\p{N}_"
    else:
        text, flag, word = _unless_ascii(col, _to_ascii), "", "a-z0-9_"
    text = F.regexp_replace(F.lower(text), rf"{flag}[^{word}{_SPACE}-]+", "")
    return F.btrim(F.regexp_replace(text, rf"{flag}[-{_SPACE}]+", "-"), F.lit("-_"))
