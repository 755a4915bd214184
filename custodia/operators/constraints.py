"""Keys and required columns of tables: declared with a table, checked with every write."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.operators.keys import DuplicateKeyError, check_key

_KEY, _REQUIRED = "declared.key", "declared.required"


def declaration(key: Sequence[str] = (), required: Sequence[str] = ()) -> str:
    """The part of a CREATE TABLE statement that keeps the declared constraints."""
    if not key and not required:
        return ""
    return f" TBLPROPERTIES ('{_KEY}' = '{','.join(key)}', '{_REQUIRED}' = '{','.join(required)}')"


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _columns(text: str) -> list[str]:
    return [name for name in text.split(",") if name]


def key_of(spark: SparkSession, table: str) -> list[str]:
    return _columns(properties(spark, table).get(_KEY, ""))


def without_nulls(df: DataFrame, table: str) -> DataFrame:
    """The rows to be written to a table; a null in a column of its key or a required one stops the write.

    The check is part of the written columns, so it needs no pass of its own, and a
    write that it stops shows nothing.
    """
    held = properties(df.sparkSession, table)
    columns = dict.fromkeys([*_columns(held.get(_KEY, "")), *_columns(held.get(_REQUIRED, ""))])
    checked = {}
    for name in (name for name in columns if name in df.columns):
        missing = F.raise_error(F.lit(f"{table}: null in {name}")).cast(df.schema[name].dataType)
        checked[name] = F.coalesce(F.col(name), missing)
    return df.withColumns(checked) if checked else df


def refuse_repeats(rows: DataFrame, table: str, key: Sequence[str]) -> None:
    """Stop if several rows share a value of the key; one such value is named.

    Keys hardly repeat, so counting them before they are shuffled would only hold all keys
    of a file in memory: they are dealt by their values first.
    """
    wrong = check_key(rows.select(*key).repartition(*key), key).first() if key else None
    if wrong:
        value = ", ".join(str(wrong[name]) for name in key)
        raise DuplicateKeyError(f"{table}: {wrong.n_rows} rows with {', '.join(key)} = {value}")
