"""Scalar expressions shared by the inventory, privilege and support jobs."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Formats in which release pages write dates.
DATE_FORMATS = ("MMM d, yyyy", "MMMM d, yyyy", "yyyy-MM-dd")

# Days left below which a runtime is flagged.
RED_BELOW = 60
ORANGE_BELOW = 90


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_of(arr) -> Column:
    """First element; null for an empty or null array, also in ANSI mode."""
    return F.get(_col(arr), F.lit(0))


def first_field(arr, field: str) -> Column:
    """A field of the first struct in an array."""
    return first_of(arr)[field]


def principal_type(group, service_principal, user) -> Column:
    return (
        F.when(_col(group).isNotNull(), "Group")
        .when(_col(service_principal).isNotNull(), "Service Principal")
        .when(_col(user).isNotNull(), "User")
        .otherwise("UNKNOWN")
    )


def acl_display_name(kind, group, user, display) -> Column:
    """Access lists name groups and users by their own name."""
    return (
        F.when(_col(kind) == "Group", _col(group)).when(_col(kind) == "User", _col(user)).otherwise(_col(display))
    )


def assignment_display_name(kind, user, display) -> Column:
    """Workspace assignments name only users by their own name."""
    return F.when(_col(kind) == "User", _col(user)).otherwise(_col(display))


def flatten_struct(df: DataFrame, col: str, fields: Sequence[str]) -> DataFrame:
    """Add struct fields as columns of the same name."""
    return df.withColumns({field: F.col(col)[field] for field in fields})


def map_value(m, key: str) -> Column:
    """Value under a key; null if missing."""
    return _col(m)[key]


def tag_value(tags, key: str) -> Column:
    """Value of the first tag named ``key`` in an array of ``{key, value}`` maps; case matters."""
    return first_of(F.filter(_col(tags), lambda tag: tag["key"] == key))["value"]


def strip_lts(version) -> Column:
    return F.regexp_replace(_col(version), " LTS", "")


def runtime_number(spark_version) -> Column:
    """``15.4.x-scala2.12`` gives ``15.4``; a version without ``.x`` stays whole."""
    return F.substring_index(_col(spark_version), ".x", 1)


def drop_cols(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def days_until(ts, as_of=None) -> Column:
    """Complete 24-hour days from ``as_of`` (default: now) to ``ts``, truncated toward zero."""
    start = F.current_timestamp() if as_of is None else as_of if isinstance(as_of, Column) else F.lit(as_of)
    return F.timestamp_diff("DAY", start.cast("timestamp"), _col(ts))


def month_of(ts) -> Column:
    return F.date_trunc("MONTH", _col(ts))


def support_label(days, red: int = RED_BELOW, orange: int = ORANGE_BELOW) -> Column:
    return F.when(_col(days) < red, "red").when(_col(days) < orange, "orange").otherwise("default")


def parse_ts(c, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that fits; a text that none fits fails the query."""
    read = F.coalesce(*[F.try_to_timestamp(_col(c), F.lit(fmt)) for fmt in formats])
    unread = F.raise_error(F.concat(F.lit("not a date: "), _col(c))).cast("timestamp")
    return F.when(_col(c).isNull() | read.isNotNull(), read).otherwise(unread)


def stamp(df: DataFrame, by: str = "created_by", at: str = "created_date", user=None, now=None) -> DataFrame:
    """Add who and when; both can be given for repeatable runs."""
    return df.withColumns(
        {
            at: (F.current_timestamp() if now is None else F.lit(now)).cast("timestamp"),
            by: F.current_user() if user is None else F.lit(user),
        }
    )
