"""Cleaning and feature preparation."""

from __future__ import annotations

import datetime as dt
from collections import Counter

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.functions.dates import as_of_date, day
from tidemark.operators.churn import add_churn_tier

# All characters that count as white space at either end of a text; the last of them is U+3000.
WHITESPACE = "".join(character for character in map(chr, range(0x3001)) if character.isspace())

# Fixed value: texts that read as a number.
NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))$"


def quoted(name: str) -> str:
    """A column name that may hold dots or backticks, as a reference."""
    return "`" + name.replace("`", "``") + "`"


def clean(df: DataFrame) -> DataFrame:
    """Plain column names, trimmed texts, and no row twice."""
    names = [name.strip().lower().replace(" ", "_") for name in df.columns]
    clashes = [name for name, times in Counter(names).items() if times > 1]
    if clashes:
        raise ValueError(f"column names become equal: {clashes}")
    renamed = df.toDF(*names)
    texts = [field.name for field in renamed.schema if isinstance(field.dataType, T.StringType)]
    return renamed.withColumns({name: F.btrim(F.col(quoted(name)), F.lit(WHITESPACE)) for name in texts}).dropDuplicates()


def add_date_parts(df: DataFrame, date: str) -> DataFrame:
    """Year, month, quarter, ISO week, day and English weekday name of a date column.

    A text column is read as a timestamp first. A missing date has missing parts.
    """
    if isinstance(df.schema[date].dataType, T.StringType):
        df = df.withColumn(date, F.to_timestamp(quoted(date)))
    value = F.col(quoted(date))
    return df.withColumns(
        {
            f"{date}_year": F.year(value),
            f"{date}_month": F.month(value),
            f"{date}_quarter": F.quarter(value),
            f"{date}_week": F.weekofyear(value),
            f"{date}_day": F.dayofmonth(value),
            f"{date}_weekday": F.date_format(value, "EEEE"),
        }
    )


def number_or_zero(df: DataFrame, column: str) -> DataFrame:
    """The column as a double; 0 for anything that is not a number."""
    value = F.col(quoted(column))
    if isinstance(df.schema[column].dataType, T.StringType):
        trimmed = F.btrim(value, F.lit(WHITESPACE))
        value = F.when(trimmed.rlike(NUMBER), trimmed.try_cast("double"))
    return df.withColumn(column, F.coalesce(F.nanvl(value.cast("double"), F.lit(0.0)), F.lit(0.0)))


def transform_transactions(df: DataFrame, date: str = "transaction_date", amount: str = "amount") -> DataFrame:
    return number_or_zero(add_date_parts(clean(df), date), amount)


def transform_churn_risk(
    logins: DataFrame, as_of: dt.date | str | None = None, last_login: str = "last_login_date"
) -> DataFrame:
    """Cleaned logins with whole days since the last one, and the tier."""
    cleaned = clean(logins)
    days = F.datediff(as_of_date(as_of), day(last_login))
    return add_churn_tier(cleaned.withColumn("days_since_login", days), "days_since_login")
