"""Text and profile expressions of users."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper end of each age bucket and its label.
AGE_BUCKETS = [(24, "18-24"), (34, "25-34"), (44, "35-44"), (54, "45-54"), (65, "55-65")]


def letters_only(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), "[^a-z]", "")


def email(first: Column, last: Column, number: Column, domain: str) -> Column:
    return F.concat(letters_only(first), F.lit("."), letters_only(last), number.cast("string"), F.lit(domain))


def is_adult(birth: Column, on: Column) -> Column:
    return F.add_months(birth, 18 * 12) <= on


def age_bucket(age: Column) -> Column:
    """Label of the bucket; null below 18 and above 65."""
    out = F.when(age < 18, F.lit(None).cast("string"))
    for top, label in AGE_BUCKETS:
        out = out.when(age <= top, label)
    return out
