"""Demographic categories (F-18, F-19)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import registry
from ._util import col_of

# Fixed value: combined code such as MALE_18_24 or FEMALE_65_PLUS.
_GROUP_PATTERN = r"^([A-Z]+)_(.*)$"


def split_group_gender(c) -> Column:
    """F-18: ``MALE_18_24`` → ``MALE``."""
    return F.nullif(F.regexp_extract(col_of(c), _GROUP_PATTERN, 1), F.lit(""))


def split_group_age(c) -> Column:
    """F-18: ``MALE_18_24`` → ``18-24``; ``FEMALE_65_PLUS`` → ``65+``."""
    rest = F.nullif(F.regexp_extract(col_of(c), _GROUP_PATTERN, 2), F.lit(""))
    return F.regexp_replace(F.regexp_replace(rest, "_PLUS$", "+"), "_", "-")


def normalise_gender(c) -> Column:
    """F-19: Homme/Femme/MALE/... → Male/Female; anything else → Unknown."""
    v = F.initcap(F.trim(col_of(c)))
    mapping = F.create_map(*[F.lit(x) for kv in registry.GENDER_VALUES.items() for x in kv])
    return F.coalesce(mapping[v], F.lit(registry.UNKNOWN))


def normalise_age(c) -> Column:
    """F-19: keep a known bracket, map everything else ("0", NULL) to Unknown."""
    v = F.trim(col_of(c))
    return F.when(v.isin(*registry.AGE_BRACKETS), v).otherwise(F.lit(registry.UNKNOWN))
