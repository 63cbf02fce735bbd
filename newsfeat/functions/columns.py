"""Column-set utilities (P16-P26): exact-case selection and dropping,
name cleaning, schema conformance, casts and JSON instances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The 16 moderation categories and 12 entity types produced by
# the scorers, and the column list the scoring model expects (in order).
MODERATION_CATEGORIES = ["Toxic", "Insult", "Profanity", "Derogatory", "Sexual", "Death, Harm & Tragedy",
                         "Violent", "Firearms & Weapons", "Public Safety", "Health", "Religion & Belief",
                         "Illicit Drugs", "War & Conflict", "Politics", "Finance", "Legal"]
ENTITY_TYPES = ["PERSON", "OTHER", "ORGANIZATION", "EVENT", "LOCATION", "WORK_OF_ART", "CONSUMER_GOOD",
                "NUMBER", "DATE", "PRICE", "ADDRESS", "PHONE_NUMBER"]
REQUIRED_COLUMNS = [
    "uri", "url", "title", "body", "date", "time", "dateTime", "dateTimePub", "lang", "isDuplicate", "dataType",
    "sentiment", "eventUri", "relevance", "image", "authors", "sharesFacebook", "sourceTitle",
    "sourceLocationLabel", "categoryLabels", "categoryWeights", "importanceRank", "alexaGlobalRank",
    "alexaCountryRank", "date_column", "year", "month", "year_month", "topic", "split", "shares_scaled",
    "body_pre", "score", "magnitude", "num_documents", "Toxic", "Insult", "Profanity", "Derogatory", "Sexual",
    "Death_Harm__Tragedy", "Violent", "Firearms__Weapons", "Public_Safety", "Health", "Religion__Belief",
    "Illicit_Drugs", "War__Conflict", "Politics", "Finance", "Legal", "PERSON", "OTHER", "ORGANIZATION",
    "EVENT", "LOCATION", "WORK_OF_ART", "CONSUMER_GOOD", "NUMBER", "PERSON_mean_salience",
    "OTHER_mean_salience", "ORGANIZATION_mean_salience", "EVENT_mean_salience", "LOCATION_mean_salience",
    "WORK_OF_ART_mean_salience", "CONSUMER_GOOD_mean_salience", "NUMBER_mean_salience", "DATE_mean_salience",
    "PRICE", "PRICE_mean_salience", "ADDRESS", "ADDRESS_mean_salience", "PHONE_NUMBER",
    "PHONE_NUMBER_mean_salience"]
# Columns left out of the model features (P24) and of the scoring request
# (P18, together with the target); the duplicate DATE is removed for the request.
OMIT_COLUMNS = ["uri", "url", "date", "body", "time", "dateTime", "dateTimePub", "lang", "isDuplicate",
                "dataType", "sentiment", "eventUri", "image", "sharesFacebook", "sourceLocationLabel",
                "categoryLabels", "categoryWeights", "alexaCountryRank", "date_column", "year", "year_month",
                "num_documents", "PERSON", "OTHER", "ORGANIZATION", "EVENT", "LOCATION", "WORK_OF_ART",
                "CONSUMER_GOOD", "NUMBER", "DATE", "NUMBER_mean_salience", "DATE_mean_salience", "PRICE",
                "ADDRESS", "ADDRESS_mean_salience", "PHONE_NUMBER", "PHONE_NUMBER_mean_salience"]
REQUEST_OMIT = [c for c in OMIT_COLUMNS if c != "DATE"]


def clean_name(name: str) -> str:
    """Remove ``&``, (the reference's ``\\s+`` step replaces the literal
    text ``\\s+``, a no-op; trap T8), remove ``,``, space -> ``_``."""
    return name.replace("&", "").replace(r"\s+", " ").replace(",", "").replace(" ", "_")


def clean_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_name(c) for c in df.columns])


def select_except(df: DataFrame, excluded: Sequence[str]) -> DataFrame:
    """Every column except ``excluded``, compared with exact case
    (trap T1).  Columns are addressed by position, so a frame holding both
    ``date`` and ``DATE`` (legal, but ambiguous by name) can be projected."""
    ex = set(excluded)
    names = df.columns
    tmp = df.toDF(*[f"__c{i}" for i in range(len(names))])
    return tmp.select(*[F.col(f"__c{i}").alias(n) for i, n in enumerate(names) if n not in ex])


def drop_exact(df: DataFrame, name: str, strict: bool = False) -> DataFrame:
    """Drop one column by exact-case name.  ``df.drop('DATE')`` would
    also drop ``date`` (case-insensitive resolution), so select the rest."""
    if name not in df.columns:
        if strict:
            raise KeyError(name)
        return df
    return select_except(df, [name])


def conform(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS, fill=0) -> DataFrame:
    """P20: every required column exists; a missing one is the constant
    ``fill``.  Existing columns are kept; order = input, then the added ones."""
    have = set(df.columns)
    lower = {c.lower() for c in df.columns}
    missing = {c: F.lit(fill) for c in required if c not in have and c.lower() not in lower}
    return df.withColumns(missing) if missing else df


def cast_to_string(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P16."""
    return df.select(*[F.col(c).cast("string").alias(c) if c in cols else F.col(c) for c in df.columns])


def new_columns(before: DataFrame, after: DataFrame) -> list[str]:
    """Columns of ``after`` that ``before`` did not have (e.g. the entity
    columns a scorer added), in ``after`` order."""
    old = set(before.columns)
    return [c for c in after.columns if c not in old]


def feature_columns(columns: Sequence[str], omit: Sequence[str], target: str, split: str = "split") -> list[str]:
    """Feature list = columns minus the omit list, the target and the split."""
    drop = set(omit) | {target, split}
    return [c for c in columns if c not in drop]


def to_instances(df: DataFrame, out: str = "instance") -> DataFrame:
    """One JSON object per row, with the same keys in every one
    (a null is written as such)."""
    fields = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(F.to_json(fields, {"ignoreNullFields": "false"}).alias(out))

