"""Normalisers of the indicator domain, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.columns import trimmed

# Codes and spellings of the school networks, by the domain they come from.
NETWORK_CODES = {
    "assessment_result": {"total": ("0", "total"), "estadual": ("2", "estadual"), "municipal": ("3", "municipal"), "publica": ("5", "publica", "pública")},
    "student_dependency": {"federal": ("1", "federal"), "estadual": ("2", "estadual"), "municipal": ("3", "municipal"), "privada": ("4", "privada")},
    "target": {
        "total": ("total",), "federal": ("federal",), "estadual": ("estadual",), "municipal": ("municipal",),
        "publica": ("publica", "pública"), "privada": ("privada",),
    },
}


def normalize_network(text: Column, domain: str) -> Column:
    """The network's name, or null for what the domain does not know; accents are part of a spelling."""
    if domain not in NETWORK_CODES:
        raise ValueError(f"unknown network domain: {domain}")
    plain, out = F.lower(trimmed(text)), F.lit(None).cast("string")
    for name, spellings in NETWORK_CODES[domain].items():
        out = F.when(plain.isin(*spellings), name).otherwise(out)
    return out


def normalize_municipality_id(text: Column) -> Column:
    """Seven digits, zeros before; null where there are other characters or more than seven digits."""
    plain = trimmed(text.cast("string"))
    return F.when(plain.rlike(r"\A[0-9]{1,7}\z"), F.lpad(plain, 7, "0"))


def rate(value: Column) -> Column:
    """A measure in the exact type of the silver tables, by its decimal spelling; null if it is none."""
    return value.cast("string").try_cast("decimal(28,9)")


def year_start(year: Column) -> Column:
    return F.make_date(year.cast("int"), F.lit(1), F.lit(1))


def days_since(moment: Column, as_of: str) -> Column:
    return F.date_diff(F.lit(as_of).cast("date"), F.to_date(moment))


def payload_hash(*columns: str) -> Column:
    """A digest of the named columns; nulls have their own place, so that (null, a) is not (a, null)."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
