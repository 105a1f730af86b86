"""Masks and pseudonyms for personal data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of personal data.
PII_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": r"\b[0-9]{3}-[0-9]{3}-[0-9]{4}\b",
    "card": r"\b[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}\b",
    "ipv4": r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b",
    "pan": r"\b[A-Z]{5}[0-9]{4}[A-Z]\b",
}

# A character that every match of a pattern contains, where there is one.
PII_SIGNS = {"email": "@", "phone": "-", "card": "", "ipv4": ".", "pan": ""}


def mask_identity_card(c: Column) -> Column:
    """Only the four digits of a ten-character tax id stay: ``XXXXX1234X``."""
    return F.concat(F.lit("XXXXX"), F.substring(c, 6, 4), F.lit("X"))


def mask_phone(c: Column) -> Column:
    return F.concat(F.lit("XXXXXX"), F.right(c, F.lit(4)))


def mask_email(c: Column) -> Column:
    return F.concat(F.left(c, F.lit(3)), F.lit("****@****.com"))


def pseudonym(c: Column, salt: str) -> Column:
    """A stable stand-in that cannot be reversed without the salt."""
    return F.sha2(F.concat(F.lit(salt), c.cast("string")), 256)
