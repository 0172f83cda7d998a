"""0/1 validators for master-data fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .amounts import flag

# Field patterns (Java regular expressions).
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]{2,}$"
TAX_ID_PATTERN = r"(?i)^[A-ZÑ&]{3,4}\d{6}$"
SUFFIX_PATTERN = r"^[A-Za-z0-9]{3}$"
DROPPED_PATTERN = r"[\t\n\r]"
LETTER_PATTERN = "[A-Za-z]"

# Digit counts and the shortest text that counts as present.
PHONE_DIGITS = (10, 12)
POSTCODE_DIGITS = (5, 5)
TEXT_LONGER_THAN = 5


def digits_valid(field: str, shortest: int, longest: int) -> Column:
    """1 when the field is ``shortest`` to ``longest`` digits and nothing else."""
    return flag(F.col(field).rlike(f"^[0-9]{{{shortest},{longest}}}$"))


def text_present(field: str) -> Column:
    """1 when the trimmed text is longer than five characters and has a letter."""
    text = F.trim(F.col(field))
    return flag((F.length(text) > TEXT_LONGER_THAN) & text.rlike(LETTER_PATTERN))


def pattern_valid(field: str, pattern: str) -> Column:
    """1 when the field matches after dropping tabs and line ends and trimming."""
    return flag(F.trim(F.regexp_replace(F.col(field), DROPPED_PATTERN, "")).rlike(pattern))
