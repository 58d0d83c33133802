"""Recognising period columns in a header."""

from __future__ import annotations

import re
from collections.abc import Iterable

# How published headers write each kind of period.
PERIOD_PATTERNS = {
    "year": r"\d{4}",
    "semester": r"\d{4}-S[12]",
    "month": r"\d{4}-\d{2}",
}


def period_columns(columns: Iterable[str], granularity: str) -> list[str]:
    """Header cells that name a period of this granularity; all others are ignored."""
    pattern = re.compile(PERIOD_PATTERNS[granularity])
    return [name for name in columns if pattern.fullmatch(name.strip())]
