"""Tickers, identifiers and free text."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


@functools.cache
def _folds() -> tuple[str, str, dict[str, str]]:
    """By the compatibility decomposition without combining marks: characters, the single ones that they become, and the
    Latin ligatures and digraphs that become several."""
    singles, several = {"ı": "i"}, {}
    for code in [*range(0x80, 0xD800), *range(0xF900, 0x10000)]:
        folded = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if len(folded) == 1 and folded != chr(code):
            singles[chr(code)] = folded
        elif len(folded) > 1 and folded.isascii() and folded.isalpha() and (code < 0x250 or 0xFB00 <= code <= 0xFB06):
            several[chr(code)] = folded
    return "".join(singles), "".join(singles.values()), several


def normalize_ticker(x: Column) -> Column:
    """Upper case without blanks around and without the exchange suffix; empty becomes null."""
    bare = F.regexp_replace(F.trim(F.upper(x)), r"\.IS$", "")
    return F.when(bare != "", bare)


def security_id(ticker: Column) -> Column:
    """Identifier of a security that no mapping names."""
    return F.concat(F.lit("SEC_"), F.substring(F.sha2(F.concat(F.lit("BIST:EQUITY:"), ticker), 256), 1, 12))


def fold_accents(x: Column) -> Column:
    """x with every character as its base character, combining marks dropped, and the dotless i as i."""
    singles, plain, several = _folds()
    for ligature, letters in several.items():
        x = F.replace(x, F.lit(ligature), F.lit(letters))
    return F.regexp_replace(F.translate(x, singles, plain), r"\p{Mn}+", "")


#: Shapes of credentials in error texts, the part to keep as group 1, and how much of a text is kept (fixed values).
CREDENTIALS = [
    r"(?i)(authorization\s*[:=]\s*)[^\s,;]+",
    r"(?i)((?:api[_-]?key|token|password|secret)\s*[:=]\s*)[^\s,;&]+",
    r"(?i)([?&](?:api[_-]?key|token|password|secret)=)[^&\s]+",
]
ERROR_LENGTH = 1000


def sanitized(x: Column, limit: int = ERROR_LENGTH) -> Column:
    """Error text without the values of credentials, cut to a length; null becomes empty."""
    x = F.coalesce(x, F.lit(""))
    for shape in CREDENTIALS:
        x = F.regexp_replace(x, shape, "$1[REDACTED]")
    return F.substring(x, 1, limit)
