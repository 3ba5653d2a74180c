"""Text expressions on Spark's own functions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _latin_pairs() -> tuple[str, str]:
    """Letters of the Latin blocks whose decomposition begins with a single ASCII letter, and that letter."""
    pairs = {}
    for code in range(0xC0, 0x250):
        base = unicodedata.normalize("NFKD", chr(code))[0]
        if base.isascii() and base.isalpha() and len(base) == 1 and base != chr(code):
            pairs[chr(code)] = base
    pairs |= {"ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ø": "o", "Ø": "O", "ß": "s", "ı": "i"}
    return "".join(pairs), "".join(pairs.values())


_FROM, _TO = _latin_pairs()


def unaccented(text: Column) -> Column:
    """Latin letters without diacritics, composed or not; other scripts stay as they are."""
    return F.translate(F.regexp_replace(text, r"\p{M}+", ""), _FROM, _TO)


def folded(text: Column) -> Column:
    """Lower-case words without diacritics, one blank between them, nothing else."""
    return F.trim(F.regexp_replace(F.lower(unaccented(text)), r"[^\p{L}\p{N}]+", " "))


def estimated_tokens(text: Column) -> Column:
    """``max(1, int(length / 3.2))``, 0 for the empty text, NULL for NULL."""
    return F.when(text == "", 0).when(text.isNotNull(), F.greatest(F.lit(1), (F.length(text) / F.expr("3.2D")).cast("int")))
