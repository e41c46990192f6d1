"""Cover-address predicates and target names."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# An address holding one of these words anywhere, in any case, is a placeholder.
BAD_KEYWORDS = ("logo", "icon", "default", "blank", "github")


def has_bad_keyword(url: Column, keywords: Sequence[str] = BAD_KEYWORDS) -> Column:
    """Null for a null address."""
    folded = F.lower(url)
    return reduce(or_, (F.contains(folded, F.lit(word.lower())) for word in keywords), F.lit(False))


def is_no_placeholder(url: Column, keywords: Sequence[str] = BAD_KEYWORDS) -> Column:
    """True unless the address is null or holds a bad keyword; the empty string passes."""
    return url.isNotNull() & F.coalesce(~has_bad_keyword(url, keywords), F.lit(False))


def is_usable_url(url: Column, keywords: Sequence[str] = BAD_KEYWORDS) -> Column:
    """A valid address that is also not empty."""
    return is_no_placeholder(url, keywords) & F.coalesce(url != "", F.lit(False))


def cover_target(directory: str, book_id: Column) -> Column:
    """File name a cover gets when covers are kept as loose files."""
    return F.concat(F.lit(directory.rstrip("/") + "/"), book_id, F.lit(".jpg"))
