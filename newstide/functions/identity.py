"""Article identity and address choice."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def article_guid(title: Column, symbol: Column, pub_date: Column) -> Column:
    """SHA-256 hex of ``title|symbol|yyyy-MM-dd``.

    ``concat_ws`` leaves nulls out, so a missing part is written as the word ``None``,
    which is what the stored identities hold for it.
    """
    parts = [title, symbol, F.date_format(pub_date, "yyyy-MM-dd")]
    return F.sha2(F.concat_ws("|", *[F.coalesce(p, F.lit("None")) for p in parts]), 256)


def article_url(click_through: Column, preview: Column) -> Column:
    """The click-through address, else the preview address; an empty one counts as missing."""
    empty = F.lit("")
    return F.coalesce(F.nullif(click_through, empty), F.nullif(preview, empty))
