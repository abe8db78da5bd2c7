"""String helpers: zero-filled ids, image paths, lists written as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zero_fill(value: Column, width: int) -> Column:
    """Left-fill with zeros; longer values stay whole (``lpad`` alone would cut them)."""
    text = value.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def image_path(article_id: Column, root: str) -> Column:
    name = zero_fill(article_id, 10)
    return F.concat(F.lit(f"{root}/images/"), F.substring(name, 1, 3), F.lit("/"), name, F.lit(".jpg"))


def parse_id_list(text: Column, limit: int | None = None) -> Column:
    """Ids of ``[1, 2]``, ``1 2`` or ``['1','2']`` as strings, in order."""
    bare = F.regexp_replace(text, "[\\[\\]'\"]", "")
    ids = F.filter(F.split(bare, "[,\\s]+"), lambda x: x != "")
    return F.slice(ids, 1, limit) if limit else ids


def joined(ids: Column) -> Column:
    return F.concat_ws(" ", ids.cast("array<string>"))
