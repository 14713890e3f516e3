"""Composite row keys: `user_item` or `user_item_time`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "_"


def rating_key(user_id: Column, item_id: Column, event_time: Column | None = None) -> Column:
    """NULL when a part is NULL, so that no two ratings share a half-empty key."""
    parts = [user_id, item_id] + ([event_time] if event_time is not None else [])
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(SEPARATOR))
        pieces.append(part.cast("string"))
    return F.concat(*pieces)


def key_parts(row_key: Column) -> Column:
    """The parts as an array; trailing empty parts are not parts."""
    return F.split(F.rtrim(row_key, F.lit(SEPARATOR)), SEPARATOR)


def key_part(row_key: Column, position: int) -> Column:
    """Part `position` (0 user, 1 item, 2 time), NULL when the key is shorter."""
    return F.get(key_parts(row_key), F.lit(position))
