"""Array expressions on token and id sequences."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Reserved ids and the mask used for ignored target positions.
PAD_ID = 0
EOS_ID = 1
UNK_ID = 2
FIRST_FREE_ID = 3
IGNORED = -100


def truncate(ids: Column, max_length: int) -> Column:
    """At most the first `max_length` items."""
    return F.slice(ids, 1, max_length)


def pad(ids: Column, length: Column, pad_id: int = PAD_ID) -> Column:
    """Fill up with the pad id to `length`; longer arrays stay as they are."""
    missing = F.greatest(length - F.size(ids), F.lit(0))
    return F.concat(ids, F.array_repeat(F.lit(pad_id), missing))


def restore_mask(ids: Column, pad_id: int = PAD_ID, ignored: int = IGNORED) -> Column:
    """Replace the ignored-position marker by the pad id."""
    return F.transform(ids, lambda i: F.when(i == ignored, F.lit(pad_id)).otherwise(i))
