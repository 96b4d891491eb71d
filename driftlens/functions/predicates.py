"""NULL semantics of the comparison rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def changed(old: Column, new: Column) -> Column:
    """Value rule predicate: different, and a NULL on either side counts as a change.

    This is how a pandas ``!=`` behaves after a left merge (NaN != anything),
    so an unmatched baseline row fires every value rule, and NULL against NULL
    is reported too.
    """
    return F.coalesce(old != new, F.lit(True))


def distinct_from(old: Column, new: Column) -> Column:
    """Strict predicate: ``IS DISTINCT FROM`` (NULL equals NULL)."""
    return ~old.eqNullSafe(new)
