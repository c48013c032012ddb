"""Join shapes that stay balanced when one key holds much of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def left_fanout(parent: DataFrame, child: DataFrame, key: str, child_keys: DataFrame | None = None) -> DataFrame:
    """``parent LEFT JOIN child`` for a unique parent key and possibly hot child keys.

    In a left outer join Spark can only split a skewed left side, and here the
    many rows are on the right. So the matches are an inner join with the
    children on the left, which adaptive execution can split, and the childless
    parents are added by an anti join against the distinct child keys. Where the
    child is itself a long plan, ``child_keys`` gives its keys from a plain table.
    """
    matched = child.join(parent, key)
    childless = parent.join((child if child_keys is None else child_keys).select(key).distinct(), key, "left_anti")
    return matched.unionByName(childless, allowMissingColumns=True)
