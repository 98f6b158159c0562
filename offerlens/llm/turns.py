"""Turns of conversations in an order that any row can be placed in by itself.

Rows of a conversation stand by turn, a missing one first. Rows of one turn stand by role and
then text, of both the first 32 characters and then a digest of the whole, so that the keys of
that order are short however long the texts are.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER = ("turn", "__role32", "__text32", "key")


def with_order(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text, and more) with the columns of ``ORDER``; no text may be missing.

    ``key`` is 16 bytes of MD5, equal for rows that agree in role and text.
    """
    whole = F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return rows.withColumns({
        "__role32": F.substring("role", 1, 32), "__text32": F.substring("text", 1, 32), "key": F.unhex(F.md5(whole)),
    })


def plain(conversations: DataFrame, missing: str) -> list[Column]:
    """conv_id, turn, role and text of a table, ``missing`` in place of a missing role or text."""
    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(missing)).alias(name)

    return [F.col("conv_id").cast("long"), F.col("turn").cast("long"), filled("role"), filled("text")]
