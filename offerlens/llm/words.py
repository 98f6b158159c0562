"""Words of a text with native functions only.

The operators use two definitions: a run of anything but ASCII white space, and, for
benchmarks, a run of lower-case ASCII letters, digits and non-ASCII characters.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A word, as Java, Python and RE2 patterns read it alike.
WORD = r"[^\x20\x09-\x0D]+"
SPACE_RUN = r"[\x20\x09-\x0D]+"
SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_of(column: Column) -> Column:
    """The text; a missing one counts as empty."""
    return F.coalesce(column.cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other letters as they are."""
    return F.translate(text, _UPPER, _UPPER.lower())


def split_words(text: Column, separators: str = SPACE_RUN) -> Column:
    """All words of ``text`` in order, as an array; the split should be a column of its own."""
    return without_empty_ends(F.split(text, separators))


def without_empty_ends(pieces: Column) -> Column:
    """A split at runs of separators without its empty pieces: only the first and last can be."""
    first = F.when(F.element_at(pieces, 1) == "", 1).otherwise(0)
    last = F.when(F.element_at(pieces, -1) == "", 1).otherwise(0)
    return F.slice(pieces, first + 1, F.greatest(F.size(pieces) - first - last, F.lit(0)))


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def without_chars(text: Column, chars: tuple[str, ...] | str) -> Column:
    """``text`` without any of ``chars``; plain replacements are searched byte by byte."""
    for char in chars:
        text = F.replace(text, F.lit(char), F.lit(""))
    return text


def window_hashes(hashes: Column, width: int) -> Column:
    """A 64-bit hash for every ``width`` consecutive elements; none if there are fewer.

    ``hashes`` must be a plain column: inside the lambda any expression would be
    evaluated again for every position.
    """
    last = F.size(hashes) - width
    positions = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(positions, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(width)]))


def computed_once(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """``df`` with the columns ``names`` evaluated below a generator of one row.

    A filter on a computed column is otherwise pushed down with its whole expression put
    in place, lambdas inside lambdas included, and evaluated again for every element.
    """
    rest = [c for c in df.columns if c not in names]
    return df.select(*rest, F.inline(F.array(F.struct(*names))))


def join_same(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Join on equal ``names``, a missing value being equal to another; the names stay once."""
    other = right.withColumnsRenamed({name: f"__right_{name}" for name in names})
    condition = F.lit(True)
    for name in names:
        condition &= F.col(name).eqNullSafe(F.col(f"__right_{name}"))
    return left.join(other, condition, how).drop(*[f"__right_{name}" for name in names])


def row_key(text: str = "text") -> Column:
    """Names a row by its id and text; rows that agree in both share a key."""
    return F.xxhash64(F.col("doc_id"), text_of(F.col(text)))


def attach(docs: DataFrame, made: DataFrame, names: list[str]) -> DataFrame:
    """``docs`` (with ``__key``) plus the columns ``names`` of ``made`` (``__key``, one row per document).

    Documents with one key get the rows of that key in order, one each. Both sides are
    shuffled once, by the key.
    """
    same = made.groupBy("__key").agg(F.sort_array(F.collect_list(F.struct(*names))).alias("__made"))
    numbered = docs.drop(*names).withColumn("__no", F.row_number().over(Window.partitionBy("__key").orderBy(F.lit(1))))
    rest = [c for c in docs.columns if c not in names and c != "__key"]
    return numbered.join(same, "__key").select(
        *rest, *[F.get("__made", F.col("__no") - 1)[name].alias(name) for name in names]
    )
