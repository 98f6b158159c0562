"""Selectors, noise and entities of stored HTML, as native expressions; ``elements`` finds elements."""

from collections.abc import Callable
from dataclasses import dataclass
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Comments, scripts and styles; what nothing closes reaches to the end of the page.
NOISE = r"(?is:<(?:!--.*?(?:-->|\z)|script\b.*?(?:</script\s*+>|\z)|style\b.*?(?:</style\s*+>|\z)))"
_ENTITY = r"^&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"


@dataclass(frozen=True)
class Selector:
    """A tag, optionally with a class.

    One class name matches any element that carries it; several names must be the
    whole class attribute, in that order.
    """

    tag: str
    classes: str = ""


def without_noise(html: Column) -> Column:
    """The page without comments, scripts and styles; bytes that are no UTF-8 are replaced."""
    return F.regexp_replace(F.make_valid_utf8(html), NOISE, "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with ``value`` computed once however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def decode_entities(text: Column) -> Column:
    """Numeric and HTML 4 named entities, each decoded once."""

    def decoded(text: Column) -> Column:
        pieces = F.transform(F.split(text, "(?=&)"), _decode_head)
        return F.when(text.contains("&"), F.array_join(pieces, "")).otherwise(text)

    return _let(text, decoded)


def _decode_head(piece: Column) -> Column:
    """Decodes the entity a piece starts with; any other piece is left as it is."""

    def number(digits: Column, base: int) -> Column:
        # No code point has more than seven digits.
        return F.when(F.length(digits) > 7, -1).when(digits == "", 0).otherwise(F.conv(digits, base, 10).cast("int"))

    def code_point(name: Column) -> Column:
        return (
            F.when(name == "", None)
            .when(name.rlike("^#[xX]"), number(F.regexp_extract(name, "^#[xX]0*(.*)$", 1), 16))
            .when(name.startswith("#"), number(F.regexp_extract(name, "^#0*(.*)$", 1), 10))
            .otherwise(F.try_element_at(_named_entities(), name))
        )

    def character(code: Column) -> Column:
        valid = F.when(code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF), code).otherwise(0xFFFD)
        return F.decode(F.unhex(F.lpad(F.hex(valid), 8, "0")), "UTF-32")

    def replaced(name: Column) -> Column:
        rest = F.substr(piece, F.length(name) + 3)
        return _let(code_point(name), lambda code: F.when(code.isNull(), piece).otherwise(F.concat(character(code), rest)))

    return _let(F.regexp_extract(piece, _ENTITY, 1), replaced)


def _named_entities() -> Column:
    names = {"apos": 39, **name2codepoint}
    return F.str_to_map(F.lit(";".join(f"{k}:{v}" for k, v in names.items())), F.lit(";"), F.lit(":")).cast(
        "map<string,int>"
    )
