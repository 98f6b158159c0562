"""Elements of stored HTML as nested intervals, as native expressions.

A page is cut once into tokens: tags, and the text between them. Every pattern steps over whole
attributes and gives nothing back, so its work is linear and its stack constant, however long a
tag is. The tags of the wanted names are marks; running sums over them give how deep each one
lies, and in the order of depth and place the mark behind a start tag is the one that ends it.
So one sort pairs all elements of a name, and a selector is a look at their classes, a search
inside an element a comparison of places.

A long page is ``shortened`` before it is cut: attributes that nothing asks for are left out of its tags,
which keeps tags of hundred thousands of characters out of every later step.

Places are numbers of tokens. Start tags that nothing closes end with the page, or with the
element that is searched. The end tags of rows, cells and list items may be left out: they end
at the next one of their kind in the same table or list.
"""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerlens.functions.html import NOISE, Selector, decode_entities, without_noise

# ``(?>x*)`` stands for ``x*+``: Java takes it in one tight loop, the other one character by character.
_VALUE = r"=(?>\s*)(?:\"(?>[^\"]*)(?:\"|\z)|'(?>[^']*)(?:'|\z))?+"
_TAG = rf"</?[A-Za-z](?:(?>[^>\"'=]+)|{_VALUE}|[\"'])*+(?:>|\z)"
_TOKEN = rf"{_TAG}|<[!?](?>[^>]*)(?:>|\z)|(?>[^<]+)|<"
#: Whether a token is no text.
_IS_TAG = r"^<[A-Za-z/!?]."

#: The attributes that ``attribute`` may be asked for.
ASKED = ("class", "href")
#: Bytes from which on a page is shortened.
_LONG = 1 << 14
_SPACE = r" \t\n\x0B\f\r"
_QUOTED = r"\"(?>[^\"<]*)\"|'(?>[^'<]*)'"
#: Attributes without a value and then one with a value: no name in them has a part like those in ``ASKED``, no
#: character outside the quotes is a quote, and what follows begins the next attribute or ends the tag.
_UNASKED = (
    rf"[{_SPACE}/](?>[^\"'=<>cChH]*)(?:[cChH](?!(?i:lass|ref))(?>[^\"'=<>cChH]*))*+(?<![{_SPACE}/])"
    rf"=(?:{_QUOTED}|(?>[^{_SPACE}>\"'=<]+)(?=[{_SPACE}>]))(?=[{_SPACE}/>])"
)
#: The next piece of a page, behind the last one: comments, scripts and styles; text, a closed declaration or a lone
#: ``<``; a tag, of whose attributes up to the last unasked one only the first space is in a group. None but the first
#: kind holds a ``<`` behind its first character, so pieces stay what they are when the first kind is removed. What is
#: no such piece, as a tag with a ``<`` in a quoted value, ends the shortening; the rest of the page stays as it is.
_PIECE = (
    rf"\G(?:{NOISE}|((?>[^<]+)|<(?=[^A-Za-z/!?<])|</(?=[^A-Za-z<])|<[!?](?>[^<>]*)>)"
    rf"|(</?[A-Za-z](?>[^{_SPACE}/>\"'=<]*))(?=[{_SPACE}/>])(?:(?<!<[A-Za-z](?=[\n\r]))(?=([{_SPACE}/]))(?:{_UNASKED})++)?+"
    rf"((?:(?>[^<>\"'=]+)|=(?>[{_SPACE}]*)(?:{_QUOTED}|(?![\"']))|[\"'])*+>))"
)

#: Elements whose end tag may be left out: what their depth is counted in, and what else ends them.
_OPEN_ENDED = {
    "li": (("ul", "ol"), ("li",)),
    "tr": (("table",), ("tr", "tbody", "thead", "tfoot")),
    "td": (("table",), ("td", "th", "tr", "tbody", "thead", "tfoot")),
}
#: Steps of a running sum that are taken together.
_STRETCH = 64


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with ``value`` computed once however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shortened(html: Column) -> Column:
    """The page, if it is long without attributes that nothing asks for.

    It has as many tokens of the same kinds and texts; its tags keep their names and the attributes ``ASKED``.
    """
    return once(html, lambda page: F.when(F.octet_length(page) < _LONG, page).otherwise(
        F.regexp_replace(F.make_valid_utf8(page), _PIECE, "$1$2$3$4")
    ))


def tokens(html: Column) -> Column:
    """The page without comments, scripts and styles, as tags and texts in order."""
    return F.regexp_extract_all(without_noise(html), F.lit(_TOKEN), F.lit(0))


def marks(tokens: Column, *names: str) -> Column:
    """(at, name, is_end, tag) of the tags that elements of ``names`` depend on."""
    wanted = {name for n in names for name in (n, *_OPEN_ENDED.get(n, ((), ()))[0], *_OPEN_ENDED.get(n, ((), ()))[1])}
    pattern = rf"^</?(?i:{'|'.join(sorted(wanted))})[\s/>]"
    # The head of a tag tells its name; the whole of it may be long.
    longest = max(map(len, wanted)) + 3
    placed = F.transform(tokens, lambda t, i: F.struct(i.alias("at"), t.alias("tag")))
    return F.transform(F.filter(placed, lambda x: F.left(x["tag"], F.lit(longest)).rlike(pattern)), lambda x: F.struct(
        x["at"].alias("at"), F.lower(F.regexp_extract(F.left(x["tag"], F.lit(longest)), r"^</?([^\s/>]++)", 1)).alias("name"),
        x["tag"].startswith("</").alias("is_end"), x["tag"].alias("tag"),
    ))


def running(values: Column, zero: Column, join: Callable[[Column, Column], Column]) -> Column:
    """For every value, all values up to it joined; ``join`` may be taken in any grouping.

    Stretches are joined by themselves, then what lies before each. An array that grows
    value by value would be copied as often as it has values.
    """
    def scan(some: Column, first: Column) -> Column:
        return F.aggregate(some, F.array(first), lambda done, x: F.array_append(done, join(F.element_at(done, -1), x)))

    def whole(stretches: Column) -> Column:
        return once(
            scan(F.transform(stretches, lambda s: F.element_at(s, -1)), zero),
            lambda before: F.flatten(F.transform(
                stretches,
                lambda s, k: F.transform(F.slice(s, F.lit(2), F.lit(_STRETCH)), lambda x: join(F.get(before, k), x)),
            )),
        )

    def cut(values: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(_STRETCH))
        return once(F.transform(starts, lambda start: scan(F.slice(values, start, F.lit(_STRETCH)), zero)), whole)

    def behind_zero(values: Column) -> Column:
        sums = scan(values, zero)
        return F.slice(sums, F.lit(2), F.greatest(F.size(values), F.lit(1)))

    # Most pages have no more than one stretch.
    return once(values, lambda v: F.when(F.size(v) <= _STRETCH, behind_zero(v)).otherwise(cut(v)))


def nested(marks: Column, *names: str) -> Column:
    """(depth, at, name, is_end, tag) of the marks that end elements of ``names``, which share one measure of depth.

    The depth is the one that a start tag makes and that an end tag leaves, and for other
    marks the one they lie in. End tags too many shift all that follows, and so no pair.
    """
    scopes = _OPEN_ENDED.get(names[0], ((names[0],), ()))[0]
    others = {b for name in names for b in _OPEN_ENDED.get(name, ((), ()))[1]} - set(scopes)
    own = F.filter(marks, lambda m: m["name"].isin(*scopes, *others))

    def deep(own: Column) -> Column:
        steps = F.transform(own, lambda m: F.when(~m["name"].isin(*scopes), 0).when(m["is_end"], -1).otherwise(1))
        return F.zip_with(own, running(steps, F.lit(0), lambda a, b: a + b), lambda m, depth: F.struct(
            (depth + F.when(m["is_end"] & m["name"].isin(*scopes), 1).otherwise(0)).alias("depth"),
            m["at"].alias("at"), m["name"].alias("name"), m["is_end"].alias("is_end"), m["tag"].alias("tag"),
        ))

    return once(own, deep)


def elements(nested: Column, name: str, n_tokens: Column) -> Column:
    """(at, end, tag) of all elements ``name`` in the order of their start: places of their tags."""
    scopes, breaks = _OPEN_ENDED.get(name, ((name,), ()))
    if breaks:  # what begins a scope lies inside an element of the outer one, and does not end it
        nested = F.filter(nested, lambda x: x["name"].isin(*breaks) | (x["name"].isin(*scopes) & x["is_end"]))
    elif name in {scope for open_ended, _ in _OPEN_ENDED.values() for scope in open_ended}:
        nested = F.filter(nested, lambda x: x["name"] == name)

    def paired(line: Column) -> Column:
        behind = F.slice(line, F.lit(2), F.greatest(F.size(line), F.lit(1)))
        return F.zip_with(line, behind, lambda a, b: F.when((a["name"] == name) & ~a["is_end"], F.struct(
            a["at"].alias("at"), F.when(a["depth"] == b["depth"], b["at"]).otherwise(n_tokens).alias("end"), a["tag"].alias("tag")
        )))

    # Without a comparator of its own, which Spark would interpret for every two elements.
    return F.sort_array(F.array_compact(once(F.sort_array(nested), paired)))


def starts(marks: Column, name: str) -> Column:
    """The elements ``name`` by their start tags alone."""
    found = F.filter(marks, lambda m: (m["name"] == name) & ~m["is_end"])
    return F.transform(found, lambda m: F.struct(m["at"].alias("at"), m["at"].alias("end"), m["tag"].alias("tag")))


def attribute_pattern(name: str) -> str:
    """Its group is the value of a start tag's first attribute of the name, with the opening quote."""
    # White space is spelled out, as classes of single characters are the fastest; and names of another
    # first letter are spared the comparison.
    space, first = _SPACE, f"{name[0].lower()}{name[0].upper()}"
    other = rf"(?:[^{space}=/>{first}](?>[^{space}=/>]*)|=(?>[^{space}=/>]*)|(?!(?i:{name})[{space}=/>])(?>[^{space}=/>]+))"
    value = rf"(?:\"(?>[^\"]*)\"?|'(?>[^']*)'?|[^{space}>\"'](?>[^{space}>]*))?+"
    return (
        rf"^<(?>[^{space}/>]+)(?:(?>[{space}/]+){other}(?:(?>[{space}]*)=(?>[{space}]*){value})?+)*+"
        rf"(?>[{space}/]+)(?i:{name})(?>[{space}]*)=(?>[{space}]*)(\"(?>[^\"]*)|'(?>[^']*)|[^{space}>\"'](?>[^{space}>]*))"
    )


def attribute(tag: Column, name: str) -> Column:
    """The value of a start tag's first attribute of the name, one of ``ASKED``; NULL where there is none."""
    if name not in ASKED:
        raise ValueError(f"shortened pages have no attribute {name}")
    return once(F.regexp_extract(tag, attribute_pattern(name), 1), lambda v: F.when(v != "", F.regexp_replace(v, "^[\"']", "")))


def matches(tag: Column, selector: Selector) -> Column:
    """Whether a start tag of the selector's name has the selector's classes."""
    names = selector.classes.split()
    if not names:
        return F.lit(True)
    given = F.filter(F.split(attribute(tag, "class"), r"\s+"), lambda c: c != "")
    found = F.array_contains(given, names[0]) if len(names) == 1 else F.array_join(given, " ") == " ".join(names)
    # The plain search spares most tags the pattern.
    return tag.contains(max(names, key=len)) & F.coalesce(found, F.lit(False))


def matching(elements: Column, selector: Selector) -> Column:
    return F.filter(elements, lambda e: matches(e["tag"], selector))


def first(elements: Column) -> Column:
    return F.get(elements, F.lit(0))


def inside(elements: Column, outer: Column) -> Column:
    """The elements that start in another one; they end with it at the latest."""
    within = F.filter(elements, lambda e: (e["at"] > outer["at"]) & (e["at"] < outer["end"]))
    return F.transform(within, lambda e: F.struct(
        e["at"].alias("at"), F.least(e["end"], outer["end"]).alias("end"), e["tag"].alias("tag")
    ))


def content(tokens: Column, element: Column) -> Column:
    """The tokens between an element's tags; NULL without an element."""
    length = F.greatest(element["end"] - element["at"] - 1, F.lit(0))
    return F.when(element.isNotNull(), F.slice(tokens, element["at"] + 2, length))


def text_of(tokens: Column) -> Column:
    """The text of tokens, with entities decoded."""
    return decode_entities(F.array_join(F.filter(tokens, lambda t: ~F.left(t, F.lit(3)).rlike(_IS_TAG)), ""))


def has_element(html: Column, selector: Selector) -> Column:
    """Whether a page has an element; a page that is missing has none."""
    opening = rf"^<(?i:{selector.tag})[\s/>]"
    found = F.exists(tokens(shortened(html)), lambda t: t.rlike(opening) & matches(t, selector))
    return F.coalesce(found, F.lit(False))


def first_links(items: Column, links: Column) -> Column:
    """Per item, in order, the ``href`` of the first link in it; NULL for an item without one."""
    def place(x: Column, is_link: bool) -> Column:
        end, tag = (F.lit(0), x["tag"]) if is_link else (x["end"], F.lit(None).cast("string"))
        return F.struct(x["at"].alias("at"), end.alias("end"), tag.alias("tag"))

    # From the last place to the first, the latest link that was seen is the next one behind.
    both = F.concat(F.transform(items, lambda x: place(x, False)), F.transform(links, lambda x: place(x, True)))
    nothing = F.struct(F.lit(-1).alias("at"), F.lit(None).cast("string").alias("tag"))

    def seen(line: Column) -> Column:
        own = F.transform(line, lambda x: F.struct(
            F.when(x["tag"].isNotNull(), x["at"]).otherwise(-1).alias("at"), x["tag"].alias("tag")
        ))
        latest = running(own, nothing, lambda a, b: F.when(b["at"] >= 0, b).otherwise(a))
        return F.zip_with(line, latest, lambda x, link: F.struct(
            x["at"].alias("at"), x["tag"].isNull().alias("is_item"),
            F.when((link["at"] >= 0) & (link["at"] < x["end"]), link["tag"]).alias("link"),
        ))

    found = F.filter(once(F.sort_array(both, asc=False), seen), lambda x: x["is_item"])
    return F.transform(F.reverse(found), lambda x: decode_entities(attribute(x["link"], "href")))
