import random
from html.parser import HTMLParser
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from offerlens.functions import elements as E
from offerlens.functions import html as H
from offerlens.operators import extract
from offerlens.operators.extract import GRID, GRID_ITEM, LINK_HOST, offer_attributes, offer_links, read_offer_pages
from offerlens.schema import BRAND, CLOCK, MODEL, PRICE, RAM
from workload import fixtures



def one(spark, html, function, *args):
    frame = spark.createDataFrame([(html,)], "html string").coalesce(1)
    return frame.select(function(F.col("html"), *args).alias("v")).first()["v"]


def intervals(spark, html, *names):
    """(at, end, tag) of the elements ``names[0]``, and the tokens; ``names`` share a measure of depth."""
    frame = spark.createDataFrame([(html,)], "html string").coalesce(1).select(E.tokens(F.col("html")).alias("tokens"))
    frame = frame.select("tokens", E.nested(E.marks(F.col("tokens"), *names), *names).alias("nested"))
    row = frame.select("tokens", E.elements(F.col("nested"), names[0], F.size("tokens")).alias("found")).first()
    return row["found"], row["tokens"]


def inner(spark, html, selector):
    """What lies inside the first matching element."""
    frame = spark.createDataFrame([(html,)], "html string").coalesce(1).select(E.tokens(F.col("html")).alias("tokens"))
    found = E.elements(E.nested(E.marks(F.col("tokens"), selector.tag), selector.tag), selector.tag, F.size("tokens"))
    frame = frame.select("tokens", E.first(E.matching(found, selector)).alias("element"))
    return frame.select(F.array_join(E.content(F.col("tokens"), F.col("element")), "").alias("v")).first()["v"]


def grid_page(items):
    return f'<div class="{GRID.classes}">{items}</div>'


def item(inner, tag="div"):
    return f'<{tag} class="{GRID_ITEM.classes}">{inner}</{tag}>'


def links(spark, html):
    frame = spark.createDataFrame([(1, html)], "k int, html string")
    return [(r["pos"], r["url"]) for r in offer_links(frame, ["k"]).orderBy("pos").collect()]


def test_one_class_matches_any_member(spark):
    selector = H.Selector("span", "a-price-whole")
    for html in [
        '<span class="a-price-whole">1</span>',
        "<SPAN id=x class='b a-price-whole c'>1</span>",
        "<span class=a-price-whole>1</span>",
        '<span class="a-price-whole-x">0</span><span data-a="b" class="\ta-price-whole">1</span>',
    ]:
        assert inner(spark, html, selector) == "1"
    assert inner(spark, '<span class="xa-price-whole">1</span>', selector) is None


def test_several_classes_must_be_the_whole_attribute(spark):
    selector = H.Selector("table", "a-normal a-spacing-micro")
    assert inner(spark, '<table class=" a-normal  a-spacing-micro ">x</table>', selector) == "x"
    for classes in ["a-spacing-micro a-normal", "a-normal a-spacing-micro b", "a-normal"]:
        assert inner(spark, f'<table class="{classes}">x</table>', selector) is None


def test_longer_tag_and_attribute_names_do_not_match(spark):
    selector = H.Selector("tr", "x")
    html = "<track class=x>0</track><tr data-class=x><td>1</tr><tr\nid=a\tclass = x><td>2</tr>"
    assert inner(spark, html, selector) == "<td>2"


def test_nested_elements_are_balanced(spark):
    div = H.Selector("div", "x")
    assert inner(spark, "<div class=x>a<div>b<div>c</div></div>d</div>e", div) == "a<div>b<div>c</div></div>d"
    assert inner(spark, "<div class=x>a<div>b</div>", div) == "a<div>b</div>"
    assert inner(spark, "<div class=x></div>", div) == ""
    many = "<div>y</div>" * 500
    assert inner(spark, f"<div class=x>{many}</div><p>", div) == many
    deep = "<div>" * 200 + "z" + "</div>" * 200
    assert inner(spark, f"<div class=x>{deep}</div><p>", div) == deep


def test_astral_characters_do_not_shift_cuts(spark):
    html = "😀😀<div class=x>😀a<div>😀</div>😀</div>tail"
    assert inner(spark, html, H.Selector("div", "x")) == "😀a<div>😀</div>😀"


def test_entities_are_decoded_once(spark):
    text = "a&amp;lt; &#174;&#x20AC;&eacute;&apos;&nbsp;&nope; & &#0;&#x110000;&AMP;"
    assert one(spark, text, H.decode_entities) == "a&lt; ®€é'\xa0&nope; & ��&AMP;"
    assert one(spark, "<b>x</b> &amp; <i>y</i>", lambda html: E.text_of(E.tokens(html))) == "x & y"


def test_links_of_a_grid(spark):
    page = grid_page(
        item('<div><a href="/a?x=1&amp;y=2">t</a><a href="/b">u</a></div>')
        + item("<div>sold out</div>")
        + '<div class="other"><a href="/ad"></a></div>'
        + item("<a name=x>no address</a><a href='/late'></a>")
        + item("<p><A title=t HREF = /c >c</A></p>")
    ) + item('<a href="/outside"></a>')
    # a link without an address is taken as missing, like an item without a link
    assert links(spark, page) == [(0, f"{LINK_HOST}/a?x=1&y=2"), (3, f"{LINK_HOST}/c")]


def test_links_only_of_the_first_grid_and_not_of_comments(spark):
    commented = f"<!-- {grid_page(item('<a href=/no></a>'))} -->"
    script = f"<script>var t = '{grid_page(item('<a href=/no></a>'))}'</script>"
    page = commented + script + grid_page(item("<a href=/yes></a>")) + grid_page(item("<a href=/second></a>"))
    assert links(spark, page) == [(0, f"{LINK_HOST}/yes")]
    assert links(spark, "<p>no grid</p>") == []


class _FirstLinks(HTMLParser):
    """The first link of every list item inside nav, read by the standard library."""

    def __init__(self):
        super().__init__()
        self.nav = self.waiting = False
        self.found = []

    def handle_starttag(self, tag, attrs):
        if tag == "nav":
            self.nav = True
        if tag == "li" and self.nav:
            self.waiting = True
        if tag == "a" and self.waiting:
            self.waiting = False
            self.found.append(dict(attrs).get("href"))

    def handle_endtag(self, tag):
        if tag == "nav":
            self.nav = False
        if tag == "li":
            self.waiting = False


def test_links_of_stored_pages_agree_with_a_parser(spark):
    pages = fixtures.table(spark, "/root/testdata/sf0.01", "pages")
    found = {}
    for row in offer_links(pages, ["page_id"], fixtures.NAV, fixtures.NAV_ITEM, "").orderBy("page_id", "pos").collect():
        found.setdefault(row["page_id"], []).append(row["url"])
    for row in pages.collect():
        parser = _FirstLinks()
        parser.feed(row["html"])
        assert found.get(row["page_id"], []) == parser.found


def spec_page(rows, price='<span class="a-price-whole">1,299<span>.</span></span>', table_class="a-normal a-spacing-micro"):
    return f'<body>{price}<table class="{table_class}">{rows}</table></body>'


def spec_row(name, label, value):
    return f'<tr class="a-spacing-small po-{name}"><td><span>{label} </span></td><td>{value}</td></tr>'


def attributes(spark, html):
    frame = spark.createDataFrame([(1, html)], "k int, html string")
    row = offer_attributes(frame, ["k"]).first()
    return row and tuple(row[c] for c in (MODEL, PRICE, BRAND, RAM, CLOCK))


def test_offer_attributes(spark):
    rows = (
        spec_row("graphics_coprocessor", "Graphics Coprocessor", " <b>RTX</b> 3060 ")
        + spec_row("brand", "Brand", "A &amp; B")
        + spec_row("graphics_ram.size", "Graphics Ram Size", "8 GB")
        + spec_row("gpu_clock_speed", "GPU Clock Speed", "1.8 GHz")
    )
    assert attributes(spark, spec_page(rows)) == (" RTX 3060 ", "1,299.", "A & B", "8 GB", "1.8 GHz")


def test_missing_attributes_are_unknown(spark):
    wrong = spec_row("brand", "Maker", "A") + spec_row("graphics_ram.size", "Graphics Ram Size", "")
    assert attributes(spark, spec_page(wrong, price="")) == ("unknown", "unknown", "unknown", "", "unknown")
    short = '<tr class="a-spacing-small po-brand"><td>Brand</td></tr><tr class="a-spacing-small po-gpu_clock_speed"></tr>'
    assert attributes(spark, spec_page(short)) == ("unknown", "1,299.", "unknown", "unknown", "unknown")


def test_offer_without_specification_table_is_dropped(spark):
    assert attributes(spark, spec_page("", table_class="a-normal")) is None
    assert attributes(spark, spec_page("")) == ("unknown", "1,299.", "unknown", "unknown", "unknown")


def test_left_out_end_tags(spark):
    rows = '<tr class="a-spacing-small po-brand"><td>Brand<td>A<tr class="a-spacing-small po-gpu_clock_speed"><td>GPU Clock Speed<td>7'
    assert attributes(spark, spec_page(rows)) == ("unknown", "1,299.", "A", "unknown", "7")


def test_missing_attributes_are_named(spark):
    wrong = spec_row("brand", "Maker", "A") + spec_row("graphics_ram.size", "Graphics Ram Size", "")
    frame = spark.createDataFrame([(1, spec_page(wrong, price="")), (2, "<p>none</p>"), (3, None)], "k int, html string")
    found = {r["k"]: (r["has_specs"], r["missing"]) for r in read_offer_pages(frame, ["k"]).collect()}
    assert found[1] == (True, [PRICE, MODEL, BRAND, CLOCK])
    assert not found[2][0] and not found[3][0]


class _Intervals(HTMLParser):
    """Start and end of every element of a name by line position, kept on a stack of open ones."""

    def __init__(self, name):
        super().__init__()
        self.name, self.open, self.found, self.count = name, [], [], 0

    def handle_starttag(self, tag, attrs):
        if tag == self.name:
            self.open.append(len(self.found))
            self.found.append([self.count, None])
            self.count += 1

    def handle_endtag(self, tag):
        if tag == self.name and self.open:
            self.found[self.open.pop()][1] = self.count
            self.count += 1


ODD_PAGES = {
    "nested": "<div>" * 20_000 + "x" + "</div>" * 20_000,
    "unclosed": "<div>a<div>b</div><div>c" * 3000,
    "stray": "</div>x</div><div>a</div></div></div><div>b<div>c</div>" * 1000,
    "attributes": "<div " + "".join(f"a{i}='>{i}' " for i in range(50_000)) + "><div>x</div></div>",
    "long value": f"<div title=\"{'<div>' * 200_000}\"><div>x</div></div>",
    "bare value": f"<div title={'x' * 1_000_000}><div>x</div></div><div>",
    "spaces": f"<div{' ' * 1_000_000}><div>x</div></div>",
}


@pytest.mark.parametrize("kind", ODD_PAGES)
def test_intervals_of_odd_pages_agree_with_a_parser(spark, kind):
    html = ODD_PAGES[kind]
    parser = _Intervals("div")
    parser.feed(html)
    found, tokens = intervals(spark, html, "div")
    assert "".join(tokens) == html
    # Places of the parser count paired tags only; those of the tokens are numbered anew to compare.
    places = sorted({x["at"] for x in found} | {x["end"] for x in found if x["end"] < len(tokens)})
    number = {place: i for i, place in enumerate(places)}
    assert [[number[x["at"]], number.get(x["end"])] for x in found] == parser.found


SELECTORS = [H.Selector("div", "x"), H.Selector("div", "x y"), H.Selector("span", "x"), H.Selector("table", "x y"), GRID, GRID_ITEM]
LONG = {
    "attributes": "".join(f" a{i}=b{i}" for i in range(100_000)),
    "flags": " hidden" * 150_000,
    "double": ' title="' + "class=q > " * 100_000 + '"',
    "single": " title='" + "<div class=q> " * 80_000 + "'",
    "bare": " title=" + "x" * 1_000_000,
    "spaces": " " * 1_000_000,
    "handler": " onclick=" + "f(1)&&" * 200_000,
}


@pytest.mark.parametrize("kind", LONG)
def test_tags_of_a_million_characters(spark, kind):
    for selector in SELECTORS:
        tag = selector.tag
        html = f"<{tag}{LONG[kind]}>no</{tag}><{tag}{LONG[kind]} class='{selector.classes}'{LONG[kind]}>yes</{tag}>"
        assert inner(spark, html, selector) == "yes"
        assert one(spark, html, E.has_element, selector)
        assert not one(spark, f"<{tag}{LONG[kind]}>no</{tag}>", E.has_element, selector)


def test_what_nothing_closes_reaches_to_the_end(spark):
    div = H.Selector("div", "x")
    for noise in ("<!--", "<script>", "<style>", "<SCRIPT a='", "<div title='", "<"):
        assert inner(spark, f"<div class=x>a</div>{noise * 20_000}<div class=x>b</div>", div) == "a"
    assert inner(spark, "<!doctype html><?x y?><div class=x>a<!b>c</div>", div) == "a<!b>c"
    assert one(spark, "a<!b>c<p>d</p>e < f", lambda html: E.text_of(E.tokens(html))) == "acde < f"


def test_cells_of_nested_tables(spark):
    html = "<table><tr><td>1<table><tr><td>2<td>3</table>4<td>5<tr><td>6</table>7"
    found, tokens = intervals(spark, html, "td", "tr")
    assert ["".join(tokens[x["at"] + 1 : x["end"]]) for x in found] == ["1<table><tr><td>2<td>3</table>4", "2", "3", "5", "6"]
    found, tokens = intervals(spark, html, "tr", "td")
    assert ["".join(tokens[x["at"] + 1 : x["end"]]) for x in found] == [
        "<td>1<table><tr><td>2<td>3</table>4<td>5", "<td>2<td>3", "<td>6"
    ]


def test_bytes_that_are_no_text(spark):
    frame = spark.createDataFrame([(bytearray(b"<div class=x>a\xff\xfeb</div>"),)], "raw binary").select(F.col("raw").cast("string").alias("html"))
    assert frame.select(E.has_element(F.col("html"), H.Selector("div", "x")).alias("v")).first()["v"]


def test_running_sums(spark):
    for n in (0, 1, 63, 64, 65, 1000):
        values = [(i * 7) % 5 - 2 for i in range(n)]
        frame = spark.createDataFrame([(values,)], "v array<int>")
        sums = frame.select(E.running(F.col("v"), F.lit(0), lambda a, b: a + b).alias("s")).first()["s"]
        assert sums == list(accumulate(values))


_PARTS = [
    "<", ">", "<", ">", "</", "/", '"', "'", "=", " ", "\n", "a", "x", "<div", "<a", "<td", "</td>", "<table", "class", "CLASS", "href",
    ' class="x y"', " class='p'", " class=z", ' href="/q"', ' data-a="b>c"', " t='u'", " hidden", ' data-class="k"', " hx=1", "!--",
    "<!--", "-->", "<script", "</script>", "<style>", "<!", "<?", "é", "< ", '="', " = ", "<!DOCTYPE", " q=a/b", "/>", '">', "'>",
]


def test_shortened_pages_have_the_same_tokens(spark, monkeypatch):
    draw = random.Random(5)
    pages = ["".join(draw.choices(_PARTS, k=draw.randint(1, 20))) for _ in range(20_000)]
    frame = spark.createDataFrame([(page,) for page in pages], "html string").repartition(4)

    def told(html):
        def kind(token):
            given = F.concat_ws("|", F.regexp_extract(token, r"^</?[^\s/>]+", 0), *[E.attribute(token, name) for name in E.ASKED])
            return F.when(F.left(token, F.lit(3)).rlike(E._IS_TAG), given).otherwise(token)

        return F.transform(E.tokens(html), kind)

    monkeypatch.setattr(E, "_LONG", 0)
    whole, short = F.col("html"), E.shortened(F.col("html"))
    seen = frame.select("html", told(whole).alias("whole"), told(short).alias("short"), (F.length(short) < F.length(whole)).alias("cut"))
    assert seen.where("not whole <=> short").collect() == []
    assert seen.where("cut").count() > 2_000


def test_long_tags_are_cut_short(spark):
    attributes = " data-a='b>c' hidden" * 2000 + " title=" + "x" * 30_000
    html = f"<!-- <i> --><table{attributes} class='y'><td{attributes}>7 <!-- > --></td{attributes}></table><a{attributes} href='/z'>"
    cut = one(spark, html, lambda html: E.tokens(E.shortened(html)))
    assert cut == ["<table  class='y'>", "<td >", "7 ", "</td >", "</table>", "<a  href='/z'>"]
    # The page stays as it is from where a tag holds a ``<``.
    odd = "<a title='<b>' id='1'>x</a>"
    assert "".join(one(spark, f"<p{attributes}>{odd}", lambda html: E.tokens(E.shortened(html)))) == f"<p >{odd}"


def test_only_attributes_that_are_kept_can_be_asked_for():
    with pytest.raises(ValueError, match="title"):
        E.attribute(F.lit("<a title=x>"), "title")


def test_long_tags_end_before_a_page_is_cut(spark):
    html = spec_page(spec_row("brand", "Brand", "A")).replace("<table", "<table" + " data-a='b>c' hidden" * 20_000)
    frame = spark.createDataFrame([(1, html)], "k int, html string")
    cut = extract._cut(frame, ["k"], F.col("html"), "table", "tr").select(F.length(F.to_json("marks")), F.length(F.to_json("tokens")))
    assert max(cut.first()) < 2_000
    assert attributes(spark, html) == ("unknown", "1,299.", "A", "unknown", "unknown")
