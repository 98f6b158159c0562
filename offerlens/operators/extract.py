"""Stored listing and offer pages to links and raw offers."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.functions import elements as E
from offerlens.functions.html import Selector
from offerlens.functions.parse import trim
from offerlens.schema import BRAND, CLOCK, MODEL, PRICE, RAM, SENTINEL

# The layout of the pages.
LINK_HOST = "https://amazon.com"
GRID = Selector("div", "s-main-slot s-result-list s-search-results sg-row")
GRID_ITEM = Selector(
    "div",
    "sg-col-20-of-24 s-result-item s-asin sg-col-0-of-12 sg-col-16-of-20 sg-col s-widget-spacing-small sg-col-12-of-16",
)
PRICE_TEXT = Selector("span", "a-price-whole")
SPEC_TABLE = Selector("table", "a-normal a-spacing-micro")
SPEC_ROWS = {
    MODEL: (Selector("tr", "a-spacing-small po-graphics_coprocessor"), "Graphics Coprocessor"),
    BRAND: (Selector("tr", "a-spacing-small po-brand"), "Brand"),
    RAM: (Selector("tr", "a-spacing-small po-graphics_ram.size"), "Graphics Ram Size"),
    CLOCK: (Selector("tr", "a-spacing-small po-gpu_clock_speed"), "GPU Clock Speed"),
}


def _cut(pages: DataFrame, keys: list[str], html: Column, *names: str) -> DataFrame:
    """``keys``, the ``tokens`` of every page, their number, and the ``marks`` of elements ``names``."""
    cut = pages.select(*keys, E.tokens(E.shortened(html)).alias("tokens"))
    return cut.select("*", E.marks(F.col("tokens"), *names).alias("marks"), F.size("tokens").alias("n"))


def grid_links(
    pages: DataFrame, keys: list[str], html: Column, grid: Selector = GRID, item: Selector = GRID_ITEM, host: str = LINK_HOST
) -> DataFrame:
    """``keys`` and in ``links`` the address of every offer of the first grid, in order.

    An offer without a link gives NULL, and so do the ``links`` of a page without a grid.
    """
    marks, n = F.col("marks"), F.col("n")
    cut = _cut(pages, keys, html, grid.tag, item.tag, "a")
    levels = cut.select(
        *keys, "n", E.nested(marks, grid.tag).alias("of_grids"), E.nested(marks, item.tag).alias("of_items"), E.starts(marks, "a").alias("a")
    )
    gridded = levels.select("*", E.first(E.matching(E.elements(F.col("of_grids"), grid.tag, n), grid)).alias("grid"))
    items = E.inside(E.matching(E.elements(F.col("of_items"), item.tag, n), item), F.col("grid"))
    listed = gridded.select(*keys, "grid", items.alias("items"), E.inside(F.col("a"), F.col("grid")).alias("anchors"))
    urls = F.transform(E.first_links(F.col("items"), F.col("anchors")), lambda href: F.concat(F.lit(host), href))
    return listed.select(*keys, F.when(F.col("grid").isNotNull(), urls).alias("links"))


def offer_links(
    pages: DataFrame, keys: list[str], grid: Selector = GRID, item: Selector = GRID_ITEM, host: str = LINK_HOST
) -> DataFrame:
    """The first link of every offer in the first grid: ``keys``, ``pos`` and ``url``."""
    linked = grid_links(pages, keys, F.col("html"), grid, item, host)
    # The outer form has no condition on the links that would read the page a second time.
    return linked.select(*keys, F.posexplode_outer("links").alias("pos", "url")).where(F.col("url").isNotNull())


def offer_attributes(offers: DataFrame, keys: list[str]) -> DataFrame:
    """The five attribute texts of every offer page that has a specification table."""
    return read_offer_pages(offers, keys).where("has_specs").drop("has_specs", "missing")


def read_offer_pages(offers: DataFrame, keys: list[str]) -> DataFrame:
    """The attribute texts in place of the page, whether it has a specification table, and what it lacks.

    Reading before any join keeps the pages themselves out of every shuffle.
    """
    tokens, marks, n, specs, of_tables = (F.col(name) for name in ("tokens", "marks", "n", "specs", "of_tables"))
    cut = _cut(offers, keys, F.col("html"), SPEC_TABLE.tag, PRICE_TEXT.tag, "tr", "td").select(
        *keys, "tokens", "n", E.nested(marks, "tr", "td").alias("of_tables"), E.nested(marks, PRICE_TEXT.tag).alias("of_texts")
    )
    # A table is exploded, and in the outer form, so that no filter is pushed below and reads the page again.
    table = F.array_compact(F.array(E.first(E.matching(E.elements(of_tables, SPEC_TABLE.tag, n), SPEC_TABLE))))
    with_table = cut.select(*keys, "tokens", "n", "of_tables", "of_texts", F.explode_outer(table).alias("specs"))
    price = E.first(E.matching(E.elements(F.col("of_texts"), PRICE_TEXT.tag, n), PRICE_TEXT))
    lists = with_table.select(
        *keys, "tokens", "specs", price.alias("price"),
        E.inside(E.elements(of_tables, "tr", n), specs).alias("rows"), E.inside(E.elements(of_tables, "td", n), specs).alias("cells"),
    )

    def two_cells(row: Selector) -> Column:
        inside = E.once(E.first(E.matching(F.col("rows"), row)), lambda r: E.inside(F.col("cells"), r))
        return E.once(inside, lambda own: F.array(F.get(own, F.lit(0)), F.get(own, F.lit(1))))

    found = F.flatten(F.array(*[two_cells(row) for row, _ in SPEC_ROWS.values()], F.array(F.col("price"))))
    # All texts go through one expression, which keeps the plan small.
    texts = F.transform(found, lambda element: E.text_of(E.content(tokens, element)))
    read = lists.select(*keys, specs.isNotNull().alias("has_specs"), texts.alias("texts"))

    def text(at: int) -> Column:
        return F.get("texts", F.lit(at))

    values = {PRICE: text(2 * len(SPEC_ROWS))}
    for at, (name, (_, label)) in enumerate(SPEC_ROWS.items()):
        values[name] = F.when(trim(text(2 * at)) == label, text(2 * at + 1))
    named = [values[name].alias(name) for name in (MODEL, PRICE, BRAND, RAM, CLOCK)]
    told = read.select(*keys, "has_specs", *named)
    lacking = F.array_compact(F.array(*[F.when(F.col(name).isNull(), F.lit(name)) for name in values]))
    filled = [F.coalesce(name, F.lit(SENTINEL)).alias(name) for name in (MODEL, PRICE, BRAND, RAM, CLOCK)]
    return told.select(*keys, "has_specs", lacking.alias("missing"), *filled)
