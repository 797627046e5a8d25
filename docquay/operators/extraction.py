"""Records from result pages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquay.functions import markup
from docquay.functions.urls import resolve_url


@dataclass(frozen=True)
class Field:
    """Where a field sits: first ``tag`` of that class, its attribute or own text."""

    tag: str
    css_class: str | None = None
    attribute: str | None = None

    def of(self, card: Column) -> Column:
        if self.attribute:
            return markup.attribute_of(card, self.tag, self.css_class, self.attribute)
        return markup.own_text_of(card, self.tag, self.css_class)


@dataclass(frozen=True)
class CardLayout:
    """Markup of a result page; the defaults are fixed values."""

    item: Field = Field("li", "each-item")
    identifier: Field = Field("h2", "title", "title")
    title: Field = Field("h2", "title")
    published_date: Field = Field("span", "date")
    description: Field = Field("p", "description", "title")
    ref_no: Field = Field("span", "refNO")
    link: Field = Field("a", "btn-primary", "href")
    count_box: Field = Field("div", "searchhead")
    count_pattern: str = r"of\s+([\d,]+)\s+results"


DEFAULT_LAYOUT = CardLayout()


def title_or_identifier(title: Column, identifier: Column) -> Column:
    return F.coalesce(F.nullif(markup.strip_space(title), F.lit("")), identifier)


def cards_of(html: Column, layout: CardLayout = DEFAULT_LAYOUT) -> Column:
    """Array with the markup of every card on a result page, those inside other cards included."""
    page = markup.strip_raw_blocks(html, "<x>")
    return markup.select_elements(page, layout.item.tag, layout.item.css_class, nested=True)


def explode_cards(
    results: DataFrame, html: str = "html", layout: CardLayout = DEFAULT_LAYOUT
) -> DataFrame:
    """One row per card with its ``position``; the other columns are the context."""
    context = [c for c in results.columns if c != html]
    return results.select(
        *context, F.posexplode(cards_of(F.col(html), layout)).alias("position", "card")
    )


def card_fields(cards: DataFrame, layout: CardLayout = DEFAULT_LAYOUT) -> DataFrame:
    """Fields of each card: trimmed, empty text when missing; the link untrimmed."""
    card = F.col("card")
    trimmed = {
        name: markup.strip_space(getattr(layout, name).of(card))
        for name in ("identifier", "title", "published_date", "description", "ref_no")
    }
    df = cards.withColumns({**trimmed, "link": layout.link.of(card)}).drop("card")
    return df.withColumn("title", title_or_identifier(F.col("title"), F.col("identifier")))


def missing_field() -> Column:
    """Reason why a card is dropped; null when it is kept."""
    return F.when(F.col("identifier") == "", "identifier missing").when(
        F.col("link") == "", "link missing"
    )


def base_url(html: Column, page_url: Column) -> Column:
    """Address that the links of a page are relative to: its ``base`` tag, else its own."""
    named = markup.attribute_of(markup.strip_raw_blocks(html), "base", None, "href")
    return F.when(html.rlike(r"(?i)<base\s"), resolve_url(page_url, named)).otherwise(page_url)


def with_document_url(cards: DataFrame, page_url: str = "page_url") -> DataFrame:
    return cards.withColumn("doc_url", resolve_url(F.col(page_url), F.col("link")))


def result_count(html: Column, layout: CardLayout = DEFAULT_LAYOUT) -> Column:
    """Total number of results named on the page, in one of its heads or else anywhere."""
    page = markup.strip_raw_blocks(html, "<x>")
    heads = markup.select_elements(page, layout.count_box.tag, layout.count_box.css_class)

    def number(text: Column) -> Column:
        return F.nullif(F.regexp_extract(text, layout.count_pattern, 1), F.lit(""))

    named = F.try_element_at(F.array_compact(F.transform(heads, number)), F.lit(1))
    digits = F.coalesce(named, number(html))
    return F.replace(digits, F.lit(","), F.lit("")).try_cast("bigint")


def page_count(total: Column, page_size: int = 10) -> Column:
    size = F.lit(page_size).cast("bigint")
    return F.call_function("div", total + size - 1, size)
