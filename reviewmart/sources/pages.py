"""Review texts from a table of web pages, extracted row by row inside the JVM."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmart.functions.text import strip

_SKIPPED = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
_REVIEW_SPAN = r"""(?i)<span\b[^>]*\sdata-hook\s*=\s*(?:"review-body"|'review-body'|review-body(?=[\s>]))[^>]*>"""
_SPAN_EDGE = r"(?i)(?=<span\b)|(?=</span\b)"
_PARAGRAPH = r"(?i)<p(?:\s[^>]*)?>"
_PARAGRAPH_END = r"(?is)</(?:p|article|div|body)\b.*"
_TAG = r"<[^>]*>"
_MIN_PARAGRAPH = 40


def _named_entities() -> Column:
    table = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


def unescape(text: Column) -> Column:
    """Replace named and numeric character references, each once, left to right."""
    names = _named_entities()

    def decode(piece: Column) -> Column:
        name = F.regexp_extract(piece, "^([A-Za-z][A-Za-z0-9]*);", 1)
        decimal = F.regexp_extract(piece, "^#([0-9]{1,7});", 1)
        hexa = F.regexp_extract(piece, "^#[xX]([0-9A-Fa-f]{1,6});", 1)
        code = F.when(decimal != "", decimal.try_cast("int")).when(
            hexa != "", F.conv(hexa, 16, 10).try_cast("int")
        )
        valid = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code < 0x110000))
        char = F.when(
            valid, F.decode(F.unhex(F.lpad(F.hex(code.cast("long")), 8, "0")), "UTF-32")
        ).when(name != "", F.try_element_at(names, name))
        return F.coalesce(
            F.concat(char, F.regexp_replace(piece, "^[^;]*;", "")), F.concat(F.lit("&"), piece)
        )

    pieces = F.split(text, "&")
    decoded = F.concat(
        F.element_at(pieces, 1),
        F.array_join(F.transform(F.slice(pieces, 2, F.size(pieces)), decode), ""),
    )
    return F.when(text.contains("&"), decoded).otherwise(text)


def _plain(fragment: Column) -> Column:
    return unescape(F.regexp_replace(fragment, _TAG, ""))


def _after_first(parts: Column) -> Column:
    return F.slice(parts, 2, F.size(parts))


def _review_spans(html: Column) -> Column:
    """Text of every review span, nested spans included."""

    def body(fragment: Column) -> Column:
        # Cut before every span edge and keep pieces until the opening span is closed.
        state = F.struct(F.lit(1).alias("depth"), F.lit("").alias("text"))

        def step(acc: Column, piece: Column) -> Column:
            lowered = F.lower(F.substring(piece, 1, 6))
            depth = acc["depth"] + F.when(lowered.startswith("</span"), -1).when(
                lowered.startswith("<span"), 1
            ).otherwise(0)
            return F.when(acc["depth"] <= 0, acc).otherwise(
                F.struct(
                    depth.alias("depth"),
                    F.when(depth <= 0, acc["text"])
                    .otherwise(F.concat(acc["text"], piece))
                    .alias("text"),
                )
            )

        return F.aggregate(F.split(fragment, _SPAN_EDGE), state, step, lambda acc: acc["text"])

    return F.transform(_after_first(F.split(html, _REVIEW_SPAN)), lambda f: _plain(body(f)))


def _paragraphs(html: Column) -> Column:
    """Text of every paragraph above the length floor, measured before stripping."""
    texts = F.transform(
        _after_first(F.split(html, _PARAGRAPH)),
        lambda f: _plain(F.regexp_replace(f, _PARAGRAPH_END, "")),
    )
    return F.filter(texts, lambda t: F.length(t) > _MIN_PARAGRAPH)


def extract_page_reviews(pages: DataFrame, per_page: int | None = None) -> DataFrame:
    """One row per review text of a page: ``page_id, url, pos, review_text``.

    Review spans win; only a page without any falls back to its paragraphs. ``per_page``
    keeps the first texts of each page in document order. Pages stay in their own row
    until the final explode, so neither the cap nor the order needs a shuffle.
    """
    cleaned = pages.select(
        "page_id", "url", F.regexp_replace("html", _SKIPPED, "").alias("html")
    )
    html = F.col("html")
    found = cleaned.select(
        "page_id",
        "url",
        F.when(html.rlike(_REVIEW_SPAN), _review_spans(html))
        .otherwise(_paragraphs(html))
        .alias("texts"),
    )
    texts = F.filter(F.transform("texts", strip), lambda t: t != "")
    if per_page is not None:
        texts = F.slice(texts, 1, per_page)
    return found.select(
        "page_id", "url", F.posexplode(texts).alias("pos", "review_text")
    )
