"""Expressions on URLs, pages and data URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip_blanks

# Elements whose whole content is no article text.
DROPPED_BLOCKS = ("script", "style", "nav", "head", "header", "footer", "aside", "form")

# Character references that occur in article text; the ampersand comes last so
# that an escaped reference is decoded once only.
CHARACTER_REFERENCES = (
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"),
)


def root_domain(url: Column) -> Column:
    """The host after the first ``www.`` anywhere, else after ``//``, up to the next ``/``.

    A URL with neither starts at its first character.
    """
    tail = (F.when(F.contains(url, F.lit("www.")), F.regexp_replace(url, "^(?s).*?www\\.", ""))
             .otherwise(F.regexp_replace(url, "^(?s).*?//", "")))
    return F.substring_index(tail, "/", 1)


def last_part(text: Column, separator: str = ",") -> Column:
    """What follows the last separator, e.g. the payload of a data URL."""
    return F.substring_index(text, separator, -1)


def article_text(html: Column) -> Column:
    """Paragraph texts of a page, markup dropped and references decoded.

    Paragraphs are joined by an empty line.  A paragraph that is never closed
    ends where the next one starts.
    """
    body = F.regexp_replace(html, "(?s)<!--.*?-->", "")
    for tag in DROPPED_BLOCKS:
        body = F.regexp_replace(body, f"(?is)<{tag}(\\s[^>]*)?>.*?</{tag}>", "")
    closed = F.concat(F.regexp_replace(body, "(?i)<p(\\s[^>]*)?>", "</p><p>"), F.lit("</p>"))
    found = F.regexp_extract_all(closed, F.lit("(?is)<p>(.*?)</p>"), F.lit(1))

    def plain(paragraph: Column) -> Column:
        text = F.regexp_replace(paragraph, "(?s)<[^>]*>", " ")
        for reference, character in CHARACTER_REFERENCES:
            text = F.replace(text, F.lit(reference), F.lit(character))
        return strip_blanks(F.regexp_replace(text, "[ \t\r\n]+", " "))

    return F.array_join(F.filter(F.transform(found, plain), lambda p: p != ""), "\n\n")
