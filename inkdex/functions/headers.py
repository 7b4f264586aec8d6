"""Title of a book from the first characters of its text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkdex.functions.text import trim_control

# The header length and the marks that open and close a title.
HEAD_CHARACTERS = 1500
TITLE_MARKS = ["Title: ", "TITLE: "]
TITLE_MARK_ANY_CASE = "title:"
TITLE_MARK_WIDTH = 6
TITLE_LINE = (
    r"(?s)^ ?(.*?)(?:Author:|Release Date:|Release date:|Language:|EBook #|\[eBook #|Posting Date:|\n|\r|\z)"
)
BANNERS = ["The Project Gutenberg eBook of", "The Project Gutenberg EBook of"]
BANNER_WIDTH = 30
BANNER_LINE = r"(?s)^(.*?)(?:This eBook|\n|\z)"
UNTITLED_PREFIX = "Book #"


def head(text: Column, characters: int = HEAD_CHARACTERS) -> Column:
    return F.substring(text, 1, characters)


def _first_mark(text: Column, marks: list[str]) -> list[Column]:
    """1-based place of each mark, null for one that does not occur."""
    return [F.nullif(F.instr(text, F.lit(mark)), F.lit(0)) for mark in marks]


def _rest(text: Column, start: Column) -> Column:
    return text.substr(start, F.length(text))


def title_from_head(text: Column) -> Column:
    """Title given in a header, or null.

    A ``Title:`` line wins over the e-book banner; within the former the spelling of the mark decides
    before its place. One comma at the end of the line is left out.
    """
    mark = F.coalesce(*_first_mark(text, TITLE_MARKS), *_first_mark(F.lower(text), [TITLE_MARK_ANY_CASE]))
    line = trim_control(F.regexp_extract(_rest(text, mark + TITLE_MARK_WIDTH), TITLE_LINE, 1))
    title = trim_control(F.regexp_replace(line, r",\z", ""))
    banner = F.coalesce(*_first_mark(text, BANNERS))
    name = trim_control(F.regexp_extract(_rest(text, banner + BANNER_WIDTH), BANNER_LINE, 1))
    return F.coalesce(F.nullif(title, F.lit("")), F.nullif(name, F.lit("")))


def untitled(doc_id: Column) -> Column:
    return F.concat(F.lit(UNTITLED_PREFIX), doc_id.cast("string"))
