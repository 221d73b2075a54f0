"""HTML as ordered text elements and as markdown, by built-in expressions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from docrecords.functions.text import squeeze

# Tags that start or end a block of text.
BLOCK_TAGS = (
    "address article aside blockquote body br caption dd div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html li main nav ol p pre section table tbody tfoot thead title tr ul"
).split()

# Named character references, ampersand last.
ENTITIES = {
    "&nbsp;": " ",
    "&copy;": "©",
    "&reg;": "®",
    "&middot;": "·",
    "&ndash;": "–",
    "&mdash;": "—",
    "&hellip;": "…",
    "&euro;": "€",
    "&quot;": '"',
    "&apos;": "'",
    "&lt;": "<",
    "&gt;": ">",
    "&amp;": "&",
}

CUT = "\u001e"
_INVISIBLE = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_TABLE = r"(?is)<table\b.*?</table\s*>"
_BLOCK = r"(?i)(</?(?:" + "|".join(BLOCK_TAGS) + r")\b)"


#: Stands after the '<' of an opening that nothing closes, so that no pattern looks for its end.
UNCLOSED = "\u001f"
_PAIRS = ((r"<(!--)", "-->"), (r"<(script\b)", r"</script\s*>"), (r"<(style\b)", r"</style\s*>"))


def _guarded(text: Column, opening: str, closing: str) -> Column:
    """Openings behind the last closing are marked; every other one has its end ahead.

    A lazy pattern then never runs to the end of the text in vain, which a page of unclosed
    openings would make it do for each of them.
    """
    return _at_last(text, f"(?is){closing}", lambda head, rest: F.concat(head, F.regexp_replace(rest, f"(?i){opening}", f"<{UNCLOSED}$1")))


def _at_last(text: Column, pattern: str, fn: Callable[[Column, Column], Column]) -> Column:
    """A function of the text up to the last match of a pattern, and of the rest.

    Text and end are bound as elements of arrays, so that neither is computed twice.
    """
    flags, body = pattern[: pattern.index(")") + 1], pattern[pattern.index(")") + 1 :]
    ended = F.transform(F.array(text), lambda t: F.struct(t.alias("t"), F.length(F.regexp_extract(t, f"{flags}^.*{body}", 0)).alias("n")))
    return F.element_at(F.transform(ended, lambda x: fn(F.substring(x["t"], F.lit(1), x["n"]), F.substring(x["t"], x["n"] + 1, F.length(x["t"])))), 1)


def _unguarded(text: Column) -> Column:
    return F.replace(text, F.lit(f"<{UNCLOSED}"), F.lit("<"))


def visible(html: Column) -> Column:
    """The page without scripts, style sheets, comments and stray separators."""
    text = F.regexp_replace(html, f"[{CUT}{UNCLOSED}]", " ")
    for opening, closing in _PAIRS:
        text = _guarded(text, opening, closing)
    return _unguarded(F.regexp_replace(text, _INVISIBLE, " "))


def plain(markup: Column) -> Column:
    """Markup as one line of text: tags dropped, character references decoded."""
    return squeeze(_entities(_at_last(markup, "(?s)>", lambda head, rest: F.concat(F.regexp_replace(head, r"(?s)<[^>]*>", ""), rest))))


def _entities(text: Column) -> Column:
    # Numeric references: every piece after the first starts with a code point.
    pieces = F.split(F.regexp_replace(text, r"&#(?:[xX]([0-9a-fA-F]{1,6})|([0-9]{1,7}));", CUT + "$1~$2~"), CUT)
    decoded = F.array_join(F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(_code_point(p))), "")
    text = F.when(text.contains("&#"), decoded).otherwise(text)
    for name, value in ENTITIES.items():
        text = F.replace(text, F.lit(name), F.lit(value))
    return text


def _code_point(piece: Column) -> Column:
    hexadecimal = F.regexp_extract(piece, r"^([0-9a-fA-F]*)~([0-9]*)~", 1)
    decimal = F.regexp_extract(piece, r"^([0-9a-fA-F]*)~([0-9]*)~", 2)
    number = F.when(hexadecimal != "", F.conv(hexadecimal, 16, 10).cast("long")).otherwise(decimal.cast("long"))
    legal = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    char = F.when(legal, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).otherwise("�")
    rest = F.regexp_replace(piece, r"^[0-9a-fA-F]*~[0-9]*~", "")
    return F.concat(char, rest)


def _pieces(html: Column) -> Column:
    """The page cut before each table, after it, and before each other block tag."""
    page = _guarded(visible(html), r"<(table\b)", r"</table\s*>")
    around_tables = F.split(_unguarded(F.regexp_replace(page, "(" + _TABLE + ")", f"{CUT}$1{CUT}")), CUT)
    return F.flatten(
        F.transform(
            around_tables,
            lambda part: F.when(part.rlike(r"(?is)^<table\b"), F.array(part)).otherwise(
                F.split(F.regexp_replace(part, _BLOCK, f"{CUT}$1"), CUT)
            ),
        )
    )


def _element(piece: Column) -> Column:
    """(tag, content): the opening tag a piece starts with, else 'text'."""
    tag = F.lower(F.regexp_extract(piece, r"^<([a-zA-Z][a-zA-Z0-9]*)", 1))
    is_table = piece.rlike(r"(?is)^<table\b.*</table")
    content = F.when(is_table, table_markdown(piece)).otherwise(plain(piece))
    return F.struct(F.when(tag == "", "text").otherwise(tag).alias("tag"), content.alias("content"))


def elements(html: Column) -> Column:
    """ARRAY<STRUCT<tag, content>> in page order; pieces without text are left out."""
    return F.filter(F.transform(_pieces(html), _element), lambda e: e["content"] != "")


def table_markdown(table: Column) -> Column:
    """Pipe rows: the first row, a separator row, the other rows."""
    rows = F.regexp_extract_all(table, F.lit(r"(?is)<tr\b[^>]*>(.*?)(?=</tr|<tr\b|</table)"), 1)
    cells = F.transform(
        rows,
        lambda r: F.transform(
            F.regexp_extract_all(r, F.lit(r"(?is)<t[hd]\b[^>]*>(.*?)(?=</t[hd]|<t[hd]\b|$)"), 1),
            lambda c: F.replace(plain(c), F.lit("|"), F.lit("\\|")),
        ),
    )
    lines = F.transform(
        F.filter(cells, lambda r: F.size(r) > 0),
        lambda r, i: F.concat(
            F.lit("| "),
            F.array_join(r, " | "),
            F.lit(" |"),
            F.when(
                i == 0,
                F.concat(F.lit("\n| "), F.array_join(F.transform(r, lambda _: F.lit("---")), " | "), F.lit(" |")),
            ).otherwise(""),
        ),
    )
    return F.array_join(lines, "\n")


def markdown(html: Column) -> Column:
    """Text sections joined by a space, tables set off by newlines."""
    return F.array_join(
        F.transform(
            elements(html),
            lambda e: F.when(e["tag"] == "table", F.concat(F.lit("\n"), e["content"], F.lit("\n"))).otherwise(
                F.concat(F.lit(" "), e["content"])
            ),
        ),
        "",
    )
