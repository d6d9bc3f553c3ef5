"""Article text out of HTML, as column expressions.

The container is the first element with the wanted tag (and class). Its paragraphs are
read the way a lenient tree parser nests them: a ``<p>`` inside an open ``<p>`` is its
child, so the outer paragraph's text holds the inner one's and both are listed; an
unclosed paragraph runs to the end of the container.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from newstide.functions.binding import bound

# Unicode non-characters: they cannot occur in interchanged text, so they can stand for tags.
OPEN, CLOSE = "\ufdd0", "\ufdd1"

#: names of character references that need no semicolon, the longest first
_BARE = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
_REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


def _windows(code: int) -> str:
    """What a reference to a control code from 128 on is read as: the Windows-1252 character."""
    try:
        return bytes([code]).decode("cp1252")
    except UnicodeDecodeError:
        return chr(code)


_WINDOWS = "".join(map(_windows, range(128, 160)))


def drop_hidden(html: Column) -> Column:
    """Remove what a reader never sees and whose text may look like tags."""
    hidden = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
    return F.regexp_replace(html, hidden, "")


def container(html: Column, tag: str, css_class: str | None = None) -> Column:
    """Inner HTML of the first matching element, null when there is none."""
    wanted = rf"<{tag}\b[^>]*>"
    if css_class:
        name = rf"(?<![\w-]){css_class}(?![\w-])"
        wanted = rf"<{tag}\b[^>]*\bclass\s*=\s*(?:\"[^\">]*{name}|'[^'>]*{name}|{name})[^>]*>"
    any_mark = rf"(?i)<(/?){tag}\b[^>]*>"

    def walk(acc: Column, mark: Column) -> Column:
        depth = acc["depth"] + F.when(mark == "/", -1).otherwise(1)
        return F.when(acc["depth"] == 0, acc).otherwise(
            F.struct(depth.alias("depth"), (acc["used"] + 1).alias("used"))
        )

    def inner(after: Column) -> Column:
        # the element ends at the tag that brings the nesting of its own kind back to zero
        marks = F.regexp_extract_all(after, F.lit(any_mark), F.lit(1))
        start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("used"))
        # one that is never closed keeps everything after its last mark as well
        pieces = F.aggregate(marks, start, walk, lambda a: a["used"] + F.when(a["depth"] > 0, 1).otherwise(0))
        return F.array_join(F.slice(F.split(after, any_mark), F.lit(1), pieces), "")

    found = F.regexp_like(html, F.lit(rf"(?is){wanted}"))
    return F.when(found, bound(F.regexp_extract(html, rf"(?is){wanted}(.*)", 1), inner))


def _character(number: Column) -> Column:
    """The character of a numeric reference, as HTML reads it; null numbers are too large."""
    surrogate = number.between(0xD800, 0xDFFF)
    last_two = (number.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE) | number.between(0xFDD0, 0xFDEF)
    control = number.between(1, 8) | (number == 11) | number.between(14, 31) | (number == 127)
    replaced = number.isNull() | (number > 0x10FFFF) | (number == 0) | surrogate
    return (
        F.when(replaced, "\ufffd")
        .when(number.between(128, 159), F.substr(F.lit(_WINDOWS), number.cast("int") - 127, F.lit(1)))
        .when(last_two | control, "")
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
    )


def unescape(text: Column) -> Column:
    """Decode character references as HTML does: by number, by name, by a name it begins with."""
    # a map is searched from its start: names are kept apart by their first two letters
    heads: dict[str, dict[str, str]] = {}
    for name, characters in html5.items():
        heads.setdefault(name[:2], {})[name] = characters
    names = F.from_json(F.lit(json.dumps(heads)), "map<string,map<string,string>>")
    bare = "^(" + "|".join(_BARE) + ")"

    def number(reference: Column) -> Column:
        hexadecimal = F.regexp_extract(reference, "^#[xX]0*([0-9a-fA-F]*)", 1)
        decimal = F.regexp_extract(reference, "^#0*([0-9]*)", 1)
        digits = F.when(reference.rlike("^#[xX]"), hexadecimal).otherwise(decimal)
        value = F.when(reference.rlike("^#[xX]"), F.conv(hexadecimal, 16, 10)).otherwise(F.conv(decimal, 10, 10))
        return F.when(digits == "", F.lit(0)).when(F.length(digits) <= 8, value.cast("bigint"))

    def known(name: Column) -> Column:
        return F.try_element_at(F.try_element_at(names, F.substring(name, 1, 2)), name)

    def named(reference: Column) -> Column:
        begins = F.regexp_extract(reference, bare, 1)
        rest = F.substring(reference, F.length(begins) + F.lit(1), F.length(reference))
        return F.coalesce(
            known(reference),
            F.when(begins != "", F.concat(known(begins), rest)),
            F.concat(F.lit("&"), reference),
        )

    def piece(part: Column, i: Column) -> Column:
        def decoded(reference: Column) -> Column:
            rest = F.substring(part, F.length(reference) + F.lit(1), F.length(part))
            value = F.when(reference == "", F.lit("&")).when(
                reference.startswith("#"), _character(number(reference))
            )
            return F.concat(value.otherwise(named(reference)), rest)

        return F.when(i == 0, part).otherwise(bound(F.regexp_extract(part, _REFERENCE, 1), decoded))

    pieces = F.transform(F.split(text, "&"), piece)
    return F.when(F.contains(text, F.lit("&")), F.array_join(pieces, "")).otherwise(text)


def marked_paragraphs(inner: Column) -> Column:
    """Turn paragraph tags into single marks and drop every other tag."""
    opened = F.regexp_replace(inner, r"(?i)<p(\s[^>]*)?>", OPEN)
    closed = F.regexp_replace(opened, r"(?i)</p\s*>", CLOSE)
    return F.regexp_replace(closed, r"<[^>]*>", "")


def paragraphs(marked: Column) -> Column:
    """Array of paragraph texts, in the order the paragraphs open.

    Where every paragraph is closed before the next one opens, each is what stands between
    its two marks. Otherwise the marks are nested first.
    """
    parts = F.split(marked, OPEN)
    plain = F.transform(
        F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), lambda part: F.substring_index(part, CLOSE, 1)
    )
    return F.when(marked.rlike(f"{OPEN}[^{CLOSE}]*{OPEN}"), nested_paragraphs(marked)).otherwise(plain)


def nested_paragraphs(marked: Column) -> Column:
    """Paragraph texts where an open paragraph holds those that open in it."""
    # nesting depth after each mark, written as numbers as wide as any array index, so that
    # the end of a paragraph is a plain substring search
    width = 11

    def number(n: Column) -> Column:
        return F.concat(F.lit(","), F.lpad(n.cast("string"), width - 1, "0"))

    def nest(acc: Column, mark: Column) -> Column:
        depth = F.when(mark == OPEN, acc["depth"] + 1).otherwise(F.greatest(acc["depth"] - 1, F.lit(0)))
        return F.struct(depth.alias("depth"), F.concat(acc["trail"], number(depth)).alias("trail"))

    def with_trail(marks: Column) -> Column:
        start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("trail"))
        return F.struct(
            marks.alias("marks"),
            F.split(marked, f"[{OPEN}{CLOSE}]").alias("texts"),  # texts[i + 1] follows marks[i]
            F.aggregate(marks, start, nest, lambda a: a["trail"]).alias("trail"),
        )

    def spans(page: Column) -> Column:
        def span(mark: Column, i: Column) -> Column:
            depth = F.substring(page["trail"], i * width + 2, F.lit(width - 1)).cast("int")
            at = F.position(number(depth - 1), page["trail"], (i + 1) * width + 1)
            end = F.when(at > 0, F.floor((at - 1) / width).cast("int")).otherwise(F.size(page["marks"]))
            return F.when(mark == OPEN, F.array_join(F.slice(page["texts"], i + 2, end - i), ""))

        return F.filter(F.transform(page["marks"], span), lambda t: t.isNotNull())

    marks = F.regexp_extract_all(marked, F.lit(f"([{OPEN}{CLOSE}])"), F.lit(1))
    return bound(bound(marks, with_trail), spans)


def article_text(html: Column, tag: str = "div", css_class: str | None = "caas-body") -> Column:
    """Text of an article page: every paragraph followed by a line break.

    A page without the container gives the empty string, a missing page gives null.
    """
    inner = bound(drop_hidden(html), lambda page: container(page, tag, css_class))
    texts = bound(marked_paragraphs(inner), paragraphs)
    # a reference does not reach over a line break, so all paragraphs are decoded at once
    lines = F.array_join(F.transform(texts, lambda p: F.concat(p, F.lit("\n"))), "")
    return F.when(html.isNotNull(), F.coalesce(bound(lines, unescape), F.lit("")))
