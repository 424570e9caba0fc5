"""Paragraph text of HTML bodies, with built-in expressions only."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .let import let
from .tokens import as_col

# The tokens of a document. A tag begins with "<" and a letter, or "</" and a letter; values in
# quotation marks may hold ">". Any other "<" is text. What stands in a script and the like is
# no markup up to its own end tag, or the end. No repetition here recurses or goes back.
_REST_OF_TAG = r"""(?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+>?"""
_RAW = [r"(?i:script)", r"(?i:style)", r"(?i:xmp)", r"(?i:iframe)", r"(?i:noembed)", r"(?i:noframes)"]
_RAW_TEXT = "|".join(rf"<{name}(?=[\s/>]){_REST_OF_TAG}(?:[^<]++|<(?!/{name}[\s/>]))*+" for name in _RAW)
_COMMENT = r"<!---?>|<!--(?:[^-]++|-(?!-!?>))*+(?:--!?>)?"
_BOGUS_COMMENT = r"<[!?][^>]*+>?|</(?![A-Za-z])[^>]*+>?"
_TAG = rf"</?[A-Za-z][^\s/>]*+{_REST_OF_TAG}"
_TOKEN = rf"(?s){_COMMENT}|{_RAW_TEXT}|{_BOGUS_COMMENT}|{_TAG}|[^<]++|<"
_IS_MARKUP = r"^<[!/?A-Za-z]"
_TAG_NAME = r"^<(/?[A-Za-z][^\s/>]*+)"
# paragraphs begin and end at these; a paragraph cannot outlive what it stands in
CONTAINERS = (
    "p div article section main aside header footer nav form fieldset blockquote figure center"
    " ul ol li dl dd dt table tbody thead tfoot tr td th body html"
).split()
# marks for what a tag does; noncharacters, which no text may hold
_OPENED, _CLOSED, _ENDED, _QUOTE, _UNQUOTE, _PAIR, _NAME = (chr(c) for c in range(0xFDD0, 0xFDD7))
_MARKS = "".join(chr(c) for c in range(0xFDD0, 0xFDD7))
_EVENTS = {"p": _OPENED, "/p": _ENDED, "br": "\n", "br/": "\n", "q": _QUOTE, "/q": _UNQUOTE} | {
    f"/{name}": _CLOSED for name in CONTAINERS if name != "p"
}

# numbers from 128 to 159 stand for the signs of windows-1252; those that it lacks, for themselves
_WINDOWS = [ord(bytes([b]).decode("cp1252", "ignore") or chr(b)) for b in range(128, 160)]

_REFERENCE = r"^(#[xX][0-9a-fA-F]{1,8};?|#[0-9]{1,9};?|[A-Za-z][A-Za-z0-9]*;?)"


def _names() -> Column:
    """All named references as one constant, with the semicolon where it is needed."""
    # one literal: an array of thousands of literals takes longer to build than many a query to run
    text = _PAIR.join(f"{name}{_NAME}{sign}" for name, sign in html5.items())
    return F.str_to_map(F.lit(text), F.lit(_PAIR), F.lit(_NAME))


def _numbered(digits: Column) -> Column:
    """The sign with a decimal or x-hexadecimal number; U+FFFD if there is none."""
    code = F.when(
        F.lower(F.substr(digits, F.lit(1), F.lit(1))) == "x", F.conv(F.substr(digits, F.lit(2)), 16, 10)
    ).otherwise(digits)

    def sign(c: Column) -> Column:
        c = F.when(c.between(128, 159), F.get(F.lit(_WINDOWS), (c - 128).cast("int")).cast("bigint")).otherwise(c)
        none = (c == 0) | c.between(0xD800, 0xDFFF) | (c > 0x10FFFF)
        hexed = F.lpad(F.hex(F.when(none, 0xFFFD).otherwise(c)), 8, "0")
        return F.decode(F.unhex(hexed), "UTF-32")

    return let(code.cast("bigint"), sign)


def unescape(text) -> Column:
    """Character references decoded, each once: ``&amp;lt;`` becomes ``&lt;``.

    Named references end in a semicolon, or are of those that need none and are not
    followed by a letter or digit.
    """
    names = _names()

    def piece(p: Column, i: Column) -> Column:
        name = F.regexp_extract(p, _REFERENCE, 1)
        number = F.when(name.startswith("#"), _numbered(F.rtrim(F.substr(name, F.lit(2)), F.lit(";"))))
        found = F.coalesce(number, F.when(name != "", F.try_element_at(names, name)))
        rest = F.substr(p, F.length(name) + 1)
        return F.when(i == 0, p).when(found.isNull(), F.concat(F.lit("&"), p)).otherwise(F.concat(found, rest))

    return let(
        as_col(text),
        lambda t: F.when(
            F.contains(t, F.lit("&")), F.array_join(F.transform(F.split(t, "&"), piece), "")
        ).otherwise(t),
    )


def _events(html: Column) -> Column:
    """The text of a document with a mark for every tag that counts, and nothing for all other markup."""
    events = F.map_from_arrays(F.lit(list(_EVENTS)), F.lit(list(_EVENTS.values())))

    def event(token: Column) -> Column:
        name = F.lower(F.regexp_extract(token, _TAG_NAME, 1))
        # a tag that the text breaks off is none
        tag = F.when(token.endswith(">"), F.try_element_at(events, name))
        return F.when(token.rlike(_IS_MARKUP), F.coalesce(tag, F.lit(""))).otherwise(unescape(token))

    tokens = F.regexp_extract_all(F.translate(as_col(html), _MARKS, ""), F.lit(_TOKEN), F.lit(0))
    return F.array_join(F.transform(tokens, event), "")


def _without_quotes(marked: Column) -> Column:
    """Quotations end at the first end tag; what begins or ends paragraphs counts inside, too."""

    def piece(p: Column, i: Column) -> Column:
        quoted = F.substring_index(p, _UNQUOTE, 1)
        kept = F.regexp_replace(quoted, f"[^{_OPENED}{_CLOSED}{_ENDED}]++", "")
        return F.when(i == 0, p).otherwise(F.concat(kept, F.substr(p, F.length(quoted) + 1)))

    whole = let(
        marked,
        lambda m: F.when(m.contains(_QUOTE), F.array_join(F.transform(F.split(m, _QUOTE), piece), "")).otherwise(m),
    )
    return F.translate(whole, _UNQUOTE, "")


def html_paragraph_text(html, part: bool = False) -> Column:
    """Text inside ``<p>``: breaks become newlines, ``<q>`` content is skipped.

    A paragraph ends at its end tag, at the next paragraph, with the element that it stands
    in, or with the text, and is followed by a blank and a newline. Text outside paragraphs
    is navigation and is left out. In a message ``part`` a paragraph is open from the start:
    what stands before the first paragraph or end of one is text, too. Only noncharacters are
    lost from texts.
    """

    def paragraphs(marked: Column) -> Column:
        inside = F.transform(
            F.filter(F.split(F.translate(marked, _ENDED, _CLOSED), _OPENED), lambda _, i: i > 0),
            lambda p: F.substring_index(p, _CLOSED, 1),
        )
        if not part:
            return inside
        # containers do not end the paragraph that the part has opened, but part its words
        head = F.translate(F.substring_index(F.translate(marked, _ENDED, _OPENED), _OPENED, 1), _CLOSED, " ")
        shown = F.filter(F.array(head), lambda h: F.rlike(h, F.lit(r"\S")))
        return F.concat(shown, inside)

    texts = let(_without_quotes(_events(html)), paragraphs)
    return F.array_join(F.transform(texts, lambda p: F.concat(p, F.lit(" \n"))), "")
