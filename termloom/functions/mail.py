"""Message fields as column expressions: headers, addresses, dates, body text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import shipping  # noqa: F401  (helpers travel with the UDFs)
from .html import html_paragraph_text
from .let import let
from .mime import decode_words, decoded_text, text_parts
from .tokens import as_col, strip_blanks


def without_divider(message) -> Column:
    """The message behind its mbox divider line."""
    return F.regexp_replace(as_col(message), r"^From [^\n]*\n", "")


def header_block(mail) -> Column:
    """Everything before the first blank line, folded lines joined."""
    mail = as_col(mail)
    block = F.when(F.startswith(mail, F.lit("\n")), F.lit("")).otherwise(F.substring_index(mail, "\n\n", 1))
    return F.regexp_replace(block, r"\n[ \t]+", " ")


def body_block(mail) -> Column:
    """Everything behind the first blank line."""
    return let(
        as_col(mail),
        lambda m: F.when(F.startswith(m, F.lit("\n")), F.substr(m, F.lit(2))).otherwise(
            F.substr(m, F.length(F.substring_index(m, "\n\n", 1)) + 3)
        ),
    )


def _header_pattern(name: str) -> str:
    return rf"(?imd)^{name}[ \t]*:[ \t]*([^\n]*)$"


def header_value(block, name: str) -> Column:
    """First value of a header, trimmed; empty if absent."""
    return strip_blanks(F.regexp_extract(as_col(block), _header_pattern(name), 1))


def last_header_value(block, name: str) -> Column:
    """Last value of a header, trimmed; empty if absent."""
    values = F.regexp_extract_all(as_col(block), F.lit(_header_pattern(name)), F.lit(1))
    return strip_blanks(F.coalesce(F.try_element_at(values, F.lit(-1)), F.lit("")))


def decoded(value) -> Column:
    """Encoded words decoded; values without any never leave the JVM."""
    value = as_col(value)
    return F.coalesce(decode_words(F.when(value.contains("=?"), value)), value)


# Marks of an address list that has been taken apart; noncharacters, which no text may hold.
_ENTRY, _MEMBER, _OPEN, _SHUT, _GROUP, _END, _TEXT = (chr(c) for c in range(0xFDD0, 0xFDD7))
_MARKS = _ENTRY + _MEMBER + _OPEN + _SHUT + _GROUP + _END + _TEXT

# signs in runs, quoted pairs, and single signs that may mean something; nothing here recurses
_ADDRESS_TOKEN = r"(?s)\\.|[^\"()\\,:;<>]++|."
#: tokens that are scanned at once, so that joining them stays cheap however many there are
_SCANNED = 2_048
# lists of names, addresses in angle brackets and commas alone
_SIMPLE = r'^[^"()\\:;]*+$'
_PAIRED = r"(?s)^[^<>]*+(?:<[^<>]*+>[^<>]*+)*+$"


def _address_step(state: Column, token: Column) -> Column:
    """One move of the pushdown over the tokens of an address list.

    ``mode`` is 0 in the open, 1 in a quoted string and 1 + n in the n-th comment within
    another; ``angle`` and ``group`` say what else is open. ``out`` gets the signs that count, and
    marks for those that part the list.
    """
    mode, angle, group = state["mode"], state["angle"], state["group"]
    pair = F.startswith(token, F.lit("\\")) & (F.length(token) == 2)
    quote = token == '"'
    commented = (
        F.when(token == "(", mode + 1).when((token == ")") & (mode == 2), F.lit(0)).when(token == ")", mode - 1).otherwise(mode)
    )
    free = mode == 0
    out = (
        F.when(mode >= 2, F.lit(""))
        # a quoted local part keeps its marks
        .when(quote, F.when(angle, token).otherwise(F.lit("")))
        .when(pair, F.substr(token, F.lit(2)))
        .when(~free, token)
        .when(token == "(", F.lit(""))
        .when(angle, F.when(token == ">", F.lit(_SHUT)).otherwise(token))
        .when(token == "<", F.lit(_OPEN))
        .when(token == ",", F.when(group, F.lit(_MEMBER)).otherwise(F.lit(_ENTRY)))
        .when((token == ":") & ~group, F.lit(_GROUP))
        .when((token == ";") & group, F.lit(_END + _ENTRY))
        .otherwise(token)
    )
    return F.struct(
        F.when(mode >= 2, commented)
        .when(mode == 1, F.when(quote, F.lit(0)).otherwise(mode))
        .when(quote, F.lit(1))
        .when(token == "(", F.lit(2))
        .otherwise(mode)
        .alias("mode"),
        (angle & ~(free & (token == ">")) | (free & (token == "<"))).alias("angle"),
        F.when(~free | angle, group).when(token == ":", F.lit(True)).when(token == ";", F.lit(False)).otherwise(group).alias("group"),
        F.concat(state["out"], out).alias("out"),
    )


def _scan_addresses(tokens: Column) -> Column:
    """(mode, angle, group, parts) after all tokens."""

    def begin(mode, angle, group, out, name):
        return F.struct(mode.alias("mode"), angle.alias("angle"), group.alias("group"), out.alias(name))

    def block(state: Column, at: Column) -> Column:
        own = F.aggregate(
            F.slice(tokens, at, _SCANNED),
            begin(state["mode"], state["angle"], state["group"], F.lit(""), "out"),
            _address_step,
        )
        return let(own, lambda r: begin(r["mode"], r["angle"], r["group"], F.concat(state["parts"], F.array(r["out"])), "parts"))

    nothing = begin(F.lit(0), F.lit(False), F.lit(False), F.array().cast("array<string>"), "parts")
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(tokens), F.lit(1)), F.lit(_SCANNED)), nothing, block)


def address_marks(header) -> Column:
    """An address list with marks for what parts it, without comments and quotation marks.

    Groups, quoted strings and quoted pairs, comments within comments and routes are taken
    apart by one scan. A header that leaves a quotation, comment, bracket or group open is no
    address list, and is kept as text behind a mark of its own.
    """

    def simple(h: Column) -> Column:
        return F.when(h.rlike(_PAIRED), F.translate(h, ",<>", _ENTRY + _OPEN + _SHUT)).otherwise(F.concat(F.lit(_TEXT), h))

    def scanned(h: Column) -> Column:
        return let(
            let(F.regexp_extract_all(h, F.lit(_ADDRESS_TOKEN), F.lit(0)), _scan_addresses),
            lambda s: F.when((s["mode"] > 0) | s["angle"] | s["group"], F.concat(F.lit(_TEXT), h)).otherwise(
                F.array_join(s["parts"], "")
            ),
        )

    return let(F.translate(as_col(header), _MARKS, ""), lambda h: F.when(h.rlike(_SIMPLE), simple(h)).otherwise(scanned(h)))


def _mailbox(entry: Column) -> Column:
    """``name <address>``, the address alone, or what else stands there."""

    def render(e: Column) -> Column:
        name = F.trim(F.split_part(e, F.lit(_OPEN), F.lit(1)))
        address = F.trim(F.regexp_replace(_bracketed(e), "^@[^:]*+:", ""))
        named = F.when(name == "", address).otherwise(F.concat(name, F.lit(" <"), address, F.lit(">")))
        return F.when(e.contains(_OPEN), named).otherwise(F.trim(e))

    return let(entry, render)


def _bracketed(entry: Column) -> Column:
    return F.split_part(F.split_part(entry, F.lit(_OPEN), F.lit(2)), F.lit(_SHUT), F.lit(1))


def _not_blank(entries: Column) -> Column:
    return F.filter(entries, lambda e: F.trim(e) != "")


def _members(entry: Column) -> Column:
    """The mailboxes of an entry that is a group."""
    return F.split(F.translate(F.split_part(entry, F.lit(_GROUP), F.lit(2)), _END, ""), _MEMBER)


def sender_of(marks) -> Column:
    """First mailbox of a From header that :func:`address_marks` has taken apart; groups count by their members."""

    def members(e: Column) -> Column:
        return F.when(e.contains(_GROUP), _members(e)).otherwise(F.array(e))

    def listed(m: Column) -> Column:
        first = F.get(_not_blank(F.flatten(F.transform(F.split(m, _ENTRY), members))), F.lit(0))
        return F.coalesce(_mailbox(first), F.lit(""))

    def text(m: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(F.translate(m, _MARKS, ""), "^<", ""), ">$", "")

    return let(as_col(marks), lambda m: F.when(m.startswith(_TEXT), text(m)).otherwise(listed(m)))


def recipients_of(marks) -> Column:
    """Entries of a To, Cc or Bcc header that :func:`address_marks` has taken apart; an absent header has none."""

    def entry(e: Column) -> Column:
        addresses = F.transform(
            _not_blank(_members(e)), lambda m: F.when(m.contains(_OPEN), F.trim(_bracketed(m))).otherwise(F.trim(m))
        )
        group = F.concat(F.trim(F.split_part(e, F.lit(_GROUP), F.lit(1))), F.lit(":"), F.array_join(F.transform(addresses, lambda a: F.concat(F.lit(" "), a)), ","), F.lit(";"))
        return F.when(e.contains(_GROUP), group).otherwise(_mailbox(e))

    def text(m: Column) -> Column:
        return F.transform(_not_blank(F.split(F.translate(m, _MARKS, ""), ",")), lambda e: F.trim(e))

    return let(
        as_col(marks),
        lambda m: F.when(m.startswith(_TEXT), text(m)).otherwise(F.transform(_not_blank(F.split(m, _ENTRY)), entry)),
    )


def from_display(header) -> Column:
    """First sender of a From header as ``name <address>`` or ``address``.

    A header that is no address list is kept as text, without one leading ``<``
    and one trailing ``>``.
    """
    return sender_of(address_marks(header))


def recipients(header) -> Column:
    """Entries of a To/Cc/Bcc header as ``name <address>``; an absent header has none.

    A group is one entry, ``name: address, address;``. A header that is no address list is
    split at its commas.
    """
    return recipients_of(address_marks(header))


def _split_creator(creator: Column) -> Column:
    """(author, address) by the two forms, without a search that could go over the text twice.

    The address begins behind the last ``<`` that has a sign, ``@`` and a sign after it.
    """

    def taken_apart(c: Column) -> Column:
        body = F.substr(c, F.lit(1), F.length(c) - 1)
        # place of the last @ that is not the last sign
        at = let(F.reverse(body), lambda r: F.locate("@", r, 2))
        at = let(at, lambda k: F.when(k > 0, F.length(c) - k))
        bracket = let(at, lambda a: let(F.substr(c, F.lit(1), a - 2), lambda h: let(F.instr(F.reverse(h), "<"), lambda k: F.when(k > 0, F.length(h) - k + 1))))
        return let(
            F.when(c.endswith(">") & ~c.rlike(r"[\n\r\u0085\u2028\u2029]"), bracket),
            lambda p: F.when(
                p.isNotNull(),
                F.struct(F.substr(c, F.lit(1), p - 1).alias("author"), F.substr(c, p + 1, F.length(c) - p - 1).alias("address")),
            ),
        )

    def plain(c: Column) -> Column:
        bare = F.locate("@", c, 2).between(2, F.length(c) - 1) & ~c.rlike(r"[\n\r\u0085\u2028\u2029]")
        return F.struct(F.lit("").alias("author"), F.when(bare, c).otherwise(F.lit("")).alias("address"))

    return let(creator, lambda c: F.when(c.isNotNull(), F.coalesce(taken_apart(c), plain(c))))


def author_of(creator, trim: bool = True) -> Column:
    """Name part of ``name <address>``, else empty. ``trim=False`` keeps its last blank."""
    name = _split_creator(as_col(creator))["author"]
    return F.trim(name) if trim else name


def address_of(creator) -> Column:
    """Address part of a sender; empty if there is none."""
    return _split_creator(as_col(creator))["address"]


# Zone names of the mail date format that are not offsets.
_ZONES = {
    "GMT": "+0000", "UTC": "+0000", "UT": "+0000", "Z": "+0000",
    "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500",
    "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
}


LONGEST_DATE = 256  # signs


def mail_date(header) -> Column:
    """RFC 822 date to a timestamp; null if unreadable, or longer than dates are."""
    text = F.when(F.length(as_col(header)) <= LONGEST_DATE, as_col(header))
    text = F.regexp_replace(text, r"\([^)]*\)", " ")
    text = F.regexp_replace(text, r"^\s*[A-Za-z]{3,9}\s*,?\s+(?=\d)|^\s*[A-Za-z]{3,9},(?=\d)", "")
    text = F.initcap(F.trim(F.regexp_replace(text, r"\s+", " ")))
    offsets = F.map_from_arrays(F.lit(list(_ZONES)), F.lit(list(_ZONES.values())))

    def numeric_zone(t: Column) -> Column:
        name = F.regexp_extract(t, r" ([A-Za-z]+)$", 1)
        offset = F.coalesce(F.try_element_at(offsets, F.upper(name)), name)
        return F.when(name == "", t).otherwise(F.concat(F.regexp_replace(t, r"[A-Za-z]+$", ""), offset))

    formats = ["d MMM yyyy H:mm:ss Z", "d MMM yyyy H:mm Z", "d MMM yy H:mm:ss Z", "d MMM yy H:mm Z"]
    return let(
        let(text, numeric_zone),
        lambda t: F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in formats]),
    )


def over_long(message, max_line_len: int) -> Column:
    """True if a line of the message passes the limit."""
    return let(
        as_col(message),
        lambda m: F.when(F.length(m) <= max_line_len, F.lit(False)).otherwise(
            F.exists(F.split(m, "\n"), lambda line: F.length(line) > max_line_len)
        ),
    )


def needs_mime(block) -> Column:
    """True if the body must be decoded: multipart, base64 or quoted-printable."""
    kind = F.lower(header_value(block, "Content-Type"))
    coding = F.lower(header_value(block, "Content-Transfer-Encoding"))
    return kind.startswith("multipart/") | coding.isin("base64", "quoted-printable")


def part_text(ctype: Column, text: Column) -> Column:
    return F.when(ctype == "text/html", html_paragraph_text(text, part=True)).otherwise(text)


# Bytes as text, one sign for each byte: patterns work on it, and nothing is lost.
BYTE_VIEW = "iso-8859-1"

# Names of the charsets that need no Python, and the signs in which the
# second differs from the bytes' own numbers.
_UTF8 = ("", "utf-8", "utf8", "us-ascii", "ascii")
_LATIN1 = ("iso-8859-1", "iso8859-1", "latin1", "latin-1")
_WINDOWS_1252 = ("windows-1252", "cp1252")
_WINDOWS_BYTES = "".join(chr(b) for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))
_WINDOWS_SIGNS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"


def byte_view(raw) -> Column:
    """Bytes as text, one sign each."""
    return F.decode(as_col(raw), BYTE_VIEW)


def view_bytes(view) -> Column:
    return F.encode(as_col(view), BYTE_VIEW)


def utf8_text(view) -> Column:
    """The text of bytes in UTF-8; wrong bytes become U+FFFD."""
    return F.make_valid_utf8(view_bytes(view).cast("string"))


def charset_of(block) -> Column:
    """Charset that the Content-Type of a message names, in lower case; empty if none."""
    kind = header_value(block, "Content-Type")
    return F.lower(F.regexp_extract(kind, r"(?i)charset\s*=\s*[\"']?([^\s;\"']+)", 1))


def charset_text(view, charset) -> Column:
    """The text of a body by its declared charset; UTF-8 if none is declared."""
    charset = as_col(charset)
    common = charset.isin(*_UTF8, *_LATIN1, *_WINDOWS_1252)
    other = decoded_text(F.when(~common, view_bytes(view)), charset)
    return (
        F.when(charset.isin(*_UTF8), utf8_text(view))
        .when(charset.isin(*_LATIN1), as_col(view))
        .when(charset.isin(*_WINDOWS_1252), F.translate(as_col(view), _WINDOWS_BYTES, _WINDOWS_SIGNS))
        .otherwise(other)
    )


def is_text_body(block) -> Column:
    kind = body_type(block)
    return kind.startswith("text/") | (kind == "")


def body_type(block) -> Column:
    return F.lower(F.regexp_extract(header_value(block, "Content-Type"), r"^([^;\s]*)", 1))


def mime_body(message, coding: str = "utf-8") -> Column:
    """Text of all text parts of a MIME message, one after the other.

    Null in, null out; null also where the message cannot be decoded. ``coding`` is what
    the message's bytes have been read as.
    """
    parts = text_parts(message, coding)
    return F.array_join(F.transform(parts, lambda p: part_text(p.ctype, p.text)), "\n")
