"""Cleaning of the e-mail text: address case, line escaping, quoted replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .tokens import as_col, strip_blanks

# What a quoted line and the line announcing a quote look like.
QUOTED_LINE = r"(?m)^[>]{1,} .*"
QUOTE_HEADER = r"(?m)^>* On ..., .+, .+wrote:"
QUOTE_HEADER_LENIENT = r"(?m)^>* ?On ..., .+, .+wrote:"


def normalize_email(c) -> Column:
    return F.lower(strip_blanks(c))


def escape_content(c) -> Column:
    """Line ends and tabs as the two-character codes of the one-line format."""
    one_line = F.regexp_replace(as_col(c), "\r\n|\r|\n", r"\\n")
    return F.replace(one_line, F.lit("\t"), F.lit("\\t"))


def unescape_content(c, unescape_tabs: bool = True) -> Column:
    """Undo :func:`escape_content` (as far as a lossy code allows).

    ``unescape_tabs=False`` keeps the tab code in the text, as the original
    tool does.
    """
    out = F.replace(as_col(c), F.lit("\\n"), F.lit("\n"))
    return F.replace(out, F.lit("\\t"), F.lit("\t")) if unescape_tabs else out


def strip_quoted_text(c) -> Column:
    """Delete quoted lines (``> ...``); the empty line stays."""
    return F.regexp_replace(as_col(c), QUOTED_LINE, "")


def strip_quote_header(c, lenient: bool = False) -> Column:
    """Delete ``On <date>, <name> wrote:`` lines.

    The literal rule wants a blank before "On"; ``lenient=True`` makes it optional.
    """
    return F.regexp_replace(as_col(c), QUOTE_HEADER_LENIENT if lenient else QUOTE_HEADER, "")
