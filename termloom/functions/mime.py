"""MIME decoding as Arrow UDFs, for the messages that need it.

Only multipart or transfer-encoded bodies and headers with ``=?`` are decoded in
Python; callers pass null for every other row, so those rows cost no transfer.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


# encoded words, and such as follow them after nothing but white space, which does not count
_WORD = r"=\?[^?\s]+\?[bqBQ]\?[^?]*\?="
_WORDS = re.compile(rf"{_WORD}(?:\s+{_WORD})*")


def _decoded_header(value: str) -> str:
    from email.header import decode_header, make_header

    def decode(found: re.Match) -> str:
        try:
            return str(make_header(decode_header(found.group())))
        except Exception:
            return found.group()

    return _WORDS.sub(decode, value)


def _text_parts(message: str, coding: str) -> list[dict[str, str]] | None:
    """Text parts of a message in order, transfer encoding and charset undone.

    ``coding`` gives back the bytes that the message was read from.
    """
    from email import message_from_bytes, policy

    try:
        parsed = message_from_bytes(message.encode(coding, "surrogateescape"), policy=policy.compat32)
        parts = []
        for part in parsed.walk():
            if part.is_multipart() or part.get_content_maintype() != "text":
                continue
            raw = part.get_payload(decode=True) or b""
            charset = part.get_content_charset("utf-8")
            try:
                text = raw.decode(charset, "replace")
            except LookupError:
                text = raw.decode("utf-8", "replace")
            text = text.replace("\r\n", "\n").replace("\r", "\n")
            parts.append({"ctype": part.get_content_type(), "text": text})
        return parts
    except Exception:
        return None


def decode_words(header) -> Column:
    """RFC 2047 encoded words to text; null in, null out.

    Declared not to be deterministic, so that no optimizer rule moves it into a generator or
    filter, where Python cannot be called.
    """

    @F.arrow_udf("string")
    def decode(arr: pa.Array) -> pa.Array:
        return pa.array([None if v is None else _decoded_header(v) for v in arr.to_pylist()], pa.string())

    return decode.asNondeterministic()(header)


def text_parts(message, coding: str = "utf-8") -> Column:
    """array<struct<ctype,text>> of a MIME message; null if it cannot be decoded.

    ``coding`` is what the message's bytes have been read as.
    """

    @F.arrow_udf("array<struct<ctype:string,text:string>>")
    def decode(arr: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("ctype", pa.string()), ("text", pa.string())]))
        return pa.array([None if v is None else _text_parts(v, coding) for v in arr.to_pylist()], kind)

    return decode(message)


def decoded_text(raw, charset) -> Column:
    """Bytes to text by the name of any charset that Python knows; UTF-8 for others."""

    @F.arrow_udf("string")
    def decode(data: pa.Array, names: pa.Array) -> pa.Array:
        out = []
        for v, name in zip(data.to_pylist(), names.to_pylist(), strict=True):
            if v is None:
                out.append(None)
                continue
            try:
                out.append(v.decode(name, "replace"))
            except LookupError:
                out.append(v.decode("utf-8", "replace"))
        return pa.array(out, pa.string())

    return decode(raw, charset)
