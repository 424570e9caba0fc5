"""Own term parsers that hold state, as table functions of SQL.

A parser is a class: one object for each task, which may load tables or keep what it has seen,
with a method that turns a text into rows. ``analyze`` lets one registered function serve any
parser: the call names it, with its options as a constant, and gets the columns it declares.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterable, Iterator
from typing import Any, Protocol

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult


class TermParser(Protocol):
    """What :func:`register_parsers` takes: options, declared columns, and rows of one text."""

    def __init__(self, **options: Any) -> None: ...

    @staticmethod
    def columns(**options: Any) -> StructType: ...

    def parse(self, text: str) -> Iterable[tuple]: ...


def register_parsers(spark: SparkSession, name: str, parsers: dict[str, type]) -> None:
    """Registers the table function ``name(text, parser[, options])``.

    ``parser`` is one of the given names and ``options`` a JSON object, both constants:
    ``select email, t.term from docs, lateral terms_of(content, 'words') t``. A null text has no
    rows. The parsers travel with the function.
    """

    def named(parser: AnalyzeArgument, options: AnalyzeArgument | None) -> tuple[type, dict]:
        if not parser.isConstantExpression or parser.value not in parsers:
            raise ValueError(f"the parser has to be a constant, one of {', '.join(sorted(parsers))}")
        if options is not None and not options.isConstantExpression:
            raise ValueError("the options of a parser have to be constant")
        return parsers[parser.value], json.loads(options.value) if options is not None and options.value else {}

    class Terms:
        @staticmethod
        def analyze(text: AnalyzeArgument, parser: AnalyzeArgument, options: AnalyzeArgument | None = None) -> AnalyzeResult:
            kind, given = named(parser, options)
            return AnalyzeResult(kind.columns(**given))

        def __init__(self) -> None:
            self.parser = None

        def eval(self, text: str | None, parser: str, options: str | None = None) -> Iterator[tuple]:
            if self.parser is None:
                self.parser = parsers[parser](**(json.loads(options) if options else {}))
            if text is not None:
                yield from self.parser.parse(text)

    for module in {__name__, *(kind.__module__ for kind in parsers.values())}:
        cloudpickle.register_pickle_by_value(sys.modules[module])
    spark.udtf.register(name, udtf(Terms))
