"""Licence texts in documents by Dice coefficient over word bigrams, in DataFrame functions.

Notices are compared with whole lines. Whole licence texts, headers, and notices that are wrapped
are compared with windows of a text's words, however these are cut into lines.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.let import let

THRESHOLD = 0.8

# fixed values: notices of one line or paragraph
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files (the \"Software\"), to deal in the Software without restriction,"
        " including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,"
        " and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,"
        " subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial"
        " portions of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation; either version 2 of the License,"
        " or (at your option) any later version.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation, either version 3 of the License,"
        " or (at your option) any later version.",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or"
        " promote products derived from this software without specific prior written permission.",
    ],
    "BSD-2-Clause": [
        "Licensed under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met:",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all"
        " copies.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
    ],
}


def whole_texts() -> dict[str, list[str]]:
    """Published licence texts and headers, from the files next to this module."""
    out: dict[str, list[str]] = {}
    for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        out.setdefault(path.stem.removesuffix(".header"), []).append(path.read_text(encoding="utf-8"))
    return out


def normal(text: Column) -> Column:
    """Lower case, every run of signs that are neither letters nor digits one space."""
    return F.btrim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _pairs(words: Column) -> Column:
    """All pairs of neighbours."""
    return F.zip_with(
        F.slice(words, 1, F.size(words) - 1),
        F.slice(words, 2, F.size(words) - 1),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )


def bigrams(words: Column) -> Column:
    """Distinct pairs of neighbours; a single word stands alone."""
    return F.when(F.size(words) > 1, F.array_distinct(_pairs(words))).otherwise(words)


def _template_column(templates: list[tuple[str, dict[str, int]]]) -> Column:
    """The templates as one constant of (name, number of bigrams, bigrams)."""
    return F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.lit(len(g)).alias("n"), F.split(F.lit("|".join(g)), "[|]").alias("grams"))
            for name, g in templates
        ]
    )


class Grams(dict):
    """Bigrams of a template and their hashes; the first and the last few as they follow each other."""

    def __init__(self, grams: list[str], hashes: list[int], lead: list[str], tail: list[str]) -> None:
        super().__init__(zip(grams, hashes, strict=True))
        self.lead, self.tail = lead, tail


EDGE = 3  # bigrams


def _template_grams(spark: SparkSession, templates: dict[str, list[str]]) -> list[tuple[str, Grams]]:
    """(name, bigrams and their hashes) of every template."""
    flat = [(name, text) for name, texts in templates.items() for text in texts]
    if not flat:
        return []
    rows = spark.createDataFrame(flat, "name string, text string")
    words = F.split(normal(F.col("text")), " ")
    rows = rows.select("name", bigrams(words).alias("grams"), _pairs(words).alias("pairs"))
    rows = rows.select("name", "grams", F.transform("grams", lambda g: F.hash(g)).alias("hashes"), "pairs")
    return [(r.name, Grams(r.grams, r.hashes, r.pairs[:EDGE], r.pairs[-EDGE:])) for r in rows.collect()]


def _one_of(gram: Column, grams: dict[str, int]) -> Column:
    """Whether a bigram is one of these, by a constant hash table; bigrams are letters, digits and spaces.

    The table is one string that the optimizer splits: a list of constants takes it very long.
    """
    size = 8 * len(grams) or 1
    buckets = [""] * size
    for g, h in grams.items():
        buckets[h % size] += f"|{g}|"
    own = F.get(F.split(F.lit("\n".join(buckets)), "\n"), F.pmod(F.hash(gram), F.lit(size)))
    return let(own, lambda b: (b != "") & F.contains(b, F.concat(F.lit("|"), gram, F.lit("|"))))


def _scarce(grams: dict[str, int], threshold: float) -> dict[str, int]:
    """Bigrams of a template of which every text at the threshold has one.

    Sets of a and b pairs share at least a * threshold / (2 - threshold) of the a. Long pairs are
    taken, as they are scarce elsewhere.
    """
    spare = int(len(grams) * (2 - 2 * threshold) / (2 - threshold) + 1e-9)
    return {g: grams[g] for g in sorted(grams, key=lambda g: (-len(g), g))[: spare + 1]}


def _best(grams: Column, templates: Column, threshold: float) -> Column:
    """(-dice, name, -common pairs) of the best template, null below the threshold; ties go to the smaller name.

    The coefficient of sets of a and b pairs is at most 2 min(a, b) / (a + b), so templates
    beyond these sizes are not compared.
    """
    n = F.size(grams)
    low, high = F.lit(threshold / (2 - threshold)), F.lit((2 - threshold) / threshold)
    like = F.filter(templates, lambda t: (n >= t["n"] * low - 1e-9) & (n <= t["n"] * high + 1e-9))
    scored = F.transform(
        like,
        lambda t: let(
            F.size(F.array_intersect(grams, t["grams"])),
            lambda c: F.struct((-2.0 * c / (n + t["n"])).alias("less"), t["name"].alias("name"), (-c).alias("rank")),
        ),
    )
    return F.array_min(F.filter(scored, lambda s: s["less"] <= -threshold))


def _segments(places: Column, least: Column, drop: Column, threshold: float) -> Column:
    """(first, last) place of runs that may be a template, from the places of its bigrams.

    A place counts 2 - threshold, a bigram between places -threshold: what is at the threshold
    is positive. A run ends where its sum is negative, or by ``drop`` below its highest, and goes
    to the highest. Runs of fewer places than ``least`` are left out.
    """

    def ended(s: Column) -> Column:
        run = F.array(F.struct(s["first"].alias("first"), s["last"].alias("last")))
        long_enough = (s["first"] >= 0) & (s["last"] - s["first"] + 1 >= least)
        return F.when(long_enough, F.concat(s["done"], run)).otherwise(s["done"])

    def step(s: Column, at: Column) -> Column:
        def added(now: Column) -> Column:
            new, total = now["new"], now["total"]
            return F.struct(
                F.when(new, ended(s)).otherwise(s["done"]).alias("done"),
                at.alias("at"),
                F.when(new, at).otherwise(s["first"]).alias("first"),
                F.when(new | (total > s["top"]), at).otherwise(s["last"]).alias("last"),
                total.alias("sum"),
                F.when(new, total).otherwise(F.greatest(s["top"], total)).alias("top"),
            )

        def judged(fallen: Column) -> Column:
            new = (s["first"] < 0) | (fallen < 0) | (fallen < s["top"] - drop)
            total = F.when(new, 0.0).otherwise(fallen) + (2.0 - threshold)
            return let(F.struct(new.alias("new"), total.alias("total")), added)

        return let(s["sum"] - threshold * (at - s["at"] - 1), judged)

    start = F.expr(
        "struct(cast(array() as array<struct<first: int, last: int>>) as done, -1 as at, -1 as first, -1 as last,"
        " 0.0D as sum, 0.0D as top)"
    )
    return F.aggregate(places, start, step, ended)


def _in_a_row(places: Column, grams: list[str], end: int) -> Column:
    """Where these bigrams follow each other; the place of the first, or with ``end`` of one further on."""

    def here(p: Column, i: Column) -> Column:
        follows = p["gram"] == grams[0]
        for k, gram in enumerate(grams[1:], 1):
            q = F.get(places, i + k)
            follows = follows & (q["gram"] == gram) & (q["at"] == p["at"] + k)
        return follows

    return F.transform(F.filter(places, here), lambda p: p["at"] + end)


def _windows(notices: list[tuple[str, Grams]], texts: list[tuple[str, Grams]], threshold: float) -> Column:
    """Hits of the templates among the windows of a text's words, those of notices only over a line's end.

    Windows are runs of the template's bigrams, and what lies from where it begins to where it next
    ends: so licences that follow each other are told apart, also the same one twice. No gap in a window at the threshold is longer than (2 / threshold - 2) of the template's
    bigrams; runs that also end at shorter gaps tell copies apart that are close together.
    """

    def places_of(name: str, known: dict[str, int], in_a_line: bool) -> Column:
        some = F.exists("scarce", lambda g: _one_of(g, _scarce(known, threshold)))
        own = F.filter("places", lambda p: _one_of(p["gram"], known))
        return let(
            F.when(some, own),
            lambda o: F.struct(
                F.lit(name).alias("name"),
                F.lit(len(known)).alias("n"),
                F.lit(in_a_line).alias("in_a_line"),
                o.alias("own"),
                _in_a_row(o, known.lead, 0).alias("opens"),
                _in_a_row(o, known.tail, len(known.tail) - 1).alias("closes"),
            ),
        )

    def hit(t: Column, run: Column) -> Column:
        inside = F.filter(t["own"], lambda p: (p["at"] >= run["first"]) & (p["at"] <= run["last"]))
        common = F.size(F.array_distinct(F.transform(inside, lambda p: p["gram"])))
        size = F.size(F.array_distinct(F.slice("grams", run["first"] + 1, run["last"] - run["first"] + 1)))
        return let(
            common,
            lambda c: F.struct(
                (-c).alias("rank"),
                (-2.0 * c / (size + t["n"])).alias("less"),
                t["name"].alias("name"),
                F.get("line_of", run["first"]).alias("line"),
                run["first"].alias("first"),
                (run["last"] + 1).alias("last"),
            ),
        )

    def of(t: Column) -> Column:
        least, drop = t["n"] * (threshold / (2 - threshold)) - 1e-9, t["n"] * (2 - 2 * threshold)
        runs = let(
            F.transform(t["own"], lambda p: p["at"]),
            lambda at: F.array_union(_segments(at, least, drop, threshold), _segments(at, least, drop / 4, threshold)),
        )
        from_end_to_end = F.transform(
            t["opens"],
            lambda s: F.struct(s.alias("first"), F.array_min(F.filter(t["closes"], lambda e: e > s)).alias("last")),
        )
        runs = F.array_union(runs, F.filter(from_end_to_end, lambda r: r["last"] - r["first"] + 1 >= least))
        over = lambda r: t["in_a_line"] | (F.get("line_of", r["first"]) < F.get("line_of", r["last"] + 1))
        return F.filter(F.transform(F.filter(runs, over), lambda r: hit(t, r)), lambda h: h["less"] <= -threshold)

    found = [places_of(*t, False) for t in notices] + [places_of(*t, True) for t in texts]
    found = F.filter(F.array(*found), lambda t: F.size(t["own"]) > 0)
    return F.flatten(F.transform(found, of))


_HITS = "array<struct<rank: int, less: double, name: string, line: int, first: int, last: int>>"


def _apart(hits: Column) -> Column:
    """Of hits that overlap, the one that shares the most bigrams with its template, then the best."""
    return F.aggregate(
        F.array_sort(hits),
        F.expr(f"cast(array() as {_HITS})"),
        lambda kept, h: F.when(
            F.exists(kept, lambda k: (k["first"] <= h["last"]) & (k["last"] >= h["first"])), kept
        ).otherwise(F.concat(kept, F.array(h))),
    )


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, list[str]] | None = None,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    whole: dict[str, list[str]] | None = None,
    all_hits: bool = False,
) -> DataFrame:
    """(id_col, n_lines, n_hits, license, dice, line) for every row of ``docs``.

    Every line of the text is compared with the templates, and every window of its words with
    the templates, if it goes over a line's end, and with the ``whole`` texts. A window ends where
    it is most like a template. Of hits that overlap, the one that shares the most bigrams with its
    template counts (ties: the higher coefficient, the smaller name, the earlier one), so a
    licence is not named after one of its lines. Without ``templates``, both are the given ones.

    ``n_lines`` are the lines with a letter or digit, ``n_hits`` the hits at or above the
    threshold; the other columns tell of the best of them (ties: the smaller name, then the
    earlier line, counted from 0; a window has the line it begins in), and are null if there
    is none.

    With ``all_hits``, the last column ``hits`` has every hit as (license, dice, line), by line.

    A null or empty text has no lines. Repeated rows, ids and null ids are judged by their
    own text. An empty table gives an empty table; other columns are not read. No templates:
    no hits.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    notices = _template_grams(spark, TEMPLATES if templates is None else templates)
    texts = _template_grams(spark, whole_texts() if whole is None and templates is None else whole or {})
    rows = rows.select("id", F.transform(F.split("text", "\n"), normal).alias("lines"))
    rows = rows.withColumn("words", F.split(F.array_join(F.filter("lines", lambda x: x != ""), " "), " "))
    rows = rows.select("id", "lines", "words", _pairs(F.col("words")).alias("grams"))
    none = F.expr(f"cast(array() as {_HITS})")
    scarce = {g: h for _, known in notices + texts for g, h in _scarce(known, threshold).items()}
    rows = rows.withColumn("scarce", F.filter("grams", lambda g: _one_of(g, scarce)))
    # without one of these bigrams there is no hit, unless a template is one word
    some = F.lit(any(" " not in g for _, known in notices for g in known)) | (F.size("scarce") > 0)
    rows = rows.select(
        "*",
        some.alias("some"),
        F.when(some, F.transform("grams", lambda g, i: F.struct(i.alias("at"), g.alias("gram")))).alias("places"),
        F.when(
            some,
            F.flatten(
                F.transform("lines", lambda x, i: F.array_repeat(i, F.when(x == "", 0).otherwise(F.size(F.split(x, " ")))))
            ),
        ).alias("line_of"),
    )

    constant = _template_column(notices) if notices else None
    least = min((len(known) for _, known in notices), default=0) * threshold / (2 - threshold)

    def judged(line: Column, i: Column) -> Column:
        def of(w: Column) -> Column:
            # too few words can't make enough pairs
            return F.when(F.size(w) >= least, let(bigrams(w), lambda g: _best(g, constant, threshold)))

        first = F.array_position("line_of", i).cast("int") - 1
        return let(
            F.split(line, " "),
            lambda w: let(
                of(w),
                lambda b: F.when(
                    b["name"].isNotNull(),
                    F.struct(
                        b["rank"].alias("rank"),
                        b["less"].alias("less"),
                        b["name"].alias("name"),
                        i.alias("line"),
                        first.alias("first"),
                        (first + F.size(w) - 1).alias("last"),
                    ),
                ),
            ),
        )

    of_lines = F.filter(F.transform("lines", judged), lambda h: h.isNotNull()) if notices else none
    many = [(name, known) for name, known in notices if len(known) > 1]
    of_windows = _windows(many, texts, threshold) if many or texts else none
    hits = F.when(F.col("some"), _apart(F.concat(of_lines, of_windows))).otherwise(none)
    rows = rows.select("id", F.size(F.filter("lines", lambda x: x != "")).alias("n_lines"), hits.alias("hits"))
    best = F.array_min(F.transform("hits", lambda h: F.struct(h["less"], h["name"], h["line"])))
    every = F.transform(
        F.array_sort(F.transform("hits", lambda h: F.struct(h["line"], h["first"], h["name"], h["less"]))),
        lambda h: F.struct(
            h["name"].alias("license"), F.round(-h["less"], 6).alias("dice"), h["line"].cast("long").alias("line")
        ),
    )
    rows = rows.select("id", "n_lines", F.size("hits").alias("n_hits"), best.alias("best"), every.alias("hits"))
    return rows.select(
        F.col("id").alias(id_col),
        F.col("n_lines").cast("long").alias("n_lines"),
        F.col("n_hits").cast("long").alias("n_hits"),
        F.col("best.name").alias("license"),
        F.round(-F.col("best.less"), 6).alias("dice"),
        F.col("best.line").cast("long").alias("line"),
        *(["hits"] if all_hits else []),
    )
