"""Licence scan by canonical digests, in DataFrame functions alone.

A text is brought to a canonical form: lower case, equivalent spellings (first
"licence" to "license", "(c)" and the sign to "copyright", web addresses
without their scheme), lines of copyright notices dropped, everything but
letters and digits to one space. The SHA-256 of the form is looked up among the
digests of known licences by an equi join; equal digests are equal texts. Looked
up are whole documents, their single lines, and all runs of lines, whatever the
line breaks, that begin with the first characters of a known text and have the
length of one; a text is never matched in part of a line.

The known texts are a parameter: a table (license_id, text) of any size; its
digests are made by the same functions. Without one, the full texts in
``license_texts``, with their usual titles, and short published notices are used.
A name inside a text (the University's in the first BSD licence) is part of it.
Known digests are broadcast after their number is checked, else the join is
shuffled. The beginnings are a set of at most as many strings: where there are
more, shorter ones.

What cannot match is not digested: a document without a word of every known text
(a small set of words, one of which is in each), a unit whose length no known
text has. Rules run only over texts that hold what they look for. The places at
which lines end are numbers; a run's are found by intersecting the places where
one of known length would end with those where lines do, so a document of many
lines that all begin like a licence takes time in proportion to its length. Only
matched units are shuffled, and one small row per document.

Defined cases: null and empty texts and texts that are only copyright lines have
no canonical form and match nothing; null ids and repeated rows are answered row
by row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.session import materialize

# Published short notices, under their SPDX identifiers.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("reserved", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
# Titles that stand above the texts of ``license_texts``.
TITLES = {
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "BSD 0-Clause License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License", "BSD 2-Clause \"Simplified\" License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License", "BSD License", "The BSD License",
                     "BSD 3-Clause \"New\" or \"Revised\" License", "New BSD License"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng license"),
}
ENDS = ("END OF TERMS AND CONDITIONS", "Exhibit A - Source Code Form License Notice")  # of the terms, before an appendix
RESERVED = "All rights reserved.\n"
# Equivalent spellings, applied in this order to lower-case text, each to its canonical form.
SPELLINGS = (
    (r"\(c\)|©", "copyright "),
    (r"https?://(www\.)?", ""),
    (r"\blicence", "license"),
    (r"\blicencing\b", "licensing"),
    (r"\bsub-?licen[cs]e", "sublicense"),
    (r"\bnon-?commercial", "noncommercial"),
    (r"\bshare-?alike", "sharealike"),
    (r"\bversion ([0-9])", "$1"),
    (r"\bv\.? ?([0-9])", "$1"),
    (r"\borganis", "organiz"),
    (r"\bauthoris", "authoriz"),
    (r"\bmerchantib", "merchantab"),
)
COPYRIGHT_LINE = r"(^|\n)[^a-z0-9\n]*copyright\b[^\n]*[0-9]{4}[^\n]*"
# A line of a notice without a year; "copyright" may also begin a line of the terms, before one of these words.
TERMS = (r"holders?|owners?|ownership|notices?|laws?|licen[cs]es?|licensors?|statements?|interests?|disclaimers?|permissions?|"
         r"treat(?:y|ies)|doctrines?|protections?|rights?|restrictions?|infringements?|patents?|lines?|the software|act|and|or|"
         r"on|of|in|is|are|if|to|for|as|that|this|which|with|under|does|may|can|resulting|also|those|it|a|an")
YEARLESS_LINE = (r"(^|\n)[^a-z0-9\n]*(?:copyright[ \t:]+(?!(?:" + TERMS + r")\b)(?:[\p{L}<\[{©]|\(c\))|©[ \t]*\p{L})[^\n]*")
BEGINNING = 16  # characters by which lines that may begin a known text are found
BROADCAST_ROWS = 100_000  # known digests are sent to every task up to this checked number


# What a text holds where one of ``SPELLINGS`` can apply, in the same order (none: always applied).
HOLDS = (("(c)", "©"), ("://",), ("licenc",), ("licencing",), ("sub",), ("commercial",), ("alike",), ("version ",), (),
         ("organis",), ("authoris",), ("merchantib",))
ABOUT_COPYRIGHT = ("copyright", "(c)", "©")


def replaced(text: Column, words: tuple[str, ...], pattern: str, form: str) -> Column:
    """``pattern`` replaced by ``form`` in a text that holds one of the words (in any, if none are given).

    The text is bound to a variable: named thrice, it would be computed thrice at every rule.
    """
    if not words:
        return F.regexp_replace(text, pattern, form)

    def rule(t: Column) -> Column:
        held = reduce(Column.__or__, [F.contains(t, F.lit(w)) for w in words])
        return F.when(held, F.regexp_replace(t, pattern, form)).otherwise(t)

    return F.get(F.transform(F.array(text), rule), F.lit(0))


def spelled(text: Column) -> Column:
    """Lower-case text in its canonical spelling, without copyright lines; no rule reaches across a line."""
    out = replaced(F.lower(F.coalesce(text.cast("string"), F.lit(""))), ABOUT_COPYRIGHT, YEARLESS_LINE, "$1")
    for (pattern, form), words in zip(SPELLINGS, HOLDS):
        out = replaced(out, words, pattern, form)
    return replaced(out, ABOUT_COPYRIGHT[:1], COPYRIGHT_LINE, "$1")


def spaced(text: Column) -> Column:
    """Everything but letters, digits and line breaks as one space."""
    return F.regexp_replace(text, r"[^\p{L}\p{N}\n]+", " ")


def one_line(form: Column) -> Column:
    return F.trim(F.regexp_replace(form, "[ \n]+", " "))


def digest(form: Column) -> Column:
    """Digest of a canonical form; null if it is empty."""
    return F.when(F.length(form) > 0, F.sha2(form, 256))


def known_forms(texts: DataFrame) -> DataFrame:
    """(form, license_id) of the known texts: their canonical forms on one line, those without one left out."""
    return texts.select(one_line(spaced(spelled(F.col("text")))).alias("form"), "license_id").where(
        "license_id is not null and length(form) > 0")


def known_digests(forms: DataFrame) -> DataFrame:
    """(known, license_id): the smallest identifier where texts agree in canonical form."""
    return forms.groupBy(digest(F.col("form")).alias("known")).agg(F.min("license_id").alias("license_id"))


def default_texts() -> list[tuple[str, str]]:
    """(license_id, text): notices, and the full texts with and without a title, "all rights reserved" and an appendix."""
    out = list(NOTICES)
    for file in sorted(resources.files(__package__).joinpath("license_texts").iterdir(), key=lambda f: f.name):
        name, text = file.name.removesuffix(".txt"), file.read_text("utf-8")
        bodies = [text]
        for end in ENDS:
            if end in text:
                bodies += [text[:text.index(end)], text[:text.index(end) + len(end)]]
        if name.startswith("BSD-"):  # points instead of numbers; holder or owner
            bodies += [re.sub(r"(?m)^[0-9]\. ", "* ", b) for b in bodies]
            bodies += [re.sub(r"COPYRIGHT\s+HOLDER OR", "COPYRIGHT OWNER OR", b) for b in bodies]
        for body in bodies:
            for head in ("", *(t + "\n" for t in TITLES.get(name, ()))):
                out.append((name, head + body))
                if name in TITLES:
                    out.append((name, head + RESERVED + body))
    return out


def literal_table(spark: SparkSession, names: tuple[str, ...], rows: list) -> DataFrame:
    return spark.range(1).select(F.inline(F.array(*(
        F.struct(*(F.lit(v).alias(n) for n, v in zip(names, r))) for r in rows))))


def known_beginnings(forms: DataFrame, limit: int) -> tuple[int, list[str], list[int]]:
    """Characters of a beginning, the distinct beginnings (at most ``limit``, or one character), the forms' bytes."""
    begins = forms.select(F.substring("form", 1, BEGINNING).alias("begin"))
    lengths = sorted(r["n"] for r in forms.select(F.octet_length("form").alias("n")).distinct().collect())
    width = min([BEGINNING, *(r["n"] for r in forms.select(F.min(F.length("form")).alias("n")).collect() if r["n"])])
    while True:
        found = begins.select(F.substring("begin", 1, width).alias("begin")).distinct()
        found = (found.limit(limit + 1) if width > 1 else found).collect()  # one character: no more than there are
        if len(found) <= limit or width <= 1:
            return width, sorted(r["begin"] for r in found), lengths
        width -= 1


def telling_words(forms: DataFrame, limit: int) -> list[str]:
    """Words of which each known text has one, the most frequent first; none where there are over ``limit`` texts."""
    rows = forms.select("form").distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        return []
    open_forms, words = [set(r["form"].split(" ")) for r in rows], []
    while open_forms:
        held = Counter(w for f in open_forms for w in f)
        best = max(held, key=lambda w: (held[w] * min(len(w), 6), len(w), w))  # short words are in most documents
        words.append(best)
        open_forms = [f for f in open_forms if best not in f]
    return words


def scan_licenses(df: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id",
                  text_col: str = "text", limit: int = BROADCAST_ROWS) -> DataFrame:
    """id, document_license, line_licenses, n_license_lines: one row per input row.

    ``document_license`` is that of the whole text (null if unknown),
    ``line_licenses`` the sorted distinct licences of its lines and runs of
    lines, joined by commas (empty if none), ``n_license_lines`` how many lines
    are one or belong to one.
    """
    spark = df.sparkSession
    forms = known_forms(known if known is not None else literal_table(spark, ("license_id", "text"), default_texts()))
    if known is None:  # few: made once
        forms = literal_table(spark, ("form", "license_id"), forms.distinct().collect())
    table = known_digests(forms)
    if table.limit(limit + 1).count() <= limit:
        table = F.broadcast(table)
    width, beginnings, lengths = known_beginnings(forms, limit)
    words = telling_words(forms, limit)
    rows = df.select(F.col(id_col).alias("id__"), F.xxhash64(F.col(text_col)).alias("key__"), F.col(text_col).alias("text__"))
    found = matched_units(rows, table, width, beginnings, lengths, words)

    # lines of units, each line once: of a unit's text what no unit before it covers
    before = Window.partitionBy("row__").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.when(F.col("start") > F.col("reached"), F.col("unit")).when(F.col("stop") > F.col("reached"), F.substring(
        F.col("unit"), F.col("reached") - F.col("start") + 2, F.octet_length("unit")))  # from the line after the last
    lines = F.when(fresh.isNotNull(), F.octet_length(fresh.cast("string")) - F.octet_length(
        F.replace(fresh.cast("string"), F.lit("\n"), F.lit(""))) + 1).otherwise(0)
    in_lines = found.where("not whole").withColumn("reached", F.coalesce(F.max("stop").over(before), F.lit(-1)))
    counted = in_lines.select("row__", "id__", "key__", F.col("license_id").alias("line"), lines.alias("n"),
                              F.lit(None).cast("string").alias("document"))
    counted = counted.unionByName(found.where("whole").select(
        "row__", "id__", "key__", F.lit(None).cast("string").alias("line"), F.lit(0).alias("n"),
        F.col("license_id").alias("document")))
    by_row = counted.groupBy("row__", "id__", "key__").agg(
        F.max("document").alias("document_license"), F.sum("n").alias("n_license_lines"),
        F.array_join(F.array_sort(F.collect_set("line")), ",").alias("line_licenses"))
    known_rows = by_row.dropDuplicates(["id__", "key__"]).drop("row__").withColumnsRenamed(  # repeated rows share theirs
        {"id__": "id_f", "key__": "key_f"})
    answered = rows.select("id__", "key__").join(
        known_rows, F.col("id__").eqNullSafe(F.col("id_f")) & (F.col("key__") == F.col("key_f")), "left")
    return answered.select(F.col("id__").alias(id_col), "document_license",
                           F.coalesce("line_licenses", F.lit("")).alias("line_licenses"),
                           F.coalesce("n_license_lines", F.lit(0)).cast("long").alias("n_license_lines"))


def matched_units(rows: DataFrame, table: DataFrame, width: int, beginnings: list[str], lengths: list[int],
                  words: list[str]) -> DataFrame:
    """row__, id__, key__, start, stop, unit (binary), whole, license_id: units with a known digest, each once.

    Lines are trimmed, empty ones dropped, the others joined by a line break;
    ``start`` and ``stop`` are bytes of that text. The rows that may match are
    written once.
    """
    def telling(text: Column) -> Column:
        """The text with single spaces; null without a word that known texts have."""
        told = reduce(Column.__or__, [F.contains(text, F.lit(w)) for w in words]) if words else F.lit(True)
        return F.when(told, spaced(text))

    form = F.get(F.transform(F.array(spelled(F.col("text__"))), telling), F.lit(0))
    lines = F.filter(F.transform(F.split(form, "\n"), lambda x: F.trim(x)), lambda x: F.length(x) > 0)
    # numbered at once: a filter is not moved below the number, so the lines are made once
    texts = rows.select("id__", "key__", lines.alias("lines"), F.monotonically_increasing_id().alias("row__"))
    texts = texts.withColumn("begins", F.transform("lines", lambda x: F.substring(x, 1, width)))

    def begins_known(x: Column, i: Column) -> Column:
        """Whether the text from line ``i`` on, across line breaks, has a known beginning."""
        across = F.substring(F.array_join(F.slice("begins", i + 1, (width + 1) // 2), " "), 1, width)
        return F.when(F.length(x) >= width, x).otherwise(across).isin(beginnings)

    places = F.transform("begins", lambda x, i: F.struct(
        i.alias("line"), F.octet_length(F.get("lines", i)).alias("size"), begins_known(x, i).alias("known")))
    texts = materialize(texts.where(F.size("lines") > 0).select(
        "id__", "key__", "lines", places.alias("places"), "row__"), "license-texts")

    places = texts.select("row__", F.inline("places"))
    so_far = Window.partitionBy("row__").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    places = places.withColumn("start", F.coalesce(F.sum(F.col("size") + 1).over(so_far), F.lit(0)))
    places = places.withColumn("stop", F.col("start") + F.col("size"))
    bytes_of = F.array(*map(F.lit, lengths)).cast("array<bigint>")
    alone = places.where(F.col("size").isin(lengths)).select("row__", "line", F.col("line").alias("last"), "start", "stop")
    begun = places.where("known").select("row__", "line", "start", F.explode(bytes_of).alias("n")).select(
        "row__", "line", "start", (F.col("start") + F.col("n")).alias("stop"))
    runs = begun.join(places.select("row__", F.col("line").alias("last"), "stop"), ["row__", "stop"]).where(
        F.col("last") > F.col("line")).select("row__", "line", "last", "start", "stop")
    units = alone.unionByName(runs).withColumn("whole", F.lit(False))
    total = F.aggregate("places", F.lit(-1).cast("bigint"), lambda n, p: n + p["size"] + 1)
    entire = texts.select("row__", F.lit(0).alias("line"), (F.size("lines") - 1).alias("last"), F.lit(0).cast("bigint").alias(
        "start"), total.alias("stop"), F.lit(True).alias("whole")).where(F.col("stop").isin(lengths))
    units = units.unionByName(entire).join(texts.select("row__", "id__", "key__", "lines"), "row__")
    unit = F.array_join(F.slice("lines", F.col("line") + 1, F.col("last") - F.col("line") + 1), "\n")
    units = units.select("row__", "id__", "key__", "start", "stop", "whole", unit.alias("text"))
    units = units.withColumn("digest", digest(F.translate("text", "\n", " ")))
    return units.join(table, F.col("digest") == F.col("known")).select(
        "row__", "id__", "key__", "start", "stop", F.col("text").cast("binary").alias("unit"), "whole", "license_id")
