"""License scans: text units against licence templates by the Dice coefficient over word bigrams.

A unit is a line or a paragraph (between blank lines) of a text, normalised to
lower-case words. With ``A`` and ``B`` the sets of word bigrams of unit and
template, Dice is ``2 |A & B| / (|A| + |B|)``. At threshold ``t`` two exact
bounds spare nearly all comparisons: ``|A|`` lies between ``|B| t / (2 - t)``
and ``|B| (2 - t) / t``; and as at least ``t / 2 (|A| + |B|)`` bigrams are
shared, a unit lacking all of a template's first few bigrams (as many as can
be missing, and one) cannot match.

DataFrame functions only; everything up to the last grouping by document is
local to a row.
"""

from math import ceil, floor

from pyspark.sql import Column, DataFrame, functions as F

from vitals.llm.common import plain_text

THRESHOLD = 0.8

# Public licence notices, as they are worded.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
        " Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions"
        " of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
        " with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is"
        " distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version.",
    ],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met:",
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
    "CC0-1.0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright to this work."],
    "Proprietary": ["All rights reserved."],
}


def bigram_set(text: str) -> list[str]:
    """Distinct word bigrams in order, as the columns below compute them."""
    words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def least_size(size: int, threshold: float) -> int:
    return ceil(round(size * threshold / (2 - threshold), 9))


def most_size(size: int, threshold: float) -> int:
    return floor(round(size * (2 - threshold) / threshold, 9))


def telling(bigrams: list[str], threshold: float) -> list[str]:
    """Bigrams of which any matching unit has one: those with the longest words, as many as needed."""
    shared = ceil(round(threshold / 2 * (least_size(len(bigrams), threshold) + len(bigrams)), 9))
    return sorted(bigrams, key=lambda b: (-min(map(len, b.split())), b))[:len(bigrams) - shared + 1]


def words_of_unit(unit: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(unit), r"[^\p{L}\p{N}]+", " "))
    return F.split(plain, " ")


def scan(docs: DataFrame, doc_id="doc_id", text="text", templates=None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document and licence found: ``doc_id, license, dice`` (the best) and ``units``, the matching ones.

    Rows that repeat an id are one document; repeated lines of a row count
    once. Null and empty texts, and units under two words, match nothing; a
    null id is kept as it is. No templates or an empty table give no rows.
    Texts of any length are read whole; other columns are not looked at.
    """
    known = [(name, bigram_set(t)) for name, texts in (TEMPLATES if templates is None else templates).items() for t in texts]
    known = [(name, b) for name, b in known if b]
    if not known:
        return docs.limit(0).select(F.col(doc_id).alias("doc_id"), F.lit("").alias("license"), F.lit(0.0).alias("dice"), F.lit(0).cast("long").alias("units"))
    sizes = [len(b) for _, b in known]
    least, most = min(least_size(s, threshold) for s in sizes), max(most_size(s, threshold) for s in sizes)
    tell = sorted({b for _, bigrams in known for b in telling(bigrams, threshold)})

    whole = plain_text(text)
    units = F.array_distinct(F.concat(F.split(whole, "\n"), F.split(whole, r"\n[ \t\r]*\n")))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.explode(units).alias("unit"))
    # A generator between keeps filters from repeating what they are over.
    rows = rows.select("doc_id", F.inline(F.array(F.struct(words_of_unit(F.col("unit")).alias("words"))))).filter(F.size("words") > least)
    pairs = F.zip_with(F.slice("words", 1, F.size("words") - 1), F.slice("words", 2, F.size("words")), lambda a, b: F.concat(a, F.lit(" "), b))
    rows = rows.select("doc_id", F.inline(F.array(F.struct(F.array_distinct(pairs).alias("bigrams")))))
    rows = rows.filter(F.size("bigrams").between(least, most) & F.arrays_overlap("bigrams", F.array(*map(F.lit, tell))))
    candidates = F.array(*[
        F.struct(F.lit(name).alias("license"), F.lit(len(b)).alias("size"), F.array(*map(F.lit, b)).alias("template")) for name, b in known])
    size = F.size("bigrams")
    near = F.filter(candidates, lambda c: size.between(
        F.ceil(F.round(c["size"] * F.lit(threshold / (2 - threshold)), 9)), F.floor(F.round(c["size"] * F.lit((2 - threshold) / threshold), 9))))
    rows = rows.select("doc_id", "bigrams", F.explode(near).alias("c"))
    dice = F.lit(2.0) * F.size(F.array_intersect("bigrams", "c.template")) / (F.size("bigrams") + F.col("c.size"))
    best = rows.select("doc_id", F.col("c.license").alias("license"), dice.alias("dice"), "bigrams").filter(F.col("dice") >= threshold)
    best = best.groupBy("doc_id", "license", "bigrams").agg(F.max("dice").alias("dice"))
    return best.groupBy("doc_id", "license").agg(F.max("dice").alias("dice"), F.count("*").alias("units"))
