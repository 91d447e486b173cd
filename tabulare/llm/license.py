"""Licence statements by the Dice coefficient of word bigrams with templates. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_SCORE = 0.8
SENTENCE_END = r"[.!?][\x20\x09-\x0D]+"

# Customary statements and opening paragraphs of public licences, by SPDX name.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
        "your option) any later version.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "This work is released under the Creative Commons CC0 1.0 Universal Public Domain Dedication."),
    ("BSD-3-Clause", "Released under the 3-Clause BSD License."),
    ("BSD-2-Clause", "Released under the 2-Clause BSD License."),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-or-later"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL-2.1", "SPDX-License-Identifier: LGPL-2.1-or-later"),
    ("LGPL-3.0", "SPDX-License-Identifier: LGPL-3.0-or-later"),
    ("AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0-or-later"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("CC-BY-4.0", "SPDX-License-Identifier: CC-BY-4.0"),
]


def word_list(text: str) -> list[str]:
    cleaned = "".join(c if c.isascii() and c.isalnum() else " " for c in text)
    return cleaned.lower().split()


def bigrams(words: list[str]) -> list[str]:
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def size_bounds(size: int, score: float) -> tuple[int, int]:
    """The set sizes that can reach the score with a set of this size: Dice is at most 2 * smaller / (smaller + larger)."""
    return math.ceil(size * score / (2 - score) - 1e-9), math.floor(size * (2 - score) / score + 1e-9)


def key_bigrams(grams: list[str], score: float) -> list[str]:
    """Bigrams of a template of which every set that reaches the score holds one.

    Such a set shares at least the lower size bound, so it misses no more than
    the others; of one bigram more than that it must hold some. Those with the
    longest words are taken, which are the rarest in other text.
    """
    missed = len(grams) - size_bounds(len(grams), score)[0]
    return sorted(grams, key=lambda gram: (-max(map(len, gram.split())), gram))[: missed + 1]


def scan_licenses(
    docs: DataFrame,
    templates: list[tuple[str, str]] | None = None,
    min_score: float = MIN_SCORE,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per document: ``doc_id``, ``matches`` (name and best score of each licence found, best first).

    Units are every line, every sentence, and every paragraph between empty
    lines of the whole text. Each is normalised to words of a-z and 0-9 and
    compared as a set of word bigrams; it counts for the template with the
    highest score, at a tie for the larger name. A unit whose number of bigrams
    is out of the bounds of a template is not compared with it, nor is one
    looked at whose number of words, which is above that of its bigrams, is
    below all bounds. A text that has none of the bigrams without which no
    template can be reached is not cut into units. Templates are a parameter,
    held in the plan. Null and empty texts match nothing; repeated rows and
    null keys each give a row; other columns are not read. No shuffle.
    """
    known = [(name, bigrams(word_list(body))) for name, body in (TEMPLATES if templates is None else templates)]
    known = [(name, grams, *size_bounds(len(grams), min_score)) for name, grams in known if grams]
    value = F.coalesce(F.col(text), F.lit(""))
    keys = sorted({gram.replace(" ", "[^A-Za-z0-9]+") for _, grams, *_ in known for gram in key_bigrams(grams, min_score)})
    possible = F.col("_t").rlike(f"(?i)(?<![A-Za-z0-9])(?:{'|'.join(keys)})(?![A-Za-z0-9])") if keys else F.lit(False)
    lowest = min((low for *_, low, _ in known), default=1)

    def words(unit: Column) -> Column:
        return F.split(F.lower(F.trim(F.regexp_replace(unit, "[^A-Za-z0-9]+", " "))), " ", -1)

    def grams_of(unit: Column) -> Column:
        return F.array_distinct(
            F.transform(F.slice(unit, 2, F.size(unit) - 1), lambda word, i: F.concat_ws(" ", F.get(unit, i), word))
        )

    def found(grams: Column) -> Column:
        def match(name: str, template: list[str], low: int, high: int) -> Column:
            size = F.size(grams)
            both = F.size(F.array_intersect(grams, F.array(*map(F.lit, template))))
            score = both * 2.0 / (size + len(template))
            return F.when(
                size.between(low, high) & (score >= min_score),
                F.struct(score.alias("score"), F.lit(name).alias("name")),
            )

        none = F.lit(None).cast("struct<score: double, name: string>")
        return F.array_max(F.array(none, *(match(*template) for template in known)))

    def above(other: Column, one: Column) -> Column:
        return (other["name"] == one["name"]) & (other["score"] > one["score"])

    units = F.concat(
        F.split("_t", "\n", -1), F.split("_t", SENTENCE_END, -1), F.split("_t", r"\n[\x20\x09-\x0D]*\n", -1)
    )
    cut = F.when(possible, F.array_distinct(units)).otherwise(F.array())
    return (
        docs.select(F.col(key).cast("bigint").alias("doc_id"), value.alias("_t"))
        .withColumn("_u", F.filter(F.transform(cut, words), lambda u: F.size(u) > lowest))
        .withColumn("_g", F.transform("_u", grams_of))
        .withColumn("_m", F.array_compact(F.transform("_g", found)))
        .withColumn("_d", F.sort_array(F.array_distinct("_m"), asc=False))
        .select("doc_id", F.filter("_d", lambda m: ~F.exists("_d", lambda o: above(o, m))).alias("matches"))
    )
