"""Licence scans: Dice coefficient over word bigrams (native expressions only).

Units of a text are its lines, its paragraphs and the text as a whole.  A unit
is normalised (lower case, runs of other characters than letters and digits
become one space) and compared to licence templates by the Dice coefficient of
their distinct word bigrams.  With threshold t a template of b bigrams can only
be met by units of t/(2-t) * b to (2-t)/t * b bigrams: units outside the bounds
of all templates are dropped by their word count before any bigram is made, and
each template is compared only within its own bounds.  Nothing is shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewise.functions.core import q

#: Public licence notices and short licence texts.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
        "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution."),
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."),
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def template_bigrams(text: str) -> list[str]:
    """Distinct bigrams of a template, normalised as the units are."""
    w = re.sub(r"[\W_]+", " ", text.lower()).strip().split(" ")
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:])})


def _bigrams(words: Column) -> Column:
    return F.array_distinct(F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1),
                                       lambda a, b: F.concat(a, F.lit(" "), b)))


def match_licences(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   templates: dict[str, str] | None = None, percent: int = 80) -> DataFrame:
    """One row per input row: id, units (compared ones), licences (distinct names
    met, sorted), best and dice (the greatest coefficient, ties by name).

    A template needs two words at least.  Null and empty texts have no units,
    and best is null where nothing is met.  Repeated rows are judged alike; an
    empty table gives an empty result; other columns are not read.
    """
    grams = {k: template_bigrams(v) for k, v in sorted((templates or TEMPLATES).items())}
    # t/(2-t)*b <= a <= (2-t)/t*b in whole numbers, t = percent/100
    low = {k: -(-percent * len(g) // (200 - percent)) for k, g in grams.items()}
    high = {k: (200 - percent) * len(g) // percent for k, g in grams.items()}
    # a unit may repeat bigrams, so its word count bounds them from above only
    least = min(low.values()) + 1

    text = F.coalesce(q(text_col), F.lit(""))
    raw = F.array_distinct(F.concat(F.split(text, "\n"), F.split(text, r"\n[\x20\x09]*\n"), F.array(text)))
    parts = df.select(q(id_col).alias("id"), raw.alias("raw"))
    words = F.transform("raw", lambda x: F.split(normalised(x), " "))
    parts = parts.select("id", F.filter(words, lambda x: F.size(x) >= least).alias("words"))
    parts = parts.select("id", F.transform("words", _bigrams).alias("grams"))
    parts = parts.select("id", F.filter("grams", lambda x: F.size(x).between(min(low.values()), max(high.values()))).alias("grams"))

    def compare(unit: Column) -> Column:
        scores = []
        for k, g in grams.items():
            both = F.size(F.array_intersect(unit, F.array(*(F.lit(x) for x in g))))
            dice = 2.0 * both / (F.size(unit) + len(g))
            scores.append(F.when(F.size(unit).between(low[k], high[k]), F.struct((-dice).alias("minus"), F.lit(k).alias("name"))))
        return F.array_compact(F.array(*scores))
    met = F.filter(F.flatten(F.transform("grams", compare)), lambda x: x["minus"] * 100 <= -percent)
    out = parts.select("id", F.size("grams").cast("long").alias("units"), F.array_sort(met).alias("met"))
    return out.select(q("id").alias(id_col), "units",
                      F.array_sort(F.array_distinct(F.transform("met", lambda x: x["name"]))).alias("licences"),
                      F.get("met", F.lit(0))["name"].alias("best"), (-F.get("met", F.lit(0))["minus"]).alias("dice"))
