"""License scan by sentences: known sentences become identifiers, ordered rules read the identifier sequence."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Identifier and text of known license sentences.
SENTENCES = {
    "apache2-line": "Licensed under the Apache License, Version 2.0.",
    "apache2-under": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache2-use": "you may not use this file except in compliance with the License.",
    "apache2-copy": "You may obtain a copy of the License at",
    "apache2-asis": 'Unless required by applicable law or agreed to in writing, software distributed under the License is '
                    'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "mit-line": "Released under the MIT License.",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
                 'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
                 'the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and '
                 'to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
                  "the Software.",
    "cc-by-nc4-line": "Licensed under CC BY-NC 4.0.",
    "cc-by4-line": "Licensed under CC BY 4.0.",
    "gpl3-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
                "later version.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                 "following conditions are met:",
    "bsd-name": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                "products derived from this software without specific prior written permission.",
}
#: Ordered rules. The first that fits takes its identifiers; ``?`` marks one that may be missing.
RULES = [
    ("Apache-2.0", ["apache2-under", "apache2-use", "apache2-copy?", "apache2-asis?"]), ("Apache-2.0", ["apache2-line"]),
    ("MIT", ["mit-line?", "mit-grant", "mit-notice?"]), ("MIT", ["mit-line"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-name"]), ("BSD-2-Clause", ["bsd-grant"]),
    ("GPL-3.0-or-later", ["gpl-free"]), ("GPL-3.0-only", ["gpl3-line"]),
    ("CC-BY-NC-4.0", ["cc-by-nc4-line"]), ("CC-BY-4.0", ["cc-by4-line"]),
]
HINT = r"(?i)licen[sc]e|permission|copyright|redistribut|free software"


def pieces(text: Column) -> Column:
    """The text cut at stops and at line ends, every piece between bars: lower case, one space for anything but letters
    and digits, British spelling undone."""
    cut = F.regexp_replace(F.lower(F.translate(text, "\x01", " ")), r"(?<=[.;:!?])\s+|\R+", "\x01")
    cut = F.regexp_replace(F.regexp_replace(cut, r"[^\p{L}\p{N}\x01]+", " "), r" ?\x01[ \x01]*", "|")
    return F.regexp_replace(F.concat(F.lit("|"), F.trim(cut), F.lit("|")), r"\blicence", "license")


def plain(sentence: str) -> str:
    return " ".join("".join(c if c.isalnum() else " " for c in sentence.lower()).split()).replace("licence", "license")


def identifiers(text: Column) -> Column:
    """The known sentences in order, the longest where several begin. A sentence begins and ends with a piece and may run
    over the ends of the pieces between: over lines, or over a stop of its own."""
    known = {plain(s): i for i, s in SENTENCES.items()}
    any_of = "|".join(s.replace(" ", "[ |]") for s in sorted(known, key=len, reverse=True))
    found = F.regexp_extract_all(pieces(text), F.lit(rf"(?<=\|)(?:{any_of})(?=\|)"), F.lit(0))
    names = F.create_map(*chain.from_iterable((F.lit(s), F.lit(i)) for s, i in known.items()))
    return F.transform(found, lambda x: F.try_element_at(names, F.translate(x, "|", " ")))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, sentences (identifiers in order), licenses (in order, repeats included) and n_unmatched for each row with a known sentence.

    Sentences begin and end at a stop and white space or at a line end, and may run over lines: see ``identifiers``.
    Identifiers that no rule takes count as unmatched. Null, empty and other texts give no row;
    equal rows give equal rows. Rows are read one by one, nothing is shuffled.
    """
    text = F.col("text")
    rows = docs.select("doc_id", "text").where(text.rlike(HINT)).select("doc_id", identifiers(text).alias("sentences"))
    joined = F.concat(F.lit(" "), F.array_join("sentences", "  "), F.lit(" "))
    for i, (_, rule) in enumerate(RULES):
        pattern = "".join(f"(?: {x[:-1]} )?" if x.endswith("?") else f" {x} " for x in rule)
        joined = F.regexp_replace(joined, pattern, f" @{i} ")
    tokens = F.filter(F.split(F.trim(joined), " +"), lambda x: x != "")
    names = F.array(*[F.lit(n) for n, _ in RULES])
    return (rows.withColumn("tokens", tokens).where(F.size("sentences") > 0).select(
        "doc_id", "sentences",
        F.transform(F.filter("tokens", lambda x: x.startswith("@")), lambda x: F.get(names, F.substring(x, 2, 9).cast("int"))).alias("licenses"),
        F.size(F.filter("tokens", lambda x: ~x.startswith("@"))).cast("long").alias("n_unmatched")))
