"""Licence scans: known licence sentences, then ordered rules over their identifiers.

A text loses the comment marks at the heads of its lines and is cut into sentences, twice: with the lines of
a paragraph joined, as licence texts are wrapped, and with a cut at every line and semicolon, as names of licences stand on lines
of their own. A sentence is normalised (lower case, runs of anything but
letters, digits, dots and hyphens as one space) and looked up among the known
sentences, which were cut and normalised alike. The identifiers of a text, in order, are matched against rules: a rule holds if
its identifiers occur in that order, with anything between them, in one of the two cuts. All steps are column
expressions, so a text never leaves its row and nothing is shuffled. Sentences are looked up only in texts that
hold one of ``HINTS``, which every known sentence does.

A null or empty text has no sentences and no licences. Rows are scanned one by one; added
columns replace columns of the same name.
"""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences and notices, as they are written.
SENTENCES = {
    "mit-name": ["Released under the MIT License", "Licensed under the MIT License", "The MIT License", "MIT License"],
    "mit-grant": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
    ],
    "notice-kept": [
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software.",
    ],
    "as-is": [
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "The software is provided \"as is\", without warranty of any kind, express or implied",
    ],
    "apache-2-name": ["Licensed under the Apache License, Version 2.0", "Apache License, Version 2.0", "Apache License Version 2.0, January 2004"],
    "apache-2-use": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License.",
    ],
    "gpl-3-name": [
        "This work is licensed under the GNU General Public License, version 3",
        "Licensed under the GNU General Public License, version 3",
        "GNU General Public License, version 3",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ],
    "gpl-3-terms": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 3 of the License, or (at your "
        "option) any later version.",
    ],
    "gpl-2-name": [
        "This work is licensed under the GNU General Public License, version 2",
        "Licensed under the GNU General Public License, version 2",
        "GNU General Public License, version 2",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    ],
    "gpl-2-terms": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License version 2 as published by the Free Software Foundation.",
    ],
    "gpl-hope": [
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ],
    "lgpl-2.1-name": ["GNU Lesser General Public License, version 2.1"],
    "lgpl-2.1-terms": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
        "your option) any later version.",
    ],
    "lgpl-3-name": ["GNU Lesser General Public License, version 3"],
    "lgpl-3-terms": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 3 of the License, or (at "
        "your option) any later version.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
    ],
    "agpl-name": ["GNU Affero General Public License, version 3"],
    "agpl-terms": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
    ],
    "bsd-grant": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
    ],
    "bsd-source": [
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",
        "Redistributions of source code must retain the above copyright notice",
    ],
    "bsd-binary": [
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Redistributions in binary form must reproduce the above copyright notice",
    ],
    "bsd-name": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
        "Neither the name of the University nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
        "Neither the name of the copyright holder nor the names of its contributors may be used",
    ],
    "mpl-terms": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "cc-by-name": ["Licensed under CC BY 4.0", "Licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-sa-name": ["Licensed under CC BY-SA 4.0"],
    "cc-by-nc-name": ["Licensed under CC BY-NC 4.0"],
    "cc0-name": ["CC0 1.0 Universal", "Licensed under CC0 1.0"],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
    "isc-grant": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "isc-as-is": [
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
        "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    ],
    "reserved": ["All rights reserved."],
}

# Licence and the ordered sentence identifiers that tell it.
RULES = [
    ("MIT", ["mit-name"]),
    ("MIT", ["mit-grant", "notice-kept", "as-is"]),
    ("Apache-2.0", ["apache-2-name"]),
    ("Apache-2.0", ["apache-2-use"]),
    ("GPL-3.0", ["gpl-3-name"]),
    ("GPL-3.0", ["gpl-3-terms", "gpl-hope"]),
    ("GPL-2.0", ["gpl-2-name"]),
    ("GPL-2.0", ["gpl-2-terms", "gpl-hope"]),
    ("LGPL-2.1", ["lgpl-2.1-name"]),
    ("LGPL-2.1", ["lgpl-2.1-terms"]),
    ("LGPL-3.0", ["lgpl-3-name"]),
    ("LGPL-3.0", ["lgpl-3-terms"]),
    ("AGPL-3.0", ["agpl-name"]),
    ("AGPL-3.0", ["agpl-terms"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name"]),
    ("MPL-2.0", ["mpl-terms"]),
    ("CC-BY-4.0", ["cc-by-name"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-name"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-name"]),
    ("CC0-1.0", ["cc0-name"]),
    ("Unlicense", ["unlicense"]),
    ("ISC", ["isc-grant", "isc-as-is"]),
    ("reserved", ["reserved"]),
]
#: A rule that is a longer form of another: the shorter licence is not reported beside it.
REPLACES = {"BSD-3-Clause": "BSD-2-Clause"}
#: Every known sentence has one of these.
HINTS = "license|warranty|permission|redistribution|software|rights reserved|cc0|copyright|mozilla public|neither the name"

#: Marks of comments and of list items at the head of a line.
MARKS = r"(?m)^[ \t]*(?:(?://+|#+|\*+|--+|;+)[ \t]*)?(?:\(?[0-9]+[.)][ \t]+)?"
#: Words that begin a sentence wherever they stand, as a line of copyright before them has no stop.
OPENINGS = r"(permission is hereby granted|permission to use, copy|redistribution and use in source)"
#: A sentence ends at a stop, mark or colon before white space or the end, or with its paragraph; in the
#: second cut also at a semicolon and with its line.
PARAGRAPHS = r"[.!?:][ \t\r\n]+|[.!?:]\z|\n[ \t\r]*\n"
LINES = r"[.!?:;][ \t\r\n]+|[.!?:;]\z|\n+"
SPACE = r"[^a-z0-9.\-]+"


def fragment(sentence: str) -> str:
    """A known sentence as the cut leaves it: its longest part, normalised."""
    parts = re.split(PARAGRAPHS.replace(r"\z", r"\Z"), sentence.lower())
    return max((re.sub(SPACE, " ", p).strip(" ") for p in parts), key=len)


#: Normalised sentence to identifier.
KNOWN = {fragment(t): name for name, texts in SENTENCES.items() for t in texts}


def _ids(text: Column, cut: str) -> Column:
    known = F.create_map(*[F.lit(x) for pair in KNOWN.items() for x in pair])
    sentences = F.transform(F.split(text, cut), lambda s: F.trim(F.regexp_replace(s, SPACE, " ")))
    likely = F.filter(sentences, lambda s: s.rlike(HINTS))
    return F.filter(F.transform(likely, lambda s: F.element_at(known, s)), lambda s: s.isNotNull())


def _names(ids: str) -> Column:
    """The licences whose rules hold for a list of identifiers."""
    line = F.concat(F.lit(" "), F.array_join(ids, "  "), F.lit(" "))
    hits = [F.when(line.rlike(pattern(rule)), F.lit(name)) for name, rule in RULES]
    return F.when(F.size(ids) > 0, F.array_compact(F.array(*hits))).otherwise(F.array().cast("array<string>"))


def pattern(rule: list[str]) -> str:
    return " .*".join(f" {re.escape(i)}" for i in rule) + " "


def scan(docs: DataFrame, text: str = "text", keep=None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``n_sentences`` (lines of a paragraph joined), ``sentence_ids`` (in order,
    then those found in single lines only) and ``licenses`` (sorted)."""
    added = ("n_sentences", "sentence_ids", "licenses")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    low = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), MARKS, ""), OPENINGS, ". $1")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), low.alias("low"))
    none = F.array().cast("array<string>")
    likely = F.col("low").rlike(HINTS)
    n = F.size(F.filter(F.split("low", PARAGRAPHS), lambda s: s.rlike(r"[a-z0-9.\-]")))
    rows = rows.select(
        "doc",
        n.cast("long").alias("n_sentences"),
        F.when(likely, _ids(F.col("low"), PARAGRAPHS)).otherwise(none).alias("joined"),
        F.when(likely, _ids(F.col("low"), LINES)).otherwise(none).alias("single"),
    )
    ids = F.concat("joined", F.array_except("single", "joined"))
    rows = rows.select("doc", "n_sentences", ids.alias("ids"), F.array_union(_names("joined"), _names("single")).alias("names"))
    shadowed = F.array_compact(
        F.array(*[F.when(F.array_contains("names", long), F.lit(short)) for long, short in REPLACES.items()])
    )
    return rows.select(
        *[F.col(f"doc.`{c}`").alias(c) for c in kept],
        "n_sentences",
        F.col("ids").alias("sentence_ids"),
        F.array_sort(F.array_except("names", shadowed)).alias("licenses"),
    )
