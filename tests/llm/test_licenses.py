import re
import textwrap

import pytest

from tests.llm import helpers
from threadloom.llm import licenses

MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction. Some more text. '
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
    'of the Software.\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED.'
)
BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\nRedistributions of source code must retain the above copyright notice.\n"
    "Redistributions in binary form must reproduce the above copyright notice."
)
THIRD = "\nNeither the name of the copyright holder nor the names of its contributors may be used."



#: Public licence texts and notices, paragraph by paragraph.
WHOLE = {
    "MIT": [
        "Copyright (c) 2020 Some Author",
        licenses.SENTENCES["mit-grant"][0],
        licenses.SENTENCES["notice-kept"][0],
        licenses.SENTENCES["as-is"][0] + " IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
        "USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "ISC": [
        "Copyright 2020 Some Author",
        licenses.SENTENCES["isc-grant"][0],
        licenses.SENTENCES["isc-as-is"][0] + " IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
        "DAMAGES OR ANY DAMAGES WHATSOEVER.",
    ],
    "BSD-2-Clause": [
        "Copyright 2020 Some Author",
        licenses.SENTENCES["bsd-grant"][0],
        "1. " + licenses.SENTENCES["bsd-source"][0],
        "2. " + licenses.SENTENCES["bsd-binary"][0],
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.",
    ],
    "BSD-3-Clause": [
        licenses.SENTENCES["bsd-grant"][0],
        "* " + licenses.SENTENCES["bsd-source"][0],
        "* " + licenses.SENTENCES["bsd-binary"][0],
        "* " + licenses.SENTENCES["bsd-name"][0],
    ],
    "Apache-2.0": [
        licenses.SENTENCES["apache-2-use"][0] + " You may obtain a copy of the License at",
        "    http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "GPL-3.0": [licenses.SENTENCES["gpl-3-terms"][0], licenses.SENTENCES["gpl-hope"][0] + " See the GNU General Public License for more details."],
    "GPL-2.0": [licenses.SENTENCES["gpl-2-terms"][0], licenses.SENTENCES["gpl-hope"][0] + " See the GNU General Public License for more details."],
    "LGPL-2.1": [licenses.SENTENCES["lgpl-2.1-terms"][0]],
    "LGPL-3.0": [licenses.SENTENCES["lgpl-3-terms"][1]],
    "AGPL-3.0": [licenses.SENTENCES["agpl-terms"][0], licenses.SENTENCES["gpl-hope"][0]],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
        "compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
}


def wrapped(paragraphs, width, mark=""):
    lines = []
    for p in paragraphs:
        lines += [*(textwrap.wrap(p, width, break_long_words=False, break_on_hyphens=False) if width else [p]), ""]
    return "\n".join((mark + s).rstrip() for s in lines)


@pytest.mark.parametrize("form", ["60", "80", "not wrapped", "one line", "in a comment", "after prose"])
def test_whole_licences_are_recognised(spark, form):
    def shape(paragraphs):
        if form == "one line":
            return " ".join(p.strip() for p in paragraphs)
        if form == "in a comment":
            return "#!/bin/sh\n#\n" + wrapped(paragraphs, 70, "# ") + "\nset -e\n"
        if form == "after prose":
            return "Some words without a stop\n\n" + wrapped(paragraphs, 72) + "\nMore words here. And more"
        return wrapped(paragraphs, int(form) if form.isdigit() else 0)

    found, _ = scan(spark, *map(shape, WHOLE.values()))
    assert dict(zip(WHOLE, found)) == {name: [name] for name in WHOLE}


def test_every_known_sentence_has_a_hint():
    assert all(re.search(licenses.HINTS, s) for s in licenses.KNOWN)
    assert {i for _, ids in licenses.RULES for i in ids} <= set(licenses.KNOWN.values())


def test_sql_finds_the_same(spark, tmp_path):
    import duckdb

    from tests.compare import canonical, duck_rows, spark_rows
    from threadloom.llm.oracles import ORACLES
    from threadloom.llm.queries import op9_license_scan

    texts = [wrapped(p, w, m) for p in WHOLE.values() for w, m in ((60, ""), (0, ""), (70, "// "))]
    texts += ["end\nMIT License\nmore", "x. All rights reserved", "(1) MIT License.", *helpers.ODD_TEXTS]
    helpers.docs(spark, texts).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got = spark_rows(op9_license_scan(spark, str(tmp_path)))
    assert canonical(got) == canonical(duck_rows(con, ORACLES["op9_license_scan"]))


def scan(spark, *texts):
    rows = licenses.scan(helpers.docs(spark, texts)).orderBy("doc_id").collect()
    return [r.licenses for r in rows], rows


def test_rules_in_order(spark):
    parts = MIT.split(". ")
    turned = ". ".join([parts[2], parts[0], *parts[1:2]]) + "."
    found, rows = scan(spark, MIT, turned, BSD, BSD + THIRD, "Released under the MIT License.", "nothing at all")
    assert found == [["MIT"], [], ["BSD-2-Clause"], ["BSD-3-Clause"], ["MIT"], []]
    assert rows[0].sentence_ids == ["mit-grant", "notice-kept", "as-is"]


def test_several_licences_and_spelling(spark):
    found, _ = scan(
        spark,
        "x.\n  licensed   under the APACHE License, Version 2.0.\nfoo; Licensed under CC BY-NC 4.0. All rights reserved.",
        "We are not licensed under the MIT license of old",
    )
    assert found == [["Apache-2.0", "CC-BY-NC-4.0", "reserved"], []]


def test_odd_rows(spark):
    got = licenses.scan(helpers.odd(spark))
    assert got.columns.count("licenses") == 1
    rows = got.collect()
    assert len(rows) == 10 and all(r["licenses"] == [] for r in rows)
    assert {r["n_sentences"] for r in rows if not (r["text"] or "").strip()} == {0}
    assert licenses.scan(helpers.empty(spark)).count() == 0
