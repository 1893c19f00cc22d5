import hashlib
import re
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from lectern.llm import licenses, queries

ODD = [None, "", "  ", "Copyright (c) 2020 A B\n", "©2020 x\nwords", "(c) 2021 y\nwords", "(c) You may\nwords", "COPYRIGHT HOLDERS stay", "Licence, LICENCE licence", "É é ß 1.2", "licence licence sub licence licence percent percent", "copyright holder copyright holders holder", "Copyright The Foo Authors\nwords", "# Copyright The Bar Project.", "copyright the owner stays", "COPYRIGHT HOLDERS AND CONTRIBUTORS\nstay"]


def canonical(text):
    kept = re.sub(r"(?im)^[^\w\n]*(?:copyright[ \t]*(?:©|\(c\)|by[ \t]|:|[0-9]{4})|©|\(c\)[ \t]*[0-9]{4}|all rights reserved)[^\n]*$", "", text or "")
    kept = re.sub(r"(?im)^[^\w\n]*copyright[ \t]+the[ \t][^\n]*(authors|contributors|developers|project|team|foundation)[^\w\n]*$", "", kept)
    words = re.sub(r"[\W_]+", " ", kept.lower()).strip(" ")
    for old, new in licenses.SPELLINGS.items():
        words = re.sub(f"(?<![^ ]){old}(?![^ ])", new, words)
    return words


def test_whole_table_and_odd_texts_against_plain_python(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(10**6 + i, t) for i, t in enumerate(ODD)] + [(None, "Licensed under CC BY-NC 4.0!"), (5, "licensed UNDER cc-by-nc 4.0"), (5, "licensed UNDER cc-by-nc 4.0"), (6, "x " * 100_000)]
    frame = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, license_id string")
    got = sorted(map(tuple, licenses.scan(frame, licenses.known_licenses(spark)).collect()), key=repr)
    by = {hashlib.sha256(canonical(t).encode()).hexdigest(): k for k, t in sorted(licenses.KNOWN.items(), reverse=True)}
    digests = [(d, hashlib.sha256(canonical(t).encode()).hexdigest()) for d, t in docs]
    assert got == sorted(((d, h, by.get(h)) for d, h in digests), key=repr)
    assert sum(r[2] is not None for r in got) == 3


def test_variants_share_a_digest(spark):
    mit = licenses.KNOWN["MIT"]
    variants = ["MIT License\n\n" + mit, mit, "Copyright The Foo Authors\n\n" + mit, "Copyright (c) 2019 Some One\n\nAll rights reserved.\n" + mit.lower(), re.sub(r"(?<=OR) (?=COPYRIGHT)", "\n", mit), mit.replace("sublicense", "sublicence").replace(",", " ,"), "# " + mit.replace("\n", "\n# "), mit.replace("COPYRIGHT HOLDERS", "Copyright Owners")]
    rows = spark.createDataFrame(list(enumerate(variants)), "doc_id long, text string")
    for limit in (100_000, 2):
        got = {r.doc_id: r.license_id for r in licenses.scan(rows, licenses.known_licenses(spark), limit).collect()}
        assert got == {0: None, **{i: "MIT" for i in range(1, len(variants))}}


def test_known_texts_that_are_empty_or_equal(spark):
    known = spark.createDataFrame([("b", "some text"), ("a", "Some TEXT"), ("e", "©2020"), ("n", None)], "license_id string, text string")
    rows = spark.createDataFrame([(1, "some, text"), (2, ""), (3, None)], "doc_id long, text string")
    assert {r.doc_id: r.license_id for r in licenses.scan(rows, known).collect()} == {1: "a", 2: None, 3: None}


def test_sql_says_the_same(spark):
    rows = spark.createDataFrame(list(enumerate(ODD)), "i int, t string").select("i", licenses.canonical(F.col("t")).alias("c")).collect()
    with duckdb.connect() as con:
        for r in rows:
            assert con.execute(f"select {licenses.canonical_sql('t')} from (select ?::varchar as t)", [ODD[r.i]]).fetchone()[0] == r.c


def test_lines_of_the_test_documents_match(spark, sf):
    by = {canonical(t): k for k, t in sorted(licenses.KNOWN.items(), reverse=True)}
    want, docs = Counter(), {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        for line in r.text.split("\n"):
            if name := by.get(canonical(line)):
                want[name] += 1
                docs.setdefault(name, set()).add(r.doc_id)
    got = queries.license_lines(spark, sf).collect()
    assert {r.license_id: (r.n, r.n_docs) for r in got} == {k: (n, len(docs[k])) for k, n in want.items()} and want


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string"), licenses.known_licenses(spark)).count() == 0


BSD2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""


def found(spark, folder, texts):
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return [r.license_id for r in sorted(queries.op9_license_scan(spark, str(folder)).collect())]


def test_titled_and_full_texts_are_found(spark, tmp_path):
    mit, owner = licenses.KNOWN["MIT"], "Copyright (c) 2020 A B\n\n"
    texts = ["MIT License\n\n" + owner + mit, "The MIT License (MIT)\n\n" + owner + mit, mit, "ISC License\n\n" + owner + licenses.KNOWN["ISC"]]
    texts += ["BSD 2-Clause License\n\n" + owner + BSD2 + DISCLAIMER, owner + BSD2 + DISCLAIMER, "BSD 3-Clause License\n\n" + owner + BSD2 + BSD3 + DISCLAIMER, BSD2 + BSD3 + DISCLAIMER]
    texts += [BSD2 + BSD3, "MIT License", "Some License\n\n" + mit]
    assert found(spark, tmp_path, texts) == ["MIT", "MIT", "MIT", "ISC", "BSD-2-Clause", "BSD-2-Clause", "BSD-3-Clause", "BSD-3-Clause", None, None, None]


@pytest.mark.skipif(not Path("/usr/share/common-licenses").is_dir(), reason="no texts on this machine")
def test_full_texts_of_the_system_are_found(spark, tmp_path):
    names = {"Apache-2.0": "Apache-2.0", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0"}
    texts = [Path("/usr/share/common-licenses", n).read_text() for n in names]
    assert dict(zip(names, found(spark, tmp_path, texts))) == names


def test_licenses_of_one_line_are_found(spark, tmp_path):
    flat = {k: " ".join(t.split()) for k, t in {**licenses.KNOWN, "BSD-2-Clause": BSD2 + DISCLAIMER, "BSD-3-Clause": BSD2 + BSD3 + DISCLAIMER}.items()}
    for owner in ("Copyright (c) 2020 A B. ", "Copyright (c) 2020 J. R. Smith, Inc. All rights reserved. ", "© 2019 Ünal ", "(c) 2018 x Copyright 2020 y "):
        assert found(spark, tmp_path, [owner + t for t in flat.values()]) == list(flat), owner
    mit, owner = flat["MIT"], "Copyright (c) 2020 A B "
    texts = ["MIT License " + owner + mit, owner + mit + " But not on Sundays.", "No. " + owner + mit, owner + "and more\nterms " + mit, owner, owner * 20_000, None]
    assert found(spark, tmp_path, texts) == ["MIT", None, None, None, None, None, None]
