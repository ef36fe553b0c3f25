import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillsieve.llm.licenses import FILES, TERMS, Templates, _plausible, op5_license_scan, scan

MIT = FILES[0][1]
ROWS = [
    ("a/LICENSE", MIT),
    ("a/b/x.py", "import os\nprint(1)"),
    ("a/b/c/LICENSE", "Licensed under CC BY 4.0."),
    ("a/b/c/y.py", "# SPDX-License-Identifier: Apache-2.0\n" + "some code of its own here\n" * 5),
    ("a/b/c/d/z.py", None),
    ("ab/w.py", "words"),
    ("top.py", "Released under\nthe MIT License."),
    ("q/r.py", "text\n  RELEASED under the MIT license!  \nmore text than the license line has"),
    ("q/r.py", "text\n  RELEASED under the MIT license!  \nmore text than the license line has"),
    ("q/long.py", "word " * 20_000 + "\nThis work is licensed under the GNU General Public License, version 3.\n"),
    ("q/empty", ""),
    (None, MIT),
]


def brute(rows, templates, threshold=0.8):
    vectors = {}
    for number, name, kind, term, w in templates.rows:
        vectors.setdefault((number, name, kind), {})[term] = w

    def best(text, kind):
        v = {t: (1 + math.log(n)) * templates.weights.get(t, templates.unknown) for t, n in Counter(re.findall(TERMS, text.lower())).items()}
        length = math.sqrt(sum(x * x for x in v.values())) or 1.0
        scores = [(round(sum(v.get(t, 0) * w for t, w in vec.items()) / length, 6), -number, name) for (number, name, k), vec in vectors.items() if k == kind]
        top = max(scores)
        return (top[0], top[2]) if top[0] >= threshold else None

    own, out = {}, {}
    for path, text in rows:
        if path is None:
            continue
        found = [("file", *b) for k in ("file", "header") if (b := best(text or "", k))]
        found += [("header", *b) for line in (text or "").split("\n") if (b := best(line, "header"))]
        found = [max(found, key=lambda f: (f[0] == "file", f[1], f[2]))] if found else []
        own[path] = max(own.get(path, []) + found, key=lambda f: (f[0] == "file", f[1], f[2]), default=None)
        own[path] = [own[path]] if own[path] else []
    speakers = {}
    for path in sorted(own):
        if own[path] and own[path][0][0] == "file":
            folder = path.rpartition("/")[0]
            if folder not in speakers or own[path][0][1] > speakers[folder][0]:
                speakers[folder] = (own[path][0][1], own[path][0][2], path)
    for path in own:
        if own[path]:
            out[path] = (own[path][0][2], own[path][0][1], own[path][0][0], path)
            continue
        folder = path.rpartition("/")[0]
        while folder and folder not in speakers:
            folder = folder.rpartition("/")[0]
        s = speakers.get(folder)
        out[path] = (s[1], s[0], "inherited", s[2]) if s else (None, None, None, None)
    return out


def result(df):
    return {r.path: tuple(r)[1:] for r in df.collect()}


def test_awkward_files(spark):
    files = spark.createDataFrame([(*r, "k", 1) for r in ROWS], "path string, text string, key string, unit int")
    assert result(scan(files)) == brute(ROWS, Templates())
    got = result(scan(files))
    assert got["a/b/x.py"] == ("MIT", 1.0, "inherited", "a/LICENSE")
    assert got["a/b/c/d/z.py"][:3] == ("CC-BY-4.0", 1.0, "inherited") and got["ab/w.py"][3] == "top.py"
    assert got["q/r.py"][:3] == ("MIT", 1.0, "header")
    assert scan(files.limit(0)).count() == 0


def test_anchors_are_terms_no_match_can_lack():
    templates = Templates()
    for number in {r[0] for r in templates.rows}:
        rest = math.sqrt(sum(r[4] ** 2 for r in templates.rows if r[0] == number and r[3] not in templates.anchors))
        assert rest < 0.8
    with pytest.raises(ValueError):
        Templates(headers=(("X", "the of and"),), files=())


def test_query_against_brute_force(spark, sf_dir):
    rows = [(f"{r.source}/{r.lang}/{r.doc_id}", r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = result(op5_license_scan(spark, sf_dir))
    assert got == brute(rows, Templates())
    assert any(r[0] for r in got.values())


def test_no_python_runs(spark, sf_dir):
    plan = op5_license_scan(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_whole_license_files_and_other_names_and_versions(spark):
    mit, bsd = FILES[-2][1], FILES[-1][1]
    rows = [
        ("m/LICENSE", f"MIT License\n\nCopyright (c) 2020 Jane Roe\n\n{mit}\n"),
        ("m/x.py", "print(1)"),
        ("b/LICENSE", f"BSD 3-Clause License\n\nCopyright (c) 2021, Jane Roe\nAll rights reserved.\n\n{bsd}\n"),
        ("o/gpl2.py", "This work is licensed under the GNU General Public License, version 2."),
        ("o/style.py", "Use of this source code is governed by a MIT-style license."),
    ]
    got = {r.path: (r.license, r.found) for r in scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert got["m/LICENSE"] == ("MIT", "file") and got["m/x.py"] == ("MIT", "inherited") and got["b/LICENSE"] == ("BSD-3-Clause", "file")
    assert got["o/gpl2.py"] == got["o/style.py"] == (None, None)


def test_texts_of_common_words_are_not_taken_apart(spark):
    templates = Templates()
    common = ["the", "of", "and", "to", "in", "is", "for", "this", "any", "software"]
    usual = common * 8 + [f"word{i}" for i in range(120)]
    # At the bound: a template with as many strangers as its cosine allows.
    near = re.findall(TERMS, MIT.lower())
    vector = {t: (1 + math.log(n)) * templates.weights[t] for t, n in Counter(near).items()}
    spare = int((1 / 0.8**2 - 1) * sum(v * v for v in vector.values()) / templates.unknown**2)
    rows = [("usual", usual), ("license", near), ("near", near + [f"x{i}" for i in range(spare)])]
    df = spark.createDataFrame(rows, "name string, tokens array<string>")
    kept = {r.name for r in df.where(_plausible(F.col("tokens"), templates, 0.8)).collect()}
    assert kept == {"license", "near"}
    files = spark.createDataFrame([("n/LICENSE", " ".join(rows[2][1]))], "path string, text string")
    assert result(scan(files))["n/LICENSE"][0] == "MIT"
