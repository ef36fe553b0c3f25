"""License scans: sparse TF-IDF cosine to templates, then inheritance from the nearest directory.

Every line of a text is compared with the header templates, and the whole text with the license
file templates; a file that is nothing but a license also speaks for its directory and all below.
DataFrame functions only.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.llm.common import table
from quillsieve.session import materialise

#: Least cosine of a match.
THRESHOLD = 0.8
TERMS = r"[a-z0-9]+(?:\.[0-9]+)*"

# Words too common to look for; they weigh as usual once a line is looked at.
COMMON = frozenset("a all and any are as be by can copy following for form from have in is it may must no nor not of on or other person subject that the their them these this to under use used with without work you".split())
# Names and versions, without which a text doesn't state a template's license.
NAMES = frozenset("mit apache gnu gpl bsd mozilla mpl cc by sa nc 2.0 3 3.0 4.0".split())
# License headers as they are commonly written.
HEADERS = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
)
# The opening grants of license files, and whole license files of MIT and BSD.
FILES = (
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files,"
        " to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,"
        " distribute, sublicense, and/or sell copies of the Software. The above copyright notice and this permission notice shall be"
        " included in all copies or substantial portions of the Software. The software is provided as is, without warranty of any kind.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
        " conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the"
        " following disclaimer. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or"
        " promote products derived from this software without specific prior written permission.",
    ),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as"
        " published by the Free Software Foundation, either version 3 of the License, or any later version. This program is distributed"
        " in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness"
        " for a particular purpose.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
        ' (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, '
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included"
        ' in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS '
        "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER"
        " IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the "
        "copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without"
        ' specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS '
        "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
        "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS "
        "OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
        "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
        "THE POSSIBILITY OF SUCH DAMAGE.",
    ),
)


def _terms(text: str) -> list[str]:
    return re.findall(TERMS, text.lower())


class Templates:
    """Sparse unit vectors of the templates, their terms' weights, and terms no match can lack.

    Weights are smoothed inverse document frequencies over the templates; a term that no template
    has weighs as much as one that none shares, which only makes a stranger's vector longer.
    """

    def __init__(self, headers: tuple = HEADERS, files: tuple = FILES, threshold: float = THRESHOLD):
        texts = [(name, kind, Counter(_terms(text))) for kind, group in (("header", headers), ("file", files)) for name, text in group]
        seen = Counter(t for _, _, terms in texts for t in terms)
        self.unknown = 1.0 + math.log(1.0 + len(texts))
        self.weights = {t: 1.0 + math.log((1.0 + len(texts)) / (1.0 + n)) for t, n in seen.items()}
        self.rows, anchors, header_anchors = [], set(), set()
        #: Names and versions of each template that its matches must have; whole license texts are known by their words.
        self.needs = [terms.keys() & NAMES if kind == "header" or "gnu" in terms else set() for _, kind, terms in texts]
        for number, (name, kind, terms) in enumerate(texts):
            vector = {t: (1.0 + math.log(n)) * self.weights[t] for t, n in terms.items()}
            length = math.sqrt(sum(v * v for v in vector.values()))
            self.rows += [(number, name, kind, t, v / length) for t, v in vector.items()]
            # Without its heaviest terms a template's rest is shorter than the threshold, and so
            # is every cosine with it.
            left = 1.0
            for t in sorted(vector.keys() - COMMON, key=lambda t: (-vector[t], t)):
                if left < threshold**2 - 1e-9:
                    break
                anchors.add(t)
                if kind == "header":
                    header_anchors.add(t)
                left -= (vector[t] / length) ** 2
            if left >= threshold**2:
                raise ValueError(f"{name}: common words alone could reach the threshold")
        self.anchors = sorted(anchors)
        #: Those that a line, which meets header templates only, can't lack.
        self.header_anchors = sorted(header_anchors)


def _plausible(tokens: Column, templates: Templates, threshold: float) -> Column:
    """Whether a unit's cosine with any template can reach the threshold.

    Terms that no template has only make a vector longer, each by at least the square of their
    weight. A known term found n times adds the square of its own weight times ``(1 + ln n) ** 2``,
    which is concave: over all known terms it adds most where each is found equally often and weighs as
    much as the heaviest. Units with too many strangers are left out; none with a match is.
    """
    known = F.filter(tokens, lambda t: t.isin(sorted(templates.weights)))
    different = F.size(F.array_distinct(known))
    strangers = F.size(F.array_distinct(tokens)) - different
    # Scores are rounded to six places before they are compared.
    share = (1.0 / (threshold - 1e-6) ** 2 - 1.0) * (max(templates.weights.values()) / templates.unknown) ** 2
    often = F.size(known) / F.greatest(different, F.lit(1))
    most = share * different * F.pow(F.lit(1.0) + F.log(F.greatest(often, F.lit(1.0))), F.lit(2.0))
    return (different > 0) & (strangers <= most + 1e-6)


def _scored(units: DataFrame, templates: Templates, threshold: float) -> DataFrame:
    """(key, scope, unit, tokens) to (key, scope, unit, name, score) of each unit's best template that it has the names and versions of.

    Lines are compared with header templates, whole texts with all.
    """
    spark = units.sparkSession
    # Constant tables: a row per term of a template.
    rows = [(*r, int(r[3] in templates.needs[r[0]]), len(templates.needs[r[0]])) for r in templates.rows]
    vectors = F.broadcast(spark.createDataFrame(rows, "template int, name string, kind string, term string, w double, needed int, needs int"))
    idf = F.broadcast(spark.createDataFrame(sorted(templates.weights.items()), "term string, idf double"))
    counted = units.select("key", "scope", "unit", F.explode("tokens").alias("term")).groupBy("key", "scope", "unit", "term").agg(F.count("*").alias("tf"))
    weighed = counted.join(idf, "term", "left").withColumn("v", (F.lit(1.0) + F.log("tf")) * F.coalesce("idf", F.lit(templates.unknown)))
    sides = F.when((F.col("scope") == "whole") | (F.col("kind") == "header"), F.struct("template", "name", "w", "needed", "needs"))
    met = weighed.join(vectors, "term", "left").withColumn("side", sides)
    # A term's own square counts once, however many templates have it.
    once = met.groupBy("key", "scope", "unit", "term", "v").agg(F.collect_list("side").alias("sides"))
    lengths = once.groupBy("key", "scope", "unit").agg(F.sum(F.col("v") * F.col("v")).alias("vv"))
    by_template = once.select("key", "scope", "unit", "v", F.explode("sides").alias("s")).groupBy("key", "scope", "unit", "s.template", "s.name")
    dots = by_template.agg(F.sum(F.col("v") * F.col("s.w")).alias("dot"), F.sum("s.needed").alias("has"), F.max("s.needs").alias("needs")).where("has = needs")
    found = dots.join(lengths, ["key", "scope", "unit"]).withColumn("score", F.round(F.col("dot") / F.sqrt("vv"), 6)).where(F.col("score") >= threshold)
    best = F.max_by("name", F.struct("score", -F.col("template"))).alias("name")
    return found.groupBy("key", "scope", "unit").agg(best, F.max("score").alias("score"))


def _ancestors(directory: Column) -> Column:
    """A directory and all above it, the root as an empty string."""
    parts = F.split(directory, "/")
    deeper = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    return F.array_distinct(F.concat(F.array(F.lit("")), deeper))


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text", templates: Templates | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(path, license, score, found, from_path): a row per different path of ``files``.

    ``found`` is ``file`` where the whole text is a license, else ``header`` where a line is,
    else ``inherited`` from the nearest directory at or above the file's that has a license file,
    else null. Of several matches the highest score counts, then the earlier template; of several
    license files of a directory the highest score, then the smallest path. ``from_path`` is the
    path of the file that says so. Null and empty texts match nothing; a null path is left out; a
    path with several rows is one file with all their lines, and its whole text is any of them.

    Only texts and lines with a term that no match can lack are taken apart, and of those only
    what can reach the threshold is shuffled, so that follows the number of licenses. Directories are made distinct before they look upwards.
    """
    templates = templates or Templates(threshold=threshold)
    pattern, in_lines = (r"(?i)(?<![a-z0-9])(?:" + "|".join(map(re.escape, a)) + r")(?![a-z0-9])" for a in (templates.anchors, templates.header_anchors or templates.anchors))
    rows = files.where(F.col(path_col).isNotNull()).select(F.col(path_col).alias("key"), F.col(text_col).alias("text"))
    terms_of = lambda text: F.regexp_extract_all(F.lower(text), F.lit(TERMS), F.lit(0))
    hopeful = rows.where(F.col("text").rlike(pattern))
    lines = F.transform(F.filter(F.split("text", "\n"), lambda line: line.rlike(in_lines)), lambda line: F.struct(F.lit("line").alias("scope"), terms_of(line).alias("tokens")))
    whole = F.array(F.struct(F.lit("whole").alias("scope"), terms_of(F.col("text")).alias("tokens")))
    units = hopeful.select("key", F.explode(F.concat(lines, whole)).alias("u")).select("key", "u.scope", "u.tokens")
    # Stored once: what follows reads it several times, and it is as small as the licenses are few.
    units = materialise(units.where(_plausible(F.col("tokens"), templates, threshold)).distinct(), "license-units")

    scored = _scored(units.withColumn("unit", F.xxhash64("tokens")), templates, threshold)
    rank = F.struct((F.col("scope") == "whole").alias("file"), "score", "name")
    direct = scored.groupBy("key").agg(F.max(rank).alias("r")).select("key", "r.name", "r.score", F.when(F.col("r.file"), "file").otherwise("header").alias("found"))

    folder = F.regexp_extract("key", r"^(.*)/[^/]*$", 1)
    speakers = direct.where("found = 'file'").groupBy(folder.alias("dir")).agg(F.min_by(F.struct("name", "score", "key"), F.struct(-F.col("score"), "key")).alias("s"))
    folders = rows.select(folder.alias("folder")).distinct()
    above = folders.select("folder", F.explode(_ancestors(F.col("folder"))).alias("dir"))
    nearest = above.join(speakers, "dir").groupBy("folder").agg(F.max_by("s", F.length("dir")).alias("s"))
    paths = rows.select("key").distinct().withColumn("folder", folder)
    joined = paths.join(direct, "key", "left").join(nearest, "folder", "left")
    inherits = F.col("found").isNull() & F.col("s").isNotNull()
    return joined.select(
        F.col("key").alias("path"),
        F.coalesce("name", "s.name").alias("license"),
        F.coalesce("score", "s.score").alias("score"),
        F.when(inherits, "inherited").otherwise(F.col("found")).alias("found"),
        F.when(inherits, F.col("s.key")).when(F.col("found").isNotNull(), F.col("key")).alias("from_path"),
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files ``source/language/id``, each with the license it states or inherits."""
    docs = table(spark, sf_dir, "documents")
    files = docs.select(F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("path"), "text")
    return scan(files)


QUERIES = {"op5_license_scan": op5_license_scan}
ORACLES: dict[str, str] = {}
