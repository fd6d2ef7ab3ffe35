"""License scan: MinHash bands over overlapping text windows find templates, shingle containment verifies them.

DataFrame functions only. Shingles are runs of three words. A template of n words is sought in windows of n + n/4 words,
n/4 words (one at least) apart, so any copy lies whole in some window. A window that holds four fifths of the template's
shingles has a Jaccard similarity to it of 0.5 to 0.75, by the template's length. Each template gets as many bands of one
row as it takes for such a window to share none of them with a probability below 1e-9, 26 or so. A template with no more
shingles than that has a band for each of its shingles instead, in whose order this shingle comes first: any window that
holds it collides, so nothing is missed.
A window shares a band only if the band's smallest template shingle is in it. So only windows around an occurrence of that
one are hashed; no window that could collide is left out.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .words import with_words, word_runs

SHINGLE, CONTAINMENT = 3, 0.8
# Highest probability that a window at the containment bound shares no band.
MISS = 1e-9

# Common license notices and texts.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-disclaimer": "Unless required by applicable law or agreed to in writing, software distributed under the "
                             "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
                             "either express or implied",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
           "the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                        "General Public License as published by the Free Software Foundation, either version 3 of the "
                        "License, or (at your option) any later version",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction",
    "MIT-mention": "Released under the MIT License",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "Reserved": "All rights reserved",
    "Unlicense": "This is free and unencumbered software released into the public domain",
    # Whole license texts and full notices.
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
                "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
                "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
                "conditions: The above copyright notice and this permission notice shall be included in all copies or "
                "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
                "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
                "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
                "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
                "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "BSD-2-Clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                         "provided that the following conditions are met: 1. Redistributions of source code must retain the "
                         "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions "
                         "in binary form must reproduce the above copyright notice, this list of conditions and the "
                         "following disclaimer in the documentation and/or other materials provided with the distribution. "
                         "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
                         "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
                         "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "BSD-3-Clause-endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to "
                                "endorse or promote products derived from this software without specific prior written "
                                "permission.",
    "BSD-liability": "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
                     "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
                     "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
                     "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
                     "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                "granted, provided that the above copyright notice and this permission notice appear in all copies. THE "
                "SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
                "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
                "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
                "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
                "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "Zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
                 "held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
                 "this software for any purpose, including commercial applications, and to alter it and redistribute it "
                 "freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; "
                 "you must not claim that you wrote the original software. If you use this software in a product, an "
                 "acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source "
                 "versions must be plainly marked as such, and must not be misrepresented as being the original software. "
                 "3. This notice may not be removed or altered from any source distribution.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                         "compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                         "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                         "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
                         "language governing permissions and limitations under the License.",
    "LGPL-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                   "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
                   "(at your option) any later version. This library is distributed in the hope that it will be useful, but "
                   "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
                   "PURPOSE.",
    "AGPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                       "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
                       "License, or (at your option) any later version.",
    "BSL-1.0-text": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
                    "and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
                    "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to "
                    "permit third-parties to whom the Software is furnished to do so, all subject to the following.",
    "Unlicense-text": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source "
                      "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}


def templates(spark: SparkSession, texts: dict[str, str] | None = None) -> DataFrame:
    rows = sorted((TEMPLATES if texts is None else texts).items())
    return spark.createDataFrame(rows, "license_id string, text string")


def _shingles(words, begin, end):
    """Hashes of the shingles that begin at begin .. end - 1; an empty array where there are none."""
    runs = F.transform(F.sequence(begin, end - 1), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)]))
    return F.when(end > begin, runs).otherwise(F.array().cast("array<bigint>"))


def _anchors(known: DataFrame) -> DataFrame:
    """One row for each template and band: its shingles, the band's smallest hash (NULL: none is compared) and its shingle."""
    words = with_words(known.select("license_id", "text"))
    sets = words.select("license_id", F.size("words").alias("n"), F.array_distinct(
        _shingles(F.col("words"), F.lit(0), F.size("words") - (SHINGLE - 1))).alias("template")).where(F.size("template") > 0)
    step = F.greatest(F.lit(1), F.floor(F.col("n") / 4).cast("int"))
    sets = sets.select("license_id", "template", F.size("template").alias("m"), step.alias("step"), (F.col("n") + step).alias("span"))
    # The fewest shared shingles that pass (a hair below, against rounding), in a window whose other shingles are all foreign.
    shared = F.ceil(F.col("m") * CONTAINMENT - 1e-6)
    similarity = shared / (F.col("m") + F.col("span") - (SHINGLE - 1) - shared)
    sets = sets.withColumn("count", F.ceil(F.log(F.lit(MISS)) / F.log(1 - similarity)).cast("int"))
    short = F.col("m") <= F.col("count")
    bands = sets.select("*", F.explode(F.sequence(F.lit(0), F.least("m", "count") - 1)).alias("band"))
    first = F.array_min(F.transform("template", lambda x: F.struct(F.xxhash64(x, F.col("band")).alias("hash"), x.alias("shingle"))))
    return bands.select("license_id", "template", "band", "step", "span", F.when(~short, first["hash"]).alias("least"),
                        F.when(short, F.get("template", F.col("band"))).otherwise(first["shingle"]).alias("token"))


def matching_windows(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Verified windows: doc_id, text_hash, license_id, first_word (from 0), containment. One row for each window."""
    texts = with_words(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text"))
    # Some 30 rows at most for each template that the caller names: a fixed, small table.
    met = word_runs(texts, SHINGLE).join(F.broadcast(_anchors(known)), "token")
    # All windows over the occurrence lie between these words; only their shingles go on.
    low, high = F.greatest(F.lit(0), F.col("pos") + SHINGLE - F.col("span")), F.least(F.col("pos") + F.col("span"), F.size("words"))
    met = met.select("doc_id", "text_hash", "license_id", "template", "band", "step", "span", "least", "pos",
                     low.alias("low"), _shingles(F.col("words"), low, high - (SHINGLE - 1)).alias("near"))
    first = F.ceil(F.col("low") / F.col("step")).cast("int")
    last = F.floor(F.col("pos") / F.col("step")).cast("int")
    starts = F.when(first <= last, F.transform(F.sequence(first, last), lambda k: k * F.col("step")))
    windows = met.select("*", F.explode(starts).alias("first_word"))
    held = F.slice("near", F.col("first_word") - F.col("low") + 1, F.col("span") - (SHINGLE - 1))
    hashed = windows.select("*", held.alias("shingles"))
    collides = F.col("least").isNull() | \
        (F.array_min(F.transform("shingles", lambda x: F.xxhash64(x, F.col("band")))) == F.col("least"))
    share = F.size(F.array_intersect("template", "shingles")) / F.size("template")
    verified = hashed.where(collides).select("doc_id", "text_hash", "license_id", "first_word", share.alias("containment"))
    return verified.where(F.col("containment") >= CONTAINMENT).distinct()


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Per document and license found: doc_id, license_id, containment (of the best window), first_word (of the first such).

    NULL, empty and short texts match nothing; rows that repeat id and text give one row. Templates of fewer than three
    words have no shingle and match nothing. Other columns are ignored.
    """
    best = F.min(F.struct((-F.col("containment")).alias("less"), "first_word"))
    found = matching_windows(docs, known).groupBy("doc_id", "text_hash", "license_id").agg(best.alias("best"))
    return found.select("doc_id", "license_id", (-F.col("best.less")).alias("containment"),
                        F.col("best.first_word").cast("long").alias("first_word"))
