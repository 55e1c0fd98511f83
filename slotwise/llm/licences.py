"""Licence scan with DataFrame operations only: a trained paragraph classifier.

1. Paragraphs (up to a line without letters and digits; wrapped lines and their comment marks
   are joined) are cut into windows of ``WINDOW`` words, half overlapping, so a notice inside a very
   long paragraph is seen whole. Words are letters and digits with inner dots.
2. Features are word n-grams (1 to 3, present or not) of the notices below that hold a cue: a
   notice word found in at most ``CUE_SHARE`` of the windows of the corpus. A window
   without a cue has no feature and is unknown; one regular expression finds those first.
3. A multinomial logistic regression with an L1 share (sparse weights) over the licence families and
   "unknown" is trained on thinned and embedded variants of the notices, on fragments of them,
   and on all windows of the corpus outside paragraphs that speak of licences (those of equal features are one
   example; all together weigh as ``BENIGN`` at most, each the same). A second logistic regression on
   variants kept out of the first turns the lead over "unknown" into a calibrated probability.
4. Every family counts whose calibrated probability is at least ``CERTAIN`` and that a template
   confirms: all word pairs of a short notice (names of the family in customary forms, with versions), or
   at least ``CONFIRM`` of those of a longer one, stand in the window. A family whose pairs there, apart from
   version numbers, are all pairs of another such family gives way to it (GPL to LGPL).

Weights and notices are tables of a fixed size, built from literals; every document is scanned
whole. Rows are reduced to found windows before anything is shuffled.

Defined results: null and empty texts hold no licence; rows of one id are one document (null
ids together); an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import json
import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm.common import cut, prepare, query, table

WINDOW, STRIDE = 64, 32
#: A word is no cue if more than COMMON windows and more than CUE_SHARE of all hold it.
COMMON, CUE_SHARE = 5, 0.005
#: Weight of a window as an example, and of all windows at most; documents that fillers of the variants are taken from.
BENIGN_SHARE, BENIGN, FILLER_DOCS = 0.2, 6_000, 1_500
CERTAIN, CONFIRM = 0.5, 0.6
UNKNOWN = "unknown"
#: Between paragraphs: lines without letters and digits. Comment marks made of letters.
PARAGRAPH = r"\r?\n(?:[^\p{L}\p{N}\n]*+\n)+"
MARKS = r"(?i)(^|\n)[ \t]*(?:rem|dnl)(?=[ \t])"

# Customary short notices and opening words of well-known licences, by family.
NOTICES: dict[str, list[str]] = {
    "AGPL": ["Licensed under the GNU Affero General Public License, version 3.",
             "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
             "Affero General Public License as published by the Free Software Foundation.",
             "SPDX-License-Identifier: AGPL-3.0-only"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License.",
                   "Released under the Apache 2.0 License.", "SPDX-License-Identifier: Apache-2.0"],
    "BSD": ["Released under the BSD License.", "Licensed under the 3-Clause BSD License.",
            "Licensed under the 2-Clause BSD License.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met.", "SPDX-License-Identifier: BSD-3-Clause"],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 "
              "International License.", "SPDX-License-Identifier: CC-BY-4.0"],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons "
                 "Attribution-NonCommercial 4.0 International License.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons "
                 "Attribution-ShareAlike 4.0 International License.", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related rights to this work.",
            "Released under CC0 1.0 Universal.", "SPDX-License-Identifier: CC0-1.0"],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.",
            "Licensed under the GNU General Public License, version 2.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation.",
            "Released under the GPLv3.", "SPDX-License-Identifier: GPL-3.0-only"],
    "ISC": ["Released under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for "
            "any purpose with or without fee is hereby granted.", "SPDX-License-Identifier: ISC"],
    "LGPL": ["Licensed under the GNU Lesser General Public License, version 3.",
             "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
             "Lesser General Public License as published by the Free Software Foundation.",
             "SPDX-License-Identifier: LGPL-3.0-only"],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files.", "SPDX-License-Identifier: MIT"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "Proprietary": ["All rights reserved.", "Copyright. All rights reserved.",
                    "No part of this publication may be reproduced or transmitted without prior written permission."],
    "Unlicense": ["This is free and unencumbered software released into the public domain.",
                  "Released under the Unlicense.", "SPDX-License-Identifier: Unlicense"],
}
# Short names of the families (FORMS are made of them), and their full names, which
# say enough by themselves.
SHORT_NAMES: dict[str, list[str]] = {
    "AGPL": ["AGPL", "AGPLv3", "AGPL-3.0", "GNU AGPL"], "Apache-2.0": ["Apache", "Apache 2.0", "Apache-2.0", "ASL 2.0"],
    "Artistic-2.0": ["Artistic 2.0", "Artistic-2.0"], "BSD": ["BSD", "BSD-2-Clause", "BSD-3-Clause", "New BSD", "Simplified BSD"],
    "BSL-1.0": ["Boost", "BSL-1.0"], "CC-BY": ["CC BY", "CC BY 3.0", "CC BY 4.0"], "CC-BY-NC": ["CC BY-NC", "CC BY-NC 4.0"],
    "CC-BY-SA": ["CC BY-SA", "CC BY-SA 3.0", "CC BY-SA 4.0"], "CC0": ["CC0", "CC0 1.0"], "EPL": ["EPL", "EPL-1.0", "EPL-2.0", "EPL 2.0"],
    "GPL": ["GPL", "GPLv2", "GPLv3", "GNU GPL", "GPL-2.0", "GPL-3.0", "GPL version 2", "GPL version 3"], "ISC": ["ISC"],
    "LGPL": ["LGPL", "LGPLv2.1", "LGPLv3", "GNU LGPL", "LGPL-2.1", "LGPL-3.0"], "MIT": ["MIT", "MIT/X11", "Expat", "MIT/Expat"],
    "MPL-2.0": ["MPL", "MPL 2.0", "MPL-2.0"], "OFL-1.1": ["OFL", "OFL-1.1"], "Unlicense": ["Unlicense"],
    "WTFPL": ["WTFPL"], "Zlib": ["zlib", "zlib/libpng"],
}
LATER = ("GPL", "LGPL", "AGPL")            # families named with "or later"
FULL_NAMES: dict[str, list[str]] = {
    "AGPL": ["GNU Affero General Public License"], "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache Software License"],
    "Artistic-2.0": ["Artistic License 2.0", "The Artistic License"], "BSD": ["Berkeley Software Distribution License"],
    "BSL-1.0": ["Boost Software License"], "CC-BY": ["Creative Commons Attribution License", "Creative Commons Attribution 4.0", "Creative Commons Attribution 3.0"],
    "CC-BY-NC": ["Creative Commons Attribution-NonCommercial"], "CC-BY-SA": ["Creative Commons Attribution-ShareAlike", "Creative Commons Attribution Share Alike"],
    "CC0": ["Creative Commons Zero", "CC0 1.0 Universal"], "EPL": ["Eclipse Public License"],
    "GPL": ["GNU General Public License"], "LGPL": ["GNU Lesser General Public License", "GNU Library General Public License"],
    "MPL-2.0": ["Mozilla Public License"], "OFL-1.1": ["SIL Open Font License"], "WTFPL": ["Do What The Fuck You Want To Public License"],
    "Zlib": ["zlib License"],
}
FORMS = ["License: {}", "{} license", "{} licensed", "licensed under {}", "licensed under the {}", "released under {}", "released under the {}",
         "available under the {}", "distributed under {}", "distributed under the {}", "under the terms of the {}", "SPDX-License-Identifier: {}"]
# Opening sentences of further families.
NOTICES |= {
    "Zlib": ["This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable "
             "for any damages arising from the use of this software."],
    "BSL-1.0": ["Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
                "accompanying documentation covered by this license", "Distributed under the Boost Software License, Version 1.0."],
    "EPL": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License"],
    "OFL-1.1": ["This Font Software is licensed under the SIL Open Font License, Version 1.1."],
    "WTFPL": ["Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is "
              "allowed as long as the name is changed."],
    "Artistic-2.0": ["The intent is that the Copyright Holder maintains some artistic control over the development of that Package"],
}
#: Notices of up to so many words must stand in a window as a whole.
WHOLE = 7


def named_notices() -> list[tuple[str, str]]:
    """(family, notice) made of the names: full names as they are, short ones in every form."""
    out = [(f, n) for f, names in FULL_NAMES.items() for n in names]
    out += [(f, form.format(n)) for f, names in SHORT_NAMES.items() for n in names for form in FORMS]
    out += [(f, f"{n} or later") for f in LATER for n in SHORT_NAMES[f]] + [(f, f"{n}+") for f in LATER for n in SHORT_NAMES[f] if n[-1].isdigit()]
    return list(dict.fromkeys(out))


# Sentences that share words with notices and are none.
OTHERS = [
    "A valid driving license is required to rent a car.", "The restaurant lost its liquor license last year.",
    "Copyright law protects authors for many years after their death.", "Students at MIT released a new report.",
    "An Apache helicopter was seen near the border.", "The new version of the game is out for the general public.",
    "All seats are reserved.", "The union fights for the rights of all workers.", "He asked for permission to leave.",
    "You may not use this room without a key.", "Public records are free to use for any person.",
    "License: see the file", "See LICENSE for details.", "The license of the driver was revoked.", "licensed under the state law",
    "released under pressure", "SPDX-License-Identifier: LicenseRef-Custom", "available under the counter", "distributed under the table",
    "The rocket's boost stage fell into the sea.", "A solar eclipse will be seen by the public.", "He will come on Monday or later.",
    "The general public may apply for a license later.", "creative work in common places", "The artistic director took a license with the text.",
    "Published under the name of another person.", "The patent was licensed to a foreign company.", "Mozilla and Apache are names of projects.",
    "The work was published by the foundation under its terms.", "Redistribution of wealth was the subject of the debate.",
]


def _literal(spark: SparkSession, rows: list, ddl: str) -> DataFrame:
    """A small table as a literal of the plan."""
    parsed = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{ddl}>>")
    return spark.range(1, numPartitions=1).select(F.explode(parsed).alias("r")).select("r.*")


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+(?:\.[\p{L}\p{N}]+)*)"), 1)


def _grams(tokens: Column, n: int) -> Column:
    last = F.size(tokens) - n
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                                         lambda i: F.array_join(F.slice(tokens, i + 1, n), " "))) \
        .otherwise(F.array().cast("array<string>"))


def grams(tokens: Column, cues: list[str]) -> Column:
    """Distinct 1- to 3-grams that hold a cue."""
    all_ = F.array_distinct(F.concat(*(_grams(tokens, n) for n in (1, 2, 3))))
    return F.filter(all_, lambda g: F.arrays_overlap(F.split(g, " "), F.array(*map(F.lit, cues))))


def _windows(tokens: Column) -> Column:
    """The windows of a list of words; the list is bound to a variable, so that it is made
    once and not once per window."""
    def cut_up(bound: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(bound) - STRIDE, F.lit(1)) - 1, F.lit(STRIDE))
        return F.transform(starts, lambda s: F.slice(bound, s + 1, WINDOW))
    return F.flatten(F.transform(F.array(tokens), cut_up))


def _plain() -> Column:
    """Whether a paragraph does not speak of licences: its windows are examples of unknown text."""
    return ~F.col("line").rlike(r"(?i)licen[sc]|copyright|reserved|warrant|spdx|permission")


def _paragraphs(docs: DataFrame, found: Column | None = None, marked: bool = False) -> DataFrame:
    """id, par, at, tokens: the windows of the paragraphs for which ``found`` holds; ``marked``: and
    whether the paragraph is plain."""
    lines = docs.select("id", F.posexplode(F.split("text", PARAGRAPH)).alias("par", "line")) \
        .withColumn("line", F.regexp_replace("line", MARKS, "$1"))
    if found is not None:
        lines = lines.where(found)
    lines = lines.withColumn("plain", _plain()) if marked else lines
    return lines.select("id", "par", *(["plain"] if marked else []), F.posexplode(_windows(words(F.col("line")))).alias("at", "tokens")) \
        .where(F.size("tokens") > 0)


class Scanner:
    """Cues, weights and calibration, all of a fixed size."""

    def __init__(self, docs: DataFrame) -> None:
        """``docs``: id, text."""
        spark = prepare(docs.sparkSession)
        self.families = sorted(NOTICES)
        notices = [(f, k, t, 80) for f in self.families for k, t in enumerate(NOTICES[f])]
        notices += [(f, 1000 + k, t, 25) for k, (f, t) in enumerate(named_notices())]
        # `variants` of each are made for the training; those from number 60 on are fragments
        self.notices = _literal(spark, [{"family": f, "notice": k, "line": t, "variants": v} for f, k, t, v in notices],
                                "family string, notice int, line string, variants int") \
            .select("family", "notice", words(F.col("line")).alias("tokens"), "variants")

        vocabulary = sorted(r["w"] for r in self.notices.select(F.explode("tokens").alias("w")).distinct().collect())   # words of the notices
        held = F.array_distinct(F.filter("tokens", lambda w: w.isin(vocabulary)))
        found = _paragraphs(docs, _plain()).select(F.explode(F.concat(F.array(F.lit("")), held)).alias("w")) \
            .groupBy("w").agg(F.count(F.lit(1)).alias("df")).collect()                          # "": of all windows
        seen = {r["w"]: r["df"] for r in found}
        n = seen.pop("", 0)
        self.cues = [w for w in vocabulary if seen.get(w, 0) <= max(COMMON, CUE_SHARE * n)]
        self.pattern = r"(?i)(?<![\p{L}\p{N}])(?:" + "|".join(map(re.escape, self.cues)) + r")(?![\p{L}\p{N}])"

        # variants: kept, thinned by up to a quarter, embedded in other words; fragments are unknown
        def thin(r: Column, tokens: Column) -> Column:
            drop = F.when(r % 30 == 0, F.lit(0)).when(r < 60, r % 25).otherwise(F.lit(75))
            return F.filter(tokens, lambda w, i: F.pmod(F.xxhash64(w, i, r), F.lit(100)) >= drop)

        variants = self.notices.withColumn("r", F.explode(F.sequence(F.lit(0), F.col("variants") - 1)))
        every = max(1, docs.count() // FILLER_DOCS)                                             # a window for each slot is needed, no more
        fillers = _paragraphs(docs.where(F.pmod(F.xxhash64("id"), F.lit(every)) == 0), _plain()) \
            .select(F.pmod(F.xxhash64("tokens"), F.lit(997)).alias("slot"), "tokens").groupBy("slot").agg(F.min("tokens").alias("filler"))
        variants = variants.withColumn("slot", F.pmod(F.xxhash64("family", "notice", "r"), F.lit(997))) \
            .join(fillers, "slot", "left")
        some = F.slice(F.coalesce("filler", F.array().cast("array<string>")), F.lit(1), F.pmod(F.col("r"), F.lit(20)))
        known = variants.select(F.when(F.col("r") < 60, F.col("family")).otherwise(F.lit(UNKNOWN)).alias("family"),
                                F.concat(some, F.when(F.size("tokens") <= WHOLE, F.when(F.col("r") < 60, F.col("tokens")).otherwise(
                                    F.slice("tokens", 1, 1))).otherwise(thin(F.col("r"), F.col("tokens")))).alias("tokens"), "r")
        others = _literal(spark, [{"line": t} for t in OTHERS], "line string") \
            .withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(79)))) \
            .select(F.lit(UNKNOWN).alias("family"), thin(F.pmod(F.col("r"), F.lit(60)), words(F.col("line"))).alias("tokens"), "r")
        examples = known.unionByName(others).select("r", "family", grams(F.col("tokens"), self.cues).alias("grams"), F.lit(1.0).alias("weight"))
        vocab = self.notices.select(F.explode(grams(F.col("tokens"), self.cues)).alias("g")).distinct()
        self.features = sorted(r["g"] for r in vocab.collect())                               # n-grams of the notices
        # unknown windows of equal features are one example of their weight, with BENIGN for all at most
        self.docs, self.windows = docs, self._cued(docs)
        rest = self.windows.where("plain").select(F.array_sort(F.filter("grams", lambda g: g.isin(self.features))).alias("grams")) \
            .groupBy("grams").agg(F.count(F.lit(1)).alias("n"))
        rest = cut(rest, "licence-benign")
        cued = rest.agg(F.sum("n")).first()[0] or 0
        rest = rest.unionByName(_literal(spark, [{"n": n - cued}], "n long").select(F.array().cast("array<string>").alias("grams"), "n")) \
            .select(F.pmod(F.xxhash64("grams"), F.lit(80)).cast("int").alias("r"), F.lit(UNKNOWN).alias("family"), "grams",
                    (F.col("n") * min(BENIGN_SHARE, BENIGN / max(1, n))).alias("weight")).where("weight > 0")
        examples = examples.unionByName(rest).withColumn(
            "label", (F.array_position(F.array(*map(F.lit, [*self.families, UNKNOWN])), F.col("family")) - 1).cast("double"))
        examples = cut(examples, "licence-examples")

        vector = CountVectorizerModel.from_vocabulary(self.features, "grams", "x", minTF=1.0)
        data = vector.transform(examples)
        first = LogisticRegression(featuresCol="x", labelCol="label", weightCol="weight", family="multinomial", regParam=5e-4,
                                   elasticNetParam=0.5, maxIter=80, standardization=False).fit(data.where("r % 5 <> 4"))
        matrix, self.bias = first.coefficientMatrix.toArray(), [float(b) for b in first.interceptVector]
        self.weights = [{"g": g, "w": [float(x) for x in matrix[:, i]]} for i, g in enumerate(self.features) if matrix[:, i].any()]
        raw = vector_to_array("rawPrediction")
        lead = first.transform(data.where("r % 5 = 4")).select(
            "weight", (F.col("label") < len(self.families)).cast("double").alias("known"),
            (F.array_max(F.slice(raw, 1, len(self.families))) - raw[len(self.families)]).alias("lead"))
        curve = LogisticRegression(featuresCol="x", labelCol="known", weightCol="weight", regParam=1e-3).fit(
            VectorAssembler(inputCols=["lead"], outputCol="x").transform(lead))
        self.slope, self.offset = float(curve.coefficients[0]), float(curve.intercept)

    def _cued(self, docs: DataFrame) -> DataFrame:
        """id, par, plain, at, tokens, key, grams: the windows that hold a cue, written once."""
        windows = _paragraphs(docs.where(F.col("text").rlike(self.pattern)), F.col("line").rlike(self.pattern), marked=True)
        windows = windows.where(F.arrays_overlap("tokens", F.array(*map(F.lit, self.cues)).cast("array<string>")))
        return cut(windows.select("id", "par", "plain", "at", "tokens", F.xxhash64("id", "par", "at", "tokens").alias("key"))
                   .withColumn("grams", grams(F.col("tokens"), self.cues)).where(F.size("grams") > 0), "licence-windows")

    def scan(self, docs: DataFrame) -> DataFrame:
        """id, par, at (window in the paragraph), family, probability, confirmed (largest share
        of a notice's word pairs), for each window that is a notice."""
        spark = docs.sparkSession
        windows = self.windows if docs is self.docs else self._cued(docs)
        # weights and notices have the size of the literals above
        weights = F.broadcast(_literal(spark, self.weights, "g string, w array<double>"))
        classes = [*self.families, UNKNOWN]
        texts = windows.groupBy("tokens").agg(F.first("grams").alias("grams"))       # equal windows are judged once
        logits = texts.select("tokens", F.explode("grams").alias("g")).join(weights, "g").groupBy("tokens") \
            .agg(*(F.sum(F.col("w")[c]).alias(f"s{c}") for c in range(len(classes))))
        scores = F.array(*(F.struct((F.col(f"s{c}") + self.bias[c]).alias("s"), F.lit(f).alias("family"))
                           for c, f in enumerate(self.families)))
        lead = F.col("one.s") - F.col("unknown") - self.bias[-1]
        judged = logits.select("tokens", F.col(f"s{len(self.families)}").alias("unknown"), F.explode(scores).alias("one")) \
            .select("tokens", F.col("one.family").alias("family"),
                    (1 / (1 + F.exp(-(self.slope * lead + self.offset)))).alias("probability")) \
            .where(F.col("probability") >= CERTAIN)
        pairs = self.notices.withColumn("pair", F.array_distinct(_grams(F.col("tokens"), 2))) \
            .withColumn("pair", F.when(F.size("pair") > 0, F.col("pair")).otherwise(F.col("tokens")))
        # short notices must stand there whole, of longer ones CONFIRM of the pairs
        pairs = F.broadcast(pairs.select("family", F.col("pair").alias("own"),
                                         F.when(F.size("tokens") <= WHOLE, 1.0).otherwise(CONFIRM).alias("needed")))
        held = F.array_intersect("own", "have")
        confirmed = judged.withColumn("have", F.concat(_grams(F.col("tokens"), 2), F.col("tokens"))) \
            .join(pairs, "family").withColumn("held", held).withColumn("share", F.size("held") / F.size("own")) \
            .where(F.col("share") >= F.col("needed")).groupBy("tokens", "family", "probability") \
            .agg(F.max("share").alias("confirmed"), F.array_distinct(F.flatten(F.collect_list("held"))).alias("held"))
        # at most one row per family in a group
        found = confirmed.withColumn("told", F.filter("held", lambda pair: ~pair.startswith("version "))).groupBy("tokens") \
            .agg(F.collect_list(F.struct("family", "probability", "confirmed", "held", "told")).alias("all"))

        def wider(one: Column, other: Column) -> Column:
            """Whether ``other`` holds all pairs of ``one`` and more, or as many with more certainty."""
            more = F.struct(F.size(other["told"]), F.size(other["held"]), other["probability"], other["family"]) > \
                F.struct(F.size(one["told"]), F.size(one["held"]), one["probability"], one["family"])
            return (F.size(F.array_except(one["told"], other["told"])) == 0) & more

        confirmed = found.select("tokens", F.explode(F.filter("all", lambda one: ~F.exists("all", lambda other: wider(one, other)))).alias("f")) \
            .select("tokens", "f.family", "f.probability", "f.confirmed")
        return windows.join(confirmed, "tokens").select("id", "par", "at", "family", "probability", "confirmed")


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, families (sorted, distinct), n_notices (paragraphs with a
    notice), probability (largest; 0 without one)."""
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = Scanner(narrow).scan(narrow)
    found = found.groupBy("id", "par", "family").agg(F.max("probability").alias("probability"))
    rows = narrow.select("id", F.lit(None).cast("int").alias("par"), F.lit(None).cast("string").alias("family"),
                         F.lit(0.0).alias("probability")).unionByName(found)
    return rows.groupBy(F.col("id").alias("doc_id")).agg(
        F.sort_array(F.collect_set("family")).alias("families"),
        F.count_distinct("par").alias("n_notices"), F.max("probability").alias("probability"))


@query("op10_licences")
def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents"))
