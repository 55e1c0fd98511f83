"""Licence scan on notices that the training does not hold, on look-alikes, on very long texts."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from slotwise.llm import licences
from slotwise.llm.common import prepare

UNSEEN = [
    ("MIT", "License: MIT"), ("MIT", "MIT/X11 license"), ("GPL", "GPLv2 or later"), ("MIT", "This library is released under MIT. See LICENSE."),
    ("Apache-2.0", "Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/\n\nTERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("GPL", "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n\nCopyright (C) 2007 Free Software Foundation, Inc."),
    ("CC-BY-SA", "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
             "damages arising from the use of this software."),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"), ("EPL", "Eclipse Public License - v 1.0"),
    ("LGPL", "You can use it under the terms of the LGPL-2.1 or later"), ("BSD", "This package is BSD licensed."),
    ("MPL-2.0", "The code is available under the MPL 2.0 license."), ("GPL", "// Distributed under the GNU GPL version 2, see COPYING"),
    ("AGPL", "License: AGPL-3.0-or-later"), ("Unlicense", "This project is released under the Unlicense"), ("ISC", "ISC licensed, see below"),
    ("CC0", "Dedicated to the public domain under CC0 1.0 Universal"), ("Artistic-2.0", "the same terms as Perl: the Artistic License 2.0"),
    ("OFL-1.1", "The fonts are under the SIL Open Font License"),
]
LOOKALIKES = ["The rental company checks your driving license.", "See the license file for details.", "The MIT students won the race.",
              "She has a license to fish.", "Boost your sales with our new plan.", "The eclipse was public news.",
              "SPDX-License-Identifier: LicenseRef-Acme-1.0", "released under a new name in 2004", "He may come on Tuesday or later."]


def test_recall_on_unseen_notices_and_look_alikes(spark, sf_dir):
    prepare(spark)
    base = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    words = "en der la que tion " * 60_000
    more = [(10 ** 6 + i, t) for i, (_, t) in enumerate(UNSEEN)] + [(2 * 10 ** 6 + i, t) for i, t in enumerate(LOOKALIKES)]
    more += [(3 * 10 ** 6, f"{words}\n\nLicense: MIT\n\n{words}"), (3 * 10 ** 6 + 1, f"{words} Licensed under the Apache License, Version 2.0. {words}"), (3 * 10 ** 6 + 2, words)]
    out = licences.scan_licences(base.unionByName(spark.createDataFrame(more, "doc_id long, text string")))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    found = {r.doc_id: r.families for r in out.where("doc_id >= 1000000").collect()}
    right = sum(found[10 ** 6 + i] == [f] for i, (f, _) in enumerate(UNSEEN))
    assert right >= 0.9 * len(UNSEEN), [(f, found[10 ** 6 + i]) for i, (f, _) in enumerate(UNSEEN)]
    assert [t for i, t in enumerate(LOOKALIKES) if found[2 * 10 ** 6 + i]] == []
    assert found[3 * 10 ** 6] == ["MIT"] and found[3 * 10 ** 6 + 1] == ["Apache-2.0"] and found[3 * 10 ** 6 + 2] == []


def test_every_document_is_an_example_of_unknown_text(spark):
    """Half of 3,200 documents hold a notice word: it is no cue, whichever half a sample would read."""
    prepare(spark)
    odd = F.pmod(F.xxhash64("id"), F.lit(2)) == 1
    for half in (odd, ~odd):
        docs = spark.range(3_200).withColumn("text", F.concat_ws(" ", F.lit("en der la que tion"), F.col("id"), F.when(half, F.lit("expat"))))
        assert docs.where(half).count() > 1_000
        found = licences.Scanner(docs)
        assert "expat" not in found.cues and "gplv3" in found.cues
