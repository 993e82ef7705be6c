from __future__ import annotations

import pytest

from barloom.llm import licenses
from compare import rows

APACHE = """# Copyright 2020 Someone
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
import os"""
CASES = [
    ("Licensed under CC BY 4.0", "cc-by"),
    ("Licensed under CC BY-SA 4.0", "cc-by-sa,cc-by"),
    ("licensed under the GNU General Public License", "gpl"),
    ("released under the GPL license", "gpl"),
    ("Use of this source code is governed by a proprietary license", "proprietary"),
    ("Released under the\nMIT License", "mit"),
    (APACHE, "apache-2.0"),
    ("/* Released under\n * the MIT\n * License */\nint main;", "mit"),
    ("licensed under the GNU Lesser General Public License", "gpl,lgpl"),
    ("We released the song under the license of the label.", ""),
    ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:", "bsd"),
    ("The MIT campus.\n\nReleased under the license.", ""),
    ("Licensed under CC BY-NC-SA 4.0", "cc-by-nc-sa,cc-by"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "cc-by-nc-sa"),
    ("// SPDX-License-Identifier: MIT\nint main;", "mit"),
    ("# SPDX-License-Identifier: MIT OR Apache-2.0", "mit,apache-2.0"),
    ("SPDX-License-Identifier: LGPL-2.1-or-later", "lgpl"),
    ("SPDX-License-Identifier: CC-BY-SA-4.0", "cc-by-sa,cc-by"),
    ("GPLv3", "gpl"),
    ("Licensed under MPL 2.0", "mpl-2.0"),
    ("governed by a proprietary license", "proprietary"),
    ("GNU AFFERO GENERAL PUBLIC LICENSE Version 3", "gpl,agpl"),
    ("Apache License\nVersion 2.0, January 2004", "apache-2.0"),
    ("The general public met a gnu.", ""),
    ("", ""),
]


def test_labels_of_notices(spark):
    """The base phrases give cc-by and gpl where they stand; the templates give one label a block."""
    df = spark.createDataFrame([(i, t, 1) for i, (t, _) in enumerate(CASES)], "doc_id long, text string, Labels int")
    found = {r["doc_id"]: r["labels"] for r in licenses.scan(df).collect()}
    assert {i: set(filter(None, v.split(","))) for i, v in found.items()} == {i: set(filter(None, want.split(","))) for i, (_, want) in enumerate(CASES)}


def test_cases_equal_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    texts = [t for t, _ in CASES] + [None, "\n\n#\n\n", "a\n \n* \nb. c! d", "All rights\n\nreserved", "All rights reserved" * 2, "Ä ß İ licensed under cc by-nc 4.0?\nx"]
    df = spark.createDataFrame(list(enumerate(texts)) + [(3, texts[3]), (None, texts[2])], "doc_id long, text string")
    pdf = df.toPandas()
    con = duckdb.connect()
    con.register("given", pdf)
    con.execute("create view documents as select doc_id::BIGINT as doc_id, text from given")
    got, cursor = licenses.scan(df), con.execute(licenses.sql())
    names = [d[0] for d in cursor.description]
    assert rows(got.columns, got.collect()) == rows(names, cursor.fetchall())
