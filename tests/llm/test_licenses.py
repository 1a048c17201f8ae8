import time

import duckdb

from flowmedallion.llm.licenses import SENTENCES, scan, scan_sql

APACHE = """   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"""
MIT = "// Permission is hereby granted, " + SENTENCES["mit_grant"][0].split("granted ")[1] + ":\n# The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
CASES = [
    ("Words. Released under the MIT License. All rights reserved.", "named MIT; reserved", "MIT; Proprietary", 0, 0),
    ("x\nThis work is licensed under the GNU General Public Licence, version 3.\ny", "named GPL-3.0", "GPL-3.0", 0, 0),
    ("Licensed under CC BY-NC 4.0.", "named CC-BY-NC-4.0", "CC-BY-NC-4.0", 0, 0),
    ("SPDX-License-Identifier: Apache-2.0", "named Apache-2.0", "Apache-2.0", 0, 0),
    (MIT, "mit_grant; mit_notice", "MIT", 0, 0),
    ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", "mit_notice", "", 1, 0),
    ("You need a license to drive. Mit", "", "", 0, 1),
    ("All rights reserved\nAll rights reserved!", "reserved; reserved", "Proprietary", 0, 0),
    ("no such thing", "", "", 0, 0),
    ("", "", "", 0, 0),
    (None, "", "", 0, 0),
]


def spark_rows(spark, rows):
    out = scan(spark.createDataFrame(rows, "doc_id long, text string, sentence string, id int"))
    return sorted(((r.doc_id, r.sentences, r.licenses, r.parts, r.unknown) for r in out.collect()), key=str)


def test_cases(spark):
    rows = [(i, case[0], "x", 1) for i, case in enumerate(CASES)]
    assert spark_rows(spark, rows) == sorted(((i, *case[1:]) for i, case in enumerate(CASES)), key=str)


def test_notice_over_lines_equals_sql(spark):
    texts = [case[0] for case in CASES] + [APACHE, APACHE.replace("\n", " "), APACHE + "\n" + MIT, " ".join(filter(None, (c[0] for c in CASES)))]
    rows = [(i, text, "x", 1) for i, text in enumerate(texts)]
    connection = duckdb.connect()
    connection.execute("create table documents(doc_id bigint, text varchar)")
    connection.executemany("insert into documents values (?, ?)", [row[:2] for row in rows])
    expected = sorted(connection.execute(f"select doc_id, sentences, licenses, parts, unknown from ({scan_sql()})").fetchall(), key=str)
    assert spark_rows(spark, rows) == expected


def test_odd_rows(spark):
    rows = [(1, "Released under the MIT License.", None, None)] * 2 + [(None, "All rights reserved.", None, None), (None, None, None, None)]
    assert sorted(r[2] for r in spark_rows(spark, rows)) == ["", "MIT", "MIT", "Proprietary"]
    assert spark_rows(spark, []) == []


MIT_FILE = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
APACHE_HEADER = """# Copyright 2020 Some One
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
import os
"""
BSD_HEADER = """;; Redistribution and use in source and binary forms, with or without
;; modification, are permitted provided that the following conditions
;; are met:
;; 1. Redistributions of source code must retain the above copyright notice.
"""
GPL_2 = """ * This program is free software; you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation; either version 2 of the License, or
 * (at your option) any later version.
"""
GPL_3 = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.
"""
WRAPPED_CASES = [
    (MIT_FILE, "title MIT; mit_grant; mit_notice", "MIT", 0, 0),
    (APACHE_HEADER, "named Apache-2.0; apache_use; apache_copy; as_is; limits", "Apache-2.0", 0, 0),
    (BSD_HEADER, "bsd_grant", "BSD", 0, 0),
    (GPL_2, "gpl_free; gpl_any_2", "GPL-2.0-or-later", 0, 0),
    (GPL_3, "gpl_free; gpl_any_3", "GPL-3.0-or-later", 0, 0),
    ("x\nReleased under the GNU\nGeneral Public License, version\n3\ny", "named GPL-3.0", "GPL-3.0", 0, 0),
    ("This work is\nlicensed under\nCC0\n1.0 Universal", "named CC0-1.0", "CC0-1.0", 0, 0),
    ("All rights! \nReserved", "", "", 0, 0),
    ("All rights. \nReserved", "", "", 0, 0),
]


def test_wrapped_notices(spark):
    rows = [(i, case[0], "x", 1) for i, case in enumerate(WRAPPED_CASES)]
    assert spark_rows(spark, rows) == sorted(((i, *case[1:]) for i, case in enumerate(WRAPPED_CASES)), key=str)


NOTICES = [
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\n"
     "copyright notice and this permission notice appear in all copies.", "ISC"),
    ("/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n"
     " * file, You can obtain one at https://mozilla.org/MPL/2.0/. */", "MPL-2.0"),
    ("# This library is free software; you can redistribute it and/or\n# modify it under the terms of the GNU Lesser General Public\n"
     "# License as published by the Free Software Foundation; either\n# version 2.1 of the License, or (at your option) any later version.", "LGPL-2.1-or-later"),
    ("This is free and unencumbered software released into the public domain.", "Unlicense"),
    ("// SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0"),
    ("SPDX-License-Identifier: GPL-3.0-or-later", "GPL-3.0-or-later"),
    ("# SPDX-License-Identifier: MIT OR Apache-2.0", "Apache-2.0; MIT"),
    ("SPDX-License-Identifier: (MIT AND BSD-3-Clause)", "MIT; BSD-3-Clause"),
    ("Distributed under the Boost Software License, Version 1.0.", "BSL-1.0"),
    ("MIT License", "MIT"),
    ("The MIT License (MIT)", "MIT"),
    ("                                 Apache License\n                           Version 2.0, January 2004\n", "Apache-2.0"),
    ("GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007", "GPL-3.0"),
    ('Licensed under the MIT license (the "License").', "MIT"),
    ("This project is licensed under the MIT License - see the LICENSE file for details.", "MIT"),
    ("This project is licensed under the MIT License - see the\n[LICENSE.md](LICENSE.md) file for details.", "MIT"),
    ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n"
     "1. Redistributions of source code must retain the above copyright notice,\n   this list of conditions and the following disclaimer.\n"
     "2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following disclaimer in the\n"
     "   documentation and/or other materials provided with the distribution.\n", "BSD-2-Clause"),
    ("They are licensed and insured, see the office for details. Mit or isc.", ""),
    ("It is licensed under terms or conditions of its own.", ""),
]


def test_common_notices(spark):
    three = NOTICES[-3][0] + (
        "3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n"
        "   this software without specific prior written permission.\n"
    )
    cases = [*NOTICES, (three, "BSD-3-Clause")]
    found = {r[0]: r[2] for r in spark_rows(spark, [(i, text, "x", 1) for i, (text, _) in enumerate(cases)])}
    assert found == {i: licenses for i, (_, licenses) in enumerate(cases)}


def test_notices_on_one_line_equal_sql(spark):
    rows = [(i, text, "x", 1) for i, (text, _) in enumerate(NOTICES) if "\n" not in text]
    connection = duckdb.connect()
    connection.execute("create table documents(doc_id bigint, text varchar)")
    connection.executemany("insert into documents values (?, ?)", [row[:2] for row in rows])
    expected = sorted(connection.execute(f"select doc_id, sentences, licenses, parts, unknown from ({scan_sql()})").fetchall(), key=str)
    assert spark_rows(spark, rows) == expected


def test_very_long_texts(spark):
    """Many lines that may each begin a sentence, and a notice behind them."""
    text = "This software is licensed under the\n" * 8000 + "MIT License."
    scan(spark.createDataFrame([(0, "x")], "doc_id long, text string")).collect()
    began = time.time()
    (row,) = scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert (row.sentences, row.licenses, row.unknown) == ("named MIT", "MIT", 7999) and time.time() - began < 30
