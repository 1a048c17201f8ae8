"""Licence scan by sentence rules: sentences -> identifiers -> licences.

A text is cut into sentences at line ends and behind full stops, question and exclamation
marks and semicolons that white space follows.  Sentences are normalised (lower case,
``licence`` spelled ``license``, only letters, digits, dots, plus signs and hyphens kept,
``version 2`` written ``v2``, no marks at either end, nor words such as ``see the LICENSE file
for details``; an expression such as ``MIT OR Apache-2.0`` becomes one sentence for each name) and looked up among the known licence
sentences.  Each document's identifiers, in the order of its text, are then matched against
the rules, in the order of RULES: a rule whose sequence occurs names its licence, and its
sentences are used up.  Known sentences that no rule used are ``part``; sentences with the
word license or licensed that are not known count as unknown.

Licence files and source headers wrap their sentences.  Neighbouring lines that make a known
sentence together, comment leaders and empty lines left out, count as that sentence and no
longer as lines; semicolons are joined over, other sentence ends are not.  The SQL of the
query reads line by line: it gives the same where no known sentence is wrapped.

Null and empty texts have no sentence.  Every row of the input has a row in the result; rows
with one id and text share it.  Only DataFrame functions are used; the broadcast table is
the fixed list of known sentences.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known licence names and the ways to write them, normalised; fixed values.
NAMES = {
    "Apache-2.0": ["apache license v2.0", "apache license 2.0", "apache-2.0 license", "apache 2.0 license", "apache-2.0"],
    "MIT": ["mit license", "expat license", "mit"],
    "GPL-2.0": ["gnu general public license v2", "gnu general public license v2.0", "gnu gpl v2", "gpl v2", "gplv2", "gpl-2.0", "gpl-2.0-only"],
    "GPL-2.0-or-later": ["gpl-2.0-or-later", "gnu general public license v2 or later"],
    "GPL-3.0": ["gnu general public license v3", "gnu general public license v3.0", "gnu gpl v3", "gpl v3", "gplv3", "gpl-3.0", "gpl-3.0-only"],
    "GPL-3.0-or-later": ["gpl-3.0-or-later", "gnu general public license v3 or later"],
    "LGPL-2.1": ["gnu lesser general public license v2.1", "lgpl v2.1", "lgplv2.1", "lgpl-2.1", "lgpl-2.1-only"],
    "LGPL-2.1-or-later": ["lgpl-2.1-or-later"],
    "LGPL-3.0": ["gnu lesser general public license v3", "gnu lesser general public license v3.0", "lgpl v3", "lgplv3", "lgpl-3.0", "lgpl-3.0-only"],
    "LGPL-3.0-or-later": ["lgpl-3.0-or-later"],
    "AGPL-3.0": ["gnu affero general public license v3", "gnu affero general public license v3.0", "agpl v3", "agplv3", "agpl-3.0", "agpl-3.0-only"],
    "AGPL-3.0-or-later": ["agpl-3.0-or-later"],
    "MPL-2.0": ["mozilla public license v2.0", "mozilla public license 2.0", "mpl 2.0", "mpl-2.0"],
    "BSD-2-Clause": ["bsd 2-clause license", "2-clause bsd license", "simplified bsd license", "bsd-2-clause license", "bsd-2-clause"],
    "BSD-3-Clause": ["bsd 3-clause license", "3-clause bsd license", "new bsd license", "bsd-3-clause license", "bsd-3-clause"],
    "ISC": ["isc license", "isc"],
    "Unlicense": ["unlicense"],
    "BSL-1.0": ["boost software license v1.0", "boost software license 1.0", "boost software license", "bsl-1.0"],
    "Zlib": ["zlib license", "zlib"],
    "0BSD": ["bsd zero clause license", "0bsd"],
    "CC0-1.0": ["cc0", "cc0 1.0", "cc0-1.0", "cc0 1.0 universal"],
    "CC-BY-4.0": ["cc by 4.0", "cc-by-4.0", "creative commons attribution 4.0 international license"],
    "CC-BY-SA-4.0": ["cc by-sa 4.0", "cc-by-sa-4.0", "creative commons attribution-sharealike 4.0 international license"],
    "CC-BY-NC-4.0": ["cc by-nc 4.0", "cc-by-nc-4.0", "creative commons attribution-noncommercial 4.0 international license"],
    "CC-BY-ND-4.0": ["cc by-nd 4.0", "cc-by-nd-4.0", "creative commons attribution-noderivatives 4.0 international license"],
    "CC-BY-NC-SA-4.0": ["cc by-nc-sa 4.0", "cc-by-nc-sa-4.0", "creative commons attribution-noncommercial-sharealike 4.0 international license"],
}
OPENINGS = [
    "licensed under", "released under", "distributed under", "available under", "published under", "this work is licensed under",
    "this work is licensed under a", "this software is licensed under", "this project is licensed under", "this file is licensed under",
    "this content is licensed under", "this code is released under", "spdx-license-identifier",
]
# Titles of licence files that are no way of writing the name in a notice; fixed values.
TITLES = {
    "Apache-2.0": ["apache license v2.0 january 2004"],
    "MIT": ["mit license mit"],
    "GPL-2.0": ["gnu general public license v2 june 1991"],
    "GPL-3.0": ["gnu general public license v3 29 june 2007"],
    "LGPL-2.1": ["gnu lesser general public license v2.1 february 1999"],
    "LGPL-3.0": ["gnu lesser general public license v3 29 june 2007"],
    "AGPL-3.0": ["gnu affero general public license v3 19 november 2007"],
    "BSL-1.0": ["boost software license - v1.0 - august 17th 2003", "boost software license v1.0 - august 17th 2003"],
}
# Sentences of licence texts and notices; fixed values.
SENTENCES = {
    "reserved": ["all rights reserved"],
    "apache_use": ["you may not use this file except in compliance with the license"],
    "apache_copy": ["you may obtain a copy of the license at http www.apache.org licenses license-2.0"],
    "as_is": [
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
        "without warranties or conditions of any kind either express or implied",
    ],
    "limits": ["see the license for the specific language governing permissions and limitations under the license"],
    "mit_grant": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
        "the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
        "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject "
        "to the following conditions",
    ],
    "mit_notice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "bsd_grant": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd_source": [
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    ],
    "bsd_binary": [
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in "
        "the documentation and or other materials provided with the distribution",
    ],
    "bsd_names": [
        f"neither the name of {holder} nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission"
        for holder in ("the copyright holder", "the copyright holders", "the copyright owner", "the author", "the organization", "the university")
    ],
    "isc_grant": [
        f"permission to use copy modify and {way}distribute this software for any purpose with or without fee is hereby granted provided that "
        "the above copyright notice and this permission notice appear in all copies"
        for way in ("", "or ")
    ],
    "zero_grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"],
    "mpl_terms": ["this source code form is subject to the terms of the mozilla public license v"],
    "mpl_copy": [
        f"if a copy of the mpl was not distributed with this file you can obtain one at {scheme} mozilla.org mpl 2.0"
        for scheme in ("http", "https")
    ],
    "unlicense_grant": ["this is free and unencumbered software released into the public domain"],
    "boost_grant": [
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying "
        "documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to "
        "prepare derivative works of the software and to permit third-parties to whom the software is furnished to do so all subject to the following",
    ],
    "lgpl_free": ["this library is free software"],
    "lgpl_any_2.1": [
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free "
        "software foundation either v2.1 of the license or at your option any later version",
    ],
    "lgpl_any_3": [
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free "
        "software foundation either v3 of the license or at your option any later version",
    ],
    "gpl_free": ["this program is free software"],
    "gpl_any_2": [
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software "
        "foundation either v2 of the license or at your option any later version",
    ],
    "gpl_any_3": [
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software "
        "foundation either v3 of the license or at your option any later version",
    ],
}
# Licences in the order in which their sequences are tried.
RULES: list[tuple[str, list[str]]] = [
    ("Apache-2.0", ["named Apache-2.0", "apache_use", "apache_copy", "as_is", "limits"]),
    ("Apache-2.0", ["apache_use", "apache_copy"]),
    ("MIT", ["mit_grant", "mit_notice"]),
    ("MIT", ["mit_grant"]),
    ("BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_names"]),
    ("BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary"]),
    ("BSD", ["bsd_grant"]),
    ("ISC", ["isc_grant"]),
    ("0BSD", ["zero_grant"]),
    ("MPL-2.0", ["mpl_terms", "mpl_copy"]),
    ("MPL-2.0", ["mpl_copy"]),
    ("Unlicense", ["unlicense_grant"]),
    ("BSL-1.0", ["boost_grant"]),
    ("LGPL-2.1-or-later", ["lgpl_free", "lgpl_any_2.1"]),
    ("LGPL-3.0-or-later", ["lgpl_free", "lgpl_any_3"]),
    ("GPL-3.0-or-later", ["gpl_free", "gpl_any_3"]),
    ("GPL-2.0-or-later", ["gpl_free", "gpl_any_2"]),
    *[(name, [f"named {name}"]) for name in NAMES],
    *[(name, [f"title {name}"]) for name in NAMES],
    ("Proprietary", ["reserved"]),
]
END = r"[.?!;]+\s+|\n+"
# What may follow a name: where the whole licence is to be found.
SEE = r"( -)? (please )?see (the )?(accompanying )?license(.md|.txt)?( license(.md|.txt)?)?( file)?( for (more |full |further )?(details|information))?$"
SEE_BEGUN = r"( -)?( please)?( see( .*)?)?$"
VERSION = r"\bversion (?=[0-9])"
# Words of which every known sentence has one; fixed values.
HINTS = r"(?i)licen[cs]e|spdx|released|distribut|available|published|permission|reserved|free\s+software"
# The GPL's notice of version 3 has a colon where that of version 2 has a semicolon.
WRAPPED = {
    f"{SENTENCES[free][0]} {text}": [free, name]
    for free, names in {"gpl_free": ["gpl_any_2", "gpl_any_3"], "lgpl_free": ["lgpl_any_2.1", "lgpl_any_3"]}.items()
    for name in names for text in SENTENCES[name]
}


def known_sentences() -> list[tuple[str, str]]:
    """(normalised sentence, identifier): every opening before every name, titles, and sentences of licences."""
    named = {
        f"{opening} {the}{way}{called}": f"named {name}"
        for name, ways in NAMES.items() for way in ways for opening in OPENINGS for the in ("", "the ") for called in ("", " the license")
    }
    titles = {
        f"{the}{way}": f"title {name}"
        for name, ways in NAMES.items() for way in [*ways, *TITLES.get(name, [])] for the in ("", "the ") if "license" in way
    }
    return [*titles.items(), *named.items(), *((text, name) for name, texts in SENTENCES.items() for text in texts)]


def choice() -> str:
    """A pattern of sentences that name several licences: an opening (group 1) and names with or, and or slash between."""
    either = lambda texts: "|".join(t.replace(".", r"\.") for t in sorted(set(texts), key=lambda t: (-len(t), t)))
    name = f"(?:the )?(?:{either(way for ways in NAMES.values() for way in ways)})"
    return f"^({either(OPENINGS)}) {name}(?: (?:or|and) {name})+$"


def normalised(sentence: Column) -> Column:
    out = F.regexp_replace(F.lower(sentence), r"[^a-z0-9.+-]+", " ")
    out = F.regexp_replace(F.replace(out, F.lit("licence"), F.lit("license")), VERSION, "v")
    return told(F.regexp_replace(out, r"^[ .+-]+|[ .+-]+$", ""))


def told(sentence: Column) -> Column:
    """The sentence without the words that say where the licence is to be found."""
    return F.when(F.contains(sentence, F.lit(" see ")), F.regexp_replace(sentence, SEE, "")).otherwise(sentence)


def single(sentence: Column) -> Column:
    """One sentence for each licence of an expression such as ``mit or apache-2.0``, else the sentence alone."""
    several = (F.contains(sentence, F.lit(" or ")) | F.contains(sentence, F.lit(" and "))) & sentence.rlike(choice())
    opening = F.regexp_extract(sentence, choice(), 1)
    names = F.split(F.substring(sentence, F.length(opening) + 2, F.length(sentence)), " (?:or|and) ")
    return F.when(several, F.transform(names, lambda name: F.concat_ws(" ", opening, name))).otherwise(F.array(sentence))


def openings_of(sentences: list[str]) -> list[str]:
    """What sentences begin with, at ends of words; ``version`` may stand alone where a line ends behind it."""
    begun = {" ".join(words[:n]) for words in map(str.split, sentences) for n in range(1, len(words) + 1)}
    cut = {" ".join([*words[:n], "version"]) for words in map(str.split, sentences) for n, word in enumerate(words) if re.match("v[0-9]", word)}
    return sorted(begun | cut)


def wrapped(rows: DataFrame) -> DataFrame:
    """``key, first, last, ids`` for every known sentence that goes over several lines or semicolons: the places of its
    first and last line among the pieces of END, and its identifiers."""
    known = [(text, [name]) for text, name in known_sentences()] + list(WRAPPED.items())
    most = max(len(text.split()) for text, _ in known)  # lines without words are left out
    opens = sorted({" ".join(text.split()[:2]) for text, _ in known})
    begins = "^(?:" + "|".join(o.replace(".", r"\.").replace("+", r"\+") for o in opens) + ")(?: |$)"
    raws = F.split(F.regexp_replace("text", r"([.?!;]+)\s+", "$1\u0002\n"), r"\n+")  # the pieces of END, their kind of end marked
    lines = F.transform(raws, lambda raw, at: F.struct(at.alias("at"), normalised(raw).alias("sentence"), raw.rlike("[.?!]\u0002$").alias("stop")))
    held = rows.filter(F.col("text").rlike(HINTS)).select("key", F.filter(lines, lambda p: p["sentence"] != "").alias("lines")).filter(F.size("lines") > 1)
    line = lambda i: F.get(F.col("lines"), i)

    def may_begin(i: Column) -> Column:
        return ~line(i)["stop"] & F.concat_ws(" ", line(i)["sentence"], line(i + 1)["sentence"]).rlike(begins)

    begun = held.select("key", F.explode(F.transform(F.filter(F.sequence(F.lit(0), F.size("lines") - 2), may_begin), lambda i: F.slice("lines", i + 1, most))).alias("block"))
    end = F.array_position(F.transform("block", lambda p: p["stop"]), True).cast("int")
    ended = begun.withColumn("n", F.when(end > 0, end).otherwise(F.size("block")))

    # only lines that go on as a known sentence does are put together any further
    two = F.regexp_replace(F.concat_ws(" ", F.get("block", F.lit(0))["sentence"], F.get("block", F.lit(1))["sentence"]), VERSION, "v")
    begins_so = F.broadcast(rows.sparkSession.createDataFrame([(text,) for text in openings_of([text for text, _ in known])], "opening string"))
    fitting = ended.withColumn("two", F.regexp_replace(two, SEE_BEGUN, "")).join(begins_so, F.col("two") == F.col("opening"), "left_semi")

    def run(n: Column) -> Column:
        joined = F.array_join(F.transform(F.slice("block", 1, n), lambda p: p["sentence"]), " ")
        return F.struct(F.get(F.col("block"), n - 1)["at"].alias("last"), told(F.regexp_replace(joined, VERSION, "v")).alias("sentence"))

    runs = fitting.select("key", F.get(F.col("block"), F.lit(0))["at"].alias("first"), F.explode(F.transform(F.sequence(F.lit(2), F.col("n")), run)).alias("run"))
    table = F.broadcast(rows.sparkSession.createDataFrame(known, "sentence string, ids array<string>"))
    found = runs.select("key", "first", "run.*").join(table, "sentence").groupBy("key", "first").agg(F.max(F.struct("last", "ids")).alias("r"))
    longest = found.select("key", "first", "r.*")
    before = longest.select("key", F.col("first").alias("other"), F.col("last").alias("until"))
    return longest.join(before, (longest["key"] == before["key"]) & (F.col("other") < F.col("first")) & (F.col("first") <= F.col("until")), "left_anti")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, sentences, licenses, parts, unknown`` for every row: identifiers in order and licences in
    the order of RULES, each joined by ``; ``, and the numbers of unused and of unknown sentences."""
    spark = docs.sparkSession
    known = F.broadcast(spark.createDataFrame(known_sentences(), "sentence string, id string"))
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("key"), F.col(f"`{text}`").alias("text")
    )
    cut = rows.select("key", F.posexplode(F.split("text", END)).alias("at", "raw")).select("key", "at", normalised(F.col("raw")).alias("whole"))
    cut = cut.select("key", "at", F.posexplode(single(F.col("whole"))).alias("part", "sentence"))
    hits = cut.join(known, "sentence", "left").filter(F.col("id").isNotNull() | F.contains("sentence", F.lit("license")))
    over = wrapped(rows).withColumnRenamed("key", "own")
    alone = hits.join(over, (F.col("key") == F.col("own")) & F.col("at").between(F.col("first"), F.col("last")), "left_anti")
    hits = alone.select("key", F.struct("at", "part").alias("at"), "id").unionByName(
        over.select(F.col("own").alias("key"), "first", F.posexplode("ids").alias("part", "id")).select("key", F.struct(F.col("first").alias("at"), "part").alias("at"), "id")
    )
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("".join(f"<{i}>" for i in ids)).alias("ids")) for name, ids in RULES])
    start = F.struct(F.col("marks").alias("left"), F.array().cast("array<string>").alias("names"))

    def try_rule(state: Column, rule: Column) -> Column:
        fits = F.contains(state["left"], rule["ids"])
        return F.struct(
            F.replace(state["left"], rule["ids"], F.lit("|")).alias("left"),
            F.when(fits & ~F.array_contains(state["names"], rule["name"]), F.array_append(state["names"], rule["name"])).otherwise(state["names"]).alias("names"),
        )

    found = (
        hits.groupBy("key", "at").agg(F.max("id").alias("id"))
        .groupBy("key")
        .agg(
            F.array_sort(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("at", "id")))).alias("all"),
            F.count(F.when(F.col("id").isNull(), 1)).alias("unknown"),
        )
        .select("key", "unknown", F.transform("all", lambda s: s["id"]).alias("ids"))
        .withColumn("marks", F.array_join(F.transform("ids", lambda i: F.concat(F.lit("<"), i, F.lit(">"))), ""))
        .withColumn("out", F.aggregate(rules, start, try_rule))
        .select(
            "key", "unknown", F.array_join("ids", "; ").alias("sentences"), F.array_join("out.names", "; ").alias("licenses"),
            F.regexp_count("out.left", F.lit("<")).cast("long").alias("parts"),
        )
    )
    return rows.select("doc_id", "key").join(found, "key", "left").select(
        "doc_id", F.coalesce("sentences", F.lit("")).alias("sentences"), F.coalesce("licenses", F.lit("")).alias("licenses"),
        F.coalesce("parts", F.lit(0)).cast("long").alias("parts"), F.coalesce("unknown", F.lit(0)).cast("long").alias("unknown"),
    )


def scan_sql(table: str = "documents") -> str:
    """The same scan in SQL, one step for each rule."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({quote(s)}, {quote(i)})" for s, i in known_sentences())
    steps = [f"""with known(sentence, id) as (values {values}),
cut as (select doc_id, unnest(regexp_split_to_array(text, '[.?!;]+\\s+|\\n+')) as raw, unnest(range(len(regexp_split_to_array(text, '[.?!;]+\\s+|\\n+')))) as pos from {table}),
normal as (select doc_id, pos, regexp_replace(regexp_replace(replace(regexp_replace(lower(raw), '[^a-z0-9.+-]+', ' ', 'g'), 'licence', 'license'),
  '\\bversion ([0-9])', 'v\\1', 'g'), '^[ .+-]+|[ .+-]+$', '', 'g') as full_sentence from cut),
told as (select doc_id, pos, regexp_replace(full_sentence, {quote(SEE)}, '') as whole from normal),
lists as (select doc_id, pos, case when regexp_matches(whole, {quote(choice())}) then list_transform(
    regexp_split_to_array(substr(whole, length(regexp_extract(whole, {quote(choice())}, 1)) + 2), ' (?:or|and) '),
    lambda name: regexp_extract(whole, {quote(choice())}, 1) || ' ' || name) else [whole] end as sentences from told),
plain as (select doc_id, pos, unnest(range(len(sentences))) as part, unnest(sentences) as sentence from lists),
hits as (select doc_id, pos, part, sentence, id from plain left join known using (sentence) where id is not null or sentence like '%license%'),
r0 as (select doc_id, string_agg(id, '; ' order by pos, part) as sentences, count(*) filter (id is null) as unknown,
  coalesce(string_agg('<' || id || '>', '' order by pos, part) , '') as seq, []::varchar[] as names from hits group by doc_id)"""]
    for k, (name, ids) in enumerate(RULES, 1):
        mark = quote("".join(f"<{i}>" for i in ids))
        steps.append(
            f"r{k} as (select doc_id, sentences, unknown, replace(seq, {mark}, '|') as seq, case when contains(seq, {mark}) and not "
            f"list_contains(names, {quote(name)}) then list_append(names, {quote(name)}) else names end as names from r{k - 1})"
        )
    return ",\n".join(steps) + f"""
select d.doc_id, coalesce(sentences, '') as sentences, coalesce(array_to_string(names, '; '), '') as licenses,
  cast(coalesce(len(regexp_extract_all(seq, '<')), 0) as bigint) as parts, cast(coalesce(unknown, 0) as bigint) as unknown
from {table} d left join r{len(RULES)} r using (doc_id)"""
