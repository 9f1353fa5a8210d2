"""License recognition by sentences, in DataFrame functions only.

A text is cut into sentences: after ``.``, ``!``, ``?``, ``:`` or ``;`` followed by white space, and at
line ends, except where a line that does not end in such a mark runs on in lower case, or with a word
of a licence's name, on the next (wrapped notices). The colon of an SPDX tag cuts nothing: tag and expression are one sentence, so ``MIT
OR Apache-2.0`` is never taken for its first half. A sentence is normalised: lower case, comment marks and quotes dropped, runs of
other characters than letters, digits, ``.``, ``-`` and ``+`` made one space, outer spaces and dots
trimmed. ``SENTENCES`` maps normalised sentences to known licence-sentence identifiers; ``RULES``
are ordered identifier sequences. Rules are tried in order, each consumes the identifiers it
matched, and what is left is reported as unmatched. Both tables are small constants that travel in
the plan, so the scan is a projection: no join, no shuffle, one row per document.

An SPDX expression (``GPL-2.0-only OR MIT``, with AND, OR, WITH and brackets) is the identifier
``spdx:`` and the expression in its usual spelling, if every name in it is known; it is reported
whole, after the licences of the rules. "All rights reserved" is a notice that stands before or in
many licences: it is listed among the sentences, breaks no rule's sequence and is no licence itself.

Held are the standard notices (and SPDX lines) of the licences in ``RULES``; other licences, full GNU
texts by title and reworded notices are not recognised.

Edge cases: null, empty and unlicensed texts give an empty list; repeated rows give a row each; a
null doc_id is kept; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: normalised licence sentences and their identifiers, from the standard licence texts and notices
SENTENCES = {
    "licensed under the apache license version 2.0": "apache2-under",
    "licensed under the apache license version 2.0 the license": "apache2-under",
    "the asf licenses this file to you under the apache license version 2.0 the license": "apache2-under",
    "you may not use this file except in compliance with the license": "apache2-comply",
    "you may obtain a copy of the license at": "apache2-copy",
    "apache license version 2.0 january 2004": "apache2-title",
    "apache license version 2.0 january 2004 http www.apache.org licenses": "apache2-title",
    "spdx-license-identifier apache-2.0": "apache2-spdx",
    "released under the mit license": "mit-under",
    "licensed under the mit license": "mit-under",
    "spdx-license-identifier mit": "mit-spdx",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "this work is licensed under the gnu general public license version 3": "gpl3-under",
    "this program is free software": "gpl-free",
    "this library is free software": "lgpl-free",
    "either version 2 of the license or at your option any later version": "gpl2-later",
    "either version 2.1 of the license or at your option any later version": "gpl21-later",
    "either version 3 of the license or at your option any later version": "gpl3-later",
    "version 2 of the license": "gpl2-only",
    "version 2": "gpl2-only",
    "version 2.1 of the license": "gpl21-only",
    "version 2.1": "gpl21-only",
    "version 3 of the license": "gpl3-only",
    "version 3": "gpl3-only",
    "licensed under cc by-nc 4.0": "ccbync4-under",
    "licensed under cc by 4.0": "ccby4-under",
    "licensed under cc by-sa 4.0": "ccbysa4-under",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-redistribution",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-endorse",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "0bsd-grant",
    "this source code form is subject to the terms of the mozilla public license v": "mpl2-terms",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla.org mpl 2.0": "mpl2-copy",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla.org mpl 2.0": "mpl2-copy",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0 which is available at https www.eclipse.org legal epl-2.0": "epl2-terms",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0 which is available at http www.eclipse.org legal epl-2.0": "epl2-terms",
    "distributed under the boost software license version 1.0": "bsl1-under",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib-grant",
    "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide": "cc0-dedicate",
    "this is free and unencumbered software released into the public domain": "unlicense-release",
    "all rights reserved": "all-rights",
}

# fixed values: licences and the identifier sequences that state them, longest first
RULES = [
    ("Apache-2.0", ["apache2-under", "apache2-comply", "apache2-copy"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-terms", "gpl3-later"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl-terms", "gpl2-later"]),
    ("BSD-3-Clause", ["bsd-redistribution", "bsd-source", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-redistribution", "bsd-source"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("MPL-2.0", ["mpl2-terms", "mpl2-copy"]),
]

# The notices of the Free Software Foundation: kind of licence, its name, (version, its sentences' short form)
GNU = [
    ("gpl", "GPL", "gnu general public license", [("3.0", "3", "3"), ("2.0", "2", "2")]),
    ("lgpl", "LGPL", "gnu lesser general public license", [("3.0", "3", "3"), ("2.1", "2.1", "21")]),
    ("lgpl2", "LGPL", "gnu library general public license", [("2.0", "2", "2")]),
    ("agpl", "AGPL", "gnu affero general public license", [("3.0", "3", "3")]),
]
for kind, short, full, versions in GNU:
    terms = f"you can redistribute it and or modify it under the terms of the {full} as published by the free software foundation"
    SENTENCES[terms] = f"{kind}-terms"
    for version, said, code in versions:
        # after a comma the version stays in the sentence, after a semicolon it is one of its own
        SENTENCES[f"{terms} either version {said} of the license or at your option any later version"] = f"{kind}{code}-terms-later"
        for only in (f"{terms} version {said} of the license", f"{terms} version {said}", terms.replace(" as published", f" version {said} as published")):
            SENTENCES[only] = f"{kind}{code}-terms-only"
        for choice, name in (("later", f"{short}-{version}-or-later"), ("only", f"{short}-{version}-only")):
            for free in ([["lgpl-free"]] if short == "LGPL" else []) + [["gpl-free"], []]:  # or the name of a program, which no table can hold
                RULES += [(name, [*free, f"{kind}{code}-terms-{choice}"]), (name, [*free, f"{kind}-terms", f"gpl{code}-{choice}"])]
RULES = list({tuple(ids): (name, ids) for name, ids in RULES}.values())

for kind, full, name in (
    ("ccby4", "attribution", "CC-BY-4.0"),
    ("ccbysa4", "attribution-sharealike", "CC-BY-SA-4.0"),
    ("ccbync4", "attribution-noncommercial", "CC-BY-NC-4.0"),
    ("ccbyncsa4", "attribution-noncommercial-sharealike", "CC-BY-NC-SA-4.0"),
    ("ccbynd4", "attribution-noderivatives", "CC-BY-ND-4.0"),
    ("ccbyncnd4", "attribution-noncommercial-noderivatives", "CC-BY-NC-ND-4.0"),
):
    SENTENCES |= {f"this work is licensed under {a} creative commons {full} 4.0 international license": f"{kind}-under" for a in ("a", "the")}

RULES += [
    ("Apache-2.0", ["apache2-under"]),
    ("Apache-2.0", ["apache2-title"]),
    ("Apache-2.0", ["apache2-spdx"]),
    ("MIT", ["mit-under"]),
    ("MIT", ["mit-spdx"]),
    ("MIT", ["mit-grant"]),
    ("MIT", ["mit-notice"]),
    ("GPL-3.0-only", ["gpl3-under"]),
    ("ISC", ["isc-grant"]),
    ("0BSD", ["0bsd-grant"]),
    ("MPL-2.0", ["mpl2-terms"]),
    ("EPL-2.0", ["epl2-terms"]),
    ("BSL-1.0", ["bsl1-under"]),
    ("Zlib", ["zlib-grant"]),
    ("CC0-1.0", ["cc0-dedicate"]),
    ("Unlicense", ["unlicense-release"]),
    ("CC-BY-NC-4.0", ["ccbync4-under"]),
    ("CC-BY-SA-4.0", ["ccbysa4-under"]),
    ("CC-BY-4.0", ["ccby4-under"]),
    ("CC-BY-NC-SA-4.0", ["ccbyncsa4-under"]),
    ("CC-BY-ND-4.0", ["ccbynd4-under"]),
    ("CC-BY-NC-ND-4.0", ["ccbyncnd4-under"]),
]

# SPDX lines of these licences; GNU names without a choice are the deprecated forms
for name in list(dict.fromkeys(n for n, _ in RULES)):
    tag = f"{name.lower()}-spdx"
    if name not in ("Apache-2.0", "MIT"):
        SENTENCES[f"spdx-license-identifier {name.lower()}"] = tag
        RULES.append((name, [tag]))
    if name.endswith("-or-later"):
        SENTENCES[f"spdx-license-identifier {name.lower().removesuffix('-or-later')}+"] = tag
    elif name.endswith("-only"):
        SENTENCES[f"spdx-license-identifier {name.lower().removesuffix('-only')}"] = tag
for either in ("mit or apache-2.0", "apache-2.0 or mit"):
    SENTENCES[f"spdx-license-identifier {either}"] = "apache2-or-mit-spdx"
RULES += [("Apache-2.0 OR MIT", ["apache2-or-mit-spdx"])]
NOTICE = "all-rights"

# fixed values: SPDX names, beyond the licences of the rules, that an expression may hold
EXCEPTIONS = [
    "Autoconf-exception-3.0", "Bison-exception-2.2", "Classpath-exception-2.0", "Font-exception-2.0",
    "GCC-exception-3.1", "Linux-syscall-note", "LLVM-exception", "OpenSSL-exception",
]
OTHER_LICENSES = [
    "AFL-2.1", "Artistic-1.0", "Artistic-2.0", "BSD-4-Clause", "BSD-3-Clause-Clear", "CDDL-1.0", "CDDL-1.1",
    "EPL-1.0", "EUPL-1.1", "EUPL-1.2", "MIT-0", "MPL-1.1", "MulanPSL-2.0", "NCSA", "OFL-1.1", "PostgreSQL",
    "PSF-2.0", "Python-2.0", "Ruby", "Unicode-DFS-2016", "WTFPL", "X11",
]
OPERATORS = ["OR", "AND", "WITH"]
_NAMES = [n for n in dict.fromkeys(n for n, _ in RULES) if " " not in n]
SPDX_NAMES = {n.lower(): n for n in [*_NAMES, *OTHER_LICENSES, *EXCEPTIONS, *OPERATORS, "(", ")"]}
for n in _NAMES:  # the deprecated forms of the GNU names
    if n.endswith(("-only", "-or-later")):
        SPDX_NAMES[n.lower().removesuffix("-only").removesuffix("-or-later") + ("+" if n.endswith("-or-later") else "")] = n

#: Every known sentence has one of these, so other texts need no cutting.
HINT = "(?i)licen|notice|software|reserved|redistribution|permission|domain|mpl|version"
WRAPPED = r"([^.!?:;\n])\n[ \t]*(?:(?:#|//|\*|--)[ \t]*)?([a-z\"(]|(?:GNU|Lesser|Library|Affero|General|Public|License|Free|Software|Foundation|Apache|Version|Mozilla|Eclipse|Boost|Creative|Commons|Attribution|International)\b)"
# an SPDX tag and its expression are one sentence, which ends where the expression does
SPDX = r"(?i:spdx-license-identifier:)[\x20\x09]*[^\x20\x09-\x0D]+(?:[\x20\x09]+(?:OR|AND|WITH)[\x20\x09]+[^\x20\x09-\x0D]+)*"
#: the expression of a tag (in lower case), and the form of one whose names are known ("?" stands for an unknown one)
SPDX_TOLD = r"spdx-license-identifier:([a-z0-9.+() \x09\-]*[a-z0-9+)])"
EXPRESSION = r"^(\( )*[^ ()?]+( (OR|AND|WITH) (\( )*[^ ()?]+| \))+$"
MARK = rf"({SPDX}|[.!?:;])(?:[\x20\x09-\x0D]+|\z)"
NOISE = r"[^\p{L}\p{N}.+\-]+"


def sentence_ids(text: str = "text") -> Column:
    """The identifiers of a text's known sentences, in order."""
    joined = F.regexp_replace(text, WRAPPED, "$1 $2")
    parts = F.split(F.regexp_replace(joined, MARK, "$1\n"), "\n", -1)
    known = F.create_map(*[F.lit(x) for x in chain.from_iterable(SENTENCES.items())])
    names = F.create_map(*[F.lit(x) for x in chain.from_iterable(SPDX_NAMES.items())])

    def name(part: Column) -> Column:
        plain = F.regexp_replace(F.lower(part), NOISE, " ")
        return F.coalesce(F.try_element_at(known, F.regexp_replace(plain, r"^[ .\-]+|[ .\-]+$", "")), expression(part))

    def expression(part: Column) -> Column:
        told = F.regexp_extract(F.lower(part), SPDX_TOLD, 1)
        words = F.split(F.trim(F.regexp_replace(F.regexp_replace(told, r"([()])", " $1 "), r"[ \x09]+", " ")), " ", -1)
        whole = F.array_join(F.transform(words, lambda w: F.try_element_at(names, w)), " ", "?")
        opened, closed = F.size(F.filter(words, lambda w: w == "(")), F.size(F.filter(words, lambda w: w == ")"))
        spelled = F.replace(F.replace(whole, F.lit("( "), F.lit("(")), F.lit(" )"), F.lit(")"))
        return F.when(whole.rlike(EXPRESSION) & whole.rlike(" (OR|AND|WITH) ") & (opened == closed), F.concat(F.lit("spdx:"), spelled))

    return F.when(F.col(text).rlike(HINT), F.filter(F.transform(parts, name), lambda x: x.isNotNull())).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, licenses, sentence_ids, unmatched): comma-joined, licences in rule order, then expressions, without repeats."""
    out = docs.select("doc_id", sentence_ids().alias("_ids"))
    told = F.filter("_ids", lambda i: i.startswith("spdx:"))
    out = out.select(
        "doc_id",
        F.array_join("_ids", ",").alias("sentence_ids"),
        F.array_join(F.filter("_ids", lambda i: ~i.startswith("spdx:") & (i != NOTICE)), ",").alias("_seq"),
        F.array_distinct(F.transform(told, lambda i: F.substr(i, F.lit(6)))).alias("_expressions"),
    )
    # identifiers as ",a,,b,": a sequence matches only as a run of whole identifiers
    rest: Column = F.when(F.col("_seq") == "", "").otherwise(F.concat(F.lit(","), F.replace("_seq", F.lit(","), F.lit(",,")), F.lit(",")))
    runs = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("".join(f",{i}," for i in ids)).alias("run")) for name, ids in RULES])
    start = F.struct(rest.alias("rest"), F.array().cast("array<string>").alias("hits"))

    def tried(s: Column, rule: Column) -> Column:
        hits = F.when(s["rest"].contains(rule["run"]), F.array_append(s["hits"], rule["name"])).otherwise(s["hits"])
        return F.struct(F.replace(s["rest"], rule["run"], F.lit("|")).alias("rest"), hits.alias("hits"))

    out = out.withColumn("_told", F.when(F.col("_seq") == "", start).otherwise(F.aggregate(runs, start, tried)))
    ordered = F.array(*[F.lit(name) for name in dict.fromkeys(name for name, _ in RULES)])
    names = F.filter(ordered, lambda name: F.array_contains("_told.hits", name))
    left = F.regexp_replace(F.regexp_replace("_told.rest", r"[|,]+", ","), "^,|,$", "")
    return out.select("doc_id", F.array_join(F.concat(names, "_expressions"), ",").alias("licenses"), "sentence_ids", left.alias("unmatched"))


def scan_sql() -> str:
    """The scan in DuckDB SQL, from the same fixed tables."""
    known, names = ("MAP {" + ", ".join(f"'{s}': '{i}'" for s, i in table.items()) + "}" for table in (SENTENCES, SPDX_NAMES))
    words = f"string_split(trim(regexp_replace(regexp_replace(regexp_extract(lower(x), '{SPDX_TOLD}', 1), '([()])', ' \\1 ', 'g'), '[ \\x09]+', ' ', 'g')), ' ')"
    whole = f"array_to_string(list_transform({words}, lambda w: coalesce(({names})[w], '?')), ' ')"
    expression = f"""CASE WHEN regexp_matches({whole}, '{EXPRESSION}') AND regexp_matches({whole}, ' (OR|AND|WITH) ')
      AND len(list_filter({words}, lambda w: w = '(')) = len(list_filter({words}, lambda w: w = ')'))
      THEN 'spdx:' || replace(replace({whole}, '( ', '('), ' )', ')') END"""
    steps, rest = [], "seq"
    for k, (_, ids) in enumerate(RULES):
        run = "".join(f",{i}," for i in ids)
        steps.append(f"s{k} AS (SELECT *, replace({rest}, '{run}', '|') AS left{k}, contains({rest}, '{run}') AS hit{k} FROM {'base' if not k else f's{k - 1}'})")
        rest = f"left{k}"
    ordered = list(dict.fromkeys(name for name, _ in RULES))
    hits = ", ".join("CASE WHEN " + " OR ".join(f"hit{k}" for k, (n, _) in enumerate(RULES) if n == name) + f" THEN '{name}' END" for name in ordered)
    wrapped = WRAPPED.replace("'", "''")
    return f"""
WITH parts AS (
  SELECT doc_id, string_split(regexp_replace(regexp_replace(coalesce(text, ''), '{wrapped}', '\\1 \\2', 'g'), '{MARK}', '\\1' || chr(10), 'g'), chr(10)) AS p
  FROM documents),
ids AS (
  SELECT doc_id, list_filter(list_transform(p, lambda x: coalesce(({known})[regexp_replace(regexp_replace(lower(x), '{NOISE}', ' ', 'g'), '^[ .\\-]+|[ .\\-]+$', '', 'g')], {expression})), lambda y: y IS NOT NULL) AS i
  FROM parts),
told AS (
  SELECT doc_id, i, list_filter(i, lambda y: NOT starts_with(y, 'spdx:') AND y <> '{NOTICE}') AS r,
         list_transform(list_filter(i, lambda y: starts_with(y, 'spdx:')), lambda y: substr(y, 6)) AS e
  FROM ids),
base AS (
  SELECT doc_id, coalesce(array_to_string(i, ','), '') AS sentence_ids,
         list_filter(e, lambda y, k: list_position(e, y) = k) AS expressions,
         CASE WHEN len(r) = 0 THEN '' ELSE ',' || array_to_string(r, ',,') || ',' END AS seq
  FROM told),
{", ".join(steps)}
SELECT doc_id, array_to_string(list_concat(list_filter([{hits}], lambda z: z IS NOT NULL), expressions), ',') AS licenses, sentence_ids,
       regexp_replace(regexp_replace({rest}, '[|,]+', ',', 'g'), '^,|,$', '', 'g') AS unmatched
FROM s{len(RULES) - 1}
"""
