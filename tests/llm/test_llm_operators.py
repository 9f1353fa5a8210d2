"""The text operators against brute force on small tables with nulls, ties, repeats and clashing columns."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.accumulators import AccumulatorParam
from pyspark.sql import functions as F

from activitykit.llm import langid_ppm, license_scan, lm_trie, mixing, nearest, packing, quality_llr, simhash, substring_dedup, suffix_dedup
from activitykit.llm.queries import llm_oracle_sql, llm_queries

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, key string"
WORDS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore".split()


def _text(seed: int, n: int) -> str:
    r = np.random.default_rng(seed)
    return " ".join(f"{WORDS[i]}{j}" for i, j in zip(r.integers(0, len(WORDS), n), r.integers(0, 40, n)))


def _rows():
    shared = _text(1, 90)
    rows = [(i, f"{_text(10 + i, 40)}\n{shared}\nAll rights reserved.\n{_text(50 + i, 30 + i)}", "en", f"s{i % 3}") for i in range(12)]
    rows += [(20, None, None, None), (21, "", "en", "s1"), (22, " \n\t ", "en", None), (23, "a  b\n\nc", None, "s2")]
    rows += [(24, shared + "x" * 3000, "en", "s0"), (25, "na " * 900, "en", "s0"), (26, rows[3][1], "en", "s2"), (27, rows[3][1], "en", "s2")]
    rows += [(30, "same row\nsame line", "en", "s1")] * 2 + [(None, "no id here at all", "en", "s1")]
    return [(*r, 0, 7, "k") for r in rows]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return spark.createDataFrame(_rows(), SCHEMA).repartition(3).cache()


def _pairs(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


def _words(text):
    return re.findall(r"[^\x20\x09-\x0d]+", text)


def _lower(text):
    return text.encode().lower().decode()


def _clean_brute(rows, min_words):
    """(text that stays, units removed, spans) of each (doc_id, text), by ranks over the whole list."""
    parsed, first = [], {}
    for d, t in rows:
        at, found = 0, []
        for m in re.finditer(r"([^\n]*?)((?<=[.!?,;:])[\x20\x09-\x0d]+|(?<=[。！？；，、：])[\x20\x09-\x0d]*|\n|$)", t or ""):
            if m.start() < at:
                continue
            words, at = _words(_lower(m[1])), m.end()
            if words:
                found.append((m.start(1), m.end(1), " ".join(words), len(words)))
        parsed.append(found)
        for k, (*_, plain, _n) in enumerate(found):
            rank = (d is None, d or 0)
            if plain not in first or rank < first[plain][0]:
                first[plain] = (rank, set())
            if rank == first[plain][0]:
                first[plain][1].add((len(parsed), k))
    out = []
    for i, ((d, t), found) in enumerate(zip(rows, parsed), 1):
        runs, run, own = [], [], set()
        for a, b, plain, n in found:
            if (d is None, d or 0) > first[plain][0] or plain in own:
                run.append((a, b, n))
            else:
                own.add(plain)
                runs, run = [*runs, run], []
        runs = [r for r in [*runs, run] if r and sum(x[2] for x in r) >= min_words]
        text = t
        for r in reversed(runs):
            text = text[: r[0][0]] + text[r[-1][1] :]
        out.append((d, t, text, sum(map(len, runs)), ",".join(f"{r[0][0]}:{r[-1][1]}" for r in runs)))
    return out


def _passages():
    """Rows that share passages which start and end inside lines, stock lines, and rows without doc_id or text."""
    shared = ", ".join(_text(70 + i, 9) for i in range(8)) + "."
    rows = [(i, f"own {_text(300 + i, 12)} so {shared[i * 7 :]} and {_text(400 + i, 9)}; end.\nAll rights reserved.\n\nTail {i}! {_text(500 + i, 6)}") for i in range(8)]
    rows += [(40, shared.upper().replace(" ", "  \t")), (41, f"{shared} {shared}\n{shared}"), (41, shared + " other text"), (None, shared), (None, shared), (None, f"x {shared}")]
    return rows + [(50, None), (51, ""), (52, " \n\n "), (53, "一。二！三 四。" * 30), (54, "zz 一。二！三 四。" * 30), (55, "word " * 60_000), (56, "w. " * 30_000), (None, None)]


@pytest.mark.parametrize("min_words", [1, 25])
def test_substring_dedup_matches_brute_force(spark, docs, min_words):
    rows = _passages() + _pairs(docs)
    frame = spark.createDataFrame([(*r, k, "g") for k, r in enumerate(rows)], "doc_id long, text string, later int, sig string").repartition(4)
    got = substring_dedup.clean(frame, min_words=min_words)
    assert got.columns == [*frame.columns, "n_units", "n_removed", "removed_spans"]
    want = {k: w for k, w in enumerate(_clean_brute(rows, min_words))}
    for r in got.collect():
        d, t, text, n, spans = want[r.later]
        assert (r.doc_id, r.text, r.n_removed, r.removed_spans) == (d, t if t is None else text, n, spans), (r.later, min_words)


def test_mid_line_passages_go_and_stock_lines_stay(spark):
    rows = [(d, t) for d, t in _passages() if d is not None and d < 8]
    got = {r.doc_id: r for r in substring_dedup.clean(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].n_removed == 0
    for d in range(1, 8):
        assert got[d].n_removed >= 5 and "All rights reserved." in got[d].text and f"Tail {d}!" in got[d].text
    lines = substring_dedup.clean(spark.createDataFrame(rows, "doc_id long, text string"), unit="line", min_words=1)
    assert all("All rights reserved." not in r.text for r in lines.collect() if r.doc_id)


def test_language_model_matches_brute_force(docs):
    pairs = _pairs(docs)
    held = F.col("doc_id") % 4 == 1
    rows = lm_trie.score(docs, F.coalesce(held, F.lit(False)), block_tokens=300).collect()
    tokens = [(d, [*_words(_lower(t)), ""]) for d, t in pairs]
    c, b = Counter(), Counter()
    for d, w in tokens:
        if d is None or d % 4 != 1:
            c.update(w)
            b.update(zip(["", *w], w))
    n, v = sum(c.values()), len(c)
    total, kinds = Counter(), Counter()
    for (u, _), k in b.items():
        total[u] += k
        kinds[u] += 1
    want = {}
    for d, w in tokens:
        plain = [(c[x] + 1) / (n + v + 1) for x in w]
        p = [max(b[u, x] - 0.75, 0) / total[u] + 0.75 * kinds[u] / total[u] * q if total[u] else q for u, x, q in zip(["", *w], w, plain)]
        want[d] = (len(w), sum(c[x] > 0 for x in w), n, sum(map(math.log10, plain)), sum(map(math.log10, p)))
    assert len(rows) == len(pairs)
    for r in rows:
        w = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == w[:3]
        assert r.base_score == pytest.approx(w[3]) and abs(r.score - w[4]) <= 0.017 * r.n_tokens


def test_frequent_context_is_cut_over_shards(spark, docs, monkeypatch):
    """One word at a third of all tokens: the same scores, and no task gets all its successors."""
    sizes = spark.sparkContext.accumulator([], type("All", (AccumulatorParam,), {"zero": lambda s, v: [], "addInPlace": lambda s, a, b: a + b})())

    def watched(make):
        def made(*args):
            run = make(*args)

            def sized(rows):
                sizes.add([sum(len(x) // 5 for x in rows["follow"])])
                return run(rows)

            return sized

        return made

    monkeypatch.setattr(lm_trie, "_shard", watched(lm_trie._shard))
    r = np.random.default_rng(9)
    texts = [" ".join(f"the w{a} v{b}" for a, b in r.integers(0, 1500, (200, 2))) for _ in range(20)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    held = F.col("doc_id") % 4 == 1
    score = lambda frame, **k: sorted(map(tuple, lm_trie.score(frame, F.coalesce(held, F.lit(False)), block_tokens=900, **k).collect()), key=str)
    whole = score(rows)
    before = max(sizes.value)
    sizes.value = []
    assert score(rows, shard_bytes=16 * 200) == whole
    successors = len({w for t in texts for w in t.split() if w[0] == "w"})
    assert before > successors and max(sizes.value) < before / 4
    assert score(docs, shard_bytes=16) == score(docs)


def test_elias_fano_round_trip():
    values = np.unique(np.random.default_rng(3).integers(0, 1 << 40, 3000).astype(np.uint64))
    coded = lm_trie.EliasFano(values, 1 << 40)
    at, zero = np.arange(len(values)), np.zeros(len(values), int)
    assert (coded.get(at) == values).all() and (coded.find(values, zero, zero + len(values)) == at).all()
    other = values + np.uint64(1)
    assert ((coded.find(other, zero, zero + len(values)) >= 0) == np.isin(other, values)).all()


def _brute_repeats(pairs, least):
    count = Counter(t.encode()[i : i + least] for _, t in pairs for i in range(len(t.encode()) - least + 1))
    out = Counter()
    for d, t in pairs:
        raw = t.encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - least + 1):
            if count[raw[i : i + least]] > 1:
                gone[i : i + least] = True
        out[d, len(raw), np.frombuffer(raw, np.uint8)[~gone].tobytes()] += 1
    return out


@pytest.mark.parametrize("crowd", [1, 4096])
def test_suffix_dedup_matches_brute_force(docs, crowd):
    found = suffix_dedup.clean(docs, keep_first=False, crowd=crowd).collect()
    assert Counter((r.doc_id, r.n_bytes, bytes(r.kept)) for r in found) == _brute_repeats(_pairs(docs), 400)


def test_licenses(spark, docs):
    texts = [
        (1, "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n    http://example.org"),
        (2, "words.\nReleased under the MIT License.\nAll rights reserved."),
        (3, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, nothing"),
        (4, None),
    ]
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got[1].licenses == "Apache-2.0" and got[1].unmatched == ""
    assert (got[2].licenses, got[2].sentence_ids, got[2].unmatched) == ("MIT", "mit-under,all-rights", "")
    assert got[3].licenses == "" and got[4].licenses == ""
    assert license_scan.scan(docs).count() == docs.count()
    hint = re.compile(license_scan.HINT)
    assert all(hint.search(s) for s in license_scan.SENTENCES if not s.startswith(("either", "neither")))


def _scanned(spark, texts):
    """Scan results by text; the SQL form must agree."""
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", rows.toPandas())
    want = con.sql(license_scan.scan_sql())
    got = license_scan.scan(rows).select(*want.columns).collect()
    assert Counter(map(tuple, got)) == Counter(want.fetchall())
    return {texts[r.doc_id]: r for r in got}


def test_spdx_lines(spark):
    texts = ["SPDX-License-Identifier: MIT", "// SPDX-License-Identifier: Apache-2.0\npackage main", "# SPDX-License-Identifier:\tMIT\n\nimport os",
             "/* SPDX-License-Identifier: MIT */\nint x;", "words. SPDX-License-Identifier: MIT. More words.", "SPDX-License-Identifier:Apache-2.0"]
    other = ["SPDX-License-Identifier: MIT AND Unknown-1.0", "SPDX-License-Identifier:\nMIT", "SPDX-License-Identifier: "]
    got = _scanned(spark, texts + other)
    for t in texts:
        assert (got[t].licenses, got[t].unmatched) == ("MIT" if "MIT" in t else "Apache-2.0", ""), t
    assert all(got[t].licenses == "" for t in other)


def test_spdx_expressions(spark):
    told = {
        "// SPDX-License-Identifier: GPL-2.0-only OR MIT": "GPL-2.0-only OR MIT",
        "/* SPDX-License-Identifier: (gpl-2.0+ WITH Linux-syscall-note) OR BSD-3-Clause */\nint x;": "(GPL-2.0-or-later WITH Linux-syscall-note) OR BSD-3-Clause",
        "# SPDX-License-Identifier: Apache-2.0 WITH LLVM-exception.": "Apache-2.0 WITH LLVM-exception",
        "SPDX-License-Identifier: (MIT OR ISC) AND (Zlib OR (NCSA AND WTFPL))\nwords": "(MIT OR ISC) AND (Zlib OR (NCSA AND WTFPL))",
        "SPDX-License-Identifier: MIT AND ISC\n// SPDX-License-Identifier: MIT AND ISC\n# SPDX-License-Identifier: Zlib": "Zlib,MIT AND ISC",
    }
    other = ["SPDX-License-Identifier: MIT OR Unknown-9", "SPDX-License-Identifier: (MIT OR ISC", "SPDX-License-Identifier: MIT OR", "SPDX-License-Identifier: ()", "MIT OR ISC"]
    got = _scanned(spark, [*told, *other])
    assert {t: got[t].licenses for t in told} == told
    assert all(got[t].unmatched == "" for t in told) and all("OR" not in got[t].licenses for t in other)


def test_all_rights_reserved_is_a_notice(spark):
    bsd = "Copyright (c) 2020, A\nAll rights reserved.\n\n" + BSD + "3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission."
    alone = "Copyright 2020 A. All rights reserved."
    got = _scanned(spark, [bsd, alone])
    assert (got[bsd].licenses, got[bsd].unmatched) == ("BSD-3-Clause", "") and got[bsd].sentence_ids.startswith("all-rights,")
    assert (got[alone].licenses, got[alone].sentence_ids, got[alone].unmatched) == ("", "all-rights", "")


GNU = "{0} is free software{1} you can redistribute it and/or modify\nit under the terms of the GNU {2} as published by\nthe Free Software Foundation{3}{4}\n\n{0} is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY."
LATER = " either version {} of the License, or\n(at your option) any later version."
GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:"
BSD = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following disclaimer in the documentation\n   and/or other materials provided with the distribution.\n\n"
NOTICES = [
    ("Apache-2.0", "Copyright 2020 A\n\nLicensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "The ASF licenses this file to You under the Apache License, Version 2.0\n(the \"License\"); you may not use this file except in compliance with\nthe License.  You may obtain a copy of the License at"),
    ("Apache-2.0", "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n   TERMS"),
    ("MIT", f"MIT License\n\n{GRANT}\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software."),
    ("MIT", GRANT),
    ("BSD-2-Clause", BSD),
    ("BSD-3-Clause", BSD + "3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the\nterms of the Eclipse Public License 2.0 which is available at\nhttps://www.eclipse.org/legal/epl-2.0/"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0.\n(See accompanying file LICENSE_1_0.txt)"),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:"),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright\nand related and neighboring rights to this software to the public domain\nworldwide."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0\nInternational License."),
    ("CC-BY-SA-4.0", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("Apache-2.0 OR MIT", "// SPDX-License-Identifier: MIT OR Apache-2.0"),
    ("GPL-2.0-or-later", "/* SPDX-License-Identifier: GPL-2.0+ */"),
    ("GPL-2.0-only", "// SPDX-License-Identifier: GPL-2.0"),
    ("LGPL-2.1-or-later", "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version."),
]
for _kind, _name, _version in [("GPL", "General Public License", "3"), ("GPL", "General Public License", "2"), ("LGPL", "Lesser General Public License", "3"),
                               ("LGPL", "Lesser General Public License", "2.1"), ("LGPL", "Library General Public License", "2"), ("AGPL", "Affero General Public License", "3")]:
    _id = f"{_kind}-{_version}{'' if '.' in _version else '.0'}"
    for _first in ("This library" if _kind == "LGPL" else "This program", "This program", "Foobar"):
        for _mark, _end in ((":", ","), (";", ";")):
            NOTICES.append((f"{_id}-or-later", GNU.format(_first, _mark, _name, _end, LATER.format(_version))))
            NOTICES.append((f"{_id}-only", GNU.format(_first, _mark, _name, _end, f" version {_version} of the License.")))
            NOTICES.append((f"{_id}-only", GNU.format(_first, _mark, _name, _end, f" version {_version}.")))
NOTICES += [(n, f"# SPDX-License-Identifier: {n}") for n in dict.fromkeys(n for n, _ in license_scan.RULES) if " " not in n]


def test_every_rule_on_its_canonical_notice(spark):
    got = _scanned(spark, [t for _, t in NOTICES])
    for name, text in NOTICES:
        assert (got[text].licenses, got[text].unmatched) == (name, ""), text
    assert {n for n, _ in NOTICES} == {n for n, _ in license_scan.RULES}
    commented = {t: "\n".join(f" * {line}" for line in t.split("\n")) for _, t in NOTICES if "1." not in t}
    again = _scanned(spark, list(commented.values()))
    assert all(again[commented[t]].licenses == n for n, t in NOTICES if t in commented)


def test_nearest_recall_and_bad_vectors(spark, docs):
    r = np.random.default_rng(5)
    rows = [(i, [float(x) for x in r.standard_normal(16)]) for i in range(800)]
    rows += [(1000, None), (1020, [0.0] * 16), (1040, [float("nan")] * 16), (1060, [None] + [1.0] * 15), (1080, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nearest.nearest(frame, F.col("vec_id") % 20 == 0, k=10).collect()
    x = np.array([v for i, v in rows if i < 1000])
    hits = total = 0
    for q in range(0, 800, 20):
        s = x @ x[q]
        s[q] = -np.inf
        best = set(np.argsort(-s)[:10].tolist())
        mine = [g for g in got if g.query_id == q]
        assert sorted(g.rank for g in mine) == list(range(1, 11))
        hits += len(best & {g.vec_id for g in mine})
        total += 10
    assert hits / total >= 0.9 and {g.query_id for g in got} == set(range(0, 800, 20))


def test_quality_counts(docs, spark):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(6)] + [(25, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality_llr.quality(docs, quality_llr.fit_weights(docs, labels)).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == docs.count()
    for d, t in _pairs(docs):
        w, r = _words(t), by_id[d]
        windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        inside = {j for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in t.split("\n") if _words(x)]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(inside))
        assert r.base_failed == (len(w) < 10 or 100 * len(inside) > 20 * len(w)) and not (r.base_failed and r.kept)
    none = quality_llr.quality(docs, quality_llr.fit_weights(docs, labels.filter("false"))).collect()
    assert all(r.kept != r.base_failed and r.llr == 0 for r in none)


def test_mixing_meets_targets(docs):
    rows = mixing.mix(docs).collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += r.size
    weights = dict(zip([*sorted(s for s in sizes if s is not None), None], [3, 1, 2, 3]))
    open_, target, left = set(sizes), {}, 1.5 * sum(sizes.values())
    while open_:
        level = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if 2 * sizes[s] <= weights[s] * level}
        target |= {s: 2 * sizes[s] for s in full} if full else {s: weights[s] * level for s in open_}
        left -= sum(2 * sizes[s] for s in full)
        open_ = open_ - full if full else set()
    longest = max(r.size for r in rows)
    for s in sizes:
        mine = [r for r in rows if r.source == s]
        assert all(r.target == pytest.approx(target[s]) and 0 <= r.copies <= 2 for r in mine)
        assert abs(sum(r.copies * r.size for r in mine) - target[s]) <= longest
    again = mixing.mix(docs.repartition(5)).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))
    assert mixing.mix(docs.filter("false")).count() == 0


def test_packing_round_trip(docs):
    from tokenizers import Tokenizer

    import public_tokenizers

    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    special = [(40, "x <|endoftext|> y", None, None, 0, 0, ""), (41, "\x01 a\tb   c", None, None, 0, 0, ""), (42, "it's\n'quoted' 12 é", None, None, 0, 0, "")]
    every = docs.unionByName(docs.sparkSession.createDataFrame(special, SCHEMA))
    rows = packing.packed_documents(every, capacity=128).collect()
    want = Counter()
    for d, t in _pairs(every):
        ids = np.array([*coder.encode(t, add_special_tokens=False).ids, 2], "<u4")
        first = (len(ids) - 1) % 128 + 1
        cuts = [0, *range(first, len(ids) + 1, 128)]
        want.update((d, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert bins.get(r.sequence_id, 0) == r.offset
        bins[r.sequence_id] = r.offset + r.length
    assert max(bins.values()) <= 128 and len(bins) <= 1 + math.ceil(sum(bins.values()) / 128 * 1.05)


def test_simhash_components_match_brute_force(spark, docs):
    import xxhash

    def fingerprint(t):
        w = _words(_lower(t))
        shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    near = [(100 + i, " ".join([*_text(7, 300).split()[:-1], f"end{i}"]), "en", "s", 0, 0, "") for i in range(15)]
    every = docs.unionByName(spark.createDataFrame(near, SCHEMA))
    pairs = [(d, fingerprint(t)) for d, t in _pairs(every)]
    group = {f: f for _, f in pairs}

    def find(f):
        while group[f] != f:
            f = group[f]
        return f

    for a in list(group):
        for b in list(group):
            if (a ^ b).bit_count() <= 3:
                group[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for d, f in pairs:
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    for cell_rows in (2, 4096):
        got = simhash.near_duplicates(every, cell_rows=cell_rows).collect()
        assert Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in got) == Counter((d, f, least.get(find(f))) for d, f in pairs)
    assert simhash.keep_one(every).columns == every.columns


def test_keep_one_tells_rows_apart_by_doc_id_and_text(spark):
    a, b, c, d, e = (_text(60 + i, 80) for i in range(5))
    rows = [(1, a), (None, a), (None, a), (None, b), (None, b), (5, c), (5, d), (7, e), (7, e), (9, c), (3, None), (None, "")]
    frame = spark.createDataFrame([(i, t, f"s{k % 2}") for k, (i, t) in enumerate(rows)], "doc_id long, text string, source string")
    want = Counter([(1, a), (None, b), (5, c), (5, d), (7, e), (3, None)])
    first = [simhash.keep_one(frame.repartition(n)).collect() for n in (1, 4)]
    assert all(Counter((r.doc_id, r.text) for r in got) == want for got in first)
    assert Counter(map(tuple, first[0])) == Counter(map(tuple, first[1]))


def test_language_id(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = rows.unionByName(spark.createDataFrame([(90000, None, None, None, 0), (90001, "12 !!", "en", "s", 0), (None, "the and of", None, "s", 0)], rows.schema))
    held = F.coalesce(F.col("doc_id") % 3 == 1, F.lit(False))
    model = langid_ppm.PpmModel(langid_ppm.training_sample(rows, ~held))
    got = langid_ppm.identify(rows, model, held).join(rows.select("doc_id", "lang"), "doc_id").collect()
    tested = [r for r in got if r.held_out and r.lang]
    assert sum(r.lang == r.lang_pred for r in tested) >= 0.97 * len(tested) and all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in got if r.doc_id in (90000, 90001)} == {"und"}
    empty = langid_ppm.PpmModel([])
    assert {r.lang_pred for r in langid_ppm.identify(rows, empty, held).collect()} == {"und"}


def test_language_learned_from_whole_rows(spark):
    shared = _text(1, 900)
    rows = [(i, shared + (" zzyx zyzx" if i % 2 else " qkwq kwqk") * 300, "ab"[i % 2]) for i in range(8)]
    rows += [(5, rows[5][1], "b"), (90, None, "a"), (91, "", "b"), (92, "none", None), (93, "held out", "a")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    assert all(len(t) > 4096 for _, t, _ in rows[:8]) and len(shared) > 4096
    sample = langid_ppm.training_sample(frame, F.col("doc_id") != 93, order=2)
    for lang in "ab":
        whole = [t.encode().lower() for d, t, g in rows if g == lang and t and d != 93]
        for k in range(3):
            want = Counter(int.from_bytes(t[i : i + k + 1]) for t in whole for i in range(len(t) - k))
            assert Counter(dict(zip(*(x.tolist() for x in sample[lang][k])))) == want
            pieces = langid_ppm._counted(whole, k, chunk=53)[k]
            assert Counter(dict(zip(*(x.tolist() for x in pieces)))) == want
    few = langid_ppm.training_sample(frame, F.col("doc_id") != 93, rows_per_language=1)
    assert all(few[lang][0][1].sum() == len(rows[0][1]) for lang in "ab")
    model = langid_ppm.PpmModel(langid_ppm.training_sample(frame, F.col("doc_id") != 93))
    asked = spark.createDataFrame([(1, "zzyx zyzx"), (2, "qkwq kwqk")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in langid_ppm.identify(asked, model, F.lit(True)).collect()} == {1: "b", 2: "a"}
    assert langid_ppm.training_sample(frame, F.lit(False)) == {}


def test_long_text_code_length_is_exact_in_chunks():
    data = np.frombuffer(_text(2, 400).encode(), np.uint8)
    model = langid_ppm.PpmModel([("a", _text(3, 300).encode()), ("b", _text(4, 200).upper().encode())])
    starts = np.array([0, len(data)])
    assert langid_ppm._in_chunks(model, data, starts, chunk=101) == pytest.approx(langid_ppm._in_chunks(model, data, starts))


@pytest.mark.parametrize("name", ["op1_substring_dedup", "op4_license_scan"])
def test_sql_forms(spark, docs, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM '{SF}/documents.parquet'")
    want = con.sql(llm_oracle_sql()[name])
    got = llm_queries()[name](spark, SF).select(*want.columns).collect()
    assert Counter(map(tuple, got)) == Counter(want.fetchall())


def test_pipeline_stages(spark, docs):
    import corpus_pipeline

    table = spark.read.parquet(f"{SF}/documents.parquet")
    rows = table
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, rows, SF).cache()
        assert after.schema.names == table.schema.names
        if name == "simhash near-dedup":
            kept = {r.component_id for r in simhash.near_duplicates(rows).collect()}
            assert {r.doc_id for r in after.collect()} == kept
        if name == "substring dedup":
            want = {(d, text) for d, _, text, _, _ in _clean_brute(_pairs(rows), substring_dedup.MIN_WORDS)}
            assert {(r.doc_id, r.text or "") for r in after.collect()} == {(d, t or "") for d, t in want}
        rows = after
    assert corpus_pipeline.run(spark, SF).agg(F.sum("length")).first()[0] == packing.pieces(rows).agg(F.sum("length")).first()[0]


def test_empty_tables(docs):
    none = docs.filter("false")
    assert substring_dedup.clean(none).count() == lm_trie.score(none, F.lit(False)).count() == 0
    assert suffix_dedup.clean(none).count() == simhash.near_duplicates(none).count() == packing.packed_documents(none).count() == 0


def test_sha_of_kept_bytes(spark, docs):
    row = llm_queries()["op3_suffix_dedup"](spark, SF).filter("n_removed = 0").first()
    text = spark.read.parquet(f"{SF}/documents.parquet").filter(F.col("doc_id") == row.doc_id).first().text
    assert row.kept_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_clashing_column_names_pass_through(spark):
    from activitykit.llm import mixing, quality_llr, simhash, substring_dedup

    names = ["size", "copies", "_copy", "_sig", "_gone", "sig", "removed", "key", "fp", "component_id", "root", "kept", "llr", "target"]
    rows = [(k, f"line one{' of many words' * 10}\nown {k}\n" + "word " * k, "en", f"s{k % 2}", 5, *[f"{n}{k}" for n in names]) for k in range(1, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"{n} string" for n in names))
    given = {r.doc_id: r[5:] for r in docs.collect()}
    stages = [substring_dedup.clean(docs).select(docs.columns), mixing.mixed_documents(docs), simhash.keep_one(docs),
              quality_llr.quality(docs, quality_llr.fit_weights(docs, spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")), keep_columns=True)]
    for out in stages:
        assert out.columns == docs.columns
        assert all(given[r.doc_id] == r[5:] for r in out.collect())
    kept = {r.doc_id: r.text for r in stages[0].collect()}
    assert kept[1].startswith("line one") and not kept[2].startswith("line one") and kept[2].startswith("\nown 2")
