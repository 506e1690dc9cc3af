"""Decontamination, mixing, licences and revisits on odd rows, each against a brute-force version."""

import hashlib
import random
import re
import textwrap
from collections import defaultdict

import pytest
from lakeread.llm import decontaminate, licenses, mixing, queries, revisits


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_contamination(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(0, len(w) - 9) or (len(w) > 0)):
            windows[tuple(w[i : i + 10])].add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if (key := tuple(w[i : i + size])) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[key] - {None}
        ids = ",".join(sorted(map(str, found)))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bound", [500_000, 0])  # with 0 nothing is broadcast
def test_contamination_matches_brute_force(spark, monkeypatch, bound):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", bound)
    rnd = random.Random(3)
    some = lambda n, k: " ".join(rnd.choice(["É", "é", "The", "the", "a1", "x-y", "ß", *map(str, range(k))]) for _ in range(n))
    items = [(i, some(n, 30)) for i, n in enumerate([1, 2, 3, 5, 6, 9, 10, 11, 12, 25, 40, 15])]
    items += [(20, None), (21, ""), (22, "-- !"), (None, some(12, 30)), (9, items[9][1]), (23, items[9][1] + " more"), (24, "z " * 30)]
    docs = [(i, some(rnd.choice([0, 3, 9, 10, 60]), 30)) for i in range(80)]
    for i in range(80, 160):
        text = (rnd.choice(items)[1] or "x").split(" ")
        a = rnd.randrange(len(text))
        docs.append((i, f"{some(20, 30)}. {' '.join(text[a : a + rnd.choice([8, 10, 14, 60])]).upper()}; {some(20, 30)}"))
    docs += [(200, None), (201, ""), (202, "z Z " * 20_000), (None, docs[90][1]), (90, docs[90][1]), (91, "another text of an id that is repeated")]
    frame = spark.createDataFrame([(i, t, 7, "clash", "clash") for i, t in docs], "doc_id long, text string, item_id int, words string, window string").repartition(4)
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = sorted(map(tuple, decontaminate.contamination(frame, bench).collect()), key=repr)
    assert got == brute_contamination(docs, items)
    stay = [(d or -1, t or "") for d, t in docs if not brute_contamination([(d, t)], items)[0][5]]  # each row by its own text
    assert sorted((r["doc_id"] or -1, r["text"] or "") for r in decontaminate.clean(frame, bench).collect()) == sorted(stay)


def test_contamination_of_and_by_nothing(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.contamination(docs.limit(0), items).collect() == []
    assert [r["n_hit"] for r in decontaminate.contamination(docs, items.limit(0)).collect()] == [0, 0]
    assert sorted(r["n_hit"] for r in decontaminate.contamination(docs, items).collect()) == [0, 3]


def test_mix(spark):
    rnd = random.Random(4)
    docs = [(i, "w " * rnd.choice([0, 1, 7, 50]), rnd.choice(["b", "a", "É", "z", None]), 5) for i in range(600)]
    docs += [(700, None, "a", 5), (701, "x\x0by z", "tiny", 5), (None, "a b", "b", 5), (3, docs[3][1], docs[3][2], 5), (702, "", "empty", 5)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, size long").repartition(5)
    rows = mixing.mix(df).collect()
    size = lambda t: len((t or "").encode().split())
    sizes = defaultdict(int)
    for _, t, s, _ in docs:
        sizes[s] += size(t)
    order = sorted((s for s in sizes if s is not None), key=str) + [None]
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        level = (total - sum(3 * sizes[s] for s in capped)) / sum(weight[s] for s in sizes if s not in capped)
        more = {s for s in sizes if s not in capped and weight[s] * level > 3 * sizes[s]}
        if not more:
            break
        capped |= more
    target = {s: 3.0 * sizes[s] if s in capped else weight[s] * level for s in sizes}
    source = {d: s for d, _, s, _ in docs}
    taken, most = defaultdict(int), defaultdict(int)
    assert len(rows) == len(docs)
    for r in rows:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - target[s]) < 1e-5
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["repetitions"] * r["size"]
        taken[s] += r["taken"]
        most[s] = max(most[s], r["size"])
    assert all(abs(taken[s] - target[s]) <= most[s] for s in sizes) and len(capped) >= 2
    key = lambda df: sorted(((r["doc_id"] or -1, r["taken"]) for r in df.collect()))
    assert key(mixing.mix(df)) == key(mixing.mix(df.repartition(2)))
    assert mixing.mix(df.limit(0)).collect() == []
    nothing = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert {(r["size"], r["target"], r["taken"]) for r in mixing.mix(nothing).collect()} == {(0, 0.0, 0)}


def test_licences(spark):
    mit = [licenses.SENTENCES[k] for k in ("mit-grant", "mit-keep", "mit-as-is")]
    bsd = [licenses.SENTENCES[k] for k in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")]
    docs = [
        (1, "Hello there. Released under the MIT License.\nMore."),
        (2, f"{mit[0].upper()}!  {mit[1].capitalize()}.\n\n({mit[2]})."),
        (3, f"{mit[0]}. {mit[2]}."),  # one is missing
        (4, f"{mit[1]}. {mit[0]}. {mit[2]}."),  # out of order
        (5, ". ".join(bsd)), (6, ". ".join(bsd[:3])), (7, f"{mit[0]}. Unknown words between. {mit[1]}. And more. {mit[2]}."),
        (8, f"{mit[0]}. all rights reserved. {mit[1]}. {mit[2]}."),  # passed over
        (15, f"{mit[0]}. {licenses.SENTENCES['isc-as-is']}. {mit[1]}. {mit[2]}."),  # another known one between
        (16, f"{mit[0]}. {'Words. ' * 70}{mit[1]}. {mit[2]}."),  # too far apart
        (9, "Released under the MIT License. " * 3_000), (10, None), (11, ""), (12, "released under the mit licenses."), (13, "Licensed under CC BY-NC 4.0. No."),
        (None, "released under the MIT license"), (1, "Hello there. Released under the MIT License.\nMore."), (14, "This\nRELEASED UNDER   THE “MIT” LICENSE"),
    ]
    df = spark.createDataFrame([(i, t, "clash", 0) for i, t in docs], "doc_id long, text string, rule string, at int").repartition(3)
    got = sorted((r["doc_id"] or -1, r["rule"], r["first_sentence"], r["last_sentence"]) for r in licenses.detect(df).collect())
    want = [(1, "mit-by-notice", 1, 1), (2, "mit-text", 0, 3), (5, "bsd-3-text", 0, 3), (6, "bsd-2-text", 0, 2), (7, "mit-text", 0, 4), (8, "mit-text", 0, 3), (13, "cc-by-nc-by-notice", 0, 0), (-1, "mit-by-notice", 0, 0)]
    want += [(9, "mit-by-notice", i, i) for i in range(3_000)]
    assert got == sorted(want)
    assert licenses.detect(df.limit(0)).collect() == []


def test_wrapped_and_commented_licences(spark):
    apache = """# Copyright 2020 Somebody
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
"""
    gpl = """/*
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the
 * GNU General Public License for more details.
 */"""
    bsd = [licenses.SENTENCES[k] for k in ("bsd-grant", "bsd-source", "bsd-binary")]
    wrap = lambda text, prefix: "\n".join(prefix + x for x in textwrap.wrap(text, 40))
    mit = "\n\n".join(wrap(licenses.SENTENCES[k] + ".", "// ") for k in ("mit-grant", "mit-keep", "mit-as-is"))
    docs = [
        (1, apache), (2, gpl), (3, mit), (4, bsd[0] + ":\n" + "\n".join(f"{i}. {wrap(s, '   ')}." for i, s in enumerate(bsd[1:], 1))),
        (5, "Notes\r\nReleased under\r\nthe MIT License\r\nby us."), (6, "Released\nunder\nthe\nMIT\nLicense"),
        (7, "Released under\n\nthe MIT License."), (8, "Released under\nthe MIT Licenses."), (9, "Released under\nthe MIT License too."), (10, mit.replace("\n", "\n\n")),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sorted((r["doc_id"], r["rule"], r["first_sentence"]) for r in licenses.detect(df).collect())
    want = [(1, "apache-header", 1), (2, "gpl-3-or-later-header", 1), (3, "mit-text", 0), (4, "bsd-2-text", 0), (5, "mit-by-notice", 1), (6, "mit-by-notice", 0)]
    assert got == want


MIT = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE."""
BSD = """Copyright (c) 2020, Somebody. All rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
APACHE = """Copyright 2020 Somebody

Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""
STANDARD = {
    "MIT": MIT, "BSD-3-Clause": BSD, "Apache-2.0": APACHE, "GPL-3.0-or-later": GPL, "LGPL-2.1-or-later": GPL.replace("program", "library").replace("GNU General", "GNU Lesser General").replace("version 3", "version 2.1"),
    "AGPL-3.0-or-later": GPL.replace("GNU General", "GNU Affero General"), "ISC": ISC, "MPL-2.0": MPL, "Zlib": ZLIB, "Unlicense": UNLICENSE, "BSL-1.0": "Boost Software License - Version 1.0 - August 17th, 2003".replace(" - August 17th, 2003", ""),
    "LGPL-3.0-only": "SPDX-License-Identifier: LGPL-3.0-only", "CC0-1.0": "SPDX-License-Identifier: CC0-1.0",
}


def test_standard_texts_are_found_however_they_are_laid_out(spark):
    """Wrapped at 72 and 80 signs, behind the signs of comments, and all on one line."""
    docs = []
    for name, text in STANDARD.items():
        paragraphs = text.split("\n\n")
        for width in (72, 80):
            wrapped = [line for p in paragraphs for line in [*textwrap.wrap(p, width), ""]]
            for mark in ("", "# ", "// ", " * ", "; ", "-- "):
                docs.append((name, "Some words before.\n" + "\n".join(mark + line for line in wrapped) + "\nAnd after."))
        docs.append((name, "".join(p.strip() + (" " if p[-1] in ".:;" else "\n") for p in paragraphs)))  # titles and addresses stand alone
        docs.append((name, "\r\n".join(p.strip() for p in paragraphs)))
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(docs)], "doc_id int, text string").repartition(4)
    got = defaultdict(set)
    for r in licenses.detect(df, rules=licenses.GRANTS).collect():
        got[r["doc_id"]].add(r["license"])
    missed = [(name, text[:200]) for i, (name, text) in enumerate(docs) if got[i] != {name}]
    assert not missed


def test_every_rule_uses_known_sentences_in_normal_form(spark):
    assert {i for _, ids in licenses.RULES.values() for i in ids} <= set(licenses.SENTENCES)
    df = spark.createDataFrame(list(licenses.SENTENCES.items()), "id string, s string")
    assert df.where(licenses.normalise(df["s"]) != df["s"]).count() == 0


def test_every_known_sentence_is_used_by_a_rule(spark, tmp_path):
    assert set(licenses.SENTENCES) == {i for _, ids in licenses.RULES.values() for i in ids}
    docs = [(1, "Copyright 2020 Somebody.\nAll rights reserved."), (2, "Released under the MIT License. All rights reserved."), (3, "All rights.")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r["doc_id"], r["rule"], r["license"], r["first_sentence"]) for r in queries.op5_license_scan(spark, str(tmp_path)).collect())
    reserved = ("all-rights-reserved", "proprietary", 1)
    assert got == [(1, *reserved), (2, *reserved), (2, "mit-by-notice", "MIT", 0)]


def canonical(url):
    rest = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://", "", url).split("#")[0]
    address, _, query = rest.partition("?")
    host, slash, path = address.partition("/")
    params = sorted(p for p in query.split("&") if p and not re.match(revisits.TRACKING, p))
    host = re.sub(r"^www\.", "", re.sub(r":(80|443)$", "", re.sub("[A-Z]", lambda m: m[0].lower(), host)))
    return host + re.sub("/+$", "", slash + path) + ("?" + "&".join(params) if params else "")


@pytest.mark.parametrize("block", [50_000, 7])
def test_revisits_match_brute_force(spark, block):
    rnd = random.Random(9)
    urls = ["http://www.A.com/x/", "https://a.com:443/x?utm_source=1", "a.com/x#f", "http://b.org/?b=2&a=1", "b.org?a=1&b=2&ref=z", "http://c.net", None]
    tags = ["1", "W/1", "2", None]
    rows = [
        (i, rnd.choice(urls), rnd.choice([None, *range(40)]), rnd.choice(["response", "revisit", "request", None]), rnd.choice(tags), rnd.choice(["d", "e", None]),
         rnd.choice(["s", "t", None]), i, rnd.choice([None, {"ETag": f"{i}", "X": "1"}, {"date": "d", "Content-Length": f"{i}"}]), "clash")
        for i in range(500)
    ]
    schema = "id long, url string, ts long, kind string, etag string, last_modified string, digest string, payload_length long, headers map<string,string>, block string"
    got = {r["id"]: r for r in revisits.resolve(spark.createDataFrame(rows, schema).repartition(4), block).collect()}
    visits = [r for r in rows if r[3] == "revisit"]
    assert got.keys() == {r[0] for r in visits}
    seen = set()
    for i, url, ts, _, etag, modified, digest, _, headers, _ in visits:
        earlier = [r for r in rows if r[3] == "response" and url and r[1] and None not in (ts, r[2]) and canonical(r[1]) == canonical(url) and r[2] < ts]
        old = max(earlier, key=lambda r: (r[2], r[0]), default=None)
        status = "missing"
        if old:
            weak = lambda e: e and e.removeprefix("W/")
            both = [(weak(old[4]), weak(etag)), (old[5], modified), (old[6], digest)]
            status = next(("resolved" if a == b else "mismatch" for a, b in both if a and b), "unverifiable")
        assert (got[i]["status"], got[i]["refers_to"]) == (status, old and old[0])
        seen.add(status)
        merged = None
        if status == "resolved":
            lower = lambda m: {k.lower(): v for k, v in (m or {}).items()}
            merged = lower(old[8]) | {k: v for k, v in lower(headers).items() if k in revisits.PERMITTED_HEADERS}
            assert got[i]["payload_length"] == old[7]
        assert got[i]["headers"] == merged
    assert seen == {"resolved", "mismatch", "unverifiable", "missing"}
    assert revisits.resolve(spark.createDataFrame([], schema)).collect() == []


def test_repeated_records_and_records_without_responses(spark):
    schema = "id long, url string, ts long, kind string, etag string, last_modified string, digest string, payload_length long, headers map<string,string>"
    visit, other = (2, "a.com", 5, "revisit", "x", None, None, None, None), (3, "b.com", 5, "revisit", "x", None, None, None, None)
    response = (1, "http://A.com/", 4, "response", "x", None, None, 9, {"A": "b"})
    rows = spark.createDataFrame([visit, visit, other, response, response], schema)
    got = sorted((r["id"], r["status"], r["refers_to"]) for r in revisits.resolve(rows).collect())
    assert got == [(2, "resolved", 1), (2, "resolved", 1), (3, "missing", None)]
    assert {r["status"] for r in revisits.resolve(spark.createDataFrame([visit], schema)).collect()} == {"missing"}
    assert revisits.resolve(spark.createDataFrame([response], schema)).collect() == []


def test_headers_that_differ_in_capitals_only_and_very_long_urls(spark):
    schema = "id string, url string, ts long, kind string, etag string, last_modified string, digest string, payload_length long, headers map<string,string>"
    long_url = "http://h/" + "x" * 200_000
    rows = [
        ("a", long_url, 1, "response", "e", None, None, 5, {"ETag": "1", "etag": "2", "X": "y", "x": "z"}),
        ("b", "https://www.h/" + "x" * 200_000 + "/", 2, "revisit", "W/e", None, None, None, {"DATE": "1", "Date": "2", "date": "3", "Content-Length": "9"}),
        ("c", long_url, 3, "revisit", "e", None, None, None, None),
    ]
    got = {r["id"]: (r["status"], r["refers_to"], r["headers"]) for r in revisits.resolve(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"b": ("resolved", "a", {"etag": "2", "x": "z", "date": "3"}), "c": ("resolved", "a", {"etag": "2", "x": "z"})}


def test_mixing_spreads_rows_without_an_id_and_takes_long_texts_whole(spark):
    docs = [(None, f"words of row {i} and more", "s") for i in range(400)] + [(None, None, "s")] * 50 + [(1, "w " * 300_000, "t"), (2, "w", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(5)
    rows = mixing.mix(df).collect()
    assert len(rows) == len(docs) and max(r["size"] for r in rows) == 300_000
    for size in {r["source_size"] for r in rows}:
        own = [r for r in rows if r["source_size"] == size]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own)
    again = mixing.mix(df.repartition(3)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_a_window_of_many_items_is_one_row_for_a_document(spark):
    shared = " ".join(f"b{i}" for i in range(12))
    items = spark.createDataFrame([(i, f"{shared} item {i}") for i in range(300)], "item_id int, text string")
    docs = spark.createDataFrame([(f"d{i}", f"{i} {shared}") for i in range(20)], "doc_id string, text string")
    worded = docs.select("doc_id", decontaminate.words_of(docs["text"]).alias("words"))
    assert decontaminate.hit_windows(worded, items, "doc_id").count() == 20 * 3
    assert {(r["n_hit"], r["n_items"]) for r in decontaminate.contamination(docs, items).collect()} == {(12, 300)}
