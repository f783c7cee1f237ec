"""Text operators against brute force, and their defined results for odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import unicodedata
import zlib
from collections import Counter
from html.parser import HTMLParser

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from peerscore.llm import html_text, langid, licenses, packing, simhash, suffix, toxicity
from peerscore.llm.components import components
from peerscore.session import recorded_scratch

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns named like those the operators make.
EXTRA = "piece string, fp string, p_toxic string, item string, row string, chunk string"


def docs(spark, rows, extra=True):
    df = spark.createDataFrame(rows, DOCS)
    return df.select("*", *[F.lit("own").alias(c.split()[0]) for c in EXTRA.split(", ")]) if extra else df


def odd_rows():
    long_text = "very long text here " * 30_000
    return [(1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t ", "en", "s", 4), (4, "one", "en", None, 3),
            (4, "one", "en", None, 3), (None, "no id at all", "en", "s", 12), (5, long_text, "en", "s", len(long_text))]


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


# Packing


def test_pieces_and_places(spark):
    from tokenizers import Tokenizer

    rng = random.Random(5)
    texts = {i: prose(rng, rng.choice([0, 3, 40, 300, 3000])) for i in range(60)}
    texts |= {100: "<|endoftext|> It's <|ENDOFTEXT|> X y\x1cz", 101: "ÀÉ é İ ẞ 1234 ... ?!"}
    rows = [(i, t, "en", "s", len(t)) for i, t in texts.items()] + odd_rows()
    out = packing.pack_documents(docs(spark, rows), block=20).collect()
    model = Tokenizer.from_file(packing.tokenizer_path())
    want = []
    for i, t, *_ in rows:
        ids = np.array([*model.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for n, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want.append((i, n, at, len(part), zlib.crc32(part.tobytes())))
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out), key=key) == sorted(want, key=key)
    bins: dict[int, list] = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(bins) <= 1.02 * -(-sum(w[3] for w in want) // 2048) + 1


def test_ids_of_words_with_a_small_cache(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "CACHE_BYTES", 40_000)
    model, ids = Tokenizer.from_file(packing.tokenizer_path()), packing.WordIds(packing.tokenizer_path())
    rng = random.Random(4)
    words = [prose(rng, 1) for _ in range(400)] + ["été", "é", "e\u0301", "İst", "ǅ", "K", "中文", "日本,", "don't", "it's.", "a1b", "x..", "(y)", "ﬁn!", "ªb", "<|endoftext|>", "a\u200bb", "."]
    for _ in range(200):
        text = " ".join(rng.choice(words) + rng.choice(["", "", ",", ".", "!", "'s", ";)"]) for _ in range(rng.randint(1, 60)))
        cut = text.encode().split() if "<|" in text else text.encode().lower().split()
        assert np.frombuffer(ids.of(cut), dtype="<u4").tolist() == model.encode(text, add_special_tokens=False).ids
        assert ids.held <= 40_000 + 200 * 60


def test_ids_of_texts_in_blocks(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "TEXT_BYTES", 2_000)
    model, ids = Tokenizer.from_file(packing.tokenizer_path()), packing.WordIds(packing.tokenizer_path())
    rng = random.Random(6)
    letters = [c for a, b in re.findall("(.)-(.)", packing._LETTERS) for c in map(chr, range(ord(a), ord(b) + 1))]
    assert all(c.isalpha() and c == c.lower() == unicodedata.normalize("NFC", c) for c in letters)
    odd = "'|<>\u0307\u0301\u0338\u093f\u3099\u200d\u0640\x85\xa0\x1c\x00²½٣µªİẞΣǅ，"
    words = ["".join(rng.sample(letters, rng.randint(1, 4))) for _ in range(3000)] + ["".join(rng.choices("abzéя中7.,!-_%#&\"" + odd, k=rng.randint(1, 5))) for _ in range(3000)]
    words += [w + m for w in ("TEXTİ", "x<|endoftext|>", "don't", "'s's", "a1b22", "été") for m in ("", ".", "%%%", "..!", "'")]
    texts = ["", " ", " \t\x0b\n", "".join(letters), "very long " * 900] + [" ".join(rng.choices(words, k=rng.randint(1, 80))) + rng.choice(["", " ", "\n\x0c"]) for _ in range(300)]
    rng.shuffle(texts)
    got = [np.frombuffer(b, "<u4").tolist() for _, block in packing._in_blocks(pa.array(texts)) for b in packing._ids_of_texts(block, ids)]
    assert got == [model.encode(t, add_special_tokens=False).ids for t in texts]
    blocks = list(packing._in_blocks(pa.array(texts)))
    assert len(blocks) > 5 and [at for at, _ in blocks] == np.cumsum([0] + [len(b) for _, b in blocks])[:-1].tolist()
    assert list(packing._in_blocks(pa.array([], pa.string()))) == []


def test_a_mark_behind_a_letter_that_ends_in_a_mark_once_lowered():
    from tokenizers import Tokenizer

    model, ids = Tokenizer.from_file(packing.tokenizer_path()), packing.WordIds(packing.tokenizer_path())
    for word in ("abİ", "abİ."):
        assert np.frombuffer(ids.of([word.encode()]), "<u4").tolist() == model.encode(word, add_special_tokens=False).ids


def test_a_word_is_encoded_once_whatever_marks_and_texts_it_stands_in():
    ids = packing.WordIds(packing.tokenizer_path())
    seen, encode = [], ids.encode

    def noted(texts, **how):
        seen.extend(w for t in texts for w in t.split())
        return encode(texts, **how)

    ids.encode = noted
    for text in ("one two", "one, two!", "(one) two%%%", "one,two"):
        ids.of(text.encode().split())
    assert sorted(seen) == sorted(["one", "two", ",", "!", "(", ")", "%%%"])


def test_best_fit_takes_the_fullest_bin():
    bins, offsets, fills = packing.best_fit(np.array([6, 5, 4, 3, 2]), 10)
    assert bins.tolist() == [0, 1, 0, 1, 1] and offsets.tolist() == [0, 0, 6, 5, 8] and fills.tolist() == [10, 10]


def test_packing_nothing(spark):
    assert packing.pack_documents(docs(spark, odd_rows()).limit(0)).collect() == []


# Licences


def test_license_rules(spark):
    mit = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\n"
        "in the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\n"
        "copies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n\n"
        "The above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.\n"
    )
    rows = [
        (10, "Words.\nLicensed under the Apache License, Version 2.0.", "en", "s", 1),
        (11, "This work is licensed under the GNU General Public License, version 3.\nReleased under the MIT License.", "en", "s", 1),
        (12, mit, "en", "s", 1),
        (13, "He was licensed under the old rules to publish.", "en", "s", 1),
        (14, "# Licensed under CC BY-NC 4.0!", "en", "s", 1),
        *odd_rows(),
    ]
    got = [(r.doc_id, r.licenses, r.n_licenses) for r in licenses.scan(docs(spark, rows)).collect()]
    by_id = {i: x for i, x, _ in got}
    assert by_id[10] == "Apache-2.0" and by_id[11] == "GPL-3.0-only,MIT" and by_id[12] == "MIT" and by_id[13] == "" and by_id[14] == "CC-BY-NC-4.0"
    assert len(got) == len(rows) and all(x == "" and n == 0 for i, x, n in got if i not in (10, 11, 12, 14))


# Notices as their publishers give them, each with the licence a scan has to name.
NOTICES = [
    ("GPL-3.0-or-later", """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details."""),
    ("GPL-2.0-or-later", """ * This program is free software; you can redistribute it and/or
 * modify it under the terms of the GNU General Public License
 * as published by the Free Software Foundation; either version 2
 * of the License, or (at your option) any later version."""),
    ("GPL-2.0-only", """// This program is free software; you can redistribute it and/or modify
// it under the terms of the GNU General Public License version 2 as
// published by the Free Software Foundation."""),
    ("LGPL-2.1-or-later", """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version."""),
    ("AGPL-3.0-or-later", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as
published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""),
    ("MPL-2.0", """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at http://mozilla.org/MPL/2.0/. */"""),
    ("Apache-2.0", """   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software"""),
    ("BSD-3-Clause", """Copyright (c) 2020, Someone
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
* Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
* Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""),
    ("MIT", """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL"""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""),
    ("MIT", "# SPDX-License-Identifier: MIT"), ("Apache-2.0", "// SPDX-License-Identifier: Apache-2.0"),
    ("GPL-2.0-or-later", "/* SPDX-License-Identifier: GPL-2.0-or-later */"), ("CC-BY-SA-4.0", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    ("BSD-3-Clause", "Words before.\nSPDX-License-Identifier: BSD-3-Clause\nWords behind."),
    ("MIT", "The MIT License (MIT)"), ("MIT", "Words.\nMIT License\nMore words."), ("ISC", "ISC License"),
    ("Apache-2.0", "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/"),
    ("GPL-3.0-only", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n"),
    ("MPL-2.0", "Mozilla Public License Version 2.0\n=================================="),
    ("MIT", "This project is licensed under the MIT License - see the LICENSE file for details."),
]


def test_published_notices_are_recognised(spark):
    rows = [(i, text, "en", "s", 1) for i, (_, text) in enumerate(NOTICES)]
    df = docs(spark, [*rows, (900, "The license of the fisher was free software to him; it was published.", "en", "s", 1)])
    got = {r.doc_id: r.licenses for r in licenses.scan(df).collect()}
    assert got == {i: lic for i, (lic, _) in enumerate(NOTICES)} | {900: ""}
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    assert {r[0]: r[2] for r in con.sql(licenses.scan_sql()).fetchall()} == got
    assert licenses.scan(df.limit(0)).collect() == []


def test_known_sentences_hold_a_cue():
    for s in licenses.known_sentences():
        assert s.startswith("under ") or any(c in s for c in licenses.CUES), s
    assert all(any(re.search(c, v) for c in licenses.CUES) for v in ("licensed", "released", "distributed", "published", "available"))


# Pages


PAGES = [
    ("<html><body><nav><a href=/>Home</a><a href=/b>B</a></nav><div class='post'><h1>Title</h1><p>First, second &amp; third,\n  with  text to read.<p>More, of it, here and there.</div>"
     "<div class=\"comments\"><p>Great post, thanks, really, very good, I like it a lot.</div><footer>&copy; me</footer>", "Title\nFirst, second & third, with text to read.\nMore, of it, here and there."),
    ("<body class='has-sidebar'><header><p>Site, name, and slogan, of this</p></header><main><p>A&#32;b &lt;c&gt; and, more words, to keep in here.</p><script>var a='<p>no</p>'</script><style>p{}</style>"
     "<form><p>Your, name, please, and mail, too</p></form></main><aside><p>An advert, buy, buy, now, and more</p></aside>", "A b <c> and, more words, to keep in here."),
    ("<p>short", "short"), ("", ""), (None, ""), ("<div><ul>" + "<li><a href=x>link text, here, and there</a>" * 5 + "</ul></div>", ""),
    ("<!-- <p>gone</p> --><div hidden><p>hidden, text, in here, yes</p></div><div><p>seen, text, in here, yes</p></div>", "seen, text, in here, yes"),
]


def test_main_text(spark):
    rows = [(i, f"u{i}", page, "own", "own") for i, (page, _) in enumerate(PAGES)] + [(None, None, "<p>x", "own", "own")]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars string")).collect()
    assert [r.text for r in got] == [want for _, want in PAGES] + ["x"]
    assert all(r.n_chars == len(r.text) for r in got)


@pytest.mark.parametrize("around", ["article", "main", "div role=main"])
@pytest.mark.parametrize("n", [1, 40])
def test_an_article_is_kept_whole(around, n):
    """However much longer one part of it is than the others."""
    p = "<p>Some words, with commas, to read, number %d, here.</p>"
    long, short = "".join(p % i for i in range(n)), "".join(p % i for i in range(2))
    parts = ["<h1>Title</h1>", "<p>Lead, short.</p>", f"<section>{long}</section>", f"<section>{short}</section>", "<h4>Steps</h4>",
             "<ul><li>One thing<li>Two things</ul>", "<blockquote>Quote</blockquote>", "<pre>x = 1</pre>", "<table><tr><td>Cell</table>"]
    page = f"<nav><a href=/>Home</a></nav><{around}>{''.join(parts)}<div class=related><p>Other, page, to read</p></div></{around.split()[0]}><footer>me</footer>"
    lines = html_text.main_text(page).split("\n")
    assert lines[:2] == ["Title", "Lead, short."] and lines[-6:] == ["Steps", "One thing", "Two things", "Quote", "x = 1", "Cell"]
    assert len(lines) == 2 + n + 2 + 6


_P = "<p>Words of the page, with commas, to read, part %s, for all.</p>"
_MANY = "".join(_P % i for i in range(8))
_TEXT = [f"Words of the page, with commas, to read, part {i}, for all." for i in range(8)]
_AROUND = "<nav><a href=/>Home</a></nav>%s<div class='comments'><p>Nice, really, nice, I say, well done.</p></div><footer>me</footer>"

KEPT = [
    # Names that only hold a mark as one of their words, around a page without an article element.
    *[(_AROUND % f"<div class='{name}'>{_MANY}</div>", _TEXT) for name in ("layout has-sidebar", "widget-area-none content", "social-science-article", "sidebar")],
    # ... and inside an article.
    ("<article>" + _MANY + "<div class='notice-period'><p>Two, weeks.</p></div><div id='search-results-2020'><p>Found, none.</p></div></article>", [*_TEXT, "Two, weeks.", "Found, none."]),
    # Short parts beside the best container.
    (_AROUND % f"<div><div>{_MANY}</div><ul><li>One<li>Two</ul><div><p>Short, second.</p></div><p>The end.</p></div>", [*_TEXT, "One", "Two", "Short, second.", "The end."]),
    # A list of references in an article.
    ("<article>" + _MANY + "<ol><li><a href=x>First reference</a><li><a href=y>Second reference</a></ol></article>", [*_TEXT, "First reference", "Second reference"]),
    # What has to go, all the same.
    (_AROUND % f"<div><div>{_MANY}</div><ul><li><a href=x>Menu</a><li><a href=y>Other</a></ul><div class='related-posts'><p>More, to read.</p></div><div id=sidebarLeft><p>Side, bar.</p></div></div>", _TEXT),
    ("<div class=comment-list>" + _MANY * 5 + "</div><div><p>The post, itself, is short, but it is here.</p></div>", ["The post, itself, is short, but it is here."]),
]


@pytest.mark.parametrize("n", range(len(KEPT)))
def test_text_is_kept(n):
    page, want = KEPT[n]
    assert html_text.main_text(page).split("\n") == want


class _Article(HTMLParser):
    """The blocks of a page's article element, by the library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.blocks, self.here = [], [], ""

    def end_block(self):
        if text := " ".join(self.here.split()):
            self.blocks.append(text)
        self.here = ""

    def handle_starttag(self, tag, attrs):
        if tag in html_text._BLOCKS:
            self.end_block()
        if tag == "br":
            self.here += " "
        if tag not in html_text._VOID:
            self.open.append("aside" if dict(attrs).get("class") == "ad" else tag)

    def handle_endtag(self, tag):
        if tag in html_text._BLOCKS:
            self.end_block()
        while tag in self.open or tag == "div" and "aside" in self.open:
            if self.open.pop() in (tag, "aside"):
                break

    def handle_data(self, data):
        if "article" in self.open and not {"script", "style", "nav", "aside", "form", "footer", "header"} & set(self.open):
            self.here += data


def test_articles_of_all_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r, got in zip(pages.orderBy("page_id").collect(), html_text.extract(pages).orderBy("page_id").collect()):
        parser = _Article()
        parser.feed(r.html or "")
        parser.close()
        assert got.text.split("\n") == (parser.blocks or [""]), r.page_id


def test_repeated_and_no_pages(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, "u", "<p>Same, text, in here.", "own", "own")] * 3
    df = spark.createDataFrame(rows, schema)
    assert [r.text for r in html_text.extract(df).collect()] == ["Same, text, in here."] * 3
    assert html_text.extract(df.limit(0)).collect() == []


def test_very_long_page():
    body = "".join(f"<p>Sentence {i}, with a comma, and some words.</p>" for i in range(20_000))
    assert html_text.main_text(f"<article>{body}</article>").count("\n") == 19_999


# SimHash


def _fingerprint(text):
    import xxhash

    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _roots(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(2)
    base = prose(rng, 400)
    texts = [prose(rng, rng.randint(1, 80)) for _ in range(60)] + [base] * 5 + ["Ünï Ä B", "b", "B"]
    for _ in range(120):
        words = base.split()
        for _ in range(rng.randint(1, 6)):
            words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts, start=50)] + odd_rows()
    got = simhash.near_duplicates(docs(spark, rows)).collect()
    fps = [_fingerprint(t) for _, t, *_ in rows]
    roots = _roots([(a, b) for a in set(fps) for b in set(fps) if a < b and (a ^ b).bit_count() <= 2], set(fps))
    least: dict[int, int] = {}
    for (i, *_), fp in zip(rows, fps):
        if i is not None:
            least[roots[fp]] = min(least.get(roots[fp], i), i)
    key = lambda r: (r[0] is None, r)
    want = sorted(((i, f"{fp:016x}", least.get(roots[fp])) for (i, *_), fp in zip(rows, fps)), key=key)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=key) == want
    assert len({c for _, _, c in want}) < len(rows) - 30  # some texts are linked
    kept = simhash.one_of_each(docs(spark, rows))
    assert kept.columns == docs(spark, rows).columns
    assert sorted(((r.doc_id is None, r.doc_id) for r in kept.collect())) == sorted({(c is None, c) for _, _, c in want})


@pytest.mark.parametrize("leaf", [8, 50])
def test_leaves_find_all_pairs(leaf):
    rng = np.random.default_rng(4)
    seeds = rng.integers(0, 2**63, 40, dtype=np.uint64)
    points = np.unique([int(s) ^ (1 << int(a)) ^ (1 << int(b)) for s in seeds for a, b in rng.integers(0, 64, (20, 2))]).astype(np.uint64)
    tree, leaves = simhash.fit_tree(points[::3], leaf)
    met: dict[int, list] = {}
    for number, index, own in simhash.route(tree, points, np.arange(len(points)), np.ones(len(points), dtype=bool), 2):
        met.setdefault(number, []).append((index, own))
    assert leaves > 3 and sum(int(own.sum()) for x in met.values() for _, own in x) == len(points)
    links = []
    for parts in met.values():
        index, own = (np.concatenate(x) for x in zip(*parts))
        links += [(int(index[a]), int(index[b])) for a, b in simhash.link_leaf(points[index], own, 2)]
    near = [(i, j) for i in range(len(points)) for j in range(i) if (int(points[i]) ^ int(points[j])).bit_count() <= 2]
    assert _roots(links, range(len(points))) == _roots(near, range(len(points)))
    assert all((int(points[a]) ^ int(points[b])).bit_count() <= 2 for a, b in links)


def test_components_of_a_chain(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


# Repeated strings


def _removed(rows):
    """doc_id, n_bytes, n_removed, n_spans, sha256 by the definition."""
    first: dict[bytes, int] = {}
    raw = [(2**63 - 1 if i is None else i, (t or "").encode()) for i, t, *_ in rows]
    for i, b in raw:
        for k in range(len(b) - 49):
            first[b[k : k + 50]] = min(first.get(b[k : k + 50], i), i)
    out = []
    for (i, b), (own, *_) in zip(raw, rows):
        gone = np.zeros(len(b) + 1, dtype=bool)
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < i:
                gone[k : k + 50] = True
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((own, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def _repeating_rows():
    rng = random.Random(9)
    shared = [prose(rng, 30) for _ in range(4)]
    rows = []
    for i in range(120):
        parts = [prose(rng, rng.randint(0, 30)) for _ in range(3)]
        if i % 3 == 0:
            parts.insert(1, rng.choice(shared))
        if i % 10 == 0:
            parts.append("ab" * 60)
        if i % 17 == 0:
            parts.append("é" * 40 + shared[0][3:70])
        rows.append((200 - i, " ".join(parts), "en", "s", 1))
    return [*rows, rows[0], rows[3], (999, rows[5][1], "en", "s", 1), *odd_rows()[:-1], (5, "very long text here " * 400, "en", "s", 1)]


@pytest.mark.parametrize("hot", [2, 256])
def test_repeats_equal_brute_force(spark, hot):
    """With ``hot=2`` every frequent anchor goes window by window."""
    rows = _repeating_rows()
    got = suffix.remove_repeats(docs(spark, rows).repartition(3), hot=hot, per_range=2000, chunk_size=3000).collect()
    key = lambda r: (r[0] is None, tuple(r[1:]) if r[0] is None else tuple(r))
    assert sorted((tuple(r) for r in got), key=key) == sorted(_removed(rows), key=key)


def test_repeats_beside_a_hot_passage(spark):
    """Documents in chunks of their own that share one rare side of an anchor, whose other side is hot for one of them."""
    rng = random.Random(4)
    passage = prose(rng, 40)
    texts = [passage + prose(rng, 10) for _ in range(6)] + [prose(rng, 10) + passage for _ in range(6)]
    for i in range(30):
        tail = prose(rng, 12)
        texts += [passage + tail, prose(rng, 5) + passage[-20 - i % 10 :] + tail]
        texts += [tail[::-1] + passage, tail[::-1] + passage[: 20 + i % 10] + prose(rng, 5)]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    got = suffix.remove_repeats(docs(spark, rows).repartition(2), hot=3, per_range=200, chunk_size=1).collect()
    assert sorted(map(tuple, got)) == sorted(_removed(rows))


def test_shortened_keeps_all_columns(spark):
    rows = _repeating_rows()
    df = docs(spark, rows)
    got = suffix.shortened(df.repartition(2), per_range=2000, chunk_size=3000)
    assert got.schema.simpleString() == df.schema.simpleString()
    found = sorted((r.doc_id is None, r.doc_id, r.n_chars, r.text is None, len((r.text or "").encode())) for r in got.collect())
    want = sorted((i is None, i, n, t is None, w[1] - w[2]) for (i, t, _, _, n), w in zip(rows, _removed(rows)))
    assert found == want or all(a[:4] == b[:4] and a[4] <= b[4] for a, b in zip(found, want))


def test_shortened_keeps_types_and_clashing_names(spark):
    rows = _repeating_rows()[:40]
    df = docs(spark, rows, extra=False).select(
        "*", F.timestamp_micros(F.lit(1_700_000_000_123_456) + F.coalesce("doc_id", F.lit(0))).alias("seen"), F.unhex(F.lit("00ff80")).alias("raw"),
        F.create_map(F.lit("k"), F.col("doc_id")).alias("pairs"), F.lit("mine").alias("_was_null"), F.lit("own").alias("carried"), F.lit(1).alias("kept"),
        F.struct(F.lit(None).cast("decimal(20,3)").alias("absent"), F.array(F.lit("x")).alias("row")).alias("row"), F.lit("d").alias("a.b"),
    )
    got = suffix.shortened(df.repartition(2), per_range=2000, chunk_size=3000)
    assert got.schema.simpleString() == df.schema.simpleString()
    without = lambda frame: sorted(repr([v for c, v in r.asDict().items() if c != "text"]) for r in frame.collect())
    assert without(got) == without(df)


def test_tables_of_chunks_can_be_dropped(spark):
    before, made = len(spark.catalog.listTables()), []
    with recorded_scratch(made):
        suffix.remove_repeats(docs(spark, _repeating_rows())).collect()
    assert len(spark.catalog.listTables()) == before + 1
    suffix.forget(spark, made)
    assert len(spark.catalog.listTables()) == before


def test_no_documents_no_repeats(spark):
    assert suffix.remove_repeats(docs(spark, odd_rows()).limit(0)).collect() == []


def test_anchors_at_the_end_of_a_slice(monkeypatch):
    text = np.random.default_rng(2).integers(97, 105, suffix._SLICE + 60, dtype=np.uint8)
    starts = np.array([0, suffix._SLICE - 200])
    sizes = range(suffix._SLICE + 20, suffix._SLICE + 56)
    sliced = [suffix.anchors(text[:n], starts, np.array([starts[1], n])) for n in sizes]
    monkeypatch.setattr(suffix, "_SLICE", 1 << 20)
    for n, got in zip(sizes, sliced):
        for a, b in zip(got, suffix.anchors(text[:n], starts, np.array([starts[1], n]))):
            assert a.tolist() == b.tolist()


def test_anchor_steps_round_trip():
    for position in ([], [0], [3, 4, 300, 1000, 1254, 1509, 70_000]):
        assert suffix._positions(suffix._steps(np.array(position, dtype=np.int64))).tolist() == position


# Toxicity


def test_chain_finds_toxic_words(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 5 == 0
        words = prose(rng, 60).split()
        if toxic:
            words[3:3] = rng.sample(["idiot", "moron", "trash", "scum,", "Pathetic"], 3)
        rows.append((i, " ".join(words), "en", "s", 1))
        if i % 2 == 0:
            labels.append((i, 1, int(toxic), "own"))
    df = docs(spark, rows + odd_rows())
    marked = spark.createDataFrame([*labels, (7, 1, None, "x"), (None, 1, 1, "x"), (12345, 0, 1, "x")], "doc_id long, quality int, toxic int, text string")
    got = toxicity.classify(df, marked)
    assert got.columns == ["doc_id", "p_insult", "p_contempt", "p_toxic", "is_toxic"]
    by_id = {(r.doc_id): r for r in got.collect()}
    assert got.count() == len(rows) + len(odd_rows())
    wrong = [i for i, *_ in rows if i not in (1, 2, 3, 4, 5) and by_id[i].is_toxic != (i % 5 == 0)]
    assert len(wrong) <= 4
    assert not by_id[None].is_toxic
    left = toxicity.without_toxic(df, toxicity.train(df, marked))
    assert left.columns == df.columns and left.schema == df.schema
    assert abs(left.count() - (len(rows) * 4 // 5 + len(odd_rows()))) <= 4


def _plain_logistic(x, y, penalty, rounds=30_000):
    """Proximal gradient steps without acceleration, row by row weights or grouping."""
    full = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(full.shape[1])
    step = 4 * len(x) / np.linalg.norm(full, 2) ** 2
    for _ in range(rounds):
        w = w - step * full.T @ (1 / (1 + np.exp(-full @ w)) - y) / len(x)
        w[:-1] = np.sign(w[:-1]) * np.maximum(np.abs(w[:-1]) - step * penalty, 0)
    return w


def test_chain_equals_a_plain_fit():
    rng = np.random.default_rng(3)
    x = (rng.random((240, 5)) < 0.4).astype(float)
    first = (rng.random(240) < np.where(x[:, 0] > 0, 0.85, 0.1)).astype(int)
    second = (rng.random(240) < np.where(first + x[:, 1] > 1, 0.9, 0.15)).astype(int)
    names = [f"w{i}" for i in range(5)]
    chain = toxicity.fit_chain(toxicity.Features(names), x, np.column_stack([first, second]))
    fold = np.arange(240) % toxicity.FOLDS
    apart = np.zeros(240)
    sigmoid = lambda w, rows: 1 / (1 + np.exp(-(np.column_stack([rows, np.ones(len(rows))]) @ w)))
    for f in range(toxicity.FOLDS):
        apart[fold == f] = sigmoid(_plain_logistic(x[fold != f], first[fold != f], toxicity.PENALTY), x[fold == f])
    models = [_plain_logistic(x, first, toxicity.PENALTY), _plain_logistic(np.column_stack([x, apart]), second, toxicity.PENALTY)]
    texts = [" ".join(n for n, v in zip(names, row) if v) for row in x]
    got = chain.probabilities(texts)
    p_first = sigmoid(models[0], x)
    assert np.allclose(got[:, 0], p_first, atol=0.01)
    assert np.allclose(got[:, 1], sigmoid(models[1], np.column_stack([x, p_first])), atol=0.02)


def test_an_own_text_column_stays(spark):
    df = docs(spark, [(1, "idiot words", "en", "s", 1), (2, None, "en", "s", 1)], extra=False).withColumn("_text", F.lit(7))
    none = toxicity.Chain(toxicity.Features([]), [(np.zeros(n), -1.0) for n in range(3)])
    out = toxicity.score(df, none)
    assert out.columns[: len(df.columns)] == df.columns and [r._text for r in out.collect()] == [7, 7]


def test_without_labels_nothing_is_toxic(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.classify(docs(spark, odd_rows()), none).collect()
    assert len(got) == len(odd_rows()) and not any(r.is_toxic for r in got)
    assert toxicity.classify(docs(spark, odd_rows()).limit(0), none).collect() == []


# Languages


def test_languages_are_told_apart(spark):
    rng = random.Random(8)
    stems = {"aa": "abcde", "bb": "fghij", "cc": "klmnñ"}
    rows = [(i, " ".join("".join(rng.choice(stems[lang]) for _ in range(5)) for _ in range(30)), lang, "s", 1) for i, lang in enumerate(["aa", "bb", "cc"] * 80, start=10)]
    rows += [*odd_rows(), (900, "1234 !!! ...", "aa", "s", 1), (901, "abcab", None, "s", 1)]
    got = langid.identify(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].lang_pred == lang for i, _, lang, *_ in rows[:240])
    assert all(by_id[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, *_ in rows[:240])
    assert all(0 <= r.score <= 1 for r in got)
    assert all((by_id[i].lang_pred, by_id[i].score) == ("und", 0.0) for i in (1, 2, 3, 900))
    assert by_id[901].lang_pred == "aa"


def _plain_centroids(rows, per_language):
    """The model by plain steps: every n-gram counted in a dictionary, documents chosen by sorting all of them."""

    def counted(text):
        raw = (" " + text.lower() + " ").encode()
        raw = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in raw)
        out = Counter()
        for n in (2, 3, 4):
            for at in range(len(raw) - n + 1):
                value = int.from_bytes(raw[at : at + n], "big")
                out[((value + n) * 2654435761 % 2**32) >> (32 - langid.BITS)] += 1
        return out

    learnt = [(str(i), t, lang) for i, t, lang, *_ in rows if t is not None and lang is not None and zlib.crc32(str("" if i is None else i).encode()) % 4 != 2]
    seen = Counter(place for _, t, _ in learnt for place in counted(t))
    idf = np.array([np.log((1 + len(learnt)) / (1 + seen[p])) + 1 for p in range(langid.SIZE)])

    def vector(text):
        x = np.zeros(langid.SIZE)
        for place, n in counted(text).items():
            x[place] = np.log1p(n) * idf[place]
        return x / max(np.linalg.norm(x), 1e-12)

    means = {}
    for lang in sorted({lang for *_, lang in learnt}):
        own = {i: t for i, t, of in learnt if of == lang and langid.has_letters(t)}
        x = np.stack([vector(t) for t in own.values()])
        means[lang] = x.mean(0) / np.linalg.norm(x.mean(0))
    return vector, means


def test_languages_equal_a_plain_fit(spark):
    """With one centroid for a language the model is the mean of its documents' vectors."""
    rng = random.Random(18)
    stems = {"aa": "abcdex", "bb": "abfghx", "cc": "klmñx"}
    rows = [(i, " ".join("".join(rng.choice(stems[lang]) for _ in range(rng.randint(1, 6))) for _ in range(12)), lang, "s", 1) for i, lang in enumerate(["aa", "bb", "cc"] * 60)]
    df = docs(spark, rows).repartition(3)
    model = langid.fit(df, per_language=1000, centroids=1)
    vector, means = _plain_centroids(rows, 1000)
    assert model.languages == sorted(means)
    assert np.allclose(model.matrix, np.stack([means[lang] for lang in model.languages]), atol=1e-4)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(df, model).collect()}
    for i, text, *_ in rows:
        near = {lang: float(vector(text) @ mean) for lang, mean in means.items()}
        assert got[i][0] == max(near, key=near.get) and got[i][1] == pytest.approx(max(near.values()), abs=1e-4)


def test_few_documents_of_a_language_reach_a_task(spark):
    rows = [(i, "abc def", "aa" if i % 10 else "bb", "s", 1) for i in range(6000)]
    model = langid.fit(docs(spark, rows).repartition(40), per_language=20)
    assert model.languages == ["aa", "bb"]


def test_nothing_to_learn_from(spark):
    rows = [(i, "some words", None, "s", 1) for i in range(5)]
    assert {r.lang_pred for r in langid.identify(docs(spark, rows)).collect()} == {"und"}
    assert langid.identify(docs(spark, rows).limit(0)).collect() == []
