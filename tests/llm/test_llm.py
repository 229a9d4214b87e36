"""Operators of the training-data pipeline against brute force and on odd rows."""

import hashlib
import os
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from compare import connect, differences
from starmart.llm import bpe, chat, components, exact_dedup, html_text, langid, licenses, mixing, quality, simhash, topk
from starmart.llm.common import take_rows
from starmart.llm.queries import ORACLE, QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

# NULLs in every column, empty texts, repeated rows, ties, a long text.
LONG = "word " * 300_000 + "end"
ODD = [
    (1, "Hello there world again", "en", "a", 1),
    (1, "Hello there world again", "en", "a", 1),
    (2, "hello THERE world again", "en", None, None),
    (None, "hello there world again", None, "b", 1),
    (None, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, "  \n", "fr", "b", 0),
    (6, "ÄÖÜ 12 !!", "de", "c", 0),
    (7, LONG, "en", "a", 0),
    (8, LONG + " x", "en", "a", 0),
    (9, "123 456", None, "c", 0),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@needs_data
@pytest.mark.parametrize("name", ORACLE)
def test_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) == []


def _fingerprint(text):
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    runs = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def _components(prints, most=3):
    """Index of the first row of each row's component."""
    root = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= most and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return root


@needs_data
def test_simhash_equals_brute_force(docs):
    rows = sorted(docs.select("doc_id", "text").collect())
    prints = [_fingerprint(r["text"]) for r in rows]
    want = {r[0]: (f"{p:016x}", rows[c][0]) for r, p, c in zip(rows, prints, _components(prints), strict=True)}
    assert {r[0]: (r[1], r[2]) for r in simhash.near_duplicates(docs).collect()} == want


def test_simhash_odd_rows(odd):
    found = [tuple(r) for r in simhash.near_duplicates(odd).collect()]
    assert len(found) == len(ODD)
    zero = {r for r in found if r[1] == "0" * 16}
    assert {r[0] for r in zero} == {None, 4, 5} and {r[2] for r in zero} == {4}
    assert {r[2] for r in found if r[0] in (1, 2)} == {1}
    left = simhash.drop_near_duplicates(odd)
    assert left.columns == odd.columns and left.where("doc_id = 1").count() == 1
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["1", "4", "6", "7", "9"]


@pytest.mark.parametrize("max_file", [65_536, 2])
def test_links_lose_no_component(spark, max_file):
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 2**63, 12, dtype=np.uint64).tolist()
    prints = set(seeds)
    for s in seeds[:6]:
        for _ in range(25):
            flipped = s
            for b in rng.integers(0, 64, rng.integers(1, 4)):
                flipped ^= 1 << int(b)
            prints.add(flipped)
            s = flipped if rng.random() < 0.3 else s
    prints = sorted(prints)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    nodes = spark.createDataFrame([(p,) for p in signed], "fp long")
    rooted = {r["fp"]: r["root"] for r in simhash.classes(nodes, max_file).collect()}
    groups = {}
    for p, r in rooted.items():
        groups.setdefault(r, set()).add(p)
    want = {}
    for p, c in zip(signed, _components(prints), strict=True):
        want.setdefault(c, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_path_a_star_and_none(spark):
    path = [(i + 1, i) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)] + [(100, 100)]
    found = components.components(spark.createDataFrame(path + star, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in found} == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_exact_dedup_odd_rows_and_second_batch(spark, odd):
    index = exact_dedup.DigestIndex.temporary(spark)
    rows = exact_dedup.deduplicate(exact_dedup.digests(odd), index).collect()
    assert len(rows) == len(ODD)
    same = [r for r in rows if r["text_sha256"] == hashlib.sha256(b"hello there world again").hexdigest()]
    assert {(r["keep_id"], r["group_size"]) for r in same} == {(2, 4)} and sum(r["kept"] for r in same) == 1
    empty = [r for r in rows if r["text_sha256"] == hashlib.sha256(b"").hexdigest()]
    assert {(r["doc_id"], r["kept"]) for r in empty} == {(None, False), (4, True)}
    more = spark.createDataFrame([(50, "HELLO there world again"), (51, "new")], "doc_id long, text string")
    again = {r["doc_id"]: r for r in exact_dedup.deduplicate(exact_dedup.digests(more), index).collect()}
    assert not again[50]["kept"] and again[50]["keep_id"] == 2 and again[51]["kept"]
    plan = index.unseen(exact_dedup.groups_of(exact_dedup.digests(more)))._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    left = exact_dedup.drop_duplicates(odd)
    assert left.columns == odd.columns and left.count() == 7


def test_identical_rows_leave_one(spark):
    twice = spark.createDataFrame([(3, "A b"), (3, "A b"), (3, "a b")], "doc_id long, text string")
    assert exact_dedup.drop_duplicates(twice).count() == 1
    assert simhash.drop_near_duplicates(twice).count() == 1


def test_clashing_columns(spark):
    names = "doc_id long, text string, _mark long, mark string, id long, fp long, rows long, copies long, score long, lang string, source string"
    row = (1, "some words here now", 5, "m", 6, 7, 8, 9, 10, "en", "s")
    docs = spark.createDataFrame([row, (2, *row[1:])], names)
    for stage in (exact_dedup.drop_duplicates, simhash.drop_near_duplicates, langid.keep_known, mixing.mixed_rows):
        left = stage(docs)
        assert left.columns == docs.columns and {tuple(r)[1:] for r in left.collect()} <= {row[1:]}


def test_take_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (2, "c")], "i long, t string")
    picks = spark.createDataFrame([(1, "a", 2, 3), (None, "b", 1, 1), (2, "c", 1, 0)], "id long, mark string, rows long, copies long")
    found = sorted(map(str, (tuple(r) for r in take_rows(docs, picks, "i", F.col("t")).collect())))
    assert found == sorted(map(str, [(1, "a")] * 3 + [(None, "b")]))


def test_preference_pairs(spark):
    turns = [
        (0, 0, "user", "q"), (0, 1, "assistant", "same"), (0, 2, "user", "x"), (0, 3, "assistant", "good"),
        (1, 0, "user", "q"), (1, 1, "assistant", "same"), (1, 2, "user", "x"), (1, 3, "assistant", None),
        (2, 0, None, "alone"), (None, 0, "user", "lost"), (4, 0, "user", "e"), (5, 0, "user", "e"),
    ]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    found = chat.preference_pairs(frame, F.floor(F.col("conv_id") / 2).cast("long"), F.col("conv_id") % 2 == 0)
    rows = {r["pair_id"]: r for r in found.collect()}
    assert set(rows) == {0, 1, 2}
    assert rows[0]["prompt"] == "<|user|>\nq\n<|assistant|>\nsame\n<|user|>\nx\n"
    span = rows[0]["chosen_mask"][0]
    assert rows[0]["chosen"][span["begin"] : span["end"]] == "good"
    assert rows[0]["rejected"] == "<|assistant|>\n\n" and rows[1]["prompt"] == "" == rows[1]["rejected"]
    assert rows[2]["prompt_turns"] == 1 and rows[2]["chosen"] == "" and rows[2]["chosen_mask"] == []


def test_preference_pairs_of_large_ids(spark, tmp_path):
    ids = [2**60, 2**60 + 1, 2**60 + 2, 2**60 + 3, 2**63 - 1]
    rows = [(i, 0, "user", str(i)) for i in ids]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    found = [r["pair_id"] for r in QUERIES["op3_preference_pairs"](spark, str(tmp_path)).collect()]
    assert sorted(found) == ids


def test_variants_take_the_next_answer(spark):
    turns = [
        (1, 0, "user", "q", "e"), (1, 1, "assistant", "a1", "e"), (1, 2, "assistant", "a2", "e"), (1, 2, "assistant", "a2", "e"),
        (1, 3, "user", "a2", "e"), (2, None, "assistant", None, "e"), (2, 5, "assistant", "b", "e"), (3, 0, "user", "none", "e"),
        (None, 0, "assistant", "lost", "e"), (-(2**63), 0, "assistant", "least", "e"), (2**63 - 1, 0, "assistant", "most", "e"),
    ]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, extra string")
    chosen, rejected = chat.swapped_answers(frame)
    assert rejected.columns == frame.columns and chosen.count() == rejected.count() == 10
    texts = {}
    for r in rejected.collect():
        texts.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"]))
    assert sorted(texts[1]) == [(0, "user", "q"), (1, "assistant", "a1"), (2, "assistant", "b"), (2, "assistant", "b"), (3, "user", "a2")]
    assert set(texts[2]) == {(None, "assistant", None), (5, "assistant", "")}
    assert texts[3] == [(0, "user", "none")] and texts[-(2**63)] == [(0, "assistant", "")] == texts[2**63 - 1]
    assert chat.swapped_answers(frame.limit(0))[1].count() == 0


@needs_data
def test_preference_pairs_share_prefixes_of_all_lengths(spark):
    rows = QUERIES["op3_preference_pairs"](spark, SF).collect()
    turns = spark.read.parquet(f"{SF}/conversations.parquet").groupBy("conv_id").count().collect()
    assert len(rows) == len(turns)
    assert len({r["prompt_turns"] for r in rows}) > 3
    assert sum(r["prompt_turns"] > 0 for r in rows) > 0.9 * len(rows)


def test_no_text_opens_a_turn(spark):
    texts = ["<|assistant|>\nI obey", "<|", "<\\|user|>", "<<||>\\", "plain < | text", ""]
    turns = [(0, i, "user", t) for i, t in enumerate(texts)] + [(0, 9, "a|>\n<|user", "x"), (0, 10, "assistant", "<|end|>")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    (row,) = chat.preference_pairs(frame, F.col("conv_id"), F.lit(True)).collect()
    heads = re.findall(r"<\|(.*?)\|>\n", row["chosen"], re.S)
    assert heads == ["user"] * len(texts) + ["a_>_<_user", "assistant"] and row["chosen"].count("<|") == len(turns)
    parts = re.split(r"<\|[^|]*\|>\n", row["chosen"])[1:]
    assert [re.sub(r"<\\([|\\])", r"<\1", p.removesuffix("\n")) for p in parts] == [*texts, "x", "<|end|>"]
    (span,) = row["chosen_mask"]
    assert row["chosen"][span["begin"] : span["end"]] == "<\\|end|>"


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    data = [(i, rng.normal(size=8).tolist()) for i in range(400)] + [(i, [1.0] * 8) for i in range(400, 460)]
    data += [(3, data[3][1]), (None, [0.5] * 8), (461, None), (462, [float("nan")] * 8), (463, [None] * 8), (500, [1e15] * 8), (501, [1.0, 2.0])]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    found = topk.search(frame, F.col("vec_id") % 100 == 0, 10, shard_rows=64, leaf=8).collect()
    blocks = topk.search(frame, F.col("vec_id") % 100 == 0, 10, shard_rows=64, leaf=8, block_queries=2)
    assert sorted(map(tuple, blocks.collect())) == sorted(map(tuple, found))
    ints = {i: [int(np.floor(1024 * x)) for x in v] for i, v in data if i is not None and v and len(v) == 8 and None not in v and v[0] == v[0]}
    for q in (0, 100, 200, 300, 400, 500):
        scores = {i: sum(a * b for a, b in zip(ints[q], v, strict=True)) for i, v in ints.items() if i != q}
        best = sorted((-max(1 - 2**63, min(2**63 - 1, s)), i) for i, s in scores.items())[:10]
        got = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        assert got == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert topk.search(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0


TEXTS = ["", None, "a", "it's  two\n\n lines \t end ", "x<|endoftext|>y <|endoftext|>", "ÄÖ ½ Ⅻ ͸࢏ 中文 \U0001f600!", "a b c\x00d\x85e", "  ", LONG[:50_000]]


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    frame = spark.createDataFrame(list(enumerate(TEXTS)) + [(None, "n"), (0, "twice")], "doc_id long, text string")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for i, t in [*enumerate(TEXTS), (None, "n"), (0, "twice")]:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        decoded = tok.decode(ids, skip_special_tokens=False)
        assert decoded == (t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(decoded)))
    for size in (64_000_000, 3):
        got = [tuple(r) for r in bpe.encode_documents(frame, tokenizer_path(), chunk_chars=size).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert bpe.encode_documents(frame.limit(0), tokenizer_path()).count() == 0


def test_packed_numbers_round_trip():
    rng = np.random.default_rng(2)
    for numbers in ([], [0], [127, 128, 255, 256, 2**31 - 1], rng.integers(0, 2**31 - 1, 1_100_000), rng.zipf(1.2, 5_000) % 10**6):
        found = bpe._unpack_numbers(bpe._pack_numbers(np.array(numbers, np.int32)))
        assert found.dtype == np.int32 and found.tolist() == list(numbers)


def test_decode_ids(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    rows = [(i, tok.encode(t, add_special_tokens=False).ids) for i, t in enumerate(TEXTS) if t]
    found = bpe.decode_ids(spark.createDataFrame(rows, "i int, ids array<int>"), "i", tokenizer_path())
    assert {r["i"]: bytes(r["decoded"]).decode() for r in found.collect()} == {i: TEXTS[i] for i, _ in rows}


def test_licenses(spark):
    texts = [
        "Text. Released under the MIT License.", None, "", "LICENSED under CC BY-NC 4.0!\nmore",
        "This program is free software. Words. You can redistribute it and/or modify it under the terms of the GNU General Public License. "
        "This program is distributed in the hope that it will be useful, but without any warranty.",
        "You may obtain a copy of the License at\nYou may not use this file except in compliance with the License.",
        LONG + "\nReleased under the MIT License.",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r[0]: (list(r[1]), list(r[2])) for r in licenses.scan_licenses(frame).collect()}
    assert [found[i][1] for i in range(7)] == [["MIT"], [], [], ["CC-BY-NC-4.0"], ["GPL"], [], ["MIT"]]
    assert found[5][0] == ["apache-2.0-copy", "apache-2.0-terms"]


MIT_TEXT = """MIT License

Copyright (c) 2020 A. Person

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
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD_TEXT = """Copyright (c) 2020, A. Person

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE.
"""
GPL_TEXT = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
"""
APACHE_TEXT = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
"""


def test_published_licenses(spark):
    cut = "Words\nAll rights\nreserved.\r\nReleased under the MIT License\nmore words"
    texts = [MIT_TEXT, BSD_TEXT, GPL_TEXT, APACHE_TEXT, "Words. All rights reserved.", cut, "All rights\n\nreserved.", MIT_TEXT.replace("\n", "\r\n")]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r[0]: list(r[2]) for r in licenses.scan_licenses(frame).collect()}
    reserved = "All-Rights-Reserved"
    want = [["MIT"], ["BSD"], ["GPL-3.0"], ["Apache-2.0"], [reserved], [reserved, "MIT"], [], ["MIT"]]
    assert [found[i] for i in range(8)] == want


def test_main_text():
    model = html_text.Model.fit([(p, html_text.by_attribute(p)) for p in map(html_text.parse, html_text.written_pages())])
    line = "Some words that make a sentence of the story, &amp; an end&hellip;"
    shown = "Some words that make a sentence of the story, & an end…"
    page = (
        f'<body><header><h1>Site</h1></header><nav><a href="/">Home</a></nav><div class="cookie">{line}</div><main><h1>Top</h1>'
        f'<p>{line}<br>\n <b>bold</b><p>{line}</p><div class="ad">{line}</div></main><aside><p>{line}</p></aside>'
        f'<section class="comments"><p>{line}</p></section><form><p>{line}</p></form><script>var a="</p>";</script>'
        f"<footer>{line}</footer>"
    )
    assert html_text.extract(page, model) == f"Top\n\n{shown} bold\n\n{shown}"
    assert [html_text.extract(t, model) for t in (None, "", "<", "<div>" * 20_000)] == [""] * 4
    content = model.marginals(html_text.parse(page))
    assert all(0.0 <= p <= 1.0 for p in content)


def test_marginals_equal_enumeration():
    model = html_text.Model.fit([(p, html_text.by_attribute(p)) for p in map(html_text.parse, html_text.written_pages())])
    page = html_text.parse("<body><div><p>one two<a href=x>three</a></p></div><footer>four</footer></body>")
    own, tied = model._potentials(page)
    n, total, on = len(page.tags), 0.0, np.zeros(len(page.tags))
    for code in range(2**n):
        state = [code >> k & 1 for k in range(n)]
        weight = np.exp(sum(own[k][state[k]] for k in range(n)) + sum(tied[k][state[page.parents[k]]][state[k]] for k in range(1, n)))
        total += weight
        on += weight * np.array(state)
    assert np.allclose(model.marginals(page), on / total)


@needs_data
def test_main_text_of_the_pages(spark):
    import html

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for row in QUERIES["op7_main_text"](spark, SF).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[row["page_id"]], re.S)[1]
        plain = re.sub(r"<[^>]+>", "", re.sub(r"<br>", " ", re.sub(r"</?(p|h1)>", "\0", inner)))
        blocks = (" ".join(html.unescape(b).split()) for b in plain.split("\0"))
        assert row["text"] == "\n\n".join(b for b in blocks if b) and row["n_chars"] == len(row["text"])


@needs_data
def test_quality_held_out(spark):
    sf = SF.replace("0.001", "0.01")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op8_quality"](spark, sf).collect()
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    right = np.mean([r["predicted"] == labels[r["doc_id"]] for r in held])
    assert len(held) > 50 and right > 0.97 and all(0 <= r["score"] <= 1 for r in rows)


def test_quality_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (7, None, 1), (999, 0, 0)], "doc_id long, quality int, toxic int")
    rows = quality.quality(odd, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["score"] == 0.5 for r in quality.quality(odd, labels.limit(0)).collect())
    # Rows that share an id vote once, whatever their number.
    plain = odd.select(F.col("doc_id").alias("id"), "text")
    assert len(quality.learn(plain, labels.select(F.col("doc_id").alias("id"), "quality")).labels) == 1


@needs_data
def test_mixing_meets_targets(spark, docs):
    rows = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    sizes, taken, target = {}, {}, {}
    for r in rows:
        s = source[r["doc_id"]]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
        target[s] = r["target"]
        assert r["taken"] % max(r["size"], 1) == 0 and r["taken"] <= 3 * r["size"]
    names = sorted(sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        share = rest / sum(weight[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and share * weight[s] > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    largest = {s: max(r["size"] for r in rows if source[r["doc_id"]] == s) for s in names}
    for s in names:
        assert target[s] == pytest.approx(3 * sizes[s] if s in capped else share * weight[s])
        assert abs(taken[s] - target[s]) <= largest[s]


def test_mixing_odd_rows(spark, odd):
    rows = mixing.mix(odd, group_rows=2).collect()
    assert len(rows) == len(ODD) and all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert mixing.mix(odd.limit(0)).count() == 0
    left = mixing.mixed_rows(odd, group_rows=2)
    assert left.columns == odd.columns
    words = sum(len((r["text"] or "").split()) for r in left.collect())
    assert words == sum(r["taken"] for r in rows)


def test_mixed_rows_keep_sources_and_columns(spark):
    names = "doc_id long, text string, source string, a string, b string"
    docs = spark.createDataFrame(
        [(1, "some words", s, a, b) for s in ("x", "y", None) for a, b in (("p", None), (None, "p"), ("p", "p"))], names
    )
    taken = {}
    for r in mixing.mixed_rows(docs, weights=(1.0, 1.0, 1.0)).collect():
        taken[tuple(r)] = taken.get(tuple(r), 0) + 1
    # Equal weights of equal sources: each row comes once.
    assert taken == {tuple(r): 1 for r in docs.collect()}


def test_pivot_keeps_words_and_expectation():
    rng = np.random.default_rng(1)
    sizes, chances = np.array([5.0, 3.0, 8.0, 2.0]), np.array([0.3, 0.6, 0.5, 0.9])
    tried = np.array([mixing.pivot(sizes, chances, rng)[0] for _ in range(6000)])
    assert np.allclose(tried @ sizes, chances @ sizes)
    assert ((tried > 0) & (tried < 1)).sum(1).max() <= 1
    assert np.allclose(tried.mean(0), chances, atol=0.03)


@needs_data
def test_languages_held_out(spark):
    sf = SF.replace("0.001", "0.01")
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op10_language"](spark, sf).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in rows]) > 0.98


def test_languages_odd_rows(spark, odd):
    rows = langid.languages(odd).collect()
    assert len(rows) == len(ODD)
    assert sum(r["lang_pred"] == "und" for r in rows) == 4  # NULL, empty, blank, digits
    assert {r["lang_pred"] for r in langid.languages(odd.limit(0)).collect()} == set()
    kept = langid.keep_known(odd)
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 4


def test_keep_known_without_profiles(spark, odd):
    text_of = lambda rows: sorted(str(tuple(r)) for r in rows)
    lettered = [r for r in odd.collect() if any(map(str.isalpha, r["text"] or ""))]
    bare = odd.withColumn("lang", F.lit(None).cast("string"))
    kept = langid.keep_known(bare)
    assert kept.schema == bare.schema and kept.count() == len(lettered) == len(ODD) - 4
    # All labelled rows held out.
    held = odd.where(langid.held_out(F.col("doc_id")))
    assert 0 < held.where("lang IS NOT NULL").count()
    assert text_of(langid.keep_known(held).collect()) == text_of(r for r in held.collect() if r in lettered)


def test_grams_of_blocks_add_up():
    short, long = langid.grams("ab ab"), langid.grams("ab " * 900_000)
    assert set(short[0]) == set(long[0]) and long[1].max() == 900_000


@needs_data
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    want = [(i, t) for i, t in rows if t and any(map(str.isalpha, t))]
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    last = {lower(t): i for i, t in want}
    want = [(i, t) for i, t in want if last[lower(t)] == i]
    roots = _components([_fingerprint(t) for _, t in want])
    want = [w for k, w in enumerate(want) if roots[k] == k]
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, SF)
        assert kept.columns == docs.columns, name
    kept = kept.select("*")
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == want
    mixed = corpus_pipeline.mix(spark, kept, SF)
    copies = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix(kept).collect()}
    found = [r["doc_id"] for r in mixed.select("doc_id").collect()]
    assert {i: found.count(i) for i in copies} == copies
    assert corpus_pipeline.run(spark, SF).count() == len(found)
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
