"""The ten operators against brute force, and on nulls, empty and long texts, repeated rows and empty tables."""

import hashlib
import math
import itertools
import random
import re

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

import public_tokenizers
from gristmill.llm import codec, exact, fingerprints, language, licences, near, packing, sharding, suffix, toxicity

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _doc int, _text string, _id int, _n int, shard string, kept string"
LONG = " ".join(f"word{i % 977} other{i % 31}" for i in range(15_000))
TEXTS = [
    (1, "one two three four five six seven"), (2, None), (3, ""), (4, " \n\t "), (5, "one two three four five six seven"), (6, LONG),
    (7, LONG), (None, "no id but a text"), (8, "Äpfel und Öl, ßtraße"), (9, "one"), (9, "one"), (10, "one two three four five six seven eight"),
    (11, "1234 !!"), (12, "\U0001f600 emoji \U0001f600"), (13, "x" * 500), (14, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en" if i and i % 2 else None, None, None, 1, "t", 2, 3, "s", "k") for i, t in TEXTS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def table(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")


def test_helper_names_in_the_documents(spark):
    """Rows that repeat an id or a text, with columns called like those that operators add."""
    extra = ["__kept_id__", "__KEPT_sha__", "__text__", "__kept_row__", "__row__", "__cut_row__", "__kept_text__", "__null__"]
    long = "some words that are long enough to be cut out of the second text " * 4
    rows = [(1, "a b c", 3), (1, "a b c", 2), (2, long, 1), (None, None, 4), (3, long, 5)]
    frame = spark.createDataFrame(
        [(i, t, len(t or ""), *[n] * len(extra)) for i, t, n in rows], "doc_id int, text string, n_chars int, " + ", ".join(f"{c} int" for c in extra)
    )
    got = {drop: drop(frame) for drop in (exact.drop_exact_copies, near.drop_near_copies, suffix.drop_repeats)}
    assert all(g.columns == frame.columns for g in got.values())
    assert sorted(r["__row__"] for r in got[exact.drop_exact_copies].collect()) == [1, 2, 4]
    assert sorted(r["__null__"] for r in got[near.drop_near_copies].collect())[0] == 1
    cut = {r["__kept_text__"]: r.text for r in got[suffix.drop_repeats].collect()}
    assert cut[1] is not None and len(cut[1]) < len(long) and cut[5] == "" and cut[4] is None and cut[3] == cut[2] == "a b c"


# ------------------------------------------------------------------ exact dedup


@pytest.mark.parametrize("keep", ["min", "max"])
def test_exact_copies(docs, keep):
    got = sorted((r.doc_id or -1, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact.exact_copies(docs, keep=keep).collect())
    want = []
    for i, t in TEXTS:
        same = [j for j, u in TEXTS if (u or "") == (t or "")]
        best = (min if keep == "min" else max)((j for j in same if j is not None), default=None)
        want.append((i or -1, best, len(same), i == best, hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=lambda r: (r[0], str(r)))


def test_exact_stage_keeps_one_of_each(docs, none):
    left = exact.drop_exact_copies(docs)
    assert left.columns == docs.columns
    assert sorted((r.text or "") for r in left.collect()) == sorted({t or "" for _, t in TEXTS})
    assert exact.drop_exact_copies(none).count() == 0 and exact.exact_copies(none).count() == 0


# ------------------------------------------------------------------ suffix dedup


def covered(rows, length):
    """(removed bytes, runs) of each text, windows compared one by one."""
    seen, out = set(), []
    for _, text in rows:
        raw = (text or "").encode()
        mask = np.zeros(len(raw), bool)
        for s in range(len(raw) - length + 1):
            window = raw[s : s + length]
            if window in seen:
                mask[s : s + length] = True
            seen.add(window)
        edge = np.diff(np.r_[0, mask.astype(int), 0])
        out.append((int(mask.sum()), int((edge == 1).sum()), hashlib.sha256(bytes(np.frombuffer(raw, np.uint8)[~mask])).hexdigest()))
    return out


def repetitive(seed, n=60):
    draw = random.Random(seed)
    phrases = ["".join(draw.choice("abcdeé ") for _ in range(draw.randint(5, 60))) for _ in range(12)]
    return ["".join(draw.choice(phrases) for _ in range(draw.randint(0, 12))) for _ in range(n)] + ["ab" * 100, "ab" * 150, "c" * 90, "c" * 120]


@pytest.mark.parametrize("hot, length", [(False, 30), (True, 45)])
def test_cut_repeats(spark, monkeypatch, hot, length):
    if hot:
        monkeypatch.setattr(suffix, "HOT_PIECES", 2)
    monkeypatch.setattr(suffix, "SEGMENT", 64)
    monkeypatch.setattr(suffix, "CHUNK_PIECES", 50)
    suffix._powers.cache_clear()
    texts = repetitive(length)
    got = suffix.cut_repeats(table(spark, texts), length=length).orderBy("doc_id").collect()
    assert [(r.n_removed, r.n_spans, r.kept_sha256) for r in got] == covered(list(enumerate(texts)), length)
    assert all(r.n_bytes == len(t.encode()) for r, t in zip(got, texts))


def test_cut_repeats_on_odd_rows(docs, none):
    got = suffix.cut_repeats(docs).collect()
    order = sorted(range(len(TEXTS)), key=lambda k: (TEXTS[k][0] is not None, TEXTS[k][0] or 0, TEXTS[k][1] or ""))
    want = covered([TEXTS[k] for k in order], 100)
    assert sorted((r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(want)
    assert suffix.cut_repeats(none).count() == 0


def test_repeats_stage_leaves_whole_characters(spark, docs):
    tail = "".join(chr(0xE0 + (i * i + i // 7) % 31) for i in range(80))
    rows = table(spark, ["a" + tail, "b" + tail, "clean text"]).withColumn("n_chars", F.lit(81).cast("bigint"))
    left = {r.doc_id: (r.text, r.n_chars) for r in suffix.drop_repeats(rows).collect()}
    assert left == {0: ("a" + tail, 81), 1: ("b", 1), 2: ("clean text", 10)}
    staged = suffix.drop_repeats(docs)
    assert staged.columns == docs.columns and staged.count() == len(TEXTS)
    assert [r.text for r in staged.filter("doc_id in (2, 14)").collect()] == [None, None]


# ------------------------------------------------------------------ license scan

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def scan_by_hand(text):
    words = WORDS.findall(ascii_lower(text))
    places = [(k, label) for phrase, label in licences.PHRASES.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
    norm = f" {' '.join(words)} "
    found = []
    if any(g in norm for g in licences.GATES):
        for priority, label, keyword, pattern, _ in licences.rules():
            if keyword in norm:
                for m in re.finditer(pattern, norm):
                    start = norm[: m.start()].count(" ") - 1
                    found.append((start, -(start + m[0].count(" ") + 1), priority, label))
    kept = []
    for d in sorted(found):
        if not kept or d[0] >= -kept[-1][1]:
            kept.append(d)
        elif -d[1] > -kept[-1][1] and d[2] < kept[-1][2]:
            kept[-1] = d
    labels = {label for _, label in places}
    return (
        len(words), len(places), min(places)[0] if places else None, max(places)[0] if places else None,
        ",".join(sorted(labels)), ",".join(sorted(labels | {d[3] for d in kept})),
    )


LICENSED = [
    "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3. MIT License mit license", "SPDX-License-Identifier: BSD-3-Clause",
    "GNU Lesser General Public License v2.1 or the Mozilla Public Licence 2.0", "mit der Lizenz", "CC0 1.0 Universal, public domain",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software; without warranty of any kind",
    "Creative Commons Attribution-NonCommercial 4.0 International License", "\x00MIT\x00LICENSE\x7f", "Émit license mit licenseé",
]


def test_licence_scan(spark, docs, none):
    assert len(licences.rules()) > 300
    for rows, texts in ((table(spark, LICENSED), LICENSED), (docs, [t for _, t in TEXTS])):
        got = licences.scan(rows).select("n_words", "n_base", "first_word", "last_word", "base_labels", "labels").collect()
        assert sorted(map(str, map(tuple, got))) == sorted(str(scan_by_hand(t or "")) for t in texts)
    scores = [r.score for r in licences.scan(table(spark, LICENSED)).collect()]
    assert all(0 <= s <= 1 for s in scores) and licences.scan(none).count() == 0


def test_licence_base_phrases_are_those_of_the_contract(spark):
    texts = [
        "MIT License. Released under the MIT license, under-the-mit-license", "see the MIT license", "under the MIT", None,
        "Apache License, Version 2.0 and CC BY-NC 4.0 under the MIT license", "under the mit licenses", "under the é mit license",
    ]
    got = licences.scan(table(spark, texts)).orderBy("doc_id").select("n_words", "n_base", "first_word", "last_word", "base_labels")
    assert list(map(tuple, got.collect())) == [
        (11, 2, 3, 7, "mit"), (4, 0, None, None, ""), (3, 0, None, None, ""), (0, 0, None, None, ""),
        (15, 3, 0, 11, "apache-2,cc-by-nc,mit"), (4, 0, None, None, ""), (5, 0, None, None, ""),
    ]
    assert [r.labels for r in licences.scan(table(spark, texts[1:2])).collect()] == ["mit"]


def spelled(pattern):
    """Strings that a rule's pattern matches: every alternative and every optional part with and without."""
    parser = re._parser
    code = {"IN": lambda v: [chr(x[1][0] if str(x[0]) == "RANGE" else x[1]) for x in v], "LITERAL": lambda v: [chr(v)]}

    def go(items):
        out = [""]
        for op, v in items:
            name = str(op)
            if name in ("ASSERT", "AT"):
                continue
            if name in code:
                found = code[name](v)
            elif name == "SUBPATTERN":
                found = go(v[3])
            elif name == "BRANCH":
                found = [s for b in v[1] for s in go(b)]
            else:
                assert name == "MAX_REPEAT"
                once = go(v[2])
                found = ([""] if v[0] == 0 else []) + once + ([a + b for a in once for b in once] if str(v[1]) == "MAXREPEAT" else [])
            out = [a + b for a in out for b in found]
        return out

    return go(parser.parse(pattern))


def test_licence_keywords_are_in_every_match():
    for priority, label, keyword, pattern, _ in licences.rules():
        for form in spelled(pattern):
            norm = f" {form} "
            if re.search(pattern, norm):
                assert keyword in norm and any(g in norm for g in licences.GATES), (priority, label, keyword, norm)


SHORT_NAMED = {
    "Licensed under EPL-2.0": "epl-2", "Licensed under BSL-1.0": "bsl-1", "released under the OFL 1.1": "ofl-1.1", "available under SSPL-1.0": "sspl-1",
    "Licensed under MS-PL.": "ms-pl", "licensed under MS-RL": "ms-rl", "Licensed under CDDL-1.1": "cddl-1.1", "provided under CPL-1.0": "cpl-1",
    "licensed under EUPL-1.2": "eupl-1.2", "distributed under the GFDL-1.3": "gfdl-1.3", "licensed under ODbL-1.0": "odbl-1",
    "licensed under ODC-By-1.0": "odc-by-1", "licensed under PDDL-1.0": "pddl-1", "licensed under BUSL-1.1": "busl-1.1", "licensed under PSF-2.0": "python-2",
    "Do What The Fuck You Want To Public License": "wtfpl", "WTFPL": "wtfpl", "Zero-Clause BSD License": "0bsd", "0BSD license": "0bsd",
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS": "apache-2",
    "free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License": "lgpl",
    "Llama 3.1 Community Licence": "llama", "Llama 2 Community License": "llama",
}


def test_licence_scan_without_keywords(spark, monkeypatch):
    texts = [*SHORT_NAMED, *LICENSED, *(f"see {a}, or {b}" for a, b in zip(SHORT_NAMED, LICENSED))]
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) for r in licences.scan(table(spark, texts)).collect()}
    assert [got[i][5] for i in range(len(SHORT_NAMED))] == list(SHORT_NAMED.values())
    every = [(p, label, "", pattern, s) for p, label, _, pattern, s in licences.rules()]
    monkeypatch.setattr(licences, "rules", lambda: every)
    monkeypatch.setattr(licences, "GATES", [""])
    assert [got[i] for i in range(len(texts))] == [scan_by_hand(t) for t in texts]


# ------------------------------------------------------------------ fingerprints


def shingles(text, width=5):
    words = [w for w in re.split(r"[ \t\n\x0b\f\r]+", text) if w]
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set())


def jaccard(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def test_edited_fingerprints(docs, none):
    got = fingerprints.edited_fingerprints(docs).collect()
    order = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    texts = [t or "" for _, t in order]
    want = []
    for t, after in zip(texts, texts[1:] + texts[:1]):
        half = len(t) // 2
        want.append((len(t), hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()))
    assert sorted((r.n_chars, r.edited_sha256) for r in got) == sorted(want)
    assert len({r.fingerprint for r in got if r.n_chars == len(LONG)}) == 1
    assert fingerprints.edited_fingerprints(none).count() == 0


def test_sketch_estimates(spark):
    draw = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    a = [" ".join(draw.choices(words, k=draw.choice([3, 60, 1500]))) for _ in range(20)]
    b = [x if i % 4 == 0 else x[: len(x) // 2] + " ".join(draw.choices(words, k=200)) for i, x in enumerate(a)]
    rows = spark.createDataFrame(list(zip(range(20), a, b)), "i int, a string, b string").select("i", fingerprints.sketch(F.col("a")).alias("a"), fingerprints.sketch(F.col("b")).alias("b"))
    near_, inside, count = zip(*(
        (r.j, r.c, r.n) for r in rows.select(
            "i", fingerprints.resemblance(F.col("a"), F.col("b")).alias("j"), fingerprints.containment(F.col("a"), F.col("b")).alias("c"),
            fingerprints.distinct_shingles(F.col("a")).alias("n"),
        ).orderBy("i").collect()
    ))
    for i in range(20):
        sa, sb = shingles(a[i]), shingles(b[i])
        assert abs(near_[i] - jaccard(sa, sb)) < 0.2
        if jaccard(sa, sb) > 0.2:
            assert abs(inside[i] - len(sa & sb) / len(sa)) < 0.35
        assert abs(count[i] / len(sa) - 1) < 0.35
    whole = fingerprints.merged_over(rows.select(F.lit(1).alias("k"), F.col("a").alias("sketch")), ["k"]).first().sketch
    assert whole == sorted(set(itertools.chain.from_iterable(r.a for r in rows.collect())))[: fingerprints.SIZE]


# ------------------------------------------------------------------ byte-level BPE


def test_codec(spark, docs, none):
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    enc = codec.encoding(path, pattern)
    got = codec.round_trip(docs, path, pattern).collect()
    for r, (_, t) in zip(got, TEXTS):
        ids = enc.encode_ordinary(t or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    tokens = codec.encode(docs, path, pattern)
    assert [bytes(r.bytes).decode() for r in codec.decode(tokens, path, pattern).collect()] == [t or "" for _, t in TEXTS]
    assert codec.round_trip(none, path, pattern).count() == 0


def test_parts_encode_as_the_whole():
    enc = codec.encoding(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    draw = random.Random(5)
    for _ in range(200):
        text = "".join(draw.choice(["ab", " ", "  ", "\n", "1", "!", "'s", "é", ".", "\x1c", " ", "don't"]) for _ in range(300))
        cut = list(codec.parts(text, 20))
        assert "".join(cut) == text and len(cut) > 1
        assert [i for p in cut for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)
    assert isinstance(enc, tiktoken.Encoding)


# ------------------------------------------------------------------ language


def test_language(spark, docs, none):
    english, german = "the of and is that with for on this", "der die und ist das mit auf den nicht"
    draw = random.Random(1)
    rows = [(i, " ".join(draw.choices((english if i % 2 else german).split(), k=30)), "en" if i % 2 else "de") for i in range(200)]
    frame = spark.createDataFrame(rows + [(500, None, "en"), (501, "123 ...", "de"), (502, "the and", None)], "doc_id bigint, text string, lang string")
    got = {r.doc_id: r for r in language.held_out_languages(frame).collect()}
    held = [r for r in got.values() if r.held_out and r.doc_id < 200]
    assert len(held) > 20 and all(r.lang_pred == ("en" if r.doc_id % 2 else "de") and 0 <= r.score <= 1 for r in held)
    assert got[500].lang_pred == got[501].lang_pred == "und" and got[502].lang_pred == "en"
    assert language.held_out_languages(docs).count() == len(TEXTS) and language.held_out_languages(none).count() == 0


def test_numbers_that_look_like_letters_are_no_language():
    model = language.Model(["en"], np.ones(language.CELLS), np.zeros((language.CELLS, 1)), np.zeros(1), 1.0)
    assert [model.predict(t)[0] for t in ("\u00bd", "\u00b2 3", "\u2167", "", None, "_1", "1a", "\u00e9")] == ["und"] * 6 + ["en"] * 2


def test_rare_languages_are_learnt(spark):
    draw = random.Random(2)
    of = lambda words: " ".join(draw.choices(words.split(), k=25))
    rows = [(i, of("the and of to house water day night"), "en") for i in range(9_000)]
    rows += [(20_000 + i, of("szybko zawsze dzień noc woda dom żółty już"), "pl") for i in range(12)]
    learning = spark.createDataFrame(rows, "_id bigint, _text string, _lang string")
    model = language.fit(learning, sample=60)
    assert model.languages == ["en", "pl"]
    assert model.predict(of("noc woda dom żółty szybko"))[0] == "pl" and model.predict(of("the house night day"))[0] == "en"


def test_temperature_and_sparsity():
    draw = np.random.default_rng(0)
    logits = draw.normal(size=(4000, 3))
    labels = np.array([draw.choice(3, p=np.exp(x) / np.exp(x).sum()) for x in logits])
    assert abs(language.fit_temperature(4 * logits, labels) - 4) < 0.5
    rows = [(np.array([i % 2, 5 + i % 7]), np.array([1.0, 0.1])) for i in range(300)]
    w, _ = language.fit_ftrl(rows, np.arange(300) % 2, 2)
    assert w[0, 0] > 0 > w[1, 0] and (w[100:] == 0).all()


# ------------------------------------------------------------------ packing


def bins_needed(items, capacity):
    """Fewest bins, by trying everything."""
    best = len(items)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(items):
            best = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= items[i]}.values():
            go(i + 1, rooms[:k] + [rooms[k] - items[i]] + rooms[k + 1 :])
        go(i + 1, rooms + [capacity - items[i]])

    go(0, [])
    return best


def test_dominance_never_costs_a_bin():
    draw = random.Random(9)
    for _ in range(150):
        items = sorted((draw.randint(1, 20) for _ in range(draw.randint(1, 9))), reverse=True)
        counts = {s: items.count(s) for s in items}
        fixed, rest = packing.reduce_by_dominance(dict(counts), 20)
        left = sorted((s for s, n in rest.items() for _ in range(n)), reverse=True)
        used = sorted([s for sizes, n in fixed for s in sizes * n] + left, reverse=True)
        assert used == items and all(sum(sizes) <= 20 for sizes, _ in fixed)
        assert sum(n for _, n in fixed) + bins_needed(left, 20) == bins_needed(items, 20), items


def test_plan_places_every_piece_once():
    draw = random.Random(4)
    for _ in range(20):
        counts = {draw.randint(1, 64): draw.randint(1, 400) for _ in range(30)}
        cells = {}
        for size, rank, n, sequence, offset in packing.plan(counts, 64):
            for i in range(n):
                cells.setdefault(sequence + i, []).append((offset, size))
        assert sum(map(len, cells.values())) == sum(counts.values())
        for placed in cells.values():
            placed.sort()
            assert [o for o, _ in placed] == [0, *itertools.accumulate(s for _, s in placed)][:-1] and sum(s for _, s in placed) <= 64


def test_pack(docs, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    pieces = packing.token_pieces(docs, path)
    lengths = sorted(r["sum(length)"] for r in pieces.filter("doc_id IS NOT NULL AND doc_id <> 9").groupBy("doc_id").sum("length").collect())
    assert lengths == sorted(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in TEXTS if i not in (9, None))
    packed = packing.pack(pieces).collect()
    assert len(packed) == pieces.count() and packing.pack(packing.token_pieces(none, path)).count() == 0
    for _, rows in itertools.groupby(sorted(packed, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        rows = list(rows)
        assert [r.offset for r in rows] == [0, *itertools.accumulate(r.length for r in rows)][:-1] and sum(r.length for r in rows) <= 2048


def test_chunks_encode_as_the_whole():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = packing.ChunkEncoder(path)
    texts = ["Don't STOP, it's 12.5% \t of\n\nThe é Ünïcode…", "a\x01b \x01", "x y", "<|endoftext|> <|EndOfText|>", "İstanbul é", "日本語 text", "", None]
    for text, raw in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(raw, "<u4").tolist() == encoder.tokenizer.encode(text or "", add_special_tokens=False).ids


# ------------------------------------------------------------------ sharding


def test_shards(spark, docs, none):
    draw = random.Random(2)
    rows = [(i, "x" * draw.choice([0, 5, 40, 300]) if i % 3 else "the same text", draw.choice(["en", "de", None])) for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = sharding.shard_documents(frame).collect()
    sizes, slots = {}, {}
    for r in got:
        sizes[r.shard] = sizes.get(r.shard, 0) + r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(got) == 3000 and sorted(sizes) == list(range(24))
    assert max(sizes.values()) - min(sizes.values()) < 0.1 * sum(sizes.values()) / 24 + 2 * 308
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    odd = sharding.shard_documents(docs).collect()
    assert len(odd) == len(TEXTS) and all(0 <= r.shard < 24 and r.law == "bytes" and r.grown_shard is None for r in odd)
    assert sharding.shard_documents(none).count() == 0


# ------------------------------------------------------------------ toxicity


def test_gradients():
    texts = [b"some fine words here", b"you scum and trash", b"plain", b"one two three four five six seven eight nine ten " * 6]
    model = toxicity.Model()
    raw, start, end, count = toxicity.words_of(texts)
    inputs = toxicity.word_inputs(raw, start, end)
    first, lengths, _ = toxicity.windows_of(count)
    index = toxicity._window_index(first, lengths, inputs[0])
    for k in model.p:
        model.p[k] = model.p[k].astype(np.float64)
    vectors = model.embed(inputs)
    grad = np.linspace(-1, 1, len(first))
    _, cache = model.forward(vectors, index, lengths, keep=True)
    grads, _ = model.backward(grad, vectors, index, cache)
    for name, g in grads.items():
        flat = model.p[name].reshape(-1)
        for at in np.random.default_rng(1).integers(0, flat.size, 4):
            old, out = flat[at], []
            for step in (1e-3, -1e-3):
                flat[at] = old + step
                out.append(float(grad @ model.forward(vectors, index, lengths)[0]))
            flat[at] = old
            assert abs((out[0] - out[1]) / 2e-3 - np.asarray(g).reshape(-1)[at]) < 2e-3 * max(1, abs(out[0])), (name, at)


def test_toxicity(spark, docs, none, monkeypatch):
    draw = random.Random(6)
    clean = [f"w{i}" for i in range(200)]
    rows, marks = [], []
    for i in range(300):
        words = draw.choices(clean, k=draw.choice([5, 50, 200]))
        if i % 3 == 0:
            words[draw.randrange(len(words))] = draw.choice(["scumbag", "scumball", "scummy"])
        rows.append((i, " ".join(words)))
        marks.append((i, int(i % 3 == 0)))
    frame = spark.createDataFrame(rows + [(900, None), (901, ""), (902, "a new scumbags " + "w1 " * 100)], "doc_id bigint, text string")
    labels = spark.createDataFrame(marks + [(None, 1), (5, None)], "doc_id bigint, toxic int")
    got = {r.doc_id: r for r in toxicity.held_out_scores(frame, labels).collect()}
    held = [r for r in got.values() if r.held_out and r.doc_id < 300]
    assert len(held) > 30 and np.mean([r.predicted == (r.doc_id % 3 == 0) for r in held]) > 0.95
    assert got[900].score == got[901].score < 0.5 and got[902].predicted == 1
    left = {r.doc_id for r in toxicity.drop_toxic(frame, labels).collect()}
    assert left == {i for i, r in got.items() if r.score < 0.5}
    assert toxicity.held_out_scores(docs, labels.limit(0)).count() == len(TEXTS) and toxicity.drop_toxic(none, labels).count() == 0


def one_by_one(model, text):
    """Score of a text, its windows cut and run through the network one at a time."""
    words = []
    for run in re.findall(rb"[0-9A-Za-z\x80-\xff]+", text):
        words += [run[a : a + toxicity.LONGEST] for a in range(0, len(run), toxicity.LONGEST)]
    starts = [0]
    while starts[-1] + toxicity.WINDOW < len(words):
        starts.append(min(starts[-1] + toxicity.STRIDE, len(words) - toxicity.WINDOW))
    logits = []
    for at in starts:
        raw, start, end, count = toxicity.words_of([b" ".join(words[at : at + toxicity.WINDOW])])
        inputs = toxicity.word_inputs(raw, start, end)
        vectors = model.embed(inputs) if len(start) else np.zeros((1, toxicity.DIM), np.float32)
        index = inputs[0][:, None] if len(start) else np.zeros((1, 1), np.int64)
        logits.append(float(model.forward(vectors, index, count)[0][0]))
    weight = np.exp(toxicity.SHARPNESS * (np.array(logits) - max(logits)))
    return 1 / (1 + np.exp(-(weight @ logits / weight.sum() + model.shift)))


def test_every_window_is_scored_whatever_the_parts(monkeypatch):
    model, draw = toxicity.Model(3), random.Random(4)
    texts = [b"", b" ,. ", b"x" * 3_000, b"word " * 40, b"word " * 41, b" " * 2_000, "äöü".encode() * 400]
    texts += [" ".join("".join(draw.choices("abcXYZ09", k=draw.randint(1, 90))) for _ in range(n)).encode() for n in (5, 69, 70, 71, 400)]
    expected = [one_by_one(model, t) for t in texts]
    for part in (toxicity.PART, 4_000, 700, 100):
        monkeypatch.setattr(toxicity, "PART", part)
        assert np.abs(toxicity.score_texts(model, texts) - expected).max() < 1e-5, part


def test_pooling_knows_no_length():
    value = lambda logits: toxicity._pooled(np.array(logits), np.zeros(len(logits), np.int64), 1, 2.0)[0][0]
    assert value([1.5] * 400) == pytest.approx(1.5) and value([4.0] + [-4.0] * 1_000) > 3.9
    logits, text = np.array([0.5, -1.0, 2.0, 0.1]), np.array([0, 0, 0, 1])
    pooled, weight = toxicity._pooled(logits, text, 2, 1.7)
    share = np.exp(1.7 * logits[:3]) / np.exp(1.7 * logits[:3]).sum()
    assert weight == pytest.approx([*share, 1]) and pooled == pytest.approx([share @ logits[:3], 0.1])


def test_long_texts_toxic_and_clean():
    draw = random.Random(8)
    clean = lambda n: draw.choices([f"w{i}" for i in range(300)], k=n)
    bad = lambda: draw.choice(["scumbag", "scumball", "scummy"])
    texts, marks = [], []
    for i in range(240):
        words = clean(draw.choice([5, 50, 300, 900]))
        if i % 2:
            words[draw.randrange(len(words))] = bad()
        texts.append(" ".join(words).encode())
        marks.append(i % 2)
    model = toxicity.train(texts, np.array(marks), 0.2, steps=200)
    long = clean(20_000)
    score = toxicity.score_texts(model, [" ".join(long).encode(), " ".join([*long[:9_000], bad(), *long[9_000:]]).encode()])
    assert score[0] < 0.5 < score[1], score


# ------------------------------------------------------------------ near-dedup


def linked(rows, width, percent):
    """(shingles, component) of each row in the order given, all pairs compared."""
    sets = []
    for _, t in rows:
        words = [w for w in re.split("[\x20\x09-\x0d]+", ascii_lower(t or "")) if w]
        sets.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set()))
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            a, b = sorted((top(i), top(j)))
            root[b] = a
    return [(len(s), top(i)) for i, s in enumerate(sets)]


def edited_copies(seed):
    draw = random.Random(seed)
    words = [f"v{i}" for i in range(300)]
    out = []
    for _ in range(12):
        base = draw.choices(words, k=draw.choice([2, 30, 120]))
        for _ in range(draw.choice([1, 4, 25])):
            copy = list(base)
            for _ in range(draw.choice([0, 1, 1, 2, 4])):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            out.append(" ".join(copy))
    draw.shuffle(out)
    return out


@pytest.mark.parametrize("percent", [50, 80, 85, 95])
def test_signatures_miss_less_than_trees(percent):
    found = near._promising.__code__.co_names, near._confirmed.__code__.co_names
    assert all("least_alike" in names for names in found)
    least = near.least_alike(percent)
    trees = (1 - percent / 100) ** (near.TREES * near.BRANCHES)
    tail = lambda k: sum(math.comb(128, i) * (percent / 100) ** i * (1 - percent / 100) ** (128 - i) for i in range(k))
    assert tail(least) <= trees / 2 < tail(least + 1)


@pytest.mark.parametrize("block, large, width, percent", [(1024, 4096, 3, 85), (4, 8, 5, 80)])
def test_near_copies(spark, monkeypatch, block, large, width, percent):
    monkeypatch.setattr(near, "BLOCK", block)
    monkeypatch.setattr(near, "LARGE", large)
    monkeypatch.setattr(near, "MANY", 3)
    texts = edited_copies(width)
    got = near.near_copies(table(spark, texts), width=width, percent=percent).orderBy("doc_id").collect()
    want = linked(list(enumerate(texts)), width, percent)
    assert [(r.n_shingles, r.component_id) for r in got] == want and all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_copies_on_odd_rows(docs, none):
    order = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = [(n, order[top][0], top == i) for i, (n, top) in enumerate(linked(order, 5, 80))]
    got = [(r.n_shingles, r.component_id, r.kept) for r in near.near_copies(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    staged = near.drop_near_copies(docs)
    assert staged.columns == docs.columns and staged.count() == sum(k for _, _, k in want)
    assert near.near_copies(none).count() == 0 and near.drop_near_copies(none).count() == 0


def test_components_of_a_chain(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 105), (105, 103), (7, 7)]
    got = {r._doc: r._label for r in near.components(spark.createDataFrame(chain, "_u bigint, _v bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 105: 100, 103: 100}


def test_workers_forget_earlier_steps(monkeypatch):
    from gristmill.llm import common

    monkeypatch.setattr(common, "_worker", {"step": None, "kept": []})
    freed = []
    common.make_room("a", lambda: freed.append("a"))
    common.make_room("a", lambda: freed.append("never"))
    assert not freed
    common.make_room("b")
    common.make_room("a")
    assert freed == ["a"]
