"""Licence votes, token files and the vector join against the library and brute force."""

import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow.fs as pafs
import pytest

P = pytest.importorskip("public_tokenizers")

from scholarmill.llm import egojoin, licences, tokenfiles  # noqa: E402

WORDS = P.path("word_bpe_49k.json")
FOLDER = "/root/testdata/sf0.001"


def documents():
    return [t for t, in duckdb.sql(f"SELECT text FROM '{FOLDER}/documents.parquet' ORDER BY doc_id").fetchall()]


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_base(text):
    words = words_of(text)
    places = [(i, label) for label, phrase in licences.PHRASES for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    return len(words), sorted(places)


def test_licences(spark):
    texts = [None, "", "...", "cc by", "CC-BY-NC cc by nc", "Under the MIT License. under the mit license under the mit",
             "Apache License, Version 2.0 and 2 apache license version 2", "É cc by nc É",
             "Permission is hereby granted, free of charge, to any single person obtaining a copy of this software",
             "this work is licensed under the gnu general public license version 3", "general public license"]
    texts += documents()
    texts += [texts[4]]
    frame = spark.createDataFrame([(None if i == 5 else i, t, "x", 3) for i, t in enumerate(texts)],
                                  "doc_id long, text string, words string, hash int").repartition(3)
    found = {r.doc_id: r for r in licences.digests(licences.scan(frame)).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        r = found[None if i == 5 else i]
        n, places = brute_base(text)
        starts = [p for p, _ in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(places), min(starts, default=None), max(starts, default=None)), text
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert (r.score == 1) >= bool(places)
    assert (found[8].labels, found[9].labels, found[10].labels, found[0].score) == ("mit", "gpl-3", "", 0.0)
    assert licences.scan(frame.filter("false")).count() == 0
    twice = spark.createDataFrame([(1, "cc by nc"), (1, "cc by nc")], "doc_id long, text string")
    assert [r.n_base for r in licences.digests(licences.scan(twice)).collect()] == [1, 1]


SHORT = [(label, text) for label, text in licences.NOTICES if (label, text) not in licences.BODIES]


def test_licence_notices_with_an_edit(spark):
    """Each short notice with each word changed, removed, and one inserted; the words that name the licence must stay."""
    cases = []
    for label, notice in SHORT:
        own = notice.split()
        cases.append((" ".join(own), label, True))
        for i, word in enumerate(own):
            names = word in licences.NAMES or (word in licences.VERSIONS and any(w in licences.NAMES for w in own))
            cases += [(" ".join([*own[:i], *new, *own[i + 1:]]), label, not names) for new in (["zzz"], [])]
            cases.append((" ".join([*own[:i], "zzz", *own[i:]]), label, True))
    long = SHORT[1][1]
    cases += [
        ("This program is licensed under the GNU General Public License, version 3", "gpl-3", True),
        ("this work is licensed under the gnu general public license version 3", "gpl-2", False),
        ("released under an MIT license", "mit", True), ("released under the BSD license", "mit", False),
        (long.replace("hereby granted free of", "granted hereby free of any"), "mit", True), (long[:40], "mit", False),
        ("this work is licensed under the GNU Lesser General Public License version 3", "gpl-3", False),
        ("this work is licensed under the GNU Affero General Public License version 3", "gpl-3", False),
        ("licensed under CC BY-SA 3.0", "cc-by-sa", True), ("licensed under CC BY-NC-SA 4.0", "cc-by-sa", False),
        ("licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by", False)]
    cases += [(text, label, found) for text, label, found in cases[:40]]
    rows = [(i, f"of the aaa under the {text}, bbb of the ccc" if i % 2 else text) for i, (text, _, _) in enumerate(cases)]
    found = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    wrong = [case for i, case in enumerate(cases) if (case[1] in found[i].labels) != case[2]]
    assert wrong == []
    assert found[0].score == 1


def test_whole_licences_with_edits_anywhere(spark):
    """Bodies and headers, as often edited as they may be: words changed, removed, inserted one by one and all together."""
    draw = random.Random(8)
    names = {*licences.NAMES, *licences.VERSIONS}
    rows, expected = [], []

    def add(label, words, edits, n):
        rows.append((len(rows), " ".join(["zzz"] * draw.randint(0, 300) + words + ["yyy"] * draw.randint(0, 300))))
        expected.append((label, 1 - edits / n))

    for label, text in licences.BODIES:
        own = words_of(text)
        n = len(own)
        most = n // licences.WORDS_AN_EDIT
        add(label, own, 0, n)
        free = [i for i, w in enumerate(own) if w not in names]
        changed = set(draw.sample(free, most))
        add(label, [f"q{i}" if i in changed else w for i, w in enumerate(own)], most, n)
        add(label, [w for i, w in enumerate(own) if i not in changed], most, n)
        at = draw.randint(n // 3, n // 2)
        add(label, own[:at] + [f"new{i}" for i in range(most)] + own[at:], most, n)
        add(None, [f"q{i}" if i in changed or i in free[:3 * most] else w for i, w in enumerate(own)], 0, n)
    found = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    for i, (label, least) in enumerate(expected):
        if label is not None:
            assert label in found[i].labels and found[i].score >= least - 1e-9, (i, label, found[i])
        else:
            assert found[i].score < 0.99


def brute_edits(template, words, names, others):
    """Least edits to any stretch of words, by the textbook table."""
    far = 10 ** 6
    best = far
    for begin in range(len(words) + 1):
        row = [j if not any(w in others for w in words[begin:begin + j]) else far for j in range(len(words) - begin + 1)]
        for w in template:
            new = [far if w in names else row[0] + 1]
            for j, x in enumerate(words[begin:], 1):
                change = row[j - 1] + (0 if x == w else far if w in names else 1)
                new.append(far if x in others else min(change, far if w in names else row[j] + 1, new[j - 1] + 1))
            row = new
        best = min(best, *row)
    return best if best < far else None


def brute_share(template, words, k, edits):
    votes = {}
    for i in range(len(words) - k + 1):
        for j in range(len(template) - k + 1):
            if words[i:i + k] == template[j:j + k]:
                votes[i - j] = votes.get(i - j, 0) + 1
    groups, last = [], None
    for d in sorted(votes):
        if last is None or edits is None or d - last > max(licences.GAP, edits):
            groups.append(0)
        groups[-1] += votes[d]
        last = d
    return min(0.99, max(groups, default=0) / (len(template) - k + 1))


def test_votes_and_score_equal_brute_force(spark):
    draw = random.Random(9)
    alphabet = ["mit", "bsd", "a", "b", "c", "d", "e", "2"]
    notices = [("x", "a b c d e a c b mit 2"), ("y", "a a b a c"), ("z", "b"), ("long", " ".join(draw.choices("abcdefghij", k=30))), ("none", "...")]
    phrases = [("p", "a b"), ("q", "c")]
    rows = []
    for i in range(220):
        words = draw.choices(alphabet, k=draw.randint(0, 14))
        if i % 3:
            own = draw.choice(notices)[1].split()
            for _ in range(draw.randint(0, 3)):
                at = draw.randrange(len(own))
                own[at:at + draw.randint(0, 1)] = draw.choices(alphabet, k=draw.randint(0, 1))
                own = own or ["a"]
            at = draw.randint(0, len(words))
            words[at:at] = own
        rows.append((i, " ".join(words)))
    found = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), phrases=phrases,
                                                notices=notices).collect()}
    for i, text in rows:
        words = text.split()
        labels = {label for label, phrase in phrases for at in range(len(words)) if words[at:at + len(phrase.split())] == phrase.split()}
        best, share = (1.0 if labels else 0.0), 0.0
        for label, notice in [*phrases, *notices[:4]]:
            own = notice.split()
            exact = (label, notice) in phrases
            edits = 0 if exact else len(own) // licences.WORDS_AN_EDIT
            k = 4 if len(own) >= licences.LONG else 2 if len(own) > 1 else 1
            share = max(share, brute_share(own, words, k, None if exact else edits))
            named = set(own) & set(licences.NAMES)
            names = named | (set(own) & set(licences.VERSIONS) if named else set())
            least = None if exact else brute_edits(own, words, names, set(licences.NAMES) - set(own))
            if least is not None and least <= edits:
                labels.add(label)
                best = max(best, 1 - least / len(own))
        assert found[i].labels == sorted(labels), text
        assert found[i].score == pytest.approx(best or share), text


def test_long_texts_take_time_in_proportion(spark):
    import time

    seconds = []
    for n in (40_000, 40_000, 160_000):
        text = " ".join(random.Random(n).choices(["of", "the", "software", "mit", "license", "under", "is", "a", *map(str, range(50))], k=n))
        frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time.perf_counter()
        assert licences.scan(frame).first().n_words == n
        seconds.append(time.perf_counter() - start)
    assert seconds[2] < 6 * seconds[1]


ODD_PARTS = ["a", "aa", "The", " ", "  ", "\n", "\x1c", "\x85", "\xa0", "é", "É", "́", "Σ", "ΟΔΟΣ", "中", "😀", "'s", "don't",
             "word.", "Word,", "x!", "1", "²", " ", "--", "<|endoftext|>", "<|startoftext|>", "\x00", "İ", "ſ", "ﬁ"]


def test_token_files(spark):
    from tokenizers import Tokenizer

    draw = random.Random(4)
    texts = ["".join(draw.choice(ODD_PARTS) for _ in range(draw.randint(0, 40))) for _ in range(400)]
    texts = [None, "", " \n", *texts, "ab" * 2000, *documents()]
    keys = [3 * i for i in range(len(texts))]
    draw.shuffle(keys)
    rows = [*zip(keys, texts), (6, texts[6]), (None, "no id")]
    frame = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, ids string, part int").repartition(4)
    tokenizer = Tokenizer.from_file(WORDS)
    manifest = tokenfiles.write(frame, WORDS, end_id=1)
    found = sorted(tokenfiles.digests(tokenfiles.read(manifest)).collect(), key=lambda r: r.start)
    start = 0
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert len(found) == len(ordered)
    for r, (key, text) in zip(found, ordered):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        assert (r.doc_id, r.start, r.n_tokens) == (key, start, len(ids)), repr(text)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += len(ids)
    for r in manifest.collect():
        store, place = pafs.FileSystem.from_uri(r.folder)
        assert store.get_file_info(f"{place}/{r['name']}.bin").size == 2 * r.n_tokens and r.width == 2
        assert store.get_file_info(f"{place}/{r['name']}.idx").size == 8 * (r.n_docs + 1)
    wide = tokenfiles.write(frame.limit(5), WORDS, end_id=70_000)
    assert [r.ids[-4:] for r in tokenfiles.read(wide).collect()] == [np.array([70_000], dtype="<u4").tobytes()] * 5
    assert tokenfiles.read(tokenfiles.write(frame.filter("false"), WORDS, end_id=1)).count() == 0


def test_tokenizers_that_do_not_split_at_white_space_see_whole_texts(spark):
    from tokenizers import Tokenizer

    other = P.path("byte_bpe_50k.json")
    assert tokenfiles.splits_at_white_space(WORDS) and not tokenfiles.splits_at_white_space(other)
    texts = ["", "two  words\nand a line", *documents()[:20]]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.ids for r in tokenfiles.read(tokenfiles.write(frame, other, end_id=50_256)).collect()}
    library = Tokenizer.from_file(other)
    for i, text in enumerate(texts):
        assert found[i] == np.array([*library.encode(text, add_special_tokens=False).ids, 50_256], dtype="<u4").tobytes()


def brute_vectors(rows, least):
    links = {r[0]: set() for r in rows}
    usable = [(k, label, np.array(v, dtype=np.float64)) for k, v, label in rows
              if k is not None and label is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    for i, (k, label, v) in enumerate(usable):
        for m, other, w in usable[i + 1:]:
            if k != m and label == other and len(v) == len(w) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= least:
                links[k].add(m)
                links[m].add(k)
    component = {}
    for k in sorted((k for k in links if k is not None)):
        todo = [k] if k not in component else []
        while todo:
            x = todo.pop()
            if x not in component:
                component[x] = k
                todo += links[x]
    return {k: (len(links[k]), component.get(k), k is not None and component.get(k) == k) for k in links}


def clouds(n, dim, seed):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, dim))
    rows = []
    for i in range(n):
        v = centres[i % 6] + draw.normal(size=dim) * draw.choice([0.0, 0.05, 0.12, 0.3])
        rows.append((1000 - i, [float(x) for x in v.astype(np.float32)], int(draw.integers(0, 3)) if i % 11 else None))
    return rows


@pytest.mark.parametrize("block,leaf", [(egojoin.BLOCK_ROWS, egojoin.LEAF_ROWS), (20, 4)])
def test_vectors(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(egojoin, "BLOCK_ROWS", block)
    monkeypatch.setattr(egojoin, "LEAF_ROWS", leaf)
    rows = clouds(400, 16, 3) + [(1, None, 1), (2, [0.0] * 16, 1), (3, [float("nan")] * 16, 1), (4, [float("inf")] + [1.0] * 15, 1),
                                 (5, [None] + [1.0] * 15, 1), (6, [], 1), (7, [1.0, 0.0], 1), (8, [3.0, 0.0], 1), (9, [1e30, 0.0], 1),
                                 (None, [1.0, 0.0], 1), (11, [1.0], 1), (12, [1.0], 1)]
    rows += [(2000 + i, rows[0][1], rows[1][2]) for i in range(40)] + [(13, rows[5][1], rows[5][2])]
    schema = "vec_id long, embedding array<float>, label int"
    frame = spark.createDataFrame(rows, schema).selectExpr("*", "1 AS rep", "'x' AS copies").repartition(5)
    found = egojoin.near_copies(frame.union(frame.limit(3))).collect()
    assert {r.vec_id: tuple(r)[1:] for r in found} == brute_vectors(rows, egojoin.LEAST_COSINE)
    assert len(found) == len(rows)
    assert egojoin.near_copies(frame.filter("false")).count() == 0
