"""Licence places against a scan of every word position."""

import random
import re

from churnmart.llm import licenses as lic

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
CRAFTED = [
    "", "...", "CC BY", "cc-by cc by-CC BY 4.0", "All rights  reserved all Rights RESERVED all rights", "GNU General Public License",
    "cc by by cc cc by", "Licensed under CC BY-NC 4.0.", "Licensed under the Apache License, Version 2.0.", "all all rights reserved rights reserved",
    "Released under the MIT License", "released unter the mit license", "İ cc by", "é cc by é", "general public general public license",
]


def slow(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    hits = [(i, label) for phrase, label in PHRASES.items() for p in [phrase.split()] for i in range(len(words)) if words[i : i + len(p)] == p]
    places = [i for i, _ in hits]
    return len(words), len(hits), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in hits}))


def check(got, texts):
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == slow(texts[r.doc_id]), texts[r.doc_id]
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert len(got) == len(texts)


def test_crafted_texts(spark):
    df = spark.createDataFrame(list(enumerate(CRAFTED)), "doc_id long, text string")
    got = lic.scan(df).collect()
    check(got, dict(enumerate(CRAFTED)))
    labels = {r.doc_id: r.labels for r in got}
    assert labels[7] == "cc-by,cc-by-nc-4.0" and labels[8] == "apache-2.0" and labels[10] == labels[11] == "mit"


def test_given_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = lic.scan(docs).collect()
    assert sum(r.n_base for r in got) > 0
    check(got, texts)


def test_idf_counts_all_texts(spark):
    df = spark.createDataFrame([(1, "mit mit"), (2, "MIT license"), (3, None)], "doc_id long, text string")
    idf = lic.idf_of(df)
    assert idf[b"mit"] < idf[b"license"] < idf[b"apache"]


def test_odd_rows(spark):
    df = spark.createDataFrame(
        [(None, "cc by", 1), (1, None, 1), (2, "cc by", 1), (2, "cc by", 1), (3, "cc by " * 40_000, 1)], "doc_id long, text string, score int"
    )
    got = lic.scan(df).collect()
    assert sorted(r.n_base for r in got) == [0, 1, 1, 1, 40_000]
    assert lic.scan(df.limit(0)).count() == 0


def test_key_phrases_are_found_whatever_the_frequencies():
    texts = {
        "licensed under GNU General Public License version 3": "gpl-3.0",
        "Apache License, Version 2.0": "apache-2.0",
        "x Mozilla Public License y": "mpl-2.0",
        "MIT license": "mit",
        "CC BY-SA 4.0": "cc-by-sa-4.0",
    }
    words = sorted({w for t in lic.TEMPLATES for w in t.places})
    for order in (words, words[::-1]):
        scanner = lic.Scanner({w: float(i) for i, w in enumerate(order)})
        for text, label in texts.items():
            assert label in {t.label for t, _, _ in scanner(lic.words_of(text))}, text
    for only in words:
        scanner = lic.Scanner({w: float(w == only) for w in words})
        assert "gpl-3.0" in {t.label for t, _, _ in scanner(lic.words_of("licensed under GNU General Public License version 3"))}


def every_place(words, templates=lic.TEMPLATES):
    """All templates at all positions, word by word, without an index."""
    found = set()
    for n, t in enumerate(templates):
        for place in range(-len(t.words), len(words) + 1):
            there = [0 <= place + i < len(words) and words[place + i] == w for i, w in enumerate(t.words)]
            if all(all(there[at : at + len(part)]) for at, part in t.musts) and sum(there) / len(t.words) >= t.least:
                found.add((n, place, sum(there) / len(t.words)))
    return found


def altered(rng, words, share):
    out = []
    for w in words:
        x = rng.random()
        out += [rng.choice(words)] if x < share / 3 else [] if x < share / 2 else [w, w] if x < share * 2 / 3 else [w]
    return out


def test_labels_match_every_template_at_every_position():
    rng, vocabulary = random.Random(3), sorted({w for t in lic.TEMPLATES for w in t.words})
    number = {id(t): n for n, t in enumerate(lic.TEMPLATES)}
    texts = [[], [b"cc"], [w for t in lic.TEMPLATES for w in t.words]]
    for t in lic.TEMPLATES:
        for share in (0, 0.05, 0.2, 0.6):
            texts.append(rng.choices(vocabulary, k=5) + altered(rng, t.words, share) + rng.choices(vocabulary, k=5))
        texts += [part for _, part in t.musts] + [t.words[1:], t.words[:-1]]
        # The key phrases in place and nothing else: too little of a whole notice.
        bare = [b"x"] * len(t.words)
        for at, part in t.musts:
            bare[at : at + len(part)] = part
        texts.append(bare)
    hits = 0
    for order in range(4):
        scanner = lic.Scanner({w: rng.random() for w in vocabulary})
        for words in texts:
            got = {(number[id(t)], place, score) for t, place, score in scanner(words)}
            assert got == every_place(words)
            hits += len(got)
    assert hits > 500


def test_the_least_score_is_a_condition_of_its_own():
    for t in lic.NOTICES:
        bare = [b"x"] * len(t.words)
        for at, part in t.musts:
            bare[at : at + len(part)] = part
        scanner = lic.Scanner(dict.fromkeys({w for x in lic.TEMPLATES for w in x.places}, 1.0))
        assert t not in [x for x, *_ in scanner(bare)] and t in [x for x, *_ in scanner(t.words)], t.label


def test_whole_notices_and_their_scores(spark):
    mit = next(t for t in lic.NOTICES if t.label == "mit")
    df = spark.createDataFrame([(1, mit.text.capitalize() + "."), (2, "Permission is hereby granted, free of charge, to all readers, without restriction")], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in lic.scan(df).collect()}
    assert got[1] == ("mit", 1.0) and got[2][1] < 0.6


def test_frequent_words_are_not_looked_up():
    idf = {w: 0.0 if w in (b"the", b"of", b"and", b"is", b"in", b"to") else 5.0 for t in lic.TEMPLATES for w in t.words}
    scanner = lic.Scanner(idf)
    words = lic.words_of("the of and is in to " * 50 + "all rights reserved")
    assert scanner.possible_places(words)[1] == 2
    assert scanner.possible_places(lic.words_of("the of and is in to " * 50)) == ({}, 0)
