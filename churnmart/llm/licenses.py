"""License scan with a positional index of rare words.

Templates are word sequences, from short phrases to whole notices, with mandatory key
phrases. The index holds the postings of every word of a key phrase: the templates it stands
in, and its position there. Document frequencies of these words, counted over all texts, rank
them. A file's words are looked up in the postings from its highest IDF downwards; each
look-up turns the word's places in the file into possible places of the templates (place
minus position), and only places on which a template's words agree remain. The walk ends when
every template whose key words the file has was met by two of them or has no place left, so
frequent words such as *the* or *of* are rarely looked up. At the places left the key phrases
must stand word by word, and the share of template words in place must reach the template's
least score. A place where the key phrases stand has all their words, so it remains whatever
the frequencies: the ranking decides how much work is done, never which labels are found.
"""

import math
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnmart.llm.common import arrow_map, id_type, slices, struct, text_or_empty

# On bytes of UTF-8 with A-Z lower-cased: digits, letters and all that is not ASCII.
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+").findall


def words_of(text: str) -> list[bytes]:
    return _WORDS(text.encode("utf-8", "surrogatepass").lower())


@dataclass(eq=False)
class Template:
    label: str
    text: str
    # Word sequences of ``text`` that must stand in place; the whole text if none is named.
    phrases: tuple = ()
    # Least share of template words in place, besides the phrases.
    least: float = 0.0
    base: bool = False
    words: list = field(init=False)
    musts: list = field(init=False)
    places: dict = field(init=False)

    def __post_init__(self):
        self.words = words_of(self.text)
        self.musts = []
        for phrase in self.phrases or (self.text,):
            part = words_of(phrase)
            at = next(i for i in range(len(self.words)) if self.words[i : i + len(part)] == part)
            self.musts.append((at, part))
        # One position of each key word: any of them leads to every place of the template.
        self.places = {}
        for at, part in self.musts:
            for i, word in enumerate(part):
                self.places.setdefault(word, at + i)


# Base phrases and their labels.
BASE = (
    Template("cc-by", "cc by", base=True),
    Template("gpl", "general public license", base=True),
    Template("reserved", "all rights reserved", base=True),
)
# Added by this scanner.
ADDED = (
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted", "free of charge")),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("general public license version 3",)),
    Template("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    Template("agpl", "gnu affero general public license", ("affero general public license",)),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source and binary forms",)),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc0", "dedicated to the public domain under cc0 1 0 universal", ("cc0 1 0",)),
)
# Whole notices; a text that keeps the key phrases but little else of one is not labelled by it.
NOTICES = (
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions the above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the software",
        ("permission is hereby granted free of charge", "without restriction"), 0.6,
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
        ("permission to use copy modify", "with or without fee"), 0.6,
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met redistributions of source code must retain the above copyright notice this list "
        "of conditions and the following disclaimer",
        ("redistribution and use", "provided that the following conditions are met"), 0.6,
    ),
    Template(
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
        "the license you may obtain a copy of the license at",
        ("apache license", "except in compliance with the license"), 0.6,
    ),
    Template(
        "gpl-3.0",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version 3 of the license or at your option "
        "any later version",
        ("gnu general public license as published by the free software foundation", "version 3"), 0.6,
    ),
    Template(
        "gpl-2.0",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version 2 of the license or at your option "
        "any later version",
        ("gnu general public license as published by the free software foundation", "version 2"), 0.6,
    ),
    Template(
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
        "distributed with this file you can obtain one at",
        ("source code form is subject to the terms", "a copy of the mpl"), 0.6,
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish "
        "use compile sell or distribute this software either in source code form or as a compiled binary for any "
        "purpose commercial or non commercial and by any means",
        ("free and unencumbered software", "public domain"), 0.6,
    ),
    Template(
        "zlib",
        "permission is granted to anyone to use this software for any purpose including commercial applications and to "
        "alter it and redistribute it freely subject to the following restrictions the origin of this software must not "
        "be misrepresented you must not claim that you wrote the original software",
        ("permission is granted to anyone to use this software", "the origin of this software must not be misrepresented"), 0.6,
    ),
)
TEMPLATES = BASE + ADDED + NOTICES


def idf_of(docs: DataFrame, templates=TEMPLATES, text_col="text") -> dict[bytes, float]:
    """Inverse document frequency of every word of a key phrase, counted over all texts."""
    vocabulary = {w for t in templates for w in t.places}

    def task(batches):
        seen, total = dict.fromkeys(vocabulary, 0), 0
        for (texts,) in batches:
            total += len(texts)
            for text in texts:
                for word in vocabulary.intersection(words_of(text)):
                    seen[word] += 1
        yield [None, *seen], [total, *seen.values()]

    counts = arrow_map(docs.select(text_or_empty(text_col).alias("text")), struct(word=T.BinaryType(), n=T.LongType()), task)
    # One row per licence word.
    rows = {r["word"] if r["word"] is None else bytes(r["word"]): r["n"] for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    total = rows.get(None, 0)
    return {w: math.log((1 + total) / (1 + rows.get(w, 0))) for w in vocabulary}


class Scanner:
    """Places of the templates in one text; made once per task."""

    def __init__(self, idf, templates=TEMPLATES):
        self.templates = templates
        # Rarest first; equal ones by spelling.
        self.rank = {w: n for n, w in enumerate(sorted({w for t in templates for w in t.places}, key=lambda w: (-idf[w], w)))}
        self.vocabulary = frozenset(self.rank)
        self.postings = {w: [(n, t.places[w]) for n, t in enumerate(templates) if w in t.places] for w in self.rank}
        # The templates a text can hold are those whose rarest key word it has, and the others too.
        self.by_rarest = {}
        for n, t in enumerate(templates):
            self.by_rarest.setdefault(min(t.places, key=self.rank.get), []).append((n, frozenset(t.places)))

    def possible_places(self, words):
        """({template number: places left}, words looked up) after the walk down the file's ranking."""
        have = self.vocabulary.intersection(words)
        left = {n: None for w in have if w in self.by_rarest for n, needed in self.by_rarest[w] if needed <= have}
        if not left:
            return left, 0
        lookups = dict.fromkeys(left, 0)
        # A template met by two of its words, or by all if it has fewer, is done.
        due = {n: min(2, len(self.templates[n].places)) for n in left}
        stands, looked_up = None, 0
        for word in sorted(have, key=self.rank.get):
            if not due:
                break
            met = [(n, i) for n, i in self.postings[word] if n in due]
            if not met:
                continue
            if stands is None:
                stands = {w: [] for w in have}
                for at, w in enumerate(words):
                    if w in have:
                        stands[w].append(at)
            looked_up += 1
            for n, i in met:
                places = {at - i for at in stands[word]}
                left[n] = places if left[n] is None else left[n] & places
                lookups[n] += 1
                if lookups[n] == due[n] or not left[n]:
                    del due[n]
        return left, looked_up

    def __call__(self, words):
        """[(template, place, score)] for the words of a text."""
        found = []
        for n, places in self.possible_places(words)[0].items():
            template = self.templates[n]
            for place in sorted(places):
                if score := score_at(template, words, place):
                    found.append((template, place, score))
        return found


def score_at(template, words, place):
    """Share of template words in place; None if a key phrase does not stand or too few words do."""
    if any(place + i < 0 or words[place + i : place + i + len(part)] != part for i, part in template.musts):
        return None
    same = sum(0 <= place + i < len(words) and words[place + i] == w for i, w in enumerate(template.words))
    score = same / len(template.words)
    return score if score >= template.least else None


def scan(docs: DataFrame, id_col="doc_id", text_col="text", templates=TEMPLATES) -> DataFrame:
    """Licence labels of every whole text, with the places of the base phrases.

    Rows: the id, ``n_words``, ``n_base`` places of base phrases, ``first_word`` and
    ``last_word`` of them, ``base_labels``, ``labels`` (of all templates), ``score`` (the
    best share of words in place, 0 without a label). NULL and empty texts have no words.
    Rows with NULL or repeated ids are reported each for itself. An empty table gives no
    rows. Other columns are not read.
    """
    idf = idf_of(docs, templates, text_col)
    schema = struct(
        **{id_col: id_type(docs, id_col)}, n_words=T.LongType(), n_base=T.LongType(), first_word=T.LongType(),
        last_word=T.LongType(), base_labels=T.StringType(), labels=T.StringType(), score=T.DoubleType(),
    )

    def task(batches):
        scanner = Scanner(idf, templates)
        for batch in batches:
            for ids, texts in slices(batch, 512):
                rows = []
                for key, text in zip(ids, texts):
                    words = words_of(text)
                    found = scanner(words)
                    base = [place for t, place, _ in found if t.base]
                    label = lambda some: ",".join(sorted({t.label for t, _, _ in some}))
                    rows.append((
                        key, len(words), len(base), min(base, default=None), max(base, default=None),
                        label(x for x in found if x[0].base), label(found), max((s for *_, s in found), default=0.0),
                    ))
                yield list(zip(*rows))

    return arrow_map(docs.select(id_col, text_or_empty(text_col).alias("text")), schema, task)
