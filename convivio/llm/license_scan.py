"""License scan with a positional index of rare tokens.

The templates are split into words; their postings are (word, template, position). One pass over the texts stores
the positional index: the places of all template words in each file. All that follows reads the index, not the
texts. Document frequencies of the template words are counted over the whole table. Each template is looked up by its
rarest words (highest inverse document frequency). A file joins the places of all looked-up words with the postings of
the templates whose words it holds, and votes for (template, offset): words that stand in the template's order agree
on the offset. An offset with enough of the template's rarity behind it is verified: all mandatory phrases of the
template must stand around it. Only DataFrame functions.

Base phrases are looked for in every text, wherever they stand; they always count.

Defined results: a null text is empty and has no label and score 0. Repeated rows are scanned alike (rows with
one id and different texts are scanned apart). An empty table gives an empty result. Extra columns pass through,
but for the text itself; the operator's own columns replace columns of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable
from .common import ascii_lower, sheltered

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Phrases of the base scan, with their labels.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
# Fixed values: (label, template, mandatory phrases). Customary notices of public licences.
TEMPLATES = [
    ("apache", "licensed under the apache license version 2 0", ["apache license"]),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in "
               "compliance with the license", ["apache license", "in compliance with the license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("bsd", "released under the bsd license", ["bsd license"]),
    ("cc-by", "licensed under cc by 4 0", ["under cc by 4"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
     ["creative commons attribution 4"]),
    ("gpl", "this work is licensed under the gnu general public license version 3", ["general public license"]),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published "
            "by the free software foundation", ["general public license"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted", ["distribute this software for any purpose with or without fee"]),
    ("lgpl", "licensed under the gnu lesser general public license", ["lesser general public license"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files", ["permission is hereby granted free of charge"]),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ["mozilla public license"]),
    ("proprietary", "all rights reserved", ["all rights reserved"]),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ["unencumbered software released into the public domain"]),
]
# Rarest words by which each template is looked up, and the part of a template's looked-up rarity that must agree on an offset.
RAREST, LEAST_SHARE = 12, 0.6


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def vocabulary(templates=TEMPLATES) -> list[str]:
    """All words of the templates, their mandatory phrases and the base phrases."""
    texts = [p for p, _ in PHRASES] + [t for _, text, phrases in templates for t in (text, *phrases)]
    return sorted({w for text in texts for w in text.split()})


def places_of(every: str, words: list[str]) -> Column:
    """Places (i, w) of the given words in a column of all words, in the text's order."""
    held = F.transform(every, lambda w, i: F.when(w.isin(words), F.struct(i.alias("i"), w.alias("w"))))
    return F.filter(held, lambda x: x.isNotNull())


def word_idf(index: DataFrame, words: list[str]) -> dict[str, float]:
    """Inverse document frequency of the template words over all documents, from their `_present`.

    The driver gets one number per template word, whatever the table holds.
    """
    # A null entry stands for the document itself, so that one pass counts documents too.
    marks = F.concat("_present", F.array(F.lit(None).cast("string")))
    found = {r["w"]: r["count"] for r in index.select(F.explode(marks).alias("w")).groupBy("w").count().collect()}
    total = found.get(None, 0)
    return {w: math.log((total + 1) / (found.get(w, 0) + 1)) + 0.01 for w in words}


def chosen_words(idf: dict[str, float], template: str, rarest: int) -> list[str]:
    """The rarest words of a template."""
    return sorted(set(template.split()), key=lambda w: (-idf[w], w))[:rarest]


def _postings(idf: dict[str, float], templates, rarest: int) -> Column:
    """A literal map word -> [(template, place)] for the rarest words of each template."""
    places: dict[str, list[tuple[int, int]]] = {}
    for t, (_, text, _) in enumerate(templates):
        chosen = chosen_words(idf, text, rarest)
        for at, word in enumerate(text.split()):
            if word in chosen:
                places.setdefault(word, []).append((t, at))
    return _map({w: F.array(*[F.struct(F.lit(t).alias("t"), F.lit(at).alias("at")) for t, at in found])
                 for w, found in places.items()})


def _map(values: dict) -> Column:
    lits = [v if isinstance(v, Column) else F.lit(v) for v in values.values()]
    return F.map_from_arrays(F.array(*map(F.lit, values)), F.array(*lits))


def base_places(hits: Column) -> dict[str, Column]:
    """Start words of each base phrase: neighbours in the text are neighbours among the hits."""
    def places(parts: list[str]) -> Column:
        def begins(x: Column, at: Column) -> Column:
            tests = [x["w"] == parts[0]]
            for k, part in enumerate(parts[1:], 1):
                other = F.get(hits, at + k)
                tests += [other["w"] == part, other["i"] == x["i"] + k]
            return F.when(_all(tests), x["i"])

        return F.filter(F.transform(hits, begins), lambda i: i.isNotNull())

    return {phrase: places(phrase.split()) for phrase, _ in PHRASES}


def _all(tests: list[Column]) -> Column:
    out = tests[0]
    for test in tests[1:]:
        out = out & test
    return out


def _candidates(files: DataFrame, idf: dict[str, float], templates, rarest: int, least_share: float) -> DataFrame:
    """(doc_id, _key, _found, _share): verified templates of each file; `files` has doc_id, _key, _hits, _present."""
    chosen = [chosen_words(idf, text, rarest) for _, text, _ in templates]
    total = _map({t: sum(idf[w] for w in text.split() if w in chosen[t]) for t, (_, text, _) in enumerate(templates)})
    # A template whose looked-up words are not all but present cannot win at any offset.
    could = []
    for t, (_, text, _) in enumerate(templates):
        words = [w for w in text.split() if w in chosen[t]]
        weight = sum(idf[w] for w in words)
        share = sum((F.when(F.array_contains("_present", w), idf[w] * words.count(w)).otherwise(0.0) for w in chosen[t]),
                    F.lit(0.0))
        could.append(F.when(share >= least_share * weight - 1e-9, F.lit(t)))
    able = files.withColumn("_able", F.filter(F.array(*could), lambda t: t.isNotNull())).filter(F.size("_able") > 0)
    near = durable(able.drop("_present").dropDuplicates(["doc_id", "_key"]))
    postings = F.filter(F.try_element_at(_postings(idf, templates, rarest), F.col("h.w")),
                        lambda p: F.array_contains("_able", p["t"]))
    placed = near.select("doc_id", "_key", "_able", F.explode("_hits").alias("h")).select(
        "doc_id", "_key", F.col("h.i").alias("_i"), F.element_at(_map(idf), F.col("h.w")).alias("_idf"),
        F.explode(postings).alias("p"))
    votes = placed.select("doc_id", "_key", F.col("p.t").alias("_t"), F.col("p.at").alias("_at"), "_idf",
                          (F.col("_i") - F.col("p.at")).alias("_off"))
    # Two overlapping rows of bins, four offsets wide, so that an inserted or missing word does not split the vote.
    bins = F.array(F.floor(F.col("_off") / 4) * 2, F.floor((F.col("_off") + 2) / 4) * 2 + 1)
    polled = votes.withColumn("_bin", F.explode(bins)).groupBy("doc_id", "_key", "_t", "_bin").agg(
        F.min("_off").alias("_off"), F.collect_set(F.struct("_at", "_idf")).alias("_set"))
    share = F.aggregate("_set", F.lit(0.0), lambda acc, x: acc + x["_idf"]) / F.element_at(total, F.col("_t"))
    won = polled.withColumn("_share", share).filter(F.col("_share") >= least_share - 1e-9).drop("_set", "_bin")
    won = won.withColumnsRenamed({"doc_id": "_d", "_key": "_k"})
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_key") == F.col("_k"))
    length = F.element_at(_map({t: len(text.split()) for t, (_, text, _) in enumerate(templates)}), F.col("_t"))
    low = F.greatest(F.col("_off") - 3, F.lit(1)) - 1
    around = F.filter("_hits", lambda x: (x["i"] >= low) & (x["i"] < low + length + 12))
    # A bar, which no word holds, stands where words between two hits are left out.
    spaced = F.transform("_around", lambda x, k: F.when(
        F.get(F.col("_around"), k - 1)["i"] == x["i"] - 1, x["w"]).otherwise(F.concat(F.lit("| "), x["w"])))
    phrases = F.element_at(_map({t: F.array(*map(F.lit, p)) for t, (_, _, p) in enumerate(templates)}), F.col("_t"))
    line = F.concat(F.lit(" "), F.array_join(spaced, " "), F.lit(" "))
    checked = near.join(won, same).withColumn("_around", around).withColumn("_line", line).filter(
        F.forall(phrases, lambda p: F.contains(F.col("_line"), F.concat(F.lit(" "), p, F.lit(" ")))))
    label = F.element_at(_map({t: name for t, (name, _, _) in enumerate(templates)}), F.col("_t"))
    return checked.groupBy(F.col("_d"), F.col("_k")).agg(
        F.collect_set(label).alias("_found"), F.least(F.max("_share"), F.lit(1.0)).alias("_share"))


def scan(docs: DataFrame, templates=TEMPLATES, rarest: int = RAREST, least_share: float = LEAST_SHARE) -> DataFrame:
    """Every row, without its text, with n_words, n_base, first_word, last_word, base_labels, labels and score.

    The score is the largest agreeing share of a verified template, or a half if only a base phrase stands.
    """
    own = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    vocab = vocabulary(templates)
    narrow, back = sheltered(docs, ["doc_id", "text"], own)
    kept = [c for c in narrow.columns if c != "text"]
    # A projection of its own, so that the words are taken once for all uses.
    split = narrow.select(*kept, F.xxhash64("text").alias("_key"),
                        words_of(F.coalesce(ascii_lower(F.col("text")), F.lit(""))).alias("_words"))
    index = durable(split.select(*kept, "_key", F.size("_words").cast("long").alias("n_words"),
                                 places_of("_words", vocab).alias("_hits"),
                                 F.array_intersect("_words", F.array(*map(F.lit, vocab))).alias("_present")))
    idf = word_idf(index, vocab)
    found = _candidates(index.select("doc_id", "_key", "_hits", "_present"), idf, templates, rarest, least_share)
    places = base_places(F.col("_hits"))
    starts = F.concat(*places.values())
    base = F.filter(F.array(*[F.when(F.size(places[p]) > 0, F.lit(name)) for p, name in PHRASES]), lambda x: x.isNotNull())
    df = index.select(*kept, "_key", "n_words", starts.alias("_starts"), F.array_sort(F.array_distinct(base)).alias("_base"))
    joined = df.join(found, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_key") == F.col("_k")), "left")
    labels = F.array_sort(F.array_distinct(F.concat("_base", F.coalesce("_found", F.array().cast("array<string>")))))
    least = F.when(F.size("_base") > 0, 0.5).otherwise(0.0)
    out = joined.select(
        *kept, F.lit(None).cast("string").alias("text"), "n_words", F.size("_starts").cast("long").alias("n_base"),
        F.array_min("_starts").cast("long").alias("first_word"), F.array_max("_starts").cast("long").alias("last_word"),
        F.array_join("_base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.greatest(F.coalesce("_share", F.lit(0.0)), least).alias("score"))
    return back(out, *own).drop("text")
