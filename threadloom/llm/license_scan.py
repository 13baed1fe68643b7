"""Licence scan over a positional index of rare words.

The corpus gives each mandatory word's document frequency. Each template's mandatory
word of highest IDF is posted as (word, template, position) and always looked up,
however common it is; each occurrence and posting name a place where the template
would start, and there all mandatory words must stand, and a given share of the
template's words.

All of it is DataFrame functions: one pass for the frequencies (as many rows come
back as templates have words), one for the scan; no shuffle of texts.

Defined results: a null text counts as empty (no words, no labels, score 0);
each input row gives one row, repeated rows too; extra columns are dropped.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

# Licence notices in words, and what is in [] must be there.
NOTICES = {
    "apache": ["licensed under the [apache license] version 2 0", "you may not use this file except in compliance with the [apache license]"],
    "bsd": ["[redistribution and use in source and binary forms] with or without modification are permitted provided that the following conditions are met", "released under the [bsd license]"],
    "cc-by-nc": ["licensed under [cc by nc] 4 0", "licensed under a creative commons [attribution noncommercial] 4 0 international license"],
    "cc-by-sa": ["licensed under [cc by sa] 4 0", "licensed under a creative commons [attribution sharealike] 4 0 international license"],
    "cc0": ["to the extent possible under law the author has waived all copyright and related rights [cc0]", "released under [cc0] 1 0"],
    "gpl-family": ["this work is licensed under the gnu [general public license] version 3", "you can redistribute it and or modify it under the terms of the gnu [general public license] as published by the free software foundation"],
    "lgpl": ["licensed under the gnu [lesser general public license] version 3"],
    "mit": ["released under the [mit license]", "[permission is hereby granted free of charge to any person] obtaining a copy of this software and associated documentation files"],
    "mpl": ["this source code form is subject to the terms of the [mozilla public license] v 2 0"],
}
# Base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _templates(notices: dict[str, list[str]], phrases: dict[str, str]) -> list[dict]:
    made = []
    for label, texts in notices.items():
        for text in texts:
            words, must, inside = [], [], False
            for w in text.split():
                inside |= w.startswith("[")
                words.append(w.strip("[]"))
                must.append(inside)
                inside &= not w.endswith("]")
            made.append({"label": label, "words": words, "must": must, "base": False})
    return made + [{"label": v, "words": k.split(), "must": [True] * len(k.split()), "base": True} for k, v in phrases.items()]


def _text(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def words_of(text: Column) -> Column:
    """Words, without A-Z: what stands between separators."""
    joined = F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS, " "))
    return F.when(joined == "", F.array().cast("array<string>")).otherwise(F.split(joined, " "))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices: dict[str, list[str]] = NOTICES, phrases: dict[str, str] = PHRASES, least_share: float = 0.8) -> DataFrame:
    """One row a document: n_words, n_base, first_word, last_word, base_labels, labels, score.

    Each template is anchored at the mandatory word that fewest documents have. A match
    has all mandatory words, so none is missed, however common the anchor is.
    ``score``: the largest share of a matched template's words, 0 without a match.
    """
    templates = _templates(notices, phrases)
    vocabulary = sorted({w for t in templates for w, m in zip(t["words"], t["must"], strict=True) if m})
    listed = F.array(*map(F.lit, vocabulary))
    words = docs.select(F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("w"))
    # Bounded by the templates: one row a licence word and one for the total.
    counted = words.select(F.explode(F.array_append(F.array_intersect("w", listed), F.lit(""))).alias("word")).groupBy("word").count()
    frequency = {r["word"]: r["count"] for r in counted.collect()}
    n = max(1, frequency.get("", 0))
    idf = {w: math.log(n / max(1, frequency.get(w, 0))) for w in vocabulary}
    places_of = [max((p for p, m in enumerate(t["must"]) if m), key=lambda p, t=t: (idf[t["words"][p]], t["words"][p])) for t in templates]
    anchors = sorted({t["words"][p] for t, p in zip(templates, places_of, strict=True)}, key=lambda w: (-idf[w], w))
    ranked = ", ".join(map(_text, anchors)) or "''"
    postings = ", ".join(f"named_struct('word', {_text(t['words'][p])}, 't', {i}, 'p', {p})" for i, (t, p) in enumerate(zip(templates, places_of, strict=True)))
    shapes = ", ".join("named_struct('label', {}, 'base', {}, 'words', array({}), 'must', array({}))".format(_text(t["label"]), str(t["base"]).lower(), ", ".join(map(_text, t["words"])), ", ".join(f"named_struct('p', {p}, 'word', {_text(w)})" for p, w in enumerate(t["words"]) if t["must"][p])) for t in templates)

    # array_intersect keeps the first array's order: the highest IDF first. A template has one posting, so no start comes twice.
    looked = words.selectExpr("id", "w", f"array_intersect(array({ranked}), w) AS top")
    places = looked.selectExpr("id", "w", "IF(size(top) = 0, array(), filter(sequence(0, size(w)), i -> array_contains(top, get(w, i)))) AS places")
    starts = places.selectExpr("id", "w", f"flatten(transform(places, i -> transform(filter(array({postings}), q -> q.word = get(w, i)), q -> named_struct('t', q.t, 's', i - q.p)))) AS starts")
    shaped = starts.selectExpr("id", "w", "starts", f"IF(size(starts) = 0, array(), array({shapes})) AS shape")
    checked = shaped.selectExpr(
        "id", "size(w) AS n",
        f"""filter(transform(filter(starts, c -> forall(shape[c.t].must, m -> get(w, c.s + m.p) <=> m.word)),
              c -> named_struct('label', shape[c.t].label, 'base', shape[c.t].base, 's', c.s,
                                'share', size(filter(shape[c.t].words, (x, i) -> get(w, c.s + i) <=> x)) / size(shape[c.t].words))),
            h -> h.share >= {least_share}) AS hits""",
    )
    base = checked.selectExpr("id", "n", "hits", "transform(filter(hits, h -> h.base), h -> h.s) AS s")
    return base.selectExpr(
        f"id AS `{id_col}`", "CAST(n AS BIGINT) AS n_words", "CAST(size(s) AS BIGINT) AS n_base", "CAST(array_min(s) AS BIGINT) AS first_word", "CAST(array_max(s) AS BIGINT) AS last_word",
        "array_join(array_sort(array_distinct(transform(filter(hits, h -> h.base), h -> h.label))), ',') AS base_labels",
        "array_join(array_sort(array_distinct(transform(hits, h -> h.label))), ',') AS labels",
        "CAST(coalesce(array_max(transform(hits, h -> h.share)), 0.0) AS DOUBLE) AS score",
    )
