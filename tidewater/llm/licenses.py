"""License scans with a positional rare-token index, in DataFrame operations only.

The index maps the rarest words of every license template (by their document
frequency in the scanned corpus) to template and position.  A file's words are
looked up in it; each hit proposes a template and the place where the template
would start, the rare words found at their relative places weigh a proposal, and
the template's mandatory key phrases must stand at theirs.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import columns

# The word rule, and the base phrases with their labels.
DELIMITERS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# Passages of well-known licenses; (label, text, mandatory key phrases).
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction",
     ("permission is hereby granted free of charge", "to deal in the software without restriction")),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                 "in compliance with the License.",
     ("apache license version 2", "in compliance with the license")),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met",
     ("redistribution and use in source and binary forms", "following conditions are met")),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation",
     ("free software you can redistribute it", "gnu general public license")),
    ("gpl", "licensed under the GNU General Public License, version",
     ("licensed under the gnu general public license",)),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
     ("gnu lesser general public license",)),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
     ("gnu affero general public license",)),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
     ("mozilla public license v 2",)),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted",
     ("for any purpose with or without fee is hereby granted",)),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License",
     ("creative commons attribution 4 0 international license",)),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
     ("creative commons attribution sharealike 4 0 international license",)),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
     ("creative commons attribution noncommercial 4 0 international license",)),
    ("unlicense", "This is free and unencumbered software released into the public domain.",
     ("free and unencumbered software released into the public domain",)),
)
#: Rarest words of a template that are looked up (at least), those that weigh a proposal,
#: and the share of their weight that must stand at its place for it to count.
ANCHORS = 2
RARE = 6
LEAST = 0.6
#: A proposal is one number: template * SHIFT + start (starts may be negative).
SHIFT = 1 << 42
HALF = 1 << 41


def words_of(text: str) -> list[str]:
    return [w for w in re.split(DELIMITERS, text.translate(str.maketrans(UPPER, LOWER))) if w]


def templates() -> list[dict]:
    """Base phrases first (each its own key phrase), then the passages."""
    out = [{"label": a, "words": words_of(p), "keys": [(0, words_of(p))], "base": True} for a, p in BASE]
    for label, text, keys in TEMPLATES:
        words, places = words_of(text), []
        for key in keys:
            k = words_of(key)
            places.append((next(i for i in range(len(words)) if words[i:i + len(k)] == k), k))
        out.append({"label": label, "words": words, "keys": places, "base": False})
    return out


def split_words(text: Column) -> Column:
    """The words of a text (null: none): ASCII letters, lower-cased, digits and
    everything beyond ASCII."""
    norm = F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), DELIMITERS, " "))
    return F.filter(F.split(norm, " "), lambda w: w != "")


def document_frequency(docs: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Number of rows, and of those that hold each license word, over all rows."""
    listed = F.array(*map(F.lit, vocabulary))
    rows = (docs.select(split_words(F.col("text")).alias("words"))
            .select(F.explode(F.concat(F.array_intersect("words", listed), F.array(F.lit("")))).alias("word"))
            .groupBy("word").count().collect())  # a row per license word at most
    count = {r["word"]: r["count"] for r in rows}
    return count.pop("", 0), count


def index(n: int, df: dict[str, int], rare: int = RARE, least: float = LEAST) -> list[dict]:
    """The templates with their rarest words: (position, word, weight).  Those that
    are looked up weigh more than a place that counts may lack, so that it has one
    of them; a base phrase lacks none."""
    out = []
    for t in templates():
        idf = {w: math.log((n + 1) / (df.get(w, 0) + 1)) + 1 for w in t["words"]}
        chosen = sorted(set(t["words"]), key=lambda w: (-idf[w], t["words"].index(w)))[:rare]
        weight = {w: idf[w] * t["words"].count(w) for w in chosen}
        spare = 0.0 if t["base"] else (1 - least) * sum(weight.values()) + 1e-9
        enough = next((k for k in range(ANCHORS, len(chosen)) if sum(weight[w] for w in chosen[:k]) > spare), len(chosen))
        out.append({**t, "rare": [(i, w, idf[w]) for i, w in enumerate(t["words"]) if w in chosen],
                    "anchors": set(chosen[:enough])})
    return out


def scan(docs: DataFrame, least: float = LEAST, rare: int = RARE, doc_id: str = "doc_id",
         text: str = "text") -> DataFrame:
    """(doc_id, n_words, found): every accepted place of every template in the
    whole text, as structs of label, start (in words, from 0), weight (the share
    of the template's rare words found at their places) and base.

    A null text counts as empty and has no words; rows with null or repeated ids
    are scanned each on their own; further columns are ignored; no rows, no rows.
    """
    src = columns(docs, doc_id=doc_id, text=text)
    vocabulary = sorted({w for t in templates() for w in t["words"]})
    n, df = document_frequency(src, vocabulary)
    entries = index(n, df, rare, least)
    posted: dict[str, list[int]] = {}
    for t, e in enumerate(entries):
        for at, word, _ in e["rare"]:
            if word in e["anchors"]:
                posted.setdefault(word, []).append(t * SHIFT + HALF - at)
    known = F.array(*map(F.lit, sorted(posted)))
    postings = F.create_map(*(x for w in sorted(posted) for x in (F.lit(w), F.array(*map(F.lit, posted[w])))))
    table = F.array(*(F.struct(
        F.lit(e["label"]).alias("label"), F.lit(e["base"]).alias("base"),
        F.array(*(F.struct(F.lit(a).alias("at"), F.lit(w).alias("word"), F.lit(x / sum(r[2] for r in e["rare"])).alias("weight"))
                  for a, w, x in e["rare"])).alias("rare"),
        F.array(*(F.struct(F.lit(a).alias("at"), F.array(*map(F.lit, k)).alias("words")) for a, k in e["keys"])).alias("keys"),
    ) for e in entries))
    words = src.select("doc_id", split_words(F.col("text")).alias("words"))
    hits = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("w"), i.cast("bigint").alias("i"))),
                    lambda x: F.array_contains(known, x["w"]))
    starts = F.array_distinct(F.flatten(F.transform("hits", lambda h: F.transform(
        F.element_at(postings, h["w"]), lambda p: p + h["i"]))))

    def place(c: Column) -> Column:
        return F.struct(F.get(table, F.shiftright(c, 42).cast("int")).alias("t"),
                        (c.bitwiseAND(F.lit(SHIFT - 1)) - F.lit(HALF)).cast("int").alias("start"))

    def weighed(x: Column) -> Column:
        right = F.filter(x["t"]["rare"], lambda r: F.get("words", x["start"] + r["at"]) == r["word"])
        keys = F.forall(x["t"]["keys"], lambda k: (x["start"] + k["at"] >= 0)
                        & (F.slice("words", F.greatest(x["start"] + k["at"], F.lit(0)) + 1, F.size(k["words"])) == k["words"]))
        return F.struct(x["t"]["label"].alias("label"), x["start"].alias("start"),
                        F.least(F.aggregate(right, F.lit(0.0), lambda a, r: a + r["weight"]), F.lit(1.0)).alias("weight"),
                        x["t"]["base"].alias("base"), keys.alias("keys"))

    # Files without any rare license word are done after one look at their words.
    any_hit = F.arrays_overlap("words", known)
    empty = F.expr("cast(array() as array<struct<label: string, start: int, weight: double, base: boolean, keys: boolean>>)")
    found = F.filter(F.transform(F.transform("starts", place), weighed),
                     lambda f: f["keys"] & (f["base"] | (f["weight"] >= least)))
    return (words.withColumn("any_hit", any_hit)
            .withColumn("hits", F.when(F.col("any_hit"), hits))
            .withColumn("starts", F.when(F.col("any_hit"), starts))
            .select("doc_id", F.size("words").cast("bigint").alias("n_words"),
                    F.when(F.col("any_hit"), found).otherwise(empty).alias("found")))


def summary(scanned: DataFrame) -> DataFrame:
    """Counts, first and last place of the base phrases, labels and a score."""
    base = F.filter("found", lambda f: f["base"])

    def labels(found):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda f: f["label"]))), ",")

    starts = F.transform("base", lambda f: f["start"].cast("bigint"))
    return scanned.withColumn("base", base).select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels("base").alias("base_labels"), labels("found").alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda f: f["weight"])), F.lit(0.0)).alias("score"))
