"""Operator 7: licence scans by a positional index of rare words, in DataFrame functions only.

A template is a short notice, as words. The words of all templates are counted over all
documents, which gives each its inverse document frequency. Of each template whose key phrase's
words a file has, the rarest of these words are looked up: each place of such a word votes for
the starts that the template's postings give it. A start with the votes of all of them is held
against the template: its key phrase must stand there in full, and its score is the share of the
template's words that stand at their places. As a start without the key phrase is none, the
votes lose no start, however many notices a file holds. Counting and scanning read the texts once
each; nothing but one row per licence word is shuffled.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logmill.llm.common import id_and_text, table

_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices: label, words, key phrase (a part of the words).
TEMPLATES = (
    ("agpl-3.0", "licensed under the gnu affero general public license version 3", "gnu affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
     "that the following conditions are met", "redistribution and use in source and binary forms"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license",
     "creative commons attribution 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-nd-4.0", "licensed under cc by nd 4 0", "cc by nd 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("cc0-1.0", "licensed under cc0 1 0 universal", "cc0 1 0"),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2",
     "gnu general public license version 2"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3",
     "gnu general public license version 3"),
    ("lgpl-3.0", "licensed under the gnu lesser general public license version 3", "gnu lesser general public license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     "permission is hereby granted free of charge"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
     "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "free and unencumbered software"),
)


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _vocabulary(templates) -> list[str]:
    return sorted({w for _, words, _ in templates for w in words.split()} | {w for p in BASE for w in p.split()})


def words_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc`` and ``w``, the words of the whole text with A-Z as small letters."""
    text = F.translate(F.coalesce("text", F.lit("")), _CAPITALS, _SMALL)
    words = F.filter(F.split(text, _NOT_WORD), lambda w: w != "")
    return id_and_text(df, id_col, text_col).select("doc", words.alias("w"))


def frequencies(words: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """Inverse document frequency of each word of the vocabulary over all rows of ``words``."""
    found = words.select(F.explode_outer(F.array_union(F.array_intersect(_strings(vocabulary), "w"), _strings([""]))).alias("word"))
    counts = {r["word"]: r["count"] for r in found.groupBy("word").count().collect()}
    total = counts.pop("", 0)
    return {w: math.log((1 + total) / (1 + counts.get(w, 0))) for w in vocabulary}


def scan(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates=TEMPLATES,
    votes: int = 2,
    least_score: float = 0.6,
) -> DataFrame:
    """``doc, n_words, n_base, first_word, last_word, base_labels, labels, score`` of each row.

    ``votes``: words of a template's key phrase, the rarest, that are looked up and must agree on
    a start (all, if it has fewer); ``least_score``: least share of template words in place.
    ``score`` is the best of the labels that the templates add, 0 without one. A null or empty text has no words and no labels. Rows are independent:
    repeated rows and null ids pass through; other columns are not read.
    """
    words = words_of(df, id_col, text_col)
    vocabulary = _vocabulary(templates)
    idf = frequencies(words, vocabulary)
    ranked = sorted(vocabulary, key=lambda w: (-idf[w], w))
    rare = [[w for w in ranked if w in key.split()][:votes] for _, _, key in templates]
    rows = words.select("doc", "w", F.array_intersect(_strings(ranked), "w").alias("has"))
    rows = rows.select("doc", "w", "has", *_base_places(), _rare_words(templates, rare).alias("rare"))
    rows = rows.withColumn("starts", _starts(templates, rare))
    rows = rows.withColumn("found", _verified(templates, least_score))
    places = F.array_sort(F.flatten(F.array(*[F.col(f"b{k}") for k in range(len(BASE))])))
    base = [F.when(F.size(f"b{k}") > 0, F.lit(label)) for k, label in enumerate(BASE.values())]
    rows = rows.select(
        "doc",
        F.size("w").cast("long").alias("n_words"),
        places.alias("places"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*base)))).alias("base"),
        "found",
    )
    return rows.select(
        "doc",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.get("places", F.lit(0)).cast("long").alias("first_word"),
        F.get("places", F.size("places") - 1).cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.col("found.label"))), ",").alias("labels"),
        F.coalesce(F.array_max("found.score"), F.lit(0.0)).alias("score"),
    )


def _base_places() -> list[Column]:
    """``bk``: starts of each base phrase, looked for only where all its words are present."""
    columns = []
    for k, phrase in enumerate(BASE):
        own = phrase.split()
        there = reduce(Column.__and__, (F.array_contains("has", w) for w in own))
        same = " and ".join(f"get(w, i + {j}) = '{w}'" for j, w in enumerate(own))
        places = F.expr(f"filter(transform(w, (x, i) -> if(x = '{own[0]}' and {same}, i, -1)), i -> i >= 0)")
        columns.append(F.when(there, places).otherwise(F.expr("cast(array() as array<int>)")).alias(f"b{k}"))
    return columns


def _keyed(key: str) -> Column:
    return reduce(Column.__and__, (F.array_contains("has", w) for w in key.split()))


def _key_place(words: str, key: str) -> int:
    own = key.split()
    return next(i for i in range(len(words.split())) if words.split()[i : i + len(own)] == own)


def _rare_words(templates, rare: list[list[str]]) -> Column:
    """The words to look up in a file: those of each template that has all words of its key phrase there."""
    none = F.expr("cast(array() as array<string>)")
    found = [F.when(_keyed(key), _strings(own)).otherwise(none) for (_, _, key), own in zip(templates, rare)]
    return F.array_distinct(F.flatten(F.array(*found)))


def _starts(templates, rare: list[list[str]]) -> Column:
    """(template, start) on which all of the template's rare words agree."""
    postings: dict[str, list[tuple[int, int]]] = {}
    for t, (_, words, key) in enumerate(templates):
        at = _key_place(words, key)
        for place, word in enumerate(key.split(), at):
            if word in rare[t]:
                postings.setdefault(word, []).append((t, place))
    index = F.create_map(
        *[
            x
            for word, own in postings.items()
            for x in (F.lit(word), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(p).alias("p")) for t, p in own]))
        ]
    )
    places = F.filter(
        F.transform("w", lambda w, i: F.when(F.array_contains("rare", w), F.struct(w.alias("word"), i.alias("i")))),
        lambda x: x.isNotNull(),
    )
    cast = F.flatten(
        F.transform(
            places,
            lambda x: F.transform(
                index[x["word"]],
                lambda y: F.struct(y["t"].alias("t"), (x["i"] - y["p"]).alias("start"), x["word"].alias("word")),
            ),
        )
    )
    # sorted by template, start and word, votes of different words for one start stand together
    ordered = F.array_sort(F.array_distinct(cast))
    need = F.create_map(*[x for t, own in enumerate(rare) for x in (F.lit(t), F.lit(len(own)))])
    agreed = F.transform(
        F.array(F.struct(ordered.alias("votes"))),
        lambda one: F.transform(
            one["votes"],
            lambda v, i: F.when(
                (F.get(one["votes"], i + need[v["t"]] - 1)["t"] == v["t"])
                & (F.get(one["votes"], i + need[v["t"]] - 1)["start"] == v["start"]),
                F.struct(v["t"].alias("t"), v["start"].alias("start")),
            ),
        ),
    )
    starts = F.array_distinct(F.array_compact(F.flatten(agreed)))
    return F.when(F.size("rare") > 0, starts).otherwise(F.expr("cast(array() as array<struct<t: int, start: int>>)"))


def _verified(templates, least_score: float) -> Column:
    """(label, score) of the starts where the key phrase stands and enough other words, the best first."""
    found = None
    for t, (label, words, key) in enumerate(templates):
        own = words.split()
        at = _key_place(words, key)
        in_place = " + ".join(f"if(get(w, s.start + {k}) <=> '{x}', 1, 0)" for k, x in enumerate(own))
        keyed = " and ".join(f"get(w, s.start + {at + k}) <=> '{x}'" for k, x in enumerate(key.split()))
        one = F.expr(f"""filter(transform(filter(starts, s -> s.t = {t} and {keyed}),
            s -> named_struct('label', '{label}', 'score', ({in_place}) / {len(own)})), x -> x.score >= {least_score})""")
        found = one if found is None else F.concat(found, one)
    empty = F.expr("cast(array() as array<struct<label: string, score: double>>)")
    return F.when(F.size("starts") > 0, found).otherwise(empty)


def op7_license_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).withColumnRenamed("doc", "doc_id")
