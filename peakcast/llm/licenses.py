"""License scan by diagonal voting.

All rolling word k-gram hashes of the documents are joined to the positions of the same hashes in license
templates (a parameter of any length; the broadcast side has a row for each template word and is counted). A hit votes for the diagonal (document
position minus template position); neighbouring diagonals, which differ by words put in or left out, are
merged, and a merged span counts if it covers enough of the template's words. Covered positions are held as bits, in
parts of PART positions, so a template may be a whole license text.

Base phrases are templates of their own that must stand unchanged: their one hash covers the whole phrase.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import doc_text, stored
from .wordcols import ascii_words, hash_at

# Phrases and labels of the base scan.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Sentences and whole texts of public license notices (words in lower case).
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in "
                   "compliance with the license you may obtain a copy of the license at"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is "
                   "distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
            "of the software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation the "
            "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
            "persons to whom the software is furnished to do so subject to the following conditions the above copyright "
            "notice and this permission notice shall be included in all copies or substantial portions of the software the "
            "software is provided as is without warranty of any kind express or implied including but not limited to the "
            "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the "
            "authors or copyright holders be liable for any claim damages or other liability whether in an action of "
            "contract tort or otherwise arising from out of or in connection with the software or the use or other dealings "
            "in the software"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted provided that the above copyright notice and this permission notice appear in all copies the software "
            "is provided as is and the author disclaims all warranties with regard to this software including all implied "
            "warranties of merchantability and fitness in no event shall the author be liable for any special direct "
            "indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether "
            "in an action of contract negligence or other tortious action arising out of or in connection with the use or "
            "performance of this software"),
]
K = 3
#: Share of a template's words that a span must cover.
COVER = 0.75
#: Diagonals this close are one span.
SLIP = 2
#: Positions of a template whose bits are held in one long (a gram may reach K - 1 bits further before it is cut).
PART = 60
#: Words of all templates together up to which their grams are broadcast; beyond, they are joined by shuffle.
MAX_BROADCAST = 200_000


def template_words(text: str) -> list[str]:
    """Words of a template, by the documents' rule."""
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def _templates(spark, cut: list[list[str]]) -> DataFrame:
    """gram hash, template number (negative for base phrases), position: a row for each word of the templates."""
    rows = [(-i - 1, len(p.split()), p.split(), [0]) for i, p in enumerate(BASE)]
    rows += [(i, K, w, list(range(len(w) - K + 1))) for i, w in enumerate(cut)]
    df = (spark.createDataFrame(rows, "template int, kind int, words array<string>, places array<int>")
          .select("template", "kind", "words", F.explode("places").alias("at")))
    key = F.lit(None).cast("long")
    for k in sorted({K, *(len(p.split()) for p in BASE)}):
        key = F.when(F.col("kind") == k, hash_at(F.col("words"), F.col("at"), tuple(range(k)), k)).otherwise(key)
    grams = df.select(key.alias("gram"), "template", "at")
    return F.broadcast(grams) if sum(map(len, cut)) <= MAX_BROADCAST else grams


def license_scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """Per document: doc_id, n_words, n_base (places of base phrases), first_word, last_word (smallest and largest
    start of those, else null), base_labels, labels (both sorted, distinct, comma-joined), score (best cover of a
    template, 1 with a base phrase), spans (label, first and last word, cover of each verified span, in order).
    ``templates`` lists (label, text); texts of fewer than K words are refused.

    Null and empty texts have no words and no labels. Identical repeated rows are one document; rows of one id with
    different texts give a row each. A null id is a document as any other. An empty table gives no rows.
    """
    spark = docs.sparkSession
    cut = [template_words(t) for _, t in templates]
    short = [label for (label, _), c in zip(templates, cut) if len(c) < K]
    if short:
        raise ValueError(f"templates of fewer than {K} words: {short}")
    w, pos = F.col("words"), F.col("pos")
    sizes = sorted({K, *(len(p.split()) for p in BASE)})
    grams = (doc_text(docs).select("doc_id", F.xxhash64("text").alias("version"), ascii_words(F.col("text")).alias("words"))
             .select("doc_id", "version", "words", F.posexplode_outer("words").alias("pos", "word"))
             .select("doc_id", "version", F.size("words").alias("n_words"), "pos",
                     F.posexplode(F.array(*(hash_at(w, pos, tuple(range(k)), k) for k in sizes))).alias("i", "gram")))
    # One row marks each document, so that one pass over the texts gives the hits and the documents without any.
    hits = (grams.join(_templates(spark, cut), "gram", "left")
            .filter(F.col("template").isNotNull() | ((F.coalesce("pos", F.lit(0)) == 0) & (F.col("i") == 0)))
            .select("doc_id", "version", "n_words", "pos", "template", "at").distinct())
    hits = stored(hits, "license-hits")
    doc = ["doc_id", "version"]

    base_label = F.lit(None).cast("string")
    for i, label in enumerate(BASE.values()):
        base_label = F.when(F.col("template") == -i - 1, F.lit(label)).otherwise(base_label)
    is_base = F.col("template") < 0
    base = hits.groupBy(*doc).agg(
        F.max("n_words").cast("long").alias("n_words"), F.count_if(is_base).alias("n_base"),
        F.min(F.when(is_base, pos)).cast("long").alias("first_word"), F.max(F.when(is_base, pos)).cast("long").alias("last_word"),
        F.collect_set(base_label).alias("base"))

    # The gram's K bits in each part that it touches (one, or two at a border).
    inside = F.col("at") - F.col("part") * PART
    bits = F.when(inside >= 0, F.expr(f"shiftleft({2 ** K - 1}L, at - part * {PART}) & {2 ** PART - 1}L")).otherwise(
        F.expr(f"shiftright({2 ** K - 1}L, part * {PART} - at)"))
    votes = (hits.filter(F.col("template") >= 0).withColumn("diagonal", pos - F.col("at"))
             .withColumn("part", F.explode(F.expr(f"sequence(int(at div {PART}), int((at + {K - 1}) div {PART}))")))
             .withColumn("bits", bits).groupBy(*doc, "template", "diagonal", "part")
             .agg(F.bit_or("bits").alias("covered"), F.min("pos").alias("lo"), (F.max("pos") + K - 1).alias("hi")))
    by = W.partitionBy(*doc, "template").orderBy("diagonal", "part")
    new = F.when(F.col("diagonal") - F.lag("diagonal").over(by) <= SLIP, 0).otherwise(1)
    spans = (votes.withColumn("new", new).withColumn("span", F.sum("new").over(by))
             .groupBy(*doc, "template", "span", "part")
             .agg(F.bit_count(F.bit_or("covered")).alias("n_covered"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
             .groupBy(*doc, "template", "span")
             .agg(F.sum("n_covered").alias("n_covered"), F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    size = F.element_at(F.array(*(F.lit(len(c)) for c in cut)), F.col("template") + 1)
    label = F.element_at(F.array(*(F.lit(name) for name, _ in templates)), F.col("template") + 1)
    spans = spans.withColumn("cover", F.col("n_covered") / size).withColumn("label", label)
    good = F.col("cover") >= COVER
    # Of a label's spans only the places are listed; their number grows with the text alone.
    found = spans.groupBy(*doc).agg(
        F.max("cover").alias("cover"), F.collect_set(F.when(good, F.col("label"))).alias("more"),
        F.sort_array(F.collect_list(F.when(good, F.struct(F.col("lo").alias("first"), F.col("hi").alias("last"), "label", "cover")))).alias("spans"))
    joined = base.join(found, (base["doc_id"].eqNullSafe(found["doc_id"])) & (base["version"] == found["version"]), "left").select(
        base["*"], "cover", "more", "spans")
    none = F.array().cast("array<string>")
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.sort_array("base"), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("base", F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("cover", F.lit(0.0))).alias("score"),
        F.coalesce("spans", F.array().cast("array<struct<first:int,last:int,label:string,cover:double>>")).alias("spans"))
