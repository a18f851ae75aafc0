"""License scan by diagonal voting.

All rolling two-word grams of all texts are joined, by hash, to their positions in the templates. A match at word p of
a text and word q of a template votes for diagonal p - q. Votes are summed per text, template and diagonal as the set of
template words they cover; neighbouring diagonals (a word added or left out) are merged, and a span is verified when
enough of the template's words are covered. The words of a match are compared, so equal hashes alone never vote.

The templates are a parameter of some dozens of words, broadcast whatever the corpus is. A text is cut into words once;
its grams are exploded, looked up and dropped within one task, so only matches and one row a document are shuffled.

Defined cases: a null text is an empty one; a text without words has no spans; repeated rows are told apart by a row
number and give one result each; an empty table gives no rows. Extra columns are not read. A template needs 2 to 60
words.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendguard.llm.common import ascii_lower

#: Phrases that count where their words stand consecutively, and their labels.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

#: Notices that need not stand word for word.
NOTICES = [
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu", "gpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by-4.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl-2.0"),
    ("to the extent possible under law the author has waived all copyright", "cc0-1.0"),
]

#: What separates words, in a text whose letters are lower case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

COVERAGE = 0.8
REACH = 2
_END = "\x00end"


def template_grams(spark: SparkSession, base, notices) -> DataFrame:
    """``(gram, tid, base, n, label, q, a, b)``: every gram of every template; and one that marks the end of a text."""
    rows = []
    for tid, (phrase, label) in enumerate([*base, *notices]):
        words = phrase.split(" ")
        if not 2 <= len(words) <= 60:
            raise ValueError(f"a template needs 2 to 60 words: {phrase}")
        for q in range(len(words) - 1):
            exact = tid < len(base)
            rows.append(dict(tid=tid, base=exact, n=len(words), label=label, q=q, a=words[q], b=words[q + 1]))
    rows.append(dict(tid=-1, base=False, n=0, label="", q=0, a=_END, b=_END))
    schema = "array<struct<tid:int,base:boolean,n:int,label:string,q:int,a:string,b:string>>"
    grams = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), schema)))
    return grams.withColumn("gram", F.xxhash64("a", "b"))


def votes(docs: DataFrame, grams: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """Votes per row, template and diagonal: ``mask`` has a bit for each template word that is covered.

    Each row also has one vote for template -1, whose diagonal is its number of words.
    """
    cut = docs.select(
        F.col(id_).alias("doc_id"),
        F.monotonically_increasing_id().alias("_row"),
        F.array_remove(F.split(ascii_lower(F.coalesce(F.col(text), F.lit(""))), SEPARATORS), "").alias("_words"),
    )
    # The lambda sees two plain arrays: were a column computed inside it, it would be computed for every word.
    rolling = F.expr("zip_with(_words, slice(_words, 2, greatest(size(_words) - 1, 0)), (a, b) -> xxhash64(a, b))")
    # The last word has no successor; its gram makes way for the mark, at position n_words.
    inner = F.expr("slice(_rolling, 1, greatest(size(_words) - 1, 0))")
    hashed = cut.withColumn("_rolling", rolling).withColumn("_n", F.size("_words"))
    marked = hashed.select(
        "doc_id", "_row", "_words", "_n", F.concat(inner, F.array(F.xxhash64(F.lit(_END), F.lit(_END)))).alias("_grams")
    )
    placed = marked.select("doc_id", "_row", "_words", "_n", F.posexplode_outer("_grams").alias("_p", "gram"))
    found = placed.join(F.broadcast(grams), "gram")
    here, there = F.get("_words", F.col("_p")), F.get("_words", F.col("_p") + 1)
    same = (F.col("tid") >= 0) & (here == F.col("a")) & (there == F.col("b"))
    last = F.col("_p") == F.greatest(F.col("_n") - 1, F.lit(0))
    bits = F.call_function("shiftleft", F.lit(3).cast("long"), F.col("q"))
    found = found.select(
        "doc_id",
        "_row",
        "tid",
        "base",
        "n",
        "label",
        F.when(F.col("tid") < 0, F.col("_n")).otherwise(F.col("_p") - F.col("q")).alias("diagonal"),
        F.when(same, bits).when((F.col("tid") < 0) & last, F.lit(1).cast("long")).alias("bits"),
    )
    summed = found.groupBy("doc_id", "_row", "tid", "base", "n", "label", "diagonal")
    return summed.agg(F.bit_or("bits").alias("mask")).where("mask is not null")


def scan_licenses(docs: DataFrame, base=BASE, notices=NOTICES, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document.

    ``n_words``, ``n_base`` (places of base phrases), ``first_word`` and ``last_word`` (their smallest and largest
    start), ``base_labels``, ``labels`` (with those of verified notices) and ``score`` (largest share of a template's
    words that is covered in a verified span; 1 for a base phrase, 0 without a span).
    """
    grams = template_grams(docs.sparkSession, base, notices)
    near = Window.partitionBy("_row", "tid").orderBy("diagonal").rangeBetween(-REACH, REACH)
    merged = votes(docs, grams, id_, text).withColumn("merged", F.bit_or("mask").over(near))
    whole = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("n")) - 1
    placed = F.col("base") & (F.col("mask") == whole)
    covered = F.bit_count("merged") / F.col("n")
    verified = (F.col("tid") >= 0) & ~F.col("base") & (covered >= COVERAGE)
    start = F.when(placed, F.col("diagonal").cast("long"))

    def joined(which):
        return F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")

    return merged.groupBy("_row", F.col("doc_id")).agg(
        F.max(F.when(F.col("tid") < 0, F.col("diagonal"))).cast("long").alias("n_words"),
        F.count(start).alias("n_base"),
        F.min(start).alias("first_word"),
        F.max(start).alias("last_word"),
        joined(placed).alias("base_labels"),
        joined(placed | verified).alias("labels"),
        F.max(F.when(placed, F.lit(1.0)).when(verified, covered).otherwise(F.lit(0.0))).alias("score"),
    ).drop("_row")
