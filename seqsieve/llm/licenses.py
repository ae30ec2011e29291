"""Operator 8, license scans: diagonal voting on word trigrams, with DataFrame functions only.

Every rolling three-word hash of every text is joined to the templates' positions (a fixed small table, so it is
broadcast); the words themselves are compared too, so a hit is exact. Hits of one template vote for the diagonal
word position - template position. Neighbouring diagonals (at most MERGE apart, where words were put in or left out)
are merged, and a merged span is verified: it must hold at least COVERAGE of the template's trigrams within STRETCH
times its length. A base phrase stands consecutively where one diagonal holds all of its trigrams.

A-Z become lower case, no other letter does, and words are the runs of digits, letters and non-ASCII characters.

Edge cases: null and empty texts have no words, no place and score 0; repeated rows get the same result each; a null
id is kept as such; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K, MERGE, COVERAGE, STRETCH = 3, 2, 0.8, 1.5
#: Fixed value: what separates words.
GAPS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
NO_ID = -(2**63)

#: The base phrases and their labels.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]
#: Sentences and paragraphs of licenses and notices, with the method's labels. Names that differ from another's
#: by one word or number are so short that a text must hold them whole.
TEMPLATES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache-2"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("gnu general public license version 2", "gpl-2"),
    ("gnu general public license version 3", "gpl-3"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("creative commons attribution 4 0 international", "cc-by"),
    ("creative commons attribution sharealike 4 0 international", "cc-by-sa"),
    ("creative commons attribution noncommercial 4 0 international", "cc-by-nc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction "
        "including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished "
        "to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
        "mit",
    ),
    (
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright "
        "notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
        "bsd",
    ),
    ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "bsd-3"),
    (
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express "
        "or implied see the license for the specific language governing permissions and limitations under the license",
        "apache-2",
    ),
    (
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu "
        "general public license for more details",
        "gpl",
    ),
    (
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted "
        "to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely",
        "zlib",
    ),
    ("anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means", "unlicense"),
    ("to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "cc0"),
]


#: The letters that become lower case.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_array(text):
    """The words of a text column; a null has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAPS), "")


def template_grams(spark: SparkSession, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """A row for each template position: its trigram, the template's number of trigrams, label, and if it is a base phrase."""
    rows = []
    for number, (text, label) in enumerate([*phrases, *templates]):
        words = text.split()
        n = len(words) - K + 1
        rows += [(number, label, number < len(phrases), n, at, *words[at : at + K]) for at in range(n)]
    table = spark.createDataFrame(rows, "template int, label string, base boolean, n_grams int, t_pos int, a string, b string, c string")
    return table.withColumn("gram", F.xxhash64("a", "b", "c"))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """key and mark tell a row by id and text, nulls too; rows alike in both are one key."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("key"),
        F.xxhash64(text_col).alias("mark"),
        F.col(text_col).alias("text"),
    )


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Verified spans: key, mark, template, label, base (the phrase stands there word by word), start and end word,
    and the coverage of the template."""
    rows = keyed(docs, id_col, text_col).select("key", "mark", word_array(F.col("text")).alias("words"))
    rows = rows.filter(F.size("words") >= K)
    rows = rows.select("key", "mark", "words", F.explode(F.sequence(F.lit(0), F.size("words") - K)).alias("pos"))
    word = lambda i: F.col("words")[F.col("pos") + i]
    rows = rows.withColumn("gram", F.xxhash64(word(0), word(1), word(2)))
    grams = F.broadcast(template_grams(docs.sparkSession))  # a fixed table of some hundred rows
    same = (rows["gram"] == grams["gram"]) & (word(0) == F.col("a")) & (word(1) == F.col("b")) & (word(2) == F.col("c"))
    hits = rows.join(grams, same).select("key", "mark", "template", "label", "base", "n_grams", "t_pos", (F.col("pos") - F.col("t_pos")).alias("diagonal"))
    votes = hits.groupBy("key", "mark", "template", "label", "base", "n_grams", "diagonal").agg(F.collect_set("t_pos").alias("held"))
    order = Window.partitionBy("key", "mark", "template").orderBy("diagonal")
    votes = votes.withColumn("new", F.coalesce((F.col("diagonal") - F.lag("diagonal").over(order) > MERGE).cast("int"), F.lit(1)))
    votes = votes.withColumn("part", F.sum("new").over(order))
    whole = F.size("held") == F.col("n_grams")
    merged = votes.groupBy("key", "mark", "template", "label", "n_grams", "part").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("held")))).alias("n_held"),
        F.min(F.col("diagonal") + F.array_min("held")).alias("first"),
        F.max(F.col("diagonal") + F.array_max("held") + K).alias("last"),
        F.array_sort(F.collect_list(F.when(F.col("base") & whole, F.col("diagonal")))).alias("places"),
    )
    coverage = F.col("n_held") / F.col("n_grams")
    fits = (coverage >= COVERAGE) & (F.col("last") - F.col("first") <= STRETCH * (F.col("n_grams") + K - 1))
    merged = merged.withColumn("coverage", coverage).withColumn("verified", fits)
    return merged.filter("verified or size(places) > 0")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score for every row of docs."""
    found = spans(docs, id_col, text_col)
    has = F.size("places") > 0
    joined = lambda c: F.concat_ws(",", F.array_sort(F.collect_set(c)))
    by_row = found.groupBy("key", "mark").agg(
        F.sum(F.size("places")).alias("n_base"),
        F.min(F.array_min("places")).alias("first_word"),
        F.max(F.array_max("places")).alias("last_word"),
        joined(F.when(has, F.col("label"))).alias("base_labels"),
        joined(F.col("label")).alias("labels"),
        F.max(F.when(has, F.lit(1.0)).otherwise(F.col("coverage"))).alias("score"),
    )
    rows = keyed(docs, id_col, text_col).select("doc_id", "key", "mark", F.size(word_array(F.col("text"))).cast("long").alias("n_words"))
    return rows.join(by_row, ["key", "mark"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce(F.col("n_base").cast("long"), F.lit(0).cast("long")).alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
