"""License notices found by diagonal voting, with DataFrame functions only.

Templates are short texts with a label. All rolling three-word hashes of all documents are joined
to the hashes of the templates; the hash finds a partner, the words themselves confirm it. A match
of a document's place with a template's place votes for the diagonal (document place less
template place). The votes of a diagonal are summed; diagonals of one template are put in order,
and neighbours at most ``gap`` apart belong together, as words put in or left out move a notice to
a neighbouring diagonal (votes elsewhere do not come between them). Of those, every window of
diagonals as wide as the template is verified by the share of the template's words that its votes
cover (each word once) and by the words that tell the template from other licenses, which have to
stand consecutively; verified windows that overlap in the text are one span.

Base phrases are templates that count only if all of their words stand consecutively.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K = 3
#: Diagonals of one notice may differ by so many words put in or left out between two of them.
GAP = 4
#: Share of a template's words that must be covered.
LEAST_COVER = 0.75
#: Notices of fewer words without a telling phrase must be there whole.
LEAST_LOOSE_WORDS = 16
#: Words that tell licenses apart: they stand consecutively wherever a notice that has them does.
TELLING = (
    "mit", "apache license version 2", "gnu general public license version 3",
    "gnu general public license version 2", "gnu general public license",
    "gnu lesser general public license", "mozilla public license v 2",
    "creative commons attribution 4 0", "creative commons attribution sharealike 4 0",
    "creative commons attribution noncommercial 4 0", "cc by nc 4", "cc by sa 4", "unencumbered",
)

#: Base phrases and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

#: Openings and body paragraphs of public license notices and their labels.
NOTICES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software "
     "and associated documentation files to deal in the software without restriction", "mit"),
    ("released under the mit license", "mit"),
    ("licensed under the apache license version 2 0 you may not use this file except in "
     "compliance with the license", "apache-2"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("this program is free software you can redistribute it and or modify it under the terms of "
     "the gnu general public license as published by the free software foundation", "gpl"),
    ("licensed under the gnu general public license version 3", "gpl-3"),
    ("licensed under the gnu general public license version 2", "gpl-2"),
    ("gnu lesser general public license as published by the free software foundation", "lgpl"),
    ("redistribution and use in source and binary forms with or without modification are "
     "permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0",
     "mpl-2"),
    ("this work is licensed under a creative commons attribution 4 0 international license",
     "cc-by"),
    ("this work is licensed under a creative commons attribution sharealike 4 0 international "
     "license", "cc-by-sa"),
    ("this work is licensed under a creative commons attribution noncommercial 4 0 international "
     "license", "cc-by-nc"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("permission to use copy modify and or distribute this software for any purpose with or "
     "without fee is hereby granted", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("the above copyright notice and this permission notice shall be included in all copies or "
     "substantial portions of the software", "mit"),
    ("the software is provided as is without warranty of any kind express or implied including "
     "but not limited to the warranties of merchantability fitness for a particular purpose and "
     "noninfringement", "mit"),
    ("unless required by applicable law or agreed to in writing software distributed under the "
     "license is distributed on an as is basis without warranties or conditions of any kind "
     "either express or implied", "apache-2"),
    ("redistributions of source code must retain the above copyright notice this list of "
     "conditions and the following disclaimer", "bsd"),
    ("redistributions in binary form must reproduce the above copyright notice this list of "
     "conditions and the following disclaimer in the documentation and or other materials "
     "provided with the distribution", "bsd"),
    ("neither the name of the copyright holder nor the names of its contributors may be used to "
     "endorse or promote products derived from this software without specific prior written "
     "permission", "bsd-3"),
    ("this program is distributed in the hope that it will be useful but without any warranty "
     "without even the implied warranty of merchantability or fitness for a particular purpose",
     "gpl"),
    ("if a copy of the mpl was not distributed with this file you can obtain one at", "mpl-2"),
    ("the software is provided as is and the author disclaims all warranties with regard to this "
     "software including all implied warranties of merchantability and fitness", "isc"),
    ("anyone is free to copy modify publish use compile sell or distribute this software either "
     "in source code form or as a compiled binary for any purpose commercial or non commercial "
     "and by any means", "unlicense"),
)


@dataclass(frozen=True)
class Template:
    number: int
    label: str
    words: tuple[str, ...]
    base: bool

    @property
    def telling(self) -> tuple[int, int]:
        """First and last place of the words that must stand consecutively; (0, -1) for none."""
        held = [p.split() for p in TELLING]
        found = [(len(p), i) for p in held for i in range(len(self.words) - len(p) + 1)
                 if list(self.words[i:i + len(p)]) == p]
        if found:
            size, at = max(found)
            return at, at + size - 1
        return (0, -1) if len(self.words) >= LEAST_LOOSE_WORDS else (0, len(self.words) - 1)


def templates(phrases=PHRASES, notices=NOTICES) -> list[Template]:
    """The base phrases and the notices; all need at least three words."""
    listed = [(p, label, True) for p, label in phrases] + [(n, c, False) for n, c in notices]
    made = [Template(i, label, tuple(text.split()), base)
            for i, (text, label, base) in enumerate(listed)]
    if any(len(t.words) < K for t in made):
        raise ValueError(f"a template needs at least {K} words")
    return made


def words_of(text: Column) -> Column:
    """Words of digits, letters and everything beyond ASCII; A-Z in lower case."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _literal_rows(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """The rows as constants of the plan."""
    structs = [F.struct(*(F.lit(v).alias(n) for n, v in zip(names, row, strict=True)))
               for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def _template_places(spark: SparkSession, listed: list[Template]) -> DataFrame:
    """One row per place of each template, with the three words there and their hash. Its size
    is that of the templates, whatever the documents."""
    rows = [(t.number, i, *t.words[i:i + K])
            for t in listed for i in range(len(t.words) - K + 1)]
    places = _literal_rows(spark, ["template", "at", "a", "b", "c"], rows)
    return places.withColumn("hash", F.xxhash64("a", "b", "c"))


def votes(docs: DataFrame, listed: list[Template]) -> DataFrame:
    """``_llm_key``, ``_llm_digest``, ``template``, ``place`` (in the document) and ``diagonal``:
    the places where three words of a document are those of a template."""
    spark = docs.sparkSession
    # A row per place has its own three words only, so the work follows the length of the text.
    grams = F.when(F.size("words") >= K, F.transform(
        F.sequence(F.lit(0), F.size("words") - K),
        lambda i: F.struct(F.get("words", i).alias("a"), F.get("words", i + 1).alias("b"),
                           F.get("words", i + 2).alias("c"))))
    placed = docs.select("_llm_key", "_llm_digest", F.posexplode(grams).alias("place", "gram"))
    hashed = placed.withColumn("hash", F.xxhash64("gram.a", "gram.b", "gram.c"))
    return (hashed.join(F.broadcast(_template_places(spark, listed)), "hash")
            .filter((F.col("gram.a") == F.col("a")) & (F.col("gram.b") == F.col("b"))
                    & (F.col("gram.c") == F.col("c")))
            .select("_llm_key", "_llm_digest", "template", "place",
                    (F.col("place") - F.col("at")).alias("diagonal"))
            # Rows with equal key and text vote alike; each place counts once.
            .distinct())


def spans(voted: DataFrame, listed: list[Template], gap: int = GAP) -> DataFrame:
    """Per document and template the verified spans: ``first`` and ``last`` word, ``cover``."""
    spark = voted.sparkSession
    about = _literal_rows(spark, ["template", "label", "base", "n", "tell_first", "tell_last"],
                          [(t.number, t.label, t.base, len(t.words), *t.telling) for t in listed])
    row = ["_llm_key", "_llm_digest", "template"]
    diagonals = voted.groupBy(*row, "diagonal").agg(
        F.min("place").alias("first"), (F.max("place") + K - 1).alias("last"),
        F.count(F.lit(1)).alias("votes"),
        # Template places that votes cover; a diagonal has no more of them than the template.
        F.array_distinct(F.flatten(F.collect_list(F.sequence(
            F.col("place") - F.col("diagonal"), F.col("place") - F.col("diagonal") + K - 1))))
        .alias("covers"),
    ).join(F.broadcast(about), "template")
    # A base phrase is whole on a single diagonal; it has no neighbours.
    whole = diagonals.filter(f"base AND votes = n - {K - 1}").select(
        *row, "label", "base", "first", "last", F.lit(1.0).alias("cover"))
    # On one diagonal, words that are consecutive in the template are so in the document.
    told = (F.col("tell_last") < F.col("tell_first")) | (F.size(F.array_except(
        F.sequence("tell_first", F.greatest("tell_first", "tell_last")), "covers")) == 0)
    own = Window.partitionBy(*row).orderBy("diagonal")
    is_new = F.col("diagonal") - F.lag("diagonal", 1).over(own) > gap
    # Diagonals less than the template's length apart, so at most twice that many words.
    wide = (Window.partitionBy(*row, "_band").orderBy(F.col("diagonal") / F.col("n"))
            .rangeBetween(0, 1))
    windows = (diagonals.filter("NOT base").withColumn("told", told)
               .withColumn("_new", F.coalesce(is_new, F.lit(False)).cast("int"))
               .withColumn("_band", F.sum("_new").over(own))
               .select(*row, "label", "base", "n", F.col("diagonal"),
                       F.min("first").over(wide).alias("first"),
                       F.max("last").over(wide).alias("last"),
                       F.max("told").over(wide).alias("told"),
                       F.size(F.array_distinct(F.flatten(F.collect_list("covers").over(wide))))
                       .alias("covered")))
    cover = F.least(F.col("covered"), F.col("last") - F.col("first") + 1) / F.col("n")
    by_place = Window.partitionBy(*row).orderBy("first", "diagonal")
    reach = F.max("last").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    merged = (windows.withColumn("cover", cover)
              .filter((F.col("cover") >= LEAST_COVER) & F.col("told"))
              .withColumn("_new", F.coalesce(F.col("first") > reach, F.lit(True)).cast("int"))
              .withColumn("_span", F.sum("_new").over(by_place))
              .groupBy(*row, "label", "base", "_span").agg(
                  F.min("first").alias("first"), F.max("last").alias("last"),
                  F.max("cover").alias("cover")))
    return whole.unionByName(merged.select(*row, "label", "base", "first", "last", "cover"))


def scan_licenses(docs: DataFrame, phrases=PHRASES, notices=NOTICES, key: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``n_words``, ``license_spans`` (array of label, base,
    first, last, cover) and ``score``, the largest cover (0 without spans).

    A null text is an empty one. Rows are told apart by key and text: equal rows get the same
    result, rows with one key and different texts get their own. Texts of fewer than three words
    have no spans. The spans of a text are gathered in its row, so they are bounded by it.
    """
    clash = {"n_words", "license_spans", "score"} & set(docs.columns)
    if clash:
        raise ValueError(f"columns with these names are added here: {sorted(clash)}")
    listed = templates(phrases, notices)
    whole = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.withColumns({"_llm_key": F.col(key), "_llm_digest": F.xxhash64(
        whole, F.length(whole)), "words": words_of(whole)})
    found = spans(votes(keyed.select("_llm_key", "_llm_digest", "words"), listed), listed)
    gathered = found.groupBy("_llm_key", "_llm_digest").agg(F.array_sort(F.collect_list(
        F.struct("first", "last", "label", "base", "cover"))).alias("license_spans"))
    gathered = gathered.select(F.col("_llm_key").alias("_llm_k"),
                               F.col("_llm_digest").alias("_llm_d"), "license_spans")
    own = keyed.withColumn("n_words", F.size("words").cast("bigint")).drop("words")
    return (own.join(gathered, own["_llm_key"].eqNullSafe(gathered["_llm_k"])
                     & (own["_llm_digest"] == gathered["_llm_d"]), "left")
            .withColumn("license_spans", F.coalesce("license_spans", F.array()))
            .withColumn("score", F.coalesce(F.array_max(F.transform(
                "license_spans", lambda s: s["cover"])), F.lit(0.0)))
            .select(*docs.columns, "n_words", "license_spans", "score"))


def license_digest(docs: DataFrame) -> DataFrame:
    """Counts, places and labels per document, from its spans."""
    scanned = scan_licenses(docs.select("doc_id", "text")).drop("text")
    base = F.filter("license_spans", lambda s: s["base"])
    starts = F.transform(base, lambda s: s["first"].cast("bigint"))

    def labels(found: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(
            F.transform(found, lambda s: s["label"]))), ",")

    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("license_spans")).alias("labels"),
        "score")
