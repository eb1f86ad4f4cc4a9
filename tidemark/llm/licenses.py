"""License texts and phrases in documents, by diagonal voting of word grams."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Query, columns_of, own_names, settled, table

LEAST_SHARE = 0.8  # of words that a span has in common with its template
REACH = 4  # words that may be put in or left out between two neighbouring diagonals
LONG_GRAM, SHORT_GRAM = 5, 2
SHORT = 8  # templates of fewer words must stand word for word
BLOCK = 4096  # words of a text that are cut into grams at a time
MOST_LETTERS = 1 << 22  # of all templates together, up to which they are sent to every executor

# The phrases and labels that must be found.
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)

# Names of licenses, and the notices that their authors ask users to reproduce.
NOTICES = (
    ("agpl", "gnu affero general public license"),
    ("apache-2.0", "apache license version 2 0"),
    ("apache-2.0", "spdx license identifier apache 2 0"),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or
        agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF
        ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("bsd", "bsd license"),
    ("bsd-2-clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
        following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
        following disclaimer in the documentation and/or other materials provided with the distribution."""),
    ("bsd-3-clause", """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
        derived from this software without specific prior written permission."""),
    ("cc-by-4.0", "cc by 4 0"),
    ("cc-by-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "cc by nc"),
    ("cc-by-nc-nd", "cc by nc nd"),
    ("cc-by-nc-sa", "cc by nc sa"),
    ("cc-by-nd", "cc by nd"),
    ("cc-by-sa", "cc by sa"),
    ("cc0", "cc0 1 0"),
    ("gpl-2.0", "gnu general public license version 2"),
    ("gpl-3.0", "gnu general public license version 3"),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is
        distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
        FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    ("isc", "isc license"),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
        that the above copyright notice and this permission notice appear in all copies."""),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "spdx license identifier mit"),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
        (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do
        so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software."""),
    ("mpl-2.0", "mozilla public license"),
    ("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
        with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
        compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
        non-commercial, and by any means."""),
)


@dataclass(frozen=True)
class Template:
    """A text to look for. `base` ones are the phrases that are counted by their places."""

    label: str
    text: str
    base: bool = False


TEMPLATES = tuple(Template(label, text, True) for label, text in PHRASES) + tuple(Template(label, text) for label, text in NOTICES)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of a text, A-Z lower-cased; none for null."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BETWEEN), "")


def _key(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


_FIELDS = [f"w{i}" for i in range(LONG_GRAM)]


def _rolling(df: DataFrame, listed: str, *others: str) -> DataFrame:
    """`others`, `at`, and the words `w0` to `w4` of every rolling gram of a list; null beyond its end."""
    shifted = F.arrays_zip(*[(F.col(listed) if i == 0 else F.slice(listed, i + 1, BLOCK + LONG_GRAM)).alias(f) for i, f in enumerate(_FIELDS)])
    rolled = df.select(*others, F.posexplode(shifted).alias("at", "g"))
    return rolled.select(*others, "at", *[F.col("g").getField(f).alias(f) for f in _FIELDS])


def _hash(size: int) -> Column:
    return F.xxhash64(*_FIELDS[:size])


def _template_words(templates: tuple[Template, ...], spark: SparkSession) -> DataFrame:
    """`(template, label, base, words, n, size)`, by the expressions that documents go through."""
    rows = [F.struct(F.lit(i).alias("template"), F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), F.lit(t.text).alias("text")) for i, t in enumerate(templates)]
    listed = spark.range(1).select(F.inline(F.array(*rows))).select("template", "label", "base", words(F.col("text")).alias("words"))
    n = F.size("words")
    return listed.filter(n >= SHORT_GRAM).select(
        "*", n.alias("n"), F.when(F.col("base") | (n < SHORT), SHORT_GRAM).otherwise(LONG_GRAM).alias("size")
    )


def _sent(df: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    return F.broadcast(df) if sum(len(t.text) for t in templates) <= MOST_LETTERS else df


def spans(docs: DataFrame, text: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """`(text_key binary, template, label, base, first_word, n_words, score)`: the places of templates in each different text.

    `text_key` is the SHA-256 of the text (null as the empty one), so texts alike are searched once each but told once.
    Every rolling gram of five words (of two, for templates that must stand word for word) is joined by its hash to the places
    of grams in templates, and compared word by word where hashes meet. Hits vote for the diagonal `place in text - place in template`. Neighbouring
    diagonals at most `REACH` apart are merged, so that words put in or left out do not end a span. A span's `score` is the
    share of words in common: those of the template that were hit, of the longer of span and template. Spans of short
    templates and base phrases need a share of 1 on one diagonal; all others are told with their score, whatever it is.
    Templates under two words are never found. A very long text is cut into grams block by block.

    Counts per diagonal are made inside each task first, and a group is never larger than what one text hits.
    """
    spark = docs.sparkSession
    known = _template_words(templates, spark)
    exact = (F.col("base") | (F.col("n") < SHORT)).alias("exact")
    rolled = _rolling(known, "words", "template", "base", "n", "size").filter(F.col("at") <= F.col("n") - F.col("size"))
    place = F.struct("template", exact, F.col("at").alias("place"), F.slice(F.array(*_FIELDS), 1, F.col("size")).alias("gram"))

    def known_grams(size: int) -> DataFrame:
        of = rolled.filter(F.col("size") == size).groupBy(_hash(size).alias(f"hash{size}")).agg(F.collect_list(place).alias(f"places{size}"))
        return _sent(of, templates)

    listed = docs.select(_key(F.col(f"`{text}`")).alias("text_key"), words(F.col(f"`{text}`")).alias("words"))
    block = lambda s: F.struct(s.alias("start"), F.slice("words", s + 1, BLOCK + LONG_GRAM - 1).alias("words"))
    blocks = F.when(F.size("words") >= SHORT_GRAM, F.transform(F.sequence(F.lit(0), F.size("words") - 1, F.lit(BLOCK)), block))
    cut = listed.select("text_key", F.explode(blocks).alias("b")).select("text_key", "b.start", "b.words")
    # Grams that begin in the overlap come again at the start of the next block: as places are gathered as sets, that changes nothing.
    grams = _rolling(cut, "words", "text_key", "start").withColumns({f"hash{k}": _hash(k) for k in (SHORT_GRAM, LONG_GRAM)})
    met = grams.join(known_grams(SHORT_GRAM), f"hash{SHORT_GRAM}", "left").join(known_grams(LONG_GRAM), f"hash{LONG_GRAM}", "left")
    lists = [F.coalesce(f"places{k}", F.array()) for k in (SHORT_GRAM, LONG_GRAM)]
    hits = met.filter(f"places{SHORT_GRAM} IS NOT NULL OR places{LONG_GRAM} IS NOT NULL").select(
        "text_key", (F.col("start") + F.col("at")).alias("at"), F.array(*_FIELDS).alias("gram"), F.explode(F.concat(*lists)).alias("p")
    ).filter(F.slice("gram", 1, F.size("p.gram")) == F.col("p.gram")).select("text_key", "at", "p.template", "p.exact", "p.place")
    votes = hits.groupBy("text_key", "template", "exact", (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.collect_set("place").alias("places"), F.min("at").alias("first"), F.max("at").alias("last")
    )
    along = Window.partitionBy("text_key", "template").orderBy("diagonal")
    apart = F.col("exact") | (F.col("diagonal") - F.lag("diagonal").over(along) > REACH)
    run = votes.withColumn("apart", F.coalesce(apart, F.lit(True)).cast("long")).withColumn("run", F.sum("apart").over(along))
    merged = run.groupBy("text_key", "template", "run").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.array_distinct(F.flatten(F.collect_list("places"))).alias("places")
    )
    info = _sent(known.select("template", "label", "base", "n", "size"), templates)
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + F.col("size") - 1)))))
    long = F.col("last") + F.col("size") - F.col("first")
    scored = merged.join(info, "template").select(
        "text_key", "template", "label", "base", F.col("first").cast("long").alias("first_word"), long.cast("long").alias("n_words"),
        (covered / F.greatest(long, F.col("n"))).alias("score"), (F.col("base") | (F.col("n") < SHORT)).alias("exact"),
    )
    return scored.filter(~F.col("exact") | (F.col("score") == 1.0)).drop("exact")


def scan(docs: DataFrame, text: str = "text", templates: tuple[Template, ...] = TEMPLATES, least: float = LEAST_SHARE) -> DataFrame:
    """`docs` with `licenses`: a struct of `n_words`, `n_base`, `first_word`, `last_word`, `base_labels`, `labels` and `score`.

    Base phrases are counted by their places (first and last word of a place's start, from 0; null if there is none). `labels`
    are those of base phrases and of all other spans with a share of at least `least`. `score` is the greatest share of any span, 0
    without one. Labels are distinct and sorted. A null text is an empty one: no words, no labels, score 0. Rows with a
    null id are kept, repeated rows get equal answers; a column `licenses` is replaced. An empty table gives no rows.

    One row for each text with hits is joined back by the text's SHA-256; a text that many rows share is a hot key of
    that join alone, which adaptive execution splits.
    """
    base = F.col("base")
    fine = base | (F.col("score") >= least)
    joined = lambda names: F.array_join(F.array_sort(F.collect_set(names)), ",")
    told = spans(docs, text, templates).groupBy("text_key").agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("first_word"))).alias("first_word"), F.max(F.when(base, F.col("first_word"))).alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"), joined(F.when(fine, F.col("label"))).alias("labels"), F.max("score").alias("score"),
    )
    given = docs.select(columns_of(docs, "licenses"))
    key, n, out = own_names(given, "_key", "_words", "_told")
    told = told.select(F.col("text_key").alias(key), F.struct("n_base", "first_word", "last_word", "base_labels", "labels", "score").alias(out))
    told = settled(told, "licenses-told")  # so that the join below stands by itself, and adaptive execution may split it
    met = given.withColumns({key: _key(F.col(f"`{text}`")), n: F.size(words(F.col(f"`{text}`"))).cast("long")}).join(told, key, "left")
    field = lambda name, default=None: F.coalesce(F.col(f"{out}.{name}"), F.lit(default)).alias(name)
    return met.select(*columns_of(given), F.struct(
        F.col(n).alias("n_words"), F.coalesce(F.col(f"{out}.n_base"), F.lit(0).cast("long")).alias("n_base"), F.col(f"{out}.first_word").alias("first_word"),
        F.col(f"{out}.last_word").alias("last_word"), field("base_labels", ""), field("labels", ""), field("score", 0.0),
    ).alias("licenses"))


def op12_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of all documents."""
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "licenses.*")


QUERIES: dict[str, Query] = {"op12_license_diagonals": op12_license_diagonals}


def _sql(templates: tuple[Template, ...] = TEMPLATES) -> str:
    def listed(column: str) -> str:
        return rf"regexp_extract_all(translate(coalesce({column}, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    values = ",\n  ".join(f"({i}, {quoted(t.label)}, {str(t.base).lower()}, {quoted(t.text)})" for i, t in enumerate(templates))
    return f"""WITH given(template, label, base, text) AS (VALUES
  {values}),
split_up AS (SELECT template, label, base, {listed("text")} AS w FROM given),
known AS MATERIALIZED (
  SELECT *, len(w) AS n, base OR len(w) < {SHORT} AS exact, CASE WHEN base OR len(w) < {SHORT} THEN {SHORT_GRAM} ELSE {LONG_GRAM} END AS size
  FROM split_up WHERE len(w) >= {SHORT_GRAM}),
starts AS (SELECT template, size, w, unnest(generate_series(0, n - size)) AS place FROM known),
places AS MATERIALIZED (SELECT template, size, place, array_to_string(w[place + 1:place + size], ' ') AS gram FROM starts),
doc_words AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {listed("text")} AS w FROM documents),
doc_starts AS (
  SELECT rid, w, size, unnest(generate_series(0, len(w) - size)) AS pos
  FROM doc_words CROSS JOIN (SELECT unnest([{SHORT_GRAM}, {LONG_GRAM}]) AS size)),
hits AS MATERIALIZED (
  SELECT d.rid, p.template, d.pos, p.place, d.pos - p.place AS diagonal
  FROM (SELECT rid, size, pos, array_to_string(w[pos + 1:pos + size], ' ') AS gram FROM doc_starts) d JOIN places p ON d.gram = p.gram AND d.size = p.size),
diagonals AS (SELECT DISTINCT rid, template, diagonal, exact FROM hits JOIN known USING (template)),
gaps AS (
  SELECT *, CASE WHEN exact THEN 1 WHEN diagonal - lag(diagonal) OVER (PARTITION BY rid, template ORDER BY diagonal) <= {REACH} THEN 0 ELSE 1 END AS apart
  FROM diagonals),
runs AS (SELECT rid, template, diagonal, sum(apart) OVER (PARTITION BY rid, template ORDER BY diagonal) AS run FROM gaps),
met AS MATERIALIZED (SELECT h.rid, h.template, r.run, h.pos, h.place FROM hits h JOIN runs r ON h.rid = r.rid AND h.template = r.template AND h.diagonal = r.diagonal),
covers AS (
  SELECT rid, template, run, count(DISTINCT p) AS covered FROM (
    SELECT m.rid, m.template, m.run, unnest(generate_series(m.place, m.place + k.size - 1)) AS p FROM met m JOIN known k ON m.template = k.template)
  GROUP BY 1, 2, 3),
ends AS (
  SELECT m.rid, m.template, m.run, min(m.pos) AS first_word, max(m.pos) + max(k.size) - min(m.pos) AS long
  FROM met m JOIN known k ON m.template = k.template GROUP BY 1, 2, 3),
spans AS (
  SELECT e.rid, k.label, k.base, e.first_word, c.covered::DOUBLE / greatest(e.long, k.n) AS score
  FROM ends e JOIN covers c ON e.rid = c.rid AND e.template = c.template AND e.run = c.run JOIN known k ON e.template = k.template
  WHERE NOT k.exact OR (c.covered = k.n AND e.long = k.n)),
told AS (
  SELECT rid, sum(CASE WHEN base THEN 1 ELSE 0 END)::BIGINT AS n_base, min(CASE WHEN base THEN first_word END) AS first_word,
    max(CASE WHEN base THEN first_word END) AS last_word, max(score) AS score FROM spans GROUP BY 1),
base_names AS (SELECT rid, string_agg(label, ',' ORDER BY label) AS base_labels FROM (SELECT DISTINCT rid, label FROM spans WHERE base) GROUP BY 1),
names AS (SELECT rid, string_agg(label, ',' ORDER BY label) AS labels FROM (SELECT DISTINCT rid, label FROM spans WHERE base OR score >= {LEAST_SHARE}) GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(t.n_base, 0)::BIGINT AS n_base, t.first_word::BIGINT AS first_word, t.last_word::BIGINT AS last_word,
  coalesce(b.base_labels, '') AS base_labels, coalesce(l.labels, '') AS labels, coalesce(t.score, 0)::DOUBLE AS score
FROM doc_words d LEFT JOIN told t ON d.rid = t.rid LEFT JOIN base_names b ON d.rid = b.rid LEFT JOIN names l ON d.rid = l.rid"""


SQL: dict[str, str] = {"op12_license_diagonals": _sql()}
