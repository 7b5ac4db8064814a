"""License scans by sentence rules.

Known license sentences have numbers. A text is cut into sentences, each is normalised (lower case, words only) and looked
up by hash; the numbers found, in order of place, are matched against the rules: ordered sequences of sentence numbers
that name a license. A rule matches sentences that follow each other among the recognised ones; of rules that begin at
the same sentence the longest wins, and a match inside a longer one is not reported.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Well-known sentences of public license texts and notices, and the rules over them.
SENTENCES = {
    1: "Released under the MIT License",
    2: "Licensed under the Apache License, Version 2.0",
    3: "This work is licensed under the GNU General Public License, version 3",
    4: "Licensed under CC BY-NC 4.0",
    5: "you may not use this file except in compliance with the License",
    6: "You may obtain a copy of the License at",
    7: "http://www.apache.org/licenses/LICENSE-2.0",
    8: "See the License for the specific language governing permissions and limitations under the License",
    9: "The above copyright notice and this permission notice shall be included in all copies or substantial portions"
    " of the Software",
    10: "Redistributions of source code must retain the above copyright notice, this list of conditions and the following"
    " disclaimer",
    11: "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the"
    " following disclaimer in the documentation and/or other materials provided with the distribution",
    12: "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
    " products derived from this software without specific prior written permission",
    13: "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
    " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any"
    " later version",
    14: "Licensed under the Apache License, Version 2.0 (the \"License\")",
    15: "This work is licensed under a Creative Commons Attribution 4.0 International License",
    16: "Licensed under CC BY 4.0",
    17: "Released under the BSD 3-Clause License",
    18: "All rights reserved",
}
RULES = [
    ("MIT", [1]), ("MIT", [9]), ("MIT", [1, 9]),
    ("Apache-2.0", [2]), ("Apache-2.0", [14]), ("Apache-2.0", [14, 5]), ("Apache-2.0", [14, 5, 6]),
    ("Apache-2.0", [14, 5, 6, 7]), ("Apache-2.0", [14, 5, 6, 7, 8]), ("Apache-2.0", [2, 5]),
    ("GPL-3.0-only", [3]), ("GPL-3.0-or-later", [13]),
    ("CC-BY-NC-4.0", [4]), ("CC-BY-4.0", [15]), ("CC-BY-4.0", [16]),
    ("BSD-2-Clause", [10, 11]), ("BSD-3-Clause", [10, 11, 12]), ("BSD-3-Clause", [17]),
    ("Proprietary", [18]),
]
BREAK = r"(?<=[.;!?])[ \t]+|[\r\n]+|(?<=\)),[ \t]*"


def normalised(sentence: F.Column) -> F.Column:
    """Lower case; runs of anything but letters and digits are one blank."""
    return F.trim(F.regexp_replace(F.lower(sentence), r"[^\p{L}\p{N}]+", " "))


def known_sentences(spark: SparkSession, sentences: dict[int, str] = SENTENCES) -> DataFrame:
    rows = spark.createDataFrame(pa.table({"sentence_id": pa.array(sentences, pa.int32()), "sentence": [*sentences.values()]}))
    return rows.select("sentence_id", normalised(F.col("sentence")).alias("sentence"))


def known_rules(spark: SparkSession, rules: list[tuple[str, list[int]]] = RULES) -> DataFrame:
    sequences = pa.array([sequence for _, sequence in rules], pa.list_(pa.int32()))
    return spark.createDataFrame(pa.table({"license": [name for name, _ in rules], "sequence": sequences}))


def recognised(docs: DataFrame, sentences: DataFrame) -> DataFrame:
    """(doc_id, row, place, sentence_id): the known sentences of every text; ``row`` tells repeated rows apart.

    ``sentences`` (sentence_id, sentence) is joined by equality; Spark knows its size and sends it to the tasks if it is
    small.
    """
    return (
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.monotonically_increasing_id().alias("row"),
            F.col("text").cast("string").alias("text"),
        )
        .select("doc_id", "row", F.posexplode(F.split("text", BREAK)).alias("place", "sentence"))
        .select("doc_id", "row", "place", normalised(F.col("sentence")).alias("sentence"))
        .where("sentence <> ''")
        .join(sentences, "sentence")
        .select("doc_id", "row", "place", "sentence_id")
    )


def licenses(docs: DataFrame, sentences: DataFrame, rules: DataFrame) -> DataFrame:
    """(doc_id, license, place, n_sentences, sentence_ids) for every rule matched in ``docs`` (doc_id, text).

    ``place`` is the number (from 0) of the first matched sentence of the text. Texts without known sentences, null
    and empty texts give no rows; repeated rows and null ids are reported one by one. Of rules of the same length that
    begin at the same sentence the first by license name is reported. Other columns are ignored. Empty tables of documents, sentences
    or rules give no rows.
    """
    found = recognised(docs, sentences)
    sequences = found.groupBy("doc_id", "row").agg(
        F.sort_array(F.collect_list(F.struct("place", "sentence_id"))).alias("known")
    )
    longest = rules.agg(F.coalesce(F.max(F.size("sequence")), F.lit(0)).alias("n")).first().n
    if not longest:
        return found.selectExpr("doc_id", "'' as license", "place", "1 as n_sentences", "'' as sentence_ids").limit(0)
    runs = sequences.select("doc_id", "row", "known", F.posexplode("known").alias("at", "first")).select(
        "doc_id",
        "row",
        "at",
        "first.place",
        F.explode(
            F.expr(
                f"""transform(sequence(1, least({longest}, size(known) - at)), n -> named_struct('n', n, 'ids',
                array_join(transform(slice(known, at + 1, n), x -> cast(x.sentence_id as string)), ',')))"""
            )
        ).alias("run"),
    )
    wanted = rules.select("license", F.array_join(F.transform("sequence", lambda x: x.cast("string")), ",").alias("ids"))
    matched = runs.select("doc_id", "row", "at", "place", "run.n", "run.ids").join(wanted, "ids")
    best = matched.groupBy("doc_id", "row", "at").agg(
        F.min_by(F.struct("license", "place", "n", "ids"), F.struct(-F.col("n"), F.col("license"))).alias("best")
    )
    before = Window.partitionBy("doc_id", "row").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    ended = best.select("doc_id", "row", "at", "best.*").withColumn("reach", F.max(F.col("at") + F.col("n")).over(before))
    return ended.where("reach is null or reach < at + n").select(
        "doc_id", "license", "place", F.col("n").alias("n_sentences"), F.col("ids").alias("sentence_ids")
    )
