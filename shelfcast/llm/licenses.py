"""Licence notices: a trained paragraph classifier confirmed by comparison with templates.

Paragraphs become sparse vectors of hashed words and word pairs; multinomial
logistic regression names a licence family, an unknown licence or none. Its
probabilities are calibrated by a temperature on rows kept out of the fit. A
prediction counts as confirmed when the paragraph holds enough of the word pairs
of one of the family's templates.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfcast.llm.tables import literal_table

#: Names under which the families are granted. Fixed values.
FAMILIES = {
    "Apache-2.0": ["the Apache License, Version 2.0", "the Apache License 2.0", "the Apache Software License version 2"],
    "MIT": ["the MIT License", "the MIT licence", "the Expat MIT License"],
    "BSD-3-Clause": ["the BSD 3-Clause License", "the three-clause BSD License", "the New BSD License"],
    "BSD-2-Clause": ["the BSD 2-Clause License", "the two-clause BSD License", "the Simplified BSD License"],
    "GPL-2.0": ["the GNU General Public License, version 2", "the GNU GPL v2", "the GPL version 2 or later"],
    "GPL-3.0": ["the GNU General Public License, version 3", "the GNU GPL v3", "the GPL version 3 or later"],
    "LGPL-2.1": ["the GNU Lesser General Public License, version 2.1", "the GNU LGPL v2.1", "the LGPL version 2.1"],
    "AGPL-3.0": ["the GNU Affero General Public License, version 3", "the GNU AGPL v3", "the AGPL version 3"],
    "MPL-2.0": ["the Mozilla Public License, version 2.0", "the Mozilla Public License 2.0", "the MPL 2.0"],
    "CC-BY-4.0": ["CC BY 4.0", "the Creative Commons Attribution 4.0 International License", "Creative Commons Attribution 4.0"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "the Creative Commons Attribution-ShareAlike 4.0 International License",
                     "Creative Commons Attribution-ShareAlike 4.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "the Creative Commons Attribution-NonCommercial 4.0 International License",
                     "Creative Commons Attribution-NonCommercial 4.0"],
    "CC0-1.0": ["CC0 1.0", "the Creative Commons CC0 1.0 Universal Public Domain Dedication", "CC0 1.0 Universal"],
    "Unlicense": ["the Unlicense", "the terms of the Unlicense", "the Unlicense into the public domain"],
}
#: Sentences that grant a licence; {} is its name. The last ones are kept out of the fit and calibrate it.
GRANTS = [
    "Licensed under {}.", "Released under {}.", "This work is licensed under {}.", "This program is distributed under {}.",
    "This file is subject to the terms of {}.", "You may use this software under the terms of {}.", "License: {}",
    "Copyright the authors. All files are made available under {}.", "Permission is granted under {}.",
    "Published under the terms and conditions of {}.", "The code is licensed under {}.", "See the LICENSE file, {}.",
]
CALIBRATION = ["This package is released under {}.", "The content is available under {}."]
#: Names of licences that belong to no family above.
OTHER = ["a proprietary license", "the vendor license agreement", "its own license", "a commercial licence",
         "the terms of the End User License", *[f"the {name} {kind} License, version {number}" for name, kind, number in (
             ("Acme", "Source", 1), ("Harbor", "Community", 3), ("Quill", "Internal", 5), ("Tundra", "Research", 6),
             ("Velvet", "Private", 9), ("Osprey", "Reader", 4), ("Granite", "Partner", 8))]]
#: More such names that only calibrate: what the fit has not seen keeps its probabilities modest.
OTHER_CALIBRATION = ["the Saffron Editor License, version 2", "a license of the publisher", "the Meridian Use License 12",
                     "the Cobalt Archive Licence", "the Juniper Field License, version 10", "site license terms"]
UNKNOWN, NONE = "unknown", "none"
TOKEN = r"[\p{L}\p{N}]+(?:\.[0-9]+)*"
FEATURES = 1 << 13
PIECE, STEP = 64, 48


@dataclass
class LicenseModel:
    classes: list[str]
    regression: LogisticRegressionModel
    temperature: float


def paragraphs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The lines of the texts in words; long lines in overlapping pieces, so none is cut off."""
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")
    words = F.regexp_extract_all(F.lower("line"), F.lit(TOKEN), F.lit(0))
    pieces = F.transform(F.sequence(F.lit(1), F.greatest(F.size("all") - (PIECE - STEP), F.lit(1)), F.lit(STEP)),
                         lambda at: F.slice("all", at, PIECE))
    return (df.select(F.col(id_col).alias("doc_id"), F.posexplode(lines).alias("paragraph", "line"))
            .select("doc_id", "paragraph", words.alias("all")).where(F.size("all") > 0)
            .select("doc_id", "paragraph", F.posexplode(pieces).alias("piece", "words")))


def pairs_of(words: Column) -> Column:
    return F.transform(F.slice(words, 1, F.size(words) - 1), lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1)))


def _vectors(rows: DataFrame) -> DataFrame:
    grams = F.when(F.size("words") > 1, F.concat("words", pairs_of(F.col("words")))).otherwise(F.col("words"))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features").transform(
        rows.withColumn("grams", grams))


def _notices(sentences: list[str], others: list[str]) -> list[tuple[str, str]]:
    named = [(family, s.format(name)) for family, names in FAMILIES.items() for name in names for s in sentences]
    return named + [(UNKNOWN, s.format(name)) for name in others for s in sentences]


def templates(spark: SparkSession) -> DataFrame:
    """The word pairs of every template, one row each; their number is fixed by the lists above."""
    rows = [(family, text) for family, names in FAMILIES.items() for text in names]
    words = F.regexp_extract_all(F.lower("text"), F.lit(TOKEN), F.lit(0))
    return (literal_table(spark, rows, "family string, text string").select("family", words.alias("words"))
            .select("family", F.when(F.size("words") > 1, pairs_of(F.col("words"))).otherwise(F.col("words")).alias("pairs")))


def train(df: DataFrame, text_col: str = "text", background_rows: int = 20_000) -> LicenseModel:
    """Fits the classifier on the notices and on at most ``background_rows`` other lines of the texts.

    The background is the bounded sample with the smallest hashes of all distinct lines
    that do not speak of a licence; a fifth of it calibrates.
    """
    spark = df.sparkSession
    schema = "name string, text string"
    words = F.regexp_extract_all(F.lower("text"), F.lit(TOKEN), F.lit(0)).alias("words")
    fitted = literal_table(spark, _notices(GRANTS, OTHER), schema).select("name", words, F.lit(False).alias("calibrates"))
    kept = literal_table(spark, _notices(CALIBRATION, OTHER_CALIBRATION), schema).select("name", words, F.lit(True).alias("calibrates"))
    spoken = (df.select(F.explode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("line"))
              .where(~F.col("line").rlike("(?i)licen[cs]")).select("line", F.xxhash64("line").alias("h")))
    # Of so many distinct lines, those below this hash are about four times the sample; only they are made distinct.
    distinct = spoken.agg(F.approx_count_distinct("h")).first()[0]
    share = min(1.0, 4.0 * background_rows / max(1, distinct))
    below = F.lit(min((1 << 63) - 1, int(-(1 << 63) + share * (1 << 64))))
    lines = spoken.where(F.col("h") <= below).distinct().orderBy("h", "line").limit(background_rows)
    plain = paragraphs(lines, "h", "line").select(
        F.lit(NONE).alias("name"), "words", (F.pmod("doc_id", F.lit(5)) == 0).alias("calibrates"))
    classes = [*FAMILIES, UNKNOWN, NONE]
    label = F.coalesce(*[F.when(F.col("name") == c, F.lit(float(i))) for i, c in enumerate(classes)])
    rows = _vectors(fitted.unionByName(kept).unionByName(plain)).select("features", "calibrates", label.alias("label")).coalesce(4).cache()
    missing = literal_table(spark, [("", NONE)], "text string, name string").select(words, "name")
    # Classes weigh alike, whatever their number of rows.
    counts = {r["label"]: r["count"] for r in rows.where("not calibrates").groupBy("label").count().collect()}
    weight = F.coalesce(*[F.when(F.col("label") == c, F.lit(100.0 / n)) for c, n in counts.items()], F.lit(1.0))
    regression = LogisticRegression(maxIter=40, regParam=3e-4, family="multinomial", weightCol="weight").fit(
        rows.where("not calibrates").select("features", "label", weight.alias("weight")).unionByName(
            # Words that no row has are no evidence of a notice: that case weighs as much as a class.
            _vectors(missing).select("features", F.lit(float(len(classes) - 1)).alias("label"), F.lit(100.0).alias("weight"))))
    raw = [(list(r["raw"]), int(r["label"])) for r in regression.transform(rows.where("calibrates")).select(
        vector_to_array("rawPrediction").alias("raw"), "label").collect()]
    rows.unpersist()
    return LicenseModel(classes, regression, _temperature(raw))


def _temperature(raw: list[tuple[list[float], int]]) -> float:
    """The scale of the margins that gives the kept-out rows the highest likelihood."""
    def loss(t: float) -> float:
        total = 0.0
        for margins, label in raw:
            top = max(margins)
            total += math.log(sum(math.exp((m - top) / t) for m in margins)) - (margins[label] - top) / t
        return total

    return min((2 ** (k / 4) for k in range(-8, 13)), key=loss) if raw else 1.0


def scan_licenses(df: DataFrame, model: LicenseModel, id_col: str = "doc_id", text_col: str = "text",
                  least: float = 0.5, containment: float = 0.6) -> DataFrame:
    """One row per paragraph that reads like a licence notice.

    doc_id, paragraph (line number from 0), piece, family, probability, similarity (the
    largest share of a template's word pairs found in the paragraph) and confirmed. A
    paragraph is reported when the calibrated probability of ``none`` is below
    ``least``; its family is the likeliest one, or ``unknown`` when no family reaches
    ``least`` or no template of it is contained to ``containment``. Null and empty texts
    have no paragraphs. Repeated rows and null ids are reported like any other, other
    columns are not read, an empty table gives no rows.
    """
    rows = _vectors(paragraphs(df, id_col, text_col))
    known = len(model.classes) - 2
    # The lambdas bind the margins and their exponentials once; named columns would be computed per use.
    heat = F.lit(model.temperature)
    powers = F.transform(F.array(vector_to_array("rawPrediction")), lambda raw: F.transform(
        F.array(F.array_max(raw)), lambda top: F.transform(raw, lambda m: F.exp((m - top) / heat))))
    shares = F.transform(F.flatten(powers), lambda e: F.transform(
        F.array(F.aggregate(e, F.lit(0.0), lambda a, b: a + b)), lambda total: F.transform(e, lambda x: x / total)))
    scored = (model.regression.transform(rows)
              .select("doc_id", "paragraph", "piece", "words", F.get(F.flatten(shares), F.lit(0)).alias("p"))
              .where(F.get("p", F.lit(known + 1)) < least))
    names = F.array(*[F.lit(c) for c in model.classes])
    top = F.array_max(F.slice("p", 1, known))
    guessed = scored.select("doc_id", "paragraph", "piece", "words", top.alias("probability"),
                            F.get(names, F.array_position(F.slice("p", 1, known), top).cast("int") - 1).alias("guess"))
    # Templates are few and fixed; they stand in the expression.
    by_family: dict[str, list[list[str]]] = {}
    for r in templates(df.sparkSession).collect():
        by_family.setdefault(r["family"], []).append(r["pairs"])
    pairs = F.when(F.size("words") > 1, pairs_of(F.col("words"))).otherwise(F.col("words"))
    held = F.lit(0.0)
    for family, wanted in by_family.items():
        best = F.greatest(*[F.size(F.array_intersect(F.array(*[F.lit(w) for w in t]), "pairs")) / F.lit(float(len(set(t))))
                            for t in wanted])
        held = F.when(F.col("guess") == family, best).otherwise(held)
    judged = guessed.withColumn("pairs", pairs).withColumn("similarity", held)
    sure = (F.col("probability") >= least) & (F.col("similarity") >= containment)
    return judged.select("doc_id", "paragraph", "piece", F.when(sure, F.col("guess")).otherwise(F.lit(UNKNOWN)).alias("family"),
                         "probability", "similarity", sure.alias("confirmed"))
