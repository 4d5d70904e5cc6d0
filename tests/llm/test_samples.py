"""Samples that models are fitted on hold distinct texts and vectors, whatever copies there are."""

import numpy as np
from pyspark.sql import functions as F

from leksika.llm import additive, language


def test_copied_texts_teach_once(spark):
    """12 texts of 1,000 rows each: thinning by rows left a language without texts, or one text in all places."""
    rows = spark.range(12000).select(F.concat(F.lit("wort"), F.col("id") % 12, F.lit(" und der "), F.col("id") % 12).alias("text"), F.lit("de").alias("lang"))
    seen = []
    real, language.TextModel.of_counts = language.TextModel.of_counts, lambda languages, counts: seen.append((languages, counts.sum()))
    try:
        language.learn_text(rows, "text", "lang", 8)
        language.learn_text(rows.distinct(), "text", "lang", 8)
    finally:
        language.TextModel.of_counts = real
    assert seen[0] == seen[1] == (["de"], 8 * 10)  # eight texts of three words: 3 + 3 + 4 trigrams


def test_copied_vectors_train_whole_codebooks(spark):
    """60 vectors of 200 rows each, a sample of 50: thinning by rows left one or two of them."""
    x = np.random.default_rng(2).normal(size=(60, 8))
    few = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    books = additive.train(few.crossJoin(spark.range(200).select(F.col("id").alias("copy"))), 50)
    assert books.shape == (additive.BOOKS, 50, 8)
