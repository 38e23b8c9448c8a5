import random

from pyspark.sql import functions as F
from rows import DOCS, documents

from slotwise.llm.quality import BAD, GOOD, NOTHING, classify, estimate, keep_good, train

FOLDER = "/root/testdata/sf0.01"


def test_estimates_recover_planted_accuracies():
    rng = random.Random(3)
    accuracy = [0.95, 0.9, 0.8, 0.75, 0.9, 0.85, 0.7]
    counts = {}
    for _ in range(20_000):
        y = GOOD if rng.random() < 0.8 else BAD
        votes = tuple(NOTHING if rng.random() < 0.2 else y if rng.random() < a else 1 - y for a in accuracy)
        counts[votes] = counts.get(votes, 0) + 1
    model = estimate(sorted(counts.items()))
    assert abs(model.prior - 0.8) < 0.03
    for rates, a in zip(model.rates, accuracy):
        assert abs(rates[GOOD][GOOD] - a) < 0.03 and abs(rates[BAD][BAD] - a) < 0.05


def test_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = classify(docs).join(labels, "doc_id")
    good = found.where("quality = 1").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    bad = found.where("quality = 0").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert good >= 0.98 and bad <= 0.05


def test_empty_texts_repeats_and_tables(spark):
    docs = documents(spark, [None, "", " \n", "x", "x"]).withColumn("_score", F.lit("own"))
    rows = train(docs).transform(docs).collect()
    assert len(rows) == 5 and [r._keep for r in rows[:3]] == [False] * 3
    assert keep_good(docs.drop("_score")).columns == DOCS.replace(" long", "").replace(" string", "").split(", ")
    assert classify(spark.createDataFrame([], DOCS)).count() == 0
