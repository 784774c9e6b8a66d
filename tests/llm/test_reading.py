import re

import numpy as np
from pyspark.sql import functions as F

from lumisift.llm import reading

EASY = "The cat saw a red hat. The boy had a new ball."
HARD = "The epistemological regularization of stochastic estimators precludes the hierarchical reification of posterior manifolds."


def words(text):
    """Words with one / for an end of a sentence or paragraph, or several in a row."""
    return re.sub(r"(/ ?)+", "/ ", " ".join(reading.prose_words(text)).replace("\n", "/")).strip()


def test_prose():
    assert words(None) == words("") == ""
    assert words("---\nid: A-1\ntopic: x\n---\n\n## 1. Heading\n\nThe cat sat. It ran!") == "the cat sat / it ran /"
    assert words("```\ncode here now\n```\nThe cat sat.") == "the cat sat /"
    assert words("WARNING step=4 reason=x file=y\n[12/40] a_001.png: bucket=FRONT\na_1,B,0.4,5,x\n| a | b |\n|---|---|\nThe cat sat.") == "the cat sat /"
    assert words("photo of qx1 person, close-up portrait, looking down, short hair") == ""
    assert words("low visibility, front, no face") == ""
    assert words("The\ncat sa-\nt here, and\nran.") == "the cat sat here and ran /"
    assert words("THE CAT SAW x_001.png TODAY.").split(" / ")[0].startswith("the cat saw")
    assert words("```\nnever closed\n\nThe cat sat.") == "the cat sat /"
    assert words("One.\n\n- Two sat.\n- Three ran.") == "one / two sat / three ran /"


def test_median_level():
    got = reading.median_level(np.array([1.0, 5.0, 2.0, 4.0]), np.array([10, 5, 3, 7]), np.array([0, 0, 2, 2]), 4)
    assert got[0] == 1.0 and np.isnan(got[1]) and got[2] == 4.0 and np.isnan(got[3])


def tables(spark, docs, labels):
    d = spark.createDataFrame(docs, "doc_id bigint, text string, lang string").withColumns({"level": F.lit(1), "words": F.lit("x"), "prose": F.lit(2)})
    return d, spark.createDataFrame(labels, "doc_id bigint, rater_id int, reading_level int, rated_at timestamp")


def test_small_corpus_with_dirt(spark):
    docs = [(i, EASY if i % 2 else HARD, "en") for i in range(40)] + [(100, None, None), (101, "", "en"), (102, "| a | b |", "de"), (103, (HARD + " ") * 3000, "xx"), (104, EASY + " " + HARD + " " + HARD, None), (None, EASY, "en"), (5, EASY, "en")]
    labels = [(i, 1, 1 if i % 2 else 5, None) for i in range(30)] + [(0, 1, None, None), (1, 2, 99, None), (None, 1, 3, None), (7777, 1, 3, None)]
    rows = reading.reading_levels(*tables(spark, docs, labels)).collect()
    assert len(rows) == len(docs)
    level = {r["doc_id"]: r["level"] for r in rows}
    assert level[100] is level[101] is level[102] is None
    assert level[39] < 2 and level[38] > 4 and level[103] > 4 and level[104] > 3.5


def test_runs_of_a_batch_give_the_same_features(monkeypatch):
    v = reading.Vocabulary([(w, {"en": 9 - i}) for i, w in enumerate("the cat sat hat epistemological".split())], ["en", "de"])
    texts = [EASY, None, HARD, "", EASY + " " + HARD] * 3
    whole = v.features(texts)
    monkeypatch.setattr(reading, "CHARACTERS", 60)
    for a, b in zip(whole, v.features(texts)):
        assert np.array_equal(a, b)
    assert v.features([])[0].shape == (0, len(reading.FEATURES))


def test_no_labels_and_empty(spark):
    d, none = tables(spark, [(1, EASY, "en")], [])
    assert [r["level"] for r in reading.reading_levels(d, none).collect()] == [None]
    d, none = tables(spark, [], [])
    assert reading.reading_levels(d, none).collect() == []


def test_label_levels(spark):
    _, labels = tables(spark, [], [])
    from datetime import datetime

    rows = [(1, 1, 2, datetime(2026, 1, 1)), (1, 1, 4, datetime(2026, 1, 2)), (1, 2, 5, datetime(2026, 1, 1)), (2, 1, 0, datetime(2026, 1, 1)), (2, 2, None, None)]
    got = reading.label_levels(spark.createDataFrame(rows, labels.schema)).collect()
    assert [tuple(r) for r in got] == [(1, 4.5)]


def test_held_out_accuracy(spark, middle):
    docs, labels = (spark.read.parquet(f"{middle}/{t}.parquet") for t in ("documents", "reading_labels"))
    held = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    got = reading.reading_levels(docs, labels.filter(~held)).join(reading.label_levels(labels.filter(held)).withColumnRenamed("level", "truth"), "doc_id")
    rows = got.filter("level is not null and (truth <= 3.4 or truth >= 3.6)").collect()
    right = sum((r["level"] >= reading.DEMANDING) == (r["truth"] >= 3.5) for r in rows)
    assert len(rows) > 200 and right / len(rows) > 0.94  # raters themselves disagree on a few per cent
