import numpy as np
import pytest
from pyspark.sql import functions as F

from lumisift.llm import mixing, queries, tokens


def sizes(spark):
    rows = [(i, ["Big Source", "big-source", "BIGSOURCE"][i % 3], 10 + i % 7) for i in range(400)] + [(1000 + i, "mid", 20) for i in range(40)] + [(2000 + i, "tiny", 5) for i in range(4)] + [(3000, None, 9), (3001, "mid", 0)]
    return spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint").withColumns({"block": F.lit(1), "tokens": F.lit(2), "source_key": F.lit("x"), "copies": F.lit(3)}).select("doc_id", "source", "n_tokens")


TARGETS = "mix_id int, source string, target_weight double, max_repeats int, total_tokens bigint"


def test_plan_and_realisation(spark):
    docs = sizes(spark).checkpoint()
    targets = spark.createDataFrame([(1, "big_source", 0.5, 1, 2000), (1, "mid", 0.45, 3, 2000), (1, "tiny", 0.05, 2, 2000), (2, "mid", 0.9, 3, 1000), (2, "nobody", 0.1, 3, 1000)], TARGETS)
    plan = mixing.mix_plan(docs, targets)
    rows = {(r["mix_id"], r["source"]): r for r in plan.collect()}
    assert {k for k, r in rows.items() if r["short"]} == {(1, "tiny"), (2, "nobody")}
    assert rows[(1, "tiny")]["budget"] == 40 and sum(r["budget"] for k, r in rows.items() if k[0] == 1) == pytest.approx(2000)
    drawn = mixing.realise(docs, plan)
    got = drawn.collect()
    assert len({(r["mix_id"], r["source"], r["doc_id"]) for r in got}) == len(got)
    for r in mixing.mix_report(plan, drawn).collect():
        assert r["most_copies"] <= r["max_repeats"]
        assert abs(r["reached_tokens"] - r["budget"]) <= 20
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.realise(docs, plan).collect()))


def test_no_targets_and_empty(spark):
    docs = sizes(spark)
    free = spark.createDataFrame([(1, "bigsource", None, 1, 300), (1, "mid", None, 1, 300), (1, "tiny", None, 1, 300)], TARGETS)
    rows = {r["source"]: r for r in mixing.mix_plan(docs, free).collect()}
    assert rows["tiny"]["budget"] == pytest.approx(20, rel=1e-3) and sum(r["budget"] for r in rows.values()) == pytest.approx(300)
    empty = docs.limit(0).checkpoint()
    plan = mixing.mix_plan(empty, free)
    assert all(r["budget"] == 0 for r in plan.collect()) and mixing.realise(empty, plan).collect() == []
    assert mixing.mix_plan(docs, free.limit(0)).collect() == []


def test_temperature():
    t = np.array([900.0, 90.0, 10.0])
    flat, natural = np.log(3), mixing.entropy(t / t.sum())
    for target in (natural + 0.1, 0.7, flat - 0.01):
        x, w = mixing.temperature_weights(t, entropy_target=target)
        assert 0 <= x <= 1 and mixing.entropy(w) == pytest.approx(target, abs=1e-6) and w.sum() == pytest.approx(1)
    x, w = mixing.temperature_weights(t, total=500, caps=t * 2)
    assert (w * 500 <= t * 2 + 1e-6).all() and 0 < x < 1
    assert mixing.temperature_weights(t, entropy_target=0.0)[0] == 1.0


def test_deficit():
    w, spare = np.array([0.5, 0.3, 0.2]), np.array([10.0, 100.0, 5.0])
    x, extra = mixing.spread_deficit(w, spare, 60)
    assert extra.sum() == pytest.approx(60, rel=1e-6) and (extra <= spare + 1e-6).all() and 0 < x <= 1
    assert mixing.spread_deficit(w, np.zeros(3), 60)[1].sum() == 0
    assert mixing.spread_deficit(w, spare, 1e9)[1].sum() == pytest.approx(115)


def test_token_counts_and_very_long_words(spark):
    rows = spark.createDataFrame([("hello world",), ("",), (None,), ("a" * 150_000,), ("<|endoftext|>",)], "t string")
    got = [r[0] for r in rows.select(tokens.token_count(F.col("t"))).collect()]
    assert got[:3] == [2, 0, 0] and got[3] > 1000 and got[4] > 1


def test_every_tokenizer_gives_the_same_short_sources(spark, small):
    docs, targets = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "mix_targets"))
    found = []
    for name in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken"):
        plan = mixing.mix_plan(tokens.document_sizes(docs, f"{tokens.FOLDER}/{name}"), targets)
        found.append(sorted(map(tuple, plan.filter("short").select("mix_id", "source").collect())))
    assert all(f == found[0] for f in found) and found[0] == sorted(map(tuple, queries.p8_found(spark, small).collect()))
