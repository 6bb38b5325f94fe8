import os
import random

import pytest

from freshet.llm.encode import default_tokenizer_dir
from freshet.llm.mix import expand_copies, mix_sources, repetition_rates

if not os.path.exists(os.path.join(default_tokenizer_dir(), "byte_bpe_50k.tiktoken")):
    pytest.skip("no vocabulary files", allow_module_level=True)


SHAPE = "source string, target_share double, max_repeats int, tokens bigint"


def rates(spark, rows, total):
    got = repetition_rates(spark.createDataFrame(rows, SHAPE), spark.createDataFrame([(float(total),)], "total double"))
    return {r.source: r.rate for r in got.collect()}


def test_rates_respect_caps_and_refill(spark):
    rows = [("a", 0.5, 1, 800), ("b", 0.4, 9, 150), ("c", 0.1, 1, 50), ("d", 0.0, 1, 0)]
    r = rates(spark, rows, 1000)
    assert r["c"] == 1.0 and r["d"] == 0.0
    assert abs(r["a"] * 800 / (r["b"] * 150) - 0.5 / 0.4) < 1e-9
    assert abs(sum(r[s] * n for s, _, _, n in rows) - 1000) < 1e-6
    assert rates(spark, rows[2:3], 1e9) == {"c": 1.0}


def test_rates_of_many_sources(spark):
    """200,000 sources, against the same rule in turns: who is over their cap is held there, until nobody is."""
    rng = random.Random(3)
    rows = [(f"s{i}", rng.random() ** 4, rng.randrange(4), rng.randrange(5000)) for i in range(200_000)]
    got = rates(spark, rows, 2e8)
    free, left, want = [r for r in rows if r[1] > 0 and r[2] > 0 and r[3] > 0], 2e8, {}
    while True:
        weight = sum(r[1] for r in free)
        full = [r for r in free if left * r[1] / weight >= r[2] * r[3]]
        if not full:
            break
        want |= {s: float(c) for s, _, c, _ in full}
        left -= sum(c * n for _, _, c, n in full)
        free = [r for r in free if r[0] not in want]
    want |= {s: left * w / weight / n for s, w, _, n in free}
    assert len(got) == len(rows) and len({c for c in want.values()}) > 100
    assert max(abs(got[s] - want.get(s, 0.0)) for s in got) < 1e-6


def test_mix_reaches_shares(spark):
    docs = [(i, "word " * 20, " A " if i % 2 else "a") for i in range(2000)] + [(5000 + i, "word " * 20, "b") for i in range(300)]
    docs += [(9000, None, "a"), (9001, "", "b"), (9002, "left out", None), (9003, "left out", "zz"), (None, "no key", "b")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string").selectExpr("*", "1 AS n", "'x' AS rate", "2 AS copies")
    targets = spark.createDataFrame([("A", 0.6, 1), ("b", 0.3, 5), ("none", 0.1, 2), (None, 0.5, 2), ("b", None, None)], "source string, target_share double, max_repeats int")
    m = mix_sources(df, targets)
    rep = {r.source: r for r in m.report.collect()}
    assert set(rep) == {"a", "b", "none"}
    assert rep["none"].actual_share == 0 and rep["none"].rate == 0
    assert abs(rep["a"].actual_share - 2 / 3) < 0.03 and abs(rep["b"].actual_share - 1 / 3) < 0.03
    rows = m.documents.collect()
    assert all(r.copies <= {"a": 1, "b": 5}[r.source] for r in rows)
    assert {r.source for r in rows} == {"a", "b"}
    assert expand_copies(m.documents).count() == sum(r.copies for r in rows)
    again = mix_sources(df, targets).documents.collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    m = mix_sources(docs, targets)
    assert m.documents.collect() == [] and m.report.first().actual_share == 0
    assert mix_sources(docs, targets.filter("false")).report.collect() == []
