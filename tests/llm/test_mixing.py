import numpy as np

from siltstone.llm import mixing


def data(spark):
    rows = [(i, s, f"{w} {w}{i % 5} talk of {w}") for i, (s, w) in enumerate([("a", "pump"), ("b", "bread"), ("c", "song")] * 40)]
    rows += [(1000 + i, None, "bread bread4 talk of bread") for i in range(6)] + [(2000, "other", "x"), (2001, "a", None), (2002, "a", "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    targets = spark.createDataFrame([("a", 0.2, 1), ("b", 0.5, 2), ("c", 0.1, 1), ("none", 0.2, 3)], "source string, target_share double, max_repeats int")
    return docs, targets


def test_mix(spark):
    docs, targets = data(spark)
    mixed, report = mixing.mix(docs, targets)
    r = {x.source: x for x in report.collect()}
    assert not r["none"].reachable and r["none"].once_tokens == 0 and all(r[s].reachable for s in "abc")
    for s in "abc":
        assert abs(r[s].expected_tokens - r[s].target_tokens) <= 0.01 * r[s].target_tokens
        assert abs(r[s].actual_tokens - r[s].target_tokens) <= 0.1 * r[s].target_tokens
    rows = mixed.collect()
    assert max(x.repeats for x in rows if x.source == "a") <= 1 and max(x.repeats for x in rows) <= 2 and not any(x.source == "other" for x in rows)
    assert len({x.doc_id for x in rows}) == len(rows)


def test_out_of_reach(spark):
    docs, targets = data(spark)
    few = docs.where("source <> 'b' or doc_id < 20")
    _, report = mixing.mix(few, targets.where("source <> 'none'"), use_unlabelled=False)
    r = {x.source: x for x in report.collect()}
    assert not r["b"].reachable and r["b"].actual_tokens == r["b"].most_tokens


def test_posterior(spark):
    docs, _ = data(spark)
    got = mixing.memberships(docs, ["a", "b", "c"]).where("source is null").collect()
    assert len(got) == 6 and all(np.argmax(x.membership) == 1 and abs(sum(x.membership) - 1) < 1e-9 for x in got)


def test_empty(spark):
    docs, targets = data(spark)
    assert mixing.mix(docs.limit(0), targets)[0].count() == 0
    mixed, report = mixing.mix(docs, targets.limit(0))
    assert report.count() == 0 and mixed.count() == 0


def test_raises(spark):
    import pytest

    docs, targets = data(spark)
    with pytest.raises(RuntimeError):
        mixing.mix(docs, targets, steps=1)
    with pytest.raises(OSError):
        mixing.tokenizer("/nowhere/vocabulary")
