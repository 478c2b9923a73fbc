import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.functions import arrow, parse
from siltstone.operators import answers, filters, metrics, questions, similarity, state


def test_triplets(spark):
    good = "x ---START_TRIPLET---\n  QUESTION: q?\nANSWER: a\nmore\nINSTRUCTION: do\n1. this\n\nrest\n---END_TRIPLET--- ---START_TRIPLET---\nQUESTION: cut"
    df = spark.createDataFrame([(1, good), (2, None), (3, ""), (4, "---START_TRIPLET---QUESTION:---END_TRIPLET---")], "pair_id bigint, reply string")
    assert [tuple(r) for r in parse.parse_triplets(df).collect()] == [(1, 1, "q?", "a", "do\n1. this")]


def test_line_parsers(spark):
    df = spark.createDataFrame([(1, "A: lost\nQ: one\nA: x\nA: y\n\nQ: two\nQ: three\nA: z"), (2, None)], "pair_id bigint, reply string")
    assert sorted((r.question, r.answer) for r in parse.parse_qa_lines(df).collect()) == [("one", "y"), ("three", "z")]
    df = spark.createDataFrame([(1, "Answer: a\nConfidence: x\nType: Fact\n\nAnswer: b\nConfidence: 0.25\nAnswer: c")], "pair_id bigint, reply string")
    assert sorted((r.text, r.score, r.type) for r in parse.parse_answers(df).collect()) == [("a", 0.8, "fact"), ("b", 0.25, None), ("c", None, None)]
    q = spark.createDataFrame([(1, 1, "old"), (1, 2, "old")], "pair_id bigint, seq int, question string")
    r = parse.parse_refinements(spark.createDataFrame([(1, "Original: old\nImproved: new\nReasoning: why\nKeep/Replace: Replace")], "pair_id bigint, reply string"))
    assert [(x.question, x.refinement_reason) for x in parse.refine_questions(q, r).orderBy("seq").collect()] == [("new", "why"), ("old", None)]


def test_density_and_booleans(spark):
    df = spark.createDataFrame([(" 0.8\n",), ("1.7",), ("-2",), ("score 0.8",), ("",), (None,), ("0.9d",), ("nan",)], "x string")
    assert [r[0] for r in df.select(parse.density(F.col("x"))).collect()] == [0.8, 1.0, 0.0, 0.5, 0.5, 0.5, 0.5, 0.5]
    df = spark.createDataFrame([("Valid: TRUE",), ("x\nValid: no\nValid: true",), ("",), (None,)], "x string")
    assert [r[0] for r in df.select(parse.boolean_verdict(F.col("x"))).collect()] == [True, False, False, False]


def test_verdicts(spark):
    good = {"valid": True, "scores": {"answer_validity": 1, "question_quality": 0.5, "instruction_quality": 0.25}, "issues": [], "improvements": []}
    cases = [json.dumps(good), "```json\n" + json.dumps(good) + "\n```", json.dumps({**good, "valid": "yes"}), json.dumps({**good, "scores": {**good["scores"], "extra": 2}}), json.dumps({**good, "scores": {**good["scores"], "question_quality": True}}), "{", "", None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, response string")
    assert [(r.well_formed, r.question_quality) for r in parse.parse_verdicts(df).orderBy("i").collect()] == [(True, 0.5), (True, 0.5)] + [(False, None)] * 6


def test_filters(spark):
    df = spark.createDataFrame([(0.7,), (0.6,), (math.nan,), (None,)], "x double")
    assert [r[0] for r in df.select(filters.dense_enough(F.col("x"))).collect()] == [True, False, False, False]
    rows = [("Who?", "Rome", "rome is old"), ("Who", "Rome", "rome"), ("Who?", "a b c d e", "a b c d x"), ("Who?", "a b c d e", "q w"), (None, "a", "a"), ("Q?", None, None)]
    df = spark.createDataFrame(rows, "q string, a string, c string")
    assert [r[0] for r in df.select(filters.pair_valid(F.col("q"), F.col("a"), F.col("c"))).collect()] == [True, False, True, False, False, False]
    df = spark.createDataFrame([("a", " ", "i", None), ("a", "b", "i", None), ("a", "b", "i", {"answer_validity": 0.7, "question_quality": 0.9, "instruction_quality": 0.9}), ("a", "b", "i", {"answer_validity": math.nan})], "question string, answer string, instruction string, validation_scores map<string,double>")
    assert [(r.missing, r.reason) for r in filters.route(df).collect()] == [("answer", "missing_fields"), ("", "no_verdict"), ("", None), ("", "low_scores")]
    df = spark.createDataFrame([("write to a.b@c.de", ""), ("plain words", None), ("def f(x)", "")], "q string, a string")
    assert [r[0] for r in df.select(filters.content_ok(F.col("q"), F.col("a"))).collect()] == [False, True, False]


def test_folds():
    v = [1.0, 1.05, 2.0, 2.01, 3.0]
    near = lambda i: np.abs(np.array(v) - v[i]) < 0.1
    assert arrow.greedy_kept(near, 5) == [True, False, True, False, True]
    assert arrow.greedy_kept(near, 5, True) == [True, False, True, True, True]
    assert arrow.star_heads(near, 5) == [0, 0, 2, 2, 4]


def test_similarity(spark):
    df = spark.createDataFrame([(1, 0, "a b c"), (1, 1, "a b c"), (1, 2, "x y"), (1, 3, None), (2, 0, "a")], "doc_id bigint, chunk_ix int, content string")
    assert [(r.doc_id, r.chunk_ix) for r in similarity.near_dup_flags(df, "doc_id", "chunk_ix", "content").where("kept").orderBy("doc_id", "chunk_ix").collect()] == [(1, 0), (1, 2), (1, 3), (2, 0)]
    assert [(r.chunk_ix, r.content) for r in similarity.merge_chunks(df.where("doc_id = 1")).orderBy("chunk_ix").collect()] == [(0, "a b c\na b c"), (2, "x y"), (3, "")]
    got = {(r.doc_id, r.chunk_ix): r.coherence for r in similarity.coherence(df).collect()}
    assert got[2, 0] == 0 and abs(got[1, 0] - 1 / 3) < 1e-9
    with pytest.raises(ValueError):
        similarity.near_dup_flags(df, "doc_id", "chunk_ix", "content", mode="other")


def test_metrics(spark):
    one = lambda c, *v: spark.createDataFrame([v], ", ".join(f"x{i} string" for i in range(len(v)))).select(c(*[F.col(f"x{i}") for i in range(len(v))]).alias("y")).first()["y"]
    assert abs(one(metrics.question_quality, "Tell me") - 0.504) < 1e-9
    assert abs(one(metrics.relevance, "a b", "a c d e") - (0.35 + 0.3 * 3 / 7)) < 1e-9 and one(metrics.relevance, "", "x") == 0
    assert abs(one(arrow.ngram_overlap, "a b c d", "a b c e") - 0.4) < 1e-9 and one(arrow.ngram_overlap, "a", None) == 0
    d = metrics.diversity(spark.createDataFrame([(1, 1, "a b c d"), (1, 2, "a b c e"), (2, 1, "x"), (3, 1, None)], "g int, o int, t string"), "g", "o", "t")
    assert {r.g: round(r.diversity, 6) for r in d.collect()} == {1: 0.6125, 2: 1.0, 3: 0.0}


def test_overlap_metrics():
    a = "the cat sat on the mat".split()
    assert arrow.bleu(a, a) == pytest.approx(1) and arrow.bleu(a, ["dog"]) == 0 and arrow.bleu([], a) == 0
    assert arrow.rouge_n(a, a, 2) == 1 and arrow.rouge_l(["a", "b", "c"], ["a", "x", "c"]) == pytest.approx(2 / 3)
    assert arrow.meteor(a, a) == pytest.approx(1 - 0.5 / 216) and arrow.meteor(a, ["dog"]) == 0
    # Words and stems of the published algorithm.
    for word, stemmed in {"caresses": "caress", "ponies": "poni", "relational": "relat", "hopping": "hop", "happy": "happi", "adjustment": "adjust", "controlling": "control", "generalizations": "gener"}.items():
        assert arrow.stem(word) == stemmed
    rng = random.Random(3)
    for _ in range(200):
        x, y = ([rng.choice("abc") for _ in range(rng.randint(1, 9))] for _ in range(2))
        t = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, p in enumerate(x):
            for j, q in enumerate(y):
                t[i + 1][j + 1] = t[i][j] + 1 if p == q else max(t[i][j + 1], t[i + 1][j])
        assert arrow.rouge_l(x, y) == pytest.approx(2 * t[-1][-1] / (len(x) + len(y)))


def test_answers_and_questions(spark):
    df = spark.createDataFrame([("fact", 0.7, "one two three four five"), ("other", 0.7, "x")], "k string, s double, t string")
    assert [round(r[0], 6) for r in df.select(answers.answer_rank(F.col("s"), F.col("k"), F.col("t"))).collect()] == [0.847, 0.7]
    docs = spark.createDataFrame([(1, "The pump was repaired in 1999 by Delta Works. It is old."), (2, None), (3, "")], "doc_id bigint, content string")
    found = answers.all_answers(docs)
    assert found.where("type = 'fact'").count() >= 1 and found.select("doc_id").distinct().count() == 1
    top = answers.ranked(answers.filtered(found), top=2).collect()
    assert len(top) <= 2 and all(r.place <= 2 for r in top)
    a = spark.createDataFrame([(1, 1, "q -> a", "visual", "analysis", "own?"), (1, 2, "X", "fact", "sentence", None), (1, 3, "Y", "visual", "odd", None)], "doc_id bigint, seq int, text string, type string, subtype string, question string")
    made = questions.from_templates(a).collect()
    assert len(made) == 7 and [r.question for r in made if r.seq == 1] == ["own?"]
    p = spark.createDataFrame([(1, "b c", "A b. B c b."), (2, "x", None)], "pair_id bigint, answer string, context string")
    assert {r.pair_id: r.sentence for r in questions.best_sentence(p).collect()} == {1: "B c b.", 2: "this content"}


def test_state(spark):
    s = spark.createDataFrame([("a", False, 1, "x"), ("a", True, 2, None), ("b", True, 1, None), ("b", False, 2, "y"), ("b", False, 2, "y")], "path string, success boolean, t int, error string").withColumn("ts", F.timestamp_seconds("t"))
    files = spark.createDataFrame([("a", "PDF"), ("b", "txt"), ("c", "txt"), ("c", "txt")], "source string, format string")
    assert sorted(r.source for r in state.unprocessed(files, s).distinct().collect()) == ["b", "c"]
    assert sorted(tuple(r) for r in state.processing_stats(files, s).collect()) == [("pdf", 1, 1, 0), ("txt", 2, 0, 1)]
    assert state.processing_stats(files.limit(0), s).collect() == []


@pytest.mark.parametrize("dense", [True, False])
def test_large_groups_in_blocks(spark, monkeypatch, dense):
    """Groups compared block by block give what gathered groups give."""
    rng = random.Random(7)
    rows = [(g, i, [rng.choice([0.0, 1.0, 2.0]) for _ in range(3)] if dense else " ".join(rng.choices("abcde", k=4))) for g in (1, 2) for i in range(60)] + [(3, 0, [1.0, 0.0, 0.0] if dense else "a"), (3, 1, None if not dense else [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, f"g int, o int, v {'array<double>' if dense else 'string'}")
    calls = {"greedy": lambda: similarity.near_dup_flags(df, "g", "o", "v", 0.9), "reference": lambda: similarity.near_dup_flags(df, "g", "o", "v", 0.9, "reference"), "merge": lambda: similarity.merge_heads(df, "g", "o", "v", 0.9)}
    want = {k: sorted(map(tuple, f().collect())) for k, f in calls.items()}
    monkeypatch.setattr(similarity, "BLOCK", 16)
    for k, f in calls.items():
        assert sorted(map(tuple, f().collect())) == want[k], k


def test_located_and_related(spark):
    long = "[OCR Text: " + " ".join(f"w{i}" for i in range(40)) + "]"
    docs = spark.createDataFrame([(1, "red pump", f"Main words here\n\n[OCR Text: red pump]\n\n{long}"), (2, "x y", None), (3, "cat", "[Image Caption: a dog]\n\n[Image Caption: cat]")], "k int, answer string, content string")
    got = {r.k: (r.main_text, r.ocr_text, r.image_caption) for r in answers.located(docs).collect()}
    assert got == {1: (False, True, False), 2: (False, False, False), 3: (False, False, True)}
    text = "p0\n\np1 the red pump\n\np2\n\np3\n\np4\n\np5 [Visual Context: red pump] [OCR Text: AB 12]"
    d = spark.createDataFrame([(1, text), (2, None), (3, "none")], "doc_id int, content string")
    rel = answers.related_paragraphs(d).orderBy("place").collect()
    assert [(r.place, len(r.related.split("\n\n"))) for r in rel] == [(1, 5), (5, 4)]
    comb = answers.combined_answers(d).collect()
    assert [(r.text, r.subtype, round(r.score, 3)) for r in comb] == [("AB 12 (Visual) - Related to: red pump", "text_ocr_text", 0.85)]
    kinds = {r.type for r in answers.all_answers(d).collect()}
    assert {"visual", "combined"} <= kinds


def test_verified_windows(spark):
    rows = [("the red pump", "It is the  RED\npump."), ("pump red the", "so the red pump it is"), ("a b c d e", "x a b c d y"), ("a b c d e", "a b x y z c"), (None, "x"), ("x", None), ("", "")]
    df = spark.createDataFrame(rows, "a string, t string")
    got = [r[0] for r in df.select(answers.verified(F.col("a"), F.col("t"))).collect()]

    def brute(a, t):
        a, t = (" ".join((x or "").lower().split()) for x in (a, t))
        n, w = len(a.split()), t.split()
        return a in t or any(arrow.cosine_of(arrow.bow(a), arrow.bow(" ".join(w[i : i + n]))) > 0.8 for i in range(len(w) - n + 1))

    assert got == [brute(*r) for r in rows] and got[:4] == [True, True, False, False]


def test_generated_questions(spark):
    a = spark.createDataFrame([(1, 1, "AB 12 (Visual) - Related to: pump", "combined", "text_ocr_text", 0.9, None, "The pump is red. It is AB 12."), (1, 2, "the pump", "entity", "name", 0.7, None, "The pump is red.")], "doc_id int, seq int, text string, type string, subtype string, score double, question string, context string")
    made = questions.from_templates(a).collect()
    assert any("It is AB 12." in r.question for r in made if r.category == "combined")

    def model(prompts):
        return [("Question Type: factual\nQuestion: What colour has the pump?\nVerification: said\nComplexity: 0.2" if p.startswith("ASK") else "Original: What colour has the pump?\nImproved: Which colour does the pump have?\nReasoning: clear\nKeep/Replace: Replace") for p in prompts]

    got = {r.question for r in questions.from_model(a, model).collect()}
    assert "Which colour does the pump have?" in got and "What colour has the pump?" not in got and len(got) == 4
    ranked = questions.generated(a, model).collect()
    assert ranked and {r.category for r in ranked} == {"combined", "text"}


def test_extracted_by_model(spark):
    d = spark.createDataFrame([(1, "The pump is red and old.")], "doc_id int, content string")
    got = answers.extracted_by_model(d, lambda ps: ["Answer: pump is red\nConfidence: 0.9\nType: Fact\n\nAnswer: nothing of it\nConfidence: 1"] * len(ps)).collect()
    assert [(r.text, r.score) for r in got] == [("pump is red", 0.9)]


def test_pair_diversity(spark):
    d = spark.createDataFrame([(1, 1, "a b c d", "x"), (1, 2, "a b c e", "x")], "g int, o int, question string, answer string")
    r = metrics.pair_diversity(d, "g", "o").first()
    assert r.question_diversity == pytest.approx(0.6125) and r.answer_diversity == pytest.approx(0.75) and r.overall_diversity == pytest.approx((0.6125 + 0.75) / 2)
