"""Mixing sources to target weights.

Every record gets a membership over the target sources: records with a source have that source, records whose source
is missing get the posterior of a naive Bayes classifier trained on a bounded sample of the labelled ones. Nonnegative
rates (expected repeats) are fitted by projected gradient steps on the squared difference between expected and wanted
tokens of each source: each step is one distributed sum of as many numbers as there are sources. Steps that do not
converge raise. Rates are bounded by the repeats allowed, so what gap is left in the end is out of reach; a rate's fraction is rounded by a hash of the record and a cut by source that meets the
expected tokens, so every run repeats the same rows.

Empty and null texts have no tokens and a rate of at most one; sources without a target are not used; a target without
records gets a share of zero and counts as out of reach. Sizes are tokens of a public tokenizer, whose file is a
parameter.
"""

from __future__ import annotations

import base64
import os

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.io import cut
from siltstone.llm.common import WORD, map_rows, word_hash

TOKENIZER = os.environ.get("SILTSTONE_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: The split pattern that public byte-level BPE vocabularies of this kind are used with.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Labelled rows a source from which the classifier learns, about; features are hashed to this many cells.
TRAIN_ROWS, CELLS = 500, 1 << 13
STEPS = 60
#: Share of all tokens by which fitted sums may miss a target: where each step is a pass over the unlabelled rows, and where not.
CLOSE, CLOSER = 1e-4, 1e-10
#: Steps of the cut by which fractions of rates are rounded.
ROUNDING = 1024
REPORT = "source string, target_share double, target_tokens double, once_tokens bigint, most_tokens bigint, expected_tokens double, actual_tokens bigint, actual_share double, reachable boolean"


def tokenizer(path: str = TOKENIZER):
    """A counter of tokens. A missing vocabulary file or library raises: sizes in other units would make another mix."""
    import tiktoken

    with open(path, "rb") as h:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, h)}
    encoding = tiktoken.Encoding("sizes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: len(encoding.encode_ordinary(text))


def features(text: str) -> np.ndarray:
    words = WORD.findall(text.lower())
    return np.fromiter((word_hash(w) % CELLS for w in words), np.int64, len(words))


def train(labelled: DataFrame, sources: list[str], counts: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Log priors and log cell weights of a naive Bayes classifier, from about ``TRAIN_ROWS`` rows a source."""
    chance = F.create_map(*[x for s in sources for x in (F.lit(s), F.lit(min(1.0, TRAIN_ROWS / max(1, counts.get(s, 0)))))])
    picked = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < chance[F.col("source")] * 1_000_000)
    place = {s: k for k, s in enumerate(sources)}

    def make():
        def f(batch):
            sums = np.zeros((len(place), CELLS), np.int64)
            for s, t in zip(*(c.to_pylist() for c in batch.columns)):
                np.add.at(sums[place[s]], features(t or ""), 1)
            k, cell = np.nonzero(sums)
            return k, cell, sums[k, cell]

        return f

    weight = np.full((len(sources), CELLS), 0.1)
    for r in map_rows(picked.select("source", "text"), make, "k bigint, cell bigint, n bigint").groupBy("k", "cell").agg(F.sum("n").alias("n")).collect():
        weight[r["k"], r["cell"]] += r["n"]
    prior = np.array([counts.get(s, 0) + 1.0 for s in sources])
    return np.log(prior / prior.sum()), np.log(weight / weight.sum(1, keepdims=True))


def memberships(docs: DataFrame, sources: list[str], tokenizer_path: str = TOKENIZER) -> DataFrame:
    """``doc_id, source, tokens, membership`` (an array over ``sources``) of the usable rows of ``docs``."""
    place = {s: k for k, s in enumerate(sources)}
    rows = docs.select("doc_id", "source", "text")
    labelled = rows.where(F.col("source").isin(sources))
    counts = {r["source"]: r["n"] for r in labelled.groupBy("source").agg(F.count("*").alias("n")).collect()}
    prior, weight = train(labelled, sources, counts)

    def make():
        count = tokenizer(tokenizer_path)
        one = [[float(k == j) for j in range(len(sources))] for k in range(len(sources))]

        def f(batch):
            ids, names, texts = (c.to_pylist() for c in batch.columns)
            member = []
            for s, t in zip(names, texts):
                if s is not None:
                    member.append(one[place[s]])
                else:
                    score = prior + weight[:, features(t or "")].sum(1)
                    p = np.exp(score - score.max())
                    member.append((p / p.sum()).tolist())
            return ids, names, [count(t) if t else 0 for t in texts], member

        return f

    usable = rows.where(F.col("source").isin(sources) | F.col("source").isNull())
    return map_rows(usable, make, "doc_id bigint, source string, tokens bigint, membership array<double>")


def rates_of(member: np.ndarray, cap: np.ndarray, history: np.ndarray) -> np.ndarray:
    """Rates of rows (rows × sources) after the steps of ``history``."""
    rate = np.minimum(1.0, cap)
    for pressure in history:
        rate = np.clip(rate + member @ pressure, 0.0, cap)
    return rate


def expected(members: DataFrame, caps: np.ndarray, history: np.ndarray) -> np.ndarray:
    """Expected tokens by source under the rates of ``history``, summed over all rows."""

    def make():
        def f(batch):
            tokens, flat = batch.column(1).to_numpy(), batch.column(2).flatten().to_numpy()
            member = flat.reshape(-1, len(caps))
            soft = np.array([s is None for s in batch.column(0).to_pylist()])
            cap = np.where(soft, np.minimum(1.0, member @ caps), member @ caps)
            sums = (member * (rates_of(member, cap, history) * tokens)[:, None]).sum(0)
            return np.arange(len(caps)), sums

        return f

    out = np.zeros(len(caps))
    for r in map_rows(members.select("source", "tokens", "membership"), make, "k int, t double").groupBy("k").agg(F.sum("t").alias("t")).collect():
        out[r["k"]] = r["t"]
    return out


def mix(docs: DataFrame, targets: DataFrame, tokenizer_path: str = TOKENIZER, steps: int = STEPS, use_unlabelled: bool = True) -> tuple[DataFrame, DataFrame]:
    """The mix and its report.

    Mix: ``doc_id, source, tokens, rate, repeats``. Report, a row a source: ``source, target_share, target_tokens,
    once_tokens`` (each labelled row once), ``most_tokens`` (each as often as allowed), ``expected_tokens,
    actual_tokens, actual_share, reachable``. ``reachable`` tells whether the fitted rates meet the target; where they
    don't, all rates of the source stand at their bounds. ``targets`` has a row a source (a bounded list).
    """
    spark = docs.sparkSession
    wanted = sorted((r["source"], float(r["target_share"]), int(r["max_repeats"])) for r in targets.select("source", "target_share", "max_repeats").distinct().collect())
    if not wanted:
        return spark.createDataFrame([], "doc_id bigint, source string, tokens bigint, rate double, domain string, repeats int"), spark.createDataFrame([], REPORT)
    sources, caps = [w[0] for w in wanted], np.array([float(w[2]) for w in wanted])
    members = cut(memberships(docs, sources, tokenizer_path), "memberships")
    # Rows of equal membership and cap move alike: labelled rows enter a step as one row a source.
    hard = {r["source"]: float(r["t"]) for r in members.where(F.col("source").isNotNull()).groupBy("source").agg(F.sum("tokens").alias("t")).collect()}
    once = np.array([hard.get(s, 0.0) for s in sources])
    goal = np.array([w[1] for w in wanted]) * once.sum()
    unlabelled = members.where(F.col("source").isNull() & (F.lit(use_unlabelled)))
    eye, history = np.eye(len(sources)), np.zeros((0, len(sources)))
    soft_size = unlabelled.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t")).first()["t"] if use_unlabelled else 0
    scale = once + soft_size / max(1, len(sources))
    before, close = None, (CLOSE if soft_size else CLOSER) * max(1.0, once.sum())
    for _ in range(steps):
        now = rates_of(eye, caps, history) * once
        if soft_size:
            now = now + expected(unlabelled, caps, history)
        step = np.where(scale > 0, 0.7 * (goal - now) / np.maximum(scale, 1.0), 0.0)
        if np.abs(goal - now).max() <= close:
            break
        history = np.vstack([history, step])
        if before is not None and np.abs(now - before).max() <= 0.2 * close:
            break  # what is left is out of reach
        before = now
    else:
        raise RuntimeError(f"rates have not converged in {steps} steps")
    reached = goal - now <= 10 * close

    def make():
        def f(batch):
            ids, names, tokens, _ = (c.to_pylist() for c in batch.columns)
            member = batch.column(3).flatten().to_numpy().reshape(-1, len(caps))
            soft = np.array([s is None for s in names])
            cap = np.where(soft, np.minimum(1.0, member @ caps), member @ caps)
            return ids, names, tokens, rates_of(member, cap, history), [sources[k] for k in member.argmax(1)]

        return f

    rated = map_rows(members.where(F.col("source").isNotNull() | F.lit(use_unlabelled)), make, "doc_id bigint, source string, tokens bigint, rate double, domain string")
    rated = cut(rated, "rates")
    # The fraction of a rate is rounded by a hash over the fraction: rows under a cut near 1 get one repeat more. The cut
    # of each source is moved to where the sum of tokens meets the expectation, from sums by steps of the cut.
    part = F.col("rate") - F.floor("rate")
    place_ = F.when(part > 1e-9, F.floor(F.pmod(F.xxhash64(F.lit("repeat"), "doc_id"), F.lit(1 << 30)) / float(1 << 30) / part * ROUNDING)).otherwise(2 * ROUNDING)
    placed = rated.withColumn("place", F.least(place_, F.lit(2 * ROUNDING)).cast("int"))
    extra = {}
    for r in placed.groupBy("domain", "place").agg(F.sum("tokens").alias("t"), F.sum(F.col("tokens") * part).alias("e")).collect():
        extra.setdefault(r["domain"], []).append((r["place"], r["t"], r["e"]))
    cuts = {}
    for s, steps_ in extra.items():
        want, have = sum(e for _, _, e in steps_), 0
        best = (abs(want), 0)
        for at, t, _ in sorted(x for x in steps_ if x[0] < 2 * ROUNDING):
            have += t
            best = min(best, (abs(want - have), at + 1))
        cuts[s] = best[1]
    cut_at = F.coalesce(*[F.when(F.col("domain") == s, c) for s, c in sorted(cuts.items())], F.lit(0)) if cuts else F.lit(0)
    mixed = placed.withColumn("repeats", (F.floor("rate") + (F.col("place") < cut_at).cast("int")).cast("int")).drop("place")
    sums = {r["domain"]: r for r in mixed.groupBy("domain").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("t"), F.sum(F.col("tokens") * F.col("rate")).alias("e")).collect()}
    total = sum(r["t"] for r in sums.values()) or 1
    report = []
    for k, (s, share, cap) in enumerate(wanted):
        most = float(once[k] * cap)
        r = sums.get(s)
        report.append((s, share, float(goal[k]), int(once[k]), int(most), float(r["e"]) if r else 0.0, int(r["t"]) if r else 0, (r["t"] if r else 0) / total, bool(reached[k])))
    return mixed, spark.createDataFrame(report, REPORT)
