"""The quality classifier against a plain restatement of its model, and on labelled documents."""

import math
import random
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenvox.llm import ngrams, quality
from lumenvox.llm.common import SWEPT, cut


def tokens(text):
    words = [w.lower() for w in text.split()]
    words = [w[:-1] if w[-1] in ".,;:!?" else w for w in words]
    found = [f"{w}<again>" if i and w == words[i - 1] else w for i, w in enumerate(words)]
    return ["<b>", *found, "<b>"]


def discounts(counts):
    n = [max(1, sum(c == k for c in counts)) for k in (1, 2, 3, 4)]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max((i + 1) - (i + 2) * y * n[i + 1] / n[i], 0.01), i + 0.99) for i in range(3)]


class Plain:
    """Interpolated modified Kneser-Ney bigrams by dictionaries."""

    def __init__(self, texts):
        self.pairs = Counter(p for t in texts if t.split() for p in zip(tokens(t), tokens(t)[1:], strict=False))
        self.d = discounts(self.pairs.values())
        ends = Counter(b for _, b in self.pairs)
        self.e, self.types, self.every = discounts(ends.values()), len(ends), len(self.pairs)
        self.spread = sum(self.off(n, self.e) for n in ends.values()) / self.every / (self.types + 1)

    @staticmethod
    def off(n, d):
        return 0 if n <= 0 else d[min(n, 3) - 1]

    def p(self, a, b, without=()):
        """p(b | a), with the counts of one text taken away."""
        less = Counter(zip(without, without[1:], strict=False))
        n = {p: c - less[p] for p, c in self.pairs.items()}
        context = [c for (x, _), c in n.items() if x == a and c > 0]
        ends = sum(1 for (_, y), c in n.items() if y == b and c > 0)
        low = max(ends - self.off(ends, self.e), 0) / self.every + self.spread
        if not context:
            return low
        lost, total = sum(self.off(c, self.d) for c in context), sum(context)
        c = n.get((a, b), 0)
        return max(c - self.off(c, self.d), 0) / total + lost / total * low


def corpus(seed=31, n=40):
    random.seed(seed)
    words = ["the", "of", "and", "house", "tree", "Walks", "sings.", "12", "river,", "the", "the"]
    return [" ".join(random.choices(words, k=random.randint(1, 60))) for _ in range(n)]


def test_perplexity_equals_the_plain_model(spark):
    texts = [*corpus(), "unseen words only", "the unseen house the", "", "   ", "tree tree tree"]
    texts += texts[:3]  # copies of trusted texts
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(3)
    found = quality.judged(docs, spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, quality int")).select("row.doc_id", "n_words", "perplexity", "kept").collect()
    trusted = sorted(set(texts[:40]))
    model = Plain(trusted)
    assert len(found) == len(texts)
    for r in found:
        t = tokens(texts[r.doc_id])
        assert r.n_words == len(t) - 2
        if len(t) == 2:
            assert r.perplexity is None and not r.kept
            continue
        own = t if texts[r.doc_id] in trusted else ()
        expected = math.exp(-sum(math.log(model.p(a, b, own)) for a, b in zip(t, t[1:], strict=False)) / (len(t) - 1))
        assert math.isclose(r.perplexity, expected, rel_tol=1e-9)


def test_probabilities_of_a_context_sum_to_one():
    model = Plain(sorted(set(corpus())))
    words = {w for p in model.pairs for w in p}
    for a in words:
        assert math.isclose(sum(model.p(a, b) for b in words) + model.p(a, "<never>"), 1, rel_tol=1e-12)


def test_small_chunks_give_the_same_scores(spark, monkeypatch):
    texts = corpus(37, 60)
    docs = spark.createDataFrame([(i, t, "en" if i % 3 else "de") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(2)
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(60)], "doc_id long, quality int")
    score = lambda: {r.doc_id: r.perplexity for r in quality.judged(docs, labels).select("row.doc_id", "perplexity").collect()}
    whole = score()
    monkeypatch.setattr("lumenvox.llm.ngrams._STEP_BYTES", 100)
    monkeypatch.setattr("lumenvox.llm.quality.coded", lambda bits: ngrams.coded(bits, 50, 4))
    small = score()
    assert whole.keys() == small.keys() and all(math.isclose(whole[k], small[k], rel_tol=1e-9) for k in whole)


def test_exchange_gives_back_what_was_asked():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 1 << 40, 500, dtype=np.uint64))
    of_key = np.sort(rng.integers(0, 2, len(keys)))
    keys = np.concatenate([np.sort(keys[of_key == g]) for g in (0, 1)])
    batch = ngrams.asked(7, np.array([-4, 9]), of_key, keys, [np.arange(len(keys))], 5, 40)
    back = ngrams.heard([{**r, "data": ngrams.packed(ngrams.unpacked(r["data"], r["n"], 2)[1])} for r in batch.to_pylist()], np.array([-4, 9]), of_key, keys, 1, 5, 40)
    assert (back[0] == np.arange(len(keys))).all()


def test_every_language_has_its_own_threshold(spark):
    random.seed(41)
    data = [(i, " ".join(random.choices([f"w{i % 40}x{j}" for j in range(30)], k=60)), f"l{i % 40}") for i in range(800)]
    data += [(900, "w1x1 w1x2 w1x3 w1x4 " * 10, "l1"), (901, "zz yy xx ww vv uu tt ss rr qq", "l1"), (902, data[0][1], None), (903, data[0][1], "other")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in quality.judged(docs, spark.createDataFrame([(i, 1) for i in range(800)], "doc_id long, quality int")).select("row.doc_id", "row.lang", "perplexity", "threshold", "kept").collect()}
    assert len({r.threshold for r in found.values()}) == 41  # forty languages and all together
    assert found[900].kept and not found[901].kept and found[902].threshold == found[903].threshold


def test_shuffle_files_go_with_their_jobs(spark, monkeypatch):
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    files = lambda: {p for d in env.blockManager().diskBlockManager().localDirs() for p in Path(d.toString()).rglob("shuffle_*.data")}
    for module in ("common", "quality"):  # without what the driver forgets by chance
        monkeypatch.setattr(f"lumenvox.llm.{module}.release", lambda spark: None)
    docs = spark.createDataFrame([(i, i, 1, t) for i, t in enumerate(corpus())], "id long, k long, g long, text string").repartition(3)
    docs, before = cut(docs), files()
    scores = quality.document_scores(docs, cut(docs.select("id")))
    for _ in range(50):
        if not (left := files() - before):
            break
        time.sleep(0.2)
    assert scores.count() == 40 and not left
    assert spark.conf.get(next(iter(SWEPT)), None) is None


@pytest.mark.parametrize("kind", ["documents"])
def test_quality_tells_junk_from_text(spark, kind):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in (kind, "labels"))
    found = quality.judged(docs, labels).select("row.doc_id", "kept").join(labels, "doc_id")
    rates = {r.quality: r.kept for r in found.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert rates[1] > 0.99 and rates[0] < 0.06
