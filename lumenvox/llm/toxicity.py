"""Toxicity: a logistic model of words, regularised by counterfactuals.

Every sampled labelled text gets twins: one with its identity terms swapped for others of their kind and one
without them, or, where it names no group, two with a mention put in. Training penalises the difference
between the scores of a text and its twins, so that a mention itself carries no weight and neutral texts about groups are
not taken for toxic ones. Features are the distinct words of a text and their first letters, which
carry over to inflected words; they are counted and chosen by Spark, so that the driver fits few numbers.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenvox.llm.common import cut, text_of

#: Labelled documents that the model is fitted on, at most about, chosen by a hash of their ids.
FIT_DOCS = 12_000
#: Features are hashed to so many bits; those in fewer documents or with less of a difference between the classes (in standard errors) are left out.
FEATURE_BITS, LEAST_DOCS, LEAST_Z = 24, 5, 4.5
#: Weights of the penalty on squared differences of the scores of twins and of the squared weights.
COUNTERFACTUAL, SHRINK = 10.0, 1e-4
# Identity terms that are swapped with each other.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african"),
    ("gay", "lesbian", "bisexual", "straight"),
    ("transgender", "cisgender"),
    ("immigrants", "natives", "refugees"),
    ("immigrant", "native", "refugee"),
    ("elderly", "young"),
    ("disabled", "blind", "deaf"),
    ("frauen", "männer"),
    ("frau", "mann"),
    ("muslime", "christen", "juden", "hindus", "buddhisten"),
    ("türken", "polen", "syrer", "araber"),
    ("schwule", "lesben"),
    ("einwanderer", "flüchtlinge"),
    ("femmes", "hommes"),
    ("femme", "homme"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes"),
    ("arabes", "africains", "asiatiques"),
    ("homosexuels", "lesbiennes"),
    ("immigrés", "réfugiés"),
    ("mujeres", "hombres"),
    ("mujer", "hombre"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas"),
    ("gitanos", "latinos", "africanos"),
    ("homosexuales", "lesbianas"),
    ("inmigrantes", "refugiados"),
)
_WORD = re.compile(r"\w+")
_CACHE_ENTRIES = 250_000


def features(word: str) -> list[int]:
    """Hashed features of a lower-cased word: itself and its first four and five letters."""
    parts = [f"w{word}"]
    if len(word) >= 4:
        parts.append(f"4{word[:4]}")
    if len(word) >= 5:
        parts.append(f"5{word[:5]}")
    return [zlib.crc32(p.encode()) & ((1 << FEATURE_BITS) - 1) for p in parts]


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def swaps(terms: tuple[tuple[str, ...], ...]) -> dict[str, str]:
    """Each identity term with the one that takes its place."""
    return {a: b for group in terms for a, b in zip(group, (*group[1:], group[0]), strict=True)}


def twins(words: set[str], terms: dict[str, str]) -> list[set[str]]:
    """The words of the twins: with mentions swapped and without them, or, where there are none, with two that the words pick."""
    if named := words & terms.keys():
        return [(words - named) | {terms[w] for w in named}, words - named]
    if not terms:
        return [words, words]
    one = sorted(terms)[zlib.crc32(" ".join(sorted(words)).encode()) % len(terms)]
    return [words | {one}, words | {terms[one]}]


def _features(words: set[str]) -> np.ndarray:
    return np.unique(np.array([f for w in words for f in features(w)], np.int64))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, text) to the features of each batch, with the numbers of texts and of texts of class 1 that have them."""
    for b in batches:
        found = [_features(words_of(t.as_py())) for t in b.column(1)]
        every = np.concatenate(found) if found else np.empty(0, np.int64)
        ones = np.repeat(np.asarray(b.column(0)).astype(np.int64), [len(f) for f in found])
        feature, inverse = np.unique(every, return_inverse=True)
        yield pa.RecordBatch.from_arrays([pa.array(feature), pa.array(np.bincount(inverse, minlength=len(feature))), pa.array(np.bincount(inverse, ones, len(feature)).astype(np.int64))], ["feature", "n", "ones"])


def _chosen(known: np.ndarray, terms: dict[str, str]):
    """mapInArrow function: (label, text) to the places in ``known`` of the features of each text and of its twins."""

    def places(words: set[str]) -> bytes:
        f = _features(words)
        at = np.minimum(np.searchsorted(known, f), max(0, len(known) - 1))
        return at[known[at] == f].astype("<u4").tobytes() if len(known) else b""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [words_of(t.as_py()) for t in b.column(1)]
            both = [[places(t) for t in twins(w, terms)] for w in words]
            columns = [[places(w) for w in words], [t[0] for t in both], [t[1] for t in both]]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.binary()) for c in columns)], ["label", "own", "twin", "other"])

    return run


def _flat(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(b"".join(rows), "<u4").astype(np.int64)
    return ids, np.repeat(np.arange(len(rows)), [len(r) // 4 for r in rows])


class Model:
    """Weights of words, by hashed feature."""

    def __init__(self, bias: float, ids: np.ndarray, weights: np.ndarray) -> None:
        self.bias = bias
        self.weights = dict(zip(ids.tolist(), weights.tolist(), strict=True))
        self.cache: dict[str, float] = {}

    def score(self, text: str) -> float:
        words = words_of(text)
        cache = self.cache
        if len(cache) > _CACHE_ENTRIES:
            cache.clear()
        total = self.bias
        for w in words:
            if (x := cache.get(w)) is None:
                x = cache[w] = sum(self.weights.get(f, 0.0) for f in features(w))
            total += x
        return float(1 / (1 + np.exp(-max(-60.0, min(60.0, total)))))


def fit(known: np.ndarray, labels: np.ndarray, own: list[bytes], twins: list[list[bytes]], penalty: float = COUNTERFACTUAL, rounds: int = 400) -> Model:
    """The model of labelled texts and their lists of twins (places in ``known`` of their features), by full gradient steps."""
    y = labels.astype(np.float64)
    n, n1 = len(y), float(y.sum())
    bias = float(np.log((n1 + 0.1) / (n - n1 + 0.9)))
    if n1 == 0 or n1 == n:
        return Model(bias, np.empty(0, np.int64), np.empty(0))
    (f, r), paired = _flat(own), [_flat(t) for t in twins] if penalty else []
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -60, 60)))
    w = np.zeros(len(known))
    m, v, bm, bv = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, rounds + 1):
        s = sigmoid(bias + np.bincount(r, weights=w[f], minlength=n))
        error = (s - y) / n
        g, gb = SHRINK * w, 0.0
        for tf, tr in paired:
            t = sigmoid(bias + np.bincount(tr, weights=w[tf], minlength=n))
            slope = 2 * penalty / len(paired) / n * (s - t)
            error = error + slope * s * (1 - s)
            back = -slope * t * (1 - t)
            g, gb = g + np.bincount(tf, weights=back[tr], minlength=len(w)), gb + back.sum()
        g, gb = g + np.bincount(f, weights=error[r], minlength=len(w)), gb + error.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        bm, bv = 0.9 * bm + 0.1 * gb, 0.99 * bv + 0.01 * gb * gb
        a, b = 1 - 0.9**step, 1 - 0.99**step
        w -= 0.05 * (m / a) / (np.sqrt(v / b) + 1e-8)
        bias -= 0.05 * (bm / a) / (np.sqrt(bv / b) + 1e-8)
    return Model(float(bias), known, w)


def held_out(id_column: Column, folds: int = 5) -> Column:
    """Whether a document's label is kept for testing: crc32 of its id as text, modulo ``folds``, is 0."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))) % folds == 0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS, fit_docs: int = FIT_DOCS, penalty: float = COUNTERFACTUAL) -> Model:
    """The model, from at most about ``fit_docs`` labelled documents that are not held out."""
    usable = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    usable = usable.groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_label"))
    share = min(1.0, fit_docs / max(1, usable.count()))
    sample = usable.filter(F.pmod(F.xxhash64("_id", F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30)))
    texts = docs.select(F.col(id_col).cast("long").alias("_doc"), text_of(text_col).alias("_text"))
    # the sample is bounded, so it is broadcast; of texts with one id the last in order counts
    rows = texts.join(F.broadcast(sample), F.col("_doc") == F.col("_id"))
    rows = cut(rows.groupBy("_id").agg(F.max("_label").alias("_label"), F.max("_text").alias("_text")).select("_id", "_label", "_text"))
    total, ones = rows.agg(F.count("*"), F.coalesce(F.sum("_label"), F.lit(0))).first()
    pairs = swaps(terms)
    kept = np.empty(0, np.int64)
    if 0 < ones < total:
        counted = rows.select("_label", "_text").mapInArrow(_counted, "feature long, n long, ones long").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones"))
        p = F.col("n") / total
        spread = F.sqrt(F.greatest(p * (1 - p), F.lit(1e-12)) * (1 / ones + 1 / (total - ones)))
        z = F.abs(F.col("ones") / ones - (F.col("n") - F.col("ones")) / (total - ones)) / spread
        kept = counted.filter((F.col("n") >= LEAST_DOCS) & (z >= LEAST_Z)).select("feature").toPandas()["feature"].to_numpy(np.int64)
    # mentions are features of their own accord, since twins have them
    named = np.array([f for t in pairs for f in features(t)], np.int64)
    known = np.unique(np.concatenate([kept, named])) if len(kept) else kept
    found = rows.select("_id", "_label", "_text").orderBy("_id").select("_label", "_text").mapInArrow(_chosen(known, pairs), "label int, own binary, twin binary, other binary").toArrow()
    return fit(known, np.array(found.column("label").to_pylist()), found.column("own").to_pylist(), [found.column(c).to_pylist() for c in ("twin", "other")], penalty)


def toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, score, predicted.

    Scores depend on the text alone; null counts as the empty text, whose score is that of no
    words. A null id is hashed as an empty one. Equal texts have equal scores; an empty table
    gives no rows; without labels of both kinds all scores are the same. Other columns aren't read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            scores = [m.score(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
