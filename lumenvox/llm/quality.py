"""Quality classifier: an interpolated modified Kneser-Ney bigram model of the words of trusted text.

Counts of all languages come from trusted documents by two exchanges between chunks and shards
(``ngrams``): of pairs of words, and of words with what their pairs give them (totals and kinds
of followers as context, number of contexts as continuation). Every chunk then has all counts that its
documents need and sums up their log-probabilities. A text that is trusted itself is judged by the
counts without its own, so it is as new to the model as any other.

A document is rejected when its perplexity lies above the quantile of its language's trusted documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenvox.llm.common import SWEPT, Bucketed, cut, discard, lookup, release, scratch_path, settings, text_of, tidy
from lumenvox.llm.ngrams import ANSWER, CODED, MESSAGE, Chunk, answered, asked, coded, heard, key_bits, members, rows_of

#: The language number of the model of all trusted text, for null languages and those without trusted text.
POOLED = 0
#: Share of a language's trusted documents beyond its threshold.
TAIL = 0.0025
#: Words of average trusted text that a document counts for besides its own when it is compared with the thresholds.
PRIOR_WORDS = 10
_PAIRS_AT_ONCE = 1 << 17
#: While counts are exchanged, a worker is handed a few chunks at once.
_EXCHANGE = SWEPT | {"spark.sql.execution.arrow.maxBytesPerBatch": "8m"}
_RATES = ("d1", "d2", "d3", "e1", "e2", "e3", "pairs", "spread")


def _trained(row: dict, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Which documents of a chunk are counted, and which have the text of one that is."""
    flags = np.array(row["flags"] or [], np.int64)
    counted, known = np.zeros(n, bool), np.zeros(n, bool)
    known[flags >> 1] = True
    counted[flags[flags & 1 == 1] >> 1] = True
    return counted, known


def _ask_pairs(shards: int, bits: int):
    """Distinct pairs of each chunk and how often the counted documents have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            c = Chunk(row, bits)
            counted, _ = _trained(row, len(c.lengths))
            n = np.bincount(c.pair[counted[c.doc]], minlength=len(c.pair_keys))
            yield asked(row["chunk"], c.languages, c.of_pair, c.pair_keys, [n], shards, bits)

    return run


def _pair_totals(inverse: np.ndarray, columns: list[np.ndarray], n: int) -> tuple[list[np.ndarray], list[int]]:
    """Twice each pair's count, and one more in the first row that counted it; numbers of pairs with counts 1 to 4 and of all."""
    (own,) = columns
    total, first = np.zeros(n, np.int64), np.full(n, len(own))
    np.add.at(total, inverse, own)
    some = np.flatnonzero(own)
    np.minimum.at(first, inverse[some], some)
    answer = 2 * total[inverse]
    answer[first[first < len(own)]] += 1
    return [answer], [*[int((total == k).sum()) for k in (1, 2, 3, 4)], int((total > 0).sum())]


def _ask_words(shards: int, bits: int):
    """Distinct words of each chunk, with what the pairs that it answers for give them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            c = Chunk(row, bits)
            (pairs,) = heard(row["pairs"], c.languages, c.of_pair, c.pair_keys, 1, shards, bits)
            own = np.flatnonzero(pairs & 1)
            n, a = pairs[own] >> 1, c.first[own]
            total = np.zeros(len(c.word_keys), np.int64)
            np.add.at(total, a, n)
            kinds = [np.bincount(a[fits], minlength=len(total)) for fits in (n == 1, n == 2, n > 2)]
            ends = np.bincount(c.second[own], minlength=len(total))
            yield asked(row["chunk"], c.languages, c.of_word, c.word_keys, [total, *kinds, ends], shards, bits)

    return run


def _word_totals(inverse: np.ndarray, columns: list[np.ndarray], n: int) -> tuple[list[np.ndarray], list[int]]:
    """Sums of each word, and the numbers of words that follow 1 to 4 others or any."""
    sums = []
    for c in columns:
        total = np.zeros(n, np.int64)
        np.add.at(total, inverse, c)
        sums.append(total)
    ends = sums[-1]
    return [s[inverse] for s in sums], [*[int((ends == k).sum()) for k in (1, 2, 3, 4)], int((ends > 0).sum())]


def _discount(n: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Discount of counts ``n``; the columns of ``d`` are those of 1, 2 and more."""
    return np.where(n <= 0, 0.0, np.where(n == 1, d[:, 0], np.where(n == 2, d[:, 1], d[:, 2])))


def log_probabilities(n, total, lost, ends, rates) -> np.ndarray:
    """Natural logarithms of p(word | word before it).

    ``n``: count of the pair; ``total``, ``lost``: of the context, its count and the sum of its pairs'
    discounts; ``ends``: different contexts of the word; ``rates``: a row (``_RATES``) for each.
    """
    d, e, pairs, spread = rates[:, :3], rates[:, 3:6], rates[:, 6], rates[:, 7]
    low = np.maximum(ends - _discount(ends, e), 0) / pairs + spread
    seen = total > 0
    size = np.where(seen, total, 1)
    return np.log(np.maximum(n - _discount(n, d), 0) / size + np.where(seen, lost / size, 1.0) * low)


def _score(shards: int, bits: int):
    """Of each document: content, language, words, and its log-probability, without its own counts if it has the text of a counted one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["k", "g", "known", "n", "total"]
        for row in rows_of(batches):
            c = Chunk(row, bits)
            docs, n_words = len(c.lengths), len(c.word_keys)
            _, known = _trained(row, docs)
            (pairs,) = heard(row["pairs"], c.languages, c.of_pair, c.pair_keys, 1, shards, bits)
            total, k1, k2, k3, ends = heard(row["words_"], c.languages, c.of_word, c.word_keys, 5, shards, bits)
            rates = np.full((len(c.languages), len(_RATES)), np.nan)
            for r in row["rates"] or []:
                rates[np.searchsorted(c.languages, r["language"])] = [r[x] for x in _RATES]
            d = rates[:, :3][c.of_word]
            lost = k1 * d[:, 0] + k2 * d[:, 1] + k3 * d[:, 2]
            del d, k1, k2, k3
            # a pair once for each document that has it
            each, times = np.unique(c.doc * len(c.pair_keys) + c.pair, return_counts=True)
            del c.doc, c.pair
            n = pairs[each % max(1, len(c.pair_keys))] >> 1
            ends_at = np.searchsorted(each, np.arange(docs + 1) * len(c.pair_keys))
            sums, at = np.zeros(docs), 0
            while at < docs:  # whole documents, a bounded number of pairs at once
                upto = max(at + 1, int(np.searchsorted(ends_at, ends_at[at] + _PAIRS_AT_ONCE, "right")) - 1)
                part = slice(ends_at[at], ends_at[upto])
                doc, pair = each[part] // max(1, len(c.pair_keys)), each[part] % max(1, len(c.pair_keys))
                own = np.where(known[doc], times[part], 0)
                r = rates[c.of_doc[doc]]
                before, after = c.first[pair], c.second[pair]
                less = np.maximum(n[part] - own, 0)
                _, here = np.unique(doc * n_words + before, return_inverse=True)
                taken = np.bincount(here, weights=n[part] - less)[here]
                given = np.bincount(here, weights=_discount(n[part], r) - _discount(less, r))[here]
                _, here = np.unique(doc * n_words + after, return_inverse=True)
                gone = np.bincount(here, weights=(n[part] > 0) & (less == 0))[here]
                p = log_probabilities(less, total[before] - taken, np.maximum(lost[before] - given, 0), np.maximum(ends[after] - gone, 0), r)
                sums[at:upto] = np.bincount(doc - at, weights=p * times[part], minlength=upto - at)
                at = upto
            columns = [c.content, c.language, known, np.where(c.lengths > 0, c.lengths + 1, 0), sums]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names)

    return run


def _rates(pairs: Column, ends: Column) -> list[Column]:
    """Discounts and the rest of a language from its counts of counts (of 1 to 4, and all)."""

    def discounts(c: Column) -> list[Column]:
        n = [F.greatest(F.get(c, F.lit(i)), F.lit(1)) for i in range(4)]
        y = n[0] / (n[0] + 2 * n[1])
        return [F.least(F.greatest((i + 1) - (i + 2) * y * n[i + 1] / n[i], F.lit(0.01)), F.lit(i + 0.99)) for i in range(3)]

    d, e = discounts(pairs), discounts(ends)
    few = [F.get(ends, F.lit(i)) for i in range(2)]
    types, every = F.get(ends, F.lit(4)), F.get(pairs, F.lit(4))
    # what the discounts leave of each seen word is dealt to all words and one unseen word
    left = few[0] * e[0] + few[1] * e[1] + (types - few[0] - few[1]) * e[2]
    return [*[x.alias(f"d{i}") for i, x in enumerate(d, 1)], *[x.alias(f"e{i}") for i, x in enumerate(e, 1)], every.alias("pairs"), (left / every / (types + 1)).alias("spread")]


def _counts(answers: DataFrame) -> DataFrame:
    """The numbers of each language, summed over shards."""
    sums = [F.sum(F.get("counts", F.lit(i))).alias(f"c{i}") for i in range(5)]
    return answers.filter("chunk < 0").groupBy("language").agg(*sums).select("language", F.array(*[f"c{i}" for i in range(5)]).alias("counts"))


def _by_chunk(answers: DataFrame, name: str) -> DataFrame:
    return answers.filter("chunk >= 0").groupBy("chunk").agg(F.collect_list(F.struct("shard", "language", "n", "data")).alias(name)).hint("shuffle_hash")


def document_scores(rows: DataFrame, trusted: DataFrame) -> DataFrame:
    """k, g, known, n and total of each row (id, k: a hash of text and language, g, text); ``trusted`` has distinct ids (id).

    ``n`` counts the words and the end, 0 for a text without words; ``total`` is null for languages without counts.
    Of equal trusted texts one is counted. The result is computed at once.
    """
    with settings(rows.sparkSession, _EXCHANGE):
        return _document_scores(rows, trusted)


def _document_scores(rows: DataFrame, trusted: DataFrame) -> DataFrame:
    spark = rows.sparkSession
    shards = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bits = key_bits(rows.agg(F.sum(F.length("text"))).first()[0] or 0)
    tables = Bucketed(spark)
    keep = lambda df, deal=True: tables.keep(df.repartition(shards, "chunk") if deal else df, shards, "chunk", "zstd")
    try:
        chunks = keep(rows.select("id", "k", "g", "text").mapInArrow(tidy(coded(bits)), CODED), deal=False)
        every = chunks.select("chunk", "n_docs", "docs").mapInArrow(members, "chunk long, place long, id long, content long, language long")
        every = every.join(trusted.select("id", F.lit(True).alias("_trusted")), "id", "left")
        place = F.struct("chunk", "place")
        contents = cut(every.groupBy("content").agg(F.count("*").alias("weight"), F.min(F.when(F.col("_trusted"), place)).alias("first")).filter("first is not null"))
        flagged = lookup(every.select("chunk", "place", "content"), "content", contents, "weight", F.xxhash64("chunk", "place")).filter("first is not null")
        flag = F.col("place") * 2 + (F.col("first") == place).cast("long")
        flags = keep(flagged.select("chunk", flag.alias("flag")).groupBy("chunk").agg(F.collect_list("flag").alias("flags")))
        known = chunks.join(flags, "chunk", "left")

        def replies(ask, columns: int, summed) -> DataFrame:
            """What shards answer, by chunk. It is written before it is dealt to the chunks, so that the messages are gone by then."""
            messages = known.mapInArrow(tidy(ask(shards, bits)), MESSAGE).repartitionById(shards, F.col("shard"))
            answers, path = messages.mapInArrow(tidy(answered(columns, summed, shards, bits)), ANSWER), scratch_path(spark, "answers")
            answers.write.parquet(path)
            schema = answers.schema
            del messages, answers
            dealt = keep(spark.read.schema(schema).parquet(path))
            discard(spark, path)
            return dealt

        pairs = replies(_ask_pairs, 1, _pair_totals)
        known = known.join(_by_chunk(pairs, "pairs"), "chunk", "left")
        words = replies(_ask_words, 5, _word_totals)
        rates = _counts(pairs).withColumnRenamed("counts", "of_pairs").join(_counts(words), "language").filter(F.get("of_pairs", F.lit(4)) > 0)
        rates = cut(rates.select("language", *_rates(F.col("of_pairs"), F.col("counts"))))
        # a language's numbers go to the chunks that have it
        has = words.filter("chunk >= 0").select("chunk", "language").distinct()
        of_chunk = has.join(_few(rates), "language").groupBy("chunk").agg(F.collect_list(F.struct("language", *_RATES)).alias("rates"))
        scored = known.join(_by_chunk(words, "words_"), "chunk", "left").join(of_chunk, "chunk", "left").mapInArrow(tidy(_score(shards, bits)), "k long, g long, known boolean, n long, total double")
        release(spark)
        return cut(scored.withColumn("total", F.when(~F.isnan("total"), F.col("total"))))
    finally:
        tables.drop()


def _few(df: DataFrame) -> DataFrame:
    """A table of languages, broadcast unless it is very long."""
    return F.broadcast(df) if df.count() <= 10_000 else df


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", quality_col: str = "quality", tail: float = TAIL) -> DataFrame:
    """``docs`` as a struct row, with n_words, perplexity, compared, threshold and kept.

    ``perplexity`` is the text's own; ``compared`` is that of the text with PRIOR_WORDS average words of trusted text, since short texts vary, and
    a document is kept where ``compared`` is at most ``threshold``, the quantile of its language's trusted documents.
    The model and thresholds come from all of ``docs`` that ``labels`` (id, quality) call trusted, quality 1.
    A text without words has no perplexity and is not kept; where nothing is trusted, all texts
    with words are kept, without a perplexity. Null counts as the empty text; a null language and one without trusted
    text are judged by the model of all languages; a null id is never trusted. Repeated rows and equal
    texts are counted once and judged alike, one at the threshold is kept, a very long text is a chunk
    of its own, and an empty table gives no rows. Other columns stay in row, whatever their names.
    """
    id_, lang = F.col(id_col).cast("long"), F.col(lang_col).cast("string")
    trusted = labels.filter((F.col(quality_col) == 1) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id")).distinct()
    own = F.when(lang.isNotNull(), F.xxhash64(lang))
    plain = docs.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(docs.columns)], id_.alias("id"), text_of(text_col).alias("text"), own.alias("own"))
    worded = plain.select("id", "own", F.col("text").rlike(r"\S").alias("worded"))
    learned = cut(worded.filter("worded and own is not null").join(trusted, "id").select("own").distinct().withColumn("g", F.col("own")))
    others = not worded.select("own").distinct().join(learned, "own", "left_anti").isEmpty()
    plain = plain.join(_few(learned), "own", "left").withColumn("g", F.coalesce("g", F.lit(POOLED).cast("long"))).withColumn("k", F.xxhash64("text", "g"))
    rows = plain.select("id", "k", "g", "text")
    if others:  # all trusted text is counted once more as that of one language
        again = plain.filter(F.col("g") != POOLED).join(trusted, "id", "left_semi")
        rows = rows.unionByName(again.select("id", F.xxhash64("text", F.lit(POOLED).cast("long")).alias("k"), F.lit(POOLED).cast("long").alias("g"), "text"))
    same = [F.first(c).alias(c) for c in ("g", "known", "n", "total")]
    scores = cut(document_scores(rows, trusted).groupBy("k").agg(*same, F.count("*").alias("weight")))
    sample = scores.filter("known and n > 0 and total is not null")
    means = cut(sample.groupBy("g").agg((-F.sum("total") / F.sum("n")).alias("mean")))
    loss = (F.col("mean") * PRIOR_WORDS - F.col("total")) / (F.col("n") + PRIOR_WORDS)
    limits = sample.join(_few(means), "g").groupBy("g").agg(F.percentile_approx(loss, F.lit(1 - tail), F.lit(10_000)).alias("high"))
    limits = cut(limits.join(means, "g"))
    found = scores.join(_few(limits), "g", "left")
    worded = F.col("n") > 0
    found = found.withColumns({"compared": F.when(worded, F.exp(loss)), "threshold": F.exp("high")})
    kept = worded & F.coalesce(F.col("compared") <= F.col("threshold"), F.lit(True))
    perplexity = F.when(worded, F.exp(-F.col("total") / F.col("n")))
    found = found.select("k", "weight", F.greatest(F.col("n") - 1, F.lit(0)).alias("n_words"), perplexity.alias("perplexity"), "compared", "threshold", kept.alias("kept"))
    dealt = plain.drop("id", "text", "own", "g").withColumn("_deal", F.monotonically_increasing_id())
    joined = lookup(dealt, "k", cut(found), "weight", F.col("_deal"))
    row = F.struct(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)]).alias("row")
    return joined.select(row, "n_words", "perplexity", "compared", "threshold", "kept")


def quality_filter(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with their columns; cases are those of ``judged``."""
    return judged(docs, labels, **options).filter("kept").select("row.*")
