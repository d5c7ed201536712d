"""Language-model scores: a log-bilinear model, trained by noise-contrastive estimation.

The model predicts a word from the one before: the score of a pair is the bilinear form of the
two words' vectors plus the word's bias. It knows the most frequent training words, the end of a
text and one class for all other words; within that class, words go by their smoothed counts.
All training texts are counted: pairs of classes are summed by Spark into a square table of
fixed size, from which the contrastive objective and its gradients are exact, with the noise
distribution in place of drawn noise. Scoring reads normalised log-probabilities from the
product of all vectors.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinflat.llm.common import in_small_batches, staged, text_of

#: Classes of all words that the model does not know, and of the end of a text.
OTHER, END = 0, 1
#: The end of a text among words; no word is empty.
END_WORD = b""
#: Distinct words that a task counts before it passes them on.
HELD_WORDS = 300_000


def held_out(id_col: str) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, mod 5, is 1. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 1


def words_in(text: str) -> list[bytes]:
    return text.encode().lower().split()


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows (word, n) of all texts, their ends included; tasks pass on sums."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            columns = [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(words_in(text))
                seen[END_WORD] += 1
                if len(seen) > HELD_WORDS:
                    yield rows()
                    seen.clear()
        yield rows()

    in_small_batches(docs.sparkSession, 500)
    parts = docs.select(text_of(text_col).alias("text")).mapInArrow(counted, "word binary, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def _most_frequent(counts: DataFrame, listed: int) -> DataFrame:
    """The words counted as often as a limit, the lowest that leaves `listed` of them at most, and the end."""
    by_n = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    upto = by_n.select("n", F.sum("words").over(Window.orderBy(F.col("n").desc())).alias("upto"))
    limit = upto.where(F.col("upto") <= listed).agg(F.min("n")).first()[0]
    # a text's end is listed in any case
    return counts.where((F.col("n") >= F.lit(limit)) | (F.octet_length("word") == 0))


def pair_counts(docs: DataFrame, class_of: dict[bytes, int], classes: int, text_col: str = "text") -> np.ndarray:
    """Square table of how often class b follows class a; a text starts after an end."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(classes * classes, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                known = class_of.get
                row = np.array([END, *[known(w, OTHER) for w in words_in(text)], END])
                cells, n = np.unique(row[:-1] * classes + row[1:], return_counts=True)
                total[cells] += n
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], ["cell", "n"])

    in_small_batches(docs.sparkSession, 500)
    parts = docs.select(text_of(text_col).alias("text")).mapInArrow(counted, "cell long, n long")
    found = parts.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # classes squared rows at most
    table = np.zeros(classes * classes)
    table[found["cell"].to_numpy()] = found["n"].to_numpy()
    return table.reshape(classes, classes)


def train(pairs: np.ndarray, width: int = 48, noise: int = 20, steps: int = 250, decay: float = 10.0, seed: int = 42) -> np.ndarray:
    """Normalised log10-probabilities [before, word] of a log-bilinear model of the counted pairs.

    score(a, w) = (R_a C) . R_w + b_w. The objective tells a pair of the data from one whose word
    is drawn from the noise, the words' own distribution, `noise` times as often; its expectation
    over the noise is a sum over the table. Vectors decay as if each had `decay` tokens of evidence
    for zero, which the data outgrow. Steps are Adam's.
    """
    n = len(pairs)
    rng = np.random.default_rng(seed)
    by_word = pairs.sum(axis=0) + 0.5
    p_noise = by_word / by_word.sum()
    total = max(pairs.sum(), 1.0)
    data = pairs / total
    drawn = noise * data.sum(axis=1)[:, None] * p_noise
    log_noise = np.log(noise * p_noise)
    values = [rng.normal(0, 0.1, (n, width)), np.eye(width), np.log(p_noise)]
    moments = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
    for step in range(1, steps + 1):
        vectors, turn, bias = values
        turned = vectors @ turn
        margin = turned @ vectors.T + bias - log_noise
        right = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        error = data * (1 - right) - drawn * right
        slopes = [
            error @ vectors @ turn.T + error.T @ turned - decay / total * vectors,
            vectors.T @ (error @ vectors) - decay / total * turn,
            error.sum(axis=0),
        ]
        rate = 0.05 * min(1.0, 2 * (1 - step / (steps + 1)))
        for value, slope, (mean, square) in zip(values, slopes, moments):
            mean += 0.1 * (slope - mean)
            square += 0.001 * (slope**2 - square)
            value += rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-10)
    vectors, turn, bias = values
    scores = vectors @ turn @ vectors.T + bias
    scores -= scores.max(axis=1, keepdims=True)
    return (scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))) / math.log(10)


def score(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    classes: int = 1024,
    listed: int = 200_000,
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Words are lower-cased from A to Z; the end of a text is a token of its own, so that a text
    without words, null included, has one token. Documents that are not held out are trained on,
    all of them. Rows that repeat an id are scored each. Where nothing is left to train on, the
    one unseen word has all probability and scores follow from the model's start. Other columns
    are ignored.

    The counts of the `listed` most frequent words and the model (classes squared numbers) go to
    every task; counts of rarer words are joined. Both are bounded by their parameters.
    """
    training = docs.where(~held_out(id_col))
    counts = staged(word_counts(training, text_col), "word-counts")
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    top = _most_frequent(counts, listed).orderBy(F.col("n").desc(), "word").collect()  # `listed` rows at most
    place = {bytes(row.word): k for k, row in enumerate(top)}
    times = np.array([row.n for row in top], np.float64)
    words = [w for w in place if w != END_WORD][: classes - 2]
    class_of = {w: k + 2 for k, w in enumerate(words)} | {END_WORD: END}
    logs = train(pair_counts(training, class_of, classes, text_col))

    log_all = math.log10(n + 0.5 * (v + 1))
    modelled = sum(times[place[w]] + 0.5 for w in class_of if w in place)
    log_other = math.log10(n + 0.5 * (v + 1) - modelled) if n else 0.0
    class_at = np.array([class_of.get(w, OTHER) for w in place] + [OTHER], np.int64)
    log_at = np.append(np.log10(times + 0.5), 0.0)
    end_at = place.get(END_WORD, -1)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            out = []
            for text in batch.column(2).to_pylist():
                found = words_in(text)
                at = np.array([*[place.get(w, -1) for w in found], end_at])
                kinds = class_at[at]
                kinds[-1] = END
                other = kinds == OTHER
                path = logs[np.append(END, kinds[:-1]), kinds].sum()
                listed_log = log_at[at].sum() + (math.log10(0.5) if end_at < 0 else 0.0)
                within = log_at[at][other].sum() - log_other * other.sum()
                rare = Counter([w for w, k in zip(found, at) if k < 0])
                number += 1
                out.append(
                    (number, len(at), int((at >= 0).sum()), listed_log - len(at) * log_all, path + within, list(rare.items()))
                )
            columns = list(zip(*out)) or [()] * len(kinds_out)
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds_out)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names)

    names = ["doc_id", "held_out", "row", "n_tokens", "n_known", "base", "model", "rare"]
    rare_kind = pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())]))
    kinds_out = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), rare_kind]
    schema = (
        f"doc_id {dict(docs.dtypes)[id_col]}, held_out boolean, row long, n_tokens long, n_known long, "
        "base double, model double, rare array<struct<word:binary,times:long>>"
    )
    in_small_batches(docs.sparkSession, 500)
    source = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), text_of(text_col).alias("text"))
    scored = staged(source.mapInArrow(rows, schema), "scored")
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.times")
    joined = rare.join(counts, "word", "left")
    sums = joined.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rare_log"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
    )
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    return scored.drop("rare").join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("base") + rare_log).alias("base_score"),
        (F.col("model") + rare_log).alias("score"),
    )
