"""Toxicity by multiple-instance learning.

A document is a bag of sentences, and only its label is known. Each sentence has a score
``p = sigmoid(bias + sum of word weights)``; the document's score is their noisy-or, ``1 - prod(1 - p)``: one toxic
sentence is enough. The weights maximise the likelihood of the document labels with an L1 penalty, by proximal AdaGrad
over all documents of a bounded sample. The trained sentence scores then locate the offending sentences.

Words are runs of letters, digits and non-ASCII bytes in lower case, hashed to ``BUCKETS`` weights; a sentence ends at
``. ! ?`` or a line end. Nothing but the text enters a score. Texts that are null or have no words score 0.

The sample holds at most ``sample_rows`` labelled documents of ``sample_words`` words together, chosen by hash; scoring covers every whole text in one pass.
Without labels of both classes nothing can be learned and every score is 0. Repeated rows are scored alike; a
doc_id may be null. Extra columns are ignored by ``score_toxicity`` and kept by ``drop_toxic``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .exchange import stage, unstage
from .samples import labelled_sample
from .textblocks import Words, chunks, words

BUCKETS = 1 << 17
SAMPLE_ROWS = 12000
SAMPLE_WORDS = 8_000_000
LEAST_DOCS = 5
_APART = np.ones(256, dtype=bool)
_APART[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_ENDS = np.zeros(256, dtype=bool)
_ENDS[[10, 33, 46, 63]] = True


def sentences(data: np.ndarray, begin: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words of a chunk, their buckets, and the index of the first word of each sentence."""
    w = words(data, begin, _APART)
    if not len(w.start):
        return w, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    number = np.cumsum(_ENDS[data])[w.start]
    new = np.append(True, (number[1:] != number[:-1]) | (w.doc[1:] != w.doc[:-1]))
    return w, (w.hashes(lower=True) % np.uint64(BUCKETS)).astype(np.int64), np.flatnonzero(new)


def fit_noisy_or(word: np.ndarray, sentence: np.ndarray, doc: np.ndarray, label: np.ndarray, steps: int = 200,
                 penalty: float = 4e-5, rate: float = 0.5, telling: float = 1.0) -> tuple[np.ndarray, float]:
    """Weights by bucket and the bias. ``sentence`` numbers the sentence of each word, ``doc`` the document of each
    sentence, ``label`` the class of each document; both numbers ascend.

    The first half selects words, with an L1 penalty; the second fits the words of a weight over ``telling`` again
    without it, as the penalty holds their weights down and thereby the bias up. A leak, the chance of a toxic label
    without any toxic sentence, is fitted along and takes up wrong labels, so that they do not raise the score of long
    clean documents. It is no part of a score.
    """
    n, n_docs = len(doc), max(1, len(label))
    # words of few documents tell nothing that holds elsewhere
    first = np.searchsorted(sentence, np.searchsorted(doc, np.arange(len(label) + 1)))
    held = np.zeros(BUCKETS, dtype=np.int64)
    for low, high in zip(first[:-1], first[1:]):
        held[np.unique(word[low:high])] += 1
    keep = held >= LEAST_DOCS

    def descend(weights, bias, leak, keep, penalty):
        use = keep[word]
        words_, sentences_ = word[use], sentence[use]
        weights = np.where(keep, weights, 0.0)
        square, square_bias, square_leak = np.full(BUCKETS, 1e-8), 1e-8, 1e-8
        for _ in range(steps):
            z = bias + np.bincount(sentences_, weights=weights[words_], minlength=n)
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            none = np.exp(np.bincount(doc, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(label)))
            chance = 1 / (1 + np.exp(-leak))
            some = np.maximum(1 - (1 - chance) * none, 1e-9)
            pull = np.where(label == 1, -(1 - chance) * none / some, 1.0)[doc] * p / n_docs
            slope_leak = np.where(label == 1, -none * (1 - chance) / some, 1.0).sum() * chance / n_docs
            slope = np.bincount(words_, weights=pull[sentences_], minlength=BUCKETS)
            square += slope ** 2
            step = rate / np.sqrt(square)
            weights = weights - step * slope
            weights = np.sign(weights) * np.maximum(np.abs(weights) - step * penalty, 0)
            slope_bias = pull.sum()
            square_bias += slope_bias ** 2
            bias -= rate / np.sqrt(square_bias) * slope_bias
            square_leak += slope_leak ** 2
            leak -= rate / np.sqrt(square_leak) * slope_leak
        return weights, bias, leak

    weights, bias, leak = descend(np.zeros(BUCKETS), -5.0, -4.0, keep, penalty)
    if (weights > telling).any():
        weights, bias, _ = descend(weights, bias, leak, weights > telling, 0.0)
    return weights, float(bias)


def _featurise(batches):
    for batch in batches:
        label = batch.column("label").to_pylist()
        rows = []
        for low, high, data, begin in chunks(batch.column("text")):
            w, bucket, heads = sentences(data, begin)
            lengths = np.diff(np.append(heads, len(bucket))).astype(np.int32)
            of = w.doc[heads]
            edge = np.searchsorted(of, np.arange(high - low + 1))
            for d in range(high - low):
                rows.append((bucket[w.first[d]:w.first[d + 1]].astype(np.int32).tobytes(),
                             lengths[edge[d]:edge[d + 1]].tobytes(), label[low + d]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([r[0] for r in rows], pa.binary()),
                                          pa.array([r[1] for r in rows], pa.binary()),
                                          pa.array([r[2] for r in rows], pa.int32())],
                                         names=["doc_id", "words", "lengths", "label"])


def longest_that_fit(n_words: list[int], total: int) -> int:
    """The greatest length such that all documents up to it have at most ``total`` words together (-1: none)."""
    lengths, count = np.unique(np.array(n_words, dtype=np.int64), return_counts=True)
    fit = np.searchsorted(np.cumsum(lengths * count), total, side="right")
    return int(lengths[fit - 1]) if fit else -1


def train_toxicity(documents: DataFrame, labels: DataFrame, learnable: Column, label: str = "toxic",
                   sample_rows: int = SAMPLE_ROWS, sample_words: int = SAMPLE_WORDS) -> tuple[np.ndarray, float]:
    """Weights and bias from at most ``sample_rows`` labelled documents with ``learnable`` (a condition on doc_id).

    What reaches the driver is bounded by rows and by words: one text a doc_id (the least, where rows share it), and of
    a sample of more than ``sample_words`` words the longest documents are left out of the fit.
    """
    sample = labelled_sample(labels, label, learnable, sample_rows)
    texts = (documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
             .groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label")))
    staged = stage(texts.mapInArrow(_featurise, "doc_id long, words binary, lengths binary, label int"), "toxicity-sample")
    size = F.length("words") / 4
    longest = longest_that_fit([int(r[0]) for r in staged.select(size).collect()], sample_words)
    rows = sorted(staged.filter(size <= longest).collect(), key=lambda r: r["doc_id"])
    unstage(staged)
    y = np.array([r["label"] for r in rows], dtype=np.int64)
    if len(set(y.tolist())) < 2:
        return np.zeros(BUCKETS, dtype=np.float32), -40.0
    word = np.concatenate([np.frombuffer(r["words"], np.int32) for r in rows])
    lengths = [np.frombuffer(r["lengths"], np.int32) for r in rows]
    doc = np.repeat(np.arange(len(rows)), [len(x) for x in lengths])
    sentence = np.repeat(np.arange(len(doc), dtype=np.int32), np.concatenate(lengths))
    del rows, lengths
    weights, bias = fit_noisy_or(word, sentence, doc, y)
    return weights.astype(np.float32), bias


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])


def _score(weights: np.ndarray, bias: float, drop: float | None):
    def of_chunk(data, begin):
        """Score of each text; of each sentence its text, first and last word, and score."""
        w, bucket, heads = sentences(data, begin)
        if not len(heads):
            return np.zeros(len(begin) - 1), w, heads, heads, np.zeros(0)
        z = np.clip(bias + np.add.reduceat(weights[bucket].astype(np.float64), heads), -30, 30)
        p = 1 / (1 + np.exp(-z))
        none = np.bincount(w.doc[heads], weights=-np.logaddexp(0, z), minlength=len(begin) - 1)
        return -np.expm1(none), w, heads, np.append(heads[1:], len(bucket)) - 1, p

    def run(batches):
        for batch in batches:
            scores, spans = [], [[] for _ in range(batch.num_rows)]
            for low, _, data, begin in chunks(batch.column("text")):
                score, w, head, last, p = of_chunk(data, begin)
                scores.append(score)
                if drop is None and (bad := np.flatnonzero(p >= 0.5)).size:
                    point = np.append(0, np.cumsum((data & 0xC0) != 0x80))     # code points before each byte
                    for s in bad:
                        d = w.doc[head[s]]
                        spans[low + d].append({"start": int(point[w.start[head[s]]] - point[begin[d]]),
                                               "end": int(point[w.end[last[s]]] - point[begin[d]]), "score": float(p[s])})
            score = np.concatenate(scores) if scores else np.zeros(0)
            if drop is not None:
                yield batch.filter(pa.array(score < drop))
            else:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), pa.array(spans, pa.list_(_SPAN))],
                                                 names=["doc_id", "score", "offending"])
    return run


def score_toxicity(documents: DataFrame, weights: np.ndarray, bias: float) -> DataFrame:
    """(doc_id, score, offending) of each row; ``offending`` holds the sentences of score 0.5 or more, as code points
    [start, end) of the text and their score."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _score(weights, bias, None), "doc_id long, score double, offending array<struct<start:long,end:long,score:double>>")


def drop_toxic(documents: DataFrame, weights: np.ndarray, bias: float, threshold: float = 0.5) -> DataFrame:
    """The rows of ``documents`` whose score is below ``threshold``, unchanged."""
    return documents.mapInArrow(_score(weights, bias, threshold), documents.schema)
