"""Toxicity by subword-bag embeddings under a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lumberline.llm.common import OWN, crc_mod, give_back, of
from lumberline.llm.words import Words, flat, slices

BUCKETS = 1 << 18
GRAMS = (3, 4, 5, 6)
DIMENSIONS = 8
#: The fit uses so many labelled rows of each class at most.
SAMPLE_ROWS = 2500
#: A text is judged by so many of its words, each once, the strongest ones wherever they stand.
STRONGEST = 3
EPOCHS, BATCH, RATE = 8, 128, 0.05
#: The first epoch, when no word is stronger than another, takes so many words of each text, drawn by chance.
DRAWN = 32
#: Small samples are gone through more often, for so many steps at least.
LEAST_STEPS = 150
#: Parts that the sample is cut into to learn the scale of the scores on texts that a fit has not seen.
FOLDS = 4
#: How far the scale is drawn to that of the fit, and the steps of Newton's method for it.
SCALE_RIDGE, SCALE_STEPS = 0.1, 50
THRESHOLD = 0.7
#: Words whose subwords are made at once.
CHUNK = 1 << 15
#: Bytes of text scored at once.
SLICE = 1 << 20


class Model(NamedTuple):
    """A bag of words scores ``mean(weights[subword]) + bias``, the log odds of label 1."""

    weights: np.ndarray
    bias: float
    #: The log odds of label 1 among all texts, for a text without words.
    prior: float


def subwords(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The word and the bucket of each byte n-gram of ``<word>``."""
    if not len(words):
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    letters, offsets = flat(words)
    inner = np.diff(offsets)
    sizes = inner + 2
    ends = np.cumsum(sizes)
    data = np.empty(ends[-1], np.uint64)
    data[np.arange(len(letters)) + 2 * np.repeat(np.arange(len(inner)), inner) + 1] = letters
    data[ends - sizes], data[ends - 1] = ord("<"), ord(">")
    left = np.repeat(ends, sizes) - np.arange(len(data))
    owner = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    owners, buckets = [], []
    value = np.zeros(len(data), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        shifted = np.zeros(len(data), np.uint64)
        later = data[n - 1 :]
        shifted[: len(later)] = later
        value = (value + shifted + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        if n in GRAMS:
            fits = left >= n
            mixed = value[fits] + np.uint64(n)
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            owners.append(owner[fits])
            buckets.append(((mixed >> np.uint64(40)) % np.uint64(BUCKETS)).astype(np.int32))
    return np.concatenate(owners), np.concatenate(buckets)


class Bags:
    """The distinct words of some texts; text ``t`` has ``word[first[t]:first[t + 1]]``."""

    def __init__(self, texts: pa.Array):
        words = Words(texts, lower=True)
        codes, distinct = words.coded()
        self.texts, self.words = len(words.first) - 1, len(distinct)
        pairs = words.document() * np.int64(max(1, self.words))
        pairs += codes
        pairs = np.unique(pairs)
        self.text, self.word = (x.astype(np.int32) for x in np.divmod(pairs, np.int64(max(1, self.words))))
        del pairs, codes, words
        self.first = np.searchsorted(self.text, np.arange(self.texts + 1))
        sizes, grams = [np.zeros(1, np.int64)], [np.zeros(0, np.int32)]
        for start in range(0, self.words, CHUNK):
            owner, bucket = subwords(distinct.slice(start, CHUNK))
            order = np.argsort(owner, kind="stable")
            sizes.append(np.bincount(owner, minlength=min(CHUNK, self.words - start)))
            grams.append(bucket[order])
        self.grams = np.concatenate(grams)
        #: Where the subwords of each word begin, and the end.
        self.begin = np.cumsum(np.concatenate(sizes))

    def of_words(self, weights: np.ndarray) -> np.ndarray:
        """The mean of each word's subwords; the shortest word has one."""
        weights, sums = weights.astype(np.float32), np.zeros(self.words)
        for start in range(0, self.words, CHUNK):
            begin = self.begin[start : start + CHUNK + 1]
            own = weights[self.grams[begin[0] : begin[-1]]]
            sums[start : start + CHUNK] = np.add.reduceat(own, begin[:-1] - begin[0], dtype=np.float64)
        return sums / np.diff(self.begin)

    def strongest(self, of_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The mean of the ``STRONGEST`` words of each text, and which they are (-1: it has fewer).

        What is missing counts as words that say nothing.
        """
        value = of_word[self.word].astype(np.float64)
        mean, chosen = np.zeros(self.texts), np.full((self.texts, STRONGEST), -1, np.int64)
        some = np.flatnonzero(np.diff(self.first) > 0)
        for k in range(STRONGEST):
            best = np.full(self.texts, -np.inf)
            if len(some):
                best[some] = np.maximum.reduceat(value, self.first[some])
            at = np.flatnonzero(value == best[self.text])[::-1]  # the first of equal ones is set last
            pick = np.full(self.texts, -1, np.int64)
            pick[self.text[at]] = at
            have = np.flatnonzero(np.diff(self.first) > k)
            chosen[have, k] = self.word[pick[have]]
            mean[have] += best[have]
            value[pick[have]] = -np.inf
        return mean / STRONGEST, chosen

    def odds(self, weights: np.ndarray, bias: float) -> np.ndarray:
        return self.strongest(self.of_words(weights))[0] + bias


def scores(model: Model, texts: pa.Array) -> np.ndarray:
    """The chance of label 1 for each whole text."""
    bags = Bags(texts)
    odds = np.where(np.diff(bags.first) > 0, bags.odds(model.weights, model.bias), model.prior)
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit(texts: pa.Array, toxic: np.ndarray, weight: np.ndarray, seed: int = 7) -> Model:
    """A model of some texts. Same input, same model.

    The scale of its scores is learnt on texts that it has not seen: each part of the sample is scored by a fit to the
    others, and a logistic curve over these scores gives the scale and the bias, since a fit finds the
    texts it learnt from far surer than new ones.
    """
    bags, rows = Bags(texts), np.arange(len(toxic))
    rng = np.random.default_rng(seed)
    fold = np.zeros(len(toxic), np.int64)
    for label in (0, 1):
        own = np.flatnonzero(toxic == label)
        fold[rng.permutation(own)] = np.arange(len(own)) % FOLDS
    # Subwords are numbered among those that occur, by which embeddings are kept.
    occurs, place, gram_of = np.zeros(BUCKETS, bool), np.zeros(BUCKETS, np.int32), np.empty_like(bags.grams)
    parts = [slice(a, a + (CHUNK << 4)) for a in range(0, len(bags.grams), CHUNK << 4)]
    for part in parts:
        occurs[bags.grams[part]] = True
    used = np.flatnonzero(occurs)
    place[used] = np.arange(len(used), dtype=np.int32)
    for part in parts:
        gram_of[part] = place[bags.grams[part]]
    unseen = np.zeros(len(toxic))
    for k in range(FOLDS):
        others = rows[fold != k]
        if len(set(toxic[others])) == 2:
            unseen[fold == k] = bags.odds(*_trained(bags, used, gram_of, others, toxic, weight, seed))[fold == k]
    weights, bias = _trained(bags, used, gram_of, rows, toxic, weight, seed)
    scale, shift = _scale(unseen, toxic, weight)
    share = np.bincount(toxic, weight, 2) + 0.5
    return Model((weights * scale).astype(np.float32), bias * scale + shift, float(np.log(share[1] / share[0])))


def _scale(odds: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Scale and shift of the logistic curve through the labels, by Newton's method."""
    x = np.stack([odds, np.ones(len(odds))], 1)
    found, ridge = np.array([1.0, 0.0]), np.diag([SCALE_RIDGE * max(odds.var(), 1e-6), 0.0])
    for _ in range(SCALE_STEPS):
        chance = 1 / (1 + np.exp(-np.clip(x @ found, -30, 30)))
        slope = x.T @ ((chance - toxic) * weight) + ridge @ (found - [1.0, 0.0])
        curve = (x * (weight * chance * (1 - chance) + 1e-9)[:, None]).T @ x + ridge + 1e-9 * np.eye(2)
        step = np.clip(np.linalg.solve(curve, slope), -2, 2)
        found = found - step
        if np.abs(step).max() < 1e-8:
            break
    return max(float(found[0]), 1e-3), float(found[1])


def _trained(
    bags: Bags, used: np.ndarray, gram_of: np.ndarray, rows: np.ndarray, toxic: np.ndarray, weight: np.ndarray, seed: int
) -> tuple[np.ndarray, float]:
    """Weights of the subwords and the bias: embeddings and softmax together, by Adam on the weighted log loss.

    The first epoch averages over words drawn from a text; then each epoch takes those that the model so far
    finds strongest, so a few words weigh as much in a long text as in a short one. Only embeddings
    that a step reads are changed by it.
    """
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.05, (len(used), DIMENSIONS))
    top, bias = rng.normal(0, 1, (DIMENSIONS, 2)), np.zeros(2)
    moments = [(p, np.zeros_like(p), np.zeros_like(p)) for p in (table, top, bias)]
    target, seen = np.eye(2)[toxic], np.zeros(len(used), bool)
    batches, step = -(-len(rows) // BATCH), 0
    for epoch in range(max(EPOCHS, -(-LEAST_STEPS // batches))):
        if epoch == 0:
            chosen = _drawn(bags, rng)
        else:
            weights = np.zeros(BUCKETS)
            weights[used] = table @ (top[:, 1] - top[:, 0])
            _, chosen = bags.strongest(bags.of_words(weights))
        for batch in np.array_split(rng.permutation(rows), batches):
            text, gram, share = _bag(bags, batch, chosen, gram_of)
            order = np.argsort(gram, kind="stable")
            begin = np.flatnonzero(np.diff(gram[order], prepend=-1))
            touched = gram[order[begin]]
            seen[touched] = True
            vectors = np.zeros((len(batch), DIMENSIONS))
            of_text = np.flatnonzero(np.diff(text, prepend=-1))  # texts come in order
            if len(text):
                vectors[text[of_text]] = np.add.reduceat(table[gram] * share[:, None], of_text)
            logits = vectors @ top + bias
            chance = np.exp(logits - logits.max(1, keepdims=True))
            chance /= chance.sum(1, keepdims=True)
            error = (chance - target[batch]) * weight[batch, None] / len(batch)
            back = error @ top.T
            d_table = np.zeros((len(touched), DIMENSIONS))
            if len(text):
                d_table = np.add.reduceat(back[text[order]] * share[order, None], begin)
            step += 1
            for (value, m, v), grad, own in zip(
                moments, (d_table, vectors.T @ error, error.sum(0)), (touched, slice(None), slice(None))
            ):
                m[own] += 0.1 * (grad - m[own])
                v[own] += 0.001 * (grad**2 - v[own])
                value[own] -= RATE * (m[own] / (1 - 0.9**step)) / (np.sqrt(v[own] / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(BUCKETS)
    weights[used[seen]] = (table @ (top[:, 1] - top[:, 0]))[seen]  # others are still what they were drawn as
    return weights, float(bias[1] - bias[0])


def _drawn(bags: Bags, rng: np.random.Generator) -> np.ndarray:
    """``DRAWN`` words of each text, drawn with repetition; all -1 where it has none."""
    counts = np.diff(bags.first)
    at = bags.first[:-1, None] + (rng.random((bags.texts, DRAWN)) * counts[:, None]).astype(np.int64)
    some = np.broadcast_to(counts[:, None] > 0, at.shape)
    return np.where(some, bags.word[np.where(some, at, 0)] if len(bags.word) else -1, -1)


def _bag(
    bags: Bags, rows: np.ndarray, chosen: np.ndarray, gram_of: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, subword and share of each subword of the chosen words; shares add up to one at most."""
    text, k = np.nonzero(chosen[rows] >= 0)
    word = chosen[rows][text, k]
    sizes = bags.begin[word + 1] - bags.begin[word]
    owner, at = _ranges(bags.begin[word], sizes)
    return text[owner], gram_of[at], 1 / (chosen.shape[1] * sizes[owner])


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers from each start on, one range after the other, and the range of each."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    before = np.cumsum(sizes) - sizes
    return owner, starts[owner] + np.arange(len(owner)) - before[owner]


def _distinct_words(text: Column) -> Column:
    """A text's words in lower case, each once; null has none. All that the fit looks at, whatever the text's length."""
    return F.array_join(F.array_distinct(F.split(F.coalesce(_lower(text), F.lit("")), r"[\x20\x09-\x0D]+")), " ")


def _lower(text: Column) -> Column:
    """A to Z alone."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from labelled documents whose crc32(id) mod 3 is not 1.

    ``labels`` has the id and ``toxic``. Of each class at most ``SAMPLE_ROWS`` rows are used, drawn
    by a hash of the id, whole texts as their distinct words, which are cut out in the tasks; classes weigh as in all
    labelled rows. Rows whose label is null don't count; of several labels of one id the largest does.
    Without labelled rows of both classes the model is the prior.
    """
    known = (
        labels.select(labels[id_col].alias(OWN + "id"), labels["toxic"].cast("int").alias(OWN + "toxic"))
        .filter(F.col(OWN + "toxic").isin(0, 1) & F.col(OWN + "id").isNotNull())
        .filter(crc_mod(F.col(OWN + "id"), 3) != 1)
        .groupBy(OWN + "id").agg(F.max(OWN + "toxic").alias(OWN + "toxic"))
    )
    share = {r[0]: r[1] for r in known.groupBy(OWN + "toxic").count().collect()}
    drawn = [
        known.filter(F.col(OWN + "toxic") == c).orderBy(F.xxhash64(OWN + "id"), OWN + "id").limit(SAMPLE_ROWS)
        for c in (0, 1)
    ]
    # Bounded by the limits above.
    sample = F.broadcast(drawn[0].unionByName(drawn[1]))
    texts = of(docs, id=id_col, text=text_col)
    chosen = texts.join(sample, OWN + "id").withColumn(OWN + "text", _distinct_words(F.col(OWN + "text")))
    rows = chosen.orderBy(OWN + "id", OWN + "text").toArrow()
    toxic = rows.column(OWN + "toxic").to_numpy().astype(np.int64)
    n = np.maximum(np.bincount(toxic, minlength=2), 1)
    if min(share.get(0, 0), share.get(1, 0)) == 0 or len(toxic) == 0 or len(set(toxic)) < 2:
        odds = np.log((share.get(1, 0) + 0.5) / (share.get(0, 0) + 0.5))
        return Model(np.zeros(BUCKETS, np.float32), float(odds), float(odds))
    weight = np.array([share[0], share[1]]) / n
    weight = (weight * len(toxic) / (share[0] + share[1]))[toxic]
    return fit(pa.concat_arrays(rows.column(OWN + "text").chunks), toxic, weight)


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = OWN + "score") -> DataFrame:
    """``docs`` with the score of each whole text; null and empty texts get that of no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col)
            for start, stop in slices(texts, SLICE):
                part = batch.slice(start, stop - start)
                found = scores(model, part.column(text_col))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found)], [*part.schema.names, score_col]
                )
            give_back()

    schema = docs.schema
    return docs.mapInArrow(run, type(schema)([*schema.fields]).add(score_col, "double"))
