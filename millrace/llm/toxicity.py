"""Toxicity: non-negative positive-unlabelled learning.

Only the confirmed toxic examples are taken at their word; all other training texts, toxic or not, are
unlabelled. With the class prior ``p``, the risk of a classifier is

    p * E+[loss(+)]  +  max(0, Eu[loss(-)] - p * E+[loss(-)])

where ``E+`` runs over toxic and ``Eu`` over unlabelled examples. The second term estimates the risk on
clean text; it is kept from going below zero, where a flexible model would only fit noise: then a step
reduces the overfit instead (non-negative risk estimator).

Several logistic classifiers are trained, each by numpy in a task of its own on a bounded, hash-chosen
share of the training texts, and their scores are averaged. Features are the words of a text and the
beginnings of its words, each once, known by a 64-bit hash; a classifier keeps those whose share among toxic
texts differs clearly from that among unlabelled ones. Every text is scored whole.

Defined results: null and empty texts get the score of a text without known words. Without any toxic
example nothing can be learned and every score is 0. Repeated ids among labels count once; repeated rows of
documents are scored each. Null ids are scored like others and never trained on. Scores are from text only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.words import IS_MARK, U64, as_bytes, folded, hash_ranges, mix, slices, word_bounds

CLASSIFIERS = 4
# training texts for each classifier, at most
TOXIC_TEXTS = 2_500
UNLABELLED_TEXTS = 5_000
FEATURES = 4_096
# a feature is in so many toxic texts at least, and its share differs by so much in logarithm and in standard errors
LEAST_TEXTS = 3
LEAST_RATIO = 0.7
LEAST_DISTANCE = 2.5
# bytes of the beginnings of words that are features beside the words: inflected forms share them
BEGINNINGS = (4, 5)
STEPS = 400
RATE = 0.1
DECAY = 1e-5


@dataclass(frozen=True)
class Classifier:
    words: np.ndarray
    weights: np.ndarray
    bias: float


def held_out(ident: Column, folds: int = 5) -> Column:
    """Whether an id falls into the share that is never trained on."""
    return F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")) % folds == 0


def features_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of all texts and of their beginnings, and the text each is from."""
    data, offsets = as_bytes(folded(texts))
    starts, ends, first = word_bounds(data, offsets, IS_MARK)
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    hashes, texts_of = [hash_ranges(data, starts, ends)], [text]
    for n in BEGINNINGS:
        longer = ends - starts > n
        part = hash_ranges(data, starts[longer], starts[longer] + n)
        hashes.append(mix(part + U64(n)))
        texts_of.append(text[longer])
    return np.concatenate(hashes), np.concatenate(texts_of)


def distinct(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each feature of a text once; texts ascend, and within a text the hashes."""
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[new], text[new]


def _chosen(words: np.ndarray, text: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """The words that tell toxic from unlabelled texts, ascending."""
    vocabulary, at = np.unique(words, return_inverse=True)
    among_toxic = np.bincount(at, weights=toxic[text], minlength=len(vocabulary))
    among_all = np.bincount(at, weights=~toxic[text], minlength=len(vocabulary))
    share_toxic = (among_toxic + 0.5) / (toxic.sum() + 1)
    share_all = (among_all + 0.5) / ((~toxic).sum() + 1)
    ratio = np.log(share_toxic / share_all)
    clear = np.flatnonzero((among_toxic >= LEAST_TEXTS) & (np.abs(ratio) > LEAST_RATIO))
    # the most telling first: distance of the shares in standard errors
    error = np.sqrt(share_toxic / (toxic.sum() + 1) + share_all / ((~toxic).sum() + 1))
    distance = np.abs(share_toxic - share_all)[clear] / error[clear]
    clear, distance = clear[distance >= LEAST_DISTANCE], distance[distance >= LEAST_DISTANCE]
    clear = clear[np.argsort(-distance, kind="stable")]
    return np.sort(vocabulary[clear[:FEATURES]])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train_one(words: np.ndarray, text: np.ndarray, toxic: np.ndarray, prior: float) -> Classifier:
    """Minimise the non-negative risk. ``words`` and ``text`` are pairs; ``toxic`` marks the confirmed texts."""
    kept = _chosen(words, text, toxic)
    if not len(kept):
        return Classifier(kept, np.zeros(0), float(np.log(prior / (1 - prior))))
    at = np.minimum(np.searchsorted(kept, words), len(kept) - 1)
    known = kept[at] == words
    feature, row = at[known], text[known]
    weights, bias = np.zeros(len(kept)), float(np.log(prior / (1 - prior)))
    share = np.where(toxic, prior / toxic.sum(), 1 / (~toxic).sum())
    moment, square = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    for step in range(1, STEPS + 1):
        score = np.bincount(row, weights=weights[feature], minlength=len(toxic)) + bias
        chance = _sigmoid(score)
        against = np.logaddexp(0, score)
        clean_risk = (against * share)[~toxic].sum() - (against * share)[toxic].sum()
        # slopes of the three expectations by the score of each text
        positive, negative = np.where(toxic, -share * (1 - chance), 0), np.where(toxic, -share * chance, share * chance)
        slope = positive + negative if clean_risk >= 0 else -negative
        gradient = np.append(np.bincount(feature, weights=slope[row], minlength=len(kept)) + DECAY * weights, slope.sum())
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        move = RATE * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        weights -= move[:-1]
        bias -= float(move[-1])
    return Classifier(kept, weights, bias)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str,
    text_col: str,
    toxic_col: str,
    *,
    usable: Column | None = None,
    classifiers: int = CLASSIFIERS,
    toxic_texts: int = TOXIC_TEXTS,
    unlabelled_texts: int = UNLABELLED_TEXTS,
) -> list[Classifier]:
    """Classifiers from the labelled rows for which ``usable``, a condition on ``id``, holds.

    At most ``toxic_texts`` and ``unlabelled_texts`` texts, chosen by a hash of their id, go to each classifier,
    so that the list of training ids is bounded and may be broadcast. The class prior is the share of toxic
    among all usable labels.
    """
    given = labels.select(F.col(id_col).cast("bigint").alias("id"), (F.col(toxic_col) == 1).alias("toxic"))
    given = given.where("id is not null and toxic is not null")
    if usable is not None:
        given = given.where(usable)
    given = given.groupBy("id").agg(F.max("toxic").alias("toxic"))
    total, toxic = given.agg(F.count("*"), F.count_if("toxic")).first()
    if not toxic:
        return []
    prior = min(0.95, max(1e-4, toxic / total))

    def share_of(most: int, there: int) -> float:
        # somewhat below the bound, so that a chance excess does not break it
        return min(1.0, 0.9 * most / there)

    # every usable text is unlabelled to a classifier; the toxic ones also are examples of their own
    uses = []
    for c in range(classifiers):
        spread = F.pmod(F.xxhash64("id", F.lit(c)), F.lit(1 << 30)) / float(1 << 30)
        use = lambda toxic, c=c: F.struct(F.lit(c).alias("shard"), F.lit(toxic).alias("toxic"))
        uses.append(F.when(spread < share_of(unlabelled_texts, total), use(False)))
        uses.append(F.when(F.col("toxic") & (spread < share_of(toxic_texts, toxic)), use(True)))
    chosen = given.select("id", F.array_compact(F.array(*uses)).alias("uses")).where(F.size("uses") > 0)
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    training = texts.join(F.broadcast(chosen), "id")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                rows = batch.slice(lo, hi - lo)
                part, text = distinct(*features_of(rows.column("text")))
                cuts = np.searchsorted(text, np.arange(hi - lo + 1))
                words = [part[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), rows.column("uses"), pa.array(words, pa.binary())], names=["id", "uses", "words"]
                )

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("id", "ascending"), ("toxic", "ascending")])
        sets = [np.frombuffer(w, U64) for w in table.column("words").to_pylist()]
        toxic = table.column("toxic").to_numpy()
        if not toxic.any() or toxic.all():
            return pa.table({"words": pa.array([], pa.binary()), "weights": pa.array([], pa.binary()), "bias": pa.array([], pa.float64())})
        text = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        found = train_one(np.concatenate(sets), text, toxic, prior)
        return pa.table({"words": [found.words.tobytes()], "weights": [found.weights.tobytes()], "bias": [found.bias]})

    featured = training.select("id", "uses", "text").mapInArrow(
        features, "id bigint, uses array<struct<shard:int,toxic:boolean>>, words binary"
    )
    fitted = featured.select("id", "words", F.inline("uses")).groupBy("shard").applyInArrow(fit, "words binary, weights binary, bias double")
    return [
        Classifier(np.frombuffer(r["words"], U64), np.frombuffer(r["weights"]), r["bias"])
        for r in sorted(fitted.collect(), key=lambda r: bytes(r["words"]))
    ]


def scores_of(texts: pa.Array, models: list[Classifier]) -> np.ndarray:
    out = np.zeros(len(texts))
    if not models:
        return out
    # one lookup for all classifiers; only what some of them knows is made distinct
    known = np.unique(np.concatenate([m.words for m in models]))
    weights = np.zeros((len(models), len(known)))
    for row, model in zip(weights, models, strict=True):
        row[np.searchsorted(known, model.words)] = model.weights
    for lo, hi in slices(texts):
        score = np.tile(np.array([[m.bias] for m in models]), (1, hi - lo))
        if len(known):
            hashes, text = features_of(texts.slice(lo, hi - lo))
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            hit = known[at] == hashes
            pair = np.unique(text[hit] * len(known) + at[hit])
            for row, model in zip(score, weights, strict=True):
                row += np.bincount(pair // len(known), weights=model[pair % len(known)], minlength=hi - lo)
        out[lo:hi] = _sigmoid(score).mean(axis=0)
    return out


def score(text: Column, models: list[Classifier]) -> Column:
    """The mean score of the classifiers for a text, from 0 to 1."""

    @F.pandas_udf("double")
    def scored(texts):
        import pandas as pd

        return pd.Series(scores_of(pa.Array.from_pandas(texts, type=pa.large_string()), models), index=texts.index)

    return scored(text)
