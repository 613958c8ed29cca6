"""Toxicity by a classifier chain.

Linear models predict the categories one after another; each later model also sees the earlier categories'
probabilities, in training those that models made without the document (out of fold) give it. Features are words and
their beginnings, chosen by how much more often toxic documents have them, each a yes or no for the whole text, and
another whether the text has it more than once.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexpanel.llm._util import fresh, slim

WORD = re.compile(r"[^\W\d_]+")
#: Parameters: documents of the training sample by label, features, beginnings, folds,
#: penalty, and how many missed toxic documents a clean one that is rejected weighs when the threshold is set.
TOXIC_ROWS, CLEAN_ROWS, FEATURES, STEMS, FOLDS, PENALTY, CLEAN_COST = 1500, 3500, 1000, (3, 4, 5, 6), 4, 0.02, 4.0
#: Bytes of text that the training sample may have in all.
SAMPLE_BYTES = 48 << 20
#: The categories in the order of the chain: a toxic word at all, toxic words again and again, the label itself.
CATEGORIES = ("lexical", "severe", "toxic")


def pieces(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in STEMS if len(word) > n)]


def words(text: str) -> Counter:
    return Counter(WORD.findall(text.lower()))


def twice(piece: str) -> str:
    """The feature of texts that have a piece more than once."""
    return piece + "+"


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = 200) -> np.ndarray:
    """Weights of a penalised logistic regression by accelerated gradient steps, classes weighing alike; the last is the bias."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    weight = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    x, y, weight = x.astype(np.float32), y.astype(np.float32), weight.astype(np.float32)
    w = np.zeros(x.shape[1], np.float32)
    held, rate = w.copy(), 4.0 / max(1.0, float((weight @ (x * x)).sum()))
    for t in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ held, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + penalty / len(w) * np.append(held[:-1], np.float32(0))
        new = held - np.float32(rate) * gradient
        held = new + np.float32(t / (t + 3)) * (new - w)
        w = new
    return w


@dataclass
class Chain:
    """vocabulary: feature -> column; weights: one row a category, over features, earlier probabilities, bias;
    threshold: the probability of the last category from which a document is toxic, set on out-of-fold predictions."""

    vocabulary: dict[str, int]
    weights: list[np.ndarray]
    threshold: float

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        out = np.empty((len(rows), 0))
        for w in self.weights:
            z = np.hstack([rows, out]) @ w[:-1] + w[-1]
            out = np.hstack([out, 1 / (1 + np.exp(-np.clip(z, -30, 30)))[:, None]])
        return out


class _Bags:
    """The words of the sample as numbers, a few small arrays a document. Feature 2 p is piece p, 2 p + 1
    piece p more than once."""

    def __init__(self, texts: list[str]):
        number: dict[str, int] = {}
        piece: dict[str, int] = {}
        self.names: list[str] = []
        self.own: list[tuple[int, ...]] = []  # the pieces of each word
        self.words, self.counts, self.features = [], [], []
        for t in texts:
            counted = words(t)
            n: dict[int, int] = {}
            for w, k in counted.items():
                if w not in number:
                    number[w] = len(self.own)
                    for p in pieces(w):
                        if p not in piece:
                            piece[p] = len(self.names)
                            self.names.append(p)
                    self.own.append(tuple(piece[p] for p in pieces(w)))
                for p in self.own[number[w]]:
                    n[p] = n.get(p, 0) + k
            self.words.append(np.array([number[w] for w in counted], np.int32))
            self.counts.append(np.array(list(counted.values()), np.int32))
            self.features.append(np.array([*(2 * p for p in n), *(2 * p + 1 for p, k in n.items() if k > 1)], np.int32))

    def name(self, f: int) -> str:
        return twice(self.names[f // 2]) if f % 2 else self.names[f // 2]

    def with_features(self, rows: np.ndarray) -> np.ndarray:
        """In how many of the rows each feature is."""
        return np.bincount(np.concatenate([np.empty(0, np.int32), *(self.features[i] for i in rows)]), minlength=2 * len(self.names))

    def select(self, rows: np.ndarray, y: np.ndarray) -> tuple[list[int], np.ndarray]:
        """From the rows alone: the features of largest gain, and the categories of all documents by the words that mark
        toxic rows (one row a category)."""
        with_, without = self.with_features(rows[y[rows] > 0]), self.with_features(rows[y[rows] == 0])
        n, m = max(1, int(y[rows].sum())), max(1, int((1 - y[rows]).sum()))
        gain = {}
        for f in np.flatnonzero((with_ >= 3) | (without >= 3)).tolist():
            k, j = int(with_[f]), int(without[f])
            told = math.log((k + 0.5) / n) - math.log((j + 0.5) / m)
            gain[f] = k / n * told if k >= 3 else j / m * -told / 20
        chosen = sorted(gain, key=lambda f: (-gain[f], self.name(f)))[:FEATURES]
        term = ((with_ >= 3) & (without == 0))[::2]
        marked = np.array([any(term[p] for p in ps) for ps in self.own], bool)
        mentions = np.array([int(k[marked[w]].sum()) if len(w) else 0 for w, k in zip(self.words, self.counts, strict=True)])
        return chosen, np.array([y * (mentions > 0), y * (mentions >= 3), y])

    def matrix(self, chosen: list[int]) -> np.ndarray:
        column = np.full(2 * len(self.names), -1)
        column[chosen] = np.arange(len(chosen))
        x = np.zeros((len(self.features), len(chosen)), np.float32)
        for i, f in enumerate(self.features):
            at = column[f]
            x[i, at[at >= 0]] = 1
        return x


def train(texts: list[str], toxic: list[int]) -> Chain:
    """Fits the chain. The categories are degrees of the one label that the tables have: lexical: toxic, with a word that at
    least three toxic and no clean documents have, or a beginning like that; severe: lexical with three or more such words;
    toxic: the label. Out of fold means wholly so: features, marking words, categories and weights behind a document's
    probabilities, which the later models and the threshold are fitted on, come from the other folds alone."""
    y = np.asarray(toxic, np.float64)
    bags, every = _Bags(texts), np.arange(len(y))
    fold = every % FOLDS
    outside = np.zeros((len(y), len(CATEGORIES)), np.float32)
    parts = []
    for k in range(FOLDS):
        rest = every[fold != k]
        chosen, labels = bags.select(rest, y)
        parts.append((rest, every[fold == k], bags.matrix(chosen), labels))
    for c in range(len(CATEGORIES)):
        predicted = np.zeros(len(y), np.float32)
        for rest, held, x, labels in parts:
            w = logistic(np.hstack([x[rest], outside[rest, :c]]), labels[c][rest])
            predicted[held] = 1 / (1 + np.exp(-np.clip(np.hstack([x[held], outside[held, :c]]) @ w[:-1] + w[-1], -30, 30)))
        outside[:, c] = predicted
    del parts
    chosen, labels = bags.select(every, y)
    x = bags.matrix(chosen)
    weights = [logistic(np.hstack([x, outside[:, :c]]), labels[c]) for c in range(len(CATEGORIES))]
    steps, last = np.linspace(0.05, 0.95, 91), outside[:, -1]
    cost = np.array([(last[y > 0] < t).sum() + CLEAN_COST * (last[y == 0] >= t).sum() for t in steps])
    best = np.flatnonzero(cost == cost.min())
    return Chain({bags.name(f): i for i, f in enumerate(chosen)}, weights, float(steps[best[len(best) // 2]]))


class Scorer:
    """Word weights are looked up once a distinct word and kept in a bounded cache."""

    def __init__(self, chain: Chain, most: int = 1 << 18):
        self.chain, self.most, self.cache = chain, most, {}

    def features(self, text: str) -> list[int]:
        n: dict[str, int] = {}
        vocabulary, cache = self.chain.vocabulary, self.cache
        for w, k in words(text).items():
            at = cache.get(w)
            if at is None:
                at = tuple(p for p in pieces(w) if p in vocabulary or twice(p) in vocabulary)
                if len(cache) >= self.most:
                    cache.clear()
                cache[w] = at
            for p in at:
                n[p] = n.get(p, 0) + k
        return [vocabulary[f] for p, k in n.items() for f in ((p, twice(p)) if k > 1 else (p,)) if f in vocabulary]

    def score(self, texts: Sequence[str] | pa.Array) -> np.ndarray:
        """A null text has no words; of an Arrow array few texts at a time are copied."""
        n, out = len(self.chain.vocabulary), []
        for at in range(0, len(texts), 256):
            part = texts[at : at + 256]
            rows = np.zeros((len(part), n), np.float32)
            for i, t in enumerate(part.to_pylist() if isinstance(part, pa.Array) else part):
                rows[i, self.features(t or "")] = 1
            out.append(self.chain.probabilities(rows))
        return np.concatenate(out) if out else np.empty((0, len(self.chain.weights)))


def sample(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", toxic: str = "toxic") -> DataFrame | None:
    """k, y, t of the training rows: at most TOXIC_ROWS and CLEAN_ROWS labelled documents, those of lowest hash, and of
    these, in that order, as many as have SAMPLE_BYTES together; one that would pass the bound is left out. A key that labels
    contradict is toxic; of rows that repeat a key the text of least digest counts. Only sizes come to the driver, no text.
    None where the rows are not of both kinds."""
    some = labels.where(labels[toxic].isNotNull() & labels[key].isNotNull()).groupBy(labels[key].alias("k")).agg(F.max((labels[toxic] > 0).cast("int")).alias("y"))
    order = [F.xxhash64("k"), F.col("k")]
    few = some.where("y = 1").orderBy(*order).limit(TOXIC_ROWS).union(some.where("y = 0").orderBy(*order).limit(CLEAN_ROWS))
    few = F.broadcast(few)  # TOXIC_ROWS + CLEAN_ROWS rows
    got = df.select(df[key].alias("k"), F.coalesce(df[text].cast("string"), F.lit("")).alias("t")).join(few, "k").withColumn("d", F.sha2("t", 256))
    sized = got.groupBy("k", "y").agg(F.min(F.struct("d", F.octet_length("t").alias("n"))).alias("m")).select("k", "y", "m.d", "m.n", F.xxhash64("k").alias("h")).collect()
    left, chosen = SAMPLE_BYTES, []
    for r in sorted(sized, key=lambda r: (r["h"], r["k"])):
        if r["n"] <= left:
            left -= r["n"]
            chosen.append((r["k"], r["d"], r["y"]))
    if len({y for _, _, y in chosen}) < 2:
        return None
    kind = df.schema[key].dataType.simpleString()
    named = df.sparkSession.createDataFrame([c[:2] for c in chosen], f"k {kind}, d string")
    return got.join(F.broadcast(named), ["k", "d"]).dropDuplicates(["k"]).select("k", "y", "t")


def fit(rows: DataFrame) -> Chain:
    """The chain trained on the rows of `sample`, by one task: they are bounded, and the driver gets the weights alone."""

    @slim
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, toxic = [], []
        for batch in batches:
            texts += batch.column("t").to_pylist()
            toxic += batch.column("y").to_pylist()
        chain = train(texts, toxic)
        yield pa.RecordBatch.from_arrays([pa.array([list(chain.vocabulary)]), pa.array([[w.tolist() for w in chain.weights]], pa.list_(pa.list_(pa.float32()))), pa.array([chain.threshold])], ["vocabulary", "weights", "threshold"])

    one = rows.repartition(1).sortWithinPartitions("k").select("y", "t")
    r = one.mapInArrow(run, "vocabulary array<string>, weights array<array<float>>, threshold double").collect()[0]
    return Chain({f: i for i, f in enumerate(r["vocabulary"])}, [np.array(w, np.float32) for w in r["weights"]], r["threshold"])


def _judged(df: DataFrame, labels: DataFrame, key: str, text: str, threshold: float | None, into: str) -> DataFrame | None:
    """df with a struct column `into` of the categories' probabilities and said, the verdict; None without a sample."""
    rows = sample(df, labels, key, text)
    if rows is None:
        return None
    chain = fit(rows)
    least = chain.threshold if threshold is None else threshold
    shared = df.sparkSession.sparkContext.broadcast(chain)

    @F.arrow_udf("struct<" + ",".join(f"{c}:double" for c in CATEGORIES) + ",said:boolean>")
    @slim
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value)
        for batch in batches:
            p = scorer.score(batch)
            yield pa.StructArray.from_arrays([*(pa.array(p[:, i]) for i in range(len(CATEGORIES))), pa.array(p[:, -1] >= least)], [*CATEGORIES, "said"])

    return df.withColumn(into, run(df[text].cast("string")))


def judge(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float | None = None) -> DataFrame:
    """Adds p_lexical, p_severe, p_toxic and toxic (p_toxic >= threshold, by default the chain's own) to df's rows; columns
    of those names are replaced, all others stay whatever their names. Trained on the bounded sample of `sample`; without
    a toxic and a clean labelled document in df nothing is toxic and probabilities are 0. Null and empty texts are scored
    as texts without words, others whole whatever their length; repeated rows get one verdict; an empty table gives no
    rows."""
    (p,) = fresh(df, "p")
    names = {f"p_{c}" for c in CATEGORIES} | {"toxic"}
    own = [F.col(f"`{c}`") for c in df.columns if c.lower() not in names]
    out = _judged(df, labels, key, text, threshold, p)
    if out is None:
        return df.select(*own, *(F.lit(0.0).alias(f"p_{c}") for c in CATEGORIES), F.lit(False).alias("toxic"))
    return out.select(*own, *(F.col(f"{p}.{c}").alias(f"p_{c}") for c in CATEGORIES), F.col(f"{p}.said").alias("toxic"))


def passed(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float | None = None) -> DataFrame:
    """The rows of df that the chain doesn't call toxic, with the columns of df, whatever their names."""
    (p,) = fresh(df, "p")
    out = _judged(df, labels, key, text, threshold, p)
    return df if out is None else out.where(~F.col(f"{p}.said")).drop(p)
