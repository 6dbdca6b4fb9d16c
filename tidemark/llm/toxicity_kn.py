"""Toxicity by class-conditional Kneser-Ney models.

Each class, toxic and ordinary, has an interpolated model of three levels: pairs of words, words, and the
letters that spell a word. At each level a class keeps the part of its count that stands out, and its
discount takes the rest: what the counts of both classes together would let expect in it, ``MARGIN``
standard deviations of that, and 1. What the discounts of both classes take away is their shared backoff
count, as Kneser and Ney build theirs, and below it lies the next level. So words and
letters of a language speak for no class, however the classes mix languages, and a rare expression falls
back on what is shared. Counts are of texts, not of occurrences, as one text may repeat an expression
at will. A text's toxic and ordinary log-likelihoods, each divided by its number of words, are
compared, and a logistic curve fitted on further labelled rows turns the difference into a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import chunks, kept, with_results
from tidemark.llm.words import WordValues, ngram_keys, word_pieces

#: Length of the longest letter n-grams, and of the longest ones that speak for no class.
ORDER, SHARED = 7, 4
#: Standard deviations that a class's count of an expression has to stand out by.
MARGIN = 3.0
#: Discount of the shared counts of words and pairs: a rarer one is left to the level below.
RARE = 20.0
#: Labelled rows of each class that the models count, and rows that the curve is fitted on.
FIT_ROWS, CURVE_ROWS = 3000, 6000
#: Words whose n-grams are taken at once when a model is fitted.
GROUP = 30_000


def _value(keys: np.ndarray, values: np.ndarray, at: np.ndarray, default: float) -> np.ndarray:
    """The values of the sorted ``keys`` for the keys ``at``."""
    if not len(keys):
        return np.full((len(at), *values.shape[1:]), default)
    place = np.minimum(np.searchsorted(keys, at), len(keys) - 1)
    known = (keys[place] == at).reshape(-1, *[1] * (values.ndim - 1))
    return np.where(known, values[place], default)


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """64-bit keys of pairs of words, from the words' keys."""
    x = (word ^ (before * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


@dataclass
class Letters:
    """Shared counts of letter n-grams of one length, the sums of their contexts, and the numbers of
    n-grams after a context."""

    grams: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    sums: np.ndarray
    kinds: np.ndarray
    discount: float

    @classmethod
    def of(cls, gram: np.ndarray, context: np.ndarray, count: np.ndarray) -> Letters:
        """From distinct n-grams, sorted."""
        once, twice = (count == 1).sum(), (count == 2).sum()
        contexts, back = np.unique(context, return_inverse=True)
        return cls(gram, count.astype(np.float32), contexts,
                   np.bincount(back, weights=count).astype(np.float32),
                   np.bincount(back).astype(np.float32),
                   float(once / (once + 2 * twice)) if once and twice else 0.5)

    def mixed(self, gram: np.ndarray, context: np.ndarray, lower: np.ndarray) -> np.ndarray:
        total = _value(self.contexts, self.sums, context, 0.0)
        safe = np.where(total > 0, total, 1)
        own = np.maximum(_value(self.grams, self.counts, gram, 0.0) - self.discount, 0) / safe
        rest = self.discount * _value(self.contexts, self.kinds, context, 0.0) / safe
        return np.where(total > 0, own + rest * lower, lower)


@dataclass
class Level:
    """What stands out in the classes and what they share, as parts of a probability: for an n-gram
    ``own`` (a column a class) and ``common``; for a context what its n-grams leave to the shared
    counts, ``rest``, and these to the level below, ``common_rest``. N-grams and contexts that
    change nothing are left out."""

    grams: np.ndarray
    own: np.ndarray
    common: np.ndarray
    contexts: np.ndarray
    rest: np.ndarray
    common_rest: np.ndarray

    @classmethod
    def of(cls, gram: np.ndarray, context: np.ndarray, counts: np.ndarray,
           contexts: np.ndarray | None = None, totals: np.ndarray | None = None,
           rare: float = np.inf) -> Level:
        """From distinct n-grams and their counts in both classes. ``totals`` are the sums of the
        sorted ``contexts``, if they hold more than the given n-grams."""
        if contexts is None:
            contexts, of = np.unique(context, return_inverse=True)
            totals = np.stack([np.bincount(of, weights=c, minlength=len(contexts))
                               for c in counts.T], 1)
        else:
            of = np.searchsorted(contexts, context)

        def sums(x: np.ndarray) -> np.ndarray:
            return np.bincount(of, weights=x, minlength=len(contexts))

        expected = totals[of] * (counts.sum(1) / np.maximum(totals[of].sum(1), 1))[:, None]
        discount = expected + MARGIN * np.sqrt(expected) + 1
        own = np.maximum(counts - discount, 0)
        taken = np.stack([sums(own[:, c]) for c in (0, 1)], 1)
        # all that the discounts took away, also of n-grams that are not given
        shared = np.maximum((totals - taken).sum(1), 1)
        common = np.maximum((counts - own).sum(1) - rare, 0)
        safe = np.maximum(totals, 1)
        rest, common_rest = 1 - taken / safe, 1 - sums(common) / shared
        own, common = own / safe[of], common / shared[of]
        speaks, changed = (own > 0).any(1) | (common > 0), (rest < 1).any(1) | (common_rest < 1)
        order = np.flatnonzero(speaks)
        order = order[np.argsort(gram[order])]
        return cls(gram[order], own[order], common[order], contexts[changed], rest[changed],
                   common_rest[changed])

    def mixed(self, gram: np.ndarray, context: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Log-probabilities of both classes, from those of the level below."""
        rest = _value(self.contexts, self.rest, context, 1.0)
        alone = (_value(self.grams, self.own, gram, 0.0)
                 + rest * _value(self.grams, self.common, gram, 0.0)[:, None])
        back = np.log(rest * _value(self.contexts, self.common_rest, context, 1.0)[:, None]) + lower
        with np.errstate(divide="ignore"):
            return np.logaddexp(np.log(alone), back)


class Model:
    """The levels of two classes, and the curve that makes a score of their difference."""

    def __init__(self, spelled: list[str], keys: np.ndarray, counts: np.ndarray, before: np.ndarray,
                 word: np.ndarray, pair_counts: np.ndarray, contexts: np.ndarray,
                 totals: np.ndarray) -> None:
        """``counts``: how many texts of each class (two columns) hold each word; ``keys`` of the
        words; pairs of words by key, and ``totals`` of all pairs after the sorted ``contexts``."""
        self.shared: list[Letters] = []
        self.letters: list[Level] = []
        tables = self._tables(spelled, counts)
        for size, (gram, context, suffix, n) in enumerate(tables, 1):
            kinds = n.sum(1)
            if size < ORDER:  # in how many ways the n-gram is continued to the left
                longer = tables[size][2]
                kinds = np.bincount(np.searchsorted(gram, longer), minlength=len(gram))
                kinds = np.maximum(kinds, 1)  # one with the begin of a word has one way
            self.shared.append(Letters.of(gram, context, kinds))
            if size > SHARED:
                self.letters.append(Level.of(gram, context, n))
        self.alphabet = len(tables[0][0]) + 1
        none = np.zeros(len(keys), np.uint64)
        self.words = Level.of(keys, none, counts, rare=RARE)
        self.pairs = Level.of(pair_keys(before, word), before, pair_counts, contexts, totals, RARE)
        self.curve = (1.0, 0.0, 1.0)

    @staticmethod
    def _tables(spelled: list[str], counts: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        """For each length the distinct letter n-grams, sorted, with their contexts, the n-grams one
        shorter that end them, and their counts. Of the n-grams that are no longer one's end, those with
        the begin of a word, no longer one is given."""
        found: list[list] = [[] for _ in range(ORDER)]

        def merged(gram, context, suffix, n):
            gram, at, back = np.unique(gram, return_index=True, return_inverse=True)
            sums = np.stack([np.bincount(back, weights=c, minlength=len(gram)) for c in n.T], 1)
            return gram, context[at], suffix[at], sums

        for first in range(0, len(spelled), GROUP):
            owner, keys, place = ngram_keys(spelled[first:first + GROUP], ORDER)
            n = counts[first:first + GROUP]
            for size in range(1, ORDER + 1):
                at = np.flatnonzero((place >= 1) & (keys[size] != 0))
                # the context of an n-gram ends one letter before it
                context = keys[size - 1][at - 1] if size > 1 else np.ones(len(at), np.uint64)
                found[size - 1].append(merged(keys[size][at], context, keys[size - 1][at], n[owner[at]]))
        return [merged(*(np.concatenate(x) for x in zip(*parts))) for parts in found]

    def spelling(self, spelled: list[str]) -> np.ndarray:
        """For each word the log-probability of its letters in both classes."""
        owner, keys, place = ngram_keys(spelled, ORDER)
        p = np.full(len(owner), 1 / self.alphabet)
        contexts = [None] * (ORDER + 1)
        inner = [None] * (ORDER + 1)
        for size, level in enumerate(self.shared, 1):
            inner[size] = ok = np.flatnonzero((place >= 1) & (keys[size] != 0))
            contexts[size] = keys[size - 1][ok - 1] if size > 1 else np.ones(len(ok), np.uint64)
            p[ok] = level.mixed(keys[size][ok], contexts[size], p[ok])
        logs = np.repeat(np.log(p)[:, None], 2, 1)
        for size, level in enumerate(self.letters, SHARED + 1):
            ok = inner[size]
            logs[ok] = level.mixed(keys[size][ok], contexts[size], logs[ok])
        logs[place < 1] = 0
        return np.stack([np.bincount(owner, weights=c, minlength=len(spelled)) for c in logs.T], 1)

    def of_words(self, keys: np.ndarray, spellings: np.ndarray) -> np.ndarray:
        """Log-probabilities of words in both classes, from those of their letters."""
        return self.words.mixed(keys, np.zeros(len(keys), np.uint64), spellings)

    def of_pairs(self, before: np.ndarray, word: np.ndarray, alone: np.ndarray) -> np.ndarray:
        """Log-probabilities of words after the words ``before``, from those of the words alone."""
        return self.pairs.mixed(pair_keys(before, word), before, alone)

    def scores(self, means: np.ndarray) -> np.ndarray:
        slope, shift, scale = self.curve
        return 1 / (1 + np.exp(-np.clip(slope * np.arcsinh(means / scale) + shift, -500, 500)))


def _with_before(pieces) -> tuple[np.ndarray, np.ndarray]:
    """The key of the word before each word (0 at the begin of a text), and its own."""
    keys = pieces.keys()
    before = np.roll(keys, 1)
    before[np.append(True, pieces.text[1:] != pieces.text[:-1])[:len(keys)]] = 0
    return before, keys


def mean_ratios(model: Model, values: WordValues, texts: list[str]) -> np.ndarray:
    """Toxic less ordinary log-likelihood of each text for each word; 0 for a text without words.
    ``values`` gives the log-probabilities of words' letters."""
    pieces, whole = word_pieces(texts)
    if not len(pieces.text):
        return np.zeros(len(texts))
    before, keys = _with_before(pieces)
    alone = model.of_words(keys, values(pieces, whole).astype(np.float64))
    both = model.of_pairs(before, keys, alone)
    total = np.bincount(pieces.text, weights=both[:, 1] - both[:, 0], minlength=len(texts))
    return total / np.maximum(np.bincount(pieces.text, minlength=len(texts)), 1)


def fit_curve(means: np.ndarray, toxic: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression on the inverse hyperbolic sine of the means, so that a few texts with many
    toxic words don't set the slope, by Newton steps, with a weak pull to zero."""
    scale = max(float(np.std(means[toxic == 0])), 1e-9)
    x = np.stack([np.arcsinh(means / scale), np.ones(len(means))], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (toxic - p) - 1e-2 * w
        curvature = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        w = w + np.clip(np.linalg.solve(curvature, gradient), -5, 5)
    return float(w[0]), float(w[1]), scale


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic",
        id: str = "doc_id", fit_rows: int = FIT_ROWS, curve_rows: int = CURVE_ROWS) -> Model:
    """A model from the texts of ``docs`` whose ``id`` has a ``label`` in ``labels`` (1: toxic, 0:
    not; others are left out).

    Two bounded samples are used, whose sizes are parameters: ``fit_rows`` labels of each class for
    the counts, and ``curve_rows`` others for the curve, both picked by a hash of ``id``. Words and
    pairs are counted by Spark; the driver gets the distinct words of the first sample, the pairs that
    two of its texts hold, and a number for each row of the second. An ``id`` that comes several times
    counts once, with the least of its texts, and as toxic if one of its labels says so. Without
    rows of both classes the score is 0.5 for every text.
    """
    narrow = (labels.filter(F.col(f"`{label}`").isin(0, 1)).filter(F.col(f"`{id}`").isNotNull())
              .groupBy(F.col(f"`{id}`").alias("id"))
              .agg(F.max(F.col(f"`{label}`").cast("int")).alias("toxic"))
              .withColumn("draw", F.xxhash64("id", F.lit(11))))
    for_curve = F.pmod("draw", F.lit(3)) == 0
    picked = narrow.filter(for_curve).orderBy("draw", "id").limit(curve_rows)
    for c in (0, 1):
        picked = picked.unionAll(narrow.filter(~for_curve & (F.col("toxic") == c))
                                 .orderBy("draw", "id").limit(fit_rows))
    sample = kept(
        docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
        .join(F.broadcast(picked), "id")  # bounded by the sample's size
        .groupBy("id", "toxic", for_curve.alias("for_curve")).agg(F.min("text").alias("text")),
        "labelled-sample")
    texts = sample.filter("not for_curve").select("text", "toxic")

    def classes(rows: DataFrame, *by: str) -> DataFrame:
        sums = [F.sum(F.when(F.col("toxic") == c, F.col("n")).otherwise(0)).alias(f"n{c}")
                for c in (0, 1)]
        return rows.groupBy(*by).agg(*sums)

    words = classes(texts.mapInArrow(_count_words, "key long, word string, toxic int, n long"),
                    "key", "word").toPandas().sort_values("word")
    counts = words[["n0", "n1"]].to_numpy(np.float64)
    if not (counts.sum(0) > 0).all():
        model = Model(["a"], np.ones(1, np.uint64), np.ones((1, 2)), *[np.zeros(0, np.uint64)] * 2,
                      np.zeros((0, 2)), np.zeros(0, np.uint64), np.zeros((0, 2)))
        model.curve = (0.0, 0.0, 1.0)
        return model
    pairs = kept(classes(texts.mapInArrow(_count_pairs, "before long, key long, toxic int, n long"),
                         "before", "key"), "pair-counts")
    # a pair of one text is part of its context's sums and says nothing else
    some = F.col("n0") + F.col("n1") >= 2
    often = pairs.filter(some).toPandas()
    totals = (pairs.groupBy("before").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"),
                                          F.bool_or(some).alias("some")).filter("some").toPandas())

    def keys(column) -> np.ndarray:
        return column.to_numpy(np.int64).view(np.uint64)

    order = np.argsort(keys(totals["before"]))
    model = Model(words["word"].tolist(), keys(words["key"]), counts, keys(often["before"]),
                  keys(often["key"]), often[["n0", "n1"]].to_numpy(np.float64),
                  keys(totals["before"])[order], totals[["n0", "n1"]].to_numpy(np.float64)[order])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    found = with_results(sample.filter("for_curve"), "text", "mean double", _means(shared),
                         ["toxic"]).toPandas()
    shared.unpersist()
    toxic = found["toxic"].to_numpy(float)
    if 0 < toxic.sum() < len(toxic):
        model.curve = fit_curve(found["mean"].to_numpy(), toxic)
    return model


def score(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with ``log_ratio`` (toxic less ordinary log-likelihood for
    each word), ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) of each whole text; columns of
    these names are replaced. A null text, or one without a word, has ratio 0. Rows are neither
    joined nor dropped."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded by the sample it was fitted on

    def make():
        means = _means(shared)()

        def of(texts):
            ratio = means(texts)[0]
            scores = shared.value.scores(ratio.to_numpy())
            return [ratio, pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
        return of

    return with_results(df, text, "log_ratio double, score double, predicted int", make, keep)


def _means(shared):
    def make():
        values = WordValues(shared.value.spelling, 2)
        return lambda texts: [pa.array(np.concatenate(
            [mean_ratios(shared.value, values, group) for _, group in chunks(texts)]))]
    return make


def _once(*columns: np.ndarray) -> np.ndarray:
    """The places of the first of the equal rows."""
    order = np.lexsort(columns)
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([c[order[1:]] != c[order[:-1]] for c in columns])
    return order[new]


def _groups(batches):
    """Pieces of groups of texts, the texts joined, and the class of each piece."""
    for batch in batches:
        texts, toxic = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        for first, group in chunks(texts):
            pieces, whole = word_pieces(group)
            if len(pieces.text):
                yield pieces, whole, toxic[first + pieces.text]


def _count_words(batches):
    for pieces, whole, toxic in _groups(batches):
        keys = pieces.keys()
        at = _once(pieces.text, keys)
        for c in (0, 1):
            own = at[toxic[at] == c]
            found, index, n = np.unique(keys[own], return_index=True, return_counts=True)
            spelled = [whole[a:b] for a, b in zip(pieces.start[own[index]].tolist(),
                                                  pieces.end[own[index]].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(spelled, pa.string()),
                 pa.array(np.full(len(n), c, np.int32)), pa.array(n)], ["key", "word", "toxic", "n"])


def _count_pairs(batches):
    for pieces, _, toxic in _groups(batches):
        before, keys = _with_before(pieces)
        at = _once(pieces.text, before, keys)
        yield pa.RecordBatch.from_arrays(
            [pa.array(before[at].view(np.int64)), pa.array(keys[at].view(np.int64)),
             pa.array(toxic[at].astype(np.int32)), pa.array(np.ones(len(at), np.int64))],
            ["before", "key", "toxic", "n"])
