"""Languages of words in code-switched text by a linear-chain conditional random field.

A word's features are its affixes, its letter n-grams, itself if it is in the lexicon, and the
languages whose lexicon holds it. Their weights add up to the word's score in each language, and
learned transition weights tie neighbouring words together. Forward-backward gives each word its
probabilities; a text's language is the one with the largest sum of them.

Texts are cut into segments of equal length. All segments of a batch pass through the recursion
side by side: first as products of matrices from their begin to their end, then, when the products
of the segments before and behind them are known, word by word. The result is that of one pass
along the whole text, however long it is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import chunks, with_results
from tidemark.llm.words import Pieces, WordValues, ngram_keys, word_pieces

#: Rows of each language that the weights are fitted on, and words of each that are used at most,
#: in runs spread over the whole text.
FIT_ROWS, ROW_WORDS, RUN_WORDS = 400, 1024, 32
#: Hashed features; counts from which a word is in a language's lexicon.
BUCKETS, LEXICON_COUNT = 1 << 17, 3
#: Words of a segment.
SEGMENT = 64
UNKNOWN = "und"


class Model:
    def __init__(self, languages: list[str], lexicon: dict[str, int]) -> None:
        """``lexicon``: for each word the languages that know it, a bit each."""
        self.languages, self.lexicon = languages, lexicon
        count = len(languages)
        self.weights = np.zeros((BUCKETS + count, count), np.float32)
        self.transitions = np.zeros((count, count))

    def features(self, spelled: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the weights for each word, one after the other, and their number for each."""
        owner, keys, place = ngram_keys(spelled, 5)
        size = np.bincount(owner, minlength=len(spelled))
        ends = place == size[owner] - 1
        parts, owners = [], []
        for length in (2, 3, 4, 5):  # from 4 letters on only at the begin or the end
            use = keys[length] != 0
            if length > 3:
                use &= ends | (place == length - 1)
            parts.append(keys[length][use] >> np.uint64(47))
            owners.append(owner[use])
        known = [self.lexicon.get(w, 0) for w in spelled]
        for row, (word, held) in enumerate(zip(spelled, known)):
            if held:
                whole = [hash_of(word)] + [BUCKETS + i for i in range(len(self.languages))
                                           if held >> i & 1]
                parts.append(np.array(whole, np.uint64))
                owners.append(np.full(len(whole), row))
        rows, owner = np.concatenate(parts).astype(np.int64), np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return rows[order], np.bincount(owner, minlength=len(spelled))

    def word_scores(self, spelled: list[str]) -> np.ndarray:
        rows, count = self.features(spelled)
        return np.add.reduceat(self.weights[rows], np.cumsum(count) - count, axis=0)


def hash_of(word: str) -> int:
    value = 1469598103934665603
    for byte in word.encode():
        value = (value ^ byte) * 1099511628211 & (1 << 64) - 1
    return value >> 47


def marginals(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Probabilities of each label for each word of texts that lie one after the other, with
    ``lengths`` words each (at least one)."""
    count = scores.shape[1]
    step = np.exp(transitions - transitions.max())
    parts = -(-lengths // SEGMENT)
    total = int(parts.sum())
    text = np.repeat(np.arange(len(lengths)), parts)
    first = np.cumsum(parts) - parts
    number = np.arange(total) - first[text]
    place = np.arange(len(scores)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = (np.repeat(first, lengths) + place // SEGMENT, place % SEGMENT)
    emitted = np.ones((total, SEGMENT, count))
    emitted[at] = np.exp(scores - scores.max(1, keepdims=True))
    real = np.zeros((total, SEGMENT), bool)
    real[at] = True

    def move(of: np.ndarray, i: int, ahead: bool) -> np.ndarray:
        """One word further on; rest after a text's last word."""
        if ahead:
            new = (of @ step) * (emitted[:, None, i] if of.ndim == 3 else emitted[:, i])
        else:
            new = (of * emitted[:, i]) @ step.T
        new /= new.sum(-1, keepdims=True).max(-2, keepdims=True) if of.ndim == 3 else new.sum(
            -1, keepdims=True)
        keep = real[:, i]
        return np.where(keep[:, None, None] if of.ndim == 3 else keep[:, None], new, of)

    product = np.broadcast_to(np.eye(count), (total, count, count))
    start = number == 0
    for i in range(SEGMENT):
        new = move(product, i, True)
        if i == 0:  # before a text's first word there is no transition
            begin = np.broadcast_to(emitted[:, None, 0], new.shape) / count
            new = np.where(start[:, None, None], begin, new)
        product = new
    into = np.full((total, count), 1 / count)
    out = np.full((total, count), 1 / count)
    for k in range(1, int(parts.max())):  # a step for each segment of the longest text
        now = first[parts > k] + k
        state = np.einsum("si,sij->sj", into[now - 1], product[now - 1])
        into[now] = state / state.sum(1, keepdims=True)
    for k in range(int(parts.max()) - 2, -1, -1):
        now = first[parts > k + 1] + k
        state = np.einsum("sij,sj->si", product[now + 1], out[now + 1])
        out[now] = state / state.sum(1, keepdims=True)

    forward, state = np.empty_like(emitted), into
    for i in range(SEGMENT):
        new = move(state, i, True)
        if i == 0:
            begin = emitted[:, 0] / emitted[:, 0].sum(1, keepdims=True)
            new = np.where(start[:, None], begin, new)
        forward[:, i] = state = new
    backward, state = np.empty_like(emitted), out
    for i in range(SEGMENT - 1, -1, -1):
        backward[:, i] = state
        state = move(state, i, False)
    found = (forward * backward)[at]
    return found / found.sum(1, keepdims=True)


def expected_moves(scores: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sequences of equal length (axes: sequence, word, label) the probabilities of labels, and
    of pairs of neighbouring labels summed over all."""
    step = np.exp(transitions)
    emitted = np.exp(scores - scores.max(2, keepdims=True))
    forward, backward = np.empty_like(emitted), np.ones_like(emitted)
    forward[:, 0] = emitted[:, 0] / emitted[:, 0].sum(1, keepdims=True)
    for i in range(1, scores.shape[1]):
        state = (forward[:, i - 1] @ step) * emitted[:, i]
        forward[:, i] = state / state.sum(1, keepdims=True)
    for i in range(scores.shape[1] - 2, -1, -1):
        state = (emitted[:, i + 1] * backward[:, i + 1]) @ step.T
        backward[:, i] = state / state.sum(1, keepdims=True)
    label = forward * backward
    label /= label.sum(2, keepdims=True)
    pair = forward[:, :-1, :, None] * step * (emitted * backward)[:, 1:, None, :]
    pair /= pair.sum((2, 3), keepdims=True)
    return label, pair.sum((0, 1))


def train(languages: list[str], runs: list[tuple[int, list[str]]], steps: int = 400,
          batch: int = 64, rate: float = 0.2, seed: int = 5) -> Model:
    """Weights by gradient steps on the log-likelihood. ``runs``: the language's number and the
    words of pieces of monolingual texts. A training sequence is put together from runs of one or
    several languages, so that the transitions learn to stay and to switch."""
    counts: dict[str, np.ndarray] = {}
    for label, run in runs:
        for word in run:
            counts.setdefault(word, np.zeros(len(languages), np.int64))[label] += 1
    lexicon = {w: sum(1 << i for i, n in enumerate(c) if n >= LEXICON_COUNT)
               for w, c in counts.items() if c.max() >= LEXICON_COUNT}
    model = Model(languages, lexicon)
    if len(languages) < 2:
        return model
    spelled = sorted(counts)
    number = {w: i for i, w in enumerate(spelled)}
    rows, count = model.features(spelled)
    first = np.cumsum(count) - count
    of_label: list[list[np.ndarray]] = [[] for _ in languages]
    for label, run in runs:
        if run:
            of_label[label].append(np.array([number[w] for w in run]))
    rng = np.random.default_rng(seed)
    squares, move_squares = np.full(len(model.weights), 1e-6), np.full(model.transitions.shape, 1e-6)
    width = 48
    for _ in range(steps):
        word, label = np.empty((batch, width), np.int64), np.empty((batch, width), np.int64)
        for row in range(batch):
            at, own = 0, int(rng.integers(len(languages)))
            while at < width:
                pick = of_label[own]
                run = pick[int(rng.integers(len(pick)))]
                take = min(width - at, int(rng.integers(4, RUN_WORDS + 1)), len(run))
                begin = int(rng.integers(len(run) - take + 1))
                word[row, at:at + take] = run[begin:begin + take]
                label[row, at:at + take] = own
                at += take
                if rng.random() < 0.3:
                    own = int(rng.integers(len(languages)))
        some, back = np.unique(word, return_inverse=True)
        held = np.concatenate([rows[first[w]:first[w] + count[w]] for w in some])
        of_word = np.repeat(np.arange(len(some)), count[some])
        value = np.zeros((len(some), len(languages)))
        np.add.at(value, of_word, model.weights[held])
        probability, moves = expected_moves(value[back.reshape(word.shape)], model.transitions)
        truth = np.eye(len(languages))[label]
        gradient = np.zeros_like(value)
        np.add.at(gradient, back.ravel(), (truth - probability).reshape(-1, len(languages)))
        of_row = np.zeros_like(model.weights, dtype=np.float64)
        np.add.at(of_row, held, gradient[of_word])
        of_row /= batch
        squares += (of_row ** 2).sum(1)
        model.weights += (rate * of_row / np.sqrt(squares)[:, None]).astype(np.float32)
        seen = np.zeros_like(model.transitions)
        np.add.at(seen, (label[:, :-1].ravel(), label[:, 1:].ravel()), 1)
        slope = (seen - moves) / batch
        move_squares += slope ** 2
        model.transitions += rate * slope / np.sqrt(move_squares)
    return model


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", id: str = "doc_id",
        fit_rows: int = FIT_ROWS, row_words: int = ROW_WORDS) -> Model:
    """A model from rows whose language is known (null ones are left out).

    The weights are fitted on a bounded sample, whose size is a parameter: about ``fit_rows`` rows
    of each language, picked by a hash of ``id``, twice as many at most, and of each ``row_words``
    words at most, in runs spread over the whole text. Only those words reach the driver. Without
    labelled words there is no language, and every text is ``und``.
    """
    rows = labelled.filter(F.col(f"`{lang}`").isNotNull()).select(
        F.col(f"`{text}`").cast("string").alias("text"),
        F.col(f"`{lang}`").cast("string").alias("lang"),
        F.pmod(F.xxhash64(F.col(f"`{id}`"), F.lit(23)), F.lit(1 << 30)).alias("draw"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], {})
    languages = sorted(sizes)
    share = F.create_map(*[F.lit(x) for name in languages
                           for x in (name, int(min(1.0, fit_rows / sizes[name]) * (1 << 30)))])
    picked = (rows.filter(F.col("draw") < share[F.col("lang")]).orderBy("draw")
              .limit(2 * fit_rows * len(languages)))

    def sampled(batches):
        for batch in batches:
            names, out = batch.column(1).to_pylist(), ([], [])
            for place, content in enumerate(batch.column(0).to_pylist()):
                for run in spread_runs(content or "", row_words):
                    out[0].append(names[place])
                    out[1].append(run)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.string()), pa.array(out[1], pa.list_(pa.string()))],
                ["lang", "words"])

    table = picked.mapInArrow(sampled, "lang string, words array<string>").collect()
    runs = sorted((languages.index(r["lang"]), list(r["words"])) for r in table)
    present = sorted({label for label, _ in runs})
    return train([languages[i] for i in present], [(present.index(i), run) for i, run in runs])


def spread_runs(text: str, most: int) -> list[list[str]]:
    """Runs of neighbouring words, all of them or ``most`` words spread over the whole text."""
    pieces, whole = word_pieces([text])
    spelled = [whole[a:b] for a, b in zip(pieces.start.tolist(), pieces.end.tolist())]
    runs = [spelled[i:i + RUN_WORDS] for i in range(0, len(spelled), RUN_WORDS)]
    take = max(1, most // RUN_WORDS)
    if len(runs) > take:
        runs = [runs[i * len(runs) // take] for i in range(take)]
    return runs


def _labelled(values: WordValues, model: Model, texts: list[str]) -> tuple[Pieces, np.ndarray, np.ndarray]:
    """The words of the texts, the words of each text, and the probabilities of each word."""
    pieces, whole = word_pieces(texts)
    count = np.bincount(pieces.text, minlength=len(texts))
    if not len(pieces.text):
        return pieces, count, np.zeros((0, len(model.languages)))
    scores = values(pieces, whole).astype(np.float64)
    return pieces, count, marginals(scores, count[count > 0], model.transitions)


def label(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with ``lang_pred`` and ``score``, the mean probability of
    that language over the words of the whole text; columns of these names are replaced. A null
    text, or one without a letter, is ``und`` with score 0. Of equal languages the first by name
    wins. Rows are neither joined nor dropped."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # its size is fixed but for the lexicon

    def make():
        model = shared.value
        values = WordValues(model.word_scores, max(1, len(model.languages)))

        def of(texts):
            names, scores = [], []
            for _, group in chunks(texts):
                if not model.languages:
                    names += [UNKNOWN] * len(group)
                    scores.append(np.zeros(len(group)))
                    continue
                pieces, count, probability = _labelled(values, model, group)
                sums = np.stack([np.bincount(pieces.text, weights=p, minlength=len(group))
                                 for p in probability.T], 1)
                best = sums.argmax(1)
                names += [model.languages[b] if n else UNKNOWN for b, n in zip(best, count)]
                scores.append(np.clip(sums.max(1) / np.maximum(count, 1), 0, 1))
            return [pa.array(names, pa.string()), pa.array(np.concatenate(scores))]
        return of

    return with_results(df, text, "lang_pred string, score double", make, keep)


def spans(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df`` (or ``keep``) with ``spans``: the runs of neighbouring words that are likeliest of one
    language, each with ``begin`` and ``end`` (characters of the lower-cased text) and ``lang``.
    A null text, or one without a letter, has no span."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value
        values = WordValues(model.word_scores, max(1, len(model.languages)))
        kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

        def of(texts):
            out = []
            for _, group in chunks(texts):
                own = [[] for _ in group]
                if model.languages:
                    pieces, _, probability = _labelled(values, model, group)
                    best, bounds = probability.argmax(1), np.cumsum([0] + [len(t.lower()) for t in group])
                    for i, (t, b) in enumerate(zip(pieces.text.tolist(), best.tolist())):
                        begin, end = (int(x[i] - bounds[t]) for x in (pieces.start, pieces.end))
                        if own[t] and own[t][-1]["lang"] == model.languages[b]:
                            own[t][-1]["end"] = end
                        else:
                            own[t].append({"begin": begin, "end": end, "lang": model.languages[b]})
                out += own
            return [pa.array(out, kind)]
        return of

    return with_results(df, text, "spans array<struct<begin:int,end:int,lang:string>>", make, keep)
