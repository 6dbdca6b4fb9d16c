"""Cross-entropy difference: how much better a target model tells a text's words than a background
model does.

Both are bigram models over one vocabulary, the distinct words of all documents. A pair's probability
is its count, backed off to the word's with a weight of ``BACKOFF`` words. The models are matched: the
background's counts are scaled to the target's number of words, so that smoothing acts alike on both
without leaving out any text.

All documents are counted, and each word and each pair of neighbouring words has a count of its own,
under the words' 64-bit keys. One shuffle does it: a row for each pair of each text goes to the task
of its second word. That task has all pairs that end in the word, so it has their counts, the word's
count and, from the texts that do not end there, the word's count as a context; it gives each
text its share of the loss. Rows of frequent words would go to one task, so these go by their pair, and
the counts of the words, at most ``2 / SHARE`` of them, are known beforehand. Rows of frequent pairs, as
many at most, are not shuffled at all. Words are shuffled in ``TURNS`` turns, by
their key, and a turn's shuffles are removed when its losses are summed, so that the disk holds the
rows of one turn only. The first turn counts the frequent pairs as it goes, and the last one has their
losses.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import CHUNK_CHARS, chunks, kept, slices
from tidemark.llm.words import word_pieces

#: Weight of the word's probability in a pair's, and of a word that was never seen.
BACKOFF, UNSEEN = 20.0, 0.5
#: Rows of whole words that a task works on at once, about.
TOGETHER = 500_000
#: Characters that words are split from at once, so that what is made of them stays near the processor.
BLOCK_CHARS = 100_000
#: Characters whose words are counted at once.
COUNTED_CHARS = 4_000_000
#: A word or pair is frequent if it has this share of all rows (a row is a pair of a text); some that
#: have half of it are taken for frequent, too.
SHARE = 1 / 2000
#: Turns that the words are shuffled in, one after the other. At least 2: the last needs what the first counts.
TURNS = 2

RESULTS = ("n_words", "target_loss", "background_loss", "difference")

# What a row of the shuffle says: it is counted, for the target, too; its word ends the text; it is
# scored; it holds sums.
_COUNTED, _TARGET, _LAST, _SCORED, _SUMS = 1, 2, 4, 8, 16

# A row of the shuffle. ``part`` is the key of the word, or of the pair if the word is frequent; ``code``
# holds the number of occurrences, the place of a frequent word, plus 1, and the flags. A row of sums has
# two doubles in ``part`` and ``before``: the losses of a text, or with a number below 0 the counts of a
# frequent pair.
_ROW = "part long, before long, number long, code long"
_PLACE_BITS, _COUNT_BITS = 8, 32


def _code(n: np.ndarray, frequent: np.ndarray, flags: np.ndarray) -> np.ndarray:
    return (n.astype(np.int64) << _COUNT_BITS) | ((frequent.astype(np.int64) + 1) << _PLACE_BITS) | flags


def _decoded(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    place = (code >> _PLACE_BITS) & ((1 << _COUNT_BITS - _PLACE_BITS) - 1)
    return code >> _COUNT_BITS, place - 1, code & ((1 << _PLACE_BITS) - 1)


def pairs_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word of the lower-cased texts (runs of letters): its text, the key of the word
    before it (0 at the begin of a text) and its own key."""
    found = []
    for first, some in chunks(texts, BLOCK_CHARS):
        pieces, _ = word_pieces(some)
        found.append((pieces.text + first, pieces.keys()))
    of, keys = map(np.concatenate, zip(*found, strict=True)) if found else (
        np.zeros(0, np.int64), np.zeros(0, np.uint64))
    new = np.ones(len(keys), bool)
    new[1:] = of[1:] != of[:-1]
    before = np.where(new, np.uint64(0), np.roll(keys, 1)) if len(keys) else keys
    return of, before.view(np.int64), keys.view(np.int64)


def _begins(*columns: np.ndarray) -> np.ndarray:
    """Whether a new value begins at a row of ``columns``."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return new


def _mixed(word: np.ndarray, before: np.ndarray) -> np.ndarray:
    """A 64-bit key of a pair."""
    x = word.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ before.view(np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))).view(np.int64)


def _order_within(group: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows by ``group``, whose numbers ascend from row to row, and in it by as many of
    the first bits of ``key`` as one sorted number holds beside it; these numbers in that order."""
    bits = max(int(group[-1]).bit_length(), 1) if len(group) else 1
    joint = (group.astype(np.uint64) << np.uint64(64 - bits)) | (key.view(np.uint64) >> np.uint64(bits))
    order = np.argsort(joint)
    return order, joint[order]


def _order_near(key: np.ndarray) -> np.ndarray:
    """An order of the rows by the first bits of ``key``; equal ones stay in their order."""
    bits = np.uint64(len(key).bit_length())
    return (np.sort(key.view(np.uint64) >> bits << bits | np.arange(len(key), dtype=np.uint64))
            & ((np.uint64(1) << bits) - np.uint64(1))).view(np.int64)


def _rows_of(texts: list[str]) -> tuple[np.ndarray, ...]:
    """The distinct pairs of each text: text, word before, word, number, and whether the word is
    the text's last one (said in one row of the text). And the number of words of each text.
    Pairs of a text whose keys begin alike may come in several rows, which add up."""
    of, before, word = pairs_of(texts)
    order, _ = _order_within(of, _mixed(word, before))
    new = _begins(of[order], word[order], before[order])
    at = np.flatnonzero(new)
    rows, n = order[at], np.diff(np.append(at, len(order)))
    is_last = np.zeros(len(rows), bool)
    ends = np.append(of[1:] != of[:-1], True) if len(of) else np.zeros(0, bool)
    is_last[(np.cumsum(new) - 1)[ends[order]]] = True
    return of[rows], before[rows], word[rows], n, is_last, np.bincount(of, minlength=len(texts))


@dataclass(frozen=True)
class Model:
    """One side of the comparison over ``docs``, whose boolean column ``target`` says which belong to
    the target."""

    name: str
    docs: DataFrame
    target: str
    text: str


def fit(docs: DataFrame, target: str, text: str = "text") -> tuple[Model, Model]:
    """The target model, of the rows where the boolean column ``target`` is true, and the background
    model, of all rows. Null texts have no words. Nothing is computed before texts are scored."""
    return tuple(Model(name, docs, target, text) for name in ("target", "background"))


@dataclass(frozen=True)
class _Known:
    """What all tasks know: the frequent words and pairs with their counts, sorted by key, and sums.
    Counts are given for the target and the background."""

    words: np.ndarray
    word_counts: np.ndarray
    context_counts: np.ndarray
    pair_words: np.ndarray
    pair_befores: np.ndarray
    pair_counts: np.ndarray
    totals: np.ndarray
    texts: np.ndarray
    vocabulary: int

    @property
    def scales(self) -> np.ndarray:
        target, background = self.totals
        return np.array([1.0, target / background if target else 1.0])

    def place_of_words(self, words: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at, -1)

    def place_of_pairs(self, words: np.ndarray, befores: np.ndarray) -> np.ndarray:
        keys = _mixed(self.pair_words, self.pair_befores)
        if not len(keys):
            return np.full(len(words), -1)
        order = np.argsort(keys)
        at = order[np.minimum(np.searchsorted(keys[order], _mixed(words, befores)), len(keys) - 1)]
        same = (self.pair_words[at] == words) & (self.pair_befores[at] == befores)
        return np.where(same, at, -1)

    def loss(self, n: np.ndarray, last: np.ndarray, pair: np.ndarray, word: np.ndarray,
             context: np.ndarray) -> np.ndarray:
        """What rows add to the loss of their text: each occurrence as a word, given the pair, and as
        a context of the next word. One line for each side."""
        out = []
        for scale, total, p, w, c in zip(self.scales, self.totals, pair, word, context, strict=True):
            alone = (w * scale + UNSEEN) / (total * scale + UNSEEN * self.vocabulary)
            out.append((n - last) * np.log(c * scale + BACKOFF)
                       - n * np.log(p * scale + BACKOFF * alone))
        return np.array(out)


def _batches(batches, column: int, most: int = CHUNK_CHARS):
    """Groups of texts of at most ``most`` characters, with the rows they came from."""
    for batch in batches:
        for some in slices(batch, column):
            for first, group in chunks(some.column(column).to_pylist(), most):
                yield some.slice(first, len(group)), group


def _known(rows: DataFrame) -> _Known:
    """``rows``: text, and whether it is counted, counted for the target, and scored."""
    sums = ["background", "target", "last_background", "last_target", "n_rows"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, group in _batches(batches, 0, COUNTED_CHARS):
            of, before, word, n, last, _ = _rows_of(group)
            if not len(of):
                continue
            flags = some.column(1).to_numpy()[of]
            counted, target = (flags & _COUNTED) > 0, (flags & _TARGET) > 0
            columns = [n * counted, n * target, last * counted, last * target,
                       np.ones(len(n), np.int64)]
            order = np.argsort(word)
            at = np.flatnonzero(_begins(word[order]))
            parts = [(np.zeros(len(at), np.int64), word[order[at]],
                      [np.add.reduceat(c[order].astype(np.int64), at) for c in columns], False)]
            # a pair has that share only if its word has
            least = SHARE / 2 * len(order)
            size = np.diff(np.append(at, len(order)))
            order = order[np.repeat(size >= least, size)]
            order = order[np.argsort(_mixed(word[order], before[order]))]
            at = np.flatnonzero(_begins(word[order], before[order]))
            size = np.diff(np.append(at, len(order)))
            # one that is frequent in all has half of that share in the groups where it is so here
            much = np.flatnonzero(size >= least)
            zero = np.zeros(len(much), np.int64)
            parts.append((before[order[at[much]]], word[order[at[much]]],
                          [zero, zero, zero, zero, size[much]], True))
            for b, w, values, pair in parts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(w), pair)), pa.array(b), pa.array(w),
                     *map(pa.array, values)], ["pair", "before", "word", *sums])

    found = kept(rows.mapInArrow(
        count, "pair boolean, before long, word long, " + ", ".join(f"{c} long" for c in sums))
        .groupBy("pair", "before", "word").agg(*[F.sum(c).alias(c) for c in sums]), "word-counts",
        last_use=True)
    words = found.filter("not pair")
    totals = words.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
                       F.count_if(F.col("background") > 0).alias("vocabulary")).first()
    # 2 / SHARE of each at most; a pair that is taken ends in a word that is
    much = F.col("n_rows") >= SHARE / 2 * totals["n_rows"]
    frequent = words.filter(much).collect()
    pairs = [(r["before"], r["word"]) for r in found.filter("pair").filter(much).select(
        "before", "word").collect()]
    frequent.sort(key=lambda r: r["word"])

    def table(values, width: int) -> np.ndarray:
        return np.array(values, np.int64).reshape(-1, width).T

    word_counts = table([(r["target"], r["background"]) for r in frequent], 2)
    lasts = table([(r["last_target"], r["last_background"]) for r in frequent], 2)
    before, word = table(pairs, 2)
    return _Known(np.array([r["word"] for r in frequent], np.int64), word_counts,
                  word_counts - lasts, word, before, np.zeros((2, len(word)), np.int64),
                  np.array([totals["target"], totals["background"]]),
                  np.array([totals["last_target"], totals["last_background"]]),
                  totals["vocabulary"])


def _with_pair_counts(known: _Known, losses: DataFrame) -> _Known:
    """``known`` with the exact counts of the frequent pairs, which the first turn has summed."""
    counts = known.pair_counts.copy()
    for r in losses.filter("number < 0").collect():  # 2 / SHARE rows at most
        counts[:, -1 - r["number"]] = r["target_loss"], r["background_loss"]
    return replace(known, pair_counts=counts)


def _listed(rows: DataFrame, known: _Known, turn: int) -> DataFrame:
    """A row for each pair of each text whose part is of this turn, but for frequent pairs. The first turn
    has sums of the counts of these instead, the last one sums of their losses in each text. Rows of
    neighbouring texts are sorted by their words, so that these take little room in the shuffle."""
    names = [c.split()[0] for c in _ROW.split(", ")]
    first, final = turn == 0, turn == TURNS - 1

    def bits(x: np.ndarray) -> np.ndarray:
        return x.astype(np.float64).view(np.int64)

    def batch(*columns: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair_counts = np.zeros((2, len(known.pair_words)))
        for some, group in _batches(batches, 0):
            flags, number = some.column(1).to_numpy(), some.column(2).to_numpy()
            of, before, word, n, last, _ = _rows_of(group)
            frequent = known.place_of_words(word)
            # a frequent pair ends in a frequent word, as that has all rows of the pair
            pair = np.full(len(word), -1)
            often = np.flatnonzero(frequent >= 0)
            pair[often] = known.place_of_pairs(word[often], before[often])
            hot = pair >= 0
            sums = []
            if first:
                for side, flag in enumerate((_TARGET, _COUNTED)):
                    counted = hot & ((flags[of] & flag) > 0)
                    pair_counts[side] += np.bincount(pair[counted], weights=n[counted],
                                                     minlength=pair_counts.shape[1])
            if final:
                here = np.flatnonzero(hot & ((flags[of] & _SCORED) > 0))
                shares = known.loss(n[here], last[here], known.pair_counts[:, pair[here]],
                                    known.word_counts[:, frequent[here]],
                                    known.context_counts[:, frequent[here]])
                texts, at = np.unique(of[here], return_index=True)
                if len(texts):  # rows are in the order of their texts
                    target, background, n_hot = (np.add.reduceat(x, at) for x in (*shares, n[here]))
                    sums = [bits(target), bits(background), number[texts],
                            _code(n_hot, np.full(len(texts), -1), _SUMS)]
            part = np.where(frequent >= 0, _mixed(word, before), word)
            mine = np.flatnonzero(~hot & (_mixed(part, part).view(np.uint64) % np.uint64(TURNS)
                                          == np.uint64(turn)))
            mine = mine[_order_near(part[mine])]
            of = of[mine]
            listed = [part[mine], before[mine], number[of],
                      _code(n[mine], frequent[mine], flags[of] | np.where(last[mine], _LAST, 0))]
            yield batch(*(listed if not sums else map(np.concatenate, zip(listed, sums, strict=True))))
        found = np.flatnonzero(pair_counts.any(0))
        if len(found):
            yield batch(*map(bits, pair_counts[:, found]), -1 - found,
                        _code(np.zeros(len(found)), np.full(len(found), -1), _SUMS))

    return rows.mapInArrow(make, _ROW)


_LOSSES = "number long, n_words long, target_loss double, background_loss double"


def _pairs_together(part: np.ndarray, before: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """An order of rows, which are sorted by ``part``, in which those of a word and of a pair are
    neighbours."""
    order, joint = _order_within(np.cumsum(_begins(part)) - 1, _mixed(before, frequent))
    part, before, frequent = part[order], before[order], frequent[order]
    # the numbers do not hold whole keys: seldom, other pairs have the same one
    apart = (joint[1:] == joint[:-1]) & (before[1:] != before[:-1])
    apart |= (part[1:] == part[:-1]) & (frequent[1:] != frequent[:-1])
    return order[np.lexsort((before, frequent, part))] if apart.any() else order


def _losses(listed: DataFrame, known: _Known) -> DataFrame:
    """What each scored row adds to the losses and to the number of words of its text; sums are handed
    on. Spark adds them up before it shuffles them."""
    names = [c.split()[0] for c in _LOSSES.split(", ")]

    def shares(part: np.ndarray, before: np.ndarray, number: np.ndarray, code: np.ndarray) -> list:
        n, frequent, flags = _decoded(code)
        whole = np.flatnonzero((flags & _SUMS) > 0)
        rows = np.flatnonzero((flags & _SUMS) == 0)
        sums = [number[whole], n[whole], part[whole].view(np.float64), before[whole].view(np.float64)]
        if not len(rows):
            return sums
        part, before, number, n, frequent, flags = (
            x[rows] for x in (part, before, number, n, frequent, flags))
        order = _pairs_together(part, before, frequent)
        part, before, number, n, frequent, flags = (
            x[order] for x in (part, before, number, n, frequent, flags))
        new = _begins(part, frequent)
        pair = new | _begins(before)
        at_pair, at_word = np.flatnonzero(pair), np.flatnonzero(new)
        of_pair, of_word = np.cumsum(pair) - 1, np.cumsum(new) - 1
        last = (flags & _LAST) > 0
        counts = []
        for flag in (_TARGET, _COUNTED):
            mine = (flags & flag) > 0
            times = n * mine
            alone = np.add.reduceat(times, at_word)
            ends = np.add.reduceat((last & mine).astype(np.int64), at_word)
            counts.append((np.add.reduceat(times, at_pair)[of_pair], alone[of_word],
                           (alone - ends)[of_word]))
        pairs, alone, context = (np.array(x) for x in zip(*counts, strict=True))
        hot = np.flatnonzero(frequent >= 0)
        alone[:, hot] = known.word_counts[:, frequent[hot]]
        context[:, hot] = known.context_counts[:, frequent[hot]]
        scored = np.flatnonzero((flags & _SCORED) > 0)
        found = [number[scored], n[scored], *known.loss(
            n[scored], last[scored], pairs[:, scored], alone[:, scored], context[:, scored])]
        return [np.concatenate(x) for x in zip(sums, found, strict=True)]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        n_held, due = 0, TOGETHER

        def finished(columns: list[np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(list(map(pa.array, shares(*columns))), names)

        for batch in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            n_held += batch.num_rows
            if n_held < due:
                continue
            columns = [np.concatenate(x) for x in zip(*held, strict=True)]
            # all rows of a word, or of a pair that ends in a frequent one, are needed together
            change = np.flatnonzero(columns[0][1:] != columns[0][:-1])
            end = int(change[-1]) + 1 if len(change) else 0
            if end:
                yield finished([c[:end] for c in columns])
            held = [[c[end:] for c in columns]]
            n_held -= end
            due = n_held + TOGETHER
        if n_held:
            yield finished([np.concatenate(x) for x in zip(*held, strict=True)])

    # by one number only, which Spark sorts by its digits; a group's rows are sorted further here
    return listed.repartition("part").sortWithinPartitions("part").mapInArrow(apply, _LOSSES)


def score(df: DataFrame, models: tuple[Model, Model], text: str = "text",
          keep: list[str] | None = None, same: bool = False) -> DataFrame:
    """``df`` (or its columns ``keep``) with ``n_words``, ``target_loss`` and ``background_loss``
    (mean negative log-probability of a word of the whole text) and ``difference``, target less
    background: the lower, the nearer to the target. A null text, or one without a letter, has 0
    words and null losses. Columns of these names are replaced; no row is dropped.

    With ``same`` the documents of the models are scored, with columns of theirs; they are then split
    and shuffled once for both. Else ``df``'s texts are only scored.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c not in RESULTS]
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row")
    model = models[0]
    counted = F.when(F.col(f"`{model.target}`"), _COUNTED | _TARGET).otherwise(_COUNTED)
    value = F.col(f"`{model.text}`").cast("string").alias("text")
    if same:
        docs = model.docs.select(row, value, counted.bitwiseOR(F.lit(_SCORED)).alias("flags"))
    else:
        docs = df.select(row, F.col(f"`{text}`").cast("string").alias("text"),
                         F.lit(_SCORED).alias("flags"))
        docs = docs.unionByName(model.docs.select(
            F.lit(None).cast(docs.schema["_row"].dataType).alias("_row"), value,
            counted.alias("flags")))
    # written with its number, so that a text keeps it in all passes
    docs = kept(docs.select("_row", "text", F.col("flags").cast("int").alias("flags"),
                            F.monotonically_increasing_id().alias("number")),
                "numbered-texts", last_use=True)
    texts = docs.select("text", "flags", "number")
    known = _known(texts)
    sums = [F.sum(c).alias(c) for c in ("n_words", "target_loss", "background_loss")]
    turns: list[DataFrame] = []
    for turn in range(TURNS):
        turns.append(kept(_losses(_listed(texts, known, turn), known).groupBy("number").agg(*sums),
                          "losses", last_use=True))
        if turn == 0 and len(known.pair_words):
            known = _with_pair_counts(known, turns[0])
    # the begin of each text is a context, too
    begins = np.log(known.texts * known.scales + BACKOFF).tolist()
    scores = functools.reduce(DataFrame.unionAll, turns).filter("number >= 0").groupBy("number").agg(
        F.sum("n_words").alias("n_words"),
        *[((F.sum(c) + begin) / F.sum("n_words")).alias(c)
          for c, begin in zip(("target_loss", "background_loss"), begins, strict=True)])
    rows = docs.filter(F.col("flags").bitwiseAND(F.lit(_SCORED)) > 0).select("_row", "number")
    return rows.join(scores.hint("merge"), "number", "left").select(
        "_row.*", F.coalesce("n_words", F.lit(0)).cast("long").alias("n_words"), "target_loss",
        "background_loss", (F.col("target_loss") - F.col("background_loss")).alias("difference"))
