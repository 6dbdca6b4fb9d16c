"""Repair of damaged conversations by the cheapest edits, as a Viterbi search in parallel chunks.

The roles of a conversation must read ``(s?(ua)+)?`` by their initials: nothing, or user and assistant
in turns behind at most one system turn. That is an automaton of four states. Every turn is kept, given
another role, or deleted, and turns may be inserted; :class:`Costs` says what each costs.

For every place of a conversation the search needs the least cost from each state to the end. These
vectors are computed backwards in chunks of rows, all chunks at the same time. A chunk does not know
the vector behind it and starts from a speculative one. Fix-up passes then hand each chunk the vector
that the next one found and run it again until a vector differs from the one found before only by a
constant: everything before it differs by that constant, too, which changes no choice. The edits are
then read forwards along the stitched vectors, always the first in the alphabet of those that cost
least; chunks are traced from all four states at once and chained.

Conversations are cut by a range partitioning on conversation and turn, so that a conversation with a
third of all rows spans many tasks. One that lies within a task is finished there. The others become
parts of bounded size: four unit vectors behind a part give its matrix of costs, and the matrices of a
conversation's parts, one small row each, give each part the true vector behind it.

Rows are taken by turn (null first), then by role and text. A null role or text counts as one space. A
null ``conv_id`` is a conversation of its own. Equal rows are taken in any order, which changes nothing.
Columns other than the four are not read. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.digests import streamed_sha256
from tidemark.llm.frames import SLICE_BYTES, kept

WHITE = " \t\n\x0b\f\r"
#: Rows of a chunk.
CHUNK_ROWS = 16
#: Bytes of text in a part of a conversation that one task does not hold whole.
PART_BYTES = SLICE_BYTES

# States: nothing yet, behind a system turn, behind a user turn, behind an assistant turn. A new
# user or assistant turn, whichever is next, leads to _NEXT.
_NEXT = np.array([2, 2, 3, 2])
_ROLES = np.array([None, None, "user", "assistant"], object)
_SYSTEM, _USER, _ASSISTANT, _OTHER = range(4)
_KEPT = np.array([[1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1], [-1, -1, -1, -1]])
_NEVER = 1 << 40
_PLAIN, _TRUNCATED, _MUST_GO = range(3)
_FAULTS = np.array([None, "blank", "duplicate", "truncated"], object)
_KIND = np.array([_PLAIN, _MUST_GO, _MUST_GO, _TRUNCATED])
_DELETE, _INSERT, _KEEP, _REROLE = range(4)
_EDITS = np.array(["D", "I", "K", "R"], object)

_TURN = T.StructType([T.StructField("turn", T.LongType()), *[
    T.StructField(name, T.StringType()) for name in ("role", "text", "fault", "edit", "new_role")]])


@dataclass(frozen=True)
class Costs:
    """What edits cost; ``truncated`` is added for each truncated turn that stays."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5

    def __post_init__(self):
        if min(self.rerole, self.delete, self.truncated) < 0 or self.insert < 1:
            raise ValueError("costs must not be negative, and an insert must cost something")


class Search:
    """The automaton's least costs over many sequences of rows at once.

    ``codes`` holds one number for each row, its initial plus four times its kind; ``starts`` and
    ``ends`` delimit the sequences; ``behind`` is the cost vector behind each of them.
    """

    def __init__(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                 behind: np.ndarray, costs: Costs, chunk_rows: int = CHUNK_ROWS):
        self.costs, self.codes = costs, codes
        initial, kind = np.arange(12) % 4, np.arange(12) // 4
        extra = np.where(kind == _TRUNCATED, costs.truncated, 0)
        extra[kind == _MUST_GO] = _NEVER
        self._keep_to = np.where(_KEPT[initial] < 0, 0, _KEPT[initial])
        self._keep = np.where(_KEPT[initial] < 0, _NEVER, extra[:, None])
        self._rerole = extra + costs.rerole
        # chunks, in order; each knows its sequence, and whether another one of it follows
        lengths = ends - starts
        counts = -(-lengths // chunk_rows)
        self.of = np.repeat(np.arange(len(starts)), counts)
        first = np.cumsum(counts) - counts
        place = np.arange(len(self.of)) - first[self.of]
        self.begin = starts[self.of] + place * chunk_rows
        self.size = np.minimum(chunk_rows, ends[self.of] - self.begin)
        self.follows = place + 1 < counts[self.of]
        self.after = np.zeros((len(codes), 4), np.int64)  # least costs behind each row
        self.behind = behind
        self._cut = np.zeros(len(codes), np.int64)  # constants taken off at each row
        self.passes = 0
        self._run()
        self.before = behind.copy()  # least costs at the start of each sequence
        cut = np.concatenate([[0], np.cumsum(self._cut)])
        fixed = behind.min(1) + cut[ends] - cut[starts]
        heads = np.flatnonzero(place == 0)
        self.before[self.of[heads]] = self.front[heads] + fixed[self.of[heads], None]

    def _options(self, rows: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, ...]:
        """Costs of deleting, keeping and rerolling each row in each state, and the least cost."""
        codes = self.codes[rows]
        delete = after + self.costs.delete
        keep = np.take_along_axis(after, self._keep_to[codes], 1) + self._keep[codes]
        rerole = after[:, _NEXT] + self._rerole[codes][:, None]
        return delete, keep, rerole, self.closed(np.minimum(np.minimum(delete, keep), rerole))

    def closed(self, costs: np.ndarray) -> np.ndarray:
        """Least costs when turns may be inserted first."""
        for _ in range(3):
            costs = np.minimum(costs, costs[:, _NEXT] + self.costs.insert)
        return costs

    def _backwards(self, chunks: np.ndarray, vectors: np.ndarray, again: bool) -> None:
        """Run chunks from the vectors behind them; a repeated run stops where nothing changes."""
        sizes, begins = self.size[chunks], self.begin[chunks]
        running = np.ones(len(chunks), bool)
        for step in range(int(sizes.max(initial=0)) - 1, -1, -1):
            here = np.flatnonzero(running & (sizes > step))
            if not len(here):
                continue
            rows = begins[here] + step
            if again:  # vectors are kept less their least value, so equal means parallel
                same = (self.after[rows] == vectors[here]).all(1)
                running[here[same]] = False
                here, rows = here[~same], rows[~same]
            self.after[rows] = vectors[here]
            found = self._options(rows, vectors[here])[3]
            self._cut[rows] = found.min(1)
            vectors[here] = found - self._cut[rows][:, None]
        ended = chunks[running]
        self.front[ended] = vectors[running]

    def _run(self) -> None:
        count = len(self.of)
        last = ~self.follows
        normal = self.behind - self.behind.min(1, keepdims=True)
        used = np.zeros((count, 4), np.int64)  # the speculation: all states cost the same
        used[last] = normal[self.of[last]]
        self.front = np.zeros((count, 4), np.int64)
        self._backwards(np.arange(count), used.copy(), again=False)
        followed = np.flatnonzero(self.follows)
        due = followed[(self.front[followed + 1] != used[followed]).any(1)]
        while len(due):
            self.passes += 1
            used[due] = self.front[due + 1]
            old = self.front[due].copy()
            self._backwards(due, used[due].copy(), again=True)
            changed = due[(self.front[due] != old).any(1)]
            before = changed[changed > 0] - 1
            due = before[self.follows[before]]

    def trace(self) -> None:
        """For each chunk and each state before it: state, inserts and edit at each row."""
        longest = int(self.size.max(initial=0))
        shape = (len(self.of), longest, 4)
        self.states, self.inserts, self.edits = (np.zeros(shape, np.int8) for _ in range(3))
        self.left = np.tile(np.arange(4), (len(self.of), 1))  # state behind each chunk
        for step in range(longest):
            here = np.flatnonzero(self.size > step)
            rows = self.begin[here] + step
            after = self.after[rows]
            delete, keep, rerole, best = self._options(rows, after)
            state = self.left[here]
            self.states[here, step] = state
            inserts = np.zeros(state.shape, np.int8)
            edit = np.full(state.shape, -1, np.int8)
            kept_to = self._keep_to[self.codes[rows]]
            for _ in range(4):
                goal = np.take_along_axis(best, state, 1)
                open_ = edit < 0
                gone = open_ & (np.take_along_axis(delete, state, 1) == goal)
                edit[gone] = _DELETE
                open_ &= ~gone
                new = open_ & (np.take_along_axis(best, _NEXT[state], 1)
                               + self.costs.insert == goal)
                open_ &= ~new
                stays = open_ & (np.take_along_axis(keep, state, 1) == goal)
                edit[stays] = _KEEP
                other = open_ & ~stays
                edit[other] = _REROLE
                inserts[new] += 1
                state = np.where(new | other, _NEXT[state],
                                 np.where(stays, np.take_along_axis(kept_to, state, 1), state))
                if not new.any():
                    break
            self.inserts[here, step], self.edits[here, step] = inserts, edit
            self.left[here] = state

    def chained(self, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """State before each chunk and behind each sequence, from the states before sequences."""
        entered, ends = np.zeros(len(self.of), np.int64), first.tolist()
        of, left = self.of.tolist(), self.left.tolist()
        for chunk, sequence in enumerate(of):
            entered[chunk] = ends[sequence]
            ends[sequence] = left[chunk][ends[sequence]]
        return entered, np.array(ends, np.int64).reshape(-1)

    def rows(self, entered: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """State, number of inserts and edit at each row."""
        picked = [np.take_along_axis(a, entered[:, None, None], 2)[:, :, 0]
                  for a in (self.states, self.inserts, self.edits)]
        inside = np.arange(picked[0].shape[1])[None, :] < self.size[:, None]
        return tuple(a[inside] for a in picked)


def accepting(costs: Costs, count: int = 1) -> np.ndarray:
    """The cost vector behind a whole conversation."""
    end = np.array([0, 2 * costs.insert, costs.insert, 0], np.int64)
    return np.tile(end, (count, 1))


def _turns(table: pa.Table, faults: np.ndarray, starts: np.ndarray, ends: np.ndarray,
           search: Search | None = None, first: np.ndarray | None = None,
           close: np.ndarray | None = None) -> pa.Array:
    """The turns of each sequence with their edits, one list each."""
    size = len(faults)
    roles = table.column("role")
    if search is None:
        source, edits, offsets = np.arange(size), np.full(size, None, object), np.append(starts, size)
        new = edits
    else:
        search.trace()
        entered, left = search.chained(first)
        states, inserts, codes = search.rows(entered)
        old = np.array(roles.to_pylist(), object)
        edits = _EDITS[codes]
        state = states.astype(np.int64)
        at, role, order = [], [], []
        for turn in range(3):  # a state is left behind by at most three inserts
            some = np.flatnonzero(inserts > turn)
            state[some] = _NEXT[state[some]]
            at.append(some)
            role.append(_ROLES[state[some]])
            order.append(np.full(len(some), turn + 3))
        new = np.where(codes == _KEEP, old, np.where(codes == _REROLE, _ROLES[_NEXT[state]], None))
        for turn in range(2):
            some = np.flatnonzero(close & ((left == 1) | (left == 2)))
            left[some] = _NEXT[left[some]]
            at.append(ends[some])
            role.append(_ROLES[left[some]])
            order.append(np.full(len(some), turn))
        at, role, order = (np.concatenate(x) for x in (at, role, order))
        # inserts at the end of a sequence stand before those at the start of the next one
        by = np.lexsort((order, at))
        at, role, order = at[by], role[by], order[by]
        source = np.insert(np.arange(size), at, -1)
        edits = np.insert(edits, at, "I")
        new = np.insert(new, at, role)
        faults = np.insert(faults, at, 0)
        closing = order < 3
        # rows and inserts before the end of each sequence
        bounds = ends + np.searchsorted(at[~closing], ends, "left") + np.searchsorted(
            at[closing], ends, "right")
        offsets = np.concatenate([[0], bounds])
    indices = pa.array(source, mask=source < 0)
    text = table.column("text").take(indices)
    if (source < 0).any():
        text = pa.array(["" if s < 0 else t for s, t in zip(source, text.to_pylist(), strict=True)],
                        pa.string())
    fields = [table.column("turn").take(indices), roles.take(indices), text,
              pa.array(_FAULTS[faults], pa.string()), pa.array(edits, pa.string()),
              pa.array(new, pa.string())]
    fields = [f.combine_chunks() if isinstance(f, pa.ChunkedArray) else f for f in fields]
    fields = [f.cast(k) for f, k in zip(
        fields, (pa.int64(), *[pa.string()] * 5), strict=True)]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                    pa.StructArray.from_arrays(fields, _TURN.names))


def _first_faults(flags: np.ndarray, keys: list[bytes], starts: np.ndarray,
                  ends: np.ndarray) -> np.ndarray:
    """Faults of rows, where ``flags`` say blank (1) or truncated (3): duplicates come between."""
    faults = flags.copy()
    for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
        if end - start > 1:
            seen = set()
            for row in range(start, end):
                if flags[row] != 1:
                    if keys[row] in seen:
                        faults[row] = 2
                    seen.add(keys[row])
    return faults


def _sliced(rows: DataFrame, costs: Costs, part_bytes: int, chunk_rows: int) -> DataFrame:
    """Conversations that end inside their task, finished, and parts of the others."""
    kind = rows.schema["conv_id"]
    schema = T.StructType([
        kind, *T.StructType.fromDDL("slice int, part int, whole boolean, initials binary").fields,
        T.StructField("turns", T.ArrayType(_TURN)),
        T.StructField("keys", T.ArrayType(T.StructType.fromDDL("place int, key binary")))])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts = TaskContext.get().partitionId(), 0
        held, held_bytes = [], 0
        unset = object()
        first = cut = unset  # the slice's first conversation, and one of which a part is out

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, held_bytes, first, cut
            table = pa.Table.from_batches(held).combine_chunks()
            ids = table.column("conv_id").to_pylist()
            starts = [i for i in range(len(ids)) if not i or ids[i] != ids[i - 1]]
            first = ids[0] if first is unset else first
            # the last conversation may go on: it waits, unless it fills the buffer alone
            ready = starts if last or len(starts) == 1 else starts[:-1]
            if not last and len(starts) == 1:
                cut = ids[0]
            edge = [ids[s] in (first, cut) or (last and s == starts[-1]) for s in ready]
            end = len(ids) if ready is starts else starts[-1]
            rest = table.slice(end)
            held, held_bytes = rest.to_batches(), rest.nbytes
            yield from finish(table.slice(0, end), ids[:end], np.array(ready), np.array(edge))

        def finish(table, ids, starts, edge):
            nonlocal parts
            there = table.column("present").to_numpy(zero_copy_only=False).astype(bool)
            ends = np.append(starts[1:], len(ids))
            before = np.concatenate([[0], np.cumsum(there)])
            names = [ids[s] for s in starts]
            starts, ends = before[starts], before[ends]
            table = table.filter(pa.array(there))
            flags = table.column("flag").to_numpy().astype(np.int64)
            initials = table.column("initial").to_numpy().astype(np.int64)
            keys = table.column("key").to_pylist()
            faults = _first_faults(flags, keys, starts, ends)
            for some, whole in ((np.flatnonzero(~edge), True), (np.flatnonzero(edge), False)):
                if not len(some):
                    continue
                take = np.concatenate([np.arange(starts[i], ends[i]) for i in some])
                lengths = (ends - starts)[some]
                high = np.cumsum(lengths)
                low = high - lengths
                mine, own = table.take(pa.array(take)), faults[take]
                if whole:
                    search = Search(initials[take] + 4 * _KIND[own], low, high,
                                    accepting(costs, len(some)), costs, chunk_rows)
                    turns = _turns(mine, own, low, high, search, np.zeros(len(some), np.int64),
                                   np.ones(len(some), bool))
                    numbers, letters = [0] * len(some), [None] * len(some)
                    firsts = [None] * len(some)
                else:
                    turns = _turns(mine, own, low, high)
                    numbers = list(range(parts, parts + len(some)))
                    parts += len(some)
                    spans = list(zip(low.tolist(), high.tolist(), strict=True))
                    letters = [initials[take[a:b]].astype(np.uint8).tobytes() for a, b in spans]
                    firsts = [[{"place": i - a, "key": keys[take[i]]} for i in range(a, b)
                               if own[i] in (0, 3)] for a, b in spans]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[i] for i in some], table.schema.field("conv_id").type),
                     pa.array([number] * len(some), pa.int32()), pa.array(numbers, pa.int32()),
                     pa.array([whole] * len(some)), pa.array(letters, pa.binary()), turns,
                     pa.array(firsts, pa.list_(pa.struct([("place", pa.int32()),
                                                          ("key", pa.binary())])))],
                    schema.names)

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                held_bytes += batch.nbytes
                if held_bytes >= part_bytes:
                    yield from flush(last=False)
        if held:
            yield from flush(last=True)

    return rows.mapInArrow(apply, schema)


def _codes(row: dict) -> np.ndarray:
    """The numbers of a part's rows, with the duplicates of earlier parts."""
    faults = [t["fault"] for t in row["turns"]]
    kinds = np.array([0 if f is None else _MUST_GO if f != "truncated" else _TRUNCATED
                      for f in faults], np.int64)
    return np.frombuffer(row["initials"], np.uint8).astype(np.int64) + 4 * kinds


def _searched(row: dict, behind: np.ndarray, costs: Costs, chunk_rows: int) -> Search:
    codes, count = _codes(row), len(behind)
    many = np.tile(codes, count)
    starts = np.arange(count) * len(codes)
    return Search(many, starts, starts + len(codes), behind, costs, chunk_rows)


def _one_by_one(parts: DataFrame, schema: str, make) -> DataFrame:
    """``make(row)`` for every part, as rows of ``schema``, which begins with slice and part."""
    kind = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                found = (row["slice"], row["part"], *make(row))
                yield pa.RecordBatch.from_pylist([dict(zip(kind.names, found, strict=True))], arrow)

    return parts.mapInArrow(apply, kind)


def _joined_parts(parts: DataFrame, costs: Costs, chunk_rows: int) -> DataFrame:
    """Edit conversations that span tasks; the parts of each are numbered in ``place``."""
    where = ["slice", "part"]
    # a row equal to one of an earlier part is a duplicate; each part sends an equal row once
    keys = parts.select("conv_id", *where, F.explode("keys").alias("k"))
    earliest = F.min(F.struct(*where)).over(Window.partitionBy("conv_id", "k.key"))
    again = (keys.withColumn("_first", earliest).filter(F.col("_first") != F.struct(*where))
             .groupBy(*where).agg(F.collect_list("k.place").alias("again")))
    turns = F.transform("turns", lambda turn, i: F.when(
        F.array_contains(F.coalesce("again", F.array().cast("array<int>")), i.cast("int")),
        turn.withField("fault", F.lit("duplicate"))).otherwise(turn))
    parts = kept(parts.drop("keys").join(again, where, "left").withColumn("turns", turns)
                 .drop("again"), "repair-parts")

    def matrix(row):
        # least costs before the part for each of the four unit vectors behind it
        unit = np.where(np.eye(4, dtype=bool), 0, _NEVER)
        return [_searched(row, unit, costs, chunk_rows).before.ravel().tolist()]

    matrices = kept(_one_by_one(parts, "slice int, part int, matrix array<bigint>", matrix),
                    "repair-costs")
    named = parts.select("conv_id", *where)

    def ends(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(where)
        vector, out = accepting(costs)[0], []
        for found in reversed(group["matrix"].tolist()):
            out.append(vector.tolist())
            vector = (np.array(found, np.int64).reshape(4, 4) + vector[:, None]).min(0)
            vector -= vector.min()
        return pd.DataFrame({"slice": group["slice"], "part": group["part"],
                             "place": np.arange(len(group)), "count": len(group),
                             "behind": out[::-1]})

    known = named.join(matrices, where).groupBy("conv_id").applyInPandas(
        ends, "slice int, part int, place bigint, count bigint, behind array<bigint>")
    parts = kept(parts.join(known, where), "repair-parts")

    def moves(row):
        search = _searched(row, np.array([row["behind"]], np.int64), costs, chunk_rows)
        search.trace()
        return [[int(search.chained(np.array([s]))[1][0]) for s in range(4)]]

    moved = _one_by_one(parts, "slice int, part int, moves array<int>", moves)

    def entries(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        state, out = 0, []
        for found in group["moves"]:
            out.append(state)
            state = int(found[state])
        return pd.DataFrame({"slice": group["slice"], "part": group["part"], "entered": out})

    entered = parts.select("conv_id", "place", *where).join(moved, where).groupBy(
        "conv_id").applyInPandas(entries, "slice int, part int, entered int")
    ready = parts.join(entered, where).select(
        "conv_id", "place", "count", "behind", "entered", "initials", "turns")
    out = T.StructType([ready.schema["conv_id"],
                        *T.StructType.fromDDL("place bigint, count bigint").fields,
                        T.StructField("turns", T.ArrayType(_TURN))])

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = {f: i for i, f in enumerate(_FAULTS)}
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                row = one.to_pylist()[0]
                search = _searched(row, np.array([row["behind"]], np.int64), costs, chunk_rows)
                turns = one.column("turns").flatten()
                table = pa.table({f: turns.field(f) for f in ("turn", "role", "text")})
                size = len(row["turns"])
                lists = _turns(
                    table, np.array([names[t["fault"]] for t in row["turns"]], np.int64),
                    np.array([0]), np.array([size]), search, np.array([row["entered"]]),
                    np.array([row["place"] + 1 == row["count"]]))
                yield pa.RecordBatch.from_arrays(
                    [one.column("conv_id"), one.column("place"), one.column("count"), lists],
                    out.names)

    return ready.mapInArrow(edited, out)


def _flag(text: Column) -> Column:
    """1 for a blank text, 3 for one that does not end as a sentence does, else 0."""
    shown = F.rtrim(text, F.lit(WHITE))
    return (F.when(shown == "", 1).when(F.right(shown, F.lit(1)).isin(".", "!", "?"), 0)
            .otherwise(3).cast("tinyint"))


def repair(conversations: DataFrame, costs: Costs | None = None, present: str | None = None,
           part_bytes: int = PART_BYTES, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The turns of every conversation with their faults and edits.

    ``conversations`` has ``conv_id``, ``turn``, ``role`` and ``text``. Rows whose column
    ``present`` is not true only name their conversation. Returns ``conv_id``, ``turns`` (with turn,
    role, text, fault, edit, new_role), ``place`` and ``count``: a conversation is one row unless it is
    long, and then ``count`` rows, the parts of it, in the order of ``place``. Deleted turns have no
    new role; inserted turns have no turn and no role, and an empty text.
    """
    costs = costs or Costs()
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    shown = F.lit(True) if present is None else F.coalesce(F.col(present), F.lit(False))
    rows = conversations.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), role.alias("role"),
        text.alias("text"), shown.alias("present"),
        F.monotonically_increasing_id().alias("row"))
    first = F.left("role", F.lit(1))
    rows = rows.withColumns({
        "flag": _flag(F.col("text")),
        "initial": F.when(first == "s", _SYSTEM).when(first == "u", _USER)
        .when(first == "a", _ASSISTANT).otherwise(_OTHER).cast("tinyint"),
        "key": F.unhex(F.md5(F.concat_ws(":", F.length("role"), "role", "text")))})
    # equal rows are told apart by their number, so that very many of them span several tasks, too
    order = ["conv_id", "turn", "role", "text", "row"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("row")
    sliced = kept(_sliced(rows, costs, part_bytes, chunk_rows), "repair-slices")
    done = sliced.filter("whole").select(
        "conv_id", F.lit(0).cast("bigint").alias("place"), F.lit(1).cast("bigint").alias("count"),
        "turns")
    return done.unionByName(
        _joined_parts(sliced.filter("not whole"), costs, chunk_rows))


def _how_many(turns: Column, test: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(turns, test)).cast("bigint")


def _with(turns: Column, field: str, value: str) -> Column:
    return _how_many(turns, lambda t: t[field] == value)


def report(repaired: DataFrame, costs: Costs | None = None) -> DataFrame:
    """Faults, least cost and edits of each conversation, and the SHA-256 of what it becomes, its
    turns as ``role:text`` joined by line breaks. ``gaps`` are the turn numbers missing between the
    least and the largest, ``illegal`` the neighbours whose initials are not su, ua or au."""
    costs = costs or Costs()
    turns = F.col("turns")
    own = F.filter(turns, lambda t: t["edit"] != "I")
    letters = F.array_join(F.transform(own, lambda t: F.when(
        t["role"].substr(1, 1).isin("s", "u", "a"), t["role"].substr(1, 1)).otherwise("x")), "")
    numbers = F.transform(F.filter(own, lambda t: t["turn"].isNotNull()), lambda t: t["turn"])
    stays = F.transform(F.filter(turns, lambda t: t["new_role"].isNotNull()),
                        lambda t: F.concat(t["new_role"], F.lit(":"), t["text"]))
    lines = repaired.select(
        "conv_id", "place", "count",
        *[_with(turns, "fault", f).alias(f) for f in ("blank", "duplicate", "truncated")],
        *[_with(turns, "edit", e).alias(f"n_{e}") for e in "RDI"],
        _how_many(turns, lambda t: (t["fault"] == "truncated") & (t["edit"] != "D")).alias("left"),
        letters.alias("letters"), numbers.alias("numbers"),
        F.array_join(F.transform(turns, lambda t: t["edit"]), "").alias("audit"),
        F.when(F.size(stays) > 0, F.array_join(stays, "\n")).alias("text"))
    lines = lines.select(
        "conv_id", "place", "count", "blank", "duplicate", "truncated", "audit", "text",
        (F.col("n_R") * costs.rerole + F.col("n_D") * costs.delete + F.col("n_I") * costs.insert
         + F.col("left") * costs.truncated).alias("cost"),
        (F.greatest(F.length("letters") - 1, F.lit(0))
         - F.regexp_count("letters", F.lit("(?=su|ua|au)"))).cast("bigint").alias("illegal"),
        F.left("letters", F.lit(1)).alias("first"), F.right("letters", F.lit(1)).alias("last"),
        F.array_min("numbers").alias("low"), F.array_max("numbers").alias("high"),
        F.size(F.array_distinct("numbers")).cast("bigint").alias("distinct"))
    sums = ["blank", "duplicate", "truncated", "illegal", "cost"]

    def gaps(low: str, high: str, distinct: str) -> Column:
        span = F.col(high).cast("decimal(20,0)") - F.col(low) + 1 - F.col(distinct)
        return F.coalesce(span, F.lit(0)).cast("bigint").alias("gaps")

    single = lines.filter("count = 1").select(
        "conv_id", gaps("low", "high", "distinct"), *sums, "audit",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("repaired_sha256"))
    # parts: neighbours across a bound, where rows are by turn, so that a turn can be in both
    several = kept(lines.filter("count > 1"), "repair-report")
    order = Window.partitionBy("conv_id").orderBy("place")
    before = F.last(F.nullif("last", F.lit("")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, -1))
    highest = F.last("high", ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, -1))
    pair = F.concat(before, F.col("first"))
    bound = several.drop("text").withColumns({
        "illegal": F.col("illegal") + F.when(
            before.isNotNull() & (F.col("first") != "") & ~pair.isin("su", "ua", "au"), 1)
        .otherwise(0),
        "distinct": F.col("distinct") - F.when(highest == F.col("low"), 1).otherwise(0)})
    joined = bound.groupBy("conv_id").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("distinct").alias("distinct"),
        *[F.sum(c).alias(c) for c in sums],
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "audit"))),
                                 lambda p: p["audit"]), "").alias("audit"))
    joined = joined.select("conv_id", gaps("low", "high", "distinct"), *sums,
                           "audit")
    hashes = streamed_sha256(several.select("conv_id", "place", "text"), "\n")
    return single.unionByName(
        joined.join(hashes, joined["conv_id"].eqNullSafe(hashes["conv_id"]), "left")
        .select(joined["*"], F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))
