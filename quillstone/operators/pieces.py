"""Order-dependent folds over keys of any size.

Rows are dealt out by range of (key, order), so a key with most of all rows lies on many partitions, as pieces. A fold over a key's rows
then takes three passes: each piece is summed up as a function from the state before it to the state behind it; the states before the
pieces of a key are worked out from these sums, of which there are two a partition at most; and every partition is folded from the state it begins with, batch by
batch. No task holds more than the times and values of a partition, and the results are those of the plain fold.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any, Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstone.operators.skew import kept

State = Any
Summary = dict[str, Any]


class Fold(Protocol):
    """A fold over times (ascending) and values. States and summaries are made of numbers and lists; the state before the first row is None."""

    def summary(self, at: np.ndarray, value: np.ndarray) -> Summary: ...

    def carry(self, state: State, summary: Summary) -> State: ...

    def run(self, state: State, at: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, State]:
        """Per row whether it is taken, and the time of the last taken one, itself included; and the state behind."""


def _chased(successor: np.ndarray) -> np.ndarray:
    """Where each row's chain of successors ends; a successor beyond the last row ends it."""
    n = len(successor)
    to = np.where(successor < n, successor, np.arange(n))
    while True:
        further = to[to]
        if (further == to).all():
            return to
        to = further


def _runs(upto: np.ndarray, exits: list) -> list:
    """(last time, exit) of each run of equal exits."""
    out: list = []
    for t, e in zip(upto.tolist(), exits, strict=True):
        if out and out[-1][1] == e:
            out[-1][0] = t
        else:
            out.append([t, e])
    return out


def _first_run(runs: list, at: int) -> list | None:
    return next((exit_ for upto, exit_ in runs if upto >= at), None)


class MinGap:
    """The first row is taken, then each next that lies ``gap`` or more after the last taken. The state is the time of that."""

    def __init__(self, gap: int):
        self.gap = gap

    def summary(self, at: np.ndarray, value: np.ndarray) -> Summary:
        ends = at[_chased(np.searchsorted(at, at + self.gap))]
        # The row that is taken first lies less than a gap behind the piece's first, or is the one after those.
        some = int(np.searchsorted(at, at[0] + self.gap)) + 1
        return {"first": int(at[0]), "runs": _runs(at[:some], ends[:some].tolist())}

    def carry(self, state: State, summary: Summary) -> State:
        found = _first_run(summary["runs"], summary["first"] if state is None else state + self.gap)
        return state if found is None else found

    def run(self, state: State, at: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, State]:
        picked, before = [], state
        i = 0 if state is None else int(np.searchsorted(at, state + self.gap))
        while i < len(at):
            picked.append(i)
            state = int(at[i])
            i = int(np.searchsorted(at, state + self.gap))
        taken = np.zeros(len(at), bool)
        taken[picked] = True
        place = np.maximum.accumulate(np.where(taken, np.arange(len(at)), -1))
        return taken, np.where(place >= 0, at[place], before if before is not None else 0), state


class Scenes:
    """A row is a cut if the mean of the last ``history`` values since the cut before exceeds ``threshold``, and it lies ``least`` or more after that cut.

    The first row's time counts as that of a cut. A value that is missing makes the means it is in exceed nothing. The state is the last cut's time and the values since, up to history - 1.
    """

    def __init__(self, threshold: float, least: int, history: int = 5):
        self.threshold, self.least, self.history = threshold, least, history

    def _over(self, values: list[float]) -> bool:
        total = 0.0
        for v in values:
            total += v
        return total / len(values) > self.threshold

    def summary(self, at: np.ndarray, value: np.ndarray) -> Summary:
        n, h = len(at), self.history
        total = np.zeros(max(n - h + 1, 0))
        for k in range(h):
            total = total + value[k : k + len(total)]
        over = np.concatenate([np.zeros(min(h - 1, n), bool), total / h > self.threshold])  # by row, over whole histories within the piece
        following = np.full(n + h + 1, n)
        following[:n] = np.where(over, np.arange(n), n)
        following = np.minimum.accumulate(following[::-1])[::-1]
        successor = following[np.maximum(np.searchsorted(at, at + self.least), np.arange(n) + h).clip(max=n)]
        part = np.zeros(n)
        for d in range(1, min(h, n)):  # histories that a cut has just begun anew
            part[: n - d] += value[d:]
            short = np.flatnonzero((part[: n - d] / d > self.threshold) & (at[d:] - at[: n - d] >= self.least))
            successor[short] = np.minimum(successor[short], short + d)
        ends = _chased(successor).tolist()
        exit_ = lambda i: [int(at[ends[i]]), value[ends[i] + 1 :][-(h - 1) :].tolist()]
        some = np.flatnonzero(over)
        some = some[: int(np.searchsorted(at[some], at[0] + self.least)) + 1]
        head = min(h - 1, n)
        return {"at": at[:head].tolist(), "value": value[:head].tolist(), "exits": [exit_(i) for i in range(head)], "runs": _runs(at[some], [exit_(i) for i in some]), "tail": value[-(h - 1) :].tolist()}

    def carry(self, state: State, summary: Summary) -> State:
        last, past = (summary["at"][0], []) if state is None else state
        for i, at in enumerate(summary["at"]):
            if at - last >= self.least and self._over((past + summary["value"][: i + 1])[-self.history :]):
                return summary["exits"][i]
        found = _first_run(summary["runs"], last + self.least)
        return [last, (past + summary["tail"])[-(self.history - 1) :]] if found is None else found

    def run(self, state: State, at: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, State]:
        if not len(at):
            return np.zeros(0, bool), np.zeros(0, np.int64), state
        last, past = (int(at[0]), []) if state is None else state
        taken, lasts = np.zeros(len(at), bool), np.empty(len(at), np.int64)
        for i, (t, v) in enumerate(zip(at.tolist(), value.tolist(), strict=True)):
            past = past[-(self.history - 1) :] + [v]
            if t - last >= self.least and self._over(past):
                taken[i], last, past = True, t, []
            lasts[i] = last
        return taken, lasts, [last, past[-(self.history - 1) :]]


class Islands:
    """Rows are spans from their time to their value; one that begins at or after the end of all before it begins an island. The state is that end and the island's time."""

    def summary(self, at: np.ndarray, value: np.ndarray) -> Summary:
        end = np.maximum.accumulate(value)
        begins = np.concatenate([[True], at[1:] >= end[:-1]])
        return {"last": int(at[np.flatnonzero(begins)[-1]]), "end": float(end[-1])}

    def carry(self, state: State, summary: Summary) -> State:
        # If the last beginning in the piece is none behind what came before, no earlier one is.
        island = summary["last"] if state is None or summary["last"] >= state[0] else state[1]
        return [summary["end"] if state is None else max(state[0], summary["end"]), island]

    def run(self, state: State, at: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, State]:
        before, island = (-np.inf, -1) if state is None else state
        end = np.maximum.accumulate(np.concatenate([[before], value]))
        taken = at >= end[:-1]
        place = np.maximum.accumulate(np.where(taken, np.arange(len(at)), -1))
        last = np.where(place >= 0, at[place], island)
        return taken, last, [float(end[-1]), int(last[-1])] if len(at) else state


def _arrays(batch: pa.RecordBatch, at: str, value: str | None) -> tuple[np.ndarray, np.ndarray]:
    times = batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64)
    values = batch.column(value).cast(pa.float64()).to_numpy(zero_copy_only=False) if value else np.zeros(len(times))
    return times, values


def _stretches(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """The batches cut where the key changes, each with whether a key begins there."""
    before: tuple | None = None
    for batch in batches:
        keys = list(zip(*[batch.column(c).to_pylist() for c in by], strict=True))
        start = 0
        while start < len(keys):
            stop = start + 1
            while stop < len(keys) and keys[stop] == keys[start]:
                stop += 1
            yield keys[start] != before, batch.slice(start, stop - start)
            before, start = keys[start], stop


def fold_pieces(rows: DataFrame, by: list[str], at: str, order: list[str], fold: Fold, value: str | None = None, parts: int | None = None) -> DataFrame:
    """rows with ``taken`` and ``last``, as the fold over each key's rows in order of ``at``, then ``order``, gives them.

    ``at`` is a whole number, not null: rows without one are left out. Rows without a key are one more key. ``value`` is what the fold reads besides. ``parts`` is the number of
    partitions, if not the session's.
    """
    names, own = [*by, at, *order], rows.columns
    timed = rows.filter(F.col(at).isNotNull())
    dealt = timed.repartitionByRange(parts, *names) if parts else timed.repartitionByRange(*names)
    dealt = kept(dealt.sortWithinPartitions(*names).withColumn("__part", F.spark_partition_id()))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        first, key = True, None

        def made() -> pa.RecordBatch:
            text = json.dumps(fold.summary(*[np.concatenate(x) for x in zip(*held, strict=True)]))
            return pa.RecordBatch.from_arrays([*[key.column(c) for c in by], key.column("__part"), pa.array([text])], names=[*by, "__part", "__sum"])

        for begins, some in _stretches(batches, by):
            if begins and held:
                if first:  # only the first and the last key of a partition can go on in another
                    yield made()
                first, held = False, []
            held.append(_arrays(some, at, value))
            key = some.slice(0, 1)
        if held:
            yield made()

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    keyed = ", ".join(f"{c} {types[c]}" for c in by)
    columns = list(dict.fromkeys([*by, "__part", at, *([value] if value else [])]))
    found = dealt.select(*columns).mapInArrow(sums, f"{keyed}, __part int, __sum string")

    def states(pieces: pd.DataFrame) -> pd.DataFrame:
        state, out = None, []
        for part, text in sorted(zip(pieces["__part"], pieces["__sum"], strict=True)):
            if state is not None:
                out.append((part, json.dumps(state)))
            state = fold.carry(state, json.loads(text))
        return pd.DataFrame(out, columns=["__part", "__state"])

    # A row a partition at most.
    before = kept(found.groupBy(*by).applyInPandas(states, "__part int, __state string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, first = None, True
        for begins, some in _stretches(batches, by):
            if begins:
                given = some.column("__state")[0].as_py() if first else None
                state, first = None if given is None else json.loads(given), False
            taken, last, state = fold.run(state, *_arrays(some, at, value))
            yield pa.RecordBatch.from_arrays([*[some.column(c) for c in own], pa.array(taken), pa.array(last, pa.int64())], names=[*own, "taken", "last"])

    schema = ", ".join(f"`{c}` {types[c]}" for c in own) + ", taken boolean, last long"
    return dealt.join(F.broadcast(before), "__part", "left").select(*own, "__state").mapInArrow(run, schema)


def greedy_min_gap(rows: DataFrame, by: list[str], at: str, order: list[str], gap: int, most: int | None = None, parts: int | None = None) -> DataFrame:
    """The first row of each key and each next that lies ``gap`` or more after the last taken; the first ``most`` of them."""
    taken = fold_pieces(rows, by, at, order, MinGap(gap), parts=parts).filter("taken").select(*rows.columns)
    if most is None:
        return taken
    return taken.withColumn("__nth", F.row_number().over(Window.partitionBy(*by).orderBy(at, *order))).filter(F.col("__nth") <= most).drop("__nth")


def dedupe_keep_better(rows: DataFrame, by: list[str], at: str, order: list[str], score: str, window: int, parts: int | None = None) -> DataFrame:
    """Of each taken row (see ``greedy_min_gap``) and those up to the next, the row of the best score; the first of equals, scores that are missing last."""
    marked = fold_pieces(rows, by, at, order, MinGap(window), parts=parts)
    best = F.struct(-F.coalesce(F.col(score).cast("double"), F.lit(float("-inf"))), F.col(at), *[F.col(c) for c in order])
    return marked.groupBy(*by, "last").agg(F.min_by(F.struct(*rows.columns), best).alias("__row")).select("__row.*")


def scene_cuts(rows: DataFrame, by: list[str], at: str, order: list[str], value: str, threshold: float, least: int, history: int = 5, parts: int | None = None) -> DataFrame:
    """The rows at which a scene ends; see ``Scenes``."""
    return fold_pieces(rows, by, at, order, Scenes(threshold, least, history), value=value, parts=parts).filter("taken").select(*rows.columns)
