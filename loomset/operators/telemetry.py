"""Training telemetry over an event table keyed by run and step.

A run may hold any share of the table. Stateful operators therefore never see a whole run: events
are grouped by (run, chunk of steps), each chunk is reduced to a short summary, summaries give the state
at every chunk's start, and the chunks finish in parallel.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomset.functions.rounding import fixed, py_round
from loomset.session import join_lookup, materialize

# Steps per chunk. A step occurs once per run, so this bounds the rows of a chunk; a run of four
# billion steps has 65,536 chunks.
CHUNK_STEPS = 1 << 16
# Chunks whose maps are composed by one task.
FAN = 64
# Ranks up to this many rows are cut before the shuffle by WindowGroupLimit.
GROUP_LIMIT = 1_000

# Defaults of the two callbacks and the logged fields.
PATIENCE, MIN_DELTA, TOP_K = 3, 0.001, 3
TRAIN_METRICS = ("loss", "learning_rate", "grad_norm", "eval_loss")
EVAL_FIELDS = ("eval_loss", "eval_runtime", "eval_samples_per_second")


def chunked(events: DataFrame, chunk_steps: int) -> DataFrame:
    """Evaluations that have a loss, with their chunk."""
    return events.where("eval_loss IS NOT NULL").select(
        "run_id",
        F.floor(F.col("step") / chunk_steps).cast("long").alias("chunk"),
        F.col("step").cast("long").alias("step"),
        F.col("eval_loss").cast("double").alias("eval_loss"),
    )


def _nan_as_worst(rows: DataFrame) -> DataFrame:
    """For ranking, a NaN loss counts as infinite."""
    loss = F.when(F.isnan("eval_loss"), F.lit(float("inf"))).otherwise(F.col("eval_loss"))
    return rows.withColumn("eval_loss", loss)


# --------------------------------------------------------------------------- early stopping


def improve(losses: np.ndarray, best: float | None, min_delta: float) -> np.ndarray:
    """Positions that improve on ``best`` by more than ``min_delta``, in order.

    Without a ``best`` the first loss improves. After that only a strict prefix minimum can. Those
    fall steadily, so the next improvement is found by bisection and the loop runs once per
    improvement. A NaN never improves on anything, and nothing improves on a NaN.
    """
    if len(losses) == 0:
        return np.empty(0, dtype=np.int64)
    hits = []
    if best is None:
        best = losses[0]
        hits.append(0)
    known = np.where(np.isnan(losses), np.inf, losses)
    before = np.concatenate(([np.inf], np.minimum.accumulate(known)[:-1]))
    places = np.flatnonzero(known < before)
    falling = -losses[places]
    at = 0
    while at < len(places):
        at += int(np.searchsorted(falling[at:], -(best - min_delta), side="right"))
        if at < len(places):
            best = losses[places[at]]
            hits.append(places[at])
            at += 1
    return np.asarray(hits, dtype=np.int64)


def stopping_states(
    losses: np.ndarray, best: float | None, wait: int, patience: int, min_delta: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best loss, evaluations without improvement, and whether to stop, after each evaluation."""
    hits = improve(losses, best, min_delta)
    at = np.arange(len(losses))
    last = np.searchsorted(hits, at, side="right") - 1
    carried = last < 0
    origin = hits[last] if len(hits) else last
    waits = np.where(carried, wait + at + 1, at - origin)
    held = np.nan if best is None else best
    bests = np.where(carried, held, losses[origin]) if len(losses) else losses
    return bests, waits, waits >= patience


def _segments(pdf: pd.DataFrame) -> Iterator[tuple[int, int]]:
    """Row ranges of equal (run, chunk) in a batch that is sorted by them."""
    if len(pdf) == 0:
        return
    runs, chunks = pdf["run_id"].to_numpy(), pdf["chunk"].to_numpy()
    # A run without an id is a NaN, which differs from itself.
    other = (runs[1:] != runs[:-1]) & ((runs[1:] == runs[1:]) | (runs[:-1] == runs[:-1]))
    cuts = np.flatnonzero(other | (chunks[1:] != chunks[:-1])) + 1
    edges = [0, *cuts.tolist(), len(pdf)]
    yield from zip(edges[:-1], edges[1:])


def chunk_map(
    losses: np.ndarray, places: np.ndarray, n: int, low: float, min_delta: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What a chunk makes of the state that enters it: ``(above, best, wait)``.

    ``losses`` are the chunk's strict prefix minima below ``low``, the smallest loss before the chunk. With
    the entering threshold T = best - min_delta, the first piece whose ``above`` is below T tells the
    leaving state; if none is, the best loss stays and the chunk's rows are added to the wait. T lies
    between low - min_delta and low, so minima behind the first one below that range never come first. Each
    minimum's chain of improvements ends somewhere in the chunk; neighbours with the same end are one piece.
    """
    if len(losses) == 0:
        return losses, losses, places
    following = np.searchsorted(-losses, -(losses - min_delta), side="right")
    end = np.where(following < len(losses), following, np.arange(len(losses)))
    while (end[end] != end).any():
        end = end[end]
    first = end[: int((losses >= low - min_delta).sum()) + 1]
    kept = np.append(np.flatnonzero(first[1:] != first[:-1]), len(first) - 1)
    return losses[kept], losses[first[kept]], n - 1 - places[first[kept]]


def compose(f: tuple, g: tuple, min_delta: float) -> tuple:
    """The map of two neighbouring stretches; a map is ``(above, best, wait, n)``."""
    (above, best, wait, n), (above2, best2, wait2, n2) = f, g
    hit = np.searchsorted(-above2, -(best - min_delta), side="right")  # NaN finds nothing
    moved = hit < len(above2)
    hit = np.minimum(hit, max(len(above2) - 1, 0))
    if len(above2):
        best, wait = np.where(moved, best2[hit], best), np.where(moved, wait2[hit], wait + n2)
    else:
        wait = wait + n2
    above, best, wait = (np.concatenate(x) for x in ((above, above2), (best, best2), (wait, wait2)))
    same = (best[1:] == best[:-1]) & (wait[1:] == wait[:-1])
    kept = np.append(np.flatnonzero(~same), len(above) - 1) if len(above) else np.empty(0, np.int64)
    return above[kept], best[kept], wait[kept], n + n2


_MAP = "above double, best_out double, wait_out bigint, n bigint, low double, first boolean"


def _map_rows(keys: tuple, pieces: tuple, n: int, low: float, first: bool) -> list[np.ndarray]:
    """A map as columns; one without pieces is a row without ``above``."""
    above, best, wait = pieces if len(pieces[0]) else ([np.nan], [np.nan], [0])
    size = len(above)
    constant = [np.full(size, x) for x in (n, low, first)]
    return [*[np.full(size, k) for k in keys], np.asarray(above), np.asarray(best), np.asarray(wait, np.int64), *constant]


def _frame(rows: list[list[np.ndarray]], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame({c: np.concatenate(x) for c, x in zip(names, zip(*rows))})


def _chunk_maps(min_delta: float):
    """The map of every chunk; a chunk begins with the row that carries the smallest loss before it.

    The first chunk of a run has no entering state. Its map is one piece that always applies.
    """
    names = ["run_id", "chunk", "above", "best_out", "wait_out", "n", "low", "first"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, low, lowest, first, n, best, at, losses, places = None, np.inf, np.inf, False, 0, None, 0, [], []

        def closed() -> list[np.ndarray]:
            if first:
                pieces = [np.inf * -1], [best], [n - 1 - at]
            else:
                pieces = chunk_map(np.concatenate([np.empty(0), *losses]), np.concatenate([np.empty(0, np.int64), *places]), n, low, min_delta)
            return _map_rows(here, pieces, n, low, first)

        for pdf in batches:
            rows = []
            runs, chunks, values, lows, firsts = (pdf[c].to_numpy() for c in ("run_id", "chunk", "eval_loss", "low", "first"))
            for start, end in _segments(pdf):
                if (runs[start], chunks[start]) != here:
                    if here is not None:
                        rows.append(closed())
                    here, n, best, at, losses, places = (runs[start], chunks[start]), 0, None, 0, [], []
                    low, first = lows[start], bool(firsts[start])
                    low = lowest = np.inf if np.isnan(low) else float(low)
                    start += 1
                part = values[start:end].astype(float)
                if first:
                    hits = improve(part, best, min_delta)
                    if len(hits):
                        best, at = float(part[hits[-1]]), n + int(hits[-1])
                elif len(part):
                    known = np.where(np.isnan(part), np.inf, part)
                    before = np.minimum.accumulate(np.concatenate(([lowest], known)))
                    found = np.flatnonzero(known < before[:-1])
                    losses.append(known[found])
                    places.append(n + found)
                    lowest = before[-1]
                n += len(part)
            if rows:
                yield _frame(rows, names)
        if here is not None:
            yield _frame([closed()], names)

    return run


def _tables(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[tuple, dict[str, np.ndarray]]]:
    """Key and columns of every stretch of rows with equal keys, across batches."""
    key, held = None, []

    def joined() -> dict[str, np.ndarray]:
        return held[0] if len(held) == 1 else {c: np.concatenate([h[c] for h in held]) for c in held[0]}

    for pdf in batches:
        if len(pdf) == 0:
            continue
        columns = {c: pdf[c].to_numpy() for c in pdf.columns}
        changed = np.zeros(len(pdf) - 1, bool)
        for k in keys:
            changed |= columns[k][1:] != columns[k][:-1]
        edges = [0, *(np.flatnonzero(changed) + 1).tolist(), len(pdf)]
        for start, end in zip(edges[:-1], edges[1:]):
            here = tuple(columns[k][start] for k in keys)
            if here != key:
                if held:
                    yield key, joined()
                key, held = here, []
            held.append({c: v[start:end] for c, v in columns.items()})
    if held:
        yield key, joined()


def _pieces(t: dict[str, np.ndarray]) -> tuple:
    some = ~np.isnan(t["above"])
    return t["above"][some], t["best_out"][some], t["wait_out"][some], int(t["n"][0])


def _compose_groups(min_delta: float):
    """One map per group of chunks, from the maps of its chunks in order."""
    names = ["run_id", "grp", "above", "best_out", "wait_out", "n", "low", "first"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, whole, low, first, rows, waiting = None, None, np.inf, False, [], 0
        for (run_id, grp, _), t in _tables(batches, ["run_id", "grp", "chunk"]):
            if (run_id, grp) != here:
                if here is not None:
                    rows.append(_map_rows(here, whole[:3], whole[3], low, first))
                    waiting += len(whole[0])
                here, whole, low, first = (run_id, grp), _pieces(t), float(t["low"][0]), bool(t["first"][0])
            else:
                whole = compose(whole, _pieces(t), min_delta)
                used = 1 if first else int((whole[0] >= low - min_delta).sum()) + 1
                whole = (*[x[:used] for x in whole[:3]], whole[3])
            if waiting >= 1 << 16:
                yield _frame(rows, names)
                rows, waiting = [], 0
        if here is not None:
            yield _frame([*rows, _map_rows(here, whole[:3], whole[3], low, first)], names)

    return run


def _walk(min_delta: float, outer: list[str], inner: str):
    """The state that enters every stretch, from maps in order; an ``is_map`` of 0 marks a row with the outer one's start."""
    names = [*dict.fromkeys(["run_id", inner]), "best_in", "wait_in", "started"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, best, wait, started, rows = None, np.nan, 0, False, []
        for key, t in _tables(batches, [*outer, "is_map", inner]):
            if key[: len(outer)] != at:
                at, best, wait, started = key[: len(outer)], np.nan, 0, False
            if key[-2] == 0:
                best, wait, started = float(t["best_out"][0]), int(t["wait_out"][0]), bool(t["first"][0])
                continue
            rows.append((key[0], key[-1], best, wait, started))
            above, bests, waits, n = _pieces(t)
            hit = np.flatnonzero(above < best - min_delta)[:1] if started else np.zeros(1, np.int64)
            started = True
            best, wait = (float(bests[hit[0]]), int(waits[hit[0]])) if len(hit) else (best, wait + n)
            if len(rows) >= 1 << 16:
                yield pd.DataFrame(rows, columns=names)
                rows = []
        if rows:
            yield pd.DataFrame(rows, columns=names)

    return run


def _in_order(maps: DataFrame, starts: DataFrame, outer: list[str], inner: str) -> DataFrame:
    """Maps of each outer stretch in one place and in order, after a row with its start state."""
    heads = starts.select(
        *outer,
        F.lit(0).alias("is_map"),
        F.col("best_in").alias("best_out"),
        F.col("wait_in").alias("wait_out"),
        F.col("started").alias("first"),
        F.lit(0).cast("long").alias(inner),
        F.lit(0).cast("long").alias("n"),
    )
    together = maps.withColumn("is_map", F.lit(1)).unionByName(heads, allowMissingColumns=True)
    return together.repartition(*outer).sortWithinPartitions(*outer, "is_map", inner, F.col("above").desc_nulls_last())


def _finish_chunks(patience: int, min_delta: float):
    """Per-row states; each chunk begins with the row that carries its start state."""

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best, wait = None, 0
        for pdf in batches:
            marker = pdf["step"].isna().to_numpy()
            losses = pdf["eval_loss"].to_numpy(dtype=float, na_value=np.nan)
            best_in = pdf["best_in"].to_numpy(dtype=float, na_value=np.nan)
            wait_in = pdf["wait_in"].to_numpy(dtype=float, na_value=0)
            started = pdf["started"].to_numpy(dtype=object)
            parts = []
            for start, end in _segments(pdf):
                if marker[start]:
                    best = float(best_in[start]) if started[start] else None
                    wait = int(wait_in[start])
                    start += 1
                if start < end:
                    states = stopping_states(losses[start:end], best, wait, patience, min_delta)
                    best, wait = float(states[0][-1]), int(states[1][-1])
                    parts.append(states)
            if parts:
                bests, waits, stops = (np.concatenate(column) for column in zip(*parts))
                out = pdf.loc[~marker, ["run_id", "step", "eval_loss"]].astype({"step": "int64"})
                yield out.assign(best_loss=bests, wait_count=waits, should_stop=stops)

    return finish


def _with_carry(rows: DataFrame, carried: DataFrame) -> DataFrame:
    """Rows in step order, each chunk in one place and headed by a row with its start state.

    The heading row has no step, so it sorts first. A union costs one shuffle where a join would
    need another one to bring the chunks back together.
    """
    together = rows.unionByName(carried, allowMissingColumns=True)
    return together.repartition("run_id", "chunk").sortWithinPartitions(
        "run_id", "chunk", F.col("step").asc_nulls_first()
    )


def _long_runs(rows: DataFrame, chunk_steps: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows with their chunk, and the smallest loss of the chunks of long runs, if there are any.

    A run of up to ``chunk_steps`` evaluations is one chunk, wherever its steps lie. In longer ones neighbouring
    stretches of ``chunk_steps`` steps make up a chunk until they hold as many evaluations.
    """
    sizes = rows.groupBy("run_id").agg(F.count("*").alias("n")).where(F.col("n") > chunk_steps)
    long = materialize(sizes.select("run_id", F.lit(True).alias("long")), "long_runs")
    if long.isEmpty():
        return rows.withColumn("chunk", F.lit(0).cast("long")), None
    marked = join_lookup(rows, long, ["run_id"])
    cells = marked.where("long").groupBy("run_id", "chunk").agg(F.count("*").alias("n"), F.min("eval_loss").alias("low"))
    # One row per stretch of steps reaches this window, 65,536 of a run of four billion steps.
    before = Window.partitionBy("run_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    held = F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / chunk_steps).cast("long")
    cells = materialize(cells.select("run_id", "chunk", held.alias("held"), "low"), "chunks")
    placed = join_lookup(marked, cells.select("run_id", "chunk", "held"), ["run_id", "chunk"])
    rows = placed.select("run_id", F.coalesce("held", F.lit(0)).cast("long").alias("chunk"), "step", "eval_loss", "long")
    return rows, cells.groupBy("run_id", F.col("held").alias("chunk")).agg(F.min("low").alias("low"))


def _chunk_heads(per_chunk: DataFrame, start: DataFrame) -> DataFrame:
    """(run_id, chunk, low, first): the smallest loss before each chunk, and whether nothing comes before it."""
    # One row per chunk reaches this window, 65,536 of a run of four billion steps.
    before = Window.partitionBy("run_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    known = F.when(~F.isnan("low"), F.col("low"))
    marked = per_chunk.select("run_id", "chunk", F.min(known).over(before).alias("low"), (F.count("*").over(before) == 0).alias("first"))
    entering = F.when(~F.isnan("best_in"), F.col("best_in"))
    return marked.join(start, "run_id", "left").select(
        "run_id", "chunk", F.least("low", entering).alias("low"), (F.col("first") & F.col("started").isNull()).alias("first")
    )


def early_stopping_states(
    events: DataFrame,
    patience: int = PATIENCE,
    min_delta: float = MIN_DELTA,
    chunk_steps: int = CHUNK_STEPS,
    start: DataFrame | None = None,
) -> DataFrame:
    """State after every evaluation: ``(run_id, step, eval_loss, best_loss, wait_count, should_stop)``.

    ``start`` ``(run_id, best_loss, wait_count)`` has the states that earlier evaluations left, one row per
    run. A run that begins with a NaN has a null best loss, here and there.

    A run of up to ``chunk_steps`` evaluations is walked in one go. In longer runs the state machine is
    evaluated as maps. A chunk becomes a piecewise constant map from the entering best
    loss to the leaving state, maps of neighbouring chunks are composed into one per group of ``FAN``, and
    groups are walked to get their start states; then chunks of a group, then the rows of a chunk. Steady
    falls faster than ``min_delta`` a step leave one piece per chunk; slower ones at most the prefix minima
    within ``min_delta`` of the entering loss.
    """
    kind = events.schema["run_id"].dataType.simpleString()
    rows, per_chunk = _long_runs(chunked(events, chunk_steps), chunk_steps)
    if start is None:
        entered = events.sparkSession.createDataFrame([], f"run_id {kind}, best_in double, wait_in bigint, started boolean")
    else:
        entered = start.select(
            F.col("run_id").cast(kind).alias("run_id"),
            F.coalesce(F.col("best_loss").cast("double"), F.lit(float("nan"))).alias("best_in"),
            F.col("wait_count").cast("long").alias("wait_in"),
            F.lit(True).alias("started"),
        )
    runs = rows.select("run_id").distinct().join(entered, "run_id", "left")
    carried = runs.withColumns({"chunk": F.lit(0).cast("long"), "started": F.coalesce("started", F.lit(False))})
    if per_chunk is not None:
        short = carried.join(per_chunk.select("run_id").distinct(), "run_id", "left_anti")
        carried = short.unionByName(_entering(rows.where("long").drop("long"), per_chunk, entered, min_delta, kind))
        rows = rows.drop("long")
    return _with_carry(rows, carried).mapInPandas(
        _finish_chunks(patience, min_delta),
        f"run_id {kind}, step bigint, eval_loss double, best_loss double, wait_count bigint, should_stop boolean",
    )


def _entering(rows: DataFrame, per_chunk: DataFrame, entered: DataFrame, min_delta: float, kind: str) -> DataFrame:
    """(run_id, chunk, best_in, wait_in, started): the state that enters every chunk of long runs."""
    entered = entered.join(per_chunk.select("run_id").distinct(), "run_id", "left_semi")
    maps = _with_carry(rows, _chunk_heads(per_chunk, entered)).mapInPandas(_chunk_maps(min_delta), f"run_id {kind}, chunk bigint, {_MAP}")
    maps = maps.withColumn("grp", F.floor(F.col("chunk") / FAN))
    grouped = maps.repartition("run_id", "grp").sortWithinPartitions("run_id", "grp", "chunk", F.col("above").desc_nulls_last())
    composed = grouped.mapInPandas(_compose_groups(min_delta), f"run_id {kind}, grp bigint, {_MAP}")
    into_groups = _in_order(composed, entered, ["run_id"], "grp").mapInPandas(
        _walk(min_delta, ["run_id"], "grp"), f"run_id {kind}, grp bigint, best_in double, wait_in bigint, started boolean"
    )
    return _in_order(maps, into_groups, ["run_id", "grp"], "chunk").mapInPandas(
        _walk(min_delta, ["run_id", "grp"], "chunk"), f"run_id {kind}, chunk bigint, best_in double, wait_in bigint, started boolean"
    )


def early_stopping(
    events: DataFrame, patience: int = PATIENCE, min_delta: float = MIN_DELTA, chunk_steps: int = CHUNK_STEPS
) -> DataFrame:
    """Per run: evaluations, final best loss and wait, and the first step that asked to stop."""
    states = early_stopping_states(events, patience, min_delta, chunk_steps)
    return states.groupBy("run_id").agg(
        F.count("*").alias("num_evals"),
        F.max_by("best_loss", "step").alias("best_loss"),
        F.max_by("wait_count", "step").alias("wait_count"),
        F.min(F.when(F.col("should_stop"), F.col("step"))).alias("stop_step"),
    )


# --------------------------------------------------------------------------- checkpoints


def _top_per_run(rows: DataFrame, k: int) -> DataFrame:
    order = ("eval_loss", "step")
    if k > GROUP_LIMIT:
        # Too many to be cut before the shuffle: rank chunks first, so no task gets a whole run.
        inner = Window.partitionBy("run_id", "chunk").orderBy(*order)
        rows = rows.withColumn("_r", F.row_number().over(inner)).where(F.col("_r") <= k).drop("_r")
    w = Window.partitionBy("run_id").orderBy(*order)
    ranked = rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.withColumn("rank", F.col("rank").cast("bigint"))


def checkpoint_path(save_dir: str, step: Column) -> Column:
    return F.concat(F.lit(f"{save_dir.rstrip('/')}/checkpoint-step-"), step.cast("string"))


def top_checkpoints(events: DataFrame, top_k: int = TOP_K, save_dir: str = "checkpoints/best") -> DataFrame:
    """The ``top_k`` evaluations of each run by loss; the earlier wins a tie."""
    kept = _top_per_run(_nan_as_worst(chunked(events, CHUNK_STEPS)), top_k)
    return kept.select("run_id", "rank", "step", "eval_loss", checkpoint_path(save_dir, F.col("step")).alias("path"))


def best_checkpoint(events: DataFrame, save_dir: str = "checkpoints/best") -> DataFrame:
    """Path of the best evaluation of each run. One combined aggregate."""
    order = F.struct("eval_loss", "step")
    best = events.where("eval_loss IS NOT NULL").groupBy("run_id").agg(F.min(order).alias("b"))
    return best.select("run_id", checkpoint_path(save_dir, F.col("b.step")).alias("path"), "b.eval_loss", "b.step")


def _chunk_smallest(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` smallest losses of each chunk."""
    w = Window.partitionBy("run_id", "chunk").orderBy("eval_loss")
    few = rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)
    return few.groupBy("run_id", "chunk").agg(F.collect_list("eval_loss").alias("losses"))


def _walk_smallest(k: int):
    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run, kept = None, []
        for pdf in batches:
            kept_in = []
            for row in pdf.itertuples(index=False):
                if row.run_id != run:
                    run, kept = row.run_id, []
                kept_in.append(kept)
                kept = heapq.nsmallest(k, [*kept, *row.losses])
            yield pdf[["run_id", "chunk"]].assign(kept_in=kept_in)

    return walk


def admitted(losses: np.ndarray, kept: list[float], k: int) -> tuple[np.ndarray, list[float]]:
    """Whether each loss enters the ``k`` smallest so far, and those after the last.

    ``kept`` are the smallest losses before. Only a loss below the largest of them enters, so the loop jumps
    from one such loss to the next, in growing strides.
    """
    worst_first = [-x for x in kept]
    heapq.heapify(worst_first)
    enters, at, n = np.zeros(len(losses), bool), 0, len(losses)
    while at < n and len(worst_first) < k:
        heapq.heappush(worst_first, -losses[at])
        enters[at] = True
        at += 1
    stride = 16
    while at < n:
        below = losses[at : at + stride] < -worst_first[0]
        first = int(below.argmax())
        if not below[first]:
            at += stride
            stride *= 2
            continue
        at += first
        heapq.heapreplace(worst_first, -losses[at])
        enters[at] = True
        at, stride = at + 1, 16
    return enters, [-x for x in worst_first]


def _admit(k: int):
    """Admission per row; each chunk begins with the row that carries the losses kept so far."""

    def admit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[float] = []
        for pdf in batches:
            marker, kept_in = pdf["step"].isna().to_numpy(), pdf["kept_in"].to_numpy()
            losses = pdf["eval_loss"].to_numpy(dtype=float, na_value=np.nan)
            parts = []
            for start, end in _segments(pdf):
                if marker[start]:
                    kept = list(kept_in[start])
                    start += 1
                enters, kept = admitted(losses[start:end], kept, k)
                parts.append(enters)
            if parts:
                out = pdf.loc[~marker, ["run_id", "step", "eval_loss"]].astype({"step": "int64"})
                yield out.assign(admitted=np.concatenate(parts))

    return admit


def checkpoint_history(events: DataFrame, top_k: int = TOP_K, chunk_steps: int = CHUNK_STEPS) -> DataFrame:
    """Per evaluation: was it saved when it arrived, and was it evicted later?

    Chunks hand on their ``top_k`` smallest losses, nothing else.
    """
    run_type = events.schema["run_id"].dataType.simpleString()
    rows = _nan_as_worst(chunked(events, chunk_steps))
    ordered = _chunk_smallest(rows, top_k).repartition("run_id").sortWithinPartitions("run_id", "chunk")
    carried = ordered.mapInPandas(_walk_smallest(top_k), f"run_id {run_type}, chunk bigint, kept_in array<double>")
    admitted = _with_carry(rows, carried).mapInPandas(
        _admit(top_k), f"run_id {run_type}, step bigint, eval_loss double, admitted boolean"
    )
    # (run, step) is unique, so this join has no hot key.
    final = _top_per_run(rows, top_k).select("run_id", "step", F.lit(True).alias("_kept"))
    joined = admitted.join(final, ["run_id", "step"], "left")
    return joined.withColumn("evicted", F.col("admitted") & F.col("_kept").isNull()).drop("_kept")


# --------------------------------------------------------------------------- logging


def run_bounds(events: DataFrame) -> DataFrame:
    """Start time and last step of each run."""
    return events.groupBy("run_id").agg(F.min("ts").alias("start_ts"), F.max("step").alias("total_steps"))


def _seconds(later: Column, earlier: Column) -> Column:
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return micros / F.lit(1_000_000)


def progress_projection(joined: DataFrame, every: int) -> DataFrame:
    """Progress rows of events that already carry ``start_ts`` and ``total_steps``. Stateless."""
    step, total = F.col("step"), F.col("total_steps")
    elapsed = _seconds(F.col("ts"), F.col("start_ts"))
    eta = F.when((step > 0) & (total > 0), elapsed / step * (total - step)).when(total.isNotNull(), F.lit(0.0))
    optional = {
        "epoch": lambda c: py_round(c, 2).alias("epoch"),
        "loss": lambda c: py_round(c, 4).alias("loss"),
        "learning_rate": lambda c: c.alias("lr"),
        "grad_norm": lambda c: py_round(c, 4).alias("grad_norm"),
    }
    return joined.where((step % every == 0) | (step == total)).select(
        "run_id",
        "step",
        "total_steps",
        py_round(elapsed, 1).alias("elapsed_s"),
        py_round(eta, 1).alias("eta_s"),
        *[make(F.col(name)) for name, make in optional.items() if name in joined.columns],
    )


def progress_rows(events: DataFrame, every: int, runs: DataFrame | None = None) -> DataFrame:
    """Every ``every``-th step and the last one, with elapsed time and time to go.

    ``runs`` ``(run_id, start_ts, total_steps)`` defaults to the bounds found in the events.
    """
    if every <= 0:
        raise ValueError("every must be positive")
    return progress_projection(join_lookup(events, run_bounds(events) if runs is None else runs, ["run_id"]), every)


def metric_rows(events: DataFrame, keys: tuple[str, ...] = ("run_id", "step")) -> DataFrame:
    """Logged values as long rows ``train/<name>``; absent ones are left out."""
    present = [m for m in TRAIN_METRICS if m in events.columns]
    named = events.select(*keys, *[F.col(m).cast("double").alias(f"train/{m}") for m in present])
    return named.unpivot(list(keys), [f"train/{m}" for m in present], "metric", "value").where("value IS NOT NULL")


def eval_rows(events: DataFrame) -> DataFrame:
    """Evaluation events with the reported fields that the table has."""
    fields = [f for f in EVAL_FIELDS if f in events.columns]
    return events.where(F.coalesce(*fields).isNotNull()).select("run_id", "step", *fields)


def run_summary(events: DataFrame, save_dir: str = "checkpoints/best") -> DataFrame:
    """Final losses, last step, total time and samples per second of each run. One aggregate."""
    columns = events.columns

    def last(name: str) -> Column:
        value = F.col(name) if name in columns else F.lit(None).cast("double")
        return F.max_by(value, F.when(value.isNotNull(), F.col("step"))).alias(name)

    samples = F.sum("num_samples") if "num_samples" in columns else F.lit(None).cast("bigint")
    summary = events.groupBy("run_id").agg(
        last("loss"),
        last("eval_loss"),
        F.max("step").alias("total_steps"),
        F.min("ts").alias("_from"),
        F.max("ts").alias("_to"),
        samples.alias("_samples"),
    )
    seconds = _seconds(F.col("_to"), F.col("_from"))
    return summary.select(
        "run_id",
        F.col("loss").alias("train_loss"),
        "eval_loss",
        "total_steps",
        py_round(seconds, 1).alias("total_time_s"),
        F.when(seconds > 0, F.col("_samples") / seconds).alias("samples_per_second"),
        checkpoint_path(save_dir, F.col("total_steps")).alias("checkpoint_path"),
    )


def run_reports(summary: DataFrame) -> DataFrame:
    """One report text per run."""

    def line(label: str, digits: int, name: str) -> Column:
        return F.when(F.col(name).isNotNull(), F.concat(F.lit(f"  {label}: "), fixed(F.col(name), digits)))

    lines = F.array(
        F.lit("Training Results:"),
        F.concat(F.lit("  Training time: "), fixed(F.col("total_time_s"), 1), F.lit("s")),
        F.concat(F.lit("  Checkpoint: "), F.col("checkpoint_path")),
        line("Train loss", 4, "train_loss"),
        line("Eval loss", 4, "eval_loss"),
        line("Samples/sec", 1, "samples_per_second"),
    )
    return summary.select("run_id", F.array_join(lines, "\n").alias("summary"))
