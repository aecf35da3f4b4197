"""Order-dependent folds over keys of any length.

A fold's verdict on a row depends on all rows before it, through a small state.  Keys are cut into parts of
time.  First every part is folded as if it stood alone; then each part whose true entering state, the leaving
state of the part before, differs from the one it was folded with is folded again, and so on until nothing
changes.  Rounds work on blocks of neighbouring parts, each GROWTH times as long as the round before: a block hands its
state on from part to part and passes over parts whose entering state is known already.  A fold that forgets where it
began after some parts is settled in the round whose blocks are as long as that, or the one after, however many parts there are; one that
never forgets takes logarithmically many rounds, the last of which is the plain fold.  Tasks read blocks as
streams of sorted rows and hold a part at a time.  The verdicts are those of the plain fold, bit by
bit.  Keys that are short, which is counted first, are one part and folded once.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..store import checkpointed
from .running import PART, in_parts

#: (columns in order, entering state) -> (verdict of each row, leaving state); a state is what JSON can hold.
Fold = Callable[[list[list], object], tuple[list, object]]


#: How much longer the blocks of a round are than those of the round before.
GROWTH = 16


def _sorted(t: pa.Table, order: Sequence[str]) -> pa.Table:
    return t.take(pc.sort_indices(t, sort_keys=[(c, "ascending") for c in order]))


def fold(df: DataFrame, run: Fold, *, inputs: Sequence[str], keys: Sequence[str], order: Sequence[str], column: str, kind: str, rows: int = PART) -> DataFrame:
    """``df`` with ``column``, what ``run`` says of each row of its key in ``order``, whose first column is a whole number."""
    if not keys:
        return fold(df.withColumn("_all", F.lit(0)), run, inputs=inputs, keys=["_all"], order=order, column=column, kind=kind, rows=rows).drop("_all")
    kinds = dict(df.dtypes)
    schema = ", ".join(f"`{n}` {t}" for n, t in df.dtypes) + f", `{column}` {kind}"

    def judge(t: pa.Table, entering: str | None) -> tuple[list, object]:
        return run([t[c].to_pylist() for c in inputs], None if entering is None else json.loads(entering))

    def verdicts(t: pa.Table) -> pa.Table:
        t = _sorted(t, order)
        said, _ = judge(t, t["_entering"][0].as_py())
        return t.drop_columns(["_part", "_entering"]).append_column(column, pa.array(said))

    cut = in_parts(df, keys=keys, order=order[0], part="_part", rows=rows)
    if df.groupBy(*keys).count().where(F.col("count") > rows).isEmpty():
        return df.withColumns({"_part": F.lit(0), "_entering": F.lit(None).cast("string")}).groupBy(*keys).applyInArrow(verdicts, schema)

    names = list(dict.fromkeys([*keys, *order, *inputs]))
    light = cut.select(*names, "_part").repartition(*keys, "_part").persist()
    state = ", ".join([*[f"`{k}` {kinds[k]}" for k in keys], "_part long, _entering string, _leaving string"])

    def leave(t: pa.Table) -> pa.Table:
        t = _sorted(t, order)
        entering = t["_entering"][0].as_py()
        leaving = json.dumps(judge(t, entering)[1])
        one = t.slice(0, 1).select([*keys, "_part"])
        return one.append_column("_entering", pa.array([entering], pa.string())).append_column("_leaving", pa.array([leaving]))

    def hand_on(batches):
        """(part, entering, leaving) of the parts of each block that change, from rows sorted by key, part and order."""
        at, state = None, None  # the block, and what its last part left
        for t in _groups(batches, part):
            block = tuple(t[c][0].as_py() for c in (*keys, "_block"))
            first = block != at
            at = block
            entering, leaving, wanted = (t[c][0].as_py() for c in ("_entering", "_leaving", "_wanted"))
            true = wanted if first else state
            if true == entering:
                state = leaving
                continue
            state = json.dumps(judge(t, true)[1])
            one = t.slice(0, 1).select(part).append_column("_entering", pa.array([true], pa.string())).append_column("_leaving", pa.array([state]))
            yield from one.to_batches()

    part = [*keys, "_part"]
    known = checkpointed(light.withColumn("_entering", F.lit(None).cast("string")).groupBy(*part).applyInArrow(leave, state))
    length = 1
    while True:
        before = F.lag("_leaving").over(Window.partitionBy(*keys).orderBy("_part"))  # one row a part
        block = F.expr(f"_part div {length}")
        wanted = known.withColumn("_wanted", before).withColumn("_block", block)
        stale = F.when(~F.col("_wanted").eqNullSafe(F.col("_entering")), F.col("_part"))
        wanted = wanted.withColumn("_from", F.min(stale).over(Window.partitionBy(*keys, "_block")))
        todo = wanted.where(F.col("_part") >= F.col("_from"))  # a block's parts from the first one that changes
        if todo.isEmpty():
            break
        rows = _on(light, todo, part, ("_block", "_entering", "_leaving", "_wanted"))
        again = rows.repartition(*keys, "_block").sortWithinPartitions(*part, *order).mapInArrow(hand_on, state)
        known = checkpointed(_replaced(known, again, part))
        length *= GROWTH
    light.unpersist()
    return _on(cut, known.drop("_leaving"), part).groupBy(*part).applyInArrow(verdicts, schema)


def _groups(batches, by: Sequence[str]):
    """Tables of the rows of one group each, out of batches sorted by ``by``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = [0]
        if batch.num_rows > 1:
            differs = [pc.fill_null(pc.not_equal(c[1:], c[:-1]), False) for c in map(batch.column, by)] + [pc.not_equal(c[1:].is_null(), c[:-1].is_null()) for c in map(batch.column, by)]
            for d in differs[1:]:
                differs[0] = pc.or_(differs[0], d)
            change += [i + 1 for i in pc.indices_nonzero(differs[0]).to_pylist()]
        for lo, hi in zip(change, [*change[1:], batch.num_rows], strict=True):
            piece = batch.slice(lo, hi - lo)
            if held and any(held[-1].column(c)[0] != piece.column(c)[0] for c in by):
                yield pa.Table.from_batches(held)
                held = []
            held.append(piece)
    if held:
        yield pa.Table.from_batches(held)


def _replaced(known: DataFrame, again: DataFrame, part: Sequence[str]) -> DataFrame:
    """``known`` with the states in ``again`` where there are any; one row a part."""
    fresh = again.withColumn("_new", F.lit(1)).unionByName(known.withColumn("_new", F.lit(0)))
    last = fresh.groupBy(*part).agg(F.max_by(F.struct("_entering", "_leaving"), "_new").alias("_s"))
    return last.select(*part, "_s._entering", "_s._leaving")


def _on(rows: DataFrame, states: DataFrame, part: Sequence[str], more: Sequence[str] = ("_entering",)) -> DataFrame:
    """Rows of the parts that have a state, with it; null keys meet."""
    renamed = states.select(*[F.col(c).alias(f"_on{i}") for i, c in enumerate(part)], *more)
    return rows.join(renamed, [F.col(c).eqNullSafe(F.col(f"_on{i}")) for i, c in enumerate(part)]).select(*rows.columns, *more)
