"""Mixing sources to target weights by entropy balancing.

Every source has a constraint: the words taken from it are its target. Among all rates that
meet it, those closest to "each document once" in relative entropy are exponentially tilted,
``rate = min(cap, exp(lambda * size / mean size))``, with one dual variable for each source.
Newton steps on the convex dual, each a distributed aggregation, find the variables.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from debutrank.llm import kernels as K
from debutrank.session import written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
STEPS = 40
TOLERANCE = 1e-6  # of the target
PARTS = 1024  # of the hashes of the keys, in which the rows of a cell are numbered


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replace the text by ``size``, its number of words (null: 0)."""
    others = [c for c in docs.columns if c not in (text, "size")]
    narrow = docs.select(*[f"`{c}`" for c in others], F.col(f"`{text}`").alias("_text"))
    schema = K.wider(narrow.drop("_text").schema, ("size", "long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.pieces(batch, "_text"):
                counts = K.spans(*K.joined(part.column("_text"))).counts
                columns = [*part.columns[:-1], pa.array(counts, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names[:-1], "size"])

    return narrow.mapInArrow(run, schema)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Per source: ``source_size`` and ``target``.

    Sources in code point order (null last) have the weights in turn and divide ``share`` of
    all words; a target stops at ``cap`` times its source, and what is above is divided among the
    others by weight, until none is above. That is the water level at which the targets
    ``min(cap * size, level * weight)`` add up, found from running sums over the sources sorted
    by their level. The windows without a key run over one row for each source.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place.cast("int") + 1)
    rows = total.withColumn("weight", weight)
    rows = rows.withColumn("limit", (F.col("source_size") * cap).cast("double"))
    rows = rows.withColumn("fill", F.col("limit") / F.col("weight"))
    by_level = Window.orderBy("fill", F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    spent = F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    wanted = F.least(F.sum("source_size").over(everything) * share, F.sum("limit").over(everything))
    rows = rows.withColumn("level", (wanted - spent) / open_weight)
    # it rises while sources that it fills are set aside and falls after that
    rows = rows.withColumn("level", F.max("level").over(everything))
    target = F.coalesce(F.least(F.col("limit"), F.col("level") * F.col("weight")), F.col("limit"))
    return rows.select("source", "source_size", "docs", target.alias("target"))


def _tilted(cap: int) -> Column:
    return F.least(F.lit(float(cap)), F.exp(F.least(F.col("dual") * F.col("x"), F.lit(50.0))))


def duals(cells: DataFrame, goal: DataFrame, cap: int = CAP, steps: int = STEPS) -> DataFrame:
    """The dual variable of every source, by safeguarded Newton steps.

    ``cells`` (source, size, n) are the documents counted by size. A step sums value and slope of
    the dual's gradient per source in one aggregation; a step that leaves the bracket known so
    far is replaced by its middle. Sources stay rows of a table: there may be any number. The loop
    ends when every source is within ``TOLERANCE`` of its target, or after ``steps`` steps.
    """
    state = goal.select(
        "source",
        "target",
        (F.col("source_size") / F.greatest("docs", F.lit(1))).alias("mean"),
        # at the cap, or with nothing to take, no finite variable is the answer
        (F.col("target") >= F.col("source_size") * cap * (1 - 1e-12)).alias("full"),
        F.lit(0.0).alias("dual"),
        F.lit(-60.0).alias("low"),
        F.lit(60.0).alias("high"),
        F.lit(False).alias("done"),
    )
    for _ in range(steps):
        state = written(state.withColumn("done", F.col("done") | F.col("full")), "dual")
        if state.filter("NOT done").isEmpty():
            break
        joined = cells.join(state, cells["source"].eqNullSafe(state["source"])).drop(cells["source"])
        joined = joined.filter("NOT done AND size > 0").withColumn("x", F.col("size") / F.col("mean"))
        rate = _tilted(cap)
        mass = F.col("n") * F.col("x")
        inside = F.when(rate < cap, mass * F.col("x") * rate).otherwise(0.0)
        sums = joined.groupBy(F.col("source").alias("_source")).agg(
            F.sum(mass * rate).alias("value"), F.sum(inside).alias("slope")
        )
        gap = F.col("value") - F.col("target") / F.col("mean")
        newton = F.col("dual") - gap / F.col("slope")
        state = state.join(sums, F.col("source").eqNullSafe(F.col("_source")), "left")
        state = state.withColumn("gap", F.coalesce(gap, F.lit(0.0)))
        state = state.withColumn("low", F.when(F.col("gap") < 0, F.col("dual")).otherwise(F.col("low")))
        state = state.withColumn("high", F.when(F.col("gap") > 0, F.col("dual")).otherwise(F.col("high")))
        near = F.abs(F.col("gap")) <= TOLERANCE * F.greatest(F.col("target") / F.col("mean"), F.lit(1e-9))
        usable = (F.col("slope") > 0) & (newton > F.col("low")) & (newton < F.col("high"))
        moved = F.when(usable, newton).otherwise((F.col("low") + F.col("high")) / 2)
        state = state.withColumn("done", F.col("done") | near)
        state = state.withColumn("dual", F.when(F.col("done"), F.col("dual")).otherwise(moved))
        state = state.select("source", "target", "mean", "full", "dual", "low", "high", "done")
    return state


def _diffuse(cap: int):
    """Copies per cell of one source: what rounding a cell leaves over goes on to the next shorter one.

    A document of a cell is taken ``whole`` times, the first ``extra`` ones once more. A source has one row for
    each size that occurs in it, as many as its longest document has words at most.
    """

    def run(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values("size", ascending=False, kind="stable")
        copies, owed = [], 0.0
        for size, n, rate in zip(cells["size"].tolist(), cells["n"].tolist(), cells["rate"].tolist()):
            owed += size * n * rate
            copies.append(min(max(round(owed / size), 0), cap * n) if size else round(n * rate))
            owed -= copies[-1] * size
        whole, extra = divmod(pd.Series(copies, cells.index, "int64"), cells["n"])
        return pd.DataFrame(
            {"source": cells["source"], "size": cells["size"], "rate": cells["rate"], "whole": whole, "extra": extra}
        )

    return run


def _same(a: DataFrame, b: DataFrame, *columns: str) -> Column:
    """Equality on the source, null or not, and on ``columns``."""
    condition = a["source"].eqNullSafe(b["source"])
    for c in columns:
        condition = condition & (a[c] == b[c])
    return condition


def take(
    sizes: DataFrame,
    key: str,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
) -> DataFrame:
    """Add ``source_size``, ``target``, ``rate`` and ``copies`` to rows with ``source`` and ``size``.

    Rates are rounded into copies per cell, a cell being the documents of one source and one size
    (they have one rate). From the longest documents to the shortest, what rounding a cell leaves
    over is carried to the next one, so the words taken differ from the target by about the
    size of a short document; inside the cell extra copies go to the rows first in the order of a
    hash of ``key``. Rows of a cell are numbered in ``PARTS`` parts of that hash, each from the
    number of rows in the parts before it, so that a cell with a third of all rows (a hot group of copies)
    is in no task as a whole, and the order is the same at every size.

    A null ``source`` is a source of its own. A null ``size`` counts as 0; empty documents have
    rate 1 or the cap and take nothing. Repeated rows are separate documents. No document is
    taken more than ``cap`` times. Reruns agree as long as ``key`` tells documents apart. Input columns may
    have any other names; those named as the ones added are replaced. ``sizes`` is computed once.
    """
    added = ("source_size", "target", "rate", "copies")
    others = [c for c in sizes.columns if c not in added]
    hash_ = F.xxhash64(F.col(f"`{key}`"))
    rows = sizes.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), "source",
        F.coalesce(F.col("size"), F.lit(0)).cast("long").alias("size"),
        hash_.alias("hash"), F.pmod(hash_, F.lit(PARTS)).cast("int").alias("part"), F.col(f"`{key}`").alias("key"),
    )
    rows = written(rows, "sizes")
    goal = written(targets(rows, weights, share, cap), "targets")
    parts = written(rows.groupBy("source", "size", "part").agg(F.count("*").alias("n")), "parts")
    cells = written(parts.groupBy("source", "size").agg(F.sum("n").alias("n")), "cells")

    # rounded, as the last bits of a distributed sum depend on the order of its rows
    dual = duals(cells, goal, cap).select("source", "mean", "full", F.round("dual", 9).alias("dual"))
    rated = cells.join(dual, _same(cells, dual)).drop(dual["source"])
    rated = rated.withColumn("x", F.col("size") / F.greatest(F.col("mean"), F.lit(1e-9)))
    rated = rated.withColumn("rate", F.when(F.col("full"), F.lit(float(cap))).otherwise(_tilted(cap)))
    rated = rated.select("source", "size", "n", "rate").groupBy("source")
    rated = rated.applyInPandas(_diffuse(cap), "source string, size long, rate double, whole long, extra long")
    rated = written(rated, "rates")

    order = Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))
    before = before.join(rated, _same(before, rated, "size")).drop(rated["source"], rated["size"])
    before = written(before.select("source", "size", "part", "rate", "whole", "extra", "before"), "extras")
    rows = rows.join(before, _same(rows, before, "size", "part")).drop(before["source"], before["size"], before["part"])
    turn = F.row_number().over(Window.partitionBy("source", "size", "part").orderBy("hash", "key"))
    extra = (F.col("before") + turn <= F.col("extra")).cast("long")
    rows = rows.withColumn("copies", (F.col("whole") + extra).cast("int"))
    # one row for each source; Spark broadcasts it only if its file is small
    goal = goal.select("source", "source_size", "target")
    rows = rows.join(goal, _same(rows, goal)).drop(goal["source"])
    columns = [F.col("size") if c == "size" else F.col("row").getField(c).alias(c) for c in others]
    return rows.select(*columns, *added)


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **terms) -> DataFrame:
    """The rows of ``docs`` in the mix: each as often as it is taken, with all its columns, whatever their names.

    Repeated rows (same key, source and text) all get the copies of the one that is taken most often. Null texts
    and empty ones have no words; an empty table stays empty.
    """
    narrow = docs.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{source}`").cast("string").alias("source"),
        F.xxhash64(F.col(f"`{text}`")).alias("text_hash"), F.col(f"`{text}`").alias("text"),
    )
    copies = take(word_counts(narrow), "key", **terms).filter("copies > 0")
    copies = copies.groupBy("key", "source", "text_hash").agg(F.max("copies").alias("copies"))
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{key}`").alias("key"),
        F.col(f"`{source}`").cast("string").alias("source"), F.xxhash64(F.col(f"`{text}`")).alias("text_hash"),
    )
    same = _same(whole, copies, "text_hash") & whole["key"].eqNullSafe(copies["key"])
    taken = whole.join(copies, same).select("row", F.explode(F.sequence(F.lit(1), "copies")))
    return taken.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
