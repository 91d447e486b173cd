"""Interleaving sources at target weights by proportionate fair scheduling. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulare.llm.rows import packed
from tabulare.session import work_table

BLOCK_ROWS = 16
RANGE_BLOCKS = 256
PARTS = 1 << 40  # weights that are not whole numbers are taken as so many parts of their sum
CELLS = 4_096
WHOLE = "decimal(38,0)"


def _quotient(over: Column, under: Column) -> Column:
    """The whole part of a quotient of whole numbers, exactly."""
    return F.call_function("div", over.cast(WHOLE), under.cast(WHOLE))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def target_weights(sizes: DataFrame, temperature: float) -> tuple[DataFrame, int]:
    """Per source its target ``_q`` as a whole number, 1 at least, and the sum of all.

    ``sizes`` has ``_source`` and ``_weight``, a row per source. A weight is
    raised to the power of the temperature, as is usual to lift small sources.
    Whole numbers are kept as they are; others are scaled to a sum of ``PARTS``.
    A weight that is not above 0 counts as the smallest one that is, or 1.
    """
    raised = sizes.withColumn("_w", F.when(F.col("_weight") > 0, F.pow(F.col("_weight").cast("double"), F.lit(temperature))))
    found = raised.agg(
        F.min("_w").alias("least"), F.sum(F.coalesce("_w", F.lit(0.0))).alias("all"), F.count_if(F.col("_w") != F.floor("_w")).alias("broken")
    ).first()
    least = found["least"] or 1.0
    scale = PARTS / (found["all"] or 1.0) if found["broken"] or (found["all"] or 0) > PARTS else 1.0
    weighed = raised.withColumn(
        "_q", F.greatest(F.round(F.coalesce("_w", F.lit(least)) * scale).cast("bigint"), F.lit(1).cast("bigint"))
    ).drop("_w")
    return weighed, weighed.agg(F.sum("_q")).first()[0] or 1


def release(block: Column, q: Column, total: Column) -> Column:
    """The first slot in which a source's block, counted from 0, may run: it is not more than a block early."""
    return _quotient(block.cast(WHOLE) * total.cast(WHOLE), q)


def deadline(block: Column, q: Column, total: Column) -> Column:
    """The slot before which it must have run: it is not more than a block late."""
    return _quotient((block + 1).cast(WHOLE) * total.cast(WHOLE) + q - 1, q)


def range_starts(sources: DataFrame, total: int, range_blocks: int) -> DataFrame:
    """Slots ``_from`` at which the schedule is cut, numbered ``_k`` from 0 on: between two of them are about ``range_blocks`` blocks.

    ``sources`` has ``_blocks`` and ``_q``. While all sources last each slot has
    a block; when some are used up, those of the others lie further apart. No
    block may run on both sides of two cuts, so between two of them are at
    least as many as the sources have for two of the smallest target.
    """
    size = max(range_blocks, -(-total // (sources.agg(F.min("_q")).first()[0] or 1)) + 2)
    by_end = Window.orderBy("_end", "_source")  # one row per source
    earlier = by_end.rowsBetween(Window.unboundedPreceding, -1)
    ordered = (
        sources.withColumn("_end", F.col("_blocks") / F.col("_q") * total)  # the slot by which a source is used up
        .withColumn("_begin", F.lag("_end", 1, 0.0).over(by_end))
        .withColumn("_rate", (total - F.coalesce(F.sum("_q").over(earlier), F.lit(0))) / total)
        .withColumn("_run", F.coalesce(F.sum("_blocks").over(earlier), F.lit(0)) + F.col("_begin") * F.col("_rate"))
        .withColumn("_until", F.lead("_run").over(by_end))
        .withColumn("_until", F.coalesce("_until", F.sum("_blocks").over(by_end.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    )
    first, last = F.ceil(F.col("_run") / size), F.ceil(F.col("_until") / size) - 1
    cuts = ordered.where(first <= last).select("_begin", "_run", "_rate", F.explode(F.sequence(first, last)).alias("_k"))
    return cuts.select(F.col("_k").cast("bigint"), F.ceil(F.col("_begin") + (F.col("_k") * size - F.col("_run")) / F.col("_rate")).cast("bigint").alias("_from"))


def settled_at(sources: DataFrame, starts: DataFrame, total: int) -> DataFrame:
    """Per source and cut: ``_done``, how many of its blocks run before the cut: its share until then, rounded up or down.

    Of the blocks that have begun to be due at a cut, those with the earliest
    deadlines are rounded up, but among the ones released in any last slots no
    more than their shares add up to. So all blocks before the cut fit in the
    slots before it, all others in those after it, and the ranges between cuts
    are settled on their own.
    """
    q, t, whole = F.col("_q"), F.col("_from"), F.lit(total).cast("bigint")
    at = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_last"))).alias("_k")
    last = starts.agg(F.max("_k")).first()[0] or 0
    due = sources.withColumn("_last", F.lit(last).cast("bigint")).select("_source", "_blocks", "_q", at)
    due = due.join(starts.withColumnRenamed("_k", "_cut"), F.col("_k") == F.col("_cut")).drop("_cut")
    share = q.cast(WHOLE) * t
    begun = _quotient(share, whole)
    due = due.withColumn("_floor", begun).withColumn("_part", (share - F.col("_floor").cast(WHOLE) * total).cast("bigint"))
    open_block = (F.col("_part") > 0) & (F.col("_floor") < F.col("_blocks"))
    due = work_table(due.withColumn("_floor", F.least("_floor", "_blocks")).withColumn("_open", open_block), "due")
    # Latest release first: what is rounded up among these is bounded by the sum of their parts.
    crossing = due.where("_open").select(
        "_k",
        F.struct(
            (-release(F.col("_floor"), q, whole)).alias("r"), deadline(F.col("_floor"), q, whole).alias("d"), F.col("_source").alias("s"),
            F.col("_part").alias("p"),
        ).alias("_c"),
    )

    def step(state: Column, c: Column) -> Column:
        part = state["part"] + c["p"]
        more = F.array_append(state["up"], F.struct(c["d"].alias("d"), c["s"].alias("s")))
        room = F.ceil(part.cast("decimal(30,0)") / total)
        return F.struct(
            part.alias("part"),
            _let(more, lambda up: F.when(F.size(up) > room, F.array_remove(up, F.array_max(up))).otherwise(up)).alias("up"),
        )

    none = F.struct(F.lit(0).cast("bigint").alias("part"), F.array().cast("array<struct<d: bigint, s: string>>").alias("up"))
    chosen = (
        crossing.groupBy("_k")
        .agg(F.sort_array(F.collect_list("_c")).alias("_cs"))
        .select(F.col("_k").alias("_k_up"), F.explode(F.aggregate("_cs", none, step, lambda state: state["up"])).alias("_up"))
        .select("_k_up", F.col("_up.s").alias("_s_up"))
    )
    same = (F.col("_k") == F.col("_k_up")) & (F.col("_source") == F.col("_s_up"))
    return due.join(chosen, same, "left").select(
        "_source", "_q", "_blocks", "_k", "_from",
        (F.col("_floor") + F.when(F.col("_k_up").isNotNull(), 1).otherwise(0)).alias("_done"),
    )


def fair_schedule(sources: DataFrame, total: int, range_blocks: int = RANGE_BLOCKS) -> DataFrame:
    """Per source and block: ``_block``, ``_release``, ``_deadline`` and ``_slot``, earliest deadline first.

    ``sources`` has ``_source``, ``_blocks`` and ``_q``, its target out of
    ``total``. In each slot, of the blocks that are released the one with the
    earliest deadline runs; ties go to the source that sorts first. The slots
    are cut into ranges, each of which is settled in one task: it has about
    ``range_blocks`` of them, or as many as the sources have between two blocks
    of the smallest target, and its work is that times the sources.
    """
    starts = work_table(range_starts(sources, total, range_blocks), "starts")
    done = work_table(settled_at(sources, starts, total), "done")
    per_source = Window.partitionBy("_source").orderBy("_k")
    spans = done.select(
        "_source", "_q", "_k", "_from", F.col("_done").alias("_first"),
        F.coalesce(F.lead("_done").over(per_source), F.col("_blocks")).alias("_next"),
        F.lead("_from").over(per_source).alias("_to"),
    ).where("_next > _first")
    q, whole = F.col("_q"), F.lit(total).cast("bigint")
    blocks = spans.select(
        "_source", "_q", "_k", "_from", "_to", F.explode(F.sequence(F.col("_first"), F.col("_next") - 1)).alias("_block")
    ).withColumns({"_release": release(F.col("_block"), q, whole), "_deadline": deadline(F.col("_block"), q, whole)})
    job = F.struct(
        F.least("_deadline", "_to").alias("d"), F.col("_source").alias("s"), F.col("_block").alias("i"),
        F.col("_release").alias("release"), F.col("_deadline").alias("deadline"),
    )
    # What is released in each slot of a range, slot by slot.
    released = blocks.groupBy("_k", F.greatest("_release", "_from").alias("_r")).agg(F.collect_list(job).alias("_js"))
    ranges = released.groupBy("_k").agg(
        F.sort_array(F.collect_list(F.struct(F.col("_r").alias("r"), F.col("_js").alias("js")))).alias("_events"),
        F.sum(F.size("_js")).alias("_jobs"),
    )
    kind = "struct<d: bigint, s: string, i: bigint, release: bigint, deadline: bigint>"
    nothing = F.array().cast(f"array<{kind}>")

    def step(state: Column, _: Column) -> Column:
        event = F.get(F.col("_events"), state["next"])
        now = F.when(F.size(state["ready"]) == 0, event["r"]).otherwise(state["now"])
        comes = F.coalesce(event["r"] <= now, F.lit(False))
        ready = F.concat(state["ready"], F.when(comes, event["js"]).otherwise(nothing))

        def run(with_best: Column) -> Column:
            return F.struct(
                (with_best["now"] + 1).alias("now"),
                F.when(comes, state["next"] + 1).otherwise(state["next"]).alias("next"),
                F.array_remove(with_best["ready"], with_best["best"]).alias("ready"),
                F.array_append(state["out"], F.struct(with_best["now"].alias("slot"), with_best["best"].alias("job"))).alias("out"),
            )

        def pick(found: Column) -> Column:
            return F.struct(now.alias("now"), found.alias("ready"), F.array_min(found).alias("best"))

        return _let(_let(ready, pick), run)

    start = F.struct(
        F.lit(0).cast("bigint").alias("now"), F.lit(0).alias("next"), nothing.alias("ready"),
        F.array().cast(f"array<struct<slot: bigint, job: {kind}>>").alias("out"),
    )
    order = F.aggregate(F.sequence(F.lit(1).cast("bigint"), F.col("_jobs")), start, step, lambda state: state["out"])
    return ranges.select(F.explode(order).alias("_at")).select(
        F.col("_at.job.s").alias("_source"), F.col("_at.job.i").alias("_block"), F.col("_at.job.release").alias("_release"),
        F.col("_at.job.deadline").alias("_deadline"), F.col("_at.slot").alias("_slot"),
    )


def with_positions(
    docs: DataFrame,
    weights: DataFrame | None = None,
    key: str = "doc_id",
    source: str = "source",
    temperature: float = 0.5,
    block_rows: int = BLOCK_ROWS,
    range_blocks: int = RANGE_BLOCKS,
    cells: int = CELLS,
) -> DataFrame:
    """``docs`` with ``_block``, ``_release``, ``_deadline``, ``_slot`` and ``_position`` added; no row is left out.

    Ordered by ``_position``, after any number of slots each source has had its
    target share of the blocks, within less than one block, as long as all
    sources last: block i of a source with the share w runs from slot
    floor(i / w) on and before slot ceil((i + 1) / w). Sources that last longer
    go on in their own slots. Targets are ``weights`` (``_source``,
    ``_weight``; of several for one source the largest), or the numbers of rows,
    raised to ``temperature``. A source without a weight above 0 has the
    smallest one.

    The rows of a source are taken in order of a digest of their key. They are
    numbered per cell of that digest, after the rows of the cells before, so
    that a source of any size is spread over ``cells`` tasks. A null source is
    a source like another; repeated rows follow each other; an empty table
    gives no rows.
    """
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    celled = docs.withColumns(
        {
            "_source": F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")),
            "_digest": digest,
            "_cell": F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(cells)).cast("int"),
        }
    )
    before = Window.partitionBy("_source").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    per_cell = work_table(celled.groupBy("_source", "_cell").agg(F.count("*").alias("_rows")), "cells")
    sizes = per_cell.groupBy("_source").agg(F.sum("_rows").alias("_weight"))
    sizes = sizes.withColumn("_blocks", F.ceil(F.col("_weight") / block_rows).cast("bigint"))
    if weights is not None:
        given = weights.groupBy(F.coalesce(F.concat(F.lit("="), F.col("_source").cast("string")), F.lit("")).alias("_of")).agg(
            F.max("_weight").alias("_given")
        )
        sizes = sizes.join(given, F.col("_source") == F.col("_of"), "left").select("_source", F.col("_given").alias("_weight"), "_blocks")
    weighed, total = target_weights(sizes, temperature)
    weighed = work_table(weighed.select("_source", "_blocks", "_q"), "weighed")
    schedule = work_table(fair_schedule(weighed, total, range_blocks), "schedule")
    offsets = per_cell.select(
        F.col("_source").alias("_s"), F.col("_cell").alias("_c"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
    )
    in_cell = Window.partitionBy("_source", "_cell").orderBy("_digest", key)
    number = F.col("_before") + F.row_number().over(in_cell) - 1
    return (
        celled.join(offsets, (F.col("_source") == F.col("_s")) & (F.col("_cell") == F.col("_c")))
        .withColumn("_number", number)
        .withColumn("_of", F.floor(F.col("_number") / block_rows).cast("bigint"))
        .drop("_s", "_c", "_before", "_digest", "_cell")
        .join(schedule.withColumnRenamed("_source", "_s"), (F.col("_source") == F.col("_s")) & (F.col("_of") == F.col("_block")))
        .withColumn("_position", F.col("_slot") * block_rows + F.pmod("_number", F.lit(block_rows)))
        .drop("_s", "_of", "_source", "_number")
    )


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, key: str = "doc_id", **options) -> DataFrame:
    """Per row: ``doc_id``, ``source``, ``block``, ``release``, ``deadline``, ``slot`` and ``position``."""
    source = options.get("source", "source")
    placed = with_positions(docs.select(key, source), weights, key, **options)
    return placed.select(
        F.col(key).alias("doc_id"), F.col(source).alias("source"),
        *(F.col(f"_{name}").alias(name) for name in ("block", "release", "deadline", "slot", "position")),
    )


def has_places(docs: DataFrame) -> bool:
    """Whether the rows come straight from files, so that each has a file and a place in it."""
    try:
        docs.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return False
    return True


def mixed_order(docs: DataFrame, key: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """All rows and columns in the order of the mixture: range by range, and sorted within each.

    Nulls, ties and repeated rows are as in ``with_positions``; texts are
    carried as they are; an empty table stays empty. Rows that come from files
    are placed by their keys and sources alone, and joined to their places.
    """
    if has_places(docs):
        at = (F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row_in_file"))
        narrow = docs.select(*at, F.col(key).alias("_id"), F.col(source).alias("_src"))
        places = with_positions(narrow, key="_id", source="_src", **options).select(
            F.col("_file").alias("_f"), F.col("_row_in_file").alias("_r"), "_position"
        )
        rows = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("_row"), *at)
        placed = rows.join(places.hint("merge"), (F.col("_file") == F.col("_f")) & (F.col("_row_in_file") == F.col("_r")))
    else:
        placed = with_positions(packed(docs, _id=key, _src=source), key="_id", source="_src", **options)
    return placed.repartitionByRange("_position").sortWithinPartitions("_position").select("_row.*")


def written_order(docs: DataFrame) -> DataFrame:
    """Per row ``_row``, all its columns, and ``_position``, its place in the order in which Spark wrote the table, from 0 on.

    Spark numbers the files of a table in the order of its partitions, and a
    row has a place in its file; reading brings the files back in any order.
    """
    name = F.col("_metadata.file_name")
    file = F.struct(
        *(F.coalesce(F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")), F.lit("0")).cast("bigint").alias(part)
          for part, pattern in (("part", r"^part-(\d+)-"), ("next", r"\.c(\d+)\."))),
        name.alias("name"),
    )
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), file.alias("_file"), F.col("_metadata.row_index").alias("_at")
    )
    sizes = work_table(docs.select(file.alias("_f")).groupBy("_f").agg(F.count("*").alias("_rows")), "files")
    before = F.sum("_rows").over(Window.orderBy("_f").rowsBetween(Window.unboundedPreceding, -1))  # one row per file
    offsets = sizes.select("_f", F.coalesce(before, F.lit(0)).alias("_before"))
    return rows.join(offsets, F.col("_file") == F.col("_f")).select("_row", (F.col("_before") + F.col("_at")).alias("_position"))
