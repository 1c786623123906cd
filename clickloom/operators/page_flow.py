"""One-step conversion along a flow of pages such as ``1,2,3,4``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.numbers import format_double, ratio
from clickloom.functions.strings import flow_pairs
from clickloom.functions.times import parse_time
from clickloom.sources.workspace import drop_folder, work_folder

SESSION = ["session", "nameless"]
# Rows of a session that one task sorts; larger sessions are cut at quantiles of their times.
SLICE_ROWS = 1_000_000
SLICES = 256


def task_flow_pairs(params: DataFrame) -> DataFrame:
    """Page pairs of each task's target flow, numbered from 0."""
    pairs = F.posexplode(flow_pairs("target_page_flow")).alias("idx", "page_split")
    return params.select("task_id", pairs)


def _pages(flow: str) -> list[int]:
    return [int(p) for p in flow.split(",")]


def _pairs(flow: str) -> list[str]:
    pages = _pages(flow)
    return [f"{a}_{b}" for a, b in zip(pages, pages[1:])]


def _borders(visits: DataFrame, slice_rows: int) -> DataFrame | None:
    """Instants that cut each session of more than ``slice_rows`` rows into even parts.

    They come from a quantile sketch, which may differ from run to run by the order of
    its merges. So they are stored: a task that runs again has to cut where it did before.
    None where no session is as large.
    """
    spark = visits.sparkSession
    folder = work_folder(spark, "page-slices")
    sizes = visits.groupBy(*SESSION).agg(F.count(F.lit(1)).alias("rows"))
    large = sizes.where(F.col("rows") > slice_rows).drop("rows")
    large.write.parquet(f"{folder}/large")
    large = spark.read.schema(large.schema).parquet(f"{folder}/large")
    if large.isEmpty():
        drop_folder(spark, folder)
        return None
    shares = [i / SLICES for i in range(1, SLICES)]
    cut = F.percentile_approx(F.unix_micros("ts"), shares).alias("cuts")
    cuts = visits.join(large, SESSION).groupBy(*SESSION).agg(cut)
    cuts.write.parquet(f"{folder}/cuts")
    return spark.read.schema(cuts.schema).parquet(f"{folder}/cuts")


def _sliced(visits: DataFrame, cuts: DataFrame) -> DataFrame:
    """Visits with ``slice``, which sorts a session's parts in time order.

    A slice is known by the number of cuts before its instants and up to them, so an
    instant that is a cut is a slice of its own. One that is several cuts holds more rows
    than a slice should: there each page is a slice, as rows of one instant go by page.
    """
    ts = F.unix_micros("ts")
    none = F.array().cast("array<bigint>")
    at = visits.join(cuts, SESSION, "left").withColumn("cuts", F.coalesce("cuts", none))
    below = F.size(F.filter("cuts", lambda c: c < ts))
    upto = F.size(F.filter("cuts", lambda c: c <= ts))
    cut = at.withColumns({"below": below, "upto": upto})
    page = F.when(F.col("upto") - F.col("below") > 1, F.col("page_id"))
    return cut.withColumn("slice", F.struct("below", "upto", page.alias("page"))).drop(
        "cuts", "below", "upto"
    )


def _followed(actions: DataFrame, slice_rows: int) -> DataFrame:
    """Each action with ``next``, a struct of the page after it; null for a session's last.

    A session of at most ``slice_rows`` rows is one window. Larger ones are looked for
    first, and cut into up to ``SLICES`` parts of about equal size. Steps inside a part
    come from a window over (session, part). The last action of a part is followed by the
    first of the session's next part; those are one aggregated row per part, placed by a
    window of their own and joined back. The result is the same for any cuts. Equal times
    are ordered by page; only rows equal in session, time and page stay in one task.
    """
    visits = actions.select(
        # Keys without nulls, so that joins need no other partitioning.
        F.coalesce("session_id", F.lit("")).alias("session"),
        F.col("session_id").isNull().alias("nameless"),
        "page_id",
        parse_time("action_time").alias("ts"),
    )
    session_id = F.when(~F.col("nameless"), F.col("session")).alias("session_id")
    page = F.struct("page_id")
    cuts = _borders(visits, slice_rows)
    if cuts is None:
        in_session = Window.partitionBy(*SESSION).orderBy("ts", "page_id")
        return visits.select(session_id, "page_id", F.lead(page).over(in_session).alias("next"))
    keys = [*SESSION, "slice"]
    # Dealt once for the window and for the first pages of the parts.
    visits = _sliced(visits, cuts).repartition(*keys)
    in_slice = Window.partitionBy(*keys).orderBy("ts", "page_id")
    placed = visits.withColumn("in_slice", F.lead(page).over(in_slice))
    firsts = visits.groupBy(*keys).agg(F.min(F.struct("ts", "page_id")).alias("first"))
    by_slice = Window.partitionBy(*SESSION).orderBy("slice")
    after = firsts.select(*keys, F.lead(F.struct("first.page_id")).over(by_slice).alias("after"))
    return placed.join(after, keys).select(
        session_id, "page_id", F.coalesce("in_slice", "after").alias("next")
    )


def page_steps(actions: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Each action with the next page of its session, in time order; last ones drop out.

    A null page is a page like any other: a step leads to it and one leads on from it.
    """
    steps = _followed(actions, slice_rows).where(F.col("next").isNotNull())
    return steps.select("session_id", "page_id", F.col("next.page_id").alias("next_page"))


def _split(next_page: str) -> Column:
    """``a_b``; null where either page is."""
    return F.concat(F.col("page_id").cast("string"), F.lit("_"), F.col(next_page).cast("string"))


def page_split_pairs(actions: DataFrame, flow: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row ``a_b`` for each step that is a pair of the target flow."""
    steps = page_steps(actions, slice_rows)
    steps = steps.select("session_id", _split("next_page").alias("page_split"))
    return steps.where(F.col("page_split").isin(_pairs(flow)))


def page_split_pv(actions: DataFrame, flow: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    pairs = page_split_pairs(actions, flow, slice_rows)
    return pairs.groupBy("page_split").agg(F.count(F.lit(1)).alias("pv"))


def start_page_pv(actions: DataFrame, flow: str) -> DataFrame:
    """One row: views of the flow's first page."""
    start = _pages(flow)[0]
    on_start = actions.where(F.col("page_id") == start)
    return on_start.agg(
        F.lit(start).cast("long").alias("page_id"), F.count(F.lit(1)).alias("pv")
    )


def page_convert_rates(
    actions: DataFrame, flow: str, scale: int = 2, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Rate of each step: its views over those of the step before (of the start page for
    the first). A step never taken counts 0; a rate over 0 is null.

    Steps and views of the start page are counted in one pass. The counts are at most one
    row per pair of the flow and one for all else, folded into one map.
    """
    pairs = _pairs(flow)
    if not pairs:
        raise ValueError("a page flow needs at least two pages")
    split = _split("next.page_id")
    counted = (
        _followed(actions, slice_rows)
        .groupBy(F.when(split.isin(pairs), split).alias("page_split"))
        .agg(
            F.count(F.lit(1)).alias("pv"),
            F.count_if(F.col("page_id") == _pages(flow)[0]).alias("starts"),
        )
    )
    entry = F.when(F.col("page_split").isNotNull(), F.struct("page_split", "pv"))
    views = counted.agg(
        F.map_from_entries(F.collect_list(entry)).alias("views"),
        F.coalesce(F.sum("starts"), F.lit(0).cast("long")).alias("start_pv"),
    )
    start = F.col("start_pv")

    def views_of(pair: str):
        return F.coalesce(F.try_element_at("views", F.lit(pair)), F.lit(0).cast("long"))

    rows = [
        F.struct(
            F.lit(i).alias("idx"),
            F.lit(pair).alias("page_split"),
            views_of(pair).alias("pv"),
            (start if i == 0 else views_of(pairs[i - 1])).alias("from_pv"),
        )
        for i, pair in enumerate(pairs)
    ]
    steps = views.select(F.inline(F.array(*rows)))
    rate = format_double(ratio("pv", "from_pv"), scale)
    return steps.select("idx", "page_split", rate.alias("convert_rate"))


def pack_rates(rates: DataFrame, task_id: int) -> DataFrame:
    """One row per task, ``1_2=0.5|2_3=0.25``, in flow order; an undefined rate is ``null``."""
    item = F.concat_ws(
        "=", "page_split", F.coalesce(F.col("convert_rate").cast("string"), F.lit("null"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("idx", item.alias("item"))))
    packed = F.array_join(F.transform(ordered, lambda x: x["item"]), "|")
    return rates.agg(
        F.lit(task_id).cast("long").alias("task_id"), packed.alias("convert_rate")
    )
