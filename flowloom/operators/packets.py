"""Packets to bidirectional flows.

A flow is a run of packets between two endpoints without an idle gap. A busy
endpoint pair may hold a large part of all packets, so packets are first counted per pair
and minute, and pairs with more packets than a slice may hold are cut at quantiles of
those counts. Runs and gaps are worked out within a slice. Only runs
that touch a slice edge can continue in the next slice; those few are joined up
per pair afterwards, all other runs are finished flows and stay spread out.
Lengths and microsecond gaps are summed as whole numbers, so the result does not
depend on the order in which partial sums meet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from flowloom.session import settle

KEY = ["endpoint_a", "endpoint_b", "protocol"]
FLAGS = ["fin", "syn", "rst", "psh", "ack", "urg", "cwr", "ece"]
SIDES = (0, 1)
# Gaps that start a new subflow and that count as idle time, in microseconds.
SUBFLOW_GAP, IDLE_GAP = 1_000_000, 5_000_000
_BIG = "decimal(38,0)"


def with_pair(packets: DataFrame) -> DataFrame:
    """Order the two endpoints of each packet, so both directions share one key.

    Input: src, src_port, dst, dst_port, protocol, ts, length, header_length,
    packet_id, one 0/1 column per TCP flag, and window where the capture has it.
    """
    window = F.col("window") if "window" in packets.columns else F.lit(0)
    source = F.concat_ws(":", "src", "src_port")
    target = F.concat_ws(":", "dst", "dst_port")
    return packets.select(
        F.least(source, target).alias("endpoint_a"),
        F.greatest(source, target).alias("endpoint_b"),
        "protocol", "ts", "packet_id",
        F.when(source <= target, 0).otherwise(1).alias("side"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("us"),
        F.col("length").cast("long").alias("length"),
        F.col("header_length").cast("long").alias("header_length"),
        window.cast("long").alias("window"),
        *[F.col(f).cast("long").alias(f) for f in FLAGS],
    )


def _square(c: Column) -> Column:
    return c.cast("decimal(19,0)") * c.cast("decimal(19,0)")


def _gap_sums(gap: Column, name: str) -> list[Column]:
    return [
        F.sum(_square(gap)).cast(_BIG).alias(f"{name}_sq"),
        F.min(gap).alias(f"{name}_min"),
        F.max(gap).alias(f"{name}_max"),
    ]


def _side_measures(s: int) -> list[Column]:
    mine = F.col("side") == s

    def of(name):
        return F.when(mine, F.col(name))

    return [
        F.count_if(mine).alias(f"n_{s}"),
        F.count_if(mine & (F.col("length") > 0)).alias(f"data_{s}"),
        F.coalesce(F.sum(of("length")), F.lit(0)).alias(f"len_{s}"),
        F.coalesce(F.sum(_square(of("length"))), F.lit(0)).cast(_BIG).alias(f"lensq_{s}"),
        F.min(of("length")).alias(f"lenmin_{s}"),
        F.max(of("length")).alias(f"lenmax_{s}"),
        F.coalesce(F.sum(of("header_length")), F.lit(0)).alias(f"hdr_{s}"),
        F.min(of("header_length")).alias(f"hdrmin_{s}"),
        F.coalesce(F.sum(of("psh")), F.lit(0)).alias(f"psh_{s}"),
        F.coalesce(F.sum(of("urg")), F.lit(0)).alias(f"urg_{s}"),
        F.min(of("us")).alias(f"first_{s}"),
        F.max(of("us")).alias(f"last_{s}"),
    ]


def _packet_measures() -> list[Column]:
    """Aggregates that do not need packet order; shared with the streaming job."""
    return [
        F.min("us").alias("first_us"), F.max("us").alias("last_us"),
        *[m for s in SIDES for m in _side_measures(s)],
        *[F.sum(f).alias(f) for f in FLAGS],
    ]


def _spread(value: Column, name: str) -> list[Column]:
    """Count, sum, squares and ends of the positive values."""
    v = F.when(value > 0, value)
    return [
        F.count(v).alias(f"{name}_n"),
        F.coalesce(F.sum(v), F.lit(0)).alias(f"{name}_sum"),
        F.coalesce(F.sum(_square(v)), F.lit(0)).cast(_BIG).alias(f"{name}_sq"),
        F.min(v).alias(f"{name}_min"),
        F.max(v).alias(f"{name}_max"),
    ]


def _pause_measures(gap: Column) -> list[Column]:
    """Subflow breaks and idle times among the gaps."""
    breaks = F.count_if(gap > SUBFLOW_GAP).alias("breaks")
    return [breaks, *_spread(F.when(gap > IDLE_GAP, gap), "idle")]


def _merged_spread(name: str, extra: list[Column]) -> list[Column]:
    """Merge partial spreads with further single values of each row."""
    more = [F.when(v > 0, v) for v in extra]
    one, none = F.lit(1), F.lit(0)

    def plus(base, piece):
        for v in more:
            base = base + F.coalesce(piece(v), none)
        return F.sum(base)

    return [
        plus(F.col(f"{name}_n"), lambda v: F.when(v.isNotNull(), one)).alias(f"{name}_n"),
        plus(F.col(f"{name}_sum"), lambda v: v).alias(f"{name}_sum"),
        plus(F.col(f"{name}_sq"), _square).cast(_BIG).alias(f"{name}_sq"),
        F.least(F.min(f"{name}_min"), *[F.min(v) for v in more]).alias(f"{name}_min"),
        F.greatest(F.max(f"{name}_max"), *[F.max(v) for v in more]).alias(f"{name}_max"),
    ]


_SUMMED = [f"{m}_{s}" for s in SIDES for m in ("n", "data", "len", "lensq", "hdr", "psh", "urg")] + FLAGS
_LOW = [f"{m}_{s}" for s in SIDES for m in ("lenmin", "hdrmin", "first")] + ["first_us"]
_HIGH = [f"{m}_{s}" for s in SIDES for m in ("lenmax", "last")] + ["last_us"]
_GAPS = ["gap", *[f"gap_{s}" for s in SIDES]]


def _place(us_step: int, id_step: int | None = None) -> list[Column]:
    """Start of the cell that a packet is counted in: so many microseconds or, within one microsecond, so many ids."""
    ids = F.floor(F.col("packet_id") / id_step) * id_step if id_step else F.lit(0)
    return [(F.floor(F.col("us") / us_step) * us_step).alias("at_us"), ids.cast("long").alias("at_id")]


def busy_slices(packets: DataFrame, slice_rows: int, cell_us: int) -> DataFrame:
    """(pair, cell, first, starts): for each counted cell of the pairs with more than `slice_rows` packets
    the slice it begins in and where the slices within it start.

    Cells with more than half a slice are counted anew in narrower ones, down to the microsecond and, where packet
    ids are whole numbers, to ids within it. Slices are whole cells, so none holds more than `slice_rows`
    packets. The tables grow with the busy pairs' minutes and slices, not with their packets.
    """
    half = max(1, slice_rows // 2)
    steps = [(cell_us,)] + [(u,) for u in (1_000_000, 1_000, 1) if u < cell_us]
    if isinstance(packets.schema["packet_id"].dataType, IntegralType):
        steps += [(1, i) for i in (1 << 24, 1 << 12, 1)]
    keys = [*KEY, "at_us", "at_id"]
    packets = packets.select(*KEY, "us", "packet_id")
    cells = packets.select(*KEY, *_place(*steps[0])).groupBy(*keys).agg(F.count("*").alias("n"))
    cells = cells.withColumn("whole", F.sum("n").over(W.partitionBy(*KEY))).filter(F.col("whole") > slice_rows).drop("whole")
    cells = settle(cells, "packet-cells")
    pieces = cells.filter(F.col("n") <= half)
    for wide, narrow in zip(steps, steps[1:]):
        heavy = cells.filter(F.col("n") > half)
        if heavy.isEmpty():
            break
        held = packets.select(*KEY, "us", "packet_id", *_place(*wide)).join(heavy.select(*keys), keys)
        cells = settle(held.select(*KEY, *_place(*narrow)).groupBy(*keys).agg(F.count("*").alias("n")), "packet-cells")
        pieces = pieces.unionByName(cells.filter(F.col("n") <= half) if narrow != steps[-1] else cells)
    before = F.sum("n").over(W.partitionBy(*KEY).orderBy("at_us", "at_id").rowsBetween(W.unboundedPreceding, -1))
    pieces = pieces.withColumn("slice", F.floor(F.coalesce(before, F.lit(0)) / half)).withColumn("cell", F.floor(F.col("at_us") / cell_us))
    starts = pieces.groupBy(*KEY, "cell", "slice").agg(F.min(F.struct("at_us", "at_id")).alias("start"))
    starts = starts.groupBy(*KEY, "cell").agg(F.min("slice").alias("first"), F.sort_array(F.collect_list("start")).alias("starts"))
    return settle(starts, "packet-slices")


def sliced(packets: DataFrame, slice_rows: int, cell_us: int) -> DataFrame:
    """Packets with their slice: 0 for the packets of quiet pairs."""
    slices = busy_slices(packets, slice_rows, cell_us)
    at = F.struct(F.col("us").alias("at_us"), (F.col("packet_id").cast("long") if isinstance(packets.schema["packet_id"].dataType, IntegralType) else F.lit(0).cast("long")).alias("at_id"))
    number = F.col("first") + F.size(F.filter("starts", lambda s: s <= at)) - 1
    cut = packets.withColumn("cell", F.floor(F.col("us") / cell_us)).join(slices, [*KEY, "cell"], "left")
    return cut.withColumn("slice", F.coalesce(number, F.lit(0))).drop("cell", "first", "starts")


def _runs(packets: DataFrame, gap_us: int) -> DataFrame:
    """Gap-free runs inside one time slice of one endpoint pair, numbered in time order."""
    cell = [*KEY, "slice"]
    order = W.partitionBy(*cell).orderBy("us", "packet_id")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    step = packets.withColumns(
        {"_prev": F.lag("us").over(order)}
        | {f"_prev_{s}": F.last(F.when(F.col("side") == s, F.col("us")), True).over(before) for s in SIDES}
    )
    starts = F.col("_prev").isNull() | (F.col("us") - F.col("_prev") > gap_us)
    step = step.withColumns(
        {
            "_starts": starts,
            "run": F.count_if(starts).over(so_far),
            "_since": F.max(F.when(starts, F.col("us"))).over(so_far),
        }
    )
    gaps = {"gap": F.when(~F.col("_starts"), F.col("us") - F.col("_prev"))}
    for s in SIDES:
        inside = (F.col("side") == s) & ~F.col("_starts") & (F.col(f"_prev_{s}") >= F.col("_since"))
        gaps[f"gap_{s}"] = F.when(inside, F.col("us") - F.col(f"_prev_{s}"))
        leads = (F.col("side") == s) & ~F.coalesce(F.col(f"_prev_{s}") >= F.col("_since"), F.lit(False))
        gaps[f"_win_{s}"] = F.when(leads, F.col("window"))
    # An active phase ends where an idle gap follows; its first and last phase may reach into other slices.
    opens = F.col("_starts") | (F.col("us") - F.col("_prev") > IDLE_GAP)
    step = step.withColumn("_phase", F.max(F.when(opens, F.col("us"))).over(so_far))
    step = step.withColumn("_phase_before", F.lag("_phase").over(order)).withColumns(gaps)
    idle_before = F.col("gap") > IDLE_GAP
    whole_phase = F.when(idle_before & (F.col("_phase_before") > F.col("_since")), F.col("_prev") - F.col("_phase_before"))
    return (
        step.groupBy(*cell, "run")
        .agg(
            F.max(F.when(F.col("_starts"), F.col("side"))).alias("opener"),
            *_packet_measures(),
            *[F.max(f"_win_{s}").alias(f"win_{s}") for s in SIDES],
            *[m for g in _GAPS for m in _gap_sums(F.col(g), g)],
            *_pause_measures(F.col("gap")),
            *_spread(whole_phase, "active"),
            F.min(F.when(idle_before, F.col("_prev"))).alias("head_end"),
            F.max("_phase").alias("tail_start"),
        )
    )


def _joined_runs(runs: DataFrame, gap_us: int) -> DataFrame:
    """Whole flows: runs at slice edges are chained over the slices of their pair."""
    last_run = F.max("run").over(W.partitionBy(*KEY, "slice"))
    inner = (F.col("run") > 1) & (F.col("run") < last_run)
    lane = [*KEY, "_lane"]
    order = W.partitionBy(*lane).orderBy("slice", "run")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    step = runs.withColumn("_lane", F.when(inner, F.xxhash64("slice", "run")).otherwise(-1)).withColumns(
        {"_prev": F.lag("last_us").over(order)}
        | {f"_prev_{s}": F.last(f"last_{s}", True).over(before) for s in SIDES}
    )
    starts = F.col("_prev").isNull() | (F.col("first_us") - F.col("_prev") > gap_us)
    step = step.withColumns(
        {
            "_starts": starts,
            "_flow": F.count_if(starts).over(so_far),
            "_since": F.max(F.when(starts, F.col("first_us"))).over(so_far),
        }
    )
    bridges = {"bridge": F.when(~F.col("_starts"), F.col("first_us") - F.col("_prev"))}
    for s in SIDES:
        inside = ~F.col("_starts") & (F.col(f"_prev_{s}") >= F.col("_since"))
        bridges[f"bridge_{s}"] = F.when(inside, F.col(f"first_{s}") - F.col(f"_prev_{s}"))
        leads = (F.col(f"n_{s}") > 0) & ~F.coalesce(F.col(f"_prev_{s}") >= F.col("_since"), F.lit(False))
        bridges[f"_win_{s}"] = F.when(leads, F.col(f"win_{s}"))
    merged = []
    for g in _GAPS:
        b = g.replace("gap", "bridge")
        squares = F.coalesce(F.col(f"{g}_sq"), F.lit(0)) + F.coalesce(_square(F.col(b)), F.lit(0))
        merged += [
            F.sum(squares).cast(_BIG).alias(f"{g}_sq"),
            F.least(F.min(f"{g}_min"), F.min(b)).alias(f"{g}_min"),
            F.greatest(F.max(f"{g}_max"), F.max(b)).alias(f"{g}_max"),
        ]
    step = step.withColumns(bridges)
    apart = F.col("_starts") | (F.col("bridge") > IDLE_GAP)
    broken = F.col("idle_n") > 0
    opened = F.when(broken, F.col("tail_start")).when(apart, F.col("first_us"))
    step = step.withColumns(
        {"_open": F.last(opened, True).over(so_far), "_open_before": F.last(opened, True).over(before)}
    )
    closed_by_bridge = F.when(F.col("bridge") > IDLE_GAP, F.col("_prev") - F.col("_open_before"))
    head_start = F.when(apart, F.col("first_us")).otherwise(F.col("_open_before"))
    closed_inside = F.when(broken, F.col("head_end") - head_start)
    merged += [
        F.sum(F.col("breaks") + F.coalesce((F.col("bridge") > SUBFLOW_GAP).cast("long"), F.lit(0))).alias("breaks"),
        *_merged_spread("idle", [F.when(F.col("bridge") > IDLE_GAP, F.col("bridge"))]),
        *_merged_spread("active", [closed_by_bridge, closed_inside]),
        F.max("_open").alias("tail_start"),
        *[F.max(f"_win_{s}").alias(f"win_{s}") for s in SIDES],
    ]
    return (
        step.groupBy(*lane, "_flow")
        .agg(
            F.max(F.when(F.col("_starts"), F.col("opener"))).alias("opener"),
            *[F.sum(c).alias(c) for c in _SUMMED],
            *[F.min(c).alias(c) for c in _LOW],
            *[F.max(c).alias(c) for c in _HIGH],
            *merged,
        )
    )


def _deviation(n: Column, total: Column, squares: Column) -> Column:
    """Sample variance from whole-number sums, 0 below two values."""
    count = n.cast("decimal(19,0)")
    spread = (count * squares.cast(_BIG) - _square(total)).cast("double")
    return F.when(n < 2, F.lit(0.0)).otherwise(spread / (n.cast("double") * (n - 1).cast("double")))


def flow_features(flows: DataFrame, gaps: bool, keep: Sequence[str] = ()) -> DataFrame:
    """Named flow features from merged sums; forward is the direction of the first packet."""
    fwd_is_a = F.col("opener") == 0
    zero = F.lit(0)

    def side(name, forward):
        a, b = F.col(f"{name}_0"), F.col(f"{name}_1")
        return F.when(fwd_is_a, a if forward else b).otherwise(b if forward else a)

    def gap(stat, forward):
        a, b = F.col(f"gap_0_{stat}"), F.col(f"gap_1_{stat}")
        return F.when(fwd_is_a, a if forward else b).otherwise(b if forward else a)

    duration = F.col("last_us") - F.col("first_us")
    n = F.col("n_0") + F.col("n_1")
    size, squares = F.col("len_0") + F.col("len_1"), F.col("lensq_0") + F.col("lensq_1")
    mean = size.cast("double") / n
    variance = _deviation(n, size, squares)

    def per_second(amount):
        rate = amount.cast("double") * 1e6 / F.when(duration > 0, duration)
        return F.when(duration > 0, rate).when(amount > 0, F.lit(float("inf")))

    def part(x):
        return F.coalesce(x, zero).cast("double")

    out = {
        "flow_start": F.timestamp_micros("first_us"), "Protocol": F.col("protocol"),
        "Flow Duration": duration,
        "Total Fwd Packet": side("n", True), "Total Bwd packets": side("n", False),
        "Total Length of Fwd Packet": side("len", True), "Total Length of Bwd Packet": side("len", False),
    }
    for title, forward in (("Fwd", True), ("Bwd", False)):
        k, total = side("n", forward), side("len", forward)
        average = F.when(k > 0, total.cast("double") / k).otherwise(0.0)
        out |= {
            f"{title} Packet Length Max": part(side("lenmax", forward)),
            f"{title} Packet Length Min": part(side("lenmin", forward)),
            f"{title} Packet Length Mean": average,
            f"{title} Packet Length Std": F.sqrt(_deviation(k, total, side("lensq", forward))),
            f"{title} PSH Flags": side("psh", forward), f"{title} URG Flags": side("urg", forward),
            f"{title} Header Length": side("hdr", forward), f"{title} Packets/s": per_second(k),
            f"{title} Segment Size Avg": average,
        }
        span = F.coalesce(side("last", forward) - side("first", forward), zero)
        out[f"{title} IAT Total"] = span
        out[f"{title} IAT Mean"] = F.when(k > 1, span.cast("double") / (k - 1)).otherwise(0.0)
        if gaps:
            out |= {
                f"{title} IAT Std": F.sqrt(_deviation(k - 1, span, gap("sq", forward))),
                f"{title} IAT Max": part(gap("max", forward)),
                f"{title} IAT Min": part(gap("min", forward)),
            }
    out |= {
        "Flow Bytes/s": per_second(size), "Flow Packets/s": per_second(n),
        "Flow IAT Mean": F.when(n > 1, duration.cast("double") / (n - 1)).otherwise(0.0),
        "Packet Length Min": part(F.least("lenmin_0", "lenmin_1")),
        "Packet Length Max": part(F.greatest("lenmax_0", "lenmax_1")),
        "Packet Length Mean": mean, "Packet Length Std": F.sqrt(variance), "Packet Length Variance": variance,
        "Average Packet Size": mean,
        "Down/Up Ratio": F.when(side("n", True) > 0, side("n", False) / side("n", True)).otherwise(0.0),
        "Fwd Act Data Pkts": side("data", True),
        "Fwd Seg Size Min": part(side("hdrmin", True)),
        "FWD Init Win Bytes": F.coalesce(side("win", True), zero), "Bwd Init Win Bytes": F.coalesce(side("win", False), zero),
        **{f"{f.upper()} Flag Count": F.col(f) for f in FLAGS},
    }
    if gaps:
        out |= {
            "Flow IAT Std": F.sqrt(_deviation(n - 1, duration, F.col("gap_sq"))),
            "Flow IAT Max": part(F.col("gap_max")), "Flow IAT Min": part(F.col("gap_min")),
        }
        tail = F.col("last_us") - F.col("tail_start")
        last_phase = F.when(tail > 0, tail)
        spreads = {
            "Idle": [F.col(f"idle_{m}") for m in ("n", "sum", "sq", "min", "max")],
            "Active": [
                F.col("active_n") + last_phase.isNotNull().cast("long"),
                F.col("active_sum") + F.coalesce(last_phase, zero),
                F.col("active_sq") + F.coalesce(_square(last_phase), zero),
                F.least("active_min", last_phase), F.greatest("active_max", last_phase),
            ],
        }
        for title, (count, total, sq, low, high) in spreads.items():
            out |= {
                f"{title} Mean": F.when(count > 0, total.cast("double") / count).otherwise(0.0),
                f"{title} Std": F.sqrt(_deviation(count, total, sq)),
                f"{title} Max": part(high), f"{title} Min": part(low),
            }
        for title, forward in (("Fwd", True), ("Bwd", False)):
            for what, amount in (("Packets", side("n", forward)), ("Bytes", side("len", forward))):
                share = F.floor(amount / F.col("breaks"))
                out[f"Subflow {title} {what}"] = F.when(F.col("breaks") > 0, share).otherwise(0)
    return flows.select("endpoint_a", "endpoint_b", *keep, *[c.alias(name) for name, c in out.items()])


def packets_to_flows(packets: DataFrame, gap_seconds: float, slice_rows: int = 1_000_000, cell_seconds: float = 60.0) -> DataFrame:
    """One row per flow with length, direction, flag, rate and inter-arrival features.

    At most `slice_rows` packets are sorted in one task; the slices and `cell_seconds`, the width in which packets are
    counted first, don't change the flows. If packet ids are not whole numbers, the
    packets of a pair with the same microsecond stay in one slice.
    """
    gap_us = int(gap_seconds * 1_000_000)
    paired = with_pair(packets)
    runs = _runs(sliced(paired, slice_rows, max(1, int(cell_seconds * 1_000_000))), gap_us)
    return flow_features(_joined_runs(runs, gap_us), gaps=True)


def flows_in_session_windows(packets: DataFrame, gap_seconds: int) -> DataFrame:
    """The features that need no packet order, by session window; also runs on a stream."""
    windows = F.session_window(F.col("ts"), f"{gap_seconds} seconds")
    place = F.struct("us", "packet_id")
    first = [F.min_by("side", place).alias("opener")]
    first += [F.min_by("window", F.when(F.col("side") == s, place)).alias(f"win_{s}") for s in SIDES]
    merged = with_pair(packets).groupBy(*KEY, windows).agg(*first, *_packet_measures())
    return flow_features(merged, gaps=False)
