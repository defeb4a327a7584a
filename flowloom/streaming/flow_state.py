"""Finished flows of a packet stream with every feature, by arbitrary state per endpoint pair.

Packets wait in state until the watermark has passed them; then they are folded in
order into the record of the pair's open flow, a fixed number of sums. State is thus the packets of
the last `delay` and one record a pair, however long a flow lasts. A flow is given out once no
packet that still counts can belong to it. Packets that come after their place has been folded
are counted and not folded.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from flowloom.operators.packets import FLAGS, IDLE_GAP, KEY, SIDES, SUBFLOW_GAP, flow_features, with_pair

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PACKET = ["us", "packet_id", "side", "length", "header_length", "window", *FLAGS]
_COUNTED = [f"{m}_{s}" for s in SIDES for m in ("n", "data", "len", "hdr", "psh", "urg")] + FLAGS + ["breaks", "idle_n", "idle_sum", "active_n", "active_sum"]
_SQUARED = [*(f"lensq_{s}" for s in SIDES), "gap_sq", "gap_0_sq", "gap_1_sq", "idle_sq", "active_sq"]
_ENDS = [f"{m}_{s}" for s in SIDES for m in ("lenmin", "lenmax", "hdrmin", "first", "last", "win")] + [
    f"{m}_{e}" for m in ("gap", "gap_0", "gap_1", "idle", "active") for e in ("min", "max")] + ["first_us", "last_us", "opener", "tail_start"]
_RECORD = ", ".join([f"{c} bigint" for c in (*_COUNTED, *_ENDS)] + [f"{c} decimal(38,0)" for c in _SQUARED])


def _spread(flow: dict, name: str, value: int) -> None:
    """Square, least and greatest of a value."""
    flow[f"{name}_sq"] += value * value
    for end, pick in (("min", min), ("max", max)):
        old = flow[f"{name}_{end}"]
        flow[f"{name}_{end}"] = value if old is None else pick(old, value)


def _counted_spread(flow: dict, name: str, value: int) -> None:
    if value > 0:
        flow[f"{name}_n"] += 1
        flow[f"{name}_sum"] += value
        _spread(flow, name, value)


def opened(packet: dict) -> dict:
    """The record of a flow whose first packet this is."""
    flow = dict.fromkeys((*_COUNTED, *_SQUARED), 0) | dict.fromkeys(_ENDS)
    flow |= {"first_us": packet["us"], "opener": packet["side"], "tail_start": packet["us"]}
    return flow


def fold(flow: dict, p: dict) -> None:
    """Add the next packet of the flow, in the order of time and id."""
    us, s = p["us"], p["side"]
    if flow["last_us"] is not None:
        gap = us - flow["last_us"]
        _spread(flow, "gap", gap)
        flow["breaks"] += gap > SUBFLOW_GAP
        if gap > IDLE_GAP:
            _counted_spread(flow, "idle", gap)
            _counted_spread(flow, "active", flow["last_us"] - flow["tail_start"])
            flow["tail_start"] = us
    if flow[f"last_{s}"] is None:
        flow[f"first_{s}"], flow[f"win_{s}"] = us, p["window"]
    else:
        _spread(flow, f"gap_{s}", us - flow[f"last_{s}"])
    flow["last_us"] = flow[f"last_{s}"] = us
    for name, value in ((f"n_{s}", 1), (f"data_{s}", int(p["length"] > 0)), (f"len_{s}", p["length"]), (f"lensq_{s}", p["length"] ** 2),
                        (f"hdr_{s}", p["header_length"]), (f"psh_{s}", p["psh"]), (f"urg_{s}", p["urg"]), *((f, p[f]) for f in FLAGS)):
        flow[name] += value
    for name, value, pick in ((f"lenmin_{s}", p["length"], min), (f"lenmax_{s}", p["length"], max), (f"hdrmin_{s}", p["header_length"], min)):
        flow[name] = value if flow[name] is None else pick(flow[name], value)


class FlowState(StatefulProcessor):
    """Waiting packets, the open flow and the time up to which packets have been folded, for one endpoint pair."""

    def __init__(self, gap_us: int, id_type: str) -> None:
        self.gap_us, self.id_type = gap_us, id_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        kinds = {"packet_id": self.id_type}
        self.waiting = handle.getListState("waiting", ", ".join(f"{c} {kinds.get(c, 'bigint')}" for c in _PACKET))
        self.open = handle.getValueState("open", "record string, folded_to bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        new = [tuple(r) for part in rows for r in part[_PACKET].itertuples(index=False)]
        return self._advance(key, [tuple(v.item() if hasattr(v, "item") else v for v in r) for r in new], timerValues)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        return self._advance(key, [], timerValues)

    def _advance(self, key, new: list[tuple], timers: TimerValues) -> Iterator[pd.DataFrame]:
        passed = timers.getCurrentWatermarkInMs() * 1000
        record, folded_to = self.open.get() if self.open.exists() else (None, None)
        flow = json.loads(record) if record else None
        late = sum(1 for p in new if folded_to is not None and p[0] < folded_to)
        waiting = sorted([*(tuple(p) for p in self.waiting.get())] + [p for p in new if folded_to is None or p[0] >= folded_to], key=lambda p: p[:2])
        done, at = [], 0
        while at < len(waiting) and waiting[at][0] < passed:
            packet, at = dict(zip(_PACKET, waiting[at])), at + 1
            if flow and packet["us"] - flow["last_us"] > self.gap_us:
                done.append(flow)
                flow = None
            flow = flow or opened(packet)
            fold(flow, packet)
        rest = waiting[at:]
        if flow and flow["last_us"] + self.gap_us < passed:
            done.append(flow)
            flow = None
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        if rest:
            self.waiting.put(rest)
        else:
            self.waiting.clear()
        if rest or flow:
            # a pair that is done leaves no state; what comes for it later opens a new flow
            self.open.update((json.dumps(flow) if flow else None, max(passed, folded_to or passed)))
            due = [rest[0][0]] if rest else []
            due += [flow["last_us"] + self.gap_us] if flow else []
            self.handle.registerTimer(max(min(due) // 1000, timers.getCurrentWatermarkInMs()) + 1)
        else:
            self.open.clear()
        if done or late:
            columns = {c: [f[c] for f in done] + [None] * bool(late) for c in (*_COUNTED, *_ENDS)}
            squares = {c: [Decimal(f[c]) for f in done] + [None] * bool(late) for c in _SQUARED}
            n = len(done) + bool(late)
            keys = {k: [v] * n for k, v in zip(KEY, key)}
            frame = {k: pd.Series(v, dtype="Int64") for k, v in columns.items()} | {k: pd.Series(v, dtype=object) for k, v in squares.items()}
            yield pd.DataFrame(keys | {"late_packets": [0] * len(done) + [late] * bool(late)} | frame)

    def close(self) -> None:
        pass


def stream_all_features(packets: DataFrame, gap_seconds: float, delay: str = "10 minutes") -> DataFrame:
    """Finished flows of a packet stream with the features that `packets_to_flows` gives, and `late_packets`.

    Rows with `late_packets` above 0 have no features: they tell how many packets of a pair came too late to be folded.
    Packets that Spark itself finds behind the watermark are dropped before and counted in the progress of the query.
    Null times, endpoints' hosts and ports are as in the batch job, where packets without a time belong to no flow of the stream.
    """
    packets.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    paired = with_pair(packets.withWatermark("ts", delay)).where(F.col("us").isNotNull())
    kinds = {c: paired.schema[c].dataType.simpleString() for c in (*KEY, "packet_id")}
    measures = paired.select("ts", *KEY, *(F.col(c) if c == "packet_id" else F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in _PACKET))
    flows = measures.groupBy(*KEY).transformWithStateInPandas(
        FlowState(int(gap_seconds * 1_000_000), kinds["packet_id"]), ", ".join(f"{k} {kinds[k]}" for k in KEY) + f", late_packets bigint, {_RECORD}", "append", "eventTime")
    return flow_features(flows, gaps=True, keep=["late_packets"])
