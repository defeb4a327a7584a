import math
import random
import statistics
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from flowloom.contracts import FEATURES_71
from flowloom.operators import packets
from flowloom.operators.packets import FLAGS, flows_in_session_windows, packets_to_flows
from flowloom.streaming.flow_state import stream_all_features
from flowloom.streaming.live import run_available, stream_flows

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = (
    "src string, src_port int, dst string, dst_port int, protocol int, ts timestamp, length long, header_length long, "
    "packet_id long, window int, " + ", ".join(f"{f} int" for f in FLAGS)
)


def make(n, seed, pairs=3):
    """Packets of a few pairs, one of them with most of the traffic, on a coarse clock so that times repeat."""
    rng = random.Random(seed)
    rows, clock = [], 0
    for i in range(n):
        clock += rng.choice([0, 1, 2, 5, 9, 40])
        pair = 0 if rng.random() < 0.7 else rng.randrange(pairs)
        ends = [(f"h{pair}", 1000), ("s", 443)]
        if rng.random() < 0.5:
            ends.reverse()
        flags = [int(rng.random() < 0.3) for _ in FLAGS]
        rows.append((*ends[0], *ends[1], 6, START + timedelta(seconds=clock), rng.choice([0, 40, 1500]), 20 + i % 5, i, i % 9, *flags))
    return rows


def brute(rows, gap):
    """Flows by walking all packets of a pair in order."""
    by_pair = {}
    for r in rows:
        by_pair.setdefault(tuple(sorted([f"{r[0]}:{r[1]}", f"{r[2]}:{r[3]}"])), []).append(r)
    out = {}
    for pair, packets in by_pair.items():
        packets.sort(key=lambda r: (r[5], r[8]))
        runs = []
        for r in packets:
            if runs and (r[5] - runs[-1][-1][5]).total_seconds() <= gap:
                runs[-1].append(r)
            else:
                runs.append([r])
        for run in runs:
            us = [int((r[5] - START).total_seconds() * 1e6) for r in run]
            fwd = [r[0] == run[0][0] for r in run]
            f_us, f_len = [u for u, f in zip(us, fwd) if f], [r[6] for r, f in zip(run, fwd) if f]
            gaps, f_gaps = [b - a for a, b in zip(us, us[1:])], [b - a for a, b in zip(f_us, f_us[1:])]

            idle, breaks = [g for g in gaps if g > 5_000_000], sum(g > 1_000_000 for g in gaps)

            phases = [[us[0], us[0]]]
            for u, g in zip(us[1:], gaps):
                if g > 5_000_000:
                    phases.append([u, u])
                phases[-1][1] = u
            active = [b - a for a, b in phases if b > a]

            def sd(x):
                return statistics.stdev(x) if len(x) > 1 else 0.0

            out[pair[0], us[0]] = {
                "Flow Duration": us[-1] - us[0], "Total Fwd Packet": len(f_us), "Total Bwd packets": len(us) - len(f_us),
                "Total Length of Fwd Packet": sum(f_len), "Fwd Packet Length Max": max(f_len), "Fwd Packet Length Std": sd(f_len),
                "Packet Length Std": sd([r[6] for r in run]), "Flow IAT Std": sd(gaps), "Flow IAT Max": max(gaps, default=0),
                "Flow IAT Min": min(gaps, default=0), "Fwd IAT Std": sd(f_gaps), "Fwd IAT Max": max(f_gaps, default=0),
                "Fwd IAT Min": min(f_gaps, default=0), "Fwd IAT Total": sum(f_gaps), "SYN Flag Count": sum(r[11] for r in run),
                "Fwd PSH Flags": sum(r[13] for r, f in zip(run, fwd) if f), "Fwd Act Data Pkts": sum(x > 0 for x in f_len),
                "Fwd Seg Size Min": min(r[7] for r, f in zip(run, fwd) if f), "FWD Init Win Bytes": run[0][9],
                "Bwd Init Win Bytes": next((r[9] for r, f in zip(run, fwd) if not f), 0),
                "Active Mean": statistics.fmean(active) if active else 0.0, "Active Std": sd(active),
                "Active Max": max(active, default=0), "Active Min": min(active, default=0),
                "Idle Mean": statistics.fmean(idle) if idle else 0.0, "Idle Std": sd(idle), "Idle Max": max(idle, default=0),
                "Idle Min": min(idle, default=0), "Subflow Fwd Bytes": sum(f_len) // breaks if breaks else 0,
                "Subflow Bwd Packets": (len(us) - len(f_us)) // breaks if breaks else 0,
            }
    return out


@pytest.mark.parametrize("slice_rows", [7, 60, 100_000])
def test_flows_match_a_plain_walk_for_any_slice(spark, slice_rows):
    rows = make(600, seed=slice_rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    expected = brute(rows, 30)
    start_us = int(START.timestamp() * 1e6)
    got = {(r["endpoint_a"], r["_us"] - start_us): r for r in
           packets_to_flows(df, 30, slice_rows).withColumn("_us", F.unix_micros("flow_start")).collect()}
    assert set(got) == set(expected)
    assert not set(FEATURES_71) - set(next(iter(got.values())).asDict())
    for key, cells in expected.items():
        for name, value in cells.items():
            assert math.isclose(got[key][name], value, rel_tol=1e-9, abs_tol=1e-6), (key, name, got[key][name], value)


def hot(n):
    """Nearly all packets belong to one pair, a third of those to one second and a quarter of those to one microsecond."""
    rows = make(n, seed=3)
    for i, r in enumerate(rows):
        if i % 20:
            ends = [("h0", 1000), ("s", 443)]
            at = START + timedelta(seconds=50) if i % 12 == 1 else START + timedelta(seconds=50, microseconds=i % 997) if i % 3 == 1 else r[5]
            rows[i] = (*ends[i % 2], *ends[1 - i % 2], 6, at, *r[6:])
    return rows


@pytest.mark.parametrize(("slice_rows", "cell_seconds"), [(40, 60), (40, 0.01), (200, 3600), (3, 60)])
def test_slices_of_a_busy_pair_are_bounded_and_in_order(spark, slice_rows, cell_seconds):
    df = spark.createDataFrame(hot(900), SCHEMA).repartition(4)
    paired = packets.with_pair(df)
    cut = packets.sliced(paired, slice_rows, int(cell_seconds * 1e6)).select("endpoint_a", "slice", "us", "packet_id").collect()
    assert len(cut) == 900
    sizes, pair = {}, sorted((r.us, r.packet_id, r.slice) for r in cut if r.endpoint_a == "h0:1000")
    for r in cut:
        sizes[r.endpoint_a, r.slice] = sizes.get((r.endpoint_a, r.slice), 0) + 1
    assert max(sizes.values()) <= slice_rows and len(pair) > 800
    assert [s for *_, s in pair] == sorted(s for *_, s in pair)
    assert len(sizes) <= 4 * 900 // slice_rows + 3


def test_flows_of_a_busy_pair_are_those_of_a_plain_walk(spark):
    rows = hot(900)
    expected = brute(rows, 30)
    start_us = int(START.timestamp() * 1e6)
    df = spark.createDataFrame(rows, SCHEMA)
    named = df.withColumn("packet_id", F.format_string("%09d", "packet_id"))  # ids that are no numbers
    for given in (df, named):
        got = {(r["endpoint_a"], r["_us"] - start_us): r for r in packets_to_flows(given, 30, 40).withColumn("_us", F.unix_micros("flow_start")).collect()}
        assert set(got) == set(expected)
        for key, cells in expected.items():
            for name, value in cells.items():
                assert math.isclose(got[key][name], value, rel_tol=1e-9, abs_tol=1e-6), (key, name, got[key][name], value)


def test_gap_of_exactly_the_limit_stays_one_flow(spark):
    base = ("a", 1, "b", 2, 6)
    tail = (10, 20, 0, 0, *[0] * 8)
    rows = [(*base, START + timedelta(seconds=s), *tail) for s in (0, 10, 21)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert packets_to_flows(df, 10, 4).count() == 2
    assert flows_in_session_windows(df, 10).count() == 2
    lone = packets_to_flows(df.limit(1), 10).first()
    assert lone["Flow Bytes/s"] == math.inf and lone["Flow IAT Std"] == 0.0


def test_stream_equals_batch_and_drops_late_rows(spark, tmp_path):
    rows = make(400, seed=2)
    rows.sort(key=lambda r: r[5])
    third = len(rows) // 3
    late = list(rows[0])
    late[5], late[8] = START - timedelta(hours=5), 9999
    source = str(tmp_path / "in")
    order = [rows[:third], rows[third : 2 * third], [*rows[2 * third :], tuple(late)]]
    for i, part in enumerate(order):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = stream_flows(spark.readStream.schema(SCHEMA).parquet(source), 30, "1 minute")
        run_available(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))
    batch = flows_in_session_windows(spark.createDataFrame(rows, SCHEMA), 30)
    horizon = rows[-1][5] - timedelta(minutes=1)
    done = batch.where(F.timestamp_micros(F.unix_micros("flow_start") + F.col("Flow Duration") + 30_000_000) <= F.lit(horizon))
    assert got.exceptAll(done).isEmpty() and done.exceptAll(got).isEmpty()
    assert 0 < got.count() < batch.count()


def test_stream_gives_every_feature_of_the_batch(spark, tmp_path):
    rows = make(300, seed=6)
    rows.sort(key=lambda r: r[5])
    rng = random.Random(1)
    third = len(rows) // 3
    mixed = sorted(rows, key=lambda r: (r[5] + timedelta(seconds=rng.randrange(50))))  # out of order, within the delay
    late = (*rows[0][:5], START - timedelta(hours=5), *rows[0][6:8], 9999, *rows[0][9:])
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    for part in ([*mixed[:third]], mixed[third : 2 * third], [*mixed[2 * third :], late]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = stream_all_features(spark.readStream.schema(SCHEMA).parquet(source), 30, "1 minute")
        run_available(stream, str(tmp_path / "out"), state).awaitTermination()
    got = spark.read.schema(stream.schema).parquet(str(tmp_path / "out")).where("late_packets = 0").drop("late_packets")
    batch = packets_to_flows(spark.createDataFrame(rows, SCHEMA), 30)
    horizon = rows[-1][5] - timedelta(minutes=1)
    done = batch.where(F.timestamp_micros(F.unix_micros("flow_start") + F.col("Flow Duration") + 30_000_000) < F.lit(horizon))
    got = got.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in batch.schema])
    assert got.exceptAll(done).isEmpty() and done.exceptAll(got).isEmpty()
    assert 10 < got.count() < batch.count() and set(got.columns) >= set(FEATURES_71)
