import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowloom.contracts import FEATURES_46
from flowloom.functions import numeric, to_places
from flowloom.operators import cleaning, conversion, shift
from flowloom.operators.quantiles import exact_quantiles

INF, NAN = math.inf, math.nan


@pytest.fixture(scope="module")
def dirty(spark):
    rows = [("a", 1.0, INF), ("b", 2.0, None), ("c", None, -INF), ("d", NAN, 4.0), ("e", 5.0, 8.0)]
    return spark.createDataFrame(rows, "row_key string, x double, `Flow Bytes/s` double")


def test_report_counts_inf_and_missing_apart(dirty):
    got = {r.feature: (r.inf_count, r.nan_count, r.nan_pct) for r in cleaning.inf_nan_report(dirty, ["x", "Flow Bytes/s", "gone"]).collect()}
    assert got == {"x": (0, 2, 40.0), "Flow Bytes/s": (2, 1, 20.0)}
    assert cleaning.inf_nan_report(dirty, ["gone"]).isEmpty()
    total = cleaning.inf_nan_summary(dirty, ["x", "Flow Bytes/s"]).first()
    assert (total.total_rows, total.total_inf_cells, total.total_nan_cells, total.columns_affected_inf) == (5, 2, 3, 1)


def test_fill_strategies(dirty):
    names = ["x", "Flow Bytes/s", "gone"]
    assert cleaning.fit_fill(dirty, names) == {"x": 2.0, "Flow Bytes/s": 6.0, "gone": 0.0}
    assert cleaning.fit_fill(dirty, names, "mean") == {"x": 8 / 3, "Flow Bytes/s": 6.0, "gone": 0.0}
    assert cleaning.fit_fill(dirty, names, "zero") == {"x": 0.0, "Flow Bytes/s": 0.0, "gone": 0.0}
    with pytest.raises(ValueError):
        cleaning.fit_fill(dirty, names, "mode")


def test_inference_clean_checks_and_fills(dirty):
    got = cleaning.inference_clean(dirty, ["Flow Bytes/s", "x"], {"x": 7.0, "Flow Bytes/s": 6.0}, ["row_key"])
    assert got.columns == ["row_key", "Flow Bytes/s", "x"]
    assert [tuple(r)[1:] for r in got.orderBy("row_key").collect()] == [(6.0, 1.0), (6.0, 2.0), (6.0, 7.0), (4.0, 7.0), (8.0, 5.0)]
    with pytest.raises(ValueError, match="Idle Min"):
        cleaning.inference_clean(dirty, ["x", "Idle Min"], {})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0), (4.0, 3.0)], "x double, c double")
    fitted = {r.feature: (r.mean, r.std) for r in cleaning.fit_scaler(df, ["x", "c"]).collect()}
    assert fitted["x"][1] == pytest.approx(np.std([1, 2, 4])) and fitted["c"] == (3.0, 1.0)
    scaled = cleaning.apply_scaler(df, cleaning.fit_scaler(df, ["x", "c"])).toPandas()
    assert scaled["x"].mean() == pytest.approx(0) and set(scaled["c"]) == {0.0}


def test_constant_columns_are_dropped_everywhere(spark):
    train = spark.createDataFrame([(1.0, 2.0, None), (1.0, 3.0, None)], "a double, b double, n double")
    test = spark.createDataFrame([(5.0, 2.0, 1.0)], "a double, b double, n double")
    kept, (left, right) = cleaning.drop_constant(train, ["a", "b", "n"], test)
    assert kept == ["b"] and left.columns == right.columns == ["b"]


def test_params_round_trip_and_both_spellings(tmp_path):
    cleaning.save_params(tmp_path / "p.json", ["a", "b"], {"a": 1.5, "b": 0.0}, "median")
    assert cleaning.load_params(tmp_path / "p.json") == {"features": ["a", "b"], "fills": {"a": 1.5, "b": 0.0}, "strategy": "median"}
    (tmp_path / "q.json").write_text(json.dumps({"nan_fill_values": {"a": 2}, "feature_names": ["a"]}))
    assert cleaning.load_params(tmp_path / "q.json")["fills"] == {"a": 2}
    (tmp_path / "r.json").write_text("{}")
    with pytest.raises(ValueError):
        cleaning.load_params(tmp_path / "r.json")


@pytest.mark.parametrize("settle_rows", [10_000_000, 500, 1])
def test_quantiles_are_exact_with_and_without_narrowing(spark, settle_rows):
    rng = np.random.default_rng(3)
    n = 20_000
    hot = np.where(rng.random(n) < 0.4, 5.0, rng.normal(5, 1, n))  # one value holds two fifths of the rows
    data = {"wide": rng.lognormal(0, 5, n), "hot": hot, "few": rng.integers(0, 3, n).astype(float)}
    rows = list(zip(*[v.tolist() for v in data.values()]))
    df = spark.createDataFrame(rows, "wide double, hot double, few double").repartition(5)
    probs = [0.0, 0.5, 0.95, 1.0]
    got = exact_quantiles(df, list(data), probs, settle_rows=settle_rows, accuracy=200)
    for name, values in data.items():
        assert got[name] == pytest.approx(np.percentile(values, [100 * p for p in probs]).tolist(), rel=1e-13)


def test_quantiles_skip_dirty_cells_and_empty_columns(spark):
    df = spark.createDataFrame([(INF, None), (1.0, None), (NAN, None), (4.0, None)], "x double, e double")
    assert exact_quantiles(df, ["x", "e"], [0.5]) == {"x": [2.5], "e": [None]}


def test_conversion_formulas(spark):
    cells = {
        "Protocol": 17.0, "Flow Duration": 2e6, "Total Fwd Packets": 4.0, "Total Backward Packets": 2.0,
        "Fwd Packets Length Total": 100.0, "Bwd Packets Length Total": -50.0, "Fwd Header Length": 80.0,
        "FIN Flag Count": 1.0, "SYN Flag Count": -1.0, "RST Flag Count": 0.0, "PSH Flag Count": 2.0, "ACK Flag Count": 3.0,
        "URG Flag Count": 0.0, "ECE Flag Count": 0.0, "CWE Flag Count": 5.0, "Packet Length Min": 1.0,
        "Packet Length Max": 9.0, "Packet Length Mean": 5.0, "Packet Length Std": 2.0, "Packet Length Variance": None,
        "Fwd Packet Length Mean": 3.0, "Bwd Packet Length Mean": 4.0, "Fwd Packet Length Std": None,
        "Bwd Packet Length Std": 2.0, "Flow IAT Mean": NAN,
    }
    df = spark.createDataFrame([tuple(cells.values())], ", ".join(f"`{c}` double" for c in cells))
    row = conversion.to_46_features(df).first()
    assert list(row.asDict()) == FEATURES_46
    expect = {
        "flow_duration": 2.0, "Header_Length": 20.0, "Rate": 3.0, "Srate": 2.0, "Drate": 1.0, "UDP": 1.0, "TCP": 0.0,
        "Tot sum": 100.0, "syn_count": 0.0, "cwr_flag_number": 5.0, "Magnitue": 5.0, "IAT": 0.0, "Number": 6.0, "IPv": 4.0,
        "Radius": np.float32(math.sqrt(2.0)), "Variance": None,
    }
    assert {k: row[k] for k in expect} == expect
    assert conversion.prepare_2018(df).first()["Variance"] == 0.0


def test_numbers_from_text(spark):
    cells = ["1", " -2.5e1 ", ".5", "5.", "1f", "0x1", "1_0", "", "nan", "+Inf", "-INFINITY", None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, t string")
    got = [r.v for r in df.select("i", numeric(F.col("t")).alias("v")).orderBy("i").collect()]
    assert got == [1.0, -25.0, 0.5, 5.0, None, None, None, None, None, INF, -INF, None]


def test_places_match_array_rounding(spark):
    values = [0.06445, 0.00005, 0.285, 1 / 3, 0.99995, 0.12345]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(to_places(F.col("v"), 4).alias("r"))
    assert [r.r for r in df.collect()] == np.round(values, 4).tolist()


def test_shift_severity_levels(spark):
    rows = [("a", 11.0), ("b", 4.0), ("c", 6.0), ("d", 0.05), ("e", 0.3), ("f", 1.0), ("g", None), ("h", 0.0)]
    got = {r.feature: (r.severity, r.counted) for r in shift.shift_severity(spark.createDataFrame(rows, "feature string, ratio double")).collect()}
    assert got == {
        "a": ("strong", 1), "b": ("moderate", 0), "c": ("moderate", 1), "d": ("strong", 1), "e": ("moderate", 0),
        "f": ("none", 0), "g": ("none", 0), "h": ("strong", 0),
    }


def test_top_features_from_either_shape(tmp_path):
    (tmp_path / "a.json").write_text('{"Feature": ["x", "y"], "Importance": [1, 2]}')
    (tmp_path / "b.json").write_text('{"x": 3, "y": 2}')
    assert shift.load_top_features(tmp_path / "a.json", 1) == ["y"]
    assert shift.load_top_features(tmp_path / "b.json") == ["x", "y"]
    assert len(shift.load_top_features(tmp_path / "none.json")) == 15


def test_fraction_fills_whole_number_columns_without_loss(spark):
    df = spark.createDataFrame([(1, 1), (None, None)], "a int, b int")
    got = cleaning.apply_fill(df, {"a": 2.5, "b": 3.0})
    assert dict(got.dtypes) == {"a": "double", "b": "int"} and [tuple(r) for r in got.collect()] == [(1.0, 1), (2.5, 3)]
