import math

import pytest
from pyspark.sql import functions as F

from flowloom.contracts import FEATURES_46, FEATURES_71, RENAMES_2017, contract_problems, load_contract
from flowloom.operators import schema
from flowloom.sources import flow_csv
from flowloom.sources.reports import write_report

HEADER = "Flow ID, Src IP,Flow Bytes/s, Flow Duration,Label"
KNOWN = ["DoS\\DoS-TCP_Flood\\b.csv"]


@pytest.fixture
def root(tmp_path):
    files = {
        "Benign/a.csv": HEADER + "\n" + "\n".join(
            f"id{i},1.2.3.4,{cell},{i},x" for i, cell in enumerate(["Infinity", "NaN", "abc", "", "1e39", "1d", " 7.5"])
        ),
        "DoS/DoS-TCP_Flood/b.csv": "id,1.1.1.1,5,6,y\nid,1.1.1.1,7,8,y\n",
        "Recon/c.csv": "id,1.1.1.1,5,6,y\n",
        "Recon/empty.csv": "",
        "Web/d.csv": "Flow ID,Extra,Flow Bytes/s,Label\nid,9,3.5,z\n",
        "Web/name with space+.csv": HEADER + "\nid,1.1.1.1,1,2,z\n",
    }
    for name, text in files.items():
        path = tmp_path / "raw" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
    return str(tmp_path / "raw")


def test_inventory_flags_headers_and_suspicious_files(spark, root):
    rows = {r.source_relative_file: r for r in flow_csv.file_inventory(spark, root, KNOWN).collect()}
    assert set(rows) == {
        "Benign/a.csv", "DoS/DoS-TCP_Flood/b.csv", "Recon/c.csv", "Recon/empty.csv", "Web/d.csv", "Web/name with space+.csv",
    }
    assert rows["Benign/a.csv"].has_header and rows["Benign/a.csv"].columns == 5
    assert rows["DoS/DoS-TCP_Flood/b.csv"].known_headerless and not rows["DoS/DoS-TCP_Flood/b.csv"].suspicious
    assert rows["Recon/c.csv"].suspicious and rows["Recon/c.csv"].has_header is False
    assert rows["Recon/empty.csv"].suspicious and rows["Recon/empty.csv"].has_header is None
    assert rows["Recon/empty.csv"].columns == 0
    assert rows["DoS/DoS-TCP_Flood/b.csv"].source_class_folder == "DoS"


def test_long_first_line_is_read_to_its_end(spark, tmp_path):
    folder = tmp_path / "Wide"
    folder.mkdir()
    names = ["Flow ID"] + [f"column number {i}" for i in range(9000)]
    (folder / "w.csv").write_text(",".join(names) + "\n" + ",".join("1" for _ in names) + "\n")
    assert flow_csv.file_inventory(spark, str(tmp_path), []).first().columns == 9001


def test_rollup_counts_problems(spark, root):
    rows = {r.source_class_folder: r for r in flow_csv.class_rollup(flow_csv.file_inventory(spark, root, KNOWN)).collect()}
    assert (rows["Recon"].files, rows["Recon"].suspicious) == (2, 2)
    assert (rows["DoS"].known_headerless, rows["DoS"].suspicious) == (1, 0)


def test_canonical_columns_come_from_first_good_file(spark, root):
    inventory = flow_csv.file_inventory(spark, root, KNOWN)
    assert flow_csv.canonical_columns(inventory) == ["Flow ID", "Src IP", "Flow Bytes/s", "Flow Duration", "Label"]
    with pytest.raises(RuntimeError):
        flow_csv.canonical_columns(inventory.where("source_class_folder = 'Recon'"))


def test_read_aligns_repairs_and_converts(spark, root):
    raw = flow_csv.read_flow_csv(spark, root, known_headerless=KNOWN, on_suspicious="null")
    done = flow_csv.compact(raw, "demo")
    assert "Src IP" not in done.columns and "Label" not in done.columns and "Extra" not in done.columns
    assert dict(done.dtypes)["Flow Bytes/s"] == "float" and dict(done.dtypes)["target_binary"] == "tinyint"
    rows = done.collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(r.source_relative_file, []).append(r)
    a = {r["Flow Duration"]: r["Flow Bytes/s"] for r in by_file["Benign/a.csv"]}
    assert a[0.0] == math.inf and a[1.0] is None and a[2.0] is None and a[3.0] is None
    assert a[4.0] == math.inf and a[5.0] is None and a[6.0] == 7.5
    assert sorted(r["Flow Bytes/s"] for r in by_file["DoS/DoS-TCP_Flood/b.csv"]) == [5.0, 7.0]
    assert by_file["Web/d.csv"][0]["Flow Duration"] is None and by_file["Web/d.csv"][0]["Flow Bytes/s"] == 3.5
    assert by_file["Web/name with space+.csv"][0]["Flow Duration"] == 2.0
    assert {r.target_binary for r in by_file["Benign/a.csv"]} == {0} and by_file["Web/d.csv"][0].target_binary == 1
    assert by_file["Web/d.csv"][0].raw_stage2_label == "Web" and by_file["Web/d.csv"][0].source_dataset == "demo"


def test_suspicious_files_are_an_error_unless_told(spark, root):
    with pytest.raises(RuntimeError, match="Recon/c.csv"):
        flow_csv.read_flow_csv(spark, root, known_headerless=KNOWN)
    rows = {how: flow_csv.read_flow_csv(spark, root, known_headerless=KNOWN, on_suspicious=how).where("source_relative_file = 'Recon/c.csv'").collect()
            for how in ("skip", "null", "positional")}
    assert rows["skip"] == [] and len(rows["positional"]) == len(rows["null"]) + 1
    assert all(r["Flow Bytes/s"] is None for r in rows["null"]) and any(r["Flow Bytes/s"] for r in rows["positional"])


def test_lineage_starts_at_a_whole_folder_name(spark):
    paths = spark.createDataFrame([("file:/srv/draw/x/raw/DoS/a.csv",), ("file:/data/raw/DoS/a.csv",)], "p string")
    got = [r[0] for r in paths.select(flow_csv.lineage("x/raw", F.col("p"))["source_relative_file"]).collect()]
    assert got[0] == "DoS/a.csv"
    assert paths.select(flow_csv.lineage("raw", F.col("p"))["source_class_folder"]).first()[0] == "DoS"


def test_store_names_and_factories(tmp_path):
    from pyarrow import fs

    from flowloom.sources import files

    files.register_filesystem("demo", lambda uri: (fs.LocalFileSystem(), str(tmp_path / uri.split("://")[1])))
    files.write_text("demo://x.txt", "hello")
    assert (tmp_path / "x.txt").read_text() == "hello" and files.read_text("demo://x.txt") == "hello"
    assert files.locate("s3a://bucket/key?region=eu-west-1")[1] == "bucket/key"


def test_compact_write_gives_manifest_of_written_rows(spark, root, tmp_path):
    raw = flow_csv.read_flow_csv(spark, root, known_headerless=KNOWN, on_suspicious="null")
    out = str(tmp_path / "compact")
    manifest = flow_csv.write_compact(flow_csv.compact(raw, "demo"), out)
    counts = {r.source_relative_file: r.rows_written for r in manifest.collect()}
    assert counts["Benign/a.csv"] == 7 and counts["DoS/DoS-TCP_Flood/b.csv"] == 2
    plan = spark.read.parquet(out).where("source_class_folder = 'Web'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(source_class_folder" in plan


def test_tolerant_read_handles_repeats_long_lines_and_latin1(spark, tmp_path):
    folder = tmp_path / "in" / "mix"
    folder.mkdir(parents=True)
    head = " Fwd Header Length, Total Fwd Packets, Fwd Header Length, Label\n"
    body = b"1,2,3,Web Attack \x96 XSS\n4,5,6,ok,EXTRA\n7,8\n"
    (folder / "latin.csv").write_bytes(head.encode() + body)
    (folder / "utf.csv").write_text(head + "9,9,9,Grün\n", encoding="utf-8")
    columns = ["Fwd Header Length", "Total Fwd Packets", "Label"]
    rows = flow_csv.read_flow_csv(spark, str(tmp_path / "in"), columns, [], tolerant=True)
    got = {(r["Fwd Header Length"], r["Total Fwd Packets"], r["Label"]) for r in rows.collect()}
    assert got == {("1", "2", "Web Attack \x96 XSS"), ("7", "8", None), ("9", "9", "Grün")}


def test_encoding_is_decided_by_line_and_variants_may_be_many(spark, tmp_path):
    folder = tmp_path / "in" / "mix"
    folder.mkdir(parents=True)
    (folder / "both.csv").write_bytes("Flow ID,Label\r\n1,Grün\r\n".encode() + b"2,caf\xe9\r\n\n3,\"a,b\"\n")
    for i in range(40):  # as many headers as files
        names = [f"x{j}" for j in range(i)] + [" Flow ID", "Label "] + [f"z{i}"]
        (folder / f"v{i}.csv").write_text(",".join(names) + "\n" + ",".join(["0"] * i + [str(100 + i), f"l{i}", "9"]) + "\n")
    rows = flow_csv.read_flow_csv(spark, str(tmp_path / "in"), ["Label", "Flow ID", "Nope"], [], tolerant=True).collect()
    got = {r["Flow ID"]: r["Label"] for r in rows}
    assert got == {"1": "Grün", "2": "café", "3": "a,b"} | {str(100 + i): f"l{i}" for i in range(40)} and len(rows) == 43
    assert {r["Nope"] for r in rows} == {None} and {r.source_class_folder for r in rows} == {"mix"}
    strict = flow_csv.read_flow_csv(spark, str(tmp_path / "in"), ["Flow ID", "Label"], [])
    assert strict.where("`Flow ID` = '2'").first().Label == "caf\ufffd"


def test_parquet_is_preferred(spark, root, tmp_path):
    folder = str(tmp_path / "both")
    spark.range(3).write.parquet(folder + "/p")
    assert flow_csv.read_preferred(spark, folder).count() == 3
    assert flow_csv.read_preferred(spark, root, lambda s, r: flow_csv.read_flow_csv(s, r, known_headerless=KNOWN, on_suspicious="null")).count() == 11
    base = str(tmp_path / "base")
    spark.range(2).write.parquet(base)
    assert flow_csv.first_existing(spark, str(tmp_path / "augmented"), base).count() == 2
    (tmp_path / "broken").mkdir()
    with pytest.raises(Exception, match="(?i)schema"):
        flow_csv.first_existing(spark, str(tmp_path / "broken"), base)


def test_foreign_alignment_names_missing_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "`Min Packet Length` double, `Max Packet Length` double")
    got = schema.align_foreign(df, RENAMES_2017, ["Packet Length Max", "Packet Length Min"])
    assert got.columns == ["Packet Length Max", "Packet Length Min"] and got.first()[0] == 2.0
    with pytest.raises(ValueError, match="Idle Min"):
        schema.align_foreign(df, RENAMES_2017, ["Packet Length Max", "Idle Min"])
    present, absent = schema.align_present(df, ["Min Packet Length", "Nope"])
    assert present.columns == ["Min Packet Length"] and absent == ["Nope"]
    assert schema.strip_names(spark.createDataFrame([(1,)], "` a ` int")).columns == ["a"]


def test_contracts(tmp_path):
    assert len(FEATURES_71) == len(set(FEATURES_71)) == 71 and len(FEATURES_46) == len(set(FEATURES_46)) == 46
    (tmp_path / "c.json").write_text('["a", "a", "target_binary"]')
    names = load_contract(tmp_path / "c.json")
    assert contract_problems(names) == {"duplicates": ["a"], "meta": ["target_binary"]}
    (tmp_path / "bad.json").write_text('{"a": 1}')
    with pytest.raises(ValueError):
        load_contract(tmp_path / "bad.json")
    with pytest.raises(FileNotFoundError):
        load_contract(tmp_path / "none.json")


def test_report_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    for fmt in ("json", "csv", "parquet"):
        write_report(df, str(tmp_path / fmt), fmt)
    text = next((tmp_path / "csv").glob("part-*")).read_bytes()
    assert text.startswith(b"\xef\xbb\xbfk,v")
    with pytest.raises(ValueError):
        write_report(df, str(tmp_path / "x"), "xml")
