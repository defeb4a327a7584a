"""Flow-shaped views of the test tables (see FIXTURES.md for their definition)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CLASS_OF_TYPE = {
    "STANDARD": "Benign", "ECONOMY": "DoS", "LARGE": "DDoS",
    "MEDIUM": "Recon", "PROMO": "Mirai", "SMALL": "Spoofing",
}
LABEL_OF_TYPE = {
    "STANDARD": "Benign", "ECONOMY": "DoS attacks-Hulk", "LARGE": "DDOS attack-HOIC",
    "MEDIUM": "Infilteration", "PROMO": "Bot", "SMALL": "SQL Injection",
}
FEATURES = ["Flow Duration", "Total Length of Fwd Packet", "Flow Bytes/s", "Flow IAT Mean", "Bwd URG Flags"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lookup(names: dict[str, str], key: str):
    return F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[F.col(key)]


def _line_key():
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    return F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", cents)


def _rate():
    return F.when(F.col("l_tax") == 0, F.lit(float("inf"))).otherwise(F.col("l_extendedprice") / F.col("l_tax"))


def _gap():
    return F.when(F.col("l_discount") != 0, F.col("l_discount") * F.col("l_quantity"))


def _lines(spark: SparkSession, sf_dir: str, join: str | None = None) -> DataFrame:
    """Line items with their part; the brand, which names the file, is one for one family and one of two for another.

    `join` is a hint how to join: Spark's estimate of the pruned, compressed part table can be far below the size of its keys on the driver.
    """
    odd = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int") % 2 == 1
    brand = F.when(F.col("p_type") == "PROMO", "Brand#11").when(F.col("p_type") == "SMALL", F.when(odd, "Brand#11").otherwise("Brand#12"))
    part = table(spark, sf_dir, "part").select("p_partkey", F.coalesce(brand, "p_brand").alias("p_brand"), "p_type")
    return table(spark, sf_dir, "lineitem").join(part.hint(join) if join else part, F.col("l_partkey") == F.col("p_partkey"))


def flows(spark: SparkSession, sf_dir: str, join: str | None = None) -> DataFrame:
    family = _lookup(CLASS_OF_TYPE, "p_type")
    return _lines(spark, sf_dir, join).select(
        _line_key().alias("row_key"),
        family.alias("source_class_folder"),
        F.concat_ws("/", family, "p_brand").alias("source_relative_file"),
        F.col("p_brand").alias("source_file_name"),
        (family != "Benign").cast("int").alias("target_binary"),
        F.col("l_quantity").alias("Flow Duration"),
        F.col("l_extendedprice").alias("Total Length of Fwd Packet"),
        _rate().alias("Flow Bytes/s"),
        _gap().alias("Flow IAT Mean"),
        F.lit(0.0).alias("Bwd URG Flags"),
    )


def raw_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow cells as text, with the dirt that real files hold."""
    n = F.col("l_linenumber")
    cell = F.col("l_extendedprice").cast("string")
    for value, line in (("abc", 1), ("", 2), ("Infinity", 3), ("1d", 4), ("1e39", 5), (" -inf ", 6)):
        cell = F.when(n == line, value).otherwise(cell)
    return table(spark, sf_dir, "lineitem").select(
        _line_key().alias("row_key"), F.col("l_quantity").cast("string").alias("Flow Duration"), cell.alias("Flow Bytes/s")
    )


def foreign_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows under the 2018 column names."""
    n, quantity, price = F.col("l_linenumber"), F.col("l_quantity"), F.col("l_extendedprice")
    tax, discount = F.col("l_tax"), F.col("l_discount")

    def flag(condition):
        return condition.cast("int")

    returned, status = F.col("l_returnflag"), F.col("l_linestatus")
    return _lines(spark, sf_dir).select(
        _line_key().alias("row_key"),
        _lookup(LABEL_OF_TYPE, "p_type").alias("Label"),
        (quantity / 50).alias("given_score"),
        F.when(n % 4 == 0, 6).when(n % 4 == 1, 17).when(n % 4 == 2, 1).alias("Protocol"),
        (quantity * 1000 - 2000).alias("Flow Duration"),
        (n - 1).alias("Total Fwd Packets"),
        (n % 3).alias("Total Backward Packets"),
        price.alias("Fwd Packets Length Total"),
        (price * discount).alias("Bwd Packets Length Total"),
        (n * 20).alias("Fwd Header Length"),
        flag(returned == "A").alias("FIN Flag Count"), flag(status == "F").alias("SYN Flag Count"),
        flag(returned == "R").alias("RST Flag Count"), flag(status == "O").alias("PSH Flag Count"),
        n.alias("ACK Flag Count"), F.lit(0).alias("URG Flag Count"), F.lit(-1).alias("ECE Flag Count"),
        (n % 2).alias("CWE Flag Count"),
        (discount * 100 - 1).alias("Packet Length Min"), (quantity * 30).alias("Packet Length Max"),
        (quantity * 10).alias("Packet Length Mean"), (tax * 100).alias("Packet Length Std"),
        (tax * 100 * tax).alias("Packet Length Variance"),
        F.when(discount != 0, price / quantity).alias("Fwd Packet Length Mean"),
        quantity.alias("Bwd Packet Length Mean"),
        (tax * 10).alias("Fwd Packet Length Std"), (discount * 10).alias("Bwd Packet Length Std"),
        _gap().alias("Flow IAT Mean"), _rate().alias("Flow Bytes/s"),
    )


def raw_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order priorities in mixed spelling, with a row split."""
    k, text = F.col("o_orderkey"), F.col("o_orderpriority")
    low = F.lower(text)
    spelled = F.when(k % 3 == 0, F.concat(F.lit("  "), low, F.lit(" "))).when(k % 3 == 1, text)
    split = F.when(k % 10 < 7, "train").when(k % 10 < 8, "val").otherwise("test")
    return table(spark, sf_dir, "orders").select(
        k.alias("row_key"), spelled.otherwise(F.concat(low, F.lit("\t"))).alias("label"), split.alias("split")
    )


LABEL_TAXONOMIES = {
    "first": {"1-urgent": 0, "2-high": 1, "3-medium": 2, "5-low": 3},
    "second": {"1-urgent": 0, "2-high": 1, "3-medium": 4, "5-low": 3},
}


def scored2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary truth with two given scores and class probabilities that are missing on some rows."""
    n = F.col("l_linenumber")
    probs = F.array(*[((F.col("l_orderkey") * (i + 3)) % 11).cast("double") for i in range(8)])
    return table(spark, sf_dir, "lineitem").select(
        _line_key().alias("row_key"),
        (F.col("l_returnflag") == "A").cast("int").alias("y"),
        (F.col("l_quantity") / 50).alias("p"),
        (F.col("l_extendedprice") / 105000).alias("p_b"),
        F.concat("l_returnflag", "l_linestatus").alias("family"),
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit("attack-"), n)).otherwise("Benign").alias("raw_label"),
        F.when(n != 7, probs).alias("probs"),
    )


def scored_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both scores in long form: one row per flow and model."""
    rows = scored2(spark, sf_dir)
    return rows.unpivot(["row_key", "y"], ["p", "p_b"], "model", "score").withColumnRenamed("score", "p")


def scored_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five of eight classes as truth with two given predictions."""
    k = F.col("o_orderkey")
    y = F.substring("o_orderpriority", 1, 1).cast("int") - 1
    return table(spark, sf_dir, "orders").select(
        k.alias("row_key"), y.alias("y"),
        F.when(k % 3 != 0, y).otherwise((k % 5).cast("int")).alias("pred"),
        F.when(k % 4 != 0, y).otherwise((k % 7).cast("int")).alias("pred_b"),
        F.array(*[((k * (i + 2)) % 13).cast("double") for i in range(8)]).alias("probs"),
    )


def domain(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    """Flow features of returned rows (b) or all others (a); domain b is scaled so that every severity occurs."""
    scale = {"a": (1.0, 1.0, 1.0, 1.0), "b": (20.0, 4.0, 0.05, 1.0)}[which]
    mine = {"a": F.col("l_returnflag") != "R", "b": F.col("l_returnflag") == "R"}[which]
    cells = [F.col("l_quantity"), F.col("l_extendedprice"), _rate(), _gap()]
    return table(spark, sf_dir, "lineitem").where(mine).select(
        _line_key().alias("row_key"),
        *[(c * F.lit(s)).alias(f) for c, s, f in zip(cells, scale, FEATURES)],
        F.lit(0.0).alias("Bwd URG Flags"),
    )


def packets(events: DataFrame) -> DataFrame:
    """Events as packets: a user talks to one server, clicks and views go out, the rest come back."""
    kind, user = F.col("event_type"), F.concat(F.lit("u"), F.col("user_id"))
    out = kind.isin("click", "view")
    server, user_port, server_port = F.lit("s"), F.lit(1000), F.lit(443)
    flags = {
        "fin": kind == "error", "syn": kind == "signup", "rst": F.lit(False), "psh": kind == "purchase",
        "ack": kind == "view", "urg": kind == "click", "cwr": F.lit(False), "ece": F.lit(False),
    }
    return events.select(
        F.when(out, user).otherwise(server).alias("src"), F.when(out, user_port).otherwise(server_port).alias("src_port"),
        F.when(out, server).otherwise(user).alias("dst"), F.when(out, server_port).otherwise(user_port).alias("dst_port"),
        F.lit(6).alias("protocol"), F.col("ts").cast("timestamp").alias("ts"),
        F.round(F.col("value") * 100).cast("long").alias("length"),
        (F.lit(20) + F.col("event_id") % 3 * 4).alias("header_length"),
        (F.col("event_id") % 7 * 1000).alias("window"),
        F.col("event_id").alias("packet_id"),
        *[c.cast("int").alias(f) for f, c in flags.items()],
    )


def event_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packets(table(spark, sf_dir, "events"))


def busy_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as packets, 95 in a hundred of them of one pair."""
    user = F.when(F.col("event_id") % 20 != 0, F.lit(0)).otherwise(F.col("user_id"))
    return packets(table(spark, sf_dir, "events").withColumn("user_id", user))


def event_packet_stream(spark: SparkSession, sf_dir: str, schema: StructType) -> DataFrame:
    return packets(spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir))


DIMENSIONS = 64
VECTOR_FEATURES = [f"e{i}" for i in range(DIMENSIONS)]


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as feature columns with a binary and an eight-class target and a row split."""
    k = F.col("vec_id")
    split = F.when(k % 10 < 7, "train").when(k % 10 < 8, "val").otherwise("test")
    return table(spark, sf_dir, "embeddings").select(
        k.alias("row_key"), split.alias("split"),
        (F.col("label") >= 5).cast("int").alias("y"), (F.col("label") % 8).alias("class_id"),
        *[F.col("embedding")[i].alias(f"e{i}") for i in range(DIMENSIONS)],
    )
