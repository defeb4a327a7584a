"""Bridge from bidirectional flow columns (2018 spelling) to the 46-feature space."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.contracts import FEATURES_46
from flowloom.functions import clip_low, named
from flowloom.operators.cleaning import zero_clean

# Plain copies of a non-negative input column, protocol numbers, constants.
_COPIES = {
    "fin_flag_number": "FIN Flag Count", "syn_flag_number": "SYN Flag Count", "rst_flag_number": "RST Flag Count",
    "psh_flag_number": "PSH Flag Count", "ack_flag_number": "ACK Flag Count", "ece_flag_number": "ECE Flag Count",
    "cwr_flag_number": "CWE Flag Count", "ack_count": "ACK Flag Count", "syn_count": "SYN Flag Count",
    "fin_count": "FIN Flag Count", "urg_count": "URG Flag Count", "rst_count": "RST Flag Count",
    "Min": "Packet Length Min", "Max": "Packet Length Max", "AVG": "Packet Length Mean",
    "Std": "Packet Length Std", "Variance": "Packet Length Variance",
}
_PROTOCOLS = {"TCP": 6, "UDP": 17, "ICMP": 1}
_CONSTANTS = {"IPv": 4.0, "HTTP": 0.0, "HTTPS": 0.0, "DNS": 0.0, "Telnet": 0.0, "SMTP": 0.0, "SSH": 0.0,
              "IRC": 0.0, "DHCP": 0.0, "ARP": 0.0, "LLC": 0.0, "Covariance": 0.0}


def to_46_features(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """All 46 features as float32 in contract order: one projection, no shuffle."""

    def pos(name):
        return clip_low(named(name).cast("double"))

    def zero(name):
        value = F.nanvl(named(name).cast("double"), F.lit(0.0))
        return clip_low(F.coalesce(value, F.lit(0.0)))

    seconds = clip_low(pos("Flow Duration") / 1e6, 1e-9)
    fwd, bwd = pos("Total Fwd Packets"), pos("Total Backward Packets")
    size = pos("Fwd Packets Length Total") + pos("Bwd Packets Length Total")
    protocol = F.coalesce(named("Protocol").cast("double"), F.lit(0.0))

    def squares(stat):
        f, b = zero(f"Fwd Packet Length {stat}"), zero(f"Bwd Packet Length {stat}")
        return f * f + b * b

    made = {name: pos(source) for name, source in _COPIES.items()}
    made |= {name: (protocol == number).cast("double") for name, number in _PROTOCOLS.items()}
    made |= {name: F.lit(value) for name, value in _CONSTANTS.items()}
    made |= {
        "flow_duration": seconds, "Duration": seconds,
        "Header_Length": pos("Fwd Header Length") / clip_low(fwd, 1.0),
        "Protocol Type": protocol,
        "Rate": (fwd + bwd) / seconds, "Weight": (fwd + bwd) / seconds,
        "Srate": fwd / seconds, "Drate": bwd / seconds,
        "Tot sum": size, "Tot size": size,
        "IAT": zero("Flow IAT Mean"), "Number": fwd + bwd,
        "Magnitue": F.sqrt(squares("Mean")), "Radius": F.sqrt(squares("Std") / 2.0),
    }
    return df.select(*[named(c) for c in keep], *[made[f].cast("float").alias(f) for f in FEATURES_46])


def prepare_2018(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Converted features with infinite and missing cells set to 0."""
    return zero_clean(to_46_features(df, keep), FEATURES_46)
