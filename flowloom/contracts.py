"""Feature contracts, label taxonomies and the other fixed tables of the flow domain."""

from __future__ import annotations

import json
from collections.abc import Sequence
from pathlib import Path

from flowloom.sources.files import exists, read_text

# --------------------------------------------------------------------------
# Column names of the public flow datasets, label spellings and
# published settings. They have to match the data and are listed in natural
# order.
# --------------------------------------------------------------------------

FEATURES_71 = [
    "Protocol", "Flow Duration", "Total Fwd Packet", "Total Bwd packets",
    "Total Length of Fwd Packet", "Total Length of Bwd Packet",
    "Fwd Packet Length Max", "Fwd Packet Length Min", "Fwd Packet Length Mean", "Fwd Packet Length Std",
    "Bwd Packet Length Max", "Bwd Packet Length Min", "Bwd Packet Length Mean", "Bwd Packet Length Std",
    "Flow Bytes/s", "Flow Packets/s",
    "Flow IAT Mean", "Flow IAT Std", "Flow IAT Max", "Flow IAT Min",
    "Fwd IAT Total", "Fwd IAT Mean", "Fwd IAT Std", "Fwd IAT Max", "Fwd IAT Min",
    "Bwd IAT Total", "Bwd IAT Mean", "Bwd IAT Std", "Bwd IAT Max", "Bwd IAT Min",
    "Fwd PSH Flags", "Bwd PSH Flags", "Fwd URG Flags", "Bwd URG Flags",
    "Fwd Header Length", "Bwd Header Length", "Fwd Packets/s", "Bwd Packets/s",
    "Packet Length Min", "Packet Length Max", "Packet Length Mean", "Packet Length Std", "Packet Length Variance",
    "FIN Flag Count", "SYN Flag Count", "RST Flag Count", "PSH Flag Count",
    "ACK Flag Count", "URG Flag Count", "CWR Flag Count", "ECE Flag Count",
    "Down/Up Ratio", "Average Packet Size", "Fwd Segment Size Avg", "Bwd Segment Size Avg",
    "Subflow Fwd Packets", "Subflow Fwd Bytes", "Subflow Bwd Packets", "Subflow Bwd Bytes",
    "FWD Init Win Bytes", "Bwd Init Win Bytes", "Fwd Act Data Pkts", "Fwd Seg Size Min",
    "Active Mean", "Active Std", "Active Max", "Active Min",
    "Idle Mean", "Idle Std", "Idle Max", "Idle Min",
]

FEATURES_46 = [
    "flow_duration", "Header_Length", "Protocol Type", "Duration", "Rate", "Srate", "Drate",
    "fin_flag_number", "syn_flag_number", "rst_flag_number", "psh_flag_number",
    "ack_flag_number", "ece_flag_number", "cwr_flag_number",
    "ack_count", "syn_count", "fin_count", "urg_count", "rst_count",
    "HTTP", "HTTPS", "DNS", "Telnet", "SMTP", "SSH", "IRC",
    "TCP", "UDP", "DHCP", "ARP", "ICMP", "IPv", "LLC",
    "Tot sum", "Min", "Max", "AVG", "Std", "Tot size",
    "IAT", "Number", "Magnitue", "Radius", "Covariance", "Variance", "Weight",
]

HEADER_PREFIX = "Flow ID,"
BENIGN_FOLDER = "Benign"
DROP_COLUMNS = ["Flow ID", "Src IP", "Dst IP", "Timestamp", "Label"]
META_COLUMNS = [
    "source_dataset", "source_class_folder", "source_relative_file",
    "source_file_name", "target_binary", "raw_stage2_label",
]
KNOWN_HEADERLESS = [
    "DoS/DoS-TCP_Flood/DoS-TCP_Flood.pcap_Flow.csv",
    "DoS/DoS-TCP_Flood/DoS-TCP_Flood1.pcap_Flow.csv",
    "DoS/DoS-TCP_Flood/DoS-TCP_Flood10.pcap_Flow.csv",
    "DoS/DoS-TCP_Flood/DoS-TCP_Flood2.pcap_Flow.csv",
    "DoS/DoS-TCP_Flood/DoS-TCP_Flood3.pcap_Flow.csv",
]

# Column spellings of the 2018 and 2017 public captures -> FEATURES_71 names.
RENAMES_2018 = {
    "Total Fwd Packets": "Total Fwd Packet",
    "Total Backward Packets": "Total Bwd packets",
    "Fwd Packets Length Total": "Total Length of Fwd Packet",
    "Bwd Packets Length Total": "Total Length of Bwd Packet",
    "CWE Flag Count": "CWR Flag Count",
    "Avg Packet Size": "Average Packet Size",
    "Avg Fwd Segment Size": "Fwd Segment Size Avg",
    "Avg Bwd Segment Size": "Bwd Segment Size Avg",
    "Init Fwd Win Bytes": "FWD Init Win Bytes",
    "Init Bwd Win Bytes": "Bwd Init Win Bytes",
    "Fwd Act Data Packets": "Fwd Act Data Pkts",
}
RENAMES_2017 = {
    "Total Fwd Packets": "Total Fwd Packet",
    "Total Backward Packets": "Total Bwd packets",
    "Total Length of Fwd Packets": "Total Length of Fwd Packet",
    "Total Length of Bwd Packets": "Total Length of Bwd Packet",
    "Min Packet Length": "Packet Length Min",
    "Max Packet Length": "Packet Length Max",
    "CWE Flag Count": "CWR Flag Count",
    "Avg Fwd Segment Size": "Fwd Segment Size Avg",
    "Avg Bwd Segment Size": "Bwd Segment Size Avg",
    "Init_Win_bytes_forward": "FWD Init Win Bytes",
    "Init_Win_bytes_backward": "Bwd Init Win Bytes",
    "act_data_pkt_fwd": "Fwd Act Data Pkts",
    "min_seg_size_forward": "Fwd Seg Size Min",
}
BENIGN_VALUE = {"2018": "Benign", "2017": "BENIGN"}

CLASS_NAMES = ["Benign", "DoS", "DDoS", "Recon", "BruteForce", "WebAttack", "Bot", "Spoofing"]
GENERAL_CLASS_NAMES = ["DoS", "DDoS", "BruteForce", "WebAttack", "Recon", "Botnet", "Infiltration"]

# Normalised raw label -> class id, one table per label vocabulary.
TAXONOMIES: dict[str, dict[str, int]] = {
    "flow71": {
        "benign": 0, "normal": 0,
        "dos": 1, "dos attacks-hulk": 1, "dos attacks-goldeneye": 1, "dos attacks-slowloris": 1,
        "dos attacks-slowhttptest": 1, "dos hulk": 1, "dos goldeneye": 1, "dos slowloris": 1,
        "dos slowhttptest": 1,
        "ddos": 2, "ddos attacks-loic-http": 2, "ddos attack-hoic": 2, "ddos attack-loic-udp": 2,
        "recon": 3, "portscan": 3, "port scan": 3, "reconnaissance": 3,
        "bruteforce": 4, "brute force": 4, "ssh-bruteforce": 4, "ftp-bruteforce": 4,
        "ftp-patator": 4, "ssh-patator": 4,
        "web-based": 5, "webattack": 5, "web attack": 5, "brute force -web": 5,
        "brute force -xss": 5, "sql injection": 5, "xss": 5,
        "mirai": 6, "bot": 6, "botnet": 6,
        "spoofing": 7,
    },
    "iot46": {
        "benigntraffic": 0,
        "dos-udp_flood": 1, "dos-tcp_flood": 1, "dos-syn_flood": 1, "dos-http_flood": 1,
        "ddos-icmp_flood": 2, "ddos-udp_flood": 2, "ddos-tcp_flood": 2, "ddos-pshack_flood": 2,
        "ddos-syn_flood": 2, "ddos-rstfinflood": 2, "ddos-synonymousip_flood": 2,
        "ddos-icmp_fragmentation": 2, "ddos-udp_fragmentation": 2, "ddos-ack_fragmentation": 2,
        "ddos-http_flood": 2, "ddos-slowloris": 2,
        "recon-hostdiscovery": 3, "recon-osscan": 3, "recon-portscan": 3, "recon-pingsweep": 3,
        "vulnerabilityscan": 3,
        "dictionarybruteforce": 4,
        "sqlinjection": 5, "xss": 5, "commandinjection": 5, "browserhijacking": 5,
        "uploading_attack": 5,
        "mirai-greeth_flood": 6, "mirai-udpplain": 6, "mirai-greip_flood": 6, "backdoor_malware": 6,
        "mitm-arpspoofing": 7, "dns_spoofing": 7,
    },
    "extended46": {
        "benign": 0,
        "dos attacks-hulk": 1, "dos attacks-goldeneye": 1, "dos attacks-slowloris": 1,
        "dos attacks-slowhttptest": 1,
        "ddos attack-loic-udp": 2, "ddos attack-hoic": 2, "ddos attacks-loic-http": 2,
        "ddos attack-loic-http": 2,
        "infilteration": 3,
        "ssh-bruteforce": 4, "ftp-bruteforce": 4, "brute force -web": 4, "brute force -xss": 4,
        "sql injection": 5,
        "bot": 6,
    },
}

# Largest number of training rows per class id, and training weight per class id.
CLASS_CAPS: dict[str, dict[int, int]] = {
    "flow71": {0: 300_000, 1: 300_000, 2: 200_000, 3: 80_000, 4: 80_000, 5: 50_000, 6: 80_000, 7: 80_000},
    "iot46": {0: 200_000, 1: 200_000, 2: 200_000, 3: 50_000, 4: 5_000, 5: 8_000, 6: 150_000, 7: 50_000},
    "extended46": {0: 300_000, 1: 300_000, 2: 300_000, 3: 80_000, 4: 50_000, 5: 20_000, 6: 200_000, 7: 50_000},
}
CLASS_WEIGHTS: dict[str, list[float]] = {
    "flow71": [1.0, 1.0, 1.0, 2.0, 3.0, 4.0, 2.0, 2.0],
    "iot46": [1.0, 1.0, 1.0, 3.0, 6.0, 6.0, 1.5, 2.0],
    "extended46": [1.0, 1.0, 1.0, 2.0, 4.0, 4.0, 1.5, 2.0],
}

SPLITS = ["train", "val", "test"]
BENIGN_TARGETS = {"train": 0.50, "val": 0.25, "test": 0.25}
ATTACK_TARGETS = {"train": 0.70, "val": 0.15, "test": 0.15}

KEY_FEATURES = [
    "Flow Bytes/s", "Flow Packets/s", "Fwd Packets/s", "Bwd Packets/s",
    "Packet Length Mean", "Packet Length Max", "Total Fwd Packet", "Total Bwd packets",
    "Flow Duration", "FWD Init Win Bytes", "Bwd Init Win Bytes",
    "Fwd Packet Length Mean", "Bwd Packet Length Mean", "ACK Flag Count", "SYN Flag Count",
]

# ------------------------- end of the fixed values -------------------------


def threshold_grid(start: float = 0.05, stop: float = 0.95, step: float = 0.01) -> list[float]:
    """Evenly stepped thresholds, `stop` included, spaced by the float difference of the first two."""
    count = int(-(-(stop + step / 2 - start) // step))
    stride = (start + step) - start
    return [start + i * stride for i in range(count)]


def load_contract(path: str | Path) -> list[str]:
    """Read a feature contract: a JSON list of column names."""
    if not exists(path):
        raise FileNotFoundError(f"no feature contract at {path}")
    names = json.loads(read_text(path))
    if not isinstance(names, list) or any(not isinstance(n, str) for n in names):
        raise ValueError(f"{path} is not a JSON list of column names")
    return names


def contract_problems(names: Sequence[str]) -> dict[str, list[str]]:
    """Duplicates and lineage columns that a feature contract must not hold."""
    seen: set[str] = set()
    repeated = [n for n in names if n in seen or seen.add(n)]
    return {"duplicates": repeated, "meta": [n for n in names if n in META_COLUMNS]}
