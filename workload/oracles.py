"""SQL (DuckDB dialect) with the same result as each registered query, written from the definitions."""

from __future__ import annotations

from workload.proxies import (
    CLASS_OF_TYPE,
    FEATURES,
    LABEL_OF_TYPE,
    LABEL_TAXONOMIES,
)

ORACLES: dict[str, str] = {}


def _case(column: str, names: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items()) + " END"


# ---- views of the test tables ---------------------------------------------------

LINE_KEY = "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(round(l_extendedprice * 100) AS BIGINT))"
RATE = "CASE WHEN l_tax = 0 THEN 'inf'::DOUBLE ELSE l_extendedprice / l_tax END"
GAP = "CASE WHEN l_discount <> 0 THEN l_discount * l_quantity END"
LINES = """(SELECT * REPLACE (CASE p_type WHEN 'PROMO' THEN 'Brand#11'
    WHEN 'SMALL' THEN CASE WHEN CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INT) % 2 = 1 THEN 'Brand#11' ELSE 'Brand#12' END
    ELSE p_brand END AS p_brand) FROM lineitem JOIN part ON l_partkey = p_partkey)"""

FLOWS = f"""flows AS (
  SELECT {LINE_KEY} AS row_key, {_case('p_type', CLASS_OF_TYPE)} AS source_class_folder,
    concat_ws('/', {_case('p_type', CLASS_OF_TYPE)}, p_brand) AS source_relative_file,
    p_brand AS source_file_name, CASE WHEN p_type = 'STANDARD' THEN 0 ELSE 1 END AS target_binary,
    l_quantity AS "Flow Duration", l_extendedprice AS "Total Length of Fwd Packet",
    {RATE} AS "Flow Bytes/s", {GAP} AS "Flow IAT Mean", 0.0::DOUBLE AS "Bwd URG Flags"
  FROM {LINES})"""

FOREIGN = f"""foreign_flows AS (
  SELECT {LINE_KEY} AS row_key, {_case('p_type', LABEL_OF_TYPE)} AS "Label", l_quantity / 50 AS given_score,
    CASE l_linenumber % 4 WHEN 0 THEN 6 WHEN 1 THEN 17 WHEN 2 THEN 1 END AS "Protocol",
    l_quantity * 1000 - 2000 AS "Flow Duration", l_linenumber - 1 AS "Total Fwd Packets",
    l_linenumber % 3 AS "Total Backward Packets", l_extendedprice AS "Fwd Packets Length Total",
    l_extendedprice * l_discount AS "Bwd Packets Length Total", l_linenumber * 20 AS "Fwd Header Length",
    (l_returnflag = 'A')::INT AS "FIN Flag Count", (l_linestatus = 'F')::INT AS "SYN Flag Count",
    (l_returnflag = 'R')::INT AS "RST Flag Count", (l_linestatus = 'O')::INT AS "PSH Flag Count",
    l_linenumber AS "ACK Flag Count", 0 AS "URG Flag Count", -1 AS "ECE Flag Count", l_linenumber % 2 AS "CWE Flag Count",
    l_discount * 100 - 1 AS "Packet Length Min", l_quantity * 30 AS "Packet Length Max",
    l_quantity * 10 AS "Packet Length Mean", l_tax * 100 AS "Packet Length Std",
    l_tax * 100 * l_tax AS "Packet Length Variance",
    CASE WHEN l_discount <> 0 THEN l_extendedprice / l_quantity END AS "Fwd Packet Length Mean",
    l_quantity AS "Bwd Packet Length Mean", l_tax * 10 AS "Fwd Packet Length Std",
    l_discount * 10 AS "Bwd Packet Length Std", {GAP} AS "Flow IAT Mean", {RATE} AS "Flow Bytes/s"
  FROM {LINES})"""

RAW_LABELS = """raw_labels AS (
  SELECT o_orderkey AS row_key,
    CASE o_orderkey % 3 WHEN 0 THEN '  ' || lower(o_orderpriority) || ' ' WHEN 1 THEN o_orderpriority
      ELSE lower(o_orderpriority) || chr(9) END AS label,
    CASE WHEN o_orderkey % 10 < 7 THEN 'train' WHEN o_orderkey % 10 < 8 THEN 'val' ELSE 'test' END AS split
  FROM orders)"""


def _dim(name: str) -> str:
    rows = ", ".join(f"('{k}', {v})" for k, v in LABEL_TAXONOMIES[name].items())
    return f"{name}_dim(norm, class_id) AS (VALUES {rows})"


NORM = r"lower(regexp_replace(label, '^\s+|\s+$', '', 'g'))"

SCORED2 = f"""scored2 AS (
  SELECT {LINE_KEY} AS row_key, (l_returnflag = 'A')::INT AS y, l_quantity / 50 AS p, l_extendedprice / 105000 AS p_b,
    l_returnflag || l_linestatus AS family,
    CASE WHEN l_returnflag = 'A' THEN 'attack-' || l_linenumber ELSE 'Benign' END AS raw_label,
    CASE WHEN l_linenumber <> 7 THEN [{', '.join(f'(l_orderkey * {i + 3}) % 11' for i in range(8))}] END AS probs
  FROM lineitem)"""
MODELS = f"""{SCORED2}, scored AS (
  SELECT 'p' AS model, y, p FROM scored2 UNION ALL SELECT 'p_b', y, p_b FROM scored2)"""
SCORED_K = f"""scored_k AS (
  SELECT o_orderkey AS row_key, CAST(substr(o_orderpriority, 1, 1) AS INT) - 1 AS y,
    CASE WHEN o_orderkey % 3 <> 0 THEN CAST(substr(o_orderpriority, 1, 1) AS INT) - 1 ELSE CAST(o_orderkey % 5 AS INT) END AS pred,
    CASE WHEN o_orderkey % 4 <> 0 THEN CAST(substr(o_orderpriority, 1, 1) AS INT) - 1 ELSE CAST(o_orderkey % 7 AS INT) END AS pred_b,
    [{', '.join(f'(o_orderkey * {i + 2}) % 13' for i in range(8))}] AS probs
  FROM orders)"""


def _domain(which: str) -> str:
    mine, scale = {"a": ("<> 'R'", (1, 1, 1, 1)), "b": ("= 'R'", (20, 4, 0.05, 1))}[which]
    cells = zip(("l_quantity", "l_extendedprice", f"({RATE})", f"({GAP})"), scale, FEATURES)
    listed = ", ".join(f'{c} * {s}::DOUBLE AS "{f}"' for c, s, f in cells)
    return f"""domain_{which} AS (SELECT {LINE_KEY} AS row_key, {listed}, 0.0::DOUBLE AS "Bwd URG Flags"
  FROM lineitem WHERE l_returnflag {mine})"""


QUOTED = [f'"{f}"' for f in FEATURES]


def _fin(c: str) -> str:
    return f"CASE WHEN isfinite({c}) THEN {c} END"


def _hash(key: str = "row_key") -> str:
    return f"md5('42:' || {key})"


def _each(template: str, features=FEATURES, source: str = "flows") -> str:
    return " UNION ALL ".join(
        template.format(name=f, c=f'"{f}"', fin=_fin(f'"{f}"'), source=source) for f in features
    )


# ---- ingest and alignment ---------------------------------------------------------

ORACLES["class_rollup"] = f"""WITH {FLOWS}, files AS (
  SELECT source_class_folder, source_file_name, round(count(*) * 640 / 1048576, 2) AS mb FROM flows GROUP BY ALL)
SELECT source_class_folder, count(*) AS files, round(sum(mb), 2) AS total_mb,
  count(*) FILTER (source_file_name = 'Brand#3') AS known_headerless,
  count(*) FILTER (source_file_name = 'Brand#7') AS suspicious
FROM files GROUP BY 1"""

ORACLES["align_schema"] = f"""WITH {FLOWS}
SELECT row_key, "Flow Bytes/s", NULL::VARCHAR AS "Idle Mean", "Flow Duration" FROM flows"""

_FOREIGN_PICK = {
    "Flow Duration": "Flow Duration", "Total Fwd Packet": "Total Fwd Packets", "Total Bwd packets": "Total Backward Packets",
    "Total Length of Fwd Packet": "Fwd Packets Length Total", "Total Length of Bwd Packet": "Bwd Packets Length Total",
    "CWR Flag Count": "CWE Flag Count", "Flow Bytes/s": "Flow Bytes/s", "Flow IAT Mean": "Flow IAT Mean",
}
ORACLES["align_rename"] = f"""WITH {FOREIGN}
SELECT row_key, {', '.join(f'"{c}"::FLOAT::DOUBLE AS "{n}"' for n, c in _FOREIGN_PICK.items())} FROM foreign_flows"""

ORACLES["safe_numeric"] = f"""SELECT {LINE_KEY} AS row_key, l_quantity::FLOAT::DOUBLE AS "Flow Duration",
  CASE WHEN l_linenumber IN (1, 2, 4) THEN NULL WHEN l_linenumber IN (3, 5) THEN 'inf'::DOUBLE
    WHEN l_linenumber = 6 THEN '-inf'::DOUBLE ELSE l_extendedprice::FLOAT::DOUBLE END AS "Flow Bytes/s"
FROM lineitem"""

ORACLES["stamp_target"] = f"""WITH {FLOWS}
SELECT row_key, source_class_folder, 'proxy' AS source_dataset,
  CASE WHEN source_class_folder = 'Benign' THEN 0 ELSE 1 END AS target_binary,
  source_class_folder AS raw_stage2_label FROM flows"""

ORACLES["compact_manifest"] = f"""WITH {FLOWS}
SELECT source_relative_file, source_class_folder, count(*) AS rows_written,
  (source_relative_file IN ('DoS/Brand#3', 'Recon/Brand#4'))::INT AS headerless_fixed
FROM flows GROUP BY source_relative_file, source_class_folder"""

ORACLES["compact_class_totals"] = f"""WITH {FLOWS}
SELECT source_class_folder, count(DISTINCT source_relative_file) AS files, count(*) AS rows_written FROM flows GROUP BY 1"""

ORACLES["augment_union"] = f"""WITH {_domain('a')}, {_domain('b')}
SELECT * FROM domain_a UNION ALL BY NAME SELECT * FROM domain_b"""

# ---- labels ---------------------------------------------------------------------------

ORACLES["label_map"] = f"""WITH {RAW_LABELS}, {_dim('first')}
SELECT row_key, class_id FROM raw_labels LEFT JOIN first_dim ON norm = {NORM}"""

ORACLES["unknown_labels"] = f"""WITH {RAW_LABELS}, {_dim('first')}
SELECT label, count(*) AS row_count FROM raw_labels WHERE {NORM} NOT IN (SELECT norm FROM first_dim) GROUP BY 1"""

ORACLES["binary_target"] = """SELECT o_orderkey,
  (NULLIF(o_orderpriority, '3-MEDIUM') IS DISTINCT FROM '5-LOW')::INT AS y FROM orders"""

ORACLES["class_distribution"] = f"""WITH {RAW_LABELS}, {_dim('first')}
SELECT split, class_id, ['Benign', 'DoS', 'DDoS', 'Recon'][class_id + 1] AS class_name, count(*) AS row_count
FROM raw_labels JOIN first_dim ON norm = {NORM} GROUP BY split, class_id"""

ORACLES["label_freq"] = f"""WITH {RAW_LABELS}
SELECT label, count(*) AS row_count, count(*) / (SELECT count(*) FROM raw_labels)::DOUBLE * 100 AS pct
FROM raw_labels GROUP BY 1"""

ORACLES["taxonomy_diff"] = f"""WITH {RAW_LABELS}, {_dim('first')}, {_dim('second')}
SELECT a.norm AS label, count(*) AS row_count, a.class_id AS first_class, b.class_id AS second_class
FROM raw_labels JOIN first_dim a ON a.norm = {NORM} JOIN second_dim b ON b.norm = a.norm
WHERE a.class_id <> b.class_id GROUP BY 1, 3, 4"""

# ---- splits, quotas, samples -----------------------------------------------------------

FILES = f"""{FLOWS}, files AS (
  SELECT source_relative_file, source_file_name, source_class_folder, target_binary, count(*) AS "rows"
  FROM flows GROUP BY ALL)"""
WALK = f"""RECURSIVE {FILES}, ranked AS (
  SELECT *, CASE WHEN target_binary = 0 THEN '' ELSE source_class_folder END AS grp,
    row_number() OVER (PARTITION BY target_binary, source_class_folder ORDER BY "rows" DESC, source_relative_file) AS i,
    count(*) OVER (PARTITION BY target_binary, source_class_folder) AS n,
    CAST(sum("rows") OVER (PARTITION BY target_binary, source_class_folder) AS DOUBLE) AS total FROM files),
walk AS (
  SELECT grp, i, source_relative_file, 'train' AS split, "rows"::BIGINT AS a, 0::BIGINT AS b, 0::BIGINT AS c
  FROM ranked WHERE i = 1
  UNION ALL
  SELECT grp, i, source_relative_file, split, a + CASE WHEN split = 'train' THEN r ELSE 0 END,
    b + CASE WHEN split = 'val' THEN r ELSE 0 END, c + CASE WHEN split = 'test' THEN r ELSE 0 END
  FROM (SELECT f.grp, f.i, f.source_relative_file, f."rows" AS r, w.a, w.b, w.c,
      CASE WHEN f.grp = '' AND f.n >= 4 AND f.i <= 4 THEN ['train', 'train', 'val', 'test'][f.i]
        WHEN f.grp = '' AND f.n = 3 THEN ['train', 'val', 'test'][f.i]
        WHEN f.grp <> '' AND f.n = 2 THEN 'test'
        WHEN f.grp <> '' AND f.i <= 3 THEN ['train', 'val', 'test'][f.i]
        WHEN f.grp = '' AND w.a / (f.total * 0.5::DOUBLE) <= least(w.b / (f.total * 0.25::DOUBLE), w.c / (f.total * 0.25::DOUBLE)) THEN 'train'
        WHEN f.grp = '' AND w.b <= w.c THEN 'val'
        WHEN f.grp = '' THEN 'test'
        WHEN w.a / (f.total * 0.7::DOUBLE) <= least(w.b / (f.total * 0.15::DOUBLE), w.c / (f.total * 0.15::DOUBLE)) THEN 'train'
        WHEN w.b <= w.c THEN 'val' ELSE 'test' END AS split
    FROM walk w JOIN ranked f ON f.grp = w.grp AND f.i = w.i + 1)),
manifest AS (SELECT files.*, walk.split FROM files JOIN walk USING (source_relative_file))"""


def _largest_remainder(source: str, cap: str, budget: str, key: str, within: str = "") -> str:
    part = f"PARTITION BY {within}" if within else ""
    return f"""(SELECT * EXCLUDE (_t, _b, _raw, _q, _left), _q + CASE WHEN _left > 0 AND _q < {cap}
        AND row_number() OVER ({part} ORDER BY _q < {cap} DESC, _raw - _q DESC, {key}) <= _left THEN 1 ELSE 0 END AS quota
      FROM (SELECT *, _b - sum(_q) OVER ({part}) AS _left
        FROM (SELECT *, least(floor(_raw)::BIGINT, {cap}::BIGINT) AS _q
          FROM (SELECT *, CASE WHEN _t = 0 THEN 0::DOUBLE ELSE _b::DOUBLE * {cap} / _t END AS _raw
            FROM (SELECT *, greatest(0, least({budget}, _t))::BIGINT AS _b
              FROM (SELECT *, CAST(sum({cap}) OVER ({part}) AS BIGINT) AS _t FROM {source}))))))"""


def _balanced(attack: str, target: str) -> str:
    """CTEs fam and quotas: family-balanced quota of the rows of `attack`."""
    return f"""fam0 AS (SELECT source_class_folder AS fam, CAST(sum("rows") AS BIGINT) AS fr,
    least({target}, (SELECT sum("rows") FROM {attack}))::BIGINT AS goal FROM {attack} GROUP BY 1),
fam1 AS (SELECT *, least(goal // (SELECT count(*) FROM fam0), fr) AS base FROM fam0),
fam2 AS (SELECT *, fr - base AS residual, (goal - sum(base) OVER ())::BIGINT AS extra FROM fam1),
fam AS (SELECT fam, base + quota AS fq FROM {_largest_remainder('fam2', 'residual', 'extra', 'fam')}),
capped AS (SELECT a.*, fq FROM {attack} a JOIN fam ON fam = source_class_folder),
quotas AS (SELECT source_relative_file, "rows", quota::BIGINT AS train_attack_quota
  FROM {_largest_remainder('capped', '"rows"', 'fq', 'source_relative_file', 'source_class_folder')})"""


_TRAIN_TARGET = """(SELECT least(round_even(sum("rows") FILTER (target_binary = 0), 0),
    sum("rows") FILTER (target_binary = 1)) FROM manifest WHERE split = 'train')"""
QUOTAS = f"""{WALK}, train_attack AS (SELECT * FROM manifest WHERE split = 'train' AND target_binary = 1),
{_balanced('train_attack', _TRAIN_TARGET)},
full_manifest AS (SELECT m.*, coalesce(q.train_attack_quota, 0) AS train_attack_quota
  FROM manifest m LEFT JOIN quotas q USING (source_relative_file))"""
SPLIT = f"""{QUOTAS}, split_rows AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT f.*, m.split, m.train_attack_quota,
      row_number() OVER (PARTITION BY f.source_relative_file ORDER BY {_hash('f.row_key')}, f.row_key) AS place
    FROM flows f JOIN full_manifest m USING (source_relative_file))
  WHERE split <> 'train' OR target_binary = 0 OR place <= train_attack_quota)"""

ORACLES["file_stats"] = f"WITH {FILES} SELECT * FROM files"
ORACLES["split_benign"] = f"""WITH {WALK}
SELECT source_relative_file, "rows", split FROM manifest WHERE target_binary = 0"""
ORACLES["split_attack"] = f"""WITH {WALK}
SELECT source_relative_file, "rows", split FROM manifest WHERE target_binary = 1"""
ORACLES["split_manifest"] = f"WITH {WALK} SELECT * FROM manifest"
ORACLES["quota_largest_remainder"] = f"""WITH {FILES}
SELECT source_relative_file, "rows", quota::BIGINT AS quota
FROM {_largest_remainder('files', '"rows"', '(SELECT sum("rows") // 3 FROM files)', 'source_relative_file')}"""
ORACLES["quota_family_balanced"] = f"""WITH {FILES}, attack AS (SELECT * FROM files WHERE target_binary = 1),
{_balanced('attack', '(SELECT sum("rows") // 2 FROM attack)')}
SELECT * FROM quotas"""
ORACLES["train_attack_quota"] = f"""WITH {QUOTAS}
SELECT source_relative_file, "rows", split, train_attack_quota FROM full_manifest"""
ORACLES["exact_file_sample"] = f"""WITH {FLOWS}
SELECT row_key, source_relative_file FROM (
  SELECT *, row_number() OVER (PARTITION BY source_relative_file ORDER BY {_hash()}, row_key) AS place,
    count(*) OVER (PARTITION BY source_relative_file) AS n FROM flows) WHERE place <= n // 3"""
ORACLES["split_rows"] = f"WITH {SPLIT} SELECT row_key, source_relative_file, split FROM split_rows"
ORACLES["split_stats"] = f"""WITH {SPLIT}
SELECT split, source_class_folder, count(*) AS row_count, count(*) FILTER (target_binary = 0) AS benign,
  count(*) FILTER (target_binary = 1) AS attack FROM split_rows GROUP BY 1, 2"""
ORACLES["train_only_classes"] = f"""WITH {WALK}
SELECT source_class_folder FROM manifest WHERE split = 'train'
EXCEPT SELECT source_class_folder FROM manifest WHERE split <> 'train'"""

CLASS_ROWS = f"""{RAW_LABELS}, {_dim('first')}, class_rows AS (
  SELECT row_key, class_id FROM raw_labels JOIN first_dim ON norm = {NORM})"""
_REST_SHARE = "(0.15::DOUBLE / ((1.0::DOUBLE - 0.15::DOUBLE - 0.15::DOUBLE) + 0.15::DOUBLE))"
ORACLES["stratified_split"] = f"""WITH {CLASS_ROWS},
counts AS (SELECT class_id, count(*) AS n, (SELECT count(*) FROM class_rows) AS total FROM class_rows GROUP BY 1),
rest AS (SELECT class_id, n, quota::BIGINT AS rest
  FROM {_largest_remainder('counts', 'n', '(total - ceil(total * 0.15::DOUBLE))', 'class_id')}),
rest_total AS (SELECT *, CAST(sum(rest) OVER () AS BIGINT) AS rt FROM rest),
sizes AS (SELECT class_id, n - rest AS n_test, rest - quota AS n_val
  FROM {_largest_remainder('rest_total', 'rest', f'(rt - ceil(rt * {_REST_SHARE}))', 'class_id')})
SELECT row_key, class_id, CASE WHEN place <= n_test THEN 'test' WHEN place <= n_test + n_val THEN 'val' ELSE 'train' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY class_id ORDER BY {_hash('row_key::VARCHAR')}, row_key) AS place FROM class_rows)
JOIN sizes USING (class_id)"""
ORACLES["class_cap"] = f"""WITH {CLASS_ROWS}
SELECT row_key, class_id FROM (
  SELECT *, row_number() OVER (PARTITION BY class_id ORDER BY {_hash('row_key::VARCHAR')}, row_key) AS place FROM class_rows)
WHERE place <= CASE class_id WHEN 0 THEN 500 WHEN 1 THEN 1000000 WHEN 2 THEN 800 ELSE place END"""
ORACLES["shuffle_rows"] = f"WITH {FLOWS} SELECT row_key, source_class_folder FROM flows ORDER BY {_hash()}, row_key"
ORACLES["sample_n"] = f"WITH {FLOWS} SELECT row_key FROM flows ORDER BY {_hash()}, row_key LIMIT 5000"
ORACLES["sample_fraction"] = f"""WITH {FLOWS}
SELECT row_key FROM (SELECT row_key, row_number() OVER (ORDER BY {_hash()}, row_key) AS place FROM flows)
WHERE place <= (SELECT round_even(count(*) * 0.2::DOUBLE, 0) FROM flows)"""
ORACLES["stable_hash"] = f"""WITH {FLOWS}
SELECT row_key, list_reduce(list_prepend(0::BIGINT, list_transform(string_split(row_key, ''), lambda ch: unicode(ch)::BIGINT)),
  lambda acc, ch: (acc * 131 + ch) % 4294967295) AS hash FROM flows"""

# ---- cleaning --------------------------------------------------------------------------

_DIRTY = _each(
    "SELECT '{name}' AS feature, count(*) FILTER (isinf({c})) AS inf_count, "
    "count(*) FILTER ({c} IS NULL OR isnan({c})) AS nan_count, count(*) AS total_rows FROM {source}"
)
ORACLES["inf_nan_report"] = f"""WITH {FLOWS}, dirty AS ({_DIRTY})
SELECT *, inf_count * 100::DOUBLE / total_rows AS inf_pct, nan_count * 100::DOUBLE / total_rows AS nan_pct
FROM dirty WHERE inf_count > 0 OR nan_count > 0"""
ORACLES["inf_nan_summary"] = f"""WITH {FLOWS}, dirty AS ({_DIRTY})
SELECT max(total_rows) AS total_rows, sum(inf_count)::BIGINT AS total_inf_cells, sum(nan_count)::BIGINT AS total_nan_cells,
  count(*) FILTER (inf_count > 0) AS columns_affected_inf, count(*) FILTER (nan_count > 0) AS columns_affected_nan FROM dirty"""
ORACLES["replace_inf"] = f"""WITH {FLOWS}
SELECT row_key, {', '.join(f'{_fin(q)} AS {q}' for q in QUOTED)} FROM flows"""
ORACLES["fit_fill_median"] = f"""WITH {FLOWS}
{_each("SELECT '{name}' AS feature, coalesce(median({fin}), 0) AS fill FROM {source}")}
UNION ALL SELECT 'Idle Mean', 0::DOUBLE"""
ORACLES["fit_fill_mean"] = f"""WITH {FLOWS}
{_each("SELECT '{name}' AS feature, round(coalesce(avg({fin}), 0), 3) AS fill FROM {source}")}
UNION ALL SELECT 'Idle Mean', 0::DOUBLE"""
_FILLED = ", ".join(f"coalesce({_fin(q)}, (SELECT median({_fin(q)}) FROM flows)) AS {q}" for q in QUOTED)
ORACLES["apply_fill"] = f"""WITH {FLOWS}
SELECT row_key, {', '.join(f'coalesce({q}, (SELECT median({_fin(q)}) FROM flows)) AS {q}' for q in QUOTED)} FROM flows"""
ORACLES["inference_clean"] = f"WITH {FLOWS} SELECT row_key, {_FILLED} FROM flows"
ORACLES["residual_missing"] = f"""WITH {FLOWS}
{_each("SELECT '{name}' AS feature, 0::BIGINT AS inf_count, 0::BIGINT AS nan_count, count(*) AS total_rows FROM {source}")}"""
_SCALE = "SELECT '{name}' AS feature, avg({fin}) AS mean, CASE WHEN stddev_pop({fin}) = 0 THEN 1 ELSE stddev_pop({fin}) END AS std FROM {source}"
ORACLES["scaler_fit"] = f"""WITH {FLOWS}, fitted AS ({_each(_SCALE)})
SELECT feature, round(mean, 3) AS mean, round(std, 3) AS std FROM fitted"""
ORACLES["scaler_apply"] = f"""WITH {FLOWS}, fitted AS ({_each(_SCALE)})
SELECT row_key, {', '.join(f'''round(({_fin(q)} - (SELECT mean FROM fitted WHERE feature = '{f}')) / (SELECT std FROM fitted WHERE feature = '{f}'), 6) AS {q}''' for f, q in zip(FEATURES, QUOTED))} FROM flows"""
ORACLES["xy_rejoin"] = f"""WITH {FLOWS} SELECT row_key, "Flow Duration", source_class_folder, target_binary FROM flows"""
ORACLES["constant_features"] = f"""WITH {FLOWS}, n AS ({_each("SELECT '{name}' AS feature, count(DISTINCT {c}) AS k FROM {source}")})
SELECT feature FROM n WHERE k <= 1"""
ORACLES["feature_stats"] = f"""WITH {FLOWS}, s AS ({_each("SELECT '{name}' AS feature, min({fin}) AS min, max({fin}) AS max, round(avg({fin}), 3) AS mean, round(stddev_pop({fin}), 3) AS std, count({fin}) AS n FROM {source}")})
SELECT * FROM s WHERE n > 0"""


def _c0(name: str) -> str:
    return f'CASE WHEN "{name}" < 0 THEN 0 ELSE "{name}" END::DOUBLE'


def _z0(name: str) -> str:
    return f'(CASE WHEN coalesce("{name}", 0) < 0 THEN 0 ELSE coalesce("{name}", 0) END)::DOUBLE'


def _converted() -> dict[str, str]:
    fwd, bwd = _c0("Total Fwd Packets"), _c0("Total Backward Packets")
    seconds = f"greatest(({_c0('Flow Duration')}) / 1e6, 1e-9)"
    size = f"({_c0('Fwd Packets Length Total')}) + ({_c0('Bwd Packets Length Total')})"
    flags = {f"{f}_flag_number": f"{f.upper()} Flag Count" for f in ("fin", "syn", "rst", "psh", "ack", "ece")}
    flags["cwr_flag_number"] = "CWE Flag Count"
    flags |= {f"{f}_count": f"{f.upper()} Flag Count" for f in ("ack", "syn", "fin", "urg", "rst")}
    sizes = {"Min": "Min", "Max": "Max", "AVG": "Mean", "Std": "Std", "Variance": "Variance"}
    out = {name: _c0(source) for name, source in flags.items()}
    out |= {name: _c0(f"Packet Length {stat}") for name, stat in sizes.items()}
    out |= dict.fromkeys(("HTTP", "HTTPS", "DNS", "Telnet", "SMTP", "SSH", "IRC", "DHCP", "ARP", "LLC", "Covariance"), "0")
    out |= {p: f'(coalesce("Protocol", 0) = {k})::INT' for p, k in (("TCP", 6), ("UDP", 17), ("ICMP", 1))}
    f, b = _z0("Fwd Packet Length Mean"), _z0("Bwd Packet Length Mean")
    fs, bs = _z0("Fwd Packet Length Std"), _z0("Bwd Packet Length Std")
    out |= {
        "IPv": "4", "Protocol Type": 'coalesce("Protocol", 0)', "flow_duration": seconds, "Duration": seconds,
        "Header_Length": f"({_c0('Fwd Header Length')}) / greatest({fwd}, 1)",
        "Rate": f"(({fwd}) + ({bwd})) / {seconds}", "Weight": f"(({fwd}) + ({bwd})) / {seconds}",
        "Srate": f"({fwd}) / {seconds}", "Drate": f"({bwd}) / {seconds}", "Tot sum": size, "Tot size": size,
        "IAT": _z0("Flow IAT Mean"), "Number": f"({fwd}) + ({bwd})",
        "Magnitue": f"sqrt({f} * {f} + {b} * {b})", "Radius": f"sqrt(({fs} * {fs} + {bs} * {bs}) / 2)",
    }
    return out


ORACLES["feature_convert"] = f"""WITH {FOREIGN}
SELECT row_key, {', '.join(f'({e})::FLOAT::DOUBLE AS "{n}"' for n, e in _converted().items())} FROM foreign_flows"""
ORACLES["zero_clean"] = f"""WITH {FOREIGN}
SELECT row_key, {', '.join(f'coalesce(({e})::FLOAT::DOUBLE, 0) AS "{n}"' for n, e in _converted().items())} FROM foreign_flows"""

_PICKED = ", ".join(f'coalesce(({_converted()[n]})::FLOAT::DOUBLE, 0) AS "{n}"' for n in ("Rate", "Tot sum", "Magnitue"))
ORACLES["extend_training"] = f"""WITH {FOREIGN}, labelled AS (
  SELECT *, CASE "Label" WHEN 'Benign' THEN 0 WHEN 'DoS attacks-Hulk' THEN 1 WHEN 'DDOS attack-HOIC' THEN 2
    WHEN 'Infilteration' THEN 3 WHEN 'Bot' THEN 6 WHEN 'SQL Injection' THEN 5 END AS class_id FROM foreign_flows),
placed AS (SELECT *, row_number() OVER (PARTITION BY class_id ORDER BY {_hash()}, row_key) AS place FROM labelled)
SELECT row_key, class_id, {_PICKED} FROM placed
WHERE place <= CASE class_id WHEN 0 THEN 5000 WHEN 1 THEN 3000 WHEN 2 THEN 1000000 WHEN 3 THEN 2000 WHEN 6 THEN 200 ELSE place END"""

# ---- packets ------------------------------------------------------------------------------

PACKETS = """packets AS (
  SELECT event_id, user_id, epoch_us(ts) AS us, CAST(round(value * 100) AS BIGINT) AS len, 20 + event_id % 3 * 4 AS hdr, event_id % 7 * 1000 AS win,
    CASE WHEN event_type IN ('click', 'view') THEN 'out' ELSE 'in' END AS side, event_type AS kind FROM events),
opened AS (SELECT *, CASE WHEN us - lag(us) OVER w > 1800000000 OR lag(us) OVER w IS NULL THEN 1 ELSE 0 END AS opens
  FROM packets WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)),
flowed AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY us, event_id) AS flow FROM opened),
faced AS (SELECT *, side = first_value(side) OVER w AS fwd, us - lag(us) OVER w AS gap FROM flowed
  WINDOW w AS (PARTITION BY user_id, flow ORDER BY us, event_id)),
gapped AS (SELECT *, us - lag(us) OVER (PARTITION BY user_id, flow, fwd ORDER BY us, event_id) AS side_gap,
  count(*) FILTER (gap > 5000000) OVER (PARTITION BY user_id, flow ORDER BY us, event_id) AS phase FROM faced),
active AS (SELECT user_id, flow, avg(took) AS a_mean, stddev_samp(took) AS a_std, max(took) AS a_max, min(took) AS a_min
  FROM (SELECT user_id, flow, max(us) - min(us) AS took FROM gapped GROUP BY user_id, flow, phase) WHERE took > 0 GROUP BY 1, 2),
whole AS (SELECT * FROM gapped LEFT JOIN active USING (user_id, flow))"""


def _sd(n: str, total: str, squares: str) -> str:
    return f"CASE WHEN {n} < 2 THEN 0 ELSE ({n}::HUGEINT * {squares} - {total}::HUGEINT * {total})::DOUBLE / ({n}::DOUBLE * ({n} - 1)::DOUBLE) END"


def _packet_columns(gaps: bool) -> str:
    n, size = "count(*)", "sum(len)::HUGEINT"
    squares = "sum(len::HUGEINT * len)"
    took = "(max(us) - min(us))"
    idle, breaks = "FILTER (gap > 5000000)", "(count(*) FILTER (gap > 1000000))"

    def per_second(amount):
        return f"CASE WHEN {took} > 0 THEN ({amount})::DOUBLE * 1e6 / {took} WHEN {amount} > 0 THEN 'inf'::DOUBLE END"

    out = {
        "flow_start": "min(us)", "Flow Duration": took, "Flow Bytes/s": f"round({per_second(size)}, 3)",
        "Flow Packets/s": f"round({per_second(n)}, 3)",
        "Flow IAT Mean": f"round(CASE WHEN {n} > 1 THEN {took}::DOUBLE / ({n} - 1) ELSE 0 END, 3)",
        "Packet Length Min": "min(len)::DOUBLE", "Packet Length Max": "max(len)::DOUBLE",
        "Packet Length Mean": f"round({size}::DOUBLE / {n}, 3)", "Average Packet Size": f"round({size}::DOUBLE / {n}, 3)",
        "Packet Length Variance": f"round({_sd(n, size, squares)}, 3)",
        "Packet Length Std": f"round(sqrt({_sd(n, size, squares)}), 3)",
        "Down/Up Ratio": f"round(count(*) FILTER (NOT fwd) / (count(*) FILTER (fwd))::DOUBLE, 3)",
        "Fwd Act Data Pkts": "count(*) FILTER (fwd AND len > 0)", "Fwd Seg Size Min": "(min(hdr) FILTER (fwd))::DOUBLE",
        "FWD Init Win Bytes": "coalesce(first(win ORDER BY us, event_id) FILTER (fwd), 0)",
        "Bwd Init Win Bytes": "coalesce(first(win ORDER BY us, event_id) FILTER (NOT fwd), 0)",
        "FIN Flag Count": "count(*) FILTER (kind = 'error')", "SYN Flag Count": "count(*) FILTER (kind = 'signup')",
        "RST Flag Count": "0::BIGINT", "PSH Flag Count": "count(*) FILTER (kind = 'purchase')",
        "ACK Flag Count": "count(*) FILTER (kind = 'view')", "URG Flag Count": "count(*) FILTER (kind = 'click')",
        "CWR Flag Count": "0::BIGINT", "ECE Flag Count": "0::BIGINT",
    }
    if gaps:
        out |= {
            "Flow IAT Std": f"round(sqrt({_sd('(count(*) - 1)', took, 'sum(gap::HUGEINT * gap)')}), 3)",
            "Flow IAT Max": "coalesce(max(gap), 0)::DOUBLE", "Flow IAT Min": "coalesce(min(gap), 0)::DOUBLE",
            "Idle Mean": f"round(coalesce(avg(gap) {idle}, 0), 3)", "Idle Std": f"round(coalesce(stddev_samp(gap) {idle}, 0), 3)",
            "Active Mean": "round(coalesce(any_value(a_mean), 0), 3)", "Active Std": "round(coalesce(any_value(a_std), 0), 3)",
            "Active Max": "coalesce(any_value(a_max), 0)::DOUBLE", "Active Min": "coalesce(any_value(a_min), 0)::DOUBLE",
            "Idle Max": f"coalesce(max(gap) {idle}, 0)::DOUBLE", "Idle Min": f"coalesce(min(gap) {idle}, 0)::DOUBLE",
        }
        for title, is_fwd in (("Fwd", "fwd"), ("Bwd", "NOT fwd")):
            for what, amount in (("Packets", "count(*)"), ("Bytes", "sum(len)")):
                out[f"Subflow {title} {what}"] = f"""CASE WHEN {breaks} > 0
                  THEN coalesce({amount} FILTER ({is_fwd}), 0) // {breaks} ELSE 0 END::BIGINT"""
    for title, is_fwd in (("Fwd", "fwd"), ("Bwd", "NOT fwd")):
        only = f"FILTER ({is_fwd})"
        k, total = f"count(*) {only}", f"coalesce(sum(len) {only}, 0)::HUGEINT"
        side_squares = f"coalesce(sum(len::HUGEINT * len) {only}, 0)"
        span = f"coalesce(max(us) {only} - min(us) {only}, 0)"
        mean = f"round(CASE WHEN {k} > 0 THEN {total}::DOUBLE / {k} ELSE 0 END, 3)"
        out |= {
            f"{title} Packet Length Max": f"coalesce(max(len) {only}, 0)::DOUBLE",
            f"{title} Packet Length Min": f"coalesce(min(len) {only}, 0)::DOUBLE",
            f"{title} Packet Length Mean": mean, f"{title} Segment Size Avg": mean,
            f"{title} Packet Length Std": f"round(sqrt({_sd(k, total, side_squares)}), 3)",
            f"{title} PSH Flags": f"count(*) FILTER ({is_fwd} AND kind = 'purchase')",
            f"{title} URG Flags": f"count(*) FILTER ({is_fwd} AND kind = 'click')",
            f"{title} Header Length": f"coalesce(sum(hdr) {only}, 0)::BIGINT",
            f"{title} Packets/s": f"round({per_second(k)}, 3)",
            f"{title} IAT Total": span,
            f"{title} IAT Mean": f"round(CASE WHEN {k} > 1 THEN {span}::DOUBLE / ({k} - 1) ELSE 0 END, 3)",
        }
        if gaps:
            out |= {
                f"{title} IAT Std": f"round(sqrt({_sd(f'({k} - 1)', span, f'coalesce(sum(side_gap::HUGEINT * side_gap) {only}, 0)')}), 3)",
                f"{title} IAT Max": f"coalesce(max(side_gap) {only}, 0)::DOUBLE",
                f"{title} IAT Min": f"coalesce(min(side_gap) {only}, 0)::DOUBLE",
            }
    out |= {
        "Total Fwd Packet": "count(*) FILTER (fwd)", "Total Bwd packets": "count(*) FILTER (NOT fwd)",
        "Total Length of Fwd Packet": "coalesce(sum(len) FILTER (fwd), 0)::BIGINT",
        "Total Length of Bwd Packet": "coalesce(sum(len) FILTER (NOT fwd), 0)::BIGINT",
    }
    ends = "'s:443' AS endpoint_a, 'u' || user_id || ':1000' AS endpoint_b, 6 AS \"Protocol\""
    return ends + ", " + ", ".join(f'{e} AS "{name}"' for name, e in out.items())


ORACLES["packets_to_flows"] = f"WITH {PACKETS} SELECT {_packet_columns(True)} FROM whole GROUP BY user_id, flow"
_BUSY = PACKETS.replace("1800000000", "600000000").replace("FROM events", "FROM (SELECT * REPLACE (CASE WHEN event_id % 20 <> 0 THEN 0 ELSE user_id END AS user_id) FROM events)")
ORACLES["packets_to_flows_busy"] = f"WITH {_BUSY} SELECT {_packet_columns(True)} FROM whole GROUP BY user_id, flow"
ORACLES["packets_to_flows_stream"] = f"""WITH {PACKETS}
SELECT {_packet_columns(False)} FROM whole GROUP BY user_id, flow
HAVING max(us) + 1800000000 <= (SELECT max(us) - 600000000 FROM packets)"""

ORACLES["packets_to_flows_stream_all"] = f"""WITH {PACKETS} SELECT {_packet_columns(True)} FROM whole GROUP BY user_id, flow
HAVING max(us) + 1800000000 < (SELECT (max(us) - 600000000) // 1000 * 1000 FROM packets)"""

# ---- decisions -----------------------------------------------------------------------------

ORACLES["threshold_decide"] = f"WITH {SCORED2} SELECT row_key, p, (p >= 0.7::DOUBLE)::INT AS prediction FROM scored2"
ORACLES["argmax_class"] = f"WITH {SCORED_K} SELECT row_key, list_position(probs, list_max(probs)) - 1 AS pred FROM scored_k"
ORACLES["alert_level"] = f"""WITH {SCORED2}
SELECT row_key, p, CASE WHEN p >= 0.85::DOUBLE THEN 'anomaly' WHEN p >= 0.7::DOUBLE THEN 'warning' ELSE 'normal' END AS alert FROM scored2"""
ORACLES["verdict"] = f"""WITH {SCORED2}
SELECT row_key, family, round_even(p_b * 10000, 0) / 10000 AS attack_proba, (p_b >= 0.7::DOUBLE)::INT AS prediction,
  CASE WHEN p_b >= 0.7::DOUBLE THEN 'ATTACK' ELSE 'BENIGN' END AS verdict FROM scored2"""
_NAMES = "['Benign', 'DoS', 'DDoS', 'Recon', 'BruteForce', 'WebAttack', 'Bot', 'Spoofing']"
_ATTACK_CLASS = f"""CASE WHEN p < 0.7::DOUBLE THEN 'Benign' WHEN probs IS NULL THEN 'Attack'
    ELSE {_NAMES}[list_position(probs, list_max(probs))] END"""
ORACLES["cascade"] = f"""WITH {SCORED2}
SELECT row_key, (p >= 0.7::DOUBLE)::INT AS is_attack, {_ATTACK_CLASS} AS attack_class FROM scored2"""
ORACLES["cascade_fallback"] = f"""WITH {SCORED2}
SELECT (p >= 0.7::DOUBLE)::INT AS is_attack, {_ATTACK_CLASS} AS attack_class, count(*) AS row_count FROM scored2 GROUP BY 1, 2"""
ORACLES["class_weights"] = f"""WITH {CLASS_ROWS}
SELECT row_key, class_id, CASE class_id WHEN 3 THEN 3.0 ELSE 1.0 END::DOUBLE AS weight FROM class_rows"""

# ---- evaluation ------------------------------------------------------------------------------


def _counts(hit: str) -> str:
    return f"""count(*) FILTER (y = 0 AND NOT ({hit})) AS tn, count(*) FILTER (y = 0 AND ({hit})) AS fp,
  count(*) FILTER (y = 1 AND NOT ({hit})) AS fn, count(*) FILTER (y = 1 AND ({hit})) AS tp"""


def _rate(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} = 0 THEN 0 ELSE ({part})::DOUBLE / ({whole}) END"


METRICS = f"""{_rate('tp + tn', '(tp + tn + fp + fn)')} AS accuracy, {_rate('tp', '(tp + fp)')} AS precision,
  {_rate('tp', '(tp + fn)')} AS recall, {_rate('2 * tp', '(2 * tp + fp + fn)')} AS f1"""
MORE_METRICS = f"""{METRICS}, {_rate('tn', '(tn + fp)')} AS specificity, {_rate('fp', '(fp + tn)')} AS fpr,
  {_rate('100 * fp', '(fp + tn)')} AS fp_pct_benign"""

ORACLES["binary_confusion"] = f"WITH {SCORED2} SELECT {_counts('p >= 0.5::DOUBLE')} FROM scored2"
ORACLES["binary_metrics"] = f"""WITH {MODELS}, c AS (SELECT model, {_counts('p >= 0.5::DOUBLE')} FROM scored GROUP BY 1)
SELECT *, 0.5::DOUBLE AS threshold, {MORE_METRICS} FROM c"""

LADDER = f"""{MODELS}, per_score AS (
  SELECT model, p AS score, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM scored GROUP BY 1, 2),
ladder AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
    sum(pos) OVER (PARTITION BY model) AS positives, sum(neg) OVER (PARTITION BY model) AS negatives
  FROM per_score WINDOW w AS (PARTITION BY model ORDER BY score DESC))"""
_AUC = "sum(pos * (2 * (negatives - fp) + neg))::DOUBLE / (max(positives)::DOUBLE * max(negatives)::DOUBLE * 2)"
_AP = "sum(pos::DOUBLE / positives * (tp::DOUBLE / (tp + fp)))"
ORACLES["roc_auc"] = f"""WITH {LADDER}
SELECT model, max(positives)::BIGINT AS positives, max(negatives)::BIGINT AS negatives, {_AUC} AS roc_auc FROM ladder GROUP BY 1"""
ORACLES["average_precision"] = f"WITH {LADDER} SELECT model, round({_AP}, 9) AS pr_auc FROM ladder GROUP BY 1"
ORACLES["roc_points"] = f"""WITH {LADDER}
SELECT model, score AS threshold, fp::DOUBLE / negatives AS fpr, tp::DOUBLE / positives AS tpr FROM ladder"""

GRID = f"""{MODELS}, grid AS (
  SELECT 0.05::DOUBLE + i * ((0.05::DOUBLE + 0.01::DOUBLE) - 0.05::DOUBLE) AS threshold FROM range(91) r(i)),
swept AS (SELECT model, threshold, {_counts('p >= threshold')} FROM scored, grid GROUP BY 1, 2),
judged AS (SELECT *, {METRICS} FROM swept)"""
ORACLES["threshold_grid"] = f"WITH {GRID} SELECT * FROM judged"
ORACLES["best_threshold"] = f"""WITH {GRID}
SELECT model, round(threshold, 4) AS best_threshold, round(f1, 6) AS f1 FROM judged
QUALIFY row_number() OVER (PARTITION BY model ORDER BY round(f1, 6) DESC, threshold) = 1"""
ORACLES["threshold_table"] = f"""WITH {SCORED2}, grid AS (SELECT round(i * 0.05::DOUBLE, 2) AS threshold FROM range(1, 20) r(i)),
c AS (SELECT threshold, {_counts('p_b >= threshold')} FROM scored2, grid GROUP BY 1), m AS (SELECT *, {MORE_METRICS} FROM c)
SELECT threshold, accuracy, precision, recall, f1, fp AS fp_count, fp_pct_benign AS fp_pct, fn AS fn_count FROM m"""
ORACLES["manual_threshold"] = f"""WITH {LADDER}, c AS (SELECT {_counts('p >= 0.7::DOUBLE')} FROM scored2)
SELECT *, 0.7::DOUBLE AS threshold, {MORE_METRICS},
  (SELECT {_AUC} FROM ladder WHERE model = 'p') AS roc_auc, round((SELECT {_AP} FROM ladder WHERE model = 'p'), 9) AS pr_auc,
  'manual_fp_optimized' AS source FROM c"""
ORACLES["per_family"] = f"""WITH {SCORED2}, c AS (SELECT family, {_counts('p >= 0.5::DOUBLE')} FROM scored2 GROUP BY 1),
t AS (SELECT *, tn + fp + fn + tp AS n FROM c)
SELECT family, n AS row_count, tn + tp AS correct, (tn + tp)::DOUBLE / n AS accuracy,
  CASE WHEN tn + fp = 0 THEN tp::DOUBLE / n END AS recall, CASE WHEN fn + tp = 0 THEN tn::DOUBLE / n END AS specificity FROM t"""
ORACLES["per_label_detection"] = f"""WITH {SCORED2}, c AS (
  SELECT raw_label, count(*) AS total, count(*) FILTER ((p >= 0.3::DOUBLE) = (raw_label <> 'Benign')) AS detected FROM scored2 GROUP BY 1)
SELECT *, total - detected AS missed, detected::DOUBLE / total AS rate,
  CASE WHEN raw_label = 'Benign' THEN 'Specificity' ELSE 'Recall' END AS metric_type,
  (detected::DOUBLE / total < 0.7::DOUBLE)::INT AS weak FROM c"""
ORACLES["model_compare"] = f"""WITH {LADDER},
c AS (SELECT model, {_counts("p >= CASE model WHEN 'p' THEN 0.7::DOUBLE ELSE 0.41::DOUBLE END")} FROM scored GROUP BY 1),
a AS (SELECT model, {_AUC} AS roc_auc, {_AP} AS pr_auc FROM ladder GROUP BY 1),
m AS (SELECT model, CASE model WHEN 'p' THEN 0.7::DOUBLE ELSE 0.41::DOUBLE END AS threshold, {METRICS}, roc_auc, pr_auc FROM c JOIN a USING (model)),
long AS (UNPIVOT m ON threshold, accuracy, precision, recall, f1, roc_auc, pr_auc INTO NAME metric VALUE v)
SELECT metric, round(max(v) FILTER (model = 'p'), 9) AS p, round(max(v) FILTER (model = 'p_b'), 9) AS p_b FROM long GROUP BY 1"""
ORACLES["best_model"] = f"""WITH {MODELS}, c AS (SELECT model, {_counts('p >= 0.5::DOUBLE')} FROM scored GROUP BY 1), m AS (SELECT *, {METRICS} FROM c)
SELECT model, f1 FROM m ORDER BY f1 DESC, model LIMIT 1"""


def _multi(pred: str, tag: str = "") -> str:
    return f"""cells{tag} AS (SELECT a.y, b.pred, count(k.y) AS n FROM range(8) a(y) CROSS JOIN range(8) b(pred)
    LEFT JOIN scored_k k ON k.y = a.y AND k.{pred} = b.pred GROUP BY 1, 2),
classes{tag} AS (SELECT c.i::INT AS class_id, (SELECT sum(n) FROM cells{tag} WHERE y = c.i AND pred = c.i)::BIGINT AS hits,
    (SELECT sum(n) FROM cells{tag} WHERE pred = c.i)::BIGINT AS predicted, (SELECT sum(n) FROM cells{tag} WHERE y = c.i)::BIGINT AS support
  FROM range(8) c(i)),
prf{tag} AS (SELECT *, {_rate('hits', 'predicted')} AS precision, {_rate('hits', 'support')} AS recall,
    {_rate('2 * hits', '(predicted + support)')} AS f1 FROM classes{tag}),
seen{tag} AS (SELECT * FROM prf{tag} WHERE predicted + support > 0)"""


MULTI = f"{SCORED_K}, {_multi('pred')}"
_NAME_OF = f"{_NAMES}[class_id + 1]"
ORACLES["confusion_multi"] = f"WITH {MULTI} SELECT y::INT AS y, pred::INT AS pred, n FROM cells"
ORACLES["confusion_norm"] = f"""WITH {MULTI}
SELECT y::INT AS y, pred::INT AS pred, n, n / (sum(n) OVER (PARTITION BY y) + 1e-9::DOUBLE) AS share FROM cells"""
ORACLES["per_class_prf"] = f"WITH {MULTI} SELECT * FROM prf"
_LABELS = "string_agg(class_id::VARCHAR, ',' ORDER BY class_id)"
ORACLES["multi_summary"] = f"""WITH {MULTI}
SELECT sum(hits)::DOUBLE / sum(support) AS accuracy, round(avg(f1), 9) AS macro_f1,
  round(sum(f1 * support) / sum(support), 9) AS weighted_f1, count(*) AS label_count, {_LABELS} AS labels FROM seen"""
_ACC = "round(sum(hits)::DOUBLE / sum(support), 9)"
ORACLES["class_report"] = f"""WITH {MULTI}
SELECT {_NAME_OF} AS "row", round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM seen
UNION ALL SELECT 'accuracy', {_ACC}, {_ACC}, {_ACC}, sum(support)::BIGINT FROM seen
UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9), sum(support)::BIGINT FROM seen
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9), round(sum(recall * support) / sum(support), 9),
  round(sum(f1 * support) / sum(support), 9), sum(support)::BIGINT FROM seen"""
ORACLES["version_delta"] = f"""WITH {MULTI}, {_multi('pred_b', '_b')},
macros AS (SELECT (SELECT avg(f1) FROM seen) AS o, (SELECT avg(f1) FROM seen_b) AS n,
  (SELECT {_LABELS} FROM seen) AS ol, (SELECT {_LABELS} FROM seen_b) AS nl)
SELECT {_NAMES}[a.class_id + 1] AS "row", round(a.f1, 9) AS old_f1, round(b.f1, 9) AS new_f1, '' AS old_labels, '' AS new_labels,
  round(b.f1 - a.f1, 9) AS delta
FROM prf a JOIN prf_b b USING (class_id) WHERE a.support > 0 OR b.support > 0
UNION ALL SELECT 'macro', round(o, 9), round(n, 9), ol, nl, round(n - o, 9) FROM macros"""

CROSS = f"""{FOREIGN}, judged AS (SELECT ("Label" <> 'Benign')::INT AS y, "Label" AS raw_label, given_score AS p FROM foreign_flows)"""
ORACLES["cross_dataset_eval"] = f"""WITH {CROSS}, c AS (SELECT {_counts('p >= 0.7::DOUBLE')} FROM judged)
SELECT *, 0.7::DOUBLE AS threshold, {MORE_METRICS} FROM c"""
ORACLES["cross_dataset_labels"] = f"""WITH {CROSS}, c AS (
  SELECT raw_label, count(*) AS total, count(*) FILTER ((p >= 0.7::DOUBLE) = (raw_label <> 'Benign')) AS detected FROM judged GROUP BY 1)
SELECT *, total - detected AS missed, detected::DOUBLE / total AS rate,
  CASE WHEN raw_label = 'Benign' THEN 'Specificity' ELSE 'Recall' END AS metric_type,
  (detected::DOUBLE / total < 0.7::DOUBLE)::INT AS weak FROM c"""


def _shift_rows() -> str:
    rows = []
    for f, q in zip(FEATURES, QUOTED):
        stats = {
            f"{d}{s}": f"(SELECT quantile_cont({_fin(q)}, {p}) FROM domain_{d})"
            for d in "ab" for s, p in (("m", 0.5), ("q", 0.95))
        }
        rows.append("SELECT '" + f + "' AS feature, " + ", ".join(f"{e} AS {n}" for n, e in stats.items()))
    return " UNION ALL ".join(rows)


SHIFT = f"""{_domain('a')}, {_domain('b')}, s AS ({_shift_rows()}),
shifted AS (SELECT feature, am AS base_median, bm AS other_median, CASE WHEN am <> 0 THEN bm / am END AS ratio,
  aq AS base_p95, bq AS other_p95 FROM s)"""
ORACLES["domain_shift"] = f"""WITH {SHIFT}
SELECT feature, round(base_median, 4) AS base_median, round(other_median, 4) AS other_median, round(ratio, 4) AS ratio,
  round(base_p95, 4) AS base_p95, round(other_p95, 4) AS other_p95 FROM shifted"""
ORACLES["shift_severity"] = f"""WITH {SHIFT}, r AS (SELECT feature, round(ratio, 2) AS r FROM shifted)
SELECT feature, CASE WHEN r > 10 OR r < 0.1::DOUBLE THEN 'strong' WHEN r > 3 OR r < 0.33::DOUBLE THEN 'moderate' ELSE 'none' END AS severity,
  coalesce(r <> 0 AND (r > 5 OR r < 0.2::DOUBLE), false)::INT AS counted FROM r"""
ORACLES["top_features"] = f"""WITH {FLOWS}, s AS ({_each("SELECT '{name}' AS feature, max({fin}) AS importance FROM {source}")})
SELECT * FROM s ORDER BY importance DESC, feature LIMIT 3"""

# ---- audit --------------------------------------------------------------------------------------

ORACLES["split_overlap"] = """WITH r AS (SELECT o_custkey AS source_relative_file,
  CASE WHEN o_custkey % 3 = 0 THEN 'train' WHEN o_orderkey % 2 = 0 THEN 'val' ELSE 'test' END AS split FROM orders)
SELECT source_relative_file, count(DISTINCT split) AS split_count FROM r GROUP BY 1 HAVING count(DISTINCT split) > 1"""
_CHECK = """CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, n::VARCHAR AS detail"""
OVERLAP = f"""{SPLIT}, pairs(a, b) AS (VALUES ('train', 'val'), ('train', 'test'), ('val', 'test')),
shared AS (SELECT a, b, (SELECT count(*) FROM (SELECT source_relative_file FROM split_rows WHERE split = a
  INTERSECT SELECT source_relative_file FROM split_rows WHERE split = b)) AS n FROM pairs),
overlap AS (SELECT 'no file overlap ' || a || '-' || b AS "check", {_CHECK} FROM shared)"""
ORACLES["audit_overlap"] = f"WITH {OVERLAP} SELECT * FROM overlap"
ORACLES["audit_clean"] = """SELECT 'no ' || k || ' in ' || s AS "check", 'PASS' AS status, '0' AS detail
FROM (VALUES ('NaN'), ('Inf')) a(k) CROSS JOIN (VALUES ('train'), ('val'), ('test')) b(s) WHERE (SELECT count(*) FROM lineitem) > 0"""
BALANCE = """balance AS (SELECT 'train balance' AS "check",
    CASE WHEN b > 0 AND a::DOUBLE / b BETWEEN 0.8::DOUBLE AND 1.2::DOUBLE THEN 'PASS' ELSE 'FAIL' END AS status,
    'benign=' || b || ' attack=' || a AS detail
  FROM (SELECT count(*) FILTER (target_binary = 0) AS b, count(*) FILTER (target_binary = 1) AS a FROM split_rows WHERE split = 'train'))"""
ORACLES["audit_balance"] = f"WITH {SPLIT}, {BALANCE} SELECT * FROM balance"
COVERAGE = f"""coverage AS (SELECT c || ' absent from ' || s AS "check", {_CHECK} FROM (
    SELECT c, s, (SELECT count(*) FROM split_rows WHERE split = s AND source_class_folder = c) AS n
    FROM (VALUES ('val'), ('test')) a(s) CROSS JOIN (VALUES ('Mirai'), ('Recon')) b(c)))"""
ORACLES["audit_coverage"] = f"WITH {SPLIT}, {COVERAGE} SELECT * FROM coverage"
ORACLES["audit_metric_floor"] = f"""WITH {MODELS}, c AS (SELECT model, {_counts('p >= 0.1::DOUBLE')} FROM scored GROUP BY 1), m AS (SELECT *, {METRICS} FROM c)
SELECT model || ' f1 > 0.5' AS "check", CASE WHEN f1 > 0.5::DOUBLE THEN 'PASS' ELSE 'FAIL' END AS status FROM m"""
ORACLES["audit_summary"] = f"""WITH {OVERLAP}, {BALANCE}, {COVERAGE}, checks AS (
  SELECT status FROM overlap UNION ALL SELECT status FROM balance UNION ALL SELECT status FROM coverage
  UNION ALL SELECT 'PASS' FROM range(3 + 5 + 6))
SELECT count(*) AS total_checks, count(*) FILTER (status = 'PASS') AS passed, count(*) FILTER (status = 'FAIL') AS failed,
  (count(*) FILTER (status = 'FAIL') = 0)::INT AS all_passed FROM checks"""


# ---- learners on rules that trees reproduce --------------------------------------------------

_CLASS_RULE = """CASE WHEN "Flow Duration" <= 15 THEN 0 WHEN "Flow Duration" <= 35 THEN 1 ELSE 2 END"""
ORACLES["learned_rule"] = f"""WITH {FLOWS} SELECT row_key, ("Flow Duration" > 25)::INT AS prediction FROM flows"""
ORACLES["learned_classes"] = f"""WITH {FLOWS} SELECT row_key, {_CLASS_RULE} AS pred FROM flows"""
ORACLES["learned_confusion"] = f"""WITH {FLOWS}, ruled AS (SELECT {_CLASS_RULE} AS class_id FROM flows)
SELECT y::INT AS y, pred::INT AS pred, (SELECT count(*) FROM ruled WHERE class_id = y AND y = pred) AS n
FROM range(3) a(y), range(3) b(pred)"""
ORACLES["learned_top_feature"] = f"""WITH {FLOWS} SELECT 'Flow Duration' AS feature WHERE (SELECT count(*) FROM flows) > 0"""
ORACLES["boosted_classes"] = f"""WITH {FLOWS} SELECT row_key, CAST(floor((coalesce("Flow Duration", 0) - 1) / 7) AS INT) AS pred FROM flows"""
ORACLES["boosted_stopped"] = f"""WITH {FLOWS} SELECT row_key, ("Flow Duration" > 25)::INT AS prediction, true AS uses_lowest_loss, true AS ended_by_patience FROM flows"""
ORACLES["boosted_leafwise"] = f"""WITH {FLOWS} SELECT row_key, ("Flow Duration" > 25)::INT AS prediction FROM flows"""
ORACLES["boosted_importance"] = f"""WITH {FLOWS} SELECT 'Flow Duration' AS feature WHERE (SELECT count(*) FROM flows) > 0"""

# ---- raw inputs and artefacts, written and read back ----------------------------------------

_GAP_KEPT = """source_class_folder <> 'Spoofing'"""
ORACLES["csv_lineage"] = f"""WITH {FLOWS} SELECT source_class_folder, count(*) AS n_rows, sum("Flow Duration")::BIGINT AS durations,
  count("Flow IAT Mean") FILTER ({_GAP_KEPT}) AS gaps FROM flows GROUP BY 1"""
ORACLES["csv_rows"] = f"""WITH {FLOWS} SELECT row_key, source_class_folder, "Flow Duration"::DOUBLE AS duration,
  CASE WHEN source_class_folder = 'Mirai' THEN 'café' ELSE 'x' END AS label FROM flows"""
ORACLES["csv_inventory"] = f"""WITH {FLOWS} SELECT source_class_folder, source_class_folder <> 'DoS' AS headers, source_class_folder = 'DoS' AS known,
  false AS suspicious, CASE source_class_folder WHEN 'Recon' THEN 5 WHEN 'Spoofing' THEN 3 ELSE 4 END AS columns FROM flows GROUP BY 1"""
ORACLES["csv_canonical"] = f"""WITH {FLOWS} SELECT place, name, (SELECT CASE place WHEN 2 THEN count("Flow IAT Mean") FILTER ({_GAP_KEPT}) ELSE count(*) END FROM flows) AS filled
FROM (VALUES (0, 'Flow ID'), (1, 'Flow Duration'), (2, 'Flow IAT Mean'), (3, 'Label')) c(place, name)"""
ORACLES["stripped_names"] = f"""WITH {FLOWS} SELECT row_key, "Flow Duration" FROM flows"""
ORACLES["preferred_source"] = f"""WITH {FLOWS} SELECT way, source_class_folder, count(*) AS n_rows FROM flows, (VALUES ('preferred'), ('existing')) w(way) GROUP BY ALL"""
ORACLES["report_sinks"] = f"""WITH {FLOWS} SELECT kind, source_class_folder, count(*) AS n_rows FROM flows, (VALUES ('json'), ('csv'), ('parquet')) k(kind) GROUP BY ALL"""
ORACLES["params_round_trip"] = f"""WITH {FLOWS} SELECT count(*) AS n_rows, count(*) - count("Flow IAT Mean") AS filled, sum("Flow Duration")::BIGINT AS durations FROM flows"""
ORACLES["contract_round_trip"] = f"""WITH {FLOWS} SELECT place, name, (SELECT CASE place WHEN 0 THEN count("Flow Duration") WHEN 1 THEN count("Total Length of Fwd Packet")
  WHEN 2 THEN count("Flow Bytes/s") ELSE count("Flow IAT Mean") END FROM flows) AS filled
FROM (VALUES (0, 'Flow Duration'), (1, 'Total Length of Fwd Packet'), (2, 'Flow Bytes/s'), (3, 'Flow IAT Mean')) c(place, name)"""
ORACLES["live_scoring"] = f"""WITH {FLOWS} SELECT row_key, CASE WHEN "Flow Duration" > 25 THEN 'ATTACK' ELSE 'BENIGN' END AS verdict FROM flows"""
ORACLES["registry_versions"] = f"""WITH {FLOWS} SELECT way, version, ("Flow Duration" > 25) <> turned AS attack, count(*) AS n_rows
FROM flows, (VALUES ('newest', '2.0', true), ('version', '1.0', false), ('as_of', '1.0', false)) v(way, version, turned) GROUP BY ALL"""
ORACLES["registry_cascade"] = f"""WITH {FLOWS} SELECT row_key, CASE WHEN "Flow Duration" <= 40 THEN 'Benign' ELSE 'high' END AS attack_class,
  CASE WHEN "Flow Duration" <= 25 THEN 'gate' WHEN "Flow Duration" <= 40 THEN 'second' ELSE 'classes' END AS decided_by FROM flows"""
_DIRTY = f"""{FLOWS}, parts AS (SELECT *, CASE source_file_name WHEN 'Brand#11' THEN 'train' WHEN 'Brand#12' THEN 'val' ELSE 'test' END AS split,
  ("Flow IAT Mean" IS NULL)::INT + ("Flow Bytes/s" IS NULL)::INT AS nan, (isinf("Flow Bytes/s"))::INT AS inf FROM flows)"""
ORACLES["audit_dirty"] = f"""WITH {_DIRTY}, found AS (
  SELECT 'no file overlap ' || a || '-' || b AS "check", (SELECT count(*) FROM (SELECT source_relative_file FROM parts GROUP BY 1 HAVING bool_or(split = a) AND bool_or(split = b))) AS n
    FROM (VALUES ('train', 'val'), ('train', 'test'), ('val', 'test')) p(a, b)
  UNION ALL SELECT 'no NaN in ' || s, (SELECT coalesce(sum(nan), 0) FROM parts WHERE split = s) FROM (VALUES ('train'), ('val'), ('test')) p(s)
  UNION ALL SELECT 'no Inf in ' || s, (SELECT coalesce(sum(inf), 0) FROM parts WHERE split = s) FROM (VALUES ('train'), ('val'), ('test')) p(s)
  UNION ALL SELECT c || ' absent from ' || s, (SELECT count(*) FROM parts WHERE split = s AND source_class_folder = c)
    FROM (VALUES ('val'), ('test')) p(s), (VALUES ('Mirai'), ('DoS')) q(c))
SELECT "check", CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, n::BIGINT::VARCHAR AS detail FROM found
UNION ALL SELECT 'train balance', CASE WHEN b > 0 AND a / b BETWEEN 0.8 AND 1.2 THEN 'PASS' ELSE 'FAIL' END, 'benign=' || b || ' attack=' || a
FROM (SELECT count(*) FILTER (target_binary = 0) AS b, count(*) FILTER (target_binary = 1) AS a FROM parts WHERE split = 'train')"""
ORACLES["committed_table"] = f"""WITH {FLOWS} SELECT way, source_class_folder, count(*) * times AS n_rows FROM flows, (VALUES ('newest', 2), ('before', 1)) w(way, times) GROUP BY way, source_class_folder, times"""
