"""Checking SQL for the registered queries, in the dialect of DuckDB.

Written on its own, from the definition of each operator: it shares with the
Spark code only the fixed values and the parameters of the fixture.
"""

from __future__ import annotations

from .fixture import CENTERS, MIXTURE, RELIABILITY_LABELS, SHORT_LABELS, ZONE_LABELS

# --- common table expressions ---------------------------------------------------

RAW = """
li AS (
  SELECT l_orderkey, CAST(COUNT(*) AS INTEGER) AS sam, MAX(l_shipdate) AS last_ship
  FROM lineitem GROUP BY l_orderkey
),
towers AS (
  SELECT CAST(o.o_orderkey AS BIGINT) AS index,
    CASE WHEN o.o_orderkey % 97 = 0 THEN 'WIFI'
         WHEN o.o_orderpriority = '1-URGENT' THEN 'NR'
         WHEN o.o_orderpriority = '2-HIGH' THEN 'LTE'
         WHEN o.o_orderpriority = '3-MEDIUM' THEN 'UMTS'
         WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN 'GSM'
         ELSE 'CDMA' END AS radio,
    CAST(500 + c.c_nationkey AS INTEGER) AS MCC,
    CAST(o.o_custkey % 20 AS INTEGER) AS MNC,
    CAST(o.o_orderkey % 997 AS INTEGER) AS TAC,
    CAST(o.o_orderkey * 7 AS BIGINT) AS CID,
    CAST(o.o_custkey % 4 AS INTEGER) AS unit,
    CAST(90 + (o.o_custkey * 37 % 5600) / CAST(100 AS DOUBLE) AS FLOAT) AS LON,
    CAST(-12 + (o.o_orderkey * 53 % 4100) / CAST(100 AS DOUBLE) AS FLOAT) AS LAT,
    CAST(o.o_orderkey * 131 % 9000 AS INTEGER) AS RANGE,
    li.sam AS SAM,
    CAST(1 AS INTEGER) AS changeable,
    CAST(epoch(o.o_orderdate) AS BIGINT) + CAST(725846400 AS BIGINT) AS created,
    CAST(epoch(li.last_ship) AS BIGINT) + CAST(725846400 AS BIGINT) AS updated,
    CAST(0 AS INTEGER) AS averageSignal,
    CASE c.c_nationkey % 14
      WHEN 0 THEN 'Indonesia' WHEN 1 THEN 'Malaysia' WHEN 2 THEN 'Thailand'
      WHEN 3 THEN 'Vietnam' WHEN 4 THEN 'Philippines' WHEN 5 THEN 'Singapore'
      WHEN 6 THEN 'Myanmar' WHEN 7 THEN 'Cambodia' WHEN 8 THEN 'Laos'
      WHEN 9 THEN 'Brunei' WHEN 10 THEN 'East Timor' ELSE n.n_name END AS Country,
    CASE WHEN o.o_custkey % 31 = 0 THEN 'Bad_Net'
         ELSE CONCAT('Operator ', CAST(o.o_custkey % 9 AS VARCHAR)) END AS Network,
    'Asia' AS Continent
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN li ON li.l_orderkey = o.o_orderkey
)"""

COUNTRY = """Country IN ('Brunei', 'Cambodia', 'East Timor', 'Indonesia', 'Laos', 'Malaysia',
  'Myanmar', 'Philippines', 'Singapore', 'Thailand', 'Vietnam')"""
NULLS = """radio IS NOT NULL AND MCC IS NOT NULL AND MNC IS NOT NULL AND TAC IS NOT NULL
  AND LON IS NOT NULL AND NOT isnan(LON) AND LAT IS NOT NULL AND NOT isnan(LAT)
  AND RANGE IS NOT NULL AND SAM IS NOT NULL AND Country IS NOT NULL AND Network IS NOT NULL
  AND created IS NOT NULL AND updated IS NOT NULL"""
ZEROS = "MCC <> 0 AND MNC <> 0 AND TAC <> 0 AND SAM <> 0 AND RANGE <> 0"
PATTERNS = r"""regexp_matches(Country, '^[a-zA-Z\s]{2,}$')
  AND regexp_matches(Network, '^[a-zA-Z0-9\s\-\.\&\+\(\)\/]{2,}$')"""
DECIMALS = r"""length(regexp_extract(CAST(abs(LON) AS VARCHAR), '\.(\d+)', 1)) >= 2
  AND length(regexp_extract(CAST(abs(LAT) AS VARCHAR), '\.(\d+)', 1)) >= 2"""
BOX = "LON BETWEEN 90 AND 145 AND LAT BETWEEN -11 AND 28"
ORDERED = "updated >= created"
RADIO = "radio IN ('GSM', 'UMTS', 'LTE', 'NR', 'CDMA')"
STEPS = {
    "country": COUNTRY,
    "nulls": NULLS,
    "zeros": ZEROS,
    "patterns": PATTERNS,
    "decimals": DECIMALS,
    "technical": f"{BOX} AND {ORDERED} AND {RADIO}",
}

CLEAN = f"""{RAW},
clean AS (
  SELECT index, radio, MCC, MNC, TAC, CID, unit, LON, LAT, RANGE, SAM, created, updated, Country, Network
  FROM towers WHERE {' AND '.join(f'({test})' for test in STEPS.values())}
)"""

GENERATION = """CASE radio WHEN 'GSM' THEN '2G' WHEN 'CDMA' THEN '2G' WHEN 'UMTS' THEN '3G'
  WHEN 'LTE' THEN '4G' WHEN 'NR' THEN '5G' END"""
AGE = """CASE WHEN updated > 1715360400 THEN CAST(0 AS DOUBLE)
  ELSE (1715360400 - updated) / CAST(86400 AS DOUBLE) END"""

RICH = f"""{CLEAN},
rich AS (
  SELECT clean.*, {AGE} AS data_age_days,
    CAST(year(make_timestamp(created * 1000000)) AS INTEGER) AS created_year,
    CAST(year(make_timestamp(updated * 1000000)) AS INTEGER) AS updated_year,
    LON AS LON_VIS, LAT AS LAT_VIS, {GENERATION} AS generasi,
    CASE WHEN RANGE < 1000 THEN 'Urban' WHEN RANGE <= 5000 THEN 'Suburban' ELSE 'Rural' END AS jangkauan,
    CASE WHEN SAM >= 10 THEN 'high' WHEN SAM >= 3 THEN 'medium' ELSE 'low' END AS keandalan_data
  FROM clean
)"""


def minmax(column: str) -> str:
    value = f"CAST({column} AS DOUBLE)"
    low, high = f"min({value}) OVER ()", f"max({value}) OVER ()"
    return f"CASE WHEN {high} = {low} THEN 0.5 ELSE ({value} - {low}) / ({high} - {low}) END"


UNIT = f"""{RICH},
unit_space AS (
  SELECT rich.*, {minmax('LON')} AS lon_s, {minmax('LAT')} AS lat_s, {minmax('RANGE')} AS range_s,
    {minmax('SAM')} AS sam_s, {minmax('data_age_days')} AS age_s
  FROM rich
)"""


def squared(center: tuple[float, ...], columns: tuple[str, ...]) -> str:
    return " + ".join(f"({c} - {at}::DOUBLE) * ({c} - {at}::DOUBLE)" for c, at in zip(columns, center))


def nearest(dims: int) -> str:
    """Position of the least distance, the first of equals."""
    columns = ("lon_s", "lat_s", "range_s")[:dims]
    values = ", ".join(squared(center[:dims], columns) for center in CENTERS)
    return f"CAST(list_position([{values}], list_min([{values}])) - 1 AS INTEGER)"


LEAST_DISTANCE = "list_min([" + ", ".join(squared(c, ("lon_s", "lat_s", "range_s")) for c in CENTERS) + "])"


def density(part, scale: float = 1.0) -> str:
    weight, (mean1, mean2), (var1, cov, var2) = part
    det = f"({var1}::DOUBLE * {var2} - {cov}::DOUBLE * {cov})"
    u, v = f"(sam_s - {mean1}::DOUBLE)", f"(age_s - {mean2}::DOUBLE)"
    form = f"({var2}::DOUBLE * {u} * {u} - 2 * {cov}::DOUBLE * {u} * {v} + {var1}::DOUBLE * {v} * {v}) / {det}"
    return (
        f"(2.220446049250313e-16 + {weight / scale!r}::DOUBLE * exp(-0.5 * {form})"
        f" / (2 * pi() * sqrt({det})))"
    )


DENSITIES = ", ".join(f"{density(part)} AS d{i}" for i, part in enumerate(MIXTURE))
D_LIST = "[d0, d1, d2, d3, d4]"

ZONED = f"""{UNIT},
zoned AS (SELECT *, {nearest(3)} AS prediction FROM unit_space)"""

DENSE = f"""{ZONED},
dense AS (SELECT *, {DENSITIES} FROM zoned)"""

LABELLED = f"""{DENSE},
labelled AS (
  SELECT *, CAST(list_position({D_LIST}, list_max({D_LIST})) - 1 AS INTEGER) AS gmm_cluster FROM dense
)"""

CLASSIFIED = f"""{LABELLED},
classified AS (
  SELECT *, CAST(prediction AS DOUBLE) AS target_label, CAST({nearest(2)} AS DOUBLE) AS prediction_rf
  FROM labelled
)"""


def ranks(column: str, source: str) -> str:
    return f"""
  SELECT {column}, CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS DOUBLE) AS place
  FROM {source} WHERE {column} IS NOT NULL GROUP BY {column}"""


def indexed(source: str) -> str:
    return f"""
rank_radio AS ({ranks('radio', source)}),
rank_country AS ({ranks('Country', source)}),
rank_generation AS ({ranks('generasi', source)}),
rank_coverage AS ({ranks('jangkauan', source)}),
indexed AS (
  SELECT t.*, a.place AS radio_index, b.place AS country_index,
    c.place AS generasi_index, d.place AS jangkauan_index
  FROM {source} t JOIN rank_radio a ON t.radio = a.radio JOIN rank_country b ON t.Country = b.Country
    JOIN rank_generation c ON t.generasi = c.generasi JOIN rank_coverage d ON t.jangkauan = d.jangkauan
)"""


def draw(purpose: str) -> str:
    digest = f"substr(md5('{purpose}-42:' || CAST(index AS VARCHAR)), 1, 13)"
    return f"(CAST(CAST('0x' || {digest} AS BIGINT) AS DOUBLE) / 4503599627370496)"


MIX_SWEEP = f"""{UNIT},
sweep AS (""" + " UNION ALL ".join(
    f"SELECT CAST({k} AS INTEGER) AS k, sum(ln("
    + " + ".join(density(part, sum(p[0] for p in MIXTURE[:k])) for part in MIXTURE[:k])
    + ")) AS log_likelihood, count(*) AS n FROM unit_space"
    for k in (2, 3, 4, 5)
) + ")"

OPERATOR_REPORT = f"""{LABELLED},
report AS (
  SELECT Country, Network, gmm_cluster, count(*) AS tower_count
  FROM labelled GROUP BY Country, Network, gmm_cluster
)"""

PAIRS = f"""{CLASSIFIED},
classes AS (
  SELECT class, sum(support) AS support, sum(predicted) AS predicted, sum(hits) AS hits FROM (
    SELECT target_label AS class, 1 AS support, 0 AS predicted, 0 AS hits FROM classified
    UNION ALL SELECT prediction_rf, 0, 1, 0 FROM classified
    UNION ALL SELECT target_label, 0, 0, 1 FROM classified WHERE target_label = prediction_rf
  ) GROUP BY class
)"""


def scores(source: str = "classes") -> str:
    return f"""
measured AS (
  SELECT class, support, hits,
    CASE WHEN predicted = 0 THEN 0 ELSE hits / CAST(predicted AS DOUBLE) END AS prec,
    CASE WHEN support = 0 THEN 0 ELSE hits / CAST(support AS DOUBLE) END AS rec,
    CASE WHEN support + predicted = 0 THEN 0
         ELSE 2 * hits / CAST(support + predicted AS DOUBLE) END AS f1
  FROM {source}
)"""


METRICS = """SELECT round(sum(hits) / CAST(sum(support) AS DOUBLE), 6) AS accuracy,
  round(sum(prec * support) / sum(support), 6) AS weighted_precision,
  round(sum(rec * support) / sum(support), 6) AS weighted_recall,
  round(sum(f1 * support) / sum(support), 6) AS f1 FROM measured"""


def degrees(column: str) -> str:
    return f"round(CAST({column} AS DOUBLE), 4) AS {column}"


POINT = f"{degrees('LON')}, {degrees('LAT')}"
PLACE = f"index, radio, {POINT}, Country, Network"
BASE = (
    f"index, radio, MCC, MNC, TAC, CID, unit, {POINT}, RANGE, SAM, created, updated, Country, Network"
)
RICH_COLUMNS = f"""round(data_age_days, 6) AS data_age_days, created_year, updated_year,
  {degrees('LON_VIS')}, {degrees('LAT_VIS')}, generasi, jangkauan"""

SILHOUETTE = """
sums AS (
  SELECT c, count(*) AS n, sum(sq) AS psi, {sums} FROM points GROUP BY c
),
mean_distance AS (
  SELECT p.id, p.c = s.c AS own, s.n,
    (s.n * p.sq + s.psi - 2 * ({dot})) / CASE WHEN p.c = s.c THEN greatest(s.n - 1, 1) ELSE s.n END AS d
  FROM points p, sums s
),
both_sides AS (
  SELECT id, max(d) FILTER (WHERE own) AS a, min(d) FILTER (WHERE NOT own) AS b,
    max(n) FILTER (WHERE own) AS n FROM mean_distance GROUP BY id
)
SELECT round(avg(CASE WHEN n = 1 OR a = b THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette
FROM both_sides"""

ORACLES: dict[str, str] = {}


def sql(name: str, ctes: str, body: str) -> None:
    ORACLES[name] = f"WITH {ctes}\n{body}" if ctes else body


# --- sources and sinks ----------------------------------------------------------

sql("s1_csv_scan", RAW, f"SELECT index, radio, {POINT}, RANGE, CAST(updated AS DOUBLE) AS updated, Country FROM towers WHERE radio <> 'WIFI'")
sql("s1_csv_bad_rows", RAW, "SELECT radio = 'WIFI' AS bad, count(*) AS rows FROM towers GROUP BY 1")
READABLE = {"malformed": "radio <> 'WIFI'", **STEPS}
READ_FUNNEL = ["SELECT CAST(0 AS INTEGER) AS step_no, 'raw' AS step, count(*) AS rows FROM towers"]
for number, step in enumerate(READABLE, start=1):
    passed = " AND ".join(f"({test})" for test in list(READABLE.values())[:number])
    READ_FUNNEL.append(f"SELECT {number}, '{step}', count(*) FROM towers WHERE {passed}")
READ_FUNNEL.append("SELECT 8, 'written', count(*) FROM clean")
READ_FUNNEL.append("SELECT 9, 'quarantined', count(*) FROM towers WHERE radio = 'WIFI'")
sql("s1_quarantine_funnel", CLEAN, "\nUNION ALL ".join(READ_FUNNEL))
sql("s1_quarantined_rows", RAW, "SELECT index, radio, CAST(18 AS INTEGER) AS fields FROM towers WHERE radio = 'WIFI'")
sql("s2_parquet_scan", CLEAN, f"SELECT index, radio, {POINT}, Network FROM clean")
sql("s3_parquet_sink", CLEAN,
    "SELECT Country, count(*) AS rows, CAST(sum(RANGE) AS BIGINT) AS range_sum FROM clean GROUP BY Country")
OWNERSHIP = """SELECT 'Asia Tenggara' AS region, Country, Network, tower_count,
  round(tower_count * 100.0::DOUBLE / sum(tower_count) OVER (PARTITION BY Country), 6) AS percentage_share
  FROM (SELECT Country, Network, count(*) AS tower_count FROM clean GROUP BY Country, Network)"""
sql("s4_report_sink", CLEAN, OWNERSHIP)
TOP3 = """SELECT Country, Network, tower_count, CAST(place AS INTEGER) AS rank FROM (
    SELECT Country, Network, count(*) AS tower_count,
      row_number() OVER (PARTITION BY Country ORDER BY count(*) DESC, Network) AS place
    FROM clean GROUP BY Country, Network) WHERE place <= 3"""
sql("s5_report_read", CLEAN, TOP3)
sql("s6_preview", CLEAN, f"SELECT index, radio, {POINT}, Country FROM clean ORDER BY index LIMIT 20")
sql("s6_row_counts", RAW, """SELECT 'rows' AS name, count(*) AS rows FROM towers
  UNION ALL SELECT 'radio', count(radio) FROM towers
  UNION ALL SELECT 'SAM', count(SAM) FROM towers
  UNION ALL SELECT 'updated', count(updated) FROM towers""")

# --- filters --------------------------------------------------------------------

for name, test in {
    "f1_filter_in": COUNTRY,
    "f3_drop_nulls": NULLS,
    "f4_filter_nonzero": ZEROS,
    "f5_filter_matches": PATTERNS,
    "f6_filter_decimals": DECIMALS,
    "f7_filter_bbox": BOX,
    "f8_filter_ordered": ORDERED,
    "f9_filter_radio": RADIO,
}.items():
    sql(name, RAW, f"SELECT {PLACE} FROM towers WHERE 1 = 1 AND {test}")

sql("f2_drop_columns", RAW, f"""SELECT {BASE} FROM (
  SELECT * REPLACE (CAST(SAM AS DOUBLE) AS SAM, CAST(updated AS DOUBLE) AS updated) FROM towers)""")
FUNNEL = ["SELECT CAST(0 AS INTEGER) AS step_no, 'raw' AS step, count(*) AS rows FROM towers"]
for number, step in enumerate(STEPS, start=1):
    passed = " AND ".join(f"({test})" for test in list(STEPS.values())[:number])
    FUNNEL.append(f"SELECT {number}, '{step}', count(*) FROM towers WHERE {passed}")
sql("f10_quality_funnel", RAW, "\nUNION ALL ".join(FUNNEL))
ORACLES["f10_funnel_of_staged_rows"] = ORACLES["f10_quality_funnel"]
sql("f11_clean_towers", CLEAN, f"SELECT {BASE} FROM clean")
sql("f12_project", CLEAN, """SELECT index AS tower_id, radio AS technology,
  CAST(RANGE AS DOUBLE) AS radius_m, CAST(SAM AS BIGINT) AS samples FROM clean""")
sql("f13_constant_column", CLEAN, "SELECT 'Asia Tenggara' AS region, index, Country FROM clean")

# --- scalar features ------------------------------------------------------------

sql("e1_data_age", RICH, "SELECT index, updated, round(data_age_days, 6) AS data_age_days FROM rich")
sql("e2_years", RICH, "SELECT index, created_year, updated_year FROM rich")
sql("e3_generation", RAW, f"SELECT index, radio, {GENERATION} AS generasi FROM towers")
sql("e4_coverage", RICH, "SELECT index, RANGE, jangkauan FROM rich")
sql("e5_reliability", RICH, "SELECT index, SAM, keandalan_data FROM rich")
sql("e6_display_coords", RICH, f"SELECT index, {degrees('LON_VIS')}, {degrees('LAT_VIS')} FROM rich")
sql("e7_enrich", RICH, f"SELECT {BASE}, {RICH_COLUMNS}, keandalan_data FROM rich")

# --- encoding -------------------------------------------------------------------

sql("x1_frequency_index", f"{RICH},{indexed('rich')}",
    "SELECT index, radio_index, country_index, generasi_index, jangkauan_index FROM indexed")
sql("x2_assemble", CLEAN, """SELECT index, round(CAST(LON AS DOUBLE), 4) AS v0,
  round(CAST(LAT AS DOUBLE), 4) AS v1, CAST(RANGE AS DOUBLE) AS v2 FROM clean""")
sql("x3_assemble_skip", RAW, """SELECT index, CAST(SAM AS DOUBLE) AS v0, CAST(updated AS DOUBLE) AS v1
  FROM towers WHERE SAM IS NOT NULL AND updated IS NOT NULL""")
sql("x4_minmax", CLEAN, f"""SELECT index, round({minmax('MCC')}, 6) AS v0,
  round({minmax('RANGE')}, 6) AS v1, round({minmax('CID')}, 6) AS v2 FROM clean""")
sql("x5_feature_vectors", UNIT, """SELECT index, round(lon_s, 6) AS s0, round(lat_s, 6) AS s1,
  round(range_s, 6) AS s2, round(sam_s, 6) AS r0, round(age_s, 6) AS r1 FROM unit_space""")
sql("x5_identity_features", CLEAN, f"""SELECT index, round({minmax('MCC')}, 6) AS i0,
  round({minmax('MNC')}, 6) AS i1, round({minmax('unit')}, 6) AS i2 FROM clean""")
sql("x6_preprocess", f"{UNIT},{indexed('unit_space')}", f"""SELECT {BASE}, {RICH_COLUMNS},
  radio_index, country_index, generasi_index, jangkauan_index,
  round(lon_s, 6) AS spatial_0, round(lat_s, 6) AS spatial_1, round(range_s, 6) AS spatial_2,
  round(lon_s, 6) AS predict_0, round(lat_s, 6) AS predict_1, round(range_s, 6) AS predict_2,
  round(sam_s, 6) AS reliable_0, round(age_s, 6) AS reliable_1 FROM indexed""")

# --- descriptive reports --------------------------------------------------------

sql("a1_category_share", RICH, """SELECT generasi, count(*) AS count,
  round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS percentage FROM rich GROUP BY generasi""")
sql("a2_count_by", CLEAN, "SELECT Country, Network, count(*) AS tower_count FROM clean GROUP BY ALL")
sql("a3_top_k_per_group", CLEAN, TOP3)
MODERN = """SELECT Country, count(*) AS total_towers,
  round(count(*) FILTER (WHERE radio IN ('LTE', 'NR')) * 100.0::DOUBLE / count(*), 6) AS modernization_percentage,
  round(avg(data_age_days), 6) AS avg_data_age_days FROM rich GROUP BY Country"""
sql("a4_modernisation", RICH, MODERN)
sql("a5_ownership_hierarchy", CLEAN, OWNERSHIP)
sql("a6_yearly_growth", RICH, "SELECT created_year, count(*) AS count FROM rich GROUP BY created_year")
DOMINANT = """SELECT Network, Country, cnt FROM (
    SELECT Network, Country, count(*) AS cnt, rank() OVER (PARTITION BY Network ORDER BY count(*) DESC) AS place
    FROM clean GROUP BY Network, Country) WHERE place = 1"""
sql("a7_dominant_value", CLEAN, DOMINANT)
LARGEST = """SELECT t.Network, t.total_menara_asean,
  h.Country AS Negara_Dominan
  FROM (SELECT Network, count(*) AS total_menara_asean FROM clean GROUP BY Network) t
  JOIN home h ON t.Network = h.Network
  ORDER BY t.total_menara_asean DESC, t.Network, h.Country LIMIT 10"""
sql("a8_top_operators", f"{CLEAN}, home AS ({DOMINANT})", LARGEST)
sql("a_reports_from_cells", f"{RICH}, home AS ({DOMINANT})", f"""
SELECT 'share' AS report, generasi AS item,
  round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS value FROM rich GROUP BY generasi
UNION ALL SELECT 'top', Country || '|' || Network, rank::DOUBLE FROM ({TOP3})
UNION ALL SELECT 'modernisation', Country, modernization_percentage FROM ({MODERN})
UNION ALL SELECT 'ownership', Country || '|' || Network, percentage_share FROM ({OWNERSHIP})
UNION ALL SELECT 'growth', created_year::VARCHAR, count(*)::DOUBLE FROM rich GROUP BY created_year
UNION ALL SELECT 'operators', Network || '|' || Negara_Dominan, total_menara_asean::DOUBLE FROM ({LARGEST})""")
sql("a9_distinct_values", ZONED, "SELECT DISTINCT prediction FROM zoned")
sql("a10_join_models", LABELLED, """SELECT z.index, z.Country, z.SAM, z.prediction, r.gmm_cluster
  FROM labelled z JOIN labelled r ON z.index = r.index""")

ORACLES["a10_join_bucketed"] = ORACLES["a10_join_models"]
ORACLES["a_reports_from_batches"] = ORACLES["a_reports_from_cells"]

# --- zones ----------------------------------------------------------------------

# What SQL cannot know of a trained model is a property that must hold for any
# well-trained one; counts, draws and folds are computed here.
sql("k1_kmeans_zones", CLEAN, "SELECT index, Country, true AS in_nearest_zone FROM clean")
sql("k1_zone_check", CLEAN, """SELECT count(*) AS towers, CAST(0 AS BIGINT) AS out_of_range,
  CAST(0 AS BIGINT) AS not_nearest, CAST(5 AS BIGINT) AS zones, true AS better_than_fixed FROM clean""")
sql("k2_kmeans_sweep", CLEAN, f"""SELECT unnest([2, 3, 4, 5]) AS k,
  (SELECT count(*) FROM clean WHERE {draw('sample')} < 0.1::DOUBLE) AS sample_rows,
  true AS in_range, true AS first_best_is_marked, true AS cost_follows, true AS silhouette_follows""")
sql("k3_silhouette", f"""{ZONED},
points AS (
  SELECT index AS id, prediction AS c, lon_s, lat_s, range_s,
    lon_s * lon_s + lat_s * lat_s + range_s * range_s AS sq FROM zoned
),""" + SILHOUETTE.format(
    sums="sum(lon_s) AS y0, sum(lat_s) AS y1, sum(range_s) AS y2",
    dot="p.lon_s * s.y0 + p.lat_s * s.y1 + p.range_s * s.y2",
).split("SELECT round")[0], "SELECT round" + SILHOUETTE.split("SELECT round")[1])
sql("k3_silhouette_embeddings", """
items AS (
  SELECT vec_id AS id, label AS c, unnest(range(64)) AS i, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings
),
cluster_sums AS (SELECT c, i, sum(x) AS y FROM items GROUP BY c, i),
points AS (SELECT id, c, sum(x * x) AS sq FROM items GROUP BY id, c),
sums AS (SELECT c, count(*) AS n, sum(sq) AS psi FROM points GROUP BY c),
dots AS (SELECT a.id, s.c, sum(a.x * s.y) AS dot FROM items a JOIN cluster_sums s ON a.i = s.i GROUP BY a.id, s.c),
mean_distance AS (
  SELECT p.id, p.c = s.c AS own, s.n,
    (s.n * p.sq + s.psi - 2 * d.dot) / CASE WHEN p.c = s.c THEN greatest(s.n - 1, 1) ELSE s.n END AS d
  FROM dots d JOIN points p ON p.id = d.id JOIN sums s ON s.c = d.c
),
both_sides AS (
  SELECT id, max(d) FILTER (WHERE own) AS a, min(d) FILTER (WHERE NOT own) AS b,
    max(n) FILTER (WHERE own) AS n FROM mean_distance GROUP BY id
)""", "SELECT round" + SILHOUETTE.split("SELECT round")[1])
sql("k4_wssse", UNIT, f"SELECT round(sum({LEAST_DISTANCE}), 6) AS wssse FROM unit_space")
sql("k5_assign_nearest", ZONED,
    f"SELECT index, prediction, round({LEAST_DISTANCE}, 6) AS squared_distance FROM zoned")
sql("k6_lloyd_step", ZONED, """SELECT prediction, round(avg(lon_s), 6) AS lon_s, round(avg(lat_s), 6) AS lat_s,
  round(avg(range_s), 6) AS range_s, count(*) AS towers FROM zoned GROUP BY prediction""")
sql("k7_cluster_sizes", ZONED, "SELECT prediction, count(*) AS count FROM zoned GROUP BY prediction")
sql("k8_cluster_stats", ZONED, """SELECT prediction, round(avg(CAST(LAT AS DOUBLE)), 4) AS avg_lat,
  round(avg(CAST(LON AS DOUBLE)), 4) AS avg_lon, round(avg(RANGE), 4) AS avg_range_radius,
  round(avg(SAM), 4) AS avg_sample_count, count(*) AS total_tower FROM zoned GROUP BY prediction""")
sql("k_profiles_from_batches", ZONED, """SELECT prediction, round(avg(CAST(LAT AS DOUBLE)), 4) AS avg_lat,
  round(avg(CAST(LON AS DOUBLE)), 4) AS avg_lon, round(avg(RANGE), 4) AS avg_range_radius,
  round(avg(SAM), 4) AS avg_sample_count, count(*) AS total_tower, min(RANGE) AS RANGE_min, max(RANGE) AS RANGE_max,
  min(SAM) AS SAM_min, max(SAM) AS SAM_max FROM zoned GROUP BY prediction""")
sql("k9_cluster_hierarchy", ZONED,
    "SELECT prediction, Country, Network, count(*) AS count FROM zoned GROUP BY prediction, Country, Network")
sql("k10_cluster_generations", ZONED,
    "SELECT prediction, generasi, count(*) AS count FROM zoned GROUP BY prediction, generasi")
sql("k11_cluster_coverage", ZONED,
    "SELECT prediction, jangkauan, count(*) AS count FROM zoned GROUP BY prediction, jangkauan")
sql("k12_sample_rows", CLEAN, f"SELECT index, Country FROM clean WHERE {draw('sample')} < 0.1::DOUBLE")
sql("k13_sample_n", ZONED, f"""SELECT {degrees('LAT')}, {degrees('LON')}, prediction, Country, Network FROM zoned
  ORDER BY {draw('sample')}, index LIMIT 10000""")
sql("k13_exact_sample", CLEAN, f"SELECT index, Country FROM clean ORDER BY {draw('sample')}, index LIMIT 500")

# --- reliability ----------------------------------------------------------------

sql("g1_gmm_reliability", CLEAN, "SELECT index, true AS one_in_all, true AS label_is_largest FROM clean")
sql("g2_gmm_sweep", CLEAN, """SELECT unnest([2, 3, 4, 5]) AS k, (SELECT count(*) FROM clean) AS n,
  true AS first_best_is_marked, true AS fitness_follows, true AS criteria_follow""")
sql("g1_membership_check", CLEAN,
    "SELECT count(*) AS towers, CAST(0 AS BIGINT) AS not_one, CAST(0 AS BIGINT) AS not_largest FROM clean")
sql("g3_log_likelihood", DENSE,
    "SELECT round(sum(ln(d0 + d1 + d2 + d3 + d4)), 4) AS log_likelihood FROM dense")
sql("g4_bic", MIX_SWEEP, """SELECT n, k, round(log_likelihood, 4) AS log_likelihood,
  round((2 * k + k - 1) * ln(n) - 2 * log_likelihood, 4) AS bic,
  round((2 * k + 3 * k + k - 1) * ln(n) - 2 * log_likelihood, 4) AS bic_full FROM sweep""")
sql("g5_responsibilities", LABELLED, "SELECT index, " + ", ".join(
    f"round(d{i} / (d0 + d1 + d2 + d3 + d4), 6) AS p{i}" for i in range(5)) + ", gmm_cluster FROM labelled")
sql("g6_sweep_summary", MIX_SWEEP, """SELECT n, k, round(log_likelihood, 4) AS log_likelihood,
  row_number() OVER (ORDER BY log_likelihood DESC, k) = 1 AS is_best FROM sweep""")
sql("g7_reliability_profile", LABELLED, """SELECT gmm_cluster, round(avg(SAM), 6) AS avg_sam,
  round(avg(data_age_days), 6) AS avg_days_old, count(*) AS tower_count FROM labelled GROUP BY gmm_cluster""")
sql("g8_operator_reliability", OPERATOR_REPORT, "SELECT * FROM report")

# --- classification -------------------------------------------------------------

CROSS = """SELECT prediction, gmm_cluster, count(index) AS tower_count, round(avg(SAM), 6) AS avg_sam,
  round(avg(data_age_days), 6) AS avg_days_old, round(avg(RANGE), 6) AS avg_range_radius
  FROM labelled GROUP BY prediction, gmm_cluster"""
sql("r1_cross_profile", LABELLED, CROSS)
sql("r2_rf_features", f"{LABELLED},{indexed('labelled')}", """SELECT index, CAST(SAM AS DOUBLE) AS f0,
  round(data_age_days, 6) AS f1, radio_index AS f2, country_index AS f3, generasi_index AS f4,
  jangkauan_index AS f5, CAST(gmm_cluster AS DOUBLE) AS f6, CAST(prediction AS DOUBLE) AS target_label
  FROM indexed""")
sql("r3_split", CLEAN,
    f"SELECT index, CASE WHEN {draw('split')} < 0.8::DOUBLE THEN 'train' ELSE 'test' END AS part FROM clean")
sql("r7_classification_metrics", f"{PAIRS},{scores()}", METRICS)
sql("r7_label_metrics", f"""
classes AS (
  SELECT class, sum(support) AS support, sum(predicted) AS predicted, sum(hits) AS hits FROM (
    SELECT quality AS class, 1 AS support, 0 AS predicted, 0 AS hits FROM labels
    UNION ALL SELECT toxic, 0, 1, 0 FROM labels
    UNION ALL SELECT quality, 0, 0, 1 FROM labels WHERE quality = toxic
  ) GROUP BY class
),{scores()}""", METRICS)
sql("r8_confusion_matrix", CLASSIFIED, "SELECT target_label, " + ", ".join(
    f'count(*) FILTER (WHERE prediction_rf = {i}) AS "{i}.0"' for i in range(5)
) + " FROM classified GROUP BY target_label")
EXPORT = f"""SELECT index, {degrees('LAT')}, {degrees('LON')}, Country, Network, radio, generasi, jangkauan,
  RANGE, SAM, round(data_age_days, 6) AS data_age_days, prediction AS kmeans_target_cluster, gmm_cluster,
  prediction_rf AS rf_predicted_cluster FROM classified"""
sql("r9_prediction_report", CLASSIFIED, EXPORT)
sql("r4_fit_forest", CLEAN, f"""SELECT CAST(50 AS INTEGER) AS trees, CAST(7 AS INTEGER) AS features,
  true AS depth_fits, true AS importances_fit, count(*) AS training_rows FROM clean WHERE {draw('split')} < 0.8::DOUBLE""")
sql("r5_cross_validate", CLEAN, f"""SELECT CAST(floor({draw('fold')} * 5) AS INTEGER) AS fold, count(*) AS rows,
  true AS fold_follows, true AS mean_follows, true AS above_majority FROM clean WHERE {draw('split')} < 0.8::DOUBLE GROUP BY 1""")
sql("r6_score", ZONED, f"""SELECT index, CAST(prediction AS DOUBLE) AS target_label, true AS one_in_all,
  true AS largest_is_predicted FROM zoned WHERE {draw('split')} >= 0.8::DOUBLE""")
sql("r10_model_reload", CLEAN, f"""SELECT count(*) AS towers, CAST(0 AS BIGINT) AS differing,
  CAST(0 AS BIGINT) AS zones_differing, CAST(0 AS BIGINT) AS clusters_differing
  FROM clean WHERE {draw('split')} >= 0.8::DOUBLE""")

# --- run metrics ----------------------------------------------------------------

sql("m1_run_metrics", MIX_SWEEP, """
, best AS (SELECT * FROM sweep ORDER BY log_likelihood DESC, k LIMIT 1)
SELECT 'one' AS run_id, 'GMM' AS experiment, 'GMM_K_' || CAST(k AS VARCHAR) AS run_name, kind, key, value FROM (
  SELECT k, 'param' AS kind, 'k' AS key, CAST(k AS DOUBLE) AS value FROM sweep
  UNION ALL SELECT k, 'metric', 'log_likelihood', round(log_likelihood, 4) FROM sweep)
UNION ALL SELECT 'one', 'GMM', 'Final_Best_GMM', 'param', 'best_k', CAST(k AS DOUBLE) FROM best
UNION ALL SELECT 'one', 'GMM', 'Final_Best_GMM', 'metric', 'log_likelihood', round(log_likelihood, 4) FROM best""")
sql("m2_best_run", MIX_SWEEP, """SELECT 'one' AS run_id, 'GMM' AS experiment, 'GMM_K_' || CAST(k AS VARCHAR) AS run_name,
  round(log_likelihood, 4) AS value FROM sweep
  ORDER BY log_likelihood DESC, k LIMIT 1""")

# --- dashboard views ------------------------------------------------------------



def named(column: str, labels: dict[int, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {code} THEN '{label}'" for code, label in labels.items()) + " END"


ZONE_NAME = named("prediction", ZONE_LABELS)
LONG_NAME = named("gmm_cluster", RELIABILITY_LABELS)
SHORT_NAME = named("gmm_cluster", SHORT_LABELS)
SHORT_NAME_BUT_LAST = named("gmm_cluster", {code: label for code, label in SHORT_LABELS.items() if code != 4})


def tree(source: str, path: list[str], value: str) -> str:
    """One SELECT per level."""
    levels = []
    for depth in range(1, len(path) + 1):
        columns = ", ".join(
            name if at < depth else f"CAST(NULL AS VARCHAR) AS {name}" for at, name in enumerate(path)
        )
        levels.append(
            f"SELECT {columns}, CAST({depth} AS INTEGER) AS level, CAST(sum({value}) AS BIGINT) AS {value} "
            f"FROM {source} GROUP BY {', '.join(path[:depth])}"
        )
    return " UNION ALL ".join(levels)


sql("d1_operator_tree", f"{CLEAN}, report AS ({OWNERSHIP})",
    tree("report", ["region", "Country", "Network"], "tower_count"))
sql("d2_zone_tree", f"""{ZONED}, report AS (
  SELECT {ZONE_NAME} AS Cluster_Name, Country, Network, count(*) AS count FROM zoned GROUP BY ALL)""",
    tree("report", ["Cluster_Name", "Country", "Network"], "count"))
sql("d3_label_map", LABELLED, f"""SELECT gmm_cluster, {LONG_NAME} AS gmm_cluster_name,
  {SHORT_NAME_BUT_LAST} AS gmm_cluster_short, count(*) AS tower_count
  FROM labelled GROUP BY gmm_cluster""")
sql("d4_country_reliability", LABELLED, f"""SELECT Country, gmm_cluster,
  {SHORT_NAME} AS gmm_cluster_short,
  count(*) AS tower_count FROM labelled GROUP BY Country, gmm_cluster""")
sql("d5_slice_all", OPERATOR_REPORT, "SELECT * FROM report")
sql("d5_slice_country", OPERATOR_REPORT, "SELECT * FROM report WHERE Country = 'Indonesia'")
sql("d5_slice_both", OPERATOR_REPORT, "SELECT * FROM report WHERE Country = 'Thailand' AND gmm_cluster = 1")
sql("d6_filter_choices", OPERATOR_REPORT, "SELECT DISTINCT Country FROM report")
sql("d7_classification_report", f"{PAIRS},{scores()}", """
SELECT CAST(class AS VARCHAR) AS label, round(prec, 6) AS precision, round(rec, 6) AS recall,
  round(f1, 6) AS f1_score, CAST(support AS BIGINT) AS support FROM measured
UNION ALL SELECT 'accuracy', round(sum(hits) / CAST(sum(support) AS DOUBLE), 6),
  round(sum(hits) / CAST(sum(support) AS DOUBLE), 6), round(sum(hits) / CAST(sum(support) AS DOUBLE), 6),
  CAST(sum(support) AS BIGINT) FROM measured
UNION ALL SELECT 'macro avg', round(avg(prec), 6), round(avg(rec), 6), round(avg(f1), 6),
  CAST(sum(support) AS BIGINT) FROM measured
UNION ALL SELECT 'weighted avg', round(sum(prec * support) / sum(support), 6),
  round(sum(rec * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
  CAST(sum(support) AS BIGINT) FROM measured""")
sql("d8_crosstab", CLASSIFIED,
    "SELECT target_label, prediction_rf, count(*) AS count FROM classified GROUP BY target_label, prediction_rf")
sql("d9_class_distribution", CLASSIFIED, """
SELECT 'target' AS source, target_label AS class, count(*) AS count FROM classified GROUP BY target_label
UNION ALL SELECT 'predicted', prediction_rf, count(*) FROM classified GROUP BY prediction_rf""")
sql("d10_heatmap", LABELLED, """SELECT 'Cluster ' || CAST(prediction AS VARCHAR) AS prediction,
  'GMM ' || CAST(gmm_cluster AS VARCHAR) AS gmm_cluster, count(index) AS tower_count
  FROM labelled GROUP BY 1, 2""")
sql("d11_first_rows", CLASSIFIED, EXPORT + " ORDER BY index LIMIT 100")
sql("d12_share_within", ZONED, """SELECT prediction, generasi, count(*) AS count,
  round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY prediction), 6) AS percentage
  FROM zoned GROUP BY prediction, generasi""")
sql("d13_display", OPERATOR_REPORT, f"""SELECT Country AS country, Network AS operator, gmm_cluster AS cluster,
  {LONG_NAME} AS "cluster name", tower_count AS towers FROM report""")
