"""Record views over the part table, by key arithmetic in SQL that Spark and DuckDB read alike.

Keys with k % 4 = 3 have no copies. S2 holds the other keys, S3 those with k % 4 in (0, 1); both alter the records by rules
of the key, and some keys have two copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NAME = "concat(p_name, ' ', p_brand)"
SUFFIX = "CASE k % 7 WHEN 0 THEN ' Inc' WHEN 1 THEN ' Private Limited' WHEN 2 THEN ' LLC' WHEN 3 THEN ' SARL' WHEN 4 THEN '' WHEN 5 THEN ' & Co' ELSE ' Services Corp.' END"
OTHER_SUFFIX = "CASE k % 7 WHEN 0 THEN ' Incorporated' WHEN 1 THEN ' Pvt Ltd' WHEN 2 THEN ' Company' WHEN 3 THEN ' SAS' WHEN 4 THEN ' Ltd' WHEN 5 THEN ' + Co' ELSE ' Services Corporation' END"
COUNTRY = "CASE WHEN k % 10 < 5 THEN 'US' WHEN k % 10 < 8 THEN 'India' WHEN k % 10 = 8 THEN 'France' ELSE 'Germany' END"
ADDRESS = """CASE WHEN k % 10 < 5 THEN concat(k % 97 + 1, ' Main St, Apt ', k % 13, ', Springfield ', 10000 + k % 211, CASE WHEN k % 3 = 0 THEN '-1234' ELSE '' END)
  WHEN k % 10 < 8 THEN concat('Plot No. ', k % 89 + 1, ', Market Rd, Opp Sec ', k % 7, ', Pune ', 411001 + k % 53)
  WHEN k % 10 = 8 THEN concat(k % 45 + 1, ' bis Rue de Lyon, ', 69001 + k % 9, ' Lyon')
  ELSE concat('Bldg ', k % 31, ' Ring Ave, Berlin ', 10115 + k % 77) END"""

S1 = f"SELECT concat('S1-', k) AS entity_id, concat(CASE WHEN k % 11 = 0 THEN 'LLP ' ELSE '' END, {NAME}, {SUFFIX}) AS business_name, {ADDRESS} AS business_address, {COUNTRY} AS country FROM (SELECT p_partkey AS k, p_name, p_brand FROM {{part}}) p"


def _copy(source: str, offset: int, keep: str, twice: str) -> str:
    noise = f"(k + c + {offset}) % 7"
    name = f"CASE {noise} WHEN 0 THEN upper(concat({NAME}, {SUFFIX})) WHEN 1 THEN concat({NAME}, {OTHER_SUFFIX}) WHEN 2 THEN concat(p_brand, ' ', p_name, {SUFFIX}) WHEN 3 THEN concat(substr(p_name, 1, length(p_name) - 1), ' ', p_brand, {SUFFIX}) ELSE concat({NAME}, {SUFFIX}) END"
    addr = f"CASE {noise} WHEN 4 THEN '' WHEN 5 THEN upper({ADDRESS}) ELSE {ADDRESS} END"
    country = f"CASE WHEN {noise} = 6 AND k % 10 < 5 THEN 'usa' ELSE {COUNTRY} END"
    keys = f"SELECT p_partkey AS k, 0 AS c, p_name, p_brand FROM {{part}} WHERE {keep} UNION ALL SELECT p_partkey AS k, 1 AS c, p_name, p_brand FROM {{part}} WHERE ({keep}) AND {twice}"
    return f"SELECT concat('{source}-', k * 2 + c) AS entity_id, {name} AS business_name, {addr} AS business_address, {country} AS country FROM ({keys}) p"


S2 = _copy("S2", 0, "p_partkey % 4 <> 3", "p_partkey % 5 = 0")
S3 = _copy("S3", 3, "p_partkey % 4 < 2", "p_partkey % 6 = 0")
TRUTH = "SELECT concat('S1-', p_partkey) AS s1_id, concat('S2-', p_partkey * 2 + c) AS cand_id FROM {part}, (SELECT 0 AS c UNION ALL SELECT 1 AS c) t WHERE p_partkey % 4 <> 3 AND (c = 0 OR p_partkey % 5 = 0) UNION ALL SELECT concat('S1-', p_partkey) AS s1_id, concat('S3-', p_partkey * 2 + c) AS cand_id FROM {part}, (SELECT 0 AS c UNION ALL SELECT 1 AS c) t WHERE p_partkey % 4 < 2 AND (c = 0 OR p_partkey % 6 = 0)"


def views(spark: SparkSession, sf_dir: str, dealt: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(S1 records, pool of S2 and S3 records, true pairs). dealt: the table is small beside the work on its records, so its
    rows go to as many tasks as a shuffle has."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    if dealt:
        part = part.select("p_partkey", "p_name", "p_brand").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    s1, s2, s3, truth = (spark.sql(q, part=part) for q in (S1, S2, S3, TRUTH))
    return s1, s2.unionByName(s3), truth
