"""A synthetic graph of persons over the `customer` table, as SQL that Spark and DuckDB both run.

It holds repeated and second names, mixed-case usernames, all forms of profile URLs and identifiers, invalid and
unnamed records, multi-valued predicates and one predicate outside the prefix table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from twinfold.functions import vocabulary as V

_PULSE, _GME = ({p: n for n, p in V.NAMESPACES.items()}[k] for k in ("pulse:", "gme:"))

TRIPLES = f"""
WITH c AS (
  SELECT CAST(c_custkey AS INT) AS k, c_mktsegment AS seg, c_nationkey AS nk, concat('urn:person:', c_custkey) AS s,
         md5(cast(c_custkey % 70 AS varchar(9))) AS h
  FROM customer),
u AS (
  SELECT k, s, concat(substr(h,1,8),'-',substr(h,9,4),'-',substr(h,13,4),'-',substr(h,17,4),'-',substr(h,21,12)) AS uuid FROM c)
SELECT s, 0 AS pos, '{V.RDF_TYPE}' AS p,
       CASE WHEN k % 50 = 49 THEN 'http://schema.org/Organization' ELSE '{V.PERSON}' END AS o FROM c
UNION ALL SELECT s, 1, 'http://schema.org/name', concat(seg, ' ', nk) FROM c WHERE k % 41 <> 0
UNION ALL SELECT s, 2, 'http://schema.org/name', concat('Alt ', seg) FROM c WHERE k % 41 <> 0 AND k % 13 = 0
UNION ALL SELECT s, 3, 'http://schema.org/name', concat(seg, ' ', nk) FROM c WHERE k % 41 <> 0 AND k % 17 = 0
UNION ALL SELECT s, 4, '{_PULSE}githubUsername', concat(CASE WHEN k % 2 = 0 THEN 'User' ELSE 'user' END, k % 64) FROM c WHERE k % 9 = 0
UNION ALL SELECT s, 5, 'http://schema.org/url',
       concat(CASE WHEN k % 2 = 0 THEN 'http' ELSE 'https' END, '://', CASE WHEN k % 7 = 0 THEN 'www.' ELSE '' END,
              'github.com/user', k % 64, CASE WHEN k % 11 = 0 THEN '/repo' WHEN k % 5 = 0 THEN '/' ELSE '' END)
       FROM c WHERE k % 9 = 1
UNION ALL SELECT s, 6, 'http://schema.org/email', concat(CASE WHEN k % 37 = 0 THEN 'bad+' ELSE 'u' END, k, '@mail.org') FROM c WHERE k % 4 <> 0
UNION ALL SELECT s, 7, '{_PULSE}orcidIdentifier',
       concat('https://orcid.org/0000-0002-', lpad(cast(k AS varchar(9)), 4, '0'), '-', lpad(cast(k % 999 AS varchar(9)), 3, '0'), 'X')
       FROM c WHERE k % 8 = 0
UNION ALL SELECT s, 8, '{_PULSE}infosciencePersonIdentifier',
       CASE WHEN k % 2 = 0 THEN concat('https://infoscience.example/server/api/core/items/', uuid)
            ELSE concat('https://infoscience.example/entities/person/', upper(uuid)) END FROM u WHERE k % 9 IN (0, 2, 3)
UNION ALL SELECT s, 9, '{_GME}location', concat('City ', nk) FROM c WHERE k % 3 <> 0
UNION ALL SELECT s, 10, '{_PULSE}owns', concat('urn:repo:', k % 60) FROM c WHERE k % 2 = 0
UNION ALL SELECT s, 11, '{_PULSE}owns', concat('urn:repo:', k % 61) FROM c WHERE k % 4 = 0
UNION ALL SELECT s, 12, 'http://xmlns.com/foaf/0.1/nick', concat('nick', k % 10) FROM c WHERE k % 20 = 0
"""


def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_mktsegment", "c_nationkey")
    return spark.sql(TRIPLES.replace("FROM customer", "FROM {customer}"), customer=customer)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, vector, label of the `embeddings` table."""
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").selectExpr("vec_id AS id", "embedding AS vector", "label")
