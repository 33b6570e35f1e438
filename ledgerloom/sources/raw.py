"""Raw, all-text company records: from CSV files, and derived from the customer table for tests."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerloom.functions import names, places, records, urls
from ledgerloom.functions.text import is_blank
from ledgerloom.sources.tables import table

#: The source's columns, in file order.
CSV_COLUMNS = ("name", "id", "role", "state", "city", "industries", "sectors", "stages", "registeredOn", "registration date", "dippCertified", "companyStatus", "website", "cin", "contactNumber")

#: Raw records with all the dirt that normalization knows, in a form both Spark and DuckDB read alike.
DERIVED_SQL = """
SELECT c_custkey AS row_idx,
 CASE WHEN c_custkey % 97 = 0 THEN 'SI000001' WHEN c_custkey % 101 = 0 THEN ' ' WHEN c_custkey % 103 = 0 THEN 'NA'
      ELSE concat('SI', lpad(cast(c_custkey AS string), 6, '0')) END AS id,
 CASE WHEN c_custkey % 89 = 0 THEN 'Not Available'
      WHEN c_custkey % 11 = 0 THEN upper(concat('Acme  ', cast(cast(floor(c_custkey / 3) AS bigint) AS string), ' robotics private limited'))
      ELSE concat('Acme ', cast(cast(floor(c_custkey / 3) AS bigint) AS string), ' Robotics',
        CASE c_custkey % 6 WHEN 0 THEN ' Pvt Ltd' WHEN 1 THEN ' Private Limited' WHEN 2 THEN ' Pvt. Ltd.' WHEN 3 THEN ' LLP' WHEN 4 THEN ' P.V.T L.T.D' ELSE ' & Co' END) END AS name,
 CASE (cast(floor(c_custkey / 3) AS bigint) + CASE WHEN c_custkey % 13 = 0 THEN 1 ELSE 0 END) % 9 WHEN 0 THEN 'orissa' WHEN 1 THEN 'TAMIL  NADU' WHEN 2 THEN 'Pondicherry' WHEN 3 THEN 'Karnataka' WHEN 4 THEN 'J&K' WHEN 5 THEN 'new delhi' WHEN 6 THEN 'Dadra & Nagar Haveli' WHEN 7 THEN 'na' END AS state,
 CASE c_custkey % 8 WHEN 0 THEN 'bangalore' WHEN 1 THEN 'GURGAON' WHEN 2 THEN ' Bombay' WHEN 3 THEN 'City of Light' WHEN 4 THEN 'New Delhi' WHEN 5 THEN 'Hosur-2' WHEN 6 THEN '-' END AS city,
 CASE c_custkey % 5 WHEN 0 THEN 'Retail' WHEN 1 THEN 'AI' WHEN 2 THEN 'Finance  Technology' WHEN 3 THEN 'Fashion' ELSE 'na' END AS industries,
 CASE c_custkey % 3 WHEN 0 THEN 'Analytics' WHEN 1 THEN 'Apparel' ELSE 'Logistics' END AS sectors,
 CASE c_custkey % 4 WHEN 0 THEN 'Scaling' WHEN 1 THEN 'EarlyTraction' WHEN 2 THEN 'Validation' END AS stages,
 CASE c_custkey % 6 WHEN 0 THEN '28-02-2024' WHEN 1 THEN '2021-7-4' WHEN 2 THEN '05/03/2019' WHEN 3 THEN '12/25/2018' WHEN 4 THEN '' ELSE 'garbage' END AS registration_date_raw,
 CASE WHEN c_custkey % 6 = 4 THEN cast(1709083608634 + c_custkey * 86400000 AS string) END AS registered_on,
 CASE c_custkey % 4 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'false' WHEN 2 THEN ' Y' END AS dipp_certified,
 CASE c_custkey % 3 WHEN 0 THEN 'Active' WHEN 1 THEN 'Strike  Off' END AS company_status,
 CASE c_custkey % 7 WHEN 0 THEN concat('https://www.site', cast(cast(floor(c_custkey / 3) AS bigint) AS string), '.in/') WHEN 1 THEN concat('SITE', cast(cast(floor(c_custkey / 3) AS bigint) AS string), '.IN')
   WHEN 2 THEN concat('in.linkedin.com/company/c', cast(c_custkey AS string)) WHEN 3 THEN concat('http://dir.agg-hub.com/', cast(c_custkey AS string))
   WHEN 4 THEN 'N/A' WHEN 5 THEN concat('ftp://u@shop', cast(c_custkey AS string), '.co.in:8080/Path/') ELSE concat('.site', cast(cast(floor(c_custkey / 3) AS bigint) AS string), '.in') END AS website,
 CASE c_custkey % 5 WHEN 0 THEN concat('u14201up2023ptc', lpad(cast(cast(floor(c_custkey / 10) AS bigint) AS string), 6, '0')) WHEN 1 THEN 'ABZ-8755' ELSE '' END AS cin,
 CASE c_custkey % 6 WHEN 0 THEN concat('9555', lpad(cast(c_custkey AS string), 6, '0')) WHEN 1 THEN concat('+91 98688 ', lpad(cast(c_custkey AS string), 5, '0'))
   WHEN 2 THEN concat('00955', lpad(cast(c_custkey AS string), 7, '5')) WHEN 3 THEN '123' WHEN 4 THEN concat('+1 (743) 555-', lpad(cast(c_custkey AS string), 4, '0')) END AS contact_number,
 CASE c_custkey % 4 WHEN 0 THEN 'Startup' WHEN 1 THEN 'Investor' WHEN 2 THEN 'startup' ELSE 'Mentor' END AS role
FROM customer
"""


def read_csv(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """All columns as text with ``row_idx``, the record's place in the file; quoted line breaks and doubled quotes are kept.
    A field with nothing in it is null, and one with an empty pair of quotes is the empty text.

    A file with line breaks in quotes is read by one task; give many files to read in parallel. ``limit`` counts raw records.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in CSV_COLUMNS])
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("encoding", "UTF-8")
    # Spark takes every text that equals nullValue for null, by default also the empty one; so it is a text that no file holds
    rows = reader.option("nullValue", uuid.uuid4().hex).option("emptyValue", "").schema(schema).csv(path)
    # places in the order of file names: within a file ids grow, and counts of the files before make them dense
    rows = rows.withColumn("_id", F.monotonically_increasing_id()).withColumn("_file", F.col("_metadata.file_path")).withColumn("_at", F.col("_metadata.file_block_start"))
    sizes = rows.groupBy("_file", "_at").agg(F.count("*").alias("n"), F.min("_id").alias("_first"))
    starts = sizes.select("_file", "_at", "_first", (F.sum("n").over(Window.orderBy("_file", "_at")) - F.col("n")).alias("_start"))
    indexed = rows.join(F.broadcast(starts), ["_file", "_at"]).withColumn("row_idx", F.col("_start") + F.col("_id") - F.col("_first")).drop("_id", "_file", "_at", "_start", "_first")
    indexed = indexed.withColumnsRenamed({"industries": "industries", "registeredOn": "registered_on", "registration date": "registration_date_raw", "dippCertified": "dipp_certified", "companyStatus": "company_status", "contactNumber": "contact_number"})
    return indexed if limit is None else indexed.where(F.col("row_idx") < limit)


def derived(spark: SparkSession, folder: str) -> DataFrame:
    """Raw records derived from the customer table."""
    return spark.sql(DERIVED_SQL.replace("FROM customer", "FROM {customer}"), customer=table(spark, folder, "customer"))


def normalize(raw: DataFrame, startups_only: bool = False) -> DataFrame:
    """Raw records in the form of the master table; records without a usable name are dropped."""
    made = {
        "startup_india_id": records.source_id(F.col("id")), "name": names.display_name(F.col("name")), "name_key": names.name_key(F.col("name")), "website": urls.website(F.col("website")), "domain": urls.domain(F.col("website")),
        "industry": records.label(F.col("industries")), "sector": records.label(F.col("sectors")), "stage": records.label(F.col("stages")), "city": places.city(F.col("city")), "state": places.state(F.col("state")),
        "registration_date": records.registration_date(F.col("registration_date_raw"), F.col("registered_on")), "cin": records.cin(F.col("cin")), "dpiit": records.flag(F.col("dipp_certified")),
        "status": records.label(F.col("company_status")), "phone": records.phone(F.col("contact_number")), "role": records.label(F.col("role")),
    }
    rows = raw.where(~is_blank(F.col("name"))).select("row_idx", *(c.alias(n) for n, c in made.items()))
    return rows.where(F.lower(F.coalesce("role", F.lit(""))) == "startup") if startups_only else rows
