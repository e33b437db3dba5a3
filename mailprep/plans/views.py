"""Mail and case tables derived from the given tables, one SQL text for both engines.

The given documents hold no reply headers, banners or contact lines; ``mails`` wraps each text in one of twelve
such forms, chosen by its id. One mail in thirteen is one more that is missing, empty or the word nan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mailprep.session import spread

MAILS = """
SELECT d.doc_id AS id, CAST(d.doc_id AS VARCHAR(20)) AS parent_id, CAST(d.lang AS VARCHAR(20)) AS lang_hint,
 CASE CAST(d.doc_id % 4 AS INT) WHEN 0 THEN 'High' WHEN 1 THEN 'Medium' WHEN 2 THEN 'Low' ELSE NULL END AS priority,
 CASE CAST(d.doc_id % 12 AS INT)
 WHEN 0 THEN d.text
 WHEN 1 THEN concat('From: a@b.com',chr(10),'Sent: Monday',chr(10),'To: c@d.org',chr(10),'Subject: case ',d.doc_id,chr(10),d.text)
 WHEN 2 THEN concat(substr(d.text,1,40),chr(10),'Van: Jan',chr(10),'Verzonden: ma',chr(10),'Aan: Piet',chr(10),d.text)
 WHEN 3 THEN concat('Hi',chr(10),'-----Original Message-----',chr(10),d.text)
 WHEN 4 THEN concat('On Monday Bob wrote: ',d.text)
 WHEN 5 THEN concat('<p>',d.text,'</p>',chr(10),'[cid:image001.png@01D]',chr(10),'<br/>end')
 WHEN 6 THEN concat(d.text,chr(10),'[https://ex.com/a?b=1]',chr(10),'thread::abc123::',chr(10),'Subject: x [ thread::q9:: ]')
 WHEN 7 THEN concat(d.text,chr(10),'bob@example.com',chr(10),'+32 123 456 789',chr(10),'Manager',chr(10),'www.example.com',chr(10),'12 street north')
 WHEN 8 THEN concat(d.text,chr(13),chr(10),chr(9),'  ',chr(10),chr(10),'tail','ZWSP',' x')
 WHEN 9 THEN concat('ATTENTION: This is an external email. Be safe.',chr(10),d.text,chr(10),'Please consider the environment before printing this email.')
 WHEN 10 THEN concat('intro',chr(10),'From: x',chr(10),'Sent: y',chr(10),'Importance: High',chr(10),'To: z',chr(10),'Subject: w',chr(10),d.text)
 ELSE d.text END AS body
FROM {documents} d
UNION ALL
SELECT -1 - d.doc_id, CAST(d.doc_id AS VARCHAR(20)), CAST(d.lang AS VARCHAR(20)),
 CASE CAST(d.doc_id % 4 AS INT) WHEN 0 THEN 'High' WHEN 1 THEN 'Medium' WHEN 2 THEN 'Low' ELSE NULL END,
 CASE CAST(d.doc_id % 36 AS INT) WHEN 11 THEN NULL WHEN 23 THEN '' ELSE 'nan' END
FROM {documents} d WHERE d.doc_id % 12 = 11
""".replace("ZWSP", "​")  # Spark's chr() stops at 255

CASE_META = """
SELECT CAST(l.doc_id AS VARCHAR(20)) AS id,
 CASE WHEN l.doc_id % 7 = 0 THEN NULL WHEN l.doc_id % 7 = 1 THEN 'Not applicable' WHEN l.doc_id % 7 = 2 THEN ' not applicable '
 WHEN l.toxic = 1 THEN 'Service' WHEN l.quality = 0 THEN 'Quality' WHEN l.doc_id % 7 = 3 THEN 'Logistics' ELSE 'Packaging' END AS complaint_type,
 CAST(NULL AS VARCHAR(20)) AS all_null_col
FROM {labels} l
"""

# the mail and case files as an export would hold them
MAIL_FILE = """
SELECT m.id AS MailId, m.parent_id AS ParentId, m.body AS TextBody, m.priority AS Priority, m.lang_hint AS Subject,
 c.complaint_type AS AGR_Type_of_Complaint__c, c.all_null_col AS AGR_Root_Cause__c
FROM {mails} m LEFT JOIN {case_meta} c ON m.parent_id = c.id
"""
CASE_FILE = """
SELECT CAST(l.doc_id AS VARCHAR(20)) AS Id, concat('user', l.quality, '@example.com') AS SuppliedEmail,
 CAST(NULL AS VARCHAR(20)) AS Closed
FROM {labels} l
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mails(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    """``wide`` spreads a single-task scan over all cores, for work on the texts."""
    documents = table(spark, sf_dir, "documents")
    return spark.sql(MAILS, documents=spread(documents, "doc_id") if wide else documents)


def case_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CASE_META, labels=table(spark, sf_dir, "labels"))


def mail_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(MAIL_FILE, mails=mails(spark, sf_dir, wide=True), case_meta=case_meta(spark, sf_dir))


def case_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CASE_FILE, labels=table(spark, sf_dir, "labels"))
