"""One query per operator, over the given tables and the views derived from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailprep import fixed as X
from mailprep.functions import text as tx
from mailprep.operators import dataset as D
from mailprep.operators import explore as E
from mailprep.operators import joins as J
from mailprep.operators import language as L
from mailprep.operators import model as M
from mailprep.operators import profile as P
from mailprep.operators import schema as C
from mailprep.plans import prepare as A
from mailprep.plans import train as B
from mailprep.plans.views import case_file, case_meta, mail_file, mails, table
from mailprep.session import new_path, saved, spread
from mailprep.sources import delimited, encoding, reports, search_index, snapshot

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SEARCH = "wi[a-z]+ the|price"
SPAN = "[aeiou]n|x*"
FILE_ROWS = 10_000  # texts in one file of the encoding census
RECORD_ROWS = 2_000  # mails in one file of an ordered snapshot: a screen or two of texts


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- shared inputs ------------------------------------------------------------------------------------------

def labelled(spark: SparkSession, sf: str, wide: bool = False) -> DataFrame:
    """Mails with complaint type, language code and name: what the explorer filters."""
    m, c = mails(spark, sf, wide), case_meta(spark, sf).withColumnRenamed("id", "case_id")
    joined = J.join_metadata(m, c, "parent_id", "case_id", "left")
    return J.language_names(joined.select("id", "body", "priority", F.col("lang_hint").alias("Language"),
                                          "complaint_type"))


def clean_mails(spark: SparkSession, sf: str) -> DataFrame:
    return C.with_clean_text(mails(spark, sf, wide=True).select("id", "body"), "body", "clean")


def complaints(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned mails with a case: (id, clean, complaint_type, complaint)."""
    m = mails(spark, sf, wide=True).select("id", "parent_id", "body")
    c = case_meta(spark, sf).withColumnRenamed("id", "case_id")
    merged = C.derive_complaint_label(J.join_metadata(m, c, "parent_id", "case_id"), "complaint_type", "complaint")
    cleaned = C.with_clean_text(merged.select("id", "body", "complaint_type", "complaint"), "body", "clean")
    return C.filter_short(cleaned, "clean", X.MIN_LENGTH_PREPARE).drop("body")


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """A stand-in prediction: long texts are said to be of high quality."""
    rows = table(spark, sf, "documents").select("doc_id", "n_chars").join(table(spark, sf, "labels"), "doc_id")
    return rows.select("doc_id", F.col("quality").cast("long").alias("TrueLabel"),
                       (F.col("n_chars") > 1000).cast("long").alias("PredictedLabel")).withColumn(
        "Correct", F.col("TrueLabel") == F.col("PredictedLabel"))


def kind_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """The same with four classes."""
    rows = table(spark, sf, "documents").select("doc_id", "n_chars").join(table(spark, sf, "labels"), "doc_id")
    return rows.select("doc_id", (F.col("quality") + 2 * F.col("toxic")).cast("long").alias("TrueLabel"),
                       (F.when(F.col("n_chars") > 1000, 1).otherwise(0)
                        + F.when(F.col("n_chars") > 4000, 2).otherwise(0)).cast("long").alias("PredictedLabel"))


def on_body(fn) -> Query:
    return lambda spark, sf: mails(spark, sf, wide=True).select("id", fn(F.col("body")).alias("out"))


# --- sources and sinks ----------------------------------------------------------------------------------------

@query
def s1_read_delimited(spark, sf):
    path = new_path(spark, "mails-csv")
    delimited.write_delimited(mails(spark, sf), path, ";")
    return delimited.read_delimited(spark, path)


@query
def s2_read_snapshot(spark, sf):
    return snapshot.read_snapshot(spark, f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")


@query
def s3_write_snapshot(spark, sf):
    path = new_path(spark, "snapshot")
    snapshot.write_snapshot(C.filter_short(clean_mails(spark, sf), "clean", X.MIN_LENGTH_PREPARE), path)
    return snapshot.read_snapshot(spark, path).select("id", "clean")


@query
def s4_write_predictions(spark, sf):
    folder = new_path(spark, "predictions")
    reports.write_predictions(predictions(spark, sf), folder)
    schema = "doc_id long, TrueLabel long, PredictedLabel long, Correct boolean"
    parts = [spark.read.schema(schema).csv(f"{folder}/{name}", header=True).withColumn("file", F.lit(name))
             for name in ("test_predictions", "incorrect_predictions")]
    return parts[0].unionByName(parts[1])


def split_labels(spark, sf):
    rows = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("long").alias("label"))
    return D.split_dataset(rows, "doc_id")


@query
def s5_write_stats(spark, sf):
    folder = new_path(spark, "stats")
    reports.write_stats(D.dataset_stats(split_labels(spark, sf)), folder)
    schema = ("total long, train long, validation long, test long, "
              "splits map<string, map<string, struct<count: long, percent: double>>>")
    read = spark.read.schema(schema).json(f"{folder}/dataset_stats")
    flat = read.select("total", "train", "validation", "test", F.explode("splits").alias("split", "labels"))
    return flat.select("total", "train", "validation", "test", "split", F.explode("labels").alias("label", "share")
                       ).select("total", "train", "validation", "test", "split", "label", "share.count",
                                "share.percent")


@query
def s5_write_metrics(spark, sf):
    folder = new_path(spark, "metrics")
    reports.write_metrics(M.classification_metrics(predictions(spark, sf), 2), folder)
    return rounded(spark.read.schema("accuracy double, precision double, recall double, f1 double")
                   .json(f"{folder}/final_metrics"), "accuracy", "precision", "recall", "f1")


@query
def s6_export_distinct(spark, sf):
    path = new_path(spark, "languages")
    reports.export_distinct(table(spark, sf, "documents"), "lang", path)
    return spark.read.schema("lang string").csv(path, header=True)


@query
def s1_read_delimited_folder(spark, sf):
    """Files with the same columns in two orders."""
    path, m = new_path(spark, "mails-csv"), mails(spark, sf)
    delimited.write_delimited(m.filter("id % 2 = 0"), f"{path}/part=0", ";")
    delimited.write_delimited(m.filter("id % 2 = 1").select("body", "id", "priority", "lang_hint", "parent_id"), f"{path}/part=1", ";")
    return delimited.read_delimited(spark, f"{path}/*/*.csv")


@query
def s7_encoding_census(spark, sf):
    """Many files of bounded row counts per language; a language is what its files are together."""
    path = new_path(spark, "texts")
    docs = table(spark, sf, "documents").filter("text is not null")
    docs.select("lang", "text").write.option("maxRecordsPerFile", FILE_ROWS).partitionBy("lang").text(path)
    found = encoding.encoding_census(spark, f"{path}/lang=*/*.txt")
    files = found.select(F.regexp_extract("path", "lang=([^/]*)", 1).alias("lang"), "encoding", "confidence")
    # a mark before one file's text is a character inside the whole: only plain files are plain together
    whole = F.when(F.every(F.col("encoding") == "ascii"), F.lit("ascii")).when(
        F.some(F.col("encoding") == "Windows-1252"), F.lit("Windows-1252")).otherwise(F.lit("utf-8"))
    told = files.groupBy("lang").agg(whole.alias("encoding"))
    sure = F.when(F.col("encoding") == "ascii", 1.0).when(F.col("encoding") == "utf-8", 0.99).otherwise(0.73)
    return told.withColumn("confidence", sure)


# --- schema and predicates --------------------------------------------------------------------------------------

@query
def c1_drop_all_null_columns(spark, sf):
    return C.drop_all_null_columns(case_meta(spark, sf))


@query
def c2_normalize_nulls(spark, sf):
    return C.normalize_nulls(mails(spark, sf))


@query
def c3_find_all_null_columns(spark, sf):
    return C.find_all_null_columns(case_meta(spark, sf))


@query
def c4_drop_duplicate_columns(spark, sf):
    d, l = table(spark, sf, "documents").select("doc_id", "lang", "n_chars"), table(spark, sf, "labels")
    return C.drop_duplicate_columns(d.join(l, d["doc_id"] == l["doc_id"]))


@query
def c5_prefix_columns(spark, sf):
    return C.prefix_columns(case_meta(spark, sf))


@query
def c6_select_existing(spark, sf):
    return C.select_existing(mails(spark, sf), ["priority", "no_such_column", "body", "id"], "body")


@query
def c7_derive_complaint_label(spark, sf):
    return C.derive_complaint_label(case_meta(spark, sf), "complaint_type", "complaint").select(
        "id", "complaint_type", "complaint")


@query
def c8_pick(spark, sf):
    return C.pick(mails(spark, sf), "id", 150)


@query
def c8_pick_text_key(spark, sf):
    return C.pick(mails(spark, sf), "parent_id", 150)


@query
def c8_limit(spark, sf):
    return C.limit(mails(spark, sf), 25, "id")


@query
def c9_body_as_text(spark, sf):
    return C.with_body_text(mails(spark, sf).select("id", "body"), "body")


# --- joins ----------------------------------------------------------------------------------------------------------

@query
def j1_join_metadata(spark, sf):
    return J.join_metadata(mails(spark, sf), C.prefix_columns(case_meta(spark, sf)), "parent_id", "META_id")


@query
def j1_join_metadata_outer(spark, sf):
    """A missing priority meets the missing priority; all groups are dealt over four tasks."""
    m = mails(spark, sf).select("id", "priority")
    known = m.filter("priority IS NULL OR priority <> 'Low'").groupBy(F.col("priority").alias("known_priority")).agg(
        F.count("*").alias("mails")).unionByName(m.agg(F.lit("Urgent").alias("known_priority"),
                                                       F.count("*").alias("mails")))
    return J.join_metadata(m, known, "priority", "known_priority", "outer", salts=4)


@query
def j1_heavy_keys(spark, sf):
    """Mails by priority against themselves: the groups that take more of such a join than an average task."""
    m = mails(spark, sf).select("id", "priority")
    found = J.heavy_keys(m, m, "priority", "priority", tasks=16, least=1)
    return found.select(F.col("key").alias("priority"), "mails", "cases")


@query
def j2_language_names(spark, sf):
    return J.language_names(table(spark, sf, "documents").select("doc_id", "lang"), "lang", "lang_name_en")


@query
def j2_language_names_code_column(spark, sf):
    """A table with columns of the same names as the code list."""
    rows = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("code"), F.col("source").alias("lang_name"))
    return J.language_names(rows, "code", "name")


# --- text functions ---------------------------------------------------------------------------------------------------

QUERIES |= {
    "t1_strip_flexible_reply_header": on_body(tx.strip_flexible_reply_header),
    "t2_remove_empty_lines": on_body(tx.remove_empty_lines),
    "t3_reduce_spaces": on_body(tx.reduce_spaces),
    "t4_remove_non_printable": on_body(tx.remove_non_printable),
    "t5_remove_http_brackets": on_body(tx.remove_http_brackets),
    "t6_clean_thread_ids": on_body(tx.clean_thread_ids),
    "t7_remove_cid": on_body(tx.remove_cid),
    "t8_strip_known_reply_headers": on_body(tx.strip_known_reply_headers),
    "t9_remove_html": on_body(tx.remove_html),
    "t10_apply_discard_patterns": on_body(tx.apply_discard_patterns),
    "t11_remove_sensitive_lines": on_body(tx.remove_sensitive_lines),
    "t12_redact": on_body(tx.redact),
    "t12_redact_token": on_body(lambda c: tx.redact(c, "token")),
    "t13_clean_crlf": on_body(tx.clean_crlf),
    "t14_last_valid_sentence": on_body(tx.last_valid_sentence),
    "t15_clean_text": on_body(tx.clean_text),
    "t17_truncate_tokens": on_body(tx.truncate_tokens),
}


@query
def t9_remove_html_pages(spark, sf):
    return spread(table(spark, sf, "pages"), "page_id").select("page_id", tx.remove_html("html").alias("out"))


@query
def t15_clean_pages(spark, sf):
    return spread(table(spark, sf, "pages"), "page_id").select("page_id", tx.clean_text("html").alias("out"))


@query
def t16_filter_short(spark, sf):
    return C.filter_short(clean_mails(spark, sf), "clean", X.MIN_LENGTH_PREPARE).select("id", "clean")


# --- language -----------------------------------------------------------------------------------------------------------

def taught(key: str) -> Column:
    """One half of the documents, by a hash of their id, is for training; the other half is judged."""
    return F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(":lang"))), 1, 1) < "8"


def trained(spark, sf, half: bool = False) -> DataFrame:
    """The model of all documents; of one half only where its quality is to be measured."""
    documents = spread(table(spark, sf, "documents"), "doc_id")
    return L.language_model(documents.filter(taught("doc_id")) if half else documents, "text", "lang")


@query
def l1_detect_language(spark, sf):
    rows = clean_mails(spark, sf).select("id", "clean")
    return L.detect_language(rows, saved(trained(spark, sf), "model"), "clean").select("id", "Language", "LangName")


@query
def l1_accuracy(spark, sf):
    """How many documents of each language are told from their text, among those the model has not seen."""
    rows = spread(table(spark, sf, "documents"), "doc_id").filter(~taught("doc_id")).select("doc_id", "text", "lang")
    told = L.detect_language(rows, saved(trained(spark, sf, half=True), "model"), "text")
    return told.groupBy("lang").agg(F.count("*").alias("texts"), F.count_if(F.col("Language") == F.col("lang")).alias("right"))


@query
def l2_language_model(spark, sf):
    return trained(spark, sf)


@query
def l3_detect_language_or_unknown(spark, sf):
    rows = mails(spark, sf, wide=True).select("id", "body")
    return L.detect_language_or_unknown(rows, saved(trained(spark, sf), "model"), "body").select("id", "Language")


@query
def l4_language_distribution(spark, sf):
    named = J.language_names(table(spark, sf, "documents").select("lang"), "lang")
    return L.language_distribution(named, threshold=120)


# --- profiles -------------------------------------------------------------------------------------------------------------

def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query
def p1_shape(spark, sf):
    return P.shape(mails(spark, sf))


@query
def p2_null_counts(spark, sf):
    return P.null_counts(labelled(spark, sf))


@query
def p3_duplicate_rows(spark, sf):
    return P.duplicate_rows(table(spark, sf, "documents").select("text", "lang"))


@query
def p3_duplicate_rows_events(spark, sf):
    return P.duplicate_rows(table(spark, sf, "events"))


@query
def p4_describe_numeric(spark, sf):
    return rounded(P.describe_numeric(spread(table(spark, sf, "lineitem"), "l_orderkey")), "mean", "std", "p25", "p50", "p75", digits=4)


@query
def p5_describe_categorical(spark, sf):
    return P.describe_categorical(mails(spark, sf))


@query
def p6_distinct_counts(spark, sf):
    return P.distinct_counts(spread(table(spark, sf, "lineitem"), "l_orderkey"))


@query
def p7_small_domains(spark, sf):
    found = P.small_domains(labelled(spark, sf))
    return found.withColumn("values", F.array_join("values", "|"))


@query
def p8_value_counts(spark, sf):
    return P.value_counts(mails(spark, sf), "priority")


@query
def p8_value_counts_orders(spark, sf):
    return P.value_counts(table(spark, sf, "orders"), "o_orderpriority", dropna=True)


@query
def p9_profile(spark, sf):
    report = P.profile(labelled(spark, sf)).withColumn("values", F.array_join("values", "|"))
    return rounded(report, "mean", "std", "p25", "p50", "p75", digits=4)


# --- exploring ----------------------------------------------------------------------------------------------------------

@query
def f1_search_regex(spark, sf):
    return E.search_regex(mails(spark, sf, wide=True).select("id", "body"), SEARCH, "body")


@query
def f1_search_regex_named_group(spark, sf):
    return E.search_regex(mails(spark, sf, wide=True).select("id", "body"), r"(?P<two>[aeiou]n)(?P=two)\Z|(?P<a_1>th)e of", "body").select("id")


@query
def f2_search_text(spark, sf):
    return E.search_text(mails(spark, sf, wide=True).select("id", "body"), "exampl..com", column="body")


@query
def f2_search_text_literal(spark, sf):
    return E.search_text(mails(spark, sf, wide=True).select("id", "body"), "Example.COM", literal=True, column="body")


@query
def f2_search_indexed(spark, sf):
    """The same with a filter of trigrams per file."""
    path = new_path(spark, "indexed")
    snapshot.write_ordered(mails(spark, sf, wide=True).select("id", "body"), path, "id", RECORD_ROWS)
    search_index.write_index(spark, path, "body")
    return search_index.search(snapshot.read_snapshot(spark, path), search_index.read_index(spark, path, "body"), "exampl..com", column="body")


@query
def f3_max_length(spark, sf):
    return E.max_length(clean_mails(spark, sf), "800", "clean").select("id", "clean")


@query
def f4_filter_complaint_type(spark, sf):
    return E.filter_complaint_type(labelled(spark, sf), "Packaging", "complaint_type").select("id", "complaint_type")


@query
def f4_filter_complaint_type_missing(spark, sf):
    return E.filter_complaint_type(labelled(spark, sf), None, "complaint_type").select("id", "priority")


@query
def f5_filter_language(spark, sf):
    return E.filter_language(labelled(spark, sf), "fr").select("id", "Language", "LangName")


@query
def f6_filter_priority(spark, sf):
    return E.filter_priority(mails(spark, sf), E.MISSING, "priority").select("id", "parent_id")


@query
def f6_filter_priority_orders(spark, sf):
    return E.filter_priority(table(spark, sf, "orders"), "1-URGENT", "o_orderpriority").select(
        "o_orderkey", "o_orderpriority")


@query
def f7_facet_counts(spark, sf):
    rows = E.search_text(labelled(spark, sf, wide=True), "the", column="body")
    return E.facet_counts(rows, "complaint_type", priority_col="priority")


@query
def f8_explore(spark, sf):
    rows = C.with_clean_text(labelled(spark, sf, wide=True), "body", "clean")
    return E.explore(rows, query=SEARCH, regex=True, max_chars="4000", complaint_type=E.MISSING, language="en",
                     priority="High", body="body", clean="clean", type_col="complaint_type",
                     priority_col="priority").select("id", "clean")


@query
def f9_page(spark, sf):
    rows = E.filter_language(labelled(spark, sf), "de").select("id", "body", "Language")
    return E.page(rows, "id", 20, after=100)


@query
def f9_page_before(spark, sf):
    rows = E.filter_language(labelled(spark, sf), "de").select("id", "body", "Language")
    return E.page(rows, "id", 20, before=180)


@query
def f9_record_at(spark, sf):
    rows = E.filter_language(labelled(spark, sf), "es").select("id", "body", "Language")
    return E.record_at(rows, "id", 17)


@query
def f9_record_at_ordered(spark, sf):
    """The same by the counts of the files of a snapshot in key order."""
    path = new_path(spark, "ordered")
    snapshot.write_ordered(labelled(spark, sf).select("id", "body", "Language"), path, "id", RECORD_ROWS)
    return snapshot.record_of(E.filter_language(snapshot.read_snapshot(spark, path), "es"), "id", 17)


@query
def f10_match_spans(spark, sf):
    return E.match_spans(mails(spark, sf, wide=True), "id", SPAN, regex=True, column="body")


@query
def f9_record_at_text_key(spark, sf):
    return E.record_at(labelled(spark, sf).withColumn("key", F.md5(F.col("id").cast("string"))).select("key", "id"), "key", 123)


@query
def f10_match_spans_repeated_key(spark, sf):
    rows = mails(spark, sf, wide=True).select("priority", "body")
    return E.match_spans(rows, "priority", "e. ", column="body").groupBy("priority", "start", "end").agg(F.count("*").alias("n"))


@query
def f10_match_spans_literal(spark, sf):
    return E.match_spans(mails(spark, sf, wide=True), "id", "e. ", column="body")


# --- training rows -------------------------------------------------------------------------------------------------------

@query
def d1_binary_dataset(spark, sf):
    return D.binary_dataset(complaints(spark, sf), "clean", "complaint", keep=("id",))


@query
def d2_type_dataset(spark, sf):
    return D.type_dataset(complaints(spark, sf), "clean", "complaint_type", "complaint", keep=("id",))


@query
def d3_encode_labels(spark, sf):
    return D.encode_labels(case_meta(spark, sf).select("id", "complaint_type"), "complaint_type").withColumn(
        "label", F.col("label").cast("long"))


@query
def d3_label_mapping(spark, sf):
    mapping = D.label_mapping(case_meta(spark, sf), "complaint_type")
    return mapping.withColumn("label", F.col("label").cast("long"))


@query
def d4_split_dataset(spark, sf):
    return D.split_dataset(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")


@query
def d5_dataset_stats(spark, sf):
    rows = D.encode_labels(table(spark, sf, "documents").select("doc_id", "lang"), "lang")
    mapping = D.label_mapping(table(spark, sf, "documents"), "lang")
    stats = D.dataset_stats(D.split_dataset(rows, "doc_id"), mapping)
    return stats.withColumn("label", F.col("label").cast("long"))


@query
def d6_class_weights(spark, sf):
    train = split_labels(spark, sf).filter("split = 'train'")
    return rounded(D.class_weights(train), "weight", digits=9)


# --- models ---------------------------------------------------------------------------------------------------------------

def model_parts(spark, sf):
    rows = saved(D.binary_dataset(complaints(spark, sf), "clean", "complaint", keep=("id",)), "rows")
    parts = D.split_dataset(rows, "id")
    parts = saved(parts, "split")
    return [parts.filter(F.col("split") == s) for s in D.SPLITS]


@query
def m1_train_classifier(spark, sf):
    train, _, test = model_parts(spark, sf)
    model = M.train_classifier(train, 2, "clean", max_iter=10)
    return checked_score(M.score(model, test, "clean"), 2)


def checked_score(scored: DataFrame, classes: int) -> DataFrame:
    """What holds for any model: every test row is scored, with a class there is, and judged rightly."""
    return scored.select("id", "TrueLabel", F.col("PredictedLabel").between(0, classes - 1).alias("known_class"),
                         (F.col("Correct") == (F.col("TrueLabel") == F.col("PredictedLabel"))).alias("judged"))


@query
def m1_confusion(spark, sf):
    """What the classifier says of the test mails, by what they are."""
    train, _, test = model_parts(spark, sf)
    return M.confusion(M.score(M.train_classifier(train, 2, "clean", max_iter=10), test, "clean"))


def by_language(spark, sf):
    """Documents with the number of their language, which their words tell: classes that a classifier can part."""
    rows = D.encode_labels(table(spark, sf, "documents").filter("text is not null").select("doc_id", "text", "lang"), "lang")
    return saved(D.split_dataset(rows, "doc_id"), "split")


@query
def m2_history(spark, sf):
    """Validation score after every round of one training that goes on from round to round."""
    parts = by_language(spark, sf)
    train, val = (parts.filter(F.col("split") == s) for s in D.SPLITS[:2])
    _, history = M.select_best(train, val, parts.select("label").distinct().count(), "text", rounds=(1, 2, 4, 8))
    return spark.createDataFrame(history, "iterations long, f1 double")


@query
def m3_predictions(spark, sf):
    """The language that the words of each test document are judged to be in."""
    parts = by_language(spark, sf)
    model = M.train_classifier(parts.filter("split = 'train'"), parts.select("label").distinct().count(), "text", max_iter=8)
    return M.score(model, parts.filter("split = 'test'").drop("split"), "text").select("doc_id", "TrueLabel", "PredictedLabel", "Correct")


@query
def m2_select_best(spark, sf):
    """The model chosen scores as the best round did."""
    train, val, _ = model_parts(spark, sf)
    model, history = M.select_best(train, val, 2, "clean", rounds=(5, 10))
    again = M.classification_metrics(M.score(model, val, "clean"), 2)
    return again.select(F.lit(len(history)).cast("long").alias("rounds"),
                        (F.abs(F.col("f1") - max(v for _, v in history)) < 1e-9).alias("is_best"))


@query
def m3_score_types(spark, sf):
    rows = saved(D.type_dataset(complaints(spark, sf), "clean", "complaint_type", "complaint", keep=("id",)), "rows")
    parts = saved(D.split_dataset(D.encode_labels(rows, "complaint_type"), "id"), "split")
    classes = parts.select("label").distinct().count()
    model = M.train_classifier(parts.filter("split = 'train'"), classes, "clean", max_iter=10)
    return checked_score(M.score(model, parts.filter("split = 'test'"), "clean"), classes)


@query
def m3_argmax(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", M.argmax("embedding").alias("best"))


@query
def m4_metrics_binary(spark, sf):
    return rounded(M.classification_metrics(predictions(spark, sf), 2), "accuracy", "precision", "recall", "f1")


@query
def m4_metrics_macro(spark, sf):
    return rounded(M.classification_metrics(kind_predictions(spark, sf), 4), "accuracy", "precision", "recall", "f1")


@query
def m5_errors(spark, sf):
    return M.errors(predictions(spark, sf))


@query
def m6_confusion(spark, sf):
    return M.confusion(kind_predictions(spark, sf))


# --- whole jobs --------------------------------------------------------------------------------------------------------------

@query
def prepare_mails(spark, sf):
    model = saved(trained(spark, sf), "model")
    return A.prepare(mail_file(spark, sf), case_file(spark, sf), model, keep=("MailId",))


@query
def train_complaint_types(spark, sf):
    snap = saved(A.prepare(mail_file(spark, sf), case_file(spark, sf), keep=("MailId",)), "snapshot")
    _, scored = B.train_complaint_types(snap, "MailId")
    return checked_score(scored.withColumnRenamed("MailId", "id"), 4)


@query
def complaints_by_priority(spark, sf):
    """Complaints per priority among the mails long enough to judge."""
    rows = A.prepare(mail_file(spark, sf), case_file(spark, sf), keep=("MailId",))
    return rows.groupBy("Priority").agg(F.count("*").alias("mails"), F.sum("Complaint").alias("complaints"))
