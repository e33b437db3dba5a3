"""Readers and writers, the whole preparation from files, streams, and plan shapes."""

import json
import os
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mailprep import fixed as X
from mailprep.operators import dataset as D
from mailprep.operators import explore as E
from mailprep.operators import joins as J
from mailprep.operators import language as L
from mailprep.functions import text as tx
from mailprep.operators import schema as C
from mailprep.plans import prepare as A
from mailprep.plans import queries
from mailprep.plans import train as B
from mailprep.plans import views as V
from mailprep.session import broadcast_if_small, saved, shared_dir, spread
from mailprep import __main__ as command
from mailprep.sources import delimited, encoding, reports, search_index, snapshot
from mailprep.streaming import clean_stream
from tests.conftest import SF_DIR


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def put(folder, name, content, encoding="utf-8"):
    path = folder / name
    path.write_bytes(content if isinstance(content, bytes) else content.encode(encoding))
    return str(path)


# --- delimited files ---------------------------------------------------------------------------------------------

def test_read_delimited(spark, tmp_path):
    path = put(tmp_path, "a.csv", 'Id;A;B;A\n1;"x;y ""q""\r\nz"; NA;b\n2;NA;"";n/a\n3;short\n4; p ;nan;None\n')
    df = delimited.read_delimited(spark, path)
    assert df.columns == ["Id", "A", "B", "A.1"]
    assert {t for _, t in df.dtypes} == {"string"}
    assert rows(df) == [("1", 'x;y "q"\r\nz', " NA", "b"), ("2", None, None, None), ("3", "short", None, None),
                        ("4", " p ", None, None)]


def test_read_delimited_in_splits(spark, tmp_path):
    path = put(tmp_path, "many.csv", "A;B\n" + "".join(f'{i};"x;{i}"\n' for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4000)
    df = delimited.read_delimited(spark, path, multi_line=False)
    assert df.rdd.getNumPartitions() > 5 and rows(df) == sorted(((str(i), f"x;{i}") for i in range(3000)), key=str)
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


CELLS = ["x", "", "a;b", 'say ""hi""', "one\ntwo", "\n", "\n\n\n;", '""', "é\n😀", "long " * 30, "line\n" * 40, ' "" \n "" ', "\r\nx", "tail\n"]


@pytest.mark.parametrize("split", [60, 200, 1000, 1 << 27])
def test_quoted_cells_over_splits(spark, tmp_path, split):
    """The same rows as the reader that takes a file whole, wherever splits fall."""
    rng = random.Random(split)
    for f in range(4):
        lines = []
        for i in range([0, 1, 60, 60][f]):
            cells = [f"{f}.{i}"]
            for _ in range(2):
                c = rng.choice(CELLS)
                cells.append(rng.choice([f'"{c}"', f'"{c}"', f'"{c}"odd', 'un"quoted', '5" x "', ""]))
            lines.append(";".join(cells[:rng.choice([3, 3, 3, 2])]))
        text = "\n".join(["K;A;B", *lines]) + rng.choice(["", "\n", "\n\n"])
        put(tmp_path, f"{f}.csv", text)
    put(tmp_path, "open.csv", 'K;A;B\no1;x;y\no2;"never\nclosed;z\n\nend')
    whole = spark.read.csv(str(tmp_path), header=True, sep=";", multiLine=True, quote='"', escape='"', enforceSchema=True, schema="K string, A string, B string",
                           ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, nullValue="")
    want = sorted(((r[0], *[None if c in X.MISSING_CELLS else c for c in r[1:]]) for r in whole.collect()), key=str)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        df = delimited.read_delimited(spark, str(tmp_path))
        assert rows(df) == want
        assert split > 100 or df.rdd.getNumPartitions() > 20
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_quoted_cells_without_broadcast(spark, tmp_path, monkeypatch):
    text = "K;A\r\n" + "".join(f'{i};"a\r\n{i}\r\n"\r\n' for i in range(300))
    put(tmp_path, "a.csv", text)
    put(tmp_path, "b.csv", "A;K\n" + "".join(f'"b\r\n{i}";{i}\n' for i in range(300)))
    monkeypatch.setattr(delimited, "MAX_BROADCAST_SPLITS", 0)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 500)
    df = delimited.read_delimited(spark, str(tmp_path))
    got = rows(df.select("K", "A"))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted([(str(i), f"a\n{i}\n") for i in range(300)] + [(str(i), f"b\r\n{i}") for i in range(300)], key=str)


def test_many_headers_in_one_job(spark, tmp_path):
    """However many files there are, the same jobs run."""
    def jobs(n):
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            put(folder, f"{i}.csv", f"K;A\n{i};x\n")
        spark.sparkContext.setJobGroup(f"files{n}", "")
        df = delimited.read_delimited(spark, str(folder))
        assert df.count() == n
        spark.sparkContext.setJobGroup("", "")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"files{n}"))

    assert jobs(150) <= jobs(3) + 3


def test_read_delimited_problems(spark, tmp_path, capsys):
    assert delimited.read_delimited(spark, str(tmp_path / "none.csv")) is None
    assert "not found" in capsys.readouterr().out
    path = put(tmp_path, "long.csv", "A;B\n1;2\n1;2;3\n")
    with pytest.raises(Exception, match="more than 2 fields"):
        delimited.read_delimited(spark, path).collect()


def test_write_delimited_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", 'a "b";\r\nc, d'), ("2", "\n"), ("3", " x ")], "k string, t string")
    delimited.write_delimited(df, str(tmp_path / "out"), ";")
    assert rows(delimited.read_delimited(spark, str(tmp_path / "out"))) == rows(df)


def test_encodings(spark, tmp_path):
    files = {"ascii": b"plain", "utf-8": "héllo".encode(), "Windows-1252": "héllo".encode("cp1252"),
             "UTF-8-SIG": "x".encode("utf-8-sig"), "UTF-16": "x".encode("utf-16"), "UTF-32": "x".encode("utf-32")}
    for name, content in files.items():
        put(tmp_path, name + ".txt", content)
    put(tmp_path, "cut.txt", "a" * 99_999 + "é" * 10)
    put(tmp_path, "empty.txt", b"")
    got = {os.path.basename(r["path"])[:-4]: r["encoding"] for r in encoding.encoding_census(spark, str(tmp_path)).collect()}
    assert got == {**{n: n for n in files}, "cut": "utf-8"}


@pytest.mark.parametrize("split", [7, 64, 1 << 27])
def test_census_in_splits(spark, tmp_path, split):
    """Wherever splits fall, a file is judged as the whole of it."""
    rng = random.Random(split)
    want = {}
    for i in range(24):
        text = "".join(rng.choice(["a", "é", "😀", "\n", "\r\n", "x" * 20]) for _ in range(rng.choice([1, 5, 90])))
        kind = rng.choice(["utf-8", "utf-8-sig", "utf-16", "cp1252", "ascii"])
        raw = text.encode(kind, "ignore")
        put(tmp_path, f"{i}.txt", raw)
        try:
            whole = "ascii" if raw.isascii() else "utf-8" if raw.decode() is not None else ""
        except UnicodeDecodeError:
            whole = "Windows-1252"
        want[f"{i}.txt"] = {"utf-8-sig": "UTF-8-SIG", "utf-16": "UTF-16"}.get(kind, whole)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    got = {os.path.basename(r["path"]): r["encoding"] for r in encoding.encoding_census(spark, str(tmp_path)).collect()}
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {n: w for n, w in want.items() if (tmp_path / n).stat().st_size}


def test_census_of_samples(spark, tmp_path):
    put(tmp_path, "cut.txt", "a" * 99 + "é" * 10)
    put(tmp_path, "late.txt", b"a" * 200 + b"\xff")
    got = {os.path.basename(r["path"]): r["encoding"] for r in encoding.encoding_census(spark, str(tmp_path), 100).collect()}
    assert got == {"cut.txt": "utf-8", "late.txt": "ascii"}


def test_census_of_a_large_language(spark, tmp_path, monkeypatch):
    rows = spark.range(300).select(F.when(F.col("id") == 299, "é").otherwise("e").alias("text"), F.lit("en").alias("lang"))
    rows = rows.union(spark.range(5).select(F.lit("x"), F.lit("de"))).union(spark.range(3).select(F.lit("\ufeffx"), F.lit("fr")))
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(queries, "new_path", lambda spark, name: str(tmp_path / name))
    monkeypatch.setattr(queries, "FILE_ROWS", 50, raising=False)
    got = sorted(tuple(r) for r in queries.s7_encoding_census(spark, str(tmp_path)).collect())
    assert got == [("de", "ascii", 1.0), ("en", "utf-8", 0.99), ("fr", "utf-8", 0.99)]
    files = list((tmp_path / "texts" / "lang=en").glob("*.txt"))
    assert len(files) >= 6 and all(len(f.read_text().splitlines()) <= 50 for f in files)


def test_reports(spark, tmp_path):
    pred = spark.createDataFrame([("a,\"b\"\nc", 1, 1, True), ("d", 0, 1, False)],
                                 "t string, TrueLabel long, PredictedLabel long, Correct boolean")
    reports.write_predictions(pred, str(tmp_path))
    read = lambda n: spark.read.csv(str(tmp_path / n), header=True, multiLine=True, escape='"')
    assert rows(read("test_predictions")) == [('a,"b"\nc', "1", "1", "true"), ("d", "0", "1", "false")]
    assert rows(read("incorrect_predictions")) == [("d", "0", "1", "false")]
    parts = spark.createDataFrame([("train", 0)] * 2 + [("train", 1)] + [("test", 1)], "split string, label long")
    reports.write_stats(D.dataset_stats(parts), str(tmp_path))
    part = next(p for p in (tmp_path / "dataset_stats").iterdir() if p.suffix == ".json")
    assert json.loads(part.read_text()) == {
        "total": 4, "train": 3, "validation": 0, "test": 1,
        "splits": {"train": {"0": {"count": 2, "percent": 66.67}, "1": {"count": 1, "percent": 33.33}},
                   "test": {"1": {"count": 1, "percent": 100.0}}}}
    reports.export_distinct(spark.createDataFrame([("en",), ("en",), (None,)], "l string"), "l", str(tmp_path / "l"))
    assert rows(spark.read.csv(str(tmp_path / "l"), header=True)) == [("en",)]


# --- snapshots in order and the index of searches -----------------------------------------------------------------

def files_read(df):
    """How many files the scan of a query opened; the query is run for it."""
    nodes = [df._jdf.queryExecution().executedPlan()]
    df._jdf.queryExecution().executedPlan().executeCollect()
    while nodes:
        node = nodes.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            nodes.append(node.executedPlan())
        metric = node.metrics().get("numFiles")
        if metric.isDefined():
            return metric.get().value()
        if node.nodeName().endswith("QueryStage"):
            nodes.append(node.plan())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]


@pytest.fixture(scope="module")
def ordered(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ordered") / "s")
    df = spark.range(1000).select(F.when(F.col("id") > 0, F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 4, "0"))).alias("key"),
                                  F.concat(F.lit("mail about order no. "), "id", F.lit(" x")).alias("body"), (F.col("id") % 3).alias("third"))
    snapshot.write_ordered(df.repartition(5, "third"), path, "key", 40)
    search_index.write_index(spark, path, "body")
    return path


def test_records_of_an_ordered_snapshot(spark, ordered):
    df, places = snapshot.read_snapshot(spark, ordered), snapshot.read_order(spark, ordered)
    assert df.count() == 1000 and places.count() >= 25 and places.agg(F.max("rows")).first()[0] <= 40
    for k in (1, 2, 40, 41, 517, 1000):
        got = snapshot.record_of(df, "key", k, places)
        assert got.first()["key"] == (None if k == 1 else f"k{k - 1:04}") and tuple(got.first())[-2:] == (k, 1000)
        assert files_read(got) == 1
    some = df.filter("third = 1")
    for k in (1, 100, 333):
        got = snapshot.record_of(some, "key", k)
        assert got.first() == E.record_at(some, "key", k).first() and files_read(got) == 1
    for k in (0, 1001):
        with pytest.raises(ValueError):
            snapshot.record_of(df, "key", k, places)
    with pytest.raises(ValueError):
        snapshot.record_of(df.filter("third = 9"), "key", 1)


@pytest.mark.parametrize("query, regex, literal, few", [
    ("no. 517 x", False, True, True), ("NO. 517", False, False, True), ("order no\\. 51[0-9]{1} x", True, False, True), ("no. \u0130x|517 x", True, False, False),
    ("absent words", False, True, True), ("Mai[l]+ abou?t", True, False, False), ("ORDER", False, True, False), ("51", False, False, False), ("", False, False, False),
    ("\u0130\u0131\u017f\u212a", False, False, True), ("日本語", False, True, False), ("a[\\]b]17 x", True, False, False)])
def test_search_by_index(spark, ordered, query, regex, literal, few):
    df, index = snapshot.read_snapshot(spark, ordered), search_index.read_index(spark, ordered, "body")
    want = E.search_regex(df, query, "body") if regex else E.search_text(df, query, literal, "body")
    got = search_index.search(df, index, query, regex, literal, "body")
    assert rows(got) == rows(want) == rows(search_index.search(df, None, query, regex, literal, "body"))
    assert (files_read(got.select("*")) < 6) == few


def test_index_folds_case_and_knows_missing_texts(spark, tmp_path):
    path = str(tmp_path / "s")
    texts = ["\u0130stanbul \u212aelvin", "mi\u017f\u017fing", None, "", "ab", "𝄞𝄞𝄞 clef", "NaN"]
    spark.createDataFrame(list(enumerate(texts)), "id int, body string").repartition(4).write.parquet(path)
    search_index.write_index(spark, path, "body")
    df, index = snapshot.read_snapshot(spark, path), search_index.read_index(spark, path, "body")
    for query in ("istanbul", "KELVIN", "missing", "nan", "ab", "clef", "𝄞 clef", "iSTan.*kel"):
        for regex, literal in ((True, False), (False, False), (False, True)):
            want = E.search_regex(df, query, "body") if regex else E.search_text(df, query, literal, "body")
            assert rows(search_index.search(df, index, query, regex, literal, "body")) == rows(want)
    df.filter("id = 0").withColumn("body", F.lit("a later file")).write.mode("append").parquet(path)
    later = snapshot.read_snapshot(spark, path)
    assert search_index.search(later, index, "later file", column="body").count() == 1


def test_needed_strings():
    for query, want in [("abc", ["abc"]), ("a.c*de", ["a", "de"]), (r"a\.b", ["a.b"]), ("ab?c{2,3}def$", ["a", "def"]), ("a|bcd", []), ("(abc)", []),
                        (r"\d+ abc\b", [" abc"]), (r"abc\Z", []), (r"[abc]def[^x]g", ["def", "g"]), ("[a[b]]cde", []), (r"[\]ab]cd", []), ("[]a]bc", [])]:
        assert search_index.needed(query) == want
    assert search_index.needed("a.(b", literal=True) == ["a.(b"]


def test_commands_on_an_ordered_snapshot(spark, tmp_path):
    df = spark.createDataFrame([(f"m{i}", f"Header order {i}", f"order {i}", "Quality", 1, "en", "English", "High" if i % 2 else "Low") for i in range(20)],
                               f"MailId string, {X.BODY} string, {X.CLEAN_BODY} string, {X.COMPLAINT_TYPE} string, {X.COMPLAINT} long, "
                               "Language string, LangName string, Priority string")
    path = str(tmp_path / "s")
    snapshot.write_ordered(df, path, "MailId", 4)
    search_index.write_index(spark, path, X.BODY)
    saved_rows = snapshot.read_snapshot(spark, path)

    def got(*given):
        args = command.parsed(["explore", path, "out", "--key", "MailId", *given])
        with_order = command.found(saved_rows, args, snapshot.read_order(spark, path), search_index.read_index(spark, path, args.body))
        assert rows(with_order) == rows(command.found(df, args))
        return with_order

    one = got("--record", "3").first().asDict()
    assert one == {"position": 3, "total": 20, "MailId": "m10", X.COMPLAINT_TYPE: "Quality", X.COMPLAINT: 1, "Language": "en",
                   "LangName": "English", "Priority": "Low", X.BODY: "Header order 10", X.CLEAN_BODY: "order 10"}
    assert got("--record", "2", "--priority", "High").first()["total"] == 10
    assert got("--query", "header order 7").count() == 1 and got("--query", "order 1", "--record", "4").first()["total"] == 11
    assert snapshot.read_order(spark, str(tmp_path)) is None and search_index.read_index(spark, path, X.CLEAN_BODY) is None
    with pytest.raises(SystemExit):
        command.parsed(["prepare", "a", "b", "c", "--ordered"])


# --- the whole way -----------------------------------------------------------------------------------------------------

BODY = "this is a mail about the broken box that came too late and we want our money back please answer us soon. " * 2


def test_prepare_files(spark, tmp_path):
    mails = put(tmp_path, "mails.csv", "MailId;ParentId;TextBody;Empty;AGR_Type_of_Complaint__c;Priority\n"
                + f'm1;c1;"<p>{BODY}</p>";;Quality;High\nm2;c2;short;;Quality;Low\nm3;c3;"{BODY}";;Not applicable;\n'
                + f'm4;nope;"{BODY}";;;High\n')
    meta = put(tmp_path, "meta.csv", "Id;SuppliedEmail;Lost\nc1;a@b.c;\nc2;d@e.f;\nc3;;\nc9;;only here\n")
    model = saved(L.language_model(V.table(spark, SF_DIR, "documents"), "text", "lang"), "model")
    out = A.prepare_files(spark, mails, meta, model, keep=("MailId",))
    assert out.columns == ["MailId", "TextBody", "Priority", X.COMPLAINT_TYPE, "META_SuppliedEmail", "Complaint",
                           "ProcessedTextBody", "Language", "LangName"]
    got = {r["MailId"]: r for r in out.collect()}
    assert set(got) == {"m1", "m3"}
    assert got["m1"]["ProcessedTextBody"] == BODY.strip() and got["m1"]["Complaint"] == 1
    assert got["m3"]["Complaint"] == 0 and got["m3"]["Priority"] is None and got["m1"]["LangName"] == "English"
    fewer = put(tmp_path, "fewer.csv", "Id;SuppliedEmail;Lost\nc1;;\nc2;;\nc3;;\nc9;g@h.i;\n")
    A.prepare_files(spark, mails, fewer, empty_columns=str(tmp_path / "empty"))
    told = spark.read.csv(str(tmp_path / "empty"), header=True)
    assert rows(told) == [("cases", "Lost"), ("mails", "Empty"), ("merged", "META_SuppliedEmail")]
    assert A.prepare_files(spark, mails, str(tmp_path / "none.csv")) is None
    path = str(tmp_path / "snapshot")
    snapshot.write_snapshot(out, path)
    assert rows(snapshot.read_snapshot(spark, path)) == rows(out)


def test_folder_with_headers_in_any_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("A;B\n1;2\n")
    (tmp_path / "b.csv").write_text("B;A\n2;1\n")
    assert [tuple(r) for r in delimited.read_delimited(spark, str(tmp_path)).select("A", "B").collect()] == [("1", "2")] * 2
    (tmp_path / "c.csv").write_text("A;C\n1;2\n")
    with pytest.raises(ValueError, match="c.csv"):
        delimited.read_delimited(spark, str(tmp_path))


def test_train_and_report(spark, tmp_path):
    kinds = ["broken", "late", "wrong"]
    data = [(i, f"the box was {kinds[i % 3]} again today", 1, kinds[i % 3]) for i in range(90)]
    snap = spark.createDataFrame(data, f"k long, {X.CLEAN_BODY} string, Complaint long, {X.COMPLAINT_TYPE} string")
    _, scored = B.train_complaint_types(snap, "k", str(tmp_path / "out"))
    assert scored.count() == 15 and scored.filter("Correct").count() == 15
    assert sorted(os.listdir(tmp_path / "out")) == ["dataset_stats", "final_metrics", "incorrect_predictions", "model",
                                                    "test_predictions", "training_history"]


def test_stream(spark, tmp_path):
    batch = V.mails(spark, SF_DIR).select("id", F.col("body").alias(X.BODY))
    batch.write.parquet(str(tmp_path / "in"))
    stream = clean_stream(spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in")))
    job = (stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck"))
           .trigger(availableNow=True).start(str(tmp_path / "out")))
    job.awaitTermination(120)
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(clean_stream(batch))


# --- session helpers ----------------------------------------------------------------------------------------------------

def test_session(spark):
    assert shared_dir(spark) == shared_dir(spark)
    small = spark.range(5)
    assert "broadcast" in str(broadcast_if_small(small, 5)._jdf.queryExecution().logical()).lower()
    assert "broadcast" not in str(broadcast_if_small(small, 4)._jdf.queryExecution().logical()).lower()
    one_task = spark.range(10, numPartitions=1)
    assert spread(one_task, "id").rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
    many = spark.range(10, numPartitions=100)
    assert spread(many, "id") is many


# --- plan shapes -----------------------------------------------------------------------------------------------------------

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_cleaning_runs_once(spark):
    mails = V.mails(spark, SF_DIR)
    cleaned = C.filter_short(C.with_clean_text(mails, "body", "clean"), "clean", 120)
    alone = mails.select(F.explode(F.array(tx.clean_text("body"))))
    assert optimized(cleaned).count("regexp_replace(") == optimized(alone).count("regexp_replace(")
    assert "Python" not in plan(cleaned) and "Exchange" not in plan(cleaned)


def test_column_filters_reach_the_scan(spark, tmp_path):
    df = spark.createDataFrame([("b", "c", "Quality", "en", "English", "High")],
                               f"{X.BODY} string, {X.CLEAN_BODY} string, {X.COMPLAINT_TYPE} string, Language string, LangName string, Priority string")
    df.write.parquet(str(tmp_path / "s"))
    found = E.explore(spark.read.parquet(str(tmp_path / "s")), complaint_type="Quality", language="en", priority=None)
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    text = plan(found.select(X.BODY))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(Language,en)" in text and "IsNull(Priority)" in text and f"EqualTo({X.COMPLAINT_TYPE},Quality)" in text
    assert "LangName" not in text.split("ReadSchema")[1]


def test_split_moves_no_texts(spark):
    """Only counts (65,536 at most) are brought to one task; the texts are neither exchanged nor sorted."""
    df = V.table(spark, SF_DIR, "documents").select("doc_id", "text")
    parts = D.split_dataset(df, "doc_id")
    main = plan(parts).split("Subquery")[0].split("Subqueries")[0]
    assert "Exchange" not in main and "Sort" not in main


def test_scoring_moves_nothing(spark, monkeypatch):
    """Mails are judged where they are; a model too large for that meets numbers and trigrams, never texts."""
    docs = V.table(spark, SF_DIR, "documents")
    model = saved(L.language_model(docs, "text", "lang"), "model")
    text = plan(L.detect_language(docs.select("text"), model, "text"))
    assert "Exchange hashpartitioning" not in text and "Cartesian" not in text and text.count("Scan parquet") == 1
    monkeypatch.setattr(L, "MAX_LOCAL_WEIGHTS", 0)
    rows = spark.range(1).selectExpr("id AS number", "'a b' AS name")
    exchanged = plan(L._joined(rows, "name", "number", L.dense_model(model)))
    assert not re.search(r"Exchange hashpartitioning\([^)]*name", exchanged)


def test_join_is_hashed_with_null_keys(spark):
    m = spark.range(10).select(F.col("id").cast("string").alias("ParentId")).hint("merge")
    c = spark.range(10).select(F.col("id").cast("string").alias("META_Id"))
    text = plan(J.join_metadata(m, c))
    assert "SortMergeJoin" in text and "Cartesian" not in text and "NestedLoop" not in text


def test_filters_leave_a_task_one_per_file(spark, tmp_path):
    """Texts are marked where they are: one row per part of a file's filter and batch, not one per trigram of a text."""
    batch = pa.RecordBatch.from_pydict({"file": ["a", "a", "b", "c"], "text": [b"abcd " * 500, b"zq7", b"ab", b"\xffabc"]})
    made = [r for out in search_index._filters(iter([batch])) for r in out.to_pylist()]
    assert {r["file"] for r in made} == {"a", "b", "c"} and all(len(r["bits"]) == search_index.PART // 8 for r in made)
    assert sum(bin(int.from_bytes(r["bits"])).count("1") for r in made if r["file"] == "a") == 6  # abc bcd cd_ d_a _ab zq7
    assert not any(any(r["bits"]) for r in made if r["file"] == "b") and max(Counter(r["file"] for r in made).values()) <= 8
    long = "k" * search_index.STEP_CHARS + "seam"
    assert {int(search_index._positions(s)[0]) for s in ("kkk", "kks", "kse", "sea", "eam")} == {
        r["part"] * search_index.PART + i for out in search_index._filters(iter([pa.RecordBatch.from_pydict({"file": ["a"], "text": [long.encode()]})]))
        for r in out.to_pylist() for i in range(search_index.PART) if r["bits"][i // 8] >> i % 8 & 1}
