"""Table operators on small hand-made tables."""

import math
import random
import statistics
import time

import pytest
from pyspark.sql import functions as F

from mailprep import __main__ as command
from mailprep import fixed as X
from mailprep.operators import dataset as D
from mailprep.operators import explore as E
from mailprep.operators import joins as J
from mailprep.operators import language as L
from mailprep.operators import model as M
from mailprep.operators import profile as P
from mailprep.operators import ranks as R
from mailprep.operators import schema as C
from mailprep.plans import queries
from mailprep.session import saved
from tests.conftest import SF_DIR


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- schema ---------------------------------------------------------------------------------------------------

def test_null_columns(spark):
    df = spark.createDataFrame([("", "nan", None, "a"), ("nan", "x", None, "NaN")], "a string, b string, c string, d string")
    assert C.drop_all_null_columns(df).columns == ["b", "d"]
    assert rows(C.normalize_nulls(df)) == rows(spark.createDataFrame(
        [(None, None, None, "a"), (None, "x", None, "NaN")], df.schema))
    assert rows(C.find_all_null_columns(df)) == [("c",)]
    assert rows(C.find_all_null_columns(df.drop("c"))) == []
    # a value far behind the first rows is still found
    late = spark.range(5000, numPartitions=4).select("id", F.when(F.col("id") == 4999, "v").alias("late"))
    assert C.all_null(late, probe_rows=10) == []


def test_duplicate_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("a", "b", "a")
    assert C.drop_duplicate_columns(df).collect()[0].asDict() == {"a": 1, "b": 2}


def test_select_existing(spark):
    df = spark.createDataFrame([("s", "t")], "Subject string, TextBody string")
    assert C.select_existing(df).columns == ["TextBody", "Subject"]
    with pytest.raises(ValueError):
        C.select_existing(df.drop("TextBody"))


def test_complaint_label(spark):
    df = spark.createDataFrame([(None, 0), ("Not applicable", 0), (" NOT applicable\t", 0), ("", 1), ("Quality", 1)],
                               "AGR_Type_of_Complaint__c string, want int")
    assert C.derive_complaint_label(df).filter("Complaint <> want").count() == 0


def test_pick_and_filter_short(spark):
    df = spark.createDataFrame([(i, "x" * i) for i in (5, 3, 9)], "k long, ProcessedTextBody string")
    assert C.pick(df, "k", 1).first()["k"] == 5
    with pytest.raises(ValueError):
        C.pick(df, "k", 3)
    assert rows(C.filter_short(df, threshold=5).select("k")) == [(5,), (9,)]
    with pytest.raises(ValueError):
        C.filter_short(df, "nope")


# --- joins -----------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("how", J.HOWS)
@pytest.mark.parametrize("null_keys", ["match", "drop"])
def test_join(spark, how, null_keys, monkeypatch):
    monkeypatch.setattr(J, "MIN_HEAVY", 1)
    left = [(1, "a"), (2, "a"), (3, None), (4, "z")]
    right = [("a", 10), ("a", 11), (None, 12), ("q", 13)]
    same = lambda l, r: l == r and (l is not None or null_keys == "match")
    want = [(*l, *r) for l in left for r in right if same(l[1], r[0])]
    if how in ("left", "outer"):
        want += [(*l, None, None) for l in left if not any(same(l[1], r[0]) for r in right)]
    if how in ("right", "outer"):
        want += [(None, None, *r) for r in right if not any(same(l[1], r[0]) for l in left)]
    ldf = spark.createDataFrame(left, "id long, ParentId string")
    rdf = spark.createDataFrame(right, "META_Id string, v long")
    for salts in (1, 3, None):
        assert rows(J.join_metadata(ldf, rdf, how=how, null_keys=null_keys, salts=salts)) == sorted(want, key=str)


@pytest.mark.parametrize("how", J.HOWS)
def test_join_with_one_heavy_case(spark, how, monkeypatch):
    """Nine mails in ten belong to one case and a tenth of the others to none: the same rows, in tasks of much the same size."""
    monkeypatch.setattr(J, "MIN_HEAVY", 1)
    n = 20_000
    key = F.when(F.col("id") % 10 > 0, "hot").when(F.col("id") % 100 == 0, F.lit(None)).otherwise(F.concat(F.lit("c"), F.col("id") % 997))
    left = saved(spark.range(n).select("id", key.alias("ParentId"), F.lit("x" * 50).alias("text")), "mails")
    right = saved(spark.range(900).select(F.concat(F.lit("c"), F.col("id")).alias("META_Id"), F.col("id").alias("v")).union(
        spark.createDataFrame([("hot", -1), ("hot", -2), (None, -3), (None, -4)], "META_Id string, v long")), "cases")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = J.join_metadata(left, right, how=how)
        assert len(joined.columns) == 5 and "xxhash64(id" in plan(joined) and ", text" not in plan(joined).split("xxhash64(id")[1].split(")")[0]
        sizes = sorted(r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())
        got = joined.groupBy("id", "v").count()
        want = left.join(right, left["ParentId"].eqNullSafe(right["META_Id"]), how).groupBy("id", "v").count()
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
        assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    found = {r["key"]: (r["mails"], r["cases"]) for r in J.heavy_keys(left, right).collect()}
    assert found["hot"] == (18_000, 2) and found.get(None, (200, 2)) == (200, 2)


def test_missing_keys_on_both_sides(spark, monkeypatch):
    """A group without a key on both sides is an all-pairs product: it is found, counted and made in many parts."""
    monkeypatch.setattr(J, "MIN_HEAVY", 1)
    left = spark.range(400).select("id", F.lit(None).cast("string").alias("ParentId"))
    right = spark.range(300).select(F.lit(None).cast("string").alias("META_Id"), F.col("id").alias("v"))
    found = J.heavy_keys(left, right).collect()
    assert [(r["key"], r["mails"], r["cases"], r["parts"] >= 8) for r in found] == [(None, 400, 300, True)]
    assert J.heavy_keys(left, right, null_keys="drop").isEmpty()
    assert J.join_metadata(left, right).count() == 120_000 and J.join_metadata(left, right, null_keys="drop").count() == 0


def test_language_names(spark):
    df = spark.createDataFrame([("en", "English"), ("deu", "German"), ("xx", "Unknown"), (None, "Unknown"), ("EN", "Unknown"),
                                ("war", "Waray")], "Language string, want string")
    got = J.language_names(df, extra={"war": "Waray"})
    assert got.count() == 6 and got.filter("LangName <> want").count() == 0


# --- ranks and profiles ----------------------------------------------------------------------------------------

def quantiles_of(df):
    return R.quantiles(df, df.groupBy("column").agg(F.count("value").alias("rows")))


@pytest.mark.parametrize("n", [1, 2, 3, 10, 5000])
def test_quantiles(spark, n):
    r = random.Random(n)
    values = [r.choice([7.0, 0.0, r.gauss(0, 1), 1e12 * r.random(), 1000 + r.random() * 1e-9, -5e-324, 1e308 * r.random()]) for _ in range(n)]
    df = spark.createDataFrame([("c", v) for v in values] + [("c", None), ("d", 1.0)], "column string, value double")
    got = {(x["column"], x["share"]): x["quantile"] for x in quantiles_of(df).collect()}
    s = sorted(values)
    for share in (0.25, 0.5, 0.75):
        at = (n - 1) * share
        low = math.floor(at)
        want = s[low] + (at - low) * (s[min(low + 1, n - 1)] - s[low])
        assert got["c", share] == pytest.approx(want, rel=1e-12)
        assert got["d", share] == 1.0


@pytest.mark.parametrize("n, inside, margin", [(1, 10 ** 6, 0.015), (3, 10 ** 6, 0.015), (5000, 10 ** 6, 0.015), (5000, 10, 0.015), (5000, 10 ** 6, -0.0005)])
def test_bracketed_quantiles(spark, n, inside, margin, monkeypatch):
    """By sketch and one count; also where the brackets would hold too much, or miss."""
    monkeypatch.setattr(R, "MAX_INSIDE", inside)
    monkeypatch.setattr(R, "SKETCH_MARGIN", margin)
    r = random.Random(n)
    values = [r.choice([7.0, 0.0, r.gauss(0, 1), 1e12 * r.random(), -5e-324, 1e308 * r.random(), float("inf")]) for _ in range(n)]
    df = spark.createDataFrame([("c", v) for v in values] + [("c", None), ("d", 1.0), ("e", None)], "column string, value double")
    stats = df.groupBy("column").agg(F.count("value").alias("rows"), R.sketch("value").alias("sketch"))
    got = {(x["column"], x["share"]): x["quantile"] for x in R.bracketed(df, saved(stats, "stats")).collect()}
    s = sorted(values)
    want = {("d", x): 1.0 for x in (0.25, 0.5, 0.75)}
    for share in (0.25, 0.5, 0.75):
        at = (n - 1) * share
        low, high = s[math.floor(at)], s[min(math.floor(at) + 1, n - 1)]
        want["c", share] = low + (at - math.floor(at)) * (high - low)
    assert got == {k: pytest.approx(v, rel=1e-12, nan_ok=True) for k, v in want.items()}


def test_many_classes(spark):
    """Class numbers come without a window over all classes."""
    df = spark.range(30_000).select(F.concat(F.lit("k"), F.pmod(F.col("id") * 7919, F.lit(10_007))).alias("c")).union(spark.sql("select null"))
    mapping = D.label_mapping(df, "c")
    names = sorted({f"k{i}" for i in range(10_007)})
    assert rows(mapping) == sorted(((c, i) for i, c in enumerate(names)), key=str)
    assert "Exchange SinglePartition" not in plan(mapping).split("BroadcastExchange")[0]
    assert D.label_mapping(df.limit(0), "c").count() == 0


def test_values_of_whole_numbers_beyond_double_precision(spark):
    base = 2 ** 60
    df = spark.range(5000).select(F.lit("c").alias("column"), (F.lit(base) + F.pmod(F.col("id") * 7919, F.lit(5000))).alias("value"))
    targets = spark.createDataFrame([("c", i, r) for i, r in enumerate((0, 1, 2500, 4999))], "column string, target int, rank long")
    assert rows(R.values_at(df, targets)) == [("c", 0, base), ("c", 1, base + 1), ("c", 2, base + 2500), ("c", 3, base + 4999)]


def test_row_at(spark):
    df = spark.range(0, 3000).select((F.col("id") * F.col("id")).alias("k"))
    for k in (1, 2, 777, 2999, 3000):
        assert R.row_at(df, "k", k).first().asDict() == {"k": (k - 1) ** 2, "position": k, "total": 3000}
    with pytest.raises(ValueError):
        R.row_at(df, "k", 3001)


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "boolean", "double", "decimal(20,3)"])
def test_row_at_by_any_key(spark, kind):
    n = 2 if kind == "boolean" else 400
    key = {"string": F.concat(F.lit("MAIL-"), F.col("id") * 7), "date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")),
           "timestamp": F.timestamp_micros(F.col("id") * 1_000_001), "boolean": F.col("id") == 1}.get(kind, F.col("id") * 0.125).cast(kind)
    df = spark.range(n).select(key.alias("k")).union(spark.sql("select null"))
    want = [None, *sorted(r[0] for r in df.filter("k is not null").collect())]
    for at in sorted({1, 2, min(n, 101), n // 2 + 1, n + 1}):
        assert R.row_at(df, "k", at).first()["k"] == want[at - 1]
    assert [r["k"] for r in R.first_rows(df, "k", 3).collect()] == want[:3]
    assert [r["k"] for r in R.first_rows(df, "k", 2, last=True).collect()] == want[-2:]


def test_columns_of_the_caller_stay(spark):
    df = spark.createDataFrame([("en", "x", "y")], "lang string, code string, lang_name string")
    assert J.language_names(df, "lang", "name").first().asDict() == {"lang": "en", "code": "x", "lang_name": "y", "name": "English"}
    df = spark.createDataFrame([("b", "x"), ("a", "y")], "kind string, class string")
    assert rows(D.encode_labels(df, "kind").select("kind", "class", "label")) == [("a", "y", 0), ("b", "x", 1)]


def test_duplicates_are_exact(spark):
    df = spark.sql("""SELECT * FROM VALUES (timestamp_micros(1), 'a', array(1, null), 0.0D), (timestamp_micros(2), 'a', array(1, null), 0.0D),
        (timestamp_micros(1), 'a', array(1), 0.0D), (timestamp_micros(1), 'a', array(1, null), -0.0D), (timestamp_micros(1), null, array(1), 0.0D),
        (timestamp_micros(1), 'null', array(1), 0.0D) AS t(ts, s, a, d)""")
    assert P.duplicate_rows(df).first()[0] == 1


def test_top_of_long_ties_is_the_smallest(spark):
    values = [c * 40 for c in "jihgfedcb"] + ["b" * 39 + "a"]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    assert P.describe_categorical(df).first()["top"] == min(values)


def test_search_dialect(spark):
    df = spark.createDataFrame([(1, "abab"), (2, "été"), (3, "xx")], "id long, body string")
    ids = lambda p: [r["id"] for r in E.search_regex(df, p, "body").orderBy("id").collect()]
    assert ids(r"(?P<my_group>ab)(?P=my_group)\Z") == [1] and ids(r"\p{L}{3}") == [1, 2] and ids(r"x++") == [3]
    with pytest.raises(ValueError):
        E.search_regex(df, "(", "body")


def test_spans_of_repeated_keys(spark):
    df = spark.createDataFrame([(1, "xab"), (1, "abx ab"), (2, "\ufdd0ab\ufdd1" + "ab" * 600)], "k long, body string")
    got = rows(E.match_spans(df, "k", "ab", column="body"))
    want = [(1, 1, 3), (1, 0, 2), (1, 4, 6), (2, 1, 3)] + [(2, 4 + 2 * i, 6 + 2 * i) for i in range(600)]
    assert sorted(got) == sorted(want)


def test_profile(spark):
    long_text = "long " * 20
    df = spark.createDataFrame([("a", 1.0, None), ("b", 2.0, long_text), ("b", float("nan"), long_text), ("a", 1.0, None)],
                               "s string, n double, t string")
    assert rows(P.null_counts(df)) == [("t", 2)]
    assert P.duplicate_rows(df).first()[0] == 1
    assert rows(P.describe_categorical(df)) == [("s", 4, 2, "a", 2), ("t", 2, 1, long_text, 2)]
    assert rows(P.distinct_counts(df)) == [("n", 3), ("s", 2), ("t", 1)]
    assert rows(P.small_domains(df, 3)) == [("s", 2, ["a", "b"]), ("t", 1, [long_text])]
    n = P.describe_numeric(df).first()
    assert (n["count"], n["min"], n["p50"], n["max"]) == (3, 1.0, 1.0, 2.0)
    assert n["std"] == pytest.approx(statistics.stdev([1, 2, 1]))
    assert P.describe_numeric(df, approx=True).first()["p75"] == 2.0
    assert {r["column"]: r["distinct"] for r in P.distinct_counts(df, approx=True).collect()}["s"] == 2
    report = {r["column"]: r for r in P.profile(df).collect()}
    assert report["s"]["values"] == ["a", "b"] and report["s"]["duplicate_rows"] == 1 and report["n"]["max"] == 2.0
    assert rows(P.shape(df)) == [(4, 3)]
    assert P.value_counts(df, "t").collect()[0]["count"] == 2
    assert rows(P.value_counts(df, "t", dropna=True)) == [(long_text, 2)]


# --- exploring ---------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def mails(spark):
    return spark.createDataFrame([
        (1, "Price a.b now", "short", "Quality", "en", "English", "High"),
        (2, "price axb", "a longer text", None, "en", "English", None),
        (3, "nothing", "x", "Quality", "xx", "Unknown", "High"),
        (4, "ÉCRIT Price", "y", "Service", None, "Unknown", "Low")],
        "k int, TextBody string, ProcessedTextBody string, AGR_Type_of_Complaint__c string, Language string, LangName string, Priority string")


def keys(df):
    return [r["k"] for r in df.orderBy("k").collect()]


def test_search(mails):
    assert keys(E.search_regex(mails, r"price\s+a.b")) == [1, 2]
    assert keys(E.search_regex(mails, "écrit")) == [4]
    assert keys(E.search_regex(mails, "  ")) == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        E.search_regex(mails, "(")
    assert keys(E.search_text(mails, "a.b")) == [1, 2]
    assert keys(E.search_text(mails, "A.B", literal=True)) == [1]
    assert keys(E.max_length(mails, " 5 ")) == [1, 3, 4]
    with pytest.raises(ValueError):
        E.max_length(mails, "five")


def test_filters(mails):
    assert keys(E.filter_complaint_type(mails, E.ALL)) == [1, 2, 3, 4]
    assert keys(E.filter_complaint_type(mails, E.MISSING)) == [2]
    assert keys(E.filter_complaint_type(mails, "Quality")) == [1, 3]
    assert keys(E.filter_language(mails, "en")) == [1, 2]
    assert keys(E.filter_language(mails, None)) == [4]
    assert keys(E.filter_language(mails, "Unknown")) == [3, 4]
    assert keys(E.filter_priority(mails, "High")) == [1, 3]
    assert keys(E.explore(mails, "price", max_chars="20", language="en", complaint_type=E.MISSING)) == [2]
    assert keys(E.explore(mails, "no such text")) == []


def test_facets_and_pages(mails):
    got = [tuple(r) for r in E.facet_counts(mails).collect()]
    assert got == [("complaint_type", "Quality", None, 2), ("complaint_type", None, None, 1), ("complaint_type", "Service", None, 1),
                   ("language", "English", "en", 2), ("language", "Unknown", "xx", 2),
                   ("priority", "High", None, 2), ("priority", None, None, 1), ("priority", "Low", None, 1)]
    assert keys(E.page(mails, "k", 2)) == [1, 2]
    assert keys(E.page(mails, "k", 2, after=2)) == [3, 4]
    assert keys(E.page(mails, "k", 2, before=4)) == [2, 3]
    assert keys(E.last_page(mails, "k", 1)) == [4]
    assert E.record_at(mails, "k", 3).first()["total"] == 4


@pytest.mark.parametrize("query,regex", [("a", False), (r"a+|x*", True), (".", False), (r"(b)\1", True), ("É", False)])
def test_match_spans(spark, query, regex):
    import re
    texts = ["", "baac aA.b", "😀 ébb\na.", "xx", "none at all"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, TextBody string")
    pattern = re.compile(query if regex else re.escape(query), re.IGNORECASE)
    want = [(i, m.start(), m.end()) for i, t in enumerate(texts) for m in pattern.finditer(t) if m.end() > m.start()]
    assert rows(E.match_spans(df, "k", query, regex)) == sorted(want, key=str)
    assert E.match_spans(df, "k", " ").count() == 0


# --- languages ------------------------------------------------------------------------------------------------------

def test_languages(spark):
    train = spark.createDataFrame([("the cat sat on the mat and the dog", "en"), ("der Hund und die Katze auf der Matte", "de"),
                                   ("猫はマットの上に座った", "ja")], "t string, l string")
    model = L.language_model(train, "t", "l").cache()
    df = spark.createDataFrame([(1, "The dog and the cat"), (2, "Die Katze und der Hund"), (3, "猫は"), (4, ""), (5, "123"), (6, None)],
                               "k int, ProcessedTextBody string")
    got = {r["k"]: (r["Language"], r["LangName"]) for r in L.detect_language(df, model).collect()}
    assert got[1] == ("en", "English") and got[2] == ("de", "German") and got[3] == ("ja", "Japanese")
    assert got[4] == got[5] == ("unknown", "Unknown")
    alone = {r["k"]: r["Language"] for r in L.detect_language_or_unknown(df, model).collect()}
    assert (alone[1], alone[4], alone[6]) == ("en", "unknown", "unknown")


def test_languages_by_join(spark, monkeypatch):
    """A model too large to send along gives the same codes, ties and unseen trigrams included."""
    texts = [("the cat sat on the mat", "en"), ("der Hund auf der Matte", "de"), ("le chat est sur le tapis", "fr"), ("the cat sat on the mat", "xx")]
    model = saved(L.language_model(spark.createDataFrame(texts, "t string, l string"), "t", "l"), "model")
    plain = ["The cat, the cat.", "der Hund!", "sur le tapis", "zzz qqq", "猫", "", None, "1 2", "the cat " * 3000, "Der the Hund cat " * 9, "𝒜𝒞 x"]
    df = spark.createDataFrame(list(enumerate(plain * 3)), "k int, ProcessedTextBody string")
    local = rows(L.detect_language(df, model))
    by_key = {r[0]: r[2] for r in local}
    assert [by_key[k] for k in (0, 1, 2, 5, 7, 8)] == ["en", "de", "fr", "unknown", "unknown", "en"]
    monkeypatch.setattr(L, "MAX_LOCAL_WEIGHTS", 0)
    assert rows(L.detect_language(df, model)) == local
    none = L.language_model(spark.createDataFrame([], "t string, l string"), "t", "l")
    assert {r["Language"] for r in L.detect_language_or_unknown(df, none).collect()} == {"unknown"}


def test_a_sentence_of_a_million_characters(spark):
    train = spark.createDataFrame([("the cat sat on the mat", "en"), ("der Hund auf der Matte", "de")], "t string, l string")
    model = saved(L.language_model(train, "t", "l"), "model")
    text = "DerHundaufderMatte" * 60_000  # one word without a stop
    df = spark.createDataFrame([(1, text), (2, "the cat on the mat"), (3, text + " " + "Matte der Hund " * 60_000 + ".")], "k int, ProcessedTextBody string")
    start = time.perf_counter()
    got = {r["k"]: r["Language"] for r in L.detect_language(df, model).select("k", "Language").collect()}
    assert got == {1: "de", 2: "en", 3: "de"} and time.perf_counter() - start < 30


def test_language_distribution(spark):
    df = spark.createDataFrame([("A",)] * 6 + [("B",)] * 3 + [("C",)] * 2 + [("D",)] + [(None,)], "LangName string")
    assert [tuple(r) for r in L.language_distribution(df, threshold=3).collect()] == [
        ("A", 6, "50.00%"), ("B", 3, "25.00%"), ("Other", 3, "25.00%")]
    assert [r[0] for r in L.language_distribution(df, threshold=1).collect()] == ["A", "B", "C", "D"]


# --- training rows ---------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("n", [0, 1, 2, 7, 90, 1000])
def test_split(spark, n):
    df = spark.range(n).withColumnRenamed("id", "k")
    parts = D.split_dataset(df, "k")
    sizes = {r["split"]: r["count"] for r in parts.groupBy("split").count().collect()}
    train, val = int(n * 0.7), int(n * 0.15)
    assert [sizes.get(s, 0) for s in D.SPLITS] == [train, val, n - train - val]
    assert parts.select("k").distinct().count() == n
    if n == 1000:
        assert rows(parts) == rows(D.split_dataset(df.repartition(13), "k"))
        assert rows(parts) != rows(D.split_dataset(df, "k", seed=1))


def test_split_ratios(spark):
    with pytest.raises(ValueError):
        D.split_dataset(spark.range(3), "id", (0.7, 0.2, 0.2))
    assert D.split_dataset(spark.range(3), "id", (0.0, 0.0, 1.0)).filter("split = 'test'").count() == 3
    assert D.split_dataset(spark.range(3), "id", (1.0, 0.0, 0.0)).filter("split = 'train'").count() == 3


def test_datasets(spark):
    df = spark.createDataFrame([("a", True, "Quality"), ("b", False, None), (None, True, "Quality"), ("c", True, "Not applicable"),
                                ("d", True, "Logistics"), ("e", None, "Quality")],
                               f"{X.CLEAN_BODY} string, Complaint boolean, {X.COMPLAINT_TYPE} string")
    assert rows(D.binary_dataset(df)) == [("a", 1), ("b", 0), ("c", 1), ("d", 1)]
    typed = D.type_dataset(df)
    assert rows(typed) == [("a", "Quality"), ("d", "Logistics")]
    assert rows(D.encode_labels(typed, X.COMPLAINT_TYPE)) == [("a", "Quality", 1), ("d", "Logistics", 0)]
    assert rows(D.label_mapping(typed, X.COMPLAINT_TYPE)) == [("Logistics", 0), ("Quality", 1)]


def test_weights_and_stats(spark):
    df = spark.createDataFrame([("train", 0)] * 3 + [("train", 1)] + [("test", 1)] * 2, "split string, label long")
    assert rows(D.class_weights(df.filter("split = 'train'"))) == [(0, 3, 4 / 6), (1, 1, 2.0)]
    mapping = spark.createDataFrame([(0, "no"), (1, "yes")], "label long, class string")
    assert rows(D.dataset_stats(df, mapping)) == [("test", 1, "yes", 2, 100.0, 2, 6), ("train", 0, "no", 3, 75.0, 4, 6),
                                                  ("train", 1, "yes", 1, 25.0, 4, 6)]


# --- models -------------------------------------------------------------------------------------------------------------

def scores(spark, pairs, k):
    df = spark.createDataFrame(pairs, "TrueLabel long, PredictedLabel long")
    return [M.classification_metrics(df, k).first()[c] for c in ("accuracy", "precision", "recall", "f1")]


def test_metrics(spark):
    assert scores(spark, [(1, 1), (1, 0), (0, 1), (0, 0), (1, 1)], 2) == [pytest.approx(x) for x in (0.6, 2 / 3, 2 / 3, 2 / 3)]
    assert scores(spark, [(1, 0), (0, 0)], 2) == [0.5, 0.0, 0.0, 0.0]
    assert scores(spark, [(0, 0), (1, 1), (2, 2)], 3) == [1.0, 1.0, 1.0, 1.0]
    # class 1 is never predicted, class 2 is only predicted
    assert scores(spark, [(0, 0), (1, 0), (0, 2)], 3) == [pytest.approx(x) for x in (1 / 3, (1 / 2) / 3, (1 / 2) / 3, (1 / 2) / 3)]


def test_argmax(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],), ([5.0],)], "a array<double>")
    assert rows(df.select(M.argmax("a"))) == [(0,), (1,)]


def separable(spark, n):
    """Three classes, each with words of its own among many that all have; the first has half of the rows."""
    r = random.Random(7)
    rows_ = []
    for i in range(n):
        label = r.choice([0, 0, 1, 2])
        words_ = [f"w{r.randrange(300)}" for _ in range(30)] + [f"own{label}x{r.randrange(12)}" for _ in range(3)]
        r.shuffle(words_)
        rows_.append((i, " ".join(words_), label))
    return saved(spark.createDataFrame(rows_, f"k long, {X.CLEAN_BODY} string, label long"), "rows")


def test_training_goes_on(spark, monkeypatch):
    """Rounds go on from each other: all together they take as many iterations as the last, and end where one training does."""
    df = separable(spark, 600)
    train, val = df.filter("k < 400"), df.filter("k >= 400")
    taken, fit = [], M.resume
    monkeypatch.setattr(M, "resume", lambda *a: taken.append(fit(*a)) or taken[-1])
    monkeypatch.setattr(M, "PATIENCE", 99)
    model, history = M.select_best(train, val, 3, rounds=(2, 4, 8, 16, 32))
    assert [n for n, _ in history] == [2, 4, 8, 16, 32][:len(history)] and len(taken) == len(history)
    assert sum(m.summary.totalIterations for m in taken) <= 32
    loss = [m.summary.objectiveHistory for m in taken]
    assert all(b[0] <= a[-1] * (1 + 1e-6) for a, b in zip(loss, loss[1:]))  # a round starts where the last one stood
    once = M.train_classifier(train, 3, max_iter=32)
    assert loss[-1][-1] <= once.stages[-1].summary.objectiveHistory[-1] * 1.1
    pred = M.score(model, val)
    found = M.classification_metrics(pred, 3).first()
    majority = M.classification_metrics(pred.withColumn("PredictedLabel", F.lit(0).cast("long")), 3).first()
    assert found["f1"] > 0.9 > majority["f1"] + 0.4 and found["accuracy"] > majority["accuracy"] + 0.3
    assert M.confusion(pred).filter("TrueLabel = PredictedLabel").agg(F.sum("n")).first()[0] > 180


def test_real_predictions(spark):
    """The languages of the test documents are told from their words, far above the most frequent one."""
    pred = queries.QUERIES["m3_predictions"](spark, SF_DIR)
    got = pred.agg(F.avg(F.col("Correct").cast("int")), F.avg((F.col("TrueLabel") == F.lit(pred.groupBy("TrueLabel").count().orderBy(
        F.desc("count")).first()[0])).cast("int"))).first()
    assert got[0] > 0.9 > got[1]
    history = queries.QUERIES["m2_history"](spark, SF_DIR).collect()
    assert [r["iterations"] for r in history] == [1, 2, 4, 8][:len(history)] and max(r["f1"] for r in history) > 0.8
    assert queries.QUERIES["m1_confusion"](spark, SF_DIR).agg(F.sum("n")).first()[0] > 0


def test_training(spark):
    texts = [(i, "broken late damaged box" if i % 2 else "thank you kind regards", i % 2) for i in range(40)]
    df = spark.createDataFrame(texts, f"k long, {X.CLEAN_BODY} string, label long")
    model, history = M.select_best(df.filter("k < 30"), df.filter("k >= 30"), 2, rounds=(1, 3, 4, 5, 6))
    assert history[0][1] == 1.0 and len(history) == 3  # stops after two rounds without progress
    scored = M.score(model, df)
    assert scored.filter("NOT Correct").count() == 0 and M.errors(scored).count() == 0
    three = df.withColumn("label", F.col("k") % 3)
    assert M.score(M.train_classifier(three, 3, max_iter=2), three).select("PredictedLabel").distinct().count() <= 3


def test_explore_command_searches_the_original_and_tells_places(spark):
    rows = spark.createDataFrame([("a", "Header invoice\nan INVOICE", "an INVOICE", "x", "en", "English", "High"),
                                  ("b", "invoice", "", "x", "en", "English", "Low"), ("c", None, None, "x", "en", "English", "Low")],
                                 f"MailId string, {X.BODY} string, {X.CLEAN_BODY} string, {X.COMPLAINT_TYPE} string, "
                                 "Language string, LangName string, Priority string")

    def got(*given):
        return command.found(rows, command.parsed(["explore", "in", "out", "--key", "MailId", "--query", "invoice", *given])).collect()

    assert sorted(r["MailId"] for r in got()) == ["a", "b"]
    assert [r["MailId"] for r in got("--body", X.CLEAN_BODY)] == ["a"]
    assert sorted(tuple(r) for r in got("--spans")) == [("a", 7, 14), ("a", 18, 25), ("b", 0, 7)]
    assert [tuple(r) for r in got("--spans", "--body", X.CLEAN_BODY)] == [("a", 3, 10)]
    assert got("--spans", "--priority", "None") == []
    with pytest.raises(SystemExit):
        command.parsed(["explore", "in", "out", "--spans"])


def test_texts_are_cut_once_for_training(spark):
    """Every pass after the first reads counts: a text is made once per training row and once per validation row."""
    for train in (lambda a, b: M.select_best(a, b, 2, "text", rounds=(1, 2), features=64), lambda a, b: M.train_classifier(a, 2, "text", max_iter=2, features=64)):
        asked = spark.sparkContext.accumulator(0)

        def told(i):
            asked.add(1)
            return f"word{i % 2} and {i}"

        rows = spark.range(40, numPartitions=2).select((F.col("id") % 2).cast("long").alias("label"), F.udf(told)("id").alias("text"), "id")
        train(rows.filter("id < 30"), rows.filter("id >= 30"))
        assert asked.value in (30, 40)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 15, 16, 17, 300, 70_000])
def test_spans_of_any_number_of_hits(spark, n):
    text = "".join(f"{'é' * (i % 3)}x" for i in range(n))
    want = [i for i, sign in enumerate(text) if sign == "x"]
    got = E.match_spans(spark.createDataFrame([(1, text)], "id long, t string"), "id", "x", column="t").orderBy("start").collect()
    assert [(r["start"], r["end"]) for r in got] == [(i, i + 1) for i in want]
