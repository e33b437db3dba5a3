"""The same queries in SQL for DuckDB, written on their own: joins, windows and list functions, whole tables.

DuckDB's regular expressions (RE2) know no look-behind and no possessive repeats but never blow up, so the patterns
here keep their plain lazy form.
"""

from __future__ import annotations

from mailprep import fixed as X
from mailprep.functions.dialect import SPACE, SPACE_CHARS
from mailprep.plans.queries import SEARCH
from mailprep.plans.views import CASE_FILE, CASE_META, MAIL_FILE, MAILS

NL = "chr(10)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rx(pattern: str) -> str:
    """Spell white space and digits out for RE2."""
    out, inside = "", False
    i = 0
    while i < len(pattern):
        if pattern[i] == "\\":
            esc = pattern[i + 1]
            out += {"s": SPACE if inside else f"[{SPACE}]", "S": f"[^{SPACE}]", "d": r"\p{Nd}"}.get(esc, "\\" + esc)
            i += 2
            continue
        inside = pattern[i] == "[" or (inside and pattern[i] != "]")
        out += pattern[i]
        i += 1
    return q(out)


def alt(words) -> str:
    return "(?:" + "|".join(words) + ")"


def sub(x: str, pattern: str, to: str = "''", flags: str = "i") -> str:
    return f"regexp_replace({x}, {rx(f'(?{flags})' + pattern if flags else pattern)}, {to}, 'g')"


def strip(x: str) -> str:
    return f"trim({x}, {q(SPACE_CHARS)})"


BREAK = r"\r\n|[\n-\r\x1c-\x1e\x85\x{2028}\x{2029}]"


def lines(x: str) -> str:
    return f"string_split_regex(regexp_replace({x}, {q(f'(?:{BREAK})$')}, ''), {q(BREAK)})"


def words(x: str) -> str:
    return f"string_split_regex({strip(x)}, {rx(chr(92) + 's+')})"


def join_lines(x: str, lst: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE coalesce(array_to_string({lst}, {NL}), '') END"


# --- one SELECT per text step: reads (k, x) from a table, gives (k, x) ---------------------------------------------

def simple(expr):
    return lambda src: f"SELECT k, {expr('x')} AS x FROM {src}"


def step_flexible(src: str) -> str:
    every = "|".join(w for ws in X.HEADER_WORDS.values() for w in ws)
    kind = "CASE " + " ".join(f"WHEN w IN ({', '.join(map(q, ws))}) THEN {q(k)}" for k, ws in X.HEADER_WORDS.items()) + " END"
    return f"""SELECT k, CASE WHEN kinds >= 3 THEN {strip(f"coalesce(array_to_string(list_slice(l, CASE WHEN subj > 0 THEN skipped + subj ELSE skipped + lastk + 1 END, len(l)), {NL}), '')")} ELSE x END AS x
 FROM (SELECT *, len(list_distinct(f)) AS kinds, coalesce(list_position(f, 'subject'), 0) AS subj,
   list_max(list_transform(f, lambda e, i: CASE WHEN e IS NOT NULL THEN i END)) AS lastk
  FROM (SELECT k, x, l, skipped, list_transform(list_transform(list_slice(l, skipped + 1, len(l)),
     lambda e: regexp_extract(lower(e), {rx(rf'^\s*({every}):')}, 1)), lambda w: {kind}) AS f
   FROM (SELECT k, x, l, greatest(len(l) - 30, 0) AS skipped FROM (SELECT k, x, {lines('x')} AS l FROM {src}))))"""


def t2(x):
    blank = f"regexp_replace({x}, {q('(?m)^[ ' + chr(92) + 't]+$' + chr(92) + 'n?')}, '', 'g')"
    return strip(sub(blank, r"\n\s*\n", NL, ""))


def t3(x):
    return f"regexp_replace({x}, '[ \\t]+', ' ', 'g')"


def t4(x):
    return f"regexp_replace({x}, {q(X.INVISIBLE)}, '', 'g')"


def t5(x):
    return sub(x, X.LINK_IN_BRACKETS)


def t6(x):
    bare = sub(sub("e", X.THREAD_IN_BRACKETS), X.THREAD_MARK)
    again = (f"CASE WHEN regexp_matches(lower({bare}), {rx(r'^\s*' + alt(X.HEADER_WORDS['subject']) + ':')}) "
             f"THEN {sub(bare, X.THREAD_IN_BRACKETS)} ELSE {bare} END")
    return join_lines(x, f"list_transform({lines(x)}, lambda e: {strip(again)})")


def t7(x):
    return sub(x, X.CID_IN_BRACKETS)


def step_known(src: str) -> str:
    block = (f"^.*?{alt(X.BLOCK_FROM)}.*?\\n{alt(X.BLOCK_SENT)}.*?\\n{alt(X.BLOCK_URGENCY)}.*?\\n?{alt(X.BLOCK_TO)}"
             f".*?\\n{alt(X.BLOCK_SUBJECT)}.*?\\n")
    banner = rf"^.*?-{{2,}}\s*{alt(X.BANNER_PHRASES)}\s*-+"
    wrote = rf"^.*?{alt(X.WROTE_OPENERS)}\s.*?{alt(X.WROTE_VERBS)}:\s*"
    cut = [f"regexp_replace(x, {rx('(?is)' + p)}, '') AS r{i}" for i, p in enumerate((block, banner, wrote))]
    return (f"SELECT k, CASE {' '.join(f'WHEN r{i} <> x THEN {strip(f'r{i}')}' for i in range(3))} ELSE x END AS x "
            f"FROM (SELECT k, x, {', '.join(cut)} FROM {src})")


def t9(x):
    return f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"


def t10(x):
    for pattern, dotall in X.DISCARDS + [(X.CONFIDENTIALITY_NOTICE.replace("{organisation}", r"\S+"), True)]:
        x = sub(x, pattern, flags="is" if dotall else "i")
    return x


def t11(x):
    address = rf"\d{{1,5}}[ ,\-]?\s*{alt(X.STREET_WORDS)}(?:[^\p{{L}}\p{{N}}_].*)?"
    whole = r"(?i)^\s*(?:" + "|".join([X.EMAIL, X.PHONE, X.DOMAIN, alt(X.JOB_TITLES), address]) + r")\s*$"
    return join_lines(x, f"list_filter({lines(x)}, lambda e: {strip('e')} = '' OR NOT regexp_matches({strip('e')}, {rx(whole)}))")


def t12(x, token=False):
    for name, p in [("EMAIL", X.EMAIL), ("PHONE", X.PHONE), ("DOMAIN", X.DOMAIN), ("TITLE", alt(X.JOB_TITLES))]:
        x = sub(x, p, q(f"[{name}]") if token else "''")
    return x


def t13(x):
    return f"coalesce({strip(f'replace(replace({x}, {NL}, chr(32)), chr(13), chr(32))')}, '')"


def step_sentence(src: str) -> str:
    mark = "'\\1' || chr(1)"
    return f"""SELECT k, coalesce(list_filter(s, lambda e: regexp_matches(e, '[.!?]$') AND len({words('e')}) >= 8)[-1],
  array_to_string(list_slice({words('t')}, 1, 20), ' '), '') AS x
 FROM (SELECT k, t, string_split({sub('t', r'([.!?])\s+', mark, '')}, chr(1)) AS s FROM (SELECT k, {strip('x')} AS t FROM {src}))"""


def t17(x):
    return f"array_to_string(list_slice({words(x)}, 1, 256), ' ')"


CLEAN = [step_flexible, *map(simple, (t2, t3, t4, t5, t6, t7)), step_known, *map(simple, (t9, t10, t11, strip)),
         simple(lambda x: f"coalesce({x}, '')")]


def chain(source: str, steps, prefix: str = "s") -> tuple[str, str]:
    """CTE definitions that run the steps one after the other, and the name of the last."""
    parts, last = [f"{prefix}0 AS MATERIALIZED ({source})"], f"{prefix}0"
    for i, step in enumerate(steps, 1):
        parts.append(f"{prefix}{i} AS MATERIALIZED ({step(last)})")
        last = f"{prefix}{i}"
    return ",\n".join(parts), last


VIEWS = (f"mails AS MATERIALIZED ({MAILS.format(documents='documents')}),\n"
         f"case_meta AS MATERIALIZED ({CASE_META.format(labels='labels')})")


def on_mails(select: str) -> str:
    return f"WITH {VIEWS}\n{select}"


def body_steps(*steps, source="SELECT id AS k, body AS x FROM mails", key="id", out="out") -> str:
    ctes, last = chain(source, steps)
    return f"WITH {VIEWS},\n{ctes}\nSELECT k AS {key}, x AS {out} FROM {last}"


def with_clean(select: str, source: str = "SELECT id AS k, body AS x FROM mails", more: str = "") -> str:
    """``select`` may read clean(k, x)."""
    ctes, last = chain(source, CLEAN)
    return f"WITH {VIEWS},\n{more}{ctes},\nclean AS (SELECT k, x FROM {last})\n{select}"


NAMES = " ".join(f"WHEN {q(code)} THEN {q(name)}" for code, name in (
    pair for two, three, name in (line.split(" ", 2) for line in X.LANGUAGES.strip().splitlines())
    for pair in ((two, name), (three, name))))


def name_of(code: str) -> str:
    return f"CASE {code} {NAMES} ELSE 'Unknown' END"


def hundredths(n: str, total: str) -> str:
    quotient, rest = f"((10000 * {n}) // {total})", f"((10000 * {n}) % {total})"
    return (f"({quotient} + CASE WHEN 2 * {rest} > {total} OR (2 * {rest} = {total} AND {quotient} % 2 = 1) "
            f"THEN 1 ELSE 0 END)")


LABELLED = f"""labelled AS MATERIALIZED (SELECT m.id, m.body, m.priority, m.lang_hint AS "Language", c.complaint_type,
 {name_of('m.lang_hint')} AS "LangName" FROM mails m LEFT JOIN case_meta c ON m.parent_id IS NOT DISTINCT FROM c.id)"""


def labelled(select: str) -> str:
    return f"WITH {VIEWS},\n{LABELLED}\n{select}"


NORMAL = "CASE WHEN {c} IN ('', 'nan') THEN NULL ELSE {c} END AS {c}"
LABEL_OF = "CAST(CASE WHEN {c} IS NULL OR lower({s}) = 'not applicable' THEN 0 ELSE 1 END AS BIGINT)"


def label_of(c: str) -> str:
    return LABEL_OF.format(c=c, s=strip(c))


COMPLAINTS = ("SELECT m.id AS k, m.body AS x FROM mails m JOIN case_meta c ON m.parent_id IS NOT DISTINCT FROM c.id")


def complaints(select: str) -> str:
    """``select`` may read rows(id, clean, complaint_type, complaint)."""
    return with_clean(f"""SELECT * FROM ({select.replace('{rows}', f'''(SELECT c.k AS id, c.x AS clean, t.complaint_type,
 {label_of('t.complaint_type')} AS complaint FROM clean c JOIN case_meta t ON CAST(c.k AS VARCHAR) = t.id
 WHERE length(c.x) >= 120)''')})""", COMPLAINTS)


def split_of(source: str, key: str) -> str:
    return f"""(SELECT *, CASE WHEN at_ <= cut1 THEN 'train' WHEN at_ <= cut1 + cut2 THEN 'validation' ELSE 'test' END AS split
 FROM (SELECT *, row_number() OVER (ORDER BY md5(concat({key}, ':42')), {key}) AS at_,
  CAST(trunc(CAST(count(*) OVER () AS DOUBLE) * CAST(0.7 AS DOUBLE)) AS BIGINT) AS cut1,
  CAST(trunc(CAST(count(*) OVER () AS DOUBLE) * CAST(0.15 AS DOUBLE)) AS BIGINT) AS cut2 FROM {source}))"""


LABEL_SPLIT = split_of("(SELECT doc_id, CAST(quality AS BIGINT) AS label FROM labels)", "doc_id")

PRED = """(SELECT d.doc_id, CAST(l.quality AS BIGINT) AS "TrueLabel", CASE WHEN d.n_chars > 1000 THEN 1::BIGINT ELSE 0::BIGINT END AS "PredictedLabel",
 l.quality = CASE WHEN d.n_chars > 1000 THEN 1 ELSE 0 END AS "Correct" FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""
KIND_PRED = """(SELECT d.doc_id, CAST(l.quality + 2 * l.toxic AS BIGINT) AS "TrueLabel",
 CAST(CASE WHEN d.n_chars > 4000 THEN 3 WHEN d.n_chars > 1000 THEN 1 ELSE 0 END AS BIGINT) AS "PredictedLabel"
 FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

BINARY_METRICS = f"""SELECT round(hits / n, 6) AS accuracy, round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision,
 round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall,
 round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1
FROM (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER ("TrueLabel" = "PredictedLabel") AS DOUBLE) AS hits,
 CAST(count(*) FILTER ("TrueLabel" = 1 AND "PredictedLabel" = 1) AS DOUBLE) AS tp,
 CAST(count(*) FILTER ("TrueLabel" <> 1 AND "PredictedLabel" = 1) AS DOUBLE) AS fp,
 CAST(count(*) FILTER ("TrueLabel" = 1 AND "PredictedLabel" <> 1) AS DOUBLE) AS fn FROM {PRED})"""

MACRO_METRICS = f"""WITH p AS ({KIND_PRED[1:-1]}), classes AS (SELECT "TrueLabel" AS c FROM p UNION SELECT "PredictedLabel" FROM p),
r AS (SELECT c, (SELECT count(*) FROM p WHERE "TrueLabel" = c AND "PredictedLabel" = c)::DOUBLE AS tp,
 (SELECT count(*) FROM p WHERE "TrueLabel" <> c AND "PredictedLabel" = c)::DOUBLE AS fp,
 (SELECT count(*) FROM p WHERE "TrueLabel" = c AND "PredictedLabel" <> c)::DOUBLE AS fn FROM classes)
SELECT round((SELECT avg(CASE WHEN "TrueLabel" = "PredictedLabel" THEN 1.0::DOUBLE ELSE 0 END) FROM p), 6) AS accuracy,
 round(avg(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END), 6) AS precision,
 round(avg(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END), 6) AS recall,
 round(avg(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END), 6) AS f1 FROM r"""


# --- the trigram model -----------------------------------------------------------------------------------------------

def taught(key: str) -> str:
    return f"substr(md5(concat({key}, ':lang')), 1, 1) < '8'"


def grams(source: str, carry: str, x: str) -> str:
    plain = f"' ' || trim(regexp_replace(lower({x}), '[^\\p{{L}}]+', ' ', 'g')) || ' '"
    return f"""SELECT {carry}, unnest(list_transform(list_filter(range(1, len(p) - 1), lambda i: p[i + 1] <> ' '),
  lambda i: p[i] || p[i + 1] || p[i + 2])) AS gram
 FROM (SELECT {carry}, string_split({plain}, '') AS p FROM {source})"""


WEIGHT = "CAST(round(ln(({n} + 1)::DOUBLE / ({total} + (SELECT count(DISTINCT gram) FROM counted))::DOUBLE) * 10000) AS INTEGER)"
ALL = "documents"
HALF = f"(SELECT * FROM documents WHERE {taught('doc_id')})"


def model_of(source: str) -> str:
    return f"""counted AS MATERIALIZED (SELECT lang, gram, count(*) AS n FROM ({grams(source, 'lang', 'text')}) GROUP BY 1, 2),
model AS MATERIALIZED (SELECT lang, gram, n, total, (SELECT count(DISTINCT gram) FROM counted) AS vocabulary, {WEIGHT.format(n='n', total='total')} AS weight
 FROM (SELECT *, CAST(sum(n) OVER (PARTITION BY lang) AS BIGINT) AS total FROM counted))"""


def detect(texts: str, source: str = ALL) -> str:
    """CTEs ending in found(k, code): the language of texts(k, x) that hold any trigram, by a model of a source."""
    return f"""{model_of(source)},
g AS MATERIALIZED (SELECT k, gram, count(*) AS n FROM ({grams(texts, 'k', 'x')}) GROUP BY 1, 2),
totals AS (SELECT DISTINCT lang, total FROM model),
scores AS (SELECT g.k, t.lang, sum(g.n * coalesce(m.weight, {WEIGHT.format(n='0', total='t.total')})) AS score
 FROM g CROSS JOIN totals t LEFT JOIN model m ON m.lang = t.lang AND m.gram = g.gram GROUP BY 1, 2),
found AS (SELECT k, lang AS code FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, lang) AS r FROM scores) WHERE r = 1)"""


def detect_on(source_steps, tail: str, source: str = "SELECT id AS k, body AS x FROM mails", learned: str = ALL) -> str:
    ctes, last = chain(source, source_steps)
    return f"WITH {VIEWS},\n{ctes},\n{detect(last, learned)}\n{tail}"


# --- profiles ------------------------------------------------------------------------------------------------------------

def long_table(source: str, columns: list[str], as_type: str = "VARCHAR") -> str:
    return " UNION ALL ".join(f"SELECT {q(c)} AS \"column\", CAST(\"{c}\" AS {as_type}) AS v FROM {source}" for c in columns)


LINE_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_COLUMNS = [*LINE_NUMBERS, "l_returnflag", "l_linestatus", "l_shipdate"]
MAIL_TEXTS = ["parent_id", "lang_hint", "priority", "body"]
LABELLED_COLUMNS = ["id", "body", "priority", "Language", "complaint_type", "LangName"]


CATEGORICAL = f"""WITH {VIEWS}, long AS MATERIALIZED ({long_table('mails', MAIL_TEXTS)}),
groups AS (SELECT "column", v, count(*) AS c FROM long WHERE v IS NOT NULL GROUP BY 1, 2),
tops AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY c DESC, v) AS r FROM groups) WHERE r = 1)
SELECT l."column", count(l.v) AS count, count(DISTINCT l.v) AS "unique", any_value(t.v) AS top, any_value(t.c) AS freq
FROM long l LEFT JOIN tops t ON l."column" = t."column" GROUP BY 1"""

NUMERIC = f"""SELECT "column", count(v) AS count, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std, min(v) AS min,
 round(quantile_cont(v, 0.25), 4) AS p25, round(quantile_cont(v, 0.5), 4) AS p50, round(quantile_cont(v, 0.75), 4) AS p75, max(v) AS max
FROM ({long_table('lineitem', LINE_NUMBERS, 'DOUBLE')}) GROUP BY 1"""

PROFILE = f"""WITH {VIEWS}, {LABELLED}, long AS MATERIALIZED ({long_table('labelled', LABELLED_COLUMNS)}),
groups AS (SELECT "column", v, count(*) AS c FROM long WHERE v IS NOT NULL GROUP BY 1, 2),
tops AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "column"
  ORDER BY c DESC, CASE "column" WHEN 'id' THEN TRY_CAST(v AS BIGINT) END, v) AS r FROM groups) WHERE r = 1),
domains AS (SELECT "column", string_agg(v, '|' ORDER BY v) AS values FROM groups GROUP BY 1 HAVING count(*) < 30),
base AS (SELECT "column", count(v) AS count, count(*) - count(v) AS nulls, count(DISTINCT v) AS "distinct", count(*) AS rows FROM long GROUP BY 1)
SELECT b."column", b.count, b.nulls, b."distinct", t.c AS freq, t.v AS top, d.values,
 CASE b."column" WHEN 'id' THEN 'bigint' ELSE 'string' END AS type,
 n.mean, n.std, n.min, n.p25, n.p50, n.p75, n.max, b.rows,
 (SELECT CAST(count(*) AS BIGINT) FROM labelled) - (SELECT count(*) FROM (SELECT DISTINCT * FROM labelled)) AS duplicate_rows
FROM base b LEFT JOIN tops t ON b."column" = t."column" LEFT JOIN domains d ON b."column" = d."column"
LEFT JOIN (SELECT 'id' AS "column", round(avg(id), 4) AS mean, round(stddev_samp(id), 4) AS std, CAST(min(id) AS DOUBLE) AS min,
 round(quantile_cont(id, 0.25), 4) AS p25, round(quantile_cont(id, 0.5), 4) AS p50, round(quantile_cont(id, 0.75), 4) AS p75,
 CAST(max(id) AS DOUBLE) AS max FROM labelled) n ON b."column" = n."column" """

SPAN_RE2 = "(?i)[aeiou]n|x+"  # hits of no length are dropped, so x* counts as x+


def spans(pattern: str) -> str:
    return on_mails(f"""SELECT id, CAST(s AS INTEGER) AS start, CAST(s + len(h) AS INTEGER) AS "end" FROM (
 SELECT id, m[i] AS h, list_sum(list_transform(g[1:i], lambda e: length(e))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda e: length(e))), 0) AS s
 FROM (SELECT id, m, g, unnest(range(1, len(m) + 1)) AS i FROM (
  SELECT id, regexp_extract_all(body, {q(pattern)}) AS m, string_split_regex(body, {q(pattern)}) AS g FROM mails WHERE body IS NOT NULL)))""")


FOUND = f"(?i){SEARCH}"
MISSING_CELLS = ", ".join(map(q, X.MISSING_CELLS))

PREPARED_ROWS = """SELECT f."MailId", f."Subject", f."Priority", f.kind AS "AGR_Type_of_Complaint__c", m."SuppliedEmail" AS "META_SuppliedEmail",
 {label} AS "Complaint", c.x AS "ProcessedTextBody" FROM files f JOIN case_file m ON f."ParentId" = m."Id" JOIN clean c ON c.k = f."MailId"
 WHERE length(c.x) >= 120""".replace("{label}", label_of("f.kind"))
FILES = f"""files AS MATERIALIZED (SELECT MailId AS "MailId", ParentId AS "ParentId", Subject AS "Subject", Priority AS "Priority",
 AGR_Type_of_Complaint__c AS kind, CASE WHEN TextBody IN ('', 'nan') THEN NULL ELSE TextBody END AS body
 FROM ({MAIL_FILE.format(mails='mails', case_meta='case_meta')})),
case_file AS MATERIALIZED ({CASE_FILE.format(labels='labels')}),
"""
PREPARED = with_clean(PREPARED_ROWS, "SELECT f.\"MailId\" AS k, coalesce(f.body, 'nan') AS x FROM files f JOIN case_file m ON f.\"ParentId\" = m.\"Id\"", FILES)

_STEPS, _LAST = chain("SELECT f.\"MailId\" AS k, coalesce(f.body, 'nan') AS x FROM files f JOIN case_file m ON f.\"ParentId\" = m.\"Id\"",
                      [*CLEAN, simple(t13), step_sentence])
PREPARED_LANGUAGES = f"""WITH {VIEWS},
{FILES}{_STEPS},
{detect(_LAST)}
SELECT p.*, coalesce(f.body, 'nan') AS "TextBody", coalesce(d.code, 'unknown') AS "Language", {name_of("coalesce(d.code, 'unknown')")} AS "LangName"
FROM ({PREPARED_ROWS.replace('clean c', f's{len(CLEAN)} c')}) p JOIN files f ON f."MailId" = p."MailId" LEFT JOIN found d ON d.k = p."MailId" """

COMPLAINT_ROWS = complaints("SELECT id, complaint AS label FROM {rows} WHERE clean IS NOT NULL AND complaint IS NOT NULL")
TYPE_ROWS = complaints("""SELECT id, CAST(dense_rank() OVER (ORDER BY complaint_type) - 1 AS BIGINT) AS label FROM {rows}
 WHERE complaint = 1 AND complaint_type IS NOT NULL AND complaint_type <> 'Not applicable'""")

ORACLE: dict[str, str] = {
    "s1_read_delimited": on_mails("SELECT " + ", ".join(
        f"CASE WHEN CAST({c} AS VARCHAR) IN ({MISSING_CELLS}) THEN NULL ELSE CAST({c} AS VARCHAR) END AS {c}"
        for c in ["id", *MAIL_TEXTS]) + " FROM mails"),
    "s1_read_delimited_folder": on_mails("SELECT " + ", ".join(
        f"CASE WHEN CAST({c} AS VARCHAR) IN ({MISSING_CELLS}) THEN NULL ELSE CAST({c} AS VARCHAR) END AS {c}"
        for c in ["id", *MAIL_TEXTS]) + " FROM mails"),
    "s7_encoding_census": """SELECT lang, CASE WHEN plain THEN 'ascii' ELSE 'utf-8' END AS encoding,
 CASE WHEN plain THEN 1.0::DOUBLE ELSE 0.99::DOUBLE END AS confidence
FROM (SELECT lang, bool_and(strlen(text) = length(text)) AS plain FROM documents WHERE text IS NOT NULL GROUP BY 1)""",
    "s2_read_snapshot": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "s3_write_snapshot": with_clean("SELECT k AS id, x AS clean FROM clean WHERE length(x) >= 120"),
    "s4_write_predictions": f"SELECT *, 'test_predictions' AS file FROM {PRED} UNION ALL "
                            f"SELECT *, 'incorrect_predictions' AS file FROM {PRED} WHERE NOT \"Correct\"",
    "s5_write_stats": f"""WITH p AS (SELECT * FROM {LABEL_SPLIT})
SELECT (SELECT count(*) FROM p) AS total, (SELECT count(*) FROM p WHERE split = 'train') AS train,
 (SELECT count(*) FROM p WHERE split = 'validation') AS validation, (SELECT count(*) FROM p WHERE split = 'test') AS test,
 split, CAST(label AS VARCHAR) AS label, n AS count, {hundredths('n', 't')} / 100.0::DOUBLE AS percent
FROM (SELECT split, label, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY split) AS BIGINT) AS t FROM p GROUP BY 1, 2)""",
    "s5_write_metrics": BINARY_METRICS,
    "s6_export_distinct": "SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL",
    "c1_drop_all_null_columns": on_mails(f"SELECT id, {NORMAL.format(c='complaint_type')} FROM case_meta"),
    "c2_normalize_nulls": on_mails("SELECT id, " + ", ".join(NORMAL.format(c=c) for c in MAIL_TEXTS) + " FROM mails"),
    "c3_find_all_null_columns": on_mails(" UNION ALL ".join(
        f"SELECT {q(c)} AS \"column\" FROM case_meta HAVING count({c}) = 0" for c in ("id", "complaint_type", "all_null_col"))),
    "c4_drop_duplicate_columns": "SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
    "c5_prefix_columns": on_mails('SELECT id AS "META_id", complaint_type AS "META_complaint_type", all_null_col AS "META_all_null_col" FROM case_meta'),
    "c6_select_existing": on_mails("SELECT priority, body, id FROM mails"),
    "c7_derive_complaint_label": on_mails(f"SELECT id, complaint_type, {label_of('complaint_type')} AS complaint FROM case_meta"),
    "c8_pick": on_mails("SELECT *, 151::BIGINT AS position, (SELECT count(*) FROM mails) AS total FROM mails ORDER BY id LIMIT 1 OFFSET 150"),
    "c8_pick_text_key": on_mails("SELECT *, 151::BIGINT AS position, (SELECT count(*) FROM mails) AS total FROM mails ORDER BY parent_id LIMIT 1 OFFSET 150"),
    "c8_limit": on_mails("SELECT * FROM mails ORDER BY id LIMIT 25"),
    "c9_body_as_text": on_mails("SELECT id, coalesce(body, 'nan') AS body FROM mails"),
    "j1_join_metadata": on_mails('SELECT m.*, c.id AS "META_id", c.complaint_type AS "META_complaint_type", c.all_null_col AS "META_all_null_col" '
                                 "FROM mails m JOIN case_meta c ON m.parent_id IS NOT DISTINCT FROM c.id"),
    "j1_join_metadata_outer": on_mails("""SELECT m.id, m.priority, k.known_priority, k.mails FROM mails m FULL JOIN
 (SELECT priority AS known_priority, count(*) AS mails FROM mails WHERE priority IS NULL OR priority <> 'Low' GROUP BY 1
  UNION ALL SELECT 'Urgent', count(*) FROM mails) k ON m.priority IS NOT DISTINCT FROM k.known_priority"""),
    "j1_heavy_keys": on_mails("""SELECT priority, mails, mails AS cases FROM (SELECT *, sum(mails * mails) OVER () AS whole
 FROM (SELECT priority, count(*) AS mails FROM mails GROUP BY 1)) WHERE mails * mails > whole / 16.0::DOUBLE AND mails > 1"""),
    "j2_language_names": f"SELECT doc_id, lang, {name_of('lang')} AS lang_name_en FROM documents",
    "j2_language_names_code_column": f"SELECT doc_id, lang AS code, source AS lang_name, {name_of('lang')} AS name FROM documents",
    "t1_strip_flexible_reply_header": body_steps(step_flexible),
    "t2_remove_empty_lines": body_steps(simple(t2)),
    "t3_reduce_spaces": body_steps(simple(t3)),
    "t4_remove_non_printable": body_steps(simple(t4)),
    "t5_remove_http_brackets": body_steps(simple(t5)),
    "t6_clean_thread_ids": body_steps(simple(t6)),
    "t7_remove_cid": body_steps(simple(t7)),
    "t8_strip_known_reply_headers": body_steps(step_known),
    "t9_remove_html": body_steps(simple(t9)),
    "t9_remove_html_pages": body_steps(simple(t9), source="SELECT page_id AS k, html AS x FROM pages", key="page_id"),
    "t10_apply_discard_patterns": body_steps(simple(t10)),
    "t11_remove_sensitive_lines": body_steps(simple(t11)),
    "t12_redact": body_steps(simple(t12)),
    "t12_redact_token": body_steps(simple(lambda x: t12(x, True))),
    "t13_clean_crlf": body_steps(simple(t13)),
    "t14_last_valid_sentence": body_steps(step_sentence),
    "t15_clean_text": body_steps(*CLEAN),
    "t15_clean_pages": body_steps(*CLEAN, source="SELECT page_id AS k, html AS x FROM pages", key="page_id"),
    "t16_filter_short": with_clean("SELECT k AS id, x AS clean FROM clean WHERE length(x) >= 120"),
    "t17_truncate_tokens": body_steps(simple(t17)),
    "l1_detect_language": detect_on([*CLEAN, simple(t13), step_sentence], f"""SELECT m.id, coalesce(f.code, 'unknown') AS "Language",
 {name_of("coalesce(f.code, 'unknown')")} AS "LangName" FROM mails m LEFT JOIN found f ON f.k = m.id"""),
    "l1_accuracy": detect_on([simple(t13), step_sentence], """SELECT lang, count(*) AS texts, count(*) FILTER (f.code = lang) AS "right"
FROM documents d LEFT JOIN found f ON f.k = d.doc_id WHERE NOT """ + taught('d.doc_id') + " GROUP BY 1",
        f"SELECT doc_id AS k, text AS x FROM documents WHERE NOT {taught('doc_id')}", HALF),
    "l2_language_model": f"WITH {model_of(ALL)} SELECT lang, gram, n, total, vocabulary, weight FROM model",
    "l3_detect_language_or_unknown": detect_on([simple(t13), step_sentence], f"""SELECT m.id,
 CASE WHEN m.body IS NULL OR {strip('m.body')} = '' THEN 'unknown' ELSE coalesce(f.code, 'unknown') END AS "Language"
FROM mails m LEFT JOIN found f ON f.k = m.id"""),
    "l4_language_distribution": f"""SELECT "Language", "EmailCount",
 concat({hundredths('"EmailCount"', 't')} // 100, '.', lpad(CAST({hundredths('"EmailCount"', 't')} % 100 AS VARCHAR), 2, '0'), '%') AS "Percentage"
FROM (SELECT "Language", CAST(sum(n) AS BIGINT) AS "EmailCount", CAST(sum(sum(n)) OVER () AS BIGINT) AS t
 FROM (SELECT CASE WHEN n < 120 THEN 'Other' ELSE name END AS "Language", n FROM
  (SELECT {name_of('lang')} AS name, count(*) AS n FROM documents GROUP BY 1)) GROUP BY 1)""",
    "p1_shape": on_mails("SELECT count(*) AS rows, 5::BIGINT AS columns FROM mails"),
    "p2_null_counts": labelled("SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT {q(c)} AS \"column\", count(*) - count(\"{c}\") AS nulls FROM labelled" for c in LABELLED_COLUMNS) + ") WHERE nulls > 0"),
    "p3_duplicate_rows": "SELECT (SELECT count(*) FROM documents) - (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS duplicate_rows",
    "p3_duplicate_rows_events": "SELECT (SELECT count(*) FROM events) - (SELECT count(*) FROM (SELECT DISTINCT * FROM events)) AS duplicate_rows",
    "p4_describe_numeric": NUMERIC,
    "p5_describe_categorical": CATEGORICAL,
    "p6_distinct_counts": f"SELECT \"column\", count(DISTINCT v) AS \"distinct\" FROM ({long_table('lineitem', LINE_COLUMNS)}) GROUP BY 1",
    "p7_small_domains": labelled(f"""SELECT "column", count(DISTINCT v) AS "distinct", string_agg(DISTINCT v, '|' ORDER BY v) AS values
FROM ({long_table('labelled', LABELLED_COLUMNS)}) WHERE v IS NOT NULL GROUP BY 1 HAVING count(DISTINCT v) < 30"""),
    "p8_value_counts": on_mails("SELECT priority, count(*) AS count FROM mails GROUP BY 1"),
    "p8_value_counts_orders": "SELECT o_orderpriority, count(*) AS count FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1",
    "p9_profile": PROFILE,
    "f1_search_regex": on_mails(f"SELECT id, body FROM mails WHERE regexp_matches(coalesce(body, 'nan'), {q(FOUND)})"),
    "f1_search_regex_named_group": on_mails("SELECT id FROM mails WHERE regexp_matches(coalesce(body, 'nan'), '(?i)(?:anan|enen|inin|onon|unun)\\z|the of')"),
    "f2_search_text": on_mails("SELECT id, body FROM mails WHERE regexp_matches(body, '(?i)exampl..com')"),
    "f2_search_indexed": on_mails("SELECT id, body FROM mails WHERE regexp_matches(body, '(?i)exampl..com')"),
    "f2_search_text_literal": on_mails("SELECT id, body FROM mails WHERE contains(lower(body), 'example.com')"),
    "f3_max_length": with_clean("SELECT k AS id, x AS clean FROM clean WHERE length(x) <= 800"),
    "f4_filter_complaint_type": labelled("SELECT id, complaint_type FROM labelled WHERE complaint_type = 'Packaging'"),
    "f4_filter_complaint_type_missing": labelled("SELECT id, priority FROM labelled WHERE complaint_type IS NULL"),
    "f5_filter_language": labelled('SELECT id, "Language", "LangName" FROM labelled WHERE "Language" = \'fr\''),
    "f6_filter_priority": on_mails("SELECT id, parent_id FROM mails WHERE priority IS NULL"),
    "f6_filter_priority_orders": "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'",
    "f7_facet_counts": labelled("""SELECT 'complaint_type' AS facet, complaint_type AS value, NULL::VARCHAR AS code, count(*) AS n
FROM labelled WHERE regexp_matches(body, '(?i)the') GROUP BY 2 UNION ALL
SELECT 'language', "LangName", min("Language"), count(*) FROM labelled WHERE regexp_matches(body, '(?i)the') AND "LangName" IS NOT NULL GROUP BY 2 UNION ALL
SELECT 'priority', priority, NULL, count(*) FROM labelled WHERE regexp_matches(body, '(?i)the') GROUP BY 2"""),
    "f8_explore": with_clean(f"""SELECT l.id, c.x AS clean FROM labelled l JOIN clean c ON c.k = l.id WHERE regexp_matches(l.body, {q(FOUND)})
 AND length(c.x) <= 4000 AND l.complaint_type IS NULL AND l."Language" = 'en' AND l.priority = 'High'""", more=LABELLED + ",\n"),
    "f9_page": labelled('SELECT id, body, "Language" FROM labelled WHERE "Language" = \'de\' AND id > 100 ORDER BY id LIMIT 20'),
    "f9_page_before": labelled('SELECT id, body, "Language" FROM labelled WHERE "Language" = \'de\' AND id < 180 ORDER BY id DESC LIMIT 20'),
    "f9_record_at": labelled("""SELECT id, body, "Language", position, total FROM (SELECT *, row_number() OVER (ORDER BY id) AS position,
 count(*) OVER () AS total FROM labelled WHERE "Language" = 'es') WHERE position = 17"""),
    "f9_record_at_ordered": labelled("""SELECT id, body, "Language", position, total FROM (SELECT *, row_number() OVER (ORDER BY id) AS position,
 count(*) OVER () AS total FROM labelled WHERE "Language" = 'es') WHERE position = 17"""),
    "f10_match_spans": spans(SPAN_RE2),
    "f9_record_at_text_key": labelled("""SELECT key, id, position, total FROM (SELECT md5(CAST(id AS VARCHAR)) AS key, id,
 row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR))) AS position, count(*) OVER () AS total FROM labelled) WHERE position = 123"""),
    "f10_match_spans_repeated_key": f"WITH s AS ({spans(r'(?i)e' + chr(92) + '. ')}), p AS ({on_mails('SELECT id, priority FROM mails')}) SELECT priority, start, \"end\", count(*) AS n FROM s JOIN p USING (id) GROUP BY ALL",
    "f10_match_spans_literal": spans(r"(?i)e\. "),
    "d1_binary_dataset": complaints("SELECT id, clean, complaint AS label FROM {rows} WHERE clean IS NOT NULL AND complaint IS NOT NULL"),
    "d2_type_dataset": complaints("SELECT id, clean, complaint_type FROM {rows} WHERE complaint = 1 AND complaint_type IS NOT NULL AND complaint_type <> 'Not applicable'"),
    "d3_encode_labels": on_mails("SELECT id, complaint_type, CAST(dense_rank() OVER (ORDER BY complaint_type) - 1 AS BIGINT) AS label FROM case_meta WHERE complaint_type IS NOT NULL"),
    "d3_label_mapping": on_mails('SELECT c AS "class", CAST(row_number() OVER (ORDER BY c) - 1 AS BIGINT) AS label FROM (SELECT DISTINCT complaint_type AS c FROM case_meta WHERE complaint_type IS NOT NULL)'),
    "d4_split_dataset": f"SELECT doc_id, lang, split FROM {split_of('(SELECT doc_id, lang FROM documents)', 'doc_id')}",
    "d5_dataset_stats": f"""SELECT split, label, lang AS label_name, n AS count, {hundredths('n', 't')} / 100.0::DOUBLE AS percent, t AS split_total, total
FROM (SELECT split, label, lang, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY split) AS BIGINT) AS t, CAST(sum(count(*)) OVER () AS BIGINT) AS total
 FROM {split_of('(SELECT doc_id, lang, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS BIGINT) AS label FROM documents)', 'doc_id')} GROUP BY 1, 2, 3)""",
    "d6_class_weights": f"""SELECT label, n AS count, round(CAST(sum(n) OVER () AS DOUBLE) / (count(*) OVER () * n), 9) AS weight
FROM (SELECT label, count(*) AS n FROM {LABEL_SPLIT} WHERE split = 'train' GROUP BY 1)""",
    "m1_train_classifier": f"SELECT id, label AS \"TrueLabel\", true AS known_class, true AS judged FROM {split_of('(' + COMPLAINT_ROWS + ')', 'id')} WHERE split = 'test'",
    "m2_select_best": "SELECT 2::BIGINT AS rounds, true AS is_best",
    "m3_score_types": f"SELECT id, label AS \"TrueLabel\", true AS known_class, true AS judged FROM {split_of('(' + TYPE_ROWS + ')', 'id')} WHERE split = 'test'",
    "train_complaint_types": f"""SELECT id, label AS "TrueLabel", true AS known_class, true AS judged FROM {split_of('''(SELECT "MailId" AS id,
 CAST(dense_rank() OVER (ORDER BY "AGR_Type_of_Complaint__c") - 1 AS BIGINT) AS label FROM (''' + PREPARED + ''')
 WHERE "Complaint" = 1 AND "AGR_Type_of_Complaint__c" IS NOT NULL AND "AGR_Type_of_Complaint__c" <> 'Not applicable')''', 'id')} WHERE split = 'test'""",
    "m3_argmax": "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS best FROM embeddings",
    "m4_metrics_binary": BINARY_METRICS,
    "m4_metrics_macro": MACRO_METRICS,
    "m5_errors": f"SELECT * FROM {PRED} WHERE NOT \"Correct\"",
    "m6_confusion": f'SELECT "TrueLabel", "PredictedLabel", count(*) AS n FROM {KIND_PRED} GROUP BY 1, 2',
    "prepare_mails": PREPARED_LANGUAGES,
    "complaints_by_priority": "SELECT \"Priority\", count(*) AS mails, CAST(sum(\"Complaint\") AS BIGINT) AS complaints FROM (" + PREPARED + ") GROUP BY 1",
}
