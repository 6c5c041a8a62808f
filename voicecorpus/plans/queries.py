"""Registered queries over the engine's own operators, with their DuckDB SQL.

The driver's tables stand for the engine's: documents for books and chapters, benchmark for
book text, labels for verdicts, events for timed segments and for regions, embeddings for
waveforms of 64 samples, orders and customer for segments and chapters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import signal as S
from ..functions import text as T
from ..operators import alignment, evaluate, export, quality, review, segments, text_prep

QUERIES: dict = {}
ORACLES: dict = {}


def _query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _seconds():
    """Seconds since 1970 of ts, whatever the session's time zone."""
    return F.expr("datediff(cast(ts as date), date'1970-01-01') * 86400L + hour(ts) * 3600 + minute(ts) * 60 + cast(floor(second(ts)) as bigint)")


# ---- text

_CLEAN = lambda x: f"regexp_replace(translate(replace(regexp_replace(translate({x}, chr(160), ' '), '[ \\t]+', ' ', 'g'), '…', '...'), '–—', '--'), '^\\s+|\\s+$', '', 'g')"
_PARAS = "list_filter(list_transform(regexp_split_to_array(text, '\\n\\s*\\n'), lambda b: regexp_replace(regexp_replace(regexp_replace(b, '^\\s+|\\s+$', '', 'g'), '\\s*\\n\\s*', ' ', 'g'), '[ \\t]+', ' ', 'g')), lambda b: b <> '')"
_SHORT = "|".join(sorted((w for ws in T.NO_STOP.values() for w in ws), key=lambda w: (-len(w), w)))
_L = T.TOKEN_LETTERS
_MARK = (
    "regexp_replace(regexp_replace(regexp_replace({p}, "
    f"'([.!?…]+)(\\s+{T.OPENERS})', '\\1' || chr(1) || '\\2', 'g'), "
    f"'(?i)(^|[^{_L}])({_SHORT}|[{T.CAPITALS}a-zá-ž])(\\.+)' || chr(1), '\\1\\2\\3', 'g'), "
    f"'((?i:^|[^{_L}]))([0-9]+)(\\.+)' || chr(1) || '(\\s+[^{T.CAPITALS}\\s])', '\\1\\2\\3\\4', 'g')"
)
_SENTS = f"list_filter(list_transform(flatten(list_transform({_PARAS}, lambda p: string_split({_MARK.format(p='p')}, chr(1)))), lambda s: regexp_replace(s, '^\\s+|\\s+$', '', 'g')), lambda s: s <> '')"
_TOKENS = lambda x: f"list_transform(regexp_extract_all({x}, '{T.TOKEN}'), lambda w: lower(w))"
_SENT_ROWS = f"s0 AS (SELECT doc_id, lang, source, {_SENTS} AS a FROM documents), s AS (SELECT doc_id, lang, source, unnest(range(len(a)))::INT AS \"order\", unnest(a) AS sentence FROM s0)"


@_query(f"SELECT doc_id, {_CLEAN('text')} AS cleaned FROM documents")
def clean_text(spark, d):
    return _t(spark, d, "documents").select("doc_id", T.clean_text(F.col("text")).alias("cleaned"))


@_query(f"WITH p AS (SELECT doc_id, {_PARAS} AS a FROM documents) SELECT doc_id, unnest(range(len(a)))::INT AS idx, unnest(a) AS paragraph FROM p")
def paragraphs(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.posexplode(T.paragraphs(F.col("text"))).alias("idx", "paragraph"))


def _sentences(spark, d):
    return _t(spark, d, "documents").select("doc_id", "lang", "source", F.posexplode(T.sentences(F.col("text"))).alias("order", "sentence"))


@_query(f'WITH {_SENT_ROWS} SELECT doc_id, "order", sentence FROM s')
def sentences(spark, d):
    return _sentences(spark, d).select("doc_id", "order", "sentence")


@_query(f"WITH {_SENT_ROWS} SELECT lang, count(DISTINCT doc_id) AS docs, count(*) AS sentences, sum(len({_TOKENS('sentence')}))::BIGINT AS tokens FROM s GROUP BY lang")
def sentence_stats(spark, d):
    """Counted within each document's row, so that one row for each is aggregated.  Tokens hold no
    white space, so those of the sentences are those of the text."""
    s = _t(spark, d, "documents").select("doc_id", "lang", F.size(T.sentences(F.col("text"))).cast("long").alias("n"), F.regexp_count("text", F.lit(T.TOKEN)).cast("long").alias("tokens"))
    s = s.groupBy("lang").agg(F.countDistinct(F.when(F.col("n") > 0, F.col("doc_id"))).alias("docs"), F.sum("n").alias("sentences"), F.sum(F.when(F.col("n") > 0, F.col("tokens"))).alias("tokens"))
    return s.where("sentences > 0")


_IDS = f"""r AS (SELECT printf('%s_s%05d', doc_id::VARCHAR, "order") AS sent_id, {_CLEAN('sentence')} AS text, {_TOKENS('sentence')} AS tokens FROM s)"""


@_query(f"WITH {_SENT_ROWS}, {_IDS} SELECT sent_id, text, array_to_string(tokens, ' ') AS tokens FROM r WHERE len(tokens) > 0")
def sentence_records(spark, d):
    s = _sentences(spark, d).where(F.col("sentence").rlike(T.TOKEN))
    return s.select(T.sentence_id(F.col("doc_id").cast("string"), F.col("order")).alias("sent_id"), T.clean_text(F.col("sentence")).alias("text"), F.lower(F.array_join(T.words(F.col("sentence")), " ")).alias("tokens"))


@_query(f"WITH t AS (SELECT unnest({_TOKENS('text')}) AS token FROM documents) SELECT token, count(*) AS n FROM t GROUP BY token")
def token_counts(spark, d):
    return _t(spark, d, "documents").select(F.explode(T.tokenize(F.col("text"))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


@_query(f"WITH t AS (SELECT DISTINCT unnest({_TOKENS('text')}) AS token FROM documents) SELECT token, strip_accents(token) AS folded FROM t")
def folded_tokens(spark, d):
    t = _t(spark, d, "documents").select(F.explode(T.tokenize(F.col("text"))).alias("token")).distinct()
    return t.select("token", T.fold(F.col("token")).alias("folded"))


def _sql_abbreviations(x: str) -> str:
    for key, form in [*sorted(T.DOTTED.items(), key=lambda kv: (-len(kv[0]), kv[0])), *T.UNDOTTED.items()]:
        stop = "\\." if key in T.DOTTED else "($|[^0-9A-Za-z_À-ɏ])"
        back = "" if key in T.DOTTED else "\\2"
        rest = f"(?i:{key[1:]})" if key[1:] else ""
        for k, f in ((key[0].upper() + rest, form[0].upper() + form[1:]), (key[0] + rest, form)):
            x = f"regexp_replace({x}, '(^|[^0-9A-Za-z_À-ɏ]){k}{stop}', '\\1{f}{back}', 'g')"
    return x


@_query("SELECT doc_id, " + _sql_abbreviations("text") + " AS expanded FROM documents")
def abbreviations(spark, d):
    return _t(spark, d, "documents").select("doc_id", T.expand_abbreviations(F.col("text")).alias("expanded"))


def _sql_spoken(digits: str) -> str:
    """Words of a number given as digits, from the lists of words that a query has as alone and before."""
    n = f"({digits})::BIGINT"
    groups = []
    for k in (3, 2, 1, 0):
        x = f"({n} // {1000**k} % 1000)"
        if k:
            one, some, many = T.SCALES[k - 1]
            scale = f"CASE WHEN {x} = 1 THEN '{one}' WHEN {x} % 10 BETWEEN 2 AND 4 AND {x} % 100 NOT BETWEEN 10 AND 20 THEN '{some}' ELSE '{many}' END"
            groups.append(f"CASE WHEN {x} > 0 THEN ltrim(before[{x} + 1] || ' ' || {scale}) END")
        else:
            groups.append(f"CASE WHEN {x} > 0 THEN alone[{x} + 1] END")
    return f"CASE WHEN length({digits}) > 12 THEN {digits} WHEN {digits} = '' THEN 'nula' ELSE concat_ws(' ', {', '.join(groups)}) END"


_NUMBERS = r"(?:[0-9]{1,3}(?:[ \x{00a0}.][0-9]{3})+|[0-9]+)(?:,[0-9]+)?"


def _sql_expanded(x: str) -> str:
    """``x`` with its numbers in words: split at them, and joined with their words."""
    whole, part = "ltrim(regexp_replace(string_split(m, ',')[1], '[^0-9]', '', 'g'), '0')", "ltrim(string_split(m, ',')[2], '0')"
    words = f"{_sql_spoken(whole)} || CASE WHEN contains(m, ',') THEN ' celá ' || {_sql_spoken(part)} ELSE '' END"
    return (
        f"array_to_string(list_transform(list_zip(string_split_regex({x}, '{_NUMBERS}'), list_append(list_transform(regexp_extract_all({x}, '{_NUMBERS}'), lambda m: {words}), '')), lambda z: z[1] || coalesce(z[2], '')), '')"
    )


_WORD_LISTS = ", ".join("[" + ", ".join(f"'{w}'" for w in T._below_thousand(alone)) + f"] AS {name}" for alone, name in ((True, "alone"), (False, "before")))


@_query(
    f"""WITH {_SENT_ROWS}, l AS (SELECT {_WORD_LISTS}), c AS (SELECT *, {_CLEAN('sentence')} AS text FROM s),
a AS (SELECT *, {_sql_abbreviations('text')} AS spoken FROM c),
e AS (SELECT doc_id, "order", text, regexp_replace(regexp_replace({_sql_expanded('spoken')}, '\\s+', ' ', 'g'), '^ | $', '', 'g') AS normalized FROM a, l)
SELECT printf('%s_s%05d', doc_id::VARCHAR, "order") AS sent_id, text, normalized, len({_TOKENS('normalized')})::INT AS n_tokens FROM e WHERE len({_TOKENS('normalized')}) > 0"""
)
def normalized_sentences(spark, d):
    return text_prep.sentence_records(_t(spark, d, "documents"), book="doc_id").select("sent_id", "text", "normalized", F.size("tokens").alias("n_tokens"))


def _sql_number(n: str) -> str:
    arr = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
    low = lambda x: f"list_filter([CASE WHEN {x} >= 100 THEN {arr(T.HUNDREDS)}[{x} // 100] END, CASE WHEN {x} % 100 >= 20 THEN {arr(T.TENS)}[{x} % 100 // 10 - 1] WHEN {x} % 100 > 0 THEN {arr(T.ONES)}[{x} % 100] END, CASE WHEN {x} % 100 >= 20 AND {x} % 10 > 0 THEN {arr(T.ONES)}[{x} % 10] END], lambda w: w IS NOT NULL)"
    k = f"({n} // 1000)"
    scale = f"CASE WHEN {k} = 1 THEN 'tisíc' WHEN {k} % 10 BETWEEN 2 AND 4 AND {k} % 100 NOT BETWEEN 10 AND 20 THEN 'tisíce' ELSE 'tisíc' END"
    return f"CASE WHEN {n} = 0 THEN 'nula' ELSE array_to_string(CASE WHEN {k} > 0 THEN CASE WHEN {k} = 1 THEN [] ELSE {low(k)} END || [{scale}] ELSE [] END || {low(f'({n} % 1000)')}, ' ') END"


@_query(f"SELECT p_partkey, {_sql_number('p_partkey')} AS key_words, {_sql_number('(p_partkey * 397 % 1000000)')} AS large_words FROM part")
def number_words(spark, d):
    p = F.col("p_partkey")
    return _t(spark, d, "part").select("p_partkey", T.number_words(p).alias("key_words"), T.number_words(p * 397 % 1000000).alias("large_words"))


# what is left beyond ASCII is one byte, as DuckDB counts bytes
_FOLD_SQL = lambda x: f"translate(regexp_replace(regexp_replace(regexp_replace(strip_accents(lower({x})), '[^\\p{{L}}\\p{{N}}\\s]', '', 'g'), '\\s+', ' ', 'g'), '^ | $', '', 'g'), 'ß', chr(1))"


@_query(
    f"""WITH b AS (SELECT item_id, text, row_number() OVER (ORDER BY item_id) - 1 AS k FROM benchmark),
x AS (SELECT doc_id, item_id, {_FOLD_SQL('b.text')} AS ref, {_FOLD_SQL('d.text')} AS hyp FROM documents d JOIN b ON b.k = d.doc_id % (SELECT greatest(1, count(*)) FROM b))
SELECT doc_id, item_id, CASE WHEN length(ref) > 0 THEN levenshtein(ref, hyp) / length(ref) END AS cer FROM x"""
)
def cer_pairs(spark, d):
    """Whole texts of every document, each against one item: the items by rank, dealt to the
    documents by doc_id modulo their counted number."""
    b = _t(spark, d, "benchmark").select("item_id", F.col("text").alias("r"))
    n = max(1, b.count())
    items = b.withColumn("k", F.row_number().over(W.orderBy("item_id")) - 1)
    docs = _t(spark, d, "documents").select("doc_id", F.col("text").alias("h"), F.pmod("doc_id", F.lit(n)).cast("int").alias("k"))
    return docs.join(items, "k").select("doc_id", "item_id", T.cer(F.col("r"), F.col("h")).alias("cer"))


@_query("SELECT page_id, replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS escaped FROM pages")
def xml_escape(spark, d):
    return _t(spark, d, "pages").select("page_id", T.xml_escape(F.col("html")).alias("escaped"))


@_query("SELECT event_id, (props::JSON->>'k')::INT AS k FROM events")
def json_block(spark, d):
    block = T.last_json_block(F.concat(F.lit("log {x} "), "props", F.lit(" end")))
    return _t(spark, d, "events").select("event_id", F.from_json(block, "k int")["k"].alias("k"))


# ---- grading and review

_CLIPS_SQL = """c AS (SELECT l_orderkey, l_linenumber, l_quantity * 0.4 AS duration, l_extendedprice / 100000 AS peak, l_discount * 6 AS silence_ratio, l_tax * 300 - 2 AS snr_db,
  CASE WHEN l_returnflag = 'A' THEN NULL ELSE (l_partkey % 40) / 100 END AS cer, (l_suppkey % 60)::DOUBLE AS edge FROM lineitem),
f AS (SELECT *, list_filter([CASE WHEN duration < 1 OR duration > 15 THEN 'duration' END, CASE WHEN round(peak, 4) >= 0.999 THEN 'clipping' END, CASE WHEN round(silence_ratio, 3) > 0.5 THEN 'silence' END,
  CASE WHEN round(snr_db, 2) < 10 THEN 'low_snr' END, CASE WHEN edge >= 40 THEN 'edge_noise' END, CASE WHEN cer > 0.2 THEN 'cer_high' WHEN cer > 0.1 THEN 'cer_review' END], lambda x: x IS NOT NULL) AS flags FROM c),
g AS (SELECT *, CASE WHEN list_has_any(flags, ['duration', 'silence', 'cer_high']) THEN 'reject' WHEN len(flags) > 0 THEN 'review' ELSE 'pass' END AS status FROM f)"""


def _graded(spark, d):
    li = _t(spark, d, "lineitem")
    clips = li.select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") * 0.4).alias("duration"), (F.col("l_extendedprice") / 100000).alias("peak"), (F.col("l_discount") * 6).alias("silence_ratio"), (F.col("l_tax") * 300 - 2).alias("snr_db"),
        F.when(F.col("l_returnflag") != "A", (F.col("l_partkey") % 40) / 100).alias("cer"), (F.col("l_suppkey") % 60).cast("double").alias("edge_lead_ms"), F.lit(0.0).alias("edge_tail_ms"),
    )
    return quality.grade(clips)


@_query(f"WITH {_CLIPS_SQL} SELECT l_orderkey, l_linenumber, array_to_string(flags, '|') AS flags, status FROM g")
def clip_status(spark, d):
    return _graded(spark, d).select("l_orderkey", "l_linenumber", T.flags_text(F.col("flags")).alias("flags"), "status")


@_query(f"WITH {_CLIPS_SQL} SELECT count(*) AS clips, count(*) FILTER (status = 'pass') AS pass, count(*) FILTER (status = 'review') AS review, count(*) FILTER (status = 'reject') AS reject FROM g")
def status_counts(spark, d):
    return quality.status_counts(_graded(spark, d))


@_query(f"WITH {_CLIPS_SQL} SELECT l_orderkey || '_' || l_linenumber AS clip_id, status, array_to_string(flags, '|') AS flags, duration FROM g WHERE status <> 'pass'")
def flagged_rows(spark, d):
    g = _graded(spark, d).withColumn("clip_id", F.concat_ws("_", "l_orderkey", "l_linenumber"))
    return quality.flagged(g).select("clip_id", "status", "flags", "duration")


@_query(f"WITH {_CLIPS_SQL} SELECT l_orderkey, l_linenumber FROM g WHERE status = 'review' AND list_contains(flags, 'low_snr')")
def listening_list(spark, d):
    return quality.select_for_listening(_graded(spark, d), "review", "low_snr").select("l_orderkey", "l_linenumber")


_REVIEW_SQL = """clips AS (SELECT doc_id AS clip_id, CASE WHEN n_chars % 5 = 0 THEN 'reject' WHEN n_chars % 5 < 3 THEN 'review' ELSE 'pass' END AS status FROM documents),
verdicts AS (SELECT doc_id + (doc_id % 7 = 0)::INT * 100000000 AS clip_id, CASE WHEN toxic = 1 THEN 'reject' ELSE 'approve' END AS verdict FROM labels),
a AS (SELECT clip_id, c.status AS status_before, v.verdict, CASE WHEN verdict = 'reject' THEN 'reject' WHEN verdict IS NOT NULL AND status = 'review' THEN 'pass' ELSE status END AS status FROM clips c LEFT JOIN verdicts v USING (clip_id))"""


def _reviewed(spark, d):
    n = F.col("n_chars") % 5
    clips = _t(spark, d, "documents").select(F.col("doc_id").alias("clip_id"), F.when(n == 0, "reject").when(n < 3, "review").otherwise("pass").alias("status"))
    v = _t(spark, d, "labels").select((F.col("doc_id") + F.when(F.col("doc_id") % 7 == 0, 100000000).otherwise(0)).alias("clip_id"), F.when(F.col("toxic") == 1, "reject").otherwise("approve").alias("verdict"))
    return clips, v


@_query(f"WITH {_REVIEW_SQL} SELECT clip_id, verdict, status_before, status FROM a")
def apply_verdicts(spark, d):
    return review.apply_verdicts(*_reviewed(spark, d)).select("clip_id", "verdict", "status_before", "status")


@_query(f"WITH {_REVIEW_SQL} SELECT (SELECT count(*) FROM a WHERE status_before = 'review' AND status = 'pass') AS approved, (SELECT count(*) FROM a WHERE verdict = 'reject') AS rejected, (SELECT count(*) FROM verdicts WHERE clip_id NOT IN (SELECT clip_id FROM clips)) AS stale")
def verdict_counts(spark, d):
    return review.outcome(*_reviewed(spark, d))


@_query(f"WITH {_REVIEW_SQL} SELECT clip_id, verdict FROM verdicts WHERE clip_id NOT IN (SELECT clip_id FROM clips)")
def stale_verdicts(spark, d):
    return review.stale(*_reviewed(spark, d)).select("clip_id", "verdict")


@_query("SELECT user_id AS clip_id, CASE WHEN arg_max(event_type, event_id) = 'error' THEN 'reject' ELSE 'approve' END AS verdict, arg_max(event_type, event_id) AS flags FROM events GROUP BY user_id")
def verdict_upsert(spark, d):
    e = _t(spark, d, "events").select(F.col("user_id").alias("clip_id"), F.when(F.col("event_type") == "error", "reject").otherwise("approve").alias("verdict"), F.col("event_type").alias("flags"), F.col("event_id").alias("seq"))
    old = e.where("seq % 2 = 0")
    return review.upsert(review.latest(old).select("clip_id", "verdict", "flags"), e)


# ---- segments

_EVENT_SEGS = "e AS (SELECT user_id, event_id, epoch_us(ts) // 1000000 % 1000000 / 1000.0::DOUBLE AS start, epoch_us(ts) // 1000000 % 1000000 / 1000.0::DOUBLE + floor(value) / 100 AS \"end\", round(value / 500, 3) AS score FROM events)"


def _event_segments(spark, d):
    start = _seconds() % 1000000 / F.lit(1000.0)
    return _t(spark, d, "events").select("user_id", "event_id", start.alias("start"), (start + F.floor("value") / 100).alias("end"), F.round(F.col("value") / 500, 3).alias("score"))


@_query(
    f"""WITH RECURSIVE {_EVENT_SEGS}, n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY start, event_id) AS k FROM e),
m AS (SELECT user_id, k, 0 AS g, event_id AS seg, start, "end", score FROM n WHERE k = 1
 UNION ALL SELECT n.user_id, n.k, m.g + (NOT j)::INT, CASE WHEN j THEN m.seg ELSE n.event_id END, CASE WHEN j THEN m.start ELSE n.start END, n."end", CASE WHEN j THEN round(((m.score + n.score) / 2)::VARCHAR::DECIMAL(38, 24), 3)::DOUBLE ELSE n.score END
 FROM m JOIN n ON n.user_id = m.user_id AND n.k = m.k + 1, LATERAL (SELECT m."end" - m.start < 1 AND n.start - m."end" <= 1 AND n."end" - m.start <= 15 AS j))
SELECT user_id, arg_max(seg, k)::VARCHAR AS seg_id, arg_max(start, k) AS start, arg_max("end", k) AS "end", arg_max(score, k) AS score FROM m GROUP BY user_id, g"""
)
def merge_short(spark, d):
    s = _event_segments(spark, d).withColumns({"seg_id": F.col("event_id").cast("string"), "text": F.lit(""), "normalized": F.lit(""), "rank": F.col("event_id")})
    return segments.merge_short(s, ["user_id"]).select("user_id", "seg_id", "start", "end", "score")


_REGION_SQL = f"""{_EVENT_SEGS}, r AS (SELECT user_id, start, max("end") AS "end" FROM e WHERE event_id % 2 = 0 GROUP BY user_id, start),
p AS (SELECT user_id, event_id, start + 0.35 AS t FROM e WHERE event_id % 2 = 1),
a AS (SELECT p.*, r.start AS rs, r."end" AS re FROM p ASOF LEFT JOIN r ON p.user_id = r.user_id AND p.t >= r.start),
b AS (SELECT a.*, r.start AS nx FROM a ASOF LEFT JOIN r ON a.user_id = r.user_id AND a.t < r.start)"""
_SNAP_END = "CASE WHEN rs IS NULL THEN t WHEN t <= re THEN CASE WHEN re <= t + 0.8 THEN re ELSE t END WHEN re >= t - 0.24 THEN re ELSE t END"
_SNAP_START = "CASE WHEN rs IS NOT NULL AND t <= re THEN CASE WHEN rs >= t - 0.8 THEN rs ELSE t END WHEN nx <= t + 0.24 THEN nx ELSE t END"


def _points_regions(spark, d):
    e = _event_segments(spark, d)
    r = e.where("event_id % 2 = 0").groupBy("user_id", "start").agg(F.max("end").alias("end"))
    return e.where("event_id % 2 = 1").select("user_id", "event_id", (F.col("start") + 0.35).alias("t")), r


@_query(f"WITH {_REGION_SQL} SELECT event_id, {_SNAP_END} AS snapped_end, {_SNAP_START} AS snapped_start FROM b")
def region_snap(spark, d):
    """By the as-of join: one sort by key, and no key's regions in one row."""
    j = segments.region_join(*_points_regions(spark, d), "user_id")
    at, end, after, t = (F.col(c) for c in ("region_start", "region_end", "next_start", "t"))
    return j.select("event_id", S.snapped_end(at, end, t).alias("snapped_end"), S.snapped_start(at, end, after, t).alias("snapped_start"))


@_query(f"WITH {_REGION_SQL} SELECT event_id, t, rs AS region_start, re AS region_end, nx AS next_start FROM b")
def region_asof(spark, d):
    p, r = _points_regions(spark, d)
    return segments.region_join(p, r, "user_id").select("event_id", "t", "region_start", "region_end", "next_start")


@_query("SELECT o_orderkey, c_name, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_custkey % 10 <> 0")
def chapter_join(spark, d):
    s, c = _orders_chapters(spark, d)
    return segments.with_chapters(s, c).select("o_orderkey", "c_name", "c_nationkey")


@_query("SELECT 'b' AS book_id, o_custkey::VARCHAR AS chapter_id, count(*) AS segments FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0) GROUP BY o_custkey")
def missing_chapters(spark, d):
    return segments.missing_chapters(*_orders_chapters(spark, d))


def _orders_chapters(spark, d):
    s = _t(spark, d, "orders").select(F.lit("b").alias("book_id"), F.col("o_custkey").cast("string").alias("chapter_id"), "o_orderkey")
    c = _t(spark, d, "customer").where("c_custkey % 10 <> 0").select(F.lit("b").alias("book_id"), F.col("c_custkey").cast("string").alias("chapter_id"), "c_name", "c_nationkey")
    return s, c


# ---- signals: an embedding is 64 samples

_FRAMES_SQL = """f0 AS (SELECT vec_id, label, embedding, list_transform(range(8), lambda i: sqrt(list_sum(list_transform(embedding[i * 8 + 1:i * 8 + 8], lambda x: x::DOUBLE * x::DOUBLE)) / 8 + 1e-12)) AS rms FROM embeddings),
f AS (SELECT *, greatest(list_aggregate(rms, 'quantile_cont', 0.95) * 0.6, 1e-4) AS thr FROM f0)"""


def _frames(spark, d):
    e = _t(spark, d, "embeddings").withColumn("rms", S.frames(F.col("embedding"), 8))
    return e.withColumn("threshold", S.silence_threshold(F.col("rms"), 0.6))


@_query(f"WITH {_FRAMES_SQL} SELECT vec_id, unnest(range(8))::INT AS frame, round(unnest(rms), 9) AS rms FROM f")
def frame_rms(spark, d):
    return _frames(spark, d).select("vec_id", F.posexplode("rms").alias("frame", "rms")).withColumn("rms", F.round("rms", 9))


@_query(
    f"""WITH {_FRAMES_SQL} SELECT vec_id, round(thr, 9) AS threshold, len(list_filter(rms, lambda x: x < thr)) / 8 AS silence_ratio, round(list_max(list_transform(embedding, lambda x: abs(x::DOUBLE))), 6) AS peak,
  round(10 * log10(list_avg(list_transform(list_filter(rms, lambda x: x >= thr), lambda x: x * x)) / greatest(coalesce(list_avg(list_transform(list_filter(rms, lambda x: x < thr), lambda x: x * x)), 1e-8), 1e-8)), 6) AS snr_db FROM f"""
)
def clip_levels(spark, d):
    rms, thr = F.col("rms"), F.col("threshold")
    return _frames(spark, d).select("vec_id", F.round(thr, 9).alias("threshold"), S.silence_ratio(rms, thr).alias("silence_ratio"), F.round(S.peak(F.col("embedding")), 6).alias("peak"), F.round(S.snr_db(rms, thr), 6).alias("snr_db"))


_SNAP_SQL = """x AS (SELECT vec_id, list_transform(embedding, lambda v: abs(v::DOUBLE)) AS rms, 0.1 AS thr, 0.2 + vec_id % 9 / 10 AS t FROM embeddings),
w AS (SELECT vec_id, thr, t, unnest(range(64)) AS i, unnest(rms) AS v FROM x),
s AS (SELECT *, i - row_number() OVER (PARTITION BY vec_id ORDER BY i) AS g FROM w WHERE v < thr AND i >= {lo} AND i < {hi}),
r AS (SELECT vec_id, g, min(i) AS a, max(i) AS b FROM s GROUP BY vec_id, g HAVING count(*) >= 3)"""
_LO_E, _HI_E = "greatest(0, trunc((t - 0.24) * 1000 / 20))", "least(64, trunc((t + 0.8) * 1000 / 20) + 1)"
_LO_S, _HI_S = "greatest(0, trunc((t - 0.8) * 1000 / 20))", "least(63, trunc((t + 0.24) * 1000 / 20))"


@_query(
    f"""WITH e AS (WITH {_SNAP_SQL.format(lo=_LO_E, hi=_HI_E)} SELECT x.vec_id, CASE WHEN min(a) IS NULL OR min(a) = any_value({_LO_E}) THEN any_value(t) ELSE min(a) * 20.0::DOUBLE / 1000 END AS snapped_end FROM x LEFT JOIN r USING (vec_id) GROUP BY x.vec_id),
z AS (WITH {_SNAP_SQL.format(lo=_LO_S, hi=_HI_S + " + 1")} SELECT x.vec_id, CASE WHEN max(b) IS NULL OR max(b) = any_value({_HI_S}) THEN any_value(t) ELSE (max(b) + 1) * 20.0::DOUBLE / 1000 END AS snapped_start FROM x LEFT JOIN r USING (vec_id) GROUP BY x.vec_id)
SELECT vec_id, snapped_end, snapped_start FROM e JOIN z USING (vec_id)"""
)
def energy_snap(spark, d):
    e = _t(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda v: F.abs(v.cast("double"))).alias("rms"), (F.lit(0.2) + F.col("vec_id") % 9 / 10).alias("t"))
    rms, t, thr = F.col("rms"), F.col("t"), F.lit(0.1)
    return e.select("vec_id", S.snap_end(rms, 20, 1000, thr, t, pause=0.06).alias("snapped_end"), S.snap_start(rms, 20, 1000, thr, t, pause=0.06).alias("snapped_start"))


@_query(
    f"""WITH {_FRAMES_SQL}, v AS (SELECT *, list_filter(list_transform(rms, lambda x, i: CASE WHEN x >= thr THEN i - 1 END), lambda i: i IS NOT NULL) AS on_ FROM f)
SELECT round(avg(list_min(on_) * (8 / 400)), 3) AS lead_silence_mean, round(avg((7 - list_max(on_)) * (8 / 400)), 3) AS trail_silence_mean FROM v"""
)
def boundary_silence(spark, d):
    return evaluate.boundary_metrics(_frames(spark, d), 8, 400)


@_query("SELECT event_id, round(CASE WHEN event_type = 'error' THEN 1.0 WHEN value / 500 * pow(10.0, (-23 + value / 20) / 20) > 0.99 THEN 0.99 / (value / 500) ELSE pow(10.0, (-23 + value / 20) / 20) END, 9) AS gain FROM events")
def loudness_gain(spark, d):
    lufs = F.when(F.col("event_type") != "error", -F.col("value") / 20)
    return _t(spark, d, "events").select("event_id", F.round(S.gain(lufs, -23.0, F.col("value") / 500), 9).alias("gain"))


@_query(
    """WITH x AS (SELECT vec_id, embedding AS e, unnest(range(48))::INT AS i FROM embeddings), p AS (SELECT *, i * (64 / 48) AS pos FROM x),
q AS (SELECT *, floor(pos)::INT AS a, least(floor(pos)::INT + 1, 63) AS b FROM p)
SELECT vec_id, i, round((e[a + 1]::DOUBLE + (e[b + 1]::DOUBLE - e[a + 1]::DOUBLE) * (pos - a))::FLOAT::DOUBLE, 5) + 0.0::DOUBLE AS sample FROM q"""
)
def resample(spark, d):
    e = _t(spark, d, "embeddings").select("vec_id", F.posexplode(S.resampled(64, 48)("embedding")).alias("i", "s"))
    return e.select("vec_id", "i", (F.round(F.col("s").cast("double"), 5) + F.lit(0.0)).alias("sample"))


#: A frame is four samples; Hann's window leaves the two inner ones, so its spectrum has a closed form.
_EDGE = {"strong": 0.9, "weak": 0.6, "max_hz": 110.0}
_EDGE_SQL = """{n}0 AS (SELECT vec_id, {samples} AS e FROM embeddings),
{n}1 AS (SELECT vec_id, list_transform(range(16), lambda i: sqrt(list_sum(list_transform(e[i * 4 + 1:i * 4 + 4], lambda v: v::DOUBLE * v::DOUBLE)) / 4 + 1e-12)) AS rms,
  list_transform(range(16), lambda i: (100 * sqrt(e[i * 4 + 2]::DOUBLE ** 2 + e[i * 4 + 3]::DOUBLE ** 2) + 200 * abs(e[i * 4 + 3]::DOUBLE - e[i * 4 + 2]))
    / nullif(abs(e[i * 4 + 2]::DOUBLE + e[i * 4 + 3]) + sqrt(e[i * 4 + 2]::DOUBLE ** 2 + e[i * 4 + 3]::DOUBLE ** 2) + abs(e[i * 4 + 3]::DOUBLE - e[i * 4 + 2]), 0)) AS hz FROM {n}0),
{n}2 AS (SELECT *, list_aggregate(rms, 'quantile_cont', 0.95) AS top FROM {n}1),
{n}3 AS (SELECT *, list_position(list_transform(rms, lambda x: x >= 0.9 * top), true) - 1 AS first, greatest(0.6 * top, 1e-4) AS thr FROM {n}2),
{n}4 AS (SELECT vec_id, first, thr, rms, unnest(range(16)) AS i, unnest(rms) AS r, unnest(hz) AS z FROM {n}3),
{n}5 AS (SELECT *, i - row_number() OVER (PARTITION BY vec_id ORDER BY i) AS g FROM {n}4 WHERE i < first AND r >= thr),
{n}6 AS (SELECT vec_id, g, min(i) AS a, max(i) + 1 AS f, median(coalesce(z, 0)) AS centre, any_value(first) AS first, any_value(thr) AS thr, any_value(rms) AS rms FROM {n}5 GROUP BY vec_id, g),
{n} AS (SELECT vec_id, max((f - a) * 10) AS ms FROM {n}6 WHERE a > 0 AND first - f >= {gap} AND centre < 110 AND len(list_filter(rms[f + 1:f + {gap}], lambda x: x >= thr)) = 0 GROUP BY vec_id)"""


@_query(
    f"WITH {_EDGE_SQL.format(n='l', samples='embedding', gap=0)}, {_EDGE_SQL.format(n='t', samples='list_reverse(embedding)', gap=3)} "
    "SELECT vec_id, coalesce(l.ms, 0)::DOUBLE AS lead_ms, coalesce(t.ms, 0)::DOUBLE AS tail_ms FROM embeddings LEFT JOIN l USING (vec_id) LEFT JOIN t USING (vec_id)"
)
def edge_noise(spark, d):
    e = _t(spark, d, "embeddings")
    return e.select("vec_id", S.edge_noise_of(400, **_EDGE)("embedding").alias("lead_ms"), S.edge_noise_of(400, True, min_gap_ms=30, **_EDGE)("embedding").alias("tail_ms"))


def _sql_loudness(sr: int, column: str) -> str:
    """Both filters sample by sample, then blocks of 0.4 s and both gates."""
    (b, a), (c, g) = ([x.tolist() for x in f] for f in S.k_weighting(sr))
    size, hop = int(0.4 * sr), int(0.1 * sr)
    return f"""WITH RECURSIVE r AS (SELECT vec_id, {column} AS e, 0 AS i, 0::DOUBLE AS z1, 0::DOUBLE AS z2, 0::DOUBLE AS w1, 0::DOUBLE AS w2, 0::DOUBLE AS y FROM embeddings
 UNION ALL SELECT vec_id, e, i + 1, {b[1]!r} * v - {a[0]!r} * u + z2, {b[2]!r} * v - {a[1]!r} * u, {c[1]!r} * u - {g[0]!r} * o + w2, {c[2]!r} * u - {g[1]!r} * o, o
  FROM (SELECT *, {c[0]!r} * u + w1 AS o FROM (SELECT *, e[i + 1]::DOUBLE AS v, {b[0]!r} * e[i + 1]::DOUBLE + z1 AS u FROM r WHERE i < len(e)))),
p AS (SELECT vec_id, k, sum(y * y) / {size} AS power FROM (SELECT vec_id, i - 1 AS i, y, len(e) AS n FROM r WHERE i > 0), range(64) AS t(k) WHERE i >= k * {hop} AND i < k * {hop} + {size} AND k * {hop} + {size} <= n GROUP BY vec_id, k),
l AS (SELECT *, -0.691 + 10 * log10(greatest(power, 1e-12)) AS level FROM p),
h AS (SELECT *, -0.691 + 10 * log10(avg(power) FILTER (level > -70) OVER (PARTITION BY vec_id)) - 10 AS gate FROM l)
SELECT vec_id, round(-0.691 + 10 * log10(avg(power) FILTER (level > -70 AND level > gate)), 6) AS lufs FROM embeddings LEFT JOIN h USING (vec_id) GROUP BY vec_id"""


@_query(_sql_loudness(100, "embedding"))
def integrated_loudness(spark, d):
    return _t(spark, d, "embeddings").select("vec_id", F.round(S.loudness_of(100)("embedding"), 6).alias("lufs"))


# ---- alignment

_BOOK_SQL = f"""b AS (SELECT item_id, unnest({_TOKENS('text')}) AS tok, unnest(range(len({_TOKENS('text')}))) AS pos FROM benchmark),
a AS (SELECT doc_id, unnest({_TOKENS('text')}) AS tok, unnest(range(len({_TOKENS('text')}))) AS idx FROM documents),
bg AS (SELECT item_id, pos, string_agg(strip_accents(tok), ' ') OVER w AS g, count(*) OVER w AS n FROM b WINDOW w AS (PARTITION BY item_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)),
ag AS (SELECT doc_id, idx, string_agg(strip_accents(tok), ' ') OVER w AS g, count(*) OVER w AS n FROM a WINDOW w AS (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)),
b1 AS (SELECT g, min(item_id) AS item_id, min(pos) AS pos FROM bg WHERE n = 8 GROUP BY g HAVING count(*) = 1), a1 AS (SELECT g, min(doc_id) AS doc_id, min(idx) AS idx FROM ag WHERE n = 8 GROUP BY g HAVING count(*) = 1)"""


def _sides(spark, d):
    item, doc = _t(spark, d, "benchmark"), _t(spark, d, "documents")
    book = item.select(F.lit("b").alias("book_id"), F.format_string("%08d", "item_id").alias("sent_id"), F.col("item_id").cast("int").alias("order"), "item_id", "text", F.col("text").alias("normalized"), T.tokenize(F.col("text")).alias("tokens"))
    return book, doc


@_query(f"WITH {_BOOK_SQL} SELECT item_id, pos::INT AS pos, doc_id, idx::INT AS idx FROM b1 JOIN a1 USING (g)")
def ngram_anchors(spark, d):
    """Runs of 8 tokens that are unique among all items and among all documents.  The items are the
    smaller side: of the documents' runs, only those that are also theirs are shuffled."""
    book, doc = _sides(spark, d)
    items = alignment.unique_grams(book.select("item_id", "tokens"), "item_id", "pos")
    docs = alignment.unique_grams(doc.select("doc_id", T.tokenize(F.col("text")).alias("tokens")), "doc_id", "idx", among=items)
    return items.join(docs, ["g1", "g2"]).select("item_id", "pos", "doc_id", "idx")


def _read_aloud(spark, d):
    """Benchmark items as chapters of twenty books, read at 0.4 s a word with one word in seven
    misheard, and their own sentences as the books' text."""
    docs = _t(spark, d, "benchmark").withColumnRenamed("item_id", "doc_id").withColumn("source", F.format_string("b%03d", F.col("doc_id") % 20))
    s = docs.select(F.col("source").alias("book_id"), "doc_id", F.posexplode(T.sentences(F.col("text"))).alias("i", "sentence"))
    s = s.select("book_id", F.format_string("%s_%06d_%04d", "book_id", "doc_id", "i").alias("sent_id"), (F.col("doc_id") * 10000 + F.col("i")).cast("int").alias("order"), F.col("sentence").alias("text"), F.col("sentence").alias("normalized"), T.tokenize(F.col("sentence")).alias("tokens")).where(F.size("tokens") > 0)
    words = F.transform(T.tokenize(F.col("text")), lambda w, i: F.struct((i * 0.4).alias("start"), (i * 0.4 + 0.4).alias("end"), F.when(i % 7 == 3, "xx").otherwise(w).alias("word"), F.lit(1.0).alias("prob")))
    c = docs.select(F.col("source").alias("book_id"), F.format_string("c%06d", "doc_id").alias("chapter_id"), F.col("doc_id").cast("int").alias("order"), words.alias("words"))
    return s, c


@_query()
def aligned_sentences(spark, d):
    return alignment.BridgeAligner().align(*_read_aloud(spark, d)).select("book_id", "chapter_id", "seg_id", "start", "end", "score", F.size("matched_words").alias("matched"))


@_query(f"WITH a AS (SELECT source, doc_id, unnest({_TOKENS('text')}) AS tok, unnest(range(len({_TOKENS('text')}))) AS i FROM documents) SELECT doc_id, i::INT AS i, tok, (row_number() OVER (PARTITION BY source ORDER BY doc_id, i) - 1)::INT AS pos FROM a")
def token_positions(spark, d):
    docs = _t(spark, d, "documents").select(F.col("source").alias("book_id"), F.col("doc_id").alias("sent_id"), F.col("doc_id").alias("order"), T.tokenize(F.col("text")).alias("tokens"))
    return alignment.book_tokens(docs, folded=False).select(F.col("sent_id").alias("doc_id"), F.col("tok_pos").alias("i"), "tok", "pos")


@_query("WITH c AS (SELECT user_id, event_type, count(*) AS c, min(event_id) AS f FROM events GROUP BY ALL) SELECT user_id, arg_min(event_type, -c * 1000000000 + f) AS mode FROM c GROUP BY user_id")
def mode_chapter(spark, d):
    return alignment.mode(_t(spark, d, "events"), ["user_id"], "event_type", "event_id").withColumnRenamed("event_type", "mode")


@_query("SELECT user_id AS book_id, count(*) AS chapters, sum(CASE WHEN event_type = 'error' THEN 0 ELSE event_id % 9 END)::BIGINT AS words FROM events GROUP BY user_id")
def word_totals(spark, d):
    n = F.when(F.col("event_type") != "error", F.slice(F.array(*[F.lit("w")] * 8), 1, (F.col("event_id") % 9).cast("int")))
    return alignment.word_totals(_t(spark, d, "events").select(F.col("user_id").alias("book_id"), n.alias("words")))


# ---- export and reports

_EXPORT_SQL = "r AS (SELECT doc_id AS clip_id, replace(text, '|', ' ') AS text, source AS speaker_id, n_chars / 15 AS duration FROM documents)"


def _export_rows(spark, d):
    return _t(spark, d, "documents").select(F.col("doc_id").alias("clip_id"), "text", F.col("text").alias("normalized"), F.col("source").alias("speaker_id"), (F.col("n_chars") / 15).alias("duration"))


@_query(
    f"""WITH {_EXPORT_SQL}, k AS (SELECT clip_id, row_number() OVER (ORDER BY md5(clip_id || ':42'), clip_id) AS n, greatest(1, floor(count(*) OVER () * 0.02)) AS v FROM r)
SELECT clip_id, CASE WHEN n <= v THEN 'val' ELSE 'train' END AS split FROM k"""
)
def train_val_split(spark, d):
    return export.split_ranked(_export_rows(spark, d)).select("clip_id", "split")


@_query()
def shuffled_split(spark, d):
    """Each source's documents by a seeded shuffle of its own, as a book's clips are split."""
    return export.split_shuffled(_export_rows(spark, d), ["clip_id"], by=["speaker_id"]).select("clip_id", "split")


@_query(
    f"""WITH {_CLIPS_SQL}, p AS (SELECT l_orderkey || '_' || l_linenumber AS clip_id, duration FROM g WHERE status = 'pass'),
k AS (SELECT *, row_number() OVER (ORDER BY md5(clip_id || ':42'), clip_id) AS n, greatest(1, floor(count(*) OVER () * 0.02)) AS v FROM p)
SELECT clip_id, clip_id || '.wav|clip ' || clip_id AS line, CASE WHEN n <= v THEN 'val' ELSE 'train' END AS split FROM k"""
)
def export_rows(spark, d):
    """What a dataset's metadata holds: passed clips alone, their lines, and their part."""
    g = _graded(spark, d).withColumn("clip_id", F.concat_ws("_", "l_orderkey", "l_linenumber"))
    rows = export.passed(g).select("clip_id", F.concat(F.lit("clip|"), "clip_id").alias("text"))
    return export.split_ranked(export.metadata_lines(rows, "piper")).select("clip_id", "line", "split")


@_query(f"WITH {_EXPORT_SQL} SELECT clip_id, clip_id || '.wav|' || text AS piper, clip_id || '|' || text || '|' || text AS ljspeech FROM r")
def metadata_lines(spark, d):
    r = _export_rows(spark, d)
    p = export.metadata_lines(r, "piper").withColumnRenamed("line", "piper")
    return export.metadata_lines(p, "ljspeech").select("clip_id", "piper", F.col("line").alias("ljspeech"))


@_query(
    """SELECT count(*) AS clips, round(sum(n_chars / 15) / 3600, 3) AS total_hours, round(min(n_chars / 15), 2) AS duration_min, round(max(n_chars / 15), 2) AS duration_max, round(avg(n_chars / 15), 2) AS duration_mean,
  array_to_string(list_sort(list(DISTINCT source)), ',') AS speakers, (SELECT string_agg(c, '' ORDER BY c) FROM (SELECT DISTINCT unnest(string_split(text, '')) AS c FROM documents)) AS char_inventory,
  (SELECT count(DISTINCT c) FROM (SELECT unnest(string_split(text, '')) AS c FROM documents)) AS char_count FROM documents"""
)
def dataset_stats(spark, d):
    return export.statistics(_export_rows(spark, d)).withColumn("speakers", F.array_join("speakers", ","))


_METRIC_SQL = f"""{_EVENT_SEGS}, m AS (SELECT event_type AS strategy, count(*) AS segments, round(sum(e."end" - e.start), 1) AS audio_seconds, round(100 * sum(e."end" - e.start) / 50000.0::DOUBLE, 1) AS retained_pct, round(avg(score), 3) AS mean_score,
  round(avg(e."end" - e.start), 2) AS dur_mean, round(min(e."end" - e.start), 2) AS dur_min, round(max(e."end" - e.start), 2) AS dur_max FROM e JOIN events USING (event_id) GROUP BY event_type)"""


def _metrics(spark, d):
    start = _seconds() % 1000000 / F.lit(1000.0)
    e = _t(spark, d, "events").select(F.col("event_type").alias("strategy"), start.alias("start"), (start + F.floor("value") / 100).alias("end"), F.round(F.col("value") / 500, 3).alias("score"))
    return evaluate.basic_metrics(e, 50000.0)


@_query(f"WITH {_METRIC_SQL} SELECT * FROM m")
def aligner_metrics(spark, d):
    return _metrics(spark, d)


@_query(
    f"""WITH {_METRIC_SQL}, l AS (UNPIVOT (SELECT strategy, segments::DOUBLE AS segments, audio_seconds, retained_pct, mean_score, dur_mean, dur_min, dur_max FROM m) ON segments, audio_seconds, retained_pct, mean_score, dur_mean, dur_min, dur_max INTO NAME metric VALUE value)
SELECT metric, max(value) FILTER (strategy = 'click') AS click, max(value) FILTER (strategy = 'error') AS error, max(value) FILTER (strategy = 'view') AS view FROM l GROUP BY metric"""
)
def report_pivot(spark, d):
    return evaluate.report(_metrics(spark, d), ["click", "error", "view"])


@_query("SELECT source AS book_id, count(*) AS chapters, sum(n_chars / 15) AS seconds FROM documents GROUP BY source")
def ingest_totals(spark, d):
    return evaluate.ingest_totals(_t(spark, d, "documents").select(F.col("source").alias("book_id"), (F.col("n_chars") / 15).alias("duration")))
