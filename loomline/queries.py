"""One query per operator over the test tables, each with DuckDB SQL for the same rows where SQL can express it."""

from __future__ import annotations

import uuid
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.functions import language as L
from loomline.functions import text as X
from loomline.functions.vectors import embed_sparse, signatures
from loomline.operators import annotation, dedup, matching, rules, search, speech, stats, synthetic
from loomline.registry import QUERIES as _QUERIES
from loomline.registry import SQL as _SQL
from loomline.registry import Query, query, table
from loomline.storage import shared_dir
from loomline.streaming.dedup import dedup_stream


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# Pieces of SQL. RE2 has no possessive quantifiers; its classes are those of the Columns.
_U = r"\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_WS = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}" + _U + "]"
_NWS = r"[^\t-\r\x{1c}-\x{20}\x{85}\x{a0}" + _U + "]"
_LS = r"[\t\x{0b}\x{0c}\r\x{1c}-\x{20}\x{85}\x{a0}" + _U + "]"
_W = r"[\p{L}\p{N}][\p{L}\p{N}\p{M}]*"
_SYM = r"[^\p{L}\p{N}\p{M}\t-\r\x{20}\x{85}\x{a0}" + _U + "]"


def _re(text: str, pattern: str, to: str) -> str:
    return f"regexp_replace({text}, '{pattern}', {to}, 'g')"


def _round(x: str, digits: int) -> str:
    """Half up on the shortest decimal form of a double, as Spark rounds."""
    return f"round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 20)), {digits})::DOUBLE"


def _strip(text: str) -> str:
    return _re(_re(text, f"^{_WS}+", "''"), rf"{_WS}+\z", "''")


def _collapse(text: str) -> str:
    return f"trim({_re(text, f'{_WS}+', chr(39) + ' ' + chr(39))})"


def _normal(text: str) -> str:
    t = f"translate(nfc_normalize(coalesce({text}, '')), chr(8203) || chr(65279) || chr(173), '')"
    for pattern, to in ((r"\r\n|\r", "chr(10)"), (r"[ \t\x{a0}\x{2000}-\x{200a}]+", "' '"), (_WS + r"+([\x{964}\x{965}])", r"'\1'"), (rf"\n{_LS}+", "chr(10)"), (rf"{_LS}+\n", "chr(10)"), (r"\n{3,}", "chr(10) || chr(10)")):
        t = _re(t, pattern, to)
    return _strip(t)


def _n(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, '{pattern}'))"


def _detect(text: str) -> str:
    each = ", ".join(f"struct_pack(n := {_n(text, f'[{r}]')}, f := -strpos({text}, regexp_extract({text}, '[{r}]')), c := '{code}')" for code, r in L.RANGES)
    return f"list_max([{each}])"


_VISIBLE = r"length(regexp_replace(t, '[\p{C}\p{Z}]', '', 'g'))"
_NORMAL_DOCS = f"d AS (SELECT doc_id, {_normal('text')} AS t FROM documents)"
_TOLD = f"{_NORMAL_DOCS}, e AS (SELECT doc_id, t, {_detect('t')} AS x, {_VISIBLE} AS v FROM d), l AS (SELECT doc_id, t, CASE WHEN x.n > 0 AND v > 0 THEN x.c END AS language, CASE WHEN x.n > 0 AND v > 0 THEN round(x.n / v, 4) ELSE 0.0 END AS confidence FROM e)"
_LINES = f"list_filter(list_transform(string_split(t, chr(10)), lambda x: {_strip('x')}), lambda x: length(x) > 0)"


def _tidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", X.normalize(F.col("text")).alias("text"))
    return docs.withColumn("_l", L.detect(F.col("text"))).select("doc_id", "text", "_l.language", "_l.confidence")


@query(f"WITH {_NORMAL_DOCS} SELECT doc_id, t AS normal FROM d")
def normalize_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.normalize(F.col("text")).alias("normal"))


@query(f"WITH {_TOLD} SELECT doc_id, language, confidence FROM l")
def lang_detect(spark, sf_dir):
    return _tidy(spark, sf_dir).select("doc_id", "language", "confidence")


@query(
    f"""WITH {_TOLD}, m AS (SELECT doc_id, language, t, length(t) AS chars, regexp_extract_all(t, '{_W}') AS w, {_n("t", _SYM)} AS sym, {_n("t", r"[\p{Nd}]")} AS dig, {_LINES} AS lines FROM l)
    SELECT doc_id, CASE WHEN chars < 20 THEN 'too_short' WHEN chars > 100000 THEN 'too_long' WHEN len(w) < 4 THEN 'too_few_words'
      WHEN list_sum(list_transform(w, lambda x: length(x))) / len(w) < 1.5 THEN 'mean_word_length_too_low' WHEN sym / chars > 0.30 THEN 'symbol_ratio_high' WHEN dig / chars > 0.40 THEN 'digit_ratio_high'
      WHEN len(lines) > 1 AND 1 - len(list_distinct(lines)) / len(lines) > 0.30 THEN 'repeated_lines' WHEN language IS NULL THEN 'unknown_language' END AS reason FROM m"""
)
def clean_filter_reasons(spark, sf_dir):
    docs = _tidy(spark, sf_dir)
    return docs.select("doc_id", rules.reason_kind(rules.drop_reason(F.col("text"), F.col("language"))).alias("reason"))


@query(
    f"""WITH m AS (SELECT doc_id, text, regexp_extract_all(text, '{_W}') AS w FROM documents)
    SELECT doc_id, length(text) AS char_count, len(w) AS word_count, length(text) - length(replace(text, chr(10), '')) + 1 AS line_count,
      CASE WHEN len(w) > 0 THEN {_round('len(list_distinct(list_transform(w, lambda x: lower(x)))) / len(w)', 4)} ELSE 0.0 END AS unique_word_ratio,
      CASE WHEN len(w) > 0 THEN {_round('list_sum(list_transform(w, lambda x: length(x))) / len(w)', 2)} ELSE 0.0 END AS avg_word_length FROM m"""
)
def text_profile(spark, sf_dir):
    return rules.profile(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@query(f"""SELECT doc_id, {_n("text", _W)} AS words, {_n("text", _SYM)} AS symbols, {_n("text", r"[\p{Nd}]")} AS digits, sha256(text) AS hash, {_collapse("text")} AS collapsed FROM documents""")
def text_counts(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", X.word_count(t).cast("long").alias("words"), X.symbol_count(t).cast("long").alias("symbols"), X.digit_count(t).cast("long").alias("digits"), X.content_hash(t).alias("hash"), X.collapse(t).alias("collapsed"))


@query(
    f"""WITH {_TOLD}, m AS (SELECT *, regexp_extract_all(lower(t), '{_W}') AS w FROM l)
    SELECT doc_id, CASE WHEN len(w) > 0 THEN round(greatest(0.0, least(1.0, 0.30 * least(len(w) / 50, 1.0) + 0.30 * len(list_distinct(w)) / len(w) + 0.20 * greatest(0.0, 1 - 2 * {_n("t", _SYM)} / length(t)) + 0.20 * CASE WHEN language IS NOT NULL THEN confidence ELSE 0.0 END)), 4) ELSE 0.0 END AS quality FROM m"""
)
def quality_score(spark, sf_dir):
    return _tidy(spark, sf_dir).select("doc_id", rules.quality(F.col("text"), F.col("language"), F.col("confidence")).alias("quality"))


@query("SELECT doc_id, CASE WHEN doc_id <> min(doc_id) OVER (PARTITION BY text) THEN min(doc_id) OVER (PARTITION BY text) END AS parent FROM documents")
def exact_dedup(spark, sf_dir):
    return dedup.exact(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "parent")


@query(
    f"""WITH {_NORMAL_DOCS}, k AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id) AS rn FROM d WHERE length(t) BETWEEN 20 AND 100000 AND {_n("t", _W)} >= 4 AND {_n("t", _SYM)} / length(t) <= 0.30 AND {_n("t", r"[\p{Nd}]")} / length(t) <= 0.40)
    SELECT doc_id, sha256(t) AS content_hash FROM k WHERE rn = 1"""
)
def scale_filter_dedup(spark, sf_dir):
    return dedup.filter_and_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), order="doc_id").select("doc_id", "content_hash")


_GREEDY = """nodes AS (SELECT node, row_number() OVER (ORDER BY node) AS rn FROM (SELECT a AS node FROM pairs UNION SELECT b FROM pairs)),
    earlier AS (SELECT n.node, n.rn, coalesce(list(p.a) FILTER (WHERE p.a IS NOT NULL), []::BIGINT[]) AS a FROM nodes n LEFT JOIN pairs p ON p.b = n.node GROUP BY ALL),
    go AS (SELECT 0::BIGINT AS rn, []::BIGINT[] AS kept UNION ALL SELECT e.rn, CASE WHEN list_has_any(go.kept, e.a) THEN go.kept ELSE list_append(go.kept, e.node) END FROM go JOIN earlier e ON e.rn = go.rn + 1),
    final AS (SELECT kept FROM go ORDER BY rn DESC LIMIT 1)"""


@query(
    f"""WITH RECURSIVE c AS (SELECT doc_id, {_collapse("text")} AS t FROM documents),
    g AS (SELECT DISTINCT doc_id, substring(t, i::INT, 4) AS s FROM (SELECT doc_id, t, unnest(range(1, greatest(length(t) - 3, 1) + 1)) AS i FROM c WHERE length(t) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY ALL), df AS (SELECT s, count(*) AS df FROM g GROUP BY ALL),
    r AS (SELECT g.doc_id, g.s, n.n, row_number() OVER (PARTITION BY g.doc_id ORDER BY df.df, g.s) AS k FROM g JOIN df USING (s) JOIN n USING (doc_id)),
    p AS (SELECT * FROM r WHERE k <= n - ceil(0.8 * n) + 1),
    cand AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM p x JOIN p y ON x.s = y.s AND x.doc_id < y.doc_id AND least(x.n, y.n) >= 0.8 * greatest(x.n, y.n)),
    i AS (SELECT a, b, count(*) AS i FROM cand JOIN g x ON x.doc_id = a JOIN g y ON y.doc_id = b AND x.s = y.s GROUP BY ALL),
    pairs AS (SELECT a, b, i / (na.n + nb.n - i) AS j FROM i JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE i / (na.n + nb.n - i) >= 0.8), {_GREEDY},
    hit AS (SELECT b, min(a) AS parent FROM pairs, final WHERE list_contains(kept, a) AND NOT list_contains(kept, b) GROUP BY b)
    SELECT d.doc_id, hit.parent, round(pairs.j, 4) AS similarity FROM documents d LEFT JOIN hit ON hit.b = d.doc_id LEFT JOIN pairs ON pairs.a = hit.parent AND pairs.b = hit.b"""
)
def near_dedup(spark, sf_dir):
    return dedup.near(table(spark, sf_dir, "documents").select("doc_id", "text"))


_VECTOR_PAIRS = "pairs AS (SELECT x.vec_id AS a, y.vec_id AS b, round(round(list_inner_product(x.embedding::DOUBLE[], y.embedding::DOUBLE[]), 6), 4) AS s FROM embeddings x JOIN embeddings y ON x.vec_id < y.vec_id WHERE round(list_inner_product(x.embedding::DOUBLE[], y.embedding::DOUBLE[]), 6) >= 0.4)"


@query(
    f"""WITH RECURSIVE {_VECTOR_PAIRS}, {_GREEDY},
    hit AS (SELECT b, arg_max(struct_pack(a := a, s := s), struct_pack(s := s, a := -a)) AS x FROM pairs, final WHERE list_contains(kept, a) AND NOT list_contains(kept, b) GROUP BY b)
    SELECT v.vec_id, hit.x.a AS parent, hit.x.s AS similarity FROM embeddings v LEFT JOIN hit ON hit.b = v.vec_id"""
)
def semantic_dedup(spark, sf_dir):
    return dedup.semantic(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), 0.4)


@query(f"WITH {_VECTOR_PAIRS} SELECT a, b, s AS similarity FROM pairs")
def semantic_pairs(spark, sf_dir):
    return dedup.similar_pairs(table(spark, sf_dir, "embeddings"), 0.4)


_GRAMS = "CASE WHEN len(w) >= 13 THEN list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END"


def _gram_rows(name: str, key: str, source: str) -> str:
    words = f"{name}w AS (SELECT {key} AS k, list_filter(string_split({_collapse('lower(text)')}, ' '), lambda x: length(x) > 0) AS w FROM {source})"
    return f"{words}, {name} AS (SELECT k, unnest({_GRAMS}) AS gram, generate_subscripts({_GRAMS}, 1) AS pos FROM {name}w)"


@query(f"WITH {_gram_rows('o', 'doc_id', 'documents')}, {_gram_rows('q', 'item_id', 'benchmark')}, first AS (SELECT gram, min(k) AS bench FROM q GROUP BY gram) SELECT o.k AS doc_id, arg_min(first.bench, pos) AS bench_id, arg_min(o.gram, pos) AS ngram FROM o JOIN first USING (gram) GROUP BY o.k")
def contamination_hits(spark, sf_dir):
    return matching.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_BARE = r"regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g')"


@query(f"SELECT page_id, {_collapse(_re(_BARE, '(?s)<[^>]+>', chr(39) + ' ' + chr(39)))} AS content FROM pages")
def html_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.html_text(F.col("html")).alias("content"))


@query(
    f"""WITH w AS (SELECT lang, length(text) AS c, regexp_extract_all(lower(text), '{_W}') AS w FROM documents), p AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
    b AS (SELECT round((log2(sum(n)) - sum(n * log2(n)) / sum(n)) / log2(count(*)), 4) AS balance FROM p), v AS (SELECT count(DISTINCT x) AS v FROM (SELECT unnest(w) AS x FROM w))
    SELECT count(*) AS num_documents, count(DISTINCT lang) AS num_languages, sum(len(w))::BIGINT AS total_tokens, sum(c)::BIGINT AS total_characters, any_value(v.v) AS vocabulary_size, any_value(b.balance) AS language_balance,
      round(any_value(v.v) / sum(len(w)), 4) AS type_token_ratio, round(sum(len(w)) / count(*), 2) AS avg_doc_tokens FROM w, v, b"""
)
def corpus_diversity(spark, sf_dir):
    return stats.diversity(table(spark, sf_dir, "documents"), language="lang")


@query("SELECT lang AS value, count(*) AS count FROM documents GROUP BY lang")
def language_distribution(spark, sf_dir):
    return stats.distribution(table(spark, sf_dir, "documents"), "lang")


@query("SELECT coalesce(source, 'unknown') AS value, count(*) AS count FROM documents GROUP BY 1")
def source_counts(spark, sf_dir):
    return stats.distribution(table(spark, sf_dir, "documents"), "source", "unknown")


@query("SELECT substr(sha256((SELECT string_agg(sha256(text), '' ORDER BY sha256(text)) FROM documents) || '{\"name\": \"test\"}'), 1, 16) AS version")
def dataset_version(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(X.content_hash(F.col("text")).alias("hash"))
    return spark.createDataFrame([(stats.dataset_version(docs, {"name": "test"}),)], "version string")


@query(f"SELECT count(*) AS documents, round(avg(quality), 4) AS avg_quality, count(*) FILTER (WHERE quality < 0.4) AS low_quality FROM ({_SQL['quality_score']})")
def quality_report(spark, sf_dir):
    return stats.quality_report(quality_score(spark, sf_dir), "quality")


@query(
    f"""WITH x AS (SELECT doc_id, doc_id // 5 AS pid, lang, text, list_distinct(regexp_extract_all(text, '[\\p{{Nd}}]+|https?://{_NWS}+|[A-Z][a-zA-Z]{{2,}}')) AS a FROM documents),
    p AS (SELECT x.doc_id AS s, y.doc_id AS t, x.pid, x.lang AS sl, y.lang AS tl, greatest(0.0::DOUBLE, 1 - (greatest(length(x.text), length(y.text)) / least(length(x.text), length(y.text)) - 1) / 2.5::DOUBLE) AS l, len(list_intersect(x.a, y.a)) AS i, len(list_distinct(list_concat(x.a, y.a))) AS u FROM x JOIN x y ON x.pid = y.pid AND x.doc_id < y.doc_id AND x.lang IS DISTINCT FROM y.lang)
    SELECT 'align-' || pid || '-' || s || '-' || t AS id, sl AS source_language, tl AS target_language, {_round('0.6::DOUBLE * l + 0.4::DOUBLE * CASE WHEN u > 0 THEN i / u ELSE l END', 4)} AS alignment_score FROM p"""
)
def parallel_align(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("parallel_id", F.floor(F.col("doc_id") / 5))
    return matching.align(docs, id_col="doc_id", language="lang").select("id", "source_language", "target_language", "alignment_score")


# Raters: the given quality label, and two rules over the documents. In the table with gaps rater c leaves out every third item.
_ALL_RATED = """r AS (SELECT l.doc_id AS item_id, 'a' AS annotator_id, CAST(l.quality AS VARCHAR) AS label, CAST(l.quality AS VARCHAR) AS gold FROM labels l
    UNION ALL SELECT d.doc_id, 'b', CASE WHEN d.n_chars >= 500 THEN '1' ELSE '0' END, CAST(l.quality AS VARCHAR) FROM labels l JOIN documents d USING (doc_id)
    UNION ALL SELECT l.doc_id, 'c', CAST(1 - l.toxic AS VARCHAR), CAST(l.quality AS VARCHAR) FROM labels l)"""
_RATED = f"{_ALL_RATED.replace('r AS', 'every AS', 1)}, r AS (SELECT * FROM every WHERE annotator_id <> 'c' OR item_id % 3 <> 0)"
_COUNTED = f"{_RATED}, k AS (SELECT item_id, label, count(*) AS c FROM r GROUP BY ALL), i AS (SELECT item_id, sum(c) AS m, max(c) AS top, sum(c * c) AS squares, sum(c * (c - 1)) AS same FROM k GROUP BY ALL)"


def _all_rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("item_id"), F.col("quality").cast("string").alias("gold_label"), "quality", "toxic")
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    rater = lambda df, name, label: df.select("item_id", F.lit(name).alias("annotator_id"), label.cast("string").alias("label"), "gold_label")
    by_length = given.join(docs, F.col("item_id") == F.col("doc_id"))
    return rater(given, "a", F.col("quality")).unionByName(rater(by_length, "b", (F.col("n_chars") >= 500).cast("int"))).unionByName(rater(given, "c", 1 - F.col("toxic")))


def _rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_rated(spark, sf_dir).filter("annotator_id <> 'c' OR item_id % 3 <> 0")


@query(f"WITH {_COUNTED}, t AS (SELECT k.item_id, count(*) AS firsts, any_value(k.label) AS label FROM k JOIN i ON i.item_id = k.item_id AND k.c = i.top GROUP BY ALL) SELECT i.item_id, CASE WHEN firsts = 1 THEN t.label END AS consensus, round(top / m, 4) AS agreement, m::BIGINT AS n_annotations, firsts > 1 OR top / m < 0.66 AS needs_adjudication FROM i JOIN t USING (item_id)")
def annotation_consensus(spark, sf_dir):
    return annotation.consensus(_rated(spark, sf_dir))


def _kappa(source: str, by: str = "") -> str:
    """Cohen's kappa of columns a, b of a table."""
    group, using = (f"GROUP BY {by}", f"USING ({by})") if by else ("", "ON true")
    key = f"{by}, " if by else ""
    return f"""(SELECT {key}CASE WHEN x.xy = n * n THEN 1.0 ELSE round((same / n - x.xy / (n * n)) / (1 - x.xy / (n * n)), 4) END AS kappa FROM (SELECT {key}count(*) AS n, sum((a = b)::INT) AS same FROM {source} {group}) g
      JOIN (SELECT {key}sum(ca * cb) AS xy FROM (SELECT {key}label, sum(ia) AS ca, sum(ib) AS cb FROM (SELECT {key}a AS label, 1 AS ia, 0 AS ib FROM {source} UNION ALL SELECT {key}b, 0, 1 FROM {source}) GROUP BY ALL) {group}) x {using})"""


_AB = "ab AS (SELECT x.label AS a, y.label AS b FROM r x JOIN r y ON x.item_id = y.item_id AND x.annotator_id = 'a' AND y.annotator_id = 'b')"


def _ab(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = _rated(spark, sf_dir)
    side = lambda name, c: rated.filter(F.col("annotator_id") == name).select("item_id", F.col("label").alias(c))
    return side("a", "a").join(side("b", "b"), "item_id")


@query(f"WITH {_RATED}, {_AB} SELECT round(avg((a = b)::INT), 6) AS agreement FROM ab")
def percent_agreement(spark, sf_dir):
    return annotation.percent_agreement(_ab(spark, sf_dir)).select(F.round("agreement", 6).alias("agreement"))


@query(f"WITH {_RATED}, {_AB} SELECT kappa FROM {_kappa('ab')}")
def cohen_kappa(spark, sf_dir):
    return annotation.cohen_kappa(_ab(spark, sf_dir))


@query(
    f"""WITH {_ALL_RATED}, k AS (SELECT item_id, label, count(*) AS c FROM r GROUP BY ALL), p AS (SELECT avg((s - 3) / 6) AS p FROM (SELECT sum(c * c) AS s FROM k GROUP BY item_id)),
    q AS (SELECT sum((t / n) * (t / n)) AS pe FROM (SELECT sum(c) AS t, sum(sum(c)) OVER () AS n FROM k GROUP BY label)) SELECT round((p - pe) / (1 - pe), 4) AS fleiss_kappa FROM p, q"""
)
def fleiss_kappa(spark, sf_dir):
    return annotation.fleiss_kappa(_all_rated(spark, sf_dir))


@query(
    f"""WITH {_COUNTED}, o AS (SELECT sum(same) AS s, sum(m * (m - 1)) AS p FROM i WHERE m > 1), v AS (SELECT sum(t) AS n, sum(t * (t - 1)) AS c FROM (SELECT sum(c) AS t FROM k JOIN i USING (item_id) WHERE m > 1 GROUP BY label))
    SELECT round(1 - (1 - s / p) / (1 - c / (n * (n - 1))), 4) AS alpha FROM o, v"""
)
def krippendorff_alpha(spark, sf_dir):
    return annotation.krippendorff_alpha_pooled(_rated(spark, sf_dir))


@query(
    f"""WITH {_COUNTED}, t AS (SELECT k.item_id, count(*) AS firsts, any_value(k.label) AS label FROM k JOIN i ON i.item_id = k.item_id AND k.c = i.top GROUP BY ALL),
    p AS (SELECT r.annotator_id, r.label AS a, t.label AS b FROM r JOIN t USING (item_id) WHERE firsts = 1), acc AS (SELECT annotator_id, round(avg((label = gold)::INT), 4) AS accuracy FROM r GROUP BY ALL)
    SELECT acc.annotator_id, accuracy, z.kappa, coalesce(accuracy, 1) < 0.8 OR coalesce(z.kappa, 1) < 0.4 AS flagged FROM acc LEFT JOIN {_kappa("p", "annotator_id")} z USING (annotator_id)"""
)
def annotator_report(spark, sf_dir):
    return annotation.annotator_report(_rated(spark, sf_dir))


_PREFERENCES = "p AS (SELECT conv_id * 100 + turn AS ord, 'p' || conv_id % 10 AS prompt, 't' || turn % 5 AS chosen, 't' || (turn * 3 + conv_id // 10) % 7 AS rejected FROM conversations)"
_ISSUES = "u AS (SELECT *, CASE WHEN chosen = rejected THEN 'chosen_equals_rejected' WHEN row_number() OVER (PARTITION BY prompt, chosen, rejected ORDER BY ord) > 1 THEN 'duplicate_pair' END AS issue FROM p)"


def _preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    name = lambda prefix, x: F.concat(F.lit(prefix), x.cast("long").cast("string"))
    return c.select((F.col("conv_id") * 100 + F.col("turn")).alias("ord"), name("p", F.col("conv_id") % 10).alias("prompt"), name("t", F.col("turn") % 5).alias("chosen"), name("t", (F.col("turn") * 3 + F.floor(F.col("conv_id") / 10)) % 7).alias("rejected"))


@query(f"WITH {_PREFERENCES}, {_ISSUES} SELECT ord, issue FROM u")
def preference_issues(spark, sf_dir):
    return annotation.preference_issues(_preferences(spark, sf_dir)).select("ord", "issue")


@query(f"WITH RECURSIVE {_PREFERENCES}, {_ISSUES}, e AS (SELECT DISTINCT prompt, chosen AS src, rejected AS dst FROM u WHERE issue IS NULL), w AS (SELECT * FROM e UNION SELECT w.prompt, w.src, e.dst FROM w JOIN e ON e.prompt = w.prompt AND e.src = w.dst) SELECT DISTINCT prompt FROM w WHERE src = dst")
def preference_cycles(spark, sf_dir):
    return annotation.cyclic_prompts(annotation.preference_issues(_preferences(spark, sf_dir)).filter(F.col("issue").isNull()))


_SEEDS = "s AS (SELECT conv_id || '-' || turn AS id, conv_id * 100 + turn AS ord, text AS instruction, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS output, role FROM conversations QUALIFY role = 'user')"
_MADE = """x AS (SELECT *, unnest(range(0, 4)) AS i, lower(left(instruction, 1)) || substring(instruction, 2) AS small FROM s),
    m AS (SELECT *, CASE i % 5 WHEN 0 THEN instruction WHEN 1 THEN 'Please ' || small WHEN 2 THEN 'Can you ' || small WHEN 3 THEN instruction || ' Explain briefly.' ELSE 'As an expert, ' || small END AS made FROM x)"""


def _seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    c = table(spark, sf_dir, "conversations").withColumn("output", F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn")))
    return c.filter("role = 'user'").select(F.concat_ws("-", "conv_id", "turn").alias("id"), (F.col("conv_id") * 100 + F.col("turn")).alias("ord"), F.col("text").alias("instruction"), "output")


@query(
    f"""WITH {_SEEDS}, {_MADE}, k AS (SELECT *, {_collapse("lower(made)")} AS key FROM m), n AS (SELECT * FROM k WHERE key NOT IN (SELECT {_collapse("lower(instruction)")} FROM s)), f AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ord, i) AS rn FROM n)
    SELECT 'syn-' || left(md5(id || '-' || i || '-' || made), 12) AS id, made AS instruction, id AS seed_id FROM f WHERE rn = 1"""
)
def instruction_expand(spark, sf_dir):
    return synthetic.build(_seeds(spark, sf_dir)).select("id", "instruction", "seed_id")


@query(f"WITH {_SEEDS} SELECT id, CASE WHEN length({_strip('instruction')}) = 0 THEN 'empty_instruction' WHEN length({_strip(chr(99) + 'oalesce(output, ' + chr(39) * 2 + ')')}) = 0 THEN 'empty_output' WHEN lower({_strip('instruction')}) = lower({_strip('output')}) THEN 'output_echoes_instruction' WHEN length(output) < 2 THEN 'output_too_short' END AS issue FROM s")
def instruction_validate(spark, sf_dir):
    return _seeds(spark, sf_dir).select("id", synthetic.instruction_issue().alias("issue"))


@query(
    f"""WITH t AS (SELECT conv_id, min(text) FILTER (WHERE turn = 0) AS goal, list(CASE WHEN turn % 4 = 3 THEN '' ELSE role END ORDER BY turn) AS tools FROM conversations GROUP BY conv_id),
    s AS (SELECT *, list_transform(range(0, len(tools)), lambda i: list_filter([CASE WHEN tools[i + 1] NOT IN ('user', 'system') THEN 'step' || i || '_undeclared_tool:' || tools[i + 1] END, CASE WHEN tools[i + 1] = '' THEN 'step' || i || '_empty_tool' END], lambda x: x IS NOT NULL)) AS steps FROM t)
    SELECT conv_id, array_to_string(list_concat(CASE WHEN length({_strip("coalesce(goal, '')")}) = 0 THEN ['empty_goal'] ELSE [] END, ['no_final_answer'], flatten(steps)), ' ') AS problems FROM s"""
)
def trajectory_validate(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").withColumn("tool", F.when(F.col("turn") % 4 == 3, F.lit("")).otherwise(F.col("role")))
    t = c.groupBy("conv_id").agg(F.min(F.when(F.col("turn") == 0, F.col("text"))).alias("goal"), F.array_sort(F.collect_list(F.struct("turn", "tool"))).alias("steps"))
    return t.withColumns({"final_answer": F.lit(""), "available_tools": F.array(F.lit("user"), F.lit("system"))}).select("conv_id", F.array_join(synthetic.trajectory_problems(), " ").alias("problems"))


_SEARCHED = "the and inea of the"


@query(
    f"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{_W}')) AS term FROM documents), p AS (SELECT term, doc_id, count(*) AS tf FROM w GROUP BY ALL), q AS (SELECT term, count(*) AS times FROM (SELECT unnest(string_split('{_SEARCHED}', ' ')) AS term) GROUP BY ALL),
    f AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) + 1 AS idf FROM p GROUP BY ALL) SELECT doc_id, round(sum(tf * idf * times), 4) AS score FROM p JOIN q USING (term) JOIN f USING (term) GROUP BY doc_id ORDER BY score DESC, doc_id LIMIT 10"""
)
def tfidf_topk(spark, sf_dir):
    return search.build_index(table(spark, sf_dir, "documents")).search(_SEARCHED, 10).select("doc_id", "score")


@query("SELECT doc_id FROM documents WHERE lower(trim(text)) = (SELECT lower(trim(text)) FROM documents WHERE doc_id = 11)")
def exact_lookup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    text = docs.filter("doc_id = 11").first()["text"]
    return search.build_index(docs).exact(text)


@query(
    f"""WITH c AS (SELECT doc_id AS item_id, {_collapse("text")} AS t FROM documents), g AS (SELECT item_id, substring(t, unnest(range(1, greatest(length(t) - 2, 1) + 1))::INT, 3) AS s FROM c WHERE length(t) > 0),
    b AS (SELECT item_id, ('0x' || right(md5(s), 2))::INT AS bucket, count(*) AS n FROM g GROUP BY ALL) SELECT item_id AS doc_id, bucket::BIGINT AS bucket, round(n / sqrt(sum(n * n) OVER (PARTITION BY item_id)), 6) AS weight FROM b"""
)
def hash_embedding(spark, sf_dir):
    return embed_sparse(table(spark, sf_dir, "documents")).select("doc_id", "bucket", F.round("weight", 6).alias("weight"))


@query()
def minhash_signatures(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", signatures()(F.col("text")).alias("signature"))


_AUDIO = f"""a AS (SELECT conv_id * 100 + turn AS ord, {_normal("text")} AS t, CASE WHEN turn > 0 THEN round(length(text) / 15.0, 1)::DOUBLE END AS d, CASE conv_id % 3 WHEN 0 THEN 'hi' WHEN 1 THEN 'ta' END AS language, role AS speaker_id FROM conversations),
    e AS (SELECT *, CASE WHEN length({_strip("t")}) = 0 THEN 'empty_transcript' WHEN {_n("t", _W)} < 1 THEN 'too_few_words' WHEN d < 0.5 THEN 'too_short' WHEN d > 30 THEN 'too_long' WHEN d IS NOT NULL AND length(t) / greatest(d, 0.01) > 25 THEN 'chars_per_sec_high' END AS rule FROM a),
    z AS (SELECT *, CASE WHEN rule IS NOT NULL THEN rule WHEN row_number() OVER (PARTITION BY rule IS NULL, lower(t) ORDER BY ord) > 1 THEN 'duplicate_transcript' END AS reason FROM e)"""


def _audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    tongue = F.when(F.col("conv_id") % 3 == 0, F.lit("hi")).when(F.col("conv_id") % 3 == 1, F.lit("ta"))
    return c.select((F.col("conv_id") * 100 + F.col("turn")).alias("ord"), F.col("text").alias("transcript"), F.when(F.col("turn") > 0, F.round(F.length("text") / 15.0, 1)).cast("double").alias("duration_sec"), tongue.alias("language"), F.col("role").alias("speaker_id"))


@query(f"WITH {_AUDIO} SELECT ord, reason FROM z")
def speech_curate(spark, sf_dir):
    return speech.curate(_audio(spark, sf_dir)).select("ord", rules.reason_kind(F.col("drop_reason")).alias("reason"))


@query(f"WITH {_AUDIO} SELECT coalesce(language, 'und') AS language, count(*) AS utterances, round(coalesce(sum(d), 0) / 3600, 4) AS hours, count(DISTINCT speaker_id) AS speakers FROM z WHERE reason IS NULL GROUP BY 1")
def speech_stats(spark, sf_dir):
    return speech.stats(speech.curate(_audio(spark, sf_dir)).filter(F.col("drop_reason").isNull()))


@query("SELECT coalesce(s, 'kept') AS stage, count(*) AS removed FROM (SELECT CASE WHEN length(text) < 100 THEN 'filter' WHEN row_number() OVER (PARTITION BY length(text) >= 100, text ORDER BY doc_id) > 1 THEN 'exact' END AS s FROM documents) GROUP BY 1")
def stage_statistics(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = dedup.keep_first(docs, X.content_hash(F.col("text")), "doc_id", F.length("text") >= 100)
    return stats.stage_stats(marked.withColumn("drop_stage", F.when(F.length("text") < 100, F.lit("filter")).when(F.col("parent").isNotNull(), F.lit("exact"))))


@query("SELECT user_id, event_type FROM events GROUP BY ALL")
def stream_event_dedup(spark, sf_dir):
    """A batch of events through the streaming operator, to a table in the shared folder."""


    base = f"{shared_dir(spark)}/loomline/stream-{uuid.uuid4().hex}"
    events = spark.readStream.schema(table(spark, sf_dir, "events").schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*")
    out = dedup_stream(events.withColumn("ts", F.col("ts").cast("timestamp")), ["user_id", "event_type"], "ts", "400 days").select("user_id", "event_type")
    out.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("user_id long, event_type string").parquet(f"{base}/out")


from loomline import io_queries as _io_queries  # noqa: E402, F401  registers the queries of readers, writers and runs
