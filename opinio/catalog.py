"""Registered queries: name → (spark, sf_dir) → DataFrame, and the DuckDB oracle SQL.

Every query reads the driver tables (or what Spark derives from them) in full; no id
subsets, row caps or prefixes. Limits appear only where the limit is the feature
(top-k reports).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import duck as D
from .operators import wordfreq as WF
from .sources import tables as S

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ----------------------------------------------------------------------------------------
# Word frequency chain
# ----------------------------------------------------------------------------------------

@register("word_frequency_top100", f"""
WITH {D.BODY_CTE}, {D.WORDS_CTE},
counts AS (SELECT word, count(*) AS count FROM words GROUP BY word),
tot AS (SELECT CAST(sum(count) AS BIGINT) AS total_words FROM counts)
SELECT CAST(row_number() OVER (ORDER BY count DESC, word) AS INTEGER) AS rank, word, count,
       count / total_words AS frequency, {D.percent_text('count', 'total_words')} AS percent, total_words
FROM counts, tot ORDER BY count DESC, word LIMIT 100""")
def q_word_frequency_top100(spark, sf):
    return WF.top_words(S.bodies(spark, sf), 100)


@register("word_count", f"""
WITH {D.BODY_CTE}, {D.WORDS_CTE}
SELECT word, count(*) AS count FROM words GROUP BY word""")
def q_word_count(spark, sf):
    return WF.word_count(S.bodies(spark, sf))


@register("frequency_percent", f"""
WITH {D.BODY_CTE}, {D.WORDS_CTE},
counts AS (SELECT word, count(*) AS count FROM words GROUP BY word),
tot AS (SELECT CAST(sum(count) AS BIGINT) AS total_words FROM counts)
SELECT word, count, {D.percent_text('count', 'total_words')} AS percent FROM counts, tot""")
def q_frequency_percent(spark, sf):
    return WF.frequency_table(S.bodies(spark, sf))


@register("tokenize", f"""
WITH {D.BODY_CTE},
t AS (SELECT doc_id, {D.tokens('body')} AS toks FROM body)
SELECT doc_id, CAST(unnest(range(len(toks))) AS INTEGER) AS pos, unnest(toks) AS token FROM t""")
def q_tokenize(spark, sf):
    return WF.exploded_tokens(S.bodies(spark, sf))


@register("remove_stopwords", f"""
WITH {D.BODY_CTE},
t AS (SELECT doc_id, {D.tokens('body')} AS toks FROM body)
SELECT doc_id, CAST(len(toks) AS INTEGER) AS n_tokens,
       CAST(len(list_filter(toks, lambda x: x NOT IN {D.stop_list()})) AS INTEGER) AS n_kept FROM t""")
def q_remove_stopwords(spark, sf):
    return WF.stopword_counts(S.bodies(spark, sf))


@register("singularize", f"""
WITH {D.BODY_CTE},
t AS (SELECT unnest({D.tokens('body')}) AS token FROM body WHERE length(body) > 0)
SELECT token, {D.singular('token')} AS word, count(*) AS n FROM t
WHERE token NOT IN {D.stop_list()} GROUP BY token""")
def q_singularize(spark, sf):
    return WF.singular_map(S.bodies(spark, sf))


@register("processed_count", f"""
WITH {D.BODY_CTE}
SELECT count(*) AS processed_articles,
       CAST(sum(len(list_filter({D.tokens('body')}, lambda x: x NOT IN {D.stop_list()}))) AS BIGINT) AS total_words
FROM body WHERE length(body) > 0""")
def q_processed_count(spark, sf):
    return WF.processed_count(S.bodies(spark, sf))


# ----------------------------------------------------------------------------------------
# Sentiment chain
# ----------------------------------------------------------------------------------------

from .operators import sentiment as V  # noqa: E402
from .operators import stats as G  # noqa: E402
from .plans import model as MD  # noqa: E402


@register("lexicon_score", f"""
WITH {D.SCORES_CTE}
SELECT doc_id, n_hits, valence_sum, compound FROM lscores""")
def q_lexicon_score(spark, sf):
    return V.lexicon_scores(S.bodies(spark, sf), MD.lexicon(spark))


@register("label_scored", f"""
WITH {D.SCORES_CTE}
SELECT doc_id, compound, score, label FROM scores""")
def q_label_scored(spark, sf):
    return MD.scores(spark, sf)


@register("label_loaded", f"""
WITH {D.SCORES_CTE}
SELECT doc_id, score, {D.label_loaded('score')} AS sentiment FROM scores""")
def q_label_loaded(spark, sf):
    return V.loaded_label(MD.scores(spark, sf))


@register("sentiment_rates", f"""
WITH {D.SCORES_CTE}
SELECT doc_id, score, {D.rates_sql('score')} FROM scores""")
def q_sentiment_rates(spark, sf):
    return V.rates(MD.scores(spark, sf))


@register("load_sentiment", f"""
WITH {D.SENT_CTE}
SELECT * FROM sentiment_analysis""")
def q_load_sentiment(spark, sf):
    return MD.sentiment_table(spark, sf)


@register("min_words_filter", f"""
WITH {D.BODY_CTE}
SELECT doc_id, CAST({D.word_count_ws('body')} AS INTEGER) AS n_words FROM body
WHERE {D.word_count_ws('body')} >= 10""")
def q_min_words_filter(spark, sf):
    return V.min_words(S.bodies(spark, sf)).drop("body")


@register("class_counts", f"""
WITH {D.SCORES_CTE}
SELECT label, count(*) AS count FROM scores GROUP BY label
UNION ALL SELECT 'total' AS label, count(*) AS count FROM scores""")
def q_class_counts(spark, sf):
    return V.class_counts(MD.scores(spark, sf))


@register("class_counts_wide", f"""
WITH {D.SCORES_CTE}
SELECT count(*) FILTER (WHERE label = 'positive') AS positive,
       count(*) FILTER (WHERE label = 'neutral') AS neutral,
       count(*) FILTER (WHERE label = 'negative') AS negative, count(*) AS total FROM scores""")
def q_class_counts_wide(spark, sf):
    return V.class_counts_wide(MD.scores(spark, sf))


@register("top5_by_class", f"""
WITH {D.SCORES_CTE}, {D.TITLES_CTE},
s AS (SELECT * FROM scores JOIN titles USING (doc_id))
(SELECT label, doc_id, title, score FROM s WHERE label = 'positive' ORDER BY compound DESC, title, doc_id LIMIT 5)
UNION ALL
(SELECT label, doc_id, title, score FROM s WHERE label = 'negative' ORDER BY compound ASC, title, doc_id LIMIT 5)""")
def q_top5_by_class(spark, sf):
    return V.top_by_class(MD.scores(spark, sf), MD.titles(spark, sf), 5)


_REPORT_KEY = ("CASE WHEN label = 'positive' THEN -compound WHEN label = 'negative' THEN compound "
               "ELSE abs(compound) END")


@register("ranked_report_lines", f"""
WITH {D.SCORES_CTE}, {D.TITLES_CTE},
r AS (SELECT CASE label WHEN 'positive' THEN 1 WHEN 'negative' THEN 2 ELSE 3 END AS section,
             row_number() OVER (PARTITION BY label ORDER BY {_REPORT_KEY}, title, doc_id) AS rank,
             title, score FROM scores JOIN titles USING (doc_id)),
c AS (SELECT count(*) FILTER (WHERE label = 'positive') AS p, count(*) FILTER (WHERE label = 'negative') AS n,
             count(*) FILTER (WHERE label = 'neutral') AS u, count(*) AS t FROM scores)
SELECT CAST(section AS INTEGER) AS section, CAST(rank AS BIGINT) AS rank,
       CAST(rank AS VARCHAR) || '. ' || title || ' (得分: ' || CAST(score AS VARCHAR) || ')' AS line FROM r
UNION ALL SELECT 0, 1, '情感分析详细结果' UNION ALL SELECT 0, 2, '=============='
UNION ALL SELECT 0, 3, '汇总统计:'
UNION ALL SELECT 0, 4, '正向报道: ' || p || '篇' FROM c UNION ALL SELECT 0, 5, '负面报道: ' || n || '篇' FROM c
UNION ALL SELECT 0, 6, '中性报道: ' || u || '篇' FROM c UNION ALL SELECT 0, 7, '总计: ' || t || '篇' FROM c
UNION ALL SELECT 1, 0, '正向报道列表 (共' || p || '篇):' FROM c
UNION ALL SELECT 2, 0, '负面报道列表 (共' || n || '篇):' FROM c
UNION ALL SELECT 3, 0, '中性报道列表 (共' || u || '篇):' FROM c""")
def q_ranked_report_lines(spark, sf):
    return V.ranked_report_lines(MD.scores(spark, sf), MD.titles(spark, sf))


# ----------------------------------------------------------------------------------------
# Statistics and verification
# ----------------------------------------------------------------------------------------

@register("source_statistics", f"""
WITH {D.CORPUS_CTE}, {D.SENT_CTE},
j AS (SELECT c.source, c.type, sa.sentiment, sa.sentiment_score FROM corpus c
      LEFT JOIN sentiment_analysis sa ON c.id = sa.corpus_id)
SELECT DATE '{MD.STAT_DATE}' AS stat_date, source, count(*) AS total_count,
       count(*) FILTER (WHERE type = 'text') AS text_count, count(*) FILTER (WHERE type = 'image') AS image_count,
       count(*) FILTER (WHERE type = 'video') AS video_count,
       count(*) FILTER (WHERE sentiment = 'positive') AS positive_count,
       count(*) FILTER (WHERE sentiment = 'neutral') AS neutral_count,
       count(*) FILTER (WHERE sentiment = 'negative') AS negative_count,
       {D.avg6_to2('sentiment_score')} AS avg_sentiment
FROM j GROUP BY source""")
def q_source_statistics(spark, sf):
    return G.source_statistics(S.corpus(spark, sf), MD.sentiment_table(spark, sf), MD.STAT_DATE)


@register("corpus_statistics", f"""
WITH {D.CORPUS_CTE}
SELECT source, type, strftime(publish_date, '%Y-%m') AS month, count(*) AS count
FROM corpus GROUP BY source, type, strftime(publish_date, '%Y-%m')""")
def q_corpus_statistics(spark, sf):
    return G.corpus_statistics(S.corpus(spark, sf))


@register("sentiment_statistics", f"""
WITH {D.CORPUS_CTE}, {D.SENT_CTE}
SELECT c.source, sa.sentiment, count(*) AS count, {D.avg6('sa.sentiment_score')} AS avg_score
FROM corpus c LEFT JOIN sentiment_analysis sa ON c.id = sa.corpus_id GROUP BY c.source, sa.sentiment""")
def q_sentiment_statistics(spark, sf):
    return G.sentiment_statistics(S.corpus(spark, sf), MD.sentiment_table(spark, sf))


@register("media_activity", f"""
WITH {D.CORPUS_CTE},
src AS (SELECT media_name, source, strftime(publish_date, '%Y-%m') AS stat_month, count(*) AS n FROM corpus GROUP BY ALL),
per AS (SELECT media_name, stat_month, CAST(sum(n) AS BIGINT) AS article_count,
               arg_min(source, row(-n, source)) AS source FROM src GROUP BY media_name, stat_month),
mx AS (SELECT stat_month, max(article_count) AS m FROM per GROUP BY stat_month)
SELECT media_name, source, article_count,
       CAST(CAST(article_count * 100 AS DECIMAL(38,6)) / m AS DECIMAL(5,2)) AS activity_score, stat_month
FROM per JOIN mx USING (stat_month)""")
def q_media_activity(spark, sf):
    return G.media_activity(S.corpus(spark, sf))


@register("q_corpus_count", "SELECT count(*) AS n FROM documents")
def q_corpus_count(spark, sf):
    return G.q_count(S.corpus(spark, sf))


@register("q_source_count", "SELECT lang AS source, count(*) AS count FROM documents GROUP BY lang")
def q_source_count(spark, sf):
    return G.q_source_count(S.corpus(spark, sf))


@register("q_sentiment_count", f"WITH {D.SENT_CTE} SELECT count(*) AS n FROM sentiment_analysis")
def q_sentiment_count(spark, sf):
    return G.q_count(MD.sentiment_table(spark, sf))


@register("q_sentiment_distribution", f"""
WITH {D.SENT_CTE}
SELECT sentiment, count(*) AS count, {D.avg6('sentiment_score')} AS avg_score
FROM sentiment_analysis GROUP BY sentiment""")
def q_sentiment_distribution(spark, sf):
    return G.q_sentiment_distribution(MD.sentiment_table(spark, sf))


@register("q_top_positive", f"""
WITH {D.CORPUS_CTE}, {D.SENT_CTE}
SELECT c.id, c.title, c.source, sa.sentiment, sa.sentiment_score
FROM corpus c JOIN sentiment_analysis sa ON c.id = sa.corpus_id
ORDER BY sa.sentiment_score DESC, c.id LIMIT 5""")
def q_top_positive(spark, sf):
    return G.q_top_sentiment(S.corpus(spark, sf), MD.sentiment_table(spark, sf), 5, True)


@register("q_top_negative", f"""
WITH {D.CORPUS_CTE}, {D.SENT_CTE}
SELECT c.id, c.title, c.source, sa.sentiment, sa.sentiment_score
FROM corpus c JOIN sentiment_analysis sa ON c.id = sa.corpus_id
ORDER BY sa.sentiment_score ASC, c.id LIMIT 5""")
def q_top_negative(spark, sf):
    return G.q_top_sentiment(S.corpus(spark, sf), MD.sentiment_table(spark, sf), 5, False)


# ----------------------------------------------------------------------------------------
# Keyword tables (S4, W8-W10, M6, K5, K6) and their verification (Q8-Q18)
# ----------------------------------------------------------------------------------------

from .operators import keywords as K  # noqa: E402

# Fixed parameter: the IN-list of Q18, words that occur in the driver prose.
EXAMPLE_KEYWORDS = ("de", "la", "que")


@register("typed_frequency_sheet", f"""
WITH {D.SHEET_CTE}
SELECT keyword, count, freq, {D.heat_score('freq', 'count')} AS heat_score,
       {D.keyword_weight('freq', 'count')} AS weight FROM sheet""")
def q_typed_frequency_sheet(spark, sf):
    return K.typed_sheet(MD.sheet(spark, sf))


@register("heat_score", f"""
WITH {D.HOT_CTE}
SELECT keyword, source, count, heat_score, stat_date, create_time, update_time FROM hot_keywords""")
def q_heat_score(spark, sf):
    return MD.hot_keywords(spark, sf)


@register("keyword_weight", f"""
WITH {D.SHEET_CTE}
SELECT keyword, count AS frequency, {D.keyword_weight('freq', 'count')} AS weight FROM sheet""")
def q_keyword_weight(spark, sf):
    return K.typed_sheet(MD.sheet(spark, sf)).select("keyword", F.col("count").alias("frequency"), "weight")


@register("assign_keywords", f"""
WITH {D.KEYWORDS_CTE}
SELECT corpus_id, keyword, weight, frequency FROM keywords""")
def q_assign_keywords(spark, sf):
    return MD.keywords(spark, sf)


_CONV_BODY = f"""body AS (SELECT conv_id * 1000 + turn AS doc_id, {D.ustrip('text')} AS body FROM conversations)"""
_UPSERT_SQL = f"""
WITH {D.top_words_cte(name='top')},
new_sheet AS ({D.typed_sheet_sql('top')}),
incoming AS (SELECT keyword, 'all' AS source, DATE '2024-12-31' AS stat_date, count,
             {D.heat_score('freq', 'count')} AS heat_score, TIMESTAMP '2024-12-31 12:00:00' AS t FROM new_sheet),
existing AS (
  WITH {D.top_words_cte(_CONV_BODY, name='otop').replace('words AS', 'words AS', 1)}
  SELECT trim(word) AS keyword, 'all' AS source, DATE '2024-12-31' AS stat_date,
         TRY_CAST(trim(CAST(count AS VARCHAR)) AS BIGINT) AS count,
         {D.heat_score('trim(percent)', 'count')} AS heat_score, TIMESTAMP '2024-12-31 00:00:00' AS t
  FROM otop WHERE trim(word) NOT IN ('', 'nan'))
SELECT coalesce(i.keyword, e.keyword) AS keyword, coalesce(i.source, e.source) AS source,
       coalesce(i.stat_date, e.stat_date) AS stat_date,
       CASE WHEN i.t IS NOT NULL THEN i.count ELSE e.count END AS count,
       CASE WHEN i.t IS NOT NULL THEN i.heat_score ELSE e.heat_score END AS heat_score,
       coalesce(e.t, i.t) AS create_time, CASE WHEN i.t IS NOT NULL THEN i.t ELSE e.t END AS update_time
FROM existing e FULL OUTER JOIN incoming i
  ON e.keyword = i.keyword AND e.source = i.source AND e.stat_date = i.stat_date"""


@register("hot_keywords_upsert", _UPSERT_SQL)
def q_hot_keywords_upsert(spark, sf):
    from .operators import wordfreq as WF
    existing = K.hot_keywords(K.sheet_from_top_words(WF.top_words(MD.conversation_bodies(spark, sf), 100)),
                              MD.STAT_DATE, now=f"{MD.STAT_DATE} 00:00:00")
    incoming = K.hot_keywords(MD.sheet(spark, sf), MD.STAT_DATE, now=f"{MD.STAT_DATE} 12:00:00")
    return K.upsert_hot_keywords(existing, incoming)


@register("hot_keywords_stored", _UPSERT_SQL)
def q_hot_keywords_stored(spark, sf):
    """K5 against a stored table: two loads, the second one run twice."""
    import uuid

    from .operators import wordfreq as WF
    from .plans.scratch import shared_folder
    from .sinks import merge as MG
    path = f"{shared_folder(spark)}/opinio/hot-keywords-{uuid.uuid4().hex}"
    first = K.hot_keywords(K.sheet_from_top_words(WF.top_words(MD.conversation_bodies(spark, sf), 100)),
                           MD.STAT_DATE, now=f"{MD.STAT_DATE} 00:00:00")
    second = K.hot_keywords(MD.sheet(spark, sf), MD.STAT_DATE, now=f"{MD.STAT_DATE} 12:00:00")
    for load, rows in (("first", first), ("second", second), ("second", second)):
        MG.merge_into(rows, path, ["keyword", "source", "stat_date"], load, first_wins=("create_time",))
    return MG.read_stored(spark, path, first.schema).select(
        "keyword", "source", "stat_date", "count", "heat_score", "create_time", "update_time")


@register("rejects", f"""
WITH {D.BODY_CTE}, {D.WORDS_CTE},
counts AS (SELECT word, count(*) AS count FROM words GROUP BY word),
tot AS (SELECT CAST(sum(count) AS BIGINT) AS total_words FROM counts),
sheet AS (SELECT CASE length(word) WHEN 2 THEN 'nan' WHEN 7 THEN repeat(word, 20) ELSE word END AS keyword,
                 CASE WHEN length(word) = 4 THEN CAST(count AS VARCHAR) || 'x' ELSE CAST(count AS VARCHAR) END AS count,
                 {D.percent_text('count', 'total_words')} AS freq FROM counts, tot),
r AS (SELECT keyword, count, freq,
        CASE WHEN trim(keyword) IS NULL OR trim(keyword) IN ('', 'nan') THEN 'blank keyword'
             WHEN length(trim(keyword)) > 100 THEN 'keyword too long'
             WHEN TRY_CAST(trim(count) AS BIGINT) IS NULL THEN 'count not an integer'
             WHEN {D.heat_score('trim(freq)', 'TRY_CAST(trim(count) AS BIGINT)')} IS NULL THEN 'heat not a DECIMAL(5,2)'
             WHEN {D.keyword_weight('trim(freq)', 'TRY_CAST(trim(count) AS BIGINT)')} IS NULL THEN 'weight not a DECIMAL(5,2)'
        END AS reason FROM sheet)
SELECT * FROM r WHERE reason IS NOT NULL""")
def q_rejects(spark, sf):
    from .operators import wordfreq as WF
    n = F.length("word")                                # a sheet with faults: by word length
    full = WF.frequency_table(S.bodies(spark, sf)).select(
        F.when(n == 2, "nan").when(n == 7, F.repeat("word", 20)).otherwise(F.col("word")).alias("keyword"),
        F.concat(F.col("count").cast("string"), F.when(n == 4, "x").otherwise("")).alias("count"), F.col("percent").alias("freq"))
    return K.rejects(full)


@register("q_hot_count", f"WITH {D.HOT_CTE} SELECT count(*) AS n FROM hot_keywords")
def q_hot_count(spark, sf):
    return G.q_count(MD.hot_keywords(spark, sf))


@register("q_hot_distinct", f"WITH {D.HOT_CTE} SELECT count(DISTINCT keyword) AS n FROM hot_keywords")
def q_hot_distinct(spark, sf):
    return G.q_distinct(MD.hot_keywords(spark, sf), "keyword", "n")


@register("q_hot_by_source", f"""
WITH {D.HOT_CTE}
SELECT source, count(*) AS keyword_count, {D.avg6('heat_score', 9)} AS avg_heat_score
FROM hot_keywords GROUP BY source""")
def q_hot_by_source(spark, sf):
    return G.q_hot_by_source(MD.hot_keywords(spark, sf))


@register("q_hot_top15", f"""
WITH {D.HOT_CTE}
SELECT keyword, source, count, heat_score, stat_date FROM hot_keywords
ORDER BY heat_score DESC, keyword, source LIMIT 15""")
def q_hot_top15(spark, sf):
    return G.q_hot_top(MD.hot_keywords(spark, sf), 15)


@register("q_hot_dates", f"WITH {D.HOT_CTE} SELECT DISTINCT stat_date FROM hot_keywords")
def q_hot_dates(spark, sf):
    return G.q_hot_dates(MD.hot_keywords(spark, sf))


@register("q_heat_bands", f"""
WITH {D.HOT_CTE}
SELECT CASE WHEN heat_score >= 50 THEN '高热度 (>=50)' WHEN heat_score >= 10 THEN '中热度 (10-50)'
            WHEN heat_score >= 1 THEN '低热度 (1-10)' ELSE '极低热度 (<1)' END AS heat_level,
       count(*) AS keyword_count, min(heat_score) AS min_heat
FROM hot_keywords GROUP BY 1""")
def q_heat_bands(spark, sf):
    return G.q_heat_bands(MD.hot_keywords(spark, sf))


@register("q_keyword_totals", f"""
WITH {D.KEYWORDS_CTE}
SELECT count(*) AS keyword_rows, count(DISTINCT keyword) AS distinct_keywords,
       count(DISTINCT corpus_id) AS distinct_articles FROM keywords""")
def q_keyword_totals(spark, sf):
    return G.q_keyword_totals(MD.keywords(spark, sf))


@register("q_keyword_top10", f"""
WITH {D.KEYWORDS_CTE}
SELECT keyword, count(*) AS article_count, avg(frequency) AS avg_frequency, {D.avg6('weight', 9)} AS avg_weight
FROM keywords GROUP BY keyword ORDER BY avg_weight DESC, keyword LIMIT 10""")
def q_keyword_top10(spark, sf):
    return G.q_keyword_top(MD.keywords(spark, sf), 10)


@register("q_keywords_per_article", f"""
WITH {D.KEYWORDS_CTE}
SELECT keyword_count, count(*) AS article_count
FROM (SELECT corpus_id, count(*) AS keyword_count FROM keywords GROUP BY corpus_id) GROUP BY keyword_count""")
def q_keywords_per_article(spark, sf):
    return G.q_keywords_per_article(MD.keywords(spark, sf))


@register("q_keywords_by_source", f"""
WITH {D.KEYWORDS_CTE}, {D.CORPUS_CTE}
SELECT c.source, count(*) AS keyword_count, count(DISTINCT k.keyword) AS unique_keywords
FROM keywords k JOIN corpus c ON k.corpus_id = c.id GROUP BY c.source""")
def q_keywords_by_source(spark, sf):
    return G.q_keywords_by_source(MD.keywords(spark, sf), S.corpus(spark, sf))


@register("q_keyword_examples", f"""
WITH {D.KEYWORDS_CTE}, {D.CORPUS_CTE}
SELECT k.corpus_id, c.title, k.keyword, k.weight, k.frequency
FROM keywords k JOIN corpus c ON k.corpus_id = c.id
WHERE k.keyword IN {tuple(EXAMPLE_KEYWORDS)}
ORDER BY k.weight DESC, k.frequency DESC, k.corpus_id, k.keyword LIMIT 10""")
def q_keyword_examples(spark, sf):
    return G.q_keyword_examples(MD.keywords(spark, sf), S.corpus(spark, sf), EXAMPLE_KEYWORDS, 10)


# ----------------------------------------------------------------------------------------
# Report parsing and title matching
# ----------------------------------------------------------------------------------------

from .operators import matching as M  # noqa: E402


@register("parse_ranked_report", f"WITH {D.REPORT_CTE} SELECT seq, title, score FROM report")
def q_parse_ranked_report(spark, sf):
    return MD.report(spark, sf)


@register("search_results_load", """
SELECT CASE WHEN doc_id % 13 <> 5 THEN 'https://news.example/' || doc_id END AS url,
       CASE WHEN doc_id % 13 <> 5 THEN split_part(text, chr(10), 1) END AS title,
       CASE WHEN doc_id % 13 = 5 THEN '{"url":"https://news.example/' || doc_id || '","title":' END AS reject
FROM documents""")
def q_search_results_load(spark, sf):
    """S5 with K6: hits and rejects of landed search-result files with broken lines."""
    from .sources import reports as R
    return R.read_search_hits(spark, MD.search_files(spark, sf)).select("url", "title", "reject")


@register("dedupe_last", f"WITH {D.REPORT_CTE} SELECT title, score, seq FROM dedup")
def q_dedupe_last(spark, sf):
    return MD.report_dedup(spark, sf)


@register("match_exact", f"""
WITH {D.REPORT_CTE}, {D.ARTICLES_CTE}
SELECT a.a_title, a.a_id, d.seq AS r_seq, d.score FROM articles a LEFT JOIN dedup d ON a.a_title = d.title""")
def q_match_exact(spark, sf):
    return M.match_exact(MD.articles(spark, sf), MD.report_dedup(spark, sf))


@register("match_fuzzy", f"""
WITH {D.REPORT_CTE}, {D.ARTICLES_CTE}, {D.FUZZY_CTE}
SELECT a_id, r_seq FROM fuzzy""")
def q_match_fuzzy(spark, sf):
    return M.match_fuzzy(MD.articles(spark, sf), MD.report_dedup(spark, sf))


@register("match_containment", f"""
WITH {D.REPORT_CTE}, {D.ARTICLES_CTE}
SELECT a_id, seq AS r_seq FROM articles, dedup
WHERE contains(lower(dedup.title), lower(articles.a_title)) OR contains(lower(articles.a_title), lower(dedup.title))""")
def q_match_containment(spark, sf):
    return M.match_containment(MD.articles(spark, sf), MD.report_dedup(spark, sf))


@register("match_best", f"""
WITH {D.REPORT_CTE}, {D.ARTICLES_CTE}, {D.BEST_CTE}
SELECT best.a_id, best.r_seq, CASE WHEN p = 0 THEN 'exact' ELSE 'fuzzy' END AS how, d.title AS r_title, d.score
FROM best JOIN dedup d ON best.r_seq = d.seq""")
def q_match_best(spark, sf):
    return M.match_best(MD.articles(spark, sf), MD.report_dedup(spark, sf))


@register("unmatched_articles", f"""
WITH {D.REPORT_CTE}, {D.ARTICLES_CTE}, {D.BEST_CTE}
SELECT a_id, a_title FROM articles WHERE a_id NOT IN (SELECT a_id FROM best)""")
def q_unmatched_articles(spark, sf):
    arts = MD.articles(spark, sf)
    return M.unmatched(arts, M.match_best(arts, MD.report_dedup(spark, sf)))


# ----------------------------------------------------------------------------------------
# Article files: render (K11, C11) and read back (F1-F8, F13), scoring variant
# ----------------------------------------------------------------------------------------

from .functions import text as TX  # noqa: E402


@register("render_article", f"WITH {D.RENDERED_CTE} SELECT doc_id, file_name, article FROM rendered")
def q_render_article(spark, sf):
    return MD.rendered(spark, sf).select("doc_id", "file_name", "article")


@register("extract_body", f"WITH {D.RENDERED_CTE} SELECT doc_id, {D.body_strict('article')} AS body FROM rendered")
def q_extract_body(spark, sf):
    return MD.rendered(spark, sf).select("doc_id", TX.body_strict(F.col("article")).alias("body"))


@register("extract_body_fallback", f"SELECT doc_id, {D.body_fallback('text')} AS body FROM documents")
def q_extract_body_fallback(spark, sf):
    d = S.read_table(spark, sf, "documents", text_work=True)
    return d.select("doc_id", TX.body_fallback(F.col("text")).alias("body"))


@register("header_title", f"""WITH {D.RENDERED_CTE}
SELECT doc_id, CASE WHEN instr(article, '标题: ') > 0 THEN regexp_extract(article, '标题: ([^' || chr(10) || ']*)', 1)
                    ELSE file_name END AS title FROM rendered""")
def q_header_title(spark, sf):
    r = MD.rendered(spark, sf)
    return r.select("doc_id", TX.header_title(F.col("article"), F.col("file_name")).alias("title"))


@register("publish_date", f"WITH {D.RENDERED_CTE} SELECT doc_id, {D.publish_date('article')} AS publish_date FROM rendered")
def q_publish_date(spark, sf):
    return MD.rendered(spark, sf).select("doc_id", TX.publish_date(F.col("article")).alias("publish_date"))


@register("title_preview", "SELECT doc_id AS id, substr(text, 1, 100) || '...' AS preview FROM documents")
def q_title_preview(spark, sf):
    return S.corpus(spark, sf).select("id", TX.preview(F.col("content"), 100).alias("preview"))


_DETAILS_BODY = f"""{D.RENDERED_CTE},
body AS (SELECT doc_id, CASE WHEN instr(article, '正文内容:') > 0 THEN {D.body_loose('article')} ELSE article END AS body
         FROM rendered WHERE {D.word_count_ws(f"CASE WHEN instr(article, '正文内容:') > 0 THEN {D.body_loose('article')} ELSE article END")} >= 10)"""


@register("sentiment_details", f"""
WITH {D.scores_cte(_DETAILS_BODY)}
SELECT r.doc_id, r.file_name, s.label AS sentiment, s.score FROM scores s JOIN rendered r USING (doc_id)""")
def q_sentiment_details(spark, sf):
    r = MD.rendered(spark, sf)
    art = F.col("article")
    body = F.when(TX.has_body_marker(art), TX.body_loose(art)).otherwise(art)
    docs = V.min_words(r.select("doc_id", body.alias("body")), 10).select("doc_id", "body")
    return V.details(V.scored(docs, MD.lexicon(spark)), r.select("doc_id", "file_name"))


# ----------------------------------------------------------------------------------------
# Page ingest over the landed pages table
# ----------------------------------------------------------------------------------------

from .functions import html as HT  # noqa: E402
from .operators import pages as P  # noqa: E402


def _pages(spark, sf):
    return S.read_table(spark, sf, "pages", text_work=True).select("page_id", "url", "html")


@register("page_paragraphs", f"""
WITH {D.pages_cte()}
SELECT page_id, CAST(unnest(range(len(paragraphs))) AS INTEGER) AS pos, unnest(paragraphs) AS paragraph
FROM parsed WHERE container IS NOT NULL""")
def q_page_paragraphs(spark, sf):
    return P.page_paragraphs(_pages(spark, sf))


@register("page_title", f"WITH {D.pages_cte()} SELECT page_id, url, title FROM parsed")
def q_page_title(spark, sf):
    return P.page_titles(_pages(spark, sf))


@register("page_body", f"""
WITH {D.pages_cte()}
SELECT page_id, CAST(len(paragraphs) AS INTEGER) AS n_paragraphs, array_to_string(paragraphs, chr(10) || chr(10)) AS body
FROM parsed WHERE container IS NOT NULL AND len(paragraphs) > 0""")
def q_page_body(spark, sf):
    return P.page_body(_pages(spark, sf))


@register("page_rejects", f"""
WITH {D.pages_cte()}
SELECT page_id, url, CASE WHEN container IS NULL THEN 'no body container' ELSE 'no text' END AS reason
FROM parsed WHERE container IS NULL OR len(paragraphs) = 0""")
def q_page_rejects(spark, sf):
    return P.page_rejects(_pages(spark, sf))


_LINKS_SQL = f"""
WITH pc AS (SELECT page_id, url, regexp_replace(html, {D.q(HT.NOISE)}, '', 'g') AS clean FROM pages),
a AS (SELECT page_id, url, regexp_extract_all(clean, {D.q('(?s)<a' + chr(92) + 'b[^>]*href="[^"]*"[^>]*>.*?</a>')}, 0) AS anchors FROM pc),
e AS (SELECT page_id, url, CAST(unnest(range(len(anchors))) AS INTEGER) AS pos, unnest(anchors) AS anc FROM a),
f AS (SELECT page_id, url, pos, regexp_extract(anc, 'href="([^"]*)"', 1) AS href,
             {D.text_of(f"regexp_extract(anc, {D.q('(?s)<a' + chr(92) + 'b[^>]*>(.*?)</a>')}, 1)")} AS txt FROM e)
SELECT page_id, pos, {D.absolutize('href', D.base_of('url'))} AS link,
       CASE WHEN txt <> '' THEN txt ELSE 'No Title' END AS title
FROM f WHERE href <> ''"""


@register("extract_links", _LINKS_SQL)
def q_extract_links(spark, sf):
    return P.extract_links(_pages(spark, sf))


@register("article_filename", f"""
WITH {D.pages_cte()}
SELECT page_id, url, title, {D.article_filename('url', 'title')} AS file_name
FROM parsed WHERE container IS NOT NULL AND len(paragraphs) > 0""")
def q_article_filename(spark, sf):
    return P.article_files(_pages(spark, sf))


# The media stand-in's rows by its own rule; what the job finds on the pages must equal them.
_MEDIA_CTE = f"""
mp AS (SELECT page_id, {D.base_of('url')} AS base FROM pages WHERE contains(html, '</article>')),
im AS (SELECT *, unnest(range(page_id % 4)) AS j FROM mp),
ki AS (SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY j) - 1 AS INTEGER) AS pos, j, base || '/img/' || page_id || '-' || j AS src,
              CASE WHEN (page_id + j) % 3 <> 0 THEN 'Picture ' || j || ' of ' || page_id ELSE {D.q(TX.NO_CAPTION)} END AS caption
       FROM im WHERE ((page_id + j) * 40) % 300 >= 100),
kv AS (SELECT page_id, 0 AS pos, CASE page_id % 5 WHEN 0 THEN 'https://media.example/' || page_id ELSE base || '/player/' || page_id END AS src, page_id % 5 AS how
       FROM mp WHERE page_id % 5 < 2)"""


@register("media_page_images", f"WITH {_MEDIA_CTE} SELECT page_id, pos, src, caption FROM ki")
def q_media_page_images(spark, sf):
    return P.page_images(MD.media_pages(spark, sf))


# a player frame counts as a player and as its container's first frame
@register("media_page_videos", f"""WITH {_MEDIA_CTE}
SELECT page_id, pos, src FROM kv UNION ALL SELECT page_id, 1, src FROM kv WHERE how = 1""")
def q_media_page_videos(spark, sf):
    return P.page_videos(MD.media_pages(spark, sf))


@register("media_page_counts", f"""WITH {_MEDIA_CTE}
SELECT page_id, CAST((SELECT count(*) FROM ki WHERE ki.page_id = mp.page_id) AS INTEGER) AS images,
       CAST(CASE page_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS INTEGER) AS videos FROM mp""")
def q_media_page_counts(spark, sf):
    return P.media_counts(MD.media_pages(spark, sf).where(F.contains("html", F.lit("</article>"))))


@register("media_files", f"""WITH {_MEDIA_CTE},
m AS (SELECT page_id, 'image' AS kind, pos, src, caption, CASE (page_id + j) % 4 WHEN 0 THEN '.png' WHEN 1 THEN '.webp' ELSE '.jpg' END AS ext,
             page_id % 7 = 0 AND (page_id + j) % 4 < 3 AS landed FROM ki
      UNION ALL SELECT page_id, 'video', pos, src, NULL, '.mp4', false FROM kv
      UNION ALL SELECT page_id, 'video', 1, src, NULL, '.mp4', false FROM kv WHERE how = 1)
SELECT page_id, kind, pos, src, caption, md5(src) || ext AS file_name FROM m WHERE NOT landed""")
def q_media_files(spark, sf):
    return P.media_files(MD.media_pages(spark, sf), MD.media_answers(spark, sf), MD.landed_media(spark, sf))


@register("media_counts")
def q_media_counts(spark, sf):
    return P.media_counts(_pages(spark, sf))


@register("page_images")
def q_page_images(spark, sf):
    return P.page_images(_pages(spark, sf))


@register("page_videos")
def q_page_videos(spark, sf):
    return P.page_videos(_pages(spark, sf))


@register("untitled_names", f"""
WITH {D.pages_cte()},
u AS (SELECT page_id, url, row_number() OVER (ORDER BY page_id) AS n FROM parsed
      WHERE title IS NULL AND container IS NOT NULL AND len(paragraphs) > 0)
SELECT page_id, url, n, 'Untitled Article ' || CAST(n AS VARCHAR) AS title,
       {D.article_filename('url', "'Untitled Article ' || CAST(n AS VARCHAR)")} AS file_name FROM u""")
def q_untitled_names(spark, sf):
    p = P.parse_pages(_pages(spark, sf)).where(F.col("found") & (F.size("paragraphs") > 0))
    return P.untitled_names(p, [F.col("page_id").asc()])


# ----------------------------------------------------------------------------------------
# Search stand-in and crawl bookkeeping
# ----------------------------------------------------------------------------------------

from .operators import ingest as I  # noqa: E402


@register("phrase_search", f"WITH {D.search_ctes()} SELECT phrase_seq, phrase, doc_id, url, title FROM hits")
def q_phrase_search(spark, sf):
    return MD.search_hits(spark, sf)


@register("phrase_search_dated", f"""
WITH {D.search_ctes()}
SELECT DISTINCT p.phrase_seq, p.phrase, d.doc_id, d.url, d.title, d.publish_date
FROM sd d JOIN ph p ON instr(lower(d.text), lower(p.phrase)) > 0 JOIN rg r ON r.phrase_seq = p.phrase_seq
WHERE d.publish_date BETWEEN r.start_date AND r.end_date""")
def q_phrase_search_dated(spark, sf):
    return I.phrase_search_dated(MD.searchable(spark, sf), I.phrases_df(spark, MD.SEARCH_PHRASES),
                                 I.ranges_df(spark, [(i, a, b) for i in range(len(MD.SEARCH_PHRASES))
                                                     for a, b in MD.SEARCH_RANGES]))


@register("search_union", f"WITH {D.search_ctes()} SELECT phrase_seq, doc_id, url, title FROM hits")
def q_search_union(spark, sf):
    return I.search_union(MD.search_hits(spark, sf))


@register("per_phrase_cap", f"""
WITH {D.search_ctes()}
SELECT * FROM (SELECT phrase_seq, phrase, doc_id, url, title,
                      CAST(row_number() OVER (PARTITION BY phrase_seq ORDER BY doc_id) AS INTEGER) AS hit_rank FROM hits)
WHERE hit_rank <= 150""")
def q_per_phrase_cap(spark, sf):
    return I.per_phrase_cap(MD.search_hits(spark, sf))


@register("dedupe_url_first", f"WITH {D.search_ctes()} SELECT url, phrase_seq, doc_id, title FROM uhits")
def q_dedupe_url_first(spark, sf):
    return I.dedupe_url_first(MD.search_hits(spark, sf))


@register("target_cap", f"""
WITH {D.search_ctes()} SELECT url, phrase_seq, doc_id, title FROM uhits ORDER BY phrase_seq, doc_id LIMIT 200""")
def q_target_cap(spark, sf):
    return I.target_cap(I.dedupe_url_first(MD.search_hits(spark, sf)))


@register("new_urls_only", f"""
WITH {D.search_ctes()}
SELECT url, phrase_seq, doc_id, title FROM uhits
WHERE url NOT IN (SELECT {D.ARTICLE_URL.replace('doc_id', 'l.doc_id')} FROM labels l)""")
def q_new_urls_only(spark, sf):
    return I.new_only(I.dedupe_url_first(MD.search_hits(spark, sf)), MD.landed_urls(spark, sf))


@register("nested_report", f"""
WITH {D.search_ctes()}
SELECT phrase_seq, doc_id, url, title, (SELECT count(*) FROM uhits) AS total_articles FROM uhits""")
def q_nested_report(spark, sf):
    return I.run_report(I.dedupe_url_first(MD.search_hits(spark, sf)))


# ----------------------------------------------------------------------------------------
# Data-quality audit
# ----------------------------------------------------------------------------------------

from .operators import quality as QA  # noqa: E402

# Fixed parameters: the source domain of the adapted corpus (languages stand in for the
# reference's countries), type domain and the column limits of the schema.
SOURCE_DOMAIN = ("en", "de", "fr", "es")
TYPE_DOMAIN = ("text", "image", "video")
SENTIMENT_DOMAIN = ("positive", "neutral", "negative")
RATE_COLUMNS = ("confidence", "positive_rate", "negative_rate", "neutral_rate")
TPCH_FKS = (("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"),
            ("lineitem", "l_partkey", "part", "p_partkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
            ("customer", "c_nationkey", "nation", "n_nationkey"), ("supplier", "s_nationkey", "nation", "n_nationkey"),
            ("nation", "n_regionkey", "region", "r_regionkey"))


def _audit(spark, sf):
    c = S.corpus(spark, sf)
    sa = MD.sentiment_table(spark, sf)
    kw = MD.keywords(spark, sf)
    parts = [
        QA.row_checks(c, "corpus", "id", [
            ("title not null", F.col("title").isNull()), ("title length <= 500", F.length("title") > 500),
            ("source in domain", ~F.col("source").isin(list(SOURCE_DOMAIN))), ("type in domain", ~F.col("type").isin(list(TYPE_DOMAIN))),
            ("media_name length <= 200", F.length("media_name") > 200)]),
        QA.unique(c, "corpus", ["id"]),
        QA.row_checks(sa, "sentiment_analysis", "id", [
            ("sentiment in domain", ~F.col("sentiment").isin(list(SENTIMENT_DOMAIN))),
            *[(f"{r} in [0, 100]", QA.outside(r, 0, 100)) for r in RATE_COLUMNS],
            ("sentiment_score in [-1, 1]", QA.outside("sentiment_score", -1, 1))]),
        QA.foreign_key(sa, "sentiment_analysis", "corpus_id", c, "id", "corpus"),
        QA.row_checks(kw, "keywords", "corpus_id", [
            ("keyword not null", F.col("keyword").isNull()), ("keyword length <= 100", F.length("keyword") > 100),
            ("weight in [0, 999.99]", QA.outside("weight", 0, 999.99))]),
        QA.row_checks(MD.hot_keywords(spark, sf), "hot_keywords", "keyword", [
            ("count not null", F.col("count").isNull()), ("heat_score in [0, 999.99]", QA.outside("heat_score", 0, 999.99)),
            ("count in INT range", QA.outside("count", -2147483648, 2147483647))]),
        QA.unique(G.source_statistics(c, sa, MD.STAT_DATE), "statistics", ["stat_date", "source"]),
        QA.unique(G.media_activity(c), "media_activity", ["media_name", "stat_month"]),
    ]
    for child, fk, parent, pk in TPCH_FKS:
        parts.append(QA.foreign_key(S.read_table(spark, sf, child), child, fk, S.read_table(spark, sf, parent), pk, parent))
    return QA.union_all(parts)


def _audit_sql() -> str:
    parts = [
        "SELECT 'corpus' AS table_name, 'title not null' AS rule, CAST(id AS VARCHAR) AS key FROM corpus WHERE title IS NULL",
        "SELECT 'corpus', 'title length <= 500', CAST(id AS VARCHAR) FROM corpus WHERE length(title) > 500",
        f"SELECT 'corpus', 'source in domain', CAST(id AS VARCHAR) FROM corpus WHERE source IS NOT NULL AND source NOT IN {SOURCE_DOMAIN}",
        f"SELECT 'corpus', 'type in domain', CAST(id AS VARCHAR) FROM corpus WHERE type IS NOT NULL AND type NOT IN {TYPE_DOMAIN}",
        "SELECT 'corpus', 'media_name length <= 200', CAST(id AS VARCHAR) FROM corpus WHERE length(media_name) > 200",
        "SELECT 'corpus', 'unique(id)', CAST(id AS VARCHAR) FROM corpus GROUP BY id HAVING count(*) > 1",
        "SELECT 'sentiment_analysis', 'corpus_id references corpus.id', CAST(corpus_id AS VARCHAR) FROM sentiment_analysis "
        "WHERE corpus_id IS NOT NULL AND corpus_id NOT IN (SELECT id FROM corpus)",
        f"SELECT 'sentiment_analysis', 'sentiment in domain', CAST(id AS VARCHAR) FROM sentiment_analysis "
        f"WHERE sentiment IS NOT NULL AND sentiment NOT IN {SENTIMENT_DOMAIN}",
        *[f"SELECT 'sentiment_analysis', '{r} in [0, 100]', CAST(id AS VARCHAR) FROM sentiment_analysis WHERE {r} < 0 OR {r} > 100"
          for r in RATE_COLUMNS],
        "SELECT 'sentiment_analysis', 'sentiment_score in [-1, 1]', CAST(id AS VARCHAR) FROM sentiment_analysis "
        "WHERE sentiment_score < -1 OR sentiment_score > 1",
        "SELECT 'keywords', 'keyword not null', CAST(corpus.id AS VARCHAR) FROM corpus, hk WHERE keyword IS NULL",
        "SELECT 'keywords', 'keyword length <= 100', CAST(corpus.id AS VARCHAR) FROM corpus, hk WHERE length(keyword) > 100",
        "SELECT 'hot_keywords', 'count not null', keyword FROM hk WHERE count IS NULL",
        "SELECT 'hot_keywords', 'heat_score in [0, 999.99]', keyword FROM hk WHERE heat_score < 0 OR heat_score > 999.99",
        "SELECT 'hot_keywords', 'count in INT range', keyword FROM hk WHERE abs(CAST(count AS HUGEINT)) > 2147483647",
        "SELECT 'media_activity', 'unique(media_name, stat_month)', media_name || '|' || m FROM (SELECT DISTINCT media_name, "
        "strftime(publish_date, '%Y-%m') AS m FROM corpus) GROUP BY media_name, m HAVING count(*) > 1",
        "SELECT 'statistics', 'unique(stat_date, source)', '2024-12-31|' || source FROM "
        "(SELECT source FROM corpus LEFT JOIN sentiment_analysis sa ON corpus.id = sa.corpus_id GROUP BY source) "
        "GROUP BY source HAVING count(*) > 1",
    ]
    for child, fk, parent, pk in TPCH_FKS:
        parts.append(f"SELECT '{child}', '{fk} references {parent}.{pk}', CAST({fk} AS VARCHAR) FROM {child} "
                     f"WHERE {fk} IS NOT NULL AND {fk} NOT IN (SELECT {pk} FROM {parent})")
    hot = f"hk AS (WITH {D.HOT_CTE} SELECT keyword, count, heat_score FROM hot_keywords)"
    return f"WITH {D.CORPUS_CTE}, {D.SENT_CTE}, {hot}\n" + "\nUNION ALL ".join(parts)


@register("audit_constraints", _audit_sql())
def q_audit_constraints(spark, sf):
    return _audit(spark, sf)


@register("cascade_delete", f"""
WITH {D.SENT_CTE}
SELECT id, corpus_id, sentiment, sentiment_score FROM sentiment_analysis
WHERE corpus_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""")
def q_cascade_delete(spark, sf):
    deleted = S.read_table(spark, sf, "labels").where(F.col("toxic") == 1).select(F.col("doc_id").alias("id"))
    return QA.cascade_delete(MD.sentiment_table(spark, sf), deleted).select("id", "corpus_id", "sentiment",
                                                                            "sentiment_score")


@register("source_statistics_incremental", f"""
WITH {D.CORPUS_CTE}, {D.SENT_CTE}, gone AS (SELECT doc_id FROM labels WHERE toxic = 1),
j AS (SELECT c.source, c.type, sa.sentiment, sa.sentiment_score FROM corpus c
      LEFT JOIN sentiment_analysis sa ON c.id = sa.corpus_id WHERE c.id NOT IN (SELECT doc_id FROM gone))
SELECT DATE '{MD.STAT_DATE}' AS stat_date, source, count(*) AS total_count,
       count(*) FILTER (WHERE type = 'text') AS text_count, count(*) FILTER (WHERE type = 'image') AS image_count,
       count(*) FILTER (WHERE type = 'video') AS video_count,
       count(*) FILTER (WHERE sentiment = 'positive') AS positive_count,
       count(*) FILTER (WHERE sentiment = 'neutral') AS neutral_count,
       count(*) FILTER (WHERE sentiment = 'negative') AS negative_count,
       {D.avg6_to2('sentiment_score')} AS avg_sentiment
FROM j GROUP BY source""")
def q_source_statistics_incremental(spark, sf):
    """G1 from the state of three loads (one run twice) and a deletion."""
    import uuid

    from .operators import stats_state as ST
    from .plans.scratch import materialise, shared_folder
    path = f"{shared_folder(spark)}/opinio/statistics-{uuid.uuid4().hex}"
    corpus, sentiment = S.corpus(spark, sf), materialise(MD.sentiment_table(spark, sf), "sentiment")
    for load in (0, 1, 2, 1):
        ST.add_load(corpus.where(F.col("id") % 3 == load), sentiment.where(F.col("corpus_id") % 3 == load), path, f"load {load}")
    deleted = S.read_table(spark, sf, "labels").where(F.col("toxic") == 1).select(F.col("doc_id").alias("id"))
    ST.subtract(corpus, sentiment, deleted, path, "toxic")
    return ST.source_statistics(ST.state(spark, path), MD.STAT_DATE)


@register("cascade_delete_keywords", f"""
WITH {D.KEYWORDS_CTE}
SELECT corpus_id, keyword FROM keywords
WHERE corpus_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""")
def q_cascade_delete_keywords(spark, sf):
    deleted = S.read_table(spark, sf, "labels").where(F.col("toxic") == 1).select(F.col("doc_id").alias("id"))
    return QA.cascade_delete(MD.keywords(spark, sf), deleted).select("corpus_id", "keyword")


@register("apply_defaults", f"""
WITH {D.SHEET_CTE}
SELECT keyword, 'all' AS source, coalesce(count, 1) AS count, {D.heat_score('freq', 'count')} AS heat_score FROM sheet""")
def q_apply_defaults(spark, sf):
    t = K.typed_sheet(MD.sheet(spark, sf)).select("keyword", F.lit(None).cast("string").alias("source"), "count",
                                                  "heat_score")
    return QA.apply_defaults(t, {"source": K.DEFAULT_HOT_SOURCE, "count": 1})


@register("corpus_ids", "SELECT doc_id AS id FROM documents")
def q_corpus_ids(spark, sf):
    return S.corpus_ids(spark, sf)


@register("profile_table", """
SELECT 'doc_id' AS column_name, 'bigint' AS data_type, count(*) AS n_rows, count(*) FILTER (WHERE doc_id IS NULL) AS n_nulls, count(DISTINCT doc_id) AS n_distinct FROM documents
UNION ALL SELECT 'text', 'string', count(*), count(*) FILTER (WHERE text IS NULL), count(DISTINCT text) FROM documents
UNION ALL SELECT 'lang', 'string', count(*), count(*) FILTER (WHERE lang IS NULL), count(DISTINCT lang) FROM documents
UNION ALL SELECT 'source', 'string', count(*), count(*) FILTER (WHERE source IS NULL), count(DISTINCT source) FROM documents
UNION ALL SELECT 'n_chars', 'bigint', count(*), count(*) FILTER (WHERE n_chars IS NULL), count(DISTINCT n_chars) FROM documents""")
def q_profile_table(spark, sf):
    return QA.profile(S.read_table(spark, sf, "documents"))


# ----------------------------------------------------------------------------------------
# Scorer context rules (V2)
# ----------------------------------------------------------------------------------------

@register("lexicon_score_context", "WITH " + D.context_scores_sql())
def q_lexicon_score_context(spark, sf):
    return V.lexicon_scores_context(S.bodies(spark, sf), MD.lexicon(spark))


# ----------------------------------------------------------------------------------------
# Emotion rates (V10) and n-gram search
# ----------------------------------------------------------------------------------------

# Fixed fixture: an emotion lexicon over tokens that occur in the driver prose.
EMOTION_LEXICON = (("ing", "joy"), ("que", "joy"), ("ou", "trust"), ("und", "trust"),
                   ("thth", "fear"), ("der", "fear"), ("tion", "surprise"), ("los", "surprise"))


def _emotion_sql() -> str:
    vals = ", ".join(f"('{t}', '{e}')" for t, e in EMOTION_LEXICON)
    pct = lambda c: (f"CASE WHEN n_tokens > 0 THEN CAST(CAST(({c} * 20000 + n_tokens) // (n_tokens * 2) AS DOUBLE) / 100 "
                     f"AS DECIMAL(5,2)) ELSE CAST(0 AS DECIMAL(5,2)) END")
    cols = ", ".join(f"{pct('_' + e)} AS emotion_{e}" for e in V.EMOTIONS)
    cnts = ", ".join(f"count(*) FILTER (WHERE emotion = '{e}') AS _{e}" for e in V.EMOTIONS)
    return f"""WITH {D.BODY_CTE},
tk AS (SELECT doc_id, {D.tokens('body')} AS t FROM body),
toks AS (SELECT doc_id, unnest(CASE WHEN len(t) = 0 THEN [NULL::VARCHAR] ELSE t END) AS token FROM tk),
emo AS (SELECT * FROM (VALUES {vals}) AS e(token, emotion)),
g AS (SELECT doc_id, count(toks.token) AS n_tokens, {cnts} FROM toks LEFT JOIN emo USING (token) GROUP BY doc_id)
SELECT doc_id, n_tokens, {cols} FROM g"""


@register("emotion_rates", _emotion_sql())
def q_emotion_rates(spark, sf):
    lex = spark.createDataFrame(list(EMOTION_LEXICON), "token string, emotion string")
    return V.emotion_rates(S.bodies(spark, sf), lex)


def _ngram_sql() -> str:
    grams = ("list_distinct(list_filter(list_transform(range(1, greatest(length(lower(phrase)) - 1, 1) + 1), "
             "lambda i: substr(lower(phrase), i, 2)), lambda g: length(g) = 2 AND NOT regexp_matches(g, '\\s')))")
    return f"""WITH {D.search_ctes()},
pg AS (SELECT phrase_seq, {grams} AS grams FROM ph),
j AS (SELECT p.phrase_seq, d.doc_id, len(list_filter(p.grams, lambda g: instr(lower(d.title || ' ' || d.text), g) > 0)) AS shared,
             len(p.grams) AS n_grams FROM sd d, pg p WHERE len(p.grams) > 0)
SELECT phrase_seq, doc_id, CAST(shared AS INTEGER) AS shared, CAST(n_grams AS INTEGER) AS n_grams FROM j WHERE shared > 0"""


@register("ngram_search", _ngram_sql())
def q_ngram_search(spark, sf):
    from .operators import search as SR
    return SR.ngram_search(MD.searchable(spark, sf), I.phrases_df(spark, MD.SEARCH_PHRASES))


# ----------------------------------------------------------------------------------------
# Corpus load (K1 + F8 + F12) from article files (rendered from the documents)
# ----------------------------------------------------------------------------------------

from .sinks import tables as SK  # noqa: E402
from .functions import urls as UR  # noqa: E402

# The constants the reference's loader writes for every article.
LOAD_SOURCE, LOAD_MEDIA = "uk", "BBC"


@register("load_corpus", f"""
WITH {D.RENDERED_CTE}
SELECT doc_id AS id, replace(file_name, '.txt', '') AS title, {D.ustrip('article')} AS content,
       '{LOAD_SOURCE}' AS source, '{LOAD_MEDIA}' AS media_name, 'text' AS type, file_name AS file_path,
       {D.publish_date(D.ustrip('article'))} AS publish_date
FROM rendered""")
def q_load_corpus(spark, sf):
    r = MD.rendered(spark, sf)
    scanned = r.select("doc_id", F.col("file_name").alias("file_path"), UR.loader_title(F.col("file_name")).alias("title"),
                       TX.ustrip(F.col("article")).alias("content"), F.lit("text").alias("type"))
    return SK.to_corpus(scanned, LOAD_SOURCE, LOAD_MEDIA, id_col="doc_id")


@register("load_corpus_stored", ORACLE["load_corpus"])
def q_load_corpus_stored(spark, sf):
    """K1 against a stored table: half of the articles, then all of them twice; each is stored once."""
    import uuid

    from .plans.scratch import shared_folder
    from .sinks import merge as MG
    path = f"{shared_folder(spark)}/opinio/corpus-{uuid.uuid4().hex}"
    rows = q_load_corpus(spark, sf)
    for load, part in (("half", rows.where("id % 2 = 0")), ("all", rows), ("all again", rows)):
        MG.merge_into(part, path, ["id"], load, update=False)
    return MG.read_stored(spark, path, rows.schema)


@register("load_sentiment_matched", f"""
WITH {D.REPORT_CTE}, {D.ARTICLES_CTE}, {D.BEST_CTE},
b AS (SELECT best.a_id, CASE WHEN p = 0 THEN 'exact' ELSE 'fuzzy' END AS how, d.score FROM best JOIN dedup d ON best.r_seq = d.seq)
SELECT a_id AS corpus_id, {D.label_loaded('score')} AS sentiment, CAST(score AS DECIMAL(3,2)) AS sentiment_score,
       {D.rates_sql('score')}, how FROM b""")
def q_load_sentiment_matched(spark, sf):
    return M.sentiment_from_matches(M.match_best(MD.articles(spark, sf), MD.report_dedup(spark, sf)))
