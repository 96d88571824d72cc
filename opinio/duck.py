"""DuckDB SQL text equivalent to the column builders, for the oracle checks.

Each helper returns an SQL expression string over its argument expression(s). They use
the same explicit character classes as ``opinio.functions.text`` so Java regex (Spark) and
RE2 (DuckDB) agree.
"""

from __future__ import annotations

from .functions import text as T


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


WS = T.WS
NOT_WS = T.NOT_WS
PUNCT = T.PUNCT


def ustrip(x: str) -> str:
    return f"trim({x}, {q(T.WS_CHARS)})"


def tokens(x: str) -> str:
    return (f"list_filter(regexp_split_to_array(regexp_replace(lower({x}), {q(PUNCT)}, '', 'g'), {q(WS + '+')}), "
            f"lambda t: length(t) > 1 AND NOT regexp_matches(t, {q(T.DIGITS_ONLY.replace(chr(92) + 'z', '$'))}))")


def stop_list() -> str:
    return "(" + ", ".join(q(w) for w in T.STOP_WORDS) + ")"


def singular(x: str) -> str:
    return f"CASE WHEN {x} LIKE '%s' AND length({x}) > 3 THEN left({x}, length({x}) - 1) ELSE {x} END"


def percent_text(count: str, total: str, decimals: int = 4) -> str:
    scale = 10 ** decimals
    units = f"((CAST({count} AS HUGEINT) * {200 * scale} + {total}) // (CAST({total} AS HUGEINT) * 2))"
    return (f"(CAST({units} // {scale} AS VARCHAR) || '.' || lpad(CAST({units} % {scale} AS VARCHAR), {decimals}, '0') || '%')")


def word_count_ws(x: str) -> str:
    return f"len(regexp_extract_all({x}, {q(NOT_WS + '+')}))"


# Adapter CTEs (documents → corpus), the same expressions as opinio.sources.tables.
CORPUS_CTE = """corpus AS (
  SELECT doc_id AS id, split_part(text, chr(10), 1) AS title, text AS content, lang AS source,
         source AS media_name,
         CASE doc_id % 3 WHEN 0 THEN 'text' WHEN 1 THEN 'image' ELSE 'video' END AS type,
         CAST(DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER) AS DATE) AS publish_date
  FROM documents)"""

BODY_CTE = f"""body AS (SELECT doc_id, {ustrip('text')} AS body FROM documents)"""

WORDS_CTE = f"""words AS (
  SELECT {singular('t')} AS word FROM (
    SELECT unnest({tokens('body')}) AS t FROM body WHERE length(body) > 0)
  WHERE t NOT IN {stop_list()})"""


def _lex_values() -> str:
    from .sources.lexicon import fixture_values_sql
    return fixture_values_sql()


def scores_cte(body_cte: str) -> str:
    """V1 + V3 + V9 over the ``body`` CTE given (doc_id, body) with the fixture lexicon."""
    return f"""{body_cte},
tk AS (SELECT doc_id, {tokens('body')} AS t FROM body),
toks AS (SELECT doc_id, unnest(CASE WHEN len(t) = 0 THEN [NULL::VARCHAR] ELSE t END) AS token FROM tk),
lex AS (SELECT * FROM {_lex_values()}),
agg AS (SELECT doc_id, count(valence) AS n_hits,
               CAST(coalesce(sum(valence), 0) AS DECIMAL(18,2)) AS valence_sum
        FROM toks LEFT JOIN lex USING (token) GROUP BY doc_id),
lscores AS (SELECT doc_id, n_hits, valence_sum,
           least(greatest(CAST(valence_sum AS DOUBLE) / sqrt(CAST(valence_sum AS DOUBLE) * CAST(valence_sum AS DOUBLE) + 15.0), -1.0), 1.0) AS compound
        FROM agg),
scores AS (SELECT doc_id, compound, CAST(compound AS DECIMAL(4,3)) AS score,
           CASE WHEN compound >= 0.05 THEN 'positive' WHEN compound <= -0.05 THEN 'negative' ELSE 'neutral' END AS label
           FROM lscores)"""


# Scores: V1 over every document body with the fixture lexicon, then V3 / V9.
SCORES_CTE = scores_cte(BODY_CTE)


def rates_sql(s: str) -> str:
    return (f"CAST(abs({s}) * 100 AS DECIMAL(5,2)) AS confidence, "
            f"CAST(greatest({s}, 0) * 100 AS DECIMAL(5,2)) AS positive_rate, "
            f"CAST(greatest(-{s}, 0) * 100 AS DECIMAL(5,2)) AS negative_rate, "
            f"CAST(100 - abs({s}) * 100 AS DECIMAL(5,2)) AS neutral_rate")


def label_loaded(s: str) -> str:
    return f"CASE WHEN {s} > 0.1 THEN 'positive' WHEN {s} < -0.1 THEN 'negative' ELSE 'neutral' END"


SENT_CTE = f"""{SCORES_CTE},
sentiment_analysis AS (
  SELECT doc_id AS id, doc_id AS corpus_id, {label_loaded('score')} AS sentiment,
         CAST(score AS DECIMAL(3,2)) AS sentiment_score, {rates_sql('score')}
  FROM scores WHERE doc_id IN (SELECT doc_id FROM labels))"""

TITLES_CTE = "titles AS (SELECT doc_id, split_part(text, chr(10), 1) AS title FROM documents)"


def _micro(x: str) -> str:
    s = f"CAST(sum({x}) * 100 AS HUGEINT)"
    n = f"count({x})"
    return f"(CASE WHEN {n} = 0 THEN NULL ELSE sign({s}) * ((abs({s}) * 20000 + {n}) // (2 * {n})) END)"


def avg6(x: str, p: int = 7) -> str:
    """Spark's ``avg`` of a DECIMAL(p-4,2): exact half-up at 6 places, DECIMAL(p,6)."""
    return f"CAST(CAST({_micro(x)} AS DOUBLE) / 1000000 AS DECIMAL({p},6))"


def avg6_to2(x: str) -> str:
    """That average stored into DECIMAL(3,2) (second half-up rounding)."""
    m = _micro(x)
    return f"CAST(CAST(sign({m}) * ((abs({m}) + 5000) // 10000) AS DOUBLE) / 100 AS DECIMAL(3,2))"


def sheet_number(x: str) -> str:
    return f"TRY_CAST(replace({x}, '%', '') AS DECIMAL(20,10))"


def heat_score(freq: str, cnt: str) -> str:
    return (f"TRY_CAST(CASE WHEN instr({freq}, '%') > 0 THEN {sheet_number(freq)} "
            f"ELSE CAST({cnt} AS DECIMAL(20,10)) END AS DECIMAL(5,2))")


def keyword_weight(freq: str, cnt: str) -> str:
    return (f"TRY_CAST(CASE WHEN instr({freq}, '%') > 0 THEN {sheet_number(freq)} * 0.01 "
            f"ELSE CAST({cnt} AS DECIMAL(20,10)) * 0.001 END AS DECIMAL(5,2))")


def top_words_cte(body_cte: str = BODY_CTE, name: str = "top", n: int = 100) -> str:
    """The top-``n`` words (rank, word, count, percent) as a CTE named ``name``."""
    return f"""{body_cte}, {WORDS_CTE},
counts AS (SELECT word, count(*) AS count FROM words GROUP BY word),
tot AS (SELECT CAST(sum(count) AS BIGINT) AS total_words FROM counts),
{name} AS (SELECT word, count, {percent_text('count', 'total_words')} AS percent
        FROM counts, tot ORDER BY count DESC, word LIMIT {n})"""


def typed_sheet_sql(top: str = "top") -> str:
    return (f"SELECT trim(word) AS keyword, TRY_CAST(trim(CAST(count AS VARCHAR)) AS INTEGER) AS count, "
            f"trim(percent) AS freq FROM {top} WHERE trim(word) NOT IN ('', 'nan')")


SHEET_CTE = f"""{top_words_cte()},
sheet AS ({typed_sheet_sql()})"""

HOT_CTE = f"""{SHEET_CTE},
hot_keywords AS (SELECT keyword, 'all' AS source, count, {heat_score('freq', 'count')} AS heat_score,
        DATE '2024-12-31' AS stat_date, TIMESTAMP '2024-12-31 00:00:00' AS create_time,
        TIMESTAMP '2024-12-31 00:00:00' AS update_time FROM sheet)"""

KEYWORDS_CTE = f"""{SHEET_CTE},
keywords AS (SELECT d.doc_id AS corpus_id, s.keyword, {keyword_weight('s.freq', 's.count')} AS weight,
        s.count AS frequency FROM documents d, sheet s)"""


def article_filename(url: str, title: str, ext: str = ".txt") -> str:
    cleaned = ustrip(f"regexp_replace({title}, {q(chr(91) + chr(92) * 2 + '/*?:\"<>|' + chr(93))}, '', 'g')")
    return (f"(CASE WHEN {title} IS NULL OR {title} = '' OR {cleaned} = '' THEN md5({url}) "
            f"ELSE substr({cleaned}, 1, 100) END || '{ext}')")


ARTICLE_URL = ("('https://news.example.org/articles/2024-' || CAST(doc_id % 12 + 1 AS VARCHAR) || '-' || "
               "CAST(doc_id % 31 + 1 AS VARCHAR) || '/' || CAST(doc_id AS VARCHAR))")

ARTICLES_CTE = f"""articles AS (
  SELECT doc_id AS a_id,
         replace({article_filename(ARTICLE_URL, 'split_part(text, chr(10), 1)')}, '.txt', '') AS a_title
  FROM documents)"""


def _report_entry_pattern() -> str:
    from .sources.reports import ENTRY_PATTERN
    return ENTRY_PATTERN


REPORT_CTE = f"""{SCORES_CTE}, {TITLES_CTE},
rl AS (SELECT CASE label WHEN 'positive' THEN 1 WHEN 'negative' THEN 2 ELSE 3 END AS section,
              row_number() OVER (PARTITION BY label ORDER BY CASE WHEN label = 'positive' THEN -compound
                   WHEN label = 'negative' THEN compound ELSE abs(compound) END, title, doc_id) AS rank,
              title, score
       FROM scores JOIN titles USING (doc_id)),
lines AS (SELECT section * 10000000000 + rank AS seq,
                 CAST(rank AS VARCHAR) || '. ' || title || ' (得分: ' || CAST(score AS VARCHAR) || ')' AS value FROM rl),
report AS (SELECT seq, {ustrip(f"regexp_extract(value, {q(_report_entry_pattern())}, 1)")} AS title,
                  TRY_CAST(regexp_extract(value, {q(_report_entry_pattern())}, 2) AS DECIMAL(4,3)) AS score
           FROM lines WHERE regexp_matches(value, {q(_report_entry_pattern())})),
dedup AS (SELECT title, arg_max(score, seq) AS score, min(seq) AS seq FROM report GROUP BY title)"""


def norm_title(x: str) -> str:
    from .operators.matching import NORM_DROP
    return f"regexp_replace(lower({x}), {q(NORM_DROP)}, '', 'g')"


def title_words(n: str) -> str:
    return f"list_distinct(list_filter(regexp_split_to_array({n}, {q(WS + '+')}), lambda x: x <> ''))"


FUZZY_CTE = f"""an AS (SELECT a_id, {norm_title('a_title')} AS n FROM articles),
rn AS (SELECT seq AS r_id, {norm_title('title')} AS n FROM dedup),
anw AS (SELECT a_id, n, {title_words('n')} AS w FROM an),
rnw AS (SELECT r_id, n, {title_words('n')} AS w FROM rn),
fuzzy AS (SELECT a_id, r_id AS r_seq FROM anw, rnw
          WHERE contains(rnw.n, anw.n) OR contains(anw.n, rnw.n) OR len(list_intersect(anw.w, rnw.w)) >= 3)"""

BEST_CTE = f"""{FUZZY_CTE},
u AS (SELECT a.a_id, d.seq AS r_seq, 0 AS prio FROM articles a JOIN dedup d ON a.a_title = d.title
      UNION ALL SELECT a_id, r_seq, 1 AS prio FROM fuzzy),
bp AS (SELECT a_id, min(prio) AS p FROM u GROUP BY a_id),
best AS (SELECT u.a_id, min(u.r_seq) AS r_seq, min(bp.p) AS p FROM u JOIN bp ON u.a_id = bp.a_id AND u.prio = bp.p
         GROUP BY u.a_id)"""


def paragraphs_of(text: str) -> str:
    return (f"list_filter(list_transform(list_slice(string_split({text}, chr(10)), 2, len(string_split({text}, chr(10)))), "
            f"lambda x: {ustrip('x')}), lambda x: x <> '')")


RENDERED_CTE = f"""rendered AS (
  SELECT doc_id, {article_filename(ARTICLE_URL, 'split_part(text, chr(10), 1)')} AS file_name, text,
         '标题: ' || coalesce(split_part(text, chr(10), 1), 'None') || chr(10) || '网址: ' || {ARTICLE_URL}
         || chr(10) || chr(10) || '正文内容:' || chr(10) || array_to_string({paragraphs_of('text')}, chr(10) || chr(10))
         AS article
  FROM documents)"""


def body_fallback(c: str) -> str:
    from .functions.text import END_MARKERS
    rest = f"regexp_extract({c}, {q('^[^' + chr(10) + ']*' + chr(10) + '[^' + chr(10) + ']*' + chr(10) + '((?s:.*))')}, 1)"
    cases = " ".join(f"WHEN instr({rest}, {q(m)}) > 1 THEN left({rest}, instr({rest}, {q(m)}) - 1)" for m in END_MARKERS)
    cut = f"CASE {cases} ELSE {rest} END"
    return (f"CASE WHEN regexp_matches({c}, {q('^[^' + chr(10) + ']*' + chr(10) + '[^' + chr(10) + ']*' + chr(10))}) "
            f"THEN {ustrip(cut)} ELSE '' END")


def body_strict(c: str) -> str:
    return (f"CASE WHEN instr({c}, '正文内容:' || chr(10)) > 0 THEN {ustrip(f'regexp_extract({c}, {q(T.BODY_STRICT_PATTERN)}, 1)')} "
            f"ELSE {body_fallback(c)} END")


def body_loose(c: str) -> str:
    return ustrip(f"regexp_extract({c}, {q(T.BODY_LOOSE_PATTERN)}, 1)")


def publish_date(c: str) -> str:
    pat = "([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})"
    head = f"substr({c}, 1, 500)"
    y, m, d = (f"regexp_extract({head}, {q(pat)}, {i})" for i in (1, 2, 3))
    return (f"coalesce(CASE WHEN {y} <> '' AND CAST({y} AS INTEGER) >= 1 THEN TRY_CAST({y} || '-' || {m} || '-' || {d} AS DATE) END, "
            f"DATE '2024-01-01')")


# ------------------------------------- pages -------------------------------------------

def _h():
    from .functions import html as H
    return H


def unescape(x: str) -> str:
    for ent, ch in _h().ENTITIES:
        x = f"replace({x}, {q(ent)}, {q(ch)})"
    return x


def text_of(x: str) -> str:
    return ustrip(unescape(f"regexp_replace({x}, '<[^>]*>', '', 'g')"))


def _cls_pat(tag: str, cls: str | None, inner: bool) -> str:
    if cls is None:
        return f"(?s)<{tag}\\b[^>]*>(.*?)</{tag}>" if inner else f"<{tag}\\b"
    base = f"<{tag}\\b[^>]*class=\"(?:[^\"]*\\s)?{cls}(?:\\s[^\"]*)?\""
    return "(?s)" + base + f"[^>]*>(.*?)</{tag}>" if inner else base


def _elem(x: str, tag: str, cls: str | None) -> str:
    return f"CASE WHEN regexp_matches({x}, {q(_cls_pat(tag, cls, False))}) THEN regexp_extract({x}, {q(_cls_pat(tag, cls, True))}, 1) END"


def page_title(x: str) -> str:
    H = _h()
    cands = []
    for tag in ("h1", "h2"):
        for cls in H.H_CLASSES + (None,):
            t = text_of(_elem(x, tag, cls))
            cands.append(f"CASE WHEN {t} <> '' AND {t} <> {q(H.SITE_NAME)} THEN {t} END")

    def meta(prop):
        a = f"regexp_extract({x}, {q(f'<meta\\b[^>]*property=\"{prop}\"[^>]*content=\"([^\"]*)\"')}, 1)"
        b = f"regexp_extract({x}, {q(f'<meta\\b[^>]*content=\"([^\"]*)\"[^>]*property=\"{prop}\"')}, 1)"
        return f"(CASE WHEN {a} <> '' THEN {a} ELSE {b} END)"
    og = ustrip(unescape(meta("og:title")))
    cands.append(f"CASE WHEN {og} <> '' AND {og} <> {q(H.SITE_NAME)} THEN {og} END")
    u = meta("og:url")
    last = ustrip(f"replace(list_extract(string_split(regexp_replace({u}, '/+$', ''), '/'), -1), '-', ' ')")
    cands.append(f"CASE WHEN {u} <> '' AND {last} <> '' THEN {last} END")
    return "coalesce(" + ", ".join(cands) + ")"


def body_container(x: str) -> str:
    H = _h()
    whens = [f"WHEN regexp_matches({x}, {q(_cls_pat('article', None, False))}) THEN regexp_extract({x}, {q(_cls_pat('article', None, True))}, 1)"]
    for cls in H.BODY_DIV_CLASSES:
        whens.append(f"WHEN regexp_matches({x}, {q(_cls_pat('div', cls, False))}) THEN regexp_extract({x}, {q(_cls_pat('div', cls, True))}, 1)")
    return "CASE " + " ".join(whens) + " END"


def paragraph_fragments(x: str) -> str:
    parts = f"regexp_split_to_array({x}, {q('<p' + chr(92) + 'b[^>]*>')})"
    return f"list_transform(list_slice({parts}, 2, len({parts})), lambda y: split_part(y, '</p>', 1))"


def paragraphs(x: str) -> str:
    H = _h()
    excl = " OR ".join(f"instr(lower({x}), {q(h)}) > 0" for h in H.EXCLUDE_PARENT_HINTS)
    ps = f"list_filter(list_transform({paragraph_fragments(x)}, lambda z: {text_of('z')}), lambda z: z <> '')"
    ps = f"(CASE WHEN {excl} THEN []::VARCHAR[] ELSE {ps} END)"
    whole = text_of(x)
    return f"(CASE WHEN len({ps}) > 0 THEN {ps} WHEN {whole} <> '' THEN [{whole}] ELSE []::VARCHAR[] END)"


def text_block_fragments(x: str) -> str:
    H = _h()
    hint = "|".join(H.TEXT_BLOCK_HINTS)
    pat = f"(?s)<div\\b[^>]*class=\"[^\"]*(?:{hint})[^\"]*\"[^>]*>(.*?)</div>"
    return f"flatten(list_transform(regexp_extract_all({x}, {q(pat)}, 1), lambda b: {paragraph_fragments('b')}))"


def pages_cte() -> str:
    H = _h()
    return f"""pc AS (SELECT page_id, url, regexp_replace(html, {q(H.NOISE)}, '', 'g') AS clean FROM pages),
pp AS (SELECT page_id, url, {page_title('clean')} AS title, {body_container('clean')} AS container,
              {text_block_fragments('clean')} AS fb FROM pc),
parsed AS (SELECT page_id, url, title,
       CASE WHEN container IS NOT NULL OR len(fb) > 0 THEN coalesce(container, array_to_string(fb, '')) END AS container,
       CASE WHEN container IS NOT NULL THEN {paragraphs('container')}
            WHEN len(fb) > 0 THEN list_filter(list_transform(fb, lambda z: {text_of('z')}), lambda z: z <> '') END AS paragraphs
       FROM pp)"""


def absolutize(u: str, base: str) -> str:
    return f"CASE WHEN starts_with({u}, '//') THEN 'https:' || {u} WHEN starts_with({u}, '/') THEN {base} || {u} ELSE {u} END"


def base_of(u: str) -> str:
    return f"regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1)"


def search_ctes() -> str:
    from .plans.model import SEARCH_PHRASES, SEARCH_RANGES
    ph = ", ".join(f"({i}, {q(p)})" for i, p in enumerate(SEARCH_PHRASES))
    rg = ", ".join(f"({i}, DATE {q(a)}, DATE {q(b)})" for i in range(len(SEARCH_PHRASES)) for a, b in SEARCH_RANGES)
    return f"""ph AS (SELECT CAST(a AS INTEGER) AS phrase_seq, b AS phrase FROM (VALUES {ph}) AS t(a, b)),
rg AS (SELECT CAST(a AS INTEGER) AS phrase_seq, b AS start_date, c AS end_date FROM (VALUES {rg}) AS t(a, b, c)),
sd AS (SELECT doc_id, {ARTICLE_URL} AS url, split_part(text, chr(10), 1) AS title, text,
              CAST(DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER) AS DATE) AS publish_date FROM documents),
hits AS (SELECT p.phrase_seq, p.phrase, d.doc_id, d.url, d.title FROM sd d JOIN ph p ON instr(lower(d.text), lower(p.phrase)) > 0),
uhits AS (SELECT url, phrase_seq, doc_id, title FROM (
          SELECT *, row_number() OVER (PARTITION BY url ORDER BY phrase_seq, doc_id) AS rn FROM hits) WHERE rn = 1)"""


def context_scores_sql() -> str:
    from .operators import sentiment as V
    negs = "(" + ", ".join(q(w) for w in V.NEGATORS) + ")"
    caps_at = lambda k: (f"(CASE WHEN {k} >= 1 THEN coalesce(raw[{k}] = upper(raw[{k}]) AND raw[{k}] <> lower(raw[{k}]), false) "
                         f"ELSE false END AND cap_diff)")
    bval = lambda x: "CASE " + " ".join(f"WHEN {x} = {q(k)} THEN CAST({v} AS DECIMAL(6,3))" for k, v in V.BOOSTERS) + " END"
    bcase = lambda x, k: (f"coalesce(CASE WHEN ({bval(x)}) IS NOT NULL AND {caps_at(k)} THEN ({bval(x)}) + {V.CAPS_INCREMENT} "
                          f"ELSE ({bval(x)}) END, CAST(0 AS DECIMAL(6,3)))")
    prev = lambda j: f"(CASE WHEN i - {j} >= 1 THEN toks[i - {j}] END)"
    neg = " OR ".join(f"coalesce({prev(j)} IN {negs}, false)" for j in (1, 2, 3))
    boost = " + ".join(f"{bcase(prev(j), f'i - {j}')} * {d}" for j, d in zip((1, 2, 3), V.BOOST_DAMPING))
    fb = " ".join(f"coalesce(list_position(toks, {q(w)}), 0)" for w in V.BUT_WORDS[:1])
    raw = (f"list_filter(regexp_split_to_array(regexp_replace(body, {q(PUNCT)}, '', 'g'), {q(WS + '+')}), "
           f"lambda t: length(t) > 1 AND NOT regexp_matches(t, {q(T.DIGITS_ONLY.replace(chr(92) + 'z', '$'))}))")
    ex = "(length(body) - length(replace(body, '!', '')))"
    qm = "(length(body) - length(replace(body, '?', '')))"
    emph = (f"CAST(least({ex}, {V.EXCLAIM_MAX}) * {V.EXCLAIM_STEP} + CASE WHEN {qm} <= 1 THEN 0 "
            f"WHEN {qm} <= {V.QUESTION_MAX_STEPS} THEN {qm} * {V.QUESTION_STEP} ELSE {V.QUESTION_CAP} END AS DECIMAL(8,4))")
    ctx = (f"list_transform(toks, lambda t, i: {{'token': t, 'neg': ({neg}), 'caps': {caps_at('i')}, "
           f"'boost': CAST({boost} AS DECIMAL(8,4)), "
           f"'but': CAST(CASE WHEN fb = 0 THEN 1 WHEN i < fb THEN {V.BUT_BEFORE} WHEN i > fb THEN {V.BUT_AFTER} ELSE 1 END AS DECIMAL(3,2))}})")
    return f"""{BODY_CTE},
pre AS (SELECT doc_id, {emph} AS emph, {tokens('body')} AS toks, {raw} AS raw FROM body),
pre2 AS (SELECT doc_id, emph, toks, raw, {fb} AS fb,
                len(list_filter(raw, lambda x: x = upper(x) AND x <> lower(x))) AS ncaps FROM pre),
pre3 AS (SELECT *, (ncaps > 0 AND ncaps < len(raw)) AS cap_diff FROM pre2),
cx AS (SELECT doc_id, emph, unnest(CASE WHEN len(toks) = 0 THEN [NULL] ELSE {ctx} END) AS c FROM pre3),
lex AS (SELECT * FROM {_lex_values()}),
hits AS (SELECT doc_id, emph, c.neg AS neg, c.boost + CASE WHEN c.caps THEN {V.CAPS_INCREMENT} ELSE 0 END AS boost,
                c.but AS but, lex.valence AS v
         FROM cx LEFT JOIN lex ON c.token = lex.token),
adj AS (SELECT doc_id, emph, v,
          (CASE WHEN neg THEN (v + CASE WHEN v <> 0 THEN CASE WHEN v < 0 THEN -boost ELSE boost END ELSE 0 END) * {V.NEGATION_SCALAR}
                ELSE (v + CASE WHEN v <> 0 THEN CASE WHEN v < 0 THEN -boost ELSE boost END ELSE 0 END) END) * but AS a
        FROM hits),
g AS (SELECT doc_id, count(v) AS n_hits, CAST(coalesce(sum(a), 0) AS DECIMAL(20,6)) AS s, max(emph) AS emph FROM adj GROUP BY doc_id),
t AS (SELECT doc_id, n_hits, CAST(CASE WHEN s > 0 THEN s + emph WHEN s < 0 THEN s - emph ELSE s END AS DECIMAL(20,6)) AS valence_sum FROM g)
SELECT doc_id, n_hits, valence_sum,
       least(greatest(CAST(valence_sum AS DOUBLE) / sqrt(CAST(valence_sum AS DOUBLE) * CAST(valence_sum AS DOUBLE) + 15.0), -1.0), 1.0) AS compound
FROM t"""
