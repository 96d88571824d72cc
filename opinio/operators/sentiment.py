"""Lexicon sentiment chain: V1 (score), V3/V4 (labels), V5/F11 (rates), V6 (details),
K2 (sentiment rows for loaded articles), K7/N1/L1-L3 (ranked report), L4 (top 5 per class).

Plan shape of the score: scan → tokens → ``explode_outer`` → hash join with the lexicon
(broadcast only after a row-count check; otherwise a shuffle join that AQE may still
convert) → partial aggregate per document (one row per document per map task) → one
shuffle on ``doc_id``. No window, no sort, no Python.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sentiment as SF
from ..functions import text as T
from ..plans.joins import bounded_broadcast
from ..plans.ranking import rank_within
from ..plans.scratch import materialise


def lexicon_scores(docs: DataFrame, lexicon: DataFrame, body_col: str = "body",
                   id_col: str = "doc_id") -> DataFrame:
    """V1: ``(doc_id, n_hits, valence_sum, compound)``; documents without hits score 0."""
    lex = bounded_broadcast(lexicon.select("token", F.col("valence").cast("decimal(4,2)").alias("valence")))
    toks = docs.select(F.col(id_col).alias("doc_id"), F.explode_outer(T.tokens(F.col(body_col))).alias("token"))
    agg = (toks.join(lex, "token", "left")
           .groupBy("doc_id")
           .agg(F.count("valence").alias("n_hits"),
                F.coalesce(F.sum("valence"), F.lit(0)).cast("decimal(18,2)").alias("valence_sum")))
    return agg.withColumn("compound", SF.compound(F.col("valence_sum")))


def scored(docs: DataFrame, lexicon: DataFrame, body_col: str = "body", id_col: str = "doc_id") -> DataFrame:
    """V1 + V3 + V9: ``(doc_id, compound, score, label)``; ``score`` is the 3-decimal report value."""
    s = lexicon_scores(docs, lexicon, body_col, id_col)
    return s.select("doc_id", "compound", SF.report_score(F.col("compound")).alias("score"),
                    SF.label_scored(F.col("compound")).alias("label"))


def loaded_label(scores: DataFrame) -> DataFrame:
    """V4 on the score read back from the report."""
    return scores.select("doc_id", "score", SF.label_loaded(F.col("score")).alias("sentiment"))


def rates(scores: DataFrame) -> DataFrame:
    """V5 / F11 from the 3-decimal score."""
    return scores.select("doc_id", "score", *SF.rates(F.col("score")))


def sentiment_rows(scores: DataFrame, loaded_ids: DataFrame) -> DataFrame:
    """K2: ``sentiment_analysis`` rows for articles that were loaded (``corpus_id`` present).

    ``loaded_ids`` has one column ``corpus_id``; the semi join keeps the scores side whole
    and shuffles only ids.
    """
    s = scores.join(loaded_ids.select(F.col("corpus_id").alias("doc_id")), "doc_id", "left_semi")
    return s.select(
        F.col("doc_id").alias("id"), F.col("doc_id").alias("corpus_id"),
        SF.label_loaded(F.col("score")).alias("sentiment"),
        F.col("score").cast("decimal(3,2)").alias("sentiment_score"),
        *SF.rates(F.col("score")))


def min_words(docs: DataFrame, n: int = 10, body_col: str = "body", id_col: str = "doc_id") -> DataFrame:
    """keep articles with at least ``n`` whitespace-separated words."""
    wc = T.word_count_ws(F.col(body_col))
    return docs.select(F.col(id_col).alias("doc_id"), wc.alias("n_words"), F.col(body_col)).where(wc >= n)


def details(scores: DataFrame, names: DataFrame) -> DataFrame:
    """One row per scored article: file name, class, score (consumers sort by score)."""
    return scores.join(names, "doc_id").select("doc_id", "file_name", F.col("label").alias("sentiment"), "score")


# ------------------------------------- reports -----------------------------------------

def report_rows(scores: DataFrame, titles: DataFrame) -> DataFrame:
    """The rows of the report with their order key, scored once and written: the numbering reads
    them for its boundaries, its counts and the numbers."""
    s = scores.join(titles, "doc_id").select("doc_id", "title", "label", "compound", "score")
    key = (F.when(F.col("label") == "positive", -F.col("compound"))
           .when(F.col("label") == "negative", F.col("compound"))
           .otherwise(F.abs(F.col("compound"))))
    return materialise(s.withColumn("_key", key), "report-rows")


def report_ranks(rows: DataFrame) -> DataFrame:
    """N1 + L1-L3 over ``report_rows``: rank inside each class; positive by score desc, negative by
    score asc, neutral by |score| asc; ties by title then id (the reference leaves them open)."""
    r = rank_within(rows, ["label"], [F.col("_key").asc(), F.col("title").asc(), F.col("doc_id").asc()])
    return r.drop("_key")


def ranked_report_lines(scores: DataFrame, titles: DataFrame) -> DataFrame:
    """K7: the report as ``(section, rank, line)``; write with ``orderBy(section, rank)``.

    Section 0 holds the header and totals; sections 1-3 the class lists with a heading line
    at rank 0. Entry lines read ``"{rank}. {title} (得分: {score})"`` with three decimals.
    """
    rows = report_rows(scores, titles)
    ranks = report_ranks(rows)
    sec = F.when(F.col("label") == "positive", 1).when(F.col("label") == "negative", 2).otherwise(3)
    entries = ranks.select(sec.alias("section"), F.col("rank"),
                           F.concat(F.col("rank").cast("string"), F.lit(". "), F.col("title"),
                                    F.lit(" (得分: "), F.col("score").cast("string"), F.lit(")")).alias("line"))
    counts = class_counts_wide(rows)
    # Report headings (section, rank, text; "%d" takes a count column).
    heads = [
        (0, 1, "情感分析详细结果", None), (0, 2, "==============", None), (0, 3, "汇总统计:", None),
        (0, 4, "正向报道: %d篇", "positive"), (0, 5, "负面报道: %d篇", "negative"),
        (0, 6, "中性报道: %d篇", "neutral"), (0, 7, "总计: %d篇", "total"),
        (1, 0, "正向报道列表 (共%d篇):", "positive"), (2, 0, "负面报道列表 (共%d篇):", "negative"),
        (3, 0, "中性报道列表 (共%d篇):", "neutral"),
    ]
    structs = [F.struct(F.lit(sec).alias("section"), F.lit(rk).cast("long").alias("rank"),
                        (F.format_string(txt, F.col(c)) if c else F.lit(txt)).alias("line"))
               for sec, rk, txt, c in heads]
    header = counts.select(F.explode(F.array(*structs)).alias("h")).select("h.section", "h.rank", "h.line")
    return header.unionByName(entries)


def top_by_class(scores: DataFrame, titles: DataFrame, n: int = 5) -> DataFrame:
    """L4: the ``n`` most positive (from the positive list) and most negative articles."""
    s = scores.join(titles, "doc_id")
    pos = (s.where(F.col("label") == "positive")
           .orderBy(F.col("compound").desc(), F.col("title").asc(), F.col("doc_id").asc()).limit(n))
    neg = (s.where(F.col("label") == "negative")
           .orderBy(F.col("compound").asc(), F.col("title").asc(), F.col("doc_id").asc()).limit(n))
    return pos.unionByName(neg).select("label", "doc_id", "title", "score")


def class_counts(scores: DataFrame) -> DataFrame:
    """Count per class plus a grand-total row (label ``total``) via ``rollup``."""
    return (scores.rollup("label").agg(F.count(F.lit(1)).alias("count"))
            .select(F.coalesce(F.col("label"), F.lit("total")).alias("label"), "count"))


def class_counts_wide(scores: DataFrame) -> DataFrame:
    """One wide row of class counts and the total."""
    lab = F.col("label")
    return scores.agg(F.count_if(lab == "positive").alias("positive"),
                      F.count_if(lab == "neutral").alias("neutral"),
                      F.count_if(lab == "negative").alias("negative"),
                      F.count(F.lit(1)).alias("total"))


# ------------------------------ V2: context rules ---------------------------------------

# Fixed values of the published rule-based scorer (Hutto & Gilbert 2014): booster
# increment, damping of boosters 2 and 3 words back, negation scalar, "but" weights,
# punctuation emphasis.
BOOST_DAMPING = (Decimal("1"), Decimal("0.95"), Decimal("0.9"))
NEGATION_SCALAR = Decimal("-0.74")
BUT_BEFORE, BUT_AFTER = Decimal("0.5"), Decimal("1.5")
EXCLAIM_STEP, EXCLAIM_MAX = Decimal("0.292"), 4
QUESTION_STEP, QUESTION_MAX_STEPS, QUESTION_CAP = Decimal("0.18"), 3, Decimal("0.96")
CAPS_INCREMENT = Decimal("0.733")
# Fixture word lists for the driver prose (parameters; ordinary English words never occur).
NEGATORS = ("not", "nicht", "no", "pas", "never")
BOOSTERS = (("very", Decimal("0.293")), ("ly", Decimal("0.293")), ("ea", Decimal("-0.293")))
BUT_WORDS = ("but",)


def first_position(toks: Column, words) -> Column:
    """1-based position of the first of ``words`` in ``toks`` (0 if none)."""
    pos = F.array_position(toks, words[0])
    for w in words[1:]:
        p = F.array_position(toks, w)
        pos = F.when((pos == 0) | ((p > 0) & (p < pos)), p).otherwise(pos)
    return pos


def raw_tokens(body: Column) -> Column:
    """W1 without lower-casing: aligned with ``tokens`` position by position."""
    parts = F.split(F.regexp_replace(body, T.PUNCT, ""), T.WS + "+")
    return F.filter(parts, lambda x: (F.length(x) > 1) & ~x.rlike(T.DIGITS_ONLY))


def is_caps(w: Column) -> Column:
    """``str.isupper()``: has a cased character and no lower-case one."""
    return (w == F.upper(w)) & (w != F.lower(w))


def context_tokens(toks: Column, first_but: Column, raw: Column | None = None, cap_diff: Column | None = None,
                   negators=NEGATORS, boosters=BOOSTERS) -> Column:
    """Per token: ``struct(token, neg, boost, but, caps)`` computed in the row (array lambdas)
    — a word's context is its own document's token array, so no window shuffle is needed.
    ``toks``, ``first_but``, ``raw`` (original-case tokens) and ``cap_diff`` (the text mixes
    all-caps and other words) must be plain columns of an earlier projection."""
    bmap = F.create_map(*[x for k, v in boosters for x in (F.lit(k), F.lit(v).cast("decimal(6,3)"))])
    cdiff = F.coalesce(cap_diff, F.lit(False)) if cap_diff is not None else F.lit(False)

    def caps_at(k):
        return F.coalesce(is_caps(F.get(raw, k)), F.lit(False)) & cdiff if raw is not None else F.lit(False)

    def ctx(t, i):
        prev = [F.get(toks, i - j) for j in (1, 2, 3)]
        neg = None
        for pv in prev:
            c = F.coalesce(pv.isin(*negators), F.lit(False))
            neg = c if neg is None else (neg | c)
        boost = F.lit(Decimal("0")).cast("decimal(8,4)")
        for j, (pv, d) in enumerate(zip(prev, BOOST_DAMPING), start=1):
            b = F.try_element_at(bmap, pv)
            # an all-caps booster gains the caps increment (signed with the word's valence later)
            b = F.when(b.isNotNull() & caps_at(i - j), b + F.lit(CAPS_INCREMENT)).otherwise(b)
            boost = boost + F.coalesce(b, F.lit(Decimal("0"))) * F.lit(d)
        but = (F.when(first_but == 0, F.lit(Decimal("1"))).when(i + 1 < first_but, F.lit(BUT_BEFORE))
               .when(i + 1 > first_but, F.lit(BUT_AFTER)).otherwise(F.lit(Decimal("1"))))
        return F.struct(t.alias("token"), neg.alias("neg"), boost.cast("decimal(8,4)").alias("boost"),
                        but.cast("decimal(3,2)").alias("but"), caps_at(i).alias("caps"))

    return F.transform(toks, ctx)


def punctuation_emphasis(body: Column) -> Column:
    """'!' adds 0.292 each (at most 4); more than one '?' adds 0.18 each up to 3, else 0.96."""
    ex = F.length(body) - F.length(F.replace(body, F.lit("!"), F.lit("")))
    qm = F.length(body) - F.length(F.replace(body, F.lit("?"), F.lit("")))
    ep = F.least(ex, F.lit(EXCLAIM_MAX)) * F.lit(EXCLAIM_STEP)
    qp = (F.when(qm <= 1, F.lit(Decimal("0"))).when(qm <= QUESTION_MAX_STEPS, qm * F.lit(QUESTION_STEP))
          .otherwise(F.lit(QUESTION_CAP)))
    return (ep + qp).cast("decimal(8,4)")


def lexicon_scores_context(docs: DataFrame, lexicon: DataFrame, body_col: str = "body",
                           id_col: str = "doc_id") -> DataFrame:
    """V2: V1 with all-caps emphasis, negation (3 words back), damped boosters, "but" weights
    and punctuation emphasis; exact decimal arithmetic, one conversion to double at the end."""
    lex = bounded_broadcast(lexicon.select("token", F.col("valence").cast("decimal(4,2)").alias("valence")))
    body = F.col(body_col)
    pre = docs.select(F.col(id_col).alias("doc_id"), punctuation_emphasis(body).alias("emph"),
                      T.tokens(body).alias("toks"), raw_tokens(body).alias("raw"))
    n_caps = F.size(F.filter("raw", is_caps))
    pre = pre.select("*", first_position(F.col("toks"), BUT_WORDS).alias("first_but"),
                     ((n_caps > 0) & (n_caps < F.size("raw"))).alias("cap_diff"))
    rows = pre.select("doc_id", "emph", F.explode_outer(
        context_tokens(F.col("toks"), F.col("first_but"), F.col("raw"), F.col("cap_diff"))).alias("c"))
    hits = rows.select("doc_id", "emph", "c.*").join(lex, "token", "left")
    v = F.col("valence")
    caps = F.when(F.col("caps"), F.lit(CAPS_INCREMENT)).otherwise(F.lit(Decimal("0")))
    signed_boost = F.when(v < 0, -(F.col("boost") + caps)).otherwise(F.col("boost") + caps)
    adj = (v + F.when(v != 0, signed_boost).otherwise(F.lit(0)))
    adj = F.when(F.col("neg"), adj * F.lit(NEGATION_SCALAR)).otherwise(adj) * F.col("but")
    agg = hits.groupBy("doc_id").agg(
        F.count("valence").alias("n_hits"),
        F.coalesce(F.sum(adj), F.lit(0)).cast("decimal(20,6)").alias("s"),
        F.max("emph").alias("emph"))
    s = F.col("s")
    total = F.when(s > 0, s + F.col("emph")).when(s < 0, s - F.col("emph")).otherwise(s).cast("decimal(20,6)")
    return agg.select("doc_id", "n_hits", total.alias("valence_sum"), SF.compound(total).alias("compound"))


# ------------------------------ V10: emotion rates --------------------------------------

EMOTIONS = ("joy", "trust", "fear", "surprise")


def emotion_rates(docs: DataFrame, emotion_lexicon: DataFrame, body_col: str = "body",
                  id_col: str = "doc_id") -> DataFrame:
    """V10 [ours]: per document, the share of tokens carrying each emotion, in percent as
    DECIMAL(5,2) (``emotion_joy`` …); rounded half-up from the exact ratio."""
    lex = bounded_broadcast(emotion_lexicon.select("token", "emotion"))
    toks = docs.select(F.col(id_col).alias("doc_id"), F.explode_outer(T.tokens(F.col(body_col))).alias("token"))
    g = toks.join(lex, "token", "left").groupBy("doc_id").agg(
        F.count("token").alias("n_tokens"),
        *[F.count_if(F.col("emotion") == e).alias(f"_{e}") for e in EMOTIONS])

    def pct(c):
        units = F.call_function("div", c * 20000 + F.col("n_tokens"), F.col("n_tokens") * 2)
        return F.when(F.col("n_tokens") > 0, (units.cast("decimal(20,0)") / 100).cast("decimal(5,2)")) \
            .otherwise(F.lit(0).cast("decimal(5,2)"))
    return g.select("doc_id", "n_tokens", *[pct(F.col(f"_{e}")).alias(f"emotion_{e}") for e in EMOTIONS])
