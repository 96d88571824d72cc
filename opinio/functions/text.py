"""Column builders for article text: body extraction, tokens, dates, previews.

Every builder returns a native Catalyst expression (no Python UDF), so the work stays
inside whole-stage codegen. Regular expressions are written so that Java (Spark) and RE2
(the DuckDB oracle) read them the same way: explicit character classes, ``\\z`` for the
end of input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------
# Fixed values. These must equal the reference's for identical results.
# ---------------------------------------------------------------------------------------

# Stop words removed before plural stripping (178 entries, reference order).
STOP_WORDS = (
    "a", "an", "the", "and", "or", "but", "is", "are", "was", "were", "be", "been", "being", "in", "on", "at",
    "to", "for", "with", "by", "about", "against", "between", "into", "through", "during", "before", "after",
    "above", "below", "from", "up", "down", "of", "off", "over", "under", "again", "further", "then", "once",
    "here", "there", "when", "where", "why", "how", "all", "any", "both", "each", "few", "more", "most",
    "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too", "very", "can",
    "will", "just", "should", "now", "that", "this", "it", "its", "has", "have", "had", "would", "could",
    "says", "said", "which", "they", "their", "them", "these", "those", "who", "what", "whom", "whose", "may",
    "might", "must", "shall", "since", "does", "did", "done", "doing", "do", "you", "your", "our", "we", "he",
    "she", "him", "her", "his", "hers", "my", "me", "mine", "am", "im", "also", "as", "if", "because",
    "while", "until", "unless", "although", "though", "despite", "however", "nevertheless", "nonetheless",
    "therefore", "thus", "hence", "consequently", "accordingly", "rather", "instead", "moreover",
    "furthermore", "additionally", "besides", "likewise", "similarly", "get", "got", "getting", "make",
    "made", "making", "take", "took", "taking", "say", "saying", "go", "going", "went", "come", "coming",
    "came", "year", "day", "time", "way", "use", "used", "using", "one", "two", "three", "four", "five",
    "six", "seven", "eight", "nine", "ten",
)

# Article file layout markers.
TITLE_MARKER = "标题: "
URL_MARKER = "网址: "
BODY_MARKER = "正文内容:"
IMAGE_LIST_MARKER = "图片列表:"
VIDEO_LIST_MARKER = "视频列表:"
NO_CAPTION = "无说明"
# Fallback body end markers, tried in this order (first listed wins, not first in text).
END_MARKERS = ("What are these?", "Most Popular Now", "These are links to other BBC pages")
# Publish date used when no valid ISO date is found in the first 500 characters.
DEFAULT_PUBLISH_DATE = "2024-01-01"
DATE_SEARCH_CHARS = 500

# ---------------------------------------------------------------------------------------
# Character classes shared with the oracle SQL.
# ---------------------------------------------------------------------------------------

# Exactly the characters Python's str.split()/str.strip() treat as whitespace.
WS = ("[\\t\\n\\x0B\\f\\r\\x1C-\\x20\\x85\\xA0\\x{1680}\\x{2000}-\\x{200A}"
      "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]")
NOT_WS = "[^" + WS[1:]
# The same characters for Java alone (RE2 has no ``&&``): one look at a bit set and one range rule out
# nearly every other character, where the class above tries its ranges one by one.
WS_JAVA = "[\\t\\n\\x0B\\f\\r\\x1C\\x1D\\x1E\\x1F\\x20\\x85\\xA0\\x{1680}-\\x{3000}&&" + WS + "]"
# The 32 ASCII punctuation characters (string.punctuation).
PUNCT = "[!-/:-@\\[-`{-~]"
DIGITS_ONLY = "^\\p{Nd}+\\z"


# The same whitespace as literal characters (for btrim, which only looks at the ends).
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
            + "\u2028\u2029\u202f\u205f\u3000")


def ustrip(c: Column) -> Column:
    """``str.strip()``: remove leading and trailing Unicode whitespace (work at the ends only)."""
    return F.btrim(c, F.lit(WS_CHARS))


def word_count_ws(c: Column) -> Column:
    """``len(text.split())``: the pieces between white space."""
    return F.when(c.isNotNull(), F.size(F.array_remove(F.split(c, WS_JAVA + "+"), "")))


def tokens(c: Column) -> Column:
    """Lower-case, delete ASCII punctuation, split on whitespace, drop 1-char and all-digit words."""
    parts = F.split(F.regexp_replace(F.lower(c), PUNCT, ""), WS_JAVA + "+")
    lettered = lambda x: (x >= "a") & (x < "{")  # noqa: E731  (a first letter a-z: no need to ask whether all are digits)
    return F.filter(parts, lambda x: (F.length(x) > 1) & (lettered(x) | ~x.rlike(DIGITS_ONLY)))


def singular(w: Column) -> Column:
    """A word ending in 's' and longer than 3 characters loses its last character."""
    return F.when(w.endswith("s") & (F.length(w) > 3), w.substr(F.lit(1), F.length(w) - 1)).otherwise(w)


def is_stop_word(w: Column, stop_words=STOP_WORDS) -> Column:
    """W2 membership test; with more than ten literals Catalyst turns it into a hash set (InSet)."""
    return w.isin(list(stop_words))


# --------------------------------- body extraction ------------------------------------

BODY_STRICT_PATTERN = "(?s)" + BODY_MARKER + "\n(.*?)(?:\n\n" + IMAGE_LIST_MARKER + "|\\z)"
BODY_LOOSE_PATTERN = "(?s)" + BODY_MARKER + "(.*?)(?:" + IMAGE_LIST_MARKER + "|\\z)"


def body_strict(content: Column) -> Column:
    """F1 + F2: body after the marker line up to the image list, else the fallback rule."""
    return F.when(F.instr(content, BODY_MARKER + "\n") > 0,
                  ustrip(F.regexp_extract(content, BODY_STRICT_PATTERN, 1))).otherwise(body_fallback(content))


def body_fallback(content: Column) -> Column:
    """drop two lines; cut at the first listed end marker found after position 0."""
    rest = F.regexp_extract(content, "^[^\n]*\n[^\n]*\n((?s:.*))", 1)
    out = None
    for m in END_MARKERS:
        pos = F.instr(rest, m)
        cut = rest.substr(F.lit(1), pos - 1)
        out = F.when(pos > 1, cut) if out is None else out.when(pos > 1, cut)
    out = out.otherwise(rest)
    return F.when(content.rlike("^[^\n]*\n[^\n]*\n"), ustrip(out)).otherwise(F.lit(""))


def body_loose(content: Column) -> Column:
    """F3 / F4 pattern: marker then anything up to the image-list marker or the end (stripped)."""
    return ustrip(F.regexp_extract(content, BODY_LOOSE_PATTERN, 1))


def has_body_marker(content: Column) -> Column:
    return F.instr(content, BODY_MARKER) > 0


def header_title(content: Column, file_name: Column) -> Column:
    """text after the title marker up to the line end; the file name if there is no header."""
    return F.when(F.instr(content, TITLE_MARKER) > 0,
                  F.regexp_extract(content, TITLE_MARKER + "([^\n]*)", 1)).otherwise(file_name)


def publish_date(content: Column, default: str = DEFAULT_PUBLISH_DATE) -> Column:
    """F8: first ``YYYY-M-D`` in the first 500 characters if it is a valid date, else the default."""
    head = F.substring(content, 1, DATE_SEARCH_CHARS)
    pat = "([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})"
    y, m, d = (F.regexp_extract(head, pat, i) for i in (1, 2, 3))
    parsed = F.when((y != "") & (y.cast("int") >= 1), F.concat_ws("-", y, m, d).try_cast("date"))
    return F.coalesce(parsed, F.lit(default).cast("date"))


def preview(c: Column, n: int = 100, suffix: str = "...") -> Column:
    """first ``n`` characters plus an ellipsis."""
    return F.concat(F.substring(c, 1, n), F.lit(suffix))
