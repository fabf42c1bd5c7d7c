"""Listing text cleaning as column expressions.

All are built-in expressions (JVM side, inside whole-stage codegen); text
that does not parse as a number gives 0 where the reference defaults to 0 and
null where the reference would fail.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: markers and patterns the crawler's text uses, as in the reference
COMMENT_PREFIX, COMMENT_SUFFIX = "共", "条评论"        # "共N条评论"
SCORE_SUFFIX = "分"                                  # "N分"
PRICE_PREFIX, PRICE_SUFFIX = "¥", "起"                # "¥N起"
NEAR = "近"                                          # "近<landmark>"
ADDRESS_SEP = " · "
CITY = "市"
PROVINCE = "省"
RANK_TAGS = ("5A", "4A", "3A", "2A", "1A")           # checked in this order
REVIEW_SUFFIX = "条点评"                              # "N条点评"
SCORE_OF_FIVE = "/5分"                                # "N/5分"
ADDRESS_CUTS = ("(", " ", "（", ",", "、")            # cut at the first of each, in order
PUNCTUATION = "[\n`~!@#$%^&*()+=|{}':;',\\[\\].<>/?~！@#￥%……&*（）——+|{}【】‘；\r\t：”“’。， 、？]"
BLANKS_BEFORE = ("\u2003", " ")                       # em space, space
BLANKS_AFTER = ("\u00a0", '"', "\n", "\r", "\t")      # no-break space, quote, controls
BETWEEN_START, BETWEEN_END = "单程", "分"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trimmed(c: Column) -> Column:
    """Without control characters and spaces at both ends (all up to U+0020)."""
    return F.btrim(c, F.lit("".join(map(chr, range(33)))))


def _replace(c: Column, search: str, repl: str = "") -> Column:
    return F.replace(c, F.lit(search), F.lit(repl))


def _num(c: Column, t: str) -> Column:
    return trimmed(c).try_cast(t)


def hotel_comment_count(comment) -> Column:
    """"共N条评论" -> N, otherwise 0."""
    c = trimmed(_c(comment))
    n = _num(_replace(_replace(c, COMMENT_PREFIX), COMMENT_SUFFIX), "int")
    return F.when(c.contains(COMMENT_PREFIX) & c.contains(COMMENT_SUFFIX), n).otherwise(F.lit(0))


def hotel_score(score) -> Column:
    """"N分" or "N" -> N; null or empty -> 0."""
    s = _c(score)
    return (F.when(s.isNull() | (F.length(s) == 0), F.lit(0.0))
             .when(s.contains(SCORE_SUFFIX), _num(_replace(s, SCORE_SUFFIX), "double"))
             .otherwise(_num(s, "double")))


def price(text) -> Column:
    """F16: "¥N起" -> N; anything else 0."""
    p = _c(text)
    n = _num(_replace(_replace(p, PRICE_SUFFIX), PRICE_PREFIX), "double")
    return (F.when(p.isNull() | (F.length(p) == 0), F.lit(0.0))
             .when(p.contains(PRICE_SUFFIX) & p.contains(PRICE_PREFIX), n)
             .otherwise(F.lit(0.0)))


def hotel_address(city, address) -> Column:
    """drop quotes and control characters, keep the part before " · ",
    drop a leading "近", prefix the city when the address lacks it."""
    a = _c(address)
    for ch in ("'", '"', "\r", "\t", "\n"):
        a = _replace(a, ch)
    a = F.when(a.contains(ADDRESS_SEP), trimmed(F.substring_index(a, ADDRESS_SEP, 1))).otherwise(a)
    a = F.when(a.startswith(NEAR), trimmed(F.substr(a, F.lit(2)))).otherwise(a)
    cty = _c(city)
    return F.when(a.contains(cty), a).otherwise(F.concat(cty, a))


def rank_class(name) -> Column:
    """the first tag found of 5A..1A -> '5'..'1', otherwise '0'."""
    n = _c(name)
    out = F.lit("0")
    for tag in reversed(RANK_TAGS):
        out = F.when(n.contains(tag), F.lit(tag[0])).otherwise(out)
    return out


def name_without_rank(name) -> Column:
    """the name with every occurrence of its first matching tag removed."""
    n = _c(name)
    out = n
    for tag in reversed(RANK_TAGS):
        out = F.when(n.contains(tag), _replace(n, tag)).otherwise(out)
    return out


def review_count(text) -> Column:
    """"N条点评" -> N, otherwise 0."""
    t = _c(text)
    return F.when(t.contains(REVIEW_SUFFIX), _num(_replace(t, REVIEW_SUFFIX), "int")).otherwise(F.lit(0))


def review_score(text) -> Column:
    """"N/5分" -> N, otherwise 0."""
    t = _c(text)
    return F.when(t.contains(SCORE_OF_FIVE), _num(_replace(t, SCORE_OF_FIVE), "double")).otherwise(F.lit(0.0))


def sight_address(city, address) -> Column:
    """cut at the first "(", " ", "（", ",", "、" (in that order), then
    add the city: "市..." -> city+"市"+a; contains "市" -> a; ends with "省" ->
    a+city+"市"; else city+"市"+a.  Spaces removed."""
    a = _c(address)
    for cut in ADDRESS_CUTS:
        a = F.substring_index(a, cut, 1)
    cty = _c(city)
    out = (F.when(a.startswith(CITY), F.concat(cty, F.lit(CITY), a))
            .when(a.contains(CITY), trimmed(a))
            .when(a.endswith(PROVINCE), F.concat(trimmed(a), cty, F.lit(CITY)))
            .otherwise(F.concat(cty, F.lit(CITY), a)))
    return _replace(out, " ")


def strip_punctuation(text) -> Column:
    """remove punctuation, blanks and control characters."""
    t = _c(text)
    for ch in BLANKS_BEFORE:
        t = _replace(t, ch)
    t = F.regexp_replace(t, PUNCTUATION, "")
    for ch in BLANKS_AFTER:
        t = _replace(t, ch)
    return t


def between(text, start: str = BETWEEN_START, end: str = BETWEEN_END) -> Column:
    """the text after ``start`` up to the first ``end`` of the string;
    null when that ``end`` does not follow ``start``."""
    t = _c(text)
    i, j = F.instr(t, start), F.instr(t, end)
    n = len(start)
    return F.when((i > 0) & (j >= i + n), F.substr(t, i + n, j - i - n))
