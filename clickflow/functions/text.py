"""Text helpers: ranking report (P9), token match and highlight."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ranking report layout (header/footer rules and labels).
REPORT_RULE_TOP = "======================"
REPORT_END_LABEL = "窗口结束时间："
REPORT_ITEM_LABEL = " 商品ID = "
REPORT_ITEM_COUNT_LABEL = " 热门度 = "
REPORT_ITEM_RULE_BOTTOM = "==================="
REPORT_PAGE_LABEL = " = "
REPORT_PAGE_COUNT_LABEL = " 浏览量 = "
REPORT_PAGE_RULE_BOTTOM = "=============================="


def report_line(rank: Column, key: Column, count: Column,
                key_label: str, count_label: str) -> Column:
    """One ``NO i: <key label><key><count label><count>`` line."""
    return F.concat(F.lit("NO "), rank.cast("string"), F.lit(":"),
                    F.lit(key_label), key.cast("string"), F.lit(count_label),
                    count.cast("string"))


def tokens(text: str | Column) -> Column:
    """Lower-cased word tokens (split on non-word characters)."""
    col = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(col), r"\W+"), lambda t: t != F.lit(""))


def has_token(text: str | Column, token: str) -> Column:
    return F.array_contains(tokens(text), token.lower())


def token_hits(text: str | Column, token: str) -> Column:
    return F.size(F.filter(tokens(text), lambda t: t == F.lit(token.lower())))


def highlight(text: str | Column, token: str, pre: str = "<em>",
              post: str = "</em>") -> Column:
    """Wrap whole-word, case-insensitive matches of ``token``."""
    col = F.col(text) if isinstance(text, str) else text
    import re
    pat = r"(?i)(?<![A-Za-z0-9_])(" + re.escape(token) + r")(?![A-Za-z0-9_])"
    return F.regexp_replace(col, pat, pre + "$1" + post)
