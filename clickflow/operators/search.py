"""Document search page (F6, T3): token match plus an exact-match filter,
ranked, paged and highlighted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.functions.text import has_token, highlight, token_hits

PAGE_SIZE = 20


def element_match(array_col: str, field: str, value: str) -> Column:
    """F6 inside an array of structs: some element's ``field`` equals ``value``."""
    return F.exists(array_col, lambda x: x[field] == value)


def doc_search(docs: DataFrame, token: str, exact: dict[str, str] | None = None,
               size: int = PAGE_SIZE, offset: int = 0, order_by: list[Column] | None = None,
               where: Column | None = None) -> DataFrame:
    """Documents whose text contains ``token`` as a word and whose columns
    equal ``exact`` (and that meet ``where``, e.g. an ``element_match``), one
    page, ordered by ``order_by`` (default: longest first, then doc_id).

    Output: doc_id, lang, n_chars, hits, highlight. The order + limit plans
    as a TakeOrderedAndProject (a per-task top-N merged once), and the
    highlight is computed only for the rows of the page.
    """
    d = docs
    for col, val in (exact or {}).items():
        d = d.where(F.col(col) == val)
    if where is not None:
        d = d.where(where)
    # cheapest test first: a whole-text substring check, then tokenising
    # only the texts that can hold the token (filters run in this order)
    d = d.where(F.instr(F.lower("text"), token.lower()) > 0).where(has_token("text", token))
    page = (d.select("doc_id", "lang", "n_chars", "text")
            .orderBy(*(order_by or [F.desc("n_chars"), F.asc("doc_id")])).limit(offset + size))
    if offset:
        page = page.offset(offset)
    return page.select("doc_id", "lang", "n_chars",
                       token_hits("text", token).alias("hits"),
                       highlight("text", token).alias("highlight"))
