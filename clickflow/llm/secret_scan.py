"""Secret scan over a trigram inverted index.

Each rule's regular expression gives a Boolean query of lower-cased trigrams
that every match must contain. The index holds, per trigram and block of
documents, the list of the block's documents with that trigram; lists are
intersected within blocks, so no list grows with the corpus. Only candidate
documents are verified with the expression itself. Rules without a mandatory
trigram scan every document.

An expression splits a text; the lengths of the gaps and matches leave it as
rows of numbers, and a running sum over them gives the offsets, so the work is
in proportion to a text's length and its matches.
"""

from __future__ import annotations

import re._constants as rc
import re._parser as rp
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm.sqltext import ascii_lower, let, save_shared

BLOCK_DOCS = 4096   # documents in one posting list, at most


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose group ``group`` has ``least`` characters."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1


BASE_RULES = [
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                   r"""([A-Za-z0-9+/_.=-]+)""", 2, 6),
    # a run shorter than the least length can't hold a longer one, so the
    # length is part of the expression
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
]
# Further public formats of keys.
MORE_RULES = [
    Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
]
RULES = BASE_RULES + MORE_RULES

# Strings an expression may stand for before their trigrams are taken.
MAX_STRINGS = 64

Clauses = frozenset[frozenset[str]]   # any clause, all of its trigrams
ANY: Clauses = frozenset([frozenset()])


def _all_of(a: Clauses, b: Clauses) -> Clauses:
    return _least(frozenset(x | y for x in a for y in b))


def _least(c: Clauses) -> Clauses:
    """Without clauses that ask for more than another one does."""
    return frozenset(x for x in c if not any(y < x for y in c))


def _of_strings(strings: set[str]) -> Clauses:
    return _least(frozenset(frozenset(s[i:i + 3].lower() for i in range(len(s) - 2))
                            for s in strings))


def _analyse(seq) -> tuple[set[str] | None, Clauses]:
    """(all strings the sequence stands for, or None if they are many; the
    trigrams that a match must have beyond that)."""
    strings, query, exact = {""}, ANY, True

    def settle() -> None:
        nonlocal strings, query, exact
        query = _all_of(query, _of_strings(strings))
        strings, exact = {""}, False

    def append(more: set[str]) -> None:
        nonlocal strings
        if len(strings) * len(more) > MAX_STRINGS:
            settle()
        if len(more) > MAX_STRINGS:
            settle()
        else:
            strings = {a + b for a in strings for b in more}

    for op, arg in seq:
        if op is rc.LITERAL:
            append({chr(arg)})
        elif op is rc.IN and all(o is rc.LITERAL for o, _ in arg):
            append({chr(c) for _, c in arg})
        elif op is rc.SUBPATTERN or op is rc.BRANCH:
            branches = [arg[-1]] if op is rc.SUBPATTERN else arg[1]
            found = [_analyse(b) for b in branches]
            if all(s is not None for s, _ in found):
                append(set().union(*(s for s, _ in found)))
            else:
                settle()
                query = _all_of(query, _least(frozenset().union(
                    *(q if s is None else _all_of(q, _of_strings(s)) for s, q in found))))
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT):
            low, high, body = arg
            s, q = _analyse(body)
            if s is not None and low == 0 and high == 1:
                append(s | {""})
            elif low >= 1 and s is not None:
                for _ in range(min(low, 3)):
                    append(s)
                if not low == high <= 3:
                    settle()
            else:
                settle()
                if low >= 1:
                    query = _all_of(query, q)
        elif op is not rc.AT:
            settle()
    if exact:
        return strings, query
    settle()
    return None, query


def trigram_query(pattern: str) -> Clauses | None:
    """The trigrams a match of ``pattern`` must contain, in any letter case:
    one of the clauses, all its trigrams. None: no trigram is mandatory."""
    s, q = _analyse(rp.parse(pattern))
    if s is not None:
        q = _all_of(q, _of_strings(s))
    return None if frozenset() in q or not q else q


def _key(doc_id: Column) -> Column:
    """Documents are indexed by a hash of their id (of NULL too). Documents
    that share a key become candidates together, which verification resolves."""
    return F.xxhash64(doc_id)


def trigram_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings of ``trigrams`` (lower case): trigram, block, keys (sorted
    array). Blocks are runs of at most ``BLOCK_DOCS`` rows of one input
    partition, so a frequent trigram has many lists of bounded size, and lists
    are combined before the shuffle."""
    wanted = F.array(*[F.lit(t) for t in trigrams])
    has = let(ascii_lower(F.col("text")), lambda t: F.filter(wanted, lambda g: F.contains(t, g)))
    d = docs.where(F.col("text").isNotNull()).select(
        _key(F.col("doc_id")).alias("key"),
        F.expr(f"monotonically_increasing_id() div {BLOCK_DOCS}").alias("block"),
        has.alias("has"))
    return (d.select("block", "key", F.explode("has").alias("trigram")).groupBy("trigram", "block")
            .agg(F.sort_array(F.collect_set("key")).alias("keys")))


def candidates(index: DataFrame, rules: list[Rule]) -> DataFrame:
    """key, rules (array of kinds): the documents each rule's query finds."""
    spark = index.sparkSession
    terms = [(r.kind, i, t, len(c)) for r in rules
             for i, c in enumerate(sorted(map(sorted, trigram_query(r.pattern) or ()))) for t in c]
    q = spark.createDataFrame(terms, "kind string, clause int, trigram string, need int")
    # the rules' terms: bounded by the rule list, not by data
    lists = index.join(F.broadcast(q), "trigram").groupBy("kind", "clause", "need", "block").agg(
        F.collect_list("keys").alias("lists")).where(F.size("lists") == F.col("need"))
    both = F.aggregate("lists", F.col("lists")[0], lambda a, x: F.array_intersect(a, x))
    return (lists.select("kind", F.explode(both).alias("key")).groupBy("key")
            .agg(F.collect_set("kind").alias("kinds")))


SPAN = "struct<start:bigint,rank:int,kind:string,end:bigint>"


def matches(text: Column, rule: Rule, rank: int) -> Column:
    """The rule's matches in ``text`` in turn: rank, i, gap (code points before
    it, after the match before), size, and whether it counts as long enough."""
    def lengths(m: Column) -> Column:
        group = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) \
            if rule.group else m
        gaps = F.slice(F.split(text, rule.pattern, -1), 1, F.size(m))
        z = F.arrays_zip(gaps.alias("gap"), m.alias("m"), group.alias("g"))
        return F.transform(z, lambda x, i: F.struct(
            F.lit(rank).alias("rank"), i.alias("i"), F.length(x["gap"]).alias("gap"),
            F.length(x["m"]).alias("size"), (F.length(x["g"]) >= rule.least).alias("counts")))

    none = F.array().cast("array<struct<rank:int,i:int,gap:int,size:int,counts:boolean>>")
    return let(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)),
               lambda m: F.when(F.size(m) > 0, lengths(m)).otherwise(none))


def spans_of(found: DataFrame, rules: list[Rule]) -> DataFrame:
    """row, spans from rows (row, m: one of ``matches``)."""
    w = Window.partitionBy("row", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    s = found.select("row", "m.*").withColumn("end", F.sum(F.col("gap") + F.col("size")).over(w))
    span = F.struct((F.col("end") - F.col("size")).alias("start"), "rank",
                    F.get(kinds, F.col("rank")).alias("kind"), "end")
    return s.where("counts").groupBy("row").agg(
        F.sort_array(F.collect_list(span)).cast(f"array<{SPAN}>").alias("spans"))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """doc_id, spans (array of (start, rank, kind, end), by start and then rule
    order) per row of ``docs`` (a scan or written table, so that it has the same
    order whenever it is read). NULL text is empty; repeated rows and NULL ids
    give one row each.

    Texts are joined with the candidates only for the rules that have a
    mandatory trigram, and then only the candidates go on; the results meet all
    documents by their row numbers."""
    numbered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = [r for r in rules if queries[r.kind]]
    text = F.coalesce("text", F.lit(""))
    parts = []
    full = [matches(text, r, i) for i, r in enumerate(rules) if not queries[r.kind]]
    if full:
        parts.append(numbered.select("row", F.explode(F.concat(*full)).alias("m")))
    if indexed:
        trigrams = sorted(set().union(*(c for r in indexed for c in queries[r.kind])))
        found = save_shared(candidates(trigram_index(docs, trigrams), indexed), "secret-candidates")
        some = numbered.withColumn("key", _key(F.col("doc_id"))).join(found, "key")
        none = F.array().cast("array<struct<rank:int,i:int,gap:int,size:int,counts:boolean>>")
        part = [F.when(F.array_contains("kinds", r.kind), matches(text, r, i)).otherwise(none)
                for i, r in enumerate(rules) if queries[r.kind]]
        parts.append(some.select("row", F.explode(F.concat(*part)).alias("m")))
    spans = spans_of(reduce(DataFrame.unionByName, parts), rules)
    ids = docs.select("doc_id", F.monotonically_increasing_id().alias("row"))
    return ids.join(spans, "row", "left").select(
        "doc_id", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"))


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every span replaced; overlapping spans are one."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def add(a: Column, s: Column) -> Column:
        fresh = F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"),
                                               (s["start"] - a["at"]).cast("int")), F.lit(mark))
        out = F.when(s["start"] >= a["at"], fresh).otherwise(a["out"])
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), out.alias("out"))

    return F.aggregate(spans, zero, add, lambda a: F.concat(
        a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))
