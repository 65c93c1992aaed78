"""Secret scans over a trigram inverted index, in DataFrame functions only.

Every rule is a regular expression. From its syntax tree follows a Boolean query of trigrams: the alternatives of a run
of characters that every match holds, each an "and" of its trigrams. The index lists, for the trigrams that any query
names, the documents that hold them. Intersecting postings gives the candidates of a rule, and the expression itself is
only run on those. A rule without a mandatory trigram scans all documents.
"""

from __future__ import annotations

import re._constants as op
import re._parser as parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import common as C

MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: Fixed patterns; the first three are the base kinds.
RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abpr]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
BASE = 3


def _times(left: set[str], right: set[str] | None) -> set[str] | None:
    if right is None or len(left) * len(right) > MOST_STRINGS:
        return None
    return {a + b for a in left for b in right}


def _strings(items) -> set[str] | None:
    """All strings that a piece of a syntax tree matches, if they are few; else None."""
    out: set[str] | None = {""}
    for code, value in items:
        if code is op.LITERAL:
            found = {chr(value)}
        elif code is op.IN and all(c is op.LITERAL for c, _ in value):
            found = {chr(v) for _, v in value}
        elif code is op.SUBPATTERN:
            found = _strings(value[-1])
        elif code is op.BRANCH:
            parts = [_strings(p) for p in value[1]]
            found = None if None in parts else set().union(*parts)
        elif code is op.MAX_REPEAT and value[1] is not op.MAXREPEAT and value[1] <= 1:
            once = _strings(value[2])
            found = None if once is None else once if value[0] else once | {""}
        elif code is op.AT:
            found = {""}
        else:
            found = None
        out = _times(out, found)
        if out is None:
            return None
    return out


def _runs(items) -> list[set[str]]:
    """For each stretch of a sequence that is one of few strings: those strings."""
    runs, now = [], {""}
    for item in items:
        code, value = item
        if code is op.SUBPATTERN and _strings([item]) is None:
            runs += [now, *_runs(value[-1])]
            now = {""}
            continue
        more = _times(now, _strings([item]))
        if more is None:
            runs.append(now)
            now = _strings([item]) or {""}
        else:
            now = more
    return [*runs, now]


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """An "or" of "and"s of lower-case trigrams that every match satisfies; empty if no trigram is mandatory."""
    usable = [r for r in _runs(parser.parse(pattern)) if min(map(len, r)) >= 3]
    if not usable:
        return []
    best = max(usable, key=lambda r: (min(map(len, r)), -len(r)))
    clauses = {frozenset(s.lower()[i:i + 3] for i in range(len(s) - 2)) for s in best}
    return sorted((c for c in clauses if not any(d < c for d in clauses)), key=sorted)


def trigram_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (doc_id, mark, trigram) of the given lower-case trigrams; ``mark`` tells texts of one doc_id apart."""
    held = F.transform(F.array(F.lower("text")), lambda s: F.filter(F.array(*map(F.lit, trigrams)), lambda t: F.contains(s, t)))
    return docs.select("doc_id", F.xxhash64("text").alias("mark"), F.explode(held[0]).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For each document that satisfies the query of some rule: the numbers of those rules."""
    clauses = [(i, c, t, len(clause)) for i, rule in enumerate(rules) for c, clause in enumerate(trigram_query(rule.pattern)) for t in sorted(clause)]
    table = F.explode(F.array(*(
        F.struct(F.lit(i).alias("rule"), F.lit(c).alias("clause"), F.lit(t).alias("trigram"), F.lit(n).alias("needed")) for i, c, t, n in clauses)))
    wanted = docs.sparkSession.range(1).select(table.alias("q")).select("q.*")
    postings = trigram_index(docs, sorted({t for _, _, t, _ in clauses}))
    return (
        postings.join(F.broadcast(wanted), "trigram").groupBy("doc_id", "mark", "rule", "clause")
        .agg(F.count(F.lit(1)).alias("n"), F.first("needed").alias("needed")).where(F.col("n") >= F.col("needed"))
        .groupBy("doc_id", "mark").agg(F.collect_set("rule").alias("rules"))
    )


def _pieces(number: int, rule: Rule) -> list[Column]:
    """Gaps, matches and tested groups of a rule in the text; null where the rule need not be run or does not match."""
    asked = F.array_contains("rules", number) if trigram_query(rule.pattern) else F.lit(True)
    found = F.coalesce(asked, F.lit(False)) & F.col("text").rlike(rule.pattern)
    every = lambda group: F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(group))
    return [
        F.when(found, F.transform(F.split("text", rule.pattern, -1), F.length)).alias(f"gaps{number}"),
        F.when(found, F.transform(every(0), F.length)).alias(f"sizes{number}"),
        F.when(found, F.transform(every(rule.group), F.length)).alias(f"tested{number}"),
    ]


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Spans of all rules in each whole text.

    Matches of a rule are leftmost and do not overlap each other; those whose tested group is too short are dropped
    after matching. Result, one row per input row: doc_id, spans (kind, start, end in code points, end exclusive; sorted
    by start, then by the order of the rules).

    Null texts are empty and have no spans. Rows that share a doc_id are told apart by their texts; exact copies of a row
    get the same result each; a null doc_id stays null. Texts are read whole. Matches are numbered and summed per
    document and rule, so that memory is bounded by the matches of one text.
    """
    texts = C.slim(docs)
    marked = texts.select("doc_id", F.xxhash64("text").alias("mark"), "text").join(candidates(texts, rules), ["doc_id", "mark"], "left")
    pieces = marked.select("doc_id", "mark", *(p for i, r in enumerate(rules) for p in _pieces(i, r)))
    kind = "array<struct<rule: int, nth: int, gap: int, size: int, tested: int>>"

    def numbered(i: int) -> Column:
        def match(x: Column, n: Column) -> Column:
            return F.struct(F.lit(i).alias("rule"), n.alias("nth"), x[f"gaps{i}"].alias("gap"), x[f"sizes{i}"].alias("size"), x[f"tested{i}"].alias("tested"))

        return F.coalesce(F.transform(F.arrays_zip(f"gaps{i}", f"sizes{i}", f"tested{i}"), match).cast(kind), F.array().cast(kind))

    found = [numbered(i) for i in range(len(rules))]
    whole = F.array(F.struct(*(F.lit(v).alias(k) for k, v in (("rule", -1), ("nth", 0), ("gap", 0), ("size", 0), ("tested", 0))))).cast(kind)
    rows = pieces.select("doc_id", "mark", F.explode(F.concat(whole, *found)).alias("m")).select("doc_id", "mark", "m.*").where(F.col("size").isNotNull())
    key = ["doc_id", "mark", "rule"]
    once = rows.groupBy(*key, "nth").agg(F.max("gap").alias("gap"), F.max("size").alias("size"), F.max("tested").alias("tested"), F.count(F.lit(1)).cast("int").alias("copies"))
    end = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy(*key).orderBy("nth").rowsBetween(Window.unboundedPreceding, 0))
    least = F.element_at(F.array(*(F.lit(r.least) for r in rules)), F.greatest(F.col("rule"), F.lit(0)) + 1)
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    placed = once.withColumn("end", end).withColumn("start", F.col("end") - F.col("size")).where((F.col("rule") < 0) | (F.col("tested") >= least))
    by_doc = placed.groupBy("doc_id", "mark").agg(
        F.max(F.when(F.col("rule") < 0, F.col("copies"))).alias("copies"),
        F.array_sort(F.collect_list(F.when(F.col("rule") >= 0, F.struct("start", "rule", "end")))).alias("spans"))
    named = F.transform("spans", lambda s: F.struct(F.get(kinds, s["rule"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).cast("array<struct<kind: string, start: long, end: long>>")
    return by_doc.select(C.real_id(), named.alias("spans"), F.explode(F.array_repeat(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")
