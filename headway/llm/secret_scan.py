"""Secret scan over a trigram inverted index, in DataFrame and SQL operations only.

From each rule's regex a Boolean trigram query is derived: the alternatives of
literal strings that any match must hold, each as the set of its trigrams. The
index holds a posting (trigram, document) for every trigram that some query
names. Intersecting the postings gives the documents that can match a rule;
only those are verified with the regex. A rule without mandatory trigrams scans
every text.

Spans are code points, end exclusive, leftmost and non-overlapping for each kind.
Kinds ``assign``, ``access`` and ``hex`` are the base; the others add spans.

Defined results: a NULL text is the empty text and has no spans; rows with equal
id and text have equal results, a NULL id included; columns other than the id
and the text are not read.
"""

from __future__ import annotations

import re._constants as C
import re._parser as parser
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import text_key, text_of

MAX_ALTERNATIVES = 64       # of literal strings; beyond them a part of a regex counts as unknown
RUN = 256                   # matches of a text whose spans are gathered in one array
BREAK = "\0"                # stands for unknown text between literal parts


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its regex and the least length of a group (0: the match)."""

    kind: str
    regex: str
    group: int = 0
    least: int = 0


# The base kinds, in their order.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
# Published token formats.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + MORE


def literals(parsed) -> list[str]:
    """Alternatives of the literal text that a parsed regex must match; BREAK is unknown text."""
    parts: list[list[str]] = []
    for op, arg in parsed:
        if op is C.LITERAL:
            parts.append([chr(arg)])
        elif op is C.IN and all(o is C.LITERAL for o, _ in arg):
            parts.append([chr(a) for _, a in arg])
        elif op is C.SUBPATTERN:
            parts.append(literals(arg[-1]))
        elif op is C.BRANCH:
            parts.append([x for branch in arg[1] for x in literals(branch)])
        elif op is C.MAX_REPEAT and arg[1] == 1:
            parts.append(["", *literals(arg[2])] if arg[0] == 0 else literals(arg[2]))
        elif op is C.MAX_REPEAT and arg[0] >= 1:
            parts.append([x + BREAK + x for x in literals(arg[2])] if len(literals(arg[2])) == 1 else [BREAK])
        else:
            parts.append([BREAK])
    out = [""]
    for alternatives in parts:
        if len(out) * len(alternatives) > MAX_ALTERNATIVES:
            alternatives = [BREAK]
        out = [a + b for a, b in product(out, alternatives)]
    return out


def trigram_query(regex: str) -> list[frozenset[str]]:
    """OR of ANDs of lower-case trigrams; empty if some alternative has none."""
    def of(text: str) -> frozenset[str]:
        return frozenset(p[i:i + 3].lower() for p in text.split(BREAK) for i in range(len(p) - 2))

    found = {of(x) for x in literals(parser.parse(regex))}
    if frozenset() in found:
        return []
    return sorted((f for f in found if not any(g < f for g in found)), key=sorted)


def keys(id_col: str, text_col: str) -> list[Column]:
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(-2 ** 63)).alias("_id"), text_key(text_col).alias("_t")]


def build_index(docs: DataFrame, trigrams: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings (trigram, _id, _t) of the given trigrams, one for each document that holds the trigram."""
    low = F.lower(text_of(text_col))
    held = F.array_compact(F.array(*[F.when(low.contains(t), F.lit(t)) for t in trigrams]))
    return docs.select(*keys(id_col, text_col), F.explode(held).alias("trigram"))


def candidates(postings: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(_id, _t, kinds): the documents whose postings satisfy a kind's query."""
    have = postings.groupBy("_id", "_t").agg(F.collect_set("trigram").alias("have"))  # at most the queries' trigrams
    met = [F.when(reduce(Column.__or__, [
        reduce(Column.__and__, [F.array_contains("have", t) for t in sorted(clause)]) for clause in query]), F.lit(kind))
        for kind, query in queries.items()]
    return have.select("_id", "_t", F.array_compact(F.array(*met)).alias("kinds")).where(F.size("kinds") > 0)


def regex_of(rule: Rule) -> str:
    """A whole match of some least length ends in a repeated class: ask for that many, so shorter ones aren't built."""
    if rule.group or not rule.least:
        return rule.regex
    return rule.regex.removesuffix("+") + "{%d,}" % (rule.least - rule.regex.rindex("["))


def rule_matches(text: Column, rule: Rule) -> Column:
    """The matches, the text between them and, if it is a part of the match, the group that counts."""
    regex = regex_of(rule)
    group = [F.regexp_extract_all(text, F.lit(regex), F.lit(rule.group)).alias("group")] if rule.group else []
    return F.struct(F.regexp_extract_all(text, F.lit(regex), F.lit(0)).alias("whole"), F.split(text, regex, -1).alias("gaps"), *group)


def rule_spans(matched: str, rule: Rule, order: int) -> Column:
    """Spans (start, order, end, kind) of the matches in a column; the lengths of matches and gaps add up to places.

    Adding to an array copies it, so the matches are taken in runs of RUN: spans
    within each run first, then the place of each run.
    """
    whole, group, gaps = (F.col(f"{matched}.{c}") for c in ("whole", "group" if rule.group else "whole", "gaps"))
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")

    def step(acc: Column, i: Column) -> Column:
        start = acc["at"] + F.length(gaps[i])
        end = start + F.length(whole[i])
        span = F.array(F.struct(start.alias("start"), F.lit(order).alias("order"), end.alias("end"),
                                F.lit(rule.kind).alias("kind")))
        return F.struct(end.alias("at"), F.when(F.length(group[i]) >= rule.least, F.concat(acc["out"], span))
                        .otherwise(acc["out"]).alias("out"))

    def run_of(first: Column) -> Column:
        return F.aggregate(F.sequence(first, F.least(first + (RUN - 1), F.size(whole) - 1)),
                           F.struct(F.lit(0).alias("at"), none.alias("out")), step)

    runs = F.transform(F.sequence(F.lit(0), F.size(whole) - 1, F.lit(RUN)), run_of)
    places = F.aggregate(
        runs, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
        lambda acc, r: F.struct((acc["at"] + r["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
        lambda acc: acc["out"])
    moved = F.zip_with(runs, places, lambda r, place: F.transform(r["out"], lambda x: F.struct(
        (x["start"] + place).alias("start"), x["order"].alias("order"), (x["end"] + place).alias("end"), x["kind"].alias("kind"))))
    return F.when(F.size(whole) > 0, F.flatten(moved)).otherwise(none)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): all spans of each text, by start, then in the order of the rules."""
    queries = {r.kind: trigram_query(r.regex) for r in rules}
    indexed = {k: q for k, q in queries.items() if q}
    trigrams = sorted({t for q in indexed.values() for clause in q for t in clause})
    found = candidates(build_index(docs, trigrams, id_col, text_col), indexed)
    rows = (docs.select(F.col(id_col), text_of(text_col).alias("text"), *keys(id_col, text_col))
            .join(found, ["_id", "_t"], "left"))
    spans = []
    for order, rule in enumerate(rules):
        name = f"_m_{rule.kind}"
        verify = rule_matches(F.col("text"), rule)
        rows = rows.withColumn(name, F.when(F.array_contains("kinds", rule.kind), verify)
                               if rule.kind in indexed else verify)
        spans.append(rule_spans(name, rule, order))
    return rows.select(id_col, F.transform(
        F.array_sort(F.concat(*spans)),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
