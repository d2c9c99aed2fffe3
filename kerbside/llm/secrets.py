"""Secret scans with a trigram inverted index, in DataFrame functions only.

From every rule's regular expression a Boolean query over trigrams is derived: what a matching text must contain. The
postings of these trigrams (trigram, document) are built once, intersected per document, and only documents that satisfy
a rule's query are searched with it. Rules without mandatory trigrams search every document.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import bind

MAX_STRINGS = 32


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``group`` must have ``least`` characters or more, else the match is dropped."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0


# The base kinds, in order.
BASE_RULES = (
    Rule(
        "assign",
        r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        6,
        2,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)
# Published key formats.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
    Rule("private", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES

#: A query in conjunctive form: every member needs one of its alternatives, an alternative needs all its trigrams.
Query = frozenset[frozenset[frozenset[str]]]


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _query_of(strings: set[str]) -> Query:
    needs = {trigrams(s) for s in strings}
    return frozenset() if not needs or frozenset() in needs else frozenset([frozenset(needs)])


def _walk(items) -> tuple[set[str] | None, Query]:
    """Of a parsed pattern: the finite set of lower-case strings it stands for, or None, and its trigram query."""
    runs: set[str] | None = {""}
    open_, query = True, frozenset()
    for op, arg in items:
        if op is sre.LITERAL:
            exact, more = {chr(arg).lower()}, frozenset()
        elif op is sre.SUBPATTERN:
            exact, more = _walk(arg[3])
        elif op is sre.BRANCH:
            parts = [_walk(x) for x in arg[1]]
            exact = None if any(e is None for e, _ in parts) else set().union(*(e for e, _ in parts))
            ands = [q for _, q in parts]
            more = frozenset()
            if exact is None and all(ands):
                # Each branch needs all of its members; one alternative per branch, where it has a single member.
                sets = [next(iter(q)) for q in ands]
                more = frozenset([frozenset().union(*sets)])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, inner = arg
            exact, more = _walk(inner)
            if (low, high) == (0, 1) and exact is not None:
                exact, more = exact | {""}, frozenset()
            elif (low, high) != (1, 1):
                exact, more = None, more if low else frozenset()
        elif op is sre.IN and all(o is sre.LITERAL for o, _ in arg):
            exact, more = {chr(c).lower() for _, c in arg}, frozenset()
        else:
            exact, more = None, frozenset()
        query |= more
        if exact is not None and len(runs) * len(exact) <= MAX_STRINGS:
            runs = {a + b for a in runs for b in exact}
        else:
            query |= _query_of(runs)
            open_ = open_ and exact is not None
            runs = set(exact) if exact is not None and len(exact) <= MAX_STRINGS else {""}
            open_ = False
    query |= _query_of(runs)
    return (runs if open_ else None), query


def trigram_query(pattern: str) -> Query:
    """What a text that matches must contain, lower-cased; empty if nothing is certain."""
    return _walk(sre_parser.parse(pattern))[1]


def holds(query: Query, found: Column) -> Column:
    """Whether the trigrams in the array ``found`` satisfy ``query``."""
    out = F.lit(True)
    for member in sorted(query, key=sorted):
        any_ = F.lit(False)
        for grams in sorted(member, key=sorted):
            all_ = F.lit(True)
            for gram in sorted(grams):
                all_ = all_ & F.array_contains(found, gram)
            any_ = any_ | all_
        out = out & any_
    return out


def postings(docs: DataFrame, grams: list[str]) -> DataFrame:
    """The inverted index of the given trigrams: (gram, doc_id), for lower-cased texts."""
    low = F.lower(F.coalesce(F.col("text"), F.lit("")))
    hits = bind(low, lambda t: F.array_compact(F.array(*[F.when(F.contains(t, F.lit(g)), g) for g in grams])))
    return docs.select("doc_id", F.explode(hits).alias("gram"))


def find(text: Column, rule: Rule, order: int) -> Column:
    """Leftmost, non-overlapping matches: array of (start, order, kind, end); code points, end exclusive."""
    none = F.array().cast("array<struct<start:long,order:int,kind:string,end:long>>")

    def spans(lengths: Column, matches: Column) -> Column:
        # Pieces and matches alternate: a match starts after all pieces and matches before it.
        zipped = F.zip_with(F.slice(lengths, 1, F.size(matches)), matches, lambda n, m: F.struct(n.alias("n"), m.alias("m")))
        start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))

        def step(acc: Column, x: Column) -> Column:
            at = acc["at"] + x["n"]
            end = at + F.length(x["m"])
            value = x["m"] if rule.group == 0 else F.regexp_extract(x["m"], rule.pattern, rule.group)
            row = F.struct(
                at.alias("start"), F.lit(order).alias("order"), F.lit(rule.kind).alias("kind"), end.alias("end")
            )
            out = F.when(F.length(value) >= rule.least, F.concat(acc["out"], F.array(row))).otherwise(acc["out"])
            return F.struct(end.cast("long").alias("at"), out.alias("out"))

        return F.aggregate(zipped, start, step)["out"]

    def located(matches: Column) -> Column:
        pieces = F.transform(F.split(text, rule.pattern, -1), lambda p: F.length(p))
        return F.when(F.size(matches) == 0, none).otherwise(bind(pieces, lambda n: spans(n, matches)))

    return bind(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), located)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All spans of every row of ``docs``: doc_id, text, spans (start, order, kind, end) sorted by start, then rule, and
    the other columns as the struct ``row``, so that no column of ``docs`` can clash.

    Null texts count as empty and stay null. Rows that share a doc_id share the index entry, which then only admits more searches;
    each row is searched by itself.
    """
    docs = docs.select("doc_id", "text", F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("row"))
    text = F.coalesce(F.col("text"), F.lit(""))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    grams = sorted({g for q in queries.values() for member in q for alt in member for g in alt})
    found = F.collect_set("gram")
    admitted = postings(docs, grams).groupBy("doc_id").agg(found.alias("found"))
    admitted = admitted.select(
        F.col("doc_id").alias("key"),
        F.array_compact(
            F.array(*[F.when(holds(queries[r.kind], F.col("found")), r.kind) for r in rules if queries[r.kind]])
        ).alias("admitted"),
    ).where(F.size("admitted") > 0)
    rows = docs.join(admitted, docs["doc_id"].eqNullSafe(admitted["key"]), "left").drop("key")
    none = F.array().cast("array<struct<start:long,order:int,kind:string,end:long>>")
    parts = []
    for order, rule in enumerate(rules):
        spans = find(text, _least(rule), order)
        if queries[rule.kind]:
            spans = F.when(F.coalesce(F.array_contains("admitted", rule.kind), F.lit(False)), spans).otherwise(none)
        parts.append(spans)
    return rows.select("doc_id", "text", F.array_sort(F.concat(*parts)).alias("spans"), "row")


def _least(rule: Rule) -> Rule:
    """The same matches for ``x+`` of a least length: shorter runs are skipped by the search instead of dropped later."""
    m = rule.pattern
    if rule.group == 0 and rule.least and m.startswith("[") and m.endswith("]+") and m.count("[") == 1:
        return Rule(rule.kind, f"{m[:-1]}{{{rule.least},}}", rule.least)
    return rule


def joined(spans: Column) -> Column:
    text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def without(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with every span replaced by ``mark``; what overlaps an earlier span goes with it."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    def whole(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(bind(F.aggregate(spans, start, step), whole))


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """``docs`` with all columns; in texts that hold secrets these are replaced by ``mark`` and n_chars, if there, is
    counted anew. Null texts stay null.
    """
    own = scan(docs, rules)
    hit = F.size("spans") > 0
    hidden = without(F.col("text"), F.col("spans"), mark)
    out = own.withColumn("hidden", F.when(hit, hidden))
    columns = []
    for name in docs.columns:
        kept = F.col("text") if name == "text" else F.col("row").getField(name)
        if name == "text":
            kept = F.coalesce("hidden", "text")
        elif name == "n_chars":
            kept = F.when(hit, F.length("hidden").cast(docs.schema[name].dataType)).otherwise(kept)
        columns.append(kept.alias(name))
    return out.select(*columns)
