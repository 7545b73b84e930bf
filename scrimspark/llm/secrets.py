"""Operator 9: secret scans through a trigram inverted index. DataFrame operations only.

Every rule's regular expression is turned into a Boolean query over the trigrams that any match must hold (lower case, so
one index serves both cases). The index has a posting (trigram, document) for each trigram of those queries. A rule's
candidates are the documents in the intersection of its postings; only they are matched against the expression. A rule
without a mandatory trigram (bare hexadecimal runs) scans every text.

Nulls, ties, empty input: a null text counts as empty and has no spans; rows that repeat a doc_id are scanned one by one
(their candidates are shared, which changes nothing); an empty table gives an empty result.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep, table, text_or_empty

#: Alternatives that a run of literals may have before it is cut.
WIDEST = 64


@dataclass(frozen=True)
class Rule:
    """kind: its name; pattern: Java, RE2 and Python agree on it; group, least: that group must have so many characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


def _either(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_KEYWORDS = "|".join([*map(_either, ("password", "passwd", "secret", "token")), _either("api") + "_?" + _either("key")])

#: The base rules, in their order, and the formats of well-known services.
RULES = (
    Rule("assign", rf"({_KEYWORDS})[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
    Rule("forge", r"gh[opsru]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("pay", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
BASE = ("assign", "access", "hex")


def _strings(op, value) -> set[str] | None:
    """All strings that a node can match, in lower case; None if there are too many."""
    if op is sre.LITERAL:
        return {chr(value).lower()}
    if op is sre.IN:
        if all(o is sre.LITERAL for o, _ in value):
            return {chr(v).lower() for _, v in value}
        return None
    if op is sre.SUBPATTERN:
        return _sequence(value[3])
    if op is sre.BRANCH:
        parts = [_sequence(x) for x in value[1]]
        return None if None in parts else set().union(*parts)
    if op is sre.MAX_REPEAT and value[1] == 1:
        inner = _sequence(value[2])
        return None if inner is None else inner | ({""} if value[0] == 0 else set())
    if op is sre.MAX_REPEAT and value[0] == value[1]:
        return _sequence([node for _ in range(value[0]) for node in value[2]])
    return None


def _sequence(nodes) -> set[str] | None:
    out = {""}
    for op, value in nodes:
        more = _strings(op, value)
        if more is None or len(out) * len(more) > WIDEST:
            return None
        out = {a + b for a, b in product(out, more)}
    return out


def _least(clauses: set[frozenset[str]]) -> set[frozenset[str]]:
    return {c for c in clauses if not any(d < c for d in clauses)}


def trigram_query(pattern: str) -> set[frozenset[str]]:
    """A disjunction of conjunctions of trigrams; one of them holds in any text that the pattern matches. The empty
    conjunction stands for no condition."""

    def of_run(strings: set[str]) -> set[frozenset[str]]:
        return _least({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings})

    def walk(nodes) -> set[frozenset[str]]:
        found, run = {frozenset()}, {""}

        def both(more):
            nonlocal found
            found = _least({a | b for a, b in product(found, more)})

        for op, value in nodes:
            strings = _strings(op, value)
            if strings is not None and len(run) * len(strings) <= WIDEST:
                run = {a + b for a, b in product(run, strings)}
                continue
            both(of_run(run))
            run = {""}
            if strings is not None:
                run = strings
            elif op is sre.SUBPATTERN:
                both(walk(value[3]))
            elif op is sre.MAX_REPEAT and value[0] > 0:
                both(walk(value[2]))
            elif op is sre.BRANCH:
                both(_least(set().union(*[walk(x) for x in value[1]])))
        both(of_run(run))
        return found

    return walk(sre_parser.parse(pattern))


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index over the given trigrams: (trigram, doc_id)."""
    lower = docs.select("doc_id", F.lower(text_or_empty()).alias("_lower"))
    held = F.filter(F.array(*[F.lit(t) for t in trigrams]), lambda t: F.contains(F.col("_lower"), t))
    return lower.select(F.explode(held).alias("trigram"), "doc_id")


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, kinds): the documents in the intersection of the postings of at least one rule. A document has at most
    as many postings as the queries have trigrams, so its group is bounded."""
    held = index.groupBy("doc_id").agg(F.collect_set("trigram").alias("_held"))
    kinds = []
    for rule in rules:
        clauses = [F.size(F.array_except(F.array(*map(F.lit, sorted(c))), F.col("_held"))) == 0 for c in sorted(trigram_query(rule.pattern), key=sorted)]
        some = clauses[0]
        for c in clauses[1:]:
            some = some | c
        kinds.append(F.when(some, F.lit(rule.kind)))
    return held.select("doc_id", F.array_compact(F.array(*kinds)).alias("kinds")).where(F.size("kinds") > 0)


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of struct(start, order, end): the matches and what lies between them alternate, so lengths give places."""
    none = F.array().cast("array<struct<start:bigint,order:bigint,end:bigint>>")
    pieces, found, kept = F.split(text, F.lit(rule.pattern), -1), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    lengths = F.transform(F.arrays_zip(pieces.alias("p"), found.alias("m"), kept.alias("g")), lambda x: F.struct(F.length(x["p"]).cast("long").alias("p"), F.length(x["m"]).cast("long").alias("m"), F.length(x["g"]).cast("long").alias("g")))
    start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))

    def step(a: Column, x: Column) -> Column:
        begin, end = a["at"] + x["p"], a["at"] + x["p"] + F.coalesce(x["m"], F.lit(0))
        span = F.array(F.struct(begin.alias("start"), F.lit(order).cast("long").alias("order"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(x["g"] >= rule.least, F.concat(a["out"], span)).otherwise(a["out"]).alias("out"))

    return F.aggregate(lengths, start, step, lambda a: a["out"])


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs (doc_id, text and any more) with found: array of struct(start, order, end) in code points, by start, then by
    the rule's place in rules. An input column named found is replaced."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = tuple(r for r in rules if frozenset() not in queries[r.kind])
    trigrams = sorted(set().union(*[c for r in indexed for c in queries[r.kind]]))
    # written, so that Spark knows how few there are and picks the join by their size
    hits = keep(candidates(postings(docs, trigrams), indexed), "secret-candidates").select(F.col("doc_id").alias("_id"), "kinds")
    docs = docs.drop("found")
    # the caller's columns are one, so no name of theirs meets one of ours
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_doc"))
    rows = rows.join(hits, rows["_doc"].eqNullSafe(hits["_id"]), "left").withColumn("_text", F.coalesce(F.col("_row.text"), F.lit("")))
    none = F.array().cast("array<struct<start:bigint,order:bigint,end:bigint>>")
    found = []
    for order, rule in enumerate(rules):
        likely = F.array_contains(F.coalesce("kinds", F.array().cast("array<string>")), F.lit(rule.kind)) if rule in indexed else F.col("_text").rlike(rule.pattern)
        found.append(F.when(likely, _spans(F.col("_text"), rule, order)).otherwise(none))
    return rows.select("_row.*", F.array_sort(F.concat(*found)).alias("found"))


def spans_text(found: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end, joined by commas."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.element_at(kinds, (x["order"] + 1).cast("int")), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """docs with every span of every rule replaced by ``mark`` in text."""
    rows = scan(docs, rules)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(a: Column, x: Column) -> Column:
        before = F.when(x["start"] >= a["at"], F.concat(a["out"], F.substr(text_or_empty(), (a["at"] + 1).cast("int"), (x["start"] - a["at"]).cast("int")), F.lit(mark))).otherwise(a["out"])
        return F.struct(F.greatest(a["at"], x["end"]).alias("at"), before.alias("out"))

    done = F.aggregate("found", start, step, lambda a: F.concat(a["out"], F.substr(text_or_empty(), (a["at"] + 1).cast("int"))))
    return rows.withColumn("text", F.when(F.size("found") > 0, done).otherwise(F.col("text")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(table(spark, sf_dir, "documents", "doc_id", "text"))

    def of(order: int) -> Column:
        return F.size(F.filter("found", lambda x: x["order"] == order)).cast("long")

    return rows.select(
        "doc_id",
        *[of(i).alias(f"n_{kind}") for i, kind in enumerate(BASE)],
        F.sha2(spans_text(F.filter("found", lambda x: x["order"] < len(BASE))), 256).alias("base_sha256"),
        spans_text(F.col("found")).alias("spans"),
    )


def _oracle() -> str:
    parts = []
    for order, rule in enumerate(RULES):
        p = rule.pattern
        parts.append(
            f"SELECT r, '{rule.kind}' AS kind, {order} AS ord, unnest(m) AS m, unnest(g) AS g, unnest(p[1:len(m)]) AS p, unnest(range(len(m))) AS i FROM "
            f"(SELECT r, regexp_extract_all(t, '{p}', 0) AS m, regexp_extract_all(t, '{p}', {rule.group}) AS g, string_split_regex(t, '{p}') AS p FROM docs WHERE regexp_matches(t, '{p}'))"
        )
    least = " ".join(f"WHEN '{r.kind}' THEN {r.least}" for r in RULES)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({' UNION ALL '.join(parts)}),
ends AS (SELECT *, (sum(length(p) + length(m)) OVER (PARTITION BY r, ord ORDER BY i))::BIGINT AS e FROM found),
spans AS (SELECT r, kind, ord, e - length(m) AS s, e FROM ends WHERE length(g) >= CASE kind {least} END),
texts AS (SELECT r, sum((kind = 'assign')::INT)::BIGINT AS n_assign, sum((kind = 'access')::INT)::BIGINT AS n_access, sum((kind = 'hex')::INT)::BIGINT AS n_hex,
  coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord) FILTER (WHERE ord < 3), '') AS base, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord) AS spans FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN texts USING (r)
"""


ORACLE = _oracle()
