"""op6: secret scans with a trigram inverted index.

From each rule's regular expression a Boolean trigram query is derived: the literal runs that
every match must contain, each an OR over its alternatives of an AND of trigrams.  Postings
(trigram, document) of the queries' trigrams are intersected per document, and only documents
that pass a rule's query are searched with its expression.  A rule without mandatory trigrams
searches every document.  Everything is DataFrame expressions.

Spans are code points, end exclusive.  ``regexp_extract_all`` gives the matches and ``split``
the text between them, so running lengths give the places.

Results in the odd cases: a null or empty text has no spans; documents that share an id (a null
id is one) share their postings, which only lets more rules search them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Clause = list[frozenset[str]]  # alternatives, each a set of trigrams that go together


@dataclass(frozen=True)
class SecretRule:
    """Matches of ``pattern`` whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0


# Fixed patterns of the contract, and further well-known token formats after them.
BASE = (
    SecretRule("assign", r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                         r"([A-Za-z0-9+/_.=-]+)", least=6, group=2),
    SecretRule("access", r"AKIA[A-Z0-9]+", least=20),
    SecretRule("hex", r"[0-9a-f]+", least=24),
)
RULES = BASE + (
    SecretRule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    SecretRule("github", r"gh[opsu]_[A-Za-z0-9]+", least=40),
    SecretRule("slack", r"xox[abprs]-[A-Za-z0-9-]+", least=20),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)

MAX_ALTERNATIVES = 32  # beyond so many strings a run of literals asks for nothing


def literal_runs(parsed) -> list[list[str]]:
    """Per literal run of a parsed expression the strings of which a match contains one."""
    runs, now = [], [""]
    for op, value in parsed:
        name = str(op)
        if name == "LITERAL":
            strings = [chr(value)]
        elif name == "SUBPATTERN":
            strings = _whole(value[-1])
        elif name == "BRANCH":
            parts = [_whole(branch) for branch in value[1]]
            strings = None if None in parts else [s for p in parts for s in p]
        elif name == "MAX_REPEAT" and value[1] == 1:
            inner = _whole(value[2])
            strings = None if inner is None else ["", *inner] if value[0] == 0 else inner
        else:
            strings = None
        if strings is not None and len(now) * len(strings) <= MAX_ALTERNATIVES:
            now = [a + b for a, b in product(now, strings)]
            continue
        runs.append(now)
        now = strings if strings is not None and len(strings) <= MAX_ALTERNATIVES else [""]
    return [*runs, now]


def _whole(parsed) -> list[str] | None:
    """All strings of an expression, or None where they aren't a short list."""
    runs = [r for r in literal_runs(parsed) if r != [""]]
    flat = all(str(op) in ("LITERAL", "SUBPATTERN", "BRANCH", "MAX_REPEAT") for op, _ in parsed)
    if not flat or len(runs) > 1 or any(
            str(op) == "MAX_REPEAT" and value[1] != 1 for op, value in parsed):
        return None
    return runs[0] if runs else [""]


def trigram_query(pattern: str) -> list[Clause]:
    """Clauses (all must hold) over trigrams of the lower-cased text; none: scan all."""
    clauses = []
    for strings in literal_runs(re._parser.parse(pattern)):
        sets = [frozenset(s.lower()[k:k + 3] for k in range(len(s) - 2)) for s in strings]
        if all(sets):
            clauses.append(sorted(set(sets), key=sorted))
    return clauses


def build_index(docs: DataFrame, key: str, text: str, trigrams: list[str]) -> DataFrame:
    """Postings (trigram, key) of the given trigrams over lower-cased texts."""
    low = docs.select(F.col(key).alias("_key"), F.lower(F.col(text)).alias("_low"))
    present = F.array_compact(F.array(*[F.when(F.contains("_low", F.lit(t)), F.lit(t))
                                        for t in trigrams]))
    return low.select(F.explode(present).alias("trigram"), "_key")


def candidates(index: DataFrame, queries: dict[str, list[Clause]]) -> DataFrame:
    """Per key the rules whose trigram query its postings satisfy."""
    held = index.groupBy("_key").agg(F.collect_set("trigram").alias("_held"))

    def holds(clauses: list[Clause]) -> Column:
        every = F.lit(True)
        for clause in clauses:
            some = F.lit(False)
            for trigrams in clause:
                wanted = F.array(*[F.lit(t) for t in sorted(trigrams)])
                some = some | (F.size(F.array_except(wanted, F.col("_held"))) == 0)
            every = every & some
        return every

    found = F.array_compact(F.array(*[F.when(holds(q), F.lit(kind))
                                      for kind, q in queries.items()]))
    return held.select("_key", found.alias("_rules")).where(F.size("_rules") > 0)


def matches(rule: SecretRule, rank: int, source: str, searched: Column) -> Column:
    """The rule's spans in column ``source``: structs of start, rank, end, kind."""
    p = rule.pattern.replace("\\", "\\\\").replace("'", "\\'")
    empty = "CAST(array() AS ARRAY<STRUCT<start: INT, rank: INT, end: INT, kind: STRING>>)"
    found = F.expr(f"""
        aggregate(
            arrays_zip(transform(split({source}, '{p}', -1), x -> length(x)),
                       transform(regexp_extract_all({source}, '{p}', 0), x -> length(x)),
                       transform(regexp_extract_all({source}, '{p}', {rule.group}),
                                 x -> length(x))),
            struct(0 AS at, {empty} AS spans),
            (a, x) -> struct(
                a.at + x['0'] + coalesce(x['1'], 0) AS at,
                IF(x['2'] >= {rule.least},
                   concat(a.spans, array(struct(a.at + x['0'] AS start, {rank} AS rank,
                          a.at + x['0'] + x['1'] AS end, '{rule.kind}' AS kind))),
                   a.spans) AS spans),
            a -> a.spans)""")
    likely = f"[0-9a-f]{{{rule.least}}}" if rule.pattern == "[0-9a-f]+" else rule.pattern
    return F.when(searched & F.col(source).rlike(likely), found).otherwise(F.expr(empty))


def scan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", out: str = "secrets",
         rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """``docs`` with an array column ``out`` of spans (start, rank, end, kind) in text order.

    ``rank`` is the rule's place in ``rules``.  An input column named like ``out`` is replaced;
    the others pass through.
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q}
    trigrams = sorted({t for q in indexed.values() for c in q for s in c for t in s})
    own = docs.drop(out)
    if trigrams:
        found = candidates(build_index(own, doc_id, text, trigrams), indexed)
        own = own.join(found, F.col(doc_id).eqNullSafe(F.col("_key")), "left").drop("_key")
    else:
        own = own.withColumn("_rules", F.array().cast("array<string>"))
    own = own.withColumn("_source", F.coalesce(F.col(text), F.lit("")))
    spans = []
    for rank, rule in enumerate(rules):
        searched = F.lit(True) if not queries[rule.kind] else F.coalesce(
            F.array_contains("_rules", rule.kind), F.lit(False))
        spans.append(matches(rule, rank, "_source", searched))
    return own.withColumn(out, F.array_sort(F.concat(*spans))).drop("_rules", "_source")


def redact(docs: DataFrame, *, text: str = "text", spans: str = "secrets",
           mask: str = "[secret]") -> DataFrame:
    """``docs`` with every span of ``spans`` in ``text`` replaced; touching spans get one mask."""
    merged = f"""
        aggregate({spans}, struct(0 AS at, '' AS kept),
            (a, s) -> struct(
                greatest(a.at, s.end) AS at,
                IF(s.start > a.at OR a.at = 0,
                   concat(a.kept, substring({text}, a.at + 1, s.start - a.at), '{mask}'),
                   a.kept) AS kept),
            a -> concat(a.kept, substring({text}, a.at + 1)))"""
    return docs.withColumn(text, F.when(F.size(spans) > 0, F.expr(merged))
                           .otherwise(F.col(text)))


def op6(docs: DataFrame) -> DataFrame:
    """The contract's columns of ``scan`` over documents."""
    listed = "array_join(transform({0}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
    base = f"filter(secrets, s -> s.rank < {len(BASE)})"
    counts = [F.expr(f"CAST(size(filter(secrets, s -> s.rank = {k})) AS BIGINT)")
              .alias(f"n_{rule.kind}") for k, rule in enumerate(BASE)]
    return scan(docs.select("doc_id", "text")).select(
        "doc_id", *counts, F.sha2(F.expr(listed.format(base)), 256).alias("base_sha256"),
        F.expr(listed.format("secrets")).alias("spans"))
