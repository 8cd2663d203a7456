"""op3: quality rules as one projection.

A table of thresholds over ratios of a text's own counts (length, symbols, stop words, lines,
repeated words) is compiled into DataFrame expressions; no user function runs and no row moves.

Words are runs between ASCII blanks.  Repeated words are those in a 3-word window that occurs
at least twice.  Windows are found by sorting one long a window: the upper bits of its hash,
the lower bits its place, as many as the text needs; neighbours whose hash bits agree are
compared word by word, so equal hashes of different windows don't count.

Results in the odd cases: a null or empty text has zero counts, fails on its length and is not
kept; rows are judged one by one, so repeated rows get repeated results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that for it as was with be by on are this from or an "
    "der die das und ist von zu mit den im auf nicht ein eine des dem auch für es "
    "le la les de et un une des du en est que qui dans pour sur pas par avec au "
    "el los las y del que en un una por con para su al se no es lo como").split()

BLANKS = r"[ \t-\r]+"


@dataclass(frozen=True)
class Rule:
    """Keep texts whose ``metric`` (an expression over the counts) lies in [low, high]."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


BASE = (
    Rule("words", "n_words", low=50),
    Rule("repeated_words", "100 * n_repeat_words - 50 * n_words", high=0),
)
# Ratios are written as products so that empty texts divide nothing.
RULES = (
    Rule("short_words", "word_chars - 2 * n_words", low=0),
    Rule("long_words", "word_chars - 18 * n_words", high=0),
    Rule("symbols", "10 * n_symbols - 2 * n_words", high=0),
    Rule("stop_words", "100 * n_stop_words - 2 * n_words", low=0),
    Rule("repeated_lines", "10 * n_dup_lines - 5 * n_lines", high=0),
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_stop_words", "n_lines")


def failed(rule: Rule) -> Column:
    metric = F.expr(rule.metric)
    broken = F.lit(False)
    if rule.low is not None:
        broken = broken | (metric < rule.low)
    if rule.high is not None:
        broken = broken | (metric > rule.high)
    return broken


def _is(words: str, x: str, y: str) -> str:
    return " AND ".join(f"get({words}, {x} + {k}) = get({words}, {y} + {k})" for k in range(3))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns of ``COUNTS`` (those of the same names are replaced)."""
    docs = docs.drop(*COUNTS)
    place = "cast(x & _mask AS INT)"
    other = "cast(get(_keys, p + {0}) & _mask AS INT)"
    twin = " OR ".join(
        f"((x | _mask) = (get(_keys, p + {d}) | _mask) AND {_is('_words', place, other.format(d))})"
        for d in (-1, 1))
    stops = sorted({*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)})
    return (
        docs
        .withColumn("_text", F.coalesce(F.col(text), F.lit("")))
        .withColumn("_words", F.array_remove(F.split("_text", BLANKS), ""))
        .withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^ \t-\r]")))
        .withColumn("_mask", F.expr("shiftleft(1L, length(bin(size(_words)))) - 1"))
        .withColumn("_keys", F.expr("""
            sort_array(transform(
                IF(size(_words) >= 3, sequence(0, size(_words) - 3), array()),
                i -> (xxhash64(get(_words, i), get(_words, i + 1), get(_words, i + 2))
                      & ~_mask) | i))"""))
        .withColumn("_starts", F.expr(f"""
            sort_array(transform(filter(_keys, (x, p) -> coalesce({twin}, false)),
                                 x -> x & _mask))"""))
        .withColumns({
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.expr("""
                aggregate(transform(_starts, (s, p) ->
                              least(3L, coalesce(get(_starts, p + 1) - s, 3L))),
                          0L, (a, b) -> a + b)"""),
            "n_stop_words": F.size(F.filter("_words", lambda w: w.isin(stops))).cast("long"),
            "n_lines": F.size("_lines").cast("long")})
        .drop("_text", "_words", "_lines", "_mask", "_keys", "_starts"))


def judge(docs: DataFrame, *, text: str = "text", out: str = "quality",
          rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with a struct ``out``: the counts, failed (rule names), base_failed, kept.

    An input column named like ``out`` is replaced.  Columns named like one of the counts pass
    through unchanged: the counts are taken beside them and end inside the struct.
    """
    own = [c for c in docs.columns if c != out]
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row"),
                       F.col(text).alias("_source"))
    broken = {r.name: failed(r) for r in (*BASE, *rules)}
    base = F.lit(False)
    for rule in BASE:
        base = base | broken[rule.name]
    names = F.array_compact(F.array(*[F.when(x, F.lit(n)) for n, x in broken.items()]))
    # A filter on the verdict must not be pushed into the counts, where it would repeat them
    # inside their own lambdas; the optimizer pushes nothing below a row number.
    judged = (measure(held, "_source").withColumn("_number", F.monotonically_increasing_id())
              .withColumn("_failed", names).withColumn("_base", base))
    return judged.select("_row.*", F.struct(
        *COUNTS, F.col("_failed").alias("failed"), F.col("_base").alias("base_failed"),
        ((F.size("_failed") == 0) & (F.col("_number") >= 0)).alias("kept")).alias(out))


def op3(docs: DataFrame) -> DataFrame:
    """The contract's columns of ``judge`` over documents."""
    return judge(docs.select("doc_id", "text")).select(
        "doc_id", *[f"quality.{c}" for c in COUNTS[:5]], "quality.base_failed", "quality.kept")
