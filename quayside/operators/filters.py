"""Filters and predicates.

Plain ``where`` conditions on columns the scan reads are pushed into the Parquet reader
by Catalyst; keyword tables of any size are matched by joins on short character grams.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions._col import col_of
from quayside.functions.text import contains_any
from quayside.session import shared_scratch


def drop_nulls(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """drop rows with a null in any column of ``subset`` (all columns if None)."""
    return df.dropna(how="any", subset=subset)


def drop_all_null(df: DataFrame, subset: list[str]) -> DataFrame:
    """drop rows where every column of ``subset`` is null."""
    return df.dropna(how="all", subset=subset)


def incomplete_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """rows with a null in any of ``columns`` (a completeness report)."""
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def drop_blank_records(df: DataFrame, line_col: str, blank: str) -> DataFrame:
    """drop records equal to the blank pattern (e.g. ``",,,,,,,"``)."""
    return df.where(F.col(line_col) != F.lit(blank))


# Keywords of one character are looked up before all others, those shorter than SHORT as they
# are, those of LONG characters or more by grams of that size, those between by grams of SHORT.
# Beside a large index those of WIDE or more are looked up by grams of WIDE - STEP + 1 characters,
# STEP neighbours of a keyword's and those of a text that start at every STEP-th character.
SHORT, LONG, WIDE, STEP = 3, 6, 12, 4
INDEX_BYTES = 32 << 20  # an index up to this size is broadcast
FILTER_WORDS = 1 << 21  # 64-bit words of a filter of hashes at most: 16 MB
COUNTERS = 1 << 20  # of hashed grams at most: 8 MB


def _grams(text: str, n: int) -> Column:
    """The overlapping character grams of a text column, in one pass of the text."""
    if n == 1:
        return F.split(text, "")
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))


def _grams_by_steps(text: str) -> Column:
    """The grams of WIDE - STEP + 1 characters that start at every STEP-th one of a text column."""
    return F.regexp_extract_all(
        text, F.lit(f"(?s)(?=(.{{{WIDE - STEP + 1}}})).{{{STEP}}}"), F.lit(1))


def _in_one_array(values: DataFrame, combined: Column, power: int) -> Column:
    """``combined`` of (slot, value) by slot, for all slots below 2^power in order.

    A slot without rows has the value 0.  Every task gets the array, as a scalar subquery.
    """
    slots = (values.union(values.sparkSession.range(1 << power).select(
        F.col("id").cast("int").alias("slot"), F.lit(0).cast("bigint").alias("value")))
             .groupBy("slot").agg(combined.alias("value")))
    runs = slots.groupBy(F.shiftright("slot", 10).alias("run")).agg(
        F.sort_array(F.collect_list(F.struct("slot", "value")))["value"].alias("values"))
    return runs.agg(F.flatten(
        F.sort_array(F.collect_list(F.struct("run", "values")))["values"])).scalar()


def _power(n: int) -> int:
    return max(10, n.bit_length() - 1)


def _slot(hashed: Column, power: int) -> Column:
    return F.shiftrightunsigned(hashed, 64 - power).cast("int")


def rarest_grams(keywords: DataFrame, keyword_col: str, gram: int = LONG,
                 n: int | None = None) -> DataFrame:
    """(keyword, gram): of each keyword's grams the one that fewest keywords have.

    Keywords shorter than ``gram`` are not in it.  Ties go to the least gram.  Grams are counted
    by their hashes, those that share a counter as one.  There are 8 to 16 counters for each of the
    ``n`` rows of ``keywords`` (counted if not given), COUNTERS at most.  Every task gets them all,
    so that neither keywords nor grams move to meet their counts.
    """
    power = _power(min(COUNTERS, 16 * (keywords.count() if n is None else n)))
    words = (keywords.select(F.col(keyword_col).alias("keyword")).distinct()
             .where(F.length("keyword") >= gram))
    grams = F.array_sort(F.array_distinct(_grams("keyword", gram)))
    slot = _slot(F.xxhash64("gram"), power)
    each = words.select("keyword", F.posexplode(grams).alias("place", "gram"))
    counts = _in_one_array(each.select(slot.alias("slot"), F.lit(1).cast("bigint").alias("value")),
                           F.sum("value"), power)
    n_and_place = F.shiftleft(F.least(F.get(counts, slot), F.lit(2**31 - 1)), 32) + F.col("place")
    best = each.select("keyword", n_and_place.alias("best")).groupBy("keyword").agg(
        F.min("best").bitwiseAND(2**32 - 1).cast("int").alias("place"))
    return best.select("keyword", F.get(grams, "place").alias("gram"))


def _written(df: DataFrame, name: str) -> DataFrame:
    folder = shared_scratch(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def keyword_index(keywords: DataFrame, keyword_col: str = "keyword") -> DataFrame:
    """(gram, keyword, size, start): the hash of the gram that each keyword is looked up by.

    ``start`` is where the first of STEP longer grams around that one starts, null for keywords
    shorter than WIDE.
    """
    n = keywords.count()
    words = (keywords.select(F.col(keyword_col).cast("string").alias("keyword"))
             .where(F.length("keyword") > 0).distinct())
    length = F.length("keyword")
    none = F.lit(None).cast("int").alias("start")
    parts = [words.where(length < SHORT).select(
        F.xxhash64("keyword").alias("gram"), "keyword", length.alias("size"), none)]
    around = F.greatest(F.lit(1), F.least(F.expr(f"locate(gram, keyword) - {STEP - 1}"),
                                          length - (WIDE - 1)))
    for size, fits, start in (
            (SHORT, (length >= SHORT) & (length < LONG), none),
            (LONG, length >= LONG, F.when(length >= WIDE, around).alias("start"))):
        parts.append(rarest_grams(words.where(fits), "keyword", size, n).select(
            F.xxhash64("gram").alias("gram"), "keyword", F.lit(size).alias("size"), start))
    return reduce(DataFrame.union, parts)


def may_hold(hashes: DataFrame, n: int, column: str) -> Column:
    """True where a bigint column is one of the ``n`` rows of ``hashes``, and for few others.

    A filter of three bits a hash in one 64-bit word, for two to four hashes a word or, with
    over four times FILTER_WORDS of them, more: it is then less sharp, never wrong.  Words are
    kept inverted.
    """
    power = _power(min(FILTER_WORDS, n // 2))

    def bits(hashed):
        return F.expr(" | ".join(f"shiftleft(1L, cast(shiftright({hashed}, {k}) & 63 as int))"
                                 for k in (0, 6, 12)))

    (name,) = hashes.columns
    words = _in_one_array(
        hashes.select(_slot(F.col(name), power).alias("slot"), bits(name).alias("value")),
        F.bitwise_not(F.bit_or("value")), power)
    return F.get(words, _slot(F.col(column), power)).bitwiseAND(bits(column)) == 0


def keyword_hits(texts: DataFrame, text_col: str, keywords: DataFrame,
                 keyword_col: str = "keyword", index_bytes: int = INDEX_BYTES) -> DataFrame:
    """The distinct values of ``text_col`` that contain any keyword of a table of any size.

    Keywords of one character are looked up first, as they have most hits and a text few
    characters; the grams of the texts left, of those sizes that keywords have, meet the written
    index of each keyword's rarest gram, and ``contains`` verifies.  No keyword goes through the
    driver, and no text meets a keyword whose rarest gram it lacks.

    An index of at most ``index_bytes`` is broadcast, so neither grams nor texts move for it, and
    each distinct text is looked at once.  A larger one is parted by the size of its grams, see
    :func:`_hits_of_large_index`.
    """
    index = _written(keyword_index(keywords, keyword_col), "keyword-index")
    size = F.when(F.col("start").isNotNull(), WIDE).otherwise(F.col("size"))
    held = index.groupBy(size.alias("size")).agg(
        F.sum(F.octet_length("keyword") + 48).alias("bytes"),
        F.count("*").alias("n")).collect()  # five rows at most
    sizes = sorted({min(r["size"], LONG) for r in held if r["size"] > 1})
    found = texts.select(F.col(text_col).alias("text")).where(F.length("text") > 0)
    letters = any(r["size"] == 1 for r in held)
    small = sum(r["bytes"] for r in held if r["size"] > 1) <= index_bytes
    if letters or small:
        found = found.distinct()
    marked = found.withColumn("hit", F.lit(None).cast("boolean"))
    if letters:
        each = F.explode(F.array_distinct(_grams("text", 1))).alias("keyword")
        settled = (found.select("text", each)
                   .join(index.where("size = 1"), "keyword", "left_semi")
                   .select("text").distinct().withColumn("hit", F.lit(True)))
        marked = found.join(settled, "text", "left")
    if not sizes:
        return marked.where("hit").select(F.col("text").alias(text_col))
    if small:
        grams = F.concat(*[_grams("text", size) for size in sizes])
        longer = index.where("size > 1").select(F.col("gram").alias("at"), "keyword")
        met = marked.select("text", "hit", F.explode_outer(
            F.when(F.col("hit").isNull(), grams)).alias("gram"))
        met = met.join(F.broadcast(longer), (F.xxhash64("gram") == F.col("at"))
                       & F.contains("text", "keyword"), "left")
        hits = met.where("hit OR keyword IS NOT NULL").select("text").distinct()
    else:
        if letters:
            marked = _written(marked, "keyword-texts")
        wide = F.array(*[F.xxhash64(F.expr(f"substring(keyword, start + {k}, {WIDE - STEP + 1})"))
                         for k in range(STEP)])
        longer = index.where("size > 1").select(size.alias("size"), F.explode(F.when(
            F.col("start").isNotNull(), wide).otherwise(F.array("gram"))).alias("at"), "keyword")
        parts = sorted((r["size"], r["bytes"], r["n"]) for r in held if r["size"] > 1)
        hits = _hits_of_large_index(marked.where("hit IS NULL").select("text"), longer, parts,
                                    index_bytes)
        if letters:
            hits = marked.where("hit").select("text").union(hits)
    return hits.select(F.col("text").alias(text_col))


def _hits_of_large_index(texts: DataFrame, index: DataFrame, parts: list[tuple[int, int, int]],
                         index_bytes: int) -> DataFrame:
    """The distinct texts that contain a keyword of ``index``: (size, at, keyword).

    ``parts`` are (size, bytes, keywords) by size.  Texts have most hits of short grams: those
    parts whose bytes add up to ``index_bytes`` at most are broadcast, never the last one.  Of the
    other grams a filter leaves those that the index may have; their hashes are shuffled, and only
    texts that have one in the index are fetched, to be verified.  ``texts`` are read three times,
    and repeated ones are looked at each time, as it would take a shuffle of all texts to tell.
    """
    near = [size for k, (size, _, _) in enumerate(parts)
            if sum(p[1] for p in parts[:k + 1]) <= index_bytes]
    far = [size for size, _, _ in parts if size not in near]
    hits = []
    if near:
        grams = F.explode(F.concat(*[_grams("text", size) for size in near])).alias("gram")
        hits.append(texts.select("text", grams).join(
            F.broadcast(index.where(F.col("size").isin(near))),
            (F.xxhash64("gram") == F.col("at")) & F.contains("text", "keyword"), "left_semi"))
    if far:
        longer = index.where(F.col("size").isin(far)).select("at", "keyword")
        keyed = texts.select("text", F.xxhash64("text").alias("key"))
        grams = F.concat(*[_grams_by_steps("text") if size == WIDE else _grams("text", size)
                           for size in far])
        seen = keyed.select("key", F.explode(grams).alias("gram")).select(
            "key", F.xxhash64("gram").alias("at"))
        n = sum(p[2] * (STEP if p[0] == WIDE else 1) for p in parts if p[0] in far)
        seen = _written(seen.where(may_hold(longer.select("at"), n, "at")).distinct(),
                        "keyword-grams")
        longer = longer.where(may_hold(seen.select("at"), seen.count(), "at"))
        candidates = _written(seen.join(longer.hint("merge"), "at")
                              .select("key", "keyword").distinct(), "keyword-candidates")
        fetched = keyed.where(may_hold(candidates.select("key"), candidates.count(), "key"))
        hits.append(fetched.distinct().alias("f").join(
            candidates.hint("merge").alias("c"), (F.col("f.key") == F.col("c.key"))
            & F.contains("text", "keyword"), "left_semi"))
    return reduce(DataFrame.union, [h.select("text") for h in hits]).distinct()


def exclude_keywords(df: DataFrame, text_col: str, keywords,
                     keyword_col: str = "keyword") -> DataFrame:
    """drop rows whose text contains any keyword anywhere (case-sensitive).

    ``keywords`` is a list (one filter expression in the scan's stage) or a keyword table of
    any size (:func:`keyword_hits` and an anti-join).  A null text contains no keyword.
    """
    if isinstance(keywords, DataFrame):
        return df.join(keyword_hits(df, text_col, keywords, keyword_col), text_col, "left_anti") \
            .select(*df.columns)
    needles = [k for k in dict.fromkeys(keywords) if k]
    return df.where(~F.coalesce(contains_any(text_col, needles), F.lit(False)))


def regex_full_match(c, pattern: str) -> Column:
    """the whole value matches ``pattern`` (anchored)."""
    body = pattern[1:] if pattern.startswith("^") else pattern
    if body.endswith("$") and not body.endswith("\\$"):
        body = body[:-1]
    body = "^(?:" + body + ")$"
    return col_of(c).rlike(body)


def any_cell_contains(columns: list[str], needle: str) -> Column:
    """F8: true when any of ``columns`` (as text) contains ``needle``."""
    return reduce(lambda a, b: a | b, [
        F.coalesce(F.col(c).cast("string").contains(needle), F.lit(False)) for c in columns])


def label_in(c, labels: list[str]) -> Column:
    """the value is one of ``labels``."""
    return col_of(c).isin(labels)
