"""Audit of filters in every order, by the potential of the removal game.

A coalition is a set of filters; its worth ``v(S)`` is the number of documents that at least
one filter of ``S`` fails.  Everything the audit reports follows from the worths of the 32
coalitions of five filters, so no order is ever run:

* after the filters ``S`` of an order's first steps, ``n - v(S)`` documents are kept, and a step
  removes ``v(S + f) - v(S)``; the same differences over the good and the toxic documents give
  what the step loses of them;
* the Hart-Mas-Colell potential ``P(S) = (v(S) + sum of P(S - i) over i in S) / |S|``, computed
  coalition by coalition, gives a filter's Shapley value as ``P(all) - P(all - f)``.  Its
  multiple by the number of orders is whole and is kept as an integer throughout.

The texts are read once: per row the verdicts of the filters that look at one text, and the
text's SHA-256 for the filter that compares texts.  Rows of one id and text are counted before
anything is joined.  The smallest id of each text comes from an aggregation with partial minima
and is joined back on text *and* id, so a text that a third of the rows share is not gathered.

Defined cases: a null text is the empty text; a null id is in no order with others, so such a row
is never a later copy and makes none; equal ids with equal texts are not copies of each other
(no *smaller* id has the text); a null part and an empty one are both the part ``''``; several
labels of an id count if any of them is set; an empty table gives no rows; other columns play no
part, whatever their names.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.llm.common import staged

#: Filters in the order of their bits.  The fifth compares texts over the whole table.
FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_UPPER = 200, 50, 2
SYMBOLS = r"[#$%&*|]"


def text_failures(text: Column) -> list[Column]:
    """Failure of filters A to D: few words, few distinct words, many capitals, a symbol."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    upper = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return [n < MIN_WORDS, 100 * distinct < MIN_DISTINCT * n, 100 * upper > MAX_UPPER * F.length(text), text.rlike(SYMBOLS)]


def _mask(failures: Sequence[Column]) -> Column:
    out = F.lit(0)
    for k, c in enumerate(failures):
        out = out + F.when(c, 1 << k).otherwise(0)
    return out


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, n_good, n_toxic``: rows of each part by the set of filters they fail."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.select("doc_id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("name"), _mask(text_failures(F.col("text"))).alias("mask"))
    rows = staged(rows.groupBy("doc_id", "part", "name", "mask").agg(F.count(F.lit(1)).alias("n")), "failures")
    first = rows.groupBy("name").agg(F.min("doc_id").alias("doc_id"))
    first = first.filter("doc_id IS NOT NULL").withColumn("is_first", F.lit(True))
    marks = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = rows.join(first, ["name", "doc_id"], "left").join(marks.filter("good = 1 OR toxic = 1"), "doc_id", "left")
    copy = F.col("is_first").isNull() & F.col("doc_id").isNotNull()
    mask = F.col("mask") + F.when(copy, 1 << 4).otherwise(0)
    return rows.groupBy("part", mask.alias("mask")).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good") == 1, F.col("n")).otherwise(0)).alias("n_good"),
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("n_toxic"))


def worths(counts: DataFrame, filters: int = len(FILTERS)) -> DataFrame:
    """Per part: ``n`` and, for all, good and toxic rows, an array of the worth of every
    coalition (at its bit mask): ``v``, ``v_good``, ``v_toxic``."""
    def game(c: str) -> Column:
        return F.array(*[F.sum(F.when(F.col("mask").bitwiseAND(s) != 0, F.col(c)).otherwise(0)) for s in range(1 << filters)])

    return counts.groupBy("part").agg(F.sum("n").alias("n"), game("n").alias("v"), game("n_good").alias("v_good"), game("n_toxic").alias("v_toxic"))


def potentials(v: str, filters: int = len(FILTERS)) -> Column:
    """The potential of every coalition (at its bit mask), times the number of orders.  A
    coalition's subsets have smaller masks, so one pass in the order of masks computes them."""
    orders = math.factorial(filters)
    smaller = "+".join(f"IF(s & {1 << k} != 0, p[s ^ {1 << k}], 0)" for k in range(filters))
    return F.expr(f"aggregate(sequence(1, {(1 << filters) - 1}), array(0L), "
                  f"(p, s) -> concat(p, array(CAST(({orders} * {v}[s] + {smaller}) DIV bit_count(s) AS BIGINT))))")


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each ``part`` (source), ``filter_order`` and ``step``."""
    games = worths(failure_counts(docs, labels)).withColumn("p", potentials("v"))
    steps, everything = [], (1 << len(FILTERS)) - 1
    for order in itertools.permutations(range(len(FILTERS))):
        before, name = 0, "".join(FILTERS[k] for k in order)
        for step, k in enumerate(order, 1):
            steps.append(F.struct(F.lit(name).alias("filter_order"), F.lit(step).alias("step"), F.lit(before).alias("before"), F.lit(1 << k).alias("bit")))
            before |= 1 << k
    df = games.withColumn("s", F.explode(F.array(*steps))).select("*", "s.*")
    at = lambda game, coalition: F.expr(f"{game}[{coalition}]")
    removed = at("v", "before | bit") - at("v", "before")
    return df.select(
        "part", "filter_order", "step", (F.col("n") - at("v", "before | bit")).alias("kept"), removed.alias("removed"),
        (at("v", "bit") - removed).alias("redundant"), (at("v", everything) - at("v", f"{everything} ^ bit")).alias("unique_fails"),
        (at("v_good", "before | bit") - at("v_good", "before")).alias("good_lost"),
        (at("v_toxic", "before | bit") - at("v_toxic", "before")).alias("toxic_lost"),
        (at("p", everything) - at("p", f"{everything} ^ bit")).alias("shapley"))


#: Every order is run on every document, step by step.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), firsts AS (
  SELECT text, min(doc_id) AS first_id FROM d GROUP BY text
), marks AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), fails AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CAST(len(words) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(words)) < 50 * len(words) AS INT)
         + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS INT)
         + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(doc_id > first_id, false) AS INT) AS mask,
         count(*) AS n
  FROM d JOIN firsts USING (text) LEFT JOIN marks USING (doc_id) GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), bits AS (
  SELECT filter_order, g.step AS step, 1 << (ascii(filter_order[g.step]) - 65) AS own FROM orders, generate_series(1, 5) AS g(step)
), steps AS (
  SELECT *, coalesce(sum(own) OVER (PARTITION BY filter_order ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS earlier
  FROM bits
), runs AS (
  SELECT part, filter_order, step, own, n, good, toxic, mask, mask & own != 0 AS fails_it, mask & earlier != 0 AS gone
  FROM fails, steps
), counted AS (
  SELECT part, filter_order, step, own,
         CAST(coalesce(sum(n) FILTER (NOT gone AND NOT fails_it), 0) AS BIGINT) AS kept,
         CAST(coalesce(sum(n) FILTER (NOT gone AND fails_it), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(n) FILTER (gone AND fails_it), 0) AS BIGINT) AS redundant,
         CAST(coalesce(sum(n) FILTER (mask = own), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(n) FILTER (NOT gone AND fails_it AND good), 0) AS BIGINT) AS good_lost,
         CAST(coalesce(sum(n) FILTER (NOT gone AND fails_it AND toxic), 0) AS BIGINT) AS toxic_lost
  FROM runs GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""
