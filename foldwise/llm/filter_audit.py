"""What each of several filters removes, in every order, by counting paths in their lattice.

Filters are applied one after another; a state of the lattice is the set of filters applied
so far, an edge applies one more. What an edge removes does not depend on the order in which
its state was reached, so all orders are read from ``k * 2**(k - 1)`` edges:

* rows are counted once by part and by the set of conditions they fail;
* each such set adds its count to the edges that remove it;
* an order is a path from no filter to all: its steps are read from the edges it takes;
* forward counts say how many orders reach a state, backward counts how many leave it; their
  product at the two ends of an edge is the number of orders that take it. Removals weighted
  by it and summed over a filter's edges are its Shapley value times the number of orders.

The lattice is small and fixed by the number of filters; only counts by part and set of failed
conditions meet it, after partial aggregation, so a part of any size costs no more.

Nulls: a condition that is null does not fail; a null mark does not count. In
``text_conditions`` a null text counts as empty; a row whose id is null repeats nothing and is
repeated by nothing; rows that share id and text do not repeat one another. Several labels of
one id mark a row if any of them does. An empty table gives an empty result. Extra columns are
ignored, whatever their names.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foldwise.llm.periodic_runs import word_names
from foldwise.llm.shared import Scratch, settle
from foldwise.llm.textbytes import chunks, pick

#: Orders grow as the factorial of the filters.
MAX_FILTERS = 7
_UPPER = np.isin(np.arange(256), np.arange(65, 91))
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#$%&*|", np.uint8))


def path_counts(k: int) -> tuple[list[int], list[int]]:
    """How many orders of ``k`` filters reach each state, and how many leave it to the end."""
    size = 1 << k
    forward, backward = [0] * size, [0] * size
    forward[0] = backward[-1] = 1
    for state in range(size):
        for f in range(k):
            if state >> f & 1:
                forward[state] += forward[state ^ 1 << f]
    for state in reversed(range(size)):
        for f in range(k):
            if not state >> f & 1:
                backward[state] += backward[state | 1 << f]
    return forward, backward


def edges(k: int) -> list[tuple[int, int, int]]:
    """State, filter and number of orders of every edge of the lattice."""
    forward, backward = path_counts(k)
    return [(state, f, forward[state] * backward[state | 1 << f])
            for state in range(1 << k) for f in range(k) if not state >> f & 1]


def steps(names: list[str]) -> list[tuple[str, int, int, int]]:
    """Order, step, state before it and filter, for all orders."""
    out = []
    for order in permutations(range(len(names))):
        state = 0
        for i, f in enumerate(order):
            out.append(("".join(names[g] for g in order), i + 1, state, f))
            state |= 1 << f
    return out


def audit(rows: DataFrame, part: str, failing: dict[str, Column], marks: dict[str, Column]
          ) -> DataFrame:
    """Counts per part, order of filters and step.

    ``failing`` names a condition per filter, ``marks`` the boolean columns whose losses are
    counted. Returns ``part, filter_order string, step int, kept, removed, redundant,
    unique_fails long``, a long ``<mark>_lost`` each, and ``shapley long`` (the filter's
    removals summed over all orders).
    """
    names = list(failing)
    if not 1 <= len(names) <= MAX_FILTERS:
        raise ValueError(f"from 1 to {MAX_FILTERS} filters, not {len(names)}")
    mask = sum((F.when(c, 1 << f).otherwise(0) for f, c in enumerate(failing.values())), F.lit(0))
    counts = rows.select(F.col(part).alias("part"), mask.alias("mask"), *[
        F.when(c, 1).otherwise(0).alias(f"mark{i}") for i, c in enumerate(marks.values())])
    counts = counts.groupBy("part", "mask").agg(
        F.count("*").alias("n"), *[F.sum(f"mark{i}").alias(f"mark{i}") for i in range(len(marks))])
    counts = settle(counts, "filter-sets").df  # as many rows per part as sets of conditions

    spark, k = rows.sparkSession, len(names)
    lattice = F.array(*[F.struct(F.lit(s).alias("state"), F.lit(f).alias("filter"),
                                 F.lit(1 << f).alias("bit"), F.lit(w).alias("orders"))
                        for s, f, w in edges(k)])
    met = counts.select("*", F.explode(lattice).alias("e")).select("*", "e.*").drop("e")
    here = F.expr("mask & state = 0")
    hit = F.expr("mask & bit <> 0")

    def total(when: Column, value: str = "n") -> Column:
        return F.sum(F.when(when, F.col(value)).otherwise(0))

    taken = met.groupBy("part", "state", "filter", "orders").agg(
        total(here & ~hit).alias("kept"), total(here & hit).alias("removed"),
        total(~here & hit).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        *[total(here & hit, f"mark{i}").alias(f"{m}_lost") for i, m in enumerate(marks)])
    taken = taken.withColumn("shapley", F.sum(F.col("removed") * F.col("orders")).over(
        W.partitionBy("part", "filter")))
    walked = spark.createDataFrame(steps(names), "filter_order string, step int, state int, filter int")
    return taken.join(F.broadcast(walked), ["state", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
        *[f"{m}_lost" for m in marks], "shapley")


def text_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  part_col: str = "source") -> DataFrame:
    """Counts per text and a fingerprint, without the text.

    Returns ``id, part string`` (null read as empty), ``fingerprint string`` (SHA-256), and long
    ``n_words, n_distinct`` (different words), ``n_chars`` (code points), ``n_upper`` and
    ``n_symbols``.
    """
    held = F.coalesce(F.col(text_col), F.lit(""))
    source = pick(docs, id_col, text_col, part_col).select(
        F.col(id_col).cast("long").alias("id"), held.alias("text"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.sha2(held, 256).alias("fingerprint"))

    def measure(batches):
        for chunk in chunks(batches):
            names = np.unique(word_names(chunk))
            yield pa.RecordBatch.from_pydict({
                "id": chunk.rows.column(0), "part": chunk.rows.column(2),
                "fingerprint": chunk.rows.column(3),
                "n_words": pa.array(chunk.per_text(chunk.words[2]), pa.int64()),
                "n_distinct": pa.array(chunk.per_text(names % max(len(chunk), 1)), pa.int64()),
                "n_chars": pa.array(chunk.chars_before[chunk.ends] - chunk.chars_before[chunk.starts]),
                "n_upper": pa.array(chunk.count(_UPPER[chunk.data])),
                "n_symbols": pa.array(chunk.count(_SYMBOL[chunk.data]))})

    return source.mapInArrow(measure, (
        "id long, part string, fingerprint string, n_words long, n_distinct long, n_chars long, "
        "n_upper long, n_symbols long"))


def text_conditions() -> dict[str, Column]:
    """The five conditions under which a text of ``text_measures`` fails.

    ``first`` is the smallest id that has the text, where that is the row's own.
    """
    return {
        "A": F.col("n_words") < 50,
        "B": 100 * F.col("n_distinct") < 65 * F.col("n_words"),
        "C": 100 * F.col("n_upper") > 5 * F.col("n_chars"),
        "D": F.col("n_symbols") > 0,
        "E": F.col("id").isNotNull() & F.col("first").isNull(),
    }


def audit_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Audit of the five text filters, with the good and the toxic rows that each step loses."""
    scratch, kept = Scratch(docs.sparkSession), ()
    try:
        rows = scratch.write(text_measures(docs, id_col, text_col, part_col), "text-measures")
        # Joined on both columns, so that a text of any number of copies is spread by its ids.
        first = (rows.where("id is not null").groupBy("fingerprint")
                 .agg(F.min("id").alias("id")).withColumn("first", F.col("id")))
        told = pick(labels, "doc_id", "quality", "toxic").groupBy(F.col("doc_id").alias("id")).agg(
            F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
        rows = rows.join(first, ["fingerprint", "id"], "left").join(told, "id", "left")
        found = audit(rows, "part", text_conditions(),
                      {"good": F.col("good"), "toxic": F.col("toxic")})
        kept = (found,)
        return found
    finally:
        scratch.drop(kept)
