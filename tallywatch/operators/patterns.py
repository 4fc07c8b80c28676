"""Sequences of events per key, found by an automaton that runs in blocks.

What a block of rows does to an automaton is a function from the state before it to the
state after it, and such functions compose. So rows are folded in blocks, the blocks'
functions in blocks of blocks, up to one per key; then the states before each block come
down the same way, and each block of rows is read once more from its known state. No
task sees more than ``BLOCK`` rows of a key at a time, however many the key has.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch import session
from tallywatch.operators.spread import HOT_ROWS, position
from tallywatch.session import pinned

BLOCK = 64  # rows, or functions, that are folded at once


@dataclass(frozen=True)
class Automaton:
    """``next[state][symbol]``; it begins in 0, and a row that leads to ``accept`` ends a match."""

    next: tuple[tuple[int, ...], ...]
    accept: int


def in_sequence(symbols: Sequence[int], alphabet: int, reset: Sequence[int] = ()) -> Automaton:
    """Finds ``symbols`` one after the other, whatever lies between.

    ``alphabet``: how many symbols there are. Symbols of ``reset`` that are not the next
    one wanted begin the search anew. A match ends the search; the next begins after it.
    """
    n = len(symbols)
    rows = [
        tuple(s + 1 if c == symbols[s] else 0 if c in reset else s for c in range(alphabet))
        for s in range(n)
    ]
    return Automaton((*rows, rows[0]), n)  # after a match as at the beginning


def _table(automaton: Automaton) -> Column:
    """For each symbol, the next state of every state."""
    alphabet = len(automaton.next[0])
    by_symbol = [F.array(*(F.lit(row[c]) for row in automaton.next)) for c in range(alphabet)]
    return F.array(*by_symbol)


def match_ends(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    tie: str,
    symbol: Column,
    automaton: Automaton,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """``keys, order, tie`` of the rows that end a match of ``automaton``.

    Rows of a key go by (order, tie), the tie being unique; ``symbol`` is a whole number
    from 0. Rows whose symbol is null or outside the alphabet change nothing. Rows with
    a null key take no part. An empty table has no matches.
    """
    keys = list(keys)
    alphabet, states = len(automaton.next[0]), len(automaton.next)
    known = F.when((symbol >= 0) & (symbol < alphabet), symbol.cast("int"))
    rows = df.select(*keys, order, tie, known.alias("__symbol")).dropna(subset=keys)
    # numbering reads them several times, and they may come from windows of their own
    rows = session.pinned(rows.filter("__symbol is not null"), "symbols")
    rows = position(rows, keys, order, tie, "__pos", hot_rows)
    rows = rows.withColumn("__block", F.floor((F.col("__pos") - 1) / BLOCK))
    table, same = _table(automaton), F.array(*(F.lit(s) for s in range(states)))

    def after(state: Column, symbol_: Column) -> Column:
        return F.element_at(F.element_at(table, symbol_ + 1), state + 1)

    def composed(f: Column, g: Column) -> Column:
        return F.transform(f, lambda s: F.element_at(g, s + 1))

    # up: what each block does to every state
    held = F.sort_array(F.collect_list(F.struct("__pos", order, tie, "__symbol")))
    level = rows.groupBy(*keys, "__block").agg(held.alias("__rows"))
    done = F.aggregate("__rows", same, lambda f, r: F.transform(f, lambda s: after(s, r["__symbol"])))
    levels = [pinned(level.withColumn("__f", done), "blocks")]
    while (levels[-1].agg(F.max("__block")).first()[0] or 0) > 0:
        held = F.sort_array(F.collect_list(F.struct("__block", "__f")))
        level = levels[-1].groupBy(*keys, F.floor(F.col("__block") / BLOCK).alias("__up"))
        level = level.agg(held.alias("__parts")).withColumnRenamed("__up", "__block")
        done = F.aggregate("__parts", same, lambda f, part: composed(f, part["__f"]))
        levels.append(pinned(level.withColumn("__f", done), "blocks"))

    # down: the state before each block
    before = levels[-1].select(*keys, "__block", F.lit(0).alias("__state"))
    for level in levels[:0:-1]:
        begin = F.struct(F.col("__state"), F.array().cast("array<struct<__block:bigint,__state:int>>"))
        passed = F.aggregate(
            "__parts",
            begin.cast("struct<s:int,found:array<struct<__block:bigint,__state:int>>>"),
            lambda acc, part: F.struct(
                F.element_at(part["__f"], acc["s"] + 1).alias("s"),
                F.array_append(
                    acc["found"], F.struct(part["__block"].alias("__block"), acc["s"].alias("__state"))
                ).alias("found"),
            ),
        )
        states_ = level.join(before, [*keys, "__block"]).select(*keys, passed["found"].alias("__found"))
        before = states_.select(*keys, F.inline("__found"))

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    hit = f"struct<{order}:{kinds[order]},{tie}:{kinds[tie]}>"
    begin = F.struct(F.col("__state"), F.array().cast(f"array<{hit}>"))

    def step(acc: Column, r: Column) -> Column:
        state = after(acc["s"], r["__symbol"])
        found = F.struct(r[order].alias(order), r[tie].alias(tie))
        hits = F.when(state == automaton.accept, F.array_append(acc["hits"], found)).otherwise(acc["hits"])
        return F.struct(state.alias("s"), hits.alias("hits"))

    read = F.aggregate("__rows", begin.cast(f"struct<s:int,hits:array<{hit}>>"), step)
    ends = levels[0].join(before, [*keys, "__block"]).select(*keys, read["hits"].alias("__hits"))
    return ends.select(*keys, F.inline("__hits"))
