"""Keyed permutations of 0 .. n-1 as column expressions.

A shuffle whose order is arithmetic: the place of a chunk in its shard's shuffled
order, and the chunk at a place, follow from the key, ``n`` and the number alone, so
no sort, no stored order and no other row is needed, and reading can start anywhere.

A Feistel network over two digits of sizes a and b, a * b >= n: a round adds a hash
of one digit to the other, modulo its size, which can be undone.  a * b exceeds n by
less than a (about the root of n); numbers that fall in between walk on along their
cycle until they are below n, a step that one in a needs.

The hash is md5 of ``key|round|digit``, its first 15 hex digits; the key holds
seed, epoch and shard, so every epoch has an order of its own.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: rounds of the network (even, so that the digits end in their places).
ROUNDS = 6


def _sizes(n: Column) -> tuple[Column, Column]:
    a = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    a = F.greatest(a, F.lit(1).cast("long"))
    return a, F.floor((n + a - 1) / a).cast("long")


def _hash(key: Column, number: Column, digit: Column) -> Column:
    text = F.concat_ws("|", key, number.cast("string"), digit.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _network(x: Column, key: Column, a: Column, b: Column, undo: bool) -> Column:
    """One pass over 0 .. a*b-1, or its inverse."""

    def step(state: Column, number: Column) -> Column:
        u, v = state["u"], state["v"]
        size = F.when(number % 2 == 0, a).otherwise(b)  # of the digit that changes
        if undo:
            return F.struct(F.pmod(v - _hash(key, number, u), size).alias("u"), u.alias("v"))
        return F.struct(v.alias("u"), ((u + _hash(key, number, v)) % size).alias("v"))

    rounds = range(ROUNDS - 1, -1, -1) if undo else range(ROUNDS)
    first = F.struct(F.floor(x / b).cast("long").alias("u"), (x % b).alias("v"))
    return F.aggregate(F.array(*map(F.lit, rounds)), first, step, lambda s: s["u"] * b + s["v"])


def _permuted(x: Column, n: Column, key: Column, undo: bool) -> Column:
    n, x = n.cast("long"), x.cast("long")
    a, b = _sizes(n)

    def step(state: Column, _number: Column) -> Column:
        return F.when(state < n, state).otherwise(_network(state, key, a, b, undo))

    def walked(first: Column) -> Column:  # one number in a comes here; the cycle leaves the gap in a * b - n steps
        return F.aggregate(F.sequence(F.lit(1).cast("long"), a * b - n), first, step)

    once = F.transform(F.array(_network(x, key, a, b, undo)), lambda y: F.when(y < n, y).otherwise(walked(y)))  # y is computed once
    return F.when((x >= 0) & (x < n), once[0])


def place_of(x: Column, n: Column, key: Column) -> Column:
    """Place of number ``x`` in the order that ``key`` gives to 0 .. n-1 (null outside)."""
    return _permuted(x, n, key, False)


def at_place(place: Column, n: Column, key: Column) -> Column:
    """The number at ``place``: the inverse of ``place_of``."""
    return _permuted(place, n, key, True)
