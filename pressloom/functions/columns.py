"""Small building blocks shared by the column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that count as white space when a text is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove white space (Unicode) from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    Column expressions that a lambda captures are evaluated again for each
    element; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def nonempty(text: Column) -> Column:
    """``text``, or null where it is empty."""
    return F.when(text != "", text)


def first_where(array: Column, test: Callable[[Column], Column]) -> Column:
    """First element of ``array`` that satisfies ``test``, else null."""
    return F.get(F.filter(array, test), F.lit(0))


def distinct(values: Column) -> Column:
    """``array_distinct`` by sorting, for elements that are not plain values: there the
    built-in function compares each with each."""
    def firsts(ordered: Column) -> Column:
        kept = F.filter(ordered, lambda x, i: (i == 0) | ~F.get(ordered, i - 1)["value"].eqNullSafe(x["value"]))
        places = F.array_sort(F.transform(kept, lambda x: F.struct(x["place"].alias("place"), x["value"].alias("value"))))
        return F.transform(places, lambda x: x["value"])

    return let(F.array_sort(F.transform(
        values, lambda v, i: F.struct(v.alias("value"), i.alias("place")))), firsts)


def grouped(values: Column, key: str, value: str) -> Column:
    """Elements with the same field ``key``, groups and the values in them in order of
    appearance: ``array<struct<key, values>>``."""
    def runs(ordered: Column) -> Column:
        begins = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda i: (i == 0) | ~F.get(ordered, i)["key"].eqNullSafe(F.get(ordered, i - 1)["key"]))
        found = let(begins, lambda bs: F.transform(bs, lambda at, k: F.struct(
            F.get(ordered, at)["place"].alias("place"), F.get(ordered, at)["key"].alias("key"),
            F.transform(
                F.slice(ordered, at + 1, F.coalesce(F.get(bs, k + 1), F.size(ordered)) - at),
                lambda x: x["value"]).alias("values"))))
        return F.transform(F.array_sort(found), lambda r: F.struct(r["key"].alias("key"), r["values"].alias("values")))

    keyed = F.array_sort(F.transform(values, lambda v, i: F.struct(
        v[key].alias("key"), i.alias("place"), v[value].alias("value"))))
    return let(keyed, lambda ordered: F.when(F.size(ordered) > 0, runs(ordered)))


#: Elements that ``running`` folds at a time.
_TOGETHER = 128


def running(values: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """The states of a fold: one after each element of ``values``.

    An array is copied when it grows, so states are gathered in groups: the time is in
    proportion to the number of elements for any array that fits a row.
    """
    def one(acc: Column, value: Column) -> Column:
        return let(step(acc["at"], value), lambda now: F.struct(
            now.alias("at"), F.concat(acc["out"], F.array(now)).alias("out")))

    def group_of(acc: Column, group: Column) -> Column:
        begin = F.struct(acc["at"].alias("at"), F.filter(F.array(acc["at"]), lambda _: F.lit(False)).alias("out"))
        return F.aggregate(group, begin, one, lambda done: F.struct(
            done["at"].alias("at"), F.concat(acc["out"], F.array(done["out"])).alias("out")))

    def fold(all_values: Column) -> Column:
        last = F.floor((F.size(all_values) - 1) / _TOGETHER).cast("int")
        groups = F.transform(F.sequence(F.lit(0), last), lambda g: F.slice(all_values, g * _TOGETHER + 1, _TOGETHER))
        nothing = F.filter(F.array(F.filter(F.array(start), lambda _: F.lit(False))), lambda _: F.lit(False))
        begin = F.struct(start.alias("at"), nothing.alias("out"))
        return F.when(F.size(all_values) > 0, F.flatten(F.aggregate(groups, begin, group_of, lambda acc: acc["out"])))

    empty = F.filter(F.array(start), lambda _: F.lit(False))
    return F.when(values.isNotNull(), F.coalesce(let(values, fold), empty))


def prefix_sums(counts: Column) -> Column:
    """Sums of the elements before each place and, last, of all: one more than the array
    has elements."""
    return F.concat(F.array(F.lit(0)), running(counts, F.lit(0), lambda total, n: total + n))
