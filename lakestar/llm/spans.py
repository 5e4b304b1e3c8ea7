"""Where a pattern matches, as built-in expressions: places in code points, end exclusive."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ONE = "struct<kind:string,start:int,end:int,value:string>"
SPAN = f"array<{ONE}>"


#: Items that are folded with one accumulator. Each step of `aggregate` copies what has been gathered so far.
BLOCK = 64


def fold(items: Column, start: Column, move, step, kind: str, finish=None, context=None) -> Column:
    """A fold with a state and an array of results, in time that grows with the number of items.

    A first pass carries the state alone, `move(state, item)`, and notes it before each block of items. Then
    each block is folded from its state into an array of its own, and the arrays are joined:
    `step(acc, item, context)` returns a struct of `state` and `out`, an array of `kind`. `context(state,
    items)` is worked out once for a block; `finish(state, out)` gets the last state and all results.
    """
    none = F.array().cast(f"array<{kind}>")
    finish = finish or (lambda state, out: out)
    once = lambda value, use: F.transform(F.array(value), use)[0]

    def whole(every: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(every) - 1) / BLOCK).cast("int"))
        numbers = F.when(F.size(every) > 0, numbers).otherwise(F.array().cast("array<int>"))

        def part(i: Column) -> Column:
            """A block's items by their place, as a slice takes as long as the whole array."""
            upto = F.least((i + 1) * BLOCK, F.size(every))
            return F.transform(F.sequence(i * BLOCK, upto - 1), lambda j: F.get(every, j))

        after = lambda acc, i: F.array_append(acc, F.aggregate(part(i), F.element_at(acc, -1), move))
        states = F.aggregate(numbers, F.array(start), after)

        def gathered(states: Column) -> Column:
            def block(i: Column) -> Column:
                state = F.get(states, i)
                first = F.struct(state.alias("state"), none.alias("out"))

                def run(known: Column) -> Column:
                    return F.aggregate(known["items"], first, lambda a, x: step(a, x, known["of"]), lambda a: a["out"])

                if context is None:
                    return F.aggregate(part(i), first, lambda a, x: step(a, x, F.lit(0)), lambda a: a["out"])
                return once(part(i), lambda found: once(F.struct(found.alias("items"), context(state, found).alias("of")), run))

            return finish(F.element_at(states, -1), F.flatten(F.transform(numbers, block)))

        return once(states, gathered)

    # The items are worked out once.
    return once(items, whole)


def spans(text: Column, kind: str, pattern: str, keep=None, group: int = 0) -> Column:
    """The leftmost non-overlapping matches, none of which is empty, as an array of spans.

    The text between the matches and the matches themselves follow each other, so their lengths give
    the places. `keep` is a condition on a match; it gets the match and its `group`.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    groups = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    rows = F.arrays_zip(between.alias("before"), found.alias("value"), groups.alias("part"))

    def step(acc: Column, row: Column, _: Column) -> Column:
        start = acc["state"] + F.length(row["before"])
        end = start + F.length(row["value"])
        span = F.struct(
            F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), row["value"].alias("value")
        )
        good = keep(row["value"], row["part"]) if keep else F.lit(True)
        more = F.when(good, F.array_append(acc["out"], span)).otherwise(acc["out"])
        return F.struct(end.alias("state"), more.alias("out"))

    move = lambda at, row: at + F.length(row["before"]) + F.length(row["value"])
    none = F.array().cast(SPAN)
    return F.when(text.rlike(pattern), fold(rows, F.lit(0), move, step, ONE)).otherwise(none)


def listed(found: Column) -> Column:
    """Spans as text, kind:start:end, joined by commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(found, one), ",")


def count_of(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


def ordered(found: Column, kinds: list[str], by_kind: bool = False) -> Column:
    """Sorted by start, then kind as listed; or by kind, then start."""
    place = F.create_map(*[F.lit(x) for i, kind in enumerate(kinds) for x in (kind, i)])

    def key(s: Column) -> Column:
        first = [place[s["kind"]].alias("k"), s["start"].alias("s")]
        return F.struct(*(first if by_kind else first[::-1]), s["end"].alias("e"), s.alias("span"))

    return F.transform(F.array_sort(F.transform(found, key)), lambda x: x["span"])
