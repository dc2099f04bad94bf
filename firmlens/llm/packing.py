"""Best-fit packing after dominance reduction, planned on the histogram of lengths and carried out by ranks."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlens.llm.running import running_starts
from firmlens.session import stored

Pattern = tuple[int, ...]  # the lengths in one sequence, in falling order


class Sizes:
    """Counts by length, with the queries that the dominance criterion asks."""

    def __init__(self, counts: dict[int, int]):
        self.n = Counter({s: c for s, c in counts.items() if c > 0})

    def falling(self) -> list[int]:
        return sorted(self.n, reverse=True)

    def take(self, pattern: Pattern) -> int:
        """Takes ``pattern`` as often as its lengths last and says how often."""
        need = Counter(pattern)
        times = min(self.n[s] // k for s, k in need.items())
        for s, k in need.items():
            self.n[s] -= k * times
            if not self.n[s]:
                del self.n[s]
        return times

    def without(self, *lengths: int) -> dict[int, int]:
        rest = dict(self.n)
        for s in lengths:
            rest[s] -= 1
        return {s: c for s, c in rest.items() if c}


def _smallest(rest: dict[int, int], k: int) -> int | None:
    """Sum of the ``k`` smallest lengths, None if there are fewer."""
    total = 0
    for s in sorted(rest):
        use = min(k, rest[s])
        total, k = total + use * s, k - use
        if not k:
            return total
    return None


def _largest(rest: dict[int, int], room: int) -> int | None:
    return max((s for s in rest if s <= room), default=None)


def _pairs(rest: dict[int, int], room: int) -> Iterator[tuple[int, int]]:
    """For each length its largest partner (not longer than itself) within ``room``."""
    for a in rest:
        if b := max((b for b in rest if b <= min(a, room - a) and (b != a or rest[a] > 1)), default=None):
            yield a, b


def dominant_set(sizes: Sizes, s: int, capacity: int) -> Pattern | None:
    """A set with one item of length ``s`` that dominates every other feasible set with it, if the criterion proves one.

    A set dominates another if the other's items can be grouped so that each group fits into the place of one of its own
    items. Sets of up to three items are tried, as in Martello and Toth's reduction procedure.
    """
    room, rest = capacity - s, sizes.without(s)
    one, two, three = (_smallest(rest, k) for k in (1, 2, 3))
    if one is None or one > room:
        return (s,)  # nothing else fits
    best = _largest(rest, room)
    if best == room or two is None or two > room:
        return (s, best)  # fills the sequence, or only one more fits
    if three is not None and three <= room:
        return None
    # Two more fit, three never do.
    pairs = list(_pairs(rest, room))
    if best >= max(a + b for a, b in pairs):
        return (s, best)  # takes the place of any two
    second = _largest(sizes.without(s, best), room - best)
    if second is not None and not any(a < best and b > second for a, b in pairs):
        return (s, best, second)  # at least as long, one by one
    return None


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[Pattern, int]], dict[int, int]]:
    """The sequences that can be fixed without losing the optimum, and the lengths that remain."""
    sizes, fixed, again = Sizes(counts), [], True
    while again:
        again = False
        for s in sizes.falling():
            while sizes.n.get(s) and (pattern := dominant_set(sizes, s, capacity)):
                fixed.append((pattern, sizes.take(pattern)))
                again = True
    return fixed, dict(sizes.n)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing, carried out for all items of a length together.

    The fullest sequence that an item fits is also the fullest for the next item of its length for as long as it has room,
    so equal sequences are filled in one step: as many full ones as possible and one rest.
    """
    open_by_room: dict[int, list[tuple[Pattern, int]]] = defaultdict(list)
    for s in sorted(counts, reverse=True):
        left = counts[s]
        for room in sorted(r for r in open_by_room if r >= s):
            most, kept = room // s, []
            for pattern, times in open_by_room.pop(room):
                whole = min(times, left // most)
                rest = min(left - whole * most, most - 1) if whole < times else 0
                for k, n in ((most, whole), (rest, 1 if rest else 0)):
                    if n:
                        open_by_room[room - k * s].append((pattern + (s,) * k, n))
                left -= whole * most + rest
                if unused := times - whole - bool(rest):
                    kept.append((pattern, unused))
            if kept:
                open_by_room[room] += kept
            if not left:
                break
        most = capacity // s
        for k, n in ((most, left // most), (left % most, 1 if left % most else 0)):
            if n:
                open_by_room[capacity - k * s].append(((s,) * k, n))
    return [x for group in open_by_room.values() for x in group]


def packing_plan(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """How often each combination of lengths becomes a sequence."""
    fixed, rest = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(rest, capacity)


def seats(plan: list[tuple[Pattern, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """The plan by length: (length, first rank, end rank, items per sequence, first sequence, offset of the first item)."""
    out, used, first = [], Counter(), 0
    for pattern, times in plan:
        offset = 0
        for s, k in sorted(Counter(pattern).items(), reverse=True):
            out.append((s, used[s], used[s] + k * times, k, first, offset))
            used[s] += k * times
            offset += k * s
        first += times
    return out


def pack(items: DataFrame, capacity: int, length_col: str = "length") -> DataFrame:
    """All rows of ``items`` with ``sequence_id`` and ``offset``: sequences of at most ``capacity``, gapless from 0.

    The histogram of lengths, at most ``capacity`` numbers whatever the number of rows, is all the driver sees. On it, sets
    that provably belong to some best packing are fixed, and best-fit decreasing packs what remains. Then each row gets
    its rank among the rows of its length (totals per written partition, so a length that holds most rows is no hot
    key) and takes the seat that the plan has for this rank. The table of seats is bounded by a function of
    ``capacity`` alone and is broadcast. Lengths must lie between 1 and ``capacity``, else the job fails. Rows that are
    equal get seats of their own; an empty table gives no rows; other columns, except ``_part``, ``_row``, ``_rank`` and
    ``_one``, are carried along.
    """
    marked = items.withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id(), "_one": F.lit(1)})
    parted = stored(marked, "items")
    counts = {r[0]: r[1] for r in parted.groupBy(length_col).count().where("count > 0").limit(capacity + 2).collect()}
    if bad := [s for s in counts if s is None or not 1 <= s <= capacity]:
        raise ValueError(f"lengths must lie between 1 and {capacity}: {bad[:3]}")
    ranked = running_starts(parted, [], {"_rank": "_one"}, [length_col])
    table = seats(packing_plan(counts, capacity))
    schema = "_length long, _from long, _to long, _each long, _sequence long, _offset long"
    seat = F.broadcast(items.sparkSession.createDataFrame(table, schema))
    here = (F.col(length_col) == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    turn = F.col("_rank") - F.col("_from")
    return ranked.join(seat, here).select(
        *items.columns, (F.col("_sequence") + F.floor(turn / F.col("_each"))).alias("sequence_id"),
        (F.col("_offset") + turn % F.col("_each") * F.col(length_col)).alias("offset"),
    )
