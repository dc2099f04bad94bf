"""Conversation structure repair: cheapest edits by depth-first branch and bound.

A repaired conversation has the role initials ``(s?(ua)+)?``. Rows are kept (0), get another role (2) or are deleted (3), and
empty user or assistant rows are inserted (2); a row that ends without a full stop costs 1 more unless it is deleted. Blank rows
and duplicates must go. Of the cheapest lists of edits the one least in ASCII order counts.

Conversations are cut into blocks of rows. A block is searched by itself, from every state its predecessor may end in, so
the rows of one conversation are spread over tasks, and the blocks of a conversation are composed afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmlens.llm.running import range_parts, running_starts
from firmlens.session import parallel_parts, stored

BLOCK = 128  # rows of a conversation that are searched together
START, SYSTEM, USER, ASSISTANT = "", "s", "u", "a"  # the initial of the last row so far
STATES = (START, SYSTEM, USER, ASSISTANT)
DONE = (START, ASSISTANT)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # what a row with a new role, or an inserted one, becomes
LEGAL = {(START, SYSTEM), (START, USER), (SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
ROLES = {USER: "user", ASSISTANT: "assistant"}
GONE, OTHER = "x", "o"  # codes of rows that must be deleted, and of rows of any other role
SPACE = r"\x20\x09-\x0D"

Best = tuple[int, str]


class Bounds:
    """What the rows from a place on cost at least, after a state.

    Rows alone: 3 for one that must go, 2 for another role, 1 for a truncated one. Two neighbours (rows that must go left
    out) whose initials may not follow each other cost 2 more: one of them changes, or a row comes between. No row counts in
    two such pairs; the state before the first row may be one of a pair.
    """

    def __init__(self, codes: str) -> None:
        n = len(codes)
        self.codes, self.low, self.pairs, self.next = codes.lower(), [0] * (n + 1), [0] * (n + 2), [n] * (n + 1)
        for i in range(n - 1, -1, -1):
            code, j = self.codes[i], self.next[i + 1]
            self.low[i] = self.low[i + 1] + (3 if code == GONE else 2 * (code == OTHER) + codes[i].isupper())
            self.pairs[i] = self.pairs[i + 1]
            if code != GONE and j < n and self._odd(code, self.codes[j]):
                self.pairs[i] = max(self.pairs[i], 2 + self.pairs[j + 1])
            self.next[i] = j if code == GONE else i

    @staticmethod
    def _odd(before: str, code: str) -> bool:
        return OTHER not in (before, code) and (before, code) not in LEGAL

    def after(self, at: int, state: str) -> int:
        j, pairs = self.next[at], self.pairs[at]
        if j < len(self.codes) and self._odd(state, self.codes[j]):
            pairs = max(pairs, 2 + self.pairs[j + 1])
        return self.low[at] + pairs


def first_incumbent(codes: str, entry: str, goals: set[str]) -> Best | None:
    """Some edits that reach a goal: rows are kept where they may be, else after an inserted row, else they get another role."""
    if entry in goals and goals <= {START, SYSTEM}:
        return 3 * len(codes), "D" * len(codes)
    if goals <= {START, SYSTEM}:
        return None
    state, cost, audit = entry, 0, ""
    for raw in codes:
        code, more = raw.lower(), int(raw.isupper())
        if code == GONE:
            cost, audit = cost + 3, audit + "D"
        elif (state, code) in LEGAL:
            state, cost, audit = code, cost + more, audit + "K"
        elif (NEXT[state], code) in LEGAL:
            state, cost, audit = code, cost + 2 + more, audit + "IK"
        else:
            state, cost, audit = NEXT[state], cost + 2 + more, audit + "R"
    while state not in goals:
        state, cost, audit = NEXT[state], cost + 2, audit + "I"
    return cost, audit


def search(codes: str, entry: str = START, goals: Iterable[str] = DONE) -> Best | None:
    """(cost, audit) of the best edits that lead from ``entry`` into a state of ``goals``; None if nothing does.

    Depth first with a stack, edits in ASCII order, so prefixes come in ASCII order too. One is given up if its cost and the
    bound of the rows to come exceed the incumbent's cost, if they equal it and its audit is past the incumbent's, or if the table of
    its node (place, state) holds a prefix that is cheaper, or as cheap and earlier. Only a cheaper prefix opens a node again,
    so a block of rows opens few nodes. Two prefixes of equal cost at one node never extend each other: further inserts
    would cost more.

    ``codes`` has one letter per row: the initial of its role (``u``, ``a``, ``s``, else ``o``), upper case if the row is
    truncated, or ``x`` if it must be deleted.
    """
    n, bounds, goals = len(codes), Bounds(codes), set(goals)
    best = first_incumbent(codes, entry, goals)
    # A user's or assistant's row is never followed by the start or by a system row.
    alive = set(STATES) if goals & {USER, ASSISTANT} else {START, SYSTEM} if SYSTEM in goals else {START}
    table: dict[tuple[int, str], Best] = {}
    stack: list[tuple[int, str, int, str]] = [(0, entry, 0, "")]
    while stack:
        at, state, cost, audit = stack.pop()
        if state not in alive:
            continue
        if best is not None:
            least = cost + bounds.after(at, state)
            if least > best[0] or (least == best[0] and audit > best[1][: len(audit)]):
                continue
        seen = table.get((at, state))
        if seen is not None and seen <= (cost, audit):
            continue
        table[at, state] = (cost, audit)
        if at == n and state in goals and (best is None or (cost, audit) < best):
            best = (cost, audit)
        if at < n and codes[at] != GONE:
            code, more = codes[at].lower(), int(codes[at].isupper())
            stack.append((at + 1, NEXT[state], cost + 2 + more, audit + "R"))
            if (state, code) in LEGAL:
                stack.append((at + 1, code, cost + more, audit + "K"))
        stack.append((at, NEXT[state], cost + 2, audit + "I"))
        if at < n:
            stack.append((at + 1, state, cost + 3, audit + "D"))
    return best


class Chain:
    """The best edits up to the end of a block, as links to those up to the block before: nothing is copied per block."""

    __slots__ = ("before", "cost", "audit")

    def __init__(self, before: Chain | None, cost: int, audit: str) -> None:
        self.before, self.cost, self.audit = before, cost, audit

    def beats(self, other: Chain) -> bool:
        if self.cost != other.cost:
            return self.cost < other.cost
        a, b, mine, theirs = self, other, [], []
        while a is not b:  # both have a link per block, so they meet at the block where they part
            mine.append(a.audit)
            theirs.append(b.audit)
            a, b = a.before, b.before
        return "".join(reversed(mine)) < "".join(reversed(theirs))

    def text(self) -> str:
        parts, link = [], self
        while link is not None:
            parts.append(link.audit)
            link = link.before
        return "".join(reversed(parts))


class Composer:
    """Puts the maps of a conversation's blocks together, block after block."""

    def __init__(self) -> None:
        self.ends: dict[str, Chain] = {START: Chain(None, 0, "")}

    def add(self, entries: list[str], exits: list[str], costs: list[int], audits: list[str]) -> None:
        ends: dict[str, Chain] = {}
        for entry, leave, cost, audit in zip(entries, exits, costs, audits):
            if entry in self.ends:
                chain = Chain(self.ends[entry], self.ends[entry].cost + cost, audit)
                if leave not in ends or chain.beats(ends[leave]):
                    ends[leave] = chain
        self.ends = ends

    def result(self) -> Best:
        done = [self.ends[s] for s in DONE if s in self.ends]
        best = done[0]
        for chain in done[1:]:
            best = chain if chain.beats(best) else best
        return best.cost, best.text()


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage that crc32(``conv_id:turn``) % 20 decides; NULLs become one space.

    0 drops a row, 1 empties its text, 2 takes ``.``, ``!`` and ``?`` out of it, 3 repeats the row, 4 makes it a user's.
    ``conv_id`` and ``turn`` themselves stay NULL. Other columns are ignored.
    """
    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = conversations.select("conv_id", "turn", filled("role").alias("role"), filled("text").alias("text"), (F.crc32(F.concat_ws(":", filled("conv_id"), filled("turn")).cast("binary")) % 20).alias("kind"))
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.sequence(F.lit(1), F.lit(2))).otherwise(F.sequence(F.lit(1), F.lit(1)))
    return rows.where("kind != 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


_MAP = "conv_id {key}, block long, entries array<string>, exits array<string>, costs array<long>, audits array<string>"


def _search_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The map of each block: best edits from every state before it to every state behind it."""
    for batch in batches:
        maps = []
        for block, last, codes in zip(batch.column("block"), batch.column("last"), batch.column("codes")):
            block, last, codes = block.as_py(), last.as_py(), codes.as_py()
            found: list[tuple[str, str, int, str]] = []
            if block == last == 0:  # the whole conversation: one search, into its end
                found.append((START, START, *search(codes)))
            else:
                for entry in STATES if block else (START,):
                    for leave in STATES:
                        best = search(codes, entry, (leave,))
                        if best:
                            found.append((entry, leave, *best))
            maps.append(found)
        lists = [pa.array([[m[k] for m in found] for found in maps], pa.list_(kind)) for k, kind in enumerate((pa.string(), pa.string(), pa.int64(), pa.string()))]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("block"), *lists], ["conv_id", "block", "entries", "exits", "costs", "audits"])


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks sorted by conversation and number -> one row per conversation. Keeps one conversation's edits at a time."""
    current, composer, keys, costs, audits, kind = None, None, [], [], [], None

    def close() -> None:
        if composer is not None:
            cost, audit = composer.result()
            keys.append(current)
            costs.append(cost)
            audits.append(audit)

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(costs, pa.int64()), pa.array(audits, pa.string())], ["conv_id", "cost", "audit"])

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for row in range(batch.num_rows):
            key = batch.column("conv_id")[row].as_py()
            if composer is None or key != current:
                close()
                current, composer = key, Composer()
            composer.add(*(batch.column(c)[row].as_py() for c in ("entries", "exits", "costs", "audits")))
        if keys:
            yield out()
            keys, costs, audits = [], [], []
    close()
    if keys:
        yield out()


class _Repaired:
    """Hash of the repaired rows of one conversation, row by row along its audit."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state, self.hash, self.first = audit, 0, START, hashlib.sha256(), True

    def _line(self, role: str, text: str) -> None:
        self.hash.update((f"{role}:{text}" if self.first else f"\n{role}:{text}").encode())
        self.first = False

    def _inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.state, self.at = NEXT[self.state], self.at + 1
            self._line(ROLES[self.state], "")

    def row(self, role: str, text: str) -> None:
        self._inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self.state = role[0]
            self._line(role, text)
        elif edit == "R":
            self.state = NEXT[self.state]
            self._line(ROLES[self.state], text)

    def digest(self) -> str:
        self._inserted()
        return self.hash.hexdigest()


def _hash_repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation, its audit first -> conv_id, repaired_sha256. Holds no text but the current row's."""
    current, repaired, keys, found, kind = None, None, [], [], None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(found, pa.string())], ["conv_id", "repaired_sha256"])

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        ids, audits, roles, texts = (batch.column(c) for c in ("conv_id", "audit", "role", "text"))
        for row in range(batch.num_rows):
            audit = audits[row].as_py()
            if audit is not None:
                if repaired is not None:
                    keys.append(current)
                    found.append(repaired.digest())
                current, repaired = ids[row].as_py(), _Repaired(audit)
            else:
                repaired.row(roles[row].as_py(), texts[row].as_py())
        if keys:
            yield out()
            keys, found = [], []
    if repaired is not None:
        keys.append(current)
        found.append(repaired.digest())
        yield out()


def repair(rows: DataFrame) -> DataFrame:
    """Faults and cheapest repair of every conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256.

    ``rows``: conv_id, turn, role, text. Rows go by turn, NULL first, then by role and checksum of the text; repeated rows lie side
    by side. NULL roles and texts are one space, a NULL ``conv_id`` is a conversation of its own, other columns are
    ignored, no rows give no rows. A row's first fault counts: ``blank`` (nothing but ASCII white space), ``duplicate`` (role
    and text of an earlier row), ``truncated`` (last visible character not ``.``, ``!`` or ``?``). ``illegal`` counts
    neighbours whose initials are not ``su``, ``ua`` or ``au``.

    Rows get their place by prefix sums over range partitions. Blocks have at most ``BLOCK`` rows of a letter each; what is
    gathered for one conversation is its blocks' maps and its audit, a value of the result. The hash of the repaired texts
    is one hash over all of them, so their rows pass through one task per conversation, one at a time.
    """
    kind = dict(rows.dtypes)["conv_id"]
    role, text = F.coalesce(F.col("role"), F.lit(" ")), F.coalesce(F.col("text"), F.lit(" "))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.crc32(text.cast("binary")).alias("crc"))
    order = ["turn", "role", "crc"]
    parted = range_parts(rows, ["conv_id", *order])
    visible, ended = F.col("text").rlike(f"[^{SPACE}]"), F.col("text").rlike(rf"[.!?][{SPACE}]*\z")
    slim = parted.select(
        "conv_id", *order, "_row", "_part", F.lit(1).alias("one"), F.substring("role", 1, 1).alias("initial"),
        F.md5(F.concat_ws(":", F.length("role"), "role", "text")).alias("digest"), (~visible).alias("is_blank"), (visible & ~ended).alias("is_open"),
    )
    placed = running_starts(slim, order, {"position": "one"}, ["conv_id"])
    again = F.row_number().over(Window.partitionBy("conv_id", "digest").orderBy("position")) > 1
    judged = placed.withColumn("again", again).select(
        "conv_id", "turn", "position", "initial", F.col("is_blank").alias("blank"), (~F.col("is_blank") & F.col("again")).alias("duplicate"),
        (~F.col("again") & F.col("is_open")).alias("truncated"),
    )
    known = F.when(F.col("initial").isin(SYSTEM, USER, ASSISTANT), F.col("initial")).otherwise(OTHER)
    code = F.when(F.col("blank") | F.col("duplicate"), GONE).otherwise(F.when(F.col("truncated"), F.upper(known)).otherwise(known))
    judged = stored(judged.select("conv_id", "turn", "position", "initial", "blank", "duplicate", "truncated", code.alias("code")), "judged")

    def total(flag: str) -> Column:
        return F.sum(F.col(flag).cast("long")).alias(flag)

    # Of each block one row: its letters in order, and what its neighbours need to know of it.
    listed = F.array_sort(F.collect_list(F.struct("position", "initial", "code")))
    blocks = judged.groupBy("conv_id", F.floor(F.col("position") / BLOCK).alias("block")).agg(listed.alias("listed"), total("blank"), total("duplicate"), total("truncated"))
    pairs = F.transform(F.sequence(F.lit(1), F.size("listed") - 1), lambda i: F.concat(F.get("listed", i - 1)["initial"], F.get("listed", i)["initial"]))
    wrong = F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au")))
    blocks = stored(blocks.select(
        "conv_id", "block", "blank", "duplicate", "truncated", F.when(F.size("listed") > 1, wrong).otherwise(0).alias("illegal"), F.concat_ws("", F.col("listed.code")).alias("codes"),
        F.get("listed", F.lit(0))["initial"].alias("first"), F.element_at("listed", -1)["initial"].alias("final"),
    ), "blocks")
    along = Window.partitionBy("conv_id").orderBy("block")
    before = F.lag("final").over(along)
    borders = F.when(F.col("block") > 0, ~F.concat(before, "first").isin("su", "ua", "au")).otherwise(False).cast("long")
    faults = blocks.withColumn("border", borders).groupBy("conv_id").agg(
        F.sum("blank").alias("blank"), F.sum("duplicate").alias("duplicate"), F.sum("truncated").alias("truncated"), F.sum(F.col("illegal") + F.col("border")).alias("illegal"),
    )
    turns = judged.select("conv_id", "turn").distinct().groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))

    last = blocks.groupBy(F.col("conv_id").alias("conv")).agg(F.max("block").alias("last"))
    asked = blocks.select("conv_id", "block", "codes").join(last, F.col("conv").eqNullSafe(F.col("conv_id"))).select("conv_id", "block", "last", "codes")
    asked = asked.repartition(parallel_parts(rows.sparkSession), "conv_id", "block")  # few bytes, but much to search
    maps = asked.mapInArrow(_search_blocks, _MAP.format(key=kind))
    audits = stored(maps.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(_compose, f"conv_id {kind}, cost long, audit string"), "audits")

    lines = parted.select("conv_id", *order, "_row", "text", F.lit(None).cast("string").alias("audit"))
    heads = audits.select("conv_id", "audit")
    both = lines.unionByName(heads, allowMissingColumns=True).withColumn("is_row", F.col("audit").isNull())
    both = both.repartition("conv_id").sortWithinPartitions("conv_id", "is_row", *order, "_row").select("conv_id", "audit", "role", "text")
    hashes = both.mapInArrow(_hash_repaired, f"conv_id {kind}, repaired_sha256 string")

    out = faults
    for k, part in enumerate((turns, audits, hashes)):
        out = out.join(part.withColumnRenamed("conv_id", f"key{k}"), F.col(f"key{k}").eqNullSafe(F.col("conv_id"))).drop(f"key{k}")
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """``repair`` of the damaged conversations, with a row for those of which no row is left: zeros, no edits."""
    ids = conversations.select(F.col("conv_id").alias("key")).distinct()
    out = ids.join(repair(damaged(conversations)), F.col("key").eqNullSafe(F.col("conv_id")), "left")
    zeros = {c: F.coalesce(F.col(c), F.lit(0).cast("long")) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return out.select(
        F.col("key").alias("conv_id"), *[v.alias(c) for c, v in zeros.items()], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
