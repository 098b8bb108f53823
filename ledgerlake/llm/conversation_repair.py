"""Conversation structure repair by survivor-coalescence Viterbi (operator 12).

The cheapest edits that give a conversation the roles ``(s?(ua)+)?`` (an optional
system turn, then user and assistant in turn, or nothing at all) are a shortest path
through four states.  Rows of a conversation stream through a task in order; every
state keeps one survivor, and survivors are leaves of a tree of backpointers with
reference counts.  Edits above the survivors' common ancestor are decided and leave
the tree; what is left holds one byte an undecided edit and survivor.  No
conversation is ever gathered: memory is its undecided edits and its audit,
which is one cell of the result.

Ties go to the audit that is least in ASCII.  Survivors are kept in the order of their
complete undecided edits: after every row their last letters belong to that row,
so no survivor's edits begin another's and the order of two extensions is
the order of what they extend, then of the letters added.

Spark's part: equal rows are counted first (map-side), the first turn of every
(role, text) is a minimum joined back, and only short rows without texts stream
through the search (``audits``).  ``replay`` streams the texts in the same order behind
their conversation's audit.  A conversation is one task's stream, since its digest
is sequential by contract; conversations are spread by hash.

Order of rows: by turn, nulls first; rows of one turn by role, then by the MD5 of
their text, so equal rows stand together.  Defined results: null role or text is
one space; null ``conv_id`` is a conversation of its own; a role counts by its first
character, and an empty one may not stay; repeated rows count each; an empty table gives no rows; texts
of any length pass one batch at a time; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, SYSTEM, USER, ASSISTANT = range(4)
_FLUSH_BYTES = 1 << 20


@dataclass(frozen=True)
class Costs:
    """Keeping is free; inserting must cost something."""
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


def due(state: int) -> int:
    """The state after the user or assistant turn that is due."""
    return ASSISTANT if state == USER else USER


def kept(state: int, initial: str) -> int | None:
    """The state after a turn as it is, None where it may not stand."""
    if initial == "s":
        return SYSTEM if state == START else None
    return due(state) if initial == ("a" if state == USER else "u") else None


class Node:
    """Edits since the parent; ``refs`` counts children and, for a leaf, its survivor."""
    __slots__ = ("parent", "letters", "children", "refs")

    def __init__(self, parent: Node | None, letters: str = ""):
        self.parent, self.letters, self.children, self.refs = parent, bytearray(letters, "ascii"), [], 1
        if parent is not None:
            parent.children.append(self)
            parent.refs += 1


class Viterbi:
    """Least cost and edits of one conversation, row by row."""

    def __init__(self, costs: Costs = Costs()):
        self.costs = costs
        self.root = Node(None)
        self.alive: dict[int, tuple[int, int, Node]] = {START: (0, 0, self.root)}  # cost, rank, leaf
        self.decided = bytearray()

    def _entries(self):
        """Survivors with as many inserted turns as lead to another state."""
        for state, (cost, rank, _) in self.alive.items():
            seen, at, letters = set(), state, ""
            while at not in seen:
                yield state, at, cost, rank, letters
                seen.add(at)
                at, cost, letters = due(at), cost + self.costs.insert, letters + "I"

    def row(self, initial: str, must_go: bool, truncated: bool) -> None:
        c, best = self.costs, {}
        extra = c.truncated if truncated else 0
        for state, at, cost, rank, letters in self._entries():
            ways = [(at, c.delete, "D")]
            if not must_go:
                ways.append((due(at), c.rerole + extra, "R"))
                to = kept(at, initial)
                if to is not None:
                    ways.append((to, extra, "K"))
            for to, price, letter in ways:
                way = (cost + price, rank, letters + letter, state)
                if to not in best or way < best[to]:
                    best[to] = way
        if ASSISTANT in best:
            # From there every continuation of the other two costs at most this much more.
            bound = best[ASSISTANT][0]
            for state, more in ((START, c.delete), (SYSTEM, 0)):
                if state in best and best[state][0] > bound + more:
                    del best[state]
        before, self.alive = self.alive, {}
        for rank, to in enumerate(sorted(best, key=lambda s: best[s][1:3])):
            cost, _, letters, state = best[to]
            self.alive[to] = (cost, rank, Node(before[state][2], letters))
        for _, _, leaf in before.values():
            self._release(leaf)
        self._decide()

    def _release(self, node: Node) -> None:
        """One reference less: unreferenced nodes go, nodes with one child join it."""
        node.refs -= 1
        while node.refs == 0 and node is not self.root:
            up = node.parent
            up.children.remove(node)
            up.refs -= 1
            node = up
        if node.refs == 1 and node.children and node is not self.root:
            child = node.children[0]
            node.letters += child.letters
            child.letters, child.parent = node.letters, node.parent
            node.parent.children[node.parent.children.index(node)] = child

    def _decide(self) -> None:
        """Edits that all survivors share leave the tree."""
        while len(self.root.children) == 1:
            self.root = self.root.children[0]
            self.root.parent = None
            self.decided += self.root.letters
            self.root.letters = bytearray()

    def finish(self) -> tuple[int, str]:
        ends = []
        for state, at, cost, rank, letters in self._entries():
            if at == ASSISTANT or (at == START and not letters):
                ends.append((cost, rank, letters, state))
        cost, _, letters, state = min(ends)
        node, path = self.alive[state][2], []
        while node is not None:
            path.append(node.letters)
            node = node.parent
        edits = self.decided + b"".join(reversed(path))
        return cost, edits.decode("ascii") + letters


class _Conversation:
    """Counts and edits of the conversation that streams by."""

    def __init__(self, costs: Costs):
        self.search = Viterbi(costs)
        self.least = self.most = self.turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.rows = 0
        self.initial = None

    def add(self, turn, initial, n, blank, truncated, first) -> None:
        if turn is not None and turn != self.turn:
            self.least = turn if self.least is None else self.least
            self.turn = self.most = turn
            self.turns += 1
        for k in range(n):
            self.rows += 1
            if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
                self.illegal += 1
            self.initial = initial
            again = not blank and (k > 0 or not first)
            cut = truncated and not blank and not again
            self.blank += blank
            self.duplicate += again
            self.truncated += cut
            self.search.row(initial, blank or again, cut)

    def result(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        cost, audit = self.search.finish()
        return (self.rows, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit)


def _streamed(batches: Iterator[pa.RecordBatch]):
    """(is first of its conversation, row) for rows sorted by conversation."""
    last, any_yet = None, False
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            yield not any_yet or row[0] != last, row
            last, any_yet = row[0], True


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(x) for x in row if isinstance(x, str))
        if size >= _FLUSH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _arrow(df: DataFrame, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(df.sparkSession.createDataFrame([], ddl).schema)


def _turns(df: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    space = F.lit(" ")
    return df.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                     F.coalesce(F.col(role), space).alias("role"), F.coalesce(F.col(text), space).alias("text"))


def _in_order(df: DataFrame, *first: str) -> DataFrame:
    order = ["conv_id", *first, F.col("turn").asc_nulls_first(), "role", "digest"]
    return df.repartition("conv_id").sortWithinPartitions(*order)


def audits(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", costs: Costs = Costs()) -> DataFrame:
    """One row a conversation: its faults and the cheapest edits.

    Columns conv_id, n_rows, gaps, blank, duplicate, truncated, illegal, cost, audit.
    """
    end = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    rows = _turns(df, conv_id, turn, role, text).select(
        "conv_id", "turn", "role", F.unhex(F.md5("text")).alias("digest"),
        (end == "").alias("is_blank"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("is_cut"))
    equal = rows.groupBy("conv_id", "turn", "role", "digest").agg(
        F.count("*").alias("n"), F.max("is_blank").alias("is_blank"), F.max("is_cut").alias("is_cut"))
    # Nulls first: a missing turn is before every other.
    first = rows.groupBy("conv_id", "role", "digest").agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("has"), "turn")).alias("at"))
    same = (equal.conv_id.eqNullSafe(first.conv_id) & (equal.role == first.role) & (equal.digest == first.digest))
    marked = equal.join(first, same).select(
        equal.conv_id, equal.turn, F.left(equal.role, F.lit(1)).alias("initial"), "n", "is_blank", "is_cut",
        equal.turn.eqNullSafe(F.col("at.turn")).alias("is_first"), equal.role, equal.digest)
    kind = marked.schema["conv_id"].dataType.simpleString()
    ddl = (f"conv_id {kind}, n_rows long, gaps long, blank long, duplicate long, truncated long, illegal long, "
           "cost long, audit string")
    schema = _arrow(df, ddl)

    def run(batches):
        def found():
            now = conv = None
            for starts, row in _streamed(batches):
                if starts:
                    if now is not None:
                        yield (conv, *now.result())
                    now, conv = _Conversation(costs), row[0]
                now.add(*row[1:])
            if now is not None:
                yield (conv, *now.result())
        return _batched(found(), schema)

    ordered = _in_order(marked).select("conv_id", "turn", "initial", "n", "is_blank", "is_cut", "is_first")
    return ordered.mapInArrow(run, ddl)


def _repaired(rows) -> Iterator[tuple]:
    """(starts, conv_id, edit, turn, role, text) of rows behind their audits."""
    state, edits, at, conv, begun = START, "", 0, None, False

    def inserted():
        nonlocal state, at, begun
        while at < len(edits) and edits[at] == "I":
            state, at = due(state), at + 1
            yield conv, "I", None, "assistant" if state == ASSISTANT else "user", ""

    for starts, (c, kind, turn, role, text, audit) in rows:
        if starts:
            yield from inserted()
            state, edits, at, conv = START, audit, 0, c
            continue
        yield from inserted()
        edit, at = edits[at], at + 1
        if edit == "R":
            state = due(state)
            role = "assistant" if state == ASSISTANT else "user"
        elif edit == "K":
            state = kept(state, role[:1])
        if edit != "D":
            yield conv, edit, turn, role, text
    yield from inserted()


def replay(df: DataFrame, found: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", digest: bool = False) -> DataFrame:
    """The repaired rows of ``df`` by the ``audits`` of its conversations.

    Columns conv_id, position, edit, turn, role, text; inserted rows have no turn and an
    empty text.  With ``digest``, conv_id and the SHA-256 of each repaired conversation's
    ``role:text`` lines instead; conversations without a row have none.
    """
    rows = _turns(df, conv_id, turn, role, text).select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", "text", F.lit(None).cast("string").alias("audit"),
        F.unhex(F.md5("text")).alias("digest"))
    none = [F.lit(None).cast(t).alias(n) for n, t in (("turn", "long"), ("role", "string"), ("text", "string"))]
    heads = found.select("conv_id", F.lit(0).alias("kind"), *none, "audit", F.lit(None).cast("binary").alias("digest"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    ddl = (f"conv_id {kind}, repaired_sha256 string" if digest else
           f"conv_id {kind}, position long, edit string, turn long, role string, text string")
    schema = _arrow(df, ddl)

    def run(batches):
        def numbered():
            last = None
            for row in _repaired(_streamed(batches)):
                n = 0 if last is None or row[0] != last[0] else n + 1
                last = row
                yield (row[0], n, *row[1:])

        def digests():
            conv = sha = None
            for c, n, _, _, who, what in numbered():
                if n == 0:
                    if sha is not None:
                        yield conv, sha.hexdigest()
                    conv, sha = c, hashlib.sha256()
                sha.update(("\n" * (n > 0) + who + ":" + what).encode())
            if sha is not None:
                yield conv, sha.hexdigest()
        return _batched(digests() if digest else numbered(), schema)

    ordered = _in_order(heads.unionByName(rows), "kind")
    return ordered.select("conv_id", "kind", "turn", "role", "text", "audit").mapInArrow(run, ddl)


def damage(df: DataFrame) -> DataFrame:
    """Conversations hurt by rule, for the query: see its contract.

    By crc32 of ``conv_id:turn`` mod 20, 0 drops a row, 1 empties its text, 2 removes
    ``.!?``, 3 repeats it, 4 makes it the user's.  Nulls are one space; turns stay null.
    """
    name = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    hurt = df.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")],
                     (F.crc32(F.concat_ws(":", *name)) % 20).alias("how")).where("how <> 0")
    text = F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("how") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("how") == 3, 2).otherwise(1)
    return hurt.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                       F.explode(F.sequence(F.lit(1), times)).alias("copy")).drop("copy")
