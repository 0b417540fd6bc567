"""Conversation structure repair: weighted CYK interval parsing over the rows of each conversation.

A well-formed conversation is nothing, or an optional system row and then pairs of a user and an assistant row. Rows may
be kept, given another role, deleted, or inserted, at a cost. The repair grammar in Chomsky normal form has a
nonterminal [p q] for each pair of states of the well-formed orders (0 nothing yet, 1 after system, 2 after user, 3 after
assistant): [p q] -> [p r] [r q], and [p q] -> a row, edited. A chart cell of a span holds, per nonterminal, the least
(cost, audit), where the audit spells the edits (D, I, K, R); row cells are closed under insertions on either side.

Cells are combined bottom-up by span length. Inside blocks of ``BLOCK`` rows the whole chart is filled, with every split.
Blocks, and the parts of a conversation that lie in different tasks, are spans already parsed, and combine the same way
(two audits of one span never tie when one begins the other, as inserts cost; so the least cell does not depend on how a
span is split, and beyond blocks one split is enough). No step needs a whole conversation's rows in one task: rows are
laid out by range over (conversation, turn, role, text hash), so that a conversation that holds a third of all rows is
spread over many tasks; each task returns one cell per conversation it meets. Only the digest of the repaired text,
which is sequential by definition, streams a conversation through one task, without holding it.

Cases: nulls in role and text count as one space; a null conv_id is a conversation, null turns come first. Rows of equal
turn are ordered by role and text hash. Repeated rows are rows (the later ones are duplicates). Roles count by their first
character; one other than s, u, a, or an empty role, cannot be kept. Empty texts are blank; texts of any length are read whole.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import bounded_broadcast, checkpoint, shuffle_partitions

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Rows whose chart is filled span by span.
BLOCK = 6
#: State after a role's initial, per state (None: not allowed).
AFTER = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
STATES = range(4)
#: The role that an inserted or reroled row takes, by state.
NEXT = ["u", "u", "a", "u"]
_DIGIT = r"[^\x20\x09-\x0D]"

Cell = list[list[tuple[int, str] | None]]


def _better(a, b):
    return a if b is None or (a is not None and a <= b) else b


def combine(x: Cell, y: Cell) -> Cell:
    """The cell of two neighbouring spans: [p q] -> [p r] [r q], the least (cost, audit)."""
    out: Cell = [[None] * 4 for _ in STATES]
    for p in STATES:
        for q in STATES:
            ways = [(x[p][r], y[r][q]) for r in STATES if x[p][r] is not None and y[r][q] is not None]
            if ways:
                least = min(a[0] + b[0] for a, b in ways)
                out[p][q] = (least, min(a[1] + b[1] for a, b in ways if a[0] + b[0] == least))
    return out


def _inserts() -> Cell:
    """[p q] over no rows: the fewest inserted rows that lead from p to q."""
    out: Cell = [[None] * 4 for _ in STATES]
    for p in STATES:
        q, k = p, 0
        while out[p][q] is None:
            out[p][q] = (INSERT * k, "I" * k)
            q, k = AFTER[q][NEXT[q]], k + 1
    return out


EMPTY = _inserts()


@functools.lru_cache(maxsize=None)
def row_cell(initial: str, fault: str) -> tuple:
    """The cell of one row (``fault``: "d" must be deleted, "t" is truncated, "" neither), closed under insertions."""
    out: Cell = [[None] * 4 for _ in STATES]
    extra = TRUNCATED if fault == "t" else 0
    for p in STATES:
        out[p][p] = (DELETE, "D")
        if fault != "d":
            q = AFTER[p][NEXT[p]]
            out[p][q] = _better((REROLE + extra, "R"), out[p][q])
            if initial in AFTER[p]:
                q = AFTER[p][initial]
                out[p][q] = _better((extra, "K"), out[p][q])
    return combine(combine(EMPTY, out), EMPTY)


@functools.lru_cache(maxsize=1 << 14)
def block_cell(rows: tuple) -> Cell:
    """CYK chart over at most ``BLOCK`` rows, (initial, fault) each: spans by rising length, every split."""
    n = len(rows)
    chart = {(i, i + 1): row_cell(*rows[i]) for i in range(n)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            best: Cell = [[None] * 4 for _ in STATES]
            for k in range(i + 1, i + length):
                way = combine(chart[i, k], chart[k, i + length])
                best = [[_better(way[p][q], best[p][q]) for q in STATES] for p in STATES]
            chart[i, i + length] = best
    return chart[0, n]


def fold(cells: list[Cell]) -> Cell:
    """The cell of a row of neighbouring spans, pairs of neighbours first."""
    if not cells:
        return EMPTY
    while len(cells) > 1:
        cells = [combine(cells[i], cells[i + 1]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0]


def power(cell: Cell, n: int) -> Cell:
    """``n`` times the same span, by doubling."""
    out = None
    while n:
        if n & 1:
            out = cell if out is None else combine(out, cell)
        cell, n = combine(cell, cell) if n > 1 else cell, n >> 1
    return EMPTY if out is None else out


class Parser:
    """Parses one span of a conversation row by row: full blocks become cells, and cells of equally many blocks merge, so
    that spans are combined by rising length and few cells are held."""

    def __init__(self):
        self.rows, self.cells = [], []

    def add(self, initial: str, fault: str, times: int = 1):
        if times > BLOCK:
            self._close()
            self._push(power(row_cell(initial, fault), times))
            return
        for _ in range(times):
            self.rows.append((initial, fault))
            if len(self.rows) == BLOCK:
                self._close()

    def _close(self):
        if self.rows:
            self._push(block_cell(tuple(self.rows)))
            self.rows = []

    def _push(self, cell: Cell):
        size = 1
        while self.cells and self.cells[-1][0] <= size:
            n, left = self.cells.pop()
            cell, size = combine(left, cell), n + size
        self.cells.append((size, cell))

    def cell(self) -> Cell:
        self._close()
        return fold([c for _, c in self.cells])


def repaired(cell: Cell, any_rows: bool) -> tuple[int, str]:
    """Cost and audit of the cheapest well-formed whole."""
    if not any_rows:
        return 0, ""
    return min(x for x in (cell[0][0], cell[0][3]) if x is not None)


def damaged(conv: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, times (how often the row now stands there; 0: gone) after the damage."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    df = conv.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                     F.coalesce(F.crc32(key) % 20, F.lit(99)).alias("how"))
    return df.select(
        "conv_id", "turn", F.when(F.col("how") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("how") == 0, 0).when(F.col("how") == 3, 2).otherwise(1).cast("long").alias("times"))


def _hashes():
    """Two 64-bit hashes of the text stand for it where rows are compared."""
    return F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("again"), "text").alias("h2")


ORDER = ["conv_id", "turn", "role", "h1", "h2"]


def narrow_rows(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, h1, h2, times, blank, open (its last word lacks an end mark), seen (role and text stand in an earlier
    turn): one row for equal rows, without texts. ``rows`` as from ``damaged``."""
    end = F.regexp_extract("text", rf"(?s)({_DIGIT})[\x20\x09-\x0D]*\z", 1)
    flat = rows.select("conv_id", "turn", F.when(F.col("times") > 0, F.col("role")).otherwise("").alias("role"), *_hashes(),
                       "times", (end == "").alias("blank"), (~end.isin(".", "!", "?", "")).alias("open"))
    there = checkpoint(flat.groupBy(*ORDER, "blank", "open").agg(F.sum("times").alias("times")))
    who = ["conv_id", "role", "h1", "h2"]
    again = there.where("times > 0").groupBy(*who).agg(F.min("turn").alias("first"), F.max(F.col("turn").isNull()).alias("null_first"), F.count("*").alias("turns"))
    again = checkpoint(again.where("turns > 1").select(*[F.col(c).alias("_" + c) for c in who], "first", "null_first"))
    same = functools.reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col("_" + c)) for c in who])
    later = F.col("turn").isNotNull() & (F.col("null_first") | (F.col("turn") > F.col("first")))
    return there.join(bounded_broadcast(again), same, "left").select(*ORDER, "times", "blank", "open", F.coalesce(later, F.lit(False)).alias("seen"))


_PIECE = ("conv_id long, piece long, turns long, low long, high long, first string, last string, blank long, duplicate long, "
          "truncated long, illegal long, n long, cost array<int>, audit array<string>")


def _flat(cell: Cell) -> tuple[list, list]:
    return [x and x[0] for row in cell for x in row], [x and x[1] for row in cell for x in row]


def _square(cost: list, audit: list) -> Cell:
    return [[None if cost[4 * p + q] is None else (cost[4 * p + q], audit[4 * p + q]) for q in STATES] for p in STATES]


def pieces(rows: DataFrame) -> DataFrame:
    """A row for each conversation and task that holds some of it: its counts and the cell of that span. ``rows``:
    ``narrow_rows``, laid out by range so that a long conversation spans many tasks."""

    def run(batches):
        from pyspark import TaskContext

        at, cur, out = TaskContext.get().partitionId(), None, []

        def done():
            cost, audit = _flat(cur["parser"].cell())
            out.append({**{k: cur[k] for k in ("conv_id", "turns", "low", "high", "first", "last", "blank", "duplicate", "truncated", "illegal", "n")},
                        "piece": at, "cost": cost, "audit": audit})

        for b in batches:
            for r in b.to_pylist():
                if cur is None or cur["conv_id"] != r["conv_id"]:
                    if cur is not None:
                        done()
                    cur = dict.fromkeys(("turns", "blank", "duplicate", "truncated", "illegal", "n"), 0) | {
                        "conv_id": r["conv_id"], "low": None, "high": None, "first": None, "last": None, "parser": Parser()}
                n, initial = r["times"], r["role"][:1]
                if not n:
                    continue
                if r["turn"] is not None:
                    cur["turns"] += r["turn"] != cur["high"]
                    cur["low"] = r["turn"] if cur["low"] is None else cur["low"]
                    cur["high"] = r["turn"]
                cur["illegal"] += (cur["n"] > 0 and cur["last"] + initial not in LEGAL) + (n - 1) * (2 * initial not in LEGAL)
                cur["first"], cur["last"], cur["n"] = initial if cur["first"] is None else cur["first"], initial, cur["n"] + n
                if r["blank"]:
                    cur["blank"] += n
                    cur["parser"].add(initial, "d", n)
                    continue
                fresh = 0 if r["seen"] else 1
                cur["duplicate"] += n - fresh
                if fresh:
                    cur["truncated"] += r["open"]
                    cur["parser"].add(initial, "t" if r["open"] else "")
                if n > fresh:
                    cur["parser"].add(initial, "d", n - fresh)
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema=_arrow(_PIECE))
                out = []
        if cur is not None:
            done()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_arrow(_PIECE))

    laid = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *[F.col(c).asc_nulls_first() for c in ORDER])
    laid = laid.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in ORDER])
    return laid.select("conv_id", "turn", "role", "times", "blank", "open", "seen").mapInArrow(run, _PIECE)


LEGAL = ("su", "ua", "au")


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}
    return pa.schema([(c.split(" ")[0], kinds[c.split(" ")[1]]) for c in ddl.split(", ")])


_WHOLE = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def wholes(parts: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit: pieces put together (a conversation has one per task
    that held some of it)."""
    cols = [c.split(" ")[0] for c in _PIECE.split(", ")[1:]]
    put = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(*cols))).alias("p"))

    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                got = {"conv_id": r["conv_id"]} | {k: sum(p[k] for p in r["p"]) for k in ("blank", "duplicate", "truncated", "illegal")}
                turns, high, last = 0, None, None
                for p in r["p"]:
                    if p["n"]:
                        got["illegal"] += last is not None and last + p["first"] not in LEGAL
                        last = p["last"]
                        turns += p["turns"] - (high is not None and p["low"] == high)
                        high = high if p["high"] is None else p["high"]
                low = next((p["low"] for p in r["p"] if p["low"] is not None), None)
                got["gaps"] = 0 if low is None else high - low + 1 - turns
                cells = [_square(p["cost"], p["audit"]) for p in r["p"] if p["n"]]
                got["cost"], got["audit"] = repaired(fold(cells), bool(cells))
                out.append(got)
            yield pa.RecordBatch.from_pylist(out, schema=_arrow(_WHOLE))

    return put.mapInArrow(run, _WHOLE)


def edited(rows: DataFrame, whole: DataFrame) -> DataFrame:
    """``whole`` with repaired_sha256 and repaired_rows: the audits applied to the rows, in their order. A conversation streams
    through one task behind a row that brings its audit."""
    head = whole.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(0).cast("long").alias("h1"),
                        F.lit(0).cast("long").alias("h2"), F.lit("").alias("text"), F.lit(0).cast("long").alias("times"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    nothing = F.lit(None).cast("long")
    body = rows.where("times > 0").select("conv_id", F.lit(1).alias("kind"), "turn", "role", *_hashes(), "text", "times",
                                          *[nothing.alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], F.lit(None).cast("string").alias("audit"))
    by = ["conv_id", "kind", "turn", "role", "h1", "h2"]
    laid = head.unionAll(body).repartition("conv_id").sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in by])
    keep = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]

    def run(batches):
        out, head, digest, n, at, state = [], None, None, 0, 0, 0

        def put(role: str, text: str, initial: str):
            nonlocal n, state
            digest.update((("\n" if n else "") + role + ":" + text).encode())
            n, state = n + 1, AFTER[state][initial]

        def inserts():
            nonlocal at
            while head["audit"][at : at + 1] == "I":
                put(FULL[NEXT[state]], "", NEXT[state])
                at += 1

        def done():
            inserts()
            out.append(head | {"repaired_sha256": digest.hexdigest(), "repaired_rows": n})

        for b in batches:
            for i in range(b.num_rows):
                if b.column(0)[i].as_py() == 0:
                    if head is not None:
                        done()
                    head = {c: b.column(c)[i].as_py() for c in keep}
                    digest, n, at, state = hashlib.sha256(), 0, 0, 0
                    continue
                role, text = b.column("role")[i].as_py(), b.column("text")[i].as_py()
                for _ in range(b.column("times")[i].as_py()):
                    inserts()
                    letter, at = head["audit"][at], at + 1
                    if letter == "K":
                        put(role, text, role[0])
                    elif letter == "R":
                        put(FULL[NEXT[state]], text, NEXT[state])
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema=_arrow(result))
                out = []
        if head is not None:
            done()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_arrow(result))

    result = _WHOLE + ", repaired_sha256 string, repaired_rows long"
    return laid.select("kind", *keep, "role", "text", "times").mapInArrow(run, result)


FULL = {"u": "user", "a": "assistant"}


def repair(rows: DataFrame) -> DataFrame:
    """A row for each conv_id of ``rows`` (conv_id, turn, role, text, times, see ``damaged``): gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256, repaired_rows."""
    whole = checkpoint(wholes(pieces(checkpoint(narrow_rows(rows)))))
    return edited(rows, whole)
