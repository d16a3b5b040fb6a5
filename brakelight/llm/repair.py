"""Conversation repair: the cheapest edits that make the roles of a conversation alternate, found in one stream."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: white space of the contract
SPACES = " \t\n\x0b\x0c\r"
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
RENAME, DELETE, INSERT, CUT_SHORT = 1, 2, 5, 5
#: states of the repaired roles so far: nothing, a system row alone, last is user, last is assistant
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
_KEEP = {("s", EMPTY): SYSTEM, ("u", EMPTY): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
_NAMES = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = {"su", "ua", "au"}


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Rows conv_id, turn, role, text, dropped after damage by crc32(``conv_id:turn``) % 20.

    0 drops the row (kept here with ``dropped`` true, so that its conversation stays known), 1 empties the text,
    2 removes ``.!?``, 3 repeats the row, 4 sets role user. Nulls count as one space, except in turn itself. Further
    columns are left out; repeated rows are damaged alike; an empty table gives an empty result.
    """
    def name(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(name(conv_col), F.lit(":"), name(turn_col)).cast("binary")) % 20
    base = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                       name(role_col).alias("role"), name(text_col).alias("text"), code.alias("code"))
    text = (F.when(F.col("code").isin(0, 1), F.lit("")).when(F.col("code") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")))
    copies = F.when(F.col("code") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return base.select("conv_id", "turn", F.when(F.col("code") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                       text.alias("text"), (F.col("code") == 0).alias("dropped"), F.explode(copies).alias("copy")).drop("copy")


def faults(rows: DataFrame) -> DataFrame:
    """Add ``fault``: 1 blank, 2 duplicate (role and text seen earlier in the conversation), 3 truncated, 0 none."""
    body = F.rtrim(F.col("text"), F.lit(SPACES))
    same = Window.partitionBy("conv_id", "dropped", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    return rows.withColumn("fault", F.when(F.length(body) == 0, BLANK).when(F.row_number().over(same) > 1, DUPLICATE)
                           .when(~F.right(body, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(0))


class _Node:
    """An edit of the backpointer tree; ``refs`` counts children and survivors that hang on it."""

    __slots__ = ("parent", "edit", "out", "kids", "refs")

    def __init__(self, parent, edit, out=None):
        self.parent, self.edit, self.out, self.kids, self.refs = parent, edit, out, [], 0
        if parent is not None:
            parent.kids.append(self)
            parent.refs += 1


def _release(node) -> None:
    """A survivor leaves the node: branches that no survivor needs are freed upwards."""
    node.refs -= 1
    while not node.refs and node.parent is not None:
        parent = node.parent
        parent.kids.remove(node)
        parent.refs -= 1
        node.parent, node = None, parent


class Repair:
    """Viterbi over the edits of one conversation, fed row by row.

    A survivor per state holds (cost, rank, inserts, node, hash). Every survivor has used up the same rows, so
    before inserts no audit is a prefix of another: ``rank`` is their order as complete strings, and an insert
    follows as a tail of ``I``. Comparing (rank, tail + edit) therefore compares the complete unresolved suffixes
    of tied survivors, without walking them again for every row. Survivors that no continuation can make
    cheapest are dropped. Once all survivors hang on one child of the root, that edit is settled: it is emitted
    and the root moves on, so the tree holds unresolved edits only. Repaired text goes into a digest per
    survivor; texts are kept (``keep_rows``) only until their edit is settled.
    """

    def __init__(self, keep_rows: bool = False):
        self.keep_rows, self.audit, self.rows, self.deepest = keep_rows, bytearray(), [], 0
        self.root = _Node(None, "")
        self.root.refs += 1
        self.live = {EMPTY: (0, 0, 0, self.root, hashlib.sha256(), True)}
        self._inserts(self.live)

    def _inserts(self, live: dict) -> None:
        for to, sources in ((USER, (EMPTY, SYSTEM, ASSISTANT)), (ASSISTANT, (USER,))):
            best, at = live.get(to), None
            key = (best[0], best[1], best[2]) if best else None
            for q in sources:
                if q in live and (key is None or (live[q][0] + INSERT, live[q][1], live[q][2] + 1) < key):
                    key, at = (live[q][0] + INSERT, live[q][1], live[q][2] + 1), q
            if at is not None:
                _, _, _, node, sha, first = live[at]
                new = _Node(node, "I", (None, _NAMES[to], "") if self.keep_rows else None)
                new.refs += 1
                if best:
                    _release(best[3])
                live[to] = (*key, new, _added(sha, first, _NAMES[to], ""), False)

    def add(self, turn, role: str, text: str, fault: int) -> None:
        initial, best = role[:1], {}
        for q, (cost, rank, tail, *_) in self.live.items():
            moves = [(q, cost + DELETE, "D")]
            if fault not in (BLANK, DUPLICATE):
                more = cost + (CUT_SHORT if fault == TRUNCATED else 0)
                to = _KEEP.get((initial, q))
                if to is not None:
                    moves.append((to, more, "K"))
                moves.append((ASSISTANT if q == USER else USER, more + RENAME, "R"))
            for to, c, edit in moves:
                key = (c, rank, "I" * tail + edit)
                if to not in best or key < best[to][0]:
                    best[to] = (key, q, edit)
        cost_of = {q: b[0][0] for q, b in best.items()}
        # continuations of the first state cost at most this much more from the second one
        for q, other, more in ((EMPTY, ASSISTANT, DELETE), (EMPTY, USER, INSERT + DELETE), (SYSTEM, ASSISTANT, 0),
                               (SYSTEM, USER, INSERT)):
            if q in best and other in cost_of and cost_of[q] > cost_of[other] + more:
                del best[q]
        order = {k: i for i, k in enumerate(sorted({b[0][1:] for b in best.values()}))}
        live = {}
        for to, ((cost, rank, tail), q, edit) in best.items():
            _, _, _, node, sha, first = self.live[q]
            out = None
            if edit != "D":
                name = role if edit == "K" else _NAMES[to]
                sha, first = _added(sha, first, name, text), False
                out = (turn, name, text) if self.keep_rows else None
            new = _Node(node, edit, out)
            new.refs += 1
            live[to] = (cost, order[rank, tail], 0, new, sha, first)
        for _, _, _, node, *_ in self.live.values():
            _release(node)
        self._inserts(live)
        self.live = live
        depth = 0
        while self.root.refs == 1 and self.root.kids:
            self._settle(self.root.kids[0])
            depth += 1
        self.deepest = max(self.deepest, depth)

    def _settle(self, node) -> None:
        self.root.kids, node.parent, self.root = [], None, node
        self.audit += node.edit.encode()
        if self.keep_rows and node.out:
            self.rows.append((node.edit, *node.out))

    def settled_rows(self) -> list:
        done, self.rows = self.rows, []
        return done

    def end(self) -> tuple[int, str, str]:
        """(cost, audit, digest of the repaired rows) of the cheapest edits, least in ASCII order among them."""
        cost, _, _, node, sha, _ = min((self.live[q] for q in (EMPTY, ASSISTANT) if q in self.live), key=lambda x: x[:3])
        path = []
        while node is not self.root:
            path.append(node)
            node = node.parent
        for node in reversed(path):
            self._settle(node)
        return cost, self.audit.decode(), sha.hexdigest()


def _added(sha, first: bool, role: str, text: str):
    sha = sha.copy()
    sha.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
    return sha


_SUMMARY = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def repair(rows: DataFrame, emit: str = "summary") -> DataFrame:
    """Repair every conversation of ``rows`` (conv_id, turn, role, text, dropped, as ``damage`` returns them).

    A row's first fault counts: blank (no character other than white space), duplicate (role and text seen earlier),
    truncated (the last such character is not one of ``.!?``). Edits: keep (0), rerole to user or assistant (1),
    delete (2; required for blank and duplicate rows), insert an empty user or assistant row (5); a truncated row
    that stays adds 5. The cheapest edits are taken whose role initials read ``(s?(ua)+)?``, ties by the
    ASCII-least list of edits.

    ``emit="summary"``: a row per conversation (null conv_id is one): gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256. ``emit="rows"``: the repaired rows: conv_id, position, edit, turn (null where
    inserted), role, text.

    Rows are taken by turn (nulls first); equal turns by role, then text. Null text or role counts as one space; an empty role
    has no initial and cannot be kept; a conversation whose rows were all dropped gives zeros, an empty audit and the digest of nothing; an
    empty table gives an empty result. Rows of a conversation run through one task as a sorted stream, because the digest
    is over their sequence; a task holds one Arrow batch and the unresolved edits (in "rows" their texts too).
    """
    marked = faults(rows)
    order = [F.col("conv_id").asc_nulls_first(), F.col("dropped").desc(), F.col("turn").asc_nulls_first(), "role", "text"]
    stream = marked.select("conv_id", "turn", "role", "text", "dropped", "fault").repartition("conv_id").sortWithinPartitions(*order)
    schema = T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType)])
    if emit == "rows":
        schema = (schema.add("position", "long").add("edit", "string").add("turn", "long").add("role", "string")
                  .add("text", "string"))
    else:
        for c in _SUMMARY:
            schema = schema.add(c, "long")
        schema = schema.add("audit", "string").add("repaired_sha256", "string")

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        out_schema, state, out = to_arrow_schema(schema), None, []

        def finish():
            cost, audit, sha = state.repair.end()
            if emit == "rows":
                state.take(out)
            else:
                gaps = state.high - state.low + 1 - state.turns if state.turns else 0
                out.append((state.conv, gaps, *state.count[1:], state.illegal, cost, audit, sha))

        for b in batches:
            for conv, turn, role, text, dropped, fault in zip(*(c.to_pylist() for c in b.columns)):
                if state is None or conv != state.conv:
                    if state is not None:
                        finish()
                    state = _Conversation(conv, emit == "rows")
                if not dropped:
                    state.add(turn, role, text, fault)
                    if emit == "rows":
                        state.take(out)
            if out:
                yield _batch(out, out_schema)
                out.clear()
        if state is not None:
            finish()
        if out:
            yield _batch(out, out_schema)

    return stream.mapInArrow(run, schema)


class _Conversation:
    def __init__(self, conv, keep_rows):
        self.conv, self.repair, self.count, self.illegal = conv, Repair(keep_rows), [0, 0, 0, 0], 0
        self.low = self.high = self.last = None
        self.turns = self.position = 0

    def add(self, turn, role, text, fault):
        self.count[fault] += 1
        if self.last is not None and self.last + role[:1] not in _LEGAL:
            self.illegal += 1
        self.last = role[:1]
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        self.repair.add(turn, role, text, fault)

    def take(self, out):
        for edit, turn, role, text in self.repair.settled_rows():
            out.append((self.conv, self.position, edit, turn, role, text))
            self.position += 1


def _batch(rows, schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
