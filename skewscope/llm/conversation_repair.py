"""Repair of conversation structure by a suffix-shared automaton.

Each row of a conversation, in order, is one symbol: its role's initial (s, u, a or other) and its fault (must go, truncated or
none). A node of the automaton stands for one sequence of symbols up to the end, so conversations with equal ends share
their nodes; for each node and each state of the grammar ``(s?(ua)+)?`` the cheapest cost to go and the ASCII-least audit
of that cost are worked out once, from the node that follows.

1. Faults: aggregates over a digest of role and text find each text's first occurrence; no conversation is gathered.
2. All rows are sorted by conversation and order over all tasks (ranges, so a long conversation is many tasks) and cut
   into segments of at most ``SEGMENT`` symbols; most conversations are one segment.
3. The segments are sorted by their symbols from the end and read with a stack: a segment walks down the nodes it shares with the
   one before and adds the rest. A segment that ends its conversation has the cost to go of 4 states, any other the cost of
   all 16 pairs of a state before and after it, and in which order their audits sort.
4. Conversations of several segments: costs are put together ``FAN`` segments at a time, level by level, then the states
   chosen are handed back down. Ties need the order of the audits only, as two audits over the same rows never start one another.
5. The texts are sorted once by conversation and order and read as a stream beside the audit.

Sorting by a conversation for its digest is the one step that follows a single conversation in one task, as a stream: a SHA-256 of all its
texts can be made in no other way. Audits are one row per conversation, as the result asks.

Defined results: null role and text count as one space; rows are ordered by turn (nulls first), then role, then a digest of role and
text, so equal rows are neighbours; a null conv_id is a conversation of its own; conversations without rows have zeros, an empty
audit and the hash of the empty string; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skewscope.llm.common import read, save

SEGMENT = 256
FAN = 256
REROLE = INSERT = TRUNCATED = 3
DELETE = 4
#: States: nothing yet, after system, after user, after assistant. Where each kept role leads, and a role that is put in.
KEPT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
MADE = (2, 2, 3, 2)
ROLES = {2: "user", 3: "assistant"}
FAR = 1 << 60
#: Cost to go and audit behind the last row.
END = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))
_SPACE = " \t\n\x0b\x0c\r"
_ORDER = ("conv", "turn", "role", "digest")
_CHOICE = "conv string, idx long, entry int, exit int"
_NODE = "conv string, idx long, last boolean, costs array<bigint>, ranks array<int>"


def _table(conversations: DataFrame) -> DataFrame:
    """conv (text, empty for null), turn, role, text, digest of role and text."""
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("long").cast("string"), F.lit("")).alias("conv"),
        F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    named = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return rows.withColumn("digest", F.md5(named.cast("binary")))


def faults(rows: DataFrame) -> DataFrame:
    """One row per distinct (conv, turn, role, digest): n rows, whether the first is the first of its kind, blank, cut."""
    body = F.rtrim(F.col("text"), F.lit(_SPACE))
    marked = rows.select(*_ORDER, F.lit(1).alias("n"), F.lit(False).alias("first"), (body == "").alias("blank"),
                         (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("cut"))
    some = marked.groupBy(*_ORDER).agg(F.sum("n").alias("n"), F.max("first").alias("first"), F.max("blank").alias("blank"),
                                       F.max("cut").alias("cut"))
    when = F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn"))
    firsts = some.groupBy("conv", "role", "digest").agg(F.min(when).alias("at")).select(
        "conv", F.col("at.turn").alias("turn"), "role", "digest", F.lit(0).cast("long").alias("n"), F.lit(True).alias("first"),
        F.lit(False).alias("blank"), F.lit(False).alias("cut"))
    return some.unionByName(firsts).groupBy(*_ORDER).agg(
        F.sum("n").alias("n"), F.max("first").alias("first"), F.max("blank").alias("blank"), F.max("cut").alias("cut"))


_SEGMENT = pa.schema([
    ("conv", pa.string()), ("k", pa.int64()), ("symbols", pa.string()), ("blank", pa.int64()), ("duplicate", pa.int64()),
    ("truncated", pa.int64()), ("illegal", pa.int64()), ("head", pa.string()), ("tail", pa.string()), ("least", pa.int64()),
    ("most", pa.int64()), ("turns", pa.int64()), ("head_turn", pa.int64())])


class _Segment:
    """A segment that is being read."""

    def __init__(self, conv: str, k: int) -> None:
        self.conv, self.k, self.symbols, self.size = conv, k, [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.head = self.tail = self.least = self.most = self.head_turn = None

    def add(self, symbols: str, role: str, turn: int | None) -> None:
        if self.head is None:
            self.head, self.head_turn = role, turn
        else:
            self.illegal += self.tail + role not in ("su", "ua", "au")
        self.illegal += (len(symbols) - 1)  # equal rows in succession
        if turn is not None and turn != self.most:
            self.turns += 1
            self.least = turn if self.least is None else self.least
            self.most = turn
        self.tail = role
        self.symbols.append(symbols)
        self.size += len(symbols)

    def row(self) -> tuple:
        return (self.conv, self.k, "".join(self.symbols), self.blank, self.duplicate, self.truncated, self.illegal, self.head,
                self.tail, self.least, self.most, self.turns, self.head_turn)


def _cut(rows: Iterator[tuple], size: int) -> Iterator[_Segment]:
    now, k = None, 0
    for conv, turn, role, n, first, blank, cut in rows:
        symbol = "D" if blank or not first else role.upper() if cut else role
        while n:
            if now is None or now.conv != conv or now.size >= size:
                if now is not None:
                    yield now
                now, k = _Segment(conv, k), k + 1
            take = min(n, size - now.size)
            kept = symbol != "D"
            now.blank += take if blank else 0
            now.duplicate += 0 if blank else take - kept
            now.truncated += kept and cut
            now.add(symbol + "D" * (take - 1), role, turn)
            n, symbol = n - take, "D"
    if now is not None:
        yield now


def _chunks(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for row in rows:
        out.append(row)
        if len(out) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)


def _rows(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for part in parts:
        yield from zip(*(c.to_pylist() for c in part.columns))


def segments(some: DataFrame, size: int = SEGMENT) -> DataFrame:
    """Saved: the conversations of ``faults`` cut into segments, numbered ``idx`` from 0, ``last`` and how many there are."""
    initial = F.substring("role", 1, 1)
    role = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("x"))
    ordered = some.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER).select(
        "conv", "turn", role.alias("role"), "n", "first", "blank", "cut")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _chunks((s.row() for s in _cut(_rows(parts), size)), _SEGMENT)

    types = {pa.string(): "string", pa.int64(): "long"}
    cut = ordered.mapInArrow(run, ", ".join(f"{f.name} {types[f.type]}" for f in _SEGMENT))
    cut = save(cut.withColumn("part", F.spark_partition_id()))
    by = Window.partitionBy("conv").orderBy("part", "k")
    near = F.concat(F.lag("tail").over(by), F.col("head"))
    return save(cut.select(
        "*", (F.row_number().over(by) - 1).cast("long").alias("idx"), F.lead("k").over(by).isNull().alias("last"),
        F.coalesce(~near.isin("su", "ua", "au"), F.lit(False)).cast("long").alias("illegal_before"),
        F.coalesce(F.lag("most").over(by) == F.col("head_turn"), F.lit(False)).cast("long").alias("turn_before")))


def step(symbol: str, after: tuple) -> tuple:
    """Cost and audit to go for each state before a row, from those after it."""
    must, cut, kept = symbol == "D", TRUNCATED * symbol.isupper(), KEPT.get(symbol.lower())
    best = []
    for q in range(4):
        cost, letter, to = after[q][0] + DELETE, "D", q
        if not must:
            if kept and kept[q] is not None and after[kept[q]][0] + cut < cost:
                cost, letter, to = after[kept[q]][0] + cut, "K", kept[q]
            if after[MADE[q]][0] + REROLE + cut < cost:
                cost, letter, to = after[MADE[q]][0] + REROLE + cut, "R", MADE[q]
        best.append((cost, letter + after[to][1]) if cost < FAR else (FAR, ""))

    def made(q: int, then: tuple) -> tuple:
        return min(best[q], (INSERT + then[0], "I" + then[1])) if then[0] < FAR else best[q]

    two, three = made(2, best[3]), made(3, best[2])
    return made(0, two), made(1, two), two, three


def _ends(last: bool) -> tuple:
    return (END,) if last else tuple(tuple((0 if q == e else FAR, "") for q in range(4)) for e in range(4))


def walk(keys: Iterator[tuple]) -> Iterator[tuple]:
    """(conv, idx, key) sorted by key -> conv, idx, costs, ranks, audits; a key is F (last) or M and the symbols from the end."""
    stack: list[tuple] = []
    before = ""
    for conv, idx, key in keys:
        same = 0
        for x, y in zip(before, key):
            if x != y:
                break
            same += 1
        del stack[same:]
        for symbol in key[same:]:
            if not stack:
                stack.append(_ends(symbol == "F"))
            else:
                stack.append(tuple(step(symbol, after) for after in stack[-1]))
        before = key
        node = stack[-1]
        if len(node) == 1:
            yield conv, idx, [c for c, _ in node[0]], [], [a for _, a in node[0]]
            continue
        ranks = []
        for q in range(4):
            order = sorted(range(4), key=lambda e: (node[e][q][0] >= FAR, node[e][q][1]))
            ranks += [order.index(e) for e in range(4)]
        yield conv, idx, [node[e][q][0] for q in range(4) for e in range(4)], ranks, [
            node[e][q][1] for q in range(4) for e in range(4)]


_SOLVED = pa.schema([("conv", pa.string()), ("idx", pa.int64()), ("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int32())),
                     ("audits", pa.list_(pa.string()))])


def solved(cut: DataFrame) -> DataFrame:
    """Saved: the segments' costs, orders of audits and audits."""
    key = F.concat(F.when(F.col("last"), "F").otherwise("M"), F.reverse("symbols")).alias("key")
    ordered = cut.select("conv", "idx", key).repartitionByRange("key", "conv", "idx").sortWithinPartitions("key")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _chunks(walk(_rows(parts)), _SOLVED)

    return save(ordered.mapInArrow(run, "conv string, idx long, costs array<bigint>, ranks array<int>, audits array<string>"))


def _fold(costs: list[int], ranks: list[int], suffix: list[list[int]], orders: list[list[int]]) -> tuple:
    """A segment before a suffix (per end, the cost of 4 states; per state, the order of the ends): the same of both, and the
    state that each (end, state) goes on with."""
    out, go = [], []
    for after in suffix:
        choice = [min(range(4), key=lambda r: (costs[4 * q + r] + after[r], ranks[4 * q + r])) for q in range(4)]
        go.append(choice)
        out.append([min(FAR, costs[4 * q + r] + after[r]) for q, r in enumerate(choice)])
    if len(suffix) == 1:
        return out, [], go
    by = []
    for q in range(4):
        order = sorted(range(4), key=lambda e: (out[e][q] >= FAR, ranks[4 * q + go[e][q]], orders[go[e][q]][e]))
        by.append([order.index(e) for e in range(4)])
    return out, by, go


def _suffix(row) -> tuple[list[list[int]], list[list[int]]]:
    c, k = list(row.costs), list(row.ranks)
    if row.last:
        return [c], []
    return [[c[4 * q + e] for q in range(4)] for e in range(4)], [k[4 * q:4 * q + 4] for q in range(4)]


def _together(pdf: pd.DataFrame) -> pd.DataFrame:
    """Segments in succession as one."""
    rows = list(pdf.sort_values("idx").itertuples())
    suffix, orders = _suffix(rows[-1])
    for row in reversed(rows[:-1]):
        suffix, orders, _ = _fold(list(row.costs), list(row.ranks), suffix, orders)
    last = bool(rows[-1].last)
    costs = suffix[0] if last else [suffix[e][q] for q in range(4) for e in range(4)]
    return pd.DataFrame({"conv": [rows[0].conv], "idx": [int(rows[0].up)], "last": [last], "costs": [costs],
                         "ranks": [[r for o in orders for r in o]]})


def _apart(pdf: pd.DataFrame) -> pd.DataFrame:
    """The states before and after each segment, given those of their whole (``exit`` -1: the end of the conversation)."""
    rows = list(pdf.sort_values("idx").itertuples())
    suffix, orders = _suffix(rows[-1])
    end = max(0, rows[-1].exit)
    goes = []
    for row in reversed(rows[:-1]):
        suffix, orders, go = _fold(list(row.costs), list(row.ranks), suffix, orders)
        goes.append(go[end if len(go) > 1 else 0])
    q, entry, out = rows[0].entry, [], []
    for go in reversed(goes):
        entry.append(q)
        q = go[q]
        out.append(q)
    return pd.DataFrame({"conv": [r.conv for r in rows], "idx": [r.idx for r in rows], "entry": [*entry, q],
                         "exit": [*out, rows[-1].exit]})


def choices(nodes: DataFrame, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """Saved: for conversations of several segments the states before and after each, and the conversations' costs."""
    levels = [save(nodes)]
    while levels[-1].where("idx > 0").limit(1).count():
        levels.append(save(levels[-1].withColumn("up", F.floor(F.col("idx") / fan)).groupBy("conv", "up").applyInPandas(_together, _NODE)))
    chosen = levels[-1].select("conv", "idx", F.lit(0).alias("entry"), F.lit(-1).alias("exit"))
    for below in reversed(levels[:-1]):
        up = below.withColumn("up", F.floor(F.col("idx") / fan)).join(chosen.withColumnRenamed("idx", "up"), ["conv", "up"])
        chosen = save(up.groupBy("conv", "up").applyInPandas(_apart, _CHOICE))
    return chosen, levels[-1].select("conv", F.col("costs")[0].alias("cost"))


def audits(cut: DataFrame, fan: int = FAN) -> DataFrame:
    """conv, cost, audit of the cheapest edits of the conversations in ``segments``."""
    parts = solved(cut)
    parts = parts.join(cut.select("conv", "idx", "last"), ["conv", "idx"])
    single = parts.where("idx = 0 and last").select("conv", F.col("costs")[0].alias("cost"), F.col("audits")[0].alias("audit"))
    many = parts.join(cut.where("idx = 1").select("conv"), "conv", "left_semi")
    chosen, costs = choices(many.select("conv", "idx", "last", "costs", "ranks"), fan)
    place = F.when(F.col("last"), F.col("entry")).otherwise(4 * F.col("entry") + F.col("exit"))
    pieces = many.join(chosen, ["conv", "idx"]).select("conv", F.struct("idx", F.col("audits")[place].alias("audit")).alias("piece"))
    whole = pieces.groupBy("conv").agg(F.array_sort(F.collect_list("piece")).alias("pieces")).select(
        "conv", F.array_join(F.col("pieces.audit"), "").alias("audit"))
    return single.unionByName(costs.join(whole, "conv").select("conv", "cost", "audit"))


def _edited(rows: Iterator[tuple]) -> Iterator[tuple]:
    """The sorted stream: (facts, None) at the start of a conversation, then (None, (role, text, edit)) for each row that is
    left, then (None, None) at its end."""
    audit, p, q, open_ = "", 0, 0, False

    def inserts(p: int, q: int):
        out = []
        while p < len(audit) and audit[p] == "I":
            q, p = MADE[q], p + 1
            out.append((None, (ROLES[q], "", "I")))
        return out, p, q

    for facts, role, text in rows:
        if facts is not None:
            if open_:
                yield from inserts(p, q)[0]
                yield None, None
            audit, p, q, open_ = facts["audit"], 0, 0, True
            yield facts, None
            continue
        new, p, q = inserts(p, q)
        yield from new
        edit, p = audit[p], p + 1
        if edit == "K":
            q = KEPT[role[0]][q]
            yield None, (role, text, "K")
        elif edit == "R":
            q = MADE[q]
            yield None, (ROLES[q], text, "R")
    if open_:
        yield from inserts(p, q)[0]
        yield None, None


_FACTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_REPAIRED = pa.schema([("conv", pa.string()), *((c, pa.int64()) for c in _FACTS), ("audit", pa.string()), ("repaired_sha256", pa.string())])
_TURNS = pa.schema([("conv", pa.string()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])


def _digests(rows: Iterator[tuple]) -> Iterator[tuple]:
    facts, sha, empty = None, None, True
    for begin, row in _edited(rows):
        if begin is not None:
            facts, sha, empty = begin, hashlib.sha256(), True
        elif row is not None:
            sha.update(f"{'' if empty else chr(10)}{row[0]}:{row[1]}".encode("utf-8", "surrogatepass"))
            empty = False
        else:
            yield facts["conv"], *(facts[c] for c in _FACTS), facts["audit"], sha.hexdigest()


def _placed(rows: Iterator[tuple]) -> Iterator[tuple]:
    conv, place = None, 0
    for begin, row in _edited(rows):
        if begin is not None:
            conv, place = begin["conv"], 0
        elif row is not None:
            yield conv, place, *row
            place += 1


def _stream(conversations: DataFrame, conv_ids: DataFrame | None, size: int, fan: int) -> DataFrame:
    """facts, role, text: per conversation its facts, then its rows in order."""
    rows = _table(conversations)
    cut = segments(save(faults(rows)), size)
    total = lambda c: F.sum(c).cast("long")
    facts = cut.groupBy("conv").agg(
        F.coalesce(F.max("most") - F.min("least") + 1 - total(F.col("turns") - F.col("turn_before")), F.lit(0)).alias("gaps"),
        total("blank").alias("blank"), total("duplicate").alias("duplicate"), total("truncated").alias("truncated"),
        total(F.col("illegal") + F.col("illegal_before")).alias("illegal"))
    facts = facts.join(audits(cut, fan), "conv")
    ids = conversations if conv_ids is None else conv_ids
    ids = ids.select(F.coalesce(F.col("conv_id").cast("long").cast("string"), F.lit("")).alias("conv")).distinct()
    facts = ids.join(facts, "conv", "left").select(
        "conv", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in _FACTS), F.coalesce("audit", F.lit("")).alias("audit"))
    heads = facts.select("conv", F.struct("conv", *_FACTS, "audit").alias("facts"))
    both = heads.unionByName(rows.withColumn("facts", F.lit(None).cast(heads.schema["facts"].dataType)), allowMissingColumns=True)
    return both.repartition("conv").sortWithinPartitions("conv", F.col("facts").isNull(), "turn", "role", "digest").select(
        "facts", "role", "text")


def _conv_id() -> F.Column:
    return F.when(F.col("conv") != "", F.col("conv")).cast("long").alias("conv_id")


def repair(conversations: DataFrame, conv_ids: DataFrame | None = None, size: int = SEGMENT, fan: int = FAN) -> DataFrame:
    """Per conversation of ``conv_ids`` (or of the table): faults, cost and audit of the cheapest repair, hash of the result."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _chunks(_digests(_rows(parts)), _REPAIRED)

    out = _stream(conversations, conv_ids, size, fan).mapInArrow(
        run, f"conv string, {', '.join(f'{c} long' for c in _FACTS)}, audit string, repaired_sha256 string")
    return out.select(_conv_id(), *_FACTS, "audit", "repaired_sha256")


def repaired_turns(conversations: DataFrame, size: int = SEGMENT, fan: int = FAN) -> DataFrame:
    """The repaired conversations: conv_id, place from 0, role, text, edit (K, R or I)."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _chunks(_placed(_rows(parts)), _TURNS)

    out = _stream(conversations, None, size, fan).mapInArrow(run, "conv string, place long, role string, text string, edit string")
    return out.select(_conv_id(), "place", "role", "text", "edit")


def damaged(conversations: DataFrame) -> DataFrame:
    """The damage of the query, by the crc32 of conv_id:turn (nulls: one space)."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", word("role").alias("role"), word("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        copies.alias("copy")).drop("copy")


def op11_suffix_automaton(spark, sf_dir: str) -> DataFrame:
    table = read(spark, sf_dir, "conversations")
    return repair(damaged(table), table.select("conv_id"))


_CRC = """xor(list_reduce([4294967295] || list_transform(string_split({s}, ''), lambda ch: ascii(ch)::BIGINT), lambda c, b:
    xor(c >> 8, list_reduce([xor(c & 255, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, z:
        CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))), 4294967295)"""
_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _sql() -> str:
    """Cost to go, audit and text to go by a recursion from the end; a state's value is (cost, audit, text)."""
    out = {}
    for q in range(4):
        made = ROLES[MADE[q]]
        keep = " ".join(f"WHEN ini = '{r}' THEN {{'c': v{to[q]}.c + tr, 'a': 'K' || v{to[q]}.a, 't': chr(10) || role || ':' || text || v{to[q]}.t}}"
                        for r, to in KEPT.items() if to[q] is not None)
        none = "{'c': 1000000000, 'a': '~', 't': ''}"
        to = f"v{MADE[q]}"
        out[q] = (f"list_min([{{'c': v{q}.c + {DELETE}, 'a': 'D' || v{q}.a, 't': v{q}.t}}, CASE WHEN del THEN {none} {keep} ELSE {none} END, "
                  f"CASE WHEN del THEN {none} ELSE {{'c': {to}.c + {REROLE} + tr, 'a': 'R' || {to}.a, "
                  f"'t': chr(10) || '{made}:' || text || {to}.t}} END])")
    both, one = "chr(10) || 'user:' || chr(10) || 'assistant:'", "chr(10) || 'assistant:'"
    ins = lambda q, b: (f"list_min([b{q}, {{'c': {b}.c + {INSERT}, 'a': 'I' || {b}.a, "  # noqa: E731
                        f"'t': chr(10) || '{ROLES[MADE[q]]}:' || {b}.t}}])")
    return f"""
WITH RECURSIVE x AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {_CRC.format(s="coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
             CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM x WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(length(role) || ':' || role || text), copy) AS i,
             rtrim(text, {_WS}) AS body, substr(role, 1, 1) AS ini FROM d),
f AS (SELECT *, body = '' AS blank, body <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate,
             right(body, 1) NOT IN ('.', '!', '?') AS cut, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini AS pair FROM o),
r AS (SELECT *, blank OR duplicate AS del, CASE WHEN cut THEN {TRUNCATED} ELSE 0 END AS tr FROM f),
g AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
             count(*) FILTER (cut AND NOT del) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
      FROM r GROUP BY conv_id),
p(conv_id, i, v0, v1, v2, v3) AS (
    SELECT conv_id, n, {', '.join(f"{{'c': {c}, 'a': '{a}', 't': {t}}}" for (c, a), t in zip(END, ["''", both, one, "''"]))} FROM g
    UNION ALL
    SELECT conv_id, i, {ins(0, "w2")}, {ins(1, "w2")}, w2, w3
    FROM (SELECT *, {ins(2, "b3")} AS w2, {ins(3, "b2")} AS w3
          FROM (SELECT p.conv_id, p.i - 1 AS i, {', '.join(f'{e} AS b{q}' for q, e in out.items())}
                FROM p JOIN r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i))),
e AS (SELECT conv_id, v0 FROM p WHERE i = 0)
SELECT c.conv_id, coalesce(g.gaps, 0)::BIGINT AS gaps, coalesce(g.blank, 0)::BIGINT AS blank,
       coalesce(g.duplicate, 0)::BIGINT AS duplicate, coalesce(g.truncated, 0)::BIGINT AS truncated,
       coalesce(g.illegal, 0)::BIGINT AS illegal, coalesce(e.v0.c, 0)::BIGINT AS cost, coalesce(e.v0.a, '') AS audit,
       sha256(coalesce(substr(e.v0.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""


SQL = _sql()
