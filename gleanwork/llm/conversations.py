"""Repair of the structure of conversations by cheapest edits.

The roles of a repaired conversation are nothing, or an optional system turn and then pairs of user and assistant.
A row may be kept (K), given the role user or assistant (R, `REROLE`) or deleted (D, `DELETE`), and an
empty turn of user or assistant may be inserted anywhere (I, `INSERT`). Blank rows and repeats of a row seen earlier must be deleted; a
truncated row that stays costs `TRUNCATED` more. Of the cheapest edits those whose letters come first in ASCII order are taken.

This is a shortest path over four states, solved from the end by a Viterbi recursion whose steps are matrices of costs. Rows are
sorted over the whole cluster and cut into chunks of `CHUNK` rows, however long a conversation is:

1. Every chunk starts from a speculative vector of costs (as if the conversation ended behind it).
2. A fix-up pass gives each chunk the vector that its successor made and reruns it, until the new vector differs from the former one at
   the same row by a constant only; what lies before stays as it is, but for the constant. Passes are repeated until none changes a chunk.
   Pass p lets a vector run through up to 2^p chunks at once, so even matrices that never lose rank, such as those of long
   runs of rows with strange roles, take a number of passes that grows with the logarithm of the length.
3. The constants of the chunks add up to the conversation's cost. The stitched vectors drive the tracing: from a state, the least
   letter is taken that leads to the row's cost. Chunks trace from a speculative state and are fixed up in the same way.

Rows are ordered by turn (nulls first), then by a digest of role and text. Equal rows of one turn are counted, not repeated, until the edits are
applied. What a chunk holds is one byte a row with its turn and digest; texts move once, at the end, to be applied in a
stream, so that no conversation is held in memory but for its letters.

Null roles and texts read as one blank; a null conversation is a conversation, null turns come first. Any text counts whole. Empty
table: empty result. Other columns are not read; the columns of the result have fixed names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork.session import staged

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
CHUNK = 256
_BLANKS = " \t\n\x0b\x0c\r"
_CLASSES = "sua"
#: States: nothing yet, after system, after user, after assistant. Where a user or assistant turn leads.
_TO_USER, _TO_ASSISTANT = 2, 3
_NEXT = (_TO_USER, _TO_USER, _TO_ASSISTANT, _TO_USER)
Vector = tuple[int, int, int, int]
#: Costs at the end: a conversation may end at once, or after its last assistant turn.
END: Vector = (0, 2 * INSERT, INSERT, 0)


@cache
def step(after: Vector, code: int) -> tuple[Vector, int, tuple[tuple[str, str, int], ...]]:
    """(costs before the row less their least, that least, and for each state the letters up to the row's own, the roles they give
    and the state behind the row)."""
    kind, fault = code % 4, code // 4
    options: list[dict[str, tuple[int, int]]] = []
    for s in range(4):
        ways = {"D": (DELETE + after[s], s)}
        if fault < 2:
            more = TRUNCATED * fault
            if kind == 0 and s == 0:
                ways["K"] = (more + after[1], 1)
            elif kind == (2 if s == 2 else 1):
                ways["K"] = (more + after[_NEXT[s]], _NEXT[s])
            ways["R"] = (REROLE + more + after[_NEXT[s]], _NEXT[s])
        options.append(ways)
    costs = [min(c for c, _ in ways.values()) for ways in options]
    for _ in range(2):
        costs = [min(c, INSERT + costs[_NEXT[s]]) for s, c in enumerate(costs)]
    chosen = []
    for start in range(4):
        s, letters, roles = start, "", ""
        while True:
            letter = next((x for x in "DIKR" if (costs[_NEXT[s]] + INSERT if x == "I" else options[s].get(x, (-1, 0))[0]) == costs[s]))
            letters += letter
            roles += {"D": "", "K": "="}.get(letter, "ua"[_NEXT[s] - 2])
            if letter != "I":
                chosen.append((letters, roles, options[s][letter][1]))
                break
            s = _NEXT[s]
    least = min(costs)
    return (costs[0] - least, costs[1] - least, costs[2] - least, costs[3] - least), least, tuple(chosen)


def tail(state: int) -> str:
    """Roles of the turns inserted at the end."""
    return {0: "", 1: "ua", 2: "a", 3: ""}[state]


def _written(vector: Vector, first: str) -> str:
    return ",".join(map(str, vector)) + "," + first


def _read(value: str) -> tuple[Vector, str]:
    a, b, c, d, first = value.split(",")
    return (int(a), int(b), int(c), int(d)), first


def _initial(code: int) -> str:
    return "suax"[code % 4]


def _legal(pair: str) -> bool:
    return pair in ("su", "ua", "au")


# --- rows ---------------------------------------------------------------------------------------------------


def rows_of(conversations: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: str | None = None) -> DataFrame:
    """(conv, turn, role, text, copies, digest, code) with nulls read and the faults of each row by itself found."""
    q = lambda c: F.col("`" + c.replace("`", "``") + "`")
    filled = lambda c: F.coalesce(q(c).cast("string"), F.lit(" "))
    rows = conversations.select(q(conversation).alias("conv"), q(turn).cast("long").alias("turn"), filled(role).alias("role"), filled(text).alias("text"),
                                (q(copies) if copies else F.lit(1)).cast("long").alias("copies"))
    ending = F.right(F.rtrim("text", F.lit(_BLANKS)), F.lit(1))
    fault = F.when(ending == "", 2).when(~ending.isin(".", "!", "?"), 1).otherwise(0)
    kind = F.instr(F.lit(_CLASSES), F.left("role", F.lit(1)))
    kind = F.when((F.col("role") != "") & (kind > 0), kind - 1).otherwise(3)
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", F.lit(":"), "text"), 256))
    return rows.withColumns({"digest": digest, "code": (kind + 4 * fault).cast("int")})


def counted(rows: DataFrame) -> DataFrame:
    """One row per conversation, turn and digest: its copies, code, and whether role and text appear here first."""
    keys = ["conv", "turn", "digest"]
    some = rows.groupBy(*keys).agg(F.sum("copies").alias("n"), F.min("code").alias("code"))
    some = staged(some, "turns")
    first = some.groupBy("conv", "digest").agg(F.min(F.struct("turn"))["turn"].alias("turn"))
    both = some.select(*keys, "n", "code", F.lit(0).alias("first")).unionByName(first.select(*keys, F.lit(0).cast("long").alias("n"), F.lit(-1).alias("code"), F.lit(1).alias("first")))
    return both.groupBy(*keys).agg(F.max("n").alias("n"), F.max("code").alias("code"), F.max("first").alias("first"))


def faults(turns: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated), each row by its first fault."""
    blank = F.col("code") >= 8
    wide = lambda c: c.cast("decimal(38,0)")
    per_turn = turns.groupBy("conv", "turn").agg(
        F.sum(F.when(blank, F.col("n")).otherwise(0)).alias("blank"), F.sum(F.when(blank, 0).otherwise(F.col("n") - F.col("first"))).alias("duplicate"),
        F.sum(F.when((F.col("first") == 1) & F.col("code").between(4, 7), 1).otherwise(0)).alias("truncated"))
    gaps = wide(F.max("turn")) - wide(F.min("turn")) + 1 - F.count("turn")
    return per_turn.groupBy("conv").agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])


# --- chunks -------------------------------------------------------------------------------------------------


def _packed(size: int) -> Callable:
    """Sorted rows to chunks; `more`: the conversation has a further chunk, or one before, in this part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk: dict[str, list] | None = None
        made: list[tuple] = []
        kind = None

        def closed(c: dict, more: bool) -> tuple:
            return (c["conv"], c["part"], c["k"], more or c["k"] > 0, bytes(c["codes"]), c["extra"], c["turns"], c["digests"])

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            types = [kind, pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary())]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                                              names=["conv", "part", "k", "more", "codes", "extra", "turns", "digests"])

        for batch in batches:
            kind = batch.schema.field("conv").type
            for conv, turn, digest, code, extra, part in zip(*[batch.column(c).to_pylist() for c in ("conv", "turn", "digest", "code", "extra", "part")]):
                if chunk is None or chunk["conv"] != conv or len(chunk["codes"]) >= size:
                    same = chunk is not None and chunk["conv"] == conv
                    if chunk is not None:
                        made.append(closed(chunk, same))
                    chunk = {"conv": conv, "part": part, "k": chunk["k"] + 1 if same else 0, "codes": [], "extra": [], "turns": [], "digests": []}
                for name, value in (("codes", code), ("extra", extra), ("turns", turn), ("digests", digest)):
                    chunk[name].append(value)
            if len(made) >= 64:
                yield batch_of(made)
                made = []
        if chunk is not None:
            yield batch_of([*made, closed(chunk, False)])
    return run


def chunks(turns: DataFrame, size: int = CHUNK) -> DataFrame:
    """(conv, no, more, codes, extra, turns, digests): chunk `no` of its conversation; `more`: not its only one. `extra`: deletions of repeats behind each row."""
    conv = turns.schema["conv"].dataType.simpleString()
    code = F.when(F.col("first") == 1, F.col("code")).otherwise(F.col("code") % 4 + 8).cast("int")
    order = turns.select("conv", "turn", "digest", code.alias("code"), (F.col("n") - 1).alias("extra"))
    order = order.repartitionByRange("conv", "turn", "digest").sortWithinPartitions("conv", "turn", "digest").withColumn("part", F.spark_partition_id())
    schema = f"conv {conv}, part int, k long, more boolean, codes binary, extra array<long>, turns array<long>, digests array<binary>"
    cut = staged(order.mapInArrow(_packed(size), schema), "chunks")
    # Conversations in several parts: fewer than there are parts.
    per_part = cut.groupBy("conv", "part").agg(F.count("*").alias("n"))
    split = per_part.groupBy("conv").agg(F.collect_list(F.struct("part", "n")).alias("parts")).filter(F.size("parts") > 1)
    split = split.select(F.col("conv").alias("its"), F.explode(F.transform("parts", lambda p: F.struct(
        p["part"].alias("at"), F.aggregate("parts", F.lit(0).cast("long"), lambda s, q: s + F.when(q["part"] < p["part"], q["n"]).otherwise(0)).alias("before")))).alias("x"))
    split = F.broadcast(split.select("its", "x.at", "x.before"))
    numbered = cut.join(split, F.col("conv").eqNullSafe(F.col("its")) & (F.col("part") == F.col("at")), "left")
    return numbered.select("conv", (F.col("k") + F.coalesce("before", F.lit(0))).alias("no"), (F.col("more") | F.col("at").isNotNull()).alias("more"),
                           "codes", "extra", "turns", "digests")


# --- passes -------------------------------------------------------------------------------------------------


def _backward(codes: bytes, given: str, before: tuple[str, str, int] | None) -> tuple[str, int]:
    """(value made at the chunk's start, its constant). `before`: (given, made, constant) of the former run, at which this one stops once
    both vectors differ by a constant only."""
    vector, _ = _read(given)
    total = 0
    old, old_total = (_read(before[0])[0], 0) if before else (None, 0)
    for code in reversed(codes):
        if vector == old:
            return before[1], before[2] - old_total + total
        vector, least, _ = step(vector, code)
        total += least
        if old is not None:
            old, gone, _ = step(old, code)
            old_total += gone
    return _written(vector, _initial(codes[0])), total


def _vectors(codes: bytes, given: str) -> list[Vector]:
    """Costs behind each row."""
    vector = _read(given)[0]
    out = []
    for code in reversed(codes):
        out.append(vector)
        vector = step(vector, code)[0]
    return out[::-1]


def _forward(codes: bytes, given: str, vectors: str) -> str:
    state = int(given)
    for code, after in zip(codes, _vectors(codes, vectors)):
        state = step(after, code)[2][state][2]
    return str(state)


_CHUNK_SCHEMA = "no long, more boolean, codes binary, vector string, given string, made string, total long, changed boolean"


def _run(forward: bool, span: int) -> Callable:
    """Chunks in the order of the pass; a value made here goes on to the next chunk of the same run of 2^span."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None
        for batch in batches:
            rows = batch.to_pylist()
            out: dict[str, list] = {"given": [], "made": [], "total": [], "changed": []}
            for r in rows:
                here = (r["conv"], r["no"] >> span)
                due = last[1] if last is not None and last[0] == here else r["due"]
                if r["made"] is not None and r["given"] == due:
                    made, total, changed = r["made"], r["total"], False
                elif forward:
                    made, total, changed = _forward(r["codes"], due, r["vector"]), r["total"], True
                else:
                    former = (r["given"], r["made"], r["total"]) if r["made"] is not None else None
                    (made, total), changed = _backward(r["codes"], due, former), True
                last = (here, made)
                for name, value in (("given", due), ("made", made), ("total", total), ("changed", changed)):
                    out[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("no"), batch.column("more"), batch.column("codes"), batch.column("vector"), pa.array(out["given"], pa.string()),
                 pa.array(out["made"], pa.string()), pa.array(out["total"], pa.int64()), pa.array(out["changed"], pa.bool_())],
                names=["conv", "no", "more", "codes", "vector", "given", "made", "total", "changed"])
    return run


def settled(cut: DataFrame, forward: bool, edge: str, guess: str) -> DataFrame:
    """Chunks (conv, no, more, codes, vector, total) with the values `given` and `made` once no pass changes one.

    `edge` goes into the outermost chunk of a conversation, `guess` is the first value of all others.
    """
    conv = cut.schema["conv"].dataType.simpleString()
    schema = f"conv {conv}, {_CHUNK_SCHEMA}"
    outer = F.col("no") == 0 if forward else ~F.col("more")
    state = cut.withColumns({"given": F.lit(None).cast("string"), "made": F.lit(None).cast("string"), "due": F.when(outer, edge).otherwise(guess)})
    given = ("conv", "no", "more", "codes", "vector", "given", "made", "total", "due")
    state = staged(state.select(*given).mapInArrow(_run(forward, 0), schema), "settled")
    moving = state.filter("more")
    span, pending = 0, moving.limit(1).count()
    while pending:
        neighbour = moving.select(F.col("conv").alias("c"), (F.col("no") + (1 if forward else -1)).alias("m"), F.col("made").alias("due"))
        due = moving.join(neighbour, F.col("conv").eqNullSafe(F.col("c")) & (F.col("no") == F.col("m")), "left").withColumn("due", F.coalesce("due", F.lit(edge)))
        run = F.shiftright("no", span)
        placed = due.select(*given).repartition(F.col("conv"), run)
        placed = placed.sortWithinPartitions("conv", run, F.col("no").asc() if forward else F.col("no").desc())
        moving = staged(placed.mapInArrow(_run(forward, span), schema), "settled")
        pending = moving.filter("changed").limit(1).count()
        span += 1
    return state.filter("not more").unionByName(moving)


# --- edits --------------------------------------------------------------------------------------------------


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {"conv": [], "turn": [], "digest": [], "edits": [], "roles": [], "deletes": [], "tail": []}
        for r in batch.to_pylist():
            state = int(r["given"])
            vectors = _vectors(r["codes"], r["vector"])
            for i, (code, after) in enumerate(zip(r["codes"], vectors)):
                letters, roles, state = step(after, code)[2][state]
                last = r["ends"] and i == len(r["codes"]) - 1
                for name, value in (("conv", r["conv"]), ("turn", r["turns"][i]), ("digest", r["digests"][i]), ("edits", letters), ("roles", roles),
                                    ("deletes", r["extra"][i]), ("tail", tail(state) if last else "")):
                    out[name].append(value)
        types = [batch.schema.field("conv").type, pa.int64(), pa.binary(), pa.string(), pa.string(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per chunk its part of the cost and its illegal pairs; copies of a row are adjacent to each other."""
    for batch in batches:
        out: dict[str, list] = {"conv": [], "cost": [], "illegal": []}
        for r in batch.to_pylist():
            initials = "".join(map(_initial, r["codes"])) + _read(r["given"])[1]
            extra = sum(r["extra"])
            out["conv"].append(r["conv"])
            out["cost"].append(r["total"] + DELETE * extra + (_read(r["made"])[0][0] if r["no"] == 0 else 0))
            out["illegal"].append(extra + sum(not _legal(a + b) for a, b in zip(initials, initials[1:])))
        types = [batch.schema.field("conv").type, pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))


def edits(turns: DataFrame, size: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """From counted rows: the script (conv, turn, digest, edits, roles, deletes, tail), a row of it per counted row, and (conv, cost, illegal).

    `edits` are the letters up to the row's own, `roles` the roles of all but deletions ('=' as it was), then come `deletes`
    deletions of its copies, and behind a conversation's last row the inserted roles `tail`.
    """
    cut = staged(chunks(turns, size), "cut")
    thin = cut.select("conv", "no", "more", "codes", F.lit(None).cast("string").alias("vector"), F.lit(None).cast("long").alias("total"))
    edge = _written(END, "")
    back = staged(settled(thin, False, edge, edge), "costs")
    own = back.select(F.col("conv").alias("c"), F.col("no").alias("m"), F.col("given").alias("vector"), F.col("made"), F.col("total"))
    stitched = staged(cut.join(own, F.col("conv").eqNullSafe(F.col("c")) & (F.col("no") == F.col("m"))).drop("c", "m"), "stitched")
    conv = cut.schema["conv"].dataType.simpleString()
    sums = stitched.select("conv", "no", "codes", "extra", F.col("vector").alias("given"), "made", "total").mapInArrow(_sums, f"conv {conv}, cost long, illegal long")
    sums = sums.groupBy("conv").agg(F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"))
    states = settled(stitched.select("conv", "no", "more", "codes", "vector", "total"), True, "0", "3")
    at = states.select(F.col("conv").alias("c"), F.col("no").alias("m"), F.col("given").alias("given"))
    ready = stitched.join(at, F.col("conv").eqNullSafe(F.col("c")) & (F.col("no") == F.col("m")))
    ready = ready.select("conv", "codes", "extra", "turns", "digests", "vector", "given", F.col("vector").endswith(",").alias("ends"))
    script = ready.mapInArrow(_traced, f"conv {conv}, turn long, digest binary, edits string, roles string, deletes long, tail string")
    return script, sums


# --- applied ------------------------------------------------------------------------------------------------

_NAMES = {"u": "user", "a": "assistant"}
_STREAM = ("conv", "turn", "digest", "is_text", "edits", "roles", "deletes", "tail", "role", "text")


def _stream(rows: DataFrame, script: DataFrame) -> DataFrame:
    """Script rows, each followed by the texts it speaks of, conversations whole and in order. Texts move here, once."""
    told = script.select(*[c for c in _STREAM if c in script.columns], F.lit(False).alias("is_text"))
    texts = rows.select("conv", "turn", "digest", "role", "text", F.lit(True).alias("is_text"))
    both = told.unionByName(texts, allowMissingColumns=True).select(*_STREAM)
    return both.repartition("conv").sortWithinPartitions("conv", "turn", "digest", "is_text")


def _events(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conversation, letters, [(role, text), ...]) for each script row."""
    told: dict | None = None
    for batch in batches:
        for i in range(batch.num_rows):
            r = {c: batch.column(c)[i].as_py() for c in ("conv", "is_text", "edits", "roles", "deletes", "tail", "role")}
            if not r["is_text"]:
                told = r
                continue
            if told is None:
                continue  # a copy of the row before
            text = batch.column("text")[i].as_py() if "=" in told["roles"] or told["edits"][-1] == "R" else ""
            turns = [(_NAMES.get(x, r["role"]), "") for x in told["roles"]]
            if told["edits"][-1] != "D":
                turns[-1] = (turns[-1][0], text)
            turns += [(_NAMES[x], "") for x in told["tail"]]
            yield told["conv"], told["edits"] + "D" * told["deletes"] + "I" * len(told["tail"]), turns
            told = None


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size, last, place, kind = 0, None, 0, None

    def batch_of() -> pa.RecordBatch:
        types = [kind, pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([h[i] for h in held], t) for i, t in enumerate(types)], names=["conv", "place", "role", "text"])

    def seen() -> Iterator[pa.RecordBatch]:
        nonlocal kind
        for b in batches:
            kind = b.schema.field("conv").type
            yield b

    for conv, _, turns in _events(seen()):
        place = place if last is not None and last[0] == conv else 0
        last = (conv,)
        for role, text in turns:
            held.append((conv, place, role, text))
            place, size = place + 1, size + len(text)
        if size > 1 << 22 or len(held) > 5000:
            yield batch_of()
            held, size = [], 0
    if held:
        yield batch_of()


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation its letters and the hash of its repaired turns, fed turn by turn."""
    kind = None
    done: list[tuple] = []
    now: tuple | None = None

    def seen() -> Iterator[pa.RecordBatch]:
        nonlocal kind
        for b in batches:
            kind = b.schema.field("conv").type
            yield b

    def batch_of() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], kind), pa.array(["".join(d[1]) for d in done], pa.string()), pa.array([d[2].hexdigest() for d in done], pa.string())],
            names=["conv", "audit", "repaired_sha256"])

    for conv, letters, turns in _events(seen()):
        if now is None or now[0] != conv:
            now = (conv, [], hashlib.sha256(), [])
            done.append(now)
            if len(done) > 2000:
                last = done.pop()
                yield batch_of()
                done = [last]
        now[1].append(letters)
        for role, text in turns:
            if now[3]:
                now[2].update(b"\n")
            else:
                now[3].append(True)
            now[2].update(f"{role}:{text}".encode())
    if done:
        yield batch_of()


def repaired(rows: DataFrame, script: DataFrame) -> DataFrame:
    """(conv, place, role, text): the turns of the repaired conversations."""
    conv = rows.schema["conv"].dataType.simpleString()
    return _stream(rows, script).mapInArrow(_repaired, f"conv {conv}, place long, role string, text string")


def repair(rows: DataFrame, size: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """From `rows_of`: the script and a report (conv, gaps, blank, duplicate, truncated, illegal, cost)."""
    turns = staged(counted(rows), "counted")
    script, sums = edits(turns, size)
    script = staged(script, "script")
    both = faults(turns).unionByName(sums, allowMissingColumns=True)
    return script, both.groupBy("conv").agg(*[F.max(c).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")])


def report(conversations: DataFrame, rows: DataFrame, size: int = CHUNK) -> DataFrame:
    """One row per conversation of `conversations` (column conv): the faults of `rows`, the cost, letters and hash of their repair."""
    script, found = repair(rows, size)
    conv = rows.schema["conv"].dataType.simpleString()
    digests = _stream(rows, script).mapInArrow(_digested, f"conv {conv}, audit string, repaired_sha256 string")
    every = conversations.select("conv").distinct()
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    both = every.unionByName(found, allowMissingColumns=True).unionByName(digests, allowMissingColumns=True)
    out = both.groupBy("conv").agg(*[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in numbers], F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
                                   F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
    return out


# --- damage -------------------------------------------------------------------------------------------------


def damaged(conversations: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows with the damage of the registered query, `copies` of each: by crc32 of `conversation:turn` modulo 20, 0 drops a row,
    1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it the user's."""
    q = lambda c: F.col("`" + c.replace("`", "``") + "`")
    filled = lambda c: F.coalesce(q(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(filled(conversation), F.lit(":"), filled(turn))) % 20
    marked = conversations.select(q(conversation).alias("conv"), q(turn).cast("long").alias("turn"), filled(role).alias("role"), filled(text).alias("text"), kind.alias("kind"))
    return marked.filter("kind != 0").select(
        "conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).alias("copies"))


# crc32 bit by bit: the codes of the key's characters, then eight shifts for each.
_CRC = """xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT,
  list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda ch: ascii(ch)::UBIGINT)),
  lambda h, x: list_reduce(list_prepend(xor(h, x), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
    lambda g, z: CASE WHEN g % 2 = 1 THEN xor(g // 2, 3988292384::UBIGINT) ELSE g // 2 END)))"""
#: The shortest path forwards, row by row: per state the least (cost, letters), with the repaired text so far.
SQL = f"""
WITH RECURSIVE moves(s, x, z) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
ways AS (SELECT s, 'K' AS letter, x, z FROM moves UNION ALL SELECT s, 'R', x, z FROM moves WHERE x != 's' UNION ALL SELECT s, 'D', '', s FROM range(4) t(s)),
inserts(s, z, n, turns) AS (SELECT s, s, 0, '' FROM range(4) t(s) UNION ALL VALUES (0, 2, 1, chr(10) || 'user:'), (1, 2, 1, chr(10) || 'user:'), (3, 2, 1, chr(10) || 'user:'),
  (2, 3, 1, chr(10) || 'assistant:'), (0, 3, 2, chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 3, 2, chr(10) || 'user:' || chr(10) || 'assistant:'),
  (2, 2, 2, chr(10) || 'assistant:' || chr(10) || 'user:')),
g AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC} % 20 AS kind FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
  CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM g WHERE kind != 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen, regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS body FROM d),
f AS MATERIALIZED (SELECT *, CASE WHEN body = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
  left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair FROM o),
c AS MATERIALIZED (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank,
  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal,
  count(*) AS n FROM f GROUP BY conv_id),
r AS (SELECT conv_id, 0::BIGINT AS i, 0 AS s, {{'c': 0::BIGINT, 'e': '', 't': ''}} AS best FROM c
  UNION ALL
  SELECT r.conv_id, f.i, w.z, min({{
    'c': (best.c + {INSERT} * j.n + CASE letter WHEN 'D' THEN {DELETE} WHEN 'R' THEN {REROLE} ELSE 0 END + CASE WHEN letter != 'D' AND fault = 'truncated' THEN {TRUNCATED} ELSE 0 END)::BIGINT,
    'e': best.e || repeat('I', j.n) || letter,
    't': best.t || j.turns || CASE letter WHEN 'D' THEN '' ELSE chr(10) || CASE WHEN letter = 'K' THEN role WHEN x = 'u' THEN 'user' ELSE 'assistant' END || ':' || text END}})
  FROM r JOIN f ON r.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = r.i + 1 JOIN inserts j ON r.s = j.s
  JOIN ways w ON w.s = j.z AND (letter = 'D' OR (fault IN ('truncated', 'none') AND (letter = 'R' OR left(role, 1) = x)))
  GROUP BY r.conv_id, f.i, w.z),
e AS (SELECT r.conv_id, min({{'c': (best.c + {INSERT} * j.n)::BIGINT, 'e': best.e || repeat('I', j.n), 't': best.t || j.turns}}) AS best
  FROM r JOIN c ON r.conv_id IS NOT DISTINCT FROM c.conv_id AND r.i = c.n JOIN inserts j ON r.s = j.s WHERE j.z IN (0, 3) GROUP BY r.conv_id)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.e, '') AS audit, sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN c ON a.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN e ON a.conv_id IS NOT DISTINCT FROM e.conv_id
"""
