"""Conversation structure repair: weighted interval parsing of turns with the cheapest edits.

A conversation is repaired when the initials of its roles read ``(s?(ua)+)?``. Edits are Keep, Rerole,
Delete and Insert; the audit is the initials of the edits in order. Of all repairs the cheapest is
taken, then the one whose audit is least as text.

The grammar is in Chomsky normal form. Its nonterminals (p, q) stand for turns that lead from state p
to state q of the wanted pattern: (p, r) -> (p, q) (q, r), and (p, q) -> turn. A cell holds the
minimum (cost, audit) of each nonterminal over a span of turns, closed under insertions at its ends.
Where a span is split, the state is q for some q whatever the place, so that one split of a
span gives the minimum of all. Spans are therefore combined bottom-up by length, 1, 2, 4 and so on,
in blocks of turns first and then across blocks, and a conversation of any length is spread over tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import groupby
from operator import itemgetter
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sievemark.llm.common import BATCH, apart, small_batches
from sievemark.session import materialize

# Costs, states (0 at the start, 1 after system, 2 after user, 3 after assistant) and steps
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
STATES, ENDS = 4, (0, 3)
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
LEGAL = ("su", "ua", "au")
ROLES = {2: "user", 3: "assistant"}

#: Consecutive turns that are parsed together; a conversation may lie in several such blocks.
BLOCK_TURNS = 4096
_MEMO = 8  # spans of at most so many turns are remembered

Cell = tuple[tuple[int, str] | None, ...]


def _closed() -> Cell:
    """The cell of a span without turns: what insertions alone can do."""
    cell: list = [None] * STATES**2
    for p in range(STATES):
        cell[p * STATES + p] = (0, "")
        q, cost, audit = p, 0, ""
        for _ in range(2):
            q, cost, audit = next(n for (o, x), n in STEPS.items() if o == q and x in "ua"), cost + INSERT, audit + "I"
            if cell[p * STATES + q] is None:
                cell[p * STATES + q] = (cost, audit)
    return tuple(cell)


def joined(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans. Audits of one span and cost are never prefixes of each
    other, since each further edit costs; so the least parts make the least whole."""
    out = []
    for p in range(STATES):
        row = left[p * STATES : p * STATES + STATES]
        for r in range(STATES):
            best = None
            for q in range(STATES):
                a, b = row[q], right[q * STATES + r]
                if a is None or b is None:
                    continue
                cost = a[0] + b[0]
                if best is None or cost <= best[0]:
                    both = (cost, a[1] + b[1])
                    if best is None or both < best:
                        best = both
            out.append(best)
    return tuple(out)


NO_TURNS = _closed()


@lru_cache(maxsize=1 << 16)
def _short(codes: str) -> Cell:
    if len(codes) > 1:
        half = 1 << (len(codes) - 1).bit_length() - 1
        return joined(_short(codes[:half]), _short(codes[half:]))
    cell: list = [None] * STATES**2
    for p in range(STATES):
        cell[p * STATES + p] = (DELETE, "D")
    if codes != "x":
        late = TRUNCATED if codes.isupper() else 0
        for (p, initial), q in STEPS.items():
            if initial == codes.lower():
                cell[p * STATES + q] = (late, "K")
            elif initial in "ua":
                cell[p * STATES + q] = (late + REROLE, "R")
    return joined(joined(NO_TURNS, tuple(cell)), NO_TURNS)


def together(cells: Sequence[Cell]) -> Cell:
    """The cell of consecutive spans, combined bottom-up by length."""
    cells = list(cells)
    while len(cells) > 1:
        cells = [joined(*cells[i : i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0] if cells else NO_TURNS


def parse(codes: str) -> Cell:
    """The cell of turns given by a letter each: s, u, a, o (another role), as a capital if
    truncated; x must go."""
    return together([_short(codes[i : i + _MEMO]) for i in range(0, len(codes), _MEMO)])


def best_repair(cell: Cell) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair."""
    return min(c for c in (cell[q] for q in ENDS) if c is not None)


def roles_after(codes: str, audit: str, state: int) -> Iterator[tuple[str, str | None, int]]:
    """(edit, role it gives or None, state after it) of each edit."""
    at = 0
    for edit in audit:
        if edit == "I":
            initial = "a" if state == 2 else "u"
        else:
            initial = codes[at].lower()
            at += 1
        if edit == "D":
            yield edit, None, state
            continue
        if edit == "R":
            initial = "a" if state == 2 else "u"
        state = STEPS[state, initial]
        yield edit, None if edit == "K" else ROLES[state], state


class Repair(NamedTuple):
    """Rows per conversation, and the turns of the repaired conversations."""

    conversations: DataFrame
    turns: DataFrame


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for whole in batches:
        for start in range(0, whole.num_rows, BATCH):
            yield from whole.slice(start, BATCH).to_pylist()


def _streamed(df: DataFrame, fields: T.StructType, function) -> DataFrame:
    """Apply a generator of dicts to the rows of each partition in their order, in bounded batches."""
    schema = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for row in function(_rows(batches)):
            held.append(row)
            if len(held) == BATCH:
                yield pa.RecordBatch.from_pylist(held, schema)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    return small_batches(df).mapInArrow(run, fields)


def ordered_turns(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, pos, block): all turns in one order, by conversation and turn.

    Null turns come first; turns of one number follow role and text. Null roles and texts are one space.
    Blocks are runs of ``BLOCK_TURNS`` positions. The table is written, since positions depend
    on where the sort has cut it.
    """
    blank = F.lit(" ")
    turns = df.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(role, blank).alias("role"), F.coalesce(text, blank).alias("text"),
    ).withColumn("__tie", F.monotonically_increasing_id())
    keys = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "text", "__tie")]
    placed = turns.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("pos", F.monotonically_increasing_id())
    block = F.shiftright("pos", BLOCK_TURNS.bit_length() - 1)
    return materialize(placed.select("conv", "turn", "role", "text", "pos", block.alias("block")), "turns")


def _filled(text: str) -> Column:
    return F.col(text).rlike(r"[^\x20\x09-\x0D]")


def repeated_turns(turns: DataFrame) -> DataFrame:
    """(pos, block): turns with words whose role and text stand earlier in the conversation."""
    parts = [F.col("conv").isNull(), F.coalesce(F.col("conv").cast("string"), F.lit("")), F.col("role"), F.col("text")]
    keyed = turns.filter(_filled("text")).select("pos", "block", *[F.xxhash64(F.lit(i), *parts).alias(f"h{i}") for i in (1, 2)])
    keyed = materialize(keyed, "turn-keys")
    first = keyed.groupBy("h1", "h2").agg(F.min("pos").alias("__first"), F.count("*").alias("__n")).filter("__n > 1")
    return keyed.join(apart(first.drop("__n"), "turn-firsts"), ["h1", "h2"]).filter("pos > __first").select("pos", "block")


_CELL = "costs array<long>, audits array<string>"
_SEGMENT = (
    "block long, first long, n long, codes string, blank long, duplicate long, truncated long, illegal long, "
    "first_role string, last_role string, first_turn long, last_turn long, n_turns long, " + _CELL
)


def _segments(rows: Iterator[dict]) -> Iterator[dict]:
    """One row per block and conversation: its counts and its cell."""
    for (block, conv), own in groupby(rows, key=itemgetter("block", "conv")):
        codes, seen, counts, illegal, first, last, distinct = [], False, [0, 0, 0], 0, None, None, 0
        low = high = None
        for r in own:
            if r["repeated"] is True:  # stands before the turn it marks
                seen = True
                continue
            fault = 0 if r["blank"] else 1 if seen else 2 if r["late"] else 3
            seen = False
            if fault < 3:
                counts[fault] += 1
            known = r["initial"] if r["initial"] in ("s", "u", "a") else "o"
            codes.append("x" if fault < 2 else known.upper() if fault == 2 else known)
            if first is None:
                first, start = r["initial"], r["pos"]
            elif last + r["initial"] not in LEGAL:
                illegal += 1
            last = r["initial"]
            if r["turn"] is not None and (high is None or r["turn"] != high):
                distinct += 1
                low, high = r["turn"] if low is None else low, r["turn"]
        cell = parse("".join(codes))
        yield {
            "conv": conv, "block": block, "first": start, "n": len(codes), "codes": "".join(codes), "blank": counts[0],
            "duplicate": counts[1], "truncated": counts[2], "illegal": illegal, "first_role": first, "last_role": last,
            "first_turn": low, "last_turn": high, "n_turns": distinct,
            "costs": [None if c is None else c[0] for c in cell], "audits": [None if c is None else c[1] for c in cell],
        }


_PART = "struct<block: long, first: long, state: int, codes: string, audit: string>"
_TOTAL = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    f"parts array<{_PART}>"
)


def _combine(rows: Iterator[dict]) -> Iterator[dict]:
    """One row per conversation from its segments in order."""
    for r in rows:
        parts = r["segments"]
        out = {"conv": r["conv"]} | {k: sum(s[k] for s in parts) for k in ("blank", "duplicate", "truncated", "illegal")}
        out["illegal"] += sum(a["last_role"] + b["first_role"] not in LEGAL for a, b in zip(parts, parts[1:]))
        numbered = [s for s in parts if s["n_turns"]]
        distinct = sum(s["n_turns"] for s in numbered) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(numbered, numbered[1:]))
        out["gaps"] = numbered[-1]["last_turn"] - numbered[0]["first_turn"] + 1 - distinct if numbered else 0
        cells = [tuple(None if c is None else (c, a) for c, a in zip(s["costs"], s["audits"])) for s in parts]
        out["cost"], out["audit"] = best_repair(together(cells))
        at, state, out["parts"] = 0, 0, []
        for i, s in enumerate(parts):
            end, left = at, s["n"]
            while left:
                left -= out["audit"][end] != "I"
                end += 1
            end = len(out["audit"]) if i + 1 == len(parts) else end
            out["parts"].append({"block": s["block"], "first": s["first"], "state": state, "codes": s["codes"], "audit": out["audit"][at:end]})
            for _, _, state in roles_after(s["codes"], out["audit"][at:end], state):
                pass
            at = end
        yield out


def _apply(rows: Iterator[dict]) -> Iterator[dict]:
    """The repaired turns of each segment, in order."""
    for (_, conv), own in groupby(rows, key=itemgetter("block", "conv")):
        part = next(own)
        for step, (edit, role, _) in enumerate(roles_after(part["codes"], part["audit"], part["state"])):
            row = None if edit == "I" else next(own)
            if edit != "D":
                yield {
                    "conv": conv, "block": part["block"], "step": step, "edit": edit, "whole": part["whole"],
                    "role": role or row["role"], "text": row["text"] if row else "",
                }


def repair_conversations(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """The cheapest repair of every conversation.

    ``conversations``: the conversation's id, gaps, blank, duplicate, truncated, illegal, cost, audit. ``turns``: the repaired turns in
    order (conv, block, step, edit, whole, role, text); ``whole`` tells that the conversation lies in one block.

    The first fault of a turn counts: blank (no character but white space), duplicate (its role and
    text stand earlier in the conversation), truncated (does not end in ``.``, ``!`` or ``?``).
    Blank and duplicate turns are deleted. Null roles and texts are taken as one space, so they are blank or of another role;
    null ids make one conversation; null turn numbers come first and count for no gap. Repeated
    rows are duplicates. Extra columns are ignored; an empty table gives no rows.

    Turns are sorted once over the whole table and parsed in blocks of ``BLOCK_TURNS``, so a conversation with very
    many turns is spread over tasks. What comes together in one task is a row per block
    of it, and its audit, which is one value of the result.
    """
    turns = ordered_turns(df, conv, turn, role, text)
    kind = turns.schema["conv"].dataType
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    no = F.lit(False)
    facts = turns.select(
        "block", "pos", "conv", "turn", F.substring("role", 1, 1).alias("initial"),
        (~_filled("text")).alias("blank"), (~last.isin(".", "!", "?")).alias("late"), no.alias("repeated"),
    )
    # a mark stands before its turn, takes the conversation from it and is not a turn itself
    marks = repeated_turns(turns).withColumnRenamed("pos", "__pos").withColumnRenamed("block", "__block")
    marked = facts.join(marks, (F.col("pos") == F.col("__pos")) & (F.col("block") == F.col("__block"))).select(
        "block", "pos", "conv", "turn", "initial", "blank", "late", F.lit(True).alias("repeated")
    )
    dealt = facts.unionAll(marked).repartition("block").sortWithinPartitions("block", "pos", F.desc("repeated"))
    fields = T.StructType([T.StructField("conv", kind), *T.StructType.fromDDL(_SEGMENT)])
    segments = materialize(_streamed(dealt, fields, _segments), "turn-segments")
    row = F.struct(*[c for c in segments.columns if c != "conv"])
    gathered = segments.groupBy("conv").agg(F.array_sort(F.collect_list(row)).alias("segments"))
    fields = T.StructType([T.StructField("conv", kind), *T.StructType.fromDDL(_TOTAL)])
    found = materialize(_streamed(gathered, fields, _combine), "turn-repairs")

    parts = found.select("conv", (F.size("parts") == 1).alias("whole"), F.explode("parts").alias("p")).select(
        F.col("p.block").alias("block"), F.col("p.first").alias("pos"), "conv", F.lit(0).alias("kind"), F.lit("").alias("role"),
        F.lit("").alias("text"), F.col("p.state").alias("state"), F.col("p.codes").alias("codes"), F.col("p.audit").alias("audit"), "whole",
    )
    rest = turns.select(
        "block", "pos", "conv", F.lit(1).alias("kind"), "role", "text", F.lit(0).alias("state"), F.lit("").alias("codes"),
        F.lit("").alias("audit"), no.alias("whole"),
    )
    fields = T.StructType([T.StructField("conv", kind), *T.StructType.fromDDL("block long, step long, edit string, whole boolean, role string, text string")])
    dealt = parts.unionAll(rest).repartition("block").sortWithinPartitions("block", "pos", "kind")
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    return Repair(found.select(F.col("conv").alias(conv), *names), _streamed(dealt, fields, _apply))


def _line(r: dict) -> bytes:
    return f"{r['role']}:{r['text']}".encode()


def _digests(rows: Iterator[dict]) -> Iterator[dict]:
    """SHA-256 of each whole conversation; the lines of one that goes on in other blocks."""
    for (_, conv), own in groupby(rows, key=itemgetter("block", "conv")):
        sha, first = hashlib.sha256(), True
        for r in own:
            if not r["whole"]:
                yield {"conv": conv, "block": r["block"], "step": r["step"], "line": _line(r), "sha256": None}
                continue
            sha.update(_line(r) if first else b"\n" + _line(r))
            first = False
        if not first:
            yield {"conv": conv, "block": None, "step": None, "line": None, "sha256": sha.hexdigest()}


def _sewn(rows: Iterator[dict]) -> Iterator[dict]:
    for conv, own in groupby(rows, key=itemgetter("conv")):
        sha = hashlib.sha256()
        for i, r in enumerate(own):
            sha.update(b"\n" * (i > 0) + r["line"])
        yield {"conv": conv, "sha256": sha.hexdigest()}


def repaired_digests(turns: DataFrame) -> DataFrame:
    """(conv, sha256) of the repaired ``role:text`` lines; conversations without such lines have no row.

    ``turns`` come from ``repair_conversations``, whose order within a block is used. A digest runs over its lines one
    after the other, so a conversation of several blocks passes through one task, line by line.
    """
    kind = turns.schema["conv"].dataType
    fields = T.StructType([T.StructField("conv", kind), *T.StructType.fromDDL("block long, step long, line binary, sha256 string")])
    first = materialize(_streamed(turns, fields, _digests), "turn-digests")
    rest = first.filter("sha256 IS NULL").repartition("conv").sortWithinPartitions("conv", "block", "step")
    fields = T.StructType([T.StructField("conv", kind), T.StructField("sha256", T.StringType())])
    return first.filter("sha256 IS NOT NULL").select("conv", "sha256").unionAll(_streamed(rest.select("conv", "line"), fields, _sewn))


def damaged(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults planted by ``crc32(conv_id:turn) % 20``: 0 drops the
    turn, 1 empties it, 2 takes out its sentence ends, 3 repeats it, 4 makes it a user's. Nulls are one space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fault = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return (
        df.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("__fault"))
        .filter("__fault <> 0")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.when(F.col("__fault") == 3, 2).otherwise(1))))
        .select(
            "conv_id", "turn", F.when(F.col("__fault") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("__fault") == 1, "").when(F.col("__fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        )
    )
