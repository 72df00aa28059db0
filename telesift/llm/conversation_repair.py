"""Repair of conversations' structure: the cheapest edits after which the roles read system? (user assistant)*.

Rows are ordered over the whole table by conversation, turn (nulls first), role and text, and cut into parts of at most PART_ROWS
rows and, but for a single longer text, PART_BYTES. A conversation that lies within one part is repaired where it lies. One of
several parts, or at the edge of a partition, goes through four steps, each spread over its parts: which texts earlier parts hold;
the lightest ways through each part from each state to each (derivation.through); ways through FAN parts, of these FAN and so on,
until one is left (derivation.joined); and back down from the chosen way to each part's edits. So no conversation of any length
meets in one task; what meets are 16 numbers a part. Only the digest of a conversation's text is one stream, in order.

Faults: a row is blank, else a duplicate (its role and text were there earlier), else truncated (its last visible character is none
of . ! ?). Blank and duplicate rows must be deleted.

Edits: keep K 0, rerole to user or assistant R 1, delete D 2, insert an empty row of user or assistant I 5; a truncated row that
stays adds 5. Of equally cheap ones the audit that is least in ASCII order is taken. System rows come from kept ones only.

Defined results
    A null role or text is one blank. A null conversation id is a conversation of its own. Rows of one turn come by role, then by
    the text's first 256 characters, then by its hash. Repeated rows are duplicates. Roles are told apart by their first
    character; rows of another than s, u or a can't be kept as they are. Without rows all counts are 0 and the audit is empty.
    Texts may be of any length. An empty table gives no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telesift.llm import derivation as dv
from telesift.llm.arrow import batch_of, record
from telesift.session import scratch_path

PART_ROWS = 256
PART_BYTES = 64 << 10
#: Parts that are joined at once, as a number of bits.
FAN_BITS = 6

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_SPACE = " \t\n\x0b\x0c\r"
_LEGAL = {"su", "ua", "au"}
_NAMES = {dv.SYSTEM: "system", dv.USER: "user", dv.ASSISTANT: "assistant"}

_CUT = record(
    c="string", pid="int", seq="int", whole="bool", turns="[long]", roles="[string]", texts="[string]", gaps="long", blank="long",
    duplicate="long", truncated="long", illegal="long", cost="long", audit="string", sha256="string", new_roles="[string]", new_texts="[string]",
)
_HELD = record(c="string", part="long", digest="binary", at="int")
_NODE = record(
    c="string", part="long", n="long", blank="long", duplicate="long", truncated="long", illegal="long", first="string", last="string",
    turns="long", first_turn="long", last_turn="long", least_turn="long", costs="[long]", ranks="[int]", children="[long]", between="[int]",
)
_TOP = record(c="string", part="long", p="int", q="int", gaps="long", blank="long", duplicate="long", truncated="long", illegal="long", cost="long", closing="string")
_PIECE = record(c="string", part="long", audit="string", new_roles="[string]", new_texts="[string]")
_DIGEST = record(c="string", audit="string", sha256="string")


@dataclass
class _Part:
    """Rows of a conversation that follow each other."""

    c: str
    seq: int = 0
    turns: list = field(default_factory=list)
    roles: list = field(default_factory=list)
    texts: list = field(default_factory=list)
    size: int = 0

    def faults(self, repeated: set[int] = frozenset()) -> list[str]:
        """blank, duplicate, truncated or nothing, for each row; `repeated` are rows that earlier parts hold."""
        seen, out = set(), []
        for i, (role, text) in enumerate(zip(self.roles, self.texts)):
            shown = text.rstrip(_SPACE)
            pair = (role, text)
            if not shown:
                out.append("blank")
            elif pair in seen or i in repeated:
                out.append("duplicate")
            else:
                out.append("" if shown[-1] in ".!?" else "truncated")
            seen.add(pair)
        return out

    def rows(self, faults: list[str]) -> list[dv.Row]:
        return [dv.Row(role[:1], f in ("blank", "duplicate"), f == "truncated") for role, f in zip(self.roles, faults)]

    def illegal(self) -> int:
        first = [role[:1] for role in self.roles]
        return sum(a + b not in _LEGAL for a, b in zip(first, first[1:]))

    def edited(self, audit: str, state: int) -> tuple[list[str], list[str]]:
        """Roles and texts after the edits, from the state before the part."""
        roles, texts, i = [], [], 0
        for edit in audit:
            if edit == "K":
                state = dv.AFTER[self.roles[i][:1]][state]
                roles.append(self.roles[i])
            elif edit in "RI":
                state = dv.NEXT[state]
                roles.append(_NAMES[state])
            if edit in "KR":
                texts.append(self.texts[i])
            elif edit == "I":
                texts.append("")
            i += edit != "I"
        return roles, texts


def _gaps(turns: list) -> int:
    there = {t for t in turns if t is not None}
    return max(there) - min(there) + 1 - len(there) if there else 0


def _repaired(part: _Part) -> list:
    """Result columns of a conversation that is one part."""
    faults = part.faults()
    cost, audit = dv.repair(part.rows(faults))
    roles, texts = part.edited(audit, dv.BEGIN)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in zip(roles, texts)).encode())
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return [_gaps(part.turns), *counts, part.illegal(), cost, audit, digest.hexdigest(), roles, texts]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of each conversation; those that can't go on in another partition, and are one part, come repaired."""
    pid = TaskContext.get().partitionId()
    out: list[list] = []
    size = 0

    def put(part: _Part, whole: bool):
        nonlocal size
        lists = [None] * 3 if whole else [part.turns, part.roles, part.texts]
        out.append([part.c, pid, part.seq, whole, *lists, *(_repaired(part) if whole else [None] * 10)])
        size += part.size

    def batch():
        nonlocal size
        made = batch_of(_CUT, [list(c) for c in zip(*out)])
        out.clear()
        size = 0
        return made

    part, first = None, True
    for rows in batches:
        for c, turn, role, text, gone in zip(*(rows.column(k).to_pylist() for k in ("c", "turn", "role", "text", "gone"))):
            if part is None or part.c != c:
                if part is not None:
                    put(part, part.seq == 0 and not first)
                    first = False
                part = _Part(c)
            if gone:
                continue
            more = len(text) * 4 + len(role) * 4
            if part.turns and (len(part.turns) >= PART_ROWS or part.size + more > PART_BYTES):
                put(part, False)
                part = _Part(c, part.seq + 1)
            part.turns.append(turn)
            part.roles.append(role)
            part.texts.append(text)
            part.size += more
            if size > 8 << 20:
                yield batch()
    if part is not None:
        put(part, False)
    if out:
        yield batch()


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[dict, _Part]]:
    for row in batch.to_pylist():
        yield row, _Part(row["c"], 0, row["turns"], row["roles"], row["texts"])


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of every role and text of a part, with the first row that holds it."""
    for batch in batches:
        out = []
        for row, part in _parts(batch):
            first: dict[bytes, int] = {}
            for i, (role, text) in enumerate(zip(part.roles, part.texts)):
                first.setdefault(hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest(), i)
            out.extend((row["c"], row["part"], digest, i) for digest, i in first.items())
        if out:
            yield batch_of(_HELD, [list(c) for c in zip(*out)])


def _flat(ways: list[dict]) -> tuple[list, list]:
    """Costs and ranks from each state to each; -1 where there is no way."""
    pairs = [ways[p].get(q, (-1, -1)) for p in range(dv.STATES) for q in range(dv.STATES)]
    return [c for c, _ in pairs], [r for _, r in pairs]


def _ways(costs: list[int], ranks: list[int]) -> list[dict]:
    return [{q: (costs[p * dv.STATES + q], ranks[p * dv.STATES + q]) for q in range(dv.STATES) if costs[p * dv.STATES + q] >= 0} for p in range(dv.STATES)]


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each part, and the lightest ways through it."""
    for batch in batches:
        out = []
        for row, part in _parts(batch):
            faults = part.faults(set(row["repeated"] or ()))
            rows = part.rows(faults)
            there = [t for t in part.turns if t is not None]
            costs, ranks = _flat([dv.ranked(dv.through(rows, p)) for p in range(dv.STATES)])
            out.append([
                row["c"], row["part"], len(rows), *(faults.count(f) for f in ("blank", "duplicate", "truncated")), part.illegal(),
                part.roles[0][:1] if rows else None, part.roles[-1][:1] if rows else None, len(set(there)),
                part.turns[0] if rows else None, part.turns[-1] if rows else None, min(there, default=None), costs, ranks, [], [],
            ])
        if out:
            yield batch_of(_NODE, [list(c) for c in zip(*out)])


def _joined(table: pa.Table) -> pa.Table:
    """Up to 2^FAN_BITS parts that follow each other as one."""
    parts = sorted(table.to_pylist(), key=lambda r: r["part"])
    total = {k: sum(r[k] for r in parts) for k in ("n", "blank", "duplicate", "truncated", "illegal", "turns")}
    filled = [r for r in parts if r["n"]]
    for a, b in zip(filled, filled[1:]):
        total["illegal"] += a["last"] + b["first"] not in _LEGAL
        total["turns"] -= a["last_turn"] is not None and a["last_turn"] == b["first_turn"]
    ways = [dv.joined([_ways(r["costs"], r["ranks"]) for r in parts], p) for p in range(dv.STATES)]
    costs, ranks = _flat([dv.ranked(w) for w in ways])
    # The states before, between and after the parts, for each pair of a first and a last state.
    between = [s for p in range(dv.STATES) for q in range(dv.STATES) for s in (ways[p][q][2] if q in ways[p] else [-1] * (len(parts) + 1))]
    ends = filled[:1] + filled[-1:] or [{"first": None, "last": None, "first_turn": None, "last_turn": None}] * 2
    row = [
        parts[0]["c"], parts[0]["part"] >> FAN_BITS, *(total[k] for k in ("n", "blank", "duplicate", "truncated", "illegal")),
        ends[0]["first"], ends[-1]["last"], total["turns"], ends[0]["first_turn"], ends[-1]["last_turn"],
        min((r["least_turn"] for r in parts if r["least_turn"] is not None), default=None), costs, ranks, [r["part"] for r in parts], between,
    ]
    return pa.Table.from_batches([batch_of(_NODE, [[v] for v in row])])


def _top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The way chosen through each whole conversation."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            q, cost, closing = dv.closed(_ways(r["costs"], r["ranks"])[dv.BEGIN])
            # Turns are in order, so the last row's is the largest, and null only if all are.
            gaps = r["last_turn"] - r["least_turn"] + 1 - r["turns"] if r["turns"] else 0
            out.append([r["c"], r["part"], dv.BEGIN, q, gaps, r["blank"], r["duplicate"], r["truncated"], r["illegal"], cost, closing])
        if out:
            yield batch_of(_TOP, [list(c) for c in zip(*out)])


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each part's edits along the chosen way, and its rows after them."""
    for batch in batches:
        out = []
        for row, part in _parts(batch):
            audit = dv.through(part.rows(part.faults(set(row["repeated"] or ()))), row["p"])[row["q"]][1]
            out.append([row["c"], row["part"], audit, *part.edited(audit, row["p"])])
        if out:
            yield batch_of(_PIECE, [list(c) for c in zip(*out)])


def _closing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [r for r in batch.to_pylist() if r["closing"]]
        pieces = [[r["c"], (1 << 62), r["closing"], *_Part(r["c"]).edited(r["closing"], r["q"])] for r in rows]
        if pieces:
            yield batch_of(_PIECE, [list(c) for c in zip(*pieces)])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest and audit per conversation, from its pieces in order."""
    c, text, audit, begun = None, None, [], False
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["c"] != c:
                if c is not None:
                    out.append([c, "".join(audit), text.hexdigest()])
                c, text, audit, begun = row["c"], hashlib.sha256(), [], False
            audit.append(row["audit"])
            for r, t in zip(row["new_roles"], row["new_texts"]):
                text.update((("\n" if begun else "") + f"{r}:{t}").encode())
                begun = True
        if out:
            yield batch_of(_DIGEST, [list(x) for x in zip(*out)])
    if c is not None:
        yield batch_of(_DIGEST, [[c], ["".join(audit)], [text.hexdigest()]])


@dataclass(frozen=True)
class Repair:
    """`conversations`: (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, sha256 of the repaired rows as role:text lines).

    `turns`: (conv_id, part, place, role, text), the repaired rows; parts ascend, places count from 0 within one.
    """

    conversations: DataFrame
    turns: DataFrame


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", gone: Column | None = None) -> Repair:
    """Repair every conversation. Rows for which `gone` holds only say that their conversation exists."""
    spark = rows.sparkSession
    kind = rows.schema[conv].dataType
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)
    plain = rows.select(
        F.when(F.col(conv).isNull(), "").otherwise(F.concat(F.lit("="), F.col(conv).cast("string"))).alias("c"),
        F.col(turn).cast("long").alias("turn"), blank(role).alias("role"), blank(text).alias("text"),
        F.coalesce(F.lit(False) if gone is None else gone, F.lit(False)).alias("gone"),
    )
    # The last key spreads rows that agree in all others over partitions.
    order = ["c", "turn", "role", "head", "hash", "row"]
    keyed = plain.select("*", F.substring("text", 1, 256).alias("head"), F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"))
    cut_path = scratch_path(spark, "parts")
    keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_cut, _CUT).write.parquet(cut_path)
    cut = spark.read.schema(_CUT).parquet(cut_path)
    whole, rest = cut.filter("whole"), cut.filter("NOT whole")
    bits = rest.agg(F.max("pid"), F.max("seq")).first()
    pid_bits, seq_bits = (int(b or 0).bit_length() for b in bits)
    rest = rest.select("c", (F.shiftleft(F.col("pid").cast("long"), seq_bits) + F.col("seq")).alias("part"), "turns", "roles", "texts")

    held = rest.mapInArrow(_held, _HELD)
    earliest = held.groupBy("c", "digest").agg(F.min("part").alias("first"))
    repeated = held.join(earliest, ["c", "digest"]).filter("part > first").groupBy("c", "part").agg(F.collect_list("at").alias("repeated"))
    judged_path = scratch_path(spark, "judged-parts")
    rest.join(repeated, ["c", "part"], "left").write.parquet(judged_path)
    judged = spark.read.parquet(judged_path)

    levels = [judged.mapInArrow(_summaries, _NODE)]
    for _ in range(max(1, -(-(pid_bits + seq_bits) // FAN_BITS))):
        path = scratch_path(spark, "ways")
        levels[-1].groupBy("c", F.shiftright("part", FAN_BITS).alias("above")).applyInArrow(_joined, _NODE).write.parquet(path)
        levels.append(spark.read.schema(_NODE).parquet(path))
    top = levels[-1].mapInArrow(_top, _TOP)
    chosen = top.select("c", "part", "p", "q")
    for level in reversed(levels[1:]):
        # (first state) * STATES + (last state) says which run of states is the chosen one; a run has one more than the children.
        wide = level.select("c", "part", "children", "between").join(chosen, ["c", "part"])
        run = F.slice("between", (F.col("p") * dv.STATES + F.col("q")) * (F.size("children") + 1) + 1, F.size("children") + 1)
        wide = wide.select("c", "children", run.alias("run")).select("c", "run", F.posexplode("children").alias("i", "part"))
        chosen = wide.select("c", "part", F.element_at("run", F.col("i") + 1).alias("p"), F.element_at("run", F.col("i") + 2).alias("q"))
    pieces_path = scratch_path(spark, "pieces")
    pieces = judged.join(chosen, ["c", "part"]).mapInArrow(_edited, _PIECE).unionByName(top.mapInArrow(_closing, _PIECE))
    pieces.write.parquet(pieces_path)
    pieces = spark.read.schema(_PIECE).parquet(pieces_path)
    digests = pieces.repartition("c").sortWithinPartitions("c", "part").mapInArrow(_digests, _DIGEST)

    named = F.when(F.col("c") != "", F.expr("substring(c, 2)")).cast(kind).alias(conv)
    counted = top.join(digests, "c").select("c", *COUNTS, "audit", "sha256").unionByName(whole.select("c", *COUNTS, "audit", "sha256"))
    parts = pieces.select("c", "part", "new_roles", "new_texts").unionByName(whole.select("c", F.lit(0).cast("long").alias("part"), "new_roles", "new_texts"))
    turns = parts.select("c", "part", F.posexplode(F.arrays_zip("new_roles", "new_texts")).alias("at", "new"))
    return Repair(
        counted.select(named, *COUNTS, "audit", "sha256"),
        turns.select(named, "part", F.col("at").alias("place"), F.col("new.new_roles").alias(role), F.col("new.new_texts").alias(text)),
    )


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults put in by crc32("conv:turn") mod 20, for tests of repair: 0 drops a row (it comes marked `gone`), 1 empties
    its text, 2 takes its . ! ? out, 3 repeats it, 4 makes it the user's. Nulls are one blank each, but for the turn's order."""
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(blank(conv), F.lit(":"), blank(turn))) % 20
    plain = rows.select(F.col(conv), F.col(turn), blank(role).alias(role), blank(text).alias(text), fault.alias("__fault"))
    return plain.select(
        conv, turn, F.when(F.col("__fault") == 4, "user").otherwise(F.col(role)).alias(role),
        F.when(F.col("__fault") == 1, "").when(F.col("__fault") == 2, F.translate(text, ".!?", "")).otherwise(F.col(text)).alias(text),
        (F.col("__fault") == 0).alias("gone"),
        F.explode(F.when(F.col("__fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("__copy"),
    ).drop("__copy")
