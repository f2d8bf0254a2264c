"""Conversation structure repair (operator 13): the cheapest edits to `(s?(ua)+)?`.

Every row of a conversation is kept (0), given the role that must come next (1) or
deleted (2, the only way out for a blank or duplicate row); an empty message may be
inserted anywhere (5); a truncated row that stays costs 5 more. Among the cheapest
ways the one whose letters (D, I, K, R) are least in ASCII order is taken.

*Weights.* The least way from each state of the role automaton to the end is one
big integer: the high digits are its cost, the low ones a fixed number of base-256
digits holding its letters from the left, with zeros behind the last letter. A
smaller integer is a cheaper way, or an equally dear one with lesser letters, so the
plain integer minimum over a row's edits decides everything, from the last row to the first.

*Distribution.* Rows are range-partitioned by conversation and turn, so one
conversation may fill many partitions. A conversation that lies inside a partition
and has at most SEGMENT_ROWS rows is solved there. Any other is cut into segments:
  - a segment's first rows of each (role, text) are reduced by key to the first of the
    conversation, which gives every segment its duplicates;
  - each segment is solved once per pair of automaton states (letters of equally dear ways
    through the same rows are never prefixes of one another, so ways may be joined);
  - the ways of a conversation's segments are joined in order (a row a segment; the letters
    themselves, a byte a row, are one cell of the result);
  - the segments write their repaired texts, and the digest runs over these in order as
    a stream, one segment at a time.

Defined results: a null role or text counts as one space, a null conv_id is a
conversation of its own; null turns come first and rows of one turn go by role, then text
(beyond 64 equal characters by a hash of the text); a role other than system, user
and assistant counts by its first letter; whole repeated rows are rows; extra columns are ignored;
an empty table gives no rows. gaps beyond 2**63 - 1 are given as that. A task holds a few segments
of at most SEGMENT_ROWS rows and about SEGMENT_BYTES (or one longer text).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplecast.llm.tables import materialise, read, shuffle_width

SEGMENT_ROWS, SEGMENT_BYTES = 512, 4 << 20
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Automaton of (s?(ua)+)?: nothing yet, after s, after u, after a. START and PAIR may end.
START, SYSTEM, USER, PAIR = range(4)
#: The state behind a user or assistant message put in each state, and its role.
NEXT = {START: USER, SYSTEM: USER, USER: PAIR, PAIR: USER}
ROLE = {START: "user", SYSTEM: "user", USER: "assistant", PAIR: "user"}
#: (state, initial) -> state, for rows that are kept.
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): PAIR, (PAIR, "u"): USER}
GOOD_PAIRS = {"su", "ua", "au"}
#: Rows that must go, rows that would better go, sound rows.
MUST, CUT, SOUND = 0, 1, 2

INK = re.compile(r"[^\x20\x09-\x0D]")

COUNTS = ("rows", "blank", "truncated", "illegal", "duplicate")
PART_SCHEMA = (
    "conv_id {id}, seg long, whole boolean, rows long, blank long, truncated long, illegal long, duplicate long, "
    "first string, last string, low long, high long, turns long, initials array<string>, kinds array<int>, "
    "roles array<string>, texts array<string>, keys array<binary>, cost long, audit string, sha string, kept string"
)
PART_COLUMNS = [x.split()[0] for x in PART_SCHEMA.split(", ")]
LONG = 2**63 - 1


def blank(text: str) -> bool:
    return not INK.search(text)


def truncated(text: str) -> bool:
    """The last character that is not white space ends no sentence (white space alone: not truncated)."""
    end = text.rstrip(" \t\n\x0b\x0c\r")
    return bool(end) and end[-1] not in ".!?"


class Ways:
    """Least ways through rows, as integers: cost in the high digits, letters in `width` low ones."""

    def __init__(self, rows: int):
        # Deleting all rows but one and adding two messages reaches every state that can be reached.
        self.width = rows + (DELETE * rows + 3 * INSERT) // INSERT + 2
        self.low = (1 << 8 * self.width) - 1

    def put(self, letter: int, cost: int, way: int) -> int:
        """An edit before a way: letters move one digit to the right."""
        low = (letter << 8 * (self.width - 1)) | ((way & self.low) >> 8)
        return (((way >> 8 * self.width) + cost) << 8 * self.width) | low

    def read(self, way: int) -> tuple[int, bytes]:
        return way >> 8 * self.width, (way & self.low).to_bytes(self.width, "big").rstrip(b"\0")


D, I, K, R = b"DIKR"  # noqa: E741


def least_ways(initials: list[str], kinds: list[int], ends: tuple[int, ...]) -> dict[int, tuple[int, bytes]]:
    """From each state the cheapest way through all rows to one of `ends`: (cost, letters)."""
    ways = Ways(len(initials))
    put = ways.put

    def inserted(at: dict[int, int]) -> dict[int, int]:
        # At most two messages in a row: a third would only repeat the first one's state.
        for _ in range(2):
            more = dict(at)
            for s, t in NEXT.items():
                if t in at and (s not in more or put(I, INSERT, at[t]) < more[s]):
                    more[s] = put(I, INSERT, at[t])
            at = more
        return at

    at = inserted({s: 0 for s in ends})
    for initial, kind in zip(reversed(initials), reversed(kinds), strict=True):
        new = {s: put(D, DELETE, way) for s, way in at.items()}
        if kind != MUST:
            more = TRUNCATED if kind == CUT else 0
            for s, t in NEXT.items():
                options = [new[s]] if s in new else []
                if t in at:
                    options.append(put(R, REROLE + more, at[t]))
                if (keep := STEP.get((s, initial))) in at:
                    options.append(put(K, KEEP + more, at[keep]))
                if options:
                    new[s] = min(options)
        at = inserted(new)
    return {s: ways.read(way) for s, way in at.items()}


def repaired(audit: str, state: int, roles: list[str], texts: list[str]) -> tuple[list[str], int]:
    """The lines `role:text` that the edits leave, and the state behind them."""
    out, row = [], 0
    for letter in audit:
        if letter == "D":
            row += 1
        elif letter == "I":
            out.append(ROLE[state] + ":")
            state = NEXT[state]
        elif letter == "R":
            out.append(f"{ROLE[state]}:{texts[row]}")
            state, row = NEXT[state], row + 1
        else:
            out.append(f"{roles[row]}:{texts[row]}")
            state, row = STEP[state, roles[row][:1]], row + 1
    return out, state


def _key(role: str, text: str) -> bytes:
    body = role.encode()
    return hashlib.blake2b(len(body).to_bytes(8, "little") + body + text.encode(), digest_size=16).digest()


class _Segment:
    """Consecutive rows of one conversation."""

    def __init__(self, conv_id, start):
        self.conv_id, self.seg, self.bytes = conv_id, start, 0
        self.turns, self.roles, self.texts = [], [], []

    def add(self, turn, role: str, text: str) -> None:
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.bytes += len(text)

    def full(self) -> bool:
        return len(self.texts) >= SEGMENT_ROWS or self.bytes >= SEGMENT_BYTES

    def row(self, whole: bool, keep_text: bool) -> dict:
        """Solved where `whole`, else the segment with what its conversation needs of it."""
        initials = [r[:1] for r in self.roles]
        known = [t for t in self.turns if t is not None]
        seen, keys, kinds = set(), [], []
        out = dict.fromkeys(PART_COLUMNS) | dict.fromkeys(COUNTS, 0)
        out |= {"conv_id": self.conv_id, "seg": self.seg, "whole": whole, "rows": len(initials)}
        for role, text in zip(self.roles, self.texts, strict=True):
            key = (role, text) if whole else _key(role, text)
            keys.append(None if blank(text) or key in seen else key)
            if blank(text):
                kinds.append(MUST)
                out["blank"] += 1
            elif key in seen:
                kinds.append(MUST)
                out["duplicate"] += 1
            else:
                kinds.append(CUT if truncated(text) else SOUND)
                out["truncated"] += kinds[-1] == CUT
            seen.add(key)
        out["illegal"] = sum(a + b not in GOOD_PAIRS for a, b in zip(initials, initials[1:], strict=False))
        out["turns"] = len(set(known))
        if known:
            out["low"], out["high"] = min(known), max(known)
        if whole:
            way = least_ways(initials, kinds, (START, PAIR))[START]
            lines, _ = repaired(way[1].decode(), START, self.roles, self.texts)
            text = "\n".join(lines)
            out |= {"cost": way[0], "audit": way[1].decode(), "sha": hashlib.sha256(text.encode()).hexdigest()}
            out["kept"] = text if keep_text else None
        else:
            out |= {"first": initials[0], "last": initials[-1], "initials": initials, "kinds": kinds, "keys": keys}
            out |= {"roles": self.roles, "texts": self.texts}
        return out


def _segments(schema: pa.Schema, keep_text: bool):
    """Sorted rows of a partition to solved conversations and to segments of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, size = [], 0
        held, first, only, current = None, True, True, object()

        def flush():
            nonlocal done, size
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
            done, size = [], 0

        for b in batches:
            columns = [b.column(x).to_pylist() for x in ("conv_id", "place", "turn", "role", "text")]
            for conv_id, place, turn, role, text in zip(*columns, strict=True):
                new = held is None or conv_id != current
                if new or held.full():
                    if held is not None:
                        # The partition's first conversation may have begun before it.
                        done.append(held.row(new and only and not first, keep_text))
                        size += held.bytes
                        first = first and not new
                    only, current, held = new, conv_id, _Segment(conv_id, place)
                held.add(turn, role, text)
            if size >= SEGMENT_BYTES or len(done) >= SEGMENT_ROWS:
                yield from flush()
        if held is not None:  # the last one may go on behind the partition
            done.append(held.row(False, keep_text))
        yield from flush()

    return run


WAY_SCHEMA = "conv_id {id}, seg long, ways array<struct<a:int,b:int,cost:long,audit:string>>"


def _segment_ways(schema: pa.Schema):
    """Per segment the least way from each state to each state, with its duplicates known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                kinds = list(r["kinds"])
                for i in r["again"] or ():
                    kinds[i] = MUST
                ways = [
                    {"a": a, "b": end, "cost": cost, "audit": letters.decode()}
                    for end in range(4)
                    for a, (cost, letters) in least_ways(r["initials"], kinds, (end,)).items()
                ]
                out.append({"conv_id": r["conv_id"], "seg": r["seg"], "ways": ways})
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


PATH_SCHEMA = "conv_id {id}, segs array<long>, states array<int>, pieces array<string>, cost long, audit string"


def _join_ways(schema: pa.Schema):
    """Segments in order: the least way of every conversation, cut at its segments again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, segs, at = object(), [], {}

        def close():
            if not segs:
                return
            cost, text, steps = min(at[s] for s in (START, PAIR) if s in at)
            pieces = []
            while steps is not None:
                steps, state, piece = steps
                pieces.append((state, piece))
            pieces.reverse()
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "conv_id": current, "segs": segs, "states": [s for s, _ in pieces],
                        "pieces": [p for _, p in pieces], "cost": cost, "audit": text,
                    }
                ],
                schema,
            )

        for b in batches:
            for r in b.to_pylist():
                if r["conv_id"] != current or not segs:
                    yield from close()
                    current, segs, at = r["conv_id"], [], {START: (0, "", None)}
                new = {}
                for w in r["ways"]:
                    if w["a"] in at:
                        cost, text, steps = at[w["a"]]
                        way = (cost + w["cost"], text + w["audit"], (steps, w["a"], w["audit"]))
                        if w["b"] not in new or way[:2] < new[w["b"]][:2]:
                            new[w["b"]] = way
                at = new
                segs.append(r["seg"])
        yield from close()

    return run


def _write_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = b.select(["state", "piece", "roles", "texts"]).to_pylist()
        lines = [repaired(r["piece"], r["state"], r["roles"], r["texts"])[0] for r in rows]
        out = ["\n".join(x) if x else None for x in lines]
        columns = [b.column("conv_id"), b.column("seg"), pa.array(out, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["conv_id", "seg", "body"])


def _digest(schema: pa.Schema, keep_text: bool):
    """Repaired segments in order; each text goes through the digest and is let go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, some, kept = None, None, False, []

        def close():
            if digest is not None:
                text = "".join(kept) if keep_text else None
                yield pa.RecordBatch.from_pylist([{"conv_id": current, "sha": digest.hexdigest(), "kept": text}], schema)

        for b in batches:
            for conv_id, body in zip(b.column("conv_id").to_pylist(), b.column("body").to_pylist(), strict=True):
                if digest is None or conv_id != current:
                    yield from close()
                    current, digest, some, kept = conv_id, hashlib.sha256(), False, []
                if body is not None:
                    body = "\n" + body if some else body
                    some = True
                    digest.update(body.encode())
                    if keep_text:
                        kept.append(body)
        yield from close()

    return run


def _solve_segments(parts: DataFrame, id_type: str, keep_text: bool) -> DataFrame:
    """(conv_id, cost, audit, sha, kept, again) of the conversations in several segments."""
    spark = parts.sparkSession
    width = shuffle_width(spark)
    # The first row of each (role, text) in a segment, reduced to the first in the conversation.
    firsts = parts.select("conv_id", "seg", F.posexplode("keys").alias("i", "key")).where(F.col("key").isNotNull())
    least = firsts.groupBy("conv_id", "key").agg(F.min(F.struct("seg", "i")).alias("at"), F.count("*").alias("n"))
    least = least.where("n > 1").select(F.col("conv_id").alias("of"), F.col("key").alias("same"), "at")
    # A key comes at most once a segment, so a text of a third of all rows gives a row a segment.
    again = (
        firsts.join(least.hint("shuffle_hash"), F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("same")))
        .where("seg > at.seg")
        .groupBy("conv_id", "seg").agg(F.collect_list("i").alias("again"))
    )
    segments = materialise(_beside(parts, again, ["again"]), "conversation-segments")
    ways = segments.select("conv_id", "seg", "initials", "kinds", "again").mapInArrow(
        _segment_ways(_arrow(WAY_SCHEMA, id_type)), WAY_SCHEMA.format(id=id_type)
    )
    path = (
        ways.repartition(width, "conv_id").sortWithinPartitions("conv_id", "seg")
        .mapInArrow(_join_ways(_arrow(PATH_SCHEMA, id_type)), PATH_SCHEMA.format(id=id_type))
    )
    path = materialise(path, "conversation-paths")
    pieces = path.select("conv_id", F.explode(F.arrays_zip("segs", "states", "pieces")).alias("p")).select(
        "conv_id", F.col("p.segs").alias("seg"), F.col("p.states").alias("state"), F.col("p.pieces").alias("piece")
    )
    digest_schema = f"conv_id {id_type}, sha string, kept string"
    written = _beside(segments.select("conv_id", "seg", "roles", "texts"), pieces, ["state", "piece"])
    digests = (
        written.mapInArrow(_write_segments, f"conv_id {id_type}, seg long, body string")
        .repartition(width, "conv_id").sortWithinPartitions("conv_id", "seg")
        .mapInArrow(_digest(_arrow(digest_schema, id_type), keep_text), digest_schema)
    )
    known = "coalesce(again, CAST(array() AS array<int>))"
    counts = segments.groupBy("conv_id").agg(
        *(F.sum(c).alias(c) for c in COUNTS if c not in ("duplicate", "truncated")),
        (F.sum("duplicate") + F.sum(F.coalesce(F.array_size("again"), F.lit(0)))).alias("duplicate"),
        F.sum(F.expr(f"size(filter(kinds, (x, i) -> x = {CUT} AND NOT array_contains({known}, i)))")).alias("truncated"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("turns").alias("turns"),
        F.sort_array(F.collect_list(F.struct("seg", "first", "last", "low", "high"))).alias("borders"),
    )
    pairs = "transform(slice(borders, 2, size(borders)), (x, i) -> struct(borders[i] AS a, x AS b))"
    good = ", ".join(f"'{x}'" for x in sorted(GOOD_PAIRS))
    counts = counts.withColumns(
        {
            "illegal": F.expr(f"illegal + size(filter({pairs}, p -> concat(p.a.last, p.b.first) NOT IN ({good})))"),
            "turns": F.expr(f"turns - size(filter({pairs}, p -> p.a.high = p.b.low))"),
        }
    ).drop("borders")
    return _beside(_beside(counts, path, ["cost", "audit"], False), digests, ["sha", "kept"], False)


def _beside(left: DataFrame, right: DataFrame, columns: list[str], seg: bool = True) -> DataFrame:
    """`left` with the columns of its one row in `right`, null conversations included."""
    names = [F.col("conv_id").alias("_conv"), *([F.col("seg").alias("_seg")] if seg else []), *columns]
    on = F.col("conv_id").eqNullSafe(F.col("_conv"))
    if seg:
        on = on & (F.col("seg") == F.col("_seg"))
    return left.join(right.select(*names).hint("shuffle_hash"), on, "left").drop("_conv", "_seg")


def _arrow(schema: str, id_type: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema.format(id=id_type)))


def repair_conversations(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", alive: str | None = None, keep_text: bool = True,
) -> DataFrame:
    """Per conversation: faults, cost and letters of the repair, and (with `keep_text`) the repaired
    messages as lines `role:text`. Rows whose boolean column `alive` is false only name their conversation."""
    spark = turns.sparkSession
    id_type = turns.schema[conv_col].dataType.simpleString()
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), space(role_col).alias("role"),
        space(text_col).alias("text"), (F.col(alive) if alive else F.lit(True)).alias("alive"),
    )
    live = rows.where("alive").drop("alive").withColumn("tie", F.monotonically_increasing_id())
    # The last three only order rows of one turn and role; `tie` lets whole repeated rows spread.
    order = [
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"),
        F.substring("text", 1, 64), F.xxhash64("text"), F.col("tie"),
    ]
    parts = (
        live.repartitionByRange(shuffle_width(spark), *order)
        .sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id())
        .select("conv_id", "place", "turn", "role", "text")
        .mapInArrow(_segments(_arrow(PART_SCHEMA, id_type), keep_text), PART_SCHEMA.format(id=id_type))
    )
    parts = materialise(parts, "conversation-parts")
    results = ["blank", "truncated", "illegal", "duplicate", "low", "high", "turns", "cost", "audit", "sha", "kept"]
    split = _solve_segments(parts.where("NOT whole"), id_type, keep_text)
    solved = parts.where("whole").select("conv_id", *results).unionByName(split.select("conv_id", *results))
    everyone = rows.groupBy("conv_id").agg(F.lit(1).alias("one"))
    found = _beside(everyone, solved, results, False)
    wide = [F.col(x).cast("decimal(38,0)") for x in ("high", "low", "turns")]
    gaps = wide[0] - wide[1] + 1 - wide[2]
    gaps = F.when(gaps > LONG, F.lit(LONG)).otherwise(gaps.cast("long"))
    empty = hashlib.sha256(b"").hexdigest()
    kept = F.coalesce("kept", F.lit("")) if keep_text else F.lit(None).cast("string")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return found.select(
        "conv_id", F.coalesce(gaps, F.lit(0)).alias("gaps"), zero("blank"), zero("duplicate"), zero("truncated"),
        zero("illegal"), zero("cost"), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.lit(empty)).alias("repaired_sha256"), kept.alias("repaired"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Rows damaged by crc32 of `conv_id:turn`, modulo 20; dropped rows stay with `alive` false."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    what = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(what == 1, F.lit("")).when(what == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    copies = F.when(what == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    role = F.when(what == 4, F.lit("user")).otherwise(space("role"))
    return turns.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), (what != 0).alias("alive"), F.explode(copies).alias("copy")
    ).drop("copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = damaged(read(spark, sf_dir, "conversations"))
    return repair_conversations(turns, alive="alive", keep_text=False).drop("repaired")
