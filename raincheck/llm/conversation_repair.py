"""Conversation structure repair by divide and conquer over cost vectors.

Operator 11. A conversation is right when the initials of its roles read
``(s?(ua)+)?``: nothing, or an optional system turn and then user and assistant
in turn. The cheapest edits that make it so are found among Keep (0), Rerole to
user or assistant (3), Delete (4) and Insert of an empty user or assistant turn
(3); a truncated turn that is not deleted adds 3; blank and duplicate turns must
be deleted. Among equally cheap edits the audit (their initials in order) that
comes first in ASCII wins.

Method (Hirschberg): the automaton has four states (nothing yet, after system,
after user, after assistant). A cost vector is carried forward from the start
and another backward from the end to the middle of the conversation; the
crossing state with the least sum splits the problem into two halves, which are
solved in the same way. Space is linear, time about twice one pass. Beside each
cost the vector holds the rank of the state's least audit among the four, so
that the audit-least of equally cheap crossings is known without any audit
being written down: inserts are counted before the turn they precede, so every
audit of the same turns ends with a turn's own edit and none is a prefix of
another; audits then compare by rank first and by their new letters after.

Spark deals the turns by conversation and sorts them within the task; a task
reads them as a stream and holds one conversation at a time.

Defined results: null role or text: one space; null conv_id: one conversation
of its own; turns sort by (turn, nulls first, role, text), so repeated rows and
ties stay side by side, and of equal rows all but the first are duplicates; a
role counts by its first character, an empty one can't be kept; texts may be of
any length and are read whole; a conversation without rows (``copies`` 0) has
zeros, an empty audit and no repaired turns; an empty table gives no rows; other
columns are not read. A conversation is repaired in one task and must fit into
its memory, since its audit is one value.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Fixed by the contract: characters that are no content, ends of a whole sentence.
SPACE, END = " \t\n\x0b\x0c\r", ".!?"
LEGAL = {"su", "ua", "au"}
START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {"u": "user", "a": "assistant"}
#: What follows each state: role initial -> next state.
STEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: Turns missing at the end, by state.
CLOSING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
#: Conversations whose edits a task remembers, by the classes of their turns
#: (only those of up to SHORT turns: a memory of bounded size).
REMEMBERED, SHORT = 50_000, 64

SCHEMA = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
          "cost bigint, audit string, repaired array<struct<role:string,text:string>>")


def needed(state: int) -> str:
    """The role that an inserted or reroled turn takes in a state."""
    return "a" if state == USER else "u"


@lru_cache(None)
def moves(kind: str) -> tuple[tuple[tuple[int, int, str], ...], ...]:
    """For each state, the ways past one turn: (next state, cost, letters).

    ``kind`` is the turn's class: role initial, then ``-`` (must go), ``t``
    (truncated) or ``.`` (whole). Two inserts suffice: a third returns to a
    state that one insert reaches.
    """
    initial, fault = kind
    out = []
    for state in range(4):
        ways, at = [], state
        for n in range(3):
            paid, letters = n * INSERT, "I" * n
            ways.append((at, paid + DELETE, letters + "D"))
            if fault != "-":
                extra = TRUNCATED if fault == "t" else 0
                if initial in STEP[at]:
                    ways.append((STEP[at][initial], paid + extra, letters + "K"))
                ways.append((STEP[at][needed(at)], paid + extra + REROLE, letters + "R"))
            at = STEP[at][needed(at)]
        out.append(tuple(ways))
    return tuple(out)


#: A vector maps a state to (cost, rank of its least audit among the vector's).
Vector = dict[int, tuple[int, int]]


def _ranked(best: dict[int, tuple]) -> Vector:
    """``best``: state -> (cost, key), keys comparing as the audits do."""
    order = {k: i for i, k in enumerate(sorted({key for _, key in best.values()}))}
    return {state: (cost, order[key]) for state, (cost, key) in best.items()}


def forward(kinds: list[str], i: int, j: int, state: int) -> Vector:
    """Costs from ``state`` before turn i to each state before turn j."""
    now: Vector = {state: (0, 0)}
    for kind in kinds[i:j]:
        best: dict[int, tuple] = {}
        for at, (cost, rank) in now.items():
            for to, paid, letters in moves(kind)[at]:
                new = cost + paid, (rank, letters)
                if to not in best or new < best[to]:
                    best[to] = new
        now = _ranked(best)
    return now


def backward(kinds: list[str], i: int, j: int, state: int) -> Vector:
    """Costs from each state before turn i to ``state`` before turn j."""
    now: Vector = {state: (0, 0)}
    for kind in reversed(kinds[i:j]):
        best: dict[int, tuple] = {}
        for at, ways in enumerate(moves(kind)):
            for to, paid, letters in ways:
                if to in now:
                    cost, rank = now[to]
                    new = cost + paid, (letters, rank)
                    if at not in best or new < best[at]:
                        best[at] = new
        now = _ranked(best)
    return now


def edits(kinds: list[str]) -> tuple[int, list[str]]:
    """The least cost, and the letters before and at each turn, then those at the end."""
    whole = forward(kinds, 0, len(kinds), START)
    cost, _, close, last = min(
        (cost + len(CLOSING[s]) * INSERT, rank, CLOSING[s], s) for s, (cost, rank) in whole.items())
    out: list[str] = []
    todo = [(0, len(kinds), START, last)]
    while todo:
        i, j, start, stop = todo.pop()
        if j - i == 1:
            out.append(min((paid, letters) for to, paid, letters in moves(kinds[i])[start] if to == stop)[1])
        elif j > i:
            middle = (i + j) // 2
            left, right = forward(kinds, i, middle, start), backward(kinds, middle, j, stop)
            cross = min((left[s][0] + right[s][0], left[s][1], right[s][1], s) for s in left if s in right)[-1]
            todo += [(middle, j, cross, stop), (i, middle, start, cross)]
    return cost, [*out, close]


remembered = lru_cache(REMEMBERED)(lambda kinds: edits(kinds.split("\n") if kinds else []))


def repaired_turns(rows: list[tuple[str, str]], steps: list[str]) -> list[dict]:
    """The turns after the edits: roles of new and reroled turns follow the state."""
    out, state = [], START
    for k, letters in enumerate(steps):
        for letter in letters:
            role, text = rows[k] if k < len(rows) and letter != "I" else ("", "")
            if letter == "D":
                continue
            if letter != "K":
                role = NAMES[needed(state)]
            state = STEP[state][role[0]]
            out.append({"role": role, "text": text})
    return out


def examine(conv_id: int | None, turns: list[int | None], rows: list[tuple[str, str]]) -> dict:
    """Faults and repair of one conversation's rows, in order."""
    seen: set[tuple[str, str]] = set()
    kinds, counts = [], {"-": 0, "=": 0, "t": 0, ".": 0}
    for row in rows:
        content = row[1].strip(SPACE)
        fault = "-" if not content else "=" if row in seen else "t" if content[-1] not in END else "."
        seen.add(row)
        counts[fault] += 1
        initial = row[0][:1]
        kinds.append((initial if initial in ("s", "u", "a") else "o") + ("-" if fault == "=" else fault))
    known = [t for t in turns if t is not None]
    cost, steps = remembered("\n".join(kinds)) if len(kinds) <= SHORT else edits(kinds)
    initials = [role[:1] for role, _ in rows]
    return {
        "conv_id": conv_id, "gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0,
        "blank": counts["-"], "duplicate": counts["="], "truncated": counts["t"],
        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False)),
        "cost": cost, "audit": "".join(steps), "repaired": repaired_turns(rows, steps)}


def _conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """Sorted turns in, one result per conversation out."""
    now, turns, rows, begun = None, [], [], False
    for batch in batches:
        for conv, turn, role, text, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if begun and conv != now:
                yield examine(now, turns, rows)
                turns, rows = [], []
            now, begun = conv, True
            turns += [turn] * copies
            rows += [(role, text)] * copies
    if begun:
        yield examine(now, turns, rows)


def repair(turns: DataFrame) -> DataFrame:
    """Faults, cost, audit and repaired turns of each conversation.

    ``turns``: conv_id, turn, role, text and, if a column ``copies`` (int) is
    there, how often the row stands; 0 only names its conversation.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        (F.col("copies").cast("int") if "copies" in turns.columns else F.lit(1)).alias("copies"))
    dealt = rows.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")
    schema = to_arrow_schema(rows.sparkSession.createDataFrame([], SCHEMA).schema)

    def run(batches):
        ready, size = [], 0
        for result in _conversations(batches):
            ready.append(result)
            size += 200 + sum(len(t["text"]) for t in result["repaired"])
            if size > 1 << 22:
                yield pa.RecordBatch.from_pylist(ready, schema)
                ready, size = [], 0
        if ready:
            yield pa.RecordBatch.from_pylist(ready, schema)

    return dealt.mapInArrow(run, SCHEMA)


def shown(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(turns: DataFrame) -> DataFrame:
    """The contract's damage, by the checksum of conversation and turn."""
    kind = F.crc32(F.concat_ws(":", shown("conv_id"), shown("turn"))) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return turns.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def query(spark, sf_dir: str) -> DataFrame:
    done = repair(damage(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    lines = F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    return done.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                       F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"))


# A plain dynamic programme that carries whole audits and texts from turn to
# turn. crc32 is computed bit by bit from its polynomial.
ORACLE = r"""
WITH RECURSIVE keyed AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations
), summed AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(k) + 1), lambda i: ascii(substr(k, i, 1))::BIGINT)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, z: xor(x >> 1, 3988292384::BIGINT * (x & 1)))),
    4294967295::BIGINT) % 20 AS kind
  FROM keyed
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text
  FROM summed, unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS was,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS fin
  FROM damaged
), faulty AS (
  SELECT *, CASE WHEN fin = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
    WHEN fin NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault
  FROM placed
), automaton(st, letter, nxt) AS (
  VALUES ('-', 's', 's'), ('-', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')
), filling(st, ins, reached, added) AS (
  VALUES ('-', '', '-', ''), ('-', 'I', 'u', E'\nuser:'), ('-', 'II', 'a', E'\nuser:\nassistant:'),
    ('s', '', 's', ''), ('s', 'I', 'u', E'\nuser:'), ('s', 'II', 'a', E'\nuser:\nassistant:'),
    ('u', '', 'u', ''), ('u', 'I', 'a', E'\nassistant:'), ('a', '', 'a', ''), ('a', 'I', 'u', E'\nuser:')
), paths AS (
  SELECT conv_id, 0::BIGINT AS pos, '-' AS st, 0::BIGINT AS cost, '' AS audit, '' AS said
  FROM (SELECT DISTINCT conv_id FROM placed)
  UNION ALL
  SELECT conv_id, pos, st, cost, audit, said FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, st ORDER BY cost, audit) AS choice FROM (
      SELECT p.conv_id, r.pos, f.reached AS st, p.cost + 3 * length(f.ins) + 4 AS cost, p.audit || f.ins || 'D' AS audit,
        p.said || f.added AS said
      FROM paths p JOIN filling f ON f.st = p.st JOIN faulty r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.pos = p.pos + 1
      UNION ALL
      SELECT p.conv_id, r.pos, a.nxt,
        p.cost + 3 * length(f.ins) + CASE WHEN r.fault = 'truncated' THEN 3 ELSE 0 END + CASE WHEN e.edit = 'R' THEN 3 ELSE 0 END,
        p.audit || f.ins || e.edit,
        p.said || f.added || E'\n' || CASE WHEN e.edit = 'K' THEN r.role WHEN a.letter = 'u' THEN 'user' ELSE 'assistant' END || ':' || r.text
      FROM paths p JOIN filling f ON f.st = p.st JOIN faulty r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.pos = p.pos + 1
        JOIN automaton a ON a.st = f.reached CROSS JOIN (VALUES ('K'), ('R')) e(edit)
      WHERE r.fault NOT IN ('blank', 'duplicate')
        AND CASE WHEN e.edit = 'K' THEN a.letter = left(r.role, 1) ELSE a.letter <> 's' END
    )
  ) WHERE choice = 1
), sizes AS (
  SELECT conv_id, max(pos) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pos > 1 AND was || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
), ended AS (
  SELECT p.conv_id, p.cost + 3 * length(f.ins) AS cost, p.audit || f.ins AS audit, substr(p.said || f.added, 2) AS said,
    row_number() OVER (PARTITION BY p.conv_id ORDER BY p.cost + 3 * length(f.ins), p.audit || f.ins) AS choice
  FROM paths p JOIN sizes s ON s.conv_id IS NOT DISTINCT FROM p.conv_id AND s.n = p.pos
    JOIN filling f ON f.st = p.st WHERE f.reached IN ('-', 'a')
)
SELECT o.conv_id, CAST(coalesce(s.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(s.blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(s.duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(s.truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(s.illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(e.cost, 0) AS BIGINT) AS cost,
  coalesce(e.audit, '') AS audit, sha256(coalesce(e.said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN sizes s ON s.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id AND e.choice = 1
"""
