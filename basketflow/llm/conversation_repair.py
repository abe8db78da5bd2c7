"""Repair of conversations by the cheapest edits, found by iterative-deepening A*.

Every row of a conversation is kept (K), given the role that is due (R) or deleted (D), and rows of
empty text may be inserted (I) before any row and at the end, so that the roles read
``system? (user assistant)+`` or nothing is left. The search goes depth first through the edits in
ASCII order, under a bound of the cost that rises to the least cost found beyond it; a table holds
for each failed state (row, roles so far) the cost it is known to need at least. The first path that
ends well under the bound is the answer: the cheapest, and of equally cheap ones the ASCII-least.

A row's fate rarely depends on rows far away. So the search is run for the states at every 16th row
first, from the back: what these cost is the exact estimate of all searches in front of them, and the
effort grows with the length of a conversation, not with its square.

Conversations reach the tasks as sorted streams, first of one code a row, then with their texts; a
task holds the codes of a conversation (one byte a row; the audit in its result row is as long), never
its texts. SHA-256 reads a conversation's lines one after another, so one task hashes them, in
batches, however long it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from basketflow.llm.common import table
from basketflow.llm.merkle import _CRC_TABLE, crc32_sql
from basketflow.session import materialize

# Fixed values of the repair.
DELETE, INSERT, REROLE, CUT_OFF = 4, 3, 3, 3
SPACE = " \t\n\x0b\x0c\r"
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)

# Roles so far: nothing, a system row, a user row last, an assistant row last.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_KEEPS = [{"s": _SYSTEM, "u": _USER}, {"u": _USER}, {"a": _ASSISTANT}, {"u": _USER}]
_DUE = [_USER, _USER, _ASSISTANT, _USER]
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
_GOOD_END = (_START, _ASSISTANT)

# Rows between the states whose cost is searched first; a search goes no deeper than two such lengths.
SPAN = 16
_NEVER = 1 << 60


def row_code(initial: str, fault: int) -> str:
    """A row as the search sees it: ``x`` if it must go, its role's initial, upper case if cut off."""
    if fault in (BLANK, DUPLICATE):
        return "x"
    known = initial if initial in ("s", "u", "a") else "o"
    return known.upper() if fault == TRUNCATED else known


def _least(code: str) -> int:
    """What a row costs at least, whatever stands around it."""
    if code == "x":
        return DELETE
    cut = CUT_OFF if code.isupper() else 0
    return min(DELETE, cut + (REROLE if code in "oO" else 0))


class Search:
    """Cheapest edits of one conversation, given as a string of row codes."""

    def __init__(self, codes: str):
        self.codes = codes
        # Exact costs of the four states at the rows that have been searched, by row number // SPAN.
        self.exact: dict[int, list[int]] = {}

    def _moves(self, at: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        """(edit, cost, next row, next state) in ASCII order."""
        due = _DUE[state]
        if at == len(self.codes):
            yield "I", INSERT, at, due
            return
        code = self.codes[at]
        yield "D", DELETE, at + 1, state
        yield "I", INSERT, at, due
        if code != "x":
            cut = CUT_OFF if code.isupper() else 0
            kept = _KEEPS[state].get(code.lower())
            if kept is not None:
                yield "K", cut, at + 1, kept
            yield "R", REROLE + cut, at + 1, due

    def run(self, start: int, state: int) -> tuple[int, str, int, int]:
        """(cost to the end, edits, row, state) of the cheapest path as far as the next searched row."""
        stop = min(len(self.codes), (start // SPAN + 1) * SPAN)
        known = self.exact.get(stop // SPAN) if stop < len(self.codes) else None
        ends_here = stop == len(self.codes)
        # Estimate: the least cost of the rows up to the stop, and of the cheapest state there.
        rest = [0] * (stop - start + 1)
        rest[-1] = min(known) if known else 0
        for i in range(stop - 1, start - 1, -1):
            rest[i - start] = rest[i - start + 1] + _least(self.codes[i])
        failed: dict[tuple[int, int], int] = {}
        path: list[str] = []
        end = [stop, state]

        def walk(at: int, now: int, left: int) -> int:
            """The cost of the first good path if within ``left``, else a cost that is needed at least."""
            if at == stop and known:
                if known[now] <= left:
                    end[:] = at, now
                return known[now]
            if at == stop and ends_here and now in _GOOD_END:
                end[:] = at, now
                return 0
            need = failed.get((at, now), rest[at - start])
            if need > left:
                return need
            need = _NEVER
            for edit, cost, then, after in self._moves(at, now):
                if cost > left:
                    beyond = cost + failed.get((then, after), rest[then - start])
                else:
                    beyond = cost + walk(then, after, left - cost)
                    if beyond <= left:
                        path.append(edit)
                        return beyond
                need = min(need, beyond)
            failed[at, now] = need
            return need

        bound = rest[0]
        while (need := walk(start, state, bound)) > bound:
            bound = need
        return need, "".join(reversed(path)), *end

    def cheapest(self) -> tuple[int, str]:
        """(cost, audit): the edits' initials in order, ASCII-least of the cheapest."""
        for block in range((len(self.codes) - 1) // SPAN, 0, -1):
            self.exact[block] = [self.run(block * SPAN, state)[0] for state in range(4)]
        total, audit, at, state = self.run(0, _START)
        parts = [audit]
        while at < len(self.codes):
            _, audit, at, state = self.run(at, state)
            parts.append(audit)
        return total, "".join(parts)


def replay(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired (role, text) rows of a conversation."""
    state = _START
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit == "K":
            state = _KEEPS[state][role[:1]]
        else:
            state = _DUE[state]
            role = _ROLE[state]
        yield role, text


def damage(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The contract's damage: rows (conv, turn, role, text, gone); dropped rows stay as ``gone``, without text.

    A missing role or text counts as one space, and so do missing ids and turns in the key that is
    hashed.
    """
    conv, at, who, body = (F.col(f"`{c}`") for c in (conv_id, turn, role, text))
    blank = F.lit(" ")
    key = F.concat(F.coalesce(conv.cast("string"), blank), F.lit(":"), F.coalesce(at.cast("string"), blank))
    mark = (F.crc32(key.cast("binary")) % 20).cast("int")
    own_role, own_text = F.coalesce(who.cast("string"), blank), F.coalesce(body.cast("string"), blank)
    gone = mark == 0
    hit = conversations.select(
        conv.alias("conv"),
        F.when(~gone, at).alias("turn"),
        F.when(~gone, F.when(mark == 4, "user").otherwise(own_role)).alias("role"),
        F.when(mark == 1, "").when(mark == 2, F.translate(own_text, ".!?", "")).when(~gone, own_text).alias("text"),
        gone.alias("gone"),
        F.when(mark == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"),
    )
    return hit.select("conv", "turn", "role", "text", "gone", F.explode("copies").alias("copy")).drop("copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """Add ``again`` (role and text seen earlier), ``fault`` (the first that a row has) and ``tie``, a hash of the text.

    Rows of one text are dealt by all of conversation, role and text.
    """
    earlier = Window.partitionBy("conv", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    last = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    again = F.row_number().over(earlier) > 1
    fault = F.when(last == "", BLANK).when(F.col("again"), DUPLICATE).when(~last.isin(".", "!", "?"), TRUNCATED)
    return rows.withColumn("again", again).select(
        "*", F.coalesce(fault, F.lit(SOUND)).alias("fault"), F.xxhash64("text").alias("tie")
    )


_COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def with_ties(faulty: DataFrame) -> DataFrame:
    """The rows with ``tie`` in the order of the texts where rows of one turn and role have several.

    Such rows are rare: only they are looked at, and most tables have none.
    """
    of = ["conv", "turn", "role"]
    crowded = faulty.filter(~F.col("gone")).groupBy(*of).agg(F.min("tie").alias("low"), F.max("tie").alias("high"))
    crowded = materialize(crowded.filter("low <> high").select(*of), "crowded-turns")
    if crowded.isEmpty():
        return faulty

    def same(columns: list[str]) -> Column:
        return reduce(lambda a, b: a & b, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in columns])

    texts = faulty.alias("l").join(crowded.alias("r"), same(of), "left_semi").select(*of, "tie", "text").distinct()
    ranked = texts.withColumn("place", F.row_number().over(Window.partitionBy(*of).orderBy("text"))).drop("text")
    joined = faulty.alias("l").join(ranked.alias("r"), same([*of, "tie"]), "left")
    own = [F.col(f"l.{c}") for c in faulty.columns if c != "tie"]
    return materialize(joined.select(*own, F.coalesce("r.place", "l.tie").cast("long").alias("tie")), "ordered-faults")


def _order() -> list[Column]:
    """Rows of a conversation by turn (missing first), role and text, copies last."""
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("tie"), F.col("again")]


def _by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Conversations of a sorted stream, each with its rows; nothing is held but the batch."""
    rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns], strict=True))
    return groupby(rows, key=lambda row: row[0])


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1024) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)


def _audited(conv: object, rows: Iterator[tuple]) -> tuple:
    """The result row of one conversation: counts of faults, and the cheapest edits."""
    codes, faults, illegal = bytearray(), [0] * 4, 0
    before, turns, least, most, latest = None, 0, None, None, None
    for _, turn, initial, fault, gone in rows:
        if gone:
            continue
        faults[fault] += 1
        illegal += before is not None and before + initial not in ("su", "ua", "au")
        before = initial
        codes += row_code(initial, fault).encode()
        if turn is not None and turn != latest:
            turns, latest, most = turns + 1, turn, turn
            least = turn if least is None else least
    gaps = 0 if least is None else int(most - least + 1 - turns)
    cost, audit = Search(codes.decode()).cheapest()
    return conv, gaps, *faults[1:], illegal, cost, audit


def audit(faulty: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation."""
    schema = T.StructType([faulty.schema["conv"], *T.StructType.fromDDL(_COUNTS)])
    target = to_arrow_schema(schema)
    # What is not a known initial is not legal beside anything; the role itself is only sorted by.
    initial = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("o")
    narrow = faulty.select("conv", "turn", "role", "tie", "again", initial.alias("initial"), "fault", "gone")
    dealt = narrow.repartition("conv").sortWithinPartitions("conv", *_order())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches((_audited(conv, rows) for conv, rows in _by_conversation(batches)), target)

    return dealt.select("conv", "turn", "initial", "fault", "gone").mapInArrow(run, schema)


def _with_audits(faulty: DataFrame, audits: DataFrame) -> DataFrame:
    """One sorted stream: each conversation's audit, then its rows."""
    rows = faulty.filter(~F.col("gone")).select(
        "conv", F.lit(1).alias("part"), "turn", "role", "tie", "again", "text", F.lit(None).cast("string").alias("audit")
    )
    heads = audits.select("conv", F.lit(0).alias("part"), "audit")
    both = rows.unionByName(heads, allowMissingColumns=True).repartition("conv")
    return both.sortWithinPartitions("conv", "part", *_order()).select("conv", "role", "text", "audit")


def _replayed(rows: Iterator[tuple]) -> Iterator[tuple[str, str]]:
    edits = next(rows)[3]
    return replay(edits, ((role, text) for _, role, text, _ in rows))


def repaired_rows(faulty: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv, place, role, text): the rows of all repaired conversations, ``place`` from 0."""
    schema = T.StructType([faulty.schema["conv"], *T.StructType.fromDDL("place long, role string, text string")])
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = (
            (conv, place, role, text)
            for conv, rows in _by_conversation(batches)
            for place, (role, text) in enumerate(_replayed(rows))
        )
        return _batches(made, target, 64)

    return _with_audits(faulty, audits).mapInArrow(run, schema)


def repaired_digests(faulty: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): SHA-256 of a conversation's ``role:text`` lines, joined by line feeds."""
    schema = T.StructType([faulty.schema["conv"], *T.StructType.fromDDL("repaired_sha256 string")])
    target = to_arrow_schema(schema)

    def digest(rows: Iterator[tuple]) -> str:
        state, between = hashlib.sha256(), ""
        for role, text in _replayed(rows):
            state.update(f"{between}{role}:{text}".encode())
            between = "\n"
        return state.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(((conv, digest(rows)) for conv, rows in _by_conversation(batches)), target)

    return _with_audits(faulty, audits).mapInArrow(run, schema)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Audits of the conversations in rows (conv, turn, role, text, gone), and the rows with their faults.

    The faults are written once; ``repaired_rows`` and ``repaired_digests`` take both results. A
    missing ``conv`` is a conversation of its own. Rows of one turn are taken by role and text. One without rows, or whose rows are all ``gone``,
    has zeros and an empty audit. Repeated rows are duplicates of the first. An empty table gives
    empty results.
    """
    faulty = with_ties(materialize(with_faults(rows), "faults"))
    return materialize(audit(faulty), "audits"), faulty


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    audits, faulty = repair(damage(table(spark, sf_dir, "conversations")))
    digests = repaired_digests(faulty, audits)
    same = F.col("a.conv").eqNullSafe(F.col("d.conv"))
    counts = [f"a.{f.name}" for f in audits.schema.fields[1:]]
    return (
        audits.alias("a").join(digests.alias("d"), same)
        .select(F.col("a.conv").alias("conv_id"), *counts, "d.repaired_sha256")
    )


# The same by exhaustion: the cheapest way to each state after each row, the ASCII-least of equal ones.
SQL = f"""
WITH RECURSIVE crc AS (SELECT {_CRC_TABLE} AS tab),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
marked AS (SELECT *, {crc32_sql("k")} % 20 AS m FROM keyed, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN m = 4 THEN 'user' ELSE role END AS role,
    CASE m WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM marked, range(2) r(copy) WHERE m <> 0 AND (copy = 0 OR m = 3)),
seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS again,
    right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last FROM damaged),
rws AS (
  SELECT *, CASE WHEN last = '' THEN 1 WHEN again THEN 2 WHEN last NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    left(role, 1) AS ini, row_number() OVER w AS pos, lag(left(role, 1)) OVER w AS prev
  FROM seen WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again)),
stats AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (prev IS NOT NULL AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rws GROUP BY conv_id),
convs AS (
  SELECT DISTINCT c.conv_id, coalesce(n, 0) AS n FROM conversations c LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM c.conv_id),
inserts(q, p, cost, edits, lines) AS (VALUES
  (0, 0, 0, '', ''), (0, 2, 3, 'I', chr(10) || 'user:'), (0, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
  (1, 1, 0, '', ''), (1, 2, 3, 'I', chr(10) || 'user:'), (1, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
  (2, 2, 0, '', ''), (2, 3, 3, 'I', chr(10) || 'assistant:'),
  (3, 3, 0, '', ''), (3, 2, 3, 'I', chr(10) || 'user:'), (2, 2, 6, 'II', chr(10) || 'assistant:' || chr(10) || 'user:'),
  (3, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')),
edits(p, e, ini, q) AS (VALUES
  (0, 'D', NULL, 0), (1, 'D', NULL, 1), (2, 'D', NULL, 2), (3, 'D', NULL, 3),
  (0, 'K', 's', 1), (0, 'K', 'u', 2), (1, 'K', 'u', 2), (2, 'K', 'a', 3), (3, 'K', 'u', 2),
  (0, 'R', NULL, 2), (1, 'R', NULL, 2), (2, 'R', NULL, 3), (3, 'R', NULL, 2)),
ways(conv_id, i, q, best) AS (
  SELECT conv_id, 0, 0, {{'cost': 0, 'audit': '', 'lines': ''}} FROM convs
  UNION ALL
  SELECT w.conv_id, w.i + 1, e.q, min({{
    'cost': w.best.cost + n.cost + CASE e.e WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
      + CASE WHEN e.e <> 'D' AND r.fault = 3 THEN 3 ELSE 0 END,
    'audit': w.best.audit || n.edits || e.e,
    'lines': w.best.lines || n.lines || CASE e.e WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || r.role || ':' || r.text
      ELSE chr(10) || CASE e.q WHEN 2 THEN 'user' ELSE 'assistant' END || ':' || r.text END}})
  FROM ways w JOIN inserts n ON n.q = w.q JOIN edits e ON e.p = n.p
    JOIN rws r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.pos = w.i + 1
  WHERE (e.ini IS NULL OR e.ini = r.ini) AND (e.e = 'D' OR r.fault NOT IN (1, 2))
  GROUP BY w.conv_id, w.i, e.q),
ended AS (
  SELECT w.conv_id, min({{'cost': w.best.cost + n.cost, 'audit': w.best.audit || n.edits, 'lines': w.best.lines || n.lines}}) AS best
  FROM ways w JOIN convs c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i JOIN inserts n ON n.q = w.q
  WHERE n.p IN (0, 3) GROUP BY w.conv_id)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(e.best.cost AS BIGINT) AS cost,
  e.best.audit AS audit, sha256(substr(e.best.lines, 2)) AS repaired_sha256
FROM ended e LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM e.conv_id
"""
