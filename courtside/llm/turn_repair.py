r"""Conversation structure repair by iterative-deepening A*.

Rows of a conversation stand in the order of turn (nulls first), of one turn
by role, then by the MD5 of role and text.  A row's first fault counts: blank
(no ``[^\x20\x09-\x0D]``), duplicate (role and text stood earlier),
truncated (its last such character is not one of ``.!?``).  Edits: Keep (0),
Rerole to user or assistant (1), Delete (2, required for blank and
duplicate), Insert an empty user or assistant row (5); a truncated row that
stays costs 5 more.  The roles' initials must become ``(s?(ua)+)?``.

The initials read so far leave one of four states (``KEEP``), and a state
admits one role only, so a path is told by its edits' initials.  ``Search``
looks depth first, edits in ASCII order (D, I, K, R), for a path within a
cost bound; the bound rises to the least cost that the last pass could not
rule out, so the first path that ends in an accepting state is the cheapest
and, of these, the first in ASCII order.  Two lower bounds prune:

* ``floor``: what the rows to come cost at least, from the relaxed problem
  in which each segment of ``SEGMENT`` rows may begin and end in any state.
* the transposition table: for each (row, state) that failed, the least that
  its own search found it to cost.  It holds for every bound, so it is kept.

Both are lists along the conversation and the search keeps its own stack, so
very long conversations don't recurse.

A conversation is searched where its rows meet, but its texts are not held:
the rows come twice in one sorted stream, first without texts (state of the
search: some bytes a row), then with them, and the repaired rows are written
or hashed as they pass.  So memory doesn't grow with the texts.

Defined results: a null conversation id is one conversation; null roles and
texts are ``NULL_AS`` (one space, so such a text is blank); a row of any other
or an empty role can only be reroled or deleted; a conversation
without rows (none ``present``) gives zeros, an empty audit and the hash of
the empty string; an empty table gives an empty result; repeated rows are
duplicates; only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import batches_of, ship_package

NULL_AS = " "
SEGMENT = 256
BLANK = r"\A[\x20\x09-\x0D]*+\z"
ENDED = r"[.!?][\x20\x09-\x0D]*+\z"
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5

#: States: 0 nothing yet, 1 after the system row, 2 after a user row, 3 after an assistant row.  0 and 3 accept.
KEEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
NEXT = (2, 2, 3, 2)  # by an inserted or reroled row: to the user's, or the assistant's, state
ACCEPTS = (True, False, False, True)
ROLE = {2: "user", 3: "assistant"}
LEGAL = {"su", "ua", "au"}


class Search:
    """The cheapest edits of one conversation: ``rows`` are (initial of the role, must go, truncated)."""

    def __init__(self, rows: list[tuple[str, bool, bool]], segment: int = SEGMENT):
        self.rows, n = rows, len(rows)
        self.floor = self._floors(segment)
        self.table = [[0] * 4 for _ in range(n + 1)]  # least cost known from (row, state) to the end
        bound = self.floor[0]
        self.path: list[str] | None = None
        while self.path is None:
            self.bound = bound
            bound = self._deepen(bound)
        self.cost, self.audit = self.bound, "".join(self.path)

    def _edits(self, i: int, state: int) -> list[tuple[str, int, int, int]]:
        """(edit, cost, next row, next state) in ASCII order."""
        if i == len(self.rows):
            return [("I", INSERT, i, NEXT[state])]
        initial, must_go, truncated = self.rows[i]
        out = [("D", DELETE, i + 1, state), ("I", INSERT, i, NEXT[state])]
        if not must_go:
            more = TRUNCATED if truncated else 0
            if initial in KEEP[state]:
                out.append(("K", more, i + 1, KEEP[state][initial]))
            out.append(("R", REROLE + more, i + 1, NEXT[state]))
        return out

    def _floors(self, segment: int) -> list[int]:
        """Per row a lower bound of the cost from there on, whatever the state."""
        n = len(self.rows)
        floor, later, ahead = [0] * (n + 1), 0, [0 if ok else 99 for ok in ACCEPTS]
        for i in range(n, -1, -1):
            here = ahead if i == n else [min(c + ahead[to] for e, c, _, to in self._edits(i, s) if e != "I") for s in range(4)]
            for _ in range(2):  # an inserted row, or two
                here = [min(here[s], INSERT + here[NEXT[s]]) for s in range(4)]
            floor[i] = later + min(here)
            ahead = here
            if i % segment == 0:
                later, ahead = floor[i], [0] * 4
        return floor

    def _deepen(self, bound: int) -> int:
        """Search within ``bound``; sets ``path`` when found, else returns the next bound."""
        floor, table = self.floor, self.table
        end, path = len(self.rows), []
        stack = [[0, 0, bound, iter(self._edits(0, 0)), 1 << 60, 0]]  # row, state, budget, edits left, least seen, cost of the edit into it
        if ACCEPTS[0] and not end:
            self.path = path
            return 0
        while stack:
            frame = stack[-1]
            i, state, budget, edits, least, _ = frame
            for edit, cost, to_row, to in edits:
                known = max(floor[to_row], table[to_row][to])
                if cost + known > budget:
                    least = min(least, cost + known)
                    continue
                path.append(edit)
                if to_row == end and ACCEPTS[to]:
                    self.path = path
                    return bound
                frame[4] = least
                stack.append([to_row, to, budget - cost, iter(self._edits(to_row, to)), 1 << 60, cost])
                break
            else:
                table[i][state] = max(table[i][state], least)
                stack.pop()
                if stack:
                    path.pop()
                    stack[-1][4] = min(stack[-1][4], frame[5] + table[i][state])
        return table[0][0]


def repaired(audit: str, rows: Iterator[tuple]) -> Iterator[tuple]:
    """The rows that the edits leave, as (turn, edit, role, text), from the conversation's (turn, role, text) rows."""
    state = 0
    for edit in audit:
        if edit == "I":
            state = NEXT[state]
            yield None, "I", ROLE[state], ""
            continue
        turn, role, text = next(rows)
        if edit == "K":
            state = KEEP[state][role[:1]]
            yield turn, "K", role, text
        elif edit == "R":
            state = NEXT[state]
            yield turn, "R", ROLE[state], text


class Conversation:
    """Counts over the rows without texts, then the search."""

    def __init__(self, rows: Iterator[tuple]):
        """``rows``: (turn, role, digest of role and text, blank, ended)."""
        turns, seen, before, plain = set(), set(), None, []
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        for turn, role, digest, blank, ended in rows:
            if turn is not None:
                turns.add(turn)
            again = digest in seen
            seen.add(digest)
            if blank:
                self.blank += 1
            elif again:
                self.duplicate += 1
            elif not ended:
                self.truncated += 1
            initial = role[:1]
            self.illegal += before is not None and before + initial not in LEGAL
            before = initial
            plain.append((initial, blank or again, not ended))
        self.gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        found = Search(plain)
        self.cost, self.audit = found.cost, found.audit

    def summary(self) -> tuple:
        return self.gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, self.audit


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The contract's damage; ``present`` is false for rows that it drops, so that no conversation is lost."""
    def filled(c: str, null_as: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(null_as))

    kind = F.crc32(F.concat(filled(conv_col, NULL_AS), F.lit(":"), filled(turn_col, NULL_AS)).cast("binary")) % 20
    text = filled(text_col, NULL_AS)
    hurt = rows.select(
        F.col(conv_col).cast("long").alias(conv_col), F.col(turn_col).cast("long").alias(turn_col),
        F.when(kind == 4, F.lit("user")).otherwise(filled(role_col, NULL_AS)).alias(role_col),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias(text_col),
        (kind != 0).alias("present"), F.when(kind == 3, F.lit(2)).otherwise(F.lit(1)).alias("_times"))
    return hurt.withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_times", "_time")


def _stream(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, present_col: str | None) -> DataFrame:
    """Every row twice (``kind`` 0 without its text, 1 with it), conversations together, in order."""
    ship_package(rows.sparkSession)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(NULL_AS)) for c in (role_col, text_col))
    present = F.lit(True) if present_col is None else F.coalesce(F.col(present_col), F.lit(False))
    one = rows.select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        present.alias("present"), F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, F.lit(":"), text))).alias("digest"),
        text.rlike(BLANK).alias("blank"), text.rlike(ENDED).alias("ended"))
    both = one.where("present").withColumn("kind", F.explode(F.array(F.lit(0), F.lit(1)))).unionByName(
        one.where("not present").withColumn("kind", F.lit(0)))
    return (both.withColumn("text", F.when(F.col("kind") == 1, F.col("text").cast("binary"))).repartition("conv")
            .sortWithinPartitions(F.col("conv").asc_nulls_first(), "kind", F.col("turn").asc_nulls_first(), "role", "digest"))


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(id, Conversation, iterator of its (turn, role, text) rows); the iterator must be used up before the next one."""
    rows = batches_of(batches, "conv", "kind", "turn", "role", "digest", "blank", "ended", "present", "text")
    ahead = next(rows, None)
    while ahead is not None:
        conv = ahead[0]

        def part(kind):
            nonlocal ahead
            while ahead is not None and ahead[0] == conv and ahead[1] == kind:
                now, ahead = ahead, next(rows, None)
                yield now

        found = Conversation((turn, role, digest, blank, ended) for _, _, turn, role, digest, blank, ended, present, _ in part(0) if present)
        texts = part(1)
        yield conv, found, ((turn, role, text) for _, _, turn, role, _, _, _, _, text in texts)
        for _ in texts:
            pass


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           present_col: str | None = None) -> DataFrame:
    """The repaired rows: conv_id, place (from 1), turn (null if inserted), edit (K, R or I), role, text."""
    schema = "conv_id bigint, place bigint, turn bigint, edit string, role string, text string"
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for conv, found, texts in _conversations(batches):
            for place, (turn, edit, role, text) in enumerate(repaired(found.audit, texts), 1):
                out.append((conv, place, turn, edit, role, text.decode() if edit != "I" else text))
                size += 64 + len(text)
                if size > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return _stream(rows, conv_col, turn_col, role_col, text_col, present_col).mapInArrow(run, schema)


def audits(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           present_col: str | None = None) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 (of ``repair``'s rows)."""
    schema = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
              "audit string, repaired_sha256 string")
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv, found, texts in _conversations(batches):
            digest = hashlib.sha256()
            for place, (_, edit, role, text) in enumerate(repaired(found.audit, texts)):
                digest.update(b"\n" * (place > 0) + role.encode() + b":")
                digest.update(text if edit != "I" else b"")
            out.append((conv, *found.summary(), digest.hexdigest()))
            if len(out) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return _stream(rows, conv_col, turn_col, role_col, text_col, present_col).mapInArrow(run, schema)


def oracle() -> str:
    """DuckDB SQL on ``conversations``: damage, then the least (cost, audit) per state, row by row."""
    bits = "list_reduce(list_concat([CAST(c AS BIGINT)], range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)"
    white = r"\x20\x09-\x0D"
    return rf"""
WITH RECURSIVE crc(t) AS (SELECT list_transform(range(256), lambda c: {bits})),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
      coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s FROM conversations),
kinds AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
      list_transform(string_split(s, ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS k FROM keyed, crc),
hurt AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
      CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
      unnest(CASE WHEN k = 3 THEN [1, 2] ELSE [1] END) AS time FROM kinds WHERE k <> 0),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, h, time) AS pos,
      row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, time) > 1 AS again
      FROM (SELECT *, md5(length(role) || ':' || role || ':' || text) AS h FROM hurt) x),
f AS (SELECT conv_id, turn, pos, role, text, left(role, 1) AS i, CASE WHEN NOT regexp_matches(text, '[^{white}]') THEN 'b' WHEN again THEN 'd'
      WHEN NOT regexp_matches(text, '[.!?][{white}]*\z') THEN 't' ELSE '' END AS fault FROM ordered),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'b') AS blank,
      count_if(fault = 'd') AS duplicate, count_if(fault = 't') AS truncated, count_if(j NOT IN ('su', 'ua', 'au')) AS illegal
      FROM (SELECT *, lag(i) OVER (PARTITION BY conv_id ORDER BY pos) || i AS j FROM f) x GROUP BY conv_id),
ins(q, q1, c, e, l) AS (VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
      (0, 2, 5, 'I', chr(10) || 'user:'), (1, 2, 5, 'I', chr(10) || 'user:'), (3, 2, 5, 'I', chr(10) || 'user:'), (2, 3, 5, 'I', chr(10) || 'assistant:'),
      (0, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
      (3, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (2, 2, 10, 'II', chr(10) || 'assistant:' || chr(10) || 'user:')),
mv(q1, e, i, q2, c) AS (VALUES (0, 'D', '', 0, 2), (1, 'D', '', 1, 2), (2, 'D', '', 2, 2), (3, 'D', '', 3, 2), (0, 'K', 's', 1, 0), (0, 'K', 'u', 2, 0),
      (1, 'K', 'u', 2, 0), (2, 'K', 'a', 3, 0), (3, 'K', 'u', 2, 0), (0, 'R', '', 2, 1), (1, 'R', '', 2, 1), (2, 'R', '', 3, 1), (3, 'R', '', 2, 1)),
st AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS pos, 0 AS q, struct_pack(c := 0, a := '', d := '') AS s FROM f
    UNION ALL SELECT conv_id, pos, q, min(s) AS s FROM (
      SELECT st.conv_id, f.pos, mv.q2 AS q, struct_pack(c := st.s.c + ins.c + mv.c + CASE WHEN fault = 't' AND mv.e <> 'D' THEN 5 ELSE 0 END,
          a := st.s.a || ins.e || mv.e, d := st.s.d || ins.l || CASE mv.e WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || role || ':' || text
          ELSE chr(10) || CASE WHEN mv.q2 = 2 THEN 'user:' ELSE 'assistant:' END || text END) AS s
      FROM st JOIN f ON f.conv_id IS NOT DISTINCT FROM st.conv_id AND f.pos = st.pos + 1 JOIN ins ON ins.q = st.q JOIN mv ON mv.q1 = ins.q1
      WHERE (mv.e <> 'K' OR f.i = mv.i) AND (mv.e = 'D' OR fault NOT IN ('b', 'd'))) x GROUP BY conv_id, pos, q),
done AS (SELECT st.conv_id, min(struct_pack(c := st.s.c + ins.c, a := st.s.a || ins.e, d := st.s.d || ins.l)) AS s
      FROM st JOIN (SELECT conv_id, max(pos) AS n FROM f GROUP BY conv_id) z ON z.conv_id IS NOT DISTINCT FROM st.conv_id AND z.n = st.pos
      JOIN ins ON ins.q = st.q WHERE ins.q1 IN (0, 3) GROUP BY st.conv_id)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
    CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(done.s.c, 0) AS BIGINT) AS cost, coalesce(done.s.a, '') AS audit,
    sha256(coalesce(substr(done.s.d, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM o.conv_id"""
