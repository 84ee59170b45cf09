"""Operator 11, conversation structure repair by Knuth's lightest derivation.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``.  An item ``[i, q]`` says that the
first ``i`` rows have been edited into a sequence that leaves the pattern in state ``q``; its weight is the pair
(cost, audit), the audit being the initials of the edits made so far.  Deductions lead from an item to the next
one by Keep, Rerole or Delete of row ``i``, or to ``[i, q']`` by an Insert.  They add to the cost and append to the audit, so no
conclusion is lighter than its premise and a lighter premise never gives a heavier conclusion: the functions are superior and monotone, and
an item is final when the agenda first pops it.  The first goal item popped is the cheapest repair, and among those
the one whose audit is least in ASCII order.

Rows are put in order once, by ranges of (conversation, turn, role, text), and numbered; equal rows are one row with a
count before that.  A conversation is then a sorted stream of small codes, ``BLOCK`` of which are on the agenda at a time: the
four items at the end of a block are the axioms of the next, with audits shortened to what still
tells them apart.  A second stream applies the audit to the texts.  Memory so grows with the audit alone, which is a single value
of the result; no group of rows is collected, and a conversation of any length is read batch by batch.

Defined results: a null conversation id is one conversation; a null role or text counts as one blank; null turns
come first; rows of one turn are ordered by role and text; a conversation without rows has cost 0, an empty
audit and the hash of the empty text; an empty table gives no rows.  Other columns of the input, whatever their names, are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import BLANK, WORD_CHARACTER, kept, register, table

#: Rows of one conversation on the agenda at a time.
BLOCK = 128
#: Costs of the edits; a truncated row that stays adds ``STAYS``.
RETYPE, DELETE, INSERT, STAYS = 1, 2, 5, 5
S, U, A, OTHER = range(4)
FINE, IS_BLANK, IS_DUPLICATE, IS_TRUNCATED = range(4)
_ROLES = {U: "user", A: "assistant"}
#: State after a role, by state: nothing yet, after s, after u, after a.
_AFTER = [{S: 1, U: 2}, {U: 2}, {A: 3}, {U: 2}]
_GOAL = (0, 3)


def _deductions(q: int, code: int) -> list[tuple[int, str, int]]:
    role, fault = divmod(code, 4)
    out = [(DELETE, "D", q)]
    if fault in (IS_BLANK, IS_DUPLICATE):
        return out
    more = STAYS if fault == IS_TRUNCATED else 0
    out += [(more, "K", _AFTER[q][role])] if role in _AFTER[q] else []
    return out + [(RETYPE + more, "R", to) for r, to in _AFTER[q].items() if r in _ROLES and r != role]


_BY_ROW = [[_deductions(q, code) for code in range(16)] for q in range(4)]
_BY_INSERT = [[to for r, to in _AFTER[q].items() if r in _ROLES] for q in range(4)]


def shortened(audits: list[str]) -> dict[str, str]:
    """Short names that compare as the audits do, whatever is appended to them."""
    names: dict[str, str] = {}

    def name(group: list[str], start: int, said: str) -> None:
        if len(group) == 1:
            names[group[0]] = said
            return
        shared = start + len(commonprefix([group[0][start:], group[-1][start:]]))
        if len(group[0]) == shared:  # the others go on where this one ends: what is appended decides
            names.update({a: said + a[shared:] for a in group})
            return
        for ch in sorted({a[shared] for a in group}):
            name([a for a in group if a[shared] == ch], shared, said + ch)

    name(sorted(set(audits)), 0, "")
    return names


class Agenda:
    """The lightest derivation of one conversation, fed row by row."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.axioms: list[tuple[int, str, int, tuple]] = [(0, "", 0, ())]  # cost, short audit, state, pieces of the audit
        self.codes: list[int] = []
        self.extra: list[int] = []

    def add(self, code: int, copies: int) -> None:
        """A row and, right after it, ``copies - 1`` equal ones, which have to go."""
        if len(self.codes) == self.block:
            final = self._run(False)
            names = shortened([audit for _, audit, *_ in final])
            self.axioms = [(cost, names[audit], q, chain) for cost, audit, q, chain in final]
            self.codes, self.extra = [], []
        self.codes.append(code)
        self.extra.append(copies - 1)

    def goal(self) -> tuple[int, str]:
        cost, _, _, chain = self._run(True)[0]
        pieces = []
        while chain:
            chain, piece = chain
            pieces.append(piece)
        return cost, "".join(reversed(pieces))

    def _run(self, last: bool) -> list[tuple[int, str, int, tuple]]:
        n, codes, extra, axioms = len(self.codes), self.codes, self.extra, self.axioms
        agenda = [(cost, audit, 0, q, k) for k, (cost, audit, q, _) in enumerate(axioms)]
        heapify(agenda)
        done, ends = set(), []
        while agenda:
            cost, audit, i, q, k = heappop(agenda)
            if (i, q) in done:
                continue
            done.add((i, q))
            if i == n:
                if not last or q in _GOAL:
                    ends.append((cost, audit, q, (axioms[k][3], self._piece(audit[len(axioms[k][1]):]))))
                    if last:
                        break
                    continue  # inserts at the end of a block are made at the start of the next
            else:
                more = DELETE * extra[i]
                for c, ch, to in _BY_ROW[q][codes[i]]:
                    heappush(agenda, (cost + c + more, audit + ch, i + 1, to, k))
            for to in _BY_INSERT[q]:
                heappush(agenda, (cost + INSERT, audit + "I", i, to, k))
        return ends

    def _piece(self, audit: str) -> str:
        if not any(self.extra):
            return audit
        rows = iter(self.extra)
        return "".join(ch if ch == "I" else ch + "D" * next(rows) for ch in audit)


_FOUND = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def derived(batches: Iterator[pa.RecordBatch], block: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """From rows (conversation, place, turn, code, copies) in order, each conversation led by a row without code: faults and repair."""
    conv, agenda, turns, counts, before = None, None, None, None, None

    def found() -> tuple:
        lo, hi, distinct = turns
        cost, audit = agenda.goal()
        return conv, hi - lo + 1 - distinct if distinct else 0, counts[IS_BLANK], counts[IS_DUPLICATE], counts[IS_TRUNCATED], counts[FINE], cost, audit

    for b in batches:
        out = []
        for c, _, turn, code, copies in zip(*[x.to_pylist() for x in b.columns], strict=True):
            if code is None:
                if agenda is not None:
                    out.append(found())
                conv, agenda, turns, counts, before = c, Agenda(block), [None, None, 0], [0, 0, 0, 0], None
                continue
            role, fault = divmod(code, 4)
            agenda.add(code, copies)
            counts[fault] += fault != FINE
            counts[IS_BLANK if fault == IS_BLANK else IS_DUPLICATE] += copies - 1
            # adjacent roles that do not follow each other, counted in the place that FINE leaves free
            counts[FINE] += copies - 1 + (before is not None and (before, role) not in ((S, U), (U, A), (A, U)))
            before = role
            if turn is not None and turn != turns[1]:
                turns[0], turns[1], turns[2] = turn if turns[0] is None else turns[0], turn, turns[2] + 1
        if out:
            yield _batch(out, b.schema.field(0).type)
    if agenda is not None:
        yield _batch([found()], b.schema.field(0).type)


def _batch(rows: list[tuple], first: pa.DataType) -> pa.RecordBatch:
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    kinds = [first] + [pa.int64()] * 6 + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """From rows (conversation, place, role, text, copies) in order, each conversation led by its audit as text:
    (conversation, edit, role, text) of the rows that stay or come in, and (conversation, None, None, None) ahead of each conversation."""
    conv, audit, at, q = None, "", 0, 0

    def inserts() -> Iterator[tuple]:
        nonlocal at, q
        while at < len(audit) and audit[at] == "I":
            role = A if q == 2 else U
            at, q = at + 1, _AFTER[q][role]
            yield conv, "I", _ROLES[role], ""

    for b in batches:
        for c, place, role, text, copies in zip(*[x.to_pylist() for x in b.columns[:5]], strict=True):
            if place < 0:
                yield from inserts()
                conv, audit, at, q = c, text, 0, 0
                yield c, None, None, None
                continue
            yield from inserts()
            edit, at = audit[at], at + copies
            if edit == "D":
                continue
            kind = {"s": S, "u": U, "a": A}[role[0]] if edit == "K" else A if q == 2 else U
            q = _AFTER[q][kind]
            yield conv, edit, role if edit == "K" else _ROLES[kind], text
    yield from inserts()


class Repair:
    """Conversations of a table brought into order: their faults, their edits, the repaired rows."""

    def __init__(self, rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 copies: Column | None = None, conversations: DataFrame | None = None, block: int = BLOCK):
        """``copies`` says how often a row stands there, ``conversations`` names those that have to be in the result."""
        self.conv, self.block = conv, block
        own = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(role, F.lit(" ")).alias("role"),
                          F.coalesce(text, F.lit(" ")).alias("text"), (F.lit(1) if copies is None else copies).cast("long").alias("copies"))
        ids = own.select("conv") if conversations is None else conversations.select(F.col(conv).alias("conv"))
        order = ["conv", "turn", "role", "text"]
        grouped = kept(own.groupBy(*order).agg(F.sum("copies").alias("copies")))
        initial = F.substring("role", 1, 1)
        kind = F.when(initial == "s", S).when(initial == "u", U).when(initial == "a", A).otherwise(OTHER)
        #: every different row with its place in the order of its conversation
        self.rows = kept(grouped.repartitionByRange(*order).sortWithinPartitions(*order).select(
            "conv", F.monotonically_increasing_id().alias("place"), "turn", "role", "text", "copies", kind.alias("kind"),
            (~F.col("text").rlike(WORD_CHARACTER)).alias("blank"), (~F.col("text").rlike(rf"[.!?]{BLANK}*\z")).alias("open")))
        light = self.rows.select("conv", "place", "turn", "kind", "blank", "open", "copies", "role", F.sha2("text", 256).alias("body"),
                                 F.coalesce(F.col("conv").cast("string"), F.lit("")).alias("c"))
        again = (light.where("not blank").groupBy("c", "role", "body").agg(F.min("place").alias("first"), F.count("*").alias("n"))
                 .where("n > 1").drop("n"))
        fault = (F.when(F.col("blank"), IS_BLANK).when(F.col("place") > F.col("first"), IS_DUPLICATE)
                 .when(F.col("open"), IS_TRUNCATED).otherwise(FINE))
        coded = light.join(again, ["c", "role", "body"], "left").select(
            "conv", "place", "turn", (F.col("kind") * 4 + fault).alias("code"), "copies")
        heads = ids.distinct().select("conv", F.lit(-1).cast("long").alias("place"), F.lit(None).cast("long").alias("turn"),
                                      F.lit(None).cast("int").alias("code"), F.lit(0).cast("long").alias("copies"))
        self.kind = rows.schema[conv].dataType.simpleString()
        self.found = kept(self._in_order(heads.unionByName(coded)).mapInArrow(lambda it: derived(it, block), f"conv {self.kind}, {_FOUND}"))

    def _in_order(self, df: DataFrame) -> DataFrame:
        return df.repartition("conv").sortWithinPartitions("conv", "place")

    def _with_audits(self) -> DataFrame:
        heads = self.found.select("conv", F.lit(-1).cast("long").alias("place"), F.lit(None).cast("string").alias("role"),
                                  F.col("audit").alias("text"), F.lit(0).cast("long").alias("copies"))
        return self._in_order(heads.unionByName(self.rows.select("conv", "place", "role", "text", "copies")))

    def faults(self) -> DataFrame:
        """One row a conversation: gaps, faults, cost and audit of its repair."""
        return self.found.withColumnRenamed("conv", self.conv)

    def repaired(self) -> DataFrame:
        """The repaired conversations: (conversation, position from 0, role, text, edit), an edit being K, R or I."""
        conv = self.conv

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out, size, position, first = [], 0, 0, None

            def seen(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                nonlocal first
                for b in it:
                    first = b.schema.field(0).type
                    yield b

            def batch() -> pa.RecordBatch:
                kinds = [first, pa.int64(), pa.string(), pa.string(), pa.string()]
                return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                                  [conv, "position", "role", "text", "edit"])

            for c, edit, role, text in edited(seen(batches)):
                if edit is None:
                    position = 0
                    continue
                out.append((c, position, role, text, edit))
                position, size = position + 1, size + len(text) + 64
                if size > 4 << 20:
                    yield batch()
                    out, size = [], 0
            if out:
                yield batch()

        return self._with_audits().mapInArrow(rows, f"`{conv}` {self.kind}, position bigint, role string, text string, edit string")

    def digests(self) -> DataFrame:
        """``faults`` with ``repaired_sha256``: the repaired ``role:text``, newline-joined, hashed as it streams by."""
        heads = self.found.select(
            "conv", F.lit(-1).cast("long").alias("place"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"),
            F.lit(0).cast("long").alias("copies"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
        numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
        all_rows = heads.unionByName(self.rows.select("conv", "place", "role", "text", "copies"), allowMissingColumns=True)

        def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            waiting: list[tuple] = []  # heads not yet given out
            kinds = None

            def watched(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                nonlocal kinds
                for b in it:
                    kinds = [b.schema.field(0).type] + [pa.int64()] * 6 + [pa.string()] * 2
                    places = b.column(1).to_pylist()
                    lead = [i for i, p in enumerate(places) if p < 0]
                    waiting.extend(zip(*[b.column(j).take(pa.array(lead, pa.int32())).to_pylist() for j in (0, 5, 6, 7, 8, 9, 10, 3)], strict=True))
                    yield b

            out, sha, empty = [], None, True

            def batch() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                                  ["conv", *numbers, "audit", "repaired_sha256"])

            for _, edit, role, text in edited(watched(batches)):
                if edit is None:
                    if sha is not None:
                        out.append((*waiting.pop(0), sha.hexdigest()))
                    if len(out) >= 4096:
                        yield batch()
                        out = []
                    sha, empty = hashlib.sha256(), True
                    continue
                sha.update((f"{role}:{text}" if empty else f"\n{role}:{text}").encode())
                empty = False
            if sha is not None:
                out.append((*waiting.pop(0), sha.hexdigest()))
                yield batch()

        schema = f"conv {self.kind}, " + ", ".join(f"{n} bigint" for n in numbers) + ", audit string, repaired_sha256 string"
        return self._in_order(all_rows).mapInArrow(hashed, schema).withColumnRenamed("conv", self.conv)


def damaged(rows: DataFrame) -> DataFrame:
    """A table of conversations damaged by the hash of conversation and turn: (conv_id, turn, role, text, copies)."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    lot = F.crc32(F.concat(said[0], F.lit(":"), said[1]).cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return rows.select(
        "conv_id", "turn", F.when(lot == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(lot == 1, "").when(lot == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(lot == 3, 2).otherwise(1).alias("copies"), lot.alias("lot")).where("lot <> 0").drop("lot")


# The same by dynamic programming: per conversation a fold over its rows of the best (cost, audit) of each state.
_ORACLE = """
WITH said AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
lots AS (SELECT *, xor(list_reduce(list_transform(string_split(name, ''), lambda ch: ascii(ch)::BIGINT),
  lambda crc, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, b)), 4294967295::BIGINT), 4294967295) % 20 AS lot FROM said),
hurt AS (SELECT conv_id, turn, CASE WHEN lot = 4 THEN 'user' ELSE role END AS role,
  CASE lot WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE lot WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM lots),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place FROM hurt),
judged AS (SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) || left(role, 1) AS pair,
  CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM placed),
folded AS (SELECT conv_id, list_reduce(list({'initial': initial, 'fault': fault} ORDER BY place), lambda z, r: CASE WHEN r.fault IN ('blank', 'duplicate') THEN
  {'q0': {'c': z.q0.c + 2, 'a': z.q0.a || 'D'}, 'q1': {'c': z.q1.c + 2, 'a': z.q1.a || 'D'}, 'q2': {'c': z.q2.c + 2, 'a': z.q2.a || 'D'}, 'q3': {'c': z.q3.c + 2, 'a': z.q3.a || 'D'}} ELSE
  list_transform([list_min([z.q2, {'c': z.q0.c + 5, 'a': z.q0.a || 'I'}, {'c': z.q1.c + 5, 'a': z.q1.a || 'I'}, {'c': z.q3.c + 5, 'a': z.q3.a || 'I'}])], lambda u:
  list_transform([list_min([z.q3, {'c': u.c + 5, 'a': u.a || 'I'}])], lambda w:
  list_transform([CASE r.fault WHEN 'truncated' THEN 5 ELSE 0 END], lambda t: {
    'q0': {'c': z.q0.c + 2, 'a': z.q0.a || 'D'},
    'q1': list_min([{'c': z.q1.c + 2, 'a': z.q1.a || 'D'}, CASE r.initial WHEN 's' THEN {'c': z.q0.c + t, 'a': z.q0.a || 'K'} END]),
    'q2': list_min([{'c': u.c + 2, 'a': u.a || 'D'}] || list_transform([z.q0, z.q1, w], lambda o:
      {'c': o.c + t + CASE r.initial WHEN 'u' THEN 0 ELSE 1 END, 'a': o.a || CASE r.initial WHEN 'u' THEN 'K' ELSE 'R' END})),
    'q3': list_min([{'c': w.c + 2, 'a': w.a || 'D'}, {'c': u.c + t + CASE r.initial WHEN 'a' THEN 0 ELSE 1 END, 'a': u.a || CASE r.initial WHEN 'a' THEN 'K' ELSE 'R' END}])})[1])[1])[1] END,
  {'q0': {'c': 0::BIGINT, 'a': ''}, 'q1': {'c': 1000000000::BIGINT, 'a': ''}, 'q2': {'c': 1000000000::BIGINT, 'a': ''}, 'q3': {'c': 1000000000::BIGINT, 'a': ''}}) AS z FROM judged GROUP BY conv_id),
ended AS (SELECT conv_id, list_min([z.q0, z.q3, {'c': list_min([z.q2, {'c': z.q0.c + 5, 'a': z.q0.a || 'I'}, {'c': z.q1.c + 5, 'a': z.q1.a || 'I'}]).c + 5,
  'a': list_min([z.q2, {'c': z.q0.c + 5, 'a': z.q0.a || 'I'}, {'c': z.q1.c + 5, 'a': z.q1.a || 'I'}]).a || 'I'}]) AS best FROM folded),
steps AS (SELECT conv_id, unnest(string_split(best.a, '')) AS edit, unnest(range(len(best.a))) AS spot FROM ended WHERE best.a <> ''),
counted AS (SELECT *, CASE WHEN edit <> 'I' THEN count(CASE WHEN edit <> 'I' THEN 1 END) OVER w END AS place, count(CASE WHEN edit <> 'D' THEN 1 END) OVER w AS nth FROM steps WINDOW w AS (PARTITION BY conv_id ORDER BY spot)),
lined AS (SELECT c.*, j.role, j.text, max(CASE WHEN nth = 1 AND edit = 'K' AND j.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY c.conv_id) AS has_system
  FROM counted c LEFT JOIN judged j ON c.conv_id IS NOT DISTINCT FROM j.conv_id AND c.place = j.place),
texts AS (SELECT conv_id, string_agg(CASE edit WHEN 'K' THEN role ELSE CASE (nth - has_system) % 2 WHEN 1 THEN 'user' ELSE 'assistant' END END || ':' || CASE edit WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY nth) AS text
  FROM lined WHERE edit <> 'D' GROUP BY conv_id),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
  count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE place > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(t.text, '')) AS repaired_sha256
FROM ids i LEFT JOIN counts c ON i.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ended e ON i.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN texts t ON i.conv_id IS NOT DISTINCT FROM t.conv_id"""


@register("op11_lightest_derivation", _ORACLE)
def op11_lightest_derivation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return Repair(damaged(rows), copies=F.col("copies"), conversations=rows).digests()
