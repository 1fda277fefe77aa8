"""Conversation repair: the cheapest edits after which a conversation's roles follow the grammar.

The initials of the roles must read ``(s?(ua)+)?``: nothing, or turns of user
and assistant after at most one of the system. A row is kept, given the role
user or assistant, or deleted; rows without text may be inserted. Blank rows
and repetitions must go, and a truncated row that stays costs extra. Of the
cheapest edits those whose initials (Keep, Rerole, Delete, Insert) come first
in ASCII order are taken.

A row's role and fault are one letter, and a conversation's letters are its
signature. Signatures are sorted from their ends over the whole table, so those
that share a suffix are neighbours, whichever conversations they come from. The
automaton of a task walks them in that order: a suffix is one node, made once;
for each node and state of the grammar it holds the cost to the end, the first
edit of the best audit and hence, along the nodes, the audit itself. (A suffix
that spans two tasks is made in both.) Equal signatures are spread over tasks
by their conversation ids.

Rows of a conversation are in the order of their turns, nulls first; rows of
one turn by role, SHA-256 of the text, and a copy after its original. Only one
conversation's letters, not its texts, are held in memory. Null roles and
texts are one space; a null id is a conversation of its own. A role is told by
its first character; others than s, u and a can't be kept, nor can an empty
role. Empty tables give empty results, very long texts are handled whole, and
other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm.common import as_bytes, map_rows, table, written

BLANKS = " \t\n\x0b\x0c\r"
#: States of the grammar: nothing yet, after the system, after a user, after an assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: The state that a role leads to; others are not allowed there.
STEPS = {"s": {EMPTY: SYSTEM}, "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
TURN = [USER, USER, ASSISTANT, USER]  # the user or assistant that may follow a state
ENDS = (EMPTY, ASSISTANT)
NEVER = 1 << 60


@dataclass(frozen=True)
class Costs:
    """Costs of the edits, above 0 for an insertion, and of a truncated row that stays."""
    keep: int = 0
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


class SuffixAutomaton:
    """Costs and audits of signatures that come sorted from their ends.

    Letters are s, u, a and o (any other role), capital where the row is
    truncated, and x for a row that must go. The nodes of the last signature's
    suffixes are held, by length; a new signature keeps those it shares.
    """

    def __init__(self, costs: Costs = Costs()):
        self.price = costs
        self.letters = bytearray()
        self.costs = array("q")  # four a node
        self.edits = bytearray()
        self.made = 0
        self.known: dict[tuple, tuple] = {}
        self._add(None, [0 if g in ENDS else NEVER for g in range(4)], b"    ")

    def _add(self, letter: int | None, costs: list[int], edits: bytes) -> None:
        """Add a node, after the best insertions before it."""
        costs, edits = list(costs), bytearray(edits)
        for _ in range(3):  # insertions alternate, so a third one in a row comes back to a state that was cheaper
            for g in range(4):
                offer = min(NEVER, costs[TURN[g]] + self.price.insert)
                if (offer, ord("I")) < (costs[g], edits[g]):
                    costs[g], edits[g] = offer, ord("I")
        if letter is not None:
            self.letters.append(letter)
        self.costs.extend(costs)
        self.edits += edits
        self.made += 1

    def _options(self, letter: int, after: list[int]) -> tuple[list[int], bytes]:
        """Cost and first edit of every state before a row, from the costs after it."""
        name, c = chr(letter), self.price
        out = []
        for g in range(4):
            options = [(after[g] + c.delete, ord("D"))]
            if name != "x":
                extra = c.truncated if name.isupper() else 0
                to = STEPS.get(name.lower(), {}).get(g)
                if to is not None:
                    options.append((after[to] + c.keep + extra, ord("K")))
                options.append((after[TURN[g]] + c.rerole + extra, ord("R")))
            out.append(min((min(cost, NEVER), edit) for cost, edit in options))
        return [cost for cost, _ in out], bytes(edit for _, edit in out)

    def push(self, ending: bytes) -> None:
        """Go on to the signature that reads ``ending`` from its end."""
        shared = 0
        for shared, (x, y) in enumerate(zip(self.letters, ending)):
            if x != y:
                break
        else:
            shared = min(len(self.letters), len(ending))
        del self.letters[shared:], self.costs[4 * (shared + 1):], self.edits[4 * (shared + 1):]
        for letter in ending[shared:]:
            after = self.costs[-4:].tolist()
            low = min(after)
            key = (letter, *[min(x - low, NEVER) if x < NEVER else NEVER for x in after])
            if key not in self.known:  # the same differences lead to the same edits
                self.known[key] = self._options(letter, list(key[1:]))
            costs, edits = self.known[key]
            self._add(letter, [x + low if x < NEVER else NEVER for x in costs], edits)

    def best(self) -> tuple[int, str]:
        """Cost and audit of the signature pushed last."""
        audit, g, node = bytearray(), EMPTY, len(self.letters)
        cost = self.costs[4 * node]
        while node or self.edits[4 * node + g] == ord("I"):
            edit = self.edits[4 * node + g]
            audit.append(edit)
            g, node = step(g, edit, chr(self.letters[node - 1]) if node else ""), node - (edit != ord("I"))
        return cost, audit.decode()


def step(state: int, edit: int, letter: str) -> int:
    """The state of the grammar after an edit (of a row with this letter)."""
    if edit == ord("D"):
        return state
    return STEPS[letter.lower()][state] if edit == ord("K") else TURN[state]


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copy, dropped): rows of (conv_id, turn, role, text) after the damage that
    crc32(``conv_id:turn``) % 20 deals them. Dropped rows stay, marked."""
    def told(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(told("text"), ".!?", "")).otherwise(told("text"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"),
                       F.when(kind == 4, "user").otherwise(told("role")).alias("role"), text.alias("text"),
                       F.explode(copies).alias("copy"), (kind == 0).alias("dropped"))


def _digest(rows: DataFrame) -> DataFrame:
    return rows.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))


def faults(rows: DataFrame) -> DataFrame:
    """Per conversation: conv_id, signature, gaps, blank, duplicate, truncated, illegal.

    ``rows`` are as ``damaged`` returns them. Texts stay where they are: only their digests and flags are shuffled.
    """
    bare = F.rtrim("text", F.lit(BLANKS))
    narrow = _digest(rows).select(
        "conv_id", "turn", "role", "digest", "copy", "dropped", (bare == "").alias("is_blank"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("is_cut"))
    # one shuffle by conversation serves both windows and the walk
    own = narrow.repartition("conv_id")
    same = Window.partitionBy("conv_id", "dropped", "role", "digest").orderBy(F.asc_nulls_first("turn"), "copy")
    marked = own.withColumn("again", F.row_number().over(same) > 1)
    seen = F.when(F.col("is_blank"), "b").when(F.col("again"), "d").when(F.col("is_cut"), "t").otherwise("-")
    ordered = marked.withColumn("fault", seen).sortWithinPartitions(
        F.asc_nulls_first("conv_id"), "dropped", F.asc_nulls_first("turn"), "role", "digest", "copy")
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches):
        current: list = []

        def result() -> dict:
            key, letters, found, turns = current
            low, high, n, _ = turns
            return {"conv_id": [key], "signature": [letters.decode()], "gaps": [high - low + 1 - n if n else 0],
                    **{k: [v] for k, v in found.items()}}

        for b in batches:
            out = []
            for key, dropped, turn, role, fault in zip(*(c.to_pylist() for c in b.columns)):
                if not current or current[0] != key:
                    if current:
                        out.append(result())
                    current = [key, bytearray(), {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}, [0, 0, 0, None]]
                    before = None
                if dropped:
                    continue
                _, letters, found, turns = current
                initial = role[:1]
                if before is not None and before + initial not in ("su", "ua", "au"):
                    found["illegal"] += 1
                before = initial
                if turn is not None and (not turns[2] or turn != turns[3]):
                    turns[:] = [turn if not turns[2] else turns[0], turn, turns[2] + 1, turn]
                letter = initial if initial and initial in "sua" else "o"
                if fault in "bd":
                    found["blank" if fault == "b" else "duplicate"] += 1
                    letter = "x"
                elif fault == "t":
                    found["truncated"] += 1
                    letter = letter.upper()
                letters += letter.encode()
            if out:
                yield {k: [v for x in out for v in x[k]] for k in out[0]}
        if current:
            yield result()

    return map_rows(ordered.select("conv_id", "dropped", "turn", "role", "fault"),
                    f"conv_id {kind}, signature string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint", run)


def audits(found: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """The rows of ``faults`` with cost and audit, by one automaton over the signatures of a task."""
    found = written(found.withColumn("ending", F.reverse("signature")), "signatures")
    ordered = found.repartitionByRange("ending", F.asc_nulls_first("conv_id")).sortWithinPartitions("ending")
    columns = [c for c in found.columns if c != "ending"]
    schema = ", ".join(f"{c} {found.schema[c].dataType.simpleString()}" for c in columns) + ", cost bigint, audit string"

    def run(batches):
        automaton = SuffixAutomaton(costs)
        last, best = b"", (0, "")
        for b in batches:
            results = []
            for ending in as_bytes(b.column(len(columns))):
                if ending != last:
                    automaton.push(ending)
                    last, best = ending, automaton.best()
                results.append(best)
            yield {**{c: b.column(k) for k, c in enumerate(columns)},
                   "cost": [c for c, _ in results], "audit": [a for _, a in results]}

    return map_rows(ordered.select(*columns, "ending"), schema, run)


def repaired(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """(conv_id, at, turn, role, text, edit): rows that stay or are inserted, by place from 0, in order; and one row
    for each conversation before them (at -1, all else null).

    The rows of a conversation are in one partition, in their order.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    all_rows = _digest(rows.where(~F.col("dropped"))).select(*[F.col(c) for c in ("conv_id", "turn", "role", "text", "digest", "copy")],
                                                             F.lit(None).cast("string").alias("audit"))
    plans = audited.select("conv_id", *[F.lit(None).cast(t).alias(c) for c, t in
                                        (("turn", "bigint"), ("role", "string"), ("text", "string"), ("digest", "string"), ("copy", "int"))], "audit")
    ordered = all_rows.unionByName(plans).repartition("conv_id").sortWithinPartitions(
        F.asc_nulls_first("conv_id"), F.col("audit").isNull(), F.asc_nulls_first("turn"), "role", "digest", "copy")

    def run(batches):
        key, audit, place, at, state, asked = None, "", 0, 0, EMPTY, False

        def inserted(out: list) -> None:
            nonlocal place, at, state
            while place < len(audit) and audit[place] == "I":
                state = TURN[state]
                out.append((key, at, None, ROLES[state], "", "I"))
                place, at = place + 1, at + 1

        for b in batches:
            out: list[tuple] = []
            for conv_id, turn, role, text, plan in zip(*(c.to_pylist() for c in b.columns)):
                if plan is not None:
                    key, audit, place, at, state = conv_id, plan, 0, 0, EMPTY
                    out.append((key, -1, None, None, None, None))
                    inserted(out)
                    continue
                edit = audit[place]
                place += 1
                if edit != "D":
                    state = STEPS[role[0]][state] if edit == "K" else TURN[state]
                    out.append((key, at, turn, role if edit == "K" else ROLES[state], text, edit))
                    at += 1
                inserted(out)
            if out:
                yield dict(zip(("conv_id", "at", "turn", "role", "text", "edit"), map(list, zip(*out))))

    return map_rows(ordered.select("conv_id", "turn", "role", "text", "audit"),
                    f"conv_id {kind}, at bigint, turn bigint, role string, text string, edit string", run)


def digests(ordered: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) from ``repaired``: of ``role:text`` of the rows in order, joined by newlines."""
    kind = ordered.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]):
        key, digest, any_yet = None, None, False
        for b in batches:
            out = []
            for conv_id, at, role, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), *(as_bytes(b.column(k)) for k in (2, 3))):
                if at < 0:
                    if any_yet:
                        out.append((key, digest.hexdigest()))
                    key, digest, any_yet = conv_id, hashlib.sha256(), True
                    continue
                digest.update((b"\n" if at else b"") + role + b":" + text)
            if out:
                yield {"conv_id": [k for k, _ in out], "repaired_sha256": [d for _, d in out]}
        if any_yet:
            yield {"conv_id": [key], "repaired_sha256": [digest.hexdigest()]}

    return map_rows(ordered.select("conv_id", "at", "role", "text"), f"conv_id {kind}, repaired_sha256 string", run)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(table(spark, sf_dir, "conversations"))
    audited = written(audits(faults(rows)), "audits")
    sums = digests(repaired(rows, audited)).withColumnRenamed("conv_id", "own")
    return audited.join(sums, F.col("conv_id").eqNullSafe(F.col("own"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _sql() -> str:
    """The same in SQL: costs and audits by recursion from the end of each conversation. A state's cost (nine digits)
    and audit are one string, so the lesser string is the better one."""
    never = "'999999999'"

    def then(edit: str, cost: str, after: str) -> str:
        return (f"CASE WHEN {after} = {never} THEN {never} ELSE "
                f"lpad((substr({after}, 1, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || '{edit}' || substr({after}, 10) END")

    extra = "(CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END)"
    after = {"e": "e", "s": "s", "u": "u", "a": "a"}
    turn = {"e": "u", "s": "u", "u": "a", "a": "u"}
    keep = {"e": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    def row(g: str) -> str:
        kept = " ".join(f"WHEN first = '{i}' THEN {then('K', extra, 'w.' + after[t])}" for i, t in keep[g].items())
        return (f"least({then('D', '2', 'w.' + after[g])}, CASE WHEN fault IN ('blank', 'duplicate') THEN {never} "
                f"ELSE least({then('R', '1 + ' + extra, 'w.' + after[turn[g]])}, CASE {kept} ELSE {never} END) END)")

    def inserted(g: str, rounds: int = 2) -> str:
        return f"o{g}" if not rounds else f"least(o{g}, {then('I', '5', '(' + inserted(turn[g], rounds - 1) + ')')})"

    crc = "list_reduce(list_prepend(x, range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))"
    return f"""
WITH RECURSIVE told AS (
  SELECT row_number() OVER () AS r, conv_id, turn::BIGINT AS turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
  FROM conversations),
hashed AS (
  SELECT * EXCLUDE (key), xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda k: ascii(k)::BIGINT)),
      lambda h, k: {crc.replace("list_prepend(x", "list_prepend(xor(h, k)")})) % 20 AS kind
  FROM told),
hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM hashed WHERE kind <> 0),
placed AS (
  SELECT conv_id, turn, role, text, substr(role, 1, 1) AS first,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS n,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM hurt),
faulty AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id) AS c, count(*) OVER (PARTITION BY conv_id) AS size,
         lag(first) OVER (PARTITION BY conv_id ORDER BY n) AS earlier,
         CASE WHEN bare = '' THEN 'blank' WHEN again THEN 'duplicate'
              WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
walk AS (
  SELECT DISTINCT c, size + 1 AS n, '000000000' AS e, '000000010II' AS s, '000000005I' AS u, '000000000' AS a FROM faulty
  UNION ALL
  SELECT c, n, {inserted("e")}, {inserted("s")}, {inserted("u")}, {inserted("a")}
  FROM (SELECT f.c, f.n, {row("e")} AS oe, {row("s")} AS os, {row("u")} AS ou, {row("a")} AS oa
        FROM walk w JOIN faulty f ON f.c = w.c AND f.n = w.n - 1)),
audited AS (SELECT c, substr(e, 1, 9)::BIGINT AS cost, substr(e, 10) AS audit FROM walk WHERE n = 1),
edits AS (
  SELECT c, unnest(string_split(audit, '')) AS edit, unnest(range(1, length(audit) + 1)) AS k FROM audited WHERE audit <> ''),
at_row AS (SELECT *, count_if(edit <> 'I') OVER (PARTITION BY c ORDER BY k) AS n FROM edits),
stays AS (
  SELECT x.c, k, edit, role, text, row_number() OVER (PARTITION BY x.c ORDER BY k) - 1 AS j,
         bool_or(edit = 'K' AND first = 's') OVER (PARTITION BY x.c) AS system
  FROM at_row x LEFT JOIN faulty f ON f.c = x.c AND f.n = x.n AND edit <> 'I' WHERE edit <> 'D'),
texts AS (
  SELECT c, string_agg(CASE WHEN edit = 'K' THEN role WHEN (j - system::INTEGER) % 2 = 0 THEN 'user' ELSE 'assistant' END
                       || ':' || coalesce(text, ''), chr(10) ORDER BY k) AS whole
  FROM stays GROUP BY c),
counted AS (
  SELECT c, any_value(conv_id) AS own, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count_if(fault = 'blank') AS blank, count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated,
         count_if(n > 1 AND earlier || first NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY c)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted k ON k.own IS NOT DISTINCT FROM o.conv_id LEFT JOIN audited USING (c) LEFT JOIN texts USING (c)
"""


OP12_SQL = _sql()
