"""Conversation structure repair by iterative-deepening A*.

The turns of a conversation are kept (K), given another role (R), deleted (D), and turns are inserted (I) until the roles read ``(s?(ua)+)?``. Each edit has its cost; wanted are the cheapest edits, of these
the first in ASCII order. Depth-first search tries edits in that order under a bound on the cost and raises the bound by one until a path is accepted, which is then the answer; places that have
failed with some budget left are held in a transposition table, together with what remains to be paid in any case.

Turns with a fault that must go and repeated turns are found before, by grouping and joins; equal rows of a turn are one row with a count. Rows are dealt to tasks by ranges of (conversation, turn), so a long
conversation is many tasks. One that lies whole in a task and has at most PIECE turns is solved there. Longer ones are cut into pieces; for each piece the search finds the cheapest way from every state of the
grammar that it can begin in to every state that it can end in, and a pass over a conversation's pieces puts the ways together. Pieces end in a turn's own edit, so none of two different ways is the
other's beginning, and the first in ASCII order of the whole is made of the first in each piece. What that pass holds of a conversation are the ways of its pieces, a few characters a turn, as the audit itself; the repaired
text is hashed as a stream.

Cases: null role and text are one space (`damaged`); a null conversation is one of its own; null turns come before all others; rows of one turn are ordered by role and text; a role that doesn't begin with s, u or a, the
empty one included, can't be kept; repeated rows are duplicates; conversations without rows are listed with zeros; texts are looked at whole; an empty table gives an empty result; other columns, whatever their names, don't take part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeloom.llm.common import stored, table

DELETE, REROLE, INSERT, CUT = 4, 3, 3, 3
#: Turns of a piece.
PIECE = 48
#: States of the grammar: at the start, after s, after u, after a; where a turn of user or assistant leads, and which of the two it must be.
START, S, U, A = range(4)
NEXT, ROLE = (U, U, A, U), ("user", "user", "assistant", "user")
KEPT = {(START, "s"): S, (START, "u"): U, (S, "u"): U, (U, "a"): A, (A, "u"): U}
ENDS = (START, A)
#: Inserts that lead to an end.
TAIL = {START: 0, S: 2, U: 1, A: 0}


def search(turns: list[tuple[str, bool, bool, int]], begin: int, end: int | None = None) -> tuple[int, str] | None:
    """The cheapest edits of turns (initial of the role, whether it must go, whether it is cut off, how many copies beyond the first, all of which must go) from one state to another: cost, audit.

    Without ``end``: to any end of the grammar, with inserts behind the last turn.
    """
    n = len(turns)
    ahead = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        _, gone, cut, more = turns[i]
        ahead[i] = ahead[i + 1] + (DELETE if gone else min(CUT, DELETE) if cut else 0) + more * DELETE
    failed: dict[tuple[int, int], int] = {}

    def walk(i: int, state: int, left: int) -> str | None:
        """The first way from here that costs at most ``left``."""
        if left < ahead[i] or left <= failed.get((i, state), -1):
            return None
        if i == n:
            if end is None and state in ENDS or state == end:
                return ""
            found = walk(n, NEXT[state], left - INSERT) if end is None else None
            if found is not None:
                return "I" + found
        else:
            initial, gone, cut, more = turns[i]
            rest, extra, copies = left - more * DELETE, CUT if cut else 0, "D" * more
            found = walk(i + 1, state, rest - DELETE)
            if found is not None:
                return "D" + copies + found
            if not gone:  # before a turn that must go no insert is needed: behind it, it costs the same and sorts lower
                found = walk(i, NEXT[state], left - INSERT)
                if found is not None:
                    return "I" + found
                to = KEPT.get((state, initial))
                if to is not None:
                    found = walk(i + 1, to, rest - extra)
                    if found is not None:
                        return "K" + copies + found
                found = walk(i + 1, NEXT[state], rest - extra - REROLE)
                if found is not None:
                    return "R" + copies + found
        failed[i, state] = left
        return None

    if end is not None and end not in reachable(turns, begin):
        return None
    bound = ahead[0]
    while True:
        found = walk(0, begin, bound)
        if found is not None:
            return bound, found
        bound += 1


def reachable(turns: list[tuple[str, bool, bool, int]], begin: int) -> set[int]:
    states = {begin}
    for initial, gone, _, _ in turns:
        if not gone:
            inserted = {NEXT[s] for s in states}
            inserted |= {NEXT[s] for s in inserted}
            before = states | inserted
            states = before | {KEPT[s, initial] for s in before if (s, initial) in KEPT} | {NEXT[s] for s in before}
    return states


def repaired(turns: list[tuple[str, str, int]], audit: str, state: int, lines: list[str]) -> int:
    """Appends the repaired turns (role, text, further copies) to lines, as role:text; the state that the grammar is in then."""
    at = 0
    for role, text, more in turns:
        while audit[at] == "I":
            lines.append(ROLE[state] + ":")
            state, at = NEXT[state], at + 1
        if audit[at] == "K":
            lines.append(f"{role}:{text}")
            state = KEPT[state, role[:1]]
        elif audit[at] == "R":
            lines.append(f"{ROLE[state]}:{text}")
            state = NEXT[state]
        at += 1 + more
    for _ in audit[at:]:
        lines.append(ROLE[state] + ":")
        state = NEXT[state]
    return state


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage that crc32(conv_id:turn) % 20 says; nulls are one space in the digest, in roles and in texts."""
    space = F.lit(" ")
    shown = lambda c: F.coalesce(F.col(c).cast("string"), space)
    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    hurt = rows.select(
        "conv_id", "turn", kind.alias("kind"), F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
    )
    return hurt.where("kind <> 0").select("conv_id", "turn", "role", "text", F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"))


def faults(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text, copies) with equal ones as one: copies, blank, duplicate, truncated for the first copy; those behind it are blank or duplicates."""
    one = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    one = one.withColumn("order", F.struct(F.col("turn").isNotNull().alias("known"), "turn"))
    # the first turn in which role and text occur: one narrow row each, so a text that a third of all turns share is no task of its own
    firsts = one.groupBy("conv_id", "role", F.sha2("text", 256).alias("sha")).agg(F.min("order").alias("order")).select("conv_id", "role", "sha", F.col("order.turn").alias("turn"), F.lit(True).alias("is_first"))
    keyed = one.withColumn("sha", F.sha2("text", 256)).alias("o")
    same = F.col("o.conv_id").eqNullSafe(F.col("f.conv_id")) & F.col("o.turn").eqNullSafe(F.col("f.turn")) & (F.col("o.role") == F.col("f.role")) & (F.col("o.sha") == F.col("f.sha"))
    met = keyed.join(firsts.alias("f"), same, "left").select("o.conv_id", "o.turn", "o.role", "o.text", "o.copies", F.col("is_first").isNull().alias("again"))
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    ended = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*+\z")
    return met.select("conv_id", "turn", "role", "text", "copies", blank.alias("blank"), (~blank & F.col("again")).alias("duplicate"), (~blank & ~F.col("again") & ~ended).alias("truncated"))


PART = (
    "conv_id string, place string, solo boolean, n_blank long, n_duplicate long, n_truncated long, n_illegal long, first_initial string, last_initial string, cost long, audit string, sha string, "
    "ways array<struct<begin:int,end:int,cost:long,audit:string>>, turns array<struct<role:string,text:string,more:long>>"
)


def _tally(held: list[tuple]) -> dict:
    """Counts over rows (role, text, copies, blank, duplicate, truncated)."""
    blank = sum(c for _, _, c, b, _, _ in held if b)
    duplicate = sum(c * d + (c - 1) * (not d and not b) for _, _, c, b, d, _ in held)
    legal = {"su", "ua", "au"}
    initials = [r[:1] for r, *_ in held]
    illegal = sum(c - 1 for _, _, c, *_ in held) + sum(a + b not in legal for a, b in zip(initials, initials[1:]))
    return {"n_blank": blank, "n_duplicate": duplicate, "n_truncated": sum(bool(t) for *_, t in held), "n_illegal": illegal, "first_initial": initials[0], "last_initial": initials[-1]}


def _turns(held: list[tuple]) -> list[tuple[str, bool, bool, int]]:
    return [(r[:1], bool(b or d), bool(t), c - 1) for r, _, c, b, d, t in held]


def _sha(lines: list[str]) -> str:
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def _part(conv, place: str, held: list[tuple], solo: bool) -> dict:
    turns, out = _turns(held), {"conv_id": conv, "place": place, "solo": solo, **_tally(held), "cost": None, "audit": None, "sha": None, "ways": None, "turns": None}
    told = [(r, t, c - 1) for r, t, c, *_ in held]
    if solo:
        cost, audit = search(turns, START)
        lines: list[str] = []
        repaired(told, audit, START, lines)
        return out | {"cost": cost, "audit": audit, "sha": _sha(lines)}
    ways = [{"begin": i, "end": j, "cost": w[0], "audit": w[1]} for i in range(4) for j in range(4) if (w := search(turns, i, j)) is not None]
    return out | {"ways": ways, "turns": [{"role": r, "text": t, "more": m} for r, t, m in told]}


def parts(rows: DataFrame) -> DataFrame:
    """rows with their faults -> conversations that are solved (solo), and pieces of the others, in their order by place."""
    names = [c.split()[0] for c in PART.split(", ")]
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    # ranges end at beginnings of texts, as the driver holds their ends
    ranged = rows.repartitionByRange(*order[:3], F.substring("text", 1, 64)).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, whose, number, first = [], None, 0, True

        def flush(last: bool) -> list[dict]:
            # a conversation with others of this task before and behind it is here whole
            nonlocal number
            solo = not first and not last and len(held) <= PIECE and cut == 0
            out = [_part(whose, f"{part:010d}-{number:012d}", held, solo)]
            number += 1
            return out

        cut, part = 0, 0
        out: list[dict] = []
        for batch in batches:
            for conv, role, text, copies, blank, duplicate, truncated, part_id in batch[["conv_id", "role", "text", "copies", "blank", "duplicate", "truncated", "part"]].itertuples(index=False):
                part = part_id
                if held and conv != whose:
                    out += flush(False)
                    held, cut, first = [], 0, False
                elif len(held) == PIECE:
                    cut = 1
                    out += flush(False)
                    held = []
                whose = conv
                held.append((role, text, int(copies), blank, duplicate, truncated))
                if len(out) >= 256:
                    yield pd.DataFrame(out, columns=names)
                    out = []
        if held:
            out += flush(True)
        if out:
            yield pd.DataFrame(out, columns=names)

    return ranged.mapInPandas(run, PART)


WAY = ["conv_id", "place", "begin", "taken", "cost"]


def put_together(pieces: DataFrame) -> DataFrame:
    """Pieces of conversations (ways, in the order of place) -> per piece the way that is taken: conv_id, place, begin, taken; the last piece's has the inserts behind it."""
    def conversation(held: list[tuple[str, list]]) -> list[tuple]:
        # per state the cost so far and its rank in ASCII order among the four; states that can't be reached are left out
        now, steps = {START: (0, 0)}, []
        for _, ways in held:
            best: dict[int, tuple] = {}
            for w in ways:
                if w["begin"] in now:
                    cost, rank = now[w["begin"]]
                    offer = (cost + w["cost"], rank, w["audit"], w["begin"])
                    if w["end"] not in best or offer < best[w["end"]]:
                        best[w["end"]] = offer
            ranked = sorted(best, key=lambda s: best[s][1:3])
            now = {s: (best[s][0], ranked.index(s)) for s in best}
            steps.append({s: (b[3], b[2]) for s, b in best.items()})
        cost, _, state = min((c + INSERT * TAIL[s], r, s) for s, (c, r) in now.items())
        tail, out = "I" * TAIL[state], []
        for (place, _), step in zip(reversed(held), reversed(steps)):
            begin, audit = step[state]
            out.append((place, begin, audit + tail, cost))
            state, tail, cost = begin, "", 0
        return out[::-1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, whose, begun = [], None, False
        for batch in batches:
            out = []
            for conv, place, ways in batch[["conv_id", "place", "ways"]].itertuples(index=False):
                if begun and conv != whose:
                    out += [(whose, *x) for x in conversation(held)]
                    held = []
                whose, begun = conv, True
                held.append((place, list(ways)))
            yield pd.DataFrame(out, columns=WAY)
        if begun:
            yield pd.DataFrame([(whose, *x) for x in conversation(held)], columns=WAY)

    ordered = pieces.select("conv_id", "place", "ways").repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return ordered.mapInPandas(run, "conv_id string, place string, begin int, taken string, cost long")


def hashed(pieces: DataFrame) -> DataFrame:
    """Pieces with the way taken (begin, taken) -> conv_id, audit, sha: a conversation's turns go through the hash one piece after the other."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whose, begun, digest, audit, any_line = None, False, None, [], False
        for batch in batches:
            out = []
            for conv, turns, begin, taken in batch[["conv_id", "turns", "begin", "taken"]].itertuples(index=False):
                if not begun or conv != whose:
                    if begun:
                        out.append((whose, "".join(audit), digest.hexdigest()))
                    whose, begun, digest, audit, any_line = conv, True, hashlib.sha256(), [], False
                lines: list[str] = []
                repaired([(t["role"], t["text"], int(t["more"])) for t in turns], taken, int(begin), lines)
                audit.append(taken)
                if lines:
                    digest.update((("\n" if any_line else "") + "\n".join(lines)).encode())
                    any_line = True
            yield pd.DataFrame(out, columns=["conv_id", "audit", "sha"])
        if begun:
            yield pd.DataFrame([(whose, "".join(audit), digest.hexdigest())], columns=["conv_id", "audit", "sha"])

    ordered = pieces.select("conv_id", "place", "turns", "begin", "taken").repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return ordered.mapInPandas(run, "conv_id string, audit string, sha string")


def repair(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text, copies; no null roles or texts) -> conv_id, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, one row a conversation."""
    kind = rows.schema["conv_id"].dataType
    done = stored(parts(faults(rows.withColumn("conv_id", F.col("conv_id").cast("string")))), "repair-parts")  # text, which pandas tells from null
    solo = done.where("solo").select("conv_id", F.col("n_blank").alias("blank"), F.col("n_duplicate").alias("duplicate"), F.col("n_truncated").alias("truncated"), F.col("n_illegal").alias("illegal"), "cost", "audit", F.col("sha").alias("repaired_sha256"))
    pieces = done.where("NOT solo")
    taken = stored(put_together(pieces), "repair-ways")
    chosen = pieces.drop("cost", "audit", "sha", "ways").join(taken.drop("conv_id"), "place")  # a piece's place is its own
    texts = hashed(chosen)
    # counts of pieces, and of the pairs of turns where one piece meets the next
    by = Window.partitionBy("conv_id").orderBy("place")
    met = chosen.select("conv_id", "place", "n_blank", "n_duplicate", "n_truncated", "n_illegal", "cost", F.concat(F.lag("last_initial").over(by), F.col("first_initial")).alias("pair"), F.lag("place").over(by).isNotNull().alias("joined"))
    counts = met.groupBy("conv_id").agg(
        F.sum("n_blank").alias("blank"), F.sum("n_duplicate").alias("duplicate"), F.sum("n_truncated").alias("truncated"),
        (F.sum("n_illegal") + F.count_if(F.col("joined") & ~F.col("pair").isin("su", "ua", "au"))).alias("illegal"), F.sum("cost").alias("cost"),
    )
    long = counts.alias("a").join(texts.alias("b"), F.col("a.conv_id").eqNullSafe(F.col("b.conv_id"))).select("a.conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.col("sha").alias("repaired_sha256"))
    return solo.unionByName(long).withColumn("conv_id", F.col("conv_id").cast(kind))


def gaps(rows: DataFrame) -> DataFrame:
    """conv_id, gaps: turns that are missing between the first and the last; turns are made distinct before they are counted."""
    turns = rows.where(F.col("turn").isNotNull()).select("conv_id", "turn").distinct()
    return turns.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    original = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = stored(damaged(original), "repair-damaged")
    every = original.select("conv_id").distinct()
    found = repair(rows)
    holes = gaps(rows)
    same = lambda a, b: F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id"))
    joined = every.alias("e").join(found.alias("r"), same("e", "r"), "left").join(holes.alias("g"), same("e", "g"), "left")
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return joined.select("e.conv_id", count("gaps"), *[count(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


ORACLE = r"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda n: list_reduce([n, 1, 2, 3, 4, 5, 6, 7, 8], lambda a, k: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END)) AS t),
o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
h AS (SELECT o.*, xor(list_reduce(list_concat([4294967295], list_transform(string_split(k, ''), lambda c: ascii(c)::BIGINT)), lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % 20 AS kind FROM o, crc),
m AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM h),
n AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen, lag(role) OVER w AS before FROM m
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role COLLATE "binary", text COLLATE "binary", copy)),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN seen > 1 THEN 'd' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault, left(role, 1) AS r FROM n),
-- cheapest edits that end at the start, after s, after u, after a, as [cost, audit]: first with inserts before the turn, then with the turn's own edit
w AS (SELECT conv_id, 0::BIGINT AS i, {'c': 0, 'a': ''} AS z, NULL::STRUCT(c INTEGER, a VARCHAR) AS s, NULL::STRUCT(c INTEGER, a VARCHAR) AS u, NULL::STRUCT(c INTEGER, a VARCHAR) AS e FROM f GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i, dz,
    list_min([ds, CASE WHEN r = 's' AND free THEN {'c': z.c + cut, 'a': z.a || 'K'} END]),
    list_min([du, CASE WHEN r = 'u' AND free THEN {'c': pu.c + cut, 'a': pu.a || 'K'} END, CASE WHEN free THEN {'c': pu.c + cut + 3, 'a': pu.a || 'R'} END]),
    list_min([de, CASE WHEN r = 'a' AND free AND iu IS NOT NULL THEN {'c': iu.c + cut, 'a': iu.a || 'K'} END, CASE WHEN free AND iu IS NOT NULL THEN {'c': iu.c + cut + 3, 'a': iu.a || 'R'} END])
  FROM (SELECT *, list_min([z, s, ie]) AS pu, CASE WHEN z IS NOT NULL THEN {'c': z.c + 4, 'a': z.a || 'D'} END AS dz, CASE WHEN s IS NOT NULL THEN {'c': s.c + 4, 'a': s.a || 'D'} END AS ds,
          CASE WHEN iu IS NOT NULL THEN {'c': iu.c + 4, 'a': iu.a || 'D'} END AS du, CASE WHEN ie IS NOT NULL THEN {'c': ie.c + 4, 'a': ie.a || 'D'} END AS de
        FROM (SELECT *, list_min([e, CASE WHEN iu IS NOT NULL THEN {'c': iu.c + 3, 'a': iu.a || 'I'} END]) AS ie
              FROM (SELECT w.conv_id, f.i, w.z, w.s, w.u, w.e, f.r, f.fault IN ('', 't') AS free, CASE WHEN f.fault = 't' THEN 3 ELSE 0 END AS cut,
                      list_min([w.u, {'c': w.z.c + 3, 'a': w.z.a || 'I'}, CASE WHEN w.s IS NOT NULL THEN {'c': w.s.c + 3, 'a': w.s.a || 'I'} END, CASE WHEN w.e IS NOT NULL THEN {'c': w.e.c + 3, 'a': w.e.a || 'I'} END]) AS iu
                    FROM w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1)))),
b AS (SELECT w.conv_id, list_min([w.z, w.e, CASE WHEN w.u IS NOT NULL THEN {'c': w.u.c + 3, 'a': w.u.a || 'I'} END, CASE WHEN w.s IS NOT NULL THEN {'c': w.s.c + 6, 'a': w.s.a || 'II'} END]) AS best
      FROM w JOIN (SELECT DISTINCT conv_id, n FROM f) l ON l.conv_id IS NOT DISTINCT FROM w.conv_id AND l.n = w.i),
-- the audit's edits, with the turn that each but an insert takes and the role that the grammar asks for
x AS (SELECT conv_id, best.a AS audit, unnest(string_split(best.a, '')) AS edit, generate_subscripts(string_split(best.a, ''), 1) AS p FROM b WHERE best.a <> ''),
y AS (SELECT *, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS i FROM x),
g AS (SELECT y.conv_id, y.p, y.edit, f.role, f.text, f.r, count(*) FILTER (y.edit <> 'D' AND NOT (y.edit = 'K' AND f.r = 's')) OVER (PARTITION BY y.conv_id ORDER BY y.p) AS spoken FROM y LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM y.conv_id AND f.i = y.i),
t AS (SELECT conv_id, string_agg(CASE edit WHEN 'K' THEN role || ':' || text WHEN 'R' THEN CASE spoken % 2 WHEN 1 THEN 'user' ELSE 'assistant' END || ':' || text ELSE CASE spoken % 2 WHEN 1 THEN 'user' ELSE 'assistant' END || ':' END, chr(10) ORDER BY p) AS told
      FROM g WHERE edit <> 'D' GROUP BY conv_id),
k AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
        count(*) FILTER (i > 1 AND left(before, 1) || r NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT c.conv_id, coalesce(k.gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
  coalesce(best.a, '') AS audit, sha256(coalesce(told, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN k ON k.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
"""
