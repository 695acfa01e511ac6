"""Chat formatting: tool calls linked to results, put in order, checked against schemas, and written as canonical JSON. DataFrame operations only.

A call has an identifier, a tool's name, and arguments as JSON; a result names the identifier that it answers. Calls and results meet in a
hash join on the identifier. A node may have to come after several others (a result after its call, a call after all results that it builds on); its level is the length of the longest
chain before it. Stretches where each node follows one other are contracted by pointer doubling, in log2 of their length rounds, so a conversation of any length is no group in one task; what is left,
nodes with several predecessors and what they follow, is eliminated level by level. Arguments are valid when they are a JSON object with all required fields, no unknown and no repeated ones, and each
of its type and length. Canonical JSON has keys in code-point order, no white space, no null fields, and one form for each number, exactly: 1.0, 1e0 and 10e-1 are 1, and 1.50 is 1.5; what
would take more than 40 characters has an exponent instead (`number`).

From plain conversations, each user turn is taken as a call of the tool ``reply`` with that turn's text, answered by the assistant's turn right after it.

Cases: null ids or turns give no identifier, level 0 and no link; null text is a missing field, thus invalid; repeated rows and rows that share conversation
and turn are one node and keep all their rows; nodes on or behind a cycle have a null level; text that isn't JSON, a key that comes twice in an object and an exponent of more than 18 digits make an invalid argument without a
canonical form; an empty table gives an empty result; extra columns don't take part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm.common import spread_join, stored, table, unused

#: tool, field, type as Spark's variants call it, whether required, least and most characters (strings).
SCHEMAS = [("reply", "text", "STRING", True, 1, 400), ("reply", "turn", "BIGINT", True, None, None)]


def schema_table(spark: SparkSession, schemas=SCHEMAS) -> DataFrame:
    return spark.createDataFrame(schemas, "name string, field string, type string, required boolean, least int, most int")


#: Parts of a JSON text: strings, numbers, all else. Possessive, so that long strings take no stack.
PARTS = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"?|-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|[^"0-9-]+|[\s\S]'
#: Strings and numbers as canonical() marks them.
MARKED = r'"n([^"]*)"|(")s([^"\\]*+(?:\\.[^"\\]*+)*+")'
WIDEST = 40


def number(text: Column) -> Column:
    """A JSON number in its one form: an integer or plain fraction without needless zeros where that has WIDEST characters or fewer, else d.ddde<exponent>; zero is 0."""
    fraction = F.regexp_extract(text, r"\.([0-9]+)", 1)
    power = F.regexp_extract(text, r"[eE]([+-]?[0-9]+)$", 1)
    power = F.when(power == "", F.lit(0).cast("long")).otherwise(F.when(F.length(power) <= 18, power.try_cast("long")))
    digits = F.regexp_replace(F.concat(F.regexp_extract(text, r"^-?([0-9]+)", 1), fraction), "^0+", "")
    significant = F.regexp_replace(digits, "0+$", "")
    n = F.length(significant).cast("long")
    up = power - F.length(fraction) + F.length(digits) - n  # the value is significant * 10^up
    cut = lambda a, length=None: F.substr(significant, a.cast("int"), *([] if length is None else [length.cast("int")]))
    zeros = lambda k: F.repeat(F.lit("0"), F.least(F.greatest(k, F.lit(0)), F.lit(WIDEST)).cast("int"))
    short = F.concat(cut(F.lit(1), F.lit(1)), F.when(n > 1, F.concat(F.lit("."), cut(F.lit(2)))).otherwise(""), F.lit("e"), (n - 1 + up).cast("string"))
    plain = (
        F.when((up >= 0) & (n + up <= WIDEST), F.concat(significant, zeros(up)))
        .when((up < 0) & (n + up > 0) & (n < WIDEST), F.concat(cut(F.lit(1), n + up), F.lit("."), cut(n + up + 1)))
        .when((up < 0) & (n + up <= 0) & (2 - up <= WIDEST), F.concat(F.lit("0."), zeros(-n - up), significant))
    )
    sign = F.when(text.startswith("-"), "-").otherwise("")
    return F.when(significant == "", F.lit("0")).otherwise(F.concat(sign, F.coalesce(plain, short)))


def canonical(text: Column) -> Column:
    """A JSON text in its canonical form, or null. Numbers pass the parser as marked strings, so none is rounded; keys and strings are marked otherwise, which keeps the order of keys."""
    parts = F.regexp_extract_all(text, F.lit(PARTS), F.lit(0))
    mark = lambda x: F.when(x.startswith('"'), F.concat(F.lit('"s'), F.substr(x, F.lit(2)))).when(x.rlike("^-?[0-9]"), F.concat(F.lit('"n'), number(x), F.lit('"'))).otherwise(x)
    marked = F.transform(parts, mark)
    # the parser stops at the first value's end; what is a value within a list and within an object has nothing after it
    alone = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).isNotNull() & F.try_parse_json(F.concat(F.lit('{"k":'), text, F.lit("}"))).isNotNull()
    whole = alone & F.forall(marked, lambda x: x.isNotNull())
    return F.when(whole, F.regexp_replace(F.to_json(F.try_parse_json(F.array_join(marked, ""))), MARKED, "$1$2$3"))


def valid_arguments(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """calls (name, arguments, ...) with ``valid`` and ``canonical``, the arguments as canonical JSON (null if they aren't JSON); columns of these names are replaced.

    The schemas' fields are gathered by tool and joined by name; a tool without a schema has no valid calls.
    """
    fields = schemas.groupBy("name").agg(F.collect_list(F.struct("field", "type", "required", "least", "most")).alias("fields"))
    # equal arguments are checked once, in their canonical form, so equal values fare alike
    distinct = calls.select("name", "arguments").distinct().join(fields, "name", "left").withColumn("canonical", canonical(F.col("arguments"))).withColumn("keys", F.json_object_keys("canonical"))
    plain = F.from_json("canonical", "map<string,string>")

    def fits(f: Column) -> Column:
        value = F.element_at(plain, f["field"])
        kind = F.element_at(F.col("kinds"), f["field"])
        there = F.array_contains("keys", f["field"])
        size = F.length(value)
        ok = (kind == f["type"]) & (f["least"].isNull() | (size >= f["least"])) & (f["most"].isNull() | (size <= f["most"]))
        return F.when(there, F.coalesce(ok, F.lit(False))).otherwise(~f["required"])

    # the type of each field from its raw JSON: a string starts with a quote, an integer has digits alone
    raw = F.from_json(F.col("canonical"), "map<string,variant>")
    kinds = F.transform_values(raw, lambda _, v: F.schema_of_variant(v))
    checked = distinct.withColumn("kinds", kinds)
    known = F.forall("keys", lambda k: F.exists("fields", lambda f: f["field"] == k))
    checked = checked.withColumn("valid", F.coalesce(F.col("fields").isNotNull() & F.col("keys").isNotNull() & F.forall("fields", fits) & known, F.lit(False)))
    # the same arguments may come in a third of all calls
    key = unused("arguments_key", calls)
    named = F.sha2(F.to_json(F.struct("name", "arguments")).cast("binary"), 256).alias(key)
    return spread_join(calls.select("*", named), checked.select(named, "valid", "canonical"), key).drop(key)


def levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes (node, unique and not null), edges (node, before: nodes that it comes after) -> node, level: the longest chain before it; null on or behind a cycle.

    Edges to nodes that aren't in ``nodes`` don't count. A node with one predecessor steps up to it; steps are doubled until they end at a node with none or several, the chain's head. Heads
    with several predecessors then get their levels round by round, each after the last of its predecessors' heads: as many rounds as there are such heads behind one another.
    """
    known = nodes.select(F.col("node").alias("k"))
    drawn = stored(edges.where("node IS NOT NULL AND before IS NOT NULL").distinct().join(known, F.col("before") == F.col("k"), "left_semi").select("node", "before"), "levels")
    single = drawn.groupBy("node").agg(F.count("*").alias("n"), F.min("before").alias("before"))
    state = stored(nodes.join(single, "node", "left").select("node", F.coalesce("n", F.lit(0)).alias("n"), F.when(F.col("n") == 1, F.col("before")).alias("up"), F.when(F.col("n") == 1, 1).otherwise(0).cast("long").alias("steps")), "levels")
    # done: head and steps from it; left: where they have come to
    most, reach = state.count(), 1
    done, left = state.where("up IS NULL").select("node", F.col("node").alias("head"), "steps"), state.where("up IS NOT NULL").select("node", "up", "steps")
    while reach <= 2 * most and not left.isEmpty():
        further = done.select(F.col("node").alias("u"), "head", F.lit(None).cast(left.schema["up"].dataType).alias("next"), F.col("steps").alias("more"))
        further = further.unionByName(left.select(F.col("node").alias("u"), F.lit(None).cast(left.schema["up"].dataType).alias("head"), F.col("up").alias("next"), F.col("steps").alias("more")))
        moved = stored(left.join(further, F.col("up") == F.col("u")).select("node", "head", F.col("next").alias("up"), (F.col("steps") + F.col("more")).alias("steps")), "levels")
        done, left = done.unionByName(moved.where("up IS NULL").select("node", "head", "steps")), moved.where("up IS NOT NULL").select("node", "up", "steps")
        reach *= 2
    placed = stored(done, "levels")
    heads = state.where("n > 1").select("node")
    after = drawn.join(heads, "node").join(placed.select(F.col("node").alias("before"), "head", "steps"), "before", "left").select("node", "head", (F.col("steps") + 1).alias("steps"))
    ranked = state.where("n = 0").select("node", F.lit(0).cast("long").alias("level"))
    waiting = stored(after, "levels")
    while not waiting.isEmpty():
        met = waiting.join(ranked.select(F.col("node").alias("head"), "level"), "head", "left")
        due = stored(met.groupBy("node").agg(F.max(F.col("level") + F.col("steps")).alias("level"), F.bool_and(F.col("level").isNotNull()).alias("ready")).where("ready").select("node", "level"), "levels")
        if due.isEmpty():
            break  # cycles, and what comes after them
        ranked, waiting = ranked.unionByName(due), stored(waiting.join(due.select("node"), "node", "left_anti"), "levels")
    found = placed.join(ranked.select(F.col("node").alias("head"), F.col("level").alias("base")), "head", "left").select("node", (F.col("base") + F.col("steps")).alias("level"))
    return nodes.select("node").join(found, "node", "left")


def link(calls: DataFrame, results: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """calls with ``linked``: whether a result answers them. call_id may repeat on either side, or be null. counted: as in spread_join."""
    answered = results.select("call_id").where(F.col("call_id").isNotNull()).distinct().withColumn("linked", F.lit(True))
    return spread_join(calls, answered.hint("shuffle_hash"), "call_id", counted).withColumn("linked", F.col("linked").isNotNull())


def formatted(messages: DataFrame, schemas: DataFrame) -> DataFrame:
    """Per row of messages (conv_id, turn, role, text): conv_id, turn, role, call_id, level, linked, valid, json.

    call_id: of a call its own, of a result that which it answers; linked: a call has a result, a result has a call; valid is null but for calls.
    """
    name = lambda turn: F.concat(F.lit("call-"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    turns = messages.select("conv_id", "turn", "role", "text")
    calls = turns.where("role = 'user'").select("conv_id", "turn", "text", name(F.col("turn")).alias("call_id"), F.when(F.col("role") == "user", F.lit("reply")).alias("name"), F.to_json(F.struct("text", "turn")).alias("arguments"))
    answers = turns.where("role = 'assistant'").select("conv_id", "turn", "text", name(F.col("turn") - 1).alias("call_id"))
    calls_linked = link(valid_arguments(calls, schemas), answers, calls)
    answers_linked = link(answers, calls)

    # a result follows its call, and a call the assistant's turn right before it
    called = calls.select(F.struct("conv_id", "turn").alias("node"), F.lit("assistant").alias("after"))
    replied = answers.select(F.struct("conv_id", "turn").alias("node"), F.lit("user").alias("after"))
    kinds = turns.where("conv_id IS NOT NULL AND turn IS NOT NULL").select(F.struct("conv_id", "turn").alias("node"), "role").distinct()
    before = (
        called.union(replied).where("node.conv_id IS NOT NULL AND node.turn IS NOT NULL").distinct()
        .withColumn("want", F.struct(F.col("node.conv_id").alias("conv_id"), (F.col("node.turn") - 1).alias("turn")))
        .join(kinds.select(F.col("node").alias("there"), F.col("role").alias("there_role")), (F.col("want") == F.col("there")) & (F.col("after") == F.col("there_role")), "left")
        .select("node", F.col("there").alias("before"))
    )
    order = levels(before.select("node").distinct(), before)

    shape = ["conv_id", "turn", "role", "call_id", "linked", "valid", "canonical", "text"]
    rows = (
        calls_linked.withColumn("role", F.lit("user")).select(*shape)
        .unionByName(answers_linked.withColumns({"role": F.lit("assistant"), "valid": F.lit(None).cast("boolean"), "canonical": F.lit(None).cast("string")}).select(*shape))
        .unionByName(turns.where("role IS NULL OR role NOT IN ('user', 'assistant')").withColumns({"call_id": F.lit(None).cast("string"), "linked": F.lit(False), "valid": F.lit(None).cast("boolean"), "canonical": F.lit(None).cast("string")}).select(*shape))
    )
    node = F.when(F.col("conv_id").isNotNull() & F.col("turn").isNotNull(), F.struct("conv_id", "turn")).alias("node")
    # turns of other roles have no place in the order; a null level is that of a cycle
    order = order.withColumn("ordered", F.lit(True))
    rows = spread_join(rows.select("*", node), order, "node", turns.select(node)).withColumn("level", F.when(F.col("ordered"), F.col("level")).otherwise(F.lit(0).cast("long")))
    call = F.when(F.col("role") == "user", F.to_json(F.struct(F.col("canonical").alias("arguments"), F.col("call_id").alias("id"), F.lit("reply").alias("name"), F.lit("user").alias("role"))))
    answer = F.when(F.col("role") == "assistant", F.to_json(F.struct(F.col("text").alias("content"), F.lit("tool").alias("role"), F.col("call_id").alias("tool_call_id"))))
    other = F.to_json(F.struct(F.col("text").alias("content"), F.col("role").alias("role")))
    return rows.select("conv_id", "turn", "role", "call_id", "level", "linked", "valid", F.coalesce(call, answer, other).alias("json"))


def op4_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formatted(table(spark, sf_dir, "conversations"), schema_table(spark))


ORACLE = r"""
WITH RECURSIVE m AS (SELECT conv_id, turn, role, text FROM conversations),
k AS (SELECT DISTINCT conv_id, turn, role FROM m),
lv AS (SELECT c.conv_id, c.turn, c.role, 0::BIGINT AS level FROM k c LEFT JOIN k p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1
          AND ((c.role = 'user' AND p.role = 'assistant') OR (c.role = 'assistant' AND p.role = 'user')) WHERE p.conv_id IS NULL
       UNION ALL
       SELECT c.conv_id, c.turn, c.role, lv.level + 1 FROM lv JOIN k c ON c.conv_id = lv.conv_id AND c.turn = lv.turn + 1
          AND ((c.role = 'user' AND lv.role = 'assistant') OR (c.role = 'assistant' AND lv.role = 'user'))),
j AS (SELECT m.*, lv.level,
        CASE m.role WHEN 'user' THEN 'call-' || m.conv_id || '-' || m.turn WHEN 'assistant' THEN 'call-' || m.conv_id || '-' || (m.turn - 1) END AS call_id,
        CASE m.role WHEN 'user' THEN EXISTS (SELECT 1 FROM k WHERE k.conv_id = m.conv_id AND k.turn = m.turn + 1 AND k.role = 'assistant')
                    WHEN 'assistant' THEN EXISTS (SELECT 1 FROM k WHERE k.conv_id = m.conv_id AND k.turn = m.turn - 1 AND k.role = 'user') ELSE false END AS linked
      FROM m JOIN lv ON lv.conv_id = m.conv_id AND lv.turn = m.turn AND lv.role = m.role)
SELECT conv_id, turn, role, call_id, level, linked,
  CASE WHEN role = 'user' THEN text IS NOT NULL AND length(text) BETWEEN 1 AND 400 END AS valid,
  CASE role WHEN 'user' THEN '{"arguments":' || to_json('{"text":' || to_json(text) || ',"turn":' || turn || '}') || ',"id":' || to_json(call_id) || ',"name":"reply","role":"user"}'
            WHEN 'assistant' THEN '{"content":' || to_json(text) || ',"role":"tool","tool_call_id":' || to_json(call_id) || '}'
            ELSE '{"content":' || to_json(text) || ',"role":' || to_json(role) || '}' END AS json
FROM j
"""
