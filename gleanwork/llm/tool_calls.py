"""Tool calls and their results, linked, ordered, checked and written as canonical JSON.

A call names its id, conversation, tool, arguments (JSON) and the call it follows, if any. Results are
joined to calls of their conversation by id; ids of other conversations are others. The position of a call is the number of calls before it in its chain, found by
pointer doubling: every round joins each call with the one it points to, so a chain of n calls takes
about log2(n) rounds, each written to the shared folder. Arguments must be an object with the tool's required fields,
no other than its fields, and values of the stated types. Canonical JSON has sorted keys and no blanks.

One row per call, per result without a call and per repeat: a conversation is never gathered, however long it is.

Status: "ok", "no result", "invalid arguments", "unknown tool", "cycle" (in this order of precedence from the last), or
"orphan" for a result without a call. Of several calls or results with one id in a conversation the first by turn, then by content, counts;
the others link with nothing and come out as "repeated", without position. A null
id links with nothing: such a call has no result and such a result is an orphan. Rows without conversation belong to one. Following an id that is not there means following none.
Null arguments are invalid. Empty tables: empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.session import staged

#: Kinds of values, as Spark names the types of JSON values.
TYPES = {"integer": "^(BIGINT|DECIMAL\\(\\d+,0\\))$", "number": "^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$", "string": "^STRING$",
         "boolean": "^BOOLEAN$", "array": "^ARRAY", "object": "^OBJECT"}
#: tool -> field -> (type, required)
Schemas = Mapping[str, Mapping[str, tuple[str, bool]]]


def valid_arguments(name: Column, arguments: Column, schemas: Schemas) -> Column:
    value = F.try_parse_json(arguments)
    keys = F.json_object_keys(arguments)
    checks = F.lit(False)
    for tool, fields in schemas.items():
        tests = [F.size(F.array_except(keys, F.array(*[F.lit(f) for f in fields]))) == 0]
        for field, (kind, required) in fields.items():
            there = F.array_contains(keys, field)
            right = F.schema_of_variant(F.try_variant_get(value, f"$.{field}", "variant")).rlike(TYPES[kind])
            tests.append(F.when(there, right).otherwise(not required))
        checks = F.when(name == tool, reduce(lambda a, b: a & b, tests)).otherwise(checks)
    return F.coalesce(value.isNotNull() & checks, F.lit(False))


def positions(calls: DataFrame) -> DataFrame:
    """(id, position) of calls (id, after); position -1 on a cycle."""
    ends = calls.select(F.col("id").alias("end"))
    chain = calls.join(ends, F.col("after") == F.col("end"), "left").select("id", F.col("end").alias("to"), F.when(F.col("end").isNotNull(), 1).otherwise(0).cast("long").alias("n"))
    chain = staged(chain, "chain")
    n, rounds = chain.count(), 0
    while chain.filter(F.col("to").isNotNull()).limit(1).count() and (1 << rounds) <= n:
        far = chain.select(F.col("id").alias("mid"), F.col("to").alias("far"), F.col("n").alias("more"))
        chain = staged(chain.join(far, F.col("to") == F.col("mid"), "left").select(
            "id", F.col("far").alias("to"), (F.col("n") + F.coalesce("more", F.lit(0))).alias("n")), "chain")
        rounds += 1
    return chain.select("id", F.when(F.col("to").isNull(), F.col("n")).otherwise(-1).alias("position"))


def _key(name: str) -> Column:
    """Names an id within its conversation; null for a null id."""
    return F.when(F.col(name).isNotNull(), F.to_json(F.struct(F.col("conversation").cast("string").alias("c"), F.col(name).cast("string").alias("i"))))


def _divided(df: DataFrame, label: str, *columns: str) -> tuple[DataFrame, DataFrame]:
    """The rows that count, one per key, and the repeats. Keys are counted up before any shuffle, repeats are told by row number."""
    rows = staged(df.select(_key("id").alias("key"), "id", "turn", "conversation", *columns, F.monotonically_increasing_id().alias("row")), label)
    named = rows.filter(F.col("key").isNotNull())
    first = staged(named.groupBy("key").agg(F.min(F.struct("turn", *columns, "row", "id", "conversation")).alias("one")).select("key", "one.*"), label)
    return first.unionByName(rows.filter(F.col("key").isNull())), named.join(first.select("row"), "row", "left_anti")


def link_calls(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """calls: (id, conversation, turn, name, arguments, after); results: (id, conversation, turn, content).

    Returns (conversation, id, turn, position, status, json).
    """
    calls, called_again = _divided(calls, "calls", "name", "arguments", "after")
    results, answered_again = _divided(results, "results", "content")
    order = positions(calls.filter(F.col("key").isNotNull()).select(F.col("key").alias("id"), _key("after").alias("after"))).withColumnRenamed("id", "__id")
    answer = results.select(F.col("key").alias("__result"), F.col("content").alias("result"))
    linked = calls.join(answer, F.col("key") == F.col("__result"), "left").join(order, F.col("key") == F.col("__id"), "left")
    linked = linked.withColumns({"position": F.coalesce("position", F.lit(0)), "valid": valid_arguments(F.col("name"), F.col("arguments"), schemas)})
    status = (F.when(F.col("position") < 0, "cycle").when(~F.coalesce(F.col("name").isin(*schemas), F.lit(False)), "unknown tool")
              .when(~F.col("valid"), "invalid arguments").when(F.col("__result").isNull(), "no result").otherwise("ok"))
    # Fields in alphabetical order; the parsed arguments are written with sorted keys.
    parsed = F.to_json(F.try_parse_json("arguments"))
    parts = {"arguments": F.coalesce(parsed, _quoted("arguments")), "id": _quoted("id"), "name": _quoted("name"), "result": _quoted("result")}
    out = linked.select("conversation", "id", "turn", "position", status.alias("status"), _object(parts).alias("json"))
    lost = results.join(calls.select(F.col("key").alias("__call")), F.col("key") == F.col("__call"), "left_anti")
    said = _object({"id": _quoted("id"), "result": _quoted("content")})
    again = _object({k: v for k, v in parts.items() if k != "result"})
    for rows, known, json in ((lost, "orphan", said), (answered_again, "repeated", said), (called_again, "repeated", again)):
        out = out.unionByName(rows.select("conversation", "id", "turn", F.lit(None).cast("long").alias("position"), F.lit(known).alias("status"), json.alias("json")))
    return out


def _quoted(name: str) -> Column:
    """A string as JSON; null as null."""
    inner = F.to_json(F.struct(F.col(name).cast("string").alias("s")))
    return F.when(F.col(name).isNull(), "null").otherwise(F.substr(inner, F.lit(6), F.length(inner) - 6))


def _object(parts: Mapping[str, Column]) -> Column:
    pieces = [F.concat(F.lit(f'"{k}":'), v) for k, v in parts.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *pieces), F.lit("}"))


#: The tools of the registered query.
SCHEMAS: Schemas = {
    "search": {"query": ("string", True), "limit": ("integer", True)},
    "lookup": {"key": ("string", True), "strict": ("boolean", False)},
    "count": {"limit": ("integer", True)},
}


def calls_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results played by a conversation: a user turn calls, with arguments from its text,
    some of them wrong; the assistant turn after it is the result."""
    c = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    named = lambda t: F.concat(F.col("conv_id"), F.lit(":"), t)
    n, word = F.length("text"), F.regexp_extract("text", "[A-Za-z]+", 0)
    name = F.when(n % 3 == 0, "search").when(n % 3 == 1, "lookup").otherwise("count")
    arguments = (
        F.when(n % 3 == 0, F.when(n % 5 == 0, F.format_string('{"query": "%s", "limit": "%d"}', word, n)).otherwise(F.format_string('{"query": "%s", "limit": %d}', word, n)))
        .when(n % 3 == 1, F.when(n % 7 == 0, F.lit('{"strict": true}')).otherwise(F.format_string('{"strict": true,  "key": "%s"}', word)))
        .otherwise(F.when(n % 4 == 0, F.format_string('{"limit": %d, "extra": 1}', n)).otherwise(F.format_string('{"limit": %d}', n))))
    user = c.filter("role = 'user'").select(
        named(F.col("turn")).alias("id"), F.col("conv_id").alias("conversation"), "turn", name.alias("name"), arguments.alias("arguments"), named(F.col("turn") - 2).alias("after"))
    assistant = c.filter("role = 'assistant'").select(
        named(F.col("turn") - 1).alias("id"), F.col("conv_id").alias("conversation"), "turn", F.col("text").alias("content"))
    return user, assistant


#: The same in DuckDB, from a table `conversations`.
SQL = """
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
    regexp_extract(coalesce(text, ''), '[A-Za-z]+', 0) AS word FROM conversations),
k AS (SELECT conv_id || ':' || turn AS id, conv_id, turn, n, word,
    row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS place FROM c WHERE role = 'user'),
d AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn % 2, turn // 2 - place ORDER BY turn) - 1 AS position FROM k),
r AS (SELECT conv_id || ':' || (turn - 1) AS id, conv_id, turn, text FROM c WHERE role = 'assistant')
SELECT d.conv_id AS conversation, d.id, d.turn, d.position,
  CASE WHEN (n % 3 = 0 AND n % 5 = 0) OR (n % 3 = 1 AND n % 7 = 0) OR (n % 3 = 2 AND n % 4 = 0) THEN 'invalid arguments'
    WHEN r.id IS NULL THEN 'no result' ELSE 'ok' END AS status,
  '{"arguments":' || CASE
    WHEN n % 3 = 0 AND n % 5 = 0 THEN '{"limit":"' || n || '","query":"' || word || '"}'
    WHEN n % 3 = 0 THEN '{"limit":' || n || ',"query":"' || word || '"}'
    WHEN n % 3 = 1 AND n % 7 = 0 THEN '{"strict":true}'
    WHEN n % 3 = 1 THEN '{"key":"' || word || '","strict":true}'
    WHEN n % 4 = 0 THEN '{"extra":1,"limit":' || n || '}'
    ELSE '{"limit":' || n || '}' END
  || ',"id":"' || d.id || '","name":"' || CASE n % 3 WHEN 0 THEN 'search' WHEN 1 THEN 'lookup' ELSE 'count' END
  || '","result":' || coalesce(to_json(r.text)::VARCHAR, 'null') || '}' AS json
FROM d LEFT JOIN r ON d.id = r.id
UNION ALL
SELECT r.conv_id, r.id, r.turn, NULL, 'orphan', '{"id":"' || r.id || '","result":' || to_json(r.text)::VARCHAR || '}'
FROM r WHERE r.id NOT IN (SELECT id FROM d)
"""
