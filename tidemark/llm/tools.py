"""Chat formatting, tool-call linking, with DataFrame functions only.

``linked`` joins calls and results by their identifier, orders the calls of a conversation topologically, checks arguments against schemas, and
writes each call with its result as canonical JSON.

- *Linking.* Of several results with one identifier the first counts (least ``position``, then least content); ``n_results`` tells how many there are.
- *Order.* A call may name one call whose result it needs (``after_id``). Its ``layer`` is the number of calls before it on that path, found by doubling:
  each round a call takes over what its current predecessor knows, so a chain of n calls takes log2(n) joins on the identifier. Sorted by (conv_id, layer, position,
  call_id) calls come after what they need. Calls on or behind a cycle have a null layer, and a predecessor that does not exist counts as none.
  No window or group holds a whole conversation.
- *Schemas.* A schema gives each tool's arguments: name, kind (``STRING``, ``BIGINT``, ``DOUBLE``, ``BOOLEAN``), whether it must be there.
  ``problem`` is null, or ``unknown_tool``, ``not_json``, ``not_object``, ``missing:<name>``, ``kind:<name>`` or ``unexpected``, the first that applies, names in alphabetical order.
- *JSON.* Keys sorted at every level, no white space, numbers as they are; arguments that are not JSON stay as a string.

Defined cases: calls with null identifier have no results; repeated calls (equal in all columns) give a row each, and one identifier with several calls
links each to the results, while those that follow it follow the one of least conv_id, position and arguments; null arguments are ``not_json``; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

#: tool -> argument -> (kind, required)
Schemas = dict[str, dict[str, tuple[str, bool]]]


def _layers(calls: DataFrame, most_rounds: int = 64) -> DataFrame:
    """call_id and ``layer`` of distinct identifiers; null on or behind a cycle."""
    one = calls.where("call_id IS NOT NULL").groupBy("call_id").agg(F.min_by("after_id", F.struct("conv_id", "position", "arguments")).alias("after_id"))
    exists = one.select(F.col("call_id").alias("up"))
    state = staged(one.join(exists, one["after_id"] == exists["up"], "left").select("call_id", "up", F.col("up").isNotNull().cast("bigint").alias("steps")), "layers")
    n, before = state.count(), -1
    for k in range(most_rounds):
        open_ = state.where("up IS NOT NULL").count()
        if not open_ or 1 << k > 2 * n or open_ == before and 1 << k > n:
            break
        before = open_
        above = state.select(F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("steps").alias("more"))
        state = staged(state.join(above, "up", "left").select("call_id", F.col("next").alias("up"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps")), "layers")
    return state.select("call_id", F.when(F.col("up").isNull(), F.col("steps")).alias("layer"))


def _problem(schemas: Schemas) -> F.Column:
    value, kinds = F.col("parsed"), F.schema_of_variant(F.col("parsed"))
    out = F.when(~F.coalesce(F.col("name").isin(*schemas), F.lit(False)), "unknown_tool").when(value.isNull(), "not_json").when(~kinds.startswith("OBJECT<"), "not_object")
    for tool, wanted in schemas.items():
        own = F.col("name") == tool
        for name, (kind, required) in sorted(wanted.items()):
            part = F.variant_get(value, f"$.{name}", "variant")
            found = F.regexp_replace(F.schema_of_variant(part), r"^DECIMAL\(.*\)$", "DOUBLE")
            found = F.when((found == "BIGINT") & F.lit(kind == "DOUBLE"), "DOUBLE").otherwise(found)
            if required:
                out = out.when(own & part.isNull(), f"missing:{name}")
            out = out.when(own & part.isNotNull() & (found != kind), f"kind:{name}")
        keys = F.map_keys(F.from_json(F.to_json(value), "map<string,string>"))
        out = out.when(own & (F.size(F.array_except(keys, F.array(*map(F.lit, wanted)))) > 0), "unexpected")
    return out


def linked(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """For each call: conv_id, call_id, layer, position, n_results, valid, problem, json.

    ``calls``: conv_id, call_id, after_id, position, name, arguments (JSON text). ``results``: call_id, position, content.
    """
    calls = calls.select("conv_id", "call_id", "after_id", "position", "name", "arguments")
    first = results.where("call_id IS NOT NULL").groupBy("call_id").agg(
        F.count("*").alias("n_results"), F.min_by("content", F.struct(F.coalesce("position", F.lit((1 << 63) - 1)), "content")).alias("content"))
    both = calls.join(first, "call_id", "left").join(_layers(calls), "call_id", "left")
    both = both.withColumn("parsed", F.try_parse_json("arguments")).withColumn("n_results", F.coalesce("n_results", F.lit(0)))
    text = lambda c: F.regexp_extract(F.to_json(F.struct(F.coalesce(c, F.lit("")).alias("x"))), r'(?s)^\{"x":(.*)\}$', 1)  # noqa: E731  a JSON string
    maybe = lambda c: F.when(F.col(c).isNull(), "null").otherwise(text(F.col(c)))
    arguments = F.when(F.col("parsed").isNotNull(), F.to_json("parsed")).otherwise(maybe("arguments"))
    json = F.concat(F.lit('{"arguments":'), arguments, F.lit(',"id":'), maybe("call_id"), F.lit(',"name":'), maybe("name"), F.lit(',"result":'), maybe("content"), F.lit("}"))
    return both.withColumn("problem", _problem(schemas)).select(
        "conv_id", "call_id", "layer", "position", "n_results", F.col("problem").isNull().alias("valid"), "problem", json.alias("json"))


#: The schemas of the query's tools.
SCHEMAS: Schemas = {
    "lookup": {"limit": ("BIGINT", True), "query": ("STRING", True)},
    "search": {"limit": ("BIGINT", False), "query": ("STRING", True), "strict": ("BOOLEAN", True)},
}


def calls_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results derived from ``conversations``: a user's turn is a call of a tool with the text as its query, which needs the call
    two turns before; an assistant's turn is the result of the call one turn before. Every third call lacks ``strict``, every seventh is of a tool without schema."""
    name = lambda turn: F.concat_ws("_", F.lit("call"), F.col("conv_id"), turn)
    query = F.to_json(F.struct(F.col("text").alias("query"), F.when((F.col("conv_id") + F.col("turn")) % 3 != 0, F.col("turn") % 2 == 0).alias("strict"),
                               F.col("turn").alias("limit")))
    calls = conversations.where("role = 'user'").select(
        "conv_id", name(F.col("turn")).alias("call_id"), name(F.col("turn") - 2).alias("after_id"), F.col("turn").alias("position"),
        F.when(F.col("conv_id") % 7 == 0, "draw").when(F.col("turn") % 4 == 0, "search").otherwise("lookup").alias("name"), query.alias("arguments"))
    results = conversations.where("role = 'assistant'").select(name(F.col("turn") - 1).alias("call_id"), F.col("turn").alias("position"), F.col("text").alias("content"))
    return calls, results
