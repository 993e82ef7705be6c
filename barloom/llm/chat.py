"""Conversations as budgeted training windows, with Spark's own functions only.

Prefix sums of turn tokens cut each conversation at turn boundaries: with B tokens for new turns, the turns that lie whole
between two multiples of B form a window, and a turn that crosses one forms a window of its own, so only a single turn longer than B goes
over the budget. A window repeats the leading system turn and a limited history of turns before it; what it repeats is context, and
the loss mask covers each assistant text in the one window where it is new.

Turns are marked <|role|>ROLE<|text|>TEXT<|end|> and a line end. Texts and roles have their backslashes doubled and a backslash put after
the first character of every control string, so no marker can stand inside a text; dropping one backslash before any character undoes it.

Defined results: a null text or role is empty; a null conv_id is a conversation of its own; null turns come first; ties of turn go by
role, then text, and repeated rows are repeated turns. An empty table gives no rows. Further columns are ignored. A text is kept whole
however long. A digest is one value a conversation, so its turns meet in one row; windows are as small as the budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Tokens of a window; the part of it for repeated turns; the most turns that are repeated besides the system turn.
BUDGET = 1024
HISTORY_TOKENS = 256
HISTORY_TURNS = 2
ROLE, TEXT, END = "<|role|>", "<|text|>", "<|end|>\n"
#: Fixed control strings of common templates: the first character, then what may follow it.
CONTROL = r"(<)(?=\||/?s>|</?SYS>>)|(\[)(?=/?INST\])"
#: A token estimate that needs no vocabulary: a run of ASCII letters and digits, or any other visible character.
TOKEN = r"[0-9A-Za-z]+|[^0-9A-Za-z\x00-\x20]"
#: Tokens of a turn's marks.
MARK_TOKENS = 3


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, "$1$2\\\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _marked(turn: Column) -> Column:
    return F.concat(F.lit(ROLE), escaped(turn["role"]), F.lit(TEXT), escaped(turn["text"]), F.lit(END))


def formatted_windows(conversations: DataFrame, budget: int = BUDGET, history_tokens: int = HISTORY_TOKENS, history_turns: int = HISTORY_TURNS) -> DataFrame:
    """conversations(conv_id, turn, role, text) to (conv_id, window, text, repeated, tokens, loss): repeated is the number of leading
    turns that an earlier window has already; loss an array of (start, end) in code points of text, end exclusive."""
    turns = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    turn = F.struct("role", "text", "tokens")
    turns = turns.withColumn("tokens", F.regexp_count("text", F.lit(TOKEN)) + MARK_TOKENS).withColumn("place", F.row_number().over(order)).withColumn("start", F.sum("tokens").over(order) - F.col("tokens"))
    turns = turns.withColumn("system", F.first(F.when(F.col("role") == "system", turn)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    lead = F.coalesce(F.col("system.tokens"), F.lit(0))
    room = F.greatest(F.lit(budget - history_tokens) - lead, F.lit(1))
    own = (F.col("place") > 1) | F.col("system").isNull()  # every turn but a leading system turn
    turns = turns.withColumn("own", own).withColumn("cell", F.when(own, F.struct(F.floor((F.col("start") - lead) / room), F.floor((F.col("start") - lead + F.col("tokens") - 1) / room))))
    new = (F.col("place") == 1) | (F.lag("own").over(order) & (F.col("cell") != F.lag("cell").over(order)))
    turns = turns.withColumn("new", new)
    past, total = [], F.lit(0)
    for k in range(1, history_turns + 1):  # the nearest turns whose sum is within the tokens for history
        total = total + F.when(F.coalesce(F.lag("own", k).over(order), F.lit(False)), F.lag("tokens", k).over(order)).otherwise(F.lit(history_tokens + 1))
        past.insert(0, F.when(F.col("new") & (total <= history_tokens), F.lag(F.struct("role", "text"), k).over(order)))
    turns = turns.withColumn("past", F.when(F.col("new"), F.array_compact(F.array(*past)))).withColumn("window", F.sum(F.col("new").cast("int")).over(order))
    windows = turns.groupBy("conv_id", "window").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "role", "text"))), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("fresh"),
        F.first("past", ignorenulls=True).alias("past"), F.sum("tokens").alias("tokens"), F.first("system").alias("system"))
    again = F.when((F.col("window") > 1) & F.col("system").isNotNull(), F.array(F.struct("system.role", "system.text"))).otherwise(F.filter("past", lambda t: F.lit(False)))
    windows = windows.withColumn("context", F.when(F.col("window") > 1, F.concat(again, "past")).otherwise(F.filter("past", lambda t: F.lit(False))))
    head = F.array_join(F.transform("context", _marked), "")

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + F.length(F.concat(F.lit(ROLE), escaped(t["role"]), F.lit(TEXT)))
        end = start + F.length(escaped(t["text"]))
        return F.struct((end + len(END)).alias("at"), F.when(t["role"] == "assistant", F.concat(acc["loss"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(acc["loss"]).alias("loss"))

    none = F.expr("cast(array() as array<struct<start:int,end:int>>)")
    loss = F.aggregate("fresh", F.struct(F.length("head").alias("at"), none.alias("loss")), step, lambda acc: acc["loss"])
    return windows.withColumn("head", head).select("conv_id", "window", F.concat("head", F.array_join(F.transform("fresh", _marked), "")).alias("text"), F.size("context").alias("repeated"), "tokens", loss.alias("loss"))


def read_back(windows: DataFrame) -> DataFrame:
    """formatted_windows()'s rows to one row a conversation, from the formatted texts alone: the turns that aren't repeated, and what the masks cover."""
    parts = F.transform(F.slice(F.split("text", r"<\|role\|>", -1), F.col("repeated") + 2, F.size(F.split("text", r"<\|role\|>", -1))), lambda p: F.split(F.regexp_replace(p, r"<\|end\|>\n\z", ""), r"<\|text\|>", -1))
    turns = F.array_join(F.transform("parts", lambda p: F.concat(unescaped(p[0]), F.lit("\n"), unescaped(p[1]), F.lit("\n"))), "")
    covered = F.array_join(F.transform("loss", lambda s: unescaped(F.substr("text", s["start"] + 1, s["end"] - s["start"]))), "")
    rows = windows.withColumn("parts", parts).select("conv_id", "window", F.size("parts").alias("n"), turns.alias("turns"), covered.alias("covered"), F.length("text").alias("chars"))
    joined = lambda name: F.array_join(F.transform("w", lambda x: x[name]), "")
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("window", "turns", "covered"))).alias("w"), F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"))
    return whole.select("conv_id", "n_turns", F.sha2(joined("turns"), 256).alias("turns_sha256"), F.length(joined("covered")).cast("long").alias("loss_chars"), F.sha2(joined("covered"), 256).alias("loss_sha256"), "formatted_chars")


#: The same digest in SQL, over a view `conversations`; formatted_chars by the lengths of what each window holds.
SQL = f"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER w AS place,
    len(regexp_extract_all(coalesce(text, ''), '{TOKEN}')) + {MARK_TOKENS} AS tokens
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, ''))),
e AS (
  SELECT *, length(role) + length(text) + len(regexp_extract_all(role || chr(10) || text, '\\\\|<\\||</?s>|<</?SYS>>|\\[/?INST\\]')) + {len(ROLE + TEXT + END)} AS chars,
    sum(tokens) OVER o - tokens AS start, bool_or(place = 1 AND role = 'system') OVER (PARTITION BY conv_id) AS led,
    coalesce(sum(tokens) FILTER (place = 1 AND role = 'system') OVER (PARTITION BY conv_id), 0) AS lead
  FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY place)),
s AS (SELECT *, place > 1 OR NOT led AS own, greatest({BUDGET - HISTORY_TOKENS} - lead, 1) AS room FROM e),
k AS (SELECT *, CASE WHEN own THEN floor((start - lead) / room) END AS a, CASE WHEN own THEN floor((start - lead + tokens - 1) / room) END AS b FROM s),
f AS (
  SELECT *, place = 1 OR (coalesce(lag(own) OVER o, false) AND (a <> lag(a) OVER o OR b <> lag(b) OVER o)) AS fresh,
    CASE WHEN lag(own, 1) OVER o AND lag(tokens, 1) OVER o <= {HISTORY_TOKENS} THEN lag(chars, 1) OVER o ELSE 0 END
    + CASE WHEN lag(own, 1) OVER o AND lag(own, 2) OVER o AND lag(tokens, 1) OVER o + lag(tokens, 2) OVER o <= {HISTORY_TOKENS} THEN lag(chars, 2) OVER o ELSE 0 END
    + CASE WHEN led THEN first(chars) OVER o ELSE 0 END AS again
  FROM k WINDOW o AS (PARTITION BY conv_id ORDER BY place))
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(chars) + coalesce(sum(again) FILTER (fresh AND place > 1), 0))::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""
