"""Conversations as training windows of a token budget, in DataFrame functions only.

Running token counts place every turn in a window of whole turns. Windows after
the first repeat the system turn and a little history; a loss mask marks each
assistant text in the one window that it belongs to. Ranks and running counts
are made in stretches of 64 turn numbers that are then moved up, so that a
conversation of any length is spread over many tasks.

A block is ``<s>role\\ntext</s>``. ``&``, ``<`` and ``[`` inside roles and texts
become entities, so that no control string can come from them, and are turned
back on reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.shared import WORDS, written

BUDGET = 512
HISTORY_TURNS = 2
HISTORY_TOKENS = 128
MARKUP = 4  # tokens counted for the marks of a block
LEAST_CELL = 16
STRETCH = 64
SYSTEM, LEARNED = "system", "assistant"
OPEN, CLOSE = "<s>", "</s>"
_ENTITIES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
_ROLE_ENTITIES = (*_ENTITIES, ("\n", "&#10;"))


def escaped(text: Column, entities=_ENTITIES) -> Column:
    for plain, entity in entities:
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def unescaped(text: Column, entities=_ENTITIES) -> Column:
    for plain, entity in reversed(entities):
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return text


def _attach(rows: DataFrame, facts: DataFrame, *keys: str) -> DataFrame:
    """``rows`` with the columns that ``facts`` has for their keys (NULL is a key)."""
    other = facts.select(*[F.col(k).alias(f"_{k}") for k in keys],
                         *[c for c in facts.columns if c not in keys])
    condition = F.lit(True)
    for k in keys:
        condition = condition & rows[k].eqNullSafe(other[f"_{k}"])
    return rows.join(other, condition).drop(*[f"_{k}" for k in keys])


def _placed(conversations: DataFrame) -> DataFrame:
    """Turns with their rank, the tokens before them and the start of their window."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), text.alias("text"),
        (F.regexp_count(text, F.lit(WORDS)) + MARKUP).cast("long").alias("tokens"),
    ).withColumn("stretch", F.floor(F.col("turn") / STRETCH))
    order = ["turn", "role", "text"]
    inside = Window.partitionBy("conv_id", "stretch").orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = turns.withColumn("rank", F.row_number().over(inside) - 1).withColumn(
        "before", F.coalesce(F.sum("tokens").over(so_far), F.lit(0)))
    stretches = turns.groupBy("conv_id", "stretch").agg(
        F.count("*").alias("n"), F.sum("tokens").alias("t"))
    earlier = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(
        Window.unboundedPreceding, -1)
    moved = stretches.select(
        "conv_id", "stretch",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_ranks"),
        F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("_tokens"))
    head = turns.groupBy("conv_id").agg(F.min(F.struct(*order, "tokens")).alias("head")).select(
        "conv_id",
        F.when(F.col("head.role") == SYSTEM, F.col("head.tokens")).otherwise(0).alias("system"))
    placed = _attach(_attach(local, moved, "conv_id", "stretch"), head, "conv_id").withColumns({
        "rank": F.col("rank") + F.col("_ranks"), "before": F.col("before") + F.col("_tokens")})
    # A window begins with each cell of running tokens, half of what the budget
    # leaves, so its turns fit unless one alone is longer than a cell; such a
    # turn begins a window too.
    cell = F.greatest(F.lit(LEAST_CELL), F.floor((BUDGET - HISTORY_TOKENS - F.col("system")) / 2))
    placed = placed.withColumns({
        "cell": F.floor(F.col("before") / cell),
        "alone": F.col("tokens") > cell,
        "is_system": (F.col("rank") == 0) & (F.col("role") == SYSTEM),
    })
    starts = placed.groupBy("conv_id", "cell", "alone").agg(F.min("rank").alias("start"))
    return _attach(placed, starts, "conv_id", "cell", "alone").select(
        "conv_id", "rank", "role", "text", "tokens", "before", "is_system", "start")


def windows(conversations: DataFrame) -> DataFrame:
    """(conv_id, start, n_repeated, formatted, loss) per window.

    ``start`` is the rank of its first own turn. The first ``n_repeated``
    blocks repeat earlier turns: the system turn and up to HISTORY_TURNS turns
    of HISTORY_TOKENS tokens together. ``loss`` lists (first, length) of the own
    assistant texts in code points. Turns go by turn, role, text; NULL comes
    first as a turn, counts as empty as a role or text, and is a conversation
    of its own as conv_id. Equal rows are equal turns.
    """
    turns = written(_placed(conversations))  # read by four branches below
    block = F.concat(F.lit(OPEN), escaped(F.col("role"), _ROLE_ENTITIES), F.lit("\n"),
                     escaped(F.col("text")), F.lit(CLOSE))
    blocks = turns.select(
        "conv_id", "rank", "before", "is_system", "start", "tokens", block.alias("block"),
        F.length(escaped(F.col("text"))).alias("n_text"),
        (F.col("role") == LEARNED).alias("learned"))
    begun = turns.groupBy("conv_id", "start").agg(F.min("before").alias("from")).where("start > 0")
    wanted = begun.withColumn("rank", F.explode(F.array(
        *[F.col("start") - k for k in range(1, HISTORY_TURNS + 1)]))).where("rank >= 0")
    columns = ["conv_id", "start", "rank", "block", "n_text", "learned"]
    history = _attach(wanted, blocks.drop("start"), "conv_id", "rank").where(
        ~F.col("is_system") & (F.col("from") - F.col("before") <= HISTORY_TOKENS))
    system = _attach(begun, blocks.where("is_system").drop("start"), "conv_id")
    repeated = history.select(columns).unionByName(system.select(columns)).withColumn(
        "learned", F.lit(False))
    rows = blocks.select(*columns, F.lit(True).alias("own")).unionByName(
        repeated.withColumn("own", F.lit(False)))
    # A window's turns are within the budget, or one long turn and its history.
    parts = F.array_sort(F.collect_list(F.struct("rank", "block", "n_text", "learned", "own")))
    none = F.array().cast("array<struct<first:int,length:int>>")
    zero = F.struct(F.lit(0).alias("at"), none.alias("loss"))

    def step(acc: Column, part: Column) -> Column:
        at = acc["at"] + F.length(part["block"])
        first = at - len(CLOSE) - part["n_text"]
        span = F.struct(first.alias("first"), part["n_text"].alias("length"))
        return F.struct(at.alias("at"), F.when(
            part["learned"], F.array_append(acc["loss"], span)).otherwise(acc["loss"]).alias("loss"))

    return rows.groupBy("conv_id", "start").agg(parts.alias("parts")).select(
        "conv_id", "start",
        F.size(F.filter("parts", lambda p: ~p["own"])).alias("n_repeated"),
        F.array_join(F.transform("parts", lambda p: p["block"]), "").alias("formatted"),
        F.aggregate("parts", zero, step, lambda acc: acc["loss"]).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, start, n_turns, turns, learned, n_chars): what windows say of
    their own turns, as role, line break, text and line break per turn, and the
    text under their loss mask."""
    every = F.split("formatted", CLOSE)
    own = F.slice(every, F.col("n_repeated") + 1, F.size(every) - 1 - F.col("n_repeated"))

    def turn(block: Column) -> Column:
        end = F.position(F.lit("\n"), block)
        role = F.substring(block, F.lit(len(OPEN) + 1), end - len(OPEN) - 1)
        text = F.substring(block, end + 1, F.length(block))
        return F.concat(unescaped(role, _ROLE_ENTITIES), F.lit("\n"), unescaped(text), F.lit("\n"))

    spans = F.transform("loss", lambda s: unescaped(
        F.substring(F.col("formatted"), s["first"] + 1, s["length"])))
    return formatted.select(
        "conv_id", "start", F.size(own).alias("n_turns"),
        F.array_join(F.transform(own, turn), "").alias("turns"),
        F.array_join(spans, "").alias("learned"), F.length("formatted").alias("n_chars"))


def digests(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)
    per conversation, read back from its windows."""
    read = read_back(windows(conversations))
    # A digest needs its conversation in one place; here it holds one row per window.
    by_conversation = read.groupBy("conv_id").agg(
        F.sum("n_turns").cast("long").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("start", "turns", "learned"))).alias("parts"),
        F.sum("n_chars").cast("long").alias("formatted_chars"))
    joined = by_conversation.select(
        "conv_id", "n_turns", F.array_join("parts.turns", "").alias("turns"),
        F.array_join("parts.learned", "").alias("learned"), "formatted_chars")
    return joined.select(
        "conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"), "formatted_chars")


CONTROL_TEXT = "</s>[INST] ok [/INST]"


def with_control(conversations: DataFrame) -> DataFrame:
    """The conversations and number -7, whose texts are control strings."""
    rows = [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)]
    extra = conversations.sparkSession.createDataFrame(
        rows, "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(extra)


def digests_sql() -> str:
    """The same digests in DuckDB SQL, from the turns themselves."""
    def grown(column: str) -> str:
        changes = "".join(f" + {len(e) - 1} * (len({column}) - len(replace({column}, '{p}', '')))"
                          for p, e in _ENTITIES)
        return f"(len({column}){changes})"
    return f"""
    WITH c AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-7, 0, 'user', '{CONTROL_TEXT}'), (-7, 1, 'assistant', '{CONTROL_TEXT}')),
    t AS (
        SELECT *, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) + {MARKUP} AS tokens,
            {grown('role')} + {grown('text')} + {len(OPEN) + 1 + len(CLOSE)} AS chars FROM c),
    r AS (
        SELECT *, row_number() OVER w - 1 AS rank,
            coalesce(sum(tokens) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
            first_value(CASE WHEN role = '{SYSTEM}' THEN tokens ELSE 0 END) OVER w AS system
        FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
    p AS (
        SELECT *, greatest({LEAST_CELL}, (({BUDGET - HISTORY_TOKENS}) - system) // 2) AS size,
            rank = 0 AND role = '{SYSTEM}' AS is_system FROM r),
    s AS (
        SELECT conv_id, min(rank) AS start, min(before) AS origin FROM p
        GROUP BY conv_id, before // size, tokens > size),
    again AS (
        SELECT p.conv_id, sum(p.chars) AS chars FROM s JOIN p ON p.conv_id = s.conv_id AND s.start > 0
        AND (p.is_system OR (p.rank < s.start AND p.rank >= s.start - {HISTORY_TURNS}
             AND s.origin - p.before <= {HISTORY_TOKENS}))
        GROUP BY p.conv_id)
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY rank)) AS turns_sha256,
        coalesce(sum(len(text)) FILTER (WHERE role = '{LEARNED}'), 0)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY rank) FILTER (WHERE role = '{LEARNED}'), '')) AS loss_sha256,
        (sum(p.chars) + coalesce(any_value(again.chars), 0))::BIGINT AS formatted_chars
    FROM p LEFT JOIN again USING (conv_id) GROUP BY conv_id"""
