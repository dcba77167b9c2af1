"""Format conversations into budgeted windows with a loss mask, natively.

A turn is written ``[TURN]role[/TURN]text</s>``; control strings within roles and
texts are escaped by one more backslash after their first character, which is
taken off again when read. Prefix sums of the turns' tokens choose the windows:
the room that the system turn and the repeated history leave is the stride, a
turn that lies within one stride joins that stride's window, and a turn that
crosses the edge of a stride has a window of its own. Each window after the
system turn repeats that, whatever its length, and as many of the turns just
before the window as fit into the history's tokens and into what is left of the
budget. So a window keeps to its budget unless one new turn, with the system
turn, is larger; such a turn is alone with that. The loss mask covers an
assistant's text only where it is new.

All of it is DataFrame functions. Prefix sums are taken within blocks of turns
and over the sums of blocks, so a long conversation is not one task's work.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialtrail.operators.staging import staged

BUDGET = 512
HISTORY = 96
TURN_TOKENS = 4  # for the marks around a turn
BLOCK_TURNS = 256
SYSTEM, ASSISTANT = "system", "assistant"

OPEN, CLOSE, END = "[TURN]", "[/TURN]", "</s>"
# The marks above and those of common templates.
_CONTROL = r"(?:/?TURN\]|/?INST\]|/?s>|<SYS>>|</SYS>>|\|[a-z_]+\|>)"
_ESCAPE = rf"([\[<])(\\*)({_CONTROL})"
_UNESCAPE = rf"([\[<])\\(\\*)({_CONTROL})"
_TOKEN = r"[\p{L}\p{M}]{1,6}|\p{N}{1,3}|[^ \t\n\x0B\f\r\p{L}\p{M}\p{N}]"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1$2$3")


def token_count(text: Column) -> Column:
    """Words and marks: a stand-in for a tokenizer that stays in the JVM."""
    return F.regexp_count(text, F.lit(_TOKEN))


def _prefix_sums(turns: DataFrame) -> DataFrame:
    """Add ``_number``, a turn's place in its conversation from 0, and
    ``_begin``, the tokens before it."""
    inside = Window.partitionBy("_conv", "_block").orderBy("_turn", "_role", "_text", "_copy")
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = turns.withColumns(
        {
            "_number": F.row_number().over(inside) - 1,
            "_begin": F.coalesce(F.sum("_tokens").over(upto), F.lit(0)),
        }
    )
    blocks = turns.groupBy("_conv", "_block").agg(
        F.count("*").alias("_rows"), F.sum("_tokens").alias("_sum")
    )
    before = Window.partitionBy("_conv").orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = blocks.select(
        F.col("_conv").alias("_c"),
        F.col("_block").alias("_b"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_sum_before"),
    )
    same = F.col("_conv").eqNullSafe(F.col("_c")) & F.col("_block").eqNullSafe(F.col("_b"))
    return local.join(offsets, same).withColumns(
        {
            "_number": F.col("_number") + F.col("_rows_before"),
            "_begin": F.col("_begin") + F.col("_sum_before"),
        }
    ).drop("_c", "_b", "_rows_before", "_sum_before")


def format_windows(
    conversations: DataFrame,
    budget: int = BUDGET,
    history: int = HISTORY,
    token_count=token_count,
) -> DataFrame:
    """One row per window (stages data): conv_id, window (in order), formatted, loss_spans
    (start and length in code points), repeated (turns at its head that an
    earlier window had as new) and tokens.

    A conversation's system turn is the first of its turns with that role,
    wherever it stands; later ones are turns like others.
    Takes conv_id, turn, role and text; a null role or text is empty, turns with
    a null number come first, and equal numbers go by role, then text. Equal
    rows are turns of their own. A null conv_id is a conversation of its own. No
    rows give no windows. Text of a window must fit into one value.
    """
    if not 0 <= history < budget:
        raise ValueError("history leaves no room in the budget")
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.select(
        F.col("conv_id").alias("_conv"),
        F.col("turn").alias("_turn"),
        F.floor(F.col("turn") / BLOCK_TURNS).alias("_block"),
        role.alias("_role"),
        text.alias("_text"),
        F.monotonically_increasing_id().alias("_copy"),
        (token_count(text) + TURN_TOKENS).cast("bigint").alias("_tokens"),
    )
    # Three uses follow; the texts are numbered once.
    placed = staged(_prefix_sums(turns), "turns")
    system = (
        placed.filter(F.col("_role") == SYSTEM)
        .groupBy(F.col("_conv").alias("_c"))
        .agg(F.min(F.struct("_number", "_begin", "_tokens", "_text")).alias("_first"))
        .select(
            "_c",
            F.col("_first._number").alias("_system_number"),
            F.col("_first._begin").alias("_system_begin"),
            F.col("_first._text").alias("_system_text"),
            F.col("_first._tokens").alias("_system"),
        )
    )
    # Where the system turn leaves no room, each turn is a window.
    stride = F.greatest(F.lit(1), F.lit(budget - history) - F.coalesce("_system", F.lit(0)))
    first, last = F.col("_begin"), F.col("_begin") + F.col("_tokens") - 1
    number = F.floor(first / F.col("_stride"))
    crossing = (number != F.floor(last / F.col("_stride"))).cast("bigint")
    new = (
        placed.join(system, F.col("_conv").eqNullSafe(F.col("_c")), "left")
        .drop("_c")
        .withColumn("_stride", stride)
        .withColumn("window", (2 * number + crossing).cast("bigint"))
    )

    def turn(name):
        return F.struct(F.col("_number"), F.col("_role"), F.col("_text"), F.lit(name).alias("_new"))

    windows = new.groupBy("_conv", "window").agg(
        F.sort_array(F.collect_list(turn(True))).alias("_own"),
        F.min("_begin").alias("_start"),
        F.sum("_tokens").alias("_tokens"),
        *[F.first(c).alias(c) for c in ("_system", "_system_number", "_system_begin")],
        F.first("_system_text").alias("_system_text"),
    ).withColumn("_has_system", F.coalesce(F.col("_start") > F.col("_system_begin"), F.lit(False)))
    # A turn that ends by a window's start and begins no more than the tokens for
    # history before it is repeated there. Both sides meet in bins of that width.
    repeated_system = F.when(F.col("_has_system"), F.col("_system")).otherwise(0)
    room = F.greatest(F.lit(0), F.lit(budget) - F.col("_tokens") - repeated_system)
    width = max(1, history)
    starts = windows.select(
        F.col("_conv").alias("_c"),
        F.col("window").alias("_w"),
        F.col("_start"),
        F.floor(F.col("_start") / width).alias("_bin"),
        F.least(F.lit(history), room).alias("_room"),
        F.when(F.col("_has_system"), F.col("_system_number")).alias("_but"),
    )
    ends = F.col("_begin") + F.col("_tokens")
    recent = placed.filter(F.col("_tokens") <= history).select(
        "_conv",
        "_begin",
        ends.alias("_end"),
        "_tokens",
        "_number",
        "_role",
        "_text",
        F.explode(
            F.sequence(F.floor(ends / width), F.floor((F.col("_begin") + history) / width))
        ).alias("_at"),
    )
    meets = (
        F.col("_conv").eqNullSafe(F.col("_c"))
        & (F.col("_at") == F.col("_bin"))
        & (F.col("_end") <= F.col("_start"))
        & (F.col("_begin") + F.col("_room") >= F.col("_start"))
        & ~F.col("_number").eqNullSafe(F.col("_but"))
    )
    context = (
        recent.join(starts, meets)
        .groupBy(F.col("_c"), F.col("_w"))
        .agg(
            F.sort_array(F.collect_list(turn(False))).alias("_history"),
            F.sum("_tokens").alias("_history_tokens"),
        )
    )
    same = F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("window") == F.col("_w"))
    joined = windows.join(context, same, "left").drop("_c", "_w")
    head = F.when(
        F.col("_has_system"),
        F.array(
            F.struct(
                F.col("_system_number").alias("_number"),
                F.lit(SYSTEM).alias("_role"),
                F.col("_system_text").alias("_text"),
                F.lit(False).alias("_new"),
            )
        ),
    )
    kind = "array<struct<_number: bigint, _role: string, _text: string, _new: boolean>>"
    none = F.array().cast(kind)
    parts = F.concat(
        F.coalesce(head.cast(kind), none),
        F.coalesce(F.col("_history").cast(kind), none),
        F.col("_own").cast(kind),
    )
    pieces = F.transform(
        parts,
        lambda t: F.struct(
            F.concat(F.lit(OPEN), escaped(t["_role"]), F.lit(CLOSE)).alias("mark"),
            escaped(t["_text"]).alias("body"),
            (t["_new"] & (t["_role"] == ASSISTANT)).alias("learn"),
        ),
    )
    rows = joined.select(
        F.col("_conv").alias("conv_id"),
        "window",
        pieces.alias("_pieces"),
        (F.size(parts) - F.size("_own")).alias("repeated"),
        (
            F.col("_tokens") + F.coalesce("_history_tokens", F.lit(0)) + repeated_system
        ).alias("tokens"),
    )
    ends = F.transform("_pieces", lambda p: F.length(p["mark"]) + F.length(p["body"]) + len(END))
    # Starts by a running sum that keeps the last value at the end of the array.
    starts = F.aggregate(
        ends,
        F.array(F.lit(0)),
        lambda done, size: F.concat(done, F.array(F.element_at(done, -1) + size)),
    )
    spans = F.transform(
        "_pieces",
        lambda p, i: F.when(
            p["learn"],
            F.struct(
                (F.get(F.col("_starts"), i) + F.length(p["mark"])).alias("start"),
                F.length(p["body"]).alias("length"),
            ),
        ),
    )
    return rows.withColumn("_starts", starts).select(
        "conv_id",
        "window",
        F.array_join(
            F.transform("_pieces", lambda p: F.concat(p["mark"], p["body"], F.lit(END))), ""
        ).alias("formatted"),
        F.filter(spans, lambda s: s.isNotNull()).alias("loss_spans"),
        "repeated",
        "tokens",
    )


def read_back(windows: DataFrame) -> DataFrame:
    """The new turns of each window, from its formatted text alone: conv_id,
    window, turns (role and text, in order) and learnt (the unescaped text under
    the loss mask)."""
    raw = F.slice(
        F.split("formatted", END, -1),
        F.col("repeated") + 1,
        F.size(F.split("formatted", END, -1)) - 1 - F.col("repeated"),
    )
    turns = F.transform(
        raw,
        lambda t: F.struct(
            unescaped(
                F.substring(F.substring_index(t, CLOSE, 1), len(OPEN) + 1, 1 << 30)
            ).alias("role"),
            unescaped(
                t.substr(
                    F.length(F.substring_index(t, CLOSE, 1)) + F.lit(len(CLOSE) + 1),
                    F.length(t),
                )
            ).alias("text"),
        ),
    )
    learnt = F.transform(
        "loss_spans",
        lambda s: unescaped(F.col("formatted").substr(s["start"] + 1, s["length"])),
    )
    return windows.select(
        "conv_id",
        "window",
        turns.alias("turns"),
        F.array_join(learnt, "").alias("learnt"),
        F.length("formatted").alias("chars"),
    )


def conversation_digests(conversations: DataFrame) -> DataFrame:
    """What the windows hold, read back from them, one row per conversation; its
    text must fit into one value."""
    turns = F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    back = read_back(format_windows(conversations)).select(
        "conv_id",
        F.struct(
            "window",
            F.array_join(turns, "").alias("said"),
            F.size("turns").alias("n"),
            "learnt",
        ).alias("part"),
        "chars",
    )
    merged = back.groupBy("conv_id").agg(
        F.sort_array(F.collect_list("part")).alias("parts"),
        F.sum("chars").alias("formatted_chars"),
    )
    learnt = F.array_join("parts.learnt", "")
    return merged.select(
        F.col("conv_id").cast("bigint"),
        F.aggregate("parts.n", F.lit(0).cast("bigint"), lambda a, n: a + n).alias("n_turns"),
        F.sha2(F.array_join("parts.said", "").cast("binary"), 256).alias("turns_sha256"),
        F.length(learnt).cast("bigint").alias("loss_chars"),
        F.sha2(learnt.cast("binary"), 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("bigint"),
    )


# A conversation whose texts are control strings.
PROBE = "</s>[INST] ok [/INST]"


def formatted_conversations(conversations: DataFrame) -> DataFrame:
    """All conversations and number -1, whose two texts are PROBE."""
    rows = conversations.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text"
    )
    probe = conversations.sparkSession.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"),
        F.lit(PROBE).alias("text"),
    )
    return conversation_digests(rows.unionByName(probe))


# The same digests straight from the rows, and the length of the windows by their
# rule. Numbers are written out, not shared with the code above.
ORACLE_SQL = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
  from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
turns as (
  select *,
    length(regexp_replace(text, '([\[<])(\\*)(/?TURN\]|/?INST\]|/?s>|<SYS>>|</SYS>>|\|[a-z_]+\|>)', '\1\\\2\3', 'g'))
      + length(regexp_replace(role, '([\[<])(\\*)(/?TURN\]|/?INST\]|/?s>|<SYS>>|</SYS>>|\|[a-z_]+\|>)', '\1\\\2\3', 'g'))
      + 17 as chars,
    4 + len(regexp_extract_all(text,
      '[\p{L}\p{M}]{1,6}|\p{N}{1,3}|[^ \t\n\x0B\f\r\p{L}\p{M}\p{N}]')) as tokens,
    row_number() over (partition by conv_id order by turn nulls first, role, text) - 1 as n
  from rows),
placed as (
  select *, cast(sum(tokens) over (partition by conv_id order by n) as bigint) as past
  from turns),
systems as (
  select conv_id as c, tokens as system_tokens, chars as system_chars, n as system_n,
    past - tokens as system_began
  from placed where role = 'system'
  qualify row_number() over (partition by conv_id order by n) = 1),
strides as (
  select *, past - tokens as began, greatest(1, 416 - coalesce(system_tokens, 0)) as stride
  from placed left join systems on conv_id is not distinct from c),
chosen as (
  select *, 2 * (began // stride)
    + case when began // stride <> (past - 1) // stride then 1 else 0 end as w
  from strides),
windows as (
  select conv_id, w, min(began) as start, sum(chars) as own_chars, sum(tokens) as own_tokens,
    case when min(began) > any_value(system_began) then any_value(system_chars) end as head_chars,
    case when min(began) > any_value(system_began) then any_value(system_n) end as head_n,
    case when min(began) > any_value(system_began) then any_value(system_tokens) end
      as head_tokens
  from chosen group by conv_id, w),
repeats as (
  select windows.conv_id as rc, windows.w as rw, sum(chosen.chars) as repeated_chars
  from windows join chosen on windows.conv_id is not distinct from chosen.conv_id
    and chosen.past <= windows.start
    and windows.start - chosen.began
      <= least(96, greatest(0, 512 - own_tokens - coalesce(head_tokens, 0)))
    and chosen.n is distinct from windows.head_n
  group by 1, 2),
sizes as (
  select conv_id as zc, cast(sum(own_chars + coalesce(repeated_chars, 0)
    + coalesce(head_chars, 0)) as bigint)
    as formatted_chars
  from windows left join repeats on conv_id is not distinct from rc and w = rw
  group by conv_id),
digests as (
  select conv_id, count(*) as n_turns,
    sha256(string_agg(concat(role, chr(10), text, chr(10)), '' order by n)) as turns_sha256,
    cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by n) filter (where role = 'assistant'), ''))
      as loss_sha256
  from turns group by conv_id)
select conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars
from digests join sizes on conv_id is not distinct from zc"""
