import hashlib
import random
import re
from collections import defaultdict

import duckdb
import pytest
import regex
from pyspark.sql import functions as F

from dialtrail.llm import chat
from tests.compare import duck_bag, spark_bag

SCHEMA = "conv_id bigint, turn bigint, role string, text string, window string, _number int"
PARTS = ["[TURN]", "[/TURN]", "</s>", "<s>", "[INST]", "\\", "[\\INST]", "<\\\\/s>", "<<SYS>>",
         "<|im_end|>", "<", "[", "a", " word", "\n", "é", "[[INST]", "<<s>"]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def random_rows(seed, conversations=30):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        for t in range(rng.choice([1, 2, 5, 40])):
            role = rng.choice(["user", "assistant", "assistant", "tool", None, "</s>"])
            role = "system" if t == 0 and rng.random() < 0.5 else role
            size = rng.choice([0, 3, 30, 30, 200, 700])
            text = "".join(rng.choices(PARTS, k=size)) if rng.random() < 0.95 else None
            rows.append((c if c else None, t if rng.random() < 0.95 else None, role, text))
    return rows + rows[:3]


def against_sql(spark, conversations):
    duck = duckdb.connect()
    frame = conversations.select("conv_id", "turn", "role", "text").toArrow()
    duck.register("conversations", frame)
    expected = duck.sql(chat.ORACLE_SQL)
    result = chat.formatted_conversations(conversations)
    assert spark_bag(result) == duck_bag(expected)
    return result


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_tables(spark, sf):
    conversations = spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet")
    against_sql(spark, conversations)


@pytest.mark.parametrize("seed", range(3))
def test_random_control_strings(spark, seed):
    against_sql(spark, table(spark, random_rows(seed)))


def test_empty_table_keeps_the_probe(spark):
    result = against_sql(spark, table(spark, [(1, 1, "user", "x")]).limit(0)).collect()
    assert [(r.conv_id, r.n_turns, r.loss_chars) for r in result] == [(-1, 2, 21)]


def tokens_of(text):
    plain = r"[\p{L}\p{M}]{1,6}|\p{N}{1,3}|[^ \t\n\x0B\f\r\p{L}\p{M}\p{N}]"
    return 4 + len(regex.findall(plain, text))


def long_turns(seed):
    """Turns between the stride and the budget, beyond it, and system turns of
    any length anywhere."""
    rng, rows = random.Random(seed), []
    for c in range(12):
        system = rng.choice([None, 0, 0, 3, 7])
        for t in range(25):
            n = rng.choice([3, 20, 60, 110, 175, 190, 230, 240, 270, 296, 297, 400])
            role = "system" if t == system else rng.choice(["user", "assistant", "system"][: 2 + c % 2])
            rows.append((c, t, role, "ab " * (n - 4 if n > 4 else 1)))
    return rows


@pytest.mark.parametrize("seed,rows_of", [(7, random_rows), (1, long_turns), (2, long_turns)])
def test_windows_by_hand(spark, seed, rows_of):
    budget, history = 300, 60
    rows = rows_of(seed)
    formatted = chat.format_windows(table(spark, rows), budget, history)
    windows = formatted.collect()
    back = {(r.conv_id, r.window): r for r in chat.read_back(formatted).collect()}
    turns = defaultdict(list)
    for c, t, role, text in rows:
        turns[c].append((t is not None, t or 0, role or "", text or ""))
    said = defaultdict(list)
    for key in sorted(back, key=lambda k: k[1]):
        said[key[0]] += [(t.role, t.text) for t in back[key].turns]
    assert said == {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    seen, n_heads = defaultdict(int), 0
    for w in sorted(windows, key=lambda w: w.window):
        own = [(t.role, t.text) for t in back[w.conv_id, w.window].turns]
        before = said[w.conv_id][: seen[w.conv_id]]
        seen[w.conv_id] += len(own)
        system = next((t for t in before if t[0] == "system"), None)
        new = sum(tokens_of(text) for _, text in own)
        head = tokens_of(system[1]) if system else 0
        # The budget holds unless one turn, with the system turn, is larger.
        assert w.tokens <= budget or (len(own) == 1 and new + head > budget)
        room = min(history, max(0, budget - new - head))
        repeated, at = [], len(before)
        while at and sum(tokens_of(t[1]) for t in before[at - 1 :]) <= room:
            at -= 1
        repeated = [t for i, t in enumerate(before) if i >= at and i != (before.index(system) if system else -1)]
        whole = ([system] if system else []) + repeated + own
        n_heads += bool(system)
        pieces = w.formatted.split("</s>")[:-1]
        texts = [chat_text(p) for p in pieces]
        assert texts == [t[1] for t in whole] and w.repeated == len(whole) - len(own)
        assert w.tokens == sum(tokens_of(t[1]) for t in whole)
    assert n_heads > 20


def chat_text(piece):
    body = piece.split("[/TURN]", 1)[1]
    return re.sub(chat._UNESCAPE, r"\1\2\3", body)


def test_system_turns_are_retained(spark):
    """Of any length and wherever they stand."""
    long_system = "rule " * 700
    rows = [(1, 0, "system", long_system)] + [(1, t, "user", "hello " * 90) for t in range(1, 9)]
    rows += [(2, t, "system" if t == 2 else "user", "hello " * 90) for t in range(9)]
    windows = chat.format_windows(table(spark, rows)).orderBy("conv_id", "window").collect()
    heads = [(w.conv_id, w.formatted.startswith("[TURN]system")) for w in windows]
    assert heads.count((1, True)) == 9
    assert [h for c, h in heads if c == 2][0] is False and heads.count((2, True)) >= 1
    against_sql(spark, table(spark, rows))


@pytest.mark.parametrize("seed", range(2))
def test_long_turns_as_sql(spark, seed):
    against_sql(spark, table(spark, long_turns(seed)))


def test_clashing_columns(spark):
    rows = random_rows(4)
    names = ["_conv", "_turn", "_tokens", "_copy", "_block", "_text", "_role", "tokens", "_c"]
    clashing = table(spark, rows).selectExpr("*", *[f"'x' AS `{n}`" for n in names])
    against_sql(spark, clashing)


def test_budget_must_leave_room(spark):
    for history in (100, -1):
        with pytest.raises(ValueError):
            chat.format_windows(table(spark, []), 100, history)


def test_mask_marks_each_assistant_text_once(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"[INST] text {t} " * 9) for t in range(60)]
    learnt = chat.read_back(chat.format_windows(table(spark, rows))).orderBy("window").collect()
    assert len(learnt) > 3
    assert "".join(r.learnt for r in learnt) == "".join(r[3] for r in rows if r[1] % 2)


def test_no_python_in_the_plan(spark):
    conversations = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    plan = chat.formatted_conversations(conversations)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_escape_is_reversible(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 12))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", chat.escaped(F.col("t")).alias("e")
    )
    wrong = df.filter(chat.unescaped(F.col("e")) != F.col("t")).count()
    marked = df.filter(F.col("e").rlike(r"</s>|\[/?TURN\]")).count()
    assert (wrong, marked) == (0, 0)
