import hashlib
import json

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import chat
from tidemark.llm.queries import PLANTED_CHAT, op1_chat_formatting

SF_DIR = "/root/testdata/sf0.001"


@given(st.text() | st.text(alphabet="\\<>blg/turn "))
def test_escape_is_reversible_and_frees_no_mark(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not set("<>") & set(chat.escape(text))


def test_query_equals_brute_force(spark):
    said = {}
    for row in spark.read.parquet(f"{SF_DIR}/conversations.parquet").collect():
        said.setdefault(row.conv_id, []).append((row.turn, row.role, row.text or ""))
    said[-7] = [(0, "user", PLANTED_CHAT), (1, "assistant", PLANTED_CHAT)]
    found = {row.conv_id: row for row in op1_chat_formatting(spark, SF_DIR).collect()}
    assert set(found) == set(said)
    for conv_id, turns in said.items():
        turns.sort()
        loss = "".join(text for _, role, text in turns if role == "assistant")
        digest = hashlib.sha256("".join(f"{role}\n{text}\n" for _, role, text in turns).encode()).hexdigest()
        row = found[conv_id]
        assert (row.n_turns, row.turns_sha256, row.loss_chars) == (len(turns), digest, len(loss))
        assert row.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def _turns(spark, *records):
    rows = spark.createDataFrame(list(enumerate(records)), "id int, record string")
    return [(r.layout, r.turns and [tuple(t) for t in r.turns]) for r in chat.canonical_turns(rows).orderBy("id").collect()]


def test_layouts_by_their_field_paths(spark):
    found = _turns(
        spark,
        json.dumps({"messages": [{"content": "a", "role": "user"}, {"role": "assistant", "content": "b"}]}),
        json.dumps({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}),
        json.dumps({"completion": "b", "prompt": "a"}),
        json.dumps({"prompt": "a", "system": "s", "completion": "b"}),
        json.dumps({"instruction": 12, "output": True}),
    )
    pair = [("user", "a"), ("assistant", "b")]
    assert found == [
        ("messages", pair),
        ("conversations", pair),
        ("prompt", pair),
        ("prompt_system", [("system", "s"), *pair]),
        ("instruction", [("user", "12"), ("assistant", "true")]),
    ]


def test_odd_records(spark):
    found = _turns(
        spark,
        None,
        "no json",
        "{}",
        json.dumps({"prompt": "a"}),
        json.dumps({"prompt": None, "completion": "b"}),
        json.dumps({"messages": [{"role": None, "content": None}, {"role": "user", "content": "x"}]}),
    )
    assert found[:4] == [(None, None)] * 4
    assert found[4:] == [("prompt", [("user", ""), ("assistant", "b")]), ("messages", [("", ""), ("user", "x")])]


def test_loss_spans_cover_what_assistants_say(spark):
    turns = [("user", "a<b"), ("assistant", "\\</turn>\n😀"), ("assistant", ""), ("as<si>stant", "x"), ("assistant", "end")]
    rows = spark.createDataFrame([(1, turns), (2, []), (3, None)], "id int, turns array<struct<role:string,text:string>>")
    one, two, three = chat.read_chats(chat.format_chats(rows)).orderBy("id").collect()
    assert [tuple(t) for t in one.read_turns] == turns
    assert one.loss_text == "\\</turn>\n😀end"
    assert len(one.loss_spans) == 3
    assert (two.formatted, two.loss_spans, two.read_turns) == ("", [], [])
    assert three.formatted is None


def test_roles_stay_as_they_are(spark):
    """Also where a layout has names of its own for the usual roles."""
    for roles in (["system", "user", "assistant", "user"], ["system", "gpt", "human", None], ["bot"], ["user", "assistant", ""]):
        rows = spark.createDataFrame([(1, i, role, f"t{i}") for i, role in enumerate(roles)], "conv_id long, turn long, role string, text string")
        read = chat.read_chats(chat.format_chats(chat.canonical_turns(chat.as_records(rows)))).first()
        assert [tuple(turn) for turn in read.read_turns] == [(role or "", f"t{i}") for i, role in enumerate(roles)]


def test_long_conversation_and_empty_table(spark):
    rows = spark.range(5000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"), F.lit("<x>" * 40).alias("text"))
    read = chat.read_chats(chat.format_chats(chat.canonical_turns(chat.as_records(rows)))).first()
    assert len(read.read_turns) == 5000 and read.loss_text == "<x>" * 40 * 5000
    assert chat.as_records(rows.limit(0)).count() == 0


def test_very_long_texts_and_conversations(spark):
    """A text longer than a VARIANT takes, and a record that is read like one."""
    text = F.concat(F.lit('a"\\\n{"x": "'), F.repeat(F.lit("<é😀"), F.lit(7_000_000)))
    rows = [F.struct(F.lit(i).cast("long").alias("conv_id"), F.lit(t).cast("long").alias("turn"), F.lit(role).alias("role"), said.alias("text"))
            for i, turns in enumerate([[("user", F.lit("q")), ("assistant", text)], [("bot", text), (None, F.lit(None).cast("string"))], [("user", F.lit("q\n")), ("assistant", F.lit("r"))]])
            for t, (role, said) in enumerate(turns)]
    rows = spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    found = chat.canonical_turns(chat.as_records(rows)).withColumn("t", F.explode("turns"))
    same = found.select("conv_id", "layout", "t.role", F.length("t.text").alias("n"), (F.col("t.text") == text).alias("same")).collect()
    assert sorted((r.conv_id, r.layout, r.role, r.n, r.same) for r in same) == [
        (0, "instruction", "assistant", 21_000_011, True),
        (0, "instruction", "user", 1, False),
        (1, "messages", "", 0, False),
        (1, "messages", "bot", 21_000_011, True),
        (2, "prompt", "assistant", 1, False),
        (2, "prompt", "user", 2, False),
    ]


def test_values_are_read_alike_at_every_length(spark):
    """Numbers, truth values, escapes and nested values, in records below and above what a VARIANT takes."""
    for value, text in (("1.0", "1.0"), ("1.50", "1.5"), ("12", "12"), ("true", "true"), ('"a\\u00e9\\n\\""', 'aé\n"'), ('{"x": [1, "b"]}', None)):
        short = _turns(spark, '{"prompt": %s, "completion": "x"}' % value)
        if text is not None:
            assert short == [("prompt", [("user", text), ("assistant", "x")])]
        else:
            assert short == [(None, None)]
    record = F.concat(F.lit('{"prompt": 1.50, "id": 7, "completion": "'), F.repeat(F.lit("y"), F.lit(21_000_000)), F.lit('"}'))
    long = chat.canonical_turns(spark.range(1).select(record.alias("record"))).first()
    assert long.layout == "prompt" and long.turns[0].text == "1.5" and len(long.turns[1].text) == 21_000_000


def test_layouts_with_more_than_the_plain_fields(spark):
    pair = [("user", "a"), ("assistant", "b")]
    messages = [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]
    told = [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]
    cases = [
        ({"id": 1, "messages": [{**m, "weight": 0.5, "calls": [{"name": "f", "args": {"x": [1]}}]} for m in messages], "meta": {"source": "s", "tags": ["t"]}}, "messages", pair),
        ({"messages": []}, "messages", []),
        ({"conversations": [], "id": 3}, "conversations", []),
        ({"messages": messages, "system": "s"}, "messages_system", [("system", "s"), *pair]),
        ({"system": None, "conversations": told}, "conversations_system", [("system", ""), *pair]),
        ({"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "c"}]}, {"role": "assistant", "content": [{"text": "b"}]}]},
         "messages_pieces", [("user", "a\nc"), ("assistant", "b")]),
        ({"data": {"messages": messages, "lang": "en"}, "split": "train"}, "messages_inside", pair),
        ({"instruction": "a", "input": "c", "output": "b"}, "instruction_input", [("user", "a\n\nc"), ("assistant", "b")]),
        ({"instruction": "a", "input": "", "output": "b", "id": "7", "score": 1.5}, "instruction_input", pair),
        ({"prompt": "a", "completion": "b", "meta": {"prompt": "no"}}, "prompt", pair),
        ({"prompt": "a", "completion": "b", "a list": [[1], [2]], "x": [{"role": "r"}]}, "prompt", pair),
        ({"messages": [{"role": "user"}, {"role": "assistant", "content": "b", "name": "n"}]}, "messages", [("user", ""), ("assistant", "b")]),
        ({"prompt": "a", "completion": "b", "output": "c"}, None, None),  # two answers: no layout has both
        ({"role": "user", "content": "a"}, None, None),
    ]
    assert _turns(spark, *[json.dumps(record) for record, _, _ in cases]) == [(name, turns) for _, name, turns in cases]
    assert _turns(spark, '{"prompt": "a", "prompt": "c", "completion": "b"}', '{"\\u0070rompt": "a", "completion": "b"}') == [(None, None)] * 2


def test_other_columns_stay(spark):
    record = json.dumps({"prompt": "a", "completion": "b"})
    names = ["work_", "WORK__", "turns__", "made__", "read__", "doc__", "record"]
    rows = spark.createDataFrame([("1", "2", "3", "4", "5", "6", record)], ", ".join(f"`{name}` string" for name in names))
    done = chat.read_chats(chat.format_chats(chat.canonical_turns(rows.withColumns({"layout": F.lit(9), "loss_text": F.lit(8)}))))
    assert sorted(done.columns) == sorted([*names, "layout", "turns", "formatted", "loss_spans", "read_turns", "loss_text"])
    row = done.first()
    assert [row[name] for name in names[:6]] == ["1", "2", "3", "4", "5", "6"]
    assert (row["layout"], row["loss_text"]) == ("prompt", "b")


def test_rows_without_a_conversation_are_one(spark):
    rows = spark.createDataFrame([(None, 0, "user", "a", 1), (None, 1, "assistant", "b", 2)], "conv_id long, turn long, role string, text string, t int")
    assert [(r.conv_id, r.layout) for r in chat.canonical_turns(chat.as_records(rows)).collect()] == [(None, "instruction")]
