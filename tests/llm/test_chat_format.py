import hashlib
import random

from pyspark.sql import functions as F

from concordat.llm import chat_format as c


def test_round_trip(spark):
    draw = random.Random(5)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "/s>", "[", "INST]", "é", "\n", " ", "s>", "\\s", "$1"]
    text = lambda: "".join(draw.choice(bits) for _ in range(draw.randrange(12)))
    convs = [[(draw.choice(("user", "assistant", "system", text())), text()) for _ in range(draw.randrange(6))] for _ in range(200)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(convs)], "i int, turns array<struct<role:string,text:string>>")
    for r in c.read_back(c.format_turns(df)).collect():
        assert [tuple(t) for t in r.read_turns] == convs[r.i]
        assert r.loss_texts == [t for role, t in convs[r.i] if role == "assistant"]
        assert r.formatted.count("[INST]") == r.formatted.count("</s>") == len(convs[r.i])
        for span, want in zip(r.loss_spans, r.loss_texts):
            part = r.formatted[span.start : span.start + span.length]
            assert part.replace("\\\\", "\0").replace("\\", "").replace("\0", "\\") == want


def test_conversations(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (None, 0, "user", "x"), (2, 0, None, "y"), (2, 0, None, "y"), (2, None, "assistant", "z")]
    df = spark.createDataFrame([(*r, "k") for r in rows], "conv_id long, turn long, role string, text string, messages string")
    found = c.read_back(c.format_turns(c.canonical_turns(c.conversation_records(df), ["messages"])))
    got = {r.conv_id: [tuple(t) for t in r.read_turns] for r in found.collect()}
    assert got == {1: [("user", ""), ("assistant", "b")], None: [("user", "x")], 2: [("assistant", "z"), ("", "y"), ("", "y")]}
    assert c.conversation_records(df.limit(0)).count() == 0


def test_layouts(spark):
    lines = [
        '{"id": 1, "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}',
        '{"id": 2, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}',
        '{"id": 3, "prompt": "q", "completion": "a"}',
        '{"id": 4, "instruction": "do", "input": "this", "output": "a"}',
        '{"id": 5, "instruction": "do", "output": "a", "system": "s"}',
        '{"id": 6, "question": "q", "answer": "a"}',
        '{"id": 7, "prompt": "only"}',
        '{"id": 8}',
    ]
    df = spark.read.json(spark.sparkContext.parallelize(lines))
    found = {r.id: r for r in c.canonical_turns(df, [x for x in df.columns if x != "id"]).collect()}
    turns = {i: [tuple(t) for t in r.turns] for i, r in found.items()}
    assert turns[1] == turns[2] == turns[3] == turns[6] == [("user", "q"), ("assistant", "a")]
    assert turns[4] == [("user", "do\n\nthis"), ("assistant", "a")] and turns[5][0] == ("system", "s")
    assert [found[i].layout for i in (1, 2, 3, 4, 7, 8)] == ["messages", "exchanges", "completion", "instruction", None, None]
    assert turns[7] == turns[8] == []
    assert found[3].fingerprint == hashlib.sha256(b"completion\nprompt").hexdigest() != found[6].fingerprint


def test_nested(spark):
    lines = [
        '{"id": 1, "messages": [{"role": "user", "content": [{"type": "text", "text": "hello"}, {"type": "image_url", "image_url": {"url": "x"}}]}]}',
        '{"id": 2, "messages": [{"role": "user", "content": [{"text": "a"}, {"text": "b"}]}, {"role": "assistant"}]}',
        '{"id": 3, "data": {"prompt": "q", "response": "a", "score": 1}}',
        '{"id": 4, "data": {"inner": {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": null}]}}}',
        '{"id": 5, "prompt": "q", "messages": [{"role": "assistant", "content": [{"type": "text", "text": "a"}]}], "turns": "t", "layout": "l"}',
        '{"id": 6, "messages": [{"role": "user", "content": null}]}',
        '{"id": 7, "messages": []}',
        '{"id": 8, "data": {"prompt": "q"}, "response": "a"}',
        '{"id": 9, "prompt": "p", "response": "r", "data": {"prompt": "q", "response": "a"}}',
    ]
    df = spark.read.json(spark.sparkContext.parallelize(lines))
    rows = c.canonical_turns(df, [x for x in df.columns if x != "id"]).collect()
    assert {r.id: (r.layout, [tuple(t) for t in r.turns]) for r in rows} == {
        1: ("messages", [("user", "hello")]),
        2: ("messages", [("user", "a\n\nb"), ("assistant", "")]),
        3: ("response", [("user", "q"), ("assistant", "a")]),
        4: ("exchanges", [("user", "q"), ("assistant", "")]),
        5: ("messages", [("assistant", "a")]),
        6: ("messages", [("user", "")]),
        7: (None, []),
        8: (None, []),
        9: ("response", [("user", "p"), ("assistant", "r")]),
    }
    assert len({r.fingerprint for r in rows}) == 9
    plain = spark.createDataFrame([(["x", None, "y"],)], "t array<string>").selectExpr("array(struct('user' AS role, t AS content)) AS messages")
    assert [tuple(t) for t in c.canonical_turns(plain, ["messages"]).first().turns] == [("user", "x\n\ny")]


def test_dealt_layouts(spark):
    draw = random.Random(8)
    roles = ("user", "assistant", "system", "human", "", "gpt")
    pairs = [[("user", f"q{i}"), ("assistant", "")] for i in range(40)]
    convs = pairs + [[(draw.choice(roles), draw.choice(("", "a\n\nb", "\n\n\n", "x", "[INST]"))) for _ in range(draw.randrange(1, 5))] for _ in range(160)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(convs)], "conv_id long, messages array<struct<role:string,content:string>>")
    records = c.dealt_records(df)
    rows = c.canonical_turns(records, [x for x in records.columns if x != "conv_id"]).collect()
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in rows} == dict(enumerate(convs))
    assert {r.layout for r in rows} == {"messages", "exchanges", "response"} and sum(r.parted is not None for r in rows) > 20
    assert len({r.fingerprint for r in rows}) >= 4


def test_wrong_spans_show(spark):
    df = spark.createDataFrame([([("user", "q"), ("assistant", "abc")],)], f"turns {c.TURNS}")
    good = c.format_turns(df)
    moved = good.withColumn("loss_spans", F.transform("loss_spans", lambda s: s.withField("start", s["start"] + 1)))
    assert (c.read_back(good).first().loss_texts, c.read_back(moved).first().loss_texts) == (["abc"], ["bc"])


def test_long_conversation(spark):
    convs = [[("assistant" if k % 2 else "user", f"é[INST]{k}") for k in range(n)] for n in (255, 256, 257, 512, 20000)] + [[("assistant", "é<s>\\" * 300_000)]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(convs)], f"i int, turns {c.TURNS}")
    for r in c.read_back(c.format_turns(df)).collect():
        assert [tuple(t) for t in r.read_turns] == convs[r.i]
        assert r.loss_texts == [t for role, t in convs[r.i] if role == "assistant"]


def test_no_turns(spark):
    df = spark.range(1).select(F.lit(None).cast("array<struct<role:string,text:string>>").alias("turns"))
    r = c.read_back(c.format_turns(df)).first()
    assert (r.formatted, r.loss_spans, r.read_turns) == ("", [], [])
