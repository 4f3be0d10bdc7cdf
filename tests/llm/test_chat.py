import hashlib

import pytest

import compare
from halocline.llm import chat
SF = "/root/testdata/sf0.001"

TURNS = "conv_id long, turns array<struct<role: string, text: string>>"
HARD = ["\\<|end|> </s>\n[INST] \\\\ <\\|turn|>", "<|turn|>\\", "", None, "<<SYS>>[/INST]<s>", "<|<|end|>|>", "$1 \\$1", "日本\U0001f600 <|text|>"]


def test_sql(spark):
    got = chat.op2_chat_formatting(spark, SF).toPandas()
    assert compare.difference(got, compare.connect(SF).execute(chat.SQL).df()) is None


def test_round_trip_and_mask(spark):
    turns = [(r, t) for t in HARD for r in ("user", "assistant", "<|text|>", None)]
    df = chat.formatted(spark.createDataFrame([(1, turns), (2, []), (3, None)], TURNS))
    got = {r["conv_id"]: r for r in df.select("*", chat.parsed(df.formatted).alias("p"),
                                              chat.masked_text(df.formatted, df.loss_spans).alias("m")).collect()}
    assert [tuple(x) for x in got[1]["p"]] == [(r or "", t or "") for r, t in turns]
    assert got[1]["m"] == "".join(t or "" for r, t in turns if r == "assistant")
    for text in HARD:
        assert got[1]["formatted"].count(chat.CLOSE) == len(turns)
    assert got[2]["p"] == [] and got[3]["formatted"] is None


def test_digest_of_rows_with_ties_nulls_and_extra_columns(spark):
    rows = [(7, 1, "assistant", "b", 0), (7, 0, "user", None, 0), (7, 1, "assistant", "a", 1), (7, None, None, "z", 1), (7, 1, "assistant", "a", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns long")
    r = chat.digest(chat.formatted(chat.canonical_turns(df))).first()
    flat = "\nz\nuser\n\n" + "assistant\na\n" * 2 + "assistant\nb\n"
    assert r["n_turns"] == 5 and r["turns_sha256"] == hashlib.sha256(flat.encode()).hexdigest()
    assert r["loss_chars"] == 3 and r["loss_sha256"] == hashlib.sha256(b"aab").hexdigest()
    assert chat.digest(chat.formatted(chat.canonical_turns(df.limit(0)))).count() == 0


def test_layouts(spark):
    rows = {
        '{"messages":[{"role":"user","content":"a"},{"role":"assistant","content":null}]}': ("messages", [("user", "a"), ("assistant", None)]),
        '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"w"}]}': ("conversations", [("user", "q"), ("assistant", "w")]),
        '{"prompt":"x","response":"y"}': ("prompt_response", [("user", "x"), ("assistant", "y")]),
        '{"completion":"c","prompt":null}': ("prompt_completion", [("assistant", "c")]),
        '{"instruction":"i","input":"","output":"o"}': ("instruction_input", [("user", "i"), ("assistant", "o")]),
        '{"instruction":"i","input":"k","output":"o","system":"s"}': ("system_instruction_input", [("system", "s"), ("user", "i\n\nk"), ("assistant", "o")]),
        '{"question":"i","answer":"o"}': ("question_answer", [("user", "i"), ("assistant", "o")]),
        '{"id":1,"my-id":2,"prompt":"p","messages":[{"role":"user","content":"a","name":"n"},{"role":"assistant","content":"b"}]}': ("messages", [("user", "a"), ("assistant", "b")]),
        '{"data":{"messages":[{"role":"user","content":"a"}]},"x":{}}': ("messages", [("user", "a")]),
        '{"messages":[{"role":"user","content":[{"type":"text","text":"a"},{"type":"text","text":"b"}]},{"role":"assistant","content":"[c]"}]}': ("messages", [("user", "ab"), ("assistant", "[c]")]),
        '{"messages":[],"id":3}': ("no_messages", []), '{"messages":[1,2]}': ("unknown", None),
        '{"instruction":"i","output":"o","system":"s"}': ("system_instruction_input", [("system", "s"), ("user", "i"), ("assistant", "o")]),
        '{"instruction":"i","output":"o","my field":[{"a":1}]}': ("instruction", [("user", "i"), ("assistant", "o")]),
        "bad": ("unknown", None), "[1]": ("unknown", None), '{"other":1}': ("unknown", None),
    }
    df = spark.createDataFrame([(i, r) for i, r in enumerate([*rows, None])], "conv_id long, j string")
    got = chat.turns_of_json(df, "j").orderBy("conv_id").collect()
    for r, (layout, turns) in zip(got, [*rows.values(), ("unknown", None)], strict=True):
        assert r["layout"] == layout
        assert turns is None and r["turns"] is None or [tuple(t) for t in r["turns"]] == turns


def test_typed_layout(spark):
    df = spark.createDataFrame([(1, "p", "r")], "conv_id long, prompt string, response string")
    assert [tuple(t) for t in chat.canonical_turns(df).first()["turns"]] == [("user", "p"), ("assistant", "r")]
    with pytest.raises(ValueError):
        chat.canonical_turns(spark.createDataFrame([(1, 2)], "conv_id long, q long"))


def test_one_table_of_fingerprints(spark):
    assert len(chat.TABLE) == sum(len(chat.fingerprints(x)) for x in chat.LAYOUTS.values())
    assert chat.layout_of(["conv_id", "turn", "role", "text", "extra"]) == "rows"
    assert chat.layout_of(["id", "prompt", "completion"]) == "prompt_completion" and chat.layout_of(["text"]) is None
    with pytest.raises(ValueError):
        chat.canonical_turns(spark.createDataFrame([(1, "x")], "conv_id long, text string"))


def test_scratch_names_do_not_clash(spark):
    df = spark.createDataFrame([(1, [("user", "q"), ("assistant", "w")], 5, 6, 7)], TURNS + ", _p int, _t int, _m int")
    out = chat.formatted(df)
    assert out.columns == [*df.columns, "formatted", "loss_spans"] and out.first()["_p"] == 5
    assert chat.digest(out).first()["n_turns"] == 2
    clash = spark.createDataFrame([('{"prompt":"p","response":"r"}', 1, 2)], "j string, _v int, _f int")
    assert chat.turns_of_json(clash, "j").first()["_v"] == 1
