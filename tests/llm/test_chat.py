import hashlib

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskstream.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, mask int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_every_assistant_turn_is_an_example_and_only_it_is_trained(spark):
    rows = [(1, 0, "system", "s", 0), (1, 1, "user", "u[INST]", 0), (1, 2, "assistant", "a\\</s>", 0),
            (1, 3, "user", None, 0), (1, 4, "assistant", "", 0), (1, 5, "user", "tail", 0),
            (2, 0, "user", "alone", 0), (None, 0, None, "x", 0)]
    examples = chat.expand(spark.createDataFrame(rows, SCHEMA))
    got = [r for r in examples.orderBy("conv_id", "example").collect() if r["conv_id"] == 1]
    assert len(got) == 3
    assert [len(r["mask"]) for r in got] == [1, 1, 0]
    assert got[1]["formatted"].startswith(got[0]["formatted"])
    for r in got:
        assert r["formatted"].count("</s>") == len(chat_turns(spark, r["formatted"]))
    digest = {r["conv_id"]: r for r in chat.digests(examples).collect()}
    assert digest[1]["n_turns"] == 6
    assert digest[1]["loss_sha256"] == sha("a\\</s>")
    assert digest[2]["loss_chars"] == 0 and digest[2]["n_turns"] == 1
    assert digest[None]["turns_sha256"] == sha("\nx\n")


def chat_turns(spark, formatted):
    df = spark.createDataFrame([(formatted,)], "f string")
    return df.select(chat.turns_of(F.col("f"))).first()[0]


@given(st.lists(st.text(alphabet="<>[]/\\s INSTé😀\n$1", max_size=12), min_size=1, max_size=30))
def test_escape_is_reversible(texts):
    # The same rule in Python: a backslash after <, [ and backslash.
    import re

    for text in texts:
        escaped = re.sub(r"([<\[\\])", r"\1\\", text)
        assert not any(mark in escaped for mark in (chat.CLOSE, chat.NAMED, chat.OPEN))
        assert re.sub(r"([<\[\\])\\", r"\1", escaped) == text


def test_escape_in_spark(spark):
    texts = ["</s>[INST] ok [/INST]", "\\\\<[", "[[<<\\", "$1 \\1", "", "é😀<"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    back = df.select("t", chat.unescape(chat.escape(F.col("t"))).alias("b"), chat.escape(F.col("t")).alias("e"))
    for r in back.collect():
        assert r["b"] == r["t"]
        assert "</s>" not in r["e"] and "[INST]" not in r["e"]


def test_turn_order_ties_and_repeats(spark):
    rows = [(1, 1, "user", "b", 0), (1, 1, "assistant", "c", 0), (1, None, "user", "a", 0), (1, 1, "user", "b", 0)]
    got = chat.digests(chat.expand(spark.createDataFrame(rows, SCHEMA))).first()
    assert got["turns_sha256"] == sha("user\na\nassistant\nc\nuser\nb\nuser\nb\n")
