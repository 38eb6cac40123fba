import random

from riskstream.llm import token_counts
from tests.llm.helpers import by_id, docs

SIGNS = ["a", "b", "the", " ", "  ", "\n", "\t", "'s", "'ll", "don't", "é", "1", "23", "!", "…",
         "\xa0", " ", "\x1c", "\x85", "😀", "中文", ".", ",", "'"]


def test_counts_follow_any_edits():
    bpe = token_counts.encoding(token_counts.read_ranks())
    counter = token_counts.Counter(bpe)
    rng = random.Random(4)

    def some(n):
        return "".join(rng.choice(SIGNS) for _ in range(n))

    for case in range(600):
        text = some(rng.choice([0, 1, 3, 20, 300, 900]))
        tree = token_counts.Tree(text, counter)
        for _ in range(6):
            assert tree.n_tokens == len(bpe.encode_ordinary(text))
            start = rng.randint(-2, len(text) + 3)
            end = rng.choice([start, start + 1, start + rng.randint(0, 40), start - 1])
            new = some(rng.choice([0, 0, 1, 2, 30, 500 if case % 20 == 0 else 3]))
            tree.edit(start, end, new)
            first = min(max(start, 0), len(text))
            text = text[:first] + new + text[min(max(end, first), len(text)) :]
            assert tree.text() == text and tree.n_chars == len(text)


def test_only_the_touched_stretch_is_encoded_again():
    tree = token_counts.Tree("word " * 20_000, token_counts.Counter(token_counts.encoding(token_counts.read_ranks())))
    tree.edit(50_000, 50_004, "two words")
    assert tree.reencoded <= 8
    assert tree.n_tokens == token_counts.Tree(tree.text(), tree.counter).n_tokens


def test_edits_from_a_table_and_awkward_rows(spark):
    df = docs(spark, ["hello world", None, "", "same", "same"], ids=[1, 2, 3, 4, 4], extra=True)
    edits = spark.createDataFrame(
        [(1, 2, 0, 5, "goodbye"), (1, 1, 0, 0, "  "), (3, 1, 7, 3, "new"), (2, 1, None, None, None), (9, 1, 0, 0, "x")],
        "doc_id bigint, step int, start int, end int, text string",
    )
    rows = by_id(token_counts.count(token_counts.with_edits(df, edits)))
    bpe = token_counts.encoding(token_counts.read_ranks())
    # step 1 puts two blanks first, step 2 replaces the first five characters then
    assert rows[1]["n_tokens_edited"] == len(bpe.encode_ordinary("goodbyelo world"))
    assert rows[1]["n_tokens"] == len(bpe.encode_ordinary("hello world"))
    assert rows[3]["n_tokens_edited"] == len(bpe.encode_ordinary("new"))
    assert rows[2]["n_tokens"] == 0 and rows[4]["n_edits"] == 0
    assert "clash" in rows[1].asDict()


def test_every_document_against_whole_encoding(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    edited = df.withColumn("edits", token_counts.routine_edits(df["text"], df["doc_id"]))
    texts = by_id(edited)
    bpe = token_counts.encoding(token_counts.read_ranks())
    for i, r in by_id(token_counts.count(edited)).items():
        text = texts[i]["text"]
        assert r["n_tokens"] == len(bpe.encode_ordinary(text))
        for e in texts[i]["edits"]:
            start = min(max(e["start"], 0), len(text))
            text = text[:start] + e["text"] + text[min(max(e["end"], start), len(text)) :]
        assert r["n_tokens_edited"] == len(bpe.encode_ordinary(text))
