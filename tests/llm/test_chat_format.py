import random
import re

from cellkpi.llm import chat_format as chat


def test_escaping_is_reversible():
    rng = random.Random(4)
    signs = ["\\", "<", "|", "<|", "s>", "</s>", "[INST]", "[/", "INST]", "<<SYS>>", "turn|>", "<|end|>", "a"]
    for _ in range(5000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 8)))
        shown = chat.escape(text)
        assert chat.unescape(shown) == text
        assert not re.search(r"<\||</?s>|\[/?INST\]|<</?SYS>>", shown)


def test_parts_are_flattened_in_order():
    f = chat.Flattener()
    f.turn("user", [{"type": "text", "text": "see <|x"}, {"type": "image", "ref": "a.png", "width": 57, "height": 28}, None,
                    {"type": "audio", "ref": "b.wav", "seconds": 1.1}, {"type": None, "text": "!"}])
    f.turn("assistant", [{"type": "document", "ref": None, "pages": 2}, {"type": "text", "text": "ok"}, {"type": "odd", "text": None}])
    row = f.row(5)
    assert chat.read_turns(row["formatted"]) == [
        ("user", "see <|x<|image_1|><|audio_2|>!"), ("assistant", "<|document_3|>ok")]
    assert [row["formatted"][a["start"]:a["end"]] for a in row["attachments"]] == ["<|image_1|>", "<|audio_2|>", "<|document_3|>"]
    assert [(a["kind"], a["ref"], a["turn"], a["tokens"]) for a in row["attachments"]] == [
        ("image", "a.png", 0, 3), ("audio", "b.wav", 0, 28), ("document", None, 1, 1536)]
    assert row["attachment_tokens"] == 1567
    assert [row["formatted"][m["start"]:m["end"]] for m in row["loss_mask"]] == ["<|document_3|>ok"]


def test_conversations(spark):
    rows = [(1, 1, "assistant", "b</s>"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, None, None, None), (None, 2, "user", "x"),
            (2, 0, "assistant", ""), (3, None, "user", "first"), (3, 0, "a\\b<|turn|>", "second")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS formatted", "2 AS nid")
    out = {r.conv_id: r for r in chat.format_conversations(df.repartition(3)).collect()}
    assert {k: chat.read_turns(r.formatted) for k, r in out.items()} == {
        1: [("user", "a"), ("user", "a"), ("assistant", "b</s>")], None: [("", ""), ("user", "x")],
        2: [("assistant", "")], 3: [("user", "first"), ("a\\b<|turn|>", "second")]}
    assert out[1].n_turns == 3
    digest = {r.conv_id: r for r in chat.digests(chat.format_conversations(df)).collect()}
    assert (digest[1].loss_chars, digest[1].n_turns, digest[1].formatted_chars) == (5, 3, len(out[1].formatted))
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_typed_content_column(spark):
    rows = [(1, 0, "user", None, [("text", "look", None, None, None, None, None), ("image", None, "r", 28, 28, None, None)])]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, text string, content array<{chat.PART}>")
    r = chat.format_conversations(df).first()
    assert chat.read_turns(r.formatted) == [("user", "look<|image_1|>")] and r.attachments[0].tokens == 1


def test_many_turns_of_one_conversation(spark):
    df = spark.range(3000).selectExpr("7L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "string(id) AS text")
    r = chat.format_conversations(df).first()
    assert [t for _, t in chat.read_turns(r.formatted)] == [str(i) for i in range(3000)]
