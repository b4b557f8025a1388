import random

from tapelake.llm import chat_format


def test_control_strings_come_back(spark):
    r = random.Random(1)
    texts = ["".join(r.choice(["<", "|", "\\", "/", "s>", "[", "INST]", "</s>", "<|end|>", "<|start|>", "[/INST]", "a", "\n", "é"]) for _ in range(r.randint(0, 14))) for _ in range(400)]
    rows = [(i % 40, i, ["user", "assistant", "<|end|>"][i % 3], t) for i, t in enumerate(texts)]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat_format.format_chats(chats)
    back = {x["conv_id"]: [(t["role"], t["text"]) for t in x["turns"]] for x in made.select("conv_id", chat_format.read_back(made["formatted"]).alias("turns")).collect()}
    for c in range(40):
        assert back[c] == [(x[2], x[3]) for x in rows if x[0] == c]
    for x in made.collect():
        assert not any(s in x["formatted"].replace("<|start|>", "").replace("<|content|>", "").replace("<|end|>", "") for s in ("</s>", "<s>", "[INST]", "[/INST]"))
        masked = [x["formatted"][s["start"] : s["start"] + s["length"]] for s in x["loss_spans"]]
        assert len(masked) == sum(1 for y in rows if y[0] == x["conv_id"] and y[2] == "assistant")


def test_parts(spark):
    part = "array<struct<kind:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>>"
    none = dict.fromkeys(("text", "uri", "width", "height", "seconds", "pages"))
    parts = [
        none | {"kind": "text", "text": "look "},
        none | {"kind": "image", "uri": "a.png", "width": 57, "height": 28},
        none | {"kind": "text", "text": " <|image|> "},
        none | {"kind": "audio", "uri": "b.wav", "seconds": 2.0},
        none | {"kind": "document", "uri": "c.pdf", "pages": 3},
        none | {"kind": "image", "uri": "d.png"},
        none | {"kind": "video", "text": "v"},
        none | {"kind": None, "text": None},
    ]
    row = chat_format.format_chats(spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, parts {part}")).first()
    assert row["formatted"] == "<|start|>user<|content|>look <|image|> <\\|image|> <|audio|><|document|><|image|>v<|end|><|start|>assistant<|content|><|end|>"
    assert [(a["kind"], a["uri"], a["tokens"], a["place"]) for a in row["attachments"]] == [("image", "a.png", 3, 0), ("audio", "b.wav", 25, 0), ("document", "c.pdf", 3072, 0), ("image", "d.png", 256, 0)]
    assert row["expanded_tokens"] == 3 + 25 + 3072 + 256
    assert [(s["start"], s["length"]) for s in row["loss_spans"]] == [(len(row["formatted"]) - len("<|end|>"), 0)]


def test_many_turns_keep_their_places(spark):
    chats = spark.range(1200).selectExpr("1L AS conv_id", "id AS turn", "if(id % 2 = 1, 'assistant', 'user') AS role", "concat('t', id) AS text")
    row = chat_format.format_chats(chats).first()
    assert [row["formatted"][s["start"] : s["start"] + s["length"]] for s in row["loss_spans"]] == [f"t{i}" for i in range(1, 1200, 2)]
