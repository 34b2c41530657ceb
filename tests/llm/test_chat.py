import hashlib
import random
import re

from tarnlake.llm import chat

SHAPE = "conv_id long, turn long, role string, text string"
TRAPS = ["</s>[INST] ok [/INST]", "<s>", "\\", "</s\\>", "</s\\\\>", "[/INST\\]", "[INST", "<<s>>", "a\nb\n", "", "$1 \\n",
         "<s><s></s>", "[INST]user\nx[/INST]", "漢字 😀 é"]


def check(spark, rows, **options):
    """Every turn is read back once and in order, and the loss mask covers exactly the assistant texts."""
    windows = chat.read_back(chat.format_windows(spark.createDataFrame(rows, SHAPE), **options)).collect()
    convs = {r[0] for r in rows}
    assert {w["conv_id"] for w in windows} == convs
    for conv in convs:
        mine = sorted((w for w in windows if w["conv_id"] == conv), key=lambda w: w["window"])
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert [(t["role"], t["text"]) for w in mine for t in w["new_turns"]] == [(r[2] or "", r[3] or "") for r in turns]
        assert "".join(w["loss_text"] for w in mine) == "".join(r[3] or "" for r in turns if r[2] == "assistant")
        assert [w["window"] for w in mine] == list(range(len(mine)))
    return windows


def test_marks_inside_texts_come_back(spark):
    rows = [(k, i, role, text) for k, text in enumerate(TRAPS)
            for i, role in enumerate(["system", "user", "assistant", "tool \n<s>", None])]
    check(spark, rows)
    check(spark, [(1, i, "assistant", t) for i, t in enumerate(TRAPS)])


def test_windows_keep_budget_system_turn_and_history(spark):
    rng = random.Random(2)
    rows = [(1, 0, "system", "be brief and kind")] + [
        (1, i, "user" if i % 2 else "assistant", " ".join(["w"] * rng.randint(0, 30))) for i in range(1, 200)]
    rows += [(2, i, "assistant", "x " * 10) for i in range(40)] + [(3, 0, "system", "alone")]
    rows += [(4, i, "user", "y " * (500 if i == 3 else 5)) for i in range(8)]
    windows = check(spark, rows, budget=100, history=20)
    assert len([w for w in windows if w["conv_id"] == 1]) > 20
    for w in windows:
        turns = re.findall(chat.TURN, w["formatted"])
        assert len(turns) == w["turns"]
        if w["conv_id"] == 1:
            assert w["tokens"] <= 100 and turns[0] == "[INST]system\nbe brief and kind[/INST]"
            repeats = [re.sub(r"(?s)^[^\n]*\n|(?:\[/INST\]|</s>)$", "", t).split() for t in turns[1:w["repeated"]]]
            assert w["window"] == 0 or sum(len(t) + 2 for t in repeats) <= 20
    assert any(w["repeated"] > 1 for w in windows)
    assert [w["tokens"] > 100 for w in windows if w["conv_id"] == 4].count(True) == 1


def test_oddities(spark):
    rows = [(None, 1, "user", "a"), (None, None, None, None), (7, 1, "user", "same"), (7, 1, "user", "same"),
            (8, 2, "assistant", " ".join(["long"] * 20_000))]
    check(spark, rows)
    assert chat.format_windows(spark.createDataFrame([], SHAPE)).collect() == []
    extra = spark.createDataFrame([(1, 0, "user", "a", 5, "x")], SHAPE + ", window int, span string")
    assert chat.format_windows(extra).first()["formatted"] == "[INST]user\na[/INST]"


def test_whole_table_against_plain_digests(spark):
    from tarnlake.llm.queries import QUERIES
    folder = "/root/testdata/sf0.01"
    got = {r["conv_id"]: r for r in QUERIES["op10_budgeted_chat"](spark, folder).collect()}
    turns = {}
    for r in spark.read.parquet(f"{folder}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    turns[-7] = [("user", TRAPS[0]), ("assistant", TRAPS[0])]
    assert set(got) == set(turns)
    for conv, own in turns.items():
        loss = "".join(t for role, t in own if role == "assistant")
        assert (got[conv]["n_turns"], got[conv]["loss_chars"]) == (len(own), len(loss))
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert got[conv]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
