import hashlib
import random

from shoplens.llm import chat


def table(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, formatted int")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(((r[1] is not None, r[1] or 0), r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        spoken = "".join(f"{role}\n{text}\n" for _, role, text in own)
        loss = "".join(text for _, role, text in own if role == "assistant")
        blocks = sum(i == 0 or own[i - 1][1] != own[i][1] for i in range(len(own)))
        out[conv] = (len(own), sha(spoken), len(loss), sha(loss), blocks)
    return out


def test_read_back_equals_the_turns(spark):
    rng = random.Random(3)
    roles = ["user", "assistant", "assistant", "system", "tool", "", None, "a>b<c[d&e", "user\n", "User"]
    parts = ["</s>", "[INST]", "[/INST]", "<s>", "<+>", "<<SYS>>", "<role x>", "&lt;", "&amp;lt;", "&", "\\", "\n", "ok", "😀é", "", "]", ">"]
    rows = [(c, rng.randrange(6), rng.choice(roles), rng.choice([None, "".join(rng.choices(parts, k=rng.randrange(7)))]))
            for c in range(60) for _ in range(rng.randrange(1, 9))]
    rows += [(None, 1, "user", "x"), (None, None, "assistant", "y"), (5, 1, "user", "twice"), (5, 1, "user", "twice")]
    found = {r.conv_id: r for r in chat.report(spark, table(spark, rows)).collect()}
    expected = brute(rows + [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")])
    assert {k: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.n_blocks) for k, r in found.items()} == expected


def test_the_template(spark):
    rows = [(1, 0, "system", "S"), (1, 1, "user", "a"), (1, 2, "user", "<b>"), (1, 3, "assistant", "c"), (1, 4, "assistant", ""), (1, 5, "tool", "t")]
    r = chat.format_chats(table(spark, rows)).collect()[0]
    assert r.formatted == "<s><<SYS>>S<</SYS>>[INST]a<+>&lt;b&gt;[/INST]<a>c<+></s><role tool>t</role>"
    assert [r.formatted[s.start:s.end] for s in r.loss_spans] == ["c", ""] and r.n_blocks == 4


def test_a_long_conversation(spark):
    rows = [(1, i, ["user", "assistant"][i % 2], f"turn {i}") for i in range(3000)]
    rows += [(2, i, "user", "same") for i in range(3000)]
    found = {r.conv_id: r for r in chat.report(spark, table(spark, rows)).collect()}
    assert {k: (found[k].n_turns, found[k].turns_sha256) for k in (1, 2)} == {k: v[:2] for k, v in brute(rows).items()}
    assert found[1].n_blocks == 3000 and found[2].n_blocks == 1


def test_no_conversations(spark):
    assert [r.conv_id for r in chat.report(spark, table(spark, [])).collect()] == [-1]
