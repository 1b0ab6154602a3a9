import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from foliomill.llm import chat

SAID = ["</s>[INST] ok [/INST]", "<\\s> \\[\\INST] [\\/INST]", "", "a\nb", "é日😀", "<", "[", "\\", "<s", "[/INST", "</s>\n<s>[INST] user [/INST] "]


def rows(spark, data):
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string, formatted string")


def expected(own):
    turns = [(r or "", t or "") for _, _, r, t, _ in own]
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_round_trip_of_control_strings_ties_nulls_and_repeats(spark):
    data = [(1, i, ("user", "assistant")[i % 2], t, "x") for i, t in enumerate(SAID)]
    data += [(2, 0, None, None, None), (2, 0, None, None, None), (None, 1, "user", "lost", None), (None, 0, "assistant", None, None), (3, None, "assistant", "first", None), (3, 0, "system", "second", None)]
    data += [(4, 5, "</s>", "role", None), (5, 1, "assistant", "b", None), (5, 1, "assistant", "a", None)]
    got = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(rows(spark, data).repartition(5))).collect()}
    key = lambda x: tuple((v is not None, v if v is not None else 0) for v in (x[1],)) + ((x[2] is not None, x[2] or ""), (x[3] is not None, x[3] or ""))
    for conv in (1, 2, None, 3, 4, 5):
        own = sorted((x for x in data if x[0] == conv), key=key)
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == expected(own)


def test_loss_spans_hold_assistant_texts_only(spark):
    done = chat.format_conversations(rows(spark, [(1, 0, "user", "é?", None), (1, 1, "assistant", "日本 </s>", None), (1, 2, "assistant", "ok", None)])).first()
    spans = [done["formatted"][a:b] for a, b in zip(done["loss_begin"], done["loss_end"], strict=True)]
    assert [chat.unescaped(x) for x in spans] == ["日本 </s>", "ok"]
    assert done["formatted"].count(chat.CLOSE) == 3


def test_empty_table(spark):
    assert chat.digests(chat.format_conversations(rows(spark, []))).count() == 0


def test_conversations_across_batches(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 200)
    data = [(i // 7, i % 7, "assistant", f"text {i} " * 5, None) for i in range(700)]
    got = chat.format_conversations(rows(spark, data)).collect()
    assert len(got) == 100 and all(r["n_turns"] == 7 for r in got)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>[]/\\sINST a", max_size=30))
def test_escape_is_reversible(text):
    import pyarrow as pa

    hidden = chat.escaped(pa.array([text]))[0].as_py()
    assert chat.unescaped(hidden) == text
    assert not any(c in hidden for c in ("<s>", "</s>", "[INST]", "[/INST]"))


@pytest.mark.parametrize("text", SAID)
def test_turns_are_read_back(text):
    import numpy as np
    import pyarrow as pa

    formatted, _, _ = chat.assembled(pa.array(["user", text]), pa.array([text, "x"]), np.array([0]))
    assert chat.turns(formatted[0].as_py()) == [("user", text), (text, "x")]
