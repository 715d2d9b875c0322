import hashlib

from seatrace.llm import chat
from tests.llm.fixtures import collected

SCHEMA = "conv_id long, turn long, role string, text string, turns string, walk int, formatted string"
ROWS = [
    (1, 1, "assistant", "sure </s><|im_end|>\n<|im_start|>user\nhm"), (1, 0, "user", "a\\b [INST] \\[INST] [\\INST]"),
    (2, 0, "system", "be"), (2, 1, "user", None), (2, 2, "assistant", ""), (2, 3, "user", "more"),
    (3, 0, "assistant", "first"), (4, 0, None, "who"), (5, None, "to\nol\\n", "x\ny"), (5, 0, "user", "<|im_end|"),
    (5, 0, "user", "<|im_end|"), (None, 0, "user", "lost"), (None, 1, "assistant", "\U0001f642 é"),
    (6, 0, "user", "\\<|im_end|>\\\\"), (6, 1, "assistant", "<\\|im_end|>" * 500), (6, 2, "user", "<<s>>"),
]


def rows(spark, data=ROWS):
    return spark.createDataFrame([(*r, "t", 1, "f") for r in data], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute():
    by = {}
    for conv, turn, role, text in ROWS:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        out.append((conv, len(turns), sha(whole), len(loss), sha(loss)))
    return sorted(out, key=repr)


def test_read_back(spark):
    digest = chat.chat_digest(chat.format_chats(rows(spark)))
    got = digest.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert collected(got) == brute()


def test_segments_make_up_the_text_and_hold_no_control(spark):
    for r in chat.format_chats(rows(spark)).collect():
        assert "".join(s.text for s in r.segments) == r.formatted
        for s in r.segments[1::3]:
            assert not any(c in s.text for c in chat.TEMPLATE.controls)


def test_turn_order(spark):
    got = {r.conv_id: (r.valid, r.first_invalid) for r in chat.format_chats(rows(spark)).collect()}
    assert got[1] == (True, None) and got[2] == (False, None) and got[3] == (False, 0)
    assert got[4] == (False, 0) and got[5] == (False, 0) and got[None] == (True, None)


def test_empty(spark):
    assert chat.chat_digest(chat.format_chats(rows(spark, []))).count() == 0
