import hashlib

from pyspark.sql import functions as F

from tests.llm.frames import prose, rows_of, with_clashes
from tradeloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def conversations():
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello & <s>[INST]")]
    rows += [(2, i, ("user", "assistant")[i % 2], prose(i, 30 + 11 * (i % 5))) for i in range(400)]
    rows += [(3, i, ("system", "user", "assistant")[i if i < 1 else 1 + i % 2], prose(i, 200)) for i in range(30)]
    rows += [(4, 0, "user", prose(4, 5000)), (4, 1, "assistant", prose(5, 3000)), (4, 2, "user", "")]
    rows += [(5, None, None, None), (5, None, "assistant", "null turn"), (5, 3, "assistant", None), (5, 3, "tool\nx<y", "t")]
    rows += [(None, 0, "user", "nobody"), (None, 1, "assistant", "</s>&lt;&amp;&#91;[/INST]")]
    rows += [(6, 0, "assistant", "same")] * 3 + [(7, 900_000, "user", ""), (7, -4, "assistant", "ünï 日本 🙂")]
    return rows


def ordered(conv):
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    return sorted((r for r in conversations() if r[0] == conv), key=key)


def test_read_back_equals_the_turns(spark):
    frame = with_clashes(spark.createDataFrame(conversations(), SCHEMA), "start", "tokens", "loss")
    found = rows_of(chat.digests(frame), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    wanted = []
    for conv in {r[0] for r in conversations()}:
        turns = ordered(conv)
        text = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        wanted.append((conv, len(turns), digest(text), len(loss), digest(loss)))
    assert found == sorted(wanted, key=lambda r: tuple((x is not None, x) for x in r))


def test_windows_keep_the_budget_and_repeat_little(spark):
    frame = spark.createDataFrame(conversations(), SCHEMA)
    windows = chat.windows(frame).withColumn("n_own", F.size(F.split("formatted", chat.CLOSE)) - 1 - F.col("n_repeated"))
    rows = windows.collect()
    assert sum(r.conv_id == 2 for r in rows) > 20
    for r in rows:
        blocks = r.formatted.split(chat.CLOSE)[:-1]
        tokens = sum(len(b.split("\n", 1)[1].split()) + chat.MARKUP for b in blocks)
        assert r.n_own >= 1 and r.n_repeated <= 1 + chat.HISTORY_TURNS
        assert tokens <= chat.BUDGET or r.n_own == 1
        if r.conv_id == 3:
            assert blocks[0].startswith("<s>system\n")
        for span in r.loss:
            assert "<s>assistant\n" == r.formatted[span.first - 13:span.first]
            assert r.formatted[span.first + span.length:][:4] == chat.CLOSE
    assert all(r.n_repeated > 0 for r in rows if r.conv_id == 2 and r.start > 1)


def test_control_strings_are_escaped(spark):
    frame = chat.with_control(spark.createDataFrame([], SCHEMA))
    row = chat.windows(frame).first()
    assert row.conv_id == -7 and row.formatted.count("</s>") == 2 and "[INST]" not in row.formatted
    got = chat.digests(frame).first()
    assert got.n_turns == 2 and got.loss_chars == len(chat.CONTROL_TEXT)
    assert got.loss_sha256 == hashlib.sha256(chat.CONTROL_TEXT.encode()).hexdigest()


def test_empty(spark):
    assert chat.digests(spark.createDataFrame([], SCHEMA)).collect() == []
