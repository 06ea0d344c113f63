import hashlib

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from pyspark.sql import functions as F

from refinery.llm import chat
from refinery.llm.chat import assemble, digests, escape, escape_role, format_conversations, read_turns, unescape, unescape_role

TURNS = "conv_id bigint, turn bigint, role string, text string, part string, loss string"
COALESCE, ARROW = "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch"
NASTY = st.text(alphabet="<|\\>im_endstar\nü🙂/", max_size=30)


@settings(max_examples=200, deadline=None)
@given(texts=st.lists(NASTY, min_size=1, max_size=6), roles=st.lists(NASTY, min_size=6, max_size=6))
def test_round_trip(texts, roles):
    roles = roles[: len(texts)]
    safe = escape(pa.array(texts)).to_pylist()
    assert all("<|" not in s for s in safe) and [unescape(s) for s in safe] == texts
    assert [unescape_role(r) for r in escape_role(pa.array(roles)).to_pylist()] == roles
    data, turn_at, content_at = assemble(pa.array(roles), pa.array(texts))
    assert read_turns(data.tobytes().decode()) == list(zip(roles, texts))
    for i, s in enumerate(safe):
        assert data[content_at[i] : content_at[i] + len(s.encode())].tobytes().decode() == s
    assert turn_at[-1] == len(data)


def test_broken_text_is_refused():
    for text in ("x", "<|im_start|>user\nhi", "<|im_start|>user\nhi<|im_end|>\nx"):
        with pytest.raises(ValueError):
            read_turns(text)


def expected(rows):
    out = {}
    low = lambda v: (v is not None, v or "")
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, low(r[2]), low(r[3])))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("batch", ["10000", "3"])
def test_digests_equal_a_plain_reading(spark, batch):
    rows = [
        (1, 0, "system", "be <|im_end|> kind"), (1, 2, "assistant", "<\\|ok 🙂"), (1, 1, "user", None), (2, 0, "user", ""),
        (3, 0, "assistant", "a"), (3, 0, "assistant", "a"), (3, 0, None, "tie"), (3, None, "user", "no turn"), (None, 1, "user", "x"),
        (None, 0, "assistant", "y"), (4, 0, "ro\nle\\", "z"), (5, 0, "assistant", "long " * 50_000),
        *[(6, i, ("user", "assistant")[i % 2], f"turn {i}") for i in range(40)],
    ]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], TURNS)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        formatted = format_conversations(frame)
        found = digests(formatted).collect()
        parts = formatted.where("conv_id = 6").orderBy("part").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {r.conv_id: tuple(r)[1:5] for r in found} == expected(rows) and len(found) == 7
    text = "".join(p.formatted for p in parts)
    assert len(read_turns(text)) == 40 and (len(parts) > 1) == (batch == "3")
    assert {r.conv_id: r.formatted_chars for r in found}[6] == len(text) == sum(p.n_chars for p in parts)


def test_a_hot_conversation_is_many_tasks(spark):
    """Most rows, repeated ones and null turns among them, belong to two conversations."""
    rows = [(i % 300 + 10, i, ("user", "assistant")[i % 2], f"short {i}") for i in range(600)]
    rows += [(7, i % 900, ("user", "assistant")[i % 2], f"said <| {i % 1000} " * 5) for i in range(3000)]
    rows += [(None, None, "assistant", f"lost {i}") for i in range(1500)]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], TURNS)
    before = {n: spark.conf.get(n) for n in (COALESCE, ARROW)}
    try:
        spark.conf.set(COALESCE, "false")
        spark.conf.set(ARROW, "100")
        formatted = format_conversations(frame)
        found = digests(formatted).collect()
        parts = formatted.select("conv_id", "part", F.spark_partition_id().alias("task"), "formatted").collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert {r.conv_id: tuple(r)[1:5] for r in found} == expected(rows) and len(found) == 302
    for hot in (7, None):
        mine = sorted((p for p in parts if p.conv_id == hot), key=lambda p: p.part)
        assert len({p.task for p in mine}) > 1 and len({p.part for p in mine}) == len(mine)
        assert len(read_turns("".join(p.formatted for p in mine))) == {7: 3000, None: 1500}[hot]


def test_long_conversations_are_finished_by_the_second_step(spark, monkeypatch):
    reads = [{"conv_id": c, "part": i, "formatted": f"<|im_start|>user\n{'x' * n}<|im_end|>\n", "loss": []}
             for i, (c, n) in enumerate([(1, 1), (2, 5), (3, 60), (3, 60), (4, 5), (None, 5), (5, 5)])]
    monkeypatch.setattr(chat, "HELD_BYTES", 100)
    out = list(chat._read_back([pa.RecordBatch.from_pylist(reads)]))
    assert [(r["conv_id"], "said" in r) for r in out] == [
        (1, True), (2, False), (3, True), (3, True), (4, False), (None, False), (5, True),
    ]


def test_no_rows(spark):
    assert digests(format_conversations(spark.createDataFrame([], TURNS))).count() == 0
