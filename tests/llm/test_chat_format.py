import hashlib
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from edge import LONG
from tablework.llm import chat_format as C
from tablework.llm.common import handover

SCHEMA = "conv_id long, turn long, role string, text string"
PARTS = list("#<>/turn\\: é日\n") + ["</turn>", "###", "\\", "</turn>\n", "### assistant: ", ": "]


def escaped(s, colons):
    out = ""
    for i, ch in enumerate(s):
        if ch == "\\" or (colons and ch == ":") or (ch == "#" and s[max(0, i - 2):i] == "##") or (ch == "/" and i and s[i - 1:i + 6] == "</turn>"):
            out += "\\"
        out += ch
    return out


def formatted(turns):
    return "".join(f"### {escaped(r, True)}: {escaped(t, False)}</turn>\n" for r, t in turns)


def conversations(rows):
    out = {}
    for c, t, role, text in rows:
        out.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in out.items()}


def figures(rows):
    out = []
    for c, turns in conversations(rows).items():
        loss = "".join(t for r, t in turns if r == "assistant")
        lines = "".join(f"{r}\n{t}\n" for r, t in turns)
        out.append((c, len(turns), hashlib.sha256(lines.encode()).hexdigest(), len(loss),
                    hashlib.sha256(loss.encode()).hexdigest(), len(formatted(turns))))
    return sorted(out, key=str)


def random_rows(seed, n, convs=6):
    rnd = random.Random(seed)

    def text():
        return rnd.choice([None, "", "".join(rnd.choices(PARTS, k=rnd.randint(1, 30)))])

    return [(rnd.choice([None, *range(convs)]), rnd.choice([None, 0, 1, 2, 3]), rnd.choice([None, "user", "assistant", text()]), text())
            for _ in range(n)]


def read(spark, rows):
    return sorted((tuple(r) for r in C.round_trip(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)


def test_bytes_equal_plain_strings():
    rnd = random.Random(1)
    for _ in range(200):
        turns = [("".join(rnd.choices(PARTS, k=rnd.randint(0, 8))), "".join(rnd.choices(PARTS, k=rnd.randint(0, 20)))) for _ in range(5)]
        buffer, ends, start, stop = C.assemble(pa.array([r for r, _ in turns]), pa.array([t for _, t in turns]))
        assert buffer.tobytes().decode() == formatted(turns)
        cuts = np.array([0, ends[1], ends[4]])
        n, lines, cut, masked, mask_cut = C.decode(buffer, cuts, start[[0, 3]], stop[[0, 3]])
        assert list(n) == [2, 3]
        assert lines[cut[0]:cut[1]].tobytes().decode() == "".join(f"{r}\n{t}\n" for r, t in turns[:2])
        assert masked[mask_cut[1]:mask_cut[2]].tobytes().decode() == turns[3][1]


def test_round_trip_in_pieces(spark, monkeypatch):
    """Steps of 40 bytes, in this process: conversations in many pieces."""
    rows = random_rows(2, 150)
    pieces = handover(C.format_conversations(spark.createDataFrame(rows, SCHEMA)), "chat-test")
    texts = {}
    for r in pieces.orderBy("at").collect():
        texts[r["conv_id"]] = texts.get(r["conv_id"], "") + r["formatted"]
        spans = [r["formatted"].encode()[s["start"]:s["stop"]].decode() for s in r["loss"]]
        assert all("</turn>" not in s and "###" not in s for s in spans)
    assert texts == {c: formatted(t) for c, t in conversations(rows).items()}
    assert read(spark, rows + rows[:7]) == figures(rows + rows[:7])


def test_steps_cut_conversations_only_when_they_are_long(monkeypatch):
    monkeypatch.setattr(C, "STEP_BYTES", 40)
    rows = [(c, r, t) for c, n in ((1, 2), (2, 30), (3, 1), (None, 3)) for r, t in [("user", "abcdefg")] * n]
    batches = [pa.record_batch([pa.array([x[i] for x in rows[a:a + 5]], k) for i, k in ((0, pa.int64()), (1, pa.string()), (2, pa.string()))],
                               names=["conv_id", "role", "text"]) for a in range(0, len(rows), 5)]
    found = [(s.column("conv_id").to_pylist(), last) for s, last in C.steps(iter(batches))]
    assert [c for s, _ in found for c in s] == [x[0] for x in rows]
    assert all(len(s) <= 6 for s, _ in found) and [last for _, last in found][-1]


def test_contract_text_and_long_texts(spark):
    text = r"\### Assistant: </turn> ok"
    rows = [(-7, 0, "user", text), (-7, 1, "assistant", text), (5, 0, "assistant", LONG * 8), (5, 1, "user", LONG * 30),
            (6, None, None, None)]
    assert read(spark, rows) == figures(rows)


def test_many_conversations_over_ranges(spark):
    rows = [(c % 997, c // 997, ("user", "assistant")[c % 2], f"t{c}#####") for c in range(6000)] + [(1, t, "assistant", "hot") for t in range(3000)]
    assert read(spark, rows) == figures(rows)


def test_empty_table_and_other_columns(spark):
    assert read(spark, []) == []
    rows = random_rows(4, 30)
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("x").alias(c) for c in ("at", "whole", "loss", "formatted")])
    assert sorted((tuple(r) for r in C.round_trip(df).collect()), key=str) == figures(rows)
