import random

import edge
from test_bpe import ENC, TIK

from tablework.llm import token_counts as C
from tablework.llm.queries import vocabulary_path


def test_trees_follow_random_edits():
    random.seed(6)
    alphabet = "aabst'vellrmd 's   \n\t12é!?.\xa0日Я"
    for size in [0, 1, 30, 500, 4000] * 12:
        text = "".join(random.choices(alphabet, k=size))
        tree = C.lay_out(ENC.pieces([text])[0], ENC)
        for _ in range(6):
            start = random.randint(-2, len(text) + 3)
            stop = start + random.choice([-4, 0, 0, 1, 5, 50, 900])
            new = "".join(random.choices(alphabet, k=random.choice([0, 1, 2, 10, 6000])))
            text, tree, touched = C.apply_edit(text, tree, start, stop, new, ENC)
            assert tree.count == len(TIK.encode_ordinary(text)) and tree.chars[1] == len(text)


def test_a_small_edit_touches_little():
    text = edge.LONG
    tree = C.lay_out(ENC.pieces([text])[0], ENC)
    _, _, touched = C.apply_edit(text, tree, 100000, 100003, "new", ENC)
    assert touched < 1000 < len(text)


def test_frames(spark):
    rows = [(1, 1, 0, 0, "start "), (5, 2, 100, 200, None), (5, 1, 50, 60, "it's\n\n"), (7, 1, 10**9, 10**9, "!"),
            (9, 1, -5, 3, "x"), (77, 1, 0, 1, "nobody"), (12, 1, None, None, "n")]
    edits = spark.createDataFrame(rows, "doc_id long, seq int, start long, stop long, replacement string")
    trees = C.build(edge.documents(spark, extra=True), vocabulary_path())
    assert sorted((str(r.doc_id), r.n_tokens) for r in trees.collect()) == sorted(
        (str(i), len(TIK.encode_ordinary(t or ""))) for i, t, _ in edge.EDGE)
    got = C.apply_edits(C.with_edits(trees, edits), vocabulary_path()).collect()
    assert len(got) == len(edge.EDGE)
    for r in got:
        assert r.n_tokens == len(TIK.encode_ordinary(r.text or ""))
        text = next(t for i, t, _ in edge.EDGE if i == r.doc_id) or ""
        for _, _, a, b, new in sorted((e for e in rows if e[0] == r.doc_id), key=lambda e: e[1]):
            a = min(max(a or 0, 0), len(text))
            text = text[:a] + (new or "") + text[min(max(b or 0, a), len(text)):]
        assert (r.text or "") == text
    assert C.build(edge.documents(spark, []), vocabulary_path()).collect() == []


def test_edits_of_many_texts_are_cut_together(monkeypatch):
    random.seed(7)
    texts = ["".join(random.choices("aabst'vellrmd 's   \n\t12é!?日", k=random.choice([0, 3, 400, 3000]))) for _ in range(200)]
    trees = [C.lay_out(ENC.pieces([t])[0], ENC) for t in texts]
    steps, cut = [], C.piece_starts
    monkeypatch.setattr(C, "piece_starts", lambda *a: steps.append(1) or cut(*a))
    C.edit_round(texts, trees, [(len(t) // 3, len(t) // 3 + 20, " it's 2 new") for t in texts], ENC)
    assert len(steps) <= 2
    assert [t.count for t in trees] == [len(TIK.encode_ordinary(t)) for t in texts]
