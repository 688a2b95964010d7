import base64

import edge
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tablework.llm import bpe
from tablework.llm.queries import vocabulary_path

ENC = bpe.Encoder(bpe.read_vocabulary(vocabulary_path()), bpe.code_point_classes())
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(vocabulary_path(), "rb"))}
TIK = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CUT = regex.compile(public_tokenizers.PATTERN)
TEXTS = st.lists(st.text(alphabet="aabst'vellrmd 's  \n\t\r12½é!?.\xa0\u3000日ЯΣ😀\x85\x1c<|endoftext|>", max_size=40)
                 | st.text(alphabet=st.characters(max_codepoint=0x24FF, exclude_categories=["Cs", "Cn"]), max_size=30), max_size=4)


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_pieces_and_ids(texts):
    pieces, counts = ENC.pieces(texts)
    assert pieces == [p for t in texts for p in CUT.findall(t)]
    ids, per = ENC.encode(texts)
    want = [TIK.encode_ordinary(t) for t in texts]
    assert ids.tolist() == [i for w in want for i in w] and per.tolist() == list(map(len, want))
    assert ENC.vocabulary.decode(ids.astype("int64")).tobytes() == "".join(texts).encode()


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000 + "!" * 1500, " " * 3000 + "x", "\n \n" * 900, "é" * 1200, "=-" * 700])
def test_long_pieces(text):
    assert ENC.encode([text])[0].tolist() == TIK.encode_ordinary(text)


def test_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 10)
    enc = bpe.Encoder(bpe.read_vocabulary(vocabulary_path()), bpe.code_point_classes())
    for k in range(5):
        text = " ".join(f"piece{k}x{i}" for i in range(20))
        assert enc.encode([text])[0].tolist() == TIK.encode_ordinary(text)


def test_frames(spark):
    for extra in (False, True):
        docs = edge.documents(spark, extra=extra)
        coded = bpe.encode(docs, vocabulary_path())
        rows = coded.collect()
        assert sorted((str(r.doc_id), r.ids) for r in rows) == sorted((str(i), TIK.encode_ordinary(t or "")) for i, t, _ in edge.EDGE)
        back = bpe.decode(coded, vocabulary_path())
        assert "ids" not in back.columns
        assert all(bytes(r.decoded) == (r.text or "").encode() for r in back.collect())
    assert bpe.encode(edge.documents(spark, []), vocabulary_path()).collect() == []


def test_null_and_unknown_ids(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [64, 65])], "n long, ids array<int>")
    assert {r.n: bytes(r.decoded) for r in bpe.decode(df, vocabulary_path()).collect()} == {
        1: b"", 2: b"", 3: TIK.decode_bytes([64, 65])}
    with pytest.raises(Exception, match="outside the vocabulary"):
        bpe.decode(spark.createDataFrame([(1, [99999999])], "n long, ids array<int>"), vocabulary_path()).collect()
