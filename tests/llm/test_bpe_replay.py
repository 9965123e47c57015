import numpy as np
import public_tokenizers as P
import tiktoken
from hypothesis import given, settings, strategies as st

from eventide.llm import bpe_replay as B
from eventide.llm.queries import op7_bpe_replay
from llm_fixtures import none, odd, real_texts, sf  # noqa: F401

RANKS = B.read_ranks(P.path("byte_bpe_50k.tiktoken"))
VOCAB = B.Vocabulary.parse(RANKS)
LIB = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=VOCAB.ranks, special_tokens={})


def encode(texts):
    out = []
    for _, ids in B.Encoder(VOCAB, P.PATTERN).run([(None, texts)]):
        out += [x.tolist() for x in ids]
    return out


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text_is_encoded_as_by_the_library(text):
    assert encode([text]) == [LIB.encode_ordinary(text)]
    assert VOCAB.decode(np.array(LIB.encode_ordinary(text), np.int64)) == text.encode()


def test_real_and_odd_texts(real_texts):
    texts = [t for _, t in real_texts] + ["a" * 5000, "aaaa aaaa", "é" * 999, " " * 3000 + "x", "\n\n\n", "<|endoftext|>", "don't I'LL we've"]
    assert encode(texts) == [LIB.encode_ordinary(t) for t in texts]


def test_texts_longer_than_a_part(monkeypatch):
    whole = B.parts
    monkeypatch.setattr(B, "parts", lambda t: whole(t, 50))
    text = "word  two\n\n three's 12345  \t end " * 300 + " " * 200 + "x" * 200
    assert "".join(B.parts(text)) == text and len(list(B.parts(text))) > 50
    assert encode([text]) == [LIB.encode_ordinary(text)]


def test_ranks_whose_merges_are_ambiguous():
    """A token may be joined in several ways, and a late merge may make an early pair."""
    ranks = {bytes([b]): b for b in range(256)}
    for i, t in enumerate([b"bc", b"abc", b"ab", b"cd", b"abcd", b"aa", b"aaa", b"aab"]):
        ranks[t] = 256 + i
    vocab, r = B.Vocabulary(ranks), np.random.default_rng(0)
    words = ["".join(r.choice(list("abcd"), int(r.integers(1, 12)))).encode() for _ in range(500)]
    ids, count = B.replay(words, vocab)
    lib = tiktoken.Encoding("t", pat_str=r"[a-z]+", mergeable_ranks=ranks, special_tokens={})
    at = np.concatenate(([0], np.cumsum(count)))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [lib.encode_ordinary(w.decode()) for w in words]


def test_query_round_trip(spark, sf, real_texts):
    import hashlib
    out = {r["doc_id"]: r for r in op7_bpe_replay(spark, sf).collect()}
    assert len(out) == len(real_texts)
    for i, text in real_texts:
        ids = LIB.encode_ordinary(text)
        assert out[i]["n_tokens"] == len(ids)
        assert out[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert out[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_odd_rows(spark, odd, none):
    out = B.decode(B.encode(odd, RANKS, P.PATTERN), RANKS).collect()
    texts = sorted((str(r["doc_id"]), r["text"] or "") for r in odd.collect())
    assert sorted((str(r["doc_id"]), bytes(r["decoded"]).decode()) for r in out) == texts
    assert B.encode(none, RANKS, P.PATTERN).count() == 0


def test_near_pattern_spells_out_properties():
    assert "\\p" not in B.near_pattern(P.PATTERN) and "\\S" not in B.near_pattern(P.PATTERN)


def test_recode_is_encode_and_decode(spark, odd, none):
    both = B.decode(B.encode(odd, RANKS, P.PATTERN), RANKS)
    one = B.recode(odd, RANKS, P.PATTERN)
    assert one.columns == both.columns and one.exceptAll(both).count() == both.exceptAll(one).count() == 0
    assert one.count() == odd.count() and B.recode(none, RANKS, P.PATTERN).count() == 0
