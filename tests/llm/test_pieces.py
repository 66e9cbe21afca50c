import hashlib
import random

import numpy as np
import pytest
from sentencepiece import SentencePieceNormalizer, SentencePieceProcessor

from tastebud.llm import pieces as P
from tastebud.llm.queries import QUERIES, tokenizer_path

MODEL = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=MODEL)


def want(library, text):
    ids = library.encode(text or "", add_eos=True)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))


def check(library, rows, docs):
    key = lambda x: tuple(map(repr, x))
    got = sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"], hashlib.sha256(r["decoded"].encode()).hexdigest()) for r in rows), key=key)
    assert got == sorted(((k, *want(library, t)) for k, t in docs), key=key)
    assert all(r["n_bytes"] == r["covered_bytes"] for r in rows)


def strings(n, seed=5):
    rnd = random.Random(seed)
    parts = ["a", "the", "word", " ", "  ", "\n", "\t", "▁", "▁▁", "é", "é", "日本", "\U0001f600", "\0", "<s>", "</s>", "<0x0A>", "<unk>", "ﬁ", "Ⅷ",
             "ｶﾞ", "　", " ", "​", "½", "Å", ".", ",", "***", "123", "\r\n", "가", "가", "ß", "İ"]
    return ["", " ", "  ", "▁", "\n", *["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 25))) for _ in range(n)]]


def test_query(spark, sf, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op13_sentencepiece"](spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == want(library, docs[r["doc_id"]])
        assert r["covered_bytes"] == r["n_bytes"]


def test_odd_rows(odd, odd_clash, no_docs, library):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    check(library, P.encode(odd, ["doc_id"], MODEL).collect(), rows)
    check(library, P.encode(odd_clash, ["doc_id"], MODEL).collect(), rows)
    clash = odd_clash.withColumnsRenamed({"t": "decoded", "id": "ids", "w": "n_tokens"})
    check(library, P.encode(clash, ["doc_id"], MODEL).collect(), rows)
    assert P.encode(no_docs, ["doc_id"], MODEL).count() == 0


def test_round_trip_through_both_operators(spark, library):
    texts = strings(300)
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    ids = P.encode(df, ["i"], MODEL, with_ids=True, with_spans=True)
    got = {r["i"]: r["decoded"] for r in P.decode(ids, ["i"], MODEL).collect()}
    for r in ids.collect():
        assert r["ids"] == library.encode(texts[r["i"]], add_eos=True)
        assert got[r["i"]] == r["decoded"] == library.decode(r["ids"])
        assert len(r["begin"]) == len(r["end"]) == r["n_tokens"] - 1
    assert P.decode(spark.createDataFrame([(1, None)], "i long, ids array<int>"), ["i"], MODEL).first()["decoded"] == ""


def test_pieces_and_spans_equal_the_library(library):
    pieces = P.Pieces(MODEL)
    texts = strings(3000)
    for text, (_, ids) in zip(texts, pieces.encode(texts), strict=True):
        assert ids.tolist() == library.encode(text), repr(text)
        begin, end = pieces.spans(text, ids)
        proto = library.encode(text, return_type="proto").pieces if text else []
        assert [(p.begin, p.end) for p in proto] == list(zip(begin.tolist(), end.tolist(), strict=True)), repr(text)


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc", "nmt_nfkc_cf", "identity"])
def test_compiled_character_maps(rule):
    """Longest-prefix normalisation and its alignment, by the library's own compiled maps."""
    library = SentencePieceNormalizer(rule_name=rule)
    spec = next(v for n, _, v, _, _ in P.wire_fields(library.serialized_model_proto()) if n == 3)
    ours = P.Normalizer(spec)
    for text in strings(3000, seed=9):
        normal, offsets = library.normalize(text, with_offsets=True)
        got, source = ours.aligned(text)
        assert got.decode() == normal, (repr(text), rule)
        chars = [0, *np.cumsum([len(c.encode()) for c in text]).tolist()]
        own = [0, *np.cumsum([len(c.encode()) for c in normal]).tolist()]
        assert not normal or [chars.index(source[b]) for b in own] == offsets, (repr(text), rule)


def test_memo_generations(monkeypatch, library):
    monkeypatch.setattr(P, "MEMO_PARTS", 20)
    pieces = P.Pieces(MODEL)
    texts = strings(400, seed=2)
    for lo in range(0, len(texts), 10):
        some = texts[lo:lo + 10]
        assert [ids.tolist() for _, ids in pieces.encode(some)] == library.encode(some)
