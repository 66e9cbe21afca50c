import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from tastebud.llm import packing as P
from tastebud.llm.queries import QUERIES, tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def brute(tokenizer, docs):
    out = []
    for key, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for k, n in enumerate(P.cut(len(ids), 2048)):
            out.append((key, k, at, n, zlib.crc32(ids[at:at + n].tobytes())))
            at += n
    return sorted(out, key=repr)


def check(tokenizer, pieces, docs):
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in pieces), key=repr) == brute(tokenizer, docs)
    sequences = {}
    for r in pieces:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    return len(sequences)


def first_fit_decreasing(lengths, capacity=2048):
    bins = []
    for n in sorted(lengths, reverse=True):
        for i, used in enumerate(bins):
            if used + n <= capacity:
                bins[i] += n
                break
        else:
            bins.append(n)
    return len(bins)


def test_query(spark, sf, tokenizer):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    pieces = QUERIES["op2_best_fit_packing"](spark, sf).collect()
    n = check(tokenizer, pieces, docs)
    assert n <= first_fit_decreasing([r["length"] for r in pieces])


def test_odd_rows(odd, odd_clash, no_docs, tokenizer):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    check(tokenizer, P.pack(odd, ["doc_id"], tokenizer_path()).collect(), rows)
    check(tokenizer, P.pack(odd_clash, ["doc_id"], tokenizer_path()).collect(), rows)
    assert P.pack(no_docs, ["doc_id"], tokenizer_path()).count() == 0


def test_ids_are_returned_on_request(docs, tokenizer):
    rows = P.pack(docs.limit(5), ["doc_id"], tokenizer_path(), with_ids=True).collect()
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in rows)


def test_word_memo_equals_whole_texts(tokenizer):
    rnd = random.Random(7)
    odd = ["a  b", "a \n b", " \nb", "  ", "x\t y", "'s 's ''ll <|endoftext|> 12 3", "", "a  b  　c", "\x1c \x1d a", "é ́x  "]
    odd += ["".join(rnd.choice(" \n\tab'12é.日  \x1c\u0301") for _ in range(rnd.randint(0, 40))) for _ in range(2000)]
    odd += ["".join(rnd.choice(["a", "it", "é", "'s", "''", "'", ",", ".", "*", "$%", " ", " ", "\n", "1", "-", "ª"]) for _ in range(rnd.randint(0, 30)))
            for _ in range(4000)]
    want = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(odd, add_special_tokens=False)]
    assert P.WordEncoder(tokenizer_path()).encode(odd) == want


def test_words_of_letters_are_merged_in_batches(tokenizer):
    """Letter words take their ids from batched merges, the same as the tokenizer's; it sees the others only."""
    rnd = random.Random(11)
    letters = "aaabeehinorstABTéèüßñçłŐ"
    words = ["a", "aaaa", "aaaaaaa", "ß", "the", "x" * 15, "x" * 16, "é" * 15, "é" * 40, "anaanaana"]
    words += ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 20))) for _ in range(20_000)]
    texts = [rnd.choice([" ", "\n"]).join(words[i:i + 50]) for i in range(0, len(words), 50)]
    want = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    encoder, asked = P.WordEncoder(tokenizer_path()), []
    ids = encoder._ids
    encoder._ids = lambda some: asked.extend(some) or ids(some)
    assert encoder.encode(texts) == want
    assert sum(len(x.split()) for x in asked) < len(set(words)) / 2 and not any(x.split()[:1] == ["anaanaana"] for x in asked)


def test_added_tokens_are_what_the_plain_call_gives(spark, tokenizer):
    rows = [(1, "a <|endoftext|> b"), (2, "x<|endoftext|>"), (3, "<|endoftext|><|endoftext|>\nc d"), (4, "<|endo ftext|>")]
    got = P.pack(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"], tokenizer_path()).collect()
    check(tokenizer, got, rows)
    assert {r["doc_id"]: r["length"] for r in got}[1] == 5


def test_plan_places_every_piece_once():
    rnd = random.Random(3)
    for capacity in (7, 64, 2048):
        histogram = {rnd.randint(1, capacity): rnd.randint(1, 400) for _ in range(min(capacity, 60))}
        placed, fill = Counter(), {}
        for length, first, last, sequence, per, at in P.plan(histogram, capacity):
            for rank in range(first, last):
                placed[length, rank] += 1
                s = sequence + (rank - first) // per
                fill.setdefault(s, []).append((at + (rank - first) % per * length, length))
        assert placed == {(n, r): 1 for n, c in histogram.items() for r in range(c)}
        for parts in fill.values():
            end = 0
            for offset, length in sorted(parts):
                assert offset == end
                end += length
            assert end <= capacity
        lengths = [n for n, c in histogram.items() for _ in range(c)]
        assert len(fill) <= 1.01 * first_fit_decreasing(lengths, capacity) + 1
