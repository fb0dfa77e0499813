"""Token counts against the tokenizer library's own unigram model over the same pieces."""

import random

import public_tokenizers
import pytest

from shipgauge.llm.token_counts import Counter, count_tokens, vocabulary

PATH = public_tokenizers.path("piece_bpe_32k.model")


def unigram(pieces):
    """The library's model; bytes cost as much as its least piece, so that no text is read as the name of a byte."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    known, least = {p for p, _ in pieces}, min(s for _, s in pieces)
    marks = ["<unk>", *(f"<0x{b:02X}>" for b in range(256))]
    pieces = [*((m, least) for m in marks if m not in known), *pieces]

    t = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return t


@pytest.fixture(scope="module")
def both():
    pieces = vocabulary(PATH)
    return Counter(pieces), unigram(pieces)


def test_odd_texts(both):
    counter, tokenizer = both
    rng = random.Random(6)
    parts = ["a", "the", "é", "日", "日本", "😀", " ", "  ", "\n", "▁", "<s>", "<0x0A>", "ing", "ß", "x", "\t", "ﷺ", "1", "."]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 10)))
        assert counter.count(text) == len(tokenizer.encode(text).ids), text


def test_names_of_marks_are_plain_text(both):
    counter, tokenizer = both
    assert not {"<s>", "</s>", "<unk>", "<0x0A>"} & {p for p, _ in vocabulary(PATH)}
    for text in ("x<0x0A>y", "<s>", "a</s>b <unk>", "<0x0A>"):
        assert counter.count(text) == len(tokenizer.encode(text).ids) > 2


def test_ties_follow_the_tokenizer():
    rng = random.Random(8)
    for _ in range(40):
        pieces = [("<unk>", 0.0), *((f"<0x{b:02X}>", -50.0) for b in range(256)), ("▁", -1.0)]
        names = {"".join(rng.choice("ab▁") for _ in range(rng.randint(1, 4))) for _ in range(12)} - {"▁"}
        pieces += [(n, float(-rng.randint(1, 3))) for n in sorted(names)]
        counter, tokenizer = Counter(pieces), unigram(pieces)
        for _ in range(60):
            text = "".join(rng.choice("ab c") for _ in range(rng.randint(0, 9)))
            assert counter.count(text) == len(tokenizer.encode(text).ids), (text, pieces)


def test_table(spark, both):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in count_tokens(docs, PATH, keep=["doc_id"]).collect()}
    assert got == {r.doc_id: len(both[1].encode(r.text).ids) for r in docs.collect()}


def test_nulls_repeats_clashes_and_empty_tables(spark):
    rows = [(1, None, "x"), (2, "", "x"), (2, "", "x"), (None, "a b", "x"), (5, "ab " * 50000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted((r.doc_id or 0, r.n_tokens) for r in count_tokens(docs, PATH).collect())
    assert [x[0] for x in got] == [0, 1, 2, 2, 5] and got[1][1] == got[2][1] == 0 and got[4][1] > 50000
    assert count_tokens(docs.limit(0), PATH).count() == 0
