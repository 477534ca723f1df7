"""Speculated and verified BPE against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from delaystats.llm import verified_bpe as bpe

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tables():
    with open(FILE, encoding="utf-8") as f:
        return bpe.read_tables(f.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)        # untouched: special tokens in a text are special


def ids_of(encoder, texts):
    return [np.frombuffer(x, "<u4").tolist() for x in encoder(texts)]


TEXTS = ["", " ", "\n", "a", "hello world", " hello  world \n\n x", "a <|endoftext|> b", "a  <|endoftext|>  b\n<|endoftext|>",
         "<|endoftext|>", "<|endoftext|><|endoftext|>x", "it's we'll they'd I'M", "é à ü ß œ Ž", "日本語 テキスト", "🙂🙃 👩‍👩‍👧",
         "a b c\u0085d\u001ce", "x" * 1000, "ab" * 700, "日本" * 300, "١٢٣ ⅷ ² ½", "ẞͅ ǅ",
         "\t\t tabs\r\n", "aaaaaaaaaaaaaaaa", " 　 x", "é", "힣ᄀ", "a\x00b"]


def test_equals_the_library(tables, library):
    encoder = bpe.Encoder(tables)
    r = random.Random(5)
    letters = "abcdefghij  \n.,'éß日🙂0123<|>"
    texts = TEXTS + ["".join(r.choice(letters) for _ in range(r.randint(1, 200))) for _ in range(600)]
    texts += ["".join(chr(r.choice([r.randrange(32, 0x250), r.randrange(0x250, 0xD800), r.randrange(0x10000, 0x1FFFF)]))
                      for _ in range(60)) for _ in range(300)]
    assert ids_of(encoder, texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids_of(encoder, texts) == ids_of(bpe.Encoder(tables), texts)       # from the cache, too


def test_a_full_cache_changes_nothing(tables, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_CHUNKS", 3)
    encoder = bpe.Encoder(tables)
    assert [ids_of(encoder, [t]) for t in TEXTS] == [ids_of(bpe.Encoder(tables), [t]) for t in TEXTS]


def test_compatible_pairs_are_exactly_those_that_stay(tables):
    exact, r = bpe.Exact(tables), np.random.default_rng(3)
    made = np.flatnonzero(tables.made >= 0)
    a, b = r.choice(made[:3000], 6000), r.choice(made[:3000], 6000)
    want = [exact(tables.pieces[x] + tables.pieces[y]) == [x, y] for x, y in zip(a.tolist(), b.tolist())]
    assert bpe.compatible(tables, a, b).tolist() == want
    assert 0.02 < np.mean(want) < 0.98
    same = made[:3000]
    assert bpe.compatible(tables, same, same).tolist() == [exact(2 * tables.pieces[x]) == [x, x] for x in same.tolist()]


def test_only_failing_words_are_merged(tables):
    encoder = bpe.Encoder(tables)
    words = [" the", " and", " unbelievable", " thorreou", "zqxj"]
    encoder.words(words)
    assert encoder.merged < len(words)


def test_long_words_in_n_log_n(tables, library):
    r = random.Random(1)
    text = "".join(r.choice("etaoinshrdlu") for _ in range(200_000))
    assert ids_of(bpe.Encoder(tables), [text]) == [library.encode(text, add_special_tokens=False).ids]


def test_rows(spark, tables, library):
    rows = [(1, None, "x"), (2, "", "y"), (None, "a b", "z"), (4, "dup text", "u"), (4, "dup text", "u"),
            (5, "É" * 50_000 + " end", "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.decode(bpe.encode(df, tables), tables).collect()
    assert len(got) == len(rows)
    want = sorted((i or -1, library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t, _ in rows)
    assert sorted((x.doc_id or -1, np.frombuffer(x.ids, "<u4").tolist(), x.text) for x in got) == want
    assert bpe.encode(df.limit(0), tables).collect() == []
    bad = spark.createDataFrame([(1, bytearray(np.array([50255, 10**6, 127], "<u4").tobytes())), (2, None)],
                                "doc_id long, ids binary")
    assert [x.text for x in bpe.decode(bad, tables).orderBy("doc_id").collect()] == [
        library.decode([50255, 127], skip_special_tokens=False), ""]


def test_other_files_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        with pytest.raises(ValueError):
            bpe.read_tables(f.read())


def test_query_contract(spark, tmp_path):
    from delaystats.llm import queries
    texts = [(i, t) for i, t in enumerate(TEXTS)] + [(99, None)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.op12_bpe(spark, str(tmp_path)).collect()}
    library = Tokenizer.from_file(FILE)
    for i, t in texts:
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(
            library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
