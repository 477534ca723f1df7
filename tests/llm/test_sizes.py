"""What goes to workers and to the driver stays small, with the same results."""

import json
import zlib

import numpy as np
import pyarrow as pa
import pytest

from delaystats.llm import byte_bpe, common, ngram_join, queries, token_ids, toxicity


def test_written_tables_send_small_batches_to_python(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.record_batch({"n": pa.array([batch.num_rows], pa.int64())})

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    wide = spark.range(0, 60, 1, 1).selectExpr("repeat(cast(id % 10 as string), 500000) x")
    got = [r.n for r in common.written(wide.mapInArrow(sizes, "n long"), "sizes").collect()]
    assert sum(got) == 60 and max(got) <= 12
    assert spark.conf.get(name, None) == before


def test_kept_sets_read_the_bit_map_in_place(monkeypatch):
    bits = np.zeros(16, np.uint8)
    for at in (0, 9, 127):
        bits[at >> 3] |= 1 << (at & 7)
    nodes = pa.array([0, 1, 9, 127, -1, 128, -128, 73], pa.int64())
    monkeypatch.setattr(np, "unpackbits", None)
    (got,) = ngram_join._kept_sets(bits.tobytes())(iter([pa.record_batch({"node": nodes})]))
    assert got.column(0).to_pylist() == [0, 9, 127, -1, 128, -128]


def test_only_words_that_can_count_reach_the_driver(spark, monkeypatch):
    rows = [(i, f"vile{'' if i % 4 else ' insult'} only{i} plain") for i in range(120)]
    rows += [(i, f"other{i} plain words") for i in range(120, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 120)) for i in range(400)], "doc_id long, toxic int")
    given = []
    fit_nnpu = toxicity.fit_nnpu
    monkeypatch.setattr(toxicity, "fit_nnpu", lambda *x: given.append(x) or fit_nnpu(*x))
    model = toxicity.fit(docs, labels)
    (positive, unlabelled, prior), = given
    assert {w for x in [*positive.to_pylist(), *unlabelled.to_pylist()] for w in x} == {"vile", "insult", "insul*", "only", "plain"}
    learnt = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    texts = dict(rows)
    whole = fit_nnpu([sorted(toxicity.words_of(texts[i])) for i in learnt if i < 120],
                     [sorted(toxicity.words_of(texts[i])) for i in learnt], prior)
    assert model.weights.keys() == whole.weights.keys() and "vile" in whole.weights
    assert all(abs(model.weights[w] - whole.weights[w]) < 1e-6 for w in whole.weights)
    assert len(positive) == sum(i < 120 for i in learnt) and len(unlabelled) == len(learnt)


@pytest.mark.parametrize("most", [1, 10, 1000])
def test_words_of_a_task_are_folded_once(monkeypatch, most):
    tokens, end = np.arange(256) + 1000, 5000
    monkeypatch.setattr(byte_bpe, "BLOCK_CHARS", 12)
    monkeypatch.setattr(byte_bpe, "TASK_WORDS", most)
    texts = ["the cat", "sat on the mat", "", None, "the cat sat on", "known words of the cat", "on\0 it  sat"] * 3
    table = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts)})
    blocks = list(byte_bpe._blocks(r" ?\S+|\s+", ["the", " the"], tokens, end)(iter([table])))
    sent = [tuple(w) for b in blocks for w in b.column("words")[0].as_py()]
    assert len(blocks) > 5 and blocks[0].column("fresh")[0].as_py()
    assert (len(sent) == len(set(sent))) == (most == 1000)

    def folded():           # a fold that merges nothing
        for b in blocks:
            words = [[int(t) - 1000 for t in w[1:-1]] for w in b.column("words")[0].as_py()]
            yield pa.record_batch({"doc_ids": b.column("doc_ids"), "counts": b.column("counts"),
                                   "numbers": b.column("numbers"), "tokens": pa.array([words], pa.list_(pa.list_(pa.int32()))),
                                   "fresh": b.column("fresh")})
    known = np.frombuffer(b"the the", np.uint8).astype(np.int32), np.array([3, 4])
    got = [x for b in byte_bpe._documents(*known)(folded()) for x in b.column("ids").to_pylist()]
    assert got == [list((t or "").encode()) for t in texts]


def test_token_id_cache_follows_the_texts(monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        tok = f.read()
    library = Tokenizer.from_str(tok)
    texts = ["", " ", "  two  spaces ", "a\0 b\0c  d", "x <|endoftext|> y", "\n line\n  ends", "q" * 300 + " long", "wide　 gap"]
    want = [np.array(library.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]
    common.worker_cache("tokenizers").clear()
    for chunks, chars in ((800_000, 4_000_000), (4, 10)):
        monkeypatch.setattr(token_ids, "CACHED_CHUNKS", chunks)
        monkeypatch.setattr(token_ids, "PIECE_CHARS", chars)
        assert list(token_ids._encoder(tok)(texts)) == want
    list(token_ids._encoder(tok)(["some more words", "the newest of all"]))
    _, _, met = common.worker_cache("tokenizers")[tok, False]
    assert any(" newest" in x for x in met) and sum(map(len, met)) < 20
    common.worker_cache("tokenizers").clear()


def test_chunks_are_cut_before_single_spaces():
    def plain(text):
        first, *parts = text.split(" ")
        out = [first]
        for p in parts:
            if p and not p[0].isspace():
                out.append(" " + p)
            else:
                out[-1] += " " + p
        return out
    for text in ["", " ", "a b", " a  b ", "a \n b", "\0 a \0b", "a　 b\x85 c \x1c d", "a  "]:
        assert byte_bpe._chunks(text) == plain(text)


def test_sets_that_share_too_few_signatures_are_not_kept():
    r = np.random.default_rng(5)
    for _ in range(150):
        size = int(r.integers(1, 700))
        x = np.unique(r.integers(0, 1 << 63, size).astype(np.uint64))
        lost, new = (int(r.integers(0, size * 7 // 100 + 1)) for _ in range(2))     # 93 / 107 is above 0.85
        y = np.unique(np.append(r.permutation(x)[lost:], r.integers(0, 1 << 63, new).astype(np.uint64)))
        both = len(np.intersect1d(ngram_join.signatures(x), ngram_join.signatures(y)))
        assert both >= max(ngram_join.least_shared(x), ngram_join.least_shared(y))

    text = " ".join(f"w{i}" for i in range(600))
    s = ngram_join.shingle_set(text, 4)
    assert ngram_join._level(ngram_join.least_shared(s)) == 3
    at = ngram_join._key(s)[0] & 63
    batch = pa.record_batch({"doc_id": pa.array([1], pa.int64()), "text": [text]})
    for level in range(4):
        bits = bytearray(16)
        bits[at >> 2] = level << (at & 3) * 2
        (got,) = ngram_join._set_rows(4, bytes(bits), 85, 100)(iter([batch]))
        assert got.column("elements")[0].is_valid == (level == 3)


def test_levels_of_shared_signatures(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BITMAP_BITS", 128)
    shared = spark.createDataFrame([(i, node) for node, n in ((3, 1), (-2, 3), (64, 9)) for i in range(n)],
                                   "sig long, node long")
    bits = ngram_join._bitmap(ngram_join._levels(shared), 2)
    levels = [bits[at >> 2] >> (at & 3) * 2 & 3 for at in range(128)]
    assert {at: x for at, x in enumerate(levels) if x} == {3: 1, 126: 2, 64: 3}


def test_pipeline_stages_get_small_batches(spark, monkeypatch, tmp_path):
    import corpus_pipeline

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch({"n": pa.array([batch.num_rows], pa.int64())})

    spark.range(0, 60, 1, 1).selectExpr("repeat(cast(id % 10 as string), 500000) x").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("sizes", lambda spark, docs, sf: docs.mapInArrow(sizes, "n long"))])
    got = [r.n for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sum(got) == 60 and max(got) <= 12


def test_a_pass_gives_back_what_it_took():
    import psutil

    me = psutil.Process()
    held = []

    def hungry(batches):
        kept = {i: str(i) * 20 for i in range(600_000)}
        held.append(me.memory_info().rss)
        yield from batches
        held.append(len(kept))

    batch = pa.record_batch({"x": pa.array([1])})
    before = me.memory_info().rss
    assert list(common.lean(hungry)(iter([batch]))) == [batch]
    took = held[0] - before
    assert took > 50 << 20 and me.memory_info().rss - before < took / 3


def test_sketches_differ_in_no_more_bits_than_sets_in_elements():
    r = np.random.default_rng(6)
    for size in (0, 1, 40, 700, 5000):
        x = r.integers(0, 1 << 63, size).astype(np.uint64)
        for lost in {0, size // 9, size}:
            y = np.append(x[lost:], r.integers(0, 1 << 63, lost).astype(np.uint64))
            both = [np.unpackbits(ngram_join._sketch(s).view(np.uint8)).astype(int) for s in (x, y)]
            assert np.abs(both[0] - both[1]).sum() <= 2 * lost


def test_sets_that_meet_by_chance_are_not_paired(spark):
    r = np.random.default_rng(7)
    sets = {i: np.unique(r.integers(0, 1 << 63, 300).astype(np.uint64)) for i in range(30)}
    sets[30] = np.unique(np.append(sets[1][5:], sets[2][:5]))     # near to 1, not to the hub 0
    dist = {i: len(np.setxor1d(sets[0], s)) for i, s in sets.items()}
    rows = spark.createDataFrame([(s, i, len(sets[i]), 0, 0, i) for i in sets for s in (7, 8)],
                                 "sig long, node long, n long, u long, hub long, comp long")
    tested = spark.createDataFrame([(0, i, d, False) for i, d in dist.items() if i],
                                   "a long, b long, dist long, link boolean")
    kept = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in sets.items()], "node long, elements binary")
    assert [tuple(x) for x in ngram_join._reachable(rows, tested, kept, 85, 100).collect()] == [(1, 30)]

CUT = ["One, two.\nThree.  Four 3.14, 1,000.", "a.b,c\nd", "..., ok.\n\nNext .5 , x", "it's, we'll. \n x\t\n y\n",
       "\nfirst\n", ".", ",", "\n", "x\x1c\ny", "x\u3000\ny", "e\u0301. z\u0301, \u4e00. \u0661,", "ab_. cd', ef\r\ngh",
       "\u00fcber, stra\u00dfe.\n\u00c9t\u00e9 na\u00efve\u00d7, \u00f7."]


def test_finer_cuts_cut_no_word():
    import public_tokenizers
    import regex
    split = regex.compile(public_tokenizers.PATTERN).findall
    assert byte_bpe._chunks(CUT[1]) == ["a", ".b", ",c", "\nd"]
    assert byte_bpe._chunks("ab, cd.\nEf") == ["ab", ",", " cd", ".", "\nEf"]
    for text in CUT:
        assert [w for c in byte_bpe._chunks(text) for w in split(c)] == split(text), text


def test_single_words_are_encoded_as_in_texts():
    from tokenizers import Tokenizer
    with open(queries.tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    assert token_ids._of_words(spec) is not None
    texts = [*CUT, *(c for x in CUT for c in byte_bpe._chunks(x)), "endoftext <|endoftext|> endoftext"]
    want = [np.array(Tokenizer.from_str(spec).encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]
    common.worker_cache("tokenizers").clear()
    assert list(token_ids._encoder(spec)(texts)) == want
    named = json.loads(spec)
    named["added_tokens"].append(named["added_tokens"][0] | {"content": "over", "id": 60000})
    assert token_ids._of_words(json.dumps(named)) is None
