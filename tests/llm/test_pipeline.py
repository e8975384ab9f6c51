"""The whole pipeline on planted documents: who stays, what is changed, and that every id is packed once."""

import random
import zlib

import numpy as np
import pytest

pytest.importorskip("riskloom.llm")

import corpus_pipeline  # noqa: E402


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9)))
    vocabulary = [word() for _ in range(600)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    docs = {k: text(120) for k in range(20)}  # clean
    base = text(150).split()
    docs |= {30: " ".join(base), 31: " ".join(base)}  # exact copies
    docs |= {40 + k: " ".join([*base[:20], *text(130).split()]) for k in range(2)}  # alike in a few words only
    near = text(200).split()
    docs |= {50 + k: " ".join([*near[:100], f"changed{k}", *near[101:]]) for k in range(4)}  # near copies
    passage = text(30)
    docs |= {60: f"{text(40)} {passage} {text(40)}", 61: f"{text(900)} {passage}"}  # a third, and a thirtieth of the words
    docs |= {70: text(20), 71: "", 72: None, 73: "same three words " * 40}  # poor
    docs |= {80: f"{text(100)} write to jane.roe@example.org or {text(20)}"}
    rows = [(k, t, "en", f"src{k % 3}", len(t or "")) for k, t in docs.items()]
    stays = {*range(20), 30, 40, 41, 50, 61, 80}
    return rows, [(1, passage)], stays, docs


def test_run_on_planted_documents(spark, planted, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    rows, bench, stays, texts = planted
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == stays
    tokenizer = tokenizers.Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    pieces = {}
    for r in packed:
        pieces.setdefault(r.doc_id, []).append(r)
    for doc in stays - {80}:  # untouched by every stage
        ids = [*tokenizer.encode(texts[doc], add_special_tokens=False).ids, 2]
        for r in pieces[doc]:
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
        assert sorted((r.start, r.length) for r in pieces[doc])[0][0] == 0 and sum(r.length for r in pieces[doc]) == len(ids)
    rest = sum(r.length for r in pieces[80])
    assert rest == pieces[80][0].doc_tokens
    windows = {}
    for r in packed:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in windows.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 4096


def test_personal_data_of_a_planted_document_is_replaced(spark, planted):
    rows, _, _, texts = planted
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = {r.doc_id: r.text for r in corpus_pipeline.personal_data(spark, docs, "").collect()}
    assert "[EMAIL]" in found[80] and "jane.roe" not in found[80]
    assert all(found[k] == texts[k] for k in texts if k != 80)
