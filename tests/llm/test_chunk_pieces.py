import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from ledgerline.llm import chunk_pieces
from ledgerline.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return chunk_pieces.Vocabulary.read(PATH)


def encoded(vocabulary, text):
    chunks, codes, _ = chunk_pieces.chunk_places(pa.array([text]))
    return [i for c in codes for i in vocabulary.segment(chunks[c].as_py())] + [vocabulary.end]


def test_random_texts(library, vocabulary):
    pick = random.Random(3)
    pool = list("aaabbeiothnrsΣİßéñ'!.,$ \n\t 0123<|>東😀▁\0") + ["  ", "   ", "▁▁", "<s>", "</s>", "<0x41>", "<unk>", " the", "ing", "é", "ﷺ", "​"]
    for _ in range(5000):
        text = "".join(pick.choices(pool, k=pick.randint(0, 30)))
        ids = library.encode(text, add_eos=True)
        assert encoded(vocabulary, text) == ids, text
        assert vocabulary.spell(ids)[1:] == library.decode(ids)


@pytest.mark.parametrize("text", ["ab" * 5000, " " * 5001, "a " * 3000 + " " * 77, "étéé東" * 900, "▁" * 33 + "x"])
def test_long_texts(library, vocabulary, text):
    assert encoded(vocabulary, text) == library.encode(text, add_eos=True)


def test_scan_and_heap_merge_alike(vocabulary):
    pick = random.Random(9)
    for _ in range(3000):
        chunk = " " * pick.randint(1, 5) + "".join(pick.choices("aetinosr'é9", k=pick.randint(0, 20)))
        assert vocabulary._scanned(chunk) == vocabulary._queued(chunk)


def test_spelling_of_broken_bytes(library, vocabulary):
    for ids in ([3 + 0xE6, 3 + 0x9D, 264], [264, 3 + 0xFF, 3 + 0x41, 1, 2], [2], [28705, 28705, 3 + 0xC3, 2]):
        assert vocabulary.spell(ids).removeprefix(" ") == library.decode(ids)


def test_other_models_are_refused(tmp_path):
    spec = chunk_pieces.sentencepiece_model_pb2.ModelProto.FromString(open(PATH, "rb").read())
    spec.pieces[500].piece = "a▁b"
    (tmp_path / "crossing.model").write_bytes(spec.SerializeToString())
    with pytest.raises(ValueError, match="crosses"):
        chunk_pieces.Vocabulary.read(str(tmp_path / "crossing.model"))
    spec.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "other.model").write_bytes(spec.SerializeToString())
    with pytest.raises(ValueError, match="plain BPE"):
        chunk_pieces.Vocabulary.read(str(tmp_path / "other.model"))


def test_blocks_do_not_change_the_result(spark, library, monkeypatch):
    pick = random.Random(4)
    rows = [(i, " ".join(pick.choices(["the", "tree", "", "東京", "x" * 40], k=pick.randint(0, 60)))) for i in range(300)]
    monkeypatch.setattr(chunk_pieces, "BLOCK_BYTES", 700)
    monkeypatch.setattr(chunk_pieces, "BUCKET_BYTES", 2000)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    blocks = chunk_pieces.placed(df.withColumnRenamed("doc_id", "key"), 3)
    found = chunk_pieces.tokens(df, PATH).collect()
    assert blocks.count() == blocks.select("block").distinct().count() > 20
    want = {i: library.encode(t, add_eos=True) for i, t in rows}
    assert {r.doc_id: r.ids for r in found} == want
    assert {r.doc_id: r.decoded for r in found} == {i: library.decode(x) for i, x in want.items()}


def test_a_block_that_changes_is_an_error(spark):
    def other_each_time(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f"w{random.random()}" for _ in range(batch.num_rows)])], ["doc_id", "text"])

    df = spark.range(200).mapInArrow(other_each_time, "doc_id long, text string")
    with pytest.raises(Exception, match="changed between two reads"):
        chunk_pieces.tokens(df, PATH, bare=True).collect()
    assert chunk_pieces.tokens(df, PATH).count() == 200


def test_awkward_rows(awkward, none, library):
    found = sorted(((r.doc_id, r.n_tokens, r.ids, r.decoded) for r in chunk_pieces.tokens(awkward, PATH).collect()), key=str)
    want = []
    for k, t in awkward.select("doc_id", "text").collect():
        ids = library.encode(t or "", add_eos=True)
        want.append((k, len(ids), ids, library.decode(ids)))
    assert found == sorted(want, key=str)
    assert chunk_pieces.tokens(none, PATH).count() == 0


def test_query_against_the_library(spark, folder, library):
    found = {r.doc_id: r for r in QUERIES["op11_sentencepiece"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(docs)
    for k, t in docs:
        ids = library.encode(t or "", add_eos=True)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), library.decode(ids))]
        assert [found[k].n_tokens, found[k].ids_sha256, found[k].decoded_sha256] == [len(ids), *digests]
