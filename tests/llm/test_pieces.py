import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from sentencepiece import SentencePieceProcessor

from shelfcast.llm import pieces
from shelfcast.llm.pieces import PieceCodec
from tests_llm_rows import SCHEMA, edge_rows

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def codec():
    return PieceCodec(pieces.read_model(MODEL))


def odd_texts():
    rng = random.Random(3)
    letters = "ab \t\n▁é日🙂x\0<>0AÅ  eéthing�"
    made = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(2000)]
    return made + ["", " ", "  ", "▁", "<s>a</s><0x41>", "the quick  brown\r\nfox", "x" * 5000, "Qa9" * 3000, " " * 300]


def test_every_text_as_the_library_has_it(codec):
    texts = odd_texts()
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        assert ids.tolist() == codec.library.encode(text), repr(text)
        assert codec.decode(ids.tolist()) == codec.library.decode(ids.tolist()), repr(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    codec = test_any_text.codec = getattr(test_any_text, "codec", None) or PieceCodec(pieces.read_model(MODEL))
    ids = codec.encode([text])[0].tolist()
    assert ids == codec.library.encode(text) and codec.decode(ids) == codec.library.decode(ids)


def test_both_forms_of_the_agenda_agree(codec):
    segments = sorted({s for text in odd_texts() for s in codec.cut(text) if len(s) <= pieces.SHORT})
    assert dict(codec.short_segments(segments)) == {s: codec.long_segment(s) for s in segments}


def test_a_segment_that_differs_is_noted(codec, monkeypatch):
    broken = PieceCodec(pieces.read_model(MODEL))
    monkeypatch.setattr(broken, "merge", list)
    monkeypatch.setattr(broken, "short_segments", lambda segments: ((s, broken.long_segment(s)) for s in segments))
    assert [same for _, same in broken.encode_checked(["the fox", "", "日", "fox 日"])] == [False, True, True, False]
    assert all(same for _, same in codec.encode_checked(odd_texts()))


def test_a_full_memory_of_segments_changes_nothing(codec, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 5)
    texts = odd_texts()[:200]
    assert [codec.encode([t])[0].tolist() for t in texts] == [codec.library.encode(t) for t in texts]


def test_decoding_of_any_ids(codec):
    rng = random.Random(4)
    draw = [lambda: rng.randrange(3), lambda: rng.randrange(3, 259), lambda: rng.randrange(3, 259),
            lambda: rng.randrange(259, 32_000), lambda: 28705]
    for _ in range(5000):
        ids = [rng.choice(draw)() for _ in range(rng.randrange(9))]
        assert codec.decode(ids) == codec.library.decode(ids), ids


def test_rows_and_clashing_names(edge):
    got = pieces.encode_texts(edge.withColumn("piece_ids", edge["bucket"]), MODEL, whole_texts=True)
    assert [c for c in got.columns if not c.startswith("piece_")] == edge.columns
    library = SentencePieceProcessor(model_file=MODEL)
    rows = got.collect()
    assert all(r.piece_agrees for r in rows)
    key = lambda pair: (repr(pair[0]), pair[1])
    assert sorted(((r.doc_id, r.piece_ids) for r in rows), key=key) == sorted(
        ((r[0], library.encode(r[1] or "")) for r in edge_rows()), key=key)
    assert all(r.piece_text == (r.text or "") for r in rows)
    back = pieces.decode_ids(got.select("doc_id", "text", "piece_ids"), MODEL).collect()
    assert all(r.piece_text == (r.text or "") for r in back)


def test_nothing_and_null_ids(spark, empty):
    assert pieces.encode_texts(empty, MODEL).collect() == []
    df = spark.createDataFrame([(1, None), (2, []), (3, [1, 264])], "doc_id long, piece_ids array<int>")
    assert [r.piece_text for r in pieces.decode_ids(df, MODEL).orderBy("doc_id").collect()] == ["", "", "a"]


def test_query_matches_the_library(spark):
    from shelfcast.llm.queries import op13_sentencepiece

    folder = "/root/testdata/sf0.001"
    library = SentencePieceProcessor(model_file=MODEL)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = {}
    for row in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = library.encode(row.text or "")
        want[row.doc_id] = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
    got = op13_sentencepiece(spark, folder).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want
    assert all(r.agrees for r in got)


def test_other_vocabularies_are_refused(tmp_path, monkeypatch):
    monkeypatch.setattr(pieces, "MODEL_BYTES", 10)
    with pytest.raises(ValueError):
        pieces.read_model(MODEL)
