import hashlib
import random

import pytest
import sentencepiece

from strataforge.llm import pieces
from strataforge.llm.queries import op13_sentencepiece

MODEL = pieces.model_bytes()
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=MODEL)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_library(i, text):
    ids = LIBRARY.encode(text or "")
    return i, len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids))


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_the_library_on_whole_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert sorted(map(tuple, op13_sentencepiece(spark, sf).collect())) == sorted(by_library(r.doc_id, r.text) for r in docs.collect())


def made_texts():
    rnd = random.Random(3)
    letters = [*"abethnoirs .,\n\t▁éü日本語👧​ ﬁ<>/0x41", "  ", "    ", "the ", "ing", "<s>", "<unk>", "<0x41>"]
    return ["", " ", "  ", "▁", "a▁b", "a  b", "  a b  ", "\x00a", "\r\n", "é", "x" * 5000, " " * 5000, "ab" * 3000, "日" * 3000, *("".join(rnd.choices(letters, k=rnd.randrange(80))) for _ in range(3000))]


def ids_of(encoder, texts):
    return encoder.encode(pieces.pa.array(texts, pieces.pa.string())).to_pylist()


def test_agendas_equal_the_library_with_and_without_cuts():
    vocabulary = pieces.Vocabulary(MODEL)
    texts = made_texts()
    normal = ["▁" + text.replace(" ", "▁") if text else "" for text in texts]
    want = [LIBRARY.encode(text) for text in texts]
    assert [vocabulary.agenda(t).tolist() for t in normal] == want
    short = [k for k, t in enumerate(normal) if len(t) < 200 and not vocabulary.tied.search(t)]
    assert [pieces.array("i", x).tolist() for x in vocabulary.agendas([normal[k] for k in short])] == [want[k] for k in short]
    encoder = pieces.Encoder(vocabulary, LIBRARY)
    assert ids_of(encoder, texts) == want
    assert [ids_of(encoder, [text])[0] for text in texts[:500]] == want[:500]
    assert ids_of(encoder, [None, "", "a"]) == [[], [], LIBRARY.encode("a")] and ids_of(encoder, []) == [] and ids_of(encoder, [""]) == [[]]


def test_a_difference_stops_the_job():
    vocabulary = pieces.Vocabulary(MODEL)
    vocabulary.values[vocabulary.values % (1 << vocabulary.bits) == vocabulary.ids["▁this"]] -= 1
    with pytest.raises(ValueError, match="in the library"):
        pieces.Encoder(vocabulary, LIBRARY).encode(pieces.pa.array(["this thing"]))


def test_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(pieces, "GROUP", 200)
    monkeypatch.setattr(pieces, "ROWS", 3)
    rows = [("a", None), (None, ""), ("b", "one two"), ("b", "one two"), ("c", "long text. " * 20_000), ("d", "y" * 100_000), *((str(k), t) for k, t in enumerate(made_texts()[:40]))]
    df = spark.createDataFrame(rows, "doc_id string, text string").selectExpr("*", "1 AS ids", "2 AS id")
    for check in ("chunks", "texts"):
        got = pieces.encoded(df, MODEL, check=check).collect()
        assert sorted((repr(r.doc_id), r.ids) for r in got) == sorted((repr(i), LIBRARY.encode(t or "")) for i, t in rows)
    assert sorted(map(repr, map(tuple, pieces.digests(df).collect()))) == sorted(repr(by_library(*r)) for r in rows)
    assert pieces.digests(df.limit(0)).count() == 0
    back = pieces.encoded(df, MODEL).select(pieces.decoded(spark, pieces.F.col("ids"), MODEL).alias("t")).collect()
    assert sorted(r.t for r in back) == sorted((t or "").replace("▁", " ") for _, t in rows)
    with pytest.raises(ValueError):
        pieces.encoded(df, MODEL, check="none")


def test_other_models_are_refused():
    from sentencepiece import sentencepiece_model_pb2 as proto

    def changed(change):
        m = proto.ModelProto()
        m.ParseFromString(MODEL)
        change(m)
        return m.SerializeToString()

    for change in (
        lambda m: setattr(m.trainer_spec, "model_type", proto.TrainerSpec.UNIGRAM), lambda m: setattr(m.trainer_spec, "byte_fallback", False),
        lambda m: setattr(m.normalizer_spec, "add_dummy_prefix", False), lambda m: setattr(m.pieces[400], "type", proto.ModelProto.SentencePiece.USER_DEFINED),
        lambda m: setattr(m.pieces[400], "piece", "a▁"),
    ):
        with pytest.raises(ValueError, match="supported"):
            pieces.Vocabulary(changed(change))
