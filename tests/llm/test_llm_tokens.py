"""Token records, SentencePiece spans and unigram counts against the libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer
from tokenizers.models import Unigram

from chatloom.llm import bpe, pieces, records, token_counts

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  a", "a ", "a\n b\tc", "Ünïcode 한글 🙂 end", "word " * 3000, "▁ ▁a", "<|endoftext|> x", "\x00 \x85 "]
SCHEMA = "doc_id long, text string, n_tokens int, ids string, part int"


def documents(spark, texts):
    return spark.createDataFrame([(i, t, 1, "x", 2) for i, t in enumerate(texts)], SCHEMA)


def random_texts(n, alphabet=" \n\t 　ab'1.!é\x85​▁  abc"):
    r = random.Random(5)
    return ["".join(r.choice(alphabet) for _ in range(r.randint(0, 20))) for _ in range(n)]


def test_segment_memo_gives_the_libraries_ids():
    texts = random_texts(4000) + [t or "" for t in ODD]
    tokenizer, model = Tokenizer.from_file(BYTE_BPE), bpe.sentencepiece_model(PIECE_BPE)
    for made, want in (
        (bpe.byte_level_ids(texts, BYTE_BPE), [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]),
        (bpe.piece_ids(texts, PIECE_BPE), model.encode(texts)),
    ):
        assert [np.frombuffer(m, np.uint32).tolist() for m in made] == want


def test_memo_stays_bounded():
    memo = bpe.Memo(lambda words: [w.encode() for w in words], most=10)
    for i in range(40):
        held = memo.hold({str(i), str(i + 1), "always"})
        assert held["always"] == b"always" and held[str(i)] == str(i).encode()
        assert len(memo.young) <= 10 and len(memo.old) <= 10


def test_token_records_round_trip(spark, tmp_path):
    docs = documents(spark, ODD * 3).union(documents(spark, ["same id"])).repartition(3)
    docs = docs.union(spark.createDataFrame([(None, "no id", 0, "", 0)], SCHEMA))
    folder = str(tmp_path / "tokens")
    index = records.write_records(docs, folder, BYTE_BPE, file_bytes=4000)
    assert index.select("file").distinct().count() > 1
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    want = [(r.doc_id, tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]) for r in rows]
    for seed in (None, 3):
        back = records.read_records(index, folder, seed).join(index.select("file", "record", "part", "seq"), ["file", "record"])
        got = sorted(back.collect(), key=lambda r: (r.part, r.seq, r.record))
        assert sorted((r.doc_id or -1, np.frombuffer(r.ids, "<u4").tolist()) for r in got) == sorted(
            (d or -1, i) for d, i in want
        )


def test_token_record_digests(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").repartition(5)
    tokenizer, start, want = Tokenizer.from_file(BYTE_BPE), 0, []
    for r in docs.orderBy("doc_id").collect():
        ids = tokenizer.encode(r.text, add_special_tokens=False).ids + [0]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = records.token_record_digests(docs, BYTE_BPE)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert records.token_record_digests(docs.limit(0), BYTE_BPE).count() == 0


def test_damaged_records_are_found():
    data = bytearray(records.frame(records.pack(7, np.array([1, 70000], np.uint32))))
    assert records.unpack(records.unframe(memoryview(data))) == (7, np.array([1, 70000], "<u4").tobytes())
    for at in (0, 9, len(data) - 6, len(data) - 1):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            records.unframe(memoryview(broken))


def test_spans_are_the_librarys():
    model = bpe.sentencepiece_model(PIECE_BPE)
    for text in random_texts(800, " ab cé한🙂\nthe  ▁") + ["naïve  Größe\n"]:
        ids = np.frombuffer(next(bpe.piece_ids([text], PIECE_BPE)), np.uint32).astype("i4")
        begin, end = pieces.spans(text, ids, PIECE_BPE)
        ours = [text.encode()[b:e] for b, e in zip(begin, end)]
        assert b"".join(ours) == text.encode()
        bytewise = [i for i in ids.tolist() if model.is_byte(i) and model.id_to_piece(i) > "<0x7F>"]
        if text and not bytewise:
            want = model.encode_as_offset_mapping(text)["offsets"]
            assert ours == [text[b:e].encode() for b, e in want]


def test_compiled_map_normalizes_like_the_library():
    normalizer = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    spec = next(v for k, v in pieces.message_fields(normalizer.serialized_model_proto()) if k == 3)
    ours = pieces.Normalizer.__new__(pieces.Normalizer)
    ours.map = pieces.CharacterMap(dict(pieces.message_fields(spec))[2])
    ours.starts, ours.prefix = ours.map.first_bytes(), False
    for text in random_texts(1500, "aé①ﬁ　ｱﾞ가Å½한é​ﬁ ™\x07\tz­ñ ㍿"):
        made, begin, end = ours.replaced(text.encode())
        # The library also drops extra blanks and puts a mark in front.
        plain = "▁".join(["", *(w for w in made.decode().split(" ") if w)])
        assert plain == normalizer.normalize(text)
        assert len(begin) == len(end) == len(made)
        assert (np.diff(begin) >= 0).all() and (begin < end).all()


def test_encoding_digests(spark):
    model = bpe.sentencepiece_model(PIECE_BPE)
    got = {r.doc_id: r for r in pieces.encoding_digests(documents(spark, ODD), PIECE_BPE).collect()}
    full = {r.doc_id: r for r in pieces.encode_documents(documents(spark, ODD), PIECE_BPE).collect()}
    for i, text in enumerate(ODD):
        ids = model.encode(text or "")
        decoded = model.decode(ids) if ids else ""
        assert got[i].n_tokens == len(ids) and full[i].ids == ids and full[i].decoded == decoded
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
        assert got[i].covered_bytes == len((text or "").encode())
    assert pieces.encoding_digests(documents(spark, ODD).limit(0), PIECE_BPE).count() == 0


def marked(text):
    return "▁" + text.replace(" ", "▁") if text else ""


def test_counts_equal_the_unigram_model(spark):
    vocabulary = token_counts.model_vocabulary(PIECE_BPE)
    tokenizer = Tokenizer(Unigram(vocabulary, unk_id=0, byte_fallback=True))
    texts = ODD + random_texts(500, " ab\nthe é中文🙂▁<0x41>ññ  12")
    got = token_counts.count_tokens(documents(spark, texts), PIECE_BPE)
    want = [len(tokenizer.encode(marked(t or "")).ids) for t in texts]
    assert [r.n_tokens for r in got.orderBy("doc_id").collect()] == want


def test_counts_follow_ties_and_unknown_runs():
    r = random.Random(2)
    for _ in range(150):
        made = {"".join(r.choice("ab▁") for _ in range(r.randint(1, 3))): r.choice([-1.0, -2.0, -0.1, -0.7]) for _ in range(8)}
        vocabulary = [("<unk>", 0.0), *made.items()]
        counter, tokenizer = token_counts.UnigramCounter(vocabulary), Tokenizer(Unigram(vocabulary, unk_id=0))
        texts = ["".join(r.choice("ab c") for _ in range(r.randint(1, 12))) for _ in range(30)]
        assert list(counter.count_texts(texts)) == [len(tokenizer.encode(marked(t)).ids) for t in texts]
