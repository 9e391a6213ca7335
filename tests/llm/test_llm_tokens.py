"""Token files, WARC and piece encoding: exact round trips and the libraries themselves."""

import gzip
import tracemalloc
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from helpers import ROWS, table
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2 as model_format

from tidemark.llm import piece_encoding, token_files, warc
from tidemark.llm.memo import Memo, flat

TEXT = st.text(st.sampled_from("aB z.,'!9éÜ\n\t\x1c\x85ßΣİ´́<|endoftext|>☃ " + "thereon" * 3), max_size=60)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_word_ids_are_the_librarys(text):
    code = token_files.encoder(token_files.MODEL)
    assert code.encode([text])[0].tolist() == code.library.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-(2**63), 2**63 - 1), unique=True, max_size=300))
def test_index_finds_every_key(keys):
    keys = np.array(keys, np.int64)
    index = token_files.build_index(keys, np.arange(len(keys)))
    assert np.array_equal(token_files.find(index, keys), np.arange(len(keys)))
    others = np.array([k for k in range(1000, 1050) if k not in set(keys.tolist())])
    assert (token_files.find(index, others) < 0).all()


def test_files_hold_all_ids_in_order(spark, tmp_path):
    path = str(tmp_path / "ids")
    token_files.write(table(spark), path, span=4, block_ids=300)
    code = token_files.encoder(token_files.MODEL)
    start, want = 0, []
    for i, text in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = code.library.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted((tuple(r) for r in token_files.read(spark, path).collect()), key=lambda r: r[1])
    assert got == want
    asked = spark.createDataFrame([(7,), (9,), (1234,), (None,)], "doc_id long")
    found = token_files.lookup(spark, path, asked, span=4).collect()
    assert sorted(r.doc_id for r in found) == [7, 7, 9]
    assert {tuple(r.ids) for r in found if r.doc_id == 7} == {(*code.library.encode(ROWS[0][1], add_special_tokens=False).ids, 2)}


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab  é☃😀\n▁.\x00Z"), max_size=40))
def test_pieces_are_the_librarys_and_cover_the_text(text):
    code = piece_encoding.encoder(piece_encoding.MODEL)
    ids = code.encode([text])[0]
    assert ids.tolist() == code.pieces.encode(text, add_eos=True)
    first, last = code.spans(text, ids)
    raw = text.encode()
    assert b"".join(raw[a:b] for a, b in zip(first, last, strict=True)) == raw


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
def test_normaliser_follows_the_map(rule):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    spec = model_format.ModelProto.FromString(library.serialized_model_proto()).normalizer_spec
    own = piece_encoding.Normaliser(spec)
    for text in ["ﬁne ① Ｈｅｌｌｏ", "  x 　 y  ", "가나 한", "é é ½", "zero​nb", "\x01a\tb", "ΑΣ İ ß", "", "   "]:
        body, begin, end = own(text)
        assert body.decode() == library.normalize(text)
        assert (begin <= end).all() and (np.diff(begin) >= 0).all() and (not len(end) or end[-1] <= len(text.encode()))


def test_encode_then_decode(spark):
    texts = {r.doc_id: r.text for r in piece_encoding.decode(piece_encoding.encode(table(spark))).collect()}
    assert all(texts[i] == (t or "") for i, t in ROWS)


PAGES = [(1, "http://a", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u\r\nX: y", None), (4, "u", ""), (5, "u", "WARC/1.1\r\n\r\n\r\n"), (None, "u", "<p>é</p>")]


def test_archive_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*r, "x") for r in PAGES], "page_id long, url string, html string, sha1 string")
    warc.write(pages, str(tmp_path / "w"), file_records=2)
    records = warc.read(spark, str(tmp_path / "w"), payloads=True)
    got = {r.page_id: tuple(r)[1:] for r in warc.pages(records).collect()}
    for i, _, html in PAGES:
        body = (html or "").encode()
        same = [j for j, _, h in PAGES if (h or "") == (html or "") and j is not None]
        again = i != min(same)
        assert got[i] == (len(body), warc.sha1_base32(body), "revisit" if again else "response", min(same) if again else None)
    bodies = {r.payload for r in records.where("record_type = 'response'").collect()}
    assert bodies == {(h or "").encode() for _, _, h in PAGES}
    assert records.where("gap IS NOT NULL").count() == 0


def test_long_urls_are_read_back(spark, tmp_path):
    urls = ["data:," + "x" * 100_000, "http://a/WARC/1.1", "data:," + "WARC/1.1 " * 50_000]
    pages = spark.createDataFrame([(i, u, f"<p>{i}</p>") for i, u in enumerate(urls)], "page_id long, url string, html string")
    warc.write(pages, str(tmp_path / "w"))
    records = warc.read(spark, str(tmp_path / "w"))
    assert sorted(r.page_id for r in warc.pages(records).collect()) == [0, 1, 2]
    assert {r.target_uri for r in records.collect()} == {u.strip() for u in urls}


def test_a_header_ends_before_the_next_record():
    good = _record(b"payload")
    cut = b"WARC/1.0\r\nWARC-Type: resource\r\n"
    assert [(a, b) for a, b, r in warc.salvage(cut + good) if isinstance(r, str)] == [(0, len(cut))]
    assert [r["payload"] for *_, r in warc.salvage(cut + good) if isinstance(r, dict)] == [b"payload"]


def test_small_payloads_are_written_in_full(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], "page_id long, url string, html string")
    warc.write(pages, str(tmp_path / "w"), smallest_payload=3)
    assert {r.record_type for r in warc.read(spark, str(tmp_path / "w")).collect()} == {"response"}


def test_empty_archive(spark, tmp_path):
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "w"))
    assert warc.pages(warc.read(spark, str(tmp_path / "w"))).collect() == []


def _record(payload: bytes, digest=True) -> bytes:
    told = f"WARC-Payload-Digest: sha1:{warc.sha1_base32(payload)}\r\n" if digest else ""
    head = f"WARC/1.0\r\nWARC-Type: resource\r\n{told}Content-Length: {len(payload)}\r\n\r\n"
    return head.encode() + payload + b"\r\n\r\n"


def test_salvage_after_damage():
    good = [_record(f"payload {i}".encode()) for i in range(4)]
    broken = good[1].replace(b"payload", b"pbyload")
    data = good[0] + broken + b"noise" + good[2] + gzip.compress(good[3]) + gzip.compress(good[1])[:-9] + good[0][:-3]
    found = list(warc.salvage(data))
    assert [r["payload"] for *_, r in found if isinstance(r, dict)] == [b"payload 0", b"payload 2", b"payload 3"]
    gaps = [(a, b) for a, b, r in found if isinstance(r, str)]
    start = len(good[0])
    assert gaps[0] == (start, start + len(broken) + 5) and gaps[1][1] == len(data)
    assert sum(b - a for a, b in {(a, b) for a, b, _ in found}) == len(data)


@pytest.mark.parametrize("level", [0, 6])
def test_salvage_within_one_member(level):
    rng = np.random.default_rng(0)
    bodies = [rng.bytes(50_000).hex().encode() for _ in range(6)]
    good = [_record(b) for b in bodies]
    broken = good[2].replace(bodies[2][:9], b"not these")

    def read(data):
        found = list(warc.salvage(data))
        assert sum(b - a for a, b in {(a, b) for a, b, _ in found}) == len(data)
        return [bodies.index(r["payload"]) for *_, r in found if isinstance(r, dict)], [(a, b) for a, b, r in found if isinstance(r, str)]

    # A bad record inside a whole member.
    whole = gzip.compress(b"".join([*good[:2], broken, *good[3:]]), level)
    assert read(whole + good[0]) == ([0, 1, 3, 4, 5, 0], [(0, len(whole))])
    # A member that ends early, alone and before others.
    whole = gzip.compress(b"".join(good), level)
    early = whole[: len(whole) * 3 // 4]
    assert read(early)[0] == [0, 1, 2, 3]
    got, gaps = read(early + gzip.compress(good[5], level) + good[4])
    assert got == [0, 1, 2, 3, 5, 4] and len(gaps) == 1
    # Bad bytes in the middle, a bad check sum at the end.
    at = len(whole) * 3 // 5
    bad = whole[:at] + b"\0" * 5000 + whole[at + 5000 :]
    assert set(read(bad)[0]) >= {0, 1, 2} and 3 not in read(bad)[0]
    assert read(whole[:-8] + bytes(8) + good[1])[0] == [0, 1, 2, 3, 4, 5, 1]
    # A member without records is a gap.
    member = gzip.compress(b"no record", level)
    assert read(member + good[0]) == ([0], [(0, len(member))])


def test_large_pages_get_files_of_their_own(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", "x" * 3000) for i in range(5)] + [(9, None, "y" * 9000), (10, "v", None)], "page_id long, url string, html string").coalesce(1)
    warc.write(pages, str(tmp_path / "w"), file_bytes=4096)
    assert len(list((tmp_path / "w").glob("part-*"))) == 7
    found = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in warc.pages(warc.read(spark, str(tmp_path / "w"))).collect()}
    assert found == {0: (3000, "response", None), **{i: (3000, "revisit", 0) for i in range(1, 5)}, 9: (9000, "response", None), 10: (0, "response", None)}


def test_rows_that_repeat_a_page_and_extra_columns(spark, tmp_path):
    rows = [(1, "a", "same", "x"), (1, "b", "same", "y"), (2, "c", "same", "z"), (None, "d", "same", "w")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, sha1 string")
    warc.write(pages, str(tmp_path / "w"))
    found = warc.pages(warc.read(spark, str(tmp_path / "w"))).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in found) == [(0, "revisit", 1), (1, "response", None), (1, "response", None), (2, "revisit", 1)]


def test_pieces_are_encoded_without_holding_a_batch_of_texts(monkeypatch):
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(30)), "text": ["a" * (1 << 20)] * 29 + [None]})
    monkeypatch.setattr(piece_encoding, "encoder", lambda path: SimpleNamespace(encode=list))
    tracemalloc.start()
    seen = 0
    for _, doc_ids, texts, _ in piece_encoding._encoded([batch], "model"):
        assert len(doc_ids) == len(texts)
        seen += len(texts)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert seen == 30 and texts == [""] and peak < 10 << 20


def test_a_memo_takes_chunks_at_one_look_and_forgets_what_it_could_not_learn():
    broken = []

    def learn(chunks):
        if broken:
            raise ValueError(broken[0])
        return flat([[len(c)] * 2 for c in chunks], np.int32)

    memo = Memo(learn, np.int32, "test")
    for texts in ([["a", "bb", "a"], [], ["ccc"]], [["bb"]], []):
        assert [memo.of(p).tolist() for p in memo.take(texts)] == [[len(c) for c in t for _ in "12"] for t in texts]
    broken.append("lost")
    with pytest.raises(ValueError, match="lost"):
        memo.take([["a", "dddd"]])
    broken.clear()
    memo.add([["dddd", "a"]])
    assert memo.of(memo.places(["a", "dddd"])).tolist() == [1, 1, 4, 4]
