"""Damaged archives, long texts, ids of any type, and the ids of a byte-pair encoding against a library's."""

import gzip
import hashlib
import random
import time

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from chronoweave.llm import bpe, html_text, pii, queries, substring_dedup, warc


def archive(*records):
    return b"".join(r + warc._END for r in records)


def response(name, body, *more):
    block = warc._HTTP + warc.chunked(body)
    digest = ("WARC-Payload-Digest", f"sha1:{warc.base32_sha1(body)}")
    return warc.record([("WARC-Type", "response"), ("WARC-Record-ID", name), digest, *more], block)


def test_damaged_archives_are_rows(spark, tmp_path):
    good, other = response("<a>", b"x" * 500), response("<b>", b"y" * 500)
    folder = tmp_path / "w"
    folder.mkdir()
    packed = gzip.compress(archive(good)) + gzip.compress(archive(other))
    (folder / "cut.warc.gz").write_bytes(packed[:-60])
    broken = bytearray(gzip.compress(archive(*[response(f"<n{k}>", bytes([k % 251]) * 40 + str(k * k).encode()) for k in range(400)]), 0))
    broken[len(broken) * 3 // 4 :] = b"\0" * (len(broken) - len(broken) * 3 // 4)
    (folder / "broken.warc.gz").write_bytes(bytes(broken))
    (folder / "plain.warc").write_bytes(
        archive(
            response("<c>", b"c", ("WARC-Segment-Number", "one")), response("<d>", b"d", ("WARC-Segment-Number", "7")),
            response("<e>", b"e", ("WARC-Segment-Number", "9" * 30)), response("<f>", b"f"),
            good.replace(b"<a>", b"<g>").replace(b"Content-Length: ", b"Content-Length: x"),
            good.replace(b"<a>", b"<h>").replace(b"Content-Length: ", b"Content-Length: 9"), response("<i>", b"i"),
            warc.record([("WARC-Type", "continuation"), ("WARC-Segment-Origin-ID", "<k>"), ("WARC-Segment-Number", "x")], b"z"),
        )
    )
    (folder / "no.warc.gz").write_bytes(b"\x1f\x8bnothing")
    (folder / "empty.warc").write_bytes(b"")
    rows = warc.read_records(spark, str(folder)).collect()
    found = {r.record_id: r.whole for r in rows if not r.record_id.startswith("<n")}
    assert found == {"<a>": True, "<b>": False, "<c>": False, "<d>": False, "<e>": False, "<f>": True, "<g>": False, "<h>": False, "<i>": True}
    kept = [r.whole for r in rows if r.record_id.startswith("<n")]
    assert sum(kept) >= 250 and len(rows) == len(found) + len(kept)
    assert warc.pages_again(warc.read_records(spark, str(folder), with_payload=False)).where("payload_bytes is not null").count() >= 253


def test_members_of_an_archive():
    parts = [b"a" * 10, b"", b"b" * 300_000]
    assert warc.unpacked(b"".join(map(gzip.compress, parts))) == b"".join(parts)
    assert warc.unpacked(b"plain") == b"plain" and warc.unpacked(gzip.compress(b"x" * 9)[:-3]) == b"x" * 9


def growth(work, make):
    """How much longer four times the input takes."""

    def seconds(n):
        text = make(n)
        return min(_timed(work, text) for _ in range(3))

    return seconds(40_000) / max(seconds(10_000), 0.005)


def _timed(work, text):
    start = time.monotonic()
    work(text)
    return time.monotonic() - start


def test_long_texts_take_time_in_proportion():
    assert growth(pii.find_spans, lambda n: "call 555 123 4567 or phone (555) 765-4321, " * (n // 20)) < 9
    assert growth(html_text.Page, lambda n: "<p>a</p><script>" + "</script " * n) < 9
    assert growth(html_text.Page, lambda n: "<script>" + "</script " * n + "> <p>b</p>") < 9


def test_further_kinds_overlap_no_other():
    text = "tel +1 555 123 4567, phone 555 123 4567, tel 10.0.0.1 555.123.4567"
    spans = pii.find_spans(text)
    assert [(s.kind, text[s.start : s.end]) for s in spans] == [
        ("ip", "10.0.0.1"), ("phone", "+1 555 123 4567"), ("local_phone", "555 123 4567"), ("local_phone", "555.123.4567"),
    ]
    assert pii.merged([pii.Span("a", 5, 9, 1), pii.Span("b", 1, 3, 1), pii.Span("c", 2, 4, 1), pii.Span("d", 9, 10, 1)]) == [(1, 4), (5, 9), (9, 10)]


def test_ids_of_any_type_are_dealt_into_bounded_chunks(spark):
    draw = random.Random(8)
    words = [f"w{k}" for k in range(300)]
    passages = [" ".join(draw.choices(words, k=25)) for _ in range(30)]
    rows = [(f"id-{k:05}", " ".join([*draw.choices(words, k=15), draw.choice(passages), *draw.choices(words, k=10)])) for k in range(1500)]
    rows += [(None, passages[0] + " end"), ("id-00007", passages[1]), ("id-00007", "another text " + passages[1])]
    docs = spark.createDataFrame(rows, "doc_id string, text string")

    def result(size):
        found = substring_dedup.remove_repeats(docs, with_text=False, chunk_bytes=size)
        return sorted((str(r.id), r.n_words, r.n_removed, r.kept_sha256) for r in found.collect())

    chunks = substring_dedup.in_chunks(docs, "doc_id", "text", 20)
    sizes = [r["count"] for r in chunks.groupBy("chunk").count().orderBy("chunk").collect()]
    assert len(sizes) >= 15 and max(sizes) < 0.2 * len(rows)
    firsts = [r[0] for r in chunks.where("id is not null").groupBy("chunk").agg(F.min("id"), F.max("id")).orderBy("chunk").select("min(id)").collect()]
    assert firsts == sorted(firsts)
    whole = result(1 << 30)
    assert result(20_000) == whole and sum(r[2] for r in whole) > 1400 * 20


def test_bpe_by_its_own_merges_is_that_of_the_library():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    own = bpe.Codec(path, public_tokenizers.PATTERN, leaf=40, piece_leaf=8)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    draw = random.Random(2)
    texts = ["".join(draw.choice("ab é\n'st1! \t") for _ in range(draw.randint(0, 400))) for _ in range(300)]
    texts += ["".join(draw.choice("aeiou th") for _ in range(500)) for _ in range(20)] + ["\x1c \x85a  b   c", "a" * 999, " " * 999, "é" * 300]
    texts += ["".join(chr(draw.randint(1, 0x2FFF)) for _ in range(300)) for _ in range(20)]
    for text in texts:
        assert own.encode(text) == library.encode_ordinary(text), text
    for _ in range(200):
        piece = bytes(draw.choices(b"abcdeinorst ", k=draw.randint(1, 80)))
        assert own.merge(piece) == own._merge_window(piece)


def test_bpe_remembers_short_matches_as_tuples_in_bounded_memories():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    own, plain = bpe.Codec(path, public_tokenizers.PATTERN), bpe.Codec(path, public_tokenizers.PATTERN)
    asked = []
    own.matches = bpe._Memory(lambda match: asked.append(match) or own._match(match), 20)
    own.short.most = own.pairs.most = 7
    long = " " + "xq" * 40
    assert own.encode(" qzxqz qzxqz" + long * 2) == plain.encode(" qzxqz qzxqz" + long * 2)
    assert asked == [" qzxqz", long, long] and list(own.matches) == [" qzxqz"] and isinstance(own.matches[" qzxqz"], tuple)
    draw = random.Random(3)
    for _ in range(50):
        text = " ".join("".join(draw.choices("qxzjéa1", k=draw.randint(1, 45))) for _ in range(60))
        assert own.encode(text) == plain.encode(text) and own.decode(own.encode(text)) == text.encode()
        assert len(own.matches) <= 20 and max(len(own.short), len(own.pairs)) <= 7
    assert max(map(len, own.matches)) <= bpe.MEMORABLE and max(map(len, own.short)) <= bpe.MEMORABLE


def test_ids_of_all_documents_are_those_of_the_library(spark):
    folder = "/root/testdata/sf0.01"
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.codec(path, public_tokenizers.PATTERN).ranks, special_tokens={})
    docs = {r.doc_id: r.text or "" for r in queries.documents(spark, folder).collect()}
    rows = queries.op5_byte_bpe(spark, folder).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode_ordinary(docs[r.doc_id])
        decimal = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), decimal, hashlib.sha256(docs[r.doc_id].encode()).hexdigest())
