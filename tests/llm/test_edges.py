"""Every operator on nulls, blanks, ties, repeated rows, empty tables and clashing column names."""

import hashlib
import math

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from chronoweave.llm import bpe, decontamination, html_text, language_id, pii, simhash, substring_dedup, toxicity, vector_dedup, warc
from chronoweave.llm.common import added, components

LONG = "la " * 40_000 + "x" * 60_000
TEXTS = [
    (1, None), (2, ""), (3, " \t\n"), (3, " \t\n"), (None, "the same words here again"), (4, "the same words here again"),
    (5, "the same words here again"), (6, "12 34 !!"), (7, LONG), (8, LONG), (None, None), (9, "é漢🙂"),
]
CLASHES = ["found", "found_", "of", "bits", "label", "chunk", "n", "kept_id", "component_id", "part", "a.b", "id"]
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module", params=["rows", "none"])
def docs(spark, request):
    table = spark.createDataFrame(TEXTS if request.param == "rows" else [], "doc_id long, text string")
    table = table.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    for name in CLASHES:
        table = table.withColumn(name, F.lit("x"))
    return table.cache()


def rows_of(docs):
    return sorted(((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=str)


def test_benchmark_passages(spark, docs):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "Words HERE again"), (3, "words here"), (None, "same")], "item_id long, text string")
    got = decontamination.find_benchmark(docs, items)
    assert got.columns[:-1] == docs.columns
    for r in got.collect():
        found = r[-1]
        hit = r.text is not None and r.text.startswith("the same")
        assert [(s.start, s.end) for s in found.spans] == ([(1, 5)] if hit else [])
        assert [(m.item_id, m.n_words, m.doc_start) for m in found.matches] == ([("3", 3, 2)] if hit else [])
    clean = decontamination.clean_documents(docs, items)
    assert clean.columns == docs.columns
    assert clean.count() == sum(not (t or "").startswith("the same") for _, t in rows_of(docs))
    none = decontamination.find_benchmark(docs, items.limit(0))
    assert all(not r[-1].spans for r in none.collect())


def test_blocks_of_a_benchmark_add_up(spark):
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(i, " ".join(words[i : i + 30])) for i in range(0, 31, 5)], "doc_id long, text string")
    items = spark.createDataFrame([(i, " ".join(words[i : i + 14])) for i in range(0, 45, 3)], "item_id long, text string")

    def result(size):
        found = decontamination.find_benchmark(docs, items, ["doc_id"], block_bytes=size)
        return sorted((r.doc_id, tuple(r[-1].spans), tuple(r[-1].matches)) for r in found.collect())

    assert result(1 << 20) == result(150)


def test_personal_data(docs):
    found = pii.find_personal_data(docs)
    assert all(r[-1].spans == "" and r[-1].redacted == r.text for r in found.collect())
    assert pii.redacted_documents(docs).columns == docs.columns


def test_redaction_and_further_kinds():
    text = "IBAN DE89370400440532013000, ssn 219-09-9999, mail a.b@c.org at 10.0.0.256 or 10.0.0.1"
    spans = pii.find_spans(text)
    assert [s.kind for s in spans] == ["email", "ip", "iban", "ssn"]
    assert pii.redact(text, spans) == "IBAN [IBAN], ssn [SSN], mail [EMAIL] at 10.0.0.256 or [IP]"
    assert not pii.find_spans("number 219-09-9999 DE89370400440532013001")


def test_language(docs):
    model = language_id.fit(docs, F.lit(True))
    got = {(r.doc_id, r.text): r[-1] for r in language_id.predict(docs, model).collect()}
    for (_, text), found in got.items():
        lettered = any(c.isalpha() for c in text or "")
        assert found.lang == ("en" if lettered else "und") and found.rejected != lettered and 0 <= found.score <= 1
    assert language_id.accepted_documents(docs, model).columns == docs.columns
    signs = docs.sparkSession.createDataFrame([("² ½ Ⅷ ٣",), ("ª",)], "text string")
    assert [r[-1].lang for r in language_id.predict(signs, model).collect()] == ["und", "en" if model else "und"]
    nothing = language_id.fit(docs, F.lit(False))
    assert nothing is None
    assert language_id.accepted_documents(docs, nothing).count() == language_id.accepted_documents(docs, model).count()


def invented(n_languages, n_rows, seed=3):
    """n_rows[k] texts of an invented language k each, from words of its own: (label, text)."""
    rng, letters, rows = np.random.default_rng(seed), list("abcdefghijklmnopqrstuvwxyz"), []
    for k in range(n_languages):
        words = ["".join(rng.choice(letters, 5)) for _ in range(12)]
        rows += [(f"l{k:02}", " ".join(rng.choice(words, 12))) for _ in range(n_rows[k])]
    return rows


def labelled(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string")


def called(table, model):
    """(lang, what it is called) of the rows and the struct found."""
    return [(r.lang, r[-1]) for r in language_id.predict(table, model).collect()]


def test_a_rare_language_is_learned(spark):
    table = labelled(spark, invented(9, [1500] * 8 + [25]))
    model = language_id.fit(table, F.lit(True), rows_per_language=100)
    rare = [found.lang for lang, found in called(table, model) if lang == "l08"]
    assert rare.count("l08") >= 24


def test_every_language_is_learned(spark):
    table = labelled(spark, invented(70, [20 + k % 2 for k in range(70)]))
    model = language_id.fit(table, F.lit(True))
    found = called(table, model)
    assert len(model.languages) == 70 and {lang for lang, f in found if f.lang == lang} == set(model.languages)
    assert sum(lang == f.lang for lang, f in found) >= 0.97 * len(found)


@pytest.mark.parametrize("n_learned", [2, 4])
def test_texts_of_a_language_not_learned_are_rejected(spark, n_learned):
    table = labelled(spark, invented(n_learned + 1, [300] * (n_learned + 1)))
    model = language_id.fit(table, F.col("lang") != f"l{n_learned:02}")
    rejected = {True: [], False: []}
    for lang, found in called(table, model):
        rejected[lang in model.languages].append(found.rejected)
    assert np.mean(rejected[True]) <= 0.01 and np.mean(rejected[False]) >= 0.3


def test_copies_are_learned_from_once(spark, monkeypatch):
    rows = invented(3, [1000, 1000, 60])
    table = labelled(spark, rows + rows[-1:] * 1000)
    seen, train, calibrate = [], language_id.train, language_id.calibrate

    def noted(step, bags, labels):
        seen.extend((step, label, at.tobytes(), share.tobytes()) for (at, share), label in zip(bags, labels))

    monkeypatch.setattr(language_id, "train", lambda b, l, n: noted("train", b, l) or train(b, l, n))
    monkeypatch.setattr(language_id, "calibrate", lambda m, b, l: noted("calibrate", b, l) or calibrate(m, b, l))
    language_id.fit(table, F.lit(True), rows_per_language=60)
    assert len(seen) == len({s[1:] for s in seen}) and sum(s[1] == 2 for s in seen) == 60


def test_encoding(docs):
    ranks = bpe.codec(PATH, public_tokenizers.PATTERN).ranks
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in bpe.encode_documents(docs, PATH, public_tokenizers.PATTERN).collect():
        ids = plain.encode_ordinary(r.text or "")
        assert r[-1].ids == ids and r[-1].n_tokens == len(ids)
        assert r[-1].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_simhash(docs):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, set()).add(r.component_id)
    if got:
        assert by_id[1] == by_id[2] == by_id[3] == {1} and by_id[4] == by_id[5] == {4} and by_id[7] == by_id[8] == {7}
        assert by_id[None] == {1, 4}
    kept = simhash.distinct_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == ([1, 4, 6, 7, 9] if got else [])


def test_simhash_without_ids_keeps_one(spark):
    docs = spark.createDataFrame([(None, "a b c d e"), (None, "a b c d e"), (7, "q r s"), (7, "q r s")], "doc_id long, text string")
    assert sorted(map(str, simhash.distinct_documents(docs).collect())) == sorted(
        map(str, spark.createDataFrame([(None, "a b c d e"), (7, "q r s")], "doc_id long, text string").collect())
    )


def test_repeats(docs):
    got = substring_dedup.remove_repeats(docs)
    for r in got.collect():
        assert r.n_removed == sum(s.end - s.start for s in r.repeats)
        if r.id == 8:
            assert r.n_removed == r.n_words == 40_001 and r.kept == ""
        if r.id is not None and r.id < 7:
            assert r.n_removed == 0
    assert got.count() == docs.count()


def test_toxicity(spark, docs):
    labels = spark.createDataFrame([(1, 0, None), (4, 1, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    found = toxicity.score(docs, model, ["doc_id"]).collect()
    assert len(found) == docs.count() and all(0 <= r.found.score <= 1 for r in found)


def test_disguised_words_are_restored(spark):
    plain = "you are an idiot and a moron said the clown to that stupid pathetic loser in the trash"
    docs = spark.createDataFrame([(i, plain) for i in range(50)], "doc_id long, text string")
    decoder = toxicity.Decoder(toxicity.trigram_costs(toxicity.trigram_counts(docs)))
    for disguised, meant in {
        "1d10t": "idiot", "m0r0n": "moron", "i d i o t": "idiot", "s.t.u.p.i.d": "stupid", "cloooown": "clown",
        "$tup1d": "stupid", "p4thet1c": "pathetic", "555-3824": "555-3824", "trash!!": "trash!!",
    }.items():
        assert decoder.restore(disguised) == meant


def test_long_and_short_disguises_are_restored(spark):
    plain = "you are an idiot and a moron said the clown to that stupid pathetic loser in the trash"
    docs = spark.createDataFrame([(i, plain) for i in range(50)], "doc_id long, text string")
    decoder = toxicity.Decoder(toxicity.trigram_costs(toxicity.trigram_counts(docs)))
    for disguised, meant in {
        "id" + "i" * 62 + "ot": "idiot", "cl" + "o" * 3000 + "wn": "clown", "y o u": "you",
        "i  d  i  o  t": "idiot", "s\tt\tu\tp\ti\td": "stupid", "1 0 5": "1 0 5", "a b": "a b",
    }.items():
        assert decoder.restore(disguised) == meant


def test_toxic_words_count_by_their_surest_form():
    model = toxicity.Model(np.zeros((28, 28, 28)), {"lout": 2.0, "lout-": 3.0, "loutis-": 1.0, "oaf": 4.0})
    assert toxicity.beginnings("lout") == [] and toxicity.beginnings("loutish") == ["lout-", "louti-", "loutis-"]
    assert model.features({"lout", "loutish", "oaf", "kind"}) == [4.0, 3.0, 2.0, math.log1p(9), math.log1p(4)]
    assert model.features(set()) == [0.0] * 5


def test_pages(spark):
    html = '<div class="nav">menu</div><div class="post-7"><h1>Title</h1><p>Some&nbsp;text<br>here &amp; there<p>More</div><footer>f</footer>'
    rows = [(1, "http://h/1", html), (2, "http://h/2", html.replace("7", "8")), (3, "http://h/3", None), (4, None, ""), (4, None, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"of": F.lit(1), "path": F.lit(2), "host": F.lit(3)})
    got = sorted((r.id, r.text) for r in html_text.extract(pages).collect())
    whole = "Title Some text here & there More"
    assert got == [(1, whole), (2, whole), (3, ""), (4, ""), (4, "")]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_a_hosts_pages_outvote_one_of_them():
    usual = html_text.Page('<div class="text">' + "<p>word word word</p>" * 5 + '</div><div class="box"><p>short</p></div>')
    odd = html_text.Page('<div class="text"><p>word</p></div><div class="box"><p>' + "much " * 50 + "</p></div>")
    path = max(usual.votes(), key=lambda k: usual.votes()[k])
    assert odd.text(path) == "word" and odd.text(None).startswith("much")


def test_archives(spark, tmp_path):
    long = "é" * 40_000 + "WARC/1.1\r\n" * 3
    rows = [(1, "u", "a"), (2, None, "a"), (3, "u u\r\n", long), (4, "u", long), (5, "u", None), (5, "u", ""), (6, "u", ""), (None, "u", "b")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"first": F.lit(1), "sum": F.lit(2), "same": F.lit(3)})
    warc.write_archives(pages, f"{tmp_path}/w", segment_bytes=1000, archive_records=7)
    records = warc.read_records(spark, f"{tmp_path}/w")
    assert records.where("not whole").count() == 0
    got = {r.record_id.split(":")[2]: r for r in warc.pages_again(records).collect()}
    assert {k: r.type for k, r in got.items()} == {
        "1": "response", "2": "revisit", "3": "response", "4": "revisit", "5": "response", "6": "revisit", "": "response"
    }
    assert got["4"].payload_bytes == len(long.encode()) and got["4"].payload_digest == warc.base32_sha1(long.encode())
    assert records.where("type = 'response'").count() == 5
    warc.write_archives(pages.limit(0), f"{tmp_path}/none")
    assert warc.read_records(spark, f"{tmp_path}/none").count() == 0


def test_copies_of_pages_are_read_apart(spark, tmp_path, monkeypatch):
    rows = [(None, "u", "b")] * 20 + [(None, "u", "é" * 3000)] * 20 + [(5, "u", "é" * 2000)] * 20 + [(6, "u", "é" * 2000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archives(pages, f"{tmp_path}/w", segment_bytes=1000, archive_records=7)
    groups, annotate = [], warc.annotate
    monkeypatch.setattr(warc, "annotate", lambda df, *more: groups.append(df) or annotate(df, *more))
    records = warc.read_records(spark, f"{tmp_path}/w")
    assert groups[0].where("size(heads) > 1 or size(parts) > 7").count() == 0
    assert records.where("type = 'response' and whole").count() == 60 and records.where("not whole").count() == 0
    assert sorted({r.payload_bytes for r in warc.pages_again(records).collect()}) == [1, 4000, 6000]
    assert warc.pages_again(records).count() == 61


def test_broken_segments_and_framing():
    block = warc._HTTP + warc.chunked(b"abc" * 10, 7)
    assert warc.payload_of(block) == b"abc" * 10 and warc.payload_of(block[:-9]) is None
    parts = [{"number": 2, "total": 6, "block": b"def"}, {"number": 1, "total": None, "block": b"abc"}]
    assert warc.together(parts) == b"abcdef"
    assert warc.together(parts[:1]) is None and warc.together([{**parts[0], "total": 7}, parts[1]]) is None


def test_vectors(spark):
    nan = float("nan")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.01], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0], 1),
        (8, [nan, 1.0], 1), (9, [None, 1.0], 1), (10, [1.0, 0.0], 1), (10, [1.0, 0.0], 1), (11, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 2),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({"node": F.lit(1), "v": F.lit(2), "n": F.lit(3)})
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in vector_dedup.near_duplicates(table).collect()), key=str)
    linked = {1: (3, 1), 2: (3, 1), 3: (1, 3), 10: (3, 1), None: (1, 3)}
    expected = sorted(((i, *linked.get(i, (0, i)), i == linked.get(i, (0, i))[1]) for i, _, _ in rows), key=str)
    assert got == expected
    assert vector_dedup.near_duplicates(table.limit(0)).count() == 0


def test_split_lists_find_the_same(spark, monkeypatch):
    import random

    random.seed(5)
    base = [[random.gauss(0, 1) for _ in range(8)] for _ in range(12)]
    rows = [(i, [x + random.gauss(0, 0.12) for x in base[i % 12]], 0) for i in range(240)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")

    def result():
        return sorted(map(tuple, vector_dedup.near_duplicates(table).collect()))

    whole = result()
    monkeypatch.setattr(vector_dedup, "BLOCK", 7)
    assert result() == whole and sum(r[1] for r in whole) > 0


def test_components_of_a_long_chain(spark):
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert components(links).agg(F.count("*"), F.max("root"), F.min("root")).first() == (301, 0, 0)


def test_pipeline(spark, docs, tmp_path):
    folder = f"{tmp_path}/{docs.count()}"
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, "no such words")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r.doc_id for r in got) == ([4, 7, 9] if docs.count() else [])


def test_added_names_the_last_column(docs):
    found = pii.find_personal_data(docs, keep=["found", "found_"])
    assert found.columns == ["found", "found_", "found__"] and found.select(added(found, "spans")).count() == docs.count()
