"""Toxicity on texts held out, by language; the pipeline against plain versions of its stages."""

import hashlib
import re
from collections import Counter

import public_tokenizers
import tiktoken
import xxhash

import corpus_pipeline
from chronoweave.llm import bpe, language_id, pii
from chronoweave.llm import queries as Q


def test_toxic_texts_held_out_are_found_in_every_language(spark):
    folder = "/root/testdata/sf0.1"
    toxic = {r.doc_id: r.toxic for r in Q.table(spark, folder, "labels").collect()}
    lang = {r.doc_id: r.lang for r in Q.table(spark, folder, "documents").collect()}
    seen = Counter()
    for r in Q.op7_toxicity(spark, folder).collect():
        if r.held_out and toxic.get(r.doc_id) is not None:
            seen[lang[r.doc_id], toxic[r.doc_id], r.predicted] += 1
    found = {x: seen[x, 1, 1] / (seen[x, 1, 0] + seen[x, 1, 1]) for x in ("en", "es", "de", "fr")}
    assert min(found.values()) >= 0.6, found
    right, wrong = (sum(n for (_, t, p), n in seen.items() if p and t == kind) for kind in (1, 0))
    assert right >= 0.85 * sum(n for (_, t, _), n in seen.items() if t) and right >= 0.97 * (right + wrong)


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def one_of_each(docs):
    prints = {d: fingerprint(t) for d, t in docs.items()}
    root, before = {d: d for d in docs}, None
    while root != before:
        before = dict(root)
        for a in docs:
            root[a] = min(root[b] for b in docs if (prints[a] ^ prints[b]).bit_count() <= 4)
    return {d: t for d, t in docs.items() if root[d] == d}


def passages(items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for text in items:
        words = word.findall(lower(text))
        n = min(10, len(words))
        windows |= {tuple(words[i : i + n]) for i in range(len(words) - n + 1 if n else 0)}
    sizes = {len(w) for w in windows}

    def held(text):
        words = word.findall(lower(text))
        return any(tuple(words[i : i + n]) in windows for n in sizes for i in range(len(words) - n + 1))

    return held


def test_the_pipeline_is_what_its_stages_say(spark):
    folder = "/root/testdata/sf0.001"
    table = Q.table(spark, folder, "documents")
    model = language_id.fit(table, language_id.remainder(table.doc_id, 5) != 0)
    accepted = {r.doc_id for r in language_id.predict(table, model).collect() if not r[-1].rejected}
    docs = {r.doc_id: r.text or "" for r in table.collect() if r.doc_id in accepted}
    assert 0.5 * table.count() < len(docs)
    held = passages([r.text or "" for r in Q.table(spark, folder, "benchmark").collect()])
    kept = {d: t for d, t in one_of_each(docs).items() if not held(t)}
    assert len(kept) < len(docs)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = bpe.codec(path, public_tokenizers.PATTERN).ranks
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert sorted(got) == sorted(kept)
    for d, text in kept.items():
        clean = pii.redact(text, pii.find_spans(text))
        ids = library.encode_ordinary(clean)
        assert (got[d].n_tokens, list(got[d].ids)) == (len(ids), ids)
        assert got[d].decoded_sha256 == hashlib.sha256(clean.encode()).hexdigest()
