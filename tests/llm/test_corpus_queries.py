"""The registered corpus queries over the small tables, against SQL or a plain brute-force version."""

import hashlib
import html
import re
import zlib

import duckdb
import pytest
import xxhash

from chronoweave.llm import queries as Q

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def texts(spark, folder):
    return {r.doc_id: r.text or "" for r in Q.documents(spark, folder).collect()}


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_same_rows_as_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        db.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    found = Q.QUERIES[name](spark, SMALL)
    wanted = db.execute(f"select {', '.join(found.columns)} from ({Q.ORACLE[name]})").fetchall()
    assert sorted(map(tuple, found.collect()), key=str) == sorted(wanted, key=str)


def test_contaminated_documents(spark):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for r in Q.table(spark, SMALL, "benchmark").collect():
        words = pattern.findall(lower(r.text or ""))
        n = min(10, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add(str(r.item_id))
    docs = texts(spark, SMALL)
    for r in Q.op1_decontamination(spark, SMALL).collect():
        words, hit, items = pattern.findall(lower(docs[r.doc_id])), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if own := windows.get(tuple(words[i : i + n])):
                    hit.update(range(i, i + n))
                    items |= own
        assert tuple(r) == (r.doc_id, len(words), len(hit), len(items), sha(",".join(sorted(items))), bool(hit))


def test_personal_data(spark):
    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def good(kind, text):
        digits = [int(c) for c in text if c in "0123456789"]
        luhn = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
        return {
            "email": True,
            "ip": kind != "ip" or all(int(p) <= 255 for p in text.split(".")),
            "card": 13 <= len(digits) <= 19 and luhn % 10 == 0,
            "phone": 9 <= len(digits) <= 15,
        }[kind]

    docs = texts(spark, MIDDLE)
    for r in Q.op2_personal_data(spark, MIDDLE).collect():
        spans = [(k, *m.span()) for k, p in kinds.items() for m in re.finditer(p, docs[r.doc_id]) if good(k, m[0])]
        assert r.base_sha256 == sha(",".join(f"{k}:{s}:{e}" for k, s, e in spans))
        assert [r[f"n_{k}"] for k in kinds] == [sum(s[0] == k for s in spans) for k in kinds]


def test_simhash_components(spark):
    docs = texts(spark, SMALL)

    def bits(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    print_of = {d: bits(t) for d, t in docs.items()}
    root = {d: d for d in docs}
    for _ in docs:
        before = dict(root)
        for a in docs:
            root[a] = min(root[b] for b in docs if (print_of[a] ^ print_of[b]).bit_count() <= 4)
        if root == before:
            break
    for r in Q.op9_simhash(spark, SMALL).collect():
        assert tuple(r) == (r.doc_id, f"{print_of[r.doc_id]:016x}", root[r.doc_id])


def test_language_of_documents_held_out(spark):
    lang = {r.doc_id: r.lang for r in Q.table(spark, MIDDLE, "documents").collect()}
    rows = Q.op4_language(spark, MIDDLE).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows) and len(rows) == len(lang)
    held_out = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held_out) >= 0.97 * len(held_out)


def test_toxicity_of_documents_held_out(spark):
    toxic = {r.doc_id: r.toxic for r in Q.table(spark, MIDDLE, "labels").collect()}
    rows = [r for r in Q.op7_toxicity(spark, MIDDLE).collect() if r.held_out and r.doc_id in toxic]
    right = sum(r.predicted == toxic[r.doc_id] for r in rows)
    assert right >= 0.9 * len(rows) and any(r.predicted for r in rows)


def test_main_text(spark):
    got = {r.page_id: r for r in Q.op6_html_text(spark, SMALL).collect()}
    for r in Q.table(spark, SMALL, "pages").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.DOTALL)[1]
        plain = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)[^>]*>", " ", article))
        text = " ".join(html.unescape(plain).split())
        assert (got[r.page_id].text, got[r.page_id].n_chars) == (text, len(text))
