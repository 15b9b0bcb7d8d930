"""Spelling variants: words one edit apart, found through pairs of trie nodes, grouped by frequency.

Every prefix of the words is a node of the forward trie, every suffix one of the trie of the
reversed words, and each node has a number. Leaving out the letter at place i of a word names the
pair (node of what stands before i, node of what stands behind it). Two words that differ in
the letter at i name the same pair; a word that has one letter more than another names the pair
into which the other parts at i. So joining integer pairs gives exactly the words one edit apart.
A pair has one row for each letter that may stand there, so no group outgrows the alphabet.

Tries are numbered without building them: in sorted order a word's nodes are those of the word
before it, as far as both go, and new ones. What a range of the sorted words must know of the ranges
beside it is their first and last word and the last word's nodes.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronoweave.llm.common import checkpoint, quoted

#: A word's form is used at least so many times as often as the word.
RATIO = 10
#: Of the counted words: fewest letters and occurrences; one run in so many loses a letter.
LEAST_LETTERS, LEAST_COUNT, MISSPELT = 7, 2, 31
#: Different words that a task counts before it passes the counts on.
COUNTED = 300_000

_RUN = re.compile("[a-zÀ-ÿ]+")
_PAIRS = "array<struct<p:bigint,s:bigint,role:int>>"


def run_counts(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): how often each word stands in the whole texts of docs.

    Words are longest runs of A-Z, a-z and U+00C0 to U+00FF, of which A-Z become small. Where
    MISSPELT divides h, the CRC-32 of "<id>:<word>", the letter at h modulo the length is left out.
    Words below LEAST_LETTERS or LEAST_COUNT are dropped. Null and empty texts have no words, a null
    id counts as empty, repeated rows count again, an empty table gives an empty one.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "n"])
            seen.clear()
            return batch

        for batch in batches:
            for name, content in zip(*batch.columns):
                start = zlib.crc32(f"{name.as_py() or ''}:".encode())
                # Bytes in lower case: only A-Z change.
                runs = _RUN.findall((content.as_py() or "").encode().lower().decode())
                for word, n in Counter(w for w in runs if len(w) >= LEAST_LETTERS).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % MISSPELT == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    seen[word] += n
                if len(seen) > COUNTED:
                    yield counted()
        yield counted()

    texts = docs.select(docs[quoted(id)].cast("string").alias("id"), docs[quoted(text)].alias("text"))
    total = texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return total.where((F.char_length("word") >= LEAST_LETTERS) & (F.col("n") >= LEAST_COUNT))


# Numbered tries ------------------------------------------------------------------------------


def common(a: str, b: str) -> int:
    """Letters that a and b begin with alike."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low = 0  # a[:low] == b[:low], a[:n] != b[:n]
    while n - low > 1:
        mid = (low + n) // 2
        low, n = (mid, n) if a[low:mid] == b[low:mid] else (low, mid)
    return low


def _ends(keys: Iterator[str]) -> dict | None:
    """What a sorted range tells the ranges beside it; node numbers count from the range's start."""
    first, last, nodes, base = None, "", [], 0
    for key in keys:
        alike = common(last, key) if first is not None else -1
        first = key if first is None else first
        nodes[alike + 1 :] = range(base + alike + 1, base + len(key) + 1)
        base, last = base + len(key) + 1, key
    return None if first is None else {"first": first, "last": last, "nodes": nodes, "size": base}


def trie_nodes(rows: DataFrame, key: str) -> DataFrame:
    """rows with `nodes`: the number of each of key's prefixes that another key has, the empty one first.

    Keys are different and not null. The number of a prefix is that of its first key in code-point order
    plus the prefix's length, so numbers differ and grow in that order; the whole key's is in `own`.
    """
    ordered = checkpoint(rows.repartitionByRange(F.col(key)).sortWithinPartitions(key))
    at = ordered.columns.index(key)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _ends(k for b in batches for k in b.column(0).to_pylist())
        if found:
            yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), **found}], schema=ends_schema)

    ends_schema = pa.schema([("part", pa.int32()), ("first", pa.string()), ("last", pa.string()), ("nodes", pa.list_(pa.int64())), ("size", pa.int64())])
    # One row for each range of the sorted keys.
    ranges = ordered.select(key).mapInArrow(ends, "part int, first string, last string, nodes array<long>, size long").orderBy("part").collect()
    start, last, nodes, beside = 0, None, [], {}
    for i, r in enumerate(ranges):
        alike = common(last, r.first) if last is not None else -1
        beside[r.part] = (start, last, nodes[: alike + 1], ranges[i + 1].first if i + 1 < len(ranges) else None)
        # A prefix that the range's first key has is numbered by its length there; so it may be older.
        nodes = [nodes[k] if n == k and k <= alike else start + n for k, n in enumerate(r.nodes)]
        start, last = start + r.size, r.last
    shared = rows.sparkSession.sparkContext.broadcast(beside)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, last, nodes, behind = shared.value.get(TaskContext.get().partitionId(), (0, None, [], None))
        nodes, batch = list(nodes), next(batches, None)
        while batch is not None:
            following = next((b for b in batches if b.num_rows), None)
            keys = batch.column(at).to_pylist()
            nexts = [*keys[1:], following.column(at)[0].as_py() if following else behind]
            own, lists = [], []
            before = common(last, keys[0]) if keys and last is not None else -1
            for word, coming in zip(keys, nexts):
                after = common(word, coming) if coming is not None else -1
                nodes[before + 1 :] = range(base + before + 1, base + len(word) + 1)
                own.append(nodes[-1])
                lists.append(nodes[: max(before, after) + 1])
                base, last, before = base + len(word) + 1, word, after
            columns = [*batch.columns, pa.array(own, pa.int64()), pa.array(lists, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "own", "nodes"])
            batch = following

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema)
    return ordered.mapInArrow(number, f"{fields}, own long, nodes array<long>")


# Neighbours ----------------------------------------------------------------------------------


def node_pairs(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(number, n, p, s, role), the pairs of nodes under which words of (word, n) meet, and (number, word, n).

    number is the word's, growing in code-point order. role is 0 where the word parts into the pair,
    else a letter is left out: 1, or 2 if the letter before it is the same, so that leaving out either gives
    one word. Pairs with a node that no other word has are left out.
    """
    forward = trie_nodes(words.select("word", "n"), "word").withColumnRenamed("own", "number").withColumnRenamed("nodes", "pre")
    forward = checkpoint(forward)
    backward = trie_nodes(forward.select(F.reverse("word").alias("backward"), F.col("number").alias("of")), "backward")
    both = forward.join(backward.select("of", F.col("nodes").alias("suf")), F.col("number") == F.col("of"))
    both = both.withColumns({"size": F.char_length("word"), "deep": F.size("pre") - 1, "near": F.size("suf") - 1, "letters": F.split("word", "")})
    size, deep, near = F.col("size"), F.col("deep"), F.col("near")

    def parted(i: Column) -> Column:
        return _pair(i, size - i, F.lit(0))

    def left_out(i: Column) -> Column:
        alike = (i > 0) & (F.get("letters", F.greatest(i - 1, F.lit(0))) == F.get("letters", i))
        return _pair(i, size - 1 - i, F.when(alike, 2).otherwise(1))

    pairs = F.concat(
        _at_places(F.greatest(F.lit(0), size - near), F.least(deep, size), parted),
        _at_places(F.greatest(F.lit(0), size - 1 - near), F.least(deep, size - 1), left_out),
    )
    return both.select("number", "n", F.inline(pairs)), forward.select("number", "word", "n")


def _pair(prefix: Column, suffix: Column, role: Column) -> Column:
    return F.struct(F.get("pre", prefix).alias("p"), F.get("suf", suffix).alias("s"), role.cast("int").alias("role"))


def _at_places(low: Column, high: Column, make: Callable[[Column], Column]) -> Column:
    """An array with make(i) for each place i from low to high; empty if there is none."""
    return F.when(low <= high, F.transform(F.sequence(low, high), make)).otherwise(F.array().cast(_PAIRS))


def near_words(pairs: DataFrame) -> DataFrame:
    """(of, n_near, best) for each word, by its number, that has words one edit apart.

    best is the near word of largest n, of equals the first in code-point order: a struct of n and
    minus its number. A pair of words that differ in a letter meets under one pair of nodes; one of which
    a letter is left out too, as of equal letters in a row only the first counts.
    """
    group = W.partitionBy("p", "s")
    ranked = group.orderBy(F.desc("n"), "number")
    whole = ranked.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    one = F.struct(F.col("n").alias("n"), (-F.col("number")).alias("number"))
    met = pairs.withColumns(
        {
            "rows": F.count("*").over(group),
            "whole": F.count_if(F.col("role") == 0).over(group),
            "first": F.count_if(F.col("role") == 1).over(group),
            "best": F.first(one).over(whole),
            "second": F.nth_value(one, 2).over(whole),
        }
    ).where("rows > 1")
    left_out = F.col("rows") - F.col("whole")
    n_near = F.when(F.col("role") == 0, F.col("first")).when(F.col("role") == 1, left_out - 1 + F.col("whole")).otherwise(left_out - 1)
    best = F.when(F.col("best.number") == -F.col("number"), F.col("second")).otherwise(F.col("best"))
    each = met.select(F.col("number").alias("of"), n_near.alias("n_near"), best.alias("best"))
    return each.groupBy("of").agg(F.sum("n_near").alias("n_near"), F.max("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(of, root) from (of, form): the last word that following forms leads to.

    n grows at least RATIO-fold from a word to its form, so there are no rings and few steps; each round
    doubles the steps taken.
    """
    reached = checkpoint(forms.select("of", F.col("form").alias("root")))
    while True:
        further = reached.select(F.col("of").alias("at"), F.col("root").alias("last"))
        moved = reached.join(further, F.col("root") == F.col("at"), "left")
        moved = checkpoint(moved.select("of", F.coalesce("last", "root").alias("root"), F.col("last").isNotNull().alias("moved")))
        reached = moved.select("of", "root")
        if not moved.agg(F.max("moved")).first()[0]:
            return reached


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each of the different words of (word, n).

    Words are near if exactly one code point is inserted, deleted or replaced between them, whatever letters
    they have. n_near counts the near words. form is the near word of largest n, of equals the first in
    code-point order, if its n, form_n, is at least ratio (over 1) times the word's; else both are null. root is
    the word that following forms leads to, the word itself if it has no form. Rows of one word add up, null
    words are dropped, an empty word is one like any other, a null n counts nothing, an empty table gives an
    empty one.
    """
    given = words.where("word is not null").groupBy("word").agg(F.coalesce(F.sum(F.col("n").cast("long")), F.lit(0).cast("long")).alias("n"))
    pairs, numbered = node_pairs(given)
    near = checkpoint(near_words(pairs))
    joined = numbered.join(near, F.col("number") == F.col("of"), "left")
    formed = checkpoint(
        joined.where((F.col("best.n") >= ratio * F.col("n")) & (F.col("best.n") > F.col("n")))
        .select("of", (-F.col("best.number")).alias("form"), F.col("best.n").alias("form_n"))
    )
    names = numbered.select(F.col("number").alias("named"), F.col("word").alias("name"))
    led = formed.join(roots(formed).withColumnRenamed("of", "start"), F.col("of") == F.col("start"))
    led = led.join(names, F.col("form") == F.col("named")).select("of", "form_n", "root", F.col("name").alias("form"))
    led = led.join(names, F.col("root") == F.col("named")).select(F.col("of").alias("start"), "form_n", "form", F.col("name").alias("root"))
    return joined.join(led, F.col("number") == F.col("start"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )
